"""The pipeline against a plain version of all five stages, on a small table."""

import collections
import hashlib
import math
import random

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken

from skyscreen.llm import bpe

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def rand_text(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 7))) for _ in range(n))


def fixture():
    """Rows of clean, dirty, short and repeating texts, shared passages, exact and near copies."""
    rng = random.Random(7)
    passage = [rand_text(rng, 12) for _ in range(5)]
    rows, bad = [], {}
    for i in range(240):
        lines = [rand_text(rng, 12) for _ in range(8)]
        kind = i % 12
        if kind in (1, 5):  # rejected by the learned list
            lines = [" ".join(w + "&&&" for w in x.split()) for x in lines]
        elif kind == 2:
            lines = lines[:1]
        elif kind == 3:
            lines = ["to be or not " * 30]
        elif kind == 4:
            lines[3:3] = passage
        elif kind == 6:
            lines = [rand_text(rng, 120)]
        elif kind == 7:  # a near copy of the row before
            w = rows[-1][1].split()
            w[60] = f"other{i}"
            lines = [" ".join(w)]
        elif kind == 8 and i > 12:  # an exact copy of an early row
            lines = rows[0][1].split("\n")
        bad[i] = kind in (1, 5)
        rows.append((i, "\n".join(lines), "en", ("web", "book", None, "code")[i // 3 % 4]))
    return rows, bad


def after_rules(rows, bad):
    out = []
    for row in rows:
        w = row[1].split()
        windows = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        inside = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        if len(w) >= 50 and 2 * len(inside) <= len(w) and not bad[row[0]]:
            out.append(row)
    return out


def after_lines(rows):
    places, out = collections.defaultdict(list), []
    lines = [r[1].split("\n") for r in rows]
    for d, ls in enumerate(lines):
        gone = set()
        for j, x in enumerate(ls):
            for e, i in places[x]:
                n = 0
                while j + n < len(ls) and i + n < len(lines[e]) and ls[j + n] == lines[e][i + n]:
                    n += 1
                if sum(len(y.split()) for y in ls[j : j + n]) >= 25:
                    gone |= set(range(j, j + n))
            places[x].append((d, j))
        if len(gone) < len(ls):
            out.append((rows[d][0], "\n".join(x for j, x in enumerate(ls) if j not in gone), *rows[d][2:]))
    return out


def after_near(rows):
    words = [r[1].split() for r in rows]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in words]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                lo, hi = sorted((find(i), find(j)))
                up[hi] = lo
    return [r for i, r in enumerate(rows) if find(i) == i]


def after_mix(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    size = [sum(len(r[1].split()) for r in by[s]) for s in names]
    target, open_, left = {}, set(range(len(names))), 1.5 * sum(size)
    while open_:
        weight = {i: (5, 2, 1)[i % 3] for i in open_}
        full = {i for i in open_ if left * weight[i] / sum(weight.values()) > 2 * size[i]}
        for i in full or open_:
            target[i] = 2.0 * size[i] if full else left * weight[i] / sum(weight.values())
        left -= sum(target[i] for i in full)
        open_ = open_ - full if full else set()
    out = []
    for i, s in enumerate(names):
        epochs = math.floor(target[i] / size[i] + 1e-12)
        rest, below = target[i] - epochs * size[i], 0

        def key(r):
            u = (int(hashlib.md5(f"mix:{r[0]}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
            symbols = sum(c in "#*$%&|<>!" for c in r[1])
            return -math.log(u) / max(0.1, 1 - 5 * symbols / max(len(r[1]), 1)), r[0]

        for r in sorted(by[s], key=key):
            n = len(r[1].split())
            out += [r] * (epochs + (rest > 0 and below + n / 2 <= rest))
            below += n
    return out


def test_pipeline_equals_plain_version(spark, tmp_path):
    rows, bad = fixture()
    columns = list(zip(*rows, strict=True))
    docs = pa.table({"doc_id": pa.array(columns[0], pa.int64()), "text": columns[1], "lang": columns[2], "source": columns[3], "n_chars": pa.array([len(x) for x in columns[1]], pa.int64())})
    pq.write_table(docs, tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array(list(bad), pa.int64()), "quality": pa.array([int(not x) for x in bad.values()], pa.int32()), "toxic": pa.array([0] * len(bad), pa.int32())}), tmp_path / "labels.parquet")
    expected = after_rules(rows, bad)
    sizes = [len(rows), len(expected)]
    for stage in (after_lines, after_near):
        expected = stage(expected)
        sizes.append(len(expected))
    assert sizes == sorted(set(sizes), reverse=True)  # every stage has something to drop
    expected = after_mix(expected)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    plain = []
    for r in expected:
        ids = library.encode_ordinary(r[1])
        plain.append((r[0], len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256(r[1].encode()).hexdigest()))
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(plain)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    rows = pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string()), "lang": pa.array([], pa.string()), "source": pa.array([], pa.string()), "n_chars": pa.array([], pa.int64())})
    pq.write_table(rows, tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([], pa.int64()), "quality": pa.array([], pa.int32()), "toxic": pa.array([], pa.int32())}), tmp_path / "labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

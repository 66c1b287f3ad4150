"""What every operator and stage makes of null, empty, very long and repeated rows, of ids that repeat or are missing, and of
columns with clashing names: values, not only counts."""

import collections
import hashlib
import math
import zlib

import public_tokenizers
import pytest
import tiktoken

from skyscreen.llm import bpe, exact_dedup, language_id, line_dedup, minhash, mixing, ppm, quality_model, quality_rules, warc

corpus_pipeline = pytest.importorskip("corpus_pipeline")

#: Columns that clash with names the operators use inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, h long, digest string, bucket int, size long, key double, at int, s string, lines_before int, component string"
LONG = " ".join(f"w{hashlib.md5(str(i).encode()).hexdigest()[:5]}" for i in range(30_000))
PROSE = "\n".join(f"line {k} tale " + " ".join(hashlib.md5(f"{k} {j}".encode()).hexdigest()[:6] for j in range(12)) for k in range(6))
ROWS = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, PROSE, "b"), (4, PROSE, "b"), (5, PROSE.replace("tale", "story"), "b"),
    (6, "same id, first text", "b"), (6, "same id, second text", "c"), (None, "no id here", None), (None, "no id there", "a"), (None, "no id here", None), (7, LONG, "c"),
]


def frame(spark, rows=ROWS):
    more = ("r", 1, "d", 2, 3, 0.5, 4, "s", 5, "c")
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *more) for i, t, s in rows], DOCS)


def plain(t):
    return (t or "").lower().split()


def test_bpe(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [*ROWS, (8, "x" * 9000, "c"), (9, "日本語の長い文字列" * 600, "c"), (10, "".join(chr(97 + k * k % 26) for k in range(5000)), "c")]
    want = []
    for i, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    coded = bpe.encode_documents(frame(spark, rows), path, public_tokenizers.PATTERN, with_ids=True).cache()
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    assert sorted((tuple(r)[:4] for r in coded.collect()), key=key) == sorted(want, key=key)
    back = bpe.decode_documents(coded, path, public_tokenizers.PATTERN).collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in back) == collections.Counter((i, t or "") for i, t, _ in rows)
    gone = bpe.decode_documents(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), path, public_tokenizers.PATTERN).first()
    assert gone["text"] is None


def test_long_pieces_merge_as_short_ones():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = bpe.Bpe(ranks, public_tokenizers.PATTERN)
    import random

    import numpy as np

    rng = random.Random(3)
    for n in (2, 3, 17, 64, 65, 500):
        for letters in ("ab", "abcdefgh", "theinga "):
            piece = own.first[np.frombuffer("".join(rng.choices(letters, k=n)).encode(), np.uint8)]
            ids, ends = own.merge_rows(piece[None, :].copy(), np.array([n]))
            assert own.merge_long(piece).tolist() == ids[0, : ends[0]].tolist()


def test_line_dedup(spark):
    got = line_dedup.dedup_lines(frame(spark)).collect()
    cut = collections.Counter((r["doc_id"], r["text"], r["lines_before"], r["lines_removed"], r["source"], r["row"], r["h"]) for r in got)
    rest = collections.Counter((i, t, sum(bool(x.split()) for x in (t or "").split("\n")), 0, s, "r", 1) for i, t, s in ROWS)
    assert cut == rest  # rows that repeat an id and a text are one document, and no other text repeats 25 words
    twice = [(1, PROSE, "a"), (2, "head\n" + PROSE + "\n\ntail", "a"), (None, PROSE, "a"), (2, PROSE + "\nend", "a")]
    got = {(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(frame(spark, twice)).collect()}
    # the row without an id comes first and keeps the passage, all others lose it
    assert got == {(None, PROSE), (1, ""), (2, "head\n\ntail"), (2, "end")}
    assert line_dedup.dedup_lines(frame(spark).where("1 = 0")).columns == [c for c in frame(spark).columns if c != "lines_before"] + ["lines_before", "lines_removed"]


def test_mix(spark):
    got = mixing.mix(frame(spark)).collect()
    sizes = collections.Counter((i, len((t or "").split()), s) for i, t, s in ROWS)
    assert collections.Counter((r["doc_id"], r["size"], r["source"]) for r in got) == sizes
    by = collections.Counter()
    for i, t, s in ROWS:
        by[s] += len((t or "").split())
    for r in got:
        assert r["source_size"] == by[r["source"]] and r["taken"] in (0, r["size"], 2 * r["size"]) and r["target"] <= 2 * r["source_size"]
    rows = mixing.mix_rows(frame(spark)).collect()
    times = collections.Counter()
    for r in got:
        times[(r["doc_id"], r["size"], r["source"])] += r["taken"] // max(r["size"], 1)
    assert collections.Counter((r["doc_id"], len((r["text"] or "").split()), r["source"]) for r in rows) == +times
    assert all((r["row"], r["key"], r["size"]) == ("r", 0.5, 3) for r in rows)
    none = mixing.mix(frame(spark).where("1 = 0"))
    assert none.count() == 0 and mixing.mix_rows(frame(spark).where("1 = 0")).columns == frame(spark).columns


def test_mix_takes_weights_and_refines_a_large_source(spark):
    rows = [(i, "w " * (1 + i % 5), "s") for i in range(20_000)]
    d = frame(spark, rows)
    plain_, fine = (mixing.mix(d, share=0.5, few=few, bits=bits).collect() for few, bits in ((50_000, 12), (3, 3)))
    taken = lambda got: {r["doc_id"] for r in got if r["taken"]}
    assert taken(plain_) == taken(fine) and abs(sum(r["taken"] for r in fine) - fine[0]["target"]) <= 5
    from pyspark.sql import functions as F

    heavy = taken(mixing.mix(d, share=0.2, weight=F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.1)).collect())
    assert sum(i % 2 == 0 for i in heavy) > 0.75 * len(heavy)


def test_ppm(spark):
    got = ppm.score_documents(frame(spark)).collect()
    assert len(got) == len(ROWS)
    learned = [plain(t) for i, t, _ in ROWS if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    counts = collections.Counter(x for w in learned for x in [*w, None])
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for i, t, _ in ROWS:
        w = [*plain(t), None]
        want[(i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 4))] += 1
    assert collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    ends = {round(r["score"], 6) for r in got if r["doc_id"] in (1, 2, 3)}
    assert len(ends) == 1 and all(r["score"] < 0 for r in got)
    only_held = [(i, "a b", "s") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    for r in ppm.score_documents(frame(spark, only_held)).collect():
        assert r["train_tokens"] == r["n_known"] == 0 and r["score"] == pytest.approx(-4 * math.log10(256)) and r["base_score"] == 0


def test_quality_model(spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (7, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_model.classify(frame(spark), labels).collect()
    scores = collections.defaultdict(set)
    for r in got:
        scores[r["doc_id"]].add(round(r["score"], 9))
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 1)
    assert len(got) == len(ROWS) and scores[1] == scores[2] == scores[3] and len(scores[4]) == 1
    bare = quality_model.classify(frame(spark), labels.where("1 = 0")).collect()
    assert {(r["score"], r["predicted"]) for r in bare} == {(0.5, 1)}


def test_minhash(spark):
    got = collections.Counter(tuple(r) for r in minhash.near_duplicates(frame(spark), 3, 85).collect())
    ids = lambda t: len({tuple(plain(t)[k : k + 3]) for k in range(max(1, len(plain(t)) - 2))}) if plain(t) else 0
    groups = {1: 1, 2: 2, 3: 3, 4: 4, 5: 4 if _alike(PROSE, PROSE.replace("tale", "story")) else 5, 6: 6, 7: 7, None: None}
    assert got == collections.Counter((i, ids(t), groups[i], groups[i] == i) for i, t, _ in ROWS)
    rows = [(r["doc_id"], r["text"], r["source"], r["digest"], r["component"]) for r in minhash.drop_near_duplicates(frame(spark), 3, 85).collect()]
    kept = {(i, t) for i, t, _ in ROWS if i != 5 or groups[5] == 5}
    assert collections.Counter((i, t) for i, t, *_ in rows) == collections.Counter(kept) and all(r[3:] == ("d", "c") for r in rows)
    copies = [(None, "a b c d e f", "x"), (None, "A b c d e f", "x"), (9, "a b c d e f", "y"), (9, "a b c  d e f", "z")]
    assert [r["doc_id"] for r in minhash.drop_near_duplicates(frame(spark, copies)).collect()] == [9]
    assert {(r["component_id"], r["kept"]) for r in minhash.near_duplicates(frame(spark, copies[:2])).collect()} == {(None, True)}


def _alike(a, b, k=3, percent=85):
    x, y = ({tuple(plain(t)[j : j + k]) for j in range(len(plain(t)) - k + 1)} for t in (a, b))
    return 100 * len(x & y) >= percent * len(x | y)


def test_quality_rules(spark):
    labels = spark.createDataFrame([(7, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(frame(spark), labels).collect()
    want = collections.Counter((i, len((t or "").split()), sum(len(w) for w in (t or "").split())) for i, t, _ in ROWS)
    assert collections.Counter((r["doc_id"], r["n_words"], r["word_chars"]) for r in got) == want
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 50) and all(r["kept"] for r in got if r["doc_id"] in (4, 5))
    rows = quality_rules.keep_good(frame(spark), labels)
    assert rows.columns == frame(spark).columns
    assert collections.Counter((r["doc_id"], r["text"], r["row"], r["s"]) for r in rows.collect()) == collections.Counter((i, t, "r", "s") for i, t, _ in ROWS if i in (4, 5, 7))
    assert quality_rules.keep_good(frame(spark).where("1 = 0"), labels.where("1 = 0")).count() == 0


def test_exact_dedup(spark):
    got = exact_dedup.exact_groups(frame(spark)).collect()
    groups = collections.defaultdict(list)
    for i, t, _ in ROWS:
        groups[exact_dedup.normalise(t)].append(i)
    by = {hashlib.sha256(t).hexdigest(): ids for t, ids in groups.items()}
    seen = collections.Counter()
    for r in got:
        ids = by[r["text_sha256"]]
        some = [i for i in ids if i is not None]
        assert r["keep_id"] == (min(some) if some else None) and r["group_size"] == len(ids)
        seen[r["text_sha256"]] += r["kept"]
    assert len(got) == len(ROWS) and set(seen.values()) == {1}
    left = exact_dedup.deduplicate(frame(spark))
    assert left.columns == frame(spark).columns and left.count() == len(groups)
    assert sorted(hashlib.sha256(exact_dedup.normalise(r["text"])).hexdigest() for r in left.collect()) == sorted(by)


def test_language_id(spark):
    got = language_id.identify(frame(spark)).collect()
    assert len(got) == len(ROWS) and all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in got if r["doc_id"] in (1, 2, 3))
    assert all((r["lang_pred"], r["score"]) == ("en", 1.0) for r in got if r["doc_id"] in (4, 5, 6, 7, None))
    from pyspark.sql import functions as F

    bare = language_id.identify(frame(spark).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in bare} == {("und", 0.0)}
    assert language_id.identify(frame(spark).where("1 = 0")).count() == 0


def test_warc(spark):
    long = "<p>" + "many words " * 60_000 + "</p>"
    rows = [(1, "http://a/", "<p>x</p>", 5), (1, "http://a/", "<p>x</p>", 5), (2, None, "", 5), (None, "http://b/", None, 5), (3, "http://c/", long, 5), (4, "http://d/", "<p>a<svg>b", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record long")
    got, two = warc.page_derivatives(pages).collect(), warc.derivatives(warc.responses(pages)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, two)) and len(got) == 2 * len(rows)
    text = {(r["page_id"], r["target_uri"]): r["body"] for r in got if r["record_type"] == "conversion"}
    assert text == {(1, "http://a/"): "x", (2, ""): "", (None, "http://b/"): "", (3, "http://c/"): ("many words " * 60_000).strip(), (4, "http://d/"): "ab"}
    assert len({r["record_id"] for r in got}) == 10 and all(r["source_intact"] and r["refers_to"] for r in got)
    odd = spark.createDataFrame([(1, None), (2, b""), (3, b"WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 0\r\n\r\n\r\n\r\n"), (4, b"junk")], "page_id long, record binary")
    assert warc.derivatives(odd).count() == 0 and warc.page_derivatives(pages.where("1 = 0")).count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_stages_on_odd_rows(spark, tmp_path, stage):
    labels = spark.createDataFrame([(7, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    d = frame(spark)
    rows = stage(spark, d, str(tmp_path))
    assert rows.columns == d.columns and stage(spark, d.where("1 = 0"), str(tmp_path)).count() == 0
    got, every = collections.Counter((r["doc_id"], r["text"], r["source"]) for r in rows.collect()), collections.Counter(ROWS)
    name = stage.__name__
    if name == "reject_low_quality":
        assert got == collections.Counter({k: v for k, v in every.items() if k[0] in (4, 5, 7)})
    elif name == "drop_repeated_lines":
        assert got == every
    elif name == "keep_one_of_near_duplicates":
        gone = {5} if _alike(PROSE, PROSE.replace("tale", "story"), 5, 80) else set()
        assert got == collections.Counter(k for k in set(ROWS) if k[0] not in gone)
    else:
        assert set(got) <= set(every) and all(v <= 2 * every[k] for k, v in got.items()) and all((k[1] or "").split() for k in got)


def test_rows_that_share_an_id_are_not_multiplied(spark):
    rows = [(None, f"word{i} " * 5, "a") for i in range(20)] + [(1, "x y z", "b"), (1, "x y w", "b"), (2, "q r s", "b")]
    got = collections.Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.mix_sources(spark, frame(spark, rows), "").collect())
    assert max(got.values()) <= 2 and 20 <= sum(v for k, v in got.items() if k[0] is None) <= 40

"""Operators without an SQL form against plain versions, step by step."""

import collections
import hashlib
import html.parser
import math
import random
import urllib.parse

import numpy as np
import pytest

from skyscreen.llm import exact_dedup, language_id, minhash, ppm, quality_model, quality_rules, warc

DOCS = "doc_id long, text string, lang string"


def rand_text(rng, n, letters="abcdefg"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(n))


# --- quality rules


def plain_counts(text):
    words = text.split()
    windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.split()]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_counts_of_texts():
    rng = random.Random(1)
    texts = ["", " ", "a", "a a a a", "a b a b a b", "é ü 日本 x#y $|< >", "x\n\nx\n x\nx", "one\x0btwo\x0cthree\x1cfour\x85five"]
    texts += ["\n".join(rand_text(rng, rng.randint(0, 6), "ab#") for _ in range(rng.randint(1, 30))) for _ in range(300)]
    for t in texts:
        spaced = t.replace("\x1c", "·").replace("\x85", "·")  # str.split cuts at more than the six characters
        assert quality_rules.statistics(t)[:5] == plain_counts(spaced), t


def plain_list(rows, bad, max_rules=8, max_conditions=4):
    """Sequential covering as it is defined, one candidate at a time. ``rows``: dicts of statistics."""
    names, alive, rules = list(rows[0]), set(range(len(rows))), []
    holds = lambda i, c: rows[i][c[0]] <= c[2] if c[1] == "<=" else rows[i][c[0]] > c[2]
    covered = lambda some, rule: {i for i in some if all(holds(i, c) for c in rule)}
    while len(rules) < max_rules:
        grow, check = {i for i in alive if i % 3 != 2}, {i for i in alive if i % 3 == 2}
        if sum(bad[i] for i in grow) < 3:
            break
        rule = []
        while len(rule) < max_conditions:
            inside = covered(grow, rule)
            p = sum(bad[i] for i in inside)
            if not p or p == len(inside):
                break
            best, chosen = 0.0, None
            for name in names:
                values, found = sorted({rows[i][name] for i in inside}), []
                for a, b in zip(values, values[1:], strict=False):
                    for op in ("<=", ">"):
                        hit = covered(inside, [(name, op, (a + b) / 2)])
                        q = sum(bad[i] for i in hit)
                        gain = q * (math.log2(max(q, 1e-9) / len(hit)) - math.log2(p / len(inside)))
                        found.append((op != "<=", gain, (name, op, (a + b) / 2)))
                for late in (False, True):
                    some = [f for f in found if f[0] == late]
                    if some and max(f[1] for f in some) > best + 1e-9:
                        best, chosen = max(((f[1], f[2]) for f in some), key=lambda x: x[0])
            if chosen is None:
                break
            rule.append(chosen)

        def worth(r, check=check):
            hit = covered(check, r)
            return (2 * sum(bad[i] for i in hit) - len(hit)) / len(hit) if hit else 0.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule.pop()
        hit = covered(alive, rule)
        if not rule or sum(bad[i] for i in hit) < 4 or sum(bad[i] for i in hit) < 0.97 * len(hit):
            break
        rules.append(rule)
        alive -= hit
    return rules


def test_decision_list_is_that_of_sequential_covering():
    import pandas as pd

    rng = random.Random(2)
    for _ in range(6):
        rows = [{"a": rng.randint(0, 8) / 8, "b": rng.randint(0, 5) / 5, "c": rng.random()} for _ in range(120)]
        bad = [(r["a"] > 0.6 and r["b"] < 0.5) or r["c"] > 0.9 for r in rows]
        got = quality_rules.learn(pd.DataFrame(rows), np.array(bad))
        want = plain_list(rows, bad)
        assert [[(n, o, pytest.approx(v)) for n, o, v in r] for r in want] == got
        assert got


def test_list_as_a_spark_conditional(spark):
    d = spark.createDataFrame([(i, i / 10, (i * 7 % 10) / 10) for i in range(10)], "i int, a double, b double")
    rules = [[("a", ">", 0.45), ("b", "<=", 0.35)], [("b", ">", 0.75)]]
    got = {r["i"]: r["k"] for r in d.withColumn("k", quality_rules.expression(rules)).collect()}
    assert got == {i: not ((i / 10 > 0.45 and (i * 7 % 10) / 10 <= 0.35) or (i * 7 % 10) / 10 > 0.75) for i in range(10)}


# --- quality classifier


def test_ftrl_step_by_step():
    rng = random.Random(3)
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.1
    model, z, n, bz, bn = quality_model.Ftrl(64), [0.0] * 64, [0.0] * 64, 0.0, 0.0
    weight = lambda i: 0.0 if abs(z[i]) <= l1 else (math.copysign(l1, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)
    for _ in range(200):
        at = sorted(rng.sample(range(64), 6))
        x, label = [rng.random() for _ in at], float(rng.random() < 0.4)
        w, b = [weight(i) for i in at], -bz / ((beta + math.sqrt(bn)) / alpha)
        p = 1 / (1 + math.exp(-(sum(a * c for a, c in zip(w, x, strict=True)) + b)))
        for i, a, c in zip(at, w, x, strict=True):
            g = (p - label) * c
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * a
            n[i] += g * g
        g = p - label
        bz, bn = bz + g - (math.sqrt(bn + g * g) - math.sqrt(bn)) / alpha * b, bn + g * g
        model.learn(np.array(at), np.array(x), label)
    assert model.weights() == pytest.approx([*(weight(i) for i in range(64)), -bz / ((beta + math.sqrt(bn)) / alpha)])


def test_features_by_hand():
    rng, features = random.Random(4), quality_model.Features(1 << 12, cache=50)
    texts = ["", "one", "One two", *(rand_text(rng, rng.randint(1, 40)) for _ in range(40))]
    row, bucket, value = features.of(texts)
    import re
    import zlib

    def grams(text):
        words = text.encode().split()
        shape = lambda w: re.sub(rb"(.)\1+", rb"\1", bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in w))
        a, b = [zlib.crc32(w.lower()) for w in words], [zlib.crc32(shape(w)) ^ 0x5BD1E995 for w in words]
        raw = [*a, *b]
        for h in (a, b):
            raw += [x * 3 + y * 7 + 1 for x, y in zip(h, h[1:], strict=False)]
        raw += [x * 5 + y * 11 + z * 13 for x, y, z in zip(b, b[1:], b[2:], strict=False)]
        return collections.Counter((x * 0x9E3779B97F4A7C15 % (1 << 64) >> 40) % (1 << 12) for x in raw)

    for k, t in enumerate(texts):
        want = {i: math.sqrt(c) for i, c in grams(t).items()}
        size = math.sqrt(sum(v * v for v in want.values()))
        got = dict(zip(bucket[row == k].tolist(), value[row == k].tolist(), strict=True))
        assert got == pytest.approx({i: v / size for i, v in want.items()})


# --- language identification


def plain_mixture(like, langs, rounds):
    """Shares and log-likelihood by expectation-maximisation over the languages given, word by word."""
    share = {g: 1 / len(langs) for g in langs}
    for _ in range(rounds):
        total = dict.fromkeys(langs, 0.0)
        for word in like:
            s = sum(word[g] * share[g] for g in langs)
            for g in langs:
                total[g] += word[g] * share[g] / s
        share = {g: v / len(like) for g, v in total.items()}
    return share, sum(math.log(sum(word[g] * share[g] for g in langs)) for word in like)


def plain_choice(like, n, penalty=3.0, rounds=6):
    share, _ = plain_mixture(like, range(n), rounds)
    order = sorted(range(n), key=lambda g: -share[g])
    best, chosen = -math.inf, None
    for size in range(1, n + 1):
        got, total = plain_mixture(like, order[:size], rounds if size > 1 else 0)
        value = total - penalty * (size - 1) * math.log(max(len(like), 2))
        if value <= best:
            break
        best, chosen = value, got
    return chosen


def test_mixtures_of_up_to_six_languages():
    rng, words = random.Random(5), {}
    langs = ["aa", "bb", "cc", "dd", "ee", "ff"]
    for k, g in enumerate(langs):
        words[g] = ["".join(rng.choices("bcdfghjklm"[k : k + 4] + "aeiou"[k % 5], k=rng.randint(3, 7))) for _ in range(60)]
    counts = np.full((language_id.BUCKETS, len(langs)), 0.5)
    grams = language_id.WordGrams()
    for k, g in enumerate(langs):
        _, bucket = grams.of([w.encode() for w in words[g]])
        counts[:, k] += np.bincount(bucket, minlength=language_id.BUCKETS)
    likelihoods = language_id.WordLikelihoods(np.log(counts / counts.sum(0)).astype(np.float32), cache=100)
    texts, made = [], []
    for _ in range(40):
        some = rng.sample(langs, rng.randint(1, 6))
        text = " ".join(w for g in some for w in rng.choices(words[g], k=rng.randint(25, 60)))
        texts.append(text)
        made.append(set(some))
    main, score, sets = language_id.infer(texts, langs, likelihoods)
    for k, t in enumerate(texts):
        one = language_id.WordLikelihoods(likelihoods.table)
        codes = one.codes([w.encode() for w in t.split()])
        rows = one.like[codes]
        want = plain_choice([dict(enumerate(r.tolist())) for r in rows], len(langs))
        assert set(sets[k].split(",")) == {langs[g] for g, v in want.items() if v > 0.01}
        assert score[k] == pytest.approx(max(want.values()), abs=1e-9) and main[k] == langs[max(want, key=lambda g: want[g])]
    found = sum(set(s.split(",")) == m for s, m in zip(sets, made, strict=True))
    assert found >= 36 and max(len(s.split(",")) for s in sets) >= 5


def test_rare_languages_are_learned(spark):
    rng = random.Random(6)
    rows = [(i, rand_text(rng, 12, "abcde") if i % 100 else rand_text(rng, 12, "vwxyz"), "common" if i % 100 else "rare") for i in range(4000)]
    langs, table = language_id.learn(spark.createDataFrame(rows, DOCS), max_train=200)
    assert langs == ["common", "rare"]
    one = language_id.WordLikelihoods(table)
    main, *_ = language_id.infer([rand_text(rng, 12, "vwxyz"), rand_text(rng, 12, "abcde")], langs, one)
    assert main == ["rare", "common"]


# --- WARC


def test_pages_against_a_plain_reader(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 12)):
            t = rand_text(rng, rng.randint(1, 8))
            parts.append(rng.choice((f"<p>{t}</p>", f"<div>{t} <b>bold</b></div>", f"<script>var x = '{t}';</script>", f"<a href='/{i}'>{t}</a>", f"<style>.{t[:3]}{{}}</style>", f"<h1>{t} &amp; more</h1>", f"<!-- {t} -->")))
        rows.append((i, f"http://h{i % 3}.org/d/p{i}", f"<html><head><title>T {i}</title></head><body>{''.join(parts)}</body></html>"))

    class Plain(html.parser.HTMLParser):
        def __init__(self):
            super().__init__()
            self.words, self.skip, self.links = [], 0, []

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style", "head")
            self.links += [v for k, v in attrs if tag == "a" and k == "href"]

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style", "head")

        def handle_data(self, data):
            if not self.skip:
                self.words += data.split()

    got = {(r["page_id"], r["record_type"]): r for r in warc.page_derivatives(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == 2 * len(rows)
    for i, url, page in rows:
        plain = Plain()
        plain.feed(page)
        text, meta = got[i, "conversion"], got[i, "metadata"]
        assert "".join(text["body"].split()) == "".join(plain.words) and text["content_length"] == len(text["body"].encode())
        import base64

        sha = "sha1:" + base64.b32encode(hashlib.sha1(page.encode()).digest()).decode()
        assert text["source_digest"] == meta["source_digest"] == sha and text["refers_to"] == meta["refers_to"] and text["target_uri"] == url
        assert meta["n_links"] == len(dict.fromkeys(plain.links)) and f"title: T {i}\r\n" in meta["body"]
        for r in (text, meta):
            (headers, block), = warc.parse_records(bytes(r["record"]))
            h = dict(headers)
            assert block.decode() == r["body"] and h["WARC-Refers-To"] == r["refers_to"] and h["WARC-Record-ID"] == r["record_id"] and h["WARC-Block-Digest"] == warc.digest(block)


MARKUP = ["<", "</", ">", "/>", "<!--", "-->", "<!", "<!doctype html>", "<![CDATA[", "]]>", "<![foo[", "<?x", "&amp;", "&lt", "&#65", "&", "href", "=", '"', "'", " ", "\n", "\xa0", "\x0b", "\0", "<p>", "</p >", "<br/>", "<a href='/x'>", "<a href=/y/>", '<A HREF="z&amp;1" href>', '<a title=" href=n" href=m>', "<a href = k>", "</a>", "<h-1>", "<SCRIPT>", "</script >", "</\u017fcript>", "<style>", "</style>", "<title>", "</title>", "<head>", "</head>", "<body>", "<svg>", "</svg>", "word", "\xfc."]
SEGMENTS = ["/", "/", "a", "b.", "..", ".", "\xfc", ":", "//h", ";x", "?y", "#z", " ", "\t", "[", "https://H.Org", "mailto:"]
BASES = ["", "http://h.org", "http://h.org/a/b?c#d", "ftp://f/g", "mailto:me@x", "a/b", "//h/p", "file:///a/b", "http://[bad/a", "HTTP://Up/", "x-y://z/w"]


def test_odd_markup_against_the_whole_parser(monkeypatch):
    class Whole(warc._Page):
        feed = html.parser.HTMLParser.feed

    def joined(url, x):
        try:
            return urllib.parse.urljoin(url, x)
        except ValueError:
            return x

    rng = random.Random(9)
    for _ in range(4000):
        page, url = "".join(rng.choices(MARKUP, k=rng.randint(1, 30))), rng.choice(BASES)
        got = warc.page_text(page, url)
        with monkeypatch.context() as m:
            m.setattr(warc, "_Page", Whole)
            assert got == warc.page_text(page, url), page
        links = ["".join(rng.choices(SEGMENTS, k=rng.randint(1, 5))).strip() for _ in range(4)]
        page = "".join(f'<a href="{x}">' for x in links)
        assert warc.page_text(page, url)[2] == list(dict.fromkeys(joined(url, x) for x in links if x)), (url, links)


def test_plain_tags_cost_one_match_each(monkeypatch):
    """The standard parser's own steps, several matches a tag, are left to odd markup."""
    steps = []
    for name in ("parse_starttag", "parse_endtag"):
        own = getattr(html.parser.HTMLParser, name)
        monkeypatch.setattr(html.parser.HTMLParser, name, lambda self, i, name=name, own=own: steps.append(name) or own(self, i))
    page = "<html lang='en'><head><meta charset=utf-8><title>T</title><script>a('</p>')</script></head><body>" + "<p class=\"x\">one <b>two</b><a href='/q'>three</a></p>" * 50 + "</body></html>"
    assert warc.page_text(page, "http://a.org/") == ("\n".join(["one twothree"] * 50), "T", ["http://a.org/q"]) and not steps
    assert warc.page_text("<p/>one<h-1>two</h-1>") == ("one" + "two", "", []) and steps


# --- near and exact copies


def test_one_bucket_of_thousands_of_distinct_members(spark):
    """Texts around the threshold that nearly all meet: links and components must be those of comparing all pairs."""
    rng = np.random.default_rng(8)
    base, n = 220, 2600
    changed = [rng.choice(base, rng.integers(2, 26), replace=False) for _ in range(n)]
    rows = []
    for i, some in enumerate(changed):
        words = [f"w{j}" for j in range(base)]
        for j in some:
            words[j] = f"x{i}" if i % 2 else f"y{int(j) % 7}"
        rows.append((i, " ".join(words), "en"))
    sets = []
    for _, t, _ in rows:
        w = t.split()
        sets.append({tuple(w[k : k + 3]) for k in range(len(w) - 2)})
    code = {s: k for k, s in enumerate(sorted(set().union(*sets)))}
    dense = np.zeros((n, len(code)), np.float32)
    for i, s in enumerate(sets):
        dense[i, [code[x] for x in s]] = 1
    both, size = (dense @ dense.T).astype(np.int64), np.array([len(s) for s in sets])
    link = 100 * both >= 85 * (size[:, None] + size - both)
    label = np.arange(n)
    while True:
        after = np.where(link, label[None, :], n).min(1)
        if (after == label).all():
            break
        label = after
    want = dict(enumerate(label.tolist()))
    assert len(set(want.values())) > 100 and max(collections.Counter(want.values()).values()) > 300
    small = minhash.BLOCK_SIGNATURES, minhash.BLOCK_MEMBERS
    for blocks in (small, (300, 200)):  # one block, and many that meet
        minhash.BLOCK_SIGNATURES, minhash.BLOCK_MEMBERS = blocks
        try:
            got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, DOCS), 3, 85).collect()}
        finally:
            minhash.BLOCK_SIGNATURES, minhash.BLOCK_MEMBERS = small
        assert got == want


def test_large_sets_are_compared_exactly():
    import pyarrow as pa

    settle = minhash._settle(80)
    n = 900_000  # 100 * n is beyond what 32-bit floats hold exactly

    def table(extra):
        a, b = np.arange(n), np.concatenate((np.arange(n), np.arange(n, n + extra)))
        return pa.table({"digest": pa.array([b"a", b"b"]), "label": pa.array([b"a", b"b"]), "block": pa.array([0, 0]), "shingles": pa.array([a, b], pa.list_(pa.int64()))})

    assert settle(table(n // 4)).num_rows == 1 and settle(table(n // 4 + 1)).num_rows == 0


def test_filters_decide_what_is_verified(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, f"text {rng.randrange(300)}", "en") for i in range(2000)]
    first, sizes = {}, collections.Counter(t for _, t, _ in rows)
    for i, t, _ in rows:
        first.setdefault(t, i)
    d = spark.createDataFrame(rows, DOCS).repartition(6)
    got = exact_dedup.exact_groups(d, max_entries=100).collect()
    text = dict((i, t) for i, t, _ in rows)
    assert all(r["keep_id"] == first[text[r["doc_id"]]] and r["group_size"] == sizes[text[r["doc_id"]]] for r in got)


def lsm_entries(rng, n, of):
    digests = [hashlib.sha256(str(rng.randrange(of)).encode()).digest() for _ in range(n)]
    numbers = np.stack([np.array([rng.randrange(50), rng.randrange(4), k, 0, 0, 0, rng.randrange(1, 5), 1]) for k in range(n)])
    return digests, numbers


def test_index_keeps_the_smallest_rows(monkeypatch):
    rng = random.Random(10)
    runs = [lsm_entries(rng, 200, 400) for _ in range(15)]
    index, want = exact_dedup.LsmIndex(max_runs=3), {}
    for digests, numbers in runs:
        index.add_run(np.array(digests, "S32"), numbers)
        for d, x in zip(digests, numbers.tolist(), strict=True):
            have = want.get(d)
            best = x if have is None or x[:3] < have[:3] else have
            want[d] = [*best[:6], (have[6] if have else 0) + x[6], (have[7] if have else 0) + 1]
    digests, numbers = index.compacted()
    raw = digests.tobytes()
    got = {raw[k * 32 : k * 32 + 32]: x for k, x in enumerate(numbers.tolist())}
    assert got == want and len(index.runs) <= 3
    # without the filters no hit between runs is found
    monkeypatch.setattr(exact_dedup.Bloom, "may_have", lambda self, d: np.zeros(len(d), bool))
    blind = exact_dedup.LsmIndex(max_runs=100)
    for digests, numbers in runs:
        blind.add_run(np.array(digests, "S32"), numbers)
    assert sum(len(r[0]) for r in blind.runs) > len(want)


def test_bloom_has_no_false_negatives():
    rng = random.Random(11)
    for width in (1, 8, 32):
        some = sorted({hashlib.sha256(str(rng.random()).encode()).digest()[:width] for _ in range(3000)})
        bloom = exact_dedup.Bloom(np.array(some, f"S{width}"))
        assert bloom.may_have(np.array(some, f"S{width}")).all()
    others = np.array([hashlib.sha256(str(rng.random()).encode()).digest() for _ in range(3000)], "S32")
    assert bloom.may_have(others).mean() < 0.05


# --- language-model scoring


def test_short_strings_are_counted_whole():
    rng = random.Random(12)
    for letters in ("ab ", "".join(map(chr, range(33, 120))) + "é日本"):
        streams = [ppm.stream(ppm.words_of(rand_text(rng, rng.randint(0, 30), letters))) for _ in range(40)]
        want = collections.Counter()
        for s in streams:
            padded = b"\n" * (ppm.SHALLOW - 1) + s
            for k in range(ppm.SHALLOW - 1, len(padded)):
                want[int.from_bytes(padded[k - ppm.SHALLOW + 1 : k + 1], "big")] += 1
        code, n = ppm.count_short(streams)
        assert dict(zip(code.tolist(), n.tolist(), strict=True)) == want


def test_hot_contexts_have_shards_of_their_own():
    codes = np.array([int.from_bytes(bytes([97, b, c, 101, 32, 116]), "big") for b in range(97, 120) for c in range(97, 120)])
    assert len(np.unique(ppm._shard_of(codes, 1 << 20))) == 23  # by three bytes: 23 of them end so

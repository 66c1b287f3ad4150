"""Language identification by multilingual mixture inference.

A language is a distribution over hashed byte n-grams (one to four bytes, word ends included) and whole words. A document
is a mixture: expectation-maximisation over the likelihoods of its words estimates the share of each language. Of the
language sets nested by share, from one language to all of them, the last one stays up to which each further language raised
the penalised likelihood.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, give_back, spread, stored, text_chunks

BUCKETS = 1 << 16
#: Labelled rows, at most about so many, that the distributions are learned from, and of one language at least, if it has them.
MAX_TRAIN, LEAST_TRAIN = 24_000, 1_000
_LETTER = re.compile(r"[^\W\d_]").search


class WordGrams:
    """Buckets of the n-grams of distinct words."""

    def __init__(self, buckets: int = BUCKETS):
        self.mask = np.uint64(buckets - 1)

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(word, bucket) for every n-gram of every word; a word is read between spaces."""
        raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint64)
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)  # byte i (and the space before the word) belongs to owner[i]
        mix = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(30)) & self.mask
        at, parts = np.arange(len(owner)), []
        padded = np.concatenate((raw, np.full(3, 32, np.uint64)))
        ends = np.cumsum(sizes)  # place of the space after each word
        for n in range(1, 5):
            code = np.full(len(owner), n, np.uint64)
            for k in range(n):
                code = code * np.uint64(257) + padded[at + k]
            inside = at + n - 1 <= ends[owner]
            if n == 1:
                inside &= padded[at] != 32
            parts.append((owner[inside], mix(code[inside])))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.int64)


class WordLikelihoods:
    """Likelihoods of words in each language, scaled so that the largest of a word is 1; known words are kept, up to a bound."""

    def __init__(self, table: np.ndarray, cache: int = 200_000):
        self.table, self.grams, self.cache = table, WordGrams(len(table)), cache
        self._reset()

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.like = np.zeros((0, self.table.shape[1]), np.float64)

    def codes(self, words: list[bytes]) -> np.ndarray:
        """The row of ``like`` of every word."""
        codes = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(codes < 0).tolist()
        if new:
            fresh = list(dict.fromkeys([words[k] for k in new]))
            if len(self.known) + len(fresh) > self.cache and self.known:
                self._reset()
                return self.codes(words)
            base = len(self.known)
            self.known.update(zip(fresh, range(base, base + len(fresh)), strict=True))
            for at in range(0, len(fresh), 20_000):
                part = fresh[at : at + 20_000]
                word, bucket = self.grams.of(part)
                order = np.argsort(word, kind="stable")
                starts = np.searchsorted(word[order], np.arange(len(part)))
                logs = np.add.reduceat(self.table[bucket[order]], starts, axis=0) / 2.5  # n-grams overlap: each byte counts in several
                self.like = np.concatenate((self.like, np.exp(np.maximum(logs - logs.max(1, keepdims=True), -30)).astype(np.float64)))
            codes[new] = np.fromiter((self.known[words[k]] for k in new), np.int64, len(new))
        return codes


def _split(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Every word of the texts, in lower case, and the text that it stands in."""
    split = [t.lower().encode("utf-8", "surrogatepass").split() for t in texts]
    return [w for ws in split for w in ws], np.repeat(np.arange(len(texts)), [len(ws) for ws in split])


def learn(docs: DataFrame, max_train: int = MAX_TRAIN, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """The languages and the log-probability of each n-gram in each, from rows with a language whose crc32(doc_id) mod 4 is not 2.

    Rows are sampled by their hashed id and text down to about ``max_train``, each language in proportion, but not below
    ``LEAST_TRAIN`` rows of it. Tasks add up their counts by language before they send them: a task sends one vector for each
    language.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null").where(crc_mod("doc_id", 4) != 2)
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if (n := sum(sizes.values())) > max_train:
        upto = [(lang, max(max_train * size / n, LEAST_TRAIN) / size) for lang, size in sizes.items()]
        quota = F.create_map(*[F.lit(x) for lang, part in upto for x in (lang, int((1 << 20) * min(1.0, part)))])
        rows = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < quota[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums = WordGrams(buckets), {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for start, texts in text_chunks(batch):
                flat, doc = _split(texts)
                if not flat:
                    continue
                index = {w: i for i, w in enumerate(dict.fromkeys(flat))}
                words, code = list(index), np.fromiter(map(index.__getitem__, flat), np.int64, len(flat))
                word, bucket = grams.of(words)
                for lang in set(langs[start : start + len(texts)]):
                    own = np.array([x == lang for x in langs[start : start + len(texts)]])
                    times = np.bincount(code[own[doc]], minlength=len(words))
                    total = sums.setdefault(lang, np.zeros(buckets))
                    total += np.bincount(bucket, times[word], buckets)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([total.tobytes()], pa.binary())], names=["lang", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(raw.as_py())
                sums[lang] = sums[lang] + part if lang in sums else part.copy()
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([total.tobytes()], pa.binary())], names=["lang", "counts"])

    schema = "lang string, counts binary"
    parts = stored(rows.select("text", "lang").mapInArrow(count, schema), "language-counts")
    got = sorted((r["lang"], np.frombuffer(bytes(r["counts"]))) for r in parts.repartition(8, "lang").mapInArrow(add, schema).collect())
    if not got:
        return [], np.zeros((buckets, 0), np.float32)
    counts = np.stack([c for _, c in got], 1) + 0.5
    return [lang for lang, _ in got], np.log(counts / counts.sum(0)).astype(np.float32)


def mixtures(like: np.ndarray, times: np.ndarray, doc: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(shares, log-likelihood) of every document by expectation-maximisation; ``allowed`` marks each document's languages.

    ``like`` has a row for each different word of a document, ``times`` says how often it stands there; rows of a document
    stand together.
    """
    share = allowed / np.maximum(allowed.sum(1, keepdims=True), 1)
    total = np.zeros(len(allowed))
    if not len(doc):
        return share, total
    firsts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    here, n = doc[firsts], np.add.reduceat(times, firsts)[:, None]
    for step in range(rounds + 1):
        joint = like * share[doc]
        sums = np.maximum(joint.sum(1), 1e-300)
        if step == rounds:
            total[here] = np.add.reduceat(times * np.log(sums), firsts)
        else:
            share[here] = np.add.reduceat(joint * (times / sums)[:, None], firsts, axis=0) / n
    return share, total


def infer(texts: list[str], langs: list[str], likelihoods: WordLikelihoods, penalty: float = 3.0, rounds: int = 6) -> tuple[list[str], np.ndarray, list[str]]:
    """(main language, its share, the chosen set) for each text; texts without a letter are ``und`` with score 0.

    A language that is one more costs ``penalty`` times the log of the number of words. Of equal shares the language that
    comes first by code point is the main one.
    """
    main, score, sets = ["und"] * len(texts), np.zeros(len(texts)), [""] * len(texts)
    words, doc = _split(texts)
    if not langs or not words:
        return main, score, sets
    code = likelihoods.codes(words)
    pair, times = np.unique(doc * len(likelihoods.known) + code, return_counts=True)  # equal words of a document fold into one row
    doc, like = pair // len(likelihoods.known), likelihoods.like[pair % len(likelihoods.known)]
    words_in = np.bincount(doc, times, len(texts))
    times = times.astype(np.float64)
    shares, _ = mixtures(like, times, doc, np.ones((len(texts), len(langs))), rounds)
    rank = np.argsort(-shares, axis=1, kind="stable")
    best, best_share = np.full(len(texts), -np.inf), shares
    rising = np.arange(len(texts))  # documents whose value has risen with every language so far
    for size in range(1, len(langs) + 1):
        own = np.isin(doc, rising)
        at = np.searchsorted(rising, doc[own])
        allowed = np.zeros((len(rising), len(langs)))
        np.put_along_axis(allowed, rank[rising, :size], 1.0, axis=1)
        got, total = mixtures(like[own], times[own], at, allowed, rounds if size > 1 else 0)
        value = total - penalty * (size - 1) * np.log(np.maximum(words_in[rising], 2))
        better = value > best[rising]
        rising = rising[better]
        best[rising], best_share[rising] = value[better], got[better]
        if not len(rising):
            break
    top = best_share.argmax(1)
    for k, text in enumerate(texts):
        if words_in[k] and _LETTER(text):
            main[k], score[k] = langs[top[k]], min(1.0, float(best_share[k, top[k]]))
            sets[k] = ",".join(langs[j] for j in np.argsort(-best_share[k], kind="stable") if best_share[k, j] > 0.01)
    return main, score, sets


def identify(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, lang_set`` of every row of ``docs``.

    ``score`` is the share of the main language in the mixture, ``lang_set`` the chosen languages by share. Null and empty
    texts and texts without a letter are ``und`` with score 0, and so is all where no row has a language; very long texts are
    read whole; null ids stay null; of equal shares the first language by code point is the main one; repeated rows get equal
    results, a row each; an empty table gives an empty result; other columns, of whatever name, are ignored. What is broadcast
    is one vector of ``BUCKETS`` floats for each language.
    """
    langs, table = learn(docs, max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likelihoods = WordLikelihoods(table)
        for batch in batches:
            for start, texts in text_chunks(batch):
                main, score, sets = infer(texts, langs, likelihoods)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), pa.array(main), pa.array(score), pa.array(sets)], names=["doc_id", "lang_pred", "score", "lang_set"])
        give_back()

    narrow = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    out = narrow.mapInArrow(run, "doc_id long, lang_pred string, score double, lang_set string")
    return out.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "lang_set")

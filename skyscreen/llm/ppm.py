"""Language-model scoring by prediction by partial matching.

The model is a trie of byte contexts up to five bytes deep. At each context a byte has probability (2 count - 1) / (2 total),
and the escape to the next shorter context distinct / (2 total); bytes that the longer context has seen are excluded there
(escape method D). What escapes from the empty context is shared evenly by the bytes that no training text has.

:class:`Trie` does this for one text after another, adaptively or as trained. :func:`score_documents` does it for a corpus:
the trie's leaves are the counts of all six-byte strings, from which contexts of three to five bytes follow by summing. Blocks
of documents send their distinct strings, with counts from training documents, to shards by the last three context bytes; a
shard holds all contexts that end so, adds the counts up, scores every different string once and sends back what each block
asked for. Shorter contexts are summed on their own, as strings of three bytes, of which there are 2^24 at most; they are sent
to all shards. Words take the same way as strings for the unigram baseline.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, stored
from .hashing import IntTable

ORDER = 5
#: Context bytes by which strings are dealt; shorter contexts are summed over the whole corpus.
SHALLOW = 3
_END = b"\n"
_PAD = _END * ORDER
#: Bytes of text that a block aims at, and positions that are worked on at once.
BLOCK_BYTES, _STEP = 8 << 20, 1 << 19


def words_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def stream(words: list[bytes]) -> bytes:
    """What the model predicts: the words with one space between two, then the end."""
    return b" ".join(words) + _END


class Trie:
    """PPM with contexts in a dictionary: the form to read, and the one that learns as it scores."""

    def __init__(self, order: int = ORDER):
        self.order, self.nodes = order, {}

    def learn(self, data: bytes) -> None:
        data = _END * self.order + data
        for i in range(self.order, len(data)):
            for k in range(self.order + 1):
                self.nodes.setdefault(data[i - k : i], Counter())[data[i]] += 1

    def log10(self, context: bytes, symbol: int) -> float:
        out, seen = 0.0, Counter()
        for k in range(self.order, -1, -1):
            counts = self.nodes.get(context[len(context) - k :])
            if not counts:
                continue
            rest = {s: c for s, c in counts.items() if s not in seen}
            if not rest:
                continue
            whole = 2 * sum(rest.values())
            if symbol in rest:
                return out + math.log10((2 * rest[symbol] - 1) / whole)
            out += math.log10(len(rest) / whole)
            seen = counts
        return out - math.log10(256 - len(seen))

    def score(self, data: bytes, adaptive: bool = False) -> float:
        """log10 of the probability of ``data``; ``adaptive``: each byte is learned after it is scored."""
        padded, total = _END * self.order + data, 0.0
        for i in range(self.order, len(padded)):
            total += self.log10(padded[i - self.order : i], padded[i])
            if adaptive:
                for k in range(self.order + 1):
                    self.nodes.setdefault(padded[i - k : i], Counter())[padded[i]] += 1
        return total


def strings_of(streams: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(stream, six-byte string) of every byte of the streams, about ``_STEP`` of them at once; a string ends at its byte."""
    group: list[bytes] = []
    first = held = 0
    for k, s in enumerate(streams):
        group.append(s)
        held += len(s)
        if held >= _STEP or k + 1 == len(streams):
            raw = np.frombuffer(b"".join(_PAD + g for g in group), np.uint8).astype(np.int64)
            code = np.zeros(len(raw) - ORDER, np.int64)
            for j in range(ORDER + 1):
                code = code << 8 | raw[j : len(raw) - ORDER + j]
            sizes = np.array([len(g) + ORDER for g in group])
            real = np.ones(len(raw), bool)
            real[(np.cumsum(sizes) - sizes)[:, None] + np.arange(ORDER)] = False
            yield np.repeat(np.arange(first, k + 1), sizes - ORDER), code[real[ORDER:]]
            group, first, held = [], k + 1, 0


def add_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sums of their counts."""
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


class Level:
    """Contexts of one length and their symbols: sums for each context, and counts of strings (context, symbol)."""

    def __init__(self, strings: np.ndarray, counts: np.ndarray, shorter: Level | None = None, bytes_: int = 0):
        self.strings, self.counts = strings, counts  # strings are in order, so a context's symbols stand together
        context = strings >> 8
        first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(context) else np.zeros(0, np.int64)
        self.contexts, self.distinct = context[first], np.diff(first, append=len(context))
        add = lambda x: np.add.reduceat(x, first) if len(first) else x
        self.total = add(counts)
        # what a context's symbols count in the next shorter context: they are excluded there
        self.below = add(shorter.count(strings & ((1 << 8 * bytes_) - 1))) if shorter else self.total

    def count(self, strings: np.ndarray) -> np.ndarray:
        at, hit = _find(self.strings, strings)
        return np.where(hit, self.counts[at], 0) if len(self.counts) else np.zeros(len(strings), np.int64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of each wanted key."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def shallow_levels(triples: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels 0 to ``SHALLOW - 1`` from strings of ``SHALLOW`` bytes over the whole corpus."""
    sums = [(triples, counts)]
    for k in range(SHALLOW - 1, 0, -1):
        sums.append(add_up([sums[-1][0] & ((1 << 8 * k) - 1)], [sums[-1][1]]))
    out: list[Level] = []
    for k, (code, n) in enumerate(reversed(sums)):
        out.append(Level(code, n, out[-1] if out else None, k))
    return out


def levels_of(strings: np.ndarray, counts: np.ndarray, shallow: list[Level]) -> list[Level]:
    """Levels 0 to ``ORDER`` from six-byte strings, those below ``SHALLOW`` from sums over the whole corpus."""
    some, sums = counts > 0, []
    code, n = strings[some], counts[some]
    for k in range(ORDER, SHALLOW - 1, -1):
        sums.append((code, n))
        code, n = add_up([code & ((1 << 8 * k) - 1)], [n])
    out = list(shallow)
    for k, (code, n) in enumerate(reversed(sums), SHALLOW):
        out.append(Level(code, n, out[-1], k))
    return out


def log_probabilities(wanted: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 of the probability of each string's last byte after the others."""
    out, open_ = np.zeros(len(wanted)), np.ones(len(wanted), bool)
    seen_distinct = np.zeros(len(wanted), np.int64)  # of the next longer context that was seen
    excluded = np.zeros(len(wanted), np.int64)  # what its symbols count at this level
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        if not len(level.contexts):
            continue
        string = wanted & ((1 << 8 * (k + 1)) - 1)
        at, known = _find(level.contexts, string >> 8)
        rest, symbols = np.where(known, level.total[at], 0) - excluded, np.where(known, level.distinct[at], 0) - seen_distinct
        here = open_ & (symbols > 0)
        count = level.count(string)
        found = here & (count > 0)
        out[found] += np.log10((2 * count[found] - 1) / (2 * rest[found]))
        lost = here & ~found
        out[lost] += np.log10(symbols[lost] / (2 * rest[lost]))
        open_ &= ~found
        seen_distinct = np.where(known, level.distinct[at], seen_distinct)
        excluded = np.where(known, level.below[at], 0)
    out[open_] -= np.log10(256 - seen_distinct[open_])
    return out


def _shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each string: by the last ``SHALLOW`` context bytes."""
    context = (codes >> 8 & ((1 << 8 * SHALLOW) - 1)).astype(np.uint64)
    return ((context * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % shards


def count_short(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of ``SHALLOW`` bytes in the streams, in order, and their counts; a string ends at a stream's byte."""
    pad = _PAD[: SHALLOW - 1]
    raw = np.frombuffer(b"".join(pad + s for s in streams), np.uint8)
    used = np.flatnonzero(np.bincount(raw, minlength=256))
    m, small = len(used), np.zeros(256, np.int64)
    small[used] = np.arange(m)  # bytes that occur, numbered: the table of their strings is small
    raw, ends = small[raw], np.cumsum([len(s) + len(pad) for s in streams])
    real = np.ones(len(raw), bool)
    real[(np.concatenate(([0], ends[:-1]))[:, None] + np.arange(len(pad))).ravel()] = False
    code = np.zeros(len(raw) - len(pad), np.int64)
    for j in range(SHALLOW):
        code = code * m + raw[j : len(raw) - len(pad) + j]
    code = code[real[len(pad) :]]
    if m**SHALLOW <= 8 * _STEP:
        counts = np.bincount(code, minlength=m**SHALLOW)
        code = np.flatnonzero(counts)
        counts = counts[code]
    else:
        code, counts = np.unique(code, return_counts=True)
    out = np.zeros(len(code), np.int64)
    for j in range(SHALLOW):
        out |= used[code // m**j % m] << 8 * j
    return out, counts


def _parts(column: pa.ChunkedArray) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of each text) of consecutive rows with about ``_STEP`` bytes of text."""
    part: list[list[bytes]] = []
    start = held = 0
    for i, value in enumerate(column):
        text = value.as_py()
        part.append(words_of(text))
        held += len(text or "")
        if held >= _STEP:
            yield start, part
            part, start, held = [], i + 1, 0
    if part:
        yield start, part


_ASK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("is_word", pa.bool_()), ("keys", pa.binary()), ("counts", pa.binary())])
_TELL = pa.schema([("block", pa.int32()), ("is_word", pa.bool_()), ("keys", pa.binary()), ("found", pa.binary()), ("n", pa.int64()), ("v", pa.int64())])
_SHALLOW: dict = {}
_DOC = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
_ddl = lambda schema: ", ".join(f"{f.name} {({pa.int32(): 'int', pa.int64(): 'long', pa.bool_(): 'boolean', pa.binary(): 'binary', pa.float64(): 'double'})[f.type]}" for f in schema)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _deltas(codes: np.ndarray) -> bytes:
    return np.diff(codes, prepend=0).tobytes()


def _codes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.int64))


def score_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Learns from rows whose crc32(doc_id) mod 7 is not 2. Tokens are lower-case words and one end for each text; ``score`` is
    the model's log10 probability of the words with one space between two, and of the end. Null texts are empty: their
    score is that of an end. Very long texts are read whole, by one task each. Null ids stay null and are one id for the
    remainder; rows are dealt by id and text. Without training rows the base is that of no counts and the model even over 256
    bytes. An empty table gives an empty result; repeated rows are learned one by one and score alike; other columns, of
    whatever name, are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), (crc_mod(id_col, 7) == 2).alias("held_out"))

    def short_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, size = [], [], 0
        for batch in batches:
            held = batch.column(1).to_pylist()
            for start, words in _parts(batch.column(0)):
                part = [stream(w) for w in words]
                size += sum(map(len, part))
                learned = [s for s, h in zip(part, held[start:], strict=False) if not h]
                if learned:
                    code, n = count_short(learned)
                    codes.append(code)
                    counts.append(n)
                if sum(map(len, codes)) > 1 << 20:
                    codes, counts = ([x] for x in add_up(codes, counts))
        code, n = add_up(codes, counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(code, -1), pa.int32()), pa.array(np.append(n, size), pa.int64())], names=["code", "n"])

    # 2^24 codes at most, however large the corpus
    got = source.select("text", "held_out").mapInArrow(short_counts, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toArrow()
    short_code, short_n = got.column("code").to_numpy().astype(np.int64), got.column("n").to_numpy().astype(np.int64)
    size, short_code, short_n = int(short_n[short_code == -1].sum()), short_code[short_code >= 0], short_n[short_code >= 0]
    train_docs = int(short_n[short_code & 0xFF == _END[0]].sum())  # one end for each training text
    key = uuid.uuid4().hex
    block_size = min(block_bytes, max(1 << 20, size // 12))
    n_blocks, shards = max(1, math.ceil(size / block_size)), max(64, math.ceil(size / block_size))
    dealt = source.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int"))

    def ask(block: pa.Table) -> pa.Table:
        number, held = block.column("block")[0].as_py(), np.array(block.column("held_out").to_pylist())
        codes, counts, seen = [], [], Counter()
        for start, words in _parts(block.column("text")):
            for doc, code in strings_of([stream(w) for w in words]):
                for part, known in ((code[~held[start + doc]], 1), (code[held[start + doc]], 0)):
                    distinct, n = np.unique(part, return_counts=True)
                    codes.append(distinct)
                    counts.append(n * known)
            if sum(map(len, codes)) > 1 << 20:  # what is held stays near the distinct strings of the block
                codes, counts = ([x] for x in add_up(codes, counts))
            for w, h in zip(words, held[start:].tolist(), strict=False):
                if not h:
                    seen.update(w)
                else:
                    for x in w:
                        seen.setdefault(x, 0)
        code, n = add_up(codes, counts)
        shard = _shard_of(code, shards)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        rows = [(s, number, False, _deltas(code[order[a:b]]), n[order[a:b]].astype(np.uint32).tobytes()) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
        by_shard: dict[int, list[bytes]] = {}
        for w in seen:
            by_shard.setdefault(zlib.crc32(w) % shards, []).append(w)
        for s, some in by_shard.items():
            some.sort()
            rows.append((s, number, True, b" ".join(some), np.fromiter(map(seen.__getitem__, some), np.uint32, len(some)).tobytes()))
        return _rows(rows, _ASK)

    def answer(asked: pa.Table) -> pa.Table:
        if _SHALLOW.get("key") != key:
            _SHALLOW.update(key=key, levels=shallow_levels(short_code, short_n))
        rows = list(zip(*[asked.column(c).to_pylist() for c in ("block", "is_word", "keys", "counts")], strict=True))
        strings = [(b, _codes(k), np.frombuffer(c, np.uint32).astype(np.int64)) for b, w, k, c in rows if not w]
        every, n = add_up([c for _, c, _ in strings], [n for _, _, n in strings])
        found = log_probabilities(every, levels_of(every, n, _SHALLOW["levels"])).astype(np.float32)
        out = [(b, False, _deltas(c), found[np.searchsorted(every, c)].tobytes(), 0, 0) for b, c, _ in strings]
        total: dict[bytes, int] = {}
        texts = [(b, k.split(), np.frombuffer(c, np.uint32).tolist()) for b, w, k, c in rows if w]
        for _, some, counts in texts:
            for w, n in zip(some, counts, strict=True):
                total[w] = total.get(w, 0) + n
        for b, some, _ in texts:
            out.append((b, True, b" ".join(some), np.fromiter(map(total.__getitem__, some), np.int64, len(some)).tobytes(), 0, 0))
        out.append((-1, True, None, None, sum(total.values()), sum(1 for n in total.values() if n)))
        return _rows(out, _TELL)

    asked = dealt.groupBy("block").applyInArrow(ask, _ddl(_ASK))
    told = stored(asked.groupBy("shard").applyInArrow(answer, _ddl(_TELL)), "ppm-answers")
    word_sums = told.where("block = -1").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n_train, n_distinct = int(word_sums["n"] or 0) + train_docs, int(word_sums["v"] or 0) + (train_docs > 0)
    scale = math.log10(n_train + n_distinct + 1)

    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        keys, values, known = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)], {}
        for is_word, k, found in zip(*[answers.column(c).to_pylist() for c in ("is_word", "keys", "found")], strict=True):
            if is_word:
                known.update(zip(k.split(), np.frombuffer(found, np.int64).tolist(), strict=True))
            else:
                keys.append(_codes(k))
                values.append(np.frombuffer(found, np.float32))
        table = IntTable(np.concatenate(keys), np.concatenate(values).astype(np.float64), 0.0)
        index = {w: i for i, w in enumerate(known)}
        seen = np.fromiter(known.values(), np.int64, len(known))
        gain = np.log10(seen + 1.0)
        sizes, n_known, base, total = [], [], [], []
        for _, words in _parts(block.column("text")):
            size = np.array([len(w) for w in words], np.int64)
            doc = np.repeat(np.arange(len(words)), size)
            code = np.fromiter((index[w] for ws in words for w in ws), np.int64, len(doc))
            sizes.append(size)
            n_known.append(np.bincount(doc, seen[code] > 0, len(words)).astype(np.int64))
            base.append(np.bincount(doc, gain[code], len(words)))
            total.append(sum(np.bincount(at, table.get(strings), len(words)) for at, strings in strings_of([stream(w) for w in words])))
        sizes, n_known, total = np.concatenate(sizes), np.concatenate(n_known) + (train_docs > 0), np.concatenate(total)
        base = np.concatenate(base) + math.log10(train_docs + 1) - (sizes + 1) * scale
        return pa.Table.from_arrays([block.column("doc_id"), block.column("held_out"), pa.array(sizes + 1), pa.array(n_known), pa.array(base), pa.array(total)], schema=_DOC)

    out = dealt.groupBy("block").cogroup(told.where("block >= 0").groupBy("block")).applyInArrow(score, _ddl(_DOC))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")

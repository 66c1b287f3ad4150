"""Exact dedup with a log-structured merge index.

Every task feeds the digests of its rows into a bounded :class:`Memtable`, which byte-checks its hits on the spot and flushes
sorted runs. Runs are dealt by digest to the shards of the index. A shard takes run after run into an :class:`LsmIndex`: the
filter of each run that it holds tells which digests may stand there, a binary search which do, and compaction merges the
runs, keeping the smallest identifiers. Only digests that were hit so have their bytes compared before they count as equal.
A group of copies sends one entry a run to the shuffle, however large it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, scratch, stored

_LAST = (1 << 63) - 1  # orders null ids after all others
_SPACE = b" \t\n\x0b\x0c\r"


def normalise(text: str | None) -> bytes:
    """UTF-8 of the text with each run of ``[\\x20\\x09-\\x0D]`` as one space; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return raw
    body = b" ".join(raw.split())
    if not body:
        return b" "
    return b" " * (raw[:1] in _SPACE) + body + b" " * (raw[-1:] in _SPACE)


class Bloom:
    """Bloom filter over an array of digests of one width: four bit positions each, by double hashing."""

    def __init__(self, digests: np.ndarray, bits_per_key: int = 10):
        self.size = max(64, len(digests) * bits_per_key)
        self.bits = np.zeros(self.size // 8 + 1, np.uint8)
        for at in self._places(digests):
            np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def _places(self, digests: np.ndarray) -> Iterator[np.ndarray]:
        raw = np.frombuffer(digests.tobytes(), np.uint8).reshape(len(digests), digests.dtype.itemsize)
        wide = np.zeros((len(digests), 16), np.uint8)
        wide[:, : min(16, raw.shape[1])] = raw[:, :16]
        a, b = (wide.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).T
        a, b = a ^ (a >> np.uint64(29)) ^ b, (b ^ (a >> np.uint64(31))) | np.uint64(1)
        for k in range(4):
            yield ((a + np.uint64(k) * b) >> np.uint64(7)).astype(np.int64) % self.size

    def may_have(self, digests: np.ndarray) -> np.ndarray:
        out = np.ones(len(digests), bool)
        for at in self._places(digests):
            out &= (self.bits[at >> 3] >> (at & 7) & 1).astype(bool)
        return out


class Memtable:
    """Entries by digest, up to a bound; rows of one entry have equal bytes.

    ``add`` returns (run, variant) of the entry that the row joined. A flush hands the entries to ``emit`` as one sorted run,
    and they leave memory with their texts.
    """

    def __init__(self, emit, max_entries: int = 50_000, max_bytes: int = 24 << 20):
        self.emit, self.max_entries, self.max_bytes = emit, max_entries, max_bytes
        self.run, self.held, self.table = 0, 0, {}

    def add(self, digest: bytes, row: tuple, data: bytes) -> tuple[int, int]:
        entries = self.table.setdefault(digest, [])
        for variant, entry in enumerate(entries):
            if entry[2] == data:  # a hit: its bytes are compared
                entry[0] = min(entry[0], row)
                entry[1] += 1
                return self.run, variant
        entries.append([row, 1, data])
        self.held += len(data) + 200
        place = self.run, len(entries) - 1
        if len(self.table) >= self.max_entries or self.held >= self.max_bytes:
            self.flush()
        return place

    def flush(self) -> None:
        if self.table:
            self.emit([(d, self.run, v, *e[0], e[1]) for d in sorted(self.table) for v, e in enumerate(self.table[d])])
            self.run, self.held, self.table = self.run + 1, 0, {}


class LsmIndex:
    """Sorted runs of digests with their filters; a digest stands in one run only.

    Of every digest it keeps the smallest row, with the place of that row's entry, the number of rows and the number of
    entries; a number above one is a hit. Runs beyond ``max_runs`` are compacted into one.
    """

    def __init__(self, max_runs: int = 4):
        self.max_runs, self.runs = max_runs, []  # (digests, numbers, filter); numbers: row, entry, n, entries

    @staticmethod
    def _fold(digests: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One row for each digest, in order."""
        order = np.lexsort((*numbers[:, ROW - 1 :: -1].T, digests))
        digests, numbers = digests[order], numbers[order]
        first = np.flatnonzero(np.concatenate(([True], digests[1:] != digests[:-1])))
        out = numbers[first]
        out[:, -2:] = np.add.reduceat(numbers[:, -2:], first, axis=0)
        return digests[first], out

    def add_run(self, digests: np.ndarray, numbers: np.ndarray) -> None:
        """Take in entries: a row of ``numbers`` for each, with the number of entries at 1."""
        if not len(digests):
            return
        digests, numbers = self._fold(digests, numbers)
        for have, own, bloom in self.runs:
            may = np.flatnonzero(bloom.may_have(digests))
            at = np.minimum(np.searchsorted(have, digests[may]), len(have) - 1)
            hit = have[at] == digests[may]
            at, may = at[hit], may[hit]
            both = own[at, -2:] + numbers[may, -2:]
            smaller, tied = np.zeros(len(may), bool), np.ones(len(may), bool)
            for c in range(ROW):
                smaller |= tied & (numbers[may, c] < own[at, c])
                tied &= numbers[may, c] == own[at, c]
            own[at[smaller]] = numbers[may[smaller]]
            own[at, -2:] = both
            rest = np.ones(len(digests), bool)
            rest[may] = False
            digests, numbers = digests[rest], numbers[rest]
        if len(digests):
            self.runs.append((digests, numbers, Bloom(digests)))
        if len(self.runs) > self.max_runs:
            digests, numbers = self.compacted()
            self.runs = [(digests, numbers, Bloom(digests))]

    def compacted(self) -> tuple[np.ndarray, np.ndarray]:
        digests = np.concatenate([r[0] for r in self.runs])
        order = np.argsort(digests, kind="stable")
        return digests[order], np.concatenate([r[1] for r in self.runs])[order]


#: Columns of numbers that order rows: id (null ids last), run and place; the hash of the text follows.
ROW = 3
_NUMBERS = ("row_id", "row_run", "row_seq", "row_h", "run", "variant", "n", "n_entries")
_ROWS = "doc_id long, digest binary, run long, variant long, row_id long, row_run long, row_seq long, row_h long, n long, is_entry boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), *[(c, pa.int64()) for c in ("run", "variant", "row_id", "row_run", "row_seq", "row_h", "n")], ("is_entry", pa.bool_())])
#: Entries of a shard of the index, about; they are what one task holds.
SHARD_ENTRIES = 500_000


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The compacted index of one shard from its entries, run after run."""
    index, digest_type, fields = LsmIndex(), "S1", ["digest", *_NUMBERS]
    for batch in batches:
        if not batch.num_rows:
            continue
        raw = batch.column(0).to_pylist()
        digest_type = f"S{len(raw[0])}"
        digests = np.frombuffer(b"".join(raw), digest_type)
        numbers = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in _NUMBERS[:-1]] + [np.ones(len(raw), np.int64)], 1)
        run = numbers[:, _NUMBERS.index("run")]
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(run)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            index.add_run(digests[a:b], numbers[a:b])
    if index.runs:
        digests, numbers = index.compacted()
        width = digests.dtype.itemsize
        for at in range(0, len(digests), 20_000):
            raw, part = digests[at : at + 20_000].tobytes(), numbers[at : at + 20_000]
            keys = pa.array([raw[i : i + width] for i in range(0, len(raw), width)], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, *(pa.array(c) for c in part.T)], names=fields)
    give_back()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32, max_entries: int = 50_000) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their normalised bytes are. Of a group, exactly one row has ``kept``: that with the smallest id,
    null ids last; of repeated rows with that id, the first that was read. Null texts count as empty, very long ones are read
    whole, an empty table gives an empty result, other columns, of whatever name, are ignored. ``digest_bytes`` under 32 cuts
    the digests, for tests of the byte check.
    """
    spark, text = docs.sparkSession, F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 24
        flushed: list[list[tuple]] = []
        table, seq = Memtable(flushed.append, max_entries), 0

        def entries() -> Iterator[pa.RecordBatch]:
            for rows in flushed:
                yield _batch([(None, d, base + run, v, *row, n, True) for d, run, v, *row, n in rows])
            flushed.clear()

        for batch in batches:
            out = []
            for doc_id, h, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = normalise(value.as_py())
                full = hashlib.sha256(data).digest()
                row = (_LAST if doc_id is None else doc_id, base, seq, h)
                run, variant = table.add(full[:digest_bytes], row, data)
                out.append((doc_id, full, base + run, variant, *row, None, False))
                seq += 1
            if out:
                yield _batch(out)
            yield from entries()
        table.flush()
        yield from entries()
        give_back()

    every = stored(source.mapInArrow(feed, _ROWS), "exact-runs")
    with scratch(spark) as block:
        row = F.struct("row_id", "row_run", "row_seq")
        entries = every.where("is_entry")
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries.count() // SHARD_ENTRIES))
        dealt = entries.select("digest", *_NUMBERS[:-1]).repartition(shards, "digest").sortWithinPartitions("run", "digest")
        merged = stored(dealt.mapInArrow(_index, "digest binary, " + ", ".join(f"{c} long" for c in _NUMBERS)), "exact-index")
        hits = entries.join(merged.where("n_entries > 1").select("digest"), "digest", "left_semi").select("digest", "run", "variant", row.alias("row"), "row_id", "row_h", "n")
        # Byte verification: the first row of every entry brings its text, and only equal bytes share a group.
        normal = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
        texts = source.select(F.coalesce("doc_id", F.lit(_LAST)).alias("row_id"), F.col("h").alias("row_h"), "text")
        data = hits.select("row_id", "row_h", "digest").distinct().join(texts, ["row_id", "row_h"]).withColumn("data", normal)
        data = data.where(F.substring(F.unhex(F.sha2("data", 256)), 1, digest_bytes) == F.col("digest")).groupBy("row_id", "row_h", "digest").agg(F.min("data").alias("data"))
        brought = stored(hits.join(data, ["row_id", "row_h", "digest"]).select("digest", "run", "variant", "row", "n", "data"), "exact-texts")
        equal = brought.groupBy("digest", "data").agg(F.min("row").alias("row"), F.sum("n").alias("n"))
        checked = brought.select("digest", "run", "variant", "data").join(equal, ["digest", "data"]).select("digest", "run", "variant", "row", "n")
        singles = merged.where("n_entries = 1").select("digest", "run", "variant", row.alias("row"), "n")
        resolved = singles.unionByName(checked).select(F.col("digest").alias("k"), "run", "variant", F.col("row").alias("keep"), F.col("n").alias("size"))
        resolved = block.keep(stored(resolved, "exact-groups"))
    rows = every.where("not is_entry").withColumn("k", F.substring("digest", 1, digest_bytes))
    joined = rows.join(resolved, ["k", "run", "variant"])
    keep_id = F.when(F.col("keep.row_id") != _LAST, F.col("keep.row_id"))
    return joined.select("doc_id", keep_id.alias("keep_id"), F.col("size").alias("group_size"), (row == F.col("keep")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of equal texts."""
    sha = F.sha2(F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)
    keep = exact_groups(docs, id_col, text_col).where("kept").select(F.coalesce("doc_id", F.lit(_LAST)).alias("_ed_id"), F.col("text_sha256").alias("_ed_sha"))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("_ed_id"), sha.alias("_ed_sha"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_ed_row"))
    rows = rows.groupBy("_ed_id", "_ed_sha").agg(F.first("_ed_row").alias("_ed_row"))  # rows may repeat
    return rows.join(keep, ["_ed_id", "_ed_sha"], "left_semi").select(*[F.col("_ed_row").getField(c).alias(c) for c in docs.columns])


#: The same in SQL. Rows with one id and one text can't be told apart there; the tables have no such rows.
ORACLE = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)
"""

"""Near-duplicate detection with b-bit MinHash.

Documents of one shingle set are one class, so exact copies meet only in an aggregate. Each class has minima under random
functions; bands of minima give the buckets in which candidates meet, and the low bits of all minima, packed into four
longs, give an estimate of the similarity, corrected for chance equality of the bits.

Candidates are not paired all with all. First every member of a bucket meets the bucket's first document; pairs whose
estimate is well below the threshold are left out, the others are compared on their full sets, and their links give labels to
whole components. Buckets whose members still carry different labels are open. There, blocks of members meet by their packed
signatures alone, which shows who may be linked with a document of another label; only such members' full sets are then
compared, block by block: a task counts the intersections of two blocks and returns only the links that join what was apart.
So no link between components is lost, and links emitted grow with the members, not with their pairs. What is sent to the
tasks is members * blocks: 52 bytes a member for each 4,096 members of an open bucket, and the full sets of those who may be
linked for each 2,048 of them. The time for comparing within an open bucket grows with the square of its members, as the
comparison is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, files_for, give_back, scratch, spread, stored, text_chunks
from .components import connected_components

#: Minima of a document and the bits kept of each: 128 * 2 bits fill four longs.
MINIMA, BITS = 128, 2
#: How far an estimate may lie below the threshold before the pair is left out: over five standard deviations.
MARGIN = 0.2
#: Members of a block that meets others by signatures, and members and shingles of one that does so by full sets, about.
BLOCK_SIGNATURES, BLOCK_MEMBERS, BLOCK_SHINGLES = 4096, 2048, 1_000_000
_LAST = (1 << 63) - 1
_U = np.uint64


def bands_for(threshold: float, miss: float = 1e-6) -> tuple[int, int]:
    """(bands, rows): the most rows for which a pair at the threshold meets in no bucket with a chance of ``miss`` at most."""
    for rows in range(10, 0, -1):
        bands = MINIMA // rows
        if (1 - threshold**rows) ** bands <= miss:
            return bands, rows
    return MINIMA, 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Shingle sets of texts: sorted hashes of runs of ``k`` words with A-Z in lower case."""

    def __init__(self, k: int, cache: int = 400_000):
        self.k, self.cache, self.known, self.hashes = k, cache, {}, np.zeros(0, np.uint64)

    def _codes(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        codes = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(codes < 0).tolist()
        if new:
            fresh = list(dict.fromkeys([words[i] for i in new]))
            if len(self.known) + len(fresh) > self.cache and self.known:
                self.known, self.hashes = {}, np.zeros(0, np.uint64)
                return self._codes(words)
            base = len(self.known)
            self.known.update(zip(fresh, range(base, base + len(fresh)), strict=True))
            self.hashes = np.concatenate((self.hashes, np.array([xxhash.xxh3_64_intdigest(w) for w in fresh], np.uint64)))
            codes[new] = np.fromiter((self.known[words[i]] for i in new), np.int64, len(new))
        return codes

    def sets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(shingles of all texts, one sorted set after another; the size of each set)."""
        split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
        sizes = np.array([len(w) for w in split], np.int64)
        codes = self._codes([w for ws in split for w in ws])
        h = self.hashes[codes]
        doc = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        # a text of fewer words is one shingle: its run ends with the text
        start = (place == 0) | (place + self.k <= np.repeat(sizes, sizes))
        acc, ends = np.zeros(len(doc), np.uint64), np.repeat(sizes, sizes)
        padded = np.concatenate((h, np.zeros(self.k, np.uint64)))
        for j in range(self.k):
            acc = _mix(acc + np.where(place + j < ends, padded[j : j + len(doc)] | _U(1), _U(0)) + _U(j + 1))
        doc, acc = doc[start], acc[start]
        order = np.lexsort((acc, doc))
        doc, acc = doc[order], acc[order]
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (acc[1:] != acc[:-1]))) if len(doc) else np.zeros(0, bool)
        return acc[new], np.bincount(doc[new], minlength=len(texts))


def minima(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``MINIMA`` minima (32 bits) for each set that isn't empty."""
    rng = np.random.RandomState(1)
    scale = (rng.randint(1, 1 << 31, MINIMA).astype(np.uint64) << _U(32) | rng.randint(0, 1 << 31, MINIMA).astype(np.uint64)) | _U(1)
    shift = rng.randint(0, 1 << 31, MINIMA).astype(np.uint64) << _U(31)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.empty((len(starts), MINIMA), np.uint64)
    first, lens = 0, sizes[sizes > 0]
    while first < len(starts):  # as many sets at once as stay in the processor's cache
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + 32_768)))
        x = shingles[starts[first] : starts[last - 1] + lens[last - 1]]
        at = starts[first:last] - starts[first]
        for j in range(MINIMA):
            out[first:last, j] = np.minimum.reduceat((x * scale[j] + shift[j]) >> _U(32), at)
        first = last
    return out


def pack(found: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of all minima as four longs for each row."""
    low = found & _U((1 << BITS) - 1)
    per = 64 // BITS
    return np.stack([np.bitwise_or.reduce(low[:, i * per : (i + 1) * per] << (np.arange(per, dtype=np.uint64) * _U(BITS)), axis=1) for i in range(MINIMA // per)], 1).view(np.int64)


def band_keys(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(found), bands), np.uint64)
    for j in range(bands):
        acc = np.full(len(found), j + 1, np.uint64)
        for i in range(rows):
            acc = _mix(acc + found[:, j * rows + i])
        out[:, j] = acc
    return out.view(np.int64)


def estimate(a: Column, b: Column) -> Column:
    """The similarity that two packed signatures show: equal minima's share, less what two bits match by chance."""
    unlike = F.lit(0)
    for i in range(MINIMA * BITS // 64):
        x = a.getItem(i).bitwiseXOR(b.getItem(i))
        unlike = unlike + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    chance = 1 / (1 << BITS)
    return (F.lit(1.0) - unlike / F.lit(float(MINIMA)) - F.lit(chance)) / F.lit(1 - chance)


_SIG = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sig", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, h, n_shingles, digest, sig, bands`` of every row of (doc_id, h, text); the last three null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        shingler = Shingler(k)
        for batch in batches:
            for start, texts in text_chunks(batch):
                shingles, sizes = shingler.sets(texts)
                found = minima(shingles, sizes)
                packed, keys = pack(found), band_keys(found, bands, rows)
                ends, some = np.cumsum(sizes).tolist(), np.flatnonzero(sizes)
                digests: list = [None] * len(texts)
                sigs, lists = list(digests), list(digests)
                for at, i in enumerate(some.tolist()):
                    digests[i] = hashlib.blake2b(shingles[ends[i] - sizes[i] : ends[i]].tobytes(), digest_size=16).digest()
                    sigs[i], lists[i] = packed[at], keys[at]
                yield pa.RecordBatch.from_arrays([*(c.slice(start, len(texts)) for c in batch.columns[:2]), pa.array(sizes, pa.int64()), *(pa.array(x, f.type) for x, f in zip((digests, sigs, lists), list(_SIG)[3:], strict=True))], schema=_SIG)
        give_back()

    return docs.select("doc_id", "h", "text").mapInArrow(run, "doc_id long, h long, n_shingles long, digest binary, sig array<long>, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``digest, shingles`` of the classes in ``wanted`` (rep, digest), from the texts of their representatives.

    A representative is an id and a hash of its text, so rows without an id don't meet under one key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        shingler = Shingler(k)
        for batch in batches:
            want = batch.column(0).to_pylist()
            for start, texts in text_chunks(batch):
                shingles, sizes = shingler.sets(texts)
                ends = np.cumsum(sizes).tolist()
                parts = [shingles[e - s : e] for s, e in zip(sizes.tolist(), ends, strict=True)]
                good = [i for i, p in enumerate(parts) if hashlib.blake2b(p.tobytes(), digest_size=16).digest() == want[start + i]]
                yield pa.RecordBatch.from_arrays([pa.array([want[start + i] for i in good], pa.binary()), pa.array([parts[i].view(np.int64) for i in good], pa.list_(pa.int64()))], names=["digest", "shingles"])
        give_back()

    text = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), "h", "text")
    rows = text.join(wanted.select("rep.id", "rep.h", "digest"), ["id", "h"]).select("digest", "text").mapInArrow(run, "digest binary, shingles array<long>")
    return rows.groupBy("digest").agg(F.first("shingles").alias("shingles"))  # rows may repeat


def _may_link(percent: int):
    """For one pair of blocks: the members whose signatures allow a link with a member of another label in the other block."""

    def run(group: pa.Table) -> pa.Table:
        block, label = np.array(group.column("block").to_pylist()), np.unique(np.array([x.hex() for x in group.column("label").to_pylist()]), return_inverse=True)[1]
        sig = group.column("sig").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, MINIMA * BITS // 64)
        # estimate >= threshold - margin, as a number of minima that differ
        most = int(MINIMA * (1 - 1 / (1 << BITS)) * (1 - (percent / 100 - MARGIN)) + 1e-9)
        left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        hit, theirs = np.zeros(len(block), bool), sig[right]
        for at in range(0, len(left), 32):
            part = left[at : at + 32]
            x = sig[part][:, None, :] ^ theirs[None, :, :]
            unlike = np.bitwise_count((x | x >> _U(1)) & _U(0x5555555555555555)).sum(2)
            near = (unlike <= most) & (label[part][:, None] != label[right][None, :])
            hit[part] |= near.any(1)
            hit[right] |= near.any(0)
        return group.filter(pa.array(hit)).select(["bucket", "digest"])

    return run


def _settle(percent: int):
    """For one pair of blocks: pairs of labels that links join, compared on full sets; a forest of them."""

    def run(group: pa.Table) -> pa.Table:
        names, label = np.unique(np.array([x.hex() for x in group.column("label").to_pylist()]), return_inverse=True)
        block, first = np.array(group.column("block").to_pylist()), label.copy()
        column = group.column("shingles").combine_chunks()
        sizes = column.value_lengths().to_numpy().astype(np.int64)
        _, code, times = np.unique(column.flatten().to_numpy(), return_inverse=True, return_counts=True)
        shared = np.cumsum(times > 1) - 1
        owner, keep = np.repeat(np.arange(len(sizes)), sizes), times[code] > 1
        owner, column = owner[keep], shared[code[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        both, width = np.zeros((len(left), len(right)), np.int32), 2048
        for tile in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, (tile, tile + width))
            dense = np.zeros((len(sizes), width), np.float32)
            dense[owner[a:b], column[a:b] - tile] = 1
            both += (dense[left] @ dense[right].T).astype(np.int32)
        out = []
        for i, x in enumerate(left.tolist()):
            common = both[i].astype(np.int64)
            link = right[100 * common >= percent * (sizes[x] + sizes[right] - common)]
            for y in link[label[link] != label[x]].tolist():
                if label[y] != label[x]:
                    out.append((bytes.fromhex(names[first[x]]), bytes.fromhex(names[first[y]])))
                    label[label == label[y]] = label[x]
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([x for _, x in out], pa.binary())})

    return run


def _in_blocks(members: DataFrame, blocks: Column) -> DataFrame:
    """Every member once for each block of its bucket: ``lo, hi`` is the pair of blocks that meet, ``block`` the member's own."""
    d = members.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    return d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("blocks", "other")


def _classes(source: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows of (doc_id, h, text), and ``digest, rep, component`` of every class, both stored: ``rep`` is
    the least (id, hash) of a class, ``component`` that of all classes that links lead to."""
    bands, rows = bands_for(percent / 100)
    sigs = stored(signatures(spread(source), k, bands, rows), "minhash-sigs")
    with scratch(source.sparkSession) as block:
        some = sigs.where("digest is not null")
        files = files_for(sigs.count())
        rep = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), "h")
        classes = some.groupBy("digest").agg(F.min(rep).alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
        classes = stored(classes, "minhash-classes")
        placed = classes.select("digest", "rep", "n", F.explode("bands").alias("bucket"))
        heads = placed.groupBy("bucket").agg(F.count("*").alias("members"), F.min(F.struct("rep", "digest")).alias("head")).where("members > 1")
        heads = stored(heads, "minhash-heads", files)  # here and below: stored, so that the join can split a hot key
        buckets = stored(placed.join(heads, "bucket").select("bucket", "digest", "n", "members", F.col("head.digest").alias("head")), "minhash-buckets", files)
        # stars: every member against the first of its bucket
        pairs = buckets.where("digest <> head").select(F.col("digest").alias("a"), F.col("head").alias("b")).distinct()
        sig = lambda c: classes.select(F.col("digest").alias(c), F.col("sig").alias(f"sig_{c}"))
        near = stored(pairs.join(sig("a"), "a").join(sig("b"), "b").where(estimate(F.col("sig_a"), F.col("sig_b")) >= percent / 100 - MARGIN).select("a", "b"), "minhash-pairs", files)
        wanted = near.select(F.col("a").alias("digest")).unionByName(near.select(F.col("b").alias("digest"))).unionByName(buckets.where("members > 2").select("digest")).distinct()
        sets = stored(full_sets(source, classes.select("digest", "rep").join(wanted, "digest", "left_semi"), k), "minhash-sets")
        own = lambda c: sets.select(F.col("digest").alias(c), F.col("shingles").alias(f"set_{c}"))
        common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
        stars = near.join(own("a"), "a").join(own("b"), "b").withColumn("both", common).where(100 * F.col("both") >= percent * (F.size("set_a") + F.size("set_b") - F.col("both"))).select("a", "b")
        comps = connected_components(stars)
        members = buckets.where("members > 2").join(comps.withColumnRenamed("node", "digest"), "digest", "left").withColumn("label", F.coalesce("label", "digest"))
        members = stored(members.select("bucket", "digest", "n", "members", "label"), "minhash-members", files)
        same = members.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.sum(F.xxhash64("digest").cast("decimal(38,0)")).alias("who"), F.max("members").alias("members"))
        open_ = same.where("lo <> hi").groupBy("members", "who").agg(F.min("bucket").alias("bucket")).select("bucket")  # equal buckets once
        open_ = stored(open_, "minhash-open", files)
        if not open_.isEmpty():
            comps = _join_labels(comps, members.join(open_, "bucket", "left_semi"), classes, sets, percent, files)
        least = stored(comps.join(classes.select(F.col("digest").alias("node"), "rep"), "node"), "minhash-reps", files)
        top = stored(least.groupBy("label").agg(F.min("rep").alias("component")), "minhash-tops", files)
        joined = least.join(top, "label").select(F.col("node").alias("digest"), "component")
        whole = classes.select("digest", "rep").join(joined, "digest", "left").select("digest", "rep", F.coalesce("component", "rep").alias("component"))
        whole = block.keep(stored(whole, "minhash-components", files))
    return sigs, whole


def _join_labels(comps: DataFrame, members: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, files: int) -> DataFrame:
    """``comps`` (node, label) with the labels joined that links within open buckets join; ``members`` are those buckets'."""
    by_sig = _in_blocks(members, F.ceil(F.col("members") / BLOCK_SIGNATURES)).join(classes.select("digest", "sig"), "digest")
    may = by_sig.select("bucket", "lo", "hi", "digest", "label", "block", "sig").groupBy("bucket", "lo", "hi").applyInArrow(_may_link(percent), "bucket long, digest binary")
    may = stored(members.join(may.distinct(), ["bucket", "digest"], "left_semi").select("bucket", "digest", "n", "label"), "minhash-may", files)
    sizes = stored(may.groupBy("bucket").agg(F.count("*").alias("members"), F.sum("n").alias("weight")), "minhash-sizes", files)
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_MEMBERS), F.ceil(F.col("weight") / BLOCK_SHINGLES))
    by_set = _in_blocks(may.join(sizes, "bucket"), blocks).join(sets, "digest")
    links = by_set.select("bucket", "lo", "hi", "label", "block", "shingles").groupBy("bucket", "lo", "hi").applyInArrow(_settle(percent), "a binary, b binary")
    joined = stored(connected_components(links).select(F.col("node").alias("label"), F.col("label").alias("to")), "minhash-joined", files)
    moved = comps.join(joined, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return moved.unionByName(joined.select(F.col("label").alias("node"), F.col("to").alias("label"))).distinct()  # labels that were alone are nodes too


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their sets of ``k``-word shingles; a text of
    fewer words is one shingle, and a text without words (or null) is empty and linked with nothing; very long texts are read
    whole. ``component_id`` is the smallest id that links lead to, null ids last; ``kept`` marks the rows that have it. An
    empty table gives an empty result; rows that repeat an id and a text are kept or dropped together; other columns, of
    whatever name, are ignored. A linked pair fails to meet in any bucket with a chance of 1e-6 at most.
    """
    sigs, whole = _classes(_source(docs, id_col, text_col), k, percent)
    whole = sigs.select("doc_id", "n_shingles", "digest").join(whole.select("digest", F.col("component.id").alias("component")), "digest", "left")
    component = F.when(F.col("component") == _LAST, F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return whole.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group that :func:`near_duplicates` links, with its columns: that of the smallest id.

    Null ids come last, a hash of the text decides between texts of one id, and rows that repeat an id and a text are one
    document, of which one row stays. Texts without words are linked with nothing and stay.
    """
    _, whole = _classes(_source(docs, id_col, text_col), k, percent)
    first = whole.where("rep = component").select(F.col("rep.id").alias("_nd_id"), F.col("rep.h").alias("_nd_h"), F.lit(True).alias("_nd_first"))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("_nd_id"), F.xxhash64(text).alias("_nd_h"), F.coalesce(~text.rlike(WORD), F.lit(True)).alias("_nd_empty"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_nd_row"))
    rows = rows.groupBy("_nd_id", "_nd_h").agg(F.first("_nd_row").alias("_nd_row"), F.first("_nd_empty").alias("_nd_empty"))
    kept = rows.join(first.hint("merge"), ["_nd_id", "_nd_h"], "left").where("_nd_first or _nd_empty")
    return kept.select(*[F.col("_nd_row").getField(c).alias(c) for c in docs.columns])

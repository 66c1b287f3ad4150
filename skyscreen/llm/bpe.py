"""Byte-level BPE encoding and decoding in numpy.

The distinct pieces of a chunk of text become padded matrices of token ids, one for each bucket of lengths. In each round
every row merges its leftmost pair of minimum rank; pairs are looked up in a hashed table, rows close the gap, and finished
rows leave the matrix. Ranks are those of a vocabulary file: any two neighbours whose joined bytes are a token may merge.
A piece too long for one line has a padded matrix to itself, read line by line: the round is the same, and only the line
that merges closes its gap, so a piece of n bytes takes about n * sqrt(n) steps. Pieces of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, spread, text_chunks
from .hashing import IntTable

_NONE = np.int32(1 << 30)
#: Bytes of the longest piece that shares a matrix with others, and entries of a matrix of many rows.
LONGEST_ROW, MATRIX = 4096, 1 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


#: Texts of these characters only are split by the standard library, which is faster and knows no classes by property.
_LATIN_ONLY = re.compile("[\\x00-\\x1b\\x20-\\x7e\u00a1-\u00ff]*")
_LETTERS, _NUMBERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"


def _latin(pattern: str) -> str:
    """The pattern with its two classes by property spelled out for Latin-1."""
    named = {r"\p{L}": _LETTERS, r"\p{N}": _NUMBERS}
    return re.sub(r"\[[^\]]*\]|\\p\{[LN]\}", lambda m: f"[{named[m[0]]}]" if m[0] in named else m[0].replace(r"\p{L}", _LETTERS).replace(r"\p{N}", _NUMBERS), pattern)


class PairTable:
    """The merged id of (left id, right id): every cut of a token into two tokens is an entry."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.table = IntTable(np.array(keys, np.int64), np.array(values, np.int32), _NONE)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.table.get(left.astype(np.int64) << 32 | right)


class Bpe:
    """Encoder and decoder for a table of ranks and a pattern that splits text into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache: int = 150_000):
        import regex

        self.is_latin, self.split_latin = _LATIN_ONLY.fullmatch, re.compile(_latin(pattern)).findall
        self.split, self.ranks, self.table, self.cache = regex.compile(pattern).findall, ranks, PairTable(ranks), cache
        self.first = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        tokens = sorted((rank, token) for token, rank in ranks.items())
        lens = np.zeros(tokens[-1][0] + 1, np.int64)
        lens[[r for r, _ in tokens]] = [len(t) for _, t in tokens]
        self.token_len, self.token_start = lens, np.concatenate(([0], np.cumsum(lens)[:-1]))
        self.token_bytes = np.frombuffer(b"".join(t for _, t in tokens), np.uint8)
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.parts: list[np.ndarray] = []
        self.lens = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)

    def merge_long(self, piece: np.ndarray) -> np.ndarray:
        """Merge one long row that is laid out over the lines of a padded matrix."""
        n, width = len(piece), 1 << (len(piece).bit_length() // 2 + 1)
        lines = -(-n // width)
        ids, pairs = np.zeros((lines, width), np.int32), np.full((lines, width), _NONE, np.int32)
        ids.reshape(-1)[:n], pairs.reshape(-1)[: n - 1] = piece, self.table.get(piece[:-1], piece[1:])
        ends = [min(width, n - k * width) for k in range(lines)]
        before, after = list(range(-1, lines - 1)), list(range(1, lines + 1))  # lines that still hold tokens
        least = pairs.min(1)
        while (rank := least[line := int(least.argmin())]) != _NONE:
            at = int(pairs[line].argmin())
            other, gap = (line, at + 1) if at + 1 < ends[line] else (after[line], 0)
            end = ends[other] = ends[other] - 1
            ids[line, at] = rank
            # compaction of the line that holds the pair's right half
            ids[other, gap:end], pairs[other, gap:end] = ids[other, gap + 1 : end + 1], pairs[other, gap + 1 : end + 1]
            pairs[other, end] = pairs[line, at] = _NONE
            if not end:
                if after[other] < lines:
                    before[after[other]] = before[other]
                after[before[other]] = after[other]
            right = (line, at + 1) if at + 1 < ends[line] else (after[line], 0) if after[line] < lines else None
            left = (line, at - 1) if at else (before[line], ends[before[line]] - 1) if before[line] >= 0 else None
            found = self.table.get(np.array([rank, ids[left] if left else 0], np.int64), np.array([ids[right] if right else 0, rank], np.int64))
            if right:
                pairs[line, at] = found[0]
            if left:
                pairs[left] = found[1]
            for k in {line, other, left[0] if left else line}:
                least[k] = pairs[k].min()
        return ids[np.arange(width) < np.array(ends)[:, None]]

    def merge_rows(self, ids: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every row of a padded matrix to its end; gives the matrix, left-aligned, and the new lengths."""
        out, out_len, rows = ids.copy(), lens.copy(), np.arange(len(ids))
        pairs = np.full((len(ids), ids.shape[1] - 1), _NONE, np.int32)
        real = np.arange(pairs.shape[1]) < (lens - 1)[:, None]
        pairs[real] = self.table.get(ids[:, :-1][real], ids[:, 1:][real])
        while len(rows):
            at = pairs.argmin(1)
            rank = pairs[np.arange(len(rows)), at]
            if (done := rank == _NONE).any():
                out[rows[done], : ids.shape[1]], out_len[rows[done]] = ids[done], lens[done]
                ids, lens, pairs, rows, at, rank = (x[~done] for x in (ids, lens, pairs, rows, at, rank))
                if not len(rows):
                    break
            here, move = np.arange(len(rows)), np.arange(pairs.shape[1]) > at[:, None]
            # compaction: what stands right of the merged pair moves one place left
            ids[:, :-1] = np.where(move, ids[:, 1:], ids[:, :-1])
            ids[here, at] = rank
            pairs[:, :-1] = np.where(move[:, :-1], pairs[:, 1:], pairs[:, :-1])
            pairs[:, -1] = _NONE
            lens = lens - 1
            pairs[here, at] = _NONE
            right, left = np.flatnonzero(at + 1 < lens), np.flatnonzero(at > 0)
            pairs[right, at[right]] = self.table.get(rank[right], ids[right, at[right] + 1])
            pairs[left, at[left] - 1] = self.table.get(ids[left, at[left] - 1], rank[left])
            if 2 * (most := max(2, int(lens.max()))) <= ids.shape[1]:
                ids, pairs = ids[:, :most].copy(), pairs[:, : most - 1].copy()
        return out, out_len

    def learn_pieces(self, pieces: list[str]) -> None:
        """Encode pieces that the cache hasn't seen."""
        data = [p.encode("utf-8", "surrogatepass") for p in pieces]
        lens = np.fromiter(map(len, data), np.int64, len(data))
        starts, raw = np.cumsum(lens) - lens, np.frombuffer(b"".join(data) + bytes(LONGEST_ROW), np.uint8)
        whole = np.fromiter(map(self.ranks.get, data, repeat(-1)), np.int32, len(data))
        counts, places, parts = np.where(whole >= 0, 1, 0), [np.flatnonzero(whole >= 0)], [whole[whole >= 0]]
        for k in np.flatnonzero((whole < 0) & (lens > LONGEST_ROW)).tolist():
            ids = self.merge_long(self.first[np.frombuffer(data[k], np.uint8)])
            counts[k] = len(ids)
            places.append(np.full(len(ids), k))
            parts.append(ids)
        width = 4
        while width <= LONGEST_ROW:
            inside = (whole < 0) & (lens <= width) & (lens > (width // 2 if width > 4 else 0))
            members, step = np.flatnonzero(inside), min(8192, MATRIX // width)
            for part in (members[at : at + step] for at in range(0, len(members), step)):
                ids, ends = self.merge_rows(self.first[raw[starts[part][:, None] + np.arange(width)]], lens[part])
                counts[part] = ends
                places.append(np.repeat(part, ends))
                parts.append(ids[np.arange(width) < ends[:, None]])
            width *= 2
        order = np.argsort(np.concatenate(places), kind="stable")
        base = len(self.known)
        self.known.update(zip(pieces, range(base, base + len(pieces)), strict=True))
        self.lens = np.concatenate((self.lens, counts))
        self.flat = np.concatenate((self.flat, np.concatenate(parts)[order].astype(np.int32)))
        self.starts = np.cumsum(self.lens) - self.lens

    def pieces(self, text: str) -> list[str]:
        return self.split_latin(text) if self.is_latin(text) else self.split(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of ids of each text."""
        split = [self.pieces(t) for t in texts]
        pieces = [p for ps in split for p in ps]
        codes = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(codes < 0).tolist()
        if new:
            fresh = list(dict.fromkeys([pieces[k] for k in new]))
            if len(self.known) + len(fresh) > self.cache and self.known:
                self._reset()
                return self.encode(texts)
            self.learn_pieces(fresh)
            codes[new] = np.fromiter((self.known[pieces[k]] for k in new), np.int64, len(new))
        lens = self.lens[codes]
        ids, ends = _gather(self.flat, self.starts[codes], lens), np.cumsum(lens)
        stops = np.concatenate(([0], ends))[np.cumsum([len(ps) for ps in split], dtype=np.int64)]
        return ids, np.diff(stops, prepend=0)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each text from the ids of all."""
        lens = self.token_len[ids]
        data = _gather(self.token_bytes, self.token_start[ids], lens).tobytes()
        stops = np.concatenate(([0], np.cumsum(lens)))[np.concatenate(([0], np.cumsum(counts)))]
        return [data[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]


def _gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The slices flat[start : start + len], one after another."""
    ends = np.cumsum(lens)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(starts - ends + lens, lens) + np.arange(ends[-1])]


_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.binary())])
_WORKER: dict = {}


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, and ``ids`` (little-endian uint32) if asked for.

    The vocabulary is read on the executors from ``ranks_path``. Null texts count as empty and have no ids; texts of any
    length are encoded whole; null ids stay null; repeated rows are encoded alike, a result row each; of equal ranks the
    leftmost pair merges first; an empty table gives an empty result; other columns, of whatever name, are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _WORKER.get("key") != (ranks_path, pattern):
            _WORKER.update(key=(ranks_path, pattern), bpe=Bpe(load_ranks(ranks_path), pattern))
        bpe = _WORKER["bpe"]
        for batch in batches:
            doc_ids = batch.column(0)
            for start, texts in text_chunks(batch):
                ids, counts = bpe.encode(texts)
                back = bpe.decode(ids, counts)
                raw, stops = ids.astype("<u4"), np.concatenate(([0], np.cumsum(counts))).tolist()
                parts = [raw[a:b].tobytes() for a, b in zip(stops[:-1], stops[1:], strict=True)]
                columns = [doc_ids.slice(start, len(texts)), counts, [hashlib.sha256(p).hexdigest() for p in parts], [hashlib.sha256(b).hexdigest() for b in back], parts if with_ids else [None] * len(texts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, _OUT, strict=True)], schema=_OUT)
        give_back()

    narrow = spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    out = narrow.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary")
    return out if with_ids else out.drop("ids")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``: null ids give null, empty ones the empty text, each row one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(load_ranks(ranks_path), pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part, texts = batch.slice(start, 256), []
                for value in part.column(1):
                    ids = np.frombuffer(value.as_py() or b"", "<u4").astype(np.int64)
                    texts.append(bpe.decode(ids, np.array([len(ids)]))[0].decode("utf-8", "replace") if value.is_valid else None)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")

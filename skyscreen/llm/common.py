"""What the operators of this package share: tables, the shared folder, words, batches."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, scratch, shared_dir, stored  # noqa: F401

#: A word is a run of anything but these six characters; ``bytes.split()`` cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
#: Characters of text that a Python worker holds as words at once.
CHUNK_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal out a table that one or two files hold, so that all cores take part; larger tables stay as they are.

    Rows are dealt in turn, not by a key: no key, null or frequent, lands in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= min(cores, 4) else df.repartition(cores)


def files_for(rows: int) -> int:
    """Files for a table of so many short rows: they grow with the square root, as does what each holds (a million rows make
    50 of 20,000, ten thousand million 5,000 of two million)."""
    return max(1, math.ceil(math.sqrt(rows) / 20))


def crc_mod(column: str, mod: int):
    """crc32 of the id as text, modulo ``mod``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


def text_chunks(batch: pa.RecordBatch, column: str = "text", chars: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows that hold about ``chars`` characters; null texts are empty."""
    texts: list[str] = []
    start = held = 0
    for i, value in enumerate(batch.column(batch.schema.get_field_index(column))):
        text = value.as_py() or ""
        texts.append(text)
        held += len(text)
        if held >= chars:
            yield start, texts
            texts, start, held = [], i + 1, 0
    if texts:
        yield start, texts


def give_back() -> None:
    """Return the memory that a worker has freed to the system: reused workers otherwise keep the most they ever held."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass

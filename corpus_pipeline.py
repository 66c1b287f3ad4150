"""A corpus pipeline of five stages, each of which applies one operator to all that the stage before it kept.

Every stage takes null ids, null sources, null and empty texts, very long texts, repeated rows, rows that share an id, empty
tables and further columns of any name, and never finds rows again by their ids alone. What it makes of them stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyscreen.llm import bpe, line_dedup, minhash, mixing, quality_rules
from skyscreen.llm.common import scratch, stored, table


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the learned list keep, judged one by one.

    Null, empty and short texts fail the base rules and go; rows without an id or a label are judged like others; repeated rows
    stay or go alike.
    """
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of later repeated runs; those of which nothing is left go.

    ``n_chars`` follows the text where lines went, and stays as it is elsewhere. Null and empty texts have no lines and stay;
    rows that repeat an id and a text are one document and change alike.
    """
    cut = line_dedup.dedup_lines(docs).where("lines_removed < lines_before or lines_before = 0")
    if "n_chars" in docs.columns:
        changed = F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", changed)
    return cut.select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more: that of the smallest id.

    Null ids come last; rows that repeat an id and a text are one document, of which one row stays; texts without words stay.
    """
    return minhash.drop_near_duplicates(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a row for every epoch.

    Texts without words are not taken; a null source is a source; rows without an id draw by their text; repeated rows are
    taken one by one.
    """
    return mixing.mix_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of decoded bytes, a row for every row of the mix; null texts count as empty."""
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", reject_low_quality),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", keep_one_of_near_duplicates),
    ("source mix", mix_sources),
    ("byte-level BPE", encode),
]

#: The learned list and the encoder have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the table of documents; of the tables written on the way only the last one stays."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as tables:
        for name, stage in STAGES:
            with scratch(spark) as own:
                docs = own.keep(stored(stage(spark, docs, sf_dir), name.replace(" ", "-")))
        return tables.keep(docs)

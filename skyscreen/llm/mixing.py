"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, divided by its quality weight; sorted by key, the documents of a source are a
weighted sample without replacement, whatever the prefix. A source first gives its complete epochs, then the prefix of its
sorted documents that meets the rest of its budget. No source is sorted in one task: keys are read as numbers of four digits,
sums by digit give the digit in which the budget ends, and so on within that digit until few documents are left, whatever the
size of the source. Only those are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, stored

#: Bits of a digit of a key, digits of a key, and documents of a source that are few enough to be put in order.
DIGIT_BITS, DIGITS, FEW = 12, 4, 50_000


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for clean prose, down to 0.1 as the share of symbol characters grows."""
    t = F.coalesce(text, F.lit(""))
    symbols = F.length(t) - F.length(F.translate(t, "#*$%&|<>!", ""))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(5.0) * symbols.cast("double") / F.greatest(F.length(t), F.lit(1)).cast("double"))


def draw(seed: str, key: Column) -> Column:
    """A number in (0, 1) that depends on the seed and the key only."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13), 16, 10)
    return (digits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, a row for each source.

    Weights repeat over the sources by code point, null last. Sharing by weight, stopping at ``most`` times the size and
    sharing the excess again ends where target = min(cap, level * weight); the level follows from the caps in the order of
    cap / weight, summed as windows over this table of sources, which a registry of sources bounds.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    d = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(most)).withColumn("ratio", F.col("cap") / F.col("w"))
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
    full = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    d = d.withColumn("level", (total - full) / F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    d = d.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(Window.partitionBy())["level"])
    return d.select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def _mixed(docs: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: str, id_col: str, source_col: str, text_col: str, weight: Column | None, few: int, bits: int, carry: bool) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every row, and all its columns as ``row`` if they are carried."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.coalesce(F.col(id_col).cast("string"), F.md5(text.cast("binary")))  # rows without an id draw by their text
    key = -F.log(draw(seed, own)) / (quality_weight(text) if weight is None else weight)
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(text).alias("size"), key.alias("key"), *row)
    place = F.floor(F.col("key") / (F.lit(1.0) + F.col("key")) * F.lit(float(1 << bits * DIGITS))).cast("long")
    narrow = stored(narrow.withColumn("place", place), "mix-keys")
    upto = lambda level: F.shiftright("place", bits * (DIGITS - level))
    by_digit = narrow.groupBy("source", upto(1).alias("at")).agg(F.sum("size").alias("n"), F.count("*").alias("rows"))
    by_digit = stored(by_digit, "mix-digits")
    plan = source_targets(by_digit.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + F.lit(1e-12))).otherwise(0).cast("long")
    plan = plan.withColumn("epochs", epochs).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
    plan = stored(plan.withColumn("before", F.lit(0).cast("long")), "mix-plan")
    level = 1
    while True:
        before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        cut = by_digit.withColumn("below", before).alias("b").join(plan.select("source", "rest", "before").alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")))
        cut = cut.where("p.before + below + n > rest").groupBy("b.source").agg(F.min(F.struct("at", (F.col("p.before") + F.col("below")).alias("before"), "rows")).alias("c"))
        plan = plan.drop("cut", "rows").withColumnRenamed("before", "was").alias("p").join(cut.alias("q"), F.col("p.source").eqNullSafe(F.col("q.source")), "left")
        plan = plan.select("p.*", F.col("c.at").alias("cut"), F.coalesce("c.before", "was").alias("before"), F.col("c.rows").alias("rows")).drop("was")
        plan = stored(plan, "mix-plan")
        if level == DIGITS or plan.where(F.col("rows") > few).isEmpty():
            break
        inside = narrow.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (upto(level) == F.col("p.cut")))
        level += 1
        by_digit = inside.groupBy("d.source", upto(level).alias("at")).agg(F.sum("size").alias("n"), F.count("*").alias("rows"))
        by_digit = stored(by_digit, "mix-digits")
    d = narrow.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).withColumn("at", upto(level))
    d = d.select("d.doc_id", "d.source", "d.size", "d.key", "at", "p.source_size", "p.target", "p.epochs", "p.rest", "p.cut", "p.before", *(["d.row"] if carry else []))
    out = lambda x, part: x.select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("epochs") + part.cast("long"))).alias("taken"), "source", (F.col("epochs") + part.cast("long")).alias("times"), *(["row"] if carry else []))
    on_cut = F.coalesce(F.col("at") == F.col("cut"), F.lit(False))
    clear = out(d.where(~on_cut), F.coalesce(F.col("at") < F.col("cut"), F.lit(True)) & (F.col("rest") > 0))
    in_order = Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    edge = d.where(on_cut).withColumn("below", F.col("before") + F.coalesce(F.sum("size").over(in_order), F.lit(0)))
    return clear.unionByName(out(edge, F.col("below") + F.col("size") / F.lit(2.0) <= F.col("rest")))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weight: Column | None = None, few: int = FEW, bits: int = DIGIT_BITS) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source`` for every row of ``docs``, those that the mix leaves out with taken 0.

    ``taken`` is the document's size times its number of epochs; documents are taken whole, and the last one of a source is
    taken if that brings the source nearer to its target. ``weight`` is a column of positive quality weights; without one the
    share of symbol characters gives it. Null and empty texts have size 0 and very long ones their whole size; null sources
    are one source that comes last; ties of keys go by id; rows without an id draw by their text; repeated rows draw equal
    keys and are taken one by one; an empty table gives an empty result; other columns, of whatever name, are ignored. The
    draw depends on ``seed`` and the id (or text) alone, so reruns agree.
    """
    return _mixed(docs, weights, share, most, seed, id_col, source_col, text_col, weight, few, bits, False).drop("times")


def mix_rows(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weight: Column | None = None) -> DataFrame:
    """The rows of ``docs`` with their columns, each as often as :func:`mix` takes it; texts of size 0 are never taken.

    Rows carry their columns along and are not found again by their ids, so null and repeated ids are rows like others.
    """
    d = _mixed(docs, weights, share, most, seed, id_col, source_col, text_col, weight, FEW, DIGIT_BITS, True)
    d = d.where("taken > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return d.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


#: The same in SQL, with the digits of the keys left out.
ORACLE = """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
  greatest(0.1, 1.0::DOUBLE - 5.0::DOUBLE * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>!', '')))::DOUBLE / greatest(length(coalesce(text, '')), 1)::DOUBLE) AS weight,
  ((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT)::DOUBLE + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents),
k AS (SELECT *, -ln(u) / weight AS key FROM d),
s AS (SELECT source, sum(size)::DOUBLE AS source_size FROM k GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 2.0::DOUBLE * source_size AS cap FROM r),
l AS (SELECT *, cap / w AS ratio, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, (SELECT min_by(level, ratio) FROM l WHERE level <= ratio) * w) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-12)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (SELECT k.doc_id, k.source, size, e.source_size, target, epochs, target - epochs * e.source_size AS rest, coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, size * (epochs + CASE WHEN rest > 0 AND below + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) AS taken, source FROM p
"""

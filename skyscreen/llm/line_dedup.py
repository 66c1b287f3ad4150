"""Line dedup by winnowing, in DataFrame operations alone.

Lines with words are hashed, twice over: 64 bits order the lines, and 32 others are summed over each fingerprint, so that it
takes 96 equal bits for other lines to pass as the same. From each line a window runs on until it holds ``min_words`` words; the smallest hash of every
window is selected, so a passage of at least ``2 * min_words`` words has selected lines, and the same ones wherever it
stands. A selected line brings the content of the window that begins and of the window that ends with it as fingerprints.
Fingerprints that occur again join the first place that has them; the match grows both ways over equal neighbours, and the
lines of the later run are deleted. Where the surroundings differ from those of the first place, the match also grows as far
as any other earlier place allows: every longer stretch of neighbours, with the fingerprint, has a first place of its own.
The lines beyond a fingerprint's window that belong to the same passage and to no other fingerprint hold fewer than
``min_words`` words, so each fingerprint carries that much of its surroundings and no document is read again to extend a match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, stored

#: Repeated runs of under 25 words stay; passages of 50 words and more are found for certain.
MIN_WORDS = 25


def _leading(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    unlike = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.when(unlike > 0, unlike - 1).otherwise(F.size(a)).cast("int")


def worded_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, version, lines`` of every different (id, text): number, hashes and words of each line that has words.

    ``version`` is a hash of the text, for ids that repeat with other texts.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), F.xxhash64(x).alias("h"), F.hash(x).cast("long").alias("g"), F.regexp_count(x, F.lit(WORD)).alias("words")))
    flat = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select("doc_id", F.xxhash64("text").alias("version"), F.filter(lines, lambda x: x["words"] > 0).alias("lines"))
    return flat.groupBy("doc_id", "version").agg(F.first("lines").alias("lines"))


def fingerprints(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``key, doc_id, version, first, n, before, after`` of every fingerprint.

    A fingerprint is the window of ``n`` worded lines from the place ``first`` on; ``key`` stands for its content. ``before``
    has the hashes of the lines before it, the nearest first, and ``after`` of those after it, as far as ``min_words`` reach.
    """
    d = lines.select("doc_id", "version", F.posexplode("lines").alias("at", "l")).select("doc_id", "version", "at", "l.h", "l.g", "l.words")
    by_doc = Window.partitionBy("doc_id", "version")
    d = d.withColumn("end", F.sum("words").over(by_doc.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))).withColumn("begin", F.col("end") - F.col("words"))
    # the window from a line on: lines that begin within min_words words; the window that ends with it: lines that end so near
    on, back, order = by_doc.orderBy("begin").rangeBetween(0, min_words - 1), by_doc.orderBy("end").rangeBetween(1 - min_words, 0), by_doc.orderBy("begin")
    least = F.min(F.struct("h", (-F.col("at")).alias("near"))).over(on)
    d = d.select("*", F.collect_list("h").over(on).alias("on"), F.sum("g").over(on).alias("on_sum"), F.max("end").over(on).alias("on_end"), least.alias("least"))
    d = d.withColumn("on_whole", F.col("on_end") - F.col("begin") >= min_words).withColumn("least", F.when(F.col("on_whole"), -F.col("least.near")))
    d = d.withColumn("chosen", F.array_contains(F.collect_set("least").over(by_doc.orderBy("begin").rangeBetween(1 - min_words, 0)), F.col("at"))).withColumn("next_on", F.lead("on").over(order))
    d = d.withColumn("on_after", F.max_by("next_on", "at").over(on))
    d = d.select("*", F.collect_list("h").over(back).alias("back"), F.sum("g").over(back).alias("back_sum"), (F.col("end") - F.min("begin").over(back) >= min_words).alias("back_whole"))
    d = d.withColumn("prev_back", F.lag("back").over(by_doc.orderBy("end")))
    d = d.withColumn("back_before", F.min_by("prev_back", "at").over(back))
    none = F.array().cast("array<bigint>")
    mark = lambda content, total, first, before, after: F.struct(content.alias("content"), total.alias("total"), first.alias("first"), F.reverse(F.coalesce(before, none)).alias("before"), F.coalesce(after, none).alias("after"))
    forward = F.when(F.col("on_whole"), mark(F.col("on"), F.col("on_sum"), F.col("at"), F.col("prev_back"), F.col("on_after")))
    backward = F.when(F.col("back_whole"), mark(F.col("back"), F.col("back_sum"), F.col("at") - F.size("back") + 1, F.col("back_before"), F.col("next_on")))
    d = d.where("chosen").select("doc_id", "version", F.explode(F.array_distinct(F.filter(F.array(forward, backward), lambda x: x.isNotNull()))).alias("f"))
    key = F.struct(F.xxhash64("f.content").alias("x"), F.hash("f.content", "f.total").alias("y"), F.col("f.total").alias("t"), F.size("f.content").alias("z"))
    return d.select(key.alias("key"), "doc_id", "version", "f.first", F.size("f.content").alias("n"), "f.before", "f.after")


def _stretches(side: str, common: str) -> Column:
    """``k, size`` of every stretch of neighbours on one side that is longer than what is shared with the first place."""
    sizes = F.filter(F.sequence(F.lit(0), F.size(side)), lambda j: j > F.col(common))

    def one(j: Column) -> Column:
        part = F.slice(side, F.lit(1), j)
        return F.struct(F.struct(F.xxhash64("key", F.lit(side), part).alias("x"), F.hash("key", F.lit(side), part).alias("y"), j.alias("z")).alias("k"), F.lit(side).alias("side"), j.alias("size"))

    return F.transform(sizes, one)


def repeated_runs(marks: DataFrame) -> DataFrame:
    """``doc_id, version, runs`` of documents with lines that stand in an earlier place too: (from, to) among worded lines.

    Places are ordered by id (null first), version and line; the first place of a fingerprint is the one that stays. A later
    place matches as many neighbours on each side as any earlier place shares, not the first one alone. The sides don't
    depend on each other, as a run on either has the fingerprint's window and so ``min_words`` words.
    """
    marks = stored(marks, "line-marks")
    place = F.struct("doc_id", "version", "first")
    heads = marks.groupBy("key").agg(F.count("*").alias("times"), F.min(F.struct("doc_id", "version", "first", "before", "after")).alias("head")).where("times > 1").select("key", "head")
    heads = stored(heads, "line-heads")  # so that the join can split a hot key
    later = marks.join(heads, "key").where(~place.eqNullSafe(F.struct("head.doc_id", "head.version", "head.first")))
    later = later.withColumn("up", _leading(F.col("before"), F.col("head.before"))).withColumn("down", _leading(F.col("after"), F.col("head.after")))
    last = F.col("first") + F.col("n") - 1
    later = stored(later.select("doc_id", "version", "first", "n", "up", "down", F.concat(_stretches("before", "up"), _stretches("after", "down")).alias("more")), "line-later")
    runs = later.select("doc_id", "version", F.struct((F.col("first") - F.col("up")).alias("from"), (last + F.col("down")).alias("to")).alias("run"))
    more = later.select("doc_id", "version", "first", "n", F.explode("more").alias("m")).select("doc_id", "version", "first", "n", "m.*")
    firsts = more.groupBy("k").agg(F.min(place).alias("head"), F.max(place).alias("tail")).where(~F.col("head").eqNullSafe(F.col("tail"))).select("k", "head")
    firsts = stored(firsts, "line-firsts")  # as above
    longer = more.join(firsts.hint("merge"), "k").where(~place.eqNullSafe(F.col("head")))
    grown = F.struct((F.col("first") - F.when(F.col("side") == "before", F.col("size")).otherwise(0)).alias("from"), (last + F.when(F.col("side") == "after", F.col("size")).otherwise(0)).alias("to"))
    return runs.unionByName(longer.select("doc_id", "version", grown.alias("run"))).groupBy("doc_id", "version").agg(F.collect_set("run").alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its columns, the text without later repeated runs, and ``lines_before``, ``lines_removed``.

    A run is a passage of whole lines with ``min_words`` words or more that also stands at an earlier place, in the same or
    another document; lines without words don't count and stay. Places are ordered by id (null first), a hash of the text and
    line. Null texts stay null, empty ones empty, and both have no lines; very long texts are read whole; rows that repeat an
    id and a text are one document and change alike, and rows that share an id (or have none) with other texts are documents
    of their own; an empty table gives an empty result. Columns of ``docs`` may have any names; those called
    ``lines_before`` or ``lines_removed`` are replaced.
    """
    runs = repeated_runs(fingerprints(worded_lines(docs, id_col, text_col), min_words))
    runs = stored(runs.select(F.col("doc_id").alias("_ld_id"), F.col("version").alias("_ld_version"), F.col("runs").alias("_ld_runs")), "line-runs")
    # a row of docs is one value here, so that its columns meet none of these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_ld_row"), F.col(text_col).cast("string").alias("_ld_text"), F.col(id_col).cast("long").alias("_ld_own"))
    at = F.col("_ld_own").eqNullSafe(F.col("_ld_id")) & (F.xxhash64(F.coalesce("_ld_text", F.lit(""))) == F.col("_ld_version"))
    joined = rows.join(runs.hint("merge"), at, "left")  # the same plan at every size
    d = joined.withColumn("_ld_lines", F.split(F.coalesce("_ld_text", F.lit("")), "\n"))
    worded = F.filter(F.transform("_ld_lines", lambda x, i: F.when(F.regexp_count(x, F.lit(WORD)) > 0, i)), lambda i: i.isNotNull())
    gone = F.array_distinct(F.flatten(F.transform("_ld_runs", lambda r: F.sequence(r["from"], r["to"]))))
    d = d.withColumn("_ld_worded", worded).withColumn("_ld_gone", F.when(F.col("_ld_runs").isNotNull(), gone))
    raw = F.transform("_ld_gone", lambda i: F.element_at("_ld_worded", i + 1))
    rest = F.array_except(F.sequence(F.lit(0), F.size("_ld_lines") - 1), raw)
    cut = F.array_join(F.transform(rest, lambda i: F.element_at("_ld_lines", i + 1)), "\n")
    out = F.when(F.col("_ld_runs").isNull(), F.col("_ld_text")).otherwise(cut)
    counts = (F.size("_ld_worded").cast("long").alias("lines_before"), F.coalesce(F.size("_ld_gone"), F.lit(0)).cast("long").alias("lines_removed"))
    kept = [c for c in docs.columns if c not in ("lines_before", "lines_removed")]
    return d.select(*[(out if c == text_col else F.col("_ld_row").getField(c)).alias(c) for c in kept], *counts)

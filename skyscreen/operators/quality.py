"""Quality rules over scored findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sky import classify_tier
from ..specs import AT_RISK, SCORED, TIERS, QaSpec, SkySpec


def tier() -> Column:
    return F.coalesce(F.nullif(F.col("risk_tier"), F.lit("")), F.lit("undetermined"))


def is_scored() -> Column:
    return tier().isin(*SCORED)


def summary(findings: DataFrame) -> DataFrame:
    """One row: counts by tier and confidence, rates to four decimals, and the versions that occur."""
    n, scored = F.count("*"), F.count_if(is_scored())
    conf = F.coalesce(F.nullif(F.col("confidence"), F.lit("")), F.lit("unknown"))
    rate = lambda a, b: F.when(b > 0, F.round(a / F.when(b > 0, b), 4)).otherwise(0.0)
    return findings.agg(
        n.alias("n_findings"),
        scored.alias("n_scored"),
        *(F.count_if(tier() == t).alias(f"n_{t}") for t in TIERS),
        *(F.count_if(conf == c).alias(f"n_confidence_{c}") for c in ("high", "medium", "low")),
        rate(F.count_if(tier() == "undetermined"), n).alias("undetermined_rate"),
        rate(F.count_if(conf == "low"), n).alias("low_confidence_rate"),
        rate(F.count_if(tier().isin(*AT_RISK)), scored).alias("at_risk_rate"),
        F.array_join(F.sort_array(F.collect_set(F.nullif(F.col("spec_version"), F.lit("")))), ",").alias("spec_versions"),
    )


def tier_histogram(findings: DataFrame) -> DataFrame:
    """``risk_tier, n`` with the four known tiers always there and unknown ones under their own name."""
    known = findings.sparkSession.createDataFrame([(t,) for t in TIERS], "risk_tier string")
    counts = findings.groupBy(tier().alias("risk_tier")).agg(F.count("*").alias("n"))
    return known.join(counts, "risk_tier", "full").select("risk_tier", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def pct_distribution(findings: DataFrame) -> DataFrame:
    """Number, extremes, mean, exact median and distinct values of the obstruction percentages."""
    p = F.col("obstruction_pct")
    return findings.where(p.isNotNull()).agg(F.count("*").alias("n"), F.min(p).alias("min_pct"), F.max(p).alias("max_pct"), F.round(F.avg(p), 4).alias("mean_pct"), F.median(p).alias("median_pct"), F.count_distinct(F.round(p, 6)).alias("n_distinct"))


def _samples(limit: int) -> Column:
    """The first ids in the order of ``ord``, of rows that a rank has cut before."""
    return F.slice(F.transform(F.sort_array(F.collect_list(F.struct("ord", "location_id"))), lambda x: x["location_id"]), 1, limit)


def _rule(bad: DataFrame, rule: str, severity: str, detail: str, spec: QaSpec) -> DataFrame:
    """One anomaly row, or none: the count of all offending rows and the first ids."""
    first = bad.orderBy("ord").limit(spec.max_samples).agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "location_id"))), lambda x: x["location_id"]).alias("sample_ids"))
    count = bad.agg(F.count("*").alias("n")).where("n > 0")
    return count.join(F.broadcast(first)).select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.lit("run").alias("scope"), F.lit(detail).alias("detail"), F.col("n").cast("double").alias("metric"), F.lit(0.0).alias("threshold"), "sample_ids")


def offending(findings: DataFrame, rule: str, sky: SkySpec = SkySpec()) -> DataFrame:
    """The rows that break a consistency rule."""
    p = F.col("obstruction_pct")
    inside = p.between(0, 100)
    test = {
        "tier_inconsistent": is_scored() & p.isNotNull() & inside & (classify_tier(p, sky) != tier()),
        "pct_out_of_range": is_scored() & p.isNotNull() & ~inside,
        "tier_pct_mismatch": ((tier() == "undetermined") & p.isNotNull()) | (is_scored() & p.isNull()),
    }[rule]
    return findings.where(test)


def consistency(findings: DataFrame, qa: QaSpec = QaSpec(), sky: SkySpec = SkySpec()) -> DataFrame:
    parts = [
        _rule(offending(findings, "tier_inconsistent", sky), "tier_inconsistent", "critical", "the tier differs from the band of its percentage", qa),
        _rule(offending(findings, "pct_out_of_range", sky), "pct_out_of_range", "critical", "a percentage beyond 0 to 100", qa),
        _rule(offending(findings, "tier_pct_mismatch", sky), "tier_pct_mismatch", "warn", "undetermined with a percentage, or scored without one", qa),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def coverage(stats: DataFrame, qa: QaSpec = QaSpec()) -> DataFrame:
    """Anomalies of the run's rates and versions, from the row that :func:`summary` gives."""
    none = F.array().cast("array<string>")
    row = lambda when, rule, severity, detail, metric, limit: stats.where(when).select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.lit("run").alias("scope"), F.lit(detail).alias("detail"), metric.cast("double").alias("metric"), F.lit(float(limit)).alias("threshold"), none.alias("sample_ids"))
    versions = F.when(F.col("spec_versions") == "", 0).otherwise(F.size(F.split("spec_versions", ",")))
    a = row(F.col("undetermined_rate") > qa.max_undetermined_rate, "undetermined_rate", "warn", "too many findings without a surface", F.col("undetermined_rate"), qa.max_undetermined_rate)
    b = row(F.col("low_confidence_rate") > qa.max_low_confidence_rate, "low_confidence_rate", "warn", "too many findings of low confidence", F.col("low_confidence_rate"), qa.max_low_confidence_rate)
    c = row(versions > 1, "spec_version_drift", "critical", "findings of several spec versions in one run", versions, 1)
    return a.unionByName(b).unionByName(c)


def region_stats(findings: DataFrame, key: str, weight: str | None = None) -> DataFrame:
    """Scored rows and weights of each region; rows without a region are left out."""
    w = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    d = findings.where(F.col(key).isNotNull() & is_scored())
    pct = F.round("obstruction_pct", 6)
    return d.groupBy(F.col(key).cast("string").alias("region")).agg(F.count("*").alias("n_scored"), F.sum(w).alias("scored_weight"), F.sum(F.when(tier().isin(*AT_RISK), w).otherwise(0.0)).alias("at_risk_weight"), F.min(pct).alias("low"), F.max(pct).alias("high"))


def saturated(findings: DataFrame, key: str, weight: str | None = None, qa: QaSpec = QaSpec()) -> DataFrame:
    rate = F.col("at_risk_weight") / F.col("scored_weight")
    d = region_stats(findings, key, weight).where((F.col("scored_weight") >= qa.min_region_size) & (rate >= qa.saturated_region_rate))
    return d.select("region", "scored_weight", F.round(rate, 4).alias("rate"))


def degenerate(findings: DataFrame, key: str, qa: QaSpec = QaSpec()) -> DataFrame:
    d = region_stats(findings, key).where((F.col("n_scored") >= qa.degenerate_group_min) & (F.col("low") == F.col("high")) & (F.col("high") > 0))
    return d.select("region", "n_scored", F.col("high").alias("only_pct"))


def regions(findings: DataFrame, key: str, scope: str, weight: str | None = None, qa: QaSpec = QaSpec()) -> DataFrame:
    """Anomalies of regions, in the order of their names."""
    a = saturated(findings, key, weight, qa).select(F.lit("saturated_region").alias("rule"), "region", F.col("rate").alias("metric"), F.lit(qa.saturated_region_rate).alias("threshold"), F.lit("nearly all scored locations are at risk").alias("detail"))
    b = degenerate(findings, key, qa).select(F.lit("degenerate_distribution").alias("rule"), "region", F.col("n_scored").cast("double").alias("metric"), F.lit(float(qa.degenerate_group_min)).alias("threshold"), F.lit("all scored locations share one percentage").alias("detail"))
    found = a.unionByName(b)
    # the first ids of each region that was found: ranks need only its own rows
    rows = findings.where(is_scored()).withColumn("region", F.col(key).cast("string")).join(found.select("region").distinct(), "region", "left_semi")
    first = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("region").orderBy("ord"))).where(F.col("_rank") <= qa.max_samples).groupBy("region").agg(_samples(qa.max_samples).alias("sample_ids"))
    return found.join(first, "region").select("rule", F.lit("warn").alias("severity"), F.concat(F.lit(f"{scope}:"), "region").alias("scope"), "detail", "metric", "threshold", "sample_ids").orderBy("scope", "rule")


def output_audit(findings: DataFrame, qa: QaSpec = QaSpec(), sky: SkySpec = SkySpec(), county: str | None = None, weight: str | None = None) -> DataFrame:
    """All anomalies of a run with ``rule_order``: consistency, coverage and drift, tiles, counties."""
    parts = [consistency(findings, qa, sky), coverage(summary(findings), qa), regions(findings, "tile_id", "tile", None, qa)]
    if county:
        parts.append(regions(findings, county, "county", weight, qa))
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("rule_order", F.lit(i))
        out = p if out is None else out.unionByName(p)
    return out.orderBy("rule_order", "scope", "rule")


def verdict(anomalies: DataFrame) -> DataFrame:
    """Whether a review is needed, and whether anything is critical."""
    return anomalies.agg(F.count("*").alias("n_anomalies"), (F.count("*") > 0).alias("review_required"), F.coalesce(F.bool_or(F.col("severity") == "critical"), F.lit(False)).alias("has_critical"))

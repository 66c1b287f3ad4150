"""Quality rules as a learned decision list.

Text statistics of every document go through an ordered list of threshold conjunctions. The list is learned by sequential
covering: a rule is grown on two thirds of the labelled rows, condition by condition, for the largest information gain,
pruned on the other third, and the rows that it covers leave the pool. The list becomes one ordered Spark conditional.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, give_back, stored

SYMBOLS = b"#*$%&|<>"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics that rules may test, all of them shares or means, so that long and short texts compare.
FEATURES = ("mean_word", "symbol_rate", "dup_line_share", "repeat_share", "upper_share", "digit_share", "punct_rate", "bang_rate", "pipe_rate", "stop_rate", "distinct_share", "line_words")
_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], *[(c, pa.float64()) for c in FEATURES]])
#: Labelled rows, at most about so many, that a list is fitted on.
MAX_TRAIN = 20_000


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window which the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(index) == n:
        return 0
    codes = np.fromiter(map(index.__getitem__, words), np.int64, n)
    pairs = codes[:-1] * len(index) + codes[1:]
    if len(index) > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, back, counts = np.unique(pairs[:-1] * len(index) + codes[2:], return_inverse=True, return_counts=True)
    twice, covered = counts[back] > 1, np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def statistics(text: str | None) -> tuple:
    """The counts and features of one whole text, in the order of the schema."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(raw) - int(h[128:192].sum())
    blanks = int(h[9:14].sum() + h[32])
    symbols = int(sum(h[c] for c in SYMBOLS))
    upper, lower, digits, high = (int(h[a:b].sum()) for a, b in ((65, 91), (97, 123), (48, 58), (192, 256)))
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    dups, repeats, distinct = len(lines) - len(set(lines)), repeat_words(words), len(set(words))
    m, chars = max(n, 1), points - blanks
    punct = int(h[33:48].sum() + h[58:65].sum() + h[91:97].sum() + h[123:127].sum())
    counts = (n, chars, symbols, dups, repeats)
    return counts + (chars / m, symbols / m, dups / max(len(lines), 1), repeats / m, upper / max(upper + lower + high, 1), digits / max(chars, 1), punct / m, int(h[33]) / m, int(h[124]) / m, raw.count(b". ") / m, distinct / m, n / max(len(lines), 1))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id``, the counts and the features of every row, and all columns of the row as ``row`` if they are carried.

    Null and empty texts have no words, very long ones are read whole; other columns, of whatever name, are ignored.
    """
    fields = list(_SCHEMA)[1:]
    ddl = ", ".join([f"{c} long" for c in _COUNTS] + [f"{c} double" for c in FEATURES])

    @F.arrow_udf(f"struct<{ddl.replace(' ', ':')}>".replace(",:", ","))
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            columns = zip(*[statistics(v.as_py()) for v in batch], strict=True) if len(batch) else [[] for _ in fields]
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], fields=fields)
        give_back()

    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *row)
    return narrow.withColumn("s", of("text")).select("doc_id", "s.*", *(["row"] if carry else []))


Condition = tuple[str, str, float]  # statistic, "<=" or ">", threshold


def covers(rule: list[Condition], x: pd.DataFrame) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for name, op, at in rule:
        hit &= (x[name] <= at).to_numpy() if op == "<=" else (x[name] > at).to_numpy()
    return hit


def _best_condition(x: pd.DataFrame, bad: np.ndarray) -> tuple[float, Condition | None]:
    """The condition of the largest FOIL gain over the rows given."""
    p, n = int(bad.sum()), int((~bad).sum())
    base, best = math.log2(p / (p + n)), (0.0, None)
    for name in x.columns:
        order = np.argsort(x[name].to_numpy(), kind="stable")
        v, b = x[name].to_numpy()[order], bad[order]
        ends = np.flatnonzero(v[:-1] < v[1:])
        if not len(ends):
            continue
        pos, neg = np.cumsum(b)[ends], np.cumsum(~b)[ends]
        for op, q, m in (("<=", pos, neg), (">", p - pos, n - neg)):
            gain = q * (np.log2(np.maximum(q, 1e-9) / np.maximum(q + m, 1e-9)) - base)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                best = float(gain[k]), (name, op, float((v[ends[k]] + v[ends[k] + 1]) / 2))
    return best


def learn(x: pd.DataFrame, bad: np.ndarray, max_rules: int = 8, max_conditions: int = 4, min_precision: float = 0.97) -> list[list[Condition]]:
    """An ordered list of rules, each of which covers rows of the ``bad`` class with few others."""
    prune_set = np.arange(len(x)) % 3 == 2
    alive, rules = np.ones(len(x), bool), []
    while len(rules) < max_rules:
        grow, check = alive & ~prune_set, alive & prune_set
        if bad[grow].sum() < 3:
            break
        rule: list[Condition] = []
        while len(rule) < max_conditions:
            inside = grow & covers(rule, x)
            if not bad[inside].any() or bad[inside].all():
                break
            gain, condition = _best_condition(x[inside], bad[inside])
            if condition is None:
                break
            rule.append(condition)

        def worth(r: list[Condition], check=check) -> float:
            hit = check & covers(r, x)
            p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
            return (p - n) / (p + n) if p + n else 0.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = alive & covers(rule, x)
        if not rule or bad[hit].sum() < 4 or bad[hit].mean() < min_precision:
            break
        rules.append(rule)
        alive &= ~hit
    return rules


def expression(rules: list[list[Condition]]) -> Column:
    """True for rows that no rule rejects: one ordered Spark conditional."""
    out = None
    for rule in rules:
        test = F.lit(True)
        for name, op, at in rule:
            test &= (F.col(name) <= at) if op == "<=" else (F.col(name) > at)
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def base_failed() -> Column:
    """Under 50 words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit(stats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> list[list[Condition]]:
    """Learn a list from the rows of ``stats`` that ``labels`` marks, those apart whose crc32(doc_id) mod 3 is 1.

    The driver gets about ``max_train`` rows of statistics at most, those with the smallest hashed ids. Without labels of both
    classes the list is empty.
    """
    marked = labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    sample = stats.where(~base_failed() & (crc_mod("doc_id", 3) != 1)).join(marked, "doc_id")
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    if (n := sample.count()) > max_train:
        sample = sample.where(order < int((1 << 20) * max_train / n))
    sample = sample.select("quality", *FEATURES, order.alias("at"), "doc_id").toPandas().sort_values(["at", "doc_id"], ignore_index=True)
    bad = (sample["quality"] == 0).to_numpy()
    return learn(sample[list(FEATURES)], bad) if bad.any() and not bad.all() else []


def judge(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept``, then the features, for every row of ``docs``.

    A row is kept if the base rules pass it and no learned rule rejects it. Null and empty texts have no words and fail; very
    long ones are read whole; null ids stay null and carry no label; repeated rows are judged alike, a result row each; equal
    values of a statistic are never cut apart, and of conditions that gain the same the first statistic's stays; an empty
    table gives an empty result; without labels only the base rules judge; other columns, of whatever name, are ignored.
    """
    stats = stored(text_statistics(docs), "quality-stats")
    rules = fit(stats, labels, max_train)
    return stats.select("doc_id", *_COUNTS, base_failed().alias("base_failed"), (~base_failed() & expression(rules)).alias("kept"), *FEATURES)


def keep_good(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with their columns.

    Rows carry their columns along and are not found again by their ids, so null and repeated ids are judged row by row.
    """
    stats = stored(text_statistics(docs, carry=True), "quality-stats")
    rules = fit(stats, labels, max_train)
    return stats.where(~base_failed() & expression(rules)).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

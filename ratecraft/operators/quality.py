"""Data-quality rules: one report row per rule, and a gate that raises.

All rules of a rule set are counted in one pass over the input (with a
unique key, per key first and then summed). The report is tiny (one row per
rule), so ``enforce`` may collect it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.specs import RuleSet

REPORT_COLUMNS = ["dataset", "rule", "checked", "violations"]


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def out_of_range(column: str, minimum: float, maximum: float) -> Column:
    """Outside ``[minimum, maximum]``; a NULL value is not counted here."""
    return ~F.col(column).between(minimum, maximum)


def _num(x: float) -> str:
    return f"{x:g}"


def rule_names(rules: RuleSet) -> list[str]:
    names = []
    if rules.not_empty:
        names.append("not_empty")
    if rules.required:
        names.append(f"not_null({','.join(rules.required)})")
    names += [f"in_range({c},{_num(lo)},{_num(hi)})" for c, lo, hi in rules.ranges]
    names += [f"positive({c})" for c in rules.positive]
    if rules.unique_key:
        names.append(f"unique_key({','.join(rules.unique_key)})")
    return names


def _entry(dataset: str, rule: str, checked: Column, violations: Column) -> Column:
    return F.struct(
        F.lit(dataset).alias("dataset"),
        F.lit(rule).alias("rule"),
        checked.cast("bigint").alias("checked"),
        violations.cast("bigint").alias("violations"),
    )


def dq_report(df: DataFrame, rules: RuleSet) -> DataFrame:
    """``(dataset, rule, checked, violations)``, one row per rule, in one scan.

    Row rules are ``count_if`` counters. With a unique key they are counted
    per key first (one keyed aggregate that also yields the key
    multiplicities) and then summed, so the input is read once; a key
    holding a large share of the rows is combined map-side like any other.
    """
    names = iter(rule_names(rules))
    counters = {"rows": F.count(F.lit(1))}
    entries = []
    if rules.not_empty:
        entries.append((next(names), "rows", F.when(F.col("rows") == 0, 1).otherwise(0)))
    if rules.required:
        counters["v_null"] = F.count_if(any_null(rules.required))
        entries.append((next(names), "rows", F.col("v_null")))
    for i, (c, lo, hi) in enumerate(rules.ranges):
        counters[f"v_range{i}"] = F.count_if(out_of_range(c, lo, hi))
        entries.append((next(names), "rows", F.col(f"v_range{i}")))
    for i, c in enumerate(rules.positive):
        counters[f"v_pos{i}"] = F.count_if(F.col(c) <= 0)
        entries.append((next(names), "rows", F.col(f"v_pos{i}")))
    aggregates = [expr.alias(name) for name, expr in counters.items()]
    if rules.unique_key:
        per_key = df.groupBy(*rules.unique_key).agg(*aggregates)
        totals = per_key.agg(
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counters],
            F.count(F.lit(1)).alias("keys"),
            F.count_if(F.col("rows") > 1).alias("dup"),
        )
        entries.append((next(names), "keys", F.col("dup")))
    else:
        totals = df.agg(*aggregates)
    return totals.select(
        F.inline(F.array(*[_entry(rules.dataset, n, F.col(ch), v) for n, ch, v in entries]))
    )


def failures(report: DataFrame) -> list[str]:
    """Messages for the failing rules of a report (collects the small report)."""
    return [
        f"{r['dataset']}: rule {r['rule']} failed with {r['violations']} of {r['checked']}"
        for r in report.where(F.col("violations") > 0).collect()
    ]


def enforce(report: DataFrame) -> None:
    """Raise ``ValueError`` listing every failed rule; the job stops before writing."""
    failed = failures(report)
    if failed:
        raise ValueError("data-quality gate failed: " + "; ".join(failed))


def validate(df: DataFrame, rules: RuleSet) -> None:
    enforce(dq_report(df, rules))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n`` (HAVING count > 1)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def range_violations(df: DataFrame, column: str, minimum: float, maximum: float) -> DataFrame:
    """Rows whose value lies outside ``[minimum, maximum]`` (NULLs are not listed)."""
    return df.where(out_of_range(column, minimum, maximum))


def null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``columns``."""
    return df.where(any_null(columns))

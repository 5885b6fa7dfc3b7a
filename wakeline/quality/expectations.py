"""Data expectations: one result row per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``kind`` is not_null, accepted_values, is_true, not_constant, unique or unique_combination."""

    kind: str
    name: str
    columns: tuple[str, ...] = ()
    values: tuple[str, ...] = ()
    expression: str = ""
    severity: str = "error"


def not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", f"not_null_{c}", (c,)) for c in columns]


def unique(column: str) -> Rule:
    return Rule("unique", f"unique_{column}", (column,))


def unique_combination(*columns: str) -> Rule:
    return Rule("unique_combination", "unique_" + "_".join(columns), columns)


def accepted_values(column: str, *values: str) -> Rule:
    return Rule("accepted_values", f"accepted_values_{column}", (column,), values)


def not_constant(column: str) -> Rule:
    return Rule("not_constant", f"not_constant_{column}", (column,))


def is_true(name: str, expression: str, severity: str = "error") -> Rule:
    return Rule("is_true", name, expression=expression, severity=severity)


KEY_RULES = ("unique", "unique_combination", "not_constant")


def _fails(rule: Rule) -> Column:
    """Whether a row breaks a rule that looks at single rows. A null test passes."""
    if rule.kind == "not_null":
        return F.col(rule.columns[0]).isNull()
    if rule.kind == "accepted_values":
        return ~F.col(rule.columns[0]).isin(*rule.values)
    return ~F.expr(rule.expression)


def expect(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(name, kind, severity, failures, passed), from one pass over the rows.

    Grouping sets put the rows into one group for the rules about single rows, and into groups by the columns of each
    rule about keys; combined before the shuffle, and counted by set after it. A column is not constant if its set has
    two groups or more.
    """
    by_key = [r for r in rules if r.kind in KEY_RULES]
    by_row = [r for r in rules if r.kind not in KEY_RULES]
    columns = list(dict.fromkeys(c for r in by_key for c in r.columns))
    sets = list(dict.fromkeys([(), *[r.columns for r in by_key]]))

    def number(of: tuple[str, ...]) -> int:
        """What grouping_id() gives: a bit for each column that is not in the set, the last column's the lowest."""
        return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in of)

    counts = [F.count(F.lit(1)).alias("_n"), *[F.count_if(_fails(r)).alias(f"_r{i}") for i, r in enumerate(by_row)]]
    if columns:
        groups = df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(F.grouping_id().alias("_set"), *counts)
    else:
        groups = df.agg(*counts).withColumn("_set", F.lit(0))

    def failures(rule: Rule) -> Column:
        if rule in by_row:
            return F.coalesce(F.sum(F.when(F.col("_set") == number(()), F.col(f"_r{by_row.index(rule)}"))), F.lit(0))
        here = F.col("_set") == number(rule.columns)
        if rule.kind == "unique_combination":
            return F.count_if(here & (F.col("_n") > 1))
        own = here & F.col(rule.columns[0]).isNotNull()
        if rule.kind == "unique":
            return F.count_if(own & (F.col("_n") > 1))
        return F.when(F.count_if(own) > 1, 0).otherwise(1).cast("bigint")

    found = groups.agg(*[failures(r).alias(f"_f{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(r.name).alias("name"), F.lit(r.kind).alias("kind"), F.lit(r.severity).alias("severity"),
            F.col(f"_f{i}").alias("failures"),
        )
        for i, r in enumerate(rules)
    ]
    return found.select(F.inline(F.array(*rows))).withColumn("passed", F.col("failures") == 0)


def failed(results: DataFrame) -> DataFrame:
    """The rules that must stop a refresh: failed and not merely a warning."""
    return results.filter(~F.col("passed") & (F.col("severity") == "error"))

"""Decision lists: ordered rules, simultaneous relabelling, and several rule sets side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sure(cond: Column) -> Column:
    """Unknown counts as false, also under a negation."""
    return F.coalesce(cond, F.lit(False))


def decide(rules: list[tuple[Column, str]], default: str) -> Column:
    """The first rule that holds names the class."""
    out = None
    for cond, name in rules:
        out = F.when(sure(cond), F.lit(name)) if out is None else out.when(sure(cond), F.lit(name))
    return out.otherwise(F.lit(default))


def relabel(column: str, rules: list[tuple[Column, object, object]], keep: Column | None = None) -> Column:
    """Each (condition, from, to) tests the class as it came; the last that holds wins, kept rows never change."""
    out = F.col(column)
    for cond, old, new in rules:
        out = F.when(sure(cond) & (F.col(column) == F.lit(old)), F.lit(new)).otherwise(out)
    return out if keep is None else F.when(sure(keep), F.col(column)).otherwise(out)


def try_rule_sets(features: DataFrame, sets: dict[str, Column], keys: list[str]) -> DataFrame:
    """(keys, rule_set, class) for every named set of rules: one scan, one column a set, then unpivoted."""
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("rule_set"), column.alias("class")) for name, column in sets.items()])).alias("e")
    return features.select(*keys, pairs).select(*keys, "e.rule_set", "e.class")

"""Constraint checks that the target tables would otherwise enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import CONSTRAINTS, PROJECT, SOURCE, TAXON_ID


def violations(df: DataFrame, rules: list[tuple[str, bool, int | None]], keys: list[str]) -> DataFrame:
    """Rows that break a rule, with one line per broken rule.

    A rule is (column, may be null, longest text). The result has ``keys``, the
    column and the kind of violation (``null`` or ``length``).
    """
    checks = []
    for column, nullable, longest in rules:
        if not nullable:
            checks.append(F.when(F.col(column).isNull(), F.struct(F.lit(column).alias("column"), F.lit("null").alias("kind"))))
        if longest is not None:
            checks.append(
                F.when(
                    F.char_length(column) > longest,
                    F.struct(F.lit(column).alias("column"), F.lit("length").alias("kind")),
                )
            )
    broken = reduce(lambda a, b: a | b, [c.isNotNull() for c in checks])
    found = F.explode(F.filter(F.array(*checks), lambda c: c.isNotNull())).alias("_v")
    return df.filter(broken).select(*keys, found).select(*keys, "_v.column", "_v.kind")


def all_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Broken rules of the staged tables given by name, with the origin of each row."""
    origin = [SOURCE, TAXON_ID, PROJECT]
    found = [
        violations(df, CONSTRAINTS[name], origin).select(F.lit(name).alias("dataset"), *origin, "column", "kind")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, found)

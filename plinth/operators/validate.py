"""Integrity rules as tables of violations: ``(rule, table_name, id)``; a sound store gives no row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _found(rows: DataFrame, rule: str, table: str, ident: Column) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), ident.cast("string").alias("id"))


def foreign_key(child: DataFrame, column: str, parent: DataFrame, key: str, table: str, ident: str) -> DataFrame:
    """Rows whose reference is set but names no parent."""
    parents = parent.select(F.col(key).alias("_parent")).distinct()
    return _found(child.filter(F.col(column).isNotNull()).join(parents, F.col(column) == F.col("_parent"), "left_anti"), f"fk_{column}", table, F.col(ident))


def unique(rows: DataFrame, columns: list[str], table: str) -> DataFrame:
    """Keys that occur more than once; keys with a null part never clash."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    found = rows.filter(whole).groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1")
    return _found(found, f"unique_{'_'.join(columns)}", table, F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))


def check(rows: DataFrame, condition: Column, rule: str, table: str, ident: str) -> DataFrame:
    """Rows for which the condition is false; unknown is no violation, as in SQL."""
    return _found(rows.filter(~condition), f"check_{rule}", table, F.col(ident))


def not_null(rows: DataFrame, column: str, table: str, ident: str) -> DataFrame:
    return _found(rows.filter(F.col(column).isNull()), f"not_null_{column}", table, F.col(ident))


def rules(rows: DataFrame, broken: dict[str, Column], table: str, ident: str) -> DataFrame:
    """Many row rules in one pass: ``broken`` maps a rule's name to the condition of its violation."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in broken.items()]))
    return rows.select(F.explode(names).alias("rule"), F.lit(table).alias("table_name"), F.col(ident).cast("string").alias("id"))


def all_of(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)

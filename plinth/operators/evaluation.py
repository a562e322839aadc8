"""Retrieval-quality metrics over observed and expected results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def ranks(results: DataFrame, order: list[Column]) -> DataFrame:
    """Positions from 1 per case."""
    return results.withColumn("position", F.row_number().over(Window.partitionBy("case_id").orderBy(*order)))


def ranking(positions: DataFrame, relevant: DataFrame, cases: DataFrame, limit: int | Column, ks: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """First relevant position per case, hit@k (null where the limit, a number or a column of the cases, is below k) and
    reciprocal rank (0 for a miss)."""
    limit = F.lit(limit) if isinstance(limit, int) else limit
    first = positions.join(relevant, ["case_id", "result_id"], "left_semi").groupBy("case_id").agg(F.min("position").alias("first"))
    out = cases.join(first, "case_id", "left")
    hits = [F.when(limit >= k, F.coalesce(F.col("first") <= k, F.lit(False))).alias(f"hit_{k}") for k in ks]
    return out.select("case_id", "first", *hits, F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("reciprocal_rank"))


def mean_reciprocal_rank(ranked: DataFrame) -> DataFrame:
    return ranked.agg(F.avg("reciprocal_rank").alias("mrr"), F.count("reciprocal_rank").alias("ranked_case_count"))


def precision_recall(observed: DataFrame, expected: DataFrame, cases: DataFrame) -> DataFrame:
    """Per case: matched observed over observed, matched expected over expected; null where nothing was observed or
    expected."""
    o, e = observed.select("case_id", "result_id").distinct(), expected.select("case_id", "result_id").distinct()
    both = o.join(e, ["case_id", "result_id"], "left_semi").groupBy("case_id").agg(F.count("*").alias("matched"))
    out = cases.select("case_id").join(o.groupBy("case_id").agg(F.count("*").alias("observed")), "case_id", "left").join(e.groupBy("case_id").agg(F.count("*").alias("expected")), "case_id", "left").join(both, "case_id", "left").fillna(0)
    return out.select("case_id", "observed", "expected", "matched", F.try_divide("matched", "observed").alias("precision"), F.try_divide("matched", "expected").alias("recall"))


def field_state(expected: Column, observed: Column) -> Column:
    """``hit`` if any expected value was observed, ``miss`` if none, ``not_applicable`` if nothing is expected."""
    none = expected.isNull() | (F.size(expected) == 0)
    return F.when(none, "not_applicable").when(F.coalesce(F.arrays_overlap(expected, observed), F.lit(False)), "hit").otherwise("miss")

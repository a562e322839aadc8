"""Seeded order and running sums inside groups of any size.

A plain window over a group puts the group into one task. Here each group is cut by its seeded hash into buckets of
equal expected size; sums per bucket (combined before the shuffle) give each bucket its offset, and windows only run
inside one bucket of one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded_key(*cols: Column, seed: int) -> Column:
    """32 hex digits that order rows at random but for ever the same; SQL engines with md5 agree on it."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]).cast("binary"))


def bucket_of(key: Column, buckets: int) -> Column:
    """Buckets in key order, of equal expected size."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / float(1 << 32) * buckets).cast("bigint")


def running(rows: DataFrame, groups: list[str], bucket: str, order: list[str], value: Column, before: str, total: str) -> DataFrame:
    """Adds ``before``, the sum of ``value`` over earlier rows of the group, and ``total``, that of the whole group.

    ``bucket`` must follow the order inside a group; groups must not be null. Rows equal in all of ``order`` get
    consecutive places in any order.
    """
    rows = rows.withColumn("_value", value.cast("bigint"))
    parts = rows.groupBy(*groups, bucket).agg(F.sum("_value").alias("_part"))
    of = Window.partitionBy(*groups)
    parts = parts.withColumn(total, F.sum("_part").over(of))
    parts = parts.withColumn("_offset", F.coalesce(F.sum("_part").over(of.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_part")
    # dealt by bucket before the join, or a join by group alone would bring a large group into one task
    rows = rows.repartition(*[F.col(c) for c in (*groups, bucket)])
    inside = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(parts, [*groups, bucket])
    out = out.withColumn(before, F.col("_offset") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return out.drop("_value", "_offset")

"""Comparing and updating snapshots of a project's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare(previous: DataFrame, current: DataFrame, identity: str = "identity", sha: str = "source_sha256") -> DataFrame:
    """``(identity, state, previous_sha256, current_sha256)``: added, changed, removed or unchanged, in one join.

    A renamed document is one removed and one added; equal bytes at two paths are two documents.
    """
    a = previous.select(F.col(identity).alias("identity"), F.col(sha).alias("previous_sha256"))
    b = current.select(F.col(identity).alias("identity"), F.col(sha).alias("current_sha256"))
    state = F.when(F.col("previous_sha256").isNull(), "added").when(F.col("current_sha256").isNull(), "removed").when(F.col("previous_sha256") == F.col("current_sha256"), "unchanged").otherwise("changed")
    return a.join(b, "identity", "full_outer").select("identity", state.alias("state"), "previous_sha256", "current_sha256")


def update(previous: DataFrame, current: DataFrame, changes: DataFrame, identity: str = "identity") -> DataFrame:
    """The new snapshot: unchanged rows of ``previous``, added and changed rows of ``current``."""
    names = lambda *states: changes.filter(F.col("state").isin(*states)).select(F.col("identity").alias(identity))
    kept = previous.join(names("unchanged"), identity, "left_semi")
    return kept.unionByName(current.join(names("added", "changed"), identity, "left_semi"))


def duplicate_groups(documents: DataFrame, identity: str = "identity", sha: str = "source_sha256") -> DataFrame:
    """Identities that share their bytes: ``(sha, n, identities)``, members sorted."""
    found = documents.groupBy(F.col(sha).alias("sha")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(identity)).alias("identities"))
    return found.filter("n > 1")


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks; empty if both hold the same rows equally often."""
    cols = a.columns
    left = a.exceptAll(b.select(*cols)).withColumn("side", F.lit("left"))
    return left.unionByName(b.select(*cols).exceptAll(a).withColumn("side", F.lit("right")))


def page_counts(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages per document, zero for those without."""
    counts = pages.groupBy("document_id").agg(F.count("*").alias("n_pages"))
    return documents.select(F.col("id").alias("document_id")).join(counts, "document_id", "left").fillna(0, ["n_pages"])


def expired(names: DataFrame, today: str, days: int, name: str = "name") -> DataFrame:
    """Date-named folders older than ``days``; names that are no date are left alone."""
    day = F.when(F.col(name).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(F.try_to_timestamp(F.col(name))))
    return names.withColumn("age", F.datediff(F.lit(today).cast("date"), day)).filter(F.col("age") > days)

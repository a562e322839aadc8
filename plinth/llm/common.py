"""Shared pieces of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's checkpoint folder.

    Only where none is set and everything runs on one machine (tests) a temporary folder is set as such; on a cluster
    that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "plinth-checkpoints")
        spark.sparkContext.setCheckpointDir(found)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/plinth-{what}-{uuid.uuid4().hex}"


def saved(df: DataFrame, what: str) -> DataFrame:
    """Cuts lineage: writes to the shared folder and reads back."""
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.plinth_path = path
    return out


def forget(df: DataFrame) -> None:
    """Removes a table that :func:`saved` wrote, once all that was made from it is saved too."""
    delete(df.sparkSession, df.plinth_path)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a path on whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def hot_join(rows: DataFrame, table: DataFrame, keys: list[str], n: str, how: str = "inner", least: int = 4096) -> DataFrame:
    """``rows`` joined with a saved ``table``, whose ``keys`` are unique and whose column ``n`` has their rows.

    Keys with over 1/4096 of all rows number at most 4,096: their part of the table is broadcast, so that no task gets
    all rows of one; the others are joined as usual.
    """
    limit = max(least, (table.agg(F.sum(n)).first()[0] or 0) // 4096)
    hot = table.filter(F.col(n) > limit)
    if hot.isEmpty():
        return rows.join(table, keys, how)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(table.filter(F.col(n) <= limit), keys, how)
    return rows.join(F.broadcast(hot), keys).unionByName(rest)


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn labels from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def unit_hash(*cols: Column, seed: int) -> Column:
    """A seeded hash of the columns in [0, 1)."""
    return (F.xxhash64(F.lit(seed), *cols).bitwiseAND(F.lit((1 << 52) - 1)).cast("double")) / float(1 << 52)


def packed(docs: DataFrame) -> Column:
    """All columns of a caller's table as one struct: working columns beside it can have any name."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def row_key(id_col: str, text_col: str) -> Column:
    """Names a row by its id and text; null ids are ids like any other. Rows equal in both have the same key."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.hash(text_col).alias("g"))


def among(rows: DataFrame, keys: DataFrame, how: str, most_broadcast: int = 2_000_000) -> DataFrame:
    """``rows`` whose ``key`` (a struct) is among (``left_semi``) or not among (``left_anti``) distinct, saved ``keys(key)``.

    Up to ``most_broadcast`` keys are broadcast, so that texts stay where they are; more are joined by a shuffle.
    """
    return rows.join(F.broadcast(keys) if keys.count() <= most_broadcast else keys, "key", how)

"""Publishing checked stores: one at a time, by date, with the latest swapped in whole or not at all; and a cache of
stores by content."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from plinth.operators import incremental, integrity
from plinth.sources import files
from plinth.sources.store import Store, StoreError


def digests(spark: SparkSession, path: str, required: list[str]) -> dict[str, str]:
    """SHA-256 of the required files of a folder; a missing one is an error."""
    missing = [n for n in required if not files.exists(spark, f"{path}/{n}")]
    if missing:
        raise StoreError(f"missing files: {', '.join(sorted(missing))}")
    rows = spark.read.format("binaryFile").load([f"{path}/{n}" for n in required]).select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), F.sha2("content", 256).alias("sha"))
    return {r["name"]: r["sha"] for r in sorted(rows.collect())}


def recover(spark: SparkSession, root: str) -> bool:
    """Puts the latest store back that an interrupted publication had set aside; whether there was one."""
    if files.exists(spark, f"{root}/latest") or not files.exists(spark, f"{root}/.previous"):
        return False
    files.rename(spark, f"{root}/.previous", f"{root}/latest")
    return True


def open_latest(spark: SparkSession, root: str) -> Store:
    """The latest store, or the one set aside while or since a publication was interrupted between its two renames."""
    there = [n for n in ("latest", ".previous") if files.exists(spark, f"{root}/{n}")]
    if not there:
        raise StoreError(f"nothing is published below {root}")
    return Store.open(spark, f"{root}/{there[0]}")


class Lease:
    """The right to publish below a folder: a file with its owner and the time it was taken or renewed.

    A process that dies leaves its file behind; after ``stale_seconds`` without renewal the next one sets the file aside, which
    only one can, and takes the lease. An owner that was overtaken learns of it at its next renewal and stops.
    """

    def __init__(self, spark: SparkSession, root: str, stale_seconds: float) -> None:
        self.spark, self.path, self.stale, self.owner = spark, f"{root}/.lock", stale_seconds, uuid.uuid4().hex
        if not files.claim(spark, self.path):
            if time.time() - files.modified(spark, self.path) < stale_seconds:
                raise StoreError("another publication is running")
            try:
                files.rename(spark, self.path, f"{root}/.lock-{self.owner}")
            except OSError:
                raise StoreError("another publication is running") from None
            files.delete(spark, f"{root}/.lock-{self.owner}")
            if not files.claim(spark, self.path):
                raise StoreError("another publication is running")
        files.replace(spark, self.path, self.owner)

    def renew(self) -> None:
        if not files.exists(self.spark, self.path) or files.read(self.spark, self.path) != self.owner:
            raise StoreError("another publication took over")
        files.replace(self.spark, self.path, self.owner)

    def release(self) -> None:
        if files.exists(self.spark, self.path) and files.read(self.spark, self.path) == self.owner:
            files.delete(self.spark, self.path)


def publish(spark: SparkSession, staged: str, root: str, day: str, keep_days: int | None = None, stale_seconds: float = 6 * 3600) -> list[str]:
    """Makes the store at ``staged`` the latest below ``root`` and keeps a copy under its day; returns what retention
    removed.

    A second publication at the same time is refused, as is a store that breaks a rule. If anything fails after the old
    store was set aside, it is put back; if the process dies at any step, the next publication does that and goes on.
    ``stale_seconds`` must be more than the longest step (checking or copying a store) takes.
    """
    lease = Lease(spark, root, stale_seconds)
    try:
        recover(spark, root)
        bad = integrity.first(Store.open(spark, staged).violations())
        if bad:
            raise StoreError(f"{bad['rule']} in {bad['table_name']} at {bad['id']}")
        lease.renew()
        # a copy has its name only when it is whole
        files.delete(spark, f"{root}/.copy")
        files.copy(spark, staged, f"{root}/.copy")
        lease.renew()
        files.delete(spark, f"{root}/archive/{day}")
        files.move(spark, f"{root}/.copy", f"{root}/archive/{day}")
        files.delete(spark, f"{root}/.previous")
        aside = files.exists(spark, f"{root}/latest")
        if aside:
            files.rename(spark, f"{root}/latest", f"{root}/.previous")
        try:
            files.rename(spark, staged, f"{root}/latest")
            Store.open(spark, f"{root}/latest")
        except Exception:
            files.delete(spark, f"{root}/latest")
            if aside:
                files.rename(spark, f"{root}/.previous", f"{root}/latest")
            raise
        files.delete(spark, f"{root}/.previous")
        if keep_days is None:
            return []
        names = spark.createDataFrame([(n,) for n in files.names(spark, f"{root}/archive")], "name string")
        gone = sorted(r["name"] for r in incremental.expired(names, day, keep_days).collect())
        for name in gone:
            files.delete(spark, f"{root}/archive/{name}")
        return gone
    finally:
        lease.release()


def cached(spark: SparkSession, folder: str, key: str, build: Callable[[], Store]) -> Store:
    """The store kept under a content key, built and kept if there is none."""
    path = f"{folder}/{key}"
    if not files.exists(spark, f"{path}/manifest.json"):
        build().write(path)
    return Store.open(spark, path)

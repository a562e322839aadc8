"""Small files on whatever file system a path lies: through Hadoop, so that stores need no local disk."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, path).listStatus(_path(spark, path)))


def read(spark: SparkSession, path: str) -> str:
    """The text of a file of any name; Spark's readers pass over those that begin with a point."""
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace(spark: SparkSession, path: str, text: str) -> None:
    """Writes beside ``path`` and renames over it: readers see the old or the new text."""
    jvm, staged = spark._jvm, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    out = _system(spark, path).create(_path(spark, staged), True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_system(spark, path).getUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, staged), _path(spark, path), options)


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    if not _system(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"cannot rename {source} to {target}")


def move(spark: SparkSession, source: str, target: str) -> None:
    """A rename that makes the folders above its target."""
    _system(spark, target).mkdirs(_path(spark, target).getParent())
    rename(spark, source, target)


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 of a file's last change."""
    return _system(spark, path).getFileStatus(_path(spark, path)).getModificationTime() / 1000


def copy(spark: SparkSession, source: str, target: str) -> None:
    at = _system(spark, target)
    at.mkdirs(_path(spark, target).getParent())
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(_system(spark, source), _path(spark, source), at, _path(spark, target), False, spark._jsc.hadoopConfiguration())


def claim(spark: SparkSession, path: str) -> bool:
    """Creates an empty file; false if there is one."""
    at = _system(spark, path)
    at.mkdirs(_path(spark, path).getParent())
    return at.createNewFile(_path(spark, path))

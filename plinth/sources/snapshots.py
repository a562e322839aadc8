"""Record snapshots: JSON documents with all records of a project, read and checked by Spark, any number of them at once.

A snapshot is parsed once, as a variant; every collection becomes rows of its table by the types of the schema. What breaks the format is told as
rows, so that a folder of snapshots is judged in one job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.sources.schema import TABLES

#: Versions of the format (fixed values) and what a snapshot must hold.
VERSIONS = ("1", "1.0")
REQUIRED = ("snapshot_version", "project", "records")
_SQL = {"s": "string", "i": "bigint", "d": "double"}


def parsed(snapshots: DataFrame) -> DataFrame:
    """``(snapshot, doc)`` of ``snapshots(snapshot, text)``; the variant is null where the text is no JSON or names a key twice.

    The parser stops after one value, so the text is parsed as a list, which must have that one value and no more.
    """
    all_of = F.try_parse_json(F.concat(F.lit("["), "text", F.lit("]")))
    one = snapshots.select("snapshot", F.try_variant_get(all_of, "$", "array<variant>").alias("values"))
    return one.select("snapshot", F.when(F.size("values") == 1, F.get("values", F.lit(0))).alias("doc"))


def _keys(v: Column) -> Column:
    """Names of an object's fields; none for anything else."""
    return F.coalesce(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), F.array().cast("array<string>"))


def _entries(docs: DataFrame, name: str) -> DataFrame:
    """``(snapshot, i, r)``: the records of a collection with their places."""
    return docs.select("snapshot", F.posexplode(F.try_variant_get("doc", f"$.records.{name}", "array<variant>")).alias("i", "r"))


def _nested(name: str) -> dict[str, str]:
    """Columns that hold a nested field as JSON, by that field."""
    return {c.removesuffix("_json"): c for c in TABLES[name].names if c.endswith("_json")}


def _ends(r: Column) -> Column:
    """The places of a location record's geometry: its point, or both ends of its line."""
    at = lambda key: F.try_variant_get(r, f"$.geometry.{key}", "array<double>")
    return F.filter(F.array(*map(at, ("point", "coordinates", "start", "end"))), lambda p: p.isNotNull() & (F.size(p) == 3))


def table(docs: DataFrame, name: str) -> DataFrame:
    """``(snapshot, <columns of the table>)``: the records of one collection.

    Nested values become JSON with sorted keys and no spaces; geometry gets its bounds where the record states none. A value that cannot be of its
    column's type is null here and told by :func:`problems`.
    """
    rows, nested = _entries(docs, name), _nested(name)
    out = []
    for spec in TABLES[name].columns.split():
        column, kind = spec.split(":")
        value = F.try_variant_get("r", f"$.{column}", _SQL[kind[0]])
        field = next((k for k, c in nested.items() if c == column), None)
        if field is not None:
            inner = F.try_variant_get("r", f"$.{field}", "variant")
            value = F.coalesce(F.when(inner.isNotNull() & ~F.is_variant_null(inner), F.to_json(inner)), value)
        if name == "geometries" and column[:4] in ("min_", "max_"):
            value = F.coalesce(value, _bound(column))
        out.append(value.alias(column))
    return rows.select("snapshot", *out)


def _bound(column: str) -> Column:
    axis, pick = F.lit("xyz".index(column[4])), F.array_min if column[:3] == "min" else F.array_max
    return pick(F.transform(_ends(F.col("r")), lambda p: F.get(p, axis)))


def problems(docs: DataFrame) -> DataFrame:
    """``(snapshot, place, problem)`` for all that breaks the format: no JSON, missing parts, another version, strange collections and fields, values
    of another type."""
    doc, said = F.col("doc"), lambda rows, place, problem: rows.select("snapshot", place.alias("place"), problem.alias("problem"))
    out = [said(docs.filter(doc.isNull()), F.lit("$"), F.lit("not strict JSON"))]
    good = docs.filter(doc.isNotNull())
    missing = F.array_except(F.array(*map(F.lit, REQUIRED)), _keys(doc))
    out.append(said(good.select("snapshot", F.explode(missing).alias("k")), F.concat(F.lit("$."), "k"), F.lit("missing")))
    version = F.try_variant_get(doc, "$.snapshot_version", "string")
    out.append(said(good.filter(version.isNotNull() & ~version.isin(*VERSIONS)), F.lit("$.snapshot_version"), F.lit("unsupported")))
    strange = F.array_except(_keys(F.try_variant_get(doc, "$.records", "variant")), F.array(*map(F.lit, TABLES)))
    out.append(said(good.select("snapshot", F.explode(strange).alias("k")), F.concat(F.lit("$.records."), "k"), F.lit("unknown collection")))
    collections = good.select("snapshot", F.explode(F.try_variant_get(doc, "$.records", "map<string,variant>")).alias("collection", "list"))
    records = collections.select("snapshot", "collection", F.posexplode(F.try_variant_get("list", "$", "array<variant>")).alias("i", "r"))
    fields = records.select("snapshot", "collection", "i", F.explode(F.try_variant_get("r", "$", "map<string,variant>")).alias("field", "value"))
    known = [(name, c.split(":")[0], c.split(":")[1][0]) for name, spec in TABLES.items() for c in spec.columns.split()] + [(name, f, "n") for name in TABLES for f in _nested(name)]
    spec = docs.sparkSession.createDataFrame(known, "collection string, field string, kind string")  # as long as the schema
    told = fields.filter(F.col("collection").isin(list(TABLES))).join(F.broadcast(spec), ["collection", "field"], "left")
    fits = F.when(F.col("kind") == "n", True)
    for kind, sql in _SQL.items():
        fits = fits.when(F.col("kind") == kind, F.try_variant_get("value", "$", sql).isNotNull())
    place = F.concat(F.lit("$.records."), "collection", F.lit("["), F.col("i").cast("string"), F.lit("]."), "field")
    wrong = F.when(F.col("kind").isNull(), "unknown field").when(~F.is_variant_null("value") & ~fits, "another type")
    out.append(said(told.withColumn("wrong", wrong).filter("wrong is not null"), place, F.col("wrong")))
    return reduce(DataFrame.unionByName, out)

"""Knowledge stores as folders of Parquet tables with a manifest."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.text import is_sha256
from plinth.operators import integrity, pages, postings, validate
from plinth.sources import files, snapshots
from plinth.sources.schema import CAPABILITIES, TABLES

VERSION, REQUIRED_METADATA = 2, ("schema_version", "generator_version", "project_id", "created_from")


class StoreError(ValueError):
    """The store, bundle or snapshot breaks its contract."""


class Store:
    """A read-only set of tables; tables a store lacks are empty, and capabilities tell which it has."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame], metadata: Mapping[str, str] | None = None) -> None:
        unknown = set(tables) - set(TABLES)
        if unknown:
            raise StoreError(f"unknown tables: {sorted(unknown)}")
        self.spark, self.tables, self.metadata = spark, dict(tables), dict(metadata or {})
        #: The stored full-text index over ``search_content``, and how this store's content differs from it: (added, removed).
        self.index: postings.Index | None = None
        self.index_changes: tuple[DataFrame, DataFrame] | None = None

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Store:
        """Reads a store folder; only its manifest is read now."""
        manifest = "".join(r.value for r in spark.read.text(f"{path}/manifest.json", wholetext=True).collect())
        found = json.loads(manifest)
        missing = [k for k in REQUIRED_METADATA if k not in found["metadata"]]
        if missing or found["metadata"]["schema_version"] != str(VERSION):
            raise StoreError(f"unsupported manifest: missing {missing}, version {found['metadata'].get('schema_version')}")
        store = cls(spark, {t: spark.read.schema(TABLES[t].struct()).parquet(f"{path}/{found['snapshot']}/{t}") for t in found["tables"]}, found["metadata"])
        if found.get("index"):
            store.index = postings.Index(spark, f"{path}/index", tuple(found["index"]["segments"]), found["index"]["n"], found["index"]["total"])
        return store

    def table(self, name: str) -> DataFrame:
        return self.tables[name] if name in self.tables else self.spark.createDataFrame([], TABLES[name].struct())

    def has(self, capability: str) -> bool:
        """Whether all tables of a capability are there with all their columns."""
        return all(t in self.tables and set(TABLES[t].names) <= set(self.tables[t].columns) for t in CAPABILITIES[capability])

    def register(self, prefix: str = "") -> None:
        """Temporary views for SQL."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(prefix + name)

    def _indexed(self, path: str, most_segments: int = 8) -> postings.Index | None:
        """The index of this store's content below ``path``: the one there with a segment for what changed, or a new one."""
        if "search_content" not in self.tables:
            return None
        if self.index is None or self.index_changes is None or self.index.path != f"{path}/index":
            return postings.build(self.table("search_content"), f"{path}/index")
        index = postings.update(self.index, *self.index_changes)
        return postings.compact(index) if len(index.segments) > most_segments else index

    def write(self, path: str, check: bool = False, index: bool = False) -> None:
        """Writes a snapshot below ``path``, on any file system, and then points the manifest at it.

        A reader sees the old or the new one; the snapshot before stays for those that still read it, older ones go.
        With ``check`` a store that breaks a rule is refused and the old snapshot stays in place. With ``index`` the store gets a
        full-text index; a store that was updated from an indexed one keeps its index up, in one more segment.
        """
        snapshot = f"snapshot-{uuid.uuid4().hex}"
        was = json.loads(files.read(self.spark, f"{path}/manifest.json")) if files.exists(self.spark, f"{path}/manifest.json") else {}
        before = was.get("snapshot")
        for name, df in self.tables.items():
            df.select([F.col(c).cast(TABLES[name].struct()[c].dataType) for c in TABLES[name].names if c in df.columns]).write.parquet(f"{path}/{snapshot}/{name}")
        metadata = {"schema_version": str(VERSION), "generator_version": "plinth-1", "project_id": "project", "created_from": "records"} | self.metadata
        if check:
            written = Store(self.spark, {t: self.spark.read.schema(TABLES[t].struct()).parquet(f"{path}/{snapshot}/{t}") for t in self.tables}, metadata)
            bad = integrity.first(written.violations())
            if bad:
                files.delete(self.spark, f"{path}/{snapshot}")
                raise StoreError(f"{bad['rule']} in {bad['table_name']} at {bad['id']}")
        found = self._indexed(path) if index or self.index_changes is not None else None
        manifest = {"snapshot": snapshot, "tables": sorted(self.tables), "metadata": metadata} | ({"index": found.as_dict()} if found else {})
        files.replace(self.spark, f"{path}/manifest.json", json.dumps(manifest, sort_keys=True))
        for old in files.names(self.spark, path):
            if old.startswith("snapshot-") and old not in (snapshot, before):
                files.delete(self.spark, f"{path}/{old}")
        used = {s for m in (was, manifest) for s in m.get("index", {}).get("segments", [])}
        for old in files.names(self.spark, f"{path}/index"):
            if old not in used:
                files.delete(self.spark, f"{path}/index/{old}")

    def violations(self) -> DataFrame:
        """Every broken rule of the schema: required columns, keys, uniqueness, references, checks, hashes, grids."""
        parts = []
        for name in self.tables:
            table, spec = self.table(name), TABLES[name]
            ident = "_key"
            rows = table.withColumn(ident, F.concat_ws("|", *[F.col(k).cast("string") for k in spec.key]))
            broken = {f"not_null_{c}": F.col(c).isNull() for c in spec.required} | {f"check_{c}": ~F.expr(c) for c in spec.checks}
            parts.append(validate.rules(rows, broken, name, ident))
            parts += [validate.unique(rows, list(u), name) for u in (spec.key, *spec.unique)]
            for r in spec.references:
                column, target = r.split(">")
                parent, key = target.split(".")
                parts.append(validate.foreign_key(rows, column, self.table(parent), key, name, ident))
        if "pdf_table_cells" in self.tables:
            tables = self.table("pdf_tables").select(F.col("id").alias("table_id"), "row_count", "column_count")
            bad = pages.grid(self.table("pdf_table_cells"), tables).filter("not complete")
            parts.append(bad.select(F.lit("complete_grid").alias("rule"), F.lit("pdf_tables").alias("table_name"), F.col("table_id").alias("id")))
        if "spatial_boundary_segments" in self.tables:
            open_ = pages.loops(self.table("spatial_boundary_segments"), "boundary_id", "segment_index", ["start_x", "start_y", "start_z"], ["end_x", "end_y", "end_z"]).filter("not closed")
            parts.append(open_.select(F.lit("closed_loop").alias("rule"), F.lit("spatial_boundaries").alias("table_name"), F.col("boundary_id").alias("id")))
        return reduce(DataFrame.unionByName, parts)

    def breaches(self) -> DataFrame:
        """Every broken rule across records, beyond those of the schema."""
        return integrity.violations(self.table)


def _bounds(geometry: dict) -> dict:
    """Bounds of a point or line record."""
    ends = [geometry[k] for k in ("point", "coordinates", "start", "end") if isinstance(geometry.get(k), list) and len(geometry[k]) == 3]
    return {f"{m}_{c}": f(e[i] for e in ends) for i, c in enumerate("xyz") for m, f in (("min", min), ("max", max))} if ends else {}


def from_records(spark: SparkSession, records: Mapping[str, list[dict]], metadata: Mapping[str, str] | None = None) -> Store:
    """A store from a record bundle; nested values (geometry, transforms, positions) become JSON with sorted keys.

    Geometry records carry ``geometry`` and get their bounds if they lack them. Unknown tables or fields are errors.
    """
    tables = {}
    for name, rows in records.items():
        if name not in TABLES:
            raise StoreError(f"unknown collection: {name}")
        spec, out = TABLES[name], []
        for row in rows:
            row = dict(row)
            if name == "geometries" and isinstance(row.get("geometry"), dict):
                row = _bounds(row["geometry"]) | {k: v for k, v in row.items() if v is not None}
            for nested in [k for k, v in row.items() if isinstance(v, (dict, list)) and f"{k}_json" in spec.names]:
                row[f"{nested}_json"] = json.dumps(row.pop(nested), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
            extra = set(row) - set(spec.names)
            if extra:
                raise StoreError(f"{name}: unknown fields {sorted(extra)}")
            kinds = dict(c.split(":") for c in spec.columns.split())
            out.append(tuple(None if row.get(c) is None else float(row[c]) if kinds[c][0] == "d" else int(row[c]) if kinds[c][0] == "i" else str(row[c]) for c in spec.names))
        tables[name] = spark.createDataFrame(out, spec.struct())
    return Store(spark, tables, metadata)


def read_snapshot(spark: SparkSession, path: str) -> Store:
    """A store from a snapshot JSON file ``{snapshot_version, coordinate_system, unit, project, records}``; Spark parses it, and any breach of the
    format is an error."""
    docs = snapshots.parsed(spark.read.text(path, wholetext=True).select(F.lit(path).alias("snapshot"), F.col("value").alias("text")))
    bad = snapshots.problems(docs).orderBy("place", "problem").first() or (docs.isEmpty() and {"place": "$", "problem": "not strict JSON"})  # an empty file has no row
    if bad:
        raise StoreError(f"{bad['place']}: {bad['problem']}")
    about = docs.select(F.map_keys(F.try_variant_get("doc", "$.records", "map<string,variant>")).alias("names"), F.try_variant_get("doc", "$.project.project_id", "string").alias("project")).first()
    return Store(spark, {name: snapshots.table(docs, name).drop("snapshot") for name in about["names"]}, {"project_id": about["project"] or "project", "created_from": "snapshot"})


def text_records(documents: DataFrame) -> dict[str, DataFrame]:
    """Document, page, block, evidence and search rows of ``documents(identity, text)``: one page a document, one block
    a line, ids derived from identity and revision."""
    base = documents.select("identity", "text", F.sha2("text", 256).alias("sha"))
    ident = lambda kind, *parts: F.concat(F.lit(f"{kind}-"), F.substring(F.sha2(F.concat_ws("\u0000", *parts), 256), 1, 24))
    rows = base.withColumn("document_id", ident("doc", "identity"))
    docs = rows.select(F.col("document_id").alias("id"), "identity", F.col("identity").alias("title"), F.col("identity").alias("source_filename"), F.col("sha").alias("source_sha256"))
    page = rows.withColumn("page_id", ident("page", "identity", "sha", F.lit("1")))
    found = page.select(F.col("page_id").alias("id"), "document_id", F.lit(1).cast("long").alias("page_number"), F.lit(612.0).alias("width_points"), F.lit(792.0).alias("height_points"), F.lit(0).cast("long").alias("rotation"), F.lit("pdf_points_top_left").alias("coordinate_space"), F.lit("text").alias("provenance"))
    lines = page.select("document_id", "page_id", "identity", "sha", F.posexplode(F.filter(F.split("text", "\n"), lambda x: x != "")).alias("order_index", "text"))
    place = F.col("order_index").cast("string")
    lines = lines.withColumn("id", ident("block", "identity", "sha", place)).withColumn("evidence_id", ident("evidence", "identity", "sha", place))
    box = [F.lit(0.0).alias("x_min"), (F.col("order_index") * 12.0).alias("y_min"), F.lit(612.0).alias("x_max"), (F.col("order_index") * 12.0 + 12).alias("y_max"), F.lit("pdf_points_top_left").alias("coordinate_space")]
    blocks = lines.select("id", "page_id", F.col("order_index").cast("long").alias("order_index"), "text", *box, F.lit("text").alias("provenance"), "evidence_id")
    none = F.lit(None).cast("string")
    evidence = lines.select(F.col("evidence_id").alias("id"), "document_id", none.alias("sheet_id"), none.alias("view_id"), F.lit(1).cast("long").alias("pdf_page"), *box)
    content = lines.select(F.lit("pdf_text_block").alias("record_kind"), F.col("id").alias("record_id"), F.col("text").alias("content"))
    return {"documents": docs, "pdf_pages": found, "pdf_text_blocks": blocks, "evidence": evidence, "search_content": content}


def verify_sources(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Manifest entries ``(source_file, source_sha256)`` whose file in ``files(path, content)`` (as ``binaryFile`` reads
    them) is missing, differs, or whose stated hash is malformed; and paths that clash when case is ignored."""
    real = files.select(F.col("path").alias("_path"), F.sha2("content", 256).alias("real"))
    joined = manifest.join(real.withColumn("source_file", F.regexp_extract("_path", "[^/]+$", 0)), "source_file", "left")
    problem = F.when(~is_sha256(F.col("source_sha256")), "bad_sha256").when(F.col("real").isNull(), "missing").when(F.col("real") != F.col("source_sha256"), "stale")
    bad = joined.select("source_file", problem.alias("problem")).filter("problem is not null")
    twice = manifest.groupBy(F.lower("source_file").alias("source_file")).count().filter("count > 1").select("source_file", F.lit("case_clash").alias("problem"))
    return bad.unionByName(twice)

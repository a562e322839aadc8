"""Projects of documents: manifests, page sidecars, building and updating a store, Markdown pages and bundles."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.geometry import TABLE_SLACK
from plinth.functions.text import is_logical_path, is_sha256, text_status
from plinth.operators import incremental, integrity, pages
from plinth.sources import files
from plinth.sources.store import Store, StoreError

VERSIONS = ("1", "2")
SPACE, EMBEDDED, DERIVED = "pdf_points_top_left", "embedded_pdf_text", "derived_pdf_table"
_SPAN = "struct<order_index:bigint,text:string,bbox:array<double>,provenance:string,font_name:string,font_size:double,font_flags:bigint>"
_LINE = f"struct<order_index:bigint,text:string,bbox:array<double>,provenance:string,spans:array<{_SPAN}>>"
_BLOCK = f"struct<order_index:bigint,text:string,bbox:array<double>,provenance:string,lines:array<{_LINE}>>"
_CELL = "struct<row_index:bigint,column_index:bigint,row_span:bigint,column_span:bigint,bbox:array<double>,text:string,span_refs:array<struct<block_index:bigint,line_index:bigint,span_index:bigint>>>"
_TABLE = f"struct<order_index:bigint,bbox:array<double>,row_count:bigint,column_count:bigint,provenance:string,cells:array<{_CELL}>>"
_EXTRACTION = "struct<status:string,algorithm:string,algorithm_version:string,library:string,library_version:string,candidate_count:bigint,accepted_count:bigint,rejected_count:bigint,rejection_counts:map<string,bigint>>"
SIDECAR = f"document_id string, source_file string, source_sha256 string, page bigint, width_points double, height_points double, rotation bigint, media_box array<double>, crop_box array<double>, coordinate_space string, text_blocks array<{_BLOCK}>, table_extraction {_EXTRACTION}, tables array<{_TABLE}>"
MANIFEST = "document_id string, source_file string, source_sha256 string, knowledge_path string, page_count bigint, pipeline_version string"
_BOX = ("x_min", "y_min", "x_max", "y_max")


def created_from(version: str) -> str:
    if version not in VERSIONS:
        raise StoreError(f"pipeline version must be one of {', '.join(VERSIONS)}")
    return f"pdf-pipeline/{version}"


def marker(version: str) -> str:
    created_from(version)
    return f".pdf-pipeline-v{version}"


def document_id(identity: Column) -> Column:
    return F.concat(F.lit("doc-"), F.substring(F.sha2(identity, 256), 1, 24))


def _id(kind: str, *parts: str) -> Column:
    return F.concat(F.lit(f"{kind}-"), F.substring(F.sha2(F.concat_ws("\u0000", *[F.col(p).cast("string") for p in parts]), 256), 1, 24))


def read_manifest(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    """The head of a project manifest and its documents in order of their files."""
    data = json.loads(files.read(spark, path))
    if not isinstance(data, dict) or not isinstance(data.get("documents"), list):
        raise StoreError("a manifest is an object with a list of documents")
    created_from(str(data.get("pipeline_version")))
    names = [c.split()[0] for c in MANIFEST.split(", ")]
    rows = [tuple(d.get(n) for n in names) for d in data["documents"]]
    return {k: v for k, v in data.items() if k != "documents"}, spark.createDataFrame(rows, MANIFEST).orderBy("source_file")


def manifest_problems(manifest: DataFrame, project: str, version: str, sources: DataFrame | None = None) -> DataFrame:
    """``(rule, id)``: paths that are not canonical or leave the project, malformed hashes, versions that differ, ids that
    are not their file's, keys given twice (paths also by another case), and sources (``path``, ``sha``) missing or
    changed."""
    base = f"projects/{project}"
    broken = {
        "source_path": ~is_logical_path(F.col("source_file"), f"{base}/source/"), "knowledge_path": ~is_logical_path(F.col("knowledge_path"), f"{base}/knowledge/", ""), "sha256": ~is_sha256(F.col("source_sha256")),
        "version": ~F.col("pipeline_version").eqNullSafe(version), "document_id": ~F.col("document_id").eqNullSafe(document_id(F.col("source_file"))), "page_count": ~F.coalesce(F.col("page_count") >= 1, F.lit(False)),
    }
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in broken.items()]))
    parts = [manifest.select(F.explode(names).alias("rule"), F.col("source_file").alias("id"))]
    for key in ("document_id", "source_file", "knowledge_path"):
        folded = F.lower(key) if key != "document_id" else F.col(key)
        twice = manifest.groupBy(folded.alias("id")).agg(F.count("*").alias("n")).filter("n > 1")
        parts.append(twice.select(F.lit(f"{key}_twice").alias("rule"), "id"))
    if sources is not None:
        known = manifest.join(sources.select(F.col("path").alias("source_file"), F.col("sha").alias("real")), "source_file", "left")
        state = F.when(F.col("real").isNull(), "source_missing").when(F.col("real") != F.col("source_sha256"), "source_changed")
        parts.append(known.select(state.alias("rule"), F.col("source_file").alias("id")).filter("rule is not null"))
    return reduce(DataFrame.unionByName, parts)


def ingestion(manifest: DataFrame, sources: DataFrame, trees: DataFrame) -> DataFrame:
    """``(source_file, action)`` of an ingestion run: ``unchanged`` if bytes and version are the manifest's and its
    tree (``knowledge_path``, ``valid``) is whole, ``process`` otherwise, ``remove`` if the source is gone."""
    old = manifest.join(trees, "knowledge_path", "left").select("source_file", "source_sha256", F.coalesce("valid", F.lit(False)).alias("valid"))
    both = old.join(sources.select(F.col("path").alias("source_file"), "sha"), "source_file", "full_outer")
    same = (F.col("sha") == F.col("source_sha256")) & F.col("valid")
    return both.select("source_file", F.when(F.col("sha").isNull(), "remove").when(F.coalesce(same, F.lit(False)), "unchanged").otherwise("process").alias("action"))


def sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Page sidecars below ``path`` (globs allowed), one row a page."""
    return spark.read.schema(SIDECAR).option("multiLine", True).option("mode", "FAILFAST").json(path)


def _sound(box: Column, strict: bool = False) -> Column:
    low = (box[0] < box[2]) & (box[1] < box[3]) if strict else (box[0] <= box[2]) & (box[1] <= box[3])
    return F.coalesce((F.size(box) == 4) & F.forall(box, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & low, F.lit(False))


def _flat(pages_: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    keys = ["document_id", "source_file", "source_sha256", "page"]
    blocks = pages_.select(*keys, F.posexplode("text_blocks").alias("bi", "b"))
    lines = blocks.select(*keys, "bi", F.posexplode("b.lines").alias("li", "l"))
    return blocks, lines, lines.select(*keys, "bi", "li", F.posexplode("l.spans").alias("si", "s"))


def sidecar_problems(pages_: DataFrame, documents: DataFrame) -> DataFrame:
    """``(rule, id)`` over sidecars and their documents ``(document_id, source_file, source_sha256, page_count)``: identity,
    page numbers, coordinate space, boxes, provenance, numbering, and text that is not that of its parts. Tables:
    counts that do not add up, grids, boxes, references, and text that is not that of its spans."""
    at = lambda *parts: F.concat_ws("/", "document_id", *[F.col(p).cast("string") for p in parts])
    blocks, lines, spans = _flat(pages_)
    found = []

    def add(rows: DataFrame, broken: dict[str, Column], ident: Column) -> None:
        names = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in broken.items()]))
        found.append(rows.select(F.explode(names).alias("rule"), ident.alias("id")))

    known = documents.select(*[F.col(c).alias(f"d_{c}") for c in ("document_id", "source_file", "source_sha256", "page_count")])
    same = pages_.join(known, F.col("document_id") == F.col("d_document_id"), "left")
    other = ~F.col("source_file").eqNullSafe(F.col("d_source_file")) | ~F.col("source_sha256").eqNullSafe(F.col("d_source_sha256"))
    add(same, {"identity": other, "page": ~F.col("page").between(1, F.col("d_page_count")), "space": ~F.col("coordinate_space").eqNullSafe(SPACE), "media_box": ~_sound(F.col("media_box")), "crop_box": ~_sound(F.col("crop_box"))}, at("page"))
    counted = known.join(pages_.groupBy("document_id").agg(F.countDistinct("page").alias("n")), F.col("document_id") == F.col("d_document_id"), "left")
    found.append(counted.filter(~F.col("n").eqNullSafe(F.col("d_page_count"))).select(F.lit("page_count").alias("rule"), F.col("d_document_id").alias("id")))
    text = lambda parts, glue: F.array_join(F.transform(parts, lambda x: F.coalesce(x["text"], F.lit(""))), glue)
    for rows, c, i, parts, glue, ident in ((blocks, "b", "bi", "lines", "\n", at("page", "bi")), (lines, "l", "li", "spans", "", at("page", "bi", "li")), (spans, "s", "si", None, "", at("page", "bi", "li", "si"))):
        rules = {f"{c}_order": F.col(f"{c}.order_index") != F.col(i), f"{c}_box": ~_sound(F.col(f"{c}.bbox")), f"{c}_provenance": ~F.col(f"{c}.provenance").eqNullSafe(EMBEDDED)}
        add(rows, rules | ({f"{c}_text": F.col(f"{c}.text") != text(F.col(f"{c}.{parts}"), glue)} if parts else {}), ident)
    e, n = F.col("table_extraction"), F.coalesce(F.size("tables"), F.lit(0))
    rejected = F.coalesce(F.aggregate(F.map_values(e["rejection_counts"]), F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0))
    failed, none = e["status"] == "extraction_error", e["status"] == "no_candidates"
    add(pages_.filter("table_extraction is not null"), {
        "extraction_status": ~e["status"].isin("completed", "no_candidates", "extraction_error"), "extraction_counts": (e["candidate_count"] != e["accepted_count"] + e["rejected_count"]) | (e["accepted_count"] != n) | (~failed & (rejected != e["rejected_count"])),
        "extraction_empty": (failed | none) & ((e["candidate_count"] != 0) | (n != 0)), "extraction_none_found": (e["status"] == "completed") & (e["candidate_count"] < 1),
    }, at("page"))
    keys = ["document_id", "source_file", "source_sha256", "page"]
    tables = pages_.select(*keys, F.posexplode("tables").alias("ti", "t"))
    add(tables, {"table_order": F.col("t.order_index") != F.col("ti"), "table_box": ~_sound(F.col("t.bbox"), True), "table_provenance": ~F.col("t.provenance").eqNullSafe(DERIVED), "table_shape": (F.col("t.row_count") < 2) | (F.col("t.column_count") < 2) | (F.size("t.cells") != F.col("t.row_count") * F.col("t.column_count"))}, at("page", "ti"))
    cells = tables.select(*keys, "ti", "t", F.posexplode("t.cells").alias("ci", "c"))
    cb, tb = F.col("c.bbox"), F.col("t.bbox")
    inside = (cb[0] >= tb[0]) & (cb[1] >= tb[1]) & (cb[2] <= tb[2]) & (cb[3] <= tb[3])
    place = (F.col("c.row_index") != F.floor(F.col("ci") / F.col("t.column_count"))) | (F.col("c.column_index") != F.col("ci") % F.col("t.column_count"))
    add(cells, {"cell_place": place, "cell_span": (F.col("c.row_span") != 1) | (F.col("c.column_span") != 1), "cell_box": ~(_sound(cb, True) & inside)}, at("page", "ti", "ci"))
    refs = cells.select(*keys, "ti", "ci", "c", F.posexplode("c.span_refs").alias("k", "r"))
    named = refs.join(spans.select("document_id", "page", F.struct(F.col("bi").cast("bigint").alias("block_index"), F.col("li").cast("bigint").alias("line_index"), F.col("si").cast("bigint").alias("span_index")).alias("r"), "s"), ["document_id", "page", "r"], "left")
    sb, box = F.col("s.bbox"), F.col("c.bbox")
    held = (sb[0] >= box[0] - TABLE_SLACK) & (sb[1] >= box[1] - TABLE_SLACK) & (sb[2] <= box[2] + TABLE_SLACK) & (sb[3] <= box[3] + TABLE_SLACK)
    add(named, {"reference": F.coalesce(F.col("s.text"), F.lit("")) == "", "reference_box": F.col("s").isNotNull() & ~held}, at("page", "ti", "ci", "k"))
    ident = at("page", "ti", "ci")
    linked = named.select(ident.alias("cell"), "k", F.col("r").alias("source"), F.concat_ws("-", "r.block_index", "r.line_index").alias("line"), F.coalesce("s.text", F.lit("")).alias("text"))
    found.append(pages.out_of_order(linked, ["cell"], "k", ["source"]).select(F.lit("reference_order").alias("rule"), F.col("cell").alias("id")).distinct())
    built = pages.joined_lines(linked, "cell", "line", "k").withColumnRenamed("text", "built")
    wrong = cells.withColumn("cell", ident).join(built, "cell", "left").filter(F.coalesce("built", F.lit("")) != F.col("c.text"))
    found.append(wrong.select(F.lit("cell_text").alias("rule"), F.col("cell").alias("id")))
    return reduce(DataFrame.unionByName, found)


def records(pages_: DataFrame, documents: DataFrame, version: str) -> dict[str, DataFrame]:
    """Store tables of all documents at once; ids are derived from file, revision and place."""
    key = ["source_file", "source_sha256", "page"]
    blocks, lines, spans = _flat(pages_)
    box = lambda c: [F.col(f"{c}.bbox")[i].alias(n) for i, n in enumerate(_BOX)] + [F.lit(SPACE).alias("coordinate_space")]
    docs = documents.select(F.col("document_id").alias("id"), F.col("source_file").alias("identity"), F.element_at(F.split("source_file", "/"), -1).alias("title"), F.element_at(F.split("source_file", "/"), -1).alias("source_filename"), "source_sha256")
    page = pages_.select(
        _id("pdf-page", *key).alias("id"), "document_id", F.col("page").alias("page_number"), "width_points", "height_points", "rotation", *[F.col(f"{b}_box")[i].alias(f"{b}_{n}") for b in ("media", "crop") for i, n in enumerate(_BOX)],
        F.lit(SPACE).alias("coordinate_space"), F.lit(f"pdf_pipeline_v{version}").alias("provenance"),
    )
    b = blocks.withColumn("page_id", _id("pdf-page", *key)).withColumn("id", _id("pdf-block", *key, "bi")).withColumn("evidence_id", _id("evidence", *key, "bi"))
    b = b.select("id", "page_id", "document_id", F.col("page").alias("pdf_page"), F.col("bi").cast("bigint").alias("order_index"), "b.text", *box("b"), "b.provenance", "evidence_id")
    none = F.lit(None).cast("string")
    out = {
        "documents": docs, "pdf_pages": page, "pdf_text_blocks": b.drop("document_id", "pdf_page"),
        "evidence": b.select(F.col("evidence_id").alias("id"), "document_id", none.alias("sheet_id"), none.alias("view_id"), "pdf_page", *_BOX, "coordinate_space"),
        "search_content": b.filter("text <> ''").select(F.lit("pdf_text_block").alias("record_kind"), F.col("id").alias("record_id"), F.col("text").alias("content")),
        "pdf_text_lines": lines.select(_id("pdf-line", *key, "bi", "li").alias("id"), _id("pdf-block", *key, "bi").alias("block_id"), F.col("li").cast("bigint").alias("order_index"), "l.text", *box("l"), "l.provenance"),
        "pdf_text_spans": spans.select(_id("pdf-span", *key, "bi", "li", "si").alias("id"), _id("pdf-line", *key, "bi", "li").alias("line_id"), F.col("si").cast("bigint").alias("order_index"), "s.text", *box("s"), "s.provenance", "s.font_name", "s.font_size", "s.font_flags"),
    }
    if version == "1":
        return out
    tables = pages_.select(*key, "table_extraction", F.posexplode("tables").alias("ti", "t"))
    cells = tables.select(*key, "ti", F.explode("t.cells").alias("c")).withColumn("r", F.col("c.row_index")).withColumn("k", F.col("c.column_index"))
    refs = cells.select(*key, _id("pdf-cell", *key, "ti", "r", "k").alias("cell_id"), F.posexplode("c.span_refs").alias("order_index", "x")).select("*", *[F.col(f"x.{n}_index").alias(n) for n in ("block", "line", "span")])
    e = F.col("table_extraction")
    return out | {
        "pdf_tables": tables.select(_id("pdf-table", *key, "ti").alias("id"), _id("pdf-page", *key).alias("page_id"), F.col("ti").cast("bigint").alias("order_index"), "t.row_count", "t.column_count", *box("t"), "t.provenance", e["algorithm"].alias("detection_method"), e["algorithm_version"].alias("algorithm_version"), e["library"].alias("library"), e["library_version"].alias("library_version")),
        "pdf_table_cells": cells.select(_id("pdf-cell", *key, "ti", "r", "k").alias("id"), _id("pdf-table", *key, "ti").alias("table_id"), "c.row_index", "c.column_index", "c.row_span", "c.column_span", "c.text", *box("c"), F.lit(DERIVED).alias("provenance")),
        "pdf_table_cell_spans": refs.select("cell_id", _id("pdf-span", *key, "block", "line", "span").alias("span_id"), F.col("order_index").cast("bigint").alias("order_index")),
    }


def build(spark: SparkSession, pages_: DataFrame, documents: DataFrame, project: str, version: str) -> Store:
    """A store of a whole project in one job; refused with the first problem of its sidecars."""
    bad = integrity.first(sidecar_problems(pages_, documents))
    if bad:
        raise StoreError(f"{bad['rule']} at {bad['id']}")
    return Store(spark, records(pages_, documents, version), {"project_id": project, "created_from": created_from(version), "binding_mode": "project"})


#: How rows of a table are traced to their document: columns that lead from parent to parent.
_PARENTS = {"pdf_pages": ("document_id", "documents"), "evidence": ("document_id", "documents"), "pdf_text_blocks": ("page_id", "pdf_pages"), "pdf_text_lines": ("block_id", "pdf_text_blocks"), "pdf_text_spans": ("line_id", "pdf_text_lines"), "pdf_tables": ("page_id", "pdf_pages"), "pdf_table_cells": ("table_id", "pdf_tables"), "pdf_table_cell_spans": ("cell_id", "pdf_table_cells"), "search_content": ("record_id", "pdf_text_blocks")}


def eligible(base: Store, project: str, version: str) -> list[str]:
    """Why a store cannot be updated in place; empty if it can."""
    wanted = {"project_id": project, "created_from": created_from(version), "binding_mode": "project"}
    out = [f"metadata {k} is {base.metadata.get(k)}, not {v}" for k, v in wanted.items() if base.metadata.get(k) != v]
    out += [f"{t} has rows" for t in integrity.MODEL_TABLES if t in base.tables and not base.table(t).isEmpty()]
    strange = base.table("documents").filter(F.col("id") != document_id(F.col("identity")))
    bad = integrity.first(integrity.all_of([*integrity.cached_text(base.table), integrity._named(strange, "document_id", "documents")]))
    return out + ([f"{bad['rule']} at {bad['id']}"] if bad else [])


def update(base: Store, current: DataFrame, pages_of_changed: DataFrame, project: str, version: str) -> Store:
    """``base`` with changed and removed documents taken out and changed and new ones put in.

    ``current`` is the manifest, ``pages_of_changed`` the sidecars of documents that are new or changed. The result is
    what building the whole project anew would give, and a base that is up to date comes back as it is.
    """
    why = eligible(base, project, version)
    if why:
        raise StoreError(f"full rebuild required: {why[0]}")
    changes = incremental.compare(base.table("documents"), current.withColumnRenamed("source_file", "identity")).filter("state <> 'unchanged'")
    if changes.isEmpty():
        return base
    stale = base.table("documents").join(changes.filter("state <> 'added'").select("identity"), "identity", "left_semi").select("id")
    gone = {"documents": stale}
    tables = {"documents": base.table("documents").join(stale, "id", "left_anti")}
    for name, (column, parent) in _PARENTS.items():
        if name not in base.tables:
            continue
        dead = base.table(name).join(gone[parent].select(F.col("id").alias(column)), column, "left_semi")
        gone[name] = dead.select("id") if "id" in dead.columns else dead
        tables[name] = base.table(name).join(gone[parent].select(F.col("id").alias(column)), column, "left_anti")
    fresh = current.join(changes.filter("state <> 'removed'").select(F.col("identity").alias("source_file")), "source_file", "left_semi")
    more = build(base.spark, pages_of_changed, fresh, project, version)
    added = {n: more.table(n).select(*[c for c in t.columns if c in more.table(n).columns]) for n, t in base.tables.items() if n in tables}
    out = Store(base.spark, {n: t.select(*base.table(n).columns).unionByName(added[n], allowMissingColumns=True) for n, t in tables.items()}, base.metadata)
    if base.index is not None:
        removed = base.table("search_content").join(tables["search_content"], ["record_kind", "record_id"], "left_anti")
        out.index, out.index_changes = base.index, (added["search_content"], removed)
    return out


def markdown(pages_: DataFrame, version: str = "2") -> DataFrame:
    """``(path, text)``: a Markdown file per page with its head, and an index per document."""
    body = F.array_join(F.transform("text_blocks", lambda b: b["text"]), "\n\n")
    head = F.concat_ws("\n", F.lit("---"), F.concat(F.lit("document_id: "), "document_id"), F.concat(F.lit("source_file: "), "source_file"), F.concat(F.lit("source_sha256: "), "source_sha256"), F.concat(F.lit("page: "), F.col("page").cast("string")), F.concat(F.lit("pipeline_version: "), F.lit(version)), F.lit("---"), F.lit(""))
    name = F.concat(F.lit("pages/p"), F.lpad(F.col("page").cast("string"), 4, "0"), F.lit(".md"))
    rows = pages_.select("document_id", "source_file", "page", name.alias("name"), F.coalesce(body, F.lit("")).alias("body"), head.alias("head"))
    own = rows.select(F.concat_ws("/", "document_id", "name").alias("path"), F.concat("head", F.lit("\n"), F.when(F.col("body") != "", F.col("body")).otherwise("(no text on this page)"), F.lit("\n")).alias("text"))
    line = F.concat(F.lit("- [Page "), F.col("page").cast("string"), F.lit("]("), "name", F.lit("): "), text_status(F.col("body")))
    index = rows.groupBy("document_id", "source_file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", line.alias("line")))), lambda x: x["line"]), "\n").alias("lines"))
    return own.unionByName(index.select(F.concat("document_id", F.lit("/index.md")).alias("path"), F.concat(F.lit("# "), "source_file", F.lit("\n\n"), "lines", F.lit("\n")).alias("text")))


def bundle(store: Store, sources: DataFrame, path: str) -> None:
    """A store with a list of its sources ``(path, sha)``; refused if one is missing, changed or given twice."""
    listed = store.table("documents").select(F.col("identity").alias("source_file"), "source_sha256")
    twice = listed.groupBy(F.lower("source_file").alias("k")).count().filter("count > 1")
    known = listed.join(sources.select(F.col("path").alias("source_file"), "sha"), "source_file", "left")
    if not twice.isEmpty() or not known.filter("sha is null or sha <> source_sha256").isEmpty():
        raise StoreError("sources are missing, changed or given twice")
    store.write(path)
    files.replace(store.spark, f"{path}/bundle.json", json.dumps({"version": 1, "sources": [r.asDict() for r in listed.orderBy("source_file").collect()]}, sort_keys=True))


def bundle_problems(spark: SparkSession, path: str, sources: DataFrame) -> DataFrame:
    """``(source_file, problem)`` of a bundle against the sources ``(path, sha)`` and its own store."""
    stated = spark.createDataFrame([(s["source_file"], s["source_sha256"]) for s in json.loads(files.read(spark, f"{path}/bundle.json"))["sources"]], "source_file string, source_sha256 string")
    rows = stated.join(sources.select(F.col("path").alias("source_file"), "sha"), "source_file", "left").join(Store.open(spark, path).table("documents").select(F.col("identity").alias("source_file"), F.col("source_sha256").alias("stored")), "source_file", "left")
    problem = F.when(F.col("sha").isNull(), "missing").when(F.col("sha") != F.col("source_sha256"), "changed").when(~F.col("stored").eqNullSafe(F.col("source_sha256")), "not_in_store")
    return rows.select("source_file", problem.alias("problem")).filter("problem is not null")

"""Rules that records must fulfil across tables: ``(rule, table_name, id)`` per breach, none in a sound store.

Every rule is a filter over joins; nothing is checked row by row, and all breaches are found, not only the first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.geometry import TABLE_SLACK, decode_primitive
from plinth.functions.text import is_sha256
from plinth.operators import documents, pages, references, validate
from plinth.operators.entities import RESOLVED

Tables = Callable[[str], DataFrame]

#: Tables that bindings of a kind name, tables that need a host model, and what indexed geometry must use (fixed).
BINDING_TABLES = {"element": "elements", "element_type": "element_types", "space": "spaces", "level": "levels", "evidence": "evidence", "pdf_table_cell": "pdf_table_cells", "pdf_text_span": "pdf_text_spans"}
MODEL_TABLES = ("link_instances", "levels", "spaces", "element_types", "elements", "views", "sheets", "viewports", "parameters", "relationships", "annotations", "annotation_segments", "annotation_references", "entity_appearances", "spatial_boundaries", "spatial_boundary_segments", "geometries")
FRAME, UNIT, HOST_UNIT = "host_revit_internal_origin", "mm", "revit_internal"
#: Parent columns and index of the tables whose rows are numbered from 0 (fixed).
NUMBERED = {
    "pdf_text_blocks": (["page_id"], "order_index"), "pdf_text_lines": (["block_id"], "order_index"), "pdf_text_spans": (["line_id"], "order_index"), "pdf_tables": (["page_id"], "order_index"), "pdf_table_cell_spans": (["cell_id"], "order_index"),
    "annotation_segments": (["annotation_id"], "segment_index"), "annotation_references": (["annotation_id"], "reference_index"), "spatial_boundaries": (["space_id", "link_instance_id"], "loop_index"), "spatial_boundary_segments": (["boundary_id"], "segment_index"),
}
MEASURED = ("parameters", "semantic_properties", "annotations", "annotation_segments")


def _named(rows: DataFrame, rule: str, table: str, ident: str = "id") -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), F.col(ident).cast("string").alias("id"))


def all_of(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def models(t: Tables) -> list[DataFrame]:
    """Exactly one host model wherever a table needs one; links join a host to a link model by a sound transform."""
    role = lambda name: t("source_models").select(F.col("id").alias(f"{name}_model"), F.col("role").alias(f"{name}_role"))
    used = all_of([t(name).limit(1).select(F.lit(1).alias("k")) for name in (*MODEL_TABLES, "source_models")]).distinct()
    hosts = t("source_models").filter("role = 'host'").agg(F.count("*").alias("n"))
    parts = [_named(hosts.join(used).filter("n <> 1"), "one_host_model", "source_models", "n")]
    links = t("link_instances").join(role("host"), F.col("host_source_model_id") == F.col("host_model"), "left").join(role("link"), F.col("linked_source_model_id") == F.col("link_model"), "left")
    shape = F.from_json("transform_to_host_json", "struct<basis_x:array<double>,basis_y:array<double>,basis_z:array<double>,origin:array<double>,source_unit:string>")
    links = links.withColumn("shape", shape)
    three = lambda c: F.coalesce((F.size(f"shape.{c}") == 3) & F.forall(f"shape.{c}", lambda v: v.isNotNull()), F.lit(False))
    sound = (F.col("shape.source_unit") == HOST_UNIT) & three("basis_x") & three("basis_y") & three("basis_z") & three("origin")
    broken = {
        "link_host_role": ~F.col("host_role").eqNullSafe("host"), "link_linked_role": ~F.col("link_role").eqNullSafe("link"), "link_unique_id": ~F.coalesce("source_unique_id", F.lit("")).rlike(r"(?U)\S"), "link_transform": ~F.coalesce(sound, F.lit(False)),
    }
    return [*parts, validate.rules(links, broken, "link_instances", "id")]


def bindings(t: Tables) -> list[DataFrame]:
    """Resolved bindings name existing records; properties use bindings of their own entity; relations have a type."""
    solid = t("semantic_bindings").filter(F.col("resolution_state").isin(*RESOLVED))
    parts = []
    for kind, table in BINDING_TABLES.items():
        own = solid.filter(F.col("source_kind") == kind)
        parts.append(_named(own.join(t(table).select(F.col("id").alias("source_id")), "source_id", "left_anti"), f"binding_source_{kind}", "semantic_bindings"))
    owner = t("semantic_bindings").select(F.col("id").alias("source_binding_id"), F.col("semantic_entity_id").alias("owner"))
    parts.append(_named(t("semantic_properties").join(owner, "source_binding_id").filter("owner <> semantic_entity_id"), "property_binding_owner", "semantic_properties"))
    parts.append(_named(t("semantic_relationships").filter(~F.coalesce("relation_type", F.lit("")).rlike(r"(?U)\S")), "relation_type_blank", "semantic_relationships"))
    return parts


def values(t: Tables) -> list[DataFrame]:
    """Single records: identities, hashes, page sizes, boxes all or none and in order, units of numbers."""
    parts = [validate.rules(t("documents"), {"identity_blank": ~F.coalesce("identity", F.lit("")).rlike(r"(?U)\S"), "sha256": ~is_sha256(F.col("source_sha256"))}, "documents", "id")]
    size = {f"{c}_finite": ~F.coalesce((F.col(c) > 0) & (F.col(c) < float("inf")), F.lit(False)) for c in ("width_points", "height_points")}
    parts.append(validate.rules(t("pdf_pages"), size, "pdf_pages", "id"))
    box = ("x_min", "y_min", "x_max", "y_max")
    some, whole = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in box]), reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in box])
    order = F.coalesce((F.col("x_min") > F.col("x_max")) | (F.col("y_min") > F.col("y_max")), F.lit(False))
    for table in ("evidence", "entity_appearances"):
        parts.append(validate.rules(t(table), {"page_number": ~F.coalesce(F.col("pdf_page") >= 1, F.lit(False)), "bbox": some & (~whole | order)}, table, "id"))
    parts += [_named(t(table).filter("numeric_value is not null and coalesce(unit, '') = ''"), "number_without_unit", table) for table in MEASURED]
    return parts


def numbered(t: Tables) -> list[DataFrame]:
    """Rows of a parent are numbered from 0 without gaps."""
    parts = []
    for table, (parent, index) in NUMBERED.items():
        bad = pages.contiguity(t(table), parent, index).filter("not contiguous")
        parts.append(_named(bad.withColumn("parent", F.concat_ws("|", *[F.coalesce(F.col(p), F.lit("")) for p in parent])), "contiguous_order", table, "parent"))
    return parts


def geometry(t: Tables) -> list[DataFrame]:
    """Indexed geometry: frame and unit, well-formed locations, bounds that are numbers in order and enclose them, and
    link instances of the right model."""
    rows = t("geometries").withColumn("primitive", decode_primitive(F.col("geometry_type"), F.col("geometry_json")))
    located = F.col("geometry_type").isin("point", "line")
    finite = reduce(lambda a, b: a & b, [F.coalesce(~F.isnan(f"{m}_{c}") & (F.abs(f"{m}_{c}") < float("inf")), F.lit(False)) for c in "xyz" for m in ("min", "max")])
    outside = F.lit(False)
    for c in "xyz":
        low, high = F.least(F.col(f"primitive.s.{c}"), F.col(f"primitive.e.{c}")), F.greatest(F.col(f"primitive.s.{c}"), F.col(f"primitive.e.{c}"))
        outside = outside | (F.col(f"min_{c}") > F.col(f"max_{c}")) | (F.col(f"min_{c}") > low) | (F.col(f"max_{c}") < high)
    broken = {
        "geometry_frame": ~(F.col("coordinate_system").eqNullSafe(FRAME) & F.col("unit").eqNullSafe(UNIT)), "location_malformed": located & F.col("primitive").isNull(), "bounds_not_finite": located & ~finite,
        "bounds_do_not_enclose": located & F.col("primitive").isNotNull() & finite & outside,
    }
    return [validate.rules(rows, broken, "geometries", "id")]


def _link_models(rows: DataFrame, t: Tables, column: str = "link_instance_id") -> DataFrame:
    link = t("link_instances").select(F.col("id").alias("_link"), F.col("linked_source_model_id").alias("link_model"))
    return rows.join(link, F.col(column) == F.col("_link"), "left")


def links(t: Tables) -> list[DataFrame]:
    """Occurrences in a link belong to records of the linked model."""
    element = t("elements").select(F.col("id").alias("entity_id"), F.col("source_model_id").alias("model"), F.lit(True).alias("known"))
    space = t("spaces").select(F.col("id").alias("space_id"), F.col("source_model_id").alias("model"))
    differs = ~F.col("model").eqNullSafe(F.col("link_model"))
    placed = F.col("link_instance_id").isNotNull() & F.col("_link").isNotNull()
    parts = []
    g = _link_models(t("geometries").filter("entity_kind = 'element'").join(element, "entity_id"), t)
    parts.append(_named(g.filter(placed & differs), "geometry_link_model", "geometries"))
    a = _link_models(t("entity_appearances").join(element, "entity_id", "left"), t)
    parts.append(_named(a.filter(placed & ((F.col("entity_kind") != "element") | F.col("known").isNull() | differs)), "appearance_link_model", "entity_appearances"))
    r = _link_models(t("annotation_references"), t, "target_link_instance_id")
    named = F.col("target_source_model_id").isNotNull() & (F.coalesce("target_source_unique_id", F.lit("")) != "") & F.col("target_link_instance_id").isNotNull()
    broken = {"linked_reference_incomplete": (F.col("is_linked") == 1) & (F.col("resolution_state") == "resolved") & ~named, "reference_link_model": F.col("_link").isNotNull() & ~F.col("target_source_model_id").eqNullSafe(F.col("link_model"))}
    parts.append(validate.rules(r, broken, "annotation_references", "id"))
    b = _link_models(t("spatial_boundaries").join(space, "space_id"), t).join(t("source_models").select(F.col("id").alias("model"), "role"), "model", "left")
    broken = {"linked_space_without_link": F.col("link_instance_id").isNull() & F.col("role").eqNullSafe("link"), "boundary_link_model": F.col("_link").isNotNull() & differs}
    parts.append(validate.rules(b, broken, "spatial_boundaries", "id"))
    loops = t("spatial_boundaries").select(F.col("id").alias("boundary_id"), "space_id", F.col("link_instance_id").alias("loop_link"))
    s = _link_models(t("spatial_boundary_segments").join(loops, "boundary_id").join(space, "space_id", "left"), t, "source_link_instance_id")
    broken = {
        "segment_link": ~F.col("link_instance_id").eqNullSafe(F.col("loop_link")), "segment_source_incomplete": F.col("source_model_id").isNull() != F.col("source_unique_id").isNull(),
        "segment_source_model": F.col("source_link_instance_id").isNull() & F.col("source_model_id").isNotNull() & ~F.col("source_model_id").eqNullSafe(F.col("model")),
        "segment_source_link_model": F.col("_link").isNotNull() & ~F.col("source_model_id").eqNullSafe(F.col("link_model")),
    }
    return [*parts, validate.rules(s, broken, "spatial_boundary_segments", "id")]


def drawing_references(t: Tables) -> list[DataFrame]:
    found = references.violations(t("drawing_references"), t("evidence"), t("views"), t("sheets"), t("viewports"))
    return [found.select(F.concat(F.lit("reference_"), "rule").alias("rule"), F.lit("drawing_references").alias("table_name"), "id")]


def table_contents(t: Tables) -> list[DataFrame]:
    return [documents.problems(t("pdf_tables"), t("pdf_table_cells"), t("pdf_table_cell_spans"), t("pdf_text_spans"), t("pdf_text_lines"), t("pdf_text_blocks"), TABLE_SLACK)]


def cached_text(t: Tables) -> list[DataFrame]:
    """What a store of documents alone must fulfil before it is updated: every block that has text is searchable as it
    is and nothing else, evidence and blocks name each other once and agree, documents have pages."""
    content, blocks = t("search_content"), t("pdf_text_blocks")
    hit = content.alias("c").join(blocks.alias("b"), F.col("c.record_id") == F.col("b.id"), "left")
    odd = hit.filter(~F.col("c.record_kind").eqNullSafe("pdf_text_block") | F.col("b.id").isNull() | (F.col("b.text") == "") | (F.col("c.content") != F.col("b.text")))
    parts = [_named(odd.select(F.col("c.record_id").alias("id")), "search_content_odd", "search_content")]
    known = content.filter("record_kind = 'pdf_text_block'").select(F.col("record_id").alias("id"))
    parts.append(_named(blocks.filter("text <> ''").join(known, "id", "left_anti"), "search_content_missing", "pdf_text_blocks"))
    parts.append(_named(blocks.groupBy("evidence_id").agg(F.count("*").alias("n")).filter("n <> 1"), "evidence_of_several_blocks", "pdf_text_blocks", "evidence_id"))
    parts.append(_named(t("evidence").join(blocks.select(F.col("evidence_id").alias("id")), "id", "left_anti"), "evidence_without_block", "evidence"))
    p, e = t("pdf_pages").alias("p"), t("evidence").alias("e")
    both = blocks.alias("b").join(p, F.col("b.page_id") == F.col("p.id")).join(e, F.col("b.evidence_id") == F.col("e.id"))
    same = reduce(lambda a, b: a & b, [F.col(f"e.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("coordinate_space", "x_min", "y_min", "x_max", "y_max")])
    parts.append(_named(both.filter((F.col("e.document_id") != F.col("p.document_id")) | (F.col("e.pdf_page") != F.col("p.page_number")) | ~same).select("b.id"), "block_evidence_differs", "pdf_text_blocks"))
    parts.append(_named(t("documents").join(t("pdf_pages").select(F.col("document_id").alias("id")), "id", "left_anti"), "document_without_pages", "documents"))
    return parts


GROUPS = (models, bindings, values, numbered, geometry, links, drawing_references, table_contents)


def violations(t: Tables) -> DataFrame:
    """All breaches of all groups."""
    return all_of([part for group in GROUPS for part in group(t)])


def first(found: DataFrame) -> dict | None:
    """One breach or none; stops at the first it meets."""
    return next((r.asDict() for r in found.limit(1).collect()), None)


def columns(present: dict[str, list[str]], required: dict[str, list[str]]) -> list[tuple[str, str, str]]:
    """``(rule, table, name)``: required tables and columns that are missing, tables that are not known."""
    out = [("missing_table", t, t) for t in required if t not in present] + [("unknown_table", t, t) for t in present if t not in required]
    return out + [("missing_column", t, c) for t in required if t in present for c in required[t] if c not in present[t]]



"""Entities of four kinds, their facts, evidence, drawing occurrences and navigation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.text import contains_nocase

#: Kinds in the order in which lists show them.
KINDS = ("level", "space", "element_type", "element")
RESOLVED = ("exact", "resolved_deterministically")
STATES = ("exact", "resolved_deterministically", "ambiguous", "unresolved")


def entities(levels: DataFrame, spaces: DataFrame, element_types: DataFrame, elements: DataFrame) -> DataFrame:
    """One table of all kinds: ``kind``, ``kind_order`` and the columns of all four tables (null where a kind has none).
    A type's name is its ``type_name``."""
    tables = (levels, spaces, element_types.withColumn("name", F.col("type_name")), elements)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.withColumn("kind", F.lit(k)).withColumn("kind_order", F.lit(i)) for i, (k, t) in enumerate(zip(KINDS, tables, strict=True))])


def find_entities(everything: DataFrame, text: str, kind: str | None = None) -> DataFrame:
    """Entities whose name contains ``text``, whatever the case of A-Z; an empty text finds all."""
    if kind is not None and kind not in KINDS:
        raise ValueError(f"unknown entity kind: {kind}")
    rows = everything if kind is None else everything.filter(F.col("kind") == kind)
    return rows.filter(contains_nocase(F.col("name"), F.lit(text)))


def bbox(x0: str = "x_min", y0: str = "y_min", x1: str = "x_max", y1: str = "y_max") -> Column:
    """All four coordinates or null."""
    cols = [F.col(c) for c in (x0, y0, x1, y1)]
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), F.array(*cols))


def with_evidence(rows: DataFrame, evidence: DataFrame, documents: DataFrame, sheets: DataFrame, views: DataFrame) -> DataFrame:
    """Adds a struct ``evidence`` (document, page, box, sheet, view) by ``evidence_id``; null without evidence."""
    e = evidence.alias("e").join(documents.alias("d"), F.col("e.document_id") == F.col("d.id"))
    e = e.join(sheets.alias("s"), F.col("e.sheet_id") == F.col("s.id"), "left").join(views.alias("v"), F.col("e.view_id") == F.col("v.id"), "left")
    context = e.select(
        F.col("e.id").alias("_evidence"),
        F.struct(
            F.col("e.id").alias("id"), F.col("d.id").alias("document_id"), F.col("d.identity").alias("document_identity"), F.col("d.source_filename").alias("source_filename"),
            F.col("e.pdf_page").alias("pdf_page"), bbox("e.x_min", "e.y_min", "e.x_max", "e.y_max").alias("bbox"), F.col("e.sheet_id").alias("sheet_id"), F.col("s.number").alias("sheet_number"),
            F.col("e.view_id").alias("view_id"), F.col("v.name").alias("view_name"),
        ).alias("evidence"),
    )
    return rows.join(context, rows["evidence_id"] == F.col("_evidence"), "left").drop("_evidence")


def numeric_facts(parameters: DataFrame) -> DataFrame:
    """Parameters with a number, in order of entity, definition name and id when shown."""
    return parameters.filter(F.col("numeric_value").isNotNull())


def occurrences(appearances: DataFrame, viewports: DataFrame, sheets: DataFrame, views: DataFrame, documents: DataFrame) -> DataFrame:
    """Drawing occurrences with document, sheet and view.

    Sheet and view come from the appearance or, failing that, its viewport. The document is the first of those of the
    appearance's sheet, its view, the viewport's sheet and the viewport's view; a sheet or view of another document is
    left out, the raw ids stay as ``appearance_sheet_id`` and ``appearance_view_id``. Occurrences without a document
    go.
    """
    sheet = lambda n: sheets.select(*[F.col(c).alias(f"{n}_{c}") for c in ("id", "document_id", "number", "name")])
    view = lambda n: views.select(*[F.col(c).alias(f"{n}_{c}") for c in ("id", "document_id", "name")])
    # a viewport's sheet and view are found before the appearances, of which there are many more, are shuffled to it
    ports = viewports.select(F.col("id").alias("_port"), F.col("sheet_id").alias("_sheet"), F.col("view_id").alias("_view"))
    ports = ports.join(sheet("s2"), F.col("_sheet") == F.col("s2_id"), "left").join(view("v2"), F.col("_view") == F.col("v2_id"), "left").drop("_sheet", "_view")
    some = appearances.filter("viewport_id is not null").join(ports, F.col("viewport_id") == F.col("_port"), "left")
    # those without a viewport are not shuffled for it, and would all meet in one task
    a = some.unionByName(appearances.filter("viewport_id is null"), allowMissingColumns=True).alias("a")
    a = a.join(sheet("s1"), F.col("a.sheet_id") == F.col("s1_id"), "left").join(view("v1"), F.col("a.view_id") == F.col("v1_id"), "left")
    a = a.withColumn("_document", F.coalesce("s1_document_id", "v1_document_id", "s2_document_id", "v2_document_id"))
    a = a.join(documents.alias("d"), F.col("_document") == F.col("d.id"))

    def of(*names: str, col: str) -> Column:
        return reduce(lambda c, n: c.when(F.col(f"{n}_document_id") == F.col("_document"), F.col(f"{n}_{col}")), names[1:], F.when(F.col(f"{names[0]}_document_id") == F.col("_document"), F.col(f"{names[0]}_{col}")))

    return a.select(
        F.col("a.id").alias("appearance_id"), F.col("a.entity_kind").alias("entity_kind"), F.col("a.entity_id").alias("entity_id"), F.col("d.id").alias("document_id"), F.col("d.identity").alias("document_identity"),
        F.col("d.source_filename").alias("source_filename"), F.col("a.pdf_page").alias("pdf_page"), bbox("a.x_min", "a.y_min", "a.x_max", "a.y_max").alias("bbox"), F.col("a.bbox_quality").alias("bbox_quality"),
        F.col("a.appearance_kind").alias("appearance_kind"), F.col("a.link_instance_id").alias("link_instance_id"), F.col("a.sheet_id").alias("appearance_sheet_id"), F.col("a.view_id").alias("appearance_view_id"),
        of("s1", "s2", col="id").alias("sheet_id"), of("s1", "s2", col="number").alias("sheet_number"), of("v1", "v2", col="id").alias("view_id"), of("v1", "v2", col="name").alias("view_name"),
    )


def deduplicated(targets: DataFrame, place: list[str], source_id: str = "source_id") -> DataFrame:
    """One target per place, that of the smallest source id."""
    return targets.groupBy(*place).agg(F.min(source_id).alias(source_id))


def binding_states(bindings: DataFrame, key: str = "semantic_entity_id") -> DataFrame:
    """Counts per resolution state, zero where there is none, and sorted ids of those that are not resolved."""
    open_ = [F.array_sort(F.collect_list(F.when(F.col("resolution_state") == s, F.col("id")))).alias(f"{s}_ids") for s in ("ambiguous", "unresolved")]
    return bindings.groupBy(key).agg(*[F.count_if(F.col("resolution_state") == s).alias(f"n_{s}") for s in STATES], *open_)


def resolved_bindings(bindings: DataFrame) -> DataFrame:
    return bindings.filter(F.col("resolution_state").isin(*RESOLVED) & F.col("source_id").isNotNull())


def link_transforms(link_instances: DataFrame) -> DataFrame:
    """Link instances with their decoded transform."""
    shape = "struct<basis_x:array<double>,basis_y:array<double>,basis_z:array<double>,origin:array<double>,source_unit:string>"
    return link_instances.withColumn("transform_to_host", F.from_json("transform_to_host_json", shape)).drop("transform_to_host_json")


def segments_of(annotation_segments: DataFrame) -> DataFrame:
    """Annotation segments with decoded positions, to be shown by ``segment_index``."""
    out = annotation_segments
    for name in ("origin", "text_position"):
        out = out.withColumn(name, F.from_json(f"{name}_json", "array<double>")).drop(f"{name}_json")
    return out


def related_annotations(annotations: DataFrame, references: DataFrame, owners: DataFrame) -> DataFrame:
    """``(entity_id, annotation_id)``: annotations that name the entity or have a resolved reference to its source.

    ``owners(entity_id, source_model_id, source_unique_id)``; entities without a model match by name only.
    """
    named = annotations.select(F.col("related_entity_id").alias("entity_id"), F.col("id").alias("annotation_id")).filter("entity_id is not null").join(owners.select("entity_id"), "entity_id", "left_semi")
    hits = references.filter("resolution_state = 'resolved'").select("annotation_id", F.col("target_source_model_id").alias("source_model_id"), F.col("target_source_unique_id").alias("source_unique_id"))
    return named.unionByName(hits.join(owners, ["source_model_id", "source_unique_id"]).select("entity_id", "annotation_id")).distinct()

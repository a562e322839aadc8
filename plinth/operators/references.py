"""Explicit references between drawings: targets, reachability, rules, and how markers become references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.operators.documents import target
from plinth.operators.entities import RESOLVED, STATES

POINTERS = ("target_view_id", "target_sheet_id", "target_evidence_id")
#: Why the rows of a schedule are not taken as its members: first that applies (fixed names and order).
SCHEDULE_LIMITS = (
    ("filtered_by_sheet", "schedule_membership_filtered_by_sheet_unsupported"), ("split", "schedule_membership_split_unsupported"), ("key_schedule", "schedule_membership_key_schedule_unsupported"),
    ("include_linked_files", "schedule_membership_linked_files_unsupported"), ("material_takeoff", "schedule_membership_material_takeoff_unsupported"), ("has_embedded_schedule", "schedule_membership_embedded_schedule_unsupported"),
)


def targets(references: DataFrame, found_evidence: DataFrame, views: DataFrame, sheets: DataFrame, documents: DataFrame) -> DataFrame:
    """References with their source and, where resolved, their target, all at once.

    ``found_evidence`` is :func:`documents.evidence`. A target leads to its evidence or, failing that, to its sheet's
    page; references that are not resolved have no target.
    """
    r = references.alias("r")
    ev = lambda a: found_evidence.select(*[F.col(c).alias(f"{a}_{c}") for c in ("evidence_id", "document_identity", "pdf_page", "view_id", "bbox", "navigation")])
    rows = r.join(ev("s"), F.col("r.source_evidence_id") == F.col("s_evidence_id"), "left").join(ev("t"), F.col("r.target_evidence_id") == F.col("t_evidence_id"), "left")
    rows = rows.join(views.alias("v"), F.col("r.target_view_id") == F.col("v.id"), "left").join(sheets.alias("h"), F.col("r.target_sheet_id") == F.col("h.id"), "left").join(documents.alias("d"), F.col("h.document_id") == F.col("d.id"), "left")
    page = target(
        "drawing_reference_target", F.col("r.id"), document=F.struct("d.id", "d.identity", "d.source_filename"), pdf_page=F.col("h.pdf_page"), bbox=F.lit(None).cast("array<double>"),
        sheet_id=F.col("h.id"), sheet_number=F.col("h.number"), sheet_name=F.col("h.name"), view_id=F.col("v.id"), view_name=F.col("v.name"),
    )
    led = F.when(F.col("t_navigation").isNotNull(), F.col("t_navigation")).when(F.col("h.id").isNotNull(), page)
    solid = F.col("r.resolution_state").isin(*RESOLVED)
    chosen = F.struct(F.col("v.id").alias("view_id"), F.col("h.id").alias("sheet_id"), F.col("t_evidence_id").alias("evidence_id"), led.alias("navigation"))
    return rows.select(
        "r.id", "r.relation_type", "r.printed_reference", "r.resolution_state", "r.provenance", "r.source_evidence_id", F.col("s_document_identity").alias("document_identity"), F.col("s_pdf_page").alias("pdf_page"), F.col("s_view_id").alias("view_id"),
        F.col("s_bbox").alias("bbox"), F.col("s_navigation").alias("source_navigation"), F.when(solid, chosen).alias("target"),
    )


def reachable(references: DataFrame) -> DataFrame:
    """``(id)``: evidence that any reference names as its source or its target, each once."""
    return references.select(F.col("source_evidence_id").alias("id")).unionByName(references.select(F.col("target_evidence_id").alias("id"))).filter("id is not null").distinct()


def reachable_context(references: DataFrame, evidence: DataFrame, views: DataFrame, sheets: DataFrame) -> DataFrame:
    """``(kind, id)``: the evidence, views and sheets that references lead to, over pointers and over their evidence."""
    near = evidence.join(reachable(references), "id", "left_semi")
    parts = [near.select(F.lit("evidence").alias("kind"), "id")]
    for kind, table, pointer, own in (("view", views, "target_view_id", "view_id"), ("sheet", sheets, "target_sheet_id", "sheet_id")):
        names = references.select(F.col(pointer).alias("id")).unionByName(near.select(F.col(own).alias("id"))).distinct()
        parts.append(table.join(names, "id", "left_semi").select(F.lit(kind).alias("kind"), "id"))
    return reduce(DataFrame.unionByName, parts)


def violations(references: DataFrame, evidence: DataFrame, views: DataFrame, sheets: DataFrame, viewports: DataFrame) -> DataFrame:
    """``(rule, id)``: every rule a reference breaks, in one pass over joined pointers."""
    r = references.alias("r")
    ev = lambda a: evidence.select(*[F.col(c).alias(f"{a}_{c}") for c in ("id", "document_id", "pdf_page", "view_id", "sheet_id")])
    rows = r.join(ev("s"), F.col("r.source_evidence_id") == F.col("s_id"), "left").join(ev("t"), F.col("r.target_evidence_id") == F.col("t_id"), "left")
    rows = rows.join(views.select(F.col("id").alias("v_id"), F.col("document_id").alias("v_document_id")), F.col("r.target_view_id") == F.col("v_id"), "left")
    rows = rows.join(sheets.select(F.col("id").alias("h_id"), F.col("document_id").alias("h_document_id"), F.col("pdf_page").alias("h_pdf_page")), F.col("r.target_sheet_id") == F.col("h_id"), "left")
    placed = viewports.select(F.col("view_id").alias("p_view")).distinct()
    there = viewports.select(F.col("view_id").alias("q_view"), F.col("sheet_id").alias("q_sheet")).distinct()
    rows = rows.join(placed, F.col("r.target_view_id") == F.col("p_view"), "left").join(there, (F.col("r.target_view_id") == F.col("q_view")) & (F.col("r.target_sheet_id") == F.col("q_sheet")), "left")
    c = lambda name: F.col(f"r.{name}")
    any_target = c(POINTERS[0]).isNotNull() | c(POINTERS[1]).isNotNull() | c(POINTERS[2]).isNotNull()
    documents = F.array_compact(F.array("v_document_id", "h_document_id", "t_document_id"))
    bad_page = lambda p: F.col(p).isNull() | (F.col(p) < 1)
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    broken = {
        "relation_type_blank": ~F.coalesce(c("relation_type"), F.lit("")).rlike(r"(?U)\S"), "source_missing": F.col("s_id").isNull(), "source_page": F.col("s_id").isNotNull() & bad_page("s_pdf_page"),
        "state_unknown": ~F.coalesce(c("resolution_state").isin(*STATES), F.lit(False)), "resolved_without_target": c("resolution_state").isin(*RESOLVED) & ~any_target, "open_with_target": c("resolution_state").isin("ambiguous", "unresolved") & any_target,
        "view_missing": c(POINTERS[0]).isNotNull() & F.col("v_id").isNull(), "sheet_missing": c(POINTERS[1]).isNotNull() & F.col("h_id").isNull(), "evidence_missing": c(POINTERS[2]).isNotNull() & F.col("t_id").isNull(),
        "sheet_page": F.col("h_id").isNotNull() & bad_page("h_pdf_page"), "evidence_page": F.col("t_id").isNotNull() & bad_page("t_pdf_page"), "documents_differ": F.size(F.array_distinct(documents)) > 1,
        "evidence_view": both("t_id", "v_id") & F.col("t_view_id").isNotNull() & (F.col("t_view_id") != F.col("v_id")), "evidence_sheet": both("t_id", "h_id") & F.col("t_sheet_id").isNotNull() & (F.col("t_sheet_id") != F.col("h_id")),
        "evidence_sheet_page": both("t_id", "h_id") & ~F.col("t_pdf_page").eqNullSafe(F.col("h_pdf_page")), "not_placed_there": both("v_id", "h_id") & F.col("p_view").isNotNull() & F.col("q_view").isNull(),
    }
    names = F.array_compact(F.array(*[F.when(cond, F.lit(n)) for n, cond in broken.items()]))
    return rows.select(F.explode(names).alias("rule"), c("id").alias("id"))


def from_markers(markers: DataFrame, placements: DataFrame, views: DataFrame) -> DataFrame:
    """References of drawing markers: ``(id, relation_type, source_view_id, source_sheet_id, target_view_id,
    target_sheet_id, printed_reference, resolution_state)``, one per sheet that shows the marker's view.

    ``markers(marker_id, source_view_id, relation_type, target_view_id, printed_reference)``. A known target view makes
    the reference exact, any other leaves it unresolved; a target sheet is named only if the view is placed once.
    """
    shown = placements.select(F.col("view_id").alias("source_view_id"), F.col("sheet_id").alias("source_sheet_id")).distinct()
    once = placements.groupBy(F.col("view_id").alias("known")).agg(F.count("*").alias("n"), F.min("sheet_id").alias("only"))
    rows = markers.join(shown, "source_view_id").join(views.select(F.col("id").alias("target_view"), F.lit(True).alias("exists")), F.col("target_view_id") == F.col("target_view"), "left").join(once, F.col("target_view") == F.col("known"), "left")
    ident = F.concat(F.lit("reference-"), F.sha2(F.concat_ws("\u001f", "relation_type", "source_view_id", "marker_id", "source_sheet_id"), 256))
    return rows.select(
        ident.alias("id"), "relation_type", "source_view_id", "source_sheet_id", F.col("target_view").alias("target_view_id"), F.when(F.col("n") == 1, F.col("only")).alias("target_sheet_id"), "printed_reference",
        F.when(F.col("exists"), "exact").otherwise("unresolved").alias("resolution_state"),
    )


def schedule_limit(flags: dict[str, Column]) -> Column:
    """The first reason for which a schedule's rows are no members; null if they are."""
    return F.coalesce(*[F.when(flags[name], F.lit(code)) for name, code in SCHEDULE_LIMITS])


def schedule_appearances(schedules: DataFrame, members: DataFrame, placements: DataFrame) -> DataFrame:
    """Page-only appearances of the members of supported schedules, one per sheet a schedule is placed on.

    ``schedules(schedule_id, <six flags>)``, ``members(schedule_id, entity_kind, entity_id)``,
    ``placements(schedule_id, sheet_id, pdf_page)``.
    """
    good = schedules.filter(schedule_limit({n: F.col(n) for n, _ in SCHEDULE_LIMITS}).isNull()).select("schedule_id")
    rows = members.distinct().join(good, "schedule_id", "left_semi").join(placements.distinct(), "schedule_id")
    return rows.select("schedule_id", "sheet_id", "pdf_page", "entity_kind", "entity_id", F.lit("page_only").alias("bbox_quality"), F.lit("schedule").alias("appearance_kind"))

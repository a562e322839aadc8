"""Routing evidence to page regions for review, and planning the reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "pdf_points_top_left"


def surfaces(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """One candidate per (entity, document, page, scope, box) from occurrence and evidence rows.

    ``rows(entity_id, kind, id, document_id, pdf_page, x_min.., coordinate_space, bbox_quality, reason)``. Rows of
    unknown documents, bad pages, bad boxes or regions of another coordinate space go; they never become whole pages.
    The first row by kind and id supplies the quality.
    """
    cols = [F.col(c) for c in ("x_min", "y_min", "x_max", "y_max")]
    none = cols[0].isNull() & cols[1].isNull() & cols[2].isNull() & cols[3].isNull()
    good = (cols[0] < cols[2]) & (cols[1] < cols[3]) & ~F.isnan(cols[0]) & ~F.isnan(cols[2]) & ~F.isnan(cols[1]) & ~F.isnan(cols[3]) & (F.col("coordinate_space") == SPACE)
    kept = rows.filter((F.col("pdf_page") >= 1) & (none | F.coalesce(good, F.lit(False))))
    kept = kept.join(documents.select(F.col("id").alias("document_id"), "identity"), "document_id")
    kept = kept.withColumn("input_scope", F.when(none, "page").otherwise("region"))
    found = kept.groupBy("entity_id", "document_id", "identity", "pdf_page", "input_scope", "x_min", "y_min", "x_max", "y_max").agg(
        F.array_sort(F.collect_set(F.concat_ws(":", "kind", "id"))).alias("source_refs"), F.array_sort(F.collect_set("reason")).alias("routing_reasons"), F.min_by("bbox_quality", F.struct("kind", "id")).alias("bbox_quality"),
    )
    shown = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return found.withColumn("candidate_id", F.concat(F.lit("candidate-"), F.sha2(F.concat_ws("\u001f", "document_id", F.col("pdf_page").cast("string"), "input_scope", *shown), 256)))


def pages_of(candidates: DataFrame) -> DataFrame:
    """Candidates collapsed to pages, references merged."""
    return candidates.groupBy("entity_id", "document_id", "pdf_page").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("source_refs")))).alias("source_refs"))


def stages(candidates: DataFrame, focused: bool = False, resolved_references: bool = False) -> DataFrame:
    """Review jobs: regions get a look in context (V1), pages are skipped for it with a reason, and all get V3 unless a
    focused review has a resolved reference, which leaves V3 to regions."""
    region = F.col("input_scope") == "region"
    v1 = F.struct(F.lit("V1").alias("stage"), F.when(~region, "page_has_no_context_bbox").alias("skipped"))
    v3 = F.struct(F.lit("V3").alias("stage"), F.when(~region, "suppressed_by_resolved_reference").alias("skipped") if focused and resolved_references else F.lit(None).cast("string").alias("skipped"))
    return candidates.select("*", F.explode(F.array(v1, v3)).alias("job")).select("*", "job.stage", "job.skipped").drop("job")


def row_unions(cells: DataFrame) -> DataFrame:
    """Cells of one table row united to their enclosing box; rows with a cell that is inexact or protected stay apart.

    ``cells(document_id, pdf_page, table_id, row_index, id, x_min.., exact, protected)``.
    """
    whole = F.min(F.col("exact") & ~F.col("protected"))
    found = cells.groupBy("document_id", "pdf_page", "table_id", "row_index").agg(
        whole.alias("united"), F.count("*").alias("n"), F.min("x_min").alias("x_min"), F.min("y_min").alias("y_min"), F.max("x_max").alias("x_max"), F.max("y_max").alias("y_max"), F.array_sort(F.collect_list("id")).alias("ids")
    )
    return found.withColumn("united", F.col("united") & (F.col("n") > 1))

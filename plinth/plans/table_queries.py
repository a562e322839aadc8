"""Tables as semantic records over the star tables: every order is a table of its lines under three header spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plinth.operators import repair, tables
from plinth.sources.bridge import Bridge

QUERIES, ORACLES = {}, {}
SPEC = tables.Interpretation("lines", "orders", "line", ("Part", "Order"), kind="instance", scope="instance", label_column="Part", canonical_names={"Qty": "quantity"})


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def _parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Grids of order, part, quantity and status; one order in ten has each kind of doubtful header."""
    b = Bridge(spark, sf_dir)
    line = b.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus", "l_returnflag")
    # partitioned by the table's id, by which cells and headers are grouped later: these need no other shuffle
    line = line.select(F.col("l_orderkey").cast("string").alias("table_id"), "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("quantity"), (F.col("l_returnflag") == "R").alias("blank"), (F.col("l_linestatus") == "F").alias("flag"))
    order = Window.partitionBy("table_id").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    line = line.withColumn("r", F.row_number().over(order) - 1)
    key, text = F.col("l_orderkey"), F.col("table_id")
    place = lambda x0, y0, x1, y1: [F.lit(v).cast("double").alias(n) if not hasattr(v, "cast") else v.cast("double").alias(n) for n, v in zip(("x_min", "y_min", "x_max", "y_max"), (x0, y0, x1, y1), strict=True)] + [F.lit("pdf_points_top_left").alias("coordinate_space")]
    values = [text, F.when(F.col("blank"), " 　").otherwise(F.col("l_partkey").cast("string")), F.col("quantity").cast("string"), F.when(F.col("flag"), "F").otherwise("")]
    # texts are made after the columns, so that headers and grids read lines without them
    cells = line.withColumn("column_index", F.explode(F.array(*map(F.lit, range(4))))).select("table_id", F.col("r").alias("row_index"), "column_index", F.get(F.array(*values), F.col("column_index")).alias("text"))
    cells = cells.select(F.concat_ws("/", F.lit("cell"), "table_id", F.col("row_index").cast("string"), F.col("column_index").cast("string")).alias("id"), "table_id", "row_index", "column_index", "text", *place(F.col("column_index") * 100, F.col("row_index") * 20 + 100, F.col("column_index") * 100 + 100, F.col("row_index") * 20 + 120))
    grids = line.groupBy("table_id").agg(F.count("*").alias("n")).withColumn("l_orderkey", text.cast("bigint"))
    tables_ = grids.select(text.alias("id"), F.concat(F.lit("page-"), text).alias("page_id"), F.col("n").cast("int").alias("row_count"), F.lit(4).alias("column_count"), *place(0, 100, 400, F.col("n") * 20 + 100))
    one = grids.select("table_id", "l_orderkey")
    off = key % 10
    pages = one.select(F.concat(F.lit("page-"), text).alias("id"), F.lit("doc").alias("document_id"), F.lit(1).alias("page_number"), F.lit(600.0).alias("width_points"), F.lit(9000.0).alias("height_points"))
    names = F.posexplode(F.array(*map(F.lit, ("Order", "Part", "Qty", "Flag")))).alias("column_index", "source_name")
    heads = one.select("l_orderkey", "table_id", names).withColumn("header_span_id", F.concat_ws("/", F.lit("span"), "table_id", F.col("column_index").cast("string")))
    qty = F.col("column_index") == 2
    left, low = F.col("column_index") * 100 + F.when(qty & (off == 2), 70).otherwise(10), F.when(qty & (off == 3), 105).otherwise(90)
    spans = heads.filter(~(qty & (off == 5))).select(F.col("header_span_id").alias("id"), F.concat(F.lit("line-"), "table_id").alias("line_id"), F.when(qty & (off == 1), "Quantity").otherwise(F.col("source_name")).alias("text"), F.lit(tables.EMBEDDED).alias("provenance"), *place(left, 70, F.when(qty & (off == 6), left).otherwise(left + 50), low))
    around = place(0, 60, 500, 110)
    lines = one.select(F.concat(F.lit("line-"), text).alias("id"), F.concat(F.lit("block-"), text).alias("block_id"), F.lit(tables.EMBEDDED).alias("provenance"), *around)
    blocks = one.select(F.concat(F.lit("block-"), text).alias("id"), F.concat(F.lit("page-"), text).alias("page_id"), F.concat(F.lit("evidence-"), text).alias("evidence_id"), F.lit(tables.EMBEDDED).alias("provenance"), *around)
    evidence = one.select(F.concat(F.lit("evidence-"), text).alias("id"), F.lit("doc").alias("document_id"), F.when(off == 4, 2).otherwise(1).alias("pdf_page"), *around)
    documents = b.raw("region").filter("r_regionkey = 0").select(F.lit("doc").alias("id"))
    checked = tables.header_spans(heads.select("table_id", "source_name", "column_index", "header_span_id"), tables_, pages, documents, cells, spans, lines, blocks, evidence)
    return {"tables": tables_, "cells": cells, "headers": checked}


_PROBLEM = "CASE k % 10 WHEN 4 THEN 'other_page' WHEN 1 THEN 'other_text' WHEN 2 THEN 'outside_column' WHEN 3 THEN 'not_above_grid' WHEN 5 THEN 'missing_evidence' WHEN 6 THEN 'invalid_box' END"


@query("header_spans", f"""
SELECT CAST(k AS VARCHAR) AS table_id, c AS column_index, CASE WHEN c = 2 OR k % 10 = 4 THEN {_PROBLEM} END AS problem FROM (SELECT DISTINCT l_orderkey AS k, unnest([0, 1, 2, 3]) AS c FROM lineitem)""")
def header_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every header of every table, with the first reason why its span proves nothing."""
    return _parts(spark, sf_dir)["headers"].select("table_id", "column_index", "problem")


@query("table_projection", f"""
WITH l AS (SELECT l_orderkey AS k, l_partkey AS p, l_returnflag = 'R' AS blank, l_linestatus = 'F' AS flag, count(*) OVER (PARTITION BY l_orderkey, l_partkey, l_returnflag = 'R') AS n FROM lineitem),
t AS (SELECT k, {_PROBLEM} AS problem, count(*) AS n, count(*) FILTER (WHERE blank) AS errors, count(*) FILTER (WHERE NOT blank AND n > 1) AS ambiguous, count(*) FILTER (WHERE NOT blank AND n = 1) AS imported, count(*) FILTER (WHERE NOT blank AND n = 1 AND flag) AS flags FROM l GROUP BY k)
SELECT CAST(k AS VARCHAR) AS table_id, problem, CASE WHEN problem IS NULL THEN imported ELSE 0 END AS imported, CASE WHEN problem IS NULL THEN n - imported ELSE 0 END AS skipped, CASE WHEN problem IS NULL THEN ambiguous ELSE 0 END AS ambiguous, CASE WHEN problem IS NULL THEN errors ELSE 0 END AS errors,
CASE WHEN problem IS NULL THEN 6 * imported + 2 * flags ELSE 0 END AS bindings, CASE WHEN problem IS NULL THEN imported + flags ELSE 0 END AS properties FROM t""")
def table_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as entities: two key cells, the quantity and a flag if there is one, each bound with the span of its header."""
    p = _parts(spark, sf_dir)
    out = tables.project(SPEC, p["tables"], p["cells"], p["headers"])
    count = lambda name: out[name].groupBy("table_id").agg(F.count("*").alias(name))
    return out["report"].join(count("bindings"), "table_id", "left").join(count("properties"), "table_id", "left").fillna(0)


#: What the second extraction of an order's page does, by the order's number; all but the last speak against it.
_OUTCOMES = (
    "no_baseline_anchor", "multiple_baseline_anchors", "outer_bbox_changed", "dimensions_changed", "baseline_already_accepted", "baseline_not_repairable_overlap", "baseline_has_no_missing_cells", "widened_not_accepted_no_text",
    "widened_still_has_missing_cells", "existing_cell_geometry_changed", "table_source_span_set_changed", "preserved_source_assignment_changed", "eligible_monotonic_completion",
)


@query("table_repair", f"""
WITH r AS (SELECT o_orderkey AS k, [{", ".join(f"'{x}'" for x in _OUTCOMES)}][o_orderkey % 13 + 1] AS reason FROM orders)
SELECT CAST(k AS VARCHAR) AS page_id, CASE k % 13 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS anchors, reason = 'eligible_monotonic_completion' AS eligible, reason, CASE WHEN k % 13 > 1 THEN CASE WHEN k % 13 = 6 THEN 0 ELSE 1 END END AS missing_before,
CASE WHEN k % 13 = 8 THEN 1 WHEN k % 13 = 3 THEN 2 ELSE 0 END AS missing_after, CASE WHEN k % 13 IN (0, 1, 6, 8) THEN 0 ELSE 1 END AS repaired, CASE WHEN k % 13 IN (0, 1, 6, 8) THEN 0 ELSE 1 END AS newly_assigned FROM r""")
def table_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two by two cells without the last, extracted again in thirteen ways: one row for every outcome."""
    orders = Bridge(spark, sf_dir).raw("orders").select(F.col("o_orderkey").cast("string").alias("page_id"), (F.col("o_orderkey") % 13).alias("way"))
    is_ = lambda n, a, b: F.when(F.col("way") == n, a).otherwise(b)
    box = lambda x0, y0, x1, y1: F.struct(*[(v if hasattr(v, "cast") else F.lit(v)).cast("double").alias(n) for n, v in zip(("x_min", "y_min", "x_max", "y_max"), (x0, y0, x1, y1), strict=True)])
    flat = lambda rows, *cols: rows.select("page_id", *cols, "box.*")
    names = F.explode(is_(1, F.array(F.lit("b1"), F.lit("b2")), F.array(F.lit("b1"))))
    aside = is_(0, 500, 0)
    first = orders.withColumn("candidate", names).withColumn("box", box(aside, 0, aside + 100, 40))
    first = flat(first, "candidate", F.lit(2).alias("row_count"), F.lit(2).alias("column_count"), is_(4, True, False).alias("accepted"), is_(4, F.lit(None).cast("string"), is_(5, "overlap", repair.REPAIRABLE)).alias("rejection"))
    second = orders.withColumn("box", box(0, 0, F.lit(100) + is_(2, 5.0, is_(10, 0.2, 0.0)), 40))
    second = flat(second, F.lit("w").alias("candidate"), F.lit(2).alias("row_count"), is_(3, 3, 2).alias("column_count"), is_(7, False, True).alias("accepted"), is_(7, "no_text", F.lit(None).cast("string")).alias("rejection"))
    places = F.explode(F.array(*[F.struct(F.lit(r).alias("row"), F.lit(c).alias("column")) for r in range(2) for c in range(2)])).alias("at")
    grid = orders.select("page_id", "way", places).select("page_id", "way", "at.*")
    corner, origin = (F.col("row") == 1) & (F.col("column") == 1), (F.col("row") == 0) & (F.col("column") == 0)
    x, y = F.col("column") * 50, F.col("row") * 20
    before = grid.filter(~corner | (F.col("way") == 6)).withColumn("candidate", names).withColumn("box", box(x + aside, y, x + aside + 50, y + 20))
    moved = F.when(origin, is_(9, 5.0, is_(11, 0.1, 0.0))).otherwise(0.0)
    after = grid.filter(~corner | (F.col("way") != 8)).withColumn("box", box(x, y, x + 50 - moved, y + 20))
    spans = orders.select("page_id", "way", F.posexplode(F.array(box(5, 5, is_(11, 50.2, 45.0), 15), box(60, 25, 90, 35), F.when(F.col("way") == 10, box(99.8, 5, 140, 15)))).alias("i", "box")).filter("box is not null")
    out = repair.decisions(first, flat(before, "candidate", "row", "column"), second, flat(after, F.lit("w").alias("candidate"), "row", "column"), flat(spans, F.col("i").cast("string").alias("span_id")))
    return out.drop("candidate", "anchor")

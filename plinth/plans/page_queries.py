"""Page, table, snapshot, routing, evaluation and integrity queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plinth.functions import geometry
from plinth.functions.text import in_engine_units, is_logical_path, is_sha256, is_timestamp, local_date, text_status
from plinth.operators import evaluation, incremental, pages, routing, validate
from plinth.sources.bridge import Bridge

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


@query("grid_completeness", """
WITH t AS (SELECT l_orderkey AS k, max(l_linenumber) AS r FROM lineitem GROUP BY 1), c AS (SELECT l_orderkey AS k, count(*) AS n, count(DISTINCT l_linenumber) AS p FROM lineitem GROUP BY 1)
SELECT t.k AS table_id, t.r AS row_count, 1 AS column_count, c.n AS n, c.n = t.r AND c.p = t.r AS complete FROM t JOIN c ON t.k = c.k""")
def grid_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as one-column tables whose rows are line numbers."""
    line = Bridge(spark, sf_dir).raw("lineitem").select(F.col("l_orderkey").alias("table_id"), (F.col("l_linenumber") - 1).alias("row_index"), F.lit(0).alias("column_index"))
    tables = line.groupBy("table_id").agg((F.max("row_index") + 1).alias("row_count")).withColumn("column_count", F.lit(1))
    return pages.grid(line, tables)


@query("order_contiguity", """
SELECT conv_id, count(*) AS n, min(turn) AS first, max(turn) AS last, min(turn) = 0 AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS contiguous FROM conversations GROUP BY conv_id""")
def order_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.contiguity(Bridge(spark, sf_dir).raw("conversations"), ["conv_id"], "turn").drop("distinct")


@query("order_monotonic", """
WITH w AS (SELECT *, lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS p FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey FROM w WHERE p IS NOT NULL AND l_partkey <= p""")
def order_monotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose part does not come after that of the line before."""
    line = Bridge(spark, sf_dir).raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").withColumn("o", F.struct("l_linenumber", "l_partkey", "l_suppkey"))
    return pages.out_of_order(line, ["l_orderkey"], "o", ["l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("loop_closure", """
WITH s AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i, count(*) OVER (PARTITION BY l_orderkey) AS m FROM lineitem),
g AS (SELECT k, i, m, CASE WHEN i = 1 THEN 0 ELSE i END AS a, CASE WHEN i = m AND k % 3 <> 0 THEN 0 ELSE i + 1 END AS b FROM s),
n AS (SELECT *, coalesce(lead(a) OVER (PARTITION BY k ORDER BY i), first_value(a) OVER (PARTITION BY k ORDER BY i)) AS nx FROM g)
SELECT k, count(*) AS n, count(*) FILTER (WHERE b <> nx) AS broken, count(*) >= 3 AND count(*) FILTER (WHERE b <> nx) = 0 AS closed FROM n GROUP BY k""")
def loop_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as loops of their lines; those divisible by three end in the open."""
    w = Window.partitionBy("l_orderkey")
    s = Bridge(spark, sf_dir).raw("lineitem").select("l_orderkey", F.row_number().over(w.orderBy("l_linenumber", "l_partkey", "l_suppkey")).alias("i"), F.count("*").over(w).alias("m"))
    s = s.select(F.col("l_orderkey").alias("k"), "i", F.when(F.col("i") == 1, 0).otherwise(F.col("i")).alias("a"), F.when((F.col("i") == F.col("m")) & (F.col("l_orderkey") % 3 != 0), 0).otherwise(F.col("i") + 1).alias("b"))
    return pages.loops(s, "k", "i", ["a"], ["b"])


@query("page_status_rollup", r"""
WITH p AS (SELECT source, length(regexp_replace(text, '\s+$', '')) AS n FROM documents)
SELECT source, count(*) AS pages, count(*) FILTER (WHERE n = 0) AS no_text, count(*) FILTER (WHERE n > 0 AND n < 40) AS minimal_text, count(*) FILTER (WHERE n >= 40) AS extracted, CAST(sum(n) AS BIGINT) AS chars FROM p GROUP BY ROLLUP (source)""")
def page_status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Bridge(spark, sf_dir).raw("documents").select("source", text_status(F.col("text")).alias("status"), F.length(F.regexp_replace("text", r"(?U)\s+$", "")).alias("n"))
    counters = {"pages": F.count("*")} | {s: F.count_if(F.col("status") == s) for s in ("no_text", "minimal_text", "extracted")} | {"chars": F.sum("n").cast("bigint")}
    return pages.report(d, "source", counters)


@query("rejection_map_sum", """
WITH r(i, reason) AS (VALUES (0, 'insufficient_dimensions'), (1, 'invalid_shape'), (2, 'merged_or_missing_cell'), (3, 'invalid_cell_geometry'), (4, 'ambiguous_span_mapping'), (5, 'overlapping_candidate'), (6, 'extraction_error')),
e AS (SELECT event_id % 5 AS i, CAST(regexp_extract(props, '"k": *(\\d+)', 1) AS BIGINT) AS k FROM events)
SELECT r.reason, CAST(coalesce(sum(k), 0) AS BIGINT) AS n FROM r LEFT JOIN e ON r.i = e.i GROUP BY r.reason""")
def rejection_map_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Bridge(spark, sf_dir).raw("events").select("event_id", F.from_json("props", "struct<k:int>")["k"].alias("k"))
    reason = F.element_at(F.array(*[F.lit(r) for r in pages.REJECTIONS]), (F.col("event_id") % 5 + 1).cast("int"))
    return pages.rejection_counts(e.select(F.create_map(reason, F.col("k")).alias("counts")), "counts").withColumn("n", F.col("n").cast("bigint"))


@query("review_queue", r"""
WITH p AS (SELECT doc_id, length(regexp_replace(text, '\s+$', '')) AS n, doc_id % 11 = 0 AS img, (doc_id % 400) AS dr, doc_id % 13 = 0 AS rej, doc_id % 17 = 0 AS fail FROM documents),
q AS (SELECT doc_id, concat_ws(',', CASE WHEN n > 0 AND n < 40 THEN 'minimal_text' END, CASE WHEN n = 0 THEN 'no_text' END, CASE WHEN img THEN 'contains_raster_image' END, CASE WHEN dr >= 200 THEN 'many_vector_drawings' END, CASE WHEN n < 40 OR img OR dr >= 200 THEN 'vision_recommended' END, CASE WHEN rej THEN 'table_candidates_rejected' END, CASE WHEN fail THEN 'table_extraction_error' END) AS reasons FROM p)
SELECT doc_id, reasons FROM q WHERE reasons <> ''""")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Bridge(spark, sf_dir).raw("documents")
    chars, images, drawings = F.length(F.regexp_replace("text", r"(?U)\s+$", "")), (F.col("doc_id") % 11 == 0).cast("int"), F.col("doc_id") % 400
    reasons = pages.review_reasons(text_status(F.col("text")), images, drawings, pages.page_flags(chars, images, drawings), (F.col("doc_id") % 13 == 0).cast("int"), F.col("doc_id") % 17 == 0)
    return d.select("doc_id", reasons.alias("r")).filter(F.size("r") > 0).select("doc_id", F.array_join("r", ",").alias("reasons"))


@query("span_cell_containment", """
WITH s AS (SELECT l_orderkey AS t, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, CAST(l_quantity AS DOUBLE) AS x0, CAST(l_quantity AS DOUBLE) + 4 AS x1 FROM lineitem), c AS (SELECT DISTINCT l_orderkey AS t, unnest(range(0, 6)) AS i FROM lineitem),
b AS (SELECT t, i, i * 10.0 AS x0, i * 10.0 + 10 AS x1 FROM c),
p AS (SELECT s.t, s.id, b.i, s.x0 >= b.x0 - 0.25 AND s.x1 <= b.x1 + 0.25 AS inside FROM s JOIN b ON s.t = b.t WHERE (s.x0 >= b.x0 - 0.25 AND s.x1 <= b.x1 + 0.25) OR least(s.x1, b.x1) - greatest(s.x0, b.x0) > 0.25)
SELECT t AS table_id, id AS span_id, count(*) AS touched, count(*) FILTER (WHERE inside) AS containing, CASE WHEN count(*) FILTER (WHERE inside) = 1 THEN min(CASE WHEN inside THEN i END) END AS cell_id, count(*) FILTER (WHERE inside) = 1 AS mapped FROM p GROUP BY 1, 2""")
def span_cell_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as spans of width four over six cells of width ten."""
    line = Bridge(spark, sf_dir).raw("lineitem")
    y = [F.lit(0.0).alias("y_min"), F.lit(5.0).alias("y_max")]
    spans = line.select(F.col("l_orderkey").alias("table_id"), F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("id"), F.col("l_quantity").cast("double").alias("x_min"), (F.col("l_quantity") + 4).cast("double").alias("x_max"), *y)
    cells = line.select(F.col("l_orderkey").alias("table_id")).distinct().select("table_id", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("id")).select("table_id", F.col("id").cast("bigint").alias("id"), (F.col("id") * 10.0).alias("x_min"), (F.col("id") * 10.0 + 10).alias("x_max"), *y)
    return pages.spans_in_cells(spans, cells)


@query("table_acceptance", """
WITH RECURSIVE c AS (SELECT CAST(l_orderkey AS VARCHAR) AS page_id, l_linenumber || '-' || l_quantity AS candidate, l_linenumber = 3 AS narrow, CAST(l_quantity AS DOUBLE) AS x0 FROM lineitem),
sp AS (SELECT CAST(l_orderkey AS VARCHAR) AS page_id, l_quantity + 1.0 AS s0, l_quantity + 3.0 AS s1 FROM lineitem),
amb AS (SELECT page_id, candidate, x0 FROM (SELECT DISTINCT page_id, candidate, x0 FROM c) c WHERE EXISTS (SELECT 1 FROM sp WHERE sp.page_id = c.page_id AND least(x0 + 8, s1) - greatest(x0, s0) > 0.25
  AND (CASE WHEN s0 >= x0 - 0.25 AND s1 <= x0 + 4 + 0.25 THEN 1 ELSE 0 END + CASE WHEN s0 >= x0 + 4 - 0.25 AND s1 <= x0 + 8 + 0.25 THEN 1 ELSE 0 END) <> 1)),
o AS (SELECT c.*, row_number() OVER (PARTITION BY c.page_id ORDER BY c.x0, c.candidate, c.narrow) AS i, amb.x0 IS NOT NULL AS ambiguous FROM c LEFT JOIN amb ON c.page_id = amb.page_id AND c.candidate = amb.candidate AND c.x0 = amb.x0),
j AS (SELECT page_id, 0::BIGINT AS i, ''::VARCHAR AS candidate, -100.0::DOUBLE AS last, -1::BIGINT AS n, NULL::VARCHAR AS reason FROM (SELECT DISTINCT page_id FROM c)
  UNION ALL SELECT o.page_id, o.i, o.candidate, CASE WHEN r.reason IS NULL THEN o.x0 ELSE j.last END, CASE WHEN r.reason IS NULL THEN j.n + 1 ELSE j.n END, r.reason
  FROM j JOIN o ON o.page_id = j.page_id AND o.i = j.i + 1, LATERAL (SELECT CASE WHEN o.narrow THEN 'insufficient_dimensions' WHEN least(o.x0, j.last) + 8 - greatest(o.x0, j.last) > 0.25 THEN 'overlapping_candidate' WHEN o.ambiguous THEN 'ambiguous_span_mapping' END AS reason) r)
SELECT page_id, candidate, CASE WHEN reason IS NULL THEN n END AS order_index, reason FROM j WHERE i > 0""")
def table_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates from orders: judged in order, an overlap with one accepted before turns the later one down."""
    line = Bridge(spark, sf_dir).raw("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    box = [F.col("l_quantity").cast("double").alias("x_min"), F.lit(0.0).alias("y_min"), (F.col("l_quantity") + 8).cast("double").alias("x_max"), F.lit(8.0).alias("y_max")]
    base = line.select(F.col("l_orderkey").cast("string").alias("page_id"), F.concat_ws("-", F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("string")).alias("candidate"), F.lit(2).alias("row_count"), F.when(F.col("l_linenumber") == 3, 1).otherwise(2).alias("column_count"), *box)
    cell = lambda r, c: F.struct(F.lit(r).alias("row"), F.lit(c).alias("column"), (F.col("x_min") + 4 * c).alias("x0"), F.lit(4.0 * r).alias("y0"), (F.col("x_min") + 4 * c + 4).alias("x1"), F.lit(4.0 * r + 4).alias("y1"))
    candidates = base.withColumn("cells", F.array(cell(0, 0), cell(0, 1), cell(1, 0), cell(1, 1)))
    spans = line.select(F.col("l_orderkey").cast("string").alias("page_id"), (F.col("l_quantity") + 1).cast("double").alias("x_min"), F.lit(1.0).alias("y_min"), (F.col("l_quantity") + 3).cast("double").alias("x_max"), F.lit(3.0).alias("y_max"))
    return pages.accept_tables(candidates, spans)


_SNAPSHOT = """
WITH p AS (SELECT source || '/' || doc_id AS identity, sha256(text) AS sha FROM documents WHERE doc_id % 10 <> 0),
c AS (SELECT source || '/' || doc_id AS identity, sha256(CASE WHEN doc_id % 7 = 0 THEN text || '!' ELSE text END) AS sha FROM documents WHERE doc_id % 10 <> 1)"""


def _snapshots(b: Bridge) -> tuple[DataFrame, DataFrame]:
    d = b.raw("documents").select("doc_id", "source", "text")
    ident = F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("identity")
    now = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return d.filter("doc_id % 10 <> 0").select(ident, F.sha2("text", 256).alias("source_sha256")), d.filter("doc_id % 10 <> 1").select(ident, F.sha2(now, 256).alias("source_sha256"))


@query("snapshot_compare", _SNAPSHOT + """ SELECT coalesce(p.identity, c.identity) AS identity, CASE WHEN p.sha IS NULL THEN 'added' WHEN c.sha IS NULL THEN 'removed' WHEN p.sha = c.sha THEN 'unchanged' ELSE 'changed' END AS state, p.sha AS previous_sha256, c.sha AS current_sha256
FROM p FULL OUTER JOIN c ON p.identity = c.identity""")
def snapshot_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.compare(*_snapshots(Bridge(spark, sf_dir)))


@query("snapshot_update", _SNAPSHOT + " SELECT identity, sha AS source_sha256 FROM c")
def snapshot_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The updated snapshot is what a full rebuild gives."""
    previous, current = _snapshots(Bridge(spark, sf_dir))
    return incremental.update(previous, current, incremental.compare(previous, current)).select("identity", "source_sha256")


@query("snapshot_equality", _SNAPSHOT + """, s AS (SELECT identity, CASE WHEN identity LIKE 'src8/%' THEN 'stale' ELSE sha END AS sha FROM c)
SELECT c.identity, 'left' AS side FROM c JOIN s ON c.identity = s.identity WHERE c.sha <> s.sha UNION ALL SELECT s.identity, 'right' FROM c JOIN s ON c.identity = s.identity WHERE c.sha <> s.sha""")
def snapshot_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An updated snapshot against a manifest that is out of date for one source; all other rows are equal."""
    previous, current = _snapshots(Bridge(spark, sf_dir))
    updated = incremental.update(previous, current, incremental.compare(previous, current)).select("identity", "source_sha256")
    stale = current.withColumn("source_sha256", F.when(F.col("identity").startswith("src8/"), "stale").otherwise(F.col("source_sha256")))
    return incremental.differences(updated, stale).select("identity", "side")


@query("duplicate_groups", """
SELECT sha256(text) AS sha, count(*) AS n, string_agg(source || '/' || doc_id, ',' ORDER BY source || '/' || doc_id) AS identities FROM documents GROUP BY 1 HAVING count(*) > 1""")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.duplicate_groups(Bridge(spark, sf_dir).documents()).withColumn("identities", F.array_join("identities", ","))


@query("page_counts", "SELECT c_custkey AS document_id, count(o_orderkey) AS n_pages FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    return incremental.page_counts(b.raw("customer").select(F.col("c_custkey").alias("id")), b.raw("orders").select(F.col("o_custkey").alias("document_id")))


@query("retention", """
SELECT event_id, CAST(datediff('day', CAST(ts AS DATE), DATE '2024-01-20') AS INTEGER) AS age FROM events WHERE event_id % 2 = 0 AND datediff('day', CAST(ts AS DATE), DATE '2024-01-20') > 10""")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders named by date expire; every other one here has no date for a name."""
    e = Bridge(spark, sf_dir).raw("events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise("latest").alias("name"))
    return incremental.expired(e, "2024-01-20", 10).select("event_id", "age")


@query("foreign_keys", """
SELECT 'fk_l_orderkey' AS rule, 'lineitem' AS table_name, CAST(l_orderkey AS VARCHAR) AS id FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderkey % 97 <> 0)
UNION ALL SELECT 'fk_o_custkey', 'orders', CAST(o_orderkey AS VARCHAR) FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'fk_doc_id', 'labels', CAST(doc_id AS VARCHAR) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id AND d.lang = 'en')""")
def foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    return validate.all_of([
        validate.foreign_key(b.raw("lineitem"), "l_orderkey", b.raw("orders").filter("o_orderkey % 97 <> 0"), "o_orderkey", "lineitem", "l_orderkey"),
        validate.foreign_key(b.raw("orders"), "o_custkey", b.raw("customer"), "c_custkey", "orders", "o_orderkey"),
        validate.foreign_key(b.raw("labels"), "doc_id", b.raw("documents").filter("lang = 'en'"), "doc_id", "labels", "doc_id"),
    ])


@query("unique_keys", """
SELECT 'unique_l_orderkey_l_linenumber' AS rule, 'lineitem' AS table_name, l_orderkey || '|' || l_linenumber AS id FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'unique_p_name_half', 'part', p_name || '|' || h FROM (SELECT p_name, CASE WHEN p_size > 25 THEN p_size END AS h FROM part) WHERE h IS NOT NULL GROUP BY p_name, h HAVING count(*) > 1""")
def unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with a null part never clash."""
    b = Bridge(spark, sf_dir)
    half = b.raw("part").select("p_name", F.when(F.col("p_size") > 25, F.col("p_size")).alias("half"))
    return validate.unique(b.raw("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem").unionByName(validate.unique(half, ["p_name", "half"], "part"))


@query("checks", """
SELECT 'check_discount' AS rule, 'lineitem' AS table_name, CAST(l_orderkey AS VARCHAR) AS id FROM lineitem WHERE NOT (l_discount <= 0.08)
UNION ALL SELECT 'check_size', 'part', CAST(p_partkey AS VARCHAR) FROM part WHERE NOT (CASE WHEN p_size > 5 THEN p_size END < 45)""")
def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unknown condition is no violation."""
    b = Bridge(spark, sf_dir)
    size = F.when(F.col("p_size") > 5, F.col("p_size")) < 45
    return validate.check(b.raw("lineitem"), F.col("l_discount") <= 0.08, "discount", "lineitem", "l_orderkey").unionByName(validate.check(b.raw("part"), size, "size", "part", "p_partkey"))


@query("route_surfaces", """
WITH a AS (SELECT l_partkey % 100 AS e, 'order-' || (l_orderkey % 500) AS d, l_linenumber - 1 AS p, CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS DOUBLE) END AS x0, l_returnflag AS rf,
  'app-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id FROM lineitem WHERE l_linestatus = 'F' OR l_returnflag <> 'R')
SELECT CAST(e AS VARCHAR) AS entity_id, d AS document_id, p AS pdf_page, CASE WHEN x0 IS NULL THEN 'page' ELSE 'region' END AS input_scope, x0 AS x_min, count(DISTINCT id) AS n_refs, string_agg(DISTINCT 'drawing_occurrence:' || rf, ',' ORDER BY 'drawing_occurrence:' || rf) AS routing_reasons
FROM a WHERE p >= 1 AND d IN (SELECT 'order-' || o_orderkey FROM orders WHERE o_orderkey % 5 <> 0) GROUP BY 1, 2, 3, 4, 5""")
def route_surfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences routed to pages and regions; first pages, unknown documents and regions in another space go."""
    b = Bridge(spark, sf_dir)
    line = b.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    box = F.col("l_returnflag") != "N"
    rows = line.select(
        (F.col("l_partkey") % 100).cast("string").alias("entity_id"), F.lit("drawing_occurrence").alias("kind"), F.concat_ws("-", F.lit("app"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("id"),
        F.concat(F.lit("order-"), (F.col("l_orderkey") % 500).cast("string")).alias("document_id"), (F.col("l_linenumber") - 1).alias("pdf_page"), F.when(box, F.col("l_quantity").cast("double")).alias("x_min"), F.when(box, 0.0).alias("y_min"), F.when(box, F.col("l_quantity") + 5.0).alias("x_max"), F.when(box, 5.0).alias("y_max"),
        F.when((F.col("l_linestatus") == "F") | (F.col("l_returnflag") != "R"), routing.SPACE).otherwise("other").alias("coordinate_space"), F.lit("exact").alias("bbox_quality"), F.concat(F.lit("drawing_occurrence:"), "l_returnflag").alias("reason"),
    )
    docs = b.raw("orders").filter("o_orderkey % 5 <> 0").select(F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderkey").cast("string").alias("identity"))
    out = routing.surfaces(rows, docs)
    return out.select("entity_id", "document_id", "pdf_page", "input_scope", "x_min", F.size("source_refs").cast("bigint").alias("n_refs"), F.array_join("routing_reasons", ",").alias("routing_reasons"))


@query("row_union_bbox", """
SELECT l_orderkey AS document_id, l_linenumber % 2 AS row_index, bool_and(l_returnflag <> 'A') AND count(*) > 1 AS united, count(*) AS n, min(l_quantity) AS x_min, max(l_quantity + 3) AS x_max FROM lineitem GROUP BY 1, 2""")
def row_union_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = Bridge(spark, sf_dir).raw("lineitem")
    cells = line.select(F.col("l_orderkey").alias("document_id"), F.lit(1).alias("pdf_page"), F.col("l_orderkey").alias("table_id"), (F.col("l_linenumber") % 2).alias("row_index"), F.col("l_partkey").alias("id"), F.col("l_quantity").alias("x_min"), F.lit(0.0).alias("y_min"), (F.col("l_quantity") + 3).alias("x_max"), F.lit(1.0).alias("y_max"), (F.col("l_returnflag") != "A").alias("exact"), F.lit(False).alias("protected"))
    return routing.row_unions(cells).select("document_id", "row_index", "united", "n", "x_min", "x_max")


_EVAL = """
WITH c AS (SELECT item_id, lower(split_part(text, ' ', 2)) AS w FROM benchmark), r AS (SELECT c.item_id, d.doc_id, row_number() OVER (PARTITION BY c.item_id ORDER BY d.n_chars, d.doc_id) AS pos FROM c JOIN documents d ON contains(d.text, ' ' || c.w || ' ')),
rel AS (SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text))"""


def _evaluation(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each benchmark item asks for its second word; relevant documents hold its whole text."""
    b = Bridge(spark, sf_dir)
    docs = b.raw("documents").select("doc_id", "n_chars", "text")
    parts = F.split("item", " ")
    cases = b.raw("benchmark").select(F.col("item_id").alias("case_id"), F.col("text").alias("item")).withColumn("second", F.get(parts, F.lit(1)))
    cases = cases.withColumn("w", F.lower("second"))
    # a word with blanks on both sides is no end of a text cut at blanks
    inner = docs.select(F.col("doc_id").alias("result_id"), "n_chars", F.explode(F.array_distinct(F.expr("slice(split(text, ' '), 2, greatest(size(split(text, ' ')) - 2, 0))"))).alias("word"))
    found = inner.join(cases.select("case_id", F.col("w").alias("word")), "word").select("case_id", "result_id", "n_chars")
    # a text that holds an item of three words or more holds its second word so; shorter items are looked for in all texts
    whole = docs.select(F.col("doc_id").alias("result_id"), "text")
    long = cases.filter(F.size(parts) > 2).select("case_id", "item", F.col("second").alias("word"))
    likely = inner.select("word", "result_id").join(long.select("word", "case_id"), "word").select("case_id", "result_id")
    relevant = likely.join(whole, "result_id").join(long.select("case_id", "item"), "case_id").filter(F.col("text").contains(F.col("item"))).select("case_id", "result_id")
    short = cases.filter(F.size(parts) <= 2).select("case_id", "item")
    if not short.isEmpty():
        relevant = relevant.unionByName(whole.join(short, F.col("text").contains(F.col("item"))).select("case_id", "result_id"))
    return evaluation.ranks(found, [F.col("n_chars"), F.col("result_id")]), relevant, cases


@query("retrieval_metrics", _EVAL + """, f AS (SELECT r.item_id, min(pos) AS first FROM r JOIN rel ON r.item_id = rel.item_id AND r.doc_id = rel.doc_id GROUP BY 1)
SELECT c.item_id AS case_id, first, coalesce(first <= 1, false) AS hit_1, coalesce(first <= 5, false) AS hit_5, coalesce(first <= 10, false) AS hit_10, round(coalesce(1.0 / first, 0), 6) AS reciprocal_rank FROM c LEFT JOIN f ON c.item_id = f.item_id""")
def retrieval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked, relevant, cases = _evaluation(spark, sf_dir)
    return evaluation.ranking(ranked, relevant, cases, 10).withColumn("reciprocal_rank", F.round("reciprocal_rank", 6))


@query("mean_reciprocal_rank", _EVAL + """, f AS (SELECT r.item_id, min(pos) AS first FROM r JOIN rel ON r.item_id = rel.item_id AND r.doc_id = rel.doc_id GROUP BY 1)
SELECT round(avg(coalesce(1.0 / first, 0)), 6) AS mrr, count(*) AS ranked_case_count FROM c LEFT JOIN f ON c.item_id = f.item_id""")
def mean_reciprocal_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked, relevant, cases = _evaluation(spark, sf_dir)
    return evaluation.mean_reciprocal_rank(evaluation.ranking(ranked, relevant, cases, 5)).withColumn("mrr", F.round("mrr", 6))


@query("evidence_precision_recall", _EVAL + """, o AS (SELECT item_id, count(*) AS n FROM r GROUP BY 1), e AS (SELECT item_id, count(*) AS n FROM rel GROUP BY 1), m AS (SELECT r.item_id, count(*) AS n FROM r JOIN rel ON r.item_id = rel.item_id AND r.doc_id = rel.doc_id GROUP BY 1)
SELECT c.item_id AS case_id, coalesce(o.n, 0) AS observed, coalesce(e.n, 0) AS expected, coalesce(m.n, 0) AS matched, round(coalesce(m.n, 0) / nullif(coalesce(o.n, 0), 0), 6) AS precision, round(coalesce(m.n, 0) / nullif(coalesce(e.n, 0), 0), 6) AS recall
FROM c LEFT JOIN o ON c.item_id = o.item_id LEFT JOIN e ON c.item_id = e.item_id LEFT JOIN m ON c.item_id = m.item_id""")
def evidence_precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked, relevant, cases = _evaluation(spark, sf_dir)
    out = evaluation.precision_recall(ranked, relevant, cases)
    return out.withColumn("precision", F.round("precision", 6)).withColumn("recall", F.round("recall", 6))


@query("field_states", """
SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN 'not_applicable' WHEN count(*) FILTER (WHERE role = 'system') > 0 THEN 'hit' ELSE 'miss' END AS state FROM conversations GROUP BY conv_id""")
def field_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Bridge(spark, sf_dir).raw("conversations").groupBy("conv_id").agg(F.collect_set("role").alias("observed"))
    expected = F.when(F.col("conv_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("system"), F.lit("nobody")))
    return c.select("conv_id", evaluation.field_state(expected, F.col("observed")).alias("state"))


@query("page_geometry", """
WITH b AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_quantity * 10.0 AS x0, l_linenumber * 50.0 AS y0, l_quantity * 10.0 + 40 AS x1, l_linenumber * 50.0 + 20 AS y1 FROM lineitem)
SELECT k, n, p, s, greatest(x0 - 144, 0) AS gx0, greatest(y0 - 144, 0) AS gy0, least(x1 + 144, 612.0) AS gx1, least(y1 + 144, 792.0) AS gy1,
concat_ws(',', CASE WHEN x0 - 144 < 0 THEN 'left' END, CASE WHEN y0 - 144 < 0 THEN 'top' END, CASE WHEN x1 + 144 > 612 THEN 'right' END, CASE WHEN y1 + 144 > 792 THEN 'bottom' END) AS clamped FROM b""")
def page_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context boxes with a margin of 144 points on a letter page."""
    x0, y0 = F.col("l_quantity") * 10.0, F.col("l_linenumber") * 50.0
    box = geometry.context_box((x0, y0, x0 + 40, y0 + 20), F.lit(612.0), F.lit(792.0))
    line = Bridge(spark, sf_dir).raw("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), box.alias("c"))
    return line.select("k", "n", "p", "s", *[F.col("c.bbox")[i].alias(name) for i, name in enumerate(("gx0", "gy0", "gx1", "gy1"))], F.array_join("c.clamped", ",").alias("clamped"))


@query("value_scalars", r"""
SELECT event_id, CASE event_type WHEN 'click' THEN round(value * 304.8, 6) WHEN 'view' THEN round(value * 0.09290304, 6) WHEN 'purchase' THEN round(value * 57.29577951308232, 6) END AS numeric_value, CASE event_type WHEN 'click' THEN 'mm' WHEN 'view' THEN 'm2' WHEN 'purchase' THEN 'degrees' END AS unit,
strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS local_day, event_id % 3 <> 0 AS path_ok, event_id % 2 = 0 AS stamp_ok, event_id % 4 = 1 AS sha_ok FROM events""")
def value_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit normalization, local dates, path, time stamp and hash formats."""
    e = Bridge(spark, sf_dir).raw("events")
    kind = F.when(F.col("event_type") == "click", "length").when(F.col("event_type") == "view", "area").when(F.col("event_type") == "purchase", "angle").otherwise("text")
    value = in_engine_units(kind, F.col("value"))
    path = F.when(F.col("event_id") % 3 == 0, "pdf/../a.pdf").otherwise(F.concat(F.lit("pdf/"), F.col("event_id").cast("string"), F.lit(".PDF")))
    stamp = F.when(F.col("event_id") % 2 == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00"))).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
    return e.select("event_id", F.round(value["value"], 6).alias("numeric_value"), value["unit"].alias("unit"), local_date(F.col("ts").cast("timestamp"), "Asia/Tokyo").cast("string").alias("local_day"), is_logical_path(path, "pdf/").alias("path_ok"), is_timestamp(stamp).alias("stamp_ok"), is_sha256(F.when(F.col("event_id") % 4 == 1, F.sha2("props", 256)).when(F.col("event_id") % 4 == 2, F.upper(F.sha2("props", 256))).otherwise(F.md5("props"))).alias("sha_ok"))

"""Manifests, ingestion runs, page extraction and Markdown over the star tables as projects, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.operators import pages
from plinth.sources import project, snapshots
from plinth.sources.bridge import Bridge

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def _manifest(b: Bridge) -> DataFrame:
    """Customers as documents: their segment and key name a file; some paths, hashes, versions and counts are wrong."""
    c, k = b.raw("customer"), F.col("c_custkey")
    path = F.concat(F.when(k % 40 == 0, "projects/q/source/").otherwise("projects/p/source/"), F.when(k % 50 == 0, F.lit("a.pdf")).when(k % 50 == 1, F.lit("A.pdf")).otherwise(F.concat("c_mktsegment", F.lit("/"), k.cast("string"), F.lit(".pdf"))))
    rows = c.select("c_custkey", "c_acctbal", "c_nationkey", "c_name", path.alias("source_file"))
    return rows.select(
        "c_custkey", F.when(F.col("c_nationkey") == 3, "doc-x").otherwise(project.document_id(F.col("source_file"))).alias("document_id"), "source_file", F.when(F.col("c_nationkey") == 4, F.upper(F.sha2("c_name", 256))).otherwise(F.sha2("c_name", 256)).alias("source_sha256"),
        F.concat(F.when(F.col("c_nationkey") == 5, "").otherwise("projects/p/knowledge/"), F.col("c_custkey").cast("string")).alias("knowledge_path"), F.when(F.col("c_acctbal") < 0, 0).otherwise(F.col("c_custkey") % 9 + 1).cast("bigint").alias("page_count"), F.when(F.col("c_nationkey") == 6, "1").otherwise("2").alias("pipeline_version"),
    )


_MANIFEST = """
WITH b AS (SELECT *, c_custkey AS k, CASE WHEN c_custkey % 40 = 0 THEN 'projects/q/source/' ELSE 'projects/p/source/' END || CASE c_custkey % 50 WHEN 0 THEN 'a.pdf' WHEN 1 THEN 'A.pdf' ELSE c_mktsegment || '/' || c_custkey || '.pdf' END AS f FROM customer),
m AS (SELECT k, f, c_acctbal, c_nationkey, c_name, CASE WHEN c_nationkey = 3 THEN 'doc-x' ELSE 'doc-' || substr(sha256(f), 1, 24) END AS d, CASE WHEN c_nationkey = 4 THEN upper(sha256(c_name)) ELSE sha256(c_name) END AS sha FROM b)
"""


@query("manifest_rules", _MANIFEST + """
SELECT 'source_path' AS rule, f AS id FROM m WHERE f LIKE 'projects/q/%'
UNION ALL SELECT 'knowledge_path', f FROM m WHERE c_nationkey = 5
UNION ALL SELECT 'sha256', f FROM m WHERE c_nationkey = 4
UNION ALL SELECT 'version', f FROM m WHERE c_nationkey = 6
UNION ALL SELECT 'document_id', f FROM m WHERE c_nationkey = 3
UNION ALL SELECT 'page_count', f FROM m WHERE c_acctbal < 0
UNION ALL SELECT 'document_id_twice', d FROM m GROUP BY d HAVING count(*) > 1
UNION ALL SELECT 'source_file_twice', lower(f) FROM m GROUP BY lower(f) HAVING count(*) > 1
UNION ALL SELECT CASE WHEN k % 11 = 0 THEN 'source_missing' ELSE 'source_changed' END, f FROM m WHERE k % 50 > 1 AND (k % 11 = 0 OR k % 13 = 0 OR c_nationkey = 4)
UNION ALL SELECT 'source_missing', f FROM m WHERE k % 50 <= 1""")
def manifest_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule that the derived manifest breaks, sources missing and changed among them."""
    m = _manifest(Bridge(spark, sf_dir))
    there = m.join(Bridge(spark, sf_dir).raw("customer").select("c_custkey", "c_name"), "c_custkey").filter("c_custkey % 11 <> 0 and c_custkey % 50 > 1")
    sources = there.select(F.col("source_file").alias("path"), F.when(F.col("c_custkey") % 13 == 0, "other").otherwise(F.sha2("c_name", 256)).alias("sha"))
    return project.manifest_problems(m, "p", "2", sources)


@query("ingestion_actions", _MANIFEST + """, s AS (SELECT f, CASE WHEN k % 13 = 0 THEN 'other' ELSE sha256(c_name) END AS sha FROM m WHERE k % 11 <> 0 AND k % 50 > 1 UNION ALL SELECT 'projects/p/source/new-' || k || '.pdf', sha256(c_name) FROM m WHERE c_nationkey = 7),
o AS (SELECT f, sha, k % 17 <> 0 AS valid FROM m WHERE k % 50 > 1)
SELECT coalesce(o.f, s.f) AS source_file, CASE WHEN s.f IS NULL THEN 'remove' WHEN o.f IS NOT NULL AND o.sha = s.sha AND o.valid THEN 'unchanged' ELSE 'process' END AS action FROM o FULL OUTER JOIN s ON o.f = s.f""")
def ingestion_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run does with each file: new, changed, gone, or of a broken tree."""
    b = Bridge(spark, sf_dir)
    m = _manifest(b).filter("c_custkey % 50 > 1").withColumn("knowledge_path", F.col("c_custkey").cast("string"))
    c = b.raw("customer").select("c_custkey", "c_name", "c_nationkey")
    there = m.join(c.drop("c_nationkey"), "c_custkey").filter("c_custkey % 11 <> 0").select("source_file", F.when(F.col("c_custkey") % 13 == 0, "other").otherwise(F.sha2("c_name", 256)).alias("sha"))
    new = c.filter("c_nationkey = 7").select(F.concat(F.lit("projects/p/source/new-"), F.col("c_custkey").cast("string"), F.lit(".pdf")).alias("source_file"), F.sha2("c_name", 256).alias("sha"))
    trees = m.select("knowledge_path", (F.col("c_custkey") % 17 != 0).alias("valid"))
    return project.ingestion(m, there.unionByName(new).withColumnRenamed("source_file", "path"), trees)


@query("extraction_states", """
WITH e AS (SELECT doc_id, doc_id % 3 <> 0 AS lines, doc_id % 19 = 0 AS failed, doc_id % 5 AS n, doc_id % 5 // 2 AS a FROM documents), s AS (SELECT *, CASE WHEN lines AND failed THEN 'extraction_error' WHEN lines AND n > 0 THEN 'completed' ELSE 'no_candidates' END AS status FROM e)
SELECT doc_id, status, CASE WHEN status = 'completed' THEN n ELSE 0 END AS candidate_count, CASE WHEN status = 'completed' THEN a ELSE 0 END AS accepted_count, CASE WHEN status = 'completed' THEN n - a ELSE 0 END AS rejected_count FROM s""")
def extraction_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    found = pages.extraction(k % 3 != 0, k % 19 == 0, k % 5, F.expr("doc_id % 5 div 2"))
    return Bridge(spark, sf_dir).raw("documents").select("doc_id", found.alias("x")).select("doc_id", "x.*")


@query("markdown_pages", r"""
WITH p AS (SELECT conv_id AS c, turn + 1 AS n, text FROM conversations), q AS (SELECT *, 'pages/p' || lpad(CAST(n AS VARCHAR), 4, '0') || '.md' AS name, length(regexp_replace(text, '\s+$', '')) AS size FROM p)
SELECT c || '/' || name AS path, length(text) + 1 AS body FROM q
UNION ALL SELECT c || '/index.md', sum(length('- [Page ' || n || '](' || name || '): ' || CASE WHEN size = 0 THEN 'no_text' WHEN size < 40 THEN 'minimal_text' ELSE 'extracted' END) + 1) FROM q GROUP BY c""")
def markdown_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as pages: each file's path and the length of its body or list."""
    c = Bridge(spark, sf_dir).raw("conversations")
    rows = c.select(F.col("conv_id").cast("string").alias("document_id"), F.lit("f").alias("source_file"), F.lit("s").alias("source_sha256"), (F.col("turn") + 1).alias("page"), F.array(F.struct("text")).alias("text_blocks"))
    body = F.when(F.col("path").endswith("index.md"), F.regexp_replace("text", "^# f\n\n", "")).otherwise(F.regexp_replace("text", "(?s)^---\n.*?\n---\n\n", ""))
    return project.markdown(rows).select("path", F.length(body).cast("bigint").alias("body"))


def _sidecars(b: Bridge) -> DataFrame:
    """Orders as one-page documents: a line per line item, two spans a line; some numbers, texts and boxes are wrong."""
    line, q = b.raw("lineitem"), F.col("l_quantity")
    box = F.array(*[F.lit(float(v)) for v in (0, 0, 9, 9)])
    none = [F.lit(None).cast("string").alias("font_name"), F.lit(None).cast("double").alias("font_size"), F.lit(None).cast("bigint").alias("font_flags")]
    span = lambda i, t: F.struct(F.lit(i).cast("bigint").alias("order_index"), F.col(t).alias("text"), box.alias("bbox"), F.when(q == 3, "guess").otherwise(project.EMBEDDED).alias("provenance"), *none)
    text = F.when(q == 7, "?").otherwise(F.concat("l_returnflag", "l_linestatus"))
    rows = line.select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", text.alias("text"), q.alias("q"), F.array(span(0, "l_returnflag"), span(1, "l_linestatus")).alias("spans")).alias("x"))
    rows = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("x"), lambda a, b: F.when(F.struct(a["l_linenumber"], a["l_partkey"], a["l_suppkey"]) < F.struct(b["l_linenumber"], b["l_partkey"], b["l_suppkey"]), -1).otherwise(1)).alias("xs"))
    lines = F.transform("xs", lambda x, i: F.struct((i + F.when(x["q"] == 5, 1).otherwise(0)).cast("bigint").alias("order_index"), x["text"].alias("text"), box.alias("bbox"), F.lit(project.EMBEDDED).alias("provenance"), x["spans"].alias("spans")))
    o = b.raw("orders").join(rows, F.col("o_orderkey") == F.col("l_orderkey"))
    whole = F.when(F.col("o_orderpriority") == "5-LOW", "x").otherwise(F.array_join(F.transform("xs", lambda x: x["text"]), "\n"))
    block = F.struct(F.lit(0).cast("bigint").alias("order_index"), whole.alias("text"), box.alias("bbox"), F.lit(project.EMBEDDED).alias("provenance"), lines.alias("lines"))
    return o.select(
        F.concat(F.lit("doc-"), F.col("o_orderkey").cast("string")).alias("document_id"), F.lit("f").alias("source_file"), F.when(F.col("o_totalprice") > 450000, "0").otherwise("s").alias("source_sha256"), F.when(F.col("o_orderstatus") == "P", 2).otherwise(1).cast("bigint").alias("page"), box.alias("media_box"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.array(*[F.lit(float(v)) for v in (0, 0, -1, 1)])).otherwise(box).alias("crop_box"), F.when(F.col("o_orderpriority") == "2-HIGH", "up").otherwise(project.SPACE).alias("coordinate_space"), F.array(block).alias("text_blocks"),
    )


@query("sidecar_rules", """
WITH i AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS li FROM lineitem),
o AS (SELECT *, 'doc-' || o_orderkey || '/' || CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS pl FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)), j AS (SELECT i.*, o.pl FROM i JOIN o ON l_orderkey = o_orderkey)
SELECT 'identity' AS rule, pl AS id FROM o WHERE o_totalprice > 450000 UNION ALL SELECT 'page', pl FROM o WHERE o_orderstatus = 'P' UNION ALL SELECT 'space', pl FROM o WHERE o_orderpriority = '2-HIGH' UNION ALL SELECT 'crop_box', pl FROM o WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT 'page_count', 'doc-' || o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'b_text', pl || '/0' FROM o WHERE o_orderpriority = '5-LOW' UNION ALL SELECT 'l_order', pl || '/0/' || li FROM j WHERE l_quantity = 5 UNION ALL SELECT 'l_text', pl || '/0/' || li FROM j WHERE l_quantity = 7
UNION ALL SELECT 's_provenance', pl || '/0/' || li || '/' || s FROM j, (VALUES (0), (1)) v(s) WHERE l_quantity = 3""")
def sidecar_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of page sidecars that the derived ones break; orders without lines lack their page."""
    b = Bridge(spark, sf_dir)
    docs = b.raw("orders").select(F.concat(F.lit("doc-"), F.col("o_orderkey").cast("string")).alias("document_id"), F.lit("f").alias("source_file"), F.lit("s").alias("source_sha256"), F.lit(1).cast("bigint").alias("page_count"))
    rows = _sidecars(b).withColumn("table_extraction", F.lit(None).cast(project._EXTRACTION)).withColumn("tables", F.array().cast(f"array<{project._TABLE}>"))
    return project.sidecar_problems(rows, docs)


@query("project_lines", """
SELECT count(*) AS lines, CAST(sum(length(CASE WHEN l_quantity = 7 THEN '?' ELSE l_returnflag || l_linestatus END)) AS BIGINT) AS chars, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS pages FROM lineitem""")
def project_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store tables of all those documents at once, counted; ids are distinct."""
    b = Bridge(spark, sf_dir)
    pages_ = _sidecars(b).withColumns({"width_points": F.lit(612.0), "height_points": F.lit(792.0), "rotation": F.lit(0).cast("bigint")})
    docs = pages_.select("document_id", "source_file", "source_sha256")
    made = project.records(pages_.withColumn("source_file", F.col("document_id")), docs, "1")
    lines = made["pdf_text_lines"].agg(F.countDistinct("id").alias("lines"), F.sum(F.length("text")).alias("chars"))
    return lines.join(made["pdf_pages"].agg(F.countDistinct("id").alias("pages")))


def _snapshots(b: Bridge) -> DataFrame:
    """A snapshot for every customer, with its orders as levels; some are of another version, some have strange or wrong fields."""
    key = F.col("o_custkey")
    off = lambda n, a, b_: F.when(key % n == 0, a).otherwise(b_)
    level = F.struct(
        F.concat(F.lit("l"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderstatus").alias("name"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey")).alias("elevation"), F.lit("mm").alias("unit"),
        F.when(F.col("o_orderkey") % 7 == 0, "x").alias("strange"), F.lit("given").alias("provenance"), F.when(F.col("o_orderkey") % 5 == 0, "sure").alias("confidence"),
    )
    rows = b.raw("orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(level)).alias("levels"))
    text = F.to_json(F.struct(off(3, 9, 1).alias("snapshot_version"), F.struct(key.alias("project_id")).alias("project"), F.struct("levels").alias("records")))
    return rows.select(key.cast("string").alias("snapshot"), off(13, F.concat(text, F.lit("x")), text).alias("text"))


_ORDERS = "WITH o AS (SELECT o_custkey AS c, o_orderkey AS k, o_custkey % 13 = 0 AS broken FROM orders)"


@query("snapshot_records", _ORDERS + """
SELECT CAST(c AS VARCHAR) AS snapshot, 'l' || k AS id, CASE WHEN k % 11 <> 0 THEN CAST(k AS DOUBLE) END AS elevation, NULL::DOUBLE AS confidence FROM o WHERE NOT broken""")
def snapshot_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all snapshots as rows of their table."""
    found = snapshots.table(snapshots.parsed(_snapshots(Bridge(spark, sf_dir))), "levels")
    return found.select("snapshot", "id", "elevation", "confidence")


@query("snapshot_problems", _ORDERS + """
SELECT CAST(c AS VARCHAR) AS snapshot, '$' AS place, 'not strict JSON' AS problem FROM o WHERE broken GROUP BY c UNION ALL SELECT CAST(c AS VARCHAR), '$.snapshot_version', 'unsupported' FROM o WHERE NOT broken AND c % 3 = 0 GROUP BY c
UNION ALL SELECT CAST(c AS VARCHAR), CASE WHEN k % 7 = 0 THEN 'strange' END, 'unknown field' FROM o WHERE NOT broken AND k % 7 = 0 UNION ALL SELECT CAST(c AS VARCHAR), 'confidence', 'another type' FROM o WHERE NOT broken AND k % 5 = 0""")
def snapshot_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What breaks the format in all snapshots; of a record's field its name only."""
    found = snapshots.problems(snapshots.parsed(_snapshots(Bridge(spark, sf_dir))))
    return found.withColumn("place", F.when(F.col("place").contains("]."), F.regexp_extract("place", r"\]\.(.*)$", 1)).otherwise(F.col("place")))

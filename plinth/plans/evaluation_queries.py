"""Evaluation over the star tables: every order is a case whose answer lists its lines, all nested in JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth import evaluation
from plinth.operators import payload
from plinth.sources.bridge import Bridge

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def _text(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _answers(b: Bridge) -> DataFrame:
    """``(case_id, payload)``: lines in order; returned ones name no source, so they are no places."""
    line = b.raw("lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").alias("l"))

    def shown(x: Column) -> Column:
        source = F.when(x["l_returnflag"] != "R", "supplier")
        document = F.struct(_text("d-", x["l_linenumber"]).alias("id"), _text("doc-", x["l_linenumber"]).alias("identity"))
        entity = F.struct(_text("part-", x["l_partkey"]).alias("id"), F.lit("part").alias("entity_class"))
        return F.struct(entity.alias("semantic_entity"), source.alias("source_kind"), _text("supplier-", x["l_suppkey"]).alias("source_id"), F.lit(True).alias("can_zoom"), document.alias("document"), x["l_linenumber"].alias("pdf_page"))

    rows = line.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list("l")), shown).alias("candidates"))
    orders = b.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("status"))
    rows = orders.join(rows, "l_orderkey")
    return rows.select(F.col("l_orderkey").cast("string").alias("case_id"), F.lit(5).alias("limit"), F.to_json(F.struct("status", "candidates")).alias("payload"))


def _cases(b: Bridge) -> DataFrame:
    """``(case_id, json)``: what is expected of each order; a third expects neither pages nor evidence."""
    key = F.col("o_orderkey")
    region = lambda doc, page: F.struct(F.lit(f"doc-{doc}").alias("document_identity"), F.lit(page).alias("pdf_page"))
    checks = F.lit('[{"path":["candidates",0,"pdf_page"],"equals":2.0},{"path":["candidates"],"contains":{"document":{"identity":"doc-3"},"source_kind":"supplier"}},{"path":["nowhere"],"equals":1}]')
    some = key % 3 != 0
    wanted = F.struct(
        F.lit("F").alias("status"), F.array(_text("part-", key % 200 + 1)).alias("semantic_entity_ids"), F.when(some, F.array(F.lit(3))).alias("pdf_pages"), F.when(some, F.array(region(2, 2), region(9, 1))).alias("evidence"),
        F.array(F.struct(F.lit("supplier").alias("kind"), F.lit("supplier-1").alias("id"))).alias("source_references"), F.from_json(checks, "array<variant>").alias("checks"),
    )
    run = F.struct(F.lit("search_semantic_entities").alias("operation"), F.struct(F.lit("x").alias("query"), F.lit(5).alias("limit")).alias("arguments"))
    orders = b.raw("orders")
    return orders.select(key.cast("string").alias("case_id"), F.to_json(F.struct(key.cast("string").alias("case_id"), run.alias("baseline"), wanted.alias("expected"))).alias("json"))


def _both(spark: SparkSession, sf_dir: str) -> tuple[evaluation.Expected, payload.Documents, DataFrame]:
    b = Bridge(spark, sf_dir)
    got = _answers(b)
    return evaluation.Expected(payload.Documents(_cases(b), "case_id", "json")), payload.Documents(got, "case_id", "payload"), got


_LINES = "WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_returnflag <> 'R' AS placed FROM lineitem), c AS (SELECT o_orderkey AS k, o_orderstatus AS st FROM orders)"


@query("payload_cells", """
WITH l AS (SELECT l_orderkey AS k, count(*) AS n, count(*) FILTER (WHERE l_returnflag <> 'R') AS named FROM lineitem GROUP BY 1)
SELECT CAST(l.k AS VARCHAR) AS case_id, 3 + 11 * n - (n - named) AS cells, n AS pages FROM l JOIN orders ON o_orderkey = l.k""")
def payload_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value inside the answers: the answer, its status and list, eleven cells a line, one less without a source."""
    found = payload.cells(_answers(Bridge(spark, sf_dir)), "case_id", "payload")
    return found.groupBy("case_id").agg(F.count("*").alias("cells"), F.count_if((payload.last(F.col("path")) == ".pdf_page") & (F.col("kind") == "integer")).alias("pages"))


@query("payload_observations", _LINES + """
SELECT CAST(k AS VARCHAR) AS case_id, field, count(DISTINCT value) AS n, max(value) AS last FROM (
  SELECT k, 'semantic_entity_ids' AS field, '"part-' || p || '"' AS value FROM l UNION ALL SELECT k, 'source_references', '{"id":"supplier-' || s || '","kind":"supplier"}' FROM l WHERE placed) JOIN c USING (k) GROUP BY ALL""")
def payload_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities and references that the answers name, each once."""
    found = evaluation.observed(payload.Documents(_answers(Bridge(spark, sf_dir)), "case_id", "payload"))
    return found.groupBy("case_id", "field").agg(F.count("*").alias("n"), F.max("value").alias("last"))


@query("evaluation_states", _LINES + """
SELECT CAST(k AS VARCHAR) AS case_id, st AS actual, CASE WHEN st = 'F' THEN 'pass' ELSE 'fail' END AS state FROM c WHERE k IN (SELECT k FROM l)""")
def evaluation_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    want, found, _ = _both(spark, sf_dir)
    return evaluation.status_states(want, found).filter("actual is not null").select("case_id", "actual", "state")


@query("evaluation_fields", _LINES + """,
f AS (SELECT c.k, bool_or(p = c.k % 200 + 1) AS part, coalesce(bool_or(placed AND n IN (1, 2, 3)), false) AS page, coalesce(bool_or(placed AND n IN (2, 9)), false) AS doc, coalesce(bool_or(placed AND s = 1), false) AS ref FROM c JOIN l USING (k) GROUP BY c.k)
SELECT CAST(k AS VARCHAR) AS case_id, field, CASE WHEN hit IS NULL THEN 'not_applicable' WHEN hit THEN 'hit' ELSE 'miss' END AS state FROM (
  SELECT k, unnest(['semantic_entity_ids', 'source_references', 'pdf_pages', 'document_identities', 'sheet_ids', 'sheet_numbers', 'view_ids', 'evidence_ids', 'bbox']) AS field,
    unnest([part, ref, CASE WHEN k % 3 <> 0 THEN page END, CASE WHEN k % 3 <> 0 THEN doc END, NULL, NULL, NULL, NULL, NULL]) AS hit FROM f)""")
def evaluation_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    want, found, _ = _both(spark, sf_dir)
    return evaluation.field_states(want, found, answered=True)


@query("evaluation_evidence", _LINES + """,
e AS (SELECT c.k, count(DISTINCT n || '/' || s) FILTER (WHERE placed) AS returned, count(DISTINCT s) FILTER (WHERE placed AND n = 2) AS wanted FROM c LEFT JOIN l USING (k) WHERE c.k % 3 <> 0 GROUP BY c.k)
SELECT CAST(k AS VARCHAR) AS case_id, 2 AS expected, returned, CASE WHEN wanted > 0 THEN 1 ELSE 0 END AS retrieved, wanted, round(wanted / nullif(returned, 0), 6) AS precision, CASE WHEN wanted > 0 THEN 0.5 ELSE 0.0 END AS recall FROM e""")
def evaluation_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    want, found, _ = _both(spark, sf_dir)
    return evaluation.evidence(want, found).withColumn("precision", F.round("precision", 6))


@query("evaluation_checks", _LINES + """,
f AS (SELECT k, arg_min(n, (n, p, s)) AS first, bool_or(placed AND n = 3) AS third FROM l GROUP BY k)
SELECT CAST(c.k AS VARCHAR) AS case_id, unnest([0, 1, 2]) AS "check", unnest([CASE WHEN first = 2 THEN 'pass' ELSE 'fail' END, CASE WHEN third THEN 'pass' ELSE 'fail' END, 'fail']) AS status, unnest([NULL, NULL, 'path_missing']) AS reason FROM c JOIN f USING (k)""")
def evaluation_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    want, found, got = _both(spark, sf_dir)
    return evaluation.checks(want, found).join(got.select("case_id"), "case_id", "left_semi")


@query("evaluation_ranking", _LINES + """,
o AS (SELECT k, p, row_number() OVER (PARTITION BY k ORDER BY n, p, s) AS place FROM l), f AS (SELECT k, min(place) FILTER (WHERE p = k % 200 + 1) AS first FROM o GROUP BY k)
SELECT CAST(k AS VARCHAR) AS case_id, first, coalesce(first <= 1, false) AS hit_1, coalesce(first <= 5, false) AS hit_5, NULL::BOOLEAN AS hit_10, round(coalesce(1.0 / first, 0), 6) AS reciprocal_rank FROM f JOIN c USING (k)""")
def evaluation_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the wanted parts among the answers; of five results, none can be known to be among the first ten."""
    want, found, got = _both(spark, sf_dir)
    return evaluation.ranking(want, found, got).withColumn("reciprocal_rank", F.round("reciprocal_rank", 6))


@query("case_breaches", """
SELECT CAST(o_orderkey AS VARCHAR) AS "case", unnest(r) AS rule FROM (SELECT o_orderkey, list_filter([CASE WHEN o_orderkey % 5 = 0 THEN 'not page' END, CASE WHEN o_orderkey % 7 = 0 THEN 'unknown field' END, CASE WHEN o_orderkey % 11 = 0 THEN 'not operation' END, CASE WHEN o_orderkey % 13 = 0 THEN 'lacks expected' END, CASE WHEN o_orderkey % 17 = 0 THEN 'not strict JSON' END], lambda x : x IS NOT NULL) AS r0,
  CASE WHEN o_orderkey % 17 = 0 THEN ['not strict JSON'] WHEN o_orderkey % 13 = 0 THEN list_filter(r0, lambda x : x IN ('lacks expected', 'unknown field', 'not operation')) ELSE r0 END AS r FROM orders)""")
def case_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with a page of 0, a strange field, an operation that is none, nothing expected, or a key given twice."""
    key = F.col("o_orderkey")
    off = lambda n, bad, good: F.when(key % n == 0, bad).otherwise(good)
    text = F.concat(
        F.lit('{"case_id":"'), key.cast("string"), F.lit('","baseline":{"operation":"'), off(11, "drop", "get_drawing_reference"), F.lit('","arguments":{"reference_id":"r"}}'),
        off(13, "", F.concat(F.lit(',"expected":{"pdf_pages":[4,'), off(5, "0", "1"), F.lit('],"checks":[{"path":[],"contains":{"any":[{}]}}]}'))), off(7, ',"strange":1', ""), off(17, ',"case_id":"x"', ""), F.lit("}"),
    )
    cases = Bridge(spark, sf_dir).raw("orders").select(key.cast("string").alias("case"), text.alias("json"))
    return evaluation.breaches(cases).select("case", "rule")

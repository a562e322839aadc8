"""Search, entity and evidence queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.text import contains_nocase, datum, first_filled, is_blank, page_range, slug, text_status, tokens
from plinth.operators import postings, entities, pages, search, semantic
from plinth.session import scratch
from plinth.sources.bridge import Bridge

LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TOKENS = r"regexp_extract_all(translate(lower({}), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[\p{{L}}\p{{N}}]+')"
QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def _content(b: Bridge) -> DataFrame:
    return b.raw("documents").select(F.lit("document").alias("record_kind"), F.col("doc_id").cast("string").alias("record_id"), F.col("text").alias("content"))


def _bm25(words: list[str], source: str, where: str) -> str:
    n = len(words)
    f = ", ".join(f"len(list_filter(t, lambda x: x = '{w}')) AS f{i}" for i, w in enumerate(words))
    facts = ", ".join(f"count(*) FILTER (WHERE f{i} > 0) AS n{i}" for i in range(n))
    parts = " + ".join(
        f"CASE WHEN ln((na - n{i} + 0.5) / (n{i} + 0.5)) > 0 THEN ln((na - n{i} + 0.5) / (n{i} + 0.5)) ELSE 1e-6 END * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * length / mean))"
        for i in range(n)
    )
    return f"""
WITH s AS ({source}), t AS (SELECT *, {TOKENS.format('content')} AS t FROM s), c AS (SELECT record_id, len(t) AS length, {f} FROM t),
g AS (SELECT count(*) AS na, avg(length) AS mean, {facts} FROM c)
SELECT record_id, round(-({parts}), 6) AS rank FROM c, g WHERE {where} ORDER BY -({parts}), record_id LIMIT 20"""


@query("text_search_bm25", _bm25(["with", "from"], "SELECT CAST(doc_id AS VARCHAR) AS record_id, text AS content FROM documents", "f0 > 0 AND f1 > 0"))
def text_search_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search_text(_content(Bridge(spark, sf_dir)), "with from", 20)
    return found.select("record_id", F.round("rank", 6).alias("rank"))


@query("text_search_boolean", _bm25(["that", "this", "les"], "SELECT CAST(doc_id AS VARCHAR) AS record_id, text AS content FROM documents", "(f0 > 0 AND NOT f1 > 0) OR f2 > 0"))
def text_search_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search_text(_content(Bridge(spark, sf_dir)), "(that NOT this) OR les", 20)
    return found.select("record_id", F.round("rank", 6).alias("rank"))


@query("text_search_phrase", r"""
WITH d AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[\p{L}\p{N}]+'), ' ') || ' ' AS t FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS record_id FROM d WHERE contains(t, ' all rights reserved ') OR contains(t, ' licens')""")  # fmt: skip
def text_search_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = _content(Bridge(spark, sf_dir))
    return search.ranked(content, '"all rights reserved" OR licens*', None).select("record_id")


@query("text_search_fallback", f"""
SELECT CAST(doc_id AS VARCHAR) AS record_id, 'substring' AS path FROM documents
WHERE instr({LOW.format('text')}, '*** t') > 0 ORDER BY CAST(doc_id AS VARCHAR) LIMIT 20""")
def text_search_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hyphenated code is no valid query and is searched as it stands."""
    return search.search_text(_content(Bridge(spark, sf_dir)), "*** T", 20).select("record_id", "path")


@query("text_search_no_hit", """
SELECT CAST(doc_id AS VARCHAR) AS record_id, 'substring' AS path FROM documents WHERE instr(text, 'ights reserve') > 0 ORDER BY 1 LIMIT 20""")
def text_search_no_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A valid query without a ranked hit falls back too."""
    return search.search_text(_content(Bridge(spark, sf_dir)), "ights reserve", 20).select("record_id", "path")


@query("text_search_index", _bm25(["with", "from"], "SELECT CAST(doc_id AS VARCHAR) AS record_id, text AS content FROM documents", "f0 > 0 AND f1 > 0"))
def text_search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From stored postings; texts are read when the index is built and not when it is asked."""
    index = postings.build(_content(Bridge(spark, sf_dir)), scratch(spark, "index"))
    return postings.search(index, "with from", 20).select("record_id", F.round("rank", 6).alias("rank"))


_TOKENS = "SELECT CAST(doc_id AS VARCHAR) AS record_id, source, " + TOKENS.format("text") + " AS t FROM documents"
_IDF = "CASE WHEN ln((na - {n} + 0.5) / ({n} + 0.5)) > 0 THEN ln((na - {n} + 0.5) / ({n} + 0.5)) ELSE 1e-6 END * {f} * 2.2 / ({f} + 1.2 * (0.25 + 0.75 * length / mean))"


@query("text_search_near", f"""
WITH d AS MATERIALIZED ({_TOKENS}), g AS (SELECT count(*) AS na, avg(len(t)) AS mean FROM d), w AS (SELECT record_id, len(t) AS length, unnest(t) AS w, unnest(range(len(t))) AS p FROM d),
a AS (SELECT * FROM w WHERE w = 'with'), b AS (SELECT * FROM w WHERE w = 'from'),
n AS (SELECT (SELECT count(DISTINCT record_id) FROM a) AS n0, (SELECT count(DISTINCT record_id) FROM b) AS n1),
m AS (SELECT a.record_id, a.length, a.p AS p, b.p AS q FROM a JOIN b ON a.record_id = b.record_id AND abs(a.p - b.p) <= 4),
c AS (SELECT record_id, length, count(DISTINCT p) AS f0, count(DISTINCT q) AS f1 FROM m GROUP BY ALL)
SELECT record_id, f0 + f1 AS instances, round(-({_IDF.format(n='n0', f='f0')} + {_IDF.format(n='n1', f='f1')}), 6) AS rank FROM c, g, n""")
def text_search_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two words with at most three between them, from stored postings, with the instances that are close."""
    index = postings.build(_content(Bridge(spark, sf_dir)), scratch(spark, "index"))
    query_ = "NEAR(with from, 3)"
    found = postings.search(index, query_)
    close = postings.instances(index.postings(postings.wanted(search.parse(query_))), search.parse(query_))
    return found.join(close, ["record_kind", "record_id"]).select("record_id", F.expr("near0 + near1").alias("instances"), F.round("rank", 6).alias("rank"))


@query("text_search_phrase_rank", f"""
WITH d AS MATERIALIZED ({_TOKENS}), c AS (SELECT record_id, len(t) AS length, len(list_filter(range(1, len(t) + 1), lambda i : t[i] = 'all' AND t[i + 1] = 'rights' AND t[i + 2] = 'reserved')) AS f0, len(list_filter(t, lambda x : starts_with(x, 'licens'))) AS f1 FROM d),
g AS (SELECT count(*) AS na, avg(length) AS mean, count(*) FILTER (WHERE f0 > 0) AS n0, count(*) FILTER (WHERE f1 > 0) AS n1 FROM c)
SELECT record_id, round(-({_IDF.format(n='n0', f='f0')} + {_IDF.format(n='n1', f='f1')}), 6) AS rank FROM c, g WHERE f0 > 0 OR f1 > 0""")
def text_search_phrase_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A phrase and a prefix from stored postings, with the rank that their counts give."""
    index = postings.build(_content(Bridge(spark, sf_dir)), scratch(spark, "index"))
    return postings.search(index, '"all rights reserved" OR licens*').select("record_id", F.round("rank", 6).alias("rank"))


@query("index_update", f"""
WITH d AS MATERIALIZED (SELECT record_id, CASE WHEN CAST(record_id AS BIGINT) % 5 = 1 THEN list_transform(t, lambda x : CASE WHEN x = 'with' THEN 'from' ELSE x END) ELSE t END AS t FROM ({_TOKENS}) WHERE CAST(record_id AS BIGINT) % 5 <> 0),
c AS (SELECT record_id, len(t) AS length, len(list_filter(t, lambda x : x = 'with')) AS f0 FROM d), g AS (SELECT count(*) AS na, avg(length) AS mean, count(*) FILTER (WHERE f0 > 0) AS n0 FROM c)
SELECT record_id, round(-({_IDF.format(n='n0', f='f0')}), 6) AS rank FROM c, g WHERE f0 > 0""")
def index_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the documents is removed from an index and another fifth changes a word: old words no longer hit, and numbers are those of today."""
    content = _content(Bridge(spark, sf_dir))
    index = postings.build(content, scratch(spark, "index"))
    which = F.col("record_id").cast("bigint") % 5
    changed = content.filter(which == 1).withColumn("content", F.array_join(F.transform(tokens(F.col("content")), lambda x: F.when(x == "with", "from").otherwise(x)), " "))
    now = postings.update(index, changed, content.filter(which <= 1))
    return postings.search(now, "with").select("record_id", F.round("rank", 6).alias("rank"))


@query("index_integrity", f"""
WITH d AS (SELECT doc_id, source, {TOKENS.format("text")} AS t FROM documents), w AS (SELECT doc_id, source, unnest(t) AS term FROM d), p AS (SELECT doc_id, source, term, count(*) AS tf FROM w GROUP BY ALL),
s AS (SELECT doc_id, source, term, CASE WHEN term = 'the' THEN tf + 1 ELSE tf END AS tf FROM p WHERE NOT (term = 'that' AND source = 'src8'))
SELECT CAST(doc_id AS VARCHAR) AS record_id, term, 'stale' AS problem FROM p WHERE term = 'the' UNION ALL SELECT CAST(doc_id AS VARCHAR), term, 'missing' FROM p WHERE term = 'the' OR (term = 'that' AND source = 'src8')""")
def index_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored index with wrong counts for one word and postings lost for another in one source."""
    b = Bridge(spark, sf_dir)
    content = _content(b)
    postings, _ = search.build_index(content)
    lost = b.raw("documents").filter("source = 'src8'").select(F.col("doc_id").cast("string").alias("record_id"), F.lit("that").alias("term"))
    stored = postings.join(lost, ["record_id", "term"], "left_anti").withColumn("tf", F.when(F.col("term") == "the", F.col("tf") + 1).otherwise(F.col("tf")))
    return search.index_differences(content, stored).select("record_id", "term", "problem")


_LINES = "SELECT doc_id, source || '/' || CAST(doc_id AS VARCHAR) AS identity, unnest(string_split(text, chr(10))) AS content, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents"


@query("text_search_blocks", f"""
WITH l AS ({_LINES}), s AS (SELECT CAST(doc_id AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS record_id, identity, i, content FROM l),
t AS (SELECT *, {TOKENS.format('content')} AS t FROM s), c AS (SELECT record_id, identity, i, len(t) AS length, len(list_filter(t, lambda x: x = 'rights')) AS f FROM t),
g AS (SELECT count(*) AS na, avg(length) AS mean, count(*) FILTER (WHERE f > 0) AS n FROM c),
r AS (SELECT record_id, identity, i, -(CASE WHEN ln((na - n + 0.5) / (n + 0.5)) > 0 THEN ln((na - n + 0.5) / (n + 0.5)) ELSE 1e-6 END * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * length / mean))) AS rank FROM c, g WHERE f > 0)
SELECT record_id, identity, CAST(i AS INTEGER) AS order_index, round(rank, 6) AS rank FROM r ORDER BY r.rank, record_id LIMIT 20""")
def text_search_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits among text blocks, joined to their document and place."""
    lines = Bridge(spark, sf_dir).lines()
    content = lines.select(F.lit("pdf_text_block").alias("record_kind"), F.col("id").alias("record_id"), F.col("text").alias("content"))
    hits = search.ranked(content, "rights", 20)
    return hits.join(lines, hits["record_id"] == lines["id"]).select("record_id", "identity", "order_index", F.round("rank", 6).alias("rank"))


@query("cell_search", "SELECT p_partkey, p_type FROM part WHERE contains(p_type, 'ECON') OR contains(p_type, 'econ') ORDER BY p_partkey LIMIT 20")
def cell_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case matters in table cells: of the two spellings only the stored one matches."""
    cells = Bridge(spark, sf_dir).raw("part").select("p_partkey", "p_type")
    upper, lower = (search.search_cells(cells, x, ["p_partkey"], 20, "p_type") for x in ("ECON", "econ"))
    return upper.unionByName(lower).distinct().orderBy("p_partkey").limit(20)


@query("find_entities", f"""
WITH e AS (SELECT 'level' AS kind, 'level-' || r_regionkey AS id, r_name AS name FROM region UNION ALL SELECT 'space', 'space-' || n_nationkey, n_name FROM nation
UNION ALL SELECT DISTINCT 'element_type', p_brand || '/' || p_type, p_type FROM part UNION ALL SELECT 'element', 'part-' || p_partkey, p_name FROM part
UNION ALL SELECT 'element', 'customer-' || c_custkey, c_name FROM customer UNION ALL SELECT 'element', 'supplier-' || s_suppkey, s_name FROM supplier)
SELECT kind, id, name FROM e WHERE instr({LOW.format('name')}, 'an') > 0""")
def find_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    return entities.find_entities(entities.entities(b.levels(), b.spaces(), b.element_types(), b.elements()), "AN").select("kind", "id", "name")


@query("find_entities_empty", "SELECT (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM (SELECT DISTINCT p_brand, p_type FROM part)) + (SELECT count(*) FROM part) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) AS n")
def find_entities_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    return entities.find_entities(entities.entities(b.levels(), b.spaces(), b.element_types(), b.elements()), "").agg(F.count("*").alias("n"))


@query("numeric_facts", """
SELECT 'part-' || p_partkey AS entity_id, 'p_size' AS definition_name, CAST(p_size AS DOUBLE) AS numeric_value, 'mm' AS unit FROM part
UNION ALL SELECT 'part-' || p_partkey, 'p_retailprice', p_retailprice, 'number' FROM part
UNION ALL SELECT 'customer-' || c_custkey, 'c_acctbal', c_acctbal, 'number' FROM customer UNION ALL SELECT 'supplier-' || s_suppkey, 's_acctbal', s_acctbal, 'number' FROM supplier""")
def numeric_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.numeric_facts(Bridge(spark, sf_dir).parameters()).select("entity_id", "definition_name", "numeric_value", "unit")


@query("evidence_context", """
SELECT l.doc_id, 'e-' || l.doc_id AS evidence_id, d.source || '/' || d.doc_id AS identity, l.quality + 1 AS pdf_page,
       CASE WHEN l.toxic = 0 THEN d.source END AS sheet_number, CASE WHEN d.lang <> 'en' THEN d.lang END AS view_name
FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id""")
def evidence_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as facts whose evidence names a document, a page, sometimes a sheet (source) and a view (language)."""
    b = Bridge(spark, sf_dir)
    docs = b.raw("documents").select("doc_id", "source", "lang")
    labels = b.raw("labels").withColumn("evidence_id", F.concat(F.lit("e-"), F.col("doc_id").cast("string")))
    none = [F.lit(None).cast("double").alias(c) for c in ("x_min", "y_min", "x_max", "y_max")]
    evidence = labels.select("doc_id", F.col("evidence_id").alias("id"), F.col("doc_id").cast("string").alias("document_id"), (F.col("quality") + 1).alias("pdf_page"), "toxic", *none).join(docs, "doc_id")
    evidence = evidence.withColumn("sheet_id", F.when(F.col("toxic") == 0, F.col("source"))).withColumn("view_id", F.when(F.col("lang") != "en", F.col("lang")))
    documents = docs.select(F.col("doc_id").cast("string").alias("id"), F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("identity"), F.col("source").alias("source_filename"))
    sheets, views = docs.select(F.col("source").alias("id"), F.col("source").alias("number")).distinct(), docs.select(F.col("lang").alias("id"), F.col("lang").alias("name")).distinct()
    out = entities.with_evidence(labels, evidence, documents, sheets, views)
    return out.select("doc_id", "evidence_id", F.col("evidence.document_identity").alias("identity"), "evidence.pdf_page", "evidence.sheet_number", "evidence.view_name")


@query("appearance_context", """
WITH a AS (SELECT l.l_partkey, l.l_linenumber, l.l_orderkey, l.l_suppkey, l.l_returnflag, o.o_orderkey, o.o_orderstatus, o.o_custkey FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT 'part-' || l_partkey AS entity_id, 'app-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS appearance_id, 'status-' || o_orderstatus AS document_identity, l_linenumber AS pdf_page,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE 'order-' || l_orderkey END AS sheet_id, CASE WHEN l_returnflag <> 'N' THEN 'view-' || o_custkey END AS view_id, l_returnflag <> 'N' AS can_zoom
FROM a WHERE o_orderkey IS NOT NULL AND NOT (l_returnflag = 'R' AND false)""")
def appearance_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences whose sheet is an order (none if returned) and whose view hangs on a viewport of the order."""
    b = Bridge(spark, sf_dir)
    orders = b.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    doc = F.concat(F.lit("status-"), "o_orderstatus")
    apps = b.appearances("l_returnflag").drop("document_id")
    order = F.concat(F.lit("order-"), F.split("id", "-")[1])
    apps = apps.withColumn("sheet_id", F.when(F.col("l_returnflag") != "R", order)).withColumn("view_id", F.lit(None).cast("string")).withColumn("viewport_id", F.when(F.col("l_returnflag") != "N", F.concat(F.lit("port-"), F.split("id", "-")[1]))).withColumn("link_instance_id", F.lit(None).cast("string"))
    sheets = orders.select(F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("id"), doc.alias("document_id"), F.col("o_orderkey").cast("string").alias("number"), F.lit("sheet").alias("name"))
    views = orders.select(F.concat(F.lit("view-"), F.col("o_custkey").cast("string"), F.lit("-"), "o_orderstatus").alias("id"), doc.alias("document_id"), F.concat(F.lit("view-"), F.col("o_custkey").cast("string")).alias("name")).distinct()
    ports = orders.select(F.concat(F.lit("port-"), F.col("o_orderkey").cast("string")).alias("id"), F.lit(None).cast("string").alias("sheet_id"), F.concat(F.lit("view-"), F.col("o_custkey").cast("string"), F.lit("-"), "o_orderstatus").alias("view_id"))
    docs = orders.select(doc.alias("id"), doc.alias("identity"), doc.alias("source_filename")).distinct()
    found = entities.occurrences(apps, ports, sheets, views, docs)
    return found.select("entity_id", "appearance_id", "document_identity", "pdf_page", "sheet_id", F.col("view_name").alias("view_id"), F.col("bbox").isNotNull().alias("can_zoom"))


@query("navigation_dedupe", """
SELECT 'order-' || l_orderkey AS document_id, l_linenumber AS pdf_page, CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS x_min,
       min('app-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey) AS source_id FROM lineitem GROUP BY 1, 2, 3""")
def navigation_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    apps = Bridge(spark, sf_dir).appearances().withColumnRenamed("id", "source_id")
    return entities.deduplicated(apps, ["document_id", "pdf_page", "x_min"]).select("document_id", "pdf_page", "x_min", "source_id")


@query("binding_state_counts", """
WITH b AS (SELECT d.lang, l.doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'exact' WHEN quality = 1 THEN 'ambiguous' ELSE 'unresolved' END AS s FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
SELECT lang, count(*) FILTER (WHERE s = 'exact') AS n_exact, count(*) FILTER (WHERE s = 'resolved_deterministically') AS n_resolved_deterministically, count(*) FILTER (WHERE s = 'ambiguous') AS n_ambiguous,
       count(*) FILTER (WHERE s = 'unresolved') AS n_unresolved, coalesce(string_agg(CASE WHEN s = 'ambiguous' THEN CAST(doc_id AS VARCHAR) END, ',' ORDER BY CAST(doc_id AS VARCHAR)), '') AS ambiguous_ids FROM b GROUP BY lang""")
def binding_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    state = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "exact").when(F.col("quality") == 1, "ambiguous").otherwise("unresolved")
    rows = b.raw("labels").join(b.raw("documents").select("doc_id", "lang"), "doc_id").select("lang", F.col("doc_id").cast("string").alias("id"), state.alias("resolution_state"))
    out = entities.binding_states(rows, "lang")
    return out.select("lang", "n_exact", "n_resolved_deterministically", "n_ambiguous", "n_unresolved", F.array_join("ambiguous_ids", ",").alias("ambiguous_ids"))


_ASKED = [("10", None), ("part-7", None), ("BRAND#12", None), ("Brand#1", "door"), ("steel", None), ("zzz", None), ("  ", None)]
_DISCOVERY = f"""
WITH q(query, cls) AS (VALUES ('10', NULL), ('part-7', NULL), ('BRAND#12', NULL), ('Brand#1', 'door'), ('steel', NULL)),
e AS (SELECT 'part-' || p_partkey AS id, CASE WHEN p_size > 25 THEN 'Equipment' ELSE 'Door' END AS class, CAST(p_partkey AS VARCHAR) AS number, p_name AS label, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part),
v AS (SELECT id, class, 'entity_id' AS ms, id AS val FROM e UNION ALL SELECT id, class, 'number', number FROM e UNION ALL SELECT id, class, 'label', label FROM e
      UNION ALL SELECT id, class, 'property_value', p_brand FROM e UNION ALL SELECT id, class, 'property_value', p_type FROM e UNION ALL SELECT id, class, 'property_value', p_size FROM e),
m AS (SELECT query, v.id, CASE WHEN {LOW.format('val')} = {LOW.format('query')} THEN CASE ms WHEN 'entity_id' THEN 0 WHEN 'number' THEN 1 WHEN 'label' THEN 2 ELSE 3 END
             WHEN ms <> 'entity_id' THEN CASE ms WHEN 'number' THEN 4 WHEN 'label' THEN 5 ELSE 6 END END AS prec
      FROM v JOIN q ON instr({LOW.format('val')}, {LOW.format('query')}) > 0 AND (cls IS NULL OR {LOW.format('class')} = cls)),
c AS (SELECT query, m.id, min(prec) AS best, count(*) AS n_matches FROM m WHERE prec IS NOT NULL GROUP BY query, m.id),
st AS (SELECT query, count(*) FILTER (WHERE best <= 3) AS n_exact, count(*) AS n_all FROM c GROUP BY query)"""


def _discovered(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    b = Bridge(spark, sf_dir)
    asked = spark.createDataFrame(_ASKED, "query string, entity_class string")
    return semantic.discover(b.semantic_entities(), b.semantic_properties(), asked, limit)


@query("semantic_discovery", _DISCOVERY + """,
r AS (SELECT c.query, c.id, best, n_matches, row_number() OVER (PARTITION BY c.query ORDER BY best, class, number, label, c.id) AS position FROM c JOIN e ON c.id = e.id)
SELECT query, id AS semantic_entity_id, CAST(best AS INTEGER) AS best, CAST(n_matches AS INTEGER) AS n_matches, CAST(position AS INTEGER) AS position FROM r WHERE position <= 20""")
def semantic_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _discovered(spark, sf_dir, 20).filter("position is not null")
    return found.select("query", "semantic_entity_id", "best", F.size("matches").alias("n_matches"), "position")


@query("semantic_discovery_status", _DISCOVERY + """, a(query) AS (VALUES ('10'), ('part-7'), ('BRAND#12'), ('Brand#1'), ('steel'), ('zzz'), ('  '))
SELECT a.query, CASE WHEN n_exact = 1 THEN 'exact_unique' WHEN n_exact > 1 THEN 'multiple_exact' WHEN n_all > 0 THEN 'candidates' ELSE 'no_match' END AS status, coalesce(n_exact, 0) AS n_exact
FROM a LEFT JOIN st ON a.query = st.query""")
def semantic_discovery_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status counts all candidates whatever the limit."""
    return _discovered(spark, sf_dir, 1).select("query", "status", "n_exact").distinct()


@query("semantic_properties_union", """
SELECT 'part-' || p_partkey AS semantic_entity_id, 'parameter' AS fact_kind, 'p_size' AS name, CAST(p_size AS VARCHAR) AS value FROM part WHERE p_partkey % 3 <> 0
UNION ALL SELECT 'part-' || p_partkey, 'semantic_property', 'p_brand', p_brand FROM part""")
def semantic_properties_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters reach an entity through resolved bindings only; its own properties always count."""
    b = Bridge(spark, sf_dir)
    part = b.raw("part").select("p_partkey", "p_size", "p_brand")
    pid = F.concat(F.lit("part-"), F.col("p_partkey").cast("string"))
    none = lambda kind: F.lit(None).cast(kind)
    bindings = part.select(pid.alias("semantic_entity_id"), F.concat(F.lit("b-"), pid).alias("id"), F.lit("element").alias("source_kind"), pid.alias("source_id"), F.when(F.col("p_partkey") % 3 == 0, "ambiguous").otherwise("exact").alias("resolution_state"))
    parameters = part.select(pid.alias("id"), F.lit("element").alias("entity_kind"), pid.alias("entity_id"), F.lit("p_size").alias("definition_name"), F.lit("").alias("value_text"), F.col("p_size").cast("string").alias("raw_value_text"), none("double").alias("numeric_value"), none("string").alias("unit"), F.lit("instance").alias("scope"))
    properties = part.select(pid.alias("id"), pid.alias("semantic_entity_id"), F.lit("p_brand").alias("source_name"), F.col("p_brand").alias("source_value"), none("double").alias("numeric_value"), none("string").alias("unit"), F.lit("type").alias("scope"), none("string").alias("source_binding_id"))
    return semantic.facts_of(bindings, parameters, properties).select("semantic_entity_id", "fact_kind", "name", "value")


@query("table_mapping", """
WITH k AS (SELECT p_brand, p_name, p_size, p_partkey, count(*) OVER (PARTITION BY p_brand, trim(p_name)) AS n FROM part)
SELECT p_brand AS table_id, CAST(p_partkey AS INTEGER) AS row_index, trim(p_name) AS label, CASE WHEN n > 1 THEN 'ambiguous' ELSE 'exact' END AS resolution_state, CASE WHEN p_size > 10 THEN 1 ELSE 0 END AS n_properties FROM k""")
def table_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as rows of one table per brand: names as keys (twice is ambiguous), sizes above ten as cells."""
    part = Bridge(spark, sf_dir).raw("part")
    cells = part.select(F.col("p_brand").alias("table_id"), F.col("p_partkey").cast("int").alias("row_index"), F.explode(F.array(F.struct(F.lit("Name").alias("column_name"), F.col("p_name").alias("text")), F.struct(F.lit("Size").alias("column_name"), F.when(F.col("p_size") > 10, F.col("p_size").cast("string")).otherwise("").alias("text")))).alias("c")).select("table_id", "row_index", "c.*")
    found, props = semantic.from_table(cells, "Name", ["Size"], "part", "parts")
    counts = props.groupBy(F.col("semantic_entity_id").alias("id")).agg(F.count("*").cast("int").alias("n_properties"))
    return found.join(counts, "id", "left").fillna(0, ["n_properties"]).select("table_id", "row_index", "label", "resolution_state", "n_properties")


@query("datum_extraction", r"""
WITH s AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type || ' + ' || CAST(user_id AS VARCHAR) WHEN 1 THEN '  ' || event_type || ' ' WHEN 2 THEN event_type || CAST(user_id AS VARCHAR) ELSE '' END AS t FROM events)
SELECT event_id, CASE event_id % 4 WHEN 0 THEN regexp_extract(t, '^\s*([A-Za-z][A-Za-z0-9_. -]*?)\s*[+-]\s*\d', 1) WHEN 1 THEN trim(t) END AS datum FROM s""")
def datum_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Bridge(spark, sf_dir).raw("events").select("event_id", "event_type", "user_id")
    kind = F.col("event_id") % 4
    text = F.when(kind == 0, F.concat("event_type", F.lit(" + "), F.col("user_id").cast("string"))).when(kind == 1, F.concat(F.lit("  "), "event_type", F.lit(" "))).when(kind == 2, F.concat("event_type", F.col("user_id").cast("string"))).otherwise("")
    return e.select("event_id", datum(text).alias("datum"))


@query("page_ranges", """
WITH c AS (SELECT conv_id, max(turn) AS m FROM conversations GROUP BY conv_id)
SELECT conv_id, unnest(CASE WHEN conv_id % 3 = 0 THEN range(2, m + 2) WHEN conv_id % 3 = 1 THEN [1, m + 1] ELSE CAST([] AS BIGINT[]) END) AS page FROM c WHERE m >= 1""")
def page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``2-n`` for a third, ``n,1,1-1`` for a third, an invalid backward range for the rest."""
    c = Bridge(spark, sf_dir).raw("conversations").groupBy("conv_id").agg(F.max("turn").alias("m")).filter("m >= 1")
    last = (F.col("m") + 1).cast("string")
    spec = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("2-"), last)).when(F.col("conv_id") % 3 == 1, F.concat(last, F.lit(", 1,1-1"))).otherwise(F.concat(last, F.lit("-0")))
    return c.select("conv_id", F.explode(page_range(spec, (F.col("m") + 1).cast("int"))).alias("page")).withColumn("page", F.col("page").cast("bigint"))


@query("text_scalars", r"""
SELECT doc_id, CASE WHEN length(regexp_replace(regexp_replace(text, chr(13) || chr(10) || '?', chr(10), 'g'), '\s+$', '')) = 0 THEN 'no_text' WHEN length(regexp_replace(text, '\s+$', '')) < 40 THEN 'minimal_text' ELSE 'extracted' END AS status,
       regexp_replace(regexp_replace(source || ' ' || lang || '!', '[^A-Za-z0-9._-]+', '-', 'g'), '^[-.]+|[-.]+$', '', 'g') || '-' || doc_id AS slug,
       'doc-' || substr(sha256(source || '/' || doc_id), 1, 24) AS document_id, NOT regexp_matches(text, '\S') AS blank, CASE WHEN lang <> 'en' THEN lang ELSE source END AS filled FROM documents""")
def text_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Bridge(spark, sf_dir).raw("documents").select("doc_id", "text", "source", "lang")
    ident = F.concat(F.lit("doc-"), F.substring(F.sha2(F.concat_ws("/", "source", F.col("doc_id").cast("string")), 256), 1, 24))
    return d.select("doc_id", text_status(F.col("text")).alias("status"), slug(F.concat("source", F.lit(" "), "lang", F.lit("!")), F.col("doc_id").cast("string")).alias("slug"), ident.alias("document_id"), is_blank(F.col("text")).alias("blank"), first_filled(F.when(F.col("lang") != "en", F.col("lang")).otherwise(""), F.col("source")).alias("filled"))


@query("line_reconstruction", """
WITH t AS (SELECT *, CASE WHEN role IS NOT DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 0 ELSE 1 END AS s FROM conversations),
r AS (SELECT *, sum(s) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM t), l AS (SELECT conv_id, run, string_agg(text, '' ORDER BY turn) AS t FROM r GROUP BY conv_id, run)
SELECT conv_id, md5(string_agg(t, chr(10) ORDER BY run)) AS text_md5, count(*) AS n_lines FROM l GROUP BY conv_id""")
def line_reconstruction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as spans, runs of one role as lines."""
    rows = Bridge(spark, sf_dir).raw("conversations")
    text = pages.joined_lines(rows, "conv_id", "role", "turn")
    n = pages.runs(rows, "conv_id", "turn", "role").groupBy("conv_id").agg(F.max("run").alias("n_lines"))
    return text.join(n, "conv_id").select("conv_id", F.md5("text").alias("text_md5"), "n_lines")


@query("nocase_is_ascii", f"SELECT doc_id FROM documents WHERE instr({LOW.format('text')}, {LOW.format(chr(39) + 'É' + chr(39))}) > 0")
def nocase_is_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """É is not é to the search."""
    return Bridge(spark, sf_dir).raw("documents").filter(contains_nocase(F.col("text"), F.lit("É"))).select("doc_id")

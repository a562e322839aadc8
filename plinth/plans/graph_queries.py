"""Topology, facts and spatial queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plinth.operators import facts, semantic, spatial, topology
from plinth.sources.bridge import Bridge

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


@query("relationship_directions", """
WITH e AS (SELECT 'placed-' || o_orderkey AS id, 'order' AS sk, 'order-' || o_orderkey AS s, 'element' AS tk, 'customer-' || o_custkey AS t FROM orders
UNION ALL SELECT 'served-' || c_custkey, 'element', 'customer-' || c_custkey, 'element', 'customer-' || greatest(CAST(floor(c_custkey / 2) AS BIGINT), 1) FROM customer)
SELECT sk AS kind, s AS entity_id, id, 'outgoing' AS direction FROM e UNION ALL SELECT tk, t, id, 'incoming' FROM e WHERE NOT (sk = tk AND s = t)""")
def relationship_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.related(Bridge(spark, sf_dir).order_edges()).select("kind", "entity_id", "id", "direction")


@query("related_entities", """
WITH e AS (SELECT 'element' AS sk, 'customer-' || c_custkey AS s, 'customer-' || greatest(CAST(floor(c_custkey / 2) AS BIGINT), 1) AS t FROM customer)
SELECT x AS entity_id, count(*) AS n, count(*) FILTER (WHERE d = 'i') AS n_incoming FROM (SELECT s AS x, 'o' AS d FROM e UNION ALL SELECT t, 'i' FROM e WHERE s <> t) GROUP BY x""")
def related_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = Bridge(spark, sf_dir).order_edges().filter("relation_type = 'served_by'")
    return topology.related(edges).groupBy("entity_id").agg(F.count("*").alias("n"), F.count_if(F.col("direction") == "incoming").alias("n_incoming"))


@query("semantic_edges", """
WITH b AS (SELECT 'sem-' || (c_custkey % 50) AS e, 'customer-' || c_custkey AS s FROM customer),
r AS (SELECT 'served-' || c_custkey AS id, 'customer-' || c_custkey AS s, 'customer-' || greatest(CAST(floor(c_custkey / 2) AS BIGINT), 1) AS t FROM customer),
x AS (SELECT b.e, r.id, 'outgoing' AS d FROM r JOIN b ON r.s = b.s UNION ALL SELECT b.e, r.id, 'incoming' FROM r JOIN b ON r.t = b.s WHERE r.s <> r.t)
SELECT e AS semantic_entity_id, id, CASE WHEN min(d) = max(d) THEN min(d) ELSE 'self' END AS direction FROM x GROUP BY e, id""")
def semantic_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty semantic entities with many bound customers each: edges inside one are ``self``."""
    b = Bridge(spark, sf_dir)
    bindings = b.raw("customer").select(F.concat(F.lit("sem-"), (F.col("c_custkey") % 50).cast("string")).alias("semantic_entity_id"), F.lit("element").alias("source_kind"), F.concat(F.lit("customer-"), F.col("c_custkey").cast("string")).alias("source_id"))
    edges = b.order_edges().filter("relation_type = 'served_by'")
    none = spark.createDataFrame([], "id string, relation_type string, subject_semantic_entity_id string, object_semantic_entity_id string")
    return topology.semantic_edges(bindings, edges, none).select("semantic_entity_id", "id", "direction")


@query("type_instances", "SELECT p_brand || '/' || p_type AS type_id, count(*) AS n FROM part GROUP BY 1")
def type_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    return b.elements().filter("type_id is not null").groupBy("type_id").agg(F.count("*").alias("n"))


@query("same_type_siblings", """
WITH e AS (SELECT 'part-' || p_partkey AS id, p_brand || '/' || p_type AS t FROM part UNION ALL SELECT 'supplier-' || s_suppkey, NULL FROM supplier UNION ALL SELECT 'customer-' || c_custkey, NULL FROM customer)
SELECT a.id AS element_id, a.t AS type_id, CAST(count(b.id) AS BIGINT) AS n_siblings, CASE WHEN a.t IS NULL THEN 'insufficient_data' ELSE 'ok' END AS status FROM e a LEFT JOIN e b ON a.t = b.t AND a.id <> b.id GROUP BY a.id, a.t""")
def same_type_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    return topology.same_type_counts(b.elements(), b.element_types())


_CONTAINED = """
WITH c AS (SELECT 'customer-' || c_custkey AS element_id, 'space-' || c_nationkey AS space_id, 'space_id' AS relation_type, CAST(NULL AS VARCHAR) AS relationship_id FROM customer
UNION ALL SELECT 'supplier-' || s_suppkey, 'space-' || s_nationkey, 'space_id', NULL FROM supplier
UNION ALL SELECT 'supplier-' || s_suppkey, 'space-' || ((s_nationkey + 1) % 30), 'contained_in', 'in-' || s_suppkey || '-1' FROM supplier WHERE (s_suppkey % 2 = 0 OR s_suppkey % 3 = 0) AND (s_nationkey + 1) % 30 < 25)"""


@query("containment_contexts", _CONTAINED + " SELECT * FROM c")
def containment_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    return topology.containment(b.elements(), b.spaces(), b.contained_edges()).select("element_id", "space_id", "relation_type", "relationship_id")


@query("contained_elements", _CONTAINED + " SELECT space_id, count(DISTINCT element_id) AS n_elements, count(*) AS n_contexts FROM c GROUP BY space_id")
def contained_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    return topology.containment(b.elements(), b.spaces(), b.contained_edges()).groupBy("space_id").agg(F.countDistinct("element_id").alias("n_elements"), F.count("*").alias("n_contexts"))


@query("same_space_elements", _CONTAINED + """, p AS (SELECT DISTINCT element_id, space_id FROM c), n AS (SELECT space_id, count(*) AS n FROM p GROUP BY space_id)
SELECT p.element_id, p.space_id, n.n FROM p JOIN n ON p.space_id = n.space_id""")
def same_space_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    return topology.same_space_counts(topology.containment(b.elements(), b.spaces(), b.contained_edges()))


_SIDES = """
WITH l AS (SELECT l_partkey, CASE WHEN l_returnflag <> 'R' THEN CAST(year(l_shipdate) AS VARCHAR) END AS phase, s_nationkey, c_nationkey,
  l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
e AS (SELECT 'from_space-' || k AS id, 'part-' || l_partkey AS c, phase, 'f' AS side, 'space-' || s_nationkey AS sp FROM l UNION ALL SELECT 'to_space-' || k, 'part-' || l_partkey, phase, 't', 'space-' || c_nationkey FROM l),
g AS (SELECT c AS connector_id, phase, CASE WHEN phase IS NULL THEN id END AS alone,
  CASE WHEN count(DISTINCT CASE WHEN side = 'f' THEN sp END) = 1 THEN min(CASE WHEN side = 'f' THEN sp END) END AS from_space, CASE WHEN count(DISTINCT CASE WHEN side = 't' THEN sp END) = 1 THEN min(CASE WHEN side = 't' THEN sp END) END AS to_space,
  count(*) AS n_relationships FROM e GROUP BY 1, 2, 3)"""


@query("space_connections", _SIDES + """ SELECT connector_id, phase, from_space, to_space, CASE WHEN phase IS NOT NULL AND from_space IS NOT NULL AND to_space IS NOT NULL THEN 'complete' ELSE 'partial' END AS status, n_relationships,
CASE WHEN phase IS NULL THEN 'phase_context_missing' END AS warning FROM g""")
def space_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    return topology.connections(b.elements(), b.spaces(), b.side_edges()).drop("first_relationship")


@query("connected_spaces", _SIDES + """, d AS (SELECT * FROM g WHERE phase IS NOT NULL AND from_space IS NOT NULL AND to_space IS NOT NULL),
s AS (SELECT DISTINCT c, phase, sp FROM e WHERE phase IS NOT NULL)
SELECT s.sp AS space_id, CASE WHEN d.from_space = s.sp THEN d.to_space ELSE d.from_space END AS connected_space, count(*) AS n FROM d JOIN s ON d.connector_id = s.c AND d.phase = s.phase GROUP BY 1, 2""")
def connected_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    edges = b.side_edges()
    found = topology.connections_of_spaces(topology.connections(b.elements(), b.spaces(), edges), edges)
    return found.filter("connected_space is not null").groupBy("space_id", "connected_space").agg(F.count("*").alias("n"))


@query("change_impact", """
WITH i AS (SELECT 'part-' || p_partkey AS e, p_brand || '/' || p_type AS t FROM part),
sp AS (SELECT DISTINCT 'part-' || l_partkey AS e, s_nationkey AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey UNION SELECT DISTINCT 'part-' || l_partkey, c_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
oc AS (SELECT DISTINCT 'part-' || l_partkey AS e, l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS q, l_returnflag <> 'N' AS b FROM lineitem),
n AS (SELECT i.t, count(DISTINCT i.e) AS total, count(DISTINCT sp.e) AS with_space, count(DISTINCT sp.s) AS spaces FROM i LEFT JOIN sp ON i.e = sp.e GROUP BY i.t),
m AS (SELECT i.t, count(DISTINCT oc.e) AS drawn, count(oc.e) AS occ FROM i LEFT JOIN oc ON i.e = oc.e GROUP BY i.t)
SELECT n.t AS type_id, total AS total_instances, with_space AS instances_with_spatial_context, drawn AS instances_with_drawing_occurrence, CAST(occ AS BIGINT) AS drawing_occurrences, spaces AS related_spaces,
concat_ws(',', CASE WHEN with_space < total THEN 'spatial_context_partial' END, CASE WHEN drawn < total THEN 'drawing_occurrence_partial' END) AS warnings FROM n JOIN m ON n.t = m.t""")
def change_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    spaces = topology.related_spaces(b.elements(), b.spaces(), b.side_edges())
    return topology.change_impact(b.element_types(), b.elements().filter("type_id is not null"), spaces, b.appearances())


@query("change_spaces", """
WITH l AS (SELECT p_brand || '/' || p_type AS t, c_nationkey AS c, s_nationkey AS s, extract(year FROM l_shipdate) AS y, l_returnflag AS f FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
e AS (SELECT t, s AS n, 'from_space' AS r, y, f FROM l UNION ALL SELECT t, c, 'to_space', y, f FROM l)
SELECT t AS type_id, 'space-' || n AS space_id, count(DISTINCT r) AS relations, 0 AS blank FROM e WHERE n IN (SELECT n_nationkey FROM nation) GROUP BY ALL""")
def change_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spaces that each type touches, with the kinds of their contexts, however many edges say so."""
    b = Bridge(spark, sf_dir)
    found = topology.impact_spaces(b.elements().filter("type_id is not null"), topology.related_spaces(b.elements(), b.spaces(), b.side_edges()))
    return found.groupBy("type_id", "space_id").agg(F.count_distinct("relation_type").alias("relations"), F.count_if(F.col("provenance").isNull()).alias("blank"))


@query("change_navigation", """
WITH o AS (SELECT DISTINCT p_brand || '/' || p_type AS t, l_partkey AS p, l_orderkey AS k, l_linenumber AS n, CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS q, l_returnflag <> 'N' AS b FROM lineitem JOIN part ON p_partkey = l_partkey),
v AS (SELECT t, k, n, q, b, count(DISTINCT p) AS m FROM o GROUP BY ALL)
SELECT t AS type_id, CAST((SELECT count(*) FROM o WHERE o.t = v.t) AS BIGINT) AS occurrences, count(*) AS places, count(*) FILTER (WHERE b) AS zoomable, CAST(sum(m) AS BIGINT) AS seen FROM v GROUP BY t""")
def change_navigation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of each type's instances, and the places they are seen at, once each."""
    b = Bridge(spark, sf_dir)
    box = F.when(F.col("x_min").isNotNull(), F.array("x_min", "y_min", "x_max", "y_max"))
    drawn = b.appearances().withColumnRenamed("id", "appearance_id").withColumn("bbox", box).drop("x_min", "y_min", "x_max", "y_max")
    shown = topology.impact_occurrences(b.elements().filter("type_id is not null"), drawn)
    places = topology.impact_navigation(shown).groupBy("type_id").agg(F.count("*").alias("places"), F.count_if("can_zoom").alias("zoomable"), F.sum("n_instances").alias("seen"))
    return shown.groupBy("type_id").agg(F.count("*").alias("occurrences")).join(places, "type_id")


@query("context_coverage", """
SELECT 'part-' || p_partkey AS id, CAST(3 AS BIGINT) AS properties, coalesce(a.n, 0) AS occurrences, coalesce(f.n, 0) AS facts FROM part
LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) a ON a.l_partkey = p_partkey LEFT JOIN (SELECT p_partkey AS k, count(*) * 2 AS n FROM part GROUP BY 1) f ON f.k = p_partkey""")
def context_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    parts = {"properties": (b.semantic_properties(), "semantic_entity_id"), "occurrences": (b.appearances(), "entity_id"), "facts": (b.parameters(), "entity_id")}
    return semantic.coverage(b.semantic_entities(), parts)


_SEGMENTS = """
WITH g AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, l_suppkey AS s, CASE WHEN l_partkey % 50 <> 0 THEN l_partkey END AS src, l_linestatus = 'O' AS up, CAST(l_quantity AS DOUBLE) AS a, CAST(l_quantity + l_linenumber * 4 AS DOUBLE) AS b,
  CASE WHEN l_returnflag = 'A' THEN 'nonlinear' WHEN l_partkey % 50 = 0 THEN 'unresolved' WHEN l_linenumber * 4 <= 1e-6 THEN 'degenerate' ELSE 'usable' END AS st FROM lineitem),
k AS (SELECT *, CASE WHEN s % 10 <> 0 THEN s % 2 END AS lvl FROM g WHERE s IN (SELECT s_suppkey FROM supplier))"""


@query("adjacent_spaces", _SEGMENTS + """
SELECT 'room-' || x.s AS space_id, 'room-' || y.s AS adjacent_id, x.id AS subject_segment_id, y.id AS adjacent_segment_id, round(least(x.b, y.b) - greatest(x.a, y.a), 6) AS overlap
FROM k x JOIN k y ON x.src = y.src AND x.up = y.up AND x.lvl = y.lvl AND x.s <> y.s WHERE x.st = 'usable' AND y.st = 'usable' AND least(x.b, y.b) - greatest(x.a, y.a) > 1e-6""")
def adjacent_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, _ = topology.adjacency(*Bridge(spark, sf_dir).boundaries())
    return pairs.select("space_id", "adjacent_id", "subject_segment_id", "adjacent_segment_id", F.round("overlap", 6).alias("overlap"))


@query("adjacency_status", _SEGMENTS + """, c AS (SELECT s, count(*) AS total, count(*) FILTER (WHERE st = 'usable') AS usable, count(*) FILTER (WHERE st = 'nonlinear') AS nonlinear, count(*) FILTER (WHERE st = 'degenerate') AS degenerate, count(*) FILTER (WHERE st = 'unresolved') AS unresolved FROM k GROUP BY s),
w AS (SELECT s_suppkey, coalesce(total, 0) AS total, coalesce(usable, 0) AS usable, coalesce(nonlinear, 0) AS nonlinear, coalesce(degenerate, 0) AS degenerate, coalesce(unresolved, 0) AS unresolved,
  CASE WHEN s_suppkey % 10 = 0 THEN 'subject_level_unavailable' WHEN coalesce(usable, 0) = 0 THEN 'no_usable_outer_line_segments' WHEN usable < total THEN 'incomplete_boundary_coverage' END AS warning FROM supplier LEFT JOIN c ON s = s_suppkey)
SELECT 'room-' || s_suppkey AS space_id, CASE WHEN warning IS NULL THEN 'ok' WHEN warning = 'incomplete_boundary_coverage' THEN 'partial' ELSE 'insufficient_data' END AS status, warning, total, usable, nonlinear, degenerate, unresolved FROM w""")
def adjacency_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, report = topology.adjacency(*Bridge(spark, sf_dir).boundaries())
    return report.drop("link_instance_id")


@query("level_difference", """
WITH l AS (SELECT r_regionkey AS k, 'level-' || r_regionkey AS id, r_regionkey * 1000.0 AS el, CASE WHEN r_regionkey <> 3 THEN 'mm' END AS u, CASE WHEN r_regionkey <> 4 THEN 'host' END AS m FROM region)
SELECT a.id AS a, b.id AS b, CASE WHEN coalesce(a.m = b.m AND a.u = b.u, false) THEN 'ok' ELSE 'insufficient_data' END AS status, CASE WHEN a.m = b.m AND a.u = b.u THEN CAST(a.el - b.el AS DOUBLE) END AS signed_difference,
CASE WHEN a.m = b.m AND a.u = b.u THEN CAST(abs(a.el - b.el) AS DOUBLE) END AS absolute_difference, CASE WHEN a.m = b.m AND a.u = b.u THEN a.u END AS unit FROM l a JOIN l b ON a.k < b.k""")
def level_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = Bridge(spark, sf_dir).levels()
    ids = levels.select("id")
    pairs = ids.select(F.col("id").alias("a")).join(F.broadcast(ids.select(F.col("id").alias("b"))), F.col("a") < F.col("b"))  # five levels
    return topology.level_differences(levels, pairs)


@query("tiered_fact_resolution", """
WITH f AS (SELECT 'part-' || p_partkey AS id, 1 AS tier, 'k-' || p_partkey AS fid, CAST(p_size AS DOUBLE) AS v FROM part WHERE p_partkey % 4 = 0
UNION ALL SELECT 'part-' || p_partkey, 2, 'n-' || p_partkey, CAST(p_size + 1 AS DOUBLE) FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'part-' || p_partkey, 4, 't-' || p.p_type, t.v FROM part p JOIN (SELECT p_type, CAST(max(p_size) AS DOUBLE) AS v FROM part GROUP BY 1) t ON p.p_type = t.p_type WHERE p_partkey % 5 = 0
UNION ALL SELECT 'part-' || l_partkey, 5, 'd-' || l_orderkey || '-' || l_linenumber || '-' || l_suppkey, CAST(l_quantity AS DOUBLE) FROM lineitem WHERE l_partkey % 7 = 0),
b AS (SELECT f.* FROM f JOIN (SELECT id, min(tier) AS t FROM f GROUP BY 1) m ON f.id = m.id AND f.tier = m.t),
o AS (SELECT id, tier, count(DISTINCT v) AS nv, min(fid) AS fid, min(v) AS v FROM b GROUP BY 1, 2),
e AS (SELECT 'part-' || p_partkey AS id, 'part-' || (p_partkey + 1) AS t FROM part WHERE p_partkey % 2 = 1 UNION ALL SELECT 'part-' || p_partkey, 'part-' || (p_partkey + 4) FROM part WHERE p_partkey % 6 = 1),
h AS (SELECT e.id, count(*) AS n, min(e.t) AS t FROM e JOIN o ON e.t = o.id GROUP BY e.id),
r AS (SELECT 'part-' || p_partkey AS id, CASE WHEN d.tier <= 4 THEN 'd' WHEN h.n = 1 THEN 'h' WHEN h.n > 1 THEN 'm' WHEN d.tier = 5 THEN 'd' ELSE 'x' END AS way, h.t FROM part LEFT JOIN o d ON d.id = 'part-' || p_partkey LEFT JOIN h ON h.id = 'part-' || p_partkey)
SELECT r.id, CASE way WHEN 'd' THEN r.id WHEN 'h' THEN r.t END AS target_id, CASE way WHEN 'm' THEN 'ambiguous' WHEN 'x' THEN 'not_found' ELSE CASE WHEN o.nv > 1 THEN 'conflict' ELSE 'ok' END END AS status, o.tier, CASE WHEN o.nv = 1 THEN o.v END AS numeric_value
FROM r LEFT JOIN o ON o.id = CASE way WHEN 'd' THEN r.id WHEN 'h' THEN r.t END""")
def tiered_fact_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening widths of parts by built-in key, name, type name and drawn dimension, over one hop where none is direct."""
    b = Bridge(spark, sf_dir)
    part = b.raw("part").select("p_partkey", "p_type", "p_size")
    pid = lambda c: F.concat(F.lit("part-"), c.cast("string"))
    key = F.col("p_partkey")
    elements = part.select(pid(key).alias("id"), F.when(key % 5 == 0, F.col("p_type")).alias("type_id"))
    cols = ["id", "entity_kind", "entity_id", "scope", "definition_key", "definition_name", "numeric_value", "unit"]

    def parameter(rows: DataFrame, ident, kind: str, entity, scope: str, dkey: str | None, name: str, value) -> DataFrame:
        return rows.select(ident.alias("id"), F.lit(kind).alias("entity_kind"), entity.alias("entity_id"), F.lit(scope).alias("scope"), F.lit(dkey).cast("string").alias("definition_key"), F.lit(name).alias("definition_name"), value.cast("double").alias("numeric_value"), F.lit("mm").alias("unit")).select(*cols)

    parameters = parameter(part.filter(key % 4 == 0), F.concat(F.lit("k-"), key.cast("string")), "element", pid(key), "instance", "Builtin:DOOR_WIDTH", "Width", F.col("p_size"))
    parameters = parameters.unionByName(parameter(part.filter(key % 3 == 0), F.concat(F.lit("n-"), key.cast("string")), "element", pid(key), "instance", None, " Opening Width ", F.col("p_size") + 1))
    types = part.groupBy("p_type").agg(F.max("p_size").alias("v"))
    parameters = parameters.unionByName(parameter(types, F.concat(F.lit("t-"), "p_type"), "element_type", F.col("p_type"), "type", None, "opening_width", F.col("v")))
    drawn = b.raw("lineitem").filter(F.col("l_partkey") % 7 == 0).select(pid(F.col("l_partkey")).alias("entity_id"), F.concat_ws("-", F.lit("d"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_suppkey").cast("string")).alias("id"), F.lit("Opening_Width").alias("semantic_type"), F.col("l_quantity").cast("double").alias("numeric_value"), F.lit("mm").alias("unit"))
    edge = lambda rows, step: rows.select(F.lit("element").alias("source_kind"), pid(key).alias("source_id"), F.lit("has_opening").alias("relation_type"), F.lit("element").alias("target_kind"), pid(key + step).alias("target_id"))
    edges = edge(part.filter(key % 2 == 1), 1).unionByName(edge(part.filter(key % 6 == 1), 4))
    subjects = part.select(F.lit("element").alias("kind"), pid(key).alias("id"))
    return facts.opening_width(subjects, elements, parameters, drawn, edges).select("id", "target_id", "status", "tier", "numeric_value")


@query("fact_conflicts", """
WITH f AS (SELECT d.source, l.doc_id, l.quality + l.toxic AS v FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
SELECT source AS entity_id, CASE WHEN count(DISTINCT v) > 1 THEN 'conflict' ELSE 'ok' END AS status, CASE WHEN count(DISTINCT v) = 1 THEN min(lpad(CAST(doc_id AS VARCHAR), 9, '0')) END AS fact_id, count(*) AS n_facts FROM f GROUP BY source""")
def fact_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bridge(spark, sf_dir)
    rows = b.raw("labels").join(b.raw("documents").select("doc_id", "source"), "doc_id")
    found = rows.select(F.col("source").alias("entity_id"), F.lit(1).alias("tier"), F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("id"), (F.col("quality") + F.col("toxic")).cast("double").alias("numeric_value"), F.lit("mark").alias("unit"))
    return facts.settled(found).select("entity_id", "status", "fact_id", "n_facts")


@query("relative_elevation", """
WITH f AS (SELECT user_id, event_id, value, CASE event_id % 3 WHEN 0 THEN lower(event_type) WHEN 1 THEN NULL ELSE 'rfl' END AS d FROM events),
r AS (SELECT user_id, CASE WHEN count(DISTINCT d) = 0 THEN 'insufficient_data' WHEN count(DISTINCT d) > 1 THEN 'ambiguous' ELSE 'ok' END AS st, min(d) AS d FROM f GROUP BY 1)
SELECT CAST(r.user_id AS VARCHAR) AS entity_id, CASE WHEN st = 'ok' AND count(DISTINCT f.value) > 1 THEN 'conflict' ELSE st END AS status, CASE WHEN st = 'ok' THEN r.d END AS reference FROM r LEFT JOIN f ON f.user_id = r.user_id AND f.d = r.d GROUP BY r.user_id, st, r.d""")
def relative_elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Bridge(spark, sf_dir).raw("events")
    kind = F.col("event_id") % 3
    text = F.when(kind == 0, F.concat("event_type", F.lit(" + 5"))).when(kind == 1, F.lit("12 34")).otherwise("RFL - 3")
    rows = e.select(F.col("user_id").cast("string").alias("entity_id"), F.lit(1).alias("tier"), F.col("event_id").cast("string").alias("id"), F.col("value").alias("numeric_value"), F.lit("mm").alias("unit"), F.array(text, F.lit(None).cast("string")).alias("texts"))
    return facts.relative_elevation(rows).select("entity_id", "status", "reference")


_GEO = """
WITH g AS (SELECT vec_id, label, round(CAST(embedding[1] AS DOUBLE) * 1000, 3) AS sx, round(CAST(embedding[2] AS DOUBLE) * 1000, 3) AS sy, round(CAST(embedding[3] AS DOUBLE) * 1000, 3) AS sz, round(CAST(embedding[4] AS DOUBLE) * 1000, 3) AS tx, round(CAST(embedding[5] AS DOUBLE) * 1000, 3) AS ty, round(CAST(embedding[6] AS DOUBLE) * 1000, 3) AS tz FROM embeddings),
e AS (SELECT vec_id, label < 5 AS pt, sx, sy, sz, CASE WHEN label < 5 THEN sx ELSE tx END AS ex, CASE WHEN label < 5 THEN sy ELSE ty END AS ey, CASE WHEN label < 5 THEN sz ELSE tz END AS ez FROM g),
b AS (SELECT *, least(sx, ex) AS x0, greatest(sx, ex) AS x1, least(sy, ey) AS y0, greatest(sy, ey) AS y1, least(sz, ez) AS z0, greatest(sz, ez) AS z1 FROM e)"""


@query("spatial_candidates", _GEO + " SELECT vec_id FROM b WHERE x0 <= 60 AND x1 >= -40 AND y0 <= 80 AND y1 >= -50 AND z0 <= 100 AND z1 >= -100")
def spatial_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.candidates(Bridge(spark, sf_dir).geometries(), (-40.0, 60.0, -50.0, 80.0, -100.0, 100.0)).select("vec_id")


@query("spatial_box_join", _GEO + " SELECT l.vec_id AS l_vec_id, r.vec_id AS r_vec_id FROM b l JOIN b r ON l.x0 <= r.x1 AND l.x1 >= r.x0 AND l.y0 <= r.y1 AND l.y1 >= r.y0 AND l.z0 <= r.z1 AND l.z1 >= r.z0 AND l.vec_id < r.vec_id")
def spatial_box_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All boxes against each other, each pair once."""
    g = Bridge(spark, sf_dir).geometries().select("vec_id", *spatial.BOX)
    return spatial.box_join(g, g, 60.0).filter("l_vec_id < r_vec_id").select("l_vec_id", "r_vec_id")


@query("vertical_relation", _GEO + """ SELECT l.vec_id AS l_vec_id, r.vec_id AS r_vec_id, CASE WHEN l.z0 > r.z1 THEN 'above' WHEN l.z1 < r.z0 THEN 'below' ELSE 'indeterminate' END AS relation,
round(CASE WHEN l.z0 > r.z1 THEN l.z0 - r.z1 WHEN l.z1 < r.z0 THEN r.z0 - l.z1 END, 6) AS separation FROM b l JOIN b r ON r.vec_id = l.vec_id + 1""")
def vertical_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's box against the next one's."""
    g = Bridge(spark, sf_dir).geometries().drop("primitive")
    left = g.select(*[F.col(c).alias(f"l_{c}") for c in g.columns])
    right = g.select(*[F.col(c).alias(f"r_{c}") for c in g.columns])
    out = spatial.vertical(left.join(right, F.col("l_vec_id") + 1 == F.col("r_vec_id")))
    return out.select("l_vec_id", "r_vec_id", "relation", F.round("separation", 6).alias("separation"))


def _dist(a: str, b: str) -> str:
    """SQL for the distance of two primitives ``a`` and ``b`` with s, e ends (points have equal ends)."""

    def ps(p: str, pe: str, q: str) -> str:
        d = [f"({q}.e{c} - {q}.s{c})" for c in "xyz"]
        w = [f"({p}.{pe}{c} - {q}.s{c})" for c in "xyz"]
        size = " + ".join(f"{x} * {x}" for x in d)
        t = f"CASE WHEN ({size}) > 0 THEN greatest(0, least(1, ({' + '.join(f'{x} * {y}' for x, y in zip(w, d, strict=True))}) / nullif({size}, 0))) ELSE 0 END"
        return "sqrt(" + " + ".join(f"power({p}.{pe}{c} - ({q}.s{c} + {x} * ({t})), 2)" for c, x in zip("xyz", d, strict=True)) + ")"

    u, v, w = ([f"({e} - {s})" for e, s in zip(es, ss, strict=True)] for es, ss in (([f"{a}.e{c}" for c in "xyz"], [f"{a}.s{c}" for c in "xyz"]), ([f"{b}.e{c}" for c in "xyz"], [f"{b}.s{c}" for c in "xyz"]), ([f"{a}.s{c}" for c in "xyz"], [f"{b}.s{c}" for c in "xyz"])))
    dot = lambda p, q: "(" + " + ".join(f"{x} * {y}" for x, y in zip(p, q, strict=True)) + ")"
    uu, uv, vv, uw, vw = dot(u, u), dot(u, v), dot(v, v), dot(u, w), dot(v, w)
    den = f"({uu} * {vv} - {uv} * {uv})"
    s, t = f"(({uv} * {vw} - {vv} * {uw}) / {den})", f"(({uu} * {vw} - {uv} * {uw}) / {den})"
    inner = "sqrt(" + " + ".join(f"power({a}.s{c} + {x} * {s} - {b}.s{c} - {y} * {t}, 2)" for c, x, y in zip("xyz", u, v, strict=True)) + ")"
    inner = f"CASE WHEN {den} > 1e-15 * {uu} * {vv} THEN CASE WHEN {s} BETWEEN 0 AND 1 AND {t} BETWEEN 0 AND 1 THEN {inner} END END"
    return f"least({ps(a, 's', b)}, {ps(a, 'e', b)}, {ps(b, 's', a)}, {ps(b, 'e', a)}, coalesce({inner}, 1e300))"


@query("location_distance", _GEO + f""" SELECT l.vec_id AS a, r.vec_id AS b, round({_dist('l', 'r')}, 4) AS distance, CASE WHEN l.pt THEN 'point' ELSE 'line' END || '_to_' || CASE WHEN r.pt THEN 'point' ELSE 'line' END AS basis FROM b l JOIN b r ON r.vec_id = l.vec_id + 1""")
def location_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Bridge(spark, sf_dir).geometries()
    pairs = g.select(F.col("vec_id").alias("a_id"), F.col("primitive").alias("a")).join(g.select(F.col("vec_id").alias("b_id"), F.col("primitive").alias("b")), F.col("a_id") + 1 == F.col("b_id"))
    return spatial.distances(pairs).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), F.round("distance", 4).alias("distance"), "basis")


_NEAR = _GEO + f", n AS (SELECT l.vec_id AS a, r.vec_id AS b, {_dist('l', 'r')} AS d FROM b l JOIN b r ON l.vec_id <> r.vec_id AND l.x0 - 40 <= r.x1 AND l.x1 + 40 >= r.x0 AND l.y0 - 40 <= r.y1 AND l.y1 + 40 >= r.y0 AND l.z0 - 40 <= r.z1 AND l.z1 + 40 >= r.z0)"


@query("nearby", _NEAR + " SELECT a AS l_vec_id, b AS r_vec_id, round(d, 4) AS distance FROM n WHERE d <= 40")
def nearby(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.nearby(Bridge(spark, sf_dir).geometries(), 40.0, ["vec_id"]).select("l_vec_id", "r_vec_id", F.round("distance", 4).alias("distance"))


@query("nearest", _NEAR + ", r AS (SELECT a, b, d, row_number() OVER (PARTITION BY a ORDER BY round(d, 6), b) AS k FROM n WHERE d <= 40) SELECT a AS l_vec_id, b AS r_vec_id, round(d, 3) AS distance FROM r WHERE k = 1")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spatial.nearest_within(Bridge(spark, sf_dir).geometries(), 40.0, ["vec_id"], 6)
    return found.select("l_vec_id", "r_vec_id", F.round("distance", 3).alias("distance"))


@query("pair_cap", """
WITH d AS (SELECT l_orderkey AS g, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS item FROM lineitem), i AS (SELECT DISTINCT g % 200 AS g, item FROM d),
o AS (SELECT g, item, row_number() OVER (PARTITION BY g ORDER BY item) AS r FROM i), x AS (SELECT a.g, a.item AS a, b.item AS b FROM o a JOIN o b ON a.g = b.g AND b.r = a.r + 1 WHERE a.r <= 5 AND a.r % 2 = 1),
p AS (SELECT a.g, a.item AS a, b.item AS b, row_number() OVER (PARTITION BY a.g ORDER BY a.r, b.r) AS k FROM o a JOIN o b ON a.g = b.g AND a.r < b.r WHERE a.r <= 35 AND NOT EXISTS (SELECT 1 FROM x WHERE x.g = a.g AND x.a = a.item AND x.b = b.item))
SELECT g, a, b, CAST(k AS INTEGER) AS rank FROM p WHERE k <= 32""")
def pair_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-occurrence pairs of a group's items, without explicit ones, at most 32 a group (the cap is the feature)."""
    pairs, _ = topology.ordered_pairs(*_pairs(spark, sf_dir), "g", "item")
    return pairs


def _pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All line items, dealt into 200 groups."""
    line = Bridge(spark, sf_dir).raw("lineitem")
    items = line.select((F.col("l_orderkey") % 200).alias("g"), (F.col("l_partkey") * 100000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("item")).distinct()
    r = items.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("item"))).filter("r <= 6")
    nxt = F.lead("item").over(Window.partitionBy("g").orderBy("item"))
    explicit = r.withColumn("b", nxt).filter("r <= 5 and r % 2 = 1 and b is not null").select("g", F.col("item").alias("a"), "b")
    return items, explicit


@query("pair_cap_report", """
WITH i AS (SELECT DISTINCT l_orderkey % 200 AS g, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS item FROM lineitem),
n AS (SELECT g, count(*) AS n FROM i GROUP BY g), e AS (SELECT g, CAST(n * (n - 1) / 2 AS BIGINT) AS eligible, CASE WHEN n >= 6 THEN 3 WHEN n >= 4 THEN 2 WHEN n >= 2 THEN 1 ELSE 0 END AS x FROM n)
SELECT g, eligible, least(32, eligible - x) AS planned, eligible - least(32, eligible - x) AS omitted FROM e""")
def pair_cap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Omitted pairs are counted by formula."""
    _, report = topology.ordered_pairs(*_pairs(spark, sf_dir), "g", "item")
    return report

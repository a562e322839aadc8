"""Integrity rules over the star tables as records, with their SQL; derived values break each rule somewhere."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.operators import integrity
from plinth.plans.context_queries import Semantic
from plinth.sources.paper import LINE, SQL, Paper, key
from plinth.sources.schema import TABLES

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


class Records:
    """A store's tables by name, empty unless a method of that name derives them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.paper, self.semantic, self.spark = Paper(spark, sf_dir), Semantic(spark, sf_dir), spark

    def __call__(self, name: str) -> DataFrame:
        return getattr(self, name)() if hasattr(self, name) else self.spark.createDataFrame([], TABLES[name].struct())

    def source_models(self) -> DataFrame:
        """Regions as models; two of them claim to be the host."""
        return self.paper.raw("region").select(key("model", "r_regionkey").alias("id"), F.when(F.col("r_regionkey") < 2, "host").otherwise("link").alias("role"))

    def link_instances(self) -> DataFrame:
        n, k = self.paper.raw("nation"), F.col("n_nationkey")
        axis = '"basis_x":[1,0,0],"basis_y":[0,1,0],"basis_z":[0,0,1]'
        shape = F.when(k % 4 == 0, "{" + axis + ',"source_unit":"revit_internal"}').when(k % 5 == 0, "{" + axis + ',"origin":[0,0,0],"source_unit":"feet"}').otherwise("{" + axis + ',"origin":[0,0,0],"source_unit":"revit_internal"}')
        return n.select(key("link", "n_nationkey").alias("id"), F.concat(F.lit("model-"), (k % 3).cast("string")).alias("host_source_model_id"), key("model", "n_regionkey").alias("linked_source_model_id"), F.when(k % 9 != 0, F.col("n_name")).otherwise(" ").alias("source_unique_id"), shape.alias("transform_to_host_json"))

    def elements(self) -> DataFrame:
        p = self.paper.raw("part")
        return p.select(key("part", "p_partkey").alias("id"), F.concat(F.lit("model-"), (F.col("p_size") % 5).cast("string")).alias("source_model_id"))

    def spaces(self) -> DataFrame:
        s = self.paper.raw("supplier")
        return s.select(key("space", "s_suppkey").alias("id"), F.concat(F.lit("model-"), (F.col("s_nationkey") % 5).cast("string")).alias("source_model_id"))

    def levels(self) -> DataFrame:
        return self.paper.raw("region").select(key("level", "r_regionkey").alias("id"))

    def evidence(self) -> DataFrame:
        return self.paper.evidence()

    def semantic_bindings(self) -> DataFrame:
        return self.semantic.bindings()

    def semantic_properties(self) -> DataFrame:
        """A property per part, of the binding of its own evidence or, for small parts, of the next part's."""
        p = self.paper.raw("part")
        of = F.col("p_partkey") + F.when(F.col("p_size") < 5, 1).otherwise(0)
        return p.select(key("prop", "p_partkey").alias("id"), key("part", "p_partkey").alias("semantic_entity_id"), F.concat(F.lit("b-"), of.cast("string"), F.lit("-3")).alias("source_binding_id"), F.col("p_retailprice").alias("numeric_value"), F.when(F.col("p_size") != 9, "number").alias("unit"))

    def semantic_relationships(self) -> DataFrame:
        o = self.paper.raw("orders")
        return o.select(key("sr", "o_orderkey").alias("id"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("  ").alias("relation_type"))

    def geometries(self) -> DataFrame:
        """A location per part, a line for big ones; bounds that are too tight, missing or of another frame for some."""
        p = self.paper.raw("part").select("p_partkey", "p_size", "p_retailprice")
        x, size = F.col("p_retailprice"), F.col("p_size")
        point = F.concat(F.lit('{"point":['), x.cast("string"), F.lit(",0,0"), F.when(size == 11, ",1").otherwise(""), F.lit("]}"))
        line = F.concat(F.lit('{"start":['), x.cast("string"), F.lit(',0,0],"end":['), (x + size).cast("string"), F.lit(",0,0]}"))
        big = size > 25
        return p.select(
            key("geo", "p_partkey").alias("id"), F.lit("element").alias("entity_kind"), key("part", "p_partkey").alias("entity_id"), F.when(size % 2 == 0, F.concat(F.lit("link-"), (F.col("p_partkey") % 25).cast("string"))).alias("link_instance_id"),
            F.when(big, "line").otherwise("point").alias("geometry_type"), F.when(big, line).otherwise(point).alias("geometry_json"), F.when(size == 13, "elsewhere").otherwise(integrity.FRAME).alias("coordinate_system"), F.when(size == 14, "m").otherwise("mm").alias("unit"),
            x.alias("min_x"), F.when(size == 30, x).otherwise(x + size).alias("max_x"), F.lit(0.0).alias("min_y"), F.lit(0.0).alias("max_y"), F.when(size == 31, 1.0).otherwise(0.0).alias("min_z"), F.when(size == 32, F.lit(None).cast("double")).otherwise(2.0).alias("max_z"),
        )

    def entity_appearances(self) -> DataFrame:
        line = self.paper.raw("lineitem")
        return line.select(
            key("app", *LINE).alias("id"), F.when(F.col("l_linenumber") == 7, "space").otherwise("element").alias("entity_kind"), key("part", "l_partkey").alias("entity_id"), F.when(F.col("l_returnflag") == "R", F.concat(F.lit("link-"), (F.col("l_suppkey") % 25).cast("string"))).alias("link_instance_id"),
            (F.col("l_linenumber") - 1).alias("pdf_page"), F.lit(0.0).alias("x_min"), F.lit(0.0).alias("y_min"), F.when(F.col("l_quantity") != 2, F.col("l_quantity") - 4).alias("x_max"), F.lit(1.0).alias("y_max"),
        )

    def annotation_references(self) -> DataFrame:
        """Line items as references: returned ones are linked and resolved, some without a name."""
        line = self.paper.raw("lineitem")
        linked = F.col("l_returnflag") == "R"
        return line.select(
            key("aref", *LINE).alias("id"), key("note", "l_orderkey").alias("annotation_id"), F.col("l_linenumber").alias("reference_index"), F.concat(F.lit("model-"), (F.col("l_partkey") % 5).cast("string")).alias("target_source_model_id"), F.when(F.col("l_quantity") != 1, F.lit("u")).otherwise("").alias("target_source_unique_id"),
            F.when(linked & (F.col("l_quantity") < 49), F.concat(F.lit("link-"), (F.col("l_suppkey") % 25).cast("string"))).alias("target_link_instance_id"), linked.cast("int").alias("is_linked"), F.when(linked, "resolved").otherwise("unresolved").alias("resolution_state"),
        )

    def spatial_boundaries(self) -> DataFrame:
        s = self.paper.raw("supplier")
        return s.select(key("loop", "s_suppkey").alias("id"), key("space", "s_suppkey").alias("space_id"), F.when(F.col("s_suppkey") % 3 == 0, key("link", "s_nationkey")).alias("link_instance_id"), (F.col("s_suppkey") % 2).alias("loop_index"))

    def spatial_boundary_segments(self) -> DataFrame:
        line = self.paper.raw("lineitem")
        own = F.when(F.col("l_suppkey") % 3 == 0, F.when(F.col("l_linestatus") == "O", F.concat(F.lit("link-"), (F.col("l_partkey") % 25).cast("string"))))
        return line.select(
            key("seg", *LINE).alias("id"), key("loop", "l_suppkey").alias("boundary_id"), F.col("l_linenumber").alias("segment_index"), own.alias("link_instance_id"), F.when(F.col("l_quantity") != 10, F.concat(F.lit("model-"), (F.col("l_partkey") % 5).cast("string"))).alias("source_model_id"),
            F.when(F.col("l_quantity") != 11, F.lit("u")).alias("source_unique_id"), F.when(F.col("l_returnflag") == "A", F.concat(F.lit("link-"), (F.col("l_partkey") % 25).cast("string"))).alias("source_link_instance_id"),
        )


_RECORDS = SQL + """,
mo AS (SELECT 'model-' || r_regionkey AS id, CASE WHEN r_regionkey < 2 THEN 'host' ELSE 'link' END AS role FROM region),
li AS (SELECT 'link-' || n_nationkey AS id, n_nationkey AS k, 'model-' || (n_nationkey % 3) AS host, 'model-' || n_regionkey AS linked, CASE WHEN n_nationkey % 9 <> 0 THEN n_name ELSE ' ' END AS uid FROM nation),
el AS (SELECT 'part-' || p_partkey AS id, 'model-' || (p_size % 5) AS model FROM part), sp AS (SELECT 'space-' || s_suppkey AS id, 'model-' || (s_nationkey % 5) AS model FROM supplier),
bo AS (SELECT 'loop-' || s_suppkey AS id, 'space-' || s_suppkey AS space, CASE WHEN s_suppkey % 3 = 0 THEN 'link-' || s_nationkey END AS link, s_suppkey % 2 AS i FROM supplier),
se AS (SELECT k AS id, 'loop-' || l_suppkey AS loop_, CASE WHEN l_suppkey % 3 = 0 AND l_linestatus = 'O' THEN 'link-' || (l_partkey % 25) END AS link, CASE WHEN l_quantity <> 10 THEN 'model-' || (l_partkey % 5) END AS model, CASE WHEN l_quantity <> 11 THEN 'u' END AS uid, CASE WHEN l_returnflag = 'A' THEN 'link-' || (l_partkey % 25) END AS slink FROM item),
ar AS (SELECT k AS id, l_orderkey, l_linenumber, 'model-' || (l_partkey % 5) AS model, CASE WHEN l_quantity <> 1 THEN 'u' ELSE '' END AS uid, CASE WHEN l_returnflag = 'R' AND l_quantity < 49 THEN 'link-' || (l_suppkey % 25) END AS link, l_returnflag = 'R' AS linked FROM item)
"""


@query("model_rules", _RECORDS + """
SELECT 'one_host_model' AS rule, 'source_models' AS table_name, CAST(count(*) AS VARCHAR) AS id FROM mo WHERE role = 'host' HAVING count(*) <> 1
UNION ALL SELECT 'link_host_role', 'link_instances', li.id FROM li LEFT JOIN mo ON li.host = mo.id WHERE mo.role IS DISTINCT FROM 'host'
UNION ALL SELECT 'link_linked_role', 'link_instances', li.id FROM li LEFT JOIN mo ON li.linked = mo.id WHERE mo.role IS DISTINCT FROM 'link'
UNION ALL SELECT 'link_unique_id', 'link_instances', id FROM li WHERE trim(uid) = ''
UNION ALL SELECT 'link_transform', 'link_instances', id FROM li WHERE k % 4 = 0 OR k % 5 = 0""")
def model_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.all_of(integrity.models(Records(spark, sf_dir)))


@query("link_rules", _RECORDS + """
SELECT 'geometry_link_model' AS rule, 'geometries' AS table_name, 'geo-' || p_partkey AS id FROM part JOIN el ON el.id = 'part-' || p_partkey JOIN li ON p_size % 2 = 0 AND li.id = 'link-' || (p_partkey % 25) WHERE el.model <> li.linked
UNION ALL SELECT 'appearance_link_model', 'entity_appearances', 'app-' || i.k FROM item i JOIN li ON l_returnflag = 'R' AND li.id = 'link-' || (l_suppkey % 25) LEFT JOIN el ON el.id = 'part-' || l_partkey WHERE l_linenumber = 7 OR el.id IS NULL OR el.model <> li.linked
UNION ALL SELECT 'linked_reference_incomplete', 'annotation_references', 'aref-' || id FROM ar WHERE linked AND (uid = '' OR link IS NULL)
UNION ALL SELECT 'reference_link_model', 'annotation_references', 'aref-' || ar.id FROM ar JOIN li ON ar.link = li.id WHERE ar.model <> li.linked
UNION ALL SELECT 'linked_space_without_link', 'spatial_boundaries', bo.id FROM bo JOIN sp ON bo.space = sp.id JOIN mo ON sp.model = mo.id WHERE bo.link IS NULL AND mo.role = 'link'
UNION ALL SELECT 'boundary_link_model', 'spatial_boundaries', bo.id FROM bo JOIN sp ON bo.space = sp.id JOIN li ON bo.link = li.id WHERE sp.model <> li.linked
UNION ALL SELECT 'segment_link', 'spatial_boundary_segments', 'seg-' || se.id FROM se JOIN bo ON se.loop_ = bo.id WHERE se.link IS DISTINCT FROM bo.link
UNION ALL SELECT 'segment_source_incomplete', 'spatial_boundary_segments', 'seg-' || se.id FROM se JOIN bo ON se.loop_ = bo.id WHERE (model IS NULL) <> (uid IS NULL)
UNION ALL SELECT 'segment_source_model', 'spatial_boundary_segments', 'seg-' || se.id FROM se JOIN bo ON se.loop_ = bo.id JOIN sp ON bo.space = sp.id WHERE se.slink IS NULL AND se.model IS NOT NULL AND se.model <> sp.model
UNION ALL SELECT 'segment_source_link_model', 'spatial_boundary_segments', 'seg-' || se.id FROM se JOIN bo ON se.loop_ = bo.id JOIN li ON se.slink = li.id WHERE se.model IS DISTINCT FROM li.linked""")
def link_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records placed through a link that belong to another model than the linked one, and their kin."""
    return integrity.all_of(integrity.links(Records(spark, sf_dir)))


@query("binding_rules", _RECORDS + """,
b AS (SELECT 'b-' || p_partkey || '-0' AS id, 'element' AS kind, p_partkey AS k, p_size > 10 AS ok FROM part UNION ALL SELECT 'b-' || p_partkey || '-1', 'space', p_partkey, true FROM part UNION ALL SELECT 'b-' || p_partkey || '-2', 'level', p_partkey, true FROM part UNION ALL SELECT 'b-' || p_partkey || '-3', 'evidence', p_partkey, p_size <= 25 FROM part)
SELECT 'binding_source_' || kind AS rule, 'semantic_bindings' AS table_name, id FROM b WHERE ok AND (kind = 'space' AND k % 30 NOT IN (SELECT s_suppkey FROM supplier) OR kind = 'level' AND k % 7 NOT IN (SELECT r_regionkey FROM region) OR kind = 'evidence' AND k NOT IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'property_binding_owner', 'semantic_properties', 'prop-' || p_partkey FROM part WHERE p_size < 5 AND p_partkey + 1 IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'relation_type_blank', 'semantic_relationships', 'sr-' || o_orderkey FROM orders WHERE o_orderpriority = '5-LOW'""")
def binding_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.all_of(integrity.bindings(Records(spark, sf_dir)))


@query("value_rules", _RECORDS + """
SELECT 'page_number' AS rule, 'entity_appearances' AS table_name, 'app-' || k AS id FROM item WHERE l_linenumber - 1 < 1
UNION ALL SELECT 'bbox', 'entity_appearances', 'app-' || k FROM item WHERE l_quantity = 2 OR l_quantity - 4 < 0
UNION ALL SELECT 'number_without_unit', 'semantic_properties', 'prop-' || p_partkey FROM part WHERE p_size = 9""")
def value_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.all_of(integrity.values(Records(spark, sf_dir)))


@query("geometry_rules", """
SELECT 'geometry_frame' AS rule, 'geometries' AS table_name, 'geo-' || p_partkey AS id FROM part WHERE p_size IN (13, 14)
UNION ALL SELECT 'location_malformed', 'geometries', 'geo-' || p_partkey FROM part WHERE p_size = 11
UNION ALL SELECT 'bounds_not_finite', 'geometries', 'geo-' || p_partkey FROM part WHERE p_size = 32
UNION ALL SELECT 'bounds_do_not_enclose', 'geometries', 'geo-' || p_partkey FROM part WHERE p_size IN (30, 31)""")
def geometry_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations in another frame or unit, malformed, without bounds, or outside of them."""
    return integrity.all_of(integrity.geometry(Records(spark, sf_dir)))


@query("numbering_rules", _RECORDS + """
SELECT 'contiguous_order' AS rule, 'annotation_references' AS table_name, 'note-' || l_orderkey AS id FROM ar GROUP BY l_orderkey HAVING min(l_linenumber) <> 0 OR max(l_linenumber) <> count(*) - 1 OR count(DISTINCT l_linenumber) <> count(*)
UNION ALL SELECT 'contiguous_order', 'spatial_boundaries', space || '|' || coalesce(link, '') FROM bo WHERE i <> 0
UNION ALL SELECT 'contiguous_order', 'spatial_boundary_segments', 'loop-' || l_suppkey FROM item GROUP BY l_suppkey HAVING min(l_linenumber) <> 0 OR max(l_linenumber) <> count(*) - 1 OR count(DISTINCT l_linenumber) <> count(*)""")
def numbering_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.all_of(integrity.numbered(Records(spark, sf_dir)))


class Cached(Records):
    """Documents as a store of text alone, out of step here and there."""

    def documents(self) -> DataFrame:
        return self.paper.documents()

    def pdf_pages(self) -> DataFrame:
        return self.paper.pages()

    def evidence(self) -> DataFrame:
        return self.paper.evidence()

    def pdf_text_blocks(self) -> DataFrame:
        """A block per order; low priority has no text, high prices share the evidence of the order before."""
        o = self.paper.raw("orders")
        ev = F.concat(F.lit("ev-"), (F.col("o_orderkey") - F.when(F.col("o_totalprice") > 450000, 1).otherwise(0)).cast("string"))
        box = F.col("o_orderstatus") != "P"
        return o.select(
            key("block", "o_orderkey").alias("id"), key("page", "o_orderkey").alias("page_id"), F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority")).alias("text"), ev.alias("evidence_id"), F.lit("pdf_points_top_left").alias("coordinate_space"),
            F.when(box, 0.0).alias("x_min"), F.when(box, 0.0).alias("y_min"), F.when(box, F.col("o_totalprice")).alias("x_max"), F.when(box, F.when(F.col("o_totalprice") < 3000, 11.0).otherwise(10.0)).alias("y_max"),
        )

    def search_content(self) -> DataFrame:
        """Text of blocks but for urgent ones; not specified priorities are changed, the cheapest are of another kind."""
        o = self.paper.raw("orders").filter("o_orderpriority <> '1-URGENT'")
        return o.select(F.when(F.col("o_totalprice") < 2000, "note").otherwise("pdf_text_block").alias("record_kind"), key("block", "o_orderkey").alias("record_id"), F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "4").otherwise(F.col("o_orderpriority")).alias("content"))


@query("cached_text_rules", SQL + """,
b AS (SELECT o.*, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS text, 'ev-' || (o_orderkey - CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END) AS ev FROM orders o),
c AS (SELECT o_orderkey, CASE WHEN o_totalprice < 2000 THEN 'note' ELSE 'pdf_text_block' END AS kind, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '4' ELSE o_orderpriority END AS content FROM orders WHERE o_orderpriority <> '1-URGENT')
SELECT 'search_content_odd' AS rule, 'search_content' AS table_name, 'block-' || c.o_orderkey AS id FROM c JOIN b ON c.o_orderkey = b.o_orderkey WHERE kind <> 'pdf_text_block' OR b.text = '' OR c.content <> b.text
UNION ALL SELECT 'search_content_missing', 'pdf_text_blocks', 'block-' || o_orderkey FROM b WHERE text <> '' AND o_orderkey NOT IN (SELECT o_orderkey FROM c WHERE kind = 'pdf_text_block')
UNION ALL SELECT 'evidence_of_several_blocks', 'pdf_text_blocks', ev FROM b GROUP BY ev HAVING count(*) <> 1
UNION ALL SELECT 'evidence_without_block', 'evidence', id FROM ev WHERE id NOT IN (SELECT ev FROM b)
UNION ALL SELECT 'block_evidence_differs', 'pdf_text_blocks', 'block-' || b.o_orderkey FROM b JOIN ev e ON b.ev = e.id WHERE e.document_id <> 'doc-' || b.o_custkey OR e.pdf_page <> b.o_orderkey % 50 + 1
  OR e.x_max IS DISTINCT FROM CASE WHEN b.o_orderstatus <> 'P' THEN b.o_totalprice END OR e.y_max IS DISTINCT FROM CASE WHEN b.o_orderstatus <> 'P' THEN CASE WHEN b.o_totalprice < 3000 THEN 11.0 ELSE 10.0 END END
UNION ALL SELECT 'document_without_pages', 'documents', id FROM doc WHERE id NOT IN (SELECT document_id FROM page)""")
def cached_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What keeps a store of documents from being updated in place."""
    return integrity.all_of(integrity.cached_text(Cached(spark, sf_dir)))


@query("first_breach", "SELECT 1 AS found")
def first_breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether there is any breach of the geometry rules; one row, found or not."""
    found = reduce(DataFrame.unionByName, integrity.geometry(Records(spark, sf_dir))).limit(1)
    return found.agg(F.count("*").cast("int").alias("found"))

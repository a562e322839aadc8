"""The plain star tables seen as a knowledge store, so that every operator can run on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.session import table


def _id(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"{kind}-"), F.col(key).cast("string"))


class Bridge:
    """Store tables over a folder of Parquet tables; every method is lazy and reads only the columns it needs."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def levels(self) -> DataFrame:
        r = self.raw("region")
        return r.select(_id("level", "r_regionkey").alias("id"), F.col("r_name").alias("name"), (F.col("r_regionkey") * 1000.0).alias("elevation"), F.when(F.col("r_regionkey") != 3, "mm").alias("unit"), F.when(F.col("r_regionkey") != 4, "host").alias("source_model_id"))

    def spaces(self) -> DataFrame:
        n = self.raw("nation")
        return n.select(_id("space", "n_nationkey").alias("id"), F.lit("Room").alias("kind"), F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("number"), _id("level", "n_regionkey").alias("level_id"), F.lit("host").alias("source_model_id"), F.lit("phase").alias("phase_source_unique_id"))

    def element_types(self) -> DataFrame:
        p = self.raw("part").select("p_brand", "p_type").distinct()
        return p.select(F.concat_ws("/", "p_brand", "p_type").alias("id"), F.col("p_brand").alias("family_name"), F.col("p_type").alias("type_name"), F.lit("part").alias("category"))

    def elements(self) -> DataFrame:
        none, given = F.lit(None).cast("string"), [F.lit("given").alias("provenance"), F.lit(1.0).alias("confidence")]
        p = self.raw("part").select(_id("part", "p_partkey").alias("id"), F.col("p_name").alias("name"), F.lit("part").alias("category"), F.concat_ws("/", "p_brand", "p_type").alias("type_id"), none.alias("space_id"), *given)
        c = self.raw("customer").select(_id("customer", "c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("category"), none.alias("type_id"), _id("space", "c_nationkey").alias("space_id"), *given)
        s = self.raw("supplier").select(_id("supplier", "s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("category"), none.alias("type_id"), _id("space", "s_nationkey").alias("space_id"), *given)
        return p.unionByName(c).unionByName(s)

    def contained_edges(self) -> DataFrame:
        """Suppliers contained in the next nation, twice over where the key divides by three; one in five elsewhere."""
        s = self.raw("supplier").filter("s_suppkey % 2 = 0 or s_suppkey % 3 = 0")
        copies = F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        s = s.withColumn("copy", F.explode(copies))
        return s.select(
            F.concat_ws("-", F.lit("in"), F.col("s_suppkey").cast("string"), F.col("copy").cast("string")).alias("id"), F.lit("element").alias("source_kind"), _id("supplier", "s_suppkey").alias("source_id"), F.lit("contained_in").alias("relation_type"), F.lit("space").alias("target_kind"),
            F.concat(F.lit("space-"), ((F.col("s_nationkey") + 1) % 30).cast("string")).alias("target_id"), F.lit("p1").alias("phase_source_unique_id"), F.lit("given").alias("provenance"), F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("evidence_id"),
        )

    def side_edges(self) -> DataFrame:
        """From/to sides of parts: from the supplier's nation to the customer's, phase by shipping year, none if returned."""
        line = self.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")
        rows = line.join(self.raw("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(self.raw("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(self.raw("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        sides = F.array(F.struct(F.lit("from_space").alias("k"), F.col("s_nationkey").alias("n")), F.struct(F.lit("to_space").alias("k"), F.col("c_nationkey").alias("n")))
        rows = rows.withColumn("side", F.explode(sides))
        return rows.select(
            F.concat_ws("-", "side.k", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("id"), F.lit("element").alias("source_kind"), _id("part", "l_partkey").alias("source_id"), F.col("side.k").alias("relation_type"), F.lit("space").alias("target_kind"),
            F.concat(F.lit("space-"), F.col("side.n").cast("string")).alias("target_id"), F.when(F.col("l_returnflag") != "R", F.year("l_shipdate").cast("string")).alias("phase_source_unique_id"), F.lit("given").alias("provenance"), F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("evidence_id"),
        )

    def order_edges(self) -> DataFrame:
        """order placed_by customer, customer served_by the customer of half its key (a loop for the first)."""
        cols = ["id", "source_kind", "source_id", "relation_type", "target_kind", "target_id", "phase_source_unique_id", "provenance", "confidence", "evidence_id"]
        rest = [F.lit(None).cast("string").alias("phase_source_unique_id"), F.lit("given").alias("provenance"), F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("evidence_id")]
        a = self.raw("orders").select(_id("placed", "o_orderkey").alias("id"), F.lit("order").alias("source_kind"), _id("order", "o_orderkey").alias("source_id"), F.lit("placed_by").alias("relation_type"), F.lit("element").alias("target_kind"), _id("customer", "o_custkey").alias("target_id"), *rest)
        half = F.concat(F.lit("customer-"), F.greatest(F.expr("c_custkey div 2"), F.lit(1)).cast("string"))
        b = self.raw("customer").select(_id("served", "c_custkey").alias("id"), F.lit("element").alias("source_kind"), _id("customer", "c_custkey").alias("source_id"), F.lit("served_by").alias("relation_type"), F.lit("element").alias("target_kind"), half.alias("target_id"), *rest)
        return a.select(*cols).unionByName(b.select(*cols))

    def parameters(self) -> DataFrame:
        def of(df: DataFrame, kind: str, key: str, names: list[tuple[str, str]]) -> DataFrame:
            facts = F.explode(F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).cast("double").alias("v"), F.lit(u).alias("u")) for c, u in names])).alias("f")
            rows = df.select(_id(kind, key).alias("entity_id"), facts)
            return rows.select(F.concat_ws(":", "entity_id", "f.n").alias("id"), F.lit("element").alias("entity_kind"), "entity_id", F.lit("instance").alias("scope"), F.col("f.n").alias("definition_name"), F.col("f.v").alias("numeric_value"), F.col("f.u").alias("unit"))

        p = of(self.raw("part"), "part", "p_partkey", [("p_size", "mm"), ("p_retailprice", "number")])
        c = of(self.raw("customer"), "customer", "c_custkey", [("c_acctbal", "number")])
        return p.unionByName(c).unionByName(of(self.raw("supplier"), "supplier", "s_suppkey", [("s_acctbal", "number")]))

    def semantic_entities(self) -> DataFrame:
        p = self.raw("part")
        return p.select(_id("part", "p_partkey").alias("id"), F.when(F.col("p_size") > 25, "Equipment").otherwise("Door").alias("entity_class"), F.col("p_name").alias("label"), F.col("p_partkey").cast("string").alias("number"))

    def semantic_properties(self) -> DataFrame:
        facts = F.explode(F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).cast("string").alias("v")) for c in ("p_brand", "p_type", "p_size")])).alias("f")
        rows = self.raw("part").select(_id("part", "p_partkey").alias("semantic_entity_id"), facts)
        return rows.select(F.concat_ws(":", "semantic_entity_id", "f.n").alias("id"), "semantic_entity_id", F.col("f.n").alias("source_name"), F.col("f.v").alias("source_value"))

    def appearances(self, *more: str) -> DataFrame:
        """Line items as occurrences of parts: document order, page line number, box from quantity; some without box.

        ``more`` are columns of the line items to keep beside."""
        line = self.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
        box = F.col("l_returnflag") != "N"
        return line.select(
            F.concat_ws("-", F.lit("app"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("id"), F.lit("element").alias("entity_kind"), _id("part", "l_partkey").alias("entity_id"),
            _id("order", "l_orderkey").alias("document_id"), F.col("l_linenumber").alias("pdf_page"), F.when(box, F.col("l_quantity")).alias("x_min"), F.when(box, F.lit(0.0)).alias("y_min"), F.when(box, F.col("l_quantity") + 10).alias("x_max"), F.when(box, F.lit(5.0)).alias("y_max"),
            F.when(box, "exact").otherwise("page_only").alias("bbox_quality"), F.lit("model").alias("appearance_kind"), *more,
        )

    def documents(self) -> DataFrame:
        d = self.raw("documents")
        return d.select("doc_id", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("identity"), F.sha2("text", 256).alias("source_sha256"), "text", "lang", "source")

    def lines(self) -> DataFrame:
        """Lines of documents with their place."""
        d = self.documents().select("doc_id", "identity", "source_sha256", F.posexplode(F.split("text", "\n")).alias("order_index", "text"))
        return d.withColumn("id", F.concat_ws("-", F.col("doc_id").cast("string"), F.col("order_index").cast("string")))

    def geometries(self) -> DataFrame:
        """Embeddings as geometry in units of a thousand: label 0 to 4 a point of dims 1-3, else a line to dims 4-6."""
        e = self.raw("embeddings")
        at = lambda i: F.round(F.element_at("embedding", i).cast("double") * 1000, 3)
        s, t = [at(i) for i in (1, 2, 3)], [at(i) for i in (4, 5, 6)]
        point = F.col("label") < 5
        end = [F.when(point, a).otherwise(b) for a, b in zip(s, t, strict=True)]
        rows = e.select("vec_id", F.when(point, "point").otherwise("line").alias("kind"), *[c.alias(f"s{n}") for c, n in zip(s, "xyz", strict=True)], *[c.alias(f"e{n}") for c, n in zip(end, "xyz", strict=True)])
        return rows.select("vec_id", F.struct("kind", F.struct(*[F.col(f"s{n}").alias(n) for n in "xyz"]).alias("s"), F.struct(*[F.col(f"e{n}").alias(n) for n in "xyz"]).alias("e")).alias("primitive"), *[f(f"s{n}", f"e{n}").alias(f"{m}_{n}") for n in "xyz" for m, f in (("min", F.least), ("max", F.greatest))])

    def boundaries(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Spaces (suppliers), one outer loop each, and segments from line items: source part, along x or (open) y."""
        spaces = self.raw("supplier").select(_id("room", "s_suppkey").alias("id"), F.lit("host").alias("source_model_id"), F.when(F.col("s_suppkey") % 10 != 0, (F.col("s_suppkey") % 2).cast("string")).alias("level_id"), F.lit("phase").alias("phase_source_unique_id"))
        loops = self.raw("supplier").select(_id("loop", "s_suppkey").alias("id"), _id("room", "s_suppkey").alias("space_id"), F.lit(None).cast("string").alias("link_instance_id"), F.lit("outer").alias("loop_kind"))
        line = self.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus", "l_returnflag")
        up = F.col("l_linestatus") == "O"
        zero = F.lit(0.0)
        a, b = F.col("l_quantity").cast("double"), (F.col("l_quantity") + F.col("l_linenumber") * 4).cast("double")
        segments = line.select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("id"), _id("loop", "l_suppkey").alias("boundary_id"), F.lit(None).cast("string").alias("link_instance_id"),
            F.when(up, zero).otherwise(a).alias("start_x"), F.when(up, a).otherwise(zero).alias("start_y"), zero.alias("start_z"), F.when(up, zero).otherwise(b).alias("end_x"), F.when(up, b).otherwise(zero).alias("end_y"), zero.alias("end_z"),
            F.lit("model").alias("source_model_id"), F.when(F.col("l_partkey") % 50 != 0, F.col("l_partkey").cast("string")).alias("source_unique_id"), F.lit(None).cast("string").alias("source_link_instance_id"), F.when(F.col("l_returnflag") == "A", "arc").otherwise("line").alias("curve_kind"),
        )
        return spaces, loops, segments

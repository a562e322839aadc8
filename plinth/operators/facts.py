"""Tiered fact resolution that reports ambiguity and conflict instead of guessing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions.text import datum, plain

#: Names and kinds that count as an opening width (fixed values).
OPENING_NAMES = ("opening_width", "opening width")
OPENING_KEY = "builtin:door_width"
OPENING_RELATIONS = ("served_by", "related_opening", "has_opening", "opens_with")
ELEVATION_NAMES = ("relative_elevation", "relative elevation", "elevation_relative_to_datum")


def best_tier(facts: DataFrame, key: str = "entity_id") -> DataFrame:
    """The rows of each entity's lowest tier of ``facts(entity_id, tier, id, numeric_value, unit)``."""
    least = facts.groupBy(key).agg(F.min("tier").alias("tier"))
    return facts.join(least, [key, "tier"])


def settled(facts: DataFrame, key: str = "entity_id") -> DataFrame:
    """``(key, tier, status, fact_id, numeric_value, unit, n_facts)``: the fact of the smallest id, or ``conflict`` where
    (value, unit) pairs differ."""
    pair = F.struct("numeric_value", "unit")
    out = facts.groupBy(key, "tier").agg(F.min(pair).alias("a"), F.max(pair).alias("b"), F.min(F.struct("id", "numeric_value", "unit")).alias("chosen"), F.count("*").alias("n_facts"))
    one = F.col("a") == F.col("b")
    return out.select(key, "tier", F.when(one, "ok").otherwise("conflict").alias("status"), *[F.when(one, F.col(f"chosen.{c}")).alias(n) for c, n in (("id", "fact_id"), ("numeric_value", "numeric_value"), ("unit", "unit"))], "n_facts")


def opening_facts(elements: DataFrame, parameters: DataFrame, dimensions: DataFrame) -> DataFrame:
    """Width facts of elements by tier: instance key, instance name, type key, type name, dimension.

    ``dimensions(entity_id, id, semantic_type, numeric_value, unit)``.
    """
    numbers = parameters.filter("numeric_value is not null")
    key, name = F.lower(F.coalesce("definition_key", F.lit(""))) == OPENING_KEY, plain(F.col("definition_name")).isin(*OPENING_NAMES)
    own = numbers.filter("entity_kind = 'element' and scope = 'instance'").withColumn("tier", F.when(key, 1).when(name, 2))
    own = own.join(elements.select(F.col("id").alias("entity_id")), "entity_id", "left_semi")
    typed = numbers.filter("entity_kind = 'element_type' and scope = 'type'").withColumn("tier", F.when(key, 3).when(name, 4)).withColumnRenamed("entity_id", "type_id")
    typed = elements.select(F.col("id").alias("entity_id"), "type_id").join(typed, "type_id")
    drawn = dimensions.filter((plain(F.col("semantic_type")) == "opening_width") & F.col("numeric_value").isNotNull()).withColumn("tier", F.lit(5))
    cols = ["entity_id", "tier", "id", "numeric_value", "unit"]
    return reduce(DataFrame.unionByName, [x.filter("tier is not null").select(*cols) for x in (own, typed, drawn)])


def opening_width(subjects: DataFrame, elements: DataFrame, parameters: DataFrame, dimensions: DataFrame, relationships: DataFrame) -> DataFrame:
    """``(kind, id, target_id, status, tier, fact_id, numeric_value, unit, candidate_ids, path)`` for ``subjects(kind, id)``.

    Direct parameters win; else the one related opening that has a fact, over one hop; several are ``ambiguous`` and
    named as ``candidate_ids``; an own dimension is the last resort. ``path`` has the relationships of the way taken
    (or of all ways, if ambiguous).

    Every way that leads from a subject to a fact is one row: the direct one and those over a hop. The settled facts of
    elements are joined to them once, and one aggregation per subject picks the way.
    """
    own = settled(best_tier(opening_facts(elements, parameters, dimensions))).withColumnRenamed("entity_id", "target_id")
    direct = subjects.filter("kind = 'element'").select("kind", "id", F.col("id").alias("target_id"), F.lit(0).alias("hop"), F.lit(None).cast("string").alias("relationship_id"))
    named = relationships if "id" in relationships.columns else relationships.withColumn("id", F.lit(None).cast("string"))
    edges = named.filter(F.col("relation_type").isin(*OPENING_RELATIONS) & (F.col("target_kind") == "element"))
    edges = edges.select(F.col("source_kind").alias("kind"), F.col("source_id").alias("id"), "target_id", F.lit(1).alias("hop"), F.col("id").alias("relationship_id"))
    ways = direct.unionByName(edges).groupBy("kind", "id", "target_id", "hop").agg(F.array_sort(F.collect_set("relationship_id")).alias("relationships"))
    facts = ways.join(own, "target_id")
    way = F.struct("target_id", "status", "tier", "fact_id", "numeric_value", "unit", "relationships")
    is_hop = F.col("hop") == 1
    found = facts.groupBy("kind", "id").agg(
        F.min(F.when(~is_hop, way)).alias("own"), F.min(F.when(is_hop, way)).alias("hop"), F.array_sort(F.collect_set(F.when(is_hop, F.col("target_id")))).alias("targets"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(is_hop, F.col("relationships")))))).alias("all"),
    )
    rows = subjects.join(found, ["kind", "id"], "left")
    hops = F.coalesce(F.size("targets"), F.lit(0))
    sure = F.coalesce(F.col("own.tier") <= 4, F.lit(False))
    chosen = F.when(sure, F.col("own")).when(hops == 1, F.col("hop")).when((hops == 0) & F.col("own").isNotNull(), F.col("own"))
    rows = rows.withColumn("chosen", chosen).withColumn("several", ~sure & (hops > 1))
    status = F.when(F.col("several"), "ambiguous").when(F.col("chosen").isNull(), "not_found").otherwise(F.col("chosen.status"))
    none = F.array().cast("array<string>")
    return rows.select(
        "kind", "id", "chosen.target_id", status.alias("status"), "chosen.tier", "chosen.fact_id", "chosen.numeric_value", "chosen.unit", F.when(F.col("several"), F.col("targets")).otherwise(none).alias("candidate_ids"),
        F.when(F.col("several"), F.col("all")).otherwise(F.coalesce("chosen.relationships", none)).alias("path"),
    )


def relative_elevation(facts: DataFrame, reference: str | None = None) -> DataFrame:
    """``(entity_id, status, reference, fact_id, numeric_value, unit, candidate_references)`` from ``facts(entity_id, tier, id, numeric_value,
    unit, texts)``: spot elevations (tier 1) before named parameters (tier 2).

    A datum must be proved by one of a fact's texts. Without a request one datum must be left; several are
    ``ambiguous``, none is ``insufficient_data``, as is a requested one that no text proves.
    """
    each = F.array_distinct(F.array_compact(F.transform("texts", lambda t: plain(datum(t)))))
    told = best_tier(facts).withColumn("datums", each)
    if reference is not None:
        wanted = reference.strip().lower()
        told = told.withColumn("reference", F.lit(wanted)).withColumn("proved", F.array_contains("datums", wanted))
        status = F.when(F.max("proved").over(Window.partitionBy("entity_id")), "ok").otherwise("insufficient_data")
        told = told.withColumn("state", status)
    else:
        exploded = told.select("entity_id", F.explode_outer("datums").alias("d")).groupBy("entity_id").agg(F.min("d").alias("reference"), F.max("d").alias("other"))
        told = told.join(exploded, "entity_id").withColumn("state", F.when(F.col("reference").isNull(), "insufficient_data").when(F.col("reference") != F.col("other"), "ambiguous").otherwise("ok"))
        told = told.withColumn("proved", F.array_contains("datums", F.col("reference")))
    good = settled(told.filter("state = 'ok' and proved").withColumn("tier", F.lit(1))).select("entity_id", "status", "fact_id", "numeric_value", "unit")
    base = told.groupBy("entity_id").agg(F.min("state").alias("state"), F.min("reference").alias("reference"))
    out = base.join(good, "entity_id", "left")
    named = told.groupBy("entity_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("datums")))).alias("every"))
    shown = F.when(F.col("state") == "ambiguous", F.col("every")).otherwise(F.array().cast("array<string>")).alias("candidate_references")
    return out.join(named, "entity_id").select("entity_id", F.coalesce("status", "state").alias("status"), F.when(F.col("state") == "ok", F.col("reference")).alias("reference"), "fact_id", "numeric_value", "unit", shown)

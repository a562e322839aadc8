"""Semantic discovery and projection over source-neutral entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions.text import ascii_lower, contains_nocase, same_nocase, stripped
from plinth.operators.entities import resolved_bindings

#: Best match first (fixed order).
PRECEDENCE = ("entity_id_exact", "number_exact", "label_exact", "property_value_exact", "number_contains", "label_contains", "property_value_contains")


def source_values(entities: DataFrame, properties: DataFrame) -> DataFrame:
    """All searchable values of the entities: id, number, label, property values."""
    none = F.lit(None).cast("string")
    own = entities.select(F.col("id").alias("semantic_entity_id"), F.explode(F.array(*[F.struct(F.lit(k).alias("match_source"), F.col(c).alias("source_value")) for k, c in (("entity_id", "id"), ("number", "number"), ("label", "label"))])).alias("v"))
    own = own.select("semantic_entity_id", "v.*", none.alias("property_id"), none.alias("source_name"))
    more = properties.select("semantic_entity_id", F.lit("property_value").alias("match_source"), "source_value", F.col("id").alias("property_id"), "source_name")
    return own.unionByName(more.join(entities.select(F.col("id").alias("semantic_entity_id")), "semantic_entity_id", "left_semi"))


def _run(text: Column, n: int):
    return lambda at: F.substring(text, at, F.lit(n))


def matches(entities: DataFrame, properties: DataFrame, queries: DataFrame) -> DataFrame:
    """``(query, semantic_entity_id, match_kind, precedence, source_name, source_value, property_id)``.

    ``queries(query, entity_class)`` is a small table of questions, null class for any; a value matches exactly or by
    containing the query (ids only exactly), ignoring the case of A-Z. Blank queries match nothing.
    """
    asked = queries.filter(F.col("query").rlike(r"(?U)\S"))
    values = source_values(entities, properties).join(entities.select(F.col("id").alias("semantic_entity_id"), "entity_class"), "semantic_entity_id")
    asked = asked.select("query", F.col("entity_class").alias("wanted"))
    # a value that contains the query has its first letters somewhere: values are listed by all runs of so many letters
    low, size = ascii_lower(F.col("query")), F.least(F.char_length("query"), F.lit(3))
    asked = asked.withColumn("gram", F.substring(low, F.lit(1), size))
    sizes = [r["n"] for r in asked.select(F.char_length("gram").alias("n")).distinct().collect()]  # of 1, 2 and 3
    text, none = ascii_lower(F.col("source_value")), F.array().cast("array<string>")
    runs = [F.when(F.char_length("source_value") >= n, F.transform(F.sequence(F.lit(1), F.char_length("source_value") - n + 1), _run(text, n))).otherwise(none) for n in sizes]
    listed = values.withColumn("gram", F.explode(F.array_distinct(F.concat(*runs) if runs else none)))
    hit = contains_nocase(F.col("source_value"), F.col("query")) & (F.col("wanted").isNull() | same_nocase(F.col("entity_class"), F.col("wanted")))
    joined = listed.join(asked, "gram").filter(hit).drop("gram")
    exact = ascii_lower(F.col("source_value")) == ascii_lower(F.col("query"))
    kind = F.when(exact, F.concat("match_source", F.lit("_exact"))).when(F.col("match_source") != "entity_id", F.concat("match_source", F.lit("_contains")))
    out = joined.withColumn("match_kind", kind).filter("match_kind is not null")
    order = F.array_position(F.array(*[F.lit(x) for x in PRECEDENCE]), F.col("match_kind")) - 1
    return out.select("query", "semantic_entity_id", "match_kind", order.cast("int").alias("precedence"), "source_name", "source_value", "property_id")


def discover(entities: DataFrame, properties: DataFrame, queries: DataFrame, limit: int = 20) -> DataFrame:
    """Candidates per query in order of best match, class, number, label, id: the first ``limit`` with their place and
    the query's status, which counts all candidates."""
    if isinstance(limit, bool) or not isinstance(limit, int) or limit < 1:
        raise ValueError("limit must be a positive integer")
    each = F.struct("precedence", F.coalesce("source_name", F.lit("")).alias("source_name"), "source_value", F.coalesce("property_id", F.lit("")).alias("property_id"), "match_kind")
    found = matches(entities, properties, queries).groupBy("query", "semantic_entity_id").agg(F.array_sort(F.collect_list(each)).alias("matches"), F.min("precedence").alias("best"))
    found = found.join(entities.withColumnRenamed("id", "semantic_entity_id"), "semantic_entity_id")
    order = Window.partitionBy("query").orderBy("best", "entity_class", F.coalesce("number", F.lit("")), F.coalesce("label", F.lit("")), "semantic_entity_id")
    counts = found.groupBy("query").agg(F.count_if(F.col("best") <= 3).alias("n_exact"), F.count("*").alias("n_candidates"))
    status = F.when(F.col("n_exact") == 1, "exact_unique").when(F.col("n_exact") > 1, "multiple_exact").when(F.col("n_candidates") > 0, "candidates").otherwise("no_match")
    top = found.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= limit)
    answer = queries.select("query").distinct().join(counts, "query", "left").fillna(0, ["n_exact", "n_candidates"]).withColumn("status", status)
    return answer.join(top, "query", "left")


def _evidence(rows: DataFrame) -> list[Column]:
    return [(F.col("evidence_id") if "evidence_id" in rows.columns else F.lit(None).cast("string")).alias("evidence_id")]


def facts_of(bindings: DataFrame, parameters: DataFrame, properties: DataFrame) -> DataFrame:
    """``(semantic_entity_id, fact_kind, id, name, value, numeric_value, unit, scope)``: parameters of resolved element
    and type bindings, then the entity's own properties."""
    solid = resolved_bindings(bindings).filter(F.col("source_kind").isin("element", "element_type"))
    bound = solid.select("semantic_entity_id", F.col("id").alias("source_binding_id"), F.col("source_kind").alias("entity_kind"), F.col("source_id").alias("entity_id"))
    value = F.coalesce(F.when(F.col("value_text") != "", F.col("value_text")), F.col("raw_value_text"))
    a = parameters.join(bound, ["entity_kind", "entity_id"]).select("semantic_entity_id", F.lit("parameter").alias("fact_kind"), "id", F.col("definition_name").alias("name"), value.alias("value"), "numeric_value", "unit", "scope", "source_binding_id", *_evidence(parameters))
    b = properties.select("semantic_entity_id", F.lit("semantic_property").alias("fact_kind"), "id", F.col("source_name").alias("name"), F.col("source_value").alias("value"), "numeric_value", "unit", "scope", "source_binding_id", *_evidence(properties))
    return a.unionByName(b)


def coverage(entities: DataFrame, parts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Entities with the number of rows each part holds of them; ``parts`` maps a name to (rows, key column)."""
    out = entities.select("id")
    for name, (rows, key) in parts.items():
        counts = rows.groupBy(F.col(key).alias("id")).agg(F.count("*").alias(name))
        out = out.join(counts, "id", "left").fillna(0, [name])
    return out


def from_table(cells: DataFrame, key_column: str, property_columns: list[str], entity_class: str, namespace: str, number_column: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Entities and properties of mapped table rows.

    ``cells(table_id, row_index, column_name, text)`` are the data rows under exact headers. The key makes the id;
    rows that share a key are ambiguous, all of them; blank keys are errors (state ``error``); empty cells give no
    property.
    """
    names = list(dict.fromkeys([key_column, *property_columns, *([number_column] if number_column else [])]))
    rows = cells.groupBy("table_id", "row_index").pivot("column_name", names).agg(F.first("text"))
    key = stripped(F.col(f"`{key_column}`"))
    again = F.count("*").over(Window.partitionBy("table_id", key))
    state = F.when(F.coalesce(key, F.lit("")) == "", "error").when(again > 1, "ambiguous").otherwise("exact")
    ident = F.concat(F.lit("semantic-"), F.sha2(F.concat_ws("\u001f", F.lit(namespace), "table_id", key, F.when(again > 1, F.col("row_index").cast("string"))), 256))
    rows = rows.withColumn("id", ident).withColumn("resolution_state", state).withColumn("number", F.col(f"`{number_column}`") if number_column else F.lit(None).cast("string"))
    entities = rows.select("id", F.lit(entity_class).alias("entity_class"), key.alias("label"), "number", "resolution_state", "table_id", "row_index")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("source_name"), F.col(f"`{c}`").alias("source_value")) for c in property_columns])).alias("p")
    properties = rows.filter("resolution_state <> 'error'").select(F.col("id").alias("semantic_entity_id"), pairs).select("semantic_entity_id", "p.*").filter("source_value <> ''")
    return entities, properties

"""One-hop contexts of semantic entities: where their records are in space and on drawings, the evidence behind them,
and the envelope that counts it all. Every function answers for all entities at once, in flat keyed rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.operators.entities import STATES, resolved_bindings

#: Whether a row states what was stored or what was worked out from it (fixed names).
STORED, DERIVED = "source_fact", "deterministic_derived"
SPATIAL_KINDS = ("space", "element", "level")
DRAWN_KINDS = ("element", "element_type", "space", "level")


def _bound(bindings: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    own = resolved_bindings(bindings).filter(F.col("source_kind").isin(*kinds))
    return own.select("semantic_entity_id", F.col("id").alias("binding_id"), "source_kind", "source_id")


def spatial_parts(entities: dict[str, DataFrame], contained: DataFrame, siblings: DataFrame, connections: DataFrame, adjacent: DataFrame) -> DataFrame:
    """``(kind, entity_id, part, related_kind, related_id, evidence_class)``: what stands around every space and element,
    and every record's level.

    ``entities`` maps a kind to its table; ``contained(element_id, space_id)``, ``siblings(element_id, sibling_id)``,
    ``connections(space_id, connector_id, connected_space)``, ``adjacent(space_id, adjacent_id)``.
    """

    def part(rows: DataFrame, kind: str, own: str, name: str, related_kind: str, related: str, klass: str) -> DataFrame:
        cols = [F.lit(kind).alias("kind"), F.col(own).alias("entity_id"), F.lit(name).alias("part"), F.lit(related_kind).alias("related_kind"), F.col(related).alias("related_id"), F.lit(klass).alias("evidence_class")]
        return rows.filter(F.col(related).isNotNull()).select(*cols).distinct()

    levels = entities["level"].select(F.col("id").alias("level_id"))
    found = [entities["level"].select(F.lit("level").alias("kind"), F.col("id").alias("entity_id"), F.lit("level").alias("part"), F.lit("level").alias("related_kind"), F.col("id").alias("related_id"), F.lit(STORED).alias("evidence_class"))]
    found += [part(entities[k].join(levels, "level_id", "left_semi"), k, "id", "level", "level", "level_id", STORED) for k in ("space", "element")]
    found += [
        part(contained, "element", "element_id", "containment", "space", "space_id", STORED), part(contained, "space", "space_id", "contained_element", "element", "element_id", STORED),
        part(siblings, "element", "element_id", "type_sibling", "element", "sibling_id", DERIVED), part(connections, "space", "space_id", "connector", "element", "connector_id", STORED),
        part(connections, "space", "space_id", "connected_space", "space", "connected_space", STORED), part(adjacent, "space", "space_id", "adjacent_space", "space", "adjacent_id", DERIVED),
    ]
    return reduce(DataFrame.unionByName, found)


def references_of(bindings: DataFrame) -> DataFrame:
    """``(source_kind, source_id, semantic_refs)``: the semantic entities that resolved bindings tie to a record."""
    refs = F.struct(F.col("semantic_entity_id"), F.col("id").alias("binding_id"))
    return resolved_bindings(bindings).groupBy("source_kind", "source_id").agg(F.array_sort(F.collect_list(refs)).alias("semantic_refs"))


def reference_lengths(bindings: DataFrame) -> DataFrame:
    """``(source_kind, source_id, refs)``: how many characters :func:`references_of` has for a record, as ``entity/binding`` with blanks
    between, summed up without the list: a record can be tied to all entities."""
    each = F.char_length("semantic_entity_id") + F.char_length("id") + 2
    return resolved_bindings(bindings).groupBy("source_kind", "source_id").agg((F.sum(each) - 1).alias("refs"))


def spatial_contexts(bindings: DataFrame, parts: DataFrame) -> DataFrame:
    """The parts around every resolved space, element and level binding, with the semantic entities of each related
    record: ``(semantic_entity_id, binding_id, source_kind, source_id, part, related_kind, related_id, evidence_class,
    semantic_refs)``."""
    own = _bound(bindings, SPATIAL_KINDS)
    rows = own.join(parts.withColumnRenamed("kind", "source_kind").withColumnRenamed("entity_id", "source_id"), ["source_kind", "source_id"])
    refs = references_of(bindings).select(F.col("source_kind").alias("related_kind"), F.col("source_id").alias("related_id"), "semantic_refs")
    cols = ["semantic_entity_id", "binding_id", "source_kind", "source_id", "part", "related_kind", "related_id", "evidence_class", "semantic_refs"]
    return rows.join(refs, ["related_kind", "related_id"], "left").select(*cols)


def spatial_bindings(bindings: DataFrame, entities: dict[str, DataFrame]) -> DataFrame:
    """Bindings that give a spatial context: a space or element always does, a level if it is stored."""
    own = _bound(bindings, SPATIAL_KINDS)
    known = own.filter("source_kind = 'level'").join(entities["level"].select(F.col("id").alias("source_id")), "source_id", "left_semi")
    return own.filter("source_kind <> 'level'").unionByName(known.select(*own.columns))


def drawn(bindings: DataFrame, occurrences: DataFrame, cells: DataFrame, spans: DataFrame, evidence: DataFrame) -> DataFrame:
    """Every place on a drawing or page that a resolved binding leads to; none is left out as a duplicate.

    ``occurrences`` is :func:`entities.occurrences`, the others come from :mod:`documents`. Columns:
    ``(semantic_entity_id, binding_id, source_kind, source_id, occurrence_id, document_id, document_identity, pdf_page,
    sheet_number, view_id, view_name, bbox, bbox_quality, appearance_kind, coordinate_space, evidence_id,
    evidence_class)``.
    """
    cols = ["occurrence_id", "document_id", "document_identity", "pdf_page", "sheet_number", "view_id", "view_name", "bbox", "bbox_quality", "appearance_kind", "coordinate_space", "evidence_id"]
    none = F.lit(None).cast("string")

    def shown(rows: DataFrame, ident: str, **more: Column) -> DataFrame:
        known = {c: F.col(c) for c in cols if c in rows.columns} | more | {"occurrence_id": F.col(ident)}
        return rows.select(*[k for k in ("source_kind", "source_id")], *[known.get(c, none).alias(c) for c in cols])

    app = occurrences.withColumn("source_kind", F.col("entity_kind")).withColumn("source_id", F.col("entity_id"))
    parts = [shown(app.filter(F.col("source_kind").isin(*DRAWN_KINDS)), "appearance_id", pdf_page=F.col("pdf_page").cast("long"))]
    for rows, kind, ident in ((cells, "pdf_table_cell", "cell_id"), (spans, "pdf_text_span", "span_id"), (evidence, "evidence", "evidence_id")):
        own = rows.withColumn("source_kind", F.lit(kind)).withColumn("source_id", F.col(ident))
        parts.append(shown(own, ident, document_id=F.col("document.id"), pdf_page=F.col("pdf_page").cast("long")))
    places = reduce(DataFrame.unionByName, parts)
    found = _bound(bindings, (*DRAWN_KINDS, "pdf_table_cell", "pdf_text_span", "evidence")).join(places, ["source_kind", "source_id"])
    return found.select("semantic_entity_id", "binding_id", "source_kind", "source_id", *cols, F.lit(STORED).alias("evidence_class"))


#: Orders drawing occurrences of an entity.
DRAWN_ORDER = ("document_identity", "pdf_page", "sheet_number", "view_name", "bbox", "occurrence_id", "binding_id")


def evidence_refs(entities: DataFrame, bindings: DataFrame, facts: DataFrame, edges: DataFrame) -> DataFrame:
    """``(semantic_entity_id, evidence_id)``, each once: evidence of the entity, its bindings, facts and relationships.

    ``facts`` and ``edges`` have ``semantic_entity_id`` and ``evidence_id``.
    """
    parts = [entities.select(F.col("id").alias("semantic_entity_id"), "evidence_id")] + [x.select("semantic_entity_id", "evidence_id") for x in (bindings, facts, edges)]
    return reduce(DataFrame.unionByName, parts).filter("coalesce(evidence_id, '') <> ''").distinct()


def envelope(entities: DataFrame, bindings: DataFrame, facts: DataFrame, edges: DataFrame, spatial: DataFrame, drawn_rows: DataFrame, evidence: DataFrame, edge_counts: DataFrame | None = None) -> DataFrame:
    """Per entity: its state, how its bindings are resolved, how much of each part there is, and its evidence and
    documents as sorted arrays.

    ``spatial`` is :func:`spatial_bindings`; ``evidence`` is :func:`documents.evidence`. Evidence that names no stored
    record does not count. Each part is summed up before it is joined, so that no part multiplies another. With
    ``edge_counts`` (:func:`topology.edge_counts`) the edges themselves are only asked for their evidence.
    """
    key = "semantic_entity_id"
    count = lambda rows, name: rows.groupBy(key).agg(F.count("*").alias(name))
    open_ids = [F.array_sort(F.collect_list(F.when(F.col("resolution_state") == s, F.col("id")))).alias(f"{s}_binding_ids") for s in ("ambiguous", "unresolved")]
    states = bindings.groupBy(key).agg(F.count("*").alias("binding_count"), *[F.count_if(F.col("resolution_state") == s).alias(f"n_{s}") for s in STATES], *open_ids)
    known = evidence_refs(entities, bindings, facts, edges).join(evidence.select("evidence_id", F.col("document.id").alias("document_id")), "evidence_id")
    refs = known.groupBy(key).agg(F.count("*").alias("evidence_count"), F.array_sort(F.collect_list("evidence_id")).alias("evidence_ids"))
    papers = known.select(key, "document_id").unionByName(drawn_rows.select(key, "document_id")).filter("document_id is not null").distinct()
    papers = papers.groupBy(key).agg(F.count("*").alias("source_document_count"), F.array_sort(F.collect_list("document_id")).alias("document_ids"))
    out = entities.select(F.col("id").alias(key), F.col("resolution_state").alias("entity_state"))
    related = count(edges, "relationship_count") if edge_counts is None else edge_counts.withColumnRenamed("n", "relationship_count")
    for rows in (states, count(facts, "property_count"), related, count(spatial, "spatial_context_count"), count(drawn_rows, "drawing_occurrence_count"), refs, papers):
        out = out.join(rows, key, "left")
    counts = ["binding_count", *[f"n_{s}" for s in STATES], "property_count", "relationship_count", "spatial_context_count", "drawing_occurrence_count", "evidence_count", "source_document_count"]
    lists = ["ambiguous_binding_ids", "unresolved_binding_ids", "evidence_ids", "document_ids"]
    return out.select(key, "entity_state", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in lists])


def answer_evidence(records: DataFrame, occurrences: DataFrame) -> DataFrame:
    """``(subject_id, evidence_kind, id, document_identity, pdf_page, sheet_number, view_name, bbox, place)``: the stated
    evidence of an answer's records and the occurrences of its entities, each once, in order.

    ``records(subject_id, evidence)`` has the struct of :func:`entities.with_evidence`; ``occurrences(subject_id, ...)``
    has the columns of :func:`entities.occurrences`.
    """
    stated = records.filter("evidence is not null").select("subject_id", F.lit("evidence").alias("evidence_kind"), "evidence.*")
    shown = occurrences.withColumn("evidence_kind", F.lit("appearance")).withColumn("id", F.col("appearance_id"))
    cols = ["subject_id", "evidence_kind", "id", "document_identity", "pdf_page", "sheet_number", "view_name", "bbox"]
    rows = stated.select(*cols).unionByName(shown.select(*cols)).dropDuplicates(["subject_id", "evidence_kind", "id"])
    order = Window.partitionBy("subject_id").orderBy("document_identity", "pdf_page", F.coalesce("sheet_number", F.lit("")), F.coalesce("view_name", F.lit("")), "id", "evidence_kind")
    return rows.withColumn("place", F.row_number().over(order))

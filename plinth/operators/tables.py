"""Rows of extracted tables as semantic entities, for all tables that one interpretation fits.

Which column is which is told by header rows, or by header spans that stand above the grid and are named one by one. A table whose
headers or grid leave any doubt gives nothing at all, and its first problem is reported; rows of a sound table that lack a key or share
one are reported and left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions.geometry import TABLE_SLACK
from plinth.functions.text import is_blank
from plinth.session import staged

#: Fixed names.
EMBEDDED, TOP_LEFT, ALL_OTHERS = "embedded_pdf_text", "pdf_points_top_left", "all_non_key"
_BOX = ("x_min", "y_min", "x_max", "y_max")


@dataclass(frozen=True)
class Interpretation:
    """What the rows of some tables are: their class, key and property columns by header, and where these come from."""

    mapping_id: str
    namespace: str
    entity_class: str
    key_columns: tuple[str, ...]
    property_columns: tuple[str, ...] | str = ALL_OTHERS
    kind: str = "unknown"
    scope: str = "unknown"
    label_column: str | None = None
    number_column: str | None = None
    canonical_names: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        named = self.property_columns if self.property_columns != ALL_OTHERS else ()
        if not all((self.mapping_id, self.namespace, self.entity_class, self.key_columns)):
            raise ValueError("an interpretation needs ids, a class and key columns")
        if len(set(self.key_columns)) < len(self.key_columns) or len(set(named)) < len(named) or set(named) & set(self.key_columns):
            raise ValueError("columns must be distinct, and keys are no properties")
        if self.kind not in ("instance", "type", "unknown") or self.scope not in ("instance", "type", "sheet", "schedule", "project", "unknown"):
            raise ValueError("an unknown kind or scope")
        if self.property_columns != ALL_OTHERS and not set(self.canonical_names) <= set(named):
            raise ValueError("canonical names are for property columns")

    @property
    def asked(self) -> list[str]:
        """Headers that a table must have."""
        named = () if self.property_columns == ALL_OTHERS else self.property_columns
        return list(dict.fromkeys([*self.key_columns, *named, *self.canonical_names, *[x for x in (self.label_column, self.number_column) if x]]))


def _sound_box(p: str) -> Column:
    sides = [F.col(f"{p}{c}") for c in _BOX]
    finite = reduce(lambda a, b: a & b, [s.isNotNull() & ~F.isnan(s) & (F.abs(s) < float("inf")) for s in sides])
    return F.coalesce(finite & (sides[0] < sides[2]) & (sides[1] < sides[3]) & (F.col(f"{p}coordinate_space") == TOP_LEFT), F.lit(False))


def _inside(inner: str, outer: str) -> Column:
    low = [F.col(f"{outer}{c}") <= F.col(f"{inner}{c}") for c in _BOX[:2]]
    return low[0] & low[1] & (F.col(f"{inner}x_max") <= F.col(f"{outer}x_max")) & (F.col(f"{inner}y_max") <= F.col(f"{outer}y_max"))


def header_spans(bindings: DataFrame, tables: DataFrame, pages: DataFrame, documents: DataFrame, cells: DataFrame, spans: DataFrame, lines: DataFrame, blocks: DataFrame, evidence: DataFrame) -> DataFrame:
    """``bindings(table_id, source_name, column_index, header_span_id)`` with ``problem``, the first that applies; null if none.

    The span must be embedded text that reads as the header does, on the table's page by its line, block and evidence, each inside the next,
    above the grid, and within the column's cells (but for the slack of table geometry).
    """
    part = lambda rows, p, cols: rows.select(*[F.col(c).alias(f"{p}{c}") for c in cols])
    box = [*_BOX, "coordinate_space"]
    of = lambda *keys: F.count("*").over(Window.partitionBy(*keys))
    rows = bindings.withColumns({"_names": of("table_id", "source_name"), "_columns": of("table_id", "column_index"), "_spans": of("table_id", "header_span_id")})
    # the narrowest room that each column's cells leave, and how far they reach, before anything meets them: one row a table
    sides = {f"{f}_{s}": (F.min if f == "low" else F.max)(s) for f in ("low", "high") for s in _BOX}
    places = cells.groupBy("table_id", "column_index", "row_index").agg(F.count("*").alias("n"), F.min(_sound_box("")).alias("sound"), *[v.alias(k) for k, v in sides.items()])
    columns = places.groupBy("table_id", "column_index").agg(F.sum("n").alias("n"), F.count_if(F.col("column_index").isNotNull() & F.col("row_index").isNotNull()).alias("places"), F.min("sound").alias("sound"), *[(F.min if k.startswith("low") else F.max)(k).alias(k) for k in sides])
    room = F.struct("column_index", "sound", F.col("high_x_min").alias("room_min"), F.col("low_x_max").alias("room_max"), "low_x_min", "low_y_min", "high_x_max", "high_y_max")
    grids = columns.groupBy("table_id").agg(F.sum("n").alias("_cells"), F.sum("places").alias("_places"), F.collect_list(room).alias("_rooms"))
    # the small side of each join is put together first, so that bindings are shuffled once to their table and once to their span
    of_table = part(tables, "t_", ["id", "page_id", "row_count", "column_count", *box]).join(grids.withColumnRenamed("table_id", "_table"), F.col("t_id") == F.col("_table"), "left").drop("_table")
    of_page = part(pages, "p_", ["id", "document_id", "page_number", "width_points", "height_points"]).join(part(documents, "d_", ["id"]), F.col("p_document_id") == F.col("d_id"), "left")
    of_table = of_table.join(of_page, F.col("t_page_id") == F.col("p_id"), "left")
    of_block = part(blocks, "b_", ["id", "page_id", "evidence_id", "provenance", *box]).join(part(evidence, "e_", ["id", "document_id", "pdf_page", *box]), F.col("b_evidence_id") == F.col("e_id"), "left")
    of_block = of_block.withColumn("b_sound", _sound_box("b_") & _sound_box("e_")).withColumn("b_inside", _inside("b_", "e_")).drop("b_evidence_id", "b_coordinate_space", *[f"e_{x}" for x in box])
    of_line = part(lines, "l_", ["id", "block_id", "provenance", *box]).join(of_block, F.col("l_block_id") == F.col("b_id"), "left")
    of_line = of_line.withColumn("l_sound", _sound_box("l_") & F.col("b_sound")).withColumn("l_inside", _inside("l_", "b_") & F.col("b_inside")).withColumn("l_embedded", (F.col("l_provenance") == EMBEDDED) & (F.col("b_provenance") == EMBEDDED))
    of_line = of_line.withColumn("l_missing", F.col("b_id").isNull() | F.col("e_id").isNull()).drop("l_block_id", "l_provenance", "l_coordinate_space", "b_id", "b_provenance", "b_sound", "b_inside", "e_id", *[f"b_{x}" for x in _BOX])
    of_span = part(spans, "s_", ["id", "line_id", "text", "provenance", *box]).join(of_line, F.col("s_line_id") == F.col("l_id"), "left")
    of_span = of_span.withColumn("s_sound", _sound_box("s_") & F.col("l_sound")).withColumn("s_inside", _inside("s_", "l_") & F.col("l_inside")).withColumn("s_embedded", (F.col("s_provenance") == EMBEDDED) & F.col("l_embedded"))
    of_span = of_span.withColumn("s_missing", F.col("l_id").isNull() | F.col("l_missing"))
    of_span = of_span.select("s_id", "s_text", *[f"s_{x}" for x in _BOX], "s_sound", "s_inside", "s_embedded", "s_missing", "b_page_id", "e_document_id", "e_pdf_page")
    rows = rows.join(of_table, F.col("table_id") == F.col("t_id"), "left").withColumn("_room", F.get(F.filter("_rooms", lambda x: x["column_index"] == F.col("column_index")), F.lit(0))).drop("_rooms", "_table")
    its = lambda name: F.col(f"_room.{name}")
    inside = (F.col("t_x_min") <= its("low_x_min")) & (F.col("t_y_min") <= its("low_y_min")) & (its("high_x_max") <= F.col("t_x_max")) & (its("high_y_max") <= F.col("t_y_max"))
    no = lambda c: ~F.coalesce(c, F.lit(False))
    c = F.col
    # what is known before the span, of which only the answer travels on: first what goes before a missing span, then what comes after
    first = (
        F.when(is_blank(c("source_name")) | is_blank(c("header_span_id")) | no((c("column_index") >= 0) & (c("column_index") < c("t_column_count"))), "invalid_binding")
        .when((c("_names") > 1) | (c("_columns") > 1) | (c("_spans") > 1), "duplicate_binding")
        .when(c("d_id").isNull(), "missing_evidence")
    )
    after = (
        F.when(no((c("p_page_number") >= 1) & (c("p_width_points") > 0) & (c("p_height_points") > 0) & (c("p_width_points") < float("inf")) & (c("p_height_points") < float("inf"))), "invalid_page")
        .when(no((c("_cells") == c("t_row_count") * c("t_column_count")) & (c("_places") == c("_cells"))), "incomplete_grid")
    )
    kept = ("p_id", "p_document_id", "p_page_number", "p_width_points", "p_height_points", "t_y_min")
    rows = rows.select(*bindings.columns, *kept, first.alias("first"), after.alias("after"), F.when(its("sound") & inside, its("room_min")).alias("room_min"), its("room_max").alias("room_max"), _sound_box("t_").alias("t_sound"))
    rows = rows.join(of_span, F.col("header_span_id") == F.col("s_id"), "left")
    page_box = (c("s_x_min") >= 0) & (c("s_y_min") >= 0) & (c("s_x_max") <= c("p_width_points")) & (c("s_y_max") <= c("p_height_points"))
    problem = (
        F.when(c("first").isNotNull(), c("first"))
        .when(c("s_id").isNull() | c("s_missing"), "missing_evidence")
        .when(c("after").isNotNull(), c("after"))
        .when(no((c("s_text") == c("source_name")) & c("s_embedded")), "other_text")
        .when(no((c("b_page_id") == c("p_id")) & (c("e_document_id") == c("p_document_id")) & (c("e_pdf_page") == c("p_page_number"))), "other_page")
        .when(~(c("t_sound") & c("s_sound")), "invalid_box")
        .when(~(c("s_inside") & page_box & (c("s_y_max") <= c("t_y_min"))), "not_above_grid")
        .when(no((c("s_x_min") >= c("room_min") - TABLE_SLACK) & (c("s_x_max") <= c("room_max") + TABLE_SLACK)), "outside_column")
    )
    return rows.select(*bindings.columns, problem.alias("problem"))


def row_headers(cells: DataFrame, header_rows: tuple[int, ...]) -> DataFrame:
    """``(table_id, source_name, column_index, header_span_id, problem)`` from header rows: the one cell of a column that is not blank."""
    if not header_rows or len(set(header_rows)) < len(header_rows):
        raise ValueError("header rows must be given, each once")
    filled = cells.filter(F.col("row_index").isin(list(header_rows)) & ~is_blank(F.col("text")))
    found = filled.groupBy("table_id", "column_index").agg(F.count("*").alias("n"), F.min("text").alias("source_name"))
    return found.select("table_id", "source_name", "column_index", F.lit(None).cast("string").alias("header_span_id"), F.when(F.col("n") > 1, "several_headers").alias("problem"))


def project(spec: Interpretation, tables: DataFrame, cells: DataFrame, headers: DataFrame, header_rows: tuple[int, ...] = (), existing: DataFrame | None = None) -> dict[str, DataFrame]:
    """``entities``, ``bindings``, ``properties``, ``issues`` and ``report`` of all ``tables``, by their ``headers``.

    ``headers`` are those of :func:`row_headers` or :func:`header_spans`. Issues have a row for each row left out, and one without a row for each
    table that gives nothing. Blank cells give no property. ``existing(id)`` are ids that new records must not have.
    """
    ident = lambda kind, *parts: F.concat(F.lit(f"{kind}-"), F.sha2(F.to_json(F.array(*parts)), 256))
    by = tables.select(F.col("id").alias("table_id"), "row_count", "column_count")
    whole = cells.groupBy("table_id").agg(F.count("*").alias("n"), F.count_distinct("row_index", "column_index").alias("places"))
    heads = headers.groupBy("table_id").agg(F.collect_list(F.struct("column_index", "source_name", "header_span_id", "problem")).alias("heads"))
    # a table is judged in one row with its headers, so that cells are joined by their table alone
    named = lambda name: F.size(F.filter("heads", lambda h: h["source_name"] == name))
    asked = F.transform(F.array(*map(F.lit, spec.asked)), named)
    outside = (F.lit(min(header_rows)) < 0) | (F.lit(max(header_rows)) >= F.col("row_count")) if header_rows else F.lit(False)
    code = (
        F.when(~F.coalesce((F.col("n") == F.col("row_count") * F.col("column_count")) & (F.col("places") == F.col("n")), F.lit(False)), "incomplete_grid")
        .when(outside, "header_row_outside")
        .when(F.exists("heads", lambda h: h["problem"].isNotNull()), F.array_min(F.transform("heads", lambda h: h["problem"])))
        .when(F.exists(asked, lambda n: n == 0), "missing_header")
        .when(F.exists(asked, lambda n: n > 1), "ambiguous_header")
    )
    if spec.property_columns == ALL_OTHERS:
        at_column = lambda i: F.filter("heads", lambda h: (h["column_index"] == i) & h["source_name"].isNotNull())
        code = code.when(F.exists(F.sequence(F.lit(0), F.col("column_count") - 1), lambda i: (F.size(at_column(i)) == 0) | F.exists(at_column(i), lambda h: named(h["source_name"]) > 1)), "column_without_header")
    judged = by.join(whole, "table_id", "left").join(heads, "table_id", "left").withColumn("heads", F.coalesce("heads", F.array().cast(heads.schema["heads"].dataType)))
    judged = staged(judged.select("table_id", code.alias("code"), "heads").withColumn("heads", F.when(F.col("code").isNull(), F.col("heads"))), "tables")
    bad = judged.filter("code is not null").select("table_id", "code")
    named_only = [*spec.asked] if spec.property_columns != ALL_OTHERS else None
    filled = cells.filter(~F.col("row_index").isin(list(header_rows))) if header_rows else cells
    filled = filled.join(judged.filter("code is null").select("table_id", "heads"), "table_id").withColumn("h", F.explode(F.filter("heads", lambda h: h["column_index"] == F.col("column_index"))))
    filled = filled if named_only is None else filled.filter(F.col("h.source_name").isin(named_only))
    at = lambda name: F.max(F.when(F.col("h.source_name") == name, F.col("text")))
    shown = F.struct("h.source_name", "h.header_span_id", F.col("id").alias("cell_id"), "text")
    rows = filled.groupBy("table_id", "row_index").agg(*[at(k).alias(f"k{i}") for i, k in enumerate(spec.key_columns)], *([at(spec.label_column).alias("label")] if spec.label_column else []), *([at(spec.number_column).alias("number")] if spec.number_column else []), F.collect_list(shown).alias("cells"))
    keys = [f"k{i}" for i in range(len(spec.key_columns))]
    blank = reduce(lambda a, b: a | b, [is_blank(F.col(k)) for k in keys])
    again = F.count("*").over(Window.partitionBy("table_id", *keys))
    rows = staged(rows.withColumn("again", again).withColumn("code", F.when(blank, "missing_key").when(F.col("again") > 1, "duplicate_key")).drop("again"), "table-rows")
    entity_id = ident("semantic-pdf", F.lit(spec.mapping_id), F.lit(spec.namespace), F.lit(spec.entity_class), *[F.col(k) for k in keys])
    rows = rows.withColumn("id", F.when(F.col("code").isNull(), entity_id))
    # the same key in two tables, or an id that is taken, would be two records of one id: neither table gives anything
    taken = rows.filter("code is null").select("table_id", *keys)
    clash = taken.join(taken.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys), keys, "left_semi").select("table_id")
    clash = clash if existing is None else clash.unionByName(rows.filter("id is not null").join(existing.select("id"), "id", "left_semi").select("table_id"))
    clash = staged(clash.distinct(), "tables-of-taken-ids")  # few if any: rows need no shuffle to leave them out
    bad = bad.unionByName(clash.select("table_id", F.lit("duplicate_id").alias("code")))
    rows = rows.join(clash, "table_id", "left_anti")
    good = rows.filter("code is null")
    provenance = F.lit(f"pdf_table_mapping:{spec.mapping_id}").alias("provenance")
    optional = lambda c, has: F.when(~is_blank(F.col(c)), F.col(c)) if has else F.lit(None).cast("string")
    entities = good.select("id", F.lit(spec.entity_class).alias("entity_class"), optional("label", spec.label_column).alias("label"), optional("number", spec.number_column).alias("number"), F.lit(spec.kind).alias("instance_or_type"), F.lit("exact").alias("resolution_state"), provenance, "table_id", "row_index")
    used = good.select("table_id", "row_index", F.col("id").alias("semantic_entity_id"), F.explode("cells").alias("c")).select("table_id", "row_index", "semantic_entity_id", "c.*")
    is_key = F.col("source_name").isin(list(spec.key_columns))
    is_property = ~is_key if spec.property_columns == ALL_OTHERS else F.col("source_name").isin(list(spec.property_columns))
    used = used.filter(is_key | (is_property & ~is_blank(F.col("text"))))
    sources = F.array_compact(F.array(F.struct(F.lit("pdf_table_cell").alias("source_kind"), F.col("cell_id").alias("source_id")), F.when(F.col("header_span_id").isNotNull(), F.struct(F.lit("pdf_text_span").alias("source_kind"), F.col("header_span_id").alias("source_id")))))
    bindings = used.select("semantic_entity_id", "table_id", F.explode(sources).alias("s")).select(ident("semantic-binding", F.col("semantic_entity_id"), F.col("s.source_id")).alias("id"), "semantic_entity_id", "s.source_kind", "s.source_id", F.lit("exact").alias("resolution_state"), provenance, "table_id")
    canonical = F.create_map(*[F.lit(x) for pair in spec.canonical_names.items() for x in pair])[F.col("source_name")] if spec.canonical_names else F.lit(None).cast("string")
    properties = used.filter(is_property).select(
        ident("semantic-property", F.col("semantic_entity_id"), F.col("cell_id")).alias("id"), "semantic_entity_id", "source_name", F.col("text").alias("source_value"), F.lit(spec.scope).alias("scope"), canonical.alias("canonical_name"), provenance,
        ident("semantic-binding", F.col("semantic_entity_id"), F.col("cell_id")).alias("source_binding_id"), "table_id",
    )
    issues = rows.filter("code is not null").select("table_id", "row_index", "code").unionByName(bad.select("table_id", F.lit(None).cast("int").alias("row_index"), "code"))
    count = lambda code: F.count_if(F.col("code") == code)
    report = rows.groupBy("table_id").agg(F.count_if(F.col("code").isNull()).alias("imported"), F.count("code").alias("skipped"), count("duplicate_key").alias("ambiguous"), count("missing_key").alias("errors"))
    report = by.select("table_id").join(report, "table_id", "left").fillna(0).join(bad.withColumnRenamed("code", "problem"), "table_id", "left")
    return {"entities": entities, "bindings": bindings, "properties": properties, "issues": issues, "report": report}

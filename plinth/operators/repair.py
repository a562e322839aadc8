"""Whether a second, wider extraction of a table may stand in for a first one that lacks cells.

Candidates of two extractions of the same pages are matched where their boxes overlap. A wider candidate may repair the one it matches only if it
fills what was missing and changes nothing else: not the outline, the grid, a cell that was there, nor which text spans a cell or the table holds.
Every candidate gets the first reason that speaks against it. All pages are judged at once, each in one row of what it holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.geometry import rect_contains, rect_intersects, same_rect

_SIDES = ("x_min", "y_min", "x_max", "y_max")
#: The one reason for which a first extraction can be repaired (fixed name).
REPAIRABLE = "merged_or_missing_cell"


def _rect(prefix: str) -> tuple[Column, ...]:
    return tuple(F.col(f"{prefix}{s}") for s in _SIDES)


def _pages(**parts: DataFrame) -> DataFrame:
    """One row a page with an array of structs for each of ``parts``, all in one shuffle; candidates of no page stay apart."""
    lone = F.when(F.col("page_id").isNull(), F.col("candidate"))
    of = {name: F.struct(*[c for c in rows.columns if c != "page_id"]) for name, rows in parts.items()}
    none = {name: F.lit(None).cast(rows.select(of[name].alias("x")).schema["x"].dataType) for name, rows in parts.items()}
    rows = [
        (rows if name == "second" else rows.filter("page_id is not null")).select("page_id", (lone if name == "second" else F.lit(None).cast("string")).alias("lone"), *[(of if n == name else none)[n].alias(n) for n in parts])
        for name, rows in parts.items()
    ]
    return reduce(DataFrame.unionByName, rows).groupBy("page_id", "lone").agg(*[F.collect_list(n).alias(n) for n in parts]).drop("lone")


def _box(x: Column) -> tuple[Column, ...]:
    return tuple(x[s] for s in _SIDES)


def _at(x: Column, y: Column) -> Column:
    return (x["row"] == y["row"]) & (x["column"] == y["column"])


def _held(table: Column, cells: str) -> Column:
    """``(row, column, span_id)`` of the page's spans that a table meets and one of its cells holds."""
    met = lambda s: rect_intersects(_box(table), _box(s))
    of = lambda c: F.transform(F.filter("spans", lambda s: met(s) & rect_contains(_box(c), _box(s))), lambda s: F.struct(c["row"].alias("row"), c["column"].alias("column"), s["span_id"].alias("span_id")))
    return F.flatten(F.transform(cells, of))


def decisions(first: DataFrame, first_cells: DataFrame, second: DataFrame, second_cells: DataFrame, spans: DataFrame) -> DataFrame:
    """``(page_id, candidate, anchors, anchor, eligible, reason, missing_before, missing_after, repaired, newly_assigned)``.

    Candidates are ``(page_id, candidate, row_count, column_count, accepted, rejection, box)``, cells that are there ``(page_id, candidate, row,
    column, box)``, spans ``(page_id, span_id, box)``. What a page holds meets in one row, so that everything is shuffled once.
    """
    rows = _pages(first=first, first_cells=first_cells, second=second, second_cells=second_cells, spans=spans)
    rows = rows.withColumn("w", F.explode("second")).drop("second")
    its = lambda cells, table: F.filter(cells, lambda c: c["candidate"] == table["candidate"])
    w, b = F.col("w"), F.col("b")
    rows = rows.withColumn("met", F.filter("first", lambda x: rect_intersects(_box(w), _box(x)))).withColumn("b", F.when(F.size("met") == 1, F.get("met", F.lit(0))))
    rows = rows.select("page_id", F.size("met").cast("bigint").alias("anchors"), "w", "b", F.when(b.isNotNull(), F.col("spans")).alias("spans"), its("second_cells", w).alias("now"), its("first_cells", b).alias("before"))
    # both extractions cell by cell: there before, there now, and in the same place
    size = lambda x: F.coalesce(F.size(x), F.lit(0)).cast("bigint")
    count = lambda x: F.when(b.isNull(), F.lit(0)).otherwise(size(x)).cast("bigint")
    no = lambda x: ~F.coalesce(x, F.lit(False))
    there = lambda c: c["x_min"].isNotNull()
    same = lambda c: F.filter("now", lambda x: _at(x, c))
    moved = F.flatten(F.transform(F.filter("before", there), lambda c: F.when(F.size(same(c)) == 0, F.array(F.lit(False))).otherwise(F.transform(same(c), lambda x: F.coalesce(same_rect(_box(c), _box(x)), F.lit(False))))))
    was = lambda x: F.exists("before", lambda c: there(c) & F.coalesce(_at(c, x), F.lit(False)))
    rows = rows.withColumns({"moved": count(F.filter(moved, lambda kept: ~kept)), "repaired": count(F.filter("now", lambda x: there(x) & ~was(x)))})
    # the spans of both: held by the tables, and by cells that were there before
    met = lambda table: F.transform(F.filter("spans", lambda s: rect_intersects(_box(table), _box(s))), lambda s: s["span_id"])
    rows = rows.withColumns({"b_met": met(b), "w_met": met(w), "b_held": _held(b, "before"), "w_held": _held(w, "now")})
    apart = lambda x, y: F.filter(x, lambda s: no(F.array_contains(y, s)))
    rows = rows.withColumn("other_spans", count(apart("b_met", F.col("w_met"))) + count(apart("w_met", F.col("b_met"))))
    rows = rows.withColumns({"lost": apart("b_held", F.col("w_held")), "come": apart("w_held", F.col("b_held")), "kept": F.transform("b_held", lambda x: x["span_id"])})
    held_before = lambda x: F.coalesce(F.array_contains(F.col("kept"), x["span_id"]), F.lit(False))
    rows = rows.withColumns({
        "reassigned": count("lost") + count(F.filter("come", was)), "taken": count(F.filter("come", lambda x: ~was(x) & held_before(x))),
        "newly_assigned": count(F.array_distinct(F.transform(F.filter("come", lambda x: ~was(x) & ~held_before(x)), lambda x: x["span_id"]))),
    })
    shown = ("candidate", "row_count", "column_count", "accepted", "rejection", *_SIDES)
    rows = rows.select("page_id", "anchors", b["candidate"].alias("anchor"), *[w[n].alias(n) for n in shown], *[b[n].alias(f"b_{n}") for n in shown[1:]], size("now").alias("w_cells"), count("before").alias("b_cells"), "moved", "repaired", "other_spans", "reassigned", "taken", "newly_assigned")
    c = F.col
    after, lacked = c("row_count") * c("column_count") - c("w_cells"), c("b_row_count") * c("b_column_count") - c("b_cells")
    ladder = [
        (c("anchors") > 1, F.lit("multiple_baseline_anchors")), (c("anchors") == 0, F.lit("no_baseline_anchor")), (~same_rect(_rect("b_"), _rect("")), F.lit("outer_bbox_changed")),
        ((c("b_row_count") != c("row_count")) | (c("b_column_count") != c("column_count")), F.lit("dimensions_changed")), (c("b_accepted"), F.lit("baseline_already_accepted")),
        (~c("b_rejection").eqNullSafe(F.lit(REPAIRABLE)), F.concat(F.lit("baseline_not_repairable_"), c("b_rejection"))), (lacked == 0, F.lit("baseline_has_no_missing_cells")),
        (~c("accepted"), F.concat(F.lit("widened_not_accepted_"), c("rejection"))), (after != 0, F.lit("widened_still_has_missing_cells")), (c("moved") > 0, F.lit("existing_cell_geometry_changed")),
        (c("repaired") != lacked, F.lit("repaired_cell_coordinates_changed")), (c("other_spans") > 0, F.lit("table_source_span_set_changed")), (c("reassigned") + c("taken") > 0, F.lit("preserved_source_assignment_changed")),
    ]
    against = reduce(lambda out, step: out.when(*step), ladder[1:], F.when(*ladder[0]))
    return rows.select(
        "page_id", "candidate", "anchors", "anchor", against.isNull().alias("eligible"), F.coalesce(against, F.lit("eligible_monotonic_completion")).alias("reason"),
        lacked.alias("missing_before"), after.alias("missing_after"), "repaired", "newly_assigned",
    )

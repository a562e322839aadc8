"""Tables as semantic records: headers in rows, doubtful tables, keys, ids."""

import pytest

from plinth.operators import tables

GRID = "id string, row_count int, column_count int"
CELL = "id string, table_id string, row_index int, column_index int, text string"


def grid(spark, **texts):
    found = spark.createDataFrame([(t, len(rows), len(rows[0])) for t, rows in texts.items()], GRID)
    cells = [(f"{t}/{r}/{c}", t, r, c, x) for t, rows in texts.items() for r, row in enumerate(rows) for c, x in enumerate(row)]
    return found, spark.createDataFrame(cells, CELL)


def test_tables_under_header_rows(spark):
    found, cells = grid(
        spark,
        good=[["No", "Name", ""], ["", "", "Size"], ["1", "x", " 　"], ["2", "y", "9"], ["2", "z", "9"], ["\t", "w", "9"]],
        twice=[["No", "Name", "Name"], ["", "", ""], ["7", "x", "1"]],
        missing=[["No", "Name", "Width"], ["", "", ""], ["8", "x", "1"]],
        heads=[["No", "Name", "Size"], ["No", "", ""], ["9", "x", "1"]],
    )
    spec = tables.Interpretation("m", "ns", "room", ("No",), ("Size", "Name"), number_column="No", canonical_names={"Size": "area"})
    out = tables.project(spec, found, cells, tables.row_headers(cells, (0, 1)), (0, 1))
    assert {(r.table_id, r.row_index, r.code) for r in out["issues"].collect()} == {("good", 4, "duplicate_key"), ("good", 3, "duplicate_key"), ("good", 5, "missing_key"), ("twice", None, "missing_header"), ("missing", None, "missing_header"), ("heads", None, "several_headers")}
    (one,) = out["entities"].collect()
    assert (one.number, one.label, one.entity_class, one.row_index, one.resolution_state) == ("1", None, "room", 2, "exact")
    assert [(r.source_name, r.source_value, r.canonical_name) for r in out["properties"].collect()] == [("Name", "x", None)]
    assert {(r.source_kind, r.source_id) for r in out["bindings"].collect()} == {("pdf_table_cell", "good/2/0"), ("pdf_table_cell", "good/2/1")}
    assert {r.source_binding_id for r in out["properties"].collect()} < {r.id for r in out["bindings"].collect()}
    report = {r.table_id: (r.imported, r.skipped, r.ambiguous, r.errors, r.problem) for r in out["report"].collect()}
    assert report["good"] == (1, 3, 2, 1, None) and report["heads"] == (0, 0, 0, 0, "several_headers")


def test_ids_that_clash_and_incomplete_grids(spark):
    found, cells = grid(spark, a=[["K", "V"], ["1", "x"]], b=[["K", "V"], ["1", "y"]], c=[["K", "V"], ["2", "z"]], d=[["K", "V"], ["3", "z"]], e=[["K", ""], ["4", "z"]])
    cells = cells.filter("id <> 'd/1/1'")
    spec = tables.Interpretation("m", "ns", "x", ("K",))
    out = tables.project(spec, found, cells, tables.row_headers(cells, (0,)), (0,))
    assert {r.table_id: r.code for r in out["issues"].collect()} == {"a": "duplicate_id", "b": "duplicate_id", "d": "incomplete_grid", "e": "column_without_header"}
    (only,) = out["entities"].collect()
    again = tables.project(spec, found, cells, tables.row_headers(cells, (0,)), (0,), spark.createDataFrame([(only.id,)], "id string"))
    assert again["entities"].count() == 0 and {r.table_id for r in again["issues"].filter("code = 'duplicate_id'").collect()} == {"a", "b", "c"}
    outside = tables.project(spec, found, cells, tables.row_headers(cells, (0,)), (0, 2))
    assert {r.code for r in outside["issues"].collect()} == {"header_row_outside", "incomplete_grid"}
    empty = tables.project(spec, found.limit(0), cells.limit(0), tables.row_headers(cells.limit(0), (0,)), (0,))
    assert all(empty[name].count() == 0 for name in empty)


@pytest.mark.parametrize("wrong", [{"mapping_id": ""}, {"key_columns": ()}, {"key_columns": ("a", "a")}, {"property_columns": ("a",)}, {"property_columns": ("b", "b")}, {"kind": "room"}, {"scope": "all"}, {"property_columns": ("b",), "canonical_names": {"c": "d"}}])
def test_interpretations_that_make_no_sense(wrong):
    with pytest.raises(ValueError):
        tables.Interpretation(**{"mapping_id": "m", "namespace": "n", "entity_class": "c", "key_columns": ("a",)} | wrong)

"""Operators on small stores: statuses, precedence, order and plan shape."""

import pytest

from plinth.operators import postings as stored
from pyspark.sql import functions as F

from plinth.operators import entities, evaluation, facts, incremental, pages, routing, search, semantic, spatial, topology, validate


def content(spark, texts):
    return spark.createDataFrame([("k", f"{i:02d}", t) for i, t in enumerate(texts)], "record_kind string, record_id string, content string")


def test_query_language():
    assert search.parse("a b") == ("and", search.Term(("a",)), search.Term(("b",)))
    assert search.parse('"x y"* OR z') == ("or", search.Term(("x", "y"), True), search.Term(("z",)))
    for bad in ("D-105", "a AND", "(a", 'a "b', "NOT", "a:b"):
        with pytest.raises(search.QuerySyntaxError):
            search.parse(bad)


def test_search_ranks_falls_back_and_guards(spark):
    rows = content(spark, ["door width", "Door door", "window D-105", "Café hall", "nothing here"])
    ids = lambda q, n=20: [(r.record_id, r.path) for r in search.search_text(rows, q, n).collect()]
    assert ids("door") == [("01", "ranked"), ("00", "ranked")]
    assert ids("cafe") == [("03", "ranked")] and ids("d-105") == [("02", "substring")] and ids("othing") == [("04", "substring")]
    assert ids('"door width"') == [("00", "ranked")] and ids("wid*") == [("00", "ranked")] and ids("door NOT width") == [("01", "ranked")]
    assert ids("  ") == [] and ids("door", 1) == [("01", "ranked")] and ids("zzz") == []
    for bad in (0, True, 1.5):
        with pytest.raises(ValueError):
            search.search_text(rows, "door", bad)


def test_index_agrees_with_search(spark, tmp_path):
    rows = content(spark, ["a b a", "b c", "a b c d e", ""])
    found = stored.search(stored.build(rows, f"file://{tmp_path}/index"), "a b", 20).collect()
    postings, _ = search.build_index(rows)
    direct = search.ranked(rows, "a b", 20).collect()
    assert [(r.record_id, round(r.rank, 9)) for r in found] == [(r.record_id, round(r.rank, 9)) for r in direct]
    assert search.index_differences(rows, postings).count() == 0
    assert {r.problem for r in search.index_differences(rows, postings.filter("term <> 'c'")).collect()} == {"missing"}


@pytest.fixture
def things(spark):
    e = spark.createDataFrame([("e1", "Door", "Main door", "W-314"), ("e2", "Door", "Side", "W-314"), ("e3", "Room", "Hall", "314"), ("e4", "Equipment", None, "X")], "id string, entity_class string, label string, number string")
    p = spark.createDataFrame([("p1", "e4", "mark", "KM731"), ("p2", "e3", "mark", "KM731"), ("p3", "e1", "mark", "é")], "id string, semantic_entity_id string, source_name string, source_value string")
    return e, p


@pytest.mark.parametrize(("query", "cls", "limit", "status", "ids"), [
    ("w-314", None, 20, "multiple_exact", ["e1", "e2"]), ("W-314", None, 1, "multiple_exact", ["e1"]), ("W-31", None, 20, "candidates", ["e1", "e2"]), ("314", "room", 20, "exact_unique", ["e3"]),
    ("314", None, 20, "exact_unique", ["e3", "e1", "e2"]), ("km731", None, 20, "multiple_exact", ["e4", "e3"]), ("É", None, 20, "no_match", []), ("W-999", None, 20, "no_match", []), ("e", None, 1, "candidates", ["e2"]), (" ", None, 20, "no_match", []),
])
def test_discovery(spark, things, query, cls, limit, status, ids):
    asked = spark.createDataFrame([(query, cls)], "query string, entity_class string")
    rows = semantic.discover(*things, asked, limit).orderBy("position").collect()
    assert rows[0].status == status and [r.semantic_entity_id for r in rows if r.position] == ids


def test_discovery_rejects_bad_limits(spark, things):
    with pytest.raises(ValueError):
        semantic.discover(*things, spark.createDataFrame([("a", None)], "query string, entity_class string"), 0)


def relations(spark, rows):
    cols = "id string, source_kind string, source_id string, relation_type string, target_kind string, target_id string, phase_source_unique_id string, provenance string, confidence double, evidence_id string"
    return spark.createDataFrame([(i, "element", s, k, "space", t, p, "given", 1.0, None) for i, s, k, t, p in rows], cols)


def store(spark):
    elements = spark.createDataFrame([("d1", "s1", "given", 1.0), ("d2", None, "given", 1.0)], "id string, space_id string, provenance string, confidence double")
    spaces = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "id string")
    return elements, spaces


def test_connections_never_mix_unknown_phases(spark):
    elements, spaces = store(spark)
    edges = relations(spark, [("r1", "d1", "from_space", "s1", "p"), ("r2", "d1", "to_space", "s2", "p"), ("r3", "d2", "from_space", "s1", None), ("r4", "d2", "to_space", "s2", None), ("r5", "d1", "from_space", "s1", "q"), ("r6", "d1", "from_space", "s3", "q"), ("r7", "gone", "to_space", "s1", "p")])
    rows = {(r.connector_id, r.phase, r.first_relationship): (r.from_space, r.to_space, r.status, r.warning) for r in topology.connections(elements, spaces, edges).collect()}
    assert rows == {
        ("d1", "p", "r1"): ("s1", "s2", "complete", None), ("d2", None, "r3"): ("s1", None, "partial", "phase_context_missing"),
        ("d2", None, "r4"): (None, "s2", "partial", "phase_context_missing"), ("d1", "q", "r5"): (None, None, "partial", None),
    }
    per_space = topology.connections_of_spaces(topology.connections(elements, spaces, edges), edges)
    assert {(r.space_id, r.connected_space) for r in per_space.filter("status = 'complete'").collect()} == {("s1", "s2"), ("s2", "s1")}


def test_containment_ignores_sides_and_repeats(spark):
    elements, spaces = store(spark)
    edges = relations(spark, [("r1", "d1", "contained_in", "s2", "p"), ("r2", "d1", "contained_in", "s2", "p"), ("r3", "d1", "contained_in", "s2", "q"), ("r4", "d1", "from_space", "s3", "p"), ("r5", "d1", "contained_in", "gone", "p")])
    rows = {(r.space_id, r.relation_type, r.relationship_id) for r in topology.containment(elements, spaces, edges).collect()}
    assert rows == {("s1", "space_id", None), ("s2", "contained_in", "r1"), ("s2", "contained_in", "r3")}
    assert topology.related_spaces(elements, spaces, edges).count() == 4


def test_adjacency_needs_a_shared_source(spark):
    spaces = spark.createDataFrame([("a", "host", "l", "p"), ("b", "host", "l", "p"), ("c", "host", "other", "p"), ("d", "host", None, "p"), ("e", "host", "l", "p")], "id string, source_model_id string, level_id string, phase_source_unique_id string")
    loops = spark.createDataFrame([(f"l{s}", s, None, "outer") for s in "abcd"], "id string, space_id string, link_instance_id string, loop_kind string")

    def segment(i, loop, a, b, source="w", kind="line"):
        return (i, loop, None, *map(float, a), *map(float, b), "m", source, "link", kind)

    rows = [segment("1", "la", (0, 0, 0), (10, 0, 0)), segment("2", "lb", (8, 2, 0), (2, 2, 0)), segment("3", "lc", (0, 0, 0), (10, 0, 0)), segment("4", "ld", (0, 0, 0), (10, 0, 0)), segment("5", "la", (0, 0, 0), (5, 5, 0), kind="arc")]
    segments = spark.createDataFrame(rows, "id string, boundary_id string, link_instance_id string, start_x double, start_y double, start_z double, end_x double, end_y double, end_z double, source_model_id string, source_unique_id string, source_link_instance_id string, curve_kind string")
    pairs, report = topology.adjacency(spaces, loops, segments)
    assert {(r.space_id, r.adjacent_id, r.overlap) for r in pairs.collect()} == {("a", "b", 6.0), ("b", "a", 6.0)}
    assert {r.space_id: (r.status, r.warning) for r in report.collect()} == {
        "a": ("partial", "incomplete_boundary_coverage"), "b": ("ok", None), "c": ("ok", None), "d": ("insufficient_data", "subject_level_unavailable"), "e": ("insufficient_data", "no_spatial_boundaries"),
    }
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in pairs._jdf.queryExecution().executedPlan().toString() and "Join Inner" in plan


def test_opening_width_ladder(spark):
    elements = spark.createDataFrame([(f"e{i}", None) for i in range(8)], "id string, type_id string")
    parameters = spark.createDataFrame(
        [("p1", "element", "e1", "instance", "builtin:DOOR_WIDTH", "W", 900.0, "mm"), ("p2", "element", "e1", "instance", None, "opening width", 1.0, "mm"), ("p3", "element", "e2", "instance", None, "Opening_Width", 5.0, "mm"), ("p4", "element", "e2", "instance", None, "opening_width", 6.0, "mm")],
        "id string, entity_kind string, entity_id string, scope string, definition_key string, definition_name string, numeric_value double, unit string",
    )
    dims = spark.createDataFrame([("e3", "a1", "opening_width", 7.0, "mm"), ("e5", "a2", "opening_width", 8.0, "mm")], "entity_id string, id string, semantic_type string, numeric_value double, unit string")
    edges = spark.createDataFrame([("element", "e4", "served_by", "element", "e1"), ("element", "e5", "has_opening", "element", "e1"), ("element", "e6", "served_by", "element", "e1"), ("element", "e6", "served_by", "element", "e3"), ("element", "e7", "other", "element", "e1")], "source_kind string, source_id string, relation_type string, target_kind string, target_id string")
    subjects = spark.createDataFrame([("element", f"e{i}") for i in range(8)], "kind string, id string")
    got = {r.id: (r.status, r.target_id, r.tier, r.numeric_value) for r in facts.opening_width(subjects, elements, parameters, dims, edges).collect()}
    assert got == {
        "e0": ("not_found", None, None, None), "e1": ("ok", "e1", 1, 900.0), "e2": ("conflict", "e2", 2, None), "e3": ("ok", "e3", 5, 7.0), "e4": ("ok", "e1", 1, 900.0), "e5": ("ok", "e1", 1, 900.0), "e6": ("ambiguous", None, None, None), "e7": ("not_found", None, None, None),
    }


def test_relative_elevation_needs_a_proved_datum(spark):
    rows = [("a", 1, "1", 5.0, "mm", ["RFL + 5"]), ("b", 1, "2", 5.0, "mm", ["12"]), ("c", 1, "3", 5.0, "mm", ["RFL + 5"]), ("c", 1, "4", 5.0, "mm", ["FFL + 5"]), ("d", 1, "5", 5.0, "mm", ["RFL + 5"]), ("d", 1, "6", 6.0, "mm", ["RFL + 6"]), ("e", 2, "7", 9.0, "mm", ["FFL"]), ("e", 1, "8", 1.0, "mm", ["RFL + 1"])]
    frame = spark.createDataFrame(rows, "entity_id string, tier int, id string, numeric_value double, unit string, texts array<string>")
    free = {r.entity_id: (r.status, r.reference, r.numeric_value) for r in facts.relative_elevation(frame).collect()}
    assert free == {"a": ("ok", "rfl", 5.0), "b": ("insufficient_data", None, None), "c": ("ambiguous", None, None), "d": ("conflict", "rfl", None), "e": ("ok", "rfl", 1.0)}
    asked = {r.entity_id: r.status for r in facts.relative_elevation(frame, "FFL").collect()}
    assert asked == {"a": "insufficient_data", "b": "insufficient_data", "c": "ok", "d": "insufficient_data", "e": "insufficient_data"}


def test_grid_join_is_exact_and_not_nested(spark):
    import random

    rng = random.Random(1)
    rows = [(i, *[v for _ in range(3) for v in (lambda a: (a, a + rng.random() * 30))(rng.uniform(-100, 100))]) for i in range(200)]
    boxes = spark.createDataFrame(rows, "id int, min_x double, max_x double, min_y double, max_y double, min_z double, max_z double")
    found = spatial.box_join(boxes, boxes, 20.0)
    want = {(a[0], b[0]) for a in rows for b in rows if all(a[i] <= b[i + 1] and a[i + 1] >= b[i] for i in (1, 3, 5))}
    got = [(r.l_id, r.r_id) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert "NestedLoop" not in (plan := found._jdf.queryExecution().executedPlan().toString()) and "Cartesian" not in plan
    with pytest.raises(ValueError):
        spatial.candidates(boxes, (1, 0, 0, 1, 0, 1))


def test_large_boxes_do_not_bring_small_ones_together(spark):
    import random

    rng = random.Random(4)
    rows = [(i, *[v for _ in range(3) for v in (lambda a: (a, a + 10.0))(rng.uniform(0, 500))]) for i in range(4000)]
    rows += [(10_000 + i, *[v for _ in range(3) for v in (float(i), 520.0)]) for i in range(3)]
    boxes = spark.createDataFrame(rows, "id int, min_x double, max_x double, min_y double, max_y double, min_z double, max_z double")
    met, found = spatial._meetings(boxes, boxes, 10.0, ()).count(), spatial.box_join(boxes, boxes, 10.0).count()
    assert found > 4000 * 3 * 2 and met < 8 * found  # 4000 small boxes in one cell of the coarse level would meet 16 million times


def test_location_statuses(spark):
    rows = [("p", "a", None, "point", '{"point":[0,0,0]}'), ("q", "b", None, "point", '{"point":[0,0,0]}'), ("r", "b", None, "line", '{"start":[0,0,0],"end":[1,0,0]}'), ("s", "c", None, "bbox3d", "{}"), ("t", "d", "l1", "point", '{"point":[0,0,0]}'), ("u", "d", "l2", "point", '{"point":[9,0,0]}')]
    frame = spark.createDataFrame([(i, "element", e, k, g, j, "host", "mm") for i, e, k, g, j in rows], "id string, entity_kind string, entity_id string, link_instance_id string, geometry_type string, geometry_json string, coordinate_system string, unit string")
    places = spatial.resolved_locations(frame)
    assert {(r.entity_id, r.status) for r in places.collect()} == {("a", "ok"), ("b", "ambiguous_geometry"), ("c", "insufficient_data"), ("d", "ok")}
    assert {r.entity_id: r.status for r in spatial.occurrence_status(places).collect()}["d"] == "ambiguous_occurrence"


def test_tables_are_judged_in_order(spark):
    cells = lambda x, w=2: [(r, c, x + 4.0 * c, 4.0 * r, x + 4.0 * c + 4, 4.0 * r + 4) for r in range(2) for c in range(w)]
    rows = [("p", "a", 2, 2, 0.0, 0.0, 8.0, 8.0, cells(0.0)), ("p", "b", 2, 2, 4.0, 0.0, 12.0, 8.0, cells(4.0)), ("p", "c", 1, 2, 20.0, 0.0, 28.0, 8.0, cells(20.0)), ("p", "d", 2, 2, 30.0, 0.0, 38.0, 8.0, cells(30.0)[:3]), ("p", "e", 2, 2, 50.0, 0.0, 58.0, 8.0, cells(50.0))]
    cand = spark.createDataFrame(rows, "page_id string, candidate string, row_count int, column_count int, x_min double, y_min double, x_max double, y_max double, cells array<struct<row:int,column:int,x0:double,y0:double,x1:double,y1:double>>")
    spans = spark.createDataFrame([("p", 1.0, 1.0, 3.0, 3.0), ("p", 52.0, 1.0, 56.0, 3.0)], "page_id string, x_min double, y_min double, x_max double, y_max double")
    got = {r.candidate: (r.order_index, r.reason) for r in pages.accept_tables(cand, spans).collect()}
    assert got == {"a": (0, None), "b": (None, "overlapping_candidate"), "c": (None, "insufficient_dimensions"), "d": (None, "invalid_shape"), "e": (None, "ambiguous_span_mapping")}


def test_pairs_come_by_formula(spark):
    items = spark.createDataFrame([("g", i) for i in range(14)] + [("h", 1)], "g string, item int")
    explicit = spark.createDataFrame([("g", 0, 1), ("g", 0, 5)], "g string, a int, b int")
    pairs, report = topology.ordered_pairs(items, explicit, "g", "item")
    got = [(r.a, r.b) for r in pairs.orderBy("rank").collect()]
    want = [(a, b) for a in range(14) for b in range(a + 1, 14) if (a, b) not in {(0, 1), (0, 5)}][:32]
    assert got == want and [(r.eligible, r.planned, r.omitted) for r in report.filter("g = 'g'").collect()] == [(91, 32, 59)]


def test_snapshots(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "identity string, source_sha256 string")
    new = spark.createDataFrame([("b", "2"), ("c", "4"), ("d", "1")], "identity string, source_sha256 string")
    changes = incremental.compare(old, new)
    assert {(r.identity, r.state) for r in changes.collect()} == {("a", "removed"), ("b", "unchanged"), ("c", "changed"), ("d", "added")}
    assert incremental.differences(incremental.update(old, new, changes), new).count() == 0
    assert incremental.differences(old, new).count() == 4


def test_metrics(spark):
    cases = spark.createDataFrame([("x",), ("y",), ("z",)], "case_id string")
    seen = spark.createDataFrame([("x", f"r{i}", i) for i in range(1, 9)] + [("y", "q", 1)], "case_id string, result_id string, position int")
    good = spark.createDataFrame([("x", "r6"), ("y", "q"), ("z", "w")], "case_id string, result_id string")
    rows = {r.case_id: r for r in evaluation.ranking(seen, good, cases, 5).collect()}
    assert rows["x"].hit_10 is None and rows["x"].hit_5 is False and rows["y"].hit_1 is True and rows["z"].reciprocal_rank == 0
    assert evaluation.ranking(seen, good, cases, 10).filter("case_id = 'x'").first().hit_10 is True
    pr = {r.case_id: (r.precision, r.recall) for r in evaluation.precision_recall(seen, good, cases).collect()}
    assert pr == {"x": (0.125, 1.0), "y": (1.0, 1.0), "z": (None, 0.0)}


def test_routing_drops_bad_surfaces(spark):
    rows = [("e", "occ", "1", "d", 1, None, None, None, None, None, "exact", "r1"), ("e", "occ", "2", "d", 1, 0.0, 0.0, 5.0, 5.0, routing.SPACE, "exact", "r2"), ("e", "occ", "3", "d", 1, 0.0, 0.0, 5.0, 5.0, routing.SPACE, "page", "r3"), ("e", "occ", "4", "d", 1, 5.0, 0.0, 5.0, 5.0, routing.SPACE, "exact", "r"), ("e", "occ", "5", "d", 1, 0.0, 0.0, 5.0, 5.0, "other", "exact", "r"), ("e", "occ", "6", "x", 1, None, None, None, None, None, "exact", "r"), ("e", "occ", "7", "d", 0, None, None, None, None, None, "exact", "r")]
    frame = spark.createDataFrame(rows, "entity_id string, kind string, id string, document_id string, pdf_page int, x_min double, y_min double, x_max double, y_max double, coordinate_space string, bbox_quality string, reason string")
    got = routing.surfaces(frame, spark.createDataFrame([("d", "doc")], "id string, identity string"))
    assert {(r.input_scope, tuple(r.source_refs), tuple(r.routing_reasons), r.bbox_quality) for r in got.collect()} == {("page", ("occ:1",), ("r1",), "exact"), ("region", ("occ:2", "occ:3"), ("r2", "r3"), "exact")}
    assert routing.pages_of(got).count() == 1 and routing.stages(got).filter("skipped is null").count() == 3


def test_violations(spark):
    rows = spark.createDataFrame([("1", "a", None), ("2", "b", 5), ("3", None, 5), ("4", "b", 50)], "id string, ref string, n int")
    parents = spark.createDataFrame([("a",)], "key string")
    assert [r.id for r in validate.foreign_key(rows, "ref", parents, "key", "t", "id").orderBy("id").collect()] == ["2", "4"]
    assert [r.id for r in validate.unique(rows, ["ref", "n"], "t").collect()] == [] and [r.id for r in validate.unique(rows, ["ref"], "t").collect()] == ["b"]
    assert [r.id for r in validate.check(rows, F.col("n") < 10, "n", "t", "id").collect()] == ["4"]


def test_binding_states_are_zero_filled(spark):
    rows = spark.createDataFrame([("e", "b2", "ambiguous"), ("e", "b1", "ambiguous"), ("f", "b3", "exact")], "semantic_entity_id string, id string, resolution_state string")
    got = {r.semantic_entity_id: (r.n_exact, r.n_ambiguous, r.n_unresolved, r.ambiguous_ids) for r in entities.binding_states(rows).collect()}
    assert got == {"e": (0, 2, 0, ["b1", "b2"]), "f": (1, 0, 0, [])}

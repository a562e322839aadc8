"""Stores, snapshots, validation and the façade, from records to answers."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from plinth import evaluation
from plinth.__main__ import typed
from plinth.api import Knowledge
from plinth.operators import payload, postings
from plinth.sources import project
from plinth.sources.store import Store, StoreError, from_records, read_snapshot, text_records, verify_sources
from plinth.streaming.windows import event_rates

TRUST = {"provenance": "given", "confidence": 1.0}
RECORDS = {
    "documents": [{"id": "doc", "identity": "pdf/a.pdf", "title": "A", "source_filename": "a.pdf", "source_sha256": "0" * 64}],
    "source_models": [{"id": "host", "role": "host", "title": "Host", "model_identity_kind": "guid", "model_identity": "1"}],
    "sheets": [{"id": "sh1", "document_id": "doc", "number": "A-1", "name": "Plan", "pdf_page": 1, "export_order": 1}],
    "views": [{"id": "v1", "document_id": "doc", "name": "Level 1"}],
    "viewports": [{"id": "vp", "sheet_id": "sh1", "view_id": "v1", "placement_kind": "viewport"}],
    "levels": [{"id": "l1", "name": "L1", "elevation": 0, "unit": "mm", "source_model_id": "host", **TRUST}, {"id": "l2", "name": "L2", "elevation": 6000, "unit": "mm", "source_model_id": "host", **TRUST}],
    "spaces": [{"id": "s1", "kind": "Room", "name": "機械室", "level_id": "l1", "source_model_id": "host", "phase_source_unique_id": "p", **TRUST}, {"id": "s2", "kind": "Corridor", "name": "Corridor", "level_id": "l1", "source_model_id": "host", "phase_source_unique_id": "p", **TRUST}],
    "element_types": [{"id": "t1", "type_name": "Door 900", "category": "Doors", **TRUST}],
    "elements": [{"id": "d1", "name": "Door", "category": "Doors", "type_id": "t1", "space_id": "s1", "level_id": "l1", **TRUST}, {"id": "d2", "name": "Gate", "category": "Doors", "type_id": "t1", **TRUST}],
    "evidence": [{"id": "e1", "document_id": "doc", "sheet_id": "sh1", "pdf_page": 1}],
    "parameters": [{"id": "w1", "entity_kind": "element", "entity_id": "d1", "scope": "instance", "definition_name": "Width", "definition_key": "builtin:DOOR_WIDTH", "numeric_value": 900, "unit": "mm", "value_text": "900", "evidence_id": "e1", **TRUST}],
    "relationships": [{"id": "r1", "source_kind": "element", "source_id": "d1", "relation_type": "from_space", "target_kind": "space", "target_id": "s1", "phase_source_unique_id": "p", **TRUST}, {"id": "r2", "source_kind": "element", "source_id": "d1", "relation_type": "to_space", "target_kind": "space", "target_id": "s2", "phase_source_unique_id": "p", **TRUST}],
    "annotations": [{"id": "a1", "kind": "spot_elevation", "display_text": "SSL + 740 mm", "numeric_value": 740, "unit": "mm", "related_entity_kind": "element", "related_entity_id": "d1", **TRUST}],
    "entity_appearances": [{"id": f"ap{i}", "entity_kind": "element", "entity_id": "d1", "viewport_id": "vp", "pdf_page": 1, "coordinate_space": "pdf_points_top_left", "appearance_kind": "model", "bbox_quality": "page_only", "provenance": "given"} for i in (1, 2)],
    "semantic_entities": [{"id": "se", "entity_class": "door", "label": "Main", "number": "G-207", "instance_or_type": "instance", "resolution_state": "exact", "provenance": "given"}],
    "semantic_bindings": [{"id": "sb", "semantic_entity_id": "se", "source_kind": "element", "source_id": "d1", "resolution_state": "exact", "provenance": "given"}],
    "semantic_properties": [{"id": "sp", "semantic_entity_id": "se", "source_name": "mark", "source_value": "QX27", "scope": "instance", "provenance": "given", "source_binding_id": "sb"}],
    "geometries": [{"id": f"g{n}", "entity_kind": "element", "entity_id": n, "geometry_type": "point", "geometry": {"point": [x, 0, 0]}, "coordinate_system": "host_revit_internal_origin", "unit": "mm", "min_x": x, "max_x": x, "min_y": 0, "max_y": 0, "min_z": 0, "max_z": 0, **TRUST} for n, x in (("d1", 0), ("d2", 3))],
    "search_content": [{"record_kind": "element", "record_id": "d1", "content": "Door G-207"}, {"record_kind": "space", "record_id": "s1", "content": "機械室"}],
}


@pytest.fixture(scope="module")
def store(spark):
    return from_records(spark, RECORDS)


@pytest.fixture(scope="module")
def core(store):
    return Knowledge(store)


def test_sound_store_has_no_violation_and_survives_a_round_trip(spark, store, tmp_path):
    assert store.violations().collect() == []
    path = f"file://{tmp_path}/store"
    (tmp_path / "store").mkdir()
    store.write(path)
    store.write(path)
    again = Store.open(spark, path)
    assert again.table("elements").exceptAll(store.table("elements")).count() == 0 and again.has("semantic_projection") and not again.has("pdf_tables")
    assert len(list((tmp_path / "store").glob("snapshot-*"))) == 2 and again.table("pdf_tables").count() == 0


@pytest.mark.parametrize(("table", "change", "rule"), [
    ("elements", {"type_id": "gone"}, "fk_type_id"), ("spaces", {"kind": "Hall"}, "check_kind in ('Room','Space','Zone','Corridor')"), ("documents", {"source_sha256": "x"}, "check_source_sha256 rlike '^[0-9a-f]{64}$'"),
    ("levels", {"name": None}, "not_null_name"), ("parameters", {"unit": None}, "check_numeric_value is null or unit is not null"), ("evidence", {"pdf_page": 0}, "check_pdf_page >= 1"), ("semantic_bindings", {"source_id": None}, "check_source_id is not null or resolution_state in ('ambiguous','unresolved')"),
])
def test_one_change_breaks_one_rule(spark, table, change, rule):
    broken = from_records(spark, {table: [RECORDS[table][0] | change, *RECORDS[table][1:]]})
    assert rule in {r.rule for r in broken.violations().collect()}


def test_bad_records_and_snapshots_are_refused(spark, tmp_path):
    with pytest.raises(StoreError):
        from_records(spark, {"walls": []})
    with pytest.raises(StoreError):
        from_records(spark, {"views": [{"id": "v", "colour": "red"}]})
    for text in ('{"snapshot_version": 1, "snapshot_version": 1}', '{"snapshot_version": 9, "project": {}, "records": {}}', '{"project": {}, "records": {}}', '{"snapshot_version": NaN}'):
        (tmp_path / "s.json").write_text(text)
        with pytest.raises(StoreError):
            read_snapshot(spark, f"file://{tmp_path}/s.json")
    (tmp_path / "s.json").write_text(json.dumps({"snapshot_version": 1, "project": {"project_id": "x"}, "records": {"levels": RECORDS["levels"]}}))
    assert read_snapshot(spark, f"file://{tmp_path}/s.json").table("levels").count() == 2


def test_answers(core):
    assert core.get_entity("space", "s2")["name"] == "Corridor" and core.get_entity("space", "x") is None
    assert [r["id"] for r in core.find_entities("DOOR")] == ["t1", "d1"] and len(core.find_entities("")) == 7
    assert core.search_text("機械室")[0]["record_id"] == "s1" and core.search_text("械室")[0]["record_id"] == "s1" and core.search_text("g-207")[0]["record_id"] == "d1"
    found = core.search_semantic_entities("qx27")
    assert found["status"] == "exact_unique" and found["candidates"][0]["semantic_entity"]["id"] == "se"
    entity = core.get_semantic_entity("se")
    assert [p["fact_kind"] for p in entity["properties"]] == ["parameter", "semantic_property"] and [r["direction"] for r in entity["relationships"]] == ["outgoing", "outgoing"] and core.get_semantic_entity("x") is None
    assert core.get_numeric_facts("element", "d1")[0]["evidence"]["sheet_number"] == "A-1"
    assert len(core.get_occurrence_evidence("element", "d1")) == 2 and [t["source_id"] for t in core.get_navigation_targets("element", "d1")] == ["ap1"]


def test_topology_answers(core):
    assert [r["relation_type"] for r in core.get_containing_spaces("d1")] == ["space_id"] and core.get_contained_elements("s2") == []
    assert core.get_same_type_elements("d1") == {"status": "ok", "type_id": "t1", "elements": ["d2"]} and core.get_same_type_elements("x")["status"] == "not_found"
    assert core.get_space_connections("s1")[0]["connected_space"] == "s2"
    assert core.get_adjacent_spaces("s1")["warnings"] == ["no_spatial_boundaries"] and core.get_adjacent_spaces("x")["status"] == "not_found"
    assert core.get_level_difference("l2", "l1")["signed_difference"] == 6000
    impact = core.get_change_impact("d1")
    assert (impact["total_instances"], impact["instances_with_spatial_context"], impact["drawing_occurrences"], impact["warnings"]) == (2, 1, 1, "spatial_context_partial,drawing_occurrence_partial")


def test_fact_and_location_answers(core):
    assert core.get_opening_width("element", "d1")["numeric_value"] == 900 and core.get_opening_width("element", "d2")["status"] == "not_found"
    elevation = core.get_relative_elevation("d1")
    assert {k: elevation[k] for k in ("entity_id", "status", "reference", "fact_id", "numeric_value", "unit", "candidate_references", "fact_source_kind", "supporting_fact_ids")} == {
        "entity_id": "d1", "status": "ok", "reference": "ssl", "fact_id": "a1", "numeric_value": 740.0, "unit": "mm", "candidate_references": [], "fact_source_kind": "annotation", "supporting_fact_ids": ["a1"],
    }
    assert elevation["display_text"] and isinstance(elevation["evidence"], list)
    width = core.get_opening_width("element", "d1")
    assert width["candidate_ids"] == [] and [(e["evidence_kind"], e["id"]) for e in width["evidence"]] == [("evidence", "e1"), ("appearance", "ap1"), ("appearance", "ap2")]
    assert core.get_relative_elevation("d1", "FFL")["status"] == "insufficient_data" and core.get_relative_elevation("d2")["status"] == "not_found"
    assert core.find_nearby_by_location("element", "d1", 3.0)["results"][0]["distance"] == 3 and core.get_nearest_by_location("element", "d1", 2.0)["status"] == "no_match" and core.get_nearest_by_location("element", "d1", 0.0)["status"] == "no_match"
    assert core.get_location_distance("element", "d1", "element", "d2") == {"status": "ok", "distance": 3.0, "unit": "mm", "geometry_basis": "point_to_point", "geometry_ids": ["gd1", "gd2"]} and core.get_location_distance("element", "x", "element", "d1")["status"] == "not_found"
    assert len(core.get_spatial_candidates((-1, 1, -1, 1, -1, 1))) == 1


def test_contexts_of_an_entity(core):
    found = core.get_architectural_evidence_context("se")
    assert found["coverage"] == {"binding_count": 1, "property_count": 2, "relationship_count": 2, "spatial_context_count": 1, "drawing_occurrence_count": 2, "evidence_count": 1, "source_document_count": 1}
    assert found["resolution"]["binding_counts"]["exact"] == 1 and found["evidence"][0]["navigation"]["can_zoom"] is False and found["source_documents"][0]["identity"] == "pdf/a.pdf"
    around = found["spatial_contexts"][0]["spatial_context"]
    assert around["level"]["id"] == "l1" and [c["space_id"] for c in around["containment"]] == ["s1"] and around["type_siblings"]["elements"] == ["d2"] and around["semantic_refs"][0]["semantic_entity_id"] == "se"
    assert core.get_architectural_evidence_context("x") is None and core.get_semantic_spatial_context("x") is None and core.get_semantic_drawing_context("x") is None
    surfaces = core.get_vision_evidence_candidates("se")
    assert len(surfaces) == 1 and surfaces[0]["input_scope"] == "page" and surfaces[0]["source_refs"] == ["drawing_occurrence:ap1", "drawing_occurrence:ap2", "evidence:e1"]
    assert core.get_spatial_context("space", "s1")["adjacency"]["status"] == "insufficient_data" and core.get_spatial_context("space", "x")["status"] == "not_found"
    assert core.get_same_space_elements("d1") == [{"space_id": "s1", "elements": ["d1"]}] and [r["id"] for r in core.get_type_instances("t1")] == ["d1", "d2"]
    assert core.get_evidence_navigation("e1")["sheet_number"] == "A-1" and core.get_pdf_evidence("x") is None and core.capabilities()["pdf_tables"] is False and core.list_pdf_tables() == []


def test_evaluation_of_a_suite(core):
    case = lambda i, op, args, expected: {"case_id": i, "baseline": {"operation": op, "arguments": args}, "expected": expected}
    suite = {"format": "architectural-retrieval-cases", "version": 1, "cases": [
        case("a", "search_semantic_entities", {"query": "qx27"}, {"status": "exact_unique", "semantic_entity_ids": ["se"]}),
        case("b", "semantic_discovery_context", {"query": "G-207"}, {"status": "ok", "evidence": [{"document_identity": "pdf/a.pdf", "pdf_page": 1}], "checks": [{"path": ["context", "coverage", "evidence_count"], "equals": 1}, {"path": ["context", "bindings"], "contains": {"source_id": "d1"}}, {"path": ["nowhere"], "equals": 1}]}),
        case("c", "search_text", {"query": "機械室", "limit": 5}, {"source_references": [{"kind": "space", "id": "s1"}], "status": "returned"}),
        case("d", "get_drawing_reference", {"reference_id": "none"}, {"status": "not_found"}),
    ]}
    got = {name: df.collect() for name, df in evaluation.evaluate(core, json.dumps(suite)).items()}
    state = {r.case_id: r.state for r in got["status"]}
    field = {(r.case_id, r.field): r.state for r in got["fields"]}
    rank = {r.case_id: r for r in got["ranking"]}
    assert state == {"a": "pass", "b": "pass", "c": "pass", "d": "pass"}
    assert field["a", "semantic_entity_ids"] == "hit" and field["a", "bbox"] == "not_applicable" and field["c", "source_references"] == "hit" and field["b", "pdf_pages"] == "hit" and field["d", "view_ids"] == "not_applicable"
    assert [(r.case_id, r.recall) for r in got["evidence"]] == [("b", 1)]
    assert [(r.status, r.reason) for r in sorted(got["checks"], key=lambda r: r.check)] == [("pass", None), ("pass", None), ("fail", "path_missing")]
    assert set(rank) == {"a", "c"} and rank["a"].reciprocal_rank == 1 and rank["c"].hit_1 is True and rank["c"].hit_10 is None and rank["a"].hit_10 is True
    for text in ('{"a": 1, "a": 2}', '{"a": NaN}', '{"a": 1e999}', json.dumps(suite | {"version": 2}), json.dumps(suite | {"cases": suite["cases"] + suite["cases"][:1]})):
        with pytest.raises(ValueError):
            evaluation.suite_cases(core.store.spark, text)


def test_every_breach_of_cases_is_told(spark):
    good = {"case_id": "a", "baseline": {"operation": "search_text", "arguments": {"query": ""}}, "expected": {"checks": [{"path": ["a", 0], "contains": {"free": [{"of": None}]}}], "pdf_pages": [2], "evidence": [{"evidence_id": "e"}]}}
    run = lambda op, **a: {"baseline": {"operation": op, "arguments": a}}
    want = lambda **x: {"expected": x}
    bad = [
        ({"case_id": " "}, "not words"), ({"extra": 1}, "unknown field"), (run("drop"), "not operation"), (run("search_text"), "lacks an argument"), (run("search_text", query="q", entity_class="x"), "has an argument of another operation"), (run("search_text", query="q", limit=0), "not limit"),
        (want(pdf_pages=[0]), "not page"), (want(pdf_pages=[True]), "not page"), (want(checks=[{"path": [-1], "equals": 1}]), "not step"), (want(checks=[{"path": []}]), "not one of equals and contains"), (want(evidence=[{"bbox": [0, 0, 1, 1]}]), "names no evidence, source or page"),
        (want(evidence=[{"evidence_id": "e", "bbox": [0, 0, 1, 1]}]), "a box without page and coordinate space"), (want(evidence=[{"evidence_id": "e", "bbox": [2, 0, 1, 1]}]), "not box"), (want(source_references=[{"kind": "k"}]), "lacks id"), (want(status=3), "not words"),
    ]
    rows = [("good", json.dumps(good)), ("text", "{"), *[(f"b{i}", json.dumps(good | {"case_id": f"b{i}"} | x)) for i, (x, _) in enumerate(bad)]]
    found = {}
    for r in evaluation.breaches(spark.createDataFrame(rows, "case string, json string")).collect():
        found.setdefault(r["case"], set()).add(r["rule"])
    assert "good" not in found and found["text"] == {"not strict JSON"}
    for i, (_, rule) in enumerate(bad):
        assert rule in found[f"b{i}"], (i, rule, found[f"b{i}"])


def test_cells_compare_by_value_and_selectors_are_partial(spark):
    df = spark.createDataFrame([("x", '{"l": [{"a": {"b": 1.0, "c": 2}}, {"a": {"b": true}}, {"a": [1]}, {"a": {}}], "1": null}')], "case_id string, payload string")
    rows = payload.cells(df, "case_id", "payload")
    got = {"".join(r["path"]): (r["kind"], r["value"]) for r in rows.collect()}
    assert got[".l#0.a.b"] == ("number", "1") and got[".l#1.a.b"] == ("boolean", "true") and got[".1"] == ("null", "null")
    bases = spark.createDataFrame([("x", i, [".l"]) for i in range(3)], "case_id string, check int, path array<string>")
    wanted = spark.createDataFrame([("x", 0, [".a", ".b"], "integer", "1"), ("x", 1, [".a"], "object", "{}"), ("x", 2, [".a"], "array", "[1]")], "case_id string, check int, rel array<string>, kind string, value string")
    assert sorted((r["check"], r["item"]) for r in payload.holding(rows, "case_id", bases, wanted).collect()) == [(0, "#0"), (1, "#0"), (1, "#1"), (1, "#3"), (2, "#2")]


def sidecar(name, page, words, table=False):
    identity = f"projects/p/source/{name}.pdf"
    span = lambda i, t: {"order_index": i, "text": t, "bbox": [10.0 * i, 0, 10.0 * i + 9, 9], "provenance": "embedded_pdf_text"}
    line = {"order_index": 0, "text": "".join(words), "bbox": [0, 0, 99, 9], "provenance": "embedded_pdf_text", "spans": [span(i, w) for i, w in enumerate(words)]}
    block = {"order_index": 0, "text": line["text"], "bbox": [0, 0, 99, 9], "provenance": "embedded_pdf_text", "lines": [line]}
    cell = lambda r, c: {"row_index": r, "column_index": c, "row_span": 1, "column_span": 1, "bbox": [10.0 * c, 10.0 * r, 10.0 * c + 10, 10.0 * r + 10], "text": words[c] if r == 0 else "", "span_refs": [{"block_index": 0, "line_index": 0, "span_index": c}] if r == 0 else []}
    tables = [{"order_index": 0, "bbox": [0, 0, 20, 20], "row_count": 2, "column_count": 2, "provenance": "derived_pdf_table", "cells": [cell(r, c) for r in (0, 1) for c in (0, 1)]}] if table else []
    counts = {"status": "completed" if table else "no_candidates", "algorithm": "lines", "algorithm_version": "1", "library": "none", "library_version": "0", "candidate_count": len(tables), "accepted_count": len(tables), "rejected_count": 0, "rejection_counts": {}}
    sha = hashlib.sha256("".join(words).encode()).hexdigest()
    return {"document_id": "doc-" + hashlib.sha256(identity.encode()).hexdigest()[:24], "source_file": identity, "source_sha256": sha, "page": page, "width_points": 612.0, "height_points": 792.0, "rotation": 0, "media_box": [0, 0, 612, 792], "crop_box": [0, 0, 612, 792], "coordinate_space": "pdf_points_top_left", "text_blocks": [block], "table_extraction": counts, "tables": tables}


def project_of(spark, folder, cars):
    folder.mkdir()
    for i, car in enumerate(cars):
        (folder / f"{i}.json").write_text(json.dumps(car))
    docs = [(c["document_id"], c["source_file"], c["source_sha256"], f"projects/p/knowledge/k{i}", 1, "2") for i, c in enumerate(cars)]
    return project.sidecars(spark, f"file://{folder}"), spark.createDataFrame(docs, project.MANIFEST)


def test_a_project_is_built_updated_and_bundled(spark, tmp_path):
    cars = [sidecar("a", 1, ["red ", "blue"], table=True), sidecar("b", 1, ["green ", "gold"])]
    pages_, docs = project_of(spark, tmp_path / "one", cars)
    assert project.sidecar_problems(pages_, docs).collect() == [] and project.manifest_problems(docs, "p", "2").collect() == []
    store = project.build(spark, pages_, docs, "p", "2")
    assert store.violations().collect() == [] and store.breaches().collect() == [] and project.eligible(store, "p", "2") == []
    core = Knowledge(store)
    table = core.list_pdf_tables()[0]
    whole = core.get_pdf_table(table["table_id"])
    assert [c["text"] for c in whole["cells"]] == ["red ", "blue", "", ""] and whole["document"]["source_filename"] == "a.pdf" and core.list_pdf_tables("x") == []
    cell = core.search_pdf_table_cells("blue")[0]
    assert core.get_pdf_table_cell(cell["cell_id"])["table"]["row_count"] == 2 and cell["source_spans"][0]["text"] == "blue"
    assert core.get_pdf_text_span(cell["source_spans"][0]["span_id"])["source_ref"]["span_index"] == 1 and core.get_pdf_table("x") is None
    with pytest.raises(ValueError):
        core.list_pdf_tables(pdf_page=0)
    changed = [sidecar("b", 1, ["green ", "lead"]), sidecar("c", 1, ["new"])]
    fresh, _ = project_of(spark, tmp_path / "two", changed)
    everything, manifest = project_of(spark, tmp_path / "three", changed)
    updated = project.update(store, manifest, fresh, "p", "2")
    rebuilt = project.build(spark, everything, manifest, "p", "2")
    for name in rebuilt.tables:
        cols = rebuilt.table(name).columns
        a, b = updated.table(name).select(*cols), rebuilt.table(name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert project.update(rebuilt, manifest, fresh, "p", "2") is rebuilt
    kept = f"file://{tmp_path}/kept"
    store.write(kept, index=True)
    project.update(Store.open(spark, kept), manifest, fresh, "p", "2").write(kept)
    now = Store.open(spark, kept)
    assert len(now.index.segments) == 2 and postings.differences(now.index, rebuilt.table("search_content")).collect() == []
    assert [x["text"] for x in Knowledge(now).search_pdf_text("lead")] == ["green lead"] and Knowledge(now).search_pdf_text("gold") == [] and Knowledge(now).search_text("red") == []
    with pytest.raises(StoreError, match="full rebuild"):
        project.update(store, manifest, fresh, "other", "2")
    sources = manifest.select(F.col("source_file").alias("path"), F.col("source_sha256").alias("sha"))
    path = f"file://{tmp_path}/bundle"
    project.bundle(rebuilt, sources, path)
    assert project.bundle_problems(spark, path, sources).collect() == []
    assert {r.problem for r in project.bundle_problems(spark, path, sources.withColumn("sha", F.lit("0"))).collect()} == {"changed"}
    with pytest.raises(StoreError):
        project.bundle(rebuilt, sources.limit(1), path)
    text = {r.path.split("/", 1)[1]: r.text for r in project.markdown(pages_.filter("source_file like '%a.pdf'")).collect()}
    assert "red blue" in text["pages/p0001.md"] and "[Page 1](pages/p0001.md): minimal_text" in text["index.md"]


@pytest.mark.parametrize(("change", "rule"), [
    (lambda c: c.update(source_sha256="0" * 64), "identity"), (lambda c: c.update(page=2), "page"), (lambda c: c.update(coordinate_space="up"), "space"), (lambda c: c.update(crop_box=[0, 0, -1, 1]), "crop_box"), (lambda c: c["text_blocks"][0].update(text="x"), "b_text"),
    (lambda c: c["text_blocks"][0]["lines"][0].update(order_index=1), "l_order"), (lambda c: c["text_blocks"][0]["lines"][0]["spans"][0].update(provenance="guess"), "s_provenance"), (lambda c: c["table_extraction"].update(accepted_count=0), "extraction_counts"),
    (lambda c: c["tables"][0].update(row_count=3), "table_shape"), (lambda c: c["tables"][0]["cells"][1].update(column_index=0), "cell_place"), (lambda c: c["tables"][0]["cells"][3]["bbox"].__setitem__(2, 90), "cell_box"), (lambda c: c["tables"][0]["cells"][0]["span_refs"][0].update(span_index=9), "reference"),
    (lambda c: c["tables"][0]["cells"][0]["span_refs"][0].update(span_index=1), "reference_box"), (lambda c: c["tables"][0]["cells"][0].update(text="pink"), "cell_text"),
])
def test_one_change_breaks_a_sidecar(spark, tmp_path, change, rule):
    good, car = sidecar("a", 1, ["red ", "blue"], table=True), sidecar("a", 1, ["red ", "blue"], table=True)
    change(car)
    pages_, _ = project_of(spark, tmp_path / "x", [car])
    docs = spark.createDataFrame([(good["document_id"], good["source_file"], good["source_sha256"], 1)], "document_id string, source_file string, source_sha256 string, page_count bigint")
    assert rule in {r.rule for r in project.sidecar_problems(pages_, docs).collect()}
    with pytest.raises(StoreError):
        project.build(spark, pages_, docs, "p", "2")


def test_manifests_and_ingestion(spark, tmp_path):
    good = sidecar("a", 1, ["x"])
    row = lambda **k: tuple((dict(document_id=good["document_id"], source_file=good["source_file"], source_sha256="0" * 64, knowledge_path="projects/p/knowledge/a", page_count=1, pipeline_version="2") | k).values())
    rows = spark.createDataFrame([row(), row(source_file="projects/p/source/../b.pdf", knowledge_path="/b", source_sha256="x", page_count=0, pipeline_version="1")], project.MANIFEST)
    found = {(r.rule, r.id) for r in project.manifest_problems(rows, "p", "2", spark.createDataFrame([(good["source_file"], "1" * 64)], "path string, sha string")).collect()}
    bad = "projects/p/source/../b.pdf"
    assert found == {(r, bad) for r in ("source_path", "knowledge_path", "sha256", "version", "document_id", "page_count", "source_missing")} | {("document_id_twice", good["document_id"]), ("source_changed", good["source_file"])}
    (tmp_path / "m.json").write_text(json.dumps({"project_id": "p", "pipeline_version": "2", "documents": [{"document_id": "d", "source_file": "b"}, {"document_id": "e", "source_file": "a"}]}))
    head, listed = project.read_manifest(spark, f"file://{tmp_path}/m.json")
    assert head["project_id"] == "p" and [r.source_file for r in listed.collect()] == ["a", "b"] and project.marker("2") == ".pdf-pipeline-v2"
    old = spark.createDataFrame([row(source_file=f, knowledge_path=f"k{f}") for f in "abc"], project.MANIFEST)
    now = spark.createDataFrame([("a", "0" * 64), ("b", "1" * 64), ("d", "0" * 64)], "path string, sha string")
    trees = spark.createDataFrame([("ka", True), ("kb", True)], "knowledge_path string, valid boolean")
    assert {r.source_file: r.action for r in project.ingestion(old, now, trees).collect()} == {"a": "unchanged", "b": "process", "c": "remove", "d": "process"}
    with pytest.raises(StoreError):
        project.created_from("3")


def test_a_store_that_breaks_a_rule_is_not_written(spark, store, tmp_path):
    path = f"file://{tmp_path}/checked"
    store.write(path, check=True)
    broken = from_records(spark, {"levels": [RECORDS["levels"][0] | {"name": None}]})
    with pytest.raises(StoreError, match="not_null_name"):
        broken.write(path, check=True)
    assert Store.open(spark, path).table("levels").count() == 2


def test_command_line_arguments_are_typed():
    assert typed(Knowledge.search_text, ["door", "5"]) == ["door", 5] and typed(Knowledge.find_nearby_by_location, ["element", "d1", "3.5"]) == ["element", "d1", 3.5] and typed(Knowledge.get_spatial_candidates, ["[0, 1]"]) == [[0, 1]]


def test_text_source_builds_a_sound_store(spark):
    docs = spark.createDataFrame([("a", "one\n\ntwo"), ("b", "one")], "identity string, text string")
    store = Store(spark, text_records(docs))
    assert store.violations().collect() == [] and Knowledge(store).search_pdf_text("two")[0]["document"]["identity"] == "a"


def test_sources_are_verified(spark):
    files = spark.createDataFrame([("file:/x/a.pdf", bytearray(b"a")), ("file:/x/b.pdf", bytearray(b"b"))], "path string, content binary")
    good = "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"
    manifest = spark.createDataFrame([("a.pdf", good), ("b.pdf", good), ("c.pdf", good), ("A.pdf", "x")], "source_file string, source_sha256 string")
    assert {(r.source_file, r.problem) for r in verify_sources(files, manifest).collect()} == {("b.pdf", "stale"), ("c.pdf", "missing"), ("A.pdf", "bad_sha256"), ("a.pdf", "case_clash")}


def test_stream_counts(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet("/root/testdata/sf0.001/events.parquet*")
    query = event_rates(stream).writeStream.outputMode("complete").format("memory").queryName("rates").start()
    query.processAllAvailable()
    query.stop()
    assert spark.sql("SELECT sum(n) FROM rates").first()[0] == events.count()


def test_entry_contract(spark):
    found = __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(found)
    assert __spark_entry__.entry(spark).count() > 0

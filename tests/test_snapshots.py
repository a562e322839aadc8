"""Record snapshots: strict parsing, types, nested values, and every breach as a row."""

import json

import pytest

from plinth.sources import snapshots
from plinth.sources.store import StoreError, read_snapshot

LEVEL = {"id": "l1", "name": "é", "elevation": 1, "unit": "mm", "provenance": "given", "confidence": 1.0}


def docs(spark, *texts):
    return snapshots.parsed(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "snapshot string, text string"))


def whole(records, **other):
    return json.dumps({"snapshot_version": 1, "project": {"project_id": "p"}, "records": records} | other)


def test_records_have_the_types_of_their_tables(spark):
    line = {"id": "g", "geometry": {"start": [0, 5, 1.5], "end": [1, 2, 3]}, "max_z": 9}
    found = docs(spark, whole({"levels": [LEVEL, LEVEL | {"id": 7, "elevation": None}], "geometries": [line, {"id": "h", "geometry": {"point": [1, 2]}}]}), whole({"levels": []}), whole({}))
    assert snapshots.problems(found).collect() == []
    levels = {r.id: r for r in snapshots.table(found, "levels").collect()}
    assert levels["l1"].elevation == 1.0 and levels["l1"].name == "é" and levels["7"].elevation is None
    g, h = sorted(snapshots.table(found, "geometries").collect(), key=lambda r: r.id)
    assert (g.min_x, g.max_x, g.min_y, g.max_y, g.min_z, g.max_z) == (0, 1, 2, 5, 1.5, 9) and g.geometry_json == '{"end":[1,2,3],"start":[0,5,1.5]}' and h.min_x is None


@pytest.mark.parametrize(
    ("text", "place", "problem"),
    [
        ("", "$", "not strict JSON"), ("{} {}", "$", "not strict JSON"), ("{},{}", "$", "not strict JSON"), ('{"a": NaN}', "$", "not strict JSON"), ('{"a": 1, "a": 1}', "$", "not strict JSON"),
        ('{"snapshot_version": 1, "records": {}}', "$.project", "missing"), (whole({}, snapshot_version=2), "$.snapshot_version", "unsupported"), (whole({"rooms": []}), "$.records.rooms", "unknown collection"),
        (whole({"levels": [LEVEL, LEVEL | {"height": 1}]}), "$.records.levels[1].height", "unknown field"), (whole({"levels": [LEVEL | {"elevation": "high"}]}), "$.records.levels[0].elevation", "another type"),
    ],
)
def test_breaches(spark, tmp_path, text, place, problem):
    assert (place, problem) in {(r.place, r.problem) for r in snapshots.problems(docs(spark, text)).collect()}
    (tmp_path / "s.json").write_text(text)
    with pytest.raises(StoreError):
        read_snapshot(spark, f"file://{tmp_path}/s.json")


def test_a_snapshot_is_a_store(spark, tmp_path):
    (tmp_path / "s.json").write_text(whole({"levels": [LEVEL]}))
    store = read_snapshot(spark, f"file://{tmp_path}/s.json")
    assert store.metadata["project_id"] == "p" and store.violations().collect() == [] and store.table("levels").first().name == "é"

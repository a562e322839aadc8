"""Plans: no nested loops over callers' tables, and groups cut before they are shuffled."""

import random

import pytest

from plinth.operators import semantic, topology
from plinth.plans.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["retrieval_metrics", "evidence_precision_recall", "semantic_discovery", "nearby", "spatial_box_join", "table_repair"])
def test_joins_have_keys(spark, name):
    found = plan(QUERIES[name](spark, SMALL))
    assert "NestedLoop" not in found and "Cartesian" not in found


def test_groups_are_cut_before_the_shuffle(spark):
    found = plan(QUERIES["pair_cap"](spark, SMALL))
    assert "WindowGroupLimit" in found and "Partial" in found


@pytest.mark.parametrize("first", [1000, 34, 0])
def test_pairs_equal_enumeration_whatever_is_kept(spark, first, monkeypatch):
    monkeypatch.setattr(topology, "_FIRST", first)
    rng = random.Random(first)
    items = {g: sorted(rng.sample(range(500), n)) for g, n in enumerate([0, 1, 2, 3, 9, 40, 120])}
    pairs = {g: [(a, b) for i, a in enumerate(x) for b in x[i + 1 :]] for g, x in items.items()}
    explicit = {g: set(rng.sample(p, min(len(p), 60))) | set(p[:50]) for g, p in pairs.items()}
    explicit[5] = {(items[5][0], items[5][1])}
    frame = spark.createDataFrame([(g, i) for g, x in items.items() for i in x], "g int, item int")
    known = spark.createDataFrame([(g, *p) for g, x in explicit.items() for p in x], "g int, a int, b int")
    found, report = topology.ordered_pairs(frame, known, "g", "item")
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.g, r.rank)):
        got.setdefault(r.g, []).append((r.a, r.b))
    assert got == {g: w for g, p in pairs.items() if (w := [x for x in p if x not in explicit[g]][:32])}


def test_discovery_equals_plain_containment(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("aAbé-") for _ in range(n))
    entities = spark.createDataFrame([(f"e{i}{word(2)}", "room", word(rng.randrange(6)), word(rng.randrange(4))) for i in range(80)], "id string, entity_class string, label string, number string")
    properties = spark.createDataFrame([(f"p{i}", r.id, "n", word(5)) for i, r in enumerate(entities.collect())], "id string, semantic_entity_id string, source_name string, source_value string")
    asked = ["a", "B", "ab", "aab", "é-", "abab", " ", "e1", "zz"]
    queries = spark.createDataFrame([(q, None) for q in asked], "query string, entity_class string")
    got = {(r.query, r.semantic_entity_id, r.source_value) for r in semantic.matches(entities, properties, queries).collect()}
    low = lambda x: "".join(c.lower() if c.isascii() else c for c in x)
    values = [(r.semantic_entity_id, r.source_value, r.match_source) for r in semantic.source_values(entities, properties).collect()]
    want = {(q, e, v) for q in asked if q.strip() for e, v, s in values if v is not None and (low(q) == low(v) or s != "entity_id" and low(q) in low(v))}
    assert got == want and len(want) > 50

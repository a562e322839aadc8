"""The stored positional index: phrases, NEAR, upkeep, and the store and façade that use it."""

import itertools
import random
import re

import pytest

from plinth.api import Knowledge
from plinth.operators import postings, search
from plinth.sources.store import Store, from_records

SHAPE = "record_kind string, record_id string, content string"


def content(spark, texts):
    return spark.createDataFrame([("k", str(i), t) for i, t in texts.items()], SHAPE)


def starts(words, term):
    ok = lambda w, x, last: w.startswith(x) if term.prefix and last else w == x
    n = len(term.words)
    return [p for p in range(len(words) - n + 1) if all(ok(words[p + i], term.words[i], i == n - 1) for i in range(n))]


def near(words, group):
    """Instances of each phrase that are in some choice of one instance each, close enough."""
    at = [starts(words, t) for t in group.terms]
    inside = [set() for _ in at]
    for choice in itertools.product(*at):
        order = sorted(range(len(choice)), key=lambda j: choice[j])
        firsts = [j for j in order if choice[j] == choice[order[0]]]
        if any(max(choice) <= choice[j] + len(group.terms[j].words) + group.distance for j in firsts):
            for j, p in enumerate(choice):
                inside[j].add(p)
    return [len(x) for x in inside]


@pytest.mark.parametrize("query", ["NEAR(a b)", "NEAR(a b c, 1)", 'NEAR("a b" c, 2)', "NEAR(a c*, 0)", 'NEAR("b c*" a b, 4)'])
def test_near_counts_equal_all_choices(spark, query):
    rng = random.Random(query)
    texts = {i: " ".join(rng.choice(["a", "b", "c", "cc", "x", "y", "z"]) for _ in range(rng.choice([0, 3, 8, 16]))) for i in range(150)}
    group = search.parse(query)
    rows = postings.positions(content(spark, texts)).filter(postings.wanted(group))
    got = {int(r["record_id"]): [r[f"near{j}"] for j in range(len(group.terms))] for r in postings.instances(rows, group).collect()}
    want = {i: f for i, t in texts.items() if all(f := near(t.split(), group))}
    assert got == want


def ids(df):
    return {(r["record_id"], round(r["rank"], 9)) for r in df.select("record_id", "rank").collect()}


def test_index_answers_as_the_texts_do_and_reads_no_texts(spark, tmp_path):
    rng = random.Random(7)
    df = content(spark, {i: " ".join(rng.choice(["red", "reed", "Blue", "été", "x1", "of"]) for _ in range(rng.randrange(12))) for i in range(120)})
    df.write.parquet(f"{tmp_path}/texts")
    df = spark.read.parquet(f"{tmp_path}/texts")
    index = postings.build(df, f"file://{tmp_path}/index", 3)
    for query in ("red blue", "re*", '"red blue" OR "ete x1"', "(red OR blue) NOT of", '"of re*" red', "NEAR(red blue, 1) OR x1", "nothing", "NEAR(red of) NOT blue"):
        found = postings.search(index, query)
        assert ids(found) == ids(search.ranked(df, query, None)), query
        assert f"{tmp_path}/texts" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.path for r in search.search_text(df, "zz* zz", 5, index).collect()} <= {"substring"}
    top = [(r.record_id, r.path) for r in search.search_text(df, "NEAR(red blue, 1)", 3, index).collect()]
    assert top == [(r.record_id, r.path) for r in search.search_text(df, "NEAR(red blue, 1)", 3).collect()] and {p for _, p in top} == {"ranked"}


def test_files_without_the_words_are_not_read(spark, tmp_path):
    df = content(spark, {i: " ".join(f"w{(i * 7 + j) % 400:03d}" for j in range(20)) for i in range(400)})
    index = postings.build(df, f"file://{tmp_path}/index", 8)
    found = postings.search(index, "w001")
    assert found.count() == 20
    rows = index.postings(postings.wanted(search.parse("w001")))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[.*EqualTo\(term,w001\)", plan)
    bounds = spark.read.parquet(f"{tmp_path}/index/{index.segments[0]}/postings").selectExpr("_metadata.file_name f", "term").groupBy("f").agg({"term": "min"}).collect()
    assert len(bounds) == 8 and len({r[1] for r in bounds}) > 6  # ranges of words, not all words everywhere


def test_updates_equal_a_fresh_index(spark, tmp_path):
    rng = random.Random(3)
    texts = {i: " ".join(rng.choice("abcdef") for _ in range(rng.randrange(9))) for i in range(60)}
    index = postings.build(content(spark, texts), f"file://{tmp_path}/index")
    before = index
    for _ in range(3):
        gone, changed, new = rng.sample(sorted(texts), 5), rng.sample(sorted(texts), 7), [max(texts) + 1 + i for i in range(4)]
        for i in gone:
            texts.pop(i, None)
        fresh = {i: " ".join(rng.choice("abcdefg") for _ in range(6)) for i in [*changed, *new]}
        texts |= fresh
        index = postings.update(index, content(spark, fresh), content(spark, dict.fromkeys([*gone, *changed, 10_000], "")))
    whole = content(spark, texts)
    again = postings.build(whole, f"file://{tmp_path}/again")
    for one in (index, postings.compact(index)):
        assert (one.n, one.total) == (again.n, again.total) == (len(texts), sum(len(t.split()) for t in texts.values()))
        assert postings.differences(one, whole).collect() == []
        for query in ("a b", '"a b"', "NEAR(a g, 2)"):
            assert ids(postings.search(one, query)) == ids(postings.search(again, query))
    assert len(index.segments) == 4 and before.segments == index.segments[:1] and not ids(postings.search(before, "g"))
    wrong = content(spark, {1: "zz"})
    assert {r.problem for r in postings.differences(index, wrong).collect()} == {"stale", "missing"}


def test_stores_keep_and_use_their_index(spark, tmp_path):
    rows = [{"record_kind": "space", "record_id": f"s{i}", "content": t} for i, t in enumerate(["red door", "blue door of red", "wall"])]
    path = f"file://{tmp_path}/store"
    from_records(spark, {"search_content": rows}).write(path, index=True)
    store = Store.open(spark, path)
    assert store.index.n == 3 and [r["record_id"] for r in Knowledge(store).search_text("NEAR(door red, 1)")] == ["s0", "s1"]
    store.tables["search_content"] = content(spark, {})  # hits come from the index: without content there is nothing to fetch
    assert Knowledge(store).search_text("door") == []
    from_records(spark, {"search_content": rows[:1]}).write(path)
    assert Store.open(spark, path).index is None


def test_blank_and_empty_content(spark, tmp_path):
    index = postings.build(content(spark, {}), f"file://{tmp_path}/none")
    assert postings.search(index, "a OR NEAR(b c)").collect() == [] and (index.n, index.total) == (0, 0)
    nulls = spark.createDataFrame([("k", "1", None), ("k", "2", "a")], SHAPE)
    assert [r.record_id for r in postings.search(postings.build(nulls, f"file://{tmp_path}/nulls"), "a").collect()] == ["2"]

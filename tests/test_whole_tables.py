"""Queries over small tables against brute force: every row takes part, whatever its id."""

from itertools import combinations

from plinth.operators import search
from plinth.plans import page_queries, text_queries
from plinth.plans.graph_queries import QUERIES


def store(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_pair_cap_takes_all_groups_and_items(spark, tmp_path):
    lines = [(g + 200 * (i % 3), p, 1 + i % 4, 1 + i % 5) for g, n in ((3, 14), (19, 2), (20, 9), (120, 5), (199, 1)) for i, p in enumerate(range(1, n + 1))]
    sf_dir = store(spark, tmp_path, lineitem=(lines + lines[:4], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int"))
    pairs, report = [], []
    for g in sorted({o % 200 for o, *_ in lines}):
        items = sorted({p * 100000 + s * 10 + n for o, p, s, n in lines if o % 200 == g})
        known = {(items[i], items[i + 1]) for i in (0, 2, 4) if i + 1 < len(items)}
        left = [x for x in combinations(items, 2) if x not in known]
        pairs += [(g, a, b, k) for k, (a, b) in enumerate(left[:32], 1)]
        report.append((g, len(left) + len(known), len(left[:32]), len(left) + len(known) - len(left[:32])))
    assert rows(QUERIES["pair_cap"](spark, sf_dir)) == sorted(pairs)
    assert rows(QUERIES["pair_cap_report"](spark, sf_dir)) == report


def test_fact_conflicts_reads_all_labels(spark, tmp_path):
    sf_dir = store(
        spark, tmp_path,
        documents=([(5, "a"), (6, "a"), (7, "b"), (10, "b"), (11, "c")], "doc_id bigint, source string"),
        labels=([(5, 1, 0), (6, 0, 0), (7, 1, 0), (10, 1, 0), (11, 0, 1)], "doc_id bigint, quality int, toxic int"),
    )
    assert rows(QUERIES["fact_conflicts"](spark, sf_dir)) == [("a", "conflict", None, 2), ("b", "ok", "000000007", 2), ("c", "ok", "000000011", 1)]


def test_relative_elevation_reads_all_events(spark, tmp_path):
    events = [(30, 1, "FFL", 2.0), (5, 1, "x", 2.0), (3, 2, "FFL", 1.0), (6, 2, "FFL", 4.0), (7, 3, "x", 1.0), (20, 4, "x", 3.0), (2, 4, "x", 3.0)]
    sf_dir = store(spark, tmp_path, events=(events, "event_id bigint, user_id bigint, event_type string, value double"))
    got = {r.entity_id: (r.status, r.reference) for r in QUERIES["relative_elevation"](spark, sf_dir).collect()}
    assert got == {"1": ("ambiguous", None), "2": ("conflict", "ffl"), "3": ("insufficient_data", None), "4": ("ok", "rfl")}


def test_box_join_pairs_ids_of_any_parity(spark, tmp_path):
    vectors = [(i, [x, 0.0, 0.0, x + 0.1, 0.01, 0.01], label) for i, x, label in ((2, 0.0, 7), (4, 0.05, 7), (5, 0.08, 7), (7, 0.1, 7), (8, 0.05, 1), (9, 0.4, 7), (11, 0.45, 7))]
    sf_dir = store(spark, tmp_path, embeddings=(vectors, "vec_id bigint, embedding array<float>, label int"))
    spans = {i: (v[0], v[3] if label >= 5 else v[0]) for i, v, label in vectors}
    want = [(i, j) for i, j in combinations(sorted(spans), 2) if spans[i][0] <= spans[j][1] and spans[i][1] >= spans[j][0]]
    assert rows(QUERIES["spatial_box_join"](spark, sf_dir)) == want and (2, 4) in want and (9, 11) in want


def test_same_space_counts_customers(spark, tmp_path):
    sf_dir = store(
        spark, tmp_path,
        nation=([(0, "n0", 0), (1, "n1", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        part=([(1, "p", "b", "t")], "p_partkey bigint, p_name string, p_brand string, p_type string"),
        customer=([(1, "c", 0, "m"), (2, "c", 0, "m"), (3, "c", 1, "m")], "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"),
        supplier=([(1, "s", 0), (6, "s", 0)], "s_suppkey bigint, s_name string, s_nationkey int"),
    )
    inside = {"space-0": ["customer-1", "customer-2", "supplier-1", "supplier-6"], "space-1": ["customer-3", "supplier-6"]}
    assert rows(QUERIES["same_space_elements"](spark, sf_dir)) == sorted((e, s, len(es)) for s, es in inside.items() for e in es)


def test_phrase_search_has_no_limit(spark, tmp_path):
    texts = ["All rights reserved", "a licensed copy", "nothing", "all rights, reserved; license", "licens"]
    sf_dir = store(spark, tmp_path, documents=(list(enumerate(texts)), "doc_id bigint, text string"))
    found = text_queries.QUERIES["text_search_phrase"](spark, sf_dir)
    assert rows(found) == [("0",), ("1",), ("3",), ("4",)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan and "Sort" not in plan
    content = spark.createDataFrame([("k", str(i), t) for i, t in enumerate(texts)], "record_kind string, record_id string, content string")
    assert rows(search.ranked(content, "licens*", None)) == rows(search.ranked(content, "licens*", 20))


def test_relevant_documents_hold_the_whole_item(spark, tmp_path):
    opening = "the very same opening of thirty characters and more "
    texts = [f"so {opening}ends", f"it is {opening}goes on to one end", f"here {opening}goes on to another end"]
    sf_dir = store(
        spark, tmp_path,
        documents=([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, n_chars bigint"),
        benchmark=([(1, f"{opening}goes on to one end"), (2, f"{opening}goes on to another end")], "item_id bigint, text string"),
    )
    found = {n: page_queries.QUERIES[n](spark, sf_dir).collect() for n in ("retrieval_metrics", "mean_reciprocal_rank", "evidence_precision_recall")}
    assert sorted((r.case_id, r.first) for r in found["retrieval_metrics"]) == [(1, 2), (2, 3)]
    assert [(r.mrr, r.ranked_case_count) for r in found["mean_reciprocal_rank"]] == [(0.416667, 2)]
    assert sorted((r.case_id, r.observed, r.expected, r.matched) for r in found["evidence_precision_recall"]) == [(1, 3, 1, 1), (2, 3, 1, 1)]

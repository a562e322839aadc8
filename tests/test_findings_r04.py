"""Findings of round 4: queries against their SQL where they went wrong or did too much."""

import datetime

from plinth import evaluation
from plinth.operators import payload
from plinth.plans.registry import QUERIES
from test_findings_r03 import same_as_sql


def test_unix_times_are_exact_where_doubles_have_gaps(spark, tmp_path):
    """Microseconds beyond 2**53 are the double's own value up to the last one there is, not its shortest digits."""
    rows = [(i, v) for i in (3125583, 3125617, 3134913, 5999999, 6000002, 60000001, 91000003, 92230952) for v in (0.0, 4.14, 8.01, 19.37, 55.73, 87.91, 99.99)]
    assert same_as_sql(spark, tmp_path, "unix_times", events=(rows, "event_id bigint, value double")) == 56


def test_field_states_read_a_case_and_its_answer_once(spark):
    """All fields are judged where a case meets its answer; odd cases and answers count as before."""
    region = '{"document_identity":"d","pdf_page":2,"bbox":[0,0,1,1.0],"coordinate_space":"s"}'
    place = '{"document":{"id":"i","identity":"d"},"source_kind":"k","source_id":"s","can_zoom":true,"pdf_page":%s,"bbox":%s,"coordinate_space":"s"}'
    shown = lambda page, box: '[{"x":[%s]}]' % (place % (page, box))
    wants = lambda text: '{"expected":{%s}}' % text
    cases = [
        ("a", wants('"evidence":[%s],"pdf_pages":[2]' % region)), ("b", wants('"evidence":[%s]' % region)), ("c", wants('"evidence":[%s]' % region)), ("c", wants('"semantic_entity_ids":["e",""]')), ("d", wants('"pdf_pages":[1],"pdf_pages":[2]')), ("e", None),
        ("f", wants('"source_references":[{"kind":"pdf_text_block","id":"q"}],"evidence_ids":["v"],"document_identities":["\\u00e4"],"sheet_ids":[null]')), ("g", wants('"pdf_pages":[2]')), (None, wants('"pdf_pages":[2]')),
    ]
    answers = [
        ("a", shown("2.0", "[0.0,0,1,1]")), ("b", shown("2", "[0,0,1,2]")), ("c", '{"entity_class":null,"id":""}'), ("c", '{"entity_class":"x","id":"e"}'), ("d", shown("2", "null")), ("e", "{}"), ("g", "{"), (None, shown("2", "null")), ("h", "{}"),
        ("f", '{"block_id":"q","evidence_refs":["v"],"o":{"source_filename":1,"identity":"ä"},"p":%s}' % place.replace('"can_zoom"', '"sheet_id":null,"can_zoom"') % ("1", "null")),
    ]
    want = evaluation.Expected(payload.Documents(spark.createDataFrame(cases, "case_id string, json string"), "case_id", "json"))
    found = payload.Documents(spark.createDataFrame(answers, "case_id string, payload string"), "case_id", "payload")
    states = evaluation.field_states(want, found)
    told = sorted((r.case_id or "", r.field, r.state) for r in states.collect() if r.state != "not_applicable")
    both = [("c", "bbox", "miss"), ("c", "document_identities", "miss"), ("c", "pdf_pages", "miss"), ("c", "semantic_entity_ids", "hit")]
    assert told == sorted(
        [("a", x, "hit") for x in ("bbox", "document_identities", "pdf_pages")] + [("b", "bbox", "miss"), ("b", "document_identities", "hit"), ("b", "pdf_pages", "hit")] + both * 2
        + [("f", x, "hit") for x in ("document_identities", "evidence_ids", "sheet_ids", "source_references")] + [("g", "pdf_pages", "miss")]
    )
    assert states.count() == 81 and evaluation.field_states(want, found, answered=True).count() == 72
    plan = evaluation.field_states(want, found)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan


def test_cell_context_shuffles_a_line_item_once(spark, tmp_path):
    """A cell's spans come with it; a line item given twice has the spans of both."""
    items = [(1, 1, 7, 3, "R", "F", 7.0), (1, 2, 7, 3, "N", "O", 5.0), (1, 2, 7, 3, "R", "O", 49.0), (2, 1, 8, 4, "A", "O", 3.0), (3, 1, 8, 4, "A", "F", 5.0), (2, 2, 8, 4, "R", "F", 5.0)]
    same = {
        "lineitem": (items, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string, l_quantity double"),
        "orders": ([(k, k, "F", 9.0, "5-LOW", datetime.date(1995, 1, 2)) for k in (1, 2)], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string, o_orderdate date"),
        "customer": ([(k, f"c{k}", "x", 1.0) for k in (1, 2)], "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double"),
        "supplier": ([(3, "s", 1, 1.0)], "s_suppkey bigint, s_name string, s_nationkey bigint, s_acctbal double"),
    }
    assert same_as_sql(spark, tmp_path, "cell_context", **same) == 5
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["cell_context"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan parquet") == 4 and plan.count("Exchange hashpartitioning") == 6


def test_review_jobs_shuffle_a_candidate_once(spark, tmp_path):
    """Parts with one, few and many candidates, referring or not, with rows to unite."""
    items = [(o, 1 + o % 3, p, 3 + o % 2, "RNA"[o % 4 % 3], "OF"[o % 5 // 4], float(4 + o % 7)) for p, n in ((1, 1), (2, 1), (3, 3), (4, 30), (5, 70), (6, 70), (7, 9)) for o in range(100 * p, 100 * p + n)]
    tables = {
        "lineitem": (items, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string, l_quantity double"),
        "part": ([(k, 26 if k % 2 == 0 else 25) for k in range(1, 9)], "p_partkey bigint, p_size int"),
        "orders": ([(1, 1, "F", 9.0, "5-LOW", datetime.date(1995, 1, 2))], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string, o_orderdate date"),
        "customer": ([(1, "c", "x", 1.0)], "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double"),
        "supplier": ([(3, "s", 1, 1.0)], "s_suppkey bigint, s_name string, s_nationkey bigint, s_acctbal double"),
    }
    assert same_as_sql(spark, tmp_path, "review_jobs", **tables) == 377
    plan = QUERIES["review_jobs"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2

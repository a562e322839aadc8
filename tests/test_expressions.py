"""Column expressions against known values."""

import math

import pytest
from pyspark.sql import functions as F

from plinth.functions import geometry as g
from plinth.functions import text as t
from plinth.operators import spatial


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def at(x, y, z):
    return g.point(F.lit(float(x)), F.lit(float(y)), F.lit(float(z)))


def test_case_folds_ascii_only(spark):
    assert one(spark, t.ascii_lower(F.lit("ABC É ß"))) == "abc É ß"
    assert one(spark, t.contains_nocase(F.lit("Door D-105"), F.lit("d-10"))) and one(spark, t.contains_nocase(F.lit("x"), F.lit("")))
    assert not one(spark, t.same_nocase(F.lit("É"), F.lit("é")))


def test_blank_and_filled(spark):
    assert one(spark, t.is_blank(F.lit("　 \t"))) and not one(spark, t.is_blank(F.lit("　x")))
    assert one(spark, t.first_filled(F.lit(""), F.lit("b"))) == "b" and one(spark, t.first_filled(F.lit("a"), F.lit("b"))) == "a"


@pytest.mark.parametrize(("text", "want"), [("SSL + 740 mm", "SSL"), ("  FFL -  3", "FFL"), ("Level", "Level"), ("L2", None), ("", None), ("Top of Slab+12", "Top of Slab"), ("x" * 40, None)])
def test_datum(spark, text, want):
    assert one(spark, t.datum(F.lit(text))) == want


def test_tokens_drop_accents_and_keep_unspaced_scripts(spark):
    assert one(spark, t.tokens(F.lit("Café-Noir ÉTÉ 機械室 12"))) == ["cafe", "noir", "ete", "機械室", "12"]


@pytest.mark.parametrize(("spec", "last", "want"), [("1,3-5", 9, [1, 3, 4, 5]), ("5, 1-2,2", 5, [1, 2, 5]), ("3-1", 9, None), ("0", 9, None), ("10", 9, None), ("a", 9, None), ("", 9, None)])
def test_page_ranges(spark, spec, last, want):
    assert one(spark, t.page_range(F.lit(spec), F.lit(last))) == want


def test_paths_hashes_stamps(spark):
    assert one(spark, t.is_logical_path(F.lit("pdf/a b.PDF"), "pdf/"))
    assert not any(one(spark, t.is_logical_path(F.lit(p), "pdf/")) for p in ("pdf/../a.pdf", "/pdf/a.pdf", "pdf//a.pdf", "pdf\\a.pdf", "pdf/a.txt", "x/a.pdf"))
    assert one(spark, t.is_sha256(F.sha2(F.lit("x"), 256))) and not one(spark, t.is_sha256(F.lit("A" * 64)))
    assert one(spark, t.is_timestamp(F.lit("2024-02-29T10:00:00+09:00"))) and not one(spark, t.is_timestamp(F.lit("2023-02-29T10:00:00Z"))) and not one(spark, t.is_timestamp(F.lit("2024-02-29 10:00")))
    assert one(spark, t.slug(F.lit("--Plan A/1.pdf"), F.lit("9"))) == "Plan-A-1.pdf-9" and one(spark, t.slug(F.lit("***"), F.lit("9"))) == "document-9"


def test_text_status(spark):
    assert [one(spark, t.text_status(F.lit(x))) for x in ("", " \n", "short", "x" * 40)] == ["no_text", "no_text", "minimal_text", "extracted"]


def test_units(spark):
    assert one(spark, t.in_engine_units(F.lit("length"), F.lit(2.0))).asDict() == {"value": 609.6, "unit": "mm"}
    assert one(spark, t.in_engine_units(F.lit("text"), F.lit(2.0))).unit is None


def test_point_segment_distance(spark):
    assert one(spark, g.point_segment_distance(at(15, 4, 0), at(0, 0, 0), at(10, 0, 0))) == pytest.approx(math.sqrt(41))
    assert one(spark, g.point_segment_distance(at(3, 4, 0), at(0, 0, 0), at(0, 0, 0))) == 5


LINES = [
    (((0, 0, 0), (10, 0, 0)), ((5, -5, 2), (5, 5, 2)), 2), (((0, 0, 0), (10, 0, 0)), ((0, 3, 4), (10, 3, 4)), 5), (((0, 0, 0), (1, 0, 0)), ((3, 0, 0), (5, 0, 0)), 2),
    (((0, 0, 0), (0, 0, 0)), ((1, 1, 0), (1, 1, 0)), math.sqrt(2)), (((0, 0, 0), (4, 0, 0)), ((2, 0, 0), (9, 0, 0)), 0), (((0, 0, 0), (1, 0, 0)), ((2, 1, 0), (3, 5, 0)), math.sqrt(2)),
]


@pytest.mark.parametrize(("a", "b", "want"), LINES)
def test_segment_distances(spark, a, b, want):
    line = lambda p: F.struct(F.lit("line").alias("kind"), at(*p[0]).alias("s"), at(*p[1]).alias("e"))
    row = spatial.distances(spark.range(1).select(line(a).alias("a"), line(b).alias("b"))).first()
    assert row.distance == pytest.approx(want) and row.basis == "line_to_line"


def test_longitudinal_overlap(spark):
    along = lambda a, b: one(spark, g.longitudinal_overlap(at(0, 0, 0), at(10, 0, 0), at(*a), at(*b)))
    assert along((8, 2, 0), (3, 2, 0)) == 5 and along((10, 0, 0), (20, 0, 0)) is None and along((5, 0, 0), (5, 9, 0)) is None and along((1, 0, 0), (1, 0, 0)) is None


def test_decoding(spark):
    decode = lambda kind, json: one(spark, g.decode_primitive(F.lit(kind), F.lit(json)))
    assert decode("point", '{"coordinates":[1,2,3]}').s.z == 3 and decode("line", '{"start":[0,0,0],"end":[1,0,0]}').e.x == 1
    assert decode("point", '{"point":[1,2]}') is None and decode("line", '{"start":[0,0,0]}') is None and decode("footprint", '{"point":[1,2,3]}') is None


def test_page_geometry(spark):
    box = tuple(F.lit(float(v)) for v in (100, 300, 200, 350))
    context = one(spark, g.context_box(box, F.lit(612.0), F.lit(792.0)))
    assert context.bbox == [0, 156, 344, 494] and context.clamped == ["left"]
    assert one(spark, g.context_box(tuple(F.lit(float(v)) for v in (0, 0, 10, 10)), F.lit(10.0), F.lit(10.0))) is None
    frame = tuple(F.lit(float(v)) for v in (0, 0, 400, 400))
    assert one(spark, g.focus_box(box, frame, F.lit(90))) == pytest.approx([0.125, 0.25, 0.25, 0.5])
    assert one(spark, g.rect_intersects(box, tuple(F.lit(float(v)) for v in (199.8, 300, 250, 350)))) is False
    assert one(spark, g.same_rect(box, tuple(F.lit(v) for v in (100.2, 300.0, 200.0, 350.0))))
    assert one(spark, g.vertical_relation(F.lit(2.0), F.lit(3.0), F.lit(0.0), F.lit(2.0))).relation == "indeterminate"

"""Exact geometry in column expressions; points are structs (x, y, z), segments are two points.

All lengths are millimetres, all coordinates doubles. Nothing here leaves code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARALLEL, SHORTEST, TABLE_SLACK = 1e-12, 1e-6, 0.25
POINT = "struct<x:double,y:double,z:double>"


def point(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), z.cast("double").alias("z"))


def minus(a: Column, b: Column) -> Column:
    return F.struct(*[(a[c] - b[c]).alias(c) for c in "xyz"])


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def along(a: Column, d: Column, t: Column) -> Column:
    return F.struct(*[(a[c] + d[c] * t).alias(c) for c in "xyz"])


def clamp(t: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))


def point_distance(a: Column, b: Column) -> Column:
    d = minus(a, b)
    return F.sqrt(dot(d, d))


def point_segment_distance(p: Column, a: Column, b: Column) -> Column:
    """Distance to the closest point of the segment; a segment of no length is a point."""
    d = minus(b, a)
    size = dot(d, d)
    t = F.when(size > 0, clamp(dot(minus(p, a), d) / F.nullif(size, F.lit(0.0)))).otherwise(0.0)
    return point_distance(p, along(a, d, t))


def decode_primitive(kind: Column, json: Column) -> Column:
    """``struct(kind, s, e)`` of a point (``point`` or ``coordinates``) or line (``start``, ``end``); null otherwise.

    Coordinates are exactly three finite numbers.
    """
    parsed = F.from_json(json, "struct<point:array<double>,coordinates:array<double>,start:array<double>,end:array<double>>")

    def at(x: Column) -> Column:
        good = (F.size(x) == 3) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        return F.when(F.coalesce(good, F.lit(False)), point(F.get(x, F.lit(0)), F.get(x, F.lit(1)), F.get(x, F.lit(2))))

    one, start, end = at(F.coalesce(parsed["point"], parsed["coordinates"])), at(parsed["start"]), at(parsed["end"])
    return F.when((kind == "point") & one.isNotNull(), F.struct(kind.alias("kind"), one.alias("s"), one.alias("e"))).when(
        (kind == "line") & start.isNotNull() & end.isNotNull(), F.struct(kind.alias("kind"), start.alias("s"), end.alias("e"))
    )


def bounds(s: Column, e: Column) -> Column:
    return F.struct(*[f(s[c], e[c]).alias(f"{n}_{c}") for c in "xyz" for n, f in (("min", F.least), ("max", F.greatest))])


def longitudinal_overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Length that parallel segments share along the first one; null if they are not parallel, too short or apart."""
    u, v = minus(b, a), minus(d, c)
    lu, lv = F.sqrt(dot(u, u)), F.sqrt(dot(v, v))
    fit = (lu > SHORTEST) & (lv > SHORTEST)
    parallel = 1 - F.abs(dot(u, v)) / F.when(fit, lu * lv) <= PARALLEL
    p, q = dot(minus(c, a), u) / F.when(fit, lu), dot(minus(d, a), u) / F.when(fit, lu)
    shared = F.least(lu, F.greatest(p, q)) - F.greatest(F.lit(0.0), F.least(p, q))
    return F.when(fit & parallel & (shared > SHORTEST), shared)


def boxes_touch(a: str, b: str) -> Column:
    """Inclusive overlap of two boxes given as columns ``<prefix>min_x`` .. ``<prefix>max_z``."""
    parts = [(F.col(f"{a}min_{c}") <= F.col(f"{b}max_{c}")) & (F.col(f"{a}max_{c}") >= F.col(f"{b}min_{c}")) for c in "xyz"]
    return parts[0] & parts[1] & parts[2]


def vertical_relation(a_low: Column, a_high: Column, b_low: Column, b_high: Column) -> Column:
    """``struct(relation, separation)``: strictly above or below, else indeterminate (touching too)."""
    return (
        F.when(a_low > b_high, F.struct(F.lit("above").alias("relation"), (a_low - b_high).alias("separation")))
        .when(a_high < b_low, F.struct(F.lit("below").alias("relation"), (b_low - a_high).alias("separation")))
        .otherwise(F.struct(F.lit("indeterminate").alias("relation"), F.lit(None).cast("double").alias("separation")))
    )


def rect_contains(outer: tuple, inner: tuple, slack: float = TABLE_SLACK) -> Column:
    return (inner[0] >= outer[0] - slack) & (inner[1] >= outer[1] - slack) & (inner[2] <= outer[2] + slack) & (inner[3] <= outer[3] + slack)


def rect_intersects(a: tuple, b: tuple, slack: float = TABLE_SLACK) -> Column:
    """Overlap of more than ``slack`` on both axes."""
    return (F.least(a[2], b[2]) - F.greatest(a[0], b[0]) > slack) & (F.least(a[3], b[3]) - F.greatest(a[1], b[1]) > slack)


def same_rect(a: tuple, b: tuple, slack: float = TABLE_SLACK) -> Column:
    parts = [F.abs(x - y) <= slack for x, y in zip(a, b, strict=True)]
    return parts[0] & parts[1] & parts[2] & parts[3]


def context_box(box: tuple, width: Column, height: Column, margin: float = 144.0) -> Column:
    """The box widened by a margin and clamped to the page, with the clamped edges; null if nothing was added."""
    grown = (F.greatest(box[0] - margin, F.lit(0.0)), F.greatest(box[1] - margin, F.lit(0.0)), F.least(box[2] + margin, width), F.least(box[3] + margin, height))
    edges = [F.when(box[0] - margin < 0, "left"), F.when(box[1] - margin < 0, "top"), F.when(box[2] + margin > width, "right"), F.when(box[3] + margin > height, "bottom")]
    added = (grown[0] < box[0]) | (grown[1] < box[1]) | (grown[2] > box[2]) | (grown[3] > box[3])
    return F.when(added, F.struct(F.array(*grown).alias("bbox"), F.array_compact(F.array(*edges)).alias("clamped")))


def focus_box(box: tuple, frame: tuple, rotation: Column) -> Column:
    """A box in unit coordinates of its frame as seen after turning the page by 0, 90, 180 or 270 degrees."""
    w, h = frame[2] - frame[0], frame[3] - frame[1]
    x0, y0, x1, y1 = (box[0] - frame[0]) / w, (box[1] - frame[1]) / h, (box[2] - frame[0]) / w, (box[3] - frame[1]) / h
    return (
        F.when(rotation == 90, F.array(1 - y1, x0, 1 - y0, x1)).when(rotation == 180, F.array(1 - x1, 1 - y1, 1 - x0, 1 - y0))
        .when(rotation == 270, F.array(y0, 1 - x1, y1, 1 - x0)).otherwise(F.array(x0, y0, x1, y1))
    )

"""Exact 3-D spatial joins by grid cells: no nested loops, no cartesian products."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions.geometry import boxes_touch, clamp, decode_primitive, vertical_relation
from plinth.session import staged

BOX = [f"{m}_{c}" for c in "xyz" for m in ("min", "max")]


def _extent() -> Column:
    return F.greatest(*[F.col(f"max_{c}") - F.col(f"min_{c}") for c in "xyz"])


def _level(cell: float) -> Column:
    """The first level of the grid whose cells are as large as the box; cells double from level to level."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(_extent(), F.lit(cell)) / cell))).cast("int")


def _cells(cell: float) -> Column:
    """Places ``(level, cx, cy, cz)`` of a box on every level of ``levels``: at most two an axis from its own level on."""
    size = lambda at: F.lit(cell) * F.pow(F.lit(2.0), at)
    axis = lambda c, at: F.sequence(F.floor(F.col(f"min_{c}") / size(at)), F.floor(F.col(f"max_{c}") / size(at)))
    on = lambda at: F.flatten(F.transform(axis("x", at), lambda x: F.flatten(F.transform(axis("y", at), lambda y: F.transform(axis("z", at), lambda z: F.struct(at.alias("level"), x.alias("cx"), y.alias("cy"), z.alias("cz")))))))
    return F.flatten(F.transform("levels", on))


def usual_extent(rows: DataFrame) -> float:
    """The mean extent of the boxes, one if all are points."""
    return rows.agg(F.avg(_extent())).first()[0] or 1.0


def box_join(left: DataFrame, right: DataFrame, cell: float, same: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of rows whose boxes overlap (inclusive) and whose ``same`` columns are equal, null included, each pair once;
    columns prefixed ``l_`` and ``r_``.

    Boxes live in a grid of levels, each on the first level whose cells are as large as itself. A pair meets on the coarser
    level of the two, in one of two equi joins: boxes of the left on their own level with boxes of the right as fine or
    finer, or boxes of the right on their own level with finer ones of the left. A side is listed only on levels that the other
    one lives on, at most eight cells each, so a box of any size costs what it touches. A pair counts only in the first cell both
    share, so nothing has to be deduplicated. Choose ``cell`` near the usual extent of a box.
    """
    pairs = _meetings(left, right, cell, same).filter(boxes_touch("l_", "r_"))
    for axis in "xyz":
        pairs = pairs.filter(F.col(f"c{axis}") == F.floor(F.greatest(f"l_min_{axis}", f"r_min_{axis}") / (F.lit(cell) * F.pow(F.lit(2.0), F.col("level")))))
    return pairs.drop(*_PLACE, *[f"same{i}" for i in range(len(same))])


_PLACE = ["level", "cx", "cy", "cz"]


def _meetings(left: DataFrame, right: DataFrame, cell: float, same: tuple[str, ...]) -> DataFrame:
    """Pairs that share a cell of the level they are compared on, once for each such cell."""
    lives = lambda rows: sorted(r["k"] for r in rows.select(_level(cell).alias("k")).filter("k is not null").distinct().collect())  # noqa: E731  tens at most

    def listed(rows: DataFrame, p: str, levels: Column) -> DataFrame:
        rows = rows.withColumn("own", _level(cell)).withColumn("levels", levels)
        kept = [c for c in rows.columns if c not in ("own", "levels")]
        # structs are equal if both hold null
        alike = [F.struct(F.col(c).alias("v")).alias(f"same{i}") for i, c in enumerate(same)]
        return rows.select(F.explode(_cells(cell)).alias("at"), *alike, *[F.col(c).alias(f"{p}_{c}") for c in kept]).select("at.*", "*").drop("at")

    def on(levels: list[int], finer: bool) -> Column:
        of = F.array(*map(F.lit, levels)).cast("array<int>")
        return F.filter(of, lambda k: k > F.col("own")) if finer else F.filter(of, lambda k: k >= F.col("own"))

    own = F.when(F.col("own").isNotNull(), F.array("own"))
    keys = [*_PLACE, *[f"same{i}" for i in range(len(same))]]
    at_left, at_right = lives(left), lives(right)
    pairs = listed(left, "l", own).join(listed(right, "r", on(at_left, False)), keys)
    if any(k > min(at_left, default=0) for k in at_right):
        pairs = pairs.unionByName(listed(left, "l", on(at_right, True)).join(listed(right, "r", own), keys))
    return pairs


def candidates(geometries: DataFrame, bounds: tuple[float, float, float, float, float, float]) -> DataFrame:
    """Rows whose box overlaps ``(min_x, max_x, min_y, max_y, min_z, max_z)``; the filter reaches the scan."""
    if len(bounds) != 6 or any(v != v or v in (float("inf"), float("-inf")) for v in bounds) or any(bounds[i] > bounds[i + 1] for i in (0, 2, 4)):
        raise ValueError("bounds must be six finite numbers, each minimum at most its maximum")
    out = geometries
    for i, c in enumerate("xyz"):
        out = out.filter((F.col(f"min_{c}") <= bounds[2 * i + 1]) & (F.col(f"max_{c}") >= bounds[2 * i]))
    return out


def resolved_locations(geometries: DataFrame) -> DataFrame:
    """One row per occurrence ``(entity_kind, entity_id, link_instance_id)`` with its location primitive and status.

    ``ambiguous_geometry`` with several usable primitives, ``insufficient_data`` with none.
    """
    rows = geometries.withColumn("primitive", decode_primitive(F.col("geometry_type"), F.col("geometry_json")))
    usable = F.when(F.col("primitive").isNotNull(), F.struct("id", "primitive", "coordinate_system", "unit"))
    found = rows.groupBy("entity_kind", "entity_id", "link_instance_id").agg(F.count("primitive").alias("n"), F.min_by(usable, F.when(F.col("primitive").isNotNull(), F.col("id"))).alias("one"))
    status = F.when(F.col("n") > 1, "ambiguous_geometry").when(F.col("n") == 0, "insufficient_data").otherwise("ok")
    return found.select("entity_kind", "entity_id", "link_instance_id", status.alias("status"), *[F.when(F.col("n") == 1, F.col(f"one.{c}")).alias(a) for c, a in (("id", "geometry_id"), ("primitive", "primitive"), ("coordinate_system", "coordinate_system"), ("unit", "unit"))])


def occurrence_status(locations: DataFrame) -> DataFrame:
    """Per entity, without a chosen occurrence: ``ambiguous_occurrence`` where it is placed more than once, else the
    status of the one occurrence."""
    found = locations.groupBy("entity_kind", "entity_id").agg(F.count("*").alias("n"), F.first("status").alias("status"), F.array_sort(F.collect_list("link_instance_id")).alias("links"))
    return found.select("entity_kind", "entity_id", F.when(F.col("n") > 1, "ambiguous_occurrence").otherwise(F.col("status")).alias("status"), "n", "links")


def distances(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Adds the exact ``distance`` and ``basis`` for columns of primitives (points are segments without length).

    The closest points of two segments are inner points of both, or one is an end: four ends against the other segment,
    and where the lines are not parallel and both inner parameters are inside, those. Steps are columns of their own, so
    that no expression is repeated in the generated code.
    """
    kept = pairs.columns
    p, q = F.col(a), F.col(b)
    end = lambda x, c: F.when(x["kind"] == "point", x["s"][c]).otherwise(x["e"][c])
    out = pairs.withColumns({f"_u{c}": end(p, c) - p["s"][c] for c in "xyz"} | {f"_v{c}": end(q, c) - q["s"][c] for c in "xyz"} | {f"_w{c}": p["s"][c] - q["s"][c] for c in "xyz"})
    distance = F.sqrt(F.least("_d0", "_d1", "_d2", "_d3", F.coalesce(_inner(), F.lit(float("inf")))))
    return _closest(out).select(*kept, distance.alias("distance"), F.concat(F.col(f"{a}.kind"), F.lit("_to_"), F.col(f"{b}.kind")).alias("basis"))


def _places() -> list[tuple[Column, Column]]:
    return [(F.lit(0.0), F.col("_t1")), (F.lit(1.0), F.col("_t2")), (F.col("_s3"), F.lit(0.0)), (F.col("_s4"), F.lit(1.0)), (F.col("_s5"), F.col("_t5"))]


def _inner() -> Column:
    return F.when(F.col("_s5").between(0.0, 1.0) & F.col("_t5").between(0.0, 1.0), F.col("_d4"))


def _closest(pairs: DataFrame) -> DataFrame:
    """Adds ``_d0`` .. ``_d4``, the squared distances at five pairs of places, for ``_u``, ``_v`` along the segments and ``_w`` between their starts."""
    dot = lambda m, n: F.col(f"_{m}x") * F.col(f"_{n}x") + F.col(f"_{m}y") * F.col(f"_{n}y") + F.col(f"_{m}z") * F.col(f"_{n}z")
    out = pairs.withColumns({f"_{m}{n}": dot(m, n) for m, n in ("uu", "uv", "vv", "uw", "vw")})
    uu, uv, vv, uw, vw = (F.col(f"_{x}") for x in ("uu", "uv", "vv", "uw", "vw"))
    out = out.withColumn("_den", uu * vv - uv * uv)
    out = out.withColumn("_safe", F.when(F.col("_den") > F.lit(1e-15) * uu * vv, F.col("_den")))
    ratio = lambda x, size: F.when(size > 0, clamp(x / F.nullif(size, F.lit(0.0)))).otherwise(0.0)
    out = out.withColumns({"_t1": ratio(vw, vv), "_t2": ratio(vw + uv, vv), "_s3": ratio(-uw, uu), "_s4": ratio(uv - uw, uu), "_s5": (uv * vw - vv * uw) / F.col("_safe"), "_t5": (uu * vw - uv * uw) / F.col("_safe")})

    def squared(s: Column, t: Column) -> Column:
        x, y, z = (F.col(f"_w{c}") + s * F.col(f"_u{c}") - t * F.col(f"_v{c}") for c in "xyz")
        return x * x + y * y + z * z

    return out.withColumns({f"_d{i}": squared(s, t) for i, (s, t) in enumerate(_places())})


#: What locations must share to be compared, and why they are not (fixed name).
FRAME = ("coordinate_system", "unit")
OTHER_FRAME = "incompatible_coordinate_system_or_unit"


def _near(locations: DataFrame, radius: float, keys: list[str], cell: float | None, same: tuple[str, ...]) -> DataFrame:
    if not 0 <= radius < float("inf"):
        raise ValueError("radius must be finite and not negative")
    wide = locations
    for c in "xyz":
        wide = wide.withColumn(f"min_{c}", F.col(f"min_{c}") - radius).withColumn(f"max_{c}", F.col(f"max_{c}") + radius)
    pairs = box_join(wide, locations, cell or 2 * radius or usual_extent(locations), same)
    itself = reduce(lambda a, k: a & F.col(f"l_{k}").eqNullSafe(F.col(f"r_{k}")), keys, F.lit(True))
    return pairs.filter(~itself)


#: Cells are as wide as the radius or an eighth of the usual extent; lines are listed by stretches of so many pieces.
_PARTS, _STRETCH = 8, 1024


def _listed(locations: DataFrame, p: str, keys: list[str], same: tuple[str, ...], size: float, reach: float) -> DataFrame:
    """Each location once in every cell that comes within ``reach`` of it on all axes; ``place`` is a hash of the cell and ``same``.

    A line is taken in pieces of a quarter of a cell. Very long ones are listed stretch by stretch, so that no array is long.
    """
    at = F.col("primitive")
    line = {f"s{c}": at["s"][c] for c in "xyz"} | {f"u{c}": F.when(at["kind"] == "point", 0.0).otherwise(at["e"][c] - at["s"][c]) for c in "xyz"}
    finite = reduce(lambda a, b: a & b, [F.abs(c) < float("inf") for c in line.values()])
    rows = locations.filter(finite).select(*keys, *same, at["kind"].alias("kind"), *[F.coalesce(c, F.lit(0.0)).alias(n) for n, c in line.items()])
    rows = rows.withColumn("pieces", F.coalesce(F.greatest(F.lit(1), F.ceil(F.greatest(*[F.abs(f"u{c}") for c in "xyz"]) * 4 / size)).cast("long"), F.lit(1)))
    rows = rows.withColumn("stretch", F.explode(F.expr(f"sequence(0L, (pieces - 1) div {_STRETCH})")))

    def cells(i: Column) -> Column:
        def axis(c: str) -> Column:
            ends = [F.col(f"s{c}") + F.col(f"u{c}") * (i + k) / F.col("pieces") for k in (0, 1)]
            slack = F.lit(reach + size * 1e-6) + F.abs(ends[0]) * 1e-12
            return F.sequence(F.floor((F.least(*ends) - slack) / size), F.floor((F.greatest(*ends) + slack) / size))

        return F.flatten(F.transform(axis("x"), lambda x: F.flatten(F.transform(axis("y"), lambda y: F.transform(axis("z"), lambda z: F.xxhash64(x, y, z, *same))))))

    of = F.sequence(F.col("stretch") * _STRETCH, F.least(F.col("pieces"), (F.col("stretch") + 1) * _STRETCH) - 1)
    placed = rows.select(F.explode(F.array_distinct(F.flatten(F.transform(of, cells)))).alias("place"), "*")
    return placed.select("place", *[F.col(c).alias(f"{p}_{c}") for c in rows.columns])


def nearby(locations: DataFrame, radius: float, keys: list[str], cell: float | None = None) -> DataFrame:
    """Ordered pairs of different locations within ``radius`` (inclusive), with exact distances.

    ``locations`` holds ``keys``, ``primitive`` and its box. Where there are columns ``coordinate_system`` and ``unit``, only
    locations that agree in both are compared. Locations meet in the cells of a grid that one passes and the other comes within
    the radius of; the exact distance decides, and a pair counts only in the cell of the closest point, so nothing has to
    be deduplicated. Each pair is measured once and given in both orders.
    """
    return _both_orders(_measured(locations, locations, radius, keys, cell), keys)


def _both_orders(found: DataFrame, keys: list[str]) -> DataFrame:
    turned = [F.col(f"{b}_{k}").alias(f"{a}_{k}") for a, b in ("lr", "rl") for k in keys]
    basis = F.concat("r_kind", F.lit("_to_"), "l_kind").alias("basis"), F.concat("l_kind", F.lit("_to_"), "r_kind").alias("basis")
    ways = F.array(F.struct(*[F.col(f"{a}_{k}") for a in "lr" for k in keys], basis[1]), F.struct(*turned, basis[0]))
    out = found.select("distance", F.explode(ways).alias("way"))
    return out.select(*[f"way.l_{k}" for k in keys], *[f"way.r_{k}" for k in keys], "distance", "way.basis")


def _measured(subjects: DataFrame, others: DataFrame, radius: float, keys: list[str], cell: float | None, ordered: bool = False) -> DataFrame:
    """Pairs within the radius with keys and kinds of both, once: the smaller keys left, or with ``ordered`` the subject left."""
    if not 0 <= radius < float("inf"):
        raise ValueError("radius must be finite and not negative")
    same = FRAME if set(FRAME) <= set(others.columns) else ()
    size = cell or max(radius, usual_extent(others) / _PARTS)
    pairs = _listed(subjects, "l", keys, same, size, radius).join(_listed(others, "r", keys, same, size, 0.0), "place")
    left, right = (F.struct(*[F.col(f"{p}_{k}") for k in keys]) for p in "lr")
    pairs = pairs.filter(~left.eqNullSafe(right) if ordered else left < right)
    for c in same:
        pairs = pairs.filter(F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")))
    pairs = pairs.withColumns({f"_u{c}": F.col(f"l_u{c}") for c in "xyz"} | {f"_v{c}": F.col(f"r_u{c}") for c in "xyz"} | {f"_w{c}": F.col(f"l_s{c}") - F.col(f"r_s{c}") for c in "xyz"})
    out = _closest(pairs).withColumn("_best", F.least("_d0", "_d1", "_d2", "_d3", F.coalesce(_inner(), F.lit(float("inf")))))
    pick = lambda i: reduce(lambda rest, k: F.when(F.col(f"_d{k}") == F.col("_best"), _places()[k][i]).otherwise(rest), (3, 2, 1, 0), _places()[4][i])
    out = out.withColumns({"_s": pick(0), "_t": pick(1)})
    stretch = lambda t, p: F.floor(F.least(t * F.col(f"{p}_pieces"), F.col(f"{p}_pieces") - 0.5) / _STRETCH)
    here = F.xxhash64(*[F.floor((F.col(f"r_s{c}") + F.col("_t") * F.col(f"_v{c}")) / size) for c in "xyz"], *[F.col(f"l_{c}") for c in same])
    counts = (F.sqrt("_best") <= radius) & (F.col("place") == here) & (F.col("l_stretch") == stretch(F.col("_s"), "l")) & (F.col("r_stretch") == stretch(F.col("_t"), "r"))
    # a filter would be pushed below the steps of the distance and repeat them; a generator is not
    found = out.withColumn("distance", F.explode(F.when(counts, F.array(F.sqrt("_best")))))
    return found.select(*[f"{p}_{k}" for p in "lr" for k in keys], "l_kind", "r_kind", "distance")


def coverage(locations: DataFrame, unusable: DataFrame, radius: float, keys: list[str], cell: float | None = None) -> DataFrame:
    """Per subject: indexed occurrences (boxes in reach), exact results, and what was skipped for which reason.

    ``unusable(keys, status, box)`` are occurrences in reach that have no single location. ``(l_keys, indexed, exact,
    skipped)``; ``skipped`` is a sorted array of structs (reason, keys).
    """
    cols = [*keys, *BOX]
    both = locations.select(*cols, *FRAME, "primitive", F.lit("ok").alias("status")).unionByName(unusable.select(*cols, "status"), allowMissingColumns=True)
    pairs = _near(both, radius, keys, cell, ()).filter("l_status = 'ok'")
    frame = reduce(lambda a, c: a & F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")), FRAME, F.lit(True))
    reason = F.when(F.col("r_status") != "ok", F.col("r_status")).when(~frame, OTHER_FRAME)
    out = distances(pairs.withColumn("reason", reason), "l_primitive", "r_primitive")
    near = F.col("reason").isNull() & (F.col("distance") <= radius)
    left = F.struct(F.col("reason").alias("reason"), *[F.col(f"r_{k}").alias(k) for k in keys])
    return out.groupBy(*[f"l_{k}" for k in keys]).agg(F.count("*").alias("indexed"), F.count_if(near).alias("exact"), F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), left))).alias("skipped"))


def coverage_counts(locations: DataFrame, unusable: DataFrame, radius: float, keys: list[str], reasons: dict[str, str], cell: float | None = None) -> DataFrame:
    """:func:`coverage` with numbers instead of lists: ``(l_keys, indexed, exact)`` and how often each of ``reasons`` (column by
    reason) skipped something. Boxes are only counted; distances are taken of the pairs that :func:`nearby` meets."""
    cols = [*keys, *BOX]
    both = locations.select(*cols, *FRAME, F.lit("ok").alias("status")).unionByName(unusable.select(*cols, "status"), allowMissingColumns=True)
    pairs = _near(both, radius, keys, cell, ()).filter("l_status = 'ok'")
    frame = reduce(lambda a, c: a & F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")), FRAME, F.lit(True))
    reason = F.when(F.col("r_status") != "ok", F.col("r_status")).when(~frame, OTHER_FRAME)
    of = [f"l_{k}" for k in keys]
    met = pairs.withColumn("reason", reason).groupBy(*of).agg(F.count("*").alias("indexed"), *[F.count_if(F.col("reason") == r).alias(n) for r, n in reasons.items()])
    near = nearby(locations, radius, keys, cell).groupBy(*of).agg(F.count("*").alias("exact"))
    same = reduce(lambda a, b: a & b, [met[k].eqNullSafe(near[k]) for k in of])
    return met.join(near, same, "left").select(*[met[k] for k in of], "indexed", F.coalesce("exact", F.lit(0)).alias("exact"), *reasons.values())


def nearest_status(covered: DataFrame) -> Column:
    """``ok`` with a result, ``insufficient_data`` where something in reach was skipped, else ``no_match``."""
    return found_status(F.col("exact"), F.size("skipped"))


def found_status(exact: Column, skipped: Column) -> Column:
    return F.when(exact > 0, "ok").when(skipped > 0, "insufficient_data").otherwise("no_match")


def pair_status(a: Column, b: Column, same_frame: Column) -> Column:
    """Status of a question about two resolved locations: the first that is not ok, then frame and unit."""
    return F.when(a != "ok", a).when(b != "ok", b).when(~same_frame, "insufficient_data").otherwise("ok")


def nearest(found: DataFrame, subject: list[str], other: list[str]) -> DataFrame:
    """The first of each subject's pairs by distance, then by the other's keys."""
    order = Window.partitionBy(*subject).orderBy("distance", *other)
    return found.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def nearest_within(locations: DataFrame, radius: float, keys: list[str], digits: int = 6) -> DataFrame:
    """The first other location of each that has one within ``radius``: by distance, rounded to ``digits``, then by keys.

    ``(l_keys, r_keys, distance)``. The search widens in three rounds, each for the locations that the one before has not settled, so
    that few of the pairs within the whole radius are ever made.
    """
    slack = 10.0**-digits
    left, found = locations, []
    for reach in (radius / 16, radius / 4, radius):
        pairs = _measured(left, locations, reach, keys, None, ordered=True).withColumn("rounded", F.round("distance", digits))
        best = pairs.groupBy(*[f"l_{k}" for k in keys]).agg(F.min(F.struct("rounded", *[f"r_{k}" for k in keys], "distance")).alias("best"))
        if reach < radius:
            best = best.filter(F.col("best.rounded") < reach - slack)  # a tie beyond the reach may come first
        found.append(staged(best, "nearest"))
        done = found[-1].select(F.struct(*[F.col(f"l_{k}").alias(k) for k in keys]).alias("done"))  # structs are equal if both hold null
        left = left.join(done, F.struct(*keys) == F.col("done"), "left_anti")
    out = reduce(DataFrame.unionByName, found)
    return out.select(*[f"l_{k}" for k in keys], *[f"best.r_{k}" for k in keys], "best.distance")


def vertical(pairs: DataFrame) -> DataFrame:
    """Adds ``relation`` and ``separation`` from ``l_``/``r_`` boxes."""
    v = vertical_relation(F.col("l_min_z"), F.col("l_max_z"), F.col("r_min_z"), F.col("r_max_z"))
    return pairs.withColumn("v", v).withColumn("relation", F.col("v.relation")).withColumn("separation", F.col("v.separation")).drop("v")


def without_gaps(spans: DataFrame, gaps: DataFrame, key: str) -> DataFrame:
    """``(key, start, end)``: what is left of ``spans(key, start, end)`` between its ``gaps(key, gap_start, gap_end)``.

    Gaps are taken in order of their bounds; each piece runs from the end of the gap before to the next one's start.
    """
    order = Window.partitionBy(key).orderBy("gap_start", "gap_end")
    cut = spans.join(gaps, key).withColumn("from", F.coalesce(F.lag("gap_end").over(order), F.col("start")))
    inner = cut.filter(F.col("from") < F.col("gap_start")).select(key, F.col("from").alias("start"), F.col("gap_start").alias("end"))
    last = gaps.groupBy(key).agg(F.max(F.struct("gap_start", "gap_end")).alias("last"))
    tail = spans.join(last, key, "left").withColumn("from", F.coalesce("last.gap_end", "start")).filter(F.col("from") < F.col("end"))
    return inner.unionByName(tail.select(key, F.col("from").alias("start"), "end"))

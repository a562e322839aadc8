"""Nested answers as tables: one row for every value inside a JSON document.

What is asked of documents of unlike shape (what they name, whether they hold what is expected, whether they keep a contract) then
is filters, joins and counts over all documents at once.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator
from json.encoder import encode_basestring
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

_CELL = "place bigint, path array<string>, kind string, value string"


def _once(pairs: list[tuple[str, Any]]) -> dict:
    found = dict(pairs)
    if len(found) < len(pairs):
        raise ValueError("a key is given twice")
    return found


def _finite(word: str) -> float:
    number = float(word)
    if not math.isfinite(number):
        raise ValueError("a number is not finite")
    return number


_DECODER = json.JSONDecoder(object_pairs_hook=_once, parse_float=_finite, parse_constant=_finite)


def strict(text: str) -> Any:
    """A JSON value; keys given twice and numbers that are not finite are errors."""
    return json.loads(text) if text.startswith("\ufeff") else _DECODER.decode(text)  # loads has its own error for the mark


def _plain(value: Any) -> Any:
    """Whole doubles as integers, so that equal numbers have one text."""
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return int(value) if isinstance(value, float) and value.is_integer() else value


_ENCODER = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def canonical(value: Any) -> str:
    """JSON with sorted keys and no spaces; other letters stay as they are, 1.0 is 1 and true is not."""
    return _ENCODER.encode(_plain(value))


_KINDS = {dict: "object", list: "array", str: "text", bool: "boolean", int: "integer", float: "number", type(None): "null"}


def _read(text: str | None) -> Any:
    return strict("null" if text is None else text)


def simple(value: Any) -> str:
    """:func:`canonical`, faster for texts and integers."""
    kind = type(value)
    return encode_basestring(value) if kind is str else repr(value) if kind is int else canonical(value)


class _Shapes:
    """Whether the path of a cell, with ``#`` for any index, is like one of some patterns; each path is tried once."""

    def __init__(self, patterns: tuple[str, ...]) -> None:
        self.like, self.known = re.compile("|".join(f"(?:{p})" for p in patterns), re.S), {}

    def __call__(self, shape: str) -> bool:
        found = self.known.get(shape)
        if found is None:
            if len(self.known) > 10_000:
                self.known.clear()
            found = self.known[shape] = self.like.fullmatch(shape) is not None
        return found


def _walk(text: str | None, wanted: Callable[[str], bool]) -> Iterator[tuple[int, tuple[str, ...], str, str]]:
    try:
        waiting = [("", (), _read(text))]
    except ValueError as error:
        if wanted(""):
            yield 0, (), "invalid", str(error)
        return
    place = 0
    while waiting:
        shape, path, value = waiting.pop()
        if wanted(shape):
            yield place, path, _KINDS[type(value)], canonical(value)
        place += 1
        if isinstance(value, dict):
            waiting += [(f"{shape}.{k}", (*path, f".{k}"), v) for k, v in reversed(value.items())]
        elif isinstance(value, list):
            waiting += [(f"{shape}#", (*path, f"#{i}"), value[i]) for i in range(len(value) - 1, -1, -1)]


def _records(text: str | None, names: list[str], needed: frozenset[str]) -> Iterator[tuple]:
    """The path and the named fields of every object that has some of them, and all the needed ones."""
    try:
        waiting = [((), _read(text))]
    except ValueError:
        return
    own, nested = set(names), [n.split(".", 1) for n in names if "." in n]
    while waiting:
        path, value = waiting.pop()
        if isinstance(value, dict):
            if needed <= value.keys():
                found = {n: canonical(value[n]) for n in own & value.keys()}
                for a, b in nested:
                    if isinstance(value.get(a), dict) and b in value[a]:
                        found[f"{a}.{b}"] = max(found.get(f"{a}.{b}", ""), canonical(value[a][b]))
                if found:
                    yield (path, *map(found.get, names))
            waiting += [((*path, f".{k}"), v) for k, v in value.items() if isinstance(v, (dict, list))]
        elif isinstance(value, list):
            waiting += [((*path, f"#{i}"), v) for i, v in enumerate(value) if isinstance(v, (dict, list))]


_MISSING = object()


def _follow(value: Any, path: list[str]) -> Any:
    for step in path:
        name = step[1:]
        if isinstance(value, dict) and step.startswith(".") and name in value:
            value = value[name]
        elif isinstance(value, list) and step.startswith("#") and name.isdecimal() and str(int(name)) == name and int(name) < len(value):
            value = value[int(name)]
        else:
            return _MISSING
    return value


def _told(text: str | None, asked: list[dict]) -> Iterator[tuple]:
    """The value at each asked path, and values of the elements there, for what is asked of them."""
    try:
        whole = _MISSING if text is None else strict(text)
    except ValueError as error:
        whole = _MISSING
        yield from ((q["check"], None, None, "invalid", str(error)) for q in asked if not q["path"])
        asked = [q for q in asked if q["path"]]
    for q in asked:
        value = _MISSING if whole is _MISSING else _follow(whole, q["path"])
        there = value is not _MISSING
        yield q["check"], None, None, _KINDS[type(value)] if there else None, canonical(value) if there else None
        for i, element in enumerate(value if isinstance(value, list) else ()):
            for rel in q["rels"] or ():
                inner = _follow(element, rel)
                if inner is not _MISSING:
                    yield q["check"], f"#{i}", rel, _KINDS[type(inner)], canonical(inner)


def _taken(documents: DataFrame, key: str, columns: list[str], take: Callable[..., Iterator[tuple]], shape: StructType) -> DataFrame:
    """``(key, <shape>)``: the rows that ``take`` finds in the ``columns`` of each document, in slices of documents."""
    schema = StructType([documents.schema[key], *shape.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(shape)
        for batch in batches:
            for slice_ in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                at, found = [], []
                for i, row in enumerate(zip(*(slice_.column(j).to_pylist() for j in range(1, len(columns) + 1)), strict=True)):
                    before = len(found)
                    found.extend(take(*row))
                    at.extend([i] * (len(found) - before))
                rows = list(zip(*found, strict=True)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([slice_.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, f.type) for c, f in zip(rows, types, strict=True))], names=schema.names)

    return documents.select(key, *columns).mapInArrow(run, schema)


def cells(documents: DataFrame, key: str, column: str, *shapes: str) -> DataFrame:
    """``(key, place, path, kind, value)``: every value inside the JSON texts of ``column``, outer before inner.

    A step of a path is ``.name`` or ``#index``. Values are canonical JSON, so that equal values are equal texts. A null text is
    a JSON null; a text that is not strict JSON is one cell of kind ``invalid``. With ``shapes``, patterns of paths put together with
    ``#`` for any index, only cells like one of them are made.
    """
    wanted = _Shapes(shapes or (".*",))
    return _taken(documents, key, [column], lambda text: _walk(text, wanted), StructType.fromDDL(_CELL))


class Documents:
    """JSON texts of ``rows(key, column)``; each question is a pass that makes only the rows it needs."""

    def __init__(self, rows: DataFrame, key: str, column: str) -> None:
        self.rows, self.key, self.column = rows.select(key, column), key, column

    def cells(self, *shapes: str) -> DataFrame:
        return cells(self.rows, self.key, self.column, *shapes)

    def objects(self, names: list[str], needed: tuple[str, ...] = ()) -> DataFrame:
        """``(key, path, <names>)``: one row per object that has some of the fields, with their values; ``a.b`` is field b of the object in a.

        Objects without one of the ``needed`` fields are left out.
        """
        shape = StructType([StructField("path", ArrayType(StringType())), *[StructField(n, StringType()) for n in names]])
        must = frozenset(needed)
        return _taken(self.rows, self.key, [self.column], lambda text: _records(text, names, must), shape)

    def told(self, questions: DataFrame) -> DataFrame:
        """``(key, check, item, rel, kind, value)`` for ``questions(key, check, path, rels)``: the value at the path (null where there is none) with
        neither item nor rel, and the values at ``rels`` below each element of the array there."""
        asked = questions.groupBy(self.key).agg(F.collect_list(F.struct("check", "path", "rels")).alias("asked"))
        texts = self.rows.select(self.key, F.coalesce(self.column, F.lit("null")).alias("text"))  # no text is left for keys without a document
        return _taken(asked.join(texts, self.key, "left"), self.key, ["text", "asked"], _told, StructType.fromDDL("check int, item string, rel array<string>, kind string, value string"))


def paired(left: Documents, right: Documents, judge: Callable[[list[str | None], list[str | None]], tuple[int, ...]], names: list[str], both: bool = False) -> DataFrame:
    """``(key, <names>)``: what ``judge`` finds, as integers, in all texts of a key on the left and all on the right, once per row on the left.

    With ``both``, only keys that are on the right too. A null key meets nothing. Texts of one key follow each other, so that a task holds those of one.
    """
    key = left.key
    side = lambda of, n: of.rows.select(F.col(of.key).alias(key), F.lit(n).alias("side"), F.col(of.column).alias("text"))
    rows = side(left, 0).unionByName(side(right, 1))
    rows = rows.select(key, "side", "text", F.row_number().over(Window.partitionBy(key).orderBy("side")).alias("n"))
    schema = StructType([left.rows.schema[key], *[StructField(n, IntegerType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out, texts = [], [], ([], [])

        def close() -> None:
            if texts[0] and (texts[1] or not both):
                found = judge(*texts)
                at.extend([of] * len(texts[0]))
                out.extend([found] * len(texts[0]))
            texts[0].clear()
            texts[1].clear()

        of = None
        for batch in batches:
            for slice_ in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                for now, where, text, n in zip(*(slice_.column(i).to_pylist() for i in range(4)), strict=True):
                    if n == 1 or now is None:
                        close()
                        of = now
                    if now is not None:
                        texts[where].append(text)
                    elif where == 0 and not both:
                        at.append(None)
                        out.append(judge([], []))
                if at:
                    yield made(at, out)
                    at.clear()
                    out.clear()
        close()
        if at:
            yield made(at, out)

    def made(at: list, out: list) -> pa.RecordBatch:
        types = to_arrow_schema(schema)
        return pa.RecordBatch.from_arrays([pa.array(at, types[0].type), *(pa.array(c, pa.int32()) for c in zip(*out, strict=True))], names=schema.names)

    return rows.mapInArrow(run, schema)


def last(path: Column, back: int = 1) -> Column:
    """A step counted from the end; null where the path is shorter."""
    return F.try_element_at(path, F.lit(-back))


def above(path: Column, levels: int = 1) -> Column:
    return F.slice(path, 1, F.greatest(F.size(path) - levels, F.lit(0)))


def given(value: Column) -> Column:
    """Whether a canonical value is there and not empty."""
    return F.coalesce(~value.isin("null", '""', "0", "false", "[]", "{}"), F.lit(False))


def leaves(found: DataFrame) -> DataFrame:
    """Cells that ask for something by themselves: all but objects with fields, and what lies inside arrays."""
    inside = F.exists("path", lambda s: s.startswith("#"))
    return found.filter(((F.col("kind") != "object") | (F.col("value") == "{}")) & ~inside)


def holding(found: DataFrame, key: str, bases: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(key, check, item)``: elements of the arrays ``bases(key, check, path)`` that have all ``wanted(key, check, rel, kind, value)``.

    Wanted cells are :func:`leaves` of a selector: objects may have more fields than it asks for, at any depth; all else is equal.
    """
    under = found.select(key, "kind", "value", "path", F.posexplode("path").alias("n", "item")).filter(F.col("item").startswith("#"))
    under = under.select(key, F.expr("slice(path, 1, n)").alias("base"), "item", F.expr("slice(path, n + 2, size(path))").alias("rel"), F.col("kind").alias("is"), F.col("value").alias("has"))
    there = under.join(bases.withColumnRenamed("path", "base"), [key, "base"]).join(wanted, [key, "check", "rel"])
    return held(there, key, wanted)


def held(there: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Elements whose values, joined with the wanted ones as columns ``is`` and ``has``, are all as wanted."""
    met = there.filter((F.col("value") == F.col("has")) | ((F.col("value") == "{}") & (F.col("is") == "object")))
    asked = wanted.groupBy(key, "check").agg(F.count("*").alias("asked"))
    return met.groupBy(key, "check", "item").agg(F.count("*").alias("met")).join(asked, [key, "check"]).filter("met = asked").select(key, "check", "item")

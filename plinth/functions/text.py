"""Text expressions: ASCII-only case folding, tokens, datums, page status, slugs, paths, time stamps, units."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Accented letters whose accents the tokenizer drops, and the letters that stay.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
LOW_TEXT_CHARS = 40


def ascii_lower(text: Column) -> Column:
    """Folds A-Z only: É stays apart from é, as everywhere in this engine."""
    return F.translate(text, UPPER, LOWER)


def same_nocase(a: Column, b: Column) -> Column:
    return ascii_lower(a) == ascii_lower(b)


def contains_nocase(text: Column, part: Column) -> Column:
    """An empty part is contained in every text."""
    return F.position(ascii_lower(part), ascii_lower(text)) > 0


def is_blank(text: Column) -> Column:
    """Null or Unicode white space only (U+3000 counts)."""
    return text.isNull() | ~text.rlike(r"(?U)\S")


def stripped(text: Column) -> Column:
    """Without white space of any kind around it."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def plain(text: Column) -> Column:
    """In lower case, without white space of any kind around it."""
    return F.lower(stripped(text))


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty; the last one is taken as it is."""
    return F.coalesce(*[F.when(v != "", v) for v in values[:-1]], values[-1])


def tokens(text: Column) -> Column:
    """Runs of letters and digits, case-folded with Unicode rules, without accents."""
    folded = F.translate(F.lower(F.coalesce(text, F.lit(""))), ACCENTED, PLAIN)
    return F.regexp_extract_all(folded, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


#: How a display text names its reference level (fixed pattern).
DATUM = r"^\s*([A-Za-z][A-Za-z0-9_. -]*?)\s*[+-]\s*\d"


def datum(text: Column) -> Column:
    """The reference level a display text names: ``RFL`` of ``RFL + 1250``, or a short text without digits as it is."""
    named = F.regexp_extract(text, DATUM, 1)
    whole = stripped(text)
    short = (F.length(whole) <= 32) & whole.rlike(r"^[A-Za-z][A-Za-z_. -]*$")
    return F.when(named != "", named).when(short, whole)


def normalized(text: Column) -> Column:
    """Line feeds only, no white space at the end."""
    return F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), r"(?U)\s+$", "")


def text_status(text: Column) -> Column:
    """``no_text``, ``minimal_text`` (under 40 characters) or ``extracted``."""
    n = F.length(F.coalesce(normalized(text), F.lit("")))
    return F.when(n == 0, "no_text").when(n < LOW_TEXT_CHARS, "minimal_text").otherwise("extracted")


def slug(text: Column, suffix: Column) -> Column:
    body = F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "-"), r"^[-.]+|[-.]+$", "")
    return F.concat(F.when(body == "", F.lit("document")).otherwise(body), F.lit("-"), suffix)


def is_sha256(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9a-f]{64}$"), F.lit(False))


def is_logical_path(path: Column, prefix: str = "", suffix: str = ".pdf") -> Column:
    """Relative POSIX path below ``prefix`` with no empty, ``.`` or ``..`` part, of the wanted suffix."""
    parts = F.split(path, "/")
    good = ~path.contains("\\") & ~path.startswith("/") & path.startswith(prefix) & F.lower(path).endswith(suffix)
    return F.coalesce(good & ~F.arrays_overlap(parts, F.array(F.lit(""), F.lit("."), F.lit(".."))), F.lit(False))


def is_timestamp(text: Column) -> Column:
    """ISO 8601 with an offset that names a real date and time."""
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$")
    whole = F.regexp_replace(text, r"\.\d+", "")  # any number of digits after the point
    real = F.try_to_timestamp(whole).isNotNull() & ~text.startswith("0000") & text.rlike(r"T([01]\d|2[0-3]):[0-5]\d:[0-5]\d") & text.rlike(r"(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$")
    return F.coalesce(shaped & real, F.lit(False))


def from_unix(seconds: Column, end: int = 253402300800) -> Column:
    """ISO 8601 in UTC of decimal Unix seconds from 0 to ``end`` (the year 9999), to the microsecond, half to even; null beyond.

    Doubles are taken as their shortest decimals; give decimals where a product of doubles is meant. Later years have more digits.
    """
    micros = F.bround(seconds.cast("decimal(38,12)") * 1_000_000, 0).cast("bigint")
    good = (seconds >= 0) & (seconds < end)
    stamp = F.timestamp_micros(micros)
    tail = F.when(micros % 1_000_000 == 0, "").otherwise(F.concat(F.lit("."), F.lpad((micros % 1_000_000).cast("string"), 6, "0")))
    return F.when(good, F.concat(F.year(stamp).cast("string"), F.date_format(stamp, "-MM-dd'T'HH:mm:ss"), tail, F.lit("Z")))


def sorted_map(counts: Column) -> Column:
    """A map with its keys in order."""
    return F.map_from_entries(F.array_sort(F.map_entries(counts)))


def local_date(ts: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def page_range(spec: Column, last: Column) -> Column:
    """Sorted distinct pages of ``1,3-5``; null where a part is no range, runs backwards or leaves 1..last."""
    parts = F.split(F.regexp_replace(spec, " ", ""), ",")
    low = F.transform(parts, lambda p: F.element_at(F.split(p, "-"), 1).try_cast("int"))
    high = F.transform(parts, lambda p: F.element_at(F.split(p, "-"), -1).try_cast("int"))
    good = F.forall(parts, lambda p: p.rlike(r"^\d+(-\d+)?$")) & F.forall(F.arrays_zip(low.alias("a"), high.alias("b")), lambda x: (x["a"] >= 1) & (x["a"] <= x["b"]) & (x["b"] <= last))
    spans = F.transform(F.arrays_zip(low.alias("a"), high.alias("b")), lambda x: F.sequence(x["a"], x["b"]))
    return F.when(F.coalesce(good, F.lit(False)), F.array_sort(F.array_distinct(F.flatten(spans))))


#: Factors to the engine's units, by kind of quantity (fixed values).
UNITS = {"length": (304.8, "mm"), "area": (0.09290304, "m2"), "volume": (0.028316846592, "m3"), "angle": (57.29577951308232, "degrees"), "integer": (1.0, "number")}


def in_engine_units(kind: Column, value: Column) -> Column:
    """Struct (value, unit): host feet and radians to mm, m2, m3 and degrees; other kinds have no numeric value."""
    factor = reduce(lambda c, kv: c.when(kind == kv[0], F.lit(kv[1][0])), UNITS.items(), F.when(F.lit(False), F.lit(0.0)))
    unit = reduce(lambda c, kv: c.when(kind == kv[0], F.lit(kv[1][1])), UNITS.items(), F.when(F.lit(False), F.lit("")))
    return F.struct((value * factor).alias("value"), unit.alias("unit"))

"""Mixing sources to target weights by hierarchical budgeting.

The token budget runs down a tree of domain, language and source in proportion to weights. A node can take no more
than its tokens times the allowed epochs. What one node cannot take goes to its siblings in proportion to their
weights, and only what a whole family cannot take goes to the family's siblings: capacities are summed up the tree
before budgets are filled down it. Each leaf then gives the longest prefix of a seeded order that fits, after as many
whole epochs as fit; every epoch has an order of its own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.llm.common import WORD, packed, saved
from plinth.llm.prefix import bucket_of, running, seeded_key

DOMAIN_WEIGHTS = {"d0": 0.4, "d1": 0.3, "d2": 0.2, "d3": 0.1}
LANG_WEIGHTS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
NONE = "(none)"


def domain_of(source: Column) -> Column:
    """The domain a source belongs to: its trailing number modulo four, else ``other``."""
    digits = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.coalesce(F.when(digits != "", F.concat(F.lit("d"), (digits.try_cast("bigint") % 4).cast("string"))), F.lit("other"))


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _weight(col: str, weights: Mapping[str, float], default: float) -> Column:
    if any(w < 0 for w in (*weights.values(), default)):
        raise ValueError("weights must not be negative")
    if not weights:
        return F.lit(float(default))
    named = {k if k == NONE else _escape(k): float(w) for k, w in weights.items()}
    return F.coalesce(F.create_map(*[F.lit(x) for kv in sorted(named.items()) for x in kv])[F.col(col)], F.lit(float(default)))


def _escape(name: str) -> str:
    return f"({name}" if name.startswith("(") else name


def _leaf_name(col: str) -> Column:
    """A name for each value, null included: ``(none)``; values that begin with a bracket get another one."""
    return F.coalesce(F.when(F.startswith(F.col(col), F.lit("(")), F.concat(F.lit("("), F.col(col))).otherwise(F.col(col)), F.lit(NONE))


def fill(nodes: DataFrame, family: list[str], name: str, budget: str, out: str) -> DataFrame:
    """Splits ``budget`` among the rows of each family by ``weight``, none above its ``cap``.

    Ordered by cap / weight, the rows that are full form a prefix; the first row that is not tells the common level.
    """
    order = Window.partitionBy(*family).orderBy(F.col("cap") / F.col("weight"), name)
    taken = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    nodes = nodes.withColumn("_level", (F.col(budget) - taken) / left)
    nodes = nodes.withColumn("_full", F.col("_level") * F.col("weight") >= F.col("cap"))
    level = F.max(F.when(~F.col("_full"), F.col("_level"))).over(Window.partitionBy(*family))
    nodes = nodes.withColumn("_water", level)
    return nodes.withColumn(out, F.when(F.col("_full"), F.col("cap")).otherwise(F.greatest(F.lit(0.0), F.col("_water") * F.col("weight")))).drop("_level", "_full", "_water")


def budgets(leaves: DataFrame, budget_share: float, max_epochs: int, domain_weights: Mapping[str, float], lang_weights: Mapping[str, float], default_weight: float) -> DataFrame:
    """``(domain, lang, source, tokens, budget)`` from ``leaves(domain, lang, source, tokens)``; budgets are whole."""
    domain, lang = _weight("domain", domain_weights, default_weight), _weight("lang", lang_weights, default_weight)
    # a weight of zero takes nothing: no capacity, and some weight so that ratios exist
    some = lambda w: F.when(w > 0, w).otherwise(1.0)
    caps = leaves.withColumn("cap", F.when((domain > 0) & (lang > 0), F.col("tokens").cast("double") * max_epochs).otherwise(0.0))
    top = caps.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("supply")).withColumn("all", F.lit(0))
    top = top.withColumn("weight", some(domain)).withColumn("b0", F.sum("supply").over(Window.partitionBy("all")) * budget_share)
    top = fill(top, ["all"], "domain", "b0", "b1").select("domain", "b1")
    mid = caps.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).withColumn("weight", some(lang))
    mid = fill(mid.join(top, "domain"), ["domain"], "lang", "b1", "b2").select("domain", "lang", "b2")
    low = caps.withColumn("weight", F.lit(1.0)).join(mid, ["domain", "lang"])
    low = fill(low, ["domain", "lang"], "source", "b2", "b3")
    return low.select("domain", "lang", "source", "tokens", F.floor(F.col("b3") + 1e-6).cast("bigint").alias("budget"))


def mix(
    docs: DataFrame, budget_share: float = 0.6, max_epochs: int = 2, domain_weights: Mapping[str, float] = DOMAIN_WEIGHTS, lang_weights: Mapping[str, float] = LANG_WEIGHTS,
    default_weight: float = 0.05, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", tie_cols: tuple[str, ...] = (), bucket_rows: int = 20_000, tokens: Column | None = None,
) -> DataFrame:
    """``docs`` repeated as often as chosen, with ``domain``, ``tokens`` and ``epoch`` (0 for the first time).

    Null languages and sources form leaves of their own (a weight for null languages is named ``(none)``). Rows
    without words have no tokens: they come along where they fall inside a prefix. Repeated rows are rows like others.
    Columns already called like the new ones are replaced; all others come back as they were, whatever their names.
    Weights that a mapping lacks are ``default_weight``; a weight of zero takes nothing, a negative one is an error;
    sources of a language share alike. The tree (not the rows) is what aggregates to one task.
    """
    new = ["domain", "tokens", "epoch"]
    kept = docs.drop(*new)
    # the caller's columns travel inside one column, so that none can clash with a working one
    rows = docs.select(
        packed(kept).alias("row"), F.struct(*[F.col(c) for c in (id_col, *tie_cols)]).alias("tie"), F.col(id_col).alias("id"), (tokens_of(F.col(text_col)) if tokens is None else tokens).alias("tokens"),
        domain_of(F.col("source")).alias("domain"), _leaf_name("lang").alias("lang"), _leaf_name("source").alias("source"),
    )
    leaf = ["domain", "lang", "source"]
    leaves = rows.groupBy(*leaf).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    plan = budgets(leaves.drop("n"), budget_share, max_epochs, domain_weights, lang_weights, default_weight)
    plan = plan.withColumn("whole", F.expr("if(tokens = 0, 0L, least(budget div greatest(tokens, 1L), cast(%d as bigint)))" % max_epochs))
    # written down, so that its true size is known: a tree of usual size is broadcast and rows stay where they are
    rows = rows.join(saved(plan.select(*leaf, "whole", (F.col("budget") - F.col("whole") * F.col("tokens")).alias("rest")), "budgets"), leaf)
    buckets = max(1, -(-docs.count() // bucket_rows))
    rows = rows.withColumn("key", seeded_key(F.col("whole"), F.col("id"), seed=seed)).withColumn("bucket", bucket_of(F.col("key"), buckets))
    rows = running(rows, leaf, "bucket", ["key", "tie"], F.col("tokens"), "before", "sum")
    partly = (F.col("rest") > 0) & (F.col("before") + F.col("tokens") <= F.col("rest"))
    rows = rows.withColumn("times", F.col("whole") + partly.cast("bigint")).filter("times > 0")
    return rows.withColumn("epoch", F.explode(F.expr("sequence(0, cast(times as int) - 1)"))).select("row.*", *new)


def digest(docs: DataFrame) -> DataFrame:
    """One row per chosen document and epoch; texts are read for their token count only."""
    light = docs.select("doc_id", "lang", "source", tokens_of(F.col("text")).alias("n"))
    return mix(light, tokens=F.col("n"), tie_cols=("n",)).select("doc_id", "domain", "lang", "source", "tokens", "epoch")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '(none)') AS lg, coalesce(source, '(none)') AS sc, lang, source,
         CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) = '' THEN 'other'
              ELSE 'd' || CAST(CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS BIGINT) % 4 AS VARCHAR) END AS dm,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
  FROM documents),
leaf AS (SELECT dm, lg, sc, sum(tokens) AS tokens, sum(tokens) * 2.0::DOUBLE AS cap FROM d GROUP BY dm, lg, sc),
t1 AS (SELECT dm, sum(cap) AS cap, CASE dm WHEN 'd0' THEN 0.4 WHEN 'd1' THEN 0.3 WHEN 'd2' THEN 0.2 WHEN 'd3' THEN 0.1 ELSE 0.05 END::DOUBLE AS w,
              sum(sum(tokens)) OVER () * 0.6::DOUBLE AS b FROM leaf GROUP BY dm),
l1 AS (SELECT *, (b - coalesce(sum(cap) OVER (ORDER BY cap / w, dm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY cap / w, dm ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM t1),
a1 AS (SELECT dm, CASE WHEN lvl * w >= cap THEN cap ELSE greatest(0, max(CASE WHEN lvl * w < cap THEN lvl END) OVER () * w) END AS b1 FROM l1),
t2 AS (SELECT leaf.dm, leaf.lg, sum(leaf.cap) AS cap, max(b1) AS b,
              CASE leaf.lg WHEN 'en' THEN 0.55 WHEN 'de' THEN 0.15 WHEN 'fr' THEN 0.15 WHEN 'es' THEN 0.15 ELSE 0.05 END::DOUBLE AS w
       FROM leaf JOIN a1 ON leaf.dm = a1.dm GROUP BY leaf.dm, leaf.lg),
l2 AS (SELECT *, (b - coalesce(sum(cap) OVER (PARTITION BY dm ORDER BY cap / w, lg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (PARTITION BY dm ORDER BY cap / w, lg ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM t2),
a2 AS (SELECT dm, lg, CASE WHEN lvl * w >= cap THEN cap ELSE greatest(0, max(CASE WHEN lvl * w < cap THEN lvl END) OVER (PARTITION BY dm) * w) END AS b2 FROM l2),
t3 AS (SELECT leaf.*, b2 AS b, 1.0::DOUBLE AS w FROM leaf JOIN a2 ON leaf.dm = a2.dm AND leaf.lg = a2.lg),
l3 AS (SELECT *, (b - coalesce(sum(cap) OVER (PARTITION BY dm, lg ORDER BY cap / w, sc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (PARTITION BY dm, lg ORDER BY cap / w, sc ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM t3),
a3 AS (SELECT dm, lg, sc, tokens AS supply,
              CAST(floor(CASE WHEN lvl * w >= cap THEN cap ELSE greatest(0, max(CASE WHEN lvl * w < cap THEN lvl END) OVER (PARTITION BY dm, lg) * w) END + 1e-6) AS BIGINT) AS budget FROM l3),
pl AS (SELECT *, CASE WHEN supply = 0 THEN 0 ELSE least(CAST(floor(budget / greatest(supply, 1)) AS BIGINT), 2) END AS whole FROM a3),
r AS (SELECT d.*, pl.whole, pl.budget - pl.whole * pl.supply AS rest,
             sum(d.tokens) OVER (PARTITION BY d.dm, d.lg, d.sc ORDER BY md5('42|' || CAST(pl.whole AS VARCHAR) || '|' || CAST(d.doc_id AS VARCHAR)), d.doc_id ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN pl ON d.dm = pl.dm AND d.lg = pl.lg AND d.sc = pl.sc),
c AS (SELECT *, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS times FROM r)
SELECT doc_id, dm AS domain, lang, source, CAST(tokens AS BIGINT) AS tokens, CAST(e AS INTEGER) AS epoch
FROM (SELECT *, unnest(range(CAST(times AS BIGINT))) AS e FROM c WHERE times > 0)
"""

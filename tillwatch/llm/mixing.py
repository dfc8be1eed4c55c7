"""Mixing sources by temperature, in DataFrame operations only.

A source's weight is its share of all tokens to the power of an exponent, normalised: 1 keeps the shares, 0
makes all sources equal. The exponent is bisected until the mixture has the target entropy, unless that
repeats some source too often; then until the repetition limit is met. The weights become token budgets, and
each budget is spent in epochs over blocks of documents: an epoch orders the blocks of a source anew, and the
documents within each block; the last epoch ends where the budget does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwatch.llm.common import written

_SPACE = r"[\x20\x09-\x0D]+"
#: Points of the exponent tried in one job; each job narrows the bracket to one of the gaps.
_POINTS = 16
_HASH_BITS = 60


def token_count(text: Column) -> Column:
    """Words of a text (runs without white space); null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, _SPACE))).cast("long")


def number_of(*parts: Column) -> Column:
    """60 bits of the MD5 of the parts, joined by colons, as a whole number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def bisect(reached: Callable[[list[float]], list[bool]], rounds: int = 5) -> float:
    """The largest exponent in 0..1, to four digits, at which ``reached`` holds; it holds below that one."""
    low, high = 0.0, 1.0
    if reached([1.0])[0]:
        return 1.0
    for _ in range(rounds):
        points = [low + (high - low) * k / _POINTS for k in range(1, _POINTS)]
        good = [p for p, ok in zip(points, reached(points), strict=True) if ok]
        low, high = max(good, default=low), min((p for p in points if p not in good), default=high)
    return round(low, 4)


@dataclass
class Measures:
    """Entropy (in nats) and the largest repetition of the mixtures at some exponents."""

    shares: DataFrame
    budget: float | None

    def at(self, exponents: list[float]) -> list[tuple[float, float]]:
        rows = self.shares.select("share", F.explode(F.array(*[F.lit(float(e)) for e in exponents])).alias("e"))
        rows = rows.withColumn("w", F.pow("share", "e"))
        found = rows.groupBy("e").agg(
            F.sum("w").alias("z"), F.sum(F.col("w") * F.log("w")).alias("s"),
            F.max(F.col("w") / F.col("share")).alias("most"), F.min(F.col("w") / F.col("share")).alias("least")).collect()
        total = self.shares.agg(F.sum("tokens")).first()[0]
        by = {}
        for r in found:
            entropy = log(r["z"]) - r["s"] / r["z"]
            scale = r["least"] if self.budget is None else r["z"] * total / self.budget
            by[r["e"]] = (entropy, r["most"] / scale)
        return [by[float(e)] for e in exponents]


def plan(docs: DataFrame, entropy_share: float | None = 0.95, repeat_limit: float = 4.0, budget: int | None = None,
         block_tokens: int = 1 << 16, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Rows (key, source, tokens, epoch, block, block_key, doc_key): every use of every document.

    Within a source the training order is epoch, block_key, doc_key (ties: doc_id). The target is an entropy of
    ``entropy_share`` of the largest possible one (None: no target, all sources equal), as far as no source
    is repeated more than ``repeat_limit`` times. ``budget`` is the number of tokens to spend; by default
    the smallest at which every source is used once in whole, so that no document is lost. The
    document at which a budget ends is the last one used.

    A null source is a source of its own. Documents without tokens carry no weight: they are used once per
    whole epoch, and a source without any tokens once. Repeated rows and null ids are used like any other row.
    No table, no rows.
    """
    sized = docs.select(F.col(key).alias("id"), F.col(source).alias("src"), token_count(F.col(text)).alias("tokens"))
    sized = written(sized, "sizes")
    sums = written(sized.groupBy("src").agg(F.sum("tokens").alias("tokens")), "source-sizes")
    filled = sums.where("tokens > 0")
    total = filled.agg(F.sum("tokens")).first()[0]
    if total is None:
        weights = sums.select("src", F.lit(1).cast("long").alias("whole"), F.lit(0).cast("long").alias("rest"), F.lit(1).cast("long").alias("blocks"))
    else:
        shares = filled.withColumn("share", F.col("tokens") / F.lit(float(total)))
        measures = Measures(shares, budget)
        count = filled.count()
        goal = entropy_share * log(count) if entropy_share is not None else None
        exponent = 0.0 if goal is None or count == 1 else bisect(lambda e: [h >= goal - 1e-12 for h, _ in measures.at(e)])
        if measures.at([exponent])[0][1] > repeat_limit:
            exponent = _smallest(lambda e: [most <= repeat_limit for _, most in measures.at(e)], exponent)
        weighted = shares.withColumn("w", F.pow("share", F.lit(exponent)))
        z, least = weighted.agg(F.sum("w"), F.min(F.col("w") / F.col("share"))).first()
        spent = float(total) * z / least if budget is None else float(budget)
        goal_tokens = F.floor(F.col("w") * F.lit(spent) / F.lit(z) + F.lit(0.5)).cast("long")
        weights = weighted.withColumn("goal", goal_tokens).select(
            "src", F.floor(F.col("goal") / F.col("tokens")).cast("long").alias("whole"),
            F.pmod("goal", "tokens").alias("rest"), F.ceil(F.col("tokens") / F.lit(block_tokens)).cast("long").alias("blocks"))
        empty = sums.where("tokens = 0").select("src", F.lit(1).cast("long").alias("whole"), F.lit(0).cast("long").alias("rest"), F.lit(1).cast("long").alias("blocks"))
        weights = weights.unionByName(empty)
    weights = written(weights, "budgets")
    placed = sized.join(weights, sized["src"].eqNullSafe(weights["src"])).select(
        "id", sized["src"], "tokens", "whole", "rest", F.pmod(number_of(F.lit("block"), F.col("id").cast("string")), F.col("blocks")).alias("block"), "blocks")

    def keyed(rows: DataFrame) -> DataFrame:
        epoch = F.col("epoch").cast("string")
        return rows.withColumn("block_key", number_of(F.lit("order"), epoch, F.col("block").cast("string"), F.coalesce("src", F.lit("")))).withColumn(
            "doc_key", number_of(F.lit("place"), epoch, F.col("id").cast("string")))

    columns = [F.col("id").alias(key), F.col("src").alias(source), "tokens", "epoch", "block", "block_key", "doc_key"]
    whole = keyed(placed.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1))))
    last = keyed(placed.where("rest > 0 and tokens > 0").withColumn("epoch", F.col("whole")))
    before = blocks_before(last)
    inside = Window.partitionBy("src", "block").orderBy("doc_key", "id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    cut = last.join(before.withColumnRenamed("src", "s").withColumnRenamed("block", "b"), F.col("src").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    cut = cut.where("before < rest").withColumn("used", F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).where("used < rest")
    return whole.select(*columns).unionByName(cut.select(*columns))


def _smallest(reached: Callable[[list[float]], list[bool]], low: float, rounds: int = 5) -> float:
    """The smallest exponent from ``low`` to 1, to four digits, at which ``reached`` holds; it holds above it."""
    high = 1.0
    for _ in range(rounds):
        points = [low + (high - low) * k / _POINTS for k in range(1, _POINTS)]
        good = [p for p, ok in zip(points, reached(points), strict=True) if ok]
        bad = [p for p in points if p not in good]
        low, high = max(bad, default=low), min(good, default=high)
    return round(high + 5e-5, 4) if high < 1 else 1.0


def blocks_before(rows: DataFrame, per_group: int = 1024) -> DataFrame:
    """(src, block, before): tokens of a source's blocks that come earlier in the order of their keys.

    Running sums in two levels: blocks are grouped by ranges of their key, about ``per_group`` to a group, so
    no window holds all blocks of a hot source.
    """
    sums = rows.groupBy("src", "block", "block_key", "blocks").agg(F.sum("tokens").alias("own"))
    groups = F.ceil(F.col("blocks") / F.lit(per_group))
    sums = sums.withColumn("grp", F.floor(F.col("block_key").cast("double") / F.lit(float(1 << _HASH_BITS)) * groups).cast("long"))
    earlier = Window.partitionBy("src").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    heads = sums.groupBy("src", "grp").agg(F.sum("own").alias("all")).select(
        F.col("src").alias("s"), F.col("grp").alias("g"), F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("ahead"))
    inner = Window.partitionBy("src", "grp").orderBy("block_key", "block").rowsBetween(Window.unboundedPreceding, -1)
    joined = sums.withColumn("near", F.coalesce(F.sum("own").over(inner), F.lit(0))).join(
        heads, F.col("src").eqNullSafe(F.col("s")) & (F.col("grp") == F.col("g")))
    return joined.select("src", "block", (F.col("ahead") + F.col("near")).alias("before"))


#: DuckDB SQL of ``plan`` with its default parameters over ``documents``.
PLAN_SQL = """
WITH RECURSIVE sized AS (
  SELECT doc_id AS id, source AS src, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens
  FROM documents
), sums AS (SELECT src, sum(tokens)::BIGINT AS tokens FROM sized GROUP BY src),
shares AS (SELECT src, tokens, tokens::DOUBLE / (SELECT sum(tokens) FROM sums)::DOUBLE AS share FROM sums WHERE tokens > 0),
whole_list AS (SELECT list(share) AS p, count(*) AS n, 0.95 * ln(count(*)) - 1e-12 AS goal FROM shares),
by_entropy(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL
  SELECT i + 1, CASE WHEN h >= goal THEN (lo + hi) / 2 ELSE lo END, CASE WHEN h >= goal THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT i, lo, hi, goal,
          ln(list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2))))
          - list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2) * ln(pow(x, (lo + hi) / 2))))
          / list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2))) AS h
        FROM by_entropy, whole_list) WHERE i < 40
), first_try AS (
  SELECT CASE WHEN n = 1 THEN 0.0 WHEN -list_sum(list_transform(p, lambda x: x * ln(x))) >= goal THEN 1.0
         ELSE (SELECT round(lo, 4) FROM by_entropy WHERE i = 40) END AS e, p FROM whole_list
), by_limit(i, lo, hi) AS (
  SELECT 0, e, 1.0::DOUBLE FROM first_try UNION ALL
  SELECT i + 1, CASE WHEN m <= 4.0 THEN lo ELSE (lo + hi) / 2 END, CASE WHEN m <= 4.0 THEN (lo + hi) / 2 ELSE hi END
  FROM (SELECT i, lo, hi, pow(list_max(p) / list_min(p), 1 - (lo + hi) / 2) AS m FROM by_limit, first_try) WHERE i < 40
), exponent AS (
  SELECT CASE WHEN pow(list_max(p) / list_min(p), 1 - e) <= 4.0 THEN e
         ELSE (SELECT CASE WHEN hi < 1 THEN round(hi + 5e-5, 4) ELSE 1.0 END FROM by_limit WHERE i = 40) END AS e FROM first_try
), weighted AS (SELECT src, tokens, share, pow(share, e) AS w FROM shares, exponent),
scale AS (SELECT sum(w) AS z, min(w / share) AS least, sum(tokens)::DOUBLE AS total FROM weighted),
budgets AS (
  SELECT src, goal // tokens AS whole, goal % tokens AS rest, ((tokens + 65535) // 65536)::BIGINT AS blocks
  FROM (SELECT src, tokens, floor(w * (total * z / least) / z + 0.5)::BIGINT AS goal FROM weighted, scale)
  UNION ALL SELECT src, 1, 0, 1 FROM sums WHERE tokens = 0
), placed AS (
  SELECT id, s.src, tokens, whole, rest, blocks,
    ('0x' || substr(md5('block' || coalesce(':' || id::VARCHAR, '')), 1, 15))::BIGINT % blocks AS block
  FROM sized s JOIN budgets b ON s.src IS NOT DISTINCT FROM b.src
), uses AS (
  SELECT *, unnest(range(0, whole + CASE WHEN rest > 0 THEN 1 ELSE 0 END)) AS epoch FROM placed
), keyed AS (
  SELECT *, ('0x' || substr(md5('order:' || epoch || ':' || block || ':' || coalesce(src, '')), 1, 15))::BIGINT AS block_key,
    ('0x' || substr(md5('place:' || epoch || coalesce(':' || id::VARCHAR, '')), 1, 15))::BIGINT AS doc_key
  FROM uses
), spent AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY src, epoch ORDER BY block_key, block, doc_key, id, tokens
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM keyed
)
SELECT id AS doc_id, src AS source, tokens, epoch, block, block_key, doc_key FROM spent
WHERE epoch < whole OR (used < rest AND tokens > 0)
"""

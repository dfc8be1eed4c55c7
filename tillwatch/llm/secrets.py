"""Secrets in texts: single patterns, and parts of one credential that lie near each other.

Access identifiers, secrets and endpoints are found by patterns in the tasks that read the texts; some
candidates are strong enough alone, the rest are weak. The parts of one credential are then linked by an
interval join: an access identifier owns a scope of ``reach`` code points on both sides, and a weak
candidate is reported only if an identifier and a secret (and, for a weak endpoint, both) lie in one
scope. The join is keyed by document and interval bin, so its work is bounded by how many
non-overlapping candidates fit into a scope.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import free_name, ship, struct_of, written

# The base patterns and their least lengths, in the order of the kinds.
BASE_KINDS = ("assign", "access", "hex")
_KEYWORD = (
    "(?:[pP][aA][sS][sS](?:[wW][oO][rR][dD]|[wW][dD])|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
)
ASSIGN = re.compile(_KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGNED = 8

#: Kinds of the linked parts, in the order of ``spans`` after the base kinds.
LINK_KINDS = ("id", "key", "endpoint")
IDENTIFIER = re.compile(
    r"""(?i:access_?key_?id|client_?id|account|username|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.ASCII)
KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/]{20,}={0,2}")
_MIXED = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Z]*[A-Z])[^a-z]*[a-z]")
ENDPOINT = re.compile(r"(?i:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp)://[A-Za-z0-9._:@/-]+", re.ASCII)

REACH = 300
KINDS = (*BASE_KINDS, *LINK_KINDS)
_SPAN = struct_of(("kind", T.IntegerType()), ("start", T.LongType()), ("stop", T.LongType()))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, in code points."""
    found = []
    if ":" in text or "=" in text:
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGNED]
    found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    return found + [(2, m.start(), m.end()) for m in HEX.finditer(text)]


def weak_spans(text: str, access: bool) -> list[tuple[int, int, int]]:
    """Parts that say nothing alone: identifiers and, if any or ``access``, long mixed keys and endpoints."""
    found = []
    if ":" in text or "=" in text:
        found += [(3, m.start(), m.end()) for m in IDENTIFIER.finditer(text)]
    if found or access:
        found += [(4, m.start(), m.end()) for m in KEY.finditer(text) if _MIXED.match(m[0])]
        if "://" in text:
            found += [(5, m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    return found


def all_spans(text: str | None) -> list[tuple[int, int, int]]:
    if not isinstance(text, str):
        return []
    base = base_spans(text)
    return base + weak_spans(text, any(kind == 1 for kind, _, _ in base))


def candidates(docs: DataFrame, text: str = "text", name: str = "found") -> DataFrame:
    """All columns of ``docs`` with the base and weak spans of the whole text (null: none)."""
    name = free_name(docs.columns, name)
    schema = struct_of(*((f.name, f.dataType) for f in docs.schema.fields), (name, T.ArrayType(_SPAN)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = [all_spans(v) for v in batch[text]]
            yield batch.assign(**{name: [[dict(zip(("kind", "start", "stop"), s, strict=True)) for s in own] for own in spans]})

    ship(docs.sparkSession)
    return docs.mapInPandas(run, schema)


def linked(spans: DataFrame, key: str, reach: int = REACH) -> DataFrame:
    """Rows (key, kind, start, stop) of the weak spans that complete a credential.

    ``spans`` has those columns, base spans included. An access span, or a weak identifier, opens a scope.
    The parts of a scope are spans that begin within ``reach`` of the identifier's bounds. An identifier is
    reported if its scope holds a secret (an assignment, a hex run or a weak key), a weak key if it lies in
    the scope of an identifier, an endpoint if it lies in a scope with a secret.
    """
    bins = F.floor(F.col("start") / F.lit(reach)).cast("long")
    ids = spans.where(F.col("kind").isin(1, 3)).select(
        F.col(key).alias("k"), F.col("kind").alias("ik"), F.col("start").alias("a"), F.col("stop").alias("b"),
        F.explode(F.sequence(F.floor((F.col("start") - reach) / F.lit(reach)), F.floor((F.col("stop") + reach) / F.lit(reach)))).alias("bin"))
    parts = spans.where(~F.col("kind").isin(1, 3)).select(
        F.col(key).alias("k"), bins.alias("bin"), "kind", "start", "stop")
    near = parts.join(ids, ["k", "bin"]).where(
        (F.col("start") >= F.col("a") - reach) & (F.col("start") <= F.col("b") + reach)
        & ((F.col("stop") <= F.col("a")) | (F.col("start") >= F.col("b"))))
    scopes = near.groupBy("k", "ik", "a", "b").agg(
        F.max(F.col("kind").isin(0, 2, 4)).alias("secret"),
        F.collect_set(F.when(F.col("kind").isin(4, 5), F.struct("kind", "start", "stop"))).alias("weak"),
    ).where("secret")
    own = scopes.where(F.col("ik") == 3).select(
        F.col("k").alias(key), F.col("ik").alias("kind"), F.col("a").alias("start"), F.col("b").alias("stop"))
    others = scopes.select(F.col("k").alias(key), F.explode("weak").alias("w")).select(key, "w.kind", "w.start", "w.stop")
    return own.unionByName(others).distinct()


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: key, ``base`` spans and all ``spans`` (arrays of kind, start, stop).

    Null and empty texts have empty arrays. Rows may repeat and keys may be null: spans are linked within
    a row, never across rows of one key. Columns of ``docs`` other than key and text are not needed.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = candidates(rows).select("key", "found", F.monotonically_increasing_id().alias("row"))
    found = written(found, "secret-candidates")
    base = F.filter("found", lambda s: s["kind"] < 3)
    weak = F.filter("found", lambda s: s["kind"] >= 3)
    some = found.where((F.size(weak) > 0) & F.exists("found", lambda s: s["kind"].isin(1, 3)))
    spans = some.select("row", F.explode("found").alias("s")).select("row", "s.kind", "s.start", "s.stop")
    added = linked(spans, "row", reach).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("added"))
    none = F.array().cast(T.ArrayType(_SPAN))
    return found.join(added, "row", "left").select(
        F.col("key").alias(key), base.alias("base"),
        F.concat(base, F.coalesce(F.col("added"), none)).alias("spans"))


def redact(docs: DataFrame, reach: int = REACH, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` (overlapping spans by one); all rows stay.

    Other columns are untouched but ``n_chars``, which follows the text where the table has it.
    """
    number = free_name(docs.columns, "row")
    marked = written(candidates(docs, text, free_name(docs.columns, "found")).withColumn(number, F.monotonically_increasing_id()), "secret-texts")
    found = marked.columns[len(docs.columns)]
    spans = marked.where(F.size(found) > 0).select(F.col(number).alias("row"), F.explode(found).alias("s")).select("row", "s.kind", "s.start", "s.stop")
    linked_name = free_name(marked.columns, "linked")
    added = linked(spans, "row", reach).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "stop")).alias(linked_name))
    joined = marked.join(added.withColumnRenamed("row", number), number, "left")
    every = F.concat(F.filter(found, lambda s: s["kind"] < 3), F.coalesce(linked_name, F.array().cast(T.ArrayType(_SPAN))))
    joined = joined.withColumn(found, F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))).drop(linked_name, number)
    cut = F.aggregate(
        F.col(found), F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.concat(acc["out"], F.when(s["start"] >= acc["at"], F.concat(
                F.substring(F.col(text), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))).otherwise(F.lit(""))).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(F.col(text), (acc["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    changed = F.size(found) > 0
    out = joined.withColumn(text, F.when(changed, cut).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Near-duplicates by SetSketch registers: banded candidates, joint likelihood, exact verification.

Each text's set of word shingles is reduced to ``BANDS * ROWS`` registers. Register i holds
``floor(1 - log_b(h_i))`` where h_i is the smallest of the set's exponential values under hash i, cut off
to a range: exponentially spaced truncated minima. Registers of a union are the larger registers, so
sketches merge, and equal registers grow likelier with the Jaccard similarity of two sets.

1. Equal sets fall into classes by a fingerprint of the whole set; one representative per class goes on.
2. Representatives with equal registers in a band share a bucket. In the first few bands each is paired
   with its bucket's smallest id: no more pairs than rows, however large the bucket.
3. Pairs whose similarity, estimated jointly with the known set sizes by maximum likelihood, could reach
   the limit are verified on the full shingle sets of the whole texts.
4. Verified links give components. A pair inside a component would change nothing. So from then on, in
   all bands, only buckets that hold several components matter: their rows outside the bucket's first
   component are paired with its smallest row, then with the smallest one among themselves, and in the last
   round with every row of another component, in large families block by block. No cap is set on buckets
   or partners.

A similarity of 0.8 is missed by every band with probability (1 - 0.8^6)^36, about 2 in 100,000, and by
the estimate's margin with less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import lean, pieces, ship, struct_of, written
from tillwatch.llm.textkit import mix, shingle_sets

BANDS, ROWS = 36, 6
REGISTERS = BANDS * ROWS
#: Bands of the first round, which joins most copies of a group at the price of few pairs.
FIRST_BANDS = 4
#: Families of more rows are compared in blocks of so many.
BLOCK = 128
#: Pairs of sketches whose likelihoods a task holds at a time, and shared shingles of two blocks that it holds.
HELD_PAIRS, HELD_SHARED = 1024, 1 << 19
BASE, SCALE = 1.02, 20.0
#: Registers are cut to 0..LIMIT: h down to b^-LIMIT, sets of more than 10^10 shingles.
LIMIT = 1400
#: The estimate has a standard deviation of at most 0.03 at 216 registers; five of them.
MARGIN = 0.15
_RNG = np.random.default_rng(411)
_FACTORS = _RNG.integers(1, 1 << 62, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _RNG.integers(1, 1 << 62, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of one set of 64-bit hashes (of an empty set: zeros)."""
    if not len(shingles):
        return np.zeros(REGISTERS, dtype=np.int16)
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for begin in range(0, len(shingles), 512):
        part = shingles[begin:begin + 512]
        np.minimum(low, (_FACTORS[:, None] * part[None, :]).min(axis=1), out=low)
    uniform = (low.astype(np.float64) + 0.5) / 2.0**64
    h = -np.log1p(-uniform) / SCALE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, LIMIT).astype(np.int16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of a union."""
    return np.maximum(a, b)


def bands(sketches: np.ndarray) -> np.ndarray:
    """(sets, bands): a 64-bit key of the band's number and registers."""
    cells = sketches.reshape(len(sketches), BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    return mix((cells * _BAND_FACTORS[None]).sum(axis=2, dtype=np.uint64)).view(np.int64)


def sketched(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, n_shingles, set_a, set_b, registers, bands) of every row; set_a and set_b name the whole set."""
    schema = struct_of((key, docs.schema[key].dataType), ("n_shingles", T.LongType()), ("set_a", T.LongType()),
                       ("set_b", T.LongType()), ("registers", T.BinaryType()), ("bands", T.ArrayType(T.LongType())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, texts in pieces(batches, text, 1 << 18):
            sets = shingle_sets(texts, size)
            sketches = np.stack([registers(s) for s in sets])
            a = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
            b = np.array([mix(s ^ np.uint64(0xA5A5)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({
                key: part[key].array, "n_shingles": [len(s) for s in sets], "set_a": a, "set_b": b,
                "registers": [s.tobytes() for s in sketches], "bands": list(bands(sketches))})

    ship(docs.sparkSession)
    return docs.select(key, text).mapInPandas(run, schema)


def likeliest(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The Jaccard similarities of maximum likelihood for pairs of sketches whose set sizes are known.

    The counts of registers that are larger, smaller and equal are multinomial; their probabilities follow
    from the shares u, v of the two sizes and the similarity J: P(K_a > K_b) = p(u - vJ), P(K_a < K_b) =
    p(v - uJ) with p(x) = -log_b(1 - x (b - 1) / b).
    """
    larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - larger - smaller
    u = n_a / (n_a + n_b)
    v = 1 - u
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)[:, None]

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    up = np.clip(p(u[:, None] - v[:, None] * grid), 1e-9, 1)
    down = np.clip(p(v[:, None] - u[:, None] * grid), 1e-9, 1)
    same = np.clip(1 - up - down, 1e-9, 1)
    logs = larger[:, None] * np.log(up) + smaller[:, None] * np.log(down) + equal[:, None] * np.log(same)
    return np.take_along_axis(grid, logs.argmax(axis=1)[:, None], axis=1)[:, 0]


def promising(pairs: DataFrame, sketches: DataFrame, key: str, percent: int) -> DataFrame:
    """The pairs (a, b) whose set sizes allow the limit and whose estimate is within the margin of it."""
    own = sketches.select(F.col(key), "n_shingles", "registers")
    sides = [own.select(F.col(key).alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}")) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").where(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    kind = pairs.schema["a"].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in lean(batches):
            for begin in range(0, len(batch), HELD_PAIRS):
                part = batch.iloc[begin:begin + HELD_PAIRS]
                a, b = (np.frombuffer(b"".join(part[f"r_{s}"]), dtype=np.int16).reshape(len(part), -1) for s in "ab")
                found = likeliest(a, b, part["n_a"].to_numpy(float), part["n_b"].to_numpy(float))
                yield part.loc[found >= percent / 100 - MARGIN, ["a", "b"]]

    return both.mapInPandas(run, struct_of(("a", kind), ("b", kind)))


def verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets meet 100 * intersection >= percent * union."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(wanted, "id", "left_semi")
    both = (
        pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    )
    kind = pairs.schema["a"].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_text, held_set = None, None
        for batch in lean(batches):
            good = np.zeros(len(batch), dtype=bool)
            for n, (one, other) in enumerate(zip(batch["text_a"], batch["text_b"], strict=True)):
                if one != held_text:  # the pairs of one hub follow each other
                    held_text, held_set = one, shingle_sets([(one or "").encode("utf-8", "surrogatepass")], size)[0]
                x = shingle_sets([(other or "").encode("utf-8", "surrogatepass")], size)[0]
                shared = len(np.intersect1d(held_set, x, assume_unique=True))
                good[n] = shared > 0 and 100 * shared >= percent * (len(held_set) + len(x) - shared)
            yield batch.loc[good, ["a", "b"]]

    return both.mapInPandas(run, struct_of(("a", kind), ("b", kind))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over the links (a, b), for all ids that have a link.

    Alternates large-star and small-star steps; each step is written, so nothing is recomputed. A node with
    many neighbours is reduced by partial aggregation before its rows meet, and its join can be split.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = written(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = written(small.where("u <> v").distinct(), "small-star")
        after = state(small)
        if after == before:
            return small.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                small.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        edges, before = small, after


def mixed_buckets(own: DataFrame, parts: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(id, component, band) of all rows, and of the rows outside their bucket's first component with it.

    A bucket's first component is the one with the smallest id, its hub that component's smallest row in it.
    """
    at = own.join(parts, own[key] == parts["id"], "left").select(
        own[key].alias("id"), F.coalesce("component", own[key]).alias("component"), F.explode("bands").alias("band"))
    mixed = at.groupBy("band").agg(F.min(F.struct("component", "id")).alias("low"), F.max("component").alias("last"))
    mixed = mixed.where(F.col("low.component") != F.col("last")).select(
        "band", F.col("low.component").alias("first"), F.col("low.id").alias("hub"))
    return at, at.join(mixed, "band").where(F.col("component") != F.col("first"))


def star_pairs(outside: DataFrame, step: str) -> DataFrame:
    """Pairs (a, b): ``first`` joins the outside rows with their hub, ``second`` with the smallest of them."""
    if step == "first":
        pairs = outside.select(F.col("hub").alias("x"), F.col("id").alias("y"))
    else:
        hub = outside.groupBy("band").agg(F.min(F.struct("component", "id")).alias("h")).select(
            F.col("band"), F.col("h.id").alias("x"), F.col("h.component").alias("c"))
        pairs = outside.join(hub, "band").where(F.col("c") != F.col("component")).select("x", F.col("id").alias("y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def family_sizes(outside: DataFrame, parts: DataFrame) -> DataFrame:
    """(first, n) for every first component: its rows and those outside of it that share a bucket with it."""
    n_in = parts.groupBy(F.col("component").alias("first")).agg(F.count("*").alias("n_in"))
    n_out = outside.groupBy("first").agg(F.count_distinct("id").alias("n_out"))
    return n_out.join(n_in, "first", "left").select("first", (F.col("n_out") + F.coalesce("n_in", F.lit(1))).alias("n"))


def row_pairs(at: DataFrame, outside: DataFrame) -> DataFrame:
    """Every pair (a, b) of an outside row and a row of another component in one bucket."""
    ours = outside.select("band", F.col("id").alias("x"), F.col("component").alias("c"), "first")
    theirs = at.select("band", F.col("id").alias("y"), F.col("component").alias("d"))
    pairs = ours.join(theirs, "band").where("c <> d and (d = first or x < y)")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def shared_counts(wanted: np.ndarray, owner_x: np.ndarray, n_x: int, values: np.ndarray, owner_y: np.ndarray, n_y: int) -> np.ndarray:
    """(sets x, sets y): how many shingles two sets share; ``wanted`` and ``values`` are the sets' shingles, with their owners.

    A shingle of ``wanted`` stands once for every set y that holds it, so few of them are taken at a time.
    """
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owner_y[order]
    low, high = np.searchsorted(values, wanted), np.searchsorted(values, wanted, side="right")
    ends = np.cumsum(high - low)
    shared, begin = np.zeros(n_x * n_y, dtype=np.int64), 0
    while begin < len(wanted):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + HELD_SHARED, side="right")))
        first, count = low[begin:end], high[begin:end] - low[begin:end]
        place = np.repeat(first - (ends[begin:end] - count - before), count) + np.arange(count.sum())
        shared += np.bincount(np.repeat(owner_x[begin:end], count) * n_y + owners[place], minlength=n_x * n_y)
        begin = end
    return shared.reshape(n_x, n_y)


def block_links(outside: DataFrame, parts: DataFrame, big: DataFrame, docs: DataFrame, key: str, text: str, size: int,
                percent: int) -> DataFrame:
    """Verified links (a, b) of the outside rows of large families with any of the family's rows.

    A family's rows are dealt into blocks of about ``BLOCK``, and a task compares two blocks at a time by
    counting shared shingles from one sorted list; no row stands for a pair of texts.
    """
    outs = outside.join(big, "first").select("first", "id", F.lit(1).alias("out")).distinct()
    ins = parts.select(F.col("component").alias("first"), "id").unionByName(
        outs.select("first", F.col("first").alias("id")).distinct()).distinct().join(big, "first", "left_semi")
    rows = outs.unionByName(ins.withColumn("out", F.lit(0))).join(big, "first")
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    block = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / F.lit(BLOCK)).cast("long"))
    blocks = rows.join(texts, "id").groupBy("first", block.alias("block")).agg(
        F.collect_list(F.struct("id", "out", "text")).alias("rows"), F.max("out").alias("any"))
    blocks = written(blocks, "blocks")
    both = blocks.select("first", F.col("block").alias("x"), F.col("rows").alias("rows_x"), F.col("any").alias("any_x")).join(
        blocks.select("first", F.col("block").alias("y"), F.col("rows").alias("rows_y"), F.col("any").alias("any_y")), "first"
    ).where("x <= y and any_x + any_y > 0").select("rows_x", "rows_y")
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in lean(batches):
            found: set[tuple] = set()
            for one, other in zip(batch["rows_x"], batch["rows_y"], strict=True):
                sides = []
                for side in (one, other):
                    sets = shingle_sets([(r["text"] or "").encode("utf-8", "surrogatepass") for r in side], size)
                    sides.append((sets, np.array([len(s) for s in sets]), np.repeat(np.arange(len(side)), [len(s) for s in sets])))
                (sets_x, n_x, owner_x), (sets_y, n_y, owner_y) = sides
                shared = shared_counts(np.concatenate(sets_x), owner_x, len(n_x), np.concatenate(sets_y), owner_y, len(n_y))
                for x, y in np.argwhere(100 * shared >= percent * (n_x[:, None] + n_y[None, :] - shared)).tolist():
                    if shared[x, y] and one[x]["id"] != other[y]["id"] and one[x]["out"] + other[y]["out"]:
                        found.add(tuple(sorted((one[x]["id"], other[y]["id"]))))
            yield pd.DataFrame(sorted(found), columns=["a", "b"])

    return both.mapInPandas(run, struct_of(("a", kind), ("b", kind))).distinct()


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row of ``docs``.

    Rows are linked if 100 * intersection >= percent * union of their sets of ``size``-word shingles;
    component_id is the smallest key reachable, kept says that it is the row's own. Texts without words
    (null, empty, blank) are linked with nothing. Rows of one key count as one node with all their
    texts' links. Rows without a key take part through equal sets alone: theirs is the component of their
    equals, or null, and a row with a null component is kept. Other columns are not read.
    """
    docs = docs.select(key, text)
    sketches = written(sketched(docs, key, text, size), "sketches")
    filled = sketches.where("n_shingles > 0")
    classes = filled.groupBy("set_a", "set_b", "n_shingles").agg(F.min(key).alias("rep"))
    membership = written(filled.select(key, "set_a", "set_b", "n_shingles").join(classes, ["set_a", "set_b", "n_shingles"]).select(key, "rep", "n_shingles"), "classes")
    # a key with several texts belongs to several classes: its node ties them
    several = membership.groupBy(key).agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a <> last")
    ties = membership.join(several, key).select("a", F.col("rep").alias("b"))
    own = filled.join(membership.where(F.col(key) == F.col("rep")).select(key).distinct(), key, "left_semi")
    own = written(own.dropDuplicates([key, "set_a", "set_b"]).select(key, "n_shingles", "registers", "bands"), "representatives")
    cells = own.select(F.col(key).alias("id"), F.explode(F.slice("bands", 1, FIRST_BANDS)).alias("band"))
    hubs = cells.groupBy("band").agg(F.min("id").alias("hub"))
    pairs = cells.join(hubs, "band").where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b"))

    def checked(pairs: DataFrame) -> DataFrame:
        return verified(written(promising(pairs.distinct(), own, key, percent), "candidates"), docs, key, text, size, percent)

    links = written(checked(pairs), "verified")
    parts = written(components(links), "components")
    for step in ("first", "second"):
        outside = written(mixed_buckets(own, parts, key)[1], "outside")
        links = written(links.unionByName(checked(star_pairs(outside, step))), "verified")
        parts = written(components(links), "components")
    at, outside = mixed_buckets(own, parts, key)
    outside = written(outside, "outside")
    big = written(family_sizes(outside, parts).where(F.col("n") > BLOCK), "families")
    more = checked(row_pairs(at, outside.join(big, "first", "left_anti")))
    more = more.unionByName(block_links(outside, parts, big, docs, key, text, size, percent))
    links = written(links.unionByName(more), "verified")
    parts = written(components(links), "components")
    if not ties.isEmpty():
        parts = components(links.unionByName(ties))
    placed = membership.join(parts.withColumnRenamed("id", "rep"), "rep", "left").select(
        key, "n_shingles", F.coalesce("component", "rep").alias("component"))
    rest = sketches.where("n_shingles = 0").select(key, "n_shingles", F.col(key).alias("component"))
    same = F.coalesce(F.col(key) == F.col("component"), F.col("component").isNull())
    return placed.unionByName(rest).select(key, "n_shingles", F.col("component").alias("component_id"), same.alias("kept"))

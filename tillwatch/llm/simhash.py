"""Near-duplicates by SimHash fingerprints and a hierarchical index in Gray order.

A text's fingerprint has 64 bits; a bit is 1 if it is set in more than half of its shingles' hashes. Texts of equal
fingerprint form a class, and classes are linked when their fingerprints differ in at most three bits.

The index is a tree of masked patterns. Bits that all members of a node share are written once, in the node:

* Its upper nodes are rows of a table. Of four blocks of bits, two fingerprints that differ in three bits share
  one whole block, so each fingerprint stands below one node for every block, its mask the block and its pattern the
  bits there. A node with more than ``LIMIT`` members is parted again by four blocks of its free bits, level by level, so
  no group reaches a task whole, however alike the texts are; distinct fingerprints run out of free bits at the latest.
* Below a node its fingerprints are sorted by their rank in the Gray code, in which neighbours share most bits. Runs
  of them form leaves, runs of leaves inner nodes, each with the mask and pattern of what its members share. The search
  goes down from the root in pairs of nodes and drops a pair as soon as their shared bits differ in more than three.

Links inside a node are reduced to a star per connected set before they leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from tillwatch.llm.common import pieces, ship, struct_of, written
from tillwatch.llm.neardup import components

SEED, SHINGLE, BITS = 42, 3, 64
#: Fingerprints of one node that a task compares; larger nodes are parted.
LIMIT = 4096
#: Fingerprints of a leaf, and children of an inner node.
LEAF, FAN = 16, 4
#: Pairs that one numpy pass compares.
PAIRS = 1 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_TOP = np.uint64(1 << 63)


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``size`` words joined by spaces, repeats included; of fewer words the whole sequence."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-size] + 1))
    found = (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist(), strict=True))
    return np.fromiter(found, dtype=np.uint64, count=len(starts))


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The majority of the shingles' hashes, bit by bit; 0 without words."""
    hashes = shingle_hashes(text, size)
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = hashes[k:k + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > len(hashes)).tolist())


def fingerprints(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, fingerprint) of every row, the fingerprint's bits as a signed number."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, texts in pieces(batches, text):
            found = np.array([fingerprint(t, size) for t in texts], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({key: part[key].array, "fingerprint": found})

    ship(docs.sparkSession)
    return docs.select(key, text).mapInPandas(run, struct_of((key, docs.schema[key].dataType), ("fingerprint", T.LongType())))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each 64-bit number in the reflected Gray code."""
    rank = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def parted(mask: int, parts: int) -> list[int]:
    """The free bits of ``mask`` in ``parts`` blocks of about the same size, each joined to the mask."""
    free = [bit for bit in range(BITS) if not mask >> bit & 1]
    cuts = [len(free) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << bit for bit in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each connected set after the links (i, j) are added to sets named by ``labels``."""
    while len(i):
        low, high = np.minimum(labels[i], labels[j]), np.maximum(labels[i], labels[j])
        np.minimum.at(labels, high, low)
        while not np.array_equal(further := labels[labels], labels):
            labels = further
        left = labels[i] != labels[j]
        i, j = i[left], j[left]
    return labels


class GrayIndex:
    """The tree over fingerprints in Gray order: ``levels[0]`` the leaves, each level's masks, patterns and bounds."""

    def __init__(self, prints: np.ndarray):
        self.order = np.argsort(gray_rank(prints), kind="stable")
        self.prints = prints[self.order]
        ones, zeros, size = self.prints, ~self.prints, LEAF
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (mask of the shared bits, their pattern)
        while True:
            starts = np.arange(0, len(ones), size)
            ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)
            self.levels.append((ones | zeros, ones))
            if len(ones) == 1:
                return
            size = FAN

    def leaf_pairs(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of leaves (u <= v) whose shared bits differ in at most ``most`` places, all their ancestors' too."""
        u = v = np.zeros(1, dtype=np.int64)
        for mask, pattern in reversed(self.levels[:-1]):
            steps = np.arange(FAN)
            x = np.broadcast_to((u * FAN)[:, None, None] + steps[:, None], (len(u), FAN, FAN)).reshape(-1)
            y = np.broadcast_to((v * FAN)[:, None, None] + steps[None, :], (len(u), FAN, FAN)).reshape(-1)
            real = (x <= y) & (y < len(mask))
            x, y = x[real], y[real]
            near = np.bitwise_count((pattern[x] ^ pattern[y]) & mask[x] & mask[y]) <= most
            u, v = x[near], y[near]
        return u, v

    def connected(self, most: int) -> np.ndarray:
        """For every fingerprint (as given) the place of a fixed member of its set, over links of ``most`` bits."""
        n = len(self.prints)
        labels = np.arange(n)
        u, v = self.leaf_pairs(most)
        step = max(PAIRS // (LEAF * LEAF), 1)
        inside = np.arange(LEAF)
        for k in range(0, len(u), step):
            i = np.broadcast_to((u[k:k + step] * LEAF)[:, None, None] + inside[:, None], (len(u[k:k + step]), LEAF, LEAF)).reshape(-1)
            j = np.broadcast_to((v[k:k + step] * LEAF)[:, None, None] + inside[None, :], (len(u[k:k + step]), LEAF, LEAF)).reshape(-1)
            real = (i < j) & (j < n)
            i, j = i[real], j[real]
            open_pairs = labels[i] != labels[j]
            i, j = i[open_pairs], j[open_pairs]
            near = np.bitwise_count(self.prints[i] ^ self.prints[j]) <= most
            labels = joined(labels, i[near], j[near])
        out = np.empty(n, dtype=np.int64)
        out[self.order] = self.order[labels]
        return out


def small_groups(prints: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """As ``GrayIndex.connected``, for many groups that are a single leaf each, next to each other."""
    labels = np.arange(len(prints))
    for lag in range(1, LEAF):
        i = np.flatnonzero(group[:-lag] == group[lag:])
        if not len(i):
            break
        near = i[np.bitwise_count(prints[i] ^ prints[i + lag]) <= most]
        labels = joined(labels, near, near + lag)
    return labels


def searched(nodes: DataFrame, most: int) -> DataFrame:
    """Links (a, b) of the members of each node (mask, pattern), a star per connected set."""
    dealt = nodes.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
    kind = nodes.schema["rep"].dataType

    def links(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        prints = rows["fingerprint"].to_numpy(np.int64).view(np.uint64)
        bounds = np.append(starts, len(rows))
        sizes = np.diff(bounds)
        group = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(rows))
        small = np.flatnonzero((sizes <= LEAF)[group] & (sizes > 1)[group])
        if len(small):
            place[small] = small[small_groups(prints[small], group[small], most)]
        for g in np.flatnonzero(sizes > LEAF).tolist():
            a, b = bounds[g], bounds[g + 1]
            place[a:b] = a + GrayIndex(prints[a:b]).connected(most)
        moved = np.flatnonzero(place != np.arange(len(rows)))
        reps = rows["rep"].array
        return pd.DataFrame({"a": reps[place[moved]], "b": reps[moved]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the last node's rows so far; a node has at most LIMIT
        for batch in batches:
            if not len(batch):
                continue
            rows = pd.concat([*held, batch], ignore_index=True) if held else batch.reset_index(drop=True)
            mask, pattern = rows["mask"].to_numpy(), rows["pattern"].to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1]))))
            last = int(starts[-1])
            held = [rows.iloc[last:]]
            if last:
                yield links(rows.iloc[:last], starts[:-1])
        if held:
            yield links(held[0].reset_index(drop=True), np.zeros(1, dtype=np.int64))

    return dealt.mapInPandas(run, struct_of(("a", kind), ("b", kind)))


def linked(classes: DataFrame, most: int = 3, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) between the representatives of classes (fingerprint, rep), enough to connect all that are near.

    Goes down the index level by level. A node of more than ``limit`` members is never searched but parted.
    """
    found: list[DataFrame] = []
    masks = parted(0, most + 1)
    rows = classes.select("fingerprint", "rep", F.explode(F.array(*[F.lit(signed(m)) for m in masks])).alias("mask"))
    while True:
        nodes = rows.select("fingerprint", "rep", "mask", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("pattern"))
        large = written(nodes.groupBy("mask", "pattern").count().where(F.col("count") > limit).select("mask", "pattern"), "large-nodes")
        if large.isEmpty():
            found.append(written(searched(nodes, most), "node-links"))
            break
        found.append(written(searched(nodes.join(large, ["mask", "pattern"], "left_anti"), most), "node-links"))
        children = {m: parted(m, most + 1) for m in masks}
        masks = sorted({c for below in children.values() for c in below})
        below = F.create_map(*[x for m, c in children.items() for x in (
            F.lit(signed(m)), F.array(*[F.lit(signed(child)) for child in c]))])
        deeper = nodes.join(large, ["mask", "pattern"], "left_semi")
        rows = written(deeper.select("fingerprint", "rep", F.explode(F.element_at(below, F.col("mask"))).alias("mask")), "nodes")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, most: int = 3,
                    limit: int = LIMIT) -> DataFrame:
    """(key, fingerprint, component_id) of every row of ``docs``, the fingerprint as 16 lowercase hex digits.

    Rows are linked if their fingerprints differ in at most ``most`` bits; component_id is the smallest key reachable.
    Texts without words (null, empty, blank) have fingerprint zero and are linked like any other. Rows
    of one key are one node with all their texts' links. Rows without a key link nothing; theirs is the component of
    rows of equal fingerprint, or null. Repeated rows each have a row. Other columns are not read.
    """
    prints = written(fingerprints(docs, key, text, size), "fingerprints")
    classes = written(prints.groupBy("fingerprint").agg(F.min(key).alias("rep")), "fingerprint-classes")
    links = linked(classes.where("rep is not null"), most, limit)
    several = prints.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("fingerprint").alias("one"), F.max("fingerprint").alias("other")).where("one <> other")
    if not several.isEmpty():
        own = prints.join(several.select(key), key, "left_semi").join(classes, "fingerprint")
        links = links.unionByName(own.select(F.col("rep").alias("a"), F.col(key).alias("b")).where("a <> b"))
    parts = written(components(links), "components")
    placed = classes.join(parts, classes["rep"] == parts["id"], "left").select(
        "fingerprint", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(written(placed, "placed"), "fingerprint").select(
        key, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")

"""Benchmark decontamination by latent semantic retrieval.

Benchmark items, long ones in passages, are TF-IDF vectors over their own words, with document frequencies counted over all
documents. A randomised singular value decomposition, whose products with the matrix are Spark jobs over
the item rows, gives the latent space of a block of passages. It has a dimension per passage, so that none
loses a part of its norm in it, and blocks are small. Every document is cut into overlapping windows of three lengths;
a window's latent vector is a sum of word vectors. Words are lowered runs between ASCII punctuation
and white space, so shouting and scattered marks hide nothing. Windows near an item in the latent space are candidates; the longest
common subsequence of the item's words and the words around the window decides, with a weaker limit where
the item's answer (its last words) stands there as well.

Before the search an exact bound is taken: a text is searched for the items that could pass that decision by the words
they share with a stretch of the text, or whose answer stands in it. Other items would be refused at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import free_name, pieces, ship, struct_of, written
from tillwatch.llm.textkit import IS_BREAK, Lookup, mix, words_of

STEP = 8
#: Windows in steps of eight words: the lengths cover short items and the middle of long ones.
WINDOWS = (2, 4, 7)
ANSWER_WORDS = 5
SHARE = 0.7
#: Items of more words are cut into equal passages, for a window holds little of a long item's norm.
PASSAGE = 64
_ITEM = struct_of(("item_id", T.LongType()), ("words", T.ArrayType(T.LongType())))


@dataclass
class Index:
    """The latent space of one block of items.

    terms: sorted word hashes; weights: their idf; space: (terms, dims) right singular vectors;
    items: (passages, dims) unit vectors; owner: the item of each passage, as its place in ids and words,
    which hold whole items.
    """

    terms: np.ndarray
    weights: np.ndarray
    space: np.ndarray
    items: np.ndarray
    owner: np.ndarray
    ids: list[int]
    words: list[np.ndarray]
    near: float
    share: float
    share_with_answer: float
    lookup: Lookup | None = None
    masks: list[dict[int, int]] | None = None
    rows: np.ndarray | None = None  # the items' rows in the whole benchmark
    member: np.ndarray | None = None  # (items, terms + 1): which terms an item holds
    complete: np.ndarray | None = None  # whether all of an item's passages are in this block


def item_words(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, words): the word hashes of every item with words, in order; null ids are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, texts in pieces(batches, text, lower=True):
            found = words_of(texts, IS_BREAK)
            words = found.words().view(np.int64)
            yield pd.DataFrame({"item_id": part[key].to_numpy(), "words": [
                words[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]})

    ship(benchmark.sparkSession)
    rows = benchmark.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias(key), text)
    return rows.mapInPandas(run, _ITEM).where(F.size("words") > 0)


def passages_of(items: DataFrame) -> DataFrame:
    """(row, part, words): every item in as few passages of about equal length as ``PASSAGE`` words allow."""
    n, parts = F.size("words"), F.ceil(F.size("words") / F.lit(PASSAGE)).cast("int")
    return items.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select("row", "part", F.slice(
        "words", F.floor(F.col("part") * n / parts).cast("int") + 1,
        (F.floor((F.col("part") + 1) * n / parts) - F.floor(F.col("part") * n / parts)).cast("int")).alias("words"))


def document_counts(docs: DataFrame, terms: np.ndarray, text: str) -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, over all documents, and how many documents there are."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup, count, rows = Lookup(shared.value), np.zeros(len(shared.value) + 1, np.int64), 0
        for _, texts in pieces(batches, text, 1 << 18, lower=True):
            found = words_of(texts, IS_BREAK)
            place = lookup(found.words())
            known = place < len(shared.value)
            pairs = np.unique(found.text_of()[known] * len(count) + place[known])
            count += np.bincount(pairs % len(count), minlength=len(count))
            rows += len(texts)
        used = np.flatnonzero(count)
        yield pd.DataFrame({"term": np.append(used, -1), "n": np.append(count[used], rows)})

    ship(docs.sparkSession)
    sums = docs.select(text).mapInPandas(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(len(terms) + 1, np.int64)
    shared.destroy()
    for row in sums:
        found[row["term"]] = row["n"]
    return found[:-1], int(found[-1])


def idf(count: np.ndarray, n: int) -> np.ndarray:
    """Smooth and at least 1: a passage that most rows hold, as copies do, keeps its weight among its words."""
    return np.log((n + 1) / (count + 1)) + 1.0


def latent_space(items: DataFrame, terms: np.ndarray, weights: np.ndarray, dims: int, rounds: int = 2) -> np.ndarray:
    """The leading right singular vectors (terms, dims) of the items' TF-IDF rows.

    Each product with the matrix's transpose and the matrix is one job: a task sums its rows' outer
    products per term, and the sums are added by term. The driver holds (terms, dims) only.
    """
    spark = items.sparkSession
    rng = np.random.default_rng(23)
    width = min(dims + 16, len(terms))
    basis = rng.normal(size=(len(terms), width))
    for _ in range(rounds):
        basis, _ = np.linalg.qr(basis)
        shared = spark.sparkContext.broadcast((terms, weights, basis))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            keys, idf, q = shared.value  # noqa: B023 - used before the next round
            lookup, total = Lookup(keys), {}
            for batch in batches:
                for words in batch["words"]:
                    place, tf = np.unique(lookup(np.asarray(words, dtype=np.int64).view(np.uint64)), return_counts=True)
                    row = tf * idf[place]
                    norm = np.linalg.norm(row)
                    if norm > 0:
                        row = row / norm
                        image = row @ q[place]
                        for p, x in zip(place[row > 0].tolist(), row[row > 0].tolist(), strict=True):
                            total[p] = total.get(p, 0) + x * image
            if total:
                yield pd.DataFrame({"term": list(total), "sums": [v.tolist() for v in total.values()]})

        partial = items.mapInPandas(run, "term int, sums array<double>")
        added = partial.groupBy("term").agg(F.collect_list("sums").alias("parts")).select("term", F.aggregate(
            "parts", F.array_repeat(F.lit(0.0), width), lambda a, b: F.zip_with(a, b, lambda x, y: x + y)).alias("sums"))
        fresh = np.zeros_like(basis)
        for row in added.toLocalIterator():
            fresh[row["term"]] = row["sums"]
        shared.destroy()
        image, basis = basis.T @ fresh, fresh  # the space's own quadratic form, then its image
    basis, _ = np.linalg.qr(basis)
    values, turned = np.linalg.eigh((image + image.T) / 2)
    kept = np.argsort(-values)[:dims]
    return (basis @ turned[:, kept]).astype(np.float32) if basis.shape[1] == turned.shape[0] else basis[:, :dims].astype(np.float32)


def fit(passages: DataFrame, rows: list, whole: dict, weight_of: tuple[np.ndarray, np.ndarray], dims: int | None = None,
        near: float = 0.42, share: float = SHARE, share_with_answer: float = 0.5) -> Index:
    """The index of one block of passages; its size is that of the block, whatever the number of documents.

    rows: the rows of ``passages``; whole: (id, words) of the items by row; weight_of: sorted word hashes, the
    block's among them, and their idf. dims: by default one per passage, with which the space is exact.
    """
    words = [np.array(r["words"], dtype=np.int64).view(np.uint64) for r in rows]
    terms = np.unique(np.concatenate(words))
    weights = np.append(weight_of[1][np.searchsorted(weight_of[0], terms)], 0.0)
    space = latent_space(passages, terms, weights, dims or len(words))
    space = np.concatenate([space, np.zeros((1, space.shape[1]), np.float32)])
    lookup = Lookup(terms)
    vectors = np.zeros((len(words), space.shape[1]), np.float32)
    for n_item, own in enumerate(words):
        place = lookup(own)
        vectors[n_item] = weights[place] @ space[place]
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    owners, owner = np.unique([r["row"] for r in rows], return_inverse=True)
    return Index(terms, weights, (space * weights[:, None]).astype(np.float32), vectors, owner, *map(list, zip(
        *(whole[n] for n in owners.tolist()), strict=True)), near, share, share_with_answer, rows=owners)


class Bound:
    """The items that enough of their rarest words occur in a stretch for.

    An item with ``share`` of its n words in order lacks u = n - share * n of them at most, so that of any s of its words
    s - u occur. The s rarest are taken, for they have few postings; repeated words count as often as the item has them.
    """

    def __init__(self, items: list[np.ndarray], numbers: list[int], weight_of: tuple[np.ndarray, np.ndarray], share: float):
        self.numbers, self.need = np.array(numbers, dtype=np.int64), np.zeros(len(numbers), np.int64)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k, number in enumerate(numbers):
            own = items[number]
            lacking = len(own) - int(np.ceil(share * len(own) - 1e-9))
            rarest = min(len(own), lacking + -(-len(own) // 3))
            order = np.argsort(-weight_of[1][np.searchsorted(weight_of[0], own)], kind="stable")[:rarest]
            words, times = np.unique(own[order], return_counts=True)
            held.append((words, np.full(len(words), k), times))
            self.need[k] = rarest - lacking
        words, item, times = (np.concatenate(column) for column in zip(*held, strict=True))
        order = np.argsort(words, kind="stable")
        self.terms, self.first = np.unique(words[order], return_index=True)
        self.first = np.append(self.first, len(words))
        self.item, self.times = item[order], times[order]
        self.lookup: Lookup | None = None

    def __call__(self, word: np.ndarray, text: np.ndarray, first: np.ndarray, span: int | None) -> np.ndarray:
        """(text, item number) of the items whose bound is met in a stretch of ``span`` words, or in a whole text.

        Stretches are two spans long and begin at every span, so that any ``span`` words lie in one.
        """
        if self.lookup is None:
            self.lookup = Lookup(self.terms)
        place = self.lookup(word)
        known = np.flatnonzero(place < len(self.terms))
        place, text_of_known = place[known].astype(np.int64), text[known]
        owner = np.arange(len(first) - 1)
        if span is None:
            pairs = text_of_known * len(self.terms) + place
        else:
            many = np.maximum(-(-np.diff(first) // span) - 1, 1)
            begin, owner = np.cumsum(many) - many, np.repeat(owner, many)
            part, last = (known - first[text_of_known]) // span, many[text_of_known] - 1
            pairs = np.concatenate([(begin[text_of_known] + np.minimum(part, last)) * len(self.terms) + place,
                                    (begin[text_of_known] + np.maximum(part - 1, 0)) * len(self.terms) + place])
        stretch, term = np.divmod(np.unique(pairs), len(self.terms))
        step = max(1, (1 << 22) // max(len(self.item), len(self.need)))
        found = [np.zeros((0, 2), np.int64)]
        for at in range(0, len(owner), step):
            low, high = np.searchsorted(stretch, (at, at + step))
            own = term[low:high]
            count = self.first[own + 1] - self.first[own]
            posting = np.repeat(self.first[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            n = min(step, len(owner) - at)
            met = np.bincount(np.repeat(stretch[low:high] - at, count) * len(self.need) + self.item[posting],
                              self.times[posting], n * len(self.need)).reshape(n, -1) >= self.need
            where, item = np.nonzero(met)
            found.append(np.stack([owner[at + where], self.numbers[item]], axis=1))
        return np.concatenate(found)


class Screen:
    """Which items the texts could hold: all that ``leaks`` would confirm, and few more.

    An item is confirmed with ``share`` of its words in order in a stretch of at most six times its length and 64 words
    (``merged`` and the reach on both sides), or with fewer where its answer stands in the text.
    """

    def __init__(self, rows: list[int], items: list[np.ndarray], weight_of: tuple[np.ndarray, np.ndarray], share: float = SHARE):
        self.rows = np.array(rows, dtype=np.int64)
        self.bounds = []
        for span, numbers in ((6 * PASSAGE + 64, [k for k, own in enumerate(items) if len(own) <= PASSAGE]),
                              (None, [k for k, own in enumerate(items) if len(own) > PASSAGE])):
            if numbers:
                self.bounds.append((span, Bound(items, numbers, weight_of, share)))
        self.answers = []
        for length in sorted({min(len(own), ANSWER_WORDS) for own in items}):
            numbers = np.array([k for k, own in enumerate(items) if min(len(own), ANSWER_WORDS) == length])
            hashes = np.concatenate([runs(items[k][-length:], length) for k in numbers])
            order = np.argsort(hashes, kind="stable")
            keys, first = np.unique(hashes[order], return_index=True)
            self.answers.append([length, keys, np.append(first, len(order)), numbers[order], None])

    def __call__(self, found) -> np.ndarray:
        """(text, item number) in order, once each; an item's number is its place in ``rows``."""
        word, text = found.words(), found.text_of()
        pairs = [np.zeros((0, 2), np.int64), *(bound(word, text, found.first, span) for span, bound in self.bounds)]
        for answer in self.answers:
            length, keys, first, numbers, lookup = answer
            if lookup is None:
                lookup = answer[-1] = Lookup(keys)
            place = lookup(runs(word, length))
            at = np.flatnonzero(place < len(keys))
            for t, p in {(t, p) for t, p in zip(text[at].tolist(), place[at].tolist(), strict=True)}:
                pairs.append(np.stack([np.full(first[p + 1] - first[p], t), numbers[first[p]:first[p + 1]]], axis=1))
        text, item = np.concatenate(pairs).T
        return np.stack(np.divmod(np.unique(text * len(self.rows) + item), max(len(self.rows), 1)), axis=1)


def runs(word: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` words that follow each other."""
    n = max(len(word) - length + 1, 0)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        rolled += word[k:n + k] * np.uint64(2 * pow(7919, k + 1, 1 << 62) + 1)
    return mix(rolled)


def bits_of(item: np.ndarray) -> dict[int, int]:
    """For each word of an item one bit per place where it stands."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | (1 << k)
    return masks


def common_subsequence(masks: dict[int, int], n: int, words: np.ndarray, least: int = 0) -> int:
    """Length of the longest common subsequence of an item of ``n`` words with others, one bit per word.

    0 where fewer than ``least`` of the item's words occur at all: no more can be in order.
    """
    found = [masks[w] for w in words.tolist() if w in masks]
    there = 0
    for mask in found:
        there |= mask
    if there.bit_count() < least:
        return 0
    full = (1 << n) - 1
    state = full
    for mask in found:
        used = state & mask
        state = ((state + used) | (state - used)) & full
    return n - state.bit_count()


def stands_in(answer: np.ndarray, words: np.ndarray) -> bool:
    n = len(answer)
    if not 0 < n <= len(words):
        return False
    return bool(np.lib.stride_tricks.sliding_window_view(words, n).__eq__(answer).all(axis=1).any())


def candidates(index: Index, found, place: np.ndarray, possible: np.ndarray | None = None) -> np.ndarray:
    """(text, item, first, last) in order: spans of word numbers whose windows are near a passage of the item.

    place: the words' places among the index's terms; possible: (texts, items), the items to search a text for (all).
    """
    known = np.flatnonzero(index.weights[place] > 0)
    if not len(known):
        return np.zeros((0, 4), np.int64)
    text = found.text_of()[known]
    own = known - found.first[text]
    steps = -(-np.diff(found.first) // STEP) + 2 * max(WINDOWS)  # empty steps before and after
    offset = np.concatenate(([0], np.cumsum(steps)))
    cell = offset[text] + own // STEP + (max(WINDOWS) - 1)
    cells, start = np.unique(cell, return_index=True)
    vectors = np.zeros((len(cells) + 1, index.space.shape[1]))
    np.cumsum(np.add.reduceat(index.space.take(place[known], axis=0), start, axis=0), axis=0, dtype=np.float64, out=vectors[1:])
    out: list[np.ndarray] = []
    for width in WINDOWS:
        # the longest windows begin at every other step; the empty steps keep texts apart
        stride = max(1, width // 3)
        begins = (cells // stride)[:, None] - np.arange(-(-width // stride))
        begins = np.unique(begins.ravel()) * stride
        low, high = np.searchsorted(cells, begins), np.searchsorted(cells, begins + width)
        begins, low, high = begins[low < high], low[low < high], high[low < high]
        for at in range(0, len(begins), 8192):
            part = slice(at, at + 8192)
            window = (vectors[high[part]] - vectors[low[part]]).astype(np.float32)
            length = np.linalg.norm(window, axis=1)
            cosine = window @ index.items.T
            n, item = np.divmod(np.flatnonzero(cosine >= index.near * np.maximum(length, 1e-9)[:, None]), cosine.shape[1])
            t = text[start[low[part][n]]]
            if possible is not None:
                wanted = np.flatnonzero(possible[t, index.owner[item]])
                n, item, t = n[wanted], item[wanted], t[wanted]
            first = (begins[part][n] - offset[t] - (max(WINDOWS) - 1)) * STEP
            out.append(np.stack([t, index.owner[item], first, first + width * STEP], axis=1))
    every = np.concatenate(out)
    return every[np.lexsort(every.T[::-1])]


def merged(index: Index, spans: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """The spans of one text and item as one where the item reaches from one to the next."""
    held = None
    for t, item, a, b in spans.tolist():
        if held and held[0] == t and held[1] == item and a <= held[3] + reach and b - held[2] <= 4 * reach + 64:
            held[3] = max(held[3], b)
        else:
            if held:
                yield tuple(held)
            held, reach = [t, item, a, b], len(index.words[item])
    if held:
        yield tuple(held)


def leaks(index: Index, texts: list[bytes], possible: np.ndarray | None = None, found=None) -> list[dict[int, float]]:
    """For each text the items found in it, with the largest share of the item's words in order.

    possible: (texts, items of the index), the items to search a text for; by default all. found: the texts' words, if known.
    """
    if index.lookup is None:
        index.lookup, index.masks = Lookup(index.terms), [bits_of(own) for own in index.words]
        index.member = np.zeros((len(index.words), len(index.terms) + 1), bool)
        for n, own in enumerate(index.words):
            index.member[n, index.lookup(own)] = True
        index.complete = ~index.member[:, -1]
    found = found or words_of(texts, IS_BREAK)
    word = found.words()
    if possible is None:
        place = index.lookup(word).astype(np.intp)
    else:  # windows lie as they would among all texts
        place, searched = np.full(len(word), len(index.terms)), possible.any(axis=1)[found.text_of()]
        place[searched] = index.lookup(word[searched])
    bounds = found.first.tolist()
    out: list[dict[int, float]] = [{} for _ in texts]
    for t, item, a, b in merged(index, candidates(index, found, place, possible)):
        own, first, last = index.words[item], bounds[t], bounds[t + 1]
        reach = len(own)
        part = slice(max(first + a - reach, first), min(first + b + reach, last))
        least = min(index.share, index.share_with_answer) * len(own)
        near = word[part]
        if index.complete[item]:
            inside = index.member[item].take(place[part])
            if np.count_nonzero(inside) < least:  # no more can be in order
                continue
            share = common_subsequence(index.masks[item], len(own), near[inside], least) / len(own)
        else:
            share = common_subsequence(index.masks[item], len(own), near, least) / len(own)
        answer = own[-ANSWER_WORDS:]
        if share >= index.share or (share >= index.share_with_answer and stands_in(answer, near)):
            out[t][index.ids[item]] = max(out[t].get(index.ids[item], 0.0), share)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", items_name: str = "items",
                  share_name: str = "share", block_items: int = 128, **options) -> DataFrame:
    """All columns of ``docs`` with the ids of the benchmark items found (sorted) and the largest share.

    An item is found where a latent candidate's surroundings hold at least ``share`` of its words in
    order, or ``share_with_answer`` and its last words in one piece. Whole texts are searched; null and
    empty texts hold nothing. The benchmark is the query set; each block of at most ``block_items`` passages has a latent
    space of as many dimensions. The documents are read once for all blocks' frequencies, and once for all blocks' search. Items that repeat are found under each of their ids; items without id or
    words are left out. Added columns whose names are taken get underscores in front.
    """
    items_name = free_name(docs.columns, items_name)
    share_name = free_name([*docs.columns, items_name], share_name)
    items = written(item_words(benchmark).withColumn("row", F.monotonically_increasing_id()), "benchmark-items")
    spark = docs.sparkSession
    whole = {r["row"]: (r["item_id"], np.array(r["words"], dtype=np.int64).view(np.uint64)) for r in items.collect()}
    passages = written(passages_of(items), "benchmark-passages")
    rows = passages.orderBy("row", "part").collect()
    terms = np.unique(np.concatenate([words for _, words in whole.values()])) if whole else np.zeros(0, np.uint64)
    weight_of = terms, idf(*document_counts(docs, terms, text)) if whole else np.zeros(0)
    blocks = [rows[len(rows) * n // k:len(rows) * (n + 1) // k] for k in [-(-len(rows) // block_items)] for n in range(k)]
    place = F.struct("row", "part")

    def bound(row) -> Column:
        return F.struct(F.lit(row["row"]).cast("long").alias("row"), F.lit(row["part"]).cast("int").alias("part"))

    indexes = [spark.sparkContext.broadcast(fit(passages.where((place >= bound(own[0])) & (place <= bound(own[-1]))), own, whole, weight_of, **options))
               for own in blocks]
    in_order = sorted(whole)
    screen = spark.sparkContext.broadcast(Screen(in_order, [whole[n][1] for n in in_order], weight_of, options.get("share", SHARE)))
    schema = struct_of(*((f.name, f.dataType) for f in docs.schema.fields),
                       (items_name, T.ArrayType(T.LongType())), (share_name, T.DoubleType()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, texts in pieces(batches, text, 1 << 18, lower=True):
            every: list[dict[int, float]] = [{} for _ in texts]
            found = words_of(texts, IS_BREAK)
            pairs = screen.value(found)
            for index in indexes if len(pairs) else ():
                of_block = np.searchsorted(screen.value.rows, index.value.rows)
                mine = pairs[np.isin(pairs[:, 1], of_block)]
                if not len(mine):
                    continue
                possible = np.zeros((len(texts), len(of_block)), bool)
                possible[mine[:, 0], np.searchsorted(of_block, mine[:, 1])] = True
                for own, more in zip(every, leaks(index.value, texts, possible, found), strict=True):
                    for item, share in more.items():  # an item's passages may lie in two blocks
                        own[item] = max(own.get(item, 0.0), share)
            yield part.assign(**{items_name: [sorted(e) for e in every], share_name: [max(e.values(), default=0.0) for e in every]})

    ship(spark)
    return docs.mapInPandas(run, schema)

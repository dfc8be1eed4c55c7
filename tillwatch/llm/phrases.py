"""Phrase collocations by an FM-index per shard of the corpus, over word ids in both directions.

1. Texts are cut into pieces at sentence marks and line ends, pieces are dealt into shards of about ``SHARD_WORDS`` words,
   and each shard numbers its own words. Shards are written once.
2. Phrases grow a word at a time. A phrase can only be frequent if both phrases of one word less in it are, so each shard
   is told which of its phrases of the last length are frequent in the whole corpus. It keeps the words they cover, builds a
   depth-limited FM-index over them and one over their reverse, finds each phrase's interval by backward search in both,
   and extends all intervals by a word to the right and to the left. Both extensions give the interval of
   the same longer phrase; where they meet, the phrase is reported with its count.
3. Counts of a phrase are summed across shards, and phrases below the limit end there. A shard sends its phrases packed, by
   buckets of their hash, as many as the corpus needs for a bucket to stay small. No word, phrase or dictionary is sent to all
   tasks; what a shard learns is joined to it by its number.

Frequent phrases carry the counts of all their beginnings and ends, which is what a cut's score needs.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import ship, struct_of, written
from tillwatch.llm.textkit import mix

SHARD_WORDS = 1 << 22
#: Words of the corpus per bucket of phrases; a bucket has fewer rows than that.
BUCKET_WORDS = 1 << 22
#: Rows of the index that one numpy pass looks at.
ROWS = 1 << 20
LONGEST, LEAST, TOP = 5, 100, 2000
NO_LANG = "und"
_LOWER = bytearray(range(256))
_LOWER[65:91] = bytes(range(97, 123))
# What ends a piece, and what parts words.
for _mark in b".,;:!?\x0a\x0b\x0c\x0d":
    _LOWER[_mark] = 10
_LOWER = bytes(_LOWER)
_TOKEN = re.compile(rb"[^ \t\n]+|\n")


def packed(words: np.ndarray) -> bytes:
    return zlib.compress(words.astype("<i4").reshape(-1, 1).view(np.uint8).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(-1).astype(np.int64)


def columns_packed(*columns: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, so that leading zeros and slow changes vanish."""
    data = np.stack([c.astype("<i8") for c in columns]).view(np.uint8).reshape(len(columns), -1, 8)
    return zlib.compress(np.ascontiguousarray(data.transpose(0, 2, 1)).tobytes(), 1)


def columns_unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(n, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).reshape(n, -1).view("<i8").astype(np.int64)


class Shard:
    """Word ids from 1 up, told apart by language; 0 stands between pieces."""

    def __init__(self) -> None:
        numbers = count(1)
        self.ids: dict[str, defaultdict] = defaultdict(lambda: defaultdict(numbers.__next__, {b"\n": 0}))
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, tokens: list[bytes]) -> None:
        found = np.fromiter(map(self.ids[lang].__getitem__, tokens), dtype=np.int32, count=len(tokens))
        self.parts += [found, np.zeros(1, dtype=np.int32)]
        self.size += len(tokens) + 1

    def row(self, number: int) -> dict:
        seq = np.concatenate(self.parts)
        entries = [(i, lang, word) for lang, ids in self.ids.items() for word, i in ids.items() if i]
        counts = np.bincount(seq, minlength=len(entries) + 1)
        entries.sort()
        return {"shard": number, "words": packed(seq), "lang": [e[1] for e in entries],
                "word": [e[2].decode("utf-8", "surrogatepass") for e in entries], "n": counts[1:]}


def shards(docs: DataFrame, text: str, lang: str, shard_words: int) -> DataFrame:
    """(shard, words, lang, word, n): the shard's word ids, and by id each word's language, text and count."""
    schema = struct_of(("shard", T.LongType()), ("words", T.BinaryType()), ("lang", T.ArrayType(T.StringType())),
                       ("word", T.ArrayType(T.StringType())), ("n", T.ArrayType(T.LongType())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = count(TaskContext.get().partitionId() << 32)
        held = Shard()
        for batch in batches:
            for content, language in zip(batch["text"], batch["lang"], strict=True):
                if not isinstance(content, str) or not content:
                    continue
                language = language if isinstance(language, str) else NO_LANG
                data = content.encode("utf-8", "surrogatepass").translate(_LOWER)
                at = 0
                while at < len(data):  # a long text is cut at ends of pieces
                    end = len(data) if len(data) - at <= shard_words else data.find(b"\n", at + shard_words) + 1 or len(data)
                    held.add(language, _TOKEN.findall(data, at, end))
                    at = end
                    if held.size >= shard_words:
                        yield pd.DataFrame([held.row(next(numbers))])
                        held = Shard()
        if held.size:
            yield pd.DataFrame([held.row(next(numbers))])

    ship(docs.sparkSession)
    return docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).mapInPandas(run, schema)


class Index:
    """FM-index of a sequence whose suffixes are sorted by their first ``depth`` symbols (symbol 0 parts pieces).

    Backward search and extension are exact for patterns of up to ``depth`` symbols.
    """

    def __init__(self, seq: np.ndarray, depth: int):
        n = len(seq)
        self.n, self.base = n, int(seq.max()) + 1
        # ranks of the first `have` symbols, doubled or moved on until they cover the depth
        ranks, have = [(1, seq)], 1
        order = np.argsort(seq) if depth == 1 else seq
        top = int(seq.max()) + 1
        while have < depth:
            width, tail = ranks[-1] if have + ranks[-1][0] <= depth else next(r for r in reversed(ranks) if have + r[0] <= depth)
            key = ranks[-1][1] * top
            key[:n - have] += tail[have:]
            order = np.argsort(key)
            have += width
            if have < depth:
                key = key[order]
                rank = np.empty(n, dtype=np.int64)
                rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
                ranks.append((have, rank))
                top = max(top, int(rank.max()) + 1)
        del ranks
        self.suffixes = order.astype(np.int32)
        self.last = seq[self.suffixes - 1].astype(np.int32)  # the BWT: the symbol before each suffix
        self.keys = self.last * np.int64(n + 1) + np.arange(n)
        self.keys.sort()

    def before(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """LF: the first row of the suffixes that put ``symbols`` before the suffixes from ``rows`` on."""
        return np.searchsorted(self.keys, symbols * (self.n + 1) + rows)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals (low, high) of patterns (rows of symbols), extended to the left symbol by symbol."""
        low, high = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.n)
        for k in range(patterns.shape[1] - 1, -1, -1):
            low, high = self.before(patterns[:, k], low), self.before(patterns[:, k], high)
        return low, high

    def extended(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All extensions of disjoint intervals by a symbol in front: (interval, symbol, count, smaller symbols).

        The last one tells how far the interval in the other direction's index moves.
        """
        sizes = high - low
        ends = np.cumsum(sizes)
        found, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        at = 0
        while at < len(low):  # whole intervals, of about ROWS rows together
            stop = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ROWS, side="right")), at + 1)
            size = sizes[at:stop]
            owner = np.repeat(np.arange(at, stop), size)
            rows = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[owner]
            one, many = np.unique(owner * self.base + self.last[rows], return_counts=True)
            found.append(one)
            counts.append(many)
            at = stop
        pairs, number = np.concatenate(found), np.concatenate(counts)
        owner, symbol = pairs // self.base, pairs % self.base
        running = np.cumsum(number) - number
        begins = np.searchsorted(owner, np.arange(len(low)))
        smaller = running - running[begins[owner]]
        real = symbol > 0
        return owner[real], symbol[real], number[real], smaller[real]


def covered(seq: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """Which places of ``seq`` lie in an occurrence of a pattern."""
    size = patterns.shape[1]
    base = int(seq.max()) + 1
    names, known = seq, patterns[:, 0]
    for k in range(1, size):
        keys = np.unique(known * base + patterns[:, k])
        after = np.zeros(len(seq), dtype=np.int64)
        after[:len(seq) - k] = seq[k:]
        wanted = names * base + after
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        names = np.where((keys[place] == wanted) & (names > 0) & (after > 0), place + 1, 0)
        known = np.searchsorted(keys, known * base + patterns[:, k]) + 1
    if size == 1:
        table = np.zeros(base, dtype=bool)
        table[known] = True
        return table[seq] & (seq > 0)
    starts = names > 0
    out = starts.copy()
    for k in range(1, size):
        out[k:] |= starts[:len(seq) - k]
    return out


def narrowed(seq: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the patterns cover: its symbols without holes in their numbers, their places, the patterns in these symbols.

    Dropped words leave a gap, one symbol however many they are. Both directions end in a gap.
    """
    kept = covered(seq, patterns)
    places = np.flatnonzero(kept | (~kept & np.concatenate(([True], kept[:-1]))))
    short = np.concatenate(([0], np.where(kept[places], seq[places], 0), [0]))
    used = np.zeros(int(seq.max()) + 1, dtype=np.int64)
    used[short] = 1
    number_of = np.cumsum(used) - 1
    return number_of[short], np.concatenate(([-1], places, [len(seq)])), number_of[patterns]


def grown(names: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The phrases that begin and end with a known one of a word less.

    The result has the known phrases that each longer one begins and ends with, its count, and one place of it.
    """
    size = patterns.shape[1] + 1
    backward = Index(names[::-1].copy(), size)
    low, high = backward.search(patterns[:, ::-1])
    # to the right: the reverse's interval grows in front, and the forward one moves by the smaller symbols
    begin, _, number, smaller = backward.extended(low, high)
    del backward
    forward = Index(names, size)
    low, high = forward.search(patterns)
    right_low = low[begin] + smaller
    # to the left: the forward interval itself
    end, symbol, _, _ = forward.extended(low, high)
    left_low = forward.before(symbol, low[end])
    if not len(right_low) or not len(left_low):
        return (np.zeros(0, dtype=np.int64),) * 4
    order = np.argsort(left_low)
    place = np.minimum(np.searchsorted(left_low[order], right_low), len(order) - 1)
    both = left_low[order][place] == right_low
    return begin[both], end[order][place[both]], number[both], forward.suffixes[right_low[both]]


def longer(base: DataFrame, marks: DataFrame, size: int, slim: bool, buckets: int) -> DataFrame:
    """(shard, bucket, phrases, words): each shard's phrases of ``size`` words.

    ``marks`` has the known ones, as rows (shard, at, id) or packed (shard, marks).

    A row has the phrases (head, tail, place, count) of one bucket. With ``slim`` a row per shard with ``words`` has what
    the known phrases cover, and places refer to that.
    """
    schema = struct_of(("shard", T.LongType()), ("bucket", T.LongType()), ("phrases", T.BinaryType()), ("words", T.BinaryType()))

    def run(shard: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(known) or not len(shard):
            return pd.DataFrame({name: [] for name in schema.names})
        if "marks" in known:
            at, ids = np.concatenate([columns_unpacked(data, 2) for data in known["marks"]], axis=1)
        else:
            at, ids = known["at"].to_numpy(), known["id"].to_numpy()
        seq = unpacked(shard["words"].iloc[0])
        patterns = at[:, None] if size == 2 else seq[at[:, None] + np.arange(size - 1)]
        names, places, patterns = narrowed(seq, patterns)
        begin, end, number, place = grown(names, patterns)
        head, tail, place = ids[begin], ids[end], place.astype(np.int64) if slim else places[place]
        bucket = (mix(head.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + tail.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((tail, head, bucket))
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1)) if buckets <= len(order) else np.append(
            np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
        rows = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if a < b:
                part = order[a:b]
                rows.append((int(bucket[part[0]]), columns_packed(np.diff(head[part], prepend=0), tail[part], place[part], number[part]), None))
        if slim:
            rows.append((-1, None, packed(names)))
        out = pd.DataFrame(rows, columns=schema.names[1:])
        out.insert(0, "shard", int(shard["shard"].iloc[0]))
        return out

    return base.select("shard", "words").groupBy("shard").cogroup(marks.groupBy("shard")).applyInPandas(run, schema)


def merged(packs: DataFrame, least: int, name: str) -> DataFrame:
    """(shard, marks, head, tail, f, id): the phrases whose counts sum to ``least`` over all shards, written.

    A phrase has a row (head, tail, f, id); its id is new. What a shard has of them is a row (shard, marks) per bucket: the
    places and ids, packed.
    """
    schema = struct_of(("shard", T.LongType()), ("marks", T.BinaryType()), ("head", T.LongType()), ("tail", T.LongType()), ("f", T.LongType()),
                       ("id", T.LongType()))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [columns_unpacked(data, 4) for data in rows["phrases"]]
        shard = np.repeat(np.arange(len(parts)), [p.shape[1] for p in parts])
        head = np.concatenate([np.cumsum(p[0]) for p in parts])
        tail, at, n = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        order = np.lexsort((tail, head))
        head, tail = head[order], tail[order]
        new = np.concatenate(([True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])))
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(n[order], starts)
        often = sums >= least
        ids = (int(key[0]) << 36) + np.cumsum(often) - 1
        group = np.cumsum(new) - 1
        kept = often[group]
        shard, at, own = shard[order][kept], at[order][kept], ids[group][kept]
        found = pd.DataFrame({"head": head[starts[often]], "tail": tail[starts[often]], "f": sums[often], "id": ids[often]}, dtype=object)
        marks = [(int(rows["shard"].iloc[k]), columns_packed(at[shard == k], own[shard == k])) for k in np.unique(shard).tolist()]
        return pd.concat([pd.DataFrame(marks, columns=["shard", "marks"], dtype=object), found], ignore_index=True).reindex(
            columns=schema.names).astype(object).where(lambda x: x.notna(), None)

    return written(packs.groupBy("bucket").applyInPandas(run, schema), name)


def frequent(rows: DataFrame, keys: list[str], least: int, name: str) -> DataFrame:
    """The rows whose counts sum to ``least`` over all shards, written with that sum ``f`` and a number ``id`` of the key.

    A key has one row per shard at most, and only those rows meet. Its id is the place of its first row in the
    sorted task, so it holds for all its rows without a join; ``first`` marks one row per key.
    """
    same = Window.partitionBy(*keys)
    summed = rows.withColumn("f", F.sum("n").over(same)).where(F.col("f") >= least)
    placed = summed.withColumn("place", F.monotonically_increasing_id())
    return written(placed.withColumn("id", F.min("place").over(same)).select(
        "*", (F.col("place") == F.col("id")).alias("first")).drop("place", "n"), name)


def counted(docs: DataFrame, text: str, lang: str, longest: int, least: int, shard_words: int) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, words) with all words' number, and for each length the phrases of ``least`` occurrences and more.

    A phrase has: id, lang, phrase, last (its last word), f, heads (counts of its beginnings, shortest first), tails (of
    its ends, shortest first), and from two words on head and tail, the ids of what it begins and ends with.
    """
    base = written(shards(docs, text, lang, shard_words), "phrase-shards")
    words = base.select("shard", F.posexplode(F.arrays_zip("lang", "word", "n")).alias("place", "w")).select(
        "shard", (F.col("place") + 1).cast("long").alias("at"), "w.lang", "w.word", "w.n")
    totals = base.select(F.explode(F.arrays_zip("lang", "n")).alias("w")).groupBy("w.lang").agg(F.sum("w.n").alias("words"))
    hits = frequent(words, ["lang", "word"], least, "phrase-words")
    marks = hits.select("shard", "at", "id")
    grams = hits.where("first").select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("heads"), F.array("f").alias("tails"))
    found = [grams]
    buckets = -(-(totals.agg(F.sum("words")).first()[0] or 1) // BUCKET_WORDS)
    for size in range(2, longest + 1):
        # the first round keeps nearly all words; from the next one on shards shrink
        slim = 2 < size < longest
        more = longer(base, marks, size, slim, buckets)
        if slim:
            more = written(more, f"phrase-rounds-{size}")
            base = more.where("words is not null").select("shard", "words")
        hits = merged(more.where("phrases is not null").select("shard", "bucket", "phrases"), least, f"phrase-hits-{size}")
        marks = hits.where("marks is not null").select("shard", "marks")
        heads = grams.select(F.col("id").alias("head"), "lang", "phrase", F.col("heads").alias("before"))
        tails = grams.select(F.col("id").alias("tail"), "last", F.col("tails").alias("after"))
        grams = written(hits.where("marks is null").select("id", "head", "tail", "f").join(heads, "head").join(tails, "tail").select(
            "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f", F.concat("before", F.array("f")).alias("heads"),
            F.concat("after", F.array("f")).alias("tails"), "head", "tail"), f"phrases-{size}")
        found.append(grams)
    return totals, found


def cut_scores(size: int) -> Column:
    """The lowest score of a phrase's cuts, with the counts of both parts; of equal scores the first cut."""
    whole = "cast(1000 as decimal(4,0)) * cast(f as decimal(17,0)) * cast(words as decimal(17,0))"
    cuts = []
    for k in range(1, size):
        left, right = f"heads[{k - 1}]", f"tails[{size - k - 1}]"
        score = F.expr(f"({whole}) div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0)))")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("cut"), F.expr(left).alias("l"), F.expr(right).alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's strongest phrases of 2 to ``longest`` words.

    A phrase stands ``least`` times in pieces of the language's texts. Of its cuts into two parts, of counts l and r, the
    lowest ``floor(1000 a n / (l r))`` counts. A phrase that only stands inside one longer phrase is dropped; it does so
    exactly if one of its extensions by a word has its count. Ranks follow score and count (falling) and the phrase's bytes.
    Null texts are empty, a null language is ``und``, repeated rows count again, an empty table gives no rows, and
    other columns are not read. A text of any length is cut into shards between pieces. Counts up to 10^17 are exact.
    """
    totals, found = counted(docs, text, lang, longest, least, shard_words)
    results = []
    for size in range(2, longest + 1):
        own = found[size - 1]
        if size < longest:
            more = found[size]
            inside = more.select(F.explode(F.array("head", "tail")).alias("id"), F.col("f").alias("longer")).groupBy("id").agg(F.max("longer").alias("longer"))
            own = own.join(inside, "id", "left").where("longer is null or longer < f")
        scored = own.join(totals, "lang").withColumn("c", cut_scores(size))
        results.append(scored.select("lang", "phrase", F.col("f").alias("a"), "c.l", "c.r", F.col("words").alias("n"), "c.score"))
    phrases = results[0]
    for more in results[1:]:
        phrases = phrases.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return phrases.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""Toxicity by a convolutional text classifier: hashed word embeddings, several filter widths, max pooling.

The network is small and trained on all labelled texts, whole: features are counted by a Spark aggregate, and in every
round each task takes its own steps through its rows, from the same weights, and the tasks' changes are averaged. Spark scores
all texts, whole, in the tasks that read them. A word is embedded as the sum of the vectors of its hash and
of the hashes of its first bytes, so unseen inflections of a known stem have a vector. Only features
that enough training texts hold have vectors; the rest are zero, which keeps long texts of rare words
from colliding with telling words.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import free_name, pieces, ship, struct_of, written
from tillwatch.llm.textkit import Lookup, Words, words_of

WIDTHS = (1, 2, 3)
#: Lengths in bytes of the word beginnings that have vectors of their own.
PREFIXES = (3, 4, 5, 6)
PAD = max(WIDTHS) - 1
#: Labelled texts that a task trains on at least before its changes are averaged with those of others.
TASK_ROWS = 8192
#: Features that have vectors at most, the most telling ones first. It is the size of the network, not of its data.
MOST_FEATURES = 1 << 18
#: Calibration counts logits in steps of this width.
LOGIT_STEP = 0.01


@dataclass
class Network:
    """Weights of a fitted classifier.

    keys: sorted hashes of the features that have vectors, and ``vectors`` in their order.
    filters: one (width, dimensions, filters) array per width; ``out`` joins the pooled filters.
    slope, offset: the calibration of the logit. thresholds: score limits by language, None for others.
    """

    keys: np.ndarray
    vectors: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    thresholds: dict[str | None, float] = field(default_factory=dict)
    lookup: Lookup | None = None


def features(found: Words) -> np.ndarray:
    """(features, words): hashes of each word and of its beginnings."""
    return np.stack([found.words(), *(found.prefixes(length) for length in PREFIXES)])


def rows_of(network: Network, hashes: np.ndarray) -> np.ndarray:
    """Row numbers of the features' vectors; the last row, all zeros, for those without one."""
    if network.lookup is None:
        network.lookup = Lookup(network.keys)
    return network.lookup(hashes)


def padded(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words when each text is followed by empty ones, and the first place of each text."""
    text = found.text_of()
    return np.arange(len(text)) + PAD * text, found.first[:-1] + PAD * np.arange(len(found.first) - 1)


def pooled(network: Network, places: np.ndarray, first: np.ndarray, rows: np.ndarray, total: int):
    """The largest activation of every filter in every text, and the embedded words."""
    embedded = np.zeros((total + PAD, network.vectors.shape[1]), dtype=np.float32)
    vectors = network.vectors[rows[0]]
    for own in rows[1:]:
        vectors += network.vectors[own]
    embedded[places] = vectors
    outside = np.ones(total, dtype=bool)
    outside[places] = False
    columns, activations = [], []
    products = embedded @ np.concatenate([part for weights in network.filters for part in weights], axis=1)
    at = 0
    for weights, bias in zip(network.filters, network.biases, strict=True):
        act = np.zeros((total, weights.shape[2]), dtype=np.float32) + bias
        for k in range(weights.shape[0]):
            act += products[k:total + k, at:at + weights.shape[2]]
            at += weights.shape[2]
        act[outside] = -np.inf
        activations.append(act)
        columns.append(np.maximum.reduceat(act, first, axis=0) if len(first) else act[:0])
    peaks = np.concatenate(columns, axis=1) if columns else np.zeros((0, 0))
    return np.maximum(peaks, 0), peaks, activations, embedded


def logits(network: Network, texts: list[bytes]) -> np.ndarray:
    found = words_of(texts)
    hashes = features(found)
    rows = rows_of(network, hashes)
    places, first = padded(found)
    relu, *_ = pooled(network, places, first, rows, len(found.starts) + PAD * len(texts))
    return relu @ network.out + network.bias


def peak_places(act: np.ndarray, peaks: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(texts, filters): the first place where a filter has its peak in a text."""
    places = np.empty(peaks.shape, dtype=np.int64)
    spans = np.maximum(sizes, 1) + PAD
    for f in range(peaks.shape[1]):
        hit = np.flatnonzero(act[:, f] == np.repeat(peaks[:, f], np.where(sizes > 0, sizes + PAD, PAD)))
        owner = np.searchsorted(first, hit, side="right") - 1
        texts, start = np.unique(owner, return_index=True)
        places[:, f] = first
        places[texts, f] = np.minimum(hit[start], first[texts] + spans[texts] - 1)
    return places


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def feature_counts(texts: list[bytes], y: np.ndarray, chunk: int = 128) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, texts, positive texts): the features' sorted hashes, and in how many (positive) texts each occurs."""
    keys, count, positive = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
    for begin in range(0, len(texts), chunk):
        own = [np.unique(features(words_of([t]))) for t in texts[begin:begin + chunk]]
        ones = np.concatenate([np.full(len(k), 1.0) for k in own])
        marked = np.repeat(y[begin:begin + chunk], [len(k) for k in own])
        keys, where = np.unique(np.concatenate([keys, *own]), return_inverse=True)
        count = np.bincount(where, weights=np.concatenate([count, ones]), minlength=len(keys))
        positive = np.bincount(where, weights=np.concatenate([positive, marked]), minlength=len(keys))
    return keys, count, positive


def blank(dims: int, per_width: int, share: float | None = None) -> Network:
    """A network without features that gives every text the same score: ``share``, kept off 0 and 1."""
    network = Network(np.zeros(0, np.uint64), np.zeros((1, dims), np.float32),
                      [np.zeros((w, dims, per_width), np.float32) for w in WIDTHS],
                      [np.zeros(per_width, np.float32) for _ in WIDTHS],
                      np.zeros(per_width * len(WIDTHS), np.float32), 0.0)
    if share is not None:
        network.bias = float(np.log(share / (1 - share)))
    return network


def link(count, positive, share: float):
    """A z-score of a feature's link with the label: numbers, arrays or columns."""
    return (positive - count * share) / (count * share + 1) ** 0.5


@dataclass
class Training:
    """A network in training: Adagrad's sums of squares, and the weights of the two classes."""

    network: Network
    speed: list[np.ndarray]
    speed_b: list[np.ndarray]
    speed_o: np.ndarray
    speed_c: float
    speed_v: np.ndarray
    weights: tuple[float, float]
    rate: float

    @classmethod
    def start(cls, keys: np.ndarray, links: np.ndarray, share: float, dims: int, per_width: int, rate: float,
              rng: np.random.Generator) -> Training:
        """keys: the features' sorted hashes; links: their z-scores; share: that of label 1."""
        network = blank(dims, per_width)
        network.keys = keys
        network.vectors = np.zeros((len(keys) + 1, dims), np.float32)
        network.vectors[:-1] = rng.normal(0, 0.05, (len(keys), dims))
        network.vectors[:-1, 0] = np.clip(links / 4, -1, 1)
        network.filters = [rng.normal(0, 0.3, (w, dims, per_width)).astype(np.float32) for w in WIDTHS]
        for weights in network.filters:
            weights[:, 0, :] = np.abs(weights[:, 0, :])
        network.out = np.abs(rng.normal(0, 0.3, per_width * len(WIDTHS))).astype(np.float32)
        network.bias = -1.0
        return cls(network, [np.full_like(w, 1e-6) for w in network.filters], [np.full_like(b, 1e-6) for b in network.biases],
                   np.full_like(network.out, 1e-6), 1e-6, np.full(len(keys) + 1, 1e-2, np.float32), (0.5 / (1 - share), 0.5 / share), rate)

    def step(self, texts: list[np.ndarray], y: np.ndarray) -> None:
        """One step down the loss of some texts, each given as the row numbers (features, words) of its words' vectors."""
        network, rate = self.network, self.rate
        weight = np.where(y > 0, self.weights[1], self.weights[0]).astype(np.float32)
        rows = np.concatenate(texts, axis=1)
        sizes = np.array([t.shape[1] for t in texts])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        owner = np.repeat(np.arange(len(texts)), sizes)
        places = np.arange(rows.shape[1]) + PAD * owner
        first = starts + PAD * np.arange(len(texts))
        total = rows.shape[1] + PAD * len(texts)
        at = np.full(total + PAD, -1)
        at[places] = np.arange(rows.shape[1])
        relu, peaks, acts, embedded = pooled(network, places, first, rows, total)
        error = (sigmoid(relu @ network.out + network.bias) - y) * weight / len(texts)
        grad_o = relu.T @ error
        grad_relu = np.outer(error, network.out) * (peaks > 0)
        column = 0
        for w, (weights, act) in enumerate(zip(network.filters, acts, strict=True)):
            own = grad_relu[:, column:column + weights.shape[2]]
            top = peak_places(act, peaks[:, column:column + weights.shape[2]], first, sizes)
            grad_w, width = np.zeros_like(weights), len(weights)
            for k in range(width):
                grad_w[k] = np.einsum("df,dfe->ef", own, embedded[top + k])
                word = at[top + k]
                used = (word >= 0) & (own != 0)
                which = rows[:, word[used]].ravel()
                change = np.tile((own[:, :, None] * weights[k].T[None])[used], (len(rows), 1))
                np.add.at(self.speed_v, which, (change**2).mean(axis=1))
                pace = 0.3 * rate / np.sqrt(self.speed_v[which])
                np.subtract.at(network.vectors, which, pace[:, None] * change)
            grad_b = own.sum(axis=0)
            self.speed[w] += grad_w**2
            self.speed_b[w] += grad_b**2
            network.filters[w] = weights - rate * grad_w / np.sqrt(self.speed[w])
            network.biases[w] = network.biases[w] - rate * grad_b / np.sqrt(self.speed_b[w])
            column += weights.shape[2]
        network.vectors[-1] = 0
        self.speed_o += grad_o**2
        self.speed_c += float(error.sum()) ** 2
        network.out = network.out - rate * grad_o / np.sqrt(self.speed_o)
        network.bias -= rate * float(error.sum()) / np.sqrt(self.speed_c)

    def small(self) -> np.ndarray:
        """All that does not belong to a feature, as one row of numbers."""
        net = self.network
        parts = [*net.filters, *net.biases, net.out, [net.bias], *self.speed, *self.speed_b, self.speed_o, [self.speed_c]]
        return np.concatenate([np.ravel(p) for p in parts]).astype(np.float64)

    def set_small(self, values: np.ndarray) -> None:
        net, at = self.network, 0

        def take(like: np.ndarray) -> np.ndarray:
            nonlocal at
            at += like.size
            return values[at - like.size:at].reshape(like.shape).astype(np.float32)

        net.filters, net.biases, net.out = [take(w) for w in net.filters], [take(b) for b in net.biases], take(net.out)
        net.bias = float(take(np.zeros(1))[0])
        self.speed, self.speed_b, self.speed_o = [take(w) for w in self.speed], [take(b) for b in self.speed_b], take(self.speed_o)
        self.speed_c = float(take(np.zeros(1))[0])


def fit(sample: pd.DataFrame, dims: int = 16, per_width: int = 8, epochs: int = 4, batch: int = 32,
        rate: float = 0.05, least_texts: int = 4, seed: int = 7) -> Network:
    """A network fitted to rows of (text, label, lang) that are at hand; lang serves the thresholds alone.

    A fifth of the rows is kept from the training and calibrates the score (a logistic fit of the
    logits) and the thresholds: per language the limit of the best F1, where both classes occur there.
    The first embedding dimension starts as a bounded z-score of the feature's link with the label, the
    others at random. No rows, or one class: a network that gives every text the share of that class.
    """
    rng = np.random.default_rng(seed)
    sample = sample.reset_index(drop=True)
    y = sample["label"].to_numpy(dtype=np.float32) if len(sample) else np.zeros(0, np.float32)
    if not len(y) or y.min() == y.max():
        return blank(dims, per_width, (float(y.sum()) + 0.01) / (len(y) + 0.02 if len(y) else 1.0))
    texts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in sample["text"]]
    held = rng.random(len(y)) < 0.2
    if y[held].min(initial=1) == y[held].max(initial=0) or y[~held].min() == y[~held].max():
        held[:] = False
    train = np.flatnonzero(~held)

    keys, count, positive = feature_counts([texts[t] for t in train], y[train])
    often, share = count >= least_texts, float(y[train].mean())
    training = Training.start(keys[often], link(count, positive, share)[often], share, dims, per_width, rate, rng)
    network = training.network
    # what a text holds does not change between epochs: the rows of its features are kept
    kept = {t: rows_of(network, features(words_of([texts[t]]))) for t in train}
    for _ in range(epochs):
        rng.shuffle(train)
        for begin in range(0, len(train), batch):
            part = train[begin:begin + batch]
            training.step([kept[t] for t in part], y[part])
    if held.any():
        own = [texts[t] for t in np.flatnonzero(held)]
        x = np.concatenate([logits(network, own[k:k + 64]) for k in range(0, len(own), 64)]).astype(np.float64)
        calibrate(network, x, y[held], np.ones(len(x)), sample["lang"].to_numpy()[held])
    return network


def calibrate(network: Network, x: np.ndarray, y: np.ndarray, n: np.ndarray, langs: np.ndarray) -> None:
    """Fits slope and offset to ``n`` texts of each logit x and label y, then a threshold per language."""
    slope, offset = 1.0, 0.0
    total, bad = n.sum(), (n * y).sum()
    goal = np.where(y > 0, (bad + 1) / (bad + 2), 1 / (total - bad + 2))
    for _ in range(60):
        p = sigmoid(slope * x + offset)
        miss, spread = n * (p - goal), n * (p * (1 - p) + 1e-9)
        gradient = np.array([(miss * x).sum() + 1e-3 * (slope - 1), miss.sum()])
        curve = np.array([[(spread * x * x).sum() + 1e-3, (spread * x).sum()], [(spread * x).sum(), spread.sum() + 1e-3]])
        step = np.linalg.solve(curve, gradient)
        slope, offset = slope - np.clip(step[0], -1, 1), offset - np.clip(step[1], -1, 1)
    network.slope, network.offset = float(max(slope, 1e-3)), float(offset)
    score = sigmoid(network.slope * x + network.offset)
    for lang in {v for v in langs if isinstance(v, str)}:
        own = np.array([v == lang for v in langs])
        if y[own].min() < y[own].max():
            limits = np.round(np.arange(0.05, 0.96, 0.05), 2)
            marked, size = y[own] > 0, n[own]
            hits = [(2 * size[(score[own] >= c) & marked].sum()) / max(size[score[own] >= c].sum() + size[marked].sum(), 1)
                    for c in limits]
            best = np.flatnonzero(np.array(hits) >= max(hits) - 1e-12)
            network.thresholds[lang] = float(limits[best[len(best) // 2]])


def marked_ids(labels: DataFrame, label: str, usable: Column) -> DataFrame:
    """(doc_id, label) of the labelled ids. Ids with contradicting labels are left out; null ids and labels too."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
        .groupBy("doc_id").agg(F.min(label).alias("low"), F.max(label).alias("high"))
        .where((F.col("low") == F.col("high")) & F.col("low").isin(0, 1)).select("doc_id", F.col("low").cast("int").alias("label"))
    )


def labelled(docs: DataFrame, labels: DataFrame, label: str, usable: Column) -> DataFrame:
    """(doc_id, text, lang, label) of every labelled text; null texts are left out.

    Of several texts of an id the first in order counts. A bitmap of the labelled ids' hashes, 16 bits an id, keeps most
    other texts out of the join.
    """
    marked = marked_ids(labels, label, usable).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    bits = F.lit(max(16 * marked.count(), 1 << 15))
    bit = F.pmod(F.xxhash64("doc_id"), bits)
    maps = marked.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.hex(F.bitmap_construct_agg(F.bitmap_bit_position(bit))).alias("map"))
    texts = docs.select("doc_id", "text", "lang").where("text is not null and doc_id is not null").withColumn("bit", bit)
    texts = texts.withColumn("bucket", F.bitmap_bucket_number("bit")).join(F.broadcast(maps), "bucket")
    place = F.bitmap_bit_position("bit")
    byte = F.conv(F.substring("map", (F.floor(place / 8) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("long")
    texts = texts.where(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))) % 2 == 1).select("doc_id", "text", "lang")
    found = texts.join(marked, "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("text", "lang")).alias("row"), F.min("label").alias("label"))
    return found.select("doc_id", "row.text", "row.lang", "label")


def telling_features(rows: DataFrame, share: float, least_texts: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, z-scores) of the features that at least ``least_texts`` of all the rows' texts hold.

    Of more than ``most`` such features those with the strongest links with the label have vectors, down to the
    hundredth at which they fit.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, texts in pieces(batches, "text"):
            keys, count, positive = feature_counts(texts, part["label"].to_numpy(), len(texts))
            yield pd.DataFrame({"key": keys.view(np.int64), "n": count.astype(np.int64), "positive": positive.astype(np.int64)})

    counts = rows.select("text", "label").mapInPandas(run, "key long, n long, positive long").groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("positive").alias("positive")).where(F.col("n") >= least_texts)
    counts = written(counts.withColumn("z", link(F.col("n"), F.col("positive"), share)), "feature-counts")
    strength = F.floor(F.least(F.abs("z"), F.lit(1000.0)) * 100)
    if counts.count() > most:
        held, least = 0, None
        for row in counts.groupBy(strength.alias("s")).count().orderBy(F.desc("s")).collect():
            held += row["count"]
            if held > most:
                break
            least = row["s"]
        counts = counts.where(strength >= least) if least is not None else counts.limit(0)
    found = counts.select("key", "z").toArrow().to_pandas()
    keys = found["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], found["z"].to_numpy(np.float64)[order]


def averaged_round(rows: DataFrame, training: Training, batch: int, seed: int) -> None:
    """One round: every task steps through its rows from the same weights, and the tasks' changes are averaged.

    A task counts by its rows; a feature's vector is averaged over the tasks that changed it.
    """
    spark = rows.sparkSession
    dims = training.network.vectors.shape[1]
    names = [f"d{k}" for k in range(dims)]
    shared = spark.sparkContext.broadcast(training)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begun, own = shared.value, copy.deepcopy(shared.value)
        rng, n = np.random.default_rng(seed), 0
        for part, texts in pieces(batches, "text", 1 << 22):
            y = part["label"].to_numpy(dtype=np.float32)
            order = rng.permutation(len(texts))
            for at in range(0, len(order), batch):
                chosen = order[at:at + batch]
                found = [rows_of(own.network, features(words_of([texts[t]]))) for t in chosen]
                own.step(found, y[chosen])
            n += len(texts)
        if not n:
            return
        change = own.speed_v.astype(np.float64) - begun.speed_v
        touched = np.flatnonzero(change[:-1])
        small = own.small() - begun.small()
        small = np.pad(small, (0, -len(small) % dims)).reshape(-1, dims)
        values = np.concatenate([small, own.network.vectors[touched].astype(np.float64) - begun.network.vectors[touched]]) * n
        out = pd.DataFrame(values, columns=names)
        out.insert(0, "speed", np.concatenate([np.zeros(len(small)), change[touched]]) * n)
        out.insert(0, "n", n)
        out.insert(0, "row", np.concatenate([-1 - np.arange(len(small)), touched]))
        yield out

    schema = "row int, n long, speed double, " + ", ".join(f"{name} double" for name in names)
    changes = rows.select("text", "label").mapInPandas(run, schema)
    mean = changes.groupBy("row").agg(*[(F.sum(c) / F.sum("n")).cast("float").alias(c) for c in ("speed", *names)]).toArrow().to_pandas()
    shared.destroy()
    row, values = mean["row"].to_numpy(), mean[names].to_numpy(np.float64)
    small = training.small()
    order = np.argsort(-row[row < 0])
    training.set_small(small + values[row < 0][order].ravel()[:len(small)])
    feature = row >= 0
    training.network.vectors[row[feature]] += values[feature].astype(np.float32)
    training.speed_v[row[feature]] += mean["speed"].to_numpy(np.float32)[feature]


def counted_logits(rows: DataFrame, network: Network) -> pd.DataFrame:
    """(lang, label, x, n): how many of all the rows' texts have the logit x, in steps of ``LOGIT_STEP``."""
    model = rows.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, texts in pieces(batches, "text"):
            x = np.clip(logits(model.value, texts).astype(np.float64), -40, 40)
            yield part[["lang", "label"]].assign(step=np.rint(x / LOGIT_STEP).astype(np.int64))

    found = rows.select("text", "lang", "label").mapInPandas(run, "lang string, label int, step long")
    found = found.groupBy("lang", "label", "step").agg(F.count("*").alias("n")).toArrow().to_pandas()
    return found.assign(x=found["step"] * LOGIT_STEP)


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, label: str = "toxic", dims: int = 16,
          per_width: int = 8, epochs: int = 4, batch: int = 32, rate: float = 0.05, least_texts: int = 4,
          most_features: int = MOST_FEATURES, seed: int = 7) -> Network:
    """The network fitted to all labelled documents; ``usable`` restricts the rows of ``labels``.

    As ``fit`` does it, over all rows: a fifth of them, by a hash of the id, is kept from the training and calibrates score and
    thresholds. A round goes through all the others' texts. Texts never reach the driver, only sums of the size of the network do.
    """
    ship(docs.sparkSession)
    rows = labelled(docs, labels, label, F.lit(True) if usable is None else usable)
    rows = written(rows.withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(5)) == 0), "labelled-texts")
    sizes = {(r["held"], r["label"]): r["count"] for r in rows.groupBy("held", "label").count().collect()}
    n, bad = sum(sizes.values()), sum(c for (_, y), c in sizes.items() if y)
    if bad in (0, n):
        return blank(dims, per_width, (bad + 0.01) / (n + 0.02 if n else 1.0))
    if len(sizes) == 4:
        own, held = rows.where("not held"), rows.where("held")
        n, bad = n - sizes[True, 0] - sizes[True, 1], bad - sizes[True, 1]
    else:
        own, held = rows, None
    keys, links = telling_features(own, bad / n, least_texts, most_features)
    training = Training.start(keys, links, bad / n, dims, per_width, rate, np.random.default_rng(seed))
    for k in range(epochs):
        averaged_round(own.coalesce(max(1, n // TASK_ROWS)), training, batch, seed + k)
    network = training.network
    if held is not None:
        found = counted_logits(held, network)
        calibrate(network, *(found[c].to_numpy(np.float64) for c in ("x", "label", "n")), found["lang"].to_numpy())
    network.lookup = None
    return network


def score(docs: DataFrame, network: Network, text: str = "text", lang: str | None = "lang",
          score_name: str = "score", limit_name: str = "limit") -> DataFrame:
    """All columns of ``docs`` with the toxicity score (0 to 1) and the limit of the text's language.

    The whole text decides; null and empty texts get the score of a text without words. The language
    chooses the limit alone (0.7 where none was calibrated). Added columns whose names are taken get
    underscores in front. Rows are neither joined nor shuffled.
    """
    score_name = free_name(docs.columns, score_name)
    limit_name = free_name([*docs.columns, score_name], limit_name)
    schema = struct_of(*((f.name, f.dataType) for f in docs.schema.fields),
                       (score_name, T.DoubleType()), (limit_name, T.DoubleType()))
    model = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = model.value
        for part, texts in pieces(batches, text):
            x = sigmoid(net.slope * logits(net, texts).astype(np.float64) + net.offset)
            limits = [net.thresholds.get(v, 0.7) for v in part[lang]] if lang else 0.7
            yield part.assign(**{score_name: x, limit_name: limits})

    ship(docs.sparkSession)
    return docs.mapInPandas(run, schema)

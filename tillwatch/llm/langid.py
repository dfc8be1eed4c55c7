"""Language of a text from averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of 1 to 4 characters of each lowered word, with marks at its ends. Training is
stochastic gradient descent in numpy on a bounded sample. As both the average and the output layer are
linear, each subword's embedding is multiplied with the output layer once; a task then only sums, over
the whole text, one small vector per subword.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import CHUNK_BYTES, free_name, ship, struct_of

BITS = 16
ORDERS = (1, 2, 3, 4)
_SALTS = [np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F)]
#: What is accepted as a letter is left to str.isalpha; these code points only separate words.
_BREAK = 32


@dataclass
class LanguageModel:
    """logits: one row per subword bucket, one column per language; reject: the least accepted score."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject: float = 0.0


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lowered code points of the texts, everything but letters a break, and the bounds of the texts."""
    lowered = [" " + text.lower() + " " for text in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, lowered), dtype=np.int64, count=len(lowered)))))
    return codes, bounds


def subwords(codes: np.ndarray) -> list[np.ndarray]:
    """For each order the bucket of the run that starts at a place; -1 where it holds a break inside."""
    ascii_other = (codes < 128) & ~(((codes >= 97) & (codes <= 122)) | (codes == 39))
    gap = ascii_other | (codes == 0xA0)
    codes = np.where(gap, np.uint32(_BREAK), codes)
    found, rolled, inner = [], np.zeros(len(codes), dtype=np.uint32), np.zeros(len(codes), dtype=bool)
    for order in ORDERS:
        n = len(codes) - order + 1
        if n <= 0:
            break
        rolled = rolled[:n] * np.uint32(0x01000193) + codes[order - 1:]
        if order > 2:  # a run may begin or end with a break, but not hold one inside
            inner = inner[:n] | gap[order - 2:order - 2 + n]
        bad = inner[:n] | (gap[:n] & gap[order - 1:]) if order > 1 else gap
        bucket = ((rolled ^ (rolled >> np.uint32(15))) * _SALTS[order - 1]) >> np.uint32(32 - BITS)
        found.append(np.where(bad, np.int32(-1), bucket.astype(np.int32)))
    return found


def bags(texts: list[str]) -> list[np.ndarray]:
    """The buckets of each text, repeats included."""
    out = []
    for text in texts:
        codes, _ = characters([text])
        runs = subwords(codes)
        joined = np.concatenate(runs) if runs else np.zeros(0, np.int32)
        out.append(joined[joined >= 0])
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(sample: pd.DataFrame, dims: int = 16, epochs: int = 6, rate: float = 0.5, most: int = 4000,
        accept: float = 0.995, seed: int = 5) -> LanguageModel:
    """A model of the languages in rows of (text, lang).

    A training text gives one random excerpt of ``most`` subwords per epoch, so a step costs the same
    for any length. A fifth of the rows is kept from the training: there the temperature is fitted, and
    the rejection limit is the score that the share ``accept`` of the right predictions reaches.
    """
    rng = np.random.default_rng(seed)
    sample = sample.reset_index(drop=True)
    languages = sorted(set(sample["lang"])) if len(sample) else []
    if not languages:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32))
    y = np.array([languages.index(v) for v in sample["lang"]])
    held = rng.random(len(y)) < 0.2
    if held.all() or len(set(y[~held])) < len(languages):
        held[:] = False
    texts = bags([t if isinstance(t, str) else "" for t in sample["text"]])
    train = np.flatnonzero(~held & np.array([len(b) > 0 for b in texts]))
    vectors = rng.normal(0, 0.1, (1 << BITS, dims)).astype(np.float32)
    out = np.zeros((dims, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    speed = np.full(1 << BITS, 1e-4, np.float32)
    speed_o = np.full_like(out, 1e-4)
    for _ in range(epochs):
        rng.shuffle(train)
        for t in train:
            bag = texts[t]
            if len(bag) > most:
                bag = bag[rng.integers(0, len(bag), most)]
            mean = vectors[bag].mean(axis=0)
            error = softmax(mean @ out + bias)
            error[y[t]] -= 1
            grad_out, grad_mean = np.outer(mean, error), out @ error
            speed_o += grad_out**2
            which, count = np.unique(bag, return_counts=True)
            own = (count / len(bag)).astype(np.float32)[:, None] * grad_mean
            speed[which] += (own**2).sum(axis=1)
            vectors[which] -= rate * own / np.sqrt(speed[which])[:, None]
            out -= rate * grad_out / np.sqrt(speed_o)
            bias -= 0.01 * rate * error
    model = LanguageModel(languages, (vectors @ out).astype(np.float32), bias)
    if held.any():
        x = np.stack([raw(model, bag) for bag, h in zip(texts, held, strict=True) if h])
        goal = y[held]
        losses = [(-np.log(softmax(x / t)[np.arange(len(goal)), goal] + 1e-12).mean(), t)
                  for t in (0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.5, 2.0, 3.0)]
        model.temperature = float(min(losses)[1])
        p = softmax(x / model.temperature)
        right = p.max(axis=1)[p.argmax(axis=1) == goal]
        model.reject = float(np.quantile(right, 1 - accept)) if len(right) else 0.0
    return model


def raw(model: LanguageModel, bag: np.ndarray) -> np.ndarray:
    return model.bias + (model.logits[bag].mean(axis=0) if len(bag) else 0)


def train(docs: DataFrame, usable: Column | None = None, per_language: int = 600, **options) -> LanguageModel:
    """A model fitted to at most about ``per_language`` documents of each language, chosen by a hash.

    The bound is on the training sample alone. Languages are the non-null values of ``lang``; they are
    counted over all usable documents, so that rare ones are taken whole.
    """
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(usable) if usable is not None else rows
    sizes = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    scale = 1 << 30
    keep = F.lit(False)
    for lang, size in sizes.items():
        share = scale if size <= per_language else int(scale * per_language / size)
        keep = keep | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(scale)) < share))
    sample = rows.where(keep).select("doc_id", "text", "lang").toPandas()
    return fit(sample.sort_values(["doc_id", "text"], ignore_index=True), **options)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", name: str = "lang_pred",
            score_name: str = "score", accepted_name: str = "accepted") -> DataFrame:
    """All columns of ``docs`` with the language, its probability, and whether that is accepted.

    Every subword of the whole text counts. Null texts, texts without any letter and all texts under a
    model without languages are ``und`` with score 0, not accepted. Ties go to the first language in
    alphabetical order. Added columns whose names are taken get underscores in front.
    """
    taken = list(docs.columns)
    names = []
    for wanted in (name, score_name, accepted_name):
        names.append(free_name([*taken, *names], wanted))
    schema = struct_of(*((f.name, f.dataType) for f in docs.schema.fields), (names[0], T.StringType()),
                       (names[1], T.DoubleType()), (names[2], T.BooleanType()))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = shared.value
        table = np.concatenate([net.logits, np.zeros((1, len(net.languages)), np.float32)])
        for batch in batches:
            start, held, texts = 0, 0, []
            values = batch[text].tolist()
            for n, value in enumerate(values):
                texts.append(value if isinstance(value, str) else "")
                held += len(texts[-1]) + 16
                if held >= CHUNK_BYTES // 4 or n + 1 == len(values):
                    yield assigned(batch.iloc[start:n + 1], texts, net, table)
                    start, held, texts = n + 1, 0, []

    def assigned(part: pd.DataFrame, texts: list[str], net: LanguageModel, table: np.ndarray) -> pd.DataFrame:
        letters = np.array([any(map(str.isalpha, t)) for t in texts], dtype=bool)
        if not net.languages:
            return part.assign(**{names[0]: "und", names[1]: 0.0, names[2]: False})
        codes, bounds = characters(texts)
        total, count = np.zeros((len(texts), len(net.languages))), np.zeros(len(texts))
        for runs in subwords(codes):
            sums = np.zeros((len(runs) + 1, len(net.languages)))
            np.cumsum(table[runs], axis=0, dtype=np.float64, out=sums[1:])
            hits = np.concatenate(([0], np.cumsum(runs >= 0)))
            ends = np.minimum(bounds, len(runs))
            total += sums[ends[1:]] - sums[ends[:-1]]
            count += hits[ends[1:]] - hits[ends[:-1]]
        x = total / np.maximum(count, 1)[:, None] + net.bias
        p = softmax(x / net.temperature)
        best = p.argmax(axis=1)
        top = p[np.arange(len(texts)), best]
        language = np.where(letters, np.array(net.languages, dtype=object)[best], "und")
        return part.assign(**{names[0]: language, names[1]: np.where(letters, top, 0.0),
                              names[2]: letters & (top >= net.reject)})

    ship(docs.sparkSession)
    return docs.mapInPandas(run, schema)


"""Phrase collocations against counting by hand."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillwatch.llm import phrases
from tillwatch.llm.queries import op13_phrase_collocations

SF = "/root/testdata/sf0.001"
SCHEMA = "text string, lang string"


def brute(rows, longest=5, least=100, top=2000):
    """The query's rows, from counters over all n-grams."""
    counts, words = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            found = re.findall(r"[^ \t]+", piece)
            words[lang] += len(found)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(found[i:i + k]) for i in range(len(found) - k + 1))
    out = set()
    for lang, f in counts.items():
        n = words[lang]
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= 100 * candidates.get(p[i:i + k], a + 1):
                        inside.add(p[i:i + k])
        scored = []
        for p, a in candidates.items():
            if p not in inside:
                cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def got(spark, rows, **options):
    found = phrases.collocations(spark.createDataFrame(rows, SCHEMA), **options).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def prose(seed, texts, vocabulary=12):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["New", "new", "York", "été", "Ä", "a b", "x y"]
    fixed = ["in spite of the", "New York city hall", "ha ha ha"]
    out = []
    for _ in range(texts):
        parts = []
        for _ in range(rng.randrange(0, 40)):
            parts.append(rng.choice(fixed) if rng.random() < 0.15 else rng.choice(words[: rng.choice((4, len(words)))]))
            parts.append(rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "; ", " ! ", "\r\n", "\x0b", " - "]))
        out.append(("".join(parts), rng.choice(["en", "en", "de", None, "und"])))
    return out


@pytest.mark.parametrize("seed,shard", [(1, 50), (2, 700), (3, 1 << 20)])
def test_equals_counting_by_hand(spark, seed, shard):
    rows = prose(seed, 300)
    assert got(spark, rows, least=8, shard_words=shard) == brute(rows, least=8)


def test_top_and_other_lengths(spark):
    rows = prose(4, 200)
    assert got(spark, rows, least=4, top=7, longest=3, shard_words=300) == brute(rows, least=4, top=7, longest=3)


def test_long_texts_are_cut_between_pieces(spark):
    one = ("a b c d e f. " * 400 + "\n") * 2
    unbroken = "p q r s t " * 3000
    rows = [(one, "en"), (unbroken, "en"), (one, "de")]
    assert got(spark, rows, shard_words=500) == brute(rows)


def test_nulls_blanks_empty_table_and_clashing_columns(spark):
    assert got(spark, [(None, "en"), ("", None), (" \t\n.,", "de")]) == set()
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [("so it goes", None)] * 120 + [("so it goes", "und")] * 3
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", shard int, N int, id int")
    found = phrases.collocations(docs)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [tuple(r) for r in found.collect()] == [("und", 1, "so it goes", 123, 123, 123, 369, 3000)]


@pytest.mark.parametrize("seed", range(6))
def test_index_counts_and_places(seed):
    rng = np.random.default_rng(seed)
    seq = np.concatenate((rng.integers(0, 5, 400), [0]))
    index = phrases.Index(np.concatenate(([0], seq)), 4)
    text = [0, *seq.tolist()]
    for size in (1, 2, 3, 4):
        patterns = rng.integers(1, 5, (40, size))
        low, high = index.search(patterns)
        for p, a, b in zip(patterns.tolist(), low, high, strict=True):
            places = [i for i in range(len(text) - size + 1) if text[i:i + size] == p]
            assert sorted(index.suffixes[a:b].tolist()) == places


@pytest.mark.parametrize("seed", range(6))
def test_growing_finds_all_longer_phrases_of_known_ones(seed):
    rng = np.random.default_rng(seed)
    seq = np.concatenate((rng.integers(0, 4, 300), [0]))
    text = seq.tolist()
    for size in (2, 3, 4, 5):
        place = {}
        for i in range(len(text) - size + 2):
            p = tuple(text[i:i + size - 1])
            if 0 not in p:
                place[p] = i
        known = [p for p in sorted(place) if rng.random() < 0.8]
        names, places, patterns = phrases.narrowed(seq, np.array(known).reshape(-1, size - 1))
        begin, end, number, at = phrases.grown(names, patterns)
        at = places[at]
        want = Counter(tuple(text[i:i + size]) for i in range(len(text) - size + 1))
        want = {p: c for p, c in want.items() if 0 not in p and p[:-1] in known and p[1:] in known}
        assert {tuple(text[a:a + size]): c for a, c in zip(at.tolist(), number.tolist(), strict=True)} == want
        assert all(known[b] == tuple(text[a:a + size - 1]) and known[e] == tuple(text[a + 1:a + size])
                   for b, e, a in zip(begin.tolist(), end.tolist(), at.tolist(), strict=True))


def test_packing_round_trip():
    seq = np.random.default_rng(1).integers(0, 1 << 30, 1000)
    assert (phrases.unpacked(phrases.packed(seq)) == seq).all()
    columns = np.random.default_rng(2).integers(-(1 << 62), 1 << 62, (4, 77))
    assert (phrases.columns_unpacked(phrases.columns_packed(*columns), 4) == columns).all()


@pytest.mark.parametrize("words", [40, 900])
def test_buckets_change_nothing(spark, monkeypatch, words):
    monkeypatch.setattr(phrases, "BUCKET_WORDS", words)
    rows = prose(5, 250)
    assert got(spark, rows, least=6, shard_words=400) == brute(rows, least=6)


def test_query_equals_counting_on_the_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang").collect()]
    assert {tuple(r) for r in op13_phrase_collocations(spark, SF).collect()} == brute(rows)

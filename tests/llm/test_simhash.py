"""SimHash components against fingerprints and links by hand."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillwatch.llm import simhash
from tillwatch.llm.queries import op12_gray_simhash

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def print_of(text):
    data = (text or "").encode()
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in data).split()
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints, most=3):
    """[component] over a list of (id, fingerprint), by all pairs."""
    parent = {i: i for i, _ in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (a, x) in enumerate(prints):
        for b, y in prints[:n]:
            if (x ^ y).bit_count() <= most:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return [root(i) for i, _ in prints]


def test_fingerprints_are_majorities(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "Bb", "é", "Ä", "x y"]) for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    texts += ["one", "one two", "one two three", "one TWO\tthree\x0bfour", " \n", "", "a b " * 20000]
    for t in texts:
        assert simhash.fingerprint(t.encode()) == print_of(t)
    df = spark.createDataFrame([("one two three",)], "s string")
    assert df.select(F.xxhash64("s")).first()[0] & (1 << 64) - 1 == simhash.fingerprint(b"one two three")


def families(seed, groups, members, flips):
    rng = random.Random(seed)
    prints = []
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(members):
            x = base
            for _ in range(rng.randrange(flips + 1)):
                x ^= 1 << rng.randrange(64)
            prints.append(x)
    rng.shuffle(prints)
    return prints


@pytest.mark.parametrize("seed,members,flips,limit", [(1, 6, 5, 4096), (2, 60, 9, 40), (3, 300, 4, 100), (4, 300, 30, 17)])
def test_index_table_links_what_all_pairs_link(spark, seed, members, flips, limit):
    prints = sorted(set(families(seed, 900 // members, members, flips)))
    rows = [(simhash.signed(x), k) for k, x in enumerate(prints)]
    classes = spark.createDataFrame(rows, "fingerprint long, rep long")
    links = simhash.linked(classes, limit=limit).collect()
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert [root(k) for k in range(len(rows))] == components_of(list(enumerate(prints)))


@pytest.mark.parametrize("seed,flips", [(1, 3), (2, 8), (3, 20)])
def test_gray_tree_equals_all_pairs(seed, flips):
    prints = sorted(set(families(seed, 4, 150, flips)))
    random.Random(seed).shuffle(prints)
    found = simhash.GrayIndex(np.array(prints, dtype=np.uint64)).connected(3)
    want = components_of(list(enumerate(prints)))
    assert len({(a, b) for a, b in zip(found.tolist(), want, strict=True)}) == len(set(want)) == len(set(found.tolist()))


def test_gray_rank_orders_the_reflected_code():
    code = np.array([k ^ (k >> 1) for k in range(1000)], dtype=np.uint64)
    assert simhash.gray_rank(code).tolist() == list(range(1000))


def test_blocks_cover_all_bits_once():
    first = simhash.parted(0, 4)
    assert sum(first) == (1 << 64) - 1 and all(m.bit_count() == 16 for m in first)
    assert all(m & first[0] == first[0] for m in simhash.parted(first[0], 4))


def test_nulls_blanks_ties_repeated_rows_and_clashing_columns(spark):
    docs = [(9, None), (8, ""), (7, " \t"), (5, "some words stand here now"), (4, "some WORDS stand here now"), (4, "some words stand here now"),
            (3, "other things lie there then"), (6, "other things lie there then"), (6, "a third text for one id"), (2, "a third text for one id"),
            (None, "a third text for one id"), (None, "nobody else has this one text")]
    df = spark.createDataFrame([(*d, 0, 1) for d in docs], SCHEMA + ", rep int, Fingerprint int")
    found = simhash.near_duplicates(df)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    rows = sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in found.where("doc_id is not null").collect())
    assert [(i, c) for i, _, c in rows] == [(2, 2), (3, 2), (4, 4), (4, 4), (5, 4), (6, 2), (6, 2), (7, 7), (8, 7), (9, 7)]
    assert all(p == "0" * 16 for i, p, _ in rows if i >= 7)
    assert sorted(str(r.component_id) for r in found.where("doc_id is null").collect()) == ["2", "None"]
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_all_pairs_on_the_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    prints = [(i, print_of(t)) for i, t in docs]
    want = {(i, f"{x:016x}", c) for (i, x), c in zip(prints, components_of(prints), strict=True)}
    assert {tuple(r) for r in op12_gray_simhash(spark, SF).collect()} == want

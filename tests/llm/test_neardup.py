"""Near-duplicates against all-pairs brute force."""

import random

import numpy as np
import pytest

from tillwatch.llm import neardup
from tillwatch.llm.queries import op3_near_duplicates
from tillwatch.llm.textkit import shingle_sets

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def sets_of(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + size]) for k in range(len(words) - size + 1)}


def brute(docs, size=4, percent=80):
    """{doc_id: component} over rows of (doc_id, text), by comparing all pairs."""
    sets = [(i, sets_of(t, size)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            shared = len(x & y)
            if shared and 100 * shared >= percent * (len(x) + len(y) - shared):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in parent}


def near_copies(seed=3, groups=12, copies=9):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    docs = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((3, 8, 40, 200)))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 6))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append(" ".join(words))
    rng.shuffle(docs)
    return list(enumerate(docs))


def found(spark, docs, **options):
    return {(r.doc_id): r for r in neardup.near_duplicates(spark.createDataFrame(docs, SCHEMA), **options).collect()}


def test_components_equal_all_pairs(spark):
    docs = near_copies()
    got, want = found(spark, docs), brute(docs)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == want[i]) for i, r in got.items())
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(sets_of(t, 4)) for i, t in docs}


def test_one_hot_group_of_near_copies_is_one_component(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    docs = []
    for k in range(150):
        words = list(base)
        words[rng.randrange(120)] = f"x{k}"
        docs.append((k, " ".join(words)))
    docs += [(1000 + k, " ".join(f"y{rng.randrange(5000)}" for _ in range(100))) for k in range(80)]
    got = found(spark, docs)
    assert {r.component_id for i, r in got.items() if i < 1000} == {0}
    assert all(r.kept for i, r in got.items() if i >= 1000)


def test_nulls_blanks_case_ties_and_repeated_rows(spark):
    long = " ".join(f"t{k}" for k in range(30000))
    docs = [
        (9, None), (8, ""), (7, " \t\n"), (6, "One two"), (5, "one TWO"), (4, "one two"), (4, "one two"),
        (3, long), (2, long + " end"), (None, "one two"), (None, "alone without an id here"), (1, "Éa b c d"), (0, "éa b c d"),
    ]
    rows = neardup.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()
    assert len(rows) == len(docs)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[i][0].component_id == i and by[i][0].kept and by[i][0].n_shingles == 0 for i in (7, 8, 9))
    assert [r.component_id for i in (4, 5, 6) for r in by[i]] == [4, 4, 4, 4]
    assert [r.kept for r in by[4]] == [True, True] and not by[6][0].kept
    assert by[3][0].component_id == by[2][0].component_id == 2
    assert sorted((r.component_id, r.kept) for r in by[None] if r.component_id) == [(4, False)]
    assert [r.kept for r in by[None] if r.component_id is None] == [True]
    assert by[0][0].component_id == 0 and by[1][0].component_id == 1  # only A to Z are lowered


def test_texts_of_one_id_tie_their_groups(spark):
    docs = [(5, "a b c d e f"), (5, "p q r s t u"), (3, "a b c d e f"), (2, "p q r s t u"), (1, "other words stand here now")]
    rows = neardup.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(5, 2), (3, 2), (2, 2), (1, 1)}


def test_empty_table_and_clashing_columns(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(1, "a b c d e", 5, 6), (2, "a b c d e", 5, 6)], SCHEMA + ", component_id int, Band int")
    assert sorted(tuple(r) for r in neardup.near_duplicates(docs).collect()) == [(1, 2, 1, True), (2, 2, 1, False)]


def test_sketches_merge_and_estimate():
    a, b = (shingle_sets([" ".join(f"{p}{k}" for k in range(n)).encode()], 1)[0] for p, n in (("u", 700), ("v", 500)))
    both = np.union1d(a, b)
    assert (neardup.merge(neardup.registers(a), neardup.registers(b)) == neardup.registers(both)).all()
    true = len(a) / len(both)
    one = neardup.likeliest(neardup.registers(a)[None], neardup.registers(both)[None], np.array([len(a)]), np.array([len(both)]))
    assert abs(one[0] - true) < 0.12
    assert neardup.registers(a[:0]).max() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_shingle_hashes_keep_equality(seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["a", "B", "b", "cé", "d.", " x"]) for _ in range(rng.randrange(0, 9))) for _ in range(200)]
    got = shingle_sets([t.encode() for t in texts], 3)
    want = [sets_of(t, 3) for t in texts]
    for k in range(0, 200, 7):
        for m in range(k, 200, 11):
            assert len(np.intersect1d(got[k], got[m])) == len(want[k] & want[m])


def test_query_equals_all_pairs_on_the_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.component_id for r in op3_near_duplicates(spark, SF).collect()}
    assert got == brute(docs)

"""Toxicity, language and quality: held-out accuracy, gradients of the data, odd rows."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwatch.llm import langid, quality, toxicity
from tillwatch.llm.queries import op4_toxicity_cnn, op8_quality_bayes, op9_language_id
from tillwatch.llm.textkit import Lookup, words_of

SF = "/root/testdata/sf0.01"
BAD = ["clown", "moron", "trash"]


def toxic_rows(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 120))]
        label = int(rng.random() < 0.3)
        for _ in range(rng.randrange(1, 4) * label):
            words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ".", "s"]))
        rows.append((k, " ".join(words), label, rng.choice(["en", "de"])))
    return rows


@pytest.fixture(scope="module")
def network():
    return toxicity.fit(pd.DataFrame(toxic_rows(700), columns=["doc_id", "text", "label", "lang"]))


def test_network_finds_toxic_texts_it_has_not_seen(network):
    rows = toxic_rows(300, seed=9)
    x = toxicity.logits(network, [t.encode() for _, t, _, _ in rows])
    score = toxicity.sigmoid(network.slope * x + network.offset)
    label = np.array([r[2] for r in rows])
    assert ((score >= 0.5) == label).mean() > 0.95
    assert set(network.thresholds) <= {"en", "de"}


def test_score_of_a_text_does_not_depend_on_its_batch(network):
    texts = [t.encode() for _, t, _, _ in toxic_rows(40, seed=3)] + [b"", b" \n"]
    together = toxicity.logits(network, texts)
    alone = np.concatenate([toxicity.logits(network, [t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-4)


def plain_logit(network, text):
    """The network on one text, word by word and filter by filter."""
    vectors = dict(zip(network.keys.tolist(), network.vectors[:-1].astype(float), strict=True))
    words = [w for w in text.encode().split() if w]
    zero = np.zeros(network.vectors.shape[1])
    embedded = [sum((vectors.get(int(h), zero) for h in toxicity.features(words_of([w]))[:, 0]), zero) for w in words]
    pooled = []
    for weights, bias in zip(network.filters, network.biases, strict=True):
        for f in range(weights.shape[2]):
            peak = 0.0
            for at in range(len(words)):
                inside = [embedded[at + k] @ weights[k, :, f] for k in range(len(weights)) if at + k < len(words)]
                peak = max(peak, sum(inside) + bias[f])
            pooled.append(peak)
    return float(np.dot(pooled, network.out) + network.bias)


def test_scores_equal_a_plain_forward_pass(spark, network):
    texts = [t for _, t, _, _ in toxic_rows(25, seed=11)] + ["", " ", "clown", "you moron", "trash.\nclowns\tw1"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, network, lang=None).collect()}
    for i, text in enumerate(texts):
        want = 1 / (1 + np.exp(-(network.slope * plain_logit(network, text) + network.offset)))
        assert got[i] == pytest.approx(want, abs=1e-4), text


def test_toxicity_of_odd_rows(spark, network):
    docs = spark.createDataFrame(
        [(1, None, "en", 7), (2, "", None, 7), (2, "", None, 7), (None, "you clown clown moron", "xx", 7), (3, "fine words " * 60000, "en", 7)],
        "doc_id long, text string, lang string, Score int")
    rows = toxicity.score(docs, network).collect()
    assert len(rows) == 5 and all(0 <= r["_score"] <= 1 and r.Score == 7 for r in rows)
    assert rows[0]["_score"] == rows[1]["_score"] == rows[2]["_score"]
    assert rows[3]["_score"] > rows[4]["_score"] and rows[3]["limit"] == 0.7
    assert toxicity.score(docs.limit(0), network).count() == 0


def test_toxicity_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, None, None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1)], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert [round(r.score, 3) for r in rows] == [0.01, 0.01]


def test_every_labelled_text_is_trained_on_and_counted(spark):
    rows = toxic_rows(4000, seed=5)
    docs = spark.createDataFrame([(k, t, g) for k, t, _, g in rows] + [(k + 10**6, t, g) for k, t, _, g in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, y) for k, _, y, _ in rows] + [(7, 1), (7, 0)], "doc_id int, toxic int")
    found = {r.doc_id: (r.text, r.label) for r in toxicity.labelled(docs, labels, "toxic", F.col("doc_id") != 9).collect()}
    assert found == {k: (t, y) for k, t, y, _ in rows if k not in (7, 9)}
    data = spark.createDataFrame([(t, y, g) for _, t, y, g in rows], "text string, label int, lang string")
    share = sum(y for _, _, y, _ in rows) / len(rows)
    keys, links = toxicity.telling_features(data.repartition(5), share, 4, 10**6)
    every, n, bad = toxicity.feature_counts([t.encode() for _, t, _, _ in rows], np.array([y for _, _, y, _ in rows]))
    assert keys.tolist() == every[n >= 4].tolist() and np.allclose(links, toxicity.link(n, bad, share)[n >= 4])
    few, strong = toxicity.telling_features(data, share, 4, 50)
    assert 0 < len(few) <= 50 and np.abs(strong).min() >= np.sort(np.abs(links))[-50] - 0.01
    network = toxicity.fit(pd.DataFrame(rows[:300], columns=["doc_id", "text", "label", "lang"]))
    assert toxicity.counted_logits(data, network)["n"].sum() == len(rows)


def test_tasks_are_averaged_into_one_network(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TASK_ROWS", 300)
    rows = toxic_rows(4000, seed=5)
    docs = spark.createDataFrame([(k, t, g) for k, t, _, g in rows], "doc_id long, text string, lang string")
    held = toxicity.averaged_round
    tasks = []
    monkeypatch.setattr(toxicity, "averaged_round", lambda own, *rest: (tasks.append(own.rdd.getNumPartitions()), held(own, *rest)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        network = toxicity.train(docs, spark.createDataFrame([(k, y) for k, _, y, _ in rows], "doc_id long, toxic int"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert min(tasks) > 1
    new = toxic_rows(500, seed=9)
    score = toxicity.sigmoid(network.slope * toxicity.logits(network, [t.encode() for _, t, _, _ in new]) + network.offset)
    assert ((score >= 0.5) == np.array([y for _, _, y, _ in new])).mean() > 0.97 and set(network.thresholds) == {"en", "de"}


def test_toxicity_query_on_held_out_documents(spark):
    rows = {r.doc_id: r for r in op4_toxicity_cnn(spark, SF).collect()}
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert set(rows) == docs
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(r.predicted == int(r.score >= 0.7) for r in rows.values())
    labels = [(r.toxic, rows[r.doc_id].score) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if rows[r.doc_id].held_out]
    bad, good = [s for t, s in labels if t], [s for t, s in labels if t == 0]
    assert np.mean([b > g for b in bad for g in good]) > 0.85  # a few hundred labels train this one


def test_language_of_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op9_language_id(spark, SF).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97


def test_language_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(k, t, c) for k, (t, c) in enumerate([("the cat and the dog sat", "en"), ("der hund und die katze", "de")] * 20)],
        "doc_id long, text string, lang string")
    model = langid.train(docs)
    odd = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, "123 !? ☃", 0), (4, "der hund " * 50000, 0), (None, "the DOG", 0), (5, "中文", 0)],
        "doc_id long, text string, ACCEPTED int")
    rows = langid.predict(odd, model).collect()
    assert [r.lang_pred for r in rows[:3]] == ["und"] * 3 and [r.score for r in rows[:3]] == [0.0] * 3
    assert rows[3].lang_pred == "de" and rows[4].lang_pred == "en" and rows[5].lang_pred in ("de", "en")
    assert not any(r["_accepted"] for r in rows[:3])
    assert langid.predict(odd.limit(0), model).count() == 0
    none = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, none).collect()} == {"und"}


def test_language_scores_do_not_depend_on_the_batch(spark):
    model = langid.fit(pd.DataFrame({"text": ["the cat", "der hund"] * 10, "lang": ["en", "de"] * 10}))
    texts = ["a cat", "und der", "x", "die katze the"]
    both = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = [r.score for r in langid.predict(both, model).collect()]
    want = [float(langid.softmax(langid.raw(model, b) / model.temperature).max()) for b in langid.bags(texts)]
    assert np.allclose(got, want, atol=1e-5)


def test_lookup_and_word_hashes():
    found = words_of([b"Abc abc ABD x", b"", b"abc"])
    words = found.words()
    assert words[0] == words[1] == words[4] and len(set(words.tolist())) == 3
    assert found.prefixes(2)[0] == found.prefixes(2)[2]
    keys = np.unique(words)
    lookup = Lookup(keys)
    assert (keys[lookup(words)] == words).all()
    assert lookup(np.array([12345], dtype=np.uint64))[0] == len(keys)


def test_site_posteriors_by_hand(spark):
    rows = [("a", "x", 1)] * 8 + [("a", "y", 0)] * 2 + [("b", None, 0)] * 4 + [(None, "x", 1)]
    hosts, paths, mean, inner = quality.posteriors(spark.createDataFrame(rows, "host string, path string, good int"), "host", "path")
    assert mean == pytest.approx(10 / 17)
    means = {r.host: r.host_mean for r in hosts.collect()}
    assert means["a"] > mean > means["b"] and means[None] > mean
    own = {(r.host, r.path): r.path_mean for r in paths.collect()}
    assert own[("a", "x")] == pytest.approx((8 + inner * means["a"]) / (8 + inner))
    assert own[("a", "x")] > means["a"] > own[("a", "y")]


def plain_statistics(text):
    import regex

    n, space = max(len(text), 1), r"[ \t\n\x0b\f\r]"
    words, lines = regex.split(space + "+", text), text.split("\n")
    return [
        min(np.log1p(len(text)) / 10, 1.5), len(regex.findall(r"[^\p{L}\p{N} \t\n\x0b\f\r.,;:!?'\"()-]", text)) / n,
        len(regex.findall(r"\p{Lu}", text)) / n, len(regex.findall(r"\p{N}", text)) / n, sum(c in "!?|" for c in text) / n,
        len(set(words)) / len(words), len(set(lines)) / len(lines), min(n / len(words) / 20, 2.0), min(len(lines) / len(words), 1.0)]


def plain_weight(groups):
    """Method of moments over (good, n, mean) of groups of two or more."""
    some = [(g, n, m) for g, n, m in groups if n >= 2]
    if len(some) < 2:
        return 10.0
    spread = sum((g - n * m) ** 2 / n for g, n, m in some)
    single, weighted = sum(m * (1 - m) for _, _, m in some), sum(n * m * (1 - m) for _, n, m in some)
    rho = (spread - single) / (weighted - single)
    return float(np.clip(1 / rho - 1, 1, 1000)) if rho > 0 else 1000.0


def test_quality_scores_equal_a_plain_computation(spark):
    from collections import Counter

    rng = random.Random(8)
    rows = []
    for i in range(400):
        host, path = rng.choice(["a", "a", "a", "b", "c", None]), rng.choice(["x", "y", None])
        good = rng.random() < {"a": 0.8, "b": 0.2}.get(host, 0.5)
        words = [rng.choice(["Haus", "tree", "Fluß", "go"]) if good or rng.random() < 0.6 else rng.choice(["!!!", "9|9", "BUY", "$$"])
                 for _ in range(rng.randrange(3, 60))]
        rows.append((i, host, path, rng.choice([" ", "\n"]).join(words), int(good)))
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, source string, lang string, text string")
    known = [r for r in rows if r[0] % 3]
    labels = spark.createDataFrame([(r[0], r[4]) for r in known], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score(docs, labels).collect()}

    x = np.array([plain_statistics(r[3]) for r in known])
    y = np.array([r[4] for r in known], float)
    w, mean, spread = quality.fit_logistic(x, y)
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    slope = z.T @ (1 / (1 + np.exp(-z @ w)) - y) + np.array([1.0] * quality.N_STATISTICS + [1e-6]) * w
    assert np.abs(slope).max() < 1e-6  # the fit is the optimum of the penalised likelihood
    good, n = Counter(), Counter()
    for _, host, path, _, label in known:
        for cell in (host, (host, path)):
            n[cell] += 1
            good[cell] += label
    overall = (y.sum() + 1) / (len(y) + 2)
    hosts = [c for c in n if not isinstance(c, tuple)]
    weight = plain_weight([(good[h], n[h], overall) for h in hosts])
    site = {h: (good[h] + weight * overall) / (n[h] + weight) for h in hosts}
    cells = [c for c in n if isinstance(c, tuple)]
    inner = plain_weight([(good[c], n[c], site[c[0]]) for c in cells])
    site.update({c: (good[c] + inner * site[c[0]]) / (n[c] + inner) for c in cells})
    base = np.log(y.mean() / (1 - y.mean()))
    for i, host, path, text, _ in rows:
        prior = site.get((host, path), site.get(host, overall))
        odds = (np.array(plain_statistics(text)) - mean) / spread @ w[:-1] + w[-1] - base + np.log(prior / (1 - prior))
        assert got[i].site_prior == pytest.approx(prior, rel=1e-9)
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-np.clip(odds, -30, 30))), abs=1e-6)


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, 1), (2, "", "s", "en", 1), (2, "", "s", "en", 1), (None, "a b", "s", None, 1), (3, "word " * 100000, "t", "de", 1)],
        "doc_id long, text string, source string, lang string, Evidence int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    rows = quality.score(docs, labels).collect()
    assert len(rows) == 5 and all(0 < r.score < 1 for r in rows)
    assert {r.score for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(docs.limit(0), labels).count() == 0


def test_quality_query_keeps_good_documents(spark):
    rows = {r.doc_id: r for r in op8_quality_bayes(spark, SF).collect()}
    held = [(r.quality, rows[r.doc_id].keep) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert np.mean([bool(q) == k for q, k in held]) > 0.95

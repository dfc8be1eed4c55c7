"""The corpus pipeline: each stage's decisions against its operator or brute force, odd rows, registration."""

import __spark_entry__ as entry
import corpus_pipeline as pipeline
import pytest

from test_neardup import brute

SF = "/root/testdata/sf0.001"


def test_stages_are_registered_with_all_operators():
    names = set(entry.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "secrets", "mix"]


def test_each_stage_works_on_what_its_predecessor_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for number, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        rows = docs.collect()
        if name != "mix":
            assert docs.columns == columns
            now = {r.doc_id: r.text for r in rows}
            assert len(now) == len(rows)
        if name == "toxicity":
            assert sum(i not in now and labels.get(i) == 0 for i in kept) <= 2
        if name == "near_dedup":
            want = brute(list(kept.items()), size=5)
            assert set(now) == {i for i in kept if want[i] == i}
        if name == "decontaminate":
            clean = {i for i, t in kept.items() if not any(x in " ".join(t.lower().split()) for x in items)}
            assert set(now) <= clean and len(clean - set(now)) <= 2
        if name == "secrets":
            assert set(now) == set(kept)
            assert all(now[i] == kept[i] or "[SECRET]" in now[i] for i in now)
            assert all(len(r.text) == r.n_chars for r in rows)
        kept = now if name != "mix" else kept
    assert {r.doc_id for r in rows} == set(kept)


@pytest.mark.parametrize("name", ["near_dedup", "decontaminate", "secrets"])
def test_stages_on_odd_rows(spark, name):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b c", "en", None, 5), (3, "word " * 50000, "en", "s", 250000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(pipeline.STAGES)[name]
    assert stage(spark, docs, SF).columns == docs.columns
    assert stage(spark, docs, SF).count() == (4 if name == "near_dedup" else 5)
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_toxicity_and_mix_on_odd_rows(spark):
    rows = [(1, None, None, None, None, 1), (2, "", "en", "s", 0, 2), (2, "", "en", "s", 0, 2), (None, "a b c", "en", None, 5, 3), (3, "word " * 50000, "en", "s", 250000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, Score int")
    stages = dict(pipeline.STAGES)
    kept = stages["toxicity"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == 5
    mixed = stages["mix"](spark, docs, SF)
    assert mixed.columns == ["doc_id", "source", "tokens", "epoch", "block", "block_key", "doc_key"]
    assert {(r.doc_id, r.tokens) for r in mixed.collect()} >= {(None, 3), (3, 50000)}
    for name in ("toxicity", "mix"):
        assert stages[name](spark, docs.limit(0), SF).count() == 0


def test_secrets_stage_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "password=hunter2hunter2 x", "en", "s", 25, 1, 2, 3)],
                                 "doc_id long, text string, lang string, source string, n_chars long, __added int, linked int, row int")
    found = pipeline.secrets_stage(spark, docs, SF)
    assert found.columns == docs.columns and "[SECRET]" in found.first()["text"]


def test_one_row_of_equal_documents_stays(spark):
    docs = spark.createDataFrame([(k // 2, "one two three four five six", "en", "s", 27) for k in range(6)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in pipeline.near_dedup_stage(spark, docs, SF).collect()] == [0]


def test_run_returns_the_mixture(spark):
    rows = pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "source", "tokens", "epoch", "block", "block_key", "doc_key"]
    assert rows.count() >= rows.select("doc_id").distinct().count() > 100

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, cash, rows
from tillwatch.sources import reports
from tillwatch.sources.tables import CatalogTable, FileTable, JdbcCuts, JdbcSplit, JdbcTable, Tables, quantile_cuts, read_table


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def small(frame, *names):
    return frame("name string, amount money", [(name, cash("1.50")) for name in names])


def test_publish_replaces_the_whole_report(spark, frame, root):
    assert reports.publish(small(frame, "a", "b"), "r", root, order=["name"]) == 2
    assert reports.publish(small(frame, "c"), "r", root) == 1
    assert rows(reports.read_report(spark, "r", root)) == [("c", 1.5)]


def test_rows_are_published_in_order(spark, frame, root):
    names = [f"n{n:03d}" for n in range(200)]
    reports.publish(small(frame, *names).repartition(4), "r", root, order=[F.desc("name")])
    found = [row["name"] for row in reports.read_report(spark, "r", root).collect()]
    assert found == names[::-1]


def test_an_empty_result_follows_its_policy(spark, frame, root):
    reports.publish(small(frame, "old"), "r", root)
    empty = small(frame)
    assert reports.publish(empty, "r", root) == 0
    assert rows(reports.read_report(spark, "r", root)) == [("old", 1.5)]
    assert reports.publish(empty, "r", root, on_empty="zero_row") == 1
    assert rows(reports.read_report(spark, "r", root)) == [("0", 0.0)]
    assert reports.publish(empty, "r", root, on_empty="replace") == 0
    assert rows(reports.read_report(spark, "r", root)) == []
    with pytest.raises(ValueError):
        reports.publish(empty, "r", root, on_empty="guess")


def test_a_failed_run_leaves_the_old_report(spark, frame, root):
    reports.publish(small(frame, "old"), "r", root)
    broken = small(frame, "new").selectExpr("name", "1 / (length(name) - 3) as amount")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        reports.publish(broken, "r", root)
    assert rows(reports.read_report(spark, "r", root)) == [("old", 1.5)]


@pytest.mark.parametrize(("shared", "path", "fine"), [
    ("file:///mnt/all", "file:///mnt/all/work-1/polled", True), ("/mnt/all/", "file:///mnt/all/r", True), ("file:///mnt/all", "/mnt/all", True),
    ("file:///mnt/all", "file:///mnt/aller/r", False), ("file:///mnt/all", "/mnt/all/../own/r", False), ("hdfs://n/mnt/all", "/mnt/all/r", False),
    (None, "/mnt/all/r", False), ("", "/mnt/all/r", False),
])
def test_a_cluster_takes_local_folders_in_the_shared_one_alone(spark, shared, path, fine):
    conf = {"spark.master": "local-cluster[3,2,3000]"} | ({} if shared is None else {"spark.checkpoint.dir": shared})
    cluster = SimpleNamespace(conf=conf, _jvm=spark._jvm, _jsc=spark._jsc)
    if fine:
        assert reports._Folder(cluster, path).markers() == []
    else:
        with pytest.raises(ValueError, match="all executors share"):
            reports._Folder(cluster, path)


def leftovers(root):
    return len(list(Path(root, "r", "versions").iterdir()))


def test_a_failure_after_some_rows_are_written_leaves_the_old_report(spark, frame, root):
    reports.publish(small(frame, "old"), "r", root)
    rows_ok = spark.range(0, 1000, 1, 4).selectExpr("cast(id as string) as name", "id as n")
    broken = rows_ok.selectExpr("name", "1 / (n - 900) as amount")  # the last task of the write fails
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        reports.publish(broken, "r", root)
    assert rows(reports.read_report(spark, "r", root)) == [("old", 1.5)]
    assert leftovers(root) == 1


def test_a_reader_sees_the_old_report_until_the_new_one_is_whole(spark, frame, root):
    reports.publish(small(frame, "old"), "r", root)
    before = reports.read_report(spark, "r", root)
    reports.publish(small(frame, "new"), "r", root)
    assert rows(before) == [("old", 1.5)]  # opened before, still readable
    assert rows(reports.read_report(spark, "r", root)) == [("new", 1.5)]
    reports.publish(small(frame, "newer"), "r", root)
    assert leftovers(root) == 2


def test_two_runs_at_once_do_not_meet(spark, frame, root):
    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(reports.publish, small(frame, *[n] * 50).repartition(3), "r", root) for n in "ab"]
        assert [run.result() for run in runs] == [50, 50]
    found = rows(reports.read_report(spark, "r", root))
    assert found in ([("a", 1.5)] * 50, [("b", 1.5)] * 50)


def test_normalise_writes_dates_as_text_and_keeps_times(frame):
    df = frame("d date, t ts, m money, n long", [(date(2024, 3, 1), AS_OF, cash("2.50"), 3)])
    assert rows(reports.normalise(df)) == [("2024-03-01", AS_OF, 2.5, 3)]


def test_label_union_matches_columns_by_name(frame):
    one = frame("a long, b string", [(1, "x")])
    two = frame("b string, a long", [("y", 2)])
    assert rows(reports.label_union({"first": one, "second": two})) == [
        ("first", 1, "x"), ("second", 2, "y"),
    ]


def test_amounts_are_grouped_by_column_name(frame):
    df = frame("zero long, amount money", [(0, cash("0")), (1, cash("1234567.5"))])
    assert rows(reports.with_grouped_digits(df, "amount")) == [(0, "0"), (1, "1,234,568")]


def test_csv_reports_are_read_with_their_header(spark, frame, root):
    small(frame, "a").write.option("header", "true").csv(f"{root}/r")
    assert rows(reports.read_report(spark, "r", root, format="csv")) == [("a", "1.50")]


def test_measure_definitions(spark):
    found = reports.measure_definitions(spark)
    assert found.columns == ["service", "measure"] and found.count() == 4


def test_tables_open_each_source_once(spark, frame, root):
    small(frame, "a").write.parquet(f"{root}/t")
    small(frame, "b").createOrReplaceTempView("tillwatch_view")
    direct = small(frame, "c")
    tables = Tables(spark, {
        "file": FileTable(f"{root}/t"), "view": CatalogTable("tillwatch_view"), "direct": direct,
    })
    assert [tables[name].first()["name"] for name in tables] == ["a", "b", "c"]
    assert tables["file"] is tables["file"] and tables["direct"] is direct and len(tables) == 3
    csv = FileTable(f"{root}/t", options={"mergeSchema": "false"})
    assert read_table(spark, csv).count() == 1


def test_jdbc_options_split_the_table():
    split = JdbcSplit("create_date", datetime(2024, 1, 1), datetime(2024, 2, 1), 64)
    table = JdbcTable(
        "jdbc:postgresql://host/db", "public.fact", split, credentials={"user": "u", "password": "p"}
    )
    assert table.options() == {
        "url": "jdbc:postgresql://host/db", "dbtable": "public.fact", "fetchsize": "10000",
        "preferTimestampNTZ": "true", "user": "u", "password": "p",
        "partitionColumn": "create_date", "lowerBound": "2024-01-01 00:00:00",
        "upperBound": "2024-02-01 00:00:00", "numPartitions": "64",
    }
    assert "password" not in repr(table)
    mysql = JdbcTable("jdbc:mysql://host/db", "messages").options()
    assert mysql["useCursorFetch"] == "true" and "partitionColumn" not in mysql


def test_a_read_report_keeps_its_order_over_several_files(spark, tmp_path):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("n"), F.lit("x").alias("label"))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        reports.publish(df, "sorted", str(tmp_path), order=[F.desc("n")])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    found = reports.read_report(spark, "sorted", str(tmp_path))
    assert len(list((tmp_path / "sorted" / "versions").glob("*/part-*"))) > 2
    assert found.columns == ["n", "label"] and [r.n for r in found.collect()] == list(range(4999, -1, -1))
    assert reports.publish(df.limit(0), "zero", str(tmp_path), order=["n"], on_empty="zero_row") == 1
    assert [tuple(r) for r in reports.read_report(spark, "zero", str(tmp_path)).collect()] == [(0, "0")]


def test_cuts_of_skewed_ids_fill_the_parts_evenly(spark):
    skewed = spark.range(20_000).select(F.when(F.col("id") < 15_000, F.col("id")).otherwise(F.col("id") * 1_000_000).alias("id"))
    cuts = quantile_cuts(skewed, "id", 8)
    conditions = cuts.conditions()
    counts = [skewed.filter(c).count() for c in conditions]
    assert len(conditions) == 8 and sum(counts) == 20_000 and max(counts) < 1.1 * 2500
    hot = spark.range(900).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("id")).unionByName(spark.sql("select cast(null as long) id"))
    conditions = quantile_cuts(hot, "id", 6).conditions()
    assert [hot.filter(c).count() > 0 for c in conditions] == [True] * len(conditions)
    assert sum(hot.filter(c).count() for c in conditions) == 901
    assert quantile_cuts(hot, "id", 1).conditions() == quantile_cuts(hot.limit(0), "id", 5).conditions() == ["1 = 1"]
    times = JdbcCuts("at", [datetime(2024, 1, 2), datetime(2024, 1, 1)])
    assert times.conditions()[1] == "at >= '2024-01-01 00:00:00' AND at < '2024-01-02 00:00:00'"
    table = JdbcTable("jdbc:postgresql://host/db", "public.log", cuts)
    assert "partitionColumn" not in table.options()

import uuid
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, cash, rows
from tillwatch.operators.health import status_roles
from tillwatch.streaming.live import checkpoint_location, live_status, publish_stream

SCHEMA = "create_date timestamp_ntz, status string, amount decimal(18,2), operator string"


def test_stream_windows_equal_the_batch_counts(spark, frame, tmp_path):
    def batch(first, count):
        return frame("create_date ts, status string, amount money, operator string", [
            (AS_OF + timedelta(minutes=n), ("SUCCESS", "FAILED", "ODD")[n % 3], cash("1"), "AB"[n % 2])
            for n in range(first, first + count)
        ])

    # Progress may be kept in a folder that outlives this test, so the name is used once only.
    source, out, name = f"{tmp_path}/in", f"{tmp_path}/out", f"live_{uuid.uuid4().hex}"
    batch(0, 40).write.parquet(source)

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        windows = live_status(stream, status_roles(), by=("operator",), slide=timedelta(minutes=30),
                              lateness=timedelta(minutes=5))
        query = publish_stream(
            windows, name, out, checkpoint_root=f"{tmp_path}/progress", once=True
        )
        query.awaitTermination()

    run()
    batch(40, 60).write.mode("append").parquet(source)
    run()  # goes on where the first run stopped
    found = spark.read.parquet(f"{out}/{name}")
    everything = spark.read.parquet(source).groupBy(
        F.window(F.col("create_date").cast("timestamp"), "30 minutes").alias("w"), "operator"
    ).agg(
        F.count_if(F.col("status") == "SUCCESS").alias("success"),
        F.count_if(F.col("status") == "ODD").alias("dispute"),
    )
    # The newest window stays open until its rows have settled.
    last = found.agg(F.max("window_end")).first()[0]
    closed = everything.filter(F.col("w.end") <= F.lit(last)).select(
        "w.start", "w.end", "operator", "success", "dispute"
    )
    assert rows(found.select("window_start", "window_end", "operator", "success", "dispute")) == rows(closed)
    assert found.count() >= 6


def test_a_late_row_counts_within_the_lateness_and_is_dropped_beyond_it(spark, frame, tmp_path):
    schema = "create_date ts, status string, amount money, operator string"

    def row(minutes):
        return (AS_OF + timedelta(minutes=minutes), "SUCCESS", cash("1"), "A")

    def first_window(lateness):
        root = f"{tmp_path}/{lateness}"
        for batch in ([row(5), row(50)], [row(6)], [row(200)]):  # the second row of the window comes late
            frame(schema, batch).write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
            windows = live_status(stream, status_roles(), slide=timedelta(minutes=30), lateness=timedelta(minutes=lateness))
            publish_stream(windows, f"late_{lateness}_{uuid.uuid5(uuid.NAMESPACE_URL, root).hex}", f"{root}/out",
                           checkpoint_root=f"{root}/progress", once=True).awaitTermination()
        found = spark.read.parquet(f"{root}/out/*").orderBy("window_start").first()
        return found["success"]

    assert first_window(60) == 2
    assert first_window(5) == 1


class Session:
    def __init__(self, folder):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}


def test_progress_belongs_to_the_shared_folder():
    assert checkpoint_location(Session("/cluster/"), "live", "/own") == "/cluster/live"
    assert checkpoint_location(Session(None), "live", "/own") == "/own/live"
    with pytest.raises(ValueError):
        checkpoint_location(Session(None), "live")

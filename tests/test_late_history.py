"""A stream of changes in any order against the intervals of the whole log."""

import random

import pytest
from pyspark.sql import functions as F

from lexstrata.operators import versions as V
from lexstrata.plans import catalog
from lexstrata.streaming import history as H

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    yield spark
    spark.conf.set(PROVIDER, before)


def run(spark, batches, schema, folder, late="4000 days"):
    """The corrections that batches of rows give, one after the other; and the query's last progress."""
    (folder / "in").mkdir()
    stream = spark.readStream.schema(schema).parquet(str(folder / "in"))
    q = H.interval_corrections(stream, late).writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(folder / "ck")).start(str(folder / "out"))
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder / "in"))
        q.processAllAvailable()
    progress = q.lastProgress
    q.stop()
    return spark.read.parquet(str(folder / "out")), progress


SCHEMA = "user_id bigint, k bigint, ts timestamp, event_id bigint, action string, cents bigint"


def wanted(log):
    return {tuple(r) for r in V.intervals(log, ["user_id", "k"], ["ts", "event_id"], "ts", "action", "cents").collect()}


def test_any_order_of_arrival_gives_the_intervals(rocks, sf_dir, tmp_path):
    log = catalog.change_log(rocks, sf_dir).select("user_id", "k", F.col("ts").cast("timestamp").alias("ts"), "event_id", "action", "cents").where("k is not null")
    log = log.withColumn("k", F.col("k") % 2)  # keys of many changes
    rows = [tuple(r) for r in log.collect()]
    random.Random(3).shuffle(rows)
    third = len(rows) // 3 + 1
    got, _ = run(rocks, [rows[:third], rows[third : 2 * third], rows[2 * third :] + rows[:20]], log.schema, tmp_path)
    assert {tuple(r) for r in H.settled(got).collect()} == wanted(log)
    assert H.corrected_often(got).count() > 0
    assert got.count() == got.select("user_id", "k", "revision").distinct().count()


def day(n):
    import datetime

    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)


def test_a_late_change_corrects_only_its_neighbour(rocks, tmp_path):
    first = [(1, 1, day(0), 0, "POST", 10), (1, 1, day(10), 1, "PUT", 20), (1, 1, day(20), 2, "DELETE", None)]
    got, _ = run(rocks, [first, [(1, 1, day(5), 3, "PUT", 15)], [(1, 1, day(6), 4, "KEEP", 1)]], SCHEMA, tmp_path)
    late = got.where("revision > 3").orderBy("revision").collect()
    assert [(r["valid_from"], r["valid_to"], r["value"]) for r in late] == [(day(0), day(5), 10), (day(5), day(10), 15)]
    assert {(r["valid_from"], r["valid_to"], r["value"]) for r in H.as_known(got, 3).collect()} == {(day(0), day(10), 10), (day(10), day(20), 20)}
    assert {(r["valid_from"], r["valid_to"], r["value"]) for r in H.settled(got).collect()} == {(day(0), day(5), 10), (day(5), day(10), 15), (day(10), day(20), 20)}


def test_state_does_not_grow_with_the_stream(rocks, tmp_path):
    """Changes a day apart, ten a batch, late by two days at most: old ones leave the state, and the history is whole."""
    batches = [[(1, 1, day(10 * b + i), 10 * b + i, "PUT", i) for i in range(10)] for b in range(6)]
    got, progress = run(rocks, batches, SCHEMA, tmp_path, "2 days")
    log = rocks.createDataFrame([r for b in batches for r in b], SCHEMA)
    assert {tuple(r) for r in H.settled(got).collect()} == wanted(log)
    held = progress.stateOperators[0].numRowsTotal
    assert held < 30, held

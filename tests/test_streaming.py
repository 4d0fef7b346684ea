"""A stream of files: windows are written once, late comments are dropped, a run goes on where it stood."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from colloquy.streaming import rates
from tests.conftest import rows

SCHEMA = "at timestamp, community string, flag long"
DAY = datetime(2024, 3, 1)


def put(spark, folder, number, made):
    """One file, newer than those before."""
    part = f"{folder}-{number}"
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.parquet(part)
    (name,) = [n for n in os.listdir(part) if n.endswith(".parquet")]
    os.makedirs(folder, exist_ok=True)
    os.rename(f"{part}/{name}", f"{folder}/{number}.parquet")
    os.utime(f"{folder}/{number}.parquet", (1_700_000_000 + number, 1_700_000_000 + number))


def hours(*of):
    return [(DAY + timedelta(hours=h), "c", flag) for h, flag in of]


def run(spark, tmp_path, files_at_once=1):
    stream = rates.comment_stream(spark, str(tmp_path / "in"), SCHEMA, files_at_once)
    rates.write_closed_windows(rates.windowed_flags(stream, "1 day", "2 hours"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = rates.read_rates(spark, str(tmp_path / "out"))
    return [(r.window_start.day, r.total_comments, r.controversial_comments) for r in found.orderBy("window_start", "community").collect()]


def test_late_comments_are_dropped_and_runs_go_on(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(spark, folder, 1, hours((1, 1), (5, 0), (23, 1)))
    put(spark, folder, 2, hours((25, 0), (22, 1)))  # 22:00 comes late, but the watermark is 21:00
    assert run(spark, tmp_path) == []  # the watermark, 23:00, has not passed midnight
    put(spark, folder, 3, hours((27, 1), (23, 0)))  # 23:00 is still counted: windows close, not times
    put(spark, folder, 4, hours((28, 0)))
    put(spark, folder, 5, hours((2, 1), (30, 0)))  # the first day was closed when the file before was read: 02:00 is dropped
    assert run(spark, tmp_path) == [(1, 5, 3)]
    put(spark, folder, 6, hours((60, 1)))
    assert run(spark, tmp_path) == [(1, 5, 3), (2, 4, 1)]
    assert run(spark, tmp_path) == [(1, 5, 3), (2, 4, 1)]


def test_closed_windows_equal_a_batch(spark, tmp_path):
    made = [(DAY + timedelta(minutes=37 * i), "ab"[i % 2], int(i % 5 == 0)) for i in range(400)]
    for number in range(4):
        put(spark, str(tmp_path / "in"), number, made[number * 100 : (number + 1) * 100])
    run(spark, tmp_path, 2)
    batch = rates.windowed_flags(spark.createDataFrame(made, SCHEMA), "1 day", "2 hours")
    closed = batch.filter(F.col("window_end") <= F.lit(made[-1][0] - timedelta(hours=2)))
    got = rates.read_rates(spark, str(tmp_path / "out"))
    assert rows(got.drop("controversy_rate")) == rows(closed) and got.count() > 15

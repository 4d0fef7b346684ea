"""Sources, sinks and session settings."""

from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from colloquy import session, staging
from colloquy.operators import subsets
from colloquy.schema import COMMENT_SCHEMA
from colloquy.sources import sinks, tables


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    data = [(str(i), f"a{i % 3}", "x" if i % 2 else "y", "b", 0, i, 1, "t", "p", 2023 + i % 2, f"{1 + i % 2:02d}")
            for i in range(8)]
    schema = COMMENT_SCHEMA.simpleString()[7:-1] + ",yyyy:int,mm:string"
    spark.createDataFrame(data, schema).write.partitionBy("yyyy", "mm").parquet(f"{path}/t")
    return f"{path}/t"


def test_month_scan_reads_one_folder(spark, raw):
    month = tables.read_month(spark, raw, 2024, 2)
    assert rows(month.select("id")) == [("1",), ("3",), ("5",), ("7",)]
    assert {"yyyy", "mm"} <= set(month.columns)
    scan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "yyyy" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_glob_list_and_schema(spark, raw):
    assert tables.read_table(spark, f"{raw}/yyyy=*/mm=02/*.parquet").count() == 4
    assert tables.read_table(spark, raw, COMMENT_SCHEMA).columns == [*COMMENT_SCHEMA.fieldNames(), "yyyy", "mm"]
    paths = [f"{raw}/yyyy=2023/mm=01", f"{raw}/yyyy=2024/mm=02"]
    assert tables.read_files(spark, *paths).count() == 8


def test_month_paths():
    assert tables.month_paths("s3a://bucket/trips/", 2021, [1, 12]) == [
        "s3a://bucket/trips/yyyy=2021/yellow_tripdata_2021-01.parquet",
        "s3a://bucket/trips/yyyy=2021/yellow_tripdata_2021-12.parquet",
    ]


def test_partitioned_overwrite(spark, raw, tmp_path):
    df = tables.read_table(spark, raw)
    for _ in range(2):
        sinks.write_table(df, f"{tmp_path}/out", ["subreddit"])
    assert tables.read_table(spark, f"{tmp_path}/out").count() == 8
    assert (tmp_path / "out/subreddit=x").is_dir()


def test_summary_csv_is_one_ordered_file(spark, tmp_path):
    big = spark.range(5000).select((F.col("id") * 37 % 5000).alias("k"), F.lit("a,\"b\"").alias("text"))
    sinks.write_summary_csv(big.orderBy(F.desc("k")), f"{tmp_path}/csv")
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 1
    back = tables.read_summary_csv(spark, f"{tmp_path}/csv", "k long, text string")
    assert [r.k for r in back.collect()] == list(range(4999, -1, -1))
    assert back.first().text == 'a,"b"'


def test_notes(spark, tmp_path):
    df = tables.integer_range(spark, 10)
    notes = subsets.run_summary({"ROWS": F.count("*"), "EVEN": F.count_if(F.col("id") % 2 == 0)}, df)
    sinks.write_notes(notes, f"{tmp_path}/notes")
    part = next((tmp_path / "notes").glob("part-*"))
    assert part.read_text() == "ROWS: 10\nEVEN: 5\n"


def test_preview_cuts_long_text(spark):
    df = spark.createDataFrame([(1, "x" * 100), (2, "short")], "id int, body string")
    got = sinks.preview(df, ["body", "absent", "id"], n=5, width=20).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("x" * 17 + "...", 1), ("short", 2)]
    assert sinks.preview(df, ["id"], n=1).count() == 1


def test_schema_report(spark, raw):
    report = rows(sinks.schema_report(tables.read_table(spark, raw, COMMENT_SCHEMA)))
    assert (0, "id", "string", True) in report and (5, "created_utc", "bigint", True) in report


def test_view_query(spark):
    df = tables.integer_range(spark, 100)
    assert tables.query_view(df, "numbers", "select count(*) as n from numbers").first().n == 100


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert session.OBJECT_STORE["spark.hadoop.fs.s3a.impl"].endswith("S3AFileSystem")


class _Cluster:
    """A session on a cluster without a shared folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "spark://host:7077"
        applicationId = "app"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_session_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_root(_Cluster())


def test_growing_summaries_are_ordered_part_files(spark, tmp_path):
    frame = spark.range(1000).repartition(5).orderBy(F.desc("id"))
    sinks.write_summary_csv(frame, str(tmp_path / "many"), one_file=False)
    parts = sorted(p for p in (tmp_path / "many").iterdir() if p.name.startswith("part-"))
    found = [int(line) for p in parts for line in p.read_text().splitlines() if line != "id"]
    assert len(parts) > 0 and found == list(range(999, -1, -1))


def test_a_written_table_repeats_no_work(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    written = staging.stage(spark.range(100).mapInArrow(touch, "id long"), "touched")
    assert written.count() == 100 and written.agg(F.sum("id")).first()[0] == 4950
    assert seen.value == 100


def test_a_scope_deletes_its_tables_and_no_others(spark):
    outer = staging.stage(spark.range(3), "kept")
    with staging.scope(spark):
        inner = staging.stage(spark.range(5), "dropped")
        files = [f.removeprefix("file://") for f in inner.inputFiles()]
        assert inner.count() == 5 and all(Path(f).exists() for f in files)
    assert files and not any(Path(f).exists() for f in files)
    assert outer.count() == 3

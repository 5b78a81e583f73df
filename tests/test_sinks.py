"""Writing, rewriting, publishing and logging."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from callmart.session import clear_staged, new_path, shared_dir, stage
from callmart.sources import sinks
from callmart.sources.tables import load


def days(spark, *rows):
    return spark.createDataFrame(list(rows), "part_date int, v int")


def back(spark, path):
    return sorted((r["part_date"], r["v"]) for r in spark.read.parquet(path).collect())


def test_refresh_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.refresh_partitions(days(spark, (1, 10), (2, 20)), path)
    sinks.refresh_partitions(days(spark, (2, 21)), path)
    sinks.refresh_partitions(days(spark, (2, 21)), path)
    assert back(spark, path) == [(1, 10), (2, 21)]
    sinks.refresh_partitions(days(spark, (3, 30)), path)
    assert back(spark, path) == [(1, 10), (2, 21), (3, 30)]


def test_a_day_without_rows_becomes_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.refresh_partitions(days(spark, (1, 10), (2, 20)), path)
    sinks.write_day(days(spark, (1, 11)), path, 2)
    assert back(spark, path) == [(1, 10)]


def test_rebuild_sorts_inside_files(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.rebuild(days(spark, *[(i % 2, 100 - i) for i in range(50)]).coalesce(1), path, ["part_date"], ["v"])
    for part in (0, 1):
        values = [r["v"] for r in spark.read.parquet(f"{path}/part_date={part}").collect()]
        assert values == sorted(values) and len(values) == 25


def test_view_has_comments(spark):
    view = sinks.publish_view(spark.range(2).selectExpr("id", "1 as x", "2 as y"), "shown", {"y": "the y", "id": "the id"})
    assert view.columns == ["y", "id"] and spark.table("shown").count() == 2
    assert view.schema["y"].metadata == {"comment": "the y"}


def test_run_log_of_a_failure(spark, tmp_path):
    path = str(tmp_path / "log")

    def work():
        raise RuntimeError("x" * 900)

    with pytest.raises(RuntimeError):
        sinks.logged_run(spark, path, "job", "1", work, clock=lambda: datetime(2024, 1, 1))
    rows = {r["status"]: r for r in spark.read.parquet(path).collect()}
    assert set(rows) == {"STARTED", "ERROR"}
    assert len(rows["ERROR"]["error_text"]) > 500


def test_staged_tables_go_to_the_shared_folder(spark):
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    df = stage(spark.range(5).withColumn("t", F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")), "mine")
    assert df.count() == 5 and dict(df.dtypes)["t"] == "timestamp_ntz"
    assert df.inputFiles()[0].startswith("file:" + shared_dir(spark)) or shared_dir(spark) in df.inputFiles()[0]


def test_without_a_setting_the_warehouse_is_used():
    class Conf:
        def get(self, key, default=None):
            return "/shared/warehouse" if key == "spark.sql.warehouse.dir" else default

    class Context:
        applicationId, master = "app", "yarn"
        checkpoints = None

        def getCheckpointDir(self):
            return self.checkpoints

    class Session:
        conf, sparkContext = Conf(), Context()

    assert shared_dir(Session()) == "/shared/warehouse/callmart/app"
    Context.checkpoints = "/shared/checkpoints"
    assert shared_dir(Session()) == "/shared/checkpoints/callmart/app"


def test_given_schema_is_used(spark, tmp_path):
    df = spark.range(3).selectExpr("id", "id as b")
    df.write.parquet(str(tmp_path / "x"))
    assert load(spark, str(tmp_path), "x", df.select("id").schema).columns == ["id"]


def test_clear_staged(spark):
    stage(spark.range(3), "gone")
    clear_staged(spark)
    with pytest.raises(Exception):
        spark.read.parquet(shared_dir(spark) + "/*")
    stage(spark.range(3), "again").count()
    assert new_path(spark) != new_path(spark)


def test_packed_days_are_few_files(spark, tmp_path):
    path, loose = str(tmp_path / "packed"), str(tmp_path / "loose")
    rows = spark.range(0, 4000, 1, 8).selectExpr("cast(id % 5 as int) as part_date", "cast(id as int) as v")
    sinks.refresh_partitions(rows, path, pack=True)
    sinks.rebuild(rows, loose, ["part_date"], ["v"])
    assert back(spark, path) == back(spark, loose)
    assert len(spark.read.parquet(path).inputFiles()) < len(spark.read.parquet(loose).inputFiles())
    sinks.rebuild(rows, path, ["part_date"], ["v"], pack=True)
    assert back(spark, path) == back(spark, loose)

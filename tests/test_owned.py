import os

import pytest
from pyspark.sql import functions as F

from peerlight.operators import skew
from peerlight.sources import materialize, owned_snapshots, shared_folder, write_parquet


def folders(spark):
    return set(os.listdir(f"{shared_folder(spark).removeprefix('file://')}/peerlight"))


def test_owned_tables_are_removed_and_kept_after_a_failure(spark):
    materialize(spark.range(1))
    before = folders(spark)
    with owned_snapshots(spark):
        outer = materialize(spark.range(3))
        with owned_snapshots(spark):
            materialize(spark.range(5))
        assert outer.count() == 3 and len(folders(spark) - before) == 1
    assert folders(spark) == before
    with pytest.raises(RuntimeError), owned_snapshots(spark):
        materialize(spark.range(3))
        raise RuntimeError
    assert len(folders(spark) - before) == 1


def test_files_per_year_are_bounded(spark, tmp_path):
    rows = spark.range(10_000, numPartitions=40).select("id", (F.col("id") % 3 + 2020).cast("int").alias("report_year"))
    write_parquet(rows, str(tmp_path / "s"), ["report_year"])
    years = [len(list(year.glob("*.parquet"))) for year in (tmp_path / "s").glob("report_year=*")]
    assert len(years) == 3 and max(years) <= 2 and spark.read.parquet(str(tmp_path / "s")).count() == 10_000


def test_salt_is_taken_from_a_written_table(spark):
    rows = spark.range(2_000).select(F.lit("a").alias("k"), "id").repartition(5)
    lookup = spark.createDataFrame([("a", 1)], "k string, v int")
    joined = skew.salted_left_join(rows, lookup, ["k"], ["a"])
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "monotonically_increasing_id" in plan and "Repartition" not in plan and joined.filter("v = 1").count() == 2_000

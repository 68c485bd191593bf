import os

from helpers import rows
from marketide.session import PLAN_SETTINGS, materialise, shared_dir, shuffle_partitions, tune
from marketide.sources.readers import stored_bytes


def test_settings_and_shuffle_size(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    tune(spark, 10 * 512 * 1024 * 1024)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert spark.conf.get(initial) == "10"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    for key, value in PLAN_SETTINGS.items():
        assert spark.conf.get(key) == value
    tune(spark, 0)
    assert spark.conf.get(initial) == before
    spark.conf.unset(initial)
    assert shuffle_partitions(10**15, 200) == 1_862_646
    assert shuffle_partitions(10**14, 200) > 200
    assert shuffle_partitions(1, 200) == 200


def test_materialise_uses_the_named_folder(spark):
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = materialise(spark.range(5).selectExpr("id * 2 AS x"))
    assert rows(df) == [(0,), (2,), (4,), (6,), (8,)]
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert any(files for _, _, files in os.walk(folder))


def test_stored_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"12345")
    assert stored_bytes(spark, str(tmp_path)) >= 5
    assert stored_bytes(spark, str(tmp_path / "none")) == 0

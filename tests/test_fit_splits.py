"""Parts in which a fit reads stored feature rows."""

from pyspark.sql import functions as F

from clickloom.operators import encoding, models
from clickloom.sources import tables


class Recorder:
    def fit(self, df):
        sizes = df.groupBy(F.spark_partition_id()).count().collect()
        return [r["count"] for r in sizes], df.rdd.getNumPartitions()


def test_a_task_of_a_fit_reads_a_bounded_part(spark, monkeypatch):
    """However large the files are, and with row groups small enough to be dealt."""
    monkeypatch.setattr(tables, "FIT_SPLIT", 1 << 18)
    monkeypatch.setattr(models, "classifier", lambda *a, **k: Recorder())
    rows = spark.range(0, 120_000, 1, 1).selectExpr("cast(id as string) rk", "cast(id % 2 as int) label", "'Train' data", "rand(1) c01", "rand(2) c02")
    _, stored = encoding.store_features(rows, [encoding.assembler(["c01", "c02"])], ["rk", "label", "data"], F.lit(True), True, "test-features", ("data",))
    before = spark.conf.get(tables.SPLIT_SETTING)
    sizes, parts = models.train("logistic", stored)
    assert sum(sizes) == 120_000 and parts >= 8 and max(sizes) < 120_000 / 4
    assert spark.conf.get(tables.SPLIT_SETTING) == before


def test_a_smaller_setting_of_the_session_stays(spark):
    before = spark.conf.get(tables.SPLIT_SETTING)
    try:
        for text, most in (("2m", 2 << 20), ("1g", tables.FIT_SPLIT), ("4096", 4096), ("64KB", 64 << 10)):
            spark.conf.set(tables.SPLIT_SETTING, text)
            with tables.fine_splits(spark):
                assert spark.conf.get(tables.SPLIT_SETTING) in (str(most), f"{most}b")
            assert spark.conf.get(tables.SPLIT_SETTING) == text
    finally:
        spark.conf.set(tables.SPLIT_SETTING, before)

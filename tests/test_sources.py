import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.sources import click_log, tables


def lines(spark, *rows):
    return spark.createDataFrame([("\t".join(r),) for r in rows], "value string")


def test_click_log_layout_has_forty_columns():
    fields = schema.click_log_schema().fields
    assert len(fields) == 40
    assert [fields[0].name, fields[1].name, fields[13].name, fields[14].name, fields[39].name] == [
        "label",
        "c01",
        "c13",
        "b01",
        "b26",
    ]


def test_blank_numbers_are_zero_and_blank_categories_stay(spark):
    row = click_log.parse_click_log(lines(spark, ["1", "", "5", "-1", "", "x"]), numeric=3, categorical=2).first()
    assert row.asDict() == {"label": 1, "c01": 0.0, "c02": 5.0, "c03": -1.0, "b01": "", "b02": "x"}


def test_parsed_schema_is_the_declared_one(spark):
    parsed = click_log.parse_click_log(lines(spark, ["0"] + ["1"] * 13 + ["a"] * 26))
    assert [(f.name, f.dataType) for f in parsed.schema] == [
        (f.name, f.dataType) for f in schema.click_log_schema()
    ]


@pytest.mark.parametrize("row", [["1", "x", "a"], ["", "1", "a"], ["1", "5.5", "a"]])
def test_strict_mode_raises_on_bad_numbers(spark, row):
    with pytest.raises(Exception, match="not an integer"):
        click_log.parse_click_log(lines(spark, row), numeric=1, categorical=1).collect()


@pytest.mark.parametrize("row", [["1", "5", "a"], ["1", "5", "a", "b", "c"], ["1"]])
def test_lines_of_another_length_are_refused(spark, row):
    with pytest.raises(Exception, match="fields expected"):
        click_log.parse_click_log(lines(spark, row), numeric=1, categorical=2).collect()
    lenient = click_log.parse_click_log(lines(spark, row), numeric=1, categorical=2, strict=False)
    assert click_log.count_rejects(lenient).first()["n_rejected"] == 1


def test_writer_keeps_missing_values_in_their_place(spark):
    path = tempfile.mkdtemp(prefix="clickloom-test-") + "/log"
    df = spark.createDataFrame([(1, None, "x", "y"), (0, 3.0, None, "z")], "label int, c01 double, b01 string, b02 string")
    click_log.write_click_log(df, path)
    back = click_log.read_click_log(spark, path, numeric=1, categorical=2)
    assert sorted(map(tuple, back.collect())) == [(0, 3.0, "", "z"), (1, 0.0, "x", "y")]


@pytest.mark.parametrize("row, said", [((1, 3.7, "x"), "not a whole number"), ((1, 3.0, "x\ty"), "tab or line break"), ((1, 3.0, "x\ny"), "tab or line break")])
def test_writer_refuses_what_the_format_cannot_hold(spark, row, said):
    path = tempfile.mkdtemp(prefix="clickloom-test-") + "/log"
    with pytest.raises(Exception, match=said):
        click_log.write_click_log(spark.createDataFrame([row], "label int, c01 double, b01 string"), path)


def test_lenient_mode_counts_rejects(spark):
    parsed = click_log.parse_click_log(
        lines(spark, ["1", "x", "a"], ["1", "2", "a"], ["0", "3"]), numeric=1, categorical=1, strict=False
    )
    assert click_log.count_rejects(parsed).first().asDict() == {"n_rejected": 2, "n_rows": 3}


def test_single_file_csv_appends_with_header(spark):
    path = tempfile.mkdtemp(prefix="clickloom-test-") + "/out"
    df = spark.createDataFrame([("a", 1.5), ("", 2.0)], "b01 string, c01 double").repartition(2)
    tables.write_csv(df, path, single_file=True)
    tables.write_csv(df, path, single_file=True)
    back = tables.read_csv(spark, path, df.schema)
    assert len(back.inputFiles()) == 2
    assert sorted(map(tuple, back.collect())) == [("", 2.0), ("", 2.0), ("a", 1.5), ("a", 1.5)]


def test_parquet_sink_refuses_to_overwrite_by_default(spark):
    path = tempfile.mkdtemp(prefix="clickloom-test-") + "/out"
    tables.write_parquet(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)exists"):
        tables.write_parquet(spark.range(3), path)
    tables.write_parquet(spark.range(5), path, mode="overwrite")
    assert tables.read_parquet(spark, path).count() == 5


def test_staged_tables_go_to_the_folder_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    staged = tables.stage(spark.range(4).withColumn("part", F.col("id") % 2), "t", partition_by=("part",))
    assert staged.inputFiles() and all(folder in f for f in staged.inputFiles())
    assert sorted(r["id"] for r in staged.where("part = 1").collect()) == [1, 3]


def test_column_roles(spark):
    df = spark.createDataFrame([("k", 1, 0.5, "a"), ("l", 0, None, "b")], "rk string, label int, c01 double, b01 string")
    rows = {r["name"]: (r["role"], r["n_values"]) for r in schema.column_roles(df).collect()}
    assert rows == {"rk": ("key", 2), "label": ("label", 2), "c01": ("numeric", 1), "b01": ("categorical", 2)}


def test_staged_tables_of_a_flow_can_be_deleted(spark):
    with tables.staging(spark):
        inner = tables.stage(spark.range(5), "inner")
        files = [f.removeprefix("file://").removeprefix("file:") for f in inner.inputFiles()]
        assert inner.count() == 5 and all(Path(f).exists() for f in files)
    assert files and not any(Path(f).exists() for f in files)


def test_a_run_written_again_replaces_itself(spark, tmp_path):
    path = f"{tmp_path}/runs"
    for run, n in (("a", 3), ("b", 2), ("a", 3), ("c/1", 1)):
        tables.append_run(spark.range(n), path, run)
    runs = tables.read_runs(spark, path, spark.range(1).schema)
    assert {r["run_id"]: r["count"] for r in runs.groupBy("run_id").count().collect()} == {"a": 3, "b": 2, "c/1": 1}
    assert "PartitionFilters: [isnotnull(run_id" in runs.where("run_id = 'b'")._jdf.queryExecution().executedPlan().toString()

import math

import pytest
from pyspark.sql import functions as F

from clickloom.operators import cleaning, profile, sampling
from clickloom.operators.encoding import target_means
from clickloom.schema import categorical_names
from clickloom.sources.tables import stage


def counts_of(df, columns):
    return stage(profile.category_frequency(df, columns), "test-counts")


def test_blank_tokens_by_column_group():
    tokens = {c: cleaning.blank_token(c) for c in categorical_names()}
    assert {c for c, t in tokens.items() if t == "empty_1"} == {"b03", "b12", "b16", "b21", "b24"}
    assert {c for c, t in tokens.items() if t == "empty_2"} == {"b19", "b20", "b25", "b26"}
    assert tokens["b04"] == "empty_0"


def test_blank_and_null_take_the_token(spark):
    df = spark.createDataFrame([("",), (None,), ("q",)], "b03 string")
    assert [r[0] for r in cleaning.impute_blank(df, ["b03"]).collect()] == ["empty_1", "empty_1", "q"]


def test_filling_counts_equals_counting_filled_rows(spark):
    df = spark.createDataFrame([("", "x"), (None, ""), ("empty_1", "y"), ("q", "")], "b03 string, b19 string")
    columns = ["b03", "b19"]
    direct = profile.category_frequency(cleaning.impute_blank(df, columns), columns)
    derived = cleaning.fill_counts(counts_of(df, columns), columns)
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, derived.collect()))


def test_folding_keeps_counts_at_the_threshold_and_folds_unseen(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "b01 string")
    folding = cleaning.fit_folding(counts_of(train, ["b01"]), ["b01"], min_count=2)
    new = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "b01 string")
    assert [r[0] for r in folding.apply(new).collect()] == ["a"] + ["less_than_1pc"] * 3


def test_folding_by_fraction(spark):
    df = spark.createDataFrame([("a",)] * 99 + [("b",)], "b01 string")
    assert cleaning.fit_folding(counts_of(df, ["b01"]), ["b01"], min_fraction=0.01).kept == {"b01": ["a", "b"]}
    assert cleaning.fit_folding(counts_of(df, ["b01"]), ["b01"], min_fraction=0.011).kept == {"b01": ["a"]}


def test_long_lists_of_kept_categories_go_through_a_join(spark):
    df = spark.createDataFrame([(str(i % 40), "k") for i in range(200)] + [("once", "k")], "b01 string, b02 string")
    columns = ["b01", "b02"]
    counts = counts_of(df, columns)
    by_list = cleaning.fit_folding(counts, columns, min_count=2)
    by_join = cleaning.fit_folding(counts, columns, min_count=2, max_literals=10)
    assert by_join.large == {"b01": 40} and by_join.kept == {"b02": ["k"]}
    assert sorted(map(tuple, by_list.apply(df).collect())) == sorted(map(tuple, by_join.apply(df).collect()))


def test_signed_log(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (math.e - 1,), (None,)], "c01 double")
    assert [r[0] for r in cleaning.log_transform(df, ["c01"]).collect()] == [-2.0, 0.0, 1.0, None]


def test_profile_counts_are_cumulative(spark):
    df = spark.createDataFrame([("",)] * 12 + [("a",)] + [("b",)] * 5, "b01 string")
    row = profile.categorical_profile(profile.category_frequency(df, ["b01"])).first()
    assert row.asDict() == {
        "feature": "b01",
        "n_unique": 3,
        "n_empty": 12,
        "n_count_eq_1": 1,
        "n_count_lt_10": 2,
        "n_count_lt_100": 3,
        "n_count_lt_1000": 3,
    }


def test_null_audit_counts_nan_and_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (None, None), (1.0, "b")], "c01 double, b01 string")
    assert {r["feature"]: r["n_missing"] for r in profile.null_audit(df).collect()} == {"c01": 2, "b01": 1}


def test_hash_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).selectExpr("cast(id as string) rk", "cast(id % 3 = 0 as int) label")
    for pick in (
        lambda d: sampling.sample_hash(d, "rk", 0.2),
        lambda d: sampling.assign_split(d, "rk"),
        lambda d: sampling.sample_n(d, "rk", 50),
    ):
        one, many = pick(df.repartition(1)), pick(df.repartition(7))
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


@pytest.mark.parametrize("share", [0.05, 0.25, 0.7, 0.75, 0.95])
def test_split_takes_any_share(spark, share):
    df = spark.range(20000).selectExpr("cast(id as string) rk", "0 label")
    parts = {r["data"]: r["n_rows"] for r in sampling.count_parts(sampling.assign_split(df, "rk", share), "data").collect()}
    assert sum(parts.values()) == 20000 and abs(parts["Train"] / 20000 - share) < 0.012


def test_seeded_random_split_covers_every_row(spark):
    df = stage(spark.range(1000), "test-split")
    train, test = sampling.random_split(df)
    assert train.count() + test.count() == 1000
    assert train.intersect(test).count() == 0


def test_frequent_counts_fold_like_full_counts(spark):
    """One value with a third of the rows, some near the limit, and a long tail of single ones."""
    value = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 < 8, (F.col("id") % 100).cast("string"))
    df = spark.range(0, 30000, 1, 6).select(
        value.otherwise(F.concat(F.lit("tail"), F.col("id"))).alias("b01"),
        (F.col("id") % 97).cast("string").alias("b02"),
        (F.col("id") % 4 == 0).cast("int").alias("label"),
    )
    columns = ["b01", "b02"]
    full = stage(target_means(df, columns).drop("mean"), "test-full")
    few = stage(cleaning.frequent_counts(df, columns), "test-few")
    assert few.count() < 300
    threshold = cleaning.count_threshold(full)
    assert cleaning.count_threshold(few) == threshold
    want, got = cleaning.fold_counts(full, threshold), cleaning.fold_counts(few, threshold)
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, got.collect()))
    assert cleaning.fit_folding(full, columns).kept == cleaning.fit_folding(few, columns).kept


def test_counts_refuse_a_threshold_below_what_they_are_exact_for(spark):
    df = spark.range(3000).selectExpr("cast(id % 3 = 0 as int) label", "cast(pow(id, 0.7) as int) as x").selectExpr("label", "cast(x as string) b01")
    counts = stage(cleaning.frequent_counts(df, ["b01"], min_fraction=0.05), "counts")
    cleaning.fit_folding(counts, ["b01"], min_fraction=0.05)
    cleaning.fit_folding(counts, ["b01"], min_count=200)
    with pytest.raises(ValueError, match="exact from"):
        cleaning.fit_folding(counts, ["b01"], min_count=3)

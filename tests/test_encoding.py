import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from clickloom.operators import cleaning, encoding, lookup, profile
from clickloom.plans import queries
from clickloom.sources.tables import stage


def train_rows(spark):
    return spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "b01 string, label int")


def test_target_means_with_unseen_category(spark):
    encoder = encoding.fit_target_means(train_rows(spark), ["b01"])
    test = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "b01 string")
    assert [r["b01_bm"] for r in encoder.apply(test).collect()] == [0.5, 1.0, 0.0, 0.0]
    assert encoder.sizes == {"b01": 2}


def test_means_of_folded_rows_follow_from_counts(spark):
    df = spark.createDataFrame(
        [(v, i % 2) for i, v in enumerate("aaaaabbbbbcd")], "b01 string, label int"
    )
    counts = stage(encoding.target_means(df, ["b01"]).drop("mean"), "test-counts")
    folding = cleaning.fit_folding(counts, ["b01"], min_count=3)
    direct = encoding.target_means(folding.apply(df), ["b01"]).select("value", "n", "mean")
    derived = encoding.encoder_from_counts(cleaning.fold_counts(counts, folding.threshold), ["b01"]).means
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, derived.select("value", "n", "mean").collect()))


def skewed(spark):
    """One category holds half of the rows, one is NULL, the rest are long-tailed."""
    value = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 400).cast("string"))
    return spark.range(6000).select(
        F.col("id").cast("string").alias("rk"),
        value.alias("b01"),
        (F.col("id") % 90).cast("string").alias("b02"),
        (F.col("id") % 5 == 0).cast("int").alias("label"),
    )


def test_shuffled_lookup_equals_broadcast_lookup(spark):
    df = skewed(spark)
    encoder = encoding.fit_target_means(df.where("b02 % 3 > 0"), ["b01", "b02"])
    rows = df.unionByName(df.limit(5).withColumn("b01", F.lit("never seen")))
    wide = sorted(map(tuple, encoder.apply(rows).collect()), key=str)
    tight = encoder.apply(rows, broadcast_rows=10)
    assert tight.columns == encoder.apply(rows).columns
    assert sorted(map(tuple, tight.collect()), key=str) == wide


def test_hot_and_null_keys_are_spread_over_tasks(spark):
    df = skewed(spark)
    table = encoding.fit_target_means(df, ["b01"]).means.where("feature = 'b01'")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup.attach(df, "b01", table, {"mean": "m"}, table.count(), broadcast_rows=10, hot_share=0.1)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 6000 and max(sizes) < 6000 / 4


def test_broadcast_encoding_does_not_shuffle_rows(spark):
    df = skewed(spark)
    encoder = encoding.fit_target_means(df, ["b01", "b02"])
    small = encoding.fit_target_means(df, ["b02"])
    assert "Join" not in small.apply(df)._jdf.queryExecution().sparkPlan().toString()  # a small table is a literal
    encoder.sizes = {c: 1000 for c in encoder.sizes}
    plan = encoder.apply(df)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_large_tables_go_through_a_shuffle_even_if_they_would_fit(spark):
    df = skewed(spark)
    encoder = encoding.fit_target_means(df, ["b01", "b02"])
    wide = sorted(map(tuple, encoder.apply(df).collect()), key=str)
    shuffled = encoder.apply(df, broadcast_rows=10)
    assert "SortMergeJoin" in shuffled._jdf.queryExecution().sparkPlan().toString()
    assert sorted(map(tuple, shuffled.collect()), key=str) == wide


def test_leave_one_out_and_global_mean(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", 0), ("b", 1)], "b01 string, label int")
    encoder = encoding.fit_target_means(df, ["b01"], fill="global_mean")
    assert encoder.fill == 0.5
    got = sorted((r["label"], r["b01_bm"]) for r in encoder.apply_leave_one_out(df).collect())
    assert got == [(0, 0.5), (0, 0.5), (1, 0.0), (1, 0.5)]
    unseen = spark.createDataFrame([("z", 0), (None, 1)], "b01 string, label int")
    assert [r["b01_bm"] for r in encoder.apply(unseen).collect()] == [0.5, 0.5]


def test_means_of_seen_categories_equal_sparks_target_encoder(spark):
    from pyspark.ml.feature import TargetEncoder

    df = spark.range(300).selectExpr("cast(id % 7 as double) c", "cast(id % 7 as string) b01", "cast(id % 3 = 0 as double) y", "cast(id % 3 = 0 as int) label")
    ours = {r["b01"]: r["mean"] for r in encoding.fit_target_means(df, ["b01"]).means.withColumnRenamed("value", "b01").collect()}
    model = TargetEncoder(inputCols=["c"], outputCols=["e"], labelCol="y", targetType="binary").fit(df)
    theirs = {r["b01"]: r["e"] for r in model.transform(df).select("b01", "e").distinct().collect()}
    assert theirs == pytest.approx(ours)


def test_string_index_order_and_tie_break(spark):
    df = spark.createDataFrame([("a",), ("a",), ("c",), ("b",)], "b01 string")
    model = encoding.string_indexer(["b01"]).fit(df)
    assert [list(v) for v in model.labelsArray] == [["a", "b", "c"]]
    counts = profile.category_frequency(df, ["b01"])
    assert encoding.category_order(counts, ["b01"]) == {"b01": ["a", "b", "c"]}


def test_one_hot_sizes_names_and_unseen(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("c", "x")], "b01 string, b02 string")
    full, columns = encoding.fit_one_hot(df, ["b01", "b02"])
    vectors = encoding.assembler(columns).transform(full.transform(df))
    assert encoding.vector_names(vectors) == ["b01=a", "b01=b", "b01=c", "b02=x"]
    short, columns = encoding.fit_one_hot(df, ["b01", "b02"], drop_last=True)
    vectors = encoding.assembler(columns).transform(short.transform(df))
    assert encoding.vector_names(vectors) == ["b01=a", "b01=b"]
    dense = [r[0] for r in vectors.select(vector_to_array("features")).collect()]
    assert dense == [[1, 0], [1, 0], [0, 1], [0, 0]]
    unseen = full.transform(spark.createDataFrame([("zz", "x")], "b01 string, b02 string"))
    assert unseen.select(vector_to_array("b01_vec")).first()[0] == [0, 0, 0]


def test_standardise_with_constant_column(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(1, 5)], "c01 double, c02 double")
    pipeline = encoding.fit_mean_features(df, ["c01"], ["c02"])
    rows = pipeline.apply(df, []).select(vector_to_array("selected_features").alias("v")).collect()
    assert [round(r["v"][0], 6) for r in rows] == [-1.161895, -0.387298, 0.387298, 1.161895]
    assert [r["v"][1] for r in rows] == [0.0] * 4
    assert pipeline.names == ["c01", "c02"] and pipeline.size == 2


def test_sparse_scaling_keeps_vectors_sparse(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 0.0)], "b01 string, c01 double")
    order = encoding.category_order(profile.category_frequency(df, ["b01"]), ["b01"])
    rows = encoding.fit_onehot_features(df, order, ["c01"], with_mean=False).apply(df, [])
    assert any("SparseVector" in type(r[0]).__name__ for r in rows.collect())


def test_chi_square_matches_the_spark_test(spark):
    df = skewed(spark).na.fill("none", ["b01"])
    columns = ["b01", "b02"]
    ours = {
        r["feature"]: (r["statistic"], r["dof"])
        for r in encoding.chi_square_table(encoding.target_means(df, columns)).collect()
    }
    indexed = encoding.string_indexer(columns).fit(df).transform(df)
    vectors = encoding.assembler([f"{c}_index" for c in columns]).transform(indexed)
    theirs = ChiSquareTest.test(vectors, "features", "label").first()
    for i, c in enumerate(columns):
        assert ours[c][0] == pytest.approx(theirs["statistics"][i])
        assert ours[c][1] == theirs["degreesOfFreedom"][i]


def test_chi_square_selection_finds_the_dependent_column(spark):
    df = spark.range(400).selectExpr(
        "cast(id % 2 as int) label", "cast(id % 2 as string) b01", "cast(floor(id / 2) % 2 as string) b02"
    )
    table = encoding.chi_square_table(encoding.target_means(df, ["b02", "b01"]))
    assert [tuple(r) for r in encoding.select_by_chi_square(table, top=1).collect()] == [("b01", 1)]


def test_chi_square_selection_does_not_fall_to_the_column_order(spark):
    table = spark.createDataFrame([("b01", 127591.0, 1), ("b02", 200000.0, 1), ("b03", 210000.0, 30)], "feature string, statistic double, dof long")
    assert [r["feature"] for r in encoding.select_by_chi_square(table, top=2).collect()] == ["b02", "b01"]


def test_slot_sums_count_categories(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "b01 string")
    model, columns = encoding.fit_one_hot(df, ["b01"])
    sums = encoding.slot_sums(encoding.assembler(columns).transform(model.transform(df)), "features")
    assert {r["slot"]: r["total"] for r in sums.collect()} == {0: 2.0, 1: 1.0}


def test_sums_of_long_vectors_by_slot(spark):
    rows = [(Vectors.sparse(5, [1, 4], [1.0, 2.0]), Vectors.dense(1.0, 0.5)), (Vectors.sparse(5, [4], [3.0]), Vectors.dense(0.0, 2.0)), (Vectors.sparse(5, [], []), Vectors.sparse(2, [1], [1.0]))]
    df = spark.createDataFrame(rows, ["u", "v"])
    got = {(r["vector"], r["slot"]): r["total"] for r in encoding.sparse_slot_sums(df, ["u", "v"]).collect()}
    assert got == {("u", 1): 1.0, ("u", 4): 5.0, ("v", 0): 1.0, ("v", 1): 3.5}


def test_long_one_hot_joins_the_view_once(spark, monkeypatch):
    made, view = [], queries.training_view
    monkeypatch.setattr(queries, "training_view", lambda *a: made.append(1) or view(*a))
    for name in ("one_hot_long", "score_batch_weights"):
        queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(made) == 2

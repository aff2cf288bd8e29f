"""Value filters, the one-shuffle lookup, the index of long vocabularies, and chi-square of slots."""

import re

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from clickloom.operators import encoding, lookup
from clickloom.sources.tables import stage
from clickloom.sources.training_view import training_view


def fitted(spark):
    """Three long columns: 3,000, 500 and 2,000 categories, the last with a hot one."""
    return spark.range(30000).selectExpr(
        "cast(id as string) rk", "cast(id % 3000 as string) b01", "cast(id % 500 as string) b02",
        "if(id % 3 = 0, 'hot', cast(id % 2000 as string)) b03", "cast(id % 7 < 2 as int) label",
    )


def scored(spark):
    """A third of the rows have one value of b01 that no fitted row has; b02 has NULLs and blanks."""
    return fitted(spark).withColumns(
        {
            "b01": F.when(F.col("rk") % 3 == 1, "absent").otherwise(F.col("b01")),
            "b02": F.when(F.col("rk") % 5 == 1, None).when(F.col("rk") % 5 == 2, "").otherwise(F.col("b02")),
        }
    )


@pytest.fixture
def plain_shuffles(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("most", [1 << 26, 64])
def test_filter_knows_all_its_values(spark, monkeypatch, most):
    """No value that went in is denied, however small the filter; of others a good one lets few through."""
    monkeypatch.setattr(lookup, "MAX_FILTER_BITS", most)
    values = stage(spark.range(5000).selectExpr("cast(id as string) v"), "values")
    known = lookup.value_filter(values, ["v"], 5000)
    asked = spark.range(10000).selectExpr("cast(id as string) v").select("v", lookup.may_hold(known, [F.col("v")]).alias("may"))
    assert asked.where("cast(v as int) < 5000 and not may").count() == 0
    wrong = asked.where("cast(v as int) >= 5000 and may").count()
    assert wrong < 250 if most > 64 else wrong > 4000
    assert "NestedLoop" not in asked._jdf.queryExecution().executedPlan().toString()


def test_filter_of_nothing_denies_everything(spark):
    known = lookup.value_filter(stage(spark.range(0).selectExpr("cast(id as string) v"), "values"), ["v"], 0)
    assert spark.range(9).where(lookup.may_hold(known, [F.col("id").cast("string")])).count() == 0


def test_absent_hot_value_is_spread(spark, plain_shuffles):
    """The value that a third of the scored rows have, and the table has not, does not go to one task."""
    table = encoding.fit_target_means(fitted(spark), ["b01"]).means.where("feature = 'b01'")
    joined = lookup.attach(scored(spark), "b01", table, {"mean": "m"}, table.count(), broadcast_rows=10)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30000 and max(sizes) < 2 * 30000 / len(sizes) and len(sizes) == 8
    assert joined.where("b01 = 'absent' and m is not null").count() == 0


@pytest.mark.parametrize("most", [1 << 26, 64])
def test_one_shuffle_equals_broadcast(spark, monkeypatch, most):
    """Also with a filter so small that it lets everything through: false positives change nothing."""
    monkeypatch.setattr(lookup, "MAX_FILTER_BITS", most)
    encoder = encoding.fit_target_means(fitted(spark), ["b01", "b02", "b03"])
    rows = scored(spark).withColumn("_f", F.lit("clash")).unionByName(scored(spark).limit(3).withColumn("_f", F.lit(None)))
    wide, tight = encoder.apply(rows), encoder.apply(rows, broadcast_rows=10)
    assert tight.columns == wide.columns
    assert sorted(map(tuple, tight.collect()), key=str) == sorted(map(tuple, wide.collect()), key=str)


def test_row_data_is_shuffled_twice_at_most(spark, plain_shuffles):
    """Once as pairs of what no broadcast answers, once by row, for three columns as for two. The table of means is shuffled as well."""
    encoder = encoding.fit_target_means(fitted(spark), ["b01", "b02", "b03"])
    counts = []
    for columns in (["b01", "b02", "b03"], ["b01", "b02"]):
        rows = lookup.attach_many(scored(spark), columns, encoder.means, "mean", "_m", 6000)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        counts.append(len(re.findall(r"Exchange hashpartitioning\(_row", plan)))
        assert plan.count("SortMergeJoin") == 1 and len(re.findall(r"Exchange hashpartitioning\(_f", plan)) == 2
    assert counts == [1, 1]


def test_no_absent_value_reaches_the_join(spark, plain_shuffles):
    encoder = encoding.fit_target_means(fitted(spark), ["b01", "b02"])
    rows = lookup.attach_many(scored(spark), ["b01", "b02"], encoder.means, "mean", "_m", 3500)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30000 and max(sizes) < 1.2 * 30000 / len(sizes)


def test_empty_tables(spark):
    encoder = encoding.fit_target_means(fitted(spark), ["b01", "b02"])
    assert encoder.apply(scored(spark).limit(0), broadcast_rows=10).count() == 0
    nothing = encoding.fit_target_means(fitted(spark).limit(0), ["b01", "b02"])
    assert nothing.apply(scored(spark)).where("b01_bm <> 0.0").count() == 0


def test_long_index_needs_no_driver(spark, monkeypatch):
    """The order of a string index, beyond the number of categories that the driver may hold."""
    monkeypatch.setattr(encoding, "MAX_VOCABULARY", 10)
    counts = stage(encoding.target_means(fitted(spark), ["b01", "b03"]).drop("mean"), "counts")
    with pytest.raises(ValueError):
        encoding.category_order(counts, ["b01", "b03"])
    index = {(r["feature"], r["value"]): r["slot"] for r in encoding.long_index(counts).collect()}
    for c in ("b01", "b03"):
        labels = encoding.string_indexer([c]).fit(fitted(spark)).labelsArray[0]
        assert [index[c, v] for v in labels] == list(range(len(labels)))


@pytest.mark.parametrize("limit", [10, 100_000])
def test_long_one_hot_vectors(spark, limit):
    counts = encoding.target_means(fitted(spark), ["b01", "b03"]).drop("mean")
    index = stage(encoding.long_index(stage(counts, "counts")), "index")
    rows, vectors = encoding.one_hot_long(scored(spark).select("rk", "b01", "b03"), ["b01", "b03"], index, limit)
    wrong = rows.join(index.where("feature = 'b01'").select(F.col("value").alias("b01"), "slot"), "b01", "left")
    kept = wrong.select("b01", "slot", F.unwrap_udt("b01_vec").alias("v"), F.unwrap_udt("b03_vec").alias("w"))
    assert vectors == ["b01_vec", "b03_vec"] and kept.count() == 30000
    assert kept.where("v.size <> 3000 or size(v.indices) <> if(slot is null, 0, 1) or (slot is not null and v.indices[0] <> slot)").count() == 0
    assert kept.where("size(w.indices) <> 1").count() == 0
    assert kept.where("v.type <> 0 or exists(v.values, x -> x <> 1.0) or size(v.values) <> size(v.indices)").count() == 0


@pytest.mark.parametrize("limit", [10, 100_000])
def test_long_one_hot_vectors_name_no_slot(spark, limit):
    """Names in the metadata of a column are held by the driver, one for each category."""
    counts = encoding.target_means(fitted(spark), ["b01"]).drop("mean")
    index = stage(encoding.long_index(stage(counts, "counts")), "index")
    rows, _ = encoding.one_hot_long(scored(spark).select("rk", "b01"), ["b01"], index, limit)
    assert len(rows.schema.json()) < 2000
    assert rows.first()["b01_vec"].size == 3000


def test_chi_square_of_slots_matches_the_spark_test(spark):
    df = spark.range(4000).selectExpr(
        "cast(id as string) rk", "if(id % 3 = 0, 'x', if(id % 5 = 0, 'y', 'z')) b01", "cast(id % 2 as string) b02",
        "cast((id % 3 + id % 4) > 2 as int) label", "cast(id % 11 as double) c01", "cast(if(id % 10 < 9, 1, id) as double) c02", "7.0D c03",
    )
    order = {"b01": ["z", "x", "y"], "b02": ["0", "1"]}
    table = encoding.chi_square_slots(df, order, ["c01", "c02", "c03"]).orderBy("slot").collect()
    assert [r["name"] for r in table] == ["b01=z", "b01=x", "b01=y", "b02=0", "b02=1", "c01", "c02", "c03"]
    cuts = encoding.quantile_cuts(df, ["c01", "c02", "c03"])
    binned = {c: sum((F.col(c) >= q).cast("double") for q in cuts[c]) for c in cuts}
    cells = [(F.col(c) == v).cast("double") for c, values in order.items() for v in values] + [binned[c] for c in ("c01", "c02", "c03")]
    names = [f"s{i}" for i in range(len(cells))]
    vectors = encoding.assembler(names).transform(df.select("label", *[c.alias(n) for c, n in zip(cells, names)]))
    theirs = ChiSquareTest.test(vectors, "features", "label").first()
    for i, r in enumerate(table):
        assert (r["statistic"], r["dof"]) == (pytest.approx(theirs["statistics"][i]), theirs["degreesOfFreedom"][i])
    assert [r["slot"] for r in encoding.select_slots(encoding.chi_square_slots(df, order, ["c01"]), 2).collect()] != [0, 1]


def test_sparse_and_dense_dot(spark):
    from clickloom.functions import vector_dot
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.dense([1.0, 2.0, 3.0]),), (Vectors.sparse(3, [2], [4.0]),), (Vectors.sparse(3, [], []),)], ["v"])
    assert [r[0] for r in rows.select(vector_dot("v", [0.5, -1.0, 0.25], 2.0)).collect()] == [1.25, 3.0, 2.0]
    assert rows.select(vector_to_array("v")).count() == 3


def test_few_long_columns_move_the_rows_once_each(spark, monkeypatch, plain_shuffles):
    """Rows are neither numbered nor brought back together, and a category that has its mean is not carried on."""
    encoder = encoding.fit_target_means(fitted(spark), ["b01", "b03"])
    one_by_one = encoder.apply(scored(spark), broadcast_rows=10)
    plan = one_by_one._jdf.queryExecution().executedPlan().toString()
    assert "_row" not in plan and plan.count("SortMergeJoin") == 2
    monkeypatch.setattr(encoding, "LONG_AT_ONCE", 1)
    together = encoder.apply(scored(spark), broadcast_rows=10)
    assert "hashpartitioning(_row" in together._jdf.queryExecution().executedPlan().toString()
    assert together.columns == one_by_one.columns
    assert sorted(map(tuple, together.collect()), key=str) == sorted(map(tuple, one_by_one.collect()), key=str)


def test_dropped_columns_are_not_shuffled(spark, plain_shuffles):
    encoder = encoding.fit_target_means(fitted(spark), ["b01", "b02"])
    whole = lookup.attach_many(scored(spark), ["b01", "b02"], encoder.means, "mean", "_m", 3500)
    narrow = lookup.attach_many(scored(spark), ["b01", "b02"], encoder.means, "mean", "_m", 3500, drop=True)
    assert narrow.columns == ["rk", "b03", "label", "b01_m", "b02_m"]
    assert sorted(map(tuple, narrow.collect()), key=str) == sorted(map(tuple, whole.select(narrow.columns).collect()), key=str)
    packed = re.findall(r"struct\(.*? AS _p#", narrow._jdf.queryExecution().analyzed().toString())
    assert packed and not any("b01" in p for p in packed)


def test_categories_that_may_all_be_hot_move_no_row(spark, plain_shuffles):
    """Above the broadcast limit, but no more than may be hot: only the longer column shuffles the rows."""
    rows = fitted(spark)
    encoder = encoding.fit_target_means(rows, ["b01", "b02"])
    found = encoder.apply(rows, broadcast_rows=10)
    assert found._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, encoder.apply(rows).collect()))


def test_no_line_moves_for_its_customer(spark, plain_shuffles):
    """Customers meet the orders, not the lines."""
    lines = training_view(spark, "/root/testdata/sf0.001", True)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(o_custkey" in line)
    depth = lines[at].index("Exchange")
    below = [x for x in lines[at:]]
    end = next((i for i, x in enumerate(below[1:], 1) if len(x) - len(x.lstrip(" :+-")) <= depth - 4), len(below))
    scans = [x for x in below[:end] if "FileScan" in x]
    assert scans and not any("l_orderkey" in x for x in scans)
    both = [training_view(spark, "/root/testdata/sf0.001", first) for first in (True, False)]
    assert both[0].columns == both[1].columns and both[0].exceptAll(both[1]).isEmpty() and both[1].exceptAll(both[0]).isEmpty()

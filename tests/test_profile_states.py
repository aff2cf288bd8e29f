"""Merged profile states against exact numbers, and what flows leave in the staging folder."""

import glob
import math
import re

import pytest
from pyspark.sql import functions as F

from clickloom.operators import profile
from clickloom.plans import flows
from clickloom.plans.queries import QUERIES
from clickloom.sources import tables
from clickloom.sources.training_view import CATEGORICAL, NUMERIC, training_view

SF_DIR = "/root/testdata/sf0.01"


def test_merged_estimates_are_within_their_bounds(spark):
    rows = tables.stage(training_view(spark, SF_DIR), "view")
    n = rows.count()
    for r in QUERIES["merged_quantiles"](spark, SF_DIR).collect():
        c = r["feature"]
        for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            below, upto = rows.agg(F.count_if(F.col(c) < r[q]), F.count_if(F.col(c) <= r[q])).first()
            assert below / n - profile.QUANTILE_ERROR <= p <= upto / n + profile.QUANTILE_ERROR
    error = 4 * 1.04 / math.sqrt(2**profile.DISTINCT_BITS)
    for r in QUERIES["merged_categorical_profile"](spark, SF_DIR).collect():
        exact = rows.agg(F.count_distinct(r["feature"]).alias("u"), F.count_if(F.col(r["feature"]) == "").alias("b")).first()
        assert abs(r["n_unique"] - exact["u"]) <= max(1, error * exact["u"]) and (r["n"], r["n_missing"], r["n_blank"]) == (n, 0, exact["b"])
        best = rows.groupBy(r["feature"]).count().orderBy(F.desc("count")).first()["count"]
        assert r["top"][0]["count"] == pytest.approx(best, abs=n / profile.TOP_TRACKED + 1)


def test_states_merge_like_the_whole(spark):
    rows = spark.range(1000).selectExpr("if(id % 9 = 0, null, cast(id as double)) c01", "if(id % 4 = 0, null, '') b01")
    parts = [profile.profile_state(p, ["c01"], ["b01"]) for p in (rows.where("c01 < 300"), rows.where("c01 >= 300 or c01 is null"), rows.limit(0))]
    merged = profile.merge_states(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    got, whole = (profile.numeric_from_state(s, ["c01"]).first() for s in (merged, profile.profile_state(rows, ["c01"], ["b01"])))
    assert got["n"] == 888 and got["n_missing"] == 112 and got[:3] == whole[:3] and (got["min"], got["max"]) == (1.0, 998.0)
    assert got["mean"] == pytest.approx(whole["mean"]) and got["stddev"] == pytest.approx(rows.agg(F.stddev_samp("c01")).first()[0])
    assert profile.categorical_from_state(merged, ["b01"]).first()["n_blank"] == 750
    empty = profile.numeric_from_state(profile.profile_state(rows.limit(0), ["c01"], ["b01"]), ["c01"]).first()
    assert (empty["n"], empty["mean"], empty["median"]) == (0, None, None)


def test_flows_leave_only_what_their_result_needs(spark):
    folder = re.sub("^file:", "", tables.shared_folder(spark)) + "/staged/"
    rows = tables.stage(training_view(spark, "/root/testdata/sf0.001"), "view")

    def made(run):
        before = set(glob.glob(folder + "*"))
        kept = run()
        return kept, sorted(re.sub("-[0-9a-f]{32}$", "", p.rsplit("/", 1)[1]) for p in set(glob.glob(folder + "*")) - before)

    prepared, left = made(lambda: flows.prepare_means(rows, fold=False, broadcast_rows=10))
    assert left == ["mean-features", "target-means"] and prepared.rows.count() == rows.count()
    assert prepared.apply(rows, ["rk"]).count() == rows.count()
    prepared, left = made(lambda: flows.prepare_onehot(rows))
    assert left == ["category-counts", "onehot-features"] and prepared.apply(rows, ["rk"]).count() == rows.count()

    def nested():
        with tables.staging(spark):
            flows.prepare_onehot(rows)

    assert made(nested)[1] == []


def test_columns_of_the_profiles(spark):
    assert QUERIES["merged_numeric_profile"](spark, SF_DIR).count() == len(NUMERIC)
    assert QUERIES["merged_categorical_profile"](spark, SF_DIR).count() == len(CATEGORICAL)

"""Plans of the main operators: what is read, what is shuffled, what is broadcast."""

import re

from clickloom.operators import cleaning, evaluate, profile
from clickloom.plans import queries
from clickloom.plans.queries import QUERIES, scored
from clickloom.sources.tables import stage
from clickloom.sources.training_view import CATEGORICAL, NUMERIC, training_view

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", plan(df)))


def test_scan_reads_only_the_columns_of_the_query(spark):
    rows = stage(training_view(spark, SF_DIR), "view")
    text = plan(profile.category_frequency(rows, ["b01", "b02"]))
    assert "ReadSchema: struct<b01:string,b02:string>" in text
    text = plan(profile.distinct_negatives(rows, "c03"))
    assert "PushedFilters: [IsNotNull(c03), LessThan(c03,0.0)]" in text and "ReadSchema: struct<c03:double>" in text


def test_scoring_and_cleaning_do_not_shuffle(spark):
    rows = stage(training_view(spark, SF_DIR), "view")
    filled = cleaning.impute_blank(rows, CATEGORICAL)
    counts = stage(cleaning.frequent_counts(filled, CATEGORICAL), "counts")
    folded = cleaning.fit_folding(counts, CATEGORICAL).apply(filled)
    assert shuffles(cleaning.log_transform(folded, NUMERIC)) == 0
    assert "Join" not in plan(folded)


def test_metrics_take_one_shuffle_of_partial_results(spark):
    df = scored(spark, SF_DIR).select("data", "label", "probability", "prediction")
    base = shuffles(df)
    for metric in (evaluate.confusion_matrix(df, ["data"]), evaluate.log_loss(df, ["data"])):
        assert shuffles(metric) == base + 1


def test_no_query_uses_python_workers_or_cross_joins(spark):
    slow = ("train_", "cross_validate", "cv_results", "descent_", "slice_features", "feature_importance", "coefficients", "training_history")
    for name in (n for n in QUERIES if not n.startswith(slow)):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_top_rows_are_taken_per_task(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["sample_n"](spark, SF_DIR))
    assert queries.QUERIES["limit_rows"](spark, SF_DIR).count() == 100

"""Each operator on an empty table and on the messy one."""

import pytest

from clickloom.llm import decontamination, line_quality, packing, pii, quality_rules, repeats, secrets, simhash, toxicity, url_filter

LABELS = "doc_id bigint, quality int, toxic int, kept string"


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0, "a"), (1, 1, 0, "a"), (3, 0, 1, "a"), (5, None, None, "a"), (None, 1, 0, "a"), (6, 0, 1, "a"), (99, 1, 1, "a")], LABELS)


OPERATORS = {
    "secrets": lambda d, _: secrets.scan(d, path_col="source"),
    "repeats": lambda d, _: repeats.remove(d),
    "pii": lambda d, _: pii.find(d),
    "toxicity": lambda d, x: toxicity.predict(d, toxicity.fit(d, x)),
    "simhash": lambda d, _: simhash.near_duplicates(d),
    "line_quality": lambda d, x: line_quality.predict(d, line_quality.fit(d, x)),
    "quality_rules": lambda d, _: quality_rules.judge(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(name, messy, nothing, labels):
    assert OPERATORS[name](messy, labels).count() == messy.count()
    assert OPERATORS[name](nothing, labels.limit(0)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows_are_alike(name, messy, labels):
    rows = [tuple(r) for r in OPERATORS[name](messy, labels).where("doc_id = 1").collect()]
    assert len(rows) == 2 and rows[0] == rows[1]


def test_packing(messy, nothing):
    got = packing.pack(messy).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3, 4, 5, 6, 7, 8, 9, None} and sum(r["piece"] == 0 for r in got) == messy.count()
    assert packing.pack(nothing).count() == 0


def test_decontamination(spark, messy, nothing):
    items = spark.createDataFrame([(1, "old wall and the people of the town walk", "z"), (2, None, "z"), (3, "short", "z")], "item_id bigint, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(messy, items).collect()}
    assert got == {(1, 1), (None, 1), (5, 1)}
    assert decontamination.matches(nothing, items).count() == 0 and decontamination.matches(messy, items.limit(0)).count() == 0


def test_url_filter(spark, labels):
    pages = spark.createDataFrame(
        [(1, "http://A.com/x", "a", 1), (1, "http://A.com/x", "a", 1), (None, "no scheme", "b", 2), (2, None, "c", 3), (3, "x://", "d", 4), (4, "http://" + "a." * 5000 + "com/y?z", None, None)],
        "page_id bigint, url string, host string, n int",
    )
    got = url_filter.judge(pages, url_filter.outcomes(pages, labels))
    assert got.count() == 6 and {r["host"] for r in got.where("page_id is null or page_id in (2, 3)").collect()} == {""}
    assert url_filter.judge(pages.limit(0), url_filter.outcomes(pages.limit(0), labels)).count() == 0

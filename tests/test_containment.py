"""Containment against a plain recursive check, on parsed and on stored records."""

import json

import pytest
from helpers import records
from pyspark.sql import functions as F

from tidemark.functions import contains
from tidemark.operators.flat import flatten
from tidemark.operators.landing import to_landing
from tidemark.operators.serve import containing

VALUES = [
    {"a": 1}, {"a": 1.0}, {"a": "1"}, {"a": True}, {"a": None}, {"a": {}}, {"a": []}, {},
    {"a": 1, "b": 2}, {"a": {"b": 1, "c": [1, 2]}}, {"a": {"b": "1"}}, {"a": [1, 2, 3]}, {"a": [3, "2", 1.0]},
    {"a": [{"x": 1, "y": 2}, {"x": 2}]}, {"a": [[1, 2], [3]]}, {"a": [None, True]}, {"a": 1e3}, {"a": 1000},
    {"a": 0.1}, {"a": -0.0}, {"a": 12345678901234567890}, {"it's": 1, "b c": {"d.e": "x"}}, {"a": "x" * 300},
    [1, 2, 3], ["1"], [[1]], [{"a": 1}], 1, "1", None, True, "x", 100, 10.50,
]

PATTERNS = VALUES + [
    {"a": 10}, {"a": [1]}, {"a": [2, 1]}, {"a": [1, 1]}, {"a": ["2"]}, {"a": [{"x": 1}]}, {"a": [{"x": 2}, {"y": 2}]},
    {"a": [[2]]}, {"a": [None]}, {"a": {"c": [2]}}, {"a": {"c": []}}, {"b c": {"d.e": "x"}}, [3, 1], [], [[]],
    10.5, False, 2, {"a": False}, {"c": 1},
]


def holds(value, pattern, top=True):
    number = (int, float)
    if isinstance(pattern, dict):
        return isinstance(value, dict) and all(k in value and holds(value[k], p, False) for k, p in pattern.items())
    if isinstance(pattern, list):
        return isinstance(value, list) and all(any(holds(v, p, False) for v in value) for p in pattern)
    if top and isinstance(value, list):
        return any(not isinstance(v, (dict, list)) and holds(v, pattern, False) for v in value)
    if isinstance(pattern, bool) or isinstance(value, bool):
        return pattern is value
    if isinstance(pattern, number):
        return isinstance(value, number) and value == pattern
    return type(value) is type(pattern) and value == pattern


@pytest.fixture(scope="module", params=["parsed", "stored"])
def values(request, spark, tmp_path_factory):
    recs = records(spark, *[json.dumps(v) for v in VALUES]).select(F.col("rec").alias("raw"), F.col("ord").alias("n"))
    if request.param == "parsed":
        return recs
    path = str(tmp_path_factory.mktemp("stored") / "values")
    recs.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_every_pattern_on_every_value(values):
    checks = [contains(F.col("raw"), p).alias(f"p{i}") for i, p in enumerate(PATTERNS)]
    for start in range(0, len(checks), 10):
        part = checks[start : start + 10]
        for row in values.select("n", *part).collect():
            for offset, got in enumerate(row[1:]):
                pattern = PATTERNS[start + offset]
                assert got == holds(VALUES[row.n], pattern), (VALUES[row.n], pattern)


@pytest.mark.parametrize("pattern", [{"a": "1"}, {"a": {"b": 1}}, {"a": 1}, {"it's": 1}, {"a": [1]}])
def test_as_a_filter(values, pattern):
    got = {r.n for r in containing(values, pattern).collect()}
    assert got == {i for i, v in enumerate(VALUES) if holds(v, pattern)}


def test_filter_over_shredded_rows_of_one_type(spark, tmp_path):
    """A stored member is a typed column; the pushed comparison must not lose rows."""
    path = str(tmp_path / "rows")
    texts = spark.range(5000).selectExpr(
        "id as seq", "to_json(named_struct('hash', string(id), 'k', id % 7, 's', concat('s', id % 5))) as value"
    )
    texts.selectExpr("parse_json(value) as raw").coalesce(1).write.parquet(path)
    stored = spark.read.parquet(path)
    assert containing(stored, {"k": 3, "s": "s4"}).count() == sum(i % 7 == 3 and i % 5 == 4 for i in range(5000))
    assert containing(stored, {"hash": "4999"}).count() == 1


def test_flat_columns_narrow_the_scan_and_keep_the_result(spark, tmp_path):
    rows = [
        {"hash": "1", "stateAbbreviation": "TX", "tags": [1, 2]},
        {"hash": "2", "stateAbbreviation": "TX"},
        {"hash": "3", "stateAbbreviation": "CA", "tags": [2]},
        {"hash": "4", "stateAbbreviation": "", "tags": [2]},
        {"hash": "5", "stateAbbreviation": None},
    ]
    path = str(tmp_path / "flat")
    flatten(to_landing(records(spark, *rows)).drop("ord")).write.parquet(path)
    flat = spark.read.parquet(path)
    for pattern in ({"stateAbbreviation": "TX"}, {"stateAbbreviation": "TX", "tags": [2]}, {"tags": [2]},
                    {"stateAbbreviation": ""}, {"stateAbbreviation": None}):
        assert {r.hash for r in containing(flat, pattern).collect()} == {r["hash"] for r in rows if holds(r, pattern)}


def test_member_names_with_both_quotes_are_refused(spark):
    with pytest.raises(ValueError, match="quote"):
        contains(F.col("raw"), {"a'\"b": 1})
    with pytest.raises(TypeError):
        contains(F.col("raw"), {"a": object()})

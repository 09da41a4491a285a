from datetime import datetime, timedelta, timezone

import pytest
from helpers import utc
from pyspark.sql import functions as F

from tidemark.functions import from_micros, instant, iso_instant, later_of
from tidemark.operators.mark import RESUME, TODAY_GUARD, high_water_mark, next_mark, row_count

AS_OF = datetime(2024, 1, 20, 10, 30)


def landing(spark, *instants):
    rows = [(str(i), t) for i, t in enumerate(instants)]
    return spark.createDataFrame(rows, "hash string, t string").selectExpr("hash", "cast(t as timestamp) as lastrefresh")


def mark_of(df):
    return from_micros(df.select(F.unix_micros("mark").alias("m")).first().m)


@pytest.mark.parametrize("policy", [RESUME, TODAY_GUARD])
@pytest.mark.parametrize("instants", [(), (None, None)])
def test_without_any_refresh_the_day_start_is_the_mark(spark, instants, policy):
    rows = landing(spark, *instants)
    assert row_count(rows).first().n_rows == len(instants)
    assert high_water_mark(rows).first().mark is None
    assert mark_of(next_mark(rows, AS_OF, policy)) == utc(2024, 1, 20)


def test_policies_differ_only_before_midnight(spark):
    earlier = landing(spark, "2024-01-19 18:00:00", None)
    assert mark_of(next_mark(earlier, AS_OF, RESUME)) == utc(2024, 1, 19, 18)
    assert mark_of(next_mark(earlier, AS_OF, TODAY_GUARD)) == utc(2024, 1, 20)
    later = landing(spark, "2024-01-20 00:00:00.123456")
    for policy in (RESUME, TODAY_GUARD):
        assert mark_of(next_mark(later, AS_OF, policy)) == utc(2024, 1, 20, 0, 0, 0, 123456)


def test_as_of_may_carry_a_zone(spark):
    zone = timezone(timedelta(hours=-5))
    assert mark_of(next_mark(landing(spark), datetime(2024, 1, 19, 22, tzinfo=zone))) == utc(2024, 1, 20)


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError, match="unknown mark policy"):
        next_mark(landing(spark), AS_OF, "yesterday")


def test_instants_compare_as_instants_and_render_as_iso(spark):
    a, b = utc(2024, 1, 1, 0, 0, 0, 123456), utc(2024, 1, 1)
    row = spark.range(1).select(
        iso_instant(later_of(instant(a), instant(b), F.lit(None).cast("timestamp"))).alias("later"),
        iso_instant(instant(b)).alias("iso"),
    )
    assert tuple(row.first()) == ("2024-01-01T00:00:00.123456Z", "2024-01-01T00:00:00.000000Z")

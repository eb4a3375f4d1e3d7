import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import numbers, text
from millrace.functions.dates import calendar_age, clock_of, date_from_parts, ordinal_day, second_of_day, time_part
from millrace.functions.geo import haversine_km, point_parts
from millrace.functions.keys import label_id, row_hash, seeded_uniform, surrogate_key
from millrace.functions.sql import register_sql_functions
from millrace.functions.vectors import blend, inner_product, l2_normalise


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize("later, earlier, years, months, days", [
    ("2024-03-01", "2024-01-31", 0, 1, 31),  # a month of 30 days and one day
    ("2023-03-01", "2023-02-28", 0, 0, 1),
    ("2024-02-29", "2023-02-28", 1, 12, 366.25),
    ("2025-02-28", "2024-02-29", 0, 11, 358),  # borrows the 29 days of the first month
    ("2024-05-05", "2024-05-05", 0, 0, 0),
    ("2024-01-01", "2023-12-31", 0, 0, 1),
    ("2023-12-31", "2024-01-01", 0, 0, -1),
])
def test_calendar_age(spark, later, earlier, years, months, days):
    age = calendar_age(F.lit(later).cast("date"), F.lit(earlier).cast("date"))
    got = one(spark, age.years, age.months, age.days)
    assert (got[0], got[1], float(got[2])) == (years, months, days)


def test_age_without_a_date(spark):
    age = calendar_age(F.lit("2024-01-01").cast("date"), F.lit(None).cast("date"))
    assert one(spark, age.years, age.months, age.days) == (None, None, None)


def test_distance(spark):
    bandung, cimahi = (F.lit(-6.9215529), F.lit(107.6110212)), (F.lit(-6.8712), F.lit(107.5548))
    here, = one(spark, haversine_km(*bandung, *bandung))
    near, = one(spark, haversine_km(*bandung, *cimahi))
    assert here == 0 and 7 < near < 10
    north, = one(spark, haversine_km(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0)))
    assert math.isclose(north, 6371 * math.pi / 2)
    # the old formula is zero as soon as one of the coordinates is the same
    assert one(spark, haversine_km(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0), legacy=True)) == (0.0,)


def test_point(spark):
    assert one(spark, *point_parts(F.lit("(-7.3302642, 110.4995353)"))) == (-7.3302642, 110.4995353)
    assert one(spark, *point_parts(F.lit("nowhere"))) == (None, None)


def test_keys(spark):
    digest = hashlib.sha256("a||null||1".encode()).hexdigest()
    got = one(spark, surrogate_key(F.lit(1)), row_hash([F.lit("a"), F.lit(None), F.lit(1)]),
              label_id(F.lit("IPO")), surrogate_key(F.lit("a"), F.lit(None)))
    assert got == (
        "c4ca4238a0b923820dcc509a6f75849b", digest,
        "54a22fae449c3a25678fdf6fc62c628b0fc67f61d6cfe9d8e738c60116d04d3f",
        hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest(),
    )


def test_hash_without_null_text_collides(spark):
    a, n = F.lit("a"), F.lit(None).cast("string")
    left, right = one(spark, row_hash([a, n], null_text=None), row_hash([n, a], null_text=None))
    assert left == right
    left, right = one(spark, row_hash([a, n]), row_hash([n, a]))
    assert left != right


def test_seeded_numbers_are_spread(spark):
    got = spark.range(4000).select(seeded_uniform(3, "id").alias("u")).agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(got[0] - 0.5) < 0.02 and got[1] >= 0 and got[2] < 1


def test_dates(spark):
    days = [one(spark, ordinal_day(F.lit(f"2024-01-{d:02d}").cast("date")))[0] for d in (1, 2, 3, 4, 11, 12, 13, 20, 21, 22, 31)]
    assert days == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "20th", "21st", "22nd", "31st"]
    assert one(spark, date_from_parts(2022, F.lit("mar"), F.lit(3))) == (dt.date(2022, 3, 3),)
    moment = F.lit("2024-01-01 09:05:07").cast("timestamp_ntz")
    assert one(spark, time_part(moment), clock_of(second_of_day(moment))) == ("09:05:07", "09:05:07")


def test_text(spark):
    got = one(
        spark, text.letters(F.lit("12-Mar")), text.letters(F.lit("12")), text.slug(F.lit("Dr. Ann, Lee")),
        text.number_before(F.lit("7/10"), "/10"), text.number_before(F.lit("x"), "/10"),
        text.feature_text([F.lit("a"), F.lit(None).cast("string"), F.lit("c")]), text.text_list(F.lit("['a', 'b']")),
        text.blank(F.lit("  ")), text.swap(F.lit("a.b.c"), ".", "_"), text.path_of("/img/", F.lit(7), ".jpg"),
        text.first_token(F.lit("Toyota Yaris")), text.starts_like(F.lit("-3"), "-"),
    )
    assert got == ("Mar", None, "dr_ann_lee", 7, None, "a  c", ["a", "b"], True, "a_b_c", "/img/7.jpg", "Toyota", True)


def test_numbers(spark):
    got = one(
        spark, numbers.safe_divide(F.lit(1), F.lit(0)), numbers.to_number(F.lit("x")),
        numbers.outcome_flag(F.lit("other")), numbers.yes_flag(F.lit(None)), numbers.discount_fraction(F.lit(10.0), F.lit(7.5)),
    )
    assert got == (None, None, None, 0, 0.25)
    frame = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "x double")
    assert tuple(frame.agg(numbers.exact_mean("x"), numbers.rounded_mean("x", 1)).first()) == (0.1, 0.1)


def test_vectors(spark):
    a, b = F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(0.0), F.lit(2.0))
    unit, product, mixed = one(spark, l2_normalise(a), inner_product(a, b), blend(a, b))
    assert unit == [0.6, 0.8] and product == 8.0
    assert math.isclose(sum(x * x for x in mixed), 1.0)
    assert one(spark, l2_normalise(F.array(F.lit(0.0), F.lit(0.0)))) == ([0.0, 0.0],)


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql("SELECT password_check('Abcdefg1'), password_check('abc'), password_check(null), "
                    "surrogate_key('1'), round(haversine_distance(0, 0, 0, 180), 3)").first()
    assert tuple(row) == (True, False, False, "c4ca4238a0b923820dcc509a6f75849b", round(6371 * math.pi, 3))

import pytest
from pyspark.sql import functions as F

from tidebook.functions.numbers import cents, from_cents, plain_text, ratio, round2, wide_sum

# Published revenue, orders and average ticket of ten customers. Two of the
# quotients lie on an exact half.
TICKETS = [
    (1087838.44, 26, 41839.94),
    (916262.58, 22, 41648.3),
    (1082775.89, 26, 41645.23),
    (655737.2, 16, 40983.57),
    (815471.3, 20, 40773.56),
    (726127.99, 18, 40340.44),
    (1040553.09, 26, 40021.27),
    (997616.46, 25, 39904.66),
    (677297.78, 17, 39841.05),
    (1146455.22, 29, 39532.94),
]

# Published weekday totals, calendar days and averages.
WEEKDAYS = [
    (57758021.43, 365, 158241.15),
    (60633373.26, 365, 166118.83),
    (63539589.22, 366, 173605.44),
    (57518480.61, 366, 157154.32),
    (62120694.25, 365, 170193.68),
    (60173268.58, 365, 164858.27),
    (57529887.95, 365, 157616.13),
]


@pytest.mark.parametrize("published", [TICKETS, WEEKDAYS])
def test_published_averages(spark, published):
    df = spark.createDataFrame(published, "total double, n bigint, average double")
    found = df.select(round2(ratio(F.col("total"), F.col("n"))).alias("r"), "average").collect()
    assert [r["r"] for r in found] == [r["average"] for r in found]


def test_ratio_guards_zero(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 4)], "a double, b bigint")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.25]


def test_cents_add_up_exactly_in_any_order(spark):
    amounts = [(0.1,), (0.2,), (0.3,), (1e9 + 0.01,), (-1e9,)] * 200
    for data in (amounts, amounts[::-1]):
        df = spark.createDataFrame(data, "x double").repartition(7)
        assert df.agg(from_cents(F.sum(cents(F.col("x"))))).first()[0] == 122.0


def test_wide_sum_exceeds_64_bits(spark):
    df = spark.range(4).select(F.lit(9_000_000_000_000_000_000).alias("x"))
    assert int(df.agg(wide_sum(F.col("x"))).first()[0]) == 36_000_000_000_000_000_000


@pytest.mark.parametrize(
    "value, text",
    [
        (57758021.43, "57758021.43"),
        (655737.2, "655737.2"),
        (0.2565525786018403, "0.2565525786018403"),
        (38.666666666666664, "38.666666666666664"),
        (1e7, "10000000.0"),
        (-12345678.5, "-12345678.5"),
        (0.00012, "0.00012"),
        (0.0, "0.0"),
        (41648.0, "41648.0"),
        (None, None),
    ],
)
def test_plain_text(spark, value, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(plain_text(F.col("x"))).first()[0] == text

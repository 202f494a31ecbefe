import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.functions import duration_minutes, duration_problem, duration_seconds

SECONDS = {
    "PT20M": 1200,
    "PT1H30M": 5400,
    "PT7H": 25200,
    "PT": 0,
    "PT0S": 0,
    "PT59S": 59,
    "PT60S": 60,
    "PT90S": 90,
    "PT1.5H": 5400,
    "PT0,5M": 30,
    "PT0.7H": 2520,
    "PT0.333333333H": 1199,
    "PT59.9999996S": 60,
    "PT59.999S": 59,
    "P1DT2H": 93600,
    "P2W": 1209600,
    "P1DT": 86400,
    "P1.5DT": 129600,
    "P1W2DT3H4M5.6S": 788645,
    "PT999999999M": 59999999940,
    "P999999999W": 604799999395200,
}
NOT_DURATIONS = [
    "",
    "P",
    "20",
    " PT5M",
    "PT5M ",
    "pt5m",
    "PT1M1H",
    "PTH",
    "PT.5H",
    "PT5",
    "PT1H1H",
    "P1H",
    "PT1D",
    "PT99999999999M",
    "-PT5M",
    "P1Y",
    "P1M",
    "about an hour",
]


def column_of(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_seconds(spark):
    assert column_of(spark, SECONDS, duration_seconds("d")) == list(SECONDS.values())


def test_anything_else_is_null(spark):
    texts = [*NOT_DURATIONS, None]
    assert column_of(spark, texts, duration_seconds("d")) == [None] * len(texts)


def test_minutes_drop_the_rest(spark):
    expected = [s // 60 for s in SECONDS.values()]
    assert column_of(spark, SECONDS, duration_minutes("d")) == expected


def test_type_is_bigint(spark):
    df = spark.createDataFrame([("PT1M",)], "d string")
    types = df.select(
        duration_seconds("d"), duration_minutes("d"), duration_minutes("d", wrap_days=True)
    ).schema
    assert {f.dataType.simpleString() for f in types} == {"bigint"}


def test_wrap_days(spark):
    texts = ["PT24H", "P1DT2H", "PT25H30M", "P2W", "PT90M", "bad"]
    expected = [0, 120, 90, 0, 90, None]
    assert column_of(spark, texts, duration_minutes("d", wrap_days=True)) == expected


def test_problem(spark):
    texts = [None, "", "PT5M", "PT1.5H", "soon"]
    expected = ["missing", "malformed", None, None, "malformed"]
    assert column_of(spark, texts, duration_problem("d")) == expected


def test_problem_agrees_with_parser(spark):
    texts = [*SECONDS, *NOT_DURATIONS, None]
    agree = duration_problem("d").isNull() == duration_seconds("d").isNotNull()
    assert column_of(spark, texts, agree) == [True] * len(texts)


part = st.integers(0, 10_000) | st.none()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(part, part, part, part, part), min_size=50, max_size=200))
def test_text_from_numbers(spark, parts):
    texts, expected = [], []
    for weeks, days, hours, minutes, seconds in parts:
        date = "".join(f"{n}{u}" for n, u in ((weeks, "W"), (days, "D")) if n is not None)
        time = "".join(
            f"{n}{u}" for n, u in ((hours, "H"), (minutes, "M"), (seconds, "S")) if n is not None
        )
        texts.append(f"P{date}T{time}")
        values = [n or 0 for n in (weeks, days, hours, minutes, seconds)]
        expected.append(
            sum(n * k for n, k in zip(values, (604800, 86400, 3600, 60, 1), strict=True))
        )
    assert column_of(spark, texts, duration_seconds("d")) == expected


def test_ansi_never_raises(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("PT",), ("PTM",), ("P99999999999999999999D",)], "d string")
    assert df.select(F.sum(duration_seconds("d"))).first()[0] == 0


@pytest.mark.parametrize("text", ["PT5M\tx", "PT5Mx", "xPT5M", "PT٥M"])
def test_no_partial_match(spark, text):
    assert column_of(spark, [text], duration_seconds("d")) == [None]


def test_line_ends_are_no_part_of_a_duration(spark):
    texts = ["PT5M", "PT5M\n", "PT5M\r", "PT5M\u2028", "PT5M "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(duration_seconds("t")).collect()]
    assert got == [300, None, None, None, None]

"""Validation rules and reject reasons (D1-D5, C3, K13); the source's assertions first."""

import pytest
from pyspark.sql import functions as F

from core_helpers import raw_df, sample
from eventmill.operators.transform import transform
from eventmill.operators.validate import decode_json


def reasons(spark, rows):
    return [r["reject_reason"] for r in transform(raw_df(spark, rows)).orderBy("event_id").collect()]


def reason_of(spark, **kw):
    return transform(raw_df(spark, [sample(**kw)])).first()["reject_reason"]


def test_valid_sample_is_accepted(spark):
    assert reason_of(spark) is None


@pytest.mark.parametrize("field", ["event_id", "user_id", "event_type", "timestamp"])
def test_missing_required_field(spark, field):
    assert reason_of(spark, **{field: ...}) == f"missing:{field}"


def test_user_id_not_a_number_fails_in_validation(spark):
    assert reason_of(spark, user_id="not_a_number") == "type:user_id"


@pytest.mark.parametrize("text,expected", [("12", 12), (" 12 ", 12), ("1_000", 1000), ("-5", -5)])
def test_user_id_integer_text(spark, text, expected):
    row = transform(raw_df(spark, [sample(user_id=text)])).first()
    assert row["reject_reason"] is None and row["user_id"] == expected


@pytest.mark.parametrize("text", ["not_a_number", "1.0", "", "12a"])
def test_user_id_bad_text(spark, text):
    assert reason_of(spark, user_id=text) == "type:user_id"


def test_blank_event_id(spark):
    assert reason_of(spark, event_id="   ") == "empty:event_id"
    assert reason_of(spark, event_id="\t") == "empty:event_id"


@pytest.mark.parametrize("ts", ["2024-01-15 10:30:00", "2024-01-15 10:30:00.123", "2024-01-15T10:30:00",
                                "2024-01-15T10:30:00Z", "2024-01-15", "20240115T103000"])
def test_accepted_timestamps(spark, ts):
    assert reason_of(spark, timestamp=ts) is None


@pytest.mark.parametrize("ts", ["2024", "2024-01", "10:30", "garbage", "2024-13-45T10:00:00"])
def test_refused_timestamps(spark, ts):
    assert reason_of(spark, timestamp=ts) == "format:timestamp"


def test_first_failing_rule_wins(spark):
    # bad user id (field 2) is reported before the missing type (field 3) and bad time
    assert reason_of(spark, user_id="x", event_type=..., timestamp="garbage") == "type:user_id"


def test_json_types_from_decoded_messages(spark):
    msgs = spark.createDataFrame([
        ('{"event_id": "a", "user_id": 5, "event_type": "click", "timestamp": "2024-01-15T10:30:00Z"}',),
        ('{"event_id": 7, "user_id": 5, "event_type": "click", "timestamp": "2024-01-15T10:30:00Z"}',),
        ('{"event_id": "c", "user_id": 1.5, "event_type": "click", "timestamp": "2024-01-15T10:30:00Z"}',),
        ('{"event_id": "d", "user_id": 5, "event_type": null, "timestamp": "2024-01-15T10:30:00Z"}',),
        ('{"event_id": "e", "user_id": 5, "timestamp": "2024-01-15T10:30:00Z"}',),
        ('not json at all',),
    ], "value string").withColumn("n", F.monotonically_increasing_id())
    got = [r["reject_reason"] for r in transform(decode_json(msgs)).orderBy("n").collect()]
    assert got == [None, "type:event_id", "type:user_id", "type:event_type", "missing:event_type", "decode:json"]


def test_validate_off_accepts_everything(spark):
    df = transform(raw_df(spark, [sample(user_id="x")]), validate=False)
    assert df.first()["reject_reason"] is None


def test_white_space_is_stripped_without_regular_expressions(spark):
    from pyspark.sql import functions as F

    from eventmill.operators.validate import strip_ws, user_id_int
    texts = [" 12 ", "\t\n\x0b\f\r", " 1_0\n", "\n-5\r\n", "1 2", "\u0085", " ", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select(strip_ws(F.col("t")).alias("s"), user_id_int(F.col("t")).alias("n")).orderBy("i")
    # a pattern scan for each message and field had been a good part of the decoding
    assert df.select(strip_ws(F.col("t")))._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 0
    assert [tuple(r) for r in got.collect()] == [("12", 12), ("", None), ("1_0", 10), ("-5", -5), ("1 2", None), ("\u0085", None), (" ", None), ("", None), (None, None)]

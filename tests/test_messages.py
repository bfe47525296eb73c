"""Messages in every shape a topic may hold."""

import math

import pytest
from pyspark.sql import functions as F

from scorewatch.functions.messages import normalize_probability, parse_messages, split_valid, to_message
from scorewatch.sources.streams import kafka_options, message_id, read_scored
from scorewatch.spec import FeatureSpec

SPEC = FeatureSpec(("a", "b"), "predicted_label")

MESSAGES = {
    "good": '{"a": 1.5, "b": 2}',
    "missing field": '{"a": 1.5}',
    "null field": '{"a": null, "b": 2}',
    "no field": "{}",
    "extra field": '{"a": 1.5, "b": 2, "c": 9}',
    "nan": '{"a": NaN, "b": 2}',
    "quoted nan": '{"a": "NaN", "b": 2}',
    "infinite": '{"a": Infinity, "b": 2}',
    "wrong type": '{"a": "x", "b": 2}',
    "not json": "hello",
    "cut off": '{"a": 1.5, "b"',
    "empty": "",
    "blank": "  ",
    "json null": "null",
    "array": "[1, 2]",
    "number": "7",
    "null": None,
}
VALID = {"good", "no field", "missing field", "null field", "extra field"}


@pytest.fixture
def messages(spark):
    return spark.createDataFrame(list(MESSAGES.items()), "name string, value string")


def test_bad_messages_are_marked_with_their_text(messages):
    rows = {r.name: r for r in parse_messages(messages, SPEC.schema()).collect()}
    assert {n for n, r in rows.items() if r.is_valid} == VALID
    for name in set(MESSAGES) - VALID:
        assert rows[name].raw_value == MESSAGES[name]
    assert (rows["good"].a, rows["good"].b) == (1.5, 2.0)
    assert rows["missing field"].b is None


def test_validity_does_not_depend_on_the_columns_read(messages):
    parsed = parse_messages(messages, SPEC.schema()).select("name", "b", "is_valid")
    assert {r.name for r in parsed.filter("is_valid").collect()} == VALID


def test_binary_values_are_read(messages):
    binary = messages.withColumn("value", F.col("value").cast("binary"))
    good, bad = split_valid(parse_messages(binary, SPEC.schema()), SPEC.schema())
    assert {r.name for r in good.collect()} == VALID
    assert {r.name for r in bad.collect()} == set(MESSAGES) - VALID
    assert bad.columns == ["name", "raw_value"]


def test_zero_fill_keeps_every_row(messages):
    rows = parse_messages(messages, SPEC.schema(), policy="zero_fill").collect()
    assert len(rows) == len(MESSAGES)
    by_name = {r.name: r for r in rows}
    assert by_name["not json"].a is None
    assert math.isnan(by_name["nan"].a)
    with pytest.raises(ValueError):
        parse_messages(messages, SPEC.schema(), policy="other")


@pytest.mark.parametrize(
    ("text", "pair"),
    [
        ('{"type":1,"values":[0.3,0.7]}', [0.3, 0.7]),
        ("[0.3, 0.7]", [0.3, 0.7]),
        ('"[0.3, 0.7]"', [0.3, 0.7]),
        ('"{\\"values\\":[0.3,0.7]}"', [0.3, 0.7]),
        ('{"other":1}', [0.0, 0.0]),
        ("junk", [0.0, 0.0]),
        ("0.5", [0.0, 0.0]),
        ("", [0.0, 0.0]),
        (None, [0.0, 0.0]),
        ("[0.5]", [0.5]),
    ],
)
def test_normalize_probability(spark, text, pair):
    df = spark.createDataFrame([(text,)], "p string")
    assert df.select(normalize_probability("p")).first()[0] == pair


def test_read_scored_fills_what_is_missing(spark):
    rows = [
        ('{"a": 1, "predicted_label": 1.0, "prediction_probability": {"type":1,"values":[0.1,0.9]}}',),
        ('{"a": 1, "b": null, "predicted_label": 0, "prediction_probability": "[0.8,0.2]"}',),
        ('{"b": 3, "prediction_probability": [0.4]}',),
        ("junk",),
    ]
    df = spark.createDataFrame(rows, "value string").coalesce(1)
    good = [(1.0, 0.1, 0.9, 1.0, 0.0), (0.0, 0.8, 0.2, 1.0, 0.0), (0.0, 0.4, 0.0, 0.0, 3.0)]
    found = read_scored(df, SPEC).collect()
    assert [tuple(r) for r in found] == [(*g, True, None) for g in good] + [(*[None] * 5, False, "junk")]
    zeros = read_scored(df, SPEC, policy="zero_fill").collect()
    assert [tuple(r) for r in zeros] == [*good, (0.0, 0.0, 0.0, 0.0, 0.0)]


@pytest.mark.parametrize(
    "text", ["not json at all", '{"a": 1, "predicted', None, "", '{"a": 1, "predicted_label": "high"}', '{"a": NaN}']
)
def test_read_scored_makes_no_case_of_junk(spark, text):
    row = read_scored(spark.createDataFrame([(text,)], "value string"), SPEC).first()
    assert not row.is_valid and row.raw_value == text
    assert row.predicted_label is None and row.benign_probability is None and row.a is None


def test_sent_messages_are_read_back(spark):
    df = spark.createDataFrame([(1.5, None, 1.0, [0.25, 0.75])], "a double, b double, l double, p array<double>")
    sent = df.select(
        to_message(
            ["a", "b", F.col("l").alias("predicted_label"), F.col("p").alias("prediction_probability")]
        ).alias("value")
    )
    assert '"prediction_probability":[0.25,0.75]' in sent.first().value
    assert tuple(read_scored(sent, SPEC).first()) == (1.0, 0.25, 0.75, 1.5, 0.0, True, None)


def test_message_id_and_kafka_options(spark):
    df = spark.createDataFrame([("t", 2, 17)], "topic string, partition int, offset bigint")
    assert message_id(df).first().message_id == "t-2-17"
    options = kafka_options("host:9092", "t", max_offsets=100)
    assert options["maxOffsetsPerTrigger"] == "100"
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "false"
    assert "maxOffsetsPerTrigger" not in kafka_options("host:9092", "t")

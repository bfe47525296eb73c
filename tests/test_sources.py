"""Files, rows from memory, connector options."""

from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from scorewatch.session import scratch_folder
from scorewatch.sinks import tables as sinks
from scorewatch.sources import connectors, tables
from scorewatch.spec import FeatureSpec, tumour_spec

SPEC = FeatureSpec(("a", "b"), "predicted_label")


def test_training_csv_with_a_trailing_column(spark, tmp_path):
    (tmp_path / "data.csv").write_text("id,diagnosis,concave points_mean,\n1,M,0.5,\n2,B,0.25,\n")
    df = tables.read_table(spark, str(tmp_path), "csv")
    assert df.columns == ["id", "diagnosis", "concave points_mean", "_c3"]
    assert dict(df.dtypes)["concave points_mean"] == "double"


def test_csv_without_header_needs_names(spark, tmp_path):
    (tmp_path / "data.csv").write_text("1,M,0.5\n2,B,\n")
    df = tables.read_table(spark, str(tmp_path), "csv", "id int, diagnosis string, r double", header=False)
    assert [tuple(r) for r in df.sort("id").collect()] == [(1, "M", 0.5), (2, "B", None)]
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path), "csv", header=False)


def test_rows_of_every_kind(spark):
    schema = "b double, a string"
    rows = [Row(a="x", b=1.0), {"a": "y", "b": 2}, (3, "z"), {"a": "w"}]
    found = [tuple(r) for r in tables.from_rows(spark, rows, schema).collect()]
    assert sorted(found, key=str) == [(1.0, "x"), (2.0, "y"), (3.0, "z"), (None, "w")]
    nested = "patient_id string, features map<string, double>"
    assert tables.from_rows(spark, [{"patient_id": "P1", "features": {"a": 1.0}}], nested).count() == 1
    with pytest.raises(ValueError):
        tables.from_rows(spark, [(1.0,)], schema)


def test_history_before_the_first_write_is_empty(spark, tmp_path):
    for fmt in ("parquet", "csv"):
        df = tables.read_history(spark, str(tmp_path / "none"), tumour_spec("x"), fmt)
        assert df.count() == 0 and len(df.columns) == 34


def test_history_appends_and_prunes_by_day(spark, tmp_path):
    path = str(tmp_path / "history")
    schema = tables.history_schema(SPEC)
    for day in (1, 2, 2):
        row = (datetime(2024, 1, day, 10), 1.0, 0.2, 0.8, 1.0, 2.0)
        sinks.append_history(spark.createDataFrame([row], schema), path)
    df = tables.read_history(spark, path, SPEC)
    assert df.count() == 3
    day = df.filter(F.col("date") == F.lit("2024-01-02").cast("date"))
    assert day.count() == 2
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().executedPlan().toString()


def test_bad_timestamps_are_kept_apart(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        "timestamp,predicted_label,benign_probability,malignant_probability,a,b\n"
        "2024-01-01 10:00:00.123456,1.0,0.2,0.8,1,2\nyesterday,0.0,0.9,0.1,1,2\n"
    )
    rows = tables.read_history(spark, str(tmp_path), SPEC, "csv").sort("predicted_label").collect()
    assert (rows[0].timestamp, rows[0].bad_timestamp) == (None, "yesterday")
    assert (rows[1].timestamp, rows[1].bad_timestamp) == (datetime(2024, 1, 1, 10, 0, 0, 123456), None)


def test_csv_export_has_a_header_and_microseconds(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0, 5), "x")], "ts timestamp, s string")
    sinks.export_csv(df, str(tmp_path / "out"), files=1)
    text = next((tmp_path / "out").glob("*.csv")).read_text()
    assert text == "ts,s\n2024-01-01T00:00:00.000005Z,x\n"


def test_connectors_by_format_name(spark, tmp_path):
    df = spark.createDataFrame([("id1", "Alice", 42.5)], "id string, name string, value double")
    for _ in range(2):
        sinks.write_connector(df, "parquet", path=str(tmp_path / "kv"))
    assert connectors.read_connector(spark, "parquet", path=str(tmp_path / "kv")).count() == 2


def test_jdbc_options():
    """No database is started here: only the options that reach Spark are checked."""
    write = sinks.jdbc_write_options("jdbc:x", "predictions", num_partitions=4, user="u")
    assert write == {
        "url": "jdbc:x",
        "dbtable": "predictions",
        "batchsize": "100",
        "isolationLevel": "READ_COMMITTED",
        "numPartitions": "4",
        "user": "u",
    }
    read = connectors.jdbc_read_options("jdbc:x", "t", "id", 0, 100, 8)
    assert (read["partitionColumn"], read["numPartitions"]) == ("id", "8")
    with pytest.raises(TypeError):
        connectors.jdbc_read_options("jdbc:x", "t")
    with pytest.raises(TypeError):
        sinks.jdbc_write_options("jdbc:x", "predictions")


def test_preview_is_bounded(spark):
    assert tables.preview(spark.range(100), 7).count() == 7


def test_scratch_folder_is_below_the_shared_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first.startswith(root) and first != second

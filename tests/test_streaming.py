"""The row-local rule pass on a file stream (memory sink, available-now trigger)."""

import pytest

from lintel.streaming import review_stream


def test_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "in"
    df = spark.createDataFrame([(1, -2.0, "x"), (2, 5.0, "O"), (3, 500.0, "F")], "id long, amount double, status string")
    df.write.parquet(str(src))
    rules = [{"type": "numeric_range", "column": "amount", "allow_negative": False, "max_value": 100},
             {"type": "allowed_values", "column": "status", "allowed_values": ["o", "f"]}]
    stream = spark.readStream.schema(df.schema).parquet(str(src))
    q = (review_stream(stream, rules).writeStream.format("memory").queryName("lintel_stream_issues")
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = sorted((r["id"], r["issue_type"]) for r in spark.sql("SELECT * FROM lintel_stream_issues").collect())
    assert got == [(1, "invalid_allowed_value_status"), (1, "range_check_amount"), (3, "range_check_amount")]


def test_stream_rejects_table_rules(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id long")
    df.write.parquet(str(tmp_path / "in2"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in2"))
    with pytest.raises(ValueError):
        review_stream(stream, [{"type": "duplicate", "column": "id"}])

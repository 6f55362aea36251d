import pytest
from pyspark.sql import functions as F

from tidemart.operators.quality import observed_gate, rule_counts
from tidemart.session import written

SCHEMA = "name string, v int"
ROWS = [("a", 1), (None, 2), ("b", -1), (None, None), ("b", -1), ("c", 5)]


@pytest.fixture
def rules(spark):
    return {"positive": F.col("v") > 0, "named": F.col("name").isNotNull()}


def test_batch_counts_equal_a_pass_of_their_own(spark, rules):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    gate, seen = observed_gate(df, rules, "batch")
    assert written(gate.passed, "clean").count() == 2
    assert gate.quarantined.count() == 4
    want = {r["rule"]: r["failing_rows"] for r in rule_counts(df, rules).collect()}
    assert seen.get == {"rows_seen": 6, **want}


def test_empty_and_failing(spark, rules):
    gate, seen = observed_gate(spark.createDataFrame([], SCHEMA), rules, "none")
    assert gate.passed.collect() == [] and seen.get["rows_seen"] == 0
    gate, _ = observed_gate(spark.createDataFrame(ROWS, SCHEMA), rules, "stop", "fail")
    with pytest.raises(Exception, match="quality gate"):
        gate.passed.collect()


def test_stream_reports_each_batch(spark, tmp_path, rules):
    source = str(tmp_path / "in")
    spark.createDataFrame(ROWS, SCHEMA).coalesce(1).write.json(source)
    spark.createDataFrame(ROWS[:3], SCHEMA).coalesce(1).write.mode("append").json(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(source)
    gate, seen = observed_gate(stream, rules, "gate")
    assert seen is None
    query = gate.passed.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    told = [p["observedMetrics"]["gate"] for p in query.recentProgress if p["numInputRows"]]
    assert sorted(m["rows_seen"] for m in told) == [3, 6]
    assert sum(m["named"] for m in told) == 3 and sum(m["positive"] for m in told) == 4
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3

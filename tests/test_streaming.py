from ledgerloom import functions as L
from ledgerloom.quality.rules import REASON
from ledgerloom.quality.validators import validate


def test_rules_work_on_a_stream(spark, tmp_path):
    schema = "SK_ID_BUREAU string, MONTHS_BALANCE string, STATUS string"
    spark.createDataFrame([("1", "-1", "C"), ("x", "-1", "C"), ("2", "0", None)], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    rejects = validate(stream, "bureau_balance").rejects.withColumn("key", L.surrogate_key(["SK_ID_BUREAU"]))
    query = rejects.writeStream.format("memory").queryName("stream_rejects").option(
        "checkpointLocation", str(tmp_path / "state")
    ).start()
    query.processAllAvailable()
    query.stop()
    found = spark.table("stream_rejects").collect()
    assert sorted(r[REASON] for r in found) == ["INVALID_SK_ID_BUREAU_TYPE", "NULL_STATUS"]
    assert all(len(r["key"]) == 32 for r in found)

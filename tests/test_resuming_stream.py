"""A pause that ends by a timer."""

import time
from datetime import datetime, timedelta, timezone

from docloom.streaming.state_stream import resuming_stream


def test_paused_keys_come_back_after_their_time(spark, tmp_path):
    soon, past = datetime.now(timezone.utc) + timedelta(seconds=14), datetime.now(timezone.utc) - timedelta(hours=1)
    schema = "chunk_id string, seq long, state string, reset_at timestamp"
    steps = ["CHUNK_READY", "SENT", "PAUSED_LIMIT"]
    rows = [(k, i, s, at if s == "PAUSED_LIMIT" else None) for k, at in (("stated", soon), ("past", past), ("none", None), ("ended", None)) for i, s in enumerate(steps)]
    rows += [("odd", 0, "PAUSED_LIMIT", soon), ("done", 0, "CHUNK_READY", None)]
    spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in" / "0"))
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    query = None
    try:
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in" / "*"))
        start = lambda: resuming_stream(stream, recheck_seconds=20).writeStream.foreachBatch(lambda b, i: b.write.mode("append").parquet(str(tmp_path / "out"))).outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).start()
        query = start()
        read = lambda: spark.read.parquet(str(tmp_path / "out")).collect() if list(tmp_path.glob("out/*.parquet")) else []
        until = time.time() + 120
        while time.time() < until and len(read()) < len(rows):
            time.sleep(1)
        query.stop()  # timers outlive the query
        spark.createDataFrame([("ended", 3, "CHUNK_READY", None), ("stated", 9, "COMPLETED", None)], schema).coalesce(1).write.json(str(tmp_path / "in" / "1"))
        query = start()
        while time.time() < until and sum(r["seq"] is None for r in read()) < 3:
            time.sleep(1)
        time.sleep(3)
        found = read()
    finally:
        if query:
            query.stop()
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    timed = [(r["chunk_id"], r["before"], r["state"], r["allowed"]) for r in found if r["seq"] is None]
    assert sorted(timed) == [(k, "PAUSED_LIMIT", "CHUNK_READY", True) for k in ("none", "past", "stated")]
    given = {(r["chunk_id"], r["seq"]): r for r in found if r["seq"] is not None}
    assert len(given) == len(rows) + 2 and not given["odd", 0]["allowed"] and given["ended", 3]["allowed"] and not given["stated", 9]["allowed"]
    assert given["stated", 2]["resume_at"].replace(tzinfo=timezone.utc).timestamp() - soon.timestamp() < 1 and given["past", 2]["resume_at"] > given["stated", 2]["resume_at"] - timedelta(seconds=14)
    assert given["stated", 0]["resume_at"] is None

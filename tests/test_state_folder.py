"""Snapshots, later logs and broken files."""

import random

from docloom.operators import states
from docloom.sources.state_folder import StateFolder

from test_states import folded, likely_log


def steps(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, seq long, state string, metadata map<string,string>").coalesce(1)


def loaded(folder):
    return {r["chunk_id"]: (r["state"], r["changes"], r["rejected"], r["metadata"]) for r in folder.load().states.collect()}


def test_an_absent_folder_begins_afresh(spark, tmp_path):
    found = StateFolder(spark, str(tmp_path / "none")).load()
    assert found.states.count() == 0 and found.aside == []


def test_snapshots_and_logs_give_what_the_whole_log_gives(spark, tmp_path):
    rows = [(k, i, s, {"at": str(i)}) for i, (k, _, s) in enumerate(likely_log(random.Random(7), ["a", "b", "c", "d"], 25)) if s is not None]
    folder, expected = StateFolder(spark, f"file://{tmp_path}/states"), {}
    for k, i, s, before, ok in folded([r[:3] for r in rows]):
        now = expected.setdefault(k, [None, 0, 0, {}, -1])
        now[1], now[2] = now[1] + ok, now[2] + (not ok)
        if ok and i > now[4]:
            now[0], now[3], now[4] = s, {"at": str(i)}, i
    for part in range(3):
        folder.append(steps(spark, [r for r in rows if r[1] % 100 // 34 == part]))
        if part < 2:
            assert folder.compact() == part + 1
    assert loaded(folder) == {k: tuple(v[:4]) for k, v in expected.items() if v[0]}
    assert loaded(folder) == loaded(folder)  # loading changes nothing


def test_a_truncated_log_file_is_set_aside_and_its_good_lines_stay(spark, tmp_path):
    folder = StateFolder(spark, str(tmp_path))
    folder.append(steps(spark, [("a", 1, "CHUNK_READY", None), ("a", 2, "SENT", None)]))
    (file,) = (tmp_path / "log").glob("*.json")
    (tmp_path / "log" / ".junk.crc").unlink(missing_ok=True)
    file.write_text(file.read_text()[:-12])  # breaks the last line
    for crc in (tmp_path / "log").glob(".*.crc"):
        crc.unlink()
    folder.append(steps(spark, [("b", 1, "CHUNK_READY", {"x": "1"})]))
    found = folder.load()
    assert [why for _, why in found.aside] == ["broken lines"] and len(list((tmp_path / "aside").glob("log-*.corrupt-*"))) == 1
    assert loaded(folder) == {"a": ("CHUNK_READY", 1, 0, {}), "b": ("CHUNK_READY", 1, 0, {"x": "1"})}
    assert folder.load().aside == []


def test_a_broken_snapshot_gives_way_to_the_one_before(spark, tmp_path):
    folder = StateFolder(spark, str(tmp_path))
    for i, s in enumerate(("CHUNK_READY", "SENT", "RESPONDED", "PARSED")):
        folder.append(steps(spark, [("a", i, s, {s: "x"})]))
        if i < 3:
            folder.compact()
    whole = loaded(folder)
    assert whole == {"a": ("PARSED", 4, 0, dict.fromkeys(("CHUNK_READY", "SENT", "RESPONDED", "PARSED"), "x"))}
    for file in (tmp_path / "snapshots" / "3").glob("*.parquet"):
        file.write_bytes(file.read_bytes()[:50])
    for crc in (tmp_path / "snapshots" / "3").glob(".*.crc"):
        crc.unlink()
    assert loaded(folder) == whole  # from snapshot 2 and the steps merged since
    assert [p.name for p in (tmp_path / "snapshots").iterdir()] == ["2"] and len(list((tmp_path / "aside").iterdir())) == 1
    (tmp_path / "snapshots" / "9").mkdir()  # a snapshot that was never finished
    assert loaded(folder) == whole and folder.compact() == 4 and loaded(folder) == whole


def test_steps_begin_where_a_snapshot_ends(spark):
    log = spark.createDataFrame([("a", 5, "RESPONDED"), ("a", 6, "PARSED"), ("b", 1, "SENT"), (None, 1, "SENT")], "chunk_id string, seq long, state string")
    since = spark.createDataFrame([("a", "SENT"), (None, "CHUNK_READY"), ("z", "SENT")], "chunk_id string, state string")
    from pyspark.sql import functions as F

    for bucket in (None, F.col("seq"), F.lit(None).cast("int")):
        got = {(r["chunk_id"], r["seq"], r["before"], r["allowed"]) for r in states.checked_log(log, bucket=bucket, since=since).collect()}
        assert got == {("a", 5, "SENT", True), ("a", 6, "RESPONDED", True), ("b", 1, None, False), (None, 1, "CHUNK_READY", True)}

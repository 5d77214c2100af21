"""The state fold against a plain loop: order, buckets, long histories, odd values."""

import random
import time

import pytest
from pyspark.sql import functions as F

from docloom.operators import states


def folded(rows):
    """(key, order, state) -> before, allowed, one step after another."""
    now, out = {}, []
    for key, order, state in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2] or "")):
        before = now.get(key)
        ok = states.is_allowed(before, state)
        out.append((key, order, state, before, ok))
        if ok:
            now[key] = state
    return sorted(out, key=repr)


def likely_log(r, keys, steps):
    """Logs in which about half of the steps are allowed, with unknown states, ties and nulls."""
    names = list(states.TRANSITIONS)
    rows = []
    for key in keys:
        state = "CHUNK_READY"
        for _ in range(steps):
            follow = states.TRANSITIONS[state] or ("CHUNK_READY",)
            state = r.choice(follow) if r.random() < 0.6 else r.choice(names)
            rows.append((key, r.randrange(steps) if r.random() > 0.02 else None, r.choice([state] * 30 + ["elsewhere", None])))
    return rows


def test_one_rule_for_columns_values_and_the_fold(spark):
    names = [None, *states.TRANSITIONS, "elsewhere"]
    pairs = [(a, b) for a in names for b in names]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.coalesce(states.may_follow(F.col("a"), F.col("b")), F.lit(False)).alias("ok")).collect()
    for r in got:
        if r["a"] != "elsewhere":  # no key ever is in an unknown state
            assert r["ok"] == states.is_allowed(r["a"], r["b"]) == (r["b"] in states.FOLLOWS and states.NAMES.index(r["a"]) in states.FOLLOWS[r["b"]])


@pytest.mark.parametrize("seed", range(3))
def test_random_logs_in_any_cut(spark, seed):
    r = random.Random(seed)
    rows = likely_log(r, ["a", "b", None, "c", ""], 300)
    log = spark.createDataFrame(rows, "chunk_id string, seq long, state string").withColumns({"before": F.lit("own"), "_key": F.lit(1), "_start": F.lit(2)}).drop("before").repartition(5)
    expected = folded(rows)
    assert any(x[4] for x in expected) and not all(x[4] for x in expected)
    for bucket in (None, F.expr("seq div 7"), F.col("seq"), F.lit(None).cast("int"), F.floor(F.col("seq") / 100.0)):
        got = states.checked_log(log, bucket=bucket)
        assert got.columns == [*log.columns, "before", "allowed"]
        assert sorted((tuple(x) for x in got.select("chunk_id", "seq", "state", "before", "allowed").collect()), key=repr) == expected


def test_keys_and_orders_of_other_kinds(spark):
    rows = [(1.5, (1, "x"), "CHUNK_READY", [1]), (1.5, (1, "y"), "SENT", None), (2.5, (0, "z"), "SENT", [])]
    log = spark.createDataFrame(rows, "k double, o struct<a:int,b:string>, state string, more array<int>")
    got = {(r["k"], r["o"]["b"], r["allowed"], tuple(r["more"] or ())) for r in states.checked_log(log, "k", "o", F.col("o.a")).collect()}
    assert got == {(1.5, "x", True, (1,)), (1.5, "y", True, ()), (2.5, "z", False, ())}


def test_a_key_of_many_steps_takes_linear_time(spark):
    def log(n):
        names = F.array(*[F.lit(s) for s in ("CHUNK_READY", "SENT", "RESPONDED", "FAILED", "elsewhere")])
        return spark.range(n).select(F.lit("hot").alias("chunk_id"), F.col("id").alias("seq"), F.get(names, (F.col("id") % 5).cast("int")).alias("state"))

    def seconds(n, bucket):
        began = time.time()
        # Of five steps the last is unknown; after FAILED the key is ready again.
        assert states.checked_log(log(n), bucket=bucket).agg(F.count_if("allowed")).first()[0] == n // 5 * 4
        return time.time() - began

    seconds(1000, None)
    for bucket in (None, F.expr("seq div 10000")):
        small, large = seconds(100_000, bucket), seconds(1_000_000, bucket)
        assert large < 60 and large < 15 * max(small, 1.0)

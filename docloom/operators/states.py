"""A log of state changes per key: current states, forbidden steps, what to resume, how far a run is."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

# Which state may follow which, and from which a run resumes.
TRANSITIONS = {
    "PREPARED": ("TEXT_EXTRACTED", "CHUNK_READY"),
    "TEXT_EXTRACTED": ("HINTS_GENERATED",),
    "HINTS_GENERATED": ("CHUNKS_CREATED",),
    "CHUNKS_CREATED": ("CHUNK_READY",),
    "CHUNK_READY": ("SENT", "SKIPPED"),
    "SENT": ("RESPONDED", "PAUSED_LIMIT", "FAILED", "CHUNK_READY"),
    "RESPONDED": ("PARSED", "FAILED"),
    "PARSED": ("VALIDATED", "FAILED"),
    "VALIDATED": ("COMPLETED", "FAILED"),
    "PAUSED_LIMIT": ("CHUNK_READY",),
    "FAILED": ("CHUNK_READY", "SKIPPED"),
    "COMPLETED": (),
    "SKIPPED": ("CHUNK_READY",),
}
RESUMABLE = ("CHUNK_READY", "SENT", "FAILED", "PAUSED_LIMIT")
RECHECK_MINUTES = 30


def may_follow(before: Column, after: Column) -> Column:
    """Whether the step is allowed: the same state again, a listed one, or, for a new key, CHUNK_READY."""
    out = F.lit(False)
    for state, next_states in TRANSITIONS.items():
        out = F.when(before == state, after.isin(*next_states) if next_states else F.lit(False)).otherwise(out)
    return F.when(before.isNull(), after == "CHUNK_READY").when(before == after, True).otherwise(out)


def is_allowed(before: str | None, after: str | None) -> bool:
    """may_follow() of plain values."""
    return after == "CHUNK_READY" if before is None else after in TRANSITIONS.get(before, ()) or (after == before and after in TRANSITIONS)


# The fold counts states by number; the last one is a key that isn't registered.
NAMES: list[str | None] = [*TRANSITIONS, None]
NEW = len(NAMES) - 1
#: For each step the numbers of the states that it may follow, and what it makes of every state's number.
FOLLOWS = {step: frozenset(i for i, before in enumerate(NAMES) if is_allowed(before, step)) for step in TRANSITIONS}
MAKES = {step: bytes(NAMES.index(step) if i in allowed else i for i in range(256)) for step, allowed in FOLLOWS.items()}
#: What a bucket without steps makes of each state: the same.
SAME = bytes(range(len(NAMES)))


def _runs(batches: Iterator[pa.RecordBatch], n_group: int) -> Iterator[tuple[pa.RecordBatch, list[tuple], list[bool]]]:
    """Batches of sorted rows with the group of each row (the first `n_group` columns), and whether it differs from the row's before."""
    last: tuple | None = None
    for batch in batches:
        groups = list(zip(*(c.to_pylist() for c in batch.columns[:n_group]), strict=True))
        fresh = [a != b for a, b in zip([last, *groups], groups, strict=False)]
        yield batch, groups, fresh
        last = groups[-1] if groups else last


def _bucket_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, bucket, map) of every run of (key, bucket, state) rows: what the bucket's steps make of each state."""
    group, made = None, SAME
    for batch, groups, fresh in _runs(batches, 2):
        done = []
        for now, new, step in zip(groups, fresh, batch.column(2).to_pylist(), strict=True):
            if new:
                if group is not None:
                    done.append((*group, made))
                group, made = now, SAME
            if step in MAKES:
                made = made.translate(MAKES[step])
        if done:
            yield _batch(batch, done)
    if group is not None:
        yield _batch(batch, [(*group, made)])


def _bucket_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, bucket, start) of sorted (key, bucket, map) rows: the number of the state in which the bucket begins."""
    state = NEW
    for batch, _, fresh in _runs(batches, 1):
        starts = []
        for new, made in zip(fresh, batch.column(2).to_pylist(), strict=True):
            starts.append(NEW if new else state)
            state = made[starts[-1]]
        out = pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(starts, pa.int32())], ["_key", "_bucket", "_start"])
        yield out.filter(batch.column(3))


def _batch(like: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*[pa.array(c, like.schema.field(i).type) for i, c in enumerate(columns[:2])], pa.array(columns[2], pa.binary())], ["_key", "_bucket", "_map"])


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, bucket, start, state, row): the state before each step and whether it is taken; a row with a start is no step."""
    state = NEW
    for batch, _, fresh in _runs(batches, 2):
        start, step = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        before, allowed = [], []
        for new, begins, after in zip(fresh, start, step, strict=True):
            if new:
                state = NEW
            if begins is not None:
                state = begins
                before.append(None)
                allowed.append(None)
                continue
            before.append(NAMES[state])
            taken = after in FOLLOWS and state in FOLLOWS[after]
            allowed.append(taken)
            if taken:
                state = MAKES[after][state]
        out = pa.RecordBatch.from_arrays([batch.column(4), pa.array(before, pa.string()), pa.array(allowed, pa.bool_())], ["_row", "before", "allowed"])
        yield out.filter(out.column(2).is_valid())


def _number(state: Column) -> Column:
    """The number of a known state, that of a new key for any other."""
    at = F.array_position(F.array(*[F.lit(s) for s in TRANSITIONS]), state)
    return F.when(at > 0, at - 1).otherwise(NEW).cast("int")


def bucket_starts(log: DataFrame, key: str, order: str, bucket: Column, since: DataFrame | None = None) -> DataFrame:
    """_key, _bucket, _start: the state (its number) in which every bucket of a key begins.

    A bucket's steps are folded into a map from each state to the one they lead to, bucket by bucket; a key's maps,
    one small row per bucket, then give the starts in order.
    """
    state = F.coalesce("state", F.lit(""))
    keyed = log.select(F.col(key).alias("_key"), bucket.alias("_bucket"), state.alias("_state"), F.col(order).alias("_order"))
    kinds = dict(keyed.dtypes)
    group = f"_key {kinds['_key']}, _bucket {kinds['_bucket']}"
    sorted_steps = keyed.repartition("_key", "_bucket").sortWithinPartitions("_key", "_bucket", "_order", "_state").drop("_order")
    maps = sorted_steps.mapInArrow(_bucket_maps, f"{group}, _map binary").withColumn("_steps", F.lit(True))
    if since is not None:  # what a key was before leads every state to the same one
        constant = F.unhex(F.repeat(F.lpad(F.hex(_number(F.col("state")).cast("long")), 2, "0"), len(NAMES)))
        maps = maps.unionByName(since.select(F.col(key).alias("_key"), F.lit(None).cast(kinds["_bucket"]).alias("_bucket"), constant.alias("_map"), F.lit(False).alias("_steps")))
    return maps.repartition("_key").sortWithinPartitions("_key", "_steps", "_bucket").mapInArrow(_bucket_starts, f"{group}, _start int")


def checked_log(log: DataFrame, key: str = "chunk_id", order: str = "seq", bucket: Column | None = None, since: DataFrame | None = None) -> DataFrame:
    """The log (key, order, state, ...) with before and allowed; a step that isn't allowed leaves the state as it was.

    A key's steps are read once, in order, by a task that holds its present state and one batch: time is linear in the steps, and
    memory doesn't grow with them. `bucket` (never falling as `order` rises) cuts a hot key's history: bucket_starts() says where each
    bucket begins, and the buckets are then read side by side. Without one a key is read by one task. `since` (key, state; a row per key)
    has the states in which keys begin, as a snapshot gives them. Steps of equal order are taken by state; nulls come first.
    """
    cut = bucket is not None
    rows = log.select(
        F.col(key).alias("_key"), (bucket if cut else F.lit(0)).alias("_bucket"), F.lit(None).cast("int").alias("_start"), F.coalesce("state", F.lit("")).alias("_state"),
        F.struct("*").alias("_row"), F.col(order).alias("_order"),
    )
    if cut:
        rows = rows.unionByName(bucket_starts(log, key, order, bucket, since), allowMissingColumns=True)
    elif since is not None:
        begun = since.select(F.col(key).alias("_key"), F.lit(0).alias("_bucket"), _number(F.col("state")).alias("_start"))
        rows = rows.unionByName(begun, allowMissingColumns=True)
    # A bucket's start comes before its steps.
    sorted_rows = rows.repartition("_key", "_bucket").sortWithinPartitions("_key", "_bucket", F.col("_start").isNull(), "_order", "_state").drop("_order")
    schema = StructType([StructField("_row", rows.schema["_row"].dataType), StructField("before", StringType()), StructField("allowed", BooleanType())])
    return sorted_rows.mapInArrow(_checked, schema).select("_row.*", "before", "allowed")


def current_states(log: DataFrame, key: str = "chunk_id", order: str = "seq", bucket: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """key, state, changes (steps taken), rejected, order, and of each `keep` column the last value given by a step that was taken.

    Keys of which no step was taken aren't registered and don't appear.
    """
    checked = checked_log(log, key, order, bucket)
    taken = lambda c: F.when(F.col("allowed"), F.col(c))
    last = [F.max_by(c, F.when(F.col("allowed") & F.col(c).isNotNull(), F.col(order))).alias(c) for c in keep]
    rows = checked.groupBy(key).agg(
        F.max_by("state", taken(order)).alias("state"), F.count_if("allowed").alias("changes"), F.count_if(~F.col("allowed")).alias("rejected"), F.max(taken(order)).alias(order), *last
    )
    return rows.filter("changes > 0")


def merged_metadata(log: DataFrame, key: str = "chunk_id", order: str = "seq", bucket: Column | None = None, column: str = "metadata") -> DataFrame:
    """key, metadata map: of each name the last value among the steps that were taken."""
    each = checked_log(log, key, order, bucket).filter("allowed").select(key, order, F.explode(column).alias("name", "value"))
    last = each.groupBy(key, "name").agg(F.max_by("value", order).alias("value"))
    return last.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias(column))


def history(log: DataFrame, key: str = "chunk_id", order: str = "seq", bucket: Column | None = None) -> DataFrame:
    """The steps that were taken, a row each, as the log gives them."""
    return checked_log(log, key, order, bucket).filter("allowed").drop("before", "allowed")


def state_of(states: DataFrame, name: object, key: str = "chunk_id") -> DataFrame:
    """One key's row, none if it isn't registered; the filter reaches the scan."""
    return states.filter(F.col(key) == F.lit(name))


def register(states: DataFrame, keys: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The keys that aren't in `states` yet, as CHUNK_READY."""
    return keys.select(key).distinct().join(states, key, "left_anti").withColumn("state", F.lit("CHUNK_READY"))


def resumable(states: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Keys to take up again; SENT and FAILED start over."""
    reset = F.when(F.col("state").isin("SENT", "FAILED"), "CHUNK_READY").otherwise(F.col("state"))
    return states.filter(F.col("state").isin(*RESUMABLE)).select(key, reset.alias("state"))


def resume_at(reset_at: Column, now: Column) -> Column:
    """The stated end of a limit if it lies ahead, else half an hour from now."""
    return F.when(reset_at > now, reset_at).otherwise(now + F.expr(f"INTERVAL {RECHECK_MINUTES} MINUTES"))


def wait_seconds(paused: DataFrame, now: Column, until: str = "resume_at") -> DataFrame:
    """One row: seconds until the last pause ends, 0 if past, 1800 if there is none."""
    left = F.max(F.unix_micros(until)) / 1e6 - F.unix_micros(now) / 1e6
    return paused.agg(F.when(left.isNull(), 60.0 * RECHECK_MINUTES).otherwise(F.greatest(F.lit(0.0), left)).alias("wait_seconds"))


def progress(states: DataFrame, duration: str | None = None) -> DataFrame:
    """One row: keys, those of each group of states, what remains, the share done in percent, and the seconds left.

    `duration` names a column of seconds; the mean of completed keys' (zeros aside) times what remains is eta_seconds,
    null where there is none. Percent and seconds have one decimal.
    """
    n = F.count("*")
    done, skipped = F.count_if(F.col("state") == "COMPLETED"), F.count_if(F.col("state") == "SKIPPED")
    failed, paused = F.count_if(F.col("state") == "FAILED"), F.count_if(F.col("state") == "PAUSED_LIMIT")
    share = F.coalesce(F.round(100.0 * (done + skipped) / F.nullif(n, F.lit(0)), 1), F.lit(0.0))
    mean = F.avg(F.when((F.col("state") == "COMPLETED") & (F.col(duration) != 0), F.col(duration))) if duration else F.lit(None).cast("double")
    left = n - done - skipped
    return states.agg(
        n.alias("total"), done.alias("completed"), skipped.alias("skipped"), failed.alias("failed"), paused.alias("paused"), left.alias("remaining"), share.alias("percent"),
        F.round(mean * left, 1).alias("eta_seconds"),
    )


def state_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("state").agg(F.count("*").alias("n"))

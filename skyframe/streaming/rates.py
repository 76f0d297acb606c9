"""Progress rates over repeated counter snapshots, as a stream and as a batch table.

A snapshot row says how far one task has read: scope, task_id, run_id, status, read_bytes, started_at
(seconds, of the task's attempt) and snapshot_at (seconds). Rates never add up per-task rates; they
divide the sum of counter steps by the shared elapsed time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pandas.api.types import union_categoricals
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skyframe.operators.sequences import with_neighbours, with_previous
from skyframe.session import STATE_STORE

SNAPSHOT = "scope string, task_id string, run_id string, status string, read_bytes bigint, started_at double, snapshot_at double"
WATCH = "task_id string, run_id string, status string, snapshot_at double, elapsed_seconds double, average_mbps double"
STEP = ("scope string, run_id string, snapshot_at double, prev_at double, bytes bigint, change bigint, started_at double")

# States that end a watch window, silent states, intervals kept for the recent rate, stale limit.
ENDED = ("complete", "interrupted", "paused", "failed")
SILENT = ("queued", "deferred", "unavailable")
KEPT_INTERVALS = 60
STALE_SECONDS = 120
DAY_MS = 86_400_000


OUT_ROWS = 100_000
BUCKETS = 1024  # groups that the tasks of a stream are dealt into; a checkpoint holds for this number only
ARROW = {"str": pa.string(), "f8": pa.float64(), "i8": pa.int64(), "bool": pa.bool_()}


def _in_order(chunks, texts: list[str]) -> pd.DataFrame:
    """A bucket's snapshots of one batch in time order, texts as codes of the few values they take (some 40 bytes a row).
    A snapshot without a time or a counter says nothing."""
    columns = {c: [] for c in [*texts, "read_bytes", "snapshot_at", "started_at"]}
    for chunk in chunks:
        chunk = chunk[chunk["snapshot_at"].notna() & chunk["read_bytes"].notna() & ~chunk["status"].isin(SILENT)]
        for name, held in columns.items():
            held.append(pd.Categorical(chunk[name]) if name in texts else chunk[name].astype("int64" if name == "read_bytes" else "float64").to_numpy())
    joined = {c: union_categoricals(held) if c in texts else np.concatenate(held) for c, held in columns.items()}
    return pd.DataFrame(joined).sort_values("snapshot_at", kind="stable", ignore_index=True)


def _place(columns: list[pd.Categorical]) -> np.ndarray:
    """One number for every combination of the columns' values; a null is a value."""
    number = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        number = number * (len(column.categories) + 1) + column.codes + 1
        number = np.unique(number, return_inverse=True)[1]
    return number


def _joined(keys: list[str], before: pd.DataFrame, rows: pd.DataFrame) -> tuple[dict[str, pd.Categorical], np.ndarray, np.ndarray]:
    """The text columns of the state's rows and then the batch's, their order by key (a key's state, then its snapshots in
    time), and in that order where a key begins."""
    names = [*keys, *[c for c in ("run_id",) if c not in keys]]
    parts = {c: [pd.Categorical(before[c]), pd.Categorical(rows[c])] for c in names}
    both = {c: union_categoricals([pd.Categorical.from_codes(p.codes, p.categories.astype(object)) for p in parts[c]]) for c in names}
    place = _place([both[k] for k in keys])
    order = np.argsort(place, kind="stable")
    place = place[order]
    return both, order, np.r_[True, place[1:] != place[:-1]][:len(place)]


def watch_tasks(rows: pd.DataFrame, before: pd.DataFrame, now_ms: int = 0) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Elapsed time and rate of every snapshot of many tasks, each task's in order, and all windows' states after the last.

    State, a row a task: task, run, first time, first counter, last counter, last time, ended, and when its task last came.
    Before there is a window,
    completions say nothing. While a window is ended its last counter stands still, and a smaller one than the least since
    then opens a new window.
    """
    texts, order, begins = _joined(["task_id"], before, rows)
    carried = order < len(before)  # a window so far goes ahead of its task's snapshots as one row
    told = carried | (rows["status"] != "complete").to_numpy(dtype=bool)[np.maximum(order - len(before), 0)] if len(rows) else carried
    ahead = np.cumsum(told)
    known = ahead > np.maximum.accumulate(np.where(begins, ahead - told, 0))
    order, carried = order[known], carried[known]
    task, run = texts["task_id"].codes[order], texts["run_id"].codes[order]
    at, count, ended = (np.concatenate([before[old], now])[order] for old, now in (
        ("last_seen", rows["snapshot_at"]), ("last_bytes", rows["read_bytes"]), ("stopped", rows["status"].isin(ENDED))))
    ended = ended.astype(bool)
    same = (task[1:] == task[:-1]) & (run[1:] == run[:-1])
    both = ended[1:] & ended[:-1]
    stretch = np.cumsum(np.r_[True, ~(same & both)][:len(run)])
    least = pd.Series(count).groupby(stretch).cummin().to_numpy()
    fresh = np.r_[True, ~same | (count[1:] < least[:-1]) | (ended[:-1] & ~ended[1:])][:len(run)]
    place = np.arange(len(run))
    frozen = np.r_[False, both][:len(run)] & ~fresh
    begin, now = np.maximum.accumulate(np.where(fresh, place, 0)), np.maximum.accumulate(np.where(frozen, 0, place))
    first_at, first_count = at.copy(), count.copy()
    first_at[carried], first_count[carried] = before["first_seen"].to_numpy()[order[carried]], before["base_bytes"].to_numpy()[order[carried]]
    elapsed = np.maximum(0.0, at[now] - first_at[begin])
    rate = np.full(len(run), np.nan)
    np.divide((count[now] - first_count[begin]) * 8, elapsed, out=rate, where=elapsed > 0)
    out = rows.iloc[order[~carried] - len(before)].assign(elapsed_seconds=elapsed[~carried], average_mbps=rate[~carried] / 1e6)
    ends = np.flatnonzero(np.r_[task[1:] != task[:-1], True][:len(task)])
    after = pd.DataFrame({
        "task_id": texts["task_id"][order[ends]].astype(object), "run_id": texts["run_id"][order[ends]].astype(object), "first_seen": first_at[begin[ends]],
        "base_bytes": first_count[begin[ends]], "last_bytes": count[now[ends]], "last_seen": at[now[ends]], "stopped": ended[ends],
        "seen_ms": _seen(before, order[ends], now_ms)})
    return out, after


def _seen(before: pd.DataFrame, last: np.ndarray, now_ms: int) -> np.ndarray:
    """When the tasks last came, by the places of their last rows: those that end with the state's row keep its time."""
    return np.r_[before["seen_ms"].to_numpy(), now_ms][np.minimum(last, len(before))]


def watch_windows(rows: pd.DataFrame, state: tuple | None) -> tuple[pd.DataFrame, tuple | None]:
    """``watch_tasks`` of one task, its state a tuple without the task."""
    before = _state(WINDOWS, [] if state is None else [(None, *state, 0)])
    out, after = watch_tasks(rows.assign(task_id=pd.Categorical([None] * len(rows))), before)
    if after.empty:
        return out, None
    name, *numbers = after.drop(columns=["task_id", "seen_ms"]).iloc[0].tolist()
    return out, (None if pd.isna(name) else name, *numbers)


def task_changes(rows: pd.DataFrame, before: pd.DataFrame, now_ms: int = 0) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The steps between the snapshots of many tasks, each task's in order, and the last snapshot of all; a repeated or stale
    one adds nothing."""
    texts, order, begins = _joined(TASK, before, rows)
    carried = order < len(before)
    at, count = (np.concatenate([before[c], rows[c]])[order] for c in ("snapshot_at", "read_bytes"))
    place = np.cumsum(begins)
    newest = np.where(begins & carried, at, -np.inf)[begins][place - 1] if len(at) else at
    kept = carried | ((begins | (at > np.r_[-np.inf, at][:-1])) & (at > newest))
    order, carried, at, count, place = order[kept], carried[kept], at[kept], count[kept], place[kept]
    first = np.r_[True, place[1:] != place[:-1]][:len(place)]
    prev_at = np.where(first, np.nan, np.r_[np.nan, at][:-1])[~carried]
    change = pd.array(count - np.r_[count[:1], count][:len(count)], "Int64")
    change[first] = pd.NA
    out = rows.iloc[order[~carried] - len(before)].rename(columns={"read_bytes": "bytes"}).assign(prev_at=prev_at, change=change[~carried])
    ends = np.flatnonzero(np.r_[first[1:], True][:len(first)])
    last = {k: texts[k][order[ends]].astype(object) for k in TASK}
    return out, pd.DataFrame({**last, "snapshot_at": at[ends], "read_bytes": count[ends], "seen_ms": _seen(before, order[ends], now_ms)})


def counter_changes(rows: pd.DataFrame, before: tuple | None) -> pd.DataFrame:
    """``task_changes`` of one task."""
    known = _state(NEWEST, [(None, None, None, *before, 0)] if before else [])
    return task_changes(rows.assign(**{k: pd.Categorical([None] * len(rows)) for k in TASK}), known)[0]


TASK = ["scope", "run_id", "task_id"]
WINDOWS = {"task_id": "str", "run_id": "str", "first_seen": "f8", "base_bytes": "i8", "last_bytes": "i8", "last_seen": "f8", "stopped": "bool", "seen_ms": "i8"}
NEWEST = {**{k: "str" for k in TASK}, "snapshot_at": "f8", "read_bytes": "i8", "seen_ms": "i8"}


def _state(kinds: dict[str, str], rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=list(kinds)).astype({c: object if k == "str" else k for c, k in kinds.items()})


class _TaskStates(StatefulProcessor):
    """Tasks dealt into ``BUCKETS`` by hash: one call, one reading and one writing of state serve all tasks of a bucket. The
    state is a row a task, a bucket's rows one Arrow table. A task that was silent for ``expire_days`` has none."""

    kinds: dict[str, str]
    texts: list[str]

    def __init__(self, expire_days: int | None = None):
        self.expire_ms = expire_days * DAY_MS if expire_days else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("tasks", "rows binary", self.expire_ms)

    def advance(self, batch: pd.DataFrame, before: pd.DataFrame, now_ms: int) -> tuple[pd.DataFrame, pd.DataFrame]:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch, now = _in_order(rows, self.texts), timerValues.getCurrentProcessingTimeInMs() if self.expire_ms else 0
        if batch.empty:
            return
        before = pa.ipc.open_stream(self.held.get()[0]).read_all().to_pandas() if self.held.exists() else _state(self.kinds, [])
        if self.expire_ms:
            before = before[before["seen_ms"] > now - self.expire_ms].reset_index(drop=True)
        out, after = self.advance(batch, before, now)
        table = pa.Table.from_pandas(after, pa.schema([(c, ARROW[k]) for c, k in self.kinds.items()]), preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        self.held.update((sink.getvalue().to_pybytes(),))
        for start in range(0, len(out), OUT_ROWS):
            yield out.iloc[start:start + OUT_ROWS].astype({c: object for c in self.texts})[self.columns]

    def close(self) -> None:
        pass


class WatchProcessor(_TaskStates):
    """One watch window per task. A new run, a smaller counter or a resumed task starts a new window;
    an ended task is frozen; a queued one shows nothing."""

    kinds, texts = WINDOWS, ["task_id", "run_id", "status"]
    columns = ["task_id", "run_id", "status", "snapshot_at", "elapsed_seconds", "average_mbps"]

    def advance(self, batch, before, now_ms):
        return watch_tasks(batch, before, now_ms)


class StepProcessor(_TaskStates):
    """T02, first stage: the step of every task's counter since its own previous snapshot in the run."""

    kinds, texts = NEWEST, TASK
    columns = ["scope", "run_id", "snapshot_at", "prev_at", "bytes", "change", "started_at"]

    def advance(self, batch, before, now_ms):
        return task_changes(batch, before, now_ms)


def watch_rates(snapshots: DataFrame, expire_days: int | None = None) -> DataFrame:
    """T01 over a stream of snapshots: elapsed time and average rate of every task's watch window.

    A monitor that never stops should let the state of silent tasks expire; a run that drains a folder
    cannot (expiry keeps a stream ticking for ever).
    """
    return _stateful(snapshots, ["task_id"], WatchProcessor(expire_days), WATCH, "Update", expire_days)


def counter_steps(snapshots: DataFrame, expire_days: int | None = None) -> DataFrame:
    """T02 over a stream, first stage: keyed by task, so a scope with many tasks spreads over the cluster."""
    usable = snapshots.filter(~F.col("status").isin(*SILENT) & F.col("read_bytes").isNotNull())
    return _stateful(usable, TASK, StepProcessor(expire_days), STEP, "Append", expire_days)


def _stateful(snapshots, keys, processor, schema, mode, expire_days):
    grouped = snapshots.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))).groupBy("bucket")
    snapshots.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return grouped.transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode=mode, timeMode="ProcessingTime" if expire_days else "None")


def watch_rates_batch(snapshots: DataFrame) -> DataFrame:
    """T01 over a finished table whose tasks end with their last snapshot. As in the stream, completions before anything
    else was seen of a task say nothing."""
    rows = snapshots.filter(~F.col("status").isin(*SILENT) & F.col("read_bytes").isNotNull())
    seen = rows.filter("status <> 'complete'").groupBy("task_id").agg(F.min("snapshot_at").alias("_seen"))
    rows = rows.join(seen, "task_id").filter((F.col("snapshot_at") > F.col("_seen")) | ((F.col("snapshot_at") == F.col("_seen")) & (F.col("status") != "complete")))
    rows = with_previous(rows.drop("_seen"), ["task_id"], ["snapshot_at"], ["run_id", "read_bytes", "status"])
    fresh = (F.col("prev_run_id").isNull() | (F.col("prev_run_id") != F.col("run_id")) | (F.col("read_bytes") < F.col("prev_read_bytes"))
             | F.col("prev_status").isin(*ENDED))
    rows = rows.withColumn("_opens", F.when(fresh, F.struct(F.col("snapshot_at").alias("at"), F.col("read_bytes").alias("base"))))
    rows = with_neighbours(rows, ["task_id"], ["snapshot_at"], "_opens", last="_start")
    elapsed = F.col("snapshot_at") - F.col("_start.at")
    rate = F.when(elapsed > 0, (F.col("read_bytes") - F.col("_start.base")) * 8 / elapsed / 1e6)
    return rows.select("task_id", "run_id", "status", "snapshot_at", elapsed.alias("elapsed_seconds"), rate.alias("average_mbps"))


def counter_steps_batch(snapshots: DataFrame) -> DataFrame:
    """T02, first stage, over a finished table."""
    usable = snapshots.filter(~F.col("status").isin(*SILENT) & F.col("read_bytes").isNotNull())
    rows = with_previous(usable, ["scope", "run_id", "task_id"], ["snapshot_at"], ["snapshot_at", "read_bytes"])
    return rows.select("scope", "run_id", "snapshot_at", F.col("prev_snapshot_at").alias("prev_at"), F.col("read_bytes").alias("bytes"),
                       (F.col("read_bytes") - F.col("prev_read_bytes")).alias("change"), "started_at")


def interval_parts(steps: DataFrame) -> DataFrame:
    """T02, second stage: steps summed per snapshot and previous snapshot of their tasks (mergeable)."""
    return steps.groupBy("scope", "run_id", "snapshot_at", "prev_at").agg(
        F.count(F.lit(1)).alias("tasks"), F.sum(F.greatest("change", F.lit(0))).alias("step_bytes"), F.sum("bytes").alias("all_bytes"),
        F.min("change").alias("worst_change"), F.min(F.coalesce("started_at", F.lit(float("-inf")))).alias("first_start"))


def recent_bandwidth(parts: DataFrame) -> DataFrame:
    """T02, last stage: per scope and run the mean and median rate of the last sixty fresh intervals.

    An interval counts the steps of tasks seen at both of its ends and the whole counter of tasks that
    began inside it. A vanished task, a smaller counter or an unknown first counter clears the history.
    Snapshots, not tasks, bound the windows here.
    """
    keys = ["scope", "run_id"]
    stamps = parts.groupBy(*keys, "snapshot_at").agg(F.sum("tasks").alias("_tasks"))
    line = Window.partitionBy(*keys).orderBy("snapshot_at")
    stamps = stamps.select(*keys, "snapshot_at", F.lag("snapshot_at").over(line).alias("_before_at"), F.lag("_tasks").over(line).alias("_before_tasks"))
    merged = parts.groupBy(*keys, "snapshot_at", "prev_at").agg(
        F.sum("tasks").alias("tasks"), F.sum("step_bytes").alias("step_bytes"), F.sum("all_bytes").alias("all_bytes"),
        F.min("worst_change").alias("worst_change"), F.min("first_start").alias("first_start"))
    rows = merged.join(stamps, [*keys, "snapshot_at"]).filter("_before_at is not null")
    going = F.coalesce(F.col("prev_at") == F.col("_before_at"), F.lit(False))
    per = rows.groupBy(*keys, "snapshot_at", "_before_at", "_before_tasks").agg(
        F.coalesce(F.sum(F.when(going, F.col("tasks"))), F.lit(0)).alias("_kept"),
        F.sum(F.when(going, F.col("step_bytes")).otherwise(F.col("all_bytes"))).alias("_bytes"),
        F.bool_or(going & (F.col("worst_change") < 0)).alias("_shrunk"),
        F.bool_or(~going & (F.col("first_start") < F.col("_before_at"))).alias("_unknown"))
    per = per.withColumn("_reset", (F.col("_kept") < F.col("_before_tasks")) | F.col("_shrunk") | F.col("_unknown"))
    back = Window.partitionBy(*keys).orderBy(F.col("snapshot_at").desc())
    per = per.withColumn("_resets_after", F.sum(F.col("_reset").cast("int")).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    live = per.filter("_resets_after = 0").withColumn("_n", F.row_number().over(back)).filter(F.col("_n") <= KEPT_INTERVALS)
    seconds = F.col("snapshot_at") - F.col("_before_at")
    found = live.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("intervals"), F.sum(seconds).alias("window_seconds"),
        (F.sum("_bytes") * 8 / F.sum(seconds) / 1e6).alias("recent_average_mbps"),
        F.median(F.col("_bytes") * 8 / seconds / 1e6).alias("recent_median_mbps"))
    spine = stamps.select(*keys).distinct()
    return spine.join(found, keys, "left").withColumns(
        {"intervals": F.coalesce("intervals", F.lit(0)), "window_seconds": F.coalesce("window_seconds", F.lit(0.0))})


def run_average(snapshots: DataFrame, runs: DataFrame) -> DataFrame:
    """Average of a whole run: newest counters of its tasks over the time since it started.

    runs: run_id, run_started_at, run_until.
    """
    newest = snapshots.groupBy("run_id", "task_id").agg(F.max_by("read_bytes", "snapshot_at").alias("_bytes"))
    sums = newest.groupBy("run_id").agg(F.sum("_bytes").alias("_bytes"), F.bool_and(F.col("_bytes").isNotNull()).alias("_whole"))
    rows = runs.join(sums, "run_id", "left")
    elapsed = F.col("run_until") - F.col("run_started_at")
    return rows.select("run_id", F.when(F.col("_whole") & (elapsed > 0), F.col("_bytes") * 8 / elapsed / 1e6).alias("run_average_mbps"))


def display_status(tasks: DataFrame, runs: DataFrame) -> DataFrame:
    """What a monitor shows for a task, from its own state and its run's.

    tasks: task_id, run_id, status, source, product, month, selected, checkpointed, attempt_started_at;
    runs: run_id, run_status, run_started_at, process_alive.
    """
    rows = tasks.join(runs, "run_id", "left")
    busy = tasks.join(runs.filter("run_status = 'running'").select("run_id"), "run_id", "left_semi").select(
        "source", "product", "month").distinct().withColumn("_busy", F.lit(1))
    rows = rows.join(busy, ["source", "product", "month"], "left")
    complete, halted = F.col("status") == "complete", F.col("run_status").isin("interrupted", "paused", "failed")
    alive = F.coalesce("process_alive", F.coalesce(F.col("run_status") == "running", F.lit(False)))
    state = (F.when(~complete & ~F.col("status").isin(*SILENT) & halted, F.col("run_status"))
             .when(F.col("status") == "checkpointed", F.when(alive, "fetching").otherwise("checkpointed")).otherwise(F.col("status")))
    old = ~complete & (F.col("run_status") == "running") & (F.col("attempt_started_at") < F.col("run_started_at"))
    waits = ~complete & halted & F.col("_busy").isNotNull()
    shown = F.when(F.coalesce(old | waits, F.lit(False)), "waiting").otherwise(state)
    done = (F.col("selected") > 0) & (F.col("checkpointed") >= F.col("selected"))
    rows = rows.withColumn("_shown", shown)
    final = F.when(F.col("_shown").isin("checkpointed", "fetching") & done, "unpublished").otherwise(F.col("_shown"))
    return rows.select(*tasks.columns, final.alias("display_status"))


def stale_runs(heartbeats: DataFrame, now: float) -> DataFrame:
    """Running runs whose newest heartbeat is older than two minutes are shown as unknown."""
    newest = heartbeats.groupBy("run_id").agg(F.max_by("status", "heartbeat").alias("status"), F.max("heartbeat").alias("heartbeat"))
    old = (F.col("status") == "running") & (F.lit(now) - F.col("heartbeat") > STALE_SECONDS)
    return newest.withColumn("shown_status", F.when(old, "unknown").otherwise(F.col("status")))

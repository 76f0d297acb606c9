"""Versioned tables: snapshot merges, upserts, rebuilds, month merges and task bookkeeping.

Plain files have no in-place update, so every operation returns the whole new version of a table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.functions.checks import guard
from skyframe.functions.identity import hash_number, id_set_digest
from skyframe.operators.alignment import first_of

# Task states that count as active, and so end as interrupted in a closed snapshot.
ACTIVE = ("running", "fetching", "queued", "checkpointed", "finalizing")


def stack(snapshots: list[DataFrame]) -> DataFrame:
    """Snapshots of one table in input order."""
    tagged = [df.withColumn("src_ord", F.lit(i)) for i, df in enumerate(snapshots)]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def _row_of(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in df.columns if c != "src_ord"])


def _without_conflict(rows: DataFrame, keys: list[str], tests: list[Column], message: str) -> DataFrame:
    """Fail when any test column takes two different known values for one key."""
    checks = rows.groupBy(*keys).agg(*[F.count_distinct(t).alias(f"_c{i}") for i, t in enumerate(tests)])
    clean = reduce(lambda a, b: a & b, [F.col(f"_c{i}") <= 1 for i in range(len(tests))])
    return rows.join(guard(checks, clean, message).select(*keys), keys, "left_semi")


def merge_archives(snapshots: list[DataFrame], key: str = "path") -> DataFrame:
    """U01 archives and receipts: differing known checksum or size fails; otherwise the last input wins."""
    rows = stack(snapshots)
    rows = _without_conflict(rows, [key], [F.col("sha256"), F.col("stored_bytes")], "Conflicting archive evidence")
    return first_of(rows, [key], [F.col("src_ord").desc()]).drop("src_ord", "_rank")


def merge_benchmarks(snapshots: list[DataFrame], key: str = "case_id") -> DataFrame:
    """U01 benchmark cases: any difference fails."""
    rows = stack(snapshots)
    rows = _without_conflict(rows, [key], [_row_of(rows)], "Conflicting benchmark case")
    return first_of(rows, [key], [F.col("src_ord")]).drop("src_ord", "_rank")


def merge_tasks(snapshots: list[DataFrame], key: str = "task_id") -> DataFrame:
    """U01 tasks: latest update, the earlier input on a tie."""
    return first_of(stack(snapshots), [key], [F.coalesce("updated_at", F.lit(0)).desc(), F.col("src_ord")]).drop("src_ord", "_rank")


def merge_jobs(snapshots: list[DataFrame], key: str = "run_id") -> DataFrame:
    """U01 jobs: latest heartbeat, then one that is not running, the earlier input on a tie."""
    order = [F.coalesce("heartbeat", F.lit(0)).desc(), (F.col("status") == "running").asc(), F.col("src_ord")]
    return first_of(stack(snapshots), [key], order).drop("src_ord", "_rank")


def merge_selections(snapshots: list[DataFrame], catalogs: DataFrame, key: str = "selection_id") -> DataFrame:
    """U01 selections: one whose catalog exists, then the latest indexed."""
    rows = stack(snapshots).join(catalogs.select(F.col("path").alias("catalog_path"), F.lit(1).alias("_there")), "catalog_path", "left")
    order = [F.coalesce("_there", F.lit(0)).desc(), F.coalesce(F.col("indexed_at").cast("string"), F.lit("")).desc(), F.col("src_ord")]
    return first_of(rows, [key], order).drop("src_ord", "_rank", "_there")


def merge_fetch_runs(snapshots: list[DataFrame], key: str = "run_id") -> DataFrame:
    """U01 fetch runs: a complete one, then the longer; two different complete ones fail."""
    rows = stack(snapshots).filter(F.col(key).isNotNull())
    done = F.when(F.col("status") == "complete", _row_of(rows))
    order = [(F.col("status") == "complete").desc(), F.coalesce("wall_seconds", F.lit(0.0)).desc(), F.col("src_ord")]
    # One shuffle and one sort: complete runs come first, and each must equal the one before it.
    line = Window.partitionBy(key).orderBy(*order)
    before = F.lag(done).over(line)
    ranked = rows.withColumns({"_rank": F.row_number().over(line), "_same": done.isNull() | before.isNull() | (before == done)})
    return guard(ranked, F.col("_same"), "Conflicting completed fetch run").filter("_rank = 1").drop("src_ord", "_rank", "_same")


def correct_tasks(tasks: DataFrame, archives: DataFrame, now_seconds: float) -> DataFrame:
    """U02 tasks: a verified archive completes its task (inserting a missing one); a completion without an
    archive becomes unknown; other active states become interrupted."""
    facts = archives.select(F.col("path").alias("task_id"), F.col("observations").alias("_n"), F.col("source").alias("_source"),
                            F.col("product").alias("_product"), F.col("month").alias("_month"), F.col("band").alias("_band"))
    rows = tasks.withColumn("_task", F.lit(1)).join(facts, "task_id", "full_outer")
    proven, new = F.col("_n").isNotNull(), F.col("_task").isNull()
    state = (F.when(proven, "complete").when(F.col("status") == "complete", "unknown")
             .when(F.col("status").isin(*ACTIVE), "interrupted").otherwise(F.col("status")))
    picked = {
        "task_id": F.col("task_id"), "run_id": F.when(new, "manifest-merge").otherwise(F.col("run_id")),
        "source": F.when(new, F.col("_source")).otherwise(F.col("source")),
        "product": F.when(new, F.col("_product")).otherwise(F.col("product")),
        "month": F.when(new, F.col("_month")).otherwise(F.col("month")), "band": F.when(new, F.col("_band")).otherwise(F.col("band")),
        "selected": F.when(proven, F.greatest(F.coalesce("selected", F.lit(0)), F.col("_n"))).otherwise(F.col("selected")),
        "checkpointed": F.when(proven, F.col("_n")).otherwise(F.col("checkpointed")),
        "completed": F.when(proven, F.col("_n")).otherwise(F.col("completed")), "status": state,
        "updated_at": F.when(new, F.lit(now_seconds)).otherwise(F.col("updated_at")),
    }
    return rows.select(*[c.alias(n) for n, c in picked.items()])


def correct_jobs(jobs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """U02 jobs: a running job takes its reported outcome, else it was interrupted."""
    rows = jobs.join(outcomes.select("run_id", F.col("outcome").alias("_o")), "run_id", "left")
    state = F.when(F.col("status") == "running", F.coalesce("_o", F.lit("interrupted"))).otherwise(F.col("status"))
    return rows.withColumn("status", state).drop("_o")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], newest: list[Column] | None = None) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key."""
    rows = stack([old, new])
    return first_of(rows, keys, [F.col("src_ord").desc(), *(newest or [])]).drop("src_ord", "_rank")


def rebuild_index(manifests: DataFrame, tasks: DataFrame, now_seconds: float) -> tuple[DataFrame, DataFrame]:
    """The archive table from manifests alone, and the tasks with one added per archive without any."""
    archives = first_of(manifests, ["path"], [F.col("archive_sha256")]).select(
        "path", "source", "product", "month", "band", "observations", "stored_bytes", F.col("archive_sha256").alias("sha256"))
    missing = archives.join(tasks.select(F.col("task_id").alias("path")), "path", "left_anti")
    added = missing.select(
        F.col("path").alias("task_id"), F.lit("rebuild").alias("run_id"), "source", "product", "month", "band",
        F.col("observations").alias("selected"), F.col("observations").alias("checkpointed"),
        F.col("observations").alias("completed"), F.lit("complete").alias("status"), F.lit(now_seconds).alias("updated_at"))
    return archives, tasks.unionByName(added)


def merge_month(old: DataFrame, new: DataFrame, key: str = "asset_id", time: str = "time", ties: list[str] | None = None) -> DataFrame:
    """Observations of a month, one per asset; the stored copy wins."""
    rows = stack([old, new])
    order = [F.col("src_ord"), *[F.col(t) for t in ties or []]]
    return first_of(rows, [key], order).drop("src_ord", "_rank").orderBy(time, key)


def adoption_audit(wanted: DataFrame, shared: DataFrame, older: DataFrame, key: str = "asset_id", content: str = "content") -> DataFrame:
    """What adopting older stores would do per asset; two different contents fail."""
    nothing = F.lit(None).cast(shared.schema[content].dataType).alias(content)
    sides = [(shared, F.col(content), 1, 0, 0), (older, F.col(content), 0, 1, 0), (wanted, nothing, 0, 0, 1)]
    stacked = [df.select(key, c, F.lit(s).alias("_s"), F.lit(o).alias("_o"), F.lit(w).alias("_w")) for df, c, s, o, w in sides]
    # Everything is dealt by the asset once; the counts by content and by asset find their rows where they are.
    rows = reduce(lambda a, b: a.unionByName(b), stacked).filter(F.col(key).isNotNull() | (F.col("_w") == 1)).repartition(key)
    per = rows.groupBy(key).agg(F.count_distinct(content).alias("_kinds"), *[F.sum(c).alias(c) for c in ("_s", "_o", "_w")])
    rows = guard(per, F.col("_kinds") <= 1, "Copies of one asset differ in content").filter("_w > 0")
    has = F.coalesce("_s", F.lit(0)) > 0
    action = F.when(has, "already_shared").when(F.coalesce("_o", F.lit(0)) > 0, "moved").otherwise("not_present")
    spare = F.when(has, F.coalesce("_o", F.lit(0))).otherwise(F.greatest(F.coalesce("_o", F.lit(0)) - 1, F.lit(0)))
    return rows.select(key, action.alias("action"), spare.cast("long").alias("duplicates_removed"))


def set_relations(left: DataFrame, right: DataFrame, keys: list[str], item: str) -> DataFrame:
    """Per key the sizes of union, intersection and differences, and the subset and disjoint tests.

    Items are reduced to one row per key and item first, so no set is gathered.
    """
    rows = left.select(*keys, item, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*keys, item, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    each = rows.groupBy(*keys, item).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    both, only_l, only_r = (F.col("_l") + F.col("_r") == 2), (F.col("_r") == 0), (F.col("_l") == 0)
    out = each.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("in_either"), F.count_if(both).alias("in_both"),
        F.count_if(only_l).alias("only_left"), F.count_if(only_r).alias("only_right"))
    return out.withColumns({"left_is_subset": F.col("only_left") == 0, "disjoint": F.col("in_both") == 0,
                            "equal": (F.col("only_left") == 0) & (F.col("only_right") == 0)})


def queue_tasks(assets: DataFrame, existing: DataFrame, run_id: str, now_seconds: float) -> DataFrame:
    """One queued task per product, band and month, with the digest of its id set; known tasks stay."""
    groups = assets.groupBy("source", "product", "band", "month").agg(
        F.count(F.lit(1)).alias("selected"), id_set_digest(F.col("asset_id")).alias("ids_digest"))
    target = F.concat_ws("/", "source", "product", F.when(F.col("band").isNotNull(), F.format_string("C%02d", "band")), "month")
    queued = groups.select(
        target.alias("task_id"), F.lit(run_id).alias("run_id"), "source", "product", "month", "band", "selected",
        F.lit(0).cast("long").alias("checkpointed"), F.lit(0).cast("long").alias("completed"), F.lit("queued").alias("status"),
        F.lit(now_seconds).alias("updated_at"), "ids_digest")
    return existing.unionByName(queued.join(existing.select("task_id"), "task_id", "left_anti"))


def complete_tasks(tasks: DataFrame, scratch: DataFrame, manifest_assets: DataFrame, files: DataFrame) -> DataFrame:
    """Drop scratch rows superseded by a target; complete a task only when its manifest holds exactly
    its ids and its file has the stored size.

    scratch: folder, target; manifest_assets: path, asset_id, stored_bytes; files: path, length.
    """
    superseded = scratch.filter("target is not null").select(F.col("folder").alias("task_id"))
    rows = tasks.join(superseded, "task_id", "left_anti")
    proof = manifest_assets.groupBy("path").agg(
        id_set_digest(F.col("asset_id")).alias("_digest"), F.count(F.lit(1)).alias("_n"), F.max("stored_bytes").alias("_stored"))
    proof = proof.join(files.select("path", "length"), "path").filter(F.col("length") == F.col("_stored"))
    joined = rows.join(proof.withColumnRenamed("path", "task_id"), "task_id", "left")
    done = (F.col("status") != "complete") & (F.col("_digest") == F.col("ids_digest"))
    done = F.coalesce(done, F.lit(False))
    return joined.withColumns({
        "completed": F.when(done, F.col("_n")).otherwise(F.col("completed")),
        "status": F.when(done, "complete").otherwise(F.col("status"))}).select(*tasks.columns)


def verify_archives(archives: DataFrame, manifests: DataFrame, files: DataFrame) -> DataFrame:
    """Every indexed archive against its manifest (checksum, size) and its file (length)."""
    facts = manifests.select("path", F.col("archive_sha256").alias("_sha"), F.col("stored_bytes").alias("_bytes"))
    rows = archives.join(facts, "path", "left").join(files.select("path", "length"), "path", "left")
    problem = (
        F.when(F.col("length").isNull(), "file missing").when(F.col("_sha").isNull(), "manifest missing")
        .when(F.col("_sha") != F.col("sha256"), "checksum differs").when(F.col("length") != F.col("stored_bytes"), "size differs")
        .when(F.coalesce("_bytes", F.col("stored_bytes")) != F.col("stored_bytes"), "declared size differs"))
    return rows.select("path", problem.alias("problem"))


def group_fingerprints(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows and an order-free portable content number per group."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(hash_number(line)).alias("content"),
        F.sum(hash_number(line).cast("decimal(38,0)")).alias("total"))

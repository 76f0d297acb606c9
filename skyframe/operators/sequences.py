"""Ordered scans that do not put a hot key into one task.

A plain ``Window.partitionBy(key)`` sorts one key in one task. The scans here range-partition all rows by key and order
together, so that a key of any size spreads over as many ranges as its rows need, and a NULL key like any other. Each
range is scanned on its own, and one carry row per key and range is passed along the key. There is no limit on keys, rows
or ranges: their number is the session's shuffle partitions, which a cluster sets to its data. The ranges are written to
the shared folder once, so that both uses of them see the same cuts, also when a task runs again. Results do not depend
on where the cuts fall.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.functions.checks import guard
from skyframe.session import written

GROUPS = 1 << 18  # keys' parts of ranges up to which their starts are broadcast


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys that may be NULL: a NULL meets a NULL. The left side's keys stay."""
    same = reduce(lambda x, y: x & y, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    added = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), same, how).select("l.*", *added)


def with_block(df: DataFrame, keys: list[str], order: list[Column], parts: int | None = None) -> DataFrame:
    """Add ``_block``, the range of a row among all rows by key and order. Equal rows are in one block."""
    count = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, *[F.col(k) for k in keys], *order)
    return written(ranged.withColumn("_block", F.spark_partition_id()), "ranges")


def ranged(df: DataFrame, order: list[Column], parts: int | None = None) -> DataFrame:
    """Rows dealt into ranges by ``order``, and ``_block``, the range of a row. The rows are shuffled here, once: whatever reads
    the result reads that shuffle's files. It keeps its cuts, so all that read it see the same, also when a task runs again."""
    spark = df.sparkSession
    dealt = df.repartitionByRange(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    rows = spark._jsparkSession.internalCreateDataFrame(dealt._jdf.queryExecution().toRdd(), dealt._jdf.schema(), False)
    return DataFrame(rows, spark).withColumn("_block", F.spark_partition_id())


def with_element_ordinal(df: DataFrame, keys: list[str], instant: Column, array: str, key: str, order: str, name: str = "ordinal",
                         unchanged: tuple[str, str] | None = None, parts: int | None = None) -> DataFrame:
    """One row for every element of ``array``, as ``_element``, with the zero-based position of the element among all of its
    ``keys`` and its field ``key``, by ``instant`` (NULL first) and then its field ``order``; ``_size`` is the array's.

    Rows are shuffled once, before their arrays are spread out, and by ``instant`` and their least ``order``, so one key or
    instant may hold any share of them. Elements of an instant that lies in several ranges (there is at most one for every
    cut) may stand in any of these: they are numbered by a scan of their own. All others are numbered by their place in
    the range, from what is counted per key and range. With ``unchanged``, a column and a message, keys for which the column
    has not one value fail.
    """
    column, message = unchanged or (array, "")
    least = F.array_min(F.transform(array, lambda x: x[order]))
    rows = ranged(df, [*[F.col(k) for k in keys], instant, least], parts).withColumn("_at", F.coalesce(instant, F.lit(-(1 << 63))))
    told = rows.groupBy(*keys, "_block", *([column] if unchanged else [])).agg(F.min("_at").alias("_low"), F.max("_at").alias("_high"))
    told = written(told, "edges")
    edges = told.groupBy(*keys, "_block").agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"))
    if unchanged:
        values = told.groupBy(*keys).agg(F.count_distinct(column).alias("_values"))
        # One row says it of all keys; a join by keys would put each of them into one task.
        edges = edges.crossJoin(F.broadcast(guard(values.agg(F.count_if(F.col("_values") != 1).alias("_changed")), F.col("_changed") == 0, message)))
    after = F.lead("_low").over(Window.partitionBy(*keys).orderBy("_block"))
    cut = edges.withColumn("_after", after).filter("_after = _high").select(*keys, F.col("_high").alias("_at")).distinct().withColumn("_cut", F.lit(True))
    # At most one row for every cut.
    rows = join_on(rows, F.broadcast(cut), [*keys, "_at"])
    kept = [c for c in df.columns if c not in (array, column)]
    each = rows.select(*kept, "_block", "_at", "_cut", F.size(array).alias("_size"), F.explode(array).alias("_element"))
    named = {"_key": F.col("_element")[key], "_order": F.col("_element")[order]}
    whole, out = [*keys, "_key"], [*kept, "_size", "_element", (F.col("_place") + F.col("_move")).alias(name)]
    counted = written(each.withColumns(named).groupBy(*whole, "_block", F.when(F.col("_cut"), F.col("_at")).alias("_shared")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")), "counted")
    before = (Window.unboundedPreceding, -1)
    start = F.sum("_n").over(Window.partitionBy(*whole).orderBy("_block", "_first").rowsBetween(*before))
    starts = counted.withColumn("_start", F.coalesce(start, F.lit(0)))
    place = F.sum("_n").over(Window.partitionBy("_block").orderBy(*whole).rowsBetween(*before))
    moves = starts.filter("_shared IS NULL").select(*whole, "_block", (F.col("_start") - F.coalesce(place, F.lit(0))).alias("_move"))
    moves = F.broadcast(moves) if counted.count() <= GROUPS else moves
    alone = each.filter("_cut IS NULL").drop("_cut").sortWithinPartitions(*keys, named["_key"], "_at", named["_order"])
    # A row's place in its sorted range: the lower 33 bits.
    alone = alone.withColumns({"_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)), "_key": named["_key"]})
    alone = join_on(alone, moves, [*whole, "_block"], "inner").select(*out)
    several = with_ordinal(each.filter("_cut").drop("_block", "_cut").withColumns(named), [*whole, "_at"], ["_order"], "_place", parts)
    moves = starts.filter("_shared IS NOT NULL").groupBy(*whole, F.col("_shared").alias("_at")).agg(F.min("_start").alias("_move"))
    return alone.unionByName(join_on(several, moves, [*whole, "_at"], "inner").select(*out))


def _scan(df, keys, order, parts):
    """Blocked rows, the same dealt to a task a block, the window inside a block and the window along the blocks of a key."""
    columns = [F.col(o) for o in order]
    blocked = with_block(df, keys, columns, parts)
    # By their number: hashes of blocks collide, and a task would read several of them.
    dealt = blocked.repartitionById(parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_block")
    inside = Window.partitionBy(*keys, "_block").orderBy(*columns)
    along = Window.partitionBy(*keys).orderBy("_block")
    return blocked, dealt, inside, along


def _attach(rows, carry, keys):
    return join_on(rows, carry, [*keys, "_block"])


def with_previous(df: DataFrame, keys: list[str], order: list[str], values: list[str],
                  prefix: str = "prev_", parts: int | None = None) -> DataFrame:
    """Add the values of the preceding row of the key (``lag``). Order columns must be ascending."""
    blocked, dealt, inside, along = _scan(df, keys, order, parts)
    kept = F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    rows = dealt.withColumn("_lag", F.lag(kept).over(inside))
    tails = blocked.groupBy(*keys, "_block").agg(
        F.max(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], kept.alias("kept"))).alias("_tail"))
    carry = tails.select(*keys, "_block", F.lag("_tail.kept").over(along).alias("_carry"))
    out = _attach(rows, carry, keys)
    best = F.coalesce("_lag", "_carry")
    return out.select(*df.columns, *[best[f"v{i}"].alias(prefix + v) for i, v in enumerate(values)])


def with_neighbours(df: DataFrame, keys: list[str], order: list[str], value: str, last: str | None = "last",
                    following: str | None = None, bounded: bool = False, parts: int | None = None) -> DataFrame:
    """Add the last non-NULL ``value`` at or before the row and/or the first one at or after it.

    ``bounded`` promises that a key's rows are few (an axis, a clock); then one plain window does.
    """
    # What follows is what precedes in the reverse order: a frame up to the key's end would be summed anew for every row.
    behind = (Window.unboundedPreceding, Window.currentRow)
    back = [F.col(o).desc() for o in order]
    if bounded:
        whole = Window.partitionBy(*keys)
        found = []
        if last:
            found.append(F.last(value, ignorenulls=True).over(whole.orderBy(*order).rowsBetween(*behind)).alias(last))
        if following:
            found.append(F.last(value, ignorenulls=True).over(whole.orderBy(*back).rowsBetween(*behind)).alias(following))
        return df.select("*", *found)
    blocked, dealt, inside, along = _scan(df, keys, order, parts)
    position = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)])
    known = F.when(F.col(value).isNotNull(), position)
    kept = F.struct(F.col(value).alias("v"))
    edges = blocked.groupBy(*keys, "_block").agg(F.max_by(kept, known).alias("_tail"), F.min_by(kept, known).alias("_head"))
    rows, carry, out = dealt, [], list(df.columns)
    if last:
        rows = rows.withColumn("_behind", F.last(value, ignorenulls=True).over(inside.rowsBetween(*behind)))
        earlier = along.rowsBetween(Window.unboundedPreceding, -1)
        carry.append(F.last("_tail.v", ignorenulls=True).over(earlier).alias("_carry_behind"))
        out.append(F.coalesce("_behind", "_carry_behind").alias(last))
    if following:
        rows = rows.withColumn("_ahead", F.last(value, ignorenulls=True).over(inside.orderBy(*back).rowsBetween(*behind)))
        later = along.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
        carry.append(F.last("_head.v", ignorenulls=True).over(later).alias("_carry_ahead"))
        out.append(F.coalesce("_ahead", "_carry_ahead").alias(following))
    return _attach(rows, edges.select(*keys, "_block", *carry), keys).select(*out)


def with_running(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str,
                 total: str | None = None, parts: int | None = None) -> DataFrame:
    """Add the running total of ``value`` up to and including the row, and the key's ``total`` if named."""
    return with_runnings(df, keys, order, {name: value}, {name: total} if total else {}, parts)


def with_runnings(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column], totals: dict[str, str] | None = None,
                  parts: int | None = None) -> DataFrame:
    """Add several running totals in one scan, by name, and the key's totals of those that ``totals`` names."""
    source = df.withColumns({f"_value{i}": v for i, v in enumerate(values.values())})
    blocked, dealt, inside, along = _scan(source, keys, order, parts)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier, whole = along.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    n = range(len(values))
    rows = dealt.withColumns({f"_here{i}": F.sum(f"_value{i}").over(upto) for i in n})
    tails = blocked.groupBy(*keys, "_block").agg(*[F.sum(f"_value{i}").alias(f"_part{i}") for i in n])
    carry = tails.select(*keys, "_block", *[F.coalesce(F.sum(f"_part{i}").over(earlier), F.lit(0)).alias(f"_carry{i}") for i in n],
                         *[F.sum(f"_part{i}").over(whole).alias(f"_total{i}") for i in n])
    out = _attach(rows, carry, keys)
    upto = [(F.coalesce(f"_here{i}", F.lit(0)) + F.coalesce(f"_carry{i}", F.lit(0))).alias(name) for i, name in enumerate(values)]
    known = [F.col(f"_total{i}").alias(totals[name]) for i, name in enumerate(values) if totals and name in totals]
    return out.select(*df.columns, *upto, *known)


def with_running_max(df: DataFrame, keys: list[str], order: list[str], value: str, name: str,
                     parts: int | None = None) -> DataFrame:
    """Add the greatest ``value`` over all *earlier* rows of the key (NULL on the first)."""
    blocked, dealt, inside, along = _scan(df, keys, order, parts)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.withColumn("_here", F.max(value).over(before))
    tails = blocked.groupBy(*keys, "_block").agg(F.max(value).alias("_top"))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(*keys, "_block", F.max("_top").over(earlier).alias("_carry"))
    out = _attach(rows, carry, keys)
    return out.select(*df.columns, F.greatest("_here", "_carry").alias(name))


def with_ordinal(df: DataFrame, keys: list[str], order: list[str], name: str = "ordinal",
                 parts: int | None = None) -> DataFrame:
    """Add the zero-based position of the row in its key."""
    out = with_running(df, keys, order, F.lit(1), "_upto", parts=parts)
    return out.withColumn(name, (F.col("_upto") - 1).cast("long")).drop("_upto")


def islands(df: DataFrame, keys: list[str], order: list[str], starts: Column, name: str = "island",
            parts: int | None = None) -> DataFrame:
    """Number runs: a new one begins wherever ``starts`` is true."""
    return with_running(df, keys, order, F.when(starts, 1).otherwise(0), name, parts=parts)


def _both_sides(left, right, keys, left_us, right_us, right_order, payload):
    """Left and right rows on one time line; right rows of an instant come before left ones."""
    ties = [f"_t{i}" for i in range(len(right_order))]
    asked = left.select(*keys, F.col(left_us).alias("_at"), F.lit(1).alias("_side"), F.struct(*[F.col(c) for c in left.columns]).alias("_left"))
    found = right.select(
        *keys, F.col(right_us).alias("_at"), F.lit(0).alias("_side"), *[F.col(c).alias(t) for c, t in zip(right_order, ties)],
        F.struct(F.col(right_us).alias("_us"), *[F.col(c) for c in payload]).alias("_right"))
    return asked.unionByName(found, allowMissingColumns=True), ["_at", "_side", *ties]


def asof_latest(left: DataFrame, right: DataFrame, keys: list[str], left_us: str, right_us: str, right_order: list[str],
                payload: list[str], hit: str = "hit", tolerance_us: int | None = None, bounded: bool = False, parts: int | None = None) -> DataFrame:
    """As-of join with reuse: for each left row the latest right row at or before it.

    Both sides go through one ordered scan, so the work is linear in their sizes and no pairs are formed.
    ``right_order`` breaks ties between right rows of one instant (ascending, last wins). ``hit`` is a
    struct of ``_us`` and the payload, or NULL.
    """
    both, order = _both_sides(left, right, keys, left_us, right_us, right_order, payload)
    scanned = with_neighbours(both, keys, order, "_right", "_last", bounded=bounded, parts=parts).filter("_side = 1")
    value = F.col("_last")
    if tolerance_us is not None:
        value = F.when(F.col("_at") - F.col("_last._us") <= tolerance_us, value)
    return scanned.select("_left.*", value.alias(hit))


def asof_nearest(left: DataFrame, right: DataFrame, keys: list[str], left_us: str, right_us: str, payload: list[str],
                 tolerance_us: int, hit: str = "hit", parts: int | None = None) -> DataFrame:
    """As-of join to the nearest right row within the tolerance, the earlier one on a tie. Right rows must
    be unique per key and instant."""
    both, order = _both_sides(left, right, keys, left_us, right_us, [], payload)
    scanned = with_neighbours(both, keys, order, "_right", "_last", "_next", parts=parts).filter("_side = 1")
    back, ahead = F.col("_at") - F.col("_last._us"), F.col("_next._us") - F.col("_at")
    pick = F.when(F.col("_next").isNull() | (back <= ahead), F.col("_last")).otherwise(F.col("_next"))
    near = F.when(F.abs(F.col("_pick._us") - F.col("_at")) <= tolerance_us, F.col("_pick"))
    return scanned.withColumn("_pick", pick).select("_left.*", near.alias(hit))

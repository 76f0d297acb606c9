"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.common import WORD, running_total
from skyframe.session import written

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Words of a text; none in a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = 3) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from ``source`` and ``size`` rows.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all sizes; none gets more
    than ``repeats`` times its size, and what it cannot take goes to the others by weight. In closed form: by rising
    size per weight the sources are capped one after another, as long as the level of the rest lies above their cap.
    The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(place) - 1) % len(weights)
    rows = per.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    everything = Window.partitionBy(F.lit(0))
    ratio = F.col("source_size") * repeats / F.col("_w")
    order = everything.orderBy("_ratio", F.col("source").asc_nulls_last())
    rows = rows.withColumn("_ratio", ratio).withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest_weight = F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.col("_total") - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * repeats) / rest_weight
    rows = rows.withColumn("_level", level).withColumn("_capped", F.col("_ratio") <= F.col("_level"))
    final = F.min(F.when(~F.col("_capped"), F.struct("_ratio", "_level"))).over(everything)["_level"]
    target = F.when(F.col("_capped"), (F.col("source_size") * repeats).cast("double")).otherwise(F.col("_w") * final)
    return rows.select("source", "source_size", target.alias("target"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = 3, seed: int = 0,
          id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id``, ``nth``, ``size``, ``source``, ``source_size``, ``target``, ``copies``, ``taken``.

    Every source is shuffled by a keyed hash; a copy of a document finishes at the virtual time at which its source has
    given out so many words per word of its target. All copies are ranged by that time over all sources and taken until
    the budget (``share`` of all words) is used up. Equal finish times go by source and key, so reruns agree.

    Null text: size 0. Null source: a source of its own, the last. Rows that repeat a doc_id (or have none) are documents
    of their own, told apart by ``nth``, their place by source and text hash. Documents without words take part with size
    0. An empty table gives no rows. Other columns are not read.
    """
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("source", "_hash"))
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                       word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("_hash"))
    rows = written(rows.withColumn("nth", nth).withColumn("_key", F.xxhash64(F.lit(seed), "doc_id", "nth")).drop("_hash"), "sizes")
    targets = source_targets(rows, weights, share, repeats)
    ahead = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    # One row per source on the broadcast-or-shuffle side: left to the planner, which knows its size.
    per = targets.withColumn("_ahead", F.coalesce(F.sum("source_size").over(ahead), F.lit(0)))
    queue = running_total(rows, [F.col("source").asc_nulls_last(), F.col("_key"), F.col("doc_id"), F.col("nth")], "size", "_upto")
    placed = queue.alias("q").join(per.alias("p"), F.col("q.source").eqNullSafe(F.col("p.source"))).select(
        "q.doc_id", "q.nth", "q.source", "q.size", "q._key", "p.source_size", "p.target", (F.col("q._upto") - F.col("p._ahead")).alias("_inside"))
    copy = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_copy")
    finish = (F.col("_inside") + F.col("_copy") * F.col("source_size")) / F.col("target")
    copies = placed.filter("target > 0").select("*", copy).withColumn("_finish", finish)
    budget = rows.agg((F.coalesce(F.sum("size"), F.lit(0)) * F.lit(float(share))).alias("_budget"))
    order = [F.col(c) for c in ("_finish", "source", "_key", "doc_id", "nth", "_copy")]
    ranged = running_total(copies.select("doc_id", "nth", "source", "size", "_key", "_copy", "_finish"), order, "size", "_spent")
    kept = ranged.join(F.broadcast(budget)).filter("_spent <= _budget").groupBy("doc_id", "nth").agg(F.count(F.lit(1)).alias("copies"))
    same = F.col("a.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("a.nth") == F.col("k.nth"))
    return placed.alias("a").join(kept.alias("k"), same, "left").select(
        "a.doc_id", "a.nth", "a.size", "a.source", "a.source_size", "a.target", F.coalesce("k.copies", F.lit(0)).alias("copies"),
        (F.coalesce("k.copies", F.lit(0)) * F.col("a.size")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = 3, seed: int = 0,
        id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: the documents as often as ``mixed`` takes them, with all their columns."""
    taken = mixed(docs, weights, share, repeats, seed, id, text, source).filter("copies > 0").select("doc_id", "nth", "copies")
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("_source", "_hash"))
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("_source"), F.xxhash64(F.col(text)).alias("_hash"), rest)
    same = F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("d.nth") == F.col("t.nth"))
    rows = rows.withColumn("nth", nth).alias("d").join(taken.alias("t"), same).select("d.rest", "t.copies")
    return rows.select("rest", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("rest.*")

"""Lines that repeat across documents: two Bloom filters find suspects, only those shuffle to be confirmed exactly."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import packed, schema_of, slices, texts, unpacked
from skyframe.session import written

PAGE = 1 << 16  # cells of a filter that travel and are merged together
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28  # a filter's cells: 4 per line within these bounds; the upper one bounds the broadcast at 32 MB
HASHES = 2


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return line.strip().lower()


def long_keys(text: bytes, least: int) -> list[bytes]:
    """Distinct line keys of at least ``least`` code points."""
    keys = {line_key(line) for line in text.split(b"\n")}
    return [k for k in keys if len(k) >= least and (k.isascii() or len(k.decode()) >= least)]


def cells(keys: list[bytes], bits: int) -> np.ndarray:
    """The ``HASHES`` cells of every key, one row per key."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))
    low, high = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32)
    return np.stack([(low + np.uint64(i) * (high | np.uint64(1))) % np.uint64(bits) for i in range(HASHES)], axis=1).astype(np.int64)


def note(once: np.ndarray, twice: np.ndarray, found: np.ndarray) -> None:
    """Count cells of one document up to two: seen before goes to ``twice``, new ones to ``once``."""
    found = np.unique(found)
    twice[found[once[found]]] = True
    once[found] = True


def repeat_filter(docs: DataFrame, bits: int, least: int) -> np.ndarray:
    """Merged twice-seen filter of ``bits`` cells over the line keys of all documents, as packed bits.

    Every task fills its own once-seen and twice-seen filters. Merged cell by cell, a cell is seen twice if it is so in
    one task or seen once in two; a key that two documents hold has all its cells there, so none is missed.
    """
    def fill(batches):
        once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
        for batch in slices(batches):
            for text in texts(batch):
                keys = long_keys(text, least)
                if keys:
                    note(once, twice, cells(keys, bits).ravel())
        pages = [(p, x, y) for p in range(bits // PAGE) if (x := once[p * PAGE:(p + 1) * PAGE]).any() for y in [twice[p * PAGE:(p + 1) * PAGE]]]
        yield pa.RecordBatch.from_arrays([
            pa.array([p for p, _, _ in pages], pa.int32()),
            pa.array([zlib.compress(np.packbits(x).tobytes(), 1) for _, x, _ in pages], pa.binary()),
            pa.array([zlib.compress(np.packbits(y).tobytes(), 1) for _, _, y in pages], pa.binary())], names=["page", "once", "twice"])

    def merge(batches):
        once, twice = {}, {}
        for batch in batches:
            for page, x, y in zip(*(batch.column(c).to_pylist() for c in ("page", "once", "twice"))):
                x, y = (np.frombuffer(zlib.decompress(v), np.uint8) for v in (x, y))
                if page in once:
                    twice[page] |= y | (once[page] & x)
                    once[page] |= x
                else:
                    once[page], twice[page] = x.copy(), y.copy()
        kept = sorted(p for p in twice if twice[p].any())
        yield pa.RecordBatch.from_arrays([
            pa.array(kept, pa.int32()), pa.array([zlib.compress(twice[p].tobytes(), 1) for p in kept], pa.binary())], names=["page", "twice"])

    filled = docs.select("text").mapInArrow(fill, "page int, once binary, twice binary")
    merged = filled.repartition("page").mapInArrow(merge, "page int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.collect():  # at most ``MOST_BITS / 8`` bytes, whatever the number of lines
        out[row["page"] * PAGE // 8:(row["page"] + 1) * PAGE // 8] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    return out


def line_filter_bits(docs: DataFrame) -> int:
    """Cells for the lines of the table: four times their number as a power of two, within the bounds."""
    newlines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    lines = docs.agg(F.sum(newlines)).first()[0] or 0
    return int(min(MOST_BITS, max(LEAST_BITS, 1 << (4 * int(lines)).bit_length())))


def repeated_lines(docs: DataFrame, least: int = 20, copies: int = 3, keep: str = "last", bits: int | None = None) -> DataFrame:
    """``doc_id`` and ``key`` of every line key that the document loses, of ``doc_id`` and ``text`` rows.

    Only keys whose cells are all in the twice-seen filter are shuffled: to their document, so that repeated rows count
    once, then by key, pre-aggregated, to be counted and to find the document that keeps them. False positives of the
    filter are counted away there; a table beyond the filter's bound only has more of them.
    """
    spark = docs.sparkSession
    bits = bits or line_filter_bits(docs)
    seen = spark.sparkContext.broadcast(repeat_filter(docs, bits, least))

    def suspects(batches):
        for batch in slices(batches):
            ids, keys = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                own = long_keys(text, least)
                if own and doc is not None:
                    at = cells(own, bits)
                    hit = ((seen.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
                    picked = [k for k, h in zip(own, hit.tolist()) if h]
                    ids += [doc] * len(picked)
                    keys += picked
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()).cast(pa.string())], names=["doc_id", "key"])

    rows = written(docs.select("doc_id", "text").mapInArrow(suspects, "doc_id long, key string"), "suspects").distinct()
    best = F.max("doc_id") if keep == "last" else F.min("doc_id")
    known = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), best.alias("_keeps")).filter(F.col("_n") >= copies)
    return rows.join(known.select("key", "_keeps"), "key").filter("doc_id <> _keeps").select("doc_id", "key")


def without_repeated_lines(docs: DataFrame, least: int = 20, copies: int = 3, keep: str = "last", id: str = "doc_id",
                           text: str = "text", bits: int | None = None, raw: bool = False) -> DataFrame:
    """The documents without the lines whose key is in ``copies`` documents or more, except in the last (or first) one.

    All columns stay. A null or empty text is one empty line and comes back empty. A null doc_id counts as no document
    and loses no line; rows that repeat a doc_id are one document to the count, and each loses its lines. The key is at
    least ``least`` code points long, so shorter lines always stay. With ``raw`` the columns are ``doc_id``, ``rest`` (a
    struct of the other columns), ``kept``, ``n_lines`` and ``n_dropped``.
    """
    rows = packed(docs, text, id)
    lost = repeated_lines(rows.select("doc_id", "text"), least, copies, keep, bits)
    per = lost.groupBy("doc_id").agg(F.collect_list("key").alias("_lost"))  # bounded by the document's own lines
    joined = rows.join(per, "doc_id", "left")

    def drop(batches):
        for batch in slices(batches):
            kept, n, dropped = [], [], []
            for content, lost in zip(texts(batch), batch.column("_lost").to_pylist()):
                lines = content.split(b"\n")
                gone = {k.encode() for k in lost or ()}
                left = [line for line in lines if line_key(line) not in gone] if gone else lines
                n.append(len(lines))
                dropped.append(len(lines) - len(left))
                kept.append(b"\n".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rest"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(dropped, pa.int64())],
                names=["doc_id", "rest", "kept", "n_lines", "n_dropped"])

    out = joined.mapInArrow(drop, schema_of(joined.select("doc_id", "rest"), kept="string", n_lines="long", n_dropped="long"))
    return out if raw else unpacked(out, docs, text, "kept")

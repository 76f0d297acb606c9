"""Near copies by SimHash fingerprints: pivot distance tables discard pairs, popcounts verify, links become components.
With a similarity the links are checked on the shingles, and pairs at it with other fingerprints are met by keys."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import components, partitions, shares, slices, texts
from skyframe.session import written

PIVOTS = 24  # reference fingerprints of a distance table
SLOTS = 128  # smallest shingle hashes kept of a long text, by hash class
BANDS = 16  # pairs of slots that let long similar texts meet
SHORT = 64  # texts up to this many shingles meet by some of the shingles themselves, which misses no pair
LOOSE = 0.3  # by so much the share of equal slots may fall short of the similarity before the exact check
SMALL = 24  # runs up to this many fingerprints are compared by shifts, longer ones by expanding groups
PIECE = 1 << 22  # comparisons at a time
TILE = 4096  # rows of one key that are compared as one; keys of more rows go in parts of about so many, two of them a tile


def shingle_hashes(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``words`` words, space-joined, ASCII lower case; of the whole sequence if it is shorter."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(parts), xxhash.xxh64_intdigest
    n = max(1, len(parts) - words + 1)
    if n == 1:
        return np.array([digest(line, seed)], np.uint64)
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=at[1:])
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(at[:n].tolist(), (at[words:words + n] - 1).tolist())), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """Fingerprint: a bit is one if it is one in over half the hashes; zero without any."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):
        part = np.ascontiguousarray(hashes[start:start + (1 << 16)]).astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Least hash of each of ``SLOTS`` classes; an empty class takes over its next neighbour's, marked by the distance."""
    out = np.zeros(SLOTS, np.uint64)
    if not len(hashes):
        return out
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)  # classes by other bits than the fingerprint's
    mixed ^= mixed >> np.uint64(29)
    order = np.sort(mixed)
    slot = (order & np.uint64(SLOTS - 1)).astype(np.int64)
    full, first = np.unique(slot, return_index=True)
    out[full] = order[first]
    gap = full[np.searchsorted(full, np.arange(SLOTS)) % len(full)]
    away = (gap - np.arange(SLOTS)) % SLOTS
    return out[gap] + away.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def references() -> np.ndarray:
    """The reference fingerprints: a fixed random set."""
    return np.random.default_rng(20).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def table(prints: np.ndarray) -> np.ndarray:
    """Hamming distances of every fingerprint to every reference."""
    return np.bitwise_count(prints[:, None] ^ references()[None, :]).astype(np.int8)


def near(prints, pivots, a, b, max_bits) -> np.ndarray:
    """Which of the pairs (a, b) link: pivot distances differ by ``max_bits`` at most in every coordinate (by the triangle
    inequality no link fails that), then the fingerprints do."""
    ok = np.zeros(np.broadcast(a, b).shape, bool)
    a, b = np.broadcast_arrays(a, b)
    left = np.arange(len(a))
    for p in range(PIVOTS):
        left = left[np.abs(pivots[a[left], p] - pivots[b[left], p]) <= max_bits]
    ok[left[np.bitwise_count(prints[a[left]] ^ prints[b[left]]) <= max_bits]] = True
    return ok


def expand(members: np.ndarray, link) -> list[tuple[np.ndarray, int]]:
    """Spanning links of a long run: a member reaches all unreached ones it links to, until none is left to reach.

    A tight group of copies is reached from its first members, so this is far from all pairs; it holds no pair list.
    """
    out, waiting = [], members
    while len(waiting):
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            at = queue.pop()
            hit = np.concatenate([link(np.intp(at), waiting[s:s + PIECE]) for s in range(0, len(waiting), PIECE)])
            if hit.any():
                reached = waiting[hit]
                out.append((reached, at))
                queue.extend(reached.tolist())
                waiting = waiting[~hit]
    return out


def shifted(runs: np.ndarray):
    """All pairs (a, b) within the runs (starts and ends, each of at most ``SMALL`` rows), shift by shift."""
    for shift in range(1, SMALL):
        begin, length = runs[:, 0], runs[:, 1] - runs[:, 0] - shift
        begin, length = begin[length > 0], length[length > 0]
        if not len(begin):
            return
        a = np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        yield a, a + shift


def run_links(keys: np.ndarray, prints: np.ndarray, marks: None = None, max_bits: int = 4, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices a, b) within every run of equal keys (sorted): all of short runs, spanning ones of long runs."""
    runs = [r for r in shares(keys) if r[1] - r[0] > 1]
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pivots, found_a, found_b = table(prints), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in shifted(np.array([r for r in runs if r[1] - r[0] <= SMALL], np.int64).reshape(-1, 2)):
        ok = near(prints, pivots, a, b, max_bits)
        found_a.append(a[ok])
        found_b.append(b[ok])
    for begin, end in runs:
        if end - begin > SMALL:
            for reached, at in expand(np.arange(begin, end), lambda x, y: near(prints, pivots, x, y, max_bits)):
                found_a.append(np.full(len(reached), at))
                found_b.append(reached)
    return np.concatenate(found_a), np.concatenate(found_b)


def bit_keys(max_bits: int) -> list[tuple[int, int]]:
    """(shift, mask) pieces: of ``max_bits + 2`` segments two are equal in every linked pair; all pairs of segments."""
    n = max_bits + 2
    bounds = [round(i * 64 / n) for i in range(n + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(bounds[:-1], bounds[1:])]
    return [(i, x | y) for i, (x, y) in enumerate(combinations(masks, 2))]


def fingerprints(docs: DataFrame, words: int, seed: int = 42) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (signed long) of ``doc_id`` and ``text`` rows."""
    def run(batches):
        for batch in slices(batches):
            prints = np.array([majority(shingle_hashes(text, words, seed)) for text in texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint long")


def links(classes: DataFrame, max_bits: int) -> DataFrame:
    """Links (``a``, ``b``: class ids) between classes of ``node`` and ``fingerprint``.

    Pairs meet in blocks: a block is a pair of equal fingerprint segments, which every linked pair shares (pigeonhole). It
    is sorted and compared in its task, in pieces of bounded size, and gives at most spanning links, so that a large group
    never becomes a list of its pairs.
    """
    masks = [F.struct(F.lit(i).cast("long").alias("i"), F.lit(m - (1 << 64) if m >> 63 else m).cast("long").alias("m")) for i, m in bit_keys(max_bits)]
    rows = classes.select("node", "fingerprint", F.explode(F.array(*masks)).alias("mask"))
    rows = rows.select("node", "fingerprint", F.xxhash64("mask.i", F.col("fingerprint").bitwiseAND(F.col("mask.m"))).alias("key"))
    # Equal keys of different blocks only bring pairs together that fail the check.

    def compare(batches):
        whole = met(batches)
        if whole is None:
            return
        node, prints = whole.column("node").to_numpy(), whole.column("fingerprint").to_numpy().view(np.uint64)
        a, b = run_links(whole.column("key").to_numpy(), prints, None, max_bits, 0.0)
        yield pa.RecordBatch.from_arrays([pa.array(node[a], pa.int64()), pa.array(node[b], pa.int64())], names=["a", "b"])

    # A partition holds its keys' rows at once; many partitions keep that small, whatever the session's count is for the input.
    many = max(partitions(classes), 32)
    found = rows.repartition(many, "key").mapInArrow(compare, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def met(batches) -> pa.Table | None:
    """A partition's rows sorted by key, without those whose key no other row has."""
    whole = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if whole is None or not whole.num_rows:
        return None
    key = whole.column("key").to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    alone = np.ones(len(key), bool)
    same = key[1:] == key[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    return whole.take(pa.array(order[~alone])) if not alone.all() else None


def content(hashes: np.ndarray) -> bytes:
    """What stands for a set of shingles (sorted, distinct): 16 bytes."""
    return xxhash.xxh3_128_digest(hashes.tobytes())


def meeting_keys(hashes: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray | None, bytes | None]:
    """Keys by which sets of shingles (sorted, distinct) meet, a short set itself and one byte a slot of a long one.

    Two short sets of at least the similarity share one of their ``n - similarity * n + 1`` least members (even keys). Long
    sets meet by pairs of equal slots (odd keys): at 0.8 about one pair in a million meets in none of ``BANDS``. Sets
    near the border have both, so that a pair meets in one of the two ways.
    """
    n, keys, short, marks = len(hashes), [], None, None
    if n <= SHORT / similarity:
        least = hashes[:n - math.ceil(similarity * n - 1e-9) + 1]
        keys.append((least * np.uint64(0xD6E8FEB86659FD93)) & ~np.uint64(1))
        short = hashes.view(np.int64)
    if n > SHORT:
        slots = sketch(hashes)
        step = SLOTS // (2 * BANDS)
        x, y = slots[::2 * step], slots[step::2 * step]
        keys.append((x * np.uint64(0x9E3779B97F4A7C15) ^ (y + np.arange(BANDS, dtype=np.uint64))) * np.uint64(0xD6E8FEB86659FD93) | np.uint64(1))
        marks = ((slots * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8).tobytes()
    return np.unique(np.concatenate(keys)), short, marks


def may_link(n, marks, a, b, similarity) -> np.ndarray:
    """Which of the pairs (a, b) of long sets may have the similarity: by their sizes, which lose no pair, and by equal
    slots with ``LOOSE`` to spare."""
    a, b = np.broadcast_arrays(a, b)
    ok = np.zeros(a.shape, bool)
    for start in range(0, len(a), 1 << 16):
        x, y = a[start:start + (1 << 16)], b[start:start + (1 << 16)]
        at = np.flatnonzero(np.minimum(n[x], n[y]) >= similarity * np.maximum(n[x], n[y]) - 1e-9)
        ok[start + at[(marks[x[at]] == marks[y[at]]).mean(axis=1) >= similarity - LOOSE]] = True
    return ok


class Union:
    """Groups of labels, joined link by link."""

    def __init__(self, label: np.ndarray):
        names, self.group = np.unique(label, return_inverse=True)
        self.parent, self.found = list(range(len(names))), []

    def top(self, row: int) -> int:
        i, parent = int(self.group[row]), self.parent
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def join(self, a, b) -> None:
        """Link the rows a and b one by one; kept are the links that join two groups."""
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = self.top(x), self.top(y)
            if p != q:
                self.parent[p] = q
                self.found.append((x, y))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.array(self.found, np.int64).reshape(-1, 2)
        return at[:, 0], at[:, 1]


def long_pairs(run, values, ends, n, label, similarity: float, keys=None, key=None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within every run of equal numbers (sorted) whose sets may share the similarity; rows of one label need none.

    ``values`` (from ``ends[i]`` to ``ends[i + 1]`` those of row i) are 16 bits of every member's hash: as many members as
    are shared are found among them at least, so no pair is lost, and few come that fall short. Without ``keys`` only
    as many pairs are given as span all of them. With the rows' ``keys``, all are, each at the least key that both have
    (``key`` is that of the run).
    """
    union, found_a, found_b = Union(label), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    marked = np.zeros(1 << 16, bool)
    for begin, end in shares(run):
        own = np.array([union.top(i) for i in range(begin, end)])
        for i in range(begin, end - 1):
            apart = own[i + 1 - begin:] != own[i - begin]
            if not apart.any():
                continue
            mine = values[ends[i]:ends[i + 1]]
            marked[mine] = True
            both = np.add.reduceat(marked[values[ends[i + 1]:ends[end]]], ends[i + 1:end] - ends[i + 1], dtype=np.int64)
            marked[mine] = False
            both = np.minimum(both, np.minimum(n[i], n[i + 1:end]))
            hit = i + 1 + np.flatnonzero(apart & (both / (n[i] + n[i + 1:end] - both) >= similarity))
            if keys is not None:
                least = np.where(np.isin(keys[hit], keys[i]), keys[hit], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
                hit = hit[least >= key[i]]
                found_a.append(np.full(len(hit), i))
                found_b.append(hit)
            elif len(hit):
                union.join(np.full(len(hit), i), hit)
                own[np.isin(own, own[hit - begin])] = own[i - begin]
    return union.links() if keys is None else (np.concatenate(found_a), np.concatenate(found_b))


def padded(sets: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Sets as rows of numbers of their members, filled up with -1, and their sizes."""
    ends = sets.offsets.to_numpy()
    size = np.diff(ends)
    names, number = np.unique(sets.values.to_numpy()[ends[0]:ends[-1]], return_inverse=True)
    out = np.full((len(size), max(1, size.max(initial=0))), -1, np.int32)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(number)) - np.repeat(ends[:-1] - ends[0], size)] = number
    return out, size


def alike(members: np.ndarray, n: np.ndarray, a, b, similarity: float) -> np.ndarray:
    """Which of the pairs (a, b) share at least the similarity of both sets' members."""
    ok = np.zeros(len(a), bool)
    for start in range(0, len(a), 1 << 14):
        x, y = a[start:start + (1 << 14)], b[start:start + (1 << 14)]
        line = np.sort(np.concatenate([members[x], members[y]], axis=1), axis=1)
        both = ((line[:, 1:] == line[:, :-1]) & (line[:, 1:] >= 0)).sum(axis=1)
        ok[start:start + (1 << 14)] = both / np.maximum(n[x] + n[y] - both, 1) >= similarity
    return ok


def short_links(key, members, n, label, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links within every run of equal keys (sorted) of short sets, decided on the sets: as many as span what all pairs
    would join over all runs, given that rows of one label are together already."""
    union = Union(label)
    runs = [r for r in shares(key) if r[1] - r[0] > 1]
    for a, b in shifted(np.array([r for r in runs if r[1] - r[0] <= SMALL], np.int64).reshape(-1, 2)):
        open_ = (label[a] != label[b]) & (np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]) - 1e-9)
        a, b = a[open_], b[open_]
        ok = alike(members, n, a, b, similarity)
        union.join(a[ok], b[ok])
    for begin, end in runs:
        if end - begin <= SMALL:
            continue
        own = np.array([union.top(i) for i in range(begin, end)])
        marked = np.zeros(members.max(initial=0) + 2, bool)
        for i in range(end - begin - 1):
            others = i + 1 + np.flatnonzero(own[i + 1:] != own[i])
            marked[members[begin + i]] = True
            marked[-1] = False  # the filling
            both = marked[members[begin + others]].sum(axis=1)
            hit = others[both / np.maximum(n[begin + i] + n[begin + others] - both, 1) >= similarity]
            marked[members[begin + i]] = False
            if len(hit):
                union.join(np.full(len(hit), begin + i), begin + hit)
                own[np.isin(own, own[hit])] = own[i]
                if (own == own[0]).all():
                    break
    return union.links()


def shingle_sets(docs: DataFrame, members: DataFrame, words: int, seed: int) -> DataFrame:
    """``content`` and ``shingles`` (all distinct hashes) of the members (``content`` and the ``node`` whose text has it)."""
    def run(batches):
        def batch_of(contents, sets):
            ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
            values = pa.array(np.concatenate(sets).view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(contents, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), values)], names=["content", "shingles"])

        contents, sets, held = [], [], 0
        for batch in slices(batches):
            for text, wanted in zip(texts(batch), batch.column("content").to_pylist()):
                hashes = np.unique(shingle_hashes(text, words, seed))
                if content(hashes) == wanted:  # a repeated doc_id may have other texts
                    contents.append(wanted)
                    sets.append(hashes)
                    held += len(hashes)
                if held > 1 << 20:
                    yield batch_of(contents, sets)
                    contents, sets, held = [], [], 0
        if sets:
            yield batch_of(contents, sets)

    found = docs.join(members.withColumnRenamed("node", "doc_id"), "doc_id").withColumn("_text", F.xxhash64("text"))
    found = found.dropDuplicates(["doc_id", "content", "_text"]).select("content", "text")
    return found.mapInArrow(run, "content binary, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (``a``, ``b``) of those pairs whose whole sets share at least the similarity."""
    # A first one or a probe is in many pairs: its set comes last, so that the shuffled rows hold the other one's.
    both = pairs.join(sets.withColumnRenamed("shingles", "_x"), "content").join(
        sets.select(F.col("content").alias("other_content"), F.col("shingles").alias("_y")), "other_content")
    shared = both.select(F.col("node").alias("a"), F.col("other").alias("b"), F.size(F.array_intersect("_x", "_y")).alias("_both"), (F.size("_x") + F.size("_y")).alias("_all"))
    return shared.filter(F.col("_both") / (F.col("_all") - F.col("_both")) >= similarity).select("a", "b")


def still_open(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the keys whose members are not of one component yet, with their components (``label``)."""
    named = components(found).select("node", F.col("component").alias("_label"))
    rows = rows.drop("label").join(named, "node", "left").withColumn("label", F.coalesce("_label", "node")).drop("_label")
    many = rows.groupBy("key").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low < _high")
    return rows.join(many.select("key"), "key")


def tiles(rows: DataFrame) -> DataFrame:
    """The rows with the number of a ``tile``: a key's rows are one, or, beyond ``TILE`` of them, dealt into parts of which
    every two make one, so that all pairs meet and no task needs a whole key."""
    parts = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("_parts"))
    own = F.pmod(F.xxhash64("content"), "_parts").cast("int")
    others = F.when(F.col("_parts") == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("_parts") - 1), F.col("_own")))
    dealt = rows.join(parts, "key").withColumn("_own", own).withColumn("_other", F.explode(others))
    tile = F.xxhash64("key", F.least("_own", "_other"), F.greatest("_own", "_other"))
    return dealt.withColumn("tile", tile).drop("_parts", "_own", "_other")


def print_pairs(classes: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (``content``, ``other``: a class id) of classes whose fingerprints are equal or link at ``max_bits``: every class
    with the first one of its fingerprint, and that fingerprint's first one with those that it links to."""
    prints = classes.groupBy("fingerprint").agg(F.min("node").alias("node"))
    same = classes.join(prints.withColumnRenamed("node", "other"), "fingerprint").filter("node != other").select("content", "other")
    near_ones = links(prints, max_bits).filter("a < b").withColumnRenamed("a", "other")
    return same.unionAll(near_ones.join(classes, F.col("b") == F.col("node")).select("content", "other"))


def similar_links(classes: DataFrame, docs: DataFrame, words: int, seed: int, similarity: float, max_bits: int = 4) -> DataFrame:
    """Links (``a``, ``b``: class ids) that span all pairs of classes which meet by fingerprint or by a key and share at least
    ``similarity`` of the shingles of both, counted on the whole sets.

    First every class meets those that its fingerprint links it to, and the first one of each of its keys, in joins that send
    one thin row a key and class: this links a tight group whatever its size. Keys whose members then are of one component
    are done. Of the others, short sets are compared in their key's task, which gives spanning links only. Long ones are
    compared there by 16 bits of every shingle's hash; the pairs that span what these let through are joined with both sets
    and counted. After that, pairs between components that are still apart come once each, all of them close below the similarity, and are counted.
    """
    many = max(partitions(classes), 32)
    classes = written(classes, "classes")
    keyed = classes.select("node", "content", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("_last")).filter("first < _last").drop("_last")
    rows = written(keyed.join(shared, "key"), "meetings")

    def judged(batches):
        for batch in slices(batches, 1 << 13):
            n, other_n = (batch.column(c).to_numpy() for c in ("n", "other_n"))
            short = batch.column("short").is_valid().to_numpy(zero_copy_only=False) & batch.column("other_short").is_valid().to_numpy(zero_copy_only=False)
            keep = np.zeros(batch.num_rows, bool)
            at = np.flatnonzero(short)
            if len(at):
                members, size = padded(pa.concat_arrays([batch.column(c).take(pa.array(at)) for c in ("short", "other_short")]))
                keep[at] = alike(members, size, np.arange(len(at)), np.arange(len(at)) + len(at), similarity)
            at = np.flatnonzero(~short & batch.column("marks").is_valid().to_numpy(zero_copy_only=False) & batch.column("other_marks").is_valid().to_numpy(zero_copy_only=False))
            if len(at):
                x, y = (np.frombuffer(b"".join(batch.column(c).take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), -1) for c in ("marks", "other_marks"))
                keep[at] = may_link(np.concatenate([n[at], other_n[at]]), np.concatenate([x, y]), np.arange(len(at)), np.arange(len(at)) + len(at), similarity)
            out = batch.select(["node", "content", "other", "other_content"]).append_column("sure", pa.array(short))
            yield out.filter(pa.array(keep))

    told = ["n", "short", "marks"]
    firsts = classes.select(F.col("node").alias("other"), F.col("content").alias("other_content"), *[F.col(c).alias(f"other_{c}") for c in told])
    pairs = rows.filter("node != first").select("content", F.col("first").alias("other")).unionAll(print_pairs(classes, max_bits)).distinct()
    pairs = pairs.join(firsts, "other").join(classes.select("node", "content", *told), "content")
    pairs = pairs.filter((F.least("n", "other_n") >= similarity * F.greatest("n", "other_n") - 1e-9))
    pairs = written(pairs.mapInArrow(judged, "node long, content binary, other long, other_content binary, sure boolean"), "pairs")
    sure, unsure = pairs.filter("sure").select(F.col("node").alias("a"), F.col("other").alias("b")), pairs.filter("not sure").drop("sure")
    members = unsure.select("content", "node").unionAll(unsure.select("other_content", "other")).distinct()
    found = sure.unionAll(written(verified(unsure, shingle_sets(docs, members, words, seed), similarity), "links"))
    rows = written(still_open(rows.drop("first"), found), "open")

    def compare_short(batches):
        whole = met(batches)
        if whole is None:
            return
        members, n = padded(whole.column("short").combine_chunks())
        node = whole.column("node").to_numpy()
        a, b = short_links(whole.column("key").to_numpy(), members, n, whole.column("label").to_numpy(), similarity)
        yield pa.RecordBatch.from_arrays([pa.array(node[a], pa.int64()), pa.array(node[b], pa.int64())], names=["a", "b"])

    odd = F.col("key").bitwiseAND(F.lit(1)) == 1
    short = rows.filter(~odd).join(classes.select("content", "short"), "content").select("node", "key", "label", "short")
    found = found.unionAll(written(short.repartition(many, "key").mapInArrow(compare_short, "a long, b long"), "links"))

    rows = rows.filter(odd)
    if not rows.limit(1).count():
        return found
    sets = written(shingle_sets(docs, rows.select("content", "node").distinct(), words, seed), "sets")
    bits = F.transform("shingles", lambda x: F.shiftright(x, 48).cast("short"))
    bodies = classes.join(sets, "content").select("content", "n", "keys", bits.alias("body"))

    def compare_long(every):
        def run(batches):
            whole = met(batches)
            if whole is None:
                return
            key, label = whole.column("tile").to_numpy(), whole.column("label").to_numpy()
            _, place, count = np.unique(np.stack([key, label]), axis=1, return_inverse=True, return_counts=True)
            whole = whole.take(pa.array(np.lexsort((label, count[place.ravel()], key))))  # a run's largest component comes last
            tile, key, n, label, node = (whole.column(c).to_numpy() for c in ("tile", "key", "n", "label", "node"))
            body, own = whole.column("body").combine_chunks(), None
            ends = body.offsets.to_numpy().astype(np.int64)
            values = body.values.to_numpy().view(np.uint16)
            if every:
                own = np.full((len(key), BANDS), np.iinfo(np.int64).max)
                for i, k in enumerate(whole.column("keys").to_pylist()):
                    k = [x for x in k if x & 1]
                    own[i, :len(k)] = k
            a, b = long_pairs(tile, values, ends, n, label, similarity, own, key)
            content = whole.column("content")
            for start in range(0, len(a), 1 << 16):
                x, y = a[start:start + (1 << 16)], b[start:start + (1 << 16)]
                columns = [pa.array(node[x]), content.take(pa.array(x)), pa.array(node[y]), content.take(pa.array(y))]
                yield from pa.table(columns, names=["node", "content", "other", "other_content"]).to_batches()
        return run

    # First what spans the pairs that the bits let through; then those between components that are still apart.
    for every in (False, True):
        met_rows = tiles(rows).join(bodies, "content").repartition(many, "tile")
        pairs = met_rows.mapInArrow(compare_long(every), "node long, content binary, other long, other_content binary")
        pairs = written(pairs.dropDuplicates(["content", "other_content"]), "pairs")
        found = found.unionAll(written(verified(pairs, sets, similarity), "links"))
        if not every:
            rows = written(still_open(rows, found), "open")
    return found


def described(docs: DataFrame, words: int, seed: int, similarity: float) -> DataFrame:
    """``doc_id``, ``fingerprint`` and what ``similar_links`` needs of ``doc_id`` and ``text`` rows."""
    names = ["doc_id", "fingerprint", "content", "n", "keys", "short", "marks"]

    def run(batches):
        for batch in slices(batches):
            prints, contents, sizes, keys, shorts, marks = [], [], [], [], [], []
            for text in texts(batch):
                hashes = shingle_hashes(text, words, seed)
                prints.append(majority(hashes))
                hashes = np.unique(hashes)
                contents.append(content(hashes))
                sizes.append(len(hashes))
                own = meeting_keys(hashes, similarity)
                keys.append(own[0].view(np.int64))
                shorts.append(own[1])
                marks.append(own[2])
            columns = [batch.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(contents, pa.binary()), pa.array(sizes, pa.int64()),
                       pa.array(keys, pa.list_(pa.int64())), pa.array(shorts, pa.list_(pa.int64())), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint long, content binary, n long, keys array<long>, short array<long>, marks binary")


def near_groups(docs: DataFrame, words: int = 4, max_bits: int = 4, similarity: float | None = None, id: str = "doc_id",
                text: str = "text", seed: int = 42) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 lowercase hex digits) and ``component_id``, the smallest doc_id of its group.

    Shingles are runs of ``words`` words over whole texts. Without ``similarity`` two fingerprints link at ``max_bits`` or
    fewer differing bits. With it, such links are checked, and hold if the two texts share at least that part of the distinct
    shingles of both (their exact Jaccard similarity); so do texts with other fingerprints that ``meeting_keys`` bring together.
    Equal fingerprints, or equal sets of
    shingles, fall together before anything is compared.

    Null and empty texts have fingerprint zero and link like any other; so do texts of a few words. A null doc_id is
    grouped but never names a group. Rows that repeat a doc_id come back as often. An empty table gives no rows. Other
    columns are not read.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    if similarity is None:
        same, prints = "fingerprint", written(fingerprints(rows, words, seed), "fingerprints")
        classes = prints.groupBy(same).agg(F.min("doc_id").alias("node"))
        found = links(classes.filter("node is not null"), max_bits)
    else:
        same, prints = "content", written(described(rows, words, seed, similarity), "fingerprints")
        firsts = [F.first(c).alias(c) for c in ("n", "keys", "short", "marks")]  # the same in all rows of one content
        # Fingerprints of one set differ where shingles repeat: any one will do, but always the same.
        classes = prints.groupBy(same).agg(F.min("doc_id").alias("node"), F.min("fingerprint").alias("fingerprint"), *firsts)
        found = similar_links(classes.filter("node is not null"), rows, words, seed, similarity, max_bits)
    grouped = components(found)
    named = classes.join(grouped, "node", "left").select(same, F.coalesce("component", "node").alias("component_id"))
    out = prints.join(named, same)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each group of near copies left, the one with the smallest doc_id; all columns stay.

    Documents with a null doc_id stay; of rows that repeat the kept doc_id all stay.
    """
    kept = near_groups(docs, words, similarity=similarity, id=id, text=text).filter("doc_id = component_id").select("doc_id").distinct()
    column = F.col(f"`{id}`").cast("long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"), column.alias("doc_id"))
    found = rows.join(kept.withColumn("_kept", F.lit(True)), "doc_id", "left").filter("_kept or doc_id is null")
    return found.select("rest.*")

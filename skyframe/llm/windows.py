"""Substring dedup by level-wise doubling: only windows that repeat at one length are extended to twice that length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import packed, partitions, schema_of, slices, texts, unpacked

FLUSH = 1 << 21  # windows that a task compares among themselves before it sends what is left
ASK, KNOWN = 0, 1
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def doubled(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of windows of twice ``length`` from those of ``length``, by start; the last ``length`` have no meaning."""
    out = h * M1
    out[:-length] += (h[length:] ^ (h[length:] >> np.uint64(31))) * M2
    return out ^ (out >> np.uint64(29))


def level_hashes(words: np.ndarray, length: int, doublings: int) -> list[np.ndarray]:
    """Window hashes at ``length``, ``2 length``, ... by start: the shortest by their words, each next by its two halves."""
    h = words.copy()
    for i in range(1, length):
        h[:-i] = (h[:-i] * M1 ^ (h[:-i] >> np.uint64(32))) + words[i:] * M2
    out = [h ^ (h >> np.uint64(29))]
    for i in range(doublings):
        out.append(doubled(out[-1], length << i))
    return out


def sliding_least(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first and of the last least value of every ``n`` neighbours, by the first one's place (the last
    ``n - 1`` have no meaning)."""
    first, last, have = np.arange(len(h)), np.arange(len(h)), 1
    while have < n:
        step = min(have, n - have)
        a, b = first[:-step], first[step:]
        first[:-step] = np.where(h[b] < h[a], b, a)
        a, b = last[:-step], last[step:]
        last[:-step] = np.where(h[b] <= h[a], b, a)
        have += step
    return first, last


def runs_of(doc: np.ndarray, pos: np.ndarray, *same: np.ndarray) -> np.ndarray:
    """First index of every run of neighbouring windows of one document that agree in the ``same`` arrays."""
    if not len(doc):
        return np.zeros(0, np.int64)
    new = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1)
    for x in same:
        new |= x[1:] != x[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def blob_rows(target: np.ndarray, kind: int, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """One row per target with the packed values of its entries."""
    order = np.argsort(target, kind="stable")
    target = target[order]
    first = np.concatenate([[0], np.flatnonzero(target[1:] != target[:-1]) + 1]) if len(target) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(target))
    sorted_columns = [c[order] for c in columns]
    blobs = [pa.array([c[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()) for c in sorted_columns]
    return pa.RecordBatch.from_arrays([pa.array(target[first], pa.int32()), pa.array([kind] * len(first), pa.int32()), *blobs], names=["r", "kind", *names])


class Words:
    """Words of a slice of documents in one array of hashes, with every word's document and place."""

    def __init__(self, ids: list[int | None], contents: list[bytes]):
        split = [c.split() if i is not None else [] for i, c in zip(ids, contents)]
        self.sizes = np.array([len(w) for w in split], np.int64)
        self.hashes = word_hashes([w for words in split for w in words])
        self.ends = np.cumsum(self.sizes)
        self.row = np.repeat(np.arange(len(ids)), self.sizes)
        self.pos = np.arange(len(self.hashes)) - np.repeat(self.ends - self.sizes, self.sizes)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)

    def starts(self, length: int) -> np.ndarray:
        """Indices at which a window of ``length`` words of one document starts."""
        return np.flatnonzero(self.pos + length <= np.repeat(self.sizes, self.sizes))


def ask_repeated(docs: DataFrame, window: int, length: int, n: int) -> DataFrame:
    """Level 1: which windows of ``window`` words have an anchor that repeats. ``doc_id``, ``pos``, ``n``: runs of starts.

    The anchor of a window is the least hash among its sub-windows of ``length`` words; equal windows have equal anchors,
    and neighbours mostly share theirs, so a run of windows asks once. A task compares its own runs first: an anchor that
    it sees twice is known to repeat, and one witness of it is enough for the others, so a passage that a third of all
    documents hold sends a few rows per task.
    """
    names = ["doc", "pos", "n", "anchor"]

    def ask(batches):
        held = []

        def flush():
            doc, pos, count, anchor, twice = (np.concatenate(x) for x in zip(*held))
            held.clear()
            _, first, index = np.unique(anchor, return_index=True, return_inverse=True)
            seen = np.bincount(index, weights=1 + twice)
            repeated = seen[index] > 1
            known = np.flatnonzero(repeated)
            if len(known):
                yield blob_rows(doc[known] % n, KNOWN, [doc[known], pos[known], count[known], anchor[known]], names)
                witness = first[seen > 1]
                # A witness asks twice with no windows, so whoever else has the anchor finds it repeated.
                both = np.repeat(witness, 2)
                yield blob_rows((anchor[both] % np.uint64(n)).astype(np.int64), ASK, [doc[both], pos[both], np.zeros(len(both), np.int32), anchor[both]], names)
            alone = np.flatnonzero(~repeated)
            if len(alone):
                yield blob_rows((anchor[alone] % np.uint64(n)).astype(np.int64), ASK, [doc[alone], pos[alone], count[alone], anchor[alone]], names)

        size = 0
        for batch in slices(batches):
            words = Words(batch.column("doc_id").to_pylist(), texts(batch))
            at = words.starts(window)
            if not len(at):
                continue
            h = level_hashes(words.hashes, length, 0)[0]
            least, last = (x[at] for x in sliding_least(h, window - length + 1))
            # A run shares one place of its anchor; a window that holds the anchor at two places has found it repeated.
            first = runs_of(words.row[at], words.pos[at], least)
            count = np.diff(np.append(first, len(at)))
            twice = np.maximum.reduceat(least != last, first)
            held.append((words.ids[words.row[at[first]]], words.pos[at[first]].astype(np.int32), count.astype(np.int32), h[least[first]], twice))
            size += len(at)
            if size >= FLUSH:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    def answer(batches):
        asks, out = [], []
        for batch in batches:
            for row in batch.to_pylist():
                part = [np.frombuffer(row[c], t) for c, t in zip(names, (np.int64, np.int32, np.int32, np.uint64))]
                (asks if row["kind"] == ASK else out).append(part)
        if asks:
            parts = [np.concatenate(x) for x in zip(*asks)]
            _, index, seen = np.unique(parts[3], return_inverse=True, return_counts=True)
            keep = (seen[index] > 1) & (parts[2] > 0)
            out.append([p[keep] for p in parts])
        for doc, pos, count, _ in out:
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(pos), pa.array(count)], names=["doc_id", "pos", "n"])

    kind = "r int, kind int, " + ", ".join(f"{c} binary" for c in names)
    return docs.mapInArrow(ask, kind).repartition(n, "r").mapInArrow(answer, "doc_id long, pos int, n int")


def spread(runs: list[dict] | None) -> np.ndarray:
    """Starts of all windows of the runs, in order."""
    if not runs:
        return np.zeros(0, np.int64)
    pos, n = np.array([r["pos"] for r in runs], np.int64), np.array([r["n"] for r in runs], np.int64)
    order = np.argsort(pos)
    pos, n = pos[order], n[order]
    return np.unique(np.repeat(pos - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()))


def later_windows(joined: DataFrame, window: int, length: int, doublings: int, n: int) -> DataFrame:
    """Last level: of the surviving windows, extended to ``window`` words, those that also start earlier.

    ``joined`` has ``doc_id``, ``text`` and the ``runs`` of survivors, if any. A task finds the first of its own equal windows and sends
    only that; of those sent for one window the first by document and start stays. ``doc_id``, ``pos``, ``n``.
    """
    names = ["doc", "pos", "n", "anchor", "h"]

    def entries(doc, pos, anchor, h, kind):
        """Packed runs; the windows' own hashes lie behind each other in the order of the runs."""
        order = np.lexsort((pos, doc))
        doc, pos, anchor, h = doc[order], pos[order], anchor[order], h[order]
        first = runs_of(doc, pos, anchor)
        count = np.diff(np.append(first, len(doc)))
        target = (anchor[first] % np.uint64(n)).astype(np.int64) if kind == ASK else doc[first] % n
        by = np.argsort(target, kind="stable")
        place = np.argsort(np.repeat(target, count), kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(target[by])) + 1, [len(by)]])
        upto = np.concatenate([[0], np.cumsum(count[by])])
        rows = [(int(target[by[a]]), kind, doc[first[by[a:b]]].tobytes(), pos[first[by[a:b]]].astype(np.int32).tobytes(), count[by[a:b]].astype(np.int32).tobytes(),
                 anchor[first[by[a:b]]].tobytes(), h[place[upto[a]:upto[b]]].tobytes() if kind == ASK else b"") for a, b in zip(cuts[:-1], cuts[1:])]
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["r", "kind", *names])

    def ask(batches):
        held, size = [], 0

        def flush():
            doc, pos, anchor, h = (np.concatenate(x) for x in zip(*held))
            held.clear()
            later = repeats(doc, pos, anchor, h)
            if later.any():
                yield entries(doc[later], pos[later], anchor[later], h[later], KNOWN)
            yield entries(doc[~later], pos[~later], anchor[~later], h[~later], ASK)

        for batch in slices(batches):
            runs = batch.column("runs").to_pylist()
            words = Words([i if r else None for i, r in zip(batch.column("doc_id").to_pylist(), runs)], texts(batch))
            begin = words.ends - words.sizes
            starts = [spread(r) for r in runs]
            # Of rows that repeat a doc_id each has only the windows that its own text is long enough for.
            at = np.concatenate([b + s[s + window <= n_words] for b, s, n_words in zip(begin, starts, words.sizes)] or [np.zeros(0)]).astype(np.int64)
            if not len(at):
                continue
            levels = level_hashes(words.hashes, length, doublings)
            anchor = levels[0][sliding_least(levels[0], window - length + 1)[0][at]]
            held.append((words.ids[words.row[at]], words.pos[at], anchor, levels[-1][at]))
            size += len(at)
            if size >= FLUSH:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    def answer(batches):
        asks, out = [], []
        for batch in batches:
            for row in batch.to_pylist():
                doc, pos, count, anchor, h = (np.frombuffer(row[c], t) for c, t in zip(names, (np.int64, np.int32, np.int32, np.uint64, np.uint64)))
                if row["kind"] == KNOWN:
                    out.append((doc, pos, count))
                else:
                    inside = np.arange(count.sum()) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
                    asks.append((np.repeat(doc, count), np.repeat(pos, count) + inside, np.repeat(anchor, count), h))
        if asks:
            doc, pos, anchor, h = (np.concatenate(x) for x in zip(*asks))
            asks.clear()
            later = repeats(doc, pos, anchor, h)
            doc, pos = doc[later], pos[later]
            order = np.lexsort((pos, doc))
            doc, pos = doc[order], pos[order]
            first = runs_of(doc, pos)
            out.append((doc[first], pos[first].astype(np.int32), np.diff(np.append(first, len(doc))).astype(np.int32)))
        for doc, pos, count in out:
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(pos), pa.array(count)], names=["doc_id", "pos", "n"])

    kind = "r int, kind int, " + ", ".join(f"{c} binary" for c in names)
    return joined.mapInArrow(ask, kind).repartition(n, "r").mapInArrow(answer, "doc_id long, pos int, n int")


def repeats(doc: np.ndarray, pos: np.ndarray, anchor: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which windows have an equal one (same hash, same anchor) that starts earlier, by document and place."""
    out = np.zeros(len(h), bool)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    some = np.zeros(len(h), bool)
    some[:-1] |= same
    some[1:] |= same
    rest = order[some]
    rest = rest[np.lexsort((pos[rest], doc[rest], anchor[rest], h[rest]))]
    new = np.ones(len(rest), bool)
    new[1:] = (h[rest][1:] != h[rest][:-1]) | (anchor[rest][1:] != anchor[rest][:-1])
    first = rest[np.maximum.accumulate(np.where(new, np.arange(len(rest)), 0))] if len(rest) else rest
    out[rest] = (doc[rest] != doc[first]) | (pos[rest] != pos[first])
    return out


def without_repeated_windows(docs: DataFrame, window: int = 20, shortest: int = 10, id: str = "doc_id", text: str = "text", raw: bool = False) -> DataFrame:
    """The documents without the words of every ``window``-word window that also starts earlier: in a document with a
    smaller doc_id, or earlier in the same one. Windows are those of the input; kept words are joined by one space.

    ``window`` is ``shortest`` times a power of two. At the shortest level windows are asked for by hash; those that repeat
    are extended to twice the length by joining the hashes of their halves, and so on, up to ``window``; all others are
    dropped from the search where they stop repeating. Two 64-bit hashes, of the window and of its anchor, must agree.

    Null and empty texts have no words and come back empty. A document without a doc_id has no place in the order: it loses
    nothing and removes nothing. Rows that repeat a doc_id are one document, so neither removes the other's windows at the
    same place. Texts of any length are taken whole. All columns stay; with ``raw`` they are ``doc_id``, ``rest`` (a struct
    of the other columns), ``kept``, ``n_words`` and ``n_removed``.
    """
    doublings = (window // shortest).bit_length() - 1
    if shortest << doublings != window:
        raise ValueError("The window must be the shortest one times a power of two")
    n = 2 * partitions(docs)
    rows = packed(docs, text, id)
    place = F.collect_list(F.struct("pos", "n"))  # bounded by the document's own words
    runs = ask_repeated(rows.select("doc_id", "text"), window, shortest, n).groupBy("doc_id").agg(place.alias("runs"))
    # Both joins take the same columns and keep all rows, so that one shuffle of the texts serves them both.
    later = later_windows(rows.join(runs, "doc_id", "left"), window, shortest, doublings, n)
    lost = later.groupBy("doc_id").agg(place.alias("_lost"))
    joined = rows.join(lost, "doc_id", "left")

    def drop(batches):
        for batch in slices(batches):
            kept, sizes, removed = [], [], []
            for content, lost in zip(texts(batch), batch.column("_lost").to_pylist()):
                words = content.split()
                if lost:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, [min(len(words), r["pos"]) for r in lost], 1)
                    np.add.at(change, [min(len(words), r["pos"] + r["n"] + window - 1) for r in lost], -1)
                    left = [w for w, x in zip(words, np.cumsum(change[:-1]).tolist()) if not x]
                else:
                    left = words
                sizes.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rest"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())],
                names=["doc_id", "rest", "kept", "n_words", "n_removed"])

    out = joined.mapInArrow(drop, schema_of(joined.select("doc_id", "rest"), kept="string", n_words="long", n_removed="long"))
    return out if raw else unpacked(out, docs, text, "kept")

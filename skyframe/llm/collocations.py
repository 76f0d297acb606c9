"""Phrase collocations: n-gram counts in weighted acyclic automata, summed by prefix range and composed with each other.

A first pass finds, by counts of hashed n-grams, which can be frequent at all; its errors only let more through. The second
builds, for every shard, count transducers of those from the sorted n-grams. Transducers are cut by prefix range, those of a
range are united by summing weights, and parts of candidates are looked up by composing a transducer of questions with the
one that holds the counts. No table of words or n-grams is broadcast or collected; a hot word's phrases spread over ranges.
"""

from __future__ import annotations

import itertools
import math
from array import array
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.common import partitions, shares, slices
from skyframe.session import written

FLUSH = 1 << 19  # words whose n-grams a task counts at a time
HELD = 1 << 22  # n-grams of a shard that a task holds at a time, 24 bytes each
CHUNK = 1024  # n-grams of one transducer of a shard
SHOWN = 64  # bytes of a word that a bound of ranges keeps
ROOM = 16  # cells of the first pass for every n-gram
BREAK = 0  # the word id between pieces
#: A-Z to lower case, ends of pieces to a full stop, tabs to spaces.
TABLE = bytes(46 if chr(i) in ".,;:!?\n\v\f\r" else 32 if i == 9 else i + 32 if 65 <= i <= 90 else i for i in range(256))
PARTS = "labels array<binary>, weights binary, starts binary, arcs binary"
PARTS_SCHEMA = [("labels", pa.list_(pa.binary())), ("weights", pa.binary()), ("starts", pa.binary()), ("arcs", pa.binary())]


class Automaton:
    """A minimal acyclic automaton over words with a weight at every state: the count of the path that ends there.

    Paths are added in order. States off the path that is being extended are final; equal ones (same weight, same arcs)
    are one state.
    """

    def __init__(self):
        self.weights: list[int] = []
        self.arcs: list[tuple[tuple[bytes, int], ...]] = []
        self.register: dict[tuple, int] = {}
        self.open: list[list] = [[None, 0, []]]
        self.path: tuple[bytes, ...] = ()
        self.root: int | None = None

    def state(self, weight: int, arcs: tuple) -> int:
        known = self.register.get((weight, arcs))
        if known is None:
            known = self.register[weight, arcs] = len(self.weights)
            self.weights.append(weight)
            self.arcs.append(arcs)
        return known

    def _close(self, depth: int) -> None:
        while len(self.open) > depth + 1:
            label, weight, arcs = self.open.pop()
            self.open[-1][2].append((label, self.state(weight, tuple(arcs))))

    def add(self, path: tuple[bytes, ...], weight: int) -> None:
        same = 0
        for a, b in zip(self.path, path):
            if a != b:
                break
            same += 1
        self._close(same)
        self.open += [[label, 0, []] for label in path[same:]]
        self.open[-1][1] += weight
        self.path = path

    def done(self) -> Automaton:
        self._close(0)
        self.root = self.state(self.open[0][1], tuple(self.open[0][2]))
        return self

    def paths(self, state: int | None = None, before: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int]]:
        """Every path of a weight, in order."""
        state = self.root if state is None else state
        if self.weights[state]:
            yield before, self.weights[state]
        for label, then in self.arcs[state]:
            yield from self.paths(then, (*before, label))

    def parts(self) -> tuple:
        """The columns of a row that holds it."""
        labels = {label: i for i, label in enumerate(dict.fromkeys(label for arcs in self.arcs for label, _ in arcs))}
        flat = [x for arcs in self.arcs for label, then in arcs for x in (labels[label], then)]
        starts = np.cumsum([0, *map(len, self.arcs)])
        return list(labels), np.array(self.weights, "<i8").tobytes(), starts.astype("<i4").tobytes(), np.array(flat, "<i4").tobytes()

    @classmethod
    def of(cls, row: dict) -> Automaton:
        out, labels = cls(), row["labels"]
        out.weights = np.frombuffer(row["weights"], "<i8").tolist()
        arcs = [(labels[a], b) for a, b in np.frombuffer(row["arcs"], "<i4").reshape(-1, 2).tolist()]
        starts = np.frombuffer(row["starts"], "<i4").tolist()
        out.arcs = [tuple(arcs[a:b]) for a, b in zip(starts[:-1], starts[1:])]
        out.root = len(out.weights) - 1  # a state comes after all that it leads to
        return out

    @classmethod
    def from_sorted(cls, items: Iterable[tuple[tuple[bytes, ...], int]]) -> Automaton:
        out = cls()
        for path, weight in items:
            out.add(path, weight)
        return out.done()


def by_rows(grams: np.ndarray) -> np.ndarray:
    """The order of rows of numbers from 0, column by column."""
    bits = int(grams.max(initial=0)).bit_length() or 1
    keys, room = [], 0
    for column in grams.T:
        if room < bits:
            keys.append(np.zeros(len(grams), np.int64))
            room = 63
        keys[-1] = keys[-1] << bits | column
        room -= bits
    return np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")


def summed_rows(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order and the sums of their counts."""
    order = by_rows(grams)
    grams = grams[order]
    first = np.flatnonzero(np.append(True, (grams[1:] != grams[:-1]).any(axis=1))) if len(grams) else np.zeros(0, np.int64)
    return grams[first], np.add.reduceat(counts[order], first) if len(first) else counts


def automata_of(labels: list[bytes], grams: np.ndarray, counts: np.ndarray, size: int) -> Iterator[tuple]:
    """Of every ``size`` paths the columns of the row that holds their minimal automaton, as ``Automaton.from_sorted`` makes it.

    Paths are distinct rows in order: places in ``labels`` from 1, then noughts. All automata are made in one go: nodes of their
    tries depth by depth, states from the lowest nodes to the roots. Nodes that hashes take for equal are compared; where one
    is not, the nodes of that height stay states of their own.
    """
    n, depth = grams.shape
    if not n:
        return
    length = (grams > 0).sum(axis=1)
    differs = np.ones((n, depth), bool)
    differs[1:] = grams[1:] != grams[:-1]
    differs[::size] = True
    first = differs.argmax(axis=1)
    begins = np.arange(n) % size == 0
    trees = int(begins.sum())
    levels = [(np.zeros(trees, np.int64), np.zeros(trees, np.int64), np.zeros(trees, np.int64), np.arange(trees))]
    above, base = np.cumsum(begins) - 1, trees
    for d in range(1, depth + 1):
        new = (first < d) & (length >= d)
        at = np.flatnonzero(new)
        levels.append((above[at], grams[at, d - 1].astype(np.int64), np.where(length[at] == d, counts[at], 0), at // size))
        above, base = base + np.cumsum(new) - 1, base + len(at)
    ends = np.cumsum([len(x[0]) for x in levels])
    parent, label, weight, tree = (np.concatenate(x) for x in zip(*levels))
    kids = np.bincount(parent[trees:], minlength=base)
    start = trees + np.cumsum(kids) - kids  # the nodes below a node lie side by side
    height = np.zeros(base, np.int64)
    for a, b in zip(ends[-2::-1], ends[:0:-1]):
        np.maximum.at(height, parent[a:b], height[a:b] + 1)

    def below(nodes):
        """Nodes below the given ones, and where each one's begin in them."""
        many = kids[nodes]
        begin = np.cumsum(many) - many
        return np.repeat(start[nodes] - begin, many) + np.arange(many.sum()), begin

    state, kept, made = np.zeros(base, np.int64), [], 0
    for h in range(int(height.max()) + 1):
        nodes = np.flatnonzero(height == h)
        key = mixed(chained(mixed(weight[nodes].astype(np.uint64) + np.uint64(h)), tree[nodes].astype(np.uint64)))
        if h:
            arcs, begin = below(nodes)
            key += np.add.reduceat(mixed(chained(mixed(label[arcs].astype(np.uint64)), state[arcs].astype(np.uint64))), begin)
        _, index, of = np.unique(key, return_index=True, return_inverse=True)
        like = nodes[index[of]]
        same = (weight[nodes] == weight[like]) & (tree[nodes] == tree[like]) & (kids[nodes] == kids[like])
        if h and same.all():
            others = below(like)[0]
            same = (label[arcs] == label[others]) & (state[arcs] == state[others])
        if not same.all():
            index = of = np.arange(len(nodes))
        state[nodes] = made + of
        kept.append(nodes[index])
        made += len(index)
    kept = np.concatenate(kept)
    order = np.argsort(tree[kept], kind="stable")  # by height within a tree: a state comes after all that it leads to
    kept = kept[order]
    cuts = np.searchsorted(tree[kept], np.arange(trees + 1))
    place = np.empty(made, np.int64)
    place[order] = np.arange(made) - cuts[tree[kept]]
    arcs, begin = below(kept)
    weights, begin = weight[kept].astype("<i8"), np.append(begin, len(arcs))
    for a, b in zip(cuts[:-1], cuts[1:]):
        some = arcs[begin[a]:begin[b]]
        used, own = np.unique(label[some], return_inverse=True)
        flat = np.stack([own, place[state[some]]], axis=1).astype("<i4")
        yield [labels[i - 1] for i in used.tolist()], weights[a:b].tobytes(), (begin[a:b + 1] - begin[a]).astype("<i4").tobytes(), flat.tobytes()


def paths_of(rows: list[dict]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Labels in order, and of the paths of all these rows' automata the labels' places from 1 and the weights."""
    known = sorted({x for r in rows for x in r["labels"]})
    number = {x: i for i, x in enumerate(known, 1)}
    label, to, weights, starts, roots = [], [], [], [], []
    at = arcs = 0
    for r in rows:
        own, flat = np.array([number[x] for x in r["labels"]], np.int32), np.frombuffer(r["arcs"], "<i4").reshape(-1, 2)
        label.append(own[flat[:, 0]] if len(flat) else own[:0])
        to.append(flat[:, 1].astype(np.int64) + at)
        weights.append(np.frombuffer(r["weights"], "<i8"))
        starts.append(np.frombuffer(r["starts"], "<i4")[:-1].astype(np.int64) + arcs)
        at, arcs = at + len(weights[-1]), arcs + len(flat)
        roots.append(at - 1)
    label, to, weights, starts = map(np.concatenate, (label, to, weights, starts))
    many = np.diff(np.append(starts, arcs))
    found, states, path = [], np.array(roots), np.zeros((len(roots), 0), np.int32)
    while len(states):
        good = weights[states] > 0
        found.append((path[good], weights[states[good]]))
        n = many[states]
        some = np.repeat(starts[states] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        path, states = np.column_stack([np.repeat(path, n, axis=0), label[some]]), to[some]
    grams = np.zeros((sum(len(p) for p, _ in found), max(1, len(found) - 1)), np.int32)
    a = 0
    for p, _ in found:
        grams[a:a + len(p), :p.shape[1]] = p
        a += len(p)
    return known, grams, np.concatenate([w for _, w in found])


class Paths(Sequence):
    """Rows of labels' places from 1, read as paths."""

    def __init__(self, labels: list[bytes], grams: np.ndarray):
        self.labels, self.grams = labels, grams

    def __len__(self) -> int:
        return len(self.grams)

    def __getitem__(self, i: int) -> tuple[bytes, ...]:
        return tuple(self.labels[x - 1] for x in self.grams[i].tolist() if x)


def united(automata: list[Automaton], least: int = 1) -> Automaton:
    """The automaton of all paths with summed weights, without those below ``least``."""
    out = Automaton()

    def merge(at: list[tuple[Automaton, int]]) -> int | None:
        weight, arcs = sum(a.weights[s] for a, s in at), {}
        for a, s in at:
            for label, then in a.arcs[s]:
                arcs.setdefault(label, []).append((a, then))
        kept = tuple((label, then) for label in sorted(arcs) if (then := merge(arcs[label])) is not None)
        weight = weight if weight >= least else 0
        return out.state(weight, kept) if weight or kept else None

    root = merge([(a, a.root) for a in automata])
    out.root = out.state(0, ()) if root is None else root
    return out


def composed(questions: Automaton, counts: Automaton) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """Every path of both, in order: its weight as a question and its count."""
    def walk(q, c, path):
        if questions.weights[q] and counts.weights[c]:
            yield path, questions.weights[q], counts.weights[c]
        if questions.arcs[q]:
            known = dict(counts.arcs[c])
            for label, then in questions.arcs[q]:
                if label in known:
                    yield from walk(then, known[label], (*path, label))

    return walk(questions.root, counts.root, ())


def chained(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram and one more word."""
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word


def mixed(h: np.ndarray) -> np.ndarray:
    """The hash with all bits alike, so that its upper ones make a cell."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Flush:
    """Words of some documents as ids, with breaks between pieces."""

    def __init__(self):
        self.next = itertools.count(BREAK + 1).__next__  # all languages share the ids
        self.words: dict[bytes, defaultdict] = {}
        self.ids = array("q", [BREAK])

    def add(self, lang: bytes, text: bytes) -> None:
        words = self.words.get(lang)
        if words is None:
            words = self.words[lang] = defaultdict(self.next, {b".": BREAK})
        self.ids.extend(map(words.__getitem__, text.translate(TABLE).replace(b".", b" . ").split()))
        self.ids.append(BREAK)

    def by_language(self) -> Iterator[tuple[bytes, list[bytes], np.ndarray]]:
        """Words of every language and their ids, without the break."""
        for lang, words in self.words.items():
            yield lang, list(itertools.islice(words, 1, None)), np.fromiter(itertools.islice(words.values(), 1, None), np.int64, len(words) - 1)

    def size(self) -> int:
        return 1 + sum(len(words) - 1 for words in self.words.values())

    def hashes(self) -> np.ndarray:
        out = np.zeros(self.size(), np.uint64)
        for lang, words, ids in self.by_language():
            out[ids] = np.fromiter(map(xxhash.xxh64_intdigest, words, itertools.repeat(xxhash.xxh64_intdigest(lang))), np.uint64, len(words))
        return out

    def grams(self, most: int) -> Iterator[np.ndarray]:
        """For 1 to ``most`` words: hashes of all n-grams."""
        ids = np.array(self.ids, np.int64)
        word = self.hashes()[ids]
        whole, h = ids != BREAK, word
        for m in range(1, most + 1):
            if m > 1:
                whole = whole[:-1] & (ids[m - 1:] != BREAK)
                h = chained(h[:-1], word[m - 1:])
            yield mixed(h[whole])


def narrow(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def wide(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def packed_cells(cells: np.ndarray) -> bytes:
    """Rising cells, one at least, as the first one and steps of as few bytes as the longest needs."""
    steps = np.diff(cells)
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + int(cells[0]).to_bytes(8, "little") + narrow(steps, width)


def cells_of(data: bytes) -> np.ndarray:
    steps = wide(data[9:], data[0])
    return np.cumsum(np.append(np.uint64(int.from_bytes(data[1:9], "little")), steps), dtype=np.uint64)


def maybe_frequent(docs: DataFrame, most: int, least: int, width: int, n: int, words: int = FLUSH) -> DataFrame:
    """``shard``, ``cells``: hashes of ``width`` bytes (as ``packed_cells``) whose counts over all shards reach ``least``, for every shard that has them."""
    shift, small = np.uint64(64 - 8 * width), np.min_scalar_type(least)

    def ask(batches):
        flush, shard = Flush(), None

        def rows():
            cells, counts = np.unique(np.concatenate([h >> shift for h in flush.grams(most)]), return_counts=True)
            counts = np.minimum(counts, least).astype(small)
            # The cells are in order, so those of a bucket lie side by side.
            for a, b in shares((cells >> np.uint64(8 * width - 16)).astype(np.int64) * n >> 16):
                bucket = int(cells[a] >> np.uint64(8 * width - 16)) * n >> 16
                yield bucket, shard, packed_cells(cells[a:b]), counts[a:b].tobytes()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows()), kinds)], names=["bucket", "shard", "cells", "counts"])

        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        for batch in slices(batches):
            for number, lang, text in zip(*(batch.column(c).to_pylist() for c in ("shard", "lang", "body"))):
                if len(flush.ids) > 1 and (number != shard or len(flush.ids) > words):
                    yield out()
                    flush = Flush()
                shard = number
                flush.add(lang.encode(), text)
        if flush.size() > 1:
            yield out()

    def answer(batches):
        def frequent(rows):
            cells = [cells_of(r["cells"]) for r in rows]
            _, at = np.unique(np.concatenate(cells), return_inverse=True)
            sums = np.bincount(at, np.concatenate([np.frombuffer(r["counts"], small) for r in rows]))
            kept = np.split(sums[at] >= least, np.cumsum([len(c) for c in cells])[:-1])
            by = {}
            for r, c, k in zip(rows, cells, kept):
                if k.any():
                    by.setdefault(r["shard"], []).append(c[k])
            found = [(shard, packed_cells(np.unique(np.concatenate(c)))) for shard, c in by.items()]
            return pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.int32()), pa.array([c for _, c in found], pa.binary())], names=["shard", "cells"])

        held = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield frequent(held)
                    held = []
                held.append(row)
        if held:
            yield frequent(held)

    asked = docs.mapInArrow(ask, "bucket int, shard int, cells binary, counts binary")
    return asked.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(answer, "shard int, cells binary")


class Cells:
    """Given hashes, found by their first bits before they are looked for."""

    def __init__(self, cells: np.ndarray, shift: np.uint64):
        self.cells, self.shift = cells, shift
        self.down = np.uint64(max(40, 64 - max(10, len(cells).bit_length() + 4)))
        self.there = np.zeros(1 << 64 - int(self.down), bool)
        self.there[(cells << shift) >> self.down] = True

    def among(self, h: np.ndarray) -> np.ndarray:
        h = mixed(h)
        out = self.there[h >> self.down]
        at = np.flatnonzero(out)
        x = h[at] >> self.shift
        out[at] = self.cells[np.minimum(np.searchsorted(self.cells, x), len(self.cells) - 1)] == x
        return out


class Held:
    """N-grams of a shard with their counts, as numbers of words of its own list; words tell n-grams apart, not hashes."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.numbers, self.next, self.grams, self.counts, self.settled = {}, itertools.count(1).__next__, [], [], 0

    def add(self, flush: Flush, cells: Cells) -> None:
        """Add those n-grams of a flush whose cells are among the given ones."""
        if not len(cells.cells):
            return
        ids, word = np.array(flush.ids, np.int64), flush.hashes()
        size, known = len(word), cells.among(word)
        known[BREAK] = False
        own = np.zeros(size, np.int32)
        for lang, words, at in flush.by_language():
            numbers, at = self.numbers.setdefault(lang, defaultdict(self.next)), at[kept := known[at]]
            own[at] = np.fromiter(map(numbers.__getitem__, itertools.compress(words, kept)), np.int32, len(at))
        at = np.flatnonzero(known[ids])
        h, code = word[ids], ids
        for m in range(1, self.most + 1):
            if m == 1:
                every = np.bincount(ids[at], minlength=size)
                found = np.flatnonzero(every)
                inverse, count = (np.cumsum(every > 0) - 1)[ids[at]], every[found]
            else:  # both shorter n-grams in it are as frequent
                at = at[kept[at] & kept[at + 1]]
                found, inverse, count = np.unique(code[at] * size + ids[at + m - 1], return_inverse=True, return_counts=True)
                one = np.zeros(len(found), np.int64)
                one[inverse] = at
                x = chained(h[one], word[ids[one + m - 1]])
                good = cells.among(x)
                found, count, there = found[good], count[good], good[inverse]
                at, inverse = at[there], inverse[there]
                h[at] = x[inverse]
                inverse = (np.cumsum(good) - 1)[inverse]
            kept = np.zeros(len(ids) + self.most, bool)
            kept[at] = True
            rows = np.zeros((len(found), self.most), np.int32)
            if m > 1:
                rows[:, :m - 1] = before[found // size, :m - 1]
            rows[:, m - 1] = own[found % size if m > 1 else found]
            code = np.zeros(len(ids), np.int64)
            code[at] = inverse
            before = rows
            self.grams.append(rows)
            self.counts.append(count)
        if sum(map(len, self.counts)) > 2 * self.settled + (1 << 19):
            self.settle(*self.summed())

    def settle(self, grams: np.ndarray, counts: np.ndarray) -> None:
        self.grams, self.counts, self.settled = [grams], [counts], len(counts)

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams and their counts, by the numbers of their words."""
        return summed_rows(np.concatenate(self.grams), np.concatenate(self.counts))

    def drained(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """All n-grams in the order of their languages and words: labels, their places from 1 and the counts; nothing is held then."""
        if not self.counts:
            return [], np.zeros((0, self.most + 1), np.int32), np.zeros(0, np.int64)
        grams, counts = self.summed()
        langs, labels, numbers = sorted(self.numbers), [], []
        for lang in langs:
            words = sorted(self.numbers[lang])
            labels += words
            numbers += map(self.numbers[lang].__getitem__, words)
        place, lead = np.zeros((2, len(labels) + 1), np.int32)
        place[numbers] = np.arange(1, len(labels) + 1)
        lead[1:] = len(labels) + 1 + np.repeat(np.arange(len(langs)), [len(self.numbers[lang]) for lang in langs])
        self.clear()
        grams = place[grams]
        order = by_rows(grams)
        grams = grams[order]
        return labels + langs, np.column_stack([lead[grams[:, 0]], grams]), counts[order]


def shown(path: tuple[bytes, ...], end: bool = False) -> list[bytes]:
    """A bound of the path: its beginnings of words, lifted above all such paths for an end."""
    return [w if len(w) <= SHOWN else w[:SHOWN] + b"\xff" * end for w in path]


def shard_counts(docs: DataFrame, frequent: DataFrame, most: int, width: int, n: int, words: int = FLUSH, chunk: int = CHUNK) -> DataFrame:
    """Transducers of every shard's n-grams, in chunks with their bounds; rows with ``words`` count a language's words instead.
    Each of the ``n`` shards goes to a task of its own."""
    shift = np.uint64(64 - 8 * width)
    names = ["low", "high", "lang", "words", *[c for c, _ in PARTS_SCHEMA]]
    kinds = [pa.list_(pa.binary()), pa.list_(pa.binary()), pa.string(), pa.int64(), *[t for _, t in PARTS_SCHEMA]]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(kinds), kinds)], names=names)

    def run(batches):
        flush, shard, cells, held, totals = Flush(), None, [], Held(most), {}
        among = None

        def count():
            nonlocal flush, among
            if among is None:
                among = Cells(np.unique(np.concatenate(cells)) if cells else np.zeros(0, np.uint64), shift)
                cells.clear()
            per = np.bincount(np.array(flush.ids), minlength=flush.size())
            for lang, words, ids in flush.by_language():
                if words:
                    totals[lang] = totals.get(lang, 0) + int(per[ids].sum())
            held.add(flush, among)
            flush = Flush()

        def out():
            labels, grams, counts = held.drained()
            for a in range(0, len(grams), 64 * chunk):
                rows, some = grams[a:a + 64 * chunk], []
                for i, parts in enumerate(automata_of(labels, rows, counts[a:a + 64 * chunk], chunk)):
                    low, high = ([labels[x - 1] for x in row if x] for row in rows[[i * chunk, min((i + 1) * chunk, len(rows)) - 1]].tolist())
                    some.append((shown(low), shown(high, True), None, None, *parts))
                yield batch_of(some)

        for batch in slices(batches):
            for number, lang, body in zip(*(batch.column(c).to_pylist() for c in ("shard", "lang", "body"))):
                if number != shard or len(flush.ids) > words:
                    count()
                    if number != shard or held.settled > HELD:
                        yield from out()
                if number != shard:
                    shard, cells, among = number, [], None
                if lang is None:  # a shard's cells come before its documents
                    cells.append(cells_of(body))
                else:
                    flush.add(lang.encode(), body)
        count()
        yield from out()
        if totals:
            yield batch_of([(None, None, lang.decode(), n, None, None, None, None) for lang, n in totals.items()])

    both = frequent.select("shard", F.lit(None).cast("string").alias("lang"), F.col("cells").alias("body")).unionByName(docs)
    sorted_rows = both.repartitionById(n, "shard").sortWithinPartitions("shard", F.col("lang").isNotNull())
    return sorted_rows.mapInArrow(run, f"low array<binary>, high array<binary>, lang string, words long, {PARTS}")


def bounds_of(chunks: DataFrame, n: int) -> list[tuple[bytes, ...]]:
    """Where prefix ranges begin: as many keys as there are ranges, a few hundred bytes each."""
    ranged = chunks.select("low").repartitionByRange(n, "low").withColumn("_range", F.spark_partition_id())
    lows = ranged.groupBy("_range").agg(F.min("low").alias("low")).collect()
    return sorted({tuple(map(bytes, r.low)) for r in lows})[1:]


def automaton_rows(rows: list[tuple], lead: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    schema = [*lead, *PARTS_SCHEMA]
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, schema)], names=[c for c, _ in schema])


def grouped(batches: Iterable[pa.RecordBatch], key: str = "r") -> Iterator[tuple[int, list[dict]]]:
    """Rows of every range; the partition is sorted by range."""
    held = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0][key] != row[key]:
                yield held[0][key], held
                held = []
            held.append(row)
    if held:
        yield held[0][key], held


def range_counts(chunks: DataFrame, bounds: list[tuple[bytes, ...]], least: int, n: int) -> DataFrame:
    """``r`` and the transducer of the range's n-grams that reach ``least``."""
    def cut(batches):
        for batch in slices(batches, 64):
            low, high = ([bisect_right(bounds, tuple(x)) for x in batch.column(c).to_pylist()] for c in ("low", "high"))
            whole = batch.filter(pa.array([a == b for a, b in zip(low, high)])).select([c for c, _ in PARTS_SCHEMA])
            yield pa.RecordBatch.from_arrays([pa.array([a for a, b in zip(low, high) if a == b], pa.int32()), *whole.columns], names=["r", *whole.schema.names])
            out = []
            for row in batch.filter(pa.array([a != b for a, b in zip(low, high)])).to_pylist():
                labels, grams, counts = paths_of([row])
                order = by_rows(grams)
                grams, counts = grams[order], counts[order]
                # Of the path that begins a range all that follow are in it or a later one.
                first = [0, *(bisect_left(Paths(labels, grams), x) for x in bounds[bisect_right(bounds, tuple(row["low"])):bisect_right(bounds, tuple(row["high"]))]), len(grams)]
                for a, b in zip(first[:-1], first[1:]):
                    if a < b:
                        r = bisect_right(bounds, Paths(labels, grams)[a])
                        out.append((r, *next(automata_of(labels, grams[a:b], counts[a:b], b - a))))
            yield automaton_rows(out, [("r", pa.int32())])

    def unite(batches):
        for r, rows in grouped(batches):
            labels, grams, counts = paths_of(rows)
            grams, counts = summed_rows(grams, counts)
            good = counts >= least
            parts = next(automata_of(labels, grams[good], counts[good], max(1, len(grams))), Automaton().done().parts())
            yield automaton_rows([(r, *parts)], [("r", pa.int32())])

    kind = f"r int, {PARTS}"
    return chunks.filter("low IS NOT NULL").mapInArrow(cut, kind).repartition(n, "r").sortWithinPartitions("r").mapInArrow(unite, kind)


def parts_of(path: tuple[bytes, ...]) -> Iterator[tuple[int, tuple[bytes, ...], tuple[bytes, ...]]]:
    """Cuts of a candidate: number of first words, first part, rest."""
    for k in range(1, len(path) - 1):
        yield k, path[:k + 1], (path[0], *path[k + 1:])


def questions(counts: DataFrame, bounds: list[tuple[bytes, ...]]) -> DataFrame:
    """``r``, ``asks`` and a transducer: what range ``asks`` wants to know of n-grams in range ``r``. A weight is one more than the
    greatest count of a longer candidate that holds the n-gram; one for n-grams of which only the count is asked."""
    def ask(batches):
        for r, rows in grouped(batches):
            wanted: dict[tuple[bytes, ...], int] = {}
            for path, count in Automaton.of(rows[0]).paths():
                if len(path) < 3:
                    continue
                for _, first, rest in parts_of(path):
                    wanted.setdefault(first, 1)
                    wanted.setdefault(rest, 1)
                words = path[1:]
                for size in range(2, len(words)):
                    for at in range(len(words) - size + 1):
                        inner = (path[0], *words[at:at + size])
                        wanted[inner] = max(wanted.get(inner, 1), count + 1)
            by: dict[int, list] = {}
            for path in sorted(wanted):
                by.setdefault(bisect_right(bounds, path), []).append((path, wanted[path]))
            yield automaton_rows([(to, r, *Automaton.from_sorted(items).parts()) for to, items in by.items()], [("r", pa.int32()), ("asks", pa.int32())])

    return counts.mapInArrow(ask, f"r int, asks int, {PARTS}")


def answers(counts: DataFrame, asked: DataFrame, percent: int, n: int) -> DataFrame:
    """``r``, ``own`` and a transducer: the candidates of range ``r`` that no longer one covers, and counts that it asked for."""
    def answer(batches):
        for r, rows in grouped(batches):
            counts, covered, out = Automaton.of(rows[0]), set(), []
            for row in rows[1:]:
                found = []
                for path, weight, count in composed(Automaton.of(row), counts):
                    found.append((path, count))
                    if 100 * (weight - 1) >= percent * count:
                        covered.add(path)
                out.append((row["asks"], False, *Automaton.from_sorted(found).parts()))
            kept = [(path, count) for path, count in counts.paths() if len(path) > 2 and path not in covered]
            out.append((r, True, *Automaton.from_sorted(kept).parts()))
            for a in range(0, len(out), 64):
                yield automaton_rows(out[a:a + 64], [("r", pa.int32()), ("own", pa.bool_())])

    both = counts.withColumn("asks", F.lit(None).cast("int")).unionByName(asked)
    return both.repartition(n, "r").sortWithinPartitions("r", F.col("asks").isNotNull()).mapInArrow(answer, f"r int, own boolean, {PARTS}")


def scored(answered: DataFrame, n: int) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``score`` of every candidate that is left."""
    def score(batches):
        for _, rows in grouped(batches):
            kept = [Automaton.of(x) for x in rows if x["own"]]
            known = dict(united([Automaton.of(x) for x in rows if not x["own"]]).paths())
            out = []
            for path, a in (item for k in kept for item in k.paths()):
                least, _, l, r = min((2_000_000 * a // (known[first] + known[rest]), k, known[first], known[rest]) for k, first, rest in parts_of(path))
                out.append((path[0].decode(), b" ".join(path[1:]).decode(), a, l, r, least))
            names, kinds = ["lang", "phrase", "a", "l", "r", "score"], [pa.string(), pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(list(zip(*out)) or [()] * 6, kinds)], names=names)

    ordered = answered.repartition(n, "r").sortWithinPartitions("r")
    return ordered.mapInArrow(score, "lang string, phrase string, a long, l long, r long, score long")


def collocations(docs: DataFrame, most: int = 4, least: int = 30, percent: int = 80, top: int | None = 2000, lang: str = "lang", text: str = "text",
                 words: int = FLUSH, chunk: int = CHUNK) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of phrases of 2 to ``most`` words.

    A-Z are lower-cased, texts are cut into pieces at ``[.,;:!?]`` and line ends and these into words at spaces and tabs. ``a`` counts
    a phrase's occurrences within pieces, overlaps included, over all documents of its language; ``n`` counts words. Phrases found
    at least ``least`` times are candidates. Cut after its first words into parts found ``l`` and ``r`` times a candidate scores
    floor(2000000 a / (l + r)); the cut of the lowest score counts, of equal ones the first. A candidate is dropped if a longer
    one that holds its words, dropped or not, is found at least ``percent`` in a hundred times as often. The first ``top`` of a language
    (all with None) come by score, then ``a``, then the phrase's UTF-8.

    Null and empty texts have no words; a null language is ``und``. Repeated rows count as often. Texts of any length are taken
    whole. An empty table, or one without candidates, gives no rows. Other columns are not read. A task counts ``words`` words at
    a time and puts ``chunk`` n-grams into one transducer; the result does not depend on either.
    """
    n = partitions(docs)
    rows = written(docs.select(
        F.spark_partition_id().alias("shard"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("body")).withColumn("size", F.length("body")), "shards")
    size, last = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("shard"), F.lit(0))).first()
    rows = rows.drop("size")
    # A word and what parts it from the next take two bytes at least, so there are at most most / 2 n-grams a byte.
    width = max(3, min(8, math.ceil(math.log2(ROOM * most * max(2, size) / 2) / 8)))
    frequent = maybe_frequent(rows, most, least, width, 4 * n, words)
    chunks = written(shard_counts(rows, frequent, most, width, last + 1, words, chunk), "chunks")
    bounds = bounds_of(chunks.filter("low IS NOT NULL"), n)
    counts = written(range_counts(chunks, bounds, least, n), "counts")
    found = scored(answers(counts, questions(counts, bounds), percent, n), n)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long"))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    totals = chunks.filter("words IS NOT NULL").groupBy("lang").agg(F.sum("words").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

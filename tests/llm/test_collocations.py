"""Phrase collocations against plain counting, transducers against dictionaries, and odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyframe.llm import collocations as co

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, most=4, least=30, percent=80, top=2000):
    """``(lang, rank, phrase, a, l, r, n, score)`` from a dictionary of all n-grams."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, most + 1):
                for i in range(len(words) - m + 1):
                    f[(lang, *words[i:i + m])] += 1
    candidates = {p for p, a in f.items() if a >= least and len(p) > 2}
    covered = set()
    for p in candidates:
        for size in range(2, len(p) - 1):
            for i in range(1, len(p) - size + 1):
                inner = (p[0], *p[i:i + size])
                if 100 * f[p] >= percent * f[inner]:
                    covered.add(inner)
    by = {}
    for p in candidates - covered:
        score, k = min((2_000_000 * f[p] // (f[p[:k + 1]] + f[(p[0], *p[k + 1:])]), k) for k in range(1, len(p) - 1))
        by.setdefault(p[0], []).append((-score, -f[p], " ".join(p[1:]).encode(), f[p[:k + 1]], f[(p[0], *p[k + 1:])]))
    return sorted((lang, i, phrase.decode(), -a, l, r, n[lang], -score) for lang, found in by.items()
                  for i, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1))


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


def texts(seed, n):
    rng = random.Random(seed)
    words = ["The", "of", "new", "york", "city", "is", "a\x01", "a", "à", "ß", "I'm", "\x00", "x-y", "漢字", "\x1c", "York", "\x85z"]
    out = []
    for i in range(n):
        said = " ".join(rng.choice(["New York City", "is a", "the"] + words) + rng.choice(["", "", ".", ",", "\t", "\n", "  ", "!?"]) for _ in range(rng.randint(0, 60)))
        out.append((rng.choice(["en", "de", None, "und", "e n"]), said))
    return out + [("en", None), (None, ""), ("en", "one " * 500), ("de", "a b. " * 40), ("fr", "  \t ..., ")]


def test_transducers_hold_and_sum_what_was_added():
    rng = random.Random(1)
    parts, sums = [], Counter()
    for _ in range(5):
        counts = Counter(tuple(rng.choice([b"a", b"b", b"ab", b"c"]) for _ in range(rng.randint(1, 4))) for _ in range(200))
        parts.append(co.Automaton.from_sorted(sorted(counts.items())))
        sums.update(counts)
        assert list(parts[-1].paths()) == sorted(counts.items())
        assert len(parts[-1].weights) < 1 + sum(len(p) for p in counts)
    row = dict(zip(("labels", "weights", "starts", "arcs"), parts[0].parts()))
    assert list(co.Automaton.of(row).paths()) == list(parts[0].paths())
    assert list(co.united(parts).paths()) == sorted(sums.items())
    assert list(co.united(parts, 9).paths()) == sorted((p, c) for p, c in sums.items() if c >= 9)
    assert list(co.united([]).paths()) == []
    asked = co.Automaton.from_sorted([((b"a",), 3), ((b"a", b"b"), 1), ((b"zz",), 1)])
    assert list(co.composed(asked, co.united(parts))) == [(p, w, sums[p]) for p, w in [((b"a",), 3), ((b"a", b"b"), 1)] if p in sums]


def test_equal_ends_are_one_state():
    one = co.Automaton.from_sorted([((b"a", b"x", b"y"), 2), ((b"b", b"x", b"y"), 2)])
    assert len(one.weights) == 4


@pytest.mark.parametrize("least,percent,top,flush", [(30, 80, 2000, 1 << 20), (5, 80, 2000, 300), (2, 50, 7, 1000), (1, 100, 50, 64)])
def test_against_plain_counting(spark, least, percent, top, flush):
    rows = texts(least, 120)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "lang string, text string, phrase string").repartition(5)
    assert got(co.collocations(frame, least=least, percent=percent, top=top, words=flush, chunk=50)) == plain(rows, least=least, percent=percent, top=top)


def test_two_words_at_most_and_all_ranks(spark):
    rows = texts(9, 60)
    frame = spark.createDataFrame(rows, "lang string, text string")
    assert got(co.collocations(frame, most=2, least=4, top=None)) == plain(rows, most=2, least=4, top=None)


def test_long_words_and_bounds(spark):
    long = "y" * 70
    rows = [("en", f"{long}{i % 7} {long}{i % 3} z" + " w" * (i % 4)) for i in range(200)]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert got(co.collocations(frame, least=3, chunk=3)) == plain(rows, least=3)


def test_empty_and_without_candidates(spark, none, docs):
    assert co.collocations(none).collect() == []
    assert co.collocations(spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")).collect() == []


def test_documents(spark, docs, rows):
    assert got(co.collocations(docs, least=5)) == plain([(r[2], r[1]) for r in rows], least=5)


def test_whole_table(spark):
    from skyframe.llm.plans import op11_collocations

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text").collect()]
    assert got(op11_collocations(spark, "/root/testdata/sf0.001")) == plain(rows)


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_automata_of_sorted_numbers_are_minimal_and_hold_the_same(size):
    rng = random.Random(size)
    labels = [b"a", b"ab", b"b", b"c", b"d", b"a"]  # a language may be called like a word
    counts = Counter((6, *[rng.randint(1, 5) for _ in range(rng.randint(1, 4))]) for _ in range(900))
    rows = sorted((p + (0,) * (5 - len(p)), c) for p, c in counts.items())
    grams, weights = np.array([p for p, _ in rows], np.int32), np.array([c for _, c in rows])
    found = [dict(zip(("labels", "weights", "starts", "arcs"), p)) for p in co.automata_of(labels, grams, weights, size)]
    items = [(tuple(labels[x - 1] for x in p if x), c) for p, c in rows]
    for i, row in enumerate(found):
        plain = co.Automaton.from_sorted(items[i * size:(i + 1) * size])
        assert list(co.Automaton.of(row).paths()) == items[i * size:(i + 1) * size]
        assert len(row["weights"]) == 8 * len(plain.weights)
    known, back, sums = co.paths_of(found + found[:1])
    back, sums = co.summed_rows(back, sums)
    want = Counter(dict(items)) + Counter(dict(items[:size]))
    assert [(tuple(known[x - 1] for x in p if x), c) for p, c in zip(back.tolist(), sums.tolist())] == sorted(want.items())
    assert list(co.automata_of([], grams[:0], weights[:0], size)) == []


@pytest.mark.parametrize("width", [3, 5, 8])
def test_cells_are_found(width):
    rng = np.random.default_rng(width)
    h, shift = rng.integers(0, 1 << 63, 5000, dtype=np.uint64), np.uint64(64 - 8 * width)
    cells = np.unique(co.mixed(h[::3]) >> shift)
    assert co.Cells(cells, shift).among(h).tolist() == np.isin(co.mixed(h) >> shift, cells).tolist()


@pytest.mark.parametrize("bits,least", [(63, 8), (40, 3), (20, 1)])
def test_cells_are_packed_as_steps(bits, least):
    cells = np.unique(np.random.default_rng(bits).integers(0, 1 << bits, 1_000_000, dtype=np.uint64))
    for some in (cells, cells[:1], cells[-2:], np.array([0, (1 << 64) - 1], np.uint64)):
        assert co.cells_of(co.packed_cells(some)).tolist() == some.tolist()
    assert len(co.packed_cells(cells)) <= 9 + max(1, least) * len(cells)  # 5 bytes a cell before, of 40 bits


def test_a_task_counts_one_shard(spark):
    """Hashes of the shards' numbers collide: some tasks had three of them, one after the other."""
    rows = spark.createDataFrame([(i % 9, "en", f"a b c{i}".encode()) for i in range(90)], "shard int, lang string, body binary")
    cells = co.maybe_frequent(rows, 4, 1, 5, 4)
    held = co.shard_counts(rows, cells, 4, 5, 9).filter("words IS NOT NULL").groupBy(F.spark_partition_id().alias("task")).agg(F.sum("words").alias("n")).collect()
    assert sorted((r.task, r.n) for r in held) == [(i, 30) for i in range(9)]


def test_chunks_that_several_ranges_cut(spark):
    rows = [("en", f"{a}{b} {b}{c}") for a in "abcdef" for b in "ghij" for c in "klmn"] + [("de", "x y z")] * 3
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    shards = frame.select(F.spark_partition_id().alias("shard"), "lang", F.col("text").cast("binary").alias("body"))
    frequent = co.maybe_frequent(shards, 3, 1, 5, 4)
    chunks = co.written(co.shard_counts(shards, frequent, 3, 5, 2, chunk=1000), "chunks")
    bounds = [(b"en", w) for w in (b"ah", b"bi", b"cg", b"cg ", b"gk", b"zz")]
    counts = co.range_counts(chunks, bounds, 1, 3).collect()
    got_ranges = {r.r: [p for p, _ in co.Automaton.of(r.asDict()).paths()] for r in counts}
    every = sorted(p for paths in got_ranges.values() for p in paths)
    assert len(every) == len(set(every)) and all(co.bisect_right(bounds, p) == r for r, paths in got_ranges.items() for p in paths)
    words = {(lang, *text.split()[i:i + m]) for lang, text in rows for m in (1, 2, 3) for i in range(len(text.split()) - m + 1)}
    assert {tuple(x.decode() for x in p) for p in every} == words

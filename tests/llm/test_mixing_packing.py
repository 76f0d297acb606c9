"""Mixing and packing: targets, budgets and capacities, round trips of ids, and odd rows."""

import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyframe.llm import mixing, packing
from skyframe.llm.plans import tokenizer_files


def filled(sizes, weights, total, cap):
    """Targets by repeated resharing."""
    left, out = set(sizes), {s: Fraction(0) for s in sizes}
    while left:
        free = total - sum(out[s] for s in sizes if s not in left)
        w = sum(weights[s] for s in left)
        over = [s for s in left if free * weights[s] / w > cap * sizes[s]]
        if not over:
            for s in left:
                out[s] = Fraction(free) * weights[s] / w
            break
        for s in over:
            out[s] = Fraction(cap * sizes[s])
            left.discard(s)
    return out


def test_targets_reshare_by_weight(spark):
    sizes = {"a": 10, "b": 100, "c": 1000, "d": 3, None: 7, "Z": 0, "é": 400}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    want = filled(sizes, weights, sum(sizes.values()), 3)
    assert {s: pytest.approx(float(t)) for s, t in want.items()} == got


def test_mix(docs, rows):
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        assert r.taken <= 3 * r.size
    taken = defaultdict(int)
    longest = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    total = sum(sizes.values())
    assert sum(taken.values()) <= total
    for r in got:  # every queue stops within a document of its share of the budget
        assert abs(taken[r.source] - r.target) <= 2 * max(longest.values())
    again = mixing.mixed(docs.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_is_the_queue_in_order(docs):
    """The kept copies are the first by finish time."""
    got = mixing.mixed(docs).collect()
    spent = sum(r.taken for r in got)
    budget = sum(r.size for r in got)
    assert budget - spent < max(r.size for r in got)


def test_mix_repeats_documents(docs, none):
    decisions = Counter()
    for r in mixing.mixed(docs).collect():
        decisions[r.doc_id] += r.copies
    mixed = mixing.mix(docs)
    assert mixed.schema == docs.schema
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: v for k, v in decisions.items() if v})
    assert mixing.mixed(none).collect() == [] and mixing.mix(none).collect() == []


ODD = ["", " ", "a  b", " a", "a ", " \n a", "x\n y", "a\t b <|endoftext|> c", "Привет мир ꙮ 日本語 text", "a  b", "don't  \n\n I'll", "  x", "naïve ɐɓ 12³ ½", "w" * 3000, "x " * 2000]


@pytest.mark.parametrize("quick", [True, False])
def test_ids_are_the_tokenizers(quick, rows, monkeypatch):
    files = tokenizer_files()
    encode = packing.Encoder(**files) if quick else packing.Encoder(files["path"])
    monkeypatch.setattr(packing, "KNOWN", 50)
    monkeypatch.setattr(packing, "STRETCH", 40)
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ODD + [r[1] or "" for r in rows]:
        assert np.frombuffer(encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packed_round_trip(docs, rows, none):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.packed_sequences(docs, **tokenizer_files(), with_ids=True).collect()
    whole = defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= 1024 and zlib.crc32(r.ids) == r.ids_crc32
        whole[r.doc_id].append((r.piece, r.start, ids.tolist()))
    want = defaultdict(Counter)
    for doc, text, *_ in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            want[doc][(k, a, tuple(ids[a:b]))] += 1
    assert {d: Counter((k, a, tuple(x)) for k, a, x in parts) for d, parts in whole.items()} == dict(want)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    tokens = sum(r.length for r in got)
    assert len(places) <= -(-tokens // 1024) + 1
    assert packing.packed_sequences(none, **tokenizer_files()).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    lengths = np.random.default_rng(1).integers(1, 100, 700)
    capacity = packing.Capacity(100, 4, 4000.0)
    bins, offsets = packing.best_fit(lengths, capacity, (1.0, 0.5, 0.5), rule)
    for b in np.unique(bins):
        own = lengths[bins == b]
        assert own.sum() <= 100 and len(own) <= 4 and (len(own) == 1 or (own.astype(float) ** 2).sum() <= 4000 + 1e-6)
        assert sorted(offsets[bins == b]) == sorted(np.concatenate([[0], np.cumsum(own[np.argsort(offsets[bins == b])])[:-1]]))


def test_best_fit_is_the_plain_rule():
    """Least norm of what is left, by a loop over all sequences."""
    lengths = np.random.default_rng(2).integers(1, 300, 200)
    capacity, w = packing.Capacity(300, 6, 60000.0), (1.0, 0.2, 0.3)
    bins, _ = packing.best_fit(lengths, capacity, w)
    open_, want = [], np.zeros(len(lengths), int)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = np.array([lengths[i] / 300, 1 / 6, lengths[i] ** 2 / 60000])
        fits = [(((r - need) ** 2 * w).sum(), b) for b, r in enumerate(open_) if (r - need >= -1e-12).all()]
        b = min(fits, key=lambda x: (round(x[0], 14), x[1]))[1] if fits else len(open_)
        if b == len(open_):
            open_.append(np.ones(3))
        open_[b] = open_[b] - need
        want[i] = b
    assert len(set(want)) == len(set(bins))
    assert (want == bins).mean() > 0.99

"""Line dedup, SimHash, window dedup and license scans against plain loops over the same rows."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from skyframe.llm import licenses, line_dedup, simhash, windows

SPACES = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words_in(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lines_left(rows, least=20, copies=3, keep=max):
    holders = defaultdict(set)
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            key = line.strip(SPACES).translate(LOW)
            if doc is not None and len(key) >= least:
                holders[key].add(doc)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders.get(k := x.strip(SPACES).translate(LOW), ())) < copies or keep(holders[k]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("keep,bits", [("last", None), ("first", None), ("last", 1 << 16)])
def test_lines(docs, rows, keep, bits):
    got = line_dedup.without_repeated_lines(docs, keep=keep, bits=bits, raw=True)
    found = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect())
    assert found == lines_left(rows, keep=max if keep == "last" else min)
    assert sum(k[2] * n for k, n in found.items()) > 0


def test_lines_in_a_full_filter(docs, rows, monkeypatch):
    """A filter far too small for its lines only finds more suspects; the result is the same."""
    monkeypatch.setattr(line_dedup, "cells", lambda keys, bits: np.zeros((len(keys), 2), np.int64))
    got = line_dedup.without_repeated_lines(docs, raw=True)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect()) == lines_left(rows)


def test_lines_keep_all_columns(docs, none):
    assert line_dedup.without_repeated_lines(docs).columns == docs.columns
    assert line_dedup.without_repeated_lines(docs).schema == docs.schema
    assert line_dedup.without_repeated_lines(none).collect() == []


def print_of(text, words):
    parts = words_in((text or "").translate(LOW))
    grams = [" ".join(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("small", [simhash.SMALL, 2])
def test_simhash(docs, rows, small, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL", small)
    prints = [(r[0], print_of(r[1], 4)) for r in rows]
    known = {}
    for doc, p in prints:
        if doc is not None:
            known[p] = min(doc, known.get(p, doc))
    links = [(a, b) for a in known for b in known if a < b and (a ^ b).bit_count() <= 4]
    group = groups([(known[a], known[b]) for a, b in links], set(known.values()))
    want = Counter((doc, f"{p:016x}", group[known[p]] if p in known else None) for doc, p in prints)
    got = Counter(tuple(r) for r in simhash.near_groups(docs).select("doc_id", "fingerprint", "component_id").collect())
    assert got == want


def test_no_linked_pair_misses_all_blocks():
    """Fingerprints at four differing bits share a block whatever the bits are; pivots never discard them."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        a = int(rng.integers(0, 2**63))
        b = a
        for bit in rng.choice(64, 4, replace=False):
            b ^= 1 << int(bit)
        assert any(a & m == b & m for _, m in simhash.bit_keys(4))
        x = simhash.table(np.array([a, b], np.uint64))
        assert np.abs(x[0].astype(int) - x[1]).max() <= 4


def test_tight_group_is_spanned_without_its_pairs():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, dtype=np.uint64)
    prints = np.unique(np.array([base ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for i in range(40) for j in range(i)], np.uint64))
    a, b = simhash.run_links(np.zeros(len(prints), np.int64), prints, None, 4, 0.0)
    assert len(a) == len(prints) - 1
    assert len(set(groups(zip(a.tolist(), b.tolist()), range(len(prints))).values())) == 1


def test_similar_texts(docs, rows, none):
    kept = simhash.without_near_copies(docs)
    assert kept.schema == docs.schema
    found = [r.doc_id for r in kept.collect()]
    by = defaultdict(set)
    for doc, text, *_ in rows:
        parts = words_in((text or "").translate(LOW))
        by[doc] = frozenset(" ".join(parts[i:i + 5]) for i in range(max(1, len(parts) - 4)) if parts)
    ids = [d for d in by if d is not None]
    alike = lambda a, b: by[a] == by[b] or len(by[a] & by[b]) >= 0.9 * len(by[a] | by[b])
    for d in ids:
        if any(e < d and alike(d, e) for e in ids):
            assert d not in found
        if not any(e != d and len(by[e] & by[d]) > 0.6 * len(by[e] | by[d]) or by[e] == by[d] and e != d for e in ids):
            assert d in found
    assert found.count(None) == 2
    assert simhash.without_near_copies(none).collect() == []


def windows_left(rows, size):
    firsts, places = {}, []
    for doc, text, *_ in rows:
        w = words_in(text)
        own = [tuple(w[i:i + size]) for i in range(len(w) - size + 1)] if doc is not None else []
        for i, x in enumerate(own):
            firsts[x] = min(firsts.get(x, (doc, i)), (doc, i))
        places.append((doc, w, own))
    out = []
    for doc, w, own in places:
        lost = {i + k for i, x in enumerate(own) if firsts[x] != (doc, i) for k in range(size)}
        out.append((doc, len(w), len(lost), " ".join(x for i, x in enumerate(w) if i not in lost)))
    return Counter(out)


@pytest.mark.parametrize("size,shortest,flush", [(20, 10, None), (20, 5, 200), (8, 1, 50), (4, 4, None)])
def test_windows(docs, rows, size, shortest, flush, monkeypatch):
    if flush:
        monkeypatch.setattr(windows, "FLUSH", flush)
    got = windows.without_repeated_windows(docs, size, shortest, raw=True)
    found = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect())
    assert found == windows_left(rows, size)
    assert sum(k[2] * n for k, n in found.items()) > 0


def test_windows_keep_all_columns(docs, none):
    assert windows.without_repeated_windows(docs).schema == docs.schema
    assert windows.without_repeated_windows(none).collect() == []
    with pytest.raises(ValueError):
        windows.without_repeated_windows(docs, 20, 3)


NOTICES = [
    "Some text. CC BY 4.0, cc-by and CC\nBY; all rights reserved? All   Rights, Reserved!",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0.",
    "Permission is hereby granted, free of charge, to any lucky person obtaining a copy of this software and associated documentation files (the Software)",
    "permission is granted", "The general public has a license", "ccby general publiclicense", "general public license " * 5,
]


def test_licenses(spark, docs, rows, none):
    schema = "doc_id long, text string, spans string, template int"
    own = [(i, t, "s", 1) for i, t in enumerate(NOTICES)] + [(100, None, None, None), (101, "", "", 1), (None, NOTICES[0], "", 1), (7, NOTICES[7], "s", 1)]
    got = licenses.digest(licenses.scan(spark.createDataFrame(own, schema))).collect()
    assert len(got) == len(own)
    phrases = {tuple(p.split()): label for p, label in licenses.PHRASES.items()}
    want = []
    for doc, text, *_ in own:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        places = [(i, label) for p, label in phrases.items() for i in range(len(w)) if tuple(w[i:i + len(p)]) == p]
        starts = [i for i, _ in places]
        want.append((doc, len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))))
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter(want)
    labels = {r.doc_id: r.labels for r in got}
    assert (labels[1], labels[2], labels[3], labels[4]) == ("gpl,gpl-3", "apache-2.0", "mit", "")
    assert all(0 <= r.score <= 1 for r in got)
    assert licenses.digest(licenses.scan(none)).collect() == []
    assert licenses.scan(docs).count() == len(rows)


def between():
    """Texts of 5 to 400 words and copies of them whose similarity lies between 0.6 and 1, long families among them."""
    rng, texts = np.random.default_rng(11), []
    for n in (5, 6, 8, 9, 12, 24, 50, 50, 69, 70, 84, 85, 100, 250, 400):
        base = [f"w{n}x{i}" for i in rng.integers(0, 10**6, n)]
        texts += [base, base[:-1], base + ["more"], base[: max(1, n * 9 // 10)], base[: max(1, n * 4 // 5 + 1)]]
        for changed in range(1, max(2, n // 25)):
            for _ in range(3):
                other = list(base)
                for at in rng.choice(n, changed, replace=False):
                    other[at] = f"new{rng.integers(0, 10**6)}"
                texts.append(other)
    template = [f"t{i}" for i in range(80)]
    for i in range(40):  # alike to about 0.7 to one another, and pairs of them closer
        texts.append(template + [f"own{i // 2}x{k}" for k in range(12)] + [f"last{i}x{k}" for k in range(3)])
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("small", [simhash.SMALL, 3])
def test_similar_texts_at_exactly_the_similarity(spark, small, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL", small)
    rows = between()
    sets = [frozenset(" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))) for w in (t.split(" ") for _, t in rows)]
    share = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in range(len(rows)) for b in range(a) if sets[a] & sets[b]}
    assert sum(0.7 <= s < 0.8 for s in share.values()) > 20 and sum(0.8 <= s < 0.9 for s in share.values()) > 20
    want = groups([p for p, s in share.items() if s >= 0.8], range(len(rows)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs, words=5, similarity=0.8).collect()}
    assert got == {i: min(j for j in want if want[j] == want[i]) for i in want}


def long_rows(sets):
    values = np.concatenate([x >> np.uint64(48) for x in sets]).astype(np.uint16)
    return values, np.concatenate([[0], np.cumsum([len(x) for x in sets])])


def test_similar_texts_of_one_long_group_are_not_listed_pair_by_pair():
    n = 500
    values, ends = long_rows([np.arange(200, dtype=np.uint64) << np.uint64(48)] * n)
    a, b = simhash.long_pairs(np.zeros(n, np.int64), values, ends, np.full(n, 200), np.arange(n), 0.8)
    assert len(a) == n - 1
    a, b = simhash.long_pairs(np.zeros(n, np.int64), values, ends, np.full(n, 200), np.zeros(n, np.int64), 0.8)
    assert len(a) == 0


def test_bits_of_hashes_lose_no_pair():
    """Sets of random hashes: every pair at the similarity is joined by the spanning pairs, or listed when all are asked for."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 900, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(900) < 0.02 + 0.1 * rng.random(), rng.integers(0, 2**63, 900, dtype=np.uint64), base)) for _ in range(60)]
    values, ends = long_rows(sets)
    sizes, run = np.array([len(x) for x in sets]), np.zeros(60, np.int64)
    want = {(j, i) for i in range(60) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) >= 0.8}
    a, b = simhash.long_pairs(run, values, ends, sizes, np.arange(60), 0.8, np.zeros((60, 1), np.int64), run)
    assert want <= set(zip(a.tolist(), b.tolist())) and len(a) <= len(want) + 60
    a, b = simhash.long_pairs(run, values, ends, sizes, np.arange(60), 0.8)
    joined = groups(zip(a.tolist(), b.tolist()), range(60))
    assert 0 < len(want) < 1770 and all(joined[i] == joined[j] for i, j in want) and len(a) < 60


def test_templated_texts_below_the_similarity_all_stay(spark):
    """Each shares 0.70 to 0.79 of the shingles with every other one: none is a near copy, and none may chain to another."""
    def family(own, n):
        return [" ".join([f"t{n}x{i}" for i in range(n)] + [f"own{n}x{k}x{i}" for i in range(own)]) for k in range(60)]
    texts = family(9, 60) + family(30, 200) + family(120, 900)
    sets = [frozenset(" ".join(w[i:i + 5]) for i in range(len(w) - 4)) for w in (t.split(" ") for t in texts)]
    shares = [len(sets[at] & sets[at + 1]) / len(sets[at] | sets[at + 1]) for at in (0, 60, 120)]
    assert all(0.7 <= s < 0.8 for s in shares)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert simhash.without_near_copies(docs).count() == len(texts)


def test_short_sets_in_shared_keys_give_spanning_links_only():
    """All keys of a partition: the groups are those of all pairs that share a key, with one link less than members."""
    rng = np.random.default_rng(8)
    for _ in range(20):
        base = [rng.choice(400, 30, replace=False) for _ in range(6)]
        sets = [np.unique(np.where(rng.random(30) < 0.06, rng.integers(400, 900, 30), base[rng.integers(6)])) for _ in range(120)]
        sets = [np.sort(s.astype(np.int64)) for s in sets]
        at = [(k, i) for i, s in enumerate(sets) for k in (int(s[0]), int(s[1]), 5000 + i % 2)]
        at.sort()
        key, row = np.array([k for k, _ in at]), np.array([i for _, i in at])
        members, n = simhash.padded(pa.array([sets[i].tolist() for i in row], pa.list_(pa.int64())))
        label = row // 2 * 2  # pairs that are together already
        a, b = simhash.short_links(key, members, n, label, 0.8)
        near = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y)) >= 0.8
        want = {(i, j) for i in range(120) for j in range(i) if near(sets[i], sets[j]) and (i % 2 == j % 2 or sets[i][0] in sets[j][:2] or sets[i][1] in sets[j][:2])}
        assert all((max(i, j), min(i, j)) in want for i, j in zip(row[a].tolist(), row[b].tolist()))
        together = {(i, i // 2 * 2) for i in range(120)}
        assert groups({(row[x], row[y]) for x, y in zip(a, b)} | together, range(120)) == groups(want | together, range(120))
        assert len(a) < 60


def test_every_pair_of_long_sets_comes_at_one_key():
    """Rows of equal sets: each pair comes up once, however many keys the two rows share."""
    n, keys = 30, np.full((30, simhash.BANDS), np.iinfo(np.int64).max)
    keys[:, :3] = [3, 5, 7]
    key, row = np.repeat([3, 5, 7], n), np.tile(np.arange(n), 3)
    values, ends = long_rows([np.arange(100, dtype=np.uint64) << np.uint64(48)] * 3 * n)
    a, b = simhash.long_pairs(key, values, ends, np.full(3 * n, 100), row, 0.8, keys[row], key)
    pairs = Counter(tuple(sorted(p)) for p in zip(row[a].tolist(), row[b].tolist()))
    assert set(pairs.values()) == {1} and len(pairs) == n * (n - 1) // 2


@pytest.mark.parametrize("tile", [None, 7])
def test_edited_copies_of_one_text_form_the_groups_of_all_pairs(spark, monkeypatch, tile):
    """Similarities from 0.3 to 1 within one group, so that keys stay open after the first links."""
    if tile:
        monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(11)
    rate = [0.002, 0.01, 0.02, 0.05]
    texts = [" ".join(f"w{n}x{i}" if rng.random() > rate[k % 4] else f"own{k}x{i}" for i in range(n)) for n in (40, 72, 160) for k in range(50)]
    sets = [frozenset(" ".join(w[i:i + 5]) for i in range(len(w) - 4)) for w in (t.split(" ") for t in texts)]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs, words=5, similarity=0.8).collect()}
    assert got == groups(pairs, range(len(texts)))
    assert 3 < len(set(got.values())) < len(texts)


def test_a_template_of_many_texts_gives_few_rows_a_text(spark, monkeypatch):
    """800 texts with one word changed, short and long: every row that the rounds write for them is counted."""
    texts = [" ".join(f"t{n}x{i}" if i != (k * 7) % n else f"own{k}" for i in range(n)) for n in (60, 200) for k in range(800)]
    rows, keep = Counter(), simhash.written

    def counted(df, name):
        out = keep(df, name)
        rows[name] += out.count()
        return out

    monkeypatch.setattr(simhash, "written", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.component_id for r in simhash.near_groups(docs, words=5, similarity=0.8).select("component_id").distinct().collect()}
    assert got == {0, 800}
    assert rows["pairs"] <= 16 * len(texts) and rows["links"] <= 16 * len(texts) and rows["open"] <= 20 * len(texts)


def test_fingerprints_link_similar_texts_and_shingles_check_them(spark, monkeypatch):
    """With keys that no two texts share only fingerprints bring texts together; equal ones of different sets do not link."""
    def own_key(hashes, similarity, keep=simhash.meeting_keys):
        _, short, marks = keep(hashes, similarity)
        return hashes[:1] & ~np.uint64(1) if len(hashes) < 50 else hashes[-1:] ^ hashes[len(hashes) // 2] | np.uint64(1), short, marks

    monkeypatch.setattr(simhash, "meeting_keys", own_key)
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(400)]
    copies = [base, base] + [base[:at] + ["new"] + base[at + 1:] for at in rng.choice(400, 12, replace=False).tolist()]
    phrase = ["one", "two", "three", "four", "five"] * 60
    texts = [" ".join(t) for t in copies + [phrase + [f"{x}{i}" for i in range(30)] for x in "ab"]]
    prints = [print_of(t, 5) for t in texts]
    assert prints[-1] == prints[-2]
    want = groups([(a, b) for a in range(14) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4], range(len(texts)))
    assert len(set(want.values())) < 12
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs, words=5, similarity=0.8).collect()}
    assert got == want

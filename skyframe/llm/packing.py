"""Tokenised documents packed into sequences by vector best fit under token, document and attention capacities."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import schema_of, slices

GROUP_DOCS = 16384  # documents whose open pieces one task packs together
KNOWN = 200_000  # words with their ids that a task remembers
STRETCH = 1 << 20  # characters split into words at a time


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds: tokens, documents, and attention cost (the sum of squared piece lengths)."""

    tokens: int = 1024
    documents: int = 1024
    attention: float = 1024.0 * 1024.0


class Odd(Exception):
    """White space at which the text can't be cut without changing its tokens."""


class Words(dict):
    """Ids (little-endian 32 bit) of a space and a word, encoded when first met."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word):
        if not word or word[0].isspace():
            raise Odd
        if len(self) >= KNOWN:
            self.clear()
        ids = self[word] = self.encode(" " + word)
        return ids


class Encoder:
    """Token ids of a text as bytes. A single space before a word always begins a token of its own, so words are encoded
    once and remembered; a text with other spacing, or with a special token's string, is encoded as a whole."""

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.quick = None
        if ranks:  # the same vocabulary as ranks: quicker on a word never met
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.words = Words(self.one)

    def one(self, text: str) -> bytes:
        # Letters beyond the Latin blocks go to the tokenizer itself: pattern libraries may disagree on newer ones.
        ids = self.quick.encode_ordinary(text) if self.quick and max(text, default=" ") < "ɐ" else self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        try:
            cut = text.find(" ")
            if cut < 0:
                return self.one(text)
            out, start = [self.one(text[:cut]) if cut else b""], cut + 1
            while True:
                end = text.find(" ", start + STRETCH)
                out += map(self.words.__getitem__, text[start:end if end >= 0 else len(text)].split(" "))
                if end < 0:
                    return b"".join(out)
                start = end + 1
        except Odd:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def pieces(docs: DataFrame, path: str, ranks: str | None = None, pattern: str | None = None, end: int = 2, most: int = 1024,
           with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` (little-endian 32 bit).

    A document is its ids and the end id. Longer ones than ``most`` are cut so that all pieces but the first are full.
    """
    last = np.array([end], "<u4").tobytes()

    def run(batches):
        encode = Encoder(path, ranks, pattern)
        for batch in slices(batches, 256):
            doc, piece, start, length, crc, ids = [], [], [], [], [], []
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                data = encode(text or "") + last
                n, at, k = len(data) // 4, 0, 0
                stop = (n - 1) % most + 1
                while at < n:
                    part = data[4 * at:4 * stop]
                    doc.append(key)
                    piece.append(k)
                    start.append(at)
                    length.append(stop - at)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
                    at, stop, k = stop, stop + most, k + 1
            columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names=names + ["ids"] * with_ids)

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.mapInArrow(run, kind)


def best_fit(lengths: np.ndarray, capacity: Capacity, weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece.

    Pieces come by falling length. Of the sequences whose residual tokens, documents and attention cost all allow it, the
    piece goes to the one with the least weighted norm of what would be left (``norm``) or with the greatest weighted
    dot product of the piece's needs and the residual (``dot``), both as shares of the capacities; ties to the oldest.
    """
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], np.float64)
    needs = np.stack([lengths, np.ones(len(lengths)), lengths.astype(np.float64) ** 2], axis=1) / full
    w = np.asarray(weights, np.float64)
    order = np.lexsort((np.arange(len(lengths)), -lengths))
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.ones((max(1, len(lengths)), 3))  # residuals of the open sequences, as shares
    name = np.zeros(max(1, len(lengths)), np.int64)  # their numbers
    used = np.zeros(max(1, len(lengths)), np.int64)  # tokens in a sequence, by number
    n_open, n_all, slack = 0, 0, 1e-12
    least = needs.min(axis=0) if len(lengths) else np.zeros(3)
    for k, i in enumerate(order.tolist()):
        need = needs[i]
        if need[0] > 1 + slack:
            raise ValueError("A piece is longer than a sequence")
        spare = left[:n_open] - need
        fits = np.flatnonzero((spare >= -slack).all(axis=1))
        if len(fits):
            if rule == "norm":
                at = fits[np.argmin((spare[fits] ** 2) @ w)]
            else:
                at = fits[np.argmax(left[fits] @ (w * need))]
        else:  # a piece always has a sequence of its own, even above the other capacities
            at = n_open
            left[at], name[at] = 1.0, n_all
            n_open, n_all = n_open + 1, n_all + 1
        left[at] -= need
        bins[i], offsets[i] = name[at], used[name[at]]
        used[name[at]] += lengths[i]
        if k % 256 == 255:  # sequences that nothing fits any more leave the search
            live = (left[:n_open] >= least - slack).all(axis=1)
            m = int(live.sum())
            left[:m], name[:m], n_open = left[:n_open][live], name[:n_open][live], m
    return bins, offsets


def placed(rows: DataFrame, n_docs: int, capacity: Capacity | None = None, weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm") -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``. Pieces are dealt by hash into groups of about ``GROUP_DOCS`` documents,
    each packed in one task; full pieces need no search."""
    capacity = capacity or Capacity()
    groups = max(1, math.ceil(n_docs / GROUP_DOCS))
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))

    def pack(table):
        group = table.column("_group")[0].as_py()
        # The order of arrival must not matter, so that a task that is run again gives the same.
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit(table.column("length").to_numpy(), capacity, weights, rule)
        out = table.drop_columns(["_group"])
        return out.append_column("sequence_id", pa.array(bins + (group << 32), pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return dealt.groupBy("_group").applyInArrow(pack, schema_of(rows, sequence_id="long", offset="long"))


def packed_sequences(docs: DataFrame, path: str, ranks: str | None = None, pattern: str | None = None, end: int = 2, capacity: Capacity | None = None,
                     weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm", with_ids: bool = False, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``, and ``ids``
    if asked for.

    Null and empty texts are the end id alone. A null doc_id is packed like any other; rows that repeat a doc_id are
    packed as often. Texts of any length are cut, never shortened. An empty table gives no rows. Other columns are not
    read. The tokenizer's files must be at the same path on every executor.
    """
    capacity = capacity or Capacity()
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    cut = pieces(rows, path, ranks, pattern, end, capacity.tokens, with_ids)
    return placed(cut, docs.count(), capacity, weights, rule)

"""SentencePiece ids of whole texts from a merge-type vocabulary, by an agenda of adjacent symbol pairs, and back to text."""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import slices

SPACE = "▁"  # how the vocabulary writes a space
BPE, NORMAL, UNKNOWN, CONTROL, BYTE = 2, 1, 2, 3, 6  # numbers of the model file's format
KNOWN = 650_000  # units with their ids that a task remembers
LONGEST = 64  # characters of a unit worth remembering
SHORT = 24  # characters of a unit whose agenda is a plain list
NONE = 1 << 60  # place of a pair that is no piece
BATCH = 256  # texts encoded and checked at a time


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of every field of a protocol buffer message."""
    at = 0

    def number():
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            out, shift, at = out | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return out

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            value = number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


class Vocabulary:
    """Pieces, scores and text rules of a model file. Models that need more than merges are refused."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = file.read()
        self.ids: dict[str, int] = {}
        scores: dict[str, float] = {}
        self.size, self.unknown, self.end, self.bytes = 0, 0, None, {}
        trainer, rules = {}, {}
        for field, value in fields(model):
            if field == 1:
                self._piece(dict(fields(value)), scores)
            elif field == 2:
                trainer = dict(fields(value))
            elif field == 3:
                rules = dict(fields(value))
        if trainer.get(3) != BPE or trainer.get(24) or rules.get(2) or not rules.get(5, 1):
            raise ValueError(f"{path} is not a merge-type vocabulary without a table of replacements")
        self.prefix, self.squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        order = {score: i for i, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.place = {piece: order[score] for piece, score in scores.items()}  # equal scores have equal places
        self.bytes = self.bytes if trainer.get(35) and len(self.bytes) == 256 else {}
        long = [p for p in self.ids if len(p) > 1]
        # No piece goes over a cut, so nothing can merge over it and what lies between two cuts is encoded on its own.
        alone = "".join(c for c in "\n\t" if not any(c in p for p in long))
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in long)
        self.single = self.prefix and not self.squeeze and not crossing and "\n" in alone
        one = f"[{alone}]|" if alone else ""
        self.pairs = {a + b for p in long for a, b in zip(p, p[1:])}
        self.unit = re.compile(r"(?s).+" if crossing else f"{one}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+")

    def _piece(self, piece: dict, scores: dict[str, float]) -> None:
        text, kind, id, self.size = piece[1].decode(), piece.get(3, NORMAL), self.size, self.size + 1
        if kind == NORMAL:
            self.ids[text], scores[text] = id, struct.unpack("<f", piece.get(2, bytes(4)))[0]
        elif kind == BYTE:
            self.bytes[int(text[3:5], 16)] = id
        elif kind == UNKNOWN:
            self.unknown = id
        elif kind != CONTROL:
            raise ValueError("User-defined and unused pieces are not supported")
        elif text == "</s>":
            self.end = id

    def written(self, text: str) -> str:
        """The text with the vocabulary's spaces."""
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return (" " * (self.prefix and text != "") + text).replace(" ", SPACE)


class Encoder(dict):
    """Ids of a text. Units between cuts are remembered, twice ``KNOWN`` at most."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            ids = self.cut(unit)
        if len(unit) <= LONGEST:
            if len(self) >= KNOWN:  # what was met since the last time stays within reach
                self.older = dict(self)
                self.clear()
            self[unit] = ids
        return ids

    def cut(self, unit: str) -> bytes:
        """Ids of a unit, cut between neighbours that no piece holds next to each other."""
        pairs = self.vocabulary.pairs
        cuts = [i for i, pair in enumerate(map(str.__add__, unit, unit[1:]), 1) if pair not in pairs]
        if not cuts:
            return self.merged(unit)
        return b"".join(self[unit[a:b]] for a, b in zip([0, *cuts], [*cuts, len(unit)]))

    def merged(self, unit: str) -> bytes:
        """Merge adjacent symbols, the pair of the greatest score first and the leftmost of equal ones.

        The agenda holds every pair of neighbours that is a piece; that of a short unit is searched, that of a long one a heap.
        There an entry whose ends have meanwhile merged with others no longer spells its piece and is passed over.
        """
        place = self.vocabulary.place
        symbols: list[str | None] = list(unit)
        n = len(symbols)
        if n <= SHORT:
            agenda = [place.get(piece, NONE) for piece in map(str.__add__, unit, unit[1:])]
            while agenda and (first := min(agenda)) < NONE:
                left = agenda.index(first)
                piece = symbols[left] = symbols[left] + symbols.pop(left + 1)
                del agenda[left]
                if left < len(agenda):
                    agenda[left] = place.get(piece + symbols[left + 1], NONE)
                if left:
                    agenda[left - 1] = place.get(symbols[left - 1] + piece, NONE)
            return self.spelled(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # An entry is the pair's place in the order of scores and, below it, where the pair stands.
        agenda = [place[piece] * n + left for left, piece in enumerate(map(str.__add__, unit, unit[1:])) if piece in place]
        heapify(agenda)
        while agenda:
            rank, left = divmod(heappop(agenda), n)
            first, right = symbols[left], after[left]
            if first is None or right == n:
                continue
            piece = first + symbols[right]
            if place.get(piece) != rank:
                continue
            symbols[left], symbols[right] = piece, None
            right = after[left] = after[right]
            if right < n:
                before[right] = left
                longer = piece + symbols[right]
                if longer in place:
                    heappush(agenda, place[longer] * n + left)
            left = before[left]
            if left >= 0:
                longer = symbols[left] + piece
                if longer in place:
                    heappush(agenda, place[longer] * n + left)
        return self.spelled(symbols)

    def spelled(self, symbols: list[str | None]) -> bytes:
        """Ids of the symbols that are left."""
        known = self.vocabulary.ids
        out: list[int] = []
        for symbol in symbols:
            if symbol is None:
                continue
            id = known.get(symbol)
            if id is not None:
                out.append(id)
            elif self.vocabulary.bytes:
                out.extend(self.vocabulary.bytes[b] for b in symbol.encode())
            else:
                out.append(self.vocabulary.unknown)
        return array("i", out).tobytes()

    def __call__(self, text: str, end: bool = True) -> np.ndarray:
        if self.vocabulary.single and text and text[0] != " " and "  " not in text and SPACE not in text:
            units = (SPACE + text.replace(" ", f" {SPACE}").replace("\n", " \n ")).split(" ")  # one space before every word
        else:
            units = self.vocabulary.unit.findall(self.vocabulary.written(text))
        ids = np.frombuffer(b"".join(map(self.__getitem__, units)) + array("i", [self.vocabulary.end] * end).tobytes(), np.intc)
        if self.vocabulary.bytes or len(ids) < 2:
            return ids
        unknown = ids == self.vocabulary.unknown  # a run of unknown symbols is one
        return ids[np.append(True, ~(unknown[1:] & unknown[:-1]))]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder a worker process, so that tasks after the first find its units."""
    return Encoder(Vocabulary(path))


def encoded(docs: DataFrame, path: str, end: bool = True, check: bool = True, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``ids``, ``decoded`` (the library's text of the ids) and ``agrees``.

    The ids come from the agenda. With ``check`` the sentencepiece library encodes every Arrow batch too and ``agrees`` says
    whether it gives the same ids (null without). ``end`` adds the end id.

    Null and empty texts are the end id alone (no id without ``end``) and decode to the empty text. Rows that repeat a doc_id
    or have none are encoded like any other; an empty table gives no rows. Texts of any length are taken whole. Other
    columns are not read. The model file must be at the same path on every executor.
    """
    def run(batches):
        import sentencepiece

        encode, library = encoder(path), sentencepiece.SentencePieceProcessor(model_file=path)
        for batch in slices(batches, BATCH):
            contents = [t or "" for t in batch.column("text").to_pylist()]
            ids = [encode(t, end) for t in contents]
            if check:
                lists = library.encode(contents, add_eos=end, num_threads=1)
                agrees = [len(a) == len(b) and array("i", b).tobytes() == a.tobytes() for a, b in zip(ids, lists)]
                lists = [b if same else a.tolist() for a, b, same in zip(ids, lists, agrees)]
            else:
                lists, agrees = [a.tolist() for a in ids], [None] * len(ids)
            starts = np.cumsum([0, *map(len, ids)])
            column = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate([*ids, np.zeros(0, np.intc)]), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), column, pa.array(library.decode(lists, num_threads=1), pa.string()), pa.array(agrees, pa.bool_())],
                names=["doc_id", "ids", "decoded", "agrees"])

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string, agrees boolean")


def decoded(rows: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns and the library's text of the ids under ``name``. Null ids and ids of no piece give a null text."""
    def run(batches):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        for batch in slices(batches, BATCH):
            lists = batch.column("_ids").to_pylist()
            good = [x is not None and all(i is not None and 0 <= i < size for i in x) for x in lists]
            found = iter(library.decode([x for x, ok in zip(lists, good) if ok], num_threads=1) if any(good) else [])
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array([next(found) if ok else None for ok in good], pa.string())], names=["_row", "_text"])

    kind = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"))
    given = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), F.col(f"`{ids}`").alias("_ids"))
    out = given.mapInArrow(run, kind.schema.add("_text", "string"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in rows.columns], F.col("_text").alias(name))

"""License scans: k-gram hits vote for diagonals, neighbouring diagonals merge, spans are verified in the text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.common import packed, schema_of, slices, texts

LONG_GRAM, SHORT_GRAM = 4, 2
DRIFT = 3  # words that may be missing or inserted between two stretches of one template
LEAST = 0.75  # share of a template's words that a span must have in order
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

#: The phrases that the scan must find and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Opening and granting sentences of public license texts and notices, and their labels.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "has waived all copyright and related or neighboring rights": "cc0",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

#: A-Z in lower case; ASCII letters, digits and everything beyond ASCII stay; the rest parts words.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Template:
    label: str
    words: list[bytes]
    base: bool

    @property
    def gram(self) -> int:
        return SHORT_GRAM if self.base else LONG_GRAM


def templates(phrases: dict[str, str] = PHRASES, texts_: dict[str, str] = TEMPLATES) -> list[Template]:
    return [Template(label, phrase.encode().split(), True) for phrase, label in phrases.items()] + [
        Template(label, text.encode().split(), False) for text, label in texts_.items()]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def grams(words: list[bytes]) -> np.ndarray:
    """Rolling hashes: of every two words, then of every four, by start; those beyond the end are hashed as if padded."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))

    def join(x, step, salt):
        out = x * M1 + salt
        out[:-step] += (x[step:] ^ (x[step:] >> np.uint64(31))) * M2
        return out ^ (out >> np.uint64(29))

    two = join(h, 1, np.uint64(1))
    return np.concatenate([two, join(two, 2, np.uint64(2))])


def template_grams(spark, known: list[Template]) -> DataFrame:
    """``hash``, ``template``, ``tpos``: every k-gram of every template; as many rows as the templates have words, at most."""
    rows = []
    for i, t in enumerate(known):
        both, n = grams(t.words), len(t.words)
        own = both[:n] if t.gram == SHORT_GRAM else both[n:]
        rows += [(int(h), i, p) for p, h in enumerate(own[:n - t.gram + 1].view(np.int64).tolist())]
    return spark.createDataFrame(rows, "hash long, template int, tpos int")


def diagonals(docs: DataFrame, known: list[Template]) -> DataFrame:
    """``doc_id``, ``template``, ``first``, ``last``, ``votes`` of merged diagonals of ``doc_id`` and ``text`` rows.

    All rolling k-gram hashes are joined with the template positions. A hit at word p of k-gram t votes for the diagonal
    p - t: there the template would begin if nothing were inserted. Of one template in one document, diagonals at most
    ``DRIFT`` apart are one span; a base phrase has to stand word for word, so its diagonals stay apart.
    """
    def roll(batches):
        for batch in slices(batches):
            out, sizes = [], []
            for text in texts(batch):
                words = words_of(text)
                sizes.append(len(words))
                out.append(grams(words).view(np.int64) if words else np.zeros(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])])
            lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(np.concatenate(out) if out else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), lists.cast(pa.list_(pa.int64()))], names=["doc_id", "n", "grams"])

    rolled = docs.mapInArrow(roll, "doc_id long, n long, grams array<long>")
    hits = rolled.select("doc_id", "n", F.posexplode("grams").alias("_at", "hash"))
    # The templates are a fixed list of a few hundred k-grams, so this side is bounded.
    joined = hits.join(F.broadcast(template_grams(docs.sparkSession, known)), "hash")
    pos = F.pmod(F.col("_at"), F.col("n"))
    lines = joined.groupBy("doc_id", "template", (pos - F.col("tpos")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.min(pos).alias("first"), F.max(pos).alias("last"))
    base = F.array_contains(F.array(*[F.lit(i) for i, t in enumerate(known) if t.base]), F.col("template"))
    along = Window.partitionBy("doc_id", "template").orderBy("diagonal")  # bounded by the document's own hits
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    new = F.when(gap.isNull() | base | (gap > DRIFT), 1).otherwise(0)
    spans = lines.withColumn("_new", new).withColumn("_span", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return spans.groupBy("doc_id", "template", "_span").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"), F.min("diagonal").alias("diagonal")).drop("_span")


def in_order(found: list[bytes], wanted: list[bytes]) -> int:
    """Length of the longest common subsequence of two short word lists."""
    row = np.zeros(len(wanted) + 1, np.int64)
    for word in found:
        above = row.copy()
        for j, w in enumerate(wanted):
            row[j + 1] = above[j] + 1 if w == word else max(above[j + 1], row[j])
    return int(row[-1])


def scan(docs: DataFrame, known: list[Template] | None = None, least: float = LEAST, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``rest`` (a struct of the other columns), ``n_words``, ``spans`` (label, base, start,
    length, score) of all verified places, in order.

    A base phrase is a place where its words stand consecutively. A template's span is verified against the text: the share
    of its words that stand there in order has to reach ``least``. Null and empty texts have no words and no spans; null and
    repeated doc_ids are scanned like any other, each row over its own whole text. An empty table gives no rows.
    """
    known = known or templates()
    rows = packed(docs, text, id)
    need = F.array(*[F.lit(len(t.words) - t.gram + 1 if t.base else max(1, (len(t.words) - t.gram + 1) // 4)) for t in known])
    kept = diagonals(rows.select("doc_id", "text"), known).filter(F.col("votes") >= F.element_at(need, F.col("template") + 1))
    place = F.struct("template", "first", "last", "diagonal")
    per = kept.groupBy("doc_id").agg(F.array_sort(F.collect_list(place)).alias("places"))  # bounded by the document's own hits
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id"))
    joined = rows.alias("d").join(per.alias("p"), same, "left").select("d.doc_id", "d.text", "d.rest", "p.places")

    def verify(batches):
        for batch in slices(batches):
            sizes, out = [], []
            for content, places in zip(texts(batch), batch.column("places").to_pylist()):
                words, spans = words_of(content), []
                sizes.append(len(words))
                for p in places or ():
                    t = known[p["template"]]
                    if t.base:
                        if words[p["diagonal"]:p["diagonal"] + len(t.words)] == t.words and p["diagonal"] >= 0:
                            spans.append({"label": t.label, "base": True, "start": p["diagonal"], "length": len(t.words), "score": 1.0})
                    else:
                        # Several copies lie far apart on the diagonals; one span is no longer than the template and its drift.
                        a, b = max(0, p["first"] - len(t.words)), min(len(words), p["last"] + t.gram + len(t.words))
                        score = in_order(words[a:b], t.words) / len(t.words)
                        if score >= least:
                            spans.append({"label": t.label, "base": False, "start": p["first"], "length": p["last"] + t.gram - p["first"], "score": score})
                out.append(sorted(spans, key=lambda s: (s["start"], s["label"])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rest"), pa.array(sizes, pa.int64()), pa.array(out, SPANS)],
                                             names=["doc_id", "rest", "n_words", "spans"])

    kind = "array<struct<label:string,base:boolean,start:long,length:long,score:double>>"
    return joined.mapInArrow(verify, schema_of(joined.select("doc_id", "rest"), n_words="long", spans=kind))


SPANS = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64())]))


def digest(scanned: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` (the best
    span's share; 0 without any) of scanned documents."""
    base = F.filter("spans", lambda s: s["base"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["start"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"))

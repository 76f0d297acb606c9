"""Agenda merges against the sentencepiece library: random texts, whole tables, odd rows."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from skyframe.llm import subwords

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("seed", range(20))
def test_random_texts(library, seed):
    rng, encode = random.Random(seed), subwords.Encoder(subwords.Vocabulary(PATH))
    alphabet = list("abcdeethin   \n\n\t\r▁ 漢字éñ😀\x00{}();<s/>0x.,-=") + ["the", " of", "</s>", "<0x0A>", "  ", "ing", " ", " "]
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80)))
        assert encode(text).tolist() == library.encode(text, add_eos=True), repr(text)
        assert encode(text, end=False).tolist() == library.encode(text)


def test_units_are_cut_where_no_piece_goes(library):
    vocabulary = subwords.Vocabulary(PATH)
    encode = subwords.Encoder(vocabulary)
    text = "some words, with (marks) and\nlines\t and  spaces."
    assert np.frombuffer(encode.merged(vocabulary.written(text)), np.intc).tolist() == encode(text, end=False).tolist() == library.encode(text)


def test_a_long_text_without_spaces(library):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh漢") for _ in range(200_000))
    assert subwords.Encoder(subwords.Vocabulary(PATH))(text).tolist() == library.encode(text, add_eos=True)


def test_refuses_what_is_no_merge_vocabulary(tmp_path):
    other = tmp_path / "other.model"
    other.write_bytes(bytes([0x12, 2, 0x18, 1]))  # a trainer of type 1
    with pytest.raises(ValueError, match="merge-type"):
        subwords.Vocabulary(str(other))


def test_documents(spark, docs, rows, library):
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.ids, r.decoded, r.agrees) for r in subwords.encoded(docs, PATH).collect())
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_eos=True)
        want.append((-1 if doc_id is None else doc_id, ids, library.decode(ids), True))
    assert got == sorted(want)


def test_empty_table_and_no_check(spark, none, docs):
    assert subwords.encoded(none, PATH).collect() == []
    assert {r.agrees for r in subwords.encoded(docs, PATH, check=False).collect()} == {None}


def test_decoded_column(spark, library):
    rows = spark.createDataFrame([(1, library.encode("Hello there.")), (2, None), (3, []), (4, [5, 99_999_999]), (5, [None])], "_row int, ids array<int>")
    got = {r["_row"]: r["decoded"] for r in subwords.decoded(rows, PATH).collect()}
    assert got == {1: "Hello there.", 2: None, 3: "", 4: None, 5: None}


def test_whole_table(spark, library):
    from skyframe.llm.plans import op12_subword_round_trip

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op12_subword_round_trip(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.agrees) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), True)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()

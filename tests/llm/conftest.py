import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi", "Omikron", "pi", "rho", "sigma", "tau"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, _lost string, nth int, rest string"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


def corpus():
    """Documents with copies, near copies, shared lines and passages, nulls, empty and long texts, and columns whose names
    an operator might use itself."""
    rng = random.Random(5)
    passage, line = sentence(rng, 45), "This Line stands in many documents."
    texts = [None, "", " \t ", "one", "one two", "\n\n", "A  b\x0bc\x1cd e f\r\ng"]
    for i in range(40):
        texts.append("\n".join(sentence(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 5))))
    for i in range(6):
        texts.append(texts[10])
        words = texts[12 + i].split(" ")
        words[len(words) // 2] = "changed" + str(i)
        texts.append(" ".join(words))
        texts.append(sentence(rng, 8) + " " + passage + " " + sentence(rng, 5) + ("\n  " + line.upper() + " \n" if i % 2 else "\n" + line))
    texts.append("und " * 300)
    texts.append(sentence(rng, 6000))
    rows = [(i * 3 % 211, t, "en", [None, "b", "a", "c", "é"][i % 5], None, "x", "y", 1, "z") for i, t in enumerate(texts)]
    rows += [(None, texts[15], None, "a", 1, None, None, None, None), (None, passage, None, None, 1, None, None, None, None)]
    rows += [rows[20], rows[20]]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)

"""Toxicity by a classifier chain: linear models in sequence, each fed the out-of-fold probabilities of those before it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import packed, schema_of, slices, texts, unpacked
from skyframe.session import written

BUCKETS = 1 << 18
SAMPLE = 12_000  # labelled documents that a chain is trained on at most
FOLDS = 3
CHANCE = 6.0  # standard deviations by which a feature's share must differ between the classes
KNOWN = 80_000  # words with their features or weights that a task remembers
#: ASCII letters in lower case; everything else in ASCII parts words.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def features(word: bytes) -> list[int]:
    """Hashed features of a word: itself, its beginning and its end."""
    h = xxhash.xxh3_64_intdigest
    out = [h(word, 1) % BUCKETS]
    for n in (4, 6):
        if len(word) > n:
            out += [h(word[:n], 2) % BUCKETS, h(word[-n:], 3) % BUCKETS]
    return out


def vocabulary(text: bytes) -> set[bytes]:
    """Distinct words of a text, ASCII lower case."""
    return set(text.translate(LETTERS).split())


@dataclass
class Chain:
    """Trained models: for each category the weights of the hashed features, of the earlier categories, and a bias."""

    categories: list[str]
    weights: np.ndarray  # categories x BUCKETS
    earlier: np.ndarray  # categories x categories, strictly lower triangle
    bias: np.ndarray
    threshold: np.ndarray


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def telling(bags: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Which features occur in one class's rows so much more often than in the other's that chance is no explanation."""
    ones, rows = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bag, positive in zip(bags, y):
        once = np.unique(bag)  # a feature counts once a row
        rows[once] += 1
        if positive:
            ones[once] += 1
    p, n = max(y.sum(), 1.0), max((1 - y).sum(), 1.0)
    share = rows / (p + n)
    gap = ones / p - (rows - ones) / n
    return (rows >= 5) & (np.abs(gap) > CHANCE * np.sqrt(share * (1 - share) * (1 / p + 1 / n) + 1e-12))


def fit(bags: list[np.ndarray], extra: np.ndarray, y: np.ndarray, rounds: int = 80, ridge: float = 1e-5, rate: float = 0.2):
    """Logistic regression over bags of features and dense ``extra`` columns, by full-batch steps scaled per coordinate.
    Only telling features have weights."""
    used = telling(bags, y)
    bags = [bag[used[bag]] for bag in bags]
    row = np.repeat(np.arange(len(bags)), [len(bag) for bag in bags])
    index = np.concatenate(bags) if bags else np.zeros(0, np.int32)
    w, v, b = np.zeros(BUCKETS), np.zeros(extra.shape[1]), 0.0
    gw, gv, gb = np.full(BUCKETS, 1e-8), np.full(extra.shape[1], 1e-8), 1e-8
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    cost = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / len(y)
    for _ in range(rounds):
        z = extra @ v + b + np.bincount(row, weights=w[index], minlength=len(y))
        r = (sigmoid(z) - y) * cost
        d = np.bincount(index, weights=r[row], minlength=BUCKETS) + ridge * w
        gw += d * d
        w -= rate * d / np.sqrt(gw)
        d = extra.T @ r + ridge * v
        gv += d * d
        v -= rate * d / np.sqrt(gv)
        gb += r.sum() ** 2
        b -= rate * r.sum() / np.sqrt(gb)
    return w, v, b


def margins(w, v, b, bags, extra):
    return extra @ v + b + np.array([w[bag].sum() for bag in bags])


def labelled(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int) -> DataFrame:
    """At most ``sample`` labelled documents, the first by a hash of their id, as feature bags: ``doc_id``, ``bag``, ``y``."""
    per = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.max(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(categories)]).dropna()
    chosen = per.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", F.array(*[f"_{i}" for i in range(len(categories))]).alias("y"))

    def bags(batches):
        known = {}
        for batch in slices(batches):
            out = []
            for text in texts(batch):
                own = []
                for word in vocabulary(text):
                    if word not in known:
                        if len(known) >= KNOWN:
                            known.clear()
                        known[word] = features(word)
                    own += known[word]
                out.append(np.array(own, np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary()), batch.column("y")], names=["doc_id", "bag", "y"])

    # The sample's bound makes its ids a safe broadcast; only its documents are hashed.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = rows.mapInArrow(bags, "doc_id long, bag binary, y array<double>")
    # Rows that repeat a doc_id train once, with the smallest bag.
    return found.groupBy("doc_id").agg(F.min(F.struct("bag", "y")).alias("r")).select("doc_id", "r.bag", "r.y")


def train(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int = SAMPLE, folds: int = FOLDS) -> Chain:
    """Fit the chain on a bounded sample of labelled rows.

    For each category ``folds`` models, each without one fold, give every sampled row a probability from a model that did
    not see it; the later categories are trained on those. One more model on all rows scores the corpus. The fits of a
    category run as parallel tasks, each over the sample's bags; the driver sees weights and the sample's probabilities.
    Without labelled rows (or with one class only) a category's models are zero and reject nothing.
    """
    rows = written(labelled(docs, labels, categories, sample).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(folds)).cast("int")), "bags")
    n = len(categories)
    chain = Chain(categories, np.zeros((n, BUCKETS)), np.zeros((n, n)), np.zeros(n), np.full(n, 0.5))
    seen: dict[int, list[float]] = {}  # logits of the earlier categories, of the bounded sample
    for c in range(n):
        known = docs.sparkSession.sparkContext.broadcast(seen)
        models = F.explode(F.array(*[F.lit(k) for k in range(-1, folds)])).alias("model")
        found = rows.select("*", models).groupBy("model").applyInArrow(fold_fit(c, known), "doc_id long, z double, y double, model binary").collect()
        z, y = [], []
        for row in found:
            if row["model"] is not None:
                both = np.frombuffer(row["model"], np.float64)
                chain.weights[c], chain.earlier[c, :c], chain.bias[c] = both[:BUCKETS], both[BUCKETS:], row["z"]
            else:
                seen.setdefault(row["doc_id"], []).append(float(sigmoid(row["z"])))
                z.append(row["z"])
                y.append(row["y"])
        chain.threshold[c] = threshold(np.array(z), np.array(y))
        known.unpersist()
    return chain


def fold_fit(c, known):
    """The task that fits category ``c`` without one fold (-1: on all rows) and scores that fold."""
    def run(table):
        which = table.column("model")[0].as_py()
        table = table.sort_by([("doc_id", "ascending")])
        ids, fold = table.column("doc_id").to_numpy(), table.column("fold").to_numpy()
        bags = [np.frombuffer(b, np.int32) for b in table.column("bag").to_pylist()]
        y = np.array(table.column("y").to_pylist(), np.float64)[:, c]
        extra = np.array([known.value.get(int(i), []) for i in ids], np.float64).reshape(len(ids), c)
        inside = fold != which
        if not inside.any() or y[inside].min() == y[inside].max():
            w, v, b = np.zeros(BUCKETS), np.zeros(c), -40.0
        else:
            w, v, b = fit([x for x, k in zip(bags, inside) if k], extra[inside], y[inside])
        if which < 0:
            return pa.table({"doc_id": pa.array([None], pa.int64()), "z": pa.array([float(b)]), "y": pa.array([0.0]),
                             "model": pa.array([np.concatenate([w, v]).tobytes()], pa.binary())})
        out = ~inside
        z = margins(w, v, b, [x for x, k in zip(bags, out) if k], extra[out]) if out.any() else np.zeros(0)
        return pa.table({"doc_id": pa.array(ids[out], pa.int64()), "z": pa.array(z), "y": pa.array(y[out]), "model": pa.array([None] * int(out.sum()), pa.binary())})

    return run


def threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The probability at which the out-of-fold F1 is best, in the middle of the gap to the next lower score, but at least
    one half: what the models hold for clean is not rejected. One class alone: nothing is."""
    if not len(z) or y.max() == y.min():
        return 1.0
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    at = int(np.argmax(f1))
    low = z[order][at + 1] if at + 1 < len(z) else z[order][at] - 1
    return max(0.5, float(sigmoid((z[order][at] + low) / 2)))


def scores(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id`` and ``rest`` of the given rows with ``p``, the probabilities of the chain's categories in order."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        model = sent.value
        n = len(model.categories)
        known: dict[bytes, tuple[float, ...]] = {}
        for batch in slices(batches):
            z = np.zeros((batch.num_rows, n))
            for i, text in enumerate(texts(batch)):
                own = vocabulary(text)
                new = [w for w in own if w not in known]
                if len(known) + len(new) > KNOWN:
                    known.clear()
                    new = own
                for word in new:
                    known[word] = tuple(model.weights[:, features(word)].sum(axis=1).tolist())
                if own:
                    z[i] = np.array([known[w] for w in own]).sum(axis=0)
            p = np.zeros_like(z)
            for c in range(n):
                p[:, c] = sigmoid(z[:, c] + model.bias[c] + p[:, :c] @ model.earlier[c, :c])
            names = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(p.tolist(), pa.list_(pa.float64()))], names=[*names, "p"])

    kept = docs.drop("text")
    return docs.mapInArrow(run, schema_of(kept, p="array<double>"))


def toxic(docs: DataFrame, labels: DataFrame, categories: list[str], reject: str, sample: int = SAMPLE, folds: int = FOLDS,
          id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``rest`` (a struct of the other columns), ``text``, ``p`` (a probability per category) and ``rejected``:
    whether category ``reject`` reaches its threshold.

    ``labels`` has ``doc_id`` and a 0/1 column per category, in the chain's order; rows with a null there do not train.
    Null and empty texts have no words and get the bias alone. Every document is scored over its whole text; null and
    repeated doc_ids are scored like any other. An empty table gives no rows, a table without labelled rows rejects none.
    """
    rows = packed(docs, text, id)
    chain = train(rows.select("doc_id", "text"), labels, categories, sample, folds)
    at = categories.index(reject)
    scored = scores(rows.withColumn("content", F.col("text")), chain)
    return scored.select("doc_id", "rest", F.col("content").alias("text"), "p", (F.col("p")[at] >= F.lit(float(chain.threshold[at]))).alias("rejected"))


def without_toxic(docs: DataFrame, labels: DataFrame, categories: list[str], reject: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    return unpacked(toxic(docs, labels, categories, reject, id=id, text=text).filter("not rejected"), docs, text)

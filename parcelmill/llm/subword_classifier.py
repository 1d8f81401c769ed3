"""Quality classifier over learned subword vectors.

A word's vector is the mean of the hashed vectors of the word and of its character n-grams; a document's is
the mean over its words, and a softmax layer gives the class. Words that a text repeats (the word before
again, passages of five words, too few words at all) add tokens of their own. Vectors and layer are learned
by stochastic gradient descent in numpy on a bounded, class-balanced sample of labelled documents; all
documents are scored. As the model is linear in a document's mean, scoring keeps one number per known word.
"""

import io
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from parcelmill.llm.common import crc32_of, utf8
from parcelmill.llm.quality_ledger import measure

#: Documents of each class that the fit may use, those with the smallest hashes.
SAMPLE = 3000
BUCKETS, WIDTH, EPOCHS, BATCH, RATE = 1 << 17, 8, 4, 32, 0.5
NGRAMS = (3, 5)
#: Words a worker remembers before it starts anew; bounds its memory.
REMEMBERED = 500_000


def features(word: bytes) -> list[int]:
    """Buckets of a word and of its character n-grams, borders marked. Tokens that are no words begin with \\x01."""
    if word[:1] == b"\x01":
        return [crc32(word) & (BUCKETS - 1)]
    data = b"<" + word + b">" if word.isascii() else ("<" + word.decode("utf-8", "replace") + ">").encode("utf-32-le")
    step = 1 if word.isascii() else 4
    found = [crc32(data) & (BUCKETS - 1)]
    if len(data) <= 64 * step:  # a longer string is no word: its n-grams say little and cost much
        for n in NGRAMS:
            found += [crc32(data[i : i + n * step]) & (BUCKETS - 1) for i in range(0, len(data) - n * step + 1, step)]
    return found


def tokens(text: str | None) -> Counter:
    """How often each word and each token for repetition occurs."""
    counts = Counter(utf8(text).split())
    m = measure(text)
    n_words, n_repeated, n_stutter = m[0], m[4], m[6]
    for token, n in ((b"\x01again", n_repeated), (b"\x01same", 3 * n_stutter), (b"\x01few", 10 * (n_words < 10)), (b"\x01any", 1)):
        if n:
            counts[token] += n
    return counts


class _Words:
    """Feature lists of words, flat, with the place where each begins."""

    def __init__(self):
        self.ids: dict[bytes, int] = {}
        self.flat: list[int] = []
        self.sizes: list[int] = []

    def id(self, word: bytes) -> int:
        if word not in self.ids:
            self.ids[word] = len(self.ids)
            found = features(word)
            self.flat += found
            self.sizes.append(len(found))
        return self.ids[word]


def fit(texts: list[Counter], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, layer and bias of the classes 0 and 1."""
    words = _Words()
    docs = []
    for counts in texts:
        ids = np.array([words.id(w) for w in counts], np.int64)
        share = np.array(list(counts.values()), np.float32)
        docs.append((ids, share / share.sum()))
    flat, sizes = np.array(words.flat, np.int64), np.array(words.sizes, np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (BUCKETS, WIDTH)).astype(np.float32) / WIDTH
    layer, bias = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    steps, step = max(1, EPOCHS * -(-len(docs) // BATCH)), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for at in range(0, len(docs), BATCH):
            some = order[at : at + BATCH]
            rate, step = RATE * (1 - step / steps), step + 1
            place = np.repeat(np.arange(len(some)), [len(docs[d][0]) for d in some])
            ids, share = np.concatenate([docs[d][0] for d in some]), np.concatenate([docs[d][1] for d in some])
            kinds, ids = np.unique(ids, return_inverse=True)
            inner = np.repeat(begins[kinds] - np.concatenate([[0], np.cumsum(sizes[kinds])[:-1]]), sizes[kinds]) + np.arange(sizes[kinds].sum())
            feats, heads = flat[inner], np.concatenate([[0], np.cumsum(sizes[kinds])[:-1]])
            vectors = np.add.reduceat(table[feats], heads, axis=0) / sizes[kinds, None]
            mean = np.stack([np.bincount(place, share * vectors[ids, k], len(some)) for k in range(WIDTH)], 1)
            z = mean @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), labels[some]] -= 1
            down = p @ layer.T
            layer -= rate * (mean.T @ p).astype(np.float32) / len(some) * 4
            bias -= rate * p.mean(axis=0).astype(np.float32)
            each = np.stack([np.bincount(ids, share * down[place, k], len(kinds)) for k in range(WIDTH)], 1)
            grad = np.repeat(each / sizes[kinds, None], sizes[kinds], axis=0)
            touched, feats = np.unique(feats, return_inverse=True)
            table[touched] -= 4 * rate * np.stack([np.bincount(feats, grad[:, k], len(touched)) for k in range(WIDTH)], 1).astype(np.float32)
    return table, layer, bias


def _fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row: the model, as bytes."""
    part = [(tokens(t), q) for b in batches for t, q in zip(b["text"], b["quality"], strict=True)]
    if part:
        table, layer, bias = fit([t for t, _ in part], np.array([q for _, q in part], np.int64))
        # the layer's difference turns each bucket's vector into one number
        one = (table @ (layer[:, 1] - layer[:, 0])).astype(np.float32)
        out = io.BytesIO()
        np.savez_compressed(out, one=one, bias=np.float64(bias[1] - bias[0]))
        yield pd.DataFrame({"model": [out.getvalue()]})


def sample_labels(labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", per_class: int = SAMPLE, folds: int = 5) -> DataFrame:
    """Ids and labels of the sample: of each class the rows of smallest hash, none held out. A doc_id with
    several labels has the largest."""
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & (crc32_of(doc_id) % folds != 0))
        .groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).alias("quality"))
    )
    return known.filter("quality = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).unionByName(
        known.filter("quality = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    )


def score_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = SAMPLE, folds: int = 5,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row `doc_id, held_out, score, predicted`.

    Rows whose CRC-32 of the id is divisible by `folds` are held out; labels of others, up to `per_class` of
    each class, are learned from. Classes are balanced in the fit, and the shares of the labelled rows are put
    back into the score. Null and empty texts have the score of a text of no words. Without any label every
    score is 0.5. Repeated rows each get a row; other columns are left out; no rows give no rows.
    """
    spark = docs.sparkSession
    # at most 2 * per_class ids and labels: bounded, so their broadcast is
    chosen = F.broadcast(sample_labels(labels, "doc_id", "quality", per_class, folds))
    sample = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(chosen, "doc_id").select("text", "quality")
    model = sample.repartition(1).mapInPandas(_fitted, "model binary").first()
    counts = labels.filter(F.col("quality").isin(0, 1) & (crc32_of("doc_id") % folds != 0)).groupBy("quality").count().collect()
    by_class = {r["quality"]: r["count"] for r in counts}
    shift = float(np.log((by_class.get(1, 0) + 1) / (by_class.get(0, 0) + 1)) - np.log((min(by_class.get(1, 0), per_class) + 1) / (min(by_class.get(0, 0), per_class) + 1)))
    shared = spark.sparkContext.broadcast(bytes(model["model"]) if model else None)

    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = _scorer(shared.value, shift)
        for part in texts:
            yield pd.Series([score(t) for t in part], dtype="float64")

    score = pandas_udf(scores, "double").asNondeterministic()
    return docs.select(
        F.col(doc_id).alias("doc_id"), (crc32_of(doc_id) % folds == 0).alias("held_out"), score(text).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _scorer(model: bytes | None, shift: float):
    if model is None:
        return lambda text: 0.5
    with np.load(io.BytesIO(model)) as stored:
        one, bias = stored["one"].tolist(), float(stored["bias"])
    known: dict[bytes, float] = {}

    def score(text: str | None) -> float:
        total = n = 0.0
        for word, count in tokens(text).items():
            value = known.get(word)
            if value is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = features(word)
                value = known[word] = sum([one[f] for f in found]) / len(found)
            total += count * value
            n += count
        z = total / n + bias + shift
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))

    return score

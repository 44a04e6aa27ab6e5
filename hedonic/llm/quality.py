"""Quality classifier: random-indexing word vectors, pooled, and a small neural network.

Every token has a fixed sparse random index vector. A token's word vector adds
up the index vectors of its neighbours over *all* documents (tokens are hashed
to ``BUCKETS`` rows, so the table has one size whatever the vocabulary) plus its
own. A document is the mean of its tokens' vectors; a two-layer numpy network
scores it, and a temperature fitted on a held-back part of the training rows
calibrates the probabilities.

Tokens are runs of letters, digits or other signs. Marks for all-capital words
and for a word said again are tokens too, so style reaches the vectors.

Scale: one map collects sums in a table of bounded size per task, combined by
Spark; one map pools and scores. Only the table, at most ``TRAIN_ROWS`` pooled
training rows and the network pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm import words as W
from hedonic.llm.frames import open_frame

BUCKETS = 1 << 14
DIM = 64
#: Nonzero entries of an index vector, and neighbours on each side that count.
SPARSE, REACH = 4, 2
#: Labelled rows that the network is fitted on, at most: those of smallest hashed id.
TRAIN_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 128, 3e-3, 1e-4
LEAST_STEPS = 1500
THRESHOLD = 0.7
#: Characters of text, and tokens, worked on at a time.
TEXT_CHARS, TOKENS = 1_000_000, 1 << 16
SEED = 11

_CLASS = np.full(256, 3, np.uint8)
_CLASS[~W.NON_SPACE] = 0
_CLASS[W.ALNUM] = 1
_CLASS[0x30:0x3A] = 2
_UPPER = np.zeros(256, np.int64)
_UPPER[0x41:0x5B] = 1
_LETTER = np.zeros(256, np.int64)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = 1
CAPITALS, AGAIN = 0, 1  # buckets of the marks


def index_vectors(buckets: int = BUCKETS, dim: int = DIM, sparse: int = SPARSE, seed: int = SEED):
    """(places, signs) of each bucket's nonzero entries."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, dim, (buckets, sparse)), rng.choice([-1.0, 1.0], (buckets, sparse))


def tokens_of(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each token with marks put in, index of each text's first token and their number)."""
    raw, at = W.join_texts(texts)
    kind = _CLASS[raw]
    edge = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1], True]) if len(raw) else np.zeros(1, int)
    start, end = edge[:-1], edge[1:]
    there = kind[start] > 0 if len(start) else np.zeros(0, bool)
    start, end = start[there], end[there]
    w = W.Words(W.LOWER[raw], at, start, end, np.searchsorted(start, at))
    h = W.hash_words(w)
    bucket = (h >> np.uint64(40)).astype(np.int64) % (BUCKETS - 2) + 2
    word = kind[start] == 1
    upper = np.r_[0, np.cumsum(_UPPER[raw])]
    letters = np.r_[0, np.cumsum(_LETTER[raw])]
    n_upper = upper[end] - upper[start]
    capital = word & (n_upper > 0) & (n_upper == letters[end] - letters[start]) & (end - start > 1)
    last = np.zeros(len(h), np.uint64)  # the word before, over signs
    at_word = np.flatnonzero(word)
    last[at_word[1:]] = h[at_word[:-1]]
    doc = np.repeat(np.arange(len(at) - 1), np.diff(w.first))
    before = np.zeros(len(h), np.int64)
    before[at_word[1:]] = at_word[:-1]
    again = word & (last == h) & (doc == doc[before]) & (np.arange(len(h)) > 0)
    if len(at_word):
        again[at_word[0]] = False
    size = 1 + capital.astype(np.int64) + again
    place = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.int64)
    out[place] = np.where(capital, CAPITALS, np.where(again, AGAIN, bucket))
    both = capital & again
    out[place[both] + 1] = AGAIN
    marked = size > 1
    out[place[marked] + size[marked] - 1] = bucket[marked]
    return out, np.r_[0, np.cumsum(size)][w.first]


def context_sums(bucket: np.ndarray, first: np.ndarray, index) -> np.ndarray:
    """Sum of the index vectors of each bucket's neighbours within its text."""
    places, signs = index
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    total = np.zeros(BUCKETS * DIM)
    for lo in range(0, len(bucket), TOKENS):
        hi = min(len(bucket), lo + TOKENS)
        for shift in range(1, REACH + 1):
            a = np.arange(max(lo, shift), hi)
            a = a[doc[a] == doc[a - shift]]
            for me, other in ((a, a - shift), (a - shift, a)):
                flat = (bucket[me] * DIM)[:, None] + places[bucket[other]]
                total += np.bincount(flat.reshape(-1), signs[bucket[other]].reshape(-1), BUCKETS * DIM)
    return total.reshape(BUCKETS, DIM)


def learn_vectors(docs: DataFrame, text: str) -> np.ndarray:
    """Word vectors over all documents: one row per bucket, of unit length before its own index vector is added."""
    src = docs.select(F.col(text).cast("string").alias("body"))

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(), np.zeros((BUCKETS, DIM))
        for part in parts:
            texts = part.column("body").to_pylist()
            for lo, hi in W.batches(texts, TEXT_CHARS):
                total += context_sums(*tokens_of(texts[lo:hi]), index)
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), *(pa.array(total[used, k]) for k in range(DIM))],
            names=["bucket", *(f"v{k}" for k in range(DIM))])

    cols = [f"v{k}" for k in range(DIM)]
    sums = src.mapInArrow(scan, "bucket long, " + ", ".join(f"{c} double" for c in cols))
    rows = sums.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in cols]).collect()  # at most BUCKETS rows
    vectors = np.zeros((BUCKETS, DIM))
    for r in rows:
        vectors[r[0]] = r[1:]  # sums of whole numbers: the same in any order
    vectors = np.sign(vectors) * np.log1p(np.abs(vectors))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    places, signs = index_vectors()
    np.add.at(vectors, (np.arange(BUCKETS)[:, None], places), signs / np.sqrt(SPARSE))
    return vectors.astype(np.float32)


def pool(texts: list, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector of each text (zero without tokens)."""
    out = np.zeros((len(texts), DIM))
    for a, b in W.batches(texts, TEXT_CHARS):
        bucket, first = tokens_of(texts[a:b])
        n = np.diff(first)
        for lo in range(0, len(bucket), TOKENS):
            hi = min(len(bucket), lo + TOKENS)
            d0, d1 = np.searchsorted(first, lo, side="right") - 1, np.searchsorted(first, hi, side="left")
            cut = np.clip(first[d0:d1], lo, hi) - lo
            some = n[d0:d1] > 0
            at = cut[some]
            add = np.add.reduceat(vectors[bucket[lo:hi]], at, axis=0, dtype=np.float64)
            out[a + d0 + np.flatnonzero(some)] += add
        out[a:b] /= np.maximum(n, 1)[:, None]
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    prior: float | None = None  # the score of everything, if there was nothing to tell apart

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return z @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logit) - y * logit))


def train(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
    """Two-layer network by Adam; a fifth of the rows is held back for the temperature.

    Without rows of both labels every score is the label's share (0.5 without rows).
    """
    empty = Network(np.zeros(DIM), np.ones(DIM), np.zeros((DIM, 1)), np.zeros(1), np.zeros(1), 0.0)
    if len(y) == 0 or y.min() == y.max():
        empty.prior = float(y.mean()) if len(y) else 0.5
        return empty
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, fit = order[:len(y) // 5], order[len(y) // 5:]
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
    p = [rng.standard_normal((DIM, HIDDEN)) * np.sqrt(2 / DIM), np.zeros(HIDDEN),
         rng.standard_normal(HIDDEN) * np.sqrt(1 / HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    xs, step = (x - mean) / scale, 0
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(fit)))):
        rng.shuffle(fit)
        for lo in range(0, len(fit), BATCH):
            b = fit[lo:lo + BATCH]
            pre = xs[b] @ p[0] + p[1]
            z = np.maximum(pre, 0)
            logit = z @ p[2] + p[3][0]
            g = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y[b]) / len(b)
            back = np.outer(g, p[2]) * (pre > 0)
            grads = [xs[b].T @ back + DECAY * p[0], back.sum(axis=0), z.T @ g + DECAY * p[2], np.array([g.sum()])]
            step += 1
            for k, gr in enumerate(grads):
                m[k] += 0.1 * (gr - m[k])
                v[k] += 0.001 * (gr * gr - v[k])
                p[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    if len(held):
        logit = net.logits(x[held])
        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=lambda t: _loss(logit / t, y[held])))
    return net


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from: crc32 of the id as text, modulo 4, is 2 (null ids: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label_id: str = "doc_id", label: str = "quality", train_rows: int = TRAIN_ROWS) -> Model:
    """Word vectors from every text and the network from at most ``train_rows`` labelled rows that are not held out.

    An id with several labels takes the smallest; null ids and labels teach
    nothing; of documents that repeat an id each is a row.
    """
    inner, tags = open_frame(docs), open_frame(labels)
    vectors = learn_vectors(inner.df, inner.name(text))
    key, tag = F.col(tags.name(label_id)), F.col(tags.name(label)).cast("int")
    known = tags.df.where(key.isNotNull() & tag.isNotNull() & ~held_out(key)).groupBy(key.alias("id")).agg(
        F.min(tag).alias("label"))
    order = (F.xxhash64(F.col("id").cast("string")), F.col("id"))
    # of labels that have a document: a bounded sample of them, then their texts, bounded again as ids may repeat
    named = known.join(inner.df.select(F.col(inner.name(doc_id)).alias("doc")), F.col("id") == F.col("doc"), "left_semi")
    chosen = F.broadcast(named.orderBy(*order).limit(train_rows))
    src = inner.df.select(F.col(inner.name(doc_id)).alias("doc"), F.col(inner.name(text)).cast("string").alias("body"))
    src = src.join(chosen, F.col("doc") == F.col("id")).select("id", "body", "label")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = pool(part.column("body").to_pylist(), shared.value).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), pa.array([v.tobytes() for v in x], pa.binary())],
                names=["id", "label", "x"])

    schema = T.StructType([src.schema["id"], src.schema["label"], T.StructField("x", T.BinaryType())])
    rows = src.mapInArrow(scan, schema).orderBy(*order, "x").limit(train_rows).select("label", "x").collect()
    x = np.frombuffer(b"".join(r["x"] for r in rows), np.float32).reshape(-1, DIM).astype(np.float64)
    return Model(vectors, train(x, np.array([float(r["label"] > 0) for r in rows])))


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
          threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep`` (default: all) plus ``score`` (higher: good quality likelier) and ``predicted`` (0 or 1).

    Null and empty texts are scored too, as a text without tokens. Rows that
    repeat get one score each, the same; texts of any length are read whole; a
    kept column with the name of an output is replaced.
    """
    inner = open_frame(docs, keep, ("score", "predicted"))
    kept = inner.kept
    src = inner.df.select(*kept, F.col(inner.name(text)).cast("string").alias("body"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in parts:
            s = m.network.scores(pool(part.column("body").to_pylist(), m.vectors))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(s, pa.float64())],
                                             names=[*kept, "score"])

    out = src.mapInArrow(scan, T.StructType([*src.select(*kept).schema.fields,
                                             T.StructField("score", T.DoubleType())]))
    return inner.close(out.withColumn("predicted", (F.col("score") >= threshold).cast("int")), "score", "predicted")


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The contract's columns: ``doc_id, held_out, score, predicted``."""
    scored = score(docs, learn(docs, labels, doc_id, text), text, keep=[doc_id])
    return scored.select(doc_id, held_out(F.col(doc_id)).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents predicted to be of good quality, with their own columns."""
    inner = open_frame(docs)
    model = learn(inner.df, labels, inner.name(doc_id), inner.name(text))
    return inner.close(score(inner.df, model, inner.name(text)).where("predicted = 1"))

"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Each tree splits space at the median of a projection on the difference of two
random sample vectors (an extra coordinate turns largest inner product into
nearest direction). A query walks all trees through one priority queue, nearest
margin first, until the leaves it has opened hold its budget of rows; those
leaves are then ranked exactly.

The trees are fitted on a bounded sample; the budget is the share of the index
that reaches ``TARGET_RECALL`` on sample queries against brute force over the
sample. Every row is indexed. Equal vectors are one index entry, so a vector
shared by many rows is stored, searched and ranked once. Leaves are cut into
parts of at most ``PART`` rows by their counted size. Queries and index rows of
a leaf meet in one shuffle; a task ranks a leaf part against its queries with
matrix products and keeps only each query's best.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm.frames import open_frame
from hedonic.session import materialise

NEAREST = 20
TREES = 8
#: Rows of a leaf aimed at; trees deepen with the index up to MAX_DEPTH, which bounds their size.
LEAF = 512
MAX_DEPTH = 12
#: Vectors that the trees are fitted on, at most: those of smallest hashed id.
SAMPLE = 20_000
SAMPLE_QUERIES = 200
TARGET_RECALL = 0.96
#: Rows of a leaf that one task holds at a time, and queries ranked against them at once.
PART = 4096
QUERY_BLOCK = 256
#: Ranked pairs a task keeps before it prunes them to each query's best.
KEEP_PAIRS = 2_000_000
#: Components scored exactly at a time (32 MB a side).
SCORE_BLOCK = 1 << 22


@dataclass
class Forest:
    depth: int
    normal: np.ndarray  # tree, inner node, coordinate
    threshold: np.ndarray
    longest: float  # largest squared norm of the index
    share: float = 1.0  # of the index a query opens
    sizes: np.ndarray | None = None  # rows of each leaf: tree, leaf

    @property
    def inner(self) -> int:
        return (1 << self.depth) - 1

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Index vectors with the coordinate that makes all of one length."""
        rest = np.sqrt(np.maximum(self.longest - (x.astype(np.float64) ** 2).sum(axis=1), 0))
        return np.column_stack((x, rest)).astype(np.float32)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every index vector in every tree."""
        x = self.lift(x)
        out = np.zeros((len(x), len(self.normal)), np.int64)
        for t in range(len(self.normal)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                p = np.einsum("ij,ij->i", x, self.normal[t][node]) - self.threshold[t][node]
                node = 2 * node + 1 + (p > 0)
            out[:, t] = node - self.inner
        return out

    def margins(self, q: np.ndarray) -> np.ndarray:
        """Signed distance of each query to every splitting plane: query, tree, node."""
        q = np.column_stack((q, np.zeros(len(q)))).astype(np.float32)
        flat = self.normal.reshape(-1, q.shape[1])
        return (q @ flat.T).reshape(len(q), *self.threshold.shape) - self.threshold

    def open(self, margin: np.ndarray, budget: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of one priority queue over all trees, until their rows reach the budget."""
        heap = [(0.0, t, 0) for t in range(len(margin))]
        out, got, inner = [], 0, self.inner
        rows = margin.tolist()
        while heap and got < budget:
            far, t, node = heapq.heappop(heap)
            tree = rows[t]
            while node < inner:
                m = tree[node]
                near = 2 * node + 1 + (m > 0)
                heapq.heappush(heap, (max(far, abs(m)), t, 4 * node + 3 - near))
                node = near
            out.append((t, node - inner))
            got += self.sizes[t, node - inner]
        return out


def fit(sample: np.ndarray, rows: int, longest: float, trees: int = TREES, leaf: int = LEAF, seed: int = 7,
        nearest: int = NEAREST, target: float = TARGET_RECALL) -> Forest:
    """Trees over the sample, deep enough for ``rows`` index rows, and the calibrated share."""
    rng = np.random.default_rng(seed)
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(rows, 1) / leaf)))))
    depth = min(depth, max(0, int(np.log2(max(len(sample), 1) / 4))))
    inner, width = (1 << depth) - 1, sample.shape[1] + 1
    forest = Forest(depth, np.zeros((trees, inner, width), np.float32), np.zeros((trees, inner), np.float32), longest)
    x = forest.lift(sample)
    for t in range(trees):
        node = np.zeros(len(x), np.int64)
        for k in range(inner):
            here = np.flatnonzero(node == k)
            v = rng.standard_normal(width)
            if len(here) > 1:
                a, b = rng.choice(here, 2, replace=False)
                if (x[a] != x[b]).any():
                    v = x[a].astype(np.float64) - x[b]
            v /= np.linalg.norm(v)
            p = x[here] @ v.astype(np.float32)
            forest.normal[t, k], forest.threshold[t, k] = v, np.median(p) if len(p) else 0
            node[here] = 2 * k + 1 + (p > forest.threshold[t, k])
    if depth:
        forest.share = calibrate(forest, sample, rng, nearest, target)
    return forest


def calibrate(forest: Forest, sample: np.ndarray, rng, nearest: int, target: float) -> float:
    """Share of the rows to open so that ``target`` of the sample queries' true neighbours are among them."""
    leaf = forest.leaves(sample)
    forest.sizes = np.stack([np.bincount(leaf[:, t], minlength=forest.inner + 1) for t in range(leaf.shape[1])])
    need = []
    queries = rng.choice(len(sample), min(SAMPLE_QUERIES, len(sample)), replace=False)
    score = sample[queries].astype(np.float64) @ sample.T.astype(np.float64)
    score[np.arange(len(queries)), queries] = -np.inf
    margin = forest.margins(sample[queries])
    for i in range(len(queries)):
        order = forest.open(margin[i], np.inf)
        at = np.zeros(forest.sizes.shape)
        total = 0
        for t, k in order:
            at[t, k] = total  # rows opened before this leaf: with more than these as budget it is opened
            total += forest.sizes[t, k]
        k = min(nearest, len(sample) - 1)
        best = np.argpartition(-score[i], k - 1)[:k]
        need += [min(at[t, leaf[b, t]] for t in range(len(at))) for b in best]
    return float((np.quantile(need, target) + 1) / len(sample))


def _valid(vec, dim: int):
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & (F.size(vec) == dim) & ~bad & F.exists(vec, lambda x: x != 0)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed in one order whatever stands around them."""
    return (q.astype(np.float64) * v.astype(np.float64)).sum(axis=1)


def best_of(q: np.ndarray, c: np.ndarray, s: np.ndarray, k: int):
    """Each query's k best pairs: highest score, then smaller id; a pair found twice counts once."""
    order = np.lexsort((c, -s, q))
    q, c, s = q[order], c[order], s[order]
    if not len(q):
        return q, c, s
    keep = np.r_[True, (q[1:] != q[:-1]) | (c[1:] != c[:-1])]  # one pair has one score, so copies are neighbours
    q, c, s = q[keep], c[keep], s[keep]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    return q[rank < k], c[rank < k], s[rank < k]


def rank_block(qid, q, cid, c, k: int):
    """Best k of one leaf part for a block of queries, with exact scores.

    Every pair that the rough sums cannot tell from the k-th is scored, however many tie.
    """
    rough = q.astype(np.float64) @ c.T.astype(np.float64)
    if k < len(cid):
        kth = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
        # rough and exact sums differ by at most n eps |q||c| (twice the bound of a sum of n products), in both pairs
        length = np.linalg.norm(q.astype(np.float64), axis=1) * np.linalg.norm(c.astype(np.float64), axis=1).max()
        apart = 2 * (q.shape[1] + 2) * (np.finfo(np.float64).eps * length + np.finfo(np.float64).tiny)
        i, j = np.nonzero(~(rough < (kth - apart)[:, None]))
    else:
        i, j = np.indices(rough.shape).reshape(2, -1)
    step = max(1, SCORE_BLOCK // q.shape[1])
    s = np.concatenate([np.zeros(0), *(scores(q[i[lo:lo + step]], c[j[lo:lo + step]]) for lo in range(0, len(i), step))])
    return best_of(qid[i], cid[j], s, k)


def search(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 20,
           nearest: int = NEAREST, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of each row whose id is divisible by ``every``.

    Score is the inner product of the original vectors in double precision;
    highest first, ties to the smaller id; a query's own id is no candidate;
    fewer candidates than ``nearest`` are all returned.

    Rows take no part if id or vector is null, the vector is all zero, holds a
    null or non-finite component, or is not of the most frequent length (the
    smaller, if two are as frequent). Rows that repeat an id are one row, with
    the smallest of their vectors. Equal vectors under several ids are all
    candidates. An empty table gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    inner = open_frame(df, [], ())
    vec = F.col(inner.name(embedding))
    kind = "<f8" if isinstance(inner.df.schema[inner.name(embedding)].dataType.elementType, T.DoubleType) else "<f4"
    dims = inner.df.where(F.size(vec) > 0).groupBy(F.size(vec).alias("dim")).count()
    top = dims.orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = top[0]["dim"] if top else 1
    rows = inner.df.select(F.col(inner.name(vec_id)).cast("long").alias("id"), vec.alias("vec")).where(
        F.col("id").isNotNull() & _valid(F.col("vec"), dim))

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = part.column("vec").flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim) + 0.0
            x = x.astype(kind)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([v.tobytes() for v in x], pa.binary()),
                                              pa.array((x.astype(np.float64) ** 2).sum(axis=1))],
                                             names=["id", "vec", "norm"])

    packed = rows.mapInArrow(pack, "id long, vec binary, norm double")
    packed = materialise(packed.groupBy("id").agg(F.min(F.struct("vec", "norm")).alias("v")).select("id", "v.*"))
    # equal vectors are one entry, with as many of its smallest ids as an answer can name
    few = packed.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(
        F.col("n") <= nearest + 1)
    entries = materialise(few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"),
                                                 F.min("id").alias("rep"), F.min("norm").alias("norm")))
    asked = packed.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), F.col("vec").alias("qvec"))
    asked = materialise(asked.join(entries.select("vec", "rep"), F.col("qvec") == F.col("vec")).select(
        "query_id", F.col("rep").alias("qrep"), "vec"))
    known = entries.agg(F.count("*").alias("n"), F.max("norm").alias("longest")).first()
    chosen = entries.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("vec").collect()
    points = np.frombuffer(b"".join(r["vec"] for r in chosen), kind).reshape(-1, dim)
    forest = fit(points, known["n"], known["longest"] or 0.0, trees, leaf, nearest=nearest)
    shared = spark.sparkContext.broadcast(forest)
    cells = 1 << forest.depth

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        total = np.zeros((len(f.normal), cells), np.int64)
        for part in parts:
            at = f.leaves(_matrix(part.column("vec"), kind)) if part.num_rows else np.zeros((0, len(total)), int)
            for t in range(len(total)):
                total[t] += np.bincount(at[:, t], minlength=cells)
        flat = np.flatnonzero(total.reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(total.reshape(-1)[flat])], names=["cell", "n"])

    # at most trees * 2^MAX_DEPTH counts
    counted = entries.select("vec").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    forest.sizes = np.zeros((trees, cells), np.int64)
    for r in counted.collect():
        forest.sizes[r["cell"] // cells, r["cell"] % cells] = r["n"]
    sized = spark.sparkContext.broadcast(forest)
    budget = max(forest.share * known["n"], 10 * nearest)

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = sized.value
        pieces = -(-f.sizes // PART)
        for part in parts:
            rep = part.column("rep").to_numpy()
            at = f.leaves(_matrix(part.column("vec"), kind)) if part.num_rows else np.zeros((0, trees), int)
            for t in range(trees):
                piece = (rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) \
                    % np.maximum(pieces[t, at[:, t]], 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[:, t] + t * cells), pa.array(piece), pa.array(np.zeros(len(rep), np.int32)),
                     part.column("rep"), part.column("vec")], names=["cell", "piece", "asks", "rep", "vec"])

    def ask(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = sized.value
        pieces = -(-f.sizes // PART)
        for part in parts:
            for lo in range(0, part.num_rows, 64):
                some = part.slice(lo, 64)
                margin = f.margins(_matrix(some.column("vec"), kind))
                i, cell, piece = [], [], []
                for k in range(some.num_rows):
                    for t, l in f.open(margin[k], budget):
                        for p in range(pieces[t, l]):
                            i.append(k)
                            cell.append(t * cells + l)
                            piece.append(p)
                take = pa.array(i, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int64()), pa.array(piece, pa.int64()), pa.array([1] * len(i), pa.int32()),
                     some.column("qrep").take(take), some.column("vec").take(take)],
                    names=["cell", "piece", "asks", "rep", "vec"])

    shape = "cell long, piece long, asks int, rep long, vec binary"
    one = asked.dropDuplicates(["qrep"]).select("qrep", "vec")
    met = entries.select("rep", "vec").mapInArrow(place, shape).unionByName(one.mapInArrow(ask, shape))
    met = met.repartition("cell", "piece").sortWithinPartitions("cell", "piece", "asks")
    k = nearest + 1

    def rank(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Leaf parts arrive one after the other, index rows before queries."""
        now, rows, mat = None, [], None
        held, n = [], 0

        def out(pairs):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], names=["qrep", "crep", "score"])

        for part in parts:
            cell, piece, asks, rep = (part.column(c).to_numpy() for c in ("cell", "piece", "asks", "rep"))
            vec = _matrix(part.column("vec"), kind)
            edge = np.flatnonzero((np.diff(cell) != 0) | (np.diff(piece) != 0) | (np.diff(asks) != 0)) + 1
            for a, b in zip(np.r_[0, edge], np.r_[edge, len(cell)], strict=True):
                if a == b:
                    continue
                if (cell[a], piece[a]) != now:
                    now, rows, mat = (cell[a], piece[a]), [], None
                if not asks[a]:
                    rows.append((rep[a:b], vec[a:b]))
                    continue
                if not rows:
                    continue
                if mat is None:
                    mat = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
                for lo in range(a, b, QUERY_BLOCK):
                    hi = min(b, lo + QUERY_BLOCK)
                    held.append(rank_block(rep[lo:hi], vec[lo:hi], *mat, k))
                    n += len(held[-1][0])
                if n > KEEP_PAIRS:
                    held = [best_of(*(np.concatenate(x) for x in zip(*held, strict=True)), k)]
                    n = len(held[0][0])
                    if n > KEEP_PAIRS // 2:  # many queries: hand on what is there, the last step merges it
                        yield out(held[0])
                        held, n = [], 0
        if held:
            yield out(best_of(*(np.concatenate(x) for x in zip(*held, strict=True)), k))

    found = met.mapInArrow(rank, "qrep long, crep long, score double")
    found = found.groupBy("qrep", "crep").agg(F.max("score").alias("score"))
    best = Window.partitionBy("qrep").orderBy(F.desc("score"), "crep")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
    named = found.join(entries.select(F.col("rep").alias("crep"), "ids"), "crep").select(
        "qrep", "score", F.explode("ids").alias("id"))
    best = Window.partitionBy("qrep").orderBy(F.desc("score"), "id")
    named = named.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
    lists = named.groupBy("qrep").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("near"))
    each = asked.select("query_id", "qrep").join(lists, "qrep")
    near = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, nearest)
    return each.select("query_id", F.posexplode(near).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"),
        F.col("x.score").alias("score"))

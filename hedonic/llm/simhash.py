"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at up to ``distance`` differing bits. The bits are
split in two halves; two linked fingerprints differ in at most ``distance // 2``
bits of one half, so comparing per half loses no link. The anchors of a half are
a covering code of the 32-bit space: the perfect Hamming code on 31 bits,
doubled for the last bit. Its covering radius is 1: every half has exactly one
*home* anchor within one bit. Each fingerprint is replicated to every anchor
within radius plus threshold of its half, where it meets the fingerprints at
home there (its partner's home is among these anchors by the triangle
inequality). At three bits that is at most 17 copies a half over 2^27 anchors,
so groups stay small at any size.

Texts with one fingerprint are one node: what is replicated is the set of
*distinct* fingerprints, however many documents share one. A group at an anchor
is cut into tiles of at most ``TILE`` homes by ``TILE`` visitors, compared as
bit matrices, and each tile returns only a spanning forest of its links, never
its pairs. Components come from Spark joins (minimum labels with pointer
jumping), each round written to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm.frames import open_frame
from hedonic.session import bounded_broadcast, materialise

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Fingerprints of one side compared at a time; bounds a task's memory whatever the group.
TILE = 2048
#: Rows of small integers that are broadcast at most (some 32 bytes each in a hash table).
BROADCAST_ROWS = 2_000_000
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 15

_SHIFTS = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text: 0 without words, else the majority bits of its shingles' hashes."""
    words = text.encode().lower().split() if text else []  # bytes: only A-Z and the six white-space characters count
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    flat = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words])
    start = (end - [len(w) + 1 for w in words])[:n - shingle + 1].tolist()
    stop = (end - 1)[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(start), BLOCK):
        h = np.array([digest(flat[a:b], SEED) for a, b in zip(start[lo:lo + BLOCK], stop[lo:lo + BLOCK], strict=True)],
                     "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * ones > len(start)).tolist()
    return sum(1 << b for b in bits)


def add_fingerprints(df: DataFrame, text: str, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """``keep`` and ``fp``, the fingerprint's bits as a signed long."""
    src = df.select(*keep, F.col(text).cast("string").alias("body"))

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fp = np.array([fingerprint(t, shingle) for t in part.column("body").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(fp.view(np.int64))],
                                             names=[*keep, "fp"])

    return src.mapInArrow(scan, T.StructType([*src.select(*keep).schema.fields, T.StructField("fp", T.LongType())]))


# ---- the covering code of one 32-bit half -----------------------------------------------------------------

#: Syndrome of each of the 31 Hamming bits: bit i has syndrome i + 1.
_SYNDROME_BITS = [sum(1 << i for i in range(31) if (i + 1) >> k & 1) for k in range(5)]


def syndrome(half: np.ndarray) -> np.ndarray:
    """Syndrome of the low 31 bits: 0 for codewords, else 1 + the bit to flip to get the one codeword next to it."""
    out = np.zeros(len(half), np.int64)
    for k, mask in enumerate(_SYNDROME_BITS):
        x = half & np.uint64(mask)
        for s in (16, 8, 4, 2, 1):
            x = x ^ (x >> np.uint64(s))
        out |= (x & np.uint64(1)).astype(np.int64) << k
    return out


def home(half: np.ndarray) -> np.ndarray:
    """The anchor within the covering radius of each half."""
    s = syndrome(half)
    return np.where(s > 0, half ^ (np.uint64(1) << np.maximum(s - 1, 0).astype(np.uint64)), half)


def anchors(half: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the half, anchor) of every anchor within ``reach`` bits of each half, each once.

    Every word within ``reach`` bits is a flip of at most ``reach`` bits; the codewords among them are the anchors.
    Flips that complete the syndrome are looked up instead of tried, so the work is 32^(reach - 1) a half.
    """
    s = syndrome(half)
    found_i, found_a = [], []

    def codewords(words: np.ndarray, index: np.ndarray, syn: np.ndarray, left: int, above: int) -> None:
        done = syn == 0
        found_i.append(index[done])
        found_a.append(words[done])
        if left == 0 or not len(words):
            return
        if left == 1:  # only the flip of the bit named by the syndrome gives a codeword (bit 31 if there is none)
            bit = np.where(syn > 0, syn - 1, 31)
            ok = bit >= above
            found_i.append(index[ok])
            found_a.append(words[ok] ^ (np.uint64(1) << bit[ok].astype(np.uint64)))
            return
        for bit in range(above, 32):
            flipped = syn if bit == 31 else syn ^ (bit + 1)
            codewords(words ^ np.uint64(1 << bit), index, flipped, left - 1, bit + 1)

    codewords(half, np.arange(len(half)), s, reach, 0)
    return np.concatenate(found_i), np.concatenate(found_a)


def replicate(fps: DataFrame, distance: int) -> DataFrame:
    """(half, anchor, fp, at_home): each fingerprint at its home anchors and at every anchor within reach."""
    reach = 1 + distance // 2

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            every = np.asarray(part.column("fp").to_numpy(zero_copy_only=False), np.int64)
            for lo in range(0, len(every), 4096):
                fp = every[lo:lo + 4096]
                for side in (0, 1):
                    half = fp.view(np.uint64) >> np.uint64(32 * side) & np.uint64(0xFFFFFFFF)
                    i, a = anchors(half, reach)
                    at_home = home(half)[i] == a
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((a.astype(np.int64) << 1) | side), pa.array(fp[i]), pa.array(at_home)],
                        names=["anchor", "fp", "at_home"])

    return fps.select("fp").mapInArrow(scan, "anchor long, fp long, at_home boolean")


def forest(a: np.ndarray, b: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two sorted sets of fingerprints (as signed longs)."""
    nodes = np.unique(np.concatenate((a, b)))
    parent = list(range(len(nodes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    at_a, at_b = np.searchsorted(nodes, a).tolist(), np.searchsorted(nodes, b).tolist()
    ub = b.view(np.uint64)
    for i, x in zip(at_a, a.view(np.uint64), strict=True):
        for k in np.flatnonzero(np.bitwise_count(ub ^ x) <= distance):
            p, q = find(i), find(at_b[k])
            if p != q:
                parent[max(p, q)] = min(p, q)
                out.append((i, at_b[k]))
    return [(int(nodes[i]), int(nodes[j])) for i, j in out]


def links(fps: DataFrame, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """Links (u, v) of distinct fingerprints that connect exactly what all links within ``distance`` connect."""
    placed = replicate(fps, distance)
    # tiles: homes are dealt to k1 parts and visitors to k2 parts of their anchor, by measured counts
    sizes = placed.groupBy("anchor").agg(F.sum(F.col("at_home").cast("long")).alias("homes"), F.count("*").alias("all"))
    sizes = sizes.where((F.col("homes") > 0) & (F.col("all") > 1))
    parts = F.ceil(F.col("all") / tile).cast("int")
    homes = F.ceil(F.col("homes") / tile).cast("int")
    # anchors where anything can meet: few of all, so that while they are few the copies are not shuffled again
    sizes = materialise(sizes.select("anchor", homes.alias("k1"), parts.alias("k2")))
    placed = placed.join(bounded_broadcast(sizes, BROADCAST_ROWS), "anchor")
    mine = F.pmod(F.xxhash64("fp"), F.col("k1")).cast("int")
    theirs = F.pmod(F.xxhash64("fp"), F.col("k2")).cast("int")
    # a home stands in every tile of its row, a visitor (homes visit too) in every tile of its column
    row = F.transform(F.sequence(F.lit(0), F.col("k2") - 1), lambda j: F.struct(mine.alias("i"), j.alias("j"),
                                                                                F.lit(True).alias("h")))
    column = F.transform(F.sequence(F.lit(0), F.col("k1") - 1), lambda i: F.struct(i.alias("i"), theirs.alias("j"),
                                                                                   F.lit(False).alias("h")))
    none = F.array().cast(T.ArrayType(T.StructType([T.StructField("i", T.IntegerType()), T.StructField(
        "j", T.IntegerType()), T.StructField("h", T.BooleanType())])))
    cells = F.concat(F.when(F.col("at_home"), row).otherwise(none), column)
    dealt = placed.select("anchor", "fp", F.explode(cells).alias("t")).select(
        "anchor", F.col("t.i").alias("i"), F.col("t.j").alias("j"), F.col("t.h").alias("h"), "fp")

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles arrive one after the other (the partition is sorted); one tile is held at a time."""
        key, sides = None, ([], [])

        def close():
            if not sides[0] or not sides[1] or len(sides[0]) == 1 and sides[0] == sides[1]:  # it meets only itself
                return []
            a, b = (np.array(s, np.int64) for s in sides)
            return forest(a, b, distance)

        for part in parts:
            out = []
            cols = [part.column(c).to_pylist() for c in ("anchor", "i", "j", "h", "fp")]
            for anchor, i, j, h, fp in zip(*cols, strict=True):
                if (anchor, i, j) != key:
                    out += close()
                    key, sides = (anchor, i, j), ([], [])
                sides[0 if h else 1].append(fp)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                              pa.array([x[1] for x in out], pa.int64())], names=["u", "v"])
        out = close()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                          pa.array([x[1] for x in out], pa.int64())], names=["u", "v"])

    grouped = dealt.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
    return grouped.mapInArrow(compare, "u long, v long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): each node of the links and the smallest node it reaches.

    Every round takes the smallest label among neighbours and then the label's own label, so distances halve; it ends
    when no label changes. Labels only shrink, and each round is written to the shared folder.
    """
    edges = materialise(edges.select("u", "v").union(edges.select("v", "u")).toDF("u", "v").where("u != v").distinct())
    label = materialise(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root"))
                        .withColumnRenamed("u", "node"))
    for _ in range(max_rounds):
        near = edges.join(label, edges.v == label.node).groupBy("u").agg(F.min("root").alias("near"))
        hooked = label.join(near, label.node == near.u).select(
            "node", "root", F.least("root", "near").alias("next"))
        # the root's own new label, and what its members found, pass on
        up = hooked.groupBy(F.col("root").alias("r")).agg(F.min("next").alias("best"))
        step = hooked.join(up, hooked.root == up.r).select("node", "root", F.least("next", "best").alias("next"))
        jump = label.select(F.col("node").alias("n"), F.col("root").alias("hop"))
        step = step.join(jump, step.next == jump.n, "left").select(
            "node", F.least("next", F.coalesce("hop", "next")).alias("new"), "root")
        step = materialise(step.select("node", F.col("new").alias("root"), (F.col("new") != F.col("root")).alias("moved")))
        label = step.select("node", "root")
        if step.where("moved").isEmpty():
            return label
    raise RuntimeError("components did not settle")


def classes(fps: DataFrame, doc_id: str, distance: int = DISTANCE) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of a table (doc_id, fp).

    ``root`` names the component; ``component_id`` is its smallest id.
    """
    distinct = materialise(fps.groupBy("fp").agg(F.min(doc_id).alias("least")))
    label = components(links(distinct, distance))
    named = distinct.join(label, distinct.fp == label.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.select("fp", "root").join(smallest, "root")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, keep: list[str] | None = None) -> DataFrame:
    """One row per document: columns ``keep`` (default: only the id) plus ``fingerprint`` (16 hexadecimal digits) and
    ``component_id``, the smallest id among the documents it reaches.

    Null and empty texts and texts of white space have fingerprint 0, which links like any other. Ids that are null do
    not count for the smallest; a component of such rows only has a null id. Rows that repeat each return; an empty
    table returns none; texts of any length are read whole.
    """
    outputs = ("fingerprint", "component_id")
    inner = open_frame(df, [doc_id] if keep is None else keep, outputs)
    key = inner.name(doc_id)
    fps = materialise(add_fingerprints(inner.df, inner.name(text), sorted({*inner.kept, key}), shingle))
    found = classes(fps, key, distance).select(F.col("fp").alias("of"), "component_id")
    out = fps.join(found, F.col("fp") == F.col("of")).withColumn("fingerprint", hex16(F.col("fp")))
    return inner.close(out, *outputs)


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, with its own columns: that of the smallest id (null ids last; rows that repeat
    an id in one component count as one document)."""
    inner = open_frame(df)
    key = inner.name(doc_id)
    shingle, distance = options.get("shingle", SHINGLE), options.get("distance", DISTANCE)
    rows = materialise(add_fingerprints(inner.df, inner.name(text), inner.kept, shingle)
                       .withColumn("row", F.monotonically_increasing_id()))
    found = classes(rows.select(key, "fp"), key, distance).select(F.col("fp").alias("of"), "root")
    light = rows.select(F.col("row").alias("at"), F.col(key).alias("id"), "fp")
    # the first row of each fingerprint, then of each component; both minima are taken before the shuffle, and lists go
    # to the rows while they are small, so no task gets all rows of a fingerprint or component
    per = light.groupBy("fp").agg(F.count("*").alias("n"), F.min(F.struct(F.isnull("id"), "id", "at")).alias("first"))
    per = materialise(per.join(found, F.col("fp") == F.col("of")).select("fp", "root", "n", "first"))
    shared = per.groupBy("root").agg(F.sum("n").alias("n"), F.min("first").alias("best")).where("n > 1").select(
        "root", F.col("best.at").alias("kept"))
    shared = per.select("fp", "root").join(bounded_broadcast(materialise(shared), BROADCAST_ROWS), "root")
    shared = bounded_broadcast(materialise(shared.select("fp", "kept")), BROADCAST_ROWS)
    drop = light.join(shared, "fp").where(F.col("at") != F.col("kept")).select("at")
    # a list of row numbers: while it is small it goes to the texts, else the texts are shuffled
    drop = bounded_broadcast(materialise(drop), BROADCAST_ROWS)
    return inner.close(rows.join(drop, F.col("row") == F.col("at"), "left_anti"))

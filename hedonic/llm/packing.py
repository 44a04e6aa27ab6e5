"""Sequence packing as a cutting-stock problem solved by column generation.

A document of n tokens gives ``n // capacity`` full pieces, each a sequence of
its own, and a remainder. The histogram of remainder lengths (at most
``capacity - 1`` counts, however many documents) is the whole input of the
optimisation, which therefore runs on the driver in bounded memory:

* the linear program "cover every length's count with as few sequences as
  possible" is solved over patterns (how many pieces of each length share a
  sequence) by revised simplex; new patterns are priced by a knapsack dynamic
  program over the capacity;
* multiplicities are rounded down, then up greedily where demand is left, and
  the same dynamic program makes patterns for the residual counts. Only patterns
  that fill a sequence exactly are used;
* documents are ranked within their length, and a rank's place follows from the
  plan by arithmetic. Ranks beyond the patterns form a chain that is cut every
  ``capacity`` tokens, its last part into powers of two, so nothing is padded.

Only counts are shuffled. Ranks come from a counter in each encoding task plus
per-task offsets, so no length, however frequent, gathers in one task.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm import tokens
from hedonic.llm.frames import open_frame
from hedonic.session import bounded_broadcast, materialise

CAPACITY = 2048
END_OF_TEXT = 1
#: Simplex pivots at most. The plan stays whole and unpadded when the search ends early; only more
#: documents are then cut in the chain.
MAX_PIVOTS = 600
#: Rounds of residual patterns at most, to the same effect.
MAX_ROUNDS = 60
#: Rows of the (task, length) offset table up to which it is broadcast (about 32 bytes each); beyond, it is joined.
BROADCAST_ROWS = 500_000
#: Token bytes in one output batch of pieces.
OUT_BYTES = 16_000_000


def price(value: np.ndarray, length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: best value within each capacity and the item chosen last (-1: one token unused)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(length)
    size, worth = length[order], value[order]
    usable = np.searchsorted(size, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if usable[c]:
            gain = best[c - size[:usable[c]]] + worth[:usable[c]]
            k = int(gain.argmax())
            if gain[k] >= best[c]:
                best[c], choice[c] = gain[k], order[k]
    return best, choice


def pattern(choice: np.ndarray, length: np.ndarray, c: int, first: int | None = None) -> dict[int, int]:
    """Items of the best knapsack of capacity ``c``, as index -> count, with ``first`` put in beforehand."""
    out: dict[int, int] = {}
    if first is not None:
        out[first] = 1
        c -= int(length[first])
    while c > 0:
        k = int(choice[c])
        if k < 0:
            c -= 1
            continue
        out[k] = out.get(k, 0) + 1
        c -= int(length[k])
    return out


def solve(length: np.ndarray, demand: np.ndarray, capacity: int, max_pivots: int = MAX_PIVOTS):
    """Patterns and multiplicities of the linear program, by column generation.

    Returns (patterns as index -> count, multiplicities). The start has one
    pattern of equal pieces for each length.
    """
    n = len(length)
    cols = [{i: int(capacity // l)} for i, l in enumerate(length)]
    inverse = np.diag([1.0 / c[i] for i, c in enumerate(cols)])
    x = demand * inverse.diagonal()
    y = inverse.sum(axis=0)
    pivots = 0
    while pivots < max_pivots:
        best, choice = price(y, length, capacity)
        if best[capacity] <= 1 + 1e-9:
            break
        with_item = y + best[capacity - length]  # best pattern that holds each length
        progress = False
        for i in np.argsort(-with_item):
            if with_item[i] <= 1 + 1e-9 or pivots >= max_pivots:
                break
            col = pattern(choice, length, capacity, int(i))
            k, a = np.fromiter(col, int), np.fromiter(col.values(), float)
            gain = float(y[k] @ a) - 1
            if gain <= 1e-9:
                continue  # an earlier pivot of this round has used it up
            d = inverse[:, k] @ a
            up = np.flatnonzero(d > 1e-9)
            ratio = x[up] / d[up]
            r = int(up[ratio.argmin()])
            step = x[r] / d[r]
            row = inverse[r] / d[r]
            rows = np.flatnonzero(np.abs(d) > 1e-12)
            inverse[rows] -= np.outer(d[rows], row)
            inverse[r] = row
            x[rows] -= step * d[rows]
            x[r] = step
            y -= gain * row
            cols[r] = col
            pivots += 1
            progress = True
        if not progress:
            break
    return cols, np.maximum(x, 0)


def fill_residual(length: np.ndarray, left: np.ndarray, capacity: int, rounds: int):
    """Exactly full patterns for what rounding left, with multiplicities; takes them off ``left``.

    Each round prices the lengths still there by the same dynamic program at the dual values the program tends to
    (the length itself, a full sequence being worth the most), lengths with many documents left a little higher.
    """
    out = []
    for _ in range(rounds):
        there = np.flatnonzero(left > 0)
        if not len(there):
            break
        size, stock = length[there], left[there]
        bonus = np.minimum(1, stock / max(1, np.percentile(stock, 90)))
        best, choice = price(size * (1 + 0.4 / capacity * bonus), size, capacity)
        taken = 0
        for i in range(len(there) - 1, -1, -1):
            if left[there[i]] <= 0:
                continue
            col = pattern(choice, size, capacity, i)
            if sum(size[k] * a for k, a in col.items()) != capacity:
                continue
            times = min(int(left[there[k]]) // a for k, a in col.items())
            times = min(times, max(1, times // 2))  # leave some for the patterns that follow
            if times:
                out.append(({int(there[k]): a for k, a in col.items()}, times))
                for k, a in col.items():
                    left[there[k]] -= a * times
                taken += times
        if not taken:
            break
    return out


@dataclass
class Plan:
    """Where a remainder goes, by its length and its rank among the documents of that length."""

    capacity: int
    place: dict[int, tuple]  # length -> (first ranks, copies a sequence, first sequences, offsets)
    used: dict[int, int]  # length -> ranks that patterns take
    chain: dict[int, int]  # length -> chain position of the first rank left
    chain_sequence: int
    chain_tokens: int
    tail: list[int]  # chain positions where the power-of-two sequences of its last part start
    sequences: int

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(tokens, sequence, offset) of the pieces of one remainder."""
        if rank < self.used.get(length, 0):
            first, copies, sequence, offset = self.place[length]
            p = bisect_right(first, rank) - 1
            k = rank - first[p]
            return [(length, sequence[p] + k // copies[p], offset[p] + k % copies[p] * length)]
        at = self.chain[length] + (rank - self.used.get(length, 0)) * length
        end, out = at + length, []
        whole = self.chain_tokens // self.capacity * self.capacity
        while at < end:
            if at < whole:
                number, start = at // self.capacity, at // self.capacity * self.capacity
                stop = start + self.capacity
            else:
                t = bisect_right(self.tail, at) - 1
                number, start = whole // self.capacity + t, self.tail[t]
                stop = self.tail[t + 1] if t + 1 < len(self.tail) else self.chain_tokens
            size = min(end, stop) - at
            out.append((size, self.chain_sequence + number, at - start))
            at += size
        return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, max_pivots: int = MAX_PIVOTS,
         max_rounds: int = MAX_ROUNDS) -> Plan:
    """The packing plan of remainders of length 1 to ``capacity - 1`` and their counts."""
    length = np.array(sorted(l for l, c in histogram.items() if c), int)
    left = np.array([histogram[int(l)] for l in length], int)
    used = np.zeros(len(length), int)
    place: dict[int, tuple] = {int(l): ([], [], [], []) for l in length}
    sequences = 0
    if len(length):
        cols, x = solve(length, left.astype(float), capacity, max_pivots)
        full = [i for i, c in enumerate(cols) if sum(length[k] * a for k, a in c.items()) == capacity]
        full.sort(key=lambda i: (-(x[i] % 1), i))
        times = {i: int(x[i] + 1e-9) for i in full}
        for i in full:  # rounding down fits: the program covers each demand exactly or beyond
            times[i] = min([times[i], *(left[k] // a for k, a in cols[i].items())])
            for k, a in cols[i].items():
                left[k] -= a * times[i]
        for i in full:
            more = min(int(left[k] // a) for k, a in cols[i].items())
            times[i] += more
            for k, a in cols[i].items():
                left[k] -= a * more
        chosen = [(cols[i], times[i]) for i in full if times[i]] + fill_residual(length, left, capacity, max_rounds)
        for col, n in chosen:
            offset = 0
            for k, a in sorted(col.items(), key=lambda ka: -length[ka[0]]):
                for arr, v in zip(place[int(length[k])], (int(used[k]), a, sequences, offset), strict=True):
                    arr.append(v)
                used[k] += a * n
                offset += int(length[k]) * a
            sequences += n
    chain, total = {}, 0
    for k, l in enumerate(length):
        chain[int(l)] = total
        total += int(l) * int(left[k])
    whole, rest = divmod(total, capacity)
    tail, at = [], whole * capacity
    while rest:
        tail.append(at)
        part = 1 << (rest.bit_length() - 1)
        at, rest = at + part, rest - part
    return Plan(capacity, place, {int(l): int(u) for l, u in zip(length, used, strict=True)}, chain, sequences, total,
                tail, sequences + whole + len(tail))


def encode(df: DataFrame, text: str, tokenizer: str, end: int, capacity: int, keep: list[str]) -> DataFrame:
    """``keep`` plus each document's ids with its end id (little-endian, 2 or 4 bytes each), their number, the
    remainder's length, and the document's task and counts of equal remainders and full pieces before it there."""
    wide = tokens.vocabulary_size(tokenizer) > 1 << 16 or end >= 1 << 16
    src = df.select(*keep, F.col(text).cast("string").alias("body"))
    names = [*keep, "ids", "n", "rest", "task", "rank", "full"]
    schema = T.StructType([*src.select(*keep).schema.fields, T.StructField("ids", T.BinaryType()),
                           T.StructField("n", T.LongType()), T.StructField("rest", T.IntegerType()),
                           T.StructField("task", T.IntegerType()), T.StructField("rank", T.LongType()),
                           T.StructField("full", T.LongType())])

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        kind = np.dtype("<u4" if wide else "<u2")
        task, seen, full = TaskContext.get().partitionId(), {}, 0
        last = np.array([end], kind).tobytes()
        for part in parts:
            ids, n, rest, rank, fulls = [], [], [], [], []
            for t in part.column("body").to_pylist():
                raw = enc.encode(t).astype(kind).tobytes() + last
                size = len(raw) // kind.itemsize
                r = size % capacity
                ids.append(raw)
                n.append(size)
                rest.append(r)
                rank.append(seen.get(r, 0))
                fulls.append(full)
                seen[r] = seen.get(r, 0) + 1
                full += size // capacity
            cols = [pa.array(ids, pa.binary()), pa.array(n, pa.int64()), pa.array(rest, pa.int32()),
                    pa.array([task] * len(n), pa.int32()), pa.array(rank, pa.int64()), pa.array(fulls, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *cols], names=names)

    return src.mapInArrow(scan, schema)


def pack_documents(df: DataFrame, text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY,
                   end: int = END_OF_TEXT, max_pivots: int = MAX_PIVOTS, keep: list[str] | None = None) -> DataFrame:
    """One row per piece: columns ``keep`` (default: all but the text) of its document plus
    ``start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers;
    ``start`` its document's ids before it; ``offset`` its place in its
    sequence. A null text is empty: its document is the end id alone. Documents
    that repeat are packed each; an empty table gives no rows; documents of any
    length are cut whole. A kept column with the name of an output is replaced.
    """
    outputs = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    tokenizer = tokenizer or tokens.default_path()
    inner = open_frame(df, [c for c in df.columns if c.lower() != text.lower()] if keep is None else keep, outputs)
    kept = inner.kept
    docs = materialise(encode(inner.df, inner.name(text), tokenizer, end, capacity, kept))

    counts = docs.groupBy("task", "rest").agg(F.count("*").alias("docs"),
                                              F.sum(F.expr(f"n div {capacity}")).alias("fulls"))
    counts = materialise(counts)  # a row for each task and length: read several times below
    histogram = {r["rest"]: r["docs"] for r in counts.groupBy("rest").agg(F.sum("docs").alias("docs")).collect()}
    histogram.pop(0, None)
    packed = plan(histogram, capacity, max_pivots)
    shared = df.sparkSession.sparkContext.broadcast(packed)
    # one row per task: the number of input splits bounds this window
    tasks = counts.groupBy("task").agg(F.sum("fulls").alias("fulls"))
    before = F.coalesce(F.sum("fulls").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    tasks = tasks.select("task", before.alias("full_base"))
    before = F.coalesce(F.sum("docs").over(Window.partitionBy("rest").orderBy("task")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select("task", "rest", before.alias("rank_base")).join(tasks, "task")
    src = docs.join(bounded_broadcast(bases, BROADCAST_ROWS), ["task", "rest"]).select(
        *kept, "ids", "rest", (F.col("rank") + F.col("rank_base")).alias("rank"),
        (F.col("full") + F.col("full_base") + packed.sequences).alias("full"), "n")
    schema = T.StructType([*src.select(*kept).schema.fields, T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_ = shared.value
        for part in parts:
            ids, rest, rank, full, n = (part.column(c).to_pylist() for c in ("ids", "rest", "rank", "full", "n"))
            rows: list[list] = [[] for _ in range(7)]
            size = 0

            def batch(rows=rows, part=part):
                take = pa.array(rows[0], pa.int64())
                return pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(take) for c in kept),
                     *(pa.array(v, k) for v, k in zip(rows[1:], (pa.int64(), pa.int64(), pa.binary(), pa.int64(),
                                                                 pa.int64(), pa.int64()), strict=True))],
                    names=[*kept, *outputs])

            for i, raw in enumerate(ids):
                every = np.frombuffer(raw, "<u2" if len(raw) == 2 * n[i] else "<u4")
                pieces = [(capacity, full[i] + k, 0) for k in range(n[i] // capacity)]
                if rest[i]:
                    pieces += plan_.pieces(rest[i], rank[i])
                start = 0
                for length, sequence, offset in pieces:
                    piece = every[start:start + length].astype("<u4").tobytes()
                    for v, x in zip(rows, (i, start, length, piece, n[i], sequence, offset), strict=True):
                        v.append(x)
                    start += length
                    size += len(piece)
                    if size >= OUT_BYTES:
                        yield batch()
                        for v in rows:
                            v.clear()
                        size = 0
            yield batch()

    return inner.close(src.mapInArrow(cut, schema), *outputs)


def digest(pieces: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The contract's columns."""
    return pieces.select(doc_id, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")

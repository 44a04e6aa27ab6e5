"""Exact substring deduplication with difference-cover anchors.

A window of ``WINDOW`` words is a duplicate if its word sequence starts
anywhere else. Comparing all windows would shuffle one hash per word. Instead,
short windows (anchors) are hashed only at positions whose index modulo
``PERIOD`` lies in a difference cover: for any two positions some common shift
below the period brings both onto the cover, so two equal windows of
``PERIOD + ANCHOR - 1`` words always share an aligned anchor. Only windows that
hold a repeated anchor are then extended: hashed whole (128 bits) and compared.

Documents lie in blocks, written once to the shared folder. A block sends each
*distinct* hash once to the bucket of that hash, with a flag if it occurs there
twice. The bucket answers with one bit per hash. So a passage in a third of all
documents is one entry per block, and what returns to a block is a bitmap.
Three passes read the blocks: anchors, windows, removal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm import words as W
from hedonic.llm.frames import open_frame
from hedonic.session import materialise

WINDOW = 35
PERIOD = 21
#: A difference cover modulo 21: every residue is a difference of two members.
COVER = (3, 6, 7, 12, 14)
ANCHOR = WINDOW - PERIOD + 1
#: Characters of text in one block; a longer document is a block of its own.
BLOCK_CHARS = 4_000_000
#: Words hashed into windows at a time.
SPAN = 1 << 20
#: Bytes of hashes that one bucket holds on average.
BUCKET_BYTES = 24_000_000
#: Bytes of all answers up to which they are broadcast to the blocks.
BROADCAST_BYTES = 64_000_000

_POWERS = (W.Powers(0x27BB2EE687B0B0FD), W.Powers(0xB5026F5AA96619E9))
_SALT = np.uint64(0xD6E8FEB86659FD93)


def is_cover(cover, period: int) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def window_hashes(h: np.ndarray, start: np.ndarray, size: int, which: int) -> np.ndarray:
    """Hash of the ``size`` words from each (sorted) word index in ``start``; ``which`` of two independent families."""
    if which:
        h = W.mix(h ^ _SALT)
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        lo = int(start[i])
        j = int(np.searchsorted(start, lo + SPAN, side="left"))
        hi = int(start[j - 1]) + size
        up, down = _POWERS[which].get(hi - lo + 1)
        acc = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(h[lo:hi] * up[:hi - lo], dtype=np.uint64, out=acc[1:])
        s = start[i:j] - lo
        out[i:j] = (acc[s + size] - acc[s]) * down[s]
        i = j
    return W.mix(out)


class Block:
    """Words of one block of documents."""

    def __init__(self, data: bytes, sizes: list[int]):
        at = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=at[1:])
        self.words = W.split(np.frombuffer(data, np.uint8), at, W.NON_SPACE)
        self.hash = W.hash_words(self.words)
        n = self.words.counts
        self.index = np.arange(len(self.hash)) - np.repeat(self.words.first[:-1], n)  # within the document
        self.rest = np.repeat(self.words.first[1:], n) - np.arange(len(self.hash))  # words from here to its end

    def anchors(self, cover, period: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        on = np.zeros(period, bool)
        on[list(cover)] = True
        at = np.flatnonzero(on[self.index % period] & (self.rest >= size))
        return at, window_hashes(self.hash, at, size, 0)

    def candidates(self, anchor_at: np.ndarray, window: int, size: int) -> np.ndarray:
        """Starts of the windows that hold one of the given anchors."""
        n = len(self.hash)
        edge = np.zeros(n + 1, np.int64)
        lo = np.maximum(anchor_at + size - window, anchor_at - self.index[anchor_at])
        np.add.at(edge, lo, 1)
        np.add.at(edge, anchor_at + 1, -1)
        return np.flatnonzero((np.cumsum(edge[:-1]) > 0) & (self.rest >= window))


def distinct_hashes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hash rows in order, whether each occurs twice or more, place of each input among them).

    ``hashes``: one column per hash family; the first orders the rows."""
    if not len(hashes):
        return hashes, np.zeros(0, bool), np.zeros(0, np.int64)
    order = np.lexsort(hashes.T[::-1])
    s = hashes[order]
    new = np.r_[True, (s[1:] != s[:-1]).any(axis=1)]
    first = np.flatnonzero(new)
    place = np.empty(len(hashes), np.int64)
    place[order] = np.cumsum(new) - 1
    return s[first], np.diff(np.r_[first, len(s)]) > 1, place


def bucket_bounds(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's rows begin: buckets are equal ranges of the first hash."""
    width = (1 << 64) // buckets + 1
    edges = np.array([min(k * width, (1 << 64) - 1) for k in range(buckets)], np.uint64)
    return np.r_[np.searchsorted(hashes[:, 0], edges), len(hashes)] if len(hashes) else np.zeros(buckets + 1, int)


_BLOCKS = "block long, ids binary, sizes array<int>, data binary, n_bytes long"
_SENT = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("block", T.LongType()),
                      T.StructField("rows", T.BinaryType()), T.StructField("twice", T.BinaryType())])


def make_blocks(df: DataFrame, kept: list[str], text: str, block_chars: int) -> DataFrame:
    """Blocks of whole documents: kept columns (an Arrow stream), sizes and bytes of their texts."""
    src = df.select(*kept, F.col(text).cast("string").alias("body"))

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for part in parts:
            texts = part.column("body").to_pylist()
            held = part.select(kept)
            for lo, hi in W.batches(texts, block_chars):
                data, at = W.join_texts(texts[lo:hi])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, held.schema) as writer:
                    writer.write_batch(held.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << 32) + n]), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                     pa.array([np.diff(at).tolist()], pa.list_(pa.int32())), pa.array([data.tobytes()], pa.binary()),
                     pa.array([len(data)])], names=["block", "ids", "sizes", "data", "n_bytes"])
                n += 1

    return src.mapInArrow(scan, _BLOCKS)


def rows_of(raw: bytes, families: int) -> np.ndarray:
    return np.frombuffer(raw, "<u8").reshape(-1, families)


def send(block: int, hashes: np.ndarray, buckets: int) -> Iterator[tuple]:
    """(bucket, block, distinct hash rows, twice flags) of one block."""
    rows, twice, _ = distinct_hashes(hashes)
    at = bucket_bounds(rows, buckets)
    for k in range(buckets):
        if at[k + 1] > at[k]:
            yield k, block, rows[at[k]:at[k + 1]].astype("<u8").tobytes(), np.packbits(twice[at[k]:at[k + 1]]).tobytes()


def answer(sent: DataFrame, families: int) -> DataFrame:
    """(block, flags): per block and bucket, one bit for each row sent: does the hash occur anywhere else?

    A bucket holds its range of hashes, each once per block that has it: a bounded share, whatever repeats.
    """

    def judge(batch: pa.Table) -> pa.Table:
        block, raw, twice = (batch.column(c).to_pylist() for c in ("block", "rows", "twice"))
        size = [len(r) // (8 * families) for r in raw]
        every = np.concatenate([rows_of(r, families) for r in raw])
        flag = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n).astype(bool)
                               for t, n in zip(twice, size, strict=True)])
        _, again, place = distinct_hashes(every)
        hit = again[place] | flag  # in several blocks, or twice in its one block
        at = np.r_[0, np.cumsum(size)]
        bits = [np.packbits(hit[at[i]:at[i + 1]]).tobytes() for i in range(len(size))]
        return pa.table({"block": pa.array(block, pa.int64()), "bucket": batch.column("bucket"),
                         "n": pa.array(size, pa.int32()), "bits": pa.array(bits, pa.binary())})

    back = sent.groupBy("bucket").applyInArrow(judge, "block long, bucket int, n int, bits binary")
    return back.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "n", "bits"))).alias("flags"))


def flags_of(flags: list | None) -> np.ndarray:
    """One boolean for each distinct hash row of a block, in order."""
    if not flags:
        return np.zeros(0, bool)
    return np.concatenate([np.unpackbits(np.frombuffer(f["bits"], np.uint8), count=f["n"]) for f in flags]).astype(bool)


def _near(answers: DataFrame) -> DataFrame:
    """Answers on their way to the blocks: broadcast while all bitmaps are small, else joined by a shuffle."""
    bits = F.aggregate("flags", F.lit(0).cast("long"), lambda s, f: s + f["n"])
    total = answers.agg(F.sum(bits)).first()[0] or 0
    return F.broadcast(answers) if total // 8 <= BROADCAST_BYTES else answers


def _send_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                       pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2] for r in rows], pa.binary()),
                                       pa.array([r[3] for r in rows], pa.binary())],
                                      names=["bucket", "block", "rows", "twice"])


def remove_repeats(df: DataFrame, text: str = "text", window: int = WINDOW, period: int = PERIOD, cover=COVER,
                   keep: list[str] | None = None, block_chars: int = BLOCK_CHARS,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Columns ``keep`` (default: all but the text) of every document plus ``n_words, n_removed, kept_text``.

    ``kept_text`` holds the words outside duplicate windows, joined by one
    space. Words are runs outside the six ASCII white-space characters, compared
    unchanged. Null and empty texts have no words and an empty ``kept_text``;
    texts shorter than a window keep all words; every copy of a repeated row
    loses its repeated windows; an empty table gives no rows; texts of any
    length are read whole. A kept column with the name of an output is replaced.
    """
    if not is_cover(cover, period) or period > window:
        raise ValueError("not a difference cover of a period within the window")
    size = window - period + 1
    outputs = ("n_words", "n_removed", "kept_text")
    inner = open_frame(df, [c for c in df.columns if c.lower() != text.lower()] if keep is None else keep, outputs)
    blocks = materialise(make_blocks(inner.df, inner.kept, inner.name(text), block_chars))
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    # about one word in five bytes at most is an anchor's place times its density
    buckets = max(1, -(-int(total / 5 * len(cover) / period * 8) // bucket_bytes))
    wide = max(1, -(-int(total / 5 * 16) // bucket_bytes))  # if every window were a candidate
    plain = blocks.select("block", "sizes", "data")

    def anchors(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for block, sizes, data in zip(*(part.column(c) for c in ("block", "sizes", "data")), strict=True):
                b = Block(data.as_py(), sizes.as_py())
                _, h = b.anchors(cover, period, size)
                yield _send_batch(list(send(block.as_py(), h[:, None], buckets)))

    marked = materialise(answer(plain.mapInArrow(anchors, _SENT), 1))  # two passes read it

    def windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            cols = [part.column(c) for c in ("block", "sizes", "data", "flags")]
            for block, sizes, data, flags in zip(*cols, strict=True):
                b = Block(data.as_py(), sizes.as_py())
                at = _candidates(b, flags.as_py())
                h = np.column_stack([window_hashes(b.hash, at, window, k) for k in (0, 1)])
                yield _send_batch(list(send(block.as_py(), h, wide)))

    def _candidates(b: Block, flags: list | None) -> np.ndarray:
        at, h = b.anchors(cover, period, size)
        _, _, place = distinct_hashes(h[:, None])
        return b.candidates(at[flags_of(flags)[place]] if len(at) else at, window, size)

    marked = _near(marked)
    sent = plain.join(marked, "block").mapInArrow(windows, _SENT)
    second = _near(materialise(answer(sent, 2))).withColumnRenamed("flags", "repeats")
    final = blocks.select("block", "ids", "sizes", "data").join(marked, "block", "left").join(second, "block", "left")
    schema = T.StructType([*inner.df.select(*inner.kept).schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])

    def remove(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            cols = [part.column(c) for c in ("ids", "sizes", "data", "flags", "repeats")]
            for ids, sizes, data, flags, repeats in zip(*cols, strict=True):
                raw = data.as_py()
                b = Block(raw, sizes.as_py())
                n = b.words.counts
                gone = np.zeros(len(b.hash), bool)
                answers = flags_of(repeats.as_py())
                if len(answers):
                    at = _candidates(b, flags.as_py())
                    h = np.column_stack([window_hashes(b.hash, at, window, k) for k in (0, 1)])
                    _, _, place = distinct_hashes(h)
                    edge = np.zeros(len(b.hash) + 1, np.int64)
                    dup = at[answers[place]]
                    np.add.at(edge, dup, 1)
                    np.add.at(edge, dup + window, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                texts = [kept_words(raw, b.words, gone, i) for i in range(len(n))]
                held = pa.ipc.open_stream(ids.as_py()).read_next_batch()
                removed = np.add.reduceat(np.r_[gone, False], b.words.first[:-1]) * (n > 0) if len(n) else n
                yield pa.RecordBatch.from_arrays(
                    [*held.columns, pa.array(n.astype(np.int64)), pa.array(removed.astype(np.int64)),
                     pa.array(texts, pa.string())], names=[*held.schema.names, *outputs])

    return inner.close(final.mapInArrow(remove, schema), *outputs)


def kept_words(raw: bytes, w: W.Words, gone: np.ndarray, i: int) -> str:
    a, b = int(w.first[i]), int(w.first[i + 1])
    if not gone[a:b].any():
        return b" ".join(raw[w.doc_start[i]:w.doc_start[i + 1]].split()).decode()
    return b" ".join([raw[s:e] for s, e, g in zip(w.start[a:b].tolist(), w.end[a:b].tolist(), gone[a:b].tolist(),
                                                  strict=True) if not g]).decode()


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The contract's columns."""
    return found.select(doc_id, "n_words", "n_removed",
                        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def oracle_sql(window: int = WINDOW) -> str:
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, i, array_to_string(list_slice(w, i, i + {window - 1}), ' ') AS s
    FROM (SELECT r, w, unnest(range(1, len(w) - {window} + 2)) AS i FROM d WHERE len(w) >= {window})),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {window})) AS p FROM dup),
every AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS n FROM every ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(s, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""

"""Benchmark decontamination with suffix arrays over the training text.

Each Arrow batch of documents is one shard. Its text is reduced, without loss,
to runs of benchmark-vocabulary words long enough to hold a window (no window
can lie anywhere else), a word-level suffix array is built over those runs,
and every suffix of every benchmark item is binary-searched in it. That gives
each suffix's longest verbatim match and, for those at least a window long, all
places where the window stands.

Documents are never shuffled: a document lies whole in one shard, so the job is
one map over the table. The benchmark is the stated query set. It reaches the
tasks in blocks of at most ``BLOCK_CHARS`` characters, each a broadcast of
bounded size; a larger benchmark takes several maps, chained over the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm import words as W
from hedonic.llm.frames import open_frame

WINDOW = 13
#: A document is contaminated if at least one word in this many is hit.
ONE_WORD_IN = 20
#: Characters of benchmark text that one broadcast holds at most (one longer item stands alone).
BLOCK_CHARS = 16_000_000
#: Characters of documents in one shard; a longer document is a shard of its own.
SHARD_CHARS = 4_000_000
#: Matches measured together.
BLOCK_MATCHES = 1 << 18

_POWERS = W.Powers(0x9FB21C651E98DF25)
MATCH = "array<struct<item_id:string,item_word:int,doc_word:long,n_words:int>>"


@dataclass
class Items:
    """A block of benchmark items as vocabulary ids, item after item, 0 between them."""

    ids: list[str | None]
    vocab: np.ndarray  # sorted word hashes; a word's id is its place, from 1
    vocab_bytes: list[bytes]
    seq: np.ndarray  # int64 ids
    item_at: np.ndarray  # item of each place in seq
    pos: np.ndarray  # suffixes: place in seq, words to the item's end, window length (0: none starts here)
    rest: np.ndarray
    window: np.ndarray
    shortest: int  # shortest window


def prepare(rows: list[tuple[str | None, str | None]], window: int) -> Items:
    data, at = W.join_texts([t for _, t in rows])
    w = W.split(W.LOWER[data], at, W.ALNUM)
    h = W.hash_words(w)
    vocab, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    raw = w.data.tobytes()
    n = w.counts
    item = np.repeat(np.arange(len(rows)), n)
    place = np.arange(len(h)) + item  # one separator before each later item
    seq = np.zeros(len(h) + max(len(rows), 1) + 1, np.int64)
    seq[place] = inverse.reshape(-1) + 1
    item_at = np.zeros(len(seq), np.int64)
    item_at[place] = item
    rest = np.repeat(np.cumsum(n), n) - np.arange(len(h))
    length = np.minimum(n, window)[item] if len(item) else np.zeros(0, np.int64)
    return Items([i for i, _ in rows], vocab, [raw[w.start[k]:w.end[k]] for k in first], seq, item_at, place, rest,
                 np.where(rest >= length, length, 0), int(length.min(initial=window)))


def suffix_array(seq: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array by prefix doubling; suffixes that agree in ``depth`` words may stand in any order."""
    n = len(seq)
    _, rank = np.unique(seq, return_inverse=True)
    rank = rank.reshape(-1).astype(np.int64) + 1
    k = 1
    while n and k < depth and rank.max() < n:
        after = np.zeros(n, np.int64)
        after[:n - k] = rank[k:]
        _, rank = np.unique(rank * (n + 2) + after, return_inverse=True)
        rank = rank.reshape(-1).astype(np.int64) + 1
        k *= 2
    return np.argsort(rank, kind="stable")


def compare(seq: np.ndarray, at: np.ndarray, query: np.ndarray, pos: np.ndarray, length: np.ndarray):
    """(words in common, sign of suffix minus query), the query cut to ``length``; sign 0: it is a prefix."""
    common = np.zeros(len(at), np.int64)
    sign = np.zeros(len(at), np.int64)
    live = np.flatnonzero(length > 0)
    k = 0
    while len(live):
        p = at[live] + k
        a = np.where(p < len(seq), seq[np.minimum(p, len(seq) - 1)], -1)
        b = query[pos[live] + k]
        same = a == b
        sign[live[~same]] = np.sign(a[~same] - b[~same])
        live = live[same]
        k += 1
        common[live] = k
        live = live[length[live] > k]
    return common, sign


def bound(seq, sa, query, pos, length, upper: bool) -> np.ndarray:
    """Binary search of every query at once: the first suffix not below it, or above it."""
    lo = np.zeros(len(pos), np.int64)
    hi = np.full(len(pos), len(sa), np.int64)
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            return lo
        mid = (lo[live] + hi[live]) // 2
        _, sign = compare(seq, sa[mid], query, pos[live], length[live])
        right = sign <= 0 if upper else sign < 0
        lo[live[right]] = mid[right] + 1
        hi[live[~right]] = mid[~right]


def longest(seq, sa, items: Items) -> np.ndarray:
    """Words of the longest verbatim match of each benchmark suffix in the shard."""
    if not len(sa):
        return np.zeros(len(items.pos), np.int64)
    at = bound(seq, sa, items.seq, items.pos, items.rest, False)
    best = np.zeros(len(at), np.int64)
    for side in (at - 1, at):
        ok = (side >= 0) & (side < len(sa))
        common, _ = compare(seq, sa[np.clip(side, 0, len(sa) - 1)], items.seq, items.pos, np.where(ok, items.rest, 0))
        best = np.maximum(best, common)
    return best


def reduce_text(w: W.Words, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(vocabulary ids with 0 between runs, word index of each place) of the runs that can hold a window."""
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = W.hash_words(w)
    if not len(h) or not len(items.vocab):
        return empty
    seen = np.zeros(1 << 16, bool)
    seen[(items.vocab >> np.uint64(48)).astype(np.int64)] = True
    cand = np.flatnonzero(seen[(h >> np.uint64(48)).astype(np.int64)])
    at = np.minimum(np.searchsorted(items.vocab, h[cand]), len(items.vocab) - 1)
    ok = items.vocab[at] == h[cand]
    ids = np.zeros(len(h), np.int64)
    ids[cand[ok]] = at[ok] + 1
    doc = np.repeat(np.arange(len(w.first) - 1), w.counts)

    def runs(ids):
        inside = ids > 0
        start = np.flatnonzero(inside & np.r_[True, ~inside[:-1] | (doc[1:] != doc[:-1])])
        end = np.flatnonzero(inside & np.r_[~inside[1:] | (doc[1:] != doc[:-1]), True]) + 1
        keep = end - start >= items.shortest
        return start[keep], end[keep]

    start, end = runs(ids)
    if not len(start):
        return empty
    size = end - start
    index = np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    raw = w.data
    wrong = [i for i in index if raw[w.start[i]:w.end[i]].tobytes() != items.vocab_bytes[ids[i] - 1]]
    if wrong:  # two words with one hash: not the benchmark's word, so the run ends there
        ids[wrong] = 0
        start, end = runs(ids)
        size = end - start
        index = np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    run = np.repeat(np.arange(len(start)), size)
    seq = np.zeros(len(index) + len(start), np.int64)
    word = np.full(len(seq), -1, np.int64)
    place = np.arange(len(index)) + run
    seq[place] = ids[index]
    word[place] = index
    return seq, word


def common_words(seq: np.ndarray, at: np.ndarray, items: Items, pos: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Words that the shard from ``at`` and an item from ``pos`` have in common, ``least`` of which are known, within the
    item: by bisection over 64-bit hashes of beginnings (they only measure matches that were found by comparing)."""
    up, down = _POWERS.get(max(len(seq), len(items.seq)) + 1)
    sums = []
    for x in (seq, items.seq):
        acc = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(W.mix(x.astype(np.uint64) + np.uint64(1)) * up[:len(x)], dtype=np.uint64, out=acc[1:])
        sums.append(acc)
    rest = np.zeros(len(items.seq), np.int64)
    rest[items.pos] = items.rest
    out = least.copy()
    for i in range(0, len(at), BLOCK_MATCHES):
        a, p = at[i:i + BLOCK_MATCHES], pos[i:i + BLOCK_MATCHES]
        lo, hi = least[i:i + BLOCK_MATCHES].copy(), np.minimum(rest[p], len(seq) - a)
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = (sums[0][a + mid] - sums[0][a]) * down[a] == (sums[1][p + mid] - sums[1][p]) * down[p]
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        out[i:i + BLOCK_MATCHES] = lo
    return out


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the range, value) of all values lo to hi - 1."""
    n = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(n)), n)
    return which, np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())


def search(texts: list, items: Items):
    """Words of each document, hit words of all (boolean array), and the matches as arrays
    (document, item index, item word, document word, words), by document.

    Equal windows are one interval of the suffix array. Its places are marked together; and of the pairs of an item's
    window and a place only those are listed that differ in the word before, where a longest match begins. So a word
    repeated in both costs its windows and its longest matches, not the product of its windows.
    """
    data, at = W.join_texts(texts)
    w = W.split(W.LOWER[data], at, W.ALNUM)
    edge = np.zeros(len(w.start) + 1, np.int64)
    found = [tuple(np.zeros(0, np.int64) for _ in range(3))]  # place in the shard, place in the items, words
    seq, word = reduce_text(w, items)
    if len(seq):
        sa = suffix_array(seq, int(items.rest.max(initial=1)))
        best = longest(seq, sa, items)
        use = np.flatnonzero((items.window > 0) & (best >= items.window))
        for span in np.unique(items.window[use]):
            pos = items.pos[use[items.window[use] == span]]
            size = np.full(len(pos), span)
            lo = bound(seq, sa, items.seq, pos, size, False)
            hi = bound(seq, sa, items.seq, pos, size, True)
            first, one, which = np.unique(lo, return_index=True, return_inverse=True)  # equal windows, once
            which = which.reshape(-1)
            group, rank = ranges(first, hi[one])
            place = sa[rank]
            np.add.at(edge, word[place], 1)
            np.add.at(edge, word[place] + span, -1)
            before = np.where(place > 0, seq[place - 1], 0)
            key = group * (len(items.vocab) + 1) + before
            order = np.argsort(key, kind="stable")
            key, place = key[order], place[order]
            begin = np.searchsorted(group, np.arange(len(first) + 1))
            mine = np.where(pos > 0, items.seq[pos - 1], 0)
            a, b = begin[which], begin[which + 1]
            same = which * (len(items.vocab) + 1) + mine
            lo_same = np.where(mine > 0, np.searchsorted(key, same, side="left"), a)
            hi_same = np.where(mine > 0, np.searchsorted(key, same, side="right"), a)
            for x, y in ((a, lo_same), (hi_same, b)):
                q, at_place = ranges(x, y)
                found.append((place[at_place], pos[q], size[q]))
    place, pos, least = (np.concatenate(x) for x in zip(*found, strict=True))
    if len(place):
        words = common_words(seq, place, items, pos, least)
        at_word = word[place]
        doc = np.searchsorted(w.first, at_word, side="right") - 1
        item = items.item_at[pos]
        item_first = np.full(len(items.ids), np.iinfo(np.int64).max)
        np.minimum.at(item_first, items.item_at[items.pos], items.pos)
        order = np.lexsort((at_word, item, doc))
        matches = tuple(x[order] for x in (doc, item, pos - item_first[item], at_word - w.first[doc], words))
    else:
        matches = tuple(place for _ in range(5))
    return w.counts, w.first, np.cumsum(edge[:-1]) > 0, matches


def _blocks(bench: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple]]:
    """The benchmark in blocks of at most ``limit`` characters, each collected on its own."""
    rows = bench.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{text}`").cast("string").alias("t"))
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-total // limit) or 1
    if n == 1:
        yield [tuple(r) for r in rows.collect()]
        return
    # half-full on average, so that a block seldom passes the limit; a single longer item cannot be split
    key = F.pmod(F.xxhash64("i", "t"), F.lit(2 * n))
    for k in range(2 * n):
        yield [tuple(r) for r in rows.where(key == k).collect()]


def _add_matches(old: pa.ListArray, found: list[tuple], items: Items, kind: pa.ListType) -> pa.ListArray:
    """The lists of earlier blocks of the benchmark with the new matches behind them."""
    row, item, *places = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 5
    ids = pa.array(items.ids, pa.string()).take(pa.array(item))
    columns = [ids, *(pa.array(p).cast(f.type) for p, f in zip(places, list(kind.value_type)[1:], strict=True))]
    new = pa.StructArray.from_arrays(columns, fields=list(kind.value_type))
    size = old.value_lengths().fill_null(0).to_numpy()
    every = pa.concat_arrays([old.flatten().cast(kind.value_type), new])
    of = np.concatenate([np.repeat(np.arange(len(old)), size), row])
    at = np.r_[0, np.cumsum(np.bincount(of, minlength=len(old)))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), every.take(pa.array(np.argsort(of, kind="stable")))).cast(kind)


def find_contamination(docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS,
                       keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) of every document plus
    ``n_words, n_hit, item_ids (sorted strings), matches, contaminated``.

    ``matches`` are the maximal verbatim runs of at least a window: item,
    first word in the item, first word in the document, words. Null or empty
    texts have no words and are clean; an item without words matches nothing;
    an item without an id hits like others but is not listed; items that
    repeat count once per id; repeated documents are judged each; empty tables
    on either side give clean or no rows. A kept column with the name of an
    output is replaced. Texts of any length are read whole.
    """
    outputs = ("n_words", "n_hit", "item_ids", "matches", "contaminated")
    inner = open_frame(docs, keep, outputs)
    out = inner.df.select(*inner.kept, F.col(inner.name(text)).cast("string").alias("body"),
                          F.lit(None).cast("array<bigint>").alias("spans"), F.lit(None).cast(MATCH).alias("matches"),
                          F.lit(0).cast("long").alias("n_words"))
    base = out.columns
    arrow = {"spans": pa.list_(pa.int64()), "n_words": pa.int64(),
             "matches": pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int32()),
                                            ("doc_word", pa.int64()), ("n_words", pa.int32())]))}
    spark = docs.sparkSession
    for block in _blocks(bench, item_id, item_text, block_chars):
        shared = spark.sparkContext.broadcast(prepare(block, window))

        def scan(parts: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for part in parts:
                texts, earlier = (part.column(c).to_pylist() for c in ("body", "spans"))
                hits, count, found = [], [], []
                for lo, hi in W.batches(texts, SHARD_CHARS):
                    n, first, every, m = search(texts[lo:hi], items)
                    count += n.tolist()
                    found.append((m[0] + lo, *m[1:]))
                    for i in range(hi - lo):
                        hit, before = every[first[i]:first[i + 1]], earlier[lo + i] or []
                        for s, e in zip(before[0::2], before[1::2], strict=True):
                            hit[s:e] = True
                        hits.append(np.flatnonzero(np.diff(np.r_[False, hit, False])))
                new = {"spans": pa.array(hits, arrow["spans"]), "n_words": pa.array(count, arrow["n_words"]),
                       "matches": _add_matches(part.column("matches"), found, items, arrow["matches"])}
                yield pa.RecordBatch.from_arrays([new.get(c, part.column(c)) for c in base], names=base)

        out = out.mapInArrow(scan, out.schema)
    edges = F.coalesce(F.col("spans"), F.array().cast("array<bigint>"))
    n_hit = F.aggregate(edges, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("sign")),
                        lambda a, x: F.struct((a["sum"] + a["sign"] * x).alias("sum"), (-a["sign"]).alias("sign")),
                        lambda a: a["sum"])
    ids = F.array_sort(F.array_distinct(F.filter(F.transform("matches", lambda m: m["item_id"]),
                                                 lambda x: x.isNotNull())))
    out = out.withColumn("n_hit", n_hit).withColumn("item_ids", ids).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (ONE_WORD_IN * F.col("n_hit") >= F.col("n_words")))
    return inner.close(out, *outputs)


def remove_contaminated(docs: DataFrame, bench: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns. See ``find_contamination``."""
    inner = open_frame(docs)
    found = find_contamination(inner.df, bench, text=inner.name(text), **options)
    return inner.close(found.where(~F.col("contaminated")))


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The contract's columns."""
    return found.select(doc_id, "n_words", "n_hit", F.size("item_ids").cast(T.LongType()).alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
                        "contaminated")


def oracle_sql(window: int = WINDOW) -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{word}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{word}') AS w
    FROM benchmark),
bw AS (SELECT item_id, w, least({window}, len(w)) AS k,
    unnest(range(1, len(w) - least({window}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s FROM bw),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k),
hit AS (SELECT r, i, win.k, win.item_id FROM dw JOIN win
    ON win.k = dw.k AND win.s = array_to_string(list_slice(dw.w, dw.i, dw.i + dw.k - 1), ' ')),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  (coalesce(n_hit, 0) > 0 AND {ONE_WORD_IN} * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

"""Spelling variants: words at one edit from each other, found by pivotal grams.

The words are counted in one map over the texts and one shuffle of counts
already summed per batch. All bigrams get one global order, rarest first (there
are at most 8,100 of them). A word's *prefix* is its three rarest bigrams and
whatever ties with the last; its two *pivots* are the lightest pair of disjoint
bigrams of the prefix, chosen by dynamic programming over positions.

One edit destroys at most one of two disjoint bigrams. So of two near words,
the one whose prefix ends earlier in the order has a pivot that the other holds
in its prefix, at a position that the edit fixes: what lies on the far side of
the pivot is equal in both words. Pivots and prefixes are therefore joined on
that equal side and, where the edit lies between the pivots or in one of them,
on the outermost letter of the other end as well. Five such keys a word cover
every place an edit can have; levenshtein verifies inside the join.

Words are distinct, so a group of the join is bounded by the vocabulary, not by
the texts. Groups still too large, as estimated on a hashed share of the words,
are dealt to several parts, to each of which the pivots are copied. The estimate
decides only how the work is dealt, never what is compared.

Near words of one word are at most 91 * length + 90 (letters of the class), which
bounds every group keyed by a word. Forms at least grow tenfold along a chain,
so following them to the root takes a few rounds of pointer jumping.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.llm import words as W
from hedonic.session import bounded_broadcast, materialise

LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form has this many times the word's occurrences.
FACTOR = 10
#: One run in so many loses a code point before it is counted (the contract's planted misspellings).
LOSS = 31
#: Characters of text looked at together.
BATCH_CHARS = 4_000_000
#: Entries of one key that one task compares with the key's pivots, and the share of words the estimate reads.
GROUP, SHARE = 16_384, 16
#: Hot keys broadcast at most (some 40 bytes each).
BROADCAST_KEYS = 500_000
#: Bytes up to which checksums are taken column by column.
COLUMNS = 64


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t.astype(np.uint32)


CRC = _crc_table()
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


def runs(texts: list) -> W.Words:
    """Maximal runs of [A-Za-zÀ-ÿ] of each text, A-Z in lower case. In UTF-8 the class's upper half is C3 and a byte."""
    data, at = W.join_texts(texts)
    lead = data == 0xC3
    m = _LETTER[data] | lead
    m[1:] |= lead[:-1]
    return W.split_mask(W.LOWER[data], at, m)


def checksums(w: W.Words, prefix: list[bytes]) -> np.ndarray:
    """crc32 of each word's bytes after its text's prefix."""
    begin = np.array([zlib.crc32(p) ^ 0xFFFFFFFF for p in prefix], np.uint32)
    state = np.repeat(begin, w.counts)
    size = w.end - w.start
    order = np.argsort(-size, kind="stable")
    start, size, state = w.start[order], size[order], state[order]
    longest = int(size[0]) if len(size) else 0
    n_long = int(np.searchsorted(-size, -COLUMNS, side="left"))  # words beyond COLUMNS bytes, one by one
    for i in range(n_long):
        raw = w.data[start[i]:start[i] + size[i]].tobytes()
        state[i] = zlib.crc32(raw, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    for j in range(min(longest, COLUMNS)):
        hi = int(np.searchsorted(-size, -j, side="left"))  # words of more than j bytes
        s = state[n_long:hi]
        state[n_long:hi] = CRC[(s ^ w.data[start[n_long:hi] + j]) & np.uint32(255)] ^ (s >> np.uint32(8))
    out = np.empty(len(state), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def word_counts(texts: list, prefix: list[bytes], loss: int, least: int) -> pa.StructArray:
    """Distinct words (``values``) of these texts and their ``counts``."""
    w = runs(texts)
    points = np.cumsum(np.concatenate(([0], (w.data & 0xC0) != 0x80)), dtype=np.int64)
    length = points[w.end] - points[w.start]
    del points
    long = np.flatnonzero(length >= least)
    which = np.searchsorted(w.first[1:], long, side="right")
    kept = W.Words(w.data, w.doc_start, w.start[long], w.end[long],
                   np.concatenate(([0], np.cumsum(np.bincount(which, minlength=len(texts))))))
    h = checksums(kept, prefix)
    hit = h % loss == 0
    whole = W.strings(w.data, kept.start[~hit], kept.end[~hit])
    cut = []
    for i in np.flatnonzero(hit):
        word = w.data[kept.start[i]:kept.end[i]].tobytes().decode()
        k = int(h[i]) % len(word)
        if len(word) > least:
            cut.append(word[:k] + word[k + 1:])
    return pa.concat_arrays([whole, pa.array(cut, pa.string())]).value_counts()


def count_words(df: DataFrame, doc_id: str = "doc_id", text: str = "text", loss: int = LOSS,
                least: int = LEAST_LENGTH) -> DataFrame:
    """(word, n) of all texts, any n. A null id is an empty one."""
    src = df.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
                    F.col(text).cast("string").alias("body"))

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            body, ids = part.column("body").to_pylist(), part.column("id").to_pylist()
            for lo, hi in W.batches(body, BATCH_CHARS):
                found = word_counts(body[lo:hi], [f"{i}:".encode() for i in ids[lo:hi]], loss, least)
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "n"])

    return src.mapInArrow(scan, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Each bigram's place in the global order, rarest first, and the number of its places in words."""
    at = F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("at")
    grams = words.select("word", at).groupBy(F.expr("substring(word, at, 2)").alias("g")).count()
    # pairs of letters of a class of 90: at most 8,100 rows
    return {g: (i, n) for i, (g, n) in enumerate(sorted(grams.collect(), key=lambda r: (r["count"], r["g"])))}


def prefix_and_pivots(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[int], int, int, int]:
    """Positions of the prefix bigrams, the order of its last one, and the positions of the two pivots."""
    grams = [order[word[i:i + 2]] for i in range(len(word) - 1)]
    last = sorted(grams)[2][0]
    at = [i for i, g in enumerate(grams) if g[0] <= last]
    one = None  # lightest bigram that ends before the present one; the best pair so far
    two, j = None, 0
    for i in at:
        while at[j] + 2 <= i:
            one = min(x for x in (one, (grams[at[j]][1], at[j])) if x)
            j += 1
        if one:
            two = min(x for x in (two, (one[0] + grams[i][1], one[1], i)) if x)
    return at, last, two[1], two[2]


def pivot_keys(word: str, a: int, b: int) -> set[str]:
    """Keys of the pivots at a < b: the letters an edit leaves alone if it lies before, in, between or after them."""
    n = len(word)
    return {">" + word[a:],                                                   # before a
            (">" + word[b:] + "|" + word[0]) if a else "E" + word[2:],        # in a
            ">" + word[b:] + "|" + word[0],                                   # between
            ("<" + word[:a + 2] + "|" + word[-1]) if b + 2 < n else "F" + word[:-2],  # in b
            "<" + word[:b + 2]}                                               # after b


def prefix_keys(word: str, at: list[int]) -> set[str]:
    """Keys under which a word whose prefix bigrams stand at ``at`` must be found."""
    n, out = len(word), set()
    for i in at:
        out |= {">" + word[i:], "<" + word[:i + 2]}
        if i:
            out.add(">" + word[i:] + "|" + word[0])
        if i + 2 < n:
            out.add("<" + word[:i + 2] + "|" + word[-1])
    out |= {"E" + word[q:] for q in (1, 2, 3) if at[-1] >= q}
    return out | {"F" + word[:n - q] for q in (1, 2, 3) if at[0] + 2 <= n - q}


def entries(words: DataFrame, order: dict[str, tuple[int, int]], pivots: bool) -> DataFrame:
    """``key, word, n, last``: a row per key of the word's pivots or of its prefix."""

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys, rows, lasts = [], [], []
            for i, word in enumerate(part.column("word").to_pylist()):
                at, last, a, b = prefix_and_pivots(word, order)
                found = pivot_keys(word, a, b) if pivots else prefix_keys(word, at)
                keys += found
                rows += [i] * len(found)
                lasts.append(last)
            rows = np.array(rows, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), part.column("word").take(pa.array(rows)),
                 part.column("n").take(pa.array(rows)), pa.array(np.array(lasts, np.int32)[rows])],
                names=["key", "word", "n", "last"])

    return words.select("word", "n").mapInArrow(scan, "key string, word string, n long, last int")


def near_words(words: DataFrame, group: int = GROUP, share: int = SHARE) -> DataFrame:
    """(word, near, near_n), both ways, of words (word, n) at one edit. Words have at least four code points."""
    order = gram_order(words)
    r, s = entries(words, order, True), entries(words, order, False)
    sample = words.where(F.pmod(F.xxhash64("word"), F.lit(share)) == 0)
    hot = entries(sample, order, False).groupBy("key").agg(F.ceil(F.count("*") * share / group).alias("parts"))
    hot = bounded_broadcast(materialise(hot.where("parts > 1")), BROADCAST_KEYS)
    parts = F.coalesce("parts", F.lit(1))
    s = s.join(hot, "key", "left").withColumn("part", F.pmod(F.xxhash64("word"), parts)).drop("parts")
    r = r.join(hot, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    r, s = r.toDF("key", "r", "r_n", "r_last", "part"), s.toDF("key", "s", "s_n", "s_last", "part")
    pairs = r.join(s.hint("merge"), ["key", "part"]).where(
        (F.col("r_last") <= F.col("s_last")) & (F.abs(F.length("r") - F.length("s")) <= 1)
        & (F.levenshtein("r", "s", 1) == 1))
    both = F.explode(F.array(F.struct(F.col("r").alias("word"), F.col("s").alias("near"), F.col("s_n").alias("near_n")),
                             F.struct(F.col("s").alias("word"), F.col("r").alias("near"), F.col("r_n").alias("near_n"))))
    return pairs.select("r", "r_n", "s", "s_n").select(both.alias("p")).select("p.*").distinct()


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, by pointer jumping."""
    at = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        nxt = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = materialise(at.join(nxt, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"),
                                                               F.col("beyond").isNotNull().alias("moved")))
        if not step.where("moved").limit(1).count():
            return step.select("word", "root")
        at = step.select("word", "root")


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of counted words (word, n)."""
    words = materialise(words)
    # of equal n the smallest word: strings compare as their UTF-8 bytes, which is code-point order
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"),
                                                 F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("top"))
    large = -F.col("top.n") >= factor * F.col("n")
    out = materialise(words.join(best, "word", "left").select(
        "word", F.when(large, F.col("top.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(large, -F.col("top.n")).alias("form_n")))
    roots = follow(out.where("form IS NOT NULL"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                  "form_n")


def spelling_variants(df: DataFrame, doc_id: str = "doc_id", text: str = "text", loss: int = LOSS,
                      least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, factor: int = FACTOR) -> DataFrame:
    """The words of a table of texts with their commoner forms.

    Null and empty texts have no words, a null id counts as empty text before
    the colon; rows that repeat count again; texts and runs of any length are read
    whole; an empty table gives no rows; other columns are not read. Of near
    words that tie in n the smallest is the form.
    """
    if least < 4:
        raise ValueError("words need four code points for three bigrams")
    return group_variants(count_words(df, doc_id, text, loss, least).where(F.col("n") >= least_count), factor)


def crc32_sql(value: str) -> tuple[str, str]:
    """DuckDB expression: unsigned crc32 of a text's UTF-8 bytes, and the one-row table it needs beside it."""
    step = "CASE WHEN {x} & 1 = 1 THEN xor({x} >> 1, 3988292384) ELSE {x} >> 1 END"
    table = "list_transform(range(256), lambda t0: list_reduce(list_prepend(t0, range(8)), lambda x, k: " \
        + step.format(x="x") + "))"
    code = "list_transform(range(octet_length(encode({v}))), lambda i: ('0x' || substring(hex(encode({v})), 2 * i + 1, 2))::BIGINT)"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, {code.format(v=value)}), lambda c, b: "
            f"xor(c >> 8, crc_t[(xor(c, b) & 255) + 1])))"), f"crc_table AS (SELECT {table} AS crc_t)"


def oracle_sql(loss: int = LOSS, least: int = LEAST_LENGTH, factor: int = FACTOR) -> str:
    crc, table = crc32_sql("key")
    return f"""WITH RECURSIVE {table},
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{{least},}}')) AS run FROM documents),
low AS (SELECT translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run,
               coalesce(doc_id::VARCHAR, '') AS id FROM runs),
each AS (SELECT id || ':' || run AS key, run, count(*) AS n FROM low GROUP BY ALL),
h AS (SELECT run, n, {crc} AS h FROM each, crc_table),
w AS (SELECT CASE WHEN h % {loss} = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2)
             ELSE run END AS word, n FROM h),
words AS (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= {least} GROUP BY 1 HAVING sum(n) >= {LEAST_COUNT}),
holes AS (SELECT word, n, substring(word, 1, i) || '_' || substring(word, i + 2) AS k FROM words, range(length(word)) r(i)),
less AS (SELECT DISTINCT word, n, replace(k, '_', '') AS k FROM holes),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.k = b.k AND a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.k = b.word
         UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.k = b.word),
top AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY 1),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {factor} * n THEN near END AS form,
             CASE WHEN near_n >= {factor} * n THEN near_n END AS form_n FROM words LEFT JOIN top USING (word)),
chain AS (SELECT word, word AS root, form FROM f
          UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN f ON c.form = f.word)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM f JOIN chain c ON c.word = f.word AND c.form IS NULL"""

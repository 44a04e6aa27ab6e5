"""Language-model scores by subword lattices.

The pieces are those of an existing vocabulary file, whose scores give the
first weights: the file scores pieces by rank, which Zipf's law turns into
frequencies. The weights are then fitted to the corpus by expectation
maximisation over the lattices of all training words, until the likelihood
stops rising. The probability of a word is the sum over all its
segmentations into pieces, by the forward recursion in log space; the first
piece begins with the word mark, so the sum over all words is one.

A word seen in training is itself a piece: it keeps its discounted count, and
the discounts of all words are the weight of the lattice of smaller pieces
(interpolated absolute discounting; so the lattice is fitted to distinct words,
each counted once). What is learned thus grows with the corpus. The probability
of a text is the product over its words and its end.

Texts are read twice, in maps. The first sends distinct words with counts,
already summed per batch. Every distinct word is put through the lattice once. The
``TABLE`` commonest words go back to the texts as an array of that fixed size;
what a text holds beyond them is joined to the word table by a shuffle, and as
they are not among the commonest no key of that join is hot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm import words as W
from hedonic.llm.frames import open_frame
from hedonic.session import materialise

DEFAULT_VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
#: Texts of this remainder are held out.
FOLDS, HELD_OUT = 5, 1
#: Weight of the vocabulary's own scores, in pieces.
PRIOR = 1000.0
#: The fit ends with the round that raises the mean log likelihood of a word by less than this (nats).
GAIN = 1.0
#: Commonest words sent to the texts, at 24 bytes each.
TABLE = 500_000
BATCH_CHARS = 4_000_000
#: Words of one length put through the lattice together, and bytes of all of them.
CHUNK_WORDS, CHUNK_BYTES = 16_384, 1_000_000
#: Rows of the word table gathered in a task before they are sorted by length, if they have no more bytes than a chunk
#: of so many words may.
GATHER = 100_000
_BASE, _SPREAD, _BITS = 0x9E6D62D06F6A9A9B, 0x9E3779B97F4A7C15, 19

_cache: dict = {}


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(DEFAULT_VOCABULARY)


class Lattice:
    """Pieces of a vocabulary file, as byte strings. Pieces that no lower-cased word can hold are left out; every single
    byte is a piece, so every word has a segmentation."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        ranked, single = [], []
        for i in range(size):
            if model.is_byte(i):
                single.append(bytes([int(model.id_to_piece(i)[3:5], 16)]))
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = model.id_to_piece(i)
                if MARK not in piece[1:] and not any("A" <= c <= "Z" for c in piece):
                    ranked.append((-model.get_score(i), piece.encode()))
        ranked.sort()
        self.pieces = [p for _, p in ranked]
        known = set(self.pieces)
        self.pieces += [b for b in {bytes([i]) for i in range(256)} | set(single) if b not in known]
        ranks = np.array([r for r, _ in ranked] + [float(size)] * (len(self.pieces) - len(ranked)))
        self.prior = 1 / (ranks + 2.7)
        self.prior /= self.prior.sum()
        self.lengths = sorted({len(p) for p in self.pieces})
        self.power = [pow(_BASE, n, 1 << 64) for n in range(self.lengths[-1] + 1)]
        code = []
        for p in self.pieces:
            h = 0
            for b in p:
                h = (h * _BASE + b + 1) & (1 << 64) - 1
            code.append(h)
        code = np.array(code, np.uint64)
        self.order = np.argsort(code)
        self.code = code[self.order]
        if (self.code[1:] == self.code[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[self._slot(self.code)] = True
        self.mark = len(MARK.encode())

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h * np.uint64(_SPREAD)) >> np.uint64(64 - _BITS)

    def edges(self, chars: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each end position, (length, words, pieces) of the pieces that end there; ``chars``: position x word."""
        size, n = chars.shape
        h = np.zeros((size + 1, n), np.uint64)
        out: list[list] = [[]]
        for j in range(1, size + 1):
            h[j] = h[j - 1] * np.uint64(_BASE) + chars[j - 1] + np.uint64(1)
            here = []
            for k in self.lengths:
                if k > j or j - k < self.mark and j - k:  # no piece begins inside the word mark
                    continue
                part = h[j] - h[j - k] * np.uint64(self.power[k])
                at = np.flatnonzero(self.filter[self._slot(part)])
                if not len(at):
                    continue
                where = np.minimum(np.searchsorted(self.code, part[at]), len(self.code) - 1)
                same = self.code[where] == part[at]
                if j - k == 0 and j < self.mark:
                    continue
                if same.any():
                    here.append((k, at[same], self.order[where[same]]))
            out.append(here)
        return out

    def forward(self, edges, n: int, weight: np.ndarray) -> np.ndarray:
        """Log probability of every beginning: position x word."""
        a = np.full((len(edges), n), -np.inf)
        a[0] = 0
        for j in range(1, len(edges)):
            terms = [(at, a[j - k, at] + weight[ids]) for k, at, ids in edges[j]]
            top = np.full(n, -np.inf)
            for at, v in terms:
                top[at] = np.maximum(top[at], v)
            safe = np.where(np.isfinite(top), top, 0.0)
            total = np.zeros(n)
            for at, v in terms:
                total[at] += np.exp(v - safe[at])
            with np.errstate(divide="ignore"):
                a[j] = safe + np.log(total)
        return a

    def expect(self, edges, a: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of all words."""
        n = a.shape[1]
        b = np.full(a.shape, -np.inf)
        b[-1] = 0
        ids_of, uses = [np.zeros(0, np.int64)], [np.zeros(0)]
        for j in range(len(edges) - 1, 0, -1):
            for k, at, ids in edges[j]:
                v = weight[ids] + b[j, at]
                b[j - k, at] = np.logaddexp(b[j - k, at], v)
                ids_of.append(ids)
                uses.append(np.exp(a[j - k, at] + v - a[-1, at]))
        return np.bincount(np.concatenate(ids_of), np.concatenate(uses), len(weight)) if n else np.zeros(len(weight))

    def chunks(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(indices, position x word) of words of one length, the word mark before each."""
        raw = [(MARK + w).encode() for w in words]
        size = np.array([len(r) for r in raw], np.int64)
        order = np.argsort(size, kind="stable")
        lo = 0
        while lo < len(order):
            k = int(size[order[lo]])
            hi = int(np.searchsorted(size[order], k, side="right"))
            hi = min(hi, lo + max(1, min(CHUNK_WORDS, CHUNK_BYTES // k)))
            at = order[lo:hi]
            yield at, np.ascontiguousarray(np.frombuffer(b"".join(raw[i] for i in at), np.uint8).reshape(-1, k).T).astype(np.uint64)
            lo = hi

    def log_probability(self, words: list[str], weight: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability, over all its segmentations."""
        out = np.empty(len(words))
        for at, chars in self.chunks(words):
            out[at] = self.forward(self.edges(chars), len(at), weight)[-1]
        return out


def gathered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches in tables of about ``GATHER`` rows, or of as many as hold 32 bytes a row of that."""
    held: list[pa.RecordBatch] = []
    for part in parts:
        held.append(part)
        if sum(p.num_rows for p in held) >= GATHER or sum(p.nbytes for p in held) >= 32 * GATHER:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def lattice(path: str) -> Lattice:
    """One lattice per worker process and vocabulary."""
    if path not in _cache:
        _cache[path] = Lattice(path)
    return _cache[path]


# ---------------------------------------------------------------- words of texts
def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """Whether crc32 of the id as text has the remainder ``fold``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def split(texts: list) -> W.Words:
    data, at = W.join_texts(texts)
    return W.split(W.LOWER[data], at, W.NON_SPACE)


def word_table(src: DataFrame) -> DataFrame:
    """``word, c, n``: occurrences in training texts and in all, of (held, body). No text end among them."""

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            body, held = part.column("body").to_pylist(), np.array(part.column("held").to_pylist(), bool)
            for lo, hi in W.batches(body, BATCH_CHARS):
                w = split(body[lo:hi])
                of_held = np.repeat(held[lo:hi], w.counts)
                for flag in (False, True):
                    mine = of_held == flag
                    found = W.strings(w.data, w.start[mine], w.end[mine]).value_counts()
                    n = found.field("counts")
                    yield pa.RecordBatch.from_arrays(
                        [found.field("values"), pa.array(np.zeros(len(n), np.int64)) if flag else n, n],
                        names=["word", "c", "n"])

    return src.select("held", "body").mapInArrow(scan, "word string, c long, n long").groupBy("word").agg(
        F.sum("c").alias("c"), F.sum("n").alias("n"))


# ---------------------------------------------------------------- model
@dataclass
class Model:
    """Weights of the pieces and what the counts of the training texts add up to."""

    path: str
    weight: np.ndarray  # natural logs
    tokens: int  # of training texts, ends included
    distinct: int  # different ones, the end included
    ends: int  # training texts
    words: int  # different words
    discount: float
    history: list[float]  # mean log likelihood of a training word's lattice, per round

    def scores(self, c: np.ndarray, log_lattice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of each word's base and model probability, from its training count and its lattice."""
        base = np.log10(c + 0.5) - math.log10(self.tokens + 0.5 * (self.distinct + 1))
        with np.errstate(divide="ignore"):
            own = np.log(np.maximum(c - self.discount, 0))
        shared = math.log(self.discount * self.words + 0.5) + log_lattice
        return base, (np.logaddexp(own, shared) - math.log(self.tokens + 1)) / math.log(10)

    def end(self) -> tuple[float, float]:
        base = math.log10(self.ends + 0.5) - math.log10(self.tokens + 0.5 * (self.distinct + 1))
        return base, math.log10(self.ends + 0.5) - math.log10(self.tokens + 1)


def fit_weights(known: DataFrame, path: str, prior: float = PRIOR, gain: float = GAIN) -> tuple[np.ndarray, list[float]]:
    """Log weights of the pieces, fitted to the distinct words of ``known``, and the likelihood by rounds."""
    pieces = lattice(path)
    weight, history = np.log(pieces.prior), []

    def expectation(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = lattice(path)
        uses, total, n = np.zeros(len(weight)), 0.0, 0
        for part in gathered(parts):
            for at, chars in here.chunks(part.column("word").to_pylist()):
                edges = here.edges(chars)
                a = here.forward(edges, len(at), weight)
                uses += here.expect(edges, a, weight)
                total, n = total + a[-1].sum(), n + len(at)
        at = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1, -2], pa.int32()), pa.array([*uses[at], total, float(n)])],
                                         names=["piece", "uses"])

    while True:
        # one row per piece of the vocabulary at most
        got = known.select("word").mapInArrow(expectation, "piece int, uses double").groupBy("piece").agg(
            F.sum("uses")).collect()
        sums = dict(map(tuple, got))
        if not sums.get(-2):
            return weight, history
        history.append(sums.pop(-1) / sums.pop(-2))
        uses = prior * pieces.prior
        uses[list(sums)] += list(sums.values())
        weight = np.log(uses / uses.sum())
        if len(history) > 1 and history[-1] - history[-2] < gain:
            return weight, history


def learn(table: DataFrame, n_texts: int, path: str, prior: float = PRIOR, gain: float = GAIN) -> Model:
    """Model of a written word table (word, c, n) and the number of training texts."""
    one, two = (F.sum((F.col("c") == k).cast("long")) for k in (1, 2))
    tokens, words, n1, n2 = table.where("c > 0").agg(F.sum("c"), F.count("*"), one, two).first()
    weight, history = fit_weights(table.where("c > 0"), path, prior, gain)
    discount = n1 / (n1 + 2 * n2) if n1 else 0.5
    return Model(path, weight, (tokens or 0) + n_texts, words + (n_texts > 0), n_texts, words,
                 min(max(discount, 0.05), 0.95), history)


def score_words(table: DataFrame, model: Model) -> DataFrame:
    """``word, code, n, known, base, score`` of each word; ``code`` is its hash."""

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = lattice(model.path)
        for part in gathered(parts):
            words = part.column("word").to_pylist()
            c = part.column("c").to_numpy()
            base, score = model.scores(c, here.log_probability(words, model.weight))
            yield from pa.table(
                {"word": part.column("word"), "code": hashes(words).view(np.int64), "n": part.column("n"), "known": c > 0,
                 "base": base, "score": score}).to_batches()

    return table.mapInArrow(scan, "word string, code long, n long, known boolean, base double, score double")


def hashes(words: list[str]) -> np.ndarray:
    data, at = W.join_texts(words)
    return W.hash_words(W.Words(data, at, at[:-1], at[1:] - 1, np.arange(len(words) + 1)))


def commonest(scored: DataFrame, size: int = TABLE) -> tuple[np.ndarray, ...]:
    """Sorted codes, known flags, base and model scores of at most ``size`` words: all of the largest counts."""
    # different counts: at most the root of twice the number of tokens, of which only the largest are needed
    by_count = scored.groupBy("n").count().orderBy(F.col("n").desc()).limit(size).toLocalIterator()
    least, total = None, 0
    for n, words in by_count:
        if total + words > size:
            break
        least, total = n, total + words
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0), np.zeros(0)
    got = scored.where(F.col("n") >= least).select("code", "known", "base", "score").toArrow()
    code = got["code"].to_numpy().view(np.uint64)
    order = np.argsort(code)
    return code[order], *(np.asarray(got[c])[order] for c in ("known", "base", "score"))


def score_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
                keep: list[str] | None = None, table_size: int = TABLE, prior: float = PRIOR,
                gain: float = GAIN) -> DataFrame:
    """Columns ``keep`` (default: all but the text) plus ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``.

    Null and empty texts have one token, their end. Rows that repeat count and
    are returned each; a null id counts as an empty text for the fold; texts and
    words of any length are scored whole; an empty table gives no rows; without
    training texts the weights are those of the vocabulary; a kept column with the
    name of an output is replaced.
    """
    path = vocabulary or default_path()
    outputs = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    inner = open_frame(df, [c for c in df.columns if c.lower() != text.lower()] if keep is None else keep, outputs)
    kept = inner.kept
    src = inner.df.select(*kept, held_out(F.col(inner.name(doc_id))).alias("held"),
                          F.col(inner.name(text)).cast("string").alias("body"))
    table = materialise(word_table(src))
    model = learn(table, src.where("NOT held").count(), path, prior, gain)
    scored = materialise(score_words(table, model))
    common = df.sparkSession.sparkContext.broadcast(commonest(scored, table_size))
    end = model.end()
    end_known = int(model.ends > 0)
    sums = T.StructType.fromDDL("row long, word string, times long, n_tokens long, n_known long, base double, score double")
    schema = T.StructType([*src.select(*kept, "held").schema.fields, *sums.fields])

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, known, base, score = common.value
        row = TaskContext.get().partitionId() << 40
        for part in parts:
            body = part.column("body").to_pylist()
            for lo, hi in W.batches(body, BATCH_CHARS):
                w = split(body[lo:hi])
                n, h = hi - lo, W.hash_words(w)
                doc = np.repeat(np.arange(n), w.counts)
                at = np.minimum(np.searchsorted(code, h), max(len(code) - 1, 0))
                found = code[at] == h if len(code) else np.zeros(len(h), bool)
                d, at = doc[found], at[found]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).slice(lo, n) for c in (*kept, "held")), pa.array(np.arange(row, row + n)),
                     pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array(w.counts + 1),
                     pa.array(np.bincount(d[known[at]], minlength=n) + end_known),
                     pa.array(np.bincount(d, base[at], n) + end[0]), pa.array(np.bincount(d, score[at], n) + end[1])],
                    schema=_arrow_schema(part, schema))
                rare = np.flatnonzero(~found)
                # equal words of a text once, with their number
                order = rare[np.lexsort((h[rare], doc[rare]))]
                new = np.ones(len(order), bool)
                new[1:] = (h[order[1:]] != h[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
                begin = np.flatnonzero(new)
                times = np.diff(np.append(begin, len(order)))
                first = order[begin]
                for i in range(0, len(first), 100_000):
                    f = first[i:i + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.nulls(len(f), part.schema.field(c).type) for c in (*kept, "held")), pa.array(row + doc[f]),
                         W.strings(w.data, w.start[f], w.end[f]), pa.array(times[i:i + 100_000]),
                         *(pa.nulls(len(f), t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64()))],
                        schema=_arrow_schema(part, schema))
                row += n

    found = materialise(src.mapInArrow(scan, schema))
    rest = found.where("word IS NOT NULL").select(F.col("row").alias("at"), "word", "times").join(
        scored.select("word", "known", "base", "score"), "word")
    rest = rest.groupBy("at").agg(F.sum(F.when(F.col("known"), F.col("times")).otherwise(0)).alias("r_known"),
                                  F.sum(F.col("times") * F.col("base")).alias("r_base"),
                                  F.sum(F.col("times") * F.col("score")).alias("r_score"))
    out = found.where("word IS NULL").join(rest, F.col("row") == F.col("at"), "left")
    total = [(F.col(a) + F.coalesce(b, F.lit(0))).alias(c) for a, b, c in (
        ("n_known", "r_known", "n_known"), ("base", "r_base", "base_score"), ("score", "r_score", "score"))]
    return inner.close(out.select(*kept, F.col("held").alias("held_out"), "n_tokens", total[0],
                                  F.lit(model.tokens).cast("long").alias("train_tokens"), *total[1:]), *outputs)


def _arrow_schema(part: pa.RecordBatch, schema: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([pa.field(f.name, part.schema.field(f.name).type if f.name in part.schema.names
                               else kinds[f.dataType.simpleString()]) for f in schema.fields])

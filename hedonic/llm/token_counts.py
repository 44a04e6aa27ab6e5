"""Token counts from the exact length histogram.

Documents are encoded once and aggregated to (length, documents). Every answer
is then a prefix or suffix sum over the histogram: for each context limit the
documents and tokens that fit, the total after truncation, the share of
documents up to it (any quantile of length is read off there).

Only (length, count) pairs leave the encoding tasks, combined before the
shuffle. The sums run in two levels (blocks of lengths, then lengths inside a
block), so no task orders all lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm import tokens
from hedonic.llm.frames import open_frame
from hedonic.session import materialise

#: Lengths in one block of the two-level sums.
BLOCK = 4096


def lengths(df: DataFrame, text: str = "text", tokenizer: str | None = None,
            keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all but the text) and ``n_tokens``, each text's number of ids. Null or empty: 0."""
    tokenizer = tokenizer or tokens.default_path()
    inner = open_frame(df, [c for c in df.columns if c.lower() != text.lower()] if keep is None else keep,
                       ("n_tokens",))
    src = inner.df.select(*inner.kept, F.col(inner.name(text)).cast("string").alias("body"))
    kept = inner.kept

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        for part in parts:
            n = np.array([enc.count(t) for t in part.column("body").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(n)],
                                             names=[*kept, "n_tokens"])

    schema = T.StructType([*src.select(*kept).schema.fields, T.StructField("n_tokens", T.LongType())])
    return inner.close(src.mapInArrow(scan, schema), "n_tokens")


def histogram(counted: DataFrame) -> DataFrame:
    """(length, docs) of a table with ``n_tokens``."""
    return counted.groupBy(F.col("n_tokens").alias("length")).agg(F.count("*").alias("docs"))


def context_limits(hist: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per occurring length L: what a context limit of L tokens means for the corpus.

    ``docs`` and ``tokens`` of that length; ``docs_fitting`` and
    ``tokens_fitting`` up to it; ``docs_beyond`` and ``tokens_beyond`` above it;
    ``truncated_total``, the tokens left if every document is cut to L;
    ``share_fitting``, the quantile of L. Limits between two occurring lengths
    follow from the lower one: ``truncated_total + (limit - L) * docs_beyond``.
    An empty histogram gives no rows.
    """
    h = hist.select("length", "docs", (F.col("length") * F.col("docs")).alias("tokens"),
                    F.floor(F.col("length") / block).alias("block"))
    h = materialise(h)
    per = h.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    # one row per block of lengths: bounded by the longest document over the block size
    every = Window.orderBy("block")
    lower = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = per.select("block", F.coalesce(F.sum("d").over(lower), F.lit(0)).alias("d0"),
                     F.coalesce(F.sum("t").over(lower), F.lit(0)).alias("t0"),
                     F.sum("d").over(whole).alias("all_docs"), F.sum("t").over(whole).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("d", F.sum("docs").over(inside)).withColumn("t", F.sum("tokens").over(inside)).join(per, "block")
    fit, tok = F.col("d0") + F.col("d"), F.col("t0") + F.col("t")
    return h.select("length", "docs", "tokens", fit.alias("docs_fitting"), tok.alias("tokens_fitting"),
                    (F.col("all_docs") - fit).alias("docs_beyond"),
                    (F.col("all_tokens") - tok).alias("tokens_beyond"),
                    (tok + F.col("length") * (F.col("all_docs") - fit)).alias("truncated_total"),
                    (fit / F.col("all_docs")).alias("share_fitting"))


def count_tokens(df: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``context_limits`` of a table of texts. Null and empty texts count as documents of length 0; rows that repeat
    count each; other columns are not read; texts of any length are encoded whole."""
    return context_limits(histogram(lengths(df, text, tokenizer, keep=[])))

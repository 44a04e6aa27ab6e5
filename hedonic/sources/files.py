"""File sources and sinks.

Every path is a parameter. Scratch output of composed jobs goes under the
shared folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import csv
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic import schemas as S
from hedonic.functions.scalar import file_timestamp, hash_timestamp, round_half_even
from hedonic.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/hedonic-io/{name}-{uuid.uuid4().hex[:12]}"


def glob_literal(path: str) -> str:
    """The path as a pattern that matches itself only."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def decoded(col) -> F.Column:
    """Percent-decoded file path; '+' stands for itself in a path."""
    return F.url_decode(F.replace(col, F.lit("+"), F.lit("%2B")))


def file_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, header, n_rows) of every text file: its first non-blank line (null where all
    lines are blank; files of zero bytes are left out by Spark's listing) and the number of non-empty lines after it. One scan of the
    lines; counts and first lines are partial aggregates, one row per file."""
    listed = spark.read.format("binaryFile").load(paths).select(decoded(F.col("_metadata.file_path")).alias("path"))
    lines = spark.read.text(paths).select(
        decoded(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"), "value")
    first = F.min(F.when(F.col("at") == 0, F.struct("n", "value")))
    seen = lines.where(F.length(F.trim("value")) > 0).groupBy("path").agg(
        first["value"].alias("header"), (F.count(F.lit(1)) - 1).alias("n_rows"))
    return listed.join(seen, "path", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def header_names(header: str | None) -> list[str]:
    """Column names of a header line, without byte-order mark and outer blanks."""
    return [n.strip() for n in next(csv.reader([(header or "").lstrip("\ufeff")]), [])]


def _read_layout(spark: SparkSession, paths: list[str], names: list[str], schema: T.StructType) -> DataFrame:
    """Files that share one header: read as text columns, picked by name, then
    cast; an absent column or a value that does not parse is null."""
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .schema(T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))]))
           .csv([glob_literal(p) for p in paths]))
    cols = [F.col(f"_c{names.index(f.name)}").try_cast(f.dataType).alias(f.name) if f.name in names
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return raw.select(*cols, decoded(F.col("_metadata.file_name")).alias("source_file"))


def read_checked(spark: SparkSession, headers: DataFrame, schema: T.StructType,
                 required: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows of the files that pass the gate, and (path, reason, n_rows) of the others.

    ``headers`` comes from ``file_headers``. A file must hold every required
    column in its header and at least one row. Files are read once per
    distinct header, by column name, whatever their column order. The driver
    holds file names and headers, as Spark's own file listing does, no rows.
    """
    headers = headers.persist()
    layouts = headers.groupBy("header").agg(F.sort_array(F.collect_list(F.when(F.col("n_rows") > 0, F.col("path"))))
                                            .alias("paths")).collect()
    out = spark.createDataFrame([], T.StructType(list(schema.fields) + [T.StructField("source_file", T.StringType())]))
    reason = F.when(F.col("header").isNull(), F.lit("no header"))
    for lay in layouts:
        names = header_names(lay["header"])
        missing = [c for c in required if c not in names]
        if lay["header"] is not None and missing:
            reason = reason.when(F.col("header") == lay["header"], F.lit("missing: " + ",".join(missing)))
        elif lay["header"] is not None and lay["paths"]:
            out = out.unionByName(_read_layout(spark, lay["paths"], names, schema))
    reason = reason.when(F.col("n_rows") == 0, F.lit("no rows"))
    rejected = headers.select("path", reason.alias("reason"), "n_rows").where(F.col("reason").isNotNull())
    return out, rejected


def read_listings(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Header CSV scan (gzip or plain) by column name, tagged with the source
    file name and its timestamp (S1, S2, S4, X14). Each file's own header
    decides where its columns are. A directory or glob reads every file,
    duplicates kept. Gzip files cannot be split, so the rows are redistributed
    when ``partitions`` is given."""
    df, _ = read_checked(spark, file_headers(spark, path), schema or S.raw_schema())
    df = df.withColumn("file_ts", file_timestamp("source_file"))
    return df.repartition(partitions) if partitions else df


def read_distinct(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Directory union scan + whole-row distinct (S3)."""
    return read_listings(spark, path, schema).drop("source_file", "file_ts").distinct()


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Result sinks."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_slices(df: DataFrame, path: str) -> None:
    """Numbered slice sink (S10): one folder per ``slice_id``; only the
    partitions present in ``df`` are replaced (dynamic overwrite), which
    makes a re-run of a slice idempotent."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
       .partitionBy("slice_id").parquet(path))


def read_slices(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """Slice range scan with partition pruning (S5, S6); a missing table is an
    empty frame with the given schema."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:  # only a missing path is an empty table; a corrupt one is an error
        if schema is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if lo is not None:
        df = df.where(F.col("slice_id") >= lo)
    if hi is not None:
        df = df.where(F.col("slice_id") <= hi)
    return df


def sparse_tokens(field: int, cols: list[str]) -> F.Column:
    """Tokens ``field:i:v`` (3 decimals) of the non-zero values of a row's columns; null without any."""
    parts = []
    for i, c in enumerate(cols):
        v = round_half_even(F.col(c).cast("double"), 3)
        parts.append(F.when(F.col(c).cast("double") != 0, F.format_string(f"{field}:{i}:%.3f", v)))
    return F.nullif(F.concat_ws(" ", *parts), F.lit(""))


def sparse_line(label, fields: list[list[str] | str]) -> F.Column:
    """Field-aware sparse text line (S11): label with 4 decimals, then each field's tokens: a list of columns, or a
    column that holds its :func:`sparse_tokens`."""
    parts = [F.format_string("%.4f", round_half_even(label, 4))]
    return F.concat_ws(" ", *parts, *[F.col(x) if isinstance(x, str) else sparse_tokens(f, x) for f, x in enumerate(fields)])


def write_sparse_text(df: DataFrame, path: str, line_col: str = "line") -> None:
    """Lines as gzip text, a file a task: tasks should be of bounded size, as the files are read whole."""
    df.select(line_col).write.mode("overwrite").option("compression", "gzip").text(path)


#: Lines that are parsed by Arrow, all at once; any other is left to Spark's expressions, row by row.
PLAIN_LINE = r"^-?[0-9]{1,15}\.[0-9]{1,15}( [0-9]{1,9}:[0-9]{1,9}:-?[0-9]{1,15}\.[0-9]{1,15})*$"
_FEATS = pa.struct([("field", pa.int32()), ("idx", pa.int32()), ("val", pa.float64())])
_PARSED = "array<struct<field:int,idx:int,val:double>>"


def _parse(batches):
    """(odd, label, feats): the parsed lines, or those that are not plain as they are."""
    for batch in batches:
        line = pc.utf8_trim(batch.column(0), characters=" ")
        plain = pc.match_substring_regex(line, PLAIN_LINE)
        tokens = pc.split_pattern(pc.if_else(plain, line, "0.0"), " ")
        starts, flat = tokens.offsets.to_numpy(), tokens.values
        rest = np.ones(len(flat), bool)
        rest[starts[:-1]] = False
        parts = pc.split_pattern(flat.filter(pa.array(rest)), ":").values
        n = len(parts) // 3
        field, idx, val = (parts.take(pa.array(3 * np.arange(n) + i)).cast(f.type) for i, f in enumerate(_FEATS))
        feats = pa.ListArray.from_arrays(pa.array((starts - starts[0] - np.arange(len(starts))).astype(np.int32)),
                                         pa.StructArray.from_arrays([field, idx, val], fields=list(_FEATS)))
        yield pa.record_batch([pc.if_else(plain, pa.scalar(None, pa.string()), line),
                               flat.take(pa.array(starts[:-1])).cast(pa.float64()), feats], names=["odd", "label", "feats"])


def read_sparse_text(spark: SparkSession, path: str) -> DataFrame:
    """Sparse text scan (S12): label + array<struct<field,idx,val>>."""
    lines = spark.read.text(path).mapInArrow(_parse, f"odd string, label double, feats {_PARSED}")
    toks = F.split("odd", r"\s+")
    feats = F.transform(F.slice(toks, 2, F.greatest(F.size(toks) - 1, F.lit(0))), lambda s: F.struct(
        F.split(s, ":").getItem(0).cast("int").alias("field"), F.split(s, ":").getItem(1).cast("int").alias("idx"),
        F.split(s, ":").getItem(2).cast("double").alias("val")))
    plain = F.col("odd").isNull()
    return lines.select(F.when(plain, F.col("label")).otherwise(toks[0].cast("double")).alias("label"),
                        F.when(plain, F.col("feats")).otherwise(feats).alias("feats"))


def _fixed(v: np.ndarray, digits: int) -> tuple[pa.Array, np.ndarray]:
    """Texts with so many digits after the point, and which of them are sure: of numbers that have no more digits."""
    with np.errstate(invalid="ignore", over="ignore"):
        steps = np.rint(v * 10 ** digits)
        sure = (np.abs(v) < 1e9) & (np.abs(v * 10 ** digits - steps) < 1e-6) & ((steps != 0) | (v == 0))
    whole = np.where(sure, steps, 0).astype(np.int64)
    raw = np.stack([whole, whole >> 63], axis=1)        # 128 bits each
    text = pa.Array.from_buffers(pa.decimal128(18, digits), len(v), [None, pa.py_buffer(raw.tobytes())]).cast(pa.string())
    return pc.if_else(pa.array(np.signbit(v) & (whole == 0)), "-" + f"{0:.{digits}f}", text), sure


def _format(batches):
    """(line, label, feats): the rows' lines, or the rows that need Spark's own formatting."""
    for batch in batches:
        label, feats = batch.column("label"), batch.column("feats")
        flat, starts = feats.flatten(), np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(feats), 0).to_numpy())]
        numbers = [flat.field(i) for i in range(3)]
        known = np.logical_and.reduce([c.is_valid().to_numpy(zero_copy_only=False) for c in (flat, *numbers)])
        val, sure = _fixed(pc.fill_null(numbers[2], 0.0).to_numpy(), 3)
        tokens = pc.binary_join_element_wise(*[pc.fill_null(c, 0).cast(pa.string()) for c in numbers[:2]], val, ":")
        first, plain = _fixed(pc.fill_null(label, 0.0).to_numpy(), 4)
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), tokens)
        rest = pc.binary_join(lists, " ")
        line = pc.if_else(pa.array(np.diff(starts) > 0), pc.binary_join_element_wise(first, rest, " "), first)
        bad = np.r_[0, np.cumsum(~(known & sure))]
        plain &= (bad[starts[1:]] == bad[starts[:-1]]) & label.is_valid().to_numpy(zero_copy_only=False) \
            & feats.is_valid().to_numpy(zero_copy_only=False)
        ok = pa.array(plain)
        yield pa.record_batch([pc.if_else(ok, line, pa.scalar(None, pa.string())), pc.if_else(ok, pa.scalar(None, pa.float64()), label),
                               pc.if_else(ok, pa.scalar(None, feats.type), feats)], names=["line", "label", "feats"])


def parsed_lines(parsed: DataFrame) -> DataFrame:
    """The ``line`` of each row of :func:`read_sparse_text`: the label with 4 decimals, then ``field:idx:val`` with 3."""
    out = parsed.select("label", "feats").mapInArrow(_format, f"line string, label double, feats {_PARSED}")
    tokens = F.transform("feats", lambda f: F.format_string("%d:%d:%.3f", f["field"], f["idx"], f["val"]))
    line = F.concat_ws(" ", F.format_string("%.4f", "label"), tokens)
    return out.select(F.coalesce("line", line).alias("line"))


def save_state(df: DataFrame, path: str) -> None:
    """Fitted lookup state / neighbour edge tables as parquet."""
    df.write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_fanout(df: DataFrame, paths: list[str], fmt: str = "parquet") -> None:
    """Same result to several places (S16): computed once (persisted), written twice."""
    cached = df.persist()
    try:
        for p in paths:
            write_table(cached, p, fmt)
    finally:
        cached.unpersist()


def split_batch_files(df: DataFrame, name_col: str = "source_file") -> tuple[DataFrame, DataFrame]:
    """Prediction batch split by file name (S8): ``*_condo*`` files are condos,
    the rest houses; both tagged with the file timestamp (X14)."""
    tagged = df.withColumn("file_ts", file_timestamp(name_col))
    is_condo = F.col(name_col).contains("_condo")
    return tagged.where(is_condo), tagged.where(~is_condo)


def merge_results(results: DataFrame, ts_col: str = "file_ts", file_col: str = "source_file",
                  max_files: int | None = None) -> DataFrame:
    """Union of result files sharing a timestamp (S17); the in-folder variant
    drops a timestamp that already has ``max_files`` or more files."""
    if max_files is None:
        return results
    counts = results.groupBy(ts_col).agg(F.countDistinct(file_col).alias("_nf"))
    keep = counts.where(F.col("_nf") < max_files).select(ts_col)
    return results.join(keep, ts_col, "left_semi")


def name_kind(name_col: str = "source_file") -> F.Column:
    """Feed of a landing file from its name prefix: 'Sold' or 'Listing' (T3, X15)."""
    n = F.col(name_col)
    return F.when(n.startswith("Sold#"), "Sold").when(n.startswith("Listing#"), "Listing")


def name_ts(name_col: str = "source_file") -> F.Column:
    return hash_timestamp(name_col)

"""Chat formatting by token-level assembly.

Role and text of every turn are encoded on their own and spliced between
reserved ids, which lie above the vocabulary: no text can produce them. Token
positions and loss masks are prefix sums of segment lengths over the turns of a
conversation. Where the stream is rendered as a string, each reserved id has a
control string; control strings that occur in content are escaped reversibly.

Turns are encoded where they lie; one shuffle by conversation orders them. The
prefix sums are running windows and reading back folds sorted turns one by one,
so a conversation of any length passes through a task without being held there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm import tokens
from hedonic.llm.frames import open_frame

# Control strings that stand for the reserved ids, in their order, and those of other common
# templates. Content must hold none of them. '<' and '[' occur only as a control string's first character.
TURN, HEADER, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = [TURN, HEADER, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]"]
LOSS_ROLE = "assistant"


def _patterns() -> list[str]:
    """For each first character: it with any number of backslashes, then the rest of a control string."""
    return [rf"({re.escape(first)}\\*)({'|'.join(re.escape(c[1:]) for c in CONTROL if c[0] == first)})"
            for first in "<["]


_FOUND = [re.compile(p) for p in _patterns()]
_MARKED = [re.compile(p.replace(r"\\*)", r"\\*)\\", 1)) for p in _patterns()]


def escape(text: str) -> str:
    """Puts one backslash more after the first character of every control string; see ``unescape``."""
    for p in _FOUND:
        text = p.sub(r"\1\\\2", text)
    return text


def unescape(text: str) -> str:
    """Takes one backslash away again; the exact inverse of ``escape`` on its results."""
    for p in _MARKED:
        text = p.sub(r"\1\2", text)
    return text


def encode_turns(df: DataFrame, role: str, text: str, tokenizer: str, carry: list[str]) -> DataFrame:
    """``carry`` and each turn's ids (little-endian, 4 bytes): TURN, role, HEADER, text, END; the numbers of its ids,
    of the ids before its text, and of its rendered characters."""
    first = tokens.vocabulary_size(tokenizer)
    src = df.select(*carry, F.coalesce(F.col(role).cast("string"), F.lit("")).alias("who"),
                    F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))
    names = [*carry, "who", "body", "ids", "n_ids", "before", "chars"]
    schema = T.StructType([*src.schema.fields, T.StructField("ids", T.BinaryType()),
                           T.StructField("n_ids", T.LongType()), T.StructField("before", T.LongType()),
                           T.StructField("chars", T.LongType())])

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer, literal=True)
        turn, header, end = (np.array([first + k], "<u4") for k in range(3))
        for part in parts:
            ids, n, before, chars = [], [], [], []
            for who, body in zip(part.column("who").to_pylist(), part.column("body").to_pylist(), strict=True):
                who, body = escape(who), escape(body)
                a, b = enc.encode(who), enc.encode(body)
                ids.append(np.concatenate((turn, a, header, b, end)).astype("<u4").tobytes())
                n.append(len(a) + len(b) + 3)
                before.append(len(a) + 2)
                chars.append(len(TURN) + len(who) + len(HEADER) + len(body) + len(END))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary()), pa.array(n, pa.int64()),
                                              pa.array(before, pa.int64()), pa.array(chars, pa.int64())], names=names)

    return src.mapInArrow(scan, schema)


def format_conversations(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", tokenizer: str | None = None,
                         loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per turn: ``conv_id, turn_no`` (from 1), ``ids, token_start, loss_start, loss_end, chars_end``.

    A conversation is its rows' ids one after the other. ``token_start`` is the
    place of the turn's first id in it, ``[loss_start, loss_end)`` the ids under
    the loss mask (empty unless the role is ``loss_role``: exactly its text's
    ids), ``chars_end`` the rendered characters so far. All are prefix sums.
    Rows come partitioned by conversation and sorted in it.

    Turns are ordered by turn (null first), then role, then text; rows that
    repeat are turns of their own. Null roles and texts are empty. Rows without
    a conversation id form one conversation with a null id. An empty table
    gives no rows; other columns are not read; texts of any length are encoded
    whole.
    """
    tokenizer = tokenizer or tokens.default_path()
    inner = open_frame(df, [conv_id], ())
    key, order = inner.name(conv_id), inner.name(turn)
    carry = [key] if key == order else [key, order]
    turns = encode_turns(inner.df, inner.name(role), inner.name(text), tokenizer, carry)
    sort = [F.col(order).asc_nulls_first(), F.col("who"), F.col("body")]
    by = Window.partitionBy(key).orderBy(*sort)
    so_far = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    loss = F.col("who") == loss_role
    out = (turns.withColumn("turn_no", F.row_number().over(by).cast("long"))
           .withColumn("token_end", F.sum("n_ids").over(so_far))
           .withColumn("chars_end", F.sum("chars").over(so_far))
           .withColumn("token_start", F.col("token_end") - F.col("n_ids"))
           .withColumn("loss_start", F.col("token_start") + F.col("before"))
           .withColumn("loss_end", F.when(loss, F.col("token_end") - 1).otherwise(F.col("loss_start"))))
    return out.select(F.col(key).alias("conv_id"), "turn_no", "ids", "token_start", "loss_start", "loss_end",
                      "chars_end")


def read_back(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """What the formatted ids say, per conversation: the contract's columns.

    Takes the rows of ``format_conversations`` as they come (one conversation
    after the other, in order) and keeps running hashes only.
    """
    tokenizer = tokenizer or tokens.default_path()
    first = tokens.vocabulary_size(tokenizer)
    kind = turns.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("n_turns", T.LongType()),
                           T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                           T.StructField("loss_sha256", T.StringType()),
                           T.StructField("formatted_chars", T.LongType())])

    def fold(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer, literal=True)
        key, state, done, conv_type = None, None, [], None

        def batch():
            cols = list(zip(*done, strict=True)) if done else [[]] * 6
            types = (conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)],
                                             names=schema.names)
            done.clear()
            return out

        def close():
            if state:
                n, every, chars, loss, shown = state
                done.append((key, n, every.hexdigest(), chars, loss.hexdigest(), shown))

        for part in parts:
            conv_type = part.schema.field("conv_id").type
            cols = [part.column(c).to_pylist() for c in ("conv_id", "ids", "token_start", "loss_start", "loss_end",
                                                         "turn_no")]
            for conv, raw, start, lo, hi, number in zip(*cols, strict=True):
                if number == 1:
                    close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.frombuffer(raw, "<u4")
                mark = np.flatnonzero(ids >= first)
                if [*ids[mark] - first] != [0, 1, 2] or mark[0] != 0 or mark[2] != len(ids) - 1:
                    raise ValueError(f"conversation {conv}: not one turn between reserved ids")
                who, body = enc.decode(ids[1:mark[1]]), enc.decode(ids[mark[1] + 1:-1])
                state[0] += 1
                state[1].update(f"{unescape(who)}\n{unescape(body)}\n".encode())
                under = unescape(enc.decode(ids[lo - start:hi - start]))
                state[2] += len(under)
                state[3].update(under.encode())
                state[4] += len(TURN) + len(who) + len(HEADER) + len(body) + len(END)
            yield batch()
        close()
        if done:
            yield batch()

    return turns.mapInArrow(fold, schema)


def oracle_sql(extra: str) -> str:
    def escaped(column: str) -> str:
        for p in _patterns():
            column = f"regexp_replace({column}, '{p}', '\\1\\\\\\2', 'g')"
        return column

    fixed = len(TURN) + len(HEADER) + len(END)
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL {extra}),
e AS (SELECT *, length({escaped('role')}) + length({escaped('text')}) + {fixed} AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{LOSS_ROLE}'), ''))
    AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id
"""

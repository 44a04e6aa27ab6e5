"""Prefix tries of conversations: adaptive radix trees over fixed-width turn ids.

A turn (role, text) becomes an id of 16 bytes, big-endian: its words (4 bytes)
and 12 bytes of a hash of role and text, so texts are never shuffled. A
conversation is the string of its ids. Spark orders these strings (with the
conversation's number, so that equal ones can lie in several parts) by range;
each task puts its range into an adaptive radix tree, and the tree emits a node
at every depth that is a whole number of turns, also inside compressed paths.

A node whose members all lie in one part is final. Only prefixes of a part's
first or last string can go on in another part; these *border* nodes, at most
two paths a part, are summed by a second, small pass that walks their paths in
order. So a first turn that a third of all conversations share is cut into as
many parts as its size asks for, and only its counts meet.

Conversations of more than ``SEGMENT`` turns are cut into segments; a segment's
tree is that of all conversations with the same turns before it. Deeper
segments are done first, and what their trees sum up to hangs below the last
node of the segment before. So no task holds more than its range of segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hedonic.llm.spelling import crc32_sql
from hedonic.session import bounded_broadcast, materialise

#: Bytes of a turn id: words, then hash.
WIDTH = 16
#: Turns of a conversation in one tree.
SEGMENT = 4096
#: Bytes of ids and of conversation numbers a task orders and puts into its tree.
PART_BYTES = 4_000_000
#: Border nodes broadcast at most (some 100 bytes each).
BROADCAST_NODES = 500_000
#: A conversation takes the first turns of the first in its block of so many; at most one turn less than this.
BLOCK, HEADS = 20, 4


# ---------------------------------------------------------------- adaptive radix tree
class Small:
    """Up to 4 or 16 children: sorted bytes and the children beside them."""

    def __init__(self, size: int, items=()):
        self.size, self.bytes = size, bytearray(b for b, _ in items)
        self.nodes = [n for _, n in items]

    def get(self, b: int):
        i = self.bytes.find(b)
        return self.nodes[i] if i >= 0 else None

    def put(self, b: int, node) -> bool:
        i = self.bytes.find(b)
        if i >= 0:
            self.nodes[i] = node
            return True
        if len(self.nodes) == self.size:
            return False
        i = sum(x < b for x in self.bytes)
        self.bytes.insert(i, b)
        self.nodes.insert(i, node)
        return True

    def items(self):
        return zip(self.bytes, self.nodes, strict=True)


class Indexed:
    """Up to 48 children: a table from byte to the place of the child."""

    def __init__(self, items=()):
        self.index, self.nodes = bytearray(256), []
        for b, n in items:
            self.put(b, n)

    def get(self, b: int):
        return self.nodes[self.index[b] - 1] if self.index[b] else None

    def put(self, b: int, node) -> bool:
        if self.index[b]:
            self.nodes[self.index[b] - 1] = node
            return True
        if len(self.nodes) == 48:
            return False
        self.nodes.append(node)
        self.index[b] = len(self.nodes)
        return True

    def items(self):
        return ((b, self.nodes[i - 1]) for b, i in enumerate(self.index) if i)


class Full:
    """A place for each of the 256 bytes."""

    def __init__(self, items=()):
        self.nodes = [None] * 256
        for b, n in items:
            self.nodes[b] = n

    def get(self, b: int):
        return self.nodes[b]

    def put(self, b: int, node) -> bool:
        self.nodes[b] = node
        return True

    def items(self):
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


def larger(layout):
    """The next larger layout with the same children."""
    if isinstance(layout, Small):
        return Small(16, list(layout.items())) if layout.size == 4 else Indexed(layout.items())
    return Full(layout.items())


@dataclass
class Node:
    path: bytes  # compressed: the bytes from the parent's branch to this node, the branching byte included
    children: object = field(default_factory=lambda: Small(4))
    value: object = None


class Art:
    """Byte strings to values; a string may be the beginning of another."""

    def __init__(self):
        self.root = Node(b"")

    def put(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                self._hang(node, Node(key[at:], value=value))
                return
            same = _common(child.path, key, at)
            if same < len(child.path):  # split the compressed path
                upper = Node(child.path[:same])
                child.path = child.path[same:]
                self._hang(upper, child)
                self._hang(node, upper)
                child = upper
            node, at = child, at + same
        node.value = value

    def get(self, key: bytes):
        node, at = self.root, 0
        while at < len(key):
            node = node.children.get(key[at])
            if node is None or key[at:at + len(node.path)] != node.path:
                return None
            at += len(node.path)
        return node.value

    @staticmethod
    def _hang(node: Node, child: Node) -> None:
        while not node.children.put(child.path[0], child):
            node.children = larger(node.children)


def _common(path: bytes, key: bytes, at: int) -> int:
    n = min(len(path), len(key) - at)
    if path[:n] == key[at:at + n]:
        return n
    lo, hi = 0, n  # path[:lo] is common, path[:hi] is not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if path[:mid] == key[at:at + mid] else (lo, mid)
    return lo


# ---------------------------------------------------------------- sums over one tree
@dataclass
class Value:
    """What ends at a string: how many, the smallest, the conversations that end for good, what goes on deeper."""

    n: int = 0
    least: int | None = None
    ends: list = field(default_factory=list)
    below: tuple[int, int, int] = (0, 0, 0)  # children, leaves, saved tokens of deeper segments


@dataclass
class Sums:
    """Of one prefix. ``open``: it may go on in another part; then only what surely lies here is summed."""

    key: bytes
    open: bool
    n: int
    least: int
    children: int
    leaves: int
    saved: int
    value: Value | None


def words_of(key: bytes) -> int:
    return int.from_bytes(key[-WIDTH:4 - WIDTH], "big") if key else 0


def walk(tree: Art, first: bytes | None, last: bytes | None) -> Iterator[Sums]:
    """Every prefix of whole turns, each after all below it and the root last. Prefixes of ``first`` or ``last`` are
    open; an open prefix adds nothing but its members to the one above."""
    stack, sums = [(tree.root, b"", False)], []
    while stack:
        node, before, done = stack.pop()
        key = before + node.path
        if not done:
            stack.append((node, before, True))
            sums.append([0, None, 0, 0, 0])  # members, smallest, children, leaves, saved tokens
            stack.extend((child, key, False) for _, child in node.children.items())
            continue
        acc, value = sums.pop(), node.value
        if value is not None:
            acc[0] += value.n
            acc[1] = value.least if acc[1] is None else min(acc[1], value.least)
        at = len(key) - len(key) % WIDTH
        while at > len(before) or not at and node is tree.root:  # also depths inside the compressed path
            prefix, here = key[:at], value if at == len(key) else None
            is_open = first is not None and first.startswith(prefix) or last is not None and last.startswith(prefix)
            if here is not None and not is_open:
                acc[2:] = [x + y for x, y in zip(acc[2:], here.below, strict=True)]
            if not is_open:
                acc[3] = acc[3] if acc[2] else 1
                acc[4] += (acc[0] - 1) * words_of(prefix)
            yield Sums(prefix, is_open, *acc, here)
            acc[2:] = [0, 0, 0] if is_open else [1, acc[3], acc[4]]
            if not at:
                return
            at -= WIDTH
        up = sums[-1]
        up[0] += acc[0]
        up[1] = acc[1] if up[1] is None else min(up[1], acc[1])
        up[2:] = [x + y for x, y in zip(up[2:], acc[2:], strict=True)]


def node_id(level: int, prior: bytes, key: bytes) -> bytes:
    """Of the prefix ``key`` in the tree of the segments after ``prior``, itself the id of the node they follow."""
    return hashlib.md5(b"%d:%d:" % (level, len(prior)) + prior + key).digest()


def joined(ids: list) -> str:
    return ",".join(map(str, ids))


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


NO_ENDS = digest_of("")


# ---------------------------------------------------------------- Spark
def turns_with_ids(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, at, id``: the turns of each conversation in order (null first), equal turn numbers by id."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    words = F.size(F.regexp_extract_all(t, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    code = F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t).cast("binary"), 256)
    ids = F.unhex(F.concat(F.lpad(F.hex(words.cast("long")), 8, "0"), F.left(code, F.lit(2 * WIDTH - 8))))
    src = df.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), ids.alias("id")).where(
        "conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    return src.select("conv_id", (F.row_number().over(order) - 1).alias("at"), "id")


def rebuild(turns: DataFrame, block: int = BLOCK, heads: int = HEADS) -> DataFrame:
    """``conv_id, at, id``: the first h turns of the first conversation of the block, then the conversation's own after
    its first h; h is the checksum of its number modulo ``heads``. A row without id stands for each conversation."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    base = F.col("conv_id") - F.col("conv_id") % block
    convs = turns.where("at = 0").select("conv_id", base.alias("base"), h.alias("h"))
    head = turns.where((F.col("conv_id") % block == 0) & (F.col("at") < heads - 1)).select(
        F.col("conv_id").alias("base"), "at", "id")
    # at most ``block`` conversations a block and ``heads`` turns each
    given = convs.where("h > 0").join(head, "base").where("at < h").select("conv_id", "at", "id")
    own = turns.where(F.col("at") >= h).select("conv_id", (F.col("at") + heads).alias("at"), "id")
    return convs.select("conv_id", F.lit(-1).alias("at"), F.lit(None).cast("binary").alias("id")).unionByName(
        given).unionByName(own)


def segments(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """``conv_id, level, prior, key, last`` of turns (conv_id, at, id): the ids of each ``size`` turns in a row."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, level, prior, key = None, 0, b"", bytearray()
        for part in parts:
            for c, i in zip(part.column("conv_id").to_pylist(), part.column("id").to_pylist(), strict=True):
                if c != conv:
                    if conv is not None:
                        out.append((conv, level, prior, bytes(key), True))
                    conv, level, prior, key = c, 0, b"", bytearray()
                if i is None:
                    continue
                if len(key) == size * WIDTH:
                    out.append((conv, level, prior, bytes(key), False))
                    level, prior, key = level + 1, node_id(level, prior, bytes(key)), bytearray()
                key += i
            if out:
                yield _batch(out, schema)
                out = []
        if conv is not None:
            yield _batch([(conv, level, prior, bytes(key), True)], schema)

    schema = "conv_id long, level int, prior binary, key binary, last boolean"
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(cut, schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(),
          "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(f.split(" ") for f in schema.split(", ")), strict=True)
    cols = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, t in zip(cols, types, strict=True)], names=names)


#: What a part gives: final nodes, open ones with the part's share, and sums of whole trees of deeper segments.
FINAL, OPEN, TREE = 0, 1, 2
_PART = (
    "kind int, node binary, parent binary, conv_id long, parent_conv_id long, depth long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, prior binary, key binary, part int, b_children long, "
    "b_leaves long, b_saved long, ends string")


def trees(rows: DataFrame, level: int, size: int, part_bytes: int) -> DataFrame:
    """Rows of ``_PART`` for the segments of one level: ``conv_id, prior, key, last, b_children, b_leaves, b_saved``."""
    total = rows.agg(F.sum(F.length("key") + F.lit(2 * WIDTH))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    ordered = rows.repartitionByRange(parts, "prior", "key", "conv_id").sortWithinPartitions("prior", "key", "conv_id")

    def nodes(prior: bytes, tree: Art, first, last, part: int) -> Iterator[tuple]:
        waiting: list[tuple[int, Sums]] = []  # final nodes whose parent has not come yet

        def name(key: bytes) -> bytes:  # a deeper tree's root is the node its segments follow
            return node_id(level, prior, key) if key or not level else prior

        def row(kind, s: Sums, parent, parent_conv, sha, ends=None, b=(None, None, None)):
            return (kind, name(s.key), parent, s.least, parent_conv, level * size + len(s.key) // WIDTH,
                    s.n, s.children, s.leaves, s.saved, sha, prior, s.key if kind == OPEN else None, part, *b, ends)

        for s in walk(tree, first, last):
            depth, me = len(s.key) // WIDTH, name(s.key)
            while waiting and waiting[-1][0] == depth + 1:
                _, child = waiting.pop()
                sha = digest_of(joined(child.value.ends)) if child.value and child.value.ends else NO_ENDS
                yield row(FINAL, child, me, None if s.open or level and not depth else s.least, sha)
            if s.open:
                v = s.value or Value()
                yield row(OPEN, s, None, None, None, joined(v.ends) if v.ends else None, v.below)
            elif depth:
                waiting.append((depth, s))
            else:
                yield row(TREE, s, None, None, None)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), []
        tree, prior, first, last, lead = Art(), None, None, None, True
        value = None

        def flush(closing: bool):
            return nodes(prior, tree, first if lead else None, last if closing else None, part)

        for batch in batches:
            for c, p, key, ends, *below in zip(*(batch.column(x).to_pylist() for x in (
                    "conv_id", "prior", "key", "last", "b_children", "b_leaves", "b_saved")), strict=True):
                if p != prior:
                    if prior is not None:
                        for r in flush(False):
                            out.append(r)
                            if len(out) == 10_000:
                                yield _batch(out, _PART)
                                out = []
                        lead = False
                    tree, prior, value, last = Art(), p, None, None
                    first = key if first is None else first
                if key != last:
                    value, last = Value(), key
                    tree.put(key, value)
                value.n += 1
                value.least = c if value.least is None else min(value.least, c)
                if ends:
                    value.ends.append(c)
                if below[0] is not None:
                    value.below = tuple(below)
        if prior is not None:
            for r in flush(True):
                out.append(r)
                if len(out) == 10_000:
                    yield _batch(out, _PART)
                    out = []
        yield _batch(out, _PART)

    return materialise(ordered.mapInArrow(build, _PART))


def close_open(found: DataFrame, level: int) -> DataFrame:
    """Rows of ``_PART`` (final nodes, and a TREE row a tree) of the open prefixes of all parts."""
    got = found.where(F.col("kind") == OPEN)
    merged = got.groupBy("prior", "key").agg(
        F.first("node").alias("node"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        *[F.max(c).alias(c) for c in ("b_children", "b_leaves", "b_saved")])
    names = ["prior", "key", "node", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "b_children",
             "b_leaves", "b_saved"]
    # at most two paths a part
    paths = merged.select(*names).repartition("prior").sortWithinPartitions("prior", "key")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path: list[dict] = []  # open prefixes, each below the one before
        out: list[tuple] = []

        def end():
            x = path.pop()
            leaves = x["n_leaves"] if x["n_children"] else 1
            saved = x["saved_tokens"] + (x["n_convs"] - 1) * words_of(x["key"])
            up = path[-1] if path else None
            if up:
                up["n_children"] += 1
                up["n_leaves"] += leaves
                up["saved_tokens"] += saved
            tree = up is None and level
            out.append((TREE if tree else FINAL, x["node"], up["node"] if up else None, x["conv_id"],
                        up["conv_id"] if up and not (level and len(path) == 1) else None, x["depth"], x["n_convs"],
                        x["n_children"], leaves, saved, NO_ENDS, x["prior"], None, None, None, None, None, None))

        for batch in batches:
            for x in batch.to_pylist():
                for c, b in (("n_children", "b_children"), ("n_leaves", "b_leaves"), ("saved_tokens", "b_saved")):
                    x[c] += x[b] or 0
                while path and (path[-1]["prior"] != x["prior"] or not x["key"].startswith(path[-1]["key"])):
                    end()
                path.append(x)
            yield _batch(out, _PART)
            out = []
        while path:
            end()
        yield _batch(out, _PART)

    return paths.mapInArrow(close, _PART)


def open_ends(found: DataFrame) -> DataFrame:
    """(node, ends) of open prefixes at which conversations end: the digest over all parts in order, streamed."""
    pieces = found.where("ends IS NOT NULL").select("node", "part", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha, out = None, None, []
        for batch in batches:
            for node, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if node != at:
                    if at is not None:
                        out.append((at, sha.hexdigest()))
                    at, sha = node, hashlib.sha256(ends.encode())
                else:
                    sha.update(b"," + ends.encode())
        if at is not None:
            out.append((at, sha.hexdigest()))
        yield _batch(out, "node binary, ends string")

    return pieces.repartition("node").sortWithinPartitions("node", "part").mapInArrow(run, "node binary, ends string")


_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(turns: DataFrame, segment: int = SEGMENT, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per node of the trie of conversations given as turns (conv_id, at, id)."""
    cut = materialise(segments(turns, segment))
    deepest = cut.agg(F.max("level")).first()[0]
    nodes, below = None, None
    for level in range(deepest or 0, -1, -1):
        rows = cut.where(F.col("level") == level).drop("level")
        if below is None:
            none = F.lit(None).cast("long")
            rows = rows.select("*", none.alias("b_children"), none.alias("b_leaves"), none.alias("b_saved"))
        else:  # what hangs below a whole segment: one row per tree of the next level
            after = F.unhex(F.md5(F.concat(F.lit(f"{level}:").cast("binary"), F.length("prior").cast("string").cast("binary"),
                                           F.lit(":").cast("binary"), "prior", "key")))
            rows = rows.withColumn("after", F.when(~F.col("last"), after)).join(
                below.withColumnRenamed("prior", "after"), "after", "left").drop("after")
        found = trees(rows, level, segment, part_bytes)
        done = materialise(close_open(found, level))
        ends = open_ends(found)
        closed = done.where(F.col("kind") == FINAL)
        final = found.where(F.col("kind") == FINAL).select(*_COLUMNS, "node", "parent")
        known = bounded_broadcast(closed.select(F.col("node").alias("parent"), F.col("conv_id").alias("known")),
                                  BROADCAST_NODES)
        final = final.join(known, "parent", "left").withColumn(
            "parent_conv_id", F.coalesce("parent_conv_id", "known")).drop("known")
        closed = closed.select(*_COLUMNS, "node", "parent").join(ends, "node", "left").withColumn(
            "ends_sha256", F.coalesce("ends", "ends_sha256")).drop("ends")
        level_nodes = materialise(final.unionByName(closed))
        nodes = level_nodes if nodes is None else nodes.unionByName(level_nodes)
        below = materialise(found.where(F.col("kind") == TREE).select(
            "prior", F.col("n_children").alias("b_children"), F.col("n_leaves").alias("b_leaves"),
            F.col("saved_tokens").alias("b_saved")).unionByName(done.where(F.col("kind") == TREE).select(
                "prior", F.col("n_children").alias("b_children"), F.col("n_leaves").alias("b_leaves"),
                F.col("saved_tokens").alias("b_saved")))) if level else None
    if deepest:  # the first nodes of deeper segments: their parent was not known yet
        named = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("known"))
        waiting = F.col("parent").isNotNull() & F.col("parent_conv_id").isNull()
        found = nodes.where(waiting).join(named, "parent").withColumn("parent_conv_id", F.col("known")).drop("known")
        nodes = nodes.where(~waiting).unionByName(found)
    return nodes.select(*_COLUMNS)


def conversation_trie(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                      block: int = BLOCK, heads: int = HEADS, segment: int = SEGMENT,
                      part_bytes: int = PART_BYTES) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations.

    Null roles and texts are empty; turns are ordered with null first, equal
    turn numbers by words, then hash; rows without a conversation take no part;
    turns that repeat count each; texts of any length are hashed whole; an empty
    table gives no rows; other columns are not read.
    """
    turns = materialise(turns_with_ids(df, conv_id, turn, role, text))
    return trie(rebuild(turns, block, heads), segment, part_bytes)


def oracle_sql(block: int = BLOCK, heads: int = HEADS) -> str:
    crc, table = crc32_sql("conv_id::VARCHAR")
    return f"""WITH {table},
t AS (SELECT conv_id, turn, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS turn_text FROM conversations
      WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(turn_text ORDER BY turn NULLS FIRST) AS turns FROM t GROUP BY 1),
h AS (SELECT conv_id, turns, {crc} % {heads} AS h FROM own, crc_table),
c AS (SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) AS turns
      FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % {block}),
p AS (SELECT conv_id, unnest(range(len(turns) + 1)) AS depth, turns FROM c),
n AS (SELECT turns[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(turns) = depth), '') AS ends
      FROM p GROUP BY 1, 2),
own_sums AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE
             (n_convs - 1) * len(regexp_extract_all(prefix[depth].t, '[^\x20\x09-\x0D]+')) END AS saved FROM n),
kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT s.*, coalesce(n_children, 0) AS n_children FROM own_sums s LEFT JOIN kids USING (prefix)),
up AS (SELECT prefix[1:d] AS prefix, sum(saved)::BIGINT AS saved_tokens,
              count(*) FILTER (WHERE n_children = 0) AS n_leaves
       FROM (SELECT prefix, saved, n_children, unnest(range(depth + 1)) AS d FROM full_nodes) GROUP BY 1)
SELECT f.conv_id, f.depth, a.conv_id AS parent_conv_id, f.n_convs, f.n_children, up.n_leaves, up.saved_tokens,
       sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN up USING (prefix) LEFT JOIN n a ON a.prefix = f.prefix[1:f.depth - 1] AND f.depth > 0"""

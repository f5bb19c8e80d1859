"""Trie of the conversations' common prefixes, from sorted sequences and their longest common prefixes.

A conversation is a sequence of turns, a turn the 16-byte digest of its role and text, so a conversation is one
binary value whose order is that of its sequence. Values are range-partitioned and sorted together with their
conversation's id, so that even one sequence shared by a third of all rows is spread over many ranges.

Each row keeps how many turns it shares with the row before and the row after it. A task reads a stretch of
sorted rows as blocks of bounded size. In a block, a sparse table holds minima of those numbers over
stretches of 2**k rows; each candidate prefix (a row and a depth beyond what it shares with the row before) finds
its left and its right extent independently, each by a binary descent in the table, all candidates together. The members of a
prefix are the rows between; there is no stack and no walk. Counts of a subtree are differences of sums along the rows.

Prefixes that touch a block's edge may go on in the next block. Of these each block writes partial sums, which
are merged by prefix: a row per block and prefix, and the ids of conversations that end there, in order, in
pieces that are hashed as they stream by. All other prefixes are complete within their block.

Defined cases: turns without a conversation's id belong to none; a null turn number comes first; turns of one
conversation with equal numbers are ordered by role, then by the text's digest, and repeated rows are
turns of their own; null roles and texts are empty; an empty table has no prefix, not even a root; other columns are
ignored. A conversation's digests (20 bytes a turn) are held in one row, its texts are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import segments, shuffle_partitions
from footfall.session import materialise

#: Bytes of a turn's digest.
WIDE = 16
#: Rows and digest bytes of a block; a longer conversation is a block by itself.
BLOCK_ROWS, BLOCK_BYTES = 1 << 16, 16 << 20
#: Ids in one piece of a prefix's list of ends.
PIECE = 1 << 10
#: Parts of the merged edge prefixes' copies, against one parent with most of all children.
SALTS = 16

ROWS = "part int, i long, conv_id long, seq binary, sizes array<int>, lcp int, after int"
NODES = (
    "edge boolean, node binary, parent binary, part int, i long, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends string"
)


# --- sequences ------------------------------------------------------------------------------


def turns(conversations: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """``conv_id, base, turns`` per conversation: its turns' digests and code points, in order."""
    conv = conv.cast("long")
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where(conv.isNotNull()).select(
        conv.alias("conv_id"),
        (conv - conv % 100).alias("base"),
        F.struct(
            turn.cast("long").alias("turn"), role.alias("role"), F.md5(text.cast("binary")).alias("order"),
            digest.alias("digest"), F.length(text).alias("size"),
        ).alias("turn"),
    )
    # one shuffle: by base, which serves the grouping and the join of base and followers
    dealt = rows.repartition(shuffle_partitions(conversations.sparkSession), "base")
    own = dealt.groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("all"))
    return own.select(
        "base", "conv_id", F.transform("all", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns")
    )


def rebuilt(own: DataFrame, head: int = 6) -> DataFrame:
    """``conv_id, seq, sizes``: each conversation with its first turns, fewer than ``head``, from its base."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).cast("int")
    bases = own.where("conv_id = base").select("base", F.slice("turns", 1, head - 1).alias("lead"))
    joined = own.join(bases, "base", "left").withColumn("h", h)
    lead = F.slice(F.coalesce("lead", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    whole = joined.select("conv_id", F.concat(lead, rest).alias("turns"))
    return whole.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("seq"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )


# --- sorted rows ----------------------------------------------------------------------------


def shared_turns(a: bytes, b: bytes) -> int:
    """Equal turns that two sequences begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDE
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int((x != y).argmax()) // WIDE


def sorted_rows(sequences: DataFrame) -> DataFrame:
    """``ROWS``: the range's number and place in it, and turns shared with the rows beside; -1 at a range's ends."""

    def run(batches):
        part = TaskContext.get().partitionId()
        names = [c.split()[0] for c in ROWS.split(", ")]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int32(), pa.int32()]
        held, i = None, 0
        for batch in batches:
            ids, seqs, sizes = (batch.column(c).to_pylist() for c in range(3))
            out = []
            for conv, seq, own in zip(ids, seqs, sizes):
                lcp = -1
                if held is not None:
                    lcp = held[6] = shared_turns(held[3], seq)
                    out.append(held)
                held = [part, i, conv, seq, own, lcp, -1]
                i += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(held, types)], names=names)

    ranges = sequences.repartitionByRange(shuffle_partitions(sequences.sparkSession), "seq", "conv_id")
    return ranges.sortWithinPartitions("seq", "conv_id").select("conv_id", "seq", "sizes").mapInArrow(run, ROWS)


def between_ranges(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Per range that has rows, the turns its first row shares with the range before and its last with the one after.

    The driver holds the first and last sequence of each range, not of each row.
    """
    ends = rows.where("lcp < 0 or after < 0").select("part", "i", "seq").collect()
    found: dict[int, list] = {}
    for r in sorted(ends, key=lambda r: (r.part, r.i)):
        found.setdefault(r.part, []).append(bytes(r.seq))
    parts = sorted(found)
    shared = [shared_turns(found[a][-1], found[b][0]) for a, b in zip(parts, parts[1:])]
    return {p: (a, b) for p, a, b in zip(parts, [-1, *shared], [*shared, -1])}


# --- blocks ---------------------------------------------------------------------------------


class Minima:
    """Minima over stretches of 2**k numbers, for k from 0."""

    def __init__(self, numbers: np.ndarray):
        self.tables = [numbers]
        while 2 << len(self.tables) - 1 <= len(numbers):
            last, half = self.tables[-1], 1 << len(self.tables) - 1
            self.tables.append(np.minimum(last[:-half], last[half:]))

    def rightward(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """First place from ``at`` on whose number is under ``least`` (or the end)."""
        at = at.copy()
        for k in range(len(self.tables) - 1, -1, -1):
            table = self.tables[k]
            inside = at < len(table)
            free = inside & (table[np.where(inside, at, 0)] >= least)
            at += free << k
        return at

    def leftward(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Last place up to ``at`` whose number is under ``least`` (or -1)."""
        at = at.copy()
        for k in range(len(self.tables) - 1, -1, -1):
            table = self.tables[k]
            first = at - (1 << k) + 1
            inside = first >= 0
            free = inside & (table[np.where(inside, first, 0)] >= least)
            at -= free << k
        return at


def trie_of(
    part: int, first: int, ids: np.ndarray, seqs: list[bytes], sizes: list[np.ndarray], lcp: np.ndarray, after: np.ndarray
) -> list[tuple]:
    """Rows of ``NODES`` of one block; ``lcp`` and ``after`` hold shared turns across the block's ends too."""
    n = len(ids)
    deep = np.array([len(s) for s in sizes], dtype=np.int64)
    offsets = segments(deep + 1)[:-1]
    sums = np.concatenate([segments(s) for s in sizes])  # code points of the first 0, 1, … turns of each row
    total = sums[offsets + deep]
    local = lcp.copy()
    local[0] = -1  # the first row's prefixes all begin here

    # candidate prefixes: depths beyond what a row shares with the row before
    counts = deep - local
    row = np.repeat(np.arange(n), counts)
    depth = np.arange(len(row)) - np.repeat(segments(counts)[:-1], counts) + local[row] + 1
    minima = Minima(local)
    left = minima.leftward(row, depth)
    right = minima.rightward(row + 1, depth)

    onto = segments(total)
    fresh = segments(total - sums[offsets + np.maximum(local, 0)])
    leaf = segments(after < deep)
    size = right - left
    above = sums[offsets[left] + np.maximum(depth - 1, 0)]
    # the first member counts from the prefix's own turn on, or from what the block before has counted
    seen = np.where(left == 0, np.minimum(np.maximum(lcp[0], depth - 1), deep[0]), depth - 1)
    distinct = fresh[right] - fresh[left + 1] + total[left] - sums[offsets[left] + np.maximum(seen, 0)]
    saved = onto[right] - onto[left] - size * above - distinct

    begin = segments(counts)[:-1]  # candidates of a row stand together, by depth
    # the parent of a row's shallowest candidate begins at the row where its depth was new
    parent = np.arange(len(row)) - 1
    head = np.flatnonzero((depth == local[row] + 1) & (row > 0))
    holder = np.maximum(minima.leftward(row[head], depth[head] - 1), 0)
    parent[head] = begin[holder] + depth[head] - 1 - (local[holder] + 1)
    parent[0] = -1
    new = (left > 0) | (depth > lcp[0])
    children = np.bincount(parent[(parent >= 0) & new], minlength=len(row))

    conv_ids = _smallest(ids, left, right).tolist()
    ends_to = _last_equal(deep, left, right, depth)
    edge = ((left == 0) | (right == n)).tolist()

    out = []
    columns = zip(
        left.tolist(), right.tolist(), depth.tolist(), parent.tolist(), edge, conv_ids, size.tolist(),
        children.tolist(), (leaf[right] - leaf[left]).tolist(), saved.tolist(), ends_to.tolist(),
    )
    texts = [str(i) for i in ids.tolist()]
    for low, high, d, up, at_edge, conv, members, kids, leaves, tokens, end in columns:
        upper = None if up < 0 or edge[up] else conv_ids[up]
        name = _name(seqs[low], d) if at_edge else None
        # a complete prefix is merged with none, but its parent may lie at an edge
        above_name = None if up < 0 or not edge[up] else _name(seqs[low], d - 1)
        own = ",".join(texts[low:end])
        digest = None if at_edge else hashlib.sha256(own.encode()).hexdigest()
        out.append((at_edge, name, above_name, part, first + low, conv, d, upper, members, kids, leaves, tokens, digest, None))
        if at_edge:
            for piece in range(low, end, PIECE):
                ids_text = ",".join(texts[piece : min(end, piece + PIECE)])
                out.append((True, name, None, part, first + piece, None, d, None, 0, 0, 0, 0, None, ids_text))
    return out


def _name(seq: bytes, depth: int) -> bytes:
    """What a prefix at a block's edge is known by."""
    return hashlib.sha256(seq[: depth * WIDE]).digest()[:WIDE] + depth.to_bytes(4, "big")


def _smallest(ids: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least id of each stretch, from minima over powers of two."""
    tables = Minima(ids).tables
    k = np.frexp((right - left).astype(np.float64))[1] - 1
    out = np.zeros(len(left), dtype=np.int64)
    for level in np.unique(k).tolist():
        own = k == level
        table = tables[level]
        out[own] = np.minimum(table[left[own]], table[right[own] - (1 << level)])
    return out


def _last_equal(deep: np.ndarray, left: np.ndarray, right: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Where the members that have no turn beyond ``depth`` end; they come first."""
    longer = np.append(np.flatnonzero(deep[1:] != deep[:-1]) + 1, len(deep))
    stop = longer[np.searchsorted(longer, left, side="right")]
    return np.where(deep[left] == depth, np.minimum(stop, right), left)


def blocks(batches: Iterator[pa.RecordBatch], ranges: dict[int, tuple[int, int]]) -> Iterator[list[tuple]]:
    """Nodes of each block: rows of one range that follow one another."""
    held: list[tuple] = []
    weight = 0

    def close():
        part, first = held[0][0], held[0][1]
        _, _, ids, seqs, sizes, lcp, after = zip(*held)
        lcp, after = np.array(lcp, np.int64), np.array(after, np.int64)
        if lcp[0] < 0:
            lcp[0] = ranges[part][0]
        if after[-1] < 0:
            after[-1] = ranges[part][1]
        return trie_of(
            part, first, np.array(ids, np.int64), list(seqs), [np.array(s, np.int64) for s in sizes], lcp, after
        )

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in range(7))):
            follows = held and held[-1][0] == row[0] and held[-1][1] + 1 == row[1]
            if held and (not follows or len(held) >= BLOCK_ROWS or weight >= BLOCK_BYTES):
                yield close()
                held, weight = [], 0
            held.append(row)
            weight += len(row[3])
    if held:
        yield close()


def local_tries(rows: DataFrame, ranges: dict[int, tuple[int, int]]) -> DataFrame:
    """``NODES`` of all blocks: complete prefixes, and partial ones at edges."""
    names = [c.split()[0] for c in NODES.split(", ")]
    types = [
        pa.bool_(), pa.binary(), pa.binary(), pa.int32(), *[pa.int64()] * 8, pa.string(), pa.string(),
    ]

    def run(batches):
        for found in blocks(batches, ranges):
            for low in range(0, len(found), 1 << 13):
                columns = zip(*found[low : low + (1 << 13)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return rows.mapInArrow(run, NODES)


# --- merging --------------------------------------------------------------------------------

MERGED = (
    "node binary, parent binary, conv_id long, depth long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def merge_edges(partial: DataFrame) -> DataFrame:
    """One row per prefix at an edge; its partial rows stream by in order of their places."""

    def run(batches):
        names = [c.split()[0] for c in MERGED.split(", ")]
        types = [pa.binary(), pa.binary(), *[pa.int64()] * 6, pa.string()]
        held, ends, any_end = None, None, False

        def closed():
            return [*held, ends.hexdigest()]

        for batch in batches:
            out = []
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (
                "node", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"
            ))
            for node, parent, conv, depth, *sums, piece in zip(*columns):
                if held is None or held[0] != node:
                    if held is not None:
                        out.append(closed())
                    held, ends, any_end = [node, parent, conv, depth, 0, 0, 0, 0], hashlib.sha256(), False
                held[1] = parent if held[1] is None else held[1]
                held[2] = conv if held[2] is None else held[2] if conv is None else min(conv, held[2])
                for c, number in enumerate(sums):
                    held[4 + c] += number
                if piece is not None:
                    ends.update((("," if any_end else "") + piece).encode())
                    any_end = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(closed(), types)], names=names)

    dealt = partial.repartition(shuffle_partitions(partial.sparkSession), "node")
    return dealt.sortWithinPartitions("node", "part", "i").mapInArrow(run, MERGED)


def prefix_trie(conversations: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """One row per different prefix of the rebuilt conversations; see the module's text."""
    rows = materialise(sorted_rows(rebuilt(turns(conversations, conv, turn, role, text))), "sorted-turns")
    found = materialise(local_tries(rows, between_ranges(rows)), "prefixes")
    edges = materialise(merge_edges(found.where("edge")), "edge-prefixes")

    values = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    named = edges.select(F.col("node").alias("parent"), F.col("conv_id").alias("upper"))
    salted = named.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    inner = found.where("not edge")
    settled = inner.where("parent is null").select(*values, "parent_conv_id")
    below = inner.where("parent is not null").withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"))
    below = below.join(salted, ["parent", "salt"]).select(*values, F.col("upper").alias("parent_conv_id"))
    outer = edges.join(named, "parent", "left").select(*values, F.col("upper").alias("parent_conv_id"))
    whole = settled.unionByName(below).unionByName(outer)
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


ORACLE = """
WITH own AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(4294967295::BIGINT, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
           lambda crc, b: list_reduce(
             list_prepend(xor(crc, b), list_transform(range(8), lambda i: 0::BIGINT)),
             lambda x, z: xor(x >> 1, (x & 1) * 3988292384::BIGINT)))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
), part AS (
  SELECT c.conv_id, o.k, o.role, o.text, 0 AS late FROM conv c JOIN own o ON o.conv_id = c.base AND o.k <= c.h
  UNION ALL
  SELECT c.conv_id, o.k, o.role, o.text, 1 FROM conv c JOIN own o ON o.conv_id = c.conv_id AND o.k > c.h
), sequence AS (
  SELECT c.conv_id, coalesce(list({'role': p.role, 'text': p.text} ORDER BY late, k) FILTER (p.k IS NOT NULL), []) AS s
  FROM conv c LEFT JOIN part p ON p.conv_id = c.conv_id GROUP BY c.conv_id
), member AS (
  SELECT conv_id, len(s) AS n, unnest(range(len(s) + 1)) AS depth, s FROM sequence
), node AS (
  SELECT s[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM member GROUP BY prefix, depth
), linked AS (
  SELECT c.*, p.conv_id AS parent_conv_id
  FROM node c LEFT JOIN node p ON p.depth = c.depth - 1 AND p.prefix = c.prefix[1:c.depth - 1]
), kids AS (
  SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL
), below AS (
  SELECT n.depth, n.n_convs, n.prefix, coalesce(n_children, 0) AS n_children, unnest(range(n.depth + 1)) AS up
  FROM node n LEFT JOIN kids k ON k.prefix = n.prefix AND k.depth = n.depth
), subtree AS (
  SELECT prefix[1:up] AS prefix, up AS depth, count(*) FILTER (n_children = 0) AS n_leaves,
         sum(CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(prefix[depth].text) END) AS saved_tokens
  FROM below GROUP BY 1, 2
)
SELECT l.conv_id, l.depth::BIGINT AS depth, l.parent_conv_id, l.n_convs::BIGINT AS n_convs,
       coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, l.ends_sha256
FROM linked l JOIN subtree s ON s.depth = l.depth AND s.prefix = l.prefix
LEFT JOIN kids k ON k.depth = l.depth AND k.prefix = l.prefix
"""

"""Prefix trie of conversations (operator 11).

Every distinct sequence of first d turns is a node.  Turns are reduced to two
64-bit hashes of (role, text) and a word count; a prefix is named by sums of
hashes of (place, turn), which are prefix sums and so need no task to hold a
conversation.  A count-min sketch of all prefix names screens them: where its
estimate is one, the prefix and all that follow it belong to one conversation,
and these nodes (the tail) are written where they stand.  Only prefixes that
may be shared are shuffled, with partial aggregates, for exact grouping.

A node belongs to its smallest member.  A conversation owns its path from some
depth on, so sums over subtrees need no recursion: every member adds, to each
possibly shared node of its path, the words that lie below on its path before
it owns it, and one leaf if it owns a node without children.

Edge cases: rows without a conv_id are left out; a null role or text is empty;
turns of equal number are taken in the order of their hashes, repeated rows are
turns of their own; an empty table gives no nodes.  Extra columns are not read.
Texts of any length are hashed by the JVM and never leave their task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..operators.prefix import prefix_sums
from .common import drop, partitions, save

WORD = r"[^\x20\x09-\x0D]+"
#: Cells of each of the two rows of the sketch: 8 for a prefix, at most this many.
MAX_CELLS = 1 << 28
#: Cells in one block of the sketch (offsets fit 16 bits).
BLOCK_BITS = 15
FLUSH_ROWS = 1 << 20
IDS_A_PART = 4096
NODE = ["p1", "p2"]


# ---------------------------------------------------------------- turns

def number_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, i, d1, d2, w): the turns of each conversation from 0 in their
    order (null first), with two hashes of (role, text) and the words of text.

    Places are prefix sums by segments of 64 turn numbers (null turns by their
    hash), so a very long conversation is split over tasks.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    d = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(11), role, text).alias("d1"), F.xxhash64(F.lit(29), text, role).alias("d2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("w"), F.lit(1).cast("long").alias("one"))
    d = save(d, "turns")
    segment = F.when(F.col("turn").isNull(), F.shiftright("d1", 54) - F.lit(1 << 60)).otherwise(F.shiftright("turn", 6))
    return prefix_sums(d, ["conv_id"], ["turn", "d1", "d2"], ["one"], segment) \
        .select("conv_id", F.col("one_before").alias("i"), "d1", "d2", "w")


def share_heads(numbered: DataFrame, donor: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Rebuild conversations: the first ``heads`` (at most ``most``) turns of
    conversation ``donor``, both functions of conv_id, then the own turns after
    the first ``heads``.  Returns the turns and the conversations (conv_id)."""
    sizes = save(numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conversations")
    convs = sizes.select("conv_id", donor.alias("donor"), heads.cast("long").alias("h"))
    first = numbered.where(F.col("i") < most).select(F.col("conv_id").alias("donor"), "i", "d1", "d2", "w")
    given = convs.where("h > 0").join(first, "donor").where("i < h").select("conv_id", "i", "d1", "d2", "w")
    # conversations whose donor has fewer turns than wanted, or is not there
    short = convs.join(sizes.select(F.col("conv_id").alias("donor"), "n"), "donor", "left") \
        .where(F.coalesce("n", F.lit(0)) < F.col("h")).select("conv_id", (F.col("h") - F.coalesce("n", F.lit(0))).alias("miss"))
    own = numbered.where(F.col("i") >= heads).join(short, "conv_id", "left") \
        .select("conv_id", (F.col("i") - F.coalesce("miss", F.lit(0))).alias("i"), "d1", "d2", "w")
    return given.unionByName(own), sizes.select("conv_id")


# ---------------------------------------------------------------- prefixes

def _name(depth: Column, sums: list[Column]) -> list[Column]:
    return [F.xxhash64(F.lit(k), depth, *sums) for k in (3, 5)]


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, q1, q2, w, path_words) for every prefix of one
    turn or more: its name p, its parent's name q, the words of its last turn
    and of all its turns."""
    z = [F.xxhash64(F.lit(k), F.col("i"), F.col("d1"), F.col("d2")) for k in (7, 13)]
    low = F.lit(0xFFFFFFFF)
    parts = [F.shiftrightunsigned(z[0], 32), z[0].bitwiseAND(low), F.shiftrightunsigned(z[1], 32), z[1].bitwiseAND(low)]
    t = save(turns.select("conv_id", "i", "w", *(p.alias(f"z{k}") for k, p in enumerate(parts))), "rebuilt")
    s = prefix_sums(t, ["conv_id"], ["i"], ["w", "z0", "z1", "z2", "z3"], F.shiftright("i", 6))
    before = [F.col(f"z{k}_before") for k in range(4)]
    upto = [F.col(f"z{k}") + F.col(f"z{k}_before") for k in range(4)]
    depth = F.col("i") + 1
    p, q = _name(depth, upto), _name(F.col("i"), before)
    return s.select("conv_id", depth.alias("depth"), p[0].alias("p1"), p[1].alias("p2"), q[0].alias("q1"), q[1].alias("q2"),
                    "w", (F.col("w") + F.col("w_before")).alias("path_words"))


# ---------------------------------------------------------------- count-min screening

def _cells(a: np.ndarray, bits: int) -> np.ndarray:
    return (a.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def repeated_cells(names: DataFrame, bits: int) -> np.ndarray:
    """Bit maps, for the two rows of a count-min sketch of 2^bits cells each,
    of the cells whose count is two or more.

    Tasks count what they read and send, for each block of cells, the offsets
    seen once and those seen more often; blocks are merged in sorted order,
    one at a time.  2 x 2^bits bits reach the driver.
    """
    block = min(bits, BLOCK_BITS)
    size = 1 << block

    def count(batches):
        seen: list[list[np.ndarray]] = [[], []]
        held = 0

        def flush():
            out = []
            for r in (0, 1):
                cell, n = np.unique(np.concatenate(seen[r]), return_counts=True)
                which = cell >> block
                at = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1])))
                for lo, hi in zip(at, [*at[1:], len(cell)]):
                    off = (cell[lo:hi] & (size - 1)).astype("<u2")
                    out.append((int(which[lo]) * 2 + r, off[n[lo:hi] == 1].tobytes(), off[n[lo:hi] > 1].tobytes()))
                seen[r].clear()
            for lo in range(0, len(out), 1024):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out[lo:lo + 1024]), (pa.int64(), pa.binary(), pa.binary()))],
                                                 names=["block", "once", "more"])

        for b in batches:
            if b.num_rows:
                for r in (0, 1):
                    seen[r].append(_cells(b.column(r).to_numpy(zero_copy_only=False), bits))
                held += b.num_rows
            if held >= FLUSH_ROWS:
                yield from flush()
                held = 0
        if held:
            yield from flush()

    def merge(batches):
        now, once, more = None, None, None

        def done():
            if now is not None and more.any():
                yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([np.packbits(more).tobytes()], pa.binary())], names=["block", "bits"])

        for b in batches:
            for k, x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if k != now:
                    yield from done()
                    now, once, more = k, np.zeros(size, bool), np.zeros(size, bool)
                x = np.frombuffer(x, "<u2")
                more[x[once[x]]] = True
                once[x] = True
                more[np.frombuffer(y, "<u2")] = True
        yield from done()

    counted = names.select(*NODE).mapInArrow(count, "block long, once binary, more binary")
    merged = counted.repartition(partitions(names.sparkSession), "block").sortWithinPartitions("block") \
        .mapInArrow(merge, "block long, bits binary")
    out = np.zeros((2, max(1, (1 << bits) // 8)), np.uint8)
    got = merged.toArrow()
    for k, x in zip(got.column("block").to_pylist(), got.column("bits").to_pylist()):
        x = np.frombuffer(x, np.uint8)
        out[k & 1, (k >> 1) * len(x):(k >> 1) * len(x) + len(x)] = x
    return out


def screen(names: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """Add ``shared``: false where the sketch proves that no other row has the
    same (p1, p2).  The sketch has 8 cells a row of ``names`` up to
    ``max_cells``; beyond, more rows count as possibly shared, and the result
    of the grouping stays the same."""
    n = names.count()
    bits = min(max(6, (8 * n - 1).bit_length()), max(6, max_cells.bit_length() - 1)) if n else 6
    sent = names.sparkSession.sparkContext.broadcast(repeated_cells(names, bits))       # at most 2 x max_cells / 8 bytes

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            shared = np.ones(b.num_rows, bool)
            for r, c in enumerate(NODE):
                cell = _cells(b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False), bits)
                shared &= (sent.value[r][cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared)], names=[*b.schema.names, "shared"])

    return names.mapInArrow(run, StructType([*names.schema.fields, StructField("shared", BooleanType())]))


# ---------------------------------------------------------------- ends

def id_digests(ends: DataFrame) -> DataFrame:
    """(p1, p2, sha): SHA-256 of the decimal conv_ids of each group, ascending
    and joined by commas.

    Ranges of (group, id) write pieces of text of at most IDS_A_PART ids; then
    each group's pieces go through one hash in order, held one at a time.
    """
    n = partitions(ends.sparkSession)

    def parts(batches):
        key, ids = None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])],
                                              names=["p1", "p2", "at", "ids"])
        for b in batches:
            for p1, p2, c in zip(*(b.column(i).to_pylist() for i in range(3))):
                if key is not None and (key != (p1, p2) or len(ids) >= IDS_A_PART):
                    yield out()
                    ids = []
                key = (p1, p2)
                ids.append(c)
        if key is not None:
            yield out()

    def digest(batches):
        key, h = None, None
        rows: list[tuple] = []
        for b in batches:
            for p1, p2, ids in zip(*(b.column(i).to_pylist() for i in (0, 1, 3))):
                if key != (p1, p2):
                    if key is not None:
                        rows.append((*key, h.hexdigest()))
                    key, h = (p1, p2), hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["p1", "p2", "sha"])
                rows = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, h.hexdigest())], names=["p1", "p2", "sha"])

    sorted_ids = ends.select(*NODE, "conv_id").repartitionByRange(n, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    return sorted_ids.mapInArrow(parts, "p1 long, p2 long, at long, ids string") \
        .repartition(n, *NODE).sortWithinPartitions(*NODE, "at").mapInArrow(digest, "p1 long, p2 long, sha string")


# ---------------------------------------------------------------- trie

def prefix_trie(turns: DataFrame, members: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """The nodes of the prefix trie of conversations.

    ``turns`` as from ``number_turns``, ``members`` (conv_id) all conversations,
    those without turns included.  One row per node: conv_id (its smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (words that need not be stored again: over its subtree, each node's members
    but one times the words of its last turn) and ends_sha256 (of the members
    that end there).
    """
    flat = save(prefixes(turns), "prefixes")
    seen = save(screen(flat, max_cells), "screened")
    drop(flat)
    zero = F.lit(0).cast("long")
    root = _name(zero, [zero] * 4)
    # a conversation's length, words and end, and the first depth that is proven to be its own
    last = seen.groupBy("conv_id").agg(F.max(F.struct("depth", "path_words", "p1", "p2")).alias("last"),
                                       F.min(F.when(~F.col("shared"), F.col("depth"))).alias("own"))
    convs = members.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("last.depth", zero).alias("len"), F.coalesce("last.path_words", zero).alias("all_words"),
        F.coalesce("last.p1", root[0]).alias("e1"), F.coalesce("last.p2", root[1]).alias("e2"), "own")
    convs = save(convs.withColumn("own", F.coalesce("own", F.col("len") + 1)), "convs")
    rows = save(seen.drop("shared").join(convs.select("conv_id", "len", "own", "all_words"), "conv_id"), "paths")
    drop(seen)
    top = rows.where("depth = own")
    shared = rows.where("depth < own").select("conv_id", "depth", *NODE, "q1", "q2", "w", "path_words", "all_words").unionByName(
        convs.select("conv_id", zero.alias("depth"), root[0].alias("p1"), root[1].alias("p2"), zero.alias("q1"), zero.alias("q2"),
                     zero.alias("w"), zero.alias("path_words"), "all_words"))
    nodes = save(shared.groupBy(*NODE, "depth", "q1", "q2", "w", "path_words").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")), "nodes")
    children = nodes.where("depth > 0").select("q1", "q2").unionByName(top.select("q1", "q2")) \
        .groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = save(nodes.join(children, NODE, "left").fillna(0, ["n_children"]), "nodes")
    # what a conversation owns: the words before, and whether it ends in a leaf
    owned = nodes.select("conv_id", (F.col("path_words") - F.col("w")).alias("before"), (F.col("n_children") == 0).cast("int").alias("leaf")) \
        .unionByName(top.select("conv_id", (F.col("path_words") - F.col("w")).alias("before"), F.lit(1).alias("leaf"))) \
        .groupBy("conv_id").agg(F.min("before").alias("before"), F.max("leaf").alias("leaf"))
    gains = shared.join(owned, "conv_id", "left").groupBy(*NODE).agg(
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        F.sum(F.greatest(zero, F.coalesce("before", "all_words") - F.col("path_words") + F.col("w"))).alias("saved_tokens"))
    ends = id_digests(convs.where("len < own").select(F.col("e1").alias("p1"), F.col("e2").alias("p2"), "conv_id"))
    none = F.sha2(F.lit(""), 256)
    of_id = F.sha2(F.col("conv_id").cast("string"), 256)
    exact = nodes.join(gains, NODE, "left").join(ends, NODE, "left").select(
        "conv_id", "depth", "q1", "q2", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", none).alias("ends_sha256"))
    tail = rows.where("depth >= own").select(
        "conv_id", "depth", "q1", "q2", "own", F.lit(1).cast("long").alias("n_convs"), (F.col("depth") < F.col("len")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"), F.when(F.col("depth") == F.col("len"), of_id).otherwise(none).alias("ends_sha256"))
    # parents: the root is one literal, so that its many children are no hot key
    smallest = convs.agg(F.min("conv_id")).first()[0]
    known = F.when(F.col("depth") == 1, F.lit(smallest).cast("long"))
    above = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    at_edge = exact.unionByName(tail.where("depth = own").drop("own"))
    high = at_edge.where("depth < 2").withColumn("parent_conv_id", known).select(cols)
    deep = at_edge.where("depth >= 2").join(above, ["q1", "q2"], "left").select(cols)
    rest = tail.where("depth > own").withColumn("parent_conv_id", F.col("conv_id")).select(cols)
    out = high.unionByName(deep).unionByName(rest)
    return out.select(*(c if c == "ends_sha256" else F.col(c).cast("long").alias(c) for c in cols))

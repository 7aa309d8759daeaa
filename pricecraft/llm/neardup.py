"""Embedding near-duplicates by cross-polytope hashing (operator 4).

A vector is rotated by three rounds of random signs and a fast Hadamard
transform; its hash is the signed axis it comes nearest to.  ``concat``
rotations make a bucket, ``TABLES`` independent buckets a vector's place in
the index, and in every table the vector is also put into the ``PROBES``
next likely buckets (those where the axis chosen with the least margin is the
second best).  Two vectors are candidates where the first bucket of one is
among the buckets of the other; their cosine is then computed in doubles.

Equal vectors are one point that counts for all of them.  A bucket with many
points is compared in pairs of blocks, each in its own task.  A pair is
counted in the first of the buckets in which it meets, so neither pairs nor
candidates are shuffled: tasks give link counts and the components of their
block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, mix64, partitions, save

TABLES = 10
PROBES = 3
BLOCK = 1024
SEED = 4
MIN_COSINE = 0.98


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (length a power of two)."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x


def cross_polytope(x: np.ndarray, tables: int, concat: int, probes: int, seed: int = SEED) -> np.ndarray:
    """(n, tables, 1 + probes) bucket codes; the first is the vector's own."""
    n, d = x.shape
    width = 1 << max(1, (d - 1).bit_length())
    full = np.zeros((n, width))
    full[:, :d] = x / np.linalg.norm(x, axis=1, keepdims=True)
    rng = np.random.default_rng((seed, width))
    out = np.empty((n, tables, 1 + probes), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        best, other, margin = [], [], []
        for _ in range(concat):
            y = full
            for _ in range(3):
                y = hadamard(y * rng.choice((-1.0, 1.0), width)) / np.sqrt(width)
            a = np.abs(y)
            two = np.argpartition(-a, 2 if width > 2 else 1, axis=1)[:, :3]
            two = np.take_along_axis(two, np.argsort(-np.take_along_axis(a, two, 1), axis=1, kind="stable"), 1)
            sign = np.take_along_axis(y, two, 1) < 0
            code = two * 2 + sign
            best.append(code[:, 0])
            for j in range(1, code.shape[1]):
                other.append((len(best) - 1, code[:, j]))
                margin.append(a[rows, two[:, 0]] - a[rows, two[:, j]])
        base = sum(c * (2 * width) ** j for j, c in enumerate(best))
        order = np.argsort(np.stack(margin, 1), axis=1, kind="stable")
        alt = np.stack([base + (c - best[j]) * (2 * width) ** j for j, c in other], 1)
        out[:, t, 0] = base
        for p in range(probes):
            out[:, t, 1 + p] = alt[rows, order[:, min(p, alt.shape[1] - 1)]]
    return out


def _bucket_keys(codes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """64-bit keys of (group, table, code)."""
    t = np.arange(codes.shape[1], dtype=np.uint64)[None, :, None]
    return mix64(mix64(codes.astype(np.uint64) * np.uint64(64) + t) ^ group.astype(np.uint64)[:, None, None]).view(np.int64)


def _collision(ka: np.ndarray, kb: np.ndarray) -> np.ndarray:
    """The first bucket in which each pair (rows of both) is a candidate."""
    one, two = kb == ka[:, :, :1], ka == kb[:, :, :1]
    m1, m2 = one.any(2), two.any(2)
    t = (m1 | m2).argmax(1)
    r = np.arange(len(t))
    pa_, pb = ka[r, t, 0], kb[r, t, 0]
    return np.where(m1[r, t] & m2[r, t], np.minimum(pa_, pb), np.where(m1[r, t], pa_, pb))


def compare_block(key: int, one: dict, two: dict | None, least: float):
    """Links between the points of a block, or of two blocks, of a bucket:
    (ids, links to count here, root in the block) of the points with a link."""
    x = one if two is None else {c: np.concatenate([one[c], two[c]]) for c in one}
    n1 = len(one["id"]) if two is not None else 0
    v = x["v"]
    norm = np.sqrt(np.einsum("ij,ij->i", v, v))
    cos = (v @ v.T) / (norm[:, None] * norm)
    hit = (cos >= least) & (x["group"][:, None] == x["group"])
    np.fill_diagonal(hit, False)
    if n1:
        hit[:n1, :n1] = False
        hit[n1:, n1:] = False
    i, j = np.nonzero(np.triu(hit, 1))
    if not len(i):
        return None
    count = np.zeros(len(v), np.int64)
    for a in range(0, len(i), 65_536):
        p, q = i[a:a + 65_536], j[a:a + 65_536]
        here = _collision(x["keys"][p], x["keys"][q]) == key
        np.add.at(count, p[here], x["m"][q[here]])
        np.add.at(count, q[here], x["m"][p[here]])
    label = x["id"].copy()
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        if (low == label).all():
            break
        label = low
    return x["id"], count, label


def near_duplicates(vectors: DataFrame, least: float = MIN_COSINE, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links long, component_id long, kept boolean of every row of
    ``vectors`` (vec_id, embedding, label).

    Vectors that are null, empty or zero, or hold null or non-finite numbers,
    those without a label or an id, link with nothing; so do vectors of different
    lengths.  Rows with equal vec_id are separate vectors that share their
    component and counts.  Other columns are left behind.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"),
                       F.xxhash64(F.col("label").cast("string"), F.size("embedding")).alias("grp"), F.col("label").isNotNull().alias("labelled"))
    fit = F.coalesce(F.col("labelled") & F.col("vec_id").isNotNull() & (F.size("v") > 0)
                     & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
                     & F.exists("v", lambda e: e != 0), F.lit(False))
    rows = save(v.select("vec_id", "v", "grp", fit.alias("fit")), "vectors")
    points = save(rows.where("fit").groupBy("grp", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("m")), "vector-points")
    n = points.count()
    concat = max(1, int(np.ceil(np.log(max(n, 1) / 64) / np.log(128)))) if n > 64 else 1

    def index(batches):
        for b in batches:
            if not b.num_rows:
                continue
            group, ids, m = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            offsets, flat = b.column(1).offsets.to_numpy(), b.column(1).values.to_numpy(zero_copy_only=False)
            for d in np.unique(np.diff(offsets)).tolist():                   # vectors of one length at a time
                at = np.flatnonzero(np.diff(offsets) == d)
                x = flat[offsets[at][:, None] + np.arange(d)]
                x = x / np.abs(x).max(1, keepdims=True)                      # far from overflow; the angle stays
                keys = _bucket_keys(cross_polytope(x, tables, concat, probes), group[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(group[at]), pa.array(m[at]), pa.array(list(map(bytes, x.astype("<f8"))), pa.binary()),
                     pa.array(list(map(bytes, keys.astype("<i8"))), pa.binary()), pa.array([np.unique(k).tolist() for k in keys], pa.list_(pa.int64()))],
                    names=["id", "grp", "m", "v", "keys", "own"])

    indexed = save(points.mapInArrow(index, "id long, grp long, m long, v binary, keys binary, own array<long>"), "vector-index")
    entries = indexed.select("id", F.explode("own").alias("bucket"))
    crowded = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1") \
        .select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    placed = entries.join(crowded, "bucket").withColumn("block", (F.pmod(F.xxhash64("id"), F.col("blocks"))).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("id", "bucket", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    dealt = placed.join(indexed.drop("own"), "id").repartition(partitions(vectors.sparkSession), "bucket", "lo", "hi") \
        .sortWithinPartitions("bucket", "lo", "hi", "block", "id") \
        .select("bucket", "lo", "hi", "block", "id", "grp", "m", "v", "keys")

    def compare(batches):
        held, at = [], None

        def rows_of(part):
            return {"id": np.array([r[1] for r in part], np.int64), "group": np.array([r[2] for r in part], np.int64),
                    "m": np.array([r[3] for r in part], np.int64), "v": np.stack([np.frombuffer(r[4], "<f8") for r in part]),
                    "keys": np.stack([np.frombuffer(r[5], "<i8").reshape(tables, 1 + probes) for r in part])}

        def links():
            out = []
            for size in {len(r[4]) for r in held}:
                same = [r for r in held if len(r[4]) == size]
                first, second = [r for r in same if r[0] == at[1]], [r for r in same if r[0] != at[1]]
                if at[1] == at[2]:
                    got = compare_block(at[0], rows_of(first), None, least) if len(first) > 1 else None
                else:
                    got = compare_block(at[0], rows_of(first), rows_of(second), least) if first and second else None
                if got is not None:
                    out.append(pa.RecordBatch.from_arrays([pa.array(a) for a in got], names=["id", "n", "root"]))
            return out
        for b in batches:
            for bucket, lo, hi, *r in zip(*(b.column(i).to_pylist() for i in range(9))):
                if at != (bucket, lo, hi):
                    if held:
                        yield from links()
                    held, at = [], (bucket, lo, hi)
                held.append(r)
        if held:
            yield from links()

    found = save(dealt.mapInArrow(compare, "id long, n long, root long"), "vector-links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    roots = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_point = points.join(counts, "id", "left").join(roots, "id", "left") \
        .select("grp", "v", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("root", "id").alias("root"), F.lit(True).alias("fit"))
    return rows.join(per_point, ["grp", "v", "fit"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("root", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))

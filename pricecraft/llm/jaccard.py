"""N-gram Jaccard join in the metric space of shingle sets (operator 1).

Two documents link when the Jaccard similarity of their sets of k-word
shingles is at least ``percent`` (distance d = 1 - J at most e = 0.2).  The
join is exact and never compares all pairs:

1.  Documents with equal sets are one point.
2.  A point can only have a link if ``percent`` of its shingles occur in
    another document too.  That is counted in blocks: a block of documents
    sends a distinct shingle once, however many of its documents have it.
    Half of the shingle universe is enough, with the bound moved accordingly.
3.  First pivots are one-shingle sets {s}, at distance 1 - 1/|x| from the
    documents that hold s and 1 from all others.  Equal distances are ordered
    by rarity, so a document's Voronoi region is its rarest shingle; its
    window are the shingles after it among which the rarest one shared with a
    linked document must be.  The document is copied to those regions.
4.  Inside a region documents are pivots.  First every region compares its
    documents with one pivot, by rows, and the links found join components.
    Regions that still hold several are then put together by their largest
    component, since those of one crowd of near copies hold much the same
    documents, which so travel once; a group is joined in one task if its
    shingles number at most ``SOLVE``, else region by region.  The task takes documents outside the
    largest component as pivots one after another, each against all of other
    components, until every pair of different components has been seen, and
    sends a spanning forest of the links, no pairs.  Larger regions are split:
    with the distances to new pivots every document goes to the region of its
    nearest pivot p and, by the triangle inequality, is copied to that of q
    when d(x,q) <= d(x,p) + 2e (pivots close to each other share a region).
    Documents further than 3e from all pivots stay in a remainder, to which
    those beyond 2e are copied.  Regions are joined recursively.

Points are classes of equal sets, named by a hash of the set, so rows that
share a doc_id cannot be taken for each other.  Shingles are 64-bit hashes; the
texts travel, since hashes do not compress.  Ids that choose texts are sent to
the texts where their number is bounded (``common.few``), so only chosen texts
are shuffled; beyond the bound texts are joined by a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, drop, few, mix64, partitions, save, shingle_sets, text_chunks

WORDS = 5
PERCENT = 80
SLICE_BYTES = 1 << 20
BLOCK_DOCS = 16_384
SOLVE = 4 << 20             # shingles of a group of regions that one task joins (32 MB)
BUCKET = 4 << 20            # shingles of the corpus to a bucket of the count in step 2; half of them are counted


def least_overlap(n: Column, percent: int = PERCENT) -> Column:
    """Shingles that a set of n must share with any linked one."""
    return F.ceil(n * percent / 100.0 - 1e-9).cast("long")


def set_sums(h: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums of every set, which equal sets have in common."""
    sums = []
    for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(h ^ np.uint64(salt)), dtype=np.uint64)])
        sums.append((run[ends[1:]] - run[ends[:-1]]).view(np.int64))
    return sums


def set_sizes(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles long, s1, s2): set size and the sums of the set."""

    def run(batches):
        for b in batches:
            for part in text_chunks(b, SLICE_BYTES):
                h, ends = shingle_sets(part.column(1), k)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends)), *map(pa.array, set_sums(h, ends))],
                                                 names=["doc_id", "n_shingles", "s1", "s2"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long")


def class_id() -> Column:
    return F.xxhash64("n_shingles", "s1", "s2")


def with_class(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(n_shingles long, s1, s2, text): texts with the size and sums of their set."""

    def run(batches):
        for b in batches:
            for part in text_chunks(b, SLICE_BYTES):
                h, ends = shingle_sets(part.column(0), k)
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(ends)), *map(pa.array, set_sums(h, ends)), part.column(0)],
                                                 names=["n_shingles", "s1", "s2", "text"])

    return docs.select("text").mapInArrow(run, "n_shingles long, s1 long, s2 long, text string")


# ---------------------------------------------------------------- step 2

def shared_counts(docs: DataFrame, buckets: int, k: int = WORDS) -> DataFrame:
    """(doc_id, n_half long, shared long): of every document's shingles in the
    lower half of the hash universe, how many are there and how many occur in
    another document too (counted too often only if 40-bit rests of hashes in
    a bucket are equal)."""
    bits = max(1, (buckets - 1).bit_length())
    top = np.uint64(63 - bits)

    def cut(batches):
        for batch in batches:
            for b in (p for s in batch_slices(batch) for p in text_chunks(s, 4 * SLICE_BYTES, BLOCK_DOCS)):
                hs, ds = [], []
                at = 0
                for part in text_chunks(b, SLICE_BYTES):
                    h, ends = shingle_sets(part.column(1), k)
                    d = np.repeat(np.arange(at, at + part.num_rows, dtype=np.int32), np.diff(ends))
                    at += part.num_rows
                    low = h < np.uint64(1 << 63)
                    hs.append(h[low]), ds.append(d[low])
                h, d = np.concatenate(hs), np.concatenate(ds)
                ids = b.column(0).to_numpy(zero_copy_only=False)
                n_half = np.bincount(d, minlength=b.num_rows)
                order = np.argsort(h, kind="stable")
                h, d = h[order], d[order]
                first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
                times = np.diff(np.append(first, len(h)))
                own = np.bincount(d[np.repeat(times > 1, times)], minlength=b.num_rows)
                u, one = h[first], np.where(times > 1, -1, d[first]) if len(h) else np.zeros(0, np.int32)
                rows = [(-1, ids.astype("<i8").tobytes(), n_half.astype("<i8").tobytes(), own.astype("<i8").tobytes())]
                there, at_bucket = np.unique(u >> top, return_index=True)
                for q, a, z in zip(there.tolist(), at_bucket.tolist(), [*at_bucket.tolist()[1:], len(u)]):
                    rest = (u[a:z] >> np.uint64(max(0, int(top) - 40))) & np.uint64((1 << 40) - 1)
                    who = one[a:z]
                    local = np.unique(who[who >= 0])
                    place = np.where(who >= 0, np.searchsorted(local, who), 0xFFFF).astype("<u2")
                    rows.append((q, ids[local].astype("<i8").tobytes(), rest.astype("<u4").tobytes() + (rest >> np.uint64(32)).astype("u1").tobytes(), place.tobytes()))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["bucket", "ids", "a", "b"])

    def count(batches):
        held, bucket = [], None

        def rows():
            if bucket == -1:
                return [pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x, "<i8")) for x in (i, n, s)], names=["doc_id", "n_half", "shared"])
                        for i, n, s in held]
            rest, who, ids, at = [], [], [], 0
            for i, a, b in held:
                p = np.frombuffer(b, "<u2").astype(np.int64)
                m = len(p)
                rest.append(np.frombuffer(a, "<u4", m).astype(np.uint64) | np.frombuffer(a, "u1", m, 4 * m).astype(np.uint64) << np.uint64(32))
                who.append(np.where(p == 0xFFFF, -1, p + at))
                ids.append(np.frombuffer(i, "<i8"))
                at += len(ids[-1])
            rest, who, ids = map(np.concatenate, (rest, who, ids))
            order = np.argsort(rest, kind="stable")
            rest, who = rest[order], who[order]
            same = rest[1:] == rest[:-1]
            shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
            n = np.bincount(who[shared & (who >= 0)], minlength=len(ids))
            hit = np.flatnonzero(n)
            return [pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(np.zeros(len(hit), np.int64)), pa.array(n[hit].astype(np.int64))],
                                               names=["doc_id", "n_half", "shared"])]
        for b in batches:
            for q, *x in zip(*(b.column(j).to_pylist() for j in range(4))):
                if held and (q != bucket or q == -1):
                    yield from rows()
                    held = []
                bucket = q
                held.append(x)
        if held:
            yield from rows()

    return docs.select("doc_id", "text").mapInArrow(cut, "bucket int, ids binary, a binary, b binary") \
        .repartition(min(1 << bits, 4 * partitions(docs.sparkSession)), F.when(F.col("bucket") < 0, F.xxhash64("ids")).otherwise(F.col("bucket"))) \
        .sortWithinPartitions("bucket").mapInArrow(count, "doc_id long, n_half long, shared long") \
        .groupBy("doc_id").agg(F.sum("n_half").alias("n_half"), F.sum("shared").alias("shared"))


def batch_slices(batch: pa.RecordBatch, rows: int = BLOCK_DOCS):
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


# ---------------------------------------------------------------- step 3

def explode_shingles(points: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, shingle long) of every shingle of every point."""

    def run(batches):
        for b in batches:
            for part in text_chunks(b, SLICE_BYTES):
                h, ends = shingle_sets(part.column(1), k)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False), np.diff(ends))),
                                                  pa.array(h.view(np.int64))], names=["doc_id", "shingle"])

    return points.select("doc_id", "text").mapInArrow(run, "doc_id long, shingle long")


def voronoi_windows(points: DataFrame, percent: int = PERCENT, k: int = WORDS) -> DataFrame:
    """(region long, doc_id, n, rank double): every point in the regions of its
    window, regions of one point left out; rank orders pivots, points with
    few shingles of their own first."""
    posts = save(explode_shingles(points, k), "postings")
    common = posts.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = posts.join(common, "shingle").select("doc_id", "shingle", "df")
    per_doc = shared.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("s"))   # one document's shingles
    own = F.col("n") - F.size("s")
    window = F.col("n") - least_overlap(F.col("n"), percent) + 1 - own       # shingles of its own are the rarest
    rows = points.select("doc_id", F.col("n_shingles").alias("n")).join(per_doc, "doc_id").withColumn("w", window).where("w > 0") \
        .select("doc_id", "n", (own / F.col("n")).alias("rank"), F.explode(F.slice("s", F.lit(1), F.col("w").cast("int"))).alias("x")) \
        .select(F.col("x.shingle").alias("region"), "doc_id", "n", "rank")
    return rows


# ---------------------------------------------------------------- step 4

def distances(pairs: DataFrame, points: DataFrame, k: int = WORDS) -> DataFrame:
    """(a, b, common, whole) of pairs (a, b): sizes of intersection and union."""
    pairs = save(pairs, "pairs")
    one = points.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    other = points.select(F.col("doc_id").alias("b"), F.col("text").alias("text"))
    if few(pairs):
        one = one.join(F.broadcast(pairs), "a")
        other = other.join(F.broadcast(pairs.select("b").distinct()), "b", "left_semi")
    else:
        one = pairs.join(one, "a")
    both = one.join(other, "b").select("a", "b", "text_a", "text")

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, SLICE_BYTES):
                ha, ea = shingle_sets(part.column(2), k)
                hb, eb = shingle_sets(part.column(3), k)
                common = np.array([len(np.intersect1d(ha[ea[i]:ea[i + 1]], hb[eb[i]:eb[i + 1]], assume_unique=True)) for i in range(part.num_rows)], np.int64)
                whole = np.diff(ea) + np.diff(eb) - common
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(common), pa.array(whole)], names=["a", "b", "common", "whole"])

    return both.mapInArrow(run, "a long, b long, common long, whole long")


def forest(labels: np.ndarray, h: np.ndarray, ends: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links (places of two sets) that, with equal ``labels``, span the
    components of a region's sets.

    A set outside the largest component is the next pivot: its intersections
    with all others are counted at once, and it is done.  When none is left
    outside, every pair of different components has been compared.
    """
    m = len(labels)
    _, code = np.unique(h, return_inverse=True)
    sizes = np.diff(ends)
    comp = np.unique(labels, return_inverse=True)[1]
    many = np.bincount(comp, minlength=m)
    marked = np.zeros(int(code.max()) + 1 if len(code) else 1, bool)
    done = np.zeros(m, bool)
    out = []
    while True:
        left = np.flatnonzero(~done & (comp != np.argmax(many)))
        if not len(left):
            return out
        x = left[np.argmax(sizes[left])]
        own = code[ends[x]:ends[x + 1]]
        marked[own] = True
        common = np.add.reduceat(marked[code].view(np.int8), ends[:-1], dtype=np.int64)
        marked[own] = False
        done[x] = True
        near = np.flatnonzero((common * 100 >= (sizes + sizes[x] - common) * percent) & (comp != comp[x]))
        for c in np.unique(comp[near]):
            out.append((int(x), int(near[np.argmax(comp[near] == c)])))
        if len(near):
            joined = np.isin(comp, np.unique(comp[near]))
            comp[joined] = comp[x]
            many = np.bincount(comp, minlength=m)


def solve_regions(rows: DataFrame, points: DataFrame, percent: int = PERCENT, k: int = WORDS) -> DataFrame:
    """(a, b) links that span the components of each region (region, doc_id,
    label), one region at a time in a task."""

    def run(batches):
        region, held = None, []

        def solved():
            if len(held) > 1:
                h = np.concatenate([x for _, _, x in held])
                ends = np.concatenate([[0], np.cumsum([len(x) for _, _, x in held])])
                links = forest(np.array([x for _, x, _ in held]), h, ends, percent)
                if links:
                    a, b = (np.array([held[p[i]][0] for p in links]) for i in (0, 1))
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for whole in batches:
            for batch in text_chunks(whole, SLICE_BYTES):
                h, ends = shingle_sets(batch.column(3), k)
                for i, (r, d, x) in enumerate(zip(*(batch.column(j).to_pylist() for j in range(3)))):
                    if r != region:
                        yield from solved()
                        region, held = r, []
                    held.append((d, x, h[ends[i]:ends[i + 1]].copy()))
        yield from solved()

    rows = save(rows, "solve")
    side = F.broadcast(rows) if few(rows) else rows
    return points.select("doc_id", "text").join(side, "doc_id").select("region", "doc_id", "label", "text") \
        .repartition(2 * partitions(rows.sparkSession), "region").sortWithinPartitions("region").mapInArrow(run, "a long, b long")


def together(rows: DataFrame, solve: int) -> DataFrame:
    """(region, doc_id, label): regions of one largest component as one, if
    they are small enough together."""
    one = rows.select("major", "doc_id", "n", "label").distinct()
    fits = one.groupBy("major").agg((F.sum("n") <= solve).alias("fits"))
    joined = one.join(fits.where("fits"), "major").select(F.xxhash64("major", F.lit("major")).alias("region"), "doc_id", "label")
    apart = rows.join(fits.where("NOT fits"), "major").select("region", "doc_id", "label")
    return joined.unionByName(apart)


def link_components(windows: DataFrame, points: DataFrame, percent: int = PERCENT, k: int = WORDS,
                    solve: int = SOLVE) -> tuple[DataFrame | None, DataFrame | None]:
    """((id, root) of all points with a link, links (a, b) that span them), or
    Nones without any: the recursive join of the regions."""
    e = 1 - percent / 100.0
    rows = save(windows.withColumn("label", F.col("doc_id")), "regions")
    edges, labels, known, level = None, None, None, 0
    while True:
        # regions that hold more than one component; equal ones once
        parts = rows.groupBy("region", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("size"),
                                                    F.sum(F.xxhash64("doc_id") % (1 << 40)).alias("k1"),
                                                    F.sum(F.xxhash64("doc_id", F.lit(1)) % (1 << 40)).alias("k2"))
        state = parts.groupBy("region").agg(F.count(F.lit(1)).alias("labels"), F.sum("c").alias("m"), F.sum("size").alias("size"),
                                            F.max(F.struct("c", "label"))["label"].alias("major"), F.sum("k1").alias("k1"), F.sum("k2").alias("k2")).where("labels > 1")
        # the first level has a pivot in every region; what is left of those of bounded size is joined in tasks
        in_task = F.lit(False) if level == 0 else F.col("size") <= solve
        open_ = state.groupBy("m", "k1", "k2").agg(F.min(F.struct("region", "major", in_task.alias("in_task"), (F.col("size") <= solve).alias("small"))).alias("r")).select("r.*")
        active = save(rows.join(open_, "region"), "regions")
        drop(rows)
        rows = active
        if not rows.take(1):
            break
        found = None
        large = rows.where("NOT in_task")
        if large.take(1):
            fan = 1 << min(level, 20)            # more pivots in later rounds: few rounds also in regions of strangers
            order = F.struct("rank", F.col("doc_id").alias("p"))
            pivots = large.groupBy("region", (F.xxhash64("doc_id", F.lit(level)) % fan).alias("part")).agg(F.min(order).alias("o")).select("region", "o.p")
            to_pivot = large.join(pivots, "region").where("doc_id <> p")
            new = to_pivot.select(F.least("doc_id", "p").alias("a"), F.greatest("doc_id", "p").alias("b")).distinct()
            if known is not None:
                new = new.join(known.select("a", "b"), ["a", "b"], "left_anti")
            found = save(distances(new, points, k), "distances")
            known = found if known is None else save(known.unionByName(found), "distances")
        links = solve_regions(together(rows.where("in_task"), solve), points, percent, k) if level else None
        if found is not None:
            direct = found.where(F.col("common") * 100 >= F.col("whole") * percent).select("a", "b")
            links = direct if links is None else links.unionByName(direct)
        edges = save(links if edges is None else edges.unionByName(links), "links")
        labels = save(connected_components(edges), "labels")
        if found is None:
            drop(active)
            return labels, edges
        # regions small enough for a task stay as they are, but for the pivot, which is done
        stay = large.where("small").join(pivots.withColumnRenamed("p", "doc_id"), ["region", "doc_id"], "left_anti").select("region", "doc_id", "n", "rank")
        d = known.select("a", "b", (1 - F.col("common") / F.col("whole")).alias("d"))
        near = to_pivot.where("NOT small").withColumn("a", F.least("doc_id", "p")).withColumn("b", F.greatest("doc_id", "p")).join(d, ["a", "b"]) \
            .select("region", "doc_id", "n", "rank", "p", "d")
        split = _next_regions(near, pivots.join(large.where("NOT small").select("region").distinct(), "region", "left_semi"), e, level)
        rows = save(stay.unionByName(split).join(labels.select(F.col("id").alias("doc_id"), "root"), "doc_id", "left")
                    .select("region", "doc_id", "n", "rank", F.coalesce("root", "doc_id").alias("label")), "regions")
        drop(active)
        level += 1
    drop(rows)
    return labels, edges


def _next_regions(near: DataFrame, pivots: DataFrame, e: float, level: int) -> DataFrame:
    """Rows of the next level from the distances (region, doc_id, n, rank, p, d)
    of all documents but the pivots themselves, which are done.  ``slack``
    keeps rounding from losing a copy."""
    slack = 1e-9
    # pivots within 4e of each other share a cell: their windows overlap, and copies would only repeat each other
    close = near.join(pivots.select("region", F.col("p").alias("doc_id")), ["region", "doc_id"]).where(F.col("d") <= 4 * e) \
        .groupBy("region", F.col("doc_id").alias("q")).agg(F.min("p").alias("first"))
    cells = pivots.join(close.withColumnRenamed("q", "p"), ["region", "p"], "left").select("region", "p", F.least("p", "first").alias("cell"))
    best = near.groupBy("region", "doc_id").agg(F.min("d").alias("dmin"))
    done = pivots.select("region", F.col("p").alias("doc_id"))
    x = near.join(best, ["region", "doc_id"]).join(done, ["region", "doc_id"], "left_anti")
    inside = x.where((F.col("dmin") < 3 * e) & (F.col("d") <= F.col("dmin") + 2 * e + slack)).join(cells, ["region", "p"]) \
        .select(F.xxhash64("region", "cell", F.lit(level)).alias("region"), "doc_id", "n", "rank").distinct()
    outside = x.where(F.col("dmin") >= 2 * e - slack).select(F.xxhash64("region", F.lit(-1), F.lit(level)).alias("region"), "doc_id", "n", "rank").distinct()
    return inside.unionByName(outside)


# ---------------------------------------------------------------- the join

def _points(src: DataFrame, able: DataFrame, odd: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, text): a text of each class (point, rep,
    n_shingles) of ``able``, with the class as doc_id."""
    ids = odd.select(F.col("doc_id").alias("rep"))
    # an id with one set names its class; any of its texts with a word will do
    one = able.join(ids, "rep", "left_anti").withColumnRenamed("rep", "doc_id")
    named = src.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).join(F.broadcast(one) if few(able) else one, "doc_id") \
        .dropDuplicates(["doc_id"]).select(F.col("point").alias("doc_id"), "n_shingles", "text")
    if not odd.take(1):
        return named
    several = with_class(src.join(odd.select("doc_id"), "doc_id", "left_semi"), k).withColumn("doc_id", class_id()) \
        .join(able.join(ids, "rep", "left_semi").select(F.col("point").alias("doc_id")), "doc_id", "left_semi") \
        .dropDuplicates(["doc_id"]).select("doc_id", "n_shingles", "text")
    return named.unionByName(several)


def jaccard_components(docs: DataFrame, percent: int = PERCENT, k: int = WORDS, solve: int = SOLVE) -> DataFrame:
    """(doc_id, n_shingles long, component_id long) of every row of ``docs``
    (doc_id, text): component_id is the smallest doc_id reachable by links.

    Null and empty texts and texts without a word have no shingle and link
    with nothing; fewer words than k are one shingle.  Rows with equal doc_id
    are one document if their sets are equal, and link by them if not; rows
    without a doc_id get component null.  Other columns are left behind; an
    empty table gives an empty table.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sizes = save(set_sizes(src, k).withColumn("point", class_id()), "set-sizes")
    whole = sizes.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = whole.groupBy("point", "n_shingles").agg(F.min("doc_id").alias("rep"))
    total = whole.agg(F.sum("n_shingles")).first()[0] or 0
    # ids with several sets: no count of their own, always points, and linked among themselves
    odd = save(whole.groupBy("doc_id").agg(F.min("point").alias("first"), F.max("point").alias("last")).where("first <> last"), "odd")
    half = shared_counts(src.where("doc_id IS NOT NULL"), max(16, total // BUCKET), k)
    enough = F.col("shared") >= F.col("n_half") - (F.col("n_shingles") - least_overlap(F.col("n_shingles"), percent))
    able = classes.join(half.withColumnRenamed("doc_id", "rep"), "rep").where(enough).select("point", "rep", "n_shingles") \
        .unionByName(classes.join(odd.select(F.col("doc_id").alias("rep")), "rep", "left_semi").select("point", "rep", "n_shingles")).distinct()
    able = save(able, "able")
    points = save(_points(src, able, odd, k), "points")
    labels, edges = link_components(voronoi_windows(points, percent, k), points, percent, k, solve)
    if odd.take(1):
        same = whole.join(odd, "doc_id").select(F.col("first").alias("a"), F.col("point").alias("b")).where("a <> b").distinct()
        labels = save(connected_components(same if edges is None else edges.unionByName(same)), "labels")
    if labels is None:
        of_class = classes.select("point", F.col("rep").alias("component_id"))
    else:
        rooted = classes.join(labels.withColumnRenamed("id", "point"), "point", "left").withColumn("root", F.coalesce("root", "point"))
        least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
        of_class = rooted.join(least, "root").select("point", "component_id")
    mine = sizes.join(of_class, "point", "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return mine.select("doc_id", "n_shingles", own.alias("component_id"))

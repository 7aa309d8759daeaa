"""Language-model scores (operator 10): a word-count base and prediction by
partial matching over bytes.

Base: log10((c + 0.1) / (N + 0.1 (V + 1))) summed over a text's words and one
end token, with counts from the training texts.  Words travel as 64-bit
hashes.  A block of documents sends one count per distinct word, however often
the word occurs, and gets the corpus count back; so the most frequent words
are no hot keys, and the counts are never gathered in one place.

PPM: the trie of byte contexts up to order 3 with escape estimation C (the
number of distinct symbols seen) and symbol exclusion: symbols seen in a
context are taken out of the shorter context's distribution, which is scaled
to what remains.  Byte 0xFF stands for the end of a text, 0xFE for what is
before its start; neither occurs in UTF-8.  All training texts are counted.
The trie that goes to the tasks has all contexts of up to two bytes and the
``max_contexts`` most frequent of three.  The other contexts of three stay in
Spark: a block sends each distinct code it has outside that trie to the range
of context hashes where their counts are, and gets back how much the code's
log probability differs from what the shorter context gave it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, drop, mix64, partitions, save, text_buffer, text_chunks, word_hashes, worker_store

MAX_CONTEXTS = 32_768
BLOCK_BYTES = 4 << 20
FLUSH_ENTRIES = 4_000_000
START, END = 0xFE, 0xFF
END_TOKEN = mix64(np.array([0xE0F], np.uint64))[0]


# ---------------------------------------------------------------- PPM

def text_symbols(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, text of each, text ends): for every byte of every text and its
    end, the three bytes before it and itself as one 32-bit number."""
    data, off = text_buffer(arr)
    n = len(off) - 1
    size = np.diff(off)
    buf = np.full(len(data) + 4 * n, START, np.uint8)
    first = off[:-1] + 4 * np.arange(n) + 3
    keep = np.ones(len(buf), bool)
    for k in range(1, 4):
        keep[first - k] = False
    ends = first + size
    buf[ends] = END
    body = keep.copy()
    body[ends] = False
    buf[body] = data
    wide = buf.astype(np.uint32)
    code = wide.copy()
    code[1:] |= wide[:-1] << np.uint32(8)
    code[2:] |= wide[:-2] << np.uint32(16)
    code[3:] |= wide[:-3] << np.uint32(24)
    return code[keep], np.repeat(np.arange(n), size + 1), np.cumsum(size + 1)


def _merge(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    c, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(c, kind="stable")
    c, n = c[order], n[order]
    at = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1]))) if len(c) else np.zeros(0, np.int64)
    return c[at], np.add.reduceat(n, at) if len(at) else n


def count_contexts(texts: DataFrame) -> DataFrame:
    """(context int, symbol int, n long): how often each byte follows each
    three bytes in the texts (one column, ``text``).  Tasks merge their
    counts before the shuffle."""

    def run(batches):
        codes, counts = [], []

        def rows():
            c, n = _merge(codes, counts)
            return pa.RecordBatch.from_arrays([pa.array((c >> np.uint32(8)).astype(np.int32)), pa.array((c & np.uint32(255)).astype(np.int32)),
                                               pa.array(n)], names=["context", "symbol", "n"])
        for b in batches:
            for part in text_chunks(b, BLOCK_BYTES):
                c, n = np.unique(text_symbols(part.column(0))[0], return_counts=True)
                codes.append(c), counts.append(n.astype(np.int64))
                if sum(map(len, codes)) > FLUSH_ENTRIES:
                    c, n = _merge(codes, counts)
                    codes, counts = [c], [n]
                    if len(c) > FLUSH_ENTRIES // 2:
                        yield rows()
                        codes, counts = [], []
        if codes:
            yield rows()

    return texts.select("text").mapInArrow(run, "context int, symbol int, n long") \
        .groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def learn_trie(texts: DataFrame, max_contexts: int = MAX_CONTEXTS) -> list[tuple[np.ndarray, np.ndarray]]:
    """The trie of ``learn_contexts`` alone."""
    trie, rest = learn_contexts(texts, max_contexts)
    drop(rest)
    return trie


def learn_contexts(texts: DataFrame, max_contexts: int = MAX_CONTEXTS) -> tuple[list[tuple[np.ndarray, np.ndarray]], DataFrame]:
    """(trie, all counted contexts of three as (context, symbol, n)).

    The trie: [(codes, counts)] of orders 0 to 3; a code is the context's bytes and
    the symbol.  At most 2**24 entries of orders 0 to 2 and 256 *
    ``max_contexts`` of order 3 are possible, whatever the corpus."""
    full = save(count_contexts(texts), "contexts")
    kept = full.groupBy("context").agg(F.sum("n").alias("t")).orderBy(F.desc("t"), "context").limit(max_contexts)
    top = full.join(kept.select("context"), "context", "left_semi")
    out = []
    for order in range(4):
        ctx = F.col("context").bitwiseAND((1 << 8 * order) - 1)
        src = top if order == 3 else full
        rows = src.groupBy(ctx.alias("c"), "symbol").agg(F.sum("n").alias("n")).orderBy("c", "symbol").toArrow()
        c, s, n = (rows.column(i).to_numpy().astype(np.int64) for i in range(3))
        out.append(((c << 8 | s).astype(np.uint32), n))
    return out, full


def log_table(trie: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(row of every three-byte context, log10 probabilities (rows, 256)): a
    context without its own row has that of its longest known suffix."""
    below = np.full((1, 256), 1.0 / 256)
    rows = np.zeros(1, np.int32)                 # row of every context of the order below
    tables, used = [below], 1
    for order in range(4):
        codes, n = trie[order]
        if order:
            rows = np.tile(rows, 256)            # contexts of this order, by their last bytes
        if not len(codes):
            continue
        contexts, first = np.unique(codes >> np.uint32(8), return_index=True)
        ends = np.append(first[1:], len(codes))
        parents = np.concatenate(tables)[rows[contexts]]
        p = np.zeros((len(contexts), 256))
        r = np.repeat(np.arange(len(contexts)), ends - first)
        p[r, codes & np.uint32(255)] = n
        seen = p > 0
        total, distinct = p.sum(1, keepdims=True), seen.sum(1, keepdims=True)
        rest = np.where(seen, 0.0, parents)
        left = rest.sum(1, keepdims=True)
        # with nothing left to escape to, all of the mass is for seen symbols
        escape = np.where(left > 0, distinct / (total + distinct), 0.0)
        p = p / total * (1 - escape) + rest * (escape / np.where(left > 0, left, 1.0))
        rows[contexts] = used + np.arange(len(contexts), dtype=np.int32)
        tables.append(p)
        used += len(contexts)
    return rows, np.log10(np.concatenate(tables)).astype(np.float32)


class Model:
    """The table of a worker."""

    def __init__(self, trie):
        rows, self.log = log_table(trie)
        self.own = len(self.log) - len(np.unique(trie[3][0] >> np.uint32(8)))    # first row of a context of three
        self.rows = rows if len(rows) == 1 << 24 else np.resize(rows, 1 << 24)

    def score(self, arr: pa.Array) -> np.ndarray:
        """log10 probability of each text with its end."""
        code, _, ends = text_symbols(arr)
        lp = self.log.ravel()[self.rows[code >> np.uint32(8)].astype(np.int64) * 256 + (code & np.uint32(255))]
        return np.add.reduceat(lp.astype(np.float64), np.concatenate(([0], ends[:-1]))) if len(ends) else np.zeros(0)


    def open_codes(self, arr: pa.Array) -> dict[str, np.ndarray]:
        """The distinct codes whose context of three the trie lacks, in order
        of the context's hash, and their postings as in ``block_words``."""
        code, text, _ = text_symbols(arr)
        at = self.rows[code >> np.uint32(8)] < self.own
        post, count = np.unique(code[at].astype(np.uint64) << np.uint64(16) | text[at].astype(np.uint64), return_counts=True)
        code = (post >> np.uint64(16)).astype(np.uint32)
        order = np.argsort(_context_hash(code), kind="stable")
        code, post, count = code[order], post[order], count[order]
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
        return {"code": code[first], "code_post": np.diff(np.append(first, len(code))).astype(np.uint32),
                "code_text": (post & np.uint64(0xFFFF)).astype(np.uint16), "code_count": count.astype(np.uint32)}

    def corrections(self, asked: np.ndarray, codes: np.ndarray, n: np.ndarray) -> np.ndarray:
        """For each code asked, its log10 probability by the contexts of
        three counted in (codes, n), less that by the shorter context; 0
        where the context is not among them.  codes: ascending."""
        out = np.zeros(len(asked))
        if not len(codes) or not len(asked):
            return out
        contexts, first = np.unique(codes >> np.uint32(8), return_index=True)
        ends = np.append(first[1:], len(codes))
        where = np.minimum(np.searchsorted(contexts, asked >> np.uint32(8)), len(contexts) - 1)
        known = np.flatnonzero(contexts[where] == asked >> np.uint32(8))
        known = known[np.argsort(where[known], kind="stable")]
        used = np.unique(where[known])
        for i in range(0, len(used), 4096):
            part = used[i:i + 4096]
            r = np.repeat(np.arange(len(part)), ends[part] - first[part])
            entry = np.concatenate([np.arange(first[c], ends[c]) for c in part])
            p = np.zeros((len(part), 256))
            p[r, codes[entry] & np.uint32(255)] = n[entry]
            below = self.log[self.rows[contexts[part]]].astype(np.float64)
            total, distinct = p.sum(1), (p > 0).sum(1)
            left = np.where(p > 0, 0.0, 10.0 ** below).sum(1)
            some = left > 0
            a, z = np.searchsorted(where[known], [part[0], part[-1] + 1])
            mine = known[a:z]
            k, symbol = np.searchsorted(part, where[mine]), asked[mine] & np.uint32(255)
            seen = p[k, symbol] > 0
            scale = np.where(some, total + distinct, total)[k]
            out[mine] = np.where(seen, np.log10(np.where(seen, p[k, symbol], 1.0) / scale) - below[k, symbol],
                                 np.log10(distinct[k] / scale / np.where(some, left, 1.0)[k]))
        return out


def _context_hash(code: np.ndarray) -> np.ndarray:
    return mix64((code >> np.uint32(8)).astype(np.uint64))


def score_texts(docs: DataFrame, trie, carry: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """(*carry, score double): the log10 probability under the trie; a null
    text counts as empty (its end alone is scored)."""
    sc = docs.sparkSession.sparkContext.broadcast(trie)
    digest = _digest(trie)
    sel = docs.select(*carry, F.col(text).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sel.schema.fields[:-1])

    def run(batches):
        model = _model(sc, digest)
        for b in batches:
            for part in text_chunks(b, BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(model.score(part.column(part.num_columns - 1)))],
                                                 names=[*part.schema.names[:-1], "score"])

    return sel.mapInArrow(run, schema + ", score double")


def _digest(trie) -> str:
    h = hashlib.sha256()
    for c, n in trie:
        h.update(c.tobytes() + n.tobytes())
    return h.hexdigest()[:16]


def _model(broadcast, digest: str) -> Model:
    store = worker_store("ppm")
    if store.get("digest") != digest:            # one model at a time
        store.clear()
        store.update(model=Model(broadcast.value), digest=digest)
    return store["model"]


# ---------------------------------------------------------------- word base

def block_words(arr: pa.Array, train: np.ndarray) -> dict[str, np.ndarray]:
    """The distinct words of a block, sorted by hash: ``word``, occurrences in
    training texts ``n_train``, and the postings: number ``n_post`` of texts
    with the word, then ``text`` and ``count`` of each."""
    data, off = text_buffer(arr)
    w, ptr = word_hashes(data, off)
    n = len(off) - 1
    doc = np.concatenate([np.repeat(np.arange(n), np.diff(ptr)), np.arange(n)]).astype(np.uint16)
    w = np.concatenate([w, np.full(n, END_TOKEN, np.uint64)])
    order = np.argsort(w, kind="stable")         # stable: texts stay in order within a word
    w, doc = w[order], doc[order]
    new_word = np.concatenate(([True], w[1:] != w[:-1])) if len(w) else np.zeros(0, bool)
    post = np.flatnonzero(new_word | np.concatenate(([True], doc[1:] != doc[:-1]))) if len(w) else np.zeros(0, np.int64)
    count = np.diff(np.append(post, len(w)))
    first = np.flatnonzero(new_word[post]) if len(post) else post
    text = doc[post]
    n_train = np.add.reduceat(np.where(train[text], count, 0), first) if len(first) else first
    return {"word": w[post[first]] if len(first) else w, "n_train": n_train.astype(np.uint32), "n_tokens": np.diff(ptr) + 1,
            "n_post": np.diff(np.append(first, len(post))).astype(np.uint32), "text": text, "count": count.astype(np.uint32)}


_CODE_COLUMNS = ("code", "code_post", "code_text", "code_count")
_BLOCK_COLUMNS = ("word", "n_train", "n_post", "text", "count", *_CODE_COLUMNS)


def base_and_model_scores(docs: DataFrame, held: Column, max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row, learned from the rows for which ``held`` is not true.

    Null texts count as empty (one end token); repeated rows stay repeated and
    count as often; other columns are left behind.  Without a training row
    nothing is known: N and V are 0.
    """
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"), "text")
    trie, contexts = learn_contexts(src.where("NOT held_out").select(F.coalesce("text", F.lit("")).alias("text")), max_contexts)
    sent, digest = spark.sparkContext.broadcast(trie), _digest(trie)

    def cut(batches):
        from pyspark import TaskContext
        model, block = _model(sent, digest), TaskContext.get().partitionId() << 32
        for b in batches:
            for part in text_chunks(b, BLOCK_BYTES):
                held_out = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                x = block_words(part.column(2), ~held_out)
                x.update(model.open_codes(part.column(2)))
                block += 1
                arrays = [pa.array([block]), *(pa.array([x[c].tobytes()], pa.binary()) for c in _BLOCK_COLUMNS),
                          pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([held_out.tolist()], pa.list_(pa.bool_())),
                          pa.array([x["n_tokens"].tolist()], pa.list_(pa.int64())), pa.array([model.score(part.column(2)).tolist()], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", *_BLOCK_COLUMNS, "doc_id", "held_out", "n_tokens", "score"])

    blocks = save(src.mapInArrow(cut, "block long, " + ", ".join(f"{c} binary" for c in _BLOCK_COLUMNS)
                                 + ", doc_id array<long>, held_out array<boolean>, n_tokens array<long>, score array<double>"), "word-blocks")
    replies = save(_corpus_counts(blocks), "word-counts")
    totals = replies.agg(F.sum("own").alias("N"), F.sum("new").alias("V")).first()
    n_all, v_all = int(totals["N"] or 0), int(totals["V"] or 0)
    counts = replies.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "c"))).alias("c"))   # one block's words
    codes = save(_code_corrections(blocks, contexts, sent, digest), "code-corrections")
    drop(contexts)
    codes = codes.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "d"))).alias("d"))      # one block's codes
    joined = blocks.join(counts, "block").join(codes, "block", "left") \
        .select("n_post", "text", "count", "code_post", "code_text", "code_count", "doc_id", "held_out", "n_tokens", "score", "c", "d")

    def finish(batches):
        from math import log10
        for b in batches:
            for i in range(b.num_rows):
                r = {n: b.column(j)[i].as_py() for j, n in enumerate(b.schema.names)}
                c = np.concatenate([np.frombuffer(x["c"], "<u8") for x in r["c"]])
                c = np.repeat(c, np.frombuffer(r["n_post"], "<u4"))
                text, count = np.frombuffer(r["text"], "<u2"), np.frombuffer(r["count"], "<u4").astype(np.float64)
                n = len(r["doc_id"])
                tokens = np.array(r["n_tokens"], np.int64)
                base = np.bincount(text, count * np.log10(c + 0.1), n) - tokens * log10(n_all + 0.1 * (v_all + 1))
                d = np.concatenate([np.frombuffer(x["d"], "<f8") for x in r["d"] or []] or [np.zeros(0)])
                d = np.repeat(d, np.frombuffer(r["code_post"], "<u4")) * np.frombuffer(r["code_count"], "<u4")
                score = np.array(r["score"], np.float64) + np.bincount(np.frombuffer(r["code_text"], "<u2"), d, n)
                known = np.bincount(text, count * (c > 0), n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_id"], pa.int64()), pa.array(r["held_out"], pa.bool_()), pa.array(tokens), pa.array(known),
                     pa.array(np.full(n, n_all, np.int64)), pa.array(base), pa.array(score)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return joined.mapInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                     "base_score double, score double")


def _corpus_counts(blocks: DataFrame) -> DataFrame:
    """(block, bucket, c binary, own, new): the corpus counts of a block's
    words, by ranges of the hash; own: the block's training tokens; new: the
    distinct training words of the bucket, given with its first block."""
    spark = blocks.sparkSession
    size = blocks.agg(F.sum(F.octet_length("word"))).first()[0] or 0
    bits = max(4, int(np.ceil(np.log2(max(size / (8 << 20), 1)))))          # about 8 MB of hashes in a bucket

    def split(batches):
        shift = np.uint64(64 - bits)
        for b in batches:
            for i in range(b.num_rows):
                block = b.column(0)[i].as_py()
                word, n = np.frombuffer(b.column(1)[i].as_py(), "<u8"), np.frombuffer(b.column(2)[i].as_py(), "<u4")
                buckets = (word >> shift).astype(np.int64)
                own, first = np.unique(buckets, return_index=True)
                ends = np.append(first[1:], len(word))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.astype(np.int32)), pa.array([block] * len(own), pa.int64()),
                     pa.array([word[a:z].tobytes() for a, z in zip(first, ends)], pa.binary()),
                     pa.array([n[a:z].tobytes() for a, z in zip(first, ends)], pa.binary())], names=["bucket", "block", "word", "n"])

    def answer(batches):
        held, bucket = [], None

        def rows():
            words = [np.frombuffer(h[1], "<u8") for h in held]
            own = [np.frombuffer(h[2], "<u4").astype(np.int64) for h in held]
            all_words, n = _merge(words, own)
            c = [n[np.searchsorted(all_words, w)] for w in words]
            new = [int((n > 0).sum())] + [0] * (len(held) - 1)
            return pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in held], pa.int64()), pa.array([bucket] * len(held), pa.int32()),
                 pa.array([x.astype("<u8").tobytes() for x in c], pa.binary()), pa.array([int(o.sum()) for o in own], pa.int64()),
                 pa.array(new, pa.int64())], names=["block", "bucket", "c", "own", "new"])
        for b in batches:
            for k, block, w, n in zip(*(b.column(i).to_pylist() for i in range(4))):
                if k != bucket and held:
                    yield rows()
                    held = []
                bucket = k
                held.append((block, w, n))
        if held:
            yield rows()

    return blocks.select("block", "word", "n_train").mapInArrow(split, "bucket int, block long, word binary, n binary") \
        .repartition(min(1 << bits, 4 * partitions(spark)), "bucket").sortWithinPartitions("bucket", "block") \
        .mapInArrow(answer, "block long, bucket int, c binary, own long, new long")


def _code_corrections(blocks: DataFrame, contexts: DataFrame, sent, digest: str) -> DataFrame:
    """(block, bucket, d binary): ``Model.corrections`` of a block's codes, by
    ranges of the context's hash."""
    spark = blocks.sparkSession
    size = (blocks.agg(F.sum(F.octet_length("code"))).first()[0] or 0) + 12 * contexts.count()
    bits = max(4, int(np.ceil(np.log2(max(size / (8 << 20), 1)))))
    schema = "bucket int, block long, code binary, n binary"

    def pieces(block, code, n):
        bucket = (_context_hash(code) >> np.uint64(64 - bits)).astype(np.int64)      # ascending
        own, first = np.unique(bucket, return_index=True)
        ends = np.append(first[1:], len(code))
        return pa.RecordBatch.from_arrays(
            [pa.array(own.astype(np.int32)), pa.array([block] * len(own), pa.int64()), pa.array([code[a:z].tobytes() for a, z in zip(first, ends)], pa.binary()),
             pa.array([n[a:z].tobytes() for a, z in zip(first, ends)], pa.binary())], names=["bucket", "block", "code", "n"])

    def ask(batches):
        for b in batches:
            for block, code in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pieces(block, np.frombuffer(code, "<u4"), np.zeros(0, np.int64))

    def offer(batches):
        model = _model(sent, digest)
        for b in batches:
            context, symbol, n = (b.column(i).to_numpy().astype(np.int64) for i in range(3))
            keep = np.flatnonzero(model.rows[context] < model.own)
            code = (context[keep] << 8 | symbol[keep]).astype(np.uint32)
            order = np.argsort(_context_hash(code), kind="stable")
            yield pieces(-1, code[order], n[keep][order])        # before all blocks

    def answer(batches):
        model, bucket, codes, counts = _model(sent, digest), None, [], []
        for b in batches:
            for k, block, code, n in zip(*(b.column(i).to_pylist() for i in range(4))):
                if k != bucket:
                    bucket, codes, counts = k, [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
                code = np.frombuffer(code, "<u4")
                if block < 0:
                    codes.append(code), counts.append(np.frombuffer(n, "<i8"))
                    continue
                if len(codes) > 1:
                    c, m = _merge(codes, counts)
                    codes, counts = [c], [m]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([k], pa.int32()),
                                                  pa.array([model.corrections(code, codes[0], counts[0]).tobytes()], pa.binary())], names=["block", "bucket", "d"])

    return blocks.select("block", "code").mapInArrow(ask, schema).unionByName(contexts.select("context", "symbol", "n").mapInArrow(offer, schema)) \
        .repartition(min(1 << bits, 4 * partitions(spark)), "bucket").sortWithinPartitions("bucket", "block") \
        .mapInArrow(answer, "block long, bucket int, d binary")


def held_out_scores(docs: DataFrame, max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """All rows, learned from those whose crc32(doc_id) mod 10 is not 0; rows
    without a doc_id are not held out."""
    return base_and_model_scores(docs, crc_mod(F.col("doc_id"), 10) == 0, max_contexts)

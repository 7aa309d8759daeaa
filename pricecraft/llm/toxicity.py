"""Toxicity by compression distance (operator 7).

Two zstandard dictionaries are trained, on ordinary and on toxic text.  They
share the ordinary segments.  The toxic one also holds segments trained on
what toxic windows are made of: their runs of terms (words and phrases) that a
larger share of the sampled toxic texts has than of the ordinary ones, by more
than chance (``EVIDENCE``; near copies of a text count once).  Terms that
training left out are put before them.  The other one holds as many more
ordinary segments.  A text is cut into windows of ``WINDOW`` words; how much
shorter a window gets with the toxic dictionary is its gain.  The gains above
thresholds, their rate and the greatest one are calibrated to a probability
by a logistic fit on training rows that the dictionaries have not seen.

Fitting reads bounded samples of the labelled rows (``Bounds``); scoring
reads every whole text.  Language, source and id are no inputs.
"""

from __future__ import annotations

import hashlib
import sys
import unicodedata
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, save, text_chunks, worker_store

WINDOW = 8
LEVEL = 9
BASE_BYTES = 8192
TAIL_BYTES = 1024
THRESHOLD = 0.3
MIN_TEXTS, EVIDENCE = 4, 20.0       # a term has so many toxic texts and this G statistic (chance: 4 in a million), whatever the sample's size
PHRASE = 3                          # words of a term, at most
FAR = 9
FLUSH_TERMS = 400_000
EDGES = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] in "PS")
GAINS = (2, 3, 4)
#: Longer windows are cut into samples of this size.
SAMPLE_BYTES = 4096


@dataclass
class Bounds:
    """At most so many rows are used for fitting, first in order of a hash of
    their id; all windows of these rows are used.  Evidence for terms comes from
    all toxic and ordinary rows, the ordinary dictionary from the first
    ``dictionary_texts`` of the ordinary ones."""

    toxic_texts: int = 8_000
    ordinary_texts: int = 16_000
    calibration_texts: int = 16_000
    dictionary_texts: int = 6_000


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: list[float] = field(default_factory=list)
    shift: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)


def text_windows(text: str | None) -> list[bytes]:
    """Windows of WINDOW words, A-Z lower-cased, framed by spaces."""
    w = (text or "").encode().lower().split()
    return [b" " + b" ".join(w[i:i + WINDOW]) + b" " for i in range(0, len(w), WINDOW)]


def bare_words(text: str | None) -> list[str]:
    """The words of ``text_windows`` without punctuation at their ends; '' for one of more than 100 letters."""
    words = (w.decode() for w in (text or "").encode().lower().split())
    return ["" if len(w) > 100 else w if w.isalnum() else w.strip(EDGES) for w in words]


def terms(words: list[str]):
    """(term, first word, end) of every run of up to PHRASE words in one window."""
    for i in range(len(words)):
        for n in range(1, min(PHRASE, WINDOW - i % WINDOW, len(words) - i) + 1):
            if not words[i + n - 1]:
                break
            yield " ".join(words[i:i + n]), i, i + n


def text_terms(text: str | None) -> dict[str, int]:
    """The text's terms, each with a hash of the words FAR around where it is first."""
    words = bare_words(text)
    first = {}
    for x, a, z in terms(words):
        if x not in first:
            first[x] = zlib.crc32(f"{words[max(a - FAR, 0)]} {words[min(z + FAR, len(words)) - 1]}".encode())
    return first


def count_terms(texts: DataFrame, wanted: set[str] | None = None) -> DataFrame:
    """(term, n): how many of the texts (one column, ``text``) have each term,
    or each of those wanted.  Texts with the same words FAR around the term
    are copies and count once.  Tasks merge their rows before the shuffle."""
    sent = None if wanted is None else texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        found = set()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([c for _, c in found], pa.int64())], names=["term", "around"])
        for batch in batches:
            for part in text_chunks(batch, 4 << 20):
                for t in part.column(0).to_pylist():
                    found.update((x, c) for x, c in text_terms(t).items() if sent is None or x in sent.value)
                    if len(found) > FLUSH_TERMS:
                        yield rows()
                        found.clear()
        yield rows()

    return texts.select("text").mapInArrow(run, "term string, around long").distinct().groupBy("term").agg(F.count("*").alias("n"))


def select_terms(toxic: DataFrame, ordinary: DataFrame) -> list[str]:
    """The terms that toxic texts have more often than ordinary ones by more
    than chance, the strongest last.  A phrase counts only where its smoothed
    likelihood ratio exceeds that of all its parts."""
    n_t, n_o = toxic.count(), ordinary.count()
    if not n_t or not n_o:
        return []
    share = n_t / (n_t + n_o)
    least = max(MIN_TEXTS, EVIDENCE / (-2 * np.log(share)))      # fewer are too few even if no ordinary text has the term

    def fetch(counts):
        got = counts.toArrow()
        return dict(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))
    t = fetch(count_terms(toxic).where(F.col("n") >= float(least)))
    o = fetch(count_terms(ordinary, set(t)))

    def evidence(x):
        a, b = t[x], o.get(x, 0)
        e = (a + b) * share
        return 2 * (a * np.log(a / e) + (b * np.log(b / (a + b - e)) if b else 0)) if a > e else 0.0
    ratio = {x: (a + 0.5) / (n_t + 1) * (n_o + 1) / (o.get(x, 0) + 0.5) for x, a in t.items()}

    def adds(x):
        w = x.split(" ")
        return all(ratio[x] > ratio.get(" ".join(w[i:i + n]), 0.0) for n in range(1, len(w)) for i in range(len(w) - n + 1))
    strong = {x: e for x in t if (e := evidence(x)) >= EVIDENCE and adds(x)}
    return sorted(strong, key=lambda x: (strong[x], x))


def toxic_runs(texts: DataFrame, strong: list[str]) -> DataFrame:
    """(w binary): the windows' longest runs of words of the strong terms, framed by spaces."""
    sent = texts.sparkSession.sparkContext.broadcast(set(strong))

    def runs(text):
        words = bare_words(text)
        marked = [False] * len(words)
        for x, a, z in terms(words):
            if x in sent.value:
                marked[a:z] = [True] * (z - a)
        for i in range(0, len(words), WINDOW):
            run = []
            for x, m in [*zip(words[i:i + WINDOW], marked[i:i + WINDOW]), ("", False)]:
                if m:
                    run.append(x)
                elif run:
                    yield (" " + " ".join(run) + " ").encode()
                    run = []

    def cut(batches):
        for batch in batches:
            for part in text_chunks(batch, 4 << 20):
                yield pa.RecordBatch.from_arrays([pa.array([r for t in part.column(0).to_pylist() for r in runs(t)], pa.binary())], names=["w"])

    return texts.mapInArrow(cut, "w binary")


def train(samples: list[bytes], size: int, k: int = 48, d: int = 6) -> bytes:
    """A zstandard dictionary's bytes.  Below 16 samples or 4 times ``size``, or
    where the library finds too little to train on, the end of the samples
    themselves (``size`` bytes), which serves as a dictionary too."""
    import zstandard
    total = sum(map(len, samples))
    if total > 4 * size and len(samples) >= 16:
        try:
            return zstandard.train_dictionary(size, samples, d=d, k=k).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


def compressor(content: bytes):
    import zstandard
    d = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    p = zstandard.ZstdCompressionParameters.from_level(LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0,
                                                       write_checksum=0, write_dict_id=0)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress


def features(gains: np.ndarray) -> list[float]:
    """What the logistic fit sees of a text's window gains."""
    if not len(gains):
        gains = np.zeros(1)
    over = [np.maximum(gains - t + 1, 0) for t in GAINS]
    n = len(gains)
    return [float(gains.max()), *(float(np.log1p(o.sum())) for o in over), *(float(np.sqrt(o.mean())) for o in over), float(np.log1p(n))]


def _gain_features(docs: DataFrame, ordinary: bytes, toxic: bytes, weights=None) -> DataFrame:
    """(doc_id, f array<double>) of every row."""
    digest = hashlib.sha256(ordinary + b"|" + toxic).hexdigest()[:16]

    def run(batches):
        store = worker_store("zstd")
        if store.get("digest") != digest:
            store.update(digest=digest, ordinary=compressor(ordinary), toxic=compressor(toxic))
        a, b = store["ordinary"], store["toxic"]
        for batch in batches:
            for part in text_chunks(batch, 4 << 20):
                f = [features(np.array([len(a(w)) - len(b(w)) for w in text_windows(t)], np.float64)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(f, pa.list_(pa.float64()))], names=["doc_id", "f"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, f array<double>")


def fit(docs: DataFrame, labels: DataFrame, dictionary: Column, calibration: Column, bounds: Bounds | None = None) -> Model:
    """Fit from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id,
    toxic) marks; the columns say which ids the dictionaries and the
    calibration may use."""
    bounds = bounds or Bounds()
    lab = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(7))
    picked = [lab.where(dictionary & (F.col("toxic") == 1)).orderBy(order).limit(bounds.toxic_texts).withColumn("use", F.lit("d")),
              lab.where(dictionary & (F.col("toxic") == 0)).orderBy(order).limit(bounds.ordinary_texts).withColumn("use", F.lit("d")),
              lab.where(calibration).orderBy(order).limit(bounds.calibration_texts).withColumn("use", F.lit("c"))]
    chosen = picked[0].unionByName(picked[1]).unionByName(picked[2])
    sample = save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                  .join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL"), "toxicity-sample")       # bounded rows
    train_rows = sample.where("use = 'd'")

    toxic, plain_texts = (train_rows.where(F.col("toxic") == v).select("text") for v in (1, 0))
    strong = select_terms(toxic, plain_texts)

    def cut(batches):
        for batch in batches:
            for part in text_chunks(batch, 4 << 20):
                yield pa.RecordBatch.from_arrays([pa.array([w[i:i + SAMPLE_BYTES] for t in part.column(0).to_pylist() for w in text_windows(t) for i in range(0, len(w), SAMPLE_BYTES)],
                                                         pa.binary())], names=["w"])

    # a whole set of rows, bounded above, so that all of their windows count
    first = train_rows.where("toxic = 0").orderBy(order).limit(bounds.dictionary_texts).select("text")
    ordinary = [bytes(r[0]) for r in first.mapInArrow(cut, "w binary").orderBy(F.xxhash64("w"), "w").collect()]
    runs = [bytes(r[0]) for r in toxic_runs(toxic, strong).orderBy(F.xxhash64("w"), "w").collect()] if strong else []
    listed = [b" " + x.encode() + b" " for x in strong]
    trained = train(runs, max(2 * sum(map(len, listed)), 256), k=32, d=8) if runs else b""
    tail = b"".join(x for x in listed if x not in trained) + trained        # all terms, whatever training chose
    half = len(ordinary) // 2
    base, plain = train(ordinary[:half], BASE_BYTES)[-BASE_BYTES:], train(ordinary[half:], max(len(tail), TAIL_BYTES), k=16)
    model = Model(ordinary=plain[-len(tail):] + base, toxic=tail + base)

    cal = _gain_features(sample.where("use = 'c'"), model.ordinary, model.toxic).join(chosen.where("use = 'c'"), "doc_id") \
        .select("doc_id", "f", "toxic").orderBy("doc_id").collect()
    model.weights, model.shift, model.scale = fit_logistic([r["f"] for r in cal], [r["toxic"] for r in cal])
    return model


def fit_logistic(x: list[list[float]], y: list[int], ridge: float = 1.0) -> tuple[list[float], list[float], list[float]]:
    """Ridge logistic regression by Newton steps: (weights with the intercept
    last, shift, scale).  Without both classes the weights are 0 but for the
    (smoothed) base rate."""
    width = len(features(np.zeros(0)))
    a = np.array(x, np.float64).reshape(-1, width)
    t = np.array(y, np.float64)
    shift = a.mean(0) if len(a) else np.zeros(width)
    scale = np.where((s := a.std(0) if len(a) else np.zeros(width)) > 0, s, 1.0)
    w = np.zeros(width + 1)
    w[-1] = np.log((t.sum() + 0.5) / (len(t) - t.sum() + 0.5)) if len(t) else -5.0
    if 0 < t.sum() < len(t):
        z = np.hstack([(a - shift) / scale, np.ones((len(a), 1))])
        reg = np.full(width + 1, ridge)
        reg[-1] = 0

        def loss(w):
            return np.logaddexp(0, np.where(t > 0, -1, 1) * (z @ w)).sum() + (reg * w * w).sum() / 2
        now = loss(w)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(reg), z.T @ (t - p) - reg * w)
            # a whole step may go beyond the minimum (few rows far from the others) and never come back
            while (then := loss(w + step)) > now and np.abs(step).max() >= 1e-8:
                step = step / 2
            if np.abs(step).max() < 1e-8:
                break
            w, now = w + step, then
    return w.tolist(), shift.tolist(), scale.tolist()


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score double, predicted int) of every row of ``docs``.

    Null and empty texts have no window and get the score of gains 0; one
    row in, one row out, repeated rows too; other columns are left behind.
    """
    logit = F.lit(model.weights[-1])
    for i, (w, a, s) in enumerate(zip(model.weights, model.shift, model.scale)):
        logit = logit + F.lit(w) * (F.get("f", F.lit(i)) - F.lit(a)) / F.lit(s)
    return _gain_features(docs, model.ordinary, model.toxic) \
        .select("doc_id", (1 / (1 + F.exp(-logit))).alias("score")) \
        .select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def score_held_out(docs: DataFrame, labels: DataFrame, bounds: Bounds | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted: dictionaries from labelled rows
    whose crc32(doc_id) mod 4 is 0 or 1, calibration from 3; 2 is held out."""
    rest = crc_mod(F.col("doc_id"), 4)
    model = fit(docs, labels, rest.isin(0, 1), rest == 3, bounds)
    return score(docs, model).select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "score", "predicted")

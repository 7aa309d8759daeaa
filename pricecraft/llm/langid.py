"""Language identification with hyperdimensional profiles (operator 9).

Every letter has a random vector of +-1 (drawn from its code point alone).  A
letter trigram inside a word, word edges included, is bound as the product of
the first letter's vector rotated twice, the second's rotated once and the
third's.  A text is the bundle (sum) of its trigrams' vectors, a language the
bundle of its training texts.  Texts go to the language of greatest cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import crc_mod, text_chunks, worker_store

DIM = 1024
SEED = 9
MEMO_TRIGRAMS = 30_000
BLOCK_TRIGRAMS = 4_096
SLICE_DOCS = 256
SLICE_BYTES = 1 << 20
UND = "und"


def letter_vector(code: int, dim: int, seed: int = SEED) -> np.ndarray:
    """The +-1 vector of a code point; 0 stands for the edge of a word."""
    return np.random.default_rng((seed, code)).integers(0, 2, dim, dtype=np.int8) * np.int8(2) - np.int8(1)


class Bundler:
    """Trigram vectors of a worker, made on first use (bounded memo)."""

    def __init__(self, dim: int):
        self.dim = dim
        self.letters: dict[int, np.ndarray] = {}
        self.row: dict[int, int] = {}
        self.rows = np.zeros((0, dim), np.int8)
        self.alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)

    def _letter(self, code: int) -> np.ndarray:
        v = self.letters.get(code)
        if v is None:
            v = self.letters[code] = letter_vector(code, self.dim)
        return v

    def _vector(self, tri: int) -> np.ndarray:
        a, b, c = tri >> 42, tri >> 21 & 0x1FFFFF, tri & 0x1FFFFF
        return np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)

    def vectors(self, tris: np.ndarray) -> np.ndarray:
        """int8 rows of these distinct trigrams."""
        keys = tris.tolist()
        if len(self.row) > MEMO_TRIGRAMS:
            self.row.clear()
            self.rows = self.rows[:0]
        new = [t for t in keys if t not in self.row]
        if new:
            at = len(self.rows)
            self.rows = np.concatenate([self.rows, np.stack([self._vector(t) for t in new])])
            self.row.update((t, at + i) for i, t in enumerate(new))
        return self.rows[[self.row[t] for t in keys]]

    def trigrams(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct trigrams of all texts, index into them of every trigram,
        first trigram of each text with the end)."""
        raw = [(t or "").lower() for t in texts]
        buf = np.frombuffer(("\0" + "\0".join(raw) + "\0").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        ends = np.cumsum([len(t) + 1 for t in raw])
        buf = np.where(self.alpha[buf], buf, 0)
        # an edge is kept once: where a word ends, and before the first one
        codes = np.flatnonzero(np.bincount(buf))
        place = np.zeros(int(codes[-1]) + 1, np.int64)
        place[codes] = np.arange(len(codes))
        dense = place[buf]
        mid = np.flatnonzero(buf[1:-1]) + 1
        k = len(codes)
        tri = (dense[mid - 1] * k + dense[mid]) * k + dense[mid + 1]
        if k ** 3 <= 1 << 22:
            seen = np.flatnonzero(np.bincount(tri, minlength=k ** 3)) if len(tri) else np.zeros(0, np.int64)
            place = np.zeros(k ** 3, np.int32)
            place[seen] = np.arange(len(seen))
            index = place[tri]
        else:
            seen, index = np.unique(tri, return_inverse=True)
        full = (codes[seen // (k * k)] << 42) | (codes[seen // k % k] << 21) | codes[seen % k]
        return full, index, np.concatenate(([0], np.searchsorted(mid, ends)))

    def bundles(self, tris: np.ndarray, index: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
        """(n, dim) sums: trigram ``index[j]`` is added to row ``which[j]``;
        trigrams are taken in blocks, so memory stays bounded."""
        out = np.zeros((n, self.dim), np.float32)
        for lo in range(0, len(tris), BLOCK_TRIGRAMS):
            block = tris[lo:lo + BLOCK_TRIGRAMS]
            v = self.vectors(block).astype(np.float32)
            i, w = index, which
            if len(tris) > BLOCK_TRIGRAMS:
                take = (index >= lo) & (index < lo + len(block))
                i, w = index[take] - lo, which[take]
            count = np.bincount(w * len(block) + i, minlength=n * len(block))
            out += count.reshape(n, len(block)).astype(np.float32) @ v
        return out


def bundler(dim: int) -> Bundler:
    store = worker_store(f"bundler-{dim}")
    if not store:
        store["b"] = Bundler(dim)
    return store["b"]


def learn_prototypes(docs: DataFrame, dim: int = DIM) -> dict[str, np.ndarray]:
    """{language: bundle of all its texts} from (text, lang), rows with a null
    lang left out.  Tasks send one vector per language; the sums are made in
    Spark, and languages x dim numbers reach the driver.
    """
    rows = docs.select(F.col("lang").cast("string").alias("lang"), "text").where("lang IS NOT NULL AND text IS NOT NULL")

    def run(batches):
        b_ = bundler(dim)
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in text_chunks(batch, SLICE_BYTES, SLICE_DOCS):
                langs = part.column(0).to_pylist()
                tris, index, ptr = b_.trigrams(part.column(1).to_pylist())
                if not len(index):
                    continue
                names = sorted(set(langs))
                which = np.repeat([names.index(x) for x in langs], np.diff(ptr))
                for name, x in zip(names, b_.bundles(tris, index, which, len(names)).astype(np.float64)):
                    total[name] = total[name] + x if name in total else x
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([x.tolist() for x in total.values()], pa.list_(pa.float64()))],
                                             names=["lang", "v"])

    sums = rows.mapInArrow(run, "lang string, v array<double>").select("lang", F.posexplode("v").alias("i", "x")) \
        .groupBy("lang", "i").agg(F.sum("x").alias("x")).collect()
    out: dict[str, np.ndarray] = {}
    for r in sums:
        out.setdefault(r["lang"], np.zeros(dim))[r["i"]] = r["x"]
    return dict(sorted(out.items()))


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], dim: int = DIM, carry: tuple[str, ...] = ("doc_id",),
             names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The ``carry`` columns of every row of ``docs`` with the predicted
    language (string) and its score (double), called ``names``.

    score is the cosine with the language's prototype, 0 where negative.
    Null texts, texts without a letter, and all texts if nothing was learned,
    get ``und`` and score 0; of equal cosines the first name wins; repeated
    rows stay repeated; an empty table gives none; columns that are not carried
    are left behind, carried ones may have any names but ``names``.
    """
    if clash := set(names) & set(carry):
        raise ValueError(f"carried columns have the names of the result: {sorted(clash)}")
    langs = sorted(prototypes)
    unit = np.array([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-300) for n in langs], np.float32).reshape(len(langs), dim)
    own = [f"_c{i}" for i in range(len(carry))]
    sel = docs.select(*(docs[c].alias(n) for c, n in zip(carry, own)), docs["text"].alias("_text"))
    schema = StructType([*sel.schema.fields[:-1], StructField("_pred", StringType()), StructField("_score", DoubleType())])

    def run(batches):
        b_ = bundler(dim)
        for batch in batches:
            for part in text_chunks(batch, SLICE_BYTES, SLICE_DOCS, "_text"):
                tris, index, ptr = b_.trigrams(part.column(part.num_columns - 1).to_pylist())
                n = part.num_rows
                empty = ptr[1:] == ptr[:-1]
                if langs:
                    v = b_.bundles(tris, index, np.repeat(np.arange(n), np.diff(ptr)), n)
                    cos = v @ unit.T / np.maximum(np.linalg.norm(v, axis=1), 1e-30)[:, None]
                    best = cos.argmax(1)
                    pred = [UND if e else langs[j] for e, j in zip(empty.tolist(), best.tolist())]
                    score = np.where(empty, 0.0, np.clip(cos[np.arange(n), best], 0.0, 1.0))
                else:
                    pred, score = [UND] * n, np.zeros(n)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(pred, pa.string()), pa.array(score.astype(np.float64))],
                                                 names=[*part.schema.names[:-1], "_pred", "_score"])

    return sel.mapInArrow(run, schema).select(*(F.col(n).alias(c) for c, n in zip(carry, own)), F.col("_pred").alias(names[0]), F.col("_score").alias(names[1]))


def identify_held_out(docs: DataFrame, dim: int = DIM) -> DataFrame:
    """Learn from the rows whose crc32(doc_id) mod 4 is not 2 and predict all:
    doc_id, held_out, lang_pred, score.  Rows without a doc_id are not held out."""
    held = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    return identify(docs, learn_prototypes(docs.where(~held), dim), dim) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "lang_pred", "score")


__all__ = ["learn_prototypes", "identify", "identify_held_out", "letter_vector", "Bundler"]

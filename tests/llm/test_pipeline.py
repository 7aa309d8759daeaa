"""The pipeline's stages against brute force on the whole small table."""

import re
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline

from test_near_duplicates import brute_components
from test_quality_and_toxicity import brute, failed

SMALL = "/root/testdata/sf0.001"


def stages(spark, docs, tmp):
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp}/{i}")
        docs = spark.read.parquet(f"{tmp}/{i}")
        out.append(docs)
    return out


def test_every_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    quality, lang, unique, packed = stages(spark, docs, tmp_path)
    kept = [{r.doc_id for r in d.collect()} for d in (quality, lang, unique)]
    assert all(d.columns == docs.columns for d in (quality, lang, unique))
    assert all(rows[r.doc_id] == r for d in (quality, lang, unique) for r in d.collect())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert all(not failed(brute(rows[i].text)) for i in kept[0])
    good = [i for i, q in labels.items() if q == 1 and not failed(brute(rows[i].text))]
    assert len(set(good) & kept[0]) >= 0.95 * len(good)
    assert kept[1] <= kept[0] and all(re.search(r"[^\W\d_]", rows[i].text) for i in kept[1])
    assert len(kept[1]) >= 0.99 * len(kept[0])
    parts = brute_components([(i, rows[i].text) for i in kept[1]])
    assert kept[2] == {i for i, n, c in parts if i == c or not n}
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {}
    for r in packed.orderBy("doc_id", "piece").collect():
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.length == len(r.ids) // 4
        got.setdefault(r.doc_id, []).extend(np.frombuffer(bytes(r.ids), "<u4").tolist())
    assert got == {i: [*t.encode(rows[i].text, add_special_tokens=False).ids, 0] for i in kept[2]}


def test_run_is_the_chain_of_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    last = stages(spark, docs, tmp_path)[-1]
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select(cols).collect())) == sorted(map(tuple, last.select(cols).collect()))


def test_odd_rows(spark, tmp_path):
    """Nulls, repeated rows, equal ids, empty texts and columns of other names."""
    text = " ".join(f"the word{i} and" for i in range(40))
    rows = [(1, text, "en", "s", None, "x"), (1, text, "en", "s", None, "x"), (2, text + " more", None, None, 3, None), (None, text, "en", "s", 1, "x"),
            (3, None, "en", "s", 1, "x"), (4, "", "en", "s", 1, "x"), (5, "12 34 " * 60, "en", "s", 1, "x"), (6, text[::-1], "en", "s", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    out = stages(spark, docs, tmp_path / "a")
    assert all(d.columns == docs.columns for d in out[:3])
    ids = [sorted((r.doc_id for r in d.collect()), key=str) for d in out]
    assert 3 not in ids[0] and 4 not in ids[0] and 5 not in ids[1]
    assert ids[2].count(1) == 1 and 2 not in ids[2]
    assert stages(spark, docs.limit(0), tmp_path / "b")[-1].count() == 0

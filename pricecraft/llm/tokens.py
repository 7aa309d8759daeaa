"""Token ids by the ``tokenizers`` library, computed once per distinct chunk.

A byte-level tokenizer of this kind starts a new word at every space that a
non-space follows, and looks at nothing before it.  A text is cut there, each
distinct chunk is encoded once per worker (many chunks in one call) and the
ids are cut apart again by the byte lengths of their pieces.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import LONG_KEY, chunk_keys
from .common import text_chunks, worker_store

MEMO_CHUNKS = 1_000_000     # chunks a worker remembers (a cache: results do not depend on it)
LETTERS_END = 0x530         # below it, Unicode versions agree on what a letter is
CALL_CHARS = 10_000         # text given to the tokenizer in one call (longer calls are slower a byte)

_LETTERS = "[" + "".join(re.escape(chr(i)) for i in range(LETTERS_END) if chr(i).isalpha()) + "]+"
_MARKS = r"[!-&(-/:-@\[-`{-~]*"         # ASCII but letters, digits and the apostrophe (which begins words of its own)
#: Chunk keys whose words are plain: letters, marks right after them, and the same again on a next line.
_PLAIN = re.compile(f"({_LETTERS})({_MARKS})(?:\n({_LETTERS})({_MARKS}))?").fullmatch


class Encoder:
    """ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.tok.encode_special_tokens = True       # texts come without them (``WithAdded``)
        vocab = self.tok.get_vocab()
        self.length = np.zeros(max(vocab.values()) + 1, np.int64)
        for piece, i in vocab.items():
            self.length[i] = len(piece)             # one character stands for one byte
        self.memo: dict[str, bytes] = {}
        #: Words as the pattern cuts them, those with a space before them apart.
        self.spaced: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        # what the pattern cuts by a simple rule goes to the library's model by itself, written as its bytes' characters
        self.model = self.tok.model if plain_byte_level(json.loads(tokenizer_json)) else None
        self.to_model = {b: c for c, b in byte_characters().items()}
        self.space = self.to_model[ord(" ")]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _word(self, word: str, before: str = "") -> bytes:
        """ids of one word of the pattern; ``before`` stands in the model's characters."""
        if not word.isascii() or word == "\n":
            word = word.encode().decode("latin-1").translate(self.to_model)
        ids = [t.id for t in self.model.tokenize(before + word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _spaced(self, letters: str) -> bytes:
        v = self.spaced.get(letters)
        if v is None:
            v = self.spaced[letters] = self._word(letters, self.space)
        return v

    def _bare(self, word: str) -> bytes:
        v = self.bare.get(word)
        if v is None:
            v = self.bare[word] = self._word(word)
        return v

    def _learn(self, keys: list[str]) -> None:
        memo, bare, rest = self.memo, self._bare, []
        for d in (self.spaced, self.bare):
            if len(d) > MEMO_CHUNKS:
                d.clear()
        for k in keys:
            m = _PLAIN(k) if self.model and len(k) <= LONG_KEY else None
            if m is None:
                rest.append(k)
                continue
            a, b, c, d = m.groups()
            v = self._spaced(a) if b or c else self._word(a, self.space)
            if b:
                v += bare(b)
            if c:
                v += bare("\n") + bare(c) + (bare(d) if d else b"")
            memo[k] = v
        for k in rest:
            if k[:1] == " ":
                memo[k] = self._ids(k[1:]).tobytes() if len(k) > 1 else b""
        self._encode([k for k in rest if k[:1] != " "], lambda part: self._ids(" " + " ".join(part)))

    def _encode(self, run: list[str], ids_of) -> None:
        """Remember the ids of chunks, each with a space before it, many in a call."""
        at = 0
        while at < len(run):
            size, i = 0, at
            while at < len(run) and size < CALL_CHARS:
                size += len(run[at]) + 1
                at += 1
            part = run[i:at]
            ids = ids_of(part)
            ends = np.cumsum([len(x.encode()) + 1 for x in part])
            cut = (np.searchsorted(np.cumsum(self.length[ids]), ends) + 1) * 4
            raw = ids.tobytes()
            ends = cut.tolist()
            self.memo.update(zip(part, [raw[x:y] for x, y in zip([0, *ends], ends)]))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [chunk_keys(t) if t else () for t in texts]
        if len(self.memo) > MEMO_CHUNKS:            # keep what this slice has: the frequent ones are among it
            self.memo = {k: self.memo[k] for k in set().union(*cut).intersection(self.memo)}
        get, found, new = self.memo.get, [], set()
        for keys in cut:
            ids = list(map(get, keys))
            gaps = [i for i, v in enumerate(ids) if v is None] if None in ids else ()
            new.update([keys[i] for i in gaps])
            found.append((ids, gaps))
        self._learn(list(new))
        for keys, (ids, gaps) in zip(cut, found):
            for i in gaps:
                ids[i] = self.memo[keys[i]]
        for k in new:
            if len(k) > LONG_KEY:                   # the memo is bounded in bytes by its entries
                del self.memo[k]
        return [b"".join(ids) for ids, _ in found]


#: Fixed value: the pattern by which a byte-level pre-tokenizer cuts words.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies:
    printable Latin-1 for itself, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def plain_byte_level(j: dict) -> bool:
    """A byte-level BPE file whose words are cut by ``BYTE_LEVEL_PATTERN`` alone."""
    model, pre = j["model"], j.get("pre_tokenizer") or {}
    return (j.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                                              "byte_fallback", "ignore_merges")))


def merge_ranks(tokenizer_json: str) -> dict[bytes, int] | None:
    """Piece -> id if the file is a plain byte-level BPE whose merges are in
    the order of their ids, so that ids can serve as merge ranks; else None."""
    j = json.loads(tokenizer_json)
    model = j["model"]
    if not plain_byte_level(j):
        return None
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [model["vocab"].get(x + y, -1) for x, y in merges]
    if ids != sorted(set(ids)) or -1 in ids:
        return None
    to_byte = byte_characters()
    ranks = {bytes(to_byte[c] for c in piece): i for piece, i in model["vocab"].items() if all(c in to_byte for c in piece)}
    return ranks if len(ranks) == len(model["vocab"]) and all(bytes([b]) in ranks for b in range(256)) else None


class RankEncoder:
    """The same ids by ``tiktoken``, from the tokenizer file's own vocabulary.

    It is several times faster than ``tokenizers`` on texts with many
    different words; the tests hold one against the other."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken
        self.to_ids = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [self.to_ids(t, disallowed_special=()).astype("<u4").tobytes() if t else b"" for t in texts]


class WithAdded:
    """Added tokens of the file: their strings in a text are one id each, and
    what lies between is encoded by itself, as the library does."""

    def __init__(self, inner: Encoder | RankEncoder, added: list[dict]):
        if odd := [a["content"] for a in added if a.get("lstrip") or a.get("rstrip") or a.get("single_word")]:
            raise ValueError(f"added tokens that take in their surroundings are not supported: {odd}")
        self.inner = inner
        self.ids = {a["content"]: np.array([a["id"]], "<u4").tobytes() for a in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.ids, key=len, reverse=True))) + ")").split

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = {i: self.cut(t) for i, t in enumerate(texts) if t and any(a in t for a in self.ids)}
        if not split:
            return self.inner.encode(texts)
        flat = [p for i, t in enumerate(texts) for p in (split[i][::2] if i in split else [t])]
        found = iter(self.inner.encode(flat))
        out = []
        for i in range(len(texts)):
            parts = split.get(i, [None])
            out.append(b"".join(next(found) if k % 2 == 0 else self.ids[p] for k, p in enumerate(parts)))
        return out


def encoder(tokenizer_json: str, by_ranks: bool = False) -> Encoder | RankEncoder | WithAdded:
    """The worker's encoder for this tokenizer; with ``by_ranks`` the faster
    one where the file allows it."""
    store = worker_store(f"encoder-{by_ranks}-" + hashlib.sha256(tokenizer_json.encode()).hexdigest()[:16])
    if not store:
        ranks = merge_ranks(tokenizer_json) if by_ranks else None
        inner = RankEncoder(ranks) if ranks else Encoder(tokenizer_json)
        added = json.loads(tokenizer_json).get("added_tokens") or []
        store["encoder"] = WithAdded(inner, added) if added else inner
    return store["encoder"]


def encode_batches(batches, tokenizer_json: str, end_id: int | None, max_bytes: int = 2 << 20, by_ranks: bool = False):
    """(slice of the batch, ids of its texts with the end id) in order; the
    text is the last column."""
    enc = encoder(tokenizer_json, by_ranks)
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    for b in batches:
        name = b.schema.names[-1]
        for part in text_chunks(b, max_bytes, column=name):
            yield part, [x + end for x in enc.encode(part.column(part.num_columns - 1).to_pylist())]


def read_tokenizer(docs: DataFrame, tokenizer_file: str):
    """The tokenizer file (a few MB, of fixed size) as a broadcast value."""
    with open(tokenizer_file, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())

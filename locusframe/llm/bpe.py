"""Byte-pair encoding with a merge queue, and decoding.

A word's symbols form a doubly linked list. A priority queue holds the rank
and place of every adjacent pair that the vocabulary merges; the lowest rank
(then the leftmost place) is merged, entries whose symbols have changed since
are skipped, and the new neighbours are queued. Decoding concatenates
vocabulary strings. The vocabulary is a public file, given by its path.

Text is cut as the file says: special tokens as they stand in the raw text,
then NFC, white space to a blank, lower case, then the word pattern.

Defined results
* Null text counts as empty; an empty text has no ids and decodes to "".
* Rows repeat as they come; doc_id may be null; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import body, worker_store

#: Words whose ids are remembered by a Python worker before it starts afresh.
CACHE_WORDS = 400_000
#: Rows handed back to Spark at a time.
OUT_ROWS = 500


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1
    characters stand for themselves, the others for U+0100 onwards."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in set(own))}
    return [chr(rest.get(b, b)) for b in range(256)]


class _Chunks(dict):
    """Ids of the chunks between white space, computed when first met."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[chunk] = ids = self.encode(chunk)
        return ids


class MergeBPE:
    """Encoder and decoder from a tokenizer file's JSON text."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        model = j["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("unk_token"):
            raise ValueError("only plain byte-level BPE files are supported")
        steps = [n["type"] for n in (j["normalizer"] or {}).get("normalizers", [])]
        if steps != ["NFC", "Replace", "Lowercase"] or j["decoder"] is not None:
            raise ValueError(f"normalizer {steps} or decoder not supported")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        v = self.vocab
        self.merge = {(v[a], v[b]): (rank, v[a + b]) for rank, (a, b) in enumerate(merges)}
        self.letter = [v[c] for c in byte_letters()]
        self.last = [v[c + self.suffix] for c in byte_letters()]
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        words = next(p for p in j["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(words["pattern"]["Regex"])
        strings = {i: s for s, i in [*v.items(), *self.special.items()]}
        self.strings = [strings.get(i, "").encode() for i in range(max(strings) + 1)]
        self.cache = _Chunks(self._chunk)

    def merge_word(self, word: str) -> list[int]:
        raw = word.encode()
        n = len(raw)
        ids = [self.letter[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        merge = self.merge
        queue = []
        for i in range(n - 1):
            m = merge.get((ids[i], ids[i + 1]))
            if m:
                queue.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b, new = heapq.heappop(queue)
            k = right[i]
            if ids[i] != a or k >= n or ids[k] != b:
                continue  # stale: one of the two has been merged since
            ids[i], ids[k] = new, -1
            after = right[i] = right[k]
            if after < n:
                left[after] = i
                m = merge.get((new, ids[after]))
                if m:
                    heapq.heappush(queue, (m[0], i, new, ids[after], m[1]))
            before = left[i]
            if before >= 0:
                m = merge.get((ids[before], new))
                if m:
                    heapq.heappush(queue, (m[0], before, ids[before], new, m[1]))
        return [x for x in ids if x >= 0]

    def _chunk(self, chunk: str) -> bytes:
        ids = array("I")
        for word in self.words.findall(chunk):
            ids.extend(self.merge_word(word))
        return ids.tobytes()

    def _plain(self, text: str) -> bytes:
        s = unicodedata.normalize("NFC", text)
        # character by character, a capital sigma has one lower form
        s = "".join(c.lower() for c in s) if "Σ" in s else s.lower()
        # str.split() also cuts at U+001C to U+001F, which are no white space here
        chunks = regex.split(r"\s+", s) if regex.search(r"[\x1c-\x1f]", s) else s.split()
        return b"".join(map(self.cache.__getitem__, chunks))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.special_at is None or not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.special_at.split(text)
        return b"".join(array("I", [self.special[p]]).tobytes() if i % 2 else self._plain(p)
                        for i, p in enumerate(parts))

    def decode(self, ids: bytes) -> bytes:
        """Vocabulary strings, a blank between them: the file names no decoder."""
        return b" ".join(map(self.strings.__getitem__, memoryview(ids).cast("I")))


def load(spec: str) -> MergeBPE:
    """The encoder of this worker process; its word cache serves later tasks."""
    store, key = worker_store("bpe"), hashlib.sha256(spec.encode()).hexdigest()
    if getattr(store, "key", None) != key:
        store.key, store.bpe = key, MergeBPE(spec)
    return store.bpe


def _map(docs: DataFrame, path: str, schema: str, run) -> DataFrame:
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(spec.value)
        for b in it:
            for at in range(0, len(b), OUT_ROWS):
                yield run(bpe, b.iloc[at:at + OUT_ROWS])

    return docs.mapInPandas(batches, schema)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids`` (binary, unsigned 32-bit little-endian)."""
    def run(bpe: MergeBPE, b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": b["doc_id"], "ids": [bpe.encode(t) for t in b["text"]]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _map(docs.select("doc_id", body().alias("text")), path, f"doc_id {kind}, ids binary", run)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and ``decoded`` text."""
    def run(bpe: MergeBPE, b: pd.DataFrame) -> pd.DataFrame:
        return b.assign(decoded=[bpe.decode(i).decode() for i in b["ids"]])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return _map(encoded.select("doc_id", "ids"), path, f"doc_id {kind}, ids binary, decoded string", run)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text."""
    # one pass: a worker process for each of the two steps would hold the tables and word cache twice
    def run(bpe: MergeBPE, b: pd.DataFrame) -> pd.DataFrame:
        ids = [bpe.encode(t) for t in b["text"]]
        return pd.DataFrame({"doc_id": b["doc_id"], "ids": ids, "decoded": [bpe.decode(i).decode() for i in ids]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    both = _map(docs.select("doc_id", body().alias("text")), path, f"doc_id {kind}, ids binary, decoded string", run)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

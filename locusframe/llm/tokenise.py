"""Whole-text token ids of a byte-level BPE tokenizer file.

The file's pattern never lets a token run across the start of a run of white
space, so a text is cut before its blanks, and each piece is encoded once per
worker and remembered. Pieces are encoded by tiktoken from the file's own
vocabulary, whose ids are its merge ranks; texts that hold a special token's
string, or blanks beside other white space, go to the tokenizers library
whole. Both give the ids that the tokenizers library gives for the text.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array

from locusframe.llm.bpe import byte_letters
from locusframe.llm.common import worker_store

#: Pieces remembered by a Python worker before it starts afresh.
CACHE_PIECES = 250_000
#: Fixed value: the word pattern of byte-level BPE files with ``use_regex``.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class _Irregular(Exception):
    """A piece that must not be cut off from what surrounds it."""


class _Pieces(dict):
    def __init__(self, encode, before: str):
        self.encode, self.before = encode, before

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Irregular
        if len(self) > CACHE_PIECES:
            self.clear()
        self[piece] = ids = array("I", self.encode(self.before + piece)).tobytes()
        return ids


class PieceEncoder:
    def __init__(self, spec: str, plain_specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        j = json.loads(spec)
        pre, vocab = j["pre_tokenizer"], j["model"]["vocab"]
        if j["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("only plain byte-level BPE files are supported")
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in j["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("ids must grow with the merge ranks")
        byte = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(byte[c] for c in s): i for s, i in vocab.items()}
        piece = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = plain_specials
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.first, self.rest = (_Pieces(piece.encode_ordinary, before) for before in ("", " "))

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        head, *rest = text.split(" ")
        try:
            return self.first[head] + b"".join(map(self.rest.__getitem__, rest))
        except _Irregular:
            return self.whole(text)


def load(spec: str, plain_specials: bool = False) -> PieceEncoder:
    store, key = worker_store(f"pieces{plain_specials}"), hashlib.sha256(spec.encode()).hexdigest()
    if getattr(store, "key", None) != key:
        store.key, store.encoder = key, PieceEncoder(spec, plain_specials)
    return store.encoder

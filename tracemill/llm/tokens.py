"""Byte-level BPE token ids of whole texts, fast enough for a pass over a corpus.

The vocabulary file is the JSON of the `tokenizers` library; the ids equal what that library
gives with `add_special_tokens=False` (tests compare them): at its defaults with `added`, else
with `encode_special_tokens = True`, which takes added tokens in a text for ordinary text.
Encoding runs on `tiktoken` with the same merges. The split pattern never joins a space with
what stands before it, so a text without two white-space characters in a row is the
concatenation of its space-separated chunks, and a chunk's ids are worked out once. Texts that
hold an added token, and those with a white-space run too long for `tiktoken`, go to the library.
"""

from __future__ import annotations

import json
import re
from functools import cached_property

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

DOUBLE_SPACE, SPACES = re.compile(r"\s\s"), re.compile(r"\s+")
#: White-space characters in a row from which `tiktoken` is not asked; it fails at a million.
LONG_RUN = 100_000


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_symbol() -> dict[str, int]:
    """Vocabulary files write printable Latin-1 bytes as themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Chunks(dict):
    """Ids of a space and a chunk, as little-endian 32-bit integers."""

    #: Entries kept, and the longest chunk kept: about 100 MB in a task.
    ENTRIES, LONGEST = 300_000, 64

    def __init__(self, encoding: tiktoken.Encoding) -> None:
        super().__init__()
        self.encoding = encoding

    def __missing__(self, chunk: str) -> bytes:
        ids = np.array(self.encoding.encode_ordinary(" " + chunk), "<u4").tobytes()
        if len(chunk) <= self.LONGEST:
            if len(self) >= self.ENTRIES:
                self.clear()
            self[chunk] = ids
        return ids


class TokenEncoder:
    _loaded: dict[tuple[str, bool], TokenEncoder] = {}

    def __init__(self, path: str, added: bool = False) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec["added_tokens"]}
        symbols = _byte_of_symbol()
        ranks = {
            bytes(symbols[c] for c in token): rank for token, rank in spec["model"]["vocab"].items() if token not in special
        }
        self.encoding = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.chunks = Chunks(self.encoding)
        self.path, self.keeps_added = path, added
        # The library takes only special ones for ordinary text.
        own = [t["content"] for t in spec["added_tokens"] if added or not t.get("special")]
        self.added = re.compile("|".join(map(re.escape, own))) if own else None
        #: UTF-8 bytes of each token
        self.sizes = np.zeros(max([*ranks.values(), *(t["id"] for t in spec["added_tokens"])]) + 1, np.int64)
        for token in spec["added_tokens"]:
            self.sizes[token["id"]] = len(token["content"].encode())
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    @cached_property
    def library(self) -> Tokenizer:
        """Loaded with the first text that needs it, which most tasks never see."""
        library = Tokenizer.from_file(self.path)
        library.encode_special_tokens = not self.keeps_added
        return library

    @classmethod
    def load(cls, path: str, added: bool = False) -> TokenEncoder:
        """One encoder a Python worker, kept from task to task."""
        if (path, added) not in cls._loaded:
            cls._loaded[path, added] = cls(path, added)
        return cls._loaded[path, added]

    def by_library(self, text: str) -> bool:
        if self.added and self.added.search(text):
            return True
        return len(text) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in SPACES.finditer(text))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if self.by_library(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if DOUBLE_SPACE.search(text):
            return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        head = np.array(self.encoding.encode_ordinary(first), "<u4").tobytes()
        return head + b"".join(map(self.chunks.__getitem__, rest))

"""Exact token ids of whole texts for a tokenizers file.

Byte-level BPE files whose ids are the ranks of their merges are also run by tiktoken, which is built here from the same
file and is about three times as fast. The two split alike where Unicode tables can't differ; texts with other characters,
with the string of a special token, or with very long white space go to the tokenizers library. The tests hold both against the library.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np

#: Latin letters, ASCII controls but separators, and general punctuation: of settled category in every Unicode version.
UNSETTLED = re.compile("[^\x00-\x1b\x20-ɏ‐-‧‰-⁞]")
LONG_BLANK = 1 << 14  # white space in a row from which tiktoken's matcher is not used: its stack grows with it
BLANKS = re.compile(r"\s{64,}+")
#: Fixed value: the pre-tokenizer pattern that the byte-level kind stands for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next from 256 on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


def fast_encoding(spec: dict):
    """A tiktoken encoding with the same ids, or None if the file is of another kind."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    if not plain or model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    vocab, letters = model["vocab"], byte_letters()
    if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    import tiktoken

    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def long_blank(text: str) -> bool:
    return len(text) >= LONG_BLANK and any(m.end() - m.start() >= LONG_BLANK for m in BLANKS.finditer(text))


class Encoder:
    """Texts to ids, as lists or arrays of unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.fast = fast_encoding(spec)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    @cached_property
    def library(self):
        """Loaded when a text first needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def lists(self, texts: list[str]) -> Iterator[list[int]]:
        for t in texts:
            if self.fast is None or UNSETTLED.search(t) or any(s in t for s in self.special) or long_blank(t):
                yield self.library.encode(t, add_special_tokens=False).ids
            else:
                yield self.fast.encode_ordinary(t)

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        for ids in self.lists(texts):
            yield np.asarray(ids, "<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python worker, which lives on from task to task."""
    return Encoder(path)

"""Exact tokenisation: token ids, and token counts by way of pre-tokens.

A BPE vocabulary encodes each pre-token by itself, so a text has as many
tokens as its pre-tokens have together. Texts without ``UNSAFE`` characters
and special strings are cut with Python's ``re`` by the library's own rules,
which on these characters read the same; any other text goes to the library
whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

BYTE_RANKS, WORD_BPE = "byte_bpe_50k.tiktoken", "word_bpe_49k.json"
END_OF_TEXT = {"<|endoftext|>": 50256}  # fixed value: the byte vocabulary's special string
CACHE_ENTRIES = 300_000  # pre-tokens a worker remembers; beyond it the cache starts anew

# The character class and cutting rule of the word vocabulary, without UNSAFE characters.
_LETTER = "A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-ſ"
UNSAFE = re.compile(rf"[^\x20-\x7e\t\n\r{_LETTER}]")
RULE = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_LETTER}]+|[0-9]|[^\s{_LETTER}0-9]+")


@lru_cache(maxsize=4)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def byte_encoding(path: str):
    """The byte-level vocabulary from its file of ranks. It gives the ids of the .json file several times faster."""
    import base64

    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=END_OF_TEXT)


def token_ids(path: str, text: str) -> np.ndarray:
    """uint32 ids; special strings inside the text are special tokens, as by the library's default.

    The encoder of the rank file gives up on some very long runs, such as a million blanks; the library, with the
    same vocabulary as .json beside it, then reads the text.
    """
    try:
        return byte_encoding(path).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        whole = library(os.path.splitext(path)[0] + ".json").encode(text, add_special_tokens=False)
        return np.array(whole.ids, np.uint32)


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Cutter:
    """Pre-tokens of a text, or None where the library must read it whole."""

    def __init__(self, path: str):
        self.tokenizer = library(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.own_rule = os.path.basename(path) == WORD_BPE

    def parts(self, text: str) -> list[str] | None:
        if not self.own_rule or UNSAFE.search(text) or any(x in text for x in self.special):
            return None
        return RULE.findall(text.lower())


class LengthCache:
    """Token counts of texts: a fixed table of frequent pre-tokens, then a bounded cache for the rest."""

    def __init__(self, path: str, frequent: dict[str, int], limit: int = CACHE_ENTRIES):
        self.cut, self.frequent, self.limit = Cutter(path), frequent, limit
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        tok, frequent = self.cut.tokenizer, self.frequent
        if len(self.known) > self.limit:
            self.known.clear()
        known = self.known
        hits, misses = [], []
        for t in texts:
            ps = self.cut.parts(t)
            if ps is None:
                hits.append(len(tok.encode(t, add_special_tokens=False).ids))
                misses.append(())
                continue
            found = [frequent.get(p, 0) for p in ps]  # every pre-token has at least one token
            hits.append(sum(found))
            misses.append([p for p, n in zip(ps, found) if not n])
        new = list({p for ps in misses for p in ps} - known.keys())
        for p, e in zip(new, tok.encode_batch_fast(new, add_special_tokens=False)):
            known[p] = len(e.ids)
        return [h + sum([known[p] for p in ps]) for h, ps in zip(hits, misses)]


def runs(texts, limit: int = 1 << 20):
    """Consecutive texts (null: empty) in lists of about ``limit`` characters."""
    own, size = [], 0
    for t in texts:
        own.append(t or "")
        size += len(own[-1])
        if size >= limit:
            yield own
            own, size = [], 0
    if own:
        yield own

"""Token ids of a byte-level vocabulary as Hugging Face's `tokenizers` gives them, by way of the faster `tiktoken`.

Both read the same vocabulary; the tests hold the ids to be the same. `tiktoken` gives up on texts with very long runs of
white space, between half a million and a million blanks; texts with runs of `RUN` go to `tokenizers` itself, which takes
time in proportion to them.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: The one special token of the vocabulary.
SPECIAL = {"<|endoftext|>": 50256}


RUN = 50_000
_RUN = re.compile(r"\s{%d}" % RUN)


def _too_blank(text: str) -> bool:
    return len(text) >= RUN and _RUN.search(text) is not None


def place(name: str) -> str:
    """`name`: a file of public_tokenizers, or a path."""
    return name if "/" in name else public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoding(ranks: str = "byte_bpe_50k.tiktoken") -> tiktoken.Encoding:
    """`ranks`: a file of public_tokenizers, or a path."""
    with open(place(ranks), "rb") as f:
        pairs = [line.split() for line in f]
    return tiktoken.Encoding(
        "byte_bpe",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs},
        special_tokens=SPECIAL,
    )


@lru_cache(maxsize=4)
def tokenizer(vocabulary: str = "byte_bpe_50k.json", special: bool = False) -> Tokenizer:
    """The vocabulary's own tokenizer; with `special`, what is a special token's string in a text becomes that token."""
    made = Tokenizer.from_file(place(vocabulary))
    made.encode_special_tokens = not special
    return made


def _json(ranks: str) -> str:
    return ranks.removesuffix(".tiktoken") + ".json"


def ids(text: str, ranks: str = "byte_bpe_50k.tiktoken") -> np.ndarray:
    """Ids of a text; what a special token's string is in it becomes that token, which is the default of the file."""
    if _too_blank(text):
        return np.array(tokenizer(_json(ranks), True).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.array(encoding(ranks).encode(text, allowed_special="all"), np.uint32)


def plain_ids(text: str, ranks: str = "byte_bpe_50k.tiktoken") -> list[int]:
    """Ids of a text in which special tokens' strings are plain text."""
    if _too_blank(text):
        return tokenizer(_json(ranks)).encode(text, add_special_tokens=False).ids
    return encoding(ranks).encode_ordinary(text)


def plain_ids_of(text: str, vocabulary: str) -> list[int]:
    """The same by the tokenizer's own file; its ranks are used where they lie beside it."""
    ranks = vocabulary.removesuffix(".json") + ".tiktoken"
    if os.path.exists(place(ranks)):
        return plain_ids(text, ranks)
    return tokenizer(vocabulary).encode(text, add_special_tokens=False).ids

"""Token ids of whole texts, encoded in Arrow batches on the executors.

The byte-level vocabulary is read from its rank file; the added tokens of the JSON tokenizer of the
same name beside it, where there is one, keep their own ids inside a text, as that tokenizer encodes
them in its default setting. A null text encodes as an empty one.
"""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken


def default_ranks() -> str:
    """Path of the rank file that belongs to byte_bpe_50k.json."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    added = {}
    if os.path.exists(beside := f"{os.path.splitext(path)[0]}.json"):
        with open(beside, encoding="utf-8") as f:
            added = {x["content"]: x["id"] for x in json.load(f).get("added_tokens", [])}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


def encode(text: str | None, path: str, end: int) -> np.ndarray:
    """ids of text and the end id, as unsigned 32-bit numbers."""
    ids = encoder(path).encode_to_numpy(text or "", allowed_special="all")
    return np.append(ids.astype("<u4", copy=False), np.uint32(end))

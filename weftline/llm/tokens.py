"""Byte-level BPE ids of whole texts."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

END_OF_TEXT = "<|endoftext|>"  # the one added token; its id follows the vocabulary's
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Ids of the `tokenizers` library for the same vocabulary.

    encode(text) reads the text of an added token as plain text, encode_added(text) as the token's id, which is the
    library's default; neither adds tokens that the text doesn't hold.
    """

    def __init__(self, path: str = BYTE_BPE):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)})
        self.n_vocab = len(ranks)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.bpe.encode_ordinary(text), np.uint32)

    def encode_added(self, text: str) -> np.ndarray:
        return np.array(self.bpe.encode(text, allowed_special={END_OF_TEXT}), np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str = BYTE_BPE) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)

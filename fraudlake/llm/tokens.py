"""Token ids of the byte-level vocabulary, the same as by the tokenizers library.

Encoding uses the vocabulary's file of ranks with tiktoken, which gives the ids of the JSON file
several times faster; the tests hold the two against each other. With
`added`, the JSON file's added token END_OF_TEXT is matched inside a text before anything else, as
that library does by default; without, it is ordinary text (the library's encode_special_tokens).
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import tiktoken

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PART_CHARS = 1 << 16
END_OF_TEXT = "<|endoftext|>"
END_OF_TEXT_ID = 50256


@functools.cache
def encoder(ranks_path: str = RANKS) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART_CHARS):
    """The text in parts of about size characters, cut only where tokens end in any case.

    That is before a single space between two characters that are not white space. A text without
    such a place goes on to the next one.
    """
    start = 0
    while len(text) - start > size:
        cut = start + size
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or (cut + 1 < len(text) and not text[cut - 1].isspace() and not text[cut + 1].isspace()):
                break
            cut += 1
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def _encoded(text: str, ranks_path: str, added: bool) -> Iterator[list[int]]:
    """The ids of one part after the other."""
    encode = encoder(ranks_path).encode_ordinary
    for k, between in enumerate(text.split(END_OF_TEXT) if added else [text]):
        if k:
            yield [END_OF_TEXT_ID]
        for part in parts(between):
            yield encode(part)


def token_ids(text: str, ranks_path: str = RANKS, added: bool = False) -> np.ndarray:
    """Ids of the whole text as unsigned 32-bit integers; memory beyond the ids is that of one part."""
    found = [np.array(ids, dtype=np.uint32) for ids in _encoded(text, ranks_path, added)]
    return found[0] if len(found) == 1 else np.concatenate(found)


def token_count(text: str, ranks_path: str = RANKS, added: bool = False) -> int:
    return sum(map(len, _encoded(text, ranks_path, added)))

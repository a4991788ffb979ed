"""Token ids of whole texts with a public byte-level BPE vocabulary.

The ids are those that ``tokenizers`` gives with ``byte_bpe_50k.json`` (tested
against it); they are computed with ``tiktoken`` from the same vocabulary's rank
file, three to four times as fast here. The strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

END_ID = 1
#: White space runs beyond this may exceed the pattern engine's backtracking; they
#: are rare, and such texts are read with ``tokenizers`` itself.
LONG_SPACE = 100_000


@lru_cache(maxsize=2)
def rank_encoder(name: str = "byte_bpe_50k.tiktoken") -> tiktoken.Encoding:
    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@lru_cache(maxsize=2)
def file_encoder(name: str = "byte_bpe_50k.json"):
    from tokenizers import Tokenizer
    found = Tokenizer.from_file(public_tokenizers.path(name))
    found.encode_special_tokens = True
    return found


def ids_of(text: str | None, end_id: int = END_ID) -> np.ndarray:
    """Ids of a whole text (null: empty), with the end id behind them."""
    text = text or ""
    if len(text) > LONG_SPACE and max((len(x) for x in _spaces(text)), default=0) > LONG_SPACE:
        ids = file_encoder().encode(text, add_special_tokens=False).ids
    else:
        ids = rank_encoder().encode_ordinary(text)
    out = np.empty(len(ids) + 1, np.uint32)
    out[:-1] = ids
    out[-1] = end_id
    return out


def _spaces(text: str):
    import re
    return (m.group() for m in re.finditer(r"\s{1000,}", text))

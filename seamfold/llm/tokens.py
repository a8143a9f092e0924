"""Token ids of texts under a byte-level BPE vocabulary file."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

#: The default vocabulary; its rank file holds the same one.
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Texts of these characters only are split alike by both libraries' pattern engines.
PLAIN = re.compile(r"[\t\n\x20-\x7e¡-¬®-±´-¸»¿-ɏ]*")


class Encoder:
    """ids(text): what the tokenizers library gives for the vocabulary file, without adding special tokens.

    A special token's string within a text is that token. Plain texts without such a string go
    through the rank file of the same vocabulary, where there is one, which is faster; all
    others through the library itself.
    """

    def __init__(self, path: str | None = None) -> None:
        import public_tokenizers
        import tokenizers

        self.slow = tokenizers.Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if path is None:
            import tiktoken

            with open(public_tokenizers.path(RANKS), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        if self.fast is not None and PLAIN.fullmatch(text) and not any(t in text for t in self.special):
            return self.fast.encode_to_numpy(text).astype("<u4")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=4)
def encoder(path: str | None = None) -> Encoder:
    return Encoder(path)

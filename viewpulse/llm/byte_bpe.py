"""Token ids of a byte-level BPE file of the tokenizers library, by tiktoken's faster merge loop.

The rank table is built from the file's own vocabulary, whose ids are in
merge order.  Texts that hold the string of a special token go to the tokenizers library.
"""

from __future__ import annotations

import json
from array import array

import tiktoken
from tokenizers import Tokenizer


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write bytes as printable characters: those that print stand for themselves, the others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path) as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if any(s in text for s in self.special):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranks.encode_ordinary(text)
        return array("I", ids).tobytes()

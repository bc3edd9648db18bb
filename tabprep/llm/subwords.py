"""Subword ids of public tokenizers, with a cache of white-space separated pieces."""

from __future__ import annotations

import base64
import re

# White space stays with the word after it; what is left is white space at the end.
_PIECE = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
#: Other white space may join the run before it, so texts that hold any are encoded in one go.
_OTHER_SPACE = re.compile("[\x85\xa0  -     　]")

_encoders: dict[tuple, SubwordEncoder] = {}


class SubwordEncoder(dict):
    """Maps pieces of text to their ids as little-endian unsigned 32-bit bytes.

    Pre-tokenizing never looks across a boundary between a word and ASCII white space, so the
    ids of a text are those of its pieces in order. The dictionary forgets all once it holds
    ``limit`` pieces; that bounds memory and changes nothing else.
    """

    def __init__(self, ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...], limit: int):
        import numpy as np
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encode = tiktoken.Encoding(
            "pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._limit = limit
        self._special = {token: np.array([number], dtype="<u4").tobytes() for token, number in special}
        longest_first = sorted(self._special, key=len, reverse=True)
        self._at_special = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if special else None

    def __missing__(self, piece: str) -> bytes:
        import numpy as np

        found = np.array(self._encode(piece), dtype="<u4").tobytes()
        if len(piece) < 64:
            if len(self) >= self._limit:
                self.clear()
            self[piece] = found
        return found

    def ids(self, text: str) -> bytes:
        if self._at_special and self._at_special.search(text):
            parts = self._at_special.split(text)
            return b"".join(self._special[p] if k % 2 else self._ordinary(p) for k, p in enumerate(parts))
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        if _OTHER_SPACE.search(text):
            return self.__missing__(text)
        return b"".join(map(self.__getitem__, _PIECE.findall(text)))


def encoder(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...] = (), limit: int = 400_000) -> SubwordEncoder:
    """One encoder per Python worker and vocabulary, kept from task to task."""
    key = (ranks_path, special)
    if key not in _encoders:
        _encoders[key] = SubwordEncoder(ranks_path, pattern, special, limit)
    return _encoders[key]


def byte_bpe() -> tuple[str, str]:
    """(path of ranks, pattern) of the 50k byte-level BPE; its ids equal those of ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def byte_bpe_special() -> tuple[tuple[str, int], ...]:
    """The added tokens of ``byte_bpe_50k.json``: where a text spells one, it is that one id."""
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return tuple((t["content"], t["id"]) for t in json.load(file)["added_tokens"])

"""Token ids of whole texts with a public byte-level BPE, inside Spark tasks.

The ids are those of ``tokenizers`` (``add_special_tokens=False``) with the named vocabulary file. Most
texts are split where byte-level BPE must split anyway (before a space that is followed by a word and
is not the inside of a longer run of white space), and each such chunk is encoded once per task
process and looked up afterwards. New chunks go through ``tiktoken`` with the same vocabulary when a
probe shows that both agree; texts that name the special token go through ``tokenizers`` whole.
"""

from __future__ import annotations

import base64
import os
import re
import struct

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"
#: Chunks that a process remembers of each kind (about 200 bytes each); later new ones are encoded each time.
REMEMBERED = 200_000

#: White space other than blank, line feed, tab and return; the ASCII ones first.
_RARE_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n\t\r"]
_RARE_ASCII = [c for c in _RARE_SPACE if c.isascii()]
_BEFORE_WORD = re.compile(r"(?= \S)")
_PROBE = "It's the 1st test,  isn't it?\n\n Süß\tnaïve ñandú x  \n 12345 %%% done "


def resolve(name: str) -> str:
    """A path as it is; a bare name is a file of the public tokenizers."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _as_bytes(ids: list[int]) -> bytes:
    """Unsigned 32-bit little-endian, quicker for a few ids than an array library."""
    return struct.pack(f"<{len(ids)}I", *ids)


class _Chunks(dict):
    """chunk -> its ids as unsigned 32-bit bytes; ``lead`` is put in front of a chunk before encoding."""

    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, chunk: str) -> bytes:
        ids = _as_bytes(self.encode(self.lead + chunk)) if self.lead or chunk else b""
        if len(self) < REMEMBERED:
            self[chunk] = ids
        return ids


class Encoder:
    def __init__(self, vocabulary: str = VOCABULARY, ranks: str | None = RANKS):
        import tokenizers

        self.full = tokenizers.Tokenizer.from_file(resolve(vocabulary))
        encode = self._whole
        if ranks:
            fast = self._ranked(resolve(ranks))
            if fast(_PROBE) == self._whole(_PROBE):
                encode = fast
        self.spaced, self.plain = _Chunks(encode, " "), _Chunks(encode, "")

    def _whole(self, text: str) -> list[int]:
        return self.full.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _ranked(path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        """Ids of the text, four little-endian bytes each."""
        if SPECIAL in text:
            return _as_bytes(self._whole(text))
        if "  " in text or "\n " in text or "\t " in text or "\r " in text or any(c in text for c in (_RARE_ASCII if text.isascii() else _RARE_SPACE)):
            return b"".join(map(self.plain.__getitem__, _BEFORE_WORD.split(text)))
        first, *rest = text.split(" ")
        return self.plain[first] + b"".join(map(self.spaced.__getitem__, rest))


_encoders: dict[tuple, Encoder] = {}


def encoder(vocabulary: str = VOCABULARY, ranks: str | None = RANKS) -> Encoder:
    """One encoder per task process and vocabulary."""
    key = (vocabulary, ranks)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def piece_sizes(n: int, width: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids: whole widths, the first piece takes the remainder."""
    first = n % width
    return ([first] if first else []) + [width] * (n // width)

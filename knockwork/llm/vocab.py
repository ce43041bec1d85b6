"""Vocabulary files of public tokenizers, read on the driver and sent to the workers.

A file's place is a parameter. Its size is checked before it is broadcast.
"""

from __future__ import annotations

import base64
import json
from pathlib import Path

#: Most bytes of a vocabulary file that is broadcast.
MAX_BYTES = 32 << 20


def read(path: str) -> bytes:
    data = Path(path).read_bytes()
    if len(data) > MAX_BYTES:
        raise ValueError(f"{path} has {len(data)} bytes; a vocabulary of at most {MAX_BYTES} can be broadcast")
    return data


def ranks(data: bytes) -> dict[bytes, int]:
    """The tokens of a rank file, one 'base64 rank' a line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def word_bpe(data: bytes) -> tuple[dict[tuple[str, str], tuple[int, str]], tuple[str, ...], str]:
    """Pair ranks, strings that stand for one token wherever they occur, and the word end of a JSON vocabulary."""
    spec = json.loads(data)
    model = spec["model"]
    pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
    specials = tuple(t["content"] for t in spec["added_tokens"] if t["special"])
    return {p: (i, p[0] + p[1]) for i, p in enumerate(pairs)}, specials, model["end_of_word_suffix"] or ""


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself if it prints, else the next from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}

"""Byte-level pair encoding with the vocabulary file of a public tokenizer."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache

# The split pattern of the byte-level vocabulary.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

LONG_RUN = 100_000
BLANKS = re.compile(rf"(?<!\s)[ \t\n\r]{{{LONG_RUN},}}(?!\s)")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def byte_level_encoding(vocabulary: str):
    """The encoding of a vocabulary file. Ranks are the ids, since the file lists the single
    bytes and then the merges in order."""
    import tiktoken

    with open(vocabulary, encoding="utf-8") as handle:
        data = json.load(handle)
    special = {t["content"]: t["id"] for t in data.get("added_tokens", ())}
    letters = byte_alphabet()
    ranks = {bytes(letters[c] for c in piece): rank
             for piece, rank in data["model"]["vocab"].items() if piece not in special}
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks,
                             special_tokens=special)


def _by_runs(encoding, encode: Callable[[str], list[int]]) -> Callable[[str], list[int]]:
    """``encode`` for texts with blank runs too long for the library's matcher.

    Such a run is one pre-token, without its last character if more text follows.
    """
    def whole(text: str) -> list[int]:
        if len(text) < LONG_RUN:
            return encode(text)
        out, at = [], 0
        for run in BLANKS.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += encode(text[at:run.start()])
            out += encoding._encode_single_piece(text[run.start():end])
            at = end
        return out + encode(text[at:])

    return whole


def byte_level_encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """Text to ids. The ids are those of the tokenizers library for the same file: the string of
    a special token in a text is that token."""
    encoding = byte_level_encoding(vocabulary)
    special = encoding.special_tokens_set
    return _by_runs(encoding, lambda text: encoding.encode(text, allowed_special=special))


def plain_byte_level_encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """As ``byte_level_encoder``, but strings of special tokens are ordinary text."""
    encoding = byte_level_encoding(vocabulary)
    return _by_runs(encoding, encoding.encode_ordinary)

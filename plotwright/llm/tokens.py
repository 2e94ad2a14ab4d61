"""Exact byte-level BPE ids, one chunk at a time.

A text's ids are the joined ids of its space-led chunks, so each worker keeps a bounded memory of chunks it has met and asks
the slow encoder only for new ones.  Texts that cannot be cut so, or that hold characters which Unicode versions class
differently, go through the tokenizers library whole.
"""

from __future__ import annotations

import functools
import os
import re
import sys
import unicodedata
from collections.abc import Callable

import regex

# The pre-token pattern of byte-level BPE vocabularies (ids must equal the tokenizers library's).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Chunks that a worker remembers before it forgets all of them: memory only, results never depend on it.
REMEMBERED = 400_000
#: Longer chunks are not remembered.
LONG = 256


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@functools.cache
def doubtful() -> re.Pattern:
    """Characters that were not assigned in Unicode 3.2: libraries of different Unicode versions may class them differently."""
    old, ranges, start = unicodedata.ucd_3_2_0, [], None
    for c in range(128, sys.maxunicode + 2):
        new = c <= sys.maxunicode and old.category(chr(c)) == "Cn"
        if new and start is None:
            start = c
        elif not new and start is not None:
            ranges.append(f"{re.escape(chr(start))}-{re.escape(chr(c - 1))}")
            start = None
    return re.compile("[" + "".join(ranges) + "]")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 as itself, the rest from U+0100 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def in_doubt(text: str) -> bool:
    """Whether a text holds a doubtful character."""
    try:
        text.encode("latin-1")  # all of Latin-1 is old; the usual case, and quick
    except UnicodeEncodeError:
        return doubtful().search(text) is not None
    return False


class Pieces(dict):
    """Chunk -> what ``make`` says of it, remembered within bounds."""

    def __init__(self, make: Callable[[str], object]):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str):
        value = self.make(piece)
        if len(piece) <= LONG:
            self[piece] = value
        return value

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()


#: White space, a space, and more white space or the end: there a space does not simply belong to the chunk behind it.
UNEVEN_SPACE = re.compile(r"\s (?=\s|\Z)")


def chunks(text: str, specials: tuple[str, ...] = ("<|endoftext|>",)) -> list[str] | None:
    """Parts of a text whose ids, joined, are the text's ids; each but the first begins with the space before it.

    None: the text holds a special token, an uneven run of white space or a doubtful character and must be encoded whole.
    """
    if any(s in text for s in specials) or UNEVEN_SPACE.search(text) or in_doubt(text):
        return None
    first, *rest = text.split(" ")
    return [first, *[f" {r}" for r in rest]]


find_pieces = regex.compile(PRE_TOKEN).findall

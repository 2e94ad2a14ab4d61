"""BPE encoding and decoding by dynamic programming over prefixes (operator 6).

The ids of a piece are those of its longest prefixes: for every prefix there is exactly one token that can end its encoding.
An automaton over the vocabulary's suffix links lists, at every position, the tokens that end there; the one that may follow
the last token of the prefix before it is stored, and back-pointers give the ids.

Whether token ``b`` may follow token ``a`` is read from their merge trees: while pairs are merged in rank order, the symbol at
the right edge of ``a`` and the one at the left edge of ``b`` exist side by side for a while; if a merge of the two is ranked
before the end of either (for the left one: strictly before, as equal merges run from the left), it would cross the border.

Null text counts as empty (no ids).  Repeated rows and rows of one id are encoded each; a null id is kept.  Very long texts are
encoded whole, in memory in proportion to the longest piece.  Of several tokens that could end a prefix only one passes the pair
test, so there are no ties.  Extra columns, also ones whose names clash, are ignored.  Empty table: no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import only
from .tokens import LONG, Pieces, byte_letters, chunks, default_tokenizer, find_pieces, in_doubt, library

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Remembered answers of the pair test; memory only.
PAIRS = 1_000_000


class PrefixCoder:
    """Encodes pieces (pre-tokens) and decodes ids of one byte-level BPE vocabulary."""

    def __init__(self, path: str):
        import ahocorasick

        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        letter = byte_letters()
        raw = lambda s: bytes(letter[c] for c in s)
        vocab = {raw(s): i for s, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in vocab.items()}
        self.bytes_of |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = (raw(x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.rank[a, b] = rank
            self.halves.setdefault(whole, (rank, a, b))
        self.automaton = ahocorasick.Automaton()
        for b, i in vocab.items():
            self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.edges: dict[tuple[int, bool], tuple[tuple[int, int], ...]] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    def edge(self, token: int, right: bool) -> tuple[tuple[int, int], ...]:
        """The symbols that stand at a token's right or left edge as it is merged: (symbol, rank of the merge that ends it)."""
        if (known := self.edges.get((token, right))) is None:
            known = ((token, len(self.rank)),)
            if token in self.halves:
                rank, a, b = self.halves[token]
                below = self.edge(b if right else a, right)
                known += ((below[0][0], rank), *below[1:])
            self.edges[token, right] = known
        return known

    def may_follow(self, a: int, b: int) -> bool:
        if (known := self.fits.get((a, b))) is None:
            if len(self.fits) > PAIRS:
                self.fits.clear()
            rank, lefts = self.rank.get, self.edge(b, False)
            known = not any(
                (r := rank((x, y))) is not None and r < x_ends and r <= y_ends
                for x, x_ends in self.edge(a, True)
                for y, y_ends in lefts
            )
            self.fits[a, b] = known
        return known

    def encode_piece(self, piece: str) -> list[int]:
        text = piece.encode().decode("latin-1")
        last: list[int] = [-1] * (len(text) + 1)
        size: list[int] = [0] * (len(text) + 1)
        known = self.fits.get
        for at, (n, token) in self.automaton.iter(text):
            end = at + 1
            if last[end] >= 0:  # of the tokens that end here, only one can be right
                continue
            if end == n:
                last[end], size[end] = token, n
            elif (a := last[end - n]) >= 0 and (fits if (fits := known((a, token))) is not None else self.may_follow(a, token)):
                last[end], size[end] = token, n
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def encode(self, text: str) -> list[int]:
        return [i for p in find_pieces(text) for i in self.encode_piece(p)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.cache
def coder(path: str) -> PrefixCoder:
    return PrefixCoder(path)


@functools.cache
def _memory(path: str) -> Pieces:
    c = coder(path)

    def encoded(piece: str) -> tuple[str, bytes]:
        ids = c.encode_piece(piece)
        return ",".join(map(str, ids)), b"".join(map(c.bytes_of.__getitem__, ids))

    def make(chunk: str) -> tuple[str, bytes]:
        pieces.trim()
        got = [pieces[p] for p in find_pieces(chunk)]
        return ",".join([g[0] for g in got]), b"".join([g[1] for g in got])

    pieces = Pieces(encoded)
    return Pieces(make)


def digest(text: str | None, path: str) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded text."""
    memory = _memory(path)
    memory.trim()
    parts = chunks(text or "")
    if parts is None:
        c = coder(path)
        specials = {t.content: i for i, t in library(path).get_added_tokens_decoder().items()}
        ids = whole(text, c, specials, path)
        said, decoded = ",".join(map(str, ids)), c.decode(ids)
    else:
        got = [memory[p] for p in parts if p]
        said = ",".join([g[0] for g in got])
        decoded = b"".join([g[1] for g in got]).decode("utf-8", "replace")
    n = said.count(",") + 1 if said else 0
    return n, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def whole(text: str, c: PrefixCoder, specials: dict[str, int], path: str) -> list[int]:
    """Ids of a text with special tokens or odd white space; the library only cuts it into pieces where classes are in doubt."""
    import regex

    cut = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")")
    pre, ids = library(path).pre_tokenizer, []
    letter = byte_letters()
    memory: dict[str, list[int]] = {}
    for part in cut.split(text):
        if part in specials:
            ids.append(specials[part])
            continue
        if in_doubt(part):
            pieces = [bytes(letter[x] for x in p).decode() for p, _ in pre.pre_tokenize_str(part)]
        else:
            pieces = find_pieces(part)
        for p in pieces:
            if len(p) > LONG:
                ids += c.encode_piece(p)
            else:
                if p not in memory:
                    memory[p] = c.encode_piece(p)
                ids += memory[p]
    return ids


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs`` (doc_id, text)."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [digest(t, path) for t in map(str_or_none, batch.column(1))]
            cols = list(zip(*got, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return only(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def str_or_none(value: pa.Scalar) -> str | None:
    return value.as_py()

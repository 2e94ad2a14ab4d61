"""LM scoring by online logistic context mixing over whole texts (operator 9).

A text is lower-cased (A-Z), cut into words at ASCII white space, and closed by one end token.  The model spells every token byte
by byte and bit by bit, given the tokens before it.  Hashed contexts each predict the next bit from counts: the last one to four
bytes (which reach into the word before), the token's whole beginning, and that beginning together with the end of the word
before.  Weights chosen by a gate mix their logits, and an adaptive map refines the mix.  A document's own words so far then
predict its next one as well, with a share that follows how often the document has repeated itself up to there; so every text is
learned as it is read.  All of it is a product of proper distributions over the next token.

A token's first ``OPEN`` bytes are its opening; contexts reach across the border between words there and nowhere else.  What comes
behind the opening depends on the word alone.  Openings are scored once for each different (last ``TAIL`` bytes of the word
before, opening) of a block of documents, the rest once for each different word of the corpus.

How it is learned, all from the whole training part (ids whose CRC-32 modulo ten is not zero):

1. Each task codes its documents over dictionaries of at most ``BLOCK_WORDS`` words ("blocks") and writes both, and counts the
   block's openings; texts are read and cut once and never shuffled.
2. Dictionaries are summed to corpus-wide counts of every word, and openings to theirs: tables that grow with the corpus.
3. Words in order are cut into groups in front of every word whose hash ``GROUP_WORDS`` divides, so groups depend on the words
   alone.  A beginning's words lie side by side, so a group counts its whole beginnings itself, exactly; those of a group's first
   and last word are summed over all groups and sent out (about a kilobyte a group).  Openings are dealt to shares by hash.
4. Bit counts of the hashed contexts are summed over all words and openings as whole numbers.  Their tables get ``ROOM`` slots for
   each different context and next byte, as estimated by sketches, within the sizes of ``TABLES``; beyond the largest, which
   bounds what is broadcast to about 45 MB, contexts share slots.  Two bytes a slot are broadcast.
5. Weights are learned online within each group and share, in hash order, every byte predicted as if it had not been counted
   itself; they are averaged by how often each gate was met, in whole numbers, as are the adaptive map's counts.
6. Words go back to their blocks with count and score, where documents add them up.

Nothing depends on partitions, tasks or the order of files (but for the last digits of sums).  Of a token only the first ``HEAD``
bytes have whole beginnings; very long tokens are scored to their end by the last four bytes, in pieces of ``STEP`` bytes, so
memory does not grow with them.

Null text is empty: the end token alone.  A null doc_id counts as the empty text (held out).  Repeated rows count and are scored
each.  Extra columns, also ones whose names clash, are ignored.  Empty table: no rows.  With nothing to learn from every count is
zero and bits are even.
"""

from __future__ import annotations

import bisect
import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import only, written

END, SPACE = b"\n", b" "
#: A block's dictionary is closed at this many words, or its documents at this many tokens.
BLOCK_WORDS, BLOCK_TOKENS = 400_000, 6_000_000
#: Bytes of a token's opening, of the word before that it sees, and of a token that have whole beginnings.
OPEN, TAIL, HEAD = 3, 3, 32
#: Hashed tables and their least and greatest sizes, as powers of two: last one to four bytes, opening behind a word's end, opening.
TABLES = (("last 1", 16, 20), ("last 2", 18, 22), ("last 3", 20, 22), ("last 4", 21, 22), ("across", 20, 22), ("opening", 16, 22))
INPUTS, ACROSS, WHOLE = len(TABLES), 4, 5
CHUNK = 1 << 12
#: Words of a group, about, and openings of a share; slots for each different context and next byte; a sketch's registers.
GROUP_WORDS, SHARE_OPENINGS, ROOM, REGISTERS = 25_000, 50_000, 8, 1 << 12
#: Words or openings that a task of the counting step takes, about, for each table that it hands on.
WORDS_A_TASK = 2_000_000
PRIOR, STIFF, SMOOTH = 0.1, 20.0, 0.1
#: A gate: place in the token (first, second, third byte, behind), how sure two contexts are, and the bit's number.
GATES, BUCKETS = 4 * 9 * 8, 33
#: Bytes looked at together when scoring and learning; steps between updates of the curvature.
STEP, LEARN_STEP, BEND = 32_768, 4_096, 4
#: A weight moves by this much a step at most: where a mix is sure and wrong its curvature says nothing.
MOVE = 0.1
#: Whole numbers a unit of weight.
UNITS = 1 << 16
#: Greatest share of a document's own words in a prediction, and the strength of its first guess, in tokens.
CACHE, CACHE_PRIOR = 0.5, 5.0
#: Tokens of a block that are added up at once; bytes of texts that are cut into words at once.
TOKENS, CODED_AT_ONCE = 1_000_000, 1 << 23


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


# ---- 1: blocks --------------------------------------------------------------------------------------------------------

_ROW = pa.schema([("block", pa.int64()), ("word", pa.binary()), ("at", pa.int32()), ("n", pa.int64()), ("opening", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64()), ("codes", pa.binary())])
_BLOCKS = "block long, word binary, at int, n long, opening long, doc_id long, held_out boolean, n_tokens long, n_bytes long, codes binary"
_START = 10  # what stands before a text's first token


def laid_out(words: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of words one after the other, with a zero behind them; where each word begins; its length."""
    array = (words if isinstance(words, pa.Array) else pa.array(words, pa.binary())).cast(pa.binary())
    _, offsets, data = array.buffers()
    edges = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64) if len(array) else np.zeros(1, np.int64)
    flat = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.append(flat, np.uint8(0)), edges[:-1] - edges[0], np.diff(edges)


def as_list(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def ends_of(words: list[bytes] | pa.Array) -> np.ndarray:
    """Each word's last bytes above its opening, as one number; what is missing is zero."""
    flat, start, size = laid_out(words)
    end, out = start + size, np.zeros(len(words), np.int64)
    for k in range(TAIL, 0, -1):
        out = out << 8 | np.where(size >= k, flat[np.maximum(end - k, 0)], 0)
    closing = np.where((size == 1) & (flat[start] == END[0]), 0, SPACE[0])  # the end token has no space behind it
    for k in range(OPEN):
        out = out << 8 | np.where(size > k, flat[np.minimum(start + k, len(flat) - 1)], np.where(size == k, closing, 0))
    return out


class Numbers(dict):
    """Words by number, a new one's being the next."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def opening_keys(codes: np.ndarray, firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of documents one after the other, which begin at ``firsts``: each token's opening under the end of the word before."""
    before = np.empty(len(codes), np.int64)
    before[1:] = ends[codes[:-1]] >> 8 * OPEN
    before[firsts] = _START
    return before << 8 * OPEN | ends[codes] & (1 << 8 * OPEN) - 1


def _by_size(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Runs (from, to) of whole texts that come to about ``most`` bytes."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(size + 1) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
    yield from ((a, b) for a, b in zip(edges, edges[1:], strict=False) if a < b)


def coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(bytes of each text, tokens of all as numbers into the words, the words in the order they are met, each text's first token)."""
    letters, start, size = laid_out(pc.fill_null(texts, ""))
    letters += ((letters >= ord("A")) & (letters <= ord("Z"))).astype(np.uint8) * np.uint8(32)  # pc.ascii_lower garbles cast slices
    split = pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(np.append(start, start[-1:] + size[-1:])), pa.py_buffer(letters)))
    edges = split.offsets.to_numpy().astype(np.int64)
    flat = split.values.slice(edges[0], edges[-1] - edges[0]).cast(pa.large_binary())
    edges -= edges[0]
    there = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], np.cumsum(there)])[edges]  # words before each text, and all
    flat = flat.filter(pa.array(there))
    known = flat.dictionary_encode()
    number, words = known.indices.to_numpy(zero_copy_only=False), known.dictionary
    n = np.diff(before)
    firsts = before[:-1] + np.arange(len(n))
    ends = before[1:] + np.arange(len(n))
    # The end is numbered where it is met first, behind the words of the first text.
    first_end = int(number[: n[0]].max(initial=-1)) + 1
    out = np.full(len(number) + len(n), first_end, np.int64)
    is_word = np.ones(len(out), bool)
    is_word[ends] = False
    out[is_word] = number + (number >= first_end)
    words = pa.concat_arrays([words.slice(0, first_end), pa.array([END], pa.large_binary()), words.slice(first_end)])
    return size, out, words, firsts


def _row_batch(m: int, **given: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(m, f.type)) for f in _ROW], schema=_ROW)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Three kinds of rows: a block's words with their training counts, its openings with theirs, its documents as word numbers."""
    base, k = TaskContext.get().partitionId() << 32, 0
    numbers = Numbers()
    docs: list[tuple] = []
    tokens = 0
    codec = pa.Codec("zstd")

    def closed(n_words: int) -> Iterator[pa.RecordBatch]:
        nonlocal numbers, docs, tokens, k
        words = list(numbers)[:n_words]
        learned = np.zeros(len(words), np.int64)
        for part in _token_chunks([d[-1] for d in docs if not d[1]]):
            learned += np.bincount(np.concatenate(part), minlength=len(words))
        for a in range(0, len(words), 50_000):
            part = words[a : a + 50_000]
            m = len(part)
            yield _row_batch(m, block=pa.array(np.full(m, base + k)), word=pa.array(part, pa.binary()), at=pa.array(np.arange(a, a + m, dtype=np.int32)), n=pa.array(learned[a : a + m]))
        ends = ends_of(words)
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        for part in _token_chunks([d[-1] for d in docs if not d[1]]):
            codes = np.concatenate(part)
            firsts = np.cumsum([0, *map(len, part)])[:-1]
            sums.append(np.unique(opening_keys(codes, firsts, ends), return_counts=True))
        if sums:
            keys, back = np.unique(np.concatenate([s[0] for s in sums]), return_inverse=True)
            n = np.bincount(back, np.concatenate([s[1] for s in sums])).astype(np.int64)
            for a in range(0, len(keys), 100_000):
                yield _row_batch(len(keys[a : a + 100_000]), opening=pa.array(keys[a : a + 100_000]), n=pa.array(n[a : a + 100_000]))
        for a in range(0, len(docs), 2000):
            part = docs[a : a + 2000]
            ids, held, size, codes = zip(*part, strict=True)
            packed = [codec.compress(c.tobytes(), asbytes=True) for c in codes]
            yield _row_batch(len(part), block=pa.array(np.full(len(part), base + k)), doc_id=pa.array(ids, pa.int64()), held_out=pa.array(held), n_tokens=pa.array(list(map(len, codes)), pa.int64()), n_bytes=pa.array(size, pa.int64()), codes=pa.array(packed, pa.binary()))
        numbers, docs, tokens, k = Numbers(), [], 0, k + 1

    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        for a, b in _by_size(texts, CODED_AT_ONCE):
            while a < b:
                size, local, words, firsts = coded(texts.slice(a, b - a))
                before = len(numbers)
                number = np.fromiter(map(numbers.__getitem__, as_list(words)), np.int32, len(words))
                far = np.maximum.accumulate(np.maximum.reduceat(local, firsts))  # the last word met up to each text's end
                n_words = np.maximum(before, np.maximum.accumulate(number)[far] + 1)
                full = np.flatnonzero((n_words >= BLOCK_WORDS) | (tokens + np.append(firsts[1:], len(local)) >= BLOCK_TOKENS))
                m = int(full[0]) + 1 if len(full) else b - a  # texts that still belong to this block
                codes = number[local[: firsts[m] if m < b - a else len(local)]]
                held = [held_out(i) for i in ids[a : a + m]]
                docs += zip(ids[a : a + m], held, size[:m].tolist(), np.split(codes, firsts[1:m]), strict=True)
                tokens += len(codes)
                a += m
                if len(full):
                    yield from closed(int(n_words[m - 1]))
    if docs:
        yield from closed(len(numbers))


def _token_chunks(docs: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Whole documents, about ``TOKENS`` tokens at once."""
    held, n = [], 0
    for d in docs:
        held.append(d)
        n += len(d)
        if n >= TOKENS:
            yield held
            held, n = [], 0
    if held:
        yield held


# ---- contexts ----------------------------------------------------------------------------------------------------------

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)


def _hashed(seed: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]) if parts else 1, seed, np.uint64)
    for p in parts:
        h = (h * np.uint64(257) + p) * _M1
    return h ^ h >> np.uint64(31)


class Openings:
    """Openings place by place: which of them have a byte there, that byte, and its contexts by table."""

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        seq = [(keys >> 8 * k & 255).astype(np.uint64) for k in range(TAIL + OPEN - 1, -1, -1)]
        self.tail, self.bytes = seq[:TAIL], seq[TAIL:]

    def places(self, new: list[np.ndarray] | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """(place, which, byte, contexts); ``new``: by place, which to give."""
        alive = np.ones(self.n, bool)
        for p in range(OPEN):
            at = np.flatnonzero(alive if new is None else alive & new[p])
            before = [x[at] + np.uint64(1) for x in (*self.tail, np.full(self.n, SPACE[0], np.uint64), *self.bytes[:p])]
            last = [_hashed(k, *before[: -k - 1 : -1]) for k in range(1, 5)]
            own = [x[at] + np.uint64(1) for x in self.bytes[:p]]
            where = np.full(len(at), p, np.uint64)
            yield p, at, self.bytes[p][at].astype(np.uint8), [*last, _hashed(91, where, *before[:TAIL], *own), _hashed(92, where, *own)]
            alive &= (self.bytes[p] != SPACE[0]) & (self.bytes[p] != END[0])


def once(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(place, each opening's number or -1, key, byte, contexts) of different beginnings of openings that are in order."""
    new = [np.diff(keys >> 8 * (OPEN - 1 - p), prepend=-1) != 0 for p in range(OPEN)]
    for p, at, byte, contexts in Openings(keys).places(new):
        run = np.cumsum(new[p]) - 1
        number = np.full(int(run[-1]) + 1 if len(run) else 0, -1)
        number[run[at]] = np.arange(len(at))
        yield p, number[run], keys[at] >> 8 * (OPEN - 1 - p), byte, contexts


class Words:
    """The bytes behind the openings of sorted words: each one's owner and contexts, and the counts of whole beginnings.

    ``steps`` and ``rest`` hand out (owner, byte, contexts, what whole beginnings say by bit) in pieces; very long tokens come in
    pieces of their own.  Contexts follow from the beginning, so ``once`` and ``learned`` name each beginning and next byte once.
    """

    def __init__(self, words: list[bytes] | pa.Array, times: np.ndarray):
        self.array, self.times = words if isinstance(words, pa.Array) else pa.array(words, pa.binary()), times
        letters, start, length = laid_out(self.array)
        size = np.minimum(length + 1, HEAD)
        size[(length == 1) & (letters[start] == END[0])] = 1  # the end token has no space behind it
        starts = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(owner)) - starts[owner]
        flat = np.where(place < length[owner], letters[start[owner] + np.minimum(place, length[owner])], SPACE[0])
        at = np.flatnonzero(place >= OPEN)
        self.place, self.owner, self.byte = place[at], owner[at], flat[at]
        self.last = _last_four(flat, place, at)
        big = flat.astype(np.uint64) + np.uint64(1)
        power = np.cumprod(np.full(HEAD + 1, _M2, np.uint64), dtype=np.uint64)
        total = np.concatenate([[np.uint64(0)], np.cumsum(big * power[place], dtype=np.uint64)])
        h = total[:-1] - total[starts[owner]] + np.uint64(77)
        self.whole = (h ^ h >> np.uint64(31))[at]
        self.long = np.flatnonzero(length >= HEAD).tolist()
        self.said: list[tuple[np.ndarray, np.ndarray]] = []
        self._number(flat, place, owner, starts, size)

    def _number(self, flat: np.ndarray, place: np.ndarray, owner: np.ndarray, starts: np.ndarray, size: np.ndarray) -> None:
        """Different beginnings with their next bytes, found by how far each word goes with the one before it.

        ``keys``: beginning * 256 + next byte, in order; ``first``: a byte that has it; ``key``: each byte's; ``begun``: a byte of
        each beginning.
        """
        before = np.maximum(owner - 1, 0)
        same = (place < size[before]) & (flat[starts[before] + np.minimum(place, size[before] - 1)] == flat) & (owner > 0)
        alike = np.minimum.reduceat(np.where(same, HEAD, place), starts) if len(starts) else np.zeros(0, np.int64)
        alike[:1] = -1
        order = np.argsort(self.place.astype(np.uint8), kind="stable")  # by place, there by word: equal beginnings side by side
        far, own = alike[self.owner[order]], self.place[order]
        beginning, new = np.cumsum(own > far) - 1, np.flatnonzero(own >= far)
        self.begun = order[own > far]
        keys, self.first = beginning[new] * 256 + self.byte[order[new]], order[new]
        self.key = np.empty(len(order), np.int64)
        self.key[order] = np.cumsum(own >= far) - 1
        if (np.diff(keys) < 0).any():  # bytes below the space that closes a word
            by = np.argsort(keys, kind="stable")
            rank = np.empty(len(by), np.int64)
            rank[by] = np.arange(len(by))
            keys, self.first, self.key = keys[by], self.first[by], rank[self.key]
        self.keys = keys

    @functools.cached_property
    def words(self) -> list[bytes]:
        return as_list(self.array)

    def beginnings(self, word: int) -> np.ndarray:
        """Contexts of the whole beginnings that a word has."""
        return self.whole[self.owner == word]

    def count_whole(self, shared: tuple[np.ndarray, np.ndarray, np.ndarray], leave_out: bool = False) -> None:
        """Counts (zero, one) by bit of each different beginning and next byte; of the beginnings in ``shared`` those of all groups.

        What they say is kept with them; leave_out: as if each bit had been counted once less.
        """
        keys, total = self.keys, np.bincount(self.key, self.times[self.owner], len(self.keys))
        different = self.whole[self.begun]
        context, byte, n = shared
        lo, hi = np.searchsorted(context, different), np.searchsorted(context, different, "right")
        others = {int(d): (a, b) for d, a, b in zip(np.flatnonzero(hi > lo), lo[hi > lo], hi[hi > lo], strict=True)}
        self.own = np.arange(len(keys))
        if others:  # next bytes that only other groups have count as well
            extra = np.concatenate([np.array([d], np.int64).repeat(b - a) * 256 + byte[a:b] for d, (a, b) in others.items()])
            counts = np.concatenate([n[a:b] for a, b in others.values()])
            at = np.searchsorted(keys, extra)
            new = keys[np.minimum(at, len(keys) - 1)] != extra
            self.own = self.own + np.cumsum(np.bincount(at[new], minlength=len(keys) + 1))[:-1]
            keys, total = np.insert(keys, at[new], extra[new]), np.insert(total, at[new], 0.0)
            total[np.searchsorted(keys, extra)] = counts
        self.back = self.own[self.key]
        self.counts, self.said = [], []
        for k, _, bit in walk((keys & 255).astype(np.uint8)):
            new = np.diff(keys >> (8 - k), prepend=-1) != 0
            first = np.flatnonzero(new)
            n = np.stack([np.add.reduceat(total * (bit == v), first) for v in (0, 1)], axis=1).astype(np.float32) if len(first) else np.zeros((0, 2), np.float32)
            run = np.cumsum(new) - 1
            self.counts.append(n[run])
            if leave_out:
                self.said.append(_said(self.counts[-1][:, 0], self.counts[-1][:, 1], bit))
            else:
                logit, sure = _said(n[:, 0], n[:, 1], None)
                self.said.append((logit[run], sure[run]))

    def once(self, size: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]]:
        """(which, key, byte, contexts, what whole beginnings say by bit) of the different beginnings and next bytes, in pieces."""
        for a in range(0, len(self.keys), size):
            i = self.first[a : a + size]
            own = self.own[a : a + size] if self.said else None
            yield slice(a, a + size), self.keys[a : a + size], self.byte[i], [x[i] for x in self.last], [(logit[own], sure[own]) for logit, sure in self.said]

    def learned(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
        """(key, byte, contexts, times) of what was met in training: beginnings and next bytes once, then very long tokens."""
        total = np.bincount(self.key, self.times[self.owner], len(self.keys))
        for which, keys, byte, contexts, _ in self.once(size):
            at = np.flatnonzero(total[which] > 0)
            yield keys[at], byte[at], [x[at] for x in contexts], total[which][at]
        for owner, byte, contexts, _ in self.rest(size, True):
            yield np.arange(len(byte)) * 256 + byte, byte, contexts, self.times[owner].astype(float)

    def steps(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]]:
        """Every byte of words met in training, in the order of their hashes (not of the alphabet)."""
        hashes = np.fromiter(map(zlib.crc32, as_list(pc.binary_slice(self.array, 0, HEAD))), np.int64, len(self.array))
        n = np.bincount(self.owner, minlength=len(hashes))
        order = np.argsort(hashes, kind="stable")
        order = order[(self.times[order] > 0) & (n[order] > 0)]
        n_of, start = n[order], (np.cumsum(n) - n)[order]
        at = np.repeat(start - (np.cumsum(n_of) - n_of), n_of) + np.arange(n_of.sum())
        for a in range(0, len(at), size):
            i = at[a : a + size]
            back = self.back[i] if self.said else None
            yield self.owner[i], self.byte[i], [x[i] for x in self.last], [(logit[back], sure[back]) for logit, sure in self.said]
        yield from self.rest(size, True)

    def rest(self, size: int, learned_only: bool) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]]:
        """The same of very long tokens behind their first ``HEAD`` bytes."""
        for w in self.long:
            if self.times[w] > 0 or not learned_only:
                token = self.array[w].as_py()[HEAD - 4 :] + SPACE
                for a in range(4, len(token), size):
                    flat = np.frombuffer(token[a - 4 : a + size], np.uint8)
                    place = np.arange(len(flat))
                    i = place[4:]
                    nothing = (np.zeros(len(i), np.float32), np.zeros(len(i), np.uint8))
                    yield np.full(len(i), w), flat[i], _last_four(flat, place, i), [nothing] * 8


def _last_four(flat: np.ndarray, place: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Contexts of the last one to four bytes at some bytes; none reaches over a token's beginning."""
    before = []
    for back in range(1, 5):
        x = flat[np.maximum(at - back, 0)].astype(np.uint64) + np.uint64(1)
        short = np.flatnonzero(place[at] < back)
        x[short] = np.where(place[at[short]] == back - 1, np.uint64(SPACE[0] + 1), np.uint64(0))
        before.append(x)
    return [_hashed(k, *before[:k]) for k in range(1, 5)]


def _slots(context: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    h = (context + node.astype(np.uint64) * _M2) * _M3
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def walk(flat: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Bit by bit from the top: (number, the node that the bits before lead to, the bit)."""
    node = np.ones(len(flat), np.int64)
    for k in range(8):
        bit = (flat >> np.uint8(7 - k) & np.uint8(1)).astype(np.int64)
        yield k, node, bit
        node = node * 2 + bit


# ---- the model ----------------------------------------------------------------------------------------------------------

#: Counts are kept as eighths of the binary logarithm of one more than them.
_COUNT = (2.0 ** (np.arange(256) / 8) - 1).astype(np.float32)


def packed_counts(n: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.rint(8 * np.log2(1 + n))).astype(np.uint8)


def least_bits() -> tuple[int, ...]:
    return tuple(low for _, low, _ in TABLES)


def _said(zero: np.ndarray, one: np.ndarray, bit: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(logit, how sure from 0 to 2) that counts give; with ``bit`` as if it had been counted once less."""
    if bit is not None:
        one, zero = np.maximum(0, one - bit), np.maximum(0, zero - (1 - bit))
    n = zero + one
    return np.log((one + PRIOR) / (zero + PRIOR)).astype(np.float32), (n > 0.5).astype(np.uint8) + (n > 6)


@functools.cache
def _tables_said() -> tuple[np.ndarray, np.ndarray]:
    """What every pair of packed counts says, as it is and as if a zero or a one had been counted once less: [3 * 65536]."""
    zero, one = np.tile(_COUNT, 256), np.repeat(_COUNT, 256)  # a slot's zeros are its low byte
    parts = [_said(zero, one, None), _said(zero, one, np.zeros(len(zero), np.int64)), _said(zero, one, np.ones(len(zero), np.int64))]
    return np.concatenate([p[0] for p in parts]).astype(float), np.concatenate([p[1] for p in parts]).astype(np.int64)


_NINE = np.arange(9)[:, None]
_NODES = np.arange(256, dtype=np.uint64) * _M2 * _M3


class Mixer:
    """Counts of all hashed contexts (``counts[slot, bit]``, packed), weights by gate and the adaptive map by gate and logit.

    Bits of one number at one place in the token share nine gates, told apart by how sure two of the contexts are.
    """

    def __init__(self, counts: np.ndarray, bits: tuple[int, ...] | None = None, weights: np.ndarray | None = None, refined: np.ndarray | None = None):
        self.bits = bits or least_bits()
        self.pairs = np.ascontiguousarray(counts, np.uint8).view("<u2").ravel()
        self.offsets = np.cumsum([0, *(1 << s for s in self.bits)])[:-1, None]
        self.shifts = np.array([64 - s for s in self.bits], np.uint64)[:, None]
        self.weights = np.full((GATES, INPUTS), 1.0 / 3) if weights is None else weights
        even = 1 / (1 + np.exp(-np.linspace(-8, 8, BUCKETS)))
        self.refined = np.tile(even, (GATES, 1)) if refined is None else refined
        self.start()

    def start(self) -> None:
        """Forget what was learned: each group learns from the same beginning."""
        self.now = self.weights.copy()
        self.met = np.zeros(GATES)
        self.curves = np.tile(np.eye(INPUTS) * STIFF, (GATES, 1, 1))
        self.step = 0

    @staticmethod
    def spread(contexts: list[np.ndarray]) -> np.ndarray:
        """Contexts by row, multiplied once for all bits: slots are then those of :func:`_slots`."""
        return np.stack(contexts) * _M3

    def inputs(self, contexts: np.ndarray, node: np.ndarray, k: int, bit: np.ndarray | None, own: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(logits by context, which of the nine gates) of one bit of many bytes; with ``bit`` as if it had been counted once less.

        ``contexts`` come from :meth:`spread`.  ``own``: what whole beginnings say behind an opening, where nothing reaches across.
        """
        logit_of, sure_of = _tables_said()
        m = len(contexts)
        slot = contexts + _NODES[node]
        slot >>= self.shifts[:m]
        slot = slot.view(np.int64)
        slot += self.offsets[:m]
        pair = np.take(self.pairs, slot, mode="clip").astype(np.int64)
        if bit is not None:
            pair += (bit + 1) << 16
        logits = np.zeros((INPUTS, len(node)))
        np.take(logit_of, pair, out=logits[:m], mode="clip")
        if own is not None:
            logits[WHOLE], sure = own
        else:
            sure = np.take(sure_of, pair[ACROSS], mode="clip")
        return logits, np.take(sure_of, pair[3], mode="clip") * 3 + sure

    @staticmethod
    def gates(place: int, k: int) -> np.ndarray:
        return (place * 9 + np.arange(9)) * 8 + k

    @staticmethod
    def mix(weights: np.ndarray, logits: np.ndarray, level: np.ndarray) -> np.ndarray:
        """``weights``: of the nine gates."""
        x = np.empty(len(level))
        for a in range(0, len(level), LEARN_STEP):  # small enough for one thread
            i = level[a : a + LEARN_STEP]
            every = weights @ logits[:, a : a + LEARN_STEP]
            x[a : a + LEARN_STEP] = every.ravel().take(i * len(i) + np.arange(len(i)))
        return np.clip(x, -12, 12, out=x)

    @staticmethod
    def refine(refined: np.ndarray, x: np.ndarray, level: np.ndarray) -> np.ndarray:
        """The probability of a one bit: three parts the mix, one part what such mixes came to (``refined``: of the nine gates)."""
        at = np.clip((x + 8) * 2, 0, BUCKETS - 1.001)
        low = at.astype(np.int64)
        part = at - low
        low += level * BUCKETS
        flat = refined.ravel()
        said = flat[low] * (1 - part) + flat[low + 1] * part
        return np.clip(0.75 / (1 + np.exp(-x)) + 0.25 * said, 1e-6, 1 - 1e-6)

    def learn(self, byte: np.ndarray, contexts: list[np.ndarray], place: int, weight: np.ndarray, own: list[tuple[np.ndarray, np.ndarray]] | None, seen: np.ndarray) -> None:
        """One online step a bit: of each gate, along the loss's slope over its curvature summed so far (online Newton).

        Every ``BEND``-th step adds its curvature, for itself and for those that leave it out.
        """
        bent = self.step % BEND == 0
        late = self.step >= 2
        self.step += 1
        contexts = self.spread(contexts)
        terms = np.empty((INPUTS + 1, len(byte)))
        terms[INPUTS] = weight
        for k, node, bit in walk(byte):
            gates = self.gates(place, k)
            logits, level = self.inputs(contexts, node, k, bit, None if own is None else own[k])
            x = self.mix(self.now[gates], logits, level)
            p = 1 / (1 + np.exp(-x))
            np.multiply(logits, (bit - p) * weight, out=terms[:INPUTS])
            sums = (level == _NINE).astype(float) @ terms.T
            if bent:
                by = np.argsort(level.astype(np.uint8), kind="stable")
                edges = np.searchsorted(level[by], np.arange(10)).tolist()
                dealt, bend = np.take(logits, by, axis=1), (BEND * p * (1 - p) * weight)[by]
                for gate, a, b in zip(gates.tolist(), edges, edges[1:], strict=False):
                    if a < b:
                        self.curves[gate] += (dealt[:, a:b] * bend[a:b]) @ dealt[:, a:b].T
            self.now[gates] += np.clip(np.linalg.solve(self.curves[gates], sums[:, :INPUTS, None])[:, :, 0], -MOVE, MOVE)
            self.met[gates] += sums[:, INPUTS]
            if late:
                at = (level * BUCKETS + np.rint(np.clip((x + 8) * 2, 0, BUCKETS - 1)).astype(np.int64)) * 2 + bit
                n = np.bincount(at, weight, 9 * BUCKETS * 2).astype(np.int64).reshape(9, BUCKETS, 2)
                seen.reshape(2, GATES, BUCKETS)[:, gates] += np.stack([n.sum(axis=2), n[:, :, 1]])

    def log10(self, byte: np.ndarray, contexts: list[np.ndarray], place: int, own: list[tuple[np.ndarray, np.ndarray]] | None = None, keys: np.ndarray | None = None) -> np.ndarray:
        """log10 of each byte's probability; ``keys``: in order, bytes whose keys differ in the last eight bits only share their contexts."""
        likely = np.ones(len(byte))  # eight factors of a millionth at least
        contexts = self.spread(contexts)
        for k, node, bit in walk(byte):
            gates = self.gates(place, k)
            said = None if own is None else own[k]
            first = run = None
            if keys is not None:
                new = np.diff(keys >> (8 - k), prepend=-1) != 0
                first = np.flatnonzero(new)
            if first is not None and len(first) < 0.8 * len(byte):  # what is asked of the same bits is asked once
                run = np.cumsum(new) - 1
                logits, level = self.inputs(contexts[:, first], node[first], k, None, said and (said[0][first], said[1][first]))
            else:
                logits, level = self.inputs(contexts, node, k, None, said)
            p = self.refine(self.refined[gates], self.mix(self.weights[gates], logits, level), level)
            if run is not None:
                p = p[run]
            likely *= np.where(bit == 1, p, 1 - p)
        return np.log10(likely)

    def opening_scores(self, keys: np.ndarray) -> np.ndarray:
        """Of openings in order."""
        out = np.zeros(len(keys))
        for a in range(0, len(keys), STEP):
            for p, number, key, byte, contexts in once(keys[a : a + STEP]):
                out[a : a + STEP] += np.append(self.log10(byte, contexts, p, None, key), 0.0)[number]
        return out

    def word_scores(self, group: Words) -> np.ndarray:
        said = np.zeros(len(group.keys))
        for which, keys, byte, contexts, own in group.once(STEP):
            said[which] = self.log10(byte, contexts, OPEN, own, keys)
        out = np.bincount(group.owner, said[group.key], len(group.array))
        for owner, byte, contexts, own in group.rest(STEP, False):
            out += np.bincount(owner, self.log10(byte, contexts, OPEN, own), len(out))
        return out


# ---- 3: groups and shares, whole beginnings at their edges -------------------------------------------------------------


def _numbered(cuts: list[bytes]):
    """(group, word, c): a word's group is how many cuts are not behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect.bisect_right(cuts, w) for w in as_list(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column(0), batch.column(1)], names=["part", "value", "n"])

    return run


def _packed(kind: pa.DataType):
    """Rows (part, value, n) in order -> one row a part, which no reader can cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, values, n = None, [], []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pa.concat_arrays(values)], pa.list_(kind)), pa.array([pa.concat_arrays(n)], pa.list_(pa.int64()))], names=["vals", "times"])

        for batch in batches:
            part = batch.column(0).to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]).tolist()
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if part[a] != now and values:
                    yield row()
                    values, n = [], []
                now = part[a]
                values.append(batch.column(1).slice(a, b - a).cast(kind))
                n.append(batch.column(2).slice(a, b - a))
        if values:
            yield row()

    return run


def packed(parts: DataFrame, n_parts: int, order: str, kind: str, name: str) -> DataFrame:
    """(part, value, n) -> (vals, times): one row a part, values in order."""
    dealt = parts.repartitionByRange(max(1, n_parts), "part").sortWithinPartitions("part", order).select("part", "value", "n")
    return written(dealt.mapInArrow(_packed(pa.binary() if kind == "binary" else pa.int64()), f"vals array<{kind}>, times array<long>"), name)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        for words, times in zip(batch.column(0), batch.column(1), strict=True):
            yield Words(words.values, times.values.to_numpy())


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for keys, times in zip(batch.column(0), batch.column(1), strict=True):
            yield keys.values.to_numpy(), times.values.to_numpy()


def sketch(grams: np.ndarray) -> np.ndarray:
    """HyperLogLog registers of 64-bit values, well mixed or not."""
    h = (grams ^ grams >> np.uint64(32)) * _M3
    h = (h ^ h >> np.uint64(29)) * _M1
    h ^= h >> np.uint64(32)
    rest = (h >> np.uint64(12)).astype(np.float64)
    out = np.zeros(REGISTERS, np.uint8)
    np.maximum.at(out, (h & np.uint64(REGISTERS - 1)).astype(np.int64), (53 - np.frexp(rest)[1]).astype(np.uint8))
    return out


def sketched(registers: np.ndarray) -> float:
    """About how many different values the registers have seen."""
    m, none = len(registers), int((registers == 0).sum())
    raw = 0.7213 / (1 + 1.079 / m) * m * m / (2.0 ** -registers.astype(float)).sum()
    return m * np.log(m / none) if raw < 2.5 * m and none else raw


def _sketch_into(seen: np.ndarray, contexts: list[np.ndarray], byte: np.ndarray) -> None:
    for o, c in enumerate(contexts):
        seen[o] = np.maximum(seen[o], sketch((c * np.uint64(257) + byte) * _M1))


_EDGES = "context long, byte int, n long, t int, seen binary"


def _sketch_rows(seen: np.ndarray) -> pa.RecordBatch:
    m = len(seen)
    return pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.array(np.arange(m, dtype=np.int32)), pa.array([x.tobytes() for x in seen], pa.binary())], names=["context", "byte", "n", "t", "seen"])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Next bytes of the beginnings that a group may share with others (context, byte, n); at the end a sketch a table."""
    seen = np.zeros((INPUTS, REGISTERS), np.uint8)
    for group in _groups(batches):
        for _, byte, contexts, _ in group.learned(1 << 17):
            _sketch_into(seen, contexts, byte)
        mine = np.concatenate([group.beginnings(0), group.beginnings(len(group.array) - 1)])
        at = np.flatnonzero(np.isin(group.whole, mine) & (group.times[group.owner] > 0))
        keys, back = np.unique(np.stack([group.whole[at], group.byte[at].astype(np.uint64)]), axis=1, return_inverse=True)
        n = np.bincount(back.reshape(-1), group.times[group.owner[at]], keys.shape[1]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys[0].view(np.int64)), pa.array(keys[1].astype(np.int32)), pa.array(n), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names=["context", "byte", "n", "t", "seen"])
    yield _sketch_rows(seen)


def _opening_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros((INPUTS, REGISTERS), np.uint8)
    for keys, _ in _shares(batches):
        for _, _, _, byte, contexts in once(np.sort(keys)):
            _sketch_into(seen, contexts, byte)
    yield _sketch_rows(seen)


def _most(group: pa.Table) -> pa.Table:
    seen = np.zeros(REGISTERS, np.uint8)
    for x in group.column("seen"):
        seen = np.maximum(seen, np.frombuffer(x.as_py(), np.uint8))
    return pa.table({"t": group.column("t").slice(0, 1), "seen": pa.array([seen.tobytes()], pa.binary())})


def edges(groups: DataFrame, shares: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], tuple[int, ...]]:
    """(context, byte, n) of the beginnings at groups' edges, in order, and the tables' slots as powers of two."""
    found = written(groups.mapInArrow(_edges, _EDGES).unionByName(shares.mapInArrow(_opening_sketches, _EDGES)), "edges")
    different = {r.t: sketched(np.frombuffer(r.seen, np.uint8)) for r in found.where("seen is not null").groupBy("t").applyInArrow(_most, "t int, seen binary").collect()}
    bits = tuple(min(high, max(low, int(np.ceil(np.log2(max(1.0, ROOM * different.get(t, 0.0))))))) for t, (_, low, high) in enumerate(TABLES))
    rows = found.where("context is not null").groupBy("context", "byte").agg(F.sum("n").alias("n")).toPandas()
    context, byte, n = rows["context"].to_numpy(np.int64).view(np.uint64), rows["byte"].to_numpy(np.int64), rows["n"].to_numpy(float)
    order = np.lexsort((byte, context))
    return (context[order], byte[order], n[order]), bits


# ---- 4: context counts ------------------------------------------------------------------------------------------------


def _count_into(table: np.ndarray, offsets: np.ndarray, bits: tuple[int, ...], keys: np.ndarray, byte: np.ndarray, contexts: list[np.ndarray], weight: np.ndarray) -> None:
    """Bytes with their keys in order, which share contexts where they differ in the last eight bits only."""
    for k, node, bit in walk(byte):
        first = np.flatnonzero(np.diff(keys >> (7 - k), prepend=-1) != 0)
        n = np.add.reduceat(weight, first) if len(first) else weight
        node, bit = node[first], bit[first]
        for o, c in enumerate(contexts):
            np.add.at(table, (offsets[o] + _slots(c[first], node, bits[o])) * 2 + bit, n)


def _counted(bits: tuple[int, ...], of_openings: bool):
    size = -(-sum(1 << s for s in bits) // CHUNK) * CHUNK
    offsets = np.cumsum([0, *(1 << s for s in bits)])[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size * 2)  # whole numbers, exact up to 2**53
        if of_openings:
            for keys, times in _shares(batches):
                order = np.argsort(keys)
                for _, number, key, byte, contexts in once(keys[order]):
                    n = np.bincount(number + 1, times[order], len(key) + 1)[1:]
                    _count_into(table, offsets, bits, key, byte, contexts, n)
        else:
            for group in _groups(batches):
                for keys, byte, contexts, n in group.learned(1 << 17):
                    _count_into(table, offsets, bits, keys, byte, contexts, n)
        chunks = table.reshape(-1, CHUNK * 2)
        for k in np.flatnonzero(chunks.any(axis=1)).tolist():
            at = np.flatnonzero(chunks[k])
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([at.astype(np.uint16).tobytes()], pa.binary()), pa.array([chunks[k][at].astype(np.int64).tobytes()], pa.binary())], names=["chunk", "at", "n"])

    return size, run


def _summed(group: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK * 2)
    for at, n in zip(group.column("at"), group.column("n"), strict=True):
        total[np.frombuffer(at.as_py(), np.uint16)] += np.frombuffer(n.as_py(), np.int64)
    return pa.table({"chunk": pa.array([group.column("chunk")[0].as_py()], pa.int64()), "packed": pa.array([packed_counts(total).tobytes()], pa.binary())})


def context_counts(groups: DataFrame, shares: DataFrame, bits: tuple[int, ...], tasks: tuple[int, int]) -> np.ndarray:
    """Packed counts of the hashed contexts; two bytes a slot reach the driver."""
    size, of_words = _counted(bits, False)
    _, of_openings = _counted(bits, True)
    schema = "chunk long, at binary, n binary"
    found = groups.coalesce(tasks[0]).mapInArrow(of_words, schema).unionByName(shares.coalesce(tasks[1]).mapInArrow(of_openings, schema))
    out = np.zeros((size // CHUNK, CHUNK * 2), np.uint8)
    for row in found.groupBy("chunk").applyInArrow(_summed, "chunk long, packed binary").collect():
        out[row.chunk] = np.frombuffer(row.packed, np.uint8)
    return out.reshape(size, 2)


# ---- 5 and 6: weights and scores --------------------------------------------------------------------------------------


def _learned(make: Callable[[], Mixer], shared, of_openings: bool):
    """A task's sums in whole numbers, (number, sum): weights times meetings by gate, meetings, and the map's counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = make()
        weights, met = np.zeros((GATES, INPUTS), np.int64), np.zeros(GATES, np.int64)
        seen = np.zeros((2, GATES * BUCKETS), np.int64)

        def part_done() -> None:
            n = np.rint(mixer.met).astype(np.int64)
            weights[:] += np.rint(mixer.now * UNITS).astype(np.int64) * n[:, None]
            met[:] += n
            mixer.start()

        if of_openings:
            for keys, times in _shares(batches):
                for a in range(0, len(keys), LEARN_STEP):
                    for p, at, byte, contexts in Openings(keys[a : a + LEARN_STEP]).places():
                        mixer.learn(byte, contexts, p, times[a + at].astype(float), None, seen)
                part_done()
        else:
            for group in _groups(batches):
                group.count_whole(shared.value, leave_out=True)
                for owner, byte, contexts, own in group.steps(LEARN_STEP):
                    mixer.learn(byte, contexts, OPEN, group.times[owner].astype(float), own, seen)
                part_done()
        every = np.concatenate([weights.ravel(), met, seen.ravel()])
        at = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(every[at])], names=["i", "v"])

    return run


def _fit(groups: DataFrame, shares: DataFrame, make: Callable[[], Mixer], shared) -> tuple[np.ndarray, np.ndarray]:
    """Weights averaged by meetings, and the adaptive map of what all groups and shares saw; a few numbers a gate reach the driver."""
    rows = groups.mapInArrow(_learned(make, shared, False), "i long, v long").unionByName(shares.mapInArrow(_learned(make, shared, True), "i long, v long"))
    every = np.zeros(GATES * INPUTS + GATES + 2 * GATES * BUCKETS)
    for r in rows.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        every[r.i] = float(r.v)
    weights, met, seen = np.split(every, [GATES * INPUTS, GATES * INPUTS + GATES])
    mixer = make()
    weights, seen = weights.reshape(GATES, INPUTS) / UNITS, seen.reshape(2, GATES, BUCKETS)
    weights = np.where(met[:, None] > 0, weights / np.maximum(met, 1)[:, None], mixer.weights)
    return weights, (seen[1] + 20 * mixer.refined) / (seen[0] + 20)


def _word_scores(make: Callable[[], Mixer], shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = make()
        for group in _groups(batches):
            group.count_whole(shared.value)
            said = mixer.word_scores(group)
            ends = ends_of(group.array)
            for a in range(0, len(said), 20_000):
                b = slice(a, a + 20_000)
                yield pa.RecordBatch.from_arrays([group.array[b].cast(pa.binary()), pa.array(group.times[b]), pa.array(said[b].astype(np.float32)), pa.array(ends[b])], names=["word", "c", "s", "ends"])

    return run


def with_own_words(codes: np.ndarray, firsts: np.ndarray, said: np.ndarray) -> np.ndarray:
    """log10 probabilities of tokens (of documents that begin at ``firsts``) once each document's words so far predict as well.

    A document that has come to token ``i`` having repeated ``r`` of its tokens gives its own words ``CACHE * r / (i + CACHE_PRIOR)``
    of the prediction, shared out by how often each was met.
    """
    n = len(codes)
    doc = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, n)))
    i = np.arange(n) - firsts[doc]
    order = np.argsort(doc * (int(codes.max(initial=0)) + 1) + codes, kind="stable")
    new = np.ones(n, bool)
    new[1:] = (codes[order[1:]] != codes[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    run = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    times = np.empty(n)
    times[order] = np.arange(n) - run  # how often the token was met before
    again = np.cumsum(times > 0) - (times > 0)
    share = CACHE * (again - again[firsts][doc]) / (i + CACHE_PRIOR)
    with np.errstate(divide="ignore"):
        own = np.log(share * times / np.maximum(i, 1))
    return np.logaddexp(said * np.log(10) + np.log1p(-share), own) / np.log(10)


def _added(n: int, v: int, make: Callable[[], Mixer]):
    bottom = n + SMOOTH * (v + 1)

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        m = words.num_rows
        c, s, ends = np.zeros(m, np.int64), np.zeros(m), np.zeros(m, np.int64)
        at = words.column("at").to_numpy()
        c[at], s[at], ends[at] = words.column("c").to_numpy(), words.column("s").to_numpy(), words.column("ends").to_numpy()
        base = np.log10((c + SMOOTH) / bottom)
        codec = pa.Codec("zstd")
        coded = [np.frombuffer(codec.decompress(x.as_py(), 4 * k, asbytes=True), np.int32) for x, k in zip(docs.column("codes"), docs.column("n_tokens").to_pylist(), strict=True)]
        chunks = [(np.concatenate(part), np.cumsum([0, *map(len, part)])[:-1]) for part in _token_chunks(coded)]
        del coded
        keys, own, places = np.zeros(0, np.int64), [], []
        for codes, firsts in chunks:
            place, different = pd.factorize(opening_keys(codes, firsts, ends))
            places.append(place.astype(np.int32))
            own.append(different)
            keys = np.union1d(keys, different)
        opened = make().opening_scores(keys)
        known, b, x = [], [], []
        for (codes, firsts), place, different in zip(chunks, places, own, strict=True):
            said = s[codes] + opened[np.searchsorted(keys, different)][place]
            known.append(np.add.reduceat((c[codes] > 0).astype(np.int64), firsts))
            b.append(np.add.reduceat(base[codes], firsts))
            x.append(np.add.reduceat(with_own_words(codes, firsts, said), firsts))
        known, b, x = (np.concatenate(y) for y in (known, b, x))
        n_bytes = docs.column("n_bytes").to_pylist()
        bits = [-y / np.log10(2) / z if z else None for y, z in zip(x.tolist(), n_bytes, strict=True)]
        return pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": docs.column("n_tokens"), "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(x), n)), "base_score": pa.array(b), "score": pa.array(x), "n_bytes": pa.array(n_bytes, pa.int64()), "bits_per_byte": pa.array(bits, pa.float64())})

    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes and bits_per_byte of every row of ``docs`` (doc_id, text).

    bits_per_byte: all bits of the score, the end token's included, over the text's bytes; null for a text without bytes.
    """
    spark = docs.sparkSession
    blocks = written(only(docs, "doc_id", "text").mapInArrow(_blocks, _BLOCKS), "blocks")
    listed = blocks.where("word is not null").select("block", "word", "at", "n")
    words = written(listed.groupBy("word").agg(F.sum("n").alias("c")), "words")
    got = words.agg(F.count(F.lit(1)).alias("d"), F.sum("c").alias("n"), F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("v")).first()
    n, v = got.n or 0, got.v or 0
    opened = written(blocks.where("opening is not null").groupBy("opening").agg(F.sum("n").alias("n")), "openings")
    n_opened = opened.count()

    cut = words.where((F.pmod(F.xxhash64("word"), F.lit(GROUP_WORDS)) == 0) & (F.length("word") <= HEAD)).select("word")
    cuts = sorted(bytes(r.word) for r in cut.collect())
    groups = packed(words.select("word", "c").mapInArrow(_numbered(cuts), "part int, value binary, n long"), len(cuts) + 1, "value", "binary", "groups")
    n_shares = max(1, -(-n_opened // SHARE_OPENINGS))
    dealt = opened.select(F.pmod(F.xxhash64("opening"), F.lit(n_shares)).cast("int").alias("part"), F.col("opening").alias("value"), "n", F.xxhash64("opening", F.lit(1)).alias("h"))
    shares = packed(dealt, n_shares, "h", "bigint", "shares")

    at_edges, bits = edges(groups, shares)
    shared = spark.sparkContext.broadcast(at_edges)
    a_task = lambda k: max(8, -(-k // WORDS_A_TASK))
    counts = spark.sparkContext.broadcast(context_counts(groups, shares, bits, (a_task(got.d), a_task(n_opened))))
    weights, refined = _fit(groups, shares, lambda: Mixer(counts.value, bits), shared)
    make = lambda: Mixer(counts.value, bits, weights, refined)
    scored = groups.mapInArrow(_word_scores(make, shared), "word binary, c long, s float, ends long")
    back = listed.select("block", "word", "at").join(scored, "word").select(F.col("block").alias("of_block"), "at", "c", "s", "ends")
    coded = blocks.where("codes is not null").select("block", "doc_id", "held_out", "n_tokens", "n_bytes", "codes")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    return coded.groupBy("block").cogroup(back.groupBy("of_block")).applyInArrow(_added(n, v, make), schema)

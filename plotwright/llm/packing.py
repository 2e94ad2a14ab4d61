"""Best-fit packing of tokenised documents by hierarchical residual packing (operator 1).

1. Each task tokenises its documents, cuts those longer than a sequence (the first piece takes the remainder) and packs the
   pieces best-fit, longest first.  Nearly full bins are final.
2. Underfull bins go up a tree as items: groups of them are packed best-fit again, round by round, each round emitting the
   bins that became nearly full, until few are left or further rounds save next to nothing.
3. A bin's place in its final sequence moves the pieces in it; pieces carry no token ids through the shuffle.

Memory: a task packs at most ``CHUNK`` pieces at once, a group at most about ``GROUP`` bins.
Null text counts as empty: such a document is the closing id alone.  Repeated rows and rows of one id are packed each.  A null
doc_id is kept.  Very long texts are encoded whole, then cut.  Ties in length go by the order of the rows.  Extra columns, also
ones whose names clash, are ignored.  Empty table: no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import only, written
from .tokens import PRE_TOKEN, byte_letters, default_tokenizer, in_doubt, library

END_ID = 2
#: Pieces that a task packs at once.
CHUNK = 200_000
#: Bins that a group of a later round holds, about.
GROUP = 40_000
#: Later rounds go to this many groups at least while there are more bins than FEW, so that no task takes most of them.
GROUPS, FEW, ROUNDS = 32, 250, 4
#: A bin with at most this share of a sequence left over is nearly full.
SLACK = 1 / 128

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("bin_id", pa.int64()), ("bin_offset", pa.int64()), ("bin_fill", pa.int64())])


class BestFit:
    """Bins by the room left in them; a bit for each room size that some bin has."""

    def __init__(self, size: int):
        self.size, self.rooms, self.bits, self.fill = size, {}, 0, []

    def put(self, n: int) -> tuple[int, int]:
        """(bin, offset) of an item of length n: the bin with the least room that holds it, or a new one."""
        if ahead := self.bits >> n:
            room = n + (ahead & -ahead).bit_length() - 1
            bin_ = self.rooms[room].pop()
            if not self.rooms[room]:
                self.bits &= ~(1 << room)
        else:
            room, bin_ = self.size, len(self.fill)
            self.fill.append(0)
        at = self.fill[bin_]
        self.fill[bin_] = at + n
        if left := room - n:
            self.rooms.setdefault(left, []).append(bin_)
            self.bits |= 1 << left
        return bin_, at


def pack_lengths(lengths: list[int], size: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item, and the bins' fills; longest items first, ties in the order given."""
    fit, bins, offsets = BestFit(size), [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bins[i], offsets[i] = fit.put(lengths[i])
    return bins, offsets, fit.fill


class Tokeniser:
    """Text -> its ids as little-endian unsigned 32-bit bytes, equal to the tokenizers library's.

    Where the vocabulary's ids run in merge order, ordinary texts are encoded by tiktoken over the same vocabulary, which is
    about three times as fast; texts with special tokens or doubtful characters, texts that it gives up on, and other
    vocabularies are encoded by the library itself.
    """

    def __init__(self, path: str):
        import tiktoken

        self.tok = library(path)
        self.specials = tuple(t.content for t in self.tok.get_added_tokens_decoder().values())
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        letter = byte_letters()
        special = set(self.specials)
        vocab = {w: i for w, i in spec["model"]["vocab"].items() if w not in special}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        plain = spec["normalizer"] is None and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.quick = None
        if plain and merged == sorted(merged) and max(vocab.values()) == len(vocab) - 1:
            ranks = {bytes(letter[c] for c in w): i for w, i in vocab.items()}
            self.quick = tiktoken.Encoding("vocabulary", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.quick is not None and not any(s in text for s in self.specials) and not in_doubt(text):
            try:
                return self.quick.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
            except ValueError:  # its expressions give up on about a million white-space characters in a row
                pass
        return np.asarray(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones behind a first that takes the remainder."""
    first = n % size or size
    return [(0, first), *((s, size) for s in range(first, n, size))]


def _local(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenise, end = Tokeniser(path), END_ID.to_bytes(4, "little")
        rows: list[tuple[int, int, int, int, int]] = []
        n_bins = 0

        def packed() -> pa.RecordBatch:
            nonlocal rows, n_bins
            bins, offsets, fills = pack_lengths([r[3] for r in rows], size)
            base = (TaskContext.get().partitionId() << 36) + n_bins
            n_bins += len(fills)
            cols = [*zip(*rows, strict=True), [base + b for b in bins], offsets, [fills[b] for b in bins]]
            rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, PIECES, strict=True)], schema=PIECES)

        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, text in zip(ids_of, texts, strict=True):
                ids = tokenise(text) + end
                for k, (start, n) in enumerate(cut(len(ids) // 4, size)):
                    rows.append((doc_id, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])))
                if len(rows) >= CHUNK:
                    yield packed()
        if rows:
            yield packed()

    return run


_MOVED = "first_bin long, bin long, base long, fill long"


def _again(size: int):
    def run(group: pa.Table) -> pa.Table:
        first, bin_, base, fill = (group.column(c).to_pylist() for c in ("first_bin", "bin", "base", "fill"))
        items = sorted(dict(zip(bin_, fill, strict=True)).items())
        bins, offsets, fills = pack_lengths([n for _, n in items], size)
        head: dict[int, int] = {}
        for (b, _), k in zip(items, bins, strict=True):
            head.setdefault(k, b)
        place = {b: (head[k], o, fills[k]) for (b, _), k, o in zip(items, bins, offsets, strict=True)}
        cols = [first, [place[b][0] for b in bin_], [x + place[b][1] for x, b in zip(base, bin_, strict=True)], [place[b][2] for b in bin_]]
        return pa.table(dict(zip(("first_bin", "bin", "base", "fill"), (pa.array(c, pa.int64()) for c in cols), strict=True)))

    return run


def pack(docs: DataFrame, size: int = 1024, tokenizer: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs`` (doc_id, text)."""
    rows = only(docs, "doc_id", "text")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, bin_id long, bin_offset long, bin_fill long"
    pieces = written(rows.mapInArrow(_local(tokenizer or default_tokenizer(), size), schema), "pieces")

    full = size - int(size * SLACK)
    left = (
        pieces.where(F.col("bin_fill") < full)
        .groupBy(F.col("bin_id").alias("first_bin"))
        .agg(F.max("bin_fill").alias("fill"))
        .select("first_bin", F.col("first_bin").alias("bin"), F.lit(0).cast("long").alias("base"), "fill")
    )
    done: list[DataFrame] = []
    bins = left.count()
    for k in range(ROUNDS):
        if bins <= 1:
            break
        groups = 1 if bins <= FEW else max(GROUPS, -(-bins // GROUP)) >> k or 1
        groups = groups if bins <= FEW else max(GROUPS, groups)
        keyed = left.withColumn("grp", F.pmod(F.xxhash64("bin", F.lit(k)), F.lit(groups)))
        moved = written(keyed.groupBy("grp").applyInArrow(_again(size), _MOVED), "bins")
        done.append(moved.where(F.col("fill") >= full))
        left = moved.where(F.col("fill") < full)
        before, bins = bins, left.select("bin").distinct().count()
        if groups == 1 or bins > 0.98 * before:
            break
    places = left
    for d in done:
        places = places.unionByName(d)
    return pieces.join(places.select(F.col("first_bin").alias("bin_id"), "bin", "base"), "bin_id", "left").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("bin", "bin_id").alias("sequence_id"),
        (F.col("bin_offset") + F.coalesce("base", F.lit(0))).alias("offset"),
    )

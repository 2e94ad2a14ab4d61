"""Approximate nearest neighbours by randomly rotated one-bit codes (operator 2), after RaBitQ (Gao and Long, SIGMOD 2024).

A vector's code is the signs of its randomly rotated direction (padded to ``CODE`` bits at least); with the code go its norm and
the inner product of direction and code.  From the packed bits and those two scalars a query estimates every inner product, and
the estimate's error bound tells which vectors could still be among the nearest: those are reranked by exact inner products.

Rows with the same vector form one class and are searched once; a class carries its ``k + 1`` least ids, which is all that any
answer can hold.  Query ids stay in rows of their own and get their class's answer at the end, in ``SALTS`` parts a class.

Classes and queries are dealt over a grid of blocks (query block x candidate block).  Blocks are measured in bytes of vectors, so
long vectors make smaller ones.  Whole vectors go along with the codes: queries are a fixed share of all rows, and what one query
may leave out, another of its block must rerank; fetching each query's own candidates by id would move many times more.  Each
block answers with its best rows, which are merged ``MERGE`` blocks at a time, then over all.  No task holds more than a block of
either side, and nothing but sums reaches the driver.

Vectors that are null, empty, zero or hold null or non-finite components take no part.  Vectors of different lengths are no
candidates of each other.  Rows of one id and one vector are one candidate; rows that share the query's id are its own.
Ties go to the smaller vec_id.  Null ids take no part.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import only, written

NEAREST, EVERY, SEED = 20, 20, 7
#: Bits of a code, at least; the error falls with their root.
CODE = 128
#: Standard deviations of the error bound.  At 3 a vector is wrongly left out about once in a thousand.
EPSILON = 3.0
#: Bytes of vectors in a block, of queries and of candidates; candidate blocks at least; blocks merged at once; parts of a class's queries.
BLOCK_BYTES, BLOCKS, MERGE, SALTS = 32 << 20, 32, 64, 16
#: Pairs, and queries at most, that a block looks at together.
STEP, QUERIES = 1 << 22, 256


def _usable(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        if i is None or not v.is_valid:
            continue
        values = v.values
        if values.null_count or not len(values):
            continue
        x = values.to_numpy(zero_copy_only=False).astype("<f8")
        if np.isfinite(x).all() and x.any():
            yield i, x


def _classes(k: int, every: int):
    """Per task: a row for each different vector with its least ids, and all its query ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, tuple[set[int], set[int]]] = {}
            for i, x in _usable(batch):
                ids, asked = found.setdefault(x.tobytes(), (set(), set()))
                ids.add(i)
                if i % every == 0:
                    asked.add(i)
            least = [sorted(ids)[: k + 1] for ids, _ in found.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(least, pa.list_(pa.int64())), pa.array([sorted(q) for _, q in found.values()], pa.list_(pa.int64()))], names=["vec", "ids", "asked"])

    return run


@functools.cache
def rotation(dim: int) -> np.ndarray:
    """dim orthonormal rows in as many dimensions as a code has bits."""
    bits = max(CODE, -(-dim // 64) * 64)
    q, _ = np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((bits, bits)))
    return np.ascontiguousarray(q[:, :dim].T, np.float32)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, norms, inner products of direction and code) of rows."""
    norms = np.linalg.norm(vectors, axis=1)
    norms = np.where(np.isfinite(norms), norms, np.finfo(float).max)
    turned = (vectors / norms[:, None]).astype(np.float32) @ rotation(vectors.shape[1])
    bits = turned > 0
    return np.packbits(bits, axis=1), norms, np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])


def estimates(codes: np.ndarray, along: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines of queries (rows) with coded vectors (columns), estimated, and the bound of each column's error."""
    dim = queries.shape[1]
    turned = (queries / np.linalg.norm(queries, axis=1)[:, None]).astype(np.float32) @ rotation(dim)
    n = turned.shape[1]
    signs = np.unpackbits(codes, axis=1, count=n).astype(np.float32) * 2 - 1
    cos = turned @ (signs / (np.sqrt(n) * along)[:, None].astype(np.float32)).T
    bound = EPSILON * np.sqrt(np.maximum(0, 1 - along**2)) / along / np.sqrt(n - 1)
    return cos, bound.astype(np.float32)


def search_block(vectors: np.ndarray, codes: np.ndarray, norms: np.ndarray, along: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: (its number, candidates, exact inner products) of at least its k best, ties at the end included."""
    scale = norms.astype(np.float32)
    step = max(1, min(QUERIES, STEP // len(vectors)))
    for at in range(0, len(queries), step):
        part = queries[at : at + step]
        cos, bound = estimates(codes, along, part)
        size = np.linalg.norm(part, axis=1)
        cos *= scale
        first = min(2 * k, len(vectors))
        if first < len(vectors):
            top = np.argpartition(-cos, first - 1, axis=1)[:, :first]
        else:
            top = np.tile(np.arange(len(vectors)), (len(part), 1))
        exact = np.einsum("qcd,qd->qc", vectors[top], part)
        least = np.sort(exact, axis=1)[:, max(0, exact.shape[1] - k)]  # of the first ones, the k-th best exactly
        near = cos + bound * scale >= (least / size).astype(np.float32)[:, None] - 1e-5 * np.abs(least / size).astype(np.float32)[:, None]
        np.put_along_axis(near, top, True, axis=1)
        for q in range(len(part)):
            who = np.nonzero(near[q])[0]
            score = vectors[who] @ part[q] if len(who) < 2 else np.einsum("cd,d->c", vectors[who], part[q])
            if len(who) > k:
                keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                who, score = who[keep], score[keep]
            yield at + q, who, score


def _stacked(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Binary values of one length as rows of numbers, a copy of the bytes and nothing more."""
    width = len(column[0].as_py()) // np.dtype(kind).itemsize
    out = np.empty((len(column), width), kind)
    at = 0
    for chunk in column.chunks:
        start, end = (np.frombuffer(chunk.buffers()[1], np.int32)[i].item() for i in (chunk.offset, chunk.offset + len(chunk)))
        out[at : at + len(chunk)] = np.frombuffer(chunk.buffers()[2], np.uint8)[start:end].view(kind).reshape(-1, width)
        at += len(chunk)
    return out


def _search(k: int):
    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        rows: tuple[list, list, list] = ([], [], [])
        if asked.num_rows and held.num_rows:
            queries, vectors, codes = _stacked(asked.column("vec"), "<f8"), _stacked(held.column("vec"), "<f8"), _stacked(held.column("code"), "u1")
            norms, along = held.column("norm").to_numpy(), held.column("along").to_numpy()
            names, ids = asked.column("name").to_pylist(), held.column("ids").to_pylist()
            for q, who, score in search_block(vectors, codes, norms, along, queries, k + 1):
                best = sorted((-s, i) for c, s in zip(who.tolist(), score.tolist(), strict=True) for i in ids[c])[: k + 1]
                rows[0].append(names[q])
                rows[1].append([i for _, i in best])
                rows[2].append([-s for s, _ in best])
        return pa.table(
            {"name": pa.array(rows[0], pa.string()), "c": pa.array([key[2].as_py()] * len(rows[0]), pa.int32()), "ids": pa.array(rows[1], pa.list_(pa.int64())), "scores": pa.array(rows[2], pa.list_(pa.float64()))}
        )

    return run


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes, norms and inner products of a batch's vectors, those of one length together."""
    for batch in batches:
        m = batch.num_rows
        codes, norms, along = [b""] * m, np.zeros(m), np.zeros(m)
        raw = batch.column(1).to_pylist()
        size = np.array([len(v) for v in raw])
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            c, norms[at], along[at] = encode(np.frombuffer(b"".join([raw[i] for i in at]), "<f8").reshape(len(at), -1))
            for i, row in zip(at.tolist(), c, strict=True):
                codes[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(codes, pa.binary()), pa.array(norms), pa.array(along)], names=["name", "vec", "ids", "code", "norm", "along"])


def nearest(vectors: DataFrame, k: int = NEAREST, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row of ``vectors`` (vec_id, embedding) whose id ``every`` divides."""
    parts = written(only(vectors, "vec_id", "embedding").mapInArrow(_classes(k, every), "vec binary, ids array<long>, asked array<long>"), "parts")
    classes = written(
        parts.groupBy("vec")
        .agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"), F.max(F.size("asked") > 0).alias("asked"))
        .withColumn("name", F.md5("vec"))
        .withColumn("dim", (F.length("vec") / 8).cast("int")),
        "vectors",
    )
    size = F.length("vec").cast("long")
    total = classes.agg(F.sum(size).alias("n"), F.sum(F.when(F.col("asked"), size)).alias("q")).first()
    n_blocks, q_blocks = max(BLOCKS, -(-(total.n or 0) // BLOCK_BYTES)), max(1, -(-(total.q or 0) // BLOCK_BYTES))
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n: F.pmod(F.xxhash64("name"), F.lit(n)).cast("int")
    coded = classes.select("name", "vec", "ids").mapInArrow(_coded, "name string, vec binary, ids array<long>, code binary, norm double, along double")
    held = coded.withColumns({"dim": (F.length("vec") / 8).cast("int"), "c": block(n_blocks)}).withColumn("q", every_block(q_blocks))
    asked = classes.where("asked").select("name", "vec", "dim", block(q_blocks).alias("q")).withColumn("c", every_block(n_blocks))
    keys = ["dim", "q", "c"]
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(_search(k), "name string, c int, ids array<long>, scores array<double>")
    answers = F.transform(F.arrays_zip("ids", "scores"), lambda x: F.struct((-x["scores"]).alias("s"), x["ids"].alias("vec_id")))
    best = found.select("name", F.floor(F.col("c") / MERGE).alias("some"), answers.alias("best"))
    for keys_left in (["name", "some"], ["name"]):
        best = best.groupBy(*keys_left).agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k + 1).alias("best"))
    queries = parts.select(F.md5("vec").alias("name"), F.explode("asked").alias("query_id")).distinct().withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(SALTS)).cast("int"))
    best = best.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    own = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (
        queries.join(best, ["name", "salt"])
        .select("query_id", F.posexplode(own).alias("at", "x"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))
    )

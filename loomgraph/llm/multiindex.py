"""Approximate nearest neighbours (operator 1): an inverted multi-index.

The two halves of a vector are quantised separately, each by its own K centroids; the pair is the vector's cell. A
query sorts the centroids of either half by distance (the negative inner product) and a heap yields the pairs by
summed distance until the cells visited hold a given share of all entries; these are reranked by the exact inner
product in double precision. Centroids and that share come from a bounded sample (SAMPLE vectors, chosen by a hash
of their id): the share is the least that finds TARGET of the sample's own neighbours. Every row is indexed.

Equal vectors are one entry with their KEEP smallest ids, which are all that a list of KEEP - 1 can need. Runs of cells
are packed into blocks of BLOCK entries, and the queries of runs of cells into blocks of QUERIES (large cells are split),
so queries of one block visit much the same cells. Entries of a block go to the query blocks that visit one of its cells,
and to no others. What the driver holds is the sample and the cells' counts, K * K numbers.

Defined results: vectors that are null, zero, or hold null or non-finite components, and those of another length than
most of the sample, take no part; ties go to the smaller id; rows of one id never answer each other's query;
null ids take no part; fewer candidates than k are all returned; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CENTROIDS, SAMPLE, TARGET, BLOCK, QUERIES = 128, 8192, 0.93, 8192, 2048


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        sums = np.stack([np.bincount(near, weights=x[:, j], minlength=len(c)) for j in range(x.shape[1])], 1)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c**2).sum(1) - 2 * x @ c.T).argmin(1)


def visit(d1: np.ndarray, d2: np.ndarray, counts: list[int], enough: float) -> list[int]:
    """Cells (i * len(d2) + j) by rising d1[i] + d2[j] until they hold enough entries. The heap has the next pair of each
    row i begun; row i + 1 begins once row i's first pair is out, as none of its pairs can come before."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2, r1, r2 = d1[o1].tolist(), d2[o2].tolist(), (o1 * len(d2)).tolist(), o2.tolist()
    n1, n2, heap, out, held = len(s1), len(s2), [(s1[0] + s2[0], 0, 0)], [], 0
    advance, begin = heapq.heapreplace, heapq.heappush
    while heap and held < enough:
        _, i, j = heap[0]
        if n := counts[cell := r1[i] + r2[j]]:
            out.append(cell)
            held += n
        if j + 1 < n2:
            advance(heap, (s1[i] + s2[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < n1:
            begin(heap, (s1[i + 1] + s2[0], i + 1, 0))
    return out


class Index:
    """Centroids of the halves and the share of entries to visit."""

    def __init__(self, sample: np.ndarray, centroids: int, k: int, target: float):
        self.half, centroids = sample.shape[1] // 2, min(centroids, max(8, len(sample) // 16))
        self.c1, self.c2 = kmeans(sample[:, : self.half], centroids), kmeans(sample[:, self.half :], centroids)
        cells = self.cells(sample)
        q = sample[:: max(1, len(sample) // 256)]
        d1, d2 = self.distances(q)
        ip = q @ sample.T
        top = np.argsort(-ip, 1)[:, 1 : k + 1]  # the first is the query itself or its equal
        order = (d1[:, cells // len(self.c2)] + d2[:, cells % len(self.c2)]).argsort(1).argsort(1)
        depth = np.sort(np.take_along_axis(order, top, 1).ravel() + 1) if top.size else np.array([len(sample)])
        self.share = float(depth[min(len(depth) - 1, int(np.ceil(target * len(depth))))]) / len(sample)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, : self.half], self.c1) * len(self.c2) + nearest(x[:, self.half :], self.c2)

    def distances(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return -q[:, : self.half] @ self.c1.T, -q[:, self.half :] @ self.c2.T


def _usable(ids: list, vectors: list) -> tuple[list, list[np.ndarray]]:
    a, b = [], []
    for i, v in zip(ids, vectors):
        if i is None or v is None or not v or None in v:
            continue
        x = np.array(v, np.float64)
        if np.isfinite(x).all() and x.any():
            a.append(i), b.append(x)
    return a, b


def counts_of(celled: DataFrame, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for r in celled.groupBy("cell").count().collect():  # as many rows as cells
        out[r["cell"]] = r["count"]
    return out


def packed(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, blocks) of each cell: runs of cells of about size share a block, a larger cell has several to itself."""
    first, parts, block, held = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), 0, 0
    for c, n in enumerate(counts.tolist()):
        if held and held + n > size:
            block, held = block + 1, 0
        first[c], parts[c] = block, common.pages_of(n, size)
        if parts[c] > 1:
            block, held = block + parts[c], 0
        else:
            held += n
    return first, parts


def _celled(batches, index: Index):
    for b in batches:
        if b.num_rows:
            x = np.frombuffer(b"".join(b.column(0).to_pylist()), np.float64).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(index.cells(x), pa.int32())], ["vec", "qkey", "cell"])


def _entries(batches, index: Index, dim: int, keep: int):
    """(cell, vec, ids): the distinct vectors of each batch and their smallest ids there."""
    for batch in batches:
        held: dict[bytes, list[int]] = {}
        for i, x in zip(*_usable(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if len(x) == dim:
                held.setdefault((x + 0.0).tobytes(), []).append(i)
        if held:
            x = np.frombuffer(b"".join(held), np.float64).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([pa.array(index.cells(x), pa.int32()), pa.array(list(held), pa.binary()), pa.array([sorted(set(v))[:keep] for v in held.values()], pa.list_(pa.int64()))], ["cell", "vec", "ids"])


def _top(score: np.ndarray, ids: list, keep: int) -> list[tuple[float, int]]:
    """The keep best (score, id) of entries with several ids each."""
    if len(score) > keep:
        least = np.partition(score, len(score) - keep)[len(score) - keep]
        pick = np.flatnonzero(score >= least)
    else:
        pick = np.arange(len(score))
    return sorted(((float(score[p]), int(i)) for p in pick for i in ids[p]), key=lambda t: (-t[0], t[1]))[:keep]


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", centroids: int = CENTROIDS, sample: int = SAMPLE, target: float = TARGET) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each row of queries among vectors, both with
    id_col and vector_col."""
    spark, keep = vectors.sparkSession, k + 1
    scratch = common.Scratch(spark, "multiindex")
    cols = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    base, asked = cols(vectors), cols(queries)
    few = base.filter("id is not null and v is not null").orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    drawn = _usable([r["id"] for r in few], [r["v"] for r in few])[1]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not drawn:
        return empty
    dim = Counter(map(len, drawn)).most_common(1)[0][0]
    index = spark.sparkContext.broadcast(Index(np.stack([x for x in drawn if len(x) == dim]), centroids, k, target))
    n2 = len(index.value.c2)
    found = base.mapInArrow(lambda it: _entries(it, index.value, dim, keep), "cell int, vec binary, ids array<long>")
    found = found.groupBy("cell", "vec").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"))
    entries = scratch.save("entries", found)
    counts = counts_of(entries, len(index.value.c1) * n2)
    plan = spark.sparkContext.broadcast((counts, *packed(counts, BLOCK)))
    q = scratch.save("queries", asked.mapInArrow(lambda it: _queries(it, dim), "id long, vec binary").distinct())
    one = q.groupBy("vec").agg(F.min("id").alias("qkey")).mapInArrow(lambda it: _celled(it, index.value), "vec binary, qkey long, cell int")
    one = scratch.save("distinct", one)
    subs = spark.sparkContext.broadcast(packed(counts_of(one, len(counts)), QUERIES))
    visits = one.mapInArrow(lambda it: _visits(it, index.value, plan.value, subs.value, n2), "block int, sub int, qkey long, vec binary, cells array<int>")
    visits = scratch.save("visits", visits)
    placed = entries.mapInArrow(lambda it: _placed(it, plan.value), "block int, cell int, vec binary, ids array<long>")
    placed = placed.join(scratch.save("pairs", visits.select("block", "sub").distinct()), "block")

    def meet(qs: pd.DataFrame, es: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(qs) and len(es):
            e = np.frombuffer(b"".join(es["vec"]), np.float64).reshape(-1, dim)
            ids, (have, at) = es["ids"].tolist(), np.unique(es["cell"].to_numpy(), return_inverse=True)
            for s in range(0, len(qs), 256):
                part = qs.iloc[s : s + 256]
                score = np.frombuffer(b"".join(part["vec"]), np.float64).reshape(-1, dim) @ e.T
                for key, cells, row in zip(part["qkey"], part["cells"], score):
                    pick = np.flatnonzero(np.isin(have, cells)[at])
                    out += [(key, i, x) for x, i in _top(row[pick], [ids[p] for p in pick], keep)]
        return pd.DataFrame(out, columns=["qkey", "vec_id", "score"])

    hits = visits.groupBy("block", "sub").cogroup(placed.groupBy("block", "sub")).applyInPandas(meet, "qkey long, vec_id long, score double")
    best = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    hits = hits.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= keep).groupBy("qkey").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))
    per = q.join(one, "vec").join(hits, "qkey").select(F.col("id").alias("query_id"), F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, k).alias("near"))
    return per.select("query_id", F.posexplode("near").alias("p", "x")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def _queries(batches, dim: int):
    for b in batches:
        ids, x = _usable(b.column(0).to_pylist(), b.column(1).to_pylist())
        ok = [k for k, v in enumerate(x) if len(v) == dim]
        yield pa.RecordBatch.from_arrays([pa.array([ids[k] for k in ok], pa.int64()), pa.array([(x[k] + 0.0).tobytes() for k in ok], pa.binary())], ["id", "vec"])


def _visits(batches, index: Index, plan, subs, n2: int):
    """The blocks that each query visits, and which of their cells."""
    counts, first, parts = plan
    total = int(counts.sum())
    listed = counts.tolist()
    for b in batches:
        if not b.num_rows:
            continue
        vecs, keys, own = (b.column(i).to_pylist() for i in range(3))
        d1, d2 = index.distances(np.frombuffer(b"".join(vecs), np.float64).reshape(b.num_rows, -1))
        rows = []
        for key, vec, c, x, y in zip(keys, vecs, own, d1, d2):
            sub = int(subs[0][c]) + zlib.crc32(vec) % int(subs[1][c])
            cells = np.array(visit(x, y, listed, max(index.share * total, 1)), np.int32)
            # a cell of several blocks shares none of them, so the first cell of a block tells how many there are
            blocks, where = np.unique(first[cells], return_inverse=True)
            cells = cells[np.argsort(where, kind="stable")]
            for blk, of in zip(blocks.tolist(), np.split(cells, np.cumsum(np.bincount(where))[:-1])):
                rows += [(blk + p, sub, key, vec, of) for p in range(int(parts[of[0]]))]
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int32())))], ["block", "sub", "qkey", "vec", "cells"])


def _placed(batches, plan):
    _, first, parts = plan
    for b in batches:
        cells, vecs = b.column(0).to_pylist(), b.column(1).to_pylist()
        blocks = [int(first[c]) + (zlib.crc32(v) % int(parts[c]) if parts[c] > 1 else 0) for c, v in zip(cells, vecs)]
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), *b.columns], ["block", "cell", "vec", "ids"])

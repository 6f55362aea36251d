"""Exact nearest neighbours by a two-round metric join over Voronoi cells.

Pivots are corpus rows chosen by hash; every row belongs to its nearest pivot. A cell is cut by
hash into blocks of at most about BLOCK rows. In the first round a query meets one block of its own
cell, which bounds the distance of its k-th neighbour. By the triangle inequality a cell can hold
something nearer only if the query is within that distance of the cell's radius and of the plane
between the two pivots; the second round sends each query to the blocks of those cells alone. The
best k of both rounds are the answer, whatever the number of rows: there is no other method for
small or large tables. Of equal corpus rows only the few with the smallest ids take part.

A task reads a block, then answers its questions as they stream by; a block with many questions is
sent once for every so many of them. Where the bounds cannot tell cells apart, as in many
dimensions, the join does compare all pairs, block by block; there blocks grow with the corpus, so
that every row is sent about SENT times whatever their number, up to MOST_BLOCK rows a block. Of
these pairs a matrix product in single precision tells which may lie within the first round's bound,
with room for its rounding; only their distances are computed, dimension by dimension, so that they
equal a plain computation to the last bit. Ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.session import written

#: Corpus rows of a block, and questions answered by one copy of it.
BLOCK, ASKED = 1024, 512
#: Most pivots; beyond, cells have more blocks.
PIVOTS = 1024
#: Above so many dimensions blocks hold a SENT-th of the corpus, and as many questions; never more rows than MOST_BLOCK.
FEW, SENT, MOST_BLOCK = 4, 16, 32768
METRICS = ("euclidean", "manhattan")
#: Questions and rows of one product, and pairs whose distances are held at once.
TILE_ASKED, TILE_ROWS, TILE_PAIRS = 256, 4096, 1 << 16


def distances(a: np.ndarray, b: np.ndarray, metric: str = "euclidean") -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        gap = a[:, i, None] - b[None, :, i]
        total += gap * gap if metric == "euclidean" else np.abs(gap)
    return np.sqrt(total) if metric == "euclidean" else total


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _placed(pivots: np.ndarray, metric: str):
    """Nearest pivot of every row, and its distance."""

    @F.pandas_udf("cell int, away double")
    def place(vectors: pd.Series) -> pd.DataFrame:
        if not len(vectors):
            return pd.DataFrame({"cell": [], "away": []})
        gaps = distances(np.stack(vectors.to_numpy()), pivots, metric)
        at = gaps.argmin(1)
        return pd.DataFrame({"cell": at.astype(np.int32), "away": gaps[np.arange(len(at)), at]})

    return place


def _worth(pivots: np.ndarray, radius: np.ndarray, blocks: np.ndarray, metric: str):
    """Blocks (cell * most blocks of a cell + block) that may hold something nearer, but the first of the own cell."""
    between, width = distances(pivots, pivots, metric), max(1, int(blocks.max()))
    code = np.arange(len(blocks) * width, dtype=np.int64)
    there = code % width < np.repeat(blocks, width)

    def worth(vectors: np.ndarray, own: np.ndarray, floor: np.ndarray) -> list[np.ndarray]:
        gaps = distances(vectors, pivots, metric)
        mine = gaps[np.arange(len(own)), own][:, None]
        # Nothing in the cell is nearer than the edge of its ball or the surface between the pivots.
        least = np.maximum(gaps - radius[None, :], (gaps - mine) / 2)
        if metric == "euclidean":
            apart = between[own]
            plane = (gaps ** 2 - mine ** 2) / np.where(apart > 0, 2 * apart, np.inf)
            least = np.maximum(least, plane)
        near = least <= floor[:, None] + 1e-9 * (1 + gaps)
        return [code[np.repeat(row, width) & there & (code != home * width)] for row, home in zip(near, own)]

    @F.pandas_udf("array<long>")
    def ask(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for vectors, own, floor in parts:
            found: list[np.ndarray] = []
            for i in range(0, len(own), 256):
                found += worth(np.stack(vectors[i:i + 256].to_numpy()), own[i:i + 256].to_numpy(), floor[i:i + 256].to_numpy())
            yield pd.Series(found, dtype=object)

    return ask


def _answer(k: int, dim: int, metric: str, others: bool):
    """Rows sorted by (cell, block, chunk, asks): a block's corpus, then its questions."""

    def exact(some: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Distance of each row to its partner; a running sum adds dimension after dimension."""
        d = np.abs(some - other)
        return np.sqrt(np.cumsum(d * d, 1)[:, -1]) if metric == "euclidean" else np.cumsum(d, 1)[:, -1]

    def plain(ids, corpus, asked, queries, floor):
        """(question, row) pairs that may be among the k nearest, from all distances."""
        for i in range(0, len(asked), 64):
            gaps, limit = distances(queries[i:i + 64], corpus, metric), floor[i:i + 64] * (1 + 1e-9)
            if others:
                gaps[asked[i:i + 64, None] == ids[None, :]] = np.inf
            if len(ids) > k:
                limit = np.minimum(limit, np.partition(gaps, k - 1, axis=1)[:, k - 1] * (1 + 1e-9))
            x, near = np.nonzero((gaps <= limit[:, None]) & np.isfinite(gaps))
            yield x + i, near

    def multiplied(ids, corpus, asked, queries, floor, norms, sizes):
        """The same pairs, told by a product in single precision.

        A question is (-2 q, 1, |q|^2 - limit^2) and a row (c, |c|^2, 1), so their product is at most 0
        within the limit. Both squares are shrunk and the limit is stretched by more than the sum of
        dim + 2 terms can be off, whatever their order, so no pair within the limit is lost.
        """
        slack = 4 * (dim + 8) * 2.0 ** -24
        one = np.ones((len(corpus), 1))
        rows = np.hstack([corpus, norms[:, None] * (1 - slack), one]).astype(np.float32)
        order = np.argsort(ids, kind="stable")
        low, high = (np.searchsorted(ids[order], asked, side) for side in ("left", "right"))
        for i in range(0, len(asked), TILE_ASKED):
            some, size = queries[i:i + TILE_ASKED], sizes[i:i + TILE_ASKED]
            told = np.hstack([-2.0 * some, np.ones((len(some), 1)), size[:, None] * (1 - slack)])
            limit = floor[i:i + TILE_ASKED].copy()
            open_ = np.flatnonzero(np.isinf(limit))
            for a in range(0, len(open_) if len(ids) > k + int(others) else 0, 16):
                # Any k rows bound the k-th distance; those that look nearest bound it well.
                at = open_[a:a + 16]
                gaps = told[at].astype(np.float32) @ rows.T
                if others:
                    for x in np.flatnonzero(high[i + at] > low[i + at]):
                        gaps[x, order[low[i + at[x]]:high[i + at[x]]]] = np.inf
                near = np.argpartition(gaps, k - 1, axis=1)[:, :k]
                far = exact(np.repeat(some[at], k, axis=0), corpus[near.ravel()]).reshape(-1, k).max(1)
                limit[at] = np.where(np.isfinite(np.take_along_axis(gaps, near, 1)).all(1), far, np.inf)
            with np.errstate(over="ignore"):
                told[:, -1] -= limit * limit * (1 + slack) + 1e-30
                told = told.astype(np.float32)
            for j in range(0, len(rows), TILE_ROWS):
                tile = told @ rows[j:j + TILE_ROWS].T
                x, near = np.divmod(np.flatnonzero(tile <= 0), tile.shape[1])
                if others:
                    keep = ids[near + j] != asked[x + i]
                    x, near = x[keep], near[keep]
                yield x + i, near + j

    def best(ids: np.ndarray, corpus: np.ndarray, asked: np.ndarray, queries: np.ndarray, floor: np.ndarray
             ) -> Iterator[pa.RecordBatch]:
        if not len(ids):
            return
        with np.errstate(over="ignore", invalid="ignore"):
            norms, sizes = (corpus * corpus).sum(1), (queries * queries).sum(1)
        rounded = metric == "euclidean" and float(norms.max()) < 1e30 and float(sizes.max()) < 1e30
        for i in range(0, len(asked), TILE_ASKED):
            part = slice(i, i + TILE_ASKED)
            given = ids, corpus, asked[part], queries[part], floor[part]
            pairs = list(multiplied(*given, norms, sizes[part]) if rounded else plain(*given))
            x, near = (np.concatenate(p) for p in zip(*pairs))
            found = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
            for a in range(0, len(x), TILE_PAIRS):  # the best so far and the next pairs
                y, z = x[a:a + TILE_PAIRS], near[a:a + TILE_PAIRS]
                got = y, exact(queries[i + y], corpus[z]), ids[z]
                found = [np.concatenate(f) for f in zip(found, got)]
                by = np.lexsort((found[2], found[1], found[0]))
                found = [f[by] for f in found]
                first = np.searchsorted(found[0], found[0], "left")
                found = [f[np.arange(len(first)) - first < k] for f in found]
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(asked[i + found[0]].astype(np.int64)), "d": pa.array(found[1].astype(float)),
                "j": pa.array(found[2].astype(np.int64))})

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, rows = None, [], []
        for part in parts:
            if not part.num_rows:
                continue
            keys = np.stack([part.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                             for c in ("cell", "block", "chunk", "asks")], axis=1)
            cuts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
            own, vectors = part.column("id").to_numpy(), _matrix(part.column("vec"), dim)
            floor = part.column("floor").to_numpy()
            for a, b in zip(cuts, np.append(cuts[1:], len(keys))):
                if tuple(keys[a, :3]) != key:
                    key, ids, rows = tuple(keys[a, :3]), [], []
                if not keys[a, 3]:
                    ids.append(own[a:b])
                    rows.append(vectors[a:b])
                    continue
                if len(ids) > 1:
                    ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
                yield from best(ids[0] if ids else own[:0], rows[0] if rows else vectors[:0], own[a:b], vectors[a:b], floor[a:b])

    return run


def _met(held: DataFrame, asked: DataFrame, k: int, dim: int, metric: str, others: bool, at_once: int) -> DataFrame:
    chunks = asked.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / at_once).cast("int").alias("_chunks"))
    chunks = written(chunks, "chunks")
    sent = held.join(chunks, ["cell", "block"]).select(
        "cell", "block", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("chunk"),
        F.lit(False).alias("asks"), "id", F.lit(0.0).alias("floor"), "vec")
    asked = asked.join(chunks, ["cell", "block"]).select(
        "cell", "block", F.pmod(F.xxhash64("id", F.lit(7)), F.col("_chunks")).cast("int").alias("chunk"),
        F.lit(True).alias("asks"), "id", "floor", "vec")
    return sent.union(asked).repartition("cell", "block", "chunk").sortWithinPartitions(
        "cell", "block", "chunk", "asks").mapInArrow(_answer(k, dim, metric, others), "id long, d double, j long")


def nearest(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "euclidean", others: bool = False,
            block: int | None = None) -> DataFrame:
    """(id, d, j): the ``k`` nearest corpus rows ``j`` of every query; ``others`` leaves its own id out.

    Both frames have a unique long ``id`` and a double array ``vec`` of one length, without nulls.
    The driver holds the pivots and a count and radius for each.
    """
    assert metric in METRICS
    # Ties go to smaller ids, so of equal rows no more than the first few can be anyone's answer.
    alike = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    corpus = written(corpus.select("id", "vec", alike.alias("_copy")).where(
        F.col("_copy") <= k + int(others)).drop("_copy"), "corpus")
    queries = written(queries.select("id", "vec"), "queries")
    n = corpus.count()
    if not n:
        return queries.sparkSession.createDataFrame([], "id long, d double, j long")
    dim, at_once = len(corpus.first()["vec"]), ASKED
    if block is None:
        block = BLOCK if dim <= FEW else min(MOST_BLOCK, max(BLOCK, math.ceil(n / SENT)))
        at_once = max(ASKED, block)
    count = min(PIVOTS, max(1, math.ceil(n / block)))
    drawn = corpus.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(count).collect()
    pivots = np.unique(np.array([r["vec"] for r in drawn], float), axis=0)
    place = _placed(pivots, metric)
    held = written(corpus.withColumn("_p", place("vec")).select("id", "vec", "_p.*"), "cells")
    radius, blocks = np.zeros(len(pivots)), np.zeros(len(pivots), int)
    for r in held.groupBy("cell").agg(F.max("away").alias("far"), F.count(F.lit(1)).alias("n")).collect():
        radius[r["cell"]], blocks[r["cell"]] = r["far"], -(-r["n"] // block)
    parts = F.get(F.array(*[F.lit(int(b)) for b in np.maximum(blocks, 1)]), F.col("cell"))
    held = written(held.select(
        "cell", F.pmod(F.xxhash64("id", F.lit(5)), parts).cast("int").alias("block"), "id", "vec"), "blocks")
    asked = written(queries.withColumn("_p", place("vec")).select("id", "vec", "_p.cell"), "asked")
    home = asked.withColumn("block", F.lit(0)).withColumn("floor", F.lit(float("inf")))
    first = written(_met(held, home, k, dim, metric, others, at_once), "first-round")
    kth = first.groupBy("id").agg(F.max("d").alias("_far"), F.count(F.lit(1)).alias("_n"))
    more = asked.join(kth, "id", "left").select(
        "id", "vec", "cell", F.when(F.col("_n") >= k, F.col("_far")).otherwise(float("inf")).alias("floor"))
    # A question is written once with the blocks it asks, and repeated only on its way to them.
    more = written(more.select("id", "vec", "floor", _worth(pivots, radius, blocks, metric)(
        "vec", "cell", "floor").alias("_blocks")), "second-questions")
    width = F.lit(max(1, int(blocks.max())))
    more = more.select("id", "vec", "floor", F.explode("_blocks").alias("_w")).select(
        "id", "vec", "floor", F.floor(F.col("_w") / width).cast("int").alias("cell"),
        F.pmod(F.col("_w"), width).cast("int").alias("block"))
    order = Window.partitionBy("id").orderBy("d", "j")
    return first.union(_met(held, more, k, dim, metric, others, at_once)).withColumn(
        "_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


def _copies(ids: np.ndarray, bags: int, share: float, seed: int) -> np.ndarray:
    """How often each bag holds each row: Poisson draws fixed by the row's id."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.int64).view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + (
            np.arange(bags, dtype=np.uint64) + np.uint64(seed * 1_000_003))[None, :] * np.uint64(0xD1B54A32D192ED03)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    times = np.arange(64)
    odds = np.cumsum(np.exp(-share + times * math.log(share) - np.array([math.lgamma(t + 1.0) for t in times])))
    return np.searchsorted(odds, (x >> np.uint64(11)).astype(float) / float(1 << 53), "right")


def bagged_votes(queries: DataFrame, corpus: DataFrame, k: int, bags: int, share: float = 1.0,
                 weighted: bool = False, metric: str = "euclidean", seed: int = 42,
                 block: int | None = None) -> DataFrame:
    """(id, votes): k-nearest votes for class 1, averaged over bootstrap bags.

    A bag holds each corpus row a Poisson number of times, fixed by its id. One join finds enough
    neighbours for all bags; queries for which some bag still lacks neighbours are asked again
    for four times as many, until every bag has k or the corpus is used up.
    """
    rows = written(corpus.select("id", "vec", F.col("label").cast("double")), "bagged")
    n, wanted, done = rows.count(), 6 * k, None
    left = queries.select("id", "vec")
    while True:
        taken = wanted

        @F.pandas_udf("double")
        def vote(near: pd.Series) -> pd.Series:
            out = []
            for found in near:
                ids = np.array([f["j"] for f in found], np.int64)
                held = _copies(ids, bags, share, seed)
                used = np.clip(k - (np.cumsum(held, 0) - held), 0, held).astype(float)
                if (used.sum(0) < k).any() and len(ids) == taken < n:
                    out.append(None)
                    continue
                if weighted:
                    used /= np.maximum(np.array([f["d"] for f in found]), 1e-9)[:, None]
                total = used.sum(0)
                ones = (used * np.array([f["y"] for f in found])[:, None]).sum(0)
                out.append(float(np.where(total > 0, ones / np.maximum(total, 1e-300), 0.5).mean()))
            return pd.Series(out, dtype=float)

        near = nearest(left, rows, min(wanted, n), metric, block=block).join(
            rows.select(F.col("id").alias("j"), F.col("label").alias("y")), "j")
        lists = near.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("d", "j", "y"))).alias("near"))
        votes = written(lists.select("id", vote("near").alias("votes")), "votes")
        sure = votes.where("votes is not null and not isnan(votes)")
        done = sure if done is None else done.unionByName(sure)
        unsure = votes.where("votes is null or isnan(votes)").select("id")
        if wanted >= n or not unsure.head(1):
            return queries.select("id").join(done, "id", "left").select("id", F.coalesce("votes", F.lit(0.5)).alias("votes"))
        left, wanted = written(left.join(unsure, "id", "left_semi"), "asked-again"), 4 * wanted

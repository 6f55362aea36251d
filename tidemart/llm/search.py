"""Exact top-k inner products by dual-tree search over cover trees.

The upper level is Spark's: a bounded sample gives centres, farthest first, so that they cover the
sample; every vector goes to its nearest centre, and a centre's vectors are dealt into blocks of
bounded size. Queries first search one block of their own centre. That gives each a worst score to
beat, and centres whose bound (centre, covering radius) cannot reach it are skipped for that query.

Within a task, a cover tree over the block and another over its queries are walked together. A pair
of nodes is pruned if the largest inner product their centres and covering radii allow lies below
the worst k-th score of the query node. Leaves are compared by one matrix product; scores are whole
numbers far below 2**53, so doubles hold them exactly.

Of vectors that are equal, only the k + 1 least ids can be in a result (ties go to the smaller id),
so a very common vector does not fill its block.

Defined cases: vectors that are null or hold null or non-finite components take no part; vectors of
another length are another space; rows that repeat id and vector count once; null ids take no part;
fewer than k candidates give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import table
from tidemart.session import written

K = 5
#: Sampled vectors and centres chosen among them; rows of a block, and queries of a chunk.
SAMPLE, CENTRES, BLOCK, CHUNK = 512, 32, 8192, 2048
#: Points of a leaf of the data and of the queries, most children of a node, and how much the covering radius shrinks a level.
LEAF, QUERY_LEAF, CHILDREN, SHRINK = 256, 16, 32, 0.7
#: Queries compared with a leaf at once.
ROWS = 64


class Node:
    """Points (places in an array), a centre that covers them within a radius, and children."""

    __slots__ = ("points", "centre", "norm", "radius", "children", "worst")

    def __init__(self, x: np.ndarray, points: np.ndarray, leaf: int):
        self.points = points
        self.centre = x[points].mean(0)
        away = np.sqrt(((x[points] - self.centre) ** 2).sum(1))
        self.radius = float(away.max()) * (1 + 1e-9) + 1e-9
        self.norm = float(np.sqrt((self.centre ** 2).sum()))
        self.children: list[Node] = []
        self.worst = -np.inf
        if len(points) > leaf and away.max() > 0:
            self.children = [Node(x, p, leaf) for p in self._cover(x, points, away, leaf)]

    def _cover(self, x: np.ndarray, points: np.ndarray, away: np.ndarray, leaf: int) -> list[np.ndarray]:
        """Sets around points chosen farthest first until all lie within the next radius.

        Points that so few balls cannot cover have too many dimensions for a bound to tell them
        apart: they stay one leaf, which a matrix product searches faster than smaller nodes.
        """
        own = x[points]
        least, nearest = np.full(len(points), np.inf), np.zeros(len(points), int)
        pick, made = int(away.argmax()), 0
        while made < 2 or least.max() > self.radius * SHRINK:
            if made == CHILDREN:
                return []
            gap = np.sqrt(((own - own[pick]) ** 2).sum(1))
            closer = gap < least
            least[closer], nearest[closer] = gap[closer], made
            made += 1
            pick = int(least.argmax())
            if least[pick] == 0:
                break
        return [points[nearest == i] for i in range(made) if (nearest == i).any()]

    def beat(self, worst: np.ndarray) -> float:
        """The least k-th score among the node's queries."""
        self.worst = float(worst[self.points].min()) if not self.children else min(
            c.worst for c in self.children)
        return self.worst


def dual_search(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, data: np.ndarray,
                data_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of the k best per query, -inf where there are fewer or none at its floor."""
    order = np.argsort(data_ids, kind="stable")
    data, data_ids = data[order], data_ids[order]
    best = np.full((len(queries), k), -np.inf)
    ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    worst = floor.astype(float).copy()
    above: dict[int, Node] = {}

    def link(node: Node) -> None:
        for c in node.children:
            above[id(c)] = node
            link(c)
        node.beat(worst)

    q_root = Node(queries, np.arange(len(queries)), QUERY_LEAF)
    d_root = Node(data, np.arange(len(data)), LEAF)
    link(q_root)

    def bound(q: Node, d: Node) -> float:
        top = float(q.centre @ d.centre) + q.norm * d.radius + d.norm * q.radius + q.radius * d.radius
        return top + 1e-6 * (1 + abs(top))

    heap = [(-bound(q_root, d_root), 0, q_root, d_root)]
    made = 0
    while heap:
        negative, _, q, d = heapq.heappop(heap)
        if -negative < q.worst:
            continue
        if not q.children and not d.children:
            columns = np.sort(d.points)
            for i in range(0, len(q.points), ROWS):
                _compare(queries, query_ids, data, data_ids, q.points[i:i + ROWS], columns, best, ids, worst, k)
            worst[q.points] = np.maximum(worst[q.points], best[q.points, -1])
            node: Node | None = q
            while node is not None:
                node.beat(worst)
                node = above.get(id(node))
            continue
        split = q if q.children and (not d.children or q.radius > d.radius) else d
        for c in split.children:
            pair = (c, d) if split is q else (q, c)
            top = bound(*pair)
            if top >= pair[0].worst:
                made += 1
                heapq.heappush(heap, (-top, made, *pair))
    return best, ids


def _compare(queries, query_ids, data, data_ids, rows, columns, best, ids, worst, k) -> None:
    """Merge the scores of some queries and data (columns in order of id) into the best."""
    names = data_ids[columns]
    score = queries[rows] @ data[columns].T
    own = np.minimum(np.searchsorted(names, query_ids[rows]), len(names) - 1)
    itself = np.flatnonzero(names[own] == query_ids[rows])
    score[itself, own[itself]] = -np.inf
    place = max(0, len(names) - k)
    least = np.maximum(np.partition(score, place, axis=1)[:, place], worst[rows])
    row, column = np.nonzero((score >= least[:, None]) & (score > -np.inf))
    row = np.concatenate((row, np.repeat(np.arange(len(rows)), k)))
    value = np.concatenate((score[row[:len(column)], column], best[rows].ravel()))
    name = np.concatenate((names[column], ids[rows].ravel()))
    order = np.lexsort((name, -value, row))
    row, value, name = row[order], value[order], name[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    first = rank < k  # every query has k entries or more
    best[rows], ids[rows] = value[first].reshape(-1, k), name[first].reshape(-1, k)


def whole_numbers(vector: Column) -> Column:
    """floor(256 x) of each component as double; null unless all are finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(vector.isNotNull() & good, F.transform(
        vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("double")))


def _farthest_first(x: np.ndarray, count: int) -> np.ndarray:
    chosen, least = [0], np.full(len(x), np.inf)
    while len(chosen) < min(count, len(x)):
        least = np.minimum(least, ((x - x[chosen[-1]]) ** 2).sum(1))
        if least.max() == 0:
            break
        chosen.append(int(least.argmax()))
    return x[chosen]


def _nearest(centres: dict[int, np.ndarray]):
    """Number of the nearest centre of the vector's length and the distance to it."""
    @F.pandas_udf("centre int, away double")
    def place(vectors: pd.Series) -> pd.DataFrame:
        centre, away = np.zeros(len(vectors), np.int32), np.zeros(len(vectors))
        length = vectors.map(len).to_numpy()
        for n in np.unique(length):
            rows = np.flatnonzero(length == n)
            if n == 0 or n not in centres:
                away[rows] = [float(np.sqrt((np.asarray(vectors.iloc[i]) ** 2).sum())) for i in rows]
                continue
            x, c = np.stack(vectors.iloc[rows].to_list()), centres[n]
            gap = np.sqrt(np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ c.T + (c ** 2).sum(1)[None], 0))
            centre[rows], away[rows] = gap.argmin(1), gap.min(1)
        return pd.DataFrame({"centre": centre, "away": away})

    return place


_FOUND = "query_id long, vec_id long, score long"


def _search(k: int):
    def run(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        x, q = (np.stack(f["v"].to_list()).reshape(len(f), -1) for f in (data, queries))
        own = queries["query_id"].to_numpy(np.int64)
        best, ids = dual_search(
            q, own, queries["floor"].to_numpy(float), x, data["vec_id"].to_numpy(np.int64), k)
        row, place = np.nonzero(np.isfinite(best))
        return pd.DataFrame({
            "query_id": own[row], "vec_id": ids[row, place], "score": best[row, place].astype(np.int64)})

    return run


def _joined(data: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Results of each query in each block it asks, blocks and chunks of queries together.

    A block is sent once per chunk of queries that ask it, a query once per block.
    """
    key = ["dim", "centre", "block"]
    chunks = asked.groupBy(*key).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("_chunks"))
    asked = asked.join(chunks, key).withColumn(
        "chunk", F.pmod(F.xxhash64("query_id", F.lit(7)), F.col("_chunks")).cast("int"))
    sent = data.join(chunks, key).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    key = [*key, "chunk"]
    return sent.select(*key, "vec_id", "v").groupBy(*key).cogroup(
        asked.select(*key, "query_id", "v", "floor").groupBy(*key)).applyInPandas(_search(k), _FOUND)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every query row, its own left out."""
    valid = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), is_query.alias("_asks"),
        whole_numbers(F.col(vector_col)).alias("v")).where(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    valid = written(valid.dropDuplicates(["vec_id", "v"]).withColumn("dim", F.size("v")), "vectors")
    sample = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("dim", "v").collect()
    centres = {}
    for n in {r["dim"] for r in sample if r["dim"]}:
        centres[n] = _farthest_first(np.array([r["v"] for r in sample if r["dim"] == n]), CENTRES)
    placed = valid.withColumn("_p", _nearest(centres)("v")).select("vec_id", "_asks", "v", "dim", "_p.*")
    alike = Window.partitionBy("v").orderBy("vec_id")
    data = placed.withColumn("_copy", F.row_number().over(alike)).where(F.col("_copy") <= k + 1).drop("_copy")
    data = written(data, "candidates")
    groups = data.groupBy("dim", "centre").agg(
        F.max("away").alias("radius"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).collect()
    data = data.join(  # a row per centre: bounded
        F.broadcast(data.sparkSession.createDataFrame(
            [(r["dim"], r["centre"], r["blocks"]) for r in groups], "dim int, centre int, _blocks int")),
        ["dim", "centre"]).withColumn(
            "block", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("_blocks")).cast("int")).drop("_blocks")
    data = written(data.select("dim", "centre", "block", "vec_id", "v"), "blocks")
    queries = placed.where("_asks").select(F.col("vec_id").alias("query_id"), "v", "dim", "centre")
    home = queries.withColumn("block", F.lit(0)).withColumn("floor", F.lit(float("-inf")))
    first = written(_joined(data, home, k), "first-results")
    floors = first.groupBy(F.col("query_id").alias("_q")).agg(
        F.min("score").alias("_least"), F.count("*").alias("_n"))
    table_of = {n: [(r["centre"], r["radius"], r["blocks"]) for r in groups if r["dim"] == n]
                for n in {r["dim"] for r in groups}}

    @F.pandas_udf("array<struct<centre:int,block:int>>")
    def worth(vectors: pd.Series, own: pd.Series, floor: pd.Series) -> pd.Series:
        out = []
        for v, home_centre, least in zip(vectors, own, floor):
            v, found = np.asarray(v, float), []
            norm = float(np.sqrt((v ** 2).sum()))
            for centre, radius, blocks in table_of.get(len(v), []):
                middle = centres[len(v)][centre] if len(v) in centres else np.zeros(len(v))
                top = float(v @ middle) + norm * radius
                if top + 1e-6 * (1 + abs(top)) >= least:
                    found += [{"centre": centre, "block": b} for b in range(blocks)
                              if (centre, b) != (home_centre, 0)]
            out.append(found)
        return pd.Series(out)

    asked = queries.join(floors, F.col("query_id") == F.col("_q"), "left").withColumn(
        "floor", F.when(F.col("_n") >= k, F.col("_least").cast("double")).otherwise(float("-inf")))
    asked = written(asked.select(
        "query_id", "v", "dim", "floor", F.explode(worth("v", "centre", "floor")).alias("_w")
    ).select("query_id", "v", "dim", "floor", "_w.*"), "asked")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return first.union(_joined(data, asked, k)).withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
)
SELECT * FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
    vec_id, score FROM s
) WHERE rank <= 5
"""

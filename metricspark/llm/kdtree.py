"""Exact top-k inner products by one KD-tree per shard of the vectors."""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricspark.session import durable

#: Vectors a shard holds on average, vectors of a leaf, and queries of a block.
SHARD_ROWS = 4096
LEAF_ROWS = 256
BLOCK_ROWS = 512
#: Whole numbers that a double holds exactly.
EXACT = 2**53


def grid(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component x as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def whole(vector: Column) -> Column:
    """True if there is a vector and each component is a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


@dataclass
class Tree:
    """Nodes in an array, the root first. ``low`` and ``high`` bound the vectors below a
    node tightly; ``left`` is -1 at a leaf, whose rows are ``start`` to ``end``. ``keys`` are the
    numbers of the rows, ``ids`` their vec_ids."""

    vectors: np.ndarray
    keys: np.ndarray
    ids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as held:
            return Tree(**{k: held[k] for k in held.files})


def build(keys: np.ndarray, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
    """Split at the median of the widest component until a leaf holds at most ``leaf_rows``
    vectors, or only equal ones."""
    order = np.lexsort((keys, ids))
    low, high, left, right, start, end = [], [], [], [], [], []
    todo = [(0, len(ids), -1, False)]
    while todo:
        a, b, parent, is_right = todo.pop()
        own = vectors[order[a:b]]
        node = len(low)
        low.append(own.min(axis=0))
        high.append(own.max(axis=0))
        left.append(-1)
        right.append(-1)
        start.append(a)
        end.append(b)
        if parent >= 0:
            (right if is_right else left)[parent] = node
        spread = high[node] - low[node]
        if b - a > leaf_rows and spread.size and spread.max() > 0:
            axis = int(np.argmax(spread))
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, axis], middle)]
            todo += [(a + middle, b, node, True), (a, a + middle, node, False)]
    stack = lambda rows: np.array(rows, dtype=np.int64)
    return Tree(vectors[order], keys[order], ids[order], stack(low), stack(high), stack(left), stack(right), stack(start), stack(end))


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by doubles where all sums stay exact, else by integers
    of any size."""
    width = max(1, vectors.shape[-1])
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(query).max(initial=0)) * width
    if most < EXACT:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return np.array([sum(int(x) * int(y) for x, y in zip(v, query)) for v in vectors], dtype=object)


class Searcher:
    """Best-first search in one tree for a block of queries."""

    def __init__(self, tree: Tree, queries: np.ndarray) -> None:
        self.tree, self.queries = tree, queries
        most = max(float(np.abs(x).max(initial=0)) for x in (tree.low, tree.high)) * float(np.abs(queries).max(initial=0))
        self.exact = most * max(1, queries.shape[1]) < EXACT
        if self.exact:
            self.rows = tree.vectors.astype(np.float64)
            q = queries.astype(np.float64)
            # The highest inner product a box allows: each component at the better end.
            self.bounds = np.maximum(q, 0) @ tree.high.T.astype(np.float64) + np.minimum(q, 0) @ tree.low.T.astype(np.float64)

    def bound(self, at: int, node: int):
        if self.exact:
            return self.bounds[at, node]
        ends = zip(self.queries[at], self.tree.low[node], self.tree.high[node])
        return sum(max(int(q) * int(lo), int(q) * int(hi)) for q, lo, hi in ends)

    def search(self, at: int, own: int, k: int, floor, best: list) -> list:
        """The best ``k`` (score, -vec_id) of ``best`` and this tree; a box is opened if its
        bound can still reach the kth score, equal scores included, for ties may be of a
        smaller vec_id. ``floor`` is a score that k others are known to reach, ``own`` the
        number of the query's row, which is no candidate."""
        tree, query = self.tree, self.queries[at]
        q = query.astype(np.float64) if self.exact else None
        queue = [(-self.bound(at, 0), 0)]
        kth = best[0][0] if len(best) == k else None
        if floor is not None and (kth is None or floor > kth):
            kth = floor
        while queue:
            bound, node = heapq.heappop(queue)
            if kth is not None and -bound < kth:
                break
            if tree.left[node] >= 0:
                for child in (int(tree.left[node]), int(tree.right[node])):
                    limit = self.bound(at, child)
                    if kth is None or limit >= kth:
                        heapq.heappush(queue, (-limit, child))
                continue
            a, b = int(tree.start[node]), int(tree.end[node])
            scores = self.rows[a:b] @ q if self.exact else products(tree.vectors[a:b], query)
            hits = np.arange(b - a) if kth is None else np.flatnonzero(scores >= kth)
            for i in hits[np.lexsort((tree.ids[a:b][hits], -scores[hits]))] if self.exact else hits:
                if tree.keys[a + i] == own:
                    continue
                found = (int(scores[i]), -int(tree.ids[a + i]))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
                elif self.exact:
                    break  # the rest of this leaf is no better
            if len(best) == k:
                kth = best[0][0] if kth is None else max(kth, best[0][0])
        return best


def _trees(vectors: DataFrame) -> DataFrame:
    """One serialised tree per (dims, shard): a shard's rows have a bounded number."""

    def make(rows: pd.DataFrame) -> pd.DataFrame:
        vectors_of = np.array(rows["v"].to_list(), dtype=np.int64).reshape(len(rows), -1)
        tree = build(rows["row"].to_numpy(np.int64), rows["vec_id"].to_numpy(np.int64), vectors_of)
        return pd.DataFrame({"dims": [int(rows["dims"].iloc[0])], "shard": [int(rows["shard"].iloc[0])], "tree": [tree.dump()]})

    return vectors.groupBy("dims", "shard").applyInPandas(make, "dims int, shard int, tree binary")


def _blocks(queries: DataFrame) -> DataFrame:
    """One row per (dims, block) of queries: rows, ids, components and the kth score known so far."""
    packed = F.sort_array(F.collect_list(F.struct("query", "query_id", "v", "floor")))
    return queries.groupBy("dims", "block").agg(packed.alias("queries"))


def _search(trees: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(query, query_id, vec_id, score): the best ``k`` of each shard for each query of a block.

    ``blocks`` has a row per block and shard that are to meet."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, queries in zip(batch["tree"], batch["queries"]):
                searcher = Searcher(Tree.load(data), np.array([q["v"] for q in queries], dtype=np.int64).reshape(len(queries), -1))
                rows = []
                for at, q in enumerate(queries):
                    floor = None if q["floor"] is None or pd.isna(q["floor"]) else int(q["floor"])
                    found = searcher.search(at, q["query"], k, floor, [])
                    rows += [(q["query"], q["query_id"], -negative, score) for score, negative in found]
                yield pd.DataFrame(rows, columns=["query", "query_id", "vec_id", "score"]).astype("int64")

    met = blocks.join(trees, ["dims", "shard"]).select("tree", "queries")
    return met.mapInPandas(run, "query bigint, query_id bigint, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    """``found`` with rank, the best ``k`` of each query: Spark cuts the lists of a task at the
    rank before they are shuffled, and again where they meet."""
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` highest integer inner products of each query row with every other row.

    ``vectors`` has vec_id and embedding; ``queries`` marks the rows that ask. Components
    become floor(scale * x). Returns query_id, rank, vec_id and score; ties go to the smaller
    vec_id, and a query with fewer than ``k`` others gets all. Rows with a null vec_id, a null
    vector, or a null or non-finite component take no part; vectors of different lengths
    do not meet. Rows are told apart by themselves, not by vec_id: each repeated row is a
    candidate, rows that share a query's vec_id too, and each asking row has a list of its own.
    Other columns are not read. An empty table gives no rows. Scores beyond 64 bits are an error.

    Rows are spread over shards by a hash, some ``shard_rows`` each. Blocks of
    queries meet each shard by an equi join on its number, in two rounds: the first shard
    gives each query a kth score, which the second round takes along as the bound under
    which boxes of the other shards stay closed. Work is queries times shards at most.
    """
    usable = vectors.where(F.col("vec_id").isNotNull() & whole(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), grid(F.col("embedding"), scale).alias("v"), queries.alias("_asks")
    )
    # Rows have a number of their own, frozen by the write, so that a vec_id may have any number of them.
    usable = durable(usable.select("*", F.size("v").alias("dims"), F.monotonically_increasing_id().alias("row")), "grid")
    sizes = {r["dims"]: (r["n"], r["q"]) for r in usable.groupBy("dims").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_asks"), 1)).alias("q")).collect()}  # a row per vector length

    def spread(column: str, at: int, rows: int) -> Column:
        parts = F.lit(1)
        for dims, counts in sizes.items():
            parts = F.when(F.col("dims") == dims, F.lit(max(1, math.ceil(counts[at] / rows)))).otherwise(parts)
        return F.pmod(F.xxhash64(column, F.lit(at)), parts).cast("int")

    trees = durable(_trees(usable.select("dims", "row", "vec_id", "v", spread("row", 0, shard_rows).alias("shard"))), "trees")
    asking = usable.where("_asks").select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "dims", "v", spread("row", 1, BLOCK_ROWS).alias("block"))
    last = F.lit(0)
    for dims, counts in sizes.items():
        last = F.when(F.col("dims") == dims, F.lit(max(1, math.ceil(counts[0] / shard_rows)) - 1)).otherwise(last)

    unknown = _blocks(asking.withColumn("floor", F.lit(None).cast("bigint")))
    first = durable(_search(trees, unknown.withColumn("shard", F.pmod(F.col("block"), last + 1)), k), "round")
    kth = _best(first, k).where(F.col("rank") == k).select(F.col("query").alias("_query"), F.col("score").alias("floor"))
    known = _blocks(asking.join(kth, F.col("query") == F.col("_query"), "left").drop("_query"))
    shards = F.explode(F.filter(F.sequence(F.lit(0), last), lambda s: s != F.pmod(F.col("block"), last + 1)))
    rest = _search(trees, known.withColumn("shard", shards), k)
    return _best(first.unionByName(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

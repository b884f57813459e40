"""Exact top-k by inner product: KD-trees per shard, best-first with a propagated bound."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOWEST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class SearchSettings:
    """``shard_rows`` vectors share a tree of leaves with ``leaf_rows``; ``block_rows``
    queries travel together through the trees of ``stripe`` shards, one after another,
    and take their k-th score along from tree to tree."""

    shard_rows: int = 8192
    leaf_rows: int = 256
    block_rows: int = 1024
    stripe: int = 4


@dataclass
class Tree:
    """Rows in leaf order; per node a tight box and either two children or a range of rows."""

    ids: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: np.ndarray  # nodes x 2, -1 for leaves
    ranges: np.ndarray  # nodes x 2


def narrow(values: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them, for the shuffle."""
    return values.astype(np.result_type(np.min_scalar_type(values.min()), np.min_scalar_type(values.max())))


def build(ids: np.ndarray, rows: np.ndarray, leaf_rows: int) -> Tree:
    """Median splits along the side on which the box is longest; boxes are those of the rows."""
    order = np.argsort(ids, kind="stable")
    low, high, children, ranges = [], [], [], []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        first, last, parent, side = todo.pop()
        mine = rows[order[first:last]]
        node = len(low)
        low.append(mine.min(axis=0))
        high.append(mine.max(axis=0))
        children.append([-1, -1])
        ranges.append((first, last))
        if parent >= 0:
            children[parent][side] = node
        if last - first > leaf_rows and (high[-1] > low[-1]).any():
            axis = int((high[-1] - low[-1]).argmax())
            middle = (last - first) // 2
            order[first:last] = order[first:last][np.argpartition(mine[:, axis], middle)]
            todo += [(first, first + middle, node, 0), (first + middle, last, node, 1)]
    return Tree(ids[order], rows[order], np.array(low), np.array(high), np.array(children), np.array(ranges))


class Search:
    """The best ``k`` of a block of queries, over the trees visited so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.score = np.full((len(ids), k), LOWEST)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def visit(self, tree: Tree) -> None:
        """Each query opens its node with the highest bound until that is below its k-th score.

        The bound of a box is the largest inner product any point in it can have.
        All queries take a step at a time; those that open the same leaf meet its rows in one
        matrix product.  Sums below 2 ** 53 are exact in doubles; else long arithmetic is used.
        """
        most = max(int(np.abs(self.queries).max(initial=0)), 1) * max(int(np.abs(tree.rows.astype(np.int64)).max(initial=0)), 1)
        kind = np.float64 if most * self.queries.shape[1] < 1 << 53 else np.int64
        q, rows = self.queries.astype(kind), tree.rows.astype(kind)
        bounds = np.maximum(q, 0) @ tree.high.astype(kind).T + np.minimum(q, 0) @ tree.low.astype(kind).T
        bounds = bounds.astype(np.int64)
        open_ = np.full(bounds.shape, LOWEST)
        open_[:, 0] = bounds[:, 0]
        active = np.arange(len(q))
        while len(active):
            node = open_[active].argmax(axis=1)
            top = open_[active, node]
            go = (top >= self.score[active, -1]) & (top > LOWEST)
            active, node = active[go], node[go]
            open_[active, node] = LOWEST
            inner = tree.children[node, 0] >= 0
            for side in (0, 1):
                child = tree.children[node[inner], side]
                open_[active[inner], child] = bounds[active[inner], child]
            leaf_of, who = node[~inner], active[~inner]
            for leaf in np.unique(leaf_of):
                first, last = tree.ranges[leaf]
                self._take(who[leaf_of == leaf], q, rows[first:last], tree.ids[first:last])

    def _take(self, who: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
        score = (q[who] @ rows.T).astype(np.int64)
        hit = (score >= self.score[who, -1][:, None]) & (ids[None, :] != self.ids[who][:, None])
        r, c = np.nonzero(hit)
        if not len(r):
            return
        touched = np.unique(r)
        place = np.concatenate((np.repeat(touched, self.k), r))
        value = np.concatenate((self.score[who[touched]].ravel(), score[r, c]))
        name = np.concatenate((self.found[who[touched]].ravel(), ids[c]))
        order = np.lexsort((name, ~value, place))  # ~ turns the order round without overflow
        place, value, name = place[order], value[order], name[order]
        first = np.searchsorted(place, touched)
        keep = (first[:, None] + np.arange(self.k)).ravel()
        self.score[who[touched]] = value[keep].reshape(-1, self.k)
        self.found[who[touched]] = name[keep].reshape(-1, self.k)


def scaled(embedding: Column, factor: int = 64) -> Column:
    """floor(factor * x) of each component as long."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * factor).cast("long"))


def usable(embedding: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & ~bad


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``id, v, dim`` of each row.

    Rows with a null id or an unusable vector take no part.  Repeated rows of an id all stay.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("e"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("e"))).select("id", scaled(F.col("e")).alias("v"))
    return rows.withColumn("dim", F.size("v"))


def _dealt(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Rows with a ``part`` by hash of id and vector, about ``size`` rows each."""
    parts = max(1, -(-rows.count() // size))
    return rows.withColumn("part", F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int")), parts


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("id").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy()
    return ids, flat.reshape(len(ids), -1)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, settings: SearchSettings = SearchSettings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest scores, ties to the smaller id.

    ``vectors`` has ``id, v, dim`` as from ``integer_vectors``; ``is_query`` is a condition on ``id``.  A vector is
    no candidate of its own id, and vectors of different lengths never meet.  Repeated rows of an id are a
    candidate each; repeated rows of a query share one list of the k highest.
    Every block of queries visits every shard's tree, stripe by stripe.
    """
    s = settings
    shards, n_shards = _dealt(vectors, s.shard_rows)
    blocks, n_blocks = _dealt(vectors.where(is_query), s.block_rows)

    def plant(key: tuple, table: pa.Table) -> pa.Table:
        ids, rows = _matrix(table)
        blob = pickle.dumps(build(ids, narrow(rows), s.leaf_rows))
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "blob": [blob]})

    def bundle(key: tuple, table: pa.Table) -> pa.Table:
        ids, rows = _matrix(table)
        blob = pickle.dumps((ids, narrow(rows)))
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "blob": [blob]})

    schema = "dim int, part int, blob binary"
    stripes = -(-n_shards // s.stripe)
    trees = (
        shards.groupBy("dim", "part").applyInArrow(plant, schema)
        .select("dim", "blob", (F.col("part") % stripes).alias("stripe"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    )
    queries = (
        blocks.groupBy("dim", "part").applyInArrow(bundle, schema)
        .select("dim", "blob", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), F.col("part").alias("block"))
    )

    def walk(asked: pa.Table, planted: pa.Table) -> pa.Table:
        out = []
        for blob in asked.column("blob"):
            ids, rows = pickle.loads(blob.as_py())
            search = Search(ids, rows.astype(np.int64), k)
            for tree in planted.column("blob"):
                search.visit(pickle.loads(tree.as_py()))
            full = search.score > LOWEST
            r, c = np.nonzero(full)
            out.append(pa.table({"query_id": ids[r], "vec_id": search.found[r, c], "score": search.score[r, c]}))
        empty = pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        return pa.concat_tables(out or [empty])

    keys = ("dim", "stripe", "block")
    found = queries.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInArrow(
        walk, "query_id long, vec_id long, score long"
    )
    # A query has at most k rows from each stripe.
    best = found.groupBy("query_id").agg(
        F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))), 1, k).alias("best")
    )
    return best.select("query_id", F.posexplode("best").alias("at", "one")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "one.vec_id", (-F.col("one.down")).alias("score")
    )

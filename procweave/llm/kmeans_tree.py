"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample and every vector goes down to its leaf. A query walks the tree best bin first: a
priority queue holds the branches not taken, nearest first, and gives the order in which leaves are visited. How many
leaves is calibrated: from one on, visits widen until sample queries reach the target recall against brute force
over the sample. Leaves are searched in blocks of bounded size, on the original vectors.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import storage, vectors

K = 5


class Tree:
    """Inner nodes hold the centres of their children; leaves are numbered as they are made."""

    def __init__(self, x: np.ndarray, branching: int, leaf_rows: int):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []  # a node's number, or -1 - leaf
        self.leaves = 0
        self._branching, self._leaf_rows = branching, leaf_rows
        self.root = self._grow(x)

    def _grow(self, x: np.ndarray) -> int:
        centres = vectors.kmeans(x, self._branching) if len(x) > self._leaf_rows else x[:0]
        if len(centres) < 2:
            self.leaves += 1
            return -self.leaves
        node = len(self.centres)
        self.centres.append(centres)
        self.children.append([])
        of = vectors.nearest(x, centres)
        self.children[node] = [self._grow(x[of == i]) for i in range(len(centres))]
        return node

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), self.root)
        while (inner := np.unique(at[at >= 0])).size:
            for node in inner:
                rows = np.flatnonzero(at == node)
                at[rows] = np.array(self.children[node])[vectors.nearest(x[rows], self.centres[node])]
        return -1 - at

    def visit(self, q: np.ndarray, most: int) -> list[int]:
        """Leaves in best-bin-first order."""
        queue, out = [(0.0, self.root)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            while node >= 0:
                d = ((self.centres[node] - q) ** 2).sum(axis=1)
                near = int(d.argmin())
                for i, child in enumerate(self.children[node]):
                    if i != near:
                        heapq.heappush(queue, (float(d[i]), child))
                node = self.children[node][near]
            out.append(-1 - node)
        return out


def calibrate(tree: Tree, x: np.ndarray, recall: float, queries: int = 200) -> int:
    """Leaves to visit so that sample queries find the target share of their K nearest in the sample."""
    leaf = tree.leaf_of(x)
    ranks = []
    for i in np.random.default_rng(5).permutation(len(x))[:queries]:
        score = x @ x[i]
        score[i] = -np.inf
        place = {b: r for r, b in enumerate(tree.visit(x[i], tree.leaves))}
        ranks += [place[int(leaf[j])] for j in np.argsort(-score)[: min(K, len(x) - 1)]]
    ranks.sort()
    return ranks[min(len(ranks) - 1, math.ceil(recall * len(ranks)))] + 1 if ranks else 1


def search(rows: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, recall: float = 0.99, sample_rows: int = 10_000, branching: int = 8, leaf_rows: int = 64, block_rows: int = 256) -> DataFrame:
    """The ``k`` rows of largest cosine for each query, its own id apart: query_id, rank (from 1), vec_id, score.

    Ties go to the smaller id; a vec_id that repeats is one candidate, at its best score, and one query for each of its
    distinct vectors, of which the best scores count; with fewer than ``k`` candidates all are returned. Null or zero vectors, those with null
    or non-finite components, those of an unusual length and null ids take no part. The tree is fitted on
    about ``sample_rows`` distinct vectors. Other columns are ignored.
    """
    good = vectors.usable(rows, id_col, vector_col)

    def least_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each distinct vector of a batch the k + 1 least ids: the query's own and k more."""
        for batch in batches:
            v, groups = vectors.matrix(batch["v"]), {}
            for i, (key, one) in enumerate(zip(map(bytes, np.ascontiguousarray(v + 0.0)), batch["id"].to_pylist(), strict=True)):
                groups.setdefault(key, (i, []))[1].append(one)
            first = [i for i, _ in groups.values()]
            yield pa.RecordBatch.from_arrays([batch["v"].take(pa.array(first, pa.int64())), pa.array([sorted(set(x))[: k + 1] for _, x in groups.values()], pa.list_(pa.int64()))], names=["v", "ids"])

    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    classes, classes_path = storage.written(good.select("id", "v").mapInArrow(least_ids, "v array<double>, ids array<long>").groupBy("v").agg(ids.alias("ids")).select("v", "ids", F.get("ids", F.lit(0)).alias("id")), "classes")
    asked = vectors.usable(queries, id_col, vector_col)
    x = vectors.sample(classes, sample_rows)
    schema = "query_id long, rank int, vec_id long, score double"
    if not len(x):
        return classes.sparkSession.createDataFrame([], schema)
    tree = Tree(x, branching, leaf_rows)
    visits = calibrate(tree, x, recall)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.leaf_of(vectors.unit(vectors.matrix(batch["v"])))
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), batch["id"], batch["ids"], batch["v"]], names=["leaf", "id", "ids", "v"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = [tree.visit(q, visits) for q in vectors.unit(vectors.matrix(batch["v"]))]
                yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], pa.array(leaves, pa.list_(pa.int32()))], names=["id", "v", "leaves"])

    located, _ = storage.written(classes.select("id", "ids", "v").mapInArrow(locate, "leaf int, id long, ids array<long>, v array<double>"), "located")
    storage.remove(classes.sparkSession, classes_path)
    # one count for each leaf; their number is bounded by the sample
    sizes = {r["leaf"]: math.ceil(r["count"] / block_rows) for r in located.groupBy("leaf").count().collect()}
    blocks = F.array(*[F.lit(sizes.get(i, 1)) for i in range(tree.leaves)])
    members = located.withColumn("block", F.pmod(F.xxhash64("id"), F.get(blocks, F.col("leaf"))).cast("int"))
    walked = asked.select("id", "v").mapInArrow(walk, "id long, v array<double>, leaves array<int>")
    sent = walked.select("id", "v", F.explode("leaves").alias("leaf")).select("id", "v", "leaf", F.explode(F.sequence(F.lit(0), F.get(blocks, F.col("leaf")) - 1)).alias("block"))

    def best(key, mine, theirs):
        out = []
        if len(mine) and len(theirs):
            y, ids = vectors.unit(vectors.matrix(mine["v"])), mine["ids"].to_pylist()
            least = mine["id"].to_numpy()
            for i in range(0, len(theirs), 512):
                some = theirs.slice(i, 512)
                score = vectors.unit(vectors.matrix(some["v"])) @ y.T
                for q, s in zip(some["id"].to_pylist(), score, strict=True):
                    take = np.argpartition(-s, k)[: k + 1] if len(s) > k + 1 else np.arange(len(s))
                    take = np.flatnonzero(s >= s[take].min()) if len(s) > k + 1 else take
                    near = take[np.lexsort((least[take], -s[take]))]
                    rows_ = [(float(s[j]), one) for j in near for one in ids[j] if one != q]
                    out += [(q, one, sc) for sc, one in sorted(rows_, key=lambda r: (-r[0], r[1]))[:k]]
        a, b, c = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    near = members.groupBy("leaf", "block").cogroup(sent.groupBy("leaf", "block")).applyInArrow(best, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # a vec_id that repeats has one rank
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_kmeans_tree(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(rows, rows.where(F.col("vec_id") % 50 == 0))

"""Embedding near-dedup by an inverted multi-index.

Each half of the unit vectors has its own codebook; a vector's cell is the pair of its nearest codewords. Every vector
visits cells by the multi-sequence order of its distances to both codebooks. How many it visits is calibrated: planted
neighbours at exactly the threshold must be met with the target recall. Pairs are verified on the original vectors, in
double precision. A pair counts for both vectors, whichever of the two visits the other.

Equal vectors are one class. Classes are stored once, in blocks of bounded size along the cells, and each two blocks are read
together by a task of a product without a shuffle: which cells a vector visits is told from how far it reaches (one number), so
neither vectors nor visits are ever copied for each other. Blocks return counts and a forest of links, never pairs.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage, vectors
from .components import components

THRESHOLD = 0.9
#: Vectors of a block, at most and (where there are as many) at least, the components that it holds about, blocks of a small table.
BLOCK, LEAST, COMPONENTS, BLOCKS = 16_384, 1024, 1 << 20, 12
#: Visitors and members that are compared at once.
VISITORS, MEMBERS = 4096, 1024


def multi_sequence(first: np.ndarray, second: np.ndarray, most: int) -> list[int]:
    """The ``most`` cells of least distance in the product of two codebooks, nearest first. Both lists of distances are
    sorted; from the nearest pair on, a queue holds the next pairs along either list, each once."""
    one, two = first.argsort(kind="stable").tolist(), second.argsort(kind="stable").tolist()
    a, b, width = first[one].tolist(), second[two].tolist(), len(second)
    queue, seen, out = [(a[0] + b[0], 0, 0)], {(0, 0)}, []
    while queue and len(out) < most:
        _, i, j = heapq.heappop(queue)
        out.append(one[i] * width + two[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(queue, (a[x] + b[y], x, y))
    return out


def distances(x: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of the halves of each row to both codebooks, but for the length of the half."""
    half = x.shape[1] // 2
    return (first**2).sum(1) - 2 * x[:, :half] @ first.T, (second**2).sum(1) - 2 * x[:, half:] @ second.T


def reach(first: np.ndarray, second: np.ndarray, most: int) -> np.ndarray:
    """The distance of the last of the ``most`` cells that ``multi_sequence`` gives for each row. A cell that is i-th on one
    and j-th on the other list has i * j - 1 cells before it, so few can be among them."""
    a, b = np.sort(first, axis=1), np.sort(second, axis=1)
    most = min(most, a.shape[1] * b.shape[1])
    i, j = np.nonzero(np.outer(np.arange(1, a.shape[1] + 1), np.arange(1, b.shape[1] + 1)) <= most)
    step = max(1, (1 << 20) // len(i))
    parts = [np.partition(a[k : k + step, i] + b[k : k + step, j], most - 1, axis=1)[:, most - 1] for k in range(0, len(a), step)]
    return np.concatenate([np.zeros(0), *parts])


def calibrate(sample: np.ndarray, first: np.ndarray, second: np.ndarray, threshold: float, recall: float, seed: int = 11) -> int:
    """Cells to visit so that the given share of planted neighbours, at exactly the threshold in random directions, is met."""
    rng = np.random.default_rng(seed)
    x = np.repeat(sample[rng.permutation(len(sample))[:500]], 4, axis=0)
    away = rng.standard_normal(x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    y = threshold * x + math.sqrt(1 - threshold**2) * away / np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)
    homes = zip(*(d.argmin(axis=1) for d in distances(y, first, second)), strict=True)
    nearer = [int((p[:, None] + q <= p[i] + q[j]).sum()) for p, q, (i, j) in zip(*distances(x, first, second), homes, strict=True)]
    ranks = np.sort(nearer)
    return int(ranks[min(len(ranks) - 1, math.ceil(recall * len(ranks)))])


class Block:
    """Vectors along the cells: ``cells`` are (cell, first row, row after the last)."""

    def __init__(self, row: dict, first: np.ndarray, second: np.ndarray):
        self.number = row["block"]
        self.key, self.id, self.n = (np.frombuffer(row[c], np.int64) for c in ("key", "id", "n"))
        self.unit = vectors.unit(np.frombuffer(row["v"], np.float32 if row["short"] else np.float64).reshape(len(self.id), -1).astype(float))
        self.short = self.unit.astype(np.float32)
        self.home = np.frombuffer(row["home"], np.int32)
        self.width = len(second)
        # what is lost by rounding is made up for; in a block all is told from the same numbers
        self.far = np.frombuffer(row["far"], np.float64).astype(np.float32) + np.float32(1e-5)
        self.first, self.second = (np.ascontiguousarray(d.T, np.float32) for d in distances(self.unit, first, second))
        starts = np.flatnonzero(np.diff(self.home, prepend=-1))
        self.cells = list(zip(self.home[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(self.id)], strict=True))
        self.links, self.label = np.zeros(len(self.id), np.int64), self.id.copy()

    def visitors(self, cell: int) -> np.ndarray:
        i, j = divmod(cell, self.width)
        return np.flatnonzero(self.first[i] + self.second[j] <= self.far)

    def visit(self, rows: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Which of the rows visit which of the cells."""
        i, j = np.divmod(cells, self.width)
        return self.first[np.ix_(i, rows)].T + self.second[np.ix_(j, rows)].T <= self.far[rows][:, None]

    def begin(self) -> None:
        self.links[:], self.label[:] = 0, self.id


def alike(a: Block, rows: np.ndarray, b: Block, low: int, high: int, threshold: float) -> np.ndarray | None:
    """Which rows of one block and which of ``low`` to ``high`` of another have a cosine of at least the threshold, none if there is
    no such pair. Single precision tells all pairs but those within its error."""
    about = a.short[rows] @ b.short[low:high].T
    error = np.float32((a.unit.shape[1] + 8) * 2.0**-23)
    if about.max() < threshold - error:
        return None
    out = about >= threshold + error
    near = (about >= threshold - error) & ~out
    r, c = np.nonzero(near) if near.any() else ((), ())
    for k in range(0, len(r), 1 << 16):
        i, j = r[k : k + (1 << 16)], c[k : k + (1 << 16)]
        out[i, j] = np.einsum("ij,ij->i", a.unit[rows[i]], b.unit[low + j]) >= threshold
    return out


def _forest(match: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least label of each row's and column's component."""
    top = np.iinfo(np.int64).max
    while True:
        new_a = np.minimum(a, np.where(match, b[None, :], top).min(axis=1))
        new_b = np.minimum(b, np.where(match, new_a[:, None], top).min(axis=0))
        if (new_a == a).all() and (new_b == b).all():
            return a, b
        a, b = new_a, new_b


def _visit(of: Block, to: Block, threshold: float, again: bool, edges: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Links of the visitors ``of`` a block with the members ``to`` that they visit; ``again``: but for those whose members have
    already visited the visitor's cell. In one block, a pair of which each visits the other counts once."""
    for cell, low, high in to.cells:
        visitors = of.visitors(cell)
        for i in range(0, len(visitors), VISITORS):
            for j in range(low, high, MEMBERS):
                rows, end = visitors[i : i + VISITORS], min(high, j + MEMBERS)
                match = alike(of, rows, to, j, end, threshold)
                if match is None:
                    continue
                cols = np.arange(j, end)
                match &= of.id[rows][:, None] != to.id[cols]
                some, other = match.any(axis=1), match.any(axis=0)
                match, rows, cols = match[np.ix_(some, other)], rows[some], cols[other]
                if again or of is to:
                    back = to.visit(cols, of.home[rows]).T
                    match &= ~back if again else ~back | (rows[:, None] < cols)
                if not match.any():
                    continue
                np.add.at(of.links, rows, match @ to.n[cols])
                np.add.at(to.links, cols, of.n[rows] @ match)
                a, b = of.label[rows], to.label[cols]
                new_a, new_b = _forest(match, a, b)
                edges += [(old[old != new], new[old != new]) for old, new in ((a, new_a), (b, new_b))]
                of.label[rows] = np.minimum(of.label[rows], new_a)
                to.label[cols] = np.minimum(to.label[cols], new_b)


def meet(one: Block, two: Block, threshold: float) -> pa.RecordBatch:
    """Links of the rows of two blocks (or of one with itself) by key, and edges of a forest of their ids."""
    blocks, edges = [one] if one is two else [one, two], []
    for block in blocks:
        block.begin()
    _visit(one, two, threshold, False, edges)
    if one is not two:
        _visit(two, one, threshold, True, edges)
    key, links_ = (np.concatenate(x) for x in zip(*((b.key[b.links > 0], b.links[b.links > 0]) for b in blocks), strict=True))
    ends = np.unique(np.array([np.concatenate(x) for x in zip(*edges, strict=True)] if edges else [[], []], np.int64), axis=1)
    none = lambda n, kind=pa.int64(): pa.nulls(n, kind)
    columns = [(pa.array(key), none(ends.shape[1])), (pa.array(links_), none(ends.shape[1])), (none(len(key)), pa.array(ends[0])), (none(len(key)), pa.array(ends[1]))]
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], names=["key", "links", "id", "to"])


def links(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, recall: float = 0.999, sample_rows: int = 10_000, members_per_cell: int = 256) -> DataFrame:
    """One row per input row: vec_id, n_links (other vectors at a cosine of at least ``threshold``), component_id (least
    vec_id reachable by links) and kept.

    Rows that repeat a vec_id are one vector, however often: a link of either holds for both, and equal ones never link with
    each other. If they hold different vectors, these are of one component, and n_links is the sum over them. Null or zero vectors, those with null or non-finite components and those of an unusual length link with nothing;
    a null id stands alone, with component null. Codebooks are fitted on about ``sample_rows`` classes. Other columns
    are ignored.
    """
    spark = rows.sparkSession
    kind = "array<float>" if rows.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"  # as narrow as it is stored
    good = vectors.usable(rows, id_col, vector_col).withColumn("v", F.col("v").cast(kind))
    # different vectors of one id may be classes of the same least id, so a class has a key of its own
    grouped = good.groupBy("v").agg(F.min("id").alias("id"), F.count_distinct("id").alias("n")).withColumn("key", F.monotonically_increasing_id())
    classes, classes_path = storage.written(grouped, "classes")
    fitted = vectors.sample(classes, sample_rows)
    total = classes.count()
    everyone = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("v"))
    if not len(fitted):
        return everyone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    k = min(max(64, len(fitted) // 20), max(1, math.ceil(math.sqrt(total / members_per_cell))))
    half = fitted.shape[1] // 2
    first, second = vectors.kmeans(fitted[:, :half], k), vectors.kmeans(fitted[:, half:], k)
    visits = calibrate(fitted, first, second, threshold, recall)
    most = max(1, min(BLOCK, COMPONENTS // fitted.shape[1], max(LEAST, -(-total // BLOCKS))))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                some = batch.slice(i, 1000)
                a, b = distances(vectors.unit(vectors.matrix(some["v"]).astype(float)), first, second)
                home = a.argmin(axis=1) * len(second) + b.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(home, pa.int32()), pa.array(reach(a, b, visits)), some["key"], some["id"], some["n"], some["v"]], names=["home", "far", "key", "id", "n", "v"])

    def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting, n = [], 0
        for batch in (*batches, None):
            while n and (batch is None or n >= most):
                table = pa.concat_batches(waiting)
                some = table.slice(0, most)
                some, waiting, n = some.take(pa.array(np.argsort(some["home"].to_numpy(), kind="stable"))), [table.slice(most)], max(0, n - most)
                v = vectors.matrix(some["v"])
                short = bool((v.astype(np.float32) == v).all())
                own = {c: some[c].to_numpy().tobytes() for c in ("home", "far", "key", "id", "n")}
                yield pa.RecordBatch.from_pylist([{"block": number, **own, "short": short, "v": (v.astype(np.float32) if short else v).tobytes()}], schema=blocks_schema)
                number += 1
            if batch is not None:
                waiting.append(batch)
                n += batch.num_rows

    located, located_path = storage.written(classes.select("key", "id", "n", "v").mapInArrow(locate, f"home int, far double, key long, id long, n long, v {kind}"), "located")
    storage.remove(spark, classes_path)
    classes = located
    blocks_schema = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in ("home", "far", "key", "id", "n")), ("short", pa.bool_()), ("v", pa.binary())])
    parts = -(-total // most)
    along = located.repartitionByRange(parts, "home", F.xxhash64("key")).sortWithinPartitions("home").coalesce(parts)
    blocks, blocks_path = storage.written(along.mapInArrow(in_blocks, "block long, home binary, far binary, key binary, id binary, n binary, short boolean, v binary"), "blocks")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = None
        for batch in batches:
            for i in range(batch.num_rows):
                block = lambda side: Block({c: batch[f"{side}_{c}"][i].as_py() for c in blocks_schema.names}, first, second)  # noqa: B023, E731
                if one is None or one.number != batch["a_block"][i].as_py():
                    one = block("a")
                yield meet(one, one if one.number == batch["b_block"][i].as_py() else block("b"), threshold)

    sides = [blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "ab"]
    pairs = sides[0].join(sides[1].hint("shuffle_replicate_nl"), F.col("a_block") <= F.col("b_block"))
    found, found_path = storage.written(pairs.mapInArrow(verify, "key long, links long, id long, to long"), "links")
    storage.remove(spark, blocks_path)
    counts = found.where("key IS NOT NULL").groupBy("key").agg(F.sum("links").alias("links"))
    shared = _shared_ids(good, classes)
    links_ = found.where("key IS NULL").select("id", "to")
    if shared is not None:
        links_ = links_.unionByName(shared.select(F.col("class").alias("id"), F.col("first").alias("to")).where("id != to"))
    linked, linked_path = components(links_, "id", "to")
    sums = classes.select("key", "id", "n").join(counts, "key", "left").join(linked, "id", "left").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    result = classes.select("key", "v").join(sums, "key").drop("key")  # vectors are dealt once
    result, _ = storage.written(result, "classes")
    storage.remove(spark, located_path, found_path, linked_path)
    out = everyone.join(result, "v", "left")
    if shared is not None:
        by_id = shared.join(result, "v").groupBy(F.col("id").alias("vec_id")).agg(F.sum("n_links").alias("all_links"), F.min("component").alias("all"))
        out = out.join(by_id, "vec_id", "left").withColumns({"n_links": F.coalesce("all_links", "n_links"), "component": F.coalesce("all", "component")})
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _shared_ids(good: DataFrame, classes: DataFrame) -> DataFrame | None:
    """id, v, class and the id's first class for ids that have several vectors; none if there is no such id."""
    several = good.select("id", F.xxhash64("v").alias("h")).distinct().groupBy("id").count().where("count > 1").select("id")
    if several.isEmpty():
        return None
    own = good.select("id", "v").join(several, "id", "left_semi").distinct().join(classes.select("v", F.col("id").alias("class")), "v")
    return storage.written(own.join(own.groupBy("id").agg(F.min("class").alias("first")), "id"), "shared")[0]


#: The same rows from all pairs.
OP8_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
good AS MATERIALIZED (SELECT * FROM v WHERE x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS MATERIALIZED (SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.vec_id <> q.vec_id WHERE list_cosine_similarity(p.x, q.x) >= 0.9),
reach AS (SELECT vec_id AS id, vec_id AS other FROM v UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM v JOIN least ON id = vec_id LEFT JOIN degree ON a = vec_id
"""


def op8_multi_index(spark, sf_dir: str) -> DataFrame:
    return links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

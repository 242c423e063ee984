"""MinHash near-dedup with an LSH forest.

Every set of word shingles has ``trees`` sequences of ``depth`` minhashes. Each tree is one sorted order of all
documents, in which those with the longest common prefixes stand side by side. A region (rows that share
``least_prefix`` minhashes) of at most ``neighbours`` + 1 rows is compared whole; a larger one is split by its next
minhash, and again, until its parts are that small, so the depth adapts to how crowded the region is. In the
sorted order this is one pass: each row meets its ``neighbours`` predecessors of equal prefix. What is still larger at full
depth is a crowd: it is written down whole, and its members are compared to the end where links have not connected
them yet, block by block, with the intersections of all members of two blocks in one product of incidence matrices.
Blocks return links, never pairs.

A pair of similarity s shares the whole sequence of a tree with a chance of s ** depth, so it is missed with one of at most
(1 - s ** depth) ** trees: 4e-5 at 0.85 and 3e-3 at 0.8 if both lie in crowds in every tree, 1e-8 and 3e-6 elsewhere. A 2-bit
sketch of further minhashes drops candidates six standard deviations below the threshold; links are confirmed on
full sets.

Equal sets are one node. Nodes are dealt out by ranges of the sorted orders, so a crowded region is many tasks; the
rows at range ends are compared in one more small step. Confirmation takes each node's best candidates first, then
every other candidate whose two nodes are not yet connected, so no candidate is given up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import storage, worker
from .components import components
from .repeats import CHUNK, NO_ID, bytes_of
from .winnow import BYTES, Sequence, mix, words

_LOWER = np.arange(256)
_LOWER[65:91] += 32
LOWER_BYTES = BYTES[_LOWER]
SKETCH = 128  # minhashes with 2 bits each
BLOCK = 256  # members of a crowd, on either side, that meet in one group
COLUMNS = 4096  # shingles of two blocks that are counted at once


@dataclass(frozen=True)
class Spec:
    shingle: int = 5
    percent: int = 80  # least 100 * intersection / union
    trees: int = 32
    depth: int = 8
    least_prefix: int = 5
    neighbours: int = 4

    @property
    def least_matches(self) -> int:
        j = self.percent / 100
        p = j + (1 - j) / 4
        return int(SKETCH * p - 6 * (SKETCH * p * (1 - p)) ** 0.5)


def shingle_sets(batch: pa.RecordBatch | pa.Table, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of some documents at a time: ids, sorted distinct shingle hashes of all, and how many each has. Words are runs
    of bytes that are no white space, A-Z in lower case; fewer than ``size`` words are one shingle, none an empty set."""
    table = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
    ids, at = table["doc_id"].fill_null(NO_ID).to_numpy(), 0
    for data, offsets in bytes_of(table["text"]):
        n, i = len(offsets) - 1, 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1)
            part, ends = data[offsets[i] : offsets[j]], offsets[i + 1 : j + 1] - offsets[i]
            apart = np.full(len(part) + j - i, 32, np.uint8)
            gap = np.arange(j - i)
            apart[np.arange(len(part)) + np.repeat(gap, np.diff(np.concatenate([[0], ends])))] = part
            units, start, _ = words(apart, LOWER_BYTES)
            owner = np.searchsorted(ends + gap + 1, start, side="right")
            count = np.bincount(owner, minlength=j - i)
            stop = np.cumsum(count)
            sequence = Sequence(units)
            place = np.flatnonzero(np.arange(len(units)) + size <= stop[owner]) if len(units) else np.zeros(0, np.int64)
            short = np.flatnonzero((count > 0) & (count < size))
            first = np.concatenate([place, stop[short] - count[short]])
            last = np.concatenate([place + size, stop[short]])
            of = np.concatenate([owner[place] if len(place) else place, short])
            hashes = mix(sequence.spans(first, last) + (last - first).astype(np.uint64)) if len(first) else np.zeros(0, np.uint64)
            order = np.lexsort((hashes, of))
            hashes, of = hashes[order], of[order]
            new = np.ones(len(of), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
            yield ids[at + i : at + j], hashes[new], np.bincount(of[new], minlength=j - i)
            i = j
        at += n


def _minhashes(hashes: np.ndarray, sizes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """One row of minhashes for each set that is not empty; their low 16 bits."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.empty((len(starts), len(seeds)), np.uint16)
    for j, seed in enumerate(seeds):
        least = np.minimum.reduceat((hashes ^ (hashes >> np.uint64(29))) * seed, starts) if len(starts) else np.zeros(0, np.uint64)
        out[:, j] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


_SIGNED = "doc_id long, n_shingles long, low long, high long, keys binary, sketch binary"


def signatures(rows: DataFrame, spec: Spec) -> DataFrame:
    seeds = mix(np.arange(1, spec.trees * spec.depth + SKETCH + 1, dtype=np.uint64)) | np.uint64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.forget()
        for batch in batches:
            for ids, hashes, sizes in shingle_sets(batch, spec.shingle):
                full = sizes > 0
                m = _minhashes(hashes, sizes, seeds)
                keys = m[:, : spec.trees * spec.depth].astype(">u2")
                bits = (m[:, spec.trees * spec.depth :] & 3).astype(np.uint8).reshape(len(m), (m.shape[1] - spec.trees * spec.depth) // 4, 4)
                sketch = bits[:, :, 0] | bits[:, :, 1] << 2 | bits[:, :, 2] << 4 | bits[:, :, 3] << 6
                starts = (np.cumsum(sizes) - sizes)[full]
                sums = [np.zeros(len(ids), np.uint64) for _ in range(2)]
                for s, salt in zip(sums, (3, 5), strict=True):
                    s[full] = np.add.reduceat(mix(hashes * np.uint64(salt) + np.uint64(salt)), starts) if len(starts) else 0
                at, row = np.cumsum(full) - 1, lambda a, ok, i: a[i].tobytes() if ok else None
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64(), mask=ids == NO_ID), "n_shingles": pa.array(sizes, pa.int64()), "low": sums[0].view(np.int64), "high": sums[1].view(np.int64),
                    "keys": pa.array([row(keys, ok, i) for ok, i in zip(full, at, strict=True)], pa.binary()), "sketch": pa.array([row(sketch, ok, i) for ok, i in zip(full, at, strict=True)], pa.binary()),
                })

    return rows.mapInArrow(sign, _SIGNED)


_FOUND = "a long, b long, matches int, tree int, key binary, doc_id long, sketch binary, run long"


def _neighbours(spec: Spec, ends: bool):
    """Candidates among rows sorted by tree and key, and the members of crowds: runs of equal keys that are too long for
    all their pairs to be candidates; with ``ends``, also the first and last rows of the partition."""
    reach = spec.neighbours + 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("matches", pa.int32()), ("tree", pa.int32()), ("key", pa.binary()), ("doc_id", pa.int64()), ("sketch", pa.binary()), ("run", pa.int64())])

        def edge(rows: pa.Table) -> list[pa.RecordBatch]:
            none = pa.nulls(len(rows), pa.int64())
            return pa.table([none, none, pa.nulls(len(rows), pa.int32()), rows["tree"], rows["key"], rows["doc_id"], rows["sketch"], none], schema=schema).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is None and ends:
                yield from edge(pa.Table.from_batches([batch.slice(0, reach)]))
            old = len(held) if held is not None else 0
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([held, now]) if old else now
            tree, doc = now["tree"].to_numpy(), now["doc_id"].to_numpy()
            key = np.frombuffer(b"".join(now["key"].to_pylist()), np.uint8).reshape(len(now), -1)
            sketch = np.frombuffer(b"".join(now["sketch"].to_pylist()), np.uint8).reshape(len(now), -1)
            prefix = key[:, : 2 * spec.least_prefix]
            last = np.arange(max(old, reach), len(now))
            last = last[(tree[last] == tree[last - reach]) & (key[last] == key[last - reach]).all(axis=1)]
            if len(last):
                crowd = np.unique(last[:, None] - np.arange(reach + 1))
                run = tree[crowd].astype(np.uint64)
                for place in np.ascontiguousarray(key[crowd]).view(np.uint16).T:
                    run = mix(run + place)
                nothing = [pa.nulls(len(crowd), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*nothing, pa.array(doc[crowd]), pa.nulls(len(crowd), pa.binary()), pa.array(run.view(np.int64))], schema=schema)
            for back in range(1, spec.neighbours + 1):
                i = np.arange(max(old, back), len(now))
                i = i[(tree[i] == tree[i - back]) & (doc[i] != doc[i - back]) & (prefix[i] == prefix[i - back]).all(axis=1)]
                x = sketch[i] ^ sketch[i - back]
                matches = SKETCH - np.bitwise_count((x | x >> 1) & 0x55).sum(axis=1, dtype=np.int32)
                good = matches >= spec.least_matches
                a, b = doc[i[good]], doc[i[good] - back]
                if len(a):
                    nothing = [pa.nulls(len(a), t) for t in (pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int64())]
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b)), pa.array(matches[good].astype(np.int32)), *nothing], schema=schema)
            held = now.slice(max(0, len(now) - reach))
        if held is not None and ends:
            yield from edge(held)

    return find


def candidates(nodes: DataFrame, spec: Spec) -> tuple[DataFrame, DataFrame, tuple[str, str]]:
    """Distinct pairs a > b of nodes (doc_id, keys, sketch) with their matching sketch places, and the members (run,
    doc_id) of crowds, in which not all pairs were looked at."""
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    trees = nodes.select("doc_id", "sketch", F.posexplode(F.array(*[F.substring("keys", 2 * spec.depth * t + 1, 2 * spec.depth) for t in range(spec.trees)])).alias("tree", "key"))
    order = ("tree", "key", "doc_id")
    found, path = storage.written(trees.repartitionByRange(2 * n, *order).sortWithinPartitions(*order).mapInArrow(_neighbours(spec, True), _FOUND), "found")
    # at most 2 * neighbours + 2 rows for each partition
    seams = found.where(F.col("tree").isNotNull()).select("tree", "key", "doc_id", "sketch").distinct().coalesce(1).sortWithinPartitions(*order).mapInArrow(_neighbours(spec, False), _FOUND)
    seams, seams_path = storage.written(seams, "seams")
    both = found.where(F.col("tree").isNull()).unionByName(seams)
    pairs, pairs_path = storage.written(both.where(F.col("a").isNotNull()).groupBy("a", "b").agg(F.max("matches").alias("matches")), "pairs")
    crowd, crowd_path = storage.written(both.where(F.col("run").isNotNull()).select("run", "doc_id").distinct(), "crowd")
    storage.remove(nodes.sparkSession, path, seams_path)
    return pairs, crowd, (pairs_path, crowd_path)


def _crowd_links(crowd: DataFrame, nodes: DataFrame, sets: DataFrame, known: DataFrame, spec: Spec) -> DataFrame:
    """Links a > b that connect members of a crowd which ``known`` (id, component) leaves apart: of each pair of blocks
    a forest of all such links. Members of a crowd's largest component do not meet each other, only those outside it
    do, and each of these meets all others: so work grows with members times outsiders, and a crowd that is one component
    costs nothing."""
    rows = crowd.join(known.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    parts = rows.groupBy("run", "component").agg(F.count("*").alias("n"))
    runs = parts.groupBy("run").agg(F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("main")).where(F.col("all") > F.col("main.n"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    runs = runs.select("run", F.col("main.component").alias("main"), blocks(F.col("all")).alias("blocks"), blocks(F.col("all") - F.col("main.n")).alias("outer"))
    members = rows.join(runs, "run").join(nodes.select("doc_id", "sketch"), "doc_id").join(sets, "doc_id")
    # a group is a block of outsiders against a block of all; an outsider is in both
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    own, outer = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("outer")).cast("int")
    as_member = F.transform(upto(F.col("outer")), lambda o: F.struct(o.alias("one"), own.alias("two"), F.lit(False).alias("out")))
    as_outsider = F.transform(upto(F.col("blocks")), lambda b: F.struct(outer.alias("one"), b.alias("two"), F.lit(True).alias("out")))
    places = F.when(F.col("component") == F.col("main"), as_member).otherwise(F.concat(as_member, as_outsider))
    full = members.select("run", "doc_id", "component", "sketch", "shingles", F.explode(places).alias("at")).select("run", "at.*", "doc_id", "component", "sketch", "shingles")

    def compare(key, table):
        out = table["out"].to_numpy()
        left, right = np.flatnonzero(out), np.flatnonzero(~out)
        doc, component = table["doc_id"].to_numpy(), table["component"].to_numpy()
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(doc), -1)
        sizes = np.array([len(x) // 8 for x in table["shingles"].to_pylist()], np.int64)
        low, high = np.minimum(sizes[left][:, None], sizes[right]), np.maximum(sizes[left][:, None], sizes[right])
        may = (component[left][:, None] != component[right]) & (100 * low >= spec.percent * high)
        differ = np.zeros(may.shape, np.int32)
        for x in sketch.T:
            d = x[left][:, None] ^ x[right]
            differ += np.bitwise_count((d | d >> np.uint64(1)) & np.uint64(0x5555555555555555))
        may &= SKETCH - differ >= spec.least_matches
        rows_, columns = may.any(axis=1), may.any(axis=0)
        left, right, may = left[rows_], right[columns], may[np.ix_(rows_, columns)]
        both = intersections([table["shingles"][int(i)].as_buffer() for i in left], [table["shingles"][int(i)].as_buffer() for i in right]) if may.any() else np.zeros(may.shape)
        linked = may & (100 * both >= spec.percent * (sizes[left][:, None] + sizes[right] - both))
        a, b = forest(linked, doc[left], doc[right])
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    return full.groupBy("run", "one", "two").applyInArrow(compare, "a long, b long")


def intersections(left: list, right: list) -> np.ndarray:
    """Sizes of the intersections of two lists of sets (buffers of distinct 64-bit hashes), as products of 0/1 matrices
    over a part of the hashes at a time."""
    x, y = ([np.frombuffer(b, np.uint64) for b in some] for some in (left, right))
    of = [np.repeat(np.arange(len(some)), [len(s) for s in some]) for some in (x, y)]
    x, y = np.concatenate(x), np.concatenate(y)
    common = np.intersect1d(x, y)  # hashes on one side only cannot count
    out = np.zeros((len(left), len(right)), np.float32)
    place = [np.searchsorted(common, h) for h in (x, y)]
    place = [np.where(common[np.minimum(p, len(common) - 1)] == h, p, -1) for p, h in zip(place, (x, y), strict=True)] if len(common) else []
    for start in range(0, len(common), COLUMNS):
        parts = []
        for p, o, n in zip(place, of, out.shape, strict=True):
            here = (p >= start) & (p < start + COLUMNS)
            m = np.zeros((n, min(COLUMNS, len(common) - start)), np.float32)
            m[o[here], p[here] - start] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out.astype(np.int64)


def forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Real links (left, right) that connect whatever ``linked`` connects: those that join two parts
    which earlier ones left apart."""
    out: set[tuple[int, int]] = set()
    top = np.arange(len(left) + len(right))

    def root(i: int) -> int:
        while top[i] != i:
            top[i] = i = top[top[i]]
        return i

    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = root(int(i)), root(len(left) + int(j))
        if a != b:
            top[a] = b
            out.add((int(left[i]), int(right[j])))
    pairs = np.array(sorted(out), np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _confirmed(pairs: DataFrame, sets: DataFrame, spec: Spec) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union of the full sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= spec.percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.select("a", "b").join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    both = one.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def _joined(known: DataFrame, path: str, links: DataFrame) -> tuple[DataFrame, str]:
    """Components (id, component) and their table once more links are added: these connect components, so only the graph of
    components is worked on; without links all stays as it is."""
    if links.isEmpty():
        return known, path
    spark = links.sparkSession
    of = lambda c: known.select(F.col("id").alias(c), F.col("component").alias(f"{c}_of"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_of", "a").alias("a"), F.coalesce("b_of", "b").alias("b"))
    moved, moved_path = components(ends)
    new = moved.join(known, "id", "left_anti").select("id", F.col("id").alias("component"))
    to = moved.select(F.col("id").alias("component"), F.col("component").alias("to"))
    all_ids = known.unionByName(new).join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    out, out_path = storage.written(all_ids, "components")
    storage.remove(spark, path, moved_path)
    return out, out_path


def near_duplicates(docs: DataFrame, spec: Spec = Spec(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (least doc_id reachable by links) and kept.

    Null, empty and blank texts have an empty set and link with nothing. Rows that repeat a doc_id are one document: a
    link of either holds for both. A null doc_id is never linked and is kept. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    signed, signed_path = storage.written(signatures(rows, spec), "signed")
    real = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    nodes, nodes_path = storage.written(real.groupBy("n_shingles", "low", "high").agg(F.min_by(F.struct("doc_id", "keys", "sketch"), "doc_id").alias("r")).select("n_shingles", "low", "high", "r.*"), "nodes")
    pairs, crowd, candidate_paths = candidates(nodes, spec)
    involved = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(crowd.select("doc_id")).distinct()

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, hashes, sizes in shingle_sets(batch, spec.shingle):
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "shingles": pa.array([hashes[b - n : b].tobytes() for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary())})

    sets, sets_path = storage.written(rows.join(involved.hint("merge"), "doc_id", "left_semi").mapInArrow(sets_of, "doc_id long, shingles binary"), "sets")
    storage.remove(spark)
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("matches"), "b"))
    ranked, ranked_path = storage.written(pairs.withColumn("place", best), "ranked")
    sure, sure_path = storage.written(_confirmed(ranked.where("place <= 2"), sets, spec).distinct(), "links")
    storage.remove(spark)
    known, known_path = components(sure)
    of = lambda c: known.select(F.col("id").alias(c), F.col("component").alias(f"{c}_of"))
    rest = ranked.where("place > 2").join(of("a"), "a", "left").join(of("b"), "b", "left")
    rest = rest.where(F.coalesce("a_of", "a") != F.coalesce("b_of", "b"))
    more, more_path = storage.written(_confirmed(rest, sets, spec), "links")
    linked, linked_path = _joined(known, known_path, more)
    late, late_path = storage.written(_crowd_links(crowd, nodes, sets, linked, spec), "links")
    linked, linked_path = _joined(linked, linked_path, late)
    classes = nodes.join(linked.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("n_shingles", "low", "high", F.coalesce("component", "doc_id").alias("component"))
    classes, classes_path = storage.written(classes, "classes")
    storage.remove(spark, nodes_path, sets_path, ranked_path, sure_path, more_path, late_path, linked_path, *candidate_paths)
    out = signed.select("doc_id", "n_shingles", "low", "high").join(classes, ["n_shingles", "low", "high"], "left")
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


#: The same rows from the full sets of all documents, by counting shared shingles.
OP2_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM d, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 1, 2) END)) AS t(i)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
reach AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM documents JOIN least ON id = doc_id LEFT JOIN sizes USING (doc_id)
"""


def op2_lsh_forest(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Spec(shingle=3, percent=85))

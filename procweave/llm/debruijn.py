"""Substring dedup over words by de Bruijn compaction.

A node of the graph is ``size - 1`` words in a row, an edge is ``size`` words: it leads from the node of its first to that of
its last ``size - 1`` words. Only edges that occur in two documents matter, so only nodes under anchors that several groups
of documents have (see ``repeats``) enter the graph.

1. Nodes are dealt out by anchor. Consecutive nodes of one anchor travel as one walk, with the node before and the node
   after, so a bucket sees every edge at its nodes: an edge is a pair of node hashes (128 bits).
2. A bucket keeps the edges that two documents have, each with its source: the least doc_id and the place there. It counts
   edges into and out of each of its nodes, and chains edges through nodes with one of either, as long as their sources
   follow each other: these are pieces of nonbranching paths.
3. Pieces of different buckets share the edge at which they touch. Spark joins glue them, with pointers that double
   their reach each round, so a path of n pieces takes log2(n) rounds.
4. Groups get source and path of their edges. Windows whose source is a smaller doc_id are marked, and marked windows
   that follow each other in one path form long spans.
5. Distinct spans are compared, word for word, with the text at the source coordinates of their path. A span that differs
   (two contents with equal hashes) raises an error, so no word goes unverified.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats, storage
from .winnow import covered, grow, mix, runs

_WALKS = "bucket int, grp int, n int, shape binary, docs binary, places binary, nodes binary"
_EDGES = "grp int, row int, at int, n int, src_doc long, src_pos int, piece_pos int, open_left boolean, open_right boolean, length int"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:int,stop:int>>"
_SPAN = "src_doc long, path_pos int, shift int, words int, text string"
_SHAPE = np.dtype([("nodes", "u1"), ("first", "u1"), ("own", "u1"), ("twice", "u1")])


class Walks:
    """Walks over nodes of a group that other documents may have too: each distinct one once, with the least doc_id of the
    group that has it, in order of bucket. Nodes of a hot anchor are dealt out one by one."""

    def __init__(self, group: repeats.Group, answers: pa.Table):
        self.group, size, at = group, group.spec.size, 0
        code, base, columns = group.codes(answers), 0, [[] for _ in range(8)]
        for p in group.parts:
            mine = code[at : at + len(p.paths.lo)]
            at += len(mine)
            shared, hot = np.flatnonzero(mine == repeats.SHARED), np.flatnonzero(mine == repeats.HOT)
            n = p.paths.hi - p.paths.lo + 1
            one = grow(p.paths.lo[hot], n[hot]) if len(hot) else hot
            lo, hi = np.concatenate([p.paths.lo[shared], one]), np.concatenate([p.paths.hi[shared], one])
            doc = np.concatenate([p.paths.doc[shared], np.repeat(p.paths.doc[hot], n[hot])])
            start, stop = np.maximum(lo - 1, p.starts[doc]), np.minimum(hi + 1, p.starts[doc + 1] - size)
            spans = p.paths.sequence.spans
            key = np.concatenate([p.paths.anchor[shared], mix(spans(one, one + size)) if len(one) else p.paths.anchor[:0]])
            shape = (stop - start + 1) << 16 | (lo - start) << 8 | (hi - lo + 1)
            content = mix(spans(start, stop + size) ^ mix(shape.astype(np.uint64))) if len(start) else key
            for column, x in zip(columns, (key, content, p.ids[doc], start + base, start - p.starts[doc], stop - start + 1, lo - start, hi - lo + 1), strict=True):
                column.append(x)
            base += int(p.starts[-1])
        kinds = (np.uint64, np.uint64, *[np.int64] * 6)
        key, content, self.owner, self.start, pos, n, first, own = (np.concatenate([np.zeros(0, k), *c]) for k, c in zip(kinds, columns, strict=True))
        bucket = repeats.bucket_of(key, group.buckets)
        order, of, least = repeats.least(bucket, key, content, docs=self.owner)
        self.of_row = np.empty(len(order), np.int64)
        self.of_row[order] = of
        begin = np.flatnonzero(np.diff(of, prepend=-1))
        self.sent, self.least, self.n, self.pos = order[begin], least, n, pos
        most = np.maximum.reduceat(self.owner[order], begin) if len(order) else least
        self.shape = np.zeros(len(self.sent), _SHAPE)
        for name, x in zip(_SHAPE.names, (n[self.sent], first[self.sent], own[self.sent], most > least), strict=True):
            self.shape[name] = x
        self.cuts = np.searchsorted(bucket[self.sent], np.arange(group.buckets + 1))

    def messages(self, grp: int) -> pa.Table:
        size, none = self.group.spec.size, np.zeros(0, np.uint64)
        # the nodes of a part, padded so that places count words in all parts
        nodes = np.concatenate([none, *(np.concatenate([mix(p.paths.sequence.fixed(size)), np.zeros(min(size - 1, len(p.paths.sequence.units)), np.uint64)]) for p in self.group.parts)])
        full, out = np.flatnonzero(np.diff(self.cuts)), []
        for b in full:
            s = slice(self.cuts[b], self.cuts[b + 1])
            rows = self.sent[s]
            out.append((len(rows), self.shape[s].tobytes(), self.least[s].tobytes(), self.pos[rows].astype(np.int32).tobytes(), nodes[grow(self.start[rows], self.n[rows])].tobytes()))
        n, *packed = zip(*out, strict=True) if out else ([], [], [], [], [])
        return pa.table({"bucket": pa.array(full, pa.int32()), "grp": pa.array([grp] * len(full), pa.int32()), "n": pa.array(n, pa.int32())} | {k: pa.array(x, pa.binary()) for k, x in zip(("shape", "docs", "places", "nodes"), packed, strict=True)})


def _graph(key, table):
    """Of a bucket: for each walk that it was sent the edges that several documents have, as runs (place ``at`` in the walk,
    ``n`` edges) with source and piece; and one row without ``grp`` for each piece."""
    whole = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
    shape, docs, pos, nodes, sizes = whole("shape", _SHAPE), whole("docs", np.int64), whole("places", np.int32).astype(np.int64), whole("nodes", np.uint64), np.array(table["n"].to_pylist(), np.int64)
    n = shape["nodes"].astype(np.int64)
    begin = np.cumsum(n) - n
    walk = np.repeat(np.arange(len(n)), n - 1)
    at = np.arange(len(walk)) - np.repeat(np.cumsum(n - 1) - (n - 1), n - 1)
    tail = begin[walk] + at
    own = lambda place: (place >= shape["first"][walk]) & (place < shape["first"][walk].astype(np.int64) + shape["own"][walk])
    u, v, own_u, own_v, doc, where = nodes[tail], nodes[tail + 1], own(at), own(at + 1), docs[walk], pos[walk] + at
    order = np.lexsort((where, doc, v, u))
    new = np.ones(len(order), bool)
    new[1:] = (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])
    first, of = np.flatnonzero(new), np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    schema = pa.schema([(c.split()[0], {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}[c.split()[1]]) for c in _EDGES.split(", ")])
    if not len(order):
        return schema.append(pa.field("bucket", pa.int32())).empty_table()
    source = order[first]  # an edge's least document, and the first place there
    edge = np.flatnonzero((np.maximum.reduceat(doc[order], first) > doc[source]) | np.logical_or.reduceat(shape["twice"][walk][order] > 0, first))
    # ends that are this bucket's own nodes, with the number of such edges into and out of them
    all_nodes, ends = np.unique(np.concatenate([u[source[edge]], v[source[edge]]]), return_inverse=True)
    out, into = np.bincount(ends[: len(edge)], minlength=len(all_nodes)), np.bincount(ends[len(edge) :], minlength=len(all_nodes))
    through = (out == 1) & (into == 1)
    # in order of their sources, edges that a path joins are neighbours
    line = np.lexsort((where[source[edge]], doc[source[edge]]))
    e, ends = edge[line], ends.reshape(2, -1)[:, line]
    s = source[e]
    joined = np.zeros(len(e), bool)
    joined[1:] = (doc[s][1:] == doc[s][:-1]) & (where[s][1:] == where[s][:-1] + 1) & (ends[0][1:] == ends[1][:-1]) & through[ends[0][1:]] & own_u[s][1:]
    head = np.flatnonzero(~joined)
    piece = np.cumsum(~joined) - 1
    length = np.diff(np.append(head, len(e)))
    begin_pos, last = where[s[head]] if len(head) else head, head + length - 1
    left, right = ~own_u[s[head]], ~own_v[s[last]]
    place = np.full(len(first), -1)
    place[e] = np.arange(len(e))
    told = np.flatnonzero((place[of] >= 0) & own_u)  # an edge is told once, where its first node is at home
    mine = place[of[told]]
    fresh = np.ones(len(told), bool)
    fresh[1:] = (walk[told][1:] != walk[told][:-1]) | (at[told][1:] != at[told][:-1] + 1) | (mine[1:] != mine[:-1] + 1) | (piece[mine][1:] != piece[mine][:-1])
    run = np.flatnonzero(fresh)
    row = np.arange(len(n)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grp = np.repeat(np.array(table["grp"].to_pylist(), np.int32), sizes)
    w, m = walk[told[run]], mine[run]
    none = np.zeros(len(head), np.int64)
    columns = {
        "grp": (grp[w], none), "row": (row[w], none), "at": (at[told[run]], none), "n": (np.diff(np.append(run, len(told))), none), "src_doc": (doc[s[m]], doc[s[head]]), "src_pos": (where[s[m]], begin_pos),
        "piece_pos": (begin_pos[piece[m]], begin_pos), "open_left": (left[piece[m]], left), "open_right": (right[piece[m]], right), "length": (length[piece[m]], length),
    }
    told_n = len(run)
    arrays = [pa.array(np.concatenate(x), schema.field(k).type, mask=(np.arange(told_n + len(head)) >= told_n) if k == "grp" else None, safe=False) for k, x in columns.items()]
    return pa.Table.from_arrays(arrays, schema=schema).append_column("bucket", pa.array(np.full(told_n + len(head), key[0].as_py(), np.int32)))


def _glued(pieces: DataFrame) -> tuple[DataFrame, str]:
    """``path_pos``, where its path begins in the source, for each piece (src_doc, piece_pos, open_left). Each round joins
    every piece's pointer with the pointer of the piece that it points to."""
    keys = ("src_doc", "piece_pos", "open_left")
    before = pieces.where("open_right").select("src_doc", (F.col("piece_pos") + F.col("length") - 1).alias("piece_pos"), F.col("piece_pos").alias("to_pos"), F.col("open_left").alias("to_open"), F.lit(True).alias("open_left"))
    now, path = storage.written(pieces.select(*keys).join(before, [*keys], "left"), "pointers")
    while not now.where("to_open").isEmpty():
        step = now.select("src_doc", F.col("piece_pos").alias("to_pos"), F.col("open_left").alias("to_open"), F.col("to_pos").alias("far_pos"), F.col("to_open").alias("far_open"))
        ahead = now.join(step, ["src_doc", "to_pos", "to_open"], "left")
        # a piece that is open to the left but has nothing there is a path's first
        new = ahead.select(*keys, F.coalesce("far_pos", "to_pos").alias("to_pos"), F.when(F.col("far_pos").isNull(), F.lit(False)).otherwise(F.col("far_open")).alias("to_open"))
        new, new_path = storage.written(new.select(*keys, "to_pos", F.when(F.col("to_pos").isNotNull(), F.col("to_open")).alias("to_open")), "pointers")
        storage.remove(pieces.sparkSession, path)
        now, path = new, new_path
    return now.select(*keys, F.coalesce("to_pos", "piece_pos").alias("path_pos")), path


def _digest(size: int):
    def finish(part: repeats.Part, windows: np.ndarray) -> pa.RecordBatch:
        n = int(part.starts[-1])
        gone = covered(n, windows, size)
        n_removed = np.concatenate([[0], np.cumsum(gone)])[part.starts]
        # kept words, each with one space before it, copied at once
        start, stop = part.word_start[~gone], part.word_stop[~gone]
        length = stop - start + 1
        ends = np.cumsum(length)
        flat = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
        if len(length):
            source = np.arange(len(flat)) - np.repeat(ends - length, length)
            inside = source > 0
            flat[inside] = part.data[(np.repeat(start, length) + source - 1)[inside]]
        kept = np.concatenate([[0], np.cumsum(~gone)])[part.starts]
        at = np.concatenate([[0], ends])[kept]
        raw = flat.tobytes()
        digests = [hashlib.sha256(raw[a + 1 : b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        edge = gone.copy()
        edge[part.starts[:-1][part.lengths > 0]] = False  # spans never run on into the next document
        spans: list[list[dict]] = [[] for _ in part.ids]
        for d in np.flatnonzero(np.diff(n_removed)):
            a, b = runs(gone[part.starts[d] : part.starts[d + 1]])
            spans[d] = [{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        return pa.RecordBatch.from_pydict({"doc_id": [None if i == repeats.NO_ID else i for i in part.ids.tolist()], "n_words": part.lengths, "n_removed": np.diff(n_removed), "kept_sha256": digests, "spans": spans}, schema=pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))]))

    return finish


def _marked(group: repeats.Group, walks: Walks, told: pa.Table) -> tuple[list[np.ndarray], list[dict]]:
    """Windows of each part that a smaller doc_id has too, and the long spans of them as distinct rows of ``_SPAN``."""
    row, at, n, src, pos, path = (told[c].to_numpy().astype(np.int64) for c in ("row", "at", "n", "src_doc", "src_pos", "path_pos"))
    # every walk of the group with the runs told for the one that was sent
    order = np.argsort(row, kind="stable")
    cut = np.searchsorted(row[order], np.arange(len(walks.sent) + 1))
    many = (cut[1:] - cut[:-1])[walks.of_row]
    walk = np.repeat(np.arange(len(walks.of_row)), many)
    one = order[grow(cut[:-1][walks.of_row], many)] if len(walk) else walk
    later = src[one] < walks.owner[walk]
    walk, one = walk[later], one[later]
    start = walks.start[walk] + at[one]
    line = np.argsort(start)
    start, one = start[line], one[line]
    count, end = n[one], start + n[one]
    spans, marked, base, size = {}, [], 0, group.spec.size + 1
    for p in group.parts:
        a, b = np.searchsorted(start, [base, base + int(p.starts[-1])])
        first = start[a:b] - base
        marked.append(grow(first, count[a:b]) if b > a else first)
        doc = np.searchsorted(p.starts, first, side="right")
        o = one[a:b]
        fresh = np.ones(b - a, bool)
        fresh[1:] = (first[1:] != end[a:b][:-1] - base) | (doc[1:] != doc[:-1]) | (src[o][1:] != src[o][:-1]) | (path[o][1:] != path[o][:-1]) | (pos[o][1:] != pos[o][:-1] + count[a:b][:-1])
        begin = np.flatnonzero(fresh)
        stop = np.append(begin[1:], b - a)[: len(begin)] - 1
        for i, j in zip(begin.tolist(), stop.tolist(), strict=True):
            x, y = int(first[i]), int(first[j] + count[a + j]) + size - 1
            text = b" ".join(p.data[s:t].tobytes() for s, t in zip(p.word_start[x:y].tolist(), p.word_stop[x:y].tolist(), strict=True)).decode("utf-8", "replace")
            spans[int(src[o[i]]), int(path[o[i]]), int(pos[o[i]] - path[o[i]]), y - x, text] = None
        base += int(p.starts[-1])
    return marked, [dict(zip(("src_doc", "path_pos", "shift", "words", "text"), k, strict=True)) for k in spans]


def _differing(docs: DataFrame, spans: DataFrame, paths: DataFrame, size: int) -> DataFrame:
    """Spans whose words are not those at their place in the path's source text."""
    once = spans.groupBy("src_doc", "path_pos", "shift", "words", F.sha2("text", 256).alias("sha")).agg(F.first("text").alias("text"))
    ends = paths.groupBy("src_doc", "path_pos").agg(F.max(F.col("piece_pos") + F.col("length") + F.lit(size - 1)).alias("stop"))
    used = ends.join(once.select("src_doc", "path_pos").distinct(), ["src_doc", "path_pos"])
    cuts = used.groupBy("src_doc").agg(F.collect_list(F.struct("path_pos", "stop")).alias("cuts"))  # bounded by the document's length
    said = F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != "")
    source = docs.join(cuts, docs["doc_id"] == cuts["src_doc"]).select("src_doc", "cuts", said.alias("said")).select("src_doc", F.explode("cuts").alias("c"), "said")
    source = source.select("src_doc", "c.path_pos", F.slice("said", F.col("c.path_pos") + 1, F.col("c.stop") - F.col("c.path_pos")).alias("said")).distinct()
    both = once.join(source, ["src_doc", "path_pos"], "left")
    same = F.coalesce(F.array_join(F.slice("said", F.col("shift") + 1, F.col("words")), " ") == F.col("text"), F.lit(False))
    # rows that repeat an id have several texts, one of which is the source
    return both.groupBy("src_doc", "path_pos", "shift", "words", "sha").agg(F.max(same).alias("same")).where("NOT same")


def repeated_spans(docs: DataFrame, *, size: int = 50, k: int = 25, hot: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Word spans that documents of smaller id have too, one row per document: doc_id, n_words, n_removed,
    kept_sha256 (kept words joined by a space) and spans (start, stop in words).

    Null or empty text has no words and keeps the digest of the empty string; however long, a text is one document and its
    spans run on across all of it. Rows that repeat a doc_id are judged alike and do not remove each other; a null doc_id
    counts as larger than all. Other columns are ignored.
    """
    spark, spec, digest = docs.sparkSession, repeats.Spec("word", size - 1, k, hot=hot), _digest(size)
    with repeats.Dealt(docs, spec, id_col=id_col, text_col=text_col) as dealt:
        buckets = dealt.buckets

        def send(key, table, answers):
            return Walks(repeats.Group(table, spec, buckets), answers).messages(key[0].as_py())

        def last(key, table, both):
            anchors = both.filter(pa.compute.is_valid(both["codes"]))
            group = repeats.Group(table, spec, buckets)
            walks = Walks(group, anchors)
            told = both.filter(pa.compute.is_null(both["codes"]))
            told = told.set_column(told.schema.get_field_index("row"), "row", pa.array(walks.cuts[told["bucket"].to_numpy()] + told["row"].to_numpy()))
            marked, spans = _marked(group, walks, told)
            done = pa.Table.from_batches([digest(p, w) for p, w in zip(group.parts, marked, strict=True)])
            more = pa.Table.from_pylist(spans, schema=pa.schema([("src_doc", pa.int64()), ("path_pos", pa.int32()), ("shift", pa.int32()), ("words", pa.int32()), ("text", pa.string())]))
            return pa.concat_tables([done, more], promote_options="default")

        walks = dealt.grouped.cogroup(dealt.answers.groupBy("grp")).applyInArrow(send, _WALKS)
        graph, graph_path = storage.written(walks.groupBy("bucket").applyInArrow(_graph, _EDGES + ", bucket int"), "graph")
        storage.remove(spark)
        pieces = graph.where("grp IS NULL").select("src_doc", "piece_pos", "open_left", "open_right", "length")
        paths, paths_path = _glued(pieces)
        told = graph.where("grp IS NOT NULL").join(paths, ["src_doc", "piece_pos", "open_left"]).select("grp", "bucket", "row", "at", "n", "src_doc", "src_pos", "path_pos")
        answers = dealt.answers.unionByName(told, allowMissingColumns=True).groupBy("grp")
        out, _ = storage.written(dealt.grouped.cogroup(answers).applyInArrow(last, _RESULT + ", " + _SPAN), "repeats")
        storage.remove(spark)
        rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
        differing = _differing(rows, out.where("text IS NOT NULL").select("src_doc", "path_pos", "shift", "words", "text"), pieces.join(paths, ["src_doc", "piece_pos", "open_left"]), size)
        wrong = differing.limit(1).collect()
        storage.remove(spark, graph_path, paths_path)
        if wrong:
            raise RuntimeError(f"words differ from their source: {wrong[0]}")
    return out.where("text IS NULL").select("doc_id", "n_words", "n_removed", "kept_sha256", "spans")


#: The same rows from all windows of all documents.
OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM d, unnest(range(1, len(w) - 48)) AS t(i)),
firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
marked AS (SELECT doc_id, i FROM windows JOIN firsts USING (s) WHERE least < doc_id),
units AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d),
covered AS (
  SELECT u.doc_id, j, x, coalesce(count(m.i) OVER (PARTITION BY u.doc_id ORDER BY j ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0, false) AS gone
  FROM units u LEFT JOIN marked m ON m.doc_id = u.doc_id AND m.i = u.j),
runs AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY j) AS first FROM covered)
SELECT d.doc_id, len(any_value(w)) AS n_words, count_if(gone)::BIGINT AS n_removed, count_if(first)::INT AS n_spans,
  sha256(coalesce(string_agg(x, ' ' ORDER BY j) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id
"""


def op5_debruijn_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return repeated_spans(docs).select("doc_id", "n_words", "n_removed", "kept_sha256", F.size("spans").alias("n_spans"))

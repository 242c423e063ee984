"""The prefix table against the library, resampling and the filter audit against brute force: nulls, empty and long texts,
repeated rows, ties, empty tables and columns of clashing names."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from procweave.llm import filter_audit, importance, prefix_bpe

from .test_ops import made_texts

PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


@pytest.fixture(scope="module")
def docs(spark):
    labels = ["en", "de", None, ""]
    rows = [(i, t, labels[i % 4], "n", i, 1) for i, t in enumerate(made_texts())] + [(5, made_texts()[5], "en", "n", 0, 1), (5, "one two", "en", "n", 0, 1), (None, made_texts()[0], None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, row string, score int, fails int").repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "", r.lang or "") for r in docs.collect()]


def hexed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_pieces_as_the_library(library, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "REMEMBERED", 500)
    model, r = prefix_bpe.Model(PIECE), random.Random(4)
    some = r.sample(list(model.ids), 4000)
    parts = [*"aB.,;!?'\n\t  é²Ⅷ3_-<|>ß中́　\xa0\x1c\r\x00", "▁", "<s>", "<0x41>", "   ", " " * 17, "\n\n", "日本", "\U0001f600", "function", "====", "İ"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(3000)] + ["".join(r.choice(some) for _ in range(r.randint(1, 9))) for _ in range(3000)]
    texts += [" " * n for n in range(70)] + ["ab" * 4000, "e" * 5000, "ü" * 3000, "".join(r.choice("abé ") for _ in range(20_000))]
    for text in texts:
        ids = model.encode(text)
        assert ids.tolist() == library.encode(text), text
        assert model.decode(ids) == library.decode(ids.tolist())
    assert len(model._known) <= 500 and len(model._pairs) <= 500


def test_cuts_change_nothing(library):
    """Whole texts in one table give what cut ones do, and each prefix's last token is that of its own encoding."""
    model, r = prefix_bpe.Model(PIECE), random.Random(6)
    text = "".join(r.choice(["the", " cat", "s ", "\n", ", ", "…", "x7", "é"]) for _ in range(400))
    whole = "▁" + text.replace(" ", "▁")
    assert np.frombuffer(model._encode_part(whole), "<u4").tolist() == library.encode(text)
    last = model.last_tokens(whole)
    for n in range(1, 200):
        ids = library.encode(text[:n])
        assert last[n] == (ids[-1] if ids[-1] >= 259 else -1)


def test_ids_that_no_text_has(library):
    model, r = prefix_bpe.Model(PIECE), random.Random(8)
    for _ in range(300):
        ids = [r.randrange(300 if r.random() < 0.5 else 32_000) for _ in range(r.randint(0, 6))]
        assert model.decode(np.array(ids, "<u4")) == library.decode(ids)


def test_prefix_table_on_documents(docs, rows, library):
    encoded = prefix_bpe.encode(docs, PIECE)
    key = lambda x: (str(x[0]), *x[1:])
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in encoded.collect()), key=key)
    assert got == sorted(((i, library.encode(t)) for i, t, _ in rows), key=key)
    assert sorted(map(key, prefix_bpe.decode(encoded, PIECE).collect())) == sorted(key((i, t)) for i, t, _ in rows)
    want = [(i, len(x), hexed(",".join(map(str, x))), hexed(library.decode(x))) for i, t, _ in rows for x in [library.encode(t)]]
    assert sorted(map(key, prefix_bpe.digests(docs, PIECE).collect())) == sorted(map(key, want))
    assert prefix_bpe.digests(docs.where("doc_id < 0"), PIECE).count() == 0


def draw(rows, target, spec):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
    bucket = lambda w: zlib.crc32(w.encode()) % spec.buckets
    s, t = (collections.Counter(bucket(w) for x in texts for w in fold(x)) for texts in ([r[1] for r in rows], target))
    all_s, all_t, out = sum(s.values()), sum(t.values()), []
    for i, text, *_ in rows:
        words = fold(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + spec.buckets) / ((s[b] + 1) * (all_t + spec.buckets)))) for b in map(bucket, words)]
        weight = math.floor(sum(gain) / len(gain)) if gain else 0
        h = int(hexed(f"2024:{'' if i is None else i}")[:8], 16)
        out.append([i, len(words), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    best = sorted((r for r in out if r[1] >= spec.least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {id(r): n for n, r in enumerate(best[: spec.percent * len(best) // 100], 1)}
    return [(*r, rank.get(id(r))) for r in out]


@pytest.mark.parametrize(("gather", "percent"), [(0, 10), (0, 60), (4, 30), (4096, 10), (4096, 100)])
def test_resampling(docs, rows, spark, monkeypatch, gather, percent):
    monkeypatch.setattr(importance.cutoff, "__defaults__", (gather,))
    target = spark.createDataFrame([(1, "abc ade cab"), (2, None), (3, "ABC é")], "item_id long, text string")
    spec = importance.Spec(percent=percent, buckets=97)
    got = importance.resample(docs, target, spec).collect()
    want = draw(rows, ["abc ade cab", "ABC é"], spec)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(r[4] is not None for r in want) > 1


def test_resampling_of_little(docs, spark):
    target = spark.createDataFrame([], "text string")
    assert importance.resample(docs.where("doc_id < 0"), target).count() == 0
    assert [r.rank for r in importance.resample(docs.where("doc_id = 0"), target).collect()] == [None]
    assert [r.rank for r in importance.resample(docs.where("doc_id = 0"), target, importance.Spec(percent=100)).collect()] == [1]


def test_cutoff_amid_equal_scores(spark):
    """All scores equal, so ids decide; every wanted number is met exactly, without fetching keys."""
    rows = spark.createDataFrame([(7 if i % 3 else 5, 100 - i // 2, 1, i) for i in range(60)], "score long, doc_id long, n_features long, row long").repartition(5).cache()
    keys = sorted((-r.score, r.doc_id, r.n_features, r.row) for r in rows.collect())
    for wanted in (0, 1, 2, 17, 30, 59, 60):
        assert importance.cutoff(rows, wanted, 0) == (keys[wanted - 1] if 0 < wanted < 60 else None)


def audited(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    facts = []
    for i, t, part in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        copy = t in first and (i is None or i > first[t])
        facts.append((part, {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": copy}, *labels.get(i, (0, 0))))
    out, shapley = {}, collections.Counter()
    for part, order in itertools.product({r[2] for r in rows}, itertools.permutations("ABCDE")):
        left = here = [f for f in facts if f[0] == part]
        for step, x in enumerate(order, 1):
            gone = [f for f in left if f[1][x]]
            left = [f for f in left if not f[1][x]]
            shapley[part, x] += len(gone)
            failing = sum(f[1][x] for f in here)
            out[part, "".join(order), step] = len(left), len(gone), failing - len(gone), sum(f[1][x] and sum(f[1].values()) == 1 for f in here), sum(f[2] for f in gone), sum(f[3] for f in gone)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_filter_audit(docs, rows, spark, block):
    some = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 20)] + [(4, 1, None), (4, None, 1), (None, 1, 1), (999, 1, 1)]
    labels = spark.createDataFrame(some, "doc_id long, quality int, toxic int")
    known = {}
    for i, q, t in some:
        if i is not None:
            a, b = known.get(i, (0, 0))
            known[i] = max(a, int(q == 1)), max(b, int(t == 1))
    got = [tuple(r) for r in filter_audit.audit_documents(docs, labels, block=block).collect()]
    assert len(got) == 3 * 600 and set(got) == audited(rows, known)
    assert filter_audit.audit_documents(docs, labels.where("doc_id < 0")).where("good_lost + toxic_lost > 0").count() == 0
    assert filter_audit.audit_documents(docs.where("doc_id < 0"), labels).count() == 0


def test_lists_of_ids():
    r = np.random.default_rng(3)
    for _ in range(50):
        a, b, c = (np.flatnonzero(r.random(200) < p) for p in r.random(3) ** 2)
        assert filter_audit.union([a, b, c]).tolist() == sorted({*a.tolist(), *b.tolist(), *c.tolist()})
        assert filter_audit.difference(a, b, c).tolist() == sorted({*a.tolist()} - {*b.tolist()} - {*c.tolist()})


def test_one_text_in_many_rows(spark):
    """A third of all rows holds one text; ids that are no copies of smaller ones stay."""
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 1, "same").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"), F.lit("en").alias("lang"))
    rows = filter_audit.with_copies(filter_audit.judge(docs)).where("fails >= 16").collect()
    assert sorted(r.doc_id for r in rows) == list(range(4, 900, 3))


def test_prefix_table_query(spark, library):
    """The registered query over its whole table against the library."""
    path = "/root/testdata/sf0.001"
    got = {tuple(r) for r in prefix_bpe.op11_prefix_table(spark, path).collect()}
    want = set()
    for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        want.add((r.doc_id, len(ids), hexed(",".join(map(str, ids))), hexed(library.decode(ids))))
    assert got == want


def test_known_pieces_are_looked_up_once():
    """A text whose pieces are remembered costs one look at each piece."""
    import public_tokenizers

    from procweave.llm import tokens

    class Counted(dict):
        looks = 0

        def get(self, key, default=None):
            self.looks += 1
            return super().get(key, default)

        def __getitem__(self, key):
            self.looks += 1
            return super().__getitem__(key)

    e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    texts = ["one two, three\nfour  five six", None, "", "six one one"]
    want = e.encode(texts)
    e._rest = Counted(e._rest)
    assert e.encode(texts) == want and e._rest.looks <= sum(len(e._split(t)) for t in texts if t)

"""Training-data operators against brute force, on a small table with nulls, empty and long texts, repeated rows and
columns whose names clash with those that the operators use inside."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from procweave.llm import chat, components, debruijn, kmeans_tree, langid, lpf, minhash_forest, multi_index, packing, storage, tokens, tree_bpe, wavelet, worker

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def library(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def made_texts():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    base = [" ".join(word() for _ in range(r.randint(60, 160))) for _ in range(12)]
    shared = " ".join(word() for _ in range(70))
    out = [*base, base[0], base[1].upper(), base[2] + " " + shared, shared + " " + base[3], base[4].replace("a", "b", 2), "x " * 400, "é" * 300, shared]
    out += ["", None, " \t\n", "one two", "One  two", "İ! don't\xa0stop \n <|endoftext|> ok", "ab" * 9000, " ".join(word() for _ in range(6000))]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "n", i, 1) for i, t in enumerate(made_texts())] + [(5, made_texts()[5], "n", 0, 1), (None, made_texts()[0], None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, grp int, bucket int").repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id < 0")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def without(rows, split, join, size=50):
    """Brute force: units under windows that a smaller id has too; no id is larger than all."""
    rank = lambda i: (i is None, i or 0)
    first = {}
    window = lambda s, j: s[j : j + size] if isinstance(s, bytes) else tuple(s[j : j + size])
    for i, t in rows:
        s = split(t)
        for j in range(len(s) - size + 1):
            first[window(s, j)] = min(first.get(window(s, j), rank(i)), rank(i))
    out = []
    for i, t in rows:
        s = split(t)
        gone = [False] * len(s)
        for j in range(len(s) - size + 1):
            if first[window(s, j)] < rank(i):
                gone[j : j + size] = [True] * size
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(s), sum(gone), runs, hashlib.sha256(join(x for x, g in zip(s, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def test_word_spans(docs, rows, empty):
    got = debruijn.repeated_spans(docs).select("doc_id", "n_words", "n_removed", F.size("spans"), "kept_sha256").collect()
    want = without(rows, words, lambda x: " ".join(x).encode())
    assert sorted(map(tuple, got), key=str) == want
    assert sum(w[2] for w in want) > 200
    assert debruijn.repeated_spans(empty).count() == 0
    hot = debruijn.repeated_spans(docs, hot=1).select("doc_id", "n_words", "n_removed", F.size("spans"), "kept_sha256").collect()
    assert sorted(map(tuple, hot), key=str) == want


def test_byte_spans(docs, rows, empty):
    got = lpf.removed_spans(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == without(rows, str.encode, bytes)
    assert lpf.removed_spans(empty).count() == 0
    hot = lpf.removed_spans(docs, hot=1).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, hot), key=str) == without(rows, str.encode, bytes)


@pytest.mark.parametrize(("size", "alphabet", "documents"), [(5, 2, 4), (9, 3, 40), (20, 2, 3), (8, 1, 5)])
def test_longest_previous_factors(size, alphabet, documents):
    """Every value against all pairs of suffixes, and the decision at the full size whatever is not followed below it."""
    r = np.random.default_rng(size)
    data = r.integers(97, 97 + alphabet, 400).astype(np.uint8)
    suffix = r.permutation(400 - size)[:250]
    doc = r.integers(0, documents, 250)
    words = lpf._words(data)
    common = lambda a, b: next((i for i in range(size) if data[a + i] != data[b + i]), size)
    want = [max((common(a, b) for b, e in zip(suffix, doc, strict=True) if e < d), default=0) for a, d in zip(suffix, doc, strict=True)]
    assert lpf.longest_previous_factors(words, suffix, doc, size).tolist() == want
    assert (lpf.longest_previous_factors(words, suffix, doc, size, size) >= size).tolist() == [w >= size for w in want]
    assert len(lpf.longest_previous_factors(words, suffix[:0], doc[:0], size)) == 0


def test_texts_lose_whole_characters_only(spark):
    a = "é" * 40
    docs = spark.createDataFrame([(1, "x" + a), (2, "y" + a + "z")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in lpf.without_repeats(docs).collect()} == {1: "x" + a, 2: "yz"}


def test_spans_that_differ_from_their_source(spark):
    docs = spark.createDataFrame([(1, "a b  c d e"), (2, "b c d")], "doc_id long, text string")
    paths = spark.createDataFrame([(1, 1, 1, 2)], "src_doc long, path_pos int, piece_pos int, length int")
    spans = spark.createDataFrame([(1, 1, 0, 3, "b c d"), (1, 1, 0, 3, "b c x"), (1, 1, 1, 2, "c d")], "src_doc long, path_pos int, shift int, words int, text string")
    assert [tuple(r)[:4] for r in debruijn._differing(docs, spans, paths, 2).collect()] == [(1, 1, 0, 3)]


def test_paths_are_glued_across_buckets(spark):
    """Pieces of 3 edges that share their last edge with the next; one ends in a branch."""
    pieces = [(7, 2 * i, i > 0, i < 20, 3) for i in range(21)] + [(7, 50, False, True, 4), (7, 53, True, False, 1), (8, 5, True, False, 2)]
    paths, _ = debruijn._glued(spark.createDataFrame(pieces, "src_doc long, piece_pos int, open_left boolean, open_right boolean, length int"))
    assert {(r.src_doc, r.piece_pos): r.path_pos for r in paths.collect()} == {(7, 2 * i): 0 for i in range(21)} | {(7, 50): 50, (7, 53): 50, (8, 5): 5}


def test_a_crowded_passage(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"a{i} b{i} {passage} c{i}") for i in range(300)], "doc_id long, text string")
    got = debruijn.repeated_spans(docs).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: 60 if i else 0 for i in range(300)}


def near(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = frozenset(tuple(w[j : j + size]) for j in range(len(w) - size + 1)) or (frozenset([tuple(w)]) if w else frozenset())
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if a is not None and b is not None and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return {(i, len(sets[i]), label[i], label[i] == i) for i, _ in rows if i is not None}


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, rows, empty, size, percent):
    spec = minhash_forest.Spec(shingle=size, percent=percent)
    got = minhash_forest.near_duplicates(docs, spec).collect()
    assert {tuple(r) for r in got if r.doc_id is not None} == near(rows, size, percent)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert len(got) == len(rows)
    assert minhash_forest.near_duplicates(empty, spec).count() == 0


def test_a_group_that_hangs_on_one_text(spark):
    """Each of 2,000 copies links with the base alone: base to copy 0.886, copy to copy about 0.79."""
    r = random.Random(9)
    base = [f"w{i}" for i in range(600)]
    texts = []
    for n in range(2000):
        copy = list(base)
        for i in r.sample(range(1, 599, 3), 12):
            copy[i] = f"c{n}x{i}"
        texts.append(" ".join(copy))
    rows = [*enumerate(texts), (2000, " ".join(base)), (2001, " ".join(f"v{i}" for i in range(600)))]
    got = minhash_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), minhash_forest.Spec(shingle=3, percent=85)).collect()
    assert {r.doc_id: r.component_id for r in got} == dict.fromkeys(range(2001), 0) | {2001: 2001}


def test_pairs_in_a_crowd_below_the_threshold(spark):
    """700 documents with a common core are at 0.833 to each other, below the threshold; 40 of them have a partner at 0.856."""
    r = random.Random(12)
    core = [f"w{i}" for i in range(400)]
    own = lambda n, k: [f"o{n}x{i}" for i in range(k)]
    texts = [" ".join([*core, *own(n, 40)]) for n in range(700)]
    texts += [" ".join([*core, *own(n, 6), *own(1000 + n, 34)]) for n in range(40)]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    got = minhash_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), minhash_forest.Spec(shingle=3, percent=85)).collect()
    sets = [{tuple(w[j : j + 3]) for j in range(len(w) - 2)} for w in (t.split() for t in texts)]
    linked = [n for n in range(40) if 100 * len(sets[n] & sets[700 + n]) >= 85 * len(sets[n] | sets[700 + n])]
    other = 100 * len(sets[0] & sets[1]) >= 85 * len(sets[0] | sets[1])
    assert len(linked) == 40 and not other
    assert {r.doc_id: r.component_id for r in got} == {n: n for n in range(700)} | {700 + n: n for n in range(40)}


@pytest.mark.parametrize("block", [3, 1000])
def test_crowds_are_compared_to_the_end(spark, monkeypatch, block):
    """All members of a crowd that are not connected yet, in one block or many."""
    monkeypatch.setattr(minhash_forest, "BLOCK", block)
    r = random.Random(11)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for n in range(20):
        copy = list(base)
        for i in r.sample(range(1, 399, 3), 16):
            copy[i] = f"c{n}x{i}"
        rows += [(2 * n, " ".join(copy)), (2 * n + 1, " ".join([*copy, "more"]))]
    spec = minhash_forest.Spec(shingle=3, percent=85, trees=1)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = minhash_forest.signatures(frame, spec)
    sets = [(i, x.tobytes()) for i, t in rows for _, x, _ in minhash_forest.shingle_sets(spark.createDataFrame([(i, t.encode())], "doc_id long, text binary").toArrow().to_batches()[0], 3)]
    sets = spark.createDataFrame(sets, "doc_id long, shingles binary")
    links = lambda known: {tuple(p) for p in minhash_forest._crowd_links(nodes.selectExpr("1L AS run", "doc_id"), nodes, sets, spark.createDataFrame(known, "id long, component long"), spec).collect()}
    assert links([]) == {(2 * n + 1, 2 * n) for n in range(20)}
    assert links([(0, 0), (1, 0)]) == {(2 * n + 1, 2 * n) for n in range(1, 20)}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long"))[0].collect()}
    assert got == dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 160), 100)


def test_wavelet_matrix():
    ids = np.random.default_rng(1).integers(0, 70, 3000).astype(np.uint16)
    m = wavelet.WaveletMatrix(wavelet.build(ids))
    assert (m.ids() == ids).all()
    assert [m.access(i) for i in (0, 511, 512, 2999)] == ids[[0, 511, 512, 2999]].tolist()
    assert m.count(5) == (ids == 5).sum() and m.count(5, 1000) == (ids[:1000] == 5).sum() and m.count(60_000) == 0
    for token in (0, 5, 64, 69):
        assert [m.select(token, k) for k in range((ids == token).sum())] == np.flatnonzero(ids == token).tolist()
    for token, k in ((5, 3000), (60_000, 0)):
        with pytest.raises(IndexError):
            m.select(token, k)
    assert len(wavelet.WaveletMatrix(wavelet.build(ids[:0])).ids()) == 0


def test_wavelet_files(spark, docs, rows, empty):
    path = storage.new_path(spark, "wavelet")
    wavelet.write(docs, path, BYTE, shard_tokens=500)
    got = wavelet.read(spark, path).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want, at = set(), 0
    for (i, _), x in zip(order, library(BYTE, [t for _, t in order]), strict=True):
        x = np.array([*x, 2], "<u4")
        want.add((i, at, len(x), zlib.crc32(x)))
        at += len(x)
    assert {tuple(r) for r in got} == want and len(got) == len(rows)
    other = storage.new_path(spark, "wavelet")
    wavelet.write(empty, other, BYTE)
    assert wavelet.read(spark, other).count() == 0


def test_packing(docs, rows, empty):
    got = packing.pack(docs, WORD, length=64).collect()
    ids = collections.defaultdict(list)
    for (i, _), x in zip(rows, library(WORD, [t for _, t in rows]), strict=True):
        ids[i].append([*x, 2])
    pieces, places = collections.Counter(), collections.defaultdict(list)
    for r in got:
        x = ids[r.doc_id][0][r.start : r.start + r.length]
        assert (zlib.crc32(np.array(x, "<u4")), r.doc_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (r.ids_crc32, len(ids[r.doc_id][0]), x)
        pieces[r.doc_id] += r.length
        places[r.sequence_id].append((r.offset, r.length))
    assert pieces == {i: sum(map(len, x)) for i, x in ids.items()}
    last = max(places)
    assert set(places) == set(range(last + 1))
    for k, p in places.items():
        p.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(p, p[1:], strict=False)) and p[0][0] == 0
        assert k == last or sum(n for _, n in p) == 64
    assert packing.pack(empty, WORD).count() == 0


@pytest.mark.parametrize("leaf", [40, 100_000])
def test_tree_bpe(docs, rows, empty, leaf):
    want = sorted((str(i), x) for (i, _), x in zip(rows, library(BYTE, [t for _, t in rows]), strict=True))
    encoded = tree_bpe.encode(docs, BYTE, leaf=leaf)
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in encoded.collect()) == want
    assert sorted((str(r.doc_id), r.text) for r in tree_bpe.decode(encoded, BYTE).collect()) == sorted((str(i), t) for i, t in rows)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in tree_bpe.digests(docs, BYTE, leaf=leaf).collect())
    assert got == sorted((str(i), len(x), digest(",".join(map(str, x)).encode()), digest(t.encode())) for (i, t), x in zip(rows, library(BYTE, [t for _, t in rows]), strict=True))
    assert tree_bpe.digests(empty, BYTE).count() == 0


@pytest.mark.parametrize(("path", "leading"), [(BYTE, True), (WORD, False)])
def test_pieces_as_the_library(path, leading, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 300)
    r = random.Random(5)
    parts = [*"aB.,;!?'\n\t  é²Ⅷ3_-<|>ß中́　\xa0\x1c\r", "<|endoftext|>", "  ", "\n\n", "word", "'s", " the", "İ", "ǅ", "Σ", "aΣ", "a.\nB", "Enö,***", "ñ_", "don't,", "Ünd", "\u0149", "J\u030c", "\u030c", "E\u0301", "\u2126", "<|EndOfText|>"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(5000)]
    e = tokens.Encoder(path, leading)
    got = [np.frombuffer(x, e.dtype).tolist() for i in range(0, len(texts), 500) for x in e.encode(texts[i : i + 500])]
    assert got == library(path, texts)


def test_joins_amid_letters():
    """One word of many letters: no space to agree at."""
    encoder, sizes = tokens.encoder(BYTE, True), np.array([len(x) for x in tokens.byte_tokens(BYTE)])
    one = lambda t: np.frombuffer(encoder.encode([t])[0], encoder.dtype)
    r = random.Random(7)
    for alphabet in ("abcdefgh", "abé", "ab1!"):
        text = "".join(r.choice(alphabet) for _ in range(700))
        sides = [tree_bpe.Side(p, one(p), sizes) for p in tree_bpe.leaves(text, 60)]
        assert tree_bpe.joined(sides, one, sizes).ids.tolist() == library(BYTE, [text])[0]


def test_language(spark):
    r = random.Random(1)
    say = {"aa": "abab bcda kral mono tel".split(), "bb": "zuxu wyvo qest jip tel".split()}
    rows = [(i, " ".join(r.choice(say[x]) for _ in range(9)), x) for i, x in enumerate(["aa", "bb"] * 30)]
    docs = spark.createDataFrame([*rows, (90, None, "aa"), (91, "12 - 3", None), (92, "", "bb"), (94, "½ ² Ⅷ", None), (93, "monoabab", None)], "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    model = langid.fit(docs)
    got = {x.doc_id: (x.lang_pred, x.score) for x in langid.predict(docs, model).collect()}
    assert all(got[i][0] == x for i, _, x in rows) and all(0 <= s <= 1 for _, s in got.values())
    assert [got[i] for i in (90, 91, 92, 94)] == [("und", 0.0)] * 4 and got[93][0] == "aa"
    assert langid.predict(docs, langid.fit(docs.where("doc_id < 0"))).where("lang_pred != 'und'").count() == 0
    assert [x.h for x in docs.select(langid.held_out(F.col("doc_id")).alias("h")).limit(20).collect()] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(20)]


def plain_scores(learned, texts):
    """Best language and its share for each text, by counting words and n-grams plainly."""
    words_of = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    pieces = lambda w, n: [f"<{w}>"[i : i + n] for i in range(len(w) + 3 - n)]
    languages, counts = sorted({x for _, x in learned}), ({}, {})
    for text, language in learned:
        for w in words_of(text):
            for kind, keys in enumerate(([w], [g for n in range(1, 5) for g in pieces(w, n)])):
                for k in keys:
                    counts[kind].setdefault(k, collections.Counter())[language] += 1
    logs = []
    for known in counts:
        known = {k: c for k, c in known.items() if c.total() > 1}
        all_ = {x: sum(0.1 + c[x] for c in known.values()) for x in languages}
        of = {k: [math.log((0.1 + c[x]) / all_[x]) for x in languages] for k, c in known.items()}
        logs.append({k: [v - sum(x) / len(x) for v in x] for k, x in of.items()})

    def score(word):
        if word in logs[0]:
            return logs[0][word]
        for n in (4, 3, 2, 1):
            found = [logs[1][g] for g in pieces(word, n) if g in logs[1]]
            if found:
                return [sum(x) / len(found) for x in zip(*found)]
        return [0.0] * len(languages)

    for text in texts:
        found = words_of(text)
        total = [sum(x) for x in zip(*map(score, found))]
        yield languages[total.index(max(total))], 1 / sum(math.exp((x - max(total)) / math.sqrt(len(found))) for x in total)


def test_language_scores(spark):
    r = random.Random(8)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(1, 6)))
    stock = {"aa": "abcde", "bb": "cdefg", "cc": "abgéß"}
    stock = {x: [word(letters) for _ in range(40)] for x, letters in stock.items()}
    learned = [(" ".join(r.choices(stock[x], k=12)), x) for x in stock for _ in range(20)]
    texts = [" ".join(r.choices(stock[r.choice("abc") * 2], k=3) + [word("abcdefgéßxyz") for _ in range(r.randint(1, 9))]) for _ in range(120)] + ["QQQQ 7 Éa_b", "zzz"]
    docs = spark.createDataFrame([(i, *x) for i, x in enumerate(learned)], "doc_id long, text string, lang string")
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.lang_pred, x.score) for x in langid.predict(asked, langid.fit(docs)).collect()}
    for i, (language, share) in enumerate(plain_scores(learned, texts)):
        assert got[i][0] == language and got[i][1] == pytest.approx(share, abs=1e-4), texts[i]


@pytest.mark.parametrize("doc_id", [None, 7])
def test_language_sample_of_equal_ids(spark, doc_id):
    name = lambda i: chr(97 + i // 26) + chr(97 + i % 26)
    docs = spark.createDataFrame([(doc_id, f"{name(i)} {name(i)}", "aa") for i in range(400)], "doc_id long, text string, lang string")
    assert 15 < len(langid.fit(docs, rows=40).words) < 80


def test_a_worker_keeps_one_state():
    made = []
    make = lambda x: lambda: made.append(x) or [x]
    assert [worker.kept(k, make(k))[0] for k in "aabba"] == list("aabba") and made == list("aba")
    worker.forget()
    assert worker.kept("a", make("a")) == ["a"] and made == list("abaa")
    worker.forget()


def test_chat_round_trip(spark):
    texts = ["plain", r"\### Assistant: </turn> ok", "</turn>\n### user: x", "#h <l \\b \\", "", None, "a: b\n" * 3, "é" * 5, "</turn", "##"]
    rows = [(c, t, role, x, 9) for c in range(2) for t, x in enumerate(texts) for role in ["user", "assistant"][c : c + 1]] + [(2, 0, "odd: role\n###", "x", 9), (2, 0, "odd: role\n###", "x", 9), (None, None, None, None, 9)]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int"))
    assert formatted.where("NOT round_trip").count() == 0 and formatted.count() == 4
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    plain = [t or "" for t in texts]
    for c, role in enumerate(["user", "assistant"]):
        assert (got[c].n_turns, got[c].turns_sha256) == (10, hashlib.sha256("".join(f"{role}\n{t}\n" for t in plain).encode()).hexdigest())
    assert (got[1].loss_chars, got[1].loss_sha256) == (len("".join(plain)), hashlib.sha256("".join(plain).encode()).hexdigest())
    assert (got[0].loss_chars, got[2].n_turns) == (0, 2)
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.fixture(scope="module")
def embeddings(spark):
    r = np.random.default_rng(2)
    centres = r.standard_normal((40, 16))
    x = centres[r.integers(0, 40, 600)] + 0.25 * r.standard_normal((600, 16))
    x[100:140] = x[100]
    x[200] = 3 * x[201]
    rows = [(int(i), [float(v) for v in y], 1, 2) for i, y in enumerate(x)]
    rows += [(600, None, 1, 2), (601, [0.0] * 16, 1, 2), (602, [float("nan")] * 16, 1, 2), (603, [None] * 16, 1, 2), (604, [1.0], 1, 2), (None, rows[100][1], 1, 2), (650, [float("inf")] * 16, 1, 2)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell int, n int"), x


def test_links(embeddings):
    rows, x = embeddings
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    m = u @ u.T >= 0.9
    np.fill_diagonal(m, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.minimum(label, np.where(m, label[None, :], len(x)).min(axis=1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multi_index.links(rows, members_per_cell=40).collect()}
    assert sum(got[i] == (int(k), int(c), i == c) for i, (k, c) in enumerate(zip(m.sum(axis=1), label, strict=True))) == 600
    assert all(got[i] == (0, i, True) for i in (600, 601, 602, 603, 604, 650)) and got[None] == (0, None, True)
    assert multi_index.links(rows.where("vec_id < 0")).count() == 0


def test_repeated_vectors(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in multi_index.links(rows).collect()) == [(1, 0, 1), (1, 0, 1), (2, 1, 2), (3, 1, 2)]
    assert sorted((r.rank, r.vec_id) for r in kmeans_tree.search(rows, rows.where("vec_id = 2")).collect()) == [(1, 3), (2, 1)]


def test_ids_with_several_vectors(spark):
    one = spark.createDataFrame([(5, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [0.0, 1.0]), (8, [0.0, 1.0]), (9, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in multi_index.links(one).collect())
    assert got == [(5, 1, 5, True), (7, 2, 5, False), (7, 2, 5, False), (8, 1, 5, False), (9, 0, 9, True)]


def test_ids_whose_classes_have_one_least_id(spark):
    """Both classes of id 7 have it as their least id; the links of each count once."""
    rows = spark.createDataFrame([(7, [1.0, 0.0]), (7, [0.0, 1.0]), (9, [1.0, 0.1]), (10, [1.0, 0.2])], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in multi_index.links(rows).collect())
    assert got == [(7, 2, 7), (7, 2, 7), (9, 2, 7), (10, 2, 7)]


def test_vectors_are_not_copied_for_each_visit(spark, monkeypatch):
    """Most cells are visited; what is shuffled stays a few times the vectors, and links are those of all pairs."""
    x = np.random.default_rng(4).standard_normal((4000, 8)).astype(np.float32)
    rows = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
    sent = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()
    before = sent()
    monkeypatch.setattr(multi_index, "LEAST", 300, raising=False)
    got = {r.vec_id: r.n_links for r in multi_index.links(rows, members_per_cell=20).collect()}
    time.sleep(1)  # figures of the last stage
    assert sent() - before < 20 * x.nbytes
    u = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    assert [got[i] for i in range(len(x))] == ((u @ u.T >= 0.9).sum(axis=1) - 1).tolist()


@pytest.mark.parametrize("most", [1, 3, 17, 35, 99])
def test_reach_is_the_last_cell_of_the_order(most):
    r = np.random.default_rng(9)
    a, b = r.random((40, 7)), r.random((40, 5))
    want = [[p[c // 5] + q[c % 5] for c in multi_index.multi_sequence(p, q, most)][-1] for p, q in zip(a, b, strict=True)]
    assert multi_index.reach(a, b, most).tolist() == want


def test_cells_in_order_of_distance():
    r = np.random.default_rng(8)
    a, b = r.random(7), r.random(5)
    grid = (a[:, None] + b).ravel()
    assert multi_index.multi_sequence(a, b, 35) == grid.argsort().tolist() and multi_index.multi_sequence(a, b, 3) == grid.argsort()[:3].tolist()


def test_tree_search(embeddings):
    rows, x = embeddings
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = collections.defaultdict(list)
    for r in sorted(kmeans_tree.search(rows, rows.where("vec_id % 50 = 0"), leaf_rows=16, block_rows=20).collect(), key=lambda r: r["rank"]):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 600, 50))
    hits = 0
    for q, found in got.items():
        score = u @ u[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(600), -score.round(12)))[:5]
        hits += len({i for i, _ in found} & set(best.tolist()))
        assert len(found) == 5 and all(abs(score[i] - s) < 1e-12 for i, s in found) and [-s for _, s in found] == sorted(-s for _, s in found)
    assert hits >= 0.9 * 60
    assert [r.vec_id for r in kmeans_tree.search(rows, rows.where("vec_id = 139")).orderBy("rank").collect()] == [100, 101, 102, 103, 104]
    assert kmeans_tree.search(rows.where("vec_id < 3"), rows.where("vec_id = 0")).count() == 2
    assert kmeans_tree.search(rows.where("vec_id < 0"), rows).count() == 0

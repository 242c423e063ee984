"""The stages of the corpus pipeline on a small table, each against what it should decide."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


def test_stages(spark, tmp_path):
    say = {"aa": "abab bcda kral mono tel naro", "bb": "zuxu wyvo qest jip tel yuzo"}
    r = np.random.default_rng(4)
    text = lambda lang, n: " ".join(r.choice(say[lang].split()) + str(r.integers(0, 9)) * 0 + "".join(r.choice(list("abc"), 3)) for _ in range(n))
    rows = [(i, text(x, 80), x, "s", 0) for i, x in enumerate(["aa", "bb"] * 8)]
    passage = rows[3][1][:120]
    rows += [(20, None, "aa", "s", 0), (21, "12 34", "bb", "s", 0), (22, rows[0][1], "aa", "s", 0), (23, rows[1][1] + " extra", "bb", "s", 0), (24, text("bb", 60) + " | " + passage + " | " + text("bb", 60), "bb", None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs, ids = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        ids[name] = sorted(r.doc_id for r in docs.select("doc_id").distinct().collect())
        assert docs.columns == names or name == "packing"
        if name == "suffix_dedup":
            kept = {r.doc_id: r for r in docs.collect()}
    clean = [*range(16), 24]
    assert ids["language_id"] == sorted([*clean, 22, 23])
    assert ids["near_dedup"] == ids["suffix_dedup"] == ids["packing"] == clean
    assert kept[24].text == rows[-1][1].replace(passage, "") or len(kept[24].text) <= len(rows[-1][1]) - 118
    assert all(kept[i].text == rows[i][1] and kept[i].n_chars == len(rows[i][1]) for i in range(16))
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, {})[r.start] = np.frombuffer(r.ids, "<u4").tolist()
    whole = {i: sum((x[k] for k in sorted(x)), []) for i, x in got.items()}
    assert whole == {i: [*t.encode(k.text, add_special_tokens=False).ids, 2] for i, k in kept.items()}


def test_rows_that_repeat_an_id(spark):
    """Each distinct text of an id stays one row beside its own columns; of equal texts the least row stays."""
    a, b = ("".join(chr(97 + (i * k) % 26) for i in range(200)) for k in (3, 7))
    rows = [(1, a, "x", "s1", 0), (1, b, "y", "s2", 0), (1, b, "y", "s0", 0), (2, None, "x", "s", 0), (None, a, "z", "s", 0), (3, a[:60] + "!", "x", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("source != 's2'").collect()))
    cut = {(r.doc_id, r.source): (r.text, r.n_chars) for r in corpus_pipeline.remove_repeats(spark, docs, "").collect()}
    assert cut == {(1, "s1"): (a, 200), (1, "s2"): (b, 200), (1, "s0"): (b, 200), (2, "s"): ("", 0), (None, "s"): (a, 0), (3, "s"): ("!", 1)}

"""Language identification by words first, then by shorter and shorter character n-grams.

A word that the model knows scores its log frequency in each language. For another word the longest n-grams are asked
first; if the model knows none of that length, the next shorter ones are, down to single letters. A document's score
for a language is the sum over its words.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import storage, worker

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def _words(text: str) -> list[str]:
    """Runs of letters, in lower case. The pattern also takes numbers that are no digits, such as fractions; they go."""
    words = _WORD.findall(text.lower())
    return words if all(map(str.isalpha, words)) else "".join([c if c.isalpha() else " " for c in text.lower()]).split()


#: Words remembered by a worker beside the model's own.
REMEMBERED = 300_000


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    words: dict[str, int]
    grams: dict[str, int]
    word_scores: np.ndarray  # a row for each word: log frequency by language
    gram_scores: np.ndarray
    longest: int
    key: str  # tells one fitted model from another


def _grams(word: str, n: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def fit(labelled: DataFrame, *, rows: int = 20_000, max_words: int = 60_000, max_grams: int = 60_000, longest: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from about ``rows`` labelled rows, chosen by a hash of
    their ids and texts, so that rows without an id, or of one id, are not taken or left together. The model holds at most ``max_words``
    words and ``max_grams`` n-grams, the most frequent; only these reach the driver. Rows without text or language
    teach nothing; without any, every prediction is ``und``."""
    usable = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    total = usable.select(id_col).count()
    share = min(1.0, rows / max(1, total))
    if share < 1:
        usable = usable.where(F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 53)) < int(share * (1 << 53)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: Counter[tuple[str, str]] = Counter()
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words.update((lang, w) for w in _words(text))
            grams: Counter[tuple[str, str]] = Counter()
            for (lang, word), n in words.items():
                for size in range(1, longest + 1):
                    for g in _grams(word, size):
                        grams[lang, g] += n
            both = [(0, *k, n) for k, n in words.items()] + [(1, *k, n) for k, n in grams.items()]
            yield pa.RecordBatch.from_pydict(dict(zip(("kind", "lang", "key", "n"), map(list, zip(*both, strict=True)), strict=True)) if both else {"kind": [], "lang": [], "key": [], "n": []}, schema=pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("key", pa.string()), ("n", pa.int64())]))

    counts = usable.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(count, "kind int, lang string, key string, n long")
    table, path = storage.written(counts.groupBy("kind", "key", "lang").agg(F.sum("n").alias("n")).groupBy("kind", "key").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by")).where("total > 1"), "ngrams")
    sizes = table.groupBy("kind", "total").count().toArrow().to_pylist()  # a row for each number of occurrences
    keys, scores, found, languages = {}, {}, {}, set()
    for kind, most in ((0, max_words), (1, max_grams)):
        # the least number of occurrences that no more than ``most`` keys reach
        least, held = 2, 0
        for row in sorted((r for r in sizes if r["kind"] == kind), key=lambda r: -r["total"]):
            held += row["count"]
            if held > most:
                least = row["total"] + 1
                break
        found[kind] = table.where((F.col("kind") == kind) & (F.col("total") >= least)).select("key", F.explode("by").alias("b")).select("key", "b.*").toArrow()
        languages |= set(found[kind]["lang"].unique().to_pylist())
    storage.remove(labelled.sparkSession, path)
    languages = tuple(sorted(languages))
    place = {x: i for i, x in enumerate(languages)}
    for kind, rows_ in found.items():
        coded = rows_["key"].combine_chunks().dictionary_encode() if len(rows_) else None
        keys[kind] = {x: i for i, x in enumerate(coded.dictionary.to_pylist())} if coded is not None else {}
        n = np.full((len(keys[kind]), len(languages)), 0.1)
        if coded is not None:
            np.add.at(n, (coded.indices.to_numpy(), np.array([place[x] for x in rows_["lang"].to_pylist()])), rows_["n"].to_numpy())
        scores[kind] = np.log(n / n.sum(axis=0, keepdims=True)) if len(n) else n
    return Model(languages, keys[0], keys[1], scores[0], scores[1], longest, uuid.uuid4().hex)


class Scorer:
    """Scores words, and remembers those it has met. Scores are set off against their mean over the languages."""

    def __init__(self, model: Model):
        self.model = model
        self.index = dict(model.words)
        self.rows = np.zeros((len(self.index) + REMEMBERED, len(model.languages)), np.float32)
        if len(model.words):
            self.rows[: len(self.index)] = model.word_scores - model.word_scores.mean(axis=1, keepdims=True)
        centred = model.gram_scores - model.gram_scores.mean(axis=1, keepdims=True) if len(model.grams) else model.gram_scores
        self.grams = {g: tuple(x) for g, x in zip(model.grams, centred.tolist(), strict=True)}
        self.nothing = [0.0] * len(model.languages)

    def back_off(self, word: str) -> list[float]:
        """Mean score of the word's n-grams of the greatest length of which any is known."""
        find, padded = self.grams.get, f"<{word}>"
        for n in range(min(self.model.longest, len(padded)), 0, -1):
            known = [x for i in range(len(padded) - n + 1) if (x := find(padded[i : i + n]))]
            if known:
                return [sum(column) / len(known) for column in zip(*known, strict=True)]
        return self.nothing

    def document(self, text: str) -> tuple[str, float]:
        words = _words(text)
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        places = list(map(self.index.get, words))
        extra = np.zeros(len(self.model.languages))
        if None in places:
            for w in {w for w, p in zip(words, places, strict=True) if p is None}:
                if len(self.index) < len(self.rows):
                    self.rows[len(self.index)] = self.back_off(w)
                    self.index[w] = len(self.index)
            again = list(map(self.index.get, words))
            for w, p in zip(words, again, strict=True):
                if p is None:
                    extra += self.back_off(w)
            places = [p for p in again if p is not None]
        total = (self.rows[places].sum(axis=0, dtype=np.float64) if places else 0) + extra
        best = int(np.argmax(total))
        share = np.exp(np.clip((total - total[best]) / math.sqrt(len(words)), -700, 0))
        return self.model.languages[best], float(1 / share.sum())


def predict(docs: DataFrame, model: Model, *, text_col: str = "text", lang_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """All columns of the rows and two more (in place of columns of their names): the predicted language and its score
    (0 to 1); ``und`` with score 0 where text is null or has no letter. Only the text is looked at, all of it however long;
    each row is judged by itself, so repeated rows get the same answer, and an empty table an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most max_words + max_grams rows
    rows, key = docs.drop(lang_as, score_as), model.key
    names = [*rows.columns, lang_as, score_as]
    schema = T.StructType([*rows.schema.fields, T.StructField(lang_as, T.StringType()), T.StructField(score_as, T.DoubleType())])

    def batches_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker.kept(key, lambda: Scorer(sent.value))
        for batch in batches:
            out = [scorer.document(t) if t else (UNKNOWN, 0.0) for t in batch[text_col].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], names=names)

    return rows.mapInArrow(batches_, schema)


def held_out(doc_id) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 modulo 4 (null: not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op6_word_first_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

"""
Language by words first, with backoff to shorter and shorter character n-grams.

A known word scores each language by the log of its frequency there. An unknown word is scored
by its 4-character n-grams, an unknown one of these by the 3-character n-grams in it, and so on
down to single characters; a word's boundaries count as characters. What is unknown to the end
says nothing.

A word is a run of letters and the marks that go with them, such as vowel signs, in learning and
prediction alike. Learned from about ``SAMPLE`` rows of each language at most, chosen by a hash of
the row, so a rare language is learned as well and a text that many rows have counts as they do;
words that the sample of a language has only once are left to their n-grams, and the ``KNOWN`` most frequent
words and n-grams of each language are kept, ties by themselves. Texts that are null or hold no
letter are ``und`` with score 0, as is everything if nothing was learned; of languages that score the same
the first by name is given. Whole texts count, of any length. Every row gives one row; null ids are
neither learned from nor held out. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.base import ship_package, stored

SAMPLE, KNOWN, LONGEST = 2_500, 20_000, 4
REMEMBERED = 200_000
UNKNOWN = "und"
MARKS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c).startswith("M"))
LETTERS = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=1000)
def _with_marks(marks: frozenset[str]) -> re.Pattern:
    return re.compile(f"(?:[^\\W\\d_]|[{''.join(sorted(marks))}])+")


def words_of(text: str) -> list[str]:
    """Its words in lower case; the pattern names the marks that the text has, as one that names all is slow."""
    text = text.lower()
    marks = frozenset() if text.isascii() else MARKS.intersection(text)
    return (_with_marks(marks) if marks else LETTERS).findall(text)


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    """Log frequencies per language: of words, and of n-grams by themselves."""

    languages: list[str]
    words: dict[str, np.ndarray]
    grams: dict[str, np.ndarray]
    memory: dict[str, int] = field(default_factory=dict)
    rows: list[np.ndarray] = field(default_factory=list)

    def _backoff(self, piece: str) -> tuple[np.ndarray, int]:
        """The sum of scores of a piece and how many n-grams gave it."""
        if (found := self.grams.get(piece)) is not None:
            return found, 1
        total, count = np.zeros(len(self.languages)), 0
        if len(piece) > 1:
            for k in (0, 1):
                part, n = self._backoff(piece[k:k + len(piece) - 1])
                total, count = total + part, count + n
        return total, count

    def word(self, word: str) -> np.ndarray:
        if (found := self.words.get(word)) is not None:
            return found
        bound = f" {word} "
        total, count = np.zeros(len(self.languages)), 0
        for k in range(max(1, len(bound) - LONGEST + 1)):
            part, n = self._backoff(bound[k:k + LONGEST])
            total, count = total + part, count + n
        return total / max(1, count)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        total = np.zeros(len(self.languages))
        counts = Counter(words_of(text))
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
            self.rows.clear()
        at = []
        for word in counts:
            if (row := self.memory.get(word)) is None:
                row = self.memory[word] = len(self.rows)
                self.rows.append(self.word(word))
            at.append(row)
        if at:
            total = np.array(list(counts.values()), float) @ np.array([self.rows[k] for k in at])
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def _frequent(counts: DataFrame, column: str) -> list:
    """The KNOWN most frequent of each language."""
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col(column))
    return counts.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= KNOWN).select(
        "lang", F.col(column).alias("key"), "n").toArrow().to_pylist()


def _logs(rows: list, languages: list[str]) -> dict[str, np.ndarray]:
    """Log frequencies with one added to each count."""
    place = {lang: k for k, lang in enumerate(languages)}
    counts: dict[str, np.ndarray] = {}
    for row in rows:
        counts.setdefault(row["key"], np.zeros(len(languages)))[place[row["lang"]]] = row["n"]
    totals = sum(counts.values(), np.zeros(len(languages))) + len(counts)
    return {key: np.log((held + 1) / totals) for key, held in counts.items()}


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each language, counted by batch."""
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            counts.update((lang, word) for word in words_of(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])


def sampled(texts: DataFrame) -> DataFrame:
    """About ``SAMPLE`` rows of each language at most, of rows ``lang, text``."""
    # A row per language.
    counts = texts.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("rows"))
    drawn = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.col("rows")) < SAMPLE
    return texts.join(F.broadcast(counts), F.col("lang") == F.col("of")).filter(drawn).select("lang", "text")


def learn(docs: DataFrame) -> Model:
    """From ``docs(text, lang)``; rows without either are not used."""
    ship_package(docs.sparkSession)
    texts = docs.filter("text is not null and lang is not null").select("lang", "text")
    words = stored(sampled(texts).mapInArrow(_words, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")), "words")
    pieces = F.expr(f"""
        flatten(transform(sequence(1, {LONGEST}), s -> transform(
            sequence(1, greatest(1, char_length(bound) - s + 1)), i -> substring(bound, i, s))))""")
    grams = words.select("lang", "n", F.concat(F.lit(" "), "word", F.lit(" ")).alias("bound")).select(
        "lang", "n", F.explode(pieces).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    words_kept, grams_kept = _frequent(words.filter("n > 1"), "word"), _frequent(grams, "gram")
    languages = sorted({r["lang"] for r in grams_kept})
    return Model(languages, _logs(words_kept, languages), _logs(grams_kept, languages))


def identified(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns of every row with ``lang_pred`` and ``score``."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.words, model.grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*held.value)
        for batch in batches:
            said = [own.predict(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array([s[0] for s in said], pa.string()),
                 pa.array([s[1] for s in said], pa.float64())], [*keep, "lang_pred", "score"])

    given = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return docs.select(*keep, "text").mapInArrow(run, f"{given}, lang_pred string, score double")


def report(docs: DataFrame) -> DataFrame:
    model = learn(docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    return identified(docs.select("doc_id", "text"), model, "doc_id").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

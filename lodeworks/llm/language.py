"""Language identification by words first, then by ever shorter character n-grams.

A word that the model knows counts with its log frequency in each language. An unknown word counts with the mean of its
longest known character n-grams: if none of its 5-grams is known, its 4-grams are tried, and so on down to letters.
A text's language is the one with the largest mean over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import unused

#: Documents of each language that the model is fitted on, chosen by a hash of the text; all of them if there are fewer.
FIT_DOCS = 5_000
#: Words, and n-grams of each length, kept for each language: the most frequent. The others are unseen words, for which
#: the method backs off. So a language adds at most 30,000 entries to the model, and there may be any number of them.
TOP = 5_000
LONGEST = 5
#: Log10 frequency of what a language does not have.
ABSENT = -7.0
#: Words that a worker remembers, and entries that they have together.
REMEMBERED = 200_000
ENTRIES = 4_000_000

LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    """Lower-case runs of letters; none if no character is a letter."""
    found = LETTERS.findall(text.lower()) if text else []
    return found if any(w.isalpha() or any(map(str.isalpha, w)) for w in found) else []


@dataclass
class Model:
    """Log10 frequencies above ABSENT, kept only where a language has a feature.

    ``rows`` finds a feature by its kind (length, or 0 for words) and text; row i has the languages ``langs[index[j]]``
    and values ``above[j]`` for j from ``start[i]`` to ``start[i + 1]``.
    """

    langs: list[str]
    rows: list[dict[str, int]]
    start: np.ndarray
    index: np.ndarray
    above: np.ndarray

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.start[i], self.start[i + 1]
        return self.index[a:b], self.above[a:b]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            counts.update((lang, w) for w in letter_words(text))
        yield pd.DataFrame([(lang, w, n) for (lang, w), n in counts.items()], columns=["lang", "word", "n"])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", learn: Column | None = None, fit_docs: int = FIT_DOCS) -> Model:
    """Fits on at most about ``fit_docs`` documents of each language (exactly all, where there are no more).

    Rows with a null text or language, or for which ``learn`` is not true, are left out; of equal texts of a language one
    counts. Every language with a learnable row is learned. An empty table gives a model without languages. The driver
    gets a row for each language, and the kept features only: six times TOP for each language at most.
    """
    known = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"), (F.lit(True) if learn is None else learn).alias("learn"))
    known = known.where("learn and text is not null and lang is not null").drop("learn")
    spark = docs.sparkSession
    counts = [(r["lang"], r["n"]) for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()]
    if not counts:
        return Model([], [{} for _ in range(LONGEST + 1)], np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32))
    rate = spark.createDataFrame([(x, min(1.0, fit_docs / n)) for x, n in counts], "lang string, rate double")
    chance = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.join(F.broadcast(rate), "lang").where(chance < F.col("rate")).select("lang", "text").distinct()  # a row per language
    words = sample.mapInPandas(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("word") + 2)),
            lambda k: F.transform(F.sequence(F.lit(1), F.length("word") + 3 - k), lambda i: F.struct(k.alias("kind"), F.substring(padded, i, k).alias("gram"))),
        )
    )
    pieces = words.select("lang", "n", F.explode(grams).alias("g")).groupBy("lang", "g.kind", "g.gram").agg(F.sum("n").alias("n"))
    features = words.select("lang", F.lit(0).alias("kind"), F.col("word").alias("gram"), "n").unionByName(pieces.select("lang", "kind", "gram", "n"))
    group = Window.partitionBy("lang", "kind")
    ranked = features.withColumn("total", F.sum("n").over(group)).withColumn("place", F.row_number().over(group.orderBy(F.desc("n"), "gram")))
    best = ranked.where(F.col("place") <= TOP).select("lang", "kind", "gram", F.log10(F.col("n") / F.col("total")).alias("log"))
    found = best.toPandas().sort_values(["kind", "gram", "lang"])
    langs = sorted(x for x, _ in counts)
    rows: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    start: list[int] = []
    for i, (kind, gram) in enumerate(zip(found["kind"], found["gram"], strict=True)):
        if gram not in rows[kind]:
            rows[kind][gram] = len(start)
            start.append(i)
    index = np.searchsorted(langs, found["lang"].to_numpy(dtype=object)).astype(np.int32)
    above = (np.maximum(found["log"].to_numpy(), ABSENT) - ABSENT).astype(np.float32)
    return Model(langs, rows, np.array([*start, len(found)], dtype=np.int64), index, above)


def word_row(model: Model, word: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the languages that a word tells for, and what it adds to each above ABSENT; a language may come twice."""
    row = model.rows[0].get(word)
    if row is not None:
        return model.row(row)
    padded = f" {word} "
    for k in range(min(LONGEST, len(padded)), 0, -1):
        chars = padded if k > 1 else word  # a blank alone says nothing
        known = [r for i in range(len(chars) - k + 1) if (r := model.rows[k].get(chars[i : i + k])) is not None]
        if known:
            parts = [model.row(r) for r in known]
            return np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts]) / np.float32(len(known))
    return model.index[:0], model.above[:0]


def word_scores(model: Model, word: str) -> np.ndarray:
    """Scores of one word in all languages."""
    index, above = word_row(model, word)
    return np.bincount(index, weights=above, minlength=len(model.langs)) + ABSENT


class Scorer:
    """Scores texts, remembering the words' entries; the memory is emptied when it is full."""

    def __init__(self, model: Model):
        self.model = model
        self.index, self.above = np.empty(ENTRIES, np.int32), np.empty(ENTRIES, np.float32)
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.start, self.used = np.zeros(REMEMBERED + 1, np.int64), 0

    def place(self, word: str) -> int:
        """The word's number in the memory, if there is room."""
        index, above = word_row(self.model, word)
        at, end = len(self.at), self.used + len(index)
        if at >= REMEMBERED or end > len(self.index):
            return -1
        self.index[self.used : end], self.above[self.used : end] = index, above
        self.start[at + 1] = self.used = end
        self.at[word] = at
        return at

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = letter_words(text) if self.model.langs else []
        if not words:
            return "und", 0.0
        counts = Counter(words)
        sums = np.zeros(len(self.model.langs))
        names, numbers = list(counts), np.fromiter(counts.values(), dtype=np.float64)
        begin = 0
        while begin < len(names):
            at, places = self.at, []
            for w in names[begin:]:
                place = at[w] if w in at else self.place(w)
                if place < 0:
                    break
                places.append(place)
            if places:
                rows = np.array(places)
                first, size = self.start[rows], self.start[rows + 1] - self.start[rows]
                of = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
                weights = self.above[of] * np.repeat(numbers[begin : begin + len(places)], size)
                sums += np.bincount(self.index[of], weights=weights, minlength=len(sums))
            elif not self.at:  # a single word with more entries than the memory holds
                index, above = word_row(self.model, names[begin])
                sums += np.bincount(index, weights=above * numbers[begin], minlength=len(sums))
                places = [0]
            begin += len(places)
            if begin < len(names):
                self.forget()
        mean = sums / len(words)
        odds = 10.0 ** (mean - mean.max())
        best = int(mean.argmax())
        return self.model.langs[best], float(odds[best] / odds.sum())


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1); other names where they clash.

    ``und`` with score 0 if the text is null, empty or without a letter, or if the model has no language. Ties go to
    the language that comes first by name. Only the text is sent to Python; texts are read whole, one at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # six times TOP entries for each language at most

    @F.pandas_udf("lang_pred string, score double")
    def identified(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = Scorer(shared.value)
        for batch in texts:
            yield pd.DataFrame([score(t) for t in batch], columns=["lang_pred", "score"])

    found, pred, score = unused(docs.columns, "found", "lang_pred", "score")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.withColumn(found, identified(F.col(f"`{text}`"))).select(*columns, F.col(found)["lang_pred"].alias(pred), F.col(found)["score"].alias(score))

"""Quality rules: counts of a text's faults, and the log-likelihood ratio of its n-grams between two corpora.

The ratio compares two multinomials over hashed n-grams (words and word pairs): one counted over a trusted target, one
over the whole raw corpus. A document's ratio is divided by its number of n-grams, so length does not decide, and every
document is held against the same threshold, which is taken from the trusted documents' own ratios: these shrink as
n-grams share cells. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let, unused, words_of, written

#: Hashed n-grams fall into so many cells; the model is that many numbers, however large the corpora are.
CELLS = 1 << 14
#: Added to every cell's count in both corpora.
SMOOTHING = 1.0
#: The threshold lies below this quantile of the trusted documents' ratios, by MARGIN of its distance from their median.
QUANTILE = 0.02
MARGIN = 0.5

SYMBOLS = r"[#*$%&|<>]"
#: The bits of a window's place, which an array's length never exceeds.
PLACE = (1 << 31) - 1


def cells_of(words: Column, cells: int = CELLS) -> Column:
    """Cells of all words and of all pairs of neighbouring words, which index ``words``: give a column or bind it by ``let``."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(cells)).cast("int"))
    last = F.size(words) - 1
    pair = lambda i: F.pmod(F.xxhash64(F.get(words, i), F.get(words, i + 1)), F.lit(cells)).cast("int")
    pairs = F.when(last > 0, F.transform(F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))), pair))
    return F.concat(one, F.coalesce(pairs, F.array().cast("array<int>")))


def ratios(docs: DataFrame, trusted: Column, text: str = "text", cells: int = CELLS, smoothing: float = SMOOTHING) -> list[float]:
    """Log ratio of every cell, target against raw, from all n-grams of all rows of ``docs``.

    ``trusted`` marks the rows of the target (null: not). Counts are combined per task; the driver gets one pair of
    numbers for each of ``cells`` cells. Without any trusted n-gram every ratio is 0: nothing is rejected.
    """
    flags = F.lit(True).alias("raw"), F.coalesce(trusted, F.lit(False)).alias("target")
    return _fitted(docs.select(*flags, _text_cells(text, cells)), cells, smoothing)


def ratios_between(target: DataFrame, raw: DataFrame, text: str = "text", cells: int = CELLS, smoothing: float = SMOOTHING) -> list[float]:
    """As ``ratios``, the rows of ``target`` against those of ``raw``."""
    part = lambda df, is_raw: df.select(F.lit(is_raw).alias("raw"), F.lit(not is_raw).alias("target"), _text_cells(text, cells))
    return _fitted(part(raw, True).unionAll(part(target, False)), cells, smoothing)


def _text_cells(text: str, cells: int) -> Column:
    """The cells of a text, made before they are exploded: lambdas keep what they are part of out of generated code."""
    return let(words_of(F.col(f"`{text}`")), lambda w: cells_of(w, cells)).alias("cells")


def _fitted(split: DataFrame, cells: int, smoothing: float) -> list[float]:
    # of a plain explode Spark infers a filter on the array, below the join: the cells would be made twice
    grams = split.select("raw", "target", F.explode_outer("cells").alias("cell")).where("cell is not null")
    counted = written(grams.groupBy("cell").agg(F.count_if("raw").alias("raw"), F.count_if("target").alias("target")), "cells")
    raw_all = counted.agg(F.sum("raw")).scalar()
    target_all = counted.agg(F.sum("target")).scalar()
    p_target = (F.col("target") + smoothing) / (target_all + smoothing * cells)
    p_raw = (F.col("raw") + smoothing) / (raw_all + smoothing * cells)
    found = counted.select("cell", F.when(target_all > 0, F.log(p_target / p_raw)).otherwise(F.lit(0.0)).alias("ratio")).collect()
    known = {r["cell"]: r["ratio"] for r in found}
    return [known.get(c, 0.0) for c in range(cells)]


def mean_ratio(words: Column, model: list[float]) -> Column:
    """Mean log ratio of a text's n-grams; null without words."""
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")  # folded to one constant
    total = F.aggregate(cells_of(words, len(model)), F.lit(0.0), lambda acc, c: acc + F.get(table, c))
    return F.when(F.size(words) > 0, total / (2 * F.size(words) - 1))


def least_ratio(target: DataFrame, model: list[float], quantile: float = QUANTILE, margin: float = MARGIN, text: str = "text") -> float:
    """Threshold from the mean ratios of all rows of ``target`` with words; minus infinity if there are none.

    Ratios are rounded to five places, so tasks hand on counts of few different values and any order gives the same.
    """
    return least_of(target.select(let(words_of(F.col(f"`{text}`")), lambda w: mean_ratio(w, model)).alias("ratio")), "ratio", quantile, margin)


def least_of(target: DataFrame, ratio: str = "mean_ratio", quantile: float = QUANTILE, margin: float = MARGIN) -> float:
    """As ``least_ratio``, from mean ratios that ``judge`` has found already."""
    own = target.select(F.round(F.col(f"`{ratio}`"), 5).alias("ratio"))
    low, middle = own.agg(F.percentile("ratio", quantile).alias("low"), F.percentile("ratio", 0.5).alias("middle")).first()
    return -math.inf if low is None else low - margin * (middle - low)


def repeated_words(words: Column, width: int = 3) -> Column:
    """Number of words that lie in a window of ``width`` words found twice or more in the text.

    Windows are compared by 64-bit hashes. Only texts with a repeat are sorted: first numbers of 33 bits of the hash and
    the place, where neighbours with equal bits may be repeats, then these alone by whole hash and place, where neighbours
    with equal hashes are. Sorting keeps a text of a million words at n log n steps.
    """
    size = F.size(words)
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)])
    windows = F.transform(F.sequence(F.lit(0), F.greatest(size - width, F.lit(0))), window)
    low = F.lit(PLACE)

    def beside(alike: Callable[[Column], Column]) -> Column:
        """True if a neighbour in the order is alike; the ends have one neighbour."""
        return F.coalesce(alike(F.lit(-1)) | alike(F.lit(1)), F.lit(False))

    def candidates(hashes: Column) -> Callable[[Column], Column]:
        def chosen(ordered: Column) -> Column:
            near = lambda k, i: beside(lambda step: k.bitwiseXOR(F.get(ordered, i + step)).between(F.lit(0), low))
            at = lambda k: k.bitwiseAND(low).cast("int")
            found = F.transform(F.filter(ordered, near), lambda k: F.struct(F.get(hashes, at(k)).alias("h"), at(k).alias("at")))
            return let(F.sort_array(found), places)

        return chosen

    def places(ordered: Column) -> Column:
        again = lambda w, i: beside(lambda step: F.get(ordered, i + step)["h"] == w["h"])
        return F.sort_array(F.transform(F.filter(ordered, again), lambda w: w["at"]))

    def cover(acc: Column, at: Column) -> Column:
        return F.struct((acc["n"] + at + width - F.greatest(acc["end"], at)).alias("n"), (at + width).alias("end"))

    def covered(hashes: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))  # words covered so far, and where they end
        keys = F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(~PLACE)).bitwiseOR(i.cast("long")))
        counted = F.aggregate(let(F.sort_array(keys), candidates(hashes)), start, cover)["n"]
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), counted).otherwise(F.lit(0))

    return F.when(size > width, let(windows, covered)).otherwise(F.lit(0)).cast("long")


def repeated_lines(text: Column) -> Column:
    """Number of lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def judge(docs: DataFrame, model: list[float], threshold: float = -math.inf, text: str = "text", least_words: int = 50) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, mean_ratio and kept.

    Clashing columns of ``docs`` stay and the new ones get other names. A null, empty or blank text has no words and
    fails the base rules. ``kept`` is true if the base rules hold and the mean log ratio is at least ``threshold``.
    Rows are judged one by one: equal rows get equal verdicts, an empty table stays empty.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "mean_ratio", "kept"]
    facts, *new = unused(docs.columns, "facts", *names)

    def counted(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: acc + F.length(w)).alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
            mean_ratio(words, model).alias("mean_ratio"),
        )

    def ruled(f: Column) -> Column:
        failed = (f["n_words"] < least_words) | (100 * f["n_repeat_words"] > 50 * f["n_words"])
        kept = ~failed & F.coalesce(f["mean_ratio"] >= threshold, F.lit(False))
        return F.struct(*[f[n].alias(n) for n in ("n_words", "word_chars", "n_repeat_words", "mean_ratio")], failed.alias("base_failed"), kept.alias("kept"))

    def judged(body: Column) -> Column:
        plain = F.struct(F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), repeated_lines(body).alias("n_dup_lines"))
        return F.struct(plain.alias("plain"), let(let(words_of(body), counted), ruled).alias("ruled"))

    columns = [F.col(f"`{c}`") for c in docs.columns]
    made = docs.withColumn(facts, let(F.coalesce(F.col(f"`{text}`"), F.lit("")), judged))
    part = {"n_symbols": "plain", "n_dup_lines": "plain"}
    return made.select(*columns, *[F.col(facts)[part.get(n, "ruled")][n].alias(as_) for n, as_ in zip(names, new, strict=True)])

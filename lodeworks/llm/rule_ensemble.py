"""Quality classifier: a sparse ensemble of rules over a text's statistics.

Boosted trees are fitted to the statistics of labelled documents. Every path from a root to a node is a conjunctive rule;
a lasso logistic regression gives most rules the weight 0. The others are compiled into one Spark column expression, so
scoring is a projection without Python.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let, unused, words_of, written

#: Labelled documents that the model is fitted on, chosen by a hash of their id; all of them if there are fewer.
FIT_ROWS = 20_000
TREES = 12
DEPTH = 3
#: Strength of the lasso.
PENALTY = 0.002
SEED = 11

STATISTICS = ("words", "mean_word", "symbols", "bangs", "upper", "digits", "stops", "beyond_ascii", "distinct_words", "repeated_lines", "longest_line")


def statistics(text: Column) -> Column:
    """A struct of the statistics as doubles, none null or NaN. A null text counts as an empty one.

    All are shares or logarithms of counts over the whole text, made by built-in functions.
    """

    def measured(d: Column) -> Column:
        body, words, lines = d["body"], d["words"], d["lines"]
        n_words, n_lines = F.greatest(F.size(words), F.lit(1)), F.size(lines)
        chars = F.greatest(F.length(body), F.lit(1))
        share = lambda pattern: F.regexp_count(body, F.lit(pattern)) / chars
        made = {
            "words": F.log1p(F.size(words).cast("double")),
            "mean_word": F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: acc + F.length(w)) / n_words,
            "symbols": share(r"[#*$%&|<>{}\[\]=_~^]"),
            "bangs": share("[!?]"),
            "upper": share("[A-Z]"),
            "digits": share("[0-9]"),
            "stops": share("[.,;:]"),
            "beyond_ascii": (F.octet_length(body) - F.length(body)) / chars,
            "distinct_words": F.size(F.array_distinct(words)) / n_words,
            "repeated_lines": 1 - F.size(F.array_distinct(lines)) / n_lines,
            "longest_line": F.log1p(F.array_max(F.transform(lines, lambda x: F.length(x))).cast("double")),
        }
        return F.struct(*[made[s].cast("double").alias(s) for s in STATISTICS])

    cut = lambda body: F.struct(body.alias("body"), words_of(body).alias("words"), F.split(body, "\n").alias("lines"))
    return let(let(F.coalesce(text, F.lit("")), cut), measured)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is it at most, bound), and its weight in the log odds."""

    terms: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self, of: Callable[[str], Column]) -> Column:
        """Does it hold? ``of`` gives the column of a statistic."""
        holds = F.lit(True)
        for statistic, at_most, bound in self.terms:
            holds = holds & (of(statistic) <= bound if at_most else of(statistic) > bound)
        return holds


@dataclass(frozen=True)
class Model:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self, text: Column) -> Column:
        """Probability of label 1, as one expression over a text."""

        def odds(stats: Column) -> Column:
            total = F.lit(self.intercept)
            for rule in self.rules:
                total = total + F.when(rule.column(stats.getField), rule.weight).otherwise(0.0)
            return total

        return 1 / (1 + F.exp(-let(statistics(text), odds)))


def paths(tree) -> list[tuple[tuple[str, bool, float], ...]]:
    """The conditions from the root to every other node of a fitted tree."""
    found, open_nodes = [], [(tree._call_java("rootNode"), ())]
    while open_nodes:
        node, terms = open_nodes.pop()
        if terms:
            found.append(terms)
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            statistic, bound = STATISTICS[split.featureIndex()], float(split.threshold())
            open_nodes += [(node.leftChild(), (*terms, (statistic, True, bound))), (node.rightChild(), (*terms, (statistic, False, bound)))]
    return found


def fit(labelled: DataFrame, label: str = "label", text: str = "text") -> Model:
    """Fits on rows with a label of 0 or 1 (others are left out); the caller bounds their number.

    With one class only, or no row, the model is a constant: the smoothed share of label 1.
    """
    rows = labelled.where(F.col(f"`{label}`").isin(0, 1))
    measured = rows.select(F.col(f"`{label}`").cast("double").alias("label"), statistics(F.col(f"`{text}`")).alias("stats"))
    sample = written(measured.select("label", "stats.*").repartition(4), "quality-sample")
    n, ones = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < n:
        share = (ones + 1) / (n + 2)
        return Model((), math.log(share / (1 - share)))
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample).select("label", "features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED, featureSubsetStrategy="all").fit(vectors).trees
    rules = [Rule(terms) for terms in dict.fromkeys(p for t in trees for p in paths(t))]
    if not rules:
        return Model((), math.log(ones / (n - ones)))
    held = sample.select("label", *[r.column(F.col).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    held = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(held)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=100).fit(held.select("label", "features"))
    weights = lasso.coefficients.toArray()
    return Model(tuple(Rule(r.terms, float(w)) for r, w in zip(rules, weights, strict=True) if w != 0.0), float(lasso.intercept))


def fit_on_labels(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> Model:
    """Fits on labelled documents for which ``learn`` is true: about ``fit_rows`` at most, by a hash of doc_id.

    A document with several labels counts once with each different one; null ids and labels other than 0 and 1
    are left out. The chosen labels are few by that bound, so they are broadcast and texts stay where they are.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").where(learn).select("doc_id", F.col("quality").alias("label")).distinct()
    n = known.count()
    chance = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    chosen = known if n <= fit_rows else known.where(chance < fit_rows / n)
    return fit(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))


def judge(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 if score >= ``threshold``); other names where they clash.

    Rows are judged by their text alone: null and empty texts score as empty ones, equal texts score alike.
    """
    score, predicted = unused(docs.columns, "score", "predicted")
    scored = docs.withColumn(score, model.score(F.col(f"`{text}`")))
    return scored.withColumn(predicted, F.when(F.col(score) >= threshold, 1).otherwise(0))

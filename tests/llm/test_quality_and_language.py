from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from llm_cases import ODD, words
from pyspark.sql import functions as F

from lodeworks.llm import language as lang
from lodeworks.llm import quality_rules as qr
from lodeworks.llm import rule_ensemble as re_
from lodeworks.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def base(text):
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


# -- quality rules --------------------------------------------------------------------------------


def test_base_counts_equal_plain_ones(documents):
    rng = random.Random(4)
    rows = [*ODD, *[(100 + i, "".join(rng.choice(["a ", "b ", "c#", "\n", " é ", "\t", "a b c ", "%"]) for _ in range(rng.randrange(90)))) for i in range(60)]]
    got = qr.judge(documents(rows), [0.0] * 64).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(base(t) for _, t in rows)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])


def test_ratio_of_hand_counted_cells(documents):
    """Every word and pair in a cell of its own: the ratio is that of smoothed multinomials."""
    rows = [(1, "a b a b"), (2, "c d"), (3, None), (4, "")]
    cells = 1 << 14
    model = qr.ratios(documents(rows), F.col("doc_id") == 1, cells=cells)
    got = {r["doc_id"]: r["mean_ratio"] for r in qr.judge(documents(rows), model).collect()}
    target = {"a": 2, "b": 2, "a b": 2, "b a": 1}
    raw = {**target, "c": 1, "d": 1, "c d": 1}
    ratio = lambda g: math.log((target.get(g, 0) + 1) / (7 + cells) * (10 + cells) / (raw[g] + 1))
    assert got[1] == pytest.approx(sum(n * ratio(g) for g, n in target.items()) / 7)
    assert got[2] == pytest.approx((ratio("c") + ratio("d") + ratio("c d")) / 3)
    assert got[3] is None and got[4] is None


def test_without_a_target_nothing_is_rejected(documents, empty):
    good = (1, " ".join(f"w{i}" for i in range(80)))
    model = qr.ratios(documents([good]), F.lit(None).cast("boolean"))
    assert qr.judge(documents([good]), model).first()["kept"]
    assert set(qr.ratios(empty, F.lit(True))) == {0.0}
    assert qr.judge(empty, model).collect() == []


def test_rules_clashing_columns(documents):
    df = documents([(1, "x")]).withColumnsRenamed({"lang": "kept", "source": "Words"})
    got = qr.judge(df, [0.0] * 8)
    assert got.columns[:5] == df.columns and len({c.lower() for c in got.columns}) == 13


def test_rules_part_labelled_documents(spark):
    got = QUERIES["op6_ngram_ratio_rules"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = got.join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in judged}
    assert kept[1] > 0.95 and kept.get(0, 0.0) < 0.5


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_threshold_at_two_sizes(spark, size):
    labels = spark.read.parquet(f"/root/testdata/{size}/labels.parquet").select("doc_id", "quality").distinct()
    got = QUERIES["op6_ngram_ratio_rules"](spark, f"/root/testdata/{size}").join(labels, "doc_id").where("not base_failed")
    kept = {r["quality"]: (r["kept"], r["n"]) for r in got.groupBy("quality").agg(F.count_if("kept").alias("kept"), F.count(F.lit(1)).alias("n")).collect()}
    print(size, kept)
    assert kept[1][0] >= 0.99 * kept[1][1] and kept[0][0] <= 0.01 * kept[0][1]


def test_least_ratio_of_hand_counted_rows(documents, empty):
    target = documents([(i, "a") for i in range(4)] + [(5, "b"), (6, ""), (7, None)])
    model = [0.0] * 64
    a, b = (qr.words_of(F.lit(w)) for w in "ab")
    at = target.limit(1).select(qr.cells_of(a, 64)[0].alias("a"), qr.cells_of(b, 64)[0].alias("b")).first()
    model[at["a"]], model[at["b"]] = 1.0, -1.0
    assert qr.least_ratio(target, model, quantile=0.0, margin=0.5) == pytest.approx(-2.0)
    assert qr.least_ratio(target, model, quantile=0.5) == pytest.approx(1.0)
    assert qr.least_ratio(empty, model) == -math.inf
    assert qr.ratios_between(target.where("doc_id < 4"), target) == pytest.approx(qr.ratios(target, F.col("doc_id") < 4))


def test_every_text_is_judged_once_and_the_threshold_comes_from_the_verdicts(spark):
    """Labelled good texts were hashed three times: for the target, for the raw corpus and for the threshold."""
    got = QUERIES["op6_ngram_ratio_rules"](spark, SF)
    assert "xxhash64" not in got._jdf.queryExecution().optimizedPlan().toString()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    target = docs.join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id", "left_semi")
    model = qr.ratios_between(target, docs)
    want = qr.judge(docs, model, qr.least_ratio(target, model)).drop("text")
    assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_cells_are_made_once_below_a_join(spark, documents, monkeypatch):
    """The filter that Spark infers for a plain explode made the cells of every text a second time."""
    seen = []
    monkeypatch.setattr(qr, "written", lambda df, name: seen.append(df) or df)
    docs = documents([(1, "a b"), (2, None), (3, "")])
    qr.ratios(docs.select("doc_id", "text").join(docs.select("doc_id", F.lit(True).alias("good")).hint("merge"), "doc_id", "left"), F.col("good"))
    assert seen[0]._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_few_repeats_in_a_long_text(documents):
    w = [f"w{i}" for i in range(60_000)]
    w[50_000:50_004] = w[7:11]
    w[59_997:] = w[0:3]
    text = " ".join(w)
    assert qr.judge(documents([(1, text)]), [0.0] * 8).first()["n_repeat_words"] == base(text)[4] == 14


# -- classifier -----------------------------------------------------------------------------------


def test_classifier_on_held_out_labels(spark):
    got = QUERIES["op4_rule_ensemble_quality"](spark, "/root/testdata/sf0.01")
    judged = got.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(judged) > 40
    assert sum(r["predicted"] == r["quality"] for r in judged) / len(judged) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in judged)


def test_rules_are_conjunctions_and_sparse(documents, odd, empty):
    rows = [(i, ("word " * 30 if i % 2 else "%%% " * 30) + f"n{i}") for i in range(60)]
    labelled = documents(rows).withColumn("label", (F.col("doc_id") % 2).cast("int"))
    model = re_.fit(labelled.unionByName(documents([(99, "no label")]).withColumn("label", F.lit(None).cast("int"))))
    assert 0 < len(model.rules) < 40 and all(r.terms and r.weight for r in model.rules)
    judged = {r["doc_id"]: r for r in re_.judge(documents(rows), model).collect()}
    assert all(judged[i]["predicted"] == i % 2 for i, _ in rows)
    strange = re_.judge(odd, model).collect()
    assert len(strange) == len(ODD) and all(0 <= r["score"] <= 1 for r in strange)
    assert len({r["score"] for r in strange if not words(r["text"]) and "\n" not in (r["text"] or "")}) == 1
    assert re_.judge(empty, model).collect() == []


def test_classifier_without_labels_or_with_one_class(documents, spark):
    df = documents([(1, "a"), (2, "b"), (None, "c")])
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 1, None), (None, 0, 0), (7, 5, 0)], "doc_id long, quality int, toxic int")
    one = re_.fit_on_labels(df, labels, F.lit(True))
    assert one.rules == () and re_.judge(df, one).first()["score"] == pytest.approx(0.75)
    none = re_.fit_on_labels(df, labels.limit(0), F.lit(True))
    got = re_.judge(df.withColumnsRenamed({"lang": "score", "source": "Predicted"}), none)
    assert got.columns[:5] == ["doc_id", "text", "score", "Predicted", "n_chars"] and got.first()[5] == pytest.approx(0.5)


def test_verdicts_can_be_filtered(documents):
    """A filter over a verdict takes the expression that makes it, which must not be computed per element."""
    df = documents([(i, f"word{i} and more words of it " * 2000) for i in range(20)])
    assert qr.judge(df, [0.0] * 64).where("not kept and n_repeat_words > 10").count() == 20
    assert re_.judge(df, re_.Model((re_.Rule((("words", False, 2.0),), 3.0),), 0.0)).where("predicted = 1").count() == 20


# -- language -------------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op1_language_backoff"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    judged = got.where("held_out").collect()
    assert len(judged) > 150 and sum(r["lang"] == r["lang_pred"] for r in judged) / len(judged) > 0.98


def plain_score(model, text):
    """Sum over words one by one, without memory or matrices."""
    total = [0.0] * len(model.langs)
    found = lang.letter_words(text)
    for w in found:
        total = [a + float(b) for a, b in zip(total, lang.word_scores(model, w), strict=True)]
    return [t / len(found) for t in total]


def test_backoff(documents, odd, empty, monkeypatch):
    rows = [(1, "the cat the dog"), (2, "der hund der kater"), (3, None), (4, "the end")]
    df = documents(rows).withColumn("lang", F.when(F.col("doc_id") == 2, "de").when(F.col("doc_id") != 4, "en"))
    model = lang.fit(df)
    assert model.langs == ["de", "en"]
    the = lang.word_scores(model, "the")
    assert the[1] == pytest.approx(math.log10(2 / 4)) and the[0] == lang.ABSENT
    # unknown words: their longest known n-grams, here " kat", "kate" and others of "kater"
    assert lang.word_scores(model, "kate")[0] > lang.word_scores(model, "kate")[1]
    assert lang.word_scores(model, "漢字").tolist() == [lang.ABSENT] * 2
    for words_, entries in ((4, 1000), (100, 6), (100, 1)):
        monkeypatch.setattr(lang, "REMEMBERED", words_)
        monkeypatch.setattr(lang, "ENTRIES", entries)
        scorer = lang.Scorer(model)
        for text in ("the kater dogs and cats hund the the xylophone", "der der the", "a b c d e f g h", "the cat " * 50):
            want = plain_score(model, text)
            got, score = scorer(text)
            odds = [10 ** (x - max(want)) for x in want]
            assert got == model.langs[want.index(max(want))] and score == pytest.approx(max(odds) / sum(odds), rel=1e-5)
    for text in ("the kater dogs and cats hund the the xylophone", "der der the", "a b c d e f g h"):
        want = plain_score(model, text)
        got, score = scorer(text)
        assert got == model.langs[want.index(max(want))] and 0 <= score <= 1
    assert scorer("") == scorer(None) == scorer("12 ... ²") == ("und", 0.0)
    judged = {r["doc_id"]: r for r in lang.predict(odd, model).collect()}
    assert judged[1]["lang_pred"] == judged[2]["lang_pred"] == judged[3]["lang_pred"] == "und"
    assert judged[8]["lang_pred"] in ("de", "en")
    assert lang.predict(empty, model).collect() == []
    nothing = lang.fit(empty)
    assert {r["lang_pred"] for r in lang.predict(odd, nothing).collect()} == {"und"}
    clash = odd.withColumnsRenamed({"lang": "lang_pred", "source": "found"})
    assert lang.predict(clash, model).columns[:5] == clash.columns


def test_fit_takes_a_bounded_share_of_each_language(documents):
    spelled = lambda i: "".join("abcdefghij"[int(d)] for d in str(i))
    df = documents([(i, f"word{spelled(i)} common") for i in range(400)]).withColumn("lang", F.when(F.col("doc_id") < 390, "en").otherwise("fr"))
    model = lang.fit(df, fit_docs=50)
    assert 10 + 20 < len(model.rows[0]) < 10 + 90  # all ten of one language, about fifty of the other


def test_every_language_is_learned_and_copies_count_once(documents, empty):
    """Five hundred languages of a document each, one of them in very many copies."""
    spelled = lambda i: "".join("abcdefghij"[int(d)] for d in f"{i:03d}")
    rows = [(i, f"{spelled(i)}x {spelled(i)}y {spelled(i)}z shared") for i in range(500)] + [(1000 + i, "aaax aaay aaaz shared") for i in range(300)]
    df = documents(rows).withColumn("lang", F.concat(F.lit("l"), F.lpad((F.col("doc_id") % 1000 * F.when(F.col("doc_id") < 1000, 1).otherwise(0)).cast("string"), 3, "0")))
    model = lang.fit(df)
    assert len(model.langs) == 500 and len(model.index) < 80 * 500
    got = lang.predict(documents([(i, f"{spelled(i)}y {spelled(i)}z") for i in range(500)]), model).collect()
    assert all(r["lang_pred"] == f"l{r['doc_id']:03d}" for r in got)
    assert lang.word_scores(model, "aaax")[0] == pytest.approx(math.log10(1 / 4))  # of four words, not of 301 copies


def brute_model(rows, longest=5):
    """Log10 shares of words and n-grams of each length, straight from the definition."""
    counts = {}
    for language, text in set(rows):
        for w in lang.LETTERS.findall(text.lower()):
            counts.setdefault((language, 0), Counter())[w] += 1
            padded = f" {w} "
            for k in range(1, longest + 1):
                counts.setdefault((language, k), Counter()).update(padded[i : i + k] for i in range(len(padded) - k + 1))
    return {(language, k, g): math.log10(n / sum(c.values())) for (language, k), c in counts.items() for g, n in c.items()}


def brute_predict(shares, langs, text, longest=5):
    words_ = lang.LETTERS.findall((text or "").lower())
    total = dict.fromkeys(langs, 0.0)
    for w in words_:
        padded, options = f" {w} ", [[(0, w)]]
        options += [[(k, padded[i : i + k]) for i in range(len(padded) - k + 1)] for k in range(longest, 1, -1)] + [[(1, c) for c in w]]
        known = next((o for grams in options if (o := [g for g in grams if any((x, *g) in shares for x in langs)])), [])
        for x in langs:
            total[x] += sum(max(shares.get((x, *g), lang.ABSENT), lang.ABSENT) for g in known) / len(known) if known else lang.ABSENT
    return {x: t / len(words_) for x, t in total.items()}


def test_fit_and_scores_equal_the_definition(documents):
    rows = [("en", "the cat sat on the mat"), ("en", "the dog"), ("de", "der hund und die katze"), ("fr", "le chat et le chien"), ("fr", "le chat et le chien")]
    df = documents([(i, t) for i, (_, t) in enumerate(rows)]).withColumn("lang", F.element_at(F.array(*[F.lit(x) for x, _ in rows]), F.col("doc_id").cast("int") + 1))
    model, shares = lang.fit(df), brute_model(rows)
    texts = ["the katze", "chienne hunde", "ca", "zzz q", "on et und"]
    for r in lang.predict(documents(list(enumerate(texts))), model).collect():
        want = brute_predict(shares, ["de", "en", "fr"], r["text"])
        best = min(want, key=lambda x: (-want[x], x))
        assert r["lang_pred"] == best
        assert r["score"] == pytest.approx(1 / sum(10 ** (v - want[best]) for v in want.values()), rel=1e-4)

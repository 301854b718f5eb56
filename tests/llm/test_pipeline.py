from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from llm_cases import ODD, words
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from lodeworks.llm import secret_scan
from lodeworks.llm.shared import written

SF = "/root/testdata/sf0.001"
STAGE = dict(pipeline.STAGES)


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixture", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        after = written(stage(spark, docs, SF), name)
        out[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()])
        docs = after
    return out


def shingles(text):
    w = words((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_quality_drops_labelled_bad_documents_and_keeps_good_ones(stages, spark):
    before, after = stages["quality"]
    assert list(after[0]) == list(before[0]) and all(r in before for r in after)
    kept = {r["doc_id"] for r in after}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert all((r["doc_id"] in kept) == (r["quality"] == 1) for r in labels)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    sets = {r["doc_id"]: shingles(r["text"]) for r in before}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, j in enumerate(ids):
        for i in ids[:k]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert sorted(r["doc_id"] for r in after) == sorted(i for i in ids if find(i) == i)
    assert len(after) < len(before) and all(r in before for r in after)


def test_secrets_go_and_other_text_stays(stages):
    before, after = stages["secrets"]
    rules = [(re.compile(r.pattern, re.ASCII), r.group, r.least) for r in secret_scan.RULES]
    secret = lambda t: [m for p, g, n in rules for m in p.finditer(t) if len(m[g]) >= n]
    old, new = ({r["doc_id"]: r for r in rows} for rows in (before, after))
    assert set(old) == set(new) and any(secret(r["text"]) for r in before)
    for i, r in new.items():
        assert not secret(r["text"]) and r["n_chars"] == len(r["text"])
        if not secret(old[i]["text"]):
            assert r == old[i]


def test_mixture_repeats_rows(stages):
    before, after = stages["mixture"]
    assert list(after[0]) == list(before[0]) and all(r in before for r in after)
    assert abs(len(after) - len(before)) < 6 * len(before) ** 0.5


def test_packing_holds_every_row_once(stages):
    before, after = stages["packing"]
    assert Counter(r["doc_id"] for r in after if r["piece"] == 0) == Counter(r["doc_id"] for r in before)
    held = defaultdict(list)
    for r in after:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024


def test_stages_bear_odd_rows(odd, empty, spark, tmp_path):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    extra = odd.withColumn("score", F.lit("kept as it is")).withColumn("Blob", F.lit(1)).withColumn("copy", F.lit(2))
    docs = extra
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == extra.columns, name
        docs = written(docs, name)
        assert stage(spark, empty, str(tmp_path)).collect() == []
    assert STAGE["packing"](spark, empty, str(tmp_path)).collect() == []
    assert STAGE["packing"](spark, extra, str(tmp_path)).where("piece = 0").count() == len(ODD)


def test_near_duplicates_among_odd_rows(odd, spark):
    kept = [(r["doc_id"], r["text"]) for r in STAGE["near_duplicates"](spark, odd, SF).collect()]
    assert sorted(i for i, _ in kept if i) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert (6, "another text under the same id") in kept and sorted(str(t) for i, t in kept if i is None) == ["None", "a text without an id"]


def test_texts_of_one_id_and_rows_without_an_id_or_words_stay(documents, spark):
    long = [" ".join(f"w{k}-{i}" for i in range(40)) for k in range(4)]
    rows = [(1, long[0]), (1, long[1]), (1, long[1]), (2, long[1] + " more"), (None, long[2]), (None, long[2] + " x"), (None, long[3]), (9, long[3] + " y")]
    blank = [(None, None), (None, ""), (None, ""), (3, " "), (3, None)]
    kept = [(r["doc_id"], r["text"]) for r in STAGE["near_duplicates"](spark, documents(rows + blank), SF).collect()]
    nameless = [t for i, t in kept if i is None and t]
    assert len(nameless) == 1 and nameless[0].startswith(long[2])
    assert sorted(((i, t) for i, t in kept if i and (t or " ").strip()), key=str) == [(1, long[0]), (1, long[1]), (9, long[3] + " y")]
    assert sorted((r for r in kept if not (r[1] or "").strip()), key=str) == sorted(blank, key=str)


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is pipeline.run
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert pipeline.run(spark, SF).where("piece = 0").count() > 100

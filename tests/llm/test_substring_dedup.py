from __future__ import annotations

import random

import numpy as np
import pytest
from llm_cases import ODD, words

from lodeworks.llm import substring_dedup as sd



def brute(rows, width):
    """Kept words of every row, by the definition."""
    first: dict[tuple, int] = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - width + 1):
            window = tuple(w[k : k + width])
            if i is not None:
                first[window] = min(first.get(window, i), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = set()
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def corpus(seed=5):
    """Texts over few words, with passages in common, copies, and a line that most of them hold."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else f"w{rng.randrange(300)}"
    passages = [[word() for _ in range(rng.randrange(8, 40))] for _ in range(6)]
    rows = []
    for i in range(80):
        text = [word() for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.5:
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice(passages)
        if rng.random() < 0.7:
            text += passages[0]
        rows.append((i, " ".join(text)))
        if rng.random() < 0.2:
            rows.append((1000 - i, "\n".join(text)))
    return rows


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("width", [13, 6])
def test_equal_to_the_definition(documents, width):
    rows = corpus()
    want = brute(rows, width)
    assert sum(r[2] for r in want) > 500
    assert result(sd.remove_repeats(documents(rows), width)) == want


def test_hot_anchors_and_small_shards_change_nothing(documents, monkeypatch):
    monkeypatch.setattr(sd, "HOT_SEGMENTS", 2)
    monkeypatch.setattr(sd, "SHARD_WORDS", 50)
    rows = corpus(seed=6)
    assert result(sd.remove_repeats(documents(rows))) == brute(rows, 13)


def test_statistics_and_holders_of_a_shard():
    """Of every window how many of its last words occur twice in the shard, and the smallest owner of repeated ones."""
    rng = random.Random(3)
    contents = [[rng.choice("abc") for _ in range(rng.randrange(5, 12))] for _ in range(30)]
    owners = np.array([rng.randrange(1 << 60) for _ in contents])
    holders, bounds, reach = sd.first_holders([" ".join(c).encode() for c in contents], owners, 5)
    runs = lambda n: [tuple(c[k : k + n]) for c in contents for k in range(len(c) - n + 1)]
    windows = [(i, k) for i, c in enumerate(contents) for k in range(len(c) - 4)]
    assert len(windows) == bounds[-1] == len(reach)
    for (i, k), holder, n in zip(windows, holders.tolist(), reach.tolist(), strict=True):
        window = tuple(contents[i][k : k + 5])
        assert n == max((m for m in range(1, 6) if runs(m).count(window[5 - m :]) > 1), default=0)
        held = [int(owners[j]) for j, c in enumerate(contents) for m in range(len(c) - 4) if tuple(c[m : m + 5]) == window]
        assert holder == (min(held) if len(held) > 1 else owners[i])


def stored(monkeypatch, documents, rows):
    """What is written of an input's segments, and its hot anchors."""
    kept = {}
    own = sd.written
    monkeypatch.setattr(sd, "written", lambda df, name: kept.setdefault(name, own(df, name)))
    assert result(sd.remove_repeats(documents(rows))) == brute(rows, 13)
    return kept["segments"], kept["hot-anchors"]


def test_copies_are_not_searched_nor_cut_into_windows(documents, monkeypatch):
    monkeypatch.setattr(sd, "HOT_SEGMENTS", 50)
    text = " ".join(f"word{i * i % 97}-{i}" for i in range(200))
    for parts in (1, 5):
        with monkeypatch.context() as patch:
            told, hot = stored(patch, lambda r, n=parts: documents(r).repartition(n), [(i, text) for i in range(60)])
            searched = told.where("not whole")
            assert searched.where("doc_id = 0").count() < 188 / 3 and hot.count() == 0
            # once for each batch at most, and only the smallest document of all is left where batches meet
            assert searched.select("doc_id").distinct().count() == 1


def test_hot_anchors_are_split_alike_in_all_batches(documents, monkeypatch):
    """An anchor that is hot only over all batches together, in documents that share it within their batch too."""
    monkeypatch.setattr(sd, "HOT_SEGMENTS", 40)
    rng = random.Random(9)
    common = " ".join(f"c{i}" for i in range(14))
    rows = [(i, " ".join([f"x{rng.randrange(5)}", common, *[f"y{rng.randrange(30)}" for _ in range(4)]])) for i in range(160)]
    _, hot = stored(monkeypatch, lambda r: documents(r).repartition(6), rows)
    assert hot.count() > 0


def test_texts_are_shuffled_once(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shown = sd.remove_repeats(docs).drop("text")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange [doc_id" in shown and shown.count("documents.parquet") == 1


def test_short_windows_and_repeated_ids(documents):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "x a b c d"), (None, "a b c d e f"), (3, "d e f a b c")] * 2
    for width in (4, 5):
        assert result(sd.remove_repeats(documents(rows), width)) == brute(rows, width)
    for width in (3, 0):
        with pytest.raises(ValueError, match="at least 4"):
            sd.remove_repeats(documents(rows), width)


def test_odd_rows(odd, empty):
    got = result(sd.remove_repeats(odd))
    assert got == brute(ODD, 13)
    assert (6, 14, 14, "") in got and got.count((5, 14, 0, ODD[6][1])) == 2
    assert sd.remove_repeats(empty).collect() == []


def test_clashing_columns(documents):
    df = documents([(1, "a"), (2, None)]).withColumnsRenamed({"lang": "kept", "source": "Starts"})
    got = sd.remove_repeats(df)
    assert got.columns[:5] == df.columns and len(set(map(str.lower, got.columns))) == 8
    assert sorted(r[-1] for r in got.collect()) == ["", "a"]


def test_wavelet_tree_rank():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 64, 1000):
        symbols = rng.integers(0, size, 777)
        tree = sd.WaveletTree(symbols, size)
        asked, at = rng.integers(0, size, 300), rng.integers(0, 778, 300)
        assert tree.rank(asked, at).tolist() == [int((symbols[:p] == s).sum()) for s, p in zip(asked, at, strict=True)]


def test_backward_search_counts_occurrences():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 4, 400)
    text[[50, 51, 120, 399]] = 0
    index = sd.FMIndex(text, 4, 6)
    for _ in range(200):
        pattern = rng.integers(1, 4, rng.integers(1, 7))
        low, high = np.array([0]), np.array([len(text)])
        for s in pattern[::-1]:
            low, high = index.extend(np.array([s]), low, high)
        found = [i for i in range(len(text) - len(pattern) + 1) if (text[i : i + len(pattern)] == pattern).all()]
        assert high[0] - low[0] == len(found)
        assert sorted(index.suffixes[low[0] : high[0]].tolist()) == found

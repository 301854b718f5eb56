from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ODD, words

from lodeworks.llm import hashing
from lodeworks.llm import near_duplicates as nd


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = words((text or "").translate(LOWER))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def brute(rows, width, percent):
    """Component of every row, comparing all pairs; rows of one id are one node."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def corpus(seed=3, n=60):
    """Originals, exact copies, copies with some words changed, chains of small changes, and a common passage."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(400))
    rows, passage = [], [word() for _ in range(30)]
    for _ in range(n):
        text = [word() for _ in range(rng.randrange(3, 120))]
        if rng.random() < 0.3:
            text += passage
        rows.append(text)
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(text)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(copy)
            if rng.random() < 0.5:
                text = copy  # a chain: each is like the one before
    rng.shuffle(rows)
    return [(i, rng.choice([" ", "  ", "\n"]).join(t)) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("width", "percent"), [(4, 80), (5, 80)])
def test_components_are_those_of_all_pairs(spark, documents, width, percent):
    rows = corpus()
    got = {r["doc_id"]: r for r in nd.duplicates(documents(rows), width, percent).collect()}
    want = brute(rows, width, percent)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert len(set(want.values())) < len(rows) - 20
    for i, text in rows:
        assert got[i]["n_shingles"] == len(shingles(text, width))
        assert got[i]["kept"] == (want[i] == i)


def test_a_bucket_with_several_groups_keeps_all_links(spark):
    """Two groups that share one bucket: the first centre is like neither the rest nor their links."""
    base = [f"w{i}" for i in range(200)]
    texts = {0: [f"z{i}" for i in range(200)], **{k: [*base[: 200 - k], *[f"c{k}{i}" for i in range(k)]] for k in range(1, 6)}}
    source = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    sets = {r["doc_id"]: r for r in source.mapInArrow(nd._sketched(4, True), "doc_id long, n long, a long, b long, bands array<long>, bits array<long>, cells array<short>").collect()}
    members = spark.createDataFrame([(7, i, r["n"], (0, 197)) for i, r in sets.items()], "key long, node long, n long, centre struct<node: long, n: long>")
    sketches = spark.createDataFrame([(i, r["bits"], r["cells"]) for i, r in sets.items()], "node long, bits array<long>, cells array<short>")
    none = spark.createDataFrame([], "a long, b long")
    links = nd._linked(source, members, sketches, none, 4, 80, True)
    assert {r["node"]: r["component"] for r in nd.components(links).collect()} == {k: 1 for k in range(1, 6)}


def test_odd_rows(odd):
    rows = nd.duplicates(odd, 4, 80).collect()
    assert len(rows) == len(ODD)
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in by[2]] == [(0, 2, True)]
    assert [(r["component_id"], r["kept"]) for r in by[5]] == [(5, True)] * 2
    assert {(r["component_id"], r["kept"]) for r in by[6]} == {(5, False)}  # rows of one id are one document
    assert {(r["n_shingles"], r["component_id"], r["kept"]) for r in by[None]} == {(0, None, False), (2, None, False)}
    assert by[7][0]["n_shingles"] == 2


def test_empty_table_and_clashing_columns(empty, documents):
    assert nd.duplicates(empty).collect() == []
    clash = documents([(1, "a b c d e f"), (2, "a b c d e f")]).withColumnsRenamed({"lang": "component_id", "source": "KEPT"})
    assert sorted(tuple(r) for r in nd.duplicates(clash).collect()) == [(1, 2, 1, True), (2, 2, 1, False)]


def test_components_of_a_path(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101)]
    rng.shuffle(edges)
    found = nd.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_densified_sketches_agree_as_often_as_sets_do():
    rng = np.random.default_rng(0)
    for size in (10, 60, 2000):
        agree = []
        for _ in range(60):
            common = rng.integers(0, 1 << 63, size=size * 8 // 10, dtype=np.uint64) * np.uint64(2)
            a, b = (np.sort(np.concatenate([common, rng.integers(0, 1 << 63, size=size // 10, dtype=np.uint64) * np.uint64(2)])) for _ in "ab")
            x, y = nd.one_permutation([a, b])
            agree.append((x == y).mean())
        assert abs(np.mean(agree) - 0.8) < 0.06


def test_word_hashes_follow_words():
    texts = ["a b  c", None, "", "  x\ty\n", "Äö ß\x0bq", "abc", "a b", None, "c d"]
    known: dict[bytes, int] = {}
    for array in (pa.array(texts), pa.array(texts)[2:]):
        got = []
        for part in hashing.word_slices(array):
            for begin, end in zip(part.bounds[:-1], part.bounds[1:], strict=True):
                row = [bytes(part.data[part.start[j] : part.end[j]]) for j in range(begin, end)]
                got.append([w.decode() for w in row])
                assert all(known.setdefault(w, h) == h for w, h in zip(row, part.hashes[begin:end].tolist(), strict=True))
        assert got == [words(t) for t in array.to_pylist()]
    assert len(set(known.values())) == len(known)


def test_low_similarities_are_refused(documents):
    for percent in (75, 50, 101):
        with pytest.raises(ValueError, match="above 75"):
            nd.duplicates(documents([(1, "a")]), percent=percent)

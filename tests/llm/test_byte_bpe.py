from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD
from pyspark.sql import functions as F

from lodeworks.llm import byte_bpe, characters
from lodeworks.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
LIBRARY = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=byte_bpe.ranks_of(PATH), special_tokens={})

LONG = [
    "It's 1,000 words, she'll say;  don't   stop\n\n\tnow. " * 60,
    "x" * 3_000 + " " * 1_500 + "7" * 900,  # pre-tokens longer than an overlap
    "漢字かな交じり文、" * 200 + "՘ՙ " * 300,  # with characters that newer tables have
    "a b" + "՘" * 700 + "c,'" * 400,
    "".join(chr(33 + i * 7 % 90) for i in range(2_500)) * 2,
    "emoji \U0001f600\U0001f468‍\U0001f469 and \x1c\x85  odd blanks 　" * 90,
    "<|endoftext|>" * 300,
]


def expected(text):
    return LIBRARY.encode_ordinary(text or "")


@pytest.mark.parametrize(("chunk", "overlap"), [(16_384, 512), (200, 40), (64, 64), (997, 7)])
def test_ids_are_those_of_the_library_and_decode_to_the_text(spark, documents, chunk, overlap):
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(LONG)], (200, LONG[0]), (None, LONG[1])]
    docs = documents(rows)
    coded = byte_bpe.encode(docs, PATH, PATTERN, chunk=chunk, overlap=overlap)
    got = coded.select("doc_id", "text", byte_bpe.id_list("ids").alias("ids"), byte_bpe.decode("ids", PATH).alias("back")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["ids"] == expected(r["text"]) and bytes(r["back"]).decode() == (r["text"] or "")


def test_neighbours_that_never_agree_are_encoded_together(spark):
    texts = spark.createDataFrame([("long word", "y" * 5_000), ("plain", "some words " * 400)], "address string, text string")
    got = {r["address"]: r for r in byte_bpe.stitched(texts, PATH, PATTERN, 300, 50).collect()}
    assert not got["long word"]["joined"] and b"".join(p["body"] for p in got["long word"]["parts"]) == b"y" * 5_000
    parts = [np.frombuffer(p["body"], "<u4").tolist() for p in got["plain"]["parts"]]
    assert got["plain"]["joined"] and sum(parts, []) == expected("some words " * 400) and len(parts) == 15


def test_long_texts_are_shuffled_once(spark):
    """One exchange of chunks, read twice, one of ids, and the rows' addresses; short texts are not shuffled."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
        shown = byte_bpe.encode(docs, PATH, PATTERN).drop("text")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [line for line in shown.split("\n") if " Exchange hashpartitioning" in line]
    assert shown.count("ReusedExchange") == 1 and len(exchanges) == 5 + 1  # the line of the reused one names it again


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab1,' \n\tsre՘　é漢'")), min_size=1, max_size=60), st.integers(4, 30), st.integers(3, 12))
def test_boundaries_told_by_chunks_are_boundaries_of_the_text(text, chunk, overlap):
    """Each chunk's boundaries from its first agreement with the chunk before on are those of the whole text."""
    ends = {0, *np.cumsum([len(LIBRARY.decode(expected(m))) for m in pieces(text)]).tolist()}
    told = None
    for k in range(-(-len(text) // chunk)):
        piece = text[k * chunk : (k + 1) * chunk + overlap]
        found = set((byte_bpe.boundaries(piece, PATTERN, (k + 1) * chunk >= len(text)) + k * chunk).tolist())
        if told is not None:
            common = [p for p in sorted(found & told) if p <= k * chunk + overlap]
            if not common:
                return
            found = {p for p in found if p >= common[0]}
        assert found <= ends
        told = found


def pieces(text):
    """Pre-tokens by the library's classes of characters, each found by how it joins with a letter, a digit or a blank."""
    kind = {c: "L" if joins("a", c) else "N" if joins("1", c) else "S" if joins("\t", c) else "O" for c in set(text)}
    flat = "".join({"L": "x", "N": "0", "S": "\t", "O": "."}[kind[c]] if c not in " '\n" and not c.isascii() else c for c in text)
    at = 0
    for m in regex.finditer(PATTERN, flat):
        yield text[at : m.end()]
        at = m.end()


FIRST = sorted({chr(c).encode()[0] for c in range(0x110000) if not 0xD800 <= c < 0xE000})
PAIRS = {bytes([b]): b for b in range(256)} | {lead + bytes([f]): 256 + i * 256 + f for i, lead in enumerate((b"a", b"1", b"\t")) for f in FIRST}
CLASSES = tiktoken.Encoding("pairs", pat_str=PATTERN, mergeable_ranks=PAIRS, special_tokens={})


def joins(lead, c):
    return CLASSES.encode_ordinary(lead + c)[0] >= 256


def test_classes_of_characters_agree_but_for_unsure_ones():
    """The expressions here and the library's own must split alike wherever the unsure ones are not met."""
    kinds = [(lead, regex.compile(p)) for lead, p in (("a", r"\p{L}"), ("1", r"\p{N}"), ("\t", r"\s"))]
    for c in [*range(0xD800), *range(0xE000, 0x30000), *range(0xE0000, 0xE0200)]:
        x = chr(c)
        for lead, kind in kinds:
            if lead == "\t" or unicodedata.category(x) != "Cn":
                assert joins(lead, x) == bool(kind.match(x)), hex(c)
    assert characters.unsure("a՘") and not characters.unsure("aé漢\U0001f600")


def test_empty_tables_nulls_and_clashing_names(spark, documents, empty):
    assert byte_bpe.encode(empty, PATH, PATTERN).count() == 0
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, body string, IDS int, address string")
    got = byte_bpe.encode(docs, PATH, PATTERN, text="body", chunk=2, overlap=3)
    assert got.columns == ["doc_id", "body", "IDS", "address", "ids_2"]
    row = got.first()
    assert row["IDS"] == 5 and np.frombuffer(row["ids_2"], "<u4").tolist() == expected("a b")
    nothing = spark.createDataFrame([(None,), (bytearray(),), (bytearray(b"\xff\xff\xff\xff"),)], "ids binary")
    assert [r[0] for r in nothing.select(byte_bpe.decode("ids", PATH)).collect()] == [None, b"", b""]


def test_query_over_all_documents(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in QUERIES["op13_chunked_byte_bpe"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids, r = expected(text), got[doc_id]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert spark.read.parquet(f"{folder}/documents.parquet").where(F.length("text") > byte_bpe.CHUNK).count() > 0

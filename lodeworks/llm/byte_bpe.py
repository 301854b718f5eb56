"""Byte-level BPE: encoding in overlapping chunks, and decoding.

A pre-token is one match of the pattern, and each is encoded for itself. A text of one chunk is encoded in one call. A
longer one is cut into chunks that overlap, which are dealt to tasks and split into pre-tokens there, all at once: each
scan begins at its chunk's first character, where no pre-token need begin, so its first boundaries may be wrong. The
pattern looks ahead by a few characters and never back. So once two scans of one text share a boundary they share all
that follow, and neighbouring chunks are stitched at the first boundary that both have in their overlap: up to there
the text is the earlier chunk's, from there on the later one's. These stretches are whole pre-tokens; they are
encoded in parallel, and their ids joined. A text with an overlap without a common boundary (a pre-token longer than
the overlap) is put together again and encoded in one task: that is rare, and always right.

Decoding joins the bytes of the ids, which need not be whole characters.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .characters import unsure
from .shared import unused

#: Characters of a chunk, and of the overlap behind it that the next chunk also has.
CHUNK = 16_384
OVERLAP = 512
#: Bytes of ids that are decoded at a time.
SLICE_BYTES = 1 << 20
#: A pre-token's alternatives are decided by this many characters from its first one, and one behind its last.
AHEAD = 3


@cache
def ranks_of(path: str) -> dict[bytes, int]:
    """Bytes and id of every token in a rank file: lines of base64 and a number."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@cache
def encoding(path: str, pattern: str):
    """The library's encoder, made once in each worker process."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})


@cache
def vocabulary(path: str) -> pa.Array:
    """Bytes of the token of every id; null for numbers without a token."""
    ranks = ranks_of(path)
    found: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        found[rank] = token
    return pa.array(found, pa.large_binary())


def boundaries(text: str, pattern: str, whole: bool) -> np.ndarray:
    """Where a scan from the first character begins pre-tokens, and the text's end if it is the ``whole`` rest.

    Boundaries that depend on what follows the text are left out. In a text with characters of unsure class only the
    ends of visible runs count, at which pre-tokens end by any tables.
    """
    import regex

    found = regex.findall(r"\s*\S+|\s+" if unsure(text) else pattern, text)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
    starts = np.concatenate([[0], ends])
    # a match is sure if it neither reaches the end nor could have been another with more text
    return starts if whole else starts[: int(np.searchsorted(starts, len(text) - AHEAD, side="right"))]


def packed(path: str, pattern: str):
    """The ids of a text, four bytes each."""
    encode = encoding(path, pattern).encode_ordinary
    return lambda text: np.array(encode(text), dtype="<u4").tobytes()


def _encoder(path: str, pattern: str):
    """Arrow function: texts to their ids, four bytes each; a null text has none."""

    @F.arrow_udf("binary")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids = packed(path, pattern)
        for texts in columns:
            yield pa.array([ids(t.as_py() or "") for t in texts], pa.binary())

    return run


def _cut(chunk: int, overlap: int):
    """Arrow function: (address, text) to (address, k, last, piece): overlapping chunks, numbered from 0."""
    schema = pa.schema([("address", pa.string()), ("k", pa.int32()), ("last", pa.bool_()), ("piece", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, text in zip(batch.column(0), batch.column(1), strict=True):
                body = text.as_py()
                n = -(-len(body) // chunk)
                for k in range(n):
                    piece = body[k * chunk : (k + 1) * chunk + overlap]
                    row = {"address": address.as_py(), "k": k, "last": k == n - 1, "piece": piece}
                    yield pa.RecordBatch.from_pylist([row], schema)

    return run


def _marks(pattern: str, chunk: int, overlap: int):
    """Arrow function: (piece, last) to the boundaries in the overlap with the chunk before, and with the one behind."""

    @F.arrow_udf("struct<head: array<int>, tail: array<int>>")
    def run(pieces: pa.Array, lasts: pa.Array) -> pa.Array:
        rows = []
        for piece, last in zip(pieces, lasts, strict=True):
            found = boundaries(piece.as_py(), pattern, last.as_py())
            tail = found[found >= chunk] - chunk
            rows.append({"head": found[found <= overlap].tolist(), "tail": tail[tail <= overlap].tolist()})
        return pa.array(rows, pa.struct([("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))]))

    return run


def _stretch(path: str, pattern: str, chunk: int):
    """Arrow function: (piece, begin, end, joined) to the ids of a stretch, or its share of the text if it must be joined."""

    @F.arrow_udf("binary")
    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        ids = packed(path, pattern)
        for pieces, *edges in columns:
            rows = zip(pieces, *[e.to_pylist() for e in edges], strict=True)
            yield pa.array([ids(p.as_py()[begin:end]) if joined else p.as_py()[:chunk].encode() for p, begin, end, joined in rows], pa.binary())

    return run


def _joined(path: str, pattern: str):
    """Arrow function: (joined, stretches in order) of a text to its ids."""

    @F.arrow_udf("binary")
    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        ids = packed(path, pattern)
        for joined, stretches in columns:
            made = []
            for whole, parts in zip(joined.to_pylist(), stretches, strict=True):
                body = b"".join(p.as_py() for p in parts.values)
                made.append(body if whole else ids(body.decode()))
            yield pa.array(made, pa.binary())

    return run


def stitched(texts: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(address, joined, parts) of each different text of (address, text): the ids of its stretches in order, or, where
    ``joined`` is false, its chunks, which were not stitched.

    Chunks are dealt by text and number, so a long text is spread over tasks; equal texts are one. The text is shuffled
    once: both the boundaries and the stretches that they bound are found on that exchange.
    """
    cut = texts.mapInArrow(_cut(chunk, overlap), "address string, k int, last boolean, piece string")
    cut = cut.where("address is not null and k is not null")  # as the join below asks for, on both of its ways
    chunks = cut.groupBy("address", "k").agg(F.first("last").alias("last"), F.first("piece").alias("piece"))
    marks = chunks.select("address", "k", "last", _marks(pattern, chunk, overlap)("piece", "last").alias("m"))
    order = Window.partitionBy("address").orderBy("k")  # a few numbers for each chunk of one text
    # the first boundary that both neighbours have, counted from the begin of the later chunk
    found = marks.withColumn("to", F.array_min(F.array_intersect("m.tail", F.lead("m.head").over(order))))
    torn = F.max(~F.col("last") & F.col("to").isNull()).over(Window.partitionBy("address"))
    edges = found.select("address", "k", "to", (~torn).alias("joined"), F.coalesce(F.lag("to").over(order), F.lit(0)).alias("begin"))
    # "last" is taken from the chunks again, so that both readers of their exchange want the same columns
    end = F.when(F.col("last"), F.lit(chunk + overlap)).otherwise(F.col("to") + chunk)
    body = _stretch(path, pattern, chunk)("piece", "begin", end, "joined")
    made = chunks.join(edges.hint("merge"), ["address", "k"]).select("address", "k", "joined", body.alias("body"))
    return made.groupBy("address").agg(F.first("joined").alias("joined"), F.sort_array(F.collect_list(F.struct("k", "body"))).alias("parts"))


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``docs`` with the column ids: little-endian unsigned numbers of four bytes, as one binary.

    The ids are those of the tiktoken library for the ranks in the file at ``path`` (which must exist on the executors)
    and ``pattern``, which must match every character and look ahead by at most three; no special tokens. A null or
    empty text has no ids; an empty table stays empty; equal rows have equal ids. ``ids`` gets another name if ``docs``
    has a column of that name. See ``id_list`` for the ids as an array.
    """
    ids, address, known, joined, parts = unused(docs.columns, "ids", "address", "known", "joined", "parts")
    body = F.col(f"`{text}`")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    is_long = F.coalesce(F.length(body) > chunk, F.lit(False))
    short = docs.where(~is_long).select(*columns, _encoder(path, pattern)(body).alias(ids))
    # 128 bits of the text: equal ones are encoded once
    long = docs.where(is_long).withColumn(address, F.md5(body.cast("binary")))
    found = stitched(long.select(F.col(address).alias("address"), body.alias("text")), path, pattern, chunk, overlap)
    found = found.select(F.col("address").alias(known), F.col("joined").alias(joined), F.col("parts.body").alias(parts))
    # joined to the rows before its function is applied, which would lose the partitioning by text
    rows = long.join(found.hint("merge"), F.col(address) == F.col(known))
    return short.unionByName(rows.select(*columns, _joined(path, pattern)(joined, parts).alias(ids)))


def id_list(ids: str):
    """The ids of a binary column as an array of numbers."""

    @F.arrow_udf("array<long>")
    def run(columns: pa.Array) -> pa.Array:
        return pa.array([None if v is None else np.frombuffer(v, "<u4").tolist() for v in columns.to_pylist()], pa.list_(pa.int64()))

    return run(F.col(ids))


def decode(ids: str, path: str):
    """The bytes that the ids of a binary column stand for, joined; null for null, empty for none.

    A number without a token stands for nothing.
    """

    @F.arrow_udf("binary")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = vocabulary(path)
        for column in columns:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
            edges = np.unique(np.searchsorted(sizes, np.arange(0, sizes[-1] if len(sizes) else 0, SLICE_BYTES)))
            bounds = [0, *edges[edges > 0].tolist(), len(column)]
            yield pa.concat_arrays([told(column.slice(a, b - a), tokens) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])

    return run(F.col(ids))


def told(column: pa.Array, tokens: pa.Array) -> pa.Array:
    """The bytes of each row's ids: tokens are looked up in one go, and lie one behind the other as they are needed."""
    values = column.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    buffer = values.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    numbers = data[offsets[0] : offsets[-1]].copy().view("<u4")
    found = tokens.take(pa.array(numbers, pa.uint32(), mask=numbers >= len(tokens)))
    ends = np.frombuffer(found.buffers()[1], dtype=np.int64)[found.offset : found.offset + len(found) + 1]
    body = found.buffers()[2]
    parts = [None, pa.py_buffer(ends[(offsets - offsets[0]) // 4]), body if body is not None else pa.py_buffer(b"")]
    made = pa.Array.from_buffers(pa.large_binary(), len(values), parts)
    return pc.if_else(values.is_valid(), made, pa.scalar(None, pa.large_binary())).cast(pa.binary())

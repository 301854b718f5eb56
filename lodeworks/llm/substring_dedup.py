"""Removal of repeated word sequences, found by backward search in FM-indexes, one per shard.

Windows of ``words`` consecutive words that occur in two documents must meet in one shard. For that, a window has an
anchor: of its runs of ANCHOR words the one with the smallest hash, and equal windows have equal anchors. Neighbouring
windows mostly share theirs, so a document falls into segments, runs of windows with one anchor. Segments whose anchor
is in one document only have no window in common with any other document and go no further. Of equal segments only the
smallest document's is searched: all windows of the others are repeated, and none of them is any window's smallest
holder. What is left is dealt to shards by anchor. A shard is indexed as one text of word numbers: its Burrows-Wheeler
transform in a wavelet tree of packed bits. All segments of the shard are streamed through the index, which gives the
matching statistics: for every position, how many words that end there occur elsewhere in the shard too, cut at
``words``. Where the statistic reaches ``words``, the window is repeated, and its smallest holder is looked up. Windows
that a smaller document holds make up the intervals that are reported, and removed.

Texts are shuffled once, for both their segments and the result. Else a document's anchors are shuffled, and the
contents of the segments that are searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .hashing import Powers, mixed, sequences, word_slices
from .shared import unused, written

WORDS = 13
#: Words in an anchor. Shorter ones are shared by chance, longer ones make more segments.
ANCHOR = 4
#: Words that a shard holds, on average.
SHARD_WORDS = 2_000_000
#: An anchor with more different segments, added up over the batches that have it, has them cut into single windows,
#: dealt by the whole window and not by the anchor.
HOT_SEGMENTS = 20_000
#: Words of a searched segment, on average.
SEGMENT_WORDS = 18
#: Turns signed numbers into unsigned ones of the same order.
SIGN = np.uint64(1 << 63)
#: For the second half of a segment's hash.
OTHER = np.uint64(0xD6E8FEB86659FD93)


# -- segments -------------------------------------------------------------------------------------


def smallest_in(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def segments(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor of each run of windows with one anchor in one text's word hashes."""
    if len(hashes) < words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    anchors = smallest_in(sequences(hashes, ANCHOR), words - ANCHOR + 1)
    begin = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1])
    return begin, np.diff(begin, append=len(anchors)), anchors[begin]


def run_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """128-bit hashes (two columns) of the runs of words ``first`` to ``last``, which is not included."""
    up, down = Powers.to(len(hashes) + 1)
    out = []
    for words in (hashes, mixed(hashes ^ OTHER)):
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * up[: len(words)], out=sums[1:])
        out.append(mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)))
    return np.stack(out, axis=1)


ANCHORS = "key long, kind int, doc_id long, mark long, anchor long, n int, local array<long>"
#: Kinds of rows: an anchor of one document of a batch, or how many segments it has if several documents have it; a
#: document's segments that a smaller one of the batch has; the smallest document of a batch with a segment.
SINGLE, LOCAL, FIRST = 1, 2, 3


def _anchors(words: int):
    """Arrow function: doc_id and text to the segments of a batch, so that what is hot is a row or so for each batch.

    (anchor, SINGLE, doc_id, hash, anchor) for each segment whose anchor one document of the batch has, or
    (anchor, SINGLE, null, null, anchor, n) if several do. Of the latter anchors' segments, those that a smaller
    document of the batch has are in the list of (doc_id, LOCAL, doc_id), and the smallest document's are
    (hash, FIRST, doc_id, second half of the hash, anchor).
    """
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
    schema = pa.schema(list(zip([c.split()[0] for c in ANCHORS.split(", ")], types, strict=True)))

    def batch_of(which: int, size: int, **columns) -> pa.RecordBatch:
        columns["kind"] = pa.array(np.full(size, which, np.int32))
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)

    signed = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column(0).to_numpy(zero_copy_only=False), [np.zeros((0, 4), np.uint64)]
            for part in word_slices(batch.column(1)):
                bounds = part.bounds.tolist()
                for i, (begin, end) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    hashes = part.hashes[begin:end]
                    first, windows, anchors = segments(hashes, words)
                    if len(first):
                        # ids in the order of unsigned numbers, for the sort below
                        owner = np.full(len(first), np.int64(ids[part.first + i]).view(np.uint64) ^ SIGN)
                        found.append(np.column_stack([anchors, owner, run_hashes(hashes, first, first + windows + words - 1)]))
            rows = np.concatenate(found)
            rows = rows[np.lexsort((rows[:, 1], rows[:, 3], rows[:, 2], rows[:, 0]))]  # by anchor, hash, document
            again = np.zeros(len(rows), dtype=bool)
            again[1:] = (rows[1:] == rows[:-1]).all(axis=1)
            rows = rows[~again]
            anchor, owner = rows[:, 0], rows[:, 1] ^ SIGN
            _, at, which = np.unique(anchor, return_index=True, return_inverse=True)
            if not len(at):
                continue
            several = (np.minimum.reduceat(rows[:, 1], at) < np.maximum.reduceat(rows[:, 1], at))[which]
            first = np.ones(len(rows), dtype=bool)
            first[1:] = (rows[1:, [0, 2, 3]] != rows[:-1, [0, 2, 3]]).any(axis=1)
            one, rep, rest = ~several, several & first, several & ~first
            yield batch_of(SINGLE, int(one.sum()), key=signed(anchor[one]), doc_id=signed(owner[one]), mark=signed(rows[one, 2]), anchor=signed(anchor[one]))
            yield batch_of(FIRST, int(rep.sum()), key=signed(rows[rep, 2]), doc_id=signed(owner[rep]), mark=signed(rows[rep, 3]), anchor=signed(anchor[rep]))
            names, n = np.unique(anchor[rep], return_counts=True)
            yield batch_of(SINGLE, len(names), key=signed(names), anchor=signed(names), n=pa.array(n.astype(np.int32)))
            order = np.argsort(owner[rest], kind="stable")
            docs, starts = np.unique(owner[rest][order], return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)), pa.int32()), signed(rows[rest, 2][order]))
            yield batch_of(LOCAL, len(docs), key=signed(docs), doc_id=signed(docs), local=lists)

    return run


PARTS = "deal long, doc_id long, address long, first int, windows int, content binary"


def _cut(words: int, shards: int):
    """Arrow function: (doc_id, address, text, whole, searched, hot) to a document's segments by their hashes.

    Those that are repeated as a whole have no content, and are dealt (below zero) by document. Those that are searched are dealt
    by anchor; with a hot anchor as single windows, dealt by window.
    """
    names = [c.split()[0] for c in PARTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), [batch.column(k) for k in (3, 4, 5)]
            for part in word_slices(batch.column(2)):
                rows: list[list] = [[] for _ in range(5)]
                for i, (begin, end) in enumerate(zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist(), strict=True)):
                    at, hashes = part.first + i, part.hashes[begin:end]
                    if not lists[0][at].is_valid:
                        continue
                    whole, searched, hot = (np.asarray(c[at].values, dtype=np.int64).view(np.uint64) for c in lists)
                    first, windows, anchors = segments(hashes, words)
                    marks = run_hashes(hashes, first, first + windows + words - 1)[:, 0]
                    repeated = np.isin(marks, whole)
                    wanted = np.isin(marks, searched) & ~repeated
                    single = np.isin(anchors, hot) & wanted
                    times = np.where(single, windows, (repeated | wanted).astype(np.int64))
                    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    single = np.repeat(single, times)
                    first, windows = np.repeat(first, times) + step, np.where(single, 1, np.repeat(windows, times))
                    deal = np.repeat(anchors, times)
                    if single.any():
                        deal[single] = run_hashes(hashes, first[single], first[single] + words)[:, 0]
                    deal = np.where(np.repeat(repeated, times), -1 - at % shards, (deal % np.uint64(shards)).astype(np.int64))
                    starts, ends = part.start[begin + first].tolist(), part.end[begin + first + windows + words - 2].tolist()
                    body = [part.data[a:b].tobytes() if d >= 0 else None for a, b, d in zip(starts, ends, deal.tolist(), strict=True)]
                    for column, values in zip(rows, (np.full(len(first), at), first, windows, deal, body), strict=True):
                        column.extend(values)
                if rows[0]:
                    at, first, windows, deal, body = rows
                    at = pa.array(at, pa.int64())
                    columns = [pa.array(deal, pa.int64()), ids.take(at), batch.column(1).take(at), pa.array(first, pa.int32()), pa.array(windows, pa.int32()), pa.array(body, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _searched(words: int):
    """Arrow function: the segments of a shard to the intervals of words in windows that a smaller document holds."""

    def run(shard: pa.Table) -> pa.Table:
        ids, first, windows = (shard[c].to_numpy() for c in ("doc_id", "first", "windows"))
        at, begin, end = np.arange(len(ids)), first, first + windows  # of windows
        if shard["deal"][0].as_py() >= 0:
            holders, bounds, _ = first_holders(shard["content"].to_pylist(), ids, words)
            owner = np.repeat(np.arange(len(ids)), np.diff(bounds))
            repeated = holders < ids[owner]
            # runs of repeated windows of one segment
            edge = np.flatnonzero(np.diff(repeated.astype(np.int8), prepend=0) != 0)
            cuts = np.unique(np.concatenate([edge, bounds]))
            at, length = owner[cuts[:-1]], np.diff(cuts)
            begin = first[at] + cuts[:-1] - bounds[at]
            end, kept = begin + length, repeated[cuts[:-1]]
            at, begin, end = at[kept], begin[kept], end[kept]
        rows = pa.array(at)
        spans = [pa.array(begin.astype(np.int32)), pa.array((end + words - 1).astype(np.int32))]
        return pa.table([shard["doc_id"].take(rows), shard["address"].take(rows), *spans], names=["doc_id", "address", "begin", "end"])

    return run


# -- the index ------------------------------------------------------------------------------------


class Bits:
    """A packed bit string with the number of ones before every 64th bit: rank takes two reads."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks[:-1]), dtype=np.int64)]).astype(np.uint32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block].astype(np.int64) + np.bitwise_count(self.blocks[block] & mask)


class WaveletTree:
    """Symbols below ``size`` in a wavelet tree, level by level: rank of a symbol takes one bit rank per level."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.shifts = list(range(max(1, int(size - 1).bit_length()) - 1, -1, -1))
        self.levels, self.zeros = [], []
        for shift in self.shifts:
            bits = ((symbols >> shift) & 1).astype(np.uint8)
            self.levels.append(Bits(bits))
            self.zeros.append(len(bits) - int(bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        self.begin = np.searchsorted(self._order(symbols), self._order(np.arange(size)))

    def _order(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols with their bits reversed: the order of the last level."""
        out = np.zeros_like(symbols)
        for k, shift in enumerate(self.shifts):
            out |= ((symbols >> shift) & 1) << k
        return out

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        for shift, level, zeros in zip(self.shifts, self.levels, self.zeros, strict=True):
            ones = level.rank(at)
            at = np.where((symbols >> shift) & 1 == 1, zeros + ones, at - ones)
        return at - self.begin[symbols]


class FMIndex:
    """Backward search over a text of numbers, 0 being the end of a segment."""

    def __init__(self, text: np.ndarray, size: int, depth: int):
        # Suffixes are sorted by their first ``depth`` symbols: searches are not longer. Ranks double in length.
        rank, have = text.astype(np.int64), 1
        while have < depth:
            step = min(have, depth - have)
            after = np.zeros_like(rank)
            after[: len(rank) - step] = rank[step:] + 1
            _, rank = np.unique(rank * (int(after.max()) + 1) + after, return_inverse=True)
            have += step
        self.suffixes = np.argsort(rank, kind="stable")
        self.tree = WaveletTree(text[self.suffixes - 1], size)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of suffixes that begin with the symbol and go on as those of the given intervals."""
        base = self.smaller[symbols]
        return base + self.tree.rank(symbols, low), base + self.tree.rank(symbols, high)


def first_holders(contents: list[bytes], owners: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest owner of every window of every segment among all segments, where each segment's windows begin, and the
    matching statistics: of how many of a window's words, counted from its end, the shard has a second occurrence.

    The holder of a window without a second occurrence is its own segment's owner.
    """
    split = [c.split() for c in contents]  # of bytes: at the six ASCII blanks only
    numbers: dict[bytes, int] = {}
    lengths = np.array([len(s) for s in split])
    text = np.zeros(int(lengths.sum()) + len(split), dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    at = 0
    for s in split:
        text[at : at + len(s)] = [numbers.setdefault(w, len(numbers) + 1) for w in s]
        at += len(s) + 1
    index = FMIndex(text, len(numbers) + 1, words)
    names, ranks = np.unique(owners, return_inverse=True)
    owner = np.repeat(ranks.astype(np.int32), lengths + 1)[index.suffixes]  # of each suffix in their order, as a rank

    counts = lengths - words + 1
    bounds = np.concatenate([[0], np.cumsum(counts)])
    place = np.repeat(begin - bounds[:-1], counts) + np.arange(bounds[-1])  # of each window in the text
    found = np.repeat(owners, counts)
    low, high = index.smaller[text[place + words - 1]], index.smaller[text[place + words - 1] + 1]
    live, reach = np.arange(len(place)), np.zeros(len(place), dtype=np.int32)
    for k in range(words - 1, -1, -1):
        several = high - low > 1
        live, low, high = live[several], low[several], high[several]
        reach[live] = words - k
        if k:
            low, high = index.extend(text[place[live] + k - 1], low, high)
    if len(live):
        # intervals of whole windows are equal or apart, so each needs one minimum over the owners in suffix order
        starts, which = np.unique(low, return_inverse=True)
        ends = np.zeros(len(starts), dtype=np.int64)
        ends[which] = high
        edges = np.stack([starts, ends], axis=1).reshape(-1)
        smallest = np.minimum.reduceat(np.append(owner, np.iinfo(np.int32).max), edges)[::2]
        found[live] = np.minimum(found[live], names[smallest[which]])
    return found, bounds, reach


# -- the operator ---------------------------------------------------------------------------------


def _with(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents with what was found for their id, if anything; rows without an id are spread by their key and get nothing."""
    return docs.join(found.withColumnRenamed("doc_id", "of"), (F.col("key") == F.col("of")) & F.col("doc_id").isNotNull(), "left")


def repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, address, begin, end): of documents (doc_id, address, key, text) the intervals of words in windows that a
    smaller doc_id also holds; they may overlap. ``address`` tells rows of one id apart, ``key`` is the id where there is one.

    Rows with a null id hold none and lend none. A hot anchor or group of copies is never in one task: an anchor or a
    segment that several documents of a batch have is one row for the batch, and an anchor with very many different
    segments is dealt by whole windows.
    """
    rows = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(_anchors(words), ANCHORS)
    same, equal = Window.partitionBy("key", "kind"), Window.partitionBy("key", "kind", "mark")
    known = F.max(F.col("doc_id").isNull()).over(same) | (F.min("doc_id").over(same) < F.max("doc_id").over(same))
    smallest = F.when(F.col("kind") != LOCAL, F.min("doc_id").over(equal))
    hot = F.col("n").isNotNull() & (F.sum("n").over(same) > HOT_SEGMENTS)
    # by anchor first: that partitioning serves both windows
    told = rows.select("*", known.alias("known"), hot.alias("hot")).withColumn("smallest", smallest)
    told = told.where((F.col("kind") != SINGLE) | F.col("known") & (F.col("doc_id").isNotNull() | F.col("hot")))
    mark = F.when(F.col("kind") == FIRST, F.col("key")).otherwise(F.col("mark"))
    whole = F.coalesce(F.col("doc_id") > F.col("smallest"), F.lit(True))
    told = written(told.select("doc_id", whole.alias("whole"), mark.alias("mark"), F.when(~whole | F.col("hot"), F.col("anchor")).alias("anchor"), "local"), "segments")
    shards = max(1, -(-told.where("not whole").count() * SEGMENT_WORDS // SHARD_WORDS))

    # a table of its own, whose size Spark knows: it is broadcast only if that is small
    very = written(told.where("doc_id is null").select(F.col("anchor").alias("hot")).distinct(), "hot-anchors")
    own = told.where("doc_id is not null").join(very, F.col("anchor") == F.col("hot"), "left")
    mine = own.groupBy("doc_id").agg(
        F.concat(F.collect_list(F.when(F.col("whole"), F.col("mark"))), F.flatten(F.collect_list("local"))).alias("whole"),
        F.collect_list(F.when(~F.col("whole"), F.col("mark"))).alias("searched"), F.collect_set("hot").alias("hot"),
    )
    # a left join, as the one that needs the texts again: both then read one shuffle of them
    wanted = _with(docs, mine).select("doc_id", "address", "text", "whole", "searched", "hot")
    parts = wanted.mapInArrow(_cut(words, shards), PARTS)
    return parts.groupBy("deal").applyInArrow(_searched(words), "doc_id long, address long, begin int, end int")


def remove_repeats(docs: DataFrame, words: int = WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed and kept: the text without words in windows that a smaller doc_id also holds.

    New columns get other names where they clash. Windows are judged on the input. ``kept`` has the words that stay,
    joined by one blank; a null, empty or blank text has none. Texts shorter than a window, rows with a null id, and repeats within one document
    stay whole. Rows of one id are one document: they never repeat each other. An empty table stays empty. A window has
    at least as many words as an anchor; fewer raise an error.
    """
    if words < ANCHOR:
        raise ValueError(f"windows have at least {ANCHOR} words, not {words}")
    n_words, n_removed, kept = unused(docs.columns, "n_words", "n_removed", "kept")
    ident, body = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    address = F.xxhash64(F.coalesce(body, F.lit("")))
    own = {doc_id: "doc_id"} if docs.schema[doc_id].dataType == LongType() else {}  # needs no second column
    own[text] = "text"
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    row = [F.struct(*rest).alias("row")] if rest else []
    source = docs.select(ident.alias("doc_id"), address.alias("address"), F.coalesce(ident, address).alias("key"), body.alias("text"), *row)
    spans = repeats(source.select("doc_id", "address", "key", "text"), words)
    both = _with(source, spans.groupBy("doc_id").agg(F.collect_list(F.struct("address", "begin", "end")).alias("spans")))

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def without(texts: pd.Series, addresses: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for t, address, found in zip(texts, addresses, spans, strict=True):
            split = (t or "").encode().split()  # of bytes: at the six ASCII blanks only
            n = len(split)
            mine = [] if found is None else [(s["begin"], s["end"]) for s in found if s["address"] == address]
            if mine:
                edges = np.zeros(n + 1, dtype=np.int64)
                begins, ends = np.array(mine).T
                np.add.at(edges, begins, 1)
                np.subtract.at(edges, ends, 1)
                split = [split[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
            rows.append((n, n - len(split), b" ".join(split).decode()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    done = both.select("doc_id", "text", *["row" for _ in row], without("text", "address", "spans").alias("done"))
    columns = [(F.col(own[c]) if c in own else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    return done.select(*columns, *[F.col(f"done.{k}").alias(v) for k, v in (("n_words", n_words), ("n_removed", n_removed), ("kept", kept))])

"""Near duplicates by MinHash: one-permutation hashing with optimal densification, banded buckets, star-shaped edges.

A document is its set of word shingles, as 64-bit hashes. Equal sets are one class from the start, so thousands of exact
copies are one row afterwards. The top bits of a hash are its bin and each bin keeps its smallest hash; an empty bin
takes the value of the first full bin in a random order that is the same for all documents. Bins in bands give bucket
keys. In a bucket only edges between a centre and the other members are candidates, and an edge is a link if the full sets
are similar enough. That leaves members which are not like their centre. Each is compared with those of the bucket in
other components, unless their sketches differ too much or counts show that they cannot be similar enough: two sets
share no more than the smaller part inside the centre and the smaller part outside, and in each cell of the hashes no
more than the smaller count. So no link between members of a bucket is lost, and a large group around its centre does
not become all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import BASE, mixed, sequences, word_slices
from .shared import written

BINS = 256
#: Bins in a band. Sets of similarity 0.8 share a band with probability 0.26, and miss all 42 with 3 in a million.
ROWS = 6
BANDS = BINS // ROWS
#: Standard deviations by which an estimate from sketches may fall short of the threshold.
DOUBT = 6.0
#: Largest count of a cell.
CELL_MOST = 32_000


def shingle_sets(texts: pa.Array, width: int, lower: bool) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: of ``width`` words, or of all words if there are fewer."""
    for words in word_slices(texts, lower):
        grams = sequences(words.hashes, width)
        bounds = words.bounds.tolist()
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            if end - begin >= width:
                found = np.sort(grams[begin : end - width + 1])
                new = np.ones(len(found), dtype=bool)
                np.not_equal(found[1:], found[:-1], out=new[1:])
                yield found[new]
            elif end > begin:
                yield mixed(sequences(words.hashes[begin:end], end - begin) + np.uint64(end - begin))
            else:
                yield np.zeros(0, dtype=np.uint64)


def one_permutation(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest hash of every bin of each non-empty set, empty bins filled by optimal densification."""
    firsts = np.arange(BINS, dtype=np.uint64) << np.uint64(56)
    values = np.zeros((len(sets), BINS), dtype=np.uint64)
    full = np.zeros((len(sets), BINS), dtype=bool)
    for i, hashes in enumerate(sets):
        at = np.searchsorted(hashes, firsts)
        full[i] = np.diff(at, append=len(hashes)) > 0
        values[i] = hashes[np.minimum(at, len(hashes) - 1)]
    docs, bins = np.nonzero(~full)
    attempt = 0
    while len(docs):
        attempt += 1
        order = mixed(bins.astype(np.uint64) + np.uint64(attempt * int(BASE) % (1 << 64)))
        source = (order >> np.uint64(32)).astype(np.int64) % BINS
        hit = full[docs, source]
        values[docs[hit], bins[hit]] = values[docs[hit], source[hit]]
        docs, bins = docs[~hit], bins[~hit]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    """One bucket key for each band of each document; the band's number is part of the key."""
    keys = np.zeros((len(values), BANDS), dtype=np.uint64)
    for r in range(ROWS):
        keys = keys * BASE + values[:, r : BANDS * ROWS : ROWS]
    return mixed(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def one_bit(values: np.ndarray) -> np.ndarray:
    """One bit of every bin, packed: bins that agree have it equal, others in half of the cases."""
    return np.packbits((values & np.uint64(1)).astype(np.uint8), axis=1).view(np.uint64)


def cells(sets: list[np.ndarray]) -> np.ndarray:
    """How many hashes of each set have each value of some bits that bins do not use."""
    out = np.zeros((len(sets), BINS), dtype=np.int16)
    for i, hashes in enumerate(sets):
        out[i] = np.minimum(np.bincount((hashes & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), CELL_MOST)
    return out


def _lists(values: np.ndarray, at: np.ndarray, n: int) -> pa.ListArray:
    """``n`` lists: row i of ``values`` at place ``at[i]``, the others empty."""
    counts = np.zeros(n + 1, dtype=np.int32)
    counts[at + 1] = values.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.cumsum(counts, dtype=np.int32)), pa.array(values.reshape(-1)))


def _sketched(width: int, lower: bool):
    """Arrow function: doc_id and text to doc_id, n, a 128-bit address of the set, and the bands of sets that need any."""
    # only an equal set is similar enough to one of under four shingles, if the threshold is over 3 / 4
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("bands", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64())), ("cells", pa.list_(pa.int16()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, start = batch.column(0), 0
            for part in _parts(shingle_sets(batch.column(1), width, lower)):
                n = np.array([len(s) for s in part], dtype=np.int64)
                a = np.array([np.bitwise_xor.reduce(mixed(s)) for s in part], dtype=np.uint64)
                b = np.array([mixed(s ^ BASE).sum(dtype=np.uint64) for s in part], dtype=np.uint64)
                large = np.flatnonzero(n >= 4)
                values = one_permutation([part[i] for i in large])
                filled = cells([part[i] for i in large])
                lists = [_lists(x, large, len(part)) for x in (band_keys(values).view(np.int64), one_bit(values).view(np.int64), filled)]
                columns = [ids.slice(start, len(part)), pa.array(n), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *lists]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                start += len(part)

    return run


def _parts(sets: Iterator[np.ndarray], most: int = 500, numbers: int = 500_000) -> Iterator[list[np.ndarray]]:
    """Sets in lists of bounded size."""
    part, held = [], 0
    for s in sets:
        part.append(s)
        held += len(s)
        if len(part) >= most or held >= numbers:
            yield part
            part, held = [], 0
    if part:
        yield part


def _with_sets(width: int, lower: bool):
    """Arrow function: doc_id and text to doc_id and the set's sorted hashes as bytes."""
    schema = pa.schema([("node", pa.int64()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for part in _parts(shingle_sets(batch.column(1), width, lower)):
                columns = [batch.column(0).slice(start, len(part)), pa.array([s.tobytes() for s in part], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                start += len(part)

    return run


PAIRS = "a long, b long, na long, nb long, common long"


def _in_common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, na, nb and the bytes of two sets to the size of the intersection, read in place from Arrow's buffers."""
    for batch in batches:
        out = np.zeros(batch.num_rows, dtype=np.int64)
        for i in range(batch.num_rows):
            x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint64) for k in (4, 5))
            at = np.searchsorted(x, y)
            out[i] = (x[np.minimum(at, len(x) - 1)] == y).sum()
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out)], names=["a", "b", "na", "nb", "common"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the ends of ``links`` (a, b): the component is its smallest node.

    Each round takes the smallest label among neighbours and then the label of that label, so paths shorten by
    doubling; labels are written between rounds. Hubs are combined per task, and joins split them.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        closer = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = closer.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = closer.join(jump, "label").select("node", "old", F.least("label", "next").alias("label"))
        after = written(after, "labels")
        labels = after.select("node", "label")
        if after.where("label != old").isEmpty():
            return labels.withColumnRenamed("label", "component")


def duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, lower: bool = True, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their shingle sets (``percent`` over 75).
    ``component_id`` is the smallest doc_id that links reach; ``kept`` marks the documents that are their own.
    A text without words (null, empty, blank) has no shingles and is linked with nothing. Rows of one doc_id are
    one document, with the links of all of them; of exactly equal rows all are returned. A row with a null id
    belongs to the component of the rows with its set, if any has an id (else null), links none and is not kept.
    Of rows of one id, a blank one counts by itself.
    An empty table stays empty. Bands find all links above 75 percent only, so a lower ``percent`` is an error.
    """
    if not 75 < percent <= 100:
        raise ValueError(f"percent is above 75 and at most 100, not {percent}")
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = "doc_id long, n long, set_a long, set_b long, bands array<long>, bits array<long>, cells array<short>"
    sketches = written(source.mapInArrow(_sketched(width, lower), schema), "sketches")
    classes = sketches.where("n > 0").groupBy("set_a", "set_b", "n").agg(F.min("doc_id").alias("node"), F.any_value("bands").alias("bands"), F.any_value("bits").alias("bits"), F.any_value("cells").alias("cells"))
    nodes = written(classes.where("node is not null"), "classes")
    keyed = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("node", "n")).alias("centre"))
    members = written(keyed.join(shared.where("members > 1").drop("members"), "key"), "buckets")
    own = sketches.join(nodes.drop("bands", "bits", "cells"), ["set_a", "set_b", "n"], "left").select("doc_id", "n", "node")
    # rows of one id are one document, whichever sets they have
    several = own.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("doc_id is not null and a < z")
    same = own.join(several.drop("z"), "doc_id").where("node != a").select("a", F.col("node").alias("b")).distinct()
    found = components(_linked(source, members, nodes.select("node", "bits", "cells"), same, width, percent, lower))
    component = F.coalesce("component", "node", F.when(F.col("n") == 0, F.col("doc_id")))
    return own.join(found, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def _linked(source: DataFrame, members: DataFrame, sketches: DataFrame, links: DataFrame, width: int, percent: int, lower: bool) -> DataFrame:
    """``links`` and links (a, b) between members of a bucket, all but some within components."""
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    texts = source.join(nodes, "doc_id", "left_semi").select("doc_id", "text")
    sets = written(texts.mapInArrow(_with_sets(width, lower), "node long, hashes binary"), "sets")

    def compared(pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b, na, nb) with the size of their intersection."""
        right = pairs.distinct().join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("right")), "b")
        both = right.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("left")), "a")
        return both.select("a", "b", "na", "nb", "left", "right").mapInArrow(_in_common, PAIRS)

    def near(m, n):
        return 100 * F.least(m, n) >= percent * F.greatest(m, n)

    alike = (100 + percent) * F.col("common") >= percent * (F.col("na") + F.col("nb"))
    star = members.where("node != centre.node").select(F.col("centre.node").alias("a"), F.col("node").alias("b"), F.col("centre.n").alias("na"), F.col("n").alias("nb"))
    star = written(compared(star.where(near("na", "nb"))), "star-edges")
    links = written(links.unionByName(star.where(alike).select("a", "b").distinct()), "links")

    # members of buckets that are not yet in one component, with what they have inside and outside the centre at most
    inside = star.select(F.col("a").alias("c"), F.col("b").alias("node"), F.col("nb").alias("n"), "common")
    placed = members.select("key", "node", "n", F.col("centre.node").alias("c"), F.col("centre.n").alias("nc"))
    placed = placed.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    placed = placed.join(split, "key", "left_semi").join(inside, ["c", "node", "n"], "left")
    common = F.when(F.col("c") == F.col("node"), F.col("n")).otherwise(F.col("common"))
    placed = placed.withColumn("inside", F.coalesce(common, F.least("n", "nc"))).withColumn("outside", F.coalesce(F.col("n") - common, F.col("n")))
    placed = placed.join(sketches, "node")
    of_centre = placed.where("node = c").select("key", F.col("component").alias("main")).distinct()
    side = written(placed.join(of_centre, "key").select("key", "node", "n", "component", "main", "inside", "outside", "bits", "cells"), "open-buckets")

    x, y = (side.select("key", F.struct(*side.columns[1:]).alias(k)) for k in "xy")
    n = lambda k: F.col(f"{k}.n")
    apart = (F.col("x.component") != F.col("y.component")) & ((F.col("y.component") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
    bound = F.least("x.inside", "y.inside") + F.least("x.outside", "y.outside")
    differ = sum((F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(BINS // 64)), F.lit(0))
    # a share j of equal bins makes (1 + j) / 2 equal bits; sets smaller than the bins have that many values only
    deviation = F.sqrt(percent * (100 - percent) / 1e4 / F.least(n("x"), n("y"), F.lit(BINS)) + (100 - percent) / 100 / BINS)
    seem = 1 - differ * (2 / BINS) >= percent / 100 - DOUBT * deviation
    # two sets share no more of a cell than the one with less has there; a cell too full to count has no bound
    least = F.zip_with("x.cells", "y.cells", lambda p, q: F.when(F.least(p, q) < CELL_MOST, F.least(p, q).cast("long")).otherwise(F.lit(1 << 40)))
    by_cell = F.aggregate(least, F.lit(0).cast("long"), lambda acc, k: acc + k)
    enough = lambda common: (100 + percent) * common >= percent * (n("x") + n("y"))
    possible = near(n("x"), n("y")) & enough(bound) & seem & enough(by_cell)
    rest = x.where("x.component != x.main").join(y, "key").where(apart & possible)
    ends = F.sort_array(F.array(F.struct("x.node", "x.n"), F.struct("y.node", "y.n")))
    rest = rest.select(ends[0]["node"].alias("a"), ends[1]["node"].alias("b"), ends[0]["n"].alias("na"), ends[1]["n"].alias("nb"))
    return links.unionByName(compared(rest).where(alike).select("a", "b"))

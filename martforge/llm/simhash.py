"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint has 64 bits, each the majority of that bit over the hashes of a
text's word shingles. Two fingerprints within RADIUS bits agree on at least two of
five bit blocks, so fingerprints are bucketed by every pair of blocks (ten keys
each); only buckets with two or more distinct fingerprints go on.

Inside a bucket fingerprints lie vertically: plane b holds bit b of 64 fingerprints
in one word. Comparing a fingerprint with 64 others is one XOR per plane, added up
by carry-save counters whose overflow marks lanes beyond the radius; words whose
lanes have all overflowed are abandoned.

Buckets larger than ``CHUNK`` are cut into chunks, and every pair of chunks is a
group of its own, so no task holds a large bucket and no pair is skipped. A group
emits a star per cluster, not all its pairs; components of those stars are the
classes.

Defined cases: null and empty texts have fingerprint 0 and are linked like any other
text; repeated rows share a class; null ids are kept and are the smallest of a class
only if it has no other id (then null); other columns are not read, and pass through
``keep_one`` untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from martforge.llm.common import small_batches, staged
from martforge.llm.components import connected_components

SHINGLE = 3
RADIUS = 3
SEED = 42
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit, bits
CHUNK = 4096
ROWS = 1 << 17  # rows gathered before complete groups are compared
LANES = 64
EVERY = 8  # planes between two looks for words to abandon


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    norm, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    n, ones = len(words) - k + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        h = np.fromiter((digest(norm[a:b], SEED) for a, b in zip(starts[lo:hi], ends[lo + k - 1:hi + k - 1], strict=True)),
                        np.uint64, hi - lo)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(text: pa.Array) -> pa.Array:
    found = np.fromiter((fingerprint(t.as_py()) for t in text), np.uint64, len(text))
    return pa.array(found.view(np.int64))


def fingerprint_column(text: str = "text") -> Column:
    return F.arrow_udf(_fingerprints, LongType())(F.col(text))


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """(64, words): bit j of word w of plane b is bit b of fingerprint 64 * w + j."""
    n = len(prints)
    bits = np.zeros((-(-n // LANES) * LANES, 64), np.uint8)
    bits[:n] = np.unpackbits(prints.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits, axis=0, bitorder="little").T).view(np.uint64)


def _lanes_from(first: np.ndarray) -> np.ndarray:
    """Words whose lanes ``first`` and above are set (first from 0 to 64)."""
    shift = np.minimum(first, 63).astype(np.uint64)
    return np.where(first >= LANES, np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF) << shift)


def near_lanes(prints: np.ndarray, planes: np.ndarray, row: np.ndarray, word: np.ndarray,
               valid: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The (row, word, lanes) whose lanes lie within ``radius`` bits of the row."""
    places = max(1, radius.bit_length())
    spare = (1 << places) - 1 - radius  # counters start so that radius + 1 overflows
    counter = [np.full(len(row), np.uint64(0xFFFFFFFFFFFFFFFF) if spare >> p & 1 else np.uint64(0)) for p in range(places)]
    far = ~valid
    for b in range(64):
        own = np.uint64(0) - ((prints[row] >> np.uint64(b)) & np.uint64(1))
        carry = planes[b][word] ^ own
        for p in range(places):
            counter[p], carry = counter[p] ^ carry, counter[p] & carry
        far |= carry
        if b % EVERY == EVERY - 1:
            alive = far != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not alive.all():
                row, word, far = row[alive], word[alive], far[alive]
                counter = [c[alive] for c in counter]
            if not len(row):
                break
    return row, word, ~far


def close_pairs(group: np.ndarray, prints: np.ndarray, radius: int = RADIUS,
                block: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (i, j), i < j, of one group (rows sorted by group) within ``radius`` bits."""
    n = len(prints)
    last = np.concatenate([np.flatnonzero(group[1:] != group[:-1]) + 1, [n]])
    end = last[np.searchsorted(last, np.arange(n), side="right")]
    planes = bit_planes(prints)
    for lo in range(0, n, block):
        rows = np.arange(lo, min(n, lo + block))
        rows = rows[end[rows] > rows + 1]
        step = 0
        while len(rows):
            word = rows // LANES + step
            valid = _lanes_from(np.maximum(rows + 1 - word * LANES, 0)) & ~_lanes_from(
                np.minimum(end[rows] - word * LANES, LANES))
            r, w, lanes = near_lanes(prints, planes, rows, word, valid, radius)
            if len(r):
                hit = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                at, lane = np.nonzero(hit)
                yield r[at], w[at] * LANES + lane
            step += 1
            rows = rows[(rows // LANES + step) * LANES < end[rows]]


def clusters(group: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each row the first row of its cluster of linked rows."""
    root = np.arange(len(prints))
    for i, j in close_pairs(group, prints, radius):
        while True:
            a, b = root[i], root[j]
            low, high = np.minimum(a, b), np.maximum(a, b)
            apart = low != high
            if not apart.any():
                break
            np.minimum.at(root, high[apart], low[apart])
            while not np.array_equal(root, up := root[root]):
                root = up
    return root


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Star edges of all groups of a partition sorted by group; a group may span batches."""
    def out(group: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        root = clusters(group, prints)
        linked = root != np.arange(len(root))
        signed = prints.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[root[linked]])], ["u", "v"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append((batch.column("grp").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)))
        rows += batch.num_rows
        if rows >= ROWS:
            group, prints = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(group, group[-1]))  # the last group may go on
            if cut:
                yield out(group[:cut], prints[:cut])
            held, rows = [(group[cut:], prints[cut:])], len(group) - cut
    if rows:
        yield out(*(np.concatenate(x) for x in zip(*held, strict=True)))


def block_masks() -> list[int]:
    """Masks of every pair of blocks, as signed numbers."""
    bits = [((1 << n) - 1) << first for first, n in BLOCKS]
    keep = len(BLOCKS) - RADIUS
    return [m - (1 << 64) if m >> 63 else m for m in (sum(c) for c in combinations(bits, keep))]


def star_links(prints: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints (column fp, distinct) that
    chains of links within RADIUS connect."""
    keys = F.array(*[F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(m))) for t, m in enumerate(block_masks())])
    buckets = prints.select("fp", F.explode(keys).alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    rows = (buckets.join(shared, "bucket").withColumn("chunks", chunks).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("grp"), "fp"))
    return (rows.repartition("grp").sortWithinPartitions("grp", "fp")
            .mapInArrow(_stars, "u long, v long"))


def classes(rows: DataFrame) -> DataFrame:
    """fp, component_id and first_row (one row of the class: lowest doc_id, then
    row_id) for each fingerprint of ``rows`` (written already: row_id, doc_id, fp)."""
    spark = rows.sparkSession
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row_id"))
    prints = staged(spark, rows.groupBy("fp").agg(F.min(first).alias("first")), "simhash-prints")
    roots = connected_components(star_links(prints.select("fp")))
    named = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    per_root = named.groupBy("root").agg(F.min("first").alias("low"))
    return named.select("fp", "root").join(per_root, "root").select(
        "fp", F.col("low.doc_id").alias("component_id"), F.col("low.row_id").alias("first_row"))


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    rows = staged(docs.sparkSession, docs.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", fingerprint_column().alias("fp")), "simhash-rows")
    return rows.join(classes(rows), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with one document of each class."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    small_batches(docs.sparkSession)
    rows = staged(docs.sparkSession, docs.select(
        F.struct(*cols).alias("row"), F.monotonically_increasing_id().alias("row_id"), F.col("doc_id"),
        fingerprint_column().alias("fp")), "simhash-docs")
    first = classes(rows.select("row_id", "doc_id", "fp")).select(F.col("first_row").alias("row_id")).distinct()
    return rows.join(first, "row_id", "left_semi").select("row.*")

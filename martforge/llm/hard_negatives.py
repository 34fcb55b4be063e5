"""Mining hard negatives by exact integer scores from Kronecker-packed products.

Components become whole numbers. The anchors (the rows whose id is divisible by
``every``) meet all rows, block by block: rows are dealt over cells of about CELL by a
hash of the row, anchors over blocks of about ANCHORS, and a task gets one cell and one
block at a time.

Scores of a block: components are biased to be at least 0, and the same component of
several rows goes into separated fields of one wide number, as many as 53 bits hold (a double's
whole numbers, so that the products of all anchors run in BLAS). Each anchor component is
multiplied with the wide number once; a field of the sum is wide enough for the largest possible score, so fields never
touch, and shifts and masks give every row's score exactly. Vectors too large for this are
scored in Python's whole numbers.

Two passes: the best ``positives`` rows of the anchor's label, a few from each cell, ranked
over all cells; then, for each anchor and positive, the best ``negatives`` rows of other labels with a score of
50 to 95 percent of the positive's, a few from each cell, ranked over all cells.

Defined cases: rows with a null label or vector, or with a null, non-finite or (256 times)
over 2 ** 52 component take no part, nor do vectors of another length than the most frequent one
(ties: the longer); a null id is no anchor and comes after all others in ties; repeated
rows are rows of their own, so a copy of an anchor is a positive of it, and a repeated
anchor returns its rows again; other columns are not read; an empty table gives no rows;
scores beyond 2 ** 56 are held there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import small_batches, staged
from martforge.llm.vectors import of_common_length, scaled, usable

SCALE = 256
EVERY, POSITIVES, NEGATIVES = 50, 5, 3
LEAST, MOST = 50, 95  # percent of the positive's score
CELL, ANCHORS, GROUP = 1 << 15, 1 << 10, 64  # rows of a cell, anchors of a block, blocks that meet a cell in one task
TILE = 2048  # rows whose scores with a block are held at once
BITS = 53
NONE, TOP = np.iinfo(np.int64).min, 1 << 56


def prepared(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """row_id, vec_id, label and x of the rows that take part."""
    v, label = F.col(column), F.col("label")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return (vectors.filter(label.isNotNull() & usable(v, SCALE))
            .select(F.monotonically_increasing_id().alias("row_id"), F.col("vec_id").cast("long").alias("vec_id"),
                    shifted.cast("long").alias("label"), scaled(v, SCALE).alias("x")))


def packed_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(anchors, rows): exact inner products."""
    if not len(anchors) or not len(rows):
        return np.zeros((len(anchors), len(rows)), np.int64)
    low_a, low_x = int(anchors.min()), int(rows.min())
    dims, high_a, high_x = anchors.shape[1], int(anchors.max()) - low_a, int(rows.max()) - low_x
    width = max(1, (dims * high_a * high_x).bit_length())
    if width > BITS:
        return _wide_scores(anchors, rows)
    fields = min(BITS // width, len(rows))
    a, x = (anchors - low_a).astype(np.float64), rows - low_x
    size = -(-len(rows) // fields)
    wide = np.zeros((size, dims))
    for f in range(fields):
        part = x[f * size:(f + 1) * size]
        wide[:len(part)] += part * 2.0 ** (width * f)
    product = (a @ wide.T).astype(np.int64)
    found = np.empty((len(anchors), fields * size), np.int64)
    for f in range(fields):
        found[:, f * size:(f + 1) * size] = product >> width * f & (1 << width) - 1
    found = found[:, :len(rows)]
    found += (low_x * a.sum(axis=1).astype(np.int64))[:, None]
    found += low_a * x.sum(axis=1) + dims * low_a * low_x
    return found


def _wide_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The same where some vectors are too large: those apart, in Python's whole numbers."""
    bound = 1 << (BITS - 3 - anchors.shape[1].bit_length()) // 2
    large_a, large_x = (np.abs(v).max(axis=1) >= bound for v in (anchors, rows))
    found = np.empty((len(anchors), len(rows)), np.int64)
    found[np.ix_(~large_a, ~large_x)] = packed_scores(anchors[~large_a], rows[~large_x])
    for a, x in ((large_a, np.full(len(rows), True)), (~large_a, large_x)):
        exact = anchors[a].astype(object) @ rows[x].astype(object).T
        found[np.ix_(a, x)] = np.clip(exact, -TOP, TOP).astype(np.int64) if exact.size else 0
    return found


def best(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest of each row, and their places, the first of equals first; NONE where there are fewer. Changes ``values``."""
    line = np.arange(len(values))
    score, at = np.full((len(values), k), NONE), np.zeros((len(values), k), np.int64)
    for i in range(min(k, values.shape[1])):
        at[:, i] = values.argmax(axis=1)
        score[:, i] = values[line, at[:, i]]
        values[line, at[:, i]] = NONE
    return score, at


class _Rows:
    """The rows of a list column, in order of id."""

    def __init__(self, rows: pa.Array):
        field = dict(zip((f.name for f in rows.type), rows.flatten(), strict=True))
        self.row_id = field["row_id"].to_numpy(zero_copy_only=False)
        self.ids, self.label = field["vec_id"], field["label"].to_numpy(zero_copy_only=False)
        self.x = field["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(self.label), -1)
        self.most = [field[n] for n in ("pos",) if n in field]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Rows, _Rows]]:
    """The block of anchors and the cell of each row."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Rows(batch.column("anchors")[i].values), _Rows(batch.column("rows")[i].values)


def _merged(score: list[np.ndarray], at: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k of the tiles' best."""
    score, at = np.concatenate(score, axis=1), np.concatenate(at, axis=1)
    top, place = best(score, k)
    return top, np.take_along_axis(at, place, axis=1)


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, rows in _pairs(batches):
            for label in np.unique(anchors.label):
                own, same = np.flatnonzero(anchors.label == label), np.flatnonzero(rows.label == label)
                tiles = []
                for lo in range(0, len(same), TILE):
                    at = same[lo:lo + TILE]
                    score = packed_scores(anchors.x[own], rows.x[at])
                    score[anchors.row_id[own][:, None] == rows.row_id[at]] = NONE
                    top, place = best(score, k)
                    tiles.append((top, at[place]))
                if tiles:
                    top, at = _merged(*map(list, zip(*tiles, strict=True)), k)
                    a, j = np.nonzero(top != NONE)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchors.row_id[own][a]), rows.ids.take(pa.array(at[a, j])), pa.array(top[a, j])],
                        ["anchor", "id", "score"])
    return run


def _negatives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, rows in _pairs(batches):
            pos = anchors.most[0]
            counts = pos.value_lengths().to_numpy(zero_copy_only=False)
            given = pos.flatten()  # struct rank, id, score
            rank, limit = (given.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("rank", "score"))
            owner = np.repeat(np.arange(len(counts)), counts)
            for r in np.unique(rank):
                mine, ps = owner[rank == r], limit[rank == r]
                low, high = -(-ps * LEAST // 100), ps * MOST // 100
                tiles = []
                for lo in range(0, len(rows.label), TILE):
                    score = packed_scores(anchors.x[mine], rows.x[lo:lo + TILE])
                    out = (score < low[:, None]) | (score > high[:, None])
                    score[out | (anchors.label[mine][:, None] == rows.label[lo:lo + TILE])] = NONE
                    top, place = best(score, k)
                    tiles.append((top, place + lo))
                top, at = _merged(*map(list, zip(*tiles, strict=True)), k)
                a, j = np.nonzero(top != NONE)
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchors.row_id[mine][a]), anchors.ids.take(pa.array(mine[a])), pa.array(np.full(len(a), r)),
                    given.field("id").filter(pa.array(rank == r)).take(pa.array(a)), pa.array(ps[a]),
                    rows.ids.take(pa.array(at[a, j])), pa.array(top[a, j])],
                    ["anchor", "anchor_id", "pos", "positive_id", "positive_score", "id", "score"])
    return run


def _in_order(*names: str):
    """Rows of a group by id, nulls last."""
    row = F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "row_id", "label", "x", *names)
    return F.sort_array(F.collect_list(row))


def _met(cells: DataFrame, n_cells: int, anchors: DataFrame, n_anchors: int, *names: str) -> DataFrame:
    """A row for each cell and block of anchors."""
    blocks = -(-n_anchors // ANCHORS)
    groups = -(-blocks // GROUP)
    block = F.pmod(F.xxhash64("row_id"), F.lit(blocks)).cast("int")
    blocked = (anchors.groupBy(block.alias("block")).agg(_in_order(*names).alias("anchors"))
               .withColumn("grp", F.expr(f"block div {GROUP}").cast("int"))
               .withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(n_cells - 1)))))
    dealt = cells.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    n = n_cells * groups
    return (dealt.repartition(n, "cell", "grp").join(blocked.repartition(n, "cell", "grp").hint("shuffle_merge"), ["cell", "grp"])
            .select("rows", "anchors"))


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best scores of each key, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, column: str = "embedding", every: int = EVERY, positives: int = POSITIVES,
         negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows, _ = of_common_length(staged(spark, prepared(vectors, column), "negatives-rows"), "x")
    is_anchor = F.col("vec_id") % every == 0
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("a")).first()
    if not count["a"]:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    n_cells = max(-(-count["n"] // CELL), min(16, -(-count["n"] // 256)))
    cells = staged(spark, rows.groupBy(F.pmod(F.xxhash64(F.lit(1), "row_id"), F.lit(n_cells)).cast("int").alias("cell"))
                   .agg(_in_order().alias("rows")), "negatives-cells")
    anchors = rows.filter(is_anchor)
    near = _met(cells, n_cells, anchors, count["a"]).mapInArrow(_positives(positives), "anchor long, id long, score long")
    chosen = (_first(near, ["anchor"], positives).groupBy(F.col("anchor").alias("row_id"))
              .agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("pos")))
    chosen = staged(spark, anchors.join(chosen, "row_id"), "negatives-anchors")
    found = _met(cells, n_cells, chosen, count["a"], "pos").mapInArrow(
        _negatives(negatives), "anchor long, anchor_id long, pos long, positive_id long, positive_score long, id long, score long")
    return _first(found, ["anchor", "pos"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))

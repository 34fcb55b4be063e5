"""Mixing sources to target weights by entropy balancing.

Each source has a token target. Documents get rates that stay as close as
possible (in relative entropy, bounded to [0, MOST] copies) to one copy each
while the expected tokens of every source meet its target. The convex dual has
one multiplier per source; at the solution the rates are exponentially tilted by
document size:

    rate = MOST / (1 + (MOST - 1) * exp(-lambda_source * size / mean_source))

Documents of one source and size share a rate, so the corpus is first counted into
(source, size) classes; Newton iterations (kept inside a bracket) run over that
table with all sources at once. The sums are exact decimals, so reruns agree to
the last bit whatever order tasks finish in.

Rates become whole copies class by class: cumulative rounding in order of size
keeps a source within one document of its target, then a greedy pass from large to
small sizes moves single copies until what is missing is below the smallest size.
Within a class the first documents by a hash of id and text take the odd copy. Nothing is
ranked for that but where the last of them stands: counts of hash cells name its cell, counts of
hashes in that cell its hash. Documents of one id and text (null ids too) share a hash; if the cut falls among them, the
odd copies go to any of them, ranked over cells. So neither a hot class nor a hot document is in one
task, and reruns take the same texts.

Defined cases: null text has size 0 and takes nothing; null source is a source of
its own, last in order; sources without words have target 0; repeated rows are
separate documents; an empty table gives an empty result. One row per source is
gathered in one place (to order the sources and share out the targets), never one
row per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.llm.common import WORD, rank_cells, staged, with_salted_rank

WEIGHTS = (1, 2, 3)
MOST = 3
TOLERANCE = 1e-7
MAX_STEPS = 60


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(classes: DataFrame) -> DataFrame:
    """sidx, source, source_size, n_docs, target: weights repeat along the sources in
    code point order; what lies above MOST times a source's size is shared again.

    All sources not at their limit have target = weight * level. In order of
    limit / weight the sources at their limit are a prefix, so the level follows
    from running sums.
    """
    per = classes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod("sidx", F.lit(len(WEIGHTS))) + 1).cast("int"))
    per = per.withColumn("sidx", rank.cast("long")).withColumn("weight", weight) \
        .withColumn("limit", F.col("source_size") * MOST)
    before = Window.orderBy(F.col("limit") / F.col("weight"), "sidx").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    # With the sources before this one at their limits, is this one at its limit too?
    per = per.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") < F.col("limit"))
    final = F.min(F.when(F.col("free"), F.struct(F.col("limit") / F.col("weight"), F.col("sidx"), F.col("level")))
                  ).over(everything)["level"]
    target = F.when(F.col("limit") / F.col("weight") <= F.coalesce(final, F.lit(float("inf"))),
                    F.col("limit").cast("double")).otherwise(final * F.col("weight"))
    return per.select("sidx", "source", "source_size", "n_docs", target.alias("target"))


def tilted_rate(lam: Column, x: Column) -> Column:
    """The rate of a document of relative size ``x``; 1 at multiplier 0, within [0, MOST]."""
    return F.lit(float(MOST)) / (1 + (MOST - 1) * F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -lam * x))))


def solve_multipliers(classes: DataFrame, targets: DataFrame) -> DataFrame:
    """sidx -> lam, by bracketed Newton steps on the dual."""
    spark = classes.sparkSession
    state = targets.select(
        "sidx", F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"), F.lit(False).alias("done"))
    for step in range(MAX_STEPS):
        state = staged(spark, _newton_step(classes, targets, state), f"mix-step{step}")
        if state.filter(~F.col("done")).isEmpty():
            break
    return state.select("sidx", "lam")


def _newton_step(classes: DataFrame, targets: DataFrame, state: DataFrame) -> DataFrame:
    exact = "decimal(38,6)"
    rate, words = tilted_rate(F.col("lam"), F.col("x")), F.col("size") * F.col("n")
    sums = (classes.join(state.filter(~F.col("done")), "sidx").groupBy("sidx").agg(
        F.sum((words * rate).cast(exact)).cast("double").alias("f"),
        F.sum((words * F.col("x") * rate * (1 - rate / MOST)).cast(exact)).cast("double").alias("slope")))
    s = state.join(sums, "sidx", "left").join(targets.select("sidx", "target", "source_size"), "sidx")
    gap = F.col("target") - F.col("f")
    met = (F.col("done") | F.col("f").isNull() | (F.col("target") >= F.col("source_size") * MOST)
           | (F.abs(gap) <= F.greatest(F.lit(1e-3), F.col("target") * TOLERANCE)))
    low = F.when(gap > 0, F.col("lam")).otherwise(F.col("low"))
    high = F.when(gap <= 0, F.col("lam")).otherwise(F.col("high"))
    newton = F.col("lam") + F.when(F.col("slope") > 0, gap / F.col("slope"))
    inside = (newton > F.coalesce(low, F.lit(float("-inf")))) & (newton < F.coalesce(high, F.lit(float("inf"))))
    near = F.abs(newton - F.col("lam")) <= 2 * (F.abs(F.col("lam")) + 1)
    other = (F.when(low.isNotNull() & high.isNotNull(), (low + high) / 2)
             .otherwise(F.col("lam") + F.signum(gap) * (F.abs(F.col("lam")) + 1)))
    step = F.round(F.when(F.coalesce(inside & near, F.lit(False)), newton).otherwise(other), 12)
    return s.select("sidx", F.when(met, F.col("lam")).otherwise(step).alias("lam"),
                    low.alias("low"), high.alias("high"), met.alias("done"))


def rounded_copies(classes: DataFrame, targets: DataFrame, multipliers: DataFrame) -> DataFrame:
    """sidx, size, n and the copies that each class takes together."""
    full = F.col("target") >= F.col("source_size") * MOST
    rate = F.when(full, F.lit(float(MOST))).otherwise(tilted_rate(F.col("lam"), F.col("x")))
    c = (classes.join(multipliers, "sidx").join(targets.select("sidx", "target", "source_size"), "sidx")
         .withColumn("want", F.col("n") * rate))
    upto = F.sum("want").over(Window.partitionBy("sidx").orderBy("size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    c = c.withColumn("_to", F.floor(upto + 0.5))
    before = F.coalesce(F.lag("_to").over(Window.partitionBy("sidx").orderBy("size")), F.lit(0))
    c = c.withColumn("copies", F.greatest(F.lit(0), F.least(F.col("n") * MOST, F.col("_to") - before)).cast("long"))

    # What a source still lacks (or has too much) is moved by single copies.
    per = c.groupBy("sidx").agg(
        F.round(F.first("target") - F.sum(F.col("size") * F.col("copies"))).cast("long").alias("lack"),
        F.sort_array(F.collect_list(F.when(F.col("size") > 0, F.struct(
            "size", (F.col("n") * MOST - F.col("copies")).alias("room"), F.col("copies").alias("has")))),
            asc=False).alias("sizes"))
    start = F.struct(F.col("lack").alias("lack"),
                     F.array().cast("array<struct<size:bigint,more:bigint>>").alias("moves"))

    def move(acc: Column, s: Column) -> Column:
        most = F.when(acc["lack"] > 0, s["room"]).otherwise(s["has"])
        k = F.least(most, F.floor(F.abs(acc["lack"]) / s["size"]).cast("long"))
        signed = k * F.signum(acc["lack"].cast("double")).cast("long")
        return F.when(k > 0, F.struct(
            (acc["lack"] - signed * s["size"]).alias("lack"),
            F.concat(acc["moves"], F.array(F.struct(s["size"].alias("size"), signed.alias("more")))).alias("moves"),
        )).otherwise(acc)

    moves = per.select("sidx", F.explode(F.aggregate("sizes", start, move)["moves"]).alias("m")) \
        .select("sidx", "m.size", "m.more")
    return (c.join(moves, ["sidx", "size"], "left")
            .select("sidx", "source", "source_size", "target", "size", "n",
                    (F.col("copies") + F.coalesce("more", F.lit(0))).alias("copies")))


def mix(rows: DataFrame) -> DataFrame:
    """``rows`` (written already; ``_row_columns``) with source_size, target, copies and taken."""
    spark = rows.sparkSession
    counted = staged(spark, rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-classes")
    targets = staged(spark, source_targets(counted), "mix-targets")
    mean = F.greatest(F.lit(1e-9), F.col("source_size") / F.col("n_docs"))
    named = targets.select("sidx", F.col("source").alias("_source"), "source_size", "n_docs")
    classes = staged(spark, counted.join(named, F.col("source").eqNullSafe(F.col("_source"))).select(
        "sidx", "source", "size", "n", (F.col("size") / mean).alias("x")), "mix-sized")
    copies = staged(spark, rounded_copies(classes, targets, solve_multipliers(classes, targets)), "mix-copies")

    total = copies.agg(F.sum("n")).first()[0] or 0
    cells = rank_cells(total)
    whole = F.floor(F.col("copies") / F.col("n")).cast("long")
    c = copies.select(*_class_key(), "source_size", "target", whole.alias("_each"),
                      (F.col("copies") - whole * F.col("n")).alias("_odd"))
    keyed = (rows.withColumns(dict(zip(CLASS, _class_key(), strict=True)))
             .withColumn("_cell", F.pmod("_hash", F.lit(cells)).cast("int")))
    cuts = staged(spark, _odd_cuts(keyed, c), "mix-cuts")
    placed = keyed.join(cuts, CLASS)
    at = F.struct("_cell", "_hash")
    cut = F.struct("_cut_cell", "_cut_hash")
    # Rows that agree in id and text with the one at the cut: any of them may take the odd copies.
    tied = F.coalesce((at == cut) & (F.col("_left") > 0), F.lit(False))
    odd = F.coalesce(at < cut, F.lit(False)).cast("long")
    # Dealt out by row first: the ranks would else be taken where the join has put the whole class.
    ranked = with_salted_rank(placed.filter(tied).drop("_cell").repartition("row_id"), CLASS, F.xxhash64("row_id"), [F.col("row_id")], cells)
    of_tied = ranked.withColumn("copies", F.col("_each") + (F.col("_rank") < F.col("_left")).cast("long")).drop("_rank")
    of_others = placed.filter(~tied).withColumn("copies", F.col("_each") + odd).drop("_cell")
    return (of_others.unionByName(of_tied).withColumn("taken", F.col("copies") * F.col("size"))
            .drop("_s", "_null", "_each", "_cut_cell", "_cut_hash", "_left", "_hash"))


CLASS = ["_s", "_null", "size"]


def _class_key() -> list[Column]:
    return [F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_null"), F.col("size")]


def _odd_cuts(keyed: DataFrame, classes: DataFrame) -> DataFrame:
    """``classes`` with the place (cell, hash) in the order of a class before which rows take the odd
    copies, and how many the rows at that place take. Null if nobody does.

    The cell is found from counts of cells, then the hash from counts of hashes within the cells found.
    Rows are counted before they meet the classes, by class and cell, so neither a hot class nor equal rows meet in a task."""
    wanted = classes.filter("_odd > 0").select(*CLASS, F.col("_odd").alias("_left"))
    cell = _cut(_counts(keyed, "_cell"), "_cell", wanted)
    hashes = _counts(keyed, "_cell", "_hash").join(cell.withColumnRenamed("_cut_cell", "_cell"), [*CLASS, "_cell"])
    place = _cut(hashes.withColumnRenamed("_cell", "_cut_cell"), "_hash")
    return classes.drop("_odd").join(place, CLASS, "left")


def _counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*CLASS, *by).agg(F.count(F.lit(1)).alias("_n"))


def _cut(counts: DataFrame, by: str, wanted: DataFrame | None = None) -> DataFrame:
    """For each class the value of ``by`` at which its rows, counted in that order, exceed ``_left``
    (of ``wanted``, if not at hand), and what of ``_left`` falls to that value."""
    upto = F.sum("_n").over(Window.partitionBy(*CLASS).orderBy(by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    counts = counts.withColumn("_upto", upto)
    if wanted is not None:
        counts = counts.join(wanted, CLASS)
    before = F.col("_upto") - F.col("_n")
    return (counts.filter((before <= F.col("_left")) & (F.col("_left") < F.col("_upto")))
            .withColumn("_left", F.col("_left") - before).withColumnRenamed(by, f"_cut{by}").drop("_n", "_upto"))


def _row_columns() -> list[Column]:
    """What ``mix`` needs of a document."""
    return [F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"),
            F.xxhash64("doc_id", F.xxhash64("text")).alias("_hash"), F.monotonically_increasing_id().alias("row_id")]


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for every document."""
    rows = staged(docs.sparkSession, docs.select(*_row_columns()), "mix-rows")
    return mix(rows).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents, all columns, each as many times as the mix takes it."""
    cols = docs.columns
    numbered = staged(docs.sparkSession, docs.select(
        F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), *_row_columns()), "mix-docs")
    taken = mix(numbered.drop("row")).filter("copies > 0").select("row_id", "copies")
    return (numbered.select("row_id", "row").join(taken, "row_id")
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
            .select("row.*"))

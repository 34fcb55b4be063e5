"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger row keeps the
measurements and one failure bit per rule; versioned policies are masks over
those bits, and the effect of dropping one rule from a policy (its ablation) is
counted by bitwise aggregation over the distinct masks, without reading texts
again.

Defined cases: a null or empty text has no words and fails ``few_words``; ratio
rules of a text without words do not fail; repeated rows and null ids are
separate ledger rows; only ``doc_id`` and ``text`` are read, so extra columns
(whatever their names) do no harm; an empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import let, words

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``failed``: a condition over the measurements ({m}: where they are). A rule's
    place in RULES is its bit."""

    name: str
    failed: str


RULES = (
    Rule("few_words", "{m}n_words < 20"),
    Rule("repeated_words", "100 * {m}n_repeat_words > 30 * {m}n_words"),
    Rule("symbols", "100 * {m}n_symbols > 30 * {m}n_words"),
    Rule("repeated_lines", "{m}n_dup_lines > 2 and 100 * {m}n_dup_lines > 30 * {m}n_lines"),
    Rule("word_length", "{m}n_words > 0 and ({m}word_chars < 2 * {m}n_words or {m}word_chars > 20 * {m}n_words)"),
    Rule("shouting", "2 * {m}n_upper > {m}word_chars"),
)
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


#: A document passes a policy when none of the policy's rules failed.
POLICIES = {
    "v1": mask("few_words", "repeated_words"),
    "v2": mask(*BIT),
}
BASE = POLICIES["v1"]
CURRENT = "v2"


def _repeat_words(grams: Column) -> Column:
    """Words inside windows that occur twice or more, from the windows' hashes."""
    def covered(starts: Column) -> Column:
        # A window covers WINDOW words; overlapping ones count each word once.
        return F.aggregate(
            F.transform(starts, lambda s, j: F.least(
                F.lit(WINDOW), F.coalesce(F.get(starts, j + 1), s + WINDOW) - s).cast("long")),
            F.lit(0).cast("long"), lambda a, b: a + b)

    def repeated(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda x, j: F.coalesce(F.get(pairs, j + 1)["h"] == x["h"], F.lit(False))
                         | ((j > 0) & F.coalesce(F.get(pairs, j - 1)["h"] == x["h"], F.lit(False))))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")) \
        .otherwise(let(pairs, repeated))


def _window_hashes(w: Column) -> Column:
    """A hash for each run of WINDOW words, by doubling: 1, 2, 4, 8 words."""
    def doubled(step: int):
        return lambda h: F.zip_with(
            F.slice(h, 1, F.greatest(F.size(h) - step, F.lit(0))),
            F.slice(h, 1 + step, F.greatest(F.size(h) - step, F.lit(0))),
            lambda a, b: F.xxhash64(a, b))

    h = F.transform(w, lambda x: F.xxhash64(x))
    step = 1
    while step < WINDOW:
        h = let(h, doubled(step))
        step *= 2
    return h


def measure(text: Column) -> Column:
    """All measurements of a text as one struct."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.when(F.size(w) < WINDOW, F.lit(0).cast("long"))
            .otherwise(let(_window_hashes(w), _repeat_words)).alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"),
                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    parts = F.struct(
        let(words(text), of_words).alias("w"), let(lines, of_lines).alias("l"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"))
    return let(parts, lambda m: F.struct(
        *[m["w"][c].alias(c) for c in ("n_words", "word_chars", "n_repeat_words")],
        *[m["l"][c].alias(c) for c in ("n_lines", "n_dup_lines")],
        *[m[c].alias(c) for c in ("n_symbols", "n_upper")]))


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the measurements and ``fail_bits``."""
    flat = docs.select("doc_id", measure(F.col("text")).alias("_m")).select("doc_id", "_m.*")
    bits = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(r.failed.format(m="")), F.lit(BIT[r.name])).otherwise(F.lit(0)))
    return flat.withColumn("fail_bits", bits)


def passes(policy: str = CURRENT, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that only it rejects.

    The ledger is first counted by mask (at most 2^rules rows), so nothing else
    grows with the documents.
    """
    m = POLICIES[policy]
    by_mask = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(m)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(BIT[r.name]).cast("long").alias("bit"))
                      for r in RULES if BIT[r.name] & m])
    each = by_mask.select("bits", "n", F.explode(rules).alias("r"))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_this"))


def quality_report(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and the policy's verdict ``kept``."""
    base = F.col("fail_bits").bitwiseAND(F.lit(BASE)) != 0
    return (ledger(docs).withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & passes(policy))
            .withColumn("policy", F.lit(policy)))


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that pass, with all their columns."""
    cols, name = docs.columns, "_quality"
    while name in cols:
        name += "_"
    failed = F.lit(False)
    for r in RULES:
        if BIT[r.name] & (POLICIES[policy] | BASE):
            failed = failed | F.expr(r.failed.format(m=f"`{name}`."))
    return docs.withColumn(name, measure(F.col("text"))).filter(~failed).select(*[F.col(f"`{c}`") for c in cols])

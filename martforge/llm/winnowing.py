"""Benchmark decontamination by winnowing.

A window is a run of SPAN consecutive words of a benchmark item (a shorter item is
one window). From every run of SPAN words the smallest k-gram hash is kept (the
rightmost on ties), for documents and items alike. Equal runs keep the same k-gram,
so a document that holds a window shares a kept fingerprint with its item: that
join misses no shared window. Every shared fingerprint is then extended: all runs
around it are compared word for word with the windows of the benchmark.

The benchmark is the small side. It is read in blocks of at most ``block_bytes`` of
text, each sent to the tasks as one index; a benchmark of any size takes more blocks,
each against all documents, and what they found is written between two of them, so a
task holds one index only. Documents are never shuffled and carry their own result, so a passage that a third of them shares costs nothing extra.

Defined cases: null text has no words and no hits; empty or null items are no
windows; items with equal texts all count; a null item id marks words but is not
listed; repeated rows and null ids are answered row by row; extra columns pass through
``decontaminate`` untouched; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import small_batches, staged
from martforge.llm.wordhash import gram_hashes, word_bounds, word_hashes

SPAN = 10
BLOCK_BYTES = 16 << 20
RESULT = "struct<n_words:bigint,hits:array<struct<s:bigint,e:bigint>>,items:array<string>>"
RESULT_ARROW = pa.struct([("n_words", pa.int64()),
                          ("hits", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                          ("items", pa.list_(pa.string()))])

#: Word bytes: 0-9, a-z and all of non-ASCII; every other byte separates.
TO_WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def normalised(text: str | None) -> bytes:
    """The words of a text, A-Z lower-cased, joined by one space."""
    return b" ".join((text or "").encode().lower().translate(TO_WORDS).split())


def kept(words: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowing: positions and hashes of the k-grams kept for runs of ``span`` words."""
    k = (span + 1) // 2
    grams = gram_hashes(words, k)
    window = span - k + 1
    if len(grams) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    runs = np.lib.stride_tricks.sliding_window_view(grams, window)
    at = np.arange(len(runs)) + window - 1 - np.argmin(runs[:, ::-1], axis=1)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]  # never decreases
    return at, grams[at]


class WindowIndex:
    """The windows of a block of items, in flat arrays by length: about 30 bytes a window
    beside the texts. Windows are told apart by 64-bit hashes; a run of a document
    counts only if its bytes are the window's."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]]):
        self.ids: list[str | None] = []
        texts, size, found = [], 0, {}
        for item_id, text in items:
            norm = normalised(text)
            if not norm:
                continue
            words, starts = word_hashes(norm), word_bounds(norm)[0]
            span = min(SPAN, len(starts))
            runs = gram_hashes(words, span)
            found.setdefault(span, []).append(
                (kept(words, span)[1], runs, size + starts[:len(runs)], np.full(len(runs), len(self.ids), np.int32)))
            self.ids.append(item_id)
            texts.append(norm)
            size += len(norm) + 1
        self.texts = b" ".join(texts) + b" "
        self.spans = {span: self._arrays(*map(np.concatenate, zip(*parts, strict=True))) for span, parts in found.items()}

    @staticmethod
    def _arrays(prints: np.ndarray, runs: np.ndarray, place: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, ...]:
        """Kept fingerprints; the windows' hashes (distinct, sorted) and places in the
        texts; the items of window w are ``item[first[w]:first[w + 1]]``."""
        order = np.lexsort((item, runs))
        runs, place, item = runs[order], place[order], item[order]
        new = np.concatenate([[True], (runs[1:] != runs[:-1]) | (item[1:] != item[:-1])])
        runs, place, item = runs[new], place[new], item[new]
        first = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
        return np.unique(prints), runs[first], place[first], np.append(first, len(runs)), item

    def search(self, norm: bytes, hits: list[tuple[int, int]], items: set[str]) -> tuple[int, list, set]:
        """Words, merged hit ranges (end exclusive) and item ids of a document,
        on top of what earlier blocks found."""
        starts, ends = word_bounds(norm)
        n = len(starts)
        hit, found = np.zeros(n + 1, np.int32), set(items)
        for s, e in hits:
            hit[s] += 1
            hit[e] -= 1
        words = word_hashes(norm) if self.spans else None
        for span, (prints, windows, place, first, item) in self.spans.items():
            if n < span:
                continue
            at, hashes = kept(words, span)
            near = at[_place(prints, hashes) >= 0]
            if not len(near):
                continue
            # Extend: every run around a shared fingerprint is compared with the windows.
            around = np.zeros(n + 1, np.int32)
            np.add.at(around, np.maximum(near + (span + 1) // 2 - span, 0), 1)
            np.add.at(around, np.minimum(near, n - span) + 1, -1)
            tried = np.flatnonzero(np.cumsum(around) > 0)
            window = _place(windows, gram_hashes(words, span)[tried])
            for s, w in zip(tried[window >= 0].tolist(), window[window >= 0].tolist(), strict=True):
                run = norm[starts[s]:ends[s + span - 1]] + b" "
                if self.texts.startswith(run, place[w]):
                    hit[s] += 1
                    hit[s + span] -= 1
                    found.update(i for k in item[first[w]:first[w + 1]] if (i := self.ids[k]) is not None)
        return n, ranges(np.cumsum(hit[:n]) > 0), found


def _place(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted value stands (-1: nowhere)."""
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return np.where(sorted_values[at] == wanted, at, -1)


def ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _searcher(index) -> Callable:
    """``index``: a broadcast WindowIndex."""
    @F.arrow_udf(RESULT)
    def search(text: pa.Array, earlier: pa.Array) -> pa.Array:
        out = []
        for t, e in zip(text, earlier, strict=True):
            e = e.as_py() or {"hits": [], "items": []}
            n, hits, items = index.value.search(
                normalised(t.as_py()), [(h["s"], h["e"]) for h in e["hits"]], set(e["items"]))
            out.append({"n_words": n, "hits": [{"s": a, "e": b} for a, b in hits], "items": sorted(items)})
        return pa.array(out, RESULT_ARROW)

    return search


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterable[list]:
    """The items, repeated rows once, in blocks of about ``block_bytes`` of text at most (one item at least)."""
    benchmark = benchmark.select("item_id", "text").distinct()
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // block_bytes))
    key = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        part = benchmark.select(F.col("item_id").cast("string"), "text")
        yield [tuple(r) for r in (part if blocks == 1 else part.filter(key == b)).collect()]


def searched(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` (all columns of a document) and ``found``: n_words, hits (word ranges) and
    items. Between two blocks the rows are written to the shared folder, so a task
    holds one block's index at a time."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.lit(None).cast(RESULT).alias("found"))
    for n, items in enumerate(benchmark_blocks(benchmark, block_bytes)):
        if n:
            rows = staged(spark, rows, f"winnow-{n}")
        search = _searcher(spark.sparkContext.broadcast(WindowIndex(items)))
        rows = rows.select("row", search(F.col("row.text"), F.col("found")).alias("found"))
    return rows


def decontamination_report(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    rows = searched(docs.select("doc_id", "text"), benchmark, block_bytes)
    hit = F.aggregate("found.hits", F.lit(0).cast("long"), lambda a, h: a + h["e"] - h["s"])
    return rows.select(
        F.col("row.doc_id").alias("doc_id"), F.col("found.n_words").alias("n_words"), hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.size("found.hits") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, all columns, that hold no window of the benchmark."""
    return searched(docs, benchmark, block_bytes).filter(F.size("found.hits") == 0).select("row.*")

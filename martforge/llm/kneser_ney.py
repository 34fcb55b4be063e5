"""Quality classifier: interpolated modified Kneser-Ney trigrams trained on trusted text.

The model is trained on every trusted text (labels: good quality, not toxic) but those of a fifth of
the trusted ids, which is never trained on. Its tables grow with the corpus, so nothing holds them whole:

1. Texts become blocks of tokens: a block's different words once, and for each token the place of its word.
   Blocks are written once, bucketed by block. Labels meet the ids of the blocks.
2. A token goes, with the two before it, to the part of the word before it (a range of hashes). All
   trigrams, bigrams and contexts with that word in the middle are counted there, so these tables
   exist only while a part is worked on. A word more frequent than a part is large (``hot``) is in several parts,
   by the word before it; its bigrams are then summed between them. What parts must know of each other, the number of n-grams with
   each count and of words seen before each word, is summed as a Spark table, and the latter goes to the blocks.
3. All tokens go to the parts in the same way, those trained on marked. A part counts again, scores
   the tokens and returns a sum for each text. A pass does an eighth of the parts (``PASSES``), and
   its shuffle files are removed with it, so the disk never holds the n-grams of all texts.

Each document gets its perplexity; a language's threshold is a quantile over all the
trusted documents that were not trained on, with a margin. The logarithm of a short
text's perplexity is drawn towards the language's median first (``PULL`` tokens), as
few words say little.

Defined cases: null or empty text is one token, the end, and is kept; null language
is a language of its own; a language without trusted texts takes the threshold of all;
repeated labels count once, of several texts of a trusted id the one with the lowest hash is trained on,
repeated rows and null ids are answered row by row; without
any trusted text everything is kept; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.llm.common import small_batches, staged
from martforge.llm.hmm import bucketed, buckets
from martforge.llm.wordhash import mixed, word_hashes
from martforge.session import released, scratch_dir

MAX_TEXT_BYTES = None  # a bound for ``trusted_texts``; the query has none
HELD_OUT_FIFTHS = 5
QUANTILE = 0.99
MARGIN = 0.15  # in log10 of the perplexity
PULL = 25
ORDER = 3
BEGIN, END = np.uint64(0xA5B85C5E198ED849), np.uint64(0xE4D0F7EE57A6E4D1)
BLOCK_BYTES = 4 << 20
TOKEN_BLOCK = 8 << 20  # characters of the texts of a block of tokens
RANGE_ENTRIES = 1 << 19  # words of a range of hashes
PASSES = 8
PASS_TOKENS = 1 << 21  # fewer tokens need no further pass
PART_TOKENS = 1 << 23
COUNTED = 4  # a part that counts has so many times fewer tokens at most
HOT = 10  # level of the bigrams of the first hot word
MESSAGE = "part int, block long, words binary, c binary, c2 binary, u binary, v binary, w binary, docs binary, sizes binary, trained binary"


def sequence(text: str | None) -> np.ndarray:
    words = word_hashes(b" ".join((text or "").encode().lower().split()))
    return np.concatenate([[BEGIN, BEGIN], words, [END]]).astype(np.uint64)


def packed(x: np.ndarray) -> bytes:
    """Unsigned numbers, compressed one byte plane after the other."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()
    return bytes([x.itemsize]) + len(x).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    k, n = data[0], int.from_bytes(data[1:9], "little")
    if not n:
        return np.empty(0, f"u{k}")
    planes = np.frombuffer(pa.decompress(data[9:], n * k, codec="zstd"), np.uint8).reshape(k, n)
    return np.ascontiguousarray(planes.T).view(f"u{k}")[:, 0]


def _range(h: np.ndarray, n: int) -> np.ndarray:
    """Which of n ranges of hashes each hash is in."""
    return (((h >> np.uint64(40)) * np.uint64(n)) >> np.uint64(24)).astype(np.int64)


class Tokens:
    """A block of sequences: its different ``words``, the most frequent first, for each token the place of
    its word in them (``ids``), and the tokens of each text after the two beginnings (``sizes``)."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, sizes: np.ndarray):
        self.words, self.ids, self.sizes = words, ids, sizes.astype(np.int64)

    @classmethod
    def of(cls, got: list[np.ndarray]) -> Tokens:
        words, ids, n = np.unique(np.concatenate(got), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        return cls(words[order], rank[ids], np.array([len(g) - 2 for g in got]))

    @classmethod
    def read(cls, row: dict) -> Tokens:
        return cls(*(unpacked(row[k].as_py()) for k in ("words", "ids", "sizes")))

    def after_hot(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a token follows a hot word, and the hash of the bigram."""
        at = 1 + np.flatnonzero((_found(hot, self.words) >= 0)[self.ids[:-1]])
        return at, _pair(self.words[self.ids[at - 1]], self.words[self.ids[at]])

    def keys(self, hot: np.ndarray) -> np.ndarray:
        """What a block asks the counts of: its words, then its bigrams of hot words."""
        return np.concatenate([self.words, np.unique(self.after_hot(hot)[1])])

    def deal(self, block: int, parts: int, some: range, hot: np.ndarray, docs: np.ndarray, trained: np.ndarray, c: np.ndarray | None = None):
        """A message to each of ``some`` parts, from the ``docs`` chosen. With the counts ``c`` of its keys, it asks for scores
        and names known words only: place 0 is any other word. ``trained`` are the texts trained on."""
        place = np.arange(len(self.ids)) if docs.all() else np.flatnonzero(np.repeat(docs, self.sizes + 2))
        part = np.full(len(self.ids) + 1, -1, np.int32)
        part[1:] = _range(self.words, parts).astype(np.int32)[self.ids]  # of the word before a token
        after, pair = self.after_hot(hot)
        part[after] = _range(_pair(self.words[self.ids[after - 2]], self.words[self.ids[after - 1]]), parts)
        c2 = None if c is None else np.zeros(len(self.ids), np.uint32)
        if c is not None:
            c2[after] = c[len(self.words) + np.unique(pair, return_inverse=True)[1]]
            c = c[:len(self.words)]
        ends = np.cumsum(self.sizes + 2)
        part[ends - self.sizes - 2] = part[ends - self.sizes - 1] = -1
        place = place[(part[place] >= some.start) & (part[place] < some.stop)]
        place = place[np.argsort(part[place].astype(np.int16 if parts < 1 << 15 else np.int32), kind="stable")]
        first = np.searchsorted(part[place], np.arange(some.start, some.stop + 1))
        doc = np.repeat(np.arange(len(self.sizes), dtype=np.uint32), self.sizes + 2)
        kept = np.ones(len(self.words), bool) if c is None else (c > 0) | (self.words == BEGIN)
        for p, lo, hi in zip(some, first[:-1], first[1:], strict=True):
            if lo == hi:
                continue
            at = place[lo:hi]
            uvw = [self.ids[at - 2], self.ids[at - 1], self.ids[at]]
            used = np.zeros(len(self.words), bool)
            for x in uvw:
                used[x] = True
            used &= kept
            new = np.where(used, np.cumsum(used, dtype=np.uint32), np.uint32(0))
            of, n = _runs(doc[at])
            yield {"part": p, "block": block, "words": packed(self.words[used]), **{k: packed(new[x]) for k, x in zip("uvw", uvw, strict=True)},
                   "c": None if c is None else packed(c[used]), "c2": None if c is None else packed(c2[at]), "docs": packed(np.diff(of, prepend=np.uint32(0))),
                   "sizes": packed(n), "trained": packed(trained[of].astype(np.uint8))}


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of runs and their lengths."""
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    return x[first], np.diff(np.append(first, len(x))).astype(np.uint32)


def _single(x: np.ndarray) -> np.ndarray:
    """Rounded to single precision: what the model says of an n-gram has no more."""
    return x.astype(np.float32).astype(np.float64)


class Cuts:
    """The discounts of a level, from how many n-grams have each count: D1, D2, D3+."""

    def __init__(self, n: dict[int, int]):
        n1, n2, n3, n4 = (n.get(k, 0) + 0.5 for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = ((1 - 2 * y * n2 / n1, 1), (2 - 3 * y * n3 / n2, 2), (3 - 4 * y * n4 / n3, 3))
        self.d = np.array([0.0, *(min(max(x, 0.1), k - 0.05) for x, k in d)])

    def __call__(self, c: np.ndarray) -> np.ndarray:
        return self.d[np.minimum(c, 3).astype(np.int64)]

    def of(self, c: str) -> Column:
        d1, d2, d3 = (float(x) for x in self.d[1:])
        return F.when(F.col(c) == 1, d1).when(F.col(c) == 2, d2).otherwise(d3)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(mixed(a) + b)


class Part:
    """The n-grams trained on whose middle word is of one part, from its messages. The bigrams of
    ``hot`` words are apart, as others of them are in other parts."""

    def __init__(self, messages: list[dict], hot: np.ndarray):
        got: list[list[np.ndarray]] = [[np.empty(0, np.uint64)] for _ in "uvw"]
        for m in messages:
            if (given := unpacked(m["trained"])).any():
                words, mask = _named(m), np.repeat(given > 0, unpacked(m["sizes"]).astype(np.int64))
                for into, k in zip(got, "uvw", strict=True):
                    into.append(words[unpacked(m[k])[mask]])
        u, v, w = (np.concatenate(x) for x in got)
        uv = mixed(u) + v
        self.three, at, self.c3 = np.unique(mixed(mixed(uv) + w), return_index=True, return_counts=True)
        self.uv, self.in_uv = np.unique(mixed(uv[at]), return_inverse=True)
        v, w = v[at], w[at]
        two, at, c2 = np.unique(_pair(v, w), return_index=True, return_counts=True)
        of = _found(hot, v[at])
        self.hot, self.of_hot = hot, [x[of >= 0] for x in (of, w[at], c2)]
        two, at, c2 = (x[of < 0] for x in (two, at, c2))
        self.two, self.c2 = two, c2
        self.v, self.in_v = np.unique(v[at], return_inverse=True)
        self.before = np.unique(w[at], return_counts=True)

    def counts(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For levels 3 and 2 how many n-grams have the counts 1 to 4; for 1 after how many words of the part each
        word is found; from HOT on, for each hot word, the counts of the words after it."""
        for level, c in ((3, self.c3), (2, self.c2)):
            k = np.arange(1, 5)
            yield np.full(4, level), k, np.array([(c == x).sum() for x in k])
        yield np.ones(len(self.before[0])), self.before[0].view(np.int64), self.before[1]
        yield HOT + self.of_hot[0], self.of_hot[1].view(np.int64), self.of_hot[2]

    def tables(self, cut2: Cuts, cut3: Cuts) -> None:
        """What each n-gram has after its discount, and what a context has in all and leaves to the lower order."""
        self.a3, self.a2 = _single(self.c3 - cut3(self.c3)), _single(self.c2 - cut2(self.c2))
        self.in_all, self.left = [], []
        for at, c, cut, n in ((self.in_uv, self.c3, cut3, len(self.uv)), (self.in_v, self.c2, cut2, len(self.v))):
            self.in_all.append(_single(np.bincount(at, c, n)))
            self.left.append(_single(np.bincount(at, cut(c), n)))

    def log10(self, m: dict, p1, cut2: Cuts, hot_all: np.ndarray, hot_left: np.ndarray) -> np.ndarray:
        """The sum of log10 probabilities of each text of a message."""
        words, c, u, v, w = _named(m), np.append(np.uint32(0), unpacked(m["c"])), *(unpacked(m[k]) for k in "uvw")
        p = p1(c.astype(np.float64))[w]
        middle, hot = _found(self.v, words)[v], np.append(hot_all > 0, False)[_found(self.hot, words)][v]
        of = _found(self.hot, words)[v[hot]]
        c2 = unpacked(m["c2"])[hot].astype(np.float64)
        p[hot] = (_single(c2 - cut2(c2)) + hot_left[of] * p[hot]) / hot_all[of]
        cold = np.flatnonzero(middle >= 0)
        p[cold] = _mix(p[cold], self.a2, _found(self.two, _pair(words[v[cold]], words[w[cold]])), self.in_all[1], self.left[1], middle[cold])
        some = np.flatnonzero((middle >= 0) | hot)  # where the word before was trained on
        u, v, w = words[u[some]], words[v[some]], words[w[some]]
        uv = mixed(u) + v
        context = _found(self.uv, mixed(uv))
        seen = np.flatnonzero(context >= 0)
        three = _found(self.three, mixed(mixed(uv[seen]) + w[seen]))
        p[some[seen]] = _mix(p[some[seen]], self.a3, three, self.in_all[0], self.left[0], context[seen])
        sizes = unpacked(m["sizes"]).astype(np.int64)
        return np.add.reduceat(np.log10(p), np.cumsum(sizes) - sizes)


def _named(m: dict) -> np.ndarray:
    return np.append(np.uint64(0), unpacked(m["words"]))


def _found(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where in the sorted keys each asked one is, -1 where it is not."""
    if not len(keys):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, -1)


def _mix(lower: np.ndarray, a: np.ndarray, gram: np.ndarray, in_all: np.ndarray, left: np.ndarray, context: np.ndarray) -> np.ndarray:
    if not len(context):
        return lower
    return (np.where(gram >= 0, a[gram], 0.0) + left[context] * lower) / in_all[context]


def _counter(hot: np.ndarray):
    def run(messages: pa.Table) -> pa.Table:
        got = zip(*Part(messages.to_pylist(), hot).counts(), strict=True)
        return pa.table([pa.array(np.concatenate(x).astype(np.int64)) for x in got], names=["level", "key", "n"])
    return run


def _bigrams(hot: np.ndarray):
    """The hashes of bigrams of hot words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level, key = (batch.column(k).to_numpy() for k in ("level", "key"))
            h = _pair(hot[level - HOT], key.view(np.uint64)) if len(level) else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column("n")], ["h", "c"])
    return run


def _frequent(parts: int):
    """The words of blocks that may be hot, with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _block_rows(batches):
            tokens = Tokens.read(row)
            n = np.bincount(tokens.ids, minlength=len(tokens.words))
            some = n * 2 * parts > len(tokens.ids)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.words[some].view(np.int64)), pa.array(n[some])], ["h", "n"])
    return run


def hot_words(blocks: DataFrame, parts: int, tokens: int) -> np.ndarray:
    """Hashes of the words that are more of the tokens than a part is, fewer than the parts."""
    counts = blocks.select("words", "ids", "sizes").mapInArrow(_frequent(parts), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return np.sort(np.array([r["h"] for r in counts.filter(F.col("n") * parts > tokens).collect()], np.int64).view(np.uint64))


class KneserNey:
    """What the parts must know of each other: ``uni``, after how many words each word (h) is found (c), and the
    discounts. ``trained`` are blocks of tokens with ``chosen``, the places of their texts to train on."""

    def __init__(self, texts: DataFrame, passes: int = 1, parts: int | None = None, hot: np.ndarray | None = None, counted: int | None = None):
        """``texts``: such blocks, or texts that are all trained on. They are counted in ``counted`` parts, in some passes."""
        spark = texts.sparkSession
        if "chosen" not in texts.columns:
            blocks = tokens_of(texts.selectExpr("cast(null as long) AS doc_id", "cast(null as string) AS lang", "text"))
            texts = blocks.withColumn("chosen", F.sequence(F.lit(0), F.size("h") - 1))
        self.trained, self.parts, self.hot = texts, parts or parts_of(spark, 0, 1), np.empty(0, np.uint64) if hot is None else hot
        path = scratch_dir(spark, "llm-kn-counts")
        with released(spark):
            for some in cut(counted or self.parts, passes):
                (self.messages(some, counted or self.parts).groupBy("part").applyInArrow(_counter(self.hot), "level long, key long, n long")
                 .groupBy("level", "key").agg(F.sum("n").alias("n")).write.mode("append").parquet(path))
            summed = spark.read.schema("level long, key long, n long").parquet(path).groupBy("level", "key").agg(F.sum("n").alias("n"))
            pairs = summed.filter(F.col("level") >= HOT)
            self.uni = staged(spark, summed.filter("level = 1").unionByName(pairs.withColumn("n", F.lit(1).cast("long")))
                              .groupBy(F.col("key").alias("h")).agg(F.sum("n").alias("c")), "kn-words")
            pairs = staged(spark, pairs, "kn-bigrams") if len(self.hot) else pairs.limit(0)
            self.counts = self.uni.unionByName(pairs.mapInArrow(_bigrams(self.hot), "h long, c long")) if len(self.hot) else self.uni
            told = {level: {} for level in (1, 2, 3)}
            for r in summed.filter("level in (2, 3)").collect():
                told[r["level"]][r["key"]] = r["n"]
            for r in pairs.filter("n <= 4").groupBy("n").count().collect():
                told[2][r["n"]] += r["count"]
            told[1] = {r["c"]: r["n"] for r in self.uni.filter("c <= 4").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
            self.cuts = [Cuts(told[level]) for level in (1, 2, 3)]
            total, left, words = self.uni.agg(F.sum("c"), F.sum(self.cuts[0].of("c")), F.count(F.lit(1))).first()
            self.hot_all, self.hot_left = np.zeros(len(self.hot)), np.zeros(len(self.hot))
            for r in pairs.groupBy("level").agg(F.sum("n").alias("n"), F.sum(self.cuts[1].of("n")).alias("left")).collect():
                self.hot_all[r["level"] - HOT], self.hot_left[r["level"] - HOT] = r["n"], r["left"]
        self.words, self.total = words or 0, float(total or 1)
        self.unknown = (left / total if total else 1.0) / (self.words + 1)
        self.ranges = max(2 * spark.sparkContext.defaultParallelism, -(-self.words // RANGE_ENTRIES))

    def messages(self, some: range, parts: int) -> DataFrame:
        """The tokens to train on, dealt to some of the parts."""
        rows = self.trained.filter("size(chosen) > 0").select("block", "words", "ids", "sizes", "chosen", F.lit(None).cast("binary").alias("c"))
        return rows.mapInArrow(_dealer(parts, some, self.hot), MESSAGE)

    def scorer(self):
        cut1, cut2, cut3 = self.cuts
        total, unknown, hot, hot_all, hot_left = self.total, self.unknown, self.hot, _single(self.hot_all), _single(self.hot_left)

        def p1(c: np.ndarray) -> np.ndarray:
            return np.where(c > 0, _single((c - cut1(c)) / total + unknown), unknown)

        def run(messages: pa.Table) -> pa.Table:
            rows = messages.to_pylist()
            part = Part(rows, hot)
            part.tables(cut2, cut3)
            got = [(m["block"], m["docs"], packed(part.log10(m, p1, cut2, hot_all, hot_left).view(np.uint64))) for m in rows if m["c"] is not None]
            return pa.table([pa.array([g[i] for g in got], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary()))],
                            names=["block", "docs", "sums"])
        return run

    def log10(self, got: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and log10 probability of a few sequences."""
        spark, tokens = self.uni.sparkSession, Tokens.of(got)
        keys = tokens.keys(self.hot).view(np.int64)
        asked = spark.createDataFrame(pa.table({"h": pa.array(keys)}))
        told = {r["h"]: r["c"] for r in self.counts.join(F.broadcast(asked), "h").collect()}
        c = np.array([told.get(h, 0) for h in keys.tolist()], np.uint32)
        every = np.ones(len(got), bool)
        messages = list(tokens.deal(-1, self.parts, range(self.parts), self.hot, every, ~every, c))
        rows = spark.createDataFrame([tuple(m[k] for k in MESSAGE.replace(",", "").split()[::2]) for m in messages], MESSAGE)
        parts = [m["part"] for m in messages]
        found = (self.messages(range(min(parts), max(parts) + 1), self.parts).filter(F.col("part").isin(parts)).unionByName(rows)
                 .groupBy("part").applyInArrow(self.scorer(), "block long, docs binary, sums binary"))
        return tokens.sizes, _summed(len(got), ((r["docs"], r["sums"]) for r in found.collect()))


def _summed(n: int, found: Iterator[tuple[bytes, bytes]]) -> np.ndarray:
    """The sums of n texts, from those of their parts."""
    total = np.zeros(n)
    for docs, sums in found:
        total[np.cumsum(unpacked(docs), dtype=np.int64)] += unpacked(sums).view(np.float64)
    return total


def parts_of(spark: SparkSession, tokens: int, passes: int) -> int:
    return passes * max(2 * spark.sparkContext.defaultParallelism, -(-tokens // (passes * PART_TOKENS)))


def cut(parts: int, passes: int) -> list[range]:
    """The parts of each pass."""
    return [range(parts * i // passes, parts * (i + 1) // passes) for i in range(passes) if parts * i // passes < parts * (i + 1) // passes]


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in blocks of about BLOCK_BYTES of text, a row each."""
    at = 0
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).fill_null(0).to_pylist()
        lo, size = 0, 0
        for i, n in enumerate(sizes):
            size += n
            if size >= BLOCK_BYTES or i + 1 == len(sizes):
                rows = batch.slice(lo, i + 1 - lo)
                lists = [pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), c) for c in rows.columns]
                block = pa.array([TaskContext.get().partitionId() << 33 | at])
                yield pa.RecordBatch.from_arrays([block, *lists], ["block", *rows.schema.names])
                at, lo, size = at + 1, i + 1, 0


def blocks_of(docs: DataFrame) -> DataFrame:
    """block, and lists with an entry for each row: doc_id, lang, text and (null for null texts) its hash h."""
    types = dict(docs.dtypes)
    rows = docs.select("doc_id", "lang", "text", F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("h"))
    schema = f"block long, doc_id array<{types['doc_id']}>, lang array<{types['lang']}>, text array<string>, h array<long>"
    return bucketed(rows.mapInArrow(_packer, schema), "kn-blocks")


def chosen_places(blocks: DataFrame, ids: DataFrame) -> DataFrame:
    """block and chosen: where one text for each of ``ids`` is, of its texts the one with the lowest hash. Only ids move."""
    places = (blocks.select("block", F.posexplode(F.arrays_zip("doc_id", "h")).alias("at", "row"))
              .select("block", "at", "row.doc_id", "row.h").filter("h is not null"))
    return (places.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("h", "block", "at")).alias("row"))
            .select("row.block", "row.at").repartition(buckets(blocks), "block").groupBy("block").agg(F.collect_list("at").alias("chosen")))


def training_texts(blocks: DataFrame, ids: DataFrame) -> DataFrame:
    """One text for each of ``ids`` from ``blocks_of``, as ``chosen_places`` has them."""
    return blocks.select("block", "text").join(chosen_places(blocks, ids), "block").select(
        F.explode(F.transform("chosen", lambda i: F.get("text", i))).alias("text"))


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i] for n in batch.schema.names}


def _token_packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in blocks of tokens, of about TOKEN_BLOCK characters of text, a row each."""
    at, size, got, rows = 0, 0, [], []

    def block() -> pa.RecordBatch:
        tokens = Tokens.of(got)
        table = pa.Table.from_batches(rows).combine_chunks()
        lists = [pa.ListArray.from_arrays(pa.array([0, len(got)], pa.int32()), table[k].chunk(0)) for k in ("doc_id", "lang", "h")]
        return pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId() << 33 | at]), pa.array([len(tokens.ids)]), *lists,
             *(pa.array([packed(x)], pa.binary()) for x in (tokens.words, tokens.ids, tokens.sizes.astype(np.uint32)))],
            ["block", "n", "doc_id", "lang", "h", "words", "ids", "sizes"])

    for batch in batches:
        lo = 0
        for i, text in enumerate(batch.column("text")):
            got.append(sequence(t := text.as_py()))
            size += len(t or "")
            if size >= TOKEN_BLOCK:
                rows.append(batch.select(["doc_id", "lang", "h"]).slice(lo, i + 1 - lo))
                yield block()
                at, size, got, rows, lo = at + 1, 0, [], [], i + 1
        if lo < batch.num_rows:
            rows.append(batch.select(["doc_id", "lang", "h"]).slice(lo))
    if got:
        yield block()


def tokens_of(docs: DataFrame) -> DataFrame:
    """Blocks of tokens: block, its number of tokens n, lists with an entry for each row (doc_id, lang and, null for null
    texts, the text's hash h), and the packed words, ids and sizes."""
    types = dict(docs.dtypes)
    rows = docs.select("doc_id", "lang", "text", F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("h"))
    schema = (f"block long, n long, doc_id array<{types['doc_id']}>, lang array<{types['lang']}>, h array<long>, "
              "words binary, ids binary, sizes binary")
    return bucketed(rows.mapInArrow(_token_packer, schema), "kn-tokens")


def _dealer(parts: int, some: range, hot: np.ndarray):
    """Messages to some of the parts: from blocks without counts of the texts to train on, else from all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _block_rows(batches):
            tokens, c = Tokens.read(row), row["c"].as_py()
            trained = np.zeros(len(tokens.sizes), bool)
            trained[row["chosen"].as_py() or []] = True
            docs = trained if c is None else np.ones(len(tokens.sizes), bool)
            for m in tokens.deal(row["block"].as_py(), parts, some, hot, docs, trained, None if c is None else unpacked(c)):
                yield pa.RecordBatch.from_pylist([m], schema=SCHEMA)
    return run


SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int64()), *((k, pa.binary()) for k in ("words", "c", "c2", "u", "v", "w", "docs", "sizes", "trained"))])


def _asker(n: int, hot: np.ndarray):
    """For each block and range of hashes, the keys of the block in that range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _block_rows(batches):
            keys = np.sort(Tokens.read(row).keys(hot))
            at = np.searchsorted(_range(keys, n), np.arange(n + 1))
            given = np.flatnonzero(np.diff(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(given.astype(np.int32)), pa.array(np.full(len(given), row["block"].as_py())),
                 pa.array([packed(keys[at[i]:at[i + 1]]) for i in given], pa.binary())], ["part", "block", "keys"])
    return run


def _look_up(counts: pa.Table, asked: pa.Table) -> pa.Table:
    """The counts of the keys of each block, 0 where there is none."""
    h, c = counts["h"].to_numpy().view(np.uint64), counts["c"].to_numpy()
    order = np.argsort(h)
    h, c = h[order], np.append(c[order], 0)
    told = [packed(c[_found(h, unpacked(keys.as_py()))].astype(np.uint32)) for keys in asked["keys"]]
    return pa.table([asked["block"], asked["part"], pa.array(told, pa.binary())], names=["block", "part", "c"])


def _known(hot: np.ndarray):
    """The counts of each block's keys, in their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _block_rows(batches):
            keys = Tokens.read(row).keys(hot)
            found = sorted((f["part"], f["c"]) for f in row["found"].as_py())
            c = np.empty(len(keys), np.uint32)
            c[np.argsort(keys, kind="stable")] = np.concatenate([unpacked(x) for _, x in found])
            yield pa.RecordBatch.from_arrays([pa.array([row["block"].as_py()]), pa.array([packed(c)], pa.binary())], ["block", "c"])
    return run


def known_words(blocks: DataFrame, model: KneserNey) -> DataFrame:
    """block and c: after how many words trained on each of its words is found (and bigrams of hot words), bucketed by block."""
    n, tokens = model.ranges, blocks.select("block", "words", "ids", "sizes")
    asked = tokens.mapInArrow(_asker(n, model.hot), "part int, block long, keys binary")
    part = F.shiftright(F.shiftrightunsigned("h", 40) * n, 24).cast("int")
    found = (model.counts.withColumn("part", part).groupBy("part").cogroup(asked.groupBy("part"))
             .applyInArrow(_look_up, "block long, part int, c binary"))
    found = found.repartition(buckets(blocks), "block").groupBy("block").agg(F.collect_list(F.struct("part", "c")).alias("found"))
    return bucketed(tokens.join(found, "block").mapInArrow(_known(model.hot), "block long, c binary"), "kn-known")


def _folded(found: pa.Table) -> pa.Table:
    """What the parts of a pass found for a block as one row: at most one sum for each text."""
    rows = found.to_pylist()
    docs = [np.cumsum(unpacked(r["docs"]), dtype=np.int64) for r in rows]
    sums = _summed(1 + max(int(d[-1]) for d in docs), ((r["docs"], r["sums"]) for r in rows))
    every = np.unique(np.concatenate(docs))
    return pa.table({"block": [rows[0]["block"]], "docs": [packed(np.diff(every, prepend=0).astype(np.uint32))],
                     "sums": [packed(sums[every].view(np.uint64))]},
                    schema=pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("sums", pa.binary())]))


def _summer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _block_rows(batches):
        sizes = unpacked(row["sizes"].as_py()).astype(np.int64)
        sums = _summed(len(sizes), ((f["docs"], f["sums"]) for f in row["found"].as_py()))
        yield pa.RecordBatch.from_arrays([row["doc_id"].values, row["lang"].values, pa.array(sizes), pa.array(sums)],
                                         ["doc_id", "lang", "n_tokens", "log10_prob"])


def scored_texts(blocks: DataFrame, model: KneserNey, passes: int) -> DataFrame:
    """doc_id, lang, n_tokens, log10_prob of every text of the blocks (with ``chosen``, as the model has them)."""
    spark = blocks.sparkSession
    rows = blocks.select("block", "words", "ids", "sizes", "chosen").join(known_words(blocks, model), "block")
    path, schema = scratch_dir(spark, "llm-kn-sums"), "block long, docs binary, sums binary"
    for some in cut(model.parts, passes):
        (rows.mapInArrow(_dealer(model.parts, some, model.hot), MESSAGE).groupBy("part").applyInArrow(model.scorer(), schema)
         .groupBy("block").applyInArrow(_folded, schema).write.mode("append").parquet(path))
    sums = (spark.read.schema(schema).parquet(path).repartition(buckets(blocks), "block")
            .groupBy("block").agg(F.collect_list(F.struct("docs", "sums")).alias("found")))
    types = dict(blocks.dtypes)
    id_type, lang_type = (types[c].removeprefix("array<").removesuffix(">") for c in ("doc_id", "lang"))
    return staged(spark, blocks.select("block", "doc_id", "lang", "sizes").join(sums, "block")
                  .mapInArrow(_summer, f"doc_id {id_type}, lang {lang_type}, n_tokens long, log10_prob double"), "kn-scores")


def trusted_texts(docs: DataFrame, ids: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """One text for each of a few ``ids``, for a small model: with ``max_bytes``, lowest hash of the id first
    until these are reached. The query trains on all (``training_texts``)."""
    size = F.octet_length("text")
    texts = staged(docs.sparkSession, docs.select("doc_id", "text").filter(size <= (MAX_TEXT_BYTES or 1 << 31))
                   .join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")), "kn-texts")
    if max_bytes is None:
        return texts
    upto = F.sum(size).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # one row per trusted id, sizes only
    taken = texts.select("doc_id", upto.alias("upto")).filter(F.col("upto") <= max_bytes).select("doc_id")
    return texts.join(F.broadcast(taken), "doc_id")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_tokens, log10_prob, perplexity, threshold (log10 of the
    perplexity allowed) and kept, for every document."""
    spark = docs.sparkSession
    small_batches(spark)
    trusted = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    fifth = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT_FIFTHS)) == 0
    with released(spark):
        blocks = tokens_of(docs)
        chosen = bucketed(chosen_places(blocks, trusted.filter(~fifth)), "kn-chosen")
        blocks = blocks.join(chosen, "block", "left")
        tokens, texts, some = blocks.agg(F.sum("n"), F.sum(F.size("h")), F.sum(F.greatest(F.size("chosen"), F.lit(0)))).first()
        passes = min(PASSES, -(-(tokens or 1) // PASS_TOKENS))
        parts = parts_of(spark, tokens or 0, passes)
        few = -(-passes * (some or 0) // (texts or 1)) or 1  # passes for the texts to train on
        counted = parts_of(spark, COUNTED * (tokens or 0) * few // passes, few)
        model = KneserNey(blocks, few, parts, hot_words(blocks, parts, tokens or 0), counted)
        scored = scored_texts(blocks, model, passes)

    surprise = -F.col("log10_prob") / F.col("n_tokens")
    held = scored.join(trusted.filter(fifth), "doc_id", "left_semi").withColumn("s", surprise)
    medians = held.groupBy("lang").agg(F.percentile_approx("s", 0.5).alias("median"))
    overall = held.agg(F.percentile_approx("s", 0.5)).first()[0]
    overall = float("inf") if overall is None else overall

    def pulled(rows: DataFrame) -> DataFrame:
        named = medians.select(F.col("lang").alias("_lang"), "median")
        middle = F.coalesce("median", F.lit(overall))
        return (rows.join(named, F.col("lang").eqNullSafe(F.col("_lang")), "left")
                .withColumn("pulled", (PULL * middle - F.col("log10_prob")) / (F.col("n_tokens") + PULL))
                .drop("_lang", "median"))

    limits = pulled(held).groupBy("lang").agg((F.percentile_approx("pulled", QUANTILE) + MARGIN).alias("threshold"))
    every = pulled(held).agg(F.percentile_approx("pulled", QUANTILE) + MARGIN).first()[0]
    every = float("inf") if every is None or not model.words else every
    named = limits.select(F.col("lang").alias("_lang"), "threshold")
    return (pulled(scored).join(named, F.col("lang").eqNullSafe(F.col("_lang")), "left")
            .withColumn("threshold", F.coalesce("threshold", F.lit(every)))
            .select("doc_id", "lang", "n_tokens", "log10_prob", F.pow(F.lit(10.0), surprise).alias("perplexity"),
                    "threshold", (F.isnan("pulled") | (F.col("n_tokens") <= 1) | (F.col("pulled") <= F.col("threshold"))).alias("kept")))

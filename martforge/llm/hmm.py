"""Scoring texts with a hidden Markov language model.

Words are in classes: the most frequent ones (SINGLES at most) are classes of their own, every other
word belongs to a class by its last letters, which only smooths. Every word seen twice or more in training has
emissions of its own in every state, p(word | state) = p(class | state) * p(word | class,
state): with e the expected counts, p(word | class, state) = (e(word, state) + a * q) /
(e(own words of the class, state) + a), where a is the number of words of the class and q = (c + 1) /
(tokens + words + 1 of the class), from the counts of all training tokens, is what words
have in the class whatever the state. A word seen once, or never, has e = 0: one
place says nothing about states beyond its class. The emissions grow with the corpus: those of the
HOT most frequent words are sent to the tasks, the others stay a table by word.

Jobs: (1) tokens are counted per batch and summed by word; (2) texts are written in
blocks of about BATCH_BYTES, as class sequences with the counts of hot words looked up
in a bounded table and the block's other words listed once; (3) those lists join the counts by
word; (4) Baum-Welch: each task adds up expected counts, which are summed over
tasks by word, for ROUNDS passes over every training text; the sums of words that are not
hot join the blocks' lists again for the next pass; (5) the forward recursion, with the last sums.
Blocks and lists are bucketed by block, so passes move neither texts nor lists, only sums.

The start of Baum-Welch is a mixture of unigrams fitted on at most ``INIT_DOCS``
training texts of at most ``INIT_TOKENS`` tokens (lowest hash of the text); after that all training texts count. For
the expected counts a text is cut into stretches of SEGMENT tokens; scoring runs over
whole texts.

Defined cases: null text is empty and has one token, the end; a null id is not held
out; repeated rows are scored each and all counted; extra columns are not read; without
training texts every count is 0 and the model is uniform over classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import low_keys, small_batches, staged
from martforge.llm.wordhash import word_bounds, word_hashes
from martforge.session import delete_path, scratch_dir

FOLDS, HELD_OUT = 7, 2
STATES = 8
SINGLES = 3072
SUFFIXES = 1024
CLASSES = SINGLES + SUFFIXES
HOT = 1 << 18
OWN = 2  # occurrences from which a word has emissions of its own
LEVELS = 4096  # counts up to here are told apart when hot words are chosen
ROUNDS = 3
SEGMENT = 256
INIT_DOCS, INIT_TOKENS = 2000, 1 << 16
INIT_STEPS = 15
SMOOTHING = 200.0  # tokens of the overall class distribution added to each state
END = np.uint64(0xE4D0F7EE57A6E4D1)  # stands for the end token
BATCH_BYTES = 2 << 20
PARTITIONS_PER_BUCKET = 3
LONG, STRETCH = 2048, 512  # texts of more tokens are scored in stretches, all of a block side by side
LATTICE = 1 << 19  # tokens whose state probabilities are held at once


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % FOLDS == HELD_OUT, F.lit(False))


def tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different words of some texts, and the end as the last of them: their hashes, and their classes by
    suffix. Then which of them each token is, the words of a text and its end after one another; and the tokens of each text."""
    norm = pc.ascii_lower(pc.ascii_trim_whitespace(text.fill_null("")))
    empty = pc.equal(norm, "").to_numpy(zero_copy_only=False)
    lists = pc.ascii_split_whitespace(norm)
    sizes = np.where(empty, 0, pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64) + 1
    flat = lists.flatten()
    coded = (flat.filter(pc.not_equal(flat, "")) if empty.any() else flat).dictionary_encode()  # an empty text splits into an empty word
    words = coded.dictionary.cast(pa.binary())
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b" ")[0].as_py()
    starts, ends = word_bounds(joined)
    data = np.frombuffer(joined, np.uint8)
    suffix = np.zeros(len(starts) + 1, np.int64)
    for back in (1, 2, 3):
        at = ends - back
        inside = at >= starts
        suffix[:-1] = (suffix[:-1] * 131 + np.where(inside, data[np.maximum(at, 0)] if len(data) else 0, 0)) % 1_000_003
    which = np.full(int(sizes.sum()), len(words), np.int32)
    is_word = np.ones(len(which), bool)
    is_word[np.cumsum(sizes) - 1] = False
    which[is_word] = coded.indices.to_numpy(zero_copy_only=False)
    return np.append(word_hashes(joined), END), suffix % SUFFIXES, which, sizes


def _pieces(batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows in pieces of about ``most`` bytes of text."""
    for batch in batches:
        lo, size = 0, 0
        for i, n in enumerate(pc.utf8_length(batch.column("text")).fill_null(0).to_pylist()):
            size += n
            if size >= most or i + 1 == batch.num_rows:
                yield batch.slice(lo, i + 1 - lo)
                lo, size = i + 1, 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _pieces(batches):
        h, suffix, which, _ = tokens(rows.column("text"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(suffix.astype(np.int32)), pa.array(np.bincount(which))], ["h", "suffix", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """h, suffix, c: the training tokens counted by word."""
    training = docs.filter(~held_out()).select("text")
    return (training.mapInArrow(_count, "h long, suffix int, n long")
            .groupBy("h").agg(F.min("suffix").alias("suffix"), F.sum("n").alias("c")))


class Vocabulary:
    """The bounded part of the counts: hot words, class totals, N and V.

    Hot are all words above the lowest count (or range of counts, for large ones) with which they
    are ``hot`` at most; the first of them, chosen alike, are classes of their own."""

    def __init__(self, counts: DataFrame, hot: int = HOT):
        per = counts.groupBy("suffix").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
        self.tokens, self.words = sum(r["c"] for r in per), sum(r["v"] for r in per)
        level = F.when(F.col("c") < LEVELS, F.col("c")).otherwise(LEVELS + F.floor(16 * F.log2("c"))).cast("long")
        sizes = sorted(((r["level"], r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)

        def least(most: int) -> int:
            total, low = 0, 1 << 62
            for at, n in sizes:
                total += n
                if total > most or at < OWN:
                    break
                low = at
            return low

        top = counts.filter(level >= least(hot)).withColumn("level", level).toArrow()  # ``hot`` rows at most
        order = np.lexsort([top["h"].to_numpy(), -top["c"].to_numpy()])
        h, c, suffix, at = (top[n].to_numpy().astype(np.int64)[order] for n in ("h", "c", "suffix", "level"))
        h, singles = h.view(np.uint64), int((at >= least(min(hot, SINGLES))).sum())
        cls = np.where(np.arange(len(h)) < singles, np.arange(len(h)), SINGLES + suffix)
        mass, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
        for r in per:
            mass[SINGLES + r["suffix"]] += r["c"]
            kinds[SINGLES + r["suffix"]] += r["v"]
        single = slice(0, singles)
        np.subtract.at(mass, SINGLES + suffix[single], c[single])
        np.subtract.at(kinds, SINGLES + suffix[single], 1)
        mass[single], kinds[single] = c[single], 1
        self.class_total, self.kinds = mass + kinds + 1, kinds
        order = np.argsort(h)
        self.h, self.c, self.cls = h[order], c[order], cls[order].astype(np.uint16)

    def encode(self, h: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Class and count of each word; whether it is hot; and where it then is in the table."""
        cls = (SINGLES + suffix).astype(np.uint16)
        if not len(self.h):
            return cls, np.zeros(len(h), np.int64), np.zeros(len(h), bool), np.zeros(len(h), np.uint32)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hot = self.h[at] == h
        return np.where(hot, self.cls[at], cls), np.where(hot, self.c[at], 0), hot, at.astype(np.uint32)


def _block(i: int) -> int:
    return TaskContext.get().partitionId() << 33 | i


def _one_row(names: list[str], columns: list) -> pa.RecordBatch:
    """A row; numpy arrays become lists."""
    def of(c):
        if isinstance(c, (np.ndarray, pa.Array)):
            flat = c if isinstance(c, pa.Array) else pa.array(c)
            return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)
        return pa.array([c], pa.binary() if isinstance(c, bytes) else None)
    return pa.RecordBatch.from_arrays([of(c) for c in columns], names)


#: A row for each block of texts: lists with an entry for each text, the tokens of all, and the block's words that are not hot.
BLOCK = ("block long, doc_id array<{id}>, held_out array<boolean>, n array<long>, n_hot array<long>, log_hot array<double>, "
         "log_class array<double>, seq binary, word binary, tail array<long>")
BLOCK_COLUMNS = ["block", "doc_id", "held_out", "n", "n_hot", "log_hot", "log_class", "seq", "word", "tail"]


def _encoder(vocabulary, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary.value
        log_total = np.log10(voc.class_total)
        for i, rows in enumerate(_pieces(batches, most)):
            h, suffix, which, sizes = tokens(rows.column("text"))
            cls, c, hot, place = voc.encode(h, suffix)  # of the different words
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            tail, at = np.unique(h[~hot], return_inverse=True)
            place[~hot] = len(voc.h) + at
            seq = cls[which]
            yield _one_row(BLOCK_COLUMNS, [
                _block(i), rows.column("doc_id"), rows.column("held_out"), sizes,
                np.add.reduceat((hot & (c > 0))[which], first, dtype=np.int64), np.add.reduceat(np.log10(c + 1.0)[which], first),
                np.add.reduceat(log_total[cls][which], first), seq.tobytes(), place[which][seq >= SINGLES].tobytes(), tail.view(np.int64)])
    return run


class Words:
    """What tells the words of a class apart by state. A word's emission is that of its class
    times ``share`` (of the class) times (its ``gain`` + ``prior`` of the class), relative to q."""

    def __init__(self, voc: Vocabulary, own_by_class: np.ndarray, hot: np.ndarray):
        self.total, self.prior, self.n_hot = voc.class_total, np.maximum(voc.kinds, 1.0), len(voc.h)
        self.share = 1 / (own_by_class + self.prior[:, None])
        self.hot = (hot * (self.total[voc.cls] / (voc.c + 1.0))[:, None]).astype(np.float32)

    def gain(self, e: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Of words by their expected counts, which sum to their counts."""
        return e * (self.total[cls] / (e.sum(axis=1) + 1))[:, None]

    def factor(self, gain: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return (gain + self.prior[cls, None]) * self.share[cls]


class Model:
    """start (K), move (K, K) and emit (CLASSES, K) probabilities; ``words`` (if any were
    learned) refines the emissions of classes to those of words."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, words: Words | None = None):
        self.start, self.move, self.emit, self.words = start, move, emit, words

    @staticmethod
    def from_counts(start: np.ndarray, move: np.ndarray, emit: np.ndarray, overall: np.ndarray) -> Model:
        emit = emit + SMOOTHING * overall[:, None]
        return Model((start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(axis=1, keepdims=True),
                     emit / emit.sum(axis=0))


def first_model(seqs: list[np.ndarray], overall: np.ndarray, states: int = STATES) -> Model:
    """A mixture of unigrams over the sample: one state for each component, which it rarely leaves."""
    rng = np.random.default_rng(0)
    counts = np.stack([np.bincount(s, minlength=len(overall)) for s in seqs]).astype(np.float32) if seqs else np.zeros(
        (0, len(overall)), np.float32)
    member = rng.dirichlet(np.full(states, 0.3), len(counts))
    for _ in range(INIT_STEPS):
        emit = counts.T @ member + SMOOTHING * overall[:, None]
        emit /= emit.sum(axis=0)
        fit = counts @ np.log(emit) + np.log((member.sum(axis=0) + 1) / (len(counts) + states))
        member = np.exp(fit - fit.max(axis=1, keepdims=True, initial=-1e300))
        member /= member.sum(axis=1, keepdims=True)
    move = np.full((states, states), 1.0) + np.eye(states) * 99 * states
    return Model.from_counts(member.sum(axis=0), move, counts.T @ member, overall)


def expected_counts(model: Model, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch: expected starts, moves and emissions, and log10 likelihood, over
    ``seqs`` cut into stretches."""
    k = len(model.start)
    start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros(model.emit.shape)
    parts = [(s[a:a + SEGMENT], a == 0) for s in seqs for a in range(0, len(s), SEGMENT)]
    parts.sort(key=lambda p: -len(p[0]))
    total, lo = 0.0, 0
    while lo < len(parts):
        hi = lo + max(1, LATTICE // len(parts[lo][0]))
        total += _stretch_counts(model, parts[lo:hi], start, move, emit)
        lo = hi
    return start, move, emit, total


def _stretch_counts(model: Model, parts: list[tuple[np.ndarray, bool]], start, move, emit) -> float:
    """Adds the expected counts of stretches (longest first) to start, move and emit."""
    sizes = np.array([len(p) for p, _ in parts])
    first = np.array([f for _, f in parts])
    steps, n, k = int(sizes[0]), len(parts), len(model.start)
    seq = np.zeros((steps, n), np.uint32)
    for j, (p, _) in enumerate(parts):
        seq[:len(p), j] = p
    active = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")  # stretches that reach step t
    steady = np.linalg.matrix_power(model.move, 64).mean(axis=0)
    table, move_p = model.emit.astype(np.float32), model.move.astype(np.float32)
    alpha, scale = np.zeros((steps, n, k), np.float32), np.ones((steps, n), np.float32)
    now = np.where(first[:, None], model.start, steady).astype(np.float32)
    for t in range(steps):
        m = active[t]
        now = (now if t == 0 else alpha[t - 1, :m] @ move_p) * table[seq[t, :m]]
        scale[t, :m] = now.sum(axis=1)
        alpha[t, :m] = now / scale[t, :m, None]
    beta, between = np.ones((n, k), np.float32), np.zeros((k, k))
    for t in range(steps - 1, -1, -1):
        m = active[t]
        if t + 1 < steps and (later := active[t + 1]):
            ahead = beta[:later] * table[seq[t + 1, :later]] / scale[t + 1, :later, None]
            between += alpha[t, :later].T @ ahead
            beta[:later] = ahead @ move_p.T
        alpha[t, :m] *= beta[:m]  # now the state probabilities
    move += between * model.move
    start += alpha[0][first].sum(axis=0)
    flat = seq.ravel()
    for s in range(k):
        emit[:, s] += np.bincount(flat, alpha[:, :, s].ravel(), minlength=len(emit))
    return float(np.log10(scale).sum())


def log_likelihoods(model: Model, seqs: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each whole sequence, by the scaled forward recursion. Long sequences go in
    stretches side by side, each from every state at once, which are multiplied up at the end."""
    found = np.empty(len(seqs))
    order = sorted((j for j in range(len(seqs)) if len(seqs[j]) <= LONG), key=lambda j: -len(seqs[j]))
    if order:
        sizes = np.array([len(seqs[j]) for j in order])
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        flat = np.concatenate([seqs[j] for j in order])
        total = np.zeros(len(order))
        state = np.tile(model.start, (len(order), 1))
        active = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1), side="right")
        for t in range(int(sizes[0])):
            m = active[t]
            now = (state[:m] if t == 0 else state[:m] @ model.move) * model.emit[flat[first[:m] + t]]
            scale = now.sum(axis=1)
            state[:m] = now / scale[:, None]
            total[:m] += np.log10(scale)
        found[order] = total
    long = [j for j in range(len(seqs)) if len(seqs[j]) > LONG]
    if long:
        found[long] = _long_log_likelihoods(model, [seqs[j] for j in long])
    return found


def _long_log_likelihoods(model: Model, seqs: list[np.ndarray]) -> np.ndarray:
    parts = [(j, a) for j, s in enumerate(seqs) for a in range(1, len(s), STRETCH)]
    sizes = np.array([min(STRETCH, len(seqs[j]) - a) for j, a in parts])
    order = np.argsort(-sizes, kind="stable")
    flat, before = np.concatenate(seqs), np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    first = np.array([before[j] + a for j, a in parts])[order]
    active = np.searchsorted(-sizes[order], -np.arange(1, int(sizes.max()) + 1), side="right")
    through = np.tile(np.eye(len(model.start)), (len(parts), 1, 1))  # from each state before a stretch to each at its end
    scales = np.zeros(len(parts))
    for t, m in enumerate(active):
        now = (through[:m] @ model.move) * model.emit[flat[first[:m] + t], None]
        scale = now.sum(axis=(1, 2))
        through[:m] = now / scale[:, None, None]
        scales[:m] += np.log10(scale)
    place = np.argsort(order, kind="stable")
    total = np.zeros(len(seqs))
    state = [model.start * model.emit[s[0]] for s in seqs]
    for i, (j, _) in zip(place, parts, strict=True):
        now = state[j] @ through[i]
        total[j] += scales[i] + np.log10(now.sum())
        state[j] = now / now.sum()
    return total


class _Local:
    """The tokens of a block (a row) numbered anew, single words first and then every other word
    of the block, with a model over these."""

    def __init__(self, model: Model, row: dict[str, pa.Scalar], n_hot: int):
        sizes = _flat(row["n"])
        flat = np.frombuffer(row["seq"].as_py(), np.uint16)
        self.bounds, self.held = np.cumsum(sizes)[:-1], _flat(row["held_out"]).astype(bool)
        if "word" not in row:  # classes alone
            self.seqs, self.model, self.cls = np.split(flat, self.bounds), model, None
            return
        flat = flat.astype(np.uint32)
        fine = flat >= SINGLES
        word = np.frombuffer(row["word"].as_py(), np.uint32).astype(np.int64)
        self.tail = _flat(row["tail"])
        cold = word >= n_hot
        seen = np.zeros(n_hot, bool)
        seen[word[~cold]] = True
        self.hot = np.flatnonzero(seen)
        code = np.empty(len(word), np.int64)
        code[~cold] = (np.cumsum(seen) - 1)[word[~cold]]
        code[cold] = len(self.hot) + word[cold] - n_hot
        self.cls = np.zeros(len(self.hot) + len(self.tail), np.int64)
        self.cls[code] = flat[fine]
        flat[fine] = SINGLES + code
        self.seqs = np.split(flat, self.bounds)
        self.count = np.zeros(len(self.tail), np.int64)  # of the words that are not hot
        if len(known := row["known"].values or ()):
            self.count[self._place(_field(known, "h"))] = _field(known, "c")
        self.own = np.concatenate([np.full(len(self.hot), True), self.count >= OWN])
        emit = model.emit[self.cls]
        if model.words is not None:
            gain = np.zeros(emit.shape)
            gain[:len(self.hot)] = model.words.hot[self.hot]
            if "rare" in row and len(rare := row["rare"].values or ()):
                to = self._place(_field(rare, "h"))
                e = rare.field("e").flatten().to_numpy(zero_copy_only=False).reshape(-1, emit.shape[1])
                gain[len(self.hot) + to] = model.words.gain(e.astype(np.float64), self.cls[len(self.hot) + to])
            emit = emit * model.words.factor(gain, self.cls)
        self.model = Model(model.start, model.move, np.concatenate([model.emit[:SINGLES], emit]))

    def _place(self, h: np.ndarray) -> np.ndarray:
        """Where words are in the block's list, which is in the order of unsigned numbers."""
        return np.searchsorted(self.tail.view(np.uint64), h.view(np.uint64))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """For each text: its tokens that are known and not hot, and the sum of log10(c + 1) over these."""
        at = np.concatenate([[0], np.cumsum([len(s) for s in self.seqs])])
        flat = np.concatenate(self.seqs).astype(np.int64) - SINGLES - len(self.hot)
        c = np.where(flat >= 0, np.append(self.count, 0)[np.maximum(flat, -1)], 0)
        return np.add.reduceat(c > 0, at[:-1], dtype=np.int64), np.add.reduceat(np.log10(c + 1.0), at[:-1])


def _flat(column: pa.ListScalar) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False)


def _field(structs: pa.StructArray, name: str) -> np.ndarray:
    return structs.field(name).to_numpy(zero_copy_only=False)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Scalar]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i] for n in batch.schema.names}


def _trainer(model, n_hot: int):
    """Expected counts as rows of one value for each state: the start, the moves, the classes, the own words
    of the classes, the hot words and the likelihood by place; other words (``rare``) by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        k, c = m.emit.shape[1], len(m.emit)
        sums, seen = np.zeros((1 + k + 2 * c + n_hot + 1, k)), False
        by_class, own_by_class, hot = sums[1 + k:1 + k + c], sums[1 + k + c:1 + k + 2 * c], sums[1 + k + 2 * c:-1]

        def rows(keys: np.ndarray, values: np.ndarray, rare: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), rare)), pa.array(keys), *(pa.array(v.astype(np.float32)) for v in values.T)],
                ["rare", "h", *(f"e{i}" for i in range(k))])

        for row in _rows(batches):
            local = _Local(m, row, n_hot)
            training = [s for s, held in zip(local.seqs, local.held, strict=True) if not held]
            if not training:
                continue
            start, move, emit, total = expected_counts(local.model, training)
            sums[0] += start
            sums[1:1 + k] += move
            sums[-1, 0] += total
            seen = True
            if local.cls is None:
                by_class += emit
                continue
            by_class[:SINGLES] += emit[:SINGLES]
            words = emit[SINGLES:]
            for i in range(k):
                by_class[:, i] += np.bincount(local.cls, words[:, i], minlength=c)
                own_by_class[:, i] += np.bincount(local.cls, words[:, i] * local.own, minlength=c)
            hot[local.hot] += words[:len(local.hot)]
            given = words[len(local.hot):]
            at = np.flatnonzero(local.own[len(local.hot):] & given.any(axis=1))
            if len(at):
                yield rows(local.tail[at], given[at], True)
        if seen:
            at = np.flatnonzero(sums.any(axis=1))
            yield rows(at, sums[at], False)
    return run


def buckets(df: DataFrame) -> int:
    """Buckets of blocks, each a task: a few times fewer than other partitions, as every task sends sums of all hot words."""
    return -(-int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_PER_BUCKET)


def bucketed(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` bucketed by block to the shared folder: joins by block then move neither side."""
    path = scratch_dir(df.sparkSession, f"llm-{label}")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.format("parquet").bucketBy(buckets(df), "block").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def known_words(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """block and known: its words that are not hot and occur in training, with their counts."""
    pairs = blocks.select("block", F.explode("tail").alias("h")).join(counts.select("h", "c"), "h")
    return pairs.repartition(buckets(blocks), "block").groupBy("block").agg(F.collect_list(F.struct("h", "c")).alias("known"))


def with_rare(given: DataFrame, rare: DataFrame | None) -> DataFrame:
    """Blocks with the expected counts of their words that are not hot (and own some)."""
    if rare is None:
        return given
    pairs = given.select("block", F.explode(F.filter("known", lambda w: w["c"] >= OWN)).alias("w")).select("block", "w.h")
    found = (pairs.join(rare, "h").repartition(buckets(given), "block")
             .groupBy("block").agg(F.collect_list(F.struct("h", "e")).alias("rare")))
    return given.join(found, "block", "left")


def _short_texts(most: int):
    """The training texts of blocks that may be taken for the start, with their hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            seqs = np.split(np.frombuffer(row["seq"].as_py(), np.uint16), np.cumsum(_flat(row["n"]))[:-1])
            kept = [s.tobytes() for s, held in zip(seqs, _flat(row["held_out"]), strict=True) if not held and len(s) <= most]
            keys = np.array([xxhash.xxh64_intdigest(s) for s in kept], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(kept, pa.binary())], ["k", "seq"])
    return run


def fit(blocks: DataFrame, overall: np.ndarray, rounds: int = ROUNDS,
        voc: Vocabulary | None = None) -> tuple[Model, list[float], DataFrame | None]:
    """Baum-Welch over the training texts of ``blocks`` (with their known words); the log10 likelihood seen by each
    round; and the expected counts (h, e) of the words that are not hot. Without ``voc``
    classes are all there is."""
    spark = blocks.sparkSession
    short = blocks.select("seq", "n", "held_out").mapInArrow(_short_texts(INIT_TOKENS), "k long, seq binary")
    sample = low_keys(short, "k", INIT_DOCS).toArrow().sort_by([("k", "ascending"), ("seq", "ascending")])
    model, seen = first_model([np.frombuffer(s.as_py(), np.uint16) for s in sample["seq"]], overall), []
    k, c, n_hot = STATES, len(overall), 0 if voc is None else len(voc.h)
    names, rare, last = [f"e{i}" for i in range(k)], None, None
    used = ["block", "held_out", "n", "seq"] + (["word", "tail", "known"] if voc is not None else [])
    for _ in range(rounds):
        path = scratch_dir(spark, "llm-hmm-round")
        sent = spark.sparkContext.broadcast(model)
        (with_rare(blocks.select(*used), rare)
         .mapInArrow(_trainer(sent, n_hot), "rare boolean, h long, " + ", ".join(f"{e} float" for e in names))
         .groupBy("rare", "h").agg(*[F.sum(e).alias(e) for e in names]).write.parquet(path))
        sent.unpersist()
        out = spark.read.parquet(path)
        rows = out.filter(~F.col("rare")).toArrow()  # 2 + K + 2 * CLASSES + HOT rows at most
        sums = np.zeros((1 + k + 2 * c + n_hot + 1, k))
        sums[rows["h"].to_numpy()] = np.column_stack([rows[e].to_numpy() for e in names])
        seen.append(float(sums[-1, 0]))
        by_class, own_by_class = sums[1 + k:1 + k + c], sums[1 + k + c:1 + k + 2 * c]
        model = Model.from_counts(sums[0], sums[1:1 + k], by_class, overall)
        if voc is not None:
            model.words = Words(voc, own_by_class, sums[1 + k + 2 * c:-1])
            rare = out.filter("rare").select("h", F.array(*[F.col(e).cast("float") for e in names]).alias("e"))
        if last:
            delete_path(spark, last)  # this round has replaced it
        last = path
    return model, seen, rare


def train(blocks: DataFrame, overall: np.ndarray, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """Baum-Welch over classes alone."""
    return fit(blocks, overall, rounds)[:2]


def _scorer(model, n_hot: int, smoothed: float):
    """A row for each text of the blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            local = _Local(model.value, row, n_hot)
            n, (more, log_more) = _flat(row["n"]), local.counts()
            log_counts = _flat(row["log_hot"]) + log_more
            path = log_likelihoods(local.model, local.seqs)
            yield pa.RecordBatch.from_arrays(
                [row["doc_id"].values, row["held_out"].values, pa.array(n), pa.array(_flat(row["n_hot"]) + more),
                 pa.array(log_counts - n * smoothed), pa.array(log_counts - _flat(row["log_class"]) + path)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


def score_report(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    counts = staged(spark, word_counts(docs), "hmm-counts")
    voc = Vocabulary(counts)
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", held_out().alias("held_out"), "text")
    blocks = bucketed(texts.mapInArrow(_encoder(spark.sparkContext.broadcast(voc), BATCH_BYTES), BLOCK.format(id=kind)), "hmm-blocks")
    known = bucketed(known_words(blocks, counts), "hmm-known")
    blocks = blocks.join(known, "block", "left")

    model, _, rare = fit(blocks, voc.class_total / voc.class_total.sum(), voc=voc)
    smoothed = float(np.log10(voc.tokens + voc.words + 1))
    scored = with_rare(blocks, rare).mapInArrow(
        _scorer(spark.sparkContext.broadcast(model), len(voc.h), smoothed),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known",
                         F.lit(int(voc.tokens)).cast("long").alias("train_tokens"), "base_score", "score")

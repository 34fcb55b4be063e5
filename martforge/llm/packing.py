"""Packing token pieces into sequences of balanced cost.

A document's tokens are the ids of a public tokenizer, then END. A sequence costs the sum
over its pieces of ``length + ATTENTION * length ** 2``: attention stays inside a piece.
Documents are taken block by block inside the tasks, so nothing is shuffled. What is
longer than a sequence is cut into full sequences first. The rest of a block goes, from
the longest piece down, to the cheapest sequence with room for it. A piece that fits
nowhere is cut: its start fills the roomiest sequence, and its end is queued again.

A block gets as many sequences as its tokens fill, so every one ends full. The few tokens
that would start another one (under CAPACITY) go on into the next block; after a task's last
block they are laid in sequences whose capacities are the powers of two that their number is made of.
No sequence needs padding, whatever the documents.

White space separates words for this tokenizer, and it ignores case, so a text is encoded word by
word through a table of words seen (about WORDS of at most WORD_BYTES bytes; longer ones are
encoded each time), a stretch of the text at a time.

Defined cases: a null or empty text is END alone; repeated rows and ids are packed each;
a null id stays null; other columns are not read; an empty table gives no pieces. Piece
order, and with it the packing, follows the partitions of the input: reruns over the same
files agree. A task that is run again makes the same sequence numbers.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from martforge.llm.common import small_batches

TOKENIZER = "word_bpe_49k.json"
END = 2
CAPACITY = 4096
#: A causal layer of width d takes 24 * d ** 2 operations a token and 2 * d more for each token before it; d = 2048.
ATTENTION = 1 / 24576
BLOCK_TOKENS, BLOCK_DOCS = 1 << 21, 1 << 15
WORDS, WORD_BYTES = 1 << 20, 64
STRETCH = 1 << 20
#: Small letters, then marks: this tokenizer always cuts between the two and nowhere else.
LETTERS = re.compile(r"([a-z\u00DF-\u00F6\u00F8-\u00FF]{1,48})([!-&(-/:-@\[-`{-~]{0,8})")
ID = np.dtype("<u4")


class WordTable(dict):
    """Ids (little-endian bytes) by word."""

    def __init__(self, path: str):
        self.tokenizer, self.letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.letters.normalizer = None  # for words that it would not change, and that are one piece
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.tails: dict[str, bytes] = {}

    def ids(self, text: str, letters: bool = False) -> np.ndarray:
        tokenizer = self.letters if letters else self.tokenizer
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, ID)

    def learn(self, words: set[bytes]) -> None:
        """Add words. Letters are one piece, whose last token says that it is a last one, and what
        follows them is another; words of other forms are encoded each by itself."""
        letters, ended, others = {}, [], []
        for w in words:
            found = LETTERS.fullmatch(text := w.decode())
            if not found:
                others.append(text)
                continue
            body, tail = found.groups()
            if tail:
                ended.append((w, body.encode(), tail))
                if ended[-1][1] not in self:
                    letters[body] = None
            else:
                letters[body] = None
        ids = self.ids(" ".join(letters), letters=True)
        ends = ((np.flatnonzero(self.last[ids]) + 1) * ID.itemsize).tolist()
        data, at = ids.tobytes(), 0
        for body, end in zip(letters, ends, strict=True):
            self[body.encode()] = data[at:end]
            at = end
        for text, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self[text.encode()] = np.array(e.ids, ID).tobytes()
        for w, body, tail in ended:
            if tail not in self.tails:
                self.tails[tail] = self.ids(tail).tobytes()
            self[w] = self[body] + self.tails[tail]

    def stretch(self, data: bytes) -> bytes:
        words = data.split()
        found = list(map(self.get, words))
        if None in found:
            at = [i for i, ids in enumerate(found) if ids is None]
            if len(self) + len(at) > WORDS:
                self.clear()
                self.tails.clear()
                at = range(len(words))
            new = {words[i] for i in at}
            self.learn(new)
            for i in at:
                found[i] = self[words[i]]
            for w in new:
                if len(w) > WORD_BYTES:
                    del self[w]
        return b"".join(found)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text, without END."""
        data = (text or "").encode()
        if b"<|" not in data:  # special tokens are written so, and are told from others by case
            data = data.lower()
        at, found = 0, []
        while at < len(data):
            cut = data.rfind(b" ", at, at + STRETCH) if at + STRETCH < len(data) else len(data)
            cut = cut if cut > at else data.find(b" ", at + STRETCH)
            cut = cut if cut > at else len(data)
            found.append(self.stretch(data[at:cut]))
            at = cut
        return b"".join(found)


@cache  # a Python worker keeps it for its next tasks
def word_table(path: str) -> WordTable:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
    return WordTable(path)


def cost(length: np.ndarray | int) -> np.ndarray | float:
    return length + ATTENTION * length * length


def assign(lengths: list[int], room: np.ndarray) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Lay pieces into sequences with ``room`` tokens each, longest first.

    Returns (piece, start in the piece, length, sequence, offset) of what was laid, and
    (piece, start, length) of what found no room.
    """
    queue = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(queue)
    free, spent = room.astype(np.int64), np.zeros(len(room))
    laid, left = [], []
    while queue:
        n, i, start = heapq.heappop(queue)
        n = -n
        fits = np.flatnonzero(free >= n)
        to = int(fits[np.argmin(spent[fits])]) if len(fits) else int(np.argmax(free)) if len(free) else -1
        take = min(n, int(free[to])) if to >= 0 else 0
        if not take:
            left.append((i, start, n))
            continue
        laid.append((i, start, take, to, int(room[to] - free[to])))
        free[to] -= take
        spent[to] += cost(take)
        if take < n:
            heapq.heappush(queue, (take - n, i, start + take))
    return laid, left


class _Packer:
    """Packs the documents of one task."""

    def __init__(self, task: int, capacity: int, fields: list[pa.Field]):
        self.first, self.capacity, self.fields, self.made = task << 40, capacity, fields, 0
        self.docs: list[tuple[object, int, int, bytes]] = []  # id, tokens, start of what is left, its ids
        self.tokens = 0

    def add(self, doc_id, ids: bytes) -> Iterator[pa.RecordBatch]:
        total = len(ids) // ID.itemsize
        whole = total - total % self.capacity
        if whole:
            yield self.rows([(doc_id, total, s, ids[s * 4:(s + self.capacity) * 4], self.number(), 0)
                             for s in range(0, whole, self.capacity)])
        if total > whole:
            self.docs.append((doc_id, total, whole, ids[whole * 4:]))
            self.tokens += total - whole
        if self.tokens >= BLOCK_TOKENS or len(self.docs) >= BLOCK_DOCS and self.tokens >= self.capacity:
            yield self.flush(np.full(self.tokens // self.capacity, self.capacity))

    def finish(self) -> Iterator[pa.RecordBatch]:
        rest = self.tokens % self.capacity
        powers = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        if self.tokens:
            yield self.flush(np.array([self.capacity] * (self.tokens // self.capacity) + powers))

    def number(self) -> int:
        self.made += 1
        return self.first + self.made - 1

    def flush(self, room: np.ndarray) -> pa.RecordBatch:
        laid, left = assign([len(ids) // 4 for *_, ids in self.docs], room)
        numbers, rows = [self.number() for _ in room], []
        for i, start, length, to, offset in sorted(laid, key=lambda p: (p[3], p[4])):
            doc_id, total, before, ids = self.docs[i]
            rows.append((doc_id, total, before + start, ids[start * 4:(start + length) * 4], numbers[to], offset))
        held = [self.docs[i] for i, _, _ in left]
        self.docs = [(doc_id, total, before + start, ids[start * 4:(start + length) * 4])
                     for (doc_id, total, before, ids), (_, start, length) in zip(held, left, strict=True)]
        self.tokens = sum(length for _, _, length in left)
        return self.rows(rows)

    def rows(self, rows: list[tuple]) -> pa.RecordBatch:
        doc_id, total, start, ids, number, offset = zip(*rows, strict=True)
        columns = [doc_id, start, [len(x) // 4 for x in ids], ids, total, number, offset]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.fields, strict=True)],
                                          schema=pa.schema(self.fields))


def _packed(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, end, packer = word_table(path), np.array([END], ID).tobytes(), None
        for batch in batches:
            if packer is None:
                long = pa.int64()
                types = {"doc_id": batch.schema.field("doc_id").type, "start": long, "length": long, "ids": pa.binary(),
                         "doc_tokens": long, "sequence_id": long, "offset": long}
                packer = _Packer(TaskContext.get().partitionId(), capacity, [pa.field(k, t) for k, t in types.items()])
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                yield from packer.add(doc_id.as_py(), table.encode(text.as_py()) + end)
        if packer is not None:
            yield from packer.finish()
    return run


def packed_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """doc_id, start, length, ids (binary, unsigned 32-bit little-endian), doc_tokens, sequence_id
    and offset of every piece. ``tokenizer``: the path of a tokenizer's file, the same on every machine."""
    small_batches(docs.sparkSession)
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _packed(path, capacity),
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def packing_report(docs: DataFrame) -> DataFrame:
    return packed_pieces(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

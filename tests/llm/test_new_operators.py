"""Packing, whitening and hard negatives against plain forms of their contracts."""

import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martforge.llm import hard_negatives, packing, whitening
from martforge.llm.queries import QUERIES
from tests.llm.frames import LONG, docs

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
CLASHES = "row_id x label2 rank id score cell grp block pos anchors rows n component i s pair".split()


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check_pieces(rows, given):
    """given: (id, text) rows; each id may stand for several equal texts."""
    want = defaultdict(list)
    for i, text in given:
        want[i].append(ids_of(text))
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.doc_tokens, r.start, r.length, r.ids_crc32))
    assert set(got) == set(want)
    for i, all_ids in want.items():
        if len(all_ids) > 1:  # repeated ids: pieces can't be told apart, tokens can
            assert sum(p[2] for p in got[i]) == sum(map(len, all_ids))
            continue
        at = 0
        for total, start, length, crc in sorted(got[i], key=lambda p: p[1]):
            assert (total, start) == (len(all_ids[0]), at) and length > 0
            assert crc == zlib.crc32(np.array(all_ids[0][at:at + length], "<u4").tobytes())
            at += length
        assert at == len(all_ids[0])
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0  # a power of two: never padded
    return sequences


def test_packing_whole_table(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = QUERIES["op11_cost_balanced_packing"](spark, sf_dir).collect()
    sequences = check_pieces(rows, [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()])
    full = [p for p in sequences.values() if sum(n for _, n in p) == 4096]
    assert len(sequences) - len(full) <= 12 * d.rdd.getNumPartitions()


def test_packing_awkward_rows(spark):
    d = docs(spark)
    rows = packing.packing_report(d).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()])
    assert packing.packing_report(docs(spark, [])).count() == 0
    one = packing.packing_report(docs(spark, [(1, None, None, None, None)])).collect()
    assert [(r.doc_id, r.start, r.length, r.doc_tokens, r.offset) for r in one] == [(1, 0, 1, 1, 0)]


def test_word_table_is_the_tokenizer():
    texts = ["", " a", "Don't  STOP\tnow\x0b\x0cx\x1cy z", "é ́x Å", " nb sp wide 　x",
             "<|endoftext|>a<|startoftext|> b", "각 한국어 한", "İstanbul ΑΣ ς", "a\x00b \x00 \x00\x00 c", "Wait... What?! a.b,c 3.14 1,000; it's. 'S x!\u2026 \u2026. \u00e9. don't!'t", "<|EndOfText|> A.B", "x" * 500 + " " + "12345 " * 40, LONG[:5000]]
    table = packing.WordTable(public_tokenizers.path("word_bpe_49k.json"))
    for text in texts * 2:
        assert np.frombuffer(table.encode(text), "<u4").tolist() == ids_of(text)[:-1], text


def test_word_table_stretches(monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 7)
    monkeypatch.setattr(packing, "WORDS", 3)
    table = packing.WordTable(public_tokenizers.path("word_bpe_49k.json"))
    for text in ["one two  three\tfour five   six", "longerthanastretch it is", "        ", "no spaces\nbut\nlines here and so on"]:
        assert np.frombuffer(table.encode(text), "<u4").tolist() == ids_of(text)[:-1]


def test_assign_balances_cost():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 3000, 400).tolist()
    k = sum(lengths) // 4096
    laid, left = packing.assign(lengths, np.full(k, 4096))
    assert sum(n for *_, n in left) == sum(lengths) % 4096
    fill, spent, naive = np.zeros(k), np.zeros(k), np.zeros(k + 1)
    for _, _, n, to, offset in sorted(laid, key=lambda p: (p[3], p[4])):
        assert offset == fill[to]
        fill[to] += n
        spent[to] += packing.cost(n)
    assert (fill == 4096).all()
    at = 0
    for n in lengths:  # documents in their order, cut at every 4096
        while n:
            take = min(n, 4096 - at % 4096)
            naive[at // 4096] += packing.cost(take)
            at, n = at + take, n - take
    assert spent.std() < 0.5 * naive[:k].std()


def vector_rows(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return df.withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3)


def awkward_vectors(rng, n=400, d=6):
    rows = [(i, rng.normal(0, 0.3, d).round(3).tolist(), int(i % 4)) for i in range(n)]
    rows += [(i, [0.25] * d, 1) for i in range(1000, 1000 + n // 2)]  # one hot vector
    rows += [(i, rows[i % 5][1], int(i % 3)) for i in range(2000, 2100)]  # ties
    rows += [rows[50], rows[50], (None, [0.5] * d, 2), (None, [0.5] * d, 1)]
    rows += [(3000, None, 1), (3050, [None] * d, 1), (3100, [float("nan")] + [0.0] * (d - 1), 2), (3150, [float("inf")] * d, 2),
             (3200, [0.1] * d, None), (3250, [0.1, 0.2], 3), (3300, [], 3), (3400, [1e300] * d, 1)]
    return rows


def plain_x(rows, scale, offset=0):
    d = 6
    return [(i, [int(np.floor(scale * float(c))) + offset for c in v], label) for i, v, label in rows
            if v is not None and len(v) == d and all(c is not None and np.isfinite(c) and abs(c) < 1e12 for c in v)]


def check_whitening(got, x, tolerance=1e-9):
    """got: rows of the result; x: (id, whole numbers)."""
    fit = [list(v) for v in {tuple(v) for _, v in x}]
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    mean = [Fraction(s, n) for s in sums]
    dev = [[v[j] - mean[j] for j in range(d)] for v in fit]
    scaled = np.array([[int(c * n) for c in v] for v in dev], object)
    cov = (scaled.T @ scaled) / Fraction(n) / n / n
    cov = np.array(cov.tolist(), float)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    k = min(16, d)
    assert len(got) == len(x) * k and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-4
    by = defaultdict(lambda: defaultdict(list))
    for r in got:
        by[r.vec_id][r.component].append(r)
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
    z = np.array([[by[i][c + 1][0].whitened for c in range(k)] for i, _ in x])
    exact = {i: sum((n * v[j] - sums[j]) ** 2 for j in range(d)) for i, v in x}
    for i, _ in x:
        assert {r.deviation for r in by[i][1]} == {exact[i] if exact[i] < 1 << 63 else None}
    # the projections on all components give back every Mahalanobis product
    y = np.array([[float(v[j] - mean[j]) for j in range(d)] for _, v in x])
    w = np.linalg.lstsq(y, z, rcond=None)[0]
    assert np.allclose(y @ w, z, atol=1e-8)
    unit = w * np.sqrt(values[:k])
    assert np.allclose(unit.T @ unit, np.eye(k), atol=1e-7)
    assert np.allclose(cov @ unit, unit * values[:k], atol=1e-7 * max(1, values[0]))


def test_whitening_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    x = [(r.vec_id, [int(np.floor(64 * float(c))) + 1_000_000 for c in r.embedding]) for r in rows]
    check_whitening(QUERIES["op12_polarised_whitening"](spark, sf_dir).collect(), x)


def test_whitening_awkward_rows(spark):
    rows = [r for r in awkward_vectors(np.random.default_rng(3)) if r[0] is not None]
    x = [(i, v) for i, v, _ in plain_x(rows, 64, 1_000_000)]
    got = whitening.whiten(vector_rows(spark, rows, "double")).collect()
    once = {i: v for i, v in x}
    assert sum(r.vec_id == rows[50][0] for r in got) == 3 * 6
    assert {r.n for r in got} == {len({tuple(v) for v in once.values()})} and len(got) == 6 * len(x)
    check_whitening(list({(r.vec_id, r.component): r for r in got}.values()), list(once.items()))
    assert whitening.whiten(vector_rows(spark, [])).count() == 0
    assert whitening.whiten(vector_rows(spark, [(1, [], 1), (2, None, 1)])).count() == 0
    flat = whitening.whiten(vector_rows(spark, [(1, [0.5, 1.0], 1), (None, [0.5, 2.0], 1)])).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component, r.whitened, r.explained) for r in flat] == [
        (None, 1, pytest.approx(1 if flat[0].whitened > 0 else -1), 1.0), (None, 2, None, 0.0),
        (1, 1, pytest.approx(-1 if flat[0].whitened > 0 else 1), 1.0), (1, 2, None, 0.0)]
    one = whitening.whiten(vector_rows(spark, [(1, [0.5, 1.0], 1)])).collect()
    assert [(r.whitened, r.explained, r.deviation) for r in one] == [(None, None, 0)] * 2


def test_whitening_large_values(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 1, 6) * (1e9 if i % 9 == 0 else 1)).tolist(), 1) for i in range(60)]
    got = whitening.whiten(vector_rows(spark, rows, "double")).collect()
    fit = whitening.solve(2, [10, 20], [9, 1, 4], 2)  # by hand: y sums to rest (0, 0)
    assert fit.covariance.tolist() == [[4.5, (1 / 2 - 4.5 - 2) / 2], [(1 / 2 - 4.5 - 2) / 2, 2.0]]
    x = [(i, v) for i, v, _ in plain_x(rows, 64, 1_000_000)]
    n, sums = 60, [sum(v[j] for _, v in x) for j in range(6)]
    exact = {i: sum((n * v[j] - sums[j]) ** 2 for j in range(6)) for i, v in x}
    assert {(r.vec_id, r.deviation) for r in got} == {(i, e if e < 1 << 63 else None) for i, e in exact.items()}
    assert max(r.identity_error for r in got) < 1e-4


def plain_negatives(x):
    """x: (id, whole numbers, label), labels shifted already."""
    found = []
    score = lambda a, b: sum(p * q for p, q in zip(a, b, strict=True))
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for a, (i, v, label) in enumerate(x):
        if i is None or i % 50:
            continue
        scores = [score(v, w) for _, w, _ in x]
        same = sorted(((scores[b], j) for b, (j, _, m) in enumerate(x) if b != a and m == label), key=key)[:5]
        other = sorted(((scores[b], j) for b, (j, _, m) in enumerate(x) if m != label), key=key)
        for ps, p in same:
            fit = [(s, j) for s, j in other if 50 * ps <= 100 * s <= 95 * ps][:3]
            found += [(i, p, r + 1, j, ps, s) for r, (s, j) in enumerate(fit)]
    return found


def shifted(x):
    return [(i, v, (m + 1) % 10 if i is not None and i % 7 == 0 else m) for i, v, m in x if m is not None]


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((c is None, c or 0) for c in r))


def test_negatives_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    x = shifted([(r.vec_id, [int(np.floor(256 * float(c))) for c in r.embedding], r.label) for r in rows])
    assert order(QUERIES["op13_kronecker_negatives"](spark, sf_dir).collect()) == order(plain_negatives(x))


@pytest.mark.parametrize("cell", [64, 1 << 15])
def test_negatives_awkward_rows(spark, monkeypatch, cell):
    monkeypatch.setattr(hard_negatives, "CELL", cell)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 4 if cell == 64 else 1 << 10)
    monkeypatch.setattr(hard_negatives, "GROUP", 2)
    rows = awkward_vectors(np.random.default_rng(7))
    got = hard_negatives.mine(vector_rows(spark, rows, "double")).collect()
    assert order(got) == order(plain_negatives(shifted(plain_x(rows, 256))))
    assert got
    for none in ([], [(1, [0.5], 1)], [(50, [0.5], 1)], [(50, None, 1)]):
        assert hard_negatives.mine(vector_rows(spark, none)).count() == 0


@pytest.mark.parametrize("size", [1, 200, 1 << 24, 1 << 40])
def test_packed_scores_are_exact(size):
    rng = np.random.default_rng(size % 1000)
    a, x = (rng.integers(-size, size + 1, (n, 8)) for n in (7, 33))
    x[5], a[2] = size, -size
    if size > 1 << 30:
        x[::2] //= 1 << 35
        a[::3] //= 1 << 35
    want = a.astype(object) @ x.astype(object).T
    got = hard_negatives.packed_scores(a, x)
    assert (got == np.clip(want, -hard_negatives.TOP, hard_negatives.TOP)).all()


def test_several_rows_share_a_number():
    x = np.arange(-90, 90).reshape(-1, 6)
    a = x[::-2]
    assert hard_negatives.BITS // int(6 * 179 * 179).bit_length() >= 2
    assert (hard_negatives.packed_scores(a, x) == a @ x.T).all()

import random

import numpy as np
import pytest

from tierline.llm import negatives, whitening
from tierline.llm.spectral import leading

SCHEMA = "vec_id long, embedding array<float>, label int"
# Also names that the operators use inside.
EXTRA = ", ids array<long>, windows array<long>, part int, anchor boolean, vector string, n long, whitened double, i int"


def table(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 8) for r in rows], SCHEMA + EXTRA)


def points(count, size=6, labels=3, seed=1):
    rng = random.Random(seed)
    return [(k, [rng.gauss(0, 0.4) for _ in range(size)], rng.randrange(labels)) for k in range(count)]


def odd_rows(size):
    nan, inf = float("nan"), float("inf")
    return [
        (900, None, 1), (901, [], 1), (902, [None] * size, 1), (903, [nan] * size, 1), (904, [inf] + [0.0] * (size - 1), 2),
        (905, [0.5] * (size + 1), 1), (906, [1e30] * size, 0),
    ]


# Hard negatives


def mined(rows, every=100, positives=5, negatives=5):
    """All pairs, one anchor at a time."""
    rows = {i: (np.floor(256 * np.float32(v).astype(float)).astype(int), label) for i, v, label in reversed(rows)}
    out = []
    for a in (i for i in rows if i % every == 0):
        scores = sorted((-int(rows[a][0] @ v), i, label) for i, (v, label) in rows.items() if i != a)
        for s, p, _ in [x for x in scores if x[2] == rows[a][1]][:positives]:
            near = [x for x in scores if x[2] != rows[a][1] and 80 * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("count, size, labels", [(700, 6, 3), (150, 2, 2), (1200, 3, 1), (40, 4, 40)])
def test_hard_negatives_are_those_of_all_pairs(spark, count, size, labels):
    rows = points(count, size, labels, seed=count)
    found = negatives.hard_negatives(table(spark, rows + odd_rows(size)), anchor_every=10)
    assert sorted(map(tuple, found.collect())) == mined(rows, 10)


def test_equal_scores_go_to_the_smaller_id(spark):
    # A third of the rows is one vector, in all labels; more ties than are asked for, across groups.
    rows = [(k, [0.5, 0.5, 0.0] if k % 3 == 0 else [0.5, 0.5, 0.001 * (k % 7)], k % 4) for k in range(1500)]
    found = negatives.hard_negatives(table(spark, rows), anchor_every=100)
    assert sorted(map(tuple, found.collect())) == mined(rows)


def test_hard_negatives_of_awkward_rows(spark):
    nothing = table(spark, [])
    assert negatives.hard_negatives(nothing).collect() == []
    assert negatives.hard_negatives(table(spark, odd_rows(3))).collect() == []
    assert negatives.hard_negatives(table(spark, [(100, [1.0, 0.0], 1)])).collect() == []
    # Rows without id or label take no part; a repeated row counts once; scores below zero open no window.
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.8, 0.1], 2), (3, [-1.0, 0.0], 1), (-100, [0.5, 0.5], 2)]
    given = [*rows, rows[0], rows[2], rows[2], (None, [1.0, 0.0], 1), (5, [0.9, 0.0], None)]
    found = negatives.hard_negatives(table(spark, given))
    assert sorted(map(tuple, found.collect())) == mined(rows)
    assert {r[0] for r in mined(rows)} == {0}


def test_large_entries_are_exact(spark):
    rng = random.Random(5)
    rows = [(k, [rng.uniform(-9e5, 9e5) for _ in range(4)], k % 2) for k in range(60)]
    found = negatives.hard_negatives(table(spark, rows), anchor_every=5)
    assert sorted(map(tuple, found.collect())) == mined(rows, 5)


def test_keys_sort_like_their_values():
    values = [(a, s, kind, i) for a in (-100, 0, 7) for s in (0, 5, 1 << 40) for kind in (0, 1) for i in (-3, 0, 9)]
    columns = [np.array(c) for c in zip(*values, strict=True)]
    keys = [
        negatives.packed(columns[0][[k]], columns[1][[k]], values[k][2], columns[3][[k]])[0].as_py() for k in range(len(values))
    ]
    assert [negatives.unpacked(k) for k in keys] == values
    ordered = [negatives.unpacked(k) for k in sorted(keys)]
    assert ordered == sorted(values, key=lambda v: (v[0], -v[1], v[2], v[3]))


# Whitening


def whitened_by_hand(rows, count):
    x = np.floor(1024 * np.array([np.float32(v) for _, v, _ in rows]).astype(float)) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    whole = [[int(c) for c in row] for row in x]
    deviations = [sum((n * c - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in whole]
    return n, deviations, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_whitening_matches_a_full_decomposition(spark):
    rng = np.random.default_rng(3)
    turn = rng.standard_normal((12, 12))
    rows = [(k, list(map(float, turn @ (rng.standard_normal(12) * np.arange(1, 13)) / 30)), None) for k in range(400)]
    df = table(spark, rows + odd_rows(12))
    model = whitening.fit(df, 5)
    done = whitening.whiten(df, model)
    n, deviations, expected, explained = whitened_by_hand(rows, 5)
    got = {r["vec_id"]: r for r in done.collect()}
    assert sorted(got) == list(range(400)) and model.n == n
    assert [int(got[k]["deviation"]) for k in range(400)] == deviations
    found = np.array([got[k]["whitened"] for k in range(400)])
    signs = np.sign((found * expected).sum(axis=0))
    assert np.allclose(found * signs, expected, atol=1e-8)
    assert np.allclose(model.values / model.trace, explained, rtol=1e-10)
    assert whitening.identity_error(done, model) < 1e-10


def test_the_model_does_not_depend_on_the_partitioning(spark):
    df = table(spark, points(300))
    models = [whitening.fit(df.repartition(k), 4) for k in (1, 7)]
    assert (models[0].vectors == models[1].vectors).all() and (models[0].values == models[1].values).all()


def test_whitening_of_awkward_rows(spark):
    assert whitening.fit(table(spark, []), 8) is None
    assert whitening.fit(table(spark, [(1, None, 1), (2, [], 1), (3, [None], 1)]), 8) is None
    # One row, or equal rows: no variance, no component, and every row is still there.
    for rows in ([(1, [0.25, 0.5], 0)], [(k, [0.25, 0.5], 0) for k in range(9)]):
        df = table(spark, rows)
        model = whitening.fit(df, 8)
        done = whitening.whiten(df, model)
        assert len(model.values) == 0 and whitening.identity_error(done, model) == 0.0
        assert [(r["deviation"], r["whitened"]) for r in done.collect()] == [(0, [])] * len(rows)
    # Repeated rows count as often as they stand there, and fewer components than asked for where the rank is lower.
    rows = [(1, [0.5, 0.0, 0.0], 0), (2, [0.0, 0.5, 0.0], 0), (2, [0.0, 0.5, 0.0], 0), (None, [0.0, 0.0, 0.0], 0)]
    model = whitening.fit(table(spark, rows), 8)
    assert model.n == 4 and len(model.values) == 2
    assert whitening.whiten(table(spark, rows), model).count() == 4


def test_deviations_beyond_64_bits(spark):
    rows = [(k, [2.0**29 * (-1) ** k, 1.0], 0) for k in range(6)]
    df = table(spark, rows)
    found = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(df, whitening.fit(df, 2)).collect()}
    assert set(found.values()) == {(6 * 2**39) ** 2}


@pytest.mark.parametrize("kind", ["random", "equal", "symmetric", "close", "wide", "low rank"])
def test_divide_and_conquer(kind):
    rng = np.random.default_rng(8)
    turn, _ = np.linalg.qr(rng.standard_normal((10, 10)))
    values = {
        "random": rng.uniform(1, 2, 10), "equal": np.array([3.0] * 4 + [1.0] * 6), "symmetric": np.arange(1.0, 11.0),
        "close": 1 + 1e-9 * np.arange(10), "wide": 10.0 ** np.arange(10), "low rank": np.array([5.0, 2.0] + [0.0] * 8),
    }[kind]
    matrix = turn @ np.diag(values) @ turn.T
    found, vectors = leading((matrix + matrix.T) / 2, 10)
    expected = np.sort(values[values > 0])[::-1]
    assert np.allclose(found, expected, rtol=1e-9, atol=1e-13 * max(values)) and len(found) == len(expected)
    assert np.allclose(vectors @ vectors.T, np.eye(len(found)), atol=1e-12)
    assert np.allclose(vectors @ matrix, found[:, None] * vectors, atol=1e-12 * max(values))

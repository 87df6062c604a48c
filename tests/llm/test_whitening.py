"""Whitening against plain sums in whole numbers and a plain eigenvalue problem."""

import math
from fractions import Fraction

import numpy as np
import pytest

from ordermill.llm import queries as text_queries
from ordermill.llm import whitening
from tests.conftest import TEST_DATA

NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute(rows, components=8):
    """Per row and component its values, from rows of one length with finite entries."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, dims = len(x), len(x[0])
    total = [sum(r[j] for r in x) for j in range(dims)]
    away = [[n * r[j] - total[j] for j in range(dims)] for r in x]
    spread = np.array([[float(Fraction(sum(r[i] * r[j] for r in away), n**3))
                        for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(spread)
    order = np.argsort(-values)[:components]
    white = (np.array(away, float) / n) @ (axes[:, order] / np.sqrt(values[order]))
    return [(rows[i][0], k + 1, n, sum(a * a for a in away[i]), white[i, k],
             values[order[k]] / spread.trace())
            for i in range(n) for k in range(len(order))]


def same(found, expected):
    key = lambda r: (r[0] is None, r[0], r[1])
    found, expected = sorted(found, key=key), sorted(expected, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    for k in {r[1] for r in expected}:
        f = np.array([r[4] for r in found if r[1] == k])
        e = np.array([r[4] for r in expected if r[1] == k])
        sign = np.sign(f @ e)
        assert np.allclose(f, sign * e, atol=1e-6)
    assert np.allclose([r[5] for r in found], [r[5] for r in expected], rtol=1e-6)
    assert all(r[6] < 1e-6 for r in found)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, n long, component int, "
                                 "vector string").repartition(3)


def table(result):
    assert result.columns == NAMES
    return [tuple(r) for r in result.collect()]


def vectors(n, dims=10, seed=1):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, dims)) @ np.diag(np.linspace(1, 3, dims))
    return [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(mixed)]


def test_query_on_the_given_table(spark):
    given = spark.read.parquet(f"{TEST_DATA}/embeddings.parquet").collect()
    assert len({r.vec_id for r in given}) == len(given)
    result = text_queries.queries()["op13_embedding_whitening"](spark, TEST_DATA)
    same(table(result), brute([(r.vec_id, r.embedding) for r in given]))


def test_blocks_and_tasks_add_up(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 70)
    rows = vectors(500)
    same(table(whitening.whiten(frame(spark, rows))), brute(rows))


@pytest.mark.parametrize("rows,dims,high", [(1, 3, 5), (63, 4, 1000), (64, 2, 2**40), (130, 5, 2),
                                            (200, 3, 2**49), (65, 1, 1)])
def test_cross_products_are_exact(rows, dims, high):
    numbers = np.random.default_rng(rows).integers(-high, high, (rows, dims))
    exact = numbers.astype(object).T @ numbers.astype(object)
    assert (whitening.cross_products(numbers) == exact).all()


def test_bad_rows_leave_and_copies_count(spark):
    rows = vectors(60)
    odd = [(100, None), (101, [None] * 10), (102, [float("nan")] + [0.0] * 9),
           (103, [float("inf")] * 10), (104, [1.0]), (105, []), (106, [3e38] + [0.0] * 9)]
    copies = [(7, rows[7][1]), (None, rows[8][1])]
    found = table(whitening.whiten(frame(spark, rows + odd + copies)))
    expected = brute(rows + copies)
    # Rows of one id tie, so they are compared as sums.
    assert len(found) == len(expected)
    assert {r[0] for r in found} == {r[0] for r in expected}
    single = [r for r in found if r[0] not in (7, None)]
    same(single, [r for r in expected if r[0] not in (7, None)])


def test_rank_below_the_number_of_components(spark):
    rows = [(i, [float(i % 5), float(i % 3), 1.0, float(i % 5)]) for i in range(30)]
    found = table(whitening.whiten(frame(spark, rows)))
    assert {r[1] for r in found} == {1, 2, 3, 4}
    assert all((r[4] is None) == (r[1] > 2) for r in found)
    assert all(r[5] == 0 for r in found if r[1] > 2)
    assert max(r[6] for r in found) < 1e-9
    white = np.array([[r[4] for r in sorted(found) if r[1] == k] for k in (1, 2)])
    assert np.allclose(white @ white.T / 30, np.eye(2))


def test_equal_rows_single_rows_and_no_rows(spark):
    found = table(whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])))
    assert sorted(found) == [(i, k, 2, 0, None, 0.0, None) for i in (1, 2) for k in (1, 2)]
    assert table(whitening.whiten(frame(spark, [(None, [0.5])]))) == [
        (None, 1, 1, 0, None, 0.0, None)]
    assert table(whitening.whiten(frame(spark, []))) == []
    assert table(whitening.whiten(frame(spark, [(1, None)]))) == []
    assert table(whitening.whiten(frame(spark, [(1, [])]))) == []


def test_large_entries(spark):
    rows = [(i, [float(2**30 * i), float(i * i)]) for i in range(40)]
    found = sorted(table(whitening.whiten(frame(spark, rows, "double"))))
    expected = sorted(brute(rows))
    assert [r[3] if r[3] < 2**63 else None for r in expected] == [r[3] for r in found]
    assert any(r[3] is None for r in found)

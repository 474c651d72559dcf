import math

import numpy as np
import pytest

from sigweave.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, node string"


def brute(rows, k=20):
    ok = {i: np.array(v, float) for i, v, *_ in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v)}
    out = {}
    for q in (i for i in ok if i % 20 == 0):
        out[q] = sorted(((-float(ok[q] @ v), i) for i, v in ok.items() if i != q))[:k]
    return out


def test_recall_scores_and_order(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((6, 16))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] * (1 + i % 3) + rng.standard_normal(16)], 0, 0.0, "") for i in range(800)]
    rows += [(i, rows[40][1], 0, 0.0, "") for i in range(1000, 1300)]  # a group of copies, queries among them
    rows += [(2000, None, 1, 1.0, ""), (2020, [0.0] * 16, 1, 1.0, ""), (2040, [float("nan")] * 16, 1, 1.0, ""), (2060, [None] * 16, 1, 1.0, ""), (None, rows[3][1], 1, 1.0, ""), (7, rows[7][1], 1, 1.0, "")]
    rows += [(3000 + i, [1.0, float(i)], 0, 0.0, "") for i in range(4)]  # vectors of another length are searched among themselves
    got = {}
    for r in sorted(ann.nearest(spark.createDataFrame(rows, SCHEMA)).collect()):
        got.setdefault(r.query_id, []).append(r)
    assert [(r.rank, r.vec_id, r.score) for r in got.pop(3000)] == [(1, 3001, 1.0), (2, 3002, 1.0), (3, 3003, 1.0)]
    want = brute([r for r in rows if (r[0] or 0) < 3000])
    assert set(got) == set(want)
    hits = 0
    for q, best in want.items():
        assert [r.rank for r in got[q]] == list(range(1, 21)) and q not in {r.vec_id for r in got[q]}
        keys = [(-r.score, r.vec_id) for r in got[q]]
        assert all(a[0] < b[0] + 1e-9 for a, b in zip(keys, keys[1:], strict=False))
        hits += len({i for _, i in best} & {r.vec_id for r in got[q]})
    assert hits / (20 * len(want)) > 0.9


def test_few_rows_give_all(spark):
    rows = [(i, [1.0, float(i)], 0, 0.0, "") for i in range(6)]
    got = ann.nearest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(got)] == [(0, i, i, 1.0) for i in range(1, 6)]
    assert ann.nearest(spark.createDataFrame(rows[:1], SCHEMA)).count() == 0
    assert ann.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ids_with_several_vectors(spark):
    rows = [(0, [1.0, 0.0], 0, 0.0, ""), (0, [0.0, 1.0], 0, 0.0, ""), (1, [2.0, 0.0], 0, 0.0, ""), (1, [0.0, 3.0], 0, 0.0, ""), (1, [0.0, 3.0], 0, 0.0, ""), (2, [0.0, 1.0], 0, 0.0, "")]
    got = sorted(map(tuple, ann.nearest(spark.createDataFrame(rows, SCHEMA)).collect()))
    first = [(0, 1, 1, 2.0), (0, 2, 1, 0.0), (0, 3, 2, 0.0)]
    second = [(0, 1, 1, 3.0), (0, 2, 2, 1.0), (0, 3, 1, 0.0)]
    assert got == sorted(first + second)


def recall(spark, x, settings=ann.Settings()):
    rows = [(i, [float(np.float32(c)) if abs(c) < 1e30 else float(c) for c in v], 0, 0.0, "") for i, v in enumerate(x)]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, SCHEMA.replace("float", "double", 1)), settings=settings).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(rows)
    return sum(len({i for _, i in best} & got[q]) for q, best in want.items()) / (20 * len(want))


@pytest.mark.parametrize("outliers, ratio", [(30, 300.0), (1, 1e200)])
def test_outlier_lengths(spark, outliers, ratio):
    x = np.random.default_rng(2).standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[1 : 1 + outliers] *= ratio
    assert recall(spark, x) > 0.9


def test_many_dimensions_without_clusters(spark):
    x = np.random.default_rng(3).standard_normal((1200, 768))
    assert recall(spark, x) > 0.9


def test_parts_agree(spark):
    ids = [0, 1, 5, 2**40 + 3, -1, -(2**50), 2**63 - 1, -(2**63)]
    got = spark.createDataFrame([(i,) for i in ids], "node bigint").select(ann._part("node", 13)).collect()
    assert [r[0] for r in got] == ann._parts_of(np.array(ids, np.int64), 13).tolist()
    assert ann.part_count(51_300, 64, ann.Settings()) == 13 and ann.part_count(10**9, 64, ann.Settings()) > 10_000


def test_lists_grow_with_nodes():
    s = ann.Settings()
    assert s.grown(s.beam, 1000) == s.beam < s.grown(s.beam, 200_000) < s.grown(s.beam, 10**8)


def test_long_lists(spark):
    """Lists longer than what is scored again by default."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(8)], 0, 0.0, "") for i in range(600)]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, SCHEMA), k=100).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute(rows, 100)
    assert set(got) == set(want) and {len(v) for v in got.values()} == {100}
    assert sum(len({i for _, i in best} & set(got[q])) for q, best in want.items()) > 0.95 * 100 * len(want)

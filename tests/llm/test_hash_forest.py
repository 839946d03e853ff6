import numpy as np
import pytest
from pyspark.sql import functions as F

from celltide.llm import hash_forest as h

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def _vectors():
    rng = np.random.default_rng(4)
    rows = []
    centres = rng.standard_normal((12, 16))
    for i in range(600):
        v = (centres[i % 12] + 0.4 * rng.standard_normal(16)).astype(np.float32)
        rows.append((i, [float(x) for x in v], 1))
    hot = rows[100][1]
    rows += [(1000 + i, hot, 1) for i in range(300)]  # one vector that a third of the rows have
    rows += [(2000, [2 * x for x in hot], 1), (2001, [0.0] * 16, 1), (2002, None, 1), (2003, [None] * 16, 1),
             (2004, [float("nan")] + [1.0] * 15, 1), (2005, [], 1), (None, hot, 1), (2050, [1.0, 2.0], 1),
             (2051, [2.0, 1.0], 1), (1003, hot, 1)]
    return rows


def _exact(rows, every):
    good = {}
    for i, v, _ in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            good.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for q in good:
        if q % every:
            continue
        found = []
        for i, vs in good.items():
            for v in vs:
                if i != q and len(v) == len(good[q][0]):
                    a = good[q][0]
                    found.append((-round(float(a @ v / np.sqrt((a @ a) * (v @ v))), 9), i))
        out[q] = sorted(set(found))[:5]
    return out


@pytest.fixture(scope="module")
def found(spark):
    rows = _vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    out = h.HashForest(df, F.col("vec_id") % 50 == 0, block=128, candidates=4000).search()
    got = {}
    for r in out.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return rows, {q: sorted(v) for q, v in got.items()}


def test_answers(found):
    rows, got = found
    exact = _exact(rows, 50)
    assert set(got) == set(exact)
    hit = 0
    for q, best in exact.items():
        assert [r for r, _, _ in got[q]] == list(range(1, len(best) + 1))
        hit += len({i for _, i in best} & {i for _, i, _ in got[q]})
        assert all(a[2] >= b[2] for a, b in zip(got[q], got[q][1:]))
    assert hit >= 0.95 * sum(map(len, exact.values()))


def test_hot_vector_and_ties(found):
    _, got = found
    # Among equal vectors the smallest ids come first, and the query itself is left out.
    assert [i for _, i, _ in got[1000]] == [100, 1001, 1002, 1003, 1004]
    assert [i for _, i, _ in got[100]] == [1000, 1001, 1002, 1003, 1004]
    assert got[2050] == [(1, 2051, pytest.approx(0.8))]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert h.HashForest(df, F.col("vec_id") % 50 == 0).search().collect() == []


def test_prefix_length():
    a, b = np.array([0b1011, 0]), np.array([0b1011, 0b1000, 0b0011, 0])
    assert h._depth(a, b, 4).tolist() == [[4, 2, 0, 0], [0, 0, 2, 4]]
    big = np.array([(1 << 48) - 1])
    assert h._depth(big, np.array([0, (1 << 48) - 2]), 48).tolist() == [[0, 47]]


def test_recall_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), 0) for r in table.collect()]
    exact = [(q, i) for q, best in _exact(rows, 50).items() for _, i in best]
    truth = spark.createDataFrame(exact, "query_id BIGINT, vec_id BIGINT")
    assert h.recall(h.op3_hash_forest(spark, sf), truth) >= 0.9


def _by_query(found):
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    return {q: [i for _, i in sorted(v)] for q, v in got.items()}


def test_a_prefix_is_followed_over_all_its_blocks(spark):
    """A query that asks for all places sees all of them, however many blocks they fill."""
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.standard_normal(24).astype(np.float32)], 1) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = h.HashForest(df, F.col("vec_id") % 50 == 0, trees=2, block=16, candidates=2 * 900).search()
    assert _by_query(found) == {q: [i for _, i in best] for q, best in _exact(rows, 50).items()}


def test_family_with_equal_strings(spark):
    """Near copies with the same strings in every tree fill many blocks; each finds its own nearest ones."""
    rng = np.random.default_rng(8)
    one = rng.standard_normal(8)
    rows = [(i, [float(x) for x in one + 1e-4 * rng.standard_normal(8)], 1) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT")
    found = _by_query(h.HashForest(df, F.col("vec_id") % 50 == 0, trees=4, bits=16, block=16, candidates=100).search())
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for q, best in found.items():
        far = ((x - x[q]) ** 2).sum(axis=1)  # cosines this near to 1 are all alike in single precision
        far[q] = 9
        assert len({*best} & {*np.argsort(far)[:5].tolist()}) >= 4
    assert len(found) == 12


def test_places_grow_with_the_table():
    assert h.places(500) == 60_000 and h.places(10**6) == 800_000 and h.places(10**8) == 80_000_000


def test_broadcasts_load_without_the_package(spark, tmp_path):
    """Broadcasts are pickled by name, so they must hold nothing of this package."""
    import pickle
    import subprocess
    import sys

    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    shapes, _ = h.HashForest(table, F.col("vec_id") % 50 == 0)._shapes()
    (tmp_path / "value.pkl").write_bytes(pickle.dumps(shapes))
    code = "import pickle, importlib.util as u; assert u.find_spec('celltide') is None; assert pickle.load(open('value.pkl', 'rb'))"
    subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, check=True, timeout=120)

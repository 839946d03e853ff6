import random
import tracemalloc
from math import comb

import numpy as np
import pyarrow as pa

from celltide.llm import jaccard_join as j
from celltide.llm.components import components as connected
from tests.llm.helpers import awkward, components, empty, prose, same, table


def _found(spark, rows):
    return [tuple(r) for r in j.jaccard_components(table(spark, rows)).collect()]


def test_awkward_rows(spark):
    rows = awkward()
    same(_found(spark, rows), components(rows))


def test_sets_about_the_boundary(spark):
    rng = random.Random(3)
    rows = []
    for k in range(70):  # small sets that differ in a word or two, from 1 to 40 words
        w = prose(1 + k % 3, 4 + k % 37, 50).split(" ")
        for _ in range(k % 3):
            w[rng.randrange(len(w))] = f"e{rng.randrange(4)}"
        rows.append((k, " ".join(w), "en", "a", 0, (1,), "x"))
    same(_found(spark, rows), components(rows))


def test_family_without_a_common_centre(spark):
    """A chain: each text is near the next one only."""
    w = prose(9, 100).split(" ")
    rows = []
    for k in range(14):
        rows.append((50 - k, " ".join(w), "en", "a", 0, (1,), "x"))
        w = w[2:] + [f"new{k}", f"word{k}"]
    same(_found(spark, rows), components(rows))


def test_empty_table(spark):
    assert _found(spark, []) == []


def test_one_of_each_group_stays(spark):
    rows = awkward()
    kept = j.keep_one(table(spark, rows))
    assert kept.schema == table(spark, rows).schema
    got = [(r.doc_id, r.text) for r in kept.collect()]
    expected = components(rows)
    full = {}
    for r, (_, size, root) in zip(rows, expected):
        if size:
            order = (r[0] is None, r[0] or 0)
            full.setdefault(root, []).append((order, r[0], r[1]))
    best = [min(group)[1] for group in full.values()]
    assert sorted(map(repr, (i for i, t in got if (t or "").strip()))) == sorted(map(repr, best))
    blank = [r[0] for r in rows if not (r[1] or "").strip()]
    assert sorted(map(repr, (i for i, t in got if not (t or "").strip()))) == sorted(map(repr, blank))
    assert j.keep_one(empty(spark)).collect() == []


def test_different_texts_stay_whatever_their_ids(spark):
    """Texts without doc_id, or of one doc_id, that are linked with nothing are no copies of each other."""
    a, b, c, d, e = (prose(k, 50) for k in range(30, 35))
    rows = [(None, a), (None, b), (None, b + " tail"), (7, c), (7, d), (8, d + " tail"), (-1, e)]
    kept = j.keep_one(table(spark, [(*r, "en", "a", 0, (1,), "x") for r in rows]))
    got = {(r.doc_id, r.text.removesuffix(" tail")) for r in kept.collect()}
    assert kept.count() == 5 and got == {(None, a), (None, b), (7, c), (7, d), (-1, e)}


def test_least_overlaps():
    for n in range(1, 60):
        for m in range(1, 60):
            c = j.overlap(n, m)
            assert 100 * c >= 80 * (n + m - c) and 100 * (c - 1) < 80 * (n + m - c + 1)
        assert j.prefix(n) == n - j.overlap(n, min(j.partners(n))) + 1 or j.prefix(n) >= 1
        assert j.subsets(n) >= comb(n, n)


def test_boundary_follows_the_sizes():
    assert j.boundary({}) == 0
    assert j.boundary({n: 100 for n in range(1, 100)}) == max(
        n for n in range(1, 100) if j.subsets(n) < j.LIST_COST * j.prefix(n))
    assert j.boundary({40: 5}) == 0


def test_components_of_a_long_path(spark):
    n = 60
    edges = [(i, i + 1) for i in range(n)] + [(100, 101), (102, 101), (7, 7), (None, 3), (100, 101)]
    got = dict(connected(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect())
    assert got == {i: 0 for i in range(n + 1)} | {100: 100, 101: 100, 102: 100}
    assert connected(spark.createDataFrame([], "a BIGINT, b BIGINT")).collect() == []


def test_sketches_never_differ_more_than_the_sets():
    rng = np.random.default_rng(5)
    for _ in range(300):
        both, x, y = (rng.integers(0, 1 << 63, rng.integers(lo, 700), dtype=np.uint64) for lo in (1, 0, 0))
        far = j.differ(j.sketch(np.concatenate([both, x])), j.sketch(np.concatenate([y, both])))
        assert far <= len(x) + len(y) and far % 2 == (len(x) + len(y)) % 2
    one = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    assert j.differ(j.sketch(one), j.sketch(one[::-1])) == 0
    assert j.differ(j.sketch(one[:200]), j.sketch(one[200:])) > 100  # unrelated sets are ruled out
    assert len(j.sketch(one[:1])) == 8


def test_many_texts_with_one_passage(spark):
    """A passage that many unrelated texts share brings them together; their sketches part them again."""
    shared = prose(1, 30)
    rows = [(k, prose(100 + k, 60) + " " + shared, "en", "a", 0, (1,), "x") for k in range(60)]
    rows += [(100 + k, rows[k][1] + " end", "en", "a", 0, (1,), "x") for k in range(3)]
    same(_found(spark, rows), components(rows))


def test_memory_of_a_batch():
    """What is made of a few MB of text at a time does not grow with them."""
    n = 400
    ids = pa.array(range(n), pa.int64())
    batch = pa.record_batch({
        "doc_id": ids, "text_id": ids, "text": pa.array([prose(i, 1000, 10**6) for i in range(n)])})
    tracemalloc.start()
    try:
        for _ in j._describe(5)([batch]):
            pass
        assert tracemalloc.get_traced_memory()[1] < 30 << 20
    finally:
        tracemalloc.stop()

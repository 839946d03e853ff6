import random

import numpy as np
import pytest

from celltide.llm import suffix_dedup as s
from celltide.llm import textops
from tests.conftest import plan
from tests.llm.helpers import awkward, empty, table, without_repeats

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*COLUMNS).collect())))


def test_against_all_windows(spark):
    rows = awkward()
    rng = random.Random(5)
    base = "".join(rng.choice("abc é") for _ in range(1500))
    for i in range(6):  # copies of passages of about the least length, cut and edited at odd places
        a, b = rng.randrange(600), rng.randrange(380, 900)
        rows.append((200 + i, f"{i}" * (i * 7) + base[a : a + b] + f"z{i}" + base[:399], "en", "a", 0, (1,), "q"))
    got = s.repeated_spans(table(spark, rows))
    assert _rows(got) == sorted(map(repr, without_repeats(rows)))


def test_spans_are_those_removed(spark):
    for r in s.repeated_spans(table(spark)).collect():
        assert sum(x.end - x.start for x in r.spans) == r.n_removed and len(r.spans) == r.n_spans
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_number_of_batches_does_not_matter(spark):
    one = s.repeated_spans(table(spark), batches=1)
    assert _rows(one) == _rows(s.repeated_spans(table(spark), batches=5))


def test_empty_table(spark):
    assert s.repeated_spans(empty(spark)).collect() == []


def test_short_lengths_are_refused(spark):
    with pytest.raises(ValueError):
        s.repeated_spans(table(spark), length=100)


def test_levels_merge_geometrically(spark):
    family = s.SuffixFamily(spark, 2)
    rows = spark.range(40).selectExpr("id AS core", "id AS head", "id % 7 AS b")
    twice = []
    for k in range(7):
        twice += [r.core for r in family.add(rows.where(f"b = {k} OR core = 3")).collect()]
    assert [rank for rank, _ in family.levels] == [2, 1, 0]
    assert set(twice) == {3}
    level = spark.table(family.levels[0][1])
    assert "Exchange" not in plan(level.join(spark.table(family.levels[1][1]).hint("merge"), "core"))
    family.drop()


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(1)
    common = rng.integers(97, 100, 400).astype(np.uint8)
    h, g = textops.Hasher(), textops.Hasher(textops.BASE2)
    found = []
    for n in (0, 13, 500):
        data = np.concatenate([rng.integers(97, 123, n).astype(np.uint8), common, rng.integers(97, 123, 77).astype(np.uint8)])
        row, at, first, last, *_ = s.anchors(data, np.array([0, len(data)]), 400, h, g)
        k = np.flatnonzero((first <= n) & (n <= last))[0]
        found.append(at[k] - n)
    assert len(set(found)) == 1

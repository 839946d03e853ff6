from collections import Counter
from math import log

import pytest

from celltide.llm import mixing as m
from tests.llm.helpers import awkward, empty, prose, table, words


def _tokens(rows):
    out = Counter()
    for r in rows:
        out[r[3]] += len(words(r[1]))
    return out


def _many(sizes=(("big", 400), ("mid", 90), ("low", 25))):
    rows, k = [], 0
    for source, n in sizes:
        for _ in range(n):
            rows.append((k, prose(k, 5 + k % 17), "en", source, 0, (1,), "g"))
            k += 1
    return rows


def _found(spark, rows, **options):
    return m.mix(table(spark, rows), **options).select("doc_id", "source", "block", "place").collect()


def test_whole_blocks_and_the_head_of_one(spark):
    rows = _many()
    found = _found(spark, rows, repeats=2.5)
    tokens = _tokens(rows)
    big, low = tokens["big"], tokens["low"]
    power = 1 - log(2.5) / log(big / low)
    size = {r[0]: len(words(r[1])) for r in rows}
    for source, t in tokens.items():
        passes = (t / big) ** (power - 1)
        own = [r for r in found if r.source == source]
        whole = int(passes + 1e-9)
        ids = sorted(r[0] for r in rows if r[3] == source)
        for block in range(1, whole + 1):
            assert sorted(r.doc_id for r in own if r.block == block) == ids
        rest = (passes - whole) * t
        head = sorted((r.place, r.doc_id) for r in own if r.block == whole + 1)
        got = sum(size[i] for _, i in head)
        if rest > 1e-3:
            assert rest <= got < rest + 25
            assert got - size[head[-1][1]] < rest


def test_every_document_stays(spark):
    rows = _many()
    assert {r.doc_id for r in _found(spark, rows)} == {r[0] for r in rows}


def test_entropy_target(spark):
    tokens = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10), (None, 0)], "source STRING, tokens BIGINT")
    for goal in (0.5, 0.9, 1.05):
        power = m.exponent(tokens, repeats=None, entropy=goal)
        z = [(t / 1110) ** power for t in (1000, 100, 10)]
        w = [x / sum(z) for x in z]
        assert abs(-sum(x * log(x) for x in w) - goal) < 1e-6
    assert m.exponent(tokens, repeats=None, entropy=9.0) == 0.0
    assert m.exponent(tokens, repeats=None) == 1.0
    assert m.exponent(tokens, repeats=1e9) == 0.0
    assert abs(m.exponent(tokens, repeats=10.0) - 0.5) < 1e-9


def test_budget(spark):
    rows = _many()
    tokens = _tokens(rows)
    found = _found(spark, rows, budget=sum(tokens.values()) / 2, repeats=3.0)
    size = {r[0]: len(words(r[1])) for r in rows}
    assert abs(sum(size[r.doc_id] for r in found) - sum(tokens.values()) / 2) < 75


def test_awkward_rows(spark):
    rows = awkward()
    found = m.mix(table(spark, rows))
    assert {r.doc_id for r in found.collect()} == {r[0] for r in rows}
    assert m.mixed(table(spark, rows)).schema == table(spark, rows).schema
    assert m.mix(empty(spark)).collect() == []
    blank = [(i, None, "en", s, 0, (1,), "g") for i, s in ((1, "a"), (2, None))]
    assert m.mixed(table(spark, blank)).count() == 2


def test_weights_add_up(spark):
    tokens = spark.createDataFrame([("a", 10), ("b", 30), (None, 60)], "source STRING, tokens BIGINT")
    rows = m.weights(tokens, 0.5, budget=200.0).collect()
    assert sum(r.weight for r in rows) == pytest.approx(1)
    assert sum(r.passes * r.tokens for r in rows) == pytest.approx(200)

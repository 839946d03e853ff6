import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from celltide.llm import packing as p
from celltide.llm import textops
from celltide.session import materialize
from tests.llm.helpers import awkward, empty, table

TOKENIZER = Tokenizer.from_file(public_tokenizers.path(p.VOCABULARY))


def _ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def _encoded(texts):
    encoder, out = p.Encoder(), []
    for rows, data, at in textops.texts([pa.record_batch({"text": pa.array(texts, pa.string())})]):
        ids, ends = encoder.encode(data, at)
        out += [ids[ends[i] : ends[i + 1]].tolist() for i in range(len(rows))]
    return out


def test_ids_are_those_of_the_tokenizer():
    rng = random.Random(1)
    signs = "ab' s\n\t1_.,éÉ—½’ţ\x0b\x1c×÷"
    texts = ["", "it's we'll 'tis don't''s", "<|endoftext|> x", "漢字 カナ", "  \n ", " 'd'd 9's", "a'", "'", "É'll s'r"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += [r[1] for r in awkward()]
    texts += ["ab <|endoftext|> cd", "<|endoftext|>", "x" * 50 + "<|endoftext|><|endoftext|>\n", "<|endoftext", "|>", "<|endoftext|"]
    assert _ids("ab <|endoftext|> cd") == [397, 220, 50256, 22927]
    assert _encoded(texts) == [_ids(t) for t in texts]


def _places(rows, counts):
    """(sequence, offset, length) of all pieces by the plan."""
    table_ = np.array(sorted(rows), np.int64).reshape(-1, 5)
    length = np.repeat(list(counts), list(counts.values()))
    rank = np.concatenate([np.arange(c) for c in counts.values()])
    row = table_[p._find(table_, None, length, rank)]
    assert (row[:, 0] == length).all()
    nth = rank - row[:, 1]
    return list(zip(row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length, length))


def test_plans_are_gapless_and_tight():
    rng = random.Random(2)
    for _ in range(200):
        capacity = rng.choice([7, 30, 100, 2048])
        lengths = rng.sample(range(1, capacity + 1), min(capacity, rng.randint(1, 50)))
        counts = {n: rng.randint(1, 60) for n in lengths}
        bins = {}
        for sequence, offset, length in _places(p.plan(counts, capacity), counts):
            bins.setdefault(sequence, []).append((offset, length))
        for items in bins.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= capacity
            assert sum(3 * n > capacity for _, n in items) <= 2
        total, large = sum(n * c for n, c in counts.items()), sum(c for n, c in counts.items() if 2 * n > capacity)
        assert len(bins) <= max(large, 1.25 * total / capacity + 1) + sum(counts.values()) * 0.1


def test_plan_is_optimal_where_halves_must_match():
    assert max(r[2] + 1 for r in p.plan({1200: 3, 848: 3, 1024: 2}, 2048)) == 4
    assert p.plan({}, 2048) == []


def test_plan_does_not_grow_with_the_pieces():
    counts = {n: 10**9 + n for n in range(1, 2049)}
    assert len(p.plan(counts)) < 20_000


def test_pieces_of_awkward_rows(spark):
    rows = awkward()
    found = p.pack(table(spark, rows)).collect()
    expected = []
    for r in rows:
        ids = [*_ids(r[1]), 0]
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(map(repr, (tuple(x)[:5] for x in found))) == sorted(map(repr, expected))
    bins = {}
    for x in found:
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(x.length for x in found)
    assert len(bins) <= -(-total // 2048) + 1


def test_empty_table(spark):
    assert p.pack(empty(spark)).collect() == []


def test_other_vocabularies_by_path(spark):
    path = public_tokenizers.path(p.VOCABULARY)
    a = p.pack(table(spark), vocabulary=path).drop("sequence_id", "offset").collect()
    b = p.pack(table(spark)).drop("sequence_id", "offset").collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


class _Task:
    def partitionId(self):
        return 0


def _tokenized_here(monkeypatch, texts):
    """The rows that a task makes of a batch of texts, in this process."""
    monkeypatch.setattr(p.TaskContext, "get", staticmethod(_Task))
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    return [x.to_pylist() for x in p._tokenized(p.CAPACITY, p.VOCABULARY)(iter([batch]))]


def test_tasks_of_a_worker_share_the_encoder(monkeypatch):
    made, encoder = [], p.Encoder
    monkeypatch.setattr(p, "Encoder", lambda *a: made.append(a) or encoder(*a))
    first = _tokenized_here(monkeypatch, ["one two", "x <|endoftext|>", None])
    other = _tokenized_here(monkeypatch, ["more words", "two 漢字"])
    assert first == _tokenized_here(monkeypatch, ["one two", "x <|endoftext|>", None])
    assert other == _tokenized_here(monkeypatch, ["more words", "two 漢字"])
    assert len(made) <= 1


def test_a_task_holds_little_beside_its_batch(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(str(rng.randrange(10**4)) for _ in range(400)) for _ in range(2000)]
    _tokenized_here(monkeypatch, texts)
    tracemalloc.start()
    try:
        rows = sum(_tokenized_here(monkeypatch, texts), [])
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [(r["doc_id"], r["piece"], r["length"]) for r in rows] == [(i, 0, len(_ids(t)) + 1) for i, t in enumerate(texts)]
    assert most < 24 << 20


def test_counts_are_written_to_few_files(spark, monkeypatch):
    written = {}

    def noted(df, name="stage"):
        out = materialize(df, name)
        written[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(p, "materialize", noted)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    rows = [(i, "word " * i, "en", "web", 5 * i, (1,), "") for i in range(60)]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = p.pack(table(spark, rows)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((x.doc_id, x.length) for x in found) == [(i, len(_ids("word " * i)) + 1) for i in range(60)]
    assert written["counts"] <= spark.sparkContext.defaultParallelism

import hashlib

from celltide.llm import fingerprints as f
from tests.llm.helpers import awkward, empty, prose, table, words


def _expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return order


def test_edited_texts(spark):
    rows = [r for r in awkward() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())  # one row for each id, so that the next one is certain
    got = {r.doc_id: r for r in f.compare_neighbours(table(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: r[0])
    assert len(got) == len(order)
    for a, b in zip(order, order[1:] + order[:1]):
        t, n = a[1] or "", b[1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        r = got[a[0]]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.fingerprint != r.edited_fingerprint or r.near_edited == 1
    assert got[4].fingerprint == got[5].fingerprint and got[4].near_next == 1


def test_repeated_and_null_ids(spark):
    got = f.compare_neighbours(table(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in awkward())
    assert f.compare_neighbours(empty(spark)).collect() == []
    one = f.compare_neighbours(table(spark, awkward()[3:4])).collect()
    assert one[0].near_next == 1.0


def test_lexicon_counts_whole_texts(spark):
    rows = awkward(40)
    texts = [set(words(r[1])) for r in rows]
    count = {}
    for t in texts:
        for w in t:
            count[w] = count.get(w, 0) + 1
    for rare, common in ((0.0, 1.0), (0.05, 0.5)):
        low, high = max(1, rare * len(rows)), max(1, common * len(rows))
        band = f.lexicon(table(spark, rows), rare=rare, common=common)
        assert len(band) == sum(low <= n <= high for n in count.values())


def test_likeness_follows_the_share_of_terms(spark):
    a = prose(1, 400, 10**6)
    rows = [(0, a)]
    w = a.split(" ")
    for i, share in enumerate((0.9, 0.5, 0.1)):
        k = int(len(w) * share)
        rows.append((i + 1, " ".join(w[:k]) + " " + prose(50 + i, len(w) - k, 10**6)))
    docs = spark.createDataFrame(rows, "doc_id INT, text STRING")
    terms = f.lexicon(docs, rare=0.0, common=1.0)
    maker = f.Fingerprinter(terms, 256)
    made = maker.of(*f._joined([t for _, t in rows]))
    near = [f.likeness(made[0], m) for m in made[1:]]
    for got, share in zip(near, (0.9, 0.5, 0.1)):
        assert abs(got - share / (2 - share)) < 0.12
    assert near == sorted(near, reverse=True)


def test_columns_stay(spark):
    got = f.fingerprint(table(spark))
    assert got.columns == [*table(spark).columns, "fingerprint"] and got.count() == len(awkward())

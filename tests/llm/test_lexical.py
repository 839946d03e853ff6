import math
import re
from collections import Counter

from tests.llm.helpers import LOWER, awkward, empty, prose, table

from celltide.llm import lexical as x

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(rows, items, best=10):
    docs = [(r[0], Counter(terms(r[1]))) for r in rows]
    docs = [d for d in docs if d[1]]
    total, df = sum(sum(c.values()) for _, c in docs), Counter()
    for _, c in docs:
        df.update(c.keys())
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for doc, c in docs:
            m = 10 + 90 * sum(c.values()) * len(docs) // total
            score = sum(math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in wanted if t in c)
            if score > 0:
                found.append((-score, doc is not None, doc or 0, doc))
        out += [(item, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found, key=lambda f: f[:3])[:best])]
    return sorted(map(repr, out))


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id BIGINT, text STRING")


def asked():
    base = prose(1, 300).split(" ")
    return [(1, " ".join(base[:40])), (2, "One WORD x"), (3, None), (4, ""), (5, "nowhere?"), (6, "漢字 «q» IT'S ½ dön"),
            (7, prose(2, 160)), (8, prose(3, 50)), (9, prose(20, 60)), (9, "one"), (9, "one"), (None, "tail more"),
            (10, " ".join(prose(5, 900, 5000).split(" ")))]


def told(found):
    return sorted(repr(tuple(r)) for r in found.select("item_id", "rank", "doc_id", "score").collect())


def test_against_plain_scores(spark, monkeypatch):
    """Whole strata, and strata of many blocks with items in several sets and few postings at a time."""
    rows, want = awkward(40), plain(awkward(40), asked())
    assert len(want) > 50
    assert told(x.search(x.build(table(spark, rows)), items(spark, asked()))) == want
    monkeypatch.setattr(x, "PAIRS", 100)
    cut = x.build(table(spark, rows), block=150)
    assert cut.groupBy("m").count().where("count > 3").count()
    assert told(x.search(cut, items(spark, asked()), entries=40)) == want
    assert told(x.search(cut, items(spark, asked()), best=3)) == plain(rows, asked(), 3)


def test_copies_tie_by_id(spark):
    rows = [(1000 - k, "same text here", "en", "a", 0, (1,), "g") for k in range(300)] + awkward()
    found = x.search(x.build(table(spark, rows), block=64), items(spark, [(1, "same HERE")])).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [(k + 1, 701 + k) for k in range(10)]


def test_an_index_stays(spark, tmp_path):
    x.build(table(spark), path=str(tmp_path / "index"))
    again = spark.read.schema(x.INDEX).parquet(str(tmp_path / "index"))
    assert told(x.search(again, items(spark, asked()))) == plain(awkward(), asked())


def test_empty_tables(spark):
    assert x.search(x.build(empty(spark)), items(spark, asked())).collect() == []
    assert x.search(x.build(table(spark)), items(spark, [])).collect() == []
    nothing = [(1, None, "en", "a", 0, (1,), "g"), (2, " .", "en", "a", 0, (1,), "g")]
    assert x.search(x.build(table(spark, nothing)), items(spark, asked())).collect() == []


def test_blocks_are_left_out_by_their_bound(spark, monkeypatch):
    """Documents with all of the item's terms come first; long ones that hold one of them are not added up."""
    rows = [(k, "alpha beta gamma", "en", "a", 0, (1,), "g") for k in range(12)]
    rows += [(100 + k, "alpha " + "filler " * 200, "en", "a", 0, (1,), "g") for k in range(50)]
    index = x.build(table(spark, rows)).coalesce(1)
    best = x._Best(1, 10)
    best.add(*(x.np.array(v) for v in ([0] * 12, [5] * 12, list(range(12)))))
    best.settle()
    assert best.least.tolist() == [5]
    assert told(x.search(index, items(spark, [(1, "alpha beta gamma")]))) == plain(rows, [(1, "alpha beta gamma")])

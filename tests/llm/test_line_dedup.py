from collections import Counter

from celltide.llm import line_dedup as d
from tests.llm.helpers import awkward, empty, table


def _expected(rows, ratio, least):
    pages, seen = Counter(r[3] for r in rows), Counter()
    for r in rows:
        seen.update({(r[3], x.strip(" \t\r")) for x in (r[1] or "").split("\n") if x.strip(" \t\r")})
    often = {k for k, n in seen.items() if n >= least and n > ratio * pages[k[0]]}
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if (r[3], x.strip(" \t\r")) not in often]
        out.append((r[0], None if r[1] is None else "\n".join(kept), 0 if r[1] is None else len(lines),
                    0 if r[1] is None else len(lines) - len(kept)))
    return out


def _rows():
    out = awkward()
    for i in range(30):
        lines = [f"own {i}", "footer" if i % 3 else " footer\t", "", "rare" if i < 3 else "also own", "footer"]
        out.append((500 + i, "\n".join(lines), "en", None if i % 2 else "s", 0, (1,), "g"))
    return out


def test_against_plain_counts(spark):
    rows = _rows()
    for ratio, least in ((0.1, 5), (0.3, 2), (0.0, 1)):
        found = d.drop_lines(table(spark, rows), ratio=ratio, least=least).select(
            "row.doc_id", "kept", "n_lines", "n_dropped").collect()
        assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, _expected(rows, ratio, least)))


def test_columns_stay(spark):
    rows = _rows()
    found = d.without_lines(table(spark, rows))
    assert found.schema == table(spark, rows).schema and found.count() == len(rows)


def test_empty_table(spark):
    assert d.without_lines(empty(spark)).collect() == []

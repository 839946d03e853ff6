import math
import textwrap

import pytest

from celltide.llm import licenses as w
from tests.conftest import plan
from tests.llm.helpers import awkward, empty, prose, table


def _rows():
    rows = awkward()
    for i in range(120):
        rows.append((1000 + i, prose(i, 30) + "\n" + prose(300 + i, 25), "en", "a", 0, (1,), "g"))
    for i, (family, texts) in enumerate(w.TEMPLATES.items()):
        rows.append((2000 + i, prose(900 + i, 20) + "\n" + texts[0] + "\n\n" + prose(800 + i, 9), "en", "a", 0, (1,), family))
    rows.append((2100, "The licence of the driver, version of the work, under the name of software and source.", "en", "a", 0, (1,), "g"))
    return rows


@pytest.fixture(scope="module")
def scanned(spark):
    docs = table(spark, _rows())
    scan = w.LicenseScan(sample=200).fit(docs)
    return scan, scan.scan(docs)


def test_families(scanned):
    _, found = scanned
    got = {r.doc_id: r for r in found.collect() if r.confirmed}
    expected = {2000 + i: f for i, f in enumerate(w.TEMPLATES)}
    assert {i: r.family for i, r in got.items()} == expected
    assert all(r.paragraph == 1 and r.probability >= 0.5 and r.alike == 1 for r in got.values())


def test_unknown_stays_unknown(scanned):
    _, found = scanned
    assert found.where("confirmed AND doc_id < 2000 OR doc_id = 2100").count() == 0


def test_no_python_in_the_scan(scanned):
    _, found = scanned
    assert not any(x in plan(found) for x in ("Python", "Arrow", "Pandas"))


def test_empty_table_and_null_texts(spark, scanned):
    scan, _ = scanned
    assert scan.scan(empty(spark)).collect() == []
    nulls = table(spark, [(1, None, None, None, 0, (1,), "g"), (None, "Released under the MIT License.", None, None, 0, (1,), "g")])
    assert [(r.doc_id, r.family) for r in scan.scan(nulls).collect()] == [(None, "MIT")]
    assert w.LicenseScan(sample=10).fit(empty(spark)).scan(nulls).count() == 1


def test_notices_wrapped_over_lines(spark, scanned):
    """Each long template in lines of 72 and of 30 columns, with comment signs, among other lines."""
    scan, _ = scanned
    rows, expected, k = [], set(), 0
    for family, texts in w.TEMPLATES.items():
        for text in texts:
            for width, sign in ((72, ""), (72, " * "), (30, "// ")):
                lines = textwrap.wrap(text, width)
                if len(lines) > 1:
                    body = [prose(k, 12), prose(k + 50, 9), *(sign + x for x in lines), "", prose(k + 70, 9)]
                    rows.append((k, "\n".join(body), "en", "a", 0, (1,), "g"))
                    expected.add((k, family))
                    k += 1
    found = scan.scan(table(spark, rows)).where("confirmed").collect()
    assert k > 20 and {(r.doc_id, r.family) for r in found} == expected
    assert len(found) == k and all(r.paragraph >= 2 for r in found)


def test_counts_on_the_given_documents(spark):
    """Every line with one of these phrases, and no other, is a confirmed licence."""
    sf = "/root/testdata/sf0.001"
    lines = [
        (r.doc_id, i) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()
        for i, x in enumerate((r.text or "").split("\n"))
        if any(p in x.lower() for p in ("licensed under", "rights reserved", "mit license"))
    ]
    found = w.op6_license_scan(spark, sf).where("confirmed").collect()
    assert sorted((r.doc_id, r.paragraph) for r in found) == sorted(lines)


def test_lines_with_words_are_counted_without_their_words(spark):
    from celltide.llm.licenses import LicenseScan

    texts = ["a\n\n .. \n.\n.5\n5.\n...7", "+\nÄÖ\nK\nİ\n-.-\n\t\nA.b\r\n\r", None, "", "\n", "é é\n中文\nx" * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    scan = LicenseScan()
    assert scan.count_lines(docs) == scan.paragraphs(docs).where("size(w) > 0").count() == 11


def _numbered(texts):
    return [(i, x, "en", "a", 0, (1,), "g") for i, x in enumerate(texts)]


def test_words_are_counted_in_all_paragraphs(spark):
    """As plain Python counts them, in many times as many paragraphs as the unknown ones weigh."""
    words = sorted({x for texts in w.TEMPLATES.values() for t in texts for x in t.lower().replace(",", " ").split() if x.isalpha()})
    lines = [prose(i, 6) + "".join(f" {x} {prose(i + 7, 1)}" for k, x in enumerate(words) if i % (3 + 5 * k) == 0) for i in range(900)]
    scan = w.LicenseScan(sample=10).fit(table(spark, _numbered(["\n".join(lines[i:i + 30]) for i in range(0, 900, 30)])))
    common = {x for x in words if sum(x in line.split() for line in lines) > w.COMMON * 900}
    assert 10 < len(common) < len(words) and set(words) - set(scan.vocabulary[1]) == common


def test_a_phrase_of_some_paragraphs_is_no_licence(spark):
    """One paragraph in 40 has words of a notice, too few of them; all are learned from, though they weigh as 20."""
    lines = [prose(i, 12) + (" source code form is subject " if i % 40 == 0 else " ") + prose(i + 9, 5) for i in range(1200)]
    texts = ["\n".join(lines[i:i + 40]) for i in range(0, 1200, 40)]
    docs = table(spark, _numbered([*texts, prose(7, 9) + "\n" + w.TEMPLATES["MPL-2.0"][0]]))
    found = w.LicenseScan(sample=10).fit(docs).scan(docs).collect()
    assert [(r.doc_id, r.paragraph, r.family, r.confirmed) for r in found] == [(30, 1, "MPL-2.0", True)]


def test_notices_of_common_words_alone(spark):
    """All words of a notice are common ones; its bigrams tell it, on one line and on two."""
    lines = [f"{prose(i, 4)} all {prose(i + 1, 3)} rights {prose(i + 2, 3)} reserved {prose(i + 3, 2)}" for i in range(400)]
    texts = ["\n".join(lines[i:i + 20]) for i in range(0, 400, 20)]
    texts += [prose(3, 9) + "\nAll rights reserved.\n" + prose(4, 9), prose(5, 9) + "\n\n-- all\n-- rights reserved\n\n" + prose(6, 9)]
    docs = table(spark, _numbered(texts))
    found = w.LicenseScan(sample=200).fit(docs).scan(docs).where("confirmed").collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in found} == {(20, 1, "all-rights-reserved"), (21, 2, "all-rights-reserved")}


def test_joins_begin_with_common_words(spark):
    """The first lines of a notice hold common words only, and without them too little is left of it."""
    lines = [f"{prose(i, 4)} this {prose(i + 1, 3)} program {prose(i + 2, 3)} is {prose(i + 3, 2)} free {prose(i, 3)}" for i in range(400)]
    texts = ["\n".join(lines[i:i + 20]) for i in range(0, 400, 20)]
    notice = ["This program", "is free", "software: you can redistribute", "it and/or modify it under the", "terms of the GNU General Public"]
    docs = table(spark, _numbered([*texts, "\n".join([prose(3, 9), "", *notice, "", prose(4, 9)])]))
    found = w.LicenseScan(sample=200).fit(docs).scan(docs).where("confirmed").collect()
    assert [(r.doc_id, r.paragraph, r.family) for r in found] == [(20, 2, "GPL")]


def test_notices_that_follow_each_other(spark, scanned):
    """Notices of one family without a line between them; in some of them words have changed."""
    scan, _ = scanned
    whole = w.TEMPLATES["GPL"][1]
    some = whole.replace("redistribute it and/or modify", "copy or change")
    for many in ([some, whole], [whole, some], [some, whole, some, whole, whole]):
        body, at = [prose(1, 9)], []
        for text in many:
            at.append(len(body))
            body += textwrap.wrap(text, 60)
        found = scan.scan(table(spark, _numbered(["\n".join(body)]))).where("confirmed").collect()
        assert [(r.paragraph, r.family) for r in sorted(found, key=lambda r: r.paragraph)] == [(i, "GPL") for i in at]


def test_joins_hold_one_of_the_rarest_bigrams(scanned):
    """No choice of as many bigrams as confirm a template is without one of those that tell where joins are formed."""
    scan, _ = scanned
    for texts in scan.bigrams.values():
        for t in texts:
            others = [g for g in t if g not in scan.anchors]
            assert len(others) / len(t) < scan.alike


def test_the_threshold_is_the_exact_one(spark):
    values = [(((i * 7919) % 1000) / 1000 + (i % 3) * 1e-12, 1 + i % 5) for i in range(700)] + [(1.0, 2), (0.0, 3)]
    every = sorted(t for t, n in values for _ in range(n))
    for share in (0.0005, 0.5, 0.9, 0.999, 1.0):
        assert w.reached(spark.createDataFrame(values, "t DOUBLE, n BIGINT"), share) == every[math.ceil(share * len(every)) - 1]
    assert w.reached(spark.createDataFrame([], "t DOUBLE, n BIGINT"), 0.9) is None

import hashlib
import re

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan
from tests.llm.helpers import SCHEMA, awkward, empty, table

from celltide.llm import personal as p
from celltide.llm.frames import load

SF = "/root/testdata/sf0.01"


def _luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d *= 1 + k % 2
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _passes(kind, value):
    d = re.sub("[^0-9]", "", value)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in value.split(".")),
            "card": lambda: 16 <= len(d) <= 19 and _luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]()


def plain(text):
    """Spans of the base kinds by the plain patterns."""
    return [f"{k}:{m.start()}:{m.end()}" for k, x in p.BASE.items()
            for m in re.finditer(x, text or "") if _passes(k, m.group())]


def card(prefix):
    return next(prefix + str(k) for k in range(10) if _luhn(re.sub("[^0-9]", "", prefix + str(k))))


CASES = [
    "a@b.c_d@e.f.@g.h", "x..y%+-@a-b.c-d.e.", "a@b a@@b.c a@b..c 漢@b.cc é.x@ü.de", "😀 a@b.co 😀 1.2.3.4",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.0255.3.0000004 1.2.3 999.1.2.3.4", "1.2.3.4." * 700, "@" * 5000 + "a.b" * 900,
    card("411111111111111"), card("4111 1111-1111 111") + "-" + card("510510510510510"), card("411111111111111") + "  5",
    "0000000000000000", "1-" * 9000 + "1", "9 " * 8000 + "x", "+49 (30) 1234-567.8 +1 +12 +1234567 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "+1..........2 +4 9..(((", "a" * 8000 + "@b.c", "z" * 8000, "1" * 8000, ("m@n.op " + card("4532015112830") + " ") * 900,
    "+" * 3000 + "123456789", "a@b." * 2000 + "c", "1.1.1.1@a.b 10.0.0.1:80", " +33 1 23 45 67 89\u0085",
]


def test_base_kinds_against_plain_patterns(spark):
    rows = [(i, t) for i, t in enumerate([*CASES, *[r[1] for r in awkward()]])]
    found = p.find(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), kinds=p.KINDS[:4])
    got = {r[0]: (r[1] or "").split(",") if r[1] else [] for r in found.select(
        "row.doc_id", p.as_list(F.col("spans"))).collect()}
    values = {r["doc_id"]: r["ok"] for r in found.select("row.doc_id", F.forall("spans", lambda s: (
        s["value"] == F.substring(F.col("row.text"), s["start"].cast("int") + 1, F.length(s["value"])))).alias("ok")
    ).where("doc_id < 4").collect()}
    assert all(values.values())
    for i, text in rows:
        assert got[i] == plain(text), (i, (text or "")[:80])
    assert sum(map(len, got.values())) > 2000


def test_very_long_runs(spark):
    """Texts on which the plain patterns would go back and forth for hours, or run out of stack."""
    n = 2_000_000
    rows = [(1, "a" * n + "@b.c"), (2, "z" * n), (3, "1" * n), (4, "1-" * n + "1"), (5, "7." * n + "7"),
            (6, "a@" * n), (7, "x@y." + "y." * n + "z"), (8, ("+1 " * n))]
    found = p.find(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), kinds=p.KINDS[:4])
    got = {r[0]: (r[1], r[2]) for r in found.select(
        "row.doc_id", F.size("spans"), F.substring(p.as_list(F.slice("spans", 1, 2)), 1, 40)).collect()}
    assert got == {
        1: (1, f"email:0:{n + 4}"), 2: (0, ""), 3: (0, ""), 4: (0, ""), 5: ((n + 1) // 4, "ip:0:7,ip:8:15"), 6: (0, ""),
        7: (1, f"email:0:{2 * n + 5}"), 8: (0, "")}


def test_query_on_whole_documents(spark):
    texts = {r.doc_id: r.text for r in load(spark, SF, "documents").select("doc_id", "text").collect()}
    seen = 0
    for r in p.op11_personal_data(spark, SF).collect():
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        counts = [sum(w.startswith(k + ":") for w in want) for k in p.BASE]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert [s for s in r.spans.split(",") if s.split(":")[0] in p.BASE] == want
        seen += len(want)
    assert seen > 60


@pytest.mark.parametrize("text, kind, hit", [
    ("IBAN DE89 3704 0044 0532 0130 00.", "iban", True), ("GB82WEST12345698765432", "iban", True),
    ("GB82WEST12345698765433", "iban", False), ("DE89370400440532013000x", "iban", False),
    ("ssn: 123-45-6789", "ssn", True), ("part 123-45-6789", "ssn", False), ("123-45-6789", "ssn", False),
    ("social security 000-45-6789", "ssn", False), ("amex " + card("37828224631000"), "short_card", True),
    ("order amex " + card("37828224631000"), "short_card", False), (card("37828224631000"), "short_card", False),
    ("amex " + "3" * 14 + "1", "short_card", False),
    ("call (743) 555-3824 now", "national_phone", True), ("743-555-3824", "national_phone", False),
    ("tel +1 743-555-3824", "national_phone", False), ("743 555 3824 is my phone", "national_phone", True),
    ("far away " + "phone " + "x" * 60 + " 743 555 3824", "national_phone", False),
])
def test_other_kinds_need_checksum_or_words(spark, text, kind, hit):
    found = p.find(spark.createDataFrame([(text,)], "text STRING")).first()
    assert (kind in [s.kind for s in found.spans]) == hit


def test_words_move_the_score_and_base_kinds_stay(spark):
    number = card("411111111111111")
    rows = [("card " + number,), (number,), ("invoice " + number,), ("discard " + number,)]
    found = p.find(spark.createDataFrame(rows, "text STRING")).select("spans.kind", "spans.score").collect()
    assert [tuple(r) for r in found] == [(["card"], [1.0]), (["card"], [0.7]), (["card"], [0.4]), (["card"], [0.7])]


def test_redaction(spark):
    number = card("411111111111111")
    rows = [(1, f"é {number}, a@b.cc 1.2.3.4 and +1 (743) 555-3824; 1.2.3.400", 5), (2, None, 6), (3, "", 7)]
    out = p.redact(spark.createDataFrame(rows, "id INT, text STRING, row INT"))
    assert out.columns == ["id", "text", "row"]
    assert [tuple(r) for r in out.collect()] == [
        (1, "é [CARD], [EMAIL] [IP] and [PHONE]; 1.2.3.400", 5), (2, None, 6), (3, "", 7)]


def test_tables_of_other_shapes(spark):
    assert p.find(empty(spark)).collect() == [] and p.redact(empty(spark)).schema == empty(spark).schema
    assert p.redact(table(spark)).schema.names == [f.split()[0] for f in SCHEMA.replace("STRUCT<a: INT>", "x").split(", ")]
    found = p.find(table(spark)).select("row.*", "spans")
    assert found.count() == len(awkward())


def test_no_python_on_the_main_path(spark):
    assert "Python" not in plan(p.op11_personal_data(spark, SF)) and "Arrow" not in plan(p.op11_personal_data(spark, SF))


def test_running_sums(spark):
    for n in (0, 1, 255, 256, 257, 3000):
        got = spark.range(1).select(p.running(F.transform(
            F.slice(F.sequence(F.lit(0), F.lit(n)), 2, F.lit(n + 1)), lambda x: x.cast("bigint")))).first()[0]
        assert got == [k * (k + 1) // 2 for k in range(1, n + 1)]

"""Personal data: patterns propose spans, checksums confirm them, words nearby move their score.

Everything is built from column functions; no row leaves the JVM. A kind is a pattern, a test that its
matches must pass (length, ranges, Luhn, mod 97), a score for what passed and words that raise or lower it
when they stand up to `REACH` code points before or after the match, not beyond the next match of that kind.
Base kinds are reported whenever their test passes; the others need a score of `LEAST`, which some reach by
their checksum and some only with a word.

Places come from the text between the matches: the pattern splits the text, and running sums over the
lengths of the pieces and matches give every start. So a long text with very many matches costs one pass for
each pattern. The patterns consume without going back and start no match inside a run that has failed, which
Java's engine needs for very long runs; what they find is what the plain patterns in BASE find.

Defined cases: null and empty texts have no spans; places are code points, the end is exclusive; matches
that fail their test are dropped and nothing shorter is tried; spans of different kinds may overlap; every
row is judged by itself, so equal rows have equal spans; other columns, whatever their names, are kept in
`row`; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm.frames import as_text, load, packed

REACH, LEAST, STEP = 40, 0.5, 256
MOVE = 0.3  # what a word nearby adds or takes

# The base kinds in their order, as plain patterns.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # a pattern that every match holds, cheap to look for
    passes: Callable[[Column], Column]
    score: float
    raising: str = ""
    lowering: str = ""
    base: bool = False


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column, least: int, most: int) -> Column:
    """So many digits, and the Luhn checksum holds."""
    return F.length(digits(value)).between(least, most) & F.call_function("luhn_check", digits(value))


def mod97(value: Column) -> Column:
    """An account number whose first four signs, moved to its end, leave 1 modulo 97 (letters count 10 to 35)."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    number = F.array_join(F.transform(F.split(moved, "(?<=.)(?=.)"), lambda c: F.when(
        c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")
    # Seven digits at a time: with the remainder before them they fit a long.
    return bound(number, lambda n: F.aggregate(
        F.sequence(F.lit(0), F.expr("0") + ((F.length(n) - 1) / 7).cast("int")), F.lit(0).cast("bigint"),
        lambda left, k: F.concat(left.cast("string"), F.substring(n, k * 7 + 1, F.lit(7))).cast("bigint") % 97)) == 1


def parts_fit(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: bound(F.ltrim(p, F.lit("0")), lambda d: (
        F.length(d) < 3) | ((F.length(d) == 3) & (d <= "255"))))


CARD_WORDS = "card|visa|mastercard|amex|credit|debit|karte|kreditkarte|carte|tarjeta|cvv"
PHONE_WORDS = "phone|tel|telephone|call|mobile|cell|fax|telefon|telefono|teléfono|téléphone|portable|móvil"
NUMBER_WORDS = "isbn|issn|doi|version|order|invoice|tracking|serial|model|part|item|sku"

KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         lambda v: F.lit(True), 0.9, "mail|contact|write|email|e-mail", "example|noreply", True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]",
         parts_fit, 0.6, "ip|host|server|address|login|adresse", "version|section|release|chapter", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]{2}|[0-9][ -][0-9]",
         lambda v: luhn(v, 16, 19), 0.7, CARD_WORDS, NUMBER_WORDS, True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]",
         lambda v: F.length(digits(v)).between(8, 15), 0.6, PHONE_WORDS, NUMBER_WORDS, True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         "[A-Z]{2}[0-9]{2}", mod97, 0.8, "iban|bank|account|konto|compte|cuenta", NUMBER_WORDS),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-[0-9]{2}-",
         lambda v: ~v.rlike("^(000|666|9)|-00-|-0000$"), 0.3, "ssn|social|security|taxpayer", NUMBER_WORDS),
    Kind("short_card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]{2}|[0-9][ -][0-9]",
         lambda v: luhn(v, 13, 15), 0.3, CARD_WORDS, NUMBER_WORDS),
    Kind("national_phone",
         r"(?<![0-9+(.-])(?<!\+[0-9]{1,3}[ .-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
         "[0-9]{3}[ .-][0-9]{4}", lambda v: ~digits(v).rlike("^[01]"), 0.3, PHONE_WORDS, NUMBER_WORDS),
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _sums(values: Column) -> Column:
    zero = F.array(F.lit(0).cast("bigint"))
    return F.aggregate(values, zero, lambda done, v: F.array_append(done, F.element_at(done, -1) + v))


def running(values: Column) -> Column:
    """The sums up to and with each of the longs; by blocks, since adding to an array copies it."""
    def whole(v):
        blocks = F.transform(
            F.sequence(F.lit(0), F.greatest(F.floor((F.size(v) - 1) / STEP).cast("int"), F.lit(0))),
            lambda k: _sums(F.slice(v, k * STEP + 1, F.lit(STEP))))
        return bound(blocks, lambda b: F.flatten(F.zip_with(
            b, F.slice(_sums(F.transform(b, lambda x: F.element_at(x, -1))), F.lit(1), F.size(b)),
            lambda block, before: F.transform(F.slice(block, F.lit(2), F.lit(STEP)), lambda x: x + before))))

    return bound(values, whole)


def _near(kind: Kind, before: Column, after: Column) -> Column:
    """The score after the words nearby."""
    near = F.lower(F.concat(F.right(before, F.lit(REACH)), F.lit(" "), F.left(after, F.lit(REACH))))
    word = r"(?<![\p{{L}}0-9])(?:{})(?![\p{{L}}0-9])".format
    up = F.when(near.rlike(word(kind.raising)), MOVE).otherwise(0.0)
    down = F.when(near.rlike(word(kind.lowering)), MOVE).otherwise(0.0)
    return F.round(F.least(F.greatest(F.lit(kind.score) + up - down, F.lit(0.0)), F.lit(1.0)), 2)


def _hits(text: Column, kind: Kind) -> Column:
    """Each match with the text before it, its score, and whether it counts; the text after the last one too."""
    split = F.struct(
        F.split(text, kind.pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"))

    def paired(s):
        after = F.slice(s["gaps"], F.lit(2), F.greatest(F.size(s["gaps"]), F.lit(1)))
        pairs = F.zip_with(s["gaps"], s["found"], lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
        return F.zip_with(pairs, after, lambda p, a: F.struct(
            p["gap"].alias("gap"), p["value"].alias("value"),
            F.when(p["value"].isNotNull() & kind.passes(p["value"]), _near(kind, p["gap"], a)).alias("score")))

    return bound(split, paired)


def _counts(kind: Kind, score: Column) -> Column:
    return score.isNotNull() if kind.base else F.coalesce(score >= LEAST, F.lit(False))


SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double,value:string>>"


def _spans(text: Column, kind: Kind) -> Column:
    def placed(hits):
        ends = running(F.transform(hits, lambda h: (
            F.length(h["gap"]) + F.coalesce(F.length(h["value"]), F.lit(0))).cast("bigint")))
        return F.filter(F.zip_with(hits, ends, lambda h, e: F.struct(
            F.lit(kind.name).alias("kind"), (e - F.length(h["value"])).alias("start"), e.alias("end"),
            h["score"].alias("score"), h["value"].alias("value"))), lambda s: _counts(kind, s["score"]))

    found = bound(_hits(text, kind), placed).cast(SPAN)
    return F.when(text.rlike(kind.hint), found).otherwise(F.array().cast(SPAN))


def find(df: DataFrame, text="text", kinds=KINDS) -> DataFrame:
    """row (the input row), spans: kind, start, end, score and value of each, by kind and then by start."""
    rows = packed(df, text=as_text(df, text))
    return rows.select("row", F.concat(*[_spans(F.col("text"), k) for k in kinds]).alias("spans"))


def _without(text: Column, kind: Kind) -> Column:
    name = F.lit(f"[{kind.name.upper()}]")
    return F.array_join(F.transform(_hits(text, kind), lambda h: F.concat(
        h["gap"], F.when(_counts(kind, h["score"]), name).otherwise(F.coalesce(h["value"], F.lit(""))))), "")


def _blanked(kind: Kind) -> Callable[[Column], Column]:
    return lambda text: F.when(text.rlike(kind.hint), _without(text, kind)).otherwise(text)


def redact(df: DataFrame, text="text", kinds=KINDS) -> DataFrame:
    """The rows with each span replaced by its kind's name in brackets, one kind after the other."""
    rows = packed(df, text=F.when(F.col(f"`{text}`").isNotNull(), as_text(df, text)))
    out = F.col("text")
    for kind in kinds:
        out = bound(out, _blanked(kind))
    rows = rows.withColumn("text", out)
    return rows.select(*[
        F.col("text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in df.columns])


def as_list(spans: Column) -> Column:
    """kind:start:end of each, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(load(spark, sf_dir, "documents"))
    base = [k.name for k in KINDS if k.base]

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "row.doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in base],
        F.sha2(as_list(of(*base)), 256).alias("base_sha256"), as_list(F.col("spans")).alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"))

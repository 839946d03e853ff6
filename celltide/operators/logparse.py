"""Event text back to anomaly rows.

One event text is one value of one row, so everything up to the final explode happens inside the
row with array functions: no shuffle, and no window over the lines of an event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.numbers import to_number
from celltide.functions.text import lines_of, strip
from celltide.operators import rules as R

# The line patterns of an event text. Headers come as
# 'Cell ID 1, Band Band 29:', 'Cell ID 1, Band 29 (FORMAT ERROR):' or '1. Cell ID 1, Band 29'.
HEADER = (
    r"(?i)^(?:Cell ID\s+(\d+),\s*Band(?:\s+Band)?\s+(\d+)\s*(?:\(FORMAT ERROR\))?:"
    r"|\d+\.\s*Cell ID\s+(\d+),\s*Band\s+(\d+))\s*$"
)
FIX = r"(?i)^(?:[-*•]\s*)?(?:Recommended\s*fix|Remediation)\s*:\s*(.+)$"
INLINE = r"(?i)LLM_FORMAT_ERROR.*?:.*?"
LABELS = {
    R.THROUGHPUT: r"Throughput Drop:",
    R.RSRP: r"Low RSRP:",
    R.UES: r"UEs?\s+Spike/Drop:",
    R.SINR: r"Low SINR:",
    R.PRB: r"High PRB Utilization:",
    R.PRB_ERROR: r"PRB Utilization Error:",
    R.OUTAGE: r"Cell Outage:",
}
LEGACY_LABELS = [R.THROUGHPUT, R.RSRP, R.UES, R.SINR]
TAIL = r"(?i)\s+LLM failed to format:.*$"
MEASURED = r"([-+]?\d+(?:\.\d+)?)"

ROW = (
    "cell_id BIGINT, band INT, anomaly_type STRING, anomaly STRING, recommended_fix STRING, "
    "measured_value DOUBLE"
)


def clean_text(c: Column, legacy_sign=False) -> Column:
    """Without bullets in front, the error tail, doubled blanks and one closing sign.

    A minus directly before a digit is a sign, not a bullet, unless `legacy_sign`.
    """
    bullet = r"^[\s•*-]+" if legacy_sign else r"^(?:[\s•*]|-(?!\d))+"
    c = F.regexp_replace(c, bullet, "")
    c = F.regexp_replace(c, TAIL, "")
    c = strip(F.regexp_replace(c, r"\s{2,}", " "))
    return F.regexp_replace(c, r"[.,;:]\s*$", "")


def parse_lines(df: DataFrame, text="event", keep=("id",)) -> DataFrame:
    """Numbered, stripped lines of each text (`line_no` from 1)."""
    lines = _unnest(df.withColumn("_lines", lines_of(F.col(text))), "_lines", "line", keep)
    return lines.select(*keep, (F.col("pos") + 1).alias("line_no"), "line")


def _unnest(df: DataFrame, array: str, name: str, keep) -> DataFrame:
    """One row per element, with its position.

    A plain explode makes the planner filter on the array's size first, below this step, which
    would compute the array twice.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias("pos", name))
    return rows.where("pos IS NOT NULL")


def _blocks(df: DataFrame, text: str) -> DataFrame:
    """`_blocks`: array of (block_no, cell_id, band, start, lines, last_fix) per text.

    A fix line holds for every anomaly above it and a later one overwrites, so what counts is a
    block's last fix line: anomalies before it carry it, anomalies after it carry none.
    """
    out = df.withColumn("_lines", lines_of(F.col(text)))
    heads = F.filter(
        F.transform("_lines", lambda line, i: F.struct(
            (i + 1).alias("at"), F.regexp_extract(line, HEADER, 0).alias("head")
        )),
        lambda h: h["head"] != "",
    )
    out = out.withColumn("_heads", heads)

    def number(head, first, second):
        found = F.concat(F.regexp_extract(head, HEADER, first),
                         F.regexp_extract(head, HEADER, second))
        return found.try_cast("bigint")

    def block(h, i):
        following = F.get("_heads", i + 1)
        end = F.coalesce(following["at"], F.size("_lines") + 1)
        lines = F.slice("_lines", h["at"] + 1, end - h["at"] - 1)
        return F.struct(
            (i + 1).alias("block_no"),
            number(h["head"], 1, 3).alias("cell_id"),
            number(h["head"], 2, 4).cast("int").alias("band"),
            h["at"].alias("start"),
            F.transform(lines, lambda line, k: F.struct(
                k.alias("i"), line.alias("line"), F.regexp_extract(line, FIX, 1).alias("fix")
            )).alias("lines"),
        )

    def with_fix(b):
        fixes = F.filter(b["lines"], lambda n: n["fix"] != "")
        return F.struct(
            b["block_no"].alias("block_no"), b["cell_id"].alias("cell_id"),
            b["band"].alias("band"), b["start"].alias("start"), b["lines"].alias("lines"),
            F.try_element_at(fixes, F.lit(-1)).alias("last_fix"),
        )

    return out.withColumn(
        "_blocks", F.transform(F.transform("_heads", block), with_fix)
    ).drop("_lines", "_heads")


def parse_blocks(df: DataFrame, text="event", keep=("id",)) -> DataFrame:
    """Lines with the block they belong to; lines before the first header are left out."""
    blocks = _unnest(_blocks(df, text), "_blocks", "b", keep).select(*keep, "b.*")
    lines = _unnest(blocks, "lines", "n", (*keep, "block_no", "cell_id", "band", "start"))
    return lines.select(
        *keep, "block_no", "cell_id", "band",
        (F.col("start") + F.col("n.i") + 1).alias("line_no"), F.col("n.line").alias("line"),
    )


def _kind_of(piece: Column, labels, pattern) -> Column:
    """The first label, in table order, whose pattern the piece matches."""
    kind = F
    for name, rx in labels.items():
        kind = kind.when(piece.rlike(pattern.format(rx)), F.lit(name))
    return kind.otherwise(F.lit(None))


def _body_of(kind: Column, piece: Column, labels) -> Column:
    body = F
    for name, rx in labels.items():
        body = body.when(kind == name, F.regexp_extract(piece, rf"(?i){rx}\s*(.+)", 1))
    return body.otherwise(F.lit(None))


def _block_rows(b: Column, labels, legacy_sign, legacy_inline) -> Column:
    """The anomaly structs of one block, in line order.

    Worked out in steps, each an array of its own, so that nothing is matched twice: pieces, their
    kinds, their texts, the rows.
    """
    any_label = "(?:" + "|".join(labels.values()) + ")"
    inline = INLINE + "(" + any_label + r"\s*.+)$"
    plain = F.filter(b["lines"], lambda n: n["fix"] == "")

    def pieces(n):
        tail = F.regexp_extract(n["line"], inline, 1)
        if legacy_inline:
            parts = F.array(tail)
        else:
            parts = F.split(F.regexp_replace(tail, TAIL, ""), r";\s+")
        texts = F.when(F.contains(F.lower(n["line"]), F.lit("llm_format_error")) & (tail != ""),
                       parts).otherwise(F.array(n["line"]))
        return F.transform(texts, lambda p: F.struct(n["i"].alias("i"), p.alias("text")))

    def kinds(p):
        first = "(?i)^{0}" if legacy_inline else r"(?i){0}\s*.+"
        kind = _kind_of(p["text"], labels, r"(?i){0}\s*.+")
        if legacy_inline:
            kind = F.coalesce(_kind_of(p["text"], labels, first), kind)
        gate = p["text"].rlike("(?i)" + any_label)
        return F.struct(
            p["i"].alias("i"), p["text"].alias("text"), F.when(gate, kind).alias("kind")
        )

    def bodies(k):
        return F.struct(
            k["i"].alias("i"), k["kind"].alias("kind"),
            _body_of(k["kind"], k["text"], labels).alias("body"),
        )

    def rows(k):
        return F.struct(
            b["cell_id"].alias("cell_id"),
            b["band"].alias("band"),
            k["kind"].alias("anomaly_type"),
            F.concat(k["kind"], F.lit(": "), clean_text(k["body"], legacy_sign)).alias("anomaly"),
            F.when(
                k["i"] < b["last_fix"]["i"], clean_text(b["last_fix"]["fix"], legacy_sign)
            ).alias("recommended_fix"),
            to_number(F.regexp_extract(k["body"], MEASURED, 1)).alias("measured_value"),
        )

    named = F.filter(
        F.transform(F.flatten(F.transform(plain, pieces)), kinds), lambda k: k["kind"].isNotNull()
    )
    return F.transform(F.transform(named, bodies), rows)


def parse_anomalies(
    df: DataFrame, text="event", source_id="id", created="creation_date",
    legacy_sign=False, legacy_types=False, legacy_inline=False, dedupe=True,
) -> DataFrame:
    """One row per anomaly named in each text, with its block's cell and band.

    Repeats of (cell, band, type, text, fix) inside one text count once; the same anomaly in two
    events stays twice. The `legacy_*` options give the older results: signs lost as bullets, four
    kinds only, one row per error line.
    """
    names = LEGACY_LABELS if legacy_types else list(LABELS)
    labels = {k: LABELS[k] for k in names}
    rows = F.flatten(F.transform(
        "_blocks", lambda b: _block_rows(b, labels, legacy_sign, legacy_inline)
    ))
    meta = [
        (F.col(source_id) if source_id in df.columns else F.lit(None)).cast("string").alias(
            "source_id"
        ),
        (F.col(created) if created in df.columns else F.lit(None)).alias("creation_date"),
    ]
    parsed = _blocks(df, text).select(*meta, rows.alias("_rows"))
    keep = ("source_id", "creation_date")
    if dedupe:
        # Texts hash, structs do not: distinct over JSON keeps the first of each in linear time.
        signature = F.transform("_rows", lambda r: F.to_json(r))
        texts = parsed.withColumn("_sig", F.array_distinct(signature))
        parsed = _unnest(texts, "_sig", "sig", keep).withColumn("r", F.from_json("sig", ROW))
    else:
        parsed = _unnest(parsed, "_rows", "r", keep)
    return parsed.select(
        "r.*", "source_id", "creation_date", (F.col("pos") + 1).alias("item_no")
    )


def parse_fixes(df: DataFrame, text="event", keep=("id",)) -> DataFrame:
    """Every non-fix line with the fix that holds for it, if any."""
    def rows(b):
        plain = F.filter(b["lines"], lambda n: n["fix"] == "")
        return F.transform(plain, lambda n: F.struct(
            b["block_no"].alias("block_no"),
            b["cell_id"].alias("cell_id"),
            b["band"].alias("band"),
            (b["start"] + n["i"] + 1).alias("line_no"),
            n["line"].alias("line"),
            F.when(n["i"] < b["last_fix"]["i"], clean_text(b["last_fix"]["fix"])).alias(
                "recommended_fix"
            ),
        ))

    fixed = _blocks(df, text).withColumn("_rows", F.flatten(F.transform("_blocks", rows)))
    return _unnest(fixed, "_rows", "r", keep).select(*keep, "r.*")

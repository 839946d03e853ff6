"""Report text, reconciliation of answers with the rules, verification, remediation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.numbers import shown, to_number
from celltide.functions.text import strip
from celltide.operators import rules as R
from celltide.sinks.messages import csv_line
from celltide.sinks.files import text_columns

# Markers and outcome words of a report.
START = "**** START_EVENT ****"
END = "**** END_EVENT ****"
FOUND = "ANOMALY_DETECTED"
NONE_FOUND = "NO_ANOMALY"
NONE_LISTED = "NO_ANOMALIES_DETECTED"
CALL_FAILED = "LLM_CALL_FAILED"
FORMAT_ERROR = "LLM_FORMAT_ERROR"
BLOCK = r"(?s)\*{4} START_EVENT \*{4}.*?\*{4} END_EVENT \*{4}"

DEFAULT_FIX = "Refer to the radio unit documentation"

REQUEST_TEMPLATE = """Report the anomalies of one cell.
Cell ID: {cell_id}
Band: {band}
Reading: {reading}
Detected anomalies:
{anomalies}
Answer with one event block, or with NO_ANOMALY when the list says NO_ANOMALIES_DETECTED."""


def texts(anomalies="anomalies") -> Column:
    return F.transform(anomalies, lambda a: a["text"])


def bullets(anomalies="anomalies") -> Column:
    return F.array_join(F.transform(texts(anomalies), lambda t: F.concat(F.lit("- "), t)), "\n")


def render_report(df: DataFrame, fix: Column | str = DEFAULT_FIX) -> DataFrame:
    """`report_text`: the event block of a detected row, or NO_ANOMALY."""
    fix = F.lit(fix) if isinstance(fix, str) else fix
    block = F.concat_ws(
        "\n",
        F.lit(f"{START} {FOUND}"),
        F.concat(F.lit("1. Cell ID "), F.col("cell_id").cast("string"), F.lit(", "), F.col("band")),
        bullets(),
        F.concat(F.lit("- Recommended fix: "), fix),
        F.lit(END),
    )
    return df.withColumn("report_text", F.when(F.col("is_anomaly"), block).otherwise(NONE_FOUND))


def request_text(df: DataFrame, template=REQUEST_TEMPLATE) -> DataFrame:
    """`request_text`: the row as quoted CSV and its anomaly bullets, put into a template."""
    listed = F.when(F.size("anomalies") > 0, bullets()).otherwise(NONE_LISTED)
    values = {
        "{cell_id}": F.col("cell_id").cast("string"),
        "{band}": F.col("band"),
        "{reading}": csv_line(text_columns(df)),
        "{anomalies}": listed,
    }
    text = F.lit(template)
    for mark, value in values.items():
        text = F.replace(text, F.lit(mark), F.coalesce(value, F.lit("")))
    return df.withColumn("request_text", text)


def extract_block(response: Column) -> Column:
    """The text between the markers, across lines; NULL without markers."""
    found = F.regexp_substr(response, F.lit(BLOCK))
    inside = F.substring(
        found, F.lit(len(START) + 1), F.length(found) - len(START) - len(END)
    )
    return strip(inside)


def block_body(response: Column) -> Column:
    """The block without its marker word."""
    return strip(F.replace(extract_block(response), F.lit(FOUND), F.lit("")))


def event_header(mark="") -> Column:
    return F.concat(
        F.lit("Cell ID "), F.col("cell_id").cast("string"), F.lit(", Band "), F.col("band"),
        F.lit(f"{mark}:\n"),
    )


def with_responses(detected: DataFrame, responses: DataFrame) -> DataFrame:
    """Join answers to scored rows; a missing answer is a failed call."""
    keys = ["cell_id", "band", "event_time"]
    joined = detected.join(responses.select(*keys, "raw_response"), keys, "left")
    return joined.withColumn("raw_response", F.coalesce("raw_response", F.lit(CALL_FAILED)))


def reconcile(df: DataFrame) -> DataFrame:
    """`outcome`, `reason` and `event_text` of rows with `raw_response`. The rules are the truth.

    Fixed values: the wording of the two error texts.
    """
    response, block = F.col("raw_response"), F.col("_block")
    formatted = F.coalesce(F.contains(block, F.lit(FOUND)), F.lit(False))
    listed = F.array_join(texts(), "; ")
    unformatted = F.concat(
        F.lit(f"{FORMAT_ERROR}: Python detected anomalies: "), listed,
        F.lit(". LLM failed to format: "), response,
    )
    unexpected = F.concat(
        F.lit(f"{FORMAT_ERROR}: Python found no anomalies, but LLM responded: "), response
    )
    quiet = strip(response) == NONE_FOUND
    answered = df.withColumn("raw_response", F.coalesce("raw_response", F.lit(CALL_FAILED)))
    out = answered.withColumn("_block", extract_block(response)).withColumns({
        "outcome": F.when(F.col("is_anomaly") & formatted, "FORMATTED")
        .when(F.col("is_anomaly"), FORMAT_ERROR)
        .when(quiet, NONE_FOUND)
        .otherwise("UNEXPECTED_RESPONSE"),
        "reason": F.when(F.col("is_anomaly") & formatted, block)
        .when(F.col("is_anomaly"), unformatted)
        .when(quiet, NONE_FOUND)
        .otherwise(unexpected),
    })
    return out.withColumn(
        "event_text",
        F.when(F.col("outcome") == "FORMATTED", F.concat(event_header(), F.col("reason")))
        .when(F.col("outcome") == FORMAT_ERROR,
              F.concat(event_header(" (FORMAT ERROR)"), F.col("reason"))),
    ).drop("_block")


def anomaly_results(reconciled: DataFrame) -> DataFrame:
    return reconciled.select("cell_id", "band", "event_time", "raw_response", "is_anomaly", "reason")


def batch_report(reconciled: DataFrame) -> DataFrame:
    """The event texts in order, one block per row; `write_report` puts blank lines between.

    The blocks are never joined into one value: a batch has no size limit.
    """
    return (
        reconciled.where("is_anomaly")
        .select("cell_id", "band", "event_time", F.col("event_text").alias("report_text"))
        .orderBy("event_time", "cell_id", "band")
    )


def _number_in(text: Column, pattern: str) -> Column:
    return to_number(F.regexp_extract(text, pattern, 1))


def text_violates(text: Column, t: R.Thresholds = R.Thresholds()) -> Column:
    """True when a number named in the text breaks its limit. The three patterns."""
    sinr = _number_in(text, r"SINR.*?(-?\d+\.?\d*)\s*dB")
    rsrp = _number_in(text, r"RSRP.*?(-?\d+\.?\d*)\s*dBm")
    prb = _number_in(text, r"PRB Utilization.*?(\d+\.?\d*)\s*%")
    return F.coalesce(sinr < t.sinr_db, F.lit(False)) | F.coalesce(
        rsrp < t.rsrp_dbm, F.lit(False)
    ) | F.coalesce(prb > t.prb_percent, F.lit(False))


def row_violates(block: Column, t: R.Thresholds = R.Thresholds()) -> Column:
    """The first rule word found in the block decides which rule the row must break.

    Older reports write the last three words in small letters, so their case is ignored. A row
    without all its figures cannot be verified.
    """
    low = F.lower(block)

    def says(word):
        return F.contains(block, F.lit(word))

    enough = F.col("prior_count") >= t.history
    complete = F.lit(True)
    for c in ("ues_usage", "max_capacity", "rsrp", "sinr", "throughput_mbps", "rsrq"):
        complete = complete & F.col(c).isNotNull()
    return complete & (
        F.when(says("PRB Utilization"), F.col("is_prb"))
        .when(says("RSRP"), F.col("is_rsrp"))
        .when(says("SINR"), F.col("is_sinr"))
        .when(F.contains(low, F.lit("throughput drop")) & enough, F.col("is_throughput"))
        .when(F.contains(low, F.lit("ues spike/drop")) & enough, F.col("is_ues"))
        .when(F.contains(low, F.lit("cell outage")), F.col("is_outage"))
        .otherwise(F.lit(False))
    )


def _verify(df: DataFrame, holds, labels) -> DataFrame:
    response = F.col("raw_response")
    block = extract_block(response)
    out = df.withColumn("_block", block)
    named = F.contains(F.col("_block"), F.lit(FOUND))
    verdict = (
        F.when(named & holds(F.col("_block")), FOUND)
        .when(named, labels["false"])
        .when(F.col("_block").isNotNull(), labels["structure"])
        .when(strip(response) == NONE_FOUND, NONE_FOUND)
        .otherwise(labels["unknown"])
    )
    out = out.withColumn("verdict", verdict)
    about = F.when(
        F.col("verdict") == labels["structure"],
        F.col("_block") if labels["structure_text"] == "block" else response,
    ).when(F.col("verdict") == labels["unknown"], response).otherwise(F.col("_block"))
    prefix = F.when(
        F.col("verdict") == FORMAT_ERROR, f"{FORMAT_ERROR} (Unexpected content in tags): "
    ).otherwise(F.concat("verdict", F.lit(": ")))
    return out.withColumns({
        "is_verified": F.col("verdict") == FOUND,
        "verified_reason": F.when(F.col("verdict") == FOUND, F.col("_block"))
        .when(F.col("verdict") == NONE_FOUND, NONE_FOUND)
        .otherwise(F.concat(prefix, F.coalesce(about, F.lit("")))),
    }).drop("_block")


def verify_text(df: DataFrame, t: R.Thresholds = R.Thresholds()) -> DataFrame:
    """Check each answer by the numbers in its own text. The labels."""
    return _verify(df, lambda b: text_violates(b, t), {
        "false": "HALLUCINATION_SUSPECTED", "structure": "UNEXPECTED_STRUCTURE",
        "unknown": "UNRECOGNIZED_FORMAT", "structure_text": "response",
    })


def verify_row(df: DataFrame, t: R.Thresholds = R.Thresholds()) -> DataFrame:
    """Check each answer against the row it is about. The labels."""
    return _verify(df, lambda b: row_violates(b, t), {
        "false": "LLM_HALLUCINATION_DETECTED", "structure": FORMAT_ERROR,
        "unknown": "LLM_UNRECOGNIZED_FORMAT", "structure_text": "block",
    })


# What to do about each kind of anomaly, and the units of its figures.
ACTIONS = {
    R.PRB: "Shift load to neighbour cells",
    R.PRB_ERROR: "Correct the configured capacity",
    R.RSRP: "Adjust antenna azimuth and downtilt",
    R.SINR: "Reduce interference from neighbour cells",
    R.THROUGHPUT: "Check backhaul and scheduling",
    R.UES: "Check handover and admission settings",
    R.OUTAGE: "Restart the radio unit",
}

UNITS = {R.PRB: "%", R.RSRP: " dBm", R.SINR: " dB", R.THROUGHPUT: " Mbps", R.UES: " UEs"}
MAX_PARAMETERS = 4


def remediation(reconciled: DataFrame, azimuth=5, downtilt=3) -> DataFrame:
    """One request per well-formed answer, about the row's first violated rule, as JSON in `value`.

    Nothing is done about anomalies whose answer is missing or has no form: rows whose `outcome` (see
    `reconcile`) is another.

    A request has at most four parameters: antenna changes, where they apply, take the place of
    the anomaly's type and value.
    """
    first = F.get("anomalies", F.lit(0))
    kind = first["anomaly_type"]

    def lookup(pairs, default):
        out = F
        for k, v in pairs.items():
            out = out.when(kind == k, v)
        return out.otherwise(default)

    unit = lookup(UNITS, "")
    rows = reconciled.where("outcome = 'FORMATTED'").select(
        "cell_id", "band", "event_time", kind.alias("anomaly_type"),
        F.round(first["value"], 2).alias("_value"),
        F.round(first["threshold"], 4).alias("_limit"),
        unit.alias("_unit"),
        lookup(ACTIONS, "Inspect the cell").alias("action"),
        F.when(kind == R.RSRP, F.lit(azimuth)).alias("azimuth_change"),
        F.when(kind == R.RSRP, F.lit(downtilt)).alias("downtilt_change"),
    )
    rows = rows.withColumns({
        "anomaly_value": F.concat(shown("_value"), "_unit"),
        "threshold_value": F.concat(shown("_limit"), "_unit"),
    }).drop("_value", "_limit", "_unit")
    tilts = F.col("azimuth_change").isNotNull()
    body = F.struct(
        F.col("cell_id").cast("string").alias("cell_id"),
        F.when(~tilts, F.col("anomaly_type")).alias("anomaly_type"),
        F.when(~tilts, F.col("anomaly_value")).alias("anomaly_value"),
        F.col("action"),
        F.col("azimuth_change"),
        F.col("downtilt_change"),
    )
    return rows.withColumn("value", F.to_json(body, {"ignoreNullFields": "true"}))

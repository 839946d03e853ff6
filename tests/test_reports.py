import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL, rows

from celltide.operators import eventstore, logparse, reports
from celltide.operators import rules as R
from celltide.plans import views
from tests.test_rules import SCHEMA, T0, reading


def detected(spark, **change):
    data = [reading(i, 50.0, 200.0) for i in range(3)] + [reading(3, 50.0, 200.0, **change)]
    df = R.detect(spark.createDataFrame(data, SCHEMA))
    return df.where(F.col("event_time") == F.lit(T0 + dt.timedelta(minutes=15)))


def outcome(spark, response, **change):
    df = detected(spark, **change).withColumn("raw_response", F.lit(response).cast("string"))
    return reports.reconcile(df).first()


BLOCK = "x **** START_EVENT **** ANOMALY_DETECTED\n1. Cell ID 1, Band 29\n- y\n**** END_EVENT **** z"


def test_reconcile(spark):
    good = outcome(spark, BLOCK, sinr=-3.0)
    assert good.outcome == "FORMATTED" and good.is_anomaly
    assert good.reason == "ANOMALY_DETECTED\n1. Cell ID 1, Band 29\n- y"
    assert good.event_text == "Cell ID 1, Band Band 29:\n" + good.reason
    loose = outcome(spark, "no idea", sinr=-3.0)
    assert loose.reason == ("LLM_FORMAT_ERROR: Python detected anomalies: Low SINR: -3.0 dB < 0 dB. "
                            "LLM failed to format: no idea")
    assert loose.event_text.startswith("Cell ID 1, Band Band 29 (FORMAT ERROR):\n")
    failed = outcome(spark, None, sinr=-3.0)
    assert failed.raw_response == "LLM_CALL_FAILED" and failed.outcome == "LLM_FORMAT_ERROR"
    unnamed = outcome(spark, BLOCK.replace("ANOMALY_DETECTED", ""), sinr=-3.0)
    assert unnamed.outcome == "LLM_FORMAT_ERROR"
    quiet = outcome(spark, " NO_ANOMALY\n")
    assert (quiet.reason, quiet.event_text, quiet.is_anomaly) == ("NO_ANOMALY", None, False)
    chatty = outcome(spark, "fine")
    assert chatty.reason == ("LLM_FORMAT_ERROR: Python found no anomalies, but LLM responded: fine")


def test_answers_are_joined_and_missing_ones_failed(spark):
    rows_in = R.detect(spark.createDataFrame([reading(0), reading(0, cell=2)], SCHEMA))
    answers = rows_in.where("cell_id = 1").withColumn("raw_response", F.lit("NO_ANOMALY"))
    got = reports.with_responses(rows_in, answers)
    assert rows(got, "cell_id", "raw_response") == [(1, "NO_ANOMALY"), (2, "LLM_CALL_FAILED")]
    results = reports.anomaly_results(reports.reconcile(got))
    assert results.columns == ["cell_id", "band", "event_time", "raw_response", "is_anomaly", "reason"]


@pytest.mark.parametrize("text,verdict", [
    ("ANOMALY_DETECTED Low SINR: -3 dB", "ANOMALY_DETECTED"),
    ("ANOMALY_DETECTED Low SINR: 3 dB", "HALLUCINATION_SUSPECTED"),
    ("ANOMALY_DETECTED RSRP was -111.5 dBm", "ANOMALY_DETECTED"),
    ("ANOMALY_DETECTED High PRB Utilization: 96.00%", "ANOMALY_DETECTED"),
    ("ANOMALY_DETECTED High PRB Utilization: 95%", "HALLUCINATION_SUSPECTED"),
    ("all quiet", "UNEXPECTED_STRUCTURE"),
])
def test_verify_by_text(spark, text, verdict):
    response = f"**** START_EVENT **** {text} **** END_EVENT ****"
    df = spark.createDataFrame([(response,)], "raw_response string")
    assert reports.verify_text(df).first().verdict == verdict


def test_verify_without_block(spark):
    df = spark.createDataFrame([("NO_ANOMALY ",), ("hm",)], "raw_response string")
    got = rows(reports.verify_text(df), "verdict", "verified_reason")
    assert got == [("NO_ANOMALY", "NO_ANOMALY"),
                   ("UNRECOGNIZED_FORMAT", "UNRECOGNIZED_FORMAT: hm")]


@pytest.mark.parametrize("claim,change,verdict", [
    ("Low RSRP", dict(rsrp=-111.0), "ANOMALY_DETECTED"),
    ("Low RSRP", dict(sinr=-1.0), "LLM_HALLUCINATION_DETECTED"),
    ("PRB Utilization and RSRP", dict(rsrp=-111.0), "LLM_HALLUCINATION_DETECTED"),
    ("Throughput drop", dict(sinr=-1.0), "LLM_HALLUCINATION_DETECTED"),
    ("nothing known", dict(sinr=-1.0), "LLM_HALLUCINATION_DETECTED"),
])
def test_verify_by_row(spark, claim, change, verdict):
    response = f"**** START_EVENT **** ANOMALY_DETECTED {claim} **** END_EVENT ****"
    df = detected(spark, **change).withColumn("raw_response", F.lit(response))
    assert reports.verify_row(df).first().verdict == verdict


def test_remediation_has_at_most_four_parameters(spark):
    for change in (dict(rsrp=-115.0), dict(sinr=-1.0), dict(cap=0)):
        request = json.loads(reports.remediation(well_formed(detected(spark, **change))).first().value)
        assert request["cell_id"] == "1" and len(request) <= reports.MAX_PARAMETERS
    assert request["anomaly_type"] == R.PRB_ERROR
    assert reports.remediation(well_formed(detected(spark))).count() == 0


def well_formed(df):
    return reports.reconcile(reports.render_report(df).withColumnRenamed("report_text", "raw_response"))


def test_remediation_needs_a_well_formed_answer(spark):
    for answer in (None, "The cell looks degraded.", f"{reports.START}\n1. Cell ID 1\n{reports.END}"):
        odd = detected(spark, rsrp=-115.0).withColumn("raw_response", F.lit(answer).cast("string"))
        assert reports.remediation(reports.reconcile(odd)).count() == 0


def parse(spark, text, **options):
    df = spark.createDataFrame([(1, text, "2024-01-01")], "id long, event string, creation_date string")
    got = logparse.parse_anomalies(df, **options).orderBy("item_no").collect()
    return [(r.cell_id, r.band, r.anomaly_type, r.anomaly, r.recommended_fix, r.measured_value)
            for r in got]


def test_parser_example(spark):
    text = "Cell ID 101, Band 66:\n- Low RSRP: -104 dBm\n- Recommended fix: Adjust antenna tilt"
    assert parse(spark, text) == [
        (101, 66, "Low RSRP", "Low RSRP: -104 dBm", "Adjust antenna tilt", -104.0)]
    assert parse(spark, text, legacy_sign=True)[0][3] == "Low RSRP: 104 dBm"


@pytest.mark.parametrize("head,block", [
    ("Cell ID 1, Band Band 29:", (1, 29)), ("cell id 1, band 29 (FORMAT ERROR):", (1, 29)),
    ("1. Cell ID 2, Band 66", (2, 66)), ("  Cell ID 3,Band 71 : ", (3, 71)), ("Cell ID 4, Band 5", None),
])
def test_headers(spark, head, block):
    got = parse(spark, f"{head}\n* Low SINR:  -3  dB;")
    assert got == ([(*block, "Low SINR", "Low SINR: -3 dB", None, -3.0)] if block else [])


def test_fixes_reach_upwards(spark):
    text = ("Low RSRP: -1 dBm\nCell ID 1, Band 29:\n- Low RSRP: -111 dBm\nRecommended fix: A\n"
            "- Low SINR: -2 dB\n* Remediation: B.\n- Throughput Drop: 5 Mbps\n"
            "2. Cell ID 7, Band 66\n- UE Spike/Drop: 9")
    assert [(r[0], r[2], r[4]) for r in parse(spark, text)] == [
        (1, "Low RSRP", "B"), (1, "Low SINR", "B"), (1, "Throughput Drop", None),
        (7, "UEs Spike/Drop", None)]


def test_error_lines(spark):
    head = "Cell ID 1, Band Band 29 (FORMAT ERROR):\nLLM_FORMAT_ERROR: Python detected anomalies: "
    single = head + "Low RSRP: -112 dBm < -110 dBm. LLM failed to format: x"
    assert [r[3] for r in parse(spark, single)] == ["Low RSRP: -112 dBm < -110 dBm"]
    double = head + "Low RSRP: -112 dBm < -110 dBm; Low SINR: -3 dB < 0 dB. LLM failed to format: x"
    assert [r[3] for r in parse(spark, double)] == [
        "Low RSRP: -112 dBm < -110 dBm", "Low SINR: -3 dB < 0 dB"]
    assert [r[3] for r in parse(spark, double, legacy_inline=True)] == [
        "Low RSRP: -112 dBm < -110 dBm; Low SINR: -3 dB < 0 dB"]


def test_kinds(spark):
    text = ("Cell ID 1, Band 29:\n- High PRB Utilization: 96.00% > 95.0%\n- Cell Outage: UEs=0, Tput=0\n"
            "- Low RSRP: 1 and Throughput Drop: 2")
    assert [(r[2], r[5]) for r in parse(spark, text)] == [
        ("High PRB Utilization", 96.0), ("Cell Outage", 0.0), ("Throughput Drop", 2.0)]
    assert [r[2] for r in parse(spark, text, legacy_types=True)] == ["Throughput Drop"]


def test_repeats_count_once_per_event(spark):
    text = "Cell ID 1, Band 29:\n- Low SINR: -3 dB\n- Low SINR: -3 dB\nCell ID 1, Band 29:\nLow SINR: -3 dB"
    df = spark.createDataFrame([(1, text), (1, text), (2, None), (3, "")], "id long, event string")
    assert logparse.parse_anomalies(df).count() == 2
    assert logparse.parse_anomalies(df, dedupe=False).count() == 6


def test_rendered_reports_parse_back(spark):
    found = views.detected(spark, SMALL)
    events = reports.render_report(found).where("is_anomaly").select(
        F.col("event_id").alias("id"), F.col("report_text").alias("event"))
    parsed = logparse.parse_anomalies(events).select(
        F.col("source_id").cast("long"), "anomaly_type", "anomaly")
    long = R.anomalies_long(found, ("event_id",)).select("event_id", "anomaly_type", "text")
    assert rows(parsed) == rows(long)


def test_events_hold_the_reading(spark):
    answered = reports.reconcile(views.answered(spark, SMALL))
    events = eventstore.to_events(answered)
    assert events.count() == answered.where("is_anomaly").count()
    assert eventstore.to_events(answered, include_normal=True).count() == answered.count()
    numbered = events.withColumn("id", F.monotonically_increasing_id())
    details = eventstore.event_details(numbered)
    assert rows(details, "cell_id", "event_time", "band", "rsrp") == rows(
        answered.where("is_anomaly"), "cell_id", "event_time", "band", "rsrp")

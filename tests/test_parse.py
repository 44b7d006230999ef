import pytest
from pyspark.sql import functions as F

from spikelens.operators import parse as P
from spikelens.operators.recon import reject_summary

ARRIVED = 1_800_000_000


def parse(spark, payloads):
    rows = [("events", 4, 900 + i, "k", p) for i, p in enumerate(payloads)]
    raw = spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string")
    return P.parse_events(raw, F.lit(ARRIVED))


def event(user='"u1"', kind='"click"', value="12.5", time="1700000000", trace='"t"'):
    return f'{{"user_id":{user},"event_type":{kind},"value":{value},"timestamp":{time},"trace_id":{trace}}}'


GOOD = event()

REASONS = [
    (None, P.EMPTY),
    ("", P.EMPTY),
    ("  ", P.MALFORMED),
    ("{invalid}", P.MALFORMED),
    ("not-json", P.MALFORMED),
    ("[]", P.MALFORMED),
    ("5", P.MALFORMED),
    ('"text"', P.MALFORMED),
    (f"[{GOOD}]", P.MALFORMED),
    ("null", P.NO_USER),
    ("{}", P.NO_USER),
    (GOOD, None),
    (f" \n{GOOD}\t", None),
    (GOOD + " x", P.MALFORMED),
    (GOOD + GOOD, P.MALFORMED),
    (GOOD + "," + GOOD, P.MALFORMED),
    (GOOD + ",null", P.MALFORMED),
    (GOOD + "]", P.MALFORMED),
    (GOOD + "],[", P.MALFORMED),
    (GOOD + "] x", P.MALFORMED),
    (GOOD + "}", P.MALFORMED),
    (GOOD + ',"p":1', P.MALFORMED),
    (GOOD + "}]", P.MALFORMED),
    (event(user="7"), P.MALFORMED),
    (event(user="null"), P.NO_USER),
    (event(user='"   "'), P.NO_USER),
    (event(user='"\\t\u00a0"'), P.NO_USER),
    (event(kind="true"), P.MALFORMED),
    (event(kind='""'), P.NO_TYPE),
    (event(user='""', kind='""'), P.NO_USER),
    (event(kind='""', value="1e9"), P.NO_TYPE),
    (event(value='"12"'), P.MALFORMED),
    (event(value="[1]"), P.MALFORMED),
    (event(value="NaN"), P.MALFORMED),
    (event(value="Infinity"), P.MALFORMED),
    (event(value="1e400"), P.MALFORMED),
    (event(value="01"), P.MALFORMED),
    (event(value="null"), None),
    (event(value="99999999.99"), None),
    (event(value="-99999999.99"), None),
    (event(value="99999999.991"), P.OUT_OF_RANGE),
    (event(value="100000000.0"), P.OUT_OF_RANGE),
    (event(value="-100000000.0"), P.OUT_OF_RANGE),
    (event(value="123456789012345678901234567890"), P.OUT_OF_RANGE),
    (event(trace="17"), P.MALFORMED),
    (event(trace="null"), None),
    (event(time="{}"), None),
    ('{"user_id":"u","event_type":"c","x":[1,"]"]}', None),
    ('{"user_id":"u","user_id":null,"event_type":"c","event_type" : null}', None),
    ('{"user_id":null,"event_type":"c","value":1e9,"value":null}', P.NO_USER),
    ('{"user_id":"u","event_type":"c","value":1e9,"value":null}', P.OUT_OF_RANGE),
    ('{"user_id":"u","event_type":"c","value":nullx}', P.MALFORMED),
    ('{"user_id":null,}', P.MALFORMED),
]


def test_first_failing_rule_is_reported(spark):
    got = parse(spark, [p for p, _ in REASONS]).orderBy("offset").collect()
    assert [(p, r["reject_reason"]) for (p, _), r in zip(REASONS, got)] == REASONS


def test_valid_event_is_typed_and_stored_untrimmed(spark):
    row = parse(spark, [event(user='" u1 "', trace='"  t-1 "')]).first()
    assert (row["user_id"], row["event_type"], row["value"]) == (" u1 ", "click", 12.5)
    assert (row["timestamp"], row["trace_id"]) == (1700000000, "t-1")
    assert row["partition"] == 4 and row["offset"] == 900 and row["key"] == "k"


@pytest.mark.parametrize(
    ("payload", "user", "value"),
    [
        ('{"USER_ID":"a","Event_Type":"c","VALUE":3}', "a", 3.0),
        ('{"user_id":"a","user_id":"b","event_type":"c","value":1,"value":2}', "b", 2.0),
        ('{"user_id":"a","User_Id":"b","event_type":"c"}', "b", 0.0),
        ('{"User_Id":"a","user_id":"b","event_type":"c"}', "b", 0.0),
        ('{"user_id":"\\"USER_ID\\":","event_type":"c","note":"\\"VALUE\\":9"}', '"USER_ID":', 0.0),
    ],
)
def test_names_ignore_case_and_the_last_one_counts(spark, payload, user, value):
    row = parse(spark, [payload]).first()
    assert (row["user_id"], row["value"], row["reject_reason"]) == (user, value, None)


def test_times_by_json_type(spark):
    cases = [
        ("1700000000000", 1700000000),
        ('"1700000000"', 1700000000),
        ('"2026-09-07T12:34:56.789Z"', 1788784496),
        ("1700000000.0", ARRIVED),
        ("1.7e9", ARRIVED),
        ("true", ARRIVED),
        ("null", ARRIVED),
        ('""', ARRIVED),
        ("99999999999999999999", ARRIVED),
        ("-5", -5),
    ]
    got = parse(spark, [event(time=t) for t, _ in cases]).orderBy("offset").collect()
    assert [r["timestamp"] for r in got] == [s for _, s in cases]


def test_a_missing_key_repeats_on_replay(spark):
    payload = '{"user_id":"u","event_type":"c"}'
    first, second = parse(spark, ["", payload]), parse(spark, ["", payload])
    keys = [d.filter("offset = 901").first()["trace_id"] for d in (first, second)]
    assert keys == ["4b2286dd8014c09391dcd78c05b949c2"] * 2


def test_split_keeps_payload_with_rejects_only(spark):
    parsed = P.lean(parse(spark, [GOOD, "", "oops"]))
    valid, bad = P.split_valid(parsed)
    assert "payload" not in valid.columns and valid.count() == 1
    assert {(r["payload"], r["reject_reason"]) for r in bad.collect()} == {
        ("", P.EMPTY),
        ("oops", P.MALFORMED),
    }
    report = {(r["reject_reason"], r["partition"]): r["rejects"] for r in reject_summary(bad).collect()}
    assert report == {(P.EMPTY, 4): 1, (P.MALFORMED, 4): 1}


def test_document_is_parsed_once_under_a_filter(spark):
    parsed = P.valid_events(parse(spark, [GOOD]))
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Generate", 1)
    assert "parseJson" not in above
    assert below.count("parseJson") == 2


def test_typed_events_are_checked_by_the_same_rules(spark):
    rows = spark.createDataFrame(
        [("u", "c", float("nan")), ("u", "c", float("inf")), (" ", "c", 1.0), ("u", " ", 1.0), ("u", "c", 1.0)],
        "user_id string, event_type string, value double",
    )
    got = [r[0] for r in rows.select(P.reject_reason()).collect()]
    assert got == [P.OUT_OF_RANGE, P.OUT_OF_RANGE, P.NO_USER, P.NO_TYPE, None]

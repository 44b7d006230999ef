import importlib

from spikelens.operators import recon as R


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "trace_id string")


def test_affinity(spark):
    rows = [(f"u{u}", u % 6) for u in range(5) for _ in range(4)]
    raw = spark.createDataFrame(rows, "key string, partition int")
    assert R.affinity_violations(raw).count() == 0
    moved = raw.unionByName(spark.createDataFrame([("u1", 5), ("u1", 5)], raw.schema))
    assert [tuple(r) for r in R.affinity_violations(moved).collect()] == [("u1", 2)]


def test_completeness_per_phase(spark):
    rows = [("baseline", f"b{i}") for i in range(10)] + [("downtime-buffer", f"d{i}") for i in range(5)]
    published = spark.createDataFrame(rows + rows[:3], "phase string, trace_id string")
    audit = keys(spark, [k for _, k in rows if k != "d4"])
    got = {r["phase"]: tuple(r)[1:] for r in R.completeness(published, audit).collect()}
    assert got == {"baseline": (10, 10, 0), "downtime-buffer": (5, 4, 1)}
    assert [r["trace_id"] for r in R.missing_events(published, audit).collect()] == ["d4"]


def test_replay_report(spark):
    before, after = keys(spark, ["a", "b"]), keys(spark, ["a", "b"])
    assert tuple(R.replay_report(before, after).first()) == (2, 2, 0, 0)
    changed = keys(spark, ["a", "c", "d"])
    assert tuple(R.replay_report(before, changed).first()) == (2, 3, 2, 1)
    nothing = keys(spark, [])
    assert tuple(R.replay_report(nothing, nothing).first()) == (0, 0, 0, 0)


def test_diff_scores_counts_copies_and_nulls(spark):
    schema = "k string, rolling_avg double, is_anomaly boolean"
    a = spark.createDataFrame([("x", None, False), ("x", None, False), ("y", 1.0, True)], schema)
    b = spark.createDataFrame([("x", None, False), ("y", 1.0, True), ("z", 2.0, True)], schema)
    assert R.diff_scores(a, a).count() == 0
    got = {r["k"]: r["surplus"] for r in R.diff_scores(a, b).collect()}
    assert got == {"x": 1, "z": -1}


def test_correlate(spark):
    spans = spark.createDataFrame([("s1", "a"), ("s2", "b")], "span string, idempotency_key string")
    audit = spark.createDataFrame(
        [("a", "u", "c", 1.0, None, False)],
        "trace_id string, user_id string, event_type string, event_value double, rolling_avg double, is_anomaly boolean",
    )
    got = {r["span"]: (r["persisted"], r["user_id"]) for r in R.correlate(spans, audit).collect()}
    assert got == {"s1": (True, "u"), "s2": (False, None)}
    assert R.correlate(spans, audit, "inner").count() == 1


def test_replay_of_one_log_parses_it_once(spark, tmp_path, monkeypatch):
    from catalog import jobs

    plan = importlib.import_module("spikelens.plans.process")

    rows = [(k, k % 5, "click" if k % 2 else "view", float(k % 90)) for k in range(400)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double")
    timed = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, event_id) AS ts"
    events.selectExpr("event_id", timed, "user_id", "event_type", "value", "'{}' AS props").write.parquet(str(tmp_path / "events.parquet"))
    parses = []
    monkeypatch.setattr(plan, "parse_events", lambda *a, parse=plan.parse_events: parses.append(a) or parse(*a))
    report = jobs.replay(spark, str(tmp_path)).first()
    assert report.rows_before == report.rows_after > 200 and (report.added, report.lost) == (0, 0)
    assert len(parses) == 1
    # The staged rows give what a parse of its own gives.
    first = jobs.outcome(jobs.log(spark, str(tmp_path)))
    again = jobs.outcome(jobs.log(spark, str(tmp_path)), parsed=first.parsed)
    assert sorted(map(str, first.audit.collect())) == sorted(map(str, again.audit.collect()))
    assert sorted(map(str, first.rejects.collect())) == sorted(map(str, again.rejects.collect()))

import json
import random

import pytest
from pyspark.sql import functions as F

from baitline.operators.alerts import latest_analysis, suppress_repeat_alerts
from baitline.operators.captures import debounce, drop_consecutive_duplicates
from baitline.operators.intake import validate_emails
from baitline.plans.scoring import score_emails
from baitline.streaming import jobs, latest_log
from test_intake import GOOD
from test_policy_alerts import visits

SCHEMA = "tab int, ts timestamp, seq int, fingerprint string, risk_level string"


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    """Visits written as five files in time order, so that each is one micro-batch."""
    rows, df = visits(spark, 300, seed=11)
    folder = tmp_path_factory.mktemp("arrivals")
    ordered = sorted(rows, key=lambda r: (r[1], r[2]))
    for i in range(5):
        part = spark.createDataFrame(ordered[i * 60:(i + 1) * 60], SCHEMA).coalesce(1)
        part.write.mode("append").parquet(str(folder))
    jobs.use_stream_settings(spark)
    return str(folder), df


def stream(spark, folder):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder))


def run(spark, df, tmp_path, mode="append"):
    out, mark = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    jobs.drain(spark, lambda: jobs.to_folder(df, out, mark, mode, once=True))
    return spark.read.parquet(out)


def seqs(df):
    return sorted(r["seq"] for r in df.collect())


def test_changes_equal_the_batch_result(spark, arrivals, tmp_path):
    folder, batch = arrivals
    known = batch.filter("tab IS NOT NULL")
    got = run(spark, jobs.stream_changes(stream(spark, folder).filter("tab IS NOT NULL")), tmp_path)
    assert seqs(got) == seqs(drop_consecutive_duplicates(known))
    assert got.select("batch_id").distinct().count() > 1


def test_alerts_equal_the_batch_result(spark, arrivals, tmp_path):
    folder, batch = arrivals
    got = run(spark, jobs.stream_alerts(
        stream(spark, folder).withColumn("subject", F.lit("s"))), tmp_path)
    assert seqs(got) == seqs(suppress_repeat_alerts(batch.withColumn("subject", F.lit("s"))))


@pytest.mark.parametrize("seed", [5, 6])
def test_changes_and_alerts_do_not_depend_on_the_order_of_arrival(spark, tmp_path, seed):
    rows, batch = visits(spark, 300, seed=seed)
    rng, delay = random.Random(seed), 120
    late = sorted((r[1].timestamp() + rng.random() * delay, k) for k, r in enumerate(rows))
    for i in range(0, 300, 60):
        part = [rows[k] for _, k in late[i:i + 60]]
        rng.shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    jobs.use_stream_settings(spark)
    end = batch.filter("tab IS NOT NULL").agg(F.max("ts")).first()[0]
    done = F.col("ts") <= F.lit(end) - F.expr(f"INTERVAL {delay} SECONDS")
    got = run(spark, jobs.stream_changes(stream(spark, str(tmp_path / "in")).filter("tab IS NOT NULL"),
                                         delay=f"{delay} seconds"), tmp_path / "changes")
    want = drop_consecutive_duplicates(batch.filter("tab IS NOT NULL")).filter(done)
    assert seqs(got) == seqs(want) and 20 < want.count() < batch.count()
    assert got.select("batch_id").distinct().count() > 2
    if seed == 5:
        alerts = stream(spark, str(tmp_path / "in")).withColumn("subject", F.lit("s"))
        got = run(spark, jobs.stream_alerts(alerts, delay=f"{delay} seconds"), tmp_path / "alerts")
        want = suppress_repeat_alerts(batch.withColumn("subject", F.lit("s")))
        assert seqs(got) == seqs(want.filter(done | F.col("tab").isNull()))


def test_latest_equals_the_batch_result(spark, arrivals, tmp_path):
    folder, batch = arrivals
    updates = run(spark, jobs.stream_latest(stream(spark, folder).filter("tab IS NOT NULL")),
                  tmp_path, "update")
    assert seqs(jobs.newest_per_key(updates)) == seqs(
        latest_analysis(batch.filter("tab IS NOT NULL")))


def test_bursts_equal_the_batch_result_up_to_the_watermark(spark, arrivals, tmp_path):
    folder, batch = arrivals
    known = batch.filter("tab IS NOT NULL")
    got = run(spark, jobs.stream_debounce(stream(spark, folder).filter("tab IS NOT NULL"),
                                          gap="60 seconds", delay="1 minute"), tmp_path)
    end = known.agg(F.max("ts")).first()[0]
    want = debounce(known, gap="60 seconds").filter(
        F.col("ts") + F.expr("INTERVAL 2 MINUTES") <= F.lit(end))
    assert seqs(got) == seqs(want)


def test_scores_equal_the_batch_result_and_restart_adds_nothing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    texts = [json.dumps({**GOOD, "body_text": f"login {i}"}) for i in range(6)] + ["nope", "{}"]
    for i in range(0, 8, 2):
        (folder / f"{i}.json").write_text("\n".join(texts[i:i + 2]) + "\n")
    where = [str(tmp_path / n) for n in ("good", "bad", "checkpoint")]

    def start():
        return jobs.stream_score_emails(jobs.read_raw_stream(spark, str(folder), 1), *where,
                                        once=True)

    jobs.drain(spark, start)
    jobs.drain(spark, start)
    raw = spark.createDataFrame([(t,) for t in texts], "raw string")
    good, bad = validate_emails(raw)
    assert spark.read.parquet(where[1]).count() == bad.count() == 2
    cols = ["email_id", "risk_score", "risk_level", "reasons"]
    assert sorted(map(str, spark.read.parquet(where[0]).select(cols).collect())) == sorted(
        map(str, score_emails(good).select(cols).collect()))


@pytest.mark.parametrize("forget_ms", [1, 3_600_000])
def test_latest_log_equals_the_batch_result_whatever_is_forgotten(spark, arrivals, tmp_path, forget_ms):
    folder, batch = arrivals
    log = str(tmp_path / "log")

    def start():
        return latest_log.stream_latest_log(stream(spark, folder), log, str(tmp_path / "mark"), forget_ms,
                                            compact_every=2, once=True)

    jobs.drain(spark, start)
    got = latest_log.read_latest(spark, log)
    assert seqs(got) == seqs(latest_analysis(batch.filter("tab IS NOT NULL")))
    assert sorted(got.columns) == sorted(batch.columns)
    left = sorted(p.name for p in (tmp_path / "log" / "changes").iterdir() if p.name.startswith("batch_id="))
    assert left == ["batch_id=2", "batch_id=3", "batch_id=4"]  # merged twice; what the first version held is gone
    jobs.drain(spark, start)
    latest_log.compact(spark, log, 3)  # a retry merges nothing twice
    assert sorted(map(str, latest_log.read_latest(spark, log).collect())) == sorted(map(str, got.collect()))
    latest_log.compact(spark, log, 4)
    assert seqs(latest_log.read_latest(spark, log)) == seqs(got)


def test_state_of_the_latest_log_levels_off(spark, tmp_path):
    jobs.use_stream_settings(spark)
    for k in range(5):  # tabs that never come back
        rows = spark.range(k * 40, k * 40 + 40).selectExpr(
            "CAST(id AS INT) AS tab", f"TIMESTAMP_SECONDS({k}) AS ts", "CAST(id AS INT) AS seq", "'f' AS fingerprint",
            "'low' AS risk_level")
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def held(forget_ms):
        where = [str(tmp_path / f"{name}{forget_ms}") for name in ("log", "mark")]
        found = []

        def start():
            found.append(latest_log.stream_latest_log(stream(spark, str(tmp_path / "in")), *where, forget_ms, once=True))
            return found[0]

        jobs.drain(spark, start)
        assert latest_log.read_latest(spark, where[0]).count() == 200
        return [p["stateOperators"][0]["numRowsTotal"] for p in found[0].recentProgress if p["numInputRows"]]

    remembered, forgotten = held(3_600_000), held(1)
    assert remembered[-1] - remembered[0] >= 4 * 40
    assert max(forgotten) <= 2 * remembered[0]


def test_tabs_in_buckets_keep_large_numbers_beside_nulls(spark, tmp_path):
    """And waiting rows are no state of their own each."""
    jobs.use_stream_settings(spark)
    schema = "tab long, ts timestamp, seq long, fingerprint string, risk_level string"
    large = 2**53 + 1
    rows = spark.range(3000).selectExpr(
        f"CASE WHEN id >= 10 THEN id % 1000 + {large} END AS tab", "TIMESTAMP_SECONDS(id) AS ts",
        f"CASE WHEN id % 3 > 0 THEN id + {large} END AS seq", "CAST(id % 2 AS STRING) AS fingerprint", "'low' AS risk_level")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    end = spark.createDataFrame([(None, 9_000, 1, "end", "low")], "tab long, t long, seq long, fingerprint string, risk_level string")
    end.selectExpr("tab", "TIMESTAMP_SECONDS(t) AS ts", "seq", "fingerprint", "risk_level").coalesce(1).write.mode(
        "append").parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    found = []

    def late():
        found.append(jobs.to_folder(jobs.stream_changes(arriving, delay="60 seconds"), str(tmp_path / "late"),
                                    str(tmp_path / "late_mark"), once=True))
        return found[0]

    jobs.drain(spark, late)
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in found[0].recentProgress) < 3000
    got = spark.read.parquet(str(tmp_path / "late")).filter("tab IS NOT NULL")
    want = drop_consecutive_duplicates(rows.filter("tab IS NOT NULL"))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    jobs.drain(spark, lambda: latest_log.stream_latest_log(
        arriving, str(tmp_path / "log"), str(tmp_path / "mark"), 3_600_000, once=True))
    got = latest_log.read_latest(spark, str(tmp_path / "log"))
    want = latest_analysis(rows.filter("tab IS NOT NULL"))
    assert got.count() == 1000
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))

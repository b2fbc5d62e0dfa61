import pytest

import __spark_entry__ as entry


def test_every_query_has_a_check_but_for_models():
    own = {n for n in entry.queries() if not n.startswith(("op", "pipeline"))}
    assert own - set(entry.oracle_sql()) == {
        "train_metrics", "model_text_scores"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 200 and "risk_score" in df.columns


@pytest.mark.parametrize("name", ["score_emails", "policy_verdicts", "pages_to_emails", "url_lines",
                                  "capture_changes", "stratified_split"])
def test_query_equals_its_check(spark, data, name):
    import duckdb
    db = duckdb.connect()
    for table in ("documents", "pages", "events", "labels"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    df = entry.queries()[name](spark, data)
    cur = db.execute(entry.oracle_sql()[name])
    heads = [d[0] for d in cur.description]
    assert sorted(heads) == sorted(df.columns)
    want = sorted(str(tuple(r)) for r in cur.fetchall())
    assert sorted(str(tuple(r)) for r in df.select(heads).collect()) == want


def test_worker_code_needs_no_installed_package():
    """Executors have the job's pickles only: load them where the package is not importable."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from baitline.operators.datasets import _read_message
    from baitline.streaming.jobs import _DropRepeats
    from baitline.streaming.latest_log import _Newer
    script = ("import pickle, sys; read, keep, newer = pickle.loads(sys.stdin.buffer.read());"
              "print(read('p', b'Subject: hi\\r\\n\\r\\nx')['subject'], type(keep).__name__, type(newer).__name__)")
    done = subprocess.run([sys.executable, "-c", script], cwd="/", capture_output=True,
                          input=cloudpickle.dumps((_read_message, _DropRepeats("v", ["ts"]), _Newer(["ts"], 1))))
    assert done.stdout.decode().split() == ["hi", "_DropRepeats", "_Newer"], done.stderr.decode()

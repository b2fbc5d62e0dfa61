"""Mail archives and quoted CSV read in many splits."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from baitline.operators.datasets import decode_mail, mail_to_training
from baitline.sources import mail_archive, readers
from baitline.sources.quoted_csv import ends_inside, read_quoted_csv
from baitline.streaming import jobs

MAIL = b"From: Ann <Ann@X.org>\nSubject: n%d\n\nSee https://a.org/%d\n\nFrom here on, text.\n>From there\n"


@pytest.fixture()
def small_blocks(spark):
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    yield lambda n: (spark.conf.set(name, str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "0"))
    spark.conf.set(name, old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


# CSV

def field(rng):
    kind = rng.randrange(7)
    if kind == 0:
        return ""
    if kind == 1:
        return '""'
    if kind == 2:
        return "pl\"ain" if rng.random() < 0.5 else "été"
    signs = ["a", "b", ",", "\n", "\r\n", '""', " ", "x,\"\"y", "\n\n"]
    return '"' + "".join(rng.choice(signs) for _ in range(rng.choice([1, 4, 30]))) + '"'


def table(rng, n, end):
    rows = [f"r{i},{field(rng)},{field(rng)},z" for i in range(n)]
    return "id,text,more,last" + end + end.join(rows) + (end if rng.random() < 0.5 else "")


def rows_of(df):
    # Spark's own reader makes LF of CRLF inside quotes where records end with CRLF.
    rows = [tuple(v.replace("\r\n", "\n") if isinstance(v, str) else v for v in r) for r in df.collect()]
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_quoted_csv_equals_one_task_per_file(spark, tmp_path, small_blocks, seed, end):
    rng = random.Random(seed)
    for k, n in enumerate((1, 40, 200)):
        (tmp_path / f"{k}.csv").write_bytes(table(rng, n, end).encode())
    want = rows_of(spark.read.option("header", True).option("quote", '"').option("escape", '"')
                   .option("multiLine", True).csv(str(tmp_path)))
    assert len(want) == 241
    for block in (60, 333, 1 << 20):
        small_blocks(block)
        assert rows_of(read_quoted_csv(spark, str(tmp_path))) == want
    small_blocks(60)
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 50


def test_one_record_over_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f"line {i}, \"\"so it is\"\"" for i in range(200))
    (tmp_path / "a.csv").write_text(f'﻿k,v\n1,"{long}"\n\n2,plain\n3,"open to the end\n')
    small_blocks(100)
    assert read_quoted_csv(spark, str(tmp_path)).filter("k = 1").first().v.count("\n") == 199
    got = {r.k: r.v for r in read_quoted_csv(spark, str(tmp_path)).collect()}
    assert got["1"] == long.replace('""', '"') and got["2"] == "plain" and len(got) == 3


def test_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("url,y_true\nu,1\n")
    (tmp_path / "b.csv").write_text("y_true,url\n1,u\n")
    with pytest.raises(Exception, match="another header"):
        read_quoted_csv(spark, str(tmp_path)).collect()
    (tmp_path / "b.csv").write_text('"url","y_true"\r\nv,0\r\n')
    assert rows_of(readers.read_labelled_urls(spark, str(tmp_path))) == [("u", 1), ("v", 0)]


def test_a_quote_opens_a_field_only_at_its_begin():
    for line, out, inside in [(b'a,"b', True, False), (b'a"b,c', False, False), (b'"a""b', True, False), (b"x", False, True),
                              (b'"a"x"y,z', False, False), (b'",""', True, False), (b'a","b', True, True),
                              (b'"",""', False, True), (b'', False, True)]:
        assert (ends_inside(line, False), ends_inside(line, True)) == (out, inside), line


# mail archives

def boxed(*numbers):
    mails = ((MAIL % (i, i)).replace(b"\n>From", b"\n>>From").replace(b"\nFrom h", b"\n>From h") for i in numbers)
    return b"".join(b"From x Thu Jan 1\n" + m + b"\n" for m in mails)


def boxes(folder, n=50):
    (folder / "in.mbox").write_bytes(boxed(*range(n)))
    for i in range(30):
        (folder / f"m{i:02d}.eml").write_bytes(MAIL % (1000 + i, i))
    (folder / "bad.mbox").write_bytes(b"no mailbox\n\nFrom y\nSubject: late\n\nbody\n")
    (folder / "broken.eml").write_bytes(b'From: "\r\n\r\nbody')
    (folder / ".hidden.eml").write_bytes(b"x")
    (folder / "_staged.eml").write_bytes(b"x")


@pytest.mark.parametrize("size", [37, 200, 64 << 20])
def test_every_mail_is_read_once_whatever_the_splits(spark, tmp_path, size):
    boxes(tmp_path)
    held = mail_archive.read_archive(spark, str(tmp_path), split_bytes=size)
    rows = held.collect()
    own = [r for r in rows if r.path.endswith("in.mbox")]
    assert sorted(r.content for r in own) == sorted(MAIL % (i, i) for i in range(50))
    assert len({r.place for r in own}) == 50
    assert sorted(r.content for r in rows if "/m" in r.path) == sorted(MAIL % (1000 + i, i) for i in range(30))
    assert [(r.error is not None, r.content) for r in rows if "bad" in r.path and r.place == 0] == [(True, None)]
    assert held.rdd.getNumPartitions() > 3 if size < 1000 else held.rdd.getNumPartitions() == 1


def test_unreadable_mail_is_told_with_its_reason(spark, tmp_path):
    boxes(tmp_path)
    good, bad = readers.read_mail_archive_checked(spark, str(tmp_path))
    assert good.count() == 50 + 30 + 1
    told = {os.path.basename(r.path): r.error for r in bad.collect()}
    assert set(told) == {"bad.mbox", "broken.eml"}
    assert told["broken.eml"].startswith("IndexError") and "not a mailbox" in told["bad.mbox"]
    with pytest.raises(Exception, match="FileNotFoundError"):
        mail_archive.read_archive(spark, str(tmp_path / "none")).collect()
    files = spark.createDataFrame([("a", None), ("b", bytearray(b"Subject: s\n\nx"))], "path string, content binary")
    assert [r.error for r in decode_mail(files).orderBy("path").collect()] == ["no content", None]
    (tmp_path / "empty").mkdir()
    assert mail_archive.read_archive(spark, str(tmp_path / "empty")).count() == 0


def test_path_filters_and_limit_prune_the_listing(spark, tmp_path):
    boxes(tmp_path)
    (tmp_path / "m05.eml").unlink()
    os.symlink(tmp_path / "nowhere", tmp_path / "m05.eml")  # listed as no file
    held = mail_archive.read_archive(spark, str(tmp_path))
    chosen = held.filter(F.col("path").endswith("m07.eml") & F.col("path").contains("/m"))
    assert chosen.count() == 1
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("PushedFilters", "") or "EndsWith" not in plan.split("BatchScan")[0]
    assert mail_archive.read_archive(spark, str(tmp_path), glob="*.eml", limit=3).count() == 3
    assert mail_archive.read_archive(spark, str(tmp_path), glob="m1*.eml", contents=False).filter(
        "content IS NULL").count() == 10


def test_written_boxes_read_back(spark, tmp_path):
    texts = [MAIL % (i, i) for i in range(20)]
    mails = spark.createDataFrame([(bytearray(t),) for t in texts], "content binary").repartition(3)
    mail_archive.write_boxes(mails, str(tmp_path / "out"))
    mail_archive.write_boxes(mails, str(tmp_path / "out"))  # a retry replaces
    got = mail_archive.read_archive(spark, f"file:{tmp_path}/out").collect()
    assert sorted(r.content for r in got) == sorted(texts)
    assert not [f for f in os.listdir(tmp_path / "out") if f.startswith("_")]


def test_stream_takes_each_file_once_and_goes_on_after_a_restart(spark, tmp_path):
    folder, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    folder.mkdir()

    def drained():
        arriving = readers.read_mail_archive_stream(spark, str(folder), settle_seconds=0)
        jobs.drain(spark, lambda: jobs.to_folder(arriving, out, mark, once=True))
        return sorted(r.subject for r in spark.read.parquet(out).collect())

    (folder / "a.eml").write_bytes(MAIL % (1, 1))
    assert drained() == ["n1"]
    time.sleep(0.02)
    (folder / "b.mbox").write_bytes(boxed(2, 3))
    assert drained() == ["n1", "n2", "n3"]
    assert drained() == ["n1", "n2", "n3"]
    whole = mail_to_training(decode_mail(mail_archive.read_archive(spark, str(folder))))
    assert sorted(r.urls for r in whole.collect()) == sorted(r.urls for r in spark.read.parquet(out).collect())


def test_mails_are_decoded_and_read_a_few_megabytes_at_a_time(tmp_path):
    import pyarrow as pa

    from baitline.operators import datasets
    from baitline.sources import mail_archive

    mails = [b"From: A <a@b.org>\r\nSubject: s%d\r\n\r\n" % i + b"text " * 4000 for i in range(500)]
    batch = pa.RecordBatch.from_pydict({"path": [f"{i}.eml" for i in range(501)], "place": [0] * 501,
                                        "content": [*mails, None], "error": [None] * 501})
    found = list(datasets._decoded(iter([batch])))
    assert [r["subject"] for b in found for r in b.to_pylist()] == [*(f"s{i}" for i in range(500)), None]
    assert found[-1].to_pylist()[-1]["error"] == "no content" and max(b.nbytes for b in found) < 3 << 20
    (tmp_path / "a.mbox").write_bytes(b"\n".join(b"From - x\n" + m + b"\n" for m in mails))
    split = mail_archive.pack(mail_archive.list_files(str(tmp_path), ["*.mbox"], False), 64 << 20)[0]
    read = list(mail_archive.read_split(split))
    assert [m.rstrip(b"\n") for b in read for m in b.column("content").to_pylist()] == mails and max(b.nbytes for b in read) < 3 << 20

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from baitline.operators import models
from baitline.operators.features import training_text
from helpers import by_id, email

ROWS = [("login now %d" % i, "verify your password account reset number%d" % (i % 3), 1)
        for i in range(12)] + [("hello %d" % i, "lunch meeting tomorrow at noon plan%d" % (i % 4), 0)
                               for i in range(30)]


@pytest.fixture(scope="module")
def train(spark):
    rows = [(i, "a@gmail.com", s, b, "http://x.org" if y else "", "", y)
            for i, (s, b, y) in enumerate(ROWS)]
    return training_text(spark.createDataFrame(
        rows, "id int, sender_email string, subject string, body_text string, urls string,"
              " attachments string, label int"))


@pytest.fixture(scope="module")
def text_model(train):
    return models.train_classifier(train, with_hand_features=False)


def test_tfidf_formula(train):
    model = models.fit_text_features(train)
    got = {r["text"]: r["v"] for r in model.transform(train).select(
        "text", vector_to_array("tfidf").alias("v")).collect()}
    vocabulary = model.stages[3].vocabulary
    docs = [re.findall(r"\w\w+", f"{s} {b}".lower()) for s, b, _ in ROWS]
    docs = [w + [" ".join(p) for p in zip(w, w[1:])] for w in docs]
    df = Counter(t for d in docs for t in set(d))
    assert set(vocabulary) == set(df)
    for (s, b, _), terms in zip(ROWS, docs):
        uses = Counter(terms)
        raw = np.array([uses[t] * (math.log((1 + len(ROWS)) / (1 + df[t])) + 1) for t in vocabulary])
        assert np.allclose(got[f"{s} {b}"], raw / np.linalg.norm(raw))


def test_vocabulary_limit_keeps_most_used(train):
    model = models.fit_text_features(train, 5)
    assert len(model.stages[3].vocabulary) == 5


def test_training_reaches_the_optimum(train):
    model = models.train_classifier(train)
    held = models.predict(train, model)
    rows = held.select(vector_to_array("features").alias("x"), "label").collect()
    x = np.array([r["x"] for r in rows])
    y = np.array([r["label"] for r in rows])
    n = len(y)
    w = np.where(y == 1, n / (2 * (y == 1).sum()), n / (2 * (y == 0).sum()))
    fitted = model.stages[-1]
    beta, b0 = fitted.coefficients.toArray(), fitted.intercept

    def loss(beta, b0):
        z = x @ beta + b0
        return (w * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * beta @ beta

    p = 1 / (1 + np.exp(-(x @ beta + b0)))
    gradient = x.T @ (w * (p - y)) + beta
    step = 0.05 * gradient / max(np.linalg.norm(gradient), 1e-12)
    best = min(loss(beta - t * step, b0) for t in np.linspace(0, 1, 20))
    assert loss(beta, b0) <= best * 1.02
    metrics = models.evaluate_model(train, model).first()
    assert metrics["accuracy"] == metrics["f1"] == 1.0


def test_model_survives_saving(train, text_model, tmp_path):
    models.save_model(text_model, str(tmp_path / "m"))
    back = models.load_model(str(tmp_path / "m"))
    want = [r["y_pred"] for r in models.predict(train, text_model).orderBy("id").collect()]
    assert [r["y_pred"] for r in models.predict(train, back).orderBy("id").collect()] == want
    assert models.load_model(str(tmp_path / "none")) is None and models.load_model("") is None


MAILS = [{"subject": "login", "body_text": "verify your password"}, {"subject": "lunch"}, {},
         {"body_text": "verify your password account reset " * 60}]


@pytest.mark.parametrize("aggregation", ["mean", "max"])
def test_model_scores_per_chunk(spark, text_model, aggregation):
    df = email(spark, *MAILS)
    got = models.score_text_with_model(df, text_model, aggregation)
    rows = {r["email_id"]: r for r in got.collect()}
    assert len(rows) == 4 and rows["3"]["chunk_count"] == 3
    assert rows["0"]["text_score"] > 50 > rows["1"]["text_score"]
    assert rows["2"]["text_score"] == 0.0 and rows["2"]["text_reasons"] == ["No text content found"]
    assert rows["0"]["text_reasons"][-1] == "Transformer text model evaluated this content"
    text = (MAILS[3]["body_text"]).strip()
    chunks = spark.createDataFrame([(text[s:s + 1200],) for s in range(0, len(text), 900)],
                                   "text string")
    p = [r[0] for r in text_model.transform(chunks).select(
        vector_to_array("probability")[1]).collect()]
    want = max(p) if aggregation == "max" else sum(p) / len(p)
    assert rows["3"]["text_score"] == pytest.approx(100 * want, abs=0.006)


def test_fallback_without_a_model(spark, text_model, tmp_path):
    df = email(spark, *MAILS)
    assert by_id(models.score_text_auto(df, str(tmp_path / "none")), "text_mode")["0"] == "heuristic"
    models.save_model(text_model, str(tmp_path / "m"))
    assert by_id(models.score_text_auto(df, str(tmp_path / "m")), "text_mode")["0"] == "transformer"


def test_user_function(spark):
    def two():
        return lambda texts: np.array([[0.0, len(t) / 10] for t in texts])

    def one():
        return lambda texts: np.array([[len(t) / 10] for t in texts])

    df = email(spark, {"body_text": "x" * 20}, {})
    for make in (one, two):
        got = by_id(models.score_text_with_fn(df, make), "text_score")
        assert got["0"] == pytest.approx(100 / (1 + math.exp(-2)), abs=0.006)
        assert got["1"] == 0.0


def test_large_logits_do_not_overflow(spark):
    df = spark.createDataFrame([([1000.0, 900.0],), ([-1000.0],), ([0.0, 800.0],)],
                               "l array<double>")
    got = [r[0] for r in df.select(models.class_one(F.col("l"))).collect()]
    assert got[0] == pytest.approx(0.0) and got[1] == pytest.approx(0.0) and got[2] == 1.0


def test_arrays_are_worked_on_a_few_values_at_a_time():
    import pyarrow as pa

    from baitline.operators.heavy_hitters import few_values

    ids = [[1] * 6, None, [], [2] * 3, [3] * 25, [4], [5] * 9]
    batch = pa.RecordBatch.from_pydict({"a": pa.array(ids, pa.list_(pa.int64())), "b": pa.array(ids, pa.list_(pa.int64()))})
    cut = list(few_values(batch, ["a", "b"], 20))
    assert [v for b in cut for v in b.column(0).to_pylist()] == ids
    assert all(b.num_rows == 1 or 2 * len(b.column(0).flatten()) <= 20 for b in cut) and len(cut) > 3
    assert [len(b.column(0).flatten()) for b in few_values(batch, [0], 1 << 18)] == [44]

"""The severity model on held-out labels, and on odd inputs."""

import numpy as np
from pyspark.sql import functions as F

from deedweb.llm.toxicity import SeverityModel, fit_cumulative_link, toxicity, train_severity


def test_held_out(spark):
    at = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = train_severity(docs, labels.where(fold), grade_col="toxic", graded_by_rate=True)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    got = toxicity(docs, model).join(labels.where(~fold), "doc_id").select("toxic", "rejected", "expected_severity").collect()
    caught = np.mean([r["rejected"] for r in got if r["toxic"]])
    wrong = np.mean([r["rejected"] for r in got if not r["toxic"]])
    assert caught > 0.95 and wrong < 0.005, (caught, wrong)
    assert all(0 <= r["expected_severity"] <= 2 for r in got)


def test_grades_are_ordered():
    rng = np.random.default_rng(6)
    grades = rng.integers(0, 4, 600)
    rows = [{"bad": float(g) + rng.normal(0, 0.2), "noise": float(rng.normal())} for g in grades]
    model = fit_cumulative_link(rows, grades, ["bad", "noise"])
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 3
    assert model.weights["bad"] > 5 * abs(model.weights["noise"])
    for g in range(4):
        score = model.weights["bad"] * g
        severity = sum(1 / (1 + np.exp(t - score)) for t in model.thresholds)
        assert abs(severity - g) < 0.5


def test_odd_inputs(spark):
    docs = spark.createDataFrame(
        [(1, "bad words here", "x"), (1, "bad words here", "x"), (2, None, "x"), (3, "", "x"), (None, "bad", None), (4, "fine " * 50_000, "x")],
        "doc_id long, text string, rejected string",
    )
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (4, 0), (4, 0), (9, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    for model in (train_severity(docs, labels, grade_col="toxic"), train_severity(docs, labels.where("false"), grade_col="toxic")):
        got = toxicity(docs, model)
        assert got.columns == ["doc_id", "text", "expected_severity", "p_toxic", "rejected"]
        assert got.count() == 6
    assert model == SeverityModel({}, ()) and not any(r["rejected"] for r in got.collect())
    assert toxicity(docs.where("false"), model).count() == 0
    assert train_severity(docs.where("false"), labels, grade_col="toxic") == SeverityModel({}, ())


def plain_words(text):
    out = {}
    for w in "".join(c if not c.isascii() or c.isalpha() else " " for c in (text or "").lower()).split():
        for f in {w, *(w[:k] + "-" for k in (4, 5, 6, 7) if len(w) > k)}:
            out[f] = out.get(f, 0) + 1
    return out


def test_against_brute_force(spark, sf):
    """Features, their choice, the model's score and the expected severity, recomputed plainly on the smallest table."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = train_severity(docs, labels, grade_col="toxic", graded_by_rate=True, min_z=2.0)
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["text"] is not None}
    grades = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["doc_id"] in texts}
    share, counts = np.mean(list(grades.values())), {}
    for d, grade in grades.items():
        for f in plain_words(texts[d]):
            n = counts.setdefault(f, [0, 0])
            n[0], n[1] = n[0] + 1, n[1] + grade
    z = {f: (up - share * n) / np.sqrt(share * (1 - share) * n) for f, (n, up) in counts.items() if n >= 3}
    assert model.weights.keys() == {f for f, x in z.items() if abs(x) >= 2.0}
    for r in toxicity(docs, model).collect():
        found = plain_words(r["text"])
        words = sum(n for f, n in found.items() if not f.endswith("-"))
        score = 40 * sum(n * model.weights.get(f, 0.0) for f, n in found.items()) / max(1, words) ** 0.8
        p = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
        assert abs(r["expected_severity"] - sum(p)) < 1e-9 and abs(r["p_toxic"] - p[0]) < 1e-9
        assert r["rejected"] == (r["p_toxic"] >= 0.3)


def test_clashing_names_and_string_ids(spark):
    rows = [(f"d{i}", "bad awful words" if i % 2 else "fine words here", "x", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, Rejected string, _text int")
    labels = spark.createDataFrame([(f"d{i}", i % 2) for i in range(20)], "doc_id string, toxic int")
    got = toxicity(docs, train_severity(docs, labels, grade_col="toxic", min_z=1.0))
    assert got.columns == ["doc_id", "text", "_text", "expected_severity", "p_toxic", "rejected"]
    assert {r["doc_id"] for r in got.where("rejected").collect()} == {f"d{i}" for i in range(1, 20, 2)}

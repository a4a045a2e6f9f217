"""Quality: held-out accuracy, shrinkage, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantlake.llm import quality
from plantlake.llm.quality import (
    STRENGTH,
    TARGETS,
    _others_rate,
    _sample,
    accepted,
    classify,
    fit_logistic,
    site_rates,
)

from .conftest import prose

LABELS = "doc_id long, quality int, toxic int"


def judged(spark, docs, labels):
    return classify(docs, labels, F.col("source"), F.col("lang"))


def test_held_out_accuracy(spark):
    """Fitted on half of the labels, right on the other half."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64(F.col("doc_id") + 1), F.lit(2)) == 0
    met = judged(spark, docs, labels.where(half)).join(labels.where(~half), "doc_id")
    clean = (F.col("quality") == 1) & (F.col("toxic") == 0)
    rates = met.agg(
        F.avg(((F.col("p_quality") >= 0.5) == (F.col("quality") == 1)).cast("int")).alias("quality"),
        F.avg(F.when(clean, F.col("keep").cast("int"))).alias("kept"),
        F.avg(F.when(F.col("toxic") == 1, (~F.col("keep")).cast("int"))).alias("caught"),
    ).first()
    assert rates["quality"] > 0.98 and rates["kept"] > 0.98 and rates["caught"] > 0.75


def test_logistic_model_finds_the_weights():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    y = rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))
    assert fit_logistic(x, y.astype(float)) == pytest.approx([2, -1, 0, 0.5], abs=0.2)


def rates(spark, *paths):
    """paths: host, path, documents, share that looks good."""
    rows = [(h, p, [8.0 if k < n * s else -8.0]) for h, p, n, s in paths for k in range(n)]
    scored = spark.createDataFrame(rows, "host string, path string, evidence array<double>")
    return {(r.host, r.path): r.rates[0] for r in site_rates(scored, [0.0]).collect()}


def test_sparse_sites_shrink_toward_their_host_and_the_whole(spark):
    got = rates(
        spark, ("a", "x", 400, 0.9), ("a", "y", 400, 0.8), ("a", "z", 1, 0.0), ("b", "x", 400, 0.1),
        ("c", "x", 1, 1.0), (None, None, 400, 0.5), ("d", None, 400, 0.3),
    )
    assert got[("a", "x")] == pytest.approx(0.9, abs=0.03) and got[("b", "x")] == pytest.approx(0.1, abs=0.03)
    assert 0.5 < got[("a", "z")] < 0.86  # one bad document on a good host
    assert 0.4 < got[("c", "x")] < 0.9  # one good document says little
    assert got[(None, None)] == pytest.approx(0.5, abs=0.03)


def test_sites_that_do_not_differ_share_one_rate(spark):
    got = rates(spark, *[(f"h{k}", "p", 50, 0.5) for k in range(20)])
    assert all(r == pytest.approx(0.5, abs=1e-3) for r in got.values()) and STRENGTH[1] > 1e5


def test_odd_rows_and_labels(spark, documents):
    texts = [prose(k, 30) for k in range(40)] + [prose(k, 30).upper() + " !! !!" for k in range(40)]
    rows = [(k, t, f"s{k % 3}") for k, t in enumerate(texts)]
    docs = documents(*rows, (None, None, None), (90, ""), (91, "x" * 200_000), (3, texts[3], "s0"))
    marks = [(k, int(k < 40), 0) for k in range(0, 80, 2)] + [(None, 1, 1), (2, 0, None), (4, None, 7), (999, 1, 1)]
    out = judged(spark, docs, spark.createDataFrame(marks, LABELS)).collect()
    assert len(out) == len(rows) + 4 and all(r.keep is not None for r in out)
    found = {r.doc_id: r.keep for r in out}
    assert sum(found[k] for k in range(40)) >= 38 and sum(found[k] for k in range(40, 80)) <= 2
    kept = accepted(docs, spark.createDataFrame(marks, LABELS), F.col("source"), F.col("lang"))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((r.doc_id or -1) for r in out if r.keep)


def test_without_labels_all_stay_and_an_empty_table_is_empty(spark, documents):
    none = spark.createDataFrame([], LABELS)
    out = classify(documents((1, "a"), (2, None)), none, F.col("source"), F.col("lang")).collect()
    assert [(r.p_quality, r.p_toxic, r.keep) for r in out] == [(0.5, 0.5, True)] * 2
    empty = documents((1, "a")).where("false")
    assert classify(empty, none, F.col("source"), F.col("lang")).collect() == []
    assert accepted(empty, none, F.col("source"), F.col("lang")).collect() == []


def test_the_sample_is_bounded_in_rows_and_full(spark, documents):
    """An id with a third of the rows gives one of them; labels without a document take no place."""
    docs = documents(*[(7, prose(k, 10)) for k in range(40)], *[(k, prose(k, 10)) for k in range(10, 90)])
    marks = [(k, k % 2, 0) for k in (7, *range(10, 90), *range(1000, 3000))]
    labels = spark.createDataFrame(marks, LABELS)
    everything = _sample(docs, labels, TARGETS, 10_000)
    assert everything.count() == 81 and everything.where("t0 is null").isEmpty()
    drawn = _sample(docs, labels, TARGETS, 50)
    assert drawn.count() == 50 and drawn.exceptAll(_sample(docs, labels, TARGETS, 50)).isEmpty()


def test_a_document_is_not_in_the_rate_it_meets(spark):
    """By brute force: the rates are worked out anew without each document."""
    rng = np.random.default_rng(3)
    rows = [(f"h{k % 3}", f"p{k % 7}", [float(e)]) for k, e in enumerate(rng.normal(0, 3, 60))] + [("h0", "alone", [-4.0])]
    prior = 0.4
    scored = spark.createDataFrame(rows, "host string, path string, evidence array<double>")
    sites = site_rates(scored, [prior])
    got = {tuple(r.evidence): r.rate for r in scored.join(sites, ["host", "path"]).withColumn("rate", _others_rate(0, [prior])).collect()}
    told = {(r.host, r.path): r.site[0] for r in sites.collect()}
    soft = lambda e: 1 / (1 + np.exp(-(e[0] + prior)))
    for i, (host, path, e) in enumerate(rows):
        rest = [r for j, r in enumerate(rows) if j != i]
        site = told[host, path]
        whole = np.mean([soft(x) for *_, x in rest])
        on_host = [soft(x) for h, _, x in rest if h == host]
        at_host = (sum(on_host) + site.host_strength * whole) / (len(on_host) + site.host_strength)
        on_path = [soft(x) for h, p, x in rest if (h, p) == (host, path)]
        want = (sum(on_path) + site.strength * at_host) / (len(on_path) + site.strength)
        assert got[tuple(e)] == pytest.approx(want)
        if path == "alone":
            assert want == pytest.approx(at_host)


def test_the_model_is_fitted_on_a_few_rows_at_a_time(monkeypatch):
    """Equal to one matrix, and no step holds more than a part of it."""
    rng = np.random.default_rng(6)
    x, asked = rng.normal(size=(1000, 4)).astype(np.float32), []
    y = (rng.random(1000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)

    def rows(start, end):
        asked.append(end - start)
        return x[start:end].astype(float)

    whole = fit_logistic(x.astype(float), y)
    monkeypatch.setattr(quality, "FIT_ROWS", 90)
    assert fit_logistic(rows, y) == pytest.approx(whole, rel=1e-9)
    assert max(asked) == 90

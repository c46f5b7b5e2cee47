"""Quality classifier against densities written out, and held-out labels."""

import zlib

import numpy as np
import pytest

from reelrank.llm import quality_classifier as qc
from reelrank.llm import queries

SF = "/root/testdata/sf0.01"


def normal_log_density(x, mean, cov):
    d = x - mean
    return -0.5 * d @ np.linalg.inv(cov) @ d - 0.5 * np.log(np.linalg.det(cov))


def test_margin_is_the_difference_of_log_densities():
    rng = np.random.default_rng(3)
    p = len(qc.STATISTICS)
    rows = [rng.normal(size=(60, p)) @ rng.normal(size=(p, p)) + k for k in (0, 2)]
    ones = [np.hstack([np.ones((60, 1)), r]) for r in rows]
    model = qc.discriminant(np.array([o.T @ o for o in ones]))
    pooled = np.sqrt(np.mean([r.var(axis=0) for r in rows], axis=0)) + 1e-6
    x = rng.normal(size=(9, p))
    expected = []
    for v in x:
        logs = [normal_log_density(v / pooled, r.mean(axis=0) / pooled, qc.shrunk(
            np.cov((r / pooled).T, bias=True), 60)) + np.log(0.5) for r in rows]
        expected.append(logs[1] - logs[0])
    np.testing.assert_allclose(model.margins(x), expected, rtol=1e-6)
    for f, w in zip(model.factors, model.whiteners):
        np.testing.assert_allclose(w @ f, np.eye(p), atol=1e-9)


def test_shrinkage_grows_as_rows_become_few():
    cov = np.diag([4.0, 1.0, 0.25])
    few, many = qc.shrunk(cov, 4), qc.shrunk(cov, 4000)
    assert np.linalg.cond(few) < np.linalg.cond(many) < np.linalg.cond(cov)
    assert np.all(np.linalg.eigvalsh(qc.shrunk(np.zeros((3, 3)), 2)) > 0)


def test_calibration_follows_the_labels():
    centres = np.linspace(-10, 10, 41)
    n = np.full(41, 1000.0)
    slope, shift = qc.calibrated(centres, n, n / (1 + np.exp(-(0.4 * centres - 1))))
    assert abs(slope - 0.4) < 0.01 and abs(shift + 1) < 0.02


def test_statistics_by_hand():
    s = dict(zip(qc.STATISTICS, qc.statistics("Aé b b\nAé b b\n\n9!".encode())))
    share = lambda a, n: np.log((a + 1) / (n + 20))
    assert s["words"] == pytest.approx(np.log(8))
    assert s["length"] == pytest.approx(share(10, 7))
    assert s["capitals"] == pytest.approx(share(2, 7))
    assert s["doubled"] == pytest.approx(share(2, 7))
    assert s["commonest"] == pytest.approx(share(4, 7))
    assert s["repeated_lines"] == pytest.approx(share(1, 3))
    assert s["breaks"] == pytest.approx(share(3, 7))
    assert all(np.isfinite(qc.statistics(b"")))


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.op11_quality_classifier(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert {r["doc_id"] for r in got.values() if r["held_out"]} >= {r["doc_id"] for r in held}
    right = [got[r["doc_id"]]["predicted"] == r["quality"] for r in held]
    assert np.mean(right) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_labels_of_the_held_out_fold_are_not_read(spark, make):
    docs = make([(i, "word " * (i % 7 + 1)) for i in range(40)])
    rows = qc.document_statistics(docs)
    mark = lambda f: spark.createDataFrame(
        [(i, f(i)) for i in range(40)], "doc_id long, quality int")
    out = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0]
    a = qc.train(rows, mark(lambda i: i % 2))
    b = qc.train(rows, mark(lambda i: 1 - i % 2 if i in out else i % 2))
    np.testing.assert_allclose(a.means, b.means)
    assert a.slope == pytest.approx(b.slope)


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, None), (3, 0), (7, 1), (7, 0), (9, 1), (None, 1)],
        "doc_id long, quality int")
    rows = qc.document_statistics(odd)
    model = qc.train(rows, labels)
    got = qc.score(rows, model).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in got if r["doc_id"] is not None) == \
        sorted((r["doc_id"] is None, r["doc_id"]) for r in odd.collect() if r["doc_id"] is not None)
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert qc.score(qc.document_statistics(none), model).count() == 0
    constant = qc.train(rows, labels.where("quality = 1"))
    assert len({r["score"] for r in qc.score(rows, constant).collect()}) == 1
    empty = qc.train(qc.document_statistics(none), labels)
    assert 0 <= qc.score(rows, empty).first()["score"] <= 1

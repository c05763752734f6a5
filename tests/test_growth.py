"""Steps whose cost must follow the input: what they may not exchange, keep or do twice."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tagmill.operators import metric_cluster, model, simhash
from tagmill.plans.catalogue import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def texts(spark, tmp_path):
    """Documents, some of which repeat an id in the same or another language, and their labels."""
    words = "ab cd ef gh ij kl mn op".split()
    docs = [(i % 36, " ".join(words[(i * 3 + k) % 8] for k in range(i % 6 + 1)), ("x", "y", None)[i // 13 % 3]) for i in range(40)]
    docs += [docs[1], docs[2], (5, None, "x"), (36, " ".join(f"w{k}" for k in range(300)), None)]
    for name, rows, schema in (("documents", docs, "doc_id bigint, text string, lang string"),
                               ("labels", [(i, int(i % 3 > 0), 0) for i in range(37)], "doc_id bigint, quality bigint, toxic bigint")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path), docs


def test_pairs_are_measured_in_little_memory():
    rng = np.random.default_rng(3)
    for scale, width in ((1.0, 64), (1e-3, 5), (1e4, 64), (0.0, 3)):
        a, b = (rng.normal(size=(n, width)) * scale for n in (90, 70))
        b[:20] = a[:20]
        away = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
        for eps in (np.median(away), away[3, 40], 1e-9):
            assert (metric_cluster._near(a, b, eps) == (away <= eps)).all()
    a, b = rng.normal(size=(1024, 64)), rng.normal(size=(256, 64))
    tracemalloc.start()
    metric_cluster._near(a, b, 1.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * 1024 * 256 * 8


def test_words_of_languages_are_not_exchanged(spark, texts):
    folder, docs = texts
    out = QUERIES["t2_vocab_top_families"](spark, folder)
    above = plan(out).split("Generate")[0]
    assert not [x for x in above.splitlines() if "Aggregate [" in x and "entity#" in x]
    triples = {(lang, i, w, int(i % 3 > 0)) for i, text, lang in docs if lang and text for w in text.split(" ")}
    assert {r.family for r in out.collect()} == {x[0] for x in triples}
    for family in ("x", "y"):
        mine = [x for x in triples if x[0] == family]
        stats = {w: (sum(x[3] for x in mine if x[2] == w), sum(x[2] == w for x in mine)) for w in {x[2] for x in mine}}
        pos, total = sum(x[3] for x in mine), len(mine)

        def score(w):
            def part(p, n):
                return n / total * sum(-s * np.log(s + 1e-7) for s in (p / n, 1 - p / n))
            p, n = stats[w]
            return round(part(p, n) + part(pos - p, total - n), 12)
        want = sorted(stats, key=lambda w: (score(w), w))
        assert [r.item for r in sorted(out.collect(), key=lambda r: r.idx) if r.family == family] == want


def test_equal_weights_exchange_sums_only(spark):
    rows = [(e, f"t{(e * 5 + k * k) % 17}" if k % 7 else None) for e in range(30) for k in range(e + 1)] + [(None, "t1")]
    tokens = spark.createDataFrame(rows, "entity bigint, token string").repartition(3)
    weighted = tokens.selectExpr("*", "1e0 AS weight")
    for bits in (64, 128):
        want = {r.entity: r.bits for r in simhash.simhash(weighted, bits).collect()}
        for colocate in (False, True):
            out = simhash.simhash(tokens, bits, colocate=colocate, uniform=1.0)
            assert {r.entity: r.bits for r in out.collect()} == want and out.count() == 30
        below = plan(simhash.simhash(tokens, bits, uniform=1.0)).split("MapInPandas")[1]
        assert "Aggregate" not in below and "Join" not in below


def test_documents_exchange_sums_only(spark, texts):
    for name in ("f5_simhash_documents", "f9_bits_to_indices"):
        below = plan(QUERIES[name](spark, texts[0])).split("MapInPandas")[1]
        assert "Aggregate" not in below and "Join" not in below


def test_stored_model_splits_texts_once_for_both_scores(spark, texts, monkeypatch):
    train = model.train
    monkeypatch.setattr(model, "train", lambda df: train(df, rounds=1, depth=1))
    out = QUERIES["s14_stored_model"](spark, texts[0])
    assert "split(" not in plan(out)
    assert {r.entity for r in out.collect()} == {d[0] for d in texts[1]}


def test_points_with_many_neighbours_are_compared_with_few(monkeypatch):
    """Blocks of scattered points, each with hundreds of neighbours: a few decide about core points, and one joins a point to its piece."""
    rng, pairs = np.random.default_rng(5), []
    meeting = metric_cluster._meeting

    def counted(a, b, eps):
        near = meeting(a, b, eps)
        return lambda who, mine: (pairs.append(len(who) * len(mine)), near(who, mine))[1]

    monkeypatch.setattr(metric_cluster, "_meeting", counted)
    monkeypatch.setattr(metric_cluster, "MATRIX", 1 << 12)
    points, n = rng.random((3000, 8)), 3000
    cell = (points[:, 0] * 4).astype(np.int32)
    pivots = np.stack([points[cell == c].mean(0) for c in range(4)])
    away = metric_cluster._away(points, pivots)
    far = away[np.arange(n), cell]
    outer = np.array([far[cell == c].max() for c in range(4)])
    one = np.ones((2, 4), np.int64)
    layout = metric_cluster._Layout(pivots, 0.7, np.zeros(4, bool), np.full(4, -1), np.zeros(4), outer, np.arange(4), 0 * one, one,
                                    np.arange(4), 1, 1)
    columns = {"id": np.arange(n), "w": np.ones(n, np.int64), "vec": pa.array(list(points)), "cell": cell, "far": far,
               "block": np.zeros(n, np.int32), "c": np.zeros(n, np.int64), "comp": np.arange(n)}
    table = pa.table(columns)
    near = metric_cluster._near(points, points, 0.7)
    pairs.clear()
    found = metric_cluster._count(layout, 5)(table, table)
    assert ((found["c"].to_numpy() >= 5) == (near.sum(1) >= 5)).all()
    assert sum(pairs) < 0.3 * n * n
    pairs.clear()
    links = metric_cluster._link(layout)(table, table)
    piece = metric_cluster._merged(np.arange(n), links["src"].to_numpy(), links["dst"].to_numpy())
    want = metric_cluster._merged(np.arange(n), *np.nonzero(near))
    assert (piece == want).all() and sum(pairs) < 0.3 * n * n

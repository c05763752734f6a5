"""Hand-computed examples."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tagmill.functions import hashing
from tagmill.functions.hashing import fnv, fnv_value, folder, offset_basis
from tagmill.operators import cohort, ensemble, evaluate, selection, simhash
from tagmill.sources import readers

TRIPLES = ([("e%d" % i, "A", int(i < 3)) for i in range(4)] + [("e%d" % i, "B", int(i < 1)) for i in range(4, 8)]
           + [("e%d" % i, "C", int(i < 10)) for i in range(8, 12)])
TRIPLES = [(e, i, 1 if (i, k) in {("A", 0), ("A", 1), ("A", 2), ("B", 4), ("C", 8), ("C", 9)} else 0)
           for (e, i, _), k in zip(TRIPLES, range(12))]


@pytest.fixture(scope="module")
def triples(spark):
    return spark.createDataFrame(TRIPLES, "entity string, item string, label int")


def test_entropy_and_ranks(triples):
    scored = selection.entropy(triples)
    rows = {r.item: (r.pos, r.n, r.entropy) for r in scored.collect()}
    assert rows["A"][:2] == (3, 4) and rows["B"][:2] == (1, 4) and rows["C"][:2] == (2, 4)
    assert rows["A"][2] == pytest.approx(0.628487007, abs=1e-8)
    assert rows["B"][2] == pytest.approx(0.628487007, abs=1e-8)
    assert rows["C"][2] == pytest.approx(0.693146981, abs=1e-8)
    row = {r.item: r["rank"] for r in selection.rank(scored, "row").collect()}
    dense = {r.item: r["rank"] for r in selection.rank(scored, "dense").collect()}
    assert row == {"A": 1, "B": 2, "C": 3} and dense == {"A": 1, "B": 1, "C": 2}
    assert all(dense[i] <= row[i] for i in row)


def test_item_in_every_row_gives_nan_and_sorts_last(spark):
    rows = [("e%d" % i, "X", i % 2) for i in range(12)]
    df = spark.createDataFrame(rows, "entity string, item string, label int")
    assert math.isnan(selection.entropy(df).first().entropy)


def test_stray_labels_are_rejected_and_missing_class_counts_three(spark):
    df = spark.createDataFrame([("a", "X", 1), ("b", "X", 1), ("c", "Y", 1), ("d", "Y", 2)], "entity string, item string, label int")
    assert {(r.item, r.pos, r.n) for r in selection.item_stats(df).collect()} == {("X", 2, 2), ("Y", 1, 1)}
    counts = selection.class_counts(df).first()
    assert (counts.all_pos, counts.all_neg) == (3, 3)


def test_chi_entropy_gini(spark):
    rows = [("X", 0)] + [("X", 1)] * 3 + [("Y", 1)] * 2 + [("Z", 0)] * 4
    df = spark.createDataFrame([("e", i, lab) for i, lab in rows], "entity string, item string, label int")
    out = {r.item: (r.chi, r.ent, r.gini) for r in selection.chi_entropy_gini(df).collect()}
    assert out["X"] == pytest.approx((1.414213562, 0.811278124, 0.625), abs=1e-8)
    assert out["Y"] == pytest.approx((2.0, 2.6575e-07, 1.0), abs=1e-8)


def test_fnv(spark):
    assert offset_basis(32) == 2166136261 and offset_basis(64) == 14695981039346656037
    assert offset_basis(128) == 144066263297769815596495629667062367629
    assert fnv_value("a", 32) == 3826002220 and fnv_value("foobar", 32) == 3214735720
    assert fnv_value("a", 64) == 12638187200555641996
    assert fnv_value("a", 48) == fnv_value("a", 64)
    df = spark.createDataFrame([("a",), (None,), ("foobar",)], "t string")
    assert [r[0] for r in df.select(F.hex(fnv("t", 32))).collect()] == ["E40C292C", None, "BF9CF968"]
    for bits in (128, 256, 512, 1024):
        assert 0 <= fnv_value("text", bits, "1") < 1 << bits


def one_by_one(text, bits, variant):
    """The hash by whole numbers, a code unit at a time."""
    value, prime = offset_basis(bits), hashing.FNV_PRIMES[bits]
    data = text.encode("utf-16-le", "surrogatepass")
    for i in range(0, len(data), 2):
        unit = int.from_bytes(data[i:i + 2], "little")
        value = (value ^ unit) * prime % (1 << bits) if variant == "1a" else (value * prime % (1 << bits)) ^ unit
    return value


@pytest.mark.parametrize("bits", [32, 64, 128, 256, 512, 1024])
@pytest.mark.parametrize("variant", ["1", "1a"])
def test_fnv_of_many_texts_in_step(bits, variant, monkeypatch):
    monkeypatch.setattr(hashing, "TOGETHER", 50)
    r = random.Random(bits)
    texts = ["".join(r.choice("aZ0 é漢🙂\uffff") for _ in range(r.choice((0, 1, 5, 40, 300)))) for _ in range(120)]
    rows = folder(bits, variant)(texts)
    assert [int.from_bytes(x.tobytes(), "little") for x in rows] == [one_by_one(t, bits, variant) for t in texts]
    assert folder(bits, variant)([]).shape == (0, bits // 8)


@pytest.mark.parametrize("bits", [64, 128, 256])
def test_simhash_does_not_depend_on_the_scale_of_weights(spark, bits):
    r = random.Random(1)
    rows = [("one", "a", 1.0), ("tie", "a", 1.0), ("tie", "b", 2.0), ("tie", "c", 3.0), ("tie", "d", 0.3), ("tie", "e", 0.1), ("tie", "f", 0.2)]
    rows += [(f"e{i % 7}", f"t{r.randrange(60)}", r.choice((0.1, 0.2, 0.3, 1.0, 1e-3)) * r.choice((1, -1))) for i in range(500)]
    found = []
    for factor in (1.0, 1e-12, 1e12, 1e-200):
        df = spark.createDataFrame([(e, t, w * factor) for e, t, w in rows], "entity string, token string, weight double")
        found.append({x.entity: x.bits for x in simhash.simhash(df.repartition(4), bits).collect()})
    assert found[0] == found[1] == found[2] == found[3]
    value = one_by_one("a", bits, "1a")
    assert found[0]["one"] == "".join(str(value >> i & 1) for i in range(bits))


def test_simhash_of_odd_weights(spark):
    rows = [("n", "a", None), ("nan", "a", float("nan")), ("inf", "a", float("inf")), ("inf", "b", 1.0), ("tiny", "a", 5e-324), (None, "a", 1.0)]
    df = spark.createDataFrame(rows, "entity string, token string, weight double")
    out = {x.entity: x.bits for x in simhash.simhash(df, 64).collect()}
    a = "".join(str(one_by_one("a", 64, "1a") >> i & 1) for i in range(64))
    assert out == {"n": "1" * 64, "nan": "1" * 64, "inf": a, "tiny": a}


FNV1_PRINT = "0011010111101101100000000110000100110010101111011100011011110101"
FNV1A_PRINT = "0100010011010000010000000110000100110010011101111100011011110101"


@pytest.mark.parametrize("variant, bits", [("1", FNV1_PRINT), ("1a", FNV1A_PRINT)])
@pytest.mark.parametrize("colocate", [False, True])
def test_simhash(spark, variant, bits, colocate):
    rows = [("x", "ai", 1.1), ("x", "d", 2.0), ("x", "s", 3.0), ("x", "s", 4.0), ("none", None, 1.0), ("zero", "q", 0.0)]
    df = spark.createDataFrame(rows, "entity string, token string, weight double").repartition(5)
    out = {r.entity: r.bits for r in simhash.simhash(df, 64, variant, colocate).collect()}
    assert out == {"x": bits, "none": "1" * 64, "zero": "1" * 64}


def test_simhash_chunks_agree_with_one_by_one(spark, monkeypatch):
    tokens = [("e%d" % (i % 3), "t%d" % i, float(i % 5) - 1) for i in range(60)]
    df = spark.createDataFrame(tokens, "entity string, token string, weight double").repartition(4)
    out = {r.entity: r.bits for r in simhash.simhash(df, 256).collect()}
    for entity, bits in out.items():
        sums = [0.0] * 256
        for e, t, w in tokens:
            if e == entity:
                value = fnv_value(t, 256)
                for i in range(256):
                    sums[i] += w if value >> i & 1 else -w
        assert bits == "".join("1" if s >= 0 else "0" for s in sums)


def test_to_indices(spark):
    df = spark.createDataFrame([("a", "0101"), ("b", "0000")], "entity string, bits string")
    assert {r.entity: r.idxs for r in simhash.to_indices(df, 5).collect()} == {"a": [6, 8], "b": []}


@pytest.mark.parametrize("rows, expected", [
    ([(.9, 1), (.8, 1), (.7, 0), (.6, 1), (.55, 0), (.4, 0)], 0.888888889),
    ([(.5, 1), (.5, 0), (.9, 1), (.1, 0)], 0.875),
    ([(.5, 1), (.6, 1)], 0.5),
    ([(.5, 0), (.6, 0)], 0.5),
])
def test_auc(spark, rows, expected):
    df = spark.createDataFrame(rows, "score double, label int")
    assert evaluate.auc(df).first().auc == pytest.approx(expected, abs=1e-8)


def test_auc_equals_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(500).select((F.xxhash64("id") % 97 / 97.0).alias("score"), (F.xxhash64("id", F.lit(1)) % 3 == 0).cast("int").alias("label"))
    reference = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(df)
    got = evaluate.auc(df).first().auc
    assert 0 <= got <= 1 and got == pytest.approx(reference, abs=1e-6)


def test_tags_and_pseudo_labels(spark):
    rows = [("a", .97, .70), ("b", .97, .10), ("c", .60, .45), ("d", .65, .41), ("e", .50, .15)]
    df = spark.createDataFrame(rows, "entity string, smax double, smin double")
    tags = {r.entity: (r.tag, round(r.value, 6)) for r in ensemble.tag(df).collect()}
    assert tags == {"a": ("pos", 97), "b": ("neg", 90), "d": ("pos", 65), "e": ("neg", 85)}
    assert len(tags) <= df.count()
    pseudo = {r.entity: r.label for r in ensemble.pseudo_labels(df).collect()}
    assert pseudo == {"a": 1, "b": 1, "e": 0}


def test_date_ranges():
    days = readers.date_window("2017-02-10", 10)
    assert len(days) == 11 and days[0] == date(2017, 1, 31) and days[-1] == date(2017, 2, 10)
    month = readers.month_days("2017-07")
    assert len(month) == 31 and month[0] == date(2017, 7, 1) and month[-1] == date(2017, 7, 31)
    assert len(readers.month_days("2016-02")) == 29


def test_framed_binary(spark):
    df = spark.createDataFrame([(bytearray(b'{"ts":17}\x00BODY\xff'),), (bytearray(b"no frame"),)], "value binary")
    rows = readers.split_framed(df).collect()
    assert len(rows) == 1 and rows[0].ts == 17 and bytes(rows[0].body).hex().upper() == "424F4459FF"


def test_modal_value(spark):
    rows = [("e", i, v) for i, v in enumerate("xyyxxz")] + [("t", 0, "q"), ("t", 1, "p")]
    df = spark.createDataFrame(rows, "entity string, period int, value string")
    assert {r.entity: (r.value, r.freq) for r in cohort.modal(df).collect()} == {"e": ("x", 3), "t": ("p", 1)}

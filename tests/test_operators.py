"""Ranking, splits, text formats, decisions about odd input."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagmill import session
from tagmill.functions import normalize as n
from tagmill.functions.geometry import contains, in_box
from tagmill.operators import bags, campaign, cohort, features, geo, identity, labels, model, ranking, selection, sessions, trainset, vocab
from tagmill.operators.evaluate import auc
from tagmill.sources import libsvm, readers, sinks


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# Ranking.

def test_global_index_counts_on_over_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    out = ranking.global_index(df, ["v"], 5)
    assert all(r.idx == r.v + 5 for r in out.collect())


def test_group_and_dense_index_with_a_heavy_group(spark):
    rng = random.Random(1)
    data = [("hot" if i % 3 == 0 else f"g{i % 50}", rng.randrange(40), i) for i in range(900)]
    df = spark.createDataFrame(data, "g string, v int, id int").repartition(6)
    ordered = {}
    for g, v, i in sorted(data):
        ordered.setdefault(g, []).append((v, i))
    for r in ranking.group_index(df, ["g"], ["v", "id"]).collect():
        assert ordered[r.g][r["rank"] - 1] == (r.v, r.id)
    levels = {g: sorted({v for v, _ in xs}) for g, xs in ordered.items()}
    for r in ranking.dense_index(df, ["g"], "v").collect():
        assert levels[r.g][r["rank"] - 1] == r.v


def test_running_sums(spark):
    df = spark.range(200).select("id", (F.col("id") % 7).alias("w")).repartition(5)
    seen = 0
    for r in sorted(ranking.running_sums(df, [F.desc("id")], {"before": "w"}).collect(), key=lambda r: -r.id):
        assert r.before == seen
        seen += r.w


@pytest.mark.parametrize("quota", [0, 1, 37, 100, 5000])
def test_smallest_by_hash_is_exact(spark, quota):
    df = spark.range(600).select("id", (F.col("id") % 3 == 0).alias("g"), F.md5(F.col("id").cast("string")).alias("h"),
                                 F.lit(quota).alias("q"))
    everything = df.collect()
    out = ranking.smallest_by_hash(df, ["g"], "h", ["id"], "q", prefix=1)
    for g in (True, False):
        expected = sorted((r.h, r.id) for r in everything if r.g == g)[:quota]
        assert sorted((r.h, r.id) for r in out.filter(F.col("g") == g).collect()) == expected


# Splits do not depend on partitioning.

def test_holdouts_and_batches_are_repeatable(spark):
    df = spark.range(2000).withColumnRenamed("id", "entity")
    for split in (lambda d: trainset.repeated_holdout(d, 0.8), trainset.batches, trainset.folds):
        assert rows(split(df.repartition(3))) == rows(split(df.repartition(8)))
    share = trainset.repeated_holdout(df, 0.2).groupBy("seed").agg(F.avg(F.col("is_train").cast("int")).alias("s")).collect()
    assert len(share) == 5 and all(0.75 < r.s < 0.85 for r in share)
    sizes = [r["count"] for r in trainset.batches(df).groupBy("batch").count().collect()]
    assert len(sizes) == 5 and all(300 < s < 500 for s in sizes)


def test_balance(spark):
    df = spark.range(1000).select(F.col("id").alias("entity"), (F.col("id") % 10 == 0).cast("int").alias("label"), F.lit("1:1 2:1").alias("features"))
    got = {r.label: r.n for r in trainset.class_counts(trainset.balance(df)).collect()}
    assert got == {0: 100, 1: 100}
    assert {r.features for r in trainset.balance(df).collect()} == {"1:1 2:1"}


def test_intersection_is_over_all_families(spark):
    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "entity string")

    known = spark.createDataFrame([("a", 1), ("b", 0), ("c", 1), ("c", 0)], "entity string, label int")
    assert rows(trainset.intersect([ids("a", "b", "a"), ids("b", "c", "a"), ids("b", "z")], known)) == [("b", 0)]
    assert rows(trainset.intersect([ids("a", "c")], known)) == [("a", 1), ("c", 1)]


# Parsing.

def test_defaults_malformed_and_quotes(spark):
    df = spark.createDataFrame([("a\t1",), ("b",), ("c\tx",), ("",)], "value string")
    assert rows(n.safe_split(df, "value", {"k": (0, "string"), "v": (1, "int")})) == [("a", 1)]
    assert rows(n.with_defaults(df, "value", {"k": (0, "none"), "v": (1, "missing")})) == [
        ("", "missing"), ("a", "1"), ("b", "missing"), ("c", "x")]
    quoted = spark.createDataFrame([('"a"',), ('""a',), ("a",), ('a"b',)], "v string")
    assert [r[0] for r in quoted.select(n.strip_quotes("v")).collect()] == ["a", '"a', "a", 'a"b']


def test_json_getters(spark):
    df = spark.createDataFrame([('{"s":"x","i":3,"a":["p"]}',), ("{}",), ("broken",)], "j string")
    got = df.select(*n.json_fields("j", {"s": "string", "i": "int", "d": "double", "f": "boolean", "a": "array<string>"}))
    assert [tuple(r) for r in got.collect()] == [("x", 3, 0.0, False, ["p"]), (None, 0, 0.0, False, []), (None, 0, 0.0, False, [])]


def test_sets_and_sizes(spark):
    df = spark.createDataFrame([("a", ["46001", "46002"], ["1"]), ("b", [], ["1"]), ("c", None, ["2"]), ("d", ["46001"], [])],
                               "entity string, carriers array<string>, idents array<string>")
    assert rows(df.filter(n.has_any("carriers", ["46001", "46006"])).select("entity")) == [("a",), ("d",)]
    assert rows(cohort.bounded_sets(df, ["carriers", "idents"], 3).select("entity")) == [("a",)]
    assert rows(bags.union_sets(df, "carriers", "idents")) == [
        ("a", "1"), ("a", "46001"), ("a", "46002"), ("b", "1"), ("c", "2"), ("d", "46001")]


def test_bag_merge_is_associative(spark):
    text = [("e", "a:1,b:2"), ("e", "b:3,broken,c:x"), ("f", "a:1")]
    parts = [bags.parse(spark.createDataFrame([t], "entity string, bag string")) for t in text]
    once = rows(bags.merge(*parts))
    assert once == rows(bags.merge(bags.merge(parts[0], parts[1]), parts[2])) == [("e", "a", 1), ("e", "b", 5), ("f", "a", 1)]
    assert rows(bags.to_text(bags.merge(*parts))) == [("e", "a:1,b:5"), ("f", "a:1")]


def test_run_list_item_counts_once_per_row(spark):
    df = spark.createDataFrame([("e", ["x", "x", None]), ("e", ["x"])], "entity string, items array<string>")
    assert rows(bags.count_items(df, "items")) == [("e", "x", 2)]


def test_labels(spark):
    known = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("c", None)], "entity string, label int")
    data = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("d",)], "entity string")
    assert rows(labels.attach(data, known)) == [("a", 1), ("a", 1), ("b", 0)]
    assert labels.update(known, None) is known


def test_latest_identifier_and_confirmation(spark):
    df = spark.createDataFrame([("e", "I1", 20170101), ("e", "I3", 20170201), ("e", "I2", 20170201)], "entity string, ident string, day int")
    latest = identity.latest(df)
    assert rows(latest) == [("e", "I3")]
    for known, expected in ((["i3"], 1), (["I3", "i1"], 0)):
        lists = spark.createDataFrame([("e", known)], "entity string, idents array<string>")
        assert identity.confirm(latest, lists).count() == expected


def test_cap_keeps_first_records_and_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("entity"), (100 - F.col("id")).alias("time"))
    kept = sessions.cap_records(df, ["time"], 20)
    assert kept.count() == 40 and kept.agg(F.max("time")).first()[0] == 40
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_campaign_log(spark):
    df = spark.createDataFrame([("x,y,bc:1,sc:2,fb,z,id:A-b 1,m",), ("short,line",), ("x,y,bc:1,sc,fb,z,id:q,m",)], "value string")
    log = campaign.parse_log(df)
    assert rows(log) == [("ab1", "1", "2", "fb", "m")]
    assert rows(campaign.campaigns_per_entity(log)) == [("ab1", "1"), ("ab1", "2")]


def test_triples_skip_nulls_and_repeats(spark):
    df = spark.createDataFrame([("a", ['"x"', "x", None, "null"], ["m"]), ("b", None, ["m"]), ("c", ["x"], ["m"])],
                               "entity string, apps array<string>, models array<string>")
    known = spark.createDataFrame([("a", 1), ("b", 0)], "entity string, label int")
    out = selection.triples(df, known, {"app": "apps", "model": "models"})
    assert rows(out) == [("app", "a", "x", 1), ("model", "a", "m", 1), ("model", "b", "m", 0)]


# Vocabularies and sparse vectors.

def test_encode_modes(spark):
    data = spark.createDataFrame([("e", "a"), ("e", "a"), ("e", "b"), ("e", "zz"), ("f", "zz")], "entity string, item string")
    words = spark.createDataFrame([("a", 1), ("b", 2)], "item string, idx int")
    tags = spark.createDataFrame([("a", [0, 1]), ("zz", [1])], "item string, tags array<int>")
    assert rows(vocab.encode(data, words)) == [("e", [1, 2], [1.0, 1.0])]
    assert rows(vocab.encode(data, words, "count")) == [("e", [1, 2], [2.0, 1.0])]
    assert rows(vocab.encode_with_tags(data, words, tags, 2)) == [("e", [1, 2, 3, 4], [1.0] * 4), ("f", [4], [1.0])]
    assert rows(vocab.encode_with_tags(data, words, tags, 2, "count")) == [("e", [1, 2, 3, 4], [2.0, 1.0, 2.0, 3.0]), ("f", [4], [1.0])]


def test_tag_encoding_is_summed_entity_by_entity(spark, monkeypatch):
    """No table of all pairs of entity and index, no tag lists in an exchange; the same result on either path."""
    items = [(e, f"i{(e or 0) * 7 % 11 + k % 5}", k % 3 + 1) for e in [*range(40), None] for k in range(e or 9)] + [(3, None, 2), (4, "i1", None)]
    data = spark.createDataFrame(items, "entity bigint, item string, cnt bigint")
    words = spark.createDataFrame([(f"i{k}", k) for k in range(6)], "item string, idx int")
    shown = {f"i{k}": [k % 4, 3, *([None] if k == 2 else [])] for k in range(3, 14)} | {"i0": None}
    tags = spark.createDataFrame([*shown.items(), (None, [1])], "item string, tags array<int>")
    want, seen = {}, set()
    for entity, item, cnt in items:
        for idx in [*([int(item[1:])] if item in {f"i{k}" for k in range(6)} else []), *(t + 7 for t in shown.get(item) or [] if t is not None)]:
            seen.add((entity, idx))
            if cnt is not None:
                want[entity, idx] = want.get((entity, idx), 0.0) + cnt
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for small in (True, False):
            monkeypatch.setattr(vocab, "is_small", lambda *_, small=small: small)
            out = vocab.encode_with_tags_long(data, words, tags, 6, "count")
            plan = out._jdf.queryExecution().optimizedPlan().toString()
            assert not [x for x in plan.splitlines() if "Aggregate" in x and "idx#" in x]
            assert not small or plan.index("RepartitionByExpression") > plan.index("Join")
            assert {(r.entity, r.idx): r.val for r in out.collect()} == {k: want.get(k) for k in seen}
            found = vocab.encode_with_tags_long(data, words, tags, 6)
            assert {tuple(r) for r in found.collect()} == {(*k, 1.0) for k in seen}
            assert found.count() == len(seen) and found.dtypes == [("entity", "bigint"), ("idx", "int"), ("val", "double")]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_union_of_families_keeps_order(spark):
    first = spark.createDataFrame([("e", "1:1"), ("f", "2:1")], "entity string, features string")
    second = spark.createDataFrame([("e", "9:1")], "entity string, features string")
    assert rows(features.union_families([second, first])) == [("e", "9:1 1:1"), ("f", "2:1")]


def test_libsvm_text(spark, tmp_path):
    lines = spark.createDataFrame([("1 3:2 1:1 1:1",), ("# note",), ("",), ("0 2:0.5",), ("1 2:1 2:3",), ("0 x:1",), ("0 0:1",)], "value string")
    parsed = libsvm.parse_labelled(lines)
    assert rows(parsed) == [(0.0, [1], [0.5]), (1.0, [0, 2], [1.0, 2.0])]
    assert libsvm.num_features(parsed).first()[0] == 3
    path = str(tmp_path / "vectors")
    libsvm.write(parsed.withColumn("label", F.col("label").cast("int")), path, "label", shift=1)
    strict = libsvm.read(spark, path, 3).collect()
    assert sorted((r.label, r.features.toArray().tolist()) for r in strict) == [(0.0, [0, .5, 0]), (1.0, [1, 0, 2])]
    keyed = libsvm.parse_labelled_keyed(spark.createDataFrame([("1 e\t1:1 2:1",), ("e\t1:1",), ("0 f",)], "value string"))
    assert rows(keyed) == [(0.0, "f", [], []), (1.0, "e", [0, 1], [1.0, 1.0])]


# Areas.

def test_areas_of_very_different_size(spark):
    text = ["900000\tworld\t-60.5,-170.5;-60.5,170.5;60.5,170.5;60.5,-170.5", "110101\ttiny\t10.001,20.001;10.001,20.004;10.004,20.004;10.004,20.001",
            "broken\tx\t1,2;a,b", "noring\tx"]
    areas = geo.load_areas(spark.createDataFrame([(x,) for x in text], "value string"))
    assert areas.count() == 2
    assert geo.cover_cells(areas).groupBy("code").count().agg(F.max("count")).first()[0] <= 4
    points = spark.createDataFrame([(1, 10.002, 20.003), (2, 0.3, 0.4), (3, 80.0, 0.0)], "pid int, lat double, lng double")
    got = {r.pid: r.code for r in geo.locate(points, areas).collect()}
    assert got == {1: "110101", 2: "900000", 3: "null"}
    names = spark.createDataFrame([("110101", "tiny"), ("110100", "city"), ("110000", "prov")], "code string, name string")
    up = {r.pid: (r.district, r.city, r.province) for r in geo.rollup(geo.locate(points, areas), names).collect()}
    assert up[1] == ("tiny", "city", "prov") and up[3] == ("null", "null", "null") and up[2] == (None, None, None)
    visits = points.withColumn("entity", F.lit("e"))
    assert rows(geo.areas_per_entity(visits, areas)) == [("e", "Not Found"), ("e", "tiny"), ("e", "world")]


@pytest.mark.parametrize("by_rows", [False, True])
@pytest.mark.parametrize("single", [False, True])
def test_copies_of_an_area(spark, monkeypatch, by_rows, single):
    """Copies count as boxes, the smallest code wins, and both ways of joining agree."""
    if by_rows:
        monkeypatch.setattr(geo, "CELL_BYTES", 3)
    triangle, square = "1.01,1.01;1.01,2.99;2.99,1.01", "5.01,5.01;5.01,6.99;6.99,6.99;6.99,5.01"
    other = "5.51,5.51;5.51,8.99;8.99,8.99"
    lines = [f"{code}\tx\t{ring}" for code, ring in (("30", triangle), ("20", square), ("10", square), ("15", square), ("40", other))]
    areas = geo.load_areas(spark.createDataFrame([(x,) for x in lines], "value string"))
    points = spark.createDataFrame([(1, 2.9, 2.9), (2, 1.5, 1.5), (3, 5.2, 5.3), (4, 8.8, 5.6), (5, 6.0, 6.5)], "pid int, lat double, lng double")
    located = geo.locate(points.union(points), areas, single).collect()
    got = {r.pid: r.code for r in located}
    assert len(located) == 10
    assert got == {1: "30" if single else "null", 2: "30", 3: "10", 4: "40" if single else "null", 5: "10"}


def _ring(rng, corners, lat, lng, size):
    """A ring around a centre; its corners lie at random distances, on a lattice of 1/1024 degree."""
    turn = np.sort(rng.uniform(0, 2 * np.pi, corners))
    far = size * rng.uniform(0.5, 1.0, corners)
    return [(round((lat + d * np.sin(t)) * 1024) / 1024, round((lng + d * np.cos(t)) * 1024) / 1024) for t, d in zip(turn, far, strict=True)]


def _lines(spark, rings):
    text = [f"{code}\tname {code}\t" + ";".join(f"{a!r},{g!r}" for a, g in ring) for code, ring in rings.items()]
    return spark.createDataFrame([(x,) for x in text], "value string")


@pytest.mark.parametrize("by_rows", [False, True])
@pytest.mark.parametrize("single", [False, True])
def test_quadtree_answers_as_whole_rings_do(spark, monkeypatch, by_rows, single):
    """Against a test of every ring: corners, points on cell borders and beyond, rings that cross themselves, small and large."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(geo, "CELL_EDGES", 4)
    if by_rows:
        monkeypatch.setattr(geo, "CELL_BYTES", 3)
    rings = {f"{100 + i}": _ring(rng, int(rng.integers(3, 120)), rng.uniform(-3, 3), rng.uniform(-3, 3), 2.0 ** rng.uniform(-4, 2)) for i in range(25)}
    rings["200"] = [rings["100"][i] for i in rng.permutation(len(rings["100"]))]
    rings["201"] = [(float("nan"), 1.0), (1.0, 2.0), (2.0, 1.0)]
    rings["202"] = [(1.0, 1.0)]
    spots = [p for ring in rings.values() for p in ring[:12]]
    spots += [(a / 4, g / 4) for a in range(-8, 9, 2) for g in range(-8, 9)] + [(float("nan"), 0.0), (float("inf"), 1.0), (None, 0.5)]
    spots += [tuple(p) for p in rng.uniform(-4, 4, (800, 2)).tolist()]
    areas = geo.load_areas(_lines(spark, rings))
    points = spark.createDataFrame([(i, a, g) for i, (a, g) in enumerate(spots)], "pid int, lat double, lng double")
    got = {r.pid: r.code for r in geo.locate(points, areas, single).collect()}
    tested = points.join(areas.filter("code <> '201'"), in_box("lat", "lng")).select("pid", "code", contains("ring", "lat", "lng").alias("inside"))
    boxes, inside = {}, {}
    for r in tested.collect():
        boxes.setdefault(r.pid, []).append(r.code)
        if r.inside:
            inside.setdefault(r.pid, []).append(r.code)
    for pid in range(len(spots)):
        one = boxes[pid][0] if single and len(boxes.get(pid, [])) == 1 else min(inside.get(pid, ["null"]))
        assert got[pid] == one, (pid, spots[pid])


def test_large_ring_is_tested_by_the_edges_of_one_cell(spark):
    """300,000 corners: no cell keeps more than its share of edges, most keep none, and no edge is repeated often."""
    corners = 300_000
    turn = np.linspace(0, 2 * np.pi, corners, endpoint=False)
    far = 30 + 3 * np.sin(40 * turn)
    lats, lngs = far * np.sin(turn), far * np.cos(turn)
    ring = [(float(a), float(g)) for a, g in zip(lats, lngs, strict=True)]
    areas = geo.load_areas(_lines(spark, {"7": ring}))
    most, total = geo.area_cover(areas).agg(F.max(F.size("edges")), F.sum(F.size("edges"))).first()
    assert most <= geo.CELL_EDGES and corners <= total <= geo.GROWTH * corners
    rng = np.random.default_rng(1)
    spots = rng.uniform(-35, 35, (2000, 2))
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(spots.tolist())], "pid int, lat double, lng double")
    angle = np.arctan2(spots[:, 0], spots[:, 1])
    gap = np.hypot(spots[:, 0], spots[:, 1]) - (30 + 3 * np.sin(40 * angle))
    got = {r.pid: r.code for r in geo.locate(points, areas).collect()}
    assert all(got[i] == ("7" if gap[i] < 0 else "null") for i in range(len(spots)) if abs(gap[i]) > 1e-3)


def test_confirmation_in_long_form(spark):
    latest = spark.createDataFrame([("e", "I3"), ("f", "I1")], "entity string, ident string")
    known = spark.createDataFrame([("e", "i3"), ("e", "i3"), ("f", "i9")], "entity string, ident string")
    assert rows(identity.confirm_pairs(latest, known)) == [("e", "I3")]


# Models.

def test_model_finds_a_planted_signal_and_survives_saving(spark, tmp_path):
    signal = (F.xxhash64("id") % 2).cast("int")
    df = spark.range(400).select(F.col("id").alias("entity"), F.abs(signal).alias("label"),
                                 F.array(F.abs(signal) + 1, (F.abs(F.xxhash64("id", F.lit(2))) % 5 + 3).cast("int")).alias("idxs"))
    df = df.withColumn("vals", F.array(F.lit(1.0), F.lit(1.0)))
    vectors = model.vectorize(df, 8, keep=("entity", "label"))
    fitted = model.train(vectors, rounds=3, depth=2)
    path = str(tmp_path / "model")
    model.save(fitted, path)
    scored = model.score(model.load(path), vectors, keep=("entity", "label"))
    assert auc(scored).first().auc > 0.9


# Files.

def test_sinks_and_paths(spark, tmp_path):
    root = str(tmp_path / "days")
    df = spark.range(30).select("id", F.date_add(F.lit("2017-02-01").cast("date"), (F.col("id") % 10).cast("int")).alias("day"))
    sinks.write_parquet(df, root, ("day",))
    window = readers.read_window(spark, root, "2017-02-04", 2)
    assert window.count() == 9
    assert "PartitionFilters: [isnotnull(day" in window._jdf.queryExecution().executedPlan().toString()
    assert readers.existing_paths(spark, [root, root + "/*", root + "-none"]) == [root, root + "/*"]
    sinks.write_tsv(df, str(tmp_path / "t"), 3)
    sinks.write_tsv(df, str(tmp_path / "t"), 2)
    assert readers.read_lines(spark, str(tmp_path / "t")).count() == 30


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    for name in ("bucketed_a", "bucketed_b"):
        sinks.write_bucketed(spark.range(100).select(F.col("id").alias("entity"), F.lit(name).alias(name)), name, buckets=4, path=str(tmp_path / name))
    joined = spark.table("bucketed_a").hint("merge").join(spark.table("bucketed_b"), "entity")
    assert joined.count() == 100
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE bucketed_a")
    spark.sql("DROP TABLE bucketed_b")


def test_intersection_of_very_many_families(spark):
    families = [spark.createDataFrame([(1,), (2,)] if i != 63 else [(1,)], "entity int") for i in range(65)]
    assert rows(trainset.intersect(families)) == [(1,)]


def test_sequence_file(spark, tmp_path):
    path = str(tmp_path / "frames")
    pairs = spark.sparkContext.parallelize([("k", bytearray(b'{"ts":%d}\x00body%d' % (i, i))) for i in range(4)])
    pairs.saveAsHadoopFile(path, "org.apache.hadoop.mapred.SequenceFileOutputFormat",
                           "org.apache.hadoop.io.Text", "org.apache.hadoop.io.BytesWritable")
    got = readers.split_framed(readers.read_framed(spark, path))
    assert sorted((r.ts, bytes(r.body)) for r in got.collect()) == [(i, b"body%d" % i) for i in range(4)]


def test_nested_parquet_reads_only_the_leaves(spark, tmp_path):
    path = str(tmp_path / "nested")
    spark.range(3).select("id", F.struct(F.col("id").alias("model"), F.lit("x").alias("brand")).alias("device")).write.parquet(path)
    df = readers.read_entities(spark, path, {"entity": "id", "model": "device.model"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "struct<model:bigint>" in plan and "brand" not in plan


def test_real_valued_vectors_survive(spark):
    df = spark.createDataFrame([("a", [1, 2, 4], [0.5, 2.7, -1.0]), ("b", [], [])], "entity string, idxs array<int>, vals array<double>")
    got = {r.entity: r.features for r in model.vectorize(df, 4).collect()}
    assert got["a"].toArray().tolist() == [0.5, 2.7, 0.0, -1.0] and got["b"].toArray().tolist() == [0.0] * 4
    assert model.dimension(df) == 4
    with pytest.raises(Exception, match="indices must be"):
        model.vectorize(df, 3).collect()


def test_model_learns_from_fractions(spark):
    rows = [(float(i % 2), [1], [0.25 if i % 2 else 0.75]) for i in range(60)]
    df = spark.createDataFrame(rows, "label double, idxs array<int>, vals array<double>")
    vectors = model.vectorize(df, 1, keep=("label",))
    scored = model.score(model.train(vectors, rounds=3, depth=2), vectors, keep=("label",)).collect()
    assert all((r.score > 0.5) == (r.label == 1.0) for r in scored)


def test_ordered_files_hold_ranges(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 97).alias("v"))
    for _ in range(2):
        sinks.write_tsv(df, str(tmp_path / "o"), files=4, order_by=[F.desc("v"), F.col("k")])
    files = sorted((tmp_path / "o").glob("part-*"))
    values = [int(line.split("\t")[1]) for f in files for line in f.read_text().splitlines()]
    assert len(files) == 4 and values == sorted(values, reverse=True) and len(values) == 1000


def test_wide_rows_are_not_broadcast(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1 << 20).alias("t"))
    assert "broadcast" not in session.broadcast_if_small(wide)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in session.broadcast_if_small(spark.range(100))._jdf.queryExecution().logical().toString().lower()


def test_dense_index_carries_over_partitions_of_tied_values(spark):
    """Nearly all rows share a value: they lie in many partitions of like size, and ranks go on across them."""
    rows = [(g, 5.0 if i % 100 else float(i), i) for i in range(8000) for g in ("a",)]
    rows += [("b", v, -i) for i, v in enumerate([None, float("nan"), 1.0, float("nan"), None, 1.0, -2.0])] + [(None, 1.0, 1), (None, 0.0, 2)]
    df = spark.createDataFrame(rows, "g string, v double, id long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = [r[0] for r in ranking._place(df.withColumn("t", F.monotonically_increasing_id()), ["g", F.col("v").asc_nulls_last(), "t"])
                 .groupBy("__partition").count().select("count").collect()]
        got = {(r.g, r.id): r.rank for r in ranking.dense_index(df, ["g"], "v").collect()}
        flat = {r.id: r.rank for r in ranking.dense_index(df.filter("g = 'a'"), [], "v", 0).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(sizes) > 8 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    order = sorted({v for g, v, _ in rows if g == "a"})
    assert all(got[g, i] == order.index(v) + 1 and flat[i] == order.index(v) for g, v, i in rows if g == "a")
    assert [got["b", -i] for i in range(7)] == [4, 3, 2, 3, 4, 2, 1] and (got[None, 2], got[None, 1]) == (1, 2)


def test_dense_index_of_nothing(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert ranking.dense_index(df, ["g"], "v").count() == 0 == ranking.dense_index(df, [], "v").count()


def test_first_ranked_is_the_head_of_the_ranking_without_a_full_sort(spark, capsys):
    rng = random.Random(4)
    scored = spark.createDataFrame([(f"f{i % 3}", f"i{i:04}", rng.choice((0.1, 0.2, 0.3, float("nan")))) for i in range(300)],
                                   "family string, item string, entropy double")
    for groups in ([], ["family"]):
        ranked = selection.rank(scored, "row", groups).filter("rank <= 20").select(*groups, "item", "rank").collect()
        first = selection.first_ranked(scored, 20, groups)
        assert sorted(map(tuple, first.collect())) == sorted(map(tuple, ranked))
        first.explain()
        plan = capsys.readouterr().out
        assert "rangepartitioning" not in plan and ("WindowGroupLimit" in plan if groups else "TakeOrderedAndProject" in plan)


def test_out_of_fold_scores_find_a_planted_rule(spark):
    """Every entity is scored once, by a model that has not seen it; a plain rule is found in every fold."""
    rows = [(f"e{i}", i % 2, Vectors.dense([float(i % 2), float(i % 7), float(i % 3)])) for i in range(240)]
    df = spark.createDataFrame(rows, ["entity", "label", "features"])
    scored = model.cross_validate(df, 3, rounds=2, depth=2).cache()
    assert sorted(r.entity for r in scored.collect()) == sorted(r[0] for r in rows)
    assert {r.fold: r.auc for r in model.fold_auc(scored, 3).collect()} == {0: 1.0, 1: 1.0, 2: 1.0}
    noise = df.withColumn("label", (F.xxhash64("entity") % 2 == 0).cast("int"))
    for r in model.fold_auc(model.cross_validate(noise, 3, rounds=8, depth=5), 3).collect():
        assert 0.2 < r.auc < 0.8


def test_bundle_needs_a_word_for_each_place(spark):
    rows = [(i % 2, Vectors.sparse(2, {i % 2: 1.0})) for i in range(20)]
    fitted = model.train(spark.createDataFrame(rows, ["label", "features"]), rounds=1, depth=1)
    whole = model.bundle(["a", "b"], fitted)
    out = model.score(whole, spark.createDataFrame([(1, ["b", "b", "x"]), (2, ["a"]), (3, [])], "entity int, items array<string>"))
    found = {r.entity: r.score for r in out.collect()}
    assert found[1] > 0.5 > found[2] and set(found) == {1, 2, 3}
    with pytest.raises(ValueError):
        model.bundle(["a"], fitted)


def test_days_are_rewritten_alone_and_windows_read_their_folders(spark, tmp_path, capsys):
    path = str(tmp_path / "days")
    rows = spark.createDataFrame([(i, f"2024-01-0{1 + i % 5}") for i in range(50)], "id int, day string").withColumn("day", F.to_date("day"))
    sinks.overwrite_days(rows, path)
    folder = tmp_path / "days"
    before = {p: p.stat().st_mtime_ns for p in folder.glob("day=*/*.parquet")}
    sinks.overwrite_days(rows.filter("day = DATE '2024-01-02'").withColumn("id", F.col("id") + 100), path)
    after = {p: p.stat().st_mtime_ns for p in folder.glob("day=*/*.parquet")}
    assert {p.parent.name for p, _ in set(before.items()) ^ set(after.items())} == {"day=2024-01-02"}
    window = readers.read_window(spark, path, "2024-01-03", 1)
    assert sorted(r.id for r in window.collect()) == sorted([i + 100 for i in range(50) if i % 5 == 1] + [i for i in range(50) if i % 5 == 2])
    window.explain()
    assert "PartitionFilters: [isnotnull(day" in capsys.readouterr().out


def test_bucketed_sides_join_without_an_exchange(spark, tmp_path, capsys):
    for name in ("left_side", "right_side"):
        rows = spark.range(500).select((F.col("id") % 90).alias("entity"), F.col("id").alias(name))
        sinks.write_bucketed(rows, f"{name}_b", buckets=4, path=str(tmp_path / name))
    try:
        joined = spark.table("left_side_b").hint("merge").join(spark.table("right_side_b"), "entity").groupBy("entity").agg(F.count("*").alias("n"))
        assert joined.agg(F.sum("n")).first()[0] == sum(len(range(e, 500, 90)) ** 2 for e in range(90))
        joined.explain()
        plan = capsys.readouterr().out
        assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    finally:
        for name in ("left_side", "right_side"):
            spark.sql(f"DROP TABLE IF EXISTS {name}_b")


# Dictionaries too large to broadcast.

def test_filter_of_used_keys_works_before_the_exchange(spark, monkeypatch):
    """Exact whatever the size of the filter; the filter leaves out nearly all keys that are not used."""
    dictionary = spark.range(50_000).select((F.col("id") % 40_000).cast("string").alias("k"), "id").union(spark.sql("SELECT NULL, -1L"))
    used = spark.range(3000).select((F.col("id") * 30).cast("string").alias("k")).union(spark.sql("SELECT NULL")).unionAll(spark.sql("SELECT '0'"))
    want = rows(vocab.prune(dictionary, used, "k"))
    pruned = vocab.prune_large(dictionary, used, "k")
    assert rows(pruned) == want
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" in text and "bitmap_construct_agg" in text
    filled = vocab.key_filter(used, "k", 2)
    kept = vocab.may_be_in(dictionary, "k", filled, 2).count()
    assert len(want) <= kept < len(want) + 3000
    monkeypatch.setattr(vocab, "FILTER_BLOCKS", 1)
    monkeypatch.setattr(vocab, "FILTER_BITS", 100)
    assert rows(vocab.prune_large(dictionary, used, "k")) == want
    assert vocab.prune_large(dictionary, used.filter("false"), "k").count() == 0
    assert vocab.prune_large(dictionary.filter("false"), used, "k").count() == 0
    with pytest.raises(ValueError):
        vocab.prune_large(dictionary, spark.range(3).withColumnRenamed("id", "k"), "k")


def test_framed_records_through_sequence_files(spark, tmp_path):
    df = spark.createDataFrame([("a", b'{"ts":5}\x00\xff\x00z'), ("b", b"no zero"), ("c", b'{"ts":"x"}\x00'), (None, b"x"), ("d", None)], "key string, value binary")
    sinks.write_framed(df, str(tmp_path / "frames"))
    got = rows(readers.split_framed(readers.read_framed(spark, str(tmp_path / "frames"))))
    assert [(k, h, t, bytes(v)) for k, h, t, v in got] == [("a", '{"ts":5}', 5, b"\xff\x00z"), ("c", '{"ts":"x"}', None, b"")]

"""Jobs from files to files."""

import json
import random

from pyspark.sql import functions as F

from tagmill.plans import jobs


def put(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def get(spark, path):
    return sorted(r.value for r in spark.read.text(str(path)).select("value").collect())


def test_features_to_audience(spark, tmp_path):
    """Selection, encoding, training, scoring and tagging, the way the parts are chained."""
    rng = random.Random(3)
    users = [f"u{i}" for i in range(120)]
    label = {u: i % 2 for i, u in enumerate(users)}
    data = []
    for u in users:
        apps = [f'"a{rng.randrange(6)}"' for _ in range(3)] + (['"signal"'] if label[u] else [])
        data.append((u, [(a, "m%d" % rng.randrange(3)) for a in apps]))
    source = str(tmp_path / "source")
    spark.createDataFrame(data, "entity string, slots array<struct<app: string, model: string>>").write.parquet(source)
    label_path = put(tmp_path / "labels.csv", [f"{u},{label[u]}" for u in users[:100]] + ["broken"])

    triples = str(tmp_path / "triples")
    jobs.feature_filter(spark, source, label_path, triples, {"app": "slots.app", "model": "slots.model"})
    ranks = str(tmp_path / "ranks")
    jobs.feature_update(spark, {f: f"{triples}/family={f}" for f in ("app", "model")}, ranks)
    best = get(spark, f"{ranks}/rank/family=app")
    assert "signal,1" in best and len(best) == 7
    jobs.feature_update(spark, {"app": f"{triples}/family=app"}, str(tmp_path / "dense"), dense=True)

    encoded = str(tmp_path / "encoded")
    jobs.encode_items(spark, source, "slots.app", f"{ranks}/rank/family=app", 7, encoded)
    assert len(get(spark, encoded)) == 120
    train = str(tmp_path / "train")
    jobs.trainset_prep(spark, {"app": encoded}, label_path, train)
    assert len(get(spark, f"{train}/family=app")) == 100
    jobs.trainset_balance(spark, encoded, label_path, str(tmp_path / "balanced"))
    assert len(get(spark, tmp_path / "balanced")) == 100
    jobs.trainset_intersection(spark, {"a": encoded, "b": encoded}, label_path, str(tmp_path / "common"))
    assert len(get(spark, f"{tmp_path}/common/family=b")) == 100

    models = str(tmp_path / "models")
    jobs.train(spark, {"app": f"{train}/family=app"}, models, 7, rounds=2)
    scores = str(tmp_path / "scores")
    jobs.predict(spark, encoded, f"{models}/app", scores, 7)
    values = dict(line.split("\t") for line in get(spark, scores))
    assert min(float(values[u]) for u in users if label[u]) > max(float(values[u]) for u in users if not label[u])

    audience = str(tmp_path / "audience")
    jobs.tag_audience(spark, [scores, str(tmp_path / "not-there")], audience)
    assert len(get(spark, f"{audience}/pos")) + len(get(spark, f"{audience}/neg")) <= 120
    jobs.stack_train(spark, [scores], label_path, str(tmp_path / "stack"), rounds=2)
    jobs.stack_predict(spark, f"{tmp_path}/stack/scores", f"{tmp_path}/stack/model", str(tmp_path / "stacked"))
    assert len(get(spark, f"{tmp_path}/stacked/pos")) == 60


def test_activity_jobs(spark, tmp_path):
    day = tmp_path / "2017-07-03"
    records = [{"entity": f"U-{i % 3}", "app": '"a"', "time": i, "activities": [
        {"name": f"n{i % 4}", "start": i, "duration": 1, "refer": None if i % 2 else "r"}]} for i in range(90)]
    put(day, [json.dumps(r) for r in records])
    label_path = put(tmp_path / "labels", ["U-0,1", "U-1,0"])
    jobs.activity_filter(spark, str(day), label_path, str(tmp_path / "kept"))
    kept = spark.read.json(str(tmp_path / "kept"))
    assert sorted((r.entity, r["count"]) for r in kept.groupBy("entity").count().collect()) == [("u0", 20), ("u1", 20)]
    weights = put(tmp_path / "weights", ["a\t0.7"])
    jobs.monthly_activity_hash(spark, str(tmp_path), "2017-07", weights, str(tmp_path / "prints"), 1)
    lines = get(spark, tmp_path / "prints")
    assert [line.split(" ")[0] for line in lines] == ["u0", "u1", "u2"]
    assert all(1 <= int(p.split(":")[0]) <= 256 for line in lines for p in line.split(" ")[1:])
    put(tmp_path / "events", ['{"entity":"e","app":"a","events":[{"id":"x"},{"id":"x"},{"id":"y"}]}', "no json"])
    jobs.event_extract(spark, str(tmp_path / "events"), str(tmp_path / "ids"))
    assert get(spark, tmp_path / "ids") == ["e\ta\tx,y"]


def test_bag_and_place_jobs(spark, tmp_path):
    put(tmp_path / "places", ['{"entity":"E-1","aoiName":"mall","aoiLabel":null,"pkg":"p"}',
                              '{"entity":"e1","aoiName":"mall","aoiLabel":"shop","pkg":"p"}', '{"entity":"e1","aoiName":"null"}'])
    jobs.place_bags(spark, str(tmp_path / "places"), str(tmp_path / "bags"))
    assert get(spark, tmp_path / "bags") == ["e1\tmall:2"]
    jobs.place_bags(spark, str(tmp_path / "places"), str(tmp_path / "bags2"), "aoiLabel", "aoiName")
    assert get(spark, tmp_path / "bags2") == ["e1\tnull|mall:1,shop|mall:1"]
    put(tmp_path / "more", ["e1\tmall:5,bad", "e2\tx:1", "alone"])
    jobs.merge_bags(spark, f"{tmp_path}/bags,{tmp_path}/more", str(tmp_path / "merged"))
    assert get(spark, tmp_path / "merged") == ["e1\tmall:7", "e2\tx:1"]
    put(tmp_path / "items", ["e1\tb", "e1\ta", "e2\tb", "e2\tb"])
    jobs.merge_models(spark, str(tmp_path / "items"), str(tmp_path / "onehot"))
    assert get(spark, f"{tmp_path}/onehot/schema") == ["a\t1", "b\t2"]
    assert get(spark, f"{tmp_path}/onehot/data") == ["e1 1:1 2:1", "e2 2:1"]
    put(tmp_path / "tags", ["a\tbig red", "b\tred"])
    jobs.device_tags(spark, str(tmp_path / "items"), str(tmp_path / "tags"), str(tmp_path / "tagged"))
    assert get(spark, f"{tmp_path}/tagged/data") == ["e1 0:1 1:1", "e2 1:1"]
    put(tmp_path / "wifi", ["e1\tx\t1\t2\t[w1,w2]\ty\t[]", "e1\tx\t1\t2\t[]\ty\t[w9]", "e3\tx\t1\t2\t[]\ty\t[]"])
    put(tmp_path / "stores", ['{"wid":"w1","name":"cafe"}', '{"wid":"w2","name":"cafe"}'])
    jobs.place_names(spark, str(tmp_path / "wifi"), str(tmp_path / "stores"), str(tmp_path / "names"))
    assert get(spark, tmp_path / "names") == ["e1\tUnknown", "e1\tcafe"]
    put(tmp_path / "areas", ["110101\tcity\t1.5,0.5;1.5,1.5;2.5,1.5;2.5,0.5"])
    jobs.visited_cities(spark, str(tmp_path / "wifi"), str(tmp_path / "areas"), str(tmp_path / "cities"))
    assert get(spark, tmp_path / "cities") == ["e1\tcity"]


def test_lines_to_vectors_and_labels(spark, tmp_path):
    put(tmp_path / "rows", ["1\tb:2,a:1", "0\ta:3", "1\tb:2,a:1", "junk"])
    jobs.libsvm_build(spark, str(tmp_path / "rows"), str(tmp_path / "svm"))
    assert get(spark, f"{tmp_path}/svm/data") == ["0 1:3", "1 1:1 2:2", "1 1:1 2:2"]
    put(tmp_path / "old", ["a,1", "b,0"])
    put(tmp_path / "new", ["b,0", "c,1"])
    jobs.sample_update(spark, str(tmp_path / "old"), str(tmp_path / "new"), str(tmp_path / "u1"))
    jobs.sample_update(spark, str(tmp_path / "old"), str(tmp_path / "none"), str(tmp_path / "u2"))
    assert get(spark, tmp_path / "u1") == ["a,1", "b,0", "c,1"] and get(spark, tmp_path / "u2") == ["a,1", "b,0"]
    jobs.translate_districts(spark, [put(tmp_path / "d", ["e\t海淀区\t30", "f\t其他", "g"])], str(tmp_path / "dt"))
    assert get(spark, tmp_path / "dt") == ["e\tHaiDian\t30", "f\tBug\tAge missing", "g\tBug\tAge missing"]


def test_cohorts(spark):
    def month(*people):
        return spark.createDataFrame(list(people), "entity string, apps array<string>, carriers array<string>, idents array<string>")

    many = [str(i) for i in range(100)]
    out = jobs.carrier_cohort([month(("a", ["x"], ["46001", "46002"], ["i"]), ("b", ["x"], ["46002"], ["i"])),
                               month(("a", ["y"], ["46006"], ["j"]), ("c", ["x"], ["46001"], many))])
    assert sorted(map(tuple, out.filter(F.col("kind") == "idents").select("entity", "item").collect())) == [("a", "i"), ("a", "j")]

    def period(*people):
        return spark.createDataFrame(list(people), "entity string, district string")

    found = jobs.stable_district([period(("a", "N"), ("b", "N")), period(("a", "S"), ("b", "S")), period(("a", "S"))])
    assert [tuple(r) for r in found.collect()] == [("a", "S", 2)]
    known = spark.createDataFrame([("E-1", "IM2", ["20170101", "20170301"]), ("E-1", "IM1", ["20170201"]), ("e2", "IM9", ["20170101"])],
                                  "entity string, id string, dateArray array<string>")
    devices = spark.createDataFrame([("e1", ["im2", "im7"], ["46001x"]), ("e2", ["im1"], [])], "entity string, imei array<string>, imsi array<string>")
    qualified = jobs.qualified_entities(
        spark.createDataFrame([("e1", ["a", "b", "c"]), ("e2", ["a", "b", "c"]), ("e3", ["a"])], "entity string, apps array<string>"),
        spark.createDataFrame([("e1", "N"), ("e2", "S"), ("e3", "S")], "entity string, district string"))
    assert [tuple(r) for r in jobs.confirmed_identifiers(known, devices, qualified).collect()] == [("e1", "N", "im2", "46001x")]


def test_cluster_points(spark, tmp_path):
    put(tmp_path / "points", ["0.0\t0.0", "0.1\t0.0", "0.0\t0.1", "9.0\t9.0", "x\t1"])
    jobs.cluster_points(spark, str(tmp_path / "points"), 2, str(tmp_path / "clusters"), 0.5, 3)
    assert sorted(r.cluster for r in spark.read.parquet(str(tmp_path / "clusters")).collect()) == [0, 1, 1, 1]


def test_nested_activity_records(spark, tmp_path):
    """One record per labelled entity; repeated activities once, quotes gone, twenty records at most."""
    def activity(name, start):
        return {"name": name, "start": start, "duration": 1, "refer": '"r"'}

    rows = [{"entity": "U-1", "app": '"a"', "time": i, "activities": [activity('"x"', 1), activity("y", 0), activity('"x"', 1)]} for i in range(30)]
    rows += [{"entity": "U-2", "app": "b", "time": None, "activities": None}, {"entity": "U-3", "app": "c", "time": 1, "activities": []}]
    put(tmp_path / "day", [json.dumps(r) for r in rows])
    label_path = put(tmp_path / "labels", ["U-1,1", "U-2,0"])
    jobs.activity_nested(spark, str(tmp_path / "day"), label_path, str(tmp_path / "out"))
    got = {r["entity"]: r for r in map(json.loads, get(spark, tmp_path / "out"))}
    assert set(got) == {"u1", "u2"} and got["u1"]["label"] == 1
    assert [r["time"] for r in got["u1"]["records"]] == list(range(20))
    assert got["u1"]["records"][0]["activities"] == [{"name": "x", "start": 1, "duration": 1, "refer": "r"},
                                                     {"name": "y", "start": 0, "duration": 1, "refer": "r"}]
    assert got["u2"]["records"] == [{"app": "b", "activities": []}]


def test_audience_files_carry_tag_ids_and_the_stack_its_labelled_set(spark, tmp_path):
    one = put(tmp_path / "one", ["a\t0.9", "b\t0.2", "c\t0.5"])
    two = put(tmp_path / "two", ["a\t0.7", "d\t0.1"])
    jobs.tag_audience(spark, [one, two], str(tmp_path / "tags"))
    assert get(spark, tmp_path / "tags/pos") == ["a\t304\t90.0"]
    assert sorted(get(spark, tmp_path / "tags/neg")) == ["b\t305\t80.0", "d\t305\t90.0"]
    jobs.stack_train(spark, [one, two], put(tmp_path / "known", ["a,1", "b,0", "e,1"]), str(tmp_path / "stack"), rounds=1)
    assert sorted(get(spark, tmp_path / "stack/labelled")) == ["0\tb\t0.2\t0.2\t1", "1\ta\t0.9\t0.7\t0"]

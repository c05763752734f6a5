"""The batch jobs: read files, apply operators, write files.

Each function is one job. Inputs are paths (comma-joined lists and globs where
text is read); outputs are folders that are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.functions import constants as c
from tagmill.functions import normalize as n
from tagmill.functions.arrays import unnest
from tagmill.operators import (bags, campaign, cluster, cohort, ensemble, features, geo, identity, items, labels, model,
                               places, selection, sessions, simhash, trainset, vocab)
from tagmill.session import checkpoint
from tagmill.sources import libsvm, readers, sinks

ACTIVITY_SCHEMA = ("entity string, app string, time bigint, "
                   "activities array<struct<name: string, start: bigint, duration: int, refer: string>>")
EVENT_SCHEMA = "entity string, app string, events array<struct<id: string>>"
PLACE_SCHEMA = "entity string, aoiName string, aoiLabel string, pkg string"


# Shared readers of the interface files.

def read_labels(spark: SparkSession, path: str, sep: str = ",", entity: int = 0, label: int = 1) -> DataFrame:
    """``entity, label`` with one row per entity; unreadable lines are dropped."""
    rows = readers.read_delimited(spark, path, {"entity": (entity, "string"), "label": (label, "int")}, sep)
    return labels.dedupe(rows)


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    return readers.read_delimited(spark, path, {"entity": (0, "string"), "item": (1, "string"), "label": (2, "int")})


def read_vocabulary(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """Items of rank up to ``dim`` from ``item,rank`` lines."""
    ranked = readers.read_delimited(spark, path, {"item": (0, "string"), "rank": (1, "int")}, ",")
    return vocab.top(ranked, dim)


def read_scores(spark: SparkSession, paths: Sequence[str], labelled: bool = False) -> DataFrame:
    """Scores of several models; inputs that do not exist are skipped."""
    fields = ({"entity": (0, "string"), "label": (1, "int"), "score": (2, "double")} if labelled
              else {"entity": (0, "string"), "score": (1, "double")})
    return readers.read_delimited(spark, readers.existing_paths(spark, paths), fields)


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """``item, tags array<int>``: the last tab field holds blank-separated numbers."""
    lines = readers.read_lines(spark, path)
    numbers = F.transform(F.split(F.substring_index("value", "\t", -1), " "), lambda t: t.try_cast("int"))
    return lines.select(n.part("value", 0).alias("item"), F.array_compact(numbers).alias("tags")).dropDuplicates(["item"])


def _write_vectors(encoded: DataFrame, path: str) -> None:
    libsvm.write(encoded, path, "entity")


# Extraction.

def activity_extract(packages: DataFrame, output: str, files: int = 48) -> None:
    """Flatten decoded session packages ``entity, app, time, messages`` to activity records (JSON lines)."""
    records = sessions.to_records(packages.withColumn("entity", n.entity_id("entity")))
    records.repartition(files).write.mode("overwrite").json(output)


def activity_filter(spark: SparkSession, path: str, label_path: str, output: str) -> None:
    """Labelled activity records, at most twenty per entity."""
    records = readers.read_json(spark, path, ACTIVITY_SCHEMA).withColumn("app", n.strip_quotes("app"))
    kept = sessions.cap_records(labels.attach(records, read_labels(spark, label_path), unique=True), ["time", "app"])
    kept.withColumn("entity", n.entity_id("entity")).write.mode("overwrite").json(output)


def activity_nested(spark: SparkSession, path: str, label_path: str, output: str) -> None:
    """One JSON record per labelled entity that nests its first twenty activity records."""
    records = readers.read_json(spark, path, ACTIVITY_SCHEMA).withColumn("entity", n.entity_id("entity"))
    known = read_labels(spark, label_path).withColumn("entity", n.entity_id("entity"))
    nested = sessions.nest(labels.attach(records, known, unique=True), keys=("entity", "label"))
    nested.write.mode("overwrite").json(output)


def activity_hash(spark: SparkSession, paths: Sequence[str], weight_path: str, output: str, bits: int = 128,
                  start: int = 0, label_path: str | None = None) -> None:
    """Activity fingerprints as ``entity idx:1 ...``; missing day folders are skipped."""
    records = readers.read_json(spark, readers.existing_paths(spark, paths), ACTIVITY_SCHEMA)
    if label_path is not None:
        records = cohort.restrict(records, read_labels(spark, label_path))
    records = records.withColumns({"entity": n.entity_id("entity"), "app": n.strip_quotes("app")})
    weights = readers.read_delimited(spark, weight_path, {"app": (0, "string"), "weight": (1, "double")})
    found = simhash.activity(records, weights.dropDuplicates(["app"]), bits, start, ["time", "app"])
    ones = F.transform("idxs", lambda i: F.lit(1.0))
    _write_vectors(found.withColumn("vals", ones), output)


def monthly_activity_hash(spark: SparkSession, root: str, month: str, weight_path: str, output: str, start: int) -> None:
    """256-bit fingerprints over the day folders of one calendar month."""
    activity_hash(spark, [f"{root}/{d.isoformat()}" for d in readers.month_days(month)], weight_path, output, 256, start)


def place_bags(spark: SparkSession, path: str, output: str, item: str = "aoiName", second: str | None = None) -> None:
    """Counted place bags per entity; with ``second`` the item is ``item|second``."""
    rows = readers.read_json(spark, path, PLACE_SCHEMA).filter(n.not_nullish(second or item))
    chosen = items.composite(item, second) if second else F.col(item)
    counted = bags.count_items(rows.select(n.entity_id("entity").alias("entity"), chosen.alias("item")))
    sinks.write_tsv(bags.to_text(counted), output)


def place_hours(spark: SparkSession, path: str, label_path: str, output: str) -> None:
    """Distinct ``hour:place`` items of labelled entities."""
    rows = readers.read_entities(spark, path, {"entity": "entity", "place": "aoiName", "time": "time"})
    rows = rows.filter(n.not_nullish("place"))
    sets = bags.distinct_items(rows.select(n.entity_id("entity").alias("entity"), items.hour_item("time", "place").alias("item")))
    known = read_labels(spark, label_path).withColumn("entity", n.entity_id("entity"))
    wide = bags.to_sets(sets)
    out = labels.attach(wide, known)
    sinks.write_tsv(out.select("entity", "label", F.array_join("items", ",").alias("items")), output)


def merge_bags(spark: SparkSession, paths: str, output: str) -> None:
    lines = n.safe_split(readers.read_lines(spark, paths), "value", {"entity": (0, "string"), "bag": (1, "string")})
    sinks.write_tsv(bags.to_text(bags.merge(bags.parse(lines))), output)


def merge_models(spark: SparkSession, paths: str, output: str, start: int = 1, names: str | None = None) -> None:
    """One-hot vectors over a vocabulary learned from ``entity<TAB>item`` lines; the vocabulary is written beside them."""
    rows = readers.read_delimited(spark, paths, {"entity": (0, "string"), "item": (1, "string")})
    rows = rows.withColumn("entity", n.entity_id("entity"))
    if names is not None:
        dictionary = readers.read_delimited(spark, names, {"item": (0, "string"), "name": (1, "string")})
        rows = vocab.lookup(rows, dictionary.dropDuplicates(["item"]), "item", "name", "not found").select(
            "entity", F.col("name").alias("item"))
    vocabulary = vocab.build(rows, start)
    vocab.write(vocabulary, output)
    _write_vectors(vocab.encode(rows, vocabulary), f"{output}/data")


def run_list_bags(spark: SparkSession, path: str, ids: str, output: str) -> None:
    """Counted run-list bags of chosen entities."""
    rows = readers.read_entities(spark, path, {"entity": "entity", "run": "appList.run"})
    chosen = readers.read_delimited(spark, ids, {"entity": (0, "string")})
    counted = bags.count_items(cohort.restrict(rows, chosen), F.col("run").cast("array<string>"))
    sinks.write_tsv(bags.to_text(counted), output)


def device_extract(spark: SparkSession, root: str, end: str | date, days_back: int, output: str) -> None:
    """Distinct device descriptions over a date window of a day-partitioned table."""
    window = readers.read_window(spark, root, end, days_back)
    devices = window.select("entity", "device.model", "device.standardModel", "device.brand", "device.pixel").distinct()
    sinks.write_parquet(devices, output)


def device_tags(spark: SparkSession, path: str, tag_path: str, output: str, start: int = 0) -> None:
    """Tag vectors of ``entity<TAB>item`` lines; tags are numbered and the numbering is written beside them."""
    rows = readers.read_delimited(spark, path, {"entity": (0, "string"), "item": (1, "string")})
    lines = n.safe_split(readers.read_lines(spark, tag_path), "value", {"item": (0, "string"), "list": (1, "string")})
    tags = unnest(lines, F.split("list", " "), "item", name="tag").distinct()
    schema, indexed = vocab.index_tags(tags, start)
    vocab.write(schema, output)
    lists = indexed.groupBy("item").agg(F.sort_array(F.collect_set("idx")).alias("tags"))
    expanded = vocab.expand_tags(rows.select(n.entity_id("entity").alias("entity"), "item").distinct(), lists)
    _write_vectors(vocab.to_vectors(expanded.distinct().withColumn("val", F.lit(1.0))), f"{output}/data")


def event_extract(spark: SparkSession, path: str, output: str, label_path: str | None = None) -> None:
    """Distinct event ids per record, optionally of labelled entities with their label."""
    ids = sessions.event_ids(readers.read_json(spark, path, EVENT_SCHEMA))
    if label_path is not None:
        ids = labels.attach(ids, read_labels(spark, label_path), unique=True)
    sinks.write_tsv(ids, output)


def geo_extract(df: DataFrame, ids: DataFrame, end: str | date, days_back: int, output: str, day: str = "day") -> None:
    """Rows of chosen entities in a date window, one JSON folder per day."""
    days = readers.date_window(end, days_back)
    sinks.write_json_by_day(cohort.restrict(df.filter(readers.between_days(day, days[0], days[-1])), ids), output, day)


def id_filter(spark: SparkSession, path: str, ids: str, output: str) -> None:
    """Lines whose first field is a chosen entity."""
    lines = readers.read_lines(spark, path).select(n.part("value", 0).alias("entity"), "value")
    chosen = readers.read_delimited(spark, ids, {"entity": (0, "string")}, ",")
    cohort.restrict(lines, chosen).select("value").write.mode("overwrite").text(output)


def feature_filter(spark: SparkSession, path: str, label_path: str, output: str, families: Mapping[str, str]) -> None:
    """Labelled triples of several nested columns in one pass, one folder per family."""
    columns = dict(families)
    df = readers.read_entities(spark, path, {"entity": "entity", **{f"f_{k}": v for k, v in columns.items()}})
    triples = selection.triples(df, read_labels(spark, label_path),
                                {k: F.col(f"f_{k}").cast("array<string>") for k in columns})
    line = F.concat_ws("\t", "entity", "item", "label").alias("value")
    triples.select("family", line).write.mode("overwrite").partitionBy("family").text(output)


def slot_frequencies(df: DataFrame, ids: DataFrame, output: str) -> None:
    """Active slots per entity and item from ``entity, slots array<struct<item, mask binary>>``."""
    rows = cohort.restrict(df, ids)
    one = unnest(rows, "slots", "entity", name="s").select("entity", "s.item", bags.active_slots("s.mask").alias("slots"))
    sinks.write_tsv(bags.to_text(bags.sum_slots(one)), output)


# Selection and encoding.

def feature_update(spark: SparkSession, paths: Mapping[str, str], output: str, dense: bool = False) -> None:
    """Entropy and rank of every item, all families in one job."""
    triples = readers.union_all([read_triples(spark, path).withColumn("family", F.lit(name)) for name, path in paths.items()])
    scored = selection.entropy(triples, groups=["family"])
    entropy_line = F.concat_ws("\t", "item", F.col("entropy").cast("string"), F.concat(F.lit("("), "pos", F.lit(","), "n", F.lit(")")))
    scored.select("family", entropy_line.alias("value")).write.mode("overwrite").partitionBy("family").text(f"{output}/entropy")
    ranked = selection.rank(scored, "dense" if dense else "row", ["family"])
    line = F.concat_ws(",", "item", "rank").alias("value")
    (ranked.orderBy("family", "rank", "item").select("family", line)
     .write.mode("overwrite").partitionBy("family").text(f"{output}/rank"))


def item_scores(spark: SparkSession, path: str, output: str) -> None:
    """Residual, entropy and purity per item."""
    scored = selection.chi_entropy_gini(read_triples(spark, path))
    sinks.write_tsv(scored.select("item", F.concat_ws(",", "chi", "ent", "gini").alias("scores")), output)


def encode_items(spark: SparkSession, path: str, source: str, vocabulary: str, dim: int, output: str,
                 mode: str = "binary", tags: str | None = None) -> None:
    """Sparse vectors of a nested item column against a ranked vocabulary, optionally with tags."""
    df = readers.read_entities(spark, path, {"entity": "entity", "items": source})
    rows = unnest(df, F.transform(F.col("items").cast("array<string>"), n.strip_quotes), "entity")
    known = read_vocabulary(spark, vocabulary, dim)
    if tags is None:
        encoded = vocab.encode(rows, known, mode)
    else:
        encoded = vocab.encode_with_tags(rows, known, read_tags(spark, tags), dim, mode)
    _write_vectors(encoded, output)


def feature_union(spark: SparkSession, paths: Sequence[str], output: str) -> None:
    fields = {"entity": (0, "string"), "features": (1, "string")}
    sinks.write_tsv(features.union_families([readers.read_delimited(spark, p, fields) for p in paths]), output)


def libsvm_build(spark: SparkSession, path: str, output: str, start: int = 1, weighted: bool = True) -> None:
    """``label idx:val ...`` lines with a vocabulary learned from ``label<TAB>f:w,f:w`` lines."""
    lines = n.safe_split(readers.read_lines(spark, path), "value", {"label": (0, "string"), "bag": (1, "string")})
    # A line has no key of its own; equal lines stay apart by their place in the input.
    rows = checkpoint(lines.withColumn("id", F.monotonically_increasing_id()))
    vocabulary, entries = libsvm.build(rows, start, weighted)
    vocab.write(vocabulary, output)
    keyed = entries.groupBy(F.struct("id", "label").alias("entity"), "idx").agg(F.sum("val").alias("val"))
    vectors = vocab.to_vectors(keyed).withColumn("label", F.col("entity.label"))
    libsvm.write(vectors, f"{output}/data", "label")


# Training sets.

def _features(spark: SparkSession, path: str) -> DataFrame:
    """``entity, features`` from ``entity idx:val ...`` lines, all features kept."""
    lines = readers.read_lines(spark, path)
    at = F.locate(" ", F.col("value"))
    kept = lines.filter(at > 0)
    return kept.select(F.substring_index("value", " ", 1).alias("entity"),
                       F.substring(F.col("value"), at + 1, F.length("value")).alias("features"))


def trainset_prep(spark: SparkSession, paths: Mapping[str, str], label_path: str, output: str) -> None:
    """``label features`` lines, one folder per family."""
    known = read_labels(spark, label_path)
    rows = readers.union_all([_features(spark, p).withColumn("family", F.lit(k)) for k, p in paths.items()])
    out = trainset.prepare(rows, known, unique=True)
    out.select("family", F.concat_ws(" ", "label", "features").alias("value")).write.mode("overwrite") \
        .partitionBy("family").text(output)


def trainset_balance(spark: SparkSession, path: str, label_path: str, output: str, ratio: float = 1.0) -> None:
    rows = trainset.prepare(_features(spark, path), read_labels(spark, label_path), unique=True)
    sinks.write_tsv(trainset.balance(rows, ratio).select("label", "features"), output, sep=" ")


def trainset_holdouts(spark: SparkSession, path: str, label_path: str, output: str, ratio: float = 0.8) -> None:
    """Five random holdouts: ``label entity<TAB>features`` under ``seed=/is_train=``."""
    rows = trainset.prepare(_features(spark, path), read_labels(spark, label_path, "\t"), unique=True)
    line = F.concat_ws("\t", F.concat_ws(" ", "label", "entity"), "features").alias("value")
    (trainset.repeated_holdout(rows, ratio).select("seed", "is_train", line)
     .write.mode("overwrite").partitionBy("seed", "is_train").text(output))


def trainset_intersection(spark: SparkSession, paths: Mapping[str, str], label_path: str, output: str) -> None:
    """``entity label features`` of the entities common to all families, one folder per family."""
    rows = trainset.common_training_sets({k: _features(spark, p) for k, p in paths.items()}, read_labels(spark, label_path))
    rows.select("family", F.concat_ws(" ", "entity", "label", "features").alias("value")).write.mode("overwrite") \
        .partitionBy("family").text(output)


def sample_update(spark: SparkSession, origin: str, addition: str, output: str) -> None:
    lines = readers.read_lines(spark, origin)
    more = readers.existing_paths(spark, [addition])
    labels.update(lines, readers.read_lines(spark, more) if more else None).write.mode("overwrite").text(output)


# Models and audiences.

def train(spark: SparkSession, paths: Mapping[str, str], output: str, dim: int | None = None, rounds: int = 20) -> None:
    """One boosted-tree model per family from ``label idx:val ...`` files.

    Without ``dim`` each family's number of features is found from its file; the model keeps it. A family that
    fails does not stop the others; all failures are raised together at the end.
    """
    failed = {}
    for family, path in paths.items():
        try:
            rows = libsvm.parse_labelled(readers.read_lines(spark, path))
            size = dim or model.dimension(rows, first=0)
            fitted = model.train(model.vectorize(rows, size, keep=("label",), first=0), rounds=rounds)
            model.save(fitted, f"{output}/{family}")
        except Exception as error:
            failed[family] = error
    if failed:
        raise RuntimeError(f"families that failed: { {k: str(v)[:200] for k, v in failed.items()} }") from next(iter(failed.values()))


def predict(spark: SparkSession, path: str, model_path: str, output: str, dim: int | None = None, labelled: bool = False) -> None:
    """``entity<TAB>score`` lines, or with the label between; without ``dim`` the model's own number of features."""
    lines = readers.read_lines(spark, path)
    keep = ("entity", "label") if labelled else ("entity",)
    rows = libsvm.parse_labelled_keyed(lines) if labelled else libsvm.parse_keyed(lines)
    fitted = model.load(model_path)
    sinks.write_tsv(model.score(fitted, model.vectorize(rows, dim or fitted.numFeatures, keep, first=0), keep), output)


def tag_audience(spark: SparkSession, paths: Sequence[str], output: str, labelled: bool = False, files: int = 512) -> None:
    """Merge sub-model scores; write each audience as ``entity, tag id, value`` (the label after the entity, if any) and the pseudo-labels."""
    keys = ("entity", "label") if labelled else ("entity",)
    combined = ensemble.combine(read_scores(spark, paths, labelled), len(paths), keys).persist()
    tagged = ensemble.tag(combined, keep_label=labelled)
    for side in ("pos", "neg"):
        audience = ensemble.audience(tagged, side, keys=keys)
        sinks.write_tsv(audience, f"{output}/{side}", files, order_by=[F.desc("value"), F.col("entity")])
    sinks.write_tsv(ensemble.pseudo_labels(combined), f"{output}/sample", files, sep=",")
    combined.unpersist()


def stack_train(spark: SparkSession, paths: Sequence[str], label_path: str, output: str, rounds: int = 20) -> None:
    """Stacked model over the combined scores; all combined scores and the labelled ones it learns from are written as well."""
    combined = ensemble.combine(read_scores(spark, paths), len(paths))
    sinks.write_tsv(combined, f"{output}/scores")
    stored = readers.read_delimited(spark, f"{output}/scores", {
        "entity": (0, "string"), "smax": (1, "double"), "smin": (2, "double"), "missing": (3, "int")})
    known = read_labels(spark, label_path)
    sinks.write_tsv(ensemble.labelled_scores(stored, known), f"{output}/labelled")
    model.save(ensemble.train_stack(stored, known, rounds), f"{output}/model")


def stack_predict(spark: SparkSession, scores: str, model_path: str, output: str, files: int = 512) -> None:
    """Score and tag with the stacked model, each audience under its own folder."""
    stored = readers.read_delimited(spark, scores, {"entity": (0, "string"), "smax": (1, "double"), "smin": (2, "double")})
    tagged = ensemble.tag_stack(ensemble.score_stack(model.load(model_path), stored))
    for side in ("pos", "neg"):
        audience = ensemble.audience(tagged, side)
        sinks.write_tsv(audience, f"{output}/{side}", files, order_by=[F.desc("value"), F.col("entity")])


# Cohorts.

def place_names(spark: SparkSession, path: str, stores: str, output: str, label_path: str | None = None) -> None:
    """Place names per entity from the Wi-Fi match log."""
    fields = {"entity": (0, c.MISSING_ENTITY), "poi": (4, "[]"), "aoi": (6, "[]")}
    log = n.with_defaults(readers.read_lines(spark, path), "value", fields)
    dictionary = readers.read_json(spark, stores, "wid string, name string").dropDuplicates(["wid"])
    known = read_labels(spark, label_path, "\t", 2, 0) if label_path else None
    sinks.write_tsv(places.names_per_entity(places.matches(log, "poi", "aoi"), dictionary, known), output)


def device_types_and_categories(df: DataFrame, label_rows: DataFrame, types: DataFrame,
                                chain: Sequence[tuple[DataFrame, str, str]], output: str) -> None:
    """Device types of the models and categories of the apps of labelled entities.

    ``df`` holds ``entity, models array, apps array``; ``types`` holds ``item, type``.
    """
    rows = df.withColumn("entity", n.entity_id("entity"))
    kinds = vocab.lookup(bags.distinct_items(rows, "models"), types, "item", "type", c.UNKNOWN)
    categories = items.resolve_category(bags.distinct_items(rows, F.col("apps").cast("array<string>")), chain)
    both = (kinds.select("entity", F.lit("type").alias("kind"), F.col("type").alias("value"))
            .unionByName(categories.select("entity", F.lit("category").alias("kind"), F.col("category").alias("value"))))
    sinks.write_tsv(labels.attach(both.distinct(), label_rows), output)


def visited_cities(spark: SparkSession, path: str, area_path: str, output: str, single_bbox_ok: bool = True) -> None:
    """Cities seen per entity from the Wi-Fi match log."""
    fields = {"entity": (0, "string"), "lng": (2, "double"), "lat": (3, "double"), "poi": (4, "string"), "aoi": (6, "string")}
    log = n.safe_split(readers.read_lines(spark, path), "value", fields)
    matched = log.filter(F.size(places.match_set("poi", "aoi")) > 0)
    areas = geo.load_areas(readers.read_lines(spark, area_path))
    sinks.write_tsv(geo.areas_per_entity(matched, areas, single_bbox_ok), output)


def campaign_audience(spark: SparkSession, path: str, wanted: list[str], label_path: str, output: str) -> None:
    log = campaign.parse_log(readers.read_lines(spark, path))
    sinks.write_tsv(campaign.labelled_audience(log, wanted, read_labels(spark, label_path, "\t", 2, 0)), output)


def device_names(framed: DataFrame, label_rows: DataFrame, output: str) -> None:
    """Distinct labelled device names found in raw framed bodies."""
    body = readers.split_framed(framed).select(F.decode("body", "UTF-8").alias("body"))
    ids = n.entity_id(F.array_join(n.extract_fields("body", "tid"), ""))
    names = F.array_join(n.extract_fields("body", "deviceName"), ",")
    rows = body.select(ids.alias("entity"), names.alias("name")).filter(F.col("name") != "")
    sinks.write_tsv(labels.attach(rows.distinct(), label_rows).select("label", "entity", "name"), output)


def carrier_cohort(monthly: Sequence[DataFrame], codes: Sequence[str] = c.CARRIER_CODES, below: int = 100) -> DataFrame:
    """Entities of the wanted carrier with their identifiers, long form ``entity, kind, item``.

    Each month holds ``entity, apps, carriers, idents`` (arrays). The size bound
    applies to each monthly row before the months are merged.
    """
    kept = readers.union_all([cohort.bounded_sets(m.filter(n.has_any("carriers", list(codes))), ["apps", "carriers", "idents"], below)
                       for m in monthly])
    parts = [bags.union_sets(kept, name).select("entity", F.lit(name).alias("kind"), "item")
             for name in ("apps", "carriers", "idents")]
    return readers.union_all(parts)


def stable_district(periods: Sequence[DataFrame], needed: int | None = None) -> DataFrame:
    """Entities seen in every period with their most frequent district: ``entity, value, freq``."""
    tagged = readers.union_all([p.select("entity", F.lit(i).alias("period"), F.col("district").alias("value"))
                         for i, p in enumerate(periods)])
    return cohort.restrict(cohort.modal(tagged), cohort.stable(tagged, needed or len(periods)))


def batch_by_district(df: DataFrame, output: str, least_items: int = 3, arrays: Sequence[str] = ("apps",)) -> None:
    """Five random batches of entities with enough items, one folder per batch and district."""
    keep = df
    for name in arrays:
        keep = keep.filter(n.size_between(name, least_items))
    flat = [F.array_join(name, ",").alias(name) for name in arrays]
    out = trainset.batches(keep.select("entity", "district", *flat))
    out.write.mode("overwrite").partitionBy("batch", "district").option("sep", "\t").csv(output)


def qualified_entities(df: DataFrame, districts: DataFrame, least_items: int = 3) -> DataFrame:
    """``entity, district`` of entities with a known district and enough items (``apps`` array)."""
    found = vocab.lookup(df, districts, "entity", "district", "None")
    return found.filter((F.col("district") != "None") & n.size_between("apps", least_items)).select("entity", "district")


def confirmed_identifiers(known: DataFrame, devices: DataFrame, qualified: DataFrame) -> DataFrame:
    """``entity, district, ident, imsi``: latest identifier, kept if the device lists it.

    ``known`` holds ``entity, id, dateArray``; ``devices`` holds ``entity, imei, imsi`` arrays.
    """
    ids = known.select(n.entity_id("entity").alias("entity"), F.col("id").alias("ident"),
                       identity.newest_day("dateArray").alias("day"))
    wanted = qualified.withColumn("entity", n.entity_id("entity"))
    latest = identity.latest(cohort.restrict(ids, wanted).filter(F.col("day").isNotNull()))
    own = cohort.restrict(devices, wanted).select("entity", F.col("imei").alias("idents"), F.get("imsi", F.lit(0)).alias("imsi"))
    matched = identity.confirm(latest, own)
    return matched.join(wanted, "entity").select("entity", "district", F.lower("ident").alias("ident"), "imsi")


def translate_districts(spark: SparkSession, paths: Sequence[str], output: str) -> None:
    fields = {"entity": (0, c.MISSING_ENTITY), "district": (1, c.MISSING_DISTRICT), "age": (2, c.MISSING_AGE)}
    rows = n.with_defaults(readers.read_lines(spark, list(paths)), "value", fields)
    sinks.write_tsv(rows.withColumn("district", n.translate("district", c.DISTRICT_CODES, c.UNKNOWN_DISTRICT_CODE)), output)


def feedback_union(spark: SparkSession, paths: Sequence[str], output: str, files: int = 50) -> None:
    rows = n.with_defaults(readers.read_lines(spark, list(paths)), "value", {"entity": (0, c.MISSING_ENTITY), "age": (2, c.MISSING_AGE)})
    sinks.write_tsv(rows, output, files)


def sex_and_age(first: DataFrame, second: DataFrame, output: str, files: int = 50) -> None:
    """Age and sex labels from two feedback layouts (text columns ``c0 ...``)."""
    rows = labels.union_layouts(
        first, second,
        {"entity": "c0", "imei": "c1", "imsi": "c2", "age": "c3", "sex": "c4"},
        {"entity": "c0", "imei": "c2", "imsi": "c3", "age": "c4", "sex": "c5"})
    for column, sentinel in (("age", c.EMPTY_AGE), ("sex", c.EMPTY_SEX)):
        kept = labels.drop_sentinel(rows, column, sentinel).select("entity", "imei", "imsi", labels.recode(column).alias(column)
                                                                   if column == "sex" else F.col(column))
        sinks.write_tsv(kept, f"{output}/{column}", files)


def wifi_locations(observations: DataFrame, residence: DataFrame, output: str) -> None:
    """Observations with filled coordinates, and their join to known places."""
    sinks.write_parquet(n.fill_location(observations), f"{output}/observations")
    sinks.write_parquet(places.enrich(observations, residence), f"{output}/joined")


def cluster_points(spark: SparkSession, path: str, dims: int, output: str, eps: float = c.CLUSTER_RADIUS,
                   min_pts: int = c.CLUSTER_MIN_POINTS) -> None:
    """Cluster tab-separated points; a line's number in the input is its id."""
    lines = readers.read_lines(spark, path)
    vec: Column = F.transform(F.slice(F.split("value", "\t"), 1, dims), lambda x: x.try_cast("double"))
    points = lines.select(F.monotonically_increasing_id().alias("id"), vec.alias("vec"))
    points = points.filter((F.size("vec") == dims) & F.forall("vec", lambda x: x.isNotNull()))
    points = checkpoint(points)
    sinks.write_parquet(cluster.dbscan(points, eps, min_pts, dims), output)

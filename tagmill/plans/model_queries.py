"""Training sets, models, ensembles, evaluation, areas, clustering, file round trips."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.functions import geometry
from tagmill.operators import bags, cluster, ensemble, evaluate, geo, model, ranking, selection, trainset, vocab
from tagmill.functions.constants import SEED
from tagmill.functions.hashing import hash_hex
from tagmill.plans import bindings as b
from tagmill.plans.registry import Tables, query
from tagmill.plans.selection_queries import t2_sql
from tagmill.session import checkpoint, ensure_checkpoint_dir
from tagmill.sources import readers, sinks


def _scratch(t: Tables) -> str:
    """A new folder next to the checkpoints, which every executor can reach."""
    return f"{ensure_checkpoint_dir(t.spark)}/files-{uuid.uuid4().hex}"


# Training sets.

def _labelled_documents(t: Tables) -> DataFrame:
    return trainset.prepare(t.documents.select(F.col("doc_id").alias("entity"), "lang", "source"), b.document_labels(t), unique=True)


@query("SELECT doc_id AS entity, lang, source, quality AS label FROM documents JOIN labels USING (doc_id)")
def m1_trainset(t: Tables) -> DataFrame:
    return _labelled_documents(t)


_DRAW = "CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 8)) AS BIGINT) / 4294967296e0"


def _balanced_sql(ratio: str) -> str:
    return f"""
WITH d AS (SELECT doc_id AS entity, quality AS label FROM documents JOIN labels USING (doc_id)),
n AS (SELECT MIN(c) AS small FROM (SELECT COUNT(*) AS c FROM d GROUP BY label) AS x),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('{SEED}:' || entity), entity) AS rn FROM d)
SELECT entity, label FROM r, n WHERE rn <= CASE WHEN label = 0 THEN small ELSE FLOOR(small * {ratio}) END"""


@query(_balanced_sql("1.0"))
def m2_balanced(t: Tables) -> DataFrame:
    return trainset.balance(_labelled_documents(t)).select("entity", "label")


@query(_balanced_sql("2.5"))
def m2_balanced_ratio(t: Tables) -> DataFrame:
    return trainset.balance(_labelled_documents(t), ratio=2.5).select("entity", "label")


@query(f"""
SELECT event_type, event_id FROM (SELECT event_type, event_id,
 row_number() OVER (PARTITION BY event_type ORDER BY md5('{SEED}:' || event_id), event_id) AS rn FROM events) AS r WHERE rn <= 500""")
def t3_take_per_class(t: Tables) -> DataFrame:
    """A fixed number of rows of each class."""
    rows = t.events.select("event_type", "event_id").withColumn("hash", hash_hex("event_id", SEED)).withColumn("quota", F.lit(500))
    return ranking.smallest_by_hash(rows, ["event_type"], "hash", ["event_id"], "quota").select("event_type", "event_id")


@query(f"""
SELECT doc_id AS entity, quality AS label, CAST(seed AS INT) AS seed,
 CAST(('0x' || substr(md5(seed || ':' || doc_id), 1, 8)) AS BIGINT) / 4294967296e0 < 0.8e0 AS is_train
FROM documents JOIN labels USING (doc_id), (SELECT unnest([1, 2, 3, 4, 5]) AS seed) AS s""")
def m3_repeated_holdout(t: Tables) -> DataFrame:
    return trainset.repeated_holdout(_labelled_documents(t).select("entity", "label"), 0.8)


@query(f"""
SELECT doc_id AS entity, CAST(FLOOR({_DRAW.format(seed=SEED, key='doc_id')} * 5) AS INT) AS fold FROM labels""")
def m3_folds(t: Tables) -> DataFrame:
    return trainset.folds(b.document_labels(t).select("entity"), 5)


@query(f"""
WITH types AS (SELECT user_id AS entity, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS features FROM (
   SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2) AS x GROUP BY 1),
prio AS (SELECT o_custkey AS entity, string_agg(o_orderpriority || ':' || n, ',' ORDER BY o_orderpriority) AS features FROM (
   SELECT o_custkey, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2) AS x GROUP BY 1),
common AS (SELECT l.entity, l.label FROM ({b.USER_LABELS_SQL}) AS l JOIN types USING (entity) JOIN prio USING (entity))
SELECT 'type' AS family, entity, label, features FROM types JOIN common USING (entity)
UNION ALL SELECT 'priority', entity, label, features FROM prio JOIN common USING (entity)""")
def m4_common_trainsets(t: Tables) -> DataFrame:
    types = bags.to_text(bags.count_items(b.event_items(t)), "features")
    priority = bags.to_text(bags.count_items(
        t.orders.select(F.col("o_custkey").alias("entity"), F.col("o_orderpriority").alias("item"))), "features")
    return trainset.common_training_sets({"type": types, "priority": priority}, b.user_labels(t))


@query(f"""
SELECT entity, batch, CASE WHEN entity % 2 = 0 THEN 'even' ELSE 'odd' END AS grp FROM (
 SELECT c_custkey AS entity, CAST(LEAST(FLOOR({_DRAW.format(seed=SEED, key='c_custkey')} / 0.2e0) + 1, 5) AS INT) AS batch FROM customer) AS x""")
def m15_batches(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_custkey").alias("entity"),
                             F.when(F.col("c_custkey") % 2 == 0, "even").otherwise("odd").alias("grp"))
    return trainset.batches(rows)


# Models. Scores come from Spark ML, so there is no SQL for them.

def _family_vectors(t: Tables) -> DataFrame:
    """Documents as sparse vectors over the 256 most telling words."""
    words = b.document_words(t)
    chosen = selection.first_ranked(selection.entropy(b.word_triples(t)), 256)
    return model.vectorize(vocab.encode(words, chosen, rows=256), 256)


@query()
def m5_train_score(t: Tables) -> DataFrame:
    """Train on labelled documents, save, load, score every document."""
    vectors = _family_vectors(t).persist()
    fitted = model.train(trainset.prepare(vectors, b.document_labels(t), unique=True))
    path = _scratch(t)
    model.save(fitted, path)
    return model.score(model.load(path), vectors)


@query("SELECT doc_id AS entity, TRUE AS same FROM documents")
def s14_stored_model(t: Tables) -> DataFrame:
    """Vocabulary, vector builder and trees stored as one model: scores before and after loading, row by row."""
    labelled = b.word_triples(t)
    chosen = checkpoint(selection.first_ranked(selection.entropy(labelled), 256))
    # Only labelled documents train; written once, as training reads them several times.
    vectors = model.vectorize(vocab.encode(labelled.select("entity", "item"), chosen, rows=256), 256)
    fitted = model.train(checkpoint(trainset.prepare(vectors, b.document_labels(t), unique=True)))
    whole = model.bundle([r.item for r in chosen.orderBy("idx").collect()], fitted)
    path = _scratch(t)
    model.save_bundle(whole, path)
    rows = b.texts(t).select("entity", F.split(F.coalesce("text", F.lit("")), " ").alias("items"))
    # Both models score a text while it is at hand.
    before = model.score(whole, rows, keep=("entity", "items")).withColumnRenamed("score", "again")
    scored = checkpoint(model.score(model.load_bundle(path), before, keep=("entity", "again")))
    both = scored.select("entity", "score").join(scored.select(F.col("entity").alias("other"), "again"), F.col("entity") == F.col("other"))
    return both.select("entity", ((F.col("score") == F.col("again")) & F.col("score").between(0, 1)).alias("same"))


@query(f"""SELECT doc_id AS entity, quality AS label,
  CAST(floor({_DRAW.format(seed=SEED, key="CAST(doc_id AS VARCHAR)")} * 3) AS INT) AS fold, TRUE AS scored
FROM documents JOIN labels USING (doc_id) WHERE doc_id IN (
  SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS item FROM documents) AS w
  JOIN (SELECT item FROM ({t2_sql(256)}) AS v) AS v USING (item))""")
def m5_cross_validated(t: Tables) -> DataFrame:
    """Scores out of fold: every labelled document once, by a model that has not seen its fold."""
    labelled = trainset.prepare(_family_vectors(t), b.document_labels(t), unique=True)
    scored = model.cross_validate(labelled, 3, rounds=5, depth=4)
    return scored.select("entity", "label", "fold", F.col("score").between(0, 1).alias("scored"))


@query()
def m10_score_labelled(t: Tables) -> DataFrame:
    """Scores that keep the true label, from a model trained on one side of a holdout split."""
    labelled = trainset.prepare(_family_vectors(t), b.document_labels(t), unique=True)
    split = trainset.repeated_holdout(labelled, 0.8, seeds=(1,)).persist()
    fitted = model.train(split.filter("is_train"))
    return model.score(fitted, split.filter("not is_train"), keep=("label", "entity"))


@query()
def m11_stack(t: Tables) -> DataFrame:
    """Stacked model over combined scores, scored and tagged."""
    combined = ensemble.combine(b.scores(t), 5).persist()
    fitted = ensemble.train_stack(combined, b.user_labels(t))
    return ensemble.score_stack(fitted, combined)


@query(f"""
SELECT entity, CASE WHEN score >= 0.65e0 THEN 'pos' WHEN score <= 0.4e0 THEN 'neg' END AS tag,
 ROUND(CASE WHEN score >= 0.65e0 THEN 100 * score ELSE 100 * (1 - score) END, 6) AS value
FROM ({b.SCORES_SQL}) AS s WHERE family = 'view' AND (score >= 0.65e0 OR score <= 0.4e0)""")
def m12_tag_stack(t: Tables) -> DataFrame:
    one = b.scores(t).filter(F.col("family") == "view")
    return ensemble.tag_stack(one).withColumn("value", F.round("value", 6))


# Ensembles.

@query(b.COMBINED_SQL)
def a8_score_combine(t: Tables) -> DataFrame:
    return ensemble.combine(b.scores(t), 5)


def _tag_sql(columns: str, source: str) -> str:
    return f"""
SELECT {columns}, CASE WHEN smax >= 0.65e0 AND smin > 0.4e0 THEN 'pos' ELSE 'neg' END AS tag,
 ROUND(CASE WHEN smax >= 0.65e0 AND smin > 0.4e0 THEN 100 * smax ELSE 100 * (1 - smin) END, 6) AS value
FROM {source} WHERE (smax >= 0.65e0 AND smin > 0.4e0) OR smin <= 0.4e0"""


@query(_tag_sql("entity", f"({b.COMBINED_SQL}) AS c"))
def m6_tag_scores(t: Tables) -> DataFrame:
    return ensemble.tag(ensemble.combine(b.scores(t), 5)).withColumn("value", F.round("value", 6))


@query(_tag_sql("entity", f"({b.COMBINED_SQL}) AS c"))
def t1_sorted_tags(t: Tables) -> DataFrame:
    """The audience from strongest to weakest (range-partitioned sort)."""
    tagged = ensemble.tag(ensemble.combine(b.scores(t), 5)).withColumn("value", F.round("value", 6))
    return ensemble.sorted_tags(tagged)


@query(f"""
SELECT entity, CASE WHEN smax >= 0.95e0 THEN 1 ELSE 0 END AS label FROM ({b.COMBINED_SQL}) AS c
WHERE smax >= 0.95e0 OR smin <= 0.15e0""")
def m7_pseudo_labels(t: Tables) -> DataFrame:
    return ensemble.pseudo_labels(ensemble.combine(b.scores(t), 5))


@query(_tag_sql("c.entity, l.label", f"({b.COMBINED_SQL}) AS c JOIN ({b.USER_LABELS_SQL}) AS l ON l.entity = c.entity"))
def m8_tag_with_label(t: Tables) -> DataFrame:
    labelled = trainset.prepare(b.scores(t), b.user_labels(t))
    combined = ensemble.combine(labelled, 5, keys=("entity", "label"))
    return ensemble.tag(combined, keep_label=True).withColumn("value", F.round("value", 6))


@query("SELECT batch, tag, COUNT(*) AS n FROM (" + _tag_sql(
    "CAST(LEAST(FLOOR(" + _DRAW.format(seed=SEED, key="entity") + " / 0.2e0) + 1, 5) AS INT) AS batch",
    f"({b.COMBINED_SQL}) AS c") + ") AS x GROUP BY 1, 2")
def m9_batched_tagging(t: Tables) -> DataFrame:
    """Batches are a column; tagging stays a single pass."""
    tagged = ensemble.tag(ensemble.combine(b.scores(t), 5))
    return trainset.batches(tagged).groupBy("batch", "tag").agg(F.count("*").alias("n"))


# Evaluation.

@query(f"""
WITH s AS (SELECT score, label FROM ({b.SCORES_SQL}) AS s JOIN ({b.USER_LABELS_SQL}) AS l USING (entity)),
r AS (SELECT label, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2e0 AS rk FROM s)
SELECT ROUND((SUM(CASE WHEN label = 1 THEN rk END) - SUM(label) * (SUM(label) + 1) / 2e0)
             / (SUM(label) * SUM(1 - label)), 9) AS auc FROM r""")
def e1_auc(t: Tables) -> DataFrame:
    return evaluate.auc(trainset.prepare(b.scores(t), b.user_labels(t))).select(F.round("auc", 9).alias("auc"))


@query(f"""
SELECT ROUND(AVG(CASE WHEN (score >= 0.5e0) = (label = 1) THEN 1e0 ELSE 0e0 END), 9) AS accuracy
FROM ({b.SCORES_SQL}) AS s JOIN ({b.USER_LABELS_SQL}) AS l USING (entity)""")
def e2_accuracy(t: Tables) -> DataFrame:
    scored = trainset.prepare(b.scores(t), b.user_labels(t)).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return evaluate.accuracy(scored).select(F.round("accuracy", 9).alias("accuracy"))


# Areas.

def _areas(t: Tables) -> DataFrame:
    return geo.load_areas(b.area_lines(t))


@query(f"""
SELECT code, name, COUNT(*) AS corners, MIN(lat) AS min_lat, MAX(lat) AS max_lat, MIN(lng) AS min_lng, MAX(lng) AS max_lng
FROM ({b.VERTICES_SQL}) AS v GROUP BY 1, 2""")
def geo1_load_areas(t: Tables) -> DataFrame:
    return _areas(t).select("code", "name", F.size("ring").cast("bigint").alias("corners"),
                            "min_lat", "max_lat", "min_lng", "max_lng")


@query(f"""
WITH boxes AS (SELECT code, MIN(lat) AS a0, MAX(lat) AS a1, MIN(lng) AS g0, MAX(lng) AS g1 FROM ({b.VERTICES_SQL}) AS v GROUP BY 1),
lv AS (SELECT *, CAST(CEIL(LOG2(GREATEST(a1 - a0, g1 - g0))) AS INT) AS level FROM boxes),
x AS (SELECT *, unnest(range(CAST(FLOOR(a0 / 2 ** level) AS BIGINT), CAST(FLOOR(a1 / 2 ** level) AS BIGINT) + 1)) AS cell_lat FROM lv)
SELECT code, level, cell_lat,
 unnest(range(CAST(FLOOR(g0 / 2 ** level) AS BIGINT), CAST(FLOOR(g1 / 2 ** level) AS BIGINT) + 1)) AS cell_lng FROM x""")
def geo2_cover_cells(t: Tables) -> DataFrame:
    return geo.cover_cells(_areas(t)).select("code", "level", "cell_lat", "cell_lng")


@query(b.TESTS_SQL + """
SELECT p.pid, COALESCE(f.code, 'null') AS code FROM points AS p
LEFT JOIN (SELECT pid, MIN(code) AS code FROM tests WHERE inside GROUP BY 1) AS f USING (pid)""")
def geo3_locate(t: Tables) -> DataFrame:
    return geo.locate(b.points(t).select("pid", "lat", "lng"), _areas(t)).select("pid", "code")


@query(b.TESTS_SQL + """
SELECT p.pid, COALESCE(f.code, 'null') AS code FROM points AS p
LEFT JOIN (SELECT pid, CASE WHEN COUNT(*) = 1 THEN MIN(code) ELSE MIN(CASE WHEN inside THEN code END) END AS code
           FROM tests GROUP BY 1) AS f USING (pid)""")
def geo4_locate_single_box(t: Tables) -> DataFrame:
    return geo.locate(b.points(t).select("pid", "lat", "lng"), _areas(t), single_bbox_ok=True).select("pid", "code")


@query(b.TESTS_SQL + """
SELECT p.pid, COALESCE(x.inside, false) AS inside FROM points AS p
LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN tests AS x ON x.pid = p.pid AND x.name = n_name""")
def geo5_contains(t: Tables) -> DataFrame:
    """Is a customer's point inside the area of the customer's own nation?"""
    own = _areas(t).join(t.nation, F.col("name") == F.col("n_name"))
    rows = b.points(t).join(own, F.col("c_nationkey") == F.col("n_nationkey"))
    inside = geometry.in_box("lat", "lng") & geometry.contains("ring", "lat", "lng")
    return rows.select("pid", inside.alias("inside"))


_NAMES_SQL = f"""
 SELECT {b.AREA_CODE_SQL} AS code, n_name AS name FROM nation
 UNION ALL SELECT DISTINCT printf('%02d%02d00', n_regionkey + 11, n_nationkey % 5 + 1),
   'CITY_' || (n_regionkey + 11) || '_' || (n_nationkey % 5 + 1) FROM nation
 UNION ALL SELECT printf('%02d0000', r_regionkey + 11), r_name FROM region"""


def _area_names(t: Tables) -> DataFrame:
    towns = t.nation.select(
        F.format_string("%02d%02d00", F.col("n_regionkey") + 11, F.col("n_nationkey") % 5 + 1).alias("code"),
        F.concat(F.lit("CITY_"), F.col("n_regionkey") + 11, F.lit("_"), F.col("n_nationkey") % 5 + 1).alias("name")).distinct()
    return readers.union_all([
        t.nation.select(b.area_code().alias("code"), F.col("n_name").alias("name")), towns,
        t.region.select(F.format_string("%02d0000", F.col("r_regionkey") + 11).alias("code"), F.col("r_name").alias("name"))])


@query(b.TESTS_SQL + f""", located AS (SELECT p.pid, COALESCE(f.code, 'null') AS code FROM points AS p
 LEFT JOIN (SELECT pid, MIN(code) AS code FROM tests WHERE inside GROUP BY 1) AS f USING (pid)),
names AS ({_NAMES_SQL})
SELECT pid, located.code, COALESCE(d.name, 'null') AS district, COALESCE(c.name, 'null') AS city, COALESCE(v.name, 'null') AS province
FROM located LEFT JOIN names AS d ON d.code = located.code LEFT JOIN names AS c ON c.code = substr(located.code, 1, 4) || '00'
LEFT JOIN names AS v ON v.code = substr(located.code, 1, 2) || '0000'""")
def geo6_rollup(t: Tables) -> DataFrame:
    located = geo.locate(b.points(t).select("pid", "lat", "lng"), _areas(t)).select("pid", "code")
    return geo.rollup(located, _area_names(t))


@query(b.TESTS_SQL + """, located AS (SELECT p.pid, f.name FROM points AS p
 LEFT JOIN (SELECT pid, MIN(code) AS code, arg_min(name, code) AS name FROM tests WHERE inside GROUP BY 1) AS f USING (pid))
SELECT DISTINCT o_orderpriority AS entity, COALESCE(name, 'Not Found') AS name FROM located JOIN orders ON o_custkey = pid""")
def geo7_areas_per_entity(t: Tables) -> DataFrame:
    """Areas seen per order priority: few entities, very many points each."""
    visits = (b.points(t).join(t.orders.select(F.col("o_custkey").alias("pid"), F.col("o_orderpriority").alias("entity")), "pid"))
    return geo.areas_per_entity(visits, _areas(t))


# Clustering.

_RADIUS, _MIN_POINTS = 1.08, 3
_POINT_RADIUS, _POINT_MIN_POINTS = 0.3, 5


def _dbscan_sql(rows: str, near: str, min_pts: int) -> str:
    """Clusters over ``p(id, ...)`` given by ``rows``; ``near`` says when rows a and b are neighbours."""
    return f"""
WITH RECURSIVE p AS ({rows}),
near AS (SELECT a.id AS i, b.id AS j FROM p AS a JOIN p AS b ON {near}),
core AS (SELECT i AS id FROM near GROUP BY i HAVING COUNT(*) >= {min_pts}),
edges AS (SELECT i, j FROM near WHERE i IN (SELECT id FROM core) AND j IN (SELECT id FROM core)),
reach(id, root) AS (SELECT id, id FROM core UNION SELECT e.j, r.root FROM reach AS r JOIN edges AS e ON e.i = r.id),
comp AS (SELECT id, MIN(root) AS root FROM reach GROUP BY id),
num AS (SELECT id, dense_rank() OVER (ORDER BY root) AS cluster FROM comp),
border AS (SELECT n.i AS id, MIN(num.cluster) AS cluster FROM near AS n JOIN num ON num.id = n.j
           WHERE n.i NOT IN (SELECT id FROM core) GROUP BY 1)
SELECT p.id, COALESCE(num.cluster, border.cluster, 0) AS cluster,
 CASE WHEN num.id IS NOT NULL THEN 1 WHEN border.id IS NOT NULL THEN 0 ELSE -1 END AS kind
FROM p LEFT JOIN num ON num.id = p.id LEFT JOIN border ON border.id = p.id"""


@query(_dbscan_sql("SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings",
                   f"list_distance(a.vec, b.vec) <= {_RADIUS}", _MIN_POINTS))
def c1_dbscan(t: Tables) -> DataFrame:
    """The vectors, all coordinates, clustered by density."""
    rows = t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return cluster.dbscan(rows, _RADIUS, _MIN_POINTS)


@query(_dbscan_sql("SELECT c_custkey AS id, c_acctbal / 1000e0 AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer",
                   f"sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {_POINT_RADIUS}e0", _POINT_MIN_POINTS))
def c1_dbscan_points(t: Tables) -> DataFrame:
    """Customers in the plane of balance and nation clustered by density."""
    vec = F.array(F.col("c_acctbal") / F.lit(1000.0), F.col("c_nationkey").cast("double"))
    return cluster.dbscan(t.customer.select(F.col("c_custkey").alias("id"), vec.alias("vec")), _POINT_RADIUS, _POINT_MIN_POINTS, dims=2)


@query("""
WITH heads AS (SELECT label, arg_min(embedding, vec_id) AS head FROM embeddings GROUP BY label)
SELECT vec_id, ROUND(sqrt(list_sum(list_transform(range(1, len(embedding) + 1),
  lambda i: (CAST(embedding[i] AS DOUBLE) - CAST(head[i] AS DOUBLE)) * (CAST(embedding[i] AS DOUBLE) - CAST(head[i] AS DOUBLE))))), 6) AS distance
FROM embeddings JOIN heads USING (label)""")
def c2_distance(t: Tables) -> DataFrame:
    """Distance of each vector to the first one of its label."""
    heads = t.embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("head"))
    rows = t.embeddings.join(heads, "label")
    return rows.select("vec_id", F.round(geometry.distance("embedding", "head"), 6).alias("distance"))


# Files: written to a shared folder and read back.

@query("SELECT event_id, user_id AS entity, event_type AS item, CAST(ROUND(value * 100) AS BIGINT) AS cents FROM events")
def s7_tsv_round_trip(t: Tables) -> DataFrame:
    path = _scratch(t)
    rows = t.events.select("event_id", "user_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    sinks.write_tsv(rows, path, files=4)
    fields = {"event_id": (0, "bigint"), "entity": (1, "bigint"), "item": (2, "string"), "cents": (3, "bigint")}
    return readers.read_delimited(t.spark, path, fields)


@query("""
SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""")
def s8_json_by_day(t: Tables) -> DataFrame:
    """One folder per day in one job, read back over a date window (partition pruning)."""
    path = _scratch(t)
    sinks.write_json_by_day(t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("day")), path)
    days = readers.date_window("2024-01-09", 4)
    rows = readers.read_json(t.spark, path, "event_id bigint, user_id bigint, event_type string, day date")
    return rows.filter(readers.between_days("day", days[0], days[-1])).drop("day")


@query("SELECT c_custkey AS entity, c_mktsegment AS model, c_name AS brand FROM customer")
def s9_parquet_nested(t: Tables) -> DataFrame:
    """Nested device structs written as Parquet and read back by dotted path."""
    path = _scratch(t)
    device = F.struct(F.col("c_mktsegment").alias("model"), F.col("c_name").alias("brand"), F.col("c_nationkey").alias("pixel"))
    sinks.write_parquet(t.customer.select(F.col("c_custkey").alias("entity"), device.alias("device")), path)
    return readers.read_entities(t.spark, path, {"entity": "entity", "model": "device.model", "brand": "device.brand"})


@query("SELECT item, CAST(row_number() OVER (ORDER BY item) AS BIGINT) AS idx FROM (SELECT DISTINCT p_name AS item FROM part) AS d")
def s11_vocabulary_file(t: Tables) -> DataFrame:
    path = _scratch(t)
    vocab.write(vocab.build(t.part.select(F.col("p_name").alias("item")), 1), path)
    return readers.read_delimited(t.spark, path + "/schema", {"item": (0, "string"), "idx": (1, "bigint")})


@query("""
SELECT o_orderkey AS entity, o_custkey AS customer, COUNT(*) AS lines, CAST(SUM(l_quantity) AS BIGINT) AS quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def j7_bucketed_join(t: Tables) -> DataFrame:
    """Both sides stored hashed and sorted by the key; joined and summed without an exchange."""
    sides = {"orders": t.orders.select(F.col("o_orderkey").alias("entity"), F.col("o_custkey").alias("customer")),
             "lines": t.lineitem.select(F.col("l_orderkey").alias("entity"), "l_quantity")}
    names = {}
    for side, rows in sides.items():
        names[side] = f"{side}_{uuid.uuid4().hex}"
        sinks.write_bucketed(rows, names[side], buckets=16, path=_scratch(t))
    joined = t.spark.table(names["orders"]).hint("merge").join(t.spark.table(names["lines"]), "entity")
    return joined.groupBy("entity", "customer").agg(F.count("*").alias("lines"), F.sum("l_quantity").cast("bigint").alias("quantity"))


def _by_day(t: Tables) -> DataFrame:
    return t.events.select("event_id", "event_type", F.to_date("ts").alias("day"))


@query("SELECT event_id, event_type, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-12'")
def s6_day_folders(t: Tables) -> DataFrame:
    """Parquet folders per day; a window reads its own folders only."""
    path = _scratch(t)
    sinks.write_parquet(_by_day(t), path, ("day",))
    return readers.read_window(t.spark, path, "2024-01-12", 9).select("event_id", "event_type", "day")


@query("""SELECT event_id, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-06' THEN event_type || '!' ELSE event_type END AS event_type,
  CAST(ts AS DATE) AS day FROM events""")
def s10_day_overwrite(t: Tables) -> DataFrame:
    """One day written again, twice over; the other days stay as they are."""
    path = _scratch(t)
    sinks.overwrite_days(_by_day(t), path)
    again = _by_day(t).filter(F.col("day") == F.lit(date(2024, 1, 6))).withColumn("event_type", F.concat("event_type", F.lit("!")))
    for _ in range(2):
        sinks.overwrite_days(again, path)
    return t.spark.read.parquet(path).select("event_id", "event_type", "day")


@query("""
SELECT CAST(event_id AS VARCHAR) AS key, CAST(props->>'$.k' AS BIGINT) AS ts, 'body of ' || event_id AS body FROM events""")
def s4_sequence_files(t: Tables) -> DataFrame:
    """Framed records written to Hadoop sequence files, read back and split."""
    path = _scratch(t)
    header = F.concat(F.lit('{"ts":'), F.get_json_object("props", "$.k"), F.lit("}"))
    frame = F.concat(F.encode(header, "UTF-8"), F.unhex(F.lit("00")), F.encode(F.concat(F.lit("body of "), "event_id"), "UTF-8"))
    sinks.write_framed(t.events.select(F.col("event_id").alias("key"), frame.alias("value")), path)
    parts = readers.split_framed(readers.read_framed(t.spark, path))
    return parts.select("key", "ts", F.decode("body", "UTF-8").alias("body"))

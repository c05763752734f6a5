"""How the benchmark tables play the parts of entity logs, labels, places and scores.

Each Spark binding has its SQL twin next to it, so that a query and its oracle
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.functions.arrays import unnest
from tagmill.operators.labels import attach
from tagmill.plans.registry import Tables
from tagmill.session import spread

# Item bought by a customer, label: is the account balance not negative.
PURCHASES_SQL = """
 SELECT DISTINCT o_custkey AS entity, p_brand AS brand, p_type AS type,
        CAST(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS INT) AS label
 FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
 JOIN customer ON c_custkey = o_custkey"""
BRANDS_SQL = f"SELECT DISTINCT entity, brand AS item, label FROM ({PURCHASES_SQL}) AS p"
TYPES_SQL = f"SELECT DISTINCT entity, type AS item, label FROM ({PURCHASES_SQL}) AS p"


def bought(t: Tables) -> DataFrame:
    """``entity, brand, type`` per line item."""
    return (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("entity"))
            .join(spread(t.lineitem.select("l_orderkey", "l_partkey")), "l_orderkey")
            .join(t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"),
                                F.col("p_type").alias("type")), "l_partkey")
            .select("entity", "brand", "type"))


def customer_labels(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("entity"), (F.col("c_acctbal") >= 0).cast("int").alias("label"))


def purchase_triples(t: Tables, column: str) -> DataFrame:
    """``entity, item, label``, distinct. Duplicates collapse before the label is attached."""
    pairs = bought(t).select("entity", F.col(column).alias("item")).distinct()
    return pairs.join(customer_labels(t), "entity")


# Words of a document, label: its quality.
WORDS_SQL = """
 SELECT DISTINCT d.doc_id AS entity, w.item, l.quality AS label
 FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS item FROM documents) AS w
 JOIN documents AS d USING (doc_id) JOIN labels AS l USING (doc_id)"""


def texts(t: Tables) -> DataFrame:
    """``entity, text`` of the documents."""
    return spread(t.documents.select(F.col("doc_id").alias("entity"), "text"))


def document_words(t: Tables) -> DataFrame:
    """``entity, item`` for each distinct word of each document."""
    return unnest(texts(t), F.array_distinct(F.split("text", " ")), "entity")


def document_labels(t: Tables, column: str = "quality") -> DataFrame:
    return t.labels.select(F.col("doc_id").alias("entity"), F.col(column).alias("label"))


def word_triples(t: Tables) -> DataFrame:
    """Words of labelled documents; the label join runs before the text is split."""
    labelled = attach(texts(t), document_labels(t), unique=True)
    return unnest(labelled, F.array_distinct(F.split("text", " ")), "entity", "label")


def event_items(t: Tables) -> DataFrame:
    return t.events.select(F.col("user_id").alias("entity"), F.col("event_type").alias("item"))


# Scores of five sub-models: whole cents per user and event type, folded into 0 .. 1.
SCORES_SQL = """
 SELECT user_id AS entity, event_type AS family,
        (CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) % 1001) / 1000e0 AS score
 FROM events GROUP BY 1, 2"""
COMBINED_SQL = f"""
 SELECT entity, MAX(score) AS smax, MIN(score) AS smin, CAST(5 - COUNT(score) AS INT) AS missing
 FROM ({SCORES_SQL}) AS s GROUP BY entity"""


def scores(t: Tables) -> DataFrame:
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint"))
    return (t.events.groupBy(F.col("user_id").alias("entity"), F.col("event_type").alias("family"))
            .agg(((cents % 1001) / F.lit(1000.0)).alias("score")))


# Users with an even id are positive, others negative; every seventh user is unlabelled.
USER_LABELS_SQL = """
 SELECT DISTINCT user_id AS entity, CAST(CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END AS INT) AS label
 FROM events WHERE user_id % 7 <> 0"""


def user_labels(t: Tables) -> DataFrame:
    users = t.events.select(F.col("user_id").alias("entity")).distinct()
    return (users.filter(F.col("entity") % 7 != 0)
            .select("entity", (F.col("entity") % 2 == 0).cast("int").alias("label")))


# One concave area per nation, a point per customer.
RING = ((0, ".0137", 0, ".0171"), (3, ".5239", 0, ".2213"), (2, ".1177", 1, ".4319"),
        (5, ".7731", 5, ".6127"), (0, ".2911", 3, ".3371"))
AREA_CODE_SQL = "printf('%02d%02d%02d', n_regionkey + 11, n_nationkey % 5 + 1, n_nationkey + 1)"
VERTICES_SQL = " UNION ALL ".join(
    f"SELECT {AREA_CODE_SQL} AS code, n_name AS name, {i} AS pos, "
    f"CAST((20 + 4 * (n_nationkey // 5) + {dlat}) || '{flat}' AS DOUBLE) AS lat, "
    f"CAST((100 + 4 * (n_nationkey % 5) + {dlng}) || '{flng}' AS DOUBLE) AS lng FROM nation"
    for i, (dlat, flat, dlng, flng) in enumerate(RING))
POINTS_SQL = """
 SELECT c_custkey AS pid, 20 + ((c_custkey * 7919) % 2500) / 100e0 AS lat,
        100 + ((c_custkey * 104729) % 2500) / 100e0 AS lng, c_nationkey FROM customer"""
# Point, area, bounding-box test and even-odd test.
TESTS_SQL = f"""
 WITH v AS ({VERTICES_SQL}),
 edges AS (SELECT a.code, a.name, a.lat AS plat, a.lng AS plng, b.lat AS qlat, b.lng AS qlng
           FROM v AS a JOIN v AS b ON a.code = b.code AND b.pos = (a.pos + 1) % {len(RING)}),
 boxes AS (SELECT code, MIN(plat) AS lat0, MAX(plat) AS lat1, MIN(plng) AS lng0, MAX(plng) AS lng1
           FROM edges GROUP BY code),
 points AS ({POINTS_SQL}),
 tests AS (SELECT p.pid, p.lat, p.lng, e.code, e.name,
             SUM(CASE WHEN (plat < p.lat) <> (qlat < p.lat)
                       AND p.lng < (qlng - plng) * (p.lat - plat) / (qlat - plat) + plng THEN 1 ELSE 0 END) % 2 = 1 AS inside
           FROM points AS p JOIN boxes AS b ON p.lat BETWEEN lat0 AND lat1 AND p.lng BETWEEN lng0 AND lng1
           JOIN edges AS e ON e.code = b.code GROUP BY 1, 2, 3, 4, 5)"""


def area_code() -> Column:
    return F.format_string("%02d%02d%02d", F.col("n_regionkey") + 11, F.col("n_nationkey") % 5 + 1,
                           F.col("n_nationkey") + 1)


def area_lines(t: Tables) -> DataFrame:
    """Polygon lines ``code<TAB>name<TAB>lat,lng;...`` derived from the nations."""
    south = 20 + 4 * F.floor(F.col("n_nationkey") / 5)
    west = 100 + 4 * (F.col("n_nationkey") % 5)
    corners = [F.concat((south + dlat).cast("string"), F.lit(flat + ","), (west + dlng).cast("string"), F.lit(flng))
               for dlat, flat, dlng, flng in RING]
    return t.nation.select(F.concat_ws("\t", area_code(), "n_name", F.concat_ws(";", *corners)).alias("value"))


def points(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("pid"),
        (20 + (F.col("c_custkey") * 7919) % 2500 / F.lit(100.0)).alias("lat"),
        (100 + (F.col("c_custkey") * 104729) % 2500 / F.lit(100.0)).alias("lng"), "c_nationkey")


# Nested sessions: one message package per conversation turn; words are the activities.
def packages(t: Tables) -> DataFrame:
    """``entity, app, time, messages`` where each message has a session of activities or none."""
    turns = spread(t.conversations).withColumn("words", F.split("text", " "))
    # Each word next to the one before it; the last pair has no word.
    pairs = F.zip_with("words", F.concat(F.array(F.lit(None).cast("string")), "words"),
                       lambda w, before: F.struct(w.alias("w"), before.alias("before")))
    activities = F.transform(pairs, lambda p, i: F.struct(
        F.when(p["w"] != "", p["w"]).alias("name"), (F.col("turn") * 1000 + i).alias("start"), i.alias("duration"),
        p["before"].alias("refer")))
    # A message without words has no session.
    session = F.when(F.exists("words", lambda w: w != ""), F.struct(activities.alias("activities")))
    app = F.when(F.col("role") == "system", F.lit('"com.android.systemui"')).otherwise(
        F.concat(F.lit('"app.'), F.col("role"), F.lit('"')))
    return turns.select(F.col("conv_id").alias("entity"), app.alias("app"), F.col("turn").alias("time"),
                                  F.array(F.struct(session.alias("session"))).alias("messages"))


ACTIVITIES_SQL = """
 SELECT conv_id AS entity, role, turn AS time, NULLIF(w[i], '') AS name, turn * 1000 + i - 1 AS start,
        CAST(i - 1 AS BIGINT) AS duration, CASE WHEN i > 1 THEN w[i - 1] END AS refer
 FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i
       FROM (SELECT *, string_split(text, ' ') AS w FROM conversations) AS c) AS u
 WHERE w[i] <> ''"""

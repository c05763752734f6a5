"""Parsing, bags, joins, cohorts, set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.functions import constants as c
from tagmill.functions import normalize as n
from tagmill.operators import bags, campaign, cohort, features, identity, items, labels, places, sessions, trainset, vocab
from tagmill.plans import bindings as b
from tagmill.plans.registry import Tables, query
from tagmill.sources import readers


# Values and lines.

@query("SELECT c_custkey, regexp_replace(lower(c_name), '[^0-9a-z]', '', 'g') AS entity FROM customer")
def p1_normalize_id(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", n.entity_id("c_name").alias("entity"))


@query("SELECT c_custkey, c_name || CASE WHEN c_custkey % 3 = 0 THEN '\"' ELSE '' END AS item FROM customer")
def p2_strip_quotes(t: Tables) -> DataFrame:
    extra = F.when(F.col("c_custkey") % 3 == 0, F.lit('""')).otherwise(F.lit('"'))
    return t.customer.select("c_custkey", n.strip_quotes(F.concat(F.lit('"'), "c_name", extra)).alias("item"))


@query("SELECT c_custkey AS entity, c_nationkey AS nation, c_name AS name FROM customer "
       "WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0")
def p4_malformed_rows(t: Tables) -> DataFrame:
    """Every seventh line has a text where a number belongs, every eleventh is cut short."""
    nation = F.when(F.col("c_custkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("c_nationkey").cast("string"))
    full = F.concat_ws("\t", "c_custkey", nation, "c_name")
    line = F.when(F.col("c_custkey") % 11 == 0, F.col("c_custkey").cast("string")).otherwise(full)
    fields = {"entity": (0, "bigint"), "nation": (1, "int"), "name": (2, "string")}
    return n.safe_split(t.customer.select(line.alias("value")), "value", fields)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS entity,
 CASE WHEN c_custkey % 5 = 0 THEN 'District missing' ELSE c_mktsegment END AS district,
 CASE WHEN c_custkey % 5 = 0 OR c_custkey % 4 = 0 THEN 'Age missing' ELSE CAST(c_nationkey AS VARCHAR) END AS age FROM customer""")
def p5_missing_defaults(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    line = (F.when(F.col("c_custkey") % 5 == 0, key)
            .when(F.col("c_custkey") % 4 == 0, F.concat_ws("\t", key, "c_mktsegment"))
            .otherwise(F.concat_ws("\t", key, "c_mktsegment", "c_nationkey")))
    return n.with_defaults(t.customer.select(line.alias("value")), "value", {
        "entity": (0, c.MISSING_ENTITY), "district": (1, c.MISSING_DISTRICT), "age": (2, c.MISSING_AGE)})


@query("SELECT event_id, CAST(props->>'$.k' AS INT) AS k, CAST(NULL AS VARCHAR) AS note, CAST(0 AS BIGINT) AS size, false AS flag FROM events")
def p6_json_fields(t: Tables) -> DataFrame:
    return t.events.select("event_id", *n.json_fields("props", {
        "k": "int", "note": "string", "size": "bigint", "flag": "boolean"}))


@query("SELECT o_orderkey, o_orderpriority AS item FROM orders WHERE o_orderkey % 3 <> 0")
def p7_not_nullish(t: Tables) -> DataFrame:
    item = (F.when(F.col("o_orderkey") % 9 == 0, F.lit("null")).when(F.col("o_orderkey") % 9 == 3, F.lit(""))
            .when(F.col("o_orderkey") % 9 != 6, F.col("o_orderpriority")))
    return t.orders.select("o_orderkey", item.alias("item")).filter(n.not_nullish("item"))


@query(f"SELECT 'brand' AS mode, entity, brand AS item FROM ({b.PURCHASES_SQL}) AS p "
       f"UNION SELECT 'type', entity, type FROM ({b.PURCHASES_SQL}) AS p")
def p8_item_by_mode(t: Tables) -> DataFrame:
    """The same reader with the item column chosen by an argument."""
    rows = b.bought(t)
    return readers.union_all([bags.distinct_items(bags.read_columns(rows, "entity", mode))
                              .select(F.lit(mode).alias("mode"), "entity", "item") for mode in ("brand", "type")])


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'null' ELSE lang END || '|' || source AS item FROM documents")
def p9_composite(t: Tables) -> DataFrame:
    lang = F.when(F.col("doc_id") % 4 != 0, F.col("lang"))
    return t.documents.select("doc_id", items.composite(lang, "source").alias("item"))


@query("SELECT DISTINCT user_id AS entity, hour(ts) || ':' || event_type AS item FROM events")
def p10_hour_item(t: Tables) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.events.select(F.col("user_id").alias("entity"), items.hour_item(millis, "event_type").alias("item")).distinct()


@query("""
SELECT event_id, 'u' || user_id AS tid, event_type || ',' || 'k' || user_id % 3 AS names FROM events""")
def p11_regex_fields(t: Tables) -> DataFrame:
    """Distinct ids and names found anywhere in a raw body."""
    def one(name: Column) -> Column:
        return F.concat(F.lit('{"tid":"U-'), "user_id", F.lit('","deviceName":"'), name, F.lit('","x":1}'))

    second = F.concat(F.lit("k"), F.col("user_id") % 3)
    body = F.concat_ws(" ", one(F.col("event_type")), one(second), one(F.col("event_type")))
    raw = t.events.select("event_id", body.alias("body"))
    return raw.select("event_id", n.entity_id(F.array_join(n.extract_fields("body", "tid"), "")).alias("tid"),
                      F.array_join(n.extract_fields("body", "deviceName"), ",").alias("names"))


def _feedback_log(t: Tables) -> DataFrame:
    """Comma-separated feedback lines derived from orders; every thirteenth lost its last columns."""
    line = F.concat_ws(",", F.lit("log"), F.col("o_orderkey").cast("string"),
                       F.concat(F.lit("bc:"), F.substring("o_orderpriority", 1, 1)),
                       F.concat(F.lit("sc:S"), F.col("o_custkey") % 40),
                       F.col("o_orderstatus"), F.lit("x"),
                       F.concat(F.lit("id:C-"), F.col("o_custkey")), F.lit("yes"))
    short = F.substring_index(line, ",", 5)
    return t.orders.select(F.when(F.col("o_orderkey") % 13 == 0, short).otherwise(line).alias("value"))


_LOG_SQL = """
 SELECT 'c' || o_custkey AS entity, substr(o_orderpriority, 1, 1) AS campaign, 'S' || o_custkey % 40 AS channel,
        o_orderstatus AS feedback, 'yes' AS matched FROM orders WHERE o_orderkey % 13 <> 0"""


@query(_LOG_SQL)
def p12_kv_log(t: Tables) -> DataFrame:
    return campaign.parse_log(_feedback_log(t))


@query(f"SELECT entity, campaign AS item FROM ({_LOG_SQL}) AS l UNION SELECT entity, channel FROM ({_LOG_SQL}) AS l")
def a5_campaigns_per_entity(t: Tables) -> DataFrame:
    return campaign.campaigns_per_entity(campaign.parse_log(_feedback_log(t)))


@query(f"""
SELECT DISTINCT entity, CASE WHEN CAST(substr(entity, 2) AS BIGINT) % 2 = 0 THEN '1' ELSE 'Unknown' END AS label
FROM ({_LOG_SQL}) AS l WHERE campaign IN ('1', '3') OR channel IN ('S7', 'S12')""")
def p20_any_campaign(t: Tables) -> DataFrame:
    log = campaign.parse_log(_feedback_log(t))
    known = (t.customer.filter(F.col("c_custkey") % 2 == 0)
             .select(F.concat(F.lit("c"), "c_custkey").alias("entity"), F.lit(1).alias("label")))
    return campaign.labelled_audience(log, ["1", "3", "S7", "S12"], known)


def _match_log(t: Tables) -> DataFrame:
    """Tab-separated place matches: bracketed lists of brands and types per order line."""
    line = F.concat_ws("\t", F.col("entity").cast("string"), F.lit("x"), F.lit("1.5"), F.lit("2.5"),
                       F.concat(F.lit("["), "brand", F.lit(",]")), F.lit("y"),
                       F.concat(F.lit("["), F.when(F.col("entity") % 2 == 0, F.col("type")).otherwise(F.lit("")), F.lit("]")))
    return b.bought(t).select(line.alias("value"))


def _matches(t: Tables) -> DataFrame:
    rows = n.with_defaults(_match_log(t), "value", {"entity": (0, ""), "poi": (4, "[]"), "aoi": (6, "[]")})
    return places.matches(rows, "poi", "aoi")


_MATCHES_SQL = f"""
 SELECT CAST(entity AS VARCHAR) AS entity, brand AS wid FROM ({b.PURCHASES_SQL}) AS p
 UNION SELECT CAST(entity AS VARCHAR), type FROM ({b.PURCHASES_SQL}) AS p WHERE entity % 2 = 0"""


@query(_MATCHES_SQL)
def p13_match_set(t: Tables) -> DataFrame:
    return _matches(t)


# Names of places: every brand but those ending in 7, no type.
_STORES_SQL = "SELECT DISTINCT p_brand AS wid, 'Store ' || substr(p_brand, 7) AS name FROM part WHERE NOT p_brand LIKE '%7'"


def _stores(t: Tables) -> DataFrame:
    brands = t.part.select(F.col("p_brand").alias("wid")).filter(~F.col("wid").endswith("7")).distinct()
    return brands.select("wid", F.concat(F.lit("Store "), F.substring("wid", 7, 10)).alias("name"))


@query(f"SELECT DISTINCT entity, COALESCE(name, 'Unknown') AS name FROM ({_MATCHES_SQL}) AS m LEFT JOIN ({_STORES_SQL}) AS s USING (wid)")
def geo8_names_per_entity(t: Tables) -> DataFrame:
    return places.names_per_entity(_matches(t), _stores(t))


@query(f"""
SELECT DISTINCT m.entity, COALESCE(name, 'Unknown') AS name, CAST(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS INT) AS label
FROM ({_MATCHES_SQL}) AS m LEFT JOIN ({_STORES_SQL}) AS s USING (wid) JOIN customer ON CAST(c_custkey AS VARCHAR) = m.entity""")
def geo8_names_labelled(t: Tables) -> DataFrame:
    known = b.customer_labels(t).withColumn("entity", F.col("entity").cast("string"))
    return places.names_per_entity(_matches(t), _stores(t), known)


def _observations(t: Tables) -> DataFrame:
    """Wi-Fi sightings derived from customers; coordinates of every third are NaN."""
    lost = F.col("pid") % 3 == 0
    half = F.col("pid") % 6 == 0
    nan = F.lit(float("nan"))
    return b.points(t).select(
        F.col("pid").alias("entity"), F.concat(F.lit("ssid"), F.col("pid") % 10).alias("ssid"),
        F.when(lost, nan).otherwise(F.col("lng")).alias("rlng"), F.when(half, nan).otherwise(F.col("lat")).alias("rlat"),
        (F.col("lng") + 1).alias("lng"), (F.col("lat") + 1).alias("lat"))


_FILLED_SQL = f"""
 SELECT pid AS entity, 'ssid' || pid % 10 AS ssid, CASE WHEN pid % 3 = 0 THEN lng + 1 ELSE lng END AS rlng,
  CASE WHEN pid % 6 = 0 THEN lat + 1 ELSE lat END AS rlat, lng + 1 AS lng, lat + 1 AS lat, pid % 3 = 0 AS from_pool
 FROM ({b.POINTS_SQL}) AS p"""


@query(_FILLED_SQL)
def p14_nan_fallback(t: Tables) -> DataFrame:
    return n.fill_location(_observations(t))


@query(f"SELECT f.*, s_acctbal AS dlng, s_nationkey AS dlat FROM ({_FILLED_SQL}) AS f JOIN supplier ON s_suppkey = entity")
def geo9_enrich(t: Tables) -> DataFrame:
    residence = t.supplier.select(F.col("s_suppkey").alias("entity"), F.col("s_acctbal").alias("dlng"),
                                  F.col("s_nationkey").alias("dlat"))
    return places.enrich(_observations(t), residence)


_DISTRICTS = [*c.DISTRICT_CODES, "其他"]


@query("SELECT c_custkey, CASE c_nationkey % 17 "
       + " ".join(f"WHEN {i} THEN '{c.DISTRICT_CODES.get(name, c.UNKNOWN_DISTRICT_CODE)}'" for i, name in enumerate(_DISTRICTS))
       + " END AS district FROM customer")
def p15_translate(t: Tables) -> DataFrame:
    name = F.element_at(F.array(*[F.lit(d) for d in _DISTRICTS]), F.col("c_nationkey") % 17 + 1)
    return t.customer.select("c_custkey", n.translate(name, c.DISTRICT_CODES, c.UNKNOWN_DISTRICT_CODE).alias("district"))


def _feedback(t: Tables, first: bool) -> DataFrame:
    """One of two positional feedback layouts."""
    rows = t.customer.filter((F.col("c_custkey") % 2 == 0) == F.lit(first))
    age = F.when(F.col("c_custkey") % 5 == 0, F.lit(c.EMPTY_AGE)).otherwise(F.col("c_nationkey").cast("string"))
    fields = [F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment"), age,
              (F.col("c_custkey") % 3).cast("string")]
    if not first:
        fields.insert(1, F.lit("-"))
    return rows.select(*[f.alias(f"c{i}") for i, f in enumerate(fields)])


_FEEDBACK_SQL = f"""
 SELECT CAST(c_custkey AS VARCHAR) AS entity, c_name AS imei, c_mktsegment AS imsi,
  CASE WHEN c_custkey % 5 = 0 THEN '{c.EMPTY_AGE}' ELSE CAST(c_nationkey AS VARCHAR) END AS age,
  CAST(c_custkey % 3 AS VARCHAR) AS sex FROM customer"""


def _layouts(t: Tables) -> DataFrame:
    return labels.union_layouts(
        _feedback(t, True), _feedback(t, False),
        {"entity": "c0", "imei": "c1", "imsi": "c2", "age": "c3", "sex": "c4"},
        {"entity": "c0", "imei": "c2", "imsi": "c3", "age": "c4", "sex": "c5"})


@query(_FEEDBACK_SQL)
def g4_layout_union(t: Tables) -> DataFrame:
    return _layouts(t)


@query(f"SELECT entity, CASE WHEN sex = '2' THEN '0' ELSE sex END AS sex FROM ({_FEEDBACK_SQL}) AS f")
def p16_recode(t: Tables) -> DataFrame:
    return _layouts(t).select("entity", labels.recode("sex").alias("sex"))


@query(f"SELECT entity, age FROM ({_FEEDBACK_SQL}) AS f WHERE age <> '{c.EMPTY_AGE}'")
def p17_drop_sentinel(t: Tables) -> DataFrame:
    return labels.drop_sentinel(_layouts(t), "age", c.EMPTY_AGE).select("entity", "age")


def _identifiers(t: Tables) -> DataFrame:
    """Per document: carrier codes in nested arrays and identifiers, all made from its words."""
    words = b.texts(t).withColumn("words", F.split("text", " "))
    codes = F.transform("words", lambda w: F.array(F.concat(F.lit("4600"), F.char_length(w) % 10)))
    return words.select("entity", codes.alias("codes"), "words")


_CODES_SQL = """
 SELECT DISTINCT doc_id AS entity, '4600' || length(w) % 10 AS code
 FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) AS x"""


@query(f"SELECT entity, string_agg(code, ',' ORDER BY code) AS codes FROM ({_CODES_SQL}) AS c GROUP BY 1")
def p24_distinct_values(t: Tables) -> DataFrame:
    return _identifiers(t).select("entity", F.array_join(F.array_sort(n.distinct_values("codes")), ",").alias("codes"))


@query(f"SELECT DISTINCT entity FROM ({_CODES_SQL}) AS c WHERE code IN ('46001', '46006')")
def p18_has_any(t: Tables) -> DataFrame:
    rows = _identifiers(t).select("entity", n.distinct_values("codes").alias("codes"))
    return rows.filter(cohort.has_any("codes", list(c.CARRIER_CODES))).select("entity")


@query("""
SELECT doc_id AS entity, len(list_distinct(string_split(text, ' '))) AS n FROM documents
WHERE len(list_distinct(string_split(text, ' '))) >= 3 AND len(list_distinct(string_split(text, ' '))) < 100""")
def p19_size_bounds(t: Tables) -> DataFrame:
    rows = cohort.bounded_sets(_identifiers(t), ["codes", "words"], below=100)
    counted = rows.select("entity", F.array_distinct("words").alias("words"))
    return counted.filter(cohort.size_between("words", 3)).select("entity", F.size("words").cast("bigint").alias("n"))


@query("""
SELECT entity, item, CAST(SUM(slots) AS BIGINT) AS cnt FROM (
 SELECT user_id AS entity, event_type AS item, CAST(ts AS DATE) AS d, COUNT(DISTINCT hour(ts)) AS slots FROM events GROUP BY 1, 2, 3) AS s
GROUP BY 1, 2""")
def a3_active_slots(t: Tables) -> DataFrame:
    """Hours of a day as a 24-bit mask per row; set bits summed per entity and item."""
    masks = (t.events.groupBy(F.col("user_id").alias("entity"), F.col("event_type").alias("item"), F.to_date("ts").alias("d"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour("ts"))).alias("mask")))
    counted = masks.withColumn("slots", bags.active_slots("mask", binary=False).cast("bigint"))
    return bags.sum_slots(counted)


@query("SELECT user_id AS entity, COUNT(DISTINCT event_id % 4096) AS slots FROM events GROUP BY 1")
def p22_bitmap_count(t: Tables) -> DataFrame:
    """Set bits of one binary bitmap per entity."""
    maps = t.events.groupBy(F.col("user_id").alias("entity")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("event_id") % 4096 + 1)).alias("bits"))
    return maps.select("entity", bags.active_slots("bits").alias("slots"))


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def p23_millis_to_date(t: Tables) -> DataFrame:
    return t.events.select("event_id", items.day(F.unix_millis(F.col("ts").cast("timestamp"))).alias("day"))


# Bags.

@query("SELECT user_id AS entity, event_type AS item, COUNT(*) AS cnt FROM events GROUP BY 1, 2")
def a1_bag_counts(t: Tables) -> DataFrame:
    return bags.count_items(b.event_items(t))


@query("""
SELECT item, COUNT(*) AS cnt FROM (SELECT DISTINCT conv_id, turn, unnest(string_split(text, ' ')) AS item FROM conversations) AS w GROUP BY 1""")
def a1_bag_counts_nested(t: Tables) -> DataFrame:
    """Items in an array; repeats inside a row count once."""
    rows = t.conversations.select(F.lit(0).alias("entity"), F.split("text", " ").alias("words"))
    return bags.count_items(rows, "words").select("item", "cnt")


def _daily_bags(t: Tables) -> DataFrame:
    """``k:v,k:v`` texts per user and day, with a broken pair at the end."""
    counted = t.events.groupBy("user_id", F.to_date("ts").alias("day"), F.col("event_type").alias("item")).agg(F.count("*").alias("cnt"))
    # One row per user and day: the pair of keys stands in for the entity while the text is built.
    keyed = counted.select(F.struct("user_id", "day").alias("entity"), "item", "cnt")
    return bags.to_text(keyed).select(F.col("entity.user_id").alias("entity"), F.concat("bag", F.lit(",broken")).alias("bag"))


@query("SELECT user_id AS entity, event_type AS item, COUNT(*) AS cnt FROM events GROUP BY 1, 2")
def a2_bag_merge(t: Tables) -> DataFrame:
    return bags.merge(bags.parse(_daily_bags(t)))


@query("SELECT DISTINCT user_id AS entity, event_type AS item FROM events")
def a4_distinct_items(t: Tables) -> DataFrame:
    return bags.distinct_items(b.event_items(t))


@query("SELECT DISTINCT conv_id AS entity, unnest(list_concat(string_split(text, ' '), [role])) AS item FROM conversations")
def a5_union_sets(t: Tables) -> DataFrame:
    rows = t.conversations.select(F.col("conv_id").alias("entity"), F.split("text", " ").alias("words"), F.array("role").alias("roles"))
    return bags.union_sets(rows, "words", "roles")


@query("""
SELECT entity, event_id FROM (SELECT user_id AS entity, event_id,
 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) AS r WHERE rn <= 20""")
def a6_cap_records(t: Tables) -> DataFrame:
    rows = t.events.select(F.col("user_id").alias("entity"), "ts", "event_id")
    return sessions.cap_records(rows, ["ts", "event_id"]).select("entity", "event_id")


@query("""
WITH types AS (SELECT user_id AS entity, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS f FROM (
   SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2) AS x GROUP BY 1),
hours AS (SELECT user_id AS entity, string_agg(h || ':' || n, ',' ORDER BY h) AS f FROM (
   SELECT user_id, hour(ts) AS h, COUNT(*) AS n FROM events WHERE user_id % 2 = 0 GROUP BY 1, 2) AS x GROUP BY 1)
SELECT entity, types.f || COALESCE(' ' || hours.f, '') AS features FROM types LEFT JOIN hours USING (entity)""")
def a7_union_families(t: Tables) -> DataFrame:
    types = bags.to_text(bags.count_items(b.event_items(t)), "features")
    hours = (t.events.filter(F.col("user_id") % 2 == 0)
             .select(F.col("user_id").alias("entity"), F.hour("ts").alias("item")))
    return features.union_families([types, bags.to_text(bags.count_items(hours), "features")])


@query("""
SELECT user_id AS entity, CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS idx,
 CAST(COUNT(*) AS DOUBLE) AS val FROM events GROUP BY 1, 2
UNION ALL SELECT user_id, hour(ts) + 6, CAST(COUNT(*) AS DOUBLE) FROM events GROUP BY 1, 2""")
def a7_stack_encoded(t: Tables) -> DataFrame:
    """Two encoded families in one index space: 5 event types, then 24 hours."""
    types = vocab.encode_long(b.event_items(t), vocab.build(b.event_items(t), 1), "count")
    hours = bags.count_items(t.events.select(F.col("user_id").alias("entity"), (F.hour("ts") + 1).alias("item")))
    hours = hours.select("entity", F.col("item").alias("idx"), F.col("cnt").cast("double").alias("val"))
    return features.stack_encoded({"type": (types, 5), "hour": (hours, 24)}).select("entity", F.col("idx").cast("bigint").alias("idx"), "val")


@query("SELECT quality AS label, COUNT(*) AS n FROM labels GROUP BY 1")
def a11_class_record_counts(t: Tables) -> DataFrame:
    return trainset.class_counts(b.document_labels(t))


@query("SELECT doc_id AS entity, CAST(quality | toxic AS INT) AS label FROM labels")
def a12_label_conflict(t: Tables) -> DataFrame:
    both = b.document_labels(t, "quality").unionByName(b.document_labels(t, "toxic"))
    return labels.dedupe(both)


_LATEST_SQL = """
 SELECT entity, ident FROM (SELECT o_custkey AS entity, CAST(o_orderkey AS VARCHAR) AS ident,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS rn FROM orders) AS r WHERE rn = 1"""


def _latest(t: Tables) -> DataFrame:
    days = F.array(F.lit("19700101"), F.date_format("o_orderdate", "yyyyMMdd"))
    return identity.latest(t.orders.select(F.col("o_custkey").alias("entity"), F.col("o_orderkey").cast("string").alias("ident"),
                                           identity.newest_day(days).alias("day")))


@query(_LATEST_SQL)
def a13_latest_identifier(t: Tables) -> DataFrame:
    return _latest(t)


@query(f"""
SELECT entity, ident FROM ({_LATEST_SQL}) AS l WHERE EXISTS (
 SELECT 1 FROM orders WHERE o_custkey = entity AND CAST(o_orderkey AS VARCHAR) = ident AND o_orderstatus <> 'P')""")
def j10_confirm_identifier(t: Tables) -> DataFrame:
    """The latest order counts only if it is among the customer's settled ones."""
    settled = t.orders.filter(F.col("o_orderstatus") != "P")
    known = settled.select(F.col("o_custkey").alias("entity"), F.col("o_orderkey").cast("string").alias("ident"))
    return identity.confirm_pairs(_latest(t), known).select("entity", "ident")


def _periods(t: Tables) -> DataFrame:
    return t.events.select(F.col("user_id").alias("entity"), F.floor((F.dayofmonth("ts") - 1) / 6).alias("period"),
                           F.col("event_type").alias("value"))


@query("SELECT user_id AS entity FROM events GROUP BY 1 HAVING COUNT(DISTINCT (day(ts) - 1) // 6) = 5")
def a14_every_period(t: Tables) -> DataFrame:
    return cohort.stable(_periods(t), 5)


_MODAL_SQL = """
 SELECT entity, value, freq FROM (SELECT user_id AS entity, event_type AS value, COUNT(*) AS freq,
  row_number() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, event_type) AS rn FROM events GROUP BY 1, 2) AS r WHERE rn = 1"""


@query(_MODAL_SQL)
def a15_modal_value(t: Tables) -> DataFrame:
    return cohort.modal(_periods(t))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(text, ' '))), ' ') AS words FROM documents")
def a17_row_distinct(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.array_join(F.sort_array(bags.row_distinct(F.split("text", " "))), " ").alias("words"))


@query("SELECT DISTINCT event_type, user_id FROM events")
def a18_global_distinct(t: Tables) -> DataFrame:
    return t.events.select("event_type", "user_id").distinct()


@query("SELECT user_id AS entity, event_type AS item, CAST(ts AS DATE) AS day, COUNT(*) AS cnt FROM events GROUP BY 1, 2, 3")
def a20_daily_counts(t: Tables) -> DataFrame:
    rows = t.events.select(F.col("user_id").alias("entity"), F.col("event_type").alias("item"), F.to_date("ts").alias("day"))
    return bags.daily_counts(rows)


# Joins.

@query("SELECT event_id, user_id AS entity FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 5000)")
def j1_semi(t: Tables) -> DataFrame:
    rich = t.customer.filter(F.col("c_acctbal") >= 5000).select(F.col("c_custkey").alias("entity"))
    return cohort.restrict(t.events.select("event_id", F.col("user_id").alias("entity")), rich)


@query("SELECT e.event_id, e.user_id AS entity, CAST(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS INT) AS label "
       "FROM events AS e JOIN customer ON c_custkey = user_id")
def j2_label_inner(t: Tables) -> DataFrame:
    return labels.attach(t.events.select("event_id", F.col("user_id").alias("entity")), b.customer_labels(t))


@query("""
SELECT event_id, COALESCE(CASE WHEN n_nationkey < 20 THEN n_name END, 'not found') AS name
FROM events LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey""")
def j3_left_default(t: Tables) -> DataFrame:
    names = (t.customer.join(t.nation.filter(F.col("n_nationkey") < 20), F.col("c_nationkey") == F.col("n_nationkey"))
             .select("c_custkey", F.col("n_name").alias("name")))
    return vocab.lookup(t.events.select("event_id", "user_id"), names.withColumnRenamed("c_custkey", "user_id"),
                        "user_id", "name", "not found").select("event_id", "name")


@query("""
SELECT l_orderkey, l_linenumber, COALESCE(r_name, 'UnknownCategory') AS category
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 4) AS g ON n_regionkey = r_regionkey""")
def j4_dictionary_chain(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("item"))
    chain = [(t.supplier, "s_suppkey", "s_nationkey"), (t.nation, "n_nationkey", "n_regionkey"),
             (t.region.filter(F.col("r_regionkey") < 4), "r_regionkey", "r_name")]
    return items.resolve_category(rows, chain).select("l_orderkey", "l_linenumber", "category")


@query("""
SELECT o_custkey AS entity, o_orderkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def j6_inner(t: Tables) -> DataFrame:
    left = t.orders.select("o_orderkey", F.col("o_custkey").alias("entity"))
    return cohort.merge(left, t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey"), "o_orderkey") \
        .select("entity", "o_orderkey", "l_partkey")


@query(f"""
SELECT DISTINCT e.user_id AS entity, hour(e.ts) || ':' || e.event_type AS item, l.label
FROM events AS e JOIN ({b.USER_LABELS_SQL}) AS l ON l.entity = e.user_id""")
def j7_hour_items_labelled(t: Tables) -> DataFrame:
    """Distinct hour items per entity joined to conflicting labels merged by OR; one exchange key throughout."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    sets = bags.distinct_items(t.events.select(F.col("user_id").alias("entity"), items.hour_item(millis, "event_type").alias("item")))
    known = b.user_labels(t)
    return labels.attach(sets, known.unionByName(known.withColumn("label", F.lit(0))))


@query("SELECT s_suppkey AS wid, s_name AS name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 49)")
def j8_prune_dictionary(t: Tables) -> DataFrame:
    used = t.lineitem.filter(F.col("l_quantity") >= 49).select(F.col("l_suppkey").alias("wid"))
    return vocab.prune(t.supplier.select(F.col("s_suppkey").alias("wid"), F.col("s_name").alias("name")), used, "wid")


@query("SELECT o_orderkey AS wid, o_orderpriority AS name FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)")
def j8_prune_large_dictionary(t: Tables) -> DataFrame:
    """Orders with a line of the largest quantity; a filter of the keys works before the orders are exchanged."""
    used = t.lineitem.filter(F.col("l_quantity") == 50).select(F.col("l_orderkey").alias("wid"))
    return vocab.prune_large(t.orders.select(F.col("o_orderkey").alias("wid"), F.col("o_orderpriority").alias("name")), used, "wid")


# Set operations.

@query("SELECT o_custkey AS entity FROM orders UNION ALL SELECT user_id FROM events UNION ALL SELECT c_custkey FROM customer")
def g1_union_all(t: Tables) -> DataFrame:
    return readers.union_all([t.orders.select(F.col("o_custkey").alias("entity")),
                              t.events.select(F.col("user_id").alias("entity")),
                              t.customer.select(F.col("c_custkey").alias("entity"))])


@query("SELECT doc_id AS entity, quality AS label FROM labels UNION SELECT doc_id, toxic FROM labels")
def g2_union_distinct(t: Tables) -> DataFrame:
    return labels.update(b.document_labels(t, "quality"), b.document_labels(t, "toxic"))


@query(f"""
SELECT entity, label FROM ({b.USER_LABELS_SQL}) AS l WHERE entity IN (SELECT o_custkey FROM orders)
 AND entity IN (SELECT user_id FROM events WHERE event_type = 'click') AND entity IN (SELECT c_custkey FROM customer)""")
def g3_intersection(t: Tables) -> DataFrame:
    families = [t.orders.select(F.col("o_custkey").alias("entity")),
                t.events.filter(F.col("event_type") == "click").select(F.col("user_id").alias("entity")),
                t.customer.select(F.col("c_custkey").alias("entity"))]
    return trainset.intersect(families, b.user_labels(t))


@query("""
SELECT COUNT(DISTINCT user_id) AS entities, COUNT(DISTINCT CASE WHEN user_id % 7 <> 0 THEN user_id END) AS labelled,
 COUNT(DISTINCT CASE WHEN user_id % 7 <> 0 AND user_id % 2 = 0 THEN user_id END) AS positives,
 COUNT(DISTINCT CASE WHEN user_id % 7 <> 0 AND user_id % 2 <> 0 THEN user_id END) AS negatives FROM events""")
def e3_label_coverage(t: Tables) -> DataFrame:
    return labels.coverage(b.event_items(t), b.user_labels(t))


# Readers.

@query("""
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS ts, 'body of ' || event_id AS body FROM events""")
def s4_framed_binary(t: Tables) -> DataFrame:
    header = F.concat(F.lit('{"ts":'), F.get_json_object("props", "$.k"), F.lit("}"))
    frame = F.concat(F.encode(header, "UTF-8"), F.unhex(F.lit("00")),
                     F.encode(F.concat(F.lit("body of "), "event_id"), "UTF-8"))
    parts = readers.split_framed(t.events.select("event_id", frame.alias("value")))
    return parts.select("event_id", "ts", F.decode("body", "UTF-8").alias("body"))


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'")
def s6_date_window(t: Tables) -> DataFrame:
    days = readers.date_window(date(2024, 1, 20), 10)
    return t.events.select("event_id", F.to_date("ts").alias("day")).filter(readers.between_days("day", days[0], days[-1]))


@query("SELECT c_custkey AS entity, c_name AS name FROM customer")
def s5_existing_inputs(t: Tables) -> DataFrame:
    """Missing inputs are dropped from the list before the scan."""
    paths = [f"{t.folder}/customer.parquet", f"{t.folder}/no_such_table.parquet"]
    return readers.union_all([readers.read_entities(t.spark, p, {"entity": "c_custkey", "name": "c_name"})
                              for p in readers.existing_paths(t.spark, paths)])


@query("SELECT doc_id, length(text) AS n FROM documents ORDER BY doc_id LIMIT 100")
def t4_first_rows(t: Tables) -> DataFrame:
    """First rows in a stated order (a sampling operator)."""
    return t.documents.orderBy("doc_id").limit(100).select("doc_id", F.char_length("text").cast("bigint").alias("n"))

"""Feature selection, ranking, vocabularies, encoding, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.functions.arrays import unnest
from tagmill.functions.hashing import FNV_PRIMES, FNV_STARTS, fnv
from tagmill.operators import bags, ranking, selection, sessions, simhash, vocab
from tagmill.plans import bindings as b
from tagmill.plans.registry import Tables, query
from tagmill.session import broadcast_if_small, spread
from tagmill.sources import libsvm


def _entropy_sql(triples: str, body: str) -> str:
    return f"""
WITH triples AS ({triples}),
tot AS (SELECT CAST(SUM(label) AS DOUBLE) AS pos_all, CAST(COUNT(*) AS DOUBLE) AS n_all FROM triples),
st AS (SELECT item, CAST(SUM(label) AS DOUBLE) AS pos, CAST(COUNT(*) AS DOUBLE) AS n FROM triples GROUP BY item),
r AS (SELECT item, pos, n, n_all, pos/n AS p1, (pos_all-pos)/NULLIF(n_all-n,0) AS p2 FROM st CROSS JOIN tot),
scored AS (SELECT item, CAST(pos AS BIGINT) AS pos, CAST(n AS BIGINT) AS n,
  COALESCE(n/n_all * (-p1*LN(p1+1e-7) - (1-p1)*LN(1-p1+1e-7))
         + (n_all-n)/n_all * (-p2*LN(p2+1e-7) - (1-p2)*LN(1-p2+1e-7)), CAST('NaN' AS DOUBLE)) AS entropy FROM r)
{body}"""


_PLAIN = "SELECT item, pos, n, ROUND(entropy, 6) AS entropy FROM scored"


def _rounded(scored: DataFrame) -> DataFrame:
    return scored.withColumn("entropy", F.round("entropy", 6))


@query(_entropy_sql(b.WORDS_SQL, _PLAIN))
def f1_entropy_tokens(t: Tables) -> DataFrame:
    return _rounded(selection.entropy(b.word_triples(t)))


@query(_entropy_sql(b.BRANDS_SQL, _PLAIN))
def f1_entropy_brand(t: Tables) -> DataFrame:
    return _rounded(selection.entropy(b.purchase_triples(t, "brand")))


@query(_entropy_sql(b.TYPES_SQL, _PLAIN))
def f1_entropy_type(t: Tables) -> DataFrame:
    return _rounded(selection.entropy(b.purchase_triples(t, "type")))


_FAMILY_STATS = f"""
WITH triples AS (SELECT 'brand' AS family, * FROM ({b.BRANDS_SQL}) AS x
                 UNION ALL SELECT 'type' AS family, * FROM ({b.TYPES_SQL}) AS y),
tot AS (SELECT family, CAST(SUM(label) AS DOUBLE) AS pos_all, CAST(COUNT(*) AS DOUBLE) AS n_all FROM triples GROUP BY 1),
st AS (SELECT family, item, CAST(SUM(label) AS DOUBLE) AS pos, CAST(COUNT(*) AS DOUBLE) AS n FROM triples GROUP BY 1, 2),
r AS (SELECT st.*, n_all, pos/n AS p1, (pos_all-pos)/NULLIF(n_all-n,0) AS p2 FROM st JOIN tot USING (family)),
scored AS (SELECT family, item, ROUND(n/n_all * (-p1*LN(p1+1e-7) - (1-p1)*LN(1-p1+1e-7))
         + (n_all-n)/n_all * (-p2*LN(p2+1e-7) - (1-p2)*LN(1-p2+1e-7)), 12) AS entropy FROM r)"""


@query(_FAMILY_STATS + """
SELECT family, item, row_number() OVER (PARTITION BY family ORDER BY entropy, item) AS rank FROM scored""")
def w1_entropy_row_rank(t: Tables) -> DataFrame:
    """Two families ranked in one job."""
    pairs = b.bought(t).select("entity", F.explode(F.array(
        F.struct(F.lit("brand").alias("family"), F.col("brand").alias("item")),
        F.struct(F.lit("type").alias("family"), F.col("type").alias("item")))).alias("i"))
    triples = (pairs.select("entity", "i.family", "i.item").distinct().join(b.customer_labels(t), "entity"))
    scored = selection.entropy(triples, groups=["family"])
    return selection.rank(scored, "row", ["family"]).select("family", "item", "rank")


@query(_entropy_sql(b.WORDS_SQL, """
SELECT item, dense_rank() OVER (ORDER BY ROUND(entropy, 12)) AS rank FROM scored"""))
def w2_entropy_dense_rank(t: Tables) -> DataFrame:
    return selection.rank(selection.entropy(b.word_triples(t)), "dense").select("item", "rank")


@query("""
SELECT value, AVG(CAST(rn AS DOUBLE)) AS rank
FROM (SELECT value, row_number() OVER (ORDER BY value DESC) AS rn FROM events) AS r GROUP BY value""")
def w3_average_ranks(t: Tables) -> DataFrame:
    """Average descending rank of tied values."""
    counted = t.events.groupBy("value").agg(F.count("*").alias("n"))
    ranked = ranking.running_sums(counted, [F.desc("value")], {"before": "n"})
    return ranked.select("value", (F.col("before") + (F.col("n") + 1) / 2.0).alias("rank"))


@query("SELECT item, row_number() OVER (ORDER BY item) - 1 AS idx FROM "
       "(SELECT DISTINCT unnest(string_split(text, ' ')) AS item FROM documents) AS d")
def w4_vocab_index(t: Tables) -> DataFrame:
    return vocab.build(b.document_words(t), 0)


def t2_sql(dim: int) -> str:
    """The most telling words of labelled documents."""
    return _entropy_sql(b.WORDS_SQL, f"""
SELECT item, CAST(rank AS INT) AS idx FROM (
  SELECT item, row_number() OVER (ORDER BY ROUND(entropy, 12), item) AS rank FROM scored) AS k WHERE rank <= {dim}""")


@query(t2_sql(768))
def t2_vocab_top(t: Tables) -> DataFrame:
    return selection.first_ranked(selection.entropy(b.word_triples(t)), 768)


_FAMILY_WORDS = """SELECT DISTINCT lang AS family, doc_id AS entity, unnest(string_split(text, ' ')) AS item, quality AS label
 FROM documents JOIN labels USING (doc_id) WHERE lang IS NOT NULL"""


@query(f"""
WITH triples AS ({_FAMILY_WORDS}),
st AS (SELECT family, item, CAST(SUM(label) AS BIGINT) AS p, COUNT(*) AS n FROM triples GROUP BY 1, 2),
tot AS (SELECT family, CAST(SUM(p) AS BIGINT) AS tp, CAST(SUM(n - p) AS BIGINT) AS tn FROM st GROUP BY 1),
parts AS (SELECT family, item, n, tp + tn AS t, p / n::DOUBLE AS i, (tp - p) / NULLIF(tp + tn - n, 0)::DOUBLE AS o FROM st JOIN tot USING (family)),
scored AS (SELECT family, item, COALESCE(
   n::DOUBLE / t * (-i * ln(i + 1e-7) - (1 - i) * ln(1 - i + 1e-7)) + (t - n)::DOUBLE / t * (-o * ln(o + 1e-7) - (1 - o) * ln(1 - o + 1e-7)),
   'nan'::DOUBLE) AS entropy FROM parts)
SELECT family, item, CAST(idx AS INT) AS idx FROM (
 SELECT family, item, row_number() OVER (PARTITION BY family ORDER BY ROUND(entropy, 12), item) AS idx FROM scored) AS r WHERE idx <= 64""")
def t2_vocab_top_families(t: Tables) -> DataFrame:
    """The most telling words of each language."""
    docs = t.documents.select(F.col("doc_id").alias("entity"), F.col("lang").alias("family"), "text").filter("lang IS NOT NULL")
    labelled = spread(docs).join(b.document_labels(t).distinct(), "entity")
    # Only documents whose id comes again in its language can repeat a word; the words of all others are not exchanged.
    again = broadcast_if_small(docs.groupBy("entity", "family").agg(F.count("*").alias("n")).filter("n > 1").drop("n"))

    def triples_of(rows: DataFrame) -> DataFrame:
        return unnest(rows, F.array_distinct(F.split("text", " ")), "family", "entity", "label")

    keys = ["entity", "family"]
    triples = triples_of(labelled.join(again, keys, "left_anti")).unionByName(
        triples_of(labelled.join(again, keys, "left_semi")).distinct())
    return selection.first_ranked(selection.entropy(triples, groups=["family"]), 64, ["family"])


@query(f"""
WITH triples AS ({b.BRANDS_SQL}),
tot AS (SELECT CAST(SUM(label) AS DOUBLE) / COUNT(*) AS prior FROM triples),
st AS (SELECT item, CAST(SUM(label) AS DOUBLE) AS p, CAST(COUNT(*) AS DOUBLE) AS s FROM triples GROUP BY item),
q AS (SELECT item, p, s - p AS n, s, prior * s AS ep, (1 - prior) * s AS en FROM st CROSS JOIN tot)
SELECT item, ROUND(ABS(n - en) / SQRT(en) + ABS(p - ep) / SQRT(ep), 6) AS chi,
  ROUND(-GREATEST(n/s, 1e-8) * LOG2(GREATEST(n/s, 1e-8)) - GREATEST(p/s, 1e-8) * LOG2(GREATEST(p/s, 1e-8)), 6) AS ent,
  ROUND((n/s) * (n/s) + (p/s) * (p/s), 6) AS gini FROM q""")
def f2_chi_entropy_gini(t: Tables) -> DataFrame:
    scored = selection.chi_entropy_gini(b.purchase_triples(t, "brand"))
    return scored.select("item", *[F.round(c, 6).alias(c) for c in ("chi", "ent", "gini")])


@query(f"SELECT CAST(SUM(label) AS BIGINT) AS all_pos, CAST(SUM(1 - label) AS BIGINT) AS all_neg FROM ({b.BRANDS_SQL}) AS x")
def a9_class_counts(t: Tables) -> DataFrame:
    counts = selection.class_counts(b.purchase_triples(t, "brand"))
    return counts.select(F.col("all_pos").cast("bigint"), F.col("all_neg").cast("bigint"))


@query(f"SELECT item, CAST(SUM(label) AS BIGINT) AS pos, COUNT(*) AS n FROM ({b.WORDS_SQL}) AS x GROUP BY item")
def a10_item_stats(t: Tables) -> DataFrame:
    return selection.item_stats(b.word_triples(t))


@query(f"""
SELECT family, entity, item, label FROM (
 SELECT DISTINCT 'word' AS family, doc_id AS entity, trim(w, '"') AS item, quality AS label
 FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '"', '', 'g'), ' ')) AS w FROM documents) AS d JOIN labels USING (doc_id)
 UNION ALL SELECT 'source', doc_id, source, quality FROM documents JOIN labels USING (doc_id)
 UNION ALL SELECT 'lang', doc_id, lang, quality FROM documents JOIN labels USING (doc_id)) AS f
WHERE item <> '' AND item <> 'null'""")
def f17_triples(t: Tables) -> DataFrame:
    """Three families of labelled triples from one scan."""
    docs = spread(t.documents).select(F.col("doc_id").alias("entity"),
                              F.split(F.replace("text", F.lit('"'), F.lit("")), " ").alias("words"),
                              F.array(F.concat(F.lit('"'), "source", F.lit('"'))).alias("sources"),
                              F.array("lang").alias("langs"))
    return selection.triples(docs, b.document_labels(t), {"word": "words", "source": "sources", "lang": "langs"})


# Vocabulary of part names ordered by how many parts carry them, and encodings against it.
_BASKET_SQL = """
 SELECT l_orderkey AS entity, p_name AS item FROM lineitem JOIN part ON l_partkey = p_partkey"""
_VOCAB_SQL = """
 SELECT item, CAST(idx AS INT) AS idx FROM (
  SELECT p_name AS item, row_number() OVER (ORDER BY COUNT(*) DESC, p_name) AS idx FROM part GROUP BY p_name) AS v
 WHERE idx <= 512"""
_TAGS_SQL = """
 SELECT DISTINCT p_name AS item, CAST(p_size AS INT) AS tag FROM part"""
_DIM = 512


def _basket(t: Tables) -> DataFrame:
    return (spread(t.lineitem.select(F.col("l_orderkey").alias("entity"), "l_partkey"))
            .join(t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("item")), "l_partkey")
            .select("entity", "item"))


def _part_vocab(t: Tables) -> DataFrame:
    ranked = t.part.groupBy(F.col("p_name").alias("item")).agg(F.count("*").alias("n"))
    return vocab.top_by_order(ranked, _DIM, F.desc("n"), "item").select("item", F.col("idx").cast("int").alias("idx"))


def _part_tags(t: Tables) -> DataFrame:
    return (t.part.groupBy(F.col("p_name").alias("item"))
            .agg(F.array_sort(F.collect_set("p_size")).alias("tags")))


@query(f"SELECT DISTINCT entity, idx, 1e0 AS val FROM ({_BASKET_SQL}) AS x JOIN ({_VOCAB_SQL}) AS v USING (item)")
def f8_onehot(t: Tables) -> DataFrame:
    return vocab.encode_long(_basket(t), _part_vocab(t), "binary", rows=_DIM)


@query(f"""
SELECT entity, string_agg(idx || ':1', ' ' ORDER BY idx) AS features FROM (
 SELECT DISTINCT entity, idx FROM ({_BASKET_SQL}) AS x JOIN ({_VOCAB_SQL}) AS v USING (item)) AS d GROUP BY entity""")
def f8_onehot_lines(t: Tables) -> DataFrame:
    vectors = vocab.encode(_basket(t), _part_vocab(t), "binary", rows=_DIM)
    lines = libsvm.to_lines(vectors, "entity", sep="\t")
    return lines.select(F.substring_index("value", "\t", 1).cast("bigint").alias("entity"),
                        F.substring_index("value", "\t", -1).alias("features"))


@query(f"SELECT entity, idx, CAST(COUNT(*) AS DOUBLE) AS val FROM ({_BASKET_SQL}) AS x JOIN ({_VOCAB_SQL}) AS v USING (item) GROUP BY 1, 2")
def f10_count_encode(t: Tables) -> DataFrame:
    return vocab.encode_long(_basket(t), _part_vocab(t), "count", rows=_DIM)


_TAGGED_SQL = f"""
 SELECT entity, idx FROM ({_BASKET_SQL}) AS x JOIN ({_VOCAB_SQL}) AS v USING (item)
 UNION ALL SELECT entity, tag + {_DIM + 1} FROM ({_BASKET_SQL}) AS x JOIN ({_TAGS_SQL}) AS g USING (item)"""


@query(f"SELECT DISTINCT entity, idx, 1e0 AS val FROM ({_TAGGED_SQL}) AS u")
def f11_tag_encode(t: Tables) -> DataFrame:
    return vocab.encode_with_tags_long(_basket(t), _part_vocab(t), _part_tags(t), _DIM, "binary", rows=_DIM)


@query(f"SELECT entity, idx, CAST(COUNT(*) AS DOUBLE) AS val FROM ({_TAGGED_SQL}) AS u GROUP BY 1, 2")
def f12_tag_count_encode(t: Tables) -> DataFrame:
    return vocab.encode_with_tags_long(_basket(t), _part_vocab(t), _part_tags(t), _DIM, "count", rows=_DIM)


@query(f"SELECT x.entity, g.tag AS idx FROM ({_BASKET_SQL}) AS x JOIN ({_TAGS_SQL}) AS g USING (item)")
def j5_tag_expand(t: Tables) -> DataFrame:
    return vocab.expand_tags(_basket(t), _part_tags(t))


@query("""
WITH tags AS (SELECT DISTINCT p_name AS item, p_type AS tag FROM part),
schema AS (SELECT tag, row_number() OVER (ORDER BY tag) AS idx FROM (SELECT DISTINCT tag FROM tags) AS d)
SELECT item, idx FROM tags JOIN schema USING (tag)""")
def j5_tag_schema(t: Tables) -> DataFrame:
    """Text tags get indices of their own, then items carry them."""
    tags = t.part.select(F.col("p_name").alias("item"), F.col("p_type").alias("tag")).distinct()
    return vocab.index_tags(tags, 1)[1]


@query("""
WITH words AS (SELECT conv_id * 1000 + turn AS entity, unnest(string_split(text, ' ')) AS item FROM conversations),
vocab AS (SELECT item, row_number() OVER (ORDER BY item) AS idx FROM (SELECT DISTINCT item FROM words) AS d)
SELECT entity, idx, CAST(COUNT(*) AS DOUBLE) AS val FROM words JOIN vocab USING (item) GROUP BY 1, 2""")
def a16_within_row_counts(t: Tables) -> DataFrame:
    turns = t.conversations.withColumn("entity", F.col("conv_id") * 1000 + F.col("turn"))
    words = unnest(turns, F.split("text", " "), "entity")
    return vocab.encode_long(words, vocab.build(words, 1), "count")


# Sparse vectors as text.
_ORDER_BAG_SQL = f"SELECT entity, item, COUNT(*) AS cnt FROM ({_BASKET_SQL}) AS x GROUP BY 1, 2"


@query(f"""
WITH bag AS ({_ORDER_BAG_SQL}),
vocab AS (SELECT item, row_number() OVER (ORDER BY item) AS idx FROM (SELECT DISTINCT item FROM bag) AS d)
SELECT entity AS id, CASE WHEN o_totalprice >= 200000 THEN 1 ELSE 0 END AS label, idx, CAST(cnt AS DOUBLE) AS val
FROM bag JOIN vocab USING (item) JOIN orders ON o_orderkey = entity""")
def f13_libsvm_build(t: Tables) -> DataFrame:
    text = bags.to_text(bags.count_items(_basket(t)), "bag")
    rows = text.join(t.orders.select(F.col("o_orderkey").alias("entity"),
                                     F.when(F.col("o_totalprice") >= 200000, 1).otherwise(0).alias("label")), "entity")
    return libsvm.build(rows.withColumnRenamed("entity", "id"))[1]


_VECTOR_SQL = f"""
 SELECT entity, CASE WHEN o_totalprice >= 200000 THEN 1e0 ELSE 0e0 END AS label, idx - 1 AS idx, val FROM (
  SELECT entity, idx, CAST(COUNT(*) AS DOUBLE) AS val FROM ({_BASKET_SQL}) AS x JOIN ({_VOCAB_SQL}) AS v USING (item)
  GROUP BY 1, 2) AS e JOIN orders ON o_orderkey = entity"""


def _vectors(t: Tables) -> DataFrame:
    encoded = vocab.encode(_basket(t), _part_vocab(t), "count", rows=_DIM)
    labels = t.orders.select(F.col("o_orderkey").alias("entity"),
                             F.when(F.col("o_totalprice") >= 200000, 1).otherwise(0).alias("label"))
    return encoded.join(labels, "entity")


def _entries(parsed: DataFrame, *keys: str) -> DataFrame:
    pairs = parsed.select(*keys, F.explode(F.arrays_zip("idxs", "vals")).alias("p"))
    return pairs.select(*keys, F.col("p.idxs").alias("idx"), F.col("p.vals").alias("val"))


@query(f"SELECT label, idx, SUM(val) AS val FROM ({_VECTOR_SQL}) AS v GROUP BY 1, 2")
def f14_libsvm_labelled(t: Tables) -> DataFrame:
    """Written as labelled lines, parsed back, summed per label and index."""
    parsed = libsvm.parse_labelled(libsvm.to_lines(_vectors(t), "label"))
    return _entries(parsed, "label").groupBy("label", "idx").agg(F.sum("val").alias("val"))


@query(f"SELECT CAST(entity AS VARCHAR) AS entity, idx, val FROM ({_VECTOR_SQL}) AS v")
def f15_libsvm_keyed(t: Tables) -> DataFrame:
    return _entries(libsvm.parse_keyed(libsvm.to_lines(_vectors(t), "entity")), "entity")


@query(f"SELECT label, CAST(entity AS VARCHAR) AS entity, idx, val FROM ({_VECTOR_SQL}) AS v")
def f16_libsvm_labelled_keyed(t: Tables) -> DataFrame:
    lines = libsvm.to_lines(_vectors(t), "label", "entity", sep="\t")
    return _entries(libsvm.parse_labelled_keyed(lines), "label", "entity")


@query(f"SELECT CAST(MAX(idx) + 1 AS INT) AS num_features FROM ({_VECTOR_SQL}) AS v")
def a19_max_index(t: Tables) -> DataFrame:
    return libsvm.num_features(libsvm.parse_keyed(libsvm.to_lines(_vectors(t), "entity")))


# Hashes and fingerprints. The SQL folds the UTF-16 units of a text into the hash.
def _hash_sql(text: str, bits: int, basis: int, prime: int, variant: str) -> str:
    modulus = 1 << bits
    units = (f"flatten(list_transform(regexp_extract_all({text}, '(?s).'), lambda c: CASE WHEN unicode(c) > 65535 "
             "THEN [55296 + (unicode(c) - 65536) // 1024, 56320 + (unicode(c) - 65536) % 1024] "
             "ELSE [unicode(c)] END))")
    start = f"list_prepend(CAST({basis} AS HUGEINT), list_transform({units}, lambda u: CAST(u AS HUGEINT)))"
    step = (f"(xor(h, u) * {prime}::HUGEINT) % {modulus}::HUGEINT" if variant == "1a"
            else f"xor((h * {prime}::HUGEINT) % {modulus}::HUGEINT, u)")
    return f"list_reduce({start}, lambda h, u: {step})"


_FNV_NAMES = "SELECT DISTINCT p_name AS item FROM part UNION SELECT DISTINCT lang FROM documents"


@query(f"SELECT item, lpad(lower(hex(CAST({_hash_sql('item', 32, 2166136261, 16777619, '1')} AS BIGINT))), 8, '0') AS hash "
       f"FROM ({_FNV_NAMES}) AS n")
def f3_fnv1(t: Tables) -> DataFrame:
    items = t.part.select(F.col("p_name").alias("item")).union(t.documents.select("lang")).distinct()
    return items.select("item", F.lower(F.hex(fnv("item", 32, "1"))).alias("hash"))


@query("WITH w AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS item FROM documents) "
       f"SELECT item, CAST({_hash_sql('item', 64, 14695981039346656037, 1099511628211, '1a')} AS VARCHAR) AS hash FROM w")
def f4_fnv1a(t: Tables) -> DataFrame:
    words = b.document_words(t).select("item").distinct()
    digits = F.hex(fnv("item", 64, "1a"))
    return words.select("item", F.conv(digits, 16, 10).alias("hash"))


def _limbs_sql(text: str, bits: int, variant: str) -> str:
    """The hash as a list of 32-bit limbs, lowest first: after each unit limbs are multiplied and pass their
    excess on once, at the end until none is left."""
    prime, start, count, mask = FNV_PRIMES[bits], FNV_STARTS[bits], bits // 32, (1 << 32) - 1
    power = prime.bit_length() - 1
    skip, shift = divmod(power, 32)
    units = (f"flatten(list_transform(regexp_extract_all({text}, '(?s).'), lambda c: CASE WHEN unicode(c) > 65535 "
             "THEN [55296 + (unicode(c) - 65536) // 1024, 56320 + (unicode(c) - 65536) % 1024] ELSE [unicode(c)] END))")
    first = ", ".join(str(start >> 32 * i & mask) for i in range(count))
    states = f"list_prepend([{first}]::BIGINT[], list_transform({units}, lambda u: [u]::BIGINT[]))"

    def limb(i: int) -> str:
        return "xor(h[1], u[1])" if i == 0 and variant == "1a" else f"h[{i + 1}]"

    def product(i: int) -> str:
        parts = [f"{limb(i)} * {prime - (1 << power)}"]
        if i >= skip:
            parts.append(f"(({limb(i - skip)} << {shift}) & {mask})")
        if i > skip:
            parts.append(f"({limb(i - skip - 1)} >> {32 - shift})")
        return f"({' + '.join(parts)})"

    def passed(item, i: int) -> str:
        return f"({item(i)} & {mask})" + (f" + ({item(i - 1)} >> 32)" if i else "")

    step = [passed(product, i) for i in range(count)]
    if variant == "1":
        step[0] = f"xor({step[0]}, u[1])"
    folded = f"list_reduce({states}, lambda h, u: [{', '.join(step)}]::BIGINT[])"
    once = ", ".join(passed(lambda k: f"h[{k + 1}]", i) for i in range(count))
    return f"list_reduce(list_prepend({folded}, list_transform(range({count}), lambda x: [x]::BIGINT[])), lambda h, u: [{once}]::BIGINT[])"


def _hex_sql(limbs: str) -> str:
    return f"array_to_string(list_reverse(list_transform({limbs}, lambda x: lpad(lower(hex(x)), 8, '0'))), '')"


_WIDE = (128, 256, 512, 1024)


@query("SELECT item, " + ", ".join(f"{_hex_sql(_limbs_sql('item', n, '1'))} AS hash{n}" for n in _WIDE) + f" FROM ({_FNV_NAMES}) AS n")
def f3_fnv1_wide(t: Tables) -> DataFrame:
    items = t.part.select(F.col("p_name").alias("item")).union(t.documents.select("lang")).distinct()
    return items.select("item", *[F.lower(F.hex(fnv("item", n, "1"))).alias(f"hash{n}") for n in _WIDE])


@query("WITH w AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS item FROM documents) SELECT item, "
       + ", ".join(f"{_hex_sql(_limbs_sql('item', n, '1a'))} AS hash{n}" for n in _WIDE) + " FROM w")
def f4_fnv1a_wide(t: Tables) -> DataFrame:
    words = b.document_words(t).select("item").distinct()
    return words.select("item", *[F.lower(F.hex(fnv("item", n, "1a"))).alias(f"hash{n}") for n in _WIDE])


def _simhash_sql(tokens: str, bits: int = 64) -> str:
    return f"""
tokens AS ({tokens}),
hashed AS (SELECT token, {_limbs_sql('token', bits, '1a')} AS h
           FROM (SELECT DISTINCT token FROM tokens WHERE token IS NOT NULL) AS d),
weights AS (SELECT entity, token, SUM(weight) AS weight FROM tokens GROUP BY 1, 2),
bits AS (SELECT entity, i, SUM(CASE WHEN h IS NULL THEN 0 WHEN (h[i // 32 + 1] >> (i % 32)) & 1 = 1
                               THEN weight ELSE -weight END) AS s
         FROM weights LEFT JOIN hashed USING (token), (SELECT CAST(i AS INT) AS i FROM range({bits}) AS r(i)) AS places GROUP BY 1, 2),
prints AS (SELECT entity, string_agg(CASE WHEN s >= 0 THEN '1' ELSE '0' END, '' ORDER BY i) AS bits
           FROM bits GROUP BY entity)"""


_DOC_TOKENS_SQL = ("SELECT doc_id AS entity, token, CAST(COUNT(*) AS DOUBLE) AS weight FROM "
                   "(SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents) AS w GROUP BY 1, 2")


def _document_prints(t: Tables) -> DataFrame:
    tokens = unnest(b.texts(t), F.split("text", " "), "entity", name="token")
    return simhash.simhash(tokens, 64, uniform=1.0)


@query("WITH " + _simhash_sql(_DOC_TOKENS_SQL) + " SELECT entity, bits FROM prints")
def f5_simhash_documents(t: Tables) -> DataFrame:
    return _document_prints(t)


@query("WITH " + _simhash_sql(_DOC_TOKENS_SQL) + """
SELECT entity, string_agg(CAST(i + 1 AS VARCHAR), ',' ORDER BY i) AS idxs
FROM prints, range(64) AS r(i) WHERE bits[i + 1] = '1' GROUP BY entity""")
def f9_bits_to_indices(t: Tables) -> DataFrame:
    found = simhash.to_indices(_document_prints(t), 1)
    return found.filter(F.size("idxs") > 0).select("entity", F.array_join("idxs", ",").alias("idxs"))


def _activity_records(t: Tables) -> DataFrame:
    return sessions.to_records(b.packages(t))


def _app_weights(t: Tables) -> DataFrame:
    """Weight of an app: its share of the turns of all known apps but one that stays unknown."""
    apps = t.conversations.groupBy("role").agg(F.count("*").alias("n"))
    return apps.select(F.concat(F.lit("app."), "role").alias("app"), (F.col("n") % 17 / F.lit(16.0)).alias("weight"))


def _activity_sql(bits: int) -> str:
    return f"""
WITH act AS ({b.ACTIVITIES_SQL}),
kept AS (SELECT entity, time FROM (
   SELECT entity, time, row_number() OVER (PARTITION BY entity ORDER BY time) AS rn
   FROM (SELECT DISTINCT entity, time FROM act WHERE role <> 'system') AS d) AS k WHERE rn <= 20),
wt AS (SELECT role, (COUNT(*) % 17) / 16e0 AS weight FROM conversations GROUP BY role),
""" + _simhash_sql("""SELECT DISTINCT entity, time, token, weight FROM (
   SELECT entity, time, role, name AS token FROM act UNION ALL SELECT entity, time, role, refer FROM act WHERE refer IS NOT NULL) AS u
   JOIN kept USING (entity, time) JOIN wt USING (role)""", bits)


def _positions_sql(bits: int) -> str:
    return _activity_sql(bits) + f"""
SELECT entity, COALESCE((SELECT string_agg(CAST(i + 1 AS VARCHAR), ' ' ORDER BY i) FROM range({bits}) AS r(i)
                         WHERE bits[CAST(i AS INT) + 1] = '1'), '') AS idxs FROM prints"""


@query(_activity_sql(64) + " SELECT entity, bits FROM prints")
def f6_activity_fingerprint_64(t: Tables) -> DataFrame:
    tokens = simhash.activity_tokens(_activity_records(t), _app_weights(t), ["time"], sessions.RECORDS_PER_ENTITY)
    return simhash.simhash(tokens, 64)


@query(_positions_sql(128))
def f6_activity_fingerprint(t: Tables) -> DataFrame:
    """128 bits, as set-bit positions from 1."""
    found = simhash.activity(_activity_records(t), _app_weights(t), 128, 1)
    return found.select("entity", F.array_join("idxs", " ").alias("idxs"))


@query(_positions_sql(256))
def f7_activity_fingerprint_256(t: Tables) -> DataFrame:
    """256 bits, as set-bit positions from 1."""
    found = simhash.activity(_activity_records(t), _app_weights(t), 256, 1)
    return found.select("entity", F.array_join("idxs", " ").alias("idxs"))


@query(f"WITH act AS ({b.ACTIVITIES_SQL}) SELECT entity, name, start, duration, refer FROM act")
def f18_session_explode(t: Tables) -> DataFrame:
    rows = sessions.explode(b.packages(t))
    return rows.select("entity", "name", "start", F.col("duration").cast("bigint").alias("duration"), "refer")


@query(f"""
WITH act AS ({b.ACTIVITIES_SQL})
SELECT entity, 'app.' || role AS app, time, string_agg(name || ':' || start, ' ' ORDER BY start) AS activities
FROM act WHERE role <> 'system' GROUP BY 1, 2, 3""")
def p3_filter_valid(t: Tables) -> DataFrame:
    """Every record that stays, with the names and starts of its activities."""
    listed = F.transform("activities", lambda a: F.concat_ws(":", a["name"], a["start"].cast("string")))
    return _activity_records(t).select("entity", "app", "time", F.array_join(listed, " ").alias("activities"))


@query("""
SELECT conv_id AS entity, role AS app, turn AS time, array_to_string(list_sort(list_distinct(list_filter(
  string_split(replace(text, ',', ';'), ' '), lambda x: x <> ''))), ',') AS ids
FROM conversations WHERE len(list_filter(string_split(text, ' '), lambda x: x <> '')) > 0""")
def f19_event_ids(t: Tables) -> DataFrame:
    """The ids of every record, put in order for the comparison."""
    events = F.transform(F.split("text", " "), lambda w: F.struct(F.when(w != "", w).alias("id")))
    records = t.conversations.select(F.col("conv_id").alias("entity"), F.col("role").alias("app"),
                                     F.col("turn").alias("time"), events.alias("events"))
    # Commas inside an id would split it again, so they are replaced first.
    safe = records.withColumn("events", F.transform("events", lambda e: F.struct(
        F.replace(e["id"], F.lit(","), F.lit(";")).alias("id"))))
    ids = sessions.event_ids(safe, keep=("entity", "app", "time"))
    return ids.select("entity", "app", "time", F.array_join(F.array_sort(F.split("ids", ",")), ",").alias("ids"))


@query(f"""
WITH act AS ({b.ACTIVITIES_SQL}),
a AS (SELECT DISTINCT entity, 'app.' || role AS app, time, regexp_replace(regexp_replace(name, '^"', ''), '"$', '') AS name, start,
 regexp_replace(regexp_replace(refer, '^"', ''), '"$', '') AS refer FROM act WHERE role <> 'system'),
r AS (SELECT entity, app, time, string_agg(name || ':' || start || ':' || COALESCE(refer, '-'), ' ' ORDER BY start) AS listed FROM a GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY time, app) AS place FROM r)
SELECT entity, string_agg(app || '@' || time || '=' || listed, '|' ORDER BY place) AS records FROM k WHERE place <= 20 GROUP BY 1""")
def p3_nested_records(t: Tables) -> DataFrame:
    """The first twenty records of each entity as one row, written out for the comparison."""
    def listed(a: Column) -> Column:
        return F.concat_ws(":", a["name"], a["start"].cast("string"), F.coalesce(a["refer"], F.lit("-")))

    nested = sessions.nest(_activity_records(t))
    records = F.transform("records", lambda r: F.concat(
        r["app"], F.lit("@"), r["time"].cast("string"), F.lit("="), F.array_join(F.transform(r["activities"], listed), " ")))
    return nested.select("entity", F.array_join(records, "|").alias("records"))

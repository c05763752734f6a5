"""URL filter: per-host path templates with smoothed purity over rules. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import staged

# (verdict, host, path): a rule fits its host and all subdomains if the path starts with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# A segment stays literal with this many urls and this share of its parent's; else it becomes a wildcard.
# A node with fewer urls is not divided further: the rest of its paths is variable.
LEAST_URLS, LEAST_PERCENT = 5, 2
# Branches within this many standard errors of their parent's block share are merged.
ERRORS = 2.0
PRIOR, PURITY = 1.0, 0.7
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: str | Column) -> tuple[Column, Column]:
    """Host and path; null or without ``://``: both empty."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.position(F.lit("://"), url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _best_rule(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (F.endswith(F.concat(F.lit("."), F.col("host")), F.lit("." + host))) & F.startswith("path", F.lit(path))
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _grown(rows: DataFrame, least_urls: int, least_percent: int) -> DataFrame:
    """Every row with its ``template``. One level a round, on the rows whose paths go on, until no node is divided."""
    done, level = [], 0
    rows = staged(rows.withColumn("template", F.lit("")).withColumn("open", F.size("seg") > 0), "level")
    while True:
        done.append(rows.filter(~F.col("open")).drop("seg", "open"))
        rows = rows.filter("open").withColumn("piece", F.get("seg", F.lit(level)))
        if rows.isEmpty():
            break
        node = ["host", "template"]
        parents = rows.groupBy(*node).agg(F.count("*").alias("total")).filter(F.col("total") >= least_urls)
        children = rows.groupBy(*node, "piece").agg(F.count("*").alias("n")).filter(F.col("n") >= least_urls)
        literal = (children.join(parents, node).filter(F.col("n") * 100 >= F.col("total") * least_percent)
                   .select(*node, "piece", F.lit(True).alias("literal")))
        divided = parents.select(*node, F.lit(True).alias("divided"))
        step = F.when(F.col("divided").isNull(), F.lit("**")).when(F.col("literal"), F.col("piece")).otherwise(F.lit("*"))
        rows = rows.join(divided, node, "left").join(literal, [*node, "piece"], "left").select(
            "page_id", "host", "path", "rule", "ruled", "seg", F.concat("template", F.lit("/"), step).alias("template"),
            (F.col("divided").isNotNull() & (F.size("seg") > level + 1)).alias("open"))
        rows, level = staged(rows, "level"), level + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _merged(leaves: DataFrame, errors: float) -> DataFrame:
    """``host, template, branch, merged, b, l``: the branch of each leaf, from the deepest level to the root.

    At each level the nodes below one parent are compared with all of them
    together. A node that stands apart is a branch of its own; the others are one
    branch. A parent below which nothing stands apart is one node of the next level.
    """
    leaves = leaves.withColumns({"branch": F.lit(None).cast("string"), "merged": F.lit(False)})
    deepest = leaves.agg(F.max(F.size(F.split("template", "/")))).first()[0]
    for depth in range((deepest or 1) - 1, 0, -1):
        play = F.size(F.split("template", "/")) > depth
        node, parent = (F.when(play, F.substring_index("template", "/", k)) for k in (depth + 1, depth))
        leaves = leaves.withColumns({"node": node, "parent": parent})
        free = F.col("branch").isNull()
        # At most 100 / LEAST_PERCENT literal segments and two wildcards stand below a parent.
        nodes = leaves.filter("node IS NOT NULL").groupBy("host", "parent", "node").agg(
            F.sum(F.when(free, F.col("n"))).alias("nn"), F.sum(F.when(free, F.col("b"))).alias("nb"),
            F.bool_or(~free).alias("stuck"))
        below = Window.partitionBy("host", "parent")
        share = F.sum("nb").over(below) / F.sum("nn").over(below)
        nodes = nodes.select("host", "parent", "node", "nn", "nb", F.bool_or("stuck").over(below).alias("stuck"), share.alias("share"))
        apart = F.abs(F.col("nb") - F.col("nn") * F.col("share")) > errors * F.sqrt(F.col("nn") * F.col("share") * (1 - F.col("share")))
        nodes = nodes.withColumn("apart", F.coalesce(apart, F.lit(False)))
        nodes = nodes.select("host", "parent", "node", "apart", (F.col("stuck") | F.bool_or("apart").over(below)).alias("stays"))
        joined = leaves.join(nodes, ["host", "parent", "node"], "left")
        branch = F.coalesce("branch", F.when(F.col("apart"), F.col("node")).when(F.col("stays"), F.col("parent")))
        merged = F.when(free, F.coalesce(F.col("stays") & ~F.col("apart"), F.lit(False))).otherwise(F.col("merged"))
        leaves = staged(joined.select("host", "template", "n", "b", "l", branch.alias("branch"), merged.alias("merged")), "branches")
    return leaves.select("host", "template", "b", "l", F.coalesce("branch", F.lit("")).alias("branch"),
                         (F.col("merged") | F.col("branch").isNull()).alias("merged"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, least_urls: int = LEAST_URLS,
          least_percent: int = LEAST_PERCENT, errors: float = ERRORS, prior: float = PRIOR, purity: float = PURITY) -> DataFrame:
    """``page_id, host, path, rule, verdict, template`` of every row.

    Where a rule fits, the longest one decides; the rules' verdicts are also the
    labels. Per host a tree of path templates is grown level by level, as deep as
    nodes hold ``least_urls``: a segment stays literal if it holds enough urls,
    else it is a wildcard. Branches whose block share does not differ beyond chance
    are merged, from the deepest level up to the host. A branch is rejected if
    ``(blocked + prior) / (labelled + 2 * prior)`` reaches ``purity``; branches
    without labels are allowed. Null urls have an empty host and path. Repeated
    rows count each time and give one row each; an empty table gives none; a segment
    spelled like a wildcard counts as one; columns
    beyond ``page_id`` and ``url`` are not read. Rounds follow the depth to which
    ``least_urls`` urls share a template, not the longest path. All steps are sums
    per node, taken map-side first; the join keys of crowded nodes are split by Spark.
    """
    host, path = split_url("url")
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    name, verdict = _best_rule(rules)
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = _grown(rows.withColumn("rule", name).withColumn("ruled", verdict).withColumn("seg", segments), least_urls, least_percent)
    blocked, labelled = F.count_if(F.col("ruled") == "block"), F.count("ruled")
    leaves = staged(rows.groupBy("host", "template").agg(F.count("*").alias("n"), blocked.alias("b"), labelled.alias("l")), "leaves")
    branch = _merged(leaves, errors)
    keys = ["host", "branch", "merged"]
    pure = branch.groupBy(*keys).agg(F.sum("b").alias("b"), F.sum("l").alias("l")).select(
        *keys, ((F.col("b") + prior) / (F.col("l") + 2 * prior) >= purity).alias("rejected"))
    judged = branch.join(pure, keys).select("host", "template", "rejected")
    method = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(judged, ["host", "template"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template")


def sql(rules: Sequence[tuple[str, str, str]] = RULES, least_urls: int = LEAST_URLS,
        least_percent: int = LEAST_PERCENT, errors: float = ERRORS, prior: float = PRIOR, purity: float = PURITY) -> str:
    """The same for DuckDB."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [f"WHEN ends_with('.' || host, '.{h}') AND starts_with(path, '{p}') THEN" for _, h, p in ordered]
    name = "CASE " + " ".join(f"{f} '{h + p}'" for f, (_, h, p) in zip(fits, ordered, strict=True)) + " END"
    verdict = "CASE " + " ".join(f"{f} '{k}'" for f, (k, _, _) in zip(fits, ordered, strict=True)) + " END"
    return f"""
WITH RECURSIVE u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
t AS (SELECT 0 AS level, page_id, host, path, {name} AS rule, {verdict} AS ruled,
   list_filter(string_split(path, '/'), lambda s: s <> '') AS seg, '' AS template,
   len(list_filter(string_split(path, '/'), lambda s: s <> '')) > 0 AS unfinished FROM h
 UNION ALL SELECT level + 1, page_id, host, path, rule, ruled, seg,
   template || CASE WHEN total < {least_urls} THEN '/**'
     WHEN n >= {least_urls} AND n * 100 >= total * {least_percent} THEN '/' || seg[level + 1] ELSE '/*' END,
   total >= {least_urls} AND len(seg) > level + 1
 FROM (SELECT *, count(*) OVER (PARTITION BY host, template, seg[level + 1]) AS n,
   count(*) OVER (PARTITION BY host, template) AS total FROM t WHERE unfinished) AS c),
done AS (SELECT * FROM t WHERE NOT unfinished),
leaf AS (SELECT host, template, count(*) AS n, count(*) FILTER (ruled = 'block') AS b, count(ruled) AS l,
  len(string_split(template, '/')) - 1 AS deep FROM done GROUP BY host, template),
m AS (SELECT (SELECT max(deep) FROM leaf) AS depth, host, template, n, b, l, deep, CAST(NULL AS VARCHAR) AS branch, false AS merged FROM leaf
 UNION ALL SELECT depth - 1, host, template, n, b, l, deep,
   CASE WHEN branch IS NOT NULL OR deep < depth THEN branch WHEN apart THEN node WHEN stays THEN parent END,
   CASE WHEN branch IS NOT NULL OR deep < depth THEN merged ELSE stays AND NOT apart END
 FROM (SELECT *, coalesce(bool_or(stuck OR apart) OVER (PARTITION BY host, deep >= depth, parent), false) AS stays
  FROM (SELECT *, coalesce(abs(nb - nn * share) > {errors} * sqrt(nn * share * (1 - share)), false) AS apart
   FROM (SELECT *, sum(n) FILTER (branch IS NULL) OVER (PARTITION BY host, deep >= depth, node) AS nn,
      sum(b) FILTER (branch IS NULL) OVER (PARTITION BY host, deep >= depth, node) AS nb, branch IS NOT NULL AS stuck,
      CAST(sum(b) FILTER (branch IS NULL) OVER (PARTITION BY host, deep >= depth, parent) AS DOUBLE)
      / CAST(sum(n) FILTER (branch IS NULL) OVER (PARTITION BY host, deep >= depth, parent) AS DOUBLE) AS share
    FROM (SELECT *, array_to_string(string_split(template, '/')[:depth + 1], '/') AS node,
       array_to_string(string_split(template, '/')[:depth], '/') AS parent FROM m WHERE depth > 0) AS a) AS s) AS p) AS q),
br AS (SELECT host, template, b, l, coalesce(branch, '') AS branch, merged OR branch IS NULL AS merged FROM m WHERE depth = 0),
j AS (SELECT host, template, (sum(b) OVER w + {prior}) / (sum(l) OVER w + {2 * prior}) >= {purity} AS rejected
  FROM br WINDOW w AS (PARTITION BY host, branch, merged))
SELECT page_id, t.host, path, rule, coalesce(ruled, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM done t LEFT JOIN j ON t.host = j.host AND t.template = j.template"""

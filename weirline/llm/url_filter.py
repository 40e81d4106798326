"""URL rules by a sort-merge range join (DataFrame functions only).

A rule is (host, path prefix, verdict); it fits its host and all subdomains. A URL is probed once
per suffix of its host: the probe's key is the suffix, labels reversed, then the path, so every rule
is an interval of keys, [key, key + any ending], and intervals nest or are disjoint. Rules and probes
are range-partitioned and sorted together; each probe takes the last rule at or before it, and with
it that rule's stack: the rules that enclose it. The deepest of that stack which is a prefix of the
probe's key is the longest rule for that suffix. A partition's opening rule is carried in from the
partitions before it. Equal keys are spread by row number, so a hot URL is not one task.

Defined results: null or malformed URL (no `://`): host and path empty, no rule. Of fitting rules the
longest by host + path wins, then the longer host, then block over allow. Repeated rules count once; a rule with a null host, path or verdict is none.
An empty rule table gives the default verdict to all. Only the id and url columns are read. The
number of probes of a URL is its host's number of labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import LOWER, UPPER, col, materialize

#: The rules of the registered query: host, path, verdict (fixed values).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to / ? # or end, A-Z lower-cased. Path: then up to ? # or end."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_key(host: Column, path: Column) -> Column:
    """Labels reversed, then a low separator and the path."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("\x01"), path)


def _with_stacks(rules: DataFrame) -> DataFrame:
    """Distinct rules with the stack of rules that enclose each, itself included, longest key first."""
    best = F.max(F.struct((F.col("verdict") == "block").alias("first"), F.col("verdict").alias("verdict"))).getField("verdict")
    rules = rules.filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    r = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").withColumn("key", rule_key(F.col("host"), F.col("path"))).groupBy("key", "host", "path").agg(best.alias("verdict"))
    # Every prefix of a rule's key, longest first, looked up among the keys: as many as its length.
    ends = r.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select("key", F.expr("substring(key, 1, n)").alias("outer"))
    item = r.select(F.col("key").alias("outer"), F.struct(F.length("key").alias("len"), "key", "host", "path", "verdict").alias("item"))
    stacks = ends.join(item, "outer").groupBy("key").agg(F.sort_array(F.collect_list("item"), asc=False).alias("stack"))
    return stacks


def url_filter(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", partitions: int | None = None) -> DataFrame:
    """One row per row of urls: id_col, host, path, rule (host + path, or null), verdict."""
    spark = urls.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = split_url(col(url_col))
    pages = materialize(urls.select(F.monotonically_increasing_id().alias("row"), col(id_col).alias("id"), host.alias("host"), path.alias("path")), "pages")
    stacks = materialize(_with_stacks(rules), "rules")
    labels = F.split("host", r"\.")
    probes = pages.select("row", "host", "path", F.posexplode(labels)).select("row", rule_key(F.expr("array_join(slice(split(host, '[.]'), pos + 1, size(split(host, '[.]'))), '.')"), F.col("path")).alias("key"))
    events = stacks.select("key", F.lit(-1).cast("long").alias("row"), "stack").unionByName(probes.select("key", "row", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack")))
    # The range exchange is cut off by a written table, so that its partition numbers are facts.
    dealt = materialize(events.repartitionByRange(n, "key", "row").withColumn("part", F.spark_partition_id()), "sweep")
    sweep = W.partitionBy("part").orderBy("key", "row").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = dealt.withColumn("active", F.last("stack", ignorenulls=True).over(sweep))
    # The last rule of each part, then of all parts before it: as many rows as parts.
    closing = dealt.filter("stack IS NOT NULL").groupBy("part").agg(F.max_by("stack", "key").alias("closing"))
    carry = spark.range(n).select(F.col("id").cast("int").alias("part")).join(closing, "part", "left").withColumn("carried", F.last("closing", ignorenulls=True).over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))).select("part", "carried")
    probed = inside.filter("row >= 0").join(F.broadcast(carry), "part", "left").withColumn("active", F.coalesce("active", "carried"))
    order = lambda x: F.struct((F.length(x["host"]) + F.length(x["path"])).alias("len"), F.length(x["host"]).alias("host_len"), (x["verdict"] == "block").alias("first"), F.concat(x["host"], x["path"]).alias("rule"), x["verdict"].alias("verdict"))
    found = probed.withColumn("fit", F.try_element_at(F.filter("active", lambda x: F.col("key").startswith(x["key"])), F.lit(1))).filter("fit IS NOT NULL").groupBy("row").agg(F.max(order(F.col("fit"))).alias("won"))
    return pages.join(found, "row", "left").select(F.col("id").alias(id_col), "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict"))


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    """Query: every url of pages against the five registered rules; no rule: allow."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), rules)


OP10_SQL = r"""
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
f AS (SELECT p.page_id, p.host, p.path, x.host || x.path AS rule, x.verdict,
             row_number() OVER (PARTITION BY p.page_id ORDER BY length(x.host || x.path) DESC NULLS LAST, length(x.host) DESC, x.verdict DESC) AS k
      FROM p LEFT JOIN rules x ON (p.host = x.host OR ends_with(p.host, '.' || x.host)) AND starts_with(p.path, x.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE k = 1"""

"""URL filters: host suffixes and path prefixes of each URL, joined to rules by short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import free_name, lower_ascii

#: Hex digits of the SHA-256 digest that the join compares first.
PREFIX = 8
#: Copies of each rule, so that an expression that most URLs share is dealt over as many tasks.
SALTS = 16
#: Different lengths of rule paths that are listed in the plan; beyond, each prefix of a path is looked up.
LENGTHS = 256
RULES = "host string, path string, verdict string"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return lower_ascii(host), path


def _host_suffixes(host: Column, most: int) -> Column:
    """The host and what follows each of its dots, as far as a rule can be so long."""
    labels = F.split(host, r"\.", -1)
    count = F.size(labels)
    return F.filter(
        F.transform(
            F.sequence(F.greatest(F.lit(1), count - most), count), lambda i: F.array_join(F.slice(labels, i, count), ".")),
        lambda h: (h != "") & (F.length(h) <= most))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """Adds host, path, rule (host and path of the rule that decides, else null) and verdict.

    A rule fits its host and all subdomains if the URL's path starts with the rule's path. Of the
    rules that fit, the longest (host and path together) decides; of equally long ones that with the
    longer host, then the verdict first by name. No rule: `default`.

    Each URL is expanded into host suffixes times path prefixes; prefixes are cut where a rule's path
    can end, so their number is bounded by the distinct lengths of rule paths, not by the URL; if rule paths
    have more than `LENGTHS` lengths, each prefix of at most the longest rule's length is looked up.
    Each distinct pair of host and path is expanded once. Expressions meet rules on the first 8 hex
    digits of their SHA-256 digest; whole digests confirm. Spark broadcasts the rules if its own size
    check allows and shuffles otherwise; then 16 salted copies of the rules spread an expression that
    most URLs share, and as many copies of each decision a URL that most rows have. Rows without a host
    have salts that no decision has, spread over all tasks.

    Null URL or none with `://`: empty host and path, verdict `default`. Rules with a null host, path or
    verdict, or an empty host, fit nothing. Repeated rows on either side: one result for each page row.
    Empty tables: no rows, or the default for all. Columns of the pages called host, path, rule or
    verdict are replaced; all others stay.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    rules = rules.where("host <> '' and path is not null and verdict is not null").select(
        lower_ascii(F.col("host")).alias("host"), "path", "verdict").groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    sizes = rules.agg(F.max(F.length("host")).alias("host"), F.sort_array(F.collect_set(F.length("path"))).alias("paths")).first()
    longest, cuts = sizes["host"] or 0, sizes["paths"] or []
    host, path = url_parts(F.col(f"`{url}`"))
    parted = pages.withColumns({"host": host, "path": path})
    distinct = parted.select("host", "path").distinct()
    if len(cuts) > LENGTHS:  # every prefix up to the longest rule's; those that no rule has find none
        lengths = F.sequence(F.lit(0), F.least(F.length("path"), F.lit(max(cuts))))
    else:
        lengths = F.filter(F.array(*[F.lit(int(c)) for c in cuts]).cast("array<int>"), lambda n: n <= F.length("path"))
    made = F.flatten(F.transform(
        _host_suffixes(F.col("host"), longest),
        lambda h: F.transform(lengths, lambda n: F.concat(h, F.lit(" "), F.substring("path", F.lit(1), n)))))
    expressions = distinct.select("host", "path", F.explode(made).alias("made")).select(
        "host", "path", F.sha2("made", 256).alias("digest"), F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int").alias("salt"))
    expressions = expressions.withColumn("prefix", F.left("digest", F.lit(PREFIX)))
    digest = F.sha2(F.concat("host", F.lit(" "), "path"), 256)
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    known = rules.select(
        digest.alias("rule_digest"), F.left(digest, F.lit(PREFIX)).alias("prefix"), every_salt.alias("salt"),
        F.struct(
            (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
            F.concat("host", "path").alias("rule"), "verdict").alias("found"))
    hits = expressions.join(known, ["prefix", "salt"]).where("digest = rule_digest")
    decided = hits.groupBy("host", "path").agg(F.max("found").alias("found")).select(
        F.col("host").alias("to_host"), F.col("path").alias("to_path"), "found", every_salt.alias("to_salt"))
    salt, found = free_name(pages, "salt"), free_name(pages, "found")
    parted = parted.withColumn(salt, F.when(
        F.col("host") == "", F.lit(SALTS) + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))).otherwise(
        F.pmod(F.spark_partition_id(), F.lit(SALTS))))  # any salt below SALTS finds its copy
    decided = decided.withColumnRenamed("found", found)
    judged = parted.join(
        decided, (parted["host"] == decided["to_host"]) & (parted["path"] == decided["to_path"])
        & (parted[salt] == decided["to_salt"]), "left")
    return judged.select(
        *[parted[f"`{c}`"] for c in pages.columns], parted["host"], parted["path"], F.col(f"{found}.rule").alias("rule"),
        F.coalesce(F.col(f"{found}.verdict"), F.lit(default)).alias("verdict"))

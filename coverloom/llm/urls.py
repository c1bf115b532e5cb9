"""URL filters by host-suffix and path-prefix expressions, with DataFrame functions only.

Each URL is expanded into the expressions that a rule could equal; they are joined with the rules by the first four bytes of their SHA-256 digests
alone, then the full digest confirms which of the rules met there is the one, and the longest confirmed rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.llm.common import ascii_lower
from coverloom.session import materialise


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path), 256))


def rule_table(rules: DataFrame) -> DataFrame:
    """(rule, action, host_size, path_size, labels, digest) from (host, path, action); one row per rule, of contradicting ones the block."""
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("action").alias("action"))
    rules = rules.filter((F.col("host") != "") & F.col("action").isin("allow", "block"))
    rules = rules.groupBy("host", "path").agg(F.max("action").alias("action"))
    return rules.select(F.concat("host", "path").alias("rule"), "action", F.length("host").alias("host_size"), F.length("path").alias("path_size"),
                        F.size(F.split("host", r"\.")).alias("labels"), digest(F.col("host"), F.col("path")).alias("digest"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url", prefix_bytes: int = 4) -> DataFrame:
    """(page_id, url, host, path, rule, verdict): one row per page.

    A rule fits its host and all subdomains if the path starts with the rule's. Of the fitting rules the longest text wins, of equally
    long ones that with the longer host. No rule: ``default``. Null or malformed URLs have an empty host and fit nothing;
    null ids and repeated rows are returned like others; other columns are ignored. Rules whose digests begin alike for ``prefix_bytes`` meet
    the same expressions and are told apart by the whole digest.
    """
    table = materialise(rule_table(rules), "rules")
    # The numbers of labels and the path lengths that rules have, which a URL's length bounds.
    shape = table.agg(F.sort_array(F.collect_set("labels")).alias("labels"), F.sort_array(F.collect_set("path_size")).alias("paths")).first()
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host(url).alias("host"), path(url).alias("path"))
    deepest = F.substring_index  # the last n labels of a host
    have = F.size(F.split("host", r"\."))
    hosts = F.array_compact(F.array(*[F.when((F.col("host") != "") & (have >= n), deepest(F.col("host"), ".", -n)) for n in shape["labels"]]).cast("array<string>"))
    paths = F.array_compact(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in shape["paths"]]).cast("array<string>"))
    tried = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: digest(h, p))))
    tried = rows.select("*", F.posexplode_outer(tried).alias("_at", "_digest"))
    # one row per prefix with the few rules that share it, so an expression stays one row
    alike = table.groupBy(F.substring("digest", 1, prefix_bytes).alias("_prefix")).agg(F.collect_list(F.struct("digest", "rule", "action", "host_size")).alias("_rules"))
    met = tried.join(alike, F.substring("_digest", 1, prefix_bytes) == F.col("_prefix"), "left")
    found = met.withColumn("_rule", F.get(F.filter("_rules", lambda r: r["digest"] == F.col("_digest")), F.lit(0)))
    rule = F.col("_rule")
    rank = F.when(rule.isNotNull(), F.struct(F.length(rule["rule"]).alias("n"), rule["host_size"].alias("host_size"), rule["rule"].alias("rule"), rule["action"].alias("action")))
    # All expressions of a row are in one task, so one row per page leaves it; ``_rows`` counts repeated rows.
    best = found.groupBy("page_id", "url", "host", "path").agg(
        F.max(rank).alias("_best"), F.sum(F.when(F.coalesce("_at", F.lit(0)) == 0, 1).otherwise(0)).alias("_rows"))
    best = best.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_rows")))
    return best.select("page_id", "url", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.action", F.lit(default)).alias("verdict"))

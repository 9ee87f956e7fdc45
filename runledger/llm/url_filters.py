"""URL filters: host and path rules applied to tables of pages.

A url is expanded into expressions, each a suffix of its host followed by a prefix of its path
that ends in a slash. Rules are filed under the same kind of expression. Both sides are joined
on the first 32 bits of the expression's SHA-256; the whole digest and the rest of the rule's
path are then confirmed, and the longest rule that fits wins. All of it is DataFrame code.

Only expressions as long as the longest rule are formed (more labels or slashes fit no rule).
Equal urls are judged once, so a host or url with a large share of all pages is one row in
the join. Rules are broadcast only if measured small; the verdicts are joined back to the pages
likewise, or by a join that splits hot urls.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm.common import set_apart
from runledger.operators.skew import fits_broadcast, split_join

PREFIX = 8  # hexadecimal digits of the digest that are joined on


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty without ``://`` or for NULL."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rules as a table."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _filed(rules: DataFrame) -> DataFrame:
    """Rules by the digest of their expression. A rule without a host fits nothing. Of equal
    rules one is kept, a block before an allow."""
    host = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    path = F.coalesce("path", F.lit(""))
    named = (
        rules.where(F.col("host") != "")
        .select(host.alias("_rhost"), path.alias("_rpath"), F.col("verdict").alias("_verdict"))
        .groupBy("_rhost", "_rpath")
        .agg(F.max("_verdict").alias("_verdict"))
    )
    anchor = F.regexp_extract("_rpath", r"^(?s:.*/)?", 0)
    digest = F.sha2(F.concat("_rhost", anchor), 256)
    return named.select(
        "*",
        digest.alias("_rdigest"),
        F.substring(digest, 1, PREFIX).alias("_key"),
        F.size(F.split("_rhost", r"\.")).alias("_labels"),
        (F.size(F.split(anchor, "/")) - 1).alias("_slashes"),
    )


def _expressions(labels: int, slashes: int) -> Column:
    """Every host suffix of up to ``labels`` labels with every path prefix of up to
    ``slashes`` slashes."""
    parts, segments = F.split("_host", r"\.", -1), F.split("_path", "/", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))),
        lambda k: F.array_join(F.slice(parts, -k, k), "."),
    )
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(segments) - 1, F.lit(slashes))),
        lambda k: F.when(k == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(segments, F.lit(1), k), "/"), F.lit("/"))
        ),
    )
    return F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the rule that decides, NULL
    if none fits) and ``verdict`` (the rule's, else ``default``). Columns of these names are
    replaced; others are kept.

    A rule fits its host and all subdomains if the url's path starts with the rule's path. The
    longest rule (host and path together) wins, of equally long ones that with the longer host,
    of equal rules the one whose verdict sorts last (block after allow). NULL urls and urls
    without ``://`` have an empty host and path and get ``default``. Repeated rows get equal
    verdicts, and without rules every page gets ``default``."""
    pages, back = set_apart(pages, url)
    pages = pages.drop("host", "path", "rule", "verdict").withColumns(
        {"_host": url_host(F.col(url)), "_path": url_path(F.col(url))}
    )
    filed = _filed(rules)
    depth = filed.agg(F.max("_labels").alias("labels"), F.max("_slashes").alias("slashes")).first()
    urls = pages.where(F.col("_host") != "").select("_host", "_path").distinct()
    expressions = urls.select(
        "*", F.explode(_expressions(depth["labels"] or 0, depth["slashes"] or 0)).alias("_expr")
    ).withColumn("_digest", F.sha2("_expr", 256))
    expressions = expressions.withColumn("_key", F.substring("_digest", 1, PREFIX))
    if fits_broadcast(filed):
        met = expressions.join(F.broadcast(filed), "_key")
    else:
        met = split_join(expressions, filed, ["_key"], ["_host", "_path"])
    fits = (F.col("_digest") == F.col("_rdigest")) & F.col("_path").startswith(F.col("_rpath"))
    rank = F.struct(F.length("_rhost") + F.length("_rpath"), F.length("_rhost"), "_verdict")
    best = (
        met.where(fits)
        .groupBy("_host", "_path")
        .agg(F.max_by(F.struct(F.concat("_rhost", "_rpath").alias("rule"), "_verdict"), rank).alias("_best"))
    )
    if fits_broadcast(best):
        judged = pages.join(F.broadcast(best), ["_host", "_path"], "left")
    else:
        others = [c for c in pages.columns if c not in ("_host", "_path")]
        judged = split_join(pages, best, ["_host", "_path"], others, "left")
    return judged.withColumns({
        "host": F.col("_host"),
        "path": F.col("_path"),
        "rule": F.col("_best.rule"),
        "verdict": F.coalesce("_best._verdict", F.lit(default)),
    }).drop("_host", "_path", "_best").withColumnsRenamed(back)

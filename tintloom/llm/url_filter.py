"""URL filter: host and path rules, then a listed-URL test by a blocked Bloom filter and an exact join.

All of it is DataFrame expressions. The list of canonical URLs becomes a split-block filter, a table of
256-bit blocks (four longs a block, `bit_or` over the keys of the block); a URL that misses a bit of its
block isn't listed, the others go on to an exact hash join with the list, which removes the false hits.
The filter's table and the list are joined on the block number and the URL, so Spark sends them to the
executors whole only while they are below its broadcast threshold and shuffles them beyond it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintloom.llm.common import ascii_lower, stored

#: Bits of the filter for each listed URL, and the most rules in one expression; more are joined as a table.
BITS_PER_KEY, MAX_RULES = 16, 500


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def url_host(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits. Of equally long ones the last given wins."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.host + rule.path).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def with_rules(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """`pages` (host, path, ...) with the rule and verdict of `rule_of`, for any number of rules.

    Every distinct host meets the rules of its domains once; a row then looks for the longest path among those.
    """
    spark = pages.sparkSession
    table = spark.createDataFrame([(*r, i) for i, r in enumerate(rules)], "verdict string, domain string, start string, at int")
    hosts = pages.select("host").distinct()
    # A host's own name and what follows each of its dots.
    labels = F.split("host", r"\.", -1)
    domains = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("domain"))
    text = F.concat("domain", "start")
    of_host = domains.join(table, "domain").groupBy(F.col("host").alias("__host")).agg(F.collect_list(F.struct(F.length(text).alias("n"), "at", "start", text.alias("rule"), "verdict")).alias("__rules"))
    best = F.array_max(F.filter("__rules", lambda r: F.startswith(F.col("path"), r["start"])))
    joined = pages.join(of_host, F.col("host") == F.col("__host"), "left").withColumn("__best", best)
    return joined.select(*pages.columns, F.col("__best.rule").alias("rule"), F.col("__best.verdict").alias("verdict"))


def _block_and_masks(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key and the bits it sets in each of the block's four longs: eight bits, one in each 32."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks))
    bits = F.xxhash64(F.lit("bits"), key)
    five = lambda i: F.shiftrightunsigned(bits, 5 * i).bitwiseAND(F.lit(31).cast("long")).cast("int")
    one = F.lit(1).cast("long")
    shift = lambda i, by: F.call_function("shiftleft", one, five(i) + F.lit(by))
    return block, [shift(2 * w, 0).bitwiseOR(shift(2 * w + 1, 32)) for w in range(4)]


def build_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(filter_block, w0..w3) of the blocks in which a listed URL `canonical` sets a bit."""
    block, masks = _block_and_masks(F.col("canonical"), blocks)
    return (
        listed.select(block.alias("filter_block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
        .groupBy("filter_block")
        .agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])
    )


def listed_urls(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """The distinct values of `canonical` in `urls` that `listed` has too: filter first, exact join on what passes.

    Both sides count once each, so a URL with very many rows costs as much as any other.
    """
    listed = stored(listed.where("canonical is not null").select("canonical").distinct(), "listed")
    blocks = max(1, math.ceil(listed.count() * BITS_PER_KEY / 256))
    table = stored(build_filter(listed, blocks), "bloom")
    block, masks = _block_and_masks(F.col("canonical"), blocks)
    probe = urls.where("canonical is not null").select("canonical").distinct().withColumn("filter_block", block)
    hit = probe.join(table, "filter_block")
    for i, mask in enumerate(masks):
        hit = hit.where(F.col(f"w{i}").bitwiseAND(mask) == mask)
    return hit.select("canonical").join(listed, "canonical", "left_semi")


def filter_urls(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url: str = "url") -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict` (allow or block).

    A rule fits its host and all subdomains if the path starts with the rule's path; the longest wins. Where
    none fits, a URL is blocked if `listed` (column `canonical`: host and path) has it, else allowed. A null
    URL or one without `://` has empty host and path, no rule, and is allowed unless '' is listed. Repeated
    rows keep their number. An empty list blocks nothing. Of equally long rules the last given wins. Columns of
    `pages` named host, path, rule or verdict are replaced; others may have any name.
    """
    others = [c for c in pages.columns if c not in {"host", "path", "rule", "verdict"}]
    kept = ["__kept"]
    named = pages.select(F.struct(*others).alias("__kept") if others else F.lit(None).alias("__kept"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    if len(rules) > MAX_RULES:
        judged = with_rules(named, rules)
    else:
        rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
        judged = named.select("*", rule.alias("rule"), verdict.alias("verdict"))
    known = judged.where("verdict is not null")
    open_ = judged.where("verdict is null").withColumn("__canonical", F.concat("host", "path"))
    hits = stored(listed_urls(open_.select(F.col("__canonical").alias("canonical")), listed), "hits")
    marked = open_.join(hits.select(F.col("canonical").alias("__canonical"), F.lit("block").alias("__listed")), "__canonical", "left")
    rest = marked.select(*kept, "host", "path", "rule", F.coalesce("__listed", F.lit("allow")).alias("verdict"))
    both = known.select(*kept, "host", "path", "rule", "verdict").unionByName(rest)
    return both.select(*[F.col("__kept")[c].alias(c) for c in others], "host", "path", "rule", "verdict")

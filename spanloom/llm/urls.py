"""URL filters: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter.

DataFrame operations only. The filter is a table of blocks, one row of WORDS 64-bit words each, so a URL is probed by
one equi-join on its block number. URLs that hit all their bits are possible hits; only these go through an exact join with the list,
which removes false positives. The filter's rows are sent to the executors while they stay below MAX_BROADCAST_BLOCKS;
beyond that the same join is a shuffle on the block number.

Canonical form: host in lower case without leading `www.` or `m.`, then the path without `index.html`, `.html` and slashes at its end;
scheme, query and fragment do not count.

Defined cases: a null url or one without `://` has empty host and path, fits no rule and is allowed.
Repeated pages give repeated rows; further columns are ignored. Null entries of the list are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules in the order host and path start, verdict. The longest that fits wins.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

WORDS, BITS_PER_URL = 4, 16
MAX_BROADCAST_BLOCKS = 1 << 20  # of 40 bytes

#: Names of sites whose pages make up the list of the query below.
LISTED_SITES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    return F.concat(F.regexp_replace(host, "^(www|m)\\.", ""), F.regexp_replace(path, "(/?index\\.html|\\.html)?/*$", ""))


def rule(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for own, _ in sorted(rules, key=lambda r: len(r[0])):
        site, _, rest = own.partition("/")
        fits = ((host == site) | F.endswith(host, F.lit(f".{site}"))) & F.startswith(path, F.lit(f"/{rest}"))
        found = F.when(fits, F.lit(own)).otherwise(found)
    return found


def _place(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a canonical URL, and the word with its bit for each word of the block."""
    h = F.xxhash64(url, F.lit(2))
    return F.pmod(F.xxhash64(url), F.lit(blocks)), [_bit(h, j) for j in range(WORDS)]


def _bit(h: Column, j: int) -> Column:
    n = F.shiftrightunsigned(h, 6 * j).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def blocked_bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..): the filter over listed(url)."""
    block, bits = _place(F.col("url"), blocks)
    return listed.select(block.alias("block"), *(b.alias(f"w{j}") for j, b in enumerate(bits))).groupBy("block").agg(*(F.bit_or(f"w{j}").alias(f"w{j}") for j in range(WORDS)))


def listed_urls(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """pages(…, canonical) with `possible` (by the filter) and `listed` (by the exact join)."""
    listed = listed.select("url").where("url IS NOT NULL").distinct()
    blocks = max(1, -(-listed.count() * BITS_PER_URL // (64 * WORDS)))
    bloom = blocked_bloom(listed, blocks)
    block, bits = _place(F.col("canonical"), blocks)
    hit = F.lit(True)
    for j, bit in enumerate(bits):
        hit = hit & (F.col(f"w{j}").bitwiseAND(bit) == bit)
    probed = pages.withColumn("block", block).join(F.broadcast(bloom) if blocks <= MAX_BROADCAST_BLOCKS else bloom, "block", "left")
    probed = probed.withColumn("possible", F.coalesce(hit, F.lit(False))).drop("block", *(f"w{j}" for j in range(WORDS)))
    exact = probed.where("possible").join(listed.select(F.col("url").alias("canonical"), F.lit(True).alias("_in")), "canonical", "left")
    exact = exact.withColumn("listed", F.coalesce("_in", F.lit(False))).drop("_in")
    return exact.unionByName(probed.where("NOT possible").withColumn("listed", F.lit(False)))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """One row per page: host, path, rule, verdict, and whether the list has it. listed has canonical URLs in `url`."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    own = own.withColumn("canonical", canonical(F.col("host"), F.col("path"))).withColumn("rule", rule(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col("listed"), "block").otherwise("allow")
    for text, word in rules:
        verdict = F.when(F.col("rule") == text, word).otherwise(verdict)
    return listed_urls(own, listed).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")


def site_list(pages: DataFrame, sites: list[str] = LISTED_SITES) -> DataFrame:
    """The canonical URLs of all pages that stand on one of the named sites."""
    own = pages.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    return own.where(F.arrays_overlap(F.split("host", "\\."), F.array(*map(F.lit, sites)))).select(canonical(F.col("host"), F.col("path")).alias("url")).distinct()


ORACLE = """
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
c AS (
  SELECT *, regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '(/?index\\.html|\\.html)?/*$', '') AS canonical,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u),
listed AS (
  SELECT DISTINCT canonical FROM c
  WHERE list_has_any(string_split(host, '.'), ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict,
       canonical IN (SELECT canonical FROM listed) AS listed
FROM c
"""

"""URL filters by a blocked Bloom filter and an exact join (operator 9). DataFrame functions only.

The filter is a table: one row for each block of 512 bits, as eight words of 64. A canonical URL
has one block and sets one bit in each word of it, so testing it reads a single row. The table is
broadcast while its size, known beforehand, allows; beyond that, pages meet their block in a join
on the block number. Pages that pass are joined to the list itself, which removes the filter's
false positives; all others are settled without moving. Written tables on both sides let adaptive
execution split a URL or block that very many pages have.

Rules come first: a rule (verdict, host, path) fits its host and all subdomains where the path
starts with the rule's; the longest wins. Rules are a short list, at most MAX_RULES.

A null URL, or one without "://", has an empty host and path and no canonical form: no rule and no
list names it, so it is allowed. Repeated rows are each judged; an empty list blocks nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.llm.common import settled

WORDS = 8
BLOCK_BITS = 64 * WORDS
KEY_BITS = 12  # bits of filter for each listed URL: about 4 false positives in 1,000
ROW_BYTES = 8 * (WORDS + 2)
BROADCAST_BYTES = 64 << 20
MAX_RULES = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query, the words in a host that put its pages on the list, and the
#: first digits of the digests below which a canonical URL counts as reported.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
SPAM_WORDS = ("bets", "casino", "pills")
REPORTED = "10"


def after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www., path without slashes at its end, the sorted query without utm_ fields.

    Scheme and fragment do not count. Null if there is no "://".
    """
    query = F.regexp_extract(after_scheme(url), "^[^?#]*[?]([^#]*)", 1)
    fields = F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.startswith("utm_"))
    kept = F.array_join(F.array_sort(fields), "&")
    bare = F.concat(
        F.regexp_replace(host_of(url), "^www[.]", ""), F.regexp_replace(path_of(url), "/+$", "")
    )
    whole = F.when(kept != "", F.concat(bare, F.lit("?"), kept)).otherwise(bare)
    return F.when(F.locate("://", url) > 0, whole)


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks).cast("long"))


def _bits(url: Column) -> list[Column]:
    """The bit that a URL sets in each word of its block, as a mask."""
    mixed = F.xxhash64(url, F.lit(1))
    return [
        F.call_function(
            "shiftleft",
            F.lit(1).cast("long"),
            F.shiftrightunsigned(mixed, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int"),
        )
        for i in range(WORDS)
    ]


def build(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter of a table (canonical): a row _block, w0 ... w7 for each block in use."""
    url = F.col("canonical")
    bits = [b.alias(f"w{i}") for i, b in enumerate(_bits(url))]
    return (
        listed.select(_block(url, blocks).alias("_block"), *bits)
        .groupBy("_block")
        .agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    )


def passing(pages: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """``pages`` (with a column canonical) and ``_passes``: whether the filter may hold its URL."""
    url = F.col("canonical")
    table = F.broadcast(bloom) if blocks * ROW_BYTES <= BROADCAST_BYTES else bloom
    passes = F.lit(True)
    for i, bit in enumerate(_bits(url)):
        passes = passes & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    return (
        pages.withColumn("_block", _block(url, blocks))
        .join(table, "_block", "left")
        .withColumn("_passes", url.isNotNull() & F.coalesce(passes, F.lit(False)))
        .drop("_block", *[f"w{i}" for i in range(WORDS)])
    )


def flag_listed(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """``pages`` (with a column canonical) and ``listed``: whether the list has its URL."""
    known = settled(listed.where("canonical IS NOT NULL").select("canonical").distinct(), "listed")
    blocks = max(1, -(-known.count() * KEY_BITS // BLOCK_BITS))
    bloom = settled(build(known, blocks), "bloom")
    tested = passing(pages, bloom, blocks)
    hits = tested.where("_passes").join(known.withColumn("listed", F.lit(True)), "canonical", "left")
    others = tested.where("NOT _passes").withColumn("listed", F.lit(False))
    out = hits.withColumn("listed", F.coalesce("listed", F.lit(False))).unionByName(others)
    return out.drop("_passes")


def by_rule(rules: Sequence[Rule], value) -> Column:
    """value(rule) of the longest rule that fits the columns host and path, else null."""
    if len(rules) > MAX_RULES:
        raise ValueError("put long lists of URLs into the listed table")
    host, path = F.col("host"), F.col("path")
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        out = F.when(fits & path.startswith(rule.path), F.lit(value(rule))).otherwise(out)
    return out


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of pages (page_id, url).

    ``listed`` has a column canonical: the URLs to block where no rule speaks.
    """
    parts = pages.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        canonical(F.col("url")).alias("canonical"),
    )
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return flag_listed(parts, listed).select(
        "page_id",
        "host",
        "path",
        by_rule(rules, lambda r: r.name).alias("rule"),
        F.coalesce(by_rule(rules, lambda r: r.verdict), own).alias("verdict"),
    )


def spam_list(pages: DataFrame) -> DataFrame:
    """The canonical URLs of all pages whose host has a word of SPAM_WORDS."""
    spam = host_of(F.col("url")).rlike("|".join(SPAM_WORDS))
    return pages.where(spam).select(canonical(F.col("url")).alias("canonical"))


def mirrored(url: Column) -> Column:
    """Another form of a canonical URL, as a report might give it."""
    host = F.translate(F.regexp_extract(url, "^[^/?]*", 0), LOWER, UPPER)
    path = F.regexp_extract(url, "^[^/?]*([^?]*)", 1)
    query = F.regexp_extract(url, "^[^?]*[?](.*)$", 1)
    fields = F.when(query != "", F.concat(F.lit("&"), query)).otherwise(F.lit(""))
    return F.concat(F.lit("HTTP://WWW."), host, path, F.lit("/?utm_source=report"), fields, F.lit("#x"))


def reported_urls(pages: DataFrame) -> DataFrame:
    """A column url: other forms of a seeded share of the pages' URLs.

    It stands for a list from elsewhere: nothing in a URL itself tells that it is reported.
    """
    known = pages.select(canonical(F.col("url")).alias("canonical"))
    share = F.substring(F.md5("canonical"), 1, len(REPORTED)) < REPORTED
    return known.where(share).select(mirrored(F.col("canonical")).alias("url"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    reported = reported_urls(pages).select(canonical(F.col("url")).alias("canonical"))
    return judge(pages, spam_list(pages).unionByName(reported))


SQL = f"""
WITH rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), parts AS (
  SELECT page_id, rest,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    array_to_string(list_sort(list_filter(
      string_split(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT starts_with(x, 'utm_'))), '&') AS fields
  FROM rests
), urls AS (
  SELECT page_id, host, path, CASE WHEN rest IS NOT NULL THEN
    regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN fields <> '' THEN '?' || fields ELSE '' END END AS canonical
  FROM parts
), listed AS (
  SELECT DISTINCT canonical FROM urls WHERE regexp_matches(host, '{"|".join(SPAM_WORDS)}')
    OR substr(md5(canonical), 1, {len(REPORTED)}) < '{REPORTED}'
), rules(verdict, rhost, rpath) AS (
  VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)}
), best AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM urls JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost))
                      AND starts_with(path, rpath)
  GROUP BY page_id
)
SELECT u.page_id, u.host, u.path, b.rule,
  coalesce(b.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM urls u LEFT JOIN best b ON u.page_id = b.page_id LEFT JOIN listed l ON u.canonical = l.canonical
"""

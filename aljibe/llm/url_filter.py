"""URL filter: prefix rules, then a blocked Bloom filter of listed URLs in front of an exact join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aljibe.session import staged

#: (host, path, verdict); a rule fits its host and all subdomains if the path of the URL starts with its path.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_BITS, WORDS, BITS_PER_URL, PROBES = 64, 4, 12, 6
MAX_BLOCKS = 1 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` (A-Z lower-cased) and path; empty for NULL or without ``://``."""
    rest = F.coalesce(F.get(F.split(url, "://", 2), F.lit(1)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without trailing slashes, query without tracking parameters; NULL if there is no host."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|gclid|fbclid)="))
    bare = F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""))
    asked = F.array_join(F.array_sort(kept), "&")
    return F.when(host != "", F.concat(bare, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise("")))


def bloom_blocks(listed: int) -> int:
    """Number of 256-bit blocks for so many URLs: a power of two, never above 32 MB of filter.

    Beyond that size more URLs pass as possible hits; the exact join still decides.
    """
    wanted = max(1, listed * BITS_PER_URL // (WORD_BITS * WORDS))
    return min(MAX_BLOCKS, 1 << (wanted - 1).bit_length())


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _words(key: Column) -> list[Column]:
    """The bits of a key within its block: four words of 64 bits."""
    bits = F.xxhash64(key, F.lit("bits"))
    words = [F.lit(0).cast("bigint")] * WORDS
    for i in range(PROBES):
        at = F.shiftrightunsigned(bits, 8 * i).bitwiseAND(F.lit(255))
        one = F.expr("1L")
        for w in range(WORDS):
            bit = F.call_function("shiftleft", one, at.bitwiseAND(F.lit(63)).cast("int"))
            words[w] = words[w].bitwiseOR(F.when(F.shiftright(at, 6) == w, bit).otherwise(F.lit(0).cast("bigint")))
    return words


def blocked_bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row per used block: ``block`` and its words ``w0`` .. ``w3``. At most ``blocks`` rows."""
    words = _words(F.col(key))
    rows = listed.select(_block(F.col(key), blocks).alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(words)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possible_hits(rows: DataFrame, bloom: DataFrame, key: str, blocks: int) -> DataFrame:
    """Rows whose key may be listed. The filter is broadcast: ``bloom_blocks`` bounds it by 32 MB."""
    words = _words(F.col(key))
    hit = _block(F.col(key), blocks) == F.col("block")
    for i, word in enumerate(words):
        hit = hit & (F.col(f"w{i}").bitwiseAND(word) == word)
    return rows.join(F.broadcast(bloom), hit, "left_semi")


def judge_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, listed. Runs jobs.

    The longest fitting rule decides (of rules of equal length, the smaller one); without a rule a
    URL is blocked if its canonical form is among those of ``listed.url``, else allowed. ``listed`` tells
    whether the URL is on the list, whatever the rule says. NULL URLs have an empty host and path, fit no
    rule and are allowed. Repeated rows are judged alike; other columns are not read.

    The few distinct URLs that pass the Bloom filter are confirmed by an exact hash join; a URL that
    many rows share is looked up once.
    """
    names = staged(listed.select(canonical(F.col("url")).alias("listed_url")).filter("listed_url is not null").distinct())
    blocks = bloom_blocks(names.count())
    bloom = blocked_bloom(names, "listed_url", blocks)
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), canonical(F.col(url_col)).alias("canon"))
    seen = rows.select("canon").filter("canon is not null")
    confirmed = staged(possible_hits(seen, bloom, "canon", blocks).distinct()
                       .join(names.hint("shuffle_hash"), F.col("canon") == F.col("listed_url"), "left_semi"))
    joined = rows.join(confirmed.select(F.col("canon").alias("hit")), F.col("canon") == F.col("hit"), "left")
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("hit").isNotNull(), "block").otherwise("allow")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]), reverse=True):
        fits = ((F.col("host") == rule_host) | F.col("host").endswith("." + rule_host)) & F.col("path").startswith(rule_path)
        rule, verdict = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return joined.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), F.col("hit").isNotNull().alias("listed"))

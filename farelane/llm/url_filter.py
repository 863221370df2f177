"""URL filter: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

The filter is a table with one row of 256 bits per block. An URL looks up one block
by equi-join, so the filter is spread over the cluster like any table and only
broadcast where Spark finds it small. Possible hits alone go on to the exact join with
the list, which removes the false positives.

Cases, by definition:

* null URLs and URLs without ``://`` have empty host and path, no rule and are allowed;
* of several fitting rules the longest decides, whatever the list says;
* an URL is listed if its canonical form is; empty lists block nothing;
* repeated rows are judged alike, each on its own row; an empty table stays empty;
* other columns are kept, whatever their names, except that the result's own columns
  (``host``, ``path``, ``rule``, ``verdict``, ``canonical``) replace columns of these names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import ascii_lower, land

#: (verdict, rule); a rule is a host and a path prefix. A short list: each rule is one comparison per row.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Names of hosts whose pages are listed, whatever their subdomain.
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BITS_PER_URL = 16
BLOCK_BITS = 256


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def canonical_url(url: Column) -> Column:
    """Lower-case host without ``www.`` or ``m.``, and path without ``.html`` and closing slashes; null without a host."""
    host, path = host_and_path(url)
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"(\.html)?/*$", "")))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """(verdict, rule) of the longest fitting rule, or null."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, prefix = rule.split("/", 1)
        on_host = (host == name) | host.endswith("." + name)
        fits.append(F.when(on_host & path.startswith("/" + prefix), F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<verdict:string,rule:string>")


def _block(n_blocks: int) -> Column:
    return F.pmod(F.xxhash64("canonical"), F.lit(n_blocks))


def _masks() -> list[Column]:
    """Four longs of 64 bits with one bit set in each of their halves."""
    bit = lambda i: f"cast(shiftrightunsigned(xxhash64(canonical, 1), {5 * i}) & 31 as int)"
    return [F.expr(f"shiftleft(1L, {bit(2 * i)}) | shiftleft(1L, 32 + {bit(2 * i + 1)})") for i in range(4)]


def bloom_blocks(listed: DataFrame, n_blocks: int) -> DataFrame:
    """(block, b0..b3) from the column ``canonical`` of ``listed``."""
    keyed = listed.select(_block(n_blocks).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_masks())])
    return keyed.groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"b{i}") for i in range(4)])


def possible_hits(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` (columns block and canonical) with ``maybe``: whether all bits of the URL are set in its block."""
    probe = rows.select("*", *[m.alias(f"m{i}") for i, m in enumerate(_masks())]).join(blocks, "block", "left")
    hit = F.lit(True)
    for i in range(4):
        hit = hit & (F.col(f"m{i}").bitwiseAND(F.col(f"b{i}")) == F.col(f"m{i}"))
    return probe.select(*[c for c in rows.columns if c != "block"], F.coalesce(hit, F.lit(False)).alias("maybe"))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = RULES, bits_per_url: int = BITS_PER_URL) -> DataFrame:
    """``pages`` (column ``url``) with host, path, canonical, rule and verdict; ``listed`` has canonical URLs."""
    listed = land(listed.select("canonical").where(F.col("canonical").isNotNull()).distinct(), "listed-urls")
    n_blocks = max(1, -(-listed.count() * bits_per_url // BLOCK_BITS))
    blocks = land(bloom_blocks(listed, n_blocks), "url-blocks")
    host, path = host_and_path(F.col("url"))
    own = ("host", "path", "canonical", "rule", "verdict")
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in own]).alias("row"), "url")
    rows = rows.select("row", host.alias("host"), path.alias("path"), canonical_url(F.col("url")).alias("canonical"))
    rows = rows.select("*", matching_rule(F.col("host"), F.col("path"), rules).alias("fit"))
    ruled = rows.where(F.col("fit").isNotNull() | F.col("canonical").isNull())
    open_rows = rows.where(F.col("fit").isNull() & F.col("canonical").isNotNull()).select("*", _block(n_blocks).alias("block"))
    probe = land(possible_hits(open_rows, blocks), "url-probe")
    exact = probe.where("maybe").join(listed.select("canonical", F.lit(True).alias("listed")), "canonical", "left")
    no = F.lit(None).cast("boolean").alias("listed")
    columns = ["row", "host", "path", "canonical", "fit", "listed"]
    joined = exact.select(*columns)
    for part in (probe.where(~F.col("maybe")), ruled):
        joined = joined.unionByName(part.select("row", "host", "path", "canonical", "fit", no))
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        "row.*",
        "host",
        "path",
        "canonical",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), by_list).alias("verdict"),
    )


def named_urls(pages: DataFrame, names: Sequence[str] = LISTED_NAMES) -> DataFrame:
    """A list of canonical URLs: those of pages on hosts of which a part is one of ``names``."""
    host, _ = host_and_path(F.col("url"))
    on_list = F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, names)))
    return pages.where(on_list).select(canonical_url(F.col("url")).alias("canonical")).distinct()


def mirror_urls(pages: DataFrame) -> DataFrame:
    """A list of canonical URLs: those that repeat the html of a page with a smaller id under another URL."""
    held = pages.where(F.col("html").isNotNull()).select("page_id", F.sha2("html", 256).alias("digest"), canonical_url(F.col("url")).alias("canonical"))
    first = land(held.groupBy("digest", "canonical").agg(F.min("page_id").alias("page_id")), "url-digests")
    least = first.groupBy("digest").agg(F.min("page_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    return first.join(least, "digest").where(F.col("page_id") > F.col("least")).select("canonical").distinct()

"""Line dedup by distinct-site spread: lines found on many sites are boilerplate.

A sketch (HyperLogLog) of the sites is kept per line hash and merged by the
aggregation, so a line on a million pages costs one small sketch per task.
Where the estimate is clear of the threshold it decides; in the band around the
threshold the sites are counted exactly.

Cases, by definition:

* null text stays null; lines without a word are never counted or removed;
* a null site counts as one site of its own;
* of a widespread line the document with the smallest id keeps its occurrences, so
  copied documents leave one whole (rows with a null id keep none, unless no row has one);
* rows with equal id and text are treated alike; an empty table stays empty;
* all columns are kept, whatever their names; only ``text`` changes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import columns_of, land, normal_line

MIN_SITES = 10
LG_SKETCH = 12


def line_key(line: Column) -> Column:
    return F.xxhash64(normal_line(line))


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def line_sites(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, site, keys): the distinct lines of each document as hashes."""
    lines = F.filter(F.split("text", "\n"), _has_word)
    return docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("site"),
        F.array_distinct(F.transform(lines, line_key)).alias("keys"),
    )


def widespread(sites: DataFrame, min_sites: int = MIN_SITES, lg_sketch: int = LG_SKETCH) -> DataFrame:
    """(key, home): lines on ``min_sites`` sites or more, and the smallest id that holds each."""
    held = sites.select("doc_id", "site", F.explode("keys").alias("key"))
    error = 5 * 1.04 / math.sqrt(2**lg_sketch)
    low, high = math.floor(min_sites * (1 - error)), math.ceil(min_sites * (1 + error))
    spread = land(
        held.groupBy("key")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_sketch)).alias("about"), F.min("doc_id").alias("home"))
        .where(F.col("about") >= low),
        "line-spread",
    )
    near = spread.where(F.col("about") <= high)
    exact = (
        held.join(near.select("key"), "key", "left_semi").groupBy("key").agg(F.count_distinct("site").alias("n")).where(F.col("n") >= min_sites)
    )
    return spread.where(F.col("about") > high).select("key", "home").unionByName(near.join(exact, "key").select("key", "home"))


def removals(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(_id, _text, _lost): keys of the lines to take from each document that has some."""
    sites = land(line_sites(docs), "line-sites")
    lines = land(widespread(sites, min_sites), "widespread-lines")
    held = sites.select("doc_id", "text_key", F.explode("keys").alias("key")).join(lines, "key")
    return (
        held.where(~F.col("doc_id").eqNullSafe(F.col("home")))
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"))
        .agg(F.collect_set("key").alias("_lost"))
    )


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` without widespread lines; columns and rows stay."""
    # Removals grow with the documents, so they are never broadcast: the plan is one at every size.
    lost = land(removals(docs, min_sites), "line-removals").hint("merge")
    joined = docs.join(lost, docs["doc_id"].eqNullSafe(lost["_id"]) & (F.xxhash64(docs["text"]) == lost["_text"]), "left")
    keys = lost["_lost"]
    stays = F.filter(F.split(docs["text"], "\n"), lambda line: ~(_has_word(line) & F.array_contains(keys, line_key(line))))
    text = F.when(keys.isNull(), docs["text"]).otherwise(F.array_join(stays, "\n"))
    return joined.select(*columns_of(docs, text=text))

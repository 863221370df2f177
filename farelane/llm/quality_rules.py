"""Quality rules: per-document limits, then lines that too many documents of a host share.

Cases, by definition:

* null text counts as empty, with no words and no lines, so it fails the length rule;
* a line is frequent in a host if more than 50 distinct documents share it, or more than a tenth of
  its documents and more than 5;
* lines without a word never count and are never removed; repeated lines of one
  document count once for their frequency, and each of them when removed;
* documents are told apart by their text: exact copies count once, so copying
  alone makes no line frequent;
* the document with the smallest id holding a frequent line keeps it, so of a
  group of copies one stays whole (equal ids keep it together; rows with a null id
  keep none unless no row of the line has an id);
* a null host is a host of its own; an empty table gives an empty result;
* other columns, whatever their names, are ignored by ``judge`` and kept by ``clean``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import WHITE, columns_of, land, let, normal_line, words_of

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: Distinct documents of one host that may share a line; of a small host fewer: so many percent of its documents, but no less than the least.
    max_line_docs: int = 50
    max_line_percent: int = 10
    min_line_docs: int = 5
    #: Share of a document's words that must stay once frequent lines are gone.
    min_kept_percent: int = 30


def repeat_words(words: Column) -> Column:
    """Words inside a 3-word window that occurs twice or more in the text.

    Windows are sorted with their position; equal neighbours are repeats. Each
    repeated window then adds the words that the repeated window before it leaves
    uncovered, three at most. Work and memory per text are n log n and n.
    """

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda s, i: F.when(i == 0, F.lit(3)).otherwise(F.least(F.lit(3), s - starts[i - 1])))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def repeated(windows: Column) -> Column:
        same = lambda w, i, j: F.coalesce(F.get(windows, j)["k"] == w["k"], F.lit(False))
        hits = F.filter(windows, lambda w, i: same(w, i, i - 1) | same(w, i, i + 1))
        return F.sort_array(F.transform(hits, lambda w: w["i"]))

    def windows(w: Column) -> Column:
        return F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3),
                lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("k"), i.alias("i")),
            )
        )

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(let(windows(words), repeated), covered)).cast("long")


def _facts(docs: DataFrame) -> DataFrame:
    """One narrow row per document: counts of the rules and its lines as (key, words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select(
        F.col("doc_id"),
        F.col("source").alias("host"),
        text.alias("text"),
    )
    line_facts = lambda line, host: F.struct(
        F.xxhash64(host, normal_line(line)).alias("key"), F.size(words_of(line)).alias("words")
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # Each array is bound once; counts are then taken from it inside one expression.
    from_words = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")))
    from_lines = let(
        lines,
        lambda a: F.struct(
            (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
            F.transform(a, lambda line: line_facts(line, F.col("host"))).alias("lines"),
        ),
    )
    return plain.select(
        "doc_id",
        F.xxhash64(F.col("host").isNull(), F.col("host")).alias("host_key"),
        F.xxhash64("text").alias("text_key"),
        from_words.alias("w"),
        F.length(F.regexp_replace("text", WHITE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        from_lines.alias("l"),
    ).select("doc_id", "host_key", "text_key", "w.*", "word_chars", "n_symbols", "l.*")


def frequent_lines(facts: DataFrame, rules: QualityRules) -> DataFrame:
    """Lines (host and text in one key) that too many documents of their host share, with the id that keeps each."""
    held = facts.select("doc_id", "host_key", "text_key", F.explode(F.array_distinct(F.transform("lines", lambda x: x["key"]))).alias("key"))
    shared = (
        held.groupBy("key")
        .agg(F.count_distinct("text_key").alias("n_docs"), F.min("doc_id").alias("home"), F.min("host_key").alias("host_key"))
        .where(F.col("n_docs") > min(rules.min_line_docs, rules.max_line_docs))
    )
    hosts = land(facts.groupBy("host_key").agg(F.count_distinct("text_key").alias("host_docs")), "host-sizes")
    of_small_host = (F.col("n_docs") > rules.min_line_docs) & (100 * F.col("n_docs") > rules.max_line_percent * F.col("host_docs"))
    return shared.join(hosts, "host_key").where((F.col("n_docs") > rules.max_line_docs) | of_small_host).select("key", "home")


def _removals(facts: DataFrame, rules: QualityRules) -> DataFrame:
    """(_id, _text, lost): keys of the lines to take from each document that has some."""
    frequent = land(frequent_lines(facts, rules), "frequent-lines")
    held = facts.select("doc_id", "text_key", F.explode("lines.key").alias("key"))
    return (
        held.join(frequent, "key")
        .where(~F.col("doc_id").eqNullSafe(F.col("home")))
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"))
        .agg(F.collect_set("key").alias("lost"))
    )


def judge(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """One row per row of ``docs``: counts, ``base_failed`` and ``kept``, and the keys of removed lines (``lost``)."""
    facts = land(_facts(docs), "line-facts")
    lost = _removals(facts, rules)
    joined = facts.join(lost, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_text")), "left")
    gone = F.when(F.col("lost").isNotNull(), F.filter("lines", lambda x: F.array_contains("lost", x["key"])))
    joined = joined.withColumn("gone", gone).drop("lines")
    zero = F.lit(0).cast("long")
    lost_words = F.aggregate(F.col("gone.words"), zero, lambda a, n: a + n)
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    left = F.col("n_words") - F.coalesce(lost_words, zero)
    return joined.select(
        "doc_id",
        "text_key",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (100 * left >= rules.min_kept_percent * F.col("n_words"))).alias("kept"),
        F.when(F.col("gone").isNull(), zero).otherwise(F.size("gone").cast("long")).alias("n_lost_lines"),
        left.alias("n_left_words"),
        "lost",
    )


def clean(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of ``docs`` that pass, without their frequent lines; same columns."""
    verdicts = judge(docs, rules).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), F.col("kept").alias("_kept"), F.col("lost").alias("_lost")
    )
    verdicts = land(verdicts.dropDuplicates(["_id", "_text"]), "quality-verdicts")
    text = F.coalesce(docs["text"], F.lit(""))
    verdicts = verdicts.where("_kept")
    joined = docs.join(
        verdicts, docs["doc_id"].eqNullSafe(verdicts["_id"]) & (F.xxhash64(text) == verdicts["_text"])
    )
    lost = verdicts["_lost"]
    stays = F.filter(
        F.split(docs["text"], "\n"),
        lambda line: ~F.array_contains(lost, F.xxhash64(docs["source"], normal_line(line))) | ~line.rlike(r"[^\x20\x09-\x0D]"),
    )
    cleaned = F.when(lost.isNull(), docs["text"]).otherwise(F.array_join(stays, "\n"))
    return joined.select(*columns_of(docs, text=cleaned))

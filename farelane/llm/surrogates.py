"""Surrogates for personal entities: keyed, of the same type and format, distinct over the corpus.

A replacement is computed from the key, the entity and an attempt number, so mentions of one
entity agree everywhere without a lookup. Two entities must not share a replacement, and none
may equal an entity of the corpus. The check runs over the distinct entities of all
documents: of those that clash the least keeps its replacement and the others try again. Only
the few entities with a later attempt are stored, and joined to the documents that mention them.

Emails, telephone numbers, IPv4 and IPv6 addresses, card and social security numbers, IBANs with
right check digits, and names behind titles are found: initials and all name words, the last as
family name. Names keep gender and script, initials become other initials and need not be distinct, cards
their check digit (or lack of one), telephone numbers the country code, private addresses
their network.
Forms with few replacements, such as the addresses of a private network, end in lists that are dealt out by rank and go on in a wider form.

Cases, by definition:

* null and empty texts stay as they are; an empty table stays empty;
* repeated rows and equal entities in other formats get the same replacement;
* all columns are kept, whatever their names; only ``text`` changes;
* a name that a title announces is found in the rest of that text too, whole or by one of its words,
  also in capitals; other texts are not searched for it;
* other words, and documents without entities, stay byte for byte the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from farelane.llm.common import columns_of, land, map_batches, ship, unused
from farelane.llm.entities import RANKED, form, mentions, rendered, surrogate

_ENTITY = "kind string, value string"


def _base(kind: str) -> str:
    """Family names are one entity whatever the gender of who bears them."""
    return kind[:-2] if kind.startswith("family") else kind


def found_entities(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, kind, value) for each entity of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (row, kind, value)
                for row, text in enumerate(batch.column("text"))
                for kind, value in dict.fromkeys((_base(m.kind), m.value) for m in mentions(text.as_py()) if not m.kind.startswith("initial"))
            ]
            at = pa.array([r[0] for r in rows], pa.int64())
            columns = [batch.column("doc_id").take(at), batch.column("text_key").take(at)]
            columns += [pa.array([r[k] for r in rows], pa.string()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "kind", "value"])

    narrow = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    return map_batches(narrow, run, f"doc_id {id_type}, text_key long, {_ENTITY}")


def _with_surrogates(entities: DataFrame, key: bytes, attempt: int | None) -> DataFrame:
    """``entities`` with the replacement ``new`` of an attempt, or of the attempt in their own column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values = batch.column("kind").to_pylist(), batch.column("value").to_pylist()
            attempts = [attempt] * len(kinds) if attempt is not None else batch.column("attempt").to_pylist()
            made = [surrogate(key, k if not k.startswith("family") else f"{k}-n", v, a) for k, v, a in zip(kinds, values, attempts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], [*batch.schema.names, "new"])

    rows = entities.select("kind", "value", *([] if attempt is not None else ["form", F.col("attempt").cast("int")]))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return map_batches(rows, run, f"{fields}, new string")


def later_attempts(entities: DataFrame, key: bytes, rounds: int = 8) -> DataFrame:
    """(kind, value, attempt) of the entities whose first replacement clashes; ``entities`` is a written table.

    After some rounds, entities of forms with few replacements get free ones by rank, from the list of their form;
    all other forms grow with each attempt, so that chance settles them.
    """
    # Replacements are told apart over all kinds: a text shows no kinds.
    taken = entities.select(F.col("value").alias("new"))
    pending, settled, later, attempt = entities, None, [], 0
    while attempt == 0 or not pending.isEmpty():
        if attempt == rounds:
            listed, pending = _by_rank(pending, taken.unionByName(settled), key)
            later.append(listed.select("kind", "value", "attempt"))
            settled = settled.unionByName(listed.select("new"))
        tried = land(_with_surrogates(pending, key, attempt), "surrogates")
        free = tried.join(taken, "new", "left_anti")
        if settled is not None:
            free = free.join(settled, "new", "left_anti")
        won = land(free.groupBy("new").agg(F.min(F.struct("kind", "value")).alias("e")).select("new", "e.*"), "surrogates")
        if attempt:
            later.append(won.select("kind", "value", F.lit(attempt).alias("attempt")))
        settled = won.select("new") if settled is None else settled.unionByName(won.select("new"))
        pending = land(tried.join(won, ["kind", "value"], "left_anti").select("kind", "value"), "entities")
        attempt += 1
    none = entities.select("kind", "value", F.lit(1).alias("attempt")).limit(0)
    return reduce(DataFrame.unionByName, later, none)


def _by_rank(pending: DataFrame, taken: DataFrame, key: bytes) -> tuple[DataFrame, DataFrame]:
    """(kind, value, new, attempt) of all pending entities that have a list of replacements, and the other pending ones.

    Of each form as many ranks are tried as it has entities left; those whose replacement is free go to the entities in
    order. What is left goes on with the next ranks.
    """

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [form(k, v) for k, v in zip(batch.column("kind").to_pylist(), batch.column("value").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], ["kind", "value", "form"])

    formed = land(map_batches(pending.select("kind", "value"), forms, f"{_ENTITY}, form string"), "entity-forms")
    left, given, first = formed.where("form is not null"), [], 0
    given.append(left.select("kind", "value", F.lit("").alias("new"), F.lit(0).alias("attempt")).limit(0))
    while (most := left.groupBy("kind", "form").count().agg(F.max("count")).first()[0]) is not None:
        sizes = left.groupBy("kind", "form").agg(F.min("value").alias("value"), F.count("*").alias("n"))
        ranks = F.explode(F.sequence(F.lit(first).cast("long"), F.lit(first - 1) + 2 * F.col("n"))).alias("rank")
        offered = sizes.select("kind", "form", "value", ranks)
        made = land(_with_surrogates(offered.withColumn("attempt", F.col("rank") + RANKED), key, None), "ranked-surrogates")
        free = made.join(taken, "new", "left_anti").join(reduce(DataFrame.unionByName, given).select("new"), "new", "left_anti")
        free = free.groupBy("new").agg(F.min(F.struct("kind", "form", "attempt")).alias("f")).select("new", "f.*")
        place = F.row_number().over(Window.partitionBy("kind", "form").orderBy("attempt")).alias("place")
        offers = free.select("kind", "form", "new", "attempt", place)
        wants = left.select("kind", "form", "value", F.row_number().over(Window.partitionBy("kind", "form").orderBy("value")).alias("place"))
        won = land(wants.join(offers, ["kind", "form", "place"]).select("kind", "value", "new", "attempt"), "ranked-surrogates")
        given.append(won)
        left = land(left.join(won.select("kind", "value"), ["kind", "value"], "left_anti"), "entity-forms")
        first += 2 * most
    return reduce(DataFrame.unionByName, given), formed.where("form is null").select("kind", "value")


def _replaced(key: bytes, text: str, later: dict[tuple[str, str], int]) -> tuple[str, list[str]]:
    parts, at, kinds = [], 0, []
    for m in mentions(text):
        surface = text[m.start : m.end]
        new = surrogate(key, m.kind, m.value, later.get((_base(m.kind), m.value), 0))
        parts += [text[at : m.start], rendered(m, surface, new)]
        at = m.end
        kinds.append(m.kind.split("-")[0])
    return "".join(parts) + text[at:] if parts else text, kinds


def replacing(key: bytes) -> Column:
    """A function of (text, later attempts) that gives the new text and the kinds of its mentions."""
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType()))])

    @F.arrow_udf(kind)
    def run(texts: pa.Array, later: pa.Array) -> pa.Array:
        new, kinds = [], []
        for text, attempts in zip(texts, later):
            text = text.as_py()
            known = {(a["kind"], a["value"]): a["attempt"] for a in attempts.as_py() or []}
            found = _replaced(key, text, known) if text else (text, [])
            new.append(found[0])
            kinds.append(found[1])
        return pa.StructArray.from_arrays([pa.array(new, pa.string()), pa.array(kinds, pa.list_(pa.string()))], ["text", "kinds"])

    return run


def replace_entities(docs: DataFrame, key: bytes, kinds_column: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``; ``kinds_column`` adds the kinds found, one per mention."""
    ship(docs.sparkSession)
    found = land(found_entities(docs), "mentions")
    entities = land(found.select("kind", "value").distinct(), "entities")
    attempts = later_attempts(entities, key)
    by_doc = (
        found.join(attempts, ["kind", "value"])
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"))
        .agg(F.collect_set(F.struct("kind", "value", "attempt")).alias("_later"))
    )
    by_doc = land(by_doc, "later-attempts")
    on = docs["doc_id"].eqNullSafe(by_doc["_id"]) & (F.xxhash64(docs["text"]) == by_doc["_text"])
    new = unused(docs, "_new")
    joined = docs.join(by_doc, on, "left").withColumn(new, replacing(key)(docs["text"], by_doc["_later"]))
    columns = columns_of(docs, text=F.col(f"{new}.text"))
    return joined.select(*columns, *([F.col(f"{new}.kinds").alias(kinds_column)] if kinds_column else []))

"""Deduplication, leakage, membership and response-merging plans."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import text as X

#: Characters of items' keys in one automaton, some fifty bytes of memory each.
BLOCK_CHARS = 4_000_000


def keep_first(df: DataFrame, key: Column, *order: str) -> DataFrame:
    """The first row of each key. Written as an aggregate, which combines before the shuffle, not as a window."""
    whole = F.struct(*df.columns)
    return df.groupBy(key.alias("__key")).agg(F.min_by(whole, F.struct(*order)).alias("r")).select("r.*")


def keep_last(df: DataFrame, key: Column, *order: str) -> DataFrame:
    whole = F.struct(*df.columns)
    return df.groupBy(key.alias("__key")).agg(F.max_by(whole, F.struct(*order)).alias("r")).select("r.*")


def anti_on_keys(rows: DataFrame, held: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose normalised content isn't in held: exact leakage on several columns."""
    keys = [X.normalized_key(F.col(c)) for c in columns]
    names = [f"__k{i}" for i in range(len(columns))]
    other = held.select(*[k.alias(n) for k, n in zip(keys, names)]).distinct()
    return rows.withColumns(dict(zip(names, keys))).join(other, names, "left_anti").drop(*names)


def leaked(rows: DataFrame, held: DataFrame, columns: list[str]) -> DataFrame:
    keys = [X.normalized_key(F.col(c)) for c in columns]
    names = [f"__k{i}" for i in range(len(columns))]
    other = held.select(*[k.alias(n) for k, n in zip(keys, names)]).distinct()
    return rows.withColumns(dict(zip(names, keys))).join(other, names, "left_semi").drop(*names)


def containment(docs: DataFrame, items: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id) where the document's key holds the item's; an item whose key is empty matches nothing.

    Keys of items go to the tasks as an automaton, block_chars of them at a time, and each key of a document is read once
    for all items of a block, whatever words they share. What comes out is joined with the items by the hash of their
    key, so that texts aren't moved."""
    keyed = items.select("item_id", X.normalized_key(F.col("text")).alias("item_key")).filter("item_key <> ''").withColumn("h", F.xxhash64("item_key"))
    keys = keyed.select("h", "item_key").distinct()
    parts = max(1, -(-(keys.agg(F.sum(F.length("item_key"))).first()[0] or 0) // block_chars))
    rows, out = docs.select("doc_id", X.normalized_key(F.col("text")).alias("key")), None
    kind = docs.schema["doc_id"].dataType.simpleString()
    for k in range(parts):
        sent = docs.sparkSession.sparkContext.broadcast([(r["item_key"], r["h"]) for r in keys.filter(F.pmod("h", F.lit(parts)) == k).collect()])

        def run(batches, sent=sent):
            import ahocorasick

            found = ahocorasick.Automaton()
            for key, h in sent.value:
                found.add_word(key, h)
            if sent.value:
                found.make_automaton()
            for batch in batches if sent.value else ():
                hits = [(i, h) for i, key in enumerate(batch.column(1)) for h in {h for _, h in found.iter(key.as_py())}]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i for i, _ in hits], pa.int64())), pa.array([h for _, h in hits], pa.int64())], ["doc_id", "h"])

        part = rows.mapInArrow(run, f"doc_id {kind}, h long")
        out = part if out is None else out.unionByName(part)
    return out.join(keyed.select("h", "item_id"), "h").select("doc_id", "item_id").distinct()


def split_membership(rows: DataFrame, key: str, split: str) -> DataFrame:
    return rows.groupBy(key).agg(F.array_join(F.sort_array(F.collect_set(split)), ",").alias("split_membership"))


def circular_next(rows: DataFrame, key: str, value: str, part: str) -> DataFrame:
    """Each row's value and that of the next one in its part, the last one's being the first's."""
    w = W.partitionBy(part).orderBy(key)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return rows.withColumn("next_value", F.coalesce(F.lead(value).over(w), F.first(value).over(whole)))


def latest_responses(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """The last record of each id, in the order of the requests; ids without a request come after, as first seen."""
    last = responses.groupBy("id").agg(F.max_by(F.struct("status", "request_hash"), "file_pos").alias("r"), F.min("file_pos").alias("first_seen"))
    return last.join(requests.select("id", "request_pos"), "id", "left").select("id", "r.status", "r.request_hash", "request_pos", "first_seen")


def successful(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """Responses that succeeded for the request as it is now."""
    return responses.filter("status = 'success'").join(requests.select("id", F.col("request_hash").alias("wanted")), "id").filter("request_hash = wanted").drop("wanted")


def pending(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests without a successful response of their hash."""
    done = responses.filter("status = 'success'").select("id", "request_hash").distinct()
    return requests.join(done, ["id", "request_hash"], "left_anti")


def replace_where(rows: DataFrame, new: DataFrame, key: str, column: str, where: Column) -> DataFrame:
    """Rows with column replaced by new's (one row a key) where the predicate holds and new has the key."""
    other = new.select(F.col(key).alias("__k"), F.col(column).alias("__new"))
    joined = rows.join(other, F.col(key) == F.col("__k"), "left")
    return joined.withColumn(column, F.when(where & F.col("__new").isNotNull(), F.col("__new")).otherwise(F.col(column))).drop("__k", "__new")


def checked_pairs(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Gold and predictions by id, one to one: repeated or missing predictions raise."""
    twice = predictions.groupBy("id").count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"repeated predictions: {[r['id'] for r in twice]}")
    missing = gold.join(predictions, "id", "left_anti").select("id").limit(5).collect()
    if missing:
        raise ValueError(f"missing predictions: {[r['id'] for r in missing]}")
    return gold.join(predictions, "id")


def assert_unique(df: DataFrame, key: str) -> None:
    n = df.agg(F.count("*").alias("n"), F.countDistinct(key).alias("d"), F.count_if(F.trim(F.col(key).cast("string")) == "").alias("blank")).first()
    if n["n"] != n["d"] or n["blank"]:
        raise ValueError(f"{key}: {n['n']} rows, {n['d']} ids, {n['blank']} blank")

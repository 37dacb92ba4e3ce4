"""Mixing sources to target weights.

Tokens are summed for each source; the budget is shared by weight with no source above `most` times its size; each
document is then taken floor(rate) times, plus one copy with probability equal to the fraction, drawn from a hash of
the seed, the document's id, source and text. All of it is DataFrame expressions. What is shuffled is one partial sum for
each source and task, and eight bytes a document to find rows that are equal in all three; only those rows, numbered
among their equals so that each has a draw of its own, are shuffled themselves, dealt by the task they were read in.
The documents are joined with one row for each source.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, the last in order; a
null doc_id is drawn as the id ''; rows equal in id, source and text are drawn by their number among them, whichever is first;
an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.scratch import saved

WORD = r"[^\x20\x09-\x0D]+"
#: A table of sources up to this many rows is sent to every executor; a larger one is joined by shuffle.
BROADCAST_SOURCES = 100_000
#: So many marks of repeated rows, eight bytes each.
BROADCAST_MARKS = 1_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest(doc_id: Column, source: Column, text: Column, seed: int) -> Column:
    """A hash of seed, id, source and text: the same on every run and every engine."""
    parts = [F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(F.concat(F.lit("="), source), F.lit("")), F.md5(F.coalesce(text, F.lit("")))]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def uniform(digest_: Column, number: Column) -> Column:
    """A number in [0, 1) from a digest, and from its own hash with the number where that isn't 0."""
    own = F.when(number == 0, digest_).otherwise(F.md5(F.concat(digest_, F.lit(":"), number.cast("string"))))
    return F.conv(F.substring(own, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def numbered(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """rows (digest, size, ...) with `number`: 0, 1, ... among rows of equal digest and size over 0. marks: (mark) of
    all rows with such a size, xxhash64 of the digest."""
    again = saved(marks.groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("mark").alias("__mark")), "repeated")
    n = again.count()
    if not n:
        return rows.withColumn("number", F.lit(0).cast("long"))
    again = F.broadcast(again) if n <= BROADCAST_MARKS else again
    own = (F.col("size") > 0) & (F.xxhash64("digest") == F.col("__mark"))
    rows = rows.withColumn("part", F.spark_partition_id())
    single = rows.join(again, own, "left_anti").drop("part").withColumn("number", F.lit(0).cast("long"))
    # A number is the place within the reading task plus what the tasks before have: no task gets all equal rows.
    part = rows.join(again, own, "left_semi")
    sums = saved(part.groupBy("digest", "part").agg(F.count("*").alias("m")), "parts")
    before = sums.select(F.col("digest").alias("__d"), F.col("part").alias("__p"), (F.sum("m").over(W.partitionBy("digest").orderBy("part")) - F.col("m")).alias("before"))
    place = F.row_number().over(W.partitionBy("digest", "part").orderBy("size")) - 1
    several = part.withColumn("place", place).join(before, (F.col("digest") == F.col("__d")) & (F.col("part") == F.col("__p")))
    return single.unionByName(several.withColumn("number", F.col("before") + F.col("place")).drop("part", "place", "before", "__d", "__p"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], budget: float, most: float) -> DataFrame:
    """sizes: (source, source_size), one row a source. Adds weight and target.

    Sharing what is above a cap among the others until none is above ends at a level L with
    target = min(cap, L * weight). With the sources in order of cap / weight the capped ones come first, so L follows
    from running sums over the table of sources (one small row each)."""
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    n = len(weights)
    ranked = sizes.withColumn("place", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % n + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("place"))
    upto, every = fill.rowsBetween(W.unboundedPreceding, W.currentRow), W.partitionBy()
    level = (F.sum("source_size").over(every) * F.lit(float(budget)) - (F.sum("cap").over(upto) - F.col("cap"))) / (
        F.sum("weight").over(every) - (F.sum("weight").over(upto) - F.col("weight"))
    )
    ranked = ranked.withColumn("level", level)
    open_ = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))
    first = F.first(open_, ignorenulls=True).over(fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return ranked.withColumn("level", first).select(
        "source", "source_size", F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap")).alias("target")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, most: float = 2.0, seed: int = 42) -> DataFrame:
    """One row for each document: its columns in the struct `row`, and size, source_size, target, rate, copies."""
    size, key = word_count(F.col("text")), digest(F.col("doc_id"), F.col("source"), F.col("text"), seed)
    rows = docs.select(F.struct("*").alias("row"), F.col("source").alias("source"), size.alias("size"), key.alias("digest"))
    narrow = saved(docs.select("source", size.alias("size"), F.xxhash64(key).alias("mark")), "sizes")
    sizes = saved(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    few = sizes.count() <= BROADCAST_SOURCES
    targets = source_targets(sizes, weights, budget, most).withColumnRenamed("source", "of_source")
    rows = numbered(rows, narrow.filter("size > 0").select("mark"))
    joined = rows.join(F.broadcast(targets) if few else targets, F.col("source").eqNullSafe(F.col("of_source")))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    joined = joined.withColumn("rate", rate)
    extra = (uniform(F.col("digest"), F.col("number")) < F.col("rate") - F.floor("rate")).cast("long")
    return joined.select("row", "size", "source_size", "target", "rate", (F.floor("rate") + extra).alias("copies"))


def take(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document repeated as often as it is taken, with the columns of docs."""
    mixed = mix(docs, **options).filter("copies > 0 AND size > 0")
    return mixed.select(F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))), "row").select("row.*")


def op1_source_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs.select("doc_id", "source", "text")).select(
        F.col("row")["doc_id"].alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce('=' || source, '') || ':' || md5(coalesce(text, ''))) AS digest, row_number() OVER (PARTITION BY doc_id, source, text) - 1 AS number FROM documents
), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM s
), w AS (SELECT *, CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS cap FROM r
), l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - (sum(cap) OVER u - cap)) / (sum(weight) OVER () - (sum(weight) OVER u - weight)) AS level
  FROM w WINDOW u AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), f AS (SELECT level AS final FROM l WHERE cap > level * weight ORDER BY cap / weight, place LIMIT 1
), t AS (SELECT source, source_size, least(cap, coalesce((SELECT final FROM f) * weight, cap)) AS target FROM l
), j AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 2.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(CASE number WHEN 0 THEN digest ELSE md5(digest || ':' || number) END, 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken FROM j
"""

"""Retrieval, answer, dependency and judge metrics. Missing metrics stay null and are not averaged as zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUTOFFS = (1, 5, 10)


def unique_ids(ids: Column) -> Column:
    """As strings, without blanks and nulls, first occurrence kept."""
    return F.array_distinct(F.filter(F.transform(ids, lambda x: F.trim(x.cast("string"))), lambda x: x.isNotNull() & (x != "")))


def retrieval_metrics(retrieved: Column, gold: Column, ks: tuple[int, ...] = CUTOFFS, n: Column | None = None) -> dict[str, Column]:
    """n: the number of gold ids, where `gold` has only those that are retrieved."""
    r, g = unique_ids(retrieved), unique_ids(gold)
    n, out = F.size(g) if n is None else n, {}
    for k in ks:
        hits = F.size(F.array_intersect(F.slice(r, 1, k), g))
        out[f"recall_{k}"] = F.when(n > 0, hits / n).otherwise(0.0)
        out[f"hit_{k}"] = (hits > 0).cast("double")
        out[f"joint_recall_{k}"] = ((n > 0) & (hits == n)).cast("double")
    ranks = F.filter(F.transform(g, lambda x: F.array_position(r, x)), lambda p: p > 0)
    out["mrr"] = F.coalesce(F.lit(1.0) / F.array_min(ranks), F.lit(0.0))
    return out


def evidence_recall(retrieved: Column, evidence: Column, ks: tuple[int, ...] = CUTOFFS) -> dict[str, Column]:
    """evidence: array of arrays of documents, any of which serves; repeated entries count each."""
    r, n = unique_ids(retrieved), F.size(evidence)

    def found(k: int) -> Column:
        return F.size(F.filter(evidence, lambda e: F.arrays_overlap(e, F.slice(r, 1, k))))

    return {f"evidence_recall_{k}": F.when(n > 0, found(k) / n).otherwise(0.0) for k in ks}


def set_scores(predicted: Column, reference: Column) -> dict[str, Column]:
    """Exact match, precision, recall and F1 of two sets; two empty ones agree."""
    p, r = F.size(predicted), F.size(reference)
    both = F.size(F.array_intersect(predicted, reference))
    empty = (p == 0) & (r == 0)
    part = lambda n: F.when(empty, 1.0).when(n > 0, both / n).otherwise(0.0)
    return {
        "exact": ((p == r) & (both == r)).cast("double"), "precision": part(p), "recall": part(r),
        "f1": F.when(empty, 1.0).when(p + r > 0, both * 2.0 / (p + r)).otherwise(0.0),
    }


def average_metrics(scores: DataFrame, by: list[str]) -> DataFrame:
    """scores (by, metrics map) to (by, metric, value, items): means over the rows that have the metric. From explode
    Spark derives a filter on the map, and makes all metrics once more for each of its parts to evaluate that early."""
    long = scores.select(*by, F.explode_outer("metrics").alias("metric", "value")).filter("metric IS NOT NULL")
    return long.groupBy(*by, "metric").agg(F.round(F.avg("value"), 9).alias("value"), F.count("value").alias("items"))


def aggregate_scores(scores: DataFrame) -> DataFrame:
    """Overall, by source_dataset (null as 'None'), hop_count and answerable (nulls left out), in one pass."""
    keyed = scores.select(
        F.explode(
            F.array(
                F.struct(F.lit("overall").alias("by"), F.lit("all").alias("of")),
                F.struct(F.lit("source_dataset").alias("by"), F.coalesce(F.col("source_dataset"), F.lit("None")).alias("of")),
                F.struct(F.lit("hop_count").alias("by"), F.col("hop_count").cast("string").alias("of")),
                F.struct(F.lit("answerable").alias("by"), F.col("answerable").cast("string").alias("of")),
            )
        ).alias("g"),
        "metrics",
    ).filter("g.of IS NOT NULL")
    return average_metrics(keyed.select("g.by", "g.of", "metrics"), ["by", "of"])


def system_metrics(success: Column, errors: Column, steps: Column, fallback: Column, tokens: Column, latency: Column) -> dict[str, Column]:
    failed = F.size(F.coalesce(errors, F.array())) > 0
    return {
        "success": F.coalesce(success, ~failed).cast("double"), "error": failed.cast("double"), "query_count": F.size(steps).cast("double"),
        "fallback": F.coalesce(fallback, F.lit(False)).cast("double"), "tokens": tokens.cast("double"), "latency": latency.cast("double"),
    }


def majority(votes: DataFrame, by: list[str]) -> DataFrame:
    """votes (by, field, vote boolean): null with fewer than two valid votes or a tie."""
    n, yes = F.count("vote"), F.count_if(F.col("vote"))
    return votes.groupBy(*by, "field").agg(F.when((n >= 2) & (2 * yes != n), 2 * yes > n).alias("verdict"))


def consensus(verdicts: DataFrame, by: list[str]) -> DataFrame:
    """verdicts (by, field, model, verdict) of two models: agreement for each field, and coverage and disagreement."""
    each = verdicts.groupBy(*by, "field").agg(F.count("verdict").alias("n"), F.min("verdict").alias("a"), F.max("verdict").alias("b"))
    each = each.withColumn("agreed", F.when((F.col("n") == 2) & (F.col("a") == F.col("b")), F.col("a")))
    both = F.col("n") == 2
    return each.groupBy(*by).agg(
        F.count("*").alias("fields"), F.round(F.count("agreed") / F.count("*"), 9).alias("coverage"),
        F.round(F.count_if(both & F.col("agreed").isNull()) / F.count("*"), 9).alias("disagreement"), F.count_if(F.col("agreed")).alias("true_fields"),
    )


def group_advantage(rewards: DataFrame, group: str, reward: str, epsilon: float = 1e-6) -> DataFrame:
    """(reward - mean) / (std + epsilon) within a group, with the population's deviation."""
    from pyspark.sql import Window as W

    w = W.partitionBy(group)
    return rewards.withColumn("advantage", F.round((F.col(reward) - F.avg(reward).over(w)) / (F.stddev_pop(reward).over(w) + epsilon), 9))


def plan_reward(safe: Column, form: Column, executed: Column, final: Column, sub: Column) -> Column:
    return safe * (0.10 * form + 0.90 * executed * final * (0.70 + 0.30 * sub))

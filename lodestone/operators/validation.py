"""Record contracts as one array<string> column of the rules a row breaks, and checks of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.udfs import validate_plan
from lodestone.plans.chain import parsed

KNOWLEDGE = ("id", "text", "title", "source", "source_dataset", "namespace", "content_hash")
SFT = ("id", "instruction", "input", "output", "system")
MUSIQUE = "musique"


def broken(**rules: Column) -> Column:
    """Names of the rules whose condition isn't true."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name.replace("_", " "))) for name, ok in rules.items()]))


def filled(*columns: str) -> dict[str, Column]:
    return {f"blank_{c}": F.trim(F.col(c).cast("string")) != "" for c in columns}


def exact_fields(record: Column, fields: tuple[str, ...]) -> Column:
    """Whether a raw JSON object has exactly these keys; from_json would drop others silently."""
    keys = F.json_object_keys(record)
    return (F.size(keys) == len(fields)) & (F.size(F.array_except(keys, F.array(*[F.lit(f) for f in fields]))) == 0)


def hops(plan: Column) -> Column:
    return F.size(parsed(plan)["queries"])


def knowledge_errors() -> Column:
    return broken(**filled(*KNOWLEDGE))


def sft_errors() -> Column:
    return F.concat(broken(**filled(*SFT)), F.transform(validate_plan("output"), lambda e: F.concat(F.lit("plan: "), e)))


def multihop_sft_errors() -> Column:
    return F.concat(sft_errors(), broken(hop_count=F.col("hop_count") == hops(F.col("output")), prefix=F.startswith("id", F.lit("sft_")), provenance=(F.col("source_dataset") == MUSIQUE) & F.col("source_id").isNotNull()))


def dpo_errors() -> Column:
    return F.concat(
        broken(differ=F.col("chosen") != F.col("rejected"), hop_count=F.col("hop_count") == hops(F.col("chosen")), multi_source=(F.col("task_type") != "multi_hop") | (F.col("source_dataset") == MUSIQUE)),
        F.transform(validate_plan("chosen"), lambda e: F.concat(F.lit("chosen: "), e)), F.transform(validate_plan("rejected"), lambda e: F.concat(F.lit("rejected: "), e)),
    )


def grpo_errors() -> Column:
    n = F.size("gold_doc_ids")
    plan = F.transform(validate_plan("output"), lambda e: F.concat(F.lit("plan: "), e))
    return F.concat(plan, broken(plan_steps=F.col("hop_count") == hops(F.col("output")), task=F.col("task_type") == F.when(F.col("hop_count") > 1, "multi_hop").otherwise("single_hop"), namespace=F.col("namespace") == F.when(F.col("source_dataset") == MUSIQUE, "musique_aux").otherwise("policy"),
        **filled("id", "input", "reference_answer"), hop_count=F.col("hop_count").between(1, 4), hop_answers=(F.col("hop_count") == 1) | (F.size("hop_answers") == F.col("hop_count")),
        gold_documents=n > 0, distinct_documents=F.size(F.array_distinct("gold_doc_ids")) == n,
    ))


def eval_errors() -> Column:
    n = F.size("gold_doc_ids")
    return broken(**filled("id", "question"), unique_gold=F.size(F.array_distinct("gold_doc_ids")) == n, unanswerable_gold=F.col("answerable") | (n == 0), references=~F.col("answerable") | (F.size("reference_answers") > 0))


def annotation_errors() -> Column:
    """question, source_question, plan, hop_answers, evidence (texts), reference_answer, gold_doc_ids."""
    plan = F.lower("plan")
    return F.concat(
        broken(
            question_differs=F.lower(F.trim("question")) != F.lower(F.trim("source_question")),
            grounded=F.forall("hop_answers", lambda a: F.exists("evidence", lambda e: F.contains(F.lower(e), F.lower(a)))),
            distinct_documents=(F.size(F.array_distinct("gold_doc_ids")) == F.size("gold_doc_ids")) & (F.size("gold_doc_ids") >= 2),
            reference=F.exists("evidence", lambda e: F.contains(F.lower(e), F.lower("reference_answer"))),
            leaks=~F.exists("hop_answers", lambda a: F.contains(plan, F.lower(a))),
        ),
        F.transform(validate_plan("plan"), lambda e: F.concat(F.lit("plan: "), e)),
    )


def dangling_gold(records: DataFrame, knowledge: DataFrame) -> DataFrame:
    """(id, gold) that no knowledge row has."""
    return records.select("id", F.explode("gold_doc_ids").alias("gold")).join(knowledge.select(F.col("id").alias("gold")), "gold", "left_anti")


def overlaps(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """(first, second, key) that two parts share; empty where they are disjoint."""
    every = None
    for name, df in parts.items():
        mine = df.select(F.col(key).cast("string").alias("key"), F.lit(name).alias("part"))
        every = mine if every is None else every.unionByName(mine)
    found = every.groupBy("key").agg(F.sort_array(F.collect_set("part")).alias("parts"))
    return found.filter(F.size("parts") > 1)


def distribution_errors(rows: DataFrame, by: str, expected: dict[str, int]) -> DataFrame:
    wanted = rows.sparkSession.createDataFrame(list(expected.items()), "value string, expected long")
    have = rows.groupBy(F.col(by).cast("string").alias("value")).agg(F.count("*").alias("found"))
    return wanted.join(have, "value", "full").filter(~F.col("expected").eqNullSafe(F.col("found")))

"""Scores of predictions against gold records, by task. One row stays one row: steps are scored with array functions,
so nothing is exploded or shuffled but the join by id. A metric that doesn't apply is missing from the map.

gold: id, source_dataset, hop_count (null: not several steps), answerable, gold_doc_ids, evidence_doc_ids (array of
arrays), references (array), reference_plan, reference_steps (array of (id, query, gold_doc_id, answer, aliases)).
predictions: id, success, errors (array), fallback, tokens (map), latency (map), evidence (array of ids), answer,
said_answerable, plan (JSON text), steps (array of (status, answer, evidence))."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.functions.udfs import nfkc, nfkc_each, validate_plan
from lodestone.operators import metrics
from lodestone.operators.relational import checked_pairs
from lodestone.plans import chain

Metrics = dict[str, Column]


def named(values: Metrics, prefix: str = "") -> Metrics:
    """Names as reported: a cut-off stands after an @."""
    parts = {n: n.rsplit("_", 1) for n in values}
    return {prefix + ("@".join(p) if p[-1].isdigit() else n): values[n] for n, p in parts.items()}


def as_map(values: Metrics) -> Column:
    every = F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*[v.cast("double") for v in values.values()]))
    return F.map_filter(every, lambda k, v: v.isNotNull())


def answer_scores(answer: Column, references: Column) -> Metrics:
    return {"exact_match": X.best_of(X.exact_match, answer, references), "token_f1": X.best_of(X.token_f1, answer, references)}


def system() -> Column:
    """Success, cost and time, for every task."""
    failed = F.size(F.coalesce("errors", F.array().cast("array<string>"))) > 0
    planned = F.size(F.coalesce(chain.parsed(F.col("plan"))["queries"], F.array().cast("array<struct<id:string,query:string,depends_on:array<string>>>")))
    made = F.size(F.coalesce("steps", F.array().cast("array<struct<status:string,answer:string,evidence:array<string>>>")))
    fixed = {"inference_success": F.coalesce("success", ~failed), "query_count": F.when(made > 0, made).otherwise(planned), "fallback_rate": F.coalesce("fallback", F.lit(False)), "error_rate": failed}
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    tokens = F.map_filter(F.coalesce("tokens", empty), lambda k, v: k.isin("prompt_tokens", "completion_tokens", "total_tokens") & v.isNotNull())
    times = F.transform_keys(F.map_filter(F.coalesce("latency", empty), lambda k, v: v.isNotNull()), lambda k, v: F.concat(F.lit("latency_"), k, F.lit("_seconds")))
    return F.map_concat(as_map(fixed), tokens, times)


def rag() -> Column:
    """Documents and evidence only where there is gold, the answer only where there is one to give."""
    has, can = F.size(F.coalesce("gold_doc_ids", F.array().cast("array<string>"))) > 0, F.coalesce("answerable", F.lit(True))
    found = F.coalesce("evidence", F.array().cast("array<string>"))
    evidence = F.coalesce("evidence_doc_ids", F.transform("gold_doc_ids", lambda d: F.array(d)))
    out = {n: F.when(has, c) for n, c in named(metrics.retrieval_metrics(found, F.col("gold_doc_ids")), "doc_").items()}
    out |= {n: F.when(has, c) for n, c in named(metrics.evidence_recall(found, evidence)).items()}
    covered = F.coalesce("success", F.lit(False))
    out["answerability_coverage"] = covered
    out["answerability_accuracy"] = F.when(covered, (X.infer_answerable(F.col("said_answerable"), F.col("answer")) == can).cast("double"))
    return as_map(out | {f"answer_{n}": F.when(can, c) for n, c in answer_scores(F.col("answer"), F.col("references")).items()})


def step_scores() -> Column:
    """One struct for each reference step, against the predicted query and step in the same place."""

    def one(step: Column, i: Column) -> Column:
        said, query = F.get("steps", i), F.coalesce(F.get("queries", i)["query"], F.lit(""))
        hits = metrics.retrieval_metrics(F.coalesce(said["evidence"], F.array().cast("array<string>")), F.array(step["gold_doc_id"]))
        answers = F.concat(F.array(step["answer"]), F.coalesce(step["aliases"], F.array().cast("array<string>")))
        scores = {"query_exact_match": X.exact_match(query, step["query"]), "query_token_f1": X.token_f1(query, step["query"])}
        scores |= {f"intermediate_answer_{n}": c for n, c in answer_scores(said["answer"], answers).items()} | {f"hop_{n}": c for n, c in hits.items()}
        return F.struct(step["id"].alias("id"), F.coalesce(said["status"], F.lit("missing")).alias("status"), step["gold_doc_id"].alias("gold_doc_id"), *[c.alias(n) for n, c in scores.items()])

    return F.transform("reference_steps", one)


STEP_MEANS = ("query_exact_match", "query_token_f1", "intermediate_answer_exact_match", "intermediate_answer_token_f1")


def multihop() -> Column:
    """Plan, steps and final answer; a plan that breaks the contract counts as none. Needs valid, queries, per_step."""
    mean = lambda n: F.coalesce(F.aggregate(F.col("per_step")[n], F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size("per_step"), F.lit(0)), F.lit(0.0))
    hits = ["mrr", *[f"{kind}_{k}" for k in metrics.CUTOFFS for kind in ("recall", "hit", "joint_recall")]]
    out = {"json_parse": F.try_parse_json("plan").isNotNull(), "schema_valid": F.col("valid"), "hop_count_accuracy": F.size("queries") == F.col("hop_count")}
    mine = chain.edges(F.when(F.col("valid"), F.col("plan")))
    names = {"exact": "dependency_exact_match", "precision": "dependency_precision", "recall": "dependency_recall", "f1": "dependency_f1"}
    out |= {names[n]: c for n, c in metrics.set_scores(mine, chain.edges(F.col("reference_plan"))).items()}
    out |= {n: mean(n) for n in STEP_MEANS} | named({f"hop_{n}": mean(f"hop_{n}") for n in hits})
    whole = {f"joint_recall_{k}": (F.size("per_step") > 0) & F.forall(F.col("per_step")[f"hop_joint_recall_{k}"], lambda x: x == 1.0) for k in metrics.CUTOFFS}
    return as_map(out | named(whole) | {f"final_answer_{n}": c for n, c in answer_scores(F.col("answer"), F.col("references")).items()})


def score(gold: DataFrame, predictions: DataFrame, check: bool = True) -> DataFrame:
    """(id, source_dataset, hop_count, answerable, metrics map, per_step). Repeated or missing predictions raise if check."""
    pairs = checked_pairs(gold, predictions) if check else gold.join(predictions, "id")
    pairs = pairs.withColumn("valid", F.col("plan").isNotNull() & (F.size(validate_plan("plan")) == 0))
    pairs = pairs.withColumns({"answer": nfkc("answer"), "references": nfkc_each("references")})
    none = F.array().cast("array<struct<id:string,query:string,depends_on:array<string>>>")
    several = (F.col("source_dataset") == "musique") | F.col("hop_count").isNotNull()
    pairs = pairs.withColumns({"several": F.coalesce(several, F.lit(False)), "queries": F.when(F.col("valid"), F.coalesce(chain.parsed(F.col("plan"))["queries"], none)).otherwise(none)})
    pairs = pairs.withColumn("per_step", F.when(F.col("several"), step_scores()))
    return pairs.select("id", "source_dataset", "hop_count", "answerable", F.map_concat(system(), F.when(F.col("several"), multihop()).otherwise(rag())).alias("metrics"), "per_step")

import json
import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lodestone.functions import text as X
from lodestone.functions import udfs as U
from lodestone.operators import chunking, datasets, metrics, relational, retrieval, sampling, scoring, validation
from lodestone.plans import chain
from lodestone.sources import files
from lodestone.streaming import resume


def value(spark, column, **row):
    df = spark.createDataFrame([tuple(row.values())], list(row)) if row else spark.range(1)
    return df.select(column.alias("v")).first()["v"]


def test_text_scalars(spark):
    assert value(spark, X.normalize_text(F.lit("  it’s\nvalid  "))) == "it's valid"
    assert value(spark, X.normalized_key(F.lit("Gary Cherone?"))) == value(spark, X.normalized_key(F.lit("gary-cherone")))
    a, b = (value(spark, X.stable_hash(F.lit(p), F.lit(q))) for p, q in (("a", "b"), ("b", "a")))
    assert a != b and len(a) == 16
    assert value(spark, X.clean_intermediate_answer(F.lit("Miquette [1, 2]"))) == "Miquette"
    assert value(spark, X.format_embedding_text(F.lit("Policy title"), F.lit("Policy body"))) == "Policy title\n\nPolicy body"
    assert value(spark, X.strip_code_fence(F.lit("```json\n{}\n```"))) == "{}"


def test_answers(spark):
    assert value(spark, X.exact_match(F.lit("The Lisbon!"), F.lit("lisbon"))) == 1
    assert abs(value(spark, X.token_f1(F.lit("central Atlantic"), F.lit("central Atlantic Ocean"))) - 0.8) < 1e-9
    assert value(spark, X.token_f1(F.lit(""), F.lit("the"))) == 1
    assert value(spark, X.best_of(X.exact_match, F.lit("ITF"), F.array(F.lit("x"), F.lit("ITF")))) == 1


def test_retrieval_metrics(spark):
    ids = lambda *x: F.array(*map(F.lit, x))
    m = {k: value(spark, c) for k, c in metrics.retrieval_metrics(ids("a", "a", "x", "b"), ids("a", "b")).items()}
    assert (m["recall_1"], m["recall_5"], m["joint_recall_1"], m["joint_recall_5"], m["mrr"]) == (0.5, 1, 0, 1, 1)
    e = metrics.evidence_recall(ids("a"), F.array(ids("a"), ids("a"), ids("b")))
    assert abs(value(spark, e["evidence_recall_1"]) - 2 / 3) < 1e-9
    d = {k: value(spark, c) for k, c in metrics.set_scores(ids("q1>q2", "q1>q3"), ids("q1>q2", "q2>q3")).items()}
    assert d == {"exact": 0, "precision": 0.5, "recall": 0.5, "f1": 0.5}


@pytest.mark.parametrize(
    ("steps", "error"),
    [
        ([("q1", "first query", [])], None), ([("q1", "first query", []), ("q2", "{{q1.answer}} rules", ["q1"])], None), ([("q1", "{{q2.answer}} rules", ["q2"])], "earlier query"),
        ([("q1", "first", []), ("q3", "third", [])], "sequential"), ([("q1", "ab", [])], "query"), ([("q1", "{{q1.answer}} of", [])], "placeholders"),
    ],
)
def test_plan_rules(steps, error):
    plan = json.dumps({"queries": [dict(zip(("id", "query", "depends_on"), s)) for s in steps]})
    found = U.plan_errors(plan)
    assert error in found if error else found == []
    assert U.plan_errors('{"queries":[]} trailing') == ["json"]


def test_decomposition():
    two = U.decomposed_plan(["The Collegian >> owned by", "When was #1 founded?"])["queries"]
    assert two[1] == {"id": "q2", "query": "When was {{q1.answer}} founded?", "depends_on": ["q1"]}
    nine = U.decomposed_plan(["#9 Dream >> performer", "#1 >> father"])["queries"]
    assert nine[0]["query"] == "#9 Dream performer" and nine[1]["depends_on"] == ["q1"]


@pytest.mark.parametrize("error", U.MULTIHOP_ERRORS)
def test_rejected_plans_are_valid_and_differ(error):
    plan = json.dumps(U.decomposed_plan(["Who owns The Collegian newspaper", "When was #1 founded"]), separators=(",", ":"))
    bad = U.rejected_plan(plan, error)
    assert bad != plan and U.plan_errors(bad) == []


def test_chunker_and_evidence(spark):
    contents = ["<h1>Eligibility</h1>", "<p>You must work for your employer for at least 26 weeks.</p>"]
    docs = spark.createDataFrame([("u", "Paternity Leave", contents)], ["url", "title", "contents"])
    chunks = chunking.chunk(docs)
    assert [r.text for r in chunks.collect()] == ["Eligibility You must work for your employer for at least 26 weeks."]
    evidence = spark.createDataFrame([(1, "u", contents[1]), (2, "u", "zzz qqq"), (3, "u", " <p> </p>"), (4, "u", None)], "evidence_id int, url string, evidence string")
    got = {r.evidence_id: r.score for r in chunking.map_evidence(evidence, chunks).collect()}
    assert got == {1: 2.0, 2: None, 3: None, 4: None}
    row = chunks.first()
    assert len(row.content_hash) == 64 and len(row.id) == len("policy_") + 16


def test_page_blocks_keep_all_text():
    page = "<html><head><title>x</title></head><body>before<h1>A &amp; B</h1>tail<div>in <b>div</b><p>one</p>after</div><ul><li>item<li>next</ul><table><tr><td>cell</td></tr></table><blockquote>said</blockquote>end</body></html>"
    assert chunking.page_blocks(page) == [
        "<p>before</p>", "<h1>A &amp; B</h1>", "<p>tail</p>", "<p>in div</p>", "<p>one</p>", "<p>after</p>", "<li>item</li>", "<li>next</li>", "<p>cell</p>", "<p>said</p>", "<p>end</p>",
    ]
    assert chunking.page_blocks(None) == []


def test_containment_of_short_and_hyphenated_items(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight"), (2, "gary-cherone sang one song for all of us"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(10, "three four five"), (11, "gary cherone sang one song for all"), (12, "Three-four FIVE"), (13, "?"), (14, None)], "item_id long, text string")
    for block in (1_000_000, 5):
        assert {tuple(r) for r in relational.containment(docs, items, block).collect()} == {(1, 10), (1, 12), (2, 11)}


def test_compatible_forms_and_folding(spark):
    gold = spark.createDataFrame([("ﬁne",)], ["t"]).select(U.nfkc("t").alias("t"))
    assert gold.select(X.exact_match(F.col("t"), F.lit("fine"))).first()[0] == 1
    letters = "".join(chr(c) for c in range(0xC0, 0x180) if chr(c).isalpha())
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE d USING fts5(t, tokenize='unicode61')")
    db.execute("CREATE VIRTUAL TABLE v USING fts5vocab(d, 'row')")
    db.executemany("INSERT INTO d(t) VALUES (?)", [(f"x{c}x",) for c in letters])
    want = {r[0] for r in db.execute("SELECT term FROM v")}
    got = {t for r in spark.createDataFrame([(f"x{c}x",) for c in letters], ["t"]).select(X.index_terms(F.col("t")).alias("w")).collect() for t in r.w}
    assert got == want
    assert value(spark, X.index_terms(F.lit("Málaga està à Côte"))) == ["malaga", "esta", "a", "cote"]


@pytest.mark.parametrize(
    ("content", "plan"),
    [
        ('{"queries": ["ask this"]}', [("q1", "ask this", [])]), ('{"q1": "ask", "depends_on": ["q0"]}', [("q1", "ask", ["q0"])]), ('```json\n{"query": "ask"}\n```', [("q1", "ask", [])]),
        ('{"queries": [{"id": "q1", "query": "a", "depends_on": []}, {"id": "q2", "query": "b", "depends_on": ["q1"]}]}', [("q1", "a", []), ("q2", "b", ["q1"])]),
        ('{"queries": {"q1": "ask"}}', [("q1", "ask", [])]), ('{"queries": [{"q1": "ask"}]}', [("q1", "ask", [])]), ('{"query": "ask", "more": 1}', None), ("[1]", None), ("no", None), ('{"query": 3}', None),
    ],
)
def test_loose_plans(content, plan):
    found = U.loose_plan(content)
    assert found == (plan and {"queries": [dict(zip(("id", "query", "depends_on"), s)) for s in plan]})


def test_placeholders_are_written_without_blanks():
    plan = {"queries": [{"id": "q1", "query": "first query", "depends_on": []}, {"id": "q2", "query": "of {{ q1.answer }} and {{q1.answer}}", "depends_on": ["q1"]}]}
    assert U.plan_errors(json.dumps(plan)) == ["placeholders"]
    plan["queries"][1]["query"] = "of {{q1.answer}}"
    assert U.plan_errors(json.dumps(plan)) == []


def test_entities_are_measured_without_signs():
    assert U.without_entity("when did A.B. meet Paris again") == "when did A.B. meet again" and U.without_entity("one two Three") == "one two Three"
    assert U.without_entity("what is the longestword here") == "what is the here"


def test_request_hash_knows_nulls(spark):
    rows = spark.createDataFrame([("a", None, "x"), ("a", "x", None)], "id string, p string, q string")
    hashes = [r.request_hash for r in datasets.hashed(rows).collect()]
    assert hashes[0] != hashes[1]


def test_chunk_rules():
    long = ["<h2>A</h2>", "<h4>B</h4>", f"<p>{'x' * 900}</p>", f"<p>{'y' * 900}</p>", f"<p>{'x' * 900}</p>", "<p>éé</p>", "<h5>tail</h5>"]
    rows = chunking.chunk_document("u", "t", long)
    assert len(rows) == 2 and rows[0][5] == ["A", "B"] and rows[1][2].endswith("tail") and rows[1][6] == [3, 6]
    merged = chunking.chunk_document("u", "t", ["<h1>A</h1>", f"<p>{'x' * 300}</p>", "<h1>B</h1>", "<p>short</p>"])
    assert len(merged) == 1 and merged[0][6] == [1, 3]


def test_bm25_matches_sqlite(spark):
    rows = [(1, "Child Tax Credit", "Existing Working Tax Credit claims may continue."), (2, "Universal Credit", "Apply for Universal Credit when a new tax claim is unavailable."), (3, "Pension", "Support for people over State Pension age."), (4, "Café", "A café and nothing else")]
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE d USING fts5(id UNINDEXED, title, text, tokenize='unicode61')")
    db.executemany("INSERT INTO d(rowid, title, text) VALUES (?, ?, ?)", rows)
    want = db.execute('SELECT rowid, bm25(d, 0.0, 2.0, 1.0) FROM d WHERE d MATCH \'"universal" OR "pension" OR "cafe"\' ORDER BY 2, 1').fetchall()
    docs = spark.createDataFrame(rows, ["doc_pos", "title", "text"])
    got = [(r.doc_pos, r.score) for r in retrieval.bm25_search(docs, ["universal", "pension", "cafe"]).collect()]
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(abs(g[1] - w[1]) < 1e-8 for g, w in zip(got, want))


def test_fusion(spark):
    r = spark.createDataFrame([(0, 1), (1, 2), (1, 1), (2, 2)], ["doc_pos", "rank"])
    top = retrieval.fused_top(r).collect()
    assert [t.doc_pos for t in top] == [1, 0, 2] and abs(top[0].score - (1 / 62 + 1 / 61)) < 1e-9
    with pytest.raises(ValueError):
        retrieval.reciprocal_rank_fusion(r, 0)
    c = spark.createDataFrame([("r", 0, "a", 1), ("r", 0, "b", 2), ("r", 1, "c", 1), ("r", 1, "d", 2)], ["record_id", "step_pos", "doc", "rank"])
    assert chain.fuse_chain(c).first().evidence == ["a", "c", "b", "d"]


def test_chain_skips_dependents_of_failures(spark):
    plan = json.dumps(U.decomposed_plan(["first entity", "#1 second fact", "third thing"]))
    records = spark.createDataFrame([("good", plan), ("bad", plan), ("invalid", "{}")], ["record_id", "plan"])
    found = lambda ask: ask.filter("NOT (record_id = 'bad' AND step_id = 'q1')").select("record_id", F.array(F.col("step_id"), F.lit("x")).alias("evidence"))
    said = lambda ask: ask.select("record_id", F.concat(F.col("query"), F.lit("! [1]")).alias("answer"))
    got = {r.record_id: r for r in chain.execute(records, found, said, U.validate_plan).collect()}
    assert got["good"].steps == "q1:completed,q2:completed,q3:completed" and got["good"].answer == "third thing!"
    assert got["bad"].steps == "q1:failed,q2:skipped,q3:completed" and got["bad"].answer is None
    assert not got["invalid"].valid and got["invalid"].evidence is None


def test_samples_are_disjoint_and_repeat(spark):
    rows = spark.createDataFrame([(f"{h}-{i}", str(h)) for h in (2, 3, 4) for i in range(10)], ["id", "hop"])
    cut = lambda: sampling.disjoint_allocation(rows, "hop", "id", {"cold": dict.fromkeys("234", 2), "dpo": dict.fromkeys("234", 1)}, 6, "grpo", 1)
    a, b = ({(r.id, r.part) for r in cut().collect()} for _ in range(2))
    parts = [p for _, p in a]
    assert a == b and len({i for i, _ in a}) == len(a) == 15 and (parts.count("cold"), parts.count("dpo"), parts.count("grpo")) == (6, 3, 6)
    assert sampling.stratified_sample(rows, F.col("hop"), "id", 7).count() == 7


def test_judge(spark):
    votes = [("j", "f", m, v) for m, vs in ((1, (True, False, True)), (2, (True, True, True))) for v in vs] + [("j", "g", 1, True), ("j", "g", 2, None), ("j", "g", 1, False)]
    df = spark.createDataFrame(votes, "id string, field string, model int, vote boolean")
    row = metrics.consensus(metrics.majority(df, ["id", "model"]), ["id"]).first()
    assert (row.fields, row.coverage, row.true_fields) == (2, 0.5, 1)


def test_averages_leave_missing_out(spark):
    df = spark.createDataFrame([("a", 2, True, {"m": 1.0}), (None, None, None, {"n": 0.0, "m": 0.0})], "source_dataset string, hop_count int, answerable boolean, metrics map<string,double>")
    got = {(r["by"], r["of"], r["metric"]): (r["value"], r["items"]) for r in metrics.aggregate_scores(df).collect()}
    assert got["overall", "all", "m"] == (0.5, 2) and got["overall", "all", "n"] == (0, 1)
    assert ("source_dataset", "None", "n") in got and ("answerable", "true", "m") in got and not any(k[1] is None for k in got)


def test_relations(spark):
    gold = spark.createDataFrame([("1",), ("2",)], ["id"])
    with pytest.raises(ValueError, match="missing"):
        relational.checked_pairs(gold, spark.createDataFrame([("1", 0)], ["id", "p"]))
    with pytest.raises(ValueError, match="repeated"):
        relational.checked_pairs(gold, spark.createDataFrame([("1", 0), ("1", 1)], ["id", "p"]))
    responses = spark.createDataFrame([("third", "success", "h", 0), ("first", "invalid", "h", 1), ("second", "success", "old", 2), ("first", "success", "h", 3)], ["id", "status", "request_hash", "file_pos"])
    requests = spark.createDataFrame([("first", "h", 0), ("second", "h", 1), ("third", "h", 2)], ["id", "request_hash", "request_pos"])
    assert [r.id for r in relational.latest_responses(responses, requests).orderBy("request_pos").collect()] == ["first", "second", "third"]
    assert [r.id for r in relational.pending(requests, responses).collect()] == ["second"]
    parts = validation.overlaps({"a": gold, "b": gold.limit(1)}, "id")
    assert parts.count() == 1


def test_record_rules(spark):
    plan = json.dumps({"queries": [{"id": "q1", "query": "some query", "depends_on": []}]})
    df = spark.createDataFrame([("1", "i", "in", plan, "s"), ("2", " ", "in", "{", "s")], list(validation.SFT))
    assert [r.e for r in df.select(validation.sft_errors().alias("e")).collect()] == [[], ["blank instruction", "plan: json"]]
    a = spark.createDataFrame([("new question", "old question", plan, ["grant"], ["A grant"], "grant", ["d1", "d2"])], ["question", "source_question", "plan", "hop_answers", "evidence", "reference_answer", "gold_doc_ids"])
    assert a.select(validation.annotation_errors().alias("e")).first().e == []
    assert "leaks" in a.withColumn("plan", F.replace("plan", F.lit("some"), F.lit("grant"))).select(validation.annotation_errors().alias("e")).first().e


def test_files_and_streams(spark, tmp_path):
    p = tmp_path / "rows.jsonl"
    p.write_text('{"a": 0}\n\n{"a": 1}\n{"a": 2}\n')
    assert [r.a for r in files.read_bounded_jsonl(spark, str(p), "a int", limit=2).collect()] == [0, 1]
    with pytest.raises(ValueError, match="exceeds 2"):
        files.read_bounded_jsonl(spark, str(p), "a int", most=2)
    files.write_json(spark, str(tmp_path / "x.json"), {"é": 1})
    assert json.loads((tmp_path / "x.json").read_text()) == {"é": 1}
    docs = spark.createDataFrame([(0, "a", "one"), (1, "b", "two"), (2, "c", "three")], "doc_pos long, id string, text string")
    store = str(tmp_path / "store")
    assert resume.embed_missing(docs.limit(2), store, resume.hashed_embedding) == 2
    assert resume.embed_missing(docs, store, resume.hashed_embedding) == 1
    (tmp_path / "in").mkdir()
    for n in range(2):
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps({"id": str(n), "plan": "{}"}) + "\n")
        resume.ingest_plans(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["0", "1"]


SMALL = "/root/testdata/sf0.001"


def test_training_sets(spark):
    from lodestone import registry as r

    d = r.dpo_records(spark, SMALL).withColumn("errors", validation.dpo_errors()).cache()
    assert d.filter(F.size("errors") > 0).count() == 0
    kinds = {x["error_type"]: x["n"] for x in d.filter("source_dataset = 'qrecc'").groupBy("error_type").agg(F.count("*").alias("n")).collect()}
    assert set(kinds) == set(U.SINGLE_ERRORS) and max(kinds.values()) - min(kinds.values()) <= 1
    assert {x["error_type"] for x in d.filter("source_dataset = 'musique'").collect()} == set(U.MULTIHOP_ERRORS)
    s = r.sft_records(spark, SMALL)
    datasets.checked(s, validation.sft_errors())
    datasets.checked(r.multihop_sft_records(spark, SMALL), validation.multihop_sft_errors())
    g = r.grpo_records(spark, SMALL)
    datasets.checked(g, validation.grpo_errors())
    assert g.filter("task_type = 'single_hop' AND source_id % 3 = 0").count() == 0
    with pytest.raises(ValueError, match="broken records"):
        datasets.checked(s.withColumn("output", F.lit("{}")), validation.sft_errors())


def test_requests_and_merge(spark):
    from lodestone import registry as r

    q = r.generation_requests(spark, SMALL).cache()
    assert q.select("id").distinct().count() == q.count() and q.filter("request_hash IS NULL").count() == 0
    assert {x["n"] for x in q.filter("stage = 'grpo'").groupBy("source_id").agg(F.count("*").alias("n")).collect()} == {1, 2}
    rows = spark.createDataFrame([("a", "conditionalqa", "1", "old"), ("b", "qrecc", "2", "old")], "id string, source_dataset string, source_id string, output string")
    new = spark.createDataFrame([("1", "x", 0), ("1", "new", 1), ("2", "new", 2)], "source_id string, parsed_output string, file_pos int")
    assert {x["id"]: x["output"] for x in datasets.merged_sft(rows, new).collect()} == {"a": "new", "b": "old"}


def test_rejected_queries(spark):
    def bad(error, chosen, question="and then", title=None):
        return value(spark, datasets.rejected_query(F.lit(error), F.lit(chosen), F.lit(question), F.lit(title).cast("string"), F.lit("elsewhere")))

    chosen = "When did Paris host 3 large games"
    assert bad("unresolved_reference", chosen) == "and then" and bad("wrong_context", chosen) == "elsewhere"
    assert bad("entity_omission", chosen) == "When did host 3 large games" and bad("constraint_omission", chosen) == "When did Paris host large games"
    assert bad("overly_broad", chosen) == "General background information" and bad("overly_broad", chosen, title="T") == "General information about T"
    assert bad("unresolved_reference", chosen, question=chosen) == "General information When did Paris"


def test_scores_by_task(spark):
    from lodestone import registry as r

    gold, predictions = r._judged(spark, SMALL)
    rows = {x["id"]: x for x in scoring.score(gold, predictions).collect()}
    whole = next(x for k, x in rows.items() if k[0] == "m" and int(k[1:]) % 4 == 0)["metrics"]
    assert all(whole[n] == 1 for n in ("json_parse", "schema_valid", "hop_count_accuracy", "dependency_f1", "query_exact_match", "joint_recall@1", "hop_mrr", "final_answer_token_f1", "inference_success"))
    short = next(x for k, x in rows.items() if k[0] == "m" and int(k[1:]) % 4 == 1)
    assert short["metrics"]["hop_count_accuracy"] == 0 and short["metrics"]["query_exact_match"] < 1 and short["per_step"][0]["status"] == "success"
    failed = next(x for k, x in rows.items() if k[0] == "p" and int(k[1:]) % 4 == 3)["metrics"]
    assert failed["error_rate"] == 1 and failed["inference_success"] == 0 and failed["answerability_coverage"] == 0 and "answerability_accuracy" not in failed
    assert failed["doc_recall@1"] == 0.5 and "latency_total_seconds" in failed and "json_parse" not in failed
    none = next(x for x in rows.values() if x["source_dataset"] == "conditionalqa" and not x["answerable"])["metrics"]
    assert "answer_token_f1" not in none and "doc_mrr" in none


def test_dense_search_by_blocks_equals_one_by_one(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)] + [(400, None), (401, [1.0, float("nan")] * 3), (402, [1.0, 2.0]), (403, [None, 1.0, 2.0, 3.0, 4.0, 5.0])]
    v = spark.createDataFrame(rows, "doc_pos long, embedding array<double>").repartition(3)
    q = v.filter("doc_pos % 20 = 0 OR doc_pos = 401").select(F.col("doc_pos").alias("query_id"), F.col("embedding").alias("vector"))
    scored = v.crossJoin(q).select("query_id", "doc_pos", F.round(X.inner_product(F.col("embedding"), F.col("vector")), 6).alias("score"))
    scored.createOrReplaceTempView("scored")
    want = spark.sql("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_pos) AS rank FROM scored) WHERE rank <= 5")
    for block in (10_000, 7):
        got = retrieval.dense_search_many(v, q, 5, block)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # No join makes a row for each pair.
    assert "NestedLoop" not in retrieval.dense_search_many(v.filter("doc_pos < 400"), q.filter("query_id < 400"), 5)._jdf.queryExecution().toString()


def test_retrieval_metrics_from_the_gold_among_the_hits(spark):
    ids = lambda *x: F.array(*map(F.lit, x))
    whole = metrics.retrieval_metrics(ids("a", "x", "b"), ids("a", "b", "c", "d"))
    part = metrics.retrieval_metrics(ids("a", "x", "b"), ids("a", "b"), n=F.lit(4))
    assert {k: value(spark, c) for k, c in whole.items()} == {k: value(spark, c) for k, c in part.items()}


def test_measured_queries_hold_no_list_of_a_label(spark, tmp_path):
    from lodestone import registry

    rows = [(i, [float(i % 7), float(i % 3), 1.0], i % 2) for i in range(200)] + [(200, [1.0, 0.0, 0.0], None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = registry.retrieval_metrics(spark, str(tmp_path))
    # Two windows or lists of all members of a label would grow with the square of the table.
    assert "BroadcastNestedLoop" not in found._jdf.queryExecution().toString() and "collect_list(vec_id" not in found._jdf.queryExecution().toString() and "collect_list(g" not in found._jdf.queryExecution().toString()
    got = {r["query_id"]: r for r in found.collect()}
    assert sorted(got) == list(range(0, 200, 20))
    top = sorted(range(200), key=lambda i: (-sum(x * y for x, y in zip(rows[i][1], rows[40][1])), i))[:10]
    gold = {i for i in range(0, 200, 2)}
    assert abs(got[40]["recall_10"] - len(gold & set(top)) / 100) < 1e-12 and got[40]["joint_recall_10"] == 0
    assert got[40]["mrr"] == 1 / (1 + next(n for n, i in enumerate(top) if i in gold))


def test_functions_hold_few_rows_at_a_time(spark):
    import pyarrow as pa

    # All rows of a batch at once was how these functions grew with a batch.
    seen = []
    one = U.by_slices(lambda a, b: seen.append(len(seen)) or (None if a is None else a + b), StringType())
    got = one.func(pa.array(["a", None, "c"] * 300), pa.array(["x"] * 900))
    assert got.to_pylist() == ["ax", None, "cx"] * 300 and U.SLICE < 900
    sizes = [b.num_rows for b in chunking._by_pages(lambda n: [(n,)], "n long")(iter([pa.RecordBatch.from_pydict({"n": list(range(150))})]))]
    assert sum(sizes) == 150 and max(sizes) <= chunking.PAGES
    rows = spark.createDataFrame([(1, "<p>a <b>b</b></p>"), (2, None), (3, "")], "n long, h string").select("n", U.strip_html("h").alias("h")).select("n", "h.tag", "h.text")
    assert {tuple(r) for r in rows.collect()} == {(1, "p", "a b"), (2, "", ""), (3, "", "")}


def test_samples_are_the_first_in_hash_order(spark):
    rows = spark.createDataFrame([(str(i), str(i % 3 % 2)) for i in range(6000)] + [(None, "0"), ("7", "1"), ("7", "1")], "id string, s string")
    order = lambda: sampling.hash_order(F.col("id"), 5)
    placed = rows.withColumn("h", order())
    placed.createOrReplaceTempView("placed")
    for target in (3, 500, 100_000):
        alloc = {r["stratum"]: r["alloc"] for r in sampling.largest_remainder(rows.groupBy(F.col("s").alias("stratum")).agg(F.count("*").alias("cnt")), target).collect()}
        sample = sampling.stratified_sample(rows, F.col("s"), "id", target, 5)
        want = spark.sql("SELECT id, s, row_number() OVER (PARTITION BY s ORDER BY h, id) AS place FROM placed").collect()
        assert sorted((str(r["id"]), r["s"]) for r in sample.collect()) == sorted((str(r["id"]), r["s"]) for r in want if r["place"] <= alloc[r["s"]])
    got = sampling.numbered(rows, "id", 5).select("id", "place").collect()
    want = spark.sql("SELECT id, row_number() OVER (ORDER BY h, id) - 1 AS place FROM placed").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_keywords_with_repeated_keys_and_rare_terms(spark):
    rows = [(1, "alpha alpha beta gamma a of"), (1, "beta delta"), (2, "gamma delta epsilon epsilon"), (3, None), (4, "epsilon beta zeta"), (None, "alpha zeta"), (None, "zeta")]
    docs = spark.createDataFrame(rows, "k long, text string")
    got = {(r["k"], r["term"]): (r["weight"], r["place"]) for r in retrieval.tfidf_keywords(docs, "k", 2).collect()}
    import math

    idf = lambda df: math.log(8 / (1 + df)) + 1
    assert got == {(1, "alpha"): (round(2 * idf(2), 9), 1), (1, "beta"): (round(2 * idf(2), 9), 2), (2, "epsilon"): (round(2 * idf(2), 9), 1), (2, "delta"): (round(idf(2), 9), 2), (4, "beta"): (round(idf(2), 9), 1), (4, "epsilon"): (round(idf(2), 9), 2), (None, "zeta"): (round(2 * idf(2), 9), 1), (None, "alpha"): (round(idf(2), 9), 2)}


def test_token_f1_of_long_answers_counts_multisets(spark):
    a, b = "x y " * 3000 + "z", "y " * 5000 + "w x"
    from collections import Counter

    p, r = a.split(), b.split()
    want = 2 * sum((Counter(p) & Counter(r)).values()) / (len(p) + len(r))
    assert abs(value(spark, X.token_f1(F.lit(a), F.lit(b))) - want) < 1e-12

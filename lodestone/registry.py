"""Every query of the engine by name, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.functions import udfs as U
from lodestone.operators import chunking, datasets, metrics, relational, retrieval, sampling, scoring
from lodestone.plans import chain
from lodestone.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# SQL of the text scalars.
NORM = r"""trim(regexp_replace(translate(coalesce({c}, ''), ' ‘’“”', ' ''''""'), '[\s\x0b\x1c-\x1f\x85\p{{Z}}]+', ' ', 'g'))"""
KEY = "regexp_replace(lower(" + NORM + "), '[^a-z0-9]+', '', 'g')"
TERMS = r"regexp_extract_all(translate(lower(translate(coalesce({c}, ''), 'İſ', 'is')), '" + X.FOLD[0] + "', '" + X.FOLD[1] + r"'), '[\p{{L}}\p{{N}}]+')"
ANSWER = r"list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[!-/:-@\[-`{{-~]', ' ', 'g'), '[\s\x0b\x1c-\x1f\x85\p{{Z}}]+', ' ', 'g')), ' '), lambda t: t NOT IN ('', 'a', 'an', 'the'))"
n_, k_, t_, a_ = (lambda c, s=s: s.format(c=c) for s in (NORM, KEY, TERMS, ANSWER))


# Text scalars and identities.


@query(f"SELECT doc_id, {n_('text')} AS normalized, {k_('text')} AS norm_key FROM documents")
def normalized_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.normalize_text(F.col("text")).alias("normalized"), X.normalized_key(F.col("text")).alias("norm_key"))


@query(f"SELECT doc_id, substr(sha256(coalesce(source, '') || '␟' || {n_('text')}), 1, 16) AS content_hash FROM documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.stable_hash(F.col("source"), X.normalize_text(F.col("text"))).alias("content_hash"))


@query(r"""SELECT item_id, array_to_string(list_transform(list_distinct_ordered, lambda t: '"' || t || '"'), ' OR ') AS expression FROM (
  SELECT item_id, (SELECT list(t ORDER BY p) FROM (SELECT t, min(p) AS p FROM (SELECT unnest(w) AS t, unnest(range(len(w))) AS p) GROUP BY t)) AS list_distinct_ordered
  FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark))""")
def match_expressions(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", X.match_expression(F.col("text")).alias("expression"))


# Deduplication, leakage, membership.


@query(f"SELECT arg_min(doc_id, doc_id) AS doc_id, {k_('text')} AS norm_key FROM documents GROUP BY 2")
def kb_dedup_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", X.normalized_key(F.col("text")).alias("norm_key"))
    return relational.keep_first(d, F.col("norm_key"), "doc_id")


@query(f"SELECT min(doc_id) AS first_id, count(*) AS copies, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM documents GROUP BY {k_('text')} HAVING count(*) > 1")
def kb_duplicate_groups(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    g = d.groupBy(X.normalized_key(F.col("text")).alias("k")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"))
    return g.filter("copies > 1").drop("k")


@query(f"SELECT count(*) AS leaked FROM documents WHERE {k_('text')} IN (SELECT {k_('text')} FROM benchmark)")
def benchmark_leakage_exact(spark, sf_dir):
    return relational.leaked(table(spark, sf_dir, "documents").select("text"), table(spark, sf_dir, "benchmark").select("text"), ["text"]).agg(F.count("*").alias("leaked"))


@query(f"SELECT doc_id, item_id FROM (SELECT doc_id, {k_('text')} AS d FROM documents) JOIN (SELECT item_id, {k_('text')} AS i FROM benchmark) ON contains(d, i) AND i <> ''")
def benchmark_containment(spark, sf_dir):
    return relational.containment(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(f"SELECT doc_id FROM documents WHERE {k_('text')} NOT IN (SELECT {k_('text')} FROM conversations)")
def train_without_test(spark, sf_dir):
    return relational.anti_on_keys(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "conversations"), ["text"]).select("doc_id")


@query("SELECT d.doc_id, coalesce(string_agg(DISTINCT l.s, ',' ORDER BY l.s), '') AS split_membership FROM documents d LEFT JOIN (SELECT doc_id, unnest(['quality' || quality, 'toxic' || toxic]) AS s FROM labels) l USING (doc_id) GROUP BY 1")
def kb_membership_sets(spark, sf_dir):
    l = table(spark, sf_dir, "labels").select("doc_id", F.explode(F.array(F.concat(F.lit("quality"), "quality"), F.concat(F.lit("toxic"), "toxic"))).alias("s"))
    return table(spark, sf_dir, "documents").select("doc_id").join(relational.split_membership(l, "doc_id", "s"), "doc_id", "left").select("doc_id", F.coalesce("split_membership", F.lit("")).alias("split_membership"))


@query("SELECT count(*) AS n, count(DISTINCT doc_id) AS ids, count_if(doc_id IS NULL)::BIGINT AS blank FROM documents")
def unique_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"), F.count_if(F.col("doc_id").isNull()).alias("blank"))


@query("SELECT lang, doc_id, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_value FROM documents WINDOW w AS (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
def circular_neighbour(spark, sf_dir):
    return relational.circular_next(table(spark, sf_dir, "documents").select("lang", "doc_id"), "doc_id", "doc_id", "lang")


RESPONSES = "SELECT conv_id AS id, CASE WHEN turn % 3 = 1 THEN 'success' ELSE 'invalid' END AS status, md5(role) AS request_hash, turn AS file_pos FROM conversations"
REQUESTS = "SELECT conv_id AS id, md5('assistant') AS request_hash, 1000000 - conv_id AS request_pos FROM conversations WHERE turn = 0 AND conv_id % 5 <> 0"


def _responses(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    responses = c.select(F.col("conv_id").alias("id"), F.when(F.col("turn") % 3 == 1, "success").otherwise("invalid").alias("status"), F.md5("role").alias("request_hash"), F.col("turn").alias("file_pos"))
    requests = c.filter("turn = 0 AND conv_id % 5 <> 0").select(F.col("conv_id").alias("id"), F.md5(F.lit("assistant")).alias("request_hash"), (1000000 - F.col("conv_id")).alias("request_pos"))
    return responses, requests


@query(f"WITH r AS ({RESPONSES}), q AS ({REQUESTS}) SELECT r.id, arg_max(status, file_pos) AS status, arg_max(r.request_hash, file_pos) AS request_hash, any_value(request_pos) AS request_pos, min(file_pos) AS first_seen FROM r LEFT JOIN q ON r.id = q.id GROUP BY r.id")
def latest_response_wins(spark, sf_dir):
    return relational.latest_responses(*_responses(spark, sf_dir))


@query(f"WITH r AS ({RESPONSES}), q AS ({REQUESTS}) SELECT q.id FROM q WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.id = q.id AND r.request_hash = q.request_hash AND status = 'success')")
def stale_requests(spark, sf_dir):
    responses, requests = _responses(spark, sf_dir)
    return relational.pending(requests, responses).select("id")


@query(f"WITH r AS ({RESPONSES}), q AS ({REQUESTS}) SELECT r.id, r.file_pos FROM r JOIN q ON r.id = q.id AND r.request_hash = q.request_hash WHERE status = 'success'")
def successful_responses(spark, sf_dir):
    return relational.successful(*_responses(spark, sf_dir)).select("id", "file_pos")


# Profiles.


@query("SELECT lang, count(*) AS n, avg(n_chars) AS mean, quantile_cont(n_chars, 0.5) AS median, round(quantile_cont(n_chars, 0.95), 6) AS p95, min(n_chars) AS least, max(n_chars) AS most FROM documents GROUP BY 1")
def length_profile(spark, sf_dir):
    c = F.col("n_chars")
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.avg(c).alias("mean"), F.percentile(c, 0.5).alias("median"), F.round(F.percentile(c, 0.95), 6).alias("p95"), F.min(c).alias("least"), F.max(c).alias("most"))


@query("SELECT least(n_chars // 500, 10) AS bin, count(*) AS n FROM documents GROUP BY 1")
def length_histogram(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.least(F.floor(F.col("n_chars") / 500), F.lit(10)).alias("bin")).agg(F.count("*").alias("n"))


@query("SELECT source || ':' || lang AS mix, count(*) AS n, count_if(n_chars > 1000)::BIGINT AS long_ones FROM documents GROUP BY 1")
def source_mix(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.concat_ws(":", "source", "lang").alias("mix")).agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") > 1000).alias("long_ones"))


# Conversations.


@query(f"SELECT conv_id, string_agg(CASE WHEN i % 2 = 0 THEN 'User: ' ELSE 'Assistant: ' END || {n_('text')}, chr(10) ORDER BY i) AS history FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations) GROUP BY 1")
def conversation_history(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]).alias("turns"))
    return c.select("conv_id", X.format_history(F.col("turns")).alias("history"))


@query("SELECT role, least(turn, 10) AS turn, count(*) AS n FROM conversations GROUP BY 1, 2")
def role_turn_mix(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("role", F.least("turn", F.lit(10)).alias("turn")).agg(F.count("*").alias("n"))


@query("SELECT conv_id, turn, coalesce(lag(text, 2) OVER (PARTITION BY conv_id ORDER BY turn), 'related topic') AS context FROM conversations")
def prev_user_turn(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(F.lag("text", 2).over(W.partitionBy("conv_id").orderBy("turn")), F.lit("related topic")).alias("context"))


@query(rf"""SELECT conv_id, turn, {k_('text')} <> {k_('p')} AS nontrivial, (len(regexp_extract_all(text, '\S+')) - len(regexp_extract_all(p, '\S+')))::INT AS delta
  FROM (SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE p IS NOT NULL""")
def rewrite_delta(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumn("p", F.lag("text").over(W.partitionBy("conv_id").orderBy("turn"))).filter("p IS NOT NULL")
    return c.select("conv_id", "turn", (X.normalized_key(F.col("text")) != X.normalized_key(F.col("p"))).alias("nontrivial"), X.word_delta(F.col("p"), F.col("text")).alias("delta"))


# Retrieval.

TERMS_ASKED = ["the", "that", "thint", "ering", "des"]
STEP_TERMS = ["und", "erlich", "cion"]
_POST = f"post AS (SELECT doc_id AS doc_pos, term, count(*) AS tf FROM (SELECT doc_id, unnest({t_('text')}) AS term FROM documents) GROUP BY 1, 2)"
_LEN = f"len AS (SELECT doc_id AS doc_pos, len({t_('text')}) AS length FROM documents), whole AS (SELECT count(*)::DOUBLE AS n, avg(length) AS mean FROM len)"


def _bm25_sql(name: str, terms: list[str]) -> str:
    asked = ", ".join(f"'{t}'" for t in terms)
    return f"""{name} AS (SELECT *, row_number() OVER (ORDER BY score, doc_pos) AS rank FROM (
      SELECT p.doc_pos, round(-sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 9) AS score
      FROM post p JOIN (SELECT term, count(*) AS df FROM post WHERE term IN ({asked}) GROUP BY 1) d USING (term) JOIN len USING (doc_pos) CROSS JOIN whole GROUP BY 1) ORDER BY rank LIMIT 50)"""


def _dense_sql(name: str, vec: int) -> str:
    return f"""{name} AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_pos) AS rank FROM (
      SELECT v.vec_id AS doc_pos, round(list_inner_product(list_transform(v.embedding, lambda x: x::DOUBLE), list_transform(q.embedding, lambda x: x::DOUBLE)), 6) AS score
      FROM embeddings v CROSS JOIN (SELECT embedding FROM embeddings WHERE vec_id = {vec}) q) ORDER BY rank LIMIT 50)"""


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc_pos"), "text")


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_pos"), "embedding")


def _vector(spark, sf_dir, n):
    return table(spark, sf_dir, "embeddings").filter(F.col("vec_id") == n).select(F.col("embedding").alias("vector"))


@query(f"WITH {_POST} SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM post GROUP BY 1")
def document_frequency(spark, sf_dir):
    return retrieval.postings(_docs(spark, sf_dir)).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf_text").alias("cf"))


@query(f"WITH {_POST} SELECT doc_pos, term, tf AS tf_text FROM post")
def bm25_postings(spark, sf_dir):
    return retrieval.postings(_docs(spark, sf_dir)).select("doc_pos", "term", "tf_text")


@query(f"WITH {_POST}, {_LEN}, {_bm25_sql('b', TERMS_ASKED)} SELECT doc_pos, score, rank FROM b")
def bm25_topk(spark, sf_dir):
    return retrieval.bm25_search(_docs(spark, sf_dir), TERMS_ASKED)


@query(f"WITH {_dense_sql('d', 0)} SELECT doc_pos, score, rank FROM d")
def dense_topk(spark, sf_dir):
    return retrieval.dense_search(_vectors(spark, sf_dir), _vector(spark, sf_dir, 0))


@query("""SELECT query_id, doc_pos, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_pos) AS rank FROM (
  SELECT q.vec_id AS query_id, v.vec_id AS doc_pos, round(list_inner_product(list_transform(v.embedding, lambda x: x::DOUBLE), list_transform(q.embedding, lambda x: x::DOUBLE)), 6) AS score
  FROM embeddings v CROSS JOIN (SELECT * FROM embeddings WHERE vec_id % 20 = 0) q)) WHERE rank <= 10""")
def dense_topk_multi(spark, sf_dir):
    q = table(spark, sf_dir, "embeddings").filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return retrieval.dense_search_many(_vectors(spark, sf_dir), q, 10)


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm FROM embeddings")
def l2_norm_check(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(X.l2_norm(F.col("embedding")), 6).alias("norm"))


_FUSED = "SELECT doc_pos, score, best, row_number() OVER (ORDER BY score DESC, best, doc_pos) AS rank FROM (SELECT doc_pos, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS score, min(rank) AS best FROM (SELECT doc_pos, rank FROM b UNION ALL SELECT doc_pos, rank FROM d) GROUP BY 1) ORDER BY rank LIMIT 10"


@query(f"WITH {_POST}, {_LEN}, {_bm25_sql('b', TERMS_ASKED)}, {_dense_sql('d', 0)} {_FUSED}")
def rrf_fusion(spark, sf_dir):
    b = retrieval.bm25_search(_docs(spark, sf_dir), TERMS_ASKED).select("doc_pos", "rank")
    d = retrieval.dense_search(_vectors(spark, sf_dir), _vector(spark, sf_dir, 0)).select("doc_pos", "rank")
    return retrieval.fused_top(b.unionByName(d))


def _hybrid_sql(steps: list[tuple[str, list[str], int]]) -> str:
    parts = [f"{_bm25_sql(f'b{i}', t)}, {_dense_sql(f'd{i}', v)}" for i, (_, t, v) in enumerate(steps)]
    union = " UNION ALL ".join(f"SELECT doc_pos, rank, score, '{c}' AS channel, {i} AS place, '{s}' AS step FROM {c[0]}{i}" for i, (s, _, _) in enumerate(steps) for c in ("bm25", "dense"))
    return f"""WITH {_POST}, {_LEN}, {', '.join(parts)}, u AS ({union}) SELECT doc_pos, rrf_score, bm25_rank, bm25_score, embedding_rank, embedding_score, query_ids, row_number() OVER (ORDER BY rrf_score DESC, best, doc_pos) AS rank FROM (
      SELECT doc_pos, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS rrf_score, min(rank) AS best, min(rank) FILTER (channel = 'bm25') AS bm25_rank, arg_min(score, rank * 10 + place) FILTER (channel = 'bm25') AS bm25_score,
        min(rank) FILTER (channel = 'dense') AS embedding_rank, arg_min(score, rank * 10 + place) FILTER (channel = 'dense') AS embedding_score, string_agg(DISTINCT step, ',' ORDER BY step) AS query_ids FROM u GROUP BY 1) ORDER BY rank LIMIT 10"""


@query(_hybrid_sql([("q1", TERMS_ASKED, 0)]))
def hybrid_search(spark, sf_dir):
    return retrieval.hybrid_search(_docs(spark, sf_dir), _vectors(spark, sf_dir), [("q1", TERMS_ASKED, _vector(spark, sf_dir, 0))])


@query(_hybrid_sql([("q1", TERMS_ASKED, 0), ("q2", STEP_TERMS, 1)]))
def multi_query_fusion(spark, sf_dir):
    return retrieval.hybrid_search(_docs(spark, sf_dir), _vectors(spark, sf_dir), [("q1", TERMS_ASKED, _vector(spark, sf_dir, 0)), ("q2", STEP_TERMS, _vector(spark, sf_dir, 1))])


@query(f"""WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({t_('text')}) AS term FROM documents) WHERE len(term) > 2 GROUP BY 1, 2),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 2), n AS (SELECT count(*) AS n FROM documents)
  SELECT doc_id, term, weight, place FROM (SELECT doc_id, term, weight, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS place FROM (SELECT doc_id, term, round(tf * (ln((1 + n)::DOUBLE / (1 + df)) + 1), 9) AS weight FROM tf JOIN df USING (term) CROSS JOIN n)) WHERE place <= 6""")
def tfidf_keywords(spark, sf_dir):
    return retrieval.tfidf_keywords(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", 6)


# Metrics.

_GOLD = """h AS (SELECT query_id, list(doc_pos ORDER BY rank) AS retrieved FROM (SELECT query_id, doc_pos, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_pos) AS rank FROM (
  SELECT q.vec_id AS query_id, v.vec_id AS doc_pos, round(list_inner_product(list_transform(v.embedding, lambda x: x::DOUBLE), list_transform(q.embedding, lambda x: x::DOUBLE)), 6) AS score FROM embeddings v CROSS JOIN (SELECT * FROM embeddings WHERE vec_id % 20 = 0) q)) WHERE rank <= 10 GROUP BY 1),
  g AS (SELECT q.vec_id AS query_id, q.label, list(v.vec_id ORDER BY v.vec_id) AS gold FROM embeddings q JOIN embeddings v ON v.label = q.label WHERE q.vec_id % 20 = 0 GROUP BY 1, 2)"""
_M = "SELECT query_id, label, {} , coalesce(1.0::DOUBLE / list_min(list_filter(list_transform(gold, lambda x: list_position(retrieved, x)), lambda p: p > 0)), 0) AS mrr FROM h JOIN g USING (query_id)".format(
    ", ".join(f"len(list_intersect(retrieved[1:{k}], gold))::DOUBLE / len(gold) AS recall_{k}, (len(list_intersect(retrieved[1:{k}], gold)) > 0)::INT::DOUBLE AS hit_{k}, (len(list_intersect(retrieved[1:{k}], gold)) = len(gold))::INT::DOUBLE AS joint_recall_{k}" for k in (1, 5, 10))
)


def _measured(spark, sf_dir):
    """Gold are all vectors of the query's label. Of these the metrics need the number and those among the hits."""
    e = table(spark, sf_dir, "embeddings")
    hits = dense_topk_multi(spark, sf_dir).select("query_id", "doc_pos", "rank")
    members = e.select("label", F.col("vec_id").alias("doc_pos")).filter("label IS NOT NULL AND doc_pos IS NOT NULL").distinct().withColumn("found", F.lit(True))
    sizes = members.groupBy("label").agg(F.count("*").alias("n"))
    asked = e.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "label").distinct().join(sizes, "label")
    rows = hits.join(asked, "query_id").join(members, ["label", "doc_pos"], "left").groupBy("query_id", "label", "n").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_pos", "found"))).alias("hits"))
    retrieved, gold = F.col("hits.doc_pos"), F.transform(F.filter("hits", lambda h: h["found"]), lambda h: h["doc_pos"])
    return rows.select("query_id", "label", *[c.alias(n) for n, c in metrics.retrieval_metrics(retrieved, gold, n=F.col("n")).items()])


@query(f"WITH {_GOLD} {_M}")
def retrieval_metrics(spark, sf_dir):
    return _measured(spark, sf_dir)


@query(f"WITH {_GOLD}, m AS ({_M}), u AS (UNPIVOT m ON recall_1, recall_5, recall_10, mrr INTO NAME metric VALUE value) SELECT label, metric, round(avg(value), 9) AS value, count(*) AS items FROM u GROUP BY 1, 2")
def metrics_by_stratum(spark, sf_dir):
    names = ["recall_1", "recall_5", "recall_10", "mrr"]
    rows = _measured(spark, sf_dir).select("label", F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*map(F.col, names))).alias("metrics"))
    return metrics.average_metrics(rows, ["label"])


_PAIRS = "SELECT conv_id, turn, text AS p, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations"


def _pairs(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.col("text").alias("p"), F.lead("text").over(W.partitionBy("conv_id").orderBy("turn")).alias("r")).filter("r IS NOT NULL")


@query(f"""WITH x AS (SELECT conv_id, turn, {a_('p')} AS p, {a_('r')} AS r FROM ({_PAIRS}) WHERE r IS NOT NULL), o AS (
  SELECT conv_id, turn, sum(least(a.n, b.n)) AS o FROM (SELECT conv_id, turn, t, count(*) AS n FROM (SELECT conv_id, turn, unnest(p) AS t FROM x) GROUP BY ALL) a JOIN (SELECT conv_id, turn, t, count(*) AS n FROM (SELECT conv_id, turn, unnest(r) AS t FROM x) GROUP BY ALL) b USING (conv_id, turn, t) GROUP BY 1, 2)
  SELECT conv_id, turn, CASE WHEN len(p) = 0 OR len(r) = 0 THEN (p = r)::INT::DOUBLE ELSE round(coalesce(o, 0) * 2.0::DOUBLE / (len(p) + len(r)), 9) END AS f1, (p = r)::INT::DOUBLE AS em FROM x LEFT JOIN o USING (conv_id, turn)""")
def token_f1_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).withColumns({"p": U.nfkc("p"), "r": U.nfkc("r")}).select("conv_id", "turn", F.round(X.token_f1(F.col("p"), F.col("r")), 9).alias("f1"), X.exact_match(F.col("p"), F.col("r")).alias("em"))


# Samples.

_ALLOC = """alloc AS (SELECT stratum, cnt, least(cnt, base + CASE WHEN row_number() OVER (ORDER BY round(exact - base, 9) DESC, stratum DESC) <= {t} - sum(base) OVER () THEN 1 ELSE 0 END) AS alloc FROM (
  SELECT *, floor(exact)::BIGINT AS base FROM (SELECT lang AS stratum, count(*) AS cnt, {t} * count(*)::DOUBLE / sum(count(*)) OVER () AS exact FROM documents GROUP BY 1)))"""
_PLACE = "SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('42:' || doc_id), doc_id) AS place FROM documents"


@query(f"WITH {_ALLOC.format(t=97)} SELECT stratum, cnt, alloc::BIGINT AS alloc FROM alloc")
def proportional_allocation(spark, sf_dir):
    return sampling.largest_remainder(table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("stratum")).agg(F.count("*").alias("cnt")), 97)


@query(f"WITH {_ALLOC.format(t=97)}, p AS ({_PLACE}) SELECT doc_id, lang FROM p JOIN alloc ON lang = stratum WHERE place <= alloc")
def stratified_sample(spark, sf_dir):
    return sampling.stratified_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), F.col("lang"), "doc_id", 97).select("doc_id", "lang")


@query(f"""WITH p AS ({_PLACE}), c AS (SELECT lang, count(*) - 15 AS cnt FROM documents GROUP BY 1), e AS (SELECT *, 36 * (cnt - 1)::DOUBLE / sum(cnt - 1) OVER () AS exact FROM c),
  b AS (SELECT *, floor(exact)::BIGINT AS base FROM e), a AS (SELECT lang, least(cnt, 1 + base + CASE WHEN row_number() OVER (ORDER BY round(exact - base, 9) DESC, lang) <= 36 - sum(base) OVER () THEN 1 ELSE 0 END) AS alloc FROM b)
  SELECT doc_id, lang, CASE WHEN place <= 10 THEN 'cold' WHEN place <= 15 THEN 'dpo' ELSE 'grpo' END AS part FROM p JOIN a USING (lang) WHERE place <= 15 + alloc""")
def disjoint_allocation(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    langs = ["de", "en", "es", "fr"]
    return sampling.disjoint_allocation(d, "lang", "doc_id", {"cold": dict.fromkeys(langs, 10), "dpo": dict.fromkeys(langs, 5)}, 40, "grpo", 1)


# Chunks and evidence.


@query()
def chunk_pages(spark, sf_dir):
    return chunking.chunk_pages(table(spark, sf_dir, "pages")).withColumns({"section_path": F.array_join("section_path", " > "), "source_indices": F.array_join(F.col("source_indices").cast("array<string>"), ",")})


@query()
def chunk_length_profile(spark, sf_dir):
    n = F.length("text")
    return chunking.chunk_pages(table(spark, sf_dir, "pages")).agg(F.count("*").alias("chunks"), F.avg(n).alias("mean"), F.percentile(n, 0.5).alias("median"), F.percentile(n, 0.95).alias("p95"), F.min(n).alias("least"), F.max(n).alias("most"))


@query()
def html_visible_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.strip_html("html").alias("h")).select("page_id", "h.tag", "h.text")


@query()
def evidence_mapping(spark, sf_dir):
    """The last piece of every page's last chunk against the page's chunks, which are made once."""
    pages = table(spark, sf_dir, "pages")
    chunks = files.written(chunking.chunk_pages(pages))
    evidence = chunks.groupBy("page_id", "url").agg(F.max_by("text", "chunk_no").alias("t")).select(F.col("page_id").alias("evidence_id"), "url", F.element_at(F.split("t", r"\.\s"), -1).alias("evidence"))
    return chunking.map_evidence(evidence, chunks)


# Plans.


#: Steps of a plan, at most.
_STEPS = chain.MOST_STEPS


def _questions(spark, sf_dir):
    """Each conversation in successive parts of up to four turns, whole texts: conv_id, part, turns."""
    c = table(spark, sf_dir, "conversations").withColumn("part", F.floor(F.col("turn") / _STEPS))
    return c.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("turns"))


def _asked(turns):
    return F.transform(turns, lambda s, i: F.concat(s["text"], F.when(i > 0, F.concat(F.lit(" #"), i.cast("string"))).otherwise("")))


def _plans(spark, sf_dir):
    return _questions(spark, sf_dir).select("conv_id", "part", U.decomposition_plan(_asked("turns")).alias("plan"))


@query()
def plan_validate(spark, sf_dir):
    return _plans(spark, sf_dir).select("conv_id", "part", F.array_join(U.validate_plan("plan"), ",").alias("errors"))


@query()
def plan_edges(spark, sf_dir):
    return _plans(spark, sf_dir).select("conv_id", "part", F.array_join(chain.edges(F.col("plan")), ",").alias("edges"))


@query()
def rejected_plans(spark, sf_dir):
    kinds = F.array(*[F.lit(e) for e in U.MULTIHOP_ERRORS])
    p = _plans(spark, sf_dir).withColumn("error_type", F.element_at(kinds, (F.col("conv_id") % 5 + 1).cast("int")))
    return p.withColumn("rejected", U.reject_plan("plan", "error_type"))


@query()
def plan_dependency_f1(spark, sf_dir):
    p = rejected_plans(spark, sf_dir).filter("rejected IS NOT NULL")
    return p.select("conv_id", "part", *[c.alias(n) for n, c in metrics.set_scores(chain.edges(F.col("rejected")), chain.edges(F.col("plan"))).items()])


@query()
def chain_execute(spark, sf_dir):
    """Plans over conversations; retrieval is the first documents of the same language-independent hash, and the answer the
    query's first word: stand-ins for models, whose quality means nothing."""
    records = _plans(spark, sf_dir).select(F.concat_ws("_", F.col("conv_id").cast("string"), F.col("part").cast("string")).alias("record_id"), "plan")

    def retrieve(ask):
        return ask.select("record_id", F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.pmod(F.xxhash64("query") + i, F.lit(100)).cast("string")).alias("evidence"))

    def answer(ask):
        return ask.select("record_id", F.concat(F.element_at(F.split("query", " "), 1), F.lit(" [1]")).alias("answer"))

    out = chain.execute(records, retrieve, answer, U.validate_plan, files.written)
    return out.withColumn("evidence", F.array_join("evidence", ","))


@query("""SELECT record_id, string_agg(doc, ',' ORDER BY score DESC, step_pos, rank, doc) AS evidence FROM (SELECT record_id, doc, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS score, min(step_pos * 1000 + rank) // 1000 AS step_pos, min(step_pos * 1000 + rank) % 1000 AS rank
  FROM (SELECT conv_id AS record_id, turn AS step_pos, role || (turn % 2) AS doc, row_number() OVER (PARTITION BY conv_id, turn // 2 ORDER BY turn) AS rank FROM conversations) GROUP BY 1, 2) GROUP BY 1""")
def chain_fusion(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    rank = F.row_number().over(W.partitionBy("conv_id", F.floor(F.col("turn") / 2)).orderBy("turn"))
    r = c.select(F.col("conv_id").alias("record_id"), F.col("turn").alias("step_pos"), F.concat("role", (F.col("turn") % 2).cast("string")).alias("doc"), rank.alias("rank"))
    return chain.fuse_chain(r).withColumn("evidence", F.array_join("evidence", ","))


# Judges.

_VOTES = "SELECT doc_id, f AS field, m AS model, CASE WHEN f = 'quality' THEN (quality + i + m) % 3 > 0 ELSE (toxic + i * m) % 2 = 1 END AS vote FROM labels, (SELECT unnest(['quality', 'toxic']) AS f), (SELECT unnest([0, 1, 2]) AS i), (SELECT unnest([1, 2]) AS m) WHERE (doc_id + i) % 7 > 0"
_VERDICTS = "SELECT doc_id, field, model, CASE WHEN count(vote) >= 2 AND 2 * count_if(vote) <> count(vote) THEN 2 * count_if(vote) > count(vote) END AS verdict FROM ({}) GROUP BY 1, 2, 3".format(_VOTES)


def _votes(spark, sf_dir):
    l = table(spark, sf_dir, "labels").withColumn("field", F.explode(F.array(F.lit("quality"), F.lit("toxic")))).withColumn("i", F.explode(F.array(*map(F.lit, (0, 1, 2))))).withColumn("model", F.explode(F.array(F.lit(1), F.lit(2))))
    vote = F.when(F.col("field") == "quality", (F.col("quality") + F.col("i") + F.col("model")) % 3 > 0).otherwise((F.col("toxic") + F.col("i") * F.col("model")) % 2 == 1)
    return l.filter("(doc_id + i) % 7 > 0").select("doc_id", "field", "model", vote.alias("vote"))


@query(_VERDICTS)
def judge_majority(spark, sf_dir):
    return metrics.majority(_votes(spark, sf_dir), ["doc_id", "model"])


@query(f"""WITH e AS (SELECT doc_id, field, count(verdict) AS n, bool_and(verdict) AS a, bool_or(verdict) AS b FROM ({_VERDICTS}) GROUP BY 1, 2)
  SELECT doc_id, count(*) AS fields, round(count_if(n = 2 AND a = b) / count(*), 9) AS coverage, round(count_if(n = 2 AND a <> b) / count(*), 9) AS disagreement, count_if(n = 2 AND a AND b)::BIGINT AS true_fields FROM e GROUP BY 1""")
def judge_consensus(spark, sf_dir):
    return metrics.consensus(judge_majority(spark, sf_dir), ["doc_id"])


_SCORES = "SELECT CASE WHEN doc_id % 4 > 0 THEN source END AS source_dataset, (doc_id % 3 + 2)::VARCHAR AS hop_count, (n_chars > 1000)::VARCHAR AS answerable, n_chars::DOUBLE AS size, CASE WHEN doc_id % 2 = 0 THEN 1.0::DOUBLE END AS even FROM documents"


@query(f"""WITH s AS ({_SCORES}), g AS (SELECT 'overall' AS "by", 'all' AS "of", size, even FROM s UNION ALL SELECT 'source_dataset', coalesce(source_dataset, 'None'), size, even FROM s UNION ALL SELECT 'hop_count', hop_count, size, even FROM s UNION ALL SELECT 'answerable', answerable, size, even FROM s)
  SELECT "by", "of", metric, round(avg(value), 9) AS value, count(*) AS items FROM (UNPIVOT g ON size, even INTO NAME metric VALUE value) GROUP BY ALL""")
def aggregate_scores(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    m = F.map_filter(F.create_map(F.lit("size"), F.col("n_chars").cast("double"), F.lit("even"), F.when(F.col("doc_id") % 2 == 0, 1.0)), lambda k, v: v.isNotNull())
    s = d.select(F.when(F.col("doc_id") % 4 > 0, F.col("source")).alias("source_dataset"), (F.col("doc_id") % 3 + 2).alias("hop_count"), (F.col("n_chars") > 1000).alias("answerable"), m.alias("metrics"))
    return metrics.aggregate_scores(s)


@query("SELECT doc_id, lang, round((n_chars - avg(n_chars) OVER w) / (stddev_pop(n_chars) OVER w + 1e-6), 6) AS advantage FROM documents WINDOW w AS (PARTITION BY lang)")
def group_advantage(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return metrics.group_advantage(d, "lang", "n_chars").select("doc_id", "lang", F.round("advantage", 6).alias("advantage"))


# Training sets: conversations as rewrites and multi-hop questions, documents as policies.


def _rewrites(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    w = W.partitionBy("conv_id").orderBy("turn")
    rows = c.select("conv_id", "turn", F.col("text").alias("question"), F.lead("text").over(w).alias("rewrite"), F.collect_list("text").over(w.rowsBetween(W.unboundedPreceding, -1)).alias("context"), F.count("text").over(w.rowsBetween(W.unboundedPreceding, -1)).cast("int").alias("context_turns"))
    return rows.filter("rewrite IS NOT NULL AND length(rewrite) >= 3").select(
        F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "question", "context", F.when(F.col("turn") % 4 == 0, F.col("question")).otherwise(F.col("rewrite")).alias("rewrite"),
        F.when(F.col("conv_id") % 2 == 0, "even").otherwise("odd").alias("conversation_source"), "context_turns",
    )


def _policies(spark, sf_dir):
    """Documents by source and language: the title; of the words the first half as scenario and the rest as question, and
    three equal parts as evidence, so that all of a text is used."""
    words = F.split(X.normalize_text(F.col("text")), " ")
    n = F.size(words)
    part = lambda k, of: F.array_join(F.slice(words, F.floor(n * k / of).cast("int") + 1, F.greatest(F.lit(1), (F.floor(n * (k + 1) / of) - F.floor(n * k / of)).cast("int"))), " ")
    solid = "[^" + X.BLANKS[1:-1]
    start = X.normalize_text(F.regexp_extract("text", f"^{X.BLANKS[:-1]}*(?:{solid}+{X.BLANKS[:-1]}*){{0,3}}", 0))
    answers = F.array(F.struct(start.alias("answer"), F.lit("").alias("conditions")))
    return table(spark, sf_dir, "documents").filter(F.col("text").rlike(solid)).select(
        F.col("doc_id").cast("string").alias("id"), F.concat_ws(" ", "source", "lang").alias("title"), part(0, 2).alias("scenario"), part(1, 2).alias("question"), (F.col("doc_id") % 9 == 0).alias("not_answerable"),
        F.array(part(0, 3), part(1, 3), part(2, 3)).alias("evidences"), answers.alias("answers"), F.array(F.col("doc_id").cast("string"), (F.col("doc_id") + 1).cast("string")).alias("gold_doc_ids"),
    )


def _multihop(spark, sf_dir):
    said = F.transform("turns", lambda s: F.element_at(F.split(s["text"], " "), -1))
    rows = _questions(spark, sf_dir).filter(F.size("turns") >= 2).select((F.col("conv_id") * 100 + F.col("part")).alias("n"), _asked("turns").alias("questions"), said.alias("answers"))
    docs = F.transform("answers", lambda a, i: (F.col("n") * 10 + i).cast("string"))
    return rows.select(F.col("n").cast("string").alias("id"), F.element_at("questions", 1).alias("question"), "questions", "answers", F.element_at("answers", -1).alias("answer"), F.array(F.element_at("answers", 1)).alias("answer_aliases"), docs.alias("gold_doc_ids"), F.size("questions").alias("hop_count"))


@query()
def sft_records(spark, sf_dir):
    policy = _policies(spark, sf_dir)
    return datasets.sft(_rewrites(spark, sf_dir), policy, datasets.policy_plans(policy), 400, 100)


@query()
def multihop_sft_records(spark, sf_dir):
    return datasets.multihop_sft(_multihop(spark, sf_dir))


@query()
def dpo_records(spark, sf_dir):
    policy = _policies(spark, sf_dir)
    return datasets.dpo(_rewrites(spark, sf_dir), policy, datasets.policy_plans(policy), _multihop(spark, sf_dir), 200, 50)


@query()
def grpo_records(spark, sf_dir):
    policy = _policies(spark, sf_dir)
    used = policy.filter("id % 3 = 0").select(F.col("id").alias("source_id"))
    return datasets.grpo(_multihop(spark, sf_dir), policy, datasets.policy_plans(policy), used, 100)


@query()
def generation_requests(spark, sf_dir):
    """Requests of all three stages; each evidence maps to a document by its place."""
    policy = _policies(spark, sf_dir)
    mapped = policy.select("id", F.posexplode("evidences").alias("place", "evidence")).withColumn("doc_id", F.concat_ws("_", "id", (F.col("place") % (F.col("id") % 3 + 1)).cast("string")))
    parts = [datasets.sft_requests(policy), datasets.dpo_requests(dpo_records(spark, sf_dir)), datasets.grpo_requests(policy, mapped)]
    out = None
    for p in parts:
        p = p.select("id", "stage", "source_dataset", "source_id", "payload", "request_hash")
        out = p if out is None else out.unionByName(p)
    return out


def _judged(spark, sf_dir):
    """Gold records of both tasks, and predictions that are right, weaker by one error, or failed, by id."""
    steps = F.transform(chain.parsed(F.col("reference_plan"))["queries"], lambda q, i: F.struct(q["id"].alias("id"), q["query"].alias("query"), F.get("gold_doc_ids", i).alias("gold_doc_id"), F.get("answers", i).alias("answer"), F.array().cast("array<string>").alias("aliases")))
    nest = F.transform("gold_doc_ids", lambda d: F.array(d))
    many = _multihop(spark, sf_dir).withColumn("reference_plan", U.decomposition_plan("questions")).select(F.concat(F.lit("m"), "id").alias("id"), F.lit("musique").alias("source_dataset"), "hop_count", F.lit(True).alias("answerable"), "gold_doc_ids", nest.alias("evidence_doc_ids"), F.array("answer").alias("references"), "reference_plan", steps.alias("reference_steps"), (F.col("id") % 4).alias("kind"))
    p = _policies(spark, sf_dir)
    no_steps = F.array().cast("array<struct<id:string,query:string,gold_doc_id:string,answer:string,aliases:array<string>>>")
    one = p.select(F.concat(F.lit("p"), "id").alias("id"), F.lit("conditionalqa").alias("source_dataset"), F.lit(None).cast("int").alias("hop_count"), (~F.col("not_answerable")).alias("answerable"), "gold_doc_ids", nest.alias("evidence_doc_ids"), F.transform("answers", lambda a: a["answer"]).alias("references"), F.lit(None).cast("string").alias("reference_plan"), no_steps.alias("reference_steps"), (F.col("id") % 4).alias("kind"))
    gold = many.unionByName(one)
    k = F.col("kind")
    said = F.transform("reference_steps", lambda s, i: F.struct(F.lit("success").alias("status"), F.when(k < 2, s["answer"]).alias("answer"), F.array(s["gold_doc_id"]).alias("evidence")))
    predictions = gold.withColumn("bad", U.reject_plan("reference_plan", F.when(k == 1, "step_omission").otherwise("broken_dependency"))).select(
        "id", F.when(k == 3, False).alias("success"), F.when(k == 3, F.array(F.lit("timeout"))).alias("errors"), (k == 2).alias("fallback"), F.create_map(F.lit("total_tokens"), F.lit(10.0)).alias("tokens"), F.create_map(F.lit("total"), F.lit(0.5)).alias("latency"),
        F.when(k == 2, F.reverse("gold_doc_ids")).otherwise(F.slice("gold_doc_ids", 1, 1)).alias("evidence"), F.when(k != 3, F.element_at("references", 1)).alias("answer"), F.lit(None).cast("boolean").alias("said_answerable"),
        F.when(k == 0, F.col("reference_plan")).when(k < 3, F.col("bad")).alias("plan"), said.alias("steps"),
    )
    return gold.drop("kind"), predictions


@query()
def scores_by_task(spark, sf_dir):
    return metrics.aggregate_scores(scoring.score(*_judged(spark, sf_dir), check=False))

"""Text scalars as Column functions; all run inside the JVM."""

from __future__ import annotations

import string
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Typographic characters and what they become, the blank class, the hash separator.
QUOTES = (" ‘’“”", " ''\"\"")
BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]+"
SEPARATOR = "␟"


def _folds(last: int = 0x24F) -> tuple[str, str]:
    """Small Latin letters with one mark over or under a letter of ASCII, and that letter."""
    parts = {chr(c): unicodedata.normalize("NFD", chr(c)) for c in range(0xC0, last + 1) if chr(c).islower()}
    plain = {c: d[0] for c, d in parts.items() if len(d) == 2 and d[0] in string.ascii_lowercase}
    return "".join(plain), "".join(plain.values())


FOLD = _folds()
#: Letters that lower case makes two of, or leaves apart from their small form.
ODD = ("İſ", "is")
REFUSALS = ("not answerable", "cannot be answered", "insufficient evidence", "无法回答", "无法确定")
ANSWER_MISSING = "not answerable"


def normalize_text(c: Column) -> Column:
    """Null becomes '', typographic quotes plain, runs of any blank one space."""
    plain = F.translate(F.coalesce(c, F.lit("")), *QUOTES)
    return F.trim(F.regexp_replace(plain, BLANKS, " "))


def normalized_key(c: Column) -> Column:
    """Lower-case ASCII letters and digits only: other scripts collapse to ''."""
    return F.regexp_replace(F.lower(normalize_text(c)), "[^a-z0-9]+", "")


def stable_hash(*columns: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256), 1, length)


def strip_code_fence(c: Column) -> Column:
    inner = F.regexp_extract(F.trim(c), r"(?s)^```(?:[A-Za-z]+)?\s*(.*?)\s*```$", 1)
    return F.when(F.trim(c).rlike(r"(?s)^```.*```$"), inner).otherwise(F.trim(c))


def clean_intermediate_answer(c: Column) -> Column:
    """Without citations such as [1, 2]."""
    return F.trim(F.regexp_replace(c, r"\s*\[(?:\d+\s*,?\s*)+\]", ""))


def query_terms(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\w+"), F.lit(0)))


def match_expression(c: Column) -> Column:
    return F.array_join(F.transform(query_terms(c), lambda t: F.concat(F.lit('"'), t, F.lit('"'))), " OR ")


def index_terms(c: Column) -> Column:
    """Terms as the inverted index has them: letters and digits, folded."""
    return F.regexp_extract_all(F.translate(F.lower(F.translate(F.coalesce(c, F.lit("")), *ODD)), *FOLD), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def answer_tokens(c: Column) -> Column:
    """Tokens of an answer: lower case, ASCII punctuation as blanks, articles dropped. Expects NFKC text."""
    plain = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[!-/:-@\[-`{-~]", " ")
    return F.filter(F.split(F.trim(F.regexp_replace(plain, BLANKS, " ")), " "), lambda t: ~t.isin("", "a", "an", "the"))


def exact_match(prediction: Column, reference: Column) -> Column:
    return (answer_tokens(prediction) == answer_tokens(reference)).cast("double")


def token_f1(prediction: Column, reference: Column) -> Column:
    """2 * overlap / (both lengths), with the overlap of multisets; two empty answers are equal. Both token lists are
    made once a row and sorted together; in that order each of the reference's tokens takes one of the prediction's."""

    def step(a: Column, x: Column) -> Column:
        left = F.when(a["t"] == x["t"], a["left"]).otherwise(0)
        taken = x["second"] & (left > 0)
        return F.struct(x["t"].alias("t"), F.when(taken, left - 1).when(x["second"], 0).otherwise(left + 1).alias("left"), F.when(taken, a["n"] + 1).otherwise(a["n"]).alias("n"))

    def score(s: Column) -> Column:
        p, r = s["p"], s["r"]
        side = lambda tokens, second: F.transform(tokens, lambda t: F.struct(t.alias("t"), F.lit(second).alias("second")))
        start = F.struct(F.lit("").alias("t"), F.lit(0).alias("left"), F.lit(0).alias("n"))
        overlap = F.aggregate(F.sort_array(F.concat(side(p, False), side(r, True))), start, step, lambda a: a["n"])
        empty = (F.size(p) == 0) | (F.size(r) == 0)
        return F.when(empty, (p == r).cast("double")).otherwise(overlap * F.lit(2.0) / (F.size(p) + F.size(r)))

    both = F.struct(answer_tokens(prediction).alias("p"), answer_tokens(reference).alias("r"))
    return F.get(F.transform(F.array(both), score), F.lit(0))


def best_of(score, prediction: Column, references: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(references, lambda r: score(prediction, r))), F.lit(0.0))


def format_history(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x, i: F.concat(F.when(i % 2 == 0, "User: ").otherwise("Assistant: "), normalize_text(x))), "\n")


def format_query_input(history: Column, question: Column) -> Column:
    return F.when(history != "", F.concat(F.lit("Conversation history:\n"), history, F.lit("\n\nCurrent question: "), question)).otherwise(question)


def format_embedding_text(title: Column, text: Column) -> Column:
    return F.concat_ws("\n\n", title, text)


def single_query_plan(query: Column) -> Column:
    step = F.struct(F.lit("q1").alias("id"), query.alias("query"), F.array().cast("array<string>").alias("depends_on"))
    return F.to_json(F.struct(F.array(step).alias("queries")))


def first_query(plan: Column) -> Column:
    return F.get_json_object(plan, "$.queries[0].query")


def answer_fragments(c: Column) -> Column:
    parts = F.transform(F.split(c, ";"), normalized_key)
    return F.filter(parts, lambda k: (F.length(k) > 4) & (k != "notanswerable"))


def flatten_answers(answers: Column) -> Column:
    """answers: array of (answer, conditions); the default when none is left."""
    kept = F.filter(F.transform(answers, lambda a: normalize_text(a["answer"])), lambda a: a != "")
    joined = F.array_join(F.array_distinct(kept), "; ")
    return F.when(F.coalesce(joined, F.lit("")) == "", F.lit(ANSWER_MISSING)).otherwise(joined)


def token_value(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("long"))


def infer_answerable(flag: Column, answer: Column) -> Column:
    text = F.lower(F.trim(F.coalesce(answer, F.lit(""))))
    refused = F.lit(False)
    for marker in REFUSALS:
        refused = refused | F.contains(text, F.lit(marker))
    return F.when(flag.isNotNull(), flag).when(text == "", False).otherwise(~refused)


def word_delta(before: Column, after: Column) -> Column:
    count = lambda c: F.when(F.trim(c) == "", 0).otherwise(F.size(F.split(F.trim(c), r"\s+")))
    return count(after) - count(before)


def first_words(c: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(normalize_text(c), " "), 1, n), " ")


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column) -> Column:
    """Unit vector; null where a component isn't finite or the norm is zero."""
    norm = l2_norm(v)
    bad = F.exists(v, lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) | (norm == 0)
    return F.when(~bad, F.transform(v, lambda x: x / norm))


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def substitute(query: Column, answers: Column) -> Column:
    """{{qN.answer}} by the answers map, for N from 1 to 4."""
    for n in range(1, 5):
        query = F.replace(query, F.lit(f"{{{{q{n}.answer}}}}"), F.coalesce(F.element_at(answers, F.lit(f"q{n}")), F.lit(f"{{{{q{n}.answer}}}}")))
    return query


def evidence_block(hits: Column) -> Column:
    """hits: array of (title, text)."""
    line = lambda e, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("]\nTitle: "), e["title"], F.lit("\n"), e["text"])
    return F.array_join(F.transform(hits, line), "\n\n")


def with_scenario(scenario: Column, question: Column) -> Column:
    return F.when(F.coalesce(F.trim(scenario), F.lit("")) != "", F.concat(F.lit("Scenario: "), scenario, F.lit("\nQuestion: "), question)).otherwise(question)


def heading_path(path: Column, level: Column, text: Column) -> Column:
    return F.concat(F.slice(path, F.lit(1), F.least(level - 1, F.size(path))), F.array(text))


def within_bytes(record: Column, most: int) -> Column:
    """Whether a record, as JSON in UTF-8, has at most so many bytes; a null one has."""
    return F.coalesce(F.octet_length(F.to_json(record)) <= most, F.lit(True))

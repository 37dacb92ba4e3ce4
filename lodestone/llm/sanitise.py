"""Personal data: patterns for protected values, and terms that give a protected value away.

The corpus tells how much a term reveals. With n documents, df documents that hold a term or an entity (a protected
value) and `together` documents in which the term stands within `window` terms of the entity, the pointwise mutual
information is log2(together * n / (df_term * df_entity)); divided by the entity's own information log2(n / df_entity)
it is the share of the entity that the term discloses, between 0 and 1 as `together` is no more than either df. Terms at
or over `generalise` are replaced by their kind, at or over `remove` taken out, wherever they occur. Two conditions keep
chance out: the term must stand by the entity in `support` different texts, as copies of one prove nothing, and the
chance that a term placed at random would do so (at most (e * t / k * m / n) ** k where the entity is in m of n texts and
the term in t, k of them by the entity) times the number of pairs tried must be under `chance`. That test takes copies
of a text once, for the term those by the entity.

Contexts of entities are shuffled, and one row for each different term and task with the number of its documents.
Terms are known by 64-bit hashes; those that disclose are sent to the tasks BLOCK_TERMS at a time, and where there are
more, documents pass through one block after another in the same scan.

Defined cases: a null or empty text has no spans and the digest of ''; positions are code points; a null doc_id passes
through; repeated rows are handled alike; a very long text takes time in proportion to its length; an empty table gives
an empty result."""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lodestone.llm.scratch import saved
from lodestone.llm.words import NOT_TERM, chunks, column_bytes, tokenise

KINDS = ("email", "ip", "card", "phone", "term")
#: Disclosing terms are sent to the tasks in blocks of so many 8-byte hashes.
BLOCK_TERMS = 1 << 22
#: Different terms that a counting task holds before it passes its counts on.
COUNTED_TERMS = 1 << 21
#: Entities of more than one text that are sent to every executor; more are joined by shuffle.
BROADCAST_ENTITIES = 500_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TERM = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Each @ is tried once, with the whole run of local characters before it: the leftmost match, in linear time."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            floor = m.end()
        else:
            floor = max(floor, at + 1) if start < at or text[at] == "@" else floor
        at = text.find("@", max(floor, at + 1))
    return out


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") < 256


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", s, e) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0] if c < "\x80") <= 15]
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def _value(kind: str, value: str) -> str:
    """What counts as the same entity: digits alone for numbers, one case for addresses."""
    return kind + ":" + (value.lower() if kind in ("email", "ip") else "".join(c for c in value if c.isdigit()))


def _lowered(column: pa.Array) -> pa.Array:
    """Lower case, code point by code point: positions stay."""
    return pc.utf8_lower(pc.fill_null(column, ""))


def contexts(docs: DataFrame, window: int) -> DataFrame:
    """(entity, term, mark): the terms within `window` terms of an entity, once a document; term is null once for each
    document that holds the entity. mark is a hash of the text."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, low in zip(batch.column(0), _lowered(batch.column(0))):
                text = text.as_py()
                if not text or not (base := base_spans(text)):
                    continue
                terms = list(_TERM.finditer(low.as_py()))
                starts = np.array([m.start() for m in terms], np.int64)
                mark = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
                near: dict[str, set] = {}
                for kind, s, e in base:
                    a, b = np.searchsorted(starts, [s, e])
                    found = near.setdefault(_value(kind, text[s:e]), set())
                    found.update(m[0] for m in terms[max(0, a - window) : a] if m.end() <= s)
                    found.update(m[0] for m in terms[b : b + window])
                rows += [(entity, t, mark) for entity, found in near.items() for t in (None, *found)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], ["entity", "term", "mark"])

    return docs.select("text").mapInArrow(run, "entity string, term string, mark long")


def term_hashes(terms: pa.Array) -> np.ndarray:
    data, offsets = column_bytes(terms)
    return tokenise(data, offsets, NOT_TERM).hash


@F.pandas_udf(LongType())
def _hash_of_term(terms: pd.Series) -> pd.Series:
    return pd.Series(term_hashes(pa.array(terms, pa.string())).view(np.int64))


def document_frequency(docs: DataFrame) -> DataFrame:
    """(term_hash, df) of all terms of all documents. A task adds up its counts before they are shuffled."""

    def counted(parts: list) -> tuple[np.ndarray, np.ndarray]:
        h, c = (np.concatenate(x) for x in zip(*parts))
        keys, which = np.unique(h, return_inverse=True)
        return keys, np.bincount(which, c, len(keys)).astype(np.int64)

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            data, offsets = column_bytes(_lowered(batch.column(0)))
            for lo, hi in chunks(offsets):
                t = tokenise(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], NOT_TERM)
                if not len(t.hash):
                    continue
                order = np.argsort(t.hash, kind="stable")
                h, doc = t.hash[order], t.doc[order]
                new = np.ones(len(h), bool)
                new[1:] = h[1:] != h[:-1]
                once = new.copy()
                once[1:] |= doc[1:] != doc[:-1]
                first = np.flatnonzero(new)
                parts.append((h[first], np.add.reduceat(once.astype(np.int64), first)))
                held += len(first)
                if held > COUNTED_TERMS:
                    parts = [counted(parts)]
                    held = len(parts[0][0])
                    if held > COUNTED_TERMS // 2:
                        yield packed(*parts[0])
                        parts, held = [], 0
        if parts:
            yield packed(*counted(parts))

    def packed(h, c):
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["term_hash", "df"])

    return docs.select("text").mapInArrow(run, "term_hash long, df long").groupBy("term_hash").agg(F.sum("df").alias("df"))


def disclosing_terms(docs: DataFrame, window: int = 20, support: int = 2, generalise: float = 0.8, chance: float = 0.05) -> DataFrame:
    """(term, term_hash, disclosure): the largest share of an entity's information that the term reveals, where it is
    `generalise` or more and no accident. Saved."""
    found = saved(contexts(docs, window), "contexts")
    n = float(max(docs.count(), 1))
    texts = lambda: F.count_distinct("mark").alias("texts")
    entity = found.filter("term IS NULL").groupBy("entity").agg(F.count("*").alias("df_entity"), texts())
    entity = saved(entity.filter((F.col("texts") >= support) & (F.col("df_entity") < n)).withColumnRenamed("texts", "entity_texts"), "entities")
    # An entity of one text alone can have no disclosing term, and few entities have more.
    several = F.broadcast(entity.select("entity")) if entity.count() <= BROADCAST_ENTITIES else entity.select("entity")
    tried = found.filter("term IS NOT NULL").join(several, "entity", "left_semi").groupBy("entity", "term").agg(F.count("*").alias("together"), texts())
    tried = saved(tried, "pairs")
    pairs = tried.filter(F.col("texts") >= support).withColumn("term_hash", _hash_of_term("term"))
    pairs = saved(pairs.join(entity, "entity"), "candidates")
    df = document_frequency(docs)
    # log10 of the bound on chance, with C(df, k) <= (e df / k) ** k.
    n_texts = float(max(docs.select(F.xxhash64("text").alias("h")).distinct().count(), 1))
    k, t = F.col("texts"), F.col("df") - F.col("together") + F.col("texts")
    accident = k * (F.log10(F.lit(math.e) * t / k) + F.log10(F.col("entity_texts") / n_texts)) + math.log10(max(tried.count(), 1))
    told = F.log2(F.col("together") * n / (F.col("df").cast("double") * F.col("df_entity"))) / F.log2(F.lit(n) / F.col("df_entity"))
    scored = pairs.join(df, "term_hash").filter(accident <= math.log10(chance)).groupBy("term", "term_hash").agg(F.max(F.greatest(told, F.lit(0.0))).alias("disclosure"))
    return saved(scored.filter(F.col("disclosure") >= generalise), "disclosing")


def term_spans(docs: DataFrame, hashes: np.ndarray, gone: np.ndarray) -> DataFrame:
    """docs (doc_id, text, terms) with the disclosing terms of one more block in `terms`: flat triples of start, end and
    whether the term is removed. hashes are sorted."""
    sent = docs.sparkSession.sparkContext.broadcast((hashes, gone))

    def run(batches):
        known, removed = sent.value
        for batch in batches:
            low, more = _lowered(batch.column(1)), {}
            data, offsets = column_bytes(low)
            for lo, hi in chunks(offsets):
                t = tokenise(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], NOT_TERM)
                at = np.minimum(np.searchsorted(known, t.hash), len(known) - 1)
                hit = np.flatnonzero(known[at] == t.hash)
                for d in np.unique(t.doc[hit]).tolist():
                    # Terms come in the same order by bytes as by code points.
                    mine = hit[(hit >= t.bounds[d]) & (hit < t.bounds[d + 1])] - t.bounds[d]
                    spans = [m.span() for m in _TERM.finditer(low[lo + d].as_py())]
                    more[lo + d] = [x for k in mine.tolist() for x in (*spans[k], int(removed[at[t.bounds[d] + k]]))]
            terms = batch.column(2).to_pylist() if more else []
            for d, x in more.items():
                terms[d] = terms[d] + x
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.int32())) if more else batch.column(2)], ["doc_id", "text", "terms"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, terms array<int>")


def sanitised(text: str, spans: list[tuple[str, int, int]], removed: set[tuple[int, int]]) -> str:
    """text without the spans: each by its kind, a term by its form, or nothing if it is removed."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s < at:
            at = max(at, e)
            continue
        word = text[s:e]
        general = f"[{kind}]" if kind != "term" else "" if (s, e) in removed else "[number]" if word.isdigit() else "[name]" if word[:1].isupper() else "[word]"
        out += [text[at:s], general]
        at = e
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, window: int = 20, support: int = 2, generalise: float = 0.8, remove: float = 0.95, chance: float = 0.05, block: int = BLOCK_TERMS) -> DataFrame:
    """For each document: n_email, n_ip, n_card, n_phone, base_sha256, spans, and `sanitised`, the text without them."""
    docs = docs.select("doc_id", "text", F.array().cast("array<int>").alias("terms"))
    terms = disclosing_terms(docs, window, support, generalise, chance)
    fields = [f"n_{k}" for k in KINDS[:4]] + ["base_sha256", "spans", "sanitised"]
    parts = -(-terms.count() // block)
    for k in range(parts):
        rows = terms.filter(F.pmod("term_hash", F.lit(parts)) == k).select("term_hash", (F.col("disclosure") >= remove).alias("gone")).toArrow()
        hashes = rows.column("term_hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        if len(order):
            docs = term_spans(docs, hashes[order], rows.column("gone").to_numpy()[order])

    def run(batches):
        for batch in batches:
            for lo, hi in chunks(column_bytes(batch.column(1))[1]):
                rows = []
                for text, found in zip(batch.column(1)[lo:hi], batch.column(2)[lo:hi].to_pylist()):
                    text = text.as_py() or ""
                    base, found = base_spans(text), sorted(zip(found[::3], found[1::3], found[2::3]))
                    starts, ends, added = sorted(s for _, s, _ in base), list(itertools.accumulate((e for _, _, e in sorted(base, key=lambda x: x[1])), max)), []
                    for s, e, _ in found:
                        before = bisect.bisect_left(starts, e)
                        if not (before and ends[before - 1] > s):
                            added.append(("term", s, e))
                    counts = [sum(k == kind for k, *_ in base) for kind in KINDS[:4]]
                    clean = sanitised(text, base + added, {(s, e) for s, e, gone in found if gone})
                    rows.append([*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(base + added), clean])
                types = [pa.int64()] * 4 + [pa.string()] * 3
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], *[pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]], ["doc_id", *fields])

    ddl = ", ".join(f"n_{k} long" for k in KINDS[:4]) + ", base_sha256 string, spans string, sanitised string"
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {ddl}")


def op7_personal_data(spark, sf_dir: str) -> DataFrame:
    out = sanitise(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS[:4]], "base_sha256", "spans", F.sha2("sanitised", 256).alias("sanitised_sha256"))

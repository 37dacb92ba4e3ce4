"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +-1, drawn from its code point and a seed. An n-gram of letters is the product of
its letters' vectors, each rotated by its place; a document is the sum of its n-grams' vectors; a language is the sum
of its training documents. A document gets the language whose vector has the largest cosine with its own. The sums of
a language are added up in each task and then across tasks, so that only languages x dimensions numbers are shuffled,
whatever the corpus. Language vectors come to the driver and go to the tasks LABELS at a time; with more labels than
that, documents are compared with one block of them after another and keep the best.

Defined cases: a text that is null or has no letter is `und` with score 0, as is every text where nothing can be
learnt; rows with null lang teach nothing; a null doc_id counts as the text ''; equal cosines go to the label first by
code point; repeated rows count as often as they occur; an empty table gives an empty result."""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.scratch import saved
from lodestone.llm.words import chunks, column_bytes

DIMENSIONS = 1024
ORDER = 3
SEED = 1729
#: Labels that are collected and sent to the tasks at once: 64 MB of vectors.
LABELS = 8192
_SPACE = 32


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@lru_cache(20_000)
def _vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    return (np.random.default_rng([seed, code]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1).astype(np.int8)


def _profile(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, n-gram) index of each n-gram, and each n-gram's code points. Words are lower case, one space apart."""
    lowered = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = _letters()[np.minimum(codes, 0x10FFFF)]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (doc[1:] == doc[:-1])
    keep[np.flatnonzero(np.diff(doc, prepend=-1))] = True
    codes, doc = np.where(letter, codes, _SPACE)[keep], doc[keep]
    used = np.flatnonzero(np.bincount(codes, minlength=_SPACE + 1))
    place = np.zeros(used[-1] + 1 if len(used) else 1, np.int64)
    place[used] = np.arange(len(used))
    ids, n = place[codes], len(codes) - order + 1
    if n <= 0:
        return np.zeros((2, 0), np.int64), np.zeros(0, np.int64), np.zeros((order, 0), np.int64)
    gram = np.zeros(n, np.int64)
    for k in range(order):
        gram = gram * len(used) + ids[k : k + n]
    whole = doc[:n] == doc[order - 1 :]
    gram, doc = gram[whole], doc[:n][whole]
    if len(used) ** order <= 1 << 22:
        present = np.flatnonzero(np.bincount(gram, minlength=1))
        at = np.zeros(len(used) ** order, np.int64)
        at[present] = np.arange(len(present))
        which = at[gram]
    else:
        present, which = np.unique(gram, return_inverse=True)
    letters = np.stack([used[present // len(used) ** (order - 1 - k) % len(used)] for k in range(order)]) if len(present) else np.zeros((order, 0), np.int64)
    return np.stack([doc, which]), present, letters


def _sums(groups: np.ndarray, which: np.ndarray, letters: np.ndarray, n: int, dimensions: int, seed: int) -> np.ndarray:
    """For each of n groups, the sum of its n-grams' vectors."""
    order, total = letters.shape
    out = np.zeros((n, dimensions), np.float64)
    step = 4096
    used, inverse = np.unique(letters, return_inverse=True)
    inverse = inverse.reshape(letters.shape)
    base = np.stack([_vector(int(c), dimensions, seed) for c in used]) if len(used) else np.zeros((0, dimensions), np.int8)
    rolled = [np.roll(base, order - 1 - k, axis=1) for k in range(order)]
    arranged = np.argsort(which // step, kind="stable") if total > step else None
    if arranged is not None:
        groups, which = groups[arranged], which[arranged]
    for lo in range(0, total, step):
        hi = min(lo + step, total)
        a, b = np.searchsorted(which // step, [lo // step, lo // step + 1]) if total > step else (0, len(which))
        vectors = rolled[0][inverse[0, lo:hi]]
        for k in range(1, order):
            vectors = vectors * rolled[k][inverse[k, lo:hi]]
        counts = np.bincount(groups[a:b] * (hi - lo) + which[a:b] - lo, minlength=n * (hi - lo)).reshape(n, hi - lo)
        out += counts.astype(np.float32) @ vectors.astype(np.float32)
    return out


def _blocks(column: pa.Array):
    _, offsets = column_bytes(column)
    for lo, hi in chunks(offsets, 1 << 19):
        while lo < hi:
            top = min(hi, lo + 512)
            yield lo, top, [t or "" for t in column[lo:top].to_pylist()]
            lo = top


def learn(docs: DataFrame, dimensions: int = DIMENSIONS, order: int = ORDER, seed: int = SEED) -> DataFrame:
    """(lang, v): language vectors of documents (text, lang), saved."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lo, hi, texts in _blocks(batch.column(0)):
                langs = batch.column(1)[lo:hi].to_pylist()
                names = sorted(set(langs))
                at = {x: i for i, x in enumerate(names)}
                (doc, which), _, letters = _profile(texts, order)
                groups = np.array([at[x] for x in langs], np.int64)[doc]
                for x, v in zip(names, _sums(groups, which, letters, len(names), dimensions, seed)):
                    sums[x] = sums.get(x, 0) + v
                if len(sums) >= LABELS:
                    yield packed(sums)
                    sums = {}
        yield packed(sums)

    def packed(sums):
        names = sorted(sums)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([sums[x].astype(np.int64) for x in names], pa.list_(pa.int64()))], ["lang", "v"])

    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))
    parts = known.mapInArrow(run, "lang string, v array<long>")
    total = parts.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
    rows = total.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda s: s["x"]).alias("v"))
    return saved(rows.filter(F.exists("v", lambda x: x != 0)), "languages")


def predict(docs: DataFrame, prototypes: DataFrame, labels: int = LABELS, order: int = ORDER, seed: int = SEED) -> DataFrame:
    """docs (row: a struct with text) to (row, lang_pred, score)."""
    sc = docs.sparkSession.sparkContext
    ddl = f"row {docs.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    out = docs.select("row", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    block: list = []
    # In order of their names, so that of equal cosines the first one stays.
    rows = prototypes.orderBy("lang")
    local = iter(rows.collect() if prototypes.count() <= labels else rows.toLocalIterator())

    def compared(before: DataFrame, block: list) -> DataFrame:
        matrix = np.stack([np.array(r["v"], np.float64) for r in block])
        sent = sc.broadcast(([r["lang"] for r in block], (matrix / np.linalg.norm(matrix, axis=1, keepdims=True)).T))

        def run(batches):
            names, unit = sent.value
            for batch in batches:
                for lo, hi, texts in _blocks(batch.column(0).field("text")):
                    (doc, which), _, letters = _profile(texts, order)
                    v = _sums(doc, which, letters, len(texts), len(unit), seed)
                    has = np.zeros(len(texts), bool)
                    has[doc] = True
                    cosines = np.round(v @ unit / np.maximum(np.linalg.norm(v, axis=1), 1e-9)[:, None], 9)
                    best = cosines.argmax(1)
                    said, scores = batch.column(1)[lo:hi].to_pylist(), batch.column(2)[lo:hi].to_numpy()
                    mine = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
                    new = has & ((np.array(said, object) == "und") | (mine > scores))
                    labels_ = [names[b] if n else x for b, n, x in zip(best, new, said)]
                    yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(labels_, pa.string()), pa.array(np.where(new, mine, scores), pa.float64())], ["row", "lang_pred", "score"])

        return before.mapInArrow(run, ddl)

    while block := list(itertools.islice(local, labels)):
        out = compared(out, block)
    return out


def identify(docs: DataFrame, folds: int = 3, held: int = 1, **options) -> DataFrame:
    """Learn from the documents outside the held-out fold, then label all. Gives row (the document), held_out, lang_pred, score."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == held
    prototypes = learn(docs.filter(~fold), **options)
    dims = {k: v for k, v in options.items() if k != "dimensions"}
    said = predict(docs.select(F.struct("*").alias("row")), prototypes, **dims)
    held_out = F.crc32(F.coalesce(F.col("row")["doc_id"].cast("string"), F.lit("")).cast("binary")) % folds == held
    return said.select("row", held_out.alias("held_out"), "lang_pred", "score")


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    said = predict(docs.select(F.struct("doc_id", "text").alias("row")), learn(docs.filter(~fold)))
    return said.select(F.col("row")["doc_id"].alias("doc_id"), "lang_pred", "score").select("doc_id", fold.alias("held_out"), "lang_pred", "score")

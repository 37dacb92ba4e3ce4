"""Benchmark decontamination: an inverted index of test items, searched with every passage of every document.

Items are cut into parts of at most `part` terms, a document into overlapping passages of twice that, so that some
passage holds each copied part whole. A part's BM25 weights are divided by its own score, which makes the threshold
one number for all parts. For each term the index has its largest weight in each block of parts of similar length: a
passage skips each block whose sum of bounds is under the threshold, and only what is left is scored (block-max WAND
with a fixed threshold, for many passages at once). Nothing over the threshold is lost. Hits are verified on the
document: enough of the five-term runs of the item's question, and of the terms of its answer in order, must be there.

The index is built by Spark and sent to the tasks in shards of bounded size, one pass over the documents for each
SHARD_BYTES of test items: the number of passes follows the benchmark and not the documents. Item ids, of any type,
are carried as Arrow values.

Defined cases: null or empty texts hold nothing and an item without terms matches nothing; items with equal text are
all reported; an item of fewer than five terms is one run; rows with null ids are reported with null; repeated rows are
each reported; an empty table on either side gives an empty result."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.scratch import saved
from lodestone.llm.words import NOT_TERM, Tokens, chunks, column_bytes, ngrams, tokenise

K1, B = 1.2, 0.75
PART = 64
BLOCK = 16
INDEX_PARTS = 1024
#: Bytes of item text in one shard of the index.
SHARD_BYTES = 8 << 20
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def split_item(text: str) -> tuple[str, str]:
    """(question, answer): the last sentence is the answer; of one sentence, the last third of the words."""
    parts = [p for p in _SENTENCE.split(text.strip()) if p]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = len(words) - len(words) // 3
    return " ".join(words[:cut]), " ".join(words[cut:])


def _tokens(texts: list[str]) -> Tokens:
    data, offsets = column_bytes(pc.utf8_lower(pa.array(texts, pa.string())))
    return tokenise(data, offsets, NOT_TERM)


def _runs(tokens: Tokens, i: int, n: int = 5) -> np.ndarray:
    """The n-term runs of text i, or its only shorter one, as hashes."""
    lo, hi = tokens.bounds[i], tokens.bounds[i + 1]
    one = Tokens(tokens.hash[lo:hi], tokens.start[lo:hi], tokens.stop[lo:hi], np.array([0, hi - lo]))
    return ngrams(one, min(n, hi - lo))[0] if hi > lo else np.zeros(0, np.uint64)


def postings(items: DataFrame, part: int) -> DataFrame:
    """(item, part, term, tf, length) from items (item, text)."""

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(pc.utf8_lower(batch.column(1)))
            t = tokenise(data, offsets, NOT_TERM)
            doc = t.doc
            place = np.arange(len(doc)) - t.bounds[:-1][doc]
            # Parts of equal length: a text of 65 terms is 33 and 32, not 64 and 1.
            n = np.diff(t.bounds)
            parts = np.maximum(1, -(-n // part))
            which = place * parts[doc] // np.maximum(n[doc], 1)
            key, count = np.unique(np.stack([doc.astype(np.uint64), which.astype(np.uint64), t.hash]), axis=1, return_counts=True)
            _, size = np.unique(np.stack([doc, which]), axis=1, return_counts=True)
            _, inverse = np.unique(key[:2], axis=1, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column(0).take(pa.array(key[0].astype(np.int64)))), pa.array(key[1].astype(np.int32)), pa.array(key[2].view(np.int64)), pa.array(count.astype(np.int32)), pa.array(size[inverse.ravel()].astype(np.int32)) if len(count) else pa.array([], pa.int32())],
                ["item", "part", "term", "tf", "length"],
            )

    return items.select("item", "text").mapInArrow(run, "item long, part int, term long, tf int, length int")


class Index:
    """Up to INDEX_PARTS parts: weights by block of parts, and the largest of each term in each block. Parts come in the
    order of their length, so that the bounds of a block are close to its parts' own weights."""

    def __init__(self, term: np.ndarray, part: np.ndarray, weight: np.ndarray, parts: int):
        self.parts, self.blocks = parts, -(-parts // BLOCK)
        self.terms, which = np.unique(term, return_inverse=True)
        self.bounds = np.zeros((len(self.terms), self.blocks), np.float32)
        np.maximum.at(self.bounds, (which, part // BLOCK), np.nextafter(weight.astype(np.float32), np.float32(2)))
        self.weights, self.row = [], np.zeros((self.blocks, len(self.terms)), np.int32)
        for b in range(self.blocks):
            mine = part // BLOCK == b
            local, at = np.unique(which[mine], return_inverse=True)
            dense = np.zeros((len(local) + 1, BLOCK), np.float32)
            dense[at + 1, part[mine] % BLOCK] = weight[mine]
            self.row[b, local] = np.arange(1, len(local) + 1)
            self.weights.append(dense)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, term numbers) of the hashes that are indexed."""
        maybe = np.flatnonzero(self.filter[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, hashes[maybe]), len(self.terms) - 1)
        hit = self.terms[at] == hashes[maybe]
        return maybe[hit], at[hit]

    def search(self, cell: np.ndarray, term: np.ndarray, pair: np.ndarray, cells: int, threshold: float) -> list[tuple[int, int, float]]:
        """cell, term: the different indexed terms of each cell of a document, in order. A passage is a cell and, where
        pair is true, the next one of its document. Gives (first cell, part, score) of all passages over the threshold."""
        start = np.searchsorted(cell, np.arange(cells + 1))
        upper, low = self._sums(self.bounds, term, start), np.float32(threshold - 1e-4)
        open_ = upper[:-1] + upper[1:] * pair[:, None] >= low
        out = []
        for b in np.flatnonzero(open_.any(0)).tolist():
            # The cells of open passages, scored alone: their sums bound the passage's score for each part.
            need = np.append(open_[:, b], False)
            need[1:] |= need[:-1] & np.append(pair, False)[:-1]
            kept = need[cell]
            rows, at = self.row[b, term[kept]], np.append(0, np.cumsum(kept))[start]
            alone = self._sums(self.weights[b], rows, at)
            for c in np.flatnonzero(open_[:, b] & ((alone[:-1] + alone[1:] * pair[:, None]).max(1) >= low)).tolist():
                terms = np.unique(term[start[c] : start[c + 1 + pair[c]]])
                score = self.weights[b][self.row[b, terms]].sum(0, dtype=np.float64)
                out += [(c, b * BLOCK + int(p), float(score[p])) for p in np.flatnonzero(score >= threshold - 1e-6)]
        return out

    @staticmethod
    def _sums(table: np.ndarray, rows: np.ndarray, start: np.ndarray) -> np.ndarray:
        """For each cell, the sum of its rows of table; one more cell, of zeros, at the end."""
        out = np.zeros((len(start), table.shape[1]), np.float32)
        some = np.flatnonzero(start[1:] > start[:-1])
        if len(some):
            out[some] = np.add.reduceat(table[rows], start[some], axis=0)
        return out


def _overlap(item: tuple, text: Tokens, i: int) -> tuple[float, float]:
    """Shares of the question's runs, and of the answer's terms on one diagonal of text i, that the text holds. item:
    the runs, their length, and the answer's terms."""
    runs, length, answer = item
    q = float(np.isin(runs, _runs(text, i, length)).mean()) if len(runs) else 1.0
    if not len(answer):
        return q, 1.0
    have = text.hash[text.bounds[i] : text.bounds[i + 1]]
    places: dict[int, list[int]] = {}
    for k, h in enumerate(answer.tolist()):
        places.setdefault(h, []).append(k)
    slack = max(2, len(answer) // 4)
    near = np.array(sorted((int(p) - k, k) for p in np.flatnonzero(np.isin(have, answer)) for k in places[int(have[p])]), np.int64).reshape(-1, 2)
    end = np.searchsorted(near[:, 0], near[:, 0] + slack, side="right")
    best = 0
    for j in np.argsort(np.arange(len(near)) - end, kind="stable"):
        if end[j] - j <= best:
            break
        best = max(best, len(np.unique(near[j : end[j], 1])))
    return q, best / len(answer)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.5, question: float = 0.5, answer: float = 0.5, part: int = PART) -> DataFrame:
    """docs (doc_id, text) against items (item_id, text): doc_id, item_id, score (share of the part's own BM25 score in
    the best passage), question_overlap and answer_overlap, for each verified pair."""
    spark = docs.sparkSession
    items = items.select("item_id", "text").filter("text IS NOT NULL").withColumn("item", F.xxhash64("item_id", "text"))
    listed = saved(items.dropDuplicates(["item"]), "items")
    lists = saved(postings(listed, part), "postings")
    totals = lists.select("item", "part", "length").distinct().agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
    n, mean = totals["n"], totals["mean"] or 1.0
    df = lists.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(mean)))
    weighed = saved(lists.join(df, "term").withColumn("weight", weight), "weights")
    size = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    out = None
    for k in range(shards):
        mine = F.pmod(F.col("item"), F.lit(shards)) == k
        found = _pass(spark, docs, listed.filter(mine).toArrow(), items.schema["item_id"].dataType.simpleString(), weighed.filter(mine).toPandas(), threshold, question, answer, part)
        out = found if out is None else out.unionByName(found)
    return out


def _pass(spark, docs, listed: pa.Table, id_kind: str, weighed, threshold, question, answer, part) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {id_kind}, score double, question_overlap double, answer_overlap double"
    if not len(weighed):
        return spark.createDataFrame([], schema)
    weighed = weighed.sort_values(["length", "item", "part"])
    keys = weighed.groupby(["length", "item", "part"]).ngroup().to_numpy()
    own = np.bincount(keys, weighed["weight"])
    term, share, parts = weighed["term"].to_numpy().view(np.uint64), weighed["weight"].to_numpy() / own[keys], int(keys.max()) + 1
    indexes = []
    for lo in range(0, parts, INDEX_PARTS):
        mine = (keys >= lo) & (keys < lo + INDEX_PARTS)
        indexes.append((lo, Index(term[mine], keys[mine] - lo, share[mine], min(parts - lo, INDEX_PARTS))))
    item_at = {v: i for i, v in enumerate(listed.column("item").to_pylist())}
    part_item = np.zeros(parts, np.int64)
    part_item[keys] = weighed["item"].map(item_at)
    halves = [split_item(t) for t in listed.column("text").to_pylist()]
    q, a = _tokens([h[0] for h in halves]), _tokens([h[1] for h in halves])
    details = [(_runs(q, i), min(5, int(q.bounds[i + 1] - q.bounds[i])), a.hash[a.bounds[i] : a.bounds[i + 1]]) for i in range(len(halves))]
    ids = listed.column("item_id").combine_chunks()
    sent = spark.sparkContext.broadcast((indexes, part_item, details, ids))

    def run(batches):
        indexes, part_item, details, ids = sent.value
        for batch in batches:
            data, offsets = column_bytes(pc.utf8_lower(batch.column(1)))
            rows = []
            for lo, hi in chunks(offsets):
                t = tokenise(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], NOT_TERM)
                count = np.diff(t.bounds)
                per = -(-count // part)
                first = np.append(0, np.cumsum(per))
                pair = np.ones(first[-1], bool)
                pair[first[1:][per > 0] - 1] = False
                best: dict[tuple[int, int], float] = {}
                for base, index in indexes:
                    at, term = index.known(t.hash)
                    doc = np.searchsorted(t.bounds, at, side="right") - 1
                    cell = first[doc] + (at - t.bounds[doc]) // part
                    both = np.unique(cell * len(index.terms) + term)
                    for c, p, score in index.search(both // len(index.terms), both % len(index.terms), pair, int(first[-1]), threshold):
                        key = (int(np.searchsorted(first, c, side="right")) - 1, int(part_item[base + p]))
                        best[key] = max(best.get(key, 0.0), score)
                for (d, i), score in best.items():
                    q_share, a_share = _overlap(details[i], t, d)
                    if q_share >= question and a_share >= answer:
                        rows.append((lo + d, i, score, q_share, a_share))
            yield pa.RecordBatch.from_arrays(
                [*[x.take(pa.array([r[k] for r in rows], pa.int64())) for k, x in enumerate((batch.column(0), ids))], *[pa.array([r[k] for r in rows], pa.float64()) for k in range(2, 5)]],
                ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

"""Language-model scores by Katz backoff of any order, three by default.

Counts are kept in tables, one for each order, cut in buckets by the leading bits of an n-gram's hash. Documents are
packed into blocks; for each order a block sends each bucket its different n-grams once, as sorted arrays with their
training counts, and the bucket adds them up, writes its part of the table and answers each block with the counts of
just those n-grams. So the corpus moves as arrays, not as a row for each token, a frequent n-gram is one entry a block,
and every task holds one block or one bucket. Blocks and buckets grow with the square root of the corpus up to a bound
of memory, so that the arrays stay long: their number is the product of both.

P(w | h) = d(c) c(h w) / c(h) where the n-gram h w was seen, else alpha(h) P(w | h') with the first word of h left out,
down to P(w) = d(c) c(w) / N, where all words never seen share what the discounts leave; a context never seen passes
the question on as it is. d(c) is Katz's Good-Turing discount for counts up to 5, by order; beyond, and where the counts
of counts don't give one between 0 and 1, an absolute discount, so that something is always left. alpha(h) = (1 - sum
of P(w | h) over seen w) / (1 - sum of P(w | h') over the same w), from sums over all blocks: each n-gram is summed by
the first block that has it. The probabilities after any h therefore add up to 1. Sums move only for contexts that some
scored text may back off from; the blocks say which when they ask for counts.

Defined cases: a null or empty text is one token, the end; with no training document every score is 0; a null doc_id
counts as the text '' and is returned as null; repeated rows count and are scored each; a text longer than a block is a
block of its own; an empty table gives an empty result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.scratch import dropped, release_shuffles, saved
from lodestone.llm.words import _STEP, chunks, column_bytes, mix64, tokenise

ORDER = 3
#: Bytes of text in a block and tokens in a bucket: at least, and at most for the memory of a task.
BLOCK_BYTES, MOST_BLOCK_BYTES = 6 << 20, 24 << 20
BUCKET_TOKENS, MOST_BUCKET_TOKENS = 2_000_000, 8_000_000
#: Up to so many bytes of text the smallest blocks do.
SMALL_CORPUS = 64 << 30
#: Parts in which a block's answers and its sums move, and in which n-grams beyond pairs are counted.
SLICES, COUNT_SLICES = 4, 2
GOOD_TURING = 5
#: Taken from counts that Good-Turing leaves alone.
ABSOLUTE = 0.1
STEP = 2.0**-24
_U = np.uint64
END, START = _U(0x0123456789ABCDEF), _U(0xFEDCBA9876543210)


def packed(raw: bytes) -> bytes:
    """Compressed here, as shuffles only look for repeats and these are numbers of few bits; the size is in front."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], decompressed_size=int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def planes(x: np.ndarray) -> bytes:
    """Numbers by byte plane, so that codecs see what is alike."""
    return packed(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def unplanes(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(unpacked(raw), np.uint8).reshape(size, -1).T).view(kind).ravel()


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers by byte plane without the planes that are zero; the first byte is the number of planes."""
    size = (int(x.max(initial=0)).bit_length() + 7) // 8
    return packed(bytes([size]) + np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(len(x), 8).T[:size]).tobytes())


def wide(raw: bytes, n: int) -> np.ndarray:
    """The n numbers of narrow()."""
    raw, out = unpacked(raw), np.zeros((8, n), np.uint8)
    if raw[0]:
        out[: raw[0]] = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], n)
    return np.ascontiguousarray(out.T).view(np.uint64).ravel()


def sorted_planes(keys: np.ndarray) -> bytes:
    """Different sorted keys as differences: about 5 bytes each. The number of keys is in front."""
    return len(keys).to_bytes(8, "little") + narrow(np.diff(keys, prepend=_U(0)))


def unsorted_planes(raw: bytes) -> np.ndarray:
    return np.cumsum(wide(raw[8:], int.from_bytes(raw[:8], "little")), dtype=np.uint64)


def bits(flags: np.ndarray) -> bytes:
    return packed(np.packbits(flags).tobytes())


def unbits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(unpacked(raw), np.uint8))[:n].astype(bool)


def discounts(counts_of_counts: dict[int, int]) -> np.ndarray:
    """d(0), ..., d(GOOD_TURING), d of anything larger is (c - ABSOLUTE) / c."""
    n = [counts_of_counts.get(r, 0) for r in range(GOOD_TURING + 2)]
    out = np.ones(GOOD_TURING + 1)
    cut = (GOOD_TURING + 1) * n[GOOD_TURING + 1] / n[1] if n[1] else 1.0
    plain = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    for r in range(1, GOOD_TURING + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut < 1 else -1.0
        out[r] = d if 0 < d < 1 else (r - plain) / r
    return out


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """d(c) * c in whole steps of STEP, so that sums of them are exact in any order and short when packed."""
    return np.rint(np.where(c <= GOOD_TURING, d[np.minimum(c, GOOD_TURING)] * c, c - ABSOLUTE) / STEP) * STEP


def different(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted different keys, where each stands, the number of each key), with less memory than numpy's own."""
    order = np.argsort(keys)
    arranged = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = arranged[1:] != arranged[:-1]
    arranged, first = arranged[new], order[new]
    number = np.cumsum(new, dtype=np.int32)
    number -= 1
    which = np.empty(len(keys), np.int32)
    which[order] = number
    return arranged, first.astype(np.int32) if len(keys) < 2**31 else first, which


class _Block:
    """The tokens of a block; texts end with the end token. For each order n, from 1: grams[n], the sorted hashes of the
    different n-grams; first[n], where each stands once; which[n], the number of the n-gram that ends at a token;
    context[n], the number of the order n - 1 before a token, len(grams[n - 1]) where that is only starts."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, train: np.ndarray, order: int):
        self.lengths = lengths
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.train = train[self.doc]
        begin = np.cumsum(lengths) - lengths
        self.grams, self.which, self.context, self.starts = [None, words], [None, tokens], [None, None], [None, START]
        self.first = [None, None]
        for n in range(2, order + 1):
            before = np.empty(len(tokens), np.int32)
            before[1:] = self.which[-1][:-1]
            before[begin] = len(self.grams[-1])
            key = np.append(self.grams[-1], self.starts[-1])[before]
            key *= _STEP[0]
            key += words[tokens] * _STEP[1] + _U(n)
            for kept, x in zip((self.grams, self.first, self.which), different(mix64(key))):
                kept.append(x)
            self.context.append(before)
            self.starts.append(mix64(np.array([START + _U(n)]))[0])

    def counts(self, n: int) -> np.ndarray:
        """How often each n-gram stands in this block's training texts."""
        return np.bincount(self.which[n][self.train], minlength=len(self.grams[n]))

    def wanted(self, n: int) -> np.ndarray:
        """Which n-grams some text of this block may back off from: a word follows that this block hasn't seen there."""
        out = np.zeros(len(self.grams[n]) + 1, bool)
        if n + 1 < len(self.grams):
            new = self.counts(n + 1)[self.which[n + 1]] == 0
            out[self.context[n + 1][new]] = True
        return out[:-1]


_BLOCK_DDL = "block long, ids array<{kind}>, lengths binary, train binary, words binary, ranks binary, tokens binary, n long"


def pack(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs (doc_id, text, train) in blocks of about so many bytes of text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            train = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
            for lo, hi in chunks(offsets, block_bytes):
                hashes, lengths = [], []
                inner = offsets[lo : hi + 1] - offsets[lo]
                piece = data[offsets[lo] : offsets[hi]]
                for a, b in chunks(inner):
                    t = tokenise(piece[inner[a] : inner[b]], inner[a : b + 1] - inner[a])
                    # An end after each text's words.
                    hashes.append(np.insert(t.hash, t.bounds[1:], END))
                    lengths.append(np.diff(t.bounds) + 1)
                words, _, tokens = different(np.concatenate(hashes))
                # Numbers by how frequent a word is are small for most tokens, and small after a codec.
                by_count = np.argsort(-np.bincount(tokens, minlength=len(words)), kind="stable").astype(np.int32)
                rank = np.empty(len(words), np.int32)
                rank[by_count] = np.arange(len(words), dtype=np.int32)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([(part << 32) + number]), "ids": pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column(0)[lo:hi]),
                    "lengths": [np.concatenate(lengths).astype(np.int32).tobytes()], "train": [train[lo:hi].tobytes()],
                    "words": [sorted_planes(words)], "ranks": [narrow(rank)], "tokens": [narrow(rank[tokens])], "n": pa.array([len(tokens)]),
                })
                number += 1

    return docs.select("doc_id", "text", "train").mapInArrow(run, _BLOCK_DDL.format(kind=kind))


def _unpack(row: dict, order: int) -> _Block:
    words = unsorted_planes(row["words"])
    by_count = np.empty(len(words), np.int32)
    by_count[wide(row["ranks"], len(words)).astype(np.int64)] = np.arange(len(words), dtype=np.int32)
    return _Block(
        words, by_count[wide(row["tokens"], row["n"]).astype(np.int64)], np.frombuffer(row["lengths"], np.int32).astype(np.int64), np.frombuffer(row["train"], np.uint8).astype(bool), order
    )


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's slice of the sorted keys begins and ends."""
    edges = (np.arange(1, buckets, dtype=np.float64) * (2.0**64 / buckets)).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _ranges(buckets: int, slices: int) -> list[tuple[int, int]]:
    """The buckets in at most so many ranges, none of them empty."""
    edges = [buckets * k // slices for k in range(slices + 1)]
    return [(lo, hi) for lo, hi in zip(edges, edges[1:]) if lo < hi]


def _requests(blocks: DataFrame, n: int, order: int, buckets: int, lo: int, hi: int) -> DataFrame:
    """(bucket, block, keys, counts, wanted): a block's different n-grams of order n in each bucket from lo, which is
    given as 0, to before hi."""

    def run(batches):
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                b = _unpack(row, min(n + 1, order))
                keys, counts, wanted = b.grams[n], b.counts(n).astype(np.uint64), b.wanted(n)
                cut = _cuts(keys, buckets)
                full = [k for k in np.flatnonzero(np.diff(cut)).tolist() if lo <= k < hi]
                del b
                part = lambda pack_, x: pa.array([pack_(x[cut[k] : cut[k + 1]]) for k in full], pa.binary())  # noqa: B023, E731
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([k - lo for k in full], pa.int32()), "block": pa.array([row["block"]] * len(full), pa.int64()),
                    "keys": part(sorted_planes, keys), "counts": part(narrow, counts), "wanted": part(bits, wanted),
                })

    return blocks.select("block", "lengths", "train", "words", "ranks", "tokens", "n").mapInArrow(run, "bucket int, block long, keys binary, counts binary, wanted binary")


def _count(table: pa.Table) -> pa.Table:
    """One bucket: its part of the table (kind 0), and for each block (kind 1) the totals of its keys, whether the block
    answers for a key, and whether any block may back off from it."""
    blocks = table.column("block").to_numpy()
    order = np.argsort(blocks, kind="stable")
    rows = table.select(["keys", "counts", "wanted"]).to_pylist()
    keys = [unsorted_planes(rows[i]["keys"]) for i in order]
    sizes = np.array([len(k) for k in keys])
    every, first, which = different(np.concatenate(keys))
    del keys
    # Sums of whole numbers in floats would round beyond 2 ** 53.
    total, wanted = np.zeros(len(every), np.uint64), np.zeros(len(every), bool)
    at = np.append(0, np.cumsum(sizes))
    for i, a, b in zip(order, at, at[1:]):
        mine = which[a:b]  # different keys, so plain indexing adds each once
        total[mine] += wide(rows[i]["counts"], b - a)
        wanted[mine] |= unbits(rows[i]["wanted"], b - a)
    own = np.zeros(len(which), bool)
    own[first] = True
    seen = total > 0
    bucket, k = table.column("bucket")[0].as_py(), len(order)
    slices = list(zip(at, at[1:]))
    return pa.table({
        "kind": pa.array([0] + [1] * k, pa.int8()), "bucket": pa.array([bucket] * (k + 1), pa.int32()), "block": pa.array([None, *blocks[order].tolist()], pa.int64()),
        "keys": pa.array([sorted_planes(every[seen])] + [None] * k, pa.binary()),
        "counts": pa.array([narrow(total[seen])] + [narrow(total[which[a:b]]) for a, b in slices], pa.binary()),
        "n": pa.array([int(seen.sum()), *sizes.tolist()], pa.int64()),
        "own": pa.array([None] + [bits(own[a:b]) for a, b in slices], pa.binary()),
        "wanted": pa.array([None] + [bits(wanted[which[a:b]]) for a, b in slices], pa.binary()),
    })


def _statistics(table: DataFrame) -> dict[int, int]:
    """How many n-grams of an order occur r times, up to GOOD_TURING + 1; -1: all, -2: their sum."""

    def run(batches):
        total: dict[int, int] = {}
        for batch in batches:
            for counts, size in zip(batch.column(0), batch.column(1).to_pylist()):
                c = wide(counts.as_py(), size)
                few = np.bincount(np.minimum(c, GOOD_TURING + 2).astype(np.int64), minlength=GOOD_TURING + 3)
                for r, n in [*((r, int(few[r])) for r in range(1, GOOD_TURING + 2)), (-1, len(c)), (-2, int(c.sum(dtype=np.uint64)))]:
                    total[r] = total.get(r, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["r", "n"])

    return {r["r"]: r["n"] for r in table.select("counts", "n").mapInArrow(run, "r int, n long").groupBy("r").agg(F.sum("n").alias("n")).collect()}


class Model:
    """What all tasks need: sizes and discounts, a few numbers for each order."""

    def __init__(self, stats: list[dict[int, int]], starts: int):
        self.order, self.n, self.v, self.starts = len(stats), stats[0].get(-2, 0), stats[0].get(-1, 0), starts
        self.d = [None, *(discounts(s) for s in stats)]
        few = np.array([stats[0].get(r, 0) for r in range(GOOD_TURING + 1)], np.float64)
        few[0] = 0
        r = np.arange(GOOD_TURING + 1)
        kept = float((discounted(r, self.d[1]) * few).sum() + (self.n - (r * few).sum()) - ABSOLUTE * (self.v - few.sum()))
        self.unknown = 1.0 if not self.n else 1.0 - kept / self.n

    def word(self, c: np.ndarray) -> np.ndarray:
        """P(w) of words counted c times."""
        return np.where(c > 0, discounted(c, self.d[1]) / max(self.n, 1), self.unknown)


def _answers(rows: list[dict], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, owned and wanted of a block's n-grams of order n."""
    mine = sorted((r for r in rows if r["part"] == n), key=lambda r: r["bucket"])
    counts = [wide(r["counts"], r["n"]).astype(np.int64) for r in mine]
    flag = lambda name: np.concatenate([unbits(r[name], len(c)) for r, c in zip(mine, counts)])
    return np.concatenate(counts), flag("own"), flag("wanted")


def _partial(model: Model, buckets: int, kind: str):
    """Scores of a block but for its backoff weights, and what it adds to the sums behind those."""

    def run(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        row, said = blocks.to_pylist()[0], replies.to_pylist()
        b = _unpack(row, model.order)
        count, own, wanted = zip((None, None, None), *(_answers(said, n) for n in range(1, model.order + 1)))
        # Counts of contexts: those of the order below, and of starts.
        before = [None, *(np.append(c, model.starts) for c in count[1:])]
        c1 = count[1]
        value, left = np.zeros(len(b.doc)), np.ones(len(b.doc), bool)
        keys, a_sums, b_sums, wholes, asked_for, asks = [], [], [], [], [], []
        for n in range(model.order, 1, -1):
            c, h = count[n], b.context[n]
            ch, cg = before[n - 1][h], c[b.which[n]]
            seen = left & (cg > 0)
            value[seen] = np.log10(discounted(cg[seen], model.d[n]) / ch[seen])
            left &= ~seen
            back = left & (ch > 0)
            size = len(b.grams[n - 1]) + 1
            mine = np.flatnonzero(own[n] & (c > 0))
            at = b.first[n][mine]
            mine, at = (x[np.append(wanted[n - 1], True)[h[at]]] for x in (mine, at))
            # Counts and what discounts take from them are added up apart: both are short when packed.
            whole = count[n - 1][b.which[n - 1][at]]
            a_sum = np.bincount(h[at], discounted(c[mine], model.d[n]), size)
            b_sum, whole = np.bincount(h[at], whole - discounted(whole, model.d[n - 1]), size), np.bincount(h[at], whole, size)
            asked = np.zeros(size, bool)
            asked[h[back]] = True
            used = np.flatnonzero(asked | (np.bincount(h[at], minlength=size) > 0))
            place = np.zeros(size, np.int64)
            place[used] = np.arange(len(used)) + sum(map(len, keys))
            keys.append(np.append(b.grams[n - 1], b.starts[n - 1])[used])
            a_sums.append(a_sum[used])
            b_sums.append(b_sum[used])
            wholes.append(whole[used])
            asked_for.append(asked[used])
            # What a document asks for: its number, the context, how often, and the counts that the sums are shares of.
            pairs, some, times = np.unique(b.doc[back].astype(np.int64) * size + h[back], return_index=True, return_counts=True)
            where = np.flatnonzero(back)[some]
            below = before[n - 2][b.context[n - 1][where]] if n > 2 else np.full(len(where), model.n)
            asks.append(np.stack([pairs // size, place[pairs % size], times, ch[where], below]))
        value[left] = np.log10(model.word(c1)[b.which[1][left]])
        every = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        rank = np.empty(len(every), np.int64)
        rank[order] = np.arange(len(every))
        joined = [np.concatenate(x)[order] if x else np.zeros(0) for x in (a_sums, b_sums, wholes)]
        flags = np.concatenate(asked_for)[order] if asked_for else np.zeros(0, bool)
        ask = np.concatenate(asks, axis=1).astype(np.int64) if asks else np.zeros((5, 0), np.int64)
        # Replies come for the keys asked for only, in their order.
        ask[1] = (np.cumsum(flags) - 1)[rank[ask[1]]] if ask.size else ask[1]
        every = every[order]
        cut = _cuts(every, buckets)
        full = np.flatnonzero(np.diff(cut)).tolist()
        k, docs = len(full), len(b.lengths)
        add = lambda x: np.bincount(b.doc, x, docs)
        base = np.log10((c1 + 0.5) / (model.n + 0.5 * (model.v + 1)))
        part = lambda pack_, x: [pack_(x[cut[i] : cut[i + 1]]) for i in full]
        return pa.table({
            "kind": pa.array([0] + [1] * k, pa.int8()), "block": pa.array([row["block"]] * (k + 1)), "bucket": pa.array([None, *full], pa.int32()),
            "asks": pa.array([ask.shape[1]] + [None] * k, pa.int64()),
            "ids": pa.array([row["ids"]] + [None] * k, blocks.schema.field("ids").type), "train": pa.array([row["train"]] + [None] * k, pa.binary()),
            "a": pa.array([np.stack([b.lengths.astype(float), add(c1[b.which[1]] > 0), add(base[b.which[1]]), add(value)]).tobytes(), *part(planes, joined[0])], pa.binary()),
            "b": pa.array([narrow(ask.ravel()), *part(planes, joined[1])], pa.binary()),
            "c": pa.array([None, *part(narrow, joined[2].astype(np.uint64))], pa.binary()),
            "keys": pa.array([None, *part(sorted_planes, every)], pa.binary()), "asked": pa.array([None, *part(bits, flags)], pa.binary()),
        })

    return run, f"kind byte, block long, bucket int, asks long, ids array<{kind}>, train binary, a binary, b binary, c binary, keys binary, asked binary"


def _weights(table: pa.Table) -> pa.Table:
    """One bucket of contexts: both sums of each context that a block asked for."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    keys = [unsorted_planes(r["keys"]) for r in rows]
    which = different(np.concatenate(keys))[2]
    total = [np.bincount(which, np.concatenate([unplanes(r[x], np.float64) for r in rows])) for x in "ab"]
    total[1] = np.bincount(which, np.concatenate([wide(r["c"], len(k)) for r, k in zip(rows, keys)])) - total[1]
    at = np.append(0, np.cumsum([len(k) for k in keys]))
    asked = [which[x:y][unbits(r["asked"], y - x)] for r, x, y in zip(rows, at, at[1:])]
    return pa.table({
        "block": pa.array([r["block"] for r in rows]), "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
        "a": pa.array([planes(total[0][x]) for x in asked], pa.binary()), "b": pa.array([planes(total[1][x]) for x in asked], pa.binary()),
    })


def _final(model: Model, kind: str):
    def run(parts: pa.Table, replies: pa.Table) -> pa.Table:
        row, said = parts.to_pylist()[0], sorted(replies.to_pylist(), key=lambda r: r["bucket"])
        sums = np.frombuffer(row["a"]).reshape(4, -1)
        a, b = (np.concatenate([np.zeros(0), *(unplanes(r[x], np.float64) for r in said)]) for x in "ab")
        doc, at, times, here, below = wide(row["b"], row["asks"] * 5).astype(np.int64).reshape(5, -1)
        left = lambda x, n: np.maximum(1 - x[at] / np.maximum(n, 1), 1e-300)
        alpha = np.log10(left(a, here) / left(b, below))
        n = sums.shape[1]
        score = sums[3] + np.bincount(doc, alpha * times, n)
        ids = parts.column("ids").combine_chunks()
        return pa.table({
            "doc_id": ids.flatten(), "held_out": pa.array(np.frombuffer(row["train"], np.uint8) == 0), "n_tokens": pa.array(sums[0].astype(np.int64)), "n_known": pa.array(sums[1].astype(np.int64)),
            "train_tokens": pa.array(np.full(n, model.n)), "base_score": pa.array(sums[2]), "score": pa.array(score),
        })

    return run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """docs (doc_id, text, train): learn n-grams up to `order` from those where train is true and score all."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    whole = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count_if("train").alias("starts")).first()
    growth = max(1.0, (whole["bytes"] or 0) / SMALL_CORPUS) ** 0.5
    in_slice = F.pmod(F.xxhash64("block"), F.lit(SLICES)).cast("int")
    blocks = pack(docs, int(min(BLOCK_BYTES * growth, MOST_BLOCK_BYTES))).withColumn("slice", in_slice)
    blocks = saved(blocks, "blocks", by=["slice"])
    size = blocks.agg(F.sum("n"), F.count("*")).first()
    buckets = max(1, -(-(size[0] or 0) // int(min(BUCKET_TOKENS * growth, MOST_BUCKET_TOKENS))))
    replies, stats = None, []
    for n in range(1, order + 1):
        counted, slices = None, COUNT_SLICES if n > 2 else 1
        for lo, hi in _ranges(buckets, slices):
            asked = _requests(blocks, n, order, buckets, lo, hi).repartitionById(hi - lo, F.col("bucket"))
            part = asked.groupBy("bucket").applyInArrow(_count, "kind byte, bucket int, block long, keys binary, counts binary, n long, own binary, wanted binary")
            part = saved(part.withColumn("bucket", F.col("bucket") + lo), f"grams-{n}", by=["kind"])
            counted = part if counted is None else counted.unionByName(part)
            release_shuffles(spark)
        stats.append(_statistics(counted.filter("kind = 0")))
        mine = counted.filter("kind = 1").select("block", F.lit(n).alias("part"), "bucket", "counts", "n", "own", "wanted")
        replies = mine if replies is None else replies.unionByName(mine)
    model = Model(stats, whole["starts"])
    # The exchanges that are left go in SLICES, so that shuffle files of one slice only are there at a time.
    run, ddl = _partial(model, buckets, kind)
    tasks = max(1, -(-size[1] // SLICES))
    sums = None
    for k in range(SLICES):
        dealt = lambda df: df.filter(F.col("slice") == k).repartition(tasks, "block").groupBy("block")  # noqa: B023, E731
        part = saved(dealt(blocks).cogroup(dealt(replies.withColumn("slice", in_slice))).applyInArrow(run, ddl), "sums", by=["kind"])
        dropped(blocks, f"slice={k}")
        sums = part if sums is None else sums.unionByName(part)
        release_shuffles(spark)
    dropped(replies, "kind=1")
    weights = None
    for lo, hi in _ranges(buckets, SLICES):
        mine = sums.filter((F.col("kind") == 1) & (F.col("bucket") >= lo) & (F.col("bucket") < hi)).select("block", (F.col("bucket") - lo).alias("bucket"), "keys", "a", "b", "c", "asked")
        part = mine.repartitionById(hi - lo, F.col("bucket")).groupBy("bucket").applyInArrow(_weights, "block long, bucket int, a binary, b binary")
        part = saved(part.withColumn("bucket", F.col("bucket") + lo), "weights")
        weights = part if weights is None else weights.unionByName(part)
        release_shuffles(spark)
    dropped(sums, "kind=1")
    run, ddl = _final(model, kind)
    parts = sums.filter("kind = 0").select("block", "asks", "ids", "train", "a", "b")
    return parts.groupBy("block").cogroup(weights.groupBy("block")).applyInArrow(run, ddl)


def op4_katz(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    return score(docs.select("doc_id", "text", (fold != 1).alias("train")))

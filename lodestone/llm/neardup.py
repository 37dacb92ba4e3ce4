"""MinHash near-duplicate classes, with arrivals as in ProbMinHash and unit weights.

Texts with the same words are one node at once. Each of a node's different five-word shingles, however often it is
repeated, is a Poisson process of rate one, whose arrivals, drawn from the shingle's hash, fall in random registers. A
register keeps its earliest arrival, and the probability that two nodes agree in a register is the Jaccard similarity of
their shingle sets, by which links are accepted too. Arrivals are drawn in order for all shingles at once, and a shingle stops when its next
arrival is later than every register's: nothing after it could count.

Bands of registers give candidates. Nodes that share a band form a family (a star around the least node of each band,
then connected components). Families are then resolved by the exact Jaccard similarity of shingle sets: each node
against the family's hub, the node whose bands are fullest; what doesn't match the hub against those it can match. One
minus the Jaccard similarity is a metric, so that only nodes whose distances to the hub differ by no more than a link's
can be linked: nodes are put in rings of that width around the hub, and blocks of a ring meet blocks of the same and
of the next ring, where registers rule out pairs before sets are compared. Every link between texts of a family is found
or is inside a class that is joined already, no pair is written that isn't a link, and no task holds more than two
blocks whatever the group's size. Rows of hot bands, families and classes are dealt apart.

Defined cases: a text without words (null, empty or blank) is alone in its class; shorter than five words, its one
shingle is the whole text; rows with equal texts share a class; a class is named by its least doc_id, or null if all
are null; repeated rows are reported each; an empty table gives an empty result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.components import components
from lodestone.llm.scratch import lookup, release_shuffles, saved
from lodestone.llm.words import Tokens, chunks, column_bytes, mix64, ngrams, sequence_hashes, tokenise

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 26, 5
BLOCK = 128
#: Members of a family that are compared with the hub in one task.
HUB_ROWS = 1024
#: So many numbers of rows that go are sent to every executor; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
_U = np.uint64
_ONE = _U(1)


def shingle_sets(tokens: Tokens, width: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count) of the distinct shingles of each document, ordered by document and shingle."""
    h, at = ngrams(tokens, width)
    doc = np.searchsorted(tokens.bounds, at, side="right") - 1
    count = np.diff(tokens.bounds)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        whole = sequence_hashes(tokens)[short]
        h, doc = np.concatenate([h, whole]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], h[first], np.diff(np.append(first, len(h)))


def prob_min_hash(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """docs x registers: the shingle whose arrival is the earliest in each register (0 where a document has none)."""
    first = np.full(docs * registers, np.inf)
    owner = np.zeros(docs * registers, np.uint64)
    time = np.zeros(len(shingle))
    state = mix64(shingle ^ _U(0xA5A5F00D12345678))
    live = np.arange(len(shingle))
    while len(live):
        state = mix64(state + _U(0x9E3779B97F4A7C15))
        uniform = ((state >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / weight[live]
        # Multiply-shift on other bits of the state than the time's leading ones.
        register = ((mix64(state ^ _U(0x5851F42D4C957F2D)) >> _U(32)) * _U(registers) >> _U(32)).astype(np.int64)
        slot = doc[live] * registers + register
        np.minimum.at(first, slot, time)
        won = time == first[slot]
        owner[slot[won]] = shingle[live[won]]
        latest = first.reshape(docs, registers).max(1)
        going = time < latest[doc[live]]
        live, time, state = live[going], time[going], state[going]
    return owner.reshape(docs, registers)


def signatures(docs: DataFrame, text: Column, bands: int, rows: int, width: int) -> DataFrame:
    """docs with uid, node (two longs as hex; null without words), the number of shingles, the bands'
    hashes and the registers, four bytes each."""
    registers, keep = bands * rows, docs.columns

    def run(batches):
        n = 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            data, offsets = column_bytes(batch.column(0))
            for lo, hi in chunks(offsets):
                t = tokenise(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                doc, shingle, _ = shingle_sets(t, width)
                owner = prob_min_hash(doc, shingle, np.ones(len(shingle)), hi - lo, registers)
                band = np.zeros((hi - lo, bands), np.uint64)
                for r in range(rows):
                    band = mix64(band ^ owner[:, r::rows]) + _U(r)
                band = mix64(band + np.arange(bands, dtype=np.uint64) * _U(0xD1B54A32D192ED03))
                has = np.diff(t.bounds) > 0
                a, b = sequence_hashes(t, 1), sequence_hashes(t, 2)
                node = [f"{x:016x}{y:016x}" if h else None for x, y, h in zip(a.tolist(), b.tolist(), has.tolist())]
                small = (owner >> _U(32)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k)[lo:hi] for k in range(1, batch.num_columns)],
                        pa.array(np.arange(n, n + hi - lo) + (part << 40)), pa.array(node, pa.string()), pa.array(np.bincount(doc, minlength=hi - lo)),
                        pa.array([x.view(np.int64) if h else [] for x, h in zip(band, has)], pa.list_(pa.int64())), pa.array([x.tobytes() if h else None for x, h in zip(small, has)], pa.binary()),
                    ],
                    [*keep, "__uid", "__node", "__n", "__bands", "__registers"],
                )
                n += hi - lo

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.select(text.alias("__text"), *keep).mapInArrow(run, f"{ddl}, __uid long, __node string, __n long, __bands array<long>, __registers binary")


def _similarities(texts: list[str], width: int):
    """A function that gives the Jaccard similarity of two of the texts."""
    data, offsets = column_bytes(pa.array(texts, pa.string()))
    t = tokenise(data, offsets)
    doc, shingle, _ = shingle_sets(t, width)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    sets = [shingle[bounds[i] : bounds[i + 1]] for i in range(len(texts))]

    def similarity(i: int, j: int) -> float:
        a, b = sets[i], sets[j]
        if not len(a) or not len(b):
            return 0.0
        if len(a) > len(b):
            a, b = b, a
        both = np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a)
        return both / (len(a) + len(b) - both)

    return similarity


def _families(nodes: DataFrame) -> DataFrame:
    """(node, family, hub) of the nodes that share a band with another one."""
    bands = nodes.select("node", F.explode("bands").alias("band"))
    least = saved(bands.groupBy("band").agg(F.min("node").alias("least"), F.count("*").alias("fill")).filter("fill > 1"), "least")
    shared = saved(lookup(bands, least, "band", "fill").select("node", "least", "fill"), "bands")
    family = components(shared.select(F.col("node").alias("a"), F.col("least").alias("b")), "families")
    weight = shared.groupBy("node").agg(F.sum("fill").alias("fullness"))
    family = saved(family.join(weight, "node"), "family")
    hub = saved(family.groupBy("component").agg(F.max_by("node", F.struct("fullness", "node")).alias("hub"), F.count("*").alias("size")), "hubs")
    return lookup(family, hub, "component", "size").select("node", F.col("component").alias("family"), "hub", "size")


def resolve(docs: DataFrame, text: Column, similarity: float = SIMILARITY, width: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """The saved rows of docs with __uid and __node, and (__node, __class, fill) of all nodes, fill being the number of
    their rows. text gives a row's text from the columns of docs."""
    table = saved(signatures(docs, text, bands, rows, width), "signatures")
    nodes = saved(table.filter("__node IS NOT NULL").groupBy(F.col("__node").alias("node")).agg(F.first("__bands").alias("bands"), F.min("__uid").alias("__uid"), F.count("*").alias("fill")), "nodes")
    family = _families(nodes).join(nodes.select("node", "__uid"), "node")
    member = family.join(table.select("__uid", text.alias("text"), F.col("__registers").alias("registers")), "__uid").drop("__uid")
    member = saved(member, "members")
    links = saved(_hub_links(member, similarity, width), "hub-links")
    more = _stray_links(member, links, similarity, width, bands * rows)
    edges = links.filter("linked").select(F.col("node").alias("a"), F.col("hub").alias("b")).unionByName(more)
    named = nodes.select("node", "fill").join(components(edges, "classes"), "node", "left")
    return table, saved(named.select(F.col("node").alias("__node"), F.coalesce("component", "node").alias("__class"), "fill"), "named")


def _classed(table: DataFrame, classes: DataFrame, *columns) -> DataFrame:
    """__uid, __class and columns of the table's rows: equal classes are near-duplicates, saved without texts."""
    rows = table.select("__uid", "__node", *columns)
    alone = rows.filter("__node IS NULL").withColumn("__class", F.concat(F.lit("row "), F.col("__uid").cast("string")))
    return saved(lookup(rows.filter("__node IS NOT NULL"), classes, "__node", "fill").drop("fill").unionByName(alone), "found")


def _hub_links(member: DataFrame, similarity: float, width: int) -> DataFrame:
    """(family, node, hub, near): each node's similarity with its family's hub. A hub's text goes to one task for each
    HUB_ROWS of its family."""

    def run(batches):
        for batch in batches:
            family, node, hub, size, text, other = (batch.column(k) for k in range(6))
            values = []
            for lo in range(0, batch.num_rows, 256):
                a, b = text[lo : lo + 256].to_pylist(), other[lo : lo + 256].to_pylist()
                at: dict[str, int] = {}
                places = [at.setdefault(x, len(at)) for x in [*a, *b]]
                sim = _similarities(list(at), width)
                values += [sim(places[k], places[k + len(a)]) for k in range(len(a))]
            near = np.array(values, np.float64)
            yield pa.RecordBatch.from_arrays([family, node, hub, size, pa.array(near), pa.array(near >= similarity)], ["family", "node", "hub", "size", "near", "linked"])

    parts = F.ceil(F.col("size") / HUB_ROWS).cast("int")
    hubs = member.filter("node = hub").select(F.col("node").alias("of"), F.col("text").alias("other"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("at"))
    mine = member.filter("node <> hub").withColumn("part", F.pmod(F.xxhash64("node"), parts))
    pairs = mine.join(hubs, (F.col("hub") == F.col("of")) & (F.col("part") == F.col("at"))).select("family", "node", "hub", "size", "text", "other")
    return pairs.mapInArrow(run, "family string, node string, hub string, size long, near double, linked boolean")


def _stray_links(member: DataFrame, links: DataFrame, similarity: float, width: int, registers: int) -> DataFrame:
    """Links (a, b) of nodes that aren't the hub's near-duplicates. A block of a ring, other than the first, meets the
    blocks of its own ring and of the one before it."""
    ring = F.greatest(F.lit(1), F.ceil((1 - F.col("near")) / (1 - similarity) - 1e-9)).cast("int")
    placed = links.filter("size > 2").select("family", "node", F.when(F.col("linked"), 1).otherwise(F.greatest(ring, F.lit(2))).alias("ring"))
    count = placed.groupBy("family", "ring").agg(F.count("*").alias("n")).groupBy("family").agg(F.map_from_entries(F.collect_list(F.struct("ring", "n"))).alias("rings"))
    count = saved(count.filter("size(rings) > 1 OR NOT map_contains_key(rings, 1)").withColumn("fill", F.aggregate(F.map_values("rings"), F.lit(0).cast("long"), lambda s, x: s + x)), "rings")
    blocks = lambda r: F.ceil(F.coalesce(F.try_element_at("rings", r), F.lit(0)) / BLOCK).cast("int")
    rows = lookup(saved(placed, "placed"), count, "family", "fill").withColumn("own", F.pmod(F.xxhash64("node"), blocks(F.col("ring"))).cast("int"))
    # A task: ring, block, other ring (the same or the one before), other block.
    task = lambda ring, x, other, y: F.struct(ring.alias("ring"), x.alias("x"), other.alias("other"), y.alias("y"))
    each = lambda n, f: F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), f)).otherwise(F.array().cast(kind))
    kind = "array<struct<ring:int,x:int,other:int,y:int>>"
    r, own = F.col("ring"), F.col("own")
    tasks = F.concat(
        F.when(r > 1, each(blocks(r), lambda k: task(r, F.greatest(k, own), r, F.least(k, own)))).otherwise(F.array().cast(kind)),
        F.when(r > 1, each(blocks(r - 1), lambda k: task(r, own, r - 1, k))).otherwise(F.array().cast(kind)),
        each(blocks(r + 1), lambda k: task(r + 1, k, r, own)),
    )
    dealt = rows.select("node", F.col("ring").alias("mine"), "own", F.explode(tasks).alias("task"), "family").select("family", "node", "mine", "own", "task.*")
    dealt = dealt.join(member.select("node", "text", F.col("registers")), "node")
    low = similarity - 6 * np.sqrt(similarity * (1 - similarity) / registers)

    def run(table: pa.Table) -> pa.Table:
        node, mine, own = table.column("node").to_pylist(), table.column("mine").to_numpy(), table.column("own").to_numpy()
        ring, x, other, y = (table.column(c)[0].as_py() for c in ("ring", "x", "other", "y"))
        left = np.flatnonzero((mine == ring) & (own == x))
        same = ring == other and x == y
        right = left if same else np.flatnonzero((mine == other) & (own == y))
        marks = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint32).reshape(len(node), registers)
        a, b, sim = [], [], None
        for k, p in enumerate(left):
            rest = right[k + 1 :] if same else right
            for q in rest[(marks[rest] == marks[p]).mean(1) >= low] if len(rest) else ():
                sim = sim or _similarities(table.column("text").to_pylist(), width)
                if sim(int(p), int(q)) >= similarity:
                    a.append(node[p])
                    b.append(node[int(q)])
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})

    return dealt.groupBy("family", "ring", "x", "other", "y").applyInArrow(run, "a string, b string")


def classes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id (the class's least doc_id), class_size (rows) and n_texts (different texts) for each row."""
    found = _classed(*resolve(docs.select("doc_id", "text"), F.col("text"), **options), "doc_id")
    # By text first, so that a text of many copies is one row a task, and a class one row a text.
    texts = found.groupBy("__class", "__node").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    total = saved(texts.groupBy("__class").agg(F.min("least").alias("class_id"), F.sum("rows").alias("class_size"), F.count("__node").alias("n_texts")), "totals")
    return lookup(found, total, "__class", "class_size").select("doc_id", "class_id", "class_size", "n_texts")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each class: the one with the least doc_id, the first of repeated ones."""
    table, near = resolve(docs.select(F.struct("*").alias("row")), F.col("row")["text"], **options)
    found = _classed(table, near, F.col("row")["doc_id"].alias("doc_id"))
    first = saved(found.groupBy("__class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("__uid").alias("uid"))).alias("first"), F.count("*").alias("fill")), "first")
    gone = saved(lookup(found, first, "__class", "fill").filter(F.col("__uid") != F.col("first.uid")).select(F.col("__uid").alias("gone")), "gone")
    release_shuffles(docs.sparkSession)
    few = gone.count() <= BROADCAST_ROWS
    return table.select("__uid", "row").join(F.broadcast(gone) if few else gone, F.col("__uid") == F.col("gone"), "left_anti").select("row.*")


def op6_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))

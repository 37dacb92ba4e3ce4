"""Heading-aware chunks of HTML documents, and the best chunk for a piece of evidence."""

from __future__ import annotations

import re
from collections.abc import Iterable
from difflib import SequenceMatcher
from hashlib import sha256
from html import escape
from html.parser import HTMLParser
from itertools import accumulate, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructType

from lodestone.functions import text as X
from lodestone.functions.udfs import HIDDEN, by_slices, strip_html, strip_html_value

MOST, LEAST, CUTOFF = 1600, 120, 0.45
#: Documents that a task holds as Python objects at a time, with their chunks.
PAGES = 64
CHUNK_DDL = "chunk_no int, id string, text string, title string, url string, section_path array<string>, source_indices array<int>, content_hash string"
_HEADINGS = {"h1": 1, "h2": 2, "h3": 3, "h4": 4}
#: Elements that keep their tag as a block, and all that end one.
_OWN = {"h1", "h2", "h3", "h4", "h5", "h6", "li", "p"}
_VOID = {"hr"}
_BLOCK_TAGS = _OWN | _VOID | set("address article aside blockquote body dd div dl dt fieldset figcaption figure footer form header main nav ol pre section table tbody td tfoot th thead tr ul".split())
_BLANK = re.compile("[\\s\x1c-\x1f\x85]+")
_QUOTES = str.maketrans(dict(zip(*X.QUOTES)))


def _plain(value: str) -> str:
    return _BLANK.sub(" ", (value or "").translate(_QUOTES)).strip()


def _key(value: str) -> str:
    return re.sub("[^a-z0-9]+", "", _plain(value).lower())


def _hash(*values: str, length: int = 64) -> str:
    return sha256(X.SEPARATOR.join(values).encode("utf-8", "surrogatepass")).hexdigest()[:length]


def _sections(blocks: list[tuple[int, str, str]]) -> list[tuple[int, tuple[str, ...], int, str]]:
    """(section, heading path, index, text) of the body blocks. A heading opens a section; a block whose key is empty or
    stood before anywhere in the document is left out."""
    paths = list(accumulate(blocks, lambda path, b: (*path[: _HEADINGS[b[1]] - 1], b[2]) if b[1] in _HEADINGS else path, initial=()))[1:]
    section = list(accumulate(b[1] in _HEADINGS for b in blocks))
    body = {}
    for n, path, (i, tag, text) in zip(section, paths, blocks):
        if tag not in _HEADINGS and (key := _key(text)):
            body.setdefault(key, (n, path, i, text))
    return list(body.values())


def _pages(sizes: Iterable[int]) -> list[int]:
    """The page of each block of a section: a new one starts where the blocks so far and the next would exceed MOST."""
    places = accumulate(sizes, lambda at, size: (at[0] + 1, size) if at[1] and at[1] + size > MOST else (at[0], at[1] + size), initial=(0, 0))
    return [page for page, _ in places][1:]


def chunk_document(url: str, title: str, contents: list[str]) -> list[tuple]:
    """One chunk for each page of each section, its text the heading path and the blocks; a last one under LEAST
    characters is added to the one before, which keeps its id."""
    plain = [(i, tag, _plain(text)) for i, (tag, text) in enumerate(map(strip_html_value, contents))]
    rows = []
    for _, blocks in groupby(_sections([b for b in plain if b[2]]), key=itemgetter(0)):
        blocks = list(blocks)
        for _, page in groupby(zip(_pages(len(b[3]) + 1 for b in blocks), blocks), key=itemgetter(0)):
            part = [b for _, b in page]
            heading = " > ".join(part[0][1])
            text = _plain("\n".join([heading, *(b[3] for b in part)]))
            rows.append(("policy_" + _hash(url, heading, text, length=16), text, list(part[0][1]), [b[2] for b in part]))
    if len(rows) > 1 and len(rows[-1][1]) < LEAST:
        (id_, text, path, at), (_, more, _, rest) = rows[-2:]
        rows[-2:] = [(id_, _plain(f"{text}\n{more}"), path, at + rest)]
    return [(n, id_, text, _plain(title), url, path, at, _hash(text)) for n, (id_, text, path, at) in enumerate(rows)]


class _Blocks(HTMLParser):
    """Text of a page by block elements: headings and list items under their own tag, all else, also text that stands
    outside or after them, as paragraphs."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.open, self.text, self.hidden = [], [], [], 0

    def cut(self):
        text = "".join(self.text).strip()
        tag = next((t for t in reversed(self.open) if t in _OWN), "p")
        if text:
            self.out.append(f"<{tag}>{escape(text)}</{tag}>")
        self.text = []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in HIDDEN
        if tag in _BLOCK_TAGS:
            self.cut()
            if tag not in _VOID:
                self.open = [t for t in self.open if t not in _OWN or tag not in _OWN] + [tag]
        elif tag == "br":
            self.text.append(" ")

    def handle_endtag(self, tag):
        self.hidden -= tag in HIDDEN and self.hidden > 0
        if tag in _BLOCK_TAGS:
            self.cut()
            if tag in self.open:
                del self.open[len(self.open) - 1 - self.open[::-1].index(tag) :]

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)


def page_blocks(html: str | None) -> list[str]:
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.cut()
    return parser.out


def _by_pages(make, ddl: str):
    """Function of Arrow batches that makes the rows of each document, PAGES documents at a time."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                part = zip(*(c.to_pylist() for c in batch.slice(at, PAGES).columns))
                rows = [dict(zip(schema.names, r)) for d in part for r in make(*d)]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def chunk(documents: DataFrame) -> DataFrame:
    """documents (url, title, contents array<string>), one output row for each chunk."""
    make = lambda url, title, contents: chunk_document(url or "", title or "", contents or [])
    return documents.select("url", "title", "contents").mapInArrow(_by_pages(make, CHUNK_DDL), CHUNK_DDL)


def chunk_pages(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html), split in blocks first; the title is the first h1."""

    def make(page_id, url, html):
        blocks = page_blocks(html)
        title = next((strip_html_value(b)[1] for b in blocks if b.startswith("<h1")), "")
        return [(page_id, *r) for r in chunk_document(url or "", title, blocks)]

    ddl = "page_id long, " + CHUNK_DDL
    return pages.select("page_id", "url", "html").mapInArrow(_by_pages(make, ddl), ddl)


def evidence_scores(pairs: DataFrame) -> DataFrame:
    """pairs (evidence_id, evidence_key, chunk_key, ...) with score. Containment is decided in the JVM; difflib compares
    only evidence that no chunk holds or is held by, as its ratio is never above a containment's score."""
    ratio = by_slices(lambda a, b: SequenceMatcher(None, a, b).ratio(), DoubleType())
    e, c = F.col("evidence_key"), F.col("chunk_key")
    share = 1.0 + F.least(F.length(e), F.length(c)) / F.greatest(F.length(e), F.lit(1))
    held = pairs.withColumn("score", F.when(F.contains(e, c) | F.contains(c, e), share))
    held = held.withColumn("any", F.max("score").over(W.partitionBy("evidence_id")))
    good = held.filter("score IS NOT NULL")
    return good.unionByName(held.filter("any IS NULL").withColumn("score", ratio(e, c))).drop("any")


def map_evidence(evidence: DataFrame, chunks: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """evidence (evidence_id, url, evidence: HTML) to its best chunk of the same url: (evidence_id, id, score), id null
    under the cutoff and for blank evidence; of equal scores the first chunk."""
    keyed = evidence.select("evidence_id", "url", X.normalized_key(strip_html("evidence")["text"]).alias("evidence_key"))
    pairs = keyed.filter("evidence_key <> ''").join(chunks.select("url", "id", "chunk_no", X.normalized_key(F.col("text")).alias("chunk_key")), "url")
    best = evidence_scores(pairs).groupBy("evidence_id").agg(F.max_by(F.struct("id", "score"), F.struct("score", -F.col("chunk_no"))).alias("b"))
    found = evidence.select("evidence_id").join(best, "evidence_id", "left")
    good = F.col("b.score") >= cutoff
    return found.select("evidence_id", F.when(good, F.col("b.id")).alias("id"), F.when(good, F.col("b.score")).alias("score"))

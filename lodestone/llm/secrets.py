"""Secret scans: patterns for assignments, access keys and hexadecimal runs, and a token-efficiency test.

A byte-pair vocabulary packs written language into few tokens; random characters it does not. A run of at least
`shortest` key-like characters whose characters for each token fall below `ratio` is reported, unless it is a known
digest (a hexadecimal run of a digest's length with a digest's name just before it), a UUID, a number, an identifier
(letters and digits joined by separators, each piece of letters one token or token-efficient itself) or already within a
base span. One document is one row; nothing is shuffled; runs are encoded in pieces of bounded length, and base spans
are searched by bisection, so that a very long text takes time in proportion to its length.

Defined cases: a null or empty text has no spans and the digest of ''; positions are code points; repeated rows and
null ids pass through; an empty table gives an empty result."""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SPLIT = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_HEX_ONLY = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
_NAME = re.compile(r"(?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]+)(?:[+/_=-]+(?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]+))*[+/_=-]*\Z")
_PIECES = re.compile(r"[A-Za-z]+")
#: Lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hexadecimal.
DIGESTS = frozenset({32, 40, 56, 64, 96, 128})
#: Names that announce a digest, and how far before it they may end.
_LABEL = re.compile(r"(?:md5|sha-?[0-9]+|digest|checksum|hash|commit|etag|integrity|fingerprint)[^0-9A-Za-z]{0,8}\Z", re.IGNORECASE)
_NEAR = 32
_PIECE = 256


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


class Scanner:
    """ranks: the vocabulary file's bytes."""

    def __init__(self, ranks: bytes, split: str = SPLIT, shortest: int = 16, ratio: float = 2.0):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        self.codec = tiktoken.Encoding("secrets", pat_str=split, mergeable_ranks=table, special_tokens={})
        self.run = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % shortest)
        self.ratio = ratio

    def efficiency(self, run: str) -> float:
        """Characters for each token."""
        return len(run) / sum(len(self.codec.encode_ordinary(run[i : i + _PIECE])) for i in range(0, len(run), _PIECE))

    def excluded(self, run: str, before: str = "") -> bool:
        """before: the text just before the run."""
        core = run.strip("-=_/+")
        if _HEX_ONLY.match(core) and len(core) in DIGESTS and _LABEL.search(before) or _UUID.match(core):
            return True
        return bool(_NAME.match(core)) and all(map(self.written_language, _PIECES.findall(core)))

    def written_language(self, piece: str) -> bool:
        """One token, or as many characters for each token as the ratio asks."""
        return self.efficiency(piece) >= min(self.ratio, len(piece))

    def spans(self, text: str) -> tuple[list, list]:
        """(base spans, spans that the method adds)."""
        base, added = base_spans(text), []
        starts = sorted(s for _, s, _ in base)
        # The furthest end of the spans that start no later than each.
        ends = list(itertools.accumulate((e for _, _, e in sorted(base, key=lambda x: x[1])), max))
        for m in self.run.finditer(text):
            s, e = m.span()
            k = bisect.bisect_left(starts, e)
            if not (k and ends[k - 1] > s) and not self.excluded(m[0], text[max(0, s - _NEAR) : s]) and self.efficiency(m[0]) < self.ratio:
                added.append(("random", s, e))
        return base, added


def find_secrets(docs: DataFrame, vocabulary: str = VOCABULARY, **options) -> DataFrame:
    """For each document: counts and digest of the base spans, all spans, and `masked`, the text without them if asked."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    masked = options.pop("masked", False)
    fields = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"] + ["masked"] * masked

    def run(batches):
        scanner = Scanner(ranks.value, **options)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = []
                for t in batch.column(1)[lo : lo + 512]:
                    text = t.as_py() or ""
                    base, added = scanner.spans(text)
                    n = [sum(k == kind for k, *_ in base) for kind in KINDS[:3]]
                    row = [*n, hashlib.sha256(written(base).encode()).hexdigest(), written(base + added)]
                    rows.append(row + [mask(text, base + added)] * masked)
                kinds = [pa.int64()] * 3 + [pa.string()] * (2 + masked)
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo : lo + 512], *[pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]], ["doc_id", *fields])

    ddl = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string" + ", masked string" * masked
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {ddl}")


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if e > at:
            out += [text[at:s], f"[{kind}]"] if s >= at else []
            at = e
    return "".join(out) + text[at:]


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Secret scans: fixed base patterns, and a token-efficiency test.

A run of key characters that a tiktoken vocabulary can only spell in short
pieces (few characters per token) is random text.  Digests of known lengths,
identifiers and numbers are no secrets and are excluded first.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks

#: Base patterns with the least length of group 2 or of the match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # of runs of [0-9a-f]+, those of 24 and more
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "random")
#: A text without one of these words, whatever their case, has no assignment.
_ASSIGN_WORDS = ("passw", "secret", "token", "api")

#: Candidates of the token test: runs of key characters of this length or more.
LEAST_RANDOM = 16
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_RANDOM},}}")
#: Fewer characters per token than this is random (random base-62 text has
#: about 1.5 to 1.9, invented words more than 2).
MOST_RATIO = 2.0
#: Known digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512 in hex) and
#: identifiers: UUIDs, numbers and dates, words in one case style or in camel
#: case with up to four digits, and all of these joined by separators.  Other
#: mixed-case letters are left to the token test.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(r"(?<![A-Za-z0-9])[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9])")
WORD = re.compile(r"[0-9]+|([a-z]+|[A-Z]+|([a-z]{2,}|[A-Z][a-z]{2,})([A-Z][a-z]{2,})*)[0-9]{0,4}")
PIECE = re.compile(r"[A-Za-z0-9]+")
#: A known piece of this length or more ends a stretch; shorter ones are also
#: met inside base-64 text.
LEAST_WORD = 4

#: Pieces before byte-pair merging, as the vocabulary was made with.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start and then as listed."""
    found = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(*m.span(), 2) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]


def _known_piece(piece: str) -> bool:
    if len(piece) in DIGEST_LENGTHS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", piece):
        return True
    return WORD.fullmatch(piece) is not None


def is_known(run: str) -> bool:
    """Digests of known lengths and identifiers, alone or joined."""
    return all(map(_known_piece, PIECE.findall(UUID.sub("-", run))))


def stretches(run: str) -> Iterator[tuple[int, int]]:
    """What stands between the words, digests and UUIDs of a run, and then each
    of its pieces: (start, end) within the run."""
    bare = UUID.sub(lambda m: "-" * len(m[0]), run)
    pieces = [(*m.span(), _known_piece(m[0])) for m in PIECE.finditer(bare)]
    at, found = 0, False  # from the separator after the last word
    for start, end, known in [*pieces, (len(run) + 1, len(run) + 1 + LEAST_WORD, True)]:
        if known and end - start >= LEAST_WORD:
            if found:
                yield at, start - 1
            at, found = end + 1, False
        else:
            found = True
    yield from ((start, end) for start, end, known in pieces if not known)


def random_spans(text: str, encoder, most_ratio: float = MOST_RATIO) -> list[tuple[int, int, str]]:
    """Runs that the vocabulary spells with few characters per token; of other
    runs, the stretches or else the pieces that it spells so."""
    if not text or max(map(len, text.split()), default=0) < LEAST_RANDOM:
        return []

    def is_random(part: str) -> bool:
        return len(part) >= LEAST_RANDOM and not is_known(part) and len(part) < most_ratio * len(encoder.encode_ordinary(part))

    found = []
    for m in RUN.finditer(text):
        if is_known(m[0]):
            continue
        if is_random(m[0]):
            found.append(m.span())
            continue
        inside: list[tuple[int, int]] = []
        for start, end in dict.fromkeys(stretches(m[0])):
            if end - start < len(m[0]) and not any(s <= start and end <= e for s, e in inside) and is_random(m[0][start:end]):
                inside.append((start, end))
        found += sorted((m.start() + s, m.start() + e) for s, e in inside)
    return [(s, e, KINDS[3]) for s, e in found]


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan(docs: DataFrame, vocabulary: str = VOCABULARY, most_ratio: float = MOST_RATIO) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans: one row
    per document.

    Spans are kind:start:end in code points, end exclusive, of the whole match,
    sorted by start and then by kind as listed.  Null and empty texts have no
    spans (the digest is that of the empty string).  Repeated rows are scanned
    each; other columns aren't read.  The vocabulary (a few MB, its size does
    not depend on the data) is read on the driver and broadcast.
    """
    known = docs.sparkSession.sparkContext.broadcast(ranks(vocabulary))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoder = tiktoken.Encoding("secrets", pat_str=PIECES, mergeable_ranks=known.value, special_tokens={})
        order = {k: i for i, k in enumerate(KINDS)}
        for b in chunks(batches):
            out: list[list] = [[] for _ in range(6)]
            for text in b["text"].to_pylist():
                base = base_spans(text or "")
                both = sorted(base + random_spans(text or "", encoder, most_ratio), key=lambda x: (x[0], order[x[2]]))
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                n = [sum(k == kind for _, _, k in both) for kind in KINDS]
                for column, value in zip(out, [*n, digest, listed(both)], strict=True):
                    column.append(value)
            longs = [pa.array(x, pa.int64()) for x in out[:4]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], *longs, *(pa.array(x, pa.string()) for x in out[4:])],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        rows, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_sha256 string, spans string")

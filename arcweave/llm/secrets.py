"""Secret scans: fixed patterns and a token-efficiency test.

The patterns find assignments to names of secrets, access keys and runs of
hexadecimal digits. The token-efficiency test looks at the remaining long
unbroken strings: words of a language take few tokens of a byte-pair vocabulary
for their length, random strings many. Tested are strings of ``LEAST_LENGTH``
characters and more that hold a digit and a letter, or a run of as many letters
that is no word in lower case, upper case or with a capital; those shorter than
``LONG`` need ``UNBROKEN`` letters and digits in a row, which compounds of short
words and numbers do not have, and are left out where a fixed pattern has found
them whole. Strings of letters in one case are not tested, as
rare words take as many tokens. A string is a find if it has fewer than
``MOST_CHARS_PER_TOKEN`` characters for each token, after known digests and
identifiers (plain numbers, hexadecimal digests of the usual lengths, UUIDs, dates
and versions, addresses and host names, paths of words) are excluded.

Scanning is per row and stays in place: no shuffle, memory for one text.

Defined results: a null text is an empty one and has no finds; overlapping finds
of different kinds are all reported; repeated rows are scanned each.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from arcweave.llm.words import column, slices

VOCABULARY = "byte_bpe_50k.tiktoken"
KINDS = ("assign", "access", "hex", "random")
LEAST_LENGTH = 12
LONG = 20
UNBROKEN = 8
MOST_CHARS_PER_TOKEN = 1.7

NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_LENGTH},}}")
RUN = re.compile(rf"[A-Za-z0-9]{{{UNBROKEN},}}")
LETTERS = re.compile(rf"[A-Za-z]{{{LEAST_LENGTH},}}")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
KNOWN = re.compile(
    r"""(?ix)
    [0-9_/+=-]+                                                   # numbers and rules of signs
    | (?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})   # digests
    | [0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}   # UUIDs
    | (?:[a-z]+[/_=+-]+)*[a-z]+                                   # words and paths of words
    | [a-z]+[0-9]{1,6}                                            # numbered names
    """
)

Span = tuple[int, int, int]  # start, end, index of the kind


def base_spans(text: str) -> list[Span]:
    """Finds of the fixed patterns, by start, then kind."""
    found: list[Span] = []
    folded = text.lower()
    if any(name in folded for name in NAMES):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda span: (span[0], span[2]))


def _tested(string: str) -> bool:
    if any(c.isdigit() for c in string) and any(c.isalpha() for c in string):
        return (len(string) >= LONG or RUN.search(string) is not None) and not KNOWN.fullmatch(string)
    return any(not WORD.fullmatch(run) for run in LETTERS.findall(string))


def random_spans(text: str, encoder: tiktoken.Encoding, base: Sequence[Span] = ()) -> list[Span]:
    """Strings that a byte-pair vocabulary needs many tokens for."""
    found: list[Span] = []
    for m in CANDIDATE.finditer(text):
        string = m[0]
        if not _tested(string):
            continue
        if len(string) < LONG and any(start <= m.start() and m.end() <= end for start, end, _ in base):
            continue
        near = text[max(0, m.start() - 1) : m.start()] + text[m.end() : m.end() + 1]
        if "@" in near:
            continue
        if len(string) < MOST_CHARS_PER_TOKEN * len(encoder.encode_ordinary(string)):
            found.append((m.start(), m.end(), 3))
    return found


def encoder_of(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[Span], mark: str) -> str:
    """The text with every find, overlapping ones together, replaced by ``mark``."""
    parts, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), vocabulary: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``keep`` and scan_n_assign, scan_n_access, scan_n_hex, scan_base_sha256, scan_spans, scan_text.

    ``scan_text`` is the redacted text where there is a find, else null.
    """
    types = dict(docs.dtypes)
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in slices(batches, text):
            rows = []
            for string in column(batch, text).to_pylist():
                string = string or ""
                base = base_spans(string)
                spans = sorted(base + random_spans(string, encoder, base), key=lambda span: (span[0], span[2]))
                counts = [sum(kind == k for _, _, kind in base) for k in range(3)]
                digest = hashlib.sha256(spelled(base).encode()).hexdigest()
                rows.append((*counts, digest, spelled(spans), redacted(string, spans, mark) if spans else None))
            arrays = [column(batch, name) for name in keep]
            kinds = [pa.int64()] * 3 + [pa.string()] * 3
            arrays += [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, *(f"scan_{n}" for n in "n_assign n_access n_hex base_sha256 spans text".split())])

    own = "scan_n_assign long, scan_n_access long, scan_n_hex long, scan_base_sha256 string, scan_spans string, scan_text string"
    fields = "".join(f"`{name}` {types[name]}, " for name in keep)
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(scanned, fields + own)

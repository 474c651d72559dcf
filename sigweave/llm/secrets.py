"""Secret scans: three base patterns, and random strings by token efficiency.

A random string takes many tokens for its characters under a vocabulary that was made from natural text. Runs of at least `shortest`
characters that hold a letter are encoded with a tiktoken vocabulary; a run of at most `ratio` characters a token counts as random. A run
with slashes is judged whole, as base64 has them; if it is not random, its neighbouring parts that are random by themselves are judged together, so
that a key at the end of a path is found. UUIDs and what a base pattern has found are cut out of runs before, and what remains is judged; known
digests (hexadecimal, of a usual digest's length) are left out. Spans are code points, end exclusive; a span of kind assign is the whole match.
"""

from __future__ import annotations

import base64
import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, map_columns, text_of

# The base patterns and their least lengths.
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ANY_CASE = "|".join("".join(f"[{c}{c.upper()}]" for c in k) for k in ("password", "passwd", "secret", "token"))
ASSIGN = re.compile(rf"""({_ANY_CASE}|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run; shorter ones fail the base's length
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
DIGESTS = (32, 40, 48, 56, 64, 96, 128)
KINDS = ("assign", "access", "hex", "random")

_HEX_ONLY = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_UUID = re.compile(r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")
_LETTER = re.compile(r"[A-Za-z]")


def tiktoken_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@dataclass(frozen=True)
class Settings:
    shortest: int = 20
    ratio: float = 2.0
    vocabulary: str | None = None  # path of a .tiktoken file; None: byte_bpe_50k.tiktoken of public_tokenizers


@lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _runs(shortest: int) -> re.Pattern:
    return re.compile(rf"[A-Za-z0-9+/_=-]{{{shortest},}}")


def _is_random(run: str, settings: Settings) -> bool:
    return len(run) <= settings.ratio * len(_encoding(settings.vocabulary or tiktoken_path()).encode_ordinary(run))


def _merged(some: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order that cover the same."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(some):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _remaining(a: int, b: int, out: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What is left of a to b without the disjoint spans in out, which are in order."""
    left = []
    for s, e in out:
        if a < s:
            left.append((a, min(s, b)))
        a = max(a, e)
        if a >= b:
            return left
    return [*left, (a, b)]


def _random_parts(text: str, a: int, b: int, settings: Settings) -> list[tuple[int, int]]:
    """The run from a to b if it is random; else its longest rows of parts between slashes that are random each and together."""
    run = text[a:b]
    if b - a < settings.shortest or not _LETTER.search(run) or len(run) in DIGESTS and _HEX_ONLY.match(run):
        return []
    if _is_random(run, settings):
        return [(a, b)]
    if "/" not in run:
        return []
    rows, at, start = [], a, None
    for part in run.split("/"):
        if part and _is_random(part, settings):
            start = at if start is None else start
            end = at + len(part)
        elif start is not None:
            rows.append((start, end))
            start = None
        at += len(part) + 1
    rows += [(start, end)] if start is not None else []
    return [x for s, e in rows if (s, e) != (a, b) for x in _random_parts(text, s, e, settings)]


def random_spans(text: str, taken: list[tuple[int, int]], settings: Settings) -> list[tuple[int, int]]:
    """Random strings outside the spans in taken; runs and spans are gone through side by side."""
    out, at, taken = [], 0, _merged(taken)
    for m in _runs(settings.shortest).finditer(text):
        a, b = m.span()
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        known, to = [(a + u.start(), a + u.end()) for u in _UUID.finditer(m[0])], at
        while to < len(taken) and taken[to][0] < b:
            known.append(taken[to])
            to += 1
        out += [x for s, e in _remaining(a, b, _merged(known)) for x in _random_parts(text, s, e, settings)]
    return out


def spans(text: str, settings: Settings = Settings()) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start and then by kind in the order of KINDS."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    found += [(a, b, 3) for a, b in random_spans(text, [(s, e) for s, e, _ in found], settings)]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda x: (x[0], x[2]))]


def _joined(some: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in some)


def _scan(texts, settings):
    rows = [spans(t, settings) for t in as_text(texts)]
    base = [[x for x in r if x[2] != "random"] for r in rows]
    count = lambda kind: [sum(x[2] == kind for x in r) for r in base]
    return [count("assign"), count("access"), count("hex"), [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base], [_joined(r) for r in rows]]


def scan(docs: DataFrame, keep: list, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Columns keep, counts of the base kinds, the digest of the base spans and all spans.

    One row for each row of docs, repeated rows included; null text counts as empty and has no span. Spans that begin together stand in the order of KINDS.
    """
    made = {"n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"}
    return map_columns(docs, keep, [text_of(docs, text_col)], made, _scan, settings=settings)


def redact(text: str, settings: Settings = Settings(), mark: str = "<secret>") -> str:
    """The text with every span, overlapping ones as one, replaced by the mark."""
    out, at, end = [], 0, -1
    for a, b, _ in spans(text, settings):
        if a >= end:
            out += [text[at:a], mark]
        end = at = max(end, b)
    return "".join([*out, text[at:]])


def _redacted(texts, settings):
    return [[t if t is None else redact(t, settings) for t in texts.to_pylist()]]


def redacted(docs: DataFrame, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """docs with secrets out of the text (null stays null) and, where there is one, n_chars set to its new length."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    got = map_columns(docs, others, [text_of(docs, text_col)], {text_col: "string"}, _redacted, settings=settings)
    if "n_chars" in docs.columns:
        new = F.when(F.col(text_col).isNull(), F.col("n_chars")).otherwise(F.length(text_col)).cast(docs.schema["n_chars"].dataType)
        got = got.withColumn("n_chars", new)
    return got.select(*(F.col(f"`{c}`") for c in docs.columns))

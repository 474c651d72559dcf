"""Fill-in-middle transformation by big-integer bit-parallelism.

A text's UTF-8 becomes one integer for each class of bytes, with a bit for each byte (first byte lowest): bytes.translate maps every byte to a
binary digit, and int(digits, 2) reads them in linear time. A token ends where a byte that is no white space is followed by white space or by
nothing, and where a text ends in white space; shifted boolean operations mark all ends of a text at once, bit_count gives their number n. The two cuts
are ranked ends: recursive halving counts the bits of the lower half and goes on in the halves that hold a wanted rank, which reads each half once
and takes linear time in all. Code points of a part are the bits of the mask of first bytes within it.

Nothing is shuffled: each text is transformed where it is read, and a text is put together again by SQL functions alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_columns, text_of

_SPACES = frozenset(b"\x20\x09\x0a\x0b\x0c\x0d")
WORD_DIGITS = bytes(b"10"[c in _SPACES] for c in range(256))
FIRST_DIGITS = bytes(b"10"[c & 0xC0 == 0x80] for c in range(256))


@dataclass(frozen=True)
class Settings:
    percent: int = 50  # of texts that are transformed
    spm_percent: int = 80  # of these, with the suffix first
    seed: int = 42
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.marks
        if len(set(marks)) < 3 or not all(marks) or any(m[0] in other[1:] for m in marks for other in marks) or any(a != b and a.startswith(b) for a in marks for b in marks):
            raise ValueError("marks must differ, and none may begin inside another")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def class_mask(data: bytes, digits: bytes) -> int:
    """Bit i says whether byte i belongs to the class."""
    return int(data[::-1].translate(digits), 2) if data else 0


def token_ends(data: bytes) -> int:
    """Bit i says whether a token ends with byte i."""
    words = class_mask(data, WORD_DIGITS)
    last = 1 << len(data) >> 1
    return words & ~(words >> 1) | last & ~words


def select(mask: int, width: int, ranks: list[int], at: int = 0) -> list[int]:
    """Places of the set bits of the given ranks (from 1, ascending) in a mask of so many bits."""
    if not ranks:
        return []
    if width == 1:
        return [at] * len(ranks)
    half = width // 2
    low = mask & ((1 << half) - 1)
    n = low.bit_count()
    below = [r for r in ranks if r <= n]
    above = [r - n for r in ranks if r > n]
    return select(low, half, below, at) + (select(mask >> half, width - half, above, at + half) if above else [])


def cuts(data: bytes, ends: int, a: int, b: int) -> tuple[int, int]:
    """The bytes before the ends of the first a and the first b tokens, a <= b."""
    found = select(ends, len(data), [r for r in (a, b) if r])
    p, m = [0] * (2 - len(found)) + [x + 1 for x in found]
    return p, m


def transform(data: bytes, h: tuple[int, int, int, int], s: Settings = Settings()) -> tuple[int, str, int | None, int | None, bytes]:
    """n, form (plain, psm, spm), code points of prefix and middle (None if plain) and the output."""
    ends = token_ends(data)
    n = ends.bit_count()
    marks = [m.encode() for m in s.marks]
    if not data or h[2] % 100 >= s.percent or any(m in data for m in marks):
        return n, "plain", None, None, data
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m = cuts(data, ends, a, b)
    first = class_mask(data, FIRST_DIGITS)
    before = (first & ((1 << p) - 1)).bit_count()
    middle = (first & ((1 << m) - 1)).bit_count() - before
    prefix, suffix, mid = marks[0] + data[:p], marks[1] + data[m:], marks[2] + data[p:m]
    if h[3] % 100 < s.spm_percent:
        return n, "spm", before, middle, suffix + prefix + mid
    return n, "psm", before, middle, prefix + suffix + mid


def _batch(texts, digests, s):
    rows = [transform(t, tuple(int(d[i : i + 8], 16) for i in range(0, 32, 8)), s) for t, d in zip(as_bytes(texts), digests.to_pylist(), strict=True)]
    n, form, before, middle, out = zip(*rows, strict=True)
    return [list(n), list(form), list(before), list(middle), pa.array(out, pa.binary()).view(pa.string())]


def fill_in_middle(docs: DataFrame, keep: list, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Columns keep, n, form, prefix_chars, middle_chars and output, the text in its new order between marks.

    One row for each row of docs, repeated rows included; what happens to a text follows from its id alone, and equal rows get equal outputs. Null text
    counts as empty, a null id as an empty string. Empty texts and texts that hold a mark stay plain. A text of any length takes a few
    times its own size in memory. An empty table gives no rows; other columns of docs matter only if kept.
    """
    digest = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    made = {"n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "string"}
    return map_columns(docs, keep, [text_of(docs, text_col), digest], made, _batch, s=settings)


def restored(output: Column, form: Column, settings: Settings = Settings()) -> Column:
    """The text that was transformed, from output and form. Marks part an output in one way only, as transformed texts hold none."""

    def after(mark: str) -> Column:
        part = F.split_part(output, F.lit(mark), F.lit(2))
        for other in settings.marks:
            part = F.split_part(part, F.lit(other), F.lit(1)) if other != mark else part
        return part

    return F.when(form == "plain", output).otherwise(F.concat(after(settings.prefix), after(settings.middle), after(settings.suffix)))

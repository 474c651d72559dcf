"""Grouping of spelling variants by two-dimensional range reporting in wavelet trees.

Words are near if one inserted, deleted or replaced character makes one of the other. Words of one length, sorted forwards and sorted by
their reversals, are points in a square. For an edit position i the words with the prefix before i are an interval of the forward order, those
with the suffix behind it one of the reverse order; the points in both are the near words for this position, and a wavelet tree over the reverse places
in forward order reports them. Replacements are looked up among words of the same length, insertions among those one longer, which gives deletions, too.
A pair is reported at one position alone: the first at which the words differ.

Spark deals the work out: an edit in the second half of a word leaves its first half alone, one in the first half the second. So words
meet by length, side and half; halves are hashed into blocks of bounded size, and a block has one tree for each length and side. Halves that very
many words share are cut into chunks of words to be found and chunks of words that ask, each pair of chunks being a block of its own.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, materialize, remove, text_of

#: Maximal runs of letters, once A-Z is in lower case.
RUN = "[a-z\u00c0-\u00ff]"


@dataclass(frozen=True)
class Settings:
    shortest: int = 6  # code points of a word
    least: int = 5  # occurrences of a word
    ratio: int = 5  # a form occurs at least so many times as often
    typo: int = 199  # one run of a document in so many loses a code point; 0: none
    block: int = 1 << 13  # rows of a block, about
    chunk: int = 1 << 15  # words of a half that are found, or ask, together
    held: int = 1 << 18  # distinct words that a task counts before it passes them on

    def __post_init__(self):
        if self.ratio < 2:
            raise ValueError("forms must be more frequent, or they could go in circles")


class WaveletTree:
    """A permutation by its bits, level by level, each level with its zeros before its ones; bits are kept as running counts of zeros."""

    def __init__(self, values: np.ndarray):
        self.levels = max(1, (len(values) - 1).bit_length())
        self.zeros = []
        for level in reversed(range(self.levels)):
            one = (values >> level & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]))
            values = np.concatenate([values[~one], values[one]])

    def report(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rectangle, value) of all places from a to b whose value lies from c to d, ends excluded."""
        of = np.flatnonzero((a < b) & (c < d))
        lo, hi, first = a[of], b[of], np.zeros(len(of), np.int64)
        for level, zeros in zip(reversed(range(self.levels)), self.zeros, strict=True):
            half = 1 << level
            lo0, hi0 = zeros[lo], zeros[hi]
            lo1, hi1 = zeros[-1] + lo - lo0, zeros[-1] + hi - hi0
            left = (lo0 < hi0) & (first < d[of]) & (first + half > c[of])
            right = (lo1 < hi1) & (first + half < d[of]) & (first + 2 * half > c[of])
            lo, hi = np.concatenate([lo0[left], lo1[right]]), np.concatenate([hi0[left], hi1[right]])
            of, first = np.concatenate([of[left], of[right]]), np.concatenate([first[left], first[right] + half])
        return of, first


def _codes(words: list[str], length: int) -> np.ndarray:
    if not length:
        return np.zeros((len(words), 0), np.uint32)
    return np.array(words, f"U{length}").view(np.uint32).reshape(len(words), length)


def _keys(codes: np.ndarray, n: int) -> np.ndarray:
    return np.ascontiguousarray(codes[:, :n]).view(f"U{n}")[:, 0]


def _interval(order: np.ndarray, asks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the first n characters of each of asks stand in the sorted order."""
    if not n:
        return np.zeros(len(asks), np.int64), np.full(len(asks), len(order))
    order, keys = _keys(order, n), _keys(asks, n)
    return np.searchsorted(order, keys, "left"), np.searchsorted(order, keys, "right")


def _first_difference(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    differ = x != y
    if not x.shape[1]:
        return np.zeros(len(differ), np.int64)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])


def near_pairs(held: list[str], asks: list[str], positions: range) -> tuple[np.ndarray, np.ndarray]:
    """Places (in asks, in held) of the near words among distinct words `held` of one length for words `asks` of that length or one shorter.

    Only edits at the given positions count, and each pair is reported at the first position where its words differ.
    """
    none = np.zeros(0, np.int64)
    if not held or not asks or not positions:
        return none, none
    m, length = len(held[0]), len(asks[0])
    order = np.array(sorted(range(len(held)), key=held.__getitem__))
    codes, queries = _codes(held, m)[order], _codes(asks, length)
    back = np.argsort(_keys(codes[:, ::-1], m), kind="stable")  # forward places in reverse order
    place = np.empty(len(back), np.int64)
    place[back] = np.arange(len(back))
    tree, reverse, reversed_queries = WaveletTree(place), codes[back][:, ::-1], queries[:, ::-1]
    # Words can differ first only where the order branches, or a word that asks leaves it.
    branch = set(_first_difference(codes[1:], codes[:-1]).tolist())
    at = np.searchsorted(_keys(codes, m), _keys(queries, length)) if length else np.zeros(len(asks), np.int64)
    for beside in (np.clip(at - 1, 0, len(codes) - 1), np.clip(at, 0, len(codes) - 1)):
        branch.update(_first_difference(codes[beside][:, :length], queries).tolist())
    out_q, out_v = [none], [none]
    for i in sorted(branch.intersection(positions)):
        a, b = _interval(codes, queries, i)
        c, d = _interval(reverse, reversed_queries, m - 1 - i)
        for start in range(0, len(asks), 1 << 16):
            some = slice(start, start + (1 << 16))
            of, value = tree.report(a[some], b[some], c[some], d[some])
            of, found = of + start, back[value]
            if i < length:
                fits = codes[found, i] != queries[of, i]
                of, found = of[fits], found[fits]
            out_q.append(of)
            out_v.append(order[found])
    return np.concatenate(out_q), np.concatenate(out_v)


def _counted(s: Settings):
    """(word, n) of the runs in batches of (id, text)."""
    runs_of = re.compile(f"{RUN}{{{s.shortest},}}").findall
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def rows(total: dict[str, int]) -> pa.RecordBatch:
        kept = {w: n for w, n in total.items() if len(w) >= s.shortest}
        return pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array(kept.values(), pa.int64())], schema=schema)

    def run(batches):
        total: dict[str, int] = {}
        for batch in batches:
            for id_, text in zip(as_bytes(batch.column(0)), as_bytes(batch.column(1)), strict=True):
                crc = zlib.crc32(id_ + b":")
                for w, n in Counter(runs_of(text.lower().decode("utf-8", "replace"))).items():  # of bytes, lower() changes A-Z alone
                    if s.typo and (h := zlib.crc32(w.encode(), crc)) % s.typo == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1 :]
                    total[w] = total.get(w, 0) + n
                if len(total) >= s.held:
                    yield rows(total)
                    total = {}
        yield rows(total)

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(word, n): all words of docs that occur `least` times or more.

    Null text has no words, a null id counts as an empty string; repeated rows count as often as they are there. A table without rows gives none.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), text_of(docs, text_col).alias("text"))
    return rows.mapInArrow(_counted(settings), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.least)


def _halves(words: DataFrame) -> DataFrame:
    """(m, side, half, word, n, own) for words of length m or one less that can be near by an edit on the other side of the half."""
    length = F.length("word")
    rows = []
    for more in (0, 1):
        m = length + more
        h = (m / 2).cast("int")
        rows += [F.struct(m.alias("m"), F.lit(side).alias("side"), half.alias("half"), F.lit(not more).alias("own")) for side, half in ((0, F.substr("word", F.lit(1), h)), (1, F.substr("word", h + 1 - more)))]
    return words.select("word", "n", F.inline(F.array(*rows)))


def _block(table: pa.Table) -> pa.Table:
    """(word, n_near, form_n, form) of each word that has near words in this block: how many, and the most frequent one."""
    words, inverse = np.unique(np.array(table.column("word").to_pylist(), object), return_inverse=True)
    n = np.zeros(len(words), np.int64)
    n[inverse] = table.column("n").to_numpy()
    lengths = np.array(list(map(len, words)))
    m, side, held, i, j = (table.column(c).to_numpy() for c in ("m", "side", "held", "i", "j"))
    x, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    cells, cell = np.unique(np.stack([m, side, i, j]), axis=1, return_inverse=True)  # chunks of a half that is cut stay apart
    for c, (k, s) in enumerate(cells[:2].T.tolist()):
        here = cell == c
        found, asks = np.unique(inverse[here & held]), np.unique(inverse[here & ~held])
        for length in (k, k - 1):
            some = asks[lengths[asks] == length]
            q, v = near_pairs([words[w] for w in found], [words[w] for w in some], range(k // 2, k) if s == 0 else range(k // 2))
            x.append(some[q])
            y.append(found[v])
            if length < k:
                x.append(found[v])
                y.append(some[q])
    x, y = np.concatenate(x), np.concatenate(y)
    order = np.lexsort((y, -n[y], x))  # places in `words` are in code-point order
    x, y = x[order], y[order]
    at = np.flatnonzero(np.diff(x, prepend=-1))
    best = y[at]
    columns = [pa.array(words[x[at]], pa.string()), pa.array(np.diff(at, append=len(x)), pa.int64()), pa.array(n[best], pa.int64()), pa.array(words[best], pa.string())]
    return pa.table(columns, names=["word", "n_near", "form_n", "form"])


def near_words(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n_near, form_n, form) of the words (distinct word, n) that have near words: their number and the one of largest n, ties to the smallest."""
    s, keys = settings, ["m", "side", "half"]
    halves = materialize(_halves(words), "halves")
    groups = halves.groupBy(*keys).agg(F.count_if("own").alias("n_held"), F.count("*").alias("n_asks")).where("n_held > 0 and n_asks > 1")
    size = lambda n: F.ceil(F.col(n) / s.chunk).cast("int")
    groups = groups.withColumn("held_chunks", size("n_held")).withColumn("ask_chunks", size("n_asks"))
    rows = halves.join(groups, keys)
    mine = lambda chunks: F.pmod(F.xxhash64("word"), F.col(chunks).cast("bigint")).cast("int")
    every = lambda chunks: F.sequence(F.lit(0), F.col(chunks) - 1)
    columns = [*keys, "word", "n"]
    held = rows.where("own").select(*columns, F.lit(True).alias("held"), mine("held_chunks").alias("i"), F.explode(every("ask_chunks")).alias("j"))
    asks = rows.select(*columns, F.lit(False).alias("held"), F.explode(every("held_chunks")).alias("i"), mine("ask_chunks").alias("j"))
    dealt = materialize(held.unionByName(asks), "dealt")
    blocks = max(1, math.ceil(dealt.count() / s.block))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(*keys, "i", "j"), F.lit(blocks)))
    found = dealt.groupBy("block").applyInArrow(_block, "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form")).alias("best")
    near = materialize(found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best), "near")
    remove(halves, dealt)
    return near.select("word", "n_near", (-F.col("best.n")).alias("form_n"), "best.form")


def forms(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """word, form, root, n, n_near, form_n for the distinct words in (word, n).

    form is the near word of largest n (ties: the smallest in code-point order) if it occurs `ratio` times as often as the word, else null; root is
    what following the forms leads to. Words of one character or of very many, and tables without rows, are like any others;
    words must not hold U+0000.
    """
    s = settings
    words = materialize(words.select("word", "n"), "words")
    near = near_words(words, s)
    rows = words.join(near, "word", "left")
    has = F.col("form_n") >= s.ratio * F.col("n")
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n"))
    rows = materialize(rows, "forms")
    linked = rows.where("form is not null").select("word", F.col("form").alias("root"))
    bounds = rows.agg(F.max("n"), F.min("n")).first()
    # Counts grow by the ratio with each step, which bounds the steps; each round doubles those that are taken.
    steps = math.floor(math.log(max(1, (bounds[0] or 1) / max(1, bounds[1] or 1)), s.ratio)) + 1
    for _ in range((steps - 1).bit_length()):
        before, further = linked, linked.select(F.col("word").alias("root"), F.col("root").alias("further"))
        linked = materialize(linked.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
        remove(before)
    out = rows.join(linked, "word", "left")
    remove(words, near)
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Best-fit packing of documents into sequences of a fixed number of tokens, in bulk-synchronous rounds.

Documents are encoded and closed by an end id; only those longer than a sequence are cut. What fills a sequence is one. All others are
packed in bands of length, the longest first. A round of a band sorts its documents and the gaps of all open sequences by size, in ranges,
largest first. Each range is swept on its own: a document takes the smallest gap of its range that it fits in (its successor), and what is left of the gap
is a gap again. Documents left over then look to the ranges before theirs, whose gaps all fit: where many want the same gap, their ranks
decide, the document of rank r taking the r-th smallest gap not taken by others. Only counts by range reach the driver for that, and the ranges are
met by joins. Gaps are updated and the rounds repeated until no document finds a gap any more; those still left open new sequences, range by
range by the same rule. So a row travels by (id, length) alone, a few times; texts and ids never.

The number of sequences is that of best-fit decreasing, but for gaps that a range could not see in time and one unfilled sequence a range.
"""

from __future__ import annotations

import json
import math
import re
import struct
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import _LETTER, _NUMBER, _SPACE
from .common import as_text, fresh_path, map_columns, materialize, remove, text_of

#: Outside this range the library's own splitter works. Up to U+017F and in general punctuation the classes below are those of the library.
_ODD = re.compile("[\u0180-\u200f\u2028-\u20ab\u20ad-\U0010ffff]")
_PLAIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Words that a worker keeps encoded, and the longest of them.
MOST_WORDS, LONGEST_WORD = 300_000, 64


@dataclass(frozen=True)
class Settings:
    capacity: int = 2048
    end_id: int = 0
    shortest_band: int = 32  # documents up to this length are one band
    rows: int = 1 << 14  # rows of a sorted range, if the session's shuffle partitions allow for so many ranges
    most_rows: int = 1 << 20  # rows of a sorted range in any case, about
    tokenizer: str | None = None  # path; None: byte_bpe_50k.json of public_tokenizers


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Encoder(dict):
    """Ids of texts as little-endian 32-bit numbers, equal to the library's; itself the ids of words met so far.

    Words are merged by tiktoken, if the file is a byte-level vocabulary whose ids are in the order of its merges; all else goes to the library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        added, pre, model = made["added_tokens"], made["pre_tokenizer"] or {}, made["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        ids = [model["vocab"].get(a + b, -1) for a, b in merges]
        simple = not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")) and made["normalizer"] is None
        simple = simple and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
        self.by_word = simple and model["type"] == "BPE" and all(a < b for a, b in zip([255, *ids], ids, strict=False)) and not any(model.get(k) for k in ("dropout", "end_of_word_suffix", "continuing_subword_prefix"))
        if self.by_word:
            letters = byte_letters()
            ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in {t["content"] for t in added}}
            self.merge = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special = {t["content"]: struct.pack("<I", t["id"]) for t in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None

    def __missing__(self, word: str) -> bytes:
        merged = self.merge(word)
        ids = struct.pack(f"<{len(merged)}I", *merged)
        if len(word) <= LONGEST_WORD:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if not self.by_word or _ODD.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.cut is None or not self.cut.search(text):
            return b"".join(map(self.__getitem__, _PLAIN.findall(text)))
        return b"".join(self.special[part] if part in self.special else self.ids(part) for part in self.cut.split(text))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut_points(n: int, capacity: int) -> list[int]:
    """Where n tokens are cut: pieces of the capacity, the first one what is left over."""
    return [0, *range((n - 1) % capacity + 1, n + 1, capacity)]


def _pieces(texts, s: Settings, with_ids: bool):
    encode, end, out = encoder(s.tokenizer or tokenizer_path()).ids, struct.pack("<I", s.end_id), []
    for t in as_text(texts):
        ids = encode(t) + end
        at = cut_points(len(ids) // 4, s.capacity)
        rows = []
        for i, (a, b) in enumerate(zip(at, at[1:], strict=False)):
            row = {"piece": i, "start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[4 * a : 4 * b])}
            rows.append(row | {"ids": np.frombuffer(ids[4 * a : 4 * b], "<u4").astype(np.int32)} if with_ids else row)
        out.append(rows)
    return [out]


def pieces(docs: DataFrame, keep: list, text_col: str = "text", settings: Settings = Settings(), with_ids: bool = True) -> DataFrame:
    """Columns keep, piece (int, from 0), start, length, ids_crc32 and, unless left out, ids, for each piece of each row of docs.

    Null text counts as empty; an empty text is its end id alone. Repeated rows give repeated pieces; a table without rows gives none.
    """
    made = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint" + (",ids:array<int>>>" if with_ids else ">>")
    n = len(docs.select(*keep).columns)
    rows = map_columns(docs, keep, [text_of(docs, text_col)], {"__sigweave_pieces": made}, _pieces, s=settings, with_ids=with_ids)
    return rows.select(*(F.col(f"`{c}`") for c in rows.columns[:n]), F.inline("__sigweave_pieces"))


_SWEPT = "what string, row bigint, seq bigint, at int, size int, part int, rank bigint"


def _sweep(capacity: int, opens: bool):
    """Best fit within one sorted range of (size, gap, row, at).

    Gives a row for each document placed, for each document left (with its rank, largest first) and for each gap left (with its rank, largest
    first, if all documents of later ranges fit in it). If opens, a document without a gap opens a sequence, known by its row.
    """

    def run(batches):
        from pyspark import TaskContext

        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        size, gap, row, at = (table.column(c).to_pylist() for c in ("size", "gap", "row", "at"))
        open_: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        sizes, placed, left = 0, [], []  # sizes: a bit for each size of which a gap is open
        for n, is_gap, r, a in zip(size, gap, row, at, strict=True):
            if is_gap:
                open_[n].append((r, a))
                sizes |= 1 << n
                continue
            if fits := sizes >> n:
                room = n + (fits & -fits).bit_length() - 1
                seq, a = open_[room].pop()
                if not open_[room]:
                    sizes ^= 1 << room
            elif opens:
                seq, a, room = r, 0, capacity
            else:
                left.append((r, n))
                continue
            placed.append((r, seq, a))
            if room > n:
                open_[room - n].append((seq, a + n))
                sizes |= 1 << (room - n)
        gaps = [(seq, a, c) for c in range(capacity, 0, -1) for seq, a in open_[c]]
        sure = sum(c >= size[-1] for _, _, c in gaps)
        p, d, g = len(placed), len(left), len(gaps)
        column = lambda kind, *parts: pa.array([x for some in parts for x in some], kind)
        yield pa.RecordBatch.from_arrays(
            [
                column(pa.string(), ["placed"] * p, ["doc"] * d, ["gap"] * g),
                column(pa.int64(), (x[0] for x in placed), (x[0] for x in left), [None] * g),
                column(pa.int64(), (x[1] for x in placed), [None] * d, (x[0] for x in gaps)),
                column(pa.int32(), (x[2] for x in placed), [None] * d, (x[1] for x in gaps)),
                column(pa.int32(), [None] * p, (x[1] for x in left), (x[2] for x in gaps)),
                pa.array([TaskContext.get().partitionId()] * (p + d + g), pa.int32()),
                column(pa.int64(), [None] * p, range(d), range(sure), [None] * (g - sure)),
            ],
            names=["what", "row", "seq", "at", "size", "part", "rank"],
        )

    return run


def match_ranges(docs: dict[int, int], gaps: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """(range of documents, their first rank, range of gaps, their last rank, how many) from the numbers left in each range.

    Later ranges hold smaller sizes. Documents, in order, take the smallest gaps still free of the ranges before theirs.
    """
    out, stack = [], []
    for part in sorted({*docs, *gaps}):
        first, wanted = 0, docs.get(part, 0)
        while wanted and stack:
            of, free = stack.pop()
            n = min(wanted, free)
            out.append((part, first, of, free - 1, n))
            first, wanted = first + n, wanted - n
            if free > n:
                stack.append((of, free - n))
        if gaps.get(part):
            stack.append((part, gaps[part]))
    return out


class _Packer:
    """The tables of one run: documents by band, open gaps, what has been placed."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.s, self.placed, self.made = spark, settings, [], []
        self.gaps = self.table([], "row bigint, at int")

    def table(self, rows: list, schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        out = materialize(df, name)
        self.made.append(out)
        return out

    def ranges(self, n: int) -> int:
        bound = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / self.s.most_rows))
        return max(1, min(math.ceil(n / self.s.rows), bound))

    def sweep(self, docs: DataFrame, gaps: DataFrame | None, n: int, opens: bool) -> DataFrame:
        items = docs.select("size", F.lit(False).alias("gap"), "row", F.lit(0).alias("at"))
        if gaps is not None:
            items = items.unionByName(gaps.select((F.lit(self.s.capacity) - F.col("at")).alias("size"), F.lit(True).alias("gap"), "row", "at"))
        order = [F.col("size").desc(), F.col("gap").desc(), F.xxhash64("row")]
        swept = items.repartitionByRange(self.ranges(n), *order).sortWithinPartitions(*order).mapInArrow(_sweep(self.s.capacity, opens), _SWEPT)
        swept = self.keep(swept, "swept")
        self.placed.append(swept.where("what = 'placed'").select("row", "seq", "at"))
        return swept

    def band(self, docs: DataFrame, n_docs: int, least: int) -> None:
        """Places all documents (row, size) of a band whose shortest has length `least`."""
        fits = F.lit(self.s.capacity) - F.col("at") >= least
        waiting = [self.gaps.where(~fits)]
        gaps = self.gaps.where(fits)
        while n_docs and (n_gaps := gaps.count()):
            ranges = self.ranges(n_docs + n_gaps)
            swept = self.sweep(docs, gaps, n_docs + n_gaps, opens=ranges == 1)
            docs = swept.where("what = 'doc'").select("row", "size", "part", "rank")
            left = swept.where("what = 'gap'").select(F.col("seq").alias("row"), "at", "part", "rank")
            if ranges == 1:  # no other range to look to: what found no gap has opened sequences
                self.gaps = waiting[0].unionByName(left.select("row", "at"))
                return
            counts = swept.where("rank is not null").groupBy("what", "part").agg(F.count("*").alias("n")).collect()  # two rows a range
            number = {k: {r.part: r.n for r in counts if r.what == k} for k in ("doc", "gap")}
            matched = match_ranges(number["doc"], number["gap"])
            n_docs = sum(number["doc"].values()) - sum(m[4] for m in matched)
            docs, gaps = self.meet(docs, left, matched) if matched else (docs.select("row", "size"), left.select("row", "at"))
            waiting = [self.keep(waiting[0].unionByName(gaps.where(~fits)), "gaps")]
            gaps = self.keep(gaps.where(fits), "gaps")
            docs = self.keep(docs, "left")
            if not matched:
                break
        rest = waiting[0].unionByName(gaps)
        if n_docs:
            opened = self.sweep(docs, None, n_docs, opens=True)
            rest = rest.unionByName(opened.where("what = 'gap'").select(F.col("seq").alias("row"), "at"))
        self.gaps = rest

    def meet(self, docs: DataFrame, gaps: DataFrame, matched: list[tuple[int, int, int, int, int]]) -> tuple[DataFrame, DataFrame]:
        """Documents and gaps of matched ranges meet by rank; returns the documents still left and all gaps after that."""
        first = np.cumsum([0] + [m[4] for m in matched]).tolist()
        want = self.table([(d, r, r + n, b) for (d, r, _, _, n), b in zip(matched, first[:-1], strict=True)], "part int, lo bigint, hi bigint, base bigint")
        give = self.table([(g, t - n + 1, t + 1, b) for (_, _, g, t, n), b in zip(matched, first[:-1], strict=True)], "part int, lo bigint, hi bigint, base bigint")
        inside = (F.col("a.part") == F.col("b.part")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))

        def numbered(rows: DataFrame, table: DataFrame, pair) -> DataFrame:
            # A row a matched stretch: at most two for each range.
            return rows.alias("a").join(F.broadcast(table).alias("b"), inside, "left").select("a.*", pair.alias("pair"))

        docs = numbered(docs, want, F.col("base") + F.col("rank") - F.col("lo"))
        gaps = numbered(gaps, give, F.col("base") + F.col("hi") - 1 - F.col("rank"))
        met = docs.where("pair is not null").join(gaps.where("pair is not null").select("pair", F.col("row").alias("seq"), "at").hint("shuffle_hash"), "pair")
        met = self.keep(met.select("row", "seq", "at", "size"), "met")
        self.placed.append(met.select("row", "seq", "at"))
        after = met.select(F.col("seq").alias("row"), (F.col("at") + F.col("size")).alias("at")).where(F.col("at") < self.s.capacity)
        return docs.where("pair is null").select("row", "size"), gaps.where("pair is null").select("row", "at").unionByName(after)


def pack(rows: DataFrame, settings: Settings = Settings(), length_col: str = "length") -> DataFrame:
    """rows with sequence_id and offset: sequences of at most `capacity`, gapless, in as few as best fit needs.

    Lengths must be from 1 to the capacity; others raise an error, null as well. Rows equal in length are interchangeable; repeated rows are
    rows like any others. The order within a sequence is that of placing, longest first. An empty table gives no rows. A sequence is
    known by a number of the row that opened it. Columns of rows named sequence_id, offset or `__sigweave_row` raise an error.
    """
    s, spark = settings, rows.sparkSession
    if clash := {"sequence_id", "offset", "__sigweave_row"} & {*rows.columns}:
        raise ValueError(f"columns {sorted(clash)} are already there")
    held = materialize(rows.withColumn("__sigweave_row", F.monotonically_increasing_id()), "pieces")
    size = F.col(f"`{length_col}`").cast("int")
    lengths = held.select(F.col("__sigweave_row").alias("row"), size.alias("size"), F.greatest(F.length(F.bin(size - 1)), F.lit((s.shortest_band - 1).bit_length())).alias("band"))
    lengths = lengths.withColumn("band", F.when(F.coalesce(~F.col("size").between(1, s.capacity), F.lit(True)), -1).when(F.col("size") == s.capacity, 0).otherwise(F.col("band")))
    path = fresh_path(spark, "lengths")
    spread = F.pmod(F.xxhash64("row"), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    lengths.repartition("band", spread).write.partitionBy("band").parquet(path)
    lengths = spark.read.schema("row bigint, size int, band int").parquet(path)
    lengths._sigweave_path = path
    bands = {r.band: r for r in lengths.groupBy("band").agg(F.count("*").alias("n"), F.min("size").alias("least")).collect()}  # a row a band
    if -1 in bands:
        remove(held, lengths)
        raise ValueError(f"{bands[-1].n} lengths are not from 1 to {s.capacity}")
    packer = _Packer(spark, s)
    packer.placed.append(lengths.where("band = 0").select("row", F.col("row").alias("seq"), F.lit(0).alias("at")))
    for band in sorted((b for b in bands if b > 0), reverse=True):
        packer.band(lengths.where(F.col("band") == band).select("row", "size"), bands[band].n, bands[band].least)
    placed = packer.placed[0]
    for more in packer.placed[1:]:
        placed = placed.unionByName(more)
    placed = materialize(placed, "placed")
    remove(lengths, *packer.made)
    out = held.join(placed, held["__sigweave_row"] == placed["row"])
    return out.select(*(held[f"`{c}`"] for c in rows.columns), placed["seq"].alias("sequence_id"), placed["at"].cast("bigint").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from packed pieces with ids; a sequence's pieces are bounded by its capacity."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("rows"))
    return rows.select("sequence_id", F.flatten("rows.ids").alias("ids"))

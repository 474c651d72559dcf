"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly, and every group of equal texts lies in one shard.

A group that holds over 1 / HEAVY of all bytes, tokens or rows is a unit of its own; there are at most 3 * HEAVY of these. All smaller
groups are dealt whole into CELLS cells by the digest of their text, and each cell is a unit. The units' vectors (bytes, tokens, rows) come to
the driver, so many at most whatever the input. They are placed the largest share first, each where the dot product of its vector with the
shard's residual capacity is highest, all three weighing the same; then units move or change places so that bytes even out without
loss to the joint balance. A group larger than a shard's fair share stays whole: its shard is then larger than the others.

Slots follow from the units' counts and a numbering within units; a heavy group's rows are numbered in pieces by a hash of the id, so that no
task numbers a third of all rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_of
from .mixing import size_of

CELLS = 1 << 14
HEAVY = 1 << 12
#: A heavy group's rows are numbered in pieces of about 1 / PIECES of all rows.
PIECES = 1 << 10


def place(vectors: np.ndarray, shards: int, moves: int = 4000) -> np.ndarray:
    """A shard for each vector (bytes, tokens, rows): by dot product with residual capacity, then evened out in bytes."""
    n = len(vectors)
    if not n:
        return np.zeros(0, int)
    share = vectors / np.maximum(vectors.sum(axis=0), 1)
    capacity = np.full((shards, share.shape[1]), 1.0 / shards)
    out = np.zeros(n, int)
    for i in np.lexsort((np.arange(n), -share.max(axis=1))):
        out[i] = k = int(np.argmax(capacity @ share[i] if share[i].any() else capacity.sum(axis=1)))
        capacity[k] -= share[i]
    size = vectors[:, 0].astype(np.int64)
    load = np.bincount(out, weights=size, minlength=shards).astype(np.int64)
    fixed = np.zeros(shards, bool)  # shards from which nothing more can go
    for _ in range(moves):
        hi, lo = int(np.where(fixed, -1, load).argmax()), int(load.argmin())
        gap = int(load[hi] - load[lo])
        if fixed[hi] or gap <= 1:
            break
        got = _exchange(share, size, np.flatnonzero(out == hi), np.flatnonzero(out == lo), gap, capacity[hi], capacity[lo])
        if got is None:
            fixed[hi] = True
            continue
        x, y = got
        for unit, k, other in ((x, lo, hi), (y, hi, lo)):
            if unit >= 0:
                out[unit] = k
                load[k] += size[unit]
                load[other] -= size[unit]
                capacity[k] -= share[unit]
                capacity[other] += share[unit]
    return out


def _exchange(share: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, gap: int, left_a: np.ndarray, left_b: np.ndarray) -> tuple[int, int] | None:
    """A unit of a that goes to b's shard and one that comes back (-1: none), at least halving the gap in bytes; of those the best for all three."""
    if not len(a):
        return None
    b = np.append(b[np.argsort(size[b], kind="stable")], -1)
    there = np.append(size[b[:-1]], 0)
    order = np.argsort(there, kind="stable")
    b, there = b[order], there[order]
    # Moving x for y changes the gap by twice x - y: partners nearest to half the gap, and their neighbours.
    at = np.searchsorted(there, size[a] - gap / 2)
    pairs = np.stack([np.repeat(a, 4), b[np.clip(at[:, None] + np.arange(-2, 2), 0, len(b) - 1)].ravel()], axis=1)
    come = np.where(pairs[:, 1] >= 0, size[pairs[:, 1]], 0)
    new = np.abs(gap - 2 * (size[pairs[:, 0]] - come))
    pairs, new = pairs[new * 2 <= gap], new[new * 2 <= gap]
    if not len(pairs):
        return None
    delta = share[pairs[:, 0]] - np.where(pairs[:, 1:] >= 0, share[pairs[:, 1]], 0)
    uneven = ((left_a + delta) ** 2 + (left_b - delta) ** 2).sum(axis=1)
    return tuple(int(x) for x in pairs[np.lexsort((new, uneven))[0]])


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law (`bytes`), shard, slot, grown_shard (null) for every row of docs.

    Size is the bytes of the text plus 1; null text has none and counts as empty. A null id is an id like any other. Rows
    equal in id and text are numbered in any order, in one task. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(text_of(docs, text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        size_of(text).alias("tokens"), F.md5(text).alias("text_md5"),
    )
    rows = materialize(rows.withColumn("cell", F.conv(F.substring("text_md5", 1, 4), 16, 10).cast("int") % CELLS), "rows")
    sums = (F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    groups = materialize(rows.groupBy("text_md5", "cell").agg(*sums), "groups")
    total = groups.agg(F.sum("size"), F.sum("tokens"), F.sum("rows")).first()
    share = F.greatest(*(F.col(c) / F.lit(float(max(1, t or 0))) for c, t in zip(("size", "tokens", "rows"), total, strict=True)))
    heavy = groups.withColumn("share", share).where(F.col("share") > 1 / HEAVY)  # at most 3 * HEAVY rows
    heavy = materialize(heavy.select("text_md5", F.ceil(F.col("rows") * PIECES / max(1, total[2] or 0)).cast("int").alias("pieces")), "heavy")

    def united(df: DataFrame) -> DataFrame:
        unit = F.when(F.col("pieces").isNull(), F.col("cell").cast("string")).otherwise(F.col("text_md5"))
        return df.join(F.broadcast(heavy), "text_md5", "left").withColumn("unit", unit)

    units = united(groups).groupBy("unit").agg(*(F.sum(c).alias(c) for c in ("size", "tokens", "rows")))
    units = sorted(units.collect(), key=lambda r: r.unit)  # at most CELLS + 3 * HEAVY
    placed = place(np.array([(r["size"], r["tokens"], r["rows"]) for r in units], dtype=float).reshape(-1, 3), shards)
    piece = F.when(F.col("pieces") > 1, F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), F.col("pieces").cast("bigint"))).otherwise(0).cast("int")
    pieced = united(rows).withColumn("piece", piece)
    cut: dict[str, list[tuple[int, int]]] = {}
    for r in pieced.where("pieces > 1").groupBy("unit", "piece").agg(F.count("*").alias("n")).collect():  # at most PIECES + 3 * HEAVY
        cut.setdefault(r.unit, []).append((r.piece, r.n))
    first, table = [0] * shards, []
    for r, k in zip(units, placed.tolist(), strict=True):
        for at, n in sorted(cut.get(r["unit"], [(0, r["rows"])])):
            table.append((r["unit"], at, k, first[k]))
            first[k] += n
    table = spark.createDataFrame(table, "unit string, piece int, shard int, first bigint")
    inside = F.row_number().over(Window.partitionBy("unit", "piece").orderBy("doc_id", "text_md5")) - 1
    found = pieced.withColumn("inside", inside).join(F.broadcast(table), ["unit", "piece"])
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("inside")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

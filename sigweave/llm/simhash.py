"""SimHash near-duplicates with pigeonring filtering.

Fingerprints of 64 bits are cut into three segments. If two fingerprints differ in at most two bits, then at some segment a chain
starts whose cumulative differences stay within the proportional budgets 2/3, 4/3 and 2: the first segment is equal, the first
two differ in one bit at most, and all three in two at most (the strong form of the pigeonring principle). A segment that differs in at
most one bit agrees in one of its halves, which makes the first two budgets an equality key of 31 or 32 bits. Candidates of a key
are held against the chain's budgets and only then against the full distance.

A key that more than `bucket` fingerprints share lists no pairs. Its fingerprints take another exact way: each emits all 65 values
within one bit of itself; fingerprints that share such a value differ by at most two bits, and two that differ by at most two
bits share one. They are linked to the smallest that shares the value, so links grow with rows and not with pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_columns, materialize, text_of
from .components import connected_components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: First bit and width of the segments, and of their two halves.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
CHUNK = 1 << 15


def majority(hashes: np.ndarray) -> int:
    """Unsigned fingerprint of 64-bit values: a bit is set if it is set in over half of them; no value gives 0."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        counts += np.unpackbits(hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def simhash(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned fingerprint of a text's word shingles: a bit is set if it is set in over half of their XXH64 values; no word gives 0."""
    import xxhash

    hashed = xxhash.xxh64_intdigest
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        return hashed(b" ".join(words), seed)
    n = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    for at in range(0, n, CHUNK):
        some = np.fromiter((hashed(s, seed) for _, s in zip(range(min(CHUNK, n - at)), shingles, strict=False)), np.uint64, min(CHUNK, n - at))
        counts += np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def _batch(texts, shingle, seed):
    made = np.array([simhash(t, shingle, seed) for t in as_bytes(texts)], np.uint64)
    return [made.view(np.int64).tolist()]


def fingerprints(docs: DataFrame, keep: list[str | Column], text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """Columns keep and fp, the fingerprint as a signed long. Null text counts as empty."""
    return map_columns(docs, keep, [text_of(docs, text_col)], {"fp": "bigint"}, _batch, shingle=shingle, seed=seed)


def _bits(c: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(c, at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _mask(i: int) -> int:
    """Bits of segment i and the next one, as a signed long."""
    got = sum(((1 << w) - 1) << a for a, w in (SEGMENTS[i], SEGMENTS[(i + 1) % 3]))
    return got - (1 << 64) if got >> 63 else got


def chain_keys(fp: Column) -> Column:
    """Six keys: each start of a chain with either half of the next segment; the last three bits hold which."""
    keys = []
    for i in range(3):
        (a, w), (b, v) = SEGMENTS[i], SEGMENTS[(i + 1) % 3]
        for half, (at, width) in enumerate(((b, v // 2), (b + v // 2, v - v // 2))):
            packed = F.shiftleft(F.shiftleft(_bits(fp, a, w), 11).bitwiseOR(_bits(fp, at, width)), 3)
            keys.append(packed.bitwiseOR(F.lit(2 * i + half).cast("long")))
    return F.array(*keys)


def fingerprint_links(prints: DataFrame, distance: int = 2, bucket: int = 32) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints (distinct column fp) within distance 2, directly or through others."""
    if distance != 2:
        raise ValueError("segments and budgets are laid out for a distance of 2")
    keyed = materialize(prints.select("fp", F.explode(chain_keys(F.col("fp"))).alias("key")), "keys")
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(keyed.join(counts, "key"), "shared")
    lists = shared.where(F.col("n") <= bucket).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    start = F.shiftright(F.col("key").bitwiseAND(F.lit(7).cast("long")), 1)

    def passes(a: Column, b: Column) -> Column:
        diff = a.bitwiseXOR(b)
        two = F.when(start == 0, diff.bitwiseAND(F.lit(_mask(0)))).when(start == 1, diff.bitwiseAND(F.lit(_mask(1)))).otherwise(diff.bitwiseAND(F.lit(_mask(2))))
        return (F.bit_count(two) <= 1) & (F.bit_count(diff) <= distance)

    pairs = F.flatten(F.transform("fps", lambda a, i: F.transform(F.filter(F.slice("fps", i + 2, F.size("fps")), lambda b: passes(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    near = lists.select(F.explode(pairs).alias("p")).select("p.a", "p.b").distinct()
    crowded = shared.where(F.col("n") > bucket).select("fp").distinct()
    flips = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i).cast("long")) for i in range(64)))
    around = materialize(crowded.select("fp", F.explode(flips).alias("z")), "around")
    hubs = around.groupBy("z").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).where("n > 1")
    starred = around.join(hubs, "z").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()
    return near.unionByName(starred)


def close_pairs(nodes: DataFrame, bucket: int = 32) -> DataFrame:
    """(d, fp): each node with the first node of its own fingerprint, and of every fingerprint linked to it, if that stands before it.

    nodes are (fp, sim, place): a key, a fingerprint and an order in which no two are equal. Pairs grow with nodes and links, however many share a fingerprint.
    """
    heads = nodes.groupBy("sim").agg(F.min("place").alias("head"), F.min_by("fp", "place").alias("fp"))
    heads = materialize(heads, "heads")
    links = fingerprint_links(heads.select(F.col("sim").alias("fp")), bucket=bucket)
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = links.select(F.inline(ways)).unionByName(heads.select(F.col("sim").alias("a"), F.col("sim").alias("b")))
    near = both.join(heads, both["b"] == heads["sim"]).select("a", "head", "fp")
    return nodes.select(F.col("fp").alias("d"), F.col("sim").alias("a"), "place").join(near, "a").where("head < place").select("d", "fp").distinct()


def print_components(prints: DataFrame, bucket: int = 32) -> DataFrame:
    """(fp, root) for the distinct fingerprints in column fp; root is any fixed one of its component."""
    prints = prints.select("fp").distinct()
    joined = connected_components(fingerprint_links(prints, bucket=bucket))
    return prints.join(joined, prints["fp"] == joined["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = 32) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (the smallest id reachable; null ids take no part in the minimum).

    One row for each input row, repeated rows included. Other columns of docs are ignored. An empty table gives no rows.
    """
    prints = materialize(fingerprints(docs, [F.col(id_col).alias("doc_id")], text_col), "prints")
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = materialize(print_components(firsts, bucket), "roots")
    least = roots.join(firsts, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    classes = roots.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def row_key(docs: DataFrame, id_col: str) -> Column:
    """Order of rows: the smallest id (null last), then the smallest hash of the row."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns)))).alias("row"))


def whole_rows(docs: DataFrame, row: Column, prints: DataFrame, best: DataFrame) -> DataFrame:
    """The rows of docs whose key is in best (column k), one for each key; prints has the keys of all rows."""
    columns = docs.columns
    kept = prints.join(best.select("k"), "k", "left_semi").groupBy("k").agg(F.count("*").alias("n"))
    found = docs.withColumn("__sigweave_k", row).join(kept.select(F.col("k").alias("__sigweave_k"), F.col("n").alias("__sigweave_n")), "__sigweave_k")
    once = found.where("__sigweave_n = 1")
    again = found.where("__sigweave_n > 1").dropDuplicates(["__sigweave_k"])
    return once.unionByName(again).select(*(F.col(f"`{c}`") for c in columns))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = 32) -> DataFrame:
    """docs with one document of each group: the smallest id (null last), then the smallest hash of the row."""
    row = row_key(docs, id_col)
    prints = materialize(fingerprints(docs, [row.alias("k")], text_col), "prints")
    firsts = materialize(prints.groupBy("fp").agg(F.min("k").alias("k")), "firsts")
    best = print_components(firsts, bucket).join(firsts, "fp").groupBy("root").agg(F.min("k").alias("k"))
    return whole_rows(docs, row, prints, best)

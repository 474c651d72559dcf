"""Approximate nearest neighbours by inner product: an NN-descent graph and greedy search in it.

Equal vectors are one node, so copies cost nothing. Nodes get a coordinate more, which makes all equally long, so that nearness by angle is
nearness by inner product; the `longest` few are cut to the length of the last of them for that, so that outliers cost the others no precision,
and are held against every query directly. A vector's direction is quantised to a byte a coordinate by a scale of its own.

The graph starts from neighbours in random orders of all nodes (by the signs of random projections), cut into chunks. NN-descent then
joins, for each node, its neighbours and those whose neighbour it is with each other, and every pair may improve the lists of both; only
pairs with a link that is new since the last round are compared. Rounds are Spark joins over written tables, and go on until few links are
new. Nodes are dealt into parts: lists travel as ids, and a vector's code travels once to each part that needs it, not once for
each link.

A query starts at its own node and at the longest ones, and repeatedly expands the nearest candidates of its beam that are not yet
expanded, all queries at once, until none is left. A step sends the ids of these to the parts that hold their links, the ids of the
links with the query to the parts that hold their codes, and only what enters the beam back. Reverse lists and beams grow with the logarithm
of the number of nodes. The best candidates are scored on the original vectors in double precision.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, remove


@dataclass(frozen=True)
class Settings:
    neighbours: int = 32  # links of a node
    reverse: int = 32  # nodes whose neighbour a node is that take part in its join: the nearest; so many up to `usual` nodes
    orders: int = 16
    chunk: int = 512  # nodes compared with each other in a random order
    taken: int = 10  # links a node gets from one order
    settled: float = 0.02  # rounds end when a smaller share of the links is new
    beam: int = 192  # up to `usual` nodes
    expanded: int = 32  # nearest open candidates of a query that a step expands
    longest: int = 64  # nodes that every query is held against besides its own
    usual: int = 1 << 15
    rescored: int = 64
    part_nodes: int = 1 << 12
    part_bytes: int = 1 << 27  # of codes that a part's join may need at once
    seed: int = 7

    def grown(self, size: int, n: int) -> int:
        """size for a graph of n nodes: in proportion to log n beyond `usual`."""
        return math.ceil(size * max(1.0, math.log(max(n, 2)) / math.log(self.usual)))


def usable(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector): rows with an id and a finite, non-zero vector; rows equal in both are one."""
    v = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("vector")).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    rows = rows.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vector", lambda x: x != 0))
    return rows.distinct()


def _norm(vector: str) -> Column:
    """The length of a vector, without overflow."""
    top = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    return F.least(top * F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x / top) * (x / top))), F.lit(1.7e308))


def _part(node: str, parts: int) -> Column:
    return F.pmod(F.col(node).bitwiseXOR(F.shiftrightunsigned(node, 32)), F.lit(parts)).cast("int")


def _parts_of(nodes: np.ndarray, parts: int) -> np.ndarray:
    """What _part says, for an array."""
    return (nodes ^ (nodes.view(np.uint64) >> np.uint64(32)).view(np.int64)) % parts


def part_count(n: int, width: int, s: Settings) -> int:
    """A prime number of parts for n nodes, such that the codes that a part's join needs at most fit `part_bytes`. What a step sends follows from it, so it is the same whatever the session's partitions."""
    links = s.neighbours + s.grown(s.reverse, n)
    p = max(13, n // s.part_nodes, math.ceil(n * links * (width + 40) / s.part_bytes)) | 1
    while any(p % d == 0 for d in range(3, math.isqrt(p) + 1, 2)):
        p += 2
    return p


def _kind(width: int) -> np.dtype:
    """A node's direction (a byte a coordinate), its scale, that of the cut vector, and the added coordinate."""
    return np.dtype([("code", np.int8, (width,)), ("scale", np.float64), ("cut", np.float64), ("rest", np.float64)])


def _whole(width: int) -> type:
    """A type in which products of codes are whole numbers, so that scores agree in every task."""
    return np.float32 if width * 127 * 127 < 1 << 24 else np.float64


def _flat_bytes(column: pa.Array | pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _quantised(nodes: DataFrame, width: int, usual: float) -> DataFrame:
    """(node, code) from (node, vector, norm): the lengthened vectors; lengths are in units of `usual`, and cut there."""
    kind = _kind(width)

    def run(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            norm = b.column(2).to_numpy(zero_copy_only=False)
            top = np.abs(x).max(axis=1)
            made = np.zeros(len(x), kind)
            made["code"] = np.rint(x / top[:, None] * 127)
            made["scale"] = top / usual / 127
            made["cut"] = made["scale"] * np.minimum(1.0, usual / norm)
            made["rest"] = np.sqrt(np.maximum(0.0, 1 - np.minimum(1.0, norm / usual) ** 2))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in made], pa.binary())], names=["node", "code"])

    return nodes.select("node", "vector", "norm").mapInArrow(run, "node bigint, code binary")


def _best(u: np.ndarray, w: np.ndarray, s: np.ndarray, fresh: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best distinct w of each u, by s and then w; of equal links one that is not fresh stays so."""
    order = np.lexsort((fresh, w, u))
    u, w, s, fresh = u[order], w[order], s[order], fresh[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1])
    u, w, s, fresh = u[new], w[new], s[new], fresh[new]
    order = np.lexsort((w, -s, u))
    u, w, s, fresh = u[order], w[order], s[order], fresh[order]
    start = np.flatnonzero(np.r_[True, u[1:] != u[:-1]]) if len(u) else np.zeros(0, int)
    keep = np.arange(len(u)) - np.repeat(start, np.diff(np.r_[start, len(u)])) < k
    return u[keep], w[keep], s[keep], fresh[keep]


def _lists(nodes: np.ndarray, u: np.ndarray, *values: np.ndarray) -> list[pa.ListArray]:
    """For each node the values at its places in u; both are sorted."""
    offsets = pa.array(np.r_[np.searchsorted(u, nodes), len(u)].astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in values]


_LINKS = "p int, node bigint, code binary, ws array<bigint>, ss array<double>, fresh array<boolean>"


def _merged(k: int):
    """New lists of a part's nodes from their old ones and the links found."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("node")
        nodes = left.column("node").to_numpy()
        if not len(nodes):
            return left
        old = [left.column(c).combine_chunks() for c in ("ws", "ss", "fresh")]
        u = np.repeat(nodes, np.asarray(old[0].value_lengths().fill_null(0)))
        found = [right.column(c).combine_chunks() for c in ("ws", "ss")]
        v = np.repeat(right.column("u").to_numpy(), np.asarray(found[0].value_lengths()))
        w, s = (np.concatenate([a.flatten().to_numpy(zero_copy_only=False), b.flatten().to_numpy(zero_copy_only=False)]) for a, b in zip(old, found, strict=False))
        fresh = np.r_[np.zeros(len(u), bool), np.ones(len(v), bool)]
        u, w, s, fresh = _best(np.r_[u, v], w, s, fresh, k)
        return pa.Table.from_arrays([left.column("p"), left.column("node"), left.column("code"), *_lists(nodes, u, w, s, fresh)], names=left.column_names)

    return run


def _grouped(u, w, s, fresh, names) -> pa.RecordBatch:
    nodes = np.unique(u)
    return pa.RecordBatch.from_arrays([pa.array(nodes), *_lists(nodes, u, w, s)], names=names)


def _started(codes: DataFrame, width: int, n: int, s: Settings, parts: int) -> DataFrame:
    """(u, ws, ss): links within chunks of the random orders."""
    kind, whole = _kind(width), _whole(width)
    bits = max(1, min(24, (max(1, n // s.chunk)).bit_length()))
    planes = np.random.default_rng(s.seed).standard_normal((s.orders, width + 1, bits + 1)).astype(np.float32)

    def keys(batches):
        for b in batches:
            c = _flat_bytes(b.column(1), kind)
            x = np.concatenate([c["code"] * c["cut"][:, None], c["rest"][:, None]], axis=1).astype(np.float32)
            for t in range(s.orders):
                p = x @ planes[t]
                key = ((p[:, :bits] > 0) @ (1 << np.arange(bits))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), t, np.int32)), pa.array(key), pa.array(p[:, bits].astype(np.float64)), b.column(0), b.column(1)], names=["t", "key", "at", "node", "code"])

    def chunks(batches):
        for b in batches:
            ids, c = b.column(3).to_numpy(), _flat_bytes(b.column(4), kind)
            us, ws, ss = [], [], []
            for a in range(0, len(c), s.chunk):
                a = max(0, min(a, len(c) - s.chunk))  # the last chunk is full, too
                x, own = c[a : a + s.chunk], ids[a : a + s.chunk]
                flat = x["code"].astype(whole)
                dots = (flat @ flat.T) * (x["cut"][:, None] * x["cut"]) + x["rest"][:, None] * x["rest"]
                dots[own[:, None] == own[None, :]] = -np.inf  # a batch may hold the ends of two orders
                k = min(s.taken, len(own) - 1)
                if k < 1:
                    continue
                best = np.argpartition(-dots, k - 1, axis=1)[:, :k]
                us.append(np.repeat(own, k))
                ws.append(own[best].ravel())
                ss.append(np.take_along_axis(dots, best, 1).ravel())
            if us:
                u, w, d = np.concatenate(us), np.concatenate(ws), np.concatenate(ss)
                ok = np.isfinite(d)
                yield _grouped(*_best(u[ok], w[ok], d[ok], np.ones(int(ok.sum()), bool), s.taken), names=["u", "ws", "ss"])

    keyed = codes.mapInArrow(keys, "t int, key bigint, at double, node bigint, code binary")
    keyed = materialize(keyed, "orders")
    found = keyed.repartitionByRange(parts, "t", "key", "at").sortWithinPartitions("t", "key", "at", "node").mapInArrow(chunks, "u bigint, ws array<bigint>, ss array<double>")
    out = materialize(found, "started")
    remove(keyed)
    return out


def _improved(width: int, s: Settings):
    """Links found by comparing the members of each of a part's nodes with each other: the best of each u."""
    kind, whole = _kind(width), _whole(width)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = left.column("members").combine_chunks()
        v = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
        w, new = lists.flatten().field("w").to_numpy(), lists.flatten().field("fresh").to_numpy(zero_copy_only=False)
        order = np.lexsort((~new, w, v))
        v, w, new = v[order], w[order], new[order]
        first = np.r_[True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])][: len(v)]
        v, w, new = v[first], w[first], new[first]
        sizes = np.bincount(v, minlength=len(lists))
        ends = np.cumsum(sizes)
        ids = right.column("w").to_numpy()
        by_id = np.argsort(ids)
        at = by_id[np.searchsorted(ids[by_id], w)]
        data, least = _flat_bytes(right.column("code"), kind), right.column("least").to_numpy()
        some, found = 256, []
        for a in range(0, len(lists), some):
            many = sizes[a : a + some]
            n, m = len(many), int(many.max())
            row, col = np.repeat(np.arange(n), many), np.concatenate([np.arange(k) for k in many])
            span = slice(ends[a] - sizes[a], ends[a + n - 1])
            place, fresh = np.full((n, m), -1), np.zeros((n, m), bool)
            place[row, col], fresh[row, col] = at[span], new[span]
            code = np.zeros((n, m, width), whole)
            code[row, col] = data["code"][at[span]]
            cut, rest, low = (np.where(place >= 0, x[place], y) for x, y in ((data["cut"], 0.0), (data["rest"], 0.0), (least, np.inf)))
            dots = (code @ code.transpose(0, 2, 1)) * (cut[:, :, None] * cut[:, None, :]) + rest[:, :, None] * rest[:, None, :]
            ok = (fresh[:, :, None] | fresh[:, None, :]) & (place[:, None, :] >= 0) & (dots > low[:, :, None]) & (place[:, :, None] != place[:, None, :])
            g, i, j = np.nonzero(ok)
            if len(g):
                found.append(_best(ids[place[g, i]], ids[place[g, j]], dots[g, i, j], np.ones(len(g), bool), s.neighbours))
        if not found:
            return pa.Table.from_batches([], pa.schema([("u", pa.int64()), ("ws", pa.list_(pa.int64())), ("ss", pa.list_(pa.float64()))]))
        return pa.Table.from_batches([_grouped(*_best(*(np.concatenate(x) for x in zip(*found, strict=True)), s.neighbours), names=["u", "ws", "ss"])])

    return run


def _link_rows(state: DataFrame) -> DataFrame:
    """(v, w, s, fresh): the links of all nodes."""
    return state.select(F.col("node").alias("v"), F.explode(F.arrays_zip("ws", "ss", "fresh")).alias("x")).select("v", F.col("x.ws").alias("w"), F.col("x.ss").alias("s"), F.col("x.fresh").alias("fresh"))


def _reverse(links: DataFrame, most: int) -> DataFrame:
    """(v, w, fresh): for each node the nearest nodes whose neighbour it is."""
    back = Window.partitionBy("v").orderBy(F.desc("s"), "w")
    turned = links.select(F.col("w").alias("v"), F.col("v").alias("w"), "s", "fresh")
    return turned.withColumn("r", F.row_number().over(back)).where(F.col("r") <= most).select("v", "w", "fresh")


def graph(codes: DataFrame, width: int, n: int, parts: int, s: Settings = Settings()) -> DataFrame:
    """(p, node, code, ws, ss, fresh): at most `neighbours` links from each node, by its part."""
    none = "CAST(array() AS array<bigint>) ws", "CAST(array() AS array<double>) ss", "CAST(array() AS array<boolean>) fresh"
    state = codes.select(_part("node", parts).alias("p"), "node", "code").selectExpr("p", "node", "code", *none)
    found = _started(codes, width, n, s, parts)
    reverse = s.grown(s.reverse, n)
    while True:
        new = found.withColumn("to", _part("u", parts)).groupBy("to")
        old, state = state, materialize(state.groupBy("p").cogroup(new).applyInArrow(_merged(s.neighbours), _LINKS), "links")
        remove(old, found)
        if state.select(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] <= s.settled * s.neighbours * n:
            return state
        links = _link_rows(state)
        both = links.select("v", "w", "fresh").unionByName(_reverse(links, reverse))
        both = both.groupBy("v").agg(F.collect_list(F.struct("w", "fresh")).alias("members"), F.max("fresh").alias("any")).where("any")
        both = materialize(both.select(_part("v", parts).alias("p"), "v", "members"), "members")
        # A node with a full list takes only what is nearer than its last; others take anything.
        full = F.when(F.size("ss") >= s.neighbours, F.element_at("ss", -1)).otherwise(F.lit(-2.0))
        sent = both.select("p", F.explode("members.w").alias("w")).distinct().join(state.select(F.col("node").alias("w"), "code", full.alias("least")).hint("merge"), "w")
        found = both.groupBy("p").cogroup(sent.select(F.col("p").alias("to"), "w", "code", "least").groupBy("to")).applyInArrow(_improved(width, s), "u bigint, ws array<bigint>, ss array<double>")
        found = materialize(found, "found")
        remove(both)


def longest_of(codes: DataFrame, width: int, k: int) -> list:
    """(node, code) of the k longest: a query's best products may be with vectors that no graph by angle leads to."""
    kind = _kind(width)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_flat_bytes(b.column(1), kind)["rest"].copy())], names=["node", "code", "rest"])

    return codes.mapInArrow(run, "node bigint, code binary, rest double").orderBy("rest", "node").limit(k).collect()


_STATE = "query bigint, code binary, ids array<bigint>, scores array<double>, done array<boolean>"


def _begun(seeds: list, kind: np.dtype):
    """A query's first beam: its own node and the longest ones, scored; the added coordinate of a query counts as 0."""

    def run(batches):
        ids = np.array([i for i, _ in seeds], np.int64)
        some = np.frombuffer(b"".join(c for _, c in seeds), kind)
        turned, scale = some["code"].T.astype(np.int32), some["scale"]
        for b in batches:
            own = _flat_bytes(b.column(1), kind)
            q = own["code"].astype(np.int32)
            mine, met = (q * q).sum(axis=1) * own["scale"], (q @ turned) * scale
            out_i, out_s, out_d = [], [], []
            for row, node in enumerate(b.column(0).to_pylist()):
                other = ids != node
                i, x = np.append(ids[other], node), np.append(met[row][other], mine[row])
                order = np.lexsort((i, -x))
                out_i.append(i[order])
                out_s.append(x[order])
                out_d.append(np.zeros(len(i), bool))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out_i, pa.list_(pa.int64())), pa.array(out_s, pa.list_(pa.float64())), pa.array(out_d, pa.list_(pa.bool_()))], names=["query", "code", "ids", "scores", "done"])

    return run


def _linked(parts: int):
    """For each row (query, code, least, us) of a part all links of the us, which its nodes hold, by the parts of these."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("node")
        nodes, around = right.column("node").to_numpy(), right.column("around").combine_chunks()
        offsets, flat = np.asarray(around.offsets), around.values.to_numpy()
        to, rows, out = [], [], []
        for row, us in enumerate(left.column("us").combine_chunks()):
            at = np.searchsorted(nodes, us.values.to_numpy())
            ys = np.unique(np.concatenate([flat[offsets[i] : offsets[i + 1]] for i in at]))
            p = _parts_of(ys, parts)
            order = np.argsort(p, kind="stable")
            there, start = np.unique(p[order], return_index=True)
            to.append(there)
            rows += [row] * len(there)
            out += np.split(ys[order], start[1:]) if len(there) else []
        of = pa.array(rows, pa.int64())
        to = pa.array(np.concatenate(to) if to else [], pa.int32())
        return pa.Table.from_arrays([to, *(left.column(c).take(of) for c in ("query", "code", "least")), pa.array(out, pa.list_(pa.int64()))], names=["p", "query", "code", "least", "ys"])

    return run


def _scored(kind: np.dtype, whole: type):
    """(query, ys, scores) of a part: those of the nodes asked for that score above the query's least."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right, left = right.sort_by("node"), left.sort_by("query")
        nodes, data = right.column("node").to_numpy(), _flat_bytes(right.column("code"), kind)
        code = data["code"].astype(whole)
        queries, least, lists = left.column("query").to_numpy(), left.column("least").to_numpy(), left.column("ys").combine_chunks()
        asked = left.column("code")
        offsets, flat = np.asarray(lists.offsets), lists.values.to_numpy()
        out = [], [], []
        start = np.flatnonzero(np.r_[True, queries[1:] != queries[:-1]]) if len(queries) else []
        for a, z in zip(start, np.r_[start[1:], len(queries)] if len(queries) else [], strict=True):
            ys = np.unique(flat[offsets[a] : offsets[z]])
            at = np.searchsorted(nodes, ys)
            q = np.frombuffer(asked[int(a)].as_py(), kind)[0]["code"].astype(whole)
            scores = (code[at] @ q) * data["scale"][at]
            ok = scores > least[a]
            if ok.any():
                for o, x in zip(out, (int(queries[a]), ys[ok], scores[ok]), strict=True):
                    o.append(x)
        return pa.Table.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.list_(pa.float64()))], names=["query", "ys", "scores"])

    return run


def _step(beam: int, expanded: int):
    """Merge what was found into each query's beam; the candidates that were expanded are done."""

    def run(batches):
        for b in batches:
            out_i, out_s, out_d = [], [], []
            for row in range(b.num_rows):
                ids, scores, done = (b.column(c)[row].values.to_numpy(zero_copy_only=False) for c in (2, 3, 4))
                done = done | (np.cumsum(~done) <= expanded)
                ys, got = b.column(5)[row].values, b.column(6)[row].values
                if ys is not None and len(ys):
                    ys, got = (np.concatenate([x.to_numpy() for x in (z.values for z in many) if len(x)] or [np.zeros(0)]) for many in (ys, got))
                    new = ~np.isin(ys, ids)
                    ids, scores = np.concatenate([ids, ys[new].astype(np.int64)]), np.concatenate([scores, got[new]])
                    done = np.concatenate([done, np.zeros(int(new.sum()), bool)])
                order = np.lexsort((ids, -scores))[:beam]
                out_i.append(ids[order])
                out_s.append(scores[order])
                out_d.append(done[order])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out_i, pa.list_(pa.int64())), pa.array(out_s, pa.list_(pa.float64())), pa.array(out_d, pa.list_(pa.bool_()))], names=["query", "code", "ids", "scores", "done"])

    return run


def search(nodes: DataFrame, starts: DataFrame, width: int, n: int, parts: int, s: Settings = Settings()) -> DataFrame:
    """(query, ids): for each node in starts (column query) the nearest nodes met, itself included. nodes is what graph returns."""
    kind, beam = _kind(width), s.grown(s.beam, n)
    seeds = [(r["node"], bytes(r["code"])) for r in longest_of(nodes.select("node", "code"), width, s.longest)]
    links = _link_rows(nodes)
    around = links.select("v", "w").unionByName(_reverse(links, s.grown(s.reverse, n)).select("v", "w")).groupBy("v").agg(F.collect_set("w").alias("around"))
    held = nodes.join(around.hint("merge"), nodes["node"] == around["v"], "left").select(F.col("p").alias("at"), "node", "code", F.coalesce("around", F.array().cast("array<bigint>")).alias("around"))
    # Kept by part, so that a step moves only what is asked; what a lost executor held is computed again.
    held = held.repartition(min(parts, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "at").persist()
    state = nodes.join(starts, nodes["node"] == starts["query"], "left_semi").select(F.col("node").alias("query"), "code").mapInArrow(_begun(seeds, kind), _STATE)
    state = materialize(state, "state")
    by_part = held.select("at", "node", "code").groupBy("at")
    while True:
        wanted = F.slice(F.filter(F.arrays_zip("ids", "done"), lambda x: ~x["done"]), 1, s.expanded)
        least = F.when(F.size("scores") >= beam, F.element_at("scores", -1)).otherwise(F.lit(float("-inf")))
        open_ = state.select("query", "code", least.alias("least"), F.explode(wanted).alias("x")).select("query", "code", "least", F.col("x.ids").alias("u"))
        if open_.isEmpty():
            held.unpersist()
            return state.select("query", F.slice("ids", 1, s.rescored).alias("ids"))
        asked = open_.groupBy(_part("u", parts).alias("p"), "query", "code", "least").agg(F.collect_list("u").alias("us"))
        met = asked.groupBy("p").cogroup(held.select("at", "node", "around").groupBy("at")).applyInArrow(_linked(parts), "p int, query bigint, code binary, least double, ys array<bigint>")
        found = met.groupBy("p").cogroup(by_part).applyInArrow(_scored(kind, _whole(width)), "query bigint, ys array<bigint>, scores array<double>")
        found = found.groupBy("query").agg(F.collect_list(F.struct("ys", "scores")).alias("x")).select(F.col("query").alias("of"), F.col("x.ys").alias("ys"), F.col("x.scores").alias("got"))
        old = state
        joined = state.join(found, state["query"] == found["of"], "left").select("query", "code", "ids", "scores", "done", "ys", "got")
        state = materialize(joined.mapInArrow(_step(beam, s.expanded), _STATE), "state")
        remove(old)


def nearest(table: DataFrame, k: int = 20, every: int = 20, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by `every` its k nearest other rows found (all, if fewer).

    Null, zero and non-finite vectors and rows without id take no part. Vectors of different lengths have no product: each length is searched by
    itself. An id with several vectors asks with each and is found by each; its own rows are not among its candidates. Rows equal in id
    and vector are one. Of equal vectors each node carries its k + m smallest ids (m: the most vectors that an id has), which are all
    that a list of k can show. An empty table gives no rows.
    """
    rows = materialize(usable(table, id_col, vector_col), "vectors")
    widths = [r[0] for r in rows.select(F.size("vector")).distinct().limit(1000).collect()]
    if len(widths) > 999:
        raise ValueError("vectors of a thousand lengths or more")
    if not widths:
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    same = rows.groupBy("vec_id").count().agg(F.max("count")).first()[0]
    return reduce(DataFrame.unionByName, [_nearest(rows.where(F.size("vector") == w), w, k, k + same, every, settings) for w in sorted(widths)])


def _nearest(rows: DataFrame, width: int, k: int, most: int, every: int, s: Settings) -> DataFrame:
    """The answers for vectors of one length; most: so many rows of a node can show in a list."""
    s = replace(s, rescored=max(s.rescored, 2 * most), beam=max(s.beam, 3 * most))  # long lists need more to choose from
    nodes = rows.groupBy("vector").agg(F.min("vec_id").alias("least"))
    if most > k + 1:  # an id with several vectors may be the least of several nodes
        order = F.row_number().over(Window.partitionBy("least").orderBy("vector"))
        nodes = nodes.withColumn("r", order).withColumn("node", F.when(F.col("r") == 1, F.col("least")).otherwise(F.xxhash64("least", "r")))
    else:
        nodes = nodes.withColumn("node", F.col("least"))
    nodes = materialize(nodes.select("vector", "node", _norm("vector").alias("norm")), "nodes")
    n = nodes.count()
    if most > k + 1 and nodes.select("node").distinct().count() < n:
        raise ValueError("two vectors have one key: renumber the ids that repeat")
    usual = min(r[0] for r in nodes.select("norm").orderBy(F.desc("norm")).limit(s.longest).collect())
    parts = part_count(n, width, s)
    members = materialize(rows.join(nodes.hint("merge"), "vector").select("node", "vec_id"), "members")
    codes = materialize(_quantised(nodes, width, usual), "codes")
    linked = graph(codes, width, n, parts, s)
    asked = members.where(F.col("vec_id") % every == 0)
    got = search(linked, asked.select(F.col("node").alias("query")).distinct(), width, n, parts, s)
    got = materialize(got.select("query", F.explode("ids").alias("node")), "found")
    remove(codes, linked)
    vectors = got.join(nodes.select("node", "vector").hint("merge"), "node").join(nodes.select(F.col("node").alias("query"), F.col("vector").alias("asked")).hint("merge"), "query")
    score = F.aggregate(F.zip_with("vector", "asked", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = vectors.select("query", "node", score.alias("score"))
    few = members.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))).where(F.col("r") <= most).drop("r")
    listed = scored.join(few.hint("merge"), "node").withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= most)
    lists = listed.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("list"))
    answers = asked.select(F.col("node").alias("query"), F.col("vec_id").alias("query_id")).join(lists, "query")
    answers = answers.select("query_id", F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("list"))
    return answers.select("query_id", F.posexplode("list").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")

"""WARC archives: writing, and reading back by boundary-chain verification.

A record begins with its version line, but so may a part of a payload. Tasks read an archive cut at every version line (a candidate each), in
byte order within their split, and emit for each candidate its offset and its successor's: the end of the block that its header announces. A
task follows chains inside segments of SEGMENT bytes at once, so that it holds one segment's candidates, and emits where each candidate
leaves its segment. Pointer jumping over these exits, from the start of each file, finds the true entry of every segment in as many rounds as
the logarithm of a file's segments; candidates on the chain from there are records, all others are parts of payloads and are put back into the
block they lie in.

Of pages with equal payloads that with the smallest id becomes a response, the others revisit it. Revisits need no payload, and are made from ids and
digests alone. Which pages are revisits is told to the pages by a table of bits of a fixed size; only pages whose bit is set, revisits and a few
others, are shuffled with their payload, by digest and id, so that a payload that very many pages have is no hot key.
"""

from __future__ import annotations

import base64
import hashlib
import re
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, fresh_path, map_columns, materialize, remove, text_of

MAGIC = "WARC/1.1\r\n"
END = b"\r\n\r\n"
SEGMENT = 1 << 20
#: Bits of the table that tells pages which may be revisits; 64 to a row.
BITS = 1 << 24
_CLEAN = re.compile(r"[\x00-\x20\x7f]+")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id, payload_digest: str) -> str:
    return f"urn:x-page:{'null-' + payload_digest if page_id is None else quote(page_id, safe='') if isinstance(page_id, str) else page_id}"


def _record(page_id, url: str, payload_digest: str, length: int, payload: bytes | None, refers=None) -> bytes:
    """One record without its version line and closing line ends; a revisit of the page `refers` if there is no payload."""
    block = b"" if payload is None else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    lines = [
        f"WARC-Type: {'revisit' if payload is None else 'response'}",
        f"WARC-Record-ID: <{_name(page_id, payload_digest)}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Target-URI: {_CLEAN.sub('%20', url)}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"WARC-Payload-Length: {length}",
    ]
    if payload is None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_name(refers, payload_digest)}>"]
    else:
        lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + END + block


def _responses(ids, urls, texts):
    out = []
    for i, u, t in zip(*(c.to_pylist() for c in (ids, urls, texts)), strict=True):
        payload = (t or "").encode()
        out.append(MAGIC + _record(i, u or "", digest(payload), len(payload), payload).decode())
    return [out]


def _revisits(ids, urls, hashes, lengths, firsts):
    rows = zip(*(c.to_pylist() for c in (ids, urls, hashes, lengths, firsts)), strict=True)
    return [[MAGIC + _record(i, u or "", base64.b32encode(bytes.fromhex(h)).decode(), n, None, f).decode() for i, u, h, n, f in rows]]


def write(pages: DataFrame, path: str, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", compression: str = "none") -> None:
    """Write one record for each row of pages to archives below path, one for each task; ids are whole numbers or strings.

    Null html counts as empty. Rows that share the smallest id of their payload are all responses; a null id is greater than any other, so
    that rows with null ids are responses only where no row has an id. Payloads shorter than `least` bytes are all responses. Archives are
    plain files, read in many splits; with compression="gzip" each is one split.
    """
    kind = pages.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType | T.StringType):
        raise TypeError(f"page ids must be whole numbers or strings, not {kind.simpleString()}")
    html = F.coalesce(text_of(pages, html_col), F.lit(""))
    base = pages.select(F.col(id_col).alias("id"), text_of(pages, url_col).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("hash"))
    ids = materialize(base.select("id", "url", "hash", F.octet_length("html").cast("bigint").alias("bytes")), "digests")
    shared = ids.where(F.col("bytes") >= least).groupBy("hash").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n")
    again = materialize(ids.join(shared.hint("merge"), "hash").where(~F.col("id").eqNullSafe(F.col("first"))), "revisits")
    bit = F.pmod(F.xxhash64("hash", "id"), F.lit(BITS))
    of = F.shiftright(bit, 6)
    made = map_columns(again, [], [F.col(c) for c in ("id", "url", "hash", "bytes", "first")], {"value": "string"}, _revisits)
    flags = again.groupBy(of.alias("of")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(hash, id), {BITS}L) % 64 AS int))")).alias("bits"))
    flagged = base.withColumn("of", of).join(F.broadcast(materialize(flags, "bits")), "of", "left")  # at most BITS / 64 rows
    maybe = F.coalesce(F.expr(f"shiftrightunsigned(bits, CAST(pmod(xxhash64(hash, id), {BITS}L) % 64 AS int)) & 1L"), F.lit(0)) == 1
    parts = [flagged.where(~maybe)]
    if not again.isEmpty():
        known = again.select(F.col("hash").alias("h"), F.col("id").alias("i")).distinct()
        parts.append(flagged.where(maybe).join(known.hint("merge"), (F.col("hash") == F.col("h")) & F.col("id").eqNullSafe(F.col("i")), "left_anti"))
    for part in parts:
        made = made.unionByName(map_columns(part, [], [F.col("id"), F.col("url"), F.col("html")], {"value": "string"}, _responses))
    made.write.option("lineSep", END.decode()).option("compression", compression).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """Archives cut at every version line: (file, split, value), in byte order within a split's task."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", MAGIC).text(path).select(meta.file_path.alias("file"), meta.file_block_start.alias("split"), F.col("value").cast("binary").alias("value"))


_LENGTH = re.compile(rb"(?i)\r\nContent-Length:[ \t]*([0-9]+)[ \t]*(?:\r\n|\Z)")


def _extent(chunk: bytes) -> int:
    """Bytes from behind the version line to the record's end, closing line ends included; 0 if this is no header."""
    end = chunk.find(END)
    if end < 0 or not chunk.startswith(b"WARC-"):
        return 0
    m = _LENGTH.search(b"\r\n" + chunk[:end])
    return end + 4 + int(m[1]) + 4 if m else 0


def _walk(batches):
    """For each batch of chunks: files, splits, offsets within the split's own bytes, values."""
    now, at = None, 0
    for b in batches:
        files, splits, values = (c.to_pylist() for c in b.columns)
        places = []
        for f, s, v in zip(files, splits, values, strict=True):
            if (f, s) != now:
                now, at = (f, s), 0
            places.append(at)
            at += len(v) + len(MAGIC)
        yield files, splits, places, values, b


def _placed(batches):
    for _, _, places, _, b in _walk(batches):
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(places, pa.int64()), b.column(2)], names=["file", "split", "at", "value"])


_CANDIDATES = "file string, split bigint, segment bigint, at bigint, jump bigint, length bigint, leaves bigint"


def _candidates(segment: int):
    """For each candidate: its segment, its offset in the split, its successor's, the bytes of its piece, and where its chain leaves the segment (-1: it ends)."""

    def close(now, held):
        end = held[-1][0] + held[-1][2]
        leaves: dict[int, int] = {}
        for at, to, _ in reversed(held):
            leaves[at] = -1 if to < 0 else to if to >= end else leaves.get(to, -1)
        n = len(held)
        cols = [*([x] * n for x in now), *map(list, zip(*held, strict=True)), [leaves[x[0]] for x in held]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string()] + [pa.int64()] * 6, strict=True)], names=["file", "split", "segment", "at", "jump", "length", "leaves"])

    def run(batches):
        now, held = None, []
        for files, splits, places, values, _ in _walk(batches):
            for f, s, at, v in zip(files, splits, places, values, strict=True):
                if (f, s, at // segment) != now:
                    if held:
                        yield close(now, held)
                    now, held = (f, s, at // segment), []
                x = _extent(v)
                held.append((at, at + x + len(MAGIC) if x else -1, len(v) + len(MAGIC)))
        if held:
            yield close(now, held)

    return run


def _owned(segment: pa.Table) -> pa.Table:
    """For each candidate of a segment the record that it begins or lies in, from the segment's entry on; -1 before the entry."""
    segment = segment.sort_by("at")
    ats, jumps, entry = segment.column("at").to_pylist(), segment.column("jump").to_pylist(), segment.column("entry")[0].as_py()
    owner, next_record, out = -1, -1 if entry is None else entry, []
    for at, to in zip(ats, jumps, strict=True):
        if at == next_record:
            owner, next_record = at, to
        out.append(owner)
    return segment.select(["file", "split", "segment", "at"]).append_column("owner", pa.array(out, pa.int64()))


def reachable(start: DataFrame, hops: DataFrame, most: int) -> DataFrame:
    """(file, pos) of all that the start of each file leads to, by pointer jumping: after each round all within twice as many hops are reached."""
    reached, far = materialize(start, "reached"), 1
    while far < most:
        old, step = reached, reached.join(hops.hint("merge"), ["file", "pos"]).select("file", F.col("to").alias("pos"))
        reached = materialize(reached.unionByName(step).distinct(), "reached")
        remove(old)
        far *= 2
        if far < most:
            old, on = hops, hops.select("file", F.col("pos").alias("to"), F.col("to").alias("next"))
            hops = materialize(hops.join(on.hint("merge"), ["file", "to"]).select("file", "pos", F.col("next").alias("to")), "hops")
            remove(old)
    return reached


def owners(spark: SparkSession, path: str, segment: int = SEGMENT) -> DataFrame:
    """(file, split, at, record): for each piece of an archive the offset in the file of the record that it belongs to."""
    here = ["file", "split", "segment"]
    cand = materialize(_chunks(spark, path).mapInArrow(_candidates(segment), _CANDIDATES), "candidates")
    order = Window.partitionBy("file").orderBy("split", "segment")  # a file's segments, of 1 MB each
    segments = cand.groupBy(here).agg(F.sum("length").alias("bytes"), F.min("at").alias("first"))
    segments = segments.withColumn("base", F.sum("bytes").over(order) - F.col("bytes") - F.col("first"))  # of the split
    segments = materialize(segments.withColumn("place", F.row_number().over(order)), "segments")
    most = segments.agg(F.max("place")).first()[0] or 0
    nodes = cand.join(segments.hint("merge"), here).select(*here, (F.col("base") + F.col("at")).alias("pos"), F.when(F.col("leaves") >= 0, F.col("base") + F.col("leaves")).alias("to"))
    start = segments.where("place = 1").select("file", F.lit(len(MAGIC)).cast("bigint").alias("pos"))
    ends = nodes.where("to IS NOT NULL").select("file", F.col("to").alias("pos")).unionByName(start).distinct()
    hops = materialize(nodes.where("to IS NOT NULL").select("file", "pos", "to").join(ends.hint("merge"), ["file", "pos"], "left_semi"), "hops")
    reached = reachable(start, hops, most)
    entries = nodes.join(reached.hint("merge"), ["file", "pos"]).join(segments.select(*here, "base").hint("merge"), here)
    entries = entries.groupBy(here).agg(F.min(F.col("pos") - F.col("base")).alias("entry"))
    given = cand.select(*here, "at", "jump").join(entries.hint("merge"), here, "left")
    own = materialize(given.groupBy(here).applyInArrow(_owned, "file string, split bigint, segment bigint, at bigint, owner bigint"), "owners")
    # Pieces before a segment's entry belong to the last record of the segments before.
    last = segments.join(own.groupBy(here).agg(F.max("owner").alias("last")).hint("merge"), here)
    last = last.withColumn("last", F.when(F.col("last") >= 0, F.col("base") + F.col("last")))
    carried = last.select(*here, "base", F.last("last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    found = own.join(carried.hint("merge"), here).select("file", "split", "at", F.when(F.col("owner") >= 0, F.col("base") + F.col("owner")).otherwise(F.col("carried")).alias("record"))
    return found.where("record IS NOT NULL")


def _fields(v: bytes, named) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of a record's bytes behind the version line."""
    end = v.find(END)
    head = dict(line.split(": ", 1) for line in v[:end].decode().split("\r\n"))
    block = v[end + 4 : end + 4 + int(head["Content-Length"])]
    kind = head["WARC-Type"]
    payload = block[block.find(END) + 4 :] if kind == "response" else None
    page = lambda x: None if x is None or ":null-" in x else named(x[1:-1].rpartition(":")[2])
    length = int(head["WARC-Payload-Length"]) if payload is None else len(payload)
    hashed = head["WARC-Payload-Digest"].removeprefix("sha1:") if payload is None else digest(payload)
    return page(head["WARC-Record-ID"]), length, hashed, kind, page(head.get("WARC-Refers-To"))


def _tried(v: bytes, named) -> tuple:
    """The fields and no fault, or the fault alone."""
    try:
        return *_fields(v, named), None
    except (KeyError, ValueError) as e:
        return *(None,) * 5, f"no record of this library: {e!r}"


def _parsed(values, named):
    return [list(x) for x in zip(*(_tried(v, named) for v in as_bytes(values)), strict=True)]


def _made(id_type: str) -> dict[str, str]:
    return {"page_id": id_type, "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": id_type, "fault": "string"}


def _parsed_pieces(named, ids: pa.DataType):
    """Pieces that hold all that their header announces, parsed where they are read; others have a fault, which counts only if they are records."""
    types = [ids, pa.int64(), pa.string(), pa.string(), ids, pa.string()]

    def run(batches):
        for _, _, places, values, b in _walk(batches):
            rows = [_tried(v, named) if 0 < _extent(v) <= len(v) else (*(None,) * 5, "a record is cut short") for v in values]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(places, pa.int64()), *(pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=["file", "split", "at", *_made("")])

    return run


def records(spark: SparkSession, path: str, of: DataFrame | None = None) -> DataFrame:
    """(file, record, value): every record of the archives below path, or those of the pieces given (see owners), value being its bytes behind the version line.

    Records whose payload holds version lines are put together from their pieces, across splits too; a piece is never taken for a record.
    """
    of = owners(spark, path) if of is None else of
    pieces = _chunks(spark, path).mapInArrow(_placed, "file string, split bigint, at bigint, value binary").join(of.hint("merge"), ["file", "split", "at"])
    whole = pieces.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("split", "at", "value"))).alias("parts"))
    joined = F.when(F.size("parts") == 1, F.col("parts")[0]["value"]).otherwise(F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["value"])), MAGIC.encode().hex())))
    return whole.select("file", "record", joined.alias("value"))


def read(spark: SparkSession, path: str, id_type: str = "bigint", segment: int = SEGMENT) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record; of a response both are computed from the payload read, of a revisit they are those of its header.

    Records of one piece are parsed by the tasks that read them, and only these columns meet the chain's verdict; the bytes of records in
    several pieces are brought together. id_type is the ids' type (a whole number's or string); a record that cannot be read raises an error.
    """
    named, ids = (unquote, pa.string()) if id_type == "string" else (int, pa.int64())
    wide = "string" if id_type == "string" else "bigint"
    own = owners(spark, path, segment)
    own = materialize(own.join(own.groupBy("file", "record").agg(F.count("*").alias("pieces")).hint("merge"), ["file", "record"]), "records")
    made = _made(wide)
    parsed = _chunks(spark, path).mapInArrow(_parsed_pieces(named, ids), "file string, split bigint, at bigint, " + ", ".join(f"{k} {t}" for k, t in made.items()))
    got = parsed.join(own.where("pieces = 1").hint("merge"), ["file", "split", "at"]).select(*made)
    several = own.where("pieces > 1").drop("pieces")
    if not several.isEmpty():
        got = got.unionByName(map_columns(records(spark, path, several), [], [F.col("value")], made, _parsed, named=named))
    kind = F.when(F.col("fault").isNull(), F.col("record_type")).otherwise(F.raise_error(F.col("fault")).cast("string"))
    return got.select(F.col("page_id").cast(id_type), "payload_bytes", "payload_digest", kind.alias("record_type"), F.col("refers_to").cast(id_type))


def round_trip(pages: DataFrame, segment: int = SEGMENT, **options) -> DataFrame:
    """Write pages to archives in the shared folder and read them back."""
    path = fresh_path(pages.sparkSession, "warc")
    write(pages, path, **options)
    return read(pages.sparkSession, path, pages.schema[options.get("id_col", "page_id")].dataType.simpleString(), segment)

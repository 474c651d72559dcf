"""Media columns: Matroska files as byte columns, and their packets as rows.

Writing lays a payload as 8-bit PCM into packets of PACKET samples (24 ms at 8 kHz each), packets by lacing into SimpleBlocks, blocks into
clusters, with cues for the clusters. Reading walks variable-length EBML elements of any layout that the format allows: unknown sizes, any
lacing, block groups, elements it doesn't know; a broken file gives the packets before the break.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, map_columns, text_of

# Fixed values of the format: element ids.
EBML, SEGMENT, INFO, TRACKS, TRACK, AUDIO, CLUSTER, CUES, CUE, CUE_AT, GROUP = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0xAE, 0xE1, 0x1F43B675, 0x1C53BB6B, 0xBB, 0xB7, 0xA0
SCALE, DURATION, CLUSTER_TIME, SIMPLE_BLOCK, BLOCK, CUE_TIME, CUE_TRACK, CUE_POSITION = 0x2AD7B1, 0x4489, 0xE7, 0xA3, 0xA1, 0xB3, 0xF7, 0xF1
TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC, FRAME_NS, RATE, CHANNELS, DEPTH = 0xD7, 0x73C5, 0x83, 0x86, 0x23E383, 0xB5, 0x9F, 0x6264
MASTERS = frozenset([SEGMENT, INFO, TRACKS, TRACK, AUDIO, CLUSTER, CUES, CUE, CUE_AT, GROUP, EBML])
TOP = frozenset([CLUSTER, CUES, INFO, TRACKS, 0x114D9B74, 0x1254C367, 0x1043A770, 0x1941A469])

PACKET, SAMPLES_A_SECOND = 192, 8000
PACKET_MS = PACKET * 1000 // SAMPLES_A_SECOND
BLOCK_PACKETS, CLUSTER_PACKETS = 16, 512
#: Bytes of text that a worker has before it as Python objects, with their files and payloads.
MOST_BYTES = 1 << 20
LACINGS = ("none", "xiph", "fixed", "ebml")


def _id(n: int) -> bytes:
    return n.to_bytes((n.bit_length() + 7) // 8, "big")


def _size(n: int) -> bytes:
    k = 1
    while n >= (1 << 7 * k) - 1:  # all ones mean an unknown size
        k += 1
    return (n | 1 << 7 * k).to_bytes(k, "big")


def element(n: int, *body: bytes) -> bytes:
    joined = b"".join(body)
    return _id(n) + _size(len(joined)) + joined


def _uint(n: int, value: int) -> bytes:
    return element(n, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def _float(n: int, value: float) -> bytes:
    return element(n, struct.pack(">d", value))


def lace(frames: list[bytes], kind: str) -> tuple[int, bytes]:
    """Flag bits and body of a block's frames."""
    if len(frames) == 1 or kind == "none":
        return 0, frames[0]
    head = bytes([len(frames) - 1])
    sizes = list(map(len, frames))
    if kind == "fixed" and len(set(sizes)) == 1:
        return 0x04, head + b"".join(frames)
    if kind == "xiph":
        return 0x02, head + b"".join(b"\xff" * (s // 255) + bytes([s % 255]) for s in sizes[:-1]) + b"".join(frames)
    out = [_size(sizes[0])]
    for a, b in zip(sizes, sizes[1:-1], strict=False):
        k = 1
        while not -(1 << 7 * k - 1) < b - a < (1 << 7 * k - 1):
            k += 1
        out.append((b - a + (1 << 7 * k - 1) - 1 | 1 << 7 * k).to_bytes(k, "big"))
    return 0x06, head + b"".join(out) + b"".join(frames)


def mux(payload: bytes, lacing: str = "fixed", packet: int = PACKET) -> bytes:
    """A Matroska file of one track of 8-bit PCM samples."""
    frames = [payload[i : i + packet] for i in range(0, len(payload), packet)]
    ms = packet * 1000 // SAMPLES_A_SECOND
    info = element(INFO, _uint(SCALE, 1_000_000), _float(DURATION, len(frames) * ms), element(0x4D80, b"sigweave"), element(0x5741, b"sigweave"))
    audio = element(AUDIO, _float(RATE, SAMPLES_A_SECOND), _uint(CHANNELS, 1), _uint(DEPTH, 8))
    tracks = element(TRACKS, element(TRACK, _uint(TRACK_NUMBER, 1), _uint(TRACK_UID, 1), _uint(TRACK_TYPE, 2), element(CODEC, b"A_PCM/INT/LIT"), _uint(FRAME_NS, ms * 1_000_000), audio))
    body, at, cues = [info, tracks], len(info) + len(tracks), []
    per_block = 1 if lacing == "none" else BLOCK_PACKETS
    for first in range(0, len(frames), CLUSTER_PACKETS):
        blocks = []
        for i in range(first, min(first + CLUSTER_PACKETS, len(frames)), per_block):
            some = frames[i : min(i + per_block, first + CLUSTER_PACKETS)]
            flags, laced = lace(some, lacing)
            blocks.append(element(SIMPLE_BLOCK, b"\x81", struct.pack(">hB", (i - first) * ms, 0x80 | flags), laced))
        cluster = element(CLUSTER, _uint(CLUSTER_TIME, first * ms), *blocks)
        cues.append(element(CUE, _uint(CUE_TIME, first * ms), element(CUE_AT, _uint(CUE_TRACK, 1), _uint(CUE_POSITION, at))))
        body.append(cluster)
        at += len(cluster)
    head = element(EBML, _uint(0x4286, 1), _uint(0x42F7, 1), _uint(0x42F2, 4), _uint(0x42F3, 8), element(0x4282, b"matroska"), _uint(0x4287, 4), _uint(0x4285, 2))
    return head + element(SEGMENT, *body, element(CUES, *cues))


@dataclass
class Media:
    """(track, timestamp in ns, offset, length, cluster, keyframe) of each packet; (time in ns, track, offset of the cluster) of each cue."""

    packets: list[tuple[int, int, int, int, int, bool]] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)
    clusters: list[int] = field(default_factory=list)
    tracks: dict[int, dict] = field(default_factory=dict)
    scale: int = 1_000_000
    duration: float = 0.0
    whole: bool = True


def _vint(data: bytes, at: int, keep_mark: bool) -> tuple[int, int]:
    """A variable-length number and the offset behind it; -1 stands for an unknown size."""
    first = data[at]
    if not first:
        raise ValueError("a number of over eight bytes")
    k = 9 - first.bit_length()
    if at + k > len(data):
        raise ValueError("cut off")
    n = int.from_bytes(data[at : at + k], "big")
    if keep_mark:
        return n, at + k
    n &= (1 << 7 * k) - 1
    return (-1 if n == (1 << 7 * k) - 1 else n), at + k


def _frames(data: bytes, at: int, end: int, flags: int) -> list[tuple[int, int]]:
    """(offset, length) of a block's frames."""
    kind = flags >> 1 & 3
    if not kind:
        return [(at, end - at)]
    n, at = data[at] + 1, at + 1
    if kind == 2:
        size, rest = divmod(end - at, n)
        if rest:
            raise ValueError("frames of unequal size in fixed lacing")
        return [(at + i * size, size) for i in range(n)]
    sizes: list[int] = []
    for i in range(n - 1):
        if kind == 1:
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            size, at = size + data[at], at + 1
        else:
            raw, after = _vint(data, at, False)
            size = raw if not i else sizes[-1] + raw - ((1 << 7 * (after - at) - 1) - 1)
            at = after
        sizes.append(size)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("lacing beyond the block")
    out = []
    for size in sizes:
        out.append((at, size))
        at += size
    return out


def demux(data: bytes) -> Media:
    """Packets, cues and tracks of a Matroska file; whole is False if it broke off, and what came before is kept."""
    media, size = Media(), len(data)
    segment = time = 0
    track: dict = {}
    cue: list[int] = [0, 0, 0]
    stack: list[tuple[int, int]] = []  # open masters with their ends
    at = 0
    try:
        while at < size:
            while stack and at >= stack[-1][1] >= 0:
                stack.pop()
            n, at = _vint(data, at, True)
            length, at = _vint(data, at, False)
            while stack and stack[-1][1] == -1 and (n in TOP and stack[-1][0] not in (SEGMENT,) or n in (SEGMENT, EBML)):
                stack.pop()  # an element of unknown size ends where one begins that it can't hold
            if n in MASTERS:
                stack.append((n, at + length if length >= 0 else -1))
                if n == SEGMENT:
                    segment = at
                elif n == CLUSTER:
                    media.clusters.append(at - segment)
                    time = 0
                elif n == TRACK:
                    track = {}
                elif n == CUE:
                    cue = [0, 0, 0]
                continue
            if length < 0 or at + length > size:
                raise ValueError("cut off")
            end = at + length
            if n in (SIMPLE_BLOCK, BLOCK):
                number, p = _vint(data, at, False)
                shift, flags = struct.unpack_from(">hB", data, p)
                whole = n == BLOCK or bool(flags & 0x80)  # a frame that can be read by itself
                frame_ns = media.tracks.get(number, {}).get(FRAME_NS, 0)
                base = (time + shift) * media.scale
                for i, (a, k) in enumerate(_frames(data, p + 3, end, flags)):
                    media.packets.append((number, base + i * frame_ns, a, k, len(media.clusters), whole))
            elif n in (CLUSTER_TIME, SCALE, CUE_TIME, CUE_TRACK, CUE_POSITION, TRACK_NUMBER, TRACK_TYPE, FRAME_NS, CHANNELS, DEPTH):
                value = int.from_bytes(data[at:end], "big")
                if n == CLUSTER_TIME:
                    time = value
                elif n == SCALE:
                    media.scale = value
                elif n == CUE_TIME:
                    cue[0] = value
                elif n == CUE_TRACK:
                    cue[1] = value
                elif n == CUE_POSITION:
                    media.cues.append((cue[0] * media.scale, cue[1], value))
                else:
                    track[n] = value
                    if TRACK_NUMBER in track:
                        media.tracks[track[TRACK_NUMBER]] = track
            elif n in (DURATION, RATE):
                value = struct.unpack(">d" if length == 8 else ">f", data[at:end])[0]
                if n == DURATION:
                    media.duration = value
                else:
                    track[n] = value
            at = end
    except (ValueError, IndexError, struct.error):
        media.whole = False
    return media


def padded(text: bytes, unit: int = PACKET) -> bytes:
    """The text and spaces up to a positive multiple of unit."""
    return text + b" " * (-len(text) % unit if text else unit)


def read_back(media_file: bytes) -> tuple[bytes, Media]:
    media = demux(media_file)
    return b"".join([media_file[a : a + k] for _, _, a, k, _, _ in media.packets]), media


def feature(payload: bytes, media: Media) -> str:
    """Counts of the container, and the samples' sum, sum of squares and changes of side around 128."""
    samples = np.frombuffer(payload, np.uint8).astype(np.int64)
    turns = int(np.count_nonzero(np.diff(samples >= 128)))
    last = media.packets[-1][1] // 1_000_000 + PACKET_MS if media.packets else 0
    return f"packets={len(media.packets)};clusters={len(media.clusters)};cues={len(media.cues)};ms={last};sum={samples.sum()};squares={(samples * samples).sum()};turns={turns}"


def _store(texts):
    return [[mux(padded(t)) for t in as_bytes(texts)]]


def store(docs: DataFrame, keep: list, text_col: str = "text") -> DataFrame:
    """Columns keep and media: the text's bytes as a Matroska file. Null text counts as empty, whose payload is one packet of spaces."""
    return map_columns(docs, keep, [text_of(docs, text_col)], {"media": "binary"}, _store, most_bytes=MOST_BYTES)


def packets(media: DataFrame, keep: list, media_col: str = "media") -> DataFrame:
    """A row for each packet: columns keep, packet (from 0), track, timestamp_ns, offset, length, cluster (from 1), keyframe. Null and broken files give the packets that they hold."""
    source = media.select(*keep, F.col(media_col).alias("__sigweave_media"))
    made = T.StructType.fromDDL("packet bigint, track bigint, timestamp_ns bigint, offset bigint, length bigint, cluster bigint, keyframe boolean").fields
    schema = T.StructType(source.schema.fields[:-1] + made)

    def run(batches):
        for b in batches:
            rows, out = [], [[] for _ in made]
            for i, data in enumerate(b.column(b.num_columns - 1).to_pylist()):
                for j, p in enumerate(demux(data or b"").packets):
                    rows.append(i)
                    for o, v in zip(out, (j, *p), strict=True):
                        o.append(v)
            take = pa.array(rows, pa.int64())
            kept = [c.take(take) for c in b.columns[:-1]]
            yield pa.RecordBatch.from_arrays(kept + [pa.array(o, pa.bool_() if f.name == "keyframe" else pa.int64()) for o, f in zip(out, made, strict=True)], names=schema.names)

    return source.mapInArrow(run, schema)


def _digests(texts):
    out: list[list] = [[] for _ in range(7)]
    for t, m in zip(as_bytes(texts), _store(texts)[0], strict=True):
        payload, got = read_back(m)
        row = (len(t), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(m), hashlib.sha256(m).hexdigest(), feature(payload, got))
        for o, v in zip(out, row, strict=True):
            o.append(v)
    return out


def digests(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, sizes and digests of the payload read back and of the stored file, and the feature, for every row of docs.

    A file is written and read back by the same task, a slice of rows at a time; a table of files is what store gives.
    """
    made = {"n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string"}
    return map_columns(docs, ["doc_id"], [text_of(docs, text_col)], made, _digests, most_bytes=MOST_BYTES)

"""BPE encoding and decoding by a table of distinct words.

Texts are split into words (the pre-tokens of the tokenizer) block by block; a block's documents become lists of positions in the block's own
word list. A word's hash gives it one home partition, where the lists of all blocks meet and each distinct word is encoded once; its
ids go back to the blocks, and documents and ids of a block are joined by the block's id and the position. The pieces of a decoded text
come from a join of the block's ids with the vocabulary. A block holds a bounded amount of text, so no task's memory grows with the input, no
word list is broadcast, and lists travel compressed: a byte or two for each word of a text.

The tokenizer has a normalizer (NFC, white space, lower case), a splitting pattern and byte-level BPE with word ends. Texts whose characters
all lie in a range where that normalizing is plain lower-casing are split by an equivalent pattern; all others go through the library's own
normalizer and splitter. Strings of special tokens are found first, as the library does.
"""

from __future__ import annotations

import hashlib
import json
import re
import secrets
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import materialize, text_of

#: Characters of text a block holds before it is closed.
BLOCK = 24_000_000
#: Words that a task keeps encoded.
MOST_WORDS = 400_000
#: Up to U+017F only U+0130 changes under NFC or, in lower case, leaves the range or becomes two characters.
_ODD = re.compile("[\u0130\u0180-\U0010ffff]")
_LETTER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_NUMBER = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_SPACE = "\t-\r \u0085\u00a0"
_PLAIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


class Splitter:
    """Words of a text. A word of ordinary text is kept as "w" and the word, a special token as "s" and its string."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.special = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        splits = made["pre_tokenizer"]["pretokenizers"]
        word_only = made | {"added_tokens": [], "normalizer": None, "pre_tokenizer": splits[1], "truncation": None, "padding": None}
        self.model = Tokenizer.from_str(json.dumps(word_only))
        # Only the normalizer and the splitter of this one are used, so it goes without the vocabulary.
        slow = Tokenizer.from_str(json.dumps(made | {"added_tokens": [], "pre_tokenizer": splits[0], "truncation": None, "padding": None, "model": {"type": "BPE", "vocab": {}, "merges": []}}))
        self.normalize, self.split_all = slow.normalizer.normalize_str, slow.pre_tokenizer.pre_tokenize_str
        self.vocabulary = made["model"]["vocab"] | self.special
        self.pieces = pa.table({"id": pa.array(self.vocabulary.values(), pa.int32()), "piece": pa.array(self.vocabulary, pa.string())})

    def plain(self, text: str) -> list[str]:
        if _ODD.search(text):
            return [w for w, _ in self.split_all(self.normalize(text))]
        return _PLAIN.findall(text.lower())

    def words(self, text: str) -> list[str]:
        if self.cut is None or "<" not in text or not self.cut.search(text):
            return ["w" + w for w in self.plain(text)]
        out: list[str] = []
        for part in self.cut.split(text):
            out += ["s" + part] if part in self.special else ["w" + w for w in self.plain(part)]
        return out

    def encode(self, words: list[str]) -> list[list[int]]:
        ids = self.model.encode_batch([w[1:] for w in words], add_special_tokens=False)
        return [[self.special[w[1:]]] if w[0] == "s" else e.ids for w, e in zip(words, ids, strict=True)]


@lru_cache(maxsize=2)
def splitter(path: str) -> Splitter:
    return Splitter(path)


def vocabulary(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(id, piece): the id-to-piece table; its size is the vocabulary's, whatever the input."""
    rows = [(i, p) for p, i in splitter(path or tokenizer_path()).vocabulary.items()]
    return spark.createDataFrame(rows, "id int, piece string")


class _Words(dict):
    """Words in the order in which they were met."""

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        return at


def _laid_out(known: dict, spots: list[np.ndarray], parts: int) -> tuple[np.ndarray, list[list[str]]]:
    """Each word's position (its place in its part, times parts, plus the part; frequent words first) and the words of each part."""
    words = list(known)
    part = np.fromiter((zlib.crc32(w.encode()) % parts for w in words), np.int64, len(words))
    often = np.bincount(np.concatenate(spots), minlength=len(words)) if words else np.zeros(0, np.int64)
    order = np.lexsort((-often, part))
    sizes = np.bincount(part, minlength=parts)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lists = [[words[i] for i in some] for some in np.split(order, np.cumsum(sizes)[:-1])]
    return place * parts + part, lists


def _blocks(path: str, size: int, parts: int, schema: pa.Schema):
    """Rows (kept columns, block, part, pack): documents with their positions (part null), and a block's words by part."""

    def run(batches):
        split = splitter(path).words
        kept_names = schema.names[:-3]

        def rows(held, known):
            block = secrets.randbits(62)
            position, lists = _laid_out(known, [x for _, spots in held for x in spots], parts)
            for kept, spots in held:
                n = kept.num_rows
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([block] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.array([_pack(position[x]) for x in spots], pa.binary())], schema=schema)
            used = [i for i, w in enumerate(lists) if w]
            n = len(used)
            packs = [_squeeze("\n".join(lists[i]).encode()) for i in used]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(n, schema.field(k).type) for k in kept_names), pa.array([block] * n, pa.int64()), pa.array(used, pa.int32()), pa.array(packs, pa.binary())], schema=schema)

        held, known, weight = [], _Words(), 0
        for batch in batches:
            kept = pa.RecordBatch.from_arrays(batch.columns[:-1], schema=pa.schema(list(schema)[:-3]))
            texts = batch.column(batch.num_columns - 1)
            spots, first = [], 0
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                spots.append(np.array([known[w] for w in split(text)], np.int32))
                weight += len(text) + 50
                if weight >= size:
                    yield from rows([*held, (kept.slice(first, len(spots)), spots)], known)
                    held, known, weight, spots, first = [], _Words(), 0, [], i + 1
            if spots:
                held.append((kept.slice(first, len(spots)), spots))
        if held:
            yield from rows(held, known)

    return run


def _squeeze(raw: bytes) -> bytes:
    import zstandard

    return zstandard.compress(raw, 9)


def _swell(packed: bytes) -> bytes:
    import zstandard

    return zstandard.decompress(packed)


def _pack(numbers) -> bytes:
    """High bytes hardly vary: bytes are laid in planes and compressed."""
    a = np.asarray(numbers).astype("<u4")
    return _squeeze(a.view(np.uint8).reshape(-1, 4).T.tobytes()) if len(a) else b""


def _unpack(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.int32)
    return np.ascontiguousarray(np.frombuffer(_swell(packed), np.uint8).reshape(4, -1).T).view("<i4").ravel()


def word_parts(docs: DataFrame) -> int:
    """Parts of a block's word list, each with one home partition: two for each partition of the input, 64 to 4096."""
    return min(4096, max(64, 1 << (2 * docs.rdd.getNumPartitions() - 1).bit_length()))


def encoded_blocks(docs: DataFrame, keep: list, text_col: str = "text", path: str | None = None, block: int = BLOCK) -> tuple[DataFrame, DataFrame, int]:
    """(documents by block, ids of the block's words by block and part, number of parts)."""
    path = path or tokenizer_path()
    parts = word_parts(docs)
    source = docs.select(*keep, text_of(docs, text_col).alias("__sigweave_text"))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in source.schema.fields[:-1]] + T.StructType.fromDDL("__block bigint, __part int, __pack binary").fields)
    all_rows = materialize(source.mapInArrow(_blocks(path, block, parts, to_arrow_schema(schema)), schema), "blocks")
    words = all_rows.where(F.col("__part").isNotNull()).select("__block", "__part", "__pack").repartition("__part")

    def encode(batches):
        known: dict[str, list[int]] = {}
        for b in batches:
            out = []
            for pack in b.column(2).to_pylist():
                some = _swell(pack).decode().split("\n")
                new = [w for w in some if w not in known]
                if len(known) + len(new) > MOST_WORDS:  # bounds memory; what is met again is then encoded again
                    known.clear()
                    new = some
                known.update(zip(new, splitter(path).encode(new), strict=True))
                ids = [known[w] for w in some]
                out.append(_pack([len(ids), *map(len, ids), *(i for x in ids for i in x)]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["__of", "__part", "__ids"])

    return all_rows.where(F.col("__part").isNull()).drop("__part"), words.mapInArrow(encode, "__of bigint, __part int, __ids binary"), parts


def decode(rows: DataFrame, key: str, ids: str, spark: SparkSession, path: str | None = None) -> DataFrame:
    """(key, decoded) by a join of ids with their pieces: without a decoder the library puts one space between pieces. Rows without ids give none.

    key must be unique. The table of pieces has as many rows as the vocabulary, which bounds its broadcast.
    """
    flat = rows.select(key, F.posexplode(ids).alias("at", "id"))
    named = flat.join(F.broadcast(vocabulary(spark, path)), "id")
    ordered = F.sort_array(F.collect_list(F.struct("at", "piece")))
    return named.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["piece"]), " ").alias("decoded"))


def _block_ids(right: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all words of a block in one array, and by position a word's first place there and its number of ids."""
    lists = [(part, _unpack(pack)) for part, pack in zip(right.column("__part").to_pylist(), right.column("__ids").to_pylist(), strict=True)]
    most = max((int(x[0]) for _, x in lists), default=0) * parts
    first, many, flat, at = np.zeros(most, np.int64), np.zeros(most, np.int32), [], 0
    for part, x in lists:
        n = int(x[0])
        where = slice(part, part + n * parts, parts)
        many[where] = x[1 : n + 1]
        first[where] = at + np.cumsum(x[1 : n + 1], dtype=np.int64) - x[1 : n + 1]
        flat.append(x[n + 1 :])
        at += len(x) - n - 1
    return (np.concatenate(flat) if flat else np.zeros(0, np.int32)), first, many


def _ids(positions: list[bytes], right: pa.Table, path: str, parts: int) -> list[pa.Array]:
    """Ids of each document."""
    flat, first, many = _block_ids(right, parts)
    values, sizes = [np.zeros(0, np.int32)], [0]
    for at in map(_unpack, positions):
        n = many[at]
        before = np.cumsum(n, dtype=np.int64) - n
        values.append(flat[np.repeat(first[at] - before, n) + np.arange(n.sum(dtype=np.int64))])
        sizes.append(len(values[-1]))
    return [pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(values), pa.int32()))]


def _digests(positions: list[bytes], right: pa.Table, path: str, parts: int) -> list[pa.Array]:
    """Number of ids, digest of the ids and of the decoded text; a piece comes from a join of the block's ids with the vocabulary."""
    flat, first, many = _block_ids(right, parts)
    used = pa.table({"id": pa.array(np.unique(flat), pa.int32())})
    joined = used.join(splitter(path).pieces, "id")
    piece = dict(zip(joined.column("id").to_pylist(), joined.column("piece").to_pylist(), strict=True))
    texts, decoded = [""] * len(first), [""] * len(first)
    for i in np.flatnonzero(many).tolist():
        word = flat[first[i] : first[i] + many[i]].tolist()
        texts[i] = " ".join(map(str, word))
        decoded[i] = " ".join([piece[x] for x in word])
    counts, digests = [], ([], [])
    for at in map(_unpack, positions):
        counts.append(int(many[at].sum(dtype=np.int64)))
        at = at.tolist()
        for out, of_word in zip(digests, (texts, decoded), strict=True):
            out.append(hashlib.sha256(" ".join([of_word[i] for i in at]).encode()).hexdigest())
    return [pa.array(counts, pa.int64()), *(pa.array(x, pa.string()) for x in digests)]


def _join_back(path: str, parts: int, schema: pa.Schema, finish):
    """For each block: finish(packed positions of its documents, ids of its words) gives the new columns."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        new = finish(left.column("__pack").to_pylist(), right, path, parts)
        kept = left.drop_columns(["__block", "__pack"])
        return pa.Table.from_arrays([*(c.cast(f.type) for c, f in zip(kept.columns, schema, strict=False)), *new], schema=schema)

    return run


def _apply(docs: DataFrame, keep: list, made: str, finish, **options) -> DataFrame:
    left, right, parts = encoded_blocks(docs, keep, **options)
    schema = T.StructType(left.drop("__block", "__pack").schema.fields + T.StructType.fromDDL(made).fields)
    return left.groupBy("__block").cogroup(right.groupBy("__of")).applyInArrow(_join_back(options.get("path") or tokenizer_path(), parts, to_arrow_schema(schema), finish), schema)


def encode(docs: DataFrame, keep: list, **options) -> DataFrame:
    """Columns keep and ids (array of int) for every row of docs; null and empty texts have no ids. Repeated rows stay repeated."""
    return _apply(docs, keep, "ids array<int>", _ids, **options)


def encoded_digests(docs: DataFrame, keep: list, **options) -> DataFrame:
    """Columns keep, n_tokens, and SHA-256 of the ids in decimals and of the decoded text."""
    return _apply(docs, keep, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", _digests, **options)

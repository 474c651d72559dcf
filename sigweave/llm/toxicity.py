"""Toxicity by compression distance.

Separate zstandard dictionaries are trained on toxic and on ordinary text. A text's windows (its words, each before the same short
carrier: zstandard starts no match in the last bytes of its input) are compressed with both; a window that the toxic
dictionary makes shorter by at least a calibrated number of bytes is a hit. Both dictionaries begin with the same base, trained on
ordinary text, so that ordinary words cost the same with either, and end with what was trained on the windows that several
documents of their own class share and that the base compresses badly. Copies of a document count once in that.

The fit reads at most `per_class` labelled documents of each class, those with the smallest hash of the id; all else covers all rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, map_columns, text_of

LETTERS = re.compile(r"[^\W\d_]+")
#: Longer runs of letters are cut into overlapping windows of so many.
LONGEST = 24


@dataclass(frozen=True)
class Settings:
    per_class: int = 2000
    base_bytes: int = 48 << 10
    own_bytes: int = 12 << 10
    #: Documents (without copies) that must share a window before a dictionary is trained on it.
    shared: int = 3
    cut: float = 0.7


@dataclass
class Model:
    """Two raw dictionaries, the carrier, the hit threshold in bytes and the weights of the score."""

    toxic: bytes
    ordinary: bytes
    carrier: bytes
    threshold: int = 3
    weights: tuple[float, ...] = (-4.0, 4.0, 1.0)
    _gain: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_gain": None}

    def gain(self, window: str) -> int:
        """Bytes by which the toxic dictionary makes the window shorter."""
        if self._gain is None:
            self._gain = _Gains(self)
        return self._gain(window)

    def cost(self, window: str) -> int:
        """Bytes that the window takes with the ordinary dictionary, its carrier included."""
        if self._gain is None:
            self._gain = _Gains(self)
        return self._gain.cost(window)

    def features(self, text: str) -> list[float]:
        """Of the distinct windows: is any a hit, and how many are (logarithm)."""
        hits = sum(self.gain(w) >= self.threshold for w in windows(text))
        return [1.0, float(hits > 0), math.log1p(hits)]

    def score(self, text: str) -> float:
        z = sum(w * x for w, x in zip(self.weights, self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


class _Gains:
    """Compression lengths are kept for distinct windows, up to a fixed number."""

    MOST = 300_000

    def __init__(self, model: Model):
        import zstandard as z

        def coder(raw: bytes):
            d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
            return z.ZstdCompressor(dict_data=d, compression_params=z.ZstdCompressionParameters(strategy=z.STRATEGY_BTLAZY2, search_log=6, hash_log=17, chain_log=17, window_log=18, target_length=64, min_match=4, format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)).compress

        self.toxic, self.ordinary, self.carrier, self.known = coder(model.toxic), coder(model.ordinary), model.carrier, {}

    def cost(self, window: str) -> int:
        return len(self.ordinary(b" %b %b" % (window.encode(), self.carrier)))

    def __call__(self, window: str) -> int:
        got = self.known.get(window)
        if got is None:
            if len(self.known) >= self.MOST:
                self.known.clear()
            text = b" %b %b" % (window.encode(), self.carrier)
            got = self.known[window] = len(self.ordinary(text)) - len(self.toxic(text))
        return got


def windows(text: str) -> set[str]:
    found = set(LETTERS.findall(text.lower()))
    if long := [w for w in found if len(w) > LONGEST]:
        found.difference_update(long)
        for w in long:
            found.update(w[i : i + LONGEST] for i in range(0, len(w) - LONGEST // 2, LONGEST // 2))
    return found


def _trained(samples: list[bytes], size: int) -> bytes:
    """What zstandard's trainer picks from the samples, without the entropy tables; of exactly `size` bytes."""
    import zstandard as z

    got = b""
    try:
        if sum(map(len, samples)) > 4 * size and len(samples) > 8:
            got = z.train_dictionary(size + 1024, samples, k=64, d=6).as_bytes()[-size:]
    except z.ZstdError:
        pass
    if not got:  # too little text for the trainer: the text itself
        got = b" ".join(samples)[-size:]
    return b" " * (size - len(got)) + got


def _shared(sets: list[set[str]]) -> Counter:
    """In how many documents a window is; of documents that share the smallest hash of their windows under one of four seeds, the first counts."""
    import xxhash

    seen: set[tuple[int, int]] = set()
    n: Counter = Counter()
    for ws in sets:
        least = {(k, min((xxhash.xxh64_intdigest(w, k) for w in ws if len(w) > 7), default=-1 - len(n))) for k in range(4)}
        if not least & seen:
            n.update(ws)
        seen |= least
    return n


def fit(toxic: list[str], ordinary: list[str], settings: Settings = Settings()) -> Model:
    """A model from labelled texts; without texts of both classes it scores every text low."""
    s = settings
    if not toxic or not ordinary:
        return Model(b" " * 64, b" " * 64, b" ", 99)
    bad, fine = [windows(t) for t in toxic], [windows(t) for t in ordinary]
    join = lambda ws: (" " + " ".join(sorted(ws)) + " ").encode()
    base = _trained([join(w) for w in fine], s.base_bytes)
    carrier = base[-96:].decode(errors="ignore").encode()[:64].rpartition(b" ")[0]
    plain = Model(base + b" " * s.own_bytes, base, carrier)
    cost = lambda w: plain.cost(w) - plain.cost("") > 2

    def tail(own: list[set[str]], other: Counter) -> bytes:
        n = _shared([{x for w in ws for x in (w, w[:5] + "*")} for ws in own])
        least = max(s.shared, len(own) // 200)
        only = lambda x: n[x] >= least and n[x] > 40 * other[x]
        picked = {w for ws in own for w in ws if len(w) > 3 and (only(w) or len(w) > 5 and only(w[:5] + "*")) and cost(w)}
        body = _trained([join(ws & picked) for ws in own if ws & picked], s.own_bytes)
        known = Model(base + body, base + b" " * s.own_bytes, carrier)
        # What the trainer left out, the most shared windows last: near matches cost least.
        left = sorted((w for w in picked if known.gain(w) < 3), key=lambda w: (n[w], w))
        more = (" " + " ".join(left) + " ").encode()[-s.own_bytes // 3 :]
        return body[len(more) :] + more

    seen = lambda sets: Counter(x for ws in sets for x in {x for w in ws for x in (w, w[:5] + "*")})
    second = Model(base + tail(bad, seen(fine)), base + tail(fine, seen(bad)), carrier)
    # The threshold in bytes that tells the documents apart best, then the score's weights.
    best = []
    spread = [np.array([max((second.gain(w) for w in ws), default=0) for ws in sets]) for sets in (bad, fine)]
    for t in range(1, 12):
        best.append((float((spread[0] >= t).mean() - 3 * (spread[1] >= t).mean()), -t))
    second.threshold = -max(best)[1]
    x = np.array([second.features(t) for t in [*toxic, *ordinary]])
    y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    w = np.zeros(3)
    share = np.where(y == 1, 0.5 / len(toxic), 0.5 / len(ordinary))
    for _ in range(50):  # Newton steps of a ridge logistic fit, the classes weighing the same
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (share * (p - y)) + 1e-3 * w
        w -= np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3), grad)
    second.weights = tuple(map(float, w))
    return second


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(toxic, text) of at most per_class documents of each class whose crc32(id) mod 3 is not 1; an id with both labels counts as toxic.

    Of rows that repeat an id the smallest text counts, so that no more than 2 x per_class texts reach the driver.
    """
    key = F.col(id_col).cast("string")
    seen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.crc32(key) % 3 != 1)).groupBy(F.col(id_col).alias("__id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    few = [seen.where(F.col("toxic") == c).orderBy(F.xxhash64(F.col("__id").cast("string")), "__id").limit(settings.per_class) for c in (0, 1)]
    few = few[0].unionByName(few[1])  # 2 x per_class rows at most
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(text_of(docs, text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(few), "__id").groupBy("__id").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text")


def fit_table(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), **columns) -> Model:
    rows = sorted((r.toxic, r.text) for r in training_rows(docs, labels, settings, **columns).toLocalIterator())
    return fit([t for y, t in rows if y], [t for y, t in rows if not y], settings)


def _batch(texts, model):
    return [[model.score(t) for t in as_text(texts)]]


def score(docs: DataFrame, model: Model, keep: list, text_col: str = "text", name: str = "score") -> DataFrame:
    """Columns keep and the score in 0 to 1. Null and empty texts have no window, so no hit, and get the lowest score."""
    return map_columns(docs, keep, [text_of(docs, text_col)], {name: "double"}, _batch, model=model)


def scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    got = score(docs, fit_table(docs, labels, settings), ["doc_id"])
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return got.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= settings.cut).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """docs without those scored at or above the cut."""
    got = score(docs, fit_table(docs, labels, settings), [F.col(f"`{c}`") for c in docs.columns], name="__sigweave_score")
    return got.where(F.col("__sigweave_score") < settings.cut).drop("__sigweave_score")

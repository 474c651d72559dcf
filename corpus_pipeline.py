"""Corpus pipeline: toxic documents go, near-duplicates of an earlier document go, secrets are masked, sources are mixed to target
weights, and what is left is encoded. Every stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.llm import bpe, minhash, mixing, secrets, toxicity
from sigweave.llm.common import materialize, read, remove


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the cut. The classifier is fitted on the documents given and the table of labels; without labels of both classes all
    stay. Null and empty texts have no window and stay; equal texts have equal scores, so repeated rows stay or go together."""
    return toxicity.keep_ordinary(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Jaccard similarity of at least 0.8 on five-word shingles; the digest contract of op7_simhash binds only that query. Pairs come from op7's
    pigeonring filtering of SimHash fingerprints first, those that differ in more bits from MinHash, and each is held against the exact similarity.

    Of a group the smallest id stays (null last), of equal ids the smallest hash of the row, of equal rows one. Texts without words are alike."""
    return minhash.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with spans masked in the text and n_chars brought up to date; null texts stay null."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Null is a source; texts without words have nothing to take and go, and so do documents that the mix
    leaves out. Rows equal in id, source and text stand for one that is taken as often as all of them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' other columns, and `ids` with their number `n_tokens`; a copy that the mix repeats is encoded like its first.

    Null and empty texts have no ids. Columns of these names that documents already have are kept as doc_ids and doc_n_tokens."""
    others, names = [], [c for c in docs.columns if c != "text"]
    for c in names:
        new = c
        while new in ("ids", "n_tokens") or new != c and new in names:
            new = f"doc_{new}"
        others.append(F.col(f"`{c}`").alias(new))
    return bpe.encode(docs, others).withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Compression and fingerprints have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        remove(before)
    return docs

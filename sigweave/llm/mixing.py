"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words: its weight's part of `share` times all words, at most `most` times its own words, what is above
being dealt again by weight among the others. The whole part of target over source is taken as certain copies of every document. For the rest
documents have inclusion odds that differ: p = min(1, c * importance), by default in proportion to the binary digits of the size, so that
documents with more context come in more often without those of one page going under. c is such that the expected words are the rest; documents
with p = 1 are certain copies, too. All others are ranked by the odds of a fixed random number over the odds of inclusion and taken in
that order until the source's target is met in words (a sample of fixed size); the one at the margin gives its leading words
only. Random numbers come from a digest of the id and the text, so that reruns agree and every oracle can repeat them.

No task gathers a source: words are summed by source, by blocks and by slices of the ranking value, and only the slice in which the
target is met is put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, text_of

WEIGHTS = (3, 1, 2)
#: Blocks of the ranking value (0 to 1) within a source, and slices of a block.
BLOCKS = SLICES = 1 << 8
SEED = "mix"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size). Sources in order of code points, null last, weigh as `weights`, repeating.

    Dealing the excess again and again ends where every source has min(most * its words, rate * weight) with one common rate; sources that reach their
    bound are those with the smallest bound a weight. One row a source goes through one task here.
    """
    one = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*(F.lit(w) for w in weights))
    one = one.withColumn("w", F.element_at(table, (place % len(weights) + 1).cast("int")).cast("double"))
    bound = F.col("source_size") * F.lit(float(most))
    by = Window.orderBy((bound / F.col("w")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    one = one.withColumn("bound", bound).withColumn("n", F.row_number().over(by))
    one = one.withColumn("all", F.sum("source_size").over(everything) * F.lit(float(share))).withColumn("w_all", F.sum("w").over(everything))
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rate = (F.col("all") - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / (F.col("w_all") - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    one = one.withColumn("rate", rate)
    free = F.col("rate") * F.col("w") <= F.col("bound")
    one = one.withColumn("first_free", F.min(F.when(free, F.col("n"))).over(everything))
    common = F.min(F.when(F.col("n") == F.col("first_free"), F.col("rate"))).over(everything)
    return one.withColumn("rate", common).select("source", "source_size", F.when(F.col("n") < F.coalesce("first_free", F.col("n") + 1), F.col("bound")).otherwise(F.col("rate") * F.col("w")).alias("target"))


def digits(size: Column) -> Column:
    """Binary digits of a size; 1 for none."""
    return F.length(F.bin(size)).cast("double")


def chances(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, importance, p) for each importance in a source: min(1, c * importance), with as many words expected as `rest` of goal says.

    From the largest importance down, each is certain if c, of all that are not above it, makes it so. The table has a row for each importance of a
    source, and a source's rows go through one task, so an importance should have few distinct values, as the default has (at most 64).
    """
    one = sizes.where("size > 0").groupBy("source", "importance").agg(F.sum("size").cast("double").alias("words"))
    one = one.join(goal.select(F.col("source").alias("s1"), "rest"), F.col("source").eqNullSafe(F.col("s1"))).drop("s1")
    down = Window.partitionBy("source").orderBy(F.desc("importance"))
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    below = F.sum(F.col("importance") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))
    one = one.withColumn("c", (F.col("rest") - above) / below)
    first = F.when(F.col("c") * F.col("importance") < 1, F.struct((-F.col("importance")).alias("i"), "c"))
    one = one.withColumn("first", F.min(first).over(Window.partitionBy("source")))
    sure = F.col("first").isNull() | (F.col("importance") > -F.col("first.i"))
    return one.select("source", "importance", F.when(sure, F.lit(1.0)).otherwise(F.col("first.c") * F.col("importance")).alias("p"))


def uniform(doc_id: Column, text_md5: Column) -> Column:
    """A number over 0 and under 1 from the id and the text's digest."""
    digest = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("null")), text_md5))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    importance: Column | None = None,
) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of docs, repeated rows included, and text_md5.

    importance (positive, few distinct values; default: binary digits of the size) is what inclusion odds are in proportion to within a source.
    Null text has no words. Null ids draw by their text alone; rows equal in id and text are ordered arbitrarily among themselves, which
    changes no result but which of the equal rows is which.
    """
    text = F.coalesce(text_of(docs, text_col), F.lit(""))
    given = F.lit(None) if importance is None else importance
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size_of(text).alias("size"), F.md5(text).alias("text_md5"), given.cast("double").alias("importance"))
    base = materialize(base.withColumn("importance", F.coalesce("importance", digits(F.col("size")))), "sizes")
    goal = targets(base, weights, share, most).withColumn("whole", F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))))
    # The rest to sample, in words; certain copies meet a target at the upper bound exactly.
    goal = materialize(goal.withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("bigint")), "targets")
    odds = materialize(chances(base, goal).select(F.col("source").alias("s3"), F.col("importance").alias("i3"), "p"), "chances")
    rows = base.join(goal, base["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    rows = rows.join(odds, F.col("source").eqNullSafe(F.col("s3")) & (F.col("importance") == F.col("i3")), "left").drop("s3", "i3")
    p, u = F.col("p"), uniform(F.col("doc_id"), F.col("text_md5"))
    q = (u * (1 - p)) / (u * (1 - p) + p * (1 - u))  # odds(u) / odds(p), brought from (0, infinity) to (0, 1) in the same order
    rows = rows.withColumn("q", F.when(F.col("size") == 0, F.lit(1.0)).when(p >= 1, F.lit(0.0)).otherwise(q))
    # Certain copies have a slice before all others.
    slice_ = F.when((F.col("size") > 0) & (p >= 1), F.lit(-1)).otherwise(F.floor(F.col("q") * (BLOCKS * SLICES - 1)).cast("int"))
    rows = materialize(rows.withColumn("slice", slice_).drop("p"), "ranked")
    cut = materialize(_cuts(rows, goal), "cuts")
    rows = rows.join(cut, F.col("source").eqNullSafe(F.col("s2")), "left")  # without a cut the rest takes all
    within = Window.partitionBy("source").orderBy("q", "text_md5", "doc_id")
    at = F.col("slice") == F.col("cut")
    edge = rows.where(at).withColumn("left", F.col("rest") - F.col("before") - (F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")))
    edge = edge.withColumn("extra", F.greatest(F.lit(0).cast("bigint"), F.least(F.col("left"), F.col("size"))))
    plain = rows.where(~F.coalesce(at, F.lit(False)))
    taken = (F.col("cut").isNull() & (F.col("rest") > 0)) | (F.col("slice") < F.col("cut"))
    plain = plain.withColumn("extra", F.when(taken, F.col("size")).otherwise(0).cast("bigint"))
    columns = ["doc_id", "source", "size", "source_size", "target", "text_md5", (F.col("whole") * F.col("size") + F.col("extra")).cast("bigint").alias("taken")]
    return edge.select(*columns).unionByName(plain.select(*columns))


def _cuts(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """(s2, cut, before): the slice in which a source's rest is met, and the words before it. First its block is found, then the slice in that."""
    parts = materialize(rows.groupBy("source", "slice").agg(F.sum("size").alias("words")), "slices")
    block = F.floor(F.col("slice") / SLICES).cast("int")

    def met(sums: DataFrame, by: str) -> DataFrame:
        upto = Window.partitionBy("source").orderBy(by)
        sums = sums.withColumn("before", F.col("base") + F.sum("words").over(upto) - F.col("words"))
        return sums.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))

    blocks = parts.groupBy("source", block.alias("block")).agg(F.sum("words").alias("words"))
    # Merged, not broadcast: neither side's size follows from a bound.
    blocks = blocks.join(goal.select(F.col("source").alias("s1"), "rest").hint("merge"), F.col("source").eqNullSafe(F.col("s1"))).withColumn("base", F.lit(0).cast("bigint"))
    found = met(blocks, "block").select(F.col("source").alias("s2"), F.col("block").alias("in"), F.col("before").alias("base"), "rest")
    some = parts.withColumn("block", block).join(found.hint("merge"), F.col("source").eqNullSafe(F.col("s2")) & (F.col("block") == F.col("in")))
    return met(some, "slice").select("s2", F.col("slice").alias("cut"), "before")


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The mix itself: each document as often as it is taken whole, and the margin's document cut after the words taken.

    Rows equal in id, source and text get their shares in any order. n_chars, where there is one, follows a cut.
    """
    key = F.struct(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.md5(F.coalesce(text_of(docs, text_col), F.lit(""))).alias("text"))
    got = mix(docs, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    got = got.select(F.struct(F.col("doc_id").alias("id"), "source", F.col("text_md5").alias("text")).alias("__sigweave_k"), "size", "taken")
    got = materialize(got.where("taken > 0").groupBy("__sigweave_k").agg(F.max("size").alias("__sigweave_size"), F.sum("taken").alias("__sigweave_taken"), F.count("*").alias("__sigweave_n")), "taken")
    columns = docs.columns
    rows = docs.withColumn("__sigweave_k", key)
    # Equal rows stand for one that is taken as often as all of them.
    again = got.where("__sigweave_n > 1")
    once = rows.join(got.where("__sigweave_n = 1"), "__sigweave_k")
    rows = once.unionByName(rows.join(again, "__sigweave_k").dropDuplicates(["__sigweave_k"]))
    whole = F.floor(F.col("__sigweave_taken") / F.col("__sigweave_size")).cast("int")
    part = (F.col("__sigweave_taken") % F.col("__sigweave_size")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("__sigweave_cut", F.explode(copies))
    pieces = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(pieces, 1, F.greatest("__sigweave_cut", F.lit(1))), "")
    cut = F.when(F.col("__sigweave_cut") > 0, head).otherwise(F.col(f"`{text_col}`"))
    out = rows.withColumn(text_col, cut)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("__sigweave_cut") > 0, F.length(text_col).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*(F.col(f"`{c}`") for c in columns))

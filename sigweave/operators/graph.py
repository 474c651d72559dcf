"""Co-occurrence edges, indexes and the pruned graph."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.store import written


def pair_rows(left: DataFrame, right: DataFrame, key: str, most: int = 1 << 20) -> DataFrame:
    """left and right, each made distinct, joined by report; a report with over `most` pairs is dealt out in tiles.

    The rows of such a report are cut by hash into chunks of about the square root of `most` on either side, and each chunk of one side meets each of the
    other in a task of its own choice, so that no task makes a report's pairs alone. How many rows a report has is counted before they are made
    distinct, which can only cut more. Without such reports the plan is the plain join.
    """
    sizes = left.groupBy(key).agg(F.count("*").alias("__n")).join(right.groupBy(key).agg(F.count("*").alias("__m")), key)
    left, right = left.distinct(), right.distinct()
    side = max(1, math.isqrt(most))
    chunks = lambda n: F.ceil(F.col(n) / side).cast("int")
    heavy = sizes.where(F.col("__n").cast("double") * F.col("__m") > most).select(key, chunks("__n").alias("__ci"), chunks("__m").alias("__cj"))
    if heavy.isEmpty():
        return left.join(right, key)
    heavy = written(heavy, "heavy")
    light = left.join(heavy, key, "left_anti").join(right, key)

    def tiles(df: DataFrame, own: str, other: str, own_chunks: str, other_chunks: str) -> DataFrame:
        place = F.pmod(F.xxhash64(*(F.col(c) for c in df.columns)), F.col(own_chunks).cast("bigint")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other_chunks) - 1))
        return df.join(heavy, key).select(*df.columns, place.alias(own), every.alias(other))

    tiled = tiles(left, "__i", "__j", "__ci", "__cj").hint("merge").join(tiles(right, "__j", "__i", "__cj", "__ci"), [key, "__i", "__j"])
    return light.unionByName(tiled.drop("__i", "__j"))


def pair_counts(
    left: DataFrame, right: DataFrame, key: str, a: list[str], b: list[str], name: str = "n_cases", mode: str = "rows", most: int = 1 << 20,
) -> DataFrame:
    """Counts of (a, b) over reports. Both sides are made distinct first; `rows` keeps other columns of right apart (a report may count twice for a pair), `distinct_reports` doesn't."""
    rows = pair_rows(left.select(key, *a), right if mode == "rows" else right.select(key, *b), key, most)
    return rows.groupBy(*a, *b).agg(F.count("*").alias(name))


def prune(edges: DataFrame, weight: str, least: int) -> DataFrame:
    return edges.where(F.col(weight) >= least)


def nodes_of(edges: list[DataFrame], key: str, name: Column | None = None) -> DataFrame:
    """Distinct keys over edge tables, with the smallest name where one is given."""
    out = None
    for e in edges:
        part = e.select(key, *([name.alias("__name")] if name is not None else [])).distinct()
        out = part if out is None else out.unionByName(part)
    return out.distinct() if name is None else out.groupBy(key).agg(F.min("__name").alias("name"))


def surrogate(keys: DataFrame, key: str, name: str) -> DataFrame:
    """(name, key): dense ids from 1 in order of the key. The keys are numbered within key ranges and shifted by the counts before; no task sees all.

    The ranges are sampled anew by each plan that uses them, so the ranged keys are written once, and counts and rows both read what was written.
    """
    spark = keys.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(keys.select(key).distinct().repartitionByRange(n, key).withColumn("__p", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("__p").agg(F.count("*").alias("__n"))
    before = counts.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__p").orderBy(key))
    return ranged.withColumn("__i", inside).join(before, "__p").select((F.col("__i") + F.col("__before")).cast("bigint").alias(name), key)


def coo(edges: DataFrame, rows: DataFrame, row: str, cols: DataFrame, col: str, weight: str) -> DataFrame:
    return edges.join(rows, row).join(cols, col).select(*(c for c in rows.columns if c != row), *(c for c in cols.columns if c != col), weight)


def pair_tables(
    compounds: DataFrame, outcomes: DataFrame, least: int, key: str = "report", compound: str = "compound", outcome: str = "outcome", roles: tuple[str, ...] = ("PS", "SS"),
    include_any: bool = False, mode: str = "rows",
) -> dict[str, DataFrame]:
    """The pair tables of reports: from (key, role, compound) and (key, outcome, ...) counts for the roles given, those of at least `least` reports, indexes of
    their compounds and outcomes, and the sparse matrix of both; `any` holds the counts over all roles, and no rows unless they are asked for.

    compound may be a structure key or a raw structure. Blank compounds and outcomes take no part.
    """
    weights = pair_weights(compounds, outcomes, key, compound, outcome, roles, include_any, mode)
    return tables_of_weights(weights, least, compound, outcome, include_any)


def pair_weights(
    compounds: DataFrame, outcomes: DataFrame, key: str = "report", compound: str = "compound", outcome: str = "outcome", roles: tuple[str, ...] = ("PS", "SS"), every_role: bool = True, mode: str = "rows",
) -> DataFrame:
    """(compound, outcome, n_cases, n_any): the counts over the roles given and over all, written once. Reports and outcomes meet once for both; without
    every_role other roles' rows take no part, and n_any is n_cases."""
    asked = F.coalesce(F.col("role").isin(*roles), F.lit(False))
    some = compounds.where(F.trim(compound) != "")
    some = (some if every_role else some.where(asked)).groupBy(key, compound).agg(F.max(asked.cast("int")).alias("__asked"))
    what = outcomes.where(F.trim(outcome) != "")
    rows = pair_rows(some, what if mode == "rows" else what.select(key, outcome), key)
    return written(rows.groupBy(compound, outcome).agg(F.sum("__asked").cast("bigint").alias("n_cases"), F.count("*").alias("n_any")), "weights")


def tables_of_weights(weights: DataFrame, least: int, compound: str = "compound", outcome: str = "outcome", include_any: bool = False) -> dict[str, DataFrame]:
    """The tables of pair_tables from what pair_weights gives."""
    pairs = weights.where("n_cases > 0").select(compound, outcome, "n_cases")
    kept = prune(pairs, "n_cases", least)
    rows, columns = surrogate(kept, compound, "compound_id"), surrogate(kept, outcome, "outcome_id")
    everything = weights.select(compound, outcome, F.col("n_any").alias("n_cases")) if include_any else pairs.limit(0)
    return {"pairs": pairs, "pruned": kept, "rows": rows, "columns": columns, "matrix": coo(kept, rows, compound, columns, outcome, "n_cases"), "any": everything}


def primary_parent(hierarchy: DataFrame, child: str, primary: Column, ordinal: str) -> DataFrame:
    """One parent for each child: the primary one, else the first."""
    order = Window.partitionBy(child).orderBy(F.when(primary, 0).otherwise(1), ordinal)
    return hierarchy.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")


def flags(nodes: DataFrame, key: str, members: dict[str, DataFrame]) -> DataFrame:
    """nodes with a 0/1 column for each set of keys."""
    for name, m in members.items():
        m = m.select(F.col(key).alias("__m")).distinct()
        nodes = nodes.join(m, nodes[key] == m["__m"], "left").withColumn(name, F.col("__m").isNotNull().cast("int")).drop("__m")
    return nodes


def labelled(df: DataFrame, key: str, labels: DataFrame, label: str, base: Column, out: str) -> DataFrame:
    """df with the label of its key, or the base where there is none."""
    lab = labels.select(F.col(key).alias("__key"), F.col(label).alias("__label"))
    return df.join(lab, df[key] == lab["__key"], "left").withColumn(out, F.coalesce("__label", base)).drop("__key", "__label")


def joined_distinct(c: Column) -> Column:
    """Distinct values in order, joined by commas."""
    return F.array_join(F.array_sort(F.collect_set(c)), ",")


def core_graph(compounds: DataFrame, outcomes: DataFrame, hierarchy: DataFrame, least: int, key: str = "report") -> dict[str, DataFrame]:
    """Nodes and edges for roles PS and SS from (report, role, compound) and (report, outcome), pruned at `least`."""
    tables = {}
    counts = compounds.select(key, "role", "compound").distinct().join(outcomes.distinct(), key).groupBy("role", "compound", "outcome").agg(F.count("*").alias("n_reports"))
    kept = written(prune(counts, "n_reports", least), "edges")  # all tables are made of these
    for role in ("PS", "SS"):
        tables[f"edge_{role.lower()}"] = kept.where(F.col("role") == role).drop("role")
    tables["node_compound"] = nodes_of([kept], "compound")
    tables["node_outcome"] = nodes_of([kept], "outcome")
    tables["edge_parent"] = hierarchy.join(tables["node_outcome"], "outcome", "left_semi")
    tables["node_parent"] = tables["edge_parent"].select("parent").na.drop().distinct()
    return tables


def repaired_nodes(edges: list[DataFrame], hierarchy: DataFrame) -> dict[str, DataFrame]:
    """Outcome nodes with their smallest name from edges (pt_code, pt_name), the parents of these, and parent nodes; hierarchy has one parent for each child."""
    node = nodes_of(edges, "pt_code", F.col("pt_name")).withColumnRenamed("name", "pt_name")
    edge = hierarchy.select("pt_code", "soc_code_primary", "soc_name_primary").join(node, "pt_code", "left_semi")
    parents = edge.select(F.col("soc_name_primary").alias("soc_name"), F.col("soc_code_primary").alias("soc_code")).distinct()
    return {"node_pt": node, "edge_pt_soc_primary": edge, "node_soc": parents}


def bilingual(df: DataFrame, key: str, name: str, english: DataFrame, other: DataFrame, out: str) -> DataFrame:
    """df with <out>_en (else its own name) and <out>_zh (else empty) from (code, label) tables."""
    df = labelled(df, key, english.withColumnRenamed("code", key), "label", F.coalesce(F.col(name), F.lit("")), f"{out}_en")
    return labelled(df, key, other.withColumnRenamed("code", key), "label", F.lit(""), f"{out}_zh")


def reference_reactions(node_pt: DataFrame, edge_soc: DataFrame, pt: tuple[DataFrame, DataFrame], soc: tuple[DataFrame, DataFrame], members: dict[str, DataFrame]) -> DataFrame:
    """Each outcome with labels in two languages, its parent (null if it has none) and a 0/1 flag for each graph; order by pt_code."""
    rows = node_pt.select("pt_code", "pt_name").join(edge_soc.select("pt_code", "soc_code_primary", "soc_name_primary"), "pt_code", "left").distinct()
    rows = bilingual(rows, "pt_code", "pt_name", *pt, "pt_name").withColumn("__none", F.lit(""))
    rows = bilingual(rows, "soc_code_primary", "__none", *soc, "soc_name")
    rows = flags(rows, "pt_code", members)
    return rows.select("pt_code", "pt_name_en", "pt_name_zh", "soc_code_primary", "soc_name_en", "soc_name_zh", *members)


def reference_compounds(nodes: DataFrame, key: str, members: dict[str, DataFrame]) -> DataFrame:
    """Each compound with its columns and a 0/1 flag for each graph; order by key."""
    return flags(nodes, key, members)


def reference_parents(reactions: DataFrame) -> DataFrame:
    """Distinct parents of reference_reactions with both names; those of outcomes without parent are left out. Order by soc_code_primary."""
    return reactions.select("soc_code_primary", "soc_name_en", "soc_name_zh").na.drop().distinct()

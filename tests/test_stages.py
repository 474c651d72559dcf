"""Stages run again when what they are made from has changed, and only then."""

import pytest
from pyspark.sql import functions as F

from sigweave.plans.stages import Stage, code_digest, run


def test_a_stage_follows_what_it_is_made_from(spark, tmp_path):
    source, root, ran = str(tmp_path / "in"), str(tmp_path / "out"), []
    spark.range(5).write.parquet(source)

    def load():
        ran.append("load")
        return spark.read.parquet(source)

    def more(df, step):
        ran.append("more")
        return df.select((F.col("id") + step).alias("id"))

    def total(df):
        ran.append("total")
        return df.agg(F.sum("id").alias("n"))

    def plan(step=1, version=""):
        return [Stage("load", (), load, inputs=(source,)), Stage("more", ("load",), more, {"step": step}, version=version), ("total", ["more"], total)]

    def made(**how):
        ran.clear()
        return run(spark, root, plan(**how))["total"].first().n, list(ran)

    assert made() == (15, ["load", "more", "total"])
    assert made() == (15, [])
    assert made(step=2) == (20, ["more", "total"])
    assert made(step=2, version="b") == (20, ["more", "total"])
    spark.range(5, 7).write.mode("append").parquet(source)
    assert made(step=2, version="b") == (35, ["load", "more", "total"])
    assert len([p for p in (tmp_path / "out" / "more").iterdir()]) == 1  # earlier outputs are gone
    # Output that is gone or was never finished is made again.
    (folder,) = (tmp_path / "out" / "total").iterdir()
    (folder / "_SUCCESS").unlink()
    assert made(step=2, version="b") == (35, ["total"])
    ran.clear()
    assert run(spark, root, plan(2, "b"), resume=False)["total"].first().n == 35 and len(ran) == 3


def test_half_written_output_does_not_count(spark, tmp_path):
    root, lost = str(tmp_path / "out"), [True]

    def stage():
        return spark.range(4).where(F.when(F.lit(lost[0]) & (F.col("id") == 3), F.raise_error(F.lit("lost"))).otherwise(True))

    with pytest.raises(Exception, match="lost"):
        run(spark, root, [Stage("a", (), stage)])
    assert not (tmp_path / "out" / "_ledger").exists()
    lost[0] = False
    assert run(spark, root, [Stage("a", (), stage)])["a"].count() == 4


def test_prerequisites_are_checked_before_anything_runs(spark, tmp_path):
    def never():
        raise AssertionError

    for bad in (
        [Stage("a", (), never), Stage("b", ("c",), never)], [Stage("a", (), never), Stage("a", (), never)], [Stage("", (), never)],
    ):
        with pytest.raises(ValueError):
            run(spark, str(tmp_path), bad)
    with pytest.raises(FileNotFoundError):
        run(spark, str(tmp_path), [Stage("a", (), never), Stage("b", (), never, inputs=(str(tmp_path / "none"),))])


def test_digests_of_code():
    def f(x):
        return x + 1

    def same(n):
        def f(x, k=n):
            return x + k

        return f

    assert code_digest(same(1)) == code_digest(same(1)) != code_digest(same(2)) and code_digest(f) == code_digest(f)
    assert code_digest(lambda x: x in {1, 2, 3}) == code_digest(lambda x: x in {1, 2, 3})

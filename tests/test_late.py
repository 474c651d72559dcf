"""Cases and weights as keyed state: any order of quarters and deletes, in any batches, gives what the batch job gives."""

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from sigweave.operators import cases, graph
from sigweave.sources import archive_source, ragged
from sigweave.streaming import late

DEMO = "primaryid$caseid$caseversion$i_f_code$fda_dt$event_dt$sex$age$reporter_country\n"


def archives():
    """(name, members): reports in several quarters and cases, versions that count and that don't, deletes before and after what they delete."""
    rng, out = random.Random(8), []
    for k in range(5):
        year, quarter = 2019 + k // 4, k % 4 + 1
        demo, drug, reac = DEMO, "primaryid$caseid$drug_seq$role_cod$drugname\n", "primaryid$caseid$pt\n"
        for _ in range(40):
            report, case = rng.randint(100, 130), rng.randint(1, 25)
            case = report % 25 + 1 if rng.random() < 0.8 else case
            demo += f"{report}${case}${rng.choice(['1', '12A', '10', ''])}${rng.choice('FI')}${rng.choice(['20190101', '201901', '20200505'])}$$M$1$US\n"
            drug += f"{report}${case}$1$PS$d{report % 4}\n{report}${case}$2$SS$d{report % 3}\n"
            reac += f"{report}${case}$r{report % 5}\n"
        dead = "".join(f"{rng.choice([rng.randint(100, 130), rng.randint(1, 25)])}\n" for _ in range(2)) if k != 1 else ""
        out.append((f"faers_ascii_{year}q{quarter}.zip", f"{year % 100}Q{quarter}", {"demo": demo, "drug": drug, "reac": reac} | ({"delete": dead} if dead else {})))
    return out


def put(folder, name, quarter, members):
    with zipfile.ZipFile(folder / f"_{name}x", "w") as z:
        for kind, body in members.items():
            z.writestr(f"{kind.upper()}{quarter}.txt", body)
    (folder / f"_{name}x").rename(folder / name)


def rows(df):
    return sorted(tuple(r) for r in df.select(*cases.CASE_COLUMNS).collect())


@pytest.mark.parametrize("batches", [[[4], [0, 2, 1, 3]], [[3, 1], [2, 4], [0]]])
def test_any_order_gives_what_the_batch_job_gives(spark, tmp_path, batches):
    folder, all_ = tmp_path / "in", archives()
    folder.mkdir()
    root, seen = str(folder), []

    def facts(table):
        return ragged.parse(archive_source.lines(spark, root, table), table)

    def also(changes, batch_id):
        compounds, outcomes = facts("drug").withColumn("compound", F.col("drugname")), facts("reac").withColumn("outcome", F.col("pt"))
        late.add_changes(spark, str(tmp_path / "pairs"), batch_id, late.pair_deltas(changes, compounds, outcomes), ["compound", "outcome"], "n_reports")
        if len(seen) == 1 and not crashed:
            crashed.append(True)
            raise RuntimeError("lost")  # after the pairs of this batch, before its cases

    crashed = []
    for some in batches:
        for k in some:
            put(folder, *all_[k])
        seen.append(some)
        while True:
            try:
                got = late.cases_available(spark, root, str(tmp_path / "cases"), str(tmp_path / "mark"), also=also)
                break
            except Exception as e:
                assert "lost" in str(e)
                seen.pop()
                seen.append(some)
        want = cases.cases_from_archives(spark, root)
        assert rows(got) == rows(want.withColumn("zip_name", F.col("zip")))
        chosen = want.select("year", "quarter", "primaryid")
        c = facts("drug").join(chosen, ["year", "quarter", "primaryid"]).select(F.col("primaryid").alias("report"), F.col("drugname").alias("compound")).distinct()
        o = facts("reac").join(chosen, ["year", "quarter", "primaryid"]).select(F.col("primaryid").alias("report"), F.col("pt").alias("outcome")).distinct()
        pairs = c.join(o, "report").groupBy("compound", "outcome").agg(F.count("*").alias("n"))
        assert sorted(map(tuple, late.current(spark, str(tmp_path / "pairs")).collect())) == sorted(map(tuple, pairs.collect()))
        assert len([p for p in (tmp_path / "pairs").iterdir()]) <= 3
    assert crashed and rows(got)


def test_changes_are_added_once(spark, tmp_path):
    path = str(tmp_path / "t")
    some = lambda *r: spark.createDataFrame(list(r), "k string, n int")
    late.add_changes(spark, path, 0, some(("a", 2), ("b", 1)), ["k"], "n")
    for _ in range(3):
        late.add_changes(spark, path, 1, some(("a", 1), ("b", -1), ("c", 5)), ["k"], "n")
    assert sorted(map(tuple, late.current(spark, path).collect())) == [("a", 3), ("c", 5)]
    for batch in range(2, 6):
        late.add_changes(spark, path, batch, some(("a", 1)), ["k"], "n")
    assert sorted(map(tuple, late.current(spark, path).collect())) == [("a", 7), ("c", 5)] and len(list((tmp_path / "t").iterdir())) == 2
    assert late.current(spark, str(tmp_path / "none")) is None

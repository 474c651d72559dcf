"""What keeps the work of large tables small: passes, exchanges and what Python is given."""

import io

from pyspark.sql import functions as F

from sigweave.operators import cases, dedup, graph, match, reactions
from sigweave.plans import catalog, catalog_cases
from sigweave.sources import ragged

SF = "/root/testdata/sf0.001"


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def without_broadcasts(spark, make):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return exchanges(make())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_counts_over_some_and_all_roles_are_of_one_meeting(spark):
    c = spark.createDataFrame([(1, "PS", "a"), (1, "C", "a"), (1, "C", "b"), (2, "C", "a"), (2, "SS", " "), (3, None, "a")], "report int, role string, compound string")
    o = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "x")], "report int, outcome string")
    weights = graph.pair_weights(c, o)
    assert sorted(map(tuple, weights.collect())) == [("a", "x", 1, 3), ("a", "y", 1, 1), ("b", "x", 0, 1), ("b", "y", 0, 1)]
    got = graph.tables_of_weights(weights, 1, include_any=True)
    assert sorted(map(tuple, got["pairs"].collect())) == [("a", "x", 1), ("a", "y", 1)] and got["any"].count() == 4 and graph.pair_tables(c, o, 1)["any"].count() == 0


def test_facts_by_code_are_told_apart_by_numbers(spark):
    facts = spark.createDataFrame([(1, 1, "A"), (1, 1, "B"), (1, 1, "A"), (2, 2, "B"), (2, 2, "C"), (3, 3, "D")], "primaryid bigint, caseid bigint, pt_norm string")
    before = spark.createDataFrame([("A", "1", "one", "PT"), ("B", "1", "one", "PT"), ("C", "", "", "NO"), ("D", "2", None, "PT")], "pt_norm string, code string, name string, map_source string")
    after = before.where("pt_norm <> 'C'").unionByName(spark.createDataFrame([("C", "1", "one", "MANUAL")], before.schema))
    over = spark.createDataFrame([("C",)], "pt_norm string")
    base = reactions.facts_by_code(facts, before)
    assert sorted(map(tuple, base.collect()), key=str) == [(1, 1, "1", "one", "PT"), (2, 2, "1", "one", "PT"), (3, 3, "2", None, "PT")]
    as_rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert as_rows(reactions.counts_by_code(facts, before)) == as_rows(reactions.code_counts(base))
    assert as_rows(reactions.facts_after(facts, before, after, over)) == as_rows(reactions.refreshed_facts(base, facts, after, over))


def test_reports_are_brought_together_once_for_deletion_and_choice(spark):
    # One row of each report and case is chosen before cases' deletions are looked for: three choices, where there were two.
    plan = catalog_cases.case_latest(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [row_number()") == 3
    demo = spark.createDataFrame([("10", "7", 1, 1), ("10", "8", 2, 2), ("10", "8", 1, 3), ("11", "7", 1, 4)], "primaryid string, caseid string, quarter int, ingest_ordinal int")
    demo = demo.withColumns({"year": F.lit(2020), "caseversion": F.lit("10"), "i_f_code": F.lit("F"), "fda_dt": F.lit(""), "event_dt": F.lit("")})
    chosen = lambda *ids: sorted((r.caseid, r.ingest_ordinal) for r in dedup.latest_cases(demo, spark.createDataFrame([(i,) for i in ids], "id string")).collect())
    # The report's latest row goes with its case 8; its row of case 7 stands for it then.
    assert chosen("none") == [("7", 4), ("8", 2)] and chosen("8") == [("7", 4)] and chosen("8", "11") == [("7", 1)]


def test_counters_in_one_pass(spark):
    rows = [("z1", 1, "5", None, "1", "ps", "Aspirin", ""), ("z1", 2, "5", "9", " 1", "PS", "aspirin ", ""), ("z0", 3, "5", "8", "1", "ps", "aspirin", "x"), ("z1", 4, "", "9", "1", "ps", "a", "b"), ("z1", 5, None, "9", "1", "ps", "a", "b"), ("z2", 6, "6", "9", "1", "ps", "a", "b"), ("z0", 7, "5", "8", "1", "ps", "ASPIRIN", " X")]
    rows = spark.createDataFrame(rows, "zip string, line_no bigint, primaryid string, caseid string, drug_seq string, role_cod string, drugname string, prod_ai string")
    rows = rows.withColumns({"year": F.lit(2020), "quarter": F.lit(1), "route": F.lit(""), "dose_vbm": F.lit(""), "val_vbm": F.lit("")} | {c: (F.col("line_no") % 2).cast("int") for c in ("trimmed", "padded", "folded")})
    chosen = spark.createDataFrame([(2020, 1, "5", "8")], "year int, quarter int, primaryid string, caseid string")
    want = cases.parse_counters(rows, cases.all_drug_facts(rows, chosen), cases.drug_facts(rows, chosen))
    got = cases.drug_counters(rows, chosen)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert without_broadcasts(spark, lambda: catalog_cases.fact_counters(spark, SF)) == 5


def test_lines_of_members_are_cut_as_by_csv(spark, monkeypatch):
    monkeypatch.setattr(ragged, "BLOCK", 7)
    text = 'a$b\n1$"x\ny"$2\n\n3$q"q\n"4\r\n5"\r\n6$7\r\n8'
    of = lambda table, token=None: list(ragged._rows_of(io.StringIO(text, newline="\n"), table, token))
    assert of("demo") == ["a$b", '1$"x\ny"$2', "", '3$q"q', '"4\r\n5"', "6$7", "8"]
    assert of("reac", "$") == ["a", "$b", "1", '$"x', 'y"', "$2", "", "3", '$q"q', '"4', '5"', "6", "$7", "8"]
    cells = ragged.quoted_cells(spark.createDataFrame([('a$"b$c"$',), ("a$$",), ("",), (None,)], "line string"))
    assert [r.cells for r in cells.select("cells").collect()] == [["a", "b$c", ""], ["a", "", ""], [""], [""]]
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and catalog.queries()["archive_rows"]


class _State:
    """A value and a list of state that count the calls."""

    def __init__(self):
        self.calls, self.value, self.list = 0, None, []

    def getListState(self, name, schema):
        return self

    def getValueState(self, name, schema):
        return _Value(self)

    def get(self):
        self.calls += 1
        return iter(self.list)

    def appendList(self, rows):
        self.calls, self.list = self.calls + 1, self.list + rows

    def put(self, rows):
        self.calls, self.list = self.calls + 1, list(rows)

    def clear(self):
        self.calls, self.list = self.calls + 1, []


class _Value:
    def __init__(self, state):
        self.state = state

    def get(self):
        self.state.calls += 1
        return self.state.value

    def update(self, value):
        self.state.calls, self.state.value = self.state.calls + 1, value

    def clear(self):
        self.update(None)


def test_a_key_costs_a_few_calls_of_the_state():
    from sigweave.streaming import late

    state, keyed = _State(), late._Keyed("caseid", "first")
    keyed.init(state)
    row = lambda i, sign=1: late._EVENT("k", sign, *({"id": str(i), "first": f"{i:05}", "caseid": "c"}.get(c) for c in late._NAMES))
    run = lambda *rows: [(r.sign, r.id) for r in keyed.handleInputRows(("k",), iter(rows), None)]
    assert run(*map(row, range(1000))) == [(1, "999")] and state.calls <= 4
    assert run(row(2000)) == [(-1, "999"), (1, "2000")]
    assert run(row(2000, -1), row(999, -1)) == [(-1, "2000"), (1, "998")] and run(row(3, -1)) == []
    assert run(late._EVENT("k", late.DELETE, *[None] * len(late._NAMES))) == [(-1, "998")] and run(row(7)) == []


def test_bridged_ids_travel_in_lists(spark):
    """Lists of targets go whole to an id that has few of them; pairs are dealt out for others alone, and both ways give the same."""
    rel = spark.createDataFrame([(f"w{i}", f"m{j}") for i in range(6) for j in range(i + 1)] + [(f"k{i}", f"m{i % 4}") for i in range(9)] + [("w1", "k1"), ("w1", "k1"), ("w2", "w2")], "a string, b string")
    ids = lambda p, n: spark.createDataFrame([(f"{p}{i}",) for i in range(n)], "id string")
    made = [match.bridge(rel, ids("w", 6), ids("k", 9).unionByName(ids("w", 1)), chunk=2, most=m) for m in (0, 5, 1 << 16)]
    got = [sorted(map(tuple, df.collect())) for df in made]
    wanted = {(f"w{i}", f"k{k}") for i in range(1, 6) for k in range(9) if k % 4 <= i} | {("w0", f"k{k}") for k in (0, 4, 8)} | {(f"w{i}", "w0") for i in range(1, 6)} | {("w1", "k1")}
    assert got[0] == got[1] == got[2] == sorted(wanted)
    assert "array_distinct(flatten(collect_list(targets" in made[0]._jdf.queryExecution().optimizedPlan().toString()

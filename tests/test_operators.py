"""Operators against small cases worked out by hand, and properties."""

import json
import random
import threading

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipweave import config
from clipweave.functions import text as X
from clipweave.operators import captions, catalog, folds, intervals, library, planner, transcripts

RULES = config.SliceRules()


@pytest.mark.parametrize(
    ("duration", "scenes", "cuts"),
    [
        (9.9, [], []), (10.0, [], [(0, 10)]), (15, [], [(0, 7.5), (7.5, 15)]), (20, [], [(0, 10), (10, 20)]), (20, [5, 12], [(0, 5), (5, 12), (12, 20)]),
        (30, [1, 2, 3, 15], [(0, 2), (2, 8.5), (8.5, 15), (15, 22.5), (22.5, 30)]), (25, [7, 13, 21], [(0, 7), (7, 13), (13, 21), (21, 25)]),
        (12, [5.0, 5.25], [(0, 5), (5.25, 12)]), (20, [10, 18.5], [(0, 10), (10, 18.5)]),
    ],
)
def test_plan_cuts(spark, duration, scenes, cuts):
    assert plans(spark, [(duration, scenes)])[0] == cuts


def plans(spark, sources):
    rows = spark.createDataFrame([(i, float(d), [float(x) for x in s]) for i, (d, s) in enumerate(sources)], "i int, duration double, scenes array<double>")
    return [[tuple(c) for c in r["cuts"]] for r in intervals.with_cuts(rows, "duration", "scenes").orderBy("i").collect()]


def test_plan_cuts_are_ordered_and_long_enough(spark):
    rng = random.Random(4)
    sources = [(rng.uniform(10, 300), sorted(rng.uniform(0, 300) for _ in range(rng.randint(0, 30)))) for _ in range(200)]
    for cuts in plans(spark, sources):
        assert all(b - a >= RULES.shortest - RULES.slack - 0.02 for a, b in cuts)
        assert all(x[1] <= y[0] + 1e-9 for x, y in zip(cuts, cuts[1:]))


@pytest.mark.parametrize(
    ("cuts", "sentences", "snapped"),
    [([(0, 5), (5, 12), (12, 20)], [(4, 6), (6, 13)], [(0, 6), (6, 13), (13, 20)]), ([(0, 20)], [(0, 20)], [(0, 8), (8, 16), (16, 20)]), ([(0, 5), (5, 9)], [], [(0, 5), (5, 9)])],
)
def test_snap_cuts(spark, cuts, sentences, snapped):
    row = spark.createDataFrame([([tuple(map(float, c)) for c in cuts], [tuple(map(float, x)) for x in sentences])], f"cuts {intervals.CUTS}, said {intervals.CUTS}")
    assert [tuple(c) for c in row.select(intervals.snapped(F.col("cuts"), F.col("said")).alias("c")).first()["c"]] == snapped


def test_with_cuts_keeps_rows(spark):
    rows = spark.createDataFrame([("a", 20.0, [5.0, 12.0]), ("b", 5.0, None), ("c", None, [])], "id string, duration double, scenes array<double>")
    got = {r["id"]: [tuple(c) for c in r["cuts"]] for r in intervals.with_cuts(rows, "duration", "scenes").collect()}
    assert got == {"a": [(0, 5), (5, 12), (12, 20)], "b": [], "c": []}


@pytest.fixture
def within_a_minute(spark):
    """Jobs that take longer are stopped, and their test fails."""
    timer = threading.Timer(60, spark.sparkContext.cancelAllJobs)
    timer.start()
    yield
    timer.cancel()


def test_snapping_a_long_source(spark, within_a_minute):
    n = 4000
    cuts, said = [(5.0 * i, 5.0 * i + 5) for i in range(2 * n)], [(10.0 * i + 4, 10.0 * i + 6) for i in range(n)]
    row = spark.createDataFrame([(cuts, said)], f"cuts {intervals.CUTS}, said {intervals.CUTS}")
    wanted = [x for i in range(n) for x in [(10.0 * i, 10.0 * i + 6), (10.0 * i + 6, 10.0 * i + 10)]]
    assert [tuple(c) for c in row.select(intervals.snapped(F.col("cuts"), F.col("said")).alias("c")).first()["c"]] == wanted


def test_plan_of_a_long_source(spark, within_a_minute):
    n = 20_000  # short parts of 1 s, stretches of 6 s, and one too long at the end
    scenes = [t for i in range(n) for t in (7 * i + 1, 7 * i + 7)]
    cuts = plans(spark, [(7 * n + 16, scenes)])[0]
    assert cuts == [(7 * i, 7 * i + 7) for i in range(n)] + [(7 * n, 7 * n + 8), (7 * n + 8, 7 * n + 16)]


def test_snapping_leaves_what_it_need_not_change(spark):
    rows = spark.createDataFrame([(0, [(0.001, 5.0)], []), (1, [(0.001, 5.0)], None), (2, None, [(1.0, 2.0)]), (3, [], [(1.0, 2.0)])], f"i int, cuts {intervals.CUTS}, said {intervals.CUTS}")
    got = {r["i"]: r["c"] and [tuple(c) for c in r["c"]] for r in rows.select("i", intervals.snapped(F.col("cuts"), F.col("said")).alias("c")).collect()}
    assert got == {0: [(0.001, 5.0)], 1: [(0.001, 5.0)], 2: None, 3: []}


def test_gap_dedup(spark):
    rows = spark.createDataFrame([("a", t) for t in (1000, 1100, 1250, 1310, 2000)] + [("b", None)], "k string, t bigint")
    assert sorted(r["t"] for r in folds.gap_dedup(rows.where("t is not null"), "k", "t", 200).collect()) == [1000, 1250, 2000]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=60), st.integers(1, 400))
def test_gap_dedup_is_the_fold(spark, times, gap):
    kept = []
    for t in sorted(times):
        if not kept or t - kept[-1] > gap:
            kept.append(t)
    rows = spark.createDataFrame([("k", t) for t in times], "k string, t bigint")
    assert sorted(r["t"] for r in folds.gap_dedup(rows, "k", "t", gap).collect()) == kept


@pytest.mark.parametrize(("sizes", "batches"), [([600, 500, 500], [0, 1, 1]), ([1500, 100], [0, 1]), ([0, 1500, 0], [0, 1, 2]), ([400, 600, 1], [0, 0, 1])])
def test_size_batches(spark, sizes, batches):
    rows = spark.createDataFrame([("s", i, n) for i, n in enumerate(sizes)], "k string, i bigint, size bigint")
    got = folds.size_batches(rows, "k", ["i"], "size", 1000, ["i"]).orderBy("i").collect()
    assert [r["batch"] for r in got] == batches


def test_refined(spark):
    rows = spark.createDataFrame([(1, 0, 12000, "你好。再见吧"), (2, 0, 9000, "你好。再见吧")], "id int, start_ms bigint, end_ms bigint, text string")
    got = [tuple(r) for r in transcripts.refined(rows, ["id"]).select("id", "start_ms", "end_ms", "text").orderBy("id", "start_ms").collect()]
    assert got == [(1, 0, 6000, "你好。"), (1, 6000, 12000, "再见吧"), (2, 0, 9000, "你好。再见吧")]


def test_repeats_and_unfinished(spark):
    kind = "id int, n int, start_ms bigint, end_ms bigint, text string"
    twice = spark.createDataFrame([(1, 0, 0, 2, "今天天气很好"), (1, 1, 2, 4, "今天天气很好呀"), (1, 2, 4, 6, "完全不同")], kind)
    assert [(r["start_ms"], r["end_ms"], r["text"]) for r in transcripts.without_repeats(twice, "id", ["n"]).orderBy("start_ms").collect()] == [(0, 4, "今天天气很好呀"), (4, 6, "完全不同")]
    parts = spark.createDataFrame([(1, 0, 0, 2000, "什么原因呢"), (1, 1, 2000, 4000, "是老鼠"), (1, 2, 4000, 6000, "很快")], kind)
    assert [(r["start_ms"], r["end_ms"], r["text"]) for r in transcripts.merged(parts, "id", ["n"]).orderBy("start_ms").collect()] == [(0, 4000, "什么原因呢 是老鼠"), (4000, 6000, "很快")]


def test_captions(spark):
    text = "你敢相信吗，用啤酒来消灭老鼠，那是又快又猛又狠。"
    rows = captions.lines(spark.createDataFrame([(1, text)], "id int, text string"), ["id"], "text", 13, config.CAPTION_MARKS).orderBy("line_no").collect()
    assert len(rows) == 3 and all(len(r["line"]) <= 13 for r in rows) and "".join(r["line"] for r in rows) == text
    timed = captions.timed(spark.createDataFrame([(1, 0, "ab", 10000), (1, 1, "abcd", 10000)], "id int, line_no int, line string, total bigint"), ["id"], "total")
    assert [(r["start_ms"], r["end_ms"]) for r in timed.orderBy("line_no").collect()] == [(0, 3333), (3333, 10000)]
    assert captions.events(timed).orderBy("line_no").first()["event"] == "Dialogue: 0,0:00:00.00,0:00:03.33,sub,,0,0,0,,ab"


def test_expressions(spark):
    row = spark.range(1).select(
        X.seconds_to_say(F.lit("灭鼠颗粒19元11包，安全灭鼠。")).alias("say"), X.source_prefix(F.lit("abc_1_x")).alias("prefix"), X.suffix(F.lit(".txt")).alias("none"), X.suffix(F.lit("notes.TXT")).alias("txt"),
        X.highlighted(F.lit("19元")).alias("red"), X.ustrip(F.lit("　a ")).alias("strip"), X.sample_times(F.lit(12000).cast("long")).alias("times"), X.safe_name(F.lit("a b/c?.mp4")).alias("safe"),
        X.picture_size(F.lit("720x1280"))[0].alias("w"), X.picture_size(F.lit("wide"))[1].alias("h"), X.clock(F.lit(3723450)).alias("clock"), X.sentences(F.lit("好。 很好！")).alias("parts"),
    ).first()
    assert row["say"] == 3.6 and row["prefix"] == "abc" and row["none"] == "" and row["txt"] == ".txt" and row["strip"] == "a" and row["times"] == [1000, 6000, 11000]
    assert row["red"] == r"{\c&H0000FF&}19元{\c&HFFFFFF&}" and row["safe"] == "a_bc.mp4" and row["w"] == 720 and row["h"] == 1920 and row["clock"] == "1:02:03.45" and row["parts"] == ["好", "很好"]


@pytest.mark.parametrize(("script", "found"), [("19元11包", []), ("25元一包", ["price"]), ("11元", []), ("蓝色颗粒", ["colour"]), ("根治", ["forbidden: 根治"])])
def test_violations(spark, script, found):
    got = spark.range(1).select(X.violations(F.lit(script), F.lit("19元11包"), F.lit("红色颗粒"), F.array(F.lit("根治"))).alias("v")).first()["v"]
    assert got == found


def test_catalog(spark):
    rows = [(1, "a.mp4", "m1"), (2, "b.mp4", "m1"), (3, ".DS_Store", "m2"), (4, "notes.TXT", "m3"), (5, "c.mp4", ""), (6, "._x.mp4", "m4"), (7, ".txt", "m5"), (8, "d.mp4", None)]
    got = {r["scan_ord"]: r["class"] for r in catalog.classified(spark.createDataFrame(rows, "scan_ord int, name string, md5 string"), "name", "md5", "scan_ord").collect()}
    assert got == {1: "kept", 2: "duplicate", 3: "junk", 4: "document", 5: "kept", 6: "junk", 7: "kept", 8: "kept"}


def test_tree_paths_of_any_depth(spark):
    kind = "node int, parent int, name string"
    got = {r["node"]: (r["path"], r["depth"]) for r in catalog.tree_paths(spark.createDataFrame([(i, i - 1 if i else None, f"n{i}") for i in range(70)], kind), "node", "parent", "name").collect()}
    assert got == {i: ("/".join(f"n{j}" for j in range(i + 1)), i) for i in range(70)}
    with pytest.raises(ValueError, match="cycle"):
        catalog.tree_paths(spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (1, 2, "a")], kind), "node", "parent", "name")


def test_resume(spark):
    ledger = spark.createDataFrame([("abc", "done"), ("bad", "failed"), ("", "done"), ("short", "skipped_short")], "md5 string, status string")
    sources = spark.createDataFrame([("abc",), ("bad",), ("",), ("short",), ("new",), (None,)], "md5 string")
    assert {r["md5"] for r in catalog.unprocessed(sources, ledger, "md5", F.col("status") == "failed").collect()} == {"bad", "", "new", None}


def test_library(spark):
    lines = spark.createDataFrame([("- abc_001_x.mp4 | 6.0s | 开头 | 你敢相信吗",), ("- notavideo.txt | 3s | x | y",), ("- def_002.mp4 | 5.5s | 痛点 | 老鼠太多了",), ("text",), ("- g.mp4 | soon",)], "line string")
    rows = library.index_rows(lines).orderBy("name").collect()
    assert [(r["name"], r["duration"], r["speech"]) for r in rows] == [("abc_001_x.mp4", 6.0, "你敢相信吗"), ("def_002.mp4", 5.5, "老鼠太多了")]
    table = spark.createDataFrame([("| # | key | status |",), ("|---|---|---|",), ("| 1 | abc | done |",), ("|  | x | y |",), ("| 2 | def | failed |",)], "line string")
    assert [tuple(r) for r in library.ledger_rows(table, ["key", "status"]).orderBy("key").collect()] == [("abc", "done"), ("def", "failed")]


def test_align(spark):
    rows = spark.createDataFrame([(t, [4.0, 6.0, 5.0, 7.0]) for t in (21.0, 24.0, 20.0)] + [(9.0, [5.0]), (9.0, [])], "target double, durations array<double>")
    got = [(r["target"], r["out_durations"], r["speeds"]) for r in planner.aligned(rows, "durations", "target").collect()]
    assert (21.0, [4, 5.63, 5, 6.36], [1, 1.065, 1, 1.1]) in got and (9.0, [5.0], [1.0]) in got and (9.0, [], []) in got
    sums = {t: sum(d) for t, d, _ in got if len(d) == 4}
    assert abs(sums[24.0] - 24) < 0.15 and abs(sums[20.0] - 20.36) < 0.15


def test_seeded_plans(spark):
    clips = [(f"c{i}", i * 10 + j, f"s{i}{j}", 5.0 + j, 100 if j == 0 else 0) for i in range(5) for j in range(6)]
    df = spark.createDataFrame(clips, "category string, clip_id bigint, source string, duration double, usage bigint")
    one, two = ([tuple(r) for r in planner.seeded_plans(df, [1, 2], "c0", 20.0).orderBy("seed", "place").collect()] for _ in range(2))
    assert one == two
    for seed in (1, 2):
        mine = [r for r in one if r[0] == seed]
        assert mine[0][2] == "c0" and sum(r[4] for r in mine[1:]) >= 20 and all(r[3] % 10 for r in mine)


def test_seeded_plans_count_earlier_uses(spark):
    clips = [(f"c{i}", i * 10 + j, f"s{i}", 5.0, j) for i in range(3) for j in range(3)]
    df = spark.createDataFrame(clips, "category string, clip_id bigint, source string, duration double, usage bigint")
    seeds, uses = [5, 3, 9, 1, 7, 2], {c[1]: c[4] for c in clips}
    got = [tuple(r) for r in planner.seeded_plans(df, seeds, "c0", 10.0).collect()]
    for seed in seeds:
        mine = [r[3] for r in got if r[0] == seed]
        assert len(mine) == 3 and all(uses[c] == min(uses[c // 10 * 10 + j] for j in range(3)) for c in mine)
        for c in mine:
            uses[c] += 1


def test_overlap_join(spark):
    segments = spark.createDataFrame([(1, 0, 0, 5000), (1, 1, 5000, 12000), (1, 2, 20000, 21000), (2, 5, 4000, 6000)], "k int, seg_id int, s bigint, e bigint")
    spoken = spark.createDataFrame([(1, 7, 4000, 5500, "x"), (1, 8, 6000, 7000, "y")], "k int, sent_id int, ss bigint, se bigint, said string")
    got = {r["seg_id"]: r["speech"] for r in intervals.spoken_text(segments, spoken, "k", width=3000).collect()}
    assert got == {0: "x", 1: "y", 2: "", 5: ""}
    twin = spark.createDataFrame([(1, 0, 0, 5000), (2, 0, 0, 5000)], "k int, seg_id int, s bigint, e bigint")
    assert sorted((r["k"], r["speech"]) for r in intervals.spoken_text(twin, spoken, "k").collect()) == [(1, "x"), (2, "")]


def test_row_list(spark, tmp_path):
    from clipweave import sources

    (tmp_path / "form.csv").write_text('item,plan,fill\na,all,"3, 1，2\n9\n 4 \nx,0,99999999999999999999"\nb,all,\nc,1,7\n')
    got = {r["item"]: r["rows"] for r in sources.task_form(spark, str(tmp_path / "form.csv")).select("item", sources.row_list(F.col("answer"), 5).alias("rows")).collect()}
    assert got == {"a": [3, 1, 2, 4], "b": [1, 2, 3, 4, 5], "c": []}


def test_sources_and_stream(spark, tmp_path):
    from clipweave import sources, streaming

    (tmp_path / "form.csv").write_text("item,plan,fill\na,1,\nb,2, 3 \n")
    assert {tuple(r) for r in sources.task_form(spark, str(tmp_path / "form.csv")).collect()} == {("a", "1"), ("b", "3")}
    (tmp_path / "usage.json").write_text(json.dumps({"x": 2}))
    assert [tuple(r) for r in sources.usage(spark, str(tmp_path / "usage.json")).collect()] == [("x", 2)]
    (tmp_path / "bad.json").write_text("{")
    assert sources.usage(spark, str(tmp_path / "bad.json")).count() == 0
    (tmp_path / "d.json").write_text(json.dumps([{"index": 1, "start": 0.0, "end": 2.0, "category": "c", "more": 1}]))
    with pytest.raises(ValueError, match="more"):
        sources.decisions(spark, str(tmp_path / "d.json"))
    assert sources.files(spark, str(tmp_path), "*.csv", hash_content=True).first()["name"] == "form.csv"
    spark.createDataFrame([("a",), ("b",)], "md5 string").write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        streaming.ingest(spark, str(tmp_path / "in"), "md5 string", str(tmp_path / "ledger"), "md5", lambda d: d.withColumn("status", F.lit("done")), str(tmp_path / "ck")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 2


def test_export_names_from_1000_up(spark, tmp_path):
    from clipweave.plans.queries import QUERIES

    rows = spark.range(1, 1203).selectExpr("id AS o_orderkey", "7L AS o_custkey", "IF(id = 1001, 'F', 'O') AS o_orderstatus", "'2-HIGH' AS o_orderpriority")
    rows.write.parquet(str(tmp_path / "orders.parquet"))
    got = {r["o_orderkey"]: r["name"][8:] for r in QUERIES["export_names"](spark, str(tmp_path)).collect()}
    assert got == {i: f"_{i:03d}_2-HIGH.mp4" for i in range(1, 1203) if i != 1001}


def test_queries_match_sql(spark):
    """Every query that has SQL, on the smallest tables."""
    import duckdb
    from pandas.api.types import is_numeric_dtype

    from clipweave.plans.queries import QUERIES, SQL

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    for name, sql in SQL.items():
        mine, other = QUERIES[name](spark, folder).toPandas(), con.sql(sql).df()
        assert sorted(mine.columns) == sorted(other.columns), name
        cols = sorted(mine.columns)
        for c in cols:  # integers with nulls are floats in one library's frames and nullable integers in the other's
            if all(is_numeric_dtype(x[c]) and x[c].isna().any() for x in (mine, other)):
                mine[c], other[c] = mine[c].convert_dtypes(), other[c].convert_dtypes()
        a, b = (x[cols].astype(str).sort_values(cols).reset_index(drop=True) for x in (mine, other))
        assert a.equals(b), name
    for name in set(QUERIES) - set(SQL):
        assert QUERIES[name](spark, folder).count() > 0


def test_ledger_layouts(spark):
    from clipweave.operators import ledgers

    text = "# T\n## A\n| # | x |\n|---|---|\n| 1 | p | f.mp4 | abc123 | 1MB | 5 | out | done | 2024 |\n| 2 | p | g.mp4 | def456 | 1MB | ² | out | skipped_short | a note | 2025 |\n|  | x | y |\n| 3 | few |\n## B\n| 1 | s | v | 2 | o | done | t |\n| 2 | s | v | x | o | done | t | 7 | b |"
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(text.split("\n"))], "file string, line_no int, line string")
    rows = {r["md5"]: r for r in ledgers.slice_rows(ledgers.table_cells(lines, "## A")).collect()}
    assert set(rows) == {"abc123", "def456"} and (rows["abc123"]["note"], rows["abc123"]["time"], rows["abc123"]["slice_count"]) == ("", "2024", 5)
    assert (rows["def456"]["note"], rows["def456"]["time"], rows["def456"]["slice_count"]) == ("a note", "2025", 0)
    assert sorted((r["count"], r["seed"], r["batch"]) for r in ledgers.mix_rows(ledgers.table_cells(lines, "## B")).collect()) == [(0, "7", "b"), (2, "", "")]
    new = spark.createDataFrame([("x", ""), ("y", "then"), ("z", None)], "md5 string, time string")
    assert {r["md5"]: r["time"] for r in ledgers.appended(new.limit(0), new, "time", F.lit("now")).collect()} == {"x": "now", "y": "then", "z": "now"}


def test_numbered_rows(spark):
    from clipweave.operators import ledgers

    got = ledgers.numbered(spark.range(500).select((F.col("id") * 7 % 500).alias("k")).repartition(7), ["k"]).collect()
    assert {r["k"]: r["number"] for r in got} == {i: i + 1 for i in range(500)}


def test_decisions(spark):
    from clipweave.operators import decisions

    rows = spark.createDataFrame([("a", 1, 0.0, 5.0, "产品介绍"), ("a", 2, 4.0, 6.0, "产品介绍"), ("a", 3, 6.0, 6.0, "待复核"), ("b", 1, 0.0, 2.0, None)], "k string, index int, start double, end double, category string")
    assert {tuple(r) for r in decisions.faults(rows, "k").collect()} == {("a", 2, "overlap"), ("a", 3, "span"), ("a", 3, "category"), ("b", 1, "category")}
    files = spark.createDataFrame([("abcdefgh", 1), ("abcdefgh99", 2)], "name string, plan int")
    sources = spark.createDataFrame([("abcdefgh99",), ("abcdefgh11",), ("zzz",), (None,)], "md5 string")
    assert {r["md5"]: r["plan"] for r in decisions.looked_up(sources, files, "md5", "name", "plan").collect()} == {"abcdefgh99": 2, "abcdefgh11": 1, "zzz": None, None: None}
    assert decisions.faults(decisions.template(rows, ["k"]), "k").where("fault = 'category'").count() == 4


def test_forms(spark):
    from clipweave.operators import forms

    answers = spark.createDataFrame([(1, "状态", " 完成 "), (2, "处理范围", "a\nb\n"), (3, "混剪成片数", "x"), (4, "去重强度", "强"), (5, "状态", "OK")], "line_no int, item string, answer string")
    got = forms.settings(answers, ("a", "c"), 2).first()
    assert got["ready"] and got["scopes"] == ["a"] and got["mix_count"] == 5 and got["strength"] == "强" and got["mix_rows"] == [1, 2] and got["do_slice"] and got["size"] == "1080x1920"
    assert got["warnings"] == ["unknown scope: b", "the number of mixes is none"]
    scripts = spark.createDataFrame([(1, "19元11包"), (2, " "), (5, "25元一包")], "number int, text string")
    price = (F.lit("19元11包"), F.lit(""), F.array(F.lit("根治")))
    assert [(r["number"], r["fault"]) for r in forms.to_form(scripts, *price).collect()] == [(5, "price")]
    assert [(r["number"], r["seconds"]) for r in forms.to_form(scripts.where("number < 5"), *price).collect()] == [(1, 1.3)]
    tree = forms.simple_yaml("a: 1  # one\nb:\n  c: yes\n  d:\n    - x\n    - 'y z'\n# no\nlist:\n- 2\n- three\n")
    assert tree == {"a": 1, "b": {"c": True, "d": ["x", "y z"]}, "list": [2, "three"]} and forms.setting(tree, "b.c") is True and forms.setting(tree, "b.q", 5) == 5
    sheet = spark.createDataFrame([(1, "k", "v1"), (2, "", "v2"), (3, "m", None), (4, " ", "v3")], "at int, label string, value string").withColumn("f", F.lit(1))
    assert {r["label"]: r["values"] for r in forms.sheet_rows(sheet, ["f"], "at").collect()} == {"k": ["v1", "v2"], "m": ["v3"]}


def test_media(spark):
    from clipweave.operators import media

    bad = spark.createDataFrame([("{",), ("{}",), (None,), ('{"streams":[{"codec_type":"video","width":0,"height":5},{"codec_type":"video","width":4,"height":8,"r_frame_rate":"30000/1001"}],"format":{}}',)], "j string")
    got = [r["i"] for r in bad.select(media.probed(F.col("j")).alias("i")).collect()]
    assert [(i["width"], i["duration"], i["has_audio"], i["fps"]) for i in got[:3]] == [(0, 0.0, False, 0.0)] * 3
    assert got[3]["height"] == 8 and got[3]["fps"] == pytest.approx(29.97, abs=0.01)
    row = spark.range(1).select(media.sample_name(F.lit(12000)).alias("s"), media.drawn_text(F.lit("a:b'c%\\")).alias("d"), media.export_name(F.lit("0123456789"), F.lit(1000), F.lit("x")).alias("n"), media.status(F.lit(5.0), F.lit(False)).alias("t"), media.status(F.lit(5.0), F.lit(False), shorts=True).alias("u")).first()
    assert tuple(row) == ("sub_00012.0.jpg", "a\\:b\\'c\\%\\\\", "01234567_1000_x.mp4", "skipped_short", "done")


def test_resolved_paths(spark):
    edges = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 1, "c"), (4, 2, "d")], "node int, parent int, name string")
    assert catalog.resolved(edges, "node", "parent", "name", "a/b/d") == 4 and catalog.child(edges, "node", "name", "zz") is None
    with pytest.raises(FileNotFoundError, match="a/x"):
        catalog.resolved(edges, "node", "parent", "name", "a/x/d")
    assert [r["scan_ord"] for r in catalog.scanned(edges, "node", "parent", "name").orderBy("path").collect()] == [1, 2, 3, 4]


def test_sentence_plans(spark):
    clips = [(f"c{i}", i * 10 + j, f"s{i}{j}", 5.0 + j, 100 if j == 0 else 0) for i in range(5) for j in range(6)]
    df = spark.createDataFrame(clips, "category string, clip_id bigint, source string, duration double, usage bigint")
    script = spark.createDataFrame([("第一句话在这里。第二句话更长一些！短",)], "text string").withColumns({"total": F.lit(20.0), "hook": F.lit(5.0)})
    targets = planner.sentence_targets(script, [], "text", "total", "hook")
    assert sum(r["seconds"] for r in targets.collect()) == pytest.approx(15)
    one, two = (sorted(map(tuple, planner.sentence_plans(df.where("category <> 'c0'"), targets, [1, 2, 3], df.where("category = 'c0'")).collect())) for _ in range(2))
    assert one == two
    for seed in (1, 2, 3):
        mine = [r for r in one if r[0] == seed]
        assert len(mine) == 4 and mine[0][2] == "c0" and mine[0][3] != 0 and len({r[3] for r in mine}) == 4
    out = planner.assembled(spark.createDataFrame(one, "seed bigint, place int, category string, clip_id bigint, duration double, sentence_no int"), F.lit(25.0), by_script=True)
    assert {r["speed"] for r in out.where("place = 0").collect()} == {1.0}
    with pytest.raises(ValueError, match="hook"):
        planner.sentence_plans(df, targets, [1], df.limit(0))
    assert planner.clip_key is not None and spark.range(1).select(planner.clip_key(F.lit(""), F.lit("n"))).first()[0] == "n"


def test_sentences_of_a_long_script(spark, within_a_minute):
    n = 50_000
    scripts = spark.createDataFrame([(0, "ab. c! " * n), (1, " .;"), (2, None)], "i int, text string").withColumns({"total": F.lit(60.0), "hook": F.lit(3.0)})
    rows = planner.sentence_targets(scripts, ["i"], "text", "total", "hook", ".!").collect()
    assert [(r["i"], r["sentence_no"], r["sentence"]) for r in rows] == [(0, k, "c" if k % 2 else "ab") for k in range(2 * n)] + [(1, 0, ";")]
    assert sum(r["seconds"] for r in rows if r["i"] == 0) == pytest.approx(57)


def test_ledger_rows_of_a_long_file_are_dealt(spark):
    from clipweave.operators import ledgers

    n = 3 << ledgers.STRETCH_BITS  # sections end and begin in other stretches than most of their rows
    kept = F.when(F.col("id") == 5, " ## A ").when(F.col("id") == n - 9, "## B").otherwise(F.concat(F.lit("| "), F.col("id").cast("string"), F.lit(" | x |")))
    lines = spark.range(n).select((F.col("id") % 2).alias("file"), F.col("id").alias("line_no"), F.when(F.col("file") == 0, "| 0 |").otherwise(kept).alias("line"))
    cells = ledgers.table_cells(lines, "## A").persist()
    assert [(r["file"], r["line_no"], r["cells"][0]) for r in cells.orderBy("line_no").collect()] == [(1, i, str(i)) for i in range(7, n - 9, 2)]
    assert max(r["n"] for r in cells.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) < n // 4  # of n // 2

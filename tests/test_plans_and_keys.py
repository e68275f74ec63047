"""Plan shape checks and the surrogate-key / upsert operators."""

import re

import pytest
from pyspark.sql import functions as F

from scorebook.operators import model
from scorebook.plans.queries import queries

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_or_cartesian(spark):
    qs = queries()
    for name in ["q22_surname_resolution", "q30_dismissal_parse", "q23_longest_contained_name",
                 "q14_full_outer_chain", "q04_load_gate_quarantine"]:
        p = plan_text(qs[name](spark, SF))
        for bad in ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin"]:
            assert bad not in p, (name, bad)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_marts_move_no_fact_by_range(spark):
    """Facts are neither sorted for a key nor run again for each rank."""
    qs = queries()
    for name in ["q17_win_count_mart", "q20_batting_mart_ranks", "q21_bowling_mart"]:
        p = final_plan(qs[name](spark, SF))
        assert "rangepartitioning" not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
    ranked = final_plan(qs["q20_batting_mart_ranks"](spark, SF))
    assert "silver_match_summary" not in ranked  # the written totals are read, not the fact
    assert "runs_scored" not in ranked


def test_bowling_mart_reads_the_columns_it_sums(spark):
    p = final_plan(queries()["q21_bowling_mart"](spark, SF))
    scan = [line for line in p.splitlines() if "FileScan" in line and "overs_bowled" in line]
    assert scan and all("strike_rate" not in line for line in scan)


def test_null_bowlers_are_dealt_out(spark):
    """With broadcast off, rows that name no bowler are not shuffled by that name alone."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        p = plan_text(queries()["q16_master_and_bowler_role_joins"](spark, SF))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert re.search(r"hashpartitioning\(dismissal_bowler_id#\d+L, __spread#", p)
    assert not re.search(r"hashpartitioning\(dismissal_bowler_id#\d+L, \d+\)", p)


def test_surrogate_keys_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k")).repartition(7)
    keyed = model.assign_surrogate_keys(df, ["k"], "sk").collect()
    assert sorted((r.k, r.sk) for r in keyed) == [(i, i + 1) for i in range(5000)]


def test_insert_only_upsert_keeps_keys(spark):
    t1 = model.build_dim(spark.createDataFrame([("b",), ("a",), ("c",)], "name string"),
                         ["name"], "sk", "hk")
    assert {r.name: r.sk for r in t1.collect()} == {"a": 1, "b": 2, "c": 3}
    src = spark.createDataFrame([("d",), ("a",), ("aa",), (None,)], "name string")
    t2 = model.upsert_insert_only(t1, src, ["name"], "sk", "hk")
    got = {r.name: r.sk for r in t2.collect()}
    assert got == {"a": 1, "b": 2, "c": 3, "aa": 4, "d": 5}
    t3 = model.upsert_insert_only(t2.checkpoint(), src, ["name"], "sk", "hk")
    assert t3.count() == 5


def test_catalog_database_tables(spark, workdir):
    from scorebook.sources import catalog
    n = spark.read.parquet(f"{SF}/nation.parquet")
    p1, p2 = f"{workdir}/nation", f"{workdir}/region"
    n.write.partitionBy("n_regionkey").parquet(p1)
    spark.read.parquet(f"{SF}/region.parquet").write.parquet(p2)
    names = catalog.register_all(spark, "scorebook_test", {"dim_nation": p1, "dim_region": p2})
    assert names == ["dim_nation", "dim_region"]
    assert spark.table("scorebook_test.dim_nation").count() == 25
    catalog.cache_small(spark, "scorebook_test", ["dim_region"])
    assert spark.catalog.isCached("scorebook_test.dim_region")
    catalog.save_as_table(n, "scorebook_test", "nation_copy", f"{workdir}/nation_copy")
    assert "nation_copy" in catalog.list_tables(spark, "scorebook_test")
    catalog.create_database(spark, "scorebook_test", replace=True)
    assert catalog.list_tables(spark, "scorebook_test") == []


def test_dimension_joins_are_broadcast_before_the_fact_moves(spark):
    """Dimensions are written tables of known size: the first plan broadcasts them."""
    p = plan_text(queries()["q21_bowling_mart"](spark, SF))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_ranks_start_at_one_per_group(spark):
    df = queries()["q20_batting_mart_ranks"](spark, SF)
    mins = df.groupBy("season_key", "flag").agg(
        *[F.min(c).alias(c) for c in ["runs_rank", "strike_rate_rank", "fours_rank", "sixes_rank"]])
    for r in mins.collect():
        assert (r.runs_rank, r.strike_rate_rank, r.fours_rank, r.sixes_rank) == (1, 1, 1, 1)


def test_ranks_equal_the_window(spark):
    from pyspark.sql import Window

    from scorebook.operators import marts
    from scorebook.session import materialise
    df = materialise(spark.range(0, 3000).select(
        F.when(F.col("id") % 50 != 0, (F.col("id") % 3).cast("int")).alias("g"), F.col("id").alias("k"),
        F.when(F.col("id") % 7 != 0, F.when(F.col("id") % 4 == 0, F.lit(0.0)).otherwise(
            F.rand(3) * 100 / 3)).alias("v"), (F.col("id") % 5).alias("w")), "rank_test")
    got = marts.add_ranks(df, ["g"], ["k"], [("v", "rv"), ("w", "rw")])
    for v, r in (("v", "rv"), ("w", "rw")):
        w = Window.partitionBy("g").orderBy(F.col(v).desc_nulls_last())
        assert got.withColumn("want", F.rank().over(w)).where(~F.col("want").eqNullSafe(F.col(r))).count() == 0
    assert got.count() == 3000


def test_fact_keys_dense_without_a_sort(spark):
    df = spark.range(0, 5000).repartition(7).withColumn("x", F.col("id") % 3)
    keyed = model.assign_fact_keys(df, "sk")
    assert "rangepartitioning" not in plan_text(keyed)
    assert sorted(r.sk for r in keyed.collect()) == list(range(1, 5001))


def test_surrogate_keys_dense_when_payload_is_pruned(spark):
    """Regression: keys must stay dense when the counting pass reads fewer
    columns than the numbering pass (range bounds are sampled per exchange)."""
    li = (spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
          .select("l_orderkey", "l_returnflag", "l_linestatus").dropDuplicates()
          .withColumn("payload", F.md5(F.col("l_orderkey").cast("string"))))
    k = model.assign_surrogate_keys(li, ["l_returnflag", "l_linestatus", "l_orderkey"], "sk")
    rows = k.select("sk", "payload", "l_returnflag", "l_linestatus", "l_orderkey").collect()
    rows.sort(key=lambda r: (r.l_returnflag, r.l_linestatus, r.l_orderkey))
    assert [r.sk for r in rows] == list(range(1, len(rows) + 1))


def test_both_ways_give_the_same_keys(spark, monkeypatch):
    """A small table is numbered by a window, a large one by ranges: same keys."""
    df = spark.range(0, 4000).select((F.col("id") * 7 % 1000).alias("k"), (F.col("id") % 3).cast("string").alias("g"),
                                     F.col("id").alias("payload")).repartition(7)
    for groups in ([], ["g"]):
        small = model.assign_surrogate_keys(df, ["k"], "sk", start=5, groups=groups)
        with monkeypatch.context() as m:
            m.setattr(model, "SMALL_BYTES", 0)
            large = model.assign_surrogate_keys(df, ["k"], "sk", start=5, groups=groups)
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_team_roles_differ(spark):
    """The match fact's four team references are told apart by the data."""
    rows = queries()["q33_factless_match_fact"](spark, SF).select(
        "team_1_ref_key", "team_2_ref_key", "toss_own_team_ref_key", "match_own_team_ref_key").collect()
    for i in range(4):
        for j in range(i):
            assert any(r[i] != r[j] for r in rows) and (i, j) != (j, i)
    matches = queries()["q33_factless_match_fact"](spark, SF)
    assert matches.count() == matches.select("match_ref_key").distinct().count()


def test_bucketed_tables_join_without_an_exchange(spark):
    from scorebook.plans.q_incremental import colocated
    from scorebook.plans.warehouse import Warehouse
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        joined = colocated(Warehouse(spark, SF), 4)
        p = final_plan(joined.groupBy("match_ref_key").agg(F.sum("runs_scored")))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in p and "Exchange" not in p.split("== Initial Plan ==")[0]
    for db in spark.catalog.listDatabases():
        if db.name.startswith("scorebook_buckets_"):
            spark.sql(f"DROP DATABASE {db.name} CASCADE")


def test_lookup_reads_few_row_groups(spark, workdir):
    """Files sorted by player: a drill-through reads a small share of the rows."""
    from scorebook.sources.versions import VersionedTables
    tables = VersionedTables(spark, workdir)
    build = tables.begin()
    spark.conf.set("parquet.block.size", str(64 * 1024))
    try:
        rows = spark.range(0, 300_000).select((F.col("id") * 7919 % 5000).alias("player_ref_key"),
                                              F.col("id").alias("match_ref_key"), (F.col("id") % 2).cast("int").alias("season"))
        build.write("fact", rows, ["season"], sort_by=["player_ref_key"])
    finally:
        spark.conf.unset("parquet.block.size")
    build.publish()
    one = tables.read("fact").where("player_ref_key = 4321")
    assert one.count() == 60
    found = one.select("match_ref_key")
    found.collect()

    def scans(node):
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            children = [node.executedPlan()]
        return [node] if "Scan" in node.nodeName() else [s for c in children for s in scans(c)]

    read = scans(found._jdf.queryExecution().executedPlan())[0].metrics().apply("numOutputRows").value()
    assert 60 <= read < 300_000 / 5


def test_released_block_leaves_no_scratch(spark):
    from scorebook.session import materialise, path_exists, released
    with released(spark):
        gone = materialise(spark.range(3), "gone")
        kept = materialise(spark.range(3), "kept", lasting=True)
        folder = gone.inputFiles()[0].rsplit("/", 1)[0]
    assert not path_exists(spark, folder) and kept.count() == 3


def with_low_threshold(spark, make):
    """The plan text of ``make()`` where the session broadcasts next to nothing by itself."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in names}
    try:
        for k in names:
            spark.conf.set(k, "1")
        return plan_text(make())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_lines_move_to_their_order_only(spark):
    """Silver rows: small lookups are broadcast at any threshold, so lines are not dealt out by them."""
    from scorebook.plans.analogue import summary
    p = with_low_threshold(spark, lambda: summary(spark, SF))
    assert "hashpartitioning(l_orderkey" in p
    assert "hashpartitioning(l_suppkey" not in p and "hashpartitioning(l_partkey" not in p


def test_facts_do_not_move_to_their_players(spark):
    from scorebook.plans.warehouse import Warehouse
    w = Warehouse(spark, SF)
    p = with_low_threshold(spark, lambda: w.bowling_rows)
    assert "hashpartitioning(__pid" not in p


def test_assembly_lines_move_once(spark):
    """Lines are summed per player, and joined to lead, name and folder, where their order is."""
    from scorebook.plans.q_assembly import match_inputs
    p = with_low_threshold(spark, lambda: match_inputs(spark, SF)[0])
    assert "hashpartitioning(l_orderkey" in p
    assert "hashpartitioning(l_orderkey#" in p and not re.search(r"hashpartitioning\(l_orderkey#\d+L, l_suppkey#", p)
    assert "hashpartitioning(l_suppkey" not in p


@pytest.mark.parametrize("broadcasts", [True, False])
def test_assembly_rows_lie_by_match(spark, monkeypatch, broadcasts):
    """Staged rows are bucketed by match: nothing moves to its match again, in loaded rows or outcomes, also
    where a large master has taken the rows away in between; no staged name stays in the catalog."""
    from scorebook.operators import resolve
    from scorebook.plans import match_summary, q_assembly
    if not broadcasts:
        for module in (match_summary, resolve):
            monkeypatch.setattr(module, "small_side", lambda df: df)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in names}
    try:
        for k in names:
            spark.conf.set(k, old[k] if broadcasts else "1")
        asm = q_assembly.assemble_driver(spark, SF)
        for df in (asm.loaded, asm.quarantined):
            assert "Exchange hashpartitioning(match_slug" not in plan_text(df)
        rows = asm.loaded
        files = [f for f in asm.summary.inputFiles() if "/rows/" in f]
        assert 0 < len(files) <= 16
        total = rows.count()
        assert total + asm.matches.join(asm.quarantined, "match_slug", "left_semi").agg(F.sum("rows")).first()[0] == \
            asm.matches.agg(F.sum("rows")).first()[0]
        assert rows.join(asm.quarantined, "match_slug", "left_semi").count() == 0 < total
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("scorebook_stage_")]


def test_finished_jobs_leave_no_shuffle_files(spark):
    """What a written table was shuffled through is gone when it is written."""
    from scorebook.session import WRITING, materialise, settings
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    held = lambda: tracker.shuffleStatuses().size()
    with settings(spark, WRITING):
        before = held()
        materialise(spark.range(1000).repartition(7, "id"), "moved")
        assert held() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"

"""Published versions: write-once parts, an append-only log, and the gold tables over them."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from scorebook.plans import gold, scorecard_load
from scorebook.sources.versions import LostLog, StaleBuild, VersionedTables
from tests.scorecard_fixture import build_tree, write_match


def numbers(spark, values):
    return spark.createDataFrame([(v, v % 3) for v in values], "x int, g int")


def values(df):
    return sorted(r["x"] for r in df.collect())


def test_parts_grow_replace_and_stay_readable(spark, workdir):
    tables = VersionedTables(spark, workdir)
    first = tables.begin()
    assert first.write("grow", numbers(spark, range(5))) == 5
    first.write("swap", numbers(spark, range(6)), ["g"], replace=True)
    old = first.publish()
    second = tables.begin()
    second.write("grow", numbers(spark, [7]))
    second.write("swap", numbers(spark, [100, 101]).where("g = 1"), ["g"], replace=True)
    assert values(tables.read("grow")) == [0, 1, 2, 3, 4]          # not published yet
    second.publish()
    assert values(tables.read("grow")) == [0, 1, 2, 3, 4, 7]
    assert values(tables.read("swap")) == [0, 2, 3, 5, 100]
    assert values(tables.read("swap", old)) == [0, 1, 2, 3, 4, 5]   # readers of the old version
    assert tables.snapshot().numbers["rows grow"] == 6
    assert tables.prune(keep=2) == []
    gone = tables.prune(keep=1)
    assert len(gone) == 1 and "g=1" in gone[0]
    assert values(tables.read("swap")) == [0, 2, 3, 5, 100] and values(tables.read("grow")) == [0, 1, 2, 3, 4, 7]


def test_empty_table_and_nulls(spark, workdir):
    tables = VersionedTables(spark, workdir)
    build = tables.begin()
    assert build.write("none", numbers(spark, []), ["g"]) == 0
    build.write("holes", spark.createDataFrame([(1, None), (None, "a"), (2, "b")], "x int, t string"))
    build.publish()
    assert tables.read("none").columns == ["x", "g"] and tables.read("none").count() == 0
    assert tables.snapshot().numbers["nulls holes"] == 2
    with pytest.raises(LookupError):
        tables.read("other")


def test_dead_build_leaves_nothing_that_is_read(spark, workdir):
    tables = VersionedTables(spark, workdir)
    build = tables.begin()
    build.write("t", numbers(spark, [1]))
    build.publish()
    dead = tables.begin()
    dead.write("t", numbers(spark, [2]))       # dies before it publishes
    assert values(tables.read("t")) == [1]
    third = tables.begin()
    third.write("t", numbers(spark, [3]))
    third.publish()
    assert values(tables.read("t")) == [1, 3]
    assert [p for p in tables.prune(keep=2) if dead.version in p]


def test_lost_log_is_no_first_run(spark, workdir):
    tables = VersionedTables(spark, workdir)
    build = tables.begin()
    build.write("t", numbers(spark, [1]))
    build.publish()
    empty = VersionedTables(spark, workdir)
    empty.log_path = f"{workdir}/another-log"
    with pytest.raises(LostLog):
        empty.begin()
    assert empty.begin(rebuild=True).held.parts == {}


def test_two_builds_at_a_time(spark, workdir):
    tables = VersionedTables(spark, workdir)
    one, two = tables.begin(), tables.begin()
    one.write("t", numbers(spark, [1]))
    two.write("t", numbers(spark, [2]))
    one.publish()
    with pytest.raises(StaleBuild):
        two.publish()
    assert values(tables.read("t")) == [1]


def natural(spark, tables, fact):
    """A fact's rows under natural keys."""
    match = tables.read("dim_match_details").select(
        F.col("match_surrogate_key").alias("match_ref_key"), "match_details_hash_value")
    player = tables.read("dim_player_details").select(
        F.col("player_surrogate_key").alias("player_ref_key"), "player_id")
    rows = tables.read(fact).join(match, "match_ref_key").join(player, "player_ref_key")
    key = gold.FACT_KEYS[fact]
    return sorted(tuple(r) for r in rows.drop(key, "match_ref_key", "player_ref_key", "match_type_ref_key").collect())


def files_of(base):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{base}/**/*.parquet", recursive=True) if "/log/" not in f}


def test_gold_grows_load_by_load(spark, workdir, monkeypatch):
    root, wh = os.path.join(workdir, "bronze"), os.path.join(workdir, "warehouse")
    build_tree(root)
    scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    scorecard_load.build_gold(spark, wh)
    tables = scorecard_load.star_tables(spark, wh)
    keys = lambda: {r[1]: r[0] for r in tables.read("dim_match_details").select(
        "match_surrogate_key", "match_details_hash_value").collect()}
    before, held, rows = keys(), tables.snapshot(), natural(spark, tables, "fact_batting_scorecard")
    assert sorted(before.values()) == [1, 2]

    # a match that sorts before the old ones, in a season of its own
    write_match(root, "india-vs-pakistan-6th-odi-1006", "aaa-aaa-10.csv", "India won by 9 runs", number="0 ODI",
                series="A series", season="1999")
    scorecard_load.run_load(spark, root, wh, load_id="20240102000000")
    # the build dies between two tables
    with monkeypatch.context() as m:
        appended = []

        def fail(build, table, df):
            if appended:
                raise OSError("store lost")
            appended.append(table)
            return append(build, table, df)

        append = gold.append_fact
        m.setattr(gold, "append_fact", fail)
        with pytest.raises(OSError):
            scorecard_load.build_gold(spark, wh)
    assert tables.snapshot() == held and keys() == before
    assert natural(spark, tables, "fact_batting_scorecard") == rows

    old_files = files_of(tables.base)
    out = scorecard_load.build_gold(spark, wh)
    after = keys()
    assert {k: after[k] for k in before} == before and sorted(after.values()) == [1, 2, 3]
    assert out["audit"].where("value <> expected").count() == 0
    # files of the old version that the new one still names are as they were; facts only grew
    now = files_of(tables.base)
    parts = tables.snapshot().parts
    assert set(held.parts["fact_batting_scorecard"]) < set(parts["fact_batting_scorecard"])
    new_parts = set(parts["fact_batting_scorecard"]) - set(held.parts["fact_batting_scorecard"])
    assert len(new_parts) == 1 and "season=1999" in new_parts.pop()
    kept = [f for f in old_files if any(p in f for ps in parts.values() for p in ps)]
    assert kept and all(now[f] == old_files[f] for f in kept)
    assert {p for p in parts["batting_ranked"] if "season_key=2023" in p} == {
        p for p in held.parts["batting_ranked"] if "season_key=2023" in p}

    # a build from nothing gives the same content
    grown = {f: natural(spark, tables, f) for f in ("fact_batting_scorecard", "fact_bowling_scorecard")}
    mart = {name: sorted(tuple(r) for r in out[name].drop("player_ref_key").collect())
            for name in ("format_wise_analysis", "format_wise_winners", "batting_analysis", "bowling_analysis")}
    again = scorecard_load.build_gold(spark, wh, rebuild=True)
    assert {f: natural(spark, tables, f) for f in grown} == grown
    for name, rows in mart.items():
        assert sorted(tuple(r) for r in again[name].drop("player_ref_key").collect()) == rows


def test_unknown_members_keep_a_match(spark, workdir):
    """The fixture's second match has no player of the match: it stays with key -1's reference."""
    root, wh = os.path.join(workdir, "bronze"), os.path.join(workdir, "warehouse")
    build_tree(root)
    scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    out = scorecard_load.build_gold(spark, wh, keep_unmatched=True)
    tables = scorecard_load.star_tables(spark, wh)
    assert tables.read("fact_match_info").count() == 2
    unknown = tables.read("dim_player_details").where("player_surrogate_key = -1").first()
    held = tables.read("fact_match_info").where(F.col("player_of_the_match_ref_key") == unknown["player_hash_value"])
    assert held.count() == 1
    assert out["audit"].where("value <> expected").count() == 0
    assert tables.read("dim_match_details").where("match_surrogate_key > 0").count() == 2


def test_master_is_published_by_version(spark, workdir):
    root, wh = os.path.join(workdir, "bronze"), os.path.join(workdir, "warehouse")
    build_tree(root)
    before = scorecard_load.publish_master(spark, root, wh)
    n = before.count()
    scorecard_load.publish_master(spark, root, wh)
    assert before.count() == n == 23
    assert len(scorecard_load.master_tables(spark, wh).snapshot().parts["player_master"]) == 1


def test_player_facts_look_their_references_up_once(spark, monkeypatch):
    """Batting and bowling fact come from one written table, a load's silver rows from a folder of their own."""
    from scorebook import session
    from scorebook.plans import q_incremental
    written = {}

    def noted(df, name, *args, **kwargs):
        out = session.materialise(df, name, *args, **kwargs)
        written.setdefault(name, []).append(out)
        return out

    for module in (gold.model, q_incremental):
        monkeypatch.setattr(module, "materialise", noted)
    settings = {k: spark.conf.get(k, None) for k in session.WRITING}
    monkeypatch.setattr(q_incremental, "_GROWN", {})
    tables = q_incremental.grown(spark, "/root/testdata/sf0.001")
    assert {k: spark.conf.get(k, None) for k in settings} == settings
    loads = len(q_incremental.CUTS) + 1
    assert "placed" not in written and len(written["fact_rows"]) == len(written["new_matches"]) == loads
    rows = sum(t.count() for t in written["fact_rows"])
    for table in ("fact_batting_scorecard", "fact_bowling_scorecard"):
        fact, key = tables.read(table), gold.FACT_KEYS[table]
        assert fact.count() == rows == fact.select(key).distinct().count()
        assert fact.agg(F.min(key), F.max(key)).first() == (1, rows)
    silver, = written["silver_loads"]
    assert {f.split("/load=")[1][0] for f in silver.inputFiles()} == {str(k) for k in range(loads)}

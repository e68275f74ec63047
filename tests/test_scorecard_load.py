"""End to end over hand-made CSV trees: load gates, ledger, silver, star, marts."""

import os

import pytest
from pyspark.sql import functions as F

from scorebook.operators import load
from scorebook.plans import scorecard_load
from scorebook.sources import catalog, readers
from tests.scorecard_fixture import IDS, build_tree, write_master, write_match


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}


def test_load_gates_resolution_and_rerun(spark, workdir):
    root = os.path.join(workdir, "bronze")
    wh = os.path.join(workdir, "warehouse")
    build_tree(root)
    asm = scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    reasons = {r["match_slug"]: r["reason"] for r in asm.matches.collect()}
    assert reasons == {
        "india-vs-pakistan-1st-odi-1001": None,
        "india-vs-pakistan-2nd-odi-1002": None,
        "new-zealand-vs-pakistan-3rd-odi-1003": "unexpected row count",
        "england-vs-ireland-4th-odi-1004": "missing batting file",
        "india-vs-pakistan-5th-odi-1005": "unparsed result",
    }
    p = scorecard_load.paths(wh)
    silver = scorecard_load.read_silver(spark, wh)
    per_match = {r[0]: r[1] for r in silver.groupBy("match_slug").count().collect()}
    assert per_match == {"india-vs-pakistan-1st-odi-1001": 22, "india-vs-pakistan-2nd-odi-1002": 22}

    m1 = silver.filter(F.col("match_slug") == "india-vs-pakistan-1st-odi-1001")
    by_id = rows_by(m1, "player_id")
    # bowler resolution by surname and full name, catches credited to fielders
    assert by_id[IDS["Quinton de-Kock"]]["dismissal_bowler_id"] == IDS["Jasprit Bumrah"]
    assert by_id[IDS["Morne Morkel"]]["dismissal_bowler_id"] == IDS["Jasprit Bumrah"]
    assert by_id[IDS["Shaheen Afridi"]]["dismissal_bowler_id"] == IDS["Ravindra Jadeja"]
    assert by_id[IDS["Virat Kohli"]]["dismissal_bowler_id"] == IDS["Morne Morkel"]
    assert by_id[IDS["Imam Haq"]]["dismissal_bowler_id"] == 0
    assert by_id[IDS["Imam Haq"]]["dismissal"] == "RUNOUT"
    assert by_id[IDS["Quinton de-Kock"]]["dismissal"] == "JASPRIT BUMRAH"
    catches = {i: r["catch_taken"] for i, r in by_id.items() if r["catch_taken"]}
    assert catches == {IDS["Virat Kohli"]: 1, IDS["Jasprit Bumrah"]: 1, IDS["Rishabh Pant"]: 1,
                       IDS["Rohit Sharma"]: 1, IDS["Quinton de-Kock"]: 1}
    # match-level fields, recodes, date parts, style of the dismissing bowler
    r = by_id[IDS["Babar Azam"]]
    assert (r["team_1"], r["team_2"], r["own_team"]) == ("INDIA", "PAKISTAN", "INDIA")
    assert (r["season"], r["series_name"]) == ("2023", "ICC WORLD CUP")
    assert (r["match_day"], r["match_month"], r["match_year"]) == (15, "JANUARY", 1997)
    assert (r["venue_id"], r["venue_location"], r["stadium"]) == (55, "MAHARASHTRA", "WANKHEDE_STADIUM")
    assert r["outed_bowler_style"] == "RIGHT-ARM FAST"
    assert r["captain_flag"] == "Y"
    assert by_id[IDS["Jasprit Bumrah"]]["overs_bowled"] == 4.3
    assert by_id[IDS["Fakhar Zaman"]]["runs_scored"] == 0
    assert r["country_representative"] == "PAKISTAN"
    # second match: the side with more points wins; fractional day -> default 1; no POM
    m2 = rows_by(silver.filter(F.col("match_slug") == "india-vs-pakistan-2nd-odi-1002"), "player_id")
    r2 = m2[IDS["Babar Azam"]]
    assert r2["own_team"] == "PAKISTAN" and r2["match_type"] == "T20" and r2["match_id"] == 2
    assert (r2["match_day"], r2["match_month"], r2["match_year"]) == (1, "MARCH", 2019)
    assert r2["player_of_the_match_player_id"] == 0

    # second run: the failed ones have the files they had, so nothing is tried again or added
    assert scorecard_load.run_load(spark, root, wh, load_id="20240102000000") is None
    assert scorecard_load.read_silver(spark, wh).count() == 44
    # a late match is picked up
    write_match(root, "india-vs-pakistan-6th-odi-1006", "ground-y-60.csv", "India won by 9 runs",
                season="2021")
    asm3 = scorecard_load.run_load(spark, root, wh, load_id="20240103000000")
    assert [r["match_slug"] for r in asm3.matches.where("reason is null").collect()] == [
        "india-vs-pakistan-6th-odi-1006"]
    assert asm3.loaded.count() == 22
    assert spark.read.parquet(p["silver"]).count() == 66
    ledger = spark.read.parquet(p["ledger"])
    assert ledger.where("status = 'loaded'").count() == 3
    assert ledger.where("status = 'quarantined'").count() == 3
    assert spark.read.parquet(p["quarantine"]).count() == 3
    quarantined = {r["match_slug"]: r["reason"] for r in scorecard_load.read_quarantine(spark, wh).collect()}
    assert quarantined == {k: v for k, v in reasons.items() if v}
    assert not os.path.exists(p["stage"]) or not os.listdir(p["stage"])

    # gold: star schema and marts over the whole silver table
    gold = scorecard_load.build_gold(spark, wh)
    w = gold["warehouse"]
    assert w.fbat.count() == 66 and w.fbowl.count() == 66
    assert w.dmd.count() == 3
    fmt = gold["format_wise_analysis"].collect()
    assert sum(r["match_win_count"] for r in fmt) == 2   # match without POM drops out (inner join)
    bat = rows_by(gold["batting_analysis"].filter(F.col("season_key") == 2023), "player_name")
    assert bat["Babar-Azam"]["total_runs"] == 77 and bat["Babar-Azam"]["runs_rank"] == 1
    bowl = gold["bowling_analysis"]
    assert bowl.filter(F.col("Player_name") == "Rohit-Sharma").count() == 0   # did not bowl
    csv = spark.read.option("header", True).csv(os.path.join(p["gold"], "batting_analysis"))
    assert csv.count() == gold["batting_analysis"].count()
    # every dismissal by a bowler counts once, under the style of the player dimension
    styles = [c for c in gold["batting_analysis"].columns if "arm" in c]
    total = gold["batting_analysis"].agg(*[F.sum(c).alias(c) for c in styles]).first()
    by_bowler = w.fbat.where("dimissial_player_id <> 0").count()
    assert sum(total) == by_bowler and by_bowler > 0
    failed = gold["audit"].where("value <> expected").collect()
    assert failed == []


def test_repeated_load_id_does_not_double(spark, workdir, monkeypatch):
    """A load that fails before its ledger write, repeated under the same id."""
    root, wh = os.path.join(workdir, "bronze"), os.path.join(workdir, "warehouse")
    build_tree(root)

    def fail(*_):
        raise OSError("store lost")

    with monkeypatch.context() as m:
        m.setattr(load, "append_ledger", fail)
        with pytest.raises(OSError):
            scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    assert spark.read.parquet(scorecard_load.paths(wh)["silver"]).count() == 88
    per_match = scorecard_load.read_silver(spark, wh).groupBy("match_slug").count().collect()
    assert sorted(r["count"] for r in per_match) == [22, 22]
    assert scorecard_load.read_quarantine(spark, wh).count() == 3


def test_late_file_and_doubled_venue(spark, workdir):
    root, wh = os.path.join(workdir, "bronze"), os.path.join(workdir, "warehouse")
    write_master(root)
    late, two_rows, two_files, empty = (f"india-vs-pakistan-{k}th-odi-200{k}" for k in range(1, 5))
    write_match(root, late, "lords-london-58.csv", "India won by 1 run", batting=False)
    write_match(root, two_rows, "lords-london-58.csv", "India won by 1 run", number="2nd ODI")
    write_match(root, two_files, "lords-london-58.csv", "India won by 1 run", number="3rd ODI")
    write_match(root, empty, "lords-london-58.csv", "India won by 1 run", number="4th ODI")
    md = f"{root}/match-details"
    with open(f"{md}/venue-details/{two_rows}/lords-london-58.csv") as f:
        rows = f.read().splitlines()
    with open(f"{md}/venue-details/{two_rows}/lords-london-58.csv", "a") as f:
        f.write(rows[1] + "\n")
    with open(f"{md}/venue-details/{two_files}/other-london-59.csv", "w") as f:
        f.write("\n".join(rows[:2]) + "\n")
    for k in (1, 2):
        with open(f"{md}/bowling-scorecard/{empty}/scorecard/bowling{k}.csv", "w") as f:
            f.write("PLAYER_NAME,OVERS_BOWLED\n")  # a file of no bytes at all counts as missing
    asm = scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    got = [(r["match_slug"], r["reason"]) for r in asm.matches.collect()]
    assert sorted(got) == [(late, "missing batting file"), (two_rows, None), (two_files, "several venues"),
                           (empty, "empty bowling file")]
    assert scorecard_load.read_silver(spark, wh).count() == 22
    write_match(root, late, "lords-london-58.csv", "India won by 1 run")
    scorecard_load.run_load(spark, root, wh, load_id="20240102000000")
    per_match = {r[0]: r[1] for r in scorecard_load.read_silver(spark, wh).groupBy("match_slug").count().collect()}
    assert per_match == {late: 22, two_rows: 22}
    assert {r["match_slug"] for r in scorecard_load.read_quarantine(spark, wh).collect()} == {two_files, empty}


def test_load_id_from_the_clock(spark):
    from datetime import datetime, timedelta, timezone
    found = datetime.strptime(load.load_id_now(spark), "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc)
    assert abs(datetime.now(timezone.utc) - found) < timedelta(minutes=5)
    assert load.attempt_id("x") != load.attempt_id("x")


def test_unreadable_ledger_raises(spark):
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        load.read_ledger(spark, "nosuchstore://host/ledger").count()


def test_only_new_folders_are_read(spark, workdir):
    root, wh = os.path.join(workdir, "bronze"), os.path.join(workdir, "warehouse")
    build_tree(root)
    scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    new = "india-vs-pakistan-6th-odi-1006"
    write_match(root, new, "ground-y-60.csv", "India won by 9 runs", season="2021")
    found = readers.read_match_files(spark, root, slugs=[new])
    for df, files in ((found.batting, 2), (found.bowling, 2), (found.sheet, 1), (found.venue, 1)):
        assert {r["match_slug"] for r in df.collect()} == {new}
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numFiles").value() == files


def test_star_tables_by_name_over_two_loads(spark, workdir):
    root, wh = os.path.join(workdir, "bronze"), os.path.join(workdir, "warehouse")
    build_tree(root)
    scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    scorecard_load.build_gold(spark, wh, database="scorebook_star")
    sql = ("SELECT d.match_surrogate_key, d.match_details_hash_value FROM scorebook_star.dim_match_details d")
    before = {r[1]: r[0] for r in spark.sql(sql).collect()}
    assert sorted(before.values()) == [1, 2]
    # a match that sorts before the old ones
    write_match(root, "india-vs-pakistan-6th-odi-1006", "aaa-aaa-10.csv", "India won by 9 runs", number="0 ODI",
                series="A series", season="1999")
    scorecard_load.run_load(spark, root, wh, load_id="20240102000000")
    scorecard_load.build_gold(spark, wh, database="scorebook_star")
    after = {r[1]: r[0] for r in spark.sql(sql).collect()}
    assert {k: after[k] for k in before} == before and sorted(after.values()) == [1, 2, 3]
    n = spark.sql("""SELECT count(*) FROM scorebook_star.fact_batting_scorecard f
        JOIN scorebook_star.dim_match_details d ON d.match_surrogate_key = f.match_ref_key
        JOIN scorebook_star.dim_player_details p ON p.player_surrogate_key = f.player_ref_key""").first()[0]
    assert n == 66
    scorecard_load.build_gold(spark, wh, database="scorebook_star", rebuild=True)
    assert sorted(r[0] for r in spark.sql(sql).collect()) == [1, 2, 3]
    assert {"dim_stadium", "fact_match_info", "match_summary", "processed_matches"} <= set(
        catalog.list_tables(spark, "scorebook_star"))
    catalog.create_database(spark, "scorebook_star", replace=True)


def test_uncommitted_load_is_invisible(spark, workdir):
    """Rows written by a load whose ledger write never happened are not read."""
    root = os.path.join(workdir, "bronze")
    wh = os.path.join(workdir, "warehouse")
    build_tree(root)
    scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    p = scorecard_load.paths(wh)
    silver = scorecard_load.read_silver(spark, wh)
    n = silver.count()
    # a failed run left rows under another load id but no ledger rows
    orphan = silver.withColumns({"record_created_timestamp": F.lit("20240105000000"),
                                 "load_attempt": F.lit("20240105000000-lost")})
    orphan.write.mode("append").partitionBy("season", "match_type").parquet(p["silver"])
    assert scorecard_load.read_silver(spark, wh).count() == n


def test_failed_match_is_tried_again_when_its_files_change(spark, workdir):
    root, wh = os.path.join(workdir, "bronze"), os.path.join(workdir, "warehouse")
    write_master(root)
    slug = "india-vs-pakistan-1st-odi-3001"
    write_match(root, slug, "lords-london-58.csv", "no result")
    scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    assert scorecard_load.run_load(spark, root, wh, load_id="20240102000000") is None
    # another fault: the latest reason is shown
    write_match(root, slug, "lords-london-58.csv", "India won by 1 run", batting=False)
    for k in (1, 2):
        os.remove(f"{root}/match-details/batting-scorecard/{slug}/scorecard/batting{k}.csv")
    scorecard_load.run_load(spark, root, wh, load_id="20240103000000")
    assert [r["reason"] for r in scorecard_load.read_quarantine(spark, wh).collect()] == ["missing batting file"]
    write_match(root, slug, "lords-london-58.csv", "India won by 1 run")
    asm = scorecard_load.run_load(spark, root, wh, load_id="20240104000000")
    assert [r["reason"] for r in asm.matches.collect()] == [None]
    assert scorecard_load.read_quarantine(spark, wh).count() == 0
    assert scorecard_load.run_load(spark, root, wh, load_id="20240105000000") is None
    assert load.read_ledger(spark, scorecard_load.paths(wh)["ledger"]).count() == 3


def test_malformed_lines_are_set_aside_with_a_reason(spark, workdir):
    root, wh = os.path.join(workdir, "bronze"), os.path.join(workdir, "warehouse")
    write_master(root)
    kinds = ["good", "short", "long", "quote", "order", "none"]
    slugs = {k: f"india-vs-pakistan-{i + 1}th-odi-40{i:02d}" for i, k in enumerate(kinds)}
    for i, slug in enumerate(slugs.values()):
        write_match(root, slug, "lords-london-58.csv", "India won by 1 run", number=f"{i + 1} ODI")

    def edit(kind, change):
        path = f"{root}/match-details/batting-scorecard/{slugs[kind]}/scorecard/batting1.csv"
        with open(path, encoding="utf-8") as f:
            lines = f.read().splitlines()
        with open(path, "w", encoding="utf-8") as f:
            f.write("\n".join(change(lines)) + "\n")

    edit("short", lambda x: [*x[:3], "Babar Azam,not out,5", *x[4:]])
    edit("long", lambda x: [*x[:3], x[3] + ",1,2", *x[4:]])
    edit("quote", lambda x: [*x[:3], '"Shaheen Afridi' + x[3], *x[4:]])
    edit("order", lambda x: [",".join([x[0].split(",")[1], x[0].split(",")[0], *x[0].split(",")[2:]]), *x[1:]])
    edit("none", lambda x: x[1:])
    asm = scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    reasons = {r["match_slug"]: r["reason"] for r in asm.matches.collect()}
    want = {"good": None, "short": "malformed batting rows", "long": "malformed batting rows",
            "quote": "malformed batting rows", "order": "unexpected batting header", "none": "unexpected batting header"}
    assert reasons == {slugs[k]: r for k, r in want.items()}
    aside = {(r["match_slug"], r["part"], r["reason"]): r["record"] for r in
             scorecard_load.read_malformed(spark, wh).collect()}
    assert {(s, reason) for s, _, reason in aside} == {
        *((slugs[k], "wrong number of fields or open quote") for k in ("short", "long", "quote")),
        (slugs["order"], "unexpected header")}
    assert aside[slugs["short"], "batting", "wrong number of fields or open quote"] == "Babar Azam,not out,5"
    # lines, header apart, are rows or set aside
    found = readers.read_match_files(spark, root)
    kinds = {r["kind"]: r["count"] for r in found.lines["batting"].groupBy("kind").count().collect()}
    assert kinds == {"header": 10, "other header": 1, "malformed": 3, "row": 6 * 22 - 3}
    assert scorecard_load.read_silver(spark, wh).count() == 22


def test_first_load_of_many_folders_reads_by_join(spark, workdir, monkeypatch):
    """More new folders than path names: the same rows without a list in the plan."""
    root, wh = os.path.join(workdir, "bronze"), os.path.join(workdir, "warehouse")
    build_tree(root)
    monkeypatch.setattr(scorecard_load, "PATH_NAMES", 2)
    scorecard_load.run_load(spark, root, wh, load_id="20240101000000")
    assert scorecard_load.read_silver(spark, wh).count() == 44
    assert scorecard_load.read_quarantine(spark, wh).count() == 3

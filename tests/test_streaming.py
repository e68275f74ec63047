"""The file-stream form of the load picks up new match folders once."""

import os
import shutil
from datetime import timedelta

from scorebook.plans import scorecard_load
from scorebook.streaming import incremental
from tests.scorecard_fixture import build_tree, write_master, write_match


def test_available_now_stream_loads_new_matches(spark, workdir):
    root = os.path.join(workdir, "bronze")
    wh = os.path.join(workdir, "warehouse")
    ck = os.path.join(workdir, "stream-checkpoint")
    build_tree(root)
    incremental.start(spark, root, wh, ck).awaitTermination(600)
    silver = scorecard_load.read_silver(spark, wh)
    assert silver.select("match_slug").distinct().count() == 2
    write_match(root, "india-vs-pakistan-6th-odi-1006", "ground-y-60.csv", "India won by 9 runs")
    incremental.start(spark, root, wh, ck).awaitTermination(600)
    silver = scorecard_load.read_silver(spark, wh)
    assert silver.select("match_slug").distinct().count() == 3
    assert silver.count() == 66
    # a batting file that lands later brings its match up again
    write_match(root, "england-vs-ireland-4th-odi-1004", "lords-london-58.csv", "England won by 1 run")
    incremental.start(spark, root, wh, ck).awaitTermination(600)
    silver = scorecard_load.read_silver(spark, wh)
    assert silver.select("match_slug").distinct().count() == 4 and silver.count() == 88
    ledger = spark.read.parquet(scorecard_load.paths(wh)["ledger"])
    assert ledger.where("status = 'loaded'").count() == 4


def test_parts_in_four_batches_give_one_load(spark, workdir):
    """State per match: nothing is tried before the fourth part, or before the wait is over."""
    root, whole = os.path.join(workdir, "bronze"), os.path.join(workdir, "whole")
    wh, ck = os.path.join(workdir, "warehouse"), os.path.join(workdir, "stream-checkpoint")
    slug = "india-vs-pakistan-1st-odi-5001"
    write_master(root)
    write_match(whole, slug, "lords-london-58.csv", "India won by 1 run")
    write_match(whole, "india-vs-pakistan-2nd-odi-5002", "lords-london-58.csv", "India won by 1 run")
    ledger = scorecard_load.paths(wh)["ledger"]
    for k, tree in enumerate(("team-details", "batting-scorecard", "venue-details", "bowling-scorecard")):
        assert not os.path.exists(ledger)
        shutil.copytree(f"{whole}/match-details/{tree}/{slug}", f"{root}/match-details/{tree}/{slug}")
        incremental.start(spark, root, wh, ck, wait=timedelta(hours=1)).awaitTermination(120)
    rows = spark.read.parquet(ledger).collect()
    assert [(r["processed_match_details"], r["status"]) for r in rows] == [(slug, "loaded")]
    assert scorecard_load.read_silver(spark, wh).count() == 22
    # a match that stays incomplete is tried once files have come later
    late, other = "india-vs-pakistan-2nd-odi-5002", "india-vs-pakistan-3rd-odi-5003"
    shutil.copytree(f"{whole}/match-details/venue-details/{late}", f"{root}/match-details/venue-details/{late}")
    incremental.start(spark, root, wh, ck, wait=timedelta(milliseconds=1)).awaitTermination(120)
    write_match(root, other, "lords-london-58.csv", "India won by 1 run", number="3rd ODI")
    incremental.start(spark, root, wh, ck, wait=timedelta(milliseconds=1)).awaitTermination(120)
    assert [r["reason"] for r in scorecard_load.read_quarantine(spark, wh).collect()] == ["missing team sheet file"]
    assert scorecard_load.read_silver(spark, wh).count() == 44

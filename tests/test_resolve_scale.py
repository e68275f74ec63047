"""Name resolution at size: rows are dealt out before they are grouped, into partitions that follow the table."""

import re

import pytest
from pyspark.sql import functions as F

from scorebook import session
from scorebook.operators import resolve
from scorebook.plans.queries import queries

SF = "/root/testdata/sf0.001"


def above_scans(plan, table):
    """For each scan of ``table``, the operators above it up to the first exchange."""
    lines = [(len(re.match(r"[\s:+\-*()0-9]*", x).group()), x) for x in plan.splitlines()]
    for k, (depth, line) in enumerate(lines):
        if "FileScan" in line and f"{table}.parquet" in line:
            found = []
            for d, x in reversed(lines[:k]):
                if d < depth:
                    depth = d
                    if "Exchange" in x:
                        break
                    found.append(x)
            yield found


@pytest.mark.parametrize("name", ["q22_surname_resolution", "q44_resolution_of_any_id"])
def test_no_scan_of_lines_is_grouped_whole(spark, name):
    """A hash map over a scan's lines, nearly all distinct, grows with the files of a task."""
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = list(above_scans(plan, "lineitem"))
    assert len(scans) >= 3
    assert not [x for found in scans for x in found if "Aggregate" in x]


@pytest.mark.parametrize("name", ["q22_surname_resolution", "q44_resolution_of_any_id"])
def test_split_names_are_not_grouped_again(spark, name):
    """Players are distinct before their names are split: no second map of a row for each word."""
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan
    assert not re.search(r"Aggregate\(keys=\[[^\]]*__w#", plan)


def test_partitions_follow_the_files(spark, workdir, monkeypatch):
    monkeypatch.setattr(session, "PARTITION_BYTES", 10_000)
    counts = []
    for k in (1, 4):
        path = f"{workdir}/t{k}"
        spark.range(0, 40_000 * k, 1, k).write.parquet(path)
        counts.append(session.partitions_for(spark.read.parquet(path)))
    assert counts[0] > spark.sparkContext.defaultParallelism
    assert 3 * counts[0] <= counts[1] <= 5 * counts[0]


@pytest.mark.parametrize("partitions", [None, 3])
def test_repeated_players_mentions_and_words_count_once(spark, partitions):
    people = spark.createDataFrame(
        [(1, 10, "Ali Khan"), (1, 10, "Ali Khan"), (1, 10, "ALI KHAN"), (1, 11, "Khan Khan"), (1, 12, " "), (1, 13, None),
         (2, 20, "Khan"), (None, 30, "Ali Khan")], "m long, id long, name string")
    mentions = spark.createDataFrame(
        [(1, 1, "Khan"), (1, 2, "Khan"), (1, 3, "ali khan"), (1, 4, "Nobody"), (1, 5, ""), (1, 6, None),
         (2, 1, "Z Khan"), (None, 1, "Khan")], "m long, line int, text string")
    got = resolve.resolve_mentions(mentions, people, "m", "text", "name", "id", partitions=partitions)
    rows = {(r.m, r.line): (r.resolved_id, r.n_candidates) for r in got.collect()}
    assert rows == {(1, 1): (10, 2), (1, 2): (10, 2), (1, 3): (10, 1), (1, 4): (None, None), (1, 5): (None, None),
                    (1, 6): (None, None), (2, 1): (20, 1), (None, 1): (None, None)}
    assert got.where(F.col("m") == 1).count() == 6

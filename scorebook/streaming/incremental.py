"""Incremental load as a file-source stream (optional form of the batch load).

A new file in any of the four trees of ``match-details`` names its match folder,
so a file that lands later than the rest brings its match up again.  Each
micro-batch runs the set-based load for the folders it names that are not
loaded yet; the ledger makes a replayed batch add nothing, whatever its
number.  ``trigger(availableNow=True)`` processes what is there and stops, which
suits a scheduled job; the stream's own checkpoint records which files were seen.

With ``wait`` a match is held in keyed state until all four parts have been seen, or until a
batch so long after its last file; only then its folder is listed and loaded, so a match
whose files trickle in is neither tried nor quarantined for each of them.  Event time is
the time of the batch that sees a file: no file is ever late, and a stream that processes
what is there ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.fixed import PLAYERS_PER_MATCH
from ..plans import scorecard_load
from ..plans.match_summary import KEY
from ..sources import readers


def complete(files: DataFrame, wait: timedelta) -> DataFrame:
    """The matches of a stream of (match_slug, tree, seen_at) whose four parts have been
    seen, and those whose last file was seen ``wait`` before the newest of all.  The state of a match
    is a set of four bits."""
    trees = [tree for tree, _, _ in readers.PARTS.values()]
    whole, millis = (1 << len(trees)) - 1, int(wait.total_seconds() * 1000)

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({KEY: [key[0]]})
            return
        seen, newest = state.get[0] if state.exists else 0, 0
        for batch in batches:
            for tree in batch["tree"].unique():
                seen |= 1 << trees.index(tree)
            newest = max(newest, int(batch["seen_at"].max().timestamp() * 1000))
        if seen == whole:
            if state.exists:
                state.remove()
            yield pd.DataFrame({KEY: [key[0]]})
        else:
            state.update((seen,))
            state.setTimeoutTimestamp(max(newest + millis, state.getCurrentWatermarkMs() + 1))

    return (files.withWatermark("seen_at", "0 seconds").groupBy(KEY)
            .applyInPandasWithState(step, f"{KEY} string", "seen int", "append", GroupStateTimeout.EventTimeTimeout))


def start(spark: SparkSession, root: str, warehouse: str, checkpoint_location: str,
          expected_rows: int | None = PLAYERS_PER_MATCH,
          available_now: bool = True, wait: timedelta | None = None) -> StreamingQuery:
    """Start the stream; each micro-batch loads the matches whose files it names or, with
    ``wait``, those that are complete or have waited so long."""
    # Only paths are selected, so the files' content is not read here.
    files = (spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
             .schema("path string, modificationTime timestamp, length long, content binary")
             .load(f"{root}/match-details"))
    slugs = (files.select(readers.slug_of(F.col("path")).alias(KEY), readers.tree_of(F.col("path")).alias("tree"),
                          F.current_timestamp().alias("seen_at"))
             .where(F.col(KEY) != ""))
    slugs = complete(slugs, wait) if wait is not None else slugs.select(KEY)

    def each(batch: DataFrame, epoch_id: int) -> None:
        scorecard_load.run_load(batch.sparkSession, root, warehouse, f"stream{epoch_id:012d}",
                                expected_rows, among=batch)

    w = slugs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()

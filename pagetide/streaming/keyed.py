"""Runs whose micro-batches load their pages at once, with state kept between batches and runs.

What a load needs to know of a table is the range of times of each owner and the keys the table
holds. Both only ever grow, so they are kept as two logs that each batch adds to:

* ``ranges``: owner, smallest and largest time. What is known of an owner is the extremes of its rows.
* ``keys``: the keys, partitioned by a hash. A batch reads the partitions of its own keys only.

A batch therefore costs its pages, the ranges and a share of narrow keys, never the table or the
pages of earlier batches. When a page ends the run, the batches after it do not read their pages.

Every batch writes directories of its own number with overwrite and does not look at what it wrote
itself, so a batch that is replayed does the same again. Pages within a batch are judged in their
order; batches must come in order, which is checked. For pages in any order use ``finish_run``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagetide import schemas as S
from pagetide.functions.scalars import parse_ts
from pagetide.operators import shape as sh
from pagetide.sources import feeds
from pagetide.sources.tables import stored
from pagetide.streaming import pages as pg

#: Partitions of the keys of a feed.
BUCKETS = 64
STOPS = S.struct(stop_seq=S.LONG, stop_reason=S.STRING, last_seq=S.LONG, load=S.STRING)


def bucket_of(feed: pg.Feed):
    return F.pmod(F.xxhash64(*feed.key_names), F.lit(BUCKETS)).cast("int")


class KeyedState:
    """The ranges and keys of a table, in a folder of their own on shared storage."""

    def __init__(self, spark: SparkSession, feed: pg.Feed, root: str):
        self.spark, self.feed, self.root = spark, feed, root

    def add(self, rows: DataFrame, loaded: DataFrame, load: str) -> None:
        """What a load saw (``rows``) and what it brought into the table (``loaded``)."""
        ranges = pg.owner_ranges(self.feed.keyed(rows)).filter("_owner is not null")
        ranges.write.mode("overwrite").parquet(f"{self.root}/ranges/load={load}")
        keys = self.feed.keyed(loaded).select(*self.feed.key_names, bucket_of(self.feed).alias("bucket")).distinct()
        keys.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/keys/load={load}")

    def ranges(self, load: str) -> DataFrame:
        """_owner, _min, _max before a load."""
        log = self._log("ranges", "_owner bigint, _min bigint, _max bigint, load string", load)
        return log.groupBy("_owner").agg(F.min("_min").alias("_min"), F.max("_max").alias("_max"))

    def keys(self, rows: DataFrame, load: str) -> DataFrame:
        """The known keys that ``rows`` hold too, from the partitions of their hashes alone."""
        come = self.feed.keyed(rows)
        wanted = come.select(bucket_of(self.feed).alias("bucket")).distinct().collect()  # BUCKETS at most
        kinds = dict(come.select(*self.feed.key_names).dtypes)
        fields = ", ".join(f"{k} {kinds[k]}" for k in self.feed.key_names)
        log = self._log("keys", f"{fields}, load string, bucket int", load)
        log = log.filter(F.col("bucket").isin([r["bucket"] for r in wanted]))
        return log.join(come.select(*self.feed.key_names), self.feed.key_names, "left_semi").select(*self.feed.key_names).distinct()

    def _log(self, name: str, schema: str, load: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}").filter(F.col("load") != load)

    def compact(self, load: str) -> None:
        """One load in place of all so far, in a new folder; returns with the state on it."""
        new = KeyedState(self.spark, self.feed, f"{self.root}-{load}")
        self.ranges("").write.mode("overwrite").parquet(f"{new.root}/ranges/load={load}")
        kept = self.spark.read.parquet(f"{self.root}/keys").drop("load").distinct()
        kept.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{new.root}/keys/load={load}")
        self.root = new.root


def begin(spark: SparkSession, feed: pg.Feed, root: str, target: DataFrame) -> KeyedState:
    """The state of a table, read from it once; later runs go on with the state."""
    state = KeyedState(spark, feed, root)
    state.add(target, target, "start")
    return state


class KeyedRun:
    """One run over pages; what it loads is in ``loaded``, the summaries of its pages in ``pages``.

    ``name`` sets the run's loads apart from those of other runs on the same state.
    """

    def __init__(
        self, state: KeyedState, root: str, name: str, min_window: datetime, force_backfill: bool = False,
        high_watermark: datetime | None = None, cutoff_reason: str = "cutoff", page_cap: int | None = None,
    ):
        self.state, self.root, self.name, self.min_window = state, root, name, min_window
        self.force_backfill, self.high_watermark = force_backfill, high_watermark
        self.cutoff_reason, self.page_cap = cutoff_reason, page_cap
        self._write(state.spark.createDataFrame([], STOPS), "stops", -1)

    def _write(self, df: DataFrame, part: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{part}/batch_id={batch_id}")

    def _before(self, batch_id: int) -> tuple[int | None, bool]:
        """The last page of earlier batches, and whether one of them ended the run."""
        found = self.state.spark.read.parquet(f"{self.root}/stops").filter(F.col("batch_id") < batch_id)
        row = found.agg(F.max("last_seq").alias("last"), F.count("stop_seq").alias("stops")).first()
        return row["last"], row["stops"] > 0

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Load the pages of one micro-batch, unless the run has ended."""
        last, ended = self._before(batch_id)
        if ended:
            return
        feed, state, load = self.state.feed, self.state, f"{self.name}-{batch_id}"
        rows = stored(feed.shape(pg.page_rows(batch)))
        facts = batch.select("batch_seq", parse_ts("processed_at").alias("processed_at"), F.col("hasMore").alias("has_more"))
        facts = stored(facts)
        seqs = facts.agg(F.min("batch_seq").alias("low"), F.max("batch_seq").alias("high"), F.count(F.lit(1)).alias("n")).first()
        if seqs["n"] == 0:
            return
        if last is not None and seqs["low"] <= last:
            raise ValueError(f"page {seqs['low']} came after page {last}; use finish_run for pages in any order")
        inside = sh.in_window(rows, feed.ts, self.min_window)
        loaded = stored(pg.accepted_after(state.ranges(load), state.keys(inside, load), inside, feed))
        summary = pg.batch_stop_reason(
            pg.page_summary(facts, rows, loaded, feed.ts, self.min_window),
            self.high_watermark, self.min_window, self.force_backfill, self.cutoff_reason,
        )
        summary = stored(summary)
        stop = pg.first_stop(summary).first()
        if stop["stop_seq"] is not None:
            until = F.col("batch_seq") <= stop["stop_seq"]
            loaded, inside = loaded.filter(until), inside.filter(until)
        self._write(loaded, "loaded", batch_id)
        self._write(summary, "pages", batch_id)
        state.add(inside, loaded, load)
        # Last, as it says that the batch is whole.
        done = [(stop["stop_seq"], stop["stop_reason"], seqs["high"], load)]
        self._write(state.spark.createDataFrame(done, STOPS), "stops", batch_id)

    def load(self, pages_path: str, per_trigger: int = 1) -> None:
        """Load all waiting page files and return when none is left or the run has ended."""
        feed = self.state.feed
        query = (
            feeds.stream_pages(self.state.spark, pages_path, feed.row, per_trigger)
            .writeStream.foreachBatch(self.on_batch)
            .option("checkpointLocation", f"{self.root}/_stream")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def loaded(self) -> DataFrame:
        return self.state.spark.read.parquet(f"{self.root}/loaded").drop("batch_id")

    def pages(self) -> DataFrame:
        return self.state.spark.read.parquet(f"{self.root}/pages").drop("batch_id")

    def stop(self) -> DataFrame:
        """One row: stop_seq, stop_reason, cap_hit, sweep; the gate is closed where the cap on pages was hit."""
        stops = self.state.spark.read.parquet(f"{self.root}/stops").agg(
            F.min("stop_seq").alias("stop_seq"), F.min_by("stop_reason", "stop_seq").alias("stop_reason")
        )
        capped = self.page_cap is not None and self.pages().count() >= self.page_cap
        gate = pg.sweep_gate(F.col("stop_reason"), self.force_backfill, cap_hit=capped)
        return stops.withColumn("cap_hit", F.lit(capped)).withColumn("sweep", gate)

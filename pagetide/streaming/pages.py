"""Loading a feed page by page with Structured Streaming.

Pages are numbered in the order of the feed, newest rows first, and are judged in that order:
a page sees what the pages before it loaded, never what comes after it. Micro-batches may
group and deliver them in any way. Each appends the rows and the facts of its pages to two
logs in the run's folder, one directory per batch, written with overwrite, so that a batch
that is replayed writes the same again; it reads nothing but its own pages. ``finish_run``
works out the whole run from the logs at once, in the order of ``batch_seq``:

* A row is loaded if its key is new, i.e. neither in the table before the run nor on an
  earlier page, or if its time lies outside its owner's range. That range is the table's,
  widened by all rows of earlier pages: those that were not loaded lie inside it anyway.
* Pages after the first that ends the run count for nothing: not for rows, seen ids,
  dimension or history.
* The dimension is refreshed by each page that loaded rows, with the items of those rows (and,
  the first time, of the table's rows) that lie outside their author's range, widened likewise.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pagetide import schemas as S
from pagetide.functions.scalars import as_ts, micros, numeric_id, owner_key, parse_ts, ts_lit
from pagetide.operators import dimension as dm, expiry as ex, load as ld, shape as sh
from pagetide.plans.skew import parts_of, running_extremes, skew_join
from pagetide.sources import feeds
from pagetide.sources.tables import empty, stored

NATURAL_STOPS = ("hasMore", "cutoff")


# -- stop rules --------------------------------------------------------------------------


def batch_stop_reason(
    pages: DataFrame,
    high_watermark: datetime | None,
    min_window: datetime,
    force_backfill: bool = False,
    cutoff_reason: str = "cutoff",
    jump_seq: int | None = None,
) -> DataFrame:
    """Add ``stop_reason`` to page summaries, NULL where the run goes on.

    The first rule that holds wins: the feed has no more pages; the page's newest row is
    older than the window; nothing was inserted and the page's newest in-window row is older
    than the known newest. Pages before ``jump_seq`` ignore the last rule.
    """
    newest = F.when(F.col("n_in_window") > 0, F.col("in_window_max")).otherwise(F.col("raw_max"))
    caught_up = F.lit(False)
    if not force_backfill and high_watermark is not None:
        caught_up = (newest < ts_lit(high_watermark)) & (F.col("inserted") == 0)
        if jump_seq is not None:
            caught_up = caught_up & (F.col("batch_seq") >= jump_seq)
    reason = (
        F.when(~F.coalesce(F.col("has_more"), F.lit(False)), F.lit("hasMore"))
        .when(F.col("raw_max") < ts_lit(min_window), F.lit(cutoff_reason))
        .when(caught_up, F.lit("high_watermark"))
    )
    return pages.withColumn("stop_reason", reason)


def first_stop(pages: DataFrame) -> DataFrame:
    """One row: the first page with a stop reason, and the reason; NULLs if there is none."""
    return pages.agg(
        F.min(F.when(F.col("stop_reason").isNotNull(), F.col("batch_seq"))).alias("stop_seq"),
        F.min_by("stop_reason", F.when(F.col("stop_reason").isNotNull(), F.col("batch_seq"))).alias(
            "stop_reason"
        ),
    )


def sweep_gate(
    stop_reason: Column | str | None, forced: bool, cap_hit: bool = False, historical: bool = False
) -> Column:
    """Whether the final sweep may run: a forced run that reached its natural end."""
    reason = F.lit(stop_reason) if stop_reason is None or isinstance(stop_reason, str) else stop_reason
    natural = F.coalesce(reason.isin(*NATURAL_STOPS), F.lit(False))
    return natural & F.lit(forced and not cap_hit and not historical)


@dataclass(frozen=True)
class HistoricalWindow:
    """A load of past years: from the start of the older year, known rows up to the newer."""

    load_from: datetime
    known_until: datetime
    cutoff_reason: str = "end_year"


def historical_window(start_year: int, end_year: int) -> HistoricalWindow:
    """``start_year`` is the newer one; both from 2000 on. Such a run never expires rows."""
    if min(start_year, end_year) < 2000:
        raise ValueError(f"years must be 2000 or later: {start_year}, {end_year}")
    if start_year < end_year:
        raise ValueError(f"start year {start_year} must not be before end year {end_year}")
    return HistoricalWindow(datetime(end_year, 1, 1), datetime(start_year, 1, 1))


# -- page tables -------------------------------------------------------------------------


def page_rows(pages: DataFrame) -> DataFrame:
    """Rows of the pages with their ``batch_seq``; a page without a list has none."""
    return pages.select("batch_seq", F.explode("list").alias("_row")).select("batch_seq", "_row.*")


def page_summary(
    pages: DataFrame, rows: DataFrame, inserted: DataFrame, ts: str, min_window: datetime
) -> DataFrame:
    """One row per page: counts, newest times, inserted rows, the paging flag."""
    return _with_inserted(_page_totals(pages, rows, ts, min_window), inserted)


def _page_totals(pages: DataFrame, rows: DataFrame, ts: str, min_window: datetime) -> DataFrame:
    """What a page's own rows tell of it, whatever was loaded before."""
    when = as_ts(rows, ts)
    inside = when >= ts_lit(min_window)
    per_page = rows.groupBy("batch_seq").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(inside).alias("n_in_window"),
        F.max(when).alias("raw_max"),
        F.max(F.when(inside, when)).alias("in_window_max"),
    )
    zero = F.lit(0).cast("bigint")
    return pages.join(per_page, "batch_seq", "left").select(
        "batch_seq",
        "processed_at",
        "has_more",
        F.coalesce("n_rows", zero).alias("n_rows"),
        F.coalesce("n_in_window", zero).alias("n_in_window"),
        "raw_max",
        "in_window_max",
    )


def _with_inserted(totals: DataFrame, inserted: DataFrame) -> DataFrame:
    added = inserted.groupBy("batch_seq").agg(F.count(F.lit(1)).alias("inserted"))
    count = F.coalesce("inserted", F.lit(0).cast("bigint")).alias("inserted")
    return totals.join(added, "batch_seq", "left").select(*totals.columns, count)


# -- feeds -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Feed:
    """What sets one feed apart from the others."""

    name: str
    row: T.StructType
    table: T.StructType
    ts: str
    owner: str | None
    keys: tuple[str, ...]
    expires: bool
    has_dim: bool

    def shape(self, rows: DataFrame) -> DataFrame:
        if self.name == "purchases":
            shaped = sh.normalize_purchases(rows, keep=["batch_seq"])
        else:
            # The alignment keeps and types the fields of the items: they are not built twice.
            items = F.coalesce("media", F.array().cast(self.row["media"].dataType))
            shaped = sh.drop_bulky(rows).withColumn("media", items)
        schema = T.StructType([*self.table.fields, T.StructField("batch_seq", S.LONG)])
        return sh.align_to_schema(shaped, schema)

    @property
    def key_names(self) -> list[str]:
        return [f"_k{i}" for i in range(len(self.keys))]

    def keyed(self, rows: DataFrame) -> DataFrame:
        """Rows with their key, ``_owner`` and time ``_at`` in micros; without an owner all have one."""
        named = {k: owner_key(rows, c) if c == self.owner else F.col(c) for k, c in zip(self.key_names, self.keys)}
        owner = owner_key(rows, self.owner) if self.owner else F.lit(0).cast("bigint")
        return rows.withColumns({**named, "_owner": owner, "_at": micros(as_ts(rows, self.ts))})


MESSAGES = Feed("messages", S.MESSAGE_FEED, S.MESSAGES, "createdAt", "fromUser", ("id",), True, True)
POSTS = Feed("posts", S.POST_FEED, S.POSTS, "postedAt", "author", ("author", "id"), True, False)
PURCHASES = Feed(
    "purchases", S.PURCHASE_FEED, S.PURCHASES, "unlockAt", None, ("responseType", "id"), False, False
)


# -- run ---------------------------------------------------------------------------------


@dataclass
class Run:
    """One run over a feed's pages; ``root`` is a folder of its own on shared storage.

    The tables before the run are only referred to: give stored versions. A run of ``page_cap``
    pages without a reason to stop ends there; as it has not seen the feed's end, the final sweep stays shut.
    """

    spark: SparkSession
    feed: Feed
    root: str
    min_window: datetime
    run_ts: datetime
    author: int | None = None
    force_backfill: bool = False
    high_watermark: datetime | None = None
    cutoff_reason: str = "cutoff"
    historical: bool = False
    jump_seq: int | None = None
    retain_runs: int = dm.RETAIN_RUNS
    page_cap: int | None = None

    def start(
        self, target: DataFrame, dim: DataFrame | None = None, history: DataFrame | None = None
    ) -> None:
        """Name the tables as they are before the run; the dimension defaults to an empty one."""
        self.target = target
        self.dim = dim if dim is not None else empty(self.spark, S.dim_schema())
        self.history = history if history is not None else empty(self.spark, S.dim_schema())
        rows = T.StructType([*self.feed.table.fields, T.StructField("batch_seq", S.LONG)])
        self._write(empty(self.spark, rows), "rows", -1)
        self._write(empty(self.spark, FACTS), "facts", -1)

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Log the pages of one micro-batch."""
        self._write(self.feed.shape(page_rows(batch)), "rows", batch_id)
        facts = batch.select(
            "batch_seq", parse_ts("processed_at").alias("processed_at"), F.col("hasMore").alias("has_more")
        )
        self._write(facts, "facts", batch_id)

    def logged(self) -> tuple[DataFrame, DataFrame]:
        """Facts and rows of all pages; of a page that was delivered again, the first delivery.

        The rows are read from the log as it is, and stored anew only if some page is in it twice.
        """
        facts = self.spark.read.parquet(f"{self.root}/facts")
        first = facts.groupBy("batch_seq").agg(
            F.min("batch_id").alias("batch_id"),
            F.min_by("processed_at", "batch_id").alias("processed_at"),
            F.min_by("has_more", "batch_id").alias("has_more"),
            F.count(F.lit(1)).alias("n"),
        )
        rows = self.spark.read.parquet(f"{self.root}/rows")
        if not first.filter("n > 1 or batch_seq is null").isEmpty():
            rows = rows.join(first.select("batch_seq", "batch_id"), ["batch_seq", "batch_id"], "left_semi")
            rows = stored(rows)
        return first.drop("batch_id", "n"), rows.drop("batch_id")


FACTS = S.struct(batch_seq=S.LONG, processed_at=S.TS, has_more=S.BOOL)


@dataclass
class Outcome:
    """The tables after a run, and what the run did. The parts are lazy, on stored logs.

    Each of ``pages``, ``stop``, ``increment``, ``dim`` and ``history`` is worked out when it is first asked for.
    """

    run: Run
    target: DataFrame
    loaded: DataFrame  # rows loaded, with their page
    judged: Judged
    cap_hit: bool = False  # ended by the cap on pages

    @cached_property
    def stop(self) -> DataFrame:
        """stop_seq, stop_reason, sweep: one row."""
        # A run that the cap ends has no reason to stop, so its gate is shut.
        gate = sweep_gate(F.col("stop_reason"), self.run.force_backfill, historical=self.run.historical)
        return first_stop(self.judged.summary).withColumn("sweep", gate)

    @cached_property
    def pages(self) -> DataFrame:
        """Summary and stop reason of each page, those after the stop included."""
        return self.judged.all_pages()

    @cached_property
    def increment(self) -> DataFrame | None:
        """New versions, with the page that brought them; None for a feed without a dimension."""
        return stored(page_increments(self.run, self.loaded)) if self.run.feed.has_dim else None

    @cached_property
    def dim(self) -> DataFrame | None:
        if self.increment is None:
            return None
        return dm.scd2_rebuild(self.run.dim, self.increment.drop("batch_seq").distinct())

    @cached_property
    def history(self) -> DataFrame | None:
        if self.increment is None:
            return None
        added = dm.versions_by_page(self.run.dim, self.increment)
        return dm.history_prune(self.run.history.unionByName(added), self.run.retain_runs)


def stream_load(run: Run, pages_path: str, per_trigger: int = 1, max_bytes: int | None = None) -> None:
    """Log all waiting page files, ``per_trigger`` at a time, and return when none is left.

    With ``max_bytes`` a micro-batch takes files up to that size instead: micro-batches come one after
    the other, so a large one uses a cluster better.
    """
    source = feeds.stream_pages(run.spark, pages_path, run.feed.row, per_trigger, max_bytes)
    query = (
        source.writeStream.foreachBatch(run.on_batch)
        .option("checkpointLocation", f"{run.root}/_stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _page_marks(marks: DataFrame, part: list[str], *more: Column) -> DataFrame:
    """Smallest and largest time of a part on each page, stored as it has several readers.

    ``marks`` has the part, ``batch_seq``, ``_min`` and ``_max`` (micros), any number of rows per page;
    page -1 stands for the tables before the run.
    """
    ends = [F.min("_min").alias("_min"), F.max("_max").alias("_max")]
    return stored(marks.groupBy(*part, "batch_seq").agg(*ends, *more))


def _earlier_range(pages: DataFrame, part: list[str]) -> DataFrame:
    """Smallest and largest time of a part before each page: part, batch_seq, _low, _high."""
    ends = running_extremes(pages, part, "batch_seq", {"_high": F.col("_max")}, {"_low": F.col("_min")}, inclusive=False)
    return ends.select(*part, "batch_seq", "_low", "_high")


def _outside(at: Column) -> Column:
    """Whether a time lies outside the known range; with nothing known, any time does."""
    return F.coalesce(
        (F.col("_high").isNull() & at.isNotNull()) | (at < F.col("_low")) | (at > F.col("_high")), F.lit(False)
    )


def accepted(target: DataFrame, rows: DataFrame, feed: Feed) -> DataFrame:
    """Rows of the pages that a page-by-page load inserts, with their page.

    Rows that repeat within one page are all inserted, as a page is loaded at once. A null
    key is always new; a null owner has no range.
    """
    come, have = feed.keyed(rows), feed.keyed(target)
    return accepted_after(owner_ranges(have), ld.existing_keys(have, come, feed.key_names), rows, feed)


def owner_ranges(keyed: DataFrame) -> DataFrame:
    """_owner, _min, _max: smallest and largest time of each owner."""
    return keyed.groupBy("_owner").agg(F.min("_at").alias("_min"), F.max("_at").alias("_max"))


def accepted_after(known: DataFrame, before: DataFrame, rows: DataFrame, feed: Feed) -> DataFrame:
    """``accepted`` after what is ``known`` of owners and the keys that came ``before``."""
    come, keys = feed.keyed(rows), feed.key_names
    marks = [F.col("_owner"), F.col("_at").alias("_min"), F.col("_at").alias("_max")]
    seen = known.withColumn("batch_seq", F.lit(-1).cast("bigint")).unionByName(come.select(*marks, "batch_seq"))
    ranges = _earlier_range(_page_marks(seen.filter("_owner is not null"), ["_owner"]), ["_owner"])
    # First page of each key; -1 if it came before.
    before = before.withColumn("batch_seq", F.lit(-1).cast("bigint"))
    first = before.unionByName(come.select(*keys, "batch_seq")).groupBy(*keys).agg(F.min("batch_seq").alias("_first"))
    judged = come.join(ranges, ["_owner", "batch_seq"], "left")
    judged = judged.join(first, keys, "left")
    fresh = F.coalesce(F.col("_first") == F.col("batch_seq"), F.lit(True))
    return judged.filter(_outside(F.col("_at")) | fresh).select(*rows.columns)


def _with_items(rows: DataFrame, run: Run) -> DataFrame:
    """Message rows that the dimension looks at: author, time and items, not from the future."""
    return rows.filter(
        (as_ts(rows, run.feed.ts) <= ts_lit(run.run_ts) + F.expr("INTERVAL '1' DAY"))
        & owner_key(rows, run.feed.owner).isNotNull()
        & (F.size("media") > 0)
    )


def page_increments(run: Run, loaded: DataFrame) -> DataFrame:
    """New versions for the dimension, each with the page that brings it.

    The table's own rows are looked at by the first page that loads anything.
    """
    refresh = loaded.agg(F.min("batch_seq").alias("_refresh"))
    old = _with_items(run.target, run).join(F.broadcast(refresh.filter("_refresh is not null")))
    rows = _with_items(loaded, run).unionByName(old.withColumnRenamed("_refresh", "batch_seq"))
    keyed = rows.withColumns({"author_id": owner_key(rows, run.feed.owner), "_at": micros(as_ts(rows, run.feed.ts))})
    known = run.dim.groupBy("author_id").agg(
        micros(F.min("valid_from_ts")).alias("_min"), micros(F.max("valid_from_ts")).alias("_max")
    )
    marks = keyed.select("author_id", F.col("_at").alias("_min"), F.col("_at").alias("_max"), "batch_seq")
    marks = known.withColumn("batch_seq", F.lit(-1).cast("bigint")).unionByName(marks)
    pages = _page_marks(marks, ["author_id"], F.count(F.lit(1)).alias("_n"))
    ranges = _earlier_range(pages.drop("_n"), ["author_id"])
    # All rows of the table stand on one page, so an author's are one key of this join. The marks have counted them.
    hot = pages.select("author_id", "batch_seq", parts_of("_n").alias("_parts")).filter("_parts is not null")
    ranged = skew_join(keyed, ranges, ["author_id", "batch_seq"], "left", spread=["id", "_at"], hot=hot)
    new = ranged.filter(_outside(F.col("_at")))
    return dm.item_versions(new.select(*rows.columns), run.run_ts, keep=["batch_seq"])


@dataclass
class Judged:
    """The pages of a run in their order, and the rows that they load.

    That the feed ends or is past the window, a page's own rows tell. No page after the first such one
    counts, so rows are judged up to it; what later pages would have loaded is worked out only
    for a list of all pages.
    """

    run: Run
    totals: DataFrame  # of all pages, stored
    rows: DataFrame  # of all pages
    readers: int = 1

    @cached_property
    def natural(self):
        """stop_seq and stop_reason of the first page whose own rows end the run; Nones if there is none."""
        return first_stop(self.reasons(self.totals.withColumn("inserted", F.lit(1)))).first()

    def upto(self, df: DataFrame) -> DataFrame:
        seq = self.natural["stop_seq"]
        return df if seq is None else df.filter(F.col("batch_seq") <= seq)

    def reasons(self, summary: DataFrame) -> DataFrame:
        run = self.run
        return batch_stop_reason(
            summary, run.high_watermark, run.min_window, run.force_backfill, run.cutoff_reason, run.jump_seq
        )

    def load(self, rows: DataFrame) -> DataFrame:
        run = self.run
        return accepted(run.target, sh.in_window(rows, run.feed.ts, run.min_window), run.feed)

    @cached_property
    def loaded(self) -> DataFrame:
        """Rows that the pages up to ``natural`` load; stored where they have several readers."""
        found = self.load(self.upto(self.rows))
        return stored(found) if self.readers > 1 else found

    @cached_property
    def summary(self) -> DataFrame:
        """Summary and stop reason of the pages up to ``natural``."""
        return stored(self.reasons(_with_inserted(self.upto(self.totals), self.loaded)))

    def end(self):
        """stop_seq and stop_reason of the run. Loaded rows are only counted where a reason asks for them."""
        if self.run.high_watermark is None or self.run.force_backfill:
            return self.natural
        return first_stop(self.summary).first()

    def all_pages(self) -> DataFrame:
        seq = self.natural["stop_seq"]
        if seq is None or self.totals.filter(~F.coalesce(F.col("batch_seq") <= seq, F.lit(False))).isEmpty():
            return self.summary
        return stored(self.reasons(_with_inserted(self.totals, self.load(self.rows))))


def finish_run(run: Run) -> Outcome:
    """The tables after the run. A forced run that is not historical also expires rows.

    Rows that any page showed are revived; the author's rows that pages passed by without
    showing them are stamped; if the gate for the final sweep is open, so are all the author's
    rows in the window that were not shown. All of it is one pass over the table before the run:
    the rows it loads were shown, so there is nothing to revive or stamp among them.
    """
    feed, (facts, rows) = run.feed, run.logged()
    full = False
    if run.page_cap is not None:
        first = facts.select("batch_seq").orderBy("batch_seq").limit(run.page_cap)
        last = first.agg(F.max("batch_seq").alias("seq"), F.count(F.lit(1)).alias("n")).first()
        full = last["n"] == run.page_cap
        if full:
            until = F.coalesce(F.col("batch_seq") <= F.lit(last["seq"]), F.lit(False))
            facts, rows = facts.filter(until), rows.filter(until)
    totals = stored(_page_totals(facts, rows, feed.ts, run.min_window))
    # Besides the table, the dimension and the count that the mark asks for read the loaded rows.
    counted = run.high_watermark is not None and not run.force_backfill
    judged = Judged(run, totals, rows, readers=1 + feed.has_dim + counted)
    loaded, end, pages = judged.loaded, judged.end(), totals
    if end["stop_seq"] is not None:
        until = F.col("batch_seq") <= end["stop_seq"]
        pages, rows, loaded = totals.filter(until), rows.filter(until), loaded.filter(until)
    before = run.target
    if feed.expires:
        seen = rows.select("batch_seq", numeric_id(rows, "id").alias("id")).filter("id is not null")
        if not run.force_backfill or run.historical or run.author is None:
            before = ex.revive_seen(before, seen, feed.ts)[0]
        else:
            stamp = ts_lit(run.run_ts) if feed.has_dim else F.col("processed_at")
            passed = pages.select(
                F.lit(run.author).cast("bigint").alias("author_id"), "batch_seq", F.col("raw_max").alias("page_max"),
                stamp.alias("processed_at"),
            )
            before, _ = ex.progressive_expire(
                before, passed, seen, owner_col=feed.owner, ts=feed.ts, window_start=run.min_window,
                sweep=(run.author, run.run_ts) if end["stop_reason"] in NATURAL_STOPS else None,
            )
    target = before.unionByName(loaded.drop("batch_seq"))
    return Outcome(run, target, loaded, judged, full and end["stop_seq"] is None)


def write_pages(
    rows: DataFrame, path: str, processed_at: datetime, minutes: bool = False, per_file: int = 1
) -> None:
    """Page files from rows with a ``batch_seq``: a file has one line for each of ``per_file`` pages.

    A page is one response of the feed, so its rows fit one line; the last page by number
    has ``hasMore`` false. With ``minutes`` page n is stamped n minutes after ``processed_at``.
    Every file costs some milliseconds where it is written, listed and opened, and a stream takes files by
    their number, so a long feed is better kept with many pages to a file.
    """
    cols = [c for c in rows.columns if c != "batch_seq"]
    last = rows.agg(F.max("batch_seq").alias("_last"), F.min("batch_seq").alias("_from"))
    after = F.col("batch_seq") - F.col("_from") if minutes else F.lit(0)
    at = F.timestamp_add("MINUTE", after.cast("int"), F.lit(processed_at).cast("timestamp_ntz"))
    (
        rows.withColumn("_file", F.expr(f"batch_seq div {int(per_file)}"))
        .repartition("_file")
        .groupBy("_file", "batch_seq")
        .agg(F.collect_list(F.struct(*cols)).alias("list"))
        .join(F.broadcast(last))
        .select(
            F.col("_file").alias("page"),
            "batch_seq",
            F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("processed_at"),
            (F.col("batch_seq") < F.col("_last")).alias("hasMore"),
            "list",
        )
        .write.partitionBy("page")
        .json(path)
    )


__all__ = [
    "Feed", "HistoricalWindow", "MESSAGES", "Outcome", "POSTS", "PURCHASES", "Run", "accepted",
    "batch_stop_reason", "finish_run", "first_stop", "historical_window", "page_increments", "page_rows",
    "page_summary", "stream_load", "sweep_gate", "write_pages",
]

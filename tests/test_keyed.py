"""Runs by kept state: the rows of the whole-run form, at the cost of their own pages."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from pagetide import schemas as S
from pagetide.sources import feeds
from pagetide.streaming import keyed as kd, pages as pg

RUN, WINDOW = datetime(2024, 3, 1), datetime(2024, 1, 10)


def stamp(at):
    return at.strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def feed_rows(spark, rows):
    """rows: (page, id, author, time)"""
    data = [(i, None if a is None else (a,), "t" * 200, 1.0, 0, [], stamp(t), p) for p, i, a, t in rows]
    return spark.createDataFrame(data, T.StructType([*S.MESSAGE_FEED.fields, T.StructField("batch_seq", S.LONG)]))


def table_of(spark, rows):
    data = [(i, None if a is None else (a,), os.urandom(200).hex(), 1.0, 0, [], t, None) for i, a, t in rows]
    return spark.createDataFrame(data, S.MESSAGES)


def newest_first(n, seed):
    """Pages of eight rows, newest first, with repeats over pages, late rows and a row without an owner."""
    rng, at, out = random.Random(seed), datetime(2024, 2, 20), []
    for page in range(n):
        for _ in range(8):
            at -= timedelta(minutes=rng.randrange(900))
            out.append((page, rng.randrange(400), rng.choice([1, 1, 1, 2, 3, None]), at + timedelta(hours=rng.choice([0, 0, 0, 300]))))
    return out


@pytest.mark.parametrize("waves, mark", [(1, None), (4, None), (4, datetime(2024, 2, 10))])
def test_equal_to_the_whole_run(spark, tmp_path, waves, mark):
    rng = random.Random(5)
    target = table_of(spark, [(i, rng.choice([1, 2]), datetime(2024, 2, 1) + timedelta(hours=i)) for i in range(0, 200, 2)])
    pg.write_pages(feed_rows(spark, newest_first(12, 3)), str(tmp_path / "all"), RUN)
    pages = feeds.read_pages(spark, str(tmp_path / "all"), pg.MESSAGES.row)

    run = pg.Run(spark, pg.MESSAGES, str(tmp_path / "plain"), WINDOW, RUN, high_watermark=mark)
    run.start(target)
    pg.stream_load(run, str(tmp_path / "all"), 100)
    whole = pg.finish_run(run)

    state = kd.begin(spark, pg.MESSAGES, str(tmp_path / "state"), target)
    again = kd.KeyedRun(state, str(tmp_path / "keyed"), "a", WINDOW, high_watermark=mark)
    for wave in range(waves):
        part = pages.filter(F.col("batch_seq").between(wave * 12 // waves, (wave + 1) * 12 // waves - 1))
        part.coalesce(1).write.mode("append").json(str(tmp_path / "waves"))
        again.load(str(tmp_path / "waves"), 100)
    rows = lambda df: sorted((r["batch_seq"], r["id"], str(r["fromUser"]), r["createdAt"]) for r in df.collect())
    assert rows(again.loaded()) == rows(whole.loaded) and rows(again.loaded())
    stop, ended = whole.stop.first(), again.stop().first()
    assert (stop["stop_seq"], stop["stop_reason"], stop["sweep"]) == (ended["stop_seq"], ended["stop_reason"], ended["sweep"])


def test_a_second_run_costs_its_pages(spark, tmp_path, monkeypatch):
    """One percent of new pages reads under five percent of the table's bytes, and none after the stop."""
    n = 20_000
    target = table_of(spark, [(i, i % 50, datetime(2024, 1, 1) + timedelta(minutes=i)) for i in range(n)])
    target.write.parquet(str(tmp_path / "table"))
    target = spark.read.parquet(str(tmp_path / "table"))
    state = kd.begin(spark, pg.MESSAGES, str(tmp_path / "state"), target)
    size = lambda files: sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in files)
    new = [(p, n + 10 * p + k if k else 7, 3, datetime(2024, 1, 12) + timedelta(minutes=10 * p + k)) for p in range(2) for k in range(10)]
    read = []
    keys, ranges = kd.KeyedState.keys, kd.KeyedState.ranges
    monkeypatch.setattr(kd.KeyedState, "keys", lambda self, rows, load: read.append(keys(self, rows, load)) or read[-1])
    monkeypatch.setattr(kd.KeyedState, "ranges", lambda self, load: read.append(ranges(self, load)) or read[-1])
    pg.write_pages(feed_rows(spark, new), str(tmp_path / "pages"), RUN)
    run = kd.KeyedRun(state, str(tmp_path / "run"), "second", WINDOW)
    run.load(str(tmp_path / "pages"), 10)
    assert len(read) == 2 and size(f for df in read for f in df.inputFiles()) < 0.05 * size(target.inputFiles())
    assert run.loaded().count() == 18  # row 7 is known, and its time lies in its owner's range

    run.page_cap = 2
    assert run.stop().first()["cap_hit"]
    # The run has ended: what arrives now is not read, as a page that cannot be parsed shows.
    pages = []
    monkeypatch.setattr(pg, "page_rows", lambda batch: pages.append(batch))
    pg.write_pages(feed_rows(spark, [(9, 1, 1, RUN)]), str(tmp_path / "late"), RUN)
    spark.read.text(str(tmp_path / "late")).select("value").write.mode("append").text(str(tmp_path / "pages/page=9"))
    run.load(str(tmp_path / "pages"), 10)
    assert not pages


def test_replays_order_and_compaction(spark, tmp_path):
    target = table_of(spark, [(1, 1, datetime(2024, 2, 1))])
    state = kd.begin(spark, pg.MESSAGES, str(tmp_path / "state"), target)
    run = kd.KeyedRun(state, str(tmp_path / "run"), "a", WINDOW)
    pg.write_pages(feed_rows(spark, [(p, 10 + p, 1, datetime(2024, 2, 1)) for p in range(3)]), str(tmp_path / "pages"), RUN)
    pages = feeds.read_pages(spark, str(tmp_path / "pages"), pg.MESSAGES.row).withColumn("hasMore", F.lit(True))
    run.on_batch(pages.filter("batch_seq = 1"), 0)
    run.on_batch(pages.filter("batch_seq = 1"), 0)  # a replay
    assert [r["id"] for r in run.loaded().collect()] == [11]
    with pytest.raises(ValueError, match="any order"):
        run.on_batch(pages.filter("batch_seq = 0"), 1)
    state.compact("packed")
    run.on_batch(pages.filter("batch_seq = 2").unionByName(pages.filter("batch_seq = 1").withColumn("batch_seq", F.lit(3).cast("bigint"))), 1)
    assert sorted(r["id"] for r in run.loaded().collect()) == [11, 12]

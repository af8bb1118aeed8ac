"""What a streamed run works out, and what it leaves until it is asked for."""

import random
from datetime import datetime

import pytest
from pyspark.sql import Window, functions as F

from pagetide import schemas as S
from pagetide.catalog import feeds as catalog
from pagetide.functions import scalars as sc
from pagetide.operators import expiry as ex
from pagetide.plans import skew
from pagetide.sources import tables
from pagetide.streaming import pages as pg
from test_edges import item, messages
from test_skew import rows_of

AT = datetime(2024, 2, 1)
SF = "/root/testdata/sf0.001"


def run_of(spark, root):
    """Three pages; the first refreshes the dimension with the table's items too."""
    def page(seq, rows):
        return (seq, "2024-02-01T00:00:00Z", seq < 2,
                [(i, (a,), "t", 1.0, 1, [item(m)], f"2024-01-{day:02d}T00:00:00Z") for i, a, m, day in rows])

    pages = [page(0, [(9, 1, 1, 20)]), page(1, [(8, 1, 1, 19), (7, 2, 2, 19)]), page(2, [(6, 1, 2, 10)])]
    run = pg.Run(spark, pg.MESSAGES, str(root), datetime(2024, 1, 1), AT)
    run.start(messages(spark, [(k, 1 + k % 2, "old", [item(30 + k)], f"2024-01-{12 + k} 00:00:00", None) for k in range(5)]))
    run.on_batch(spark.createDataFrame(pages, S.page_schema(S.MESSAGE_FEED)), 0)
    return run


def test_a_run_works_out_its_dimension_when_asked(spark, tmp_path, monkeypatch):
    written, store = [], pg.stored
    monkeypatch.setattr(pg, "stored", lambda df: written.append(set(df.columns)) or store(df))
    out = pg.finish_run(run_of(spark, tmp_path / "run"))
    assert sorted(r.id for r in out.target.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9]
    assert not [w for w in written if {"author_id", "media_blob"} & w]
    assert sorted({r.media_id for r in out.dim.collect()}) == [1, 2, 30, 31, 32, 33, 34]
    assert out.history.count() >= 7 and out.increment.count() >= 7
    assert len([w for w in written if "media_blob" in w]) == 1  # all three read one stored increment


def test_a_feed_without_dimension_has_none(spark, tmp_path):
    run = pg.Run(spark, pg.POSTS, str(tmp_path / "run"), datetime(2024, 1, 1), AT)
    run.start(tables.empty(spark, S.POSTS))
    run.on_batch(spark.createDataFrame([(0, None, False, [])], S.page_schema(S.POST_FEED)), 0)
    out = pg.finish_run(run)
    assert out.increment is None and out.dim is None and out.history is None and out.target.count() == 0


def test_hot_authors_are_known_from_the_marks(spark, tmp_path, monkeypatch):
    """The rows are not counted once more, and an author cut into parts gets the same versions."""
    def versions(name):
        out = pg.finish_run(run_of(spark, tmp_path / name))
        return rows_of(out.increment)

    plain, cut = versions("plain"), []
    monkeypatch.setattr(skew, "hot_keys", lambda *a, **k: pytest.fail("keys counted on the rows"))
    monkeypatch.setattr(pg, "parts_of", lambda n: cut.append(n) or skew.parts_of(n, 1))
    assert versions("cut") == plain and cut


def test_empty_frames_start_no_python_worker(spark):
    kind = S.dim_schema()
    frame = tables.empty(spark, kind)
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in kind] and frame.count() == 0
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("bits", [1, 4, 40])
def test_both_extremes_in_one_scan(spark, inclusive, bits):
    rng = random.Random(5)
    data = [(rng.randrange(3), rng.randrange(-60, 200), rng.choice([None, rng.randrange(1000)])) for _ in range(200)]
    df = spark.createDataFrame(data, "p int, pos bigint, v bigint")
    w = Window.partitionBy("p").orderBy("pos").rangeBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    plain = df.withColumns({"hi": F.max("v").over(w), "lo": F.min("v").over(w)})
    v = F.col("v")
    assert rows_of(skew.running_extremes(df, ["p"], "pos", {"hi": v}, {"lo": v}, inclusive, bits)) == rows_of(plain)


def test_whole_numbers_are_their_own_digits(spark):
    df = spark.createDataFrame([(0,), (7,), (-7,), (2**63 - 1,), (-(2**63),), (None,)], "id bigint")
    for frame in (df, df.select(F.col("id").cast("string"))):
        found = frame.select(sc.numeric_id(frame, "id").alias("a"), sc.digits_id("id").alias("b")).collect()
        assert [r.a for r in found] == [r.b for r in found]


def test_only_rows_of_the_pages_authors_are_compared_with_the_seen(spark, monkeypatch):
    """Rows of other authors leave before the seen ids are looked up; the stamps are as before."""
    target = messages(spark, [(i, 1 + i % 3, "t", [], f"2024-01-{1 + i:02d} 00:00:00", None) for i in range(20)])
    pages = spark.createDataFrame(
        [(1, 0, datetime(2024, 1, 18), AT), (1, 1, datetime(2024, 1, 9), AT), (1, 2, datetime(2024, 1, 4), AT)],
        "author_id bigint, batch_seq bigint, page_max timestamp_ntz, processed_at timestamp_ntz")
    seen = spark.createDataFrame([(0, 9), (1, 12)], S.SEEN)
    plans, store = [], ex.stored
    monkeypatch.setattr(ex, "stored", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or store(df))
    out, _ = ex.progressive_expire(target, pages, seen, owner_col="fromUser", ts="createdAt", window_start=datetime(2024, 1, 3))
    assert sorted(r.id for r in out.filter("expired_ts is not null").collect()) == [6, 15, 18]
    assert plans[-1].index("Join LeftAnti") < plans[-1].index("Join LeftSemi")  # the plan is printed from the top


def posts_run(spark, root, **options):
    """Five pages of which the fourth is past the window; the table has posts 50 (shown) and 51 to 53."""
    def page(seq, rows):
        return (seq, f"2024-02-01T00:0{seq}:00Z", seq < 4,
                [(i, (1,), "t", 1.0, [], f"2024-01-{day:02d}T00:00:00Z", None, None, None) for i, day in rows])

    pages = [page(0, [(9, 20), (-7, 19)]), page(1, [(8, 18), (50, 17)]), page(2, [(8, 18), (7, 16)]),
             page(3, [(6, 9)]), page(4, [(5, 28), (4, 8)])]
    table = messages(spark, [(i, 1, "old", [], f"2024-01-{day} 00:00:00", None) for i, day in [(50, 17), (51, 18), (52, 15), (53, 19)]])
    table = table.select("id", F.col("fromUser").alias("author"), "text", "price", "media", F.col("createdAt").alias("postedAt"), "expired_ts")
    run = pg.Run(spark, pg.POSTS, str(root), datetime(2024, 1, 10), AT, **options)
    run.start(table)
    run.on_batch(spark.createDataFrame(pages, S.page_schema(S.POST_FEED)), 0)
    return run


def test_whole_rows_with_one_reader_are_not_copied(spark, tmp_path, monkeypatch):
    """Neither those of the table before a run, which are columns of a stored one, nor those it loads."""
    written, store = [], tables.stored

    def note(df):
        written.append(set(df.columns))
        return store(df)

    monkeypatch.setattr(tables, "stored", note)
    monkeypatch.setattr(pg, "stored", note)
    assert sorted(r.id for r in pg.finish_run(posts_run(spark, tmp_path / "run")).target.collect()) == [-7, 7, 8, 9, 50, 51, 52, 53]
    assert written and not [w for w in written if "text" in w]
    written.clear()
    assert catalog.Q["stream_load_historical"](spark, SF).count() > 0
    assert written and not [w for w in written if "text" in w]


def test_rows_are_judged_up_to_the_page_that_ends_the_feed(spark, tmp_path, monkeypatch):
    """Later pages count for nothing; what they would have loaded is worked out for a list of pages alone."""
    judged, accept = [], pg.accepted

    def note(target, rows, feed):
        judged.append({r.batch_seq for r in rows.select("batch_seq").distinct().collect()})
        return accept(target, rows, feed)

    monkeypatch.setattr(pg, "accepted", note)
    out = pg.finish_run(posts_run(spark, tmp_path / "run"))
    assert sorted(r.id for r in out.target.collect()) == [-7, 7, 8, 9, 50, 51, 52, 53]
    assert tuple(out.stop.first()) == (3, "cutoff", False)
    assert judged == [{0, 1, 2}]
    assert [(r.batch_seq, r.inserted, r.stop_reason) for r in out.pages.orderBy("batch_seq").collect()] == [
        (0, 2, None), (1, 1, None), (2, 1, None), (3, 0, "cutoff"), (4, 1, "hasMore")]
    assert judged == [{0, 1, 2}, {0, 1, 2, 4}]


def test_a_mark_still_ends_a_run_before_the_feed_does(spark, tmp_path):
    out = pg.finish_run(posts_run(spark, tmp_path / "run", high_watermark=datetime(2024, 1, 19)))
    assert tuple(out.stop.first()) == (3, "cutoff", False) and out.pages.count() == 5
    run = posts_run(spark, tmp_path / "more", high_watermark=datetime(2024, 1, 21))
    twice = [(k, None, True, [(8, (1,), "t", 1.0, [], "2024-01-18T00:00:00Z", None, None, None)]) for k in (2,)]
    run.on_batch(spark.createDataFrame(twice, S.page_schema(S.POST_FEED)), -1)  # page 2 came earlier, without post 7
    out = pg.finish_run(run)
    assert tuple(out.stop.first()) == (2, "high_watermark", False)
    assert sorted(r.id for r in out.target.collect()) == [-7, 8, 9, 50, 51, 52, 53] and sorted(r.id for r in out.loaded.collect()) == [-7, 8, 9]


def test_a_forced_run_looks_for_missing_rows_in_the_table_before_it(spark, tmp_path, monkeypatch):
    """Rows that it loads were shown, whatever their ids: they are not compared with the seen ones, nor stamped."""
    given, expire = [], ex.progressive_expire

    def note(target, *a, **k):
        given.append({r.id for r in target.select("id").collect()})
        return expire(target, *a, **k)

    monkeypatch.setattr(ex, "progressive_expire", note)
    out = pg.finish_run(posts_run(spark, tmp_path / "run", author=1, force_backfill=True))
    assert tuple(out.stop.first()) == (3, "cutoff", True)
    found = {r.id: r.expired_ts for r in out.target.collect()}
    assert found == {-7: None, 7: None, 8: None, 9: None, 50: None,
                     51: datetime(2024, 2, 1, 0, 3), 52: datetime(2024, 2, 1, 0, 3), 53: datetime(2024, 2, 1, 0, 1)}
    assert given == [{50, 51, 52, 53}]

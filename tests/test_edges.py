"""Hand-made rows for the corners of the semantics."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from pagetide import schemas as S
from pagetide.functions import scalars as sc
from pagetide.operators import dimension as dm, expiry as ex, filters as flt, load as ld, quality as ql, shape as sh
from pagetide.plans import origin as og
from pagetide.sources import feeds, tables
from pagetide.streaming import pages as pg


def item(i, duration=10):
    return (i, "video", False, True, False, None, True, duration, False)


def ts(text):
    return datetime.fromisoformat(text) if text else None


def messages(spark, rows):
    """rows: (id, author, text, items, created, expired)"""
    return spark.createDataFrame(
        [
            (i, None if a is None else (a,), t, 1.0, len(m or []), m, ts(c), ts(e))
            for i, a, t, m, c, e in rows
        ],
        S.MESSAGES,
    )


def posts(spark, rows):
    return spark.createDataFrame(
        [(i, (a,), t, 2.0, m, ts(p), ts(e)) for i, a, t, m, p, e in rows], S.POSTS
    )


def purchases(spark, rows):
    return spark.createDataFrame(
        [(k, "wall" if k == "post" else "chat", i, (a,), "t", 3.0, len(m), True, True, ts(u), m)
         for k, i, a, m, u in rows],
        S.PURCHASES,
    )


@pytest.mark.parametrize("lookup", ["asof", "join"])
def test_ids_running_backwards(spark, lookup):
    wall = posts(spark, [
        (1, 7, "a", [item(4508000000)], "2026-06-11 10:00:00", None),
        (2, 7, "b", [item(4508468661)], "2026-06-12 10:00:00", None),
        (3, 7, "c", [item(4508438257)], "2026-06-13 10:00:00", None),
    ])
    bands = {r.posted_date.day: (r.first_id, r.last_id) for r in og.day_bands(og.post_rows(wall)).collect()}
    assert bands[12] == (4508468661, 4508468661)
    assert bands[13] == (4508468661, og.OPEN_END)
    chat = messages(spark, [(9, 7, "x", [item(4508438273)], "2026-06-14 10:00:00", None)])
    out = og.origin_report_messages(chat, wall, purchases(spark, []), as_of=date(2026, 6, 20), lookup=lookup).collect()
    assert [r.approx_origin_date for r in out] == [date(2026, 6, 11)]


def test_report_corners(spark):
    wall = posts(spark, [(1, 1, "w", [item(100)], "2024-01-01 00:00:00", None),
                         (2, 1, "gone", [item(500)], "2024-01-02 00:00:00", "2024-01-03 00:00:00")])
    chat = messages(spark, [
        (1, 1, "Sale 50% off", [item(100, 29), item(101, 171)], "2024-01-05 00:00:00", None),
        (2, 1, None, None, "2024-01-05 00:00:00", None),
        (3, 1, "empty", [], "2024-01-05 00:00:00", None),
        (4, None, "no owner", [item(100)], "2024-01-05 00:00:00", None),
        (5, 1, "expired", [item(100)], "2024-01-05 00:00:00", "2024-01-06 00:00:00"),
        (6, 1, None, [item(100_000_000_001)], "2024-01-05 00:00:00", None),
        (7, 1, "early", [item(5)], "2024-01-05 00:00:00", None),
        (8, 1, "image", [item(100, 0)], "2024-01-05 00:00:00", None),
        (8, 1, "image", [item(100, 4)], "2024-01-06 00:00:00", None),
        (9, 1, "bought", [item(700)], "2024-01-06 00:00:00", None),
    ])
    bought = purchases(spark, [("post", 1, 2, [item(700)], "2024-01-01 00:00:00")])

    def report(**kw):
        return og.origin_report_messages(chat, wall, bought, as_of=date(2024, 1, 10), **kw).collect()

    out = {(r.msg_text, r.media_id): r for r in report()}
    assert set(out) == {("Sale 50% off", 100), ("Sale 50% off", 101), (None, 100_000_000_001), ("early", 5), ("image", 100)}
    assert out["Sale 50% off", 100].duration_ratio == 0.14
    assert out["Sale 50% off", 100].wall_text == "w"
    # Larger than the open end, and before the first band: no origin.
    assert out[None, 100_000_000_001].approx_origin_date == date(1900, 1, 1)
    assert out["early", 5].approx_origin_date == date(1900, 1, 1)
    # Rows without an origin pass the day filter.
    assert {r.media_id for r in report(last_n_days=1)} == {100_000_000_001, 5}
    assert {r.msg_text for r in report(text_any=["50% O"])} == {"Sale 50% off"}
    assert {r.msg_text for r in report(text_any=["s_le"])} == {"Sale 50% off"}
    assert {r.media_id for r in report(item_ids=[101])} == {101}
    assert report(authors=[99]) == []
    with pytest.raises(ValueError):
        og.origin_by_windows(chat, wall, bought, as_of=date(2024, 1, 10), days=[30, 0])


def test_purchases_sharing_an_id(spark):
    rows = purchases(spark, [("post", 5, 1, [item(1, 30)], "2024-01-01 00:00:00"),
                             ("message", 5, 1, [item(2, 70)], "2024-01-02 00:00:00")])
    wall = posts(spark, [(1, 1, "w", [item(1)], "2024-01-01 00:00:00", None)])

    def ratios(**kw):
        out = og.origin_report_purchases(rows, wall, as_of=date(2024, 1, 3), **kw).collect()
        return {r.media_id: r.duration_ratio for r in out}

    assert ratios() == {1: 0.3, 2: 0.7}
    assert ratios(key=("responseType", "id")) == {1: 1.0, 2: 1.0}


def test_timestamps(spark):
    texts = ["2024-01-10T05:00:00+00:00", "2024-01-10T05:00:00-05:00", "2024-01-10 05:00:00", "2024-01-10T05:00:00Z",
             "nonsense", "", None, "2024-01-10"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = [r[0] for r in df.select(sc.parse_ts("t")).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        five, ten = datetime(2024, 1, 10, 5), datetime(2024, 1, 10, 10)
        assert got == [five, ten, five, five, None, None, None, datetime(2024, 1, 10)]
    kept = sh.in_window(df, "t", datetime(2024, 1, 10, 5)).count()
    assert kept == 4 and sh.in_window(df, "t", None).count() == len(texts)


def test_rounding_matches_binary_doubles(spark):
    df = spark.createDataFrame([(29, 200), (1, 8), (0, 0)], "a int, b int")
    assert [r[0] for r in df.select(sc.duration_ratio("a", "b")).collect()] == [0.14, 0.13, None]


def test_normalize_purchases(spark):
    rows = [
        ("post", 1, (1,), None, None, "2024-01-01", "2023-01-01"),
        (None, 2, None, (2,), "x", "", "2024-01-02"),
        ("", 3, (3,), (9,), "", "2024-01-03", None),
        ("message", 4, (4,), None, "y", "2024-01-04", None),
        ("message", 5, None, None, "dropped", "", ""),
        ("message", None, (6,), None, "dropped", "2024-01-06", None),
    ]
    df = spark.createDataFrame(
        rows,
        "responseType string, id bigint, author struct<id: bigint>, fromUser struct<id: bigint>, text string, "
        "postedAt string, createdAt string",
    ).withColumn("media", F.lit(None).cast(S.ITEMS))
    out = {r.id: r for r in sh.normalize_purchases(df).collect()}
    assert {i: (r.responseType, r.unlockSource, r.author.id, r.text, r.unlockAt, r.media) for i, r in out.items()} == {
        1: ("post", "wall", 1, "", "2024-01-01", []),
        2: ("message", "chat", 2, "x", "2024-01-02", []),
        3: ("post", "wall", 3, "", "2024-01-03", []),
        4: ("message", "wall", 4, "y", "2024-01-04", []),
    }


def test_load_corners(spark):
    target = messages(spark, [(1, 1, "a", [], "2024-01-05 00:00:00", "2024-01-06 00:00:00"),
                              (2, 1, "b", [], "2024-01-10 00:00:00", None)])
    batch = messages(spark, [
        (1, 1, "known, inside", [], "2024-01-05 00:00:00", None),
        (2, 1, "known id, newer", [], "2024-01-11 00:00:00", None),
        (3, 1, "gap", [], "2024-01-07 00:00:00", None),
        (3, 1, "gap again", [], "2024-01-07 00:00:00", None),
        (4, 2, "new author", [], "2024-01-07 00:00:00", None),
        (2, None, "no author", [], "2024-01-07 00:00:00", None),
        (1, 1, "no time, known", [], None, None),
        (None, 1, "no id", [], "2024-01-07 00:00:00", None),
    ])
    new, inserted = ld.load_messages(target, batch)
    want = {"known id, newer", "gap", "gap again", "new author", "no author", "no id"}
    assert {r.text for r in inserted.collect()} == want
    assert new.count() == 8
    assert len(ld.load_messages(target, batch, dedup_batch=True)[1].filter("id = 3").collect()) == 1
    # A second load of the same batch adds nothing but rows that never match.
    again = ld.load_messages(new, batch.filter("id is not null and fromUser is not null"))[1]
    assert again.count() == 0
    assert {r.text for r in ld.load_messages(target, batch, dedup=False)[1].collect()} == {
        "known id, newer", "new author", "no author"}


def test_bounds_of_empty_and_out_of_window(spark):
    rows = messages(spark, [(1, 1, "a", [], "2020-01-05 00:00:00", None)])
    none = ld.watermark_bounds(rows, "createdAt", datetime(2024, 1, 1), owner="2", owner_col="fromUser").first()
    assert tuple(none) == (None, None, None, 0, 0)
    old = ld.watermark_bounds(rows, "createdAt", datetime(2024, 1, 1), owner="", owner_col="fromUser").first()
    assert tuple(old) == (None, None, datetime(2020, 1, 5), 0, 1)
    gone = ld.watermark_bounds(rows, "createdAt", None, owner=None, owner_col="fromUser", require_owner=True).first()
    assert gone.total_count == 0


def test_history_prune_keeps_unstamped_rows(spark):
    rows = [(1, None)] + [(i, datetime(2024, 1, i)) for i in range(2, 10)]
    df = spark.createDataFrame(rows, S.struct(i=S.LONG, extract_ts=S.TS))
    assert sorted(r.i for r in dm.history_prune(df, 2).collect()) == [1, 8, 9]
    assert sorted(r.i for r in dm.history_prune(df, 0).collect()) == [1, 5, 6, 7, 8, 9]
    assert dm.history_prune(df, 20).count() == 9


def test_dim_skips_gap_fills(spark):
    def at(i, day):
        return (i, 1, "m", [item(i)], f"2024-01-{day:02d} 00:00:00", None)

    empty = spark.createDataFrame([], S.dim_schema())
    run = datetime(2024, 1, 30)
    dim = tables.stored(dm.scd2_rebuild(empty, dm.dim_increment(messages(spark, [at(1, 5), at(2, 10)]), empty, run)))
    later = messages(spark, [at(3, 7), at(4, 11), at(5, 4), (6, None, "m", [item(6)], "2024-01-20 00:00:00", None),
                             (7, 1, "future", [item(7)], "2024-02-20 00:00:00", None)])
    assert {r.media_id for r in dm.dim_increment(later, dim, run).collect()} == {4, 5}
    assert {r.media_id for r in dm.dim_increment(later, dim, run, include_gaps=True).collect()} == {3, 4, 5}


def test_empty_seen_set_expires_the_window(spark):
    rows = messages(spark, [(1, 1, "a", [], "2024-01-05 00:00:00", None), (2, 1, "old", [], "2023-01-05 00:00:00", None),
                            (3, 2, "other", [], "2024-01-05 00:00:00", None)])
    seen = spark.createDataFrame([], S.SEEN)
    new, changes = ex.expire_unseen(rows, seen, author=1, owner_col="fromUser", ts="createdAt",
                                    window_start=datetime(2024, 1, 1), run_ts=datetime(2024, 2, 1))
    assert {r.id: r.expired_ts for r in new.collect()} == {1: datetime(2024, 2, 1), 2: None, 3: None}
    assert tuple(ex.change_summary(changes).first()) == (1, 0, datetime(2024, 1, 5))
    assert ld.not_in_seen(rows, seen).count() == 3 and ld.in_seen(rows, seen).count() == 0


def fold(rows, pages, author, window_start):
    """Page-by-page revive and expire, on plain Python rows."""
    state, seen, lowest = dict(rows), set(), None
    for seq, newest, stamp, ids in sorted(pages):
        seen |= ids
        for i in ids & set(state):
            a, t, _ = state[i]
            state[i] = (a, t, None)
        if newest is None:
            continue
        if lowest is None:
            lowest = newest
        elif newest < lowest:
            for i, (a, t, e) in state.items():
                if a == author and t >= window_start and t > newest and e is None and i not in seen:
                    state[i] = (a, t, stamp)
            lowest = newest
    return {i: e for i, (a, t, e) in state.items()}


@pytest.mark.parametrize("seed", range(3))
def test_progressive_expire_equals_the_fold(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 3)

    def day():
        return datetime(2024, 1, 1 + rng.randrange(20), rng.randrange(24))

    rows = {i: (rng.randrange(2), day(), day() if rng.random() < 0.3 else None) for i in range(60)}
    pages = [
        (s, day() if rng.random() < 0.9 else None, datetime(2024, 2, 1, s), set(rng.sample(range(60), rng.randrange(4))))
        for s in range(8)
    ]
    target = spark.createDataFrame(
        [(i, (a,), "t", None, 0, None, t, e) for i, (a, t, e) in rows.items()], S.MESSAGES
    )
    shuffled = pages[:]
    rng.shuffle(shuffled)
    page_df = spark.createDataFrame(
        [(1, s, n, p) for s, n, p, _ in shuffled], S.struct(author_id=S.LONG, batch_seq=S.LONG, page_max=S.TS, processed_at=S.TS)
    )
    seen = spark.createDataFrame([(s, i) for s, _, _, ids in shuffled for i in ids], S.SEEN)
    new, _ = ex.progressive_expire(target, page_df, seen, owner_col="fromUser", ts="createdAt", window_start=start)
    got = {r.id: r.expired_ts for r in new.collect()}
    want = fold(rows, pages, 1, start)
    # Without an advancing page nothing is expired; both agree on that too.
    assert got == want


def test_stop_rules(spark):
    def page(seq, more, n_in, raw, inside, inserted):
        return (seq, None, more, 5, n_in, raw, inside, inserted, None)

    rows = [
        page(0, True, 5, datetime(2024, 1, 20), datetime(2024, 1, 20), 0),
        page(1, True, 5, datetime(2024, 1, 9), datetime(2024, 1, 9), 3),
        page(2, True, 5, datetime(2024, 1, 8), datetime(2024, 1, 8), 0),
        page(3, True, 0, datetime(2023, 1, 8), None, 0),
        page(4, False, 0, None, None, 0),
        page(5, True, 0, None, None, 0),
    ]
    df = spark.createDataFrame(rows, S.PAGES).drop("stop_reason")

    def reasons(**kw):
        out = pg.batch_stop_reason(df, min_window=datetime(2024, 1, 1), **kw)
        return [r.stop_reason for r in out.orderBy("batch_seq").collect()]

    mark = datetime(2024, 1, 10)
    assert reasons(high_watermark=mark) == [None, None, "high_watermark", "cutoff", "hasMore", None]
    assert reasons(high_watermark=mark, force_backfill=True, cutoff_reason="end_year")[2:4] == [None, "end_year"]
    assert reasons(high_watermark=None)[2] is None
    assert reasons(high_watermark=mark, jump_seq=3)[2] is None
    stop = pg.first_stop(pg.batch_stop_reason(df, mark, datetime(2024, 1, 1))).first()
    assert tuple(stop) == (2, "high_watermark")
    gate = df.limit(1).select(pg.sweep_gate("hasMore", True), pg.sweep_gate("hasMore", False),
                              pg.sweep_gate("cutoff", True, cap_hit=True), pg.sweep_gate("end_year", True),
                              pg.sweep_gate(None, True), pg.sweep_gate("cutoff", True, historical=True)).first()
    assert tuple(gate) == (True, False, False, False, False, False)
    with pytest.raises(ValueError):
        pg.historical_window(2019, 2022)
    with pytest.raises(ValueError):
        pg.historical_window(2019, 1999)
    assert sh.rolling_cutoff(-1, datetime(2024, 1, 1)) == sh.rolling_cutoff(None, datetime(2024, 1, 1)) == datetime(2022, 1, 1)


GROUPINGS = {
    "at once": [[0, 1, 2, 3]],
    "one by one": [[0], [1], [2], [3]],
    "reversed": [[3], [2], [1], [0]],
    "shuffled": [[2], [0, 3], [1]],
    "again": [[0, 1], [1], [2, 3], [0]],
}


@pytest.mark.parametrize("name", GROUPINGS)
def test_run_does_not_depend_on_grouping(spark, tmp_path, name):
    """Pages that overlap and one after the end, in any order and grouping: one result."""

    def row(i, day):
        return {"id": i, "fromUser": {"id": 1}, "text": f"m{i}", "price": 1.0, "mediaCount": 1,
                "media": [{"id": 10 + i, "duration": 5, "extra": 1}], "createdAt": f"2024-01-{day:02d}T00:00:00Z"}

    listed = {0: [row(9, 20), row(8, 19)], 1: [row(8, 19), row(7, 18)], 2: [row(6, 17), row(5, 12), row(5, 12)],
              3: [row(4, 11)]}
    pages = {
        s: {"batch_seq": s, "processed_at": "2024-02-01T00:00:00Z", "hasMore": s != 2, "list": rows}
        for s, rows in listed.items()
    }
    target = messages(spark, [(7, 1, "m7", [item(17)], "2024-01-18 00:00:00", "2024-01-25 00:00:00"),
                              (3, 1, "unseen", [item(13)], "2024-01-15 00:00:00", None),
                              (2, 1, "too old", [item(12)], "2023-01-15 00:00:00", None)])
    run = pg.Run(spark, pg.MESSAGES, str(tmp_path / "run"), datetime(2024, 1, 1), datetime(2024, 2, 1, 9),
                 author=1, force_backfill=True)
    run.start(target)
    schema = S.page_schema(S.MESSAGE_FEED)
    for k, group in enumerate(GROUPINGS[name]):
        import json

        lines = spark.createDataFrame([(json.dumps(pages[s]),) for s in group], "value string")
        batch = lines.select(F.from_json("value", schema).alias("p")).select("p.*")
        run.on_batch(batch, k)
        run.on_batch(batch, k)  # a replay
    out = pg.finish_run(run)
    gone = datetime(2024, 2, 1, 9)
    rows = sorted((r.id, r.expired_ts) for r in out.target.collect())
    # Id 5 stands twice on one page and is loaded twice; page 3 comes after the end.
    assert rows == [(2, None), (3, gone), (5, None), (5, None), (6, None), (7, None), (8, None), (9, None)]
    # The first page takes in the table's items too; 16 lies inside the range by then, 15 too.
    assert sorted(r.media_id for r in out.dim.collect()) == [12, 13, 17, 18, 19]
    assert sorted((r.media_id, r.seen_count) for r in out.history.collect()) == [(i, 1) for i in (12, 13, 17, 18, 19)]
    assert tuple(out.stop.first()) == (2, "hasMore", True)
    assert [r.inserted for r in out.pages.orderBy("batch_seq").collect()] == [2, 0, 3, 1]


@pytest.mark.parametrize("cap,n,stop,hit", [(1, 1, (None, None, False), True), (3, 3, (2, "hasMore", True), False),
                                            (9, 3, (2, "hasMore", True), False)])
def test_run_ends_at_the_cap_on_pages(spark, tmp_path, cap, n, stop, hit):
    """Pages after the cap count for nothing, and what they would show is not swept."""
    at = datetime(2024, 1, 20)
    rows = [(7 - s, (1,), f"m{s}", 1.0, 0, [], f"2024-01-{20 - s:02d}T00:00:00Z", s) for s in range(3)]
    kind = T.StructType([*S.MESSAGE_FEED.fields, T.StructField("batch_seq", S.LONG)])
    pg.write_pages(spark.createDataFrame(rows, kind), str(tmp_path / "pages"), at)
    target = messages(spark, [(7 - s, 1, "old", [], f"2024-01-{20 - s:02d} 00:00:00", None) for s in range(5)])
    run = pg.Run(spark, pg.MESSAGES, str(tmp_path / "run"), datetime(2024, 1, 1), datetime(2024, 2, 1),
                 author=1, force_backfill=True, page_cap=cap)
    run.start(target)
    pg.stream_load(run, str(tmp_path / "pages"), 10)
    out = pg.finish_run(run)
    assert tuple(out.stop.first()) == stop and out.cap_hit == hit and out.pages.count() == n
    expired = {r.id for r in out.target.filter("expired_ts is not null").collect()}
    assert expired == (set() if hit else {3, 4})


def test_run_grows_an_empty_dimension_page_by_page(spark, tmp_path):
    """Each page that loads rows refreshes the dimension and adds to the history."""
    def page(seq, rows):
        return (seq, "2024-02-01T00:00:00Z", seq < 2,
                [(i, (1,), "t", 1.0, 1, [item(m)], f"2024-01-{day:02d}T00:00:00Z") for i, m, day in rows])

    pages = [page(0, [(9, 1, 20)]), page(1, [(8, 1, 19), (7, 2, 19)]), page(2, [(6, 2, 10)])]
    run = pg.Run(spark, pg.MESSAGES, str(tmp_path / "run"), datetime(2024, 1, 1), datetime(2024, 2, 1))
    run.start(messages(spark, []))
    run.on_batch(spark.createDataFrame(pages, S.page_schema(S.MESSAGE_FEED)), 0)
    out = pg.finish_run(run)
    assert sorted((r.media_id, r.seen_count, r.valid_from_ts.day) for r in out.dim.collect()) == [
        (1, 1, 19), (1, 2, 20), (2, 1, 10), (2, 2, 19)]
    history = sorted((r.media_id, r.seen_count, r.valid_from_ts.day) for r in out.history.collect())
    assert history == [(1, 1, 19), (1, 1, 20), (1, 2, 20), (2, 1, 10), (2, 1, 19), (2, 2, 19)]


def test_stream_reads_one_page_per_trigger(spark, tmp_path):
    rows = spark.range(1, 40).select(
        "id", F.struct(F.lit(1).cast("bigint").alias("id")).alias("fromUser"), F.lit("t").alias("text"), F.lit(1.0).alias("price"),
        F.lit(0).alias("mediaCount"), F.array().cast(S.ITEMS).alias("media"),
        F.lit("2024-01-10T00:00:00Z").alias("createdAt"), F.expr("(40 - id) div 10").alias("batch_seq"),
    )
    pg.write_pages(rows, str(tmp_path / "pages"), datetime(2024, 2, 1))
    run = pg.Run(spark, pg.MESSAGES, str(tmp_path / "run"), datetime(2024, 1, 1), datetime(2024, 2, 1))
    run.start(messages(spark, []))
    pg.stream_load(run, str(tmp_path / "pages"))
    batches = spark.read.parquet(f"{run.root}/facts").groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in batches) == [1, 1, 1, 1]
    assert pg.finish_run(run).target.count() == 39


@pytest.mark.parametrize("per_file,files", [(1, 40), (16, 3)])
def test_pages_that_share_files_are_the_same_run(spark, tmp_path, per_file, files):
    """Micro-batches take files by number, so their count must follow the feed's size and not its pages."""
    rows = spark.range(401).select(
        "id", F.struct((F.col("id") % 3).alias("id")).alias("fromUser"), F.lit("t").alias("text"), F.lit(1.0).alias("price"),
        F.lit(0).alias("mediaCount"), F.array().cast(S.ITEMS).alias("media"),
        F.concat(F.lit("2024-01-"), F.lpad(F.expr("string(1 + id div 14)"), 2, "0"), F.lit("T00:00:00Z")).alias("createdAt"),
        F.expr("(400 - id) div 10 + 5").alias("batch_seq"),
    ).filter("id > 0")
    pg.write_pages(rows, str(tmp_path / "pages"), datetime(2024, 2, 1), minutes=True, per_file=per_file)
    pages = feeds.read_pages(spark, str(tmp_path / "pages"), S.MESSAGE_FEED)
    assert len(pages.inputFiles()) == files and pages.count() == 40
    run = pg.Run(spark, pg.MESSAGES, str(tmp_path / "run"), datetime(2024, 1, 20), datetime(2024, 2, 1))
    run.start(messages(spark, [(30, 1, "old", [], "2024-01-22 00:00:00", None)]))
    pg.stream_load(run, str(tmp_path / "pages"), 8)
    assert spark.read.parquet(f"{run.root}/facts").select("batch_id").distinct().count() == -(-files // 8)
    out = pg.finish_run(run)
    judged = sorted((r.batch_seq, r.processed_at, r.n_rows, r.inserted, r.stop_reason) for r in out.pages.filter("batch_seq < 19").collect())
    assert [j[0] for j in judged] == [*range(5, 19)] and judged[3][1] == datetime(2024, 2, 1, 0, 3)
    assert [j[2] for j in judged] == [10] * 14 and {j[4] for j in judged} == {None}
    assert tuple(out.stop.first()) == (19, "cutoff", False)
    assert sorted(r.id for r in out.target.collect()) == [30, *range(266, 401)]


def test_a_run_reads_its_log_once_and_does_not_copy_it(spark, tmp_path, monkeypatch):
    """Micro-batches by size; the rows of pages that came once are not written again, nor aggregated repeatedly."""
    rows = spark.range(1, 401).select(
        "id", F.struct((F.col("id") % 3).alias("id")).alias("fromUser"), F.lit("t").alias("text"), F.lit(1.0).alias("price"),
        F.lit(0).alias("mediaCount"), F.array().cast(S.ITEMS).alias("media"),
        F.concat(F.lit("2024-01-"), F.lpad(F.expr("string(1 + id div 14)"), 2, "0"), F.lit("T00:00:00Z")).alias("createdAt"),
        F.expr("(400 - id) div 10").alias("batch_seq"),
    )
    pg.write_pages(rows, str(tmp_path / "pages"), datetime(2024, 2, 1))
    size = sum(f.stat().st_size for f in (tmp_path / "pages").glob("*/*.json"))
    written, store = [], pg.stored
    monkeypatch.setattr(pg, "stored", lambda df: written.append(set(df.columns)) or store(df))
    for k, (most, batches) in enumerate([(2**30, 1), (size // 4 + 1, 4)]):
        run = pg.Run(spark, pg.MESSAGES, str(tmp_path / f"run{k}"), datetime(2024, 1, 20), datetime(2024, 2, 1))
        run.start(messages(spark, [(30, 1, "old", [], "2024-01-22 00:00:00", None)]))
        pg.stream_load(run, str(tmp_path / "pages"), max_bytes=most)
        found = spark.read.parquet(f"{run.root}/facts").select("batch_id").distinct().count()
        assert found == batches if batches == 1 else batches <= found <= batches + 2
        written.clear()
        out = pg.finish_run(run)
        assert sorted(r.id for r in out.target.collect()) == [30, *range(266, 401)]
        assert [w for w in written if "text" in w and "batch_seq" in w] == [{*S.MESSAGES.names, "batch_seq"}]  # the loaded ones
        assert written.count({"_owner", "batch_seq", "_min", "_max"}) == 1


def test_overlaps_without_pairs(spark):
    def at(day):
        return None if day is None else datetime(2024, 1, day)

    links = [(1, 5, 1, 1, None), (1, 5, 2, 3, 5), (1, 5, 3, 5, 6), (1, 5, 4, 5, 5), (1, 5, 5, 5, None), (1, 6, 6, 2, 3),
             (1, 6, 7, 3, 4), (2, 5, 8, 1, None)]
    df = spark.createDataFrame(
        [(a, m, c, at(f), at(t)) for a, m, c, f, t in links],
        S.struct(author_id=S.LONG, media_id=S.LONG, chat_id=S.LONG, valid_from_ts=S.TS, valid_to_ts=S.TS),
    )
    out = {r.chat_id: r.n_open for r in dm.overlap_join(df, datetime(2024, 2, 1)).collect()}
    assert out == {1: 0, 2: 1, 3: 1, 4: 2, 5: 2, 6: 0, 7: 0, 8: 0}


def test_report_is_ordered(spark):
    rows = [(1, 0.5, 3, 1), (2, None, 9, 1), (3, 0.5, 7, 1), (4, 0.9, 1, 1)]
    df = spark.createDataFrame(rows, "media_id int, duration_ratio double, duration int, x int")
    assert [r.media_id for r in og.report_order(df).collect()] == [4, 3, 1, 2]


def test_schema_growth_and_dry_run(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, text string")
    grown = sh.ensure_columns(df, {"expired_ts": S.TS})
    assert grown.columns == ["id", "text", "expired_ts"] and sh.ensure_columns(grown, {"text": "int"}).schema == grown.schema
    assert sh.empty_like(grown).schema == grown.schema
    rows = messages(spark, [(1, 1, "a", [], "2024-01-05 00:00:00", "2024-01-06 00:00:00")])
    same, listed = ex.clear_expired(rows, [1], "fromUser", "createdAt", dry_run=True)
    assert same is rows and listed.count() == 1
    assert ql.table_parity(rows, rows).first() == (0, 0)
    assert flt.filter_item_ids(df.withColumnRenamed("id", "media_id"), []).count() == 1


def test_versions_have_folders_of_their_own(spark, tmp_path):
    root = str(tmp_path / "table")
    tables.write_version(spark.range(1), root, 1)
    tables.write_version(spark.range(2), root, 2)
    with pytest.raises(Exception, match="exists"):
        tables.write_version(spark.range(3), root, 2)
    assert tables.read_version(spark, root).count() == 2 and tables.read_version(spark, root, 1).count() == 1
    with pytest.raises(ValueError):
        flt.filter_origin_years(spark.range(1), 2024, None)

"""Fixed schemas of the feeds, the staging tables and the item dimension.

Feed rows carry timestamps as text. Staging tables hold UTC wall time in
``TIMESTAMP_NTZ`` columns, so that no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
STRING, BOOL, TS, DATE = T.StringType(), T.BooleanType(), T.TimestampNTZType(), T.DateType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ITEM = struct(
    id=LONG,
    type=STRING,
    convertedToVideo=BOOL,
    canView=BOOL,
    hasError=BOOL,
    createdAt=STRING,
    isReady=BOOL,
    duration=LONG,
    hasCustomPreview=BOOL,
)
OWNER = struct(id=LONG)
ITEMS = T.ArrayType(ITEM)

MESSAGES = struct(
    id=LONG,
    fromUser=OWNER,
    text=STRING,
    price=DOUBLE,
    mediaCount=INT,
    media=ITEMS,
    createdAt=TS,
    expired_ts=TS,
)
POSTS = struct(
    id=LONG,
    author=OWNER,
    text=STRING,
    price=DOUBLE,
    media=ITEMS,
    postedAt=TS,
    expired_ts=TS,
)
PURCHASES = struct(
    responseType=STRING,
    unlockSource=STRING,
    id=LONG,
    author=OWNER,
    text=STRING,
    price=DOUBLE,
    mediaCount=INT,
    isOpened=BOOL,
    isMediaReady=BOOL,
    unlockAt=TS,
    media=ITEMS,
)

MESSAGE_FEED = struct(
    id=LONG, fromUser=OWNER, text=STRING, price=DOUBLE, mediaCount=INT, media=ITEMS,
    createdAt=STRING,
)
POST_FEED = struct(
    id=LONG, author=OWNER, text=STRING, price=DOUBLE, media=ITEMS, postedAt=STRING,
    isMarkdownDisabled=BOOL, fundRaising=STRING, linkedPosts=STRING,
)
PURCHASE_FEED = struct(
    responseType=STRING, id=LONG, author=OWNER, fromUser=OWNER, text=STRING, price=DOUBLE,
    mediaCount=INT, isOpened=BOOL, isMediaReady=BOOL, postedAt=STRING, createdAt=STRING,
    media=ITEMS,
)


def page_schema(row: T.StructType) -> T.StructType:
    """One page of a feed: the rows, the paging flag and the page's place in the run."""
    return T.StructType(
        [
            T.StructField("batch_seq", LONG),
            T.StructField("processed_at", STRING),
            T.StructField("hasMore", BOOL),
            T.StructField("list", T.ArrayType(row)),
        ]
    )


def dim_schema(delete_aware: bool = False) -> T.StructType:
    """Item dimension and its history log; the delete-aware form has two more columns."""
    fields = struct(
        author_id=LONG,
        media_id=LONG,
        media_duration=LONG,
        media_blob=STRING,
        seen_count=INT,
        valid_from_ts=TS,
        valid_to_ts=TS,
        is_current=BOOL,
        extract_ts=TS,
    )
    if delete_aware:
        fields = fields.add("is_deleted", BOOL).add("checksum", STRING)
    return fields


SEEN = struct(batch_seq=LONG, id=LONG)
PAGES = struct(
    batch_seq=LONG,
    processed_at=TS,
    has_more=BOOL,
    n_rows=LONG,
    n_in_window=LONG,
    raw_max=TS,
    in_window_max=TS,
    inserted=LONG,
    stop_reason=STRING,
)

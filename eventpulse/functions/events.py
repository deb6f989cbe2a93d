"""Event vocabulary, schemas and the scalar expressions that staging, marts and figures share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Mart column and the event type that it counts.
BREAKOUTS = {
    "pushes": "PushEvent",
    "stars": "WatchEvent",
    "forks": "ForkEvent",
    "issues": "IssuesEvent",
    "pull_requests": "PullRequestEvent",
    "releases": "ReleaseEvent",
}
#: The event types that the feed is known to publish.
KNOWN_TYPES = [
    "PushEvent",
    "CreateEvent",
    "DeleteEvent",
    "PullRequestEvent",
    "IssueCommentEvent",
    "IssuesEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "WatchEvent",
    "ReleaseEvent",
    "ForkEvent",
    "MemberEvent",
    "CommitCommentEvent",
    "GollumEvent",
    "PublicEvent",
    "DiscussionEvent",
    "DiscussionCommentEvent",
]

#: An archived event; nested objects stay JSON text, byte for byte.
ARCHIVE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("actor", T.StringType()),
        T.StructField("repo", T.StringType()),
        T.StructField("org", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("public", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
#: A lake row: the event and its partition, held inside the file too.
LAKE = T.StructType([*ARCHIVE.fields, T.StructField("dt", T.DateType()), T.StructField("hr", T.LongType())])

#: Floors of the published numbers.
AGGREGATE_FLOOR, TRENDING_FLOOR, BUSY_FLOOR = 20, 5, 20
HOURS_A_DAY = 24


def json_text(column: Column | str, key: str) -> Column:
    return F.get_json_object(column, f"$.{key}")


def bound(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with these columns, each computed once a row.

    A generator of one row stands between them and what uses them: plain projections are merged, and then an expression is copied to each place that names it, stage over stage.
    """
    return rows.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def breakouts(event_type: Column | str) -> list[Column]:
    kind = F.col(event_type) if isinstance(event_type, str) else event_type
    return [F.count_if(kind == value).alias(name) for name, value in BREAKOUTS.items()]


def latest(value: Column, at: Column, *ties: Column) -> Column:
    """The non-null value of the latest row; ``ties`` decide among rows of one time."""
    return F.max_by(value, F.when(value.isNotNull(), F.struct(at, *ties)))


def short_name_matches(name: Column) -> Column:
    r"""Whether the part after the first slash is 5 to 8 lower-case letters; \z, so that no line end may follow."""
    return F.split_part(name, F.lit("/"), F.lit(2)).rlike(r"^[a-z]{5,8}\z")


def hour_end(day: Column, hour: Column) -> Column:
    """When an hour of a day is over (no zone)."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=hour.cast("int") + 1)

"""Timestamp parsing of the two archive formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The archive's textual formats.
POST_FORMAT = "MMM dd HH:mm:ss Z yyyy"          # after the leading 'EEE ' weekday
POST_RENDER = "EEE MMM dd HH:mm:ss Z yyyy"
DM_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSX"
DM_RENDER = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def post_epoch(created_at: Column) -> Column:
    """``'Tue Mar 19 14:05:17 +0000 2019'`` -> epoch seconds (offset-aware).  Spark
    does not parse the weekday letter, so the first 4 characters are skipped."""
    return F.unix_seconds(F.try_to_timestamp(F.substring(created_at, 5, 64), F.lit(POST_FORMAT)))


def dm_epoch(created_at: Column) -> Column:
    """``'2022-01-27T15:58:52.744Z'`` -> epoch seconds rounded half-even from the
    milliseconds (``Z`` read as UTC)."""
    ms = F.unix_millis(F.try_to_timestamp(created_at, F.lit(DM_FORMAT)))
    return F.bround(ms / F.lit(1000.0), 0).cast("bigint")


def render_post_time(ts: Column) -> Column:
    return F.date_format(ts, POST_RENDER)


def render_dm_time(ts: Column) -> Column:
    return F.concat(F.date_format(ts, DM_RENDER), F.lit("Z"))

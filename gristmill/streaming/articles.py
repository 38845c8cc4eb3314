"""The article stream: titles, alerts, out-of-order rows and window counts.

The branches that need no state share one query. The windows and the detector
keep state of their own, so each is a query with its own checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gristmill.operators.messages import parse_articles
from gristmill.streaming import detector, fanout, runs, windows

HEADER = {"header": True}


def start_articles(
    messages: Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    keyword: str,
    seq: str,
    limit: int = 100,
    size: str = "1 minute",
    slide: str = "10 seconds",
    ts: str | None = None,
    trigger: dict | None = None,
) -> dict[str, StreamingQuery]:
    """Start the queries. ``messages`` opens the stream with the message in
    ``value`` and its running number in ``seq``, such as the offset of the topic.

    Windows go by processing time, or by the event-time column ``ts`` of the
    stream, which replays alike. The trigger interval and the number of rows per
    file bound the files of the window counts.
    """

    def articles() -> DataFrame:
        kept = [seq] if ts is None else [seq, ts]
        return parse_articles(messages(), *kept)

    branches = {
        "titles": fanout.Branch(lambda d: d.select("title"), "csv", HEADER),
        "high_priority": fanout.Branch(
            lambda d: fanout.alerts(d, limit).select("title", "comment_count"), "csv", HEADER
        ),
    }
    timed = (
        windows.with_processing_time(articles(), "0 seconds")
        if ts is None
        else windows.with_event_time(articles(), ts)
    )
    counts = windows.keyword_windows(timed, F.col("content").contains(keyword), size, slide)
    return {
        "branches": fanout.fan_out(
            articles(), branches, out, f"{checkpoint}/branches", trigger
        ),
        "counts": runs.write_batches(
            counts,
            f"{out}/counts",
            f"{checkpoint}/counts",
            trigger=trigger,
            format="csv",
            per_file=10_000,
        ),
        "out_of_order": detector.by_batches(
            articles().select(seq, "title", "publish_ts"),
            seq,
            "publish_ts",
            f"{out}/out_of_order",
            f"{checkpoint}/last",
            f"{checkpoint}/out_of_order",
            trigger=trigger,
        ),
    }

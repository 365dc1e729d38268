"""Control-port transcripts as tables: reply framing, FIFO pairing, reply
values, identity and version rules.

A transcript is (connection keys, seq, line) per direction. Framing and
pairing use skew-safe ordered scans, so one long-lived connection is never
gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strobe.operators.ordering import ordered_scan, position_within

# Fixed protocol patterns. The identity reply starts with the device's product
# token; it is a parameter here (any single token by default).
IDENTITY_TEMPLATE = r"^{device} SW: (.*) FPGA: (.*) rootfs: (.*)"
API_PATTERN = r"^(\d+).(\d+)"
MODE_MIN_VERSION = (4, 0)


def frame_replies(lines: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Group received lines into replies.

    A reply is one line, or a run of ``!`` lines closed by ``.``; ``.`` alone
    is an empty multi-line reply. A line ends a reply if it is ``.`` or does
    not start with ``!``. Adds ``reply_no`` (0-based) to every line.
    """
    ends = ((F.col("line") == ".") | ~F.col("line").startswith("!")).cast("long")
    marked = lines.withColumn("__end", ends)
    return ordered_scan(marked, keys, [order], out="reply_no", weight="__end").drop("__end")


def replies(framed: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """One row per complete reply: (keys, reply_no, lines, kind).

    kind: ``single`` (one line), ``multiline`` (``!`` lines closed by ``.``),
    ``error`` (a run of ``!`` lines closed by anything but ``.``), ``open``
    (a trailing run with no closing line yet). Replies are bounded in size.
    """
    g = framed.groupBy(*keys, "reply_no").agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("n"), F.col("line").alias("line")))).alias("__l")
    )
    lines = F.transform("__l", lambda x: x["line"])
    last = F.element_at(lines, -1)
    n = F.size(lines)
    closed = (last == ".") | ~last.startswith("!")
    kind = (
        F.when(~closed, F.lit("open"))
        .when(last == ".", F.lit("multiline"))
        .when(n == 1, F.lit("single"))
        .otherwise(F.lit("error"))
    )
    return g.select(*keys, "reply_no", lines.alias("lines"), kind.alias("kind"))


def reply_value(lines: Column, kind: Column) -> dict[str, Column]:
    """Reply extraction: ``OK`` -> done; ``OK =x`` -> x (text after four
    characters); multi-line -> the lines without ``!`` and without the
    closing ``.``; anything else is an error."""
    first = F.get(lines, 0)
    status = (
        F.when(kind == "multiline", F.lit("multiline"))
        .when((kind == "single") & (first == "OK"), F.lit("ok"))
        .when((kind == "single") & first.startswith("OK ="), F.lit("value"))
        .otherwise(F.lit("error"))
    )
    items = F.transform(F.slice(lines, 1, F.size(lines) - 1), lambda x: F.substring(x, 2, 1 << 30))
    value = F.when(status == "value", F.substring(first, 5, 1 << 30))
    return {
        "status": status,
        "value": value,
        "items": F.when(status == "multiline", items),
    }


def pair_fifo(requests: DataFrame, answers: DataFrame, keys: list[str], order: str) -> DataFrame:
    """n-th request on a connection pairs with its n-th reply (full outer
    join on (keys, n)): unanswered requests keep a NULL reply, and a reply
    without a request is reported with a NULL request."""
    rq = position_within(requests, keys, [order], out="n")
    rp = position_within(answers, keys, [order], out="n")
    rq = rq.select(*keys, "n", *[F.col(c).alias(f"request_{c}") for c in rq.columns if c not in keys + ["n"]])
    rp = rp.select(*keys, "n", *[F.col(c).alias(f"reply_{c}") for c in rp.columns if c not in keys + ["n"]])
    return rq.join(rp, [*keys, "n"], "full_outer")


def identity(line: Column, device: str = r"\S+") -> dict[str, Column]:
    """``*IDN?`` reply -> software, FPGA and rootfs versions (NULL: no match).
    Groups are greedy, as in the protocol description."""
    pattern = IDENTITY_TEMPLATE.format(device=device)
    ok = line.rlike(pattern)
    return {
        "software": F.when(ok, F.regexp_extract(line, pattern, 1)),
        "fpga": F.when(ok, F.regexp_extract(line, pattern, 2)),
        "rootfs": F.when(ok, F.regexp_extract(line, pattern, 3)),
    }


def api_version(software: Column) -> dict[str, Column]:
    """(major, minor) from the start of the software version; the separator
    may be any character; no match gives NULLs (an error upstream)."""
    ok = software.rlike(API_PATTERN)
    return {
        "major": F.when(ok, F.regexp_extract(software, API_PATTERN, 1).cast("int")),
        "minor": F.when(ok, F.regexp_extract(software, API_PATTERN, 2).cast("int")),
    }


def version_at_least(major: Column, minor: Column, version: tuple[int, int]) -> Column:
    return (major > version[0]) | ((major == version[0]) & (minor >= version[1]))

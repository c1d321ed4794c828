"""A dated list joined to captures as of the time they were fetched.

Changes of a list (an entry added or removed on a day) become validity intervals.  A capture is tested
against the intervals of its host and of every parent domain that hold on its day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOST = "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host_of(url: Column) -> Column:
    """Lower-case host, without user and port; null where there is none."""
    host = F.regexp_extract(F.lower(url), HOST, 1)
    return F.when(host != "", host)


def domains_of(host: Column) -> Column:
    """The host and all its parent domains."""
    parts = F.split(host, "\\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))


def validity(changes: DataFrame) -> DataFrame:
    """entry, day, listed -> entry, intervals (valid_from, valid_to; the end is open when null).

    Of several changes of an entry on one day, an addition wins.  Repeated states merge into the
    interval they continue only by touching it, which tests the same.  Rows with nulls are no changes.
    """
    daily = changes.filter("entry is not null and day is not null and listed is not null").groupBy("entry", "day").agg(
        F.max("listed").alias("listed"))
    history = daily.groupBy("entry").agg(F.array_sort(F.collect_list(F.struct("day", "listed"))).alias("h"))
    spans = F.transform("h", lambda x, i: F.struct(
        x["day"].alias("valid_from"), F.get("h", i + 1)["day"].alias("valid_to"), x["listed"].alias("listed")))
    return history.select("entry", F.filter(spans, lambda s: s["listed"]).alias("intervals")).filter(F.size("intervals") > 0)


def active_entries(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """captures (host, day, any others) plus n_active and active_entries, the entries that hold then.

    Captures of one host and day are tested once, so a host with a third of all captures costs its
    number of days.  Captures without host or day have no entries.
    """
    keys = captures.select("host", "day").filter("host is not null and day is not null").distinct()
    tested = keys.select("host", "day", F.explode(domains_of(F.col("host"))).alias("entry")).join(validity(changes), "entry")
    holds = F.exists("intervals", lambda s: (s["valid_from"] <= F.col("day")) & (
        s["valid_to"].isNull() | (F.col("day") < s["valid_to"])))
    found = tested.filter(holds).groupBy("host", "day").agg(F.array_sort(F.collect_list("entry")).alias("_active"))
    return captures.join(found, ["host", "day"], "left").withColumns({
        "n_active": F.coalesce(F.size("_active"), F.lit(0)).cast("bigint"),
        "active_entries": F.coalesce(F.array_join("_active", ","), F.lit("")),
    }).drop("_active")

"""URL filters: dated list entries as validity intervals, joined as of the fetch date.  DataFrame operations only.

A list entry says that from a date on a key is listed or no longer listed.  Keys are domains, which cover their
subdomains, and a host with a path prefix.  The entries of a key become intervals, and every capture is judged by the
entries active on the day of its fetch.

Captures meet the lists as distinct pairs of URL and day, then of key and day, so a host with a third of all captures is
looked up once a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"


def url_host(url: Column) -> Column:
    """Lower-case host without port, user or trailing dot; empty where there is none, null for a null URL."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, _URL, 1)), r"\.$", "")


def url_path(url: Column) -> Column:
    """The path without query and fragment."""
    return F.regexp_extract(url, _URL, 2)


def url_keys(url: Column) -> Column:
    """Array of the keys that can cover a URL: every domain of at least two labels that the host ends in, or the host if it
    is one label, and the host with every prefix of the path by whole segments."""
    host = url_host(url)
    labels = F.split(host, r"\.")
    first = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
    domains = F.transform(first, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.filter(F.split(url_path(url), "/"), lambda p: p != "")
    none = F.array().cast("array<string>")
    depth = F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts)))
    paths = F.transform(depth, lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")))
    return F.when(host != "", F.concat(domains, F.coalesce(paths, none))).otherwise(none)


def entry_key(key: Column) -> Column:
    """A list key as captures have it: the host lower-case, the path as it is, since paths tell capitals apart."""
    host = F.substring_index(key, "/", 1)
    return F.concat(F.lower(host), F.substring(key, F.length(host) + 1, F.length(key)))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (list_name, kind, key, valid_from, valid_to) from entries (list_name, kind, key, listed, dated).

    ``valid_to`` is the first day on which the entry no longer holds, null while it does.  Of entries of one list, key and
    day, one that lists wins.  Hosts of keys are lower-cased, paths are not.  Entries without key or date are left out; null ``listed`` counts as delisting.
    """
    days = entries.where(F.col("key").isNotNull() & F.col("dated").isNotNull())
    days = days.groupBy("list_name", "kind", entry_key(F.col("key")).alias("key"), F.to_date("dated").alias("dated")).agg(
        F.max(F.coalesce("listed", F.lit(False))).alias("listed")
    )
    per_key = Window.partitionBy("list_name", "kind", "key").orderBy("dated")
    spans = days.withColumn("valid_to", F.lead("dated").over(per_key)).where("listed")
    return spans.select("list_name", "kind", "key", F.col("dated").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per capture (page_id, url, fetched): page_id, host, fetched_on, n_active, key, list_name, kind, blocked.

    ``n_active`` counts the entries active on the day of the fetch that cover the URL.  The one with the longest key
    decides; of equal keys "block" before "allow", then the first list by name.  A capture with no active entry, a null
    URL or a null fetch date is not blocked, its key null.  Captures that repeat are judged each.
    """
    rows = captures.select("page_id", "url", F.to_date("fetched").alias("fetched_on"))
    pairs = rows.where("url is not null and fetched_on is not null").select("url", "fetched_on").distinct()
    keyed = pairs.select("url", "fetched_on", F.explode(url_keys(F.col("url"))).alias("key"))
    spans = validity(entries).withColumnRenamed("key", "_key")
    active = keyed.select("key", "fetched_on").distinct().join(
        spans,
        (F.col("key") == F.col("_key"))
        & (F.col("fetched_on") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to"))),
    )
    rank = F.when(F.col("kind") == "block", 0).otherwise(1)
    found = active.groupBy(F.col("key").alias("_key"), F.col("fetched_on").alias("_day")).agg(
        F.count("*").alias("n"), F.min(F.struct(rank, "list_name", "kind")).alias("e")
    )
    hit = keyed.join(found, (F.col("key") == F.col("_key")) & (F.col("fetched_on") == F.col("_day")))
    best = hit.groupBy(F.col("url").alias("_url"), F.col("fetched_on").alias("_on")).agg(
        F.sum("n").alias("n_active"), F.max(F.struct(F.length("key"), "key", "e")).alias("best")
    )
    judged = rows.join(best, (F.col("url") == F.col("_url")) & (F.col("fetched_on") == F.col("_on")), "left")
    return judged.select(
        "page_id",
        F.coalesce(url_host(F.col("url")), F.lit("")).alias("host"),
        "fetched_on",
        F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.col("best.key").alias("key"),
        F.col("best.e.list_name").alias("list_name"),
        F.col("best.e.kind").alias("kind"),
        F.coalesce(F.col("best.e.kind") == "block", F.lit(False)).alias("blocked"),
    )

"""Revisit records that were answered "not modified", resolved to the response they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import settle

# Header fields that a "not modified" answer may update.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")

PARTS = r"^\s*([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?"


def canonical_url(url: Column | str) -> Column:
    """Scheme and host in small letters, no credentials, default port, fragment or leading ``www.``;
    an empty path is ``/`` and others lose one final slash; parameters are sorted and those named ``utm_*`` dropped.

    Null stays null; what does not look like a URL stays as it is.
    """
    url = F.col(url) if isinstance(url, str) else url

    def part(n: int) -> Column:
        return F.regexp_extract(url, PARTS, n)

    scheme, port = F.lower(part(1)), part(3)
    host = F.regexp_replace(F.lower(part(2)), r"^www\.", "")
    usual = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    path = F.regexp_replace(part(4), r"(.)/$", "$1")
    kept = F.array_sort(F.filter(F.split(part(5), "&"), lambda p: (p != "") & ~F.lower(p).startswith("utm_")))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    whole = F.concat(scheme, F.lit("://"), host, F.when(usual, "").otherwise(F.concat(F.lit(":"), port)), F.when(path == "", "/").otherwise(path), query)
    return F.when(part(1) == "", url).otherwise(whole)


def _strong(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(tag), r"^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Each revisit with the latest earlier full response of its canonical URL.

    ``records``: ``(record_id, kind, url, date, status, headers, digest)`` with kind ``response`` or
    ``revisit``, headers a map with names in small letters.  A full response has status 200.
    The result has one row a revisit, ``(record_id, canonical_url, date, outcome, original_id, validator, headers, digest)``:

    * ``resolved``: a validator agreed - entity tags (compared weakly) if both have one, else modification
      times, else digests; ``headers`` are the original's, updated by those of the revisit that are ``PERMITTED``;
    * ``mismatch``: the first validator that both have differs; ``unchecked``: they have none in common.
      The original is named, its headers and digest are not taken over;
    * ``no_original``: no full response is earlier.  Null URLs and dates come out so.

    Of responses of one date the greatest record id counts; a response of the revisit's own date is not earlier.
    A URL's captures are dealt over tasks by date, so one with very many of them is no bottleneck.
    Repeated rows are resolved each; other columns are not looked at.
    """
    names = ("record_id", "kind", "url", "date", "status", "headers", "digest")
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("date").isNotNull() & F.col("url").isNotNull()
    taken = records.select(*names).filter(full | (F.col("kind") == "revisit"))
    keyed = taken.select(canonical_url("url").alias("canonical_url"), "date", full.cast("int").alias("is_full"), "record_id", "headers", "digest")
    order = ("date", "is_full", "record_id")
    dealt, _ = settle(keyed.repartitionByRange("canonical_url", *order).withColumn("part", F.spark_partition_id()), "captures")
    source = F.when(F.col("is_full") == 1, F.struct("record_id", "headers", "digest"))
    inside = Window.partitionBy("canonical_url", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = dealt.withColumn("found", F.last(source, ignorenulls=True).over(inside)).filter("is_full = 0")
    # a URL goes on in the next part only at the border between two, so this is at most a row a part
    ends = dealt.groupBy("canonical_url", "part").agg(F.max_by(source, F.when(F.col("is_full") == 1, F.struct(*order))).alias("end"))
    parts = Window.partitionBy("canonical_url")
    ends = ends.withColumn("first", F.min("part").over(parts)).withColumn("last", F.max("part").over(parts)).filter("first < last")
    before = parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("canonical_url", "part", F.last("end", ignorenulls=True).over(before).alias("carried"))
    both = near.join(carried, ["canonical_url", "part"], "left").withColumn("found", F.coalesce("found", "carried"))
    both = both.withColumn("found", F.when(F.col("date").isNotNull() & F.col("canonical_url").isNotNull(), F.col("found")))

    def pair(name: str) -> tuple[Column, Column]:
        return F.col("headers")[name], F.col("found.headers")[name]

    tag, old_tag = (_strong(t) for t in pair("etag"))
    time, old_time = pair("last-modified")
    checks = (("etag", tag, old_tag), ("last-modified", time, old_time), ("digest", F.col("digest"), F.col("found.digest")))
    validator, agrees = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for name, new, old in reversed(checks):
        there = new.isNotNull() & old.isNotNull()
        validator, agrees = F.when(there, name).otherwise(validator), F.when(there, new == old).otherwise(agrees)
    outcome = F.when(F.col("found").isNull(), "no_original").when(agrees.isNull(), "unchecked").when(agrees, "resolved").otherwise("mismatch")
    updates = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter(F.coalesce("found.headers", F.create_map().cast("map<string,string>")), lambda k, v: ~F.array_contains(F.map_keys(updates), k))
    resolved = F.col("outcome") == "resolved"
    return both.withColumn("outcome", outcome).withColumn("validator", validator).select(
        "record_id", "canonical_url", "date", "outcome", F.col("found.record_id").alias("original_id"), "validator",
        F.when(resolved, F.map_concat(kept, updates)).alias("headers"), F.when(resolved, F.col("found.digest")).alias("digest"),
    )


def with_payload(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """``resolved`` with ``payload`` of the original from ``payloads`` ``(record_id, payload)``; unresolved rows keep null."""
    kept = payloads.select(F.col("record_id").alias("_original"), "payload")
    on = (F.col("original_id") == F.col("_original")) & (F.col("outcome") == "resolved")
    return resolved.join(kept, on, "left").drop("_original")

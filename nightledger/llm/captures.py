"""Not-modified captures of web archives, resolved to the full response they stand for.

A revisit record has no content. It is joined as of its time to the latest earlier full response of the same
canonical URL. If the validators agree it gets that response's content, and the response's headers with those that a
not-modified answer may renew.

The as-of join never sorts one URL in one task: captures are dealt by ranges of (URL, time, id), so a hot URL spreads
over many ranges; inside a range a window finds the latest response, and of each range only the last response of a URL is carried
on to the next ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.frames import cut_lineage

# Headers a not-modified answer does not renew, and parameters that do not name a page.
NOT_RENEWED = ["content-encoding", "content-length", "content-range", "content-type", "transfer-encoding"]
TRACKING = "^(utm_[a-z]+|fbclid|gclid|ref)="
ABSOLUTE = "^[A-Za-z][A-Za-z0-9+.-]*://"


def canonical(url: Column) -> Column:
    """URL without scheme, www., default port, fragment, tracking parameters and closing slash; host in lower case.

    Remaining parameters are sorted. Null stays null; what is no absolute URL stays as it is.
    """
    plain = F.regexp_replace(url, "#.*$", "")
    host = F.lower(F.regexp_extract(plain, ABSOLUTE + "([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^www[.]", "")
    path = F.regexp_replace(F.regexp_extract(plain, ABSOLUTE + "[^/?]*([^?]*)", 1), "/+$", "")
    given = F.split(F.regexp_extract(plain, "[?](.*)$", 1), "&")
    kept = F.array_sort(F.filter(given, lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(url.rlike(ABSOLUTE), F.concat(host, path, query)).otherwise(url)


def _latest(records: DataFrame) -> DataFrame:
    """The revisits of ``records`` with ``source``, time and id of the latest response before them."""
    dealt = records.repartitionByRange("key", "captured_at", "record_id").withColumn("part", F.spark_partition_id())
    full = F.when(F.col("kind") == "response", F.struct("captured_at", "record_id"))
    dealt = cut_lineage(dealt.withColumn("full", full))
    before = Window.unboundedPreceding, -1
    ends = dealt.groupBy("key", "part").agg(F.max("full").alias("last"))  # a row per URL and range
    carried = F.max("last").over(Window.partitionBy("key").orderBy("part").rowsBetween(*before))
    ends = ends.select("key", "part", carried.alias("carried"))
    own = F.max("full").over(Window.partitionBy("key", "part").orderBy("captured_at", "record_id").rowsBetween(*before))
    placed = dealt.withColumn("own", own).where("kind = 'revisit'").join(ends, ["key", "part"])
    return placed.withColumn("source", F.coalesce("own", "carried")).drop("own", "carried", "part", "full")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit of ``records`` with the response it stands for.

    ``records`` has record_id, url, captured_at, kind ('response' or 'revisit'), etag, last_modified, headers (a map with lower-case
    names) and payload. Returned are record_id, key (the canonical URL), captured_at, response_id, status, headers and payload.
    The response is the last before the revisit in the order of (captured_at, record_id). Status is 'resolved'; 'changed' if a
    validator both have differs; 'unchecked' if they have none in common; 'missing' without an earlier response, or
    without URL, time or id. Only a resolved revisit has a payload; another keeps its own headers. Entity tags agree
    without their weak mark, and decide before the time of modification. Null headers count as none. Repeated rows
    are resolved each; repeated responses are one, and of responses that clash in id and time the one with the smallest digest
    counts. Other kinds and further columns are ignored.
    """
    columns = ["record_id", "key", "captured_at", "kind", "etag", "last_modified", "headers"]
    keyed = records.withColumn("key", canonical(F.col("url")))
    light = keyed.where("kind in ('response', 'revisit')").select(*columns)
    known = "key is not null and captured_at is not null and record_id is not null"
    placed = _latest(light.where(known))
    lost = light.where(f"kind = 'revisit' and not ({known})").withColumn("source", F.lit(None).cast(placed.schema["source"].dataType))
    revisits = placed.unionByName(lost).withColumn("response_id", F.col("source.record_id"))

    digest = F.struct(F.xxhash64("payload"), F.xxhash64(F.array_sort(F.map_entries("headers"))), "etag", "last_modified")
    content = F.struct("etag", "last_modified", "headers", "payload")
    responses = keyed.where(f"kind = 'response' and {known}").groupBy("key", "captured_at", "record_id")
    responses = responses.agg(F.min_by(content, digest).alias("one")).select(
        F.col("key").alias("_key"),
        F.struct("captured_at", "record_id").alias("_source"),
        F.col("one.etag").alias("_etag"),
        F.col("one.last_modified").alias("_modified"),
        F.col("one.headers").alias("_headers"),
        F.col("one.payload").alias("_payload"),
    )
    met = revisits.join(responses, (F.col("key") == F.col("_key")) & (F.col("source") == F.col("_source")), "left")
    bare = {c: F.regexp_replace(c, "^W/", "") for c in ("etag", "_etag")}
    same = F.coalesce(bare["etag"] == bare["_etag"], F.col("last_modified") == F.col("_modified"))
    status = F.when(F.col("_source").isNull(), "missing").when(same.isNull(), "unchecked")
    met = met.withColumn("status", status.when(same, "resolved").otherwise("changed"))
    none = F.create_map().cast("map<string,string>")
    old, new = (F.coalesce(F.col(c), none) for c in ("_headers", "headers"))
    renewed = F.map_filter(new, lambda k, _: ~k.isin(NOT_RENEWED))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(renewed, k)), renewed)
    done = F.col("status") == "resolved"
    return met.select(
        "record_id",
        "key",
        "captured_at",
        "response_id",
        "status",
        F.when(done, merged).otherwise(F.col("headers")).alias("headers"),
        F.when(done, F.col("_payload")).alias("payload"),
    )

"""Not-modified revisits of a web archive, resolved to the response they stand for.

A revisit record has no body: the server said 304. It is joined, as of its time,
to the latest earlier full response of the same canonical URL. If the validators
agree, the revisit takes that response's body and its headers, with the header
fields that a 304 may update merged in.

The as-of join never needs all captures of a URL in one task. Captures are dealt
by URL and time bucket; inside a bucket a window looks back, and what earlier
buckets had is carried in from one row per URL and bucket. Bodies take no part,
only their digests do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Header fields that a 304 response updates.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Seconds of a URL's captures that one task sees together.
BUCKET_SECONDS = 3600

_TRACKING = r"^(utm_[a-z]*|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without a default port, path without a closing slash, query sorted
    and without tracking parameters; scheme and fragment dropped. Null where there is no host."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]+)", 1)
    host = F.regexp_replace(F.lower(host), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]+([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(plain, r"^[^?]*\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(_TRACKING))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, tail))


def _lower(headers: Column) -> Column:
    """Header fields as a sorted array of (key, value), names in lower case; of doubled names the last by order."""
    fields = F.transform(
        F.map_entries(headers), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value"))
    )
    fields = F.array_sort(F.filter(fields, lambda e: e["value"].isNotNull()))
    last = F.filter(fields, lambda e, i: (i == F.size(fields) - 1) | (F.get(fields, i + 1)["key"] != e["key"]))
    return F.coalesce(last, F.array().cast("array<struct<key:string,value:string>>"))


def _field(fields: Column, name: str) -> Column:
    return F.get(F.filter(fields, lambda e: e["key"] == name), F.lit(0))["value"]


def _etag(fields: Column) -> Column:
    return F.regexp_replace(F.trim(_field(fields, "etag")), "^[Ww]/", "")


def _status(ours: Column, theirs: Column) -> Column:
    """How a revisit's validators compare with the response's."""
    etags, dates = (_etag(ours), _etag(theirs)), (_field(ours, "last-modified"), _field(theirs, "last-modified"))
    return (
        F.when(etags[0].isNotNull() & etags[1].isNotNull(), F.when(etags[0] == etags[1], "resolved").otherwise("mismatch"))
        .when(dates[0].isNotNull() & dates[1].isNotNull(), F.when(dates[0] == dates[1], "resolved").otherwise("mismatch"))
        .otherwise("no validator")
    )


def _merged(ours: Column, theirs: Column) -> Column:
    """The response's fields, those that a 304 may update replaced by the revisit's."""
    allowed = F.array(*map(F.lit, PERMITTED))
    new = F.filter(ours, lambda e: F.array_contains(allowed, e["key"]))
    names = F.transform(new, lambda e: e["key"])
    kept = F.filter(theirs, lambda e: ~F.array_contains(names, e["key"]))
    return F.array_sort(F.concat(kept, new))


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Every record with what it stands for.

    ``records``: record_id, url, captured (timestamp), record_type ('response' or
    'revisit'), headers (map of strings) and payload_digest. Returned: record_id,
    canonical_url, record_type, ``status``, ``target_id`` (the response), headers
    (sorted array of key and value) and payload_digest.

    A response has status ``full`` and is its own target. A revisit is ``resolved``
    if the latest strictly earlier response of its canonical URL (of equal times
    the largest id) has the same ETag, compared weakly, or, where one of the two
    has no ETag, the same Last-Modified; ``mismatch`` if that differs, ``no
    validator`` if there is nothing to compare, ``no response`` if there is none
    earlier, or the URL or the time is null. Unresolved revisits keep their own
    headers and have neither target nor digest. Records of other types, or of
    none, have status ``other``. Repeated rows are resolved alike. Other columns
    are ignored.
    """
    kind = F.lower("record_type")
    captured = F.unix_micros(F.col("captured").cast("timestamp"))
    rows = records.select(
        "record_id",
        canonical_url(F.col("url")).alias("canonical_url"),
        captured.alias("at"),
        kind.alias("record_type"),
        _lower(F.col("headers")).alias("headers"),
        "payload_digest",
    )
    rows = rows.withColumn("bucket", F.floor(F.col("at") / (bucket_seconds * 1_000_000)))
    full = F.when(
        F.col("record_type") == "response", F.struct("at", F.col("record_id").alias("id"), "headers", "payload_digest")
    )
    placed = F.col("canonical_url").isNotNull() & F.col("at").isNotNull()
    dated = rows.where(placed).withColumn("full", full)

    latest = dated.groupBy("canonical_url", "bucket").agg(F.max("full").alias("latest"))
    earlier = Window.partitionBy("canonical_url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.withColumn("carried", F.max("latest").over(earlier)).drop("latest")
    before = Window.partitionBy("canonical_url", "bucket").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    found = dated.withColumn("inside", F.max("full").over(before)).join(carried, ["canonical_url", "bucket"])
    found = found.withColumn("target", F.coalesce("inside", "carried"))

    nothing = F.lit(None).cast(found.schema["target"].dataType)
    both = found.drop("full", "inside", "carried").unionByName(rows.where(~placed).withColumn("target", nothing))
    ours, theirs = F.col("headers"), F.col("target.headers")
    status = (
        F.when(F.col("record_type") == "response", "full")
        .when(F.coalesce(F.col("record_type") != "revisit", F.lit(True)), "other")
        .when(F.col("target").isNull(), "no response")
        .otherwise(_status(ours, theirs))
    )
    judged = both.withColumn("status", status)
    resolved, own = F.col("status") == "resolved", F.col("status") == "full"
    return judged.select(
        "record_id",
        "canonical_url",
        "record_type",
        "status",
        F.when(own, F.col("record_id")).when(resolved, F.col("target.id")).alias("target_id"),
        F.when(resolved, _merged(ours, theirs)).otherwise(ours).alias("headers"),
        F.when(own, F.col("payload_digest")).when(resolved, F.col("target.payload_digest")).alias("payload_digest"),
    )


def page_captures(pages: DataFrame) -> DataFrame:
    """Archive records made from the pages: a response of each and three later visits of its URL.

    The first visit brings the same ETag, marked weak; the second a Last-Modified
    only, and another one for every fifth page; the third a new ETag for every
    third page and no validator for the others. Their URLs are spelled differently.
    """
    visit = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("visit")
    each = pages.select("page_id", "url", F.md5("html").alias("digest"), visit)
    page, number = F.col("page_id"), F.col("visit")
    at = F.timestamp_micros((page % 100_000 + number * 200_000) * 1_000_000)
    modified = F.concat(F.lit("day "), (page % 7).cast("string"))
    tag = F.concat(F.lit('"'), "digest", F.lit('"'))
    etag = (
        F.when(number == 0, tag)
        .when(number == 1, F.concat(F.lit("W/"), tag))
        .when((number == 3) & (page % 3 == 0), F.lit('"changed"'))
    )
    last = F.when(number == 0, modified).when((number == 2) & (page % 5 == 0), F.lit("day 9")).when(number == 2, modified)
    fields = F.map_from_arrays(
        F.array(F.lit("ETag"), F.lit("Last-Modified"), F.lit("Date"), F.lit("Content-Type")),
        F.array(etag, last, F.concat(F.lit("visit "), number.cast("string")), F.when(number == 0, "text/html").otherwise("x/y")),
    )
    url = F.when(number == 1, F.concat("url", F.lit("#again"))).when(
        number == 2, F.regexp_replace("url", "^https?", "HTTP")
    ).otherwise(F.col("url"))
    return each.select(
        (page * 4 + number).alias("record_id"),
        url.alias("url"),
        at.alias("captured"),
        F.when(number == 0, "response").otherwise("revisit").alias("record_type"),
        fields.alias("headers"),
        F.when(number == 0, F.col("digest")).alias("payload_digest"),
    )

"""Not-modified revisits of web archives, resolved by an as-of join.

A revisit record says that a page had not changed; its body is that of the latest earlier full response of the same
canonical address. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowguard.llm.stand_ins import CAPTURES_SQL, captures

#: Seconds of a slice of time: an address's captures are joined slice by slice, so that no task holds all of one.
SLICE = 3600
#: Headers of a not-modified answer that never replace those of the stored response.
KEPT_HEADERS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
                "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade")
ADDRESS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)([?][^#]*)?(#.*)?$"
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|sessionid)="


def canonical(url: Column) -> Column:
    """Address without scheme, 'www.', default port, fragment, tracking parameters and closing slash; host in lower
    case, parameters sorted. Text that is no address stands for itself, null stays null."""
    part = lambda i: F.regexp_extract(url, ADDRESS, i)
    host = F.regexp_replace(F.regexp_replace(F.lower(part(2)), "^www[.]", ""), ":(80|443)$", "")
    query = F.array_join(F.array_sort(F.filter(F.split(F.substring(part(4), 2, 1 << 30), "&"), lambda p: (p != "") & ~F.lower(
        p).rlike(TRACKING))), "&")
    return F.when(url.rlike(ADDRESS), F.concat(host, F.regexp_replace(part(3), "/+$", ""), F.when(
        query != "", F.concat(F.lit("?"), query)).otherwise(""))).otherwise(url)


def header(headers: Column, name: str) -> Column:
    """A header by its name in any case; of repeated ones, the first by name and value."""
    found = F.array_sort(F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name))
    return F.get(found, 0)["value"]


def tag(headers: Column) -> Column:
    return F.regexp_replace(F.trim(header(headers, "etag")), "^W/", "")


def merged(stored: Column, fresh: Column) -> Column:
    """The stored response's headers with those of the revisit in place of or beside them, but for KEPT_HEADERS; names
    in lower case."""
    entries = lambda m: F.transform(F.map_entries(m), lambda e: F.struct(
        F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    permitted = F.filter(entries(fresh), lambda e: ~e["key"].isin(*KEPT_HEADERS))
    names = F.transform(permitted, lambda e: e["key"])
    rest = F.filter(stored, lambda e: ~F.array_contains(names, e["key"]))
    return F.array_sort(F.concat(rest, permitted))


def resolve(records: DataFrame) -> DataFrame:
    """A row for each revisit: record_id, canonical, captured, verdict, refers_to, payload_digest, headers.

    ``records``: record_id, record_type, target_uri, captured (seconds), status, headers (map), payload_digest; other
    columns are not used. verdict is 'resolved', 'no_capture' (no earlier full response), or 'changed' (the entity tags,
    compared weakly, differ; or, where either lacks one, the last-modified dates that both give). Only a resolved one
    has refers_to, the digest and headers, an array of (key, value) by name. A response is full if its type is
    'response', its status 200 and it has a digest; it must be earlier by the clock, and of several of one second the
    greatest record_id counts. Revisits without address or time have no capture; null headers are none. Repeated rows
    each get their row; empty tables give none.

    The as-of join works on slices of an hour of an address: each slice's last response is found first, then carried to
    the next slice, so a much-captured address is spread over many tasks.
    """
    rows = records.select(
        "record_id", "record_type", F.col("captured").cast("long").alias("captured"), "payload_digest",
        canonical(F.col("target_uri")).alias("canonical"), F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("h"),
        ((F.col("record_type") == "response") & (F.col("status") == 200) & F.col("payload_digest").isNotNull()
         & F.col("captured").isNotNull() & F.col("target_uri").isNotNull()).alias("full")
    ).where("full OR record_type = 'revisit'")
    # rows without address or time meet nothing; they are spread over slices of their own
    timed = F.col("canonical").isNotNull() & F.col("captured").isNotNull()
    rows = rows.withColumn("slice", F.when(timed, F.floor(F.col("captured") / SLICE)).otherwise(
        -1 - F.pmod(F.xxhash64("record_id"), F.lit(4096))))
    stored = F.when(F.col("full"), F.struct(
        "captured", "record_id", "payload_digest", tag(F.col("h")).alias("tag"), header(F.col("h"), "last-modified").alias("modified"),
        F.array_sort(F.transform(F.map_entries("h"), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias(
            "value")))).alias("headers")))
    rows = rows.withColumn("stored", stored)
    slices = Window.partitionBy("canonical").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.where(timed).groupBy("canonical", "slice")
              .agg(F.max("stored").alias("last")).withColumn("carried", F.max("last").over(slices)).drop("last"))
    within = Window.partitionBy("canonical", "slice").orderBy("captured").rangeBetween(Window.unboundedPreceding, -1)
    known = (rows.join(before, ["canonical", "slice"], "left")
             .withColumn("s", F.coalesce(F.max("stored").over(within), "carried")).where("record_type = 'revisit'")
             .withColumn("s", F.when(timed, F.col("s"))))
    mine, date = tag(F.col("h")), header(F.col("h"), "last-modified")
    same = F.coalesce(mine == F.col("s.tag"), date == F.col("s.modified"), F.lit(True))
    verdict = F.when(F.col("s").isNull(), "no_capture").when(same, "resolved").otherwise("changed")
    held = lambda c: F.when(F.col("verdict") == "resolved", c)
    return known.withColumn("verdict", verdict).select(
        "record_id", "canonical", "captured", "verdict", held(F.col("s.record_id")).alias("refers_to"),
        held(F.col("s.payload_digest")).alias("payload_digest"),
        held(merged(F.col("s.headers"), F.col("h"))).alias("headers"))


def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve(captures(spark, sf_dir)).select(
        "record_id", "canonical", "captured", "verdict", F.col("refers_to").cast("string").alias("refers_to"), "payload_digest",
        F.array_join(F.transform("headers", lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("headers"))


OP7_SQL = "WITH" + CAPTURES_SQL + r""",
p AS (SELECT *, regexp_extract(target_uri, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)([?][^#]*)?(#.*)?$',
      ['scheme', 'host', 'path', 'query', 'part']) AS u FROM captures),
c AS (SELECT *, regexp_replace(regexp_replace(lower(u.host), '^www[.]', ''), ':(80|443)$', '')
      || regexp_replace(u.path, '/+$', '') || (CASE WHEN q = '' THEN '' ELSE '?' || q END) AS canonical
      FROM (SELECT *, coalesce(array_to_string(list_sort(list_filter(string_split(substr(u.query, 2), '&'),
            lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|gclid|fbclid|sessionid)='))), '&'), '') AS q
            FROM p)),
f AS (SELECT canonical, captured, max(record_id) AS record_id FROM c WHERE is_full GROUP BY canonical, captured),
a AS (SELECT r.*, f.record_id AS stored FROM (SELECT * FROM c WHERE NOT is_full) r
      ASOF LEFT JOIN f ON r.canonical = f.canonical AND r.captured > f.captured),
v AS (SELECT a.record_id, a.canonical, a.captured, s.record_id AS ref, md5(s.html) AS digest, a.k,
      coalesce(a.etag, s.etag) AS out_tag, coalesce(a.modified, s.modified) AS out_modified, length(s.html) AS n,
      CASE WHEN s.record_id IS NULL THEN 'no_capture'
           WHEN coalesce(regexp_replace(a.etag, '^W/', '') = regexp_replace(s.etag, '^W/', ''),
                         a.modified = s.modified, TRUE) THEN 'resolved' ELSE 'changed' END AS verdict
      FROM a LEFT JOIN c s ON s.record_id = a.stored)
SELECT record_id, canonical, captured, verdict,
       CASE WHEN verdict = 'resolved' THEN ref::VARCHAR END AS refers_to,
       CASE WHEN verdict = 'resolved' THEN digest END AS payload_digest,
       CASE WHEN verdict = 'resolved' THEN 'cache-control=max-age=' || (k * 60) || ';content-length=' || n
            || ';content-type=text/html;date=' || captured || coalesce(';etag=' || out_tag, '')
            || coalesce(';last-modified=' || out_modified, '') END AS headers
FROM v
"""

"""Not-modified revisits of a web archive: as-of join to the latest earlier full response.

A revisit record says that a page had not changed. Its payload is that of the latest full response
fetched earlier for the same canonical URL, if the validators agree. Strong validators go first, weak ones
stand in where there are none, as RFC 9111 (4.3.4) has it: a strong entity tag must be the response's tag
byte by byte; a weak one is compared weakly (RFC 9110, 8.8.3.2), so W/"1", W/"1" and "1" are alike to it;
without a tag the modification times must be equal. The response's stored headers are then updated by
those headers that a not-modified answer may carry.

Skew: time is cut into blocks of near equal row counts, so a (URL, block) group holds at most a
block's share of all rows even if one URL owns everything; between blocks only one row per
(URL, block) with its last full response is carried on.

Defined results: a null URL is a URL of its own (empty string); a revisit without validators is
``no_validator``; equal times order by record id, and a response at the revisit's own time counts
as earlier only if its id is smaller; a revisit without a time has no response; repeated records each give a row; an empty table gives no
rows; records' other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from atelier.functions.ranking import block_of, blocks_of, quantile_cuts

LEAST_BLOCKS = 128
REVISIT_LAG = 1000  # in the query: a page is asked for again after so many fetches

# Parameters that only track visitors; headers that a 304 answer may update.
TRACKING = ["fbclid", "gclid", "ref", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term"]
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical_url(url: Column) -> Column:
    """Scheme dropped, host in lower case without www. and default port, no fragment, sorted query without tracking."""
    u = F.trim(F.coalesce(url, F.lit("")))
    bare = F.regexp_replace(F.regexp_replace(u, "#.*$", ""), "^(?i)https?://", "")
    host = F.lower(F.regexp_extract(bare, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, "\\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.regexp_extract(p, "^[^=]*", 0).isin(TRACKING))
    query = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def resolve_revisits(records: DataFrame, blocks: int | None = None) -> DataFrame:
    """records: record_id long, url string, at long, kind 'response' | 'revisit', complete boolean,
    etag string, last_modified string, headers map<string,string> (names in lower case).

    Without ``blocks``, time is cut into as many as the rows need. One row per revisit: record_id, canonical_url, at, response_id, status, headers.
    status: resolved, changed (validators disagree), no_validator, no_response.
    """
    rows = records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), "at", "kind", "etag", "last_modified", "headers", (F.col("kind") == "response") & F.coalesce(F.col("complete"), F.lit(False)) & F.col("at").isNotNull()
    ).toDF("record_id", "canonical_url", "at", "kind", "etag", "last_modified", "headers", "__full")
    total = records.count()
    cuts = quantile_cuts(records, "at", blocks or max(LEAST_BLOCKS, blocks_of(total)), total)
    rows = rows.withColumn("__block", F.coalesce(block_of(F.col("at"), cuts), F.lit(0)))
    held = F.when(F.col("__full"), F.struct("record_id", "etag", "last_modified", "headers"))
    within = Window.partitionBy("canonical_url", "__block").orderBy("at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    here = rows.withColumn("__near", F.last(held, ignorenulls=True).over(within))
    lasts = (
        rows.filter("__full")
        .groupBy("canonical_url", "__block")
        .agg(F.max_by(F.struct("record_id", "etag", "last_modified", "headers"), F.struct("at", "record_id")).alias("__last"))
    )
    # a block's carry goes to the URL's next block that has revisits; blocks are few, rows are one per (URL, block)
    asked = rows.filter("kind = 'revisit'").groupBy("canonical_url", "__block").agg(F.lit(True).alias("__asked"))
    both = lasts.join(asked, ["canonical_url", "__block"], "full")
    earlier = Window.partitionBy("canonical_url").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.withColumn("__carried", F.last("__last", ignorenulls=True).over(earlier)).filter("__asked").select("canonical_url", "__block", "__carried")
    revisits = here.filter("kind = 'revisit'").join(carried, ["canonical_url", "__block"], "left")
    found = F.coalesce(F.col("__near"), F.col("__carried"))
    revisits = revisits.withColumn("__found", found)
    opaque = lambda tag: F.regexp_replace(tag, "^W/", "")
    weakly = F.col("etag").startswith("W/") & (opaque(F.col("etag")) == opaque(F.col("__found.etag")))
    by_tag = F.coalesce(weakly | (F.col("etag") == F.col("__found.etag")), F.lit(False))
    by_time = F.coalesce(F.col("last_modified") == F.col("__found.last_modified"), F.lit(False))
    status = (
        F.when(F.col("__found").isNull(), "no_response")
        .when(F.col("etag").isNull() & F.col("last_modified").isNull(), "no_validator")
        .when(F.when(F.col("etag").isNotNull(), by_tag).otherwise(by_time), "resolved")
        .otherwise("changed")
    )
    own = F.map_filter(F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>")), lambda k, _: k.isin(PERMITTED))
    stored = F.map_filter(F.coalesce(F.col("__found.headers"), F.create_map().cast("map<string,string>")), lambda k, _: ~F.map_contains_key(own, k))
    return revisits.select(
        "record_id", "canonical_url", "at", F.col("__found.record_id").alias("response_id"), status.alias("status"), F.when(status == "resolved", F.map_concat(stored, own)).alias("headers")
    )


def page_records(pages: DataFrame, lag: int = REVISIT_LAG) -> DataFrame:
    """Archive records that the ``pages`` table implies.

    Page p was fetched at time 2p (a full response if its html was not cut off) and asked for again
    at 2 (p + lag) + 1 with that fetch's validators: an entity tag (weak on m. hosts), or only a
    modification time where the page came by plain http.
    """
    tag = F.concat(F.when(F.col("url").contains("://m."), F.lit("W/")).otherwise(""), F.lit('"'), F.substring(F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary")), 1, 16), F.lit('"'))
    base = pages.select(
        "page_id",
        "url",
        F.coalesce(F.col("html").contains("</html>"), F.lit(False)).alias("complete"),
        F.when(~F.col("url").startswith("http://"), tag).alias("etag"),
        F.format_string("day %d", F.floor(F.col("page_id") / 100)).alias("last_modified"),
        F.length(F.coalesce(F.col("html"), F.lit(""))).cast("string").alias("__length"),
    )
    pair = F.explode(F.array(F.lit("response"), F.lit("revisit")))
    both = base.select("*", pair.alias("kind"))
    response = F.col("kind") == "response"
    at = F.when(response, 2 * F.col("page_id")).otherwise(2 * (F.col("page_id") + lag) + 1)
    headers = F.when(
        response, F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.col("__length"), F.lit("date"), F.concat(F.lit("t"), at.cast("string")), F.lit("cache-control"), F.lit("max-age=60"))
    ).otherwise(F.create_map(F.lit("content-length"), F.lit("0"), F.lit("date"), F.concat(F.lit("t"), at.cast("string")), F.lit("expires"), F.concat(F.lit("t"), (at + 60).cast("string"))))
    return both.select(F.when(response, 2 * F.col("page_id")).otherwise(2 * F.col("page_id") + 1).alias("record_id"), "url", at.alias("at"), "kind", "complete", "etag", "last_modified", headers.alias("headers"))


def revisits_of_pages(pages: DataFrame) -> DataFrame:
    """op1: every page's revisit, resolved; headers as sorted ``name: value`` lines."""
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
    return resolve_revisits(page_records(pages)).select(
        F.floor(F.col("record_id") / 2).cast("long").alias("page_id"), "canonical_url", F.floor(F.col("response_id") / 2).cast("long").alias("response_page_id"), "status", F.coalesce(lines, F.lit("")).alias("headers")
    )


def revisits_of_pages_sql(lag: int = REVISIT_LAG) -> str:
    tracking = ", ".join(f"'{x}'" for x in TRACKING)
    return f"""
WITH bare AS (
  SELECT page_id, url, html, regexp_replace(regexp_replace(trim(coalesce(url, ''), ' '), '#.*$', ''), '^https?://', '', 'i') AS b FROM pages
), parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(b, '^[^/?]*', 0)), '^www\\.', ''), ':(80|443)$', '')
            || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(b, '\\?(.*)$', 1), '&'),
            lambda p: p <> '' AND NOT list_contains([{tracking}], regexp_extract(p, '^[^=]*', 0)))), '&') AS query
  FROM bare
), base AS (
  SELECT page_id, place || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical_url,
         coalesce(contains(html, '</html>'), false) AS complete,
         CASE WHEN NOT starts_with(url, 'http://') THEN CASE WHEN contains(url, '://m.') THEN 'W/' ELSE '' END || '"' || left(md5(coalesce(html, '')), 16) || '"' END AS etag,
         'day ' || (page_id // 100) AS last_modified, length(coalesce(html, '')) AS n
  FROM parts
), asked AS (SELECT *, 2 * (page_id + {lag}) + 1 AS tick FROM base),
full_ AS (SELECT *, 2 * page_id AS tick FROM base WHERE complete),
joined AS (
  SELECT a.page_id, a.canonical_url, a.tick, a.etag, a.last_modified, f.page_id AS response_page_id, f.etag AS f_etag, f.last_modified AS f_modified, f.n AS f_n, f.tick AS f_tick
  FROM asked a ASOF LEFT JOIN full_ f ON a.canonical_url = f.canonical_url AND a.tick > f.tick
), judged AS (
  SELECT *, CASE WHEN response_page_id IS NULL THEN 'no_response'
    WHEN etag IS NULL AND last_modified IS NULL THEN 'no_validator'
    WHEN CASE WHEN etag IS NOT NULL THEN coalesce(CASE WHEN starts_with(etag, 'W/') THEN regexp_replace(etag, '^W/', '') = regexp_replace(f_etag, '^W/', '') ELSE etag = f_etag END, false)
         ELSE coalesce(last_modified = f_modified, false) END THEN 'resolved' ELSE 'changed' END AS status
  FROM joined
)
SELECT page_id, canonical_url, response_page_id, status,
  CASE WHEN status = 'resolved' THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || f_n || chr(10) || 'content-type: text/html' || chr(10)
    || 'date: t' || tick || chr(10) || 'expires: t' || (tick + 60) ELSE '' END AS headers
FROM judged
"""

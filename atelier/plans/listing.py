"""Listing and novelty queries."""

import uuid

from pyspark.sql import functions as F

from atelier.functions.shared import shared_dir
from atelier.functions.text import uniform
from atelier.operators import listing as op
from atelier.operators import novelty
from atelier.plans.common import Family, strip_sql, table, uniform_sql
from atelier.sources import arrays, html_pages, manifest
from atelier.sources.bucketed import BucketedDictionary

family = Family()
ANCHORS = "regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', {})"


@family.add("page_links", f"SELECT page_id, unnest({ANCHORS.format(1)}) AS href, unnest({ANCHORS.format(2)}) AS text, unnest(range(len({ANCHORS.format(1)}))) AS pos FROM pages")
def page_links(spark, d):
    t = table(spark, d, "pages").select("page_id", F.posexplode(op.links(F.col("html"))).alias("pos", "l"))
    return t.select("page_id", F.col("l.href").alias("href"), F.col("l.text").alias("text"), F.col("pos").cast("long").alias("pos"))


@family.add("page_elements", f"SELECT page_id, unnest({ANCHORS.format(1)}) AS href, trim(unnest({ANCHORS.format(2)})) AS text, unnest(range(len({ANCHORS.format(1)}))) AS pos FROM pages")
def page_elements(spark, d):
    """The same links through the selector source."""
    return html_pages.select_elements(table(spark, d, "pages"), "page_id", "html", "nav li a")


@family.add(
    "item_desc_zip",
    f"""SELECT page_id, i AS pos, coalesce(h[i], '') AS item, CASE WHEN p[i] IS NOT NULL AND len(string_split(p[i], ' ')) > 3 THEN string_split(p[i], ' ')[4] ELSE '' END AS type
    FROM (SELECT page_id, {ANCHORS.format(2)} AS h, list_filter(regexp_extract_all(html, '<p>([^<]*)</p>', 1), lambda x: x <> '') AS p FROM pages), unnest(range(1, len(h) + 1)) t(i)""",
)
def item_desc_zip(spark, d):
    """The page's links with the first paragraphs as descriptions, split at spaces into cells."""
    t = table(spark, d, "pages").select("page_id", F.transform(op.links(F.col("html")), lambda x: x["text"]).alias("h"), F.filter(F.regexp_extract_all("html", F.lit("<p>([^<]*)</p>"), 1), lambda x: x != "").alias("p"))
    cells = F.transform(F.slice("p", F.lit(1), F.greatest(F.size("h"), F.lit(1))), lambda x: F.split(x, " "))
    zipped = t.select("page_id", F.posexplode(F.slice(op.zip_with_cells(F.col("h"), cells), F.lit(1), F.greatest(F.size("h"), F.lit(1)))).alias("pos", "z"), F.size("h").alias("n"))
    return zipped.filter("pos < n").select("page_id", (F.col("pos") + 1).cast("long").alias("pos"), F.col("z.item").alias("item"), F.col("z.type").alias("type"))


NUMBERS = "list_transform(regexp_extract_all(url, '\\d+'), lambda x: try_cast(x AS INT))"


@family.add("page_count", f"SELECT page_id, greatest(0, coalesce(list_max({NUMBERS}), 0))::INT AS pages FROM pages")
def page_count(spark, d):
    return table(spark, d, "pages").select("page_id", op.page_count(F.regexp_extract_all("url", F.lit(r"(\d+)"), 1)).alias("pages"))


BASES = "(SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || '/search.html' ELSE url END AS base, (page_id % 4)::INT AS n FROM pages)"


@family.add("page_urls", f"SELECT page_id, i AS page, CASE WHEN i = 1 THEN base WHEN contains(base, '/search.html') THEN base || '#' || i ELSE base || '?page=' || i END AS page_url FROM {BASES}, unnest(range(1, greatest(1, n) + 1)) t(i)")
def page_urls(spark, d):
    t = table(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit("/search.html"))).otherwise(F.col("url")).alias("base"), (F.col("page_id") % 4).cast("int").alias("n"))
    return t.select("page_id", F.posexplode(op.page_urls(F.col("base"), F.col("n"))).alias("i", "page_url")).select("page_id", (F.col("i") + 1).cast("long").alias("page"), "page_url")


@family.add("type_allowlist", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('PROMO', 'ECONOMY')")
def type_allowlist(spark, d):
    return op.allowed(table(spark, d, "part"), "p_type", ["PROMO", "ECONOMY"]).select("p_partkey", "p_type")


@family.add("extract_id", "SELECT page_id, regexp_extract(url, '/(\\d+)', 1) AS item_id FROM pages")
def extract_id(spark, d):
    return table(spark, d, "pages").select("page_id", op.item_id(F.col("url"), r"/(\d+)").alias("item_id"))


@family.add("rejected_links", "SELECT page_id, url FROM pages WHERE regexp_extract(url, '/(\\d+)$', 1) = ''")
def rejected_links(spark, d):
    return table(spark, d, "pages").filter(op.item_id(F.col("url"), r"/(\d+)$") == "").select("page_id", "url")


@family.add("new_items_snapshot", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def new_items_snapshot(spark, d):
    return op.new_items(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@family.add("known_items", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) OR doc_id IN (SELECT vec_id FROM embeddings)")
def known_items(spark, d):
    return op.known_items(table(spark, d, "documents").select("doc_id", "source"), [table(spark, d, "labels"), table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"))], "doc_id")


@family.add("new_items_filtered", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def new_items_filtered(spark, d):
    """Orders whose customer is in no catalog of one segment: Bloom filters, then the exact join of what may be known."""
    catalog = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    known = novelty.KnownKeys.build(catalog, "o_custkey", f"{shared_dir(spark)}/atelier/known-{uuid.uuid4().hex}")
    return novelty.new_items_filtered(table(spark, d, "orders").select("o_orderkey", "o_custkey"), catalog, "o_custkey", known)


@family.add("new_items_first_wins", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def new_items_first_wins(spark, d):
    return op.first_of(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@family.add(
    "artist_dictionary",
    """SELECT s_nationkey::BIGINT AS id, s_name AS names FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier) WHERE rn = 1 AND s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 10)
    UNION ALL SELECT n_nationkey::BIGINT, n_name FROM nation WHERE n_nationkey < 10""",
)
def artist_dictionary(spark, d):
    known = table(spark, d, "nation").filter("n_nationkey < 10").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("names"))
    seen = table(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("id"), F.col("s_suppkey").alias("at"), F.col("s_name").alias("names"))
    return op.upsert_first_wins(known, seen, "id", ["at"])


@family.add(
    "bucketed_upsert",
    "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY user_id % 3 <> 0 OR event_id % 2 = 0, ts, event_id) AS rn FROM events) WHERE rn = 1",
)
def bucketed_upsert(spark, d):
    """A dictionary of a third of the users, by their odd events; then all events are upserted: known users stay as they are."""
    events = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    known = op.first_of(events.filter("user_id % 3 = 0 and event_id % 2 = 1"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")
    held = BucketedDictionary.create(known, f"{shared_dir(spark)}/atelier/dictionary-{uuid.uuid4().hex}", "user_id", buckets=32)
    held.upsert_first_wins(events, ["ts", "event_id"])
    return held.read()


@family.add("dictionary_last_wins", "SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS priority FROM orders GROUP BY o_custkey")
def dictionary_last_wins(spark, d):
    return op.last_wins(table(spark, d, "orders").select("o_custkey", F.col("o_orderpriority").alias("priority"), "o_orderkey"), "o_custkey", "priority", "o_orderkey")


@family.add("artist_concat", "SELECT p_partkey, trim(array_to_string(list_filter(list_transform(string_split(' ' || replace(p_name, ' ', ' / ') || ', / ... / ', '/'), lambda x: trim(x, ' ')), lambda x: x <> '...'), ', '), ', ') AS names FROM part")
def artist_concat(spark, d):
    parts = F.split(F.concat(F.lit(" "), F.replace(F.col("p_name"), F.lit(" "), F.lit(" / ")), F.lit(", / ... / ")), "/")
    return table(spark, d, "part").select("p_partkey", op.joined_names(parts).alias("names"))


@family.add("explode_images", "SELECT p_partkey, i::INT AS img_index FROM part, unnest(range(1, (p_size % 5) + 1)) t(i)")
def explode_images(spark, d):
    return op.image_rows(table(spark, d, "part").select("p_partkey", (F.col("p_size") % 5).alias("n")), "n").select("p_partkey", "img_index")


@family.add("explode_success_gaps", "SELECT p_partkey, i::INT AS img_index FROM part, unnest(range(1, (p_size % 5) + 1)) t(i) WHERE (p_partkey + i) % 3 <> 0")
def explode_success_gaps(spark, d):
    rows = op.image_rows(table(spark, d, "part").select("p_partkey", (F.col("p_size") % 5).alias("n")), "n")
    return rows.filter((F.col("p_partkey") + F.col("img_index")) % 3 != 0).select("p_partkey", "img_index")


@family.add("image_names", "SELECT page_id, 'image_' || page_id || '.' || regexp_extract(url, '[^.]*$', 0) AS name FROM pages")
def image_names(spark, d):
    return table(spark, d, "pages").select("page_id", op.image_name(F.col("url"), F.col("page_id")).alias("name"))


@family.add("valid_pages", f"SELECT page_id FROM pages WHERE len({ANCHORS.format(2)}) > 0 AND {ANCHORS.format(2)}[1] <> ''")
def valid_pages(spark, d):
    return table(spark, d, "pages").filter(op.valid_page(op.links(F.col("html")))).select("page_id")


@family.add("log_levels", "SELECT CASE WHEN event_type = 'error' THEN 'ERR' ELSE 'INFO' END AS level, count(*) AS n FROM events GROUP BY 1")
def log_levels(spark, d):
    line = F.concat(F.when(F.col("event_type") == "error", "[ERR] ").otherwise("[INFO] "), F.col("event_id").cast("string"))
    return table(spark, d, "events").select(op.level_of(line).alias("level")).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@family.add("path_mapping", "SELECT page_id, '/out/latent_' || regexp_replace(substr(p, 7), '\\.[^./]*$', '') || '.npy' AS target FROM (SELECT page_id, '/data/' || regexp_replace(url, '^[a-z]+://', '') AS p FROM pages)")
def path_mapping(spark, d):
    path = F.concat(F.lit("/data/"), F.regexp_replace("url", "^[a-z]+://", ""))
    return table(spark, d, "pages").select("page_id", manifest.mapped(path, "/data", "/out", ".npy", "latent_").alias("target"))


@family.add("pending_targets", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def pending_targets(spark, d):
    return manifest.pending(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").filter("quality = 1"), "doc_id")


@family.add("manifest_filter", "SELECT page_id, url || '.' || e AS path FROM (SELECT page_id, url, ['PNG', 'jpg', 'gif', 'webp', 'txt'][(page_id % 5)::INT + 1] AS e FROM pages) WHERE lower(e) IN ('png', 'jpg', 'webp')")
def manifest_filter(spark, d):
    e = F.element_at(F.array(*[F.lit(x) for x in ("PNG", "jpg", "gif", "webp", "txt")]), (F.col("page_id") % 5 + 1).cast("int"))
    t = table(spark, d, "pages").select("page_id", F.concat("url", F.lit("."), e).alias("path"))
    return t.filter(F.lower(manifest.extension(F.col("path"))).isin(list(manifest.IMAGE_EXTENSIONS)))


LISTED = f"(SELECT CASE page_id % 5 WHEN 0 THEN ' \u3000' || url || '.webp ' WHEN 1 THEN url || '.webp' WHEN 2 THEN ' ' WHEN 3 THEN url || '.WEBP' ELSE url || '.webp.png' END AS line FROM pages WHERE {uniform_sql('page_id', 7)} < 0.8)"


@family.add("manifest_from_list", f"SELECT path FROM (SELECT {strip_sql('line')} AS path FROM {LISTED}) WHERE path LIKE '%.webp' AND path IN (SELECT url || '.webp' FROM pages WHERE page_id % 2 = 0)")
def manifest_from_list(spark, d):
    """Listed lines with white space around, blank ones, and other endings."""
    pages, k = table(spark, d, "pages"), F.col("page_id") % 5
    path = F.concat("url", F.lit(".webp"))
    line = F.when(k == 0, F.concat(F.lit(" \u3000"), path, F.lit(" "))).when(k == 1, path).when(k == 2, " ").when(k == 3, F.concat("url", F.lit(".WEBP"))).otherwise(F.concat(path, F.lit(".png")))
    return manifest.listed(pages.filter(uniform(F.col("page_id"), 7) < 0.8).select(line.alias("line")), "line", pages.filter("page_id % 2 = 0").select(path.alias("path")))


@family.add("error_capture", "SELECT event_id, CASE WHEN k % 7 <> 0 THEN k * 2 END AS doubled, CASE WHEN k % 7 <> 0 THEN 'ok' ELSE 'failed' END AS status FROM (SELECT event_id, try_cast(props->>'k' AS INT) AS k FROM events)")
def error_capture(spark, d):
    """A model that fails on some records: their status says so, and the others go on."""

    def model(shape, a):
        if not a[0] % 7 > 0:
            raise ValueError("not for this model")
        return a * 2

    k = F.get_json_object("props", "$.k").try_cast("float")
    done = arrays.apply_model(table(spark, d, "events").select(F.col("event_id").cast("string").alias("path"), F.array(F.lit(1)).alias("shape"), F.array(F.coalesce(k, F.lit(0.0).cast("float"))).alias("data")), model)
    return done.select(F.col("path").cast("long").alias("event_id"), F.element_at("data", 1).cast("int").alias("doubled"), F.when(F.col("status") == "ok", "ok").otherwise("failed").alias("status"))

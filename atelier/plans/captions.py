"""Tag and caption queries. Captions are document texts with commas for spaces; the author is the source."""

from pyspark.sql import functions as F

from atelier.functions import tokens
from atelier.functions.text import uniform
from atelier.operators import captions as op
from atelier.operators import tags
from atelier.operators.assemble import assemble_captions
from atelier.plans.common import Family, strip_sql, table, uniform_sql

family = Family()
PHRASES = ["idiot", "Licensed under", "clown", "%%%"]
THRESHOLD = 0.25
SCORES = "(SELECT vec_id, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS score FROM embeddings)"
LINE = "('tag' || pos || ' ' || printf('%.3f', score))"


def vocabulary(spark):
    return spark.range(64).select(F.col("id").cast("int").alias("pos"), F.concat(F.lit("tag"), F.col("id").cast("string")).alias("tag"))


@family.add("tag_select", f"SELECT vec_id, pos::INT AS pos, 'tag' || pos AS tag, score FROM {SCORES} WHERE score >= {THRESHOLD}")
def tag_select(spark, d):
    return tags.select_tags(table(spark, d, "embeddings"), "vec_id", "embedding", vocabulary(spark), THRESHOLD)


@family.add("tag_lines", f"SELECT vec_id, pos::INT AS pos, {LINE} AS line FROM {SCORES} WHERE score >= {THRESHOLD}")
def tag_lines(spark, d):
    return tag_select(spark, d).select("vec_id", "pos", tags.tag_line(F.col("tag"), F.col("score")).alias("line"))


@family.add("tag_files", f"SELECT vec_id, coalesce(string_agg({LINE}, chr(10) ORDER BY pos) FILTER (WHERE score >= {THRESHOLD}), '') AS content FROM {SCORES} GROUP BY vec_id")
def tag_files(spark, d):
    return tags.tag_files(table(spark, d, "embeddings"), "vec_id", "embedding", "tag", THRESHOLD)


KEEPS = "NOT (contains(text, 'idiot') OR contains(text, 'Licensed under') OR contains(text, 'clown') OR contains(text, '%%%'))"


@family.add("caption_exclude", f"SELECT doc_id, lang FROM documents WHERE {KEEPS}")
def caption_exclude(spark, d):
    return table(spark, d, "documents").filter(op.keeps(F.col("text"), PHRASES)).select("doc_id", "lang")


@family.add("caption_exclude_counts", f"SELECT count(*) AS n_before, count(*) FILTER (WHERE {KEEPS}) AS n_after FROM documents")
def caption_exclude_counts(spark, d):
    return table(spark, d, "documents").agg(F.count(F.lit(1)).alias("n_before"), F.count_if(op.keeps(F.col("text"), PHRASES)).alias("n_after"))


# a caption of a few tags, with full-width commas, blanks of two scripts and repeats; an author that is sometimes empty
CAPTION_SQL = "array_to_string(string_split(replace(p_name, ' ', '，'), '') , '') || ' ,\u3000' || p_type || ',, ' || CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE '' END"
AUTHOR_SQL = "CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 4 = 1 THEN p_type ELSE ' ' || p_brand || ' , x' END"


def captioned(spark, d):
    p = F.col("p_partkey")
    caption = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("，")), F.lit(" ,\u3000"), F.col("p_type"), F.lit(",, "), F.when(p % 3 == 0, F.col("p_name")).otherwise(""))
    author = F.when(p % 4 == 0, "").when(p % 4 == 1, F.col("p_type")).otherwise(F.concat(F.lit(" "), F.col("p_brand"), F.lit(" , x")))
    return table(spark, d, "part").select("p_partkey", caption.alias("caption"), author.alias("author"))




def split_sql(x):
    return f"list_filter(list_transform(string_split(replace(({x}), '，', ','), ','), lambda x: {strip_sql('x')}), lambda x: x <> '')"


BASE = f"""base AS (SELECT p_partkey, {split_sql(CAPTION_SQL)} AS t, array_to_string({split_sql(AUTHOR_SQL)}, ', ') AS a FROM part),
texts AS (SELECT p_partkey, a, array_to_string(t, ', ') AS f, array_to_string(list_reverse(t), ', ') AS r FROM base),
five AS (SELECT p_partkey, [f, r, a, CASE WHEN a <> '' AND f <> '' THEN a || ', ' || f WHEN a <> '' THEN a ELSE f END, CASE WHEN a <> '' AND r <> '' THEN a || ', ' || r WHEN a <> '' THEN a ELSE r END] AS v FROM texts),
masked AS (SELECT *, [v[1] <> '', v[2] <> '' AND NOT list_contains(v[1:1], v[2]), v[3] <> '' AND NOT list_contains(v[1:2], v[3]), v[4] <> '' AND NOT list_contains(v[1:3], v[4]), v[5] <> '' AND NOT list_contains(v[1:4], v[5])] AS m FROM five)"""


@family.add("split_tags", f"WITH {BASE} SELECT p_partkey, i::INT AS pos, t[i + 1] AS tag FROM base, unnest(range(len(t))) u(i)")
def split_tags(spark, d):
    return captioned(spark, d).select("p_partkey", F.posexplode(op.split_list(F.col("caption"))).alias("pos", "tag"))


@family.add("join_tags", f"WITH {BASE} SELECT p_partkey, f AS tags FROM texts")
def join_tags(spark, d):
    return captioned(spark, d).select("p_partkey", op.join_list(op.split_list(F.col("caption"))).alias("tags"))


def with_variants(spark, d):
    v = captioned(spark, d).withColumn("v", op.variants(F.col("caption"), F.col("author")))
    return v.withColumn("m", op.variant_mask(F.col("v")))


@family.add("caption_variants", f"WITH {BASE} SELECT p_partkey, i::INT AS variant, v[i + 1] AS text FROM five, unnest(range(5)) u(i)")
def caption_variants(spark, d):
    return with_variants(spark, d).select("p_partkey", F.posexplode("v").alias("variant", "text"))


@family.add("variant_mask", f"WITH {BASE} SELECT p_partkey, array_to_string(list_transform(m, lambda x: CASE WHEN x THEN '1' ELSE '0' END), '') AS mask FROM masked")
def variant_mask(spark, d):
    return with_variants(spark, d).select("p_partkey", F.array_join(F.transform("m", lambda x: F.when(x, "1").otherwise("0")), "").alias("mask"))


@family.add("preview_text", f"WITH {BASE} SELECT p_partkey, CASE WHEN m[4] THEN v[4] WHEN m[1] THEN v[1] WHEN m[3] THEN v[3] ELSE '' END AS preview FROM masked")
def preview_text(spark, d):
    return with_variants(spark, d).select("p_partkey", op.preview(F.col("v"), F.col("m")).alias("preview"))


@family.add(
    "variant_choice",
    f"""WITH {BASE}, w AS (SELECT *, list_transform(range(1, 6), lambda i: CASE WHEN m[i] THEN [0.30, 0.15, 0.10, 0.30, 0.15][i]::DOUBLE ELSE 0.0::DOUBLE END) AS w, {uniform_sql('p_partkey', 9)} AS u FROM masked),
    s AS (SELECT *, w[1] AS s1, w[1] + w[2] AS s2, w[1] + w[2] + w[3] AS s3, w[1] + w[2] + w[3] + w[4] AS s4, w[1] + w[2] + w[3] + w[4] + w[5] AS s5 FROM w),
    c AS (SELECT *, CASE WHEN s5 > 0 THEN least((s1 / s5 <= u)::INT + (s2 / s5 <= u)::INT + (s3 / s5 <= u)::INT + (s4 / s5 <= u)::INT + (s5 / s5 <= u)::INT, list_max(list_transform(range(0, 5), lambda i: CASE WHEN m[i + 1] THEN i ELSE -1 END))) ELSE -1 END AS chosen FROM s)
    SELECT p_partkey, chosen::INT AS chosen, CASE WHEN chosen >= 0 THEN v[chosen + 1] ELSE '' END AS text FROM c""",
)
def variant_choice(spark, d):
    t = with_variants(spark, d).withColumn("chosen", op.chosen_index(F.col("m"), uniform(F.col("p_partkey"), 9)))
    return t.select("p_partkey", "chosen", op.chosen_text(F.col("v"), F.col("chosen")).alias("text"))


@family.add("token_count_proxy", "SELECT doc_id, least(len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '')), 77)::INT AS n_tokens FROM documents")
def token_count_proxy(spark, d):
    return table(spark, d, "documents").select("doc_id", op.token_count_proxy(F.col("text")).alias("n_tokens"))


@family.add("caption_tokens", None)
def caption_tokens(spark, d):
    """Tokens of each whole text by the vocabulary that captions are encoded with, and how many an encoder keeps."""
    counted = op.token_counts(table(spark, d, "documents").select("doc_id", "text"), "text", "n_tokens", tokens.caption_tokens(), cap=2**31 - 1)
    return counted.select("doc_id", "n_tokens", F.least("n_tokens", F.lit(op.TOKEN_CAP).cast("long")).alias("n_kept"))


@family.add(
    "caption_assemble",
    f"""SELECT 'v/' || vec_id || '/image_1.webp' AS path, coalesce((SELECT string_agg('tag' || pos, ', ' ORDER BY pos) FROM {SCORES} s WHERE s.vec_id = e.vec_id AND score >= {THRESHOLD}), '') AS caption,
    coalesce(n_name, '') AS author FROM embeddings e LEFT JOIN nation ON n_nationkey = vec_id""",
)
def caption_assemble(spark, d):
    path = F.concat(F.lit("v/"), F.col("vec_id").cast("string"), F.lit("/image_1.webp"))
    paths = table(spark, d, "embeddings").select(path.alias("path"), F.col("vec_id").alias("item"))
    chosen = tag_select(spark, d).select(path.alias("path"), "pos", "tag")
    artists = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("item"), F.col("n_name").alias("names"))
    return assemble_captions(paths, chosen, artists)

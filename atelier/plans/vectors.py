"""Index, geometry and array queries."""

import uuid

from pyspark.sql import functions as F

from atelier.functions.shared import shared_dir
from atelier.functions.text import uniform
from atelier.operators import arrays as op
from atelier.operators import geometry
from atelier.operators.assemble import computed_once, looked_up
from atelier.plans.common import Family, table, uniform_sql
from atelier.sources import arrays as files
from atelier.sources import index, latents
from atelier.sources.row_offsets import RowOffsets

family = Family()


@family.add(
    "index_records",
    """SELECT doc_id, sha1('docs/' || doc_id || '.txt') || '.npz' AS npz, '{"npz":"' || sha1('docs/' || doc_id || '.txt') || '.npz","src":"docs/' || doc_id || '.txt","caption":"' || lang || ' ä","author":"' || source || '"}' AS line FROM documents""",
)
def index_records(spark, d):
    path = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    t = table(spark, d, "documents")
    return t.select("doc_id", F.concat(index.record_key(path), F.lit(".npz")).alias("npz"), index.index_line(path, F.concat("lang", F.lit(" ä")), F.col("source")).alias("line"))


LINES = """(SELECT event_id, CASE WHEN event_id % 11 = 0 THEN '{"k": 1' WHEN event_id % 11 = 1 THEN '{"other": 1}' WHEN event_id % 11 = 2 THEN '{"k": "a", "caption": null}'
 WHEN event_id % 11 = 3 THEN '{"k": "b", "caption": "c"}' ELSE props END AS line FROM events)"""


@family.add(
    "index_read",
    f"""SELECT event_id, line->>'k' AS k, CASE WHEN list_contains(json_keys(line), 'caption') THEN line->>'caption' ELSE '' END AS caption
    FROM (SELECT event_id, CASE WHEN json_valid(line) THEN line::JSON END AS line FROM {LINES}) WHERE line IS NOT NULL AND list_contains(json_keys(line), 'k')""",
)
def index_read(spark, d):
    e = F.col("event_id") % 11
    line = F.when(e == 0, '{"k": 1').when(e == 1, '{"other": 1}').when(e == 2, '{"k": "a", "caption": null}').when(e == 3, '{"k": "b", "caption": "c"}').otherwise(F.col("props"))
    lines = table(spark, d, "events").select("event_id", line.alias("value"))
    return index.parse_index(lines, "value", ("k", "caption"), "k")


@family.add("index_existing", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def index_existing(spark, d):
    return index.existing(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@family.add("latent_source", "SELECT vec_id, label::VARCHAR AS caption, len(embedding) AS n, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 5) AS total FROM embeddings")
def latent_source(spark, d):
    """All vectors through archives and their index, by the data source in both directions."""
    path = f"{shared_dir(spark)}/atelier/latents-{uuid.uuid4().hex}"
    src = F.concat(F.lit("vec/"), F.col("vec_id").cast("string"))
    latents.write_latents(table(spark, d, "embeddings").select(src.alias("src"), F.col("label").cast("string").alias("caption"), F.lit("").alias("author"), F.col("embedding").alias("latent")), path)
    t = latents.read_latents(spark, path, "src string, caption string, latent array<float>, latent_shape array<int>")
    total = F.aggregate("latent", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return t.select(F.substring_index("src", "/", -1).cast("long").alias("vec_id"), "caption", F.element_at("latent_shape", 1).cast("long").alias("n"), F.round(total, 5).alias("total"))


@family.add("row_by_seek", "SELECT row_idx, 'docs/' || doc_id || '.txt' AS src FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx, count(*) OVER () AS n FROM documents) WHERE row_idx IN (0, n // 2, n - 1)")
def row_by_seek(spark, d):
    """An index of all documents, and three of its records by position."""
    path = f"{shared_dir(spark)}/atelier/rows-{uuid.uuid4().hex}"
    src = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    index.write_index(table(spark, d, "documents").orderBy("doc_id").select(index.index_line(src, F.col("lang"), F.col("source")).alias("value")), path)
    rows = RowOffsets(spark, path)
    wanted = sorted({0, len(rows) // 2, len(rows) - 1})
    return spark.createDataFrame([(i, rows.row(i)["src"]) for i in wanted], "row_idx long, src string")


@family.add("path_key", "SELECT page_id, sha1(url) AS path_key FROM pages")
def path_key(spark, d):
    return table(spark, d, "pages").select("page_id", index.record_key(F.col("url")).alias("path_key"))


@family.add("npy_roundtrip", "SELECT vec_id, len(embedding) AS n, true AS same FROM embeddings")
def npy_roundtrip(spark, d):
    return files.roundtrip(table(spark, d, "embeddings"), "vec_id", "embedding")


W, H = "(l_quantity * 7 + l_linenumber)::INT", "(l_suppkey % 97 + 3)::INT"
NW, NH = f"trunc({W} * (512.0::DOUBLE / greatest({W}, {H})))::INT", f"trunc({H} * (512.0::DOUBLE / greatest({W}, {H})))::INT"


def sized(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 7 + F.col("l_linenumber")).cast("int").alias("w"), (F.col("l_suppkey") % 97 + 3).cast("int").alias("h"))


@family.add(
    "fit_pad",
    f"""SELECT l_orderkey, l_linenumber, nw AS new_w, nh AS new_h, ((512 - nw) // 2)::INT AS pad_left, ((512 - nh) // 2)::INT AS pad_top, (512 - nw - (512 - nw) // 2)::INT AS pad_right, (512 - nh - (512 - nh) // 2)::INT AS pad_bottom
    FROM (SELECT l_orderkey, l_linenumber, {NW} AS nw, {NH} AS nh FROM lineitem)""",
)
def fit_pad(spark, d):
    return sized(spark, d).select("l_orderkey", "l_linenumber", *[c.cast("int").alias(n) for n, c in geometry.fit_pad(F.col("w"), F.col("h"), 512).items()])


@family.add(
    "align8",
    "SELECT p_partkey, CASE WHEN w // 8 = 0 OR h // 8 = 0 THEN greatest(8, w) ELSE w // 8 * 8 END::INT AS w8, CASE WHEN w // 8 = 0 OR h // 8 = 0 THEN greatest(8, h) ELSE h // 8 * 8 END::INT AS h8 FROM (SELECT p_partkey, p_size AS w, (p_partkey % 60 + 1)::INT AS h FROM part)",
)
def align8(spark, d):
    t = table(spark, d, "part").select("p_partkey", F.col("p_size").alias("w"), (F.col("p_partkey") % 60 + 1).cast("int").alias("h"))
    w, h = geometry.align(F.col("w"), F.col("h"))
    return t.select("p_partkey", w.alias("w8"), h.alias("h8"))


@family.add("latent_shape", "SELECT p_partkey, '4x' || (p_size * 10 // 8) || 'x' || (p_partkey % 600 // 8) AS shape FROM part")
def latent_shape(spark, d):
    shape = geometry.latent_shape(F.col("p_partkey") % 600, F.col("p_size") * 10)
    return table(spark, d, "part").select("p_partkey", F.array_join(shape.cast("array<string>"), "x").alias("shape"))


def exploded(spark, d, column):
    return table(spark, d, "embeddings").select("vec_id", F.posexplode(column).alias("pos", "x"))


LONG = "SELECT vec_id, pos::INT AS pos, {} AS x FROM (SELECT vec_id, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings)"


@family.add("normalize_pm1", LONG.format("v * 2 - 1"))
def normalize_pm1(spark, d):
    return exploded(spark, d, op.to_signed(F.col("embedding")))


@family.add("scale_latent", LONG.format("round(v * 0.18215::DOUBLE, 9)"))
def scale_latent(spark, d):
    return exploded(spark, d, F.transform(op.scale(F.col("embedding")), lambda x: F.round(x, 9)))


@family.add("unscale_latent", LONG.format("round(v / 0.13025::DOUBLE, 8)"))
def unscale_latent(spark, d):
    return exploded(spark, d, F.transform(op.unscale(F.col("embedding"), op.LATENT_SCALE_LARGE), lambda x: F.round(x, 8)))


@family.add("quantize_trunc", LONG.format("trunc(greatest(0.0::DOUBLE, least(1.0::DOUBLE, v)) * 255)::INT"))
def quantize_trunc(spark, d):
    return exploded(spark, d, op.quantize_unit(F.col("embedding")))


@family.add("quantize_signed", LONG.format("trunc(greatest(0.0::DOUBLE, least(1.0::DOUBLE, v / 2 + 0.5::DOUBLE)) * 255)::INT"))
def quantize_signed(spark, d):
    return exploded(spark, d, op.quantize_signed(F.col("embedding")))


@family.add("quantize_round", LONG.format("round_even((greatest(-1.0::DOUBLE, least(1.0::DOUBLE, v)) * 0.5::DOUBLE + 0.5::DOUBLE) * 255, 0)::INT"))
def quantize_round(spark, d):
    return exploded(spark, d, op.quantize_rounded(F.col("embedding")))


@family.add("chw_to_hwc", "SELECT vec_id, i::INT AS pos, embedding[(i % 4) * 16 + i // 4 + 1]::DOUBLE AS x FROM embeddings, unnest(range(64)) t(i)")
def chw_to_hwc(spark, d):
    return exploded(spark, d, F.transform(op.channels_last(F.col("embedding"), 4, 4, 4), lambda x: x.cast("double")))


@family.add("cond_dropout", f"SELECT vec_id, i::INT AS pos, (CASE WHEN {uniform_sql('vec_id', 5)} < 0.1 THEN 0.0 ELSE embedding[i + 1] END)::DOUBLE AS x FROM embeddings, unnest(range(64)) t(i)")
def cond_dropout(spark, d):
    drawn = uniform(F.col("vec_id"), 5)
    empty = F.array_repeat(F.lit(0.0).cast("float"), 64)
    t = table(spark, d, "embeddings").select("vec_id", F.posexplode(op.dropped_out(F.col("embedding"), empty, drawn)).alias("pos", "x"))
    return t.select("vec_id", "pos", F.col("x").cast("double").alias("x"))


MSE = "list_sum(list_transform(range(1, 65), lambda i: (embedding[i]::DOUBLE - embedding[65 - i]::DOUBLE) ** 2)) / 64"


@family.add("row_mse", f"SELECT vec_id, round({MSE}, 9) AS mse FROM embeddings")
def row_mse(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.round(op.mean_square_error(F.col("embedding"), F.reverse("embedding")), 9).alias("mse"))


@family.add("weighted_batch_loss", f"SELECT label, round(avg({MSE}), 7) AS loss, round(avg({MSE} * (vec_id % 5)), 7) AS weighted FROM embeddings GROUP BY label")
def weighted_batch_loss(spark, d):
    mse = op.mean_square_error(F.col("embedding"), F.reverse("embedding"))
    return table(spark, d, "embeddings").select("label", mse.alias("m"), (F.col("vec_id") % 5).alias("w")).groupBy("label").agg(F.round(F.avg("m"), 7).alias("loss"), F.round(F.avg(F.col("m") * F.col("w")), 7).alias("weighted"))


SCHEDULE = """(SELECT t, beta, exp(sum(ln(1 - beta)) OVER (ORDER BY t)) AS alpha_bar FROM (SELECT t, (sqrt(0.00085::DOUBLE) + t * ((sqrt(0.012::DOUBLE) - sqrt(0.00085::DOUBLE)) / 999)) ** 2 AS beta FROM range(1000) r(t)))"""


def timed(spark, d):
    t = table(spark, d, "embeddings").withColumn("t", (F.col("vec_id") % 1000).cast("int"))
    return t.join(F.broadcast(op.noise_schedule(spark)), "t").withColumn("e", F.reverse("embedding"))


@family.add("noise_schedule", f"SELECT vec_id, s.t::INT AS t, round(beta, 9) AS beta, round(alpha_bar, 8) AS alpha_bar FROM embeddings JOIN {SCHEDULE} s ON s.t = vec_id % 1000")
def noise_schedule(spark, d):
    return timed(spark, d).select("vec_id", "t", F.round("beta", 9).alias("beta"), F.round("alpha_bar", 8).alias("alpha_bar"))


@family.add("min_snr", f"SELECT vec_id, round(least(s, 5.0::DOUBLE) / (s + 1), 7) AS weight FROM (SELECT vec_id, alpha_bar / greatest(1 - alpha_bar, 1e-8::DOUBLE) AS s FROM embeddings JOIN {SCHEDULE} s ON s.t = vec_id % 1000)")
def min_snr(spark, d):
    return timed(spark, d).select("vec_id", F.round(op.min_snr_weight(op.snr(F.col("alpha_bar")), 5.0), 7).alias("weight"))


NOISED = """SELECT vec_id, i::INT AS pos, round({}, 7) AS x FROM embeddings e JOIN {} s ON s.t = e.vec_id % 1000, unnest(range(1, 65)) u(i)"""


@family.add("add_noise", NOISED.format("sqrt(alpha_bar) * embedding[i]::DOUBLE + sqrt(1 - alpha_bar) * embedding[65 - i]::DOUBLE", SCHEDULE))
def add_noise(spark, d):
    t = timed(spark, d).select("vec_id", F.posexplode(op.add_noise(F.col("embedding"), F.col("e"), F.col("alpha_bar"))).alias("pos", "x"))
    return t.select("vec_id", (F.col("pos") + 1).alias("pos"), F.round("x", 7).alias("x"))


@family.add("velocity_target", NOISED.format("sqrt(alpha_bar) * embedding[65 - i]::DOUBLE - sqrt(1 - alpha_bar) * embedding[i]::DOUBLE", SCHEDULE))
def velocity_target(spark, d):
    t = timed(spark, d).select("vec_id", F.posexplode(op.velocity(F.col("embedding"), F.col("e"), F.col("alpha_bar"))).alias("pos", "x"))
    return t.select("vec_id", (F.col("pos") + 1).alias("pos"), F.round("x", 7).alias("x"))


@family.add("distinct_then_join", "SELECT p_partkey, sha1(p_name) AS computed FROM part")
def distinct_then_join(spark, d):
    return computed_once(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", lambda c: F.sha1(c.cast("binary"))).select("p_partkey", "computed")


@family.add("embed_lookup", "SELECT doc_id, i::INT AS pos, coalesce(embedding[i + 1], -1)::DOUBLE AS x FROM documents LEFT JOIN embeddings ON vec_id = doc_id, unnest(range(64)) t(i)")
def embed_lookup(spark, d):
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    found = looked_up(table(spark, d, "documents").select("doc_id"), "doc_id", vectors, "embedding", F.array_repeat(F.lit(-1.0).cast("float"), 64))
    return found.select("doc_id", F.posexplode("embedding").alias("pos", "x")).select("doc_id", "pos", F.col("x").cast("double").alias("x"))

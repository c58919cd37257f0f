"""Sampling, metric, retention and statistics queries."""

import uuid

from pyspark.sql import functions as F

from atelier.functions.permutation import PRIME, Permutation
from atelier.functions.ranking import rank_by_key
from atelier.functions.shared import shared_dir
from atelier.functions.text import fixed
from atelier.operators import metrics, sampling
from atelier.plans.common import Family, table, uniform_sql
from atelier.sources import published, run_files

family = Family()
ALPHA = 0.98


@family.add(
    "train_batches",
    f"SELECT doc_id, rn // 16 AS batch, (rn % 16)::INT AS place FROM (SELECT doc_id, row_number() OVER (ORDER BY {uniform_sql('doc_id', 1235)}, doc_id) - 1 AS rn, count(*) OVER () AS n FROM documents) WHERE rn // 16 < n // 16",
)
def train_batches(spark, d):
    return sampling.train_batches(table(spark, d, "documents"), "doc_id", 16, 1234, epoch=1)


def _keyed_sql(seed: int, size: int) -> str:
    """The same order in SQL: rounds folded over the keys, again for places beyond the last row."""
    keys = ", ".join(f"{{'l': 0::BIGINT, 'r': 0::BIGINT, 'm': {m}::BIGINT, 'c': {c}::BIGINT, 'd': {d}::BIGINT, 'odd': {k % 2}::BIGINT}}" for k, (m, c, d) in reversed(list(enumerate(Permutation(0, seed).keys))))
    y = "[CASE WHEN k.odd = 1 THEN s.l ELSE s.r END]"
    for step in (f"(y * k.m + k.c) % {PRIME}", f"(xor(y, y >> 13) * k.d) % {PRIME}", f"(xor(y, y >> 11) * k.m) % {PRIME}", "xor(y, y >> 15)"):
        y = f"list_transform({y}, lambda y: {step})"
    new = f"list_transform({y}, lambda y: {{'l': CASE WHEN k.odd = 1 THEN s.l ELSE ((s.l - y % a) % a + a) % a END, 'r': CASE WHEN k.odd = 1 THEN ((s.r - y % b) % b + b) % b ELSE s.r END, 'm': a, 'c': b, 'd': 0::BIGINT, 'odd': 0::BIGINT}})[1]"
    turn = f"list_transform([list_reduce(list_prepend({{'l': x // b, 'r': x % b, 'm': 0::BIGINT, 'c': 0::BIGINT, 'd': 0::BIGINT, 'odd': 0::BIGINT}}, [{keys}]), lambda s, k: {new})], lambda s: s.l * b + s.r)[1]"
    return f"""WITH RECURSIVE sized AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT n, (floor(sqrt(n - 1)) + 1)::BIGINT AS a FROM (SELECT count(*) AS n FROM documents))),
    walk AS (SELECT doc_id, x, true AS again FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS x FROM documents)
      UNION ALL SELECT doc_id, t, t >= n FROM (SELECT doc_id, n, {turn} AS t FROM walk, sized WHERE again))
    SELECT doc_id, x // {size} AS batch, (x % {size})::INT AS place FROM (SELECT doc_id, last(x ORDER BY again DESC) AS x FROM walk WHERE NOT again GROUP BY doc_id), sized WHERE x // {size} < n // {size}"""


@family.add("keyed_train_batches", _keyed_sql(1234 + 2, 16))
def keyed_train_batches(spark, d):
    """Batches of the third epoch without a sort of drawn numbers: each document's place is computed from its position."""
    t = rank_by_key(table(spark, d, "documents").select("doc_id"), "doc_id")
    return sampling.keyed_batches(t, "row_idx", t.count(), 16, 1234, epoch=2).select("doc_id", "batch", "place")


@family.add(
    "step_plan",
    "SELECT b AS batches, greatest(1, ceil(b / 4.0)::BIGINT) AS steps_per_epoch, greatest(1, ceil(b / 4.0)::BIGINT) * 10 AS total_steps, greatest(100, trunc(0.03 * greatest(1, ceil(b / 4.0)::BIGINT) * 10)::BIGINT) AS warmup_steps FROM (SELECT count(*) // 16 AS b FROM documents)",
)
def step_plan(spark, d):
    plan = sampling.step_plan(table(spark, d, "documents").count(), 16, 4, 10)
    return spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in plan.items()])


@family.add(
    "lr_schedule",
    "SELECT event_id, round(CASE WHEN s = 0 THEN 1e-4::DOUBLE WHEN s < 100 THEN 1e-4::DOUBLE * (s / 100.0::DOUBLE) ELSE 1e-4::DOUBLE * (0.1 + 0.45 * (1 + cos(pi() * (s - 100) / 1900.0::DOUBLE))) END, 12) AS lr FROM (SELECT event_id, event_id // 8 AS s FROM events)",
)
def lr_schedule(spark, d):
    """The rate at which each micro-step of the table is taken, eight to an optimiser step."""
    step = sampling.accumulation_group(F.col("event_id"), 8)
    return table(spark, d, "events").select("event_id", F.round(sampling.learning_rate(step, 1e-4, 2000, 100), 12).alias("lr"))


@family.add("accum_groups", "SELECT event_id // 8 AS opt_step, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1 HAVING count(*) = 8")
def accum_groups(spark, d):
    t = table(spark, d, "events").groupBy(sampling.accumulation_group(F.col("event_id"), 8).alias("opt_step"))
    return t.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).filter("n = 8")


@family.add(
    "loss_ema",
    f"""WITH RECURSIVE o AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
    f AS (SELECT event_type, event_id, rn, value::DOUBLE AS e FROM o WHERE rn = 1 UNION ALL SELECT o.event_type, o.event_id, o.rn, {ALPHA}::DOUBLE * f.e + (1 - {ALPHA}::DOUBLE) * o.value FROM f JOIN o ON o.event_type = f.event_type AND o.rn = f.rn + 1)
    SELECT event_id, event_type, round(e, 6) AS ema FROM f""",
)
def loss_ema(spark, d):
    t = metrics.ema(table(spark, d, "events").select("event_id", "ts", "event_type", "value"), "event_type", "ts", "event_id", "value", ALPHA)
    return t.select("event_id", "event_type", F.round("ema", 6).alias("ema"))


@family.add(
    "vector_ema",
    """WITH g AS (SELECT vec_id // 10 AS series, list(embedding ORDER BY vec_id) AS vs FROM embeddings GROUP BY 1)
    SELECT series, i::INT AS pos, round(list_reduce(list_transform(vs, lambda v: v[i + 1]::DOUBLE), lambda a, b: a * 0.9::DOUBLE + b * (1 - 0.9::DOUBLE)), 7) AS x FROM g, unnest(range(64)) t(i)""",
)
def vector_ema(spark, d):
    """Series of ten vectors each."""
    t = table(spark, d, "embeddings").groupBy(F.floor(F.col("vec_id") / 10).cast("long").alias("series")).agg(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("v"))
    shadow = metrics.vector_ema(F.transform("v", lambda s: s["embedding"]), 0.9)
    return t.select("series", F.posexplode(shadow).alias("pos", "x")).select("series", "pos", F.round("x", 7).alias("x"))


@family.add("tail_n", "SELECT event_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 500")
def tail_n(spark, d):
    return metrics.tail(table(spark, d, "events"), [F.col("ts"), F.col("event_id")], 500).select("event_id", "value")


@family.add("every_k_steps", "SELECT event_id, value FROM events WHERE event_id % 50 = 0")
def every_k_steps(spark, d):
    return metrics.every(table(spark, d, "events"), "event_id", 50).select("event_id", "value")


@family.add("loss_csv", "SELECT event_id, event_id || ',' || printf('%.6f', value::DOUBLE) || ',' || printf('%.6f', (value * 2)::DOUBLE) AS line FROM events")
def loss_csv(spark, d):
    line = F.concat_ws(",", F.col("event_id").cast("string"), fixed(F.col("value"), 6), fixed(F.col("value") * 2, 6))
    return table(spark, d, "events").select("event_id", line.alias("line"))


@family.add("axis_range", "SELECT event_type, min(value) AS low, max(value) AS high, count(*) FILTER (WHERE value BETWEEN 5 AND 50) AS n_inside FROM events GROUP BY event_type")
def axis_range(spark, d):
    """Bounds from a range file, written and read."""
    path = f"{shared_dir(spark)}/atelier/range-{uuid.uuid4().hex}"
    run_files.write_range(spark, path, 5, 50)
    low, high = run_files.read_range(spark, path)
    published.remove(spark, path)
    return table(spark, d, "events").groupBy("event_type").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count_if(metrics.in_range(F.col("value"), low, high)).alias("n_inside"))


CHECKPOINTS = "(SELECT 'step_' || o_orderkey AS name, CASE WHEN o_orderstatus = 'F' THEN 'raw' ELSE 'ema' END AS kind, epoch(o_orderdate) * 100000 + o_orderkey AS mtime FROM orders)"


def checkpoints(spark, d):
    t = table(spark, d, "orders")
    mtime = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) * 100000 + F.col("o_orderkey")
    return t.select(F.concat(F.lit("step_"), F.col("o_orderkey").cast("string")).alias("name"), F.when(F.col("o_orderstatus") == "F", "raw").otherwise("ema").alias("kind"), mtime.alias("mtime"))


@family.add("retention", f"SELECT name, kind FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY mtime DESC, name DESC) AS rn FROM {CHECKPOINTS}) WHERE rn > 10 AND (SELECT count(*) FROM {CHECKPOINTS} WHERE kind = 'ema') > 10")
def retention(spark, d):
    return metrics.pruned(checkpoints(spark, d)).select("name", "kind")


@family.add("latest_by_name", f"SELECT kind, max(name) AS latest FROM {CHECKPOINTS} GROUP BY kind")
def latest_by_name(spark, d):
    return checkpoints(spark, d).groupBy("kind").agg(F.max("name").alias("latest"))


@family.add(
    "latency_percentiles",
    "SELECT l_returnflag, q AS share, xs[trunc(q::DOUBLE * (len(xs) - 1))::INT + 1] AS value FROM (SELECT l_returnflag, list(l_extendedprice ORDER BY l_extendedprice) AS xs FROM lineitem GROUP BY 1), (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) v(q)",
)
def latency_percentiles(spark, d):
    return metrics.nearest_ranks(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", [0.5, 0.95, 0.99])


@family.add("sketched_percentiles", "SELECT l_returnflag, share, true AS within FROM (SELECT DISTINCT l_returnflag FROM lineitem), (SELECT unnest([0.01::DOUBLE, 0.5::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]) AS share)")
def sketched_percentiles(spark, d):
    """Quantiles from sketches of parts of the table, and whether their true ranks are as near as the bound says."""
    t = table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice", (F.col("l_orderkey") % 7).alias("part"))
    found = metrics.sketched_ranks(metrics.quantile_sketches(t, ["l_returnflag", "part"], "l_extendedprice"), "l_returnflag", [0.01, 0.5, 0.95, 0.99])
    # a few values a group: how many rows are below and up to each
    ranked = t.join(F.broadcast(found.select("l_returnflag", "share", "value")), "l_returnflag").groupBy("l_returnflag", "share").agg(F.avg((F.col("l_extendedprice") < F.col("value")).cast("double")).alias("below"), F.avg((F.col("l_extendedprice") <= F.col("value")).cast("double")).alias("upto"))
    near = (F.col("below") - metrics.rank_error() <= F.col("share")) & (F.col("upto") + metrics.rank_error() >= F.col("share"))
    return ranked.select("l_returnflag", "share", near.alias("within"))


@family.add("throughput", "SELECT event_type, round(1000.0::DOUBLE / (avg(value) + 1e-12::DOUBLE) * 4, 6) AS per_second FROM events GROUP BY event_type")
def throughput(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.round(metrics.throughput(F.avg("value"), 4), 6).alias("per_second"))


@family.add("bench_grid", "SELECT b::INT AS batch, event_type AS mode, n // b AS batches FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type), (SELECT unnest([4, 8, 16]) AS b)")
def bench_grid(spark, d):
    """A sweep: each mode of the table's runs with each batch size, and the whole batches that it has for it."""
    modes = table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return modes.select(F.explode(F.split(F.lit("4,8,16"), ",").cast("array<int>")).alias("batch"), F.col("event_type").alias("mode"), "n").select("batch", "mode", F.expr("n div batch").alias("batches"))


WARM = 50
TIMED = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn > {WARM})"


def timed_runs(spark, d):
    return metrics.after_warmup(table(spark, d, "events").select("event_type", "ts", "event_id", "value"), "event_type", ["ts", "event_id"], WARM)


@family.add("warmup_discard", f"SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM {TIMED} GROUP BY event_type")
def warmup_discard(spark, d):
    return timed_runs(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))


RANKED = f"(SELECT event_type, count(*) AS n, list(value ORDER BY value) AS xs, round(1000.0::DOUBLE / (avg(value) + 1e-12::DOUBLE) * 4, 3) AS sps FROM {TIMED} GROUP BY 1)"


@family.add(
    "bench_report",
    f"""SELECT '{{"meta":{{"warmup":{WARM},"runs":' || max(n) || ',"modes":' || count(*) || '}},"cases":[' || string_agg('{{"batch":4,"mode":"' || event_type || '","latency_ms":{{"p50":' || xs[trunc(0.5 * (n - 1))::INT + 1] || ',"p95":' || xs[trunc(0.95 * (n - 1))::INT + 1]
    || ',"p99":' || xs[trunc(0.99 * (n - 1))::INT + 1] || '}},"throughput_sps":' || sps || ',"max_mem_mb":null}}', ',' ORDER BY event_type) || ']}}' AS report FROM {RANKED}""",
)
def bench_report(spark, d):
    """The nested report of the timed runs; its meta is taken from them, and peak memory is null, as on a CPU."""
    runs = timed_runs(spark, d)
    ranks = metrics.nearest_ranks(runs, "event_type", "value", [0.5, 0.95, 0.99]).groupBy("event_type").pivot("share", [0.5, 0.95, 0.99]).agg(F.first("value"))
    rates = runs.groupBy("event_type").agg(F.round(metrics.throughput(F.avg("value"), 4), 3).alias("sps"), F.count(F.lit(1)).alias("n"))
    latency = F.struct(F.col("`0.5`").alias("p50"), F.col("`0.95`").alias("p95"), F.col("`0.99`").alias("p99"))
    case = F.struct(F.lit(4).alias("batch"), F.col("event_type").alias("mode"), latency.alias("latency_ms"), F.col("sps").alias("throughput_sps"), F.lit(None).cast("double").alias("max_mem_mb"))
    listed = ranks.join(rates, "event_type").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("modes"), F.transform(F.array_sort(F.collect_list(F.struct("event_type", case.alias("c")))), lambda s: s["c"]).alias("cases"))
    meta = F.struct(F.lit(WARM).alias("warmup"), F.col("n").alias("runs"), "modes")
    return listed.select(F.to_json(F.struct(meta.alias("meta"), "cases"), {"ignoreNullFields": "false"}).alias("report"))


@family.add("resume_choice", f"SELECT CASE WHEN (SELECT count(*) FROM {CHECKPOINTS} WHERE kind = 'ema') > 0 THEN (SELECT max(name) FROM {CHECKPOINTS} WHERE kind = 'ema') ELSE (SELECT max(name) FROM {CHECKPOINTS} WHERE kind = 'raw') END AS name")
def resume_choice(spark, d):
    return metrics.resume_choice(checkpoints(spark, d), ["ema", "raw"])

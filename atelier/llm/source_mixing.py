"""Mixing sources to target weights by Efraimidis-Spirakis sampling (2006), in DataFrame functions.

A source's target is its weight's share of the whole, at most ``CAP`` times what it holds; what is
over goes to the others by weight until none is above. Of its target a source gives whole epochs of
all its documents first. The rest is drawn without replacement: a document of weight w gets the key
-ln(u) / w, u being a number in (0, 1] that its id and text decide; documents come in the order of their
keys, sizes are summed up, and the sum is cut where it is nearest to the target.

Scale: texts are read once; all else runs over narrow rows (id, source, size, key). They are not
sorted: sums by source and block of keys say which block holds a source's cut, only that block's rows are
summed by distinct row, and only copies of the row at the cut are told apart, in blocks. So neither a
source with a third of all rows nor one row repeated as often lands in one task. Sources are ranked by ranges,
whatever their number; the driver sees sums only.

Defined results: a null or empty text, or one of white space, has size 0 and is never taken, whatever its
source's target; a null source is a source of its own, the last; a null doc_id is as good as any; rows alike
in id, text and source have equal keys, and of those at the cut as many are taken as fit, whichever they
are; a weight that is null or not a number counts as 1, one below ``LEAST_WEIGHT`` as that; a text of any length
counts whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from atelier.llm.common import group_rank, materialise, release

WEIGHTS = (1, 2, 3)  # of sources, repeating
CAP = 3  # times a source's size that its target is at most
SEED = 17
LEAST_WEIGHT = 1e-6
GOOD, BAD = 2.0, 0.5  # weights of documents labelled good and bad; others have 1
BLOCK_ROWS, MOST_BLOCKS = 20_000, 1 << 16  # rows of a block of keys, about; blocks of a source
COPIES = 4096  # blocks in which copies of one row are told apart

_SPACE = r"\x20\x09-\x0D"
_TRIMMED = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``: each, with the space before it, becomes one letter."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{_SPACE}]*+[^{_SPACE}]++", "a")
    return F.octet_length(F.rtrim(marks, F.lit(_TRIMMED))).cast("long")


def drawn(key: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1] that id, text and seed decide: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}:"), F.coalesce(text, F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / F.lit(float(2**52))


def sized_rows(docs: DataFrame, weights: DataFrame | None, seed: int) -> DataFrame:
    """doc_id, source, size, key and a row number of every document. ``weights``: (doc_id, weight), ids unique."""
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"), drawn(F.col("doc_id"), F.col("text"), seed).alias("u"))
    weight = F.lit(1.0)
    if weights is not None:
        rows = rows.join(weights.select("doc_id", F.col("weight").cast("double").alias("weight")), "doc_id", "left")
        weight = F.greatest(F.when(F.isnan("weight"), F.lit(1.0)).otherwise(F.coalesce("weight", F.lit(1.0))), F.lit(LEAST_WEIGHT))
    return rows.select("doc_id", "source", "size", (-F.ln("u") / weight).alias("key"), F.monotonically_increasing_id().alias("uid"))


def ranked_sources(rows: DataFrame, weights: tuple[int, ...], held: list[DataFrame]) -> DataFrame:
    """source, source_size, n_rows, weight of each source; the weight goes by its place among code points, null last.

    Sources are dealt by ranges, and a place is a count of the ranges before plus one in its own.
    """
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    order = [F.col("source").isNull(), F.col("source")]
    ranged = materialise(found.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "mix-sources", held=held)
    counts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over a count per range
    offsets = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    by_place = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    return ranged.join(offsets, "range").select("source", "source_size", "n_rows", by_place.alias("weight"))


def with_targets(sources: DataFrame, cap: int) -> DataFrame:
    """``target`` of each source. Each round caps those above their bound and shares out the rest; three sums come to the driver."""
    total, weights, n = sources.agg(F.sum("source_size"), F.sum("weight"), F.count(F.lit(1))).first()
    exact = "decimal(38,0)"
    capped, left, over = 0, total or 0, weights or 0
    while True:
        above = F.lit(cap).cast(exact) * F.col("source_size") * F.lit(over).cast(exact) <= F.lit(left).cast(exact) * F.col("weight")
        size, held, found = sources.filter(above).agg(F.sum("source_size"), F.sum("weight"), F.count(F.lit(1))).first()
        if found == capped or found == n:
            break
        capped, left, over = found, total - cap * size, weights - held
    share = F.lit(float(left)) / F.lit(float(over or 1)) * F.col("weight")
    return sources.withColumn("target", F.when(above, (F.lit(cap) * F.col("source_size")).cast("double")).otherwise(share))


def mix(docs: DataFrame, weights: DataFrame | None = None, source_weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted), epochs (times the document is taken)."""
    held: list[DataFrame] = []
    rows = materialise(sized_rows(docs, weights, seed), "mix-rows")
    sources = with_targets(ranked_sources(rows, source_weights, held), cap)
    sources = sources.withColumn("whole", F.round("target").cast("long")).withColumn("full", F.expr("if(source_size > 0, whole div source_size, 0L)"))
    sources = sources.select("source", "source_size", "n_rows", "target", "full", (F.col("whole") - F.col("full") * F.col("source_size")).alias("rest"))
    sources = materialise(sources, "mix-targets", held=held)

    most = sources.agg(F.max("n_rows")).first()[0] or 0
    blocks = min(MOST_BLOCKS, max(256, -(-most // BLOCK_ROWS)))
    block = F.least(F.floor((1 - F.exp(-F.col("key"))) * blocks), F.lit(blocks - 1)).cast("int")  # rises with the key, about evenly
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    dealt = rows.withColumn("block", block)

    sums = dealt.filter("size > 0").groupBy("source", "block").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("block"))
    passed = sums.withColumn("upto", upto).withColumnRenamed("source", "of")
    at = passed.join(sources.select("source", "rest"), same("of", "source")).filter("upto >= rest and upto - words < rest")
    cuts = materialise(at.select("source", F.col("block").alias("cut_block"), (F.col("rest") - F.col("upto") + F.col("words")).alias("wanted")), "mix-cuts", held=held)

    # inside the block with the cut: distinct rows in order, and how many copies of the one at the cut
    item = ["source", "key", "doc_id", "size"]
    inside = dealt.filter("size > 0").withColumnRenamed("source", "of").join(cuts, same("of", "source") & (F.col("block") == F.col("cut_block"))).drop("of")
    distinct = inside.groupBy(*item, "wanted").agg(F.count(F.lit(1)).alias("n"))
    run = F.sum(F.col("n") * F.col("size")).over(Window.partitionBy("source").orderBy("key", "doc_id", "size"))
    last = distinct.withColumn("upto", run).filter("upto >= wanted and upto - n * size < wanted")
    copies = F.expr("(2 * (wanted - upto + n * size) + size) div (2 * size)")  # nearest to what is wanted
    ends = materialise(last.select(F.col("source").alias("of"), F.col("key").alias("cut_key"), F.col("doc_id").alias("cut_id"), F.col("size").alias("cut_size"), "n", copies.alias("copies")), "mix-ends", held=held)

    plans = cuts.join(ends, same("source", "of")).drop("of", "wanted").withColumnRenamed("source", "of")
    plans = sources.join(plans, same("of", "source"), "left").drop("of").withColumnRenamed("source", "of")
    plans = materialise(plans, "mix-plans")
    for done in held:
        release(done)
    known = dealt.join(plans, same("source", "of")).drop("of", "n_rows")
    here = F.struct("block", "key", F.coalesce("doc_id", F.lit(-(2**63))), F.col("doc_id").isNotNull(), "size")
    there = F.struct("cut_block", "cut_key", F.coalesce("cut_id", F.lit(-(2**63))), F.col("cut_id").isNotNull(), "cut_size")
    known = known.withColumn("side", F.when((F.col("size") == 0) | F.col("cut_key").isNull(), 1).when(here < there, -1).when(here == there, 0).otherwise(1))
    split = (F.col("side") == 0) & (F.col("copies") < F.col("n"))
    result = lambda df, more: df.select("doc_id", "size", "source_size", "target", ((F.col("full") + more) * F.col("size")).alias("taken"), (F.col("full") + more).cast("long").alias("epochs"))
    sure = result(known.filter(~split), F.when(F.col("side") <= 0, 1).otherwise(0))
    told = _told_apart(known.filter(split))
    return sure.unionByName(result(told, F.when(F.col("copy") < F.col("copies"), 1).otherwise(0)))


def _told_apart(rows: DataFrame) -> DataFrame:
    """``copy``: a number from 0 for the copies of each source's row at the cut; a null source has a name for the while."""
    named = rows.withColumn("name", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    return group_rank(named, ["name"], F.pmod("uid", F.lit(COPIES)).cast("int"), [F.col("uid")], "copy")


def label_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, weight) from quality labels: ``GOOD`` for 1, ``BAD`` for 0, between for an id with both; ids without one are left out."""
    seen = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("q"))
    return seen.select("doc_id", (F.lit(BAD) + (GOOD - BAD) * F.col("q")).alias("weight"))


def mix_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op11: all documents, labelled ones weighted by their quality."""
    return mix(docs, label_weights(labels))


def mix_documents_sql() -> str:
    """The same in DuckDB SQL: keys sorted as a whole, targets from the order in which sources reach their bounds."""
    return f"""
WITH quality AS (
  SELECT doc_id, avg(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
),
docs AS (
  SELECT row_number() OVER () AS r, d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    -ln((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || ':{SEED}:' || coalesce(text, '')), 1, 13))::BIGINT + 1)::DOUBLE / {2**52}::DOUBLE) / coalesce({BAD} + {GOOD - BAD} * q, 1.0) AS key
  FROM documents d LEFT JOIN quality l ON l.doc_id = d.doc_id
),
sources AS (
  SELECT source, source_size, [{", ".join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT]::HUGEINT AS weight
  FROM (SELECT source, sum(size)::HUGEINT AS source_size FROM docs GROUP BY source)
),
ordered AS (
  SELECT *, row_number() OVER w AS place, sum(source_size) OVER () - {CAP} * coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_left,
    sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_over
  FROM sources WINDOW w AS (ORDER BY {CAP} * source_size::DOUBLE / weight::DOUBLE, source NULLS LAST)
),
level AS (
  SELECT before_left AS left_, before_over AS over_, place AS first_free FROM ordered WHERE {CAP} * source_size * before_over > before_left * weight ORDER BY place LIMIT 1
),
targets AS (
  SELECT source, source_size, CASE WHEN l.first_free IS NULL OR place < l.first_free THEN ({CAP} * source_size)::DOUBLE ELSE l.left_::DOUBLE / l.over_::DOUBLE * weight::DOUBLE END AS target
  FROM ordered LEFT JOIN level l ON true
),
needs AS (
  SELECT *, CASE WHEN source_size > 0 THEN round(target)::HUGEINT // source_size ELSE 0 END AS full_ FROM targets
),
summed AS (
  SELECT d.*, n.source_size, n.target, n.full_, round(n.target)::HUGEINT - n.full_ * n.source_size AS rest,
    sum(CASE WHEN size > 0 THEN size ELSE 0 END) OVER (PARTITION BY d.source ORDER BY CASE WHEN size > 0 THEN 0 ELSE 1 END, key, d.doc_id NULLS FIRST, size, r) AS upto
  FROM docs d JOIN needs n ON n.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, ((full_ + more) * size)::BIGINT AS taken, (full_ + more)::BIGINT AS epochs
FROM (SELECT *, CASE WHEN size > 0 AND 2 * (rest - (upto - size)) >= size THEN 1 ELSE 0 END AS more FROM summed)
"""

"""Sharding by jump consistent hashing (Lamping and Veach 2014), in DataFrame functions only.

A key and the number of shards decide a row's shard; with one shard more, a row either stays or
moves into the new shard. No ring table is kept.

Defined results: a null key counts as -1; a null text has no bytes (size 8, checksum 0); rows
with equal keys share a shard and get slots of their own; an empty table gives an empty result;
of the table only the key and the text are read, so other columns' names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.llm.common import group_rank

SHARDS = 24
BLOCKS = 256  # a shard's slots are dealt in so many blocks: no task holds a whole shard
ROW_OVERHEAD = 8

# Fixed value: the multiplier of the published generator, x -> x * MULTIPLIER + 1 modulo 2^64.
MULTIPLIER = 2862933555777941757
_HIGH, _LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_M32 = 0xFFFFFFFF


def _next_state(high: str, low: str) -> tuple[str, str]:
    """SQL for the two 32-bit halves of the next state; 16-bit limbs, so no long overflows."""
    p = f"(({low} & 65535L) * {_LOW}L + 1L)"
    q = f"(shiftright({low}, 16) * {_LOW}L + shiftright({p}, 16))"
    new_low = f"(shiftleft({q} & 65535L, 16) | ({p} & 65535L))"
    cross = f"(({high} & 65535L) * {_LOW}L + shiftleft(shiftright({high}, 16) * {_LOW}L & 65535L, 16)"
    side = f"({low} & 65535L) * {_HIGH}L + shiftleft(shiftright({low}, 16) * {_HIGH}L & 65535L, 16))"
    return f"(({cross} + {side} + shiftright({q}, 16)) & {_M32}L)", new_low


def jump_shards(key: str, shards: int) -> Column:
    """struct(shard, grown, mixed) of a long column: shard of ``shards``, of ``shards + 1``, 32 mixed bits.

    The jumps of a key are the same for every count: the shard is the last jump below it.
    """
    k = f"coalesce(`{key}`, -1L)"
    high, low = _next_state("s.high", "s.low")
    start = f"named_struct('shard', 0L, 'before', 0L, 'jump', 0L, 'high', shiftrightunsigned({k}, 32), 'low', {k} & {_M32}L, 'mixed', -1L)"
    moved = f"named_struct('shard', s.jump, 'before', s.shard, 'jump', s.jump, 'high', {high}, 'low', {low}, 'mixed', s.mixed)"
    jumped = (
        "named_struct('shard', m.shard, 'before', m.before, 'jump', cast(floor((m.shard + 1) * (2147483648D / (shiftright(m.high, 1) + 1))) as bigint), "
        "'high', m.high, 'low', m.low, 'mixed', if(m.mixed < 0, m.high, m.mixed))"
    )
    step = f"if(s.jump > {shards}L, s, element_at(transform(array({moved}), m -> {jumped}), 1))"
    end = f"named_struct('shard', cast(if(r.shard = {shards}L, r.before, r.shard) as int), 'grown', cast(r.shard as int), 'mixed', r.mixed)"
    return F.expr(f"aggregate(sequence(0, {shards}), {start}, (s, i) -> {step}, r -> {end})")


def shard_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, blocks: int = BLOCKS) -> DataFrame:
    """key, size, text_crc32, shard, grown_shard and the row's slot in its shard (from 0, no gaps).

    Only these narrow rows are shuffled, dealt by shard and block; texts stay where they are read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        jump_shards(key, shards).alias("__jump"),
    )
    rows = rows.select("doc_id", "size", "text_crc32", F.col("__jump.shard").alias("shard"), F.col("__jump.grown").alias("grown_shard"), F.col("__jump.mixed").alias("__mixed"))
    block = (F.col("__mixed") + F.col("text_crc32")).bitwiseAND(F.lit(blocks - 1)).cast("int")  # rows of one key with unlike texts are spread
    ranked = group_rank(rows, ["shard"], block, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "slot")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def shard_rows_sql(shards: int = SHARDS, blocks: int = BLOCKS) -> str:
    """The same in DuckDB SQL. Jumps by a recursive query, the checksum bit by bit over the bytes."""
    return f"""
WITH RECURSIVE
crc_table AS (
  SELECT list(value ORDER BY n) AS crcs FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS value
    FROM range(256) t(n))
),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents
),
sized AS (
  SELECT r, doc_id, octet_length(encode(body)) + {ROW_OVERHEAD} AS size, hex(encode(body)) AS digits FROM docs
),
checked AS (
  SELECT r, doc_id, size, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(size - {ROW_OVERHEAD}), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM sized, crc_table
),
jumps AS (
  SELECT r, 0::BIGINT AS shard, 0::BIGINT AS jump, (CASE WHEN coalesce(doc_id, -1) < 0 THEN coalesce(doc_id, -1)::HUGEINT + 18446744073709551616 ELSE doc_id::HUGEINT END) AS state, -1::HUGEINT AS mixed FROM docs
  UNION ALL
  SELECT r, jump, floor((jump + 1) * (2147483648.0::DOUBLE / (after // 8589934592 + 1)::DOUBLE))::BIGINT, after, CASE WHEN mixed < 0 THEN after // 4294967296 ELSE mixed END
  FROM (SELECT *, (state % 4294967296 * {MULTIPLIER} + state // 4294967296 * {MULTIPLIER % (1 << 32)} % 4294967296 * 4294967296 + 1) % 18446744073709551616 AS after FROM jumps WHERE jump <= {shards})
),
landed AS (
  SELECT r, max(shard) FILTER (WHERE shard < {shards})::INT AS shard, max(shard)::INT AS grown_shard, max(mixed) AS mixed FROM jumps GROUP BY r
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY (mixed + text_crc32) % {blocks}, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM checked JOIN landed USING (r)
"""

"""Captions: exclusion, cleaning, the five variants, and the weighted choice among them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from atelier.functions.text import or_empty, strip

# Phrases whose captions are left out.
EXCLUDED = ["no humans", "chibi", "character profile", "lineart", "sketch", "monochrome", "comic", "text focus", "1990s", "1980s", "retro artstyle", "abstract"]
# Weights of the variants (tags, tags reversed, author, author and tags, author and tags reversed).
WEIGHTS = [0.30, 0.15, 0.10, 0.30, 0.15]
TOKEN_CAP = 77


def keeps(caption: Column, phrases: list[str]) -> Column:
    """False if any phrase is anywhere in the caption, even inside a word. Null is kept."""
    c = or_empty(caption)
    return ~reduce(lambda a, b: a | b, [c.contains(p) for p in phrases], F.lit(False))


def split_list(c: Column) -> Column:
    """Items between commas (also full-width ones), stripped, empty ones dropped, order and repeats kept."""
    parts = F.split(F.replace(or_empty(c), F.lit("，"), F.lit(",")), ",")
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def join_list(items: Column) -> Column:
    return F.array_join(items, ", ")


def variants(caption: Column, author: Column) -> Column:
    """array of the five texts; authors are never reversed."""
    tags, who = split_list(caption), join_list(split_list(author))
    ahead, back = join_list(tags), join_list(F.reverse(tags))
    both = lambda t: F.when((who != "") & (t != ""), F.concat(who, F.lit(", "), t)).when(who != "", who).otherwise(t)
    return F.array(ahead, back, who, both(ahead), both(back))


def variant_mask(texts: Column) -> Column:
    """True for texts that are not empty and equal no earlier one."""
    return F.transform(texts, lambda x, i: (x != "") & ~F.exists(F.slice(texts, 1, i), lambda y: y == x))


def preview(texts: Column, mask: Column) -> Column:
    at = lambda c, i: F.element_at(c, i + 1)
    return F.when(at(mask, 3), at(texts, 3)).when(at(mask, 0), at(texts, 0)).when(at(mask, 2), at(texts, 2)).otherwise("")


def chosen_index(mask: Column, drawn: Column, weights: list[float] = WEIGHTS) -> Column:
    """Inverse of the distribution over unmasked variants at a number in [0, 1); -1 if all are masked."""
    w = F.array(*[F.when(F.element_at(mask, i + 1), F.lit(x)).otherwise(F.lit(0.0)) for i, x in enumerate(weights)])
    sums = [reduce(lambda a, b: a + b, [F.element_at(w, k + 1) for k in range(i + 1)]) for i in range(len(weights))]
    below = reduce(lambda a, b: a + b, [F.when(s / sums[-1] <= drawn, 1).otherwise(0) for s in sums])
    last = F.array_max(F.transform(mask, lambda m, i: F.when(m, i).otherwise(-1)))
    return F.when(sums[-1] > 0, F.least(below, last)).otherwise(-1).cast("int")


def chosen_text(texts: Column, index: Column) -> Column:
    return F.when(index >= 0, F.element_at(texts, index + 1)).otherwise("")


def token_count_proxy(c: Column, cap: int = TOKEN_CAP) -> Column:
    """Words between white space, at most the cap: a stand-in where no tokenizer is given."""
    words = F.filter(F.split(or_empty(c), r"\s+"), lambda x: x != "")
    return F.least(F.size(words), F.lit(cap))


def token_counts(df: DataFrame, text: str, name: str, tokenizer: Callable[[], Callable[[str], int]], cap: int = TOKEN_CAP) -> DataFrame:
    """Adds the number of tokens, at most the cap. ``tokenizer`` makes, once a task, the function text -> tokens; null counts as empty."""
    schema = StructType([*df.schema, *StructType().add(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer()
        for batch in batches:
            n = [min(cap, count(t or "")) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)

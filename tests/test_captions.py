"""The caption rules on captions whose results are worked out by hand."""

from pyspark.sql import functions as F

from atelier.operators import captions as op
from atelier.operators.tags import tag_line


# caption, author; the five texts, which of them count, the preview, and the last that counts: worked out by hand
CASES = [
    (None, None, ["", "", "", "", ""], [False] * 5, "", -1),
    ("", "x", ["", "", "x", "x", "x"], [False, False, True, False, False], "x", 2),
    ("a", "", ["a", "a", "", "a", "a"], [True, False, False, False, False], "a", 0),
    ("a, b", None, ["a, b", "b, a", "", "a, b", "b, a"], [True, True, False, False, False], "a, b", 1),
    ("a，b ,a", "w", ["a, b, a", "a, b, a", "w", "w, a, b, a", "w, a, b, a"], [True, False, True, True, False], "w, a, b, a", 3),
    ("\u3000x\t, y\u3000", " q ", ["x, y", "y, x", "q", "q, x, y", "q, y, x"], [True] * 5, "q, x, y", 4),
    (",,", "u，v", ["", "", "u, v", "u, v", "u, v"], [False, False, True, False, False], "u, v", 2),
    ("a", "a", ["a", "a", "a", "a, a", "a, a"], [True, False, False, True, False], "a, a", 3),
    ("b", "a, b", ["b", "b", "a, b", "a, b, b", "a, b, b"], [True, False, True, True, False], "a, b, b", 3),
]


def test_variants(spark):
    df = spark.createDataFrame([(i, c, a) for i, (c, a, *_) in enumerate(CASES)], "i long, c string, a string").withColumn("v", op.variants(F.col("c"), F.col("a")))
    df = df.withColumn("m", op.variant_mask(F.col("v"))).withColumn("p", op.preview(F.col("v"), F.col("m"))).withColumn("k", op.chosen_index(F.col("m"), F.lit(0.999)))
    for row in df.collect():
        assert (row["c"], row["a"], row["v"], row["m"], row["p"], row["k"]) == CASES[row["i"]]


def test_weights(spark):
    df = spark.range(20000).select(op.chosen_index(F.array(*[F.lit(True)] * 5), F.rand(3)).alias("k")).groupBy("k").count()
    shares = {r["k"]: r["count"] / 20000 for r in df.collect()}
    assert all(abs(shares[i] - w) < 0.02 for i, w in enumerate(op.WEIGHTS))


def test_exclusion_and_lines(spark):
    rows = [(None, True), ("", True), ("comic book", False), ("Comic", True)]
    df = spark.createDataFrame(rows, "c string, keep boolean")
    assert all(r[0] == r[1] for r in df.select(op.keeps(F.col("c"), op.EXCLUDED), "keep").collect())
    line = spark.range(1).select(tag_line(F.lit("t"), F.lit(0.5005)).alias("a"), tag_line(F.lit("t"), F.lit(1234.5)).alias("b")).first()
    assert tuple(line) == ("t 0.500", "t 1234.500")


def test_caption_tokens(spark):
    """Against the tokenizer itself; a pinned count; nulls, special strings and long texts."""
    from tokenizers import Tokenizer

    from atelier.functions import tokens

    rows = [(1, "long hair, 1girl, Red Bow"), (2, ""), (3, None), (4, "<|endoftext|> text"), (5, "snow, " * 20_000), (6, "\u96ea  \U0001f600")]
    df = spark.createDataFrame(rows, "k int, t string")
    got = {r["k"]: r["n"] for r in op.token_counts(df, "t", "n", tokens.caption_tokens(), cap=10**9).collect()}
    assert got[1] == 10 and got[2] == got[3] == 2 and got[5] == 40_002 and got[4] > 4
    plain = Tokenizer.from_file(tokens.CAPTION_VOCABULARY)
    assert got[6] == len(plain.encode(rows[5][1], add_special_tokens=False).ids) + 2
    assert {r["n"] for r in op.token_counts(df, "t", "n", tokens.caption_tokens()).collect()} <= set(range(78))


def test_caption_tokens_are_counted_once_a_word():
    """As the tokenizer counts whole texts, in a third of its time at most where words come again."""
    import random
    import time

    from tokenizers import Tokenizer

    from atelier.functions import tokens

    plain = Tokenizer.from_file(tokens.CAPTION_VOCABULARY)
    plain.encode_special_tokens = True
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) + rng.choice(["", "", ",", ".", "'s"]) for _ in range(5_000)]
    texts = [" ".join(rng.choices(vocabulary, k=500)) for _ in range(400)]
    count = tokens.caption_tokens()()
    began = time.process_time()
    got = [count(t) for t in texts]
    took, began = time.process_time() - began, time.process_time()
    assert got == [len(plain.encode(t, add_special_tokens=False).ids) + 2 for t in texts]
    assert 3 * took < time.process_time() - began


def test_caption_tokens_of_odd_words(monkeypatch):
    """Against the tokenizer: every plain character, marks that compose, all kinds of white space and control, other rules, full caches."""
    import random

    from tokenizers import Tokenizer

    from atelier.functions import tokens

    plain = Tokenizer.from_file(tokens.CAPTION_VOCABULARY)
    plain.encode_special_tokens = True
    expected = lambda t: len(plain.encode(t, add_special_tokens=False).ids) + 2
    monkeypatch.setattr(tokens, "KEPT", 1_000)
    tokens.counter.cache_clear()
    count = tokens.caption_tokens()()
    inert = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x10000)]) if tokens.PLAIN.fullmatch(c)]
    assert len(inert) > 30_000
    for c in inert:
        text = f"A{c}b{c}{c}'S{c} 7{c}'{c}!"
        assert count(text) == expected(text), ascii(c)
    odd = [*"aAeEsStTlLmMdDvVrR'' 0159.,<|>#\t\n\v\f\r\0\x1c\x1f\x7f\x85\xa0\xad", *map(chr, [0x130, 0x300, 0x308, 0x327, 0x3A3, 0x3C3, 0x9C7, 0x9BE, 0x1100, 0x1161, 0x11A8, 0xAC00, 0x2003, 0x2028, 0x200B, 0x3000, 0x212B, 0x1F600]), "'LL", "'re", "<|endoftext|>", "ABcd" * 30]
    rng = random.Random(4)
    for pool in (odd, odd + inert[:600]):
        for _ in range(10_000):
            text = "".join(rng.choices(pool, k=rng.randint(1, 20)))
            assert count(text) == expected(text), ascii(text)
    tokens.counter.cache_clear()


def test_caption_tokens_of_other_rules(tmp_path):
    """A vocabulary that keeps capitals is counted by its own rules."""
    from tokenizers import Tokenizer, normalizers

    from atelier.functions import tokens

    other = Tokenizer.from_file(tokens.CAPTION_VOCABULARY)
    other.normalizer = normalizers.NFC()
    other.save(str(tmp_path / "other.json"))
    text = "LONG Hair, Red BOW"
    ids = other.encode(text, add_special_tokens=False).ids
    assert tokens.caption_tokens(str(tmp_path / "other.json"))()(text) == len(ids) + 2 != tokens.caption_tokens()()(text)

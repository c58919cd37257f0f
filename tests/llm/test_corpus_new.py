"""Mixing, the conversation trie and collocations: edge cases, skewed tables, and brute force on small ones."""

import collections
import fractions
import hashlib
import itertools
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from atelier.llm import collocations, conversation_trie, source_mixing

DOCS = "doc_id long, text string, lang string, source string"
TURNS = "conv_id long, turn long, role string, text string"


def same_as_sql(spark, df, sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame.toArrow())
    want = con.sql(sql)
    names = sorted(want.columns)
    assert sorted(df.columns) == names
    got = sorted(tuple(map(repr, r)) for r in df.select(names).collect())
    expected = sorted(tuple(map(repr, r)) for r in con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall())
    assert got == expected
    return [dict(zip(names, r, strict=True)) for r in con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()]


# --- mixing

SPACES = re.compile("[^\x20\x09-\x0d]+")


def mixed(spark, rows, labels=()):
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")
    return same_as_sql(spark, source_mixing.mix_documents(docs, marks), source_mixing.mix_documents_sql(), documents=docs, labels=marks)


def test_mix_edges(spark):
    rows = [(1, None, None, "a"), (2, "", None, "a"), (3, " \t\x0b ", None, None), (None, "x y z", None, None), (5, "w " * 5000, None, "b"), (6, "one", None, "\U0001f600"), (6, "one", None, "\U0001f600"), (6, "one", None, "￮")]
    got = mixed(spark, rows, [(5, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0)])
    assert len(got) == len(rows)
    assert sorted(r["size"] for r in got) == sorted(len(SPACES.findall(t or "")) for _, t, _, _ in rows)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    clash = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as size", "2 as key", "'x' as block", "3 as uid", "4 as weight", "5 as target")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert source_mixing.mix_documents(clash, marks).count() == len(rows)
    assert source_mixing.mix_documents(spark.createDataFrame([], DOCS), marks).count() == 0


def brute_targets(sizes, weights, cap):
    """Excess over the bounds reshared by weight until none is above, in fractions."""
    total, free, out = sum(sizes.values()), set(sizes), {}
    while True:
        share = fractions.Fraction(total - sum(out.values()), sum(weights[s] for s in free) or 1)
        over = {s for s in free if cap * sizes[s] <= share * weights[s]}
        if not over:
            return out | {s: share * weights[s] for s in free}
        out |= {s: cap * sizes[s] for s in over}
        free -= over
        if not free:
            return out


def test_mix_targets_and_skew(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(["w"] * rng.randint(1, 60)), None, rng.choice([None, "a", "b", "b", "b", "c", "d"] + ["hot"] * 20)) for k in range(3000)]
    rows += [(77, "the same " * 9, None, "hot")] * 1500 + [(k, "tiny", None, f"s{k}") for k in range(40)]
    labels = [(k, k % 2, 0) for k in range(0, 3000, 3)]
    got = mixed(spark, rows, labels)
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len(text.split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: source_mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    want = brute_targets(sizes, weights, 3)
    assert collections.Counter(round(r["target"], 6) for r in got) == collections.Counter(round(float(want[s]), 6) for _, _, _, s in rows)
    taken, longest = collections.Counter(), 60
    for r in got:
        taken[(r["source_size"], r["target"])] += r["taken"]
        assert r["taken"] % r["size"] == 0 and r["taken"] <= 3 * r["size"]
    by = {(sizes[s], float(want[s])) for s in sizes if list(sizes.values()).count(sizes[s]) == 1}
    assert by and all(abs(taken[k] - k[1]) <= longest / 2 + 1 for k in by)
    assert {r["taken"] // 18 for r in got if r["doc_id"] == 77 and r["size"] == 18} <= {0, 1, 2, 3}


def test_mix_prefers_quality(spark):
    rows = [(k, "five words are in it", None, s) for s, base in (("a", 0), ("b", 10_000), ("c", 20_000)) for k in range(base, base + 4000)]
    got = mixed(spark, rows, [(r[0], r[0] % 2, 0) for r in rows])
    parts = collections.Counter((r["doc_id"] % 2, r["epochs"]) for r in got if r["doc_id"] < 4000)
    # a takes half a share: with weights 2 and 1/2, good ones come first
    assert parts[1, 1] > 2 * parts[0, 1] > 0 and sum(parts.values()) == 4000


# --- conversation trie


def brute_trie(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    plain = {c: [(r, t) for _, r, t in sorted(own)] for c, own in turns.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        path = tuple(plain.get(base, [])[:h] + own[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, own in members.items()
    )


def trie(spark, rows):
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as depth", "2 as a", "3 as n", "'x' as anchor")
    names = [c.split()[0] for c in conversation_trie.NODE.split(", ")]
    return sorted(tuple(r) for r in conversation_trie.trie_of_conversations(df).select(names).collect())


def test_trie_edges(spark):
    rows = [(0, None, "user", "é\U0001f600"), (0, 0, None, None), (7, 1, "user", "x"), (7, 1, "user", "x"), (7, None, "b", "a"), (7, None, "a", "b"), (None, 0, "user", "y"), (-3, 0, "user", "z"), (250, 5, "user", "alone"), (1200, 0, "u", "long " * 20_000), (2**40, 0, "", "")]
    assert trie(spark, rows) == brute_trie(rows)
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "a", "b")]) == []


@pytest.mark.parametrize("seed,most,held", [(1, 3, 10), (2, 40, 50), (3, 10**6, 400_000), (4, 0, 1)])
def test_trie_against_brute_force(spark, monkeypatch, seed, most, held):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-150, 700), 260):
        kind = rng.random()
        size = rng.choice([1, 2, 3, 8, 20, 45]) if kind < 0.7 else 30
        texts = ["same"] * size if kind > 0.6 else [rng.choice("ab" if kind < 0.3 else "abcdefgh") for _ in range(size)]
        rows += [(conv, k, "user", t) for k, t in enumerate(texts)]
    monkeypatch.setattr(conversation_trie, "HELD", held)
    monkeypatch.setattr(conversation_trie, "BLOCK", 3)
    monkeypatch.setattr(conversation_trie, "MEMBERS", 2)
    monkeypatch.setattr(conversation_trie, "LEAST_GROUP", most)
    monkeypatch.setattr(conversation_trie, "MOST_GROUP", most)
    assert trie(spark, rows) == brute_trie(rows)


# --- collocations


def brute_counts(rows, longest=5):
    n, f = collections.Counter(), collections.Counter()
    lower = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
    for _, text, lang, _ in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i : i + k])] += 1
    return n, f


def brute_collocations(rows, least, top):
    n, f = brute_counts(rows)
    out = collections.defaultdict(list)
    covered = collections.Counter()
    for (lang, p), a in f.items():
        if a >= least:
            for i, j in itertools.combinations(range(len(p) + 1), 2):
                if 2 <= j - i < len(p):
                    covered[lang, p[i:j]] = max(covered[lang, p[i:j]], a)
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least and covered[lang, p] < a:
            score, _, lead, rest = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), lead, rest))
    return sorted((lang, k + 1, p.decode(), -a, lead, rest, n[lang], -score) for lang, own in out.items() for k, (score, a, p, lead, rest) in enumerate(sorted(own)[:top]))


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def prose(rng, size):
    words = ["the", "The", "of", "is", "ÉTÉ", "été", "a", "xx", "İ", "new", "york"] + [f"w{k}" for k in range(40)]
    return "".join(rng.choice(words[: rng.choice([4, 11, 51])]) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", " \x0b"]) for _ in range(size))


@pytest.mark.parametrize("chunk,burst,entries", [(500_000, 4096, 300_000), (37, 3, 40), (5, 1, 7)])
def test_collocations_against_brute_force(spark, monkeypatch, chunk, burst, entries):
    rng = random.Random(chunk)
    rows = [(k, prose(rng, rng.choice([0, 1, 5, 60, 300])), rng.choice(["en", "de", None, "und"]), None) for k in range(120)]
    rows += [(None, None, "en", None), (1, "", "fr", None), (2, ". ,;", "es", None), (3, "new york " * 700, "en", None), (3, "new york " * 700, "en", None), (4, "q" * 9000 + " z " + "q" * 9000 + " z", "en", None)] * 2
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "MOST_BITS", 9 if chunk == 5 else 27)
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as n", "2 as key", "'x' as word", "3 as part")
    got = collocations.collocations(docs.repartition(3), least=4, top=60, burst=burst, entries=entries)
    assert sorted(tuple(r) for r in got.select(COLUMNS).collect()) == brute_collocations(rows, 4, 60)


def test_collocations_empty(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None, None)], DOCS)).count() == 0


def test_scores_beyond_64_bits(spark):
    key = lambda *k: b"".join(x.to_bytes(8, "big") for x in k)
    a, left, right, n = 3 * 10**12 + 7, 5 * 10**12 + 11, 4 * 10**12 + 1, 9 * 10**17 + 13
    words = spark.createDataFrame([("en", "x", 1, left), ("en", "y", 2, right)], "lang string, word string, number long, n long")
    got = collocations.scored(spark.createDataFrame([(key(1, 2), a)], "key binary, n long"), words, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert (got["l"], got["r"], got["score"]) == (left, right, 1000 * a * n // (left * right))


def test_trie_spills_whole_subtrees():
    rng = random.Random(8)
    trie_, counted, out = collocations.HatTrie(burst=5, entries=60), collections.Counter(), collections.Counter()
    for _ in range(400):
        first = bytes([0] * 7 + [rng.randrange(6)])
        rests = [b"".join(bytes([0] * 7 + [rng.randrange(4)]) for _ in range(rng.choice([1, 2, 4]))) for _ in range(5)]
        trie_.add(first, rests, [1] * 5)
        for r in rests:
            counted[first + r] += 1
        assert trie_.size == sum(slot[0] for slot in trie_.root.values())
        if trie_.full():
            run = list(trie_.spill(30))
            assert run == sorted(run) and trie_.size <= 30
            for k, n in run:
                out[k] += n
    run = list(trie_.spill(0))
    for k, n in run:
        out[k] += n
    assert not trie_.size and out == counted


def test_a_long_text_is_read_in_stretches():
    text = "ab cd. " * 400_000 + "e" * 3_000_000
    batch = pa.RecordBatch.from_pydict({"text": ["x y", text, "z"], "lang": ["en", "de", "en"]})
    got = [(len(w.number), len(w.data), on) for w, on in collocations.stretches(iter([batch]))]
    assert sum(n for n, _, _ in got) == 2 + 800_001 + 1 and sum(n for _, n, _ in got) == len(text) + 4
    assert max(n for _, n, _ in got[:-1]) <= collocations.CHUNK + 3_000_000 and got[1][2]
    assert os.environ["PYTHONPATH"]


# --- chat formatting of one very large conversation


def test_one_conversation_is_formatted_by_many_tasks(spark):
    """Most rows are one conversation's without turn numbers: its segments lie in several tasks, and its digests are those of all rows in order."""
    from atelier.llm import chat_masks

    rng = random.Random(12)
    rows = [(5, None, rng.choice(["user", "assistant"]), f"{rng.random()} <|im_end|> é{k}") for k in range(4000)] + [(k, 0, "assistant", f"t{k}") for k in range(40)]
    df = spark.createDataFrame(rows, TURNS).repartition(6)
    formatted = chat_masks.format_conversations(df)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one task's
    try:
        assert len({r["part"] // chat_masks._TASK for r in formatted.filter("conv_id = 5").select("part").collect()}) >= 3
        got = {r["conv_id"]: r for r in chat_masks.digests(formatted).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 40
    for conv in (5, 7):
        # the row of turn 0 comes after those without a turn
        own = sorted((r, t) for c, turn, r, t in rows if c == conv and turn is None) + [("assistant", f"t{conv}")]
        assert got[conv]["n_turns"] == len(own) and got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[conv]["loss_chars"] == len(loss) and got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()

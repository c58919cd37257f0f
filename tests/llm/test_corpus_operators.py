"""The operators on Spark: edge cases, and brute force on small tables."""

import collections
import glob
import hashlib
import itertools
import json
import os
import random
import zlib
from html.parser import HTMLParser

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from atelier.llm import chat_masks, chosen_path, common, decontaminate, html_crf, jump_shards, packing, pii_tagger, suffix_rules, warc_revisit, zstd_quality
from atelier.llm.queries import ORACLES, QUERIES
from tests.llm.test_corpus_kernels import brute_spans

SF = "/root/testdata/sf0.001"
EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "one two"), (5, "one two"), (None, "ünï ©ode | ### text"), (7, "long " * 30_000), (8, "a@b.co 4111 1111 1111 1111"), (-9, "x" * 50_000)]
EDGE_SCHEMA = "doc_id long, text string"


def edge(spark, extra=True):
    df = spark.createDataFrame(EDGE, EDGE_SCHEMA)
    return df.selectExpr("'c' as kept", "doc_id", "text", "1 as shard", "2 as key", "3 as uid", "4L as n_chars", "'s' as `class_id`") if extra else df


def empty(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "documents pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    a, b = (sorted((tuple(map(repr, r)) for r in rows)) for rows in (got.select(sorted(got.columns)).collect(), duck.sql(f"SELECT {', '.join(sorted(want.columns))} FROM ({ORACLES[name]})").fetchall()))
    assert [tuple(r) for r in a] == b


# --- jump sharding


def jump(key, shards):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b, key = j, (key * jump_shards.MULTIPLIER + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (2147483648.0 / ((key >> 33) + 1)))
    return b


def test_jump_shards(spark):
    keys = [*range(-50, 2000, 7), 2**63 - 1, -(2**63), 10**12]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump_shards.jump_shards("k", 24).alias("j")).collect()
    for r in got:
        assert (r["j"]["shard"], r["j"]["grown"]) == (jump(r["k"], 24), jump(r["k"], 25))
    moved = [r for r in got if r["j"]["shard"] != r["j"]["grown"]]
    assert moved and all(r["j"]["grown"] == 24 for r in moved) and len(moved) < 3 * len(keys) / 25


def test_sharding_edges(spark):
    rows = jump_shards.shard_rows(edge(spark)).collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        texts = [t or "" for d, t in EDGE if d == r["doc_id"]]
        assert r["size"] in [len(t.encode()) + 8 for t in texts] and r["text_crc32"] in [zlib.crc32(t.encode()) for t in texts]
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r["shard"], r["slot"])), key=lambda r: r["shard"]):
        own = list(own)
        assert [r["slot"] for r in own] == list(range(len(own)))
    assert jump_shards.shard_rows(empty(spark)).count() == 0


# --- revisits


def brute_revisits(records):
    out = {}
    for r in records:
        if r["kind"] != "revisit":
            continue
        earlier = [x for x in records if x["kind"] == "response" and x["complete"] and x["u"] == r["u"] and None not in (x["at"], r["at"]) and (x["at"], x["record_id"]) < (r["at"], r["record_id"])]
        f = max(earlier, key=lambda x: (x["at"], x["record_id"]), default=None)
        if f is None:
            status = "no_response"
        elif r["etag"] is None and r["last_modified"] is None:
            status = "no_validator"
        elif r["etag"] is not None:
            mine, stored = r["etag"], f["etag"] or ""
            status = "resolved" if mine == stored or mine[:2] == "W/" and mine[2:] == stored.removeprefix("W/") else "changed"
        else:
            status = "resolved" if f["last_modified"] == r["last_modified"] else "changed"
        merged = None
        if status == "resolved":
            merged = dict(f["headers"] or {}) | {k: v for k, v in (r["headers"] or {}).items() if k in warc_revisit.PERMITTED}
        out[r["record_id"]] = (f and f["record_id"], status, merged)
    return out


@pytest.mark.parametrize(
    "stored, asked, status",
    [  # (entity tag, modification time) of the response and of the revisit; what the standard says of them
        (('"a"', None), ('"a"', None), "resolved"),
        (('"a"', None), ('"b"', None), "changed"),
        (('W/"a"', None), ('W/"a"', None), "resolved"),  # weak comparison
        (('"a"', None), ('W/"a"', None), "resolved"),
        (('W/"a"', None), ('W/"b"', None), "changed"),
        (('W/"a"', None), ('"a"', None), "changed"),  # a strong validator needs the same strong one
        (('W/"a"', "d"), ('W/"a"', "d"), "resolved"),
        (('W/"a"', "d"), ('W/"b"', "d"), "changed"),  # tags go before times
        ((None, "d"), ('"a"', "d"), "changed"),
        (('"a"', "d"), (None, "d"), "resolved"),
        (('"a"', "d"), (None, "e"), "changed"),
        ((None, None), (None, "d"), "changed"),
        (('"a"', "d"), (None, None), "no_validator"),
    ],
)
def test_validators(spark, stored, asked, status):
    schema = "record_id long, url string, at long, kind string, complete boolean, etag string, last_modified string, headers map<string,string>"
    rows = [(1, "http://a.org/x", 1, "response", True, *stored, {"date": "1", "etag": "x", "x-own": "kept"}), (2, "https://www.a.org/x/", 2, "revisit", None, *asked, {"date": "2", "content-length": "0"}), (3, "a.org/x", None, "revisit", None, *asked, None)]
    got = {r["record_id"]: r for r in warc_revisit.resolve_revisits(spark.createDataFrame(rows, schema), blocks=2).collect()}
    assert got[2]["status"] == status and got[2]["headers"] == ({"date": "2", "etag": "x", "x-own": "kept"} if status == "resolved" else None)
    assert (got[3]["status"], got[3]["response_id"]) == ("no_response", None)


def test_revisits_against_brute_force(spark):
    r = random.Random(1)
    records = []
    for i in range(400):
        u = r.choice(["hot"] * 5 + ["a", "b"])
        records.append(
            {"record_id": i, "url": {"hot": r.choice(["http://www.Hot.org/p/", "https://hot.org:443/p?utm_source=x#f"]), "a": "a.org/?b=2&a=1", "b": "a.org?a=1&b=2&ref=9"}[u], "u": u if u == "hot" else "ab", "at": None if r.random() < 0.1 else r.randrange(60),
             "kind": r.choice(["response", "revisit"]), "complete": r.random() < 0.8, "etag": r.choice([None, '"1"', '"2"', 'W/"1"']), "last_modified": r.choice([None, "d1", "d2"]), "headers": r.choice([None, {"date": str(i), "content-length": "5", "x": "y"}])}
        )
    assert {x["kind"] for x in records if x["at"] is None} == {"response", "revisit"}
    schema = "record_id long, url string, at long, kind string, complete boolean, etag string, last_modified string, headers map<string,string>, canonical_url string"
    df = spark.createDataFrame([tuple(x[c] for c in ("record_id", "url", "at", "kind", "complete", "etag", "last_modified", "headers")) + ("clash",) for x in records], schema)
    got = {x["record_id"]: (x["response_id"], x["status"], x["headers"]) for x in warc_revisit.resolve_revisits(df, blocks=8).collect()}
    assert got == brute_revisits(records)
    assert {s for _, s, _ in got.values()} >= {"resolved", "changed"}
    assert warc_revisit.resolve_revisits(df.limit(0)).count() == 0
    nulls = spark.createDataFrame([(1, None, 1, "response", True, None, None, None, ""), (2, None, 2, "revisit", None, None, None, None, "")], schema)
    assert [x["status"] for x in warc_revisit.resolve_revisits(nulls).collect()] == ["no_validator"]


# --- quality rules


def test_rules_edges(spark):
    rows = suffix_rules.repetition_rules(edge(spark)).collect()
    assert len(rows) == len(EDGE)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert by[7]["n_words"] == 30_000 == by[7]["n_repeat_words"] and by[7]["longest_repeat"] == 29_999
    assert suffix_rules.repetition_rules(empty(spark)).count() == 0
    varied = " ".join(f"w{i}" for i in range(80))
    repeated = " ".join(f"w{i}" for i in range(60)) + " " + " ".join(f"v{i}" for i in range(30)) + " " + " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, varied), (2, repeated), (3, "short")], EDGE_SCHEMA).withColumn("kept", F.lit("clash"))
    assert [r["doc_id"] for r in suffix_rules.keep_unrepetitive(docs).collect()] == [1]
    assert suffix_rules.keep_unrepetitive(docs).columns == docs.columns


# --- near duplicates


def sets_of(rows):
    def one(t):
        w = (t or "").lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    return [one(t) for _, t in rows]


def brute_classes(rows):
    s, n = sets_of(rows), len(rows)
    parent, links = list(range(n)), [0] * n

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(n), 2):
        k = len(s[i] & s[j])
        if k and k >= 0.8 * (len(s[i]) + len(s[j]) - k):
            links[i] += 1
            links[j] += 1
            parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(n):
        groups.setdefault(find(i), []).append(i)
    smallest = {i: min((rows[k][0] for k in g if rows[k][0] is not None), default=None) for g in groups.values() for i in g}
    return links, smallest


@pytest.fixture(scope="module")
def near_rows():
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    base, passage = ([r.choice(vocabulary) for _ in range(n)] for n in (120, 30))
    rows = []
    for i in range(150):  # one large group of near copies
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(120)] = r.choice(vocabulary)
        rows.append((i, " ".join(w)))
    for i in range(150, 350):  # a passage that unlike texts share
        w = [r.choice(vocabulary) for _ in range(60)]
        rows.append((i, " ".join(w[:30] + passage + w[30:])))
    rows += [(i, rows[200][1]) for i in range(350, 380)]  # exact copies
    return rows + [(1000, None), (1001, ""), (1002, "one two"), (1003, "One two"), (1002, "one two")]


@pytest.mark.parametrize("leaf, block, wide, hot", [(256, 128, 1024, 200), (16, 32, 1024, 10), (16, 16, 24, 2)])
def test_join_against_brute_force(spark, near_rows, monkeypatch, leaf, block, wide, hot):
    """Clusters of one block, of several compared in one wide block or in pairs of such; few or all keys hot."""
    monkeypatch.setattr(chosen_path, "LEAF", leaf)
    monkeypatch.setattr(chosen_path, "BLOCK", block)
    monkeypatch.setattr(chosen_path, "WIDE", wide)
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    links, smallest = brute_classes(near_rows)
    got = chosen_path.jaccard_join(spark.createDataFrame(near_rows, EDGE_SCHEMA)).collect()
    assert len(got) == len(near_rows)
    want = sorted((near_rows[i][0], smallest[i], links[i]) for i in range(len(near_rows)))
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == want


def test_join_of_repeated_rows(spark, near_rows):
    """One row and its near copy, each many times over, beside a large cluster: each repeat counts, none is compared anew."""
    a, b = near_rows[0][1], " ".join(near_rows[0][1].split()[:-1]) + " other"
    once = [(0, a), (500, b), *near_rows[1:40]]
    links, smallest = brute_classes(once)
    text_links = links[0]
    docs = spark.createDataFrame(once, EDGE_SCHEMA).withColumn("n", F.when(F.col("doc_id") % 500 == 0, 10_000).otherwise(1)).withColumn("i", F.explode(F.sequence(F.lit(1), "n"))).select("doc_id", "text")
    got = chosen_path.jaccard_join(docs).groupBy("doc_id", "class_id", "n_links", "n_text_links", "n_copies").count().collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(once) and by[0]["count"] == by[500]["count"] == by[0]["n_copies"] == 10_000
    assert {d: r["class_id"] for d, r in by.items()} == {d: smallest[i] for i, (d, _) in enumerate(once)}
    assert by[0]["n_text_links"] == text_links and by[0]["n_links"] == 9_999 + text_links - 1 + 10_000
    assert chosen_path.keep_one_of_each(docs).count() == len(set(smallest.values()))


def test_join_leaves_one_table(spark, near_rows):
    before = set(glob.glob(f"{common.shared_dir(spark).removeprefix('file://')}/atelier/*"))
    chosen_path.jaccard_join(spark.createDataFrame(near_rows, EDGE_SCHEMA)).count()
    left = {os.path.basename(x).split("-")[0] for x in set(glob.glob(f"{common.shared_dir(spark).removeprefix('file://')}/atelier/*")) - before}
    assert left == {"joined"}


def test_skew_join(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    left = spark.range(300).selectExpr("case when id < 100 then 7 when id < 130 then 8 else id end as k", "id as v")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("m")).filter("k <> 200")
    joined = common.skew_join(left, right, ["k"], "n")
    assert sorted(map(tuple, joined.select("k", "v", "m").collect())) == sorted(map(tuple, left.join(right, "k").select("k", "v", "m").collect()))
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().toString() and common.skew_join(left, right.limit(0), ["k"], "n").count() == 0


def test_join_edges(spark):
    assert chosen_path.jaccard_join(empty(spark)).count() == 0
    assert chosen_path.jaccard_join(edge(spark)).count() == len(EDGE)
    docs = spark.createDataFrame([*EDGE, (20, "one two"), (None, "only here")], EDGE_SCHEMA).withColumn("class_id", F.lit("clash"))
    kept = chosen_path.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sum(t == "one two" for _, t in rows) == 1 and (4, "one two") in rows
    assert {d for d, _ in rows} == {1, 2, 3, 4, 7, 8, -9, None} and len(rows) == 9


def test_components(spark):
    r = random.Random(5)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, x) for x in range(5001, 5300)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {x["node"]: x["root"] for x in common.components(spark.createDataFrame(pairs, "a long, b long"), "test").collect()}
    assert got == {x: find(x) for x in parent}
    assert common.components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


# --- decontamination


def test_leaks(spark):
    r = random.Random(6)
    words = [f"k{i}" for i in range(400)]
    filler = ["the", "of", "and", "in", "to", "is"]
    sentence = lambda n: " ".join(r.choice(words) if r.random() < 0.6 else r.choice(filler) for _ in range(n))
    items = [(i, f"{sentence(20)}. {sentence(8)}.") for i in range(30)]
    docs, truth = [], set()
    for i in range(300):
        text = sentence(r.choice([3, 40, 200]))
        if i % 10 == 0:
            k = r.randrange(30)
            body = items[k][1].split()
            if i % 20 == 0:  # a paraphrase: some words replaced, some added, the answer kept
                for p in r.sample(range(20), 3):
                    body[p] = "swapped"
                body.insert(5, "added")
            text = f"{text} {' '.join(body)} {sentence(50)}"
            truth.add((i, k))
        docs.append((i, text))
    docs += [(1000, None), (1001, ""), (1002, "the of and")]
    bench = spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")
    df = spark.createDataFrame(docs, EDGE_SCHEMA).withColumn("item_id", F.lit("clash"))
    got = decontaminate.find_leaks(df, bench).collect()
    assert {(x["doc_id"], x["item_id"]) for x in got} == truth
    kept = decontaminate.drop_leaking(df, bench)
    assert kept.columns == df.columns and {x["doc_id"] for x in kept.collect()} == {d for d, _ in docs} - {d for d, _ in truth}
    assert decontaminate.find_leaks(df, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(df.limit(0), bench).count() == 0


def test_leaks_of_a_table(spark):
    """Every document that holds a whole item, letter by letter but for case and punctuation, is found."""
    plain = lambda t: " " + " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split()) + " "
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r["item_id"], plain(r["text"])) for r in bench.collect()]
    truth = {(r["doc_id"], i) for r in docs.collect() for t in [plain(r["text"])] for i, s in items if s in t}
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()} == truth and truth


def brute_leaks(docs, items):
    """Every document against every item and every place, by common subsequences and the answer alone."""
    judge = decontaminate.Judge(items, decontaminate.COVERED)
    lists = {}
    for d, text in docs:
        _, w = decontaminate.plain_words(pa.array([text], pa.string()))
        lists[d] = w.hash.tolist()
    out = set()
    for d, own in lists.items():
        held = collections.Counter(own)
        for k, item in enumerate(items.ids):
            length, bits, answer, answer_bits = judge.items[k]
            if sum(min(n, held[w]) for w, n in judge.counts[k].items()) < judge.least[k]:
                continue
            wide, step = -(-length * 5 // 4), max(1, length // 8)
            for start in range(0, max(1, len(own) - length // 2), step):
                part = own[start : start + wide]
                share = decontaminate.common_subsequence(bits, length, part) / length
                if share >= decontaminate.SURE or share >= decontaminate.COVERED and decontaminate.common_subsequence(answer_bits, answer, part) / answer >= decontaminate.ANSWER:
                    out.add((d, item))
                    break
    return out


@pytest.mark.parametrize("n_items, n_docs", [(30, 400), (400, 200), (2000, 120)])
def test_recall_of_the_latent_search(spark, n_items, n_docs):
    """Verbatim items and paraphrases, items of 1 to 200 words, on both sides of the rank's bound: against all pairs."""
    r = random.Random(n_items)
    vocabulary = ["".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(6000)]
    weights = [1 / (k + 200) for k in range(len(vocabulary))]
    say = lambda n: " ".join(r.choices(vocabulary, weights, k=n))
    items = [(i, f"{say(r.choice([1, 2, 3, 6, 12, 25, 60, 150]))}. {say(r.randint(2, 10))}." if i % 9 else say(r.choice([1, 2, 3])) + f" only{i}") for i in range(n_items)]
    docs, planted = [], set()
    for d in range(n_docs):
        words = say(r.choice([20, 120, 400])).split()
        if d % 3:
            k = r.randrange(n_items)
            body = items[k][1].split()
            if d % 3 == 2:  # a paraphrase: a fifth of the words swapped, some added
                body = [w if r.random() > 0.2 else r.choice(vocabulary) for w in body]
                for _ in range(len(body) // 12):
                    body.insert(r.randrange(len(body)), r.choice(vocabulary))
            at = r.randint(0, len(words))
            words[at:at] = body
            planted.add((d, k))
        docs.append((d, " ".join(words)))
    want = brute_leaks(docs, decontaminate.Items(items))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(x["doc_id"], x["item_id"]) for x in decontaminate.find_leaks(spark.createDataFrame(docs, EDGE_SCHEMA), bench).collect()}
    recall = {k: len(v & found) / len(v) for k, v in {"all": want, "planted": want & planted}.items()}
    print(f"items {n_items}: {len(want)} pairs, recall {recall}, {len(found - want)} more")
    assert len(want) > n_docs / 3 and min(recall.values()) >= 0.95 and len(found - want) <= len(want) / 20


def test_leaks_edges(spark):
    """Repeated documents are each reported; a very long text is searched to its end."""
    bench = spark.createDataFrame([(1, "seven grey herons stood beside the frozen canal at dawn. They were waiting.")], "item_id long, text string")
    text = "filler words go here " * 100_000 + "seven grey herons stood beside the frozen canal at dawn. They were waiting."
    rows = [(1, text), (1, text), (2, text[:-60]), (3, None), (None, text[-90:])]
    got = decontaminate.find_leaks(spark.createDataFrame(rows, EDGE_SCHEMA), bench).collect()
    assert sorted((x["doc_id"] or 0, x["item_id"]) for x in got) == [(0, 1), (1, 1), (1, 1)]
    assert decontaminate.drop_leaking(spark.createDataFrame(rows, EDGE_SCHEMA), bench).count() == 2


def test_leaks_of_short_items(spark):
    """Items of one or two different words: exact copies alone, among words that are no terms, and among terms of other items."""
    long = [(i, " ".join(f"t{i}x{k}" for k in range(40))) for i in range(10, 13)]
    items = [(1, "Zebra crossing?"), (2, "これは短い文です"), (3, "no no yes"), *long]
    among = " ".join(w for k in range(40) for w in (f"t10x{k}", f"t11x{(k * 7) % 40}"))
    docs = [(1, "zebra crossing"), (2, "the of and " * 40 + "zebra crossing " + "in to is " * 40), (3, f"{among} Zebra, crossing! {among}"), (4, "crossing the zebra"), (5, "zebra"), (6, "これは短い文です"), (7, f"{among} no no {among}"), (8, "yes no"), (9, "of " * 31 + "zebra crossing " + "of " * 31)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(spark.createDataFrame(docs, EDGE_SCHEMA), bench).collect()
    assert {(x["doc_id"], x["item_id"]) for x in got if x["item_id"] < 10 and x["doc_id"] != 7} == {(1, 1), (2, 1), (3, 1), (6, 2), (9, 1)}
    assert {x["common_words"] for x in got if x["item_id"] == 1} == {2} and (7, 3) in {(x["doc_id"], x["item_id"]) for x in got}
    kept = decontaminate.drop_leaking(spark.createDataFrame(docs, EDGE_SCHEMA), bench)
    assert {4, 5, 8} <= {x["doc_id"] for x in kept.collect()} and not {1, 2, 3, 6, 9} & {x["doc_id"] for x in kept.collect()}


def test_leaks_of_a_templated_benchmark(spark):
    """Nearly all words of an item stand in every item; one of its few own words is changed in the copy."""
    item = lambda k, own: f"A tank named {own} holds ninety litres and loses seven every hour until somebody mends its valve {k}a {k}b."
    bench = spark.createDataFrame([(k, item(k, f"{k}c")) for k in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item(5, "changed")), (2, item(6, "6c")), (3, "nothing of the kind")], EDGE_SCHEMA)
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.find_leaks(docs, bench).collect()}
    assert {(1, 5), (2, 6)} <= got and 3 not in {d for d, _ in got}


def test_leaks_of_a_benchmark_in_blocks(spark, monkeypatch):
    """More items than one search takes: repeated rows, an item in two blocks, and rows without words."""
    item = lambda k: " ".join(f"b{k}w{j}" for j in range(20))
    rows = [*((k, item(k)) for k in range(10)), (3, item(3)), (4, item(40)), (20, None), (None, item(50))]
    bench = spark.createDataFrame([*rows, *((30 + k, "") for k in range(8))], "item_id long, text string")
    docs = spark.createDataFrame([(100 + k, f"so {item(k)} so") for k in (0, 3, 5, 9, 40, 50, 60)] + [(200, f"{item(1)} and {item(8)}"), (201, None)], EDGE_SCHEMA)
    pairs = lambda: sorted((x["doc_id"], x["item_id"]) for x in decontaminate.find_leaks(docs, bench).collect())
    want = sorted([(100, 0), (103, 3), (103, 3), (105, 5), (109, 9), (140, 4), (200, 1), (200, 8)])
    assert pairs() == want
    monkeypatch.setattr(decontaminate, "MOST_ITEMS", 5)
    assert pairs() == want
    kept = decontaminate.drop_leaking(docs, bench)
    assert kept.columns == docs.columns and sorted(x["doc_id"] for x in kept.collect()) == [150, 160, 201]


# --- personal data


def test_tags_and_redaction(spark):
    rows = {(r["doc_id"], r["n_email"], r["n_card"], r["spans"], r["base_sha256"]) for r in pii_tagger.tag_documents(edge(spark)).collect()}
    spans = "email:0:6,card:7:26"
    assert (8, 1, 1, spans, hashlib.sha256(spans.encode()).hexdigest()) in rows
    assert (1, 0, 0, "", hashlib.sha256(b"").hexdigest()) in rows and (7, 0, 0, "", hashlib.sha256(b"").hexdigest()) in rows
    assert pii_tagger.tag_documents(empty(spark)).count() == 0
    out = pii_tagger.redact(edge(spark))
    assert out.columns == edge(spark).columns
    by = {r["doc_id"]: r for r in out.collect()}
    assert (by[8]["text"], by[8]["n_chars"]) == ("[EMAIL] [CARD]", 14) and by[1]["text"] is None and by[1]["n_chars"] == 4
    assert pii_tagger.masked("ab", [("ip", 0, 2), ("card", 1, 2)]) == "[IP]"


def test_weights_are_stored(spark, monkeypatch):
    first = pii_tagger.stored(spark)
    monkeypatch.setattr(pii_tagger, "trained", None)
    again = pii_tagger.stored(spark)
    assert first.p.keys() == again.p.keys() and all((first.p[k] == again.p[k]).all() for k in first.p)


def test_tags_of_a_table_against_brute_force(spark):
    """Base spans of every document by the contract's expressions, and counts that agree with the spans."""
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in QUERIES["op3_pii_tagger"](spark, SF).collect()}
    assert found.keys() == rows.keys()
    for d, text in rows.items():
        base, r = brute_spans(text), found[d]
        assert [r[f"n_{k}"] for k in pii_tagger.KINDS] == [sum(s[0] == k for s in base) for k in pii_tagger.KINDS]
        assert r["base_sha256"] == hashlib.sha256(pii_tagger.joined(base).encode()).hexdigest()
        assert set(pii_tagger.joined(base).split(",")) - {""} <= set(r["spans"].split(",")) and r["n_spans"] == len(base) + r["n_added"]


# --- pages


def test_pages(spark):
    rows = [(1, "u", "<html><body><nav><a href=x>m</a></nav><article><h1>A</h1><p>b &amp; c</p></article></body>", "x"), (2, None, None, ""), (3, "v", "", ""), (4, "w", "<p>" * 20_000, "")]
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in html_crf.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert got == {1: ("u", "A\nb & c", 7), 2: (None, "", 0), 3: ("v", "", 0), 4: ("w", "", 0)}
    assert html_crf.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


class _Article(HTMLParser):
    """The article of the table's pages, read by another parser: its blocks, line by line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.raw, self.blocks = 0, 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.raw += tag in ("script", "style")
        if tag == "br":
            self.blocks[-1] += " "
        elif tag not in ("a", "b", "i", "em", "strong", "span", "code"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.raw -= tag in ("script", "style")
        if tag not in ("a", "b", "i", "em", "strong", "span", "code"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside and not self.raw:
            self.blocks[-1] += data


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_pages_against_another_parser(spark, sf):
    rows = spark.read.parquet(f"{SF[:-5]}{sf}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op4_crf_extraction"](spark, f"{SF[:-5]}{sf}").collect()}
    for r in rows:
        parser = _Article()
        parser.feed(r["html"])
        parser.close()
        want = "\n".join(t for t in (" ".join(b.split()) for b in parser.blocks) if t)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want), r["page_id"]
    assert len(got) == len(rows)


# --- packing


def test_packing(spark):
    r = random.Random(7)
    rows = [(i, r.choice([3, 9, 60, 61, 500])) for i in range(500)] + [(500, 5000), (501, 1), (None, 7), (1, 9)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, n_tokens long"), buckets=4, budget=1000, block_rows=60).collect()
    assert sorted((x["doc_id"] is None, x["doc_id"], x["n_tokens"]) for x in got if x["doc_id"] is not None) == sorted((False, d, n) for d, n in rows if d is not None)
    batches = {}
    for x in got:
        assert x["n_tokens"] <= x["padded_tokens"] and x["padding"] == x["padded_tokens"] - x["n_tokens"]
        batches.setdefault((x["bucket"], x["batch"]), []).append(x)
    assert len({x["bucket"] for x in got}) <= 4
    for (bucket, number), own in batches.items():
        assert sorted(x["place"] for x in own) == list(range(len(own)))
        assert len(own) == 1 or sum(x["padded_tokens"] for x in own) <= 1000
        if (bucket, number + 1) in batches:
            assert len(own) == max(1, 1000 // own[0]["padded_tokens"])
    lengths = {x["doc_id"]: x["n_tokens"] for x in packing.token_lengths(edge(spark)).collect()}
    assert lengths[1] == lengths[2] == 1 and lengths[7] > 30_000
    assert packing.pack_documents(empty(spark)).count() == 0


def test_packing_of_long_runs(spark):
    """Texts of five million characters of white space, alone and between words; their stage of the pipeline, too."""
    run = {"spaces": " ", "newlines": "\n", "tabs": "\t", "mixed": " \n\t\u3000"}
    texts = {k: c * (5_000_000 // len(c)) for k, c in run.items()}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts.values(), *(f"ab{t}cd" for t in texts.values())])], EDGE_SCHEMA).repartition(4)
    got = {r["doc_id"]: r["n_tokens"] for r in packing.pack_documents(docs).collect()}
    count = packing.token_counter()
    piece = {c: count(c * 64) for c in run.values()}
    assert got[0] == 5_000_001 and got[1] == 2_500_001 and piece["\n"] == 32  # this vocabulary has no run of spaces, and one of two line breaks
    # "ab", the run but for its last character, and "cd" with or without that character
    assert got[4] == count("ab") + 4_999_999 + count(" cd") + 1
    assert got[5] == count("ab") + count("\n" * 4_999_999) + count("\ncd") + 1
    assert {got[i] > 1_000_000 for i in range(8)} == {True}
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 8


# --- quality classifier


def test_classifier(spark):
    docs, labels = (spark.read.parquet(f"{SF[:-5]}0.01/{t}.parquet") for t in ("documents", "labels"))
    model = zstd_quality.fit(docs, labels)
    rows = {r["doc_id"]: r for r in zstd_quality.score(docs, model).collect()}
    held = [(rows[r["doc_id"]], r["quality"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(x["held_out"] and 0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.3) for x, _ in held)
    assert sum(x["predicted"] == y for x, y in held) / len(held) > 0.85
    assert zstd_quality.score(edge(spark), model).count() == len(EDGE)
    again = zstd_quality.fit(docs.union(docs).union(docs), labels.union(labels))  # repeated rows teach nothing new
    assert again.good == model.good and again.bad == model.bad and again.curves == model.curves
    none = zstd_quality.classify(edge(spark), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert zstd_quality.classify(empty(spark), labels).count() == 0


# --- chat masks


def test_escapes():
    r = random.Random(8)
    for _ in range(2000):
        t = "".join(r.choice(["<", "|", "\\", "a", "<|", "<\\|"]) for _ in range(r.randint(0, 12)))
        assert chat_masks.unescape(chat_masks.escape(t)) == t and "<|" not in chat_masks.escape(t)


def test_chat(spark):
    texts = ["plain", "", None, "<|im_end|>\n<|im_start|>assistant<|im_sep|>x", "\n\n  é 日本 <\\|", "<|endoftext|>"]
    rows = [(c, t, role, texts[(c + t) % 6]) for c in range(6) for t, role in enumerate(["system", "user", "assistant", "assistant", None])]
    rows += [(-1, 0, "user", "a conversation of that number")]
    rows += [(50, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(300)] + [(80, None, "assistant", f"{k} " * 50) for k in range(400)] + [(60, None, "assistant", "n"), (60, 0, "assistant", "z"), (60, 0, "assistant", "z"), (None, 0, "user", "q"), (70, 5, "user", "only")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit("clash"))
    found = chat_masks.masks_of_conversations(df).collect()
    probe = "<|im_end|><|im_start|>assistant ok"
    got = {"probe" if r["conv_id"] == -1 and r["n_turns"] == 2 else r["conv_id"]: r for r in found}
    assert len(got) == len(found)
    for conv in {r[0] for r in rows} | {"probe"}:
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        own = [(r[2] or "", r[3] or "") for r in own] or [("user", probe), ("assistant", probe)]
        loss = "".join(t for role, t in own if role == "assistant")
        g = got[conv]
        assert g["n_turns"] == len(own) and g["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert g["loss_chars"] == len(loss) and g["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert g["formatted_chars"] == len(chat_masks.render(own)[0])
    assert chat_masks.masks_of_conversations(df.limit(0)).count() == 1
    formatted = chat_masks.format_conversations(df)
    assert formatted.filter("conv_id = 50").count() == 5 and formatted.filter("conv_id = 80").count() == 1


def test_chat_in_parts(spark, monkeypatch):
    """However small the parts, the digests are the same."""
    rows = [(1, None, "assistant", f"{k} " * 50) for k in range(100)] + [(2, t, "assistant", "x <| y") for t in range(200)] + [(3, 0, "user", "z" * 5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = sorted(map(tuple, chat_masks.masks_of_conversations(df).collect()))
    monkeypatch.setattr(chat_masks, "PART", 300)
    assert sorted(map(tuple, chat_masks.masks_of_conversations(df).collect())) == whole
    assert chat_masks.format_conversations(df).filter("conv_id = 1").count() > 20


# --- pipeline


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Rows that each stage has to live with: nulls, empty and very long texts, repeats, ties, clashing columns."""
    r = random.Random(12)
    prose = " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(120))
    long = " ".join(f"w{k}" for k in range(200_000))
    rows = [*EDGE, (20, prose), (20, prose), (21, prose + " more"), (None, prose), (22, f"{prose[::-1]} write to a@b.co"), (23, long), (24, "\n" * 2_000_000), (25, None), (25, None)]
    return spark.createDataFrame(rows, EDGE_SCHEMA).selectExpr("'c' as kept", "doc_id", "text", "1 as shard", "cast(length(text) as long) as n_chars", "'s' as class_id", "2L as uid", "3 as bucket")


def stages():
    return dict(pytest.importorskip("corpus_pipeline").STAGES)


def ids(df):
    return collections.Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_of_an_empty_table(spark, odd_docs):
    for name, stage in stages().items():
        out = stage(spark, odd_docs.limit(0), SF)
        assert out.count() == 0 and (name == "length_buckets" or out.columns == odd_docs.columns), name


def test_quality_stage_of_odd_rows(spark, odd_docs):
    out = stages()["quality_rules"](spark, odd_docs, SF)
    assert out.columns == odd_docs.columns and ids(out) == {20: 2, 21: 1, None: 1, 22: 1, 23: 1}


def test_near_copies_stage_of_odd_rows(spark, odd_docs):
    out = stages()["near_duplicates"](spark, odd_docs, SF)
    assert out.columns == odd_docs.columns
    # (4, 5, 5: "one two"; 20, 20, 21, None: one prose; repeats of one row once)
    assert ids(out) == {1: 1, 2: 1, 3: 1, 4: 1, None: 1, 7: 1, 8: 1, -9: 1, 20: 1, 22: 1, 23: 1, 24: 1, 25: 1}


def test_decontamination_stage_of_odd_rows(spark, odd_docs):
    out = stages()["decontamination"](spark, odd_docs, SF)
    assert out.columns == odd_docs.columns and ids(out) == ids(odd_docs)


def test_personal_data_stage_of_odd_rows(spark, odd_docs):
    out = stages()["personal_data"](spark, odd_docs, SF)
    assert out.columns == odd_docs.columns and ids(out) == ids(odd_docs)
    by = {r["doc_id"]: r for r in out.collect()}
    assert by[22]["text"].endswith("write to [EMAIL]") and by[22]["n_chars"] == len(by[22]["text"]) and by[25]["text"] is None


def test_packing_stage_of_odd_rows(spark, odd_docs):
    out = stages()["length_buckets"](spark, odd_docs, SF)
    rows = out.collect()
    assert ids(out) == ids(odd_docs) and len({(r["bucket"], r["batch"], r["place"]) for r in rows}) == len(rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 25)} == {1}


def test_packing_against_brute_force(spark):
    """The whole query: tokens by the pattern itself, the least padding of all sets of bounds, full batches."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    count = packing.token_counter()
    rows = {r["doc_id"]: r for r in QUERIES["op5_length_buckets"](spark, SF).collect()}
    assert {d: r["n_tokens"] for d, r in rows.items()} == {r["doc_id"]: (count(r["text"]) if r["text"] else 0) + 1 for r in docs}
    padded = sorted(-(-r["n_tokens"] // packing.MULTIPLE) * packing.MULTIPLE for r in rows.values())
    lengths = sorted(set(padded))
    least = {0: 0}  # least padding of the lengths up to each, by one more bucket a round
    for _ in range(packing.BUCKETS):
        new = dict(least)
        for j in range(1, len(lengths) + 1):
            for i, cost in least.items():
                if i < j:
                    own = [x for x in padded if lengths[i] <= x <= lengths[j - 1]] if i else [x for x in padded if x <= lengths[j - 1]]
                    new[j] = min(new.get(j, 10**12), cost + sum(lengths[j - 1] - x for x in own))
        least = new
    got = sum(r["padded_tokens"] - -(-r["n_tokens"] // packing.MULTIPLE) * packing.MULTIPLE for r in rows.values())
    assert got == least[len(lengths)]
    batches = collections.defaultdict(list)
    for r in rows.values():
        batches[r["bucket"], r["batch"]].append(r)
    for (bucket, batch), own in batches.items():
        full = max(1, packing.BUDGET // own[0]["padded_tokens"])
        assert sorted(r["place"] for r in own) == list(range(len(own))) and (len(own) == full or (bucket, batch + 1) not in batches and len(own) < full)


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "length_buckets"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.materialise(stage(spark, before, SF), name)
        assert after.schema.names == docs.schema.names
        a, b = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (before, after))
        if name == "quality_rules":
            assert set(b) == {r["doc_id"] for r in suffix_rules.repetition_rules(before).filter("kept").collect()}
        elif name == "near_duplicates":
            ids = sorted(a)
            _, smallest = brute_classes([(i, a[i]) for i in ids])
            assert set(b) == {i for k, i in enumerate(ids) if smallest[k] == i}
        elif name == "decontamination":
            leaks = decontaminate.find_leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
            assert set(b) == set(a) - {r["doc_id"] for r in leaks} and leaks
        else:
            assert set(a) == set(b) and any(a[i] != b[i] for i in a) and not any(pii_tagger.base_spans(b[i]) for i in b)
        before = after
    assert corpus_pipeline.run(spark, SF).count() == before.count()
    assert json.dumps(names)

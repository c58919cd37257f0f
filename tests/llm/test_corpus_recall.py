"""Recall of the latent search for each length of items and each share of swapped words."""

import collections
import random

import pytest

from atelier.llm import decontaminate
from tests.llm.test_corpus_operators import EDGE_SCHEMA, brute_leaks

LENGTHS = (1, 2, 4, 8, 12, 17, 20, 24, 32, 64, 150)
SWAPS = (0, 0.1, 0.2, 0.3, 0.38)


@pytest.mark.parametrize("n_items,skew", [(30, 200), (700, 200), (700, 10**9), (1500, 200)])
def test_recall_by_length_and_swaps(spark, n_items, skew):
    """``skew``: how flat the vocabulary is. Planted pairs that the judge accepts on the whole text must be found."""
    r = random.Random(n_items + skew)
    vocabulary = ["".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(6000)]
    weights = [1 / (k + skew) for k in range(len(vocabulary))]
    say = lambda n: r.choices(vocabulary, weights, k=n)
    items = []
    for i in range(n_items):
        n = LENGTHS[i % len(LENGTHS)]
        body = say(n) if n > 2 else [f"only{i}x{k}" for k in range(n)]
        items.append((i, " ".join(body[: -(-n * 3 // 4)]) + ("? " + " ".join(body[-(-n * 3 // 4) :]) if n > 3 else "")))
    docs, cell = [], {}
    for d in range(len(LENGTHS) * len(SWAPS) * 20):
        n, swap = LENGTHS[d % len(LENGTHS)], SWAPS[d // len(LENGTHS) % len(SWAPS)]
        k = r.randrange(d % len(LENGTHS), n_items, len(LENGTHS)) if d % len(LENGTHS) < n_items else 0
        body = [w if r.random() >= swap else r.choice(vocabulary) for w in items[k][1].split()]
        around = say(r.choice([20, 120]))
        at = r.randint(0, len(around))
        docs.append((d, " ".join(around[:at] + body + around[at:])))
        cell[d] = (n, swap, k)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(x["doc_id"], x["item_id"]) for x in decontaminate.find_leaks(spark.createDataFrame(docs, EDGE_SCHEMA).repartition(4), bench).collect()}
    texts = dict(docs)
    by_item = collections.defaultdict(list)
    for d, (_, _, k) in cell.items():
        by_item[k].append(d)
    accepted, hit = collections.Counter(), collections.Counter()
    for k, own in by_item.items():
        for d, _ in brute_leaks([(d, texts[d]) for d in own], decontaminate.Items([items[k]])):
            accepted[cell[d][:2]] += 1
            hit[cell[d][:2]] += (d, k) in found
    print(n_items, skew, {c: f"{hit[c]}/{n}" for c, n in sorted(accepted.items())})
    assert sum(accepted.values()) > 500
    assert sum(hit.values()) >= 0.97 * sum(accepted.values())
    assert all(hit[c] >= 0.95 * n for c, n in accepted.items() if n >= 15)

"""Ranked search by classes of equal bags, against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from sunledger.llm import ranked_search

from tests.llm.test_edges import ROWS, SCHEMA, clashing

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=50):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, b.total()) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        scored = []
        for i, b, n in bags:
            m = 50 + 50 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 20 * m)) for t in own if b[t])
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return Counter(out)


def got(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


def made(seed=5):
    r = random.Random(seed)
    word = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(r.choice(word[: r.choice([5, 60])]) for _ in range(r.randrange(0, 40)))) for i in range(300)]
    rows += [(1000 + i, "W1 w2, w3! w1") for i in range(120)]  # one large class
    rows += [(2000 + i, f"w4 other{i}") for i in range(90)]  # equal bags once cut down to the items' terms
    return rows + [(None, "w1 w2"), (None, "w1 w2"), (5, "w7 w8 w9"), (3000, None), (3001, ""), (3002, "...")]


ITEMS = [(1, "w1 w2 w2 W3"), (2, "w4"), (3, "w59 nowhere"), (4, "nowhere"), (5, None), (6, "!!"), (7, "w1 w10 w20 w30 w40"), (1, "w50"), (None, "w8 w9")]


@pytest.mark.parametrize("small", [False, True])
def test_search(spark, monkeypatch, small):
    if small:  # several blocks of items
        monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 2)
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").repartition(2)
    assert got(ranked_search.search(docs, items)) == plain(rows, ITEMS)
    assert got(ranked_search.search(docs, items, top=3)) == plain(rows, ITEMS, 3)


def test_classes(spark):
    """A class is scored once, whatever the number of its members."""
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    (block,) = ranked_search.item_blocks(spark.createDataFrame([(1, "w1 w2 w3 w4")], "item_id long, text string"))
    found = ranked_search.bags(docs, block)
    sizes = sorted(len(r["members"]) for r in ranked_search.classes(found, 500, 5000).collect())
    keys = Counter()
    for _, t in rows:
        w = terms(t)
        bag = frozenset((k, v) for k, v in Counter(w).items() if k in ("w1", "w2", "w3", "w4"))
        if bag:
            keys[bag, 50 + 50 * len(w) * 500 // 5000] += 1
    assert sizes == sorted(min(n, ranked_search.TOP) for n in keys.values())


def test_edges(spark):
    docs = clashing(spark.createDataFrame(ROWS, SCHEMA)).repartition(3)
    items = clashing(spark.createDataFrame([(1, "The cat"), (1, "the dog"), (2, None), (3, ""), (None, "word"), (4, "日本語 word5 chien")], "item_id long, text string"))
    want = plain([(r[0], r[1]) for r in ROWS], [(1, "The cat"), (1, "the dog"), (None, "word"), (4, "日本語 word5 chien")])
    assert got(ranked_search.search(docs, items)) == want
    assert ranked_search.search(docs.limit(0), items).collect() == []
    empty = ranked_search.search(docs, items.where(F.lit(False)))
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]

"""Windows of words dealt out as super-k-mers, against plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from sunledger.llm import substrings

from tests.llm.test_edges import LONG, ROWS, SCHEMA, clashing

SPACED = re.compile("[^\x20\x09-\x0d]+")
WIDTH = substrings.WIDTH


def plain(rows):
    """(doc_id, n_words, n_removed, kept text) of each row."""
    words = [SPACED.findall(t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - WIDTH + 1 if i is not None else 0):
            s = tuple(w[k : k + WIDTH])
            first[s] = min(first.get(s, i), i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - WIDTH + 1 if i is not None else 0):
            if first[tuple(w[k : k + WIDTH])] < i:
                gone.update(range(k, k + WIDTH))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def digests(rows):
    return Counter((i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in rows)


def made(seed=3):
    r = random.Random(seed)
    phrase = [[f"p{j}w{k}" for k in range(40)] for j in range(4)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(r.randrange(0, 6)):
            w += r.choice(phrase)[r.randrange(0, 20) : r.randrange(20, 40)] if r.random() < 0.5 else [r.choice("abc") for _ in range(r.randrange(1, 30))]
        rows.append((i, r.choice([" ", "\t", " \n "]).join(w)))
    rows += [(200 + i, "the same words stand in a great many documents of this table " * 3) for i in range(40)]
    rows += [(300, "a " * 3000), (301, "a " * 700), (302, None), (303, ""), (None, rows[5][1]), (7, rows[9][1])]
    return rows


def got(df):
    return Counter(tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for r in df.collect())


@pytest.mark.parametrize("small", [False, True])
def test_removals(spark, monkeypatch, small):
    if small:  # many blocks, and buckets that have to be split
        monkeypatch.setattr(substrings, "BLOCK_BYTES", 1500)
        monkeypatch.setattr(substrings, "BUCKET_WORDS", 60)
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    if small:
        assert substrings.Windows(docs).split
    assert got(substrings.removals(docs)) == digests(plain(rows))


def test_counts(spark):
    rows = [r for r in made() if r[0] is not None]
    want, first = Counter(), {}
    for i, t in rows:
        w = SPACED.findall(t or "")
        for k in range(len(w) - WIDTH + 1):
            s = " ".join(w[k : k + WIDTH])
            want[s] += 1
            first[s] = min(first.get(s, i), i)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {(r["words"], r["times"], r["first_doc"]) for r in substrings.windows(docs, at_least=3).collect()}
    assert found == {(s, n, first[s]) for s, n in want.items() if n >= 3}


def test_edges(spark):
    docs = clashing(spark.createDataFrame(ROWS, SCHEMA)).repartition(3)
    want = plain([(r[0], r[1]) for r in ROWS])
    assert got(substrings.removals(docs)) == digests(want)
    again = [*ROWS, (11, LONG, "en", "long", 5)]
    both = substrings.without_repeats(clashing(spark.createDataFrame(again, SCHEMA)).repartition(3))
    assert both.schema == docs.schema
    kept = {(r["doc_id"], r["text"]) for r in both.collect()}
    assert kept == {(i, None if i == 3 else t) for i, _, _, t in plain([(r[0], r[1]) for r in again])}
    assert both.where(F.col("absent") != "extra absent").count() == 0
    none = clashing(spark.createDataFrame([], SCHEMA))
    assert substrings.removals(none).collect() == [] and substrings.windows(none).collect() == []

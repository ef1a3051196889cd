"""Scores of the URL filter against plain Witten-Bell models over all contexts."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from sunledger.llm import url_filter
from sunledger.llm.registry import URL_RULES


def plain_models(rows):
    models = [(Counter(), Counter(), Counter()) for _ in range(2)]
    for url, kind in rows:
        grams, seen, kinds = models[kind]
        for i in range(len(url)):
            for k in range(url_filter.ORDER + 1):
                context = (k, b"\0" * max(0, k - i) + url[max(0, i - k) : i])
                kinds[context] += grams[context, url[i]] == 0
                grams[context, url[i]] += 1
                seen[context] += 1
    return models


def plain_score(models, url):
    logs = [0.0, 0.0]
    for m, (grams, seen, kinds) in enumerate(models):
        for i in range(len(url)):
            p = 1 / 256
            for k in range(url_filter.ORDER + 1):
                context = (k, b"\0" * max(0, k - i) + url[max(0, i - k) : i])
                if seen[context]:
                    p = (grams[context, url[i]] + kinds[context] * p) / (seen[context] + kinds[context])
            logs[m] += math.log(p)
    return (logs[1] - logs[0]) / max(len(url), 1)


def test_counts_of_many_contexts(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BLOCK_BYTES", 1 << 15, raising=False)
    monkeypatch.setattr(url_filter, "BUCKET_BYTES", 1 << 13, raising=False)
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789-_%.é"))
    ends = ("com", "net/es", "net/fr", "org", "de")
    urls = [f"https://a{i % 97}.{ends[i % 5]}/{''.join(letters[rng.integers(0, len(letters), 60)])}" for i in range(4000)]
    pages = spark.createDataFrame([*enumerate(urls), (-1, None), (-2, "")], "page_id long, url string").repartition(5)
    got = {r["page_id"]: r for r in url_filter.judge(pages, URL_RULES).collect()}
    assert len(got) == len(urls) + 2 and got[-1]["score"] == got[-2]["score"] == 0
    by_rule = defaultdict(lambda: None, {0: 1, 1: 0, 2: 0})
    train = [(u.encode(), by_rule[i % 5]) for i, u in enumerate(urls) if by_rule[i % 5] is not None and zlib.crc32(u.encode()) % url_filter.FOLDS]
    models = plain_models(train)
    assert sum(len(m[0]) for m in models) > 1 << 18
    for i in range(0, len(urls), 13):
        assert math.isclose(got[i]["score"], plain_score(models, urls[i].encode()), rel_tol=1e-9, abs_tol=1e-12)

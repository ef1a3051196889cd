"""The whole pipeline against a plain version over the smallest data."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.test_brute_force import ASCII_LOWER, SF, words


def without_near_copies(texts):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in texts.items() if (w := words(t))}
    label = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    while any(label[i] != label[j] for i, j in links):
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    return {i: t for i, t in texts.items() if label.get(i, i) == i}


def without_repeats(texts):
    raw = {i: t.encode() for i, t in texts.items()}
    seen = Counter(b[k : k + 200] for b in raw.values() for k in range(len(b) - 199))
    out = {}
    for i, b in raw.items():
        keep = np.ones(len(b), bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                keep[k : k + 200] = False
        out[i] = np.frombuffer(b, np.uint8)[keep].tobytes().decode("utf-8", "ignore")
    return {i: t for i, t in out.items() if t}


def without_benchmark(texts, benchmark):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = set()
    for t in benchmark:
        w = word.findall(t.translate(ASCII_LOWER))
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9) if w else 0)}
    sizes = {len(w) for w in windows}

    def hit(t):
        w = word.findall(t.translate(ASCII_LOWER))
        return any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    return {i: t for i, t in texts.items() if not hit(t)}


def test_run(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    benchmark = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # every text of these data has letters and one of the languages learned
    texts = {i: t for i, t in texts.items() if t and re.search(r"[^\W\d_]", t)}
    left = without_benchmark(without_repeats(without_near_copies(texts)), benchmark)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    want = set()
    for i, t in left.items():
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want |= {(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for x in places.values():
        x.sort()
        assert [o for o, _ in x] == [sum(n for _, n in x[:k]) for k in range(len(x))] and sum(n for _, n in x) <= 2048


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_rows_without_shingles_all_stay(spark):
    """Repeated ones too, whether or not a document with words is repeated elsewhere."""
    rows = [(1, ""), (1, ""), (2, None), (2, None), (3, "one two three four five six"), (4, "one two three four five six")]
    for more in ([], [(3, "one two three four five six"), (9, "a b c d e f g"), (9, "a b c d e f g"), (None, "x y z u v w"), (None, "x y z u v w")]):
        docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows + more], SCHEMA).repartition(3)
        kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()), key=str)
        want = [*rows[:4], rows[4], *([(9, "a b c d e f g"), (None, "x y z u v w")] if more else [])]
        assert kept == sorted(want, key=str)


def test_texts_without_letters_go_with_and_without_labels(spark):
    texts = [None, "", " ", "123 ...", "\u00b2 \u00bd \u2460 \u2167", "a word", "слово"]
    for lang in (None, "en"):
        docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, t in enumerate(texts)], SCHEMA)
        got = {r.text for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
        assert not got & set(texts[:5])
        if lang is None:
            assert got == set(texts[5:])

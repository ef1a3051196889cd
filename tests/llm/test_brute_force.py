"""Registered corpus queries against plain Python over the smallest data."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sunledger.llm import decontaminate, fingerprint, near_dedup, registry, repeats, token_files
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
ASCII_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SPACED = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: registry.QUERIES[name](spark, SF).collect()


def words(text):
    return SPACED.findall(text.translate(ASCII_LOWER))


def test_license_scan(run, texts):
    notices = {
        "mit": "Released under the MIT License.",
        "gpl": "This work is licensed under the GNU General Public License, version 3.",
        "cc-by-nc": "Licensed under CC BY-NC 4.0.",
        "apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "all-rights-reserved": "All rights reserved.",
    }
    want = {i: ",".join(sorted(k for k, v in notices.items() if v in t)) for i, t in texts.items()}
    assert {r["doc_id"]: r["families"] for r in run("op1_license_scan")} == want


def test_lm_scoring(run, texts):
    tokens = {i: [*words(t), None] for i, t in texts.items()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    one, two = Counter(), Counter()
    for i, w in tokens.items():
        if i not in held:
            one.update(w)
            two.update(zip(["<s>", *w[:-1]], w, strict=True))
    n, v = sum(one.values()), len(one)
    contexts, before = defaultdict(lambda: [0, 0, 0, 0]), Counter()
    for (a, b), c in two.items():
        contexts[a][0] += c
        contexts[a][min(c, 3)] += 1
        before[b] += 1

    def discounts(counts):
        m = Counter(min(x, 5) for x in counts)
        y = m[1] / (m[1] + 2 * m[2])
        return [0, 1 - 2 * y * m[2] / m[1], 2 - 3 * y * m[3] / m[2], 3 - 4 * y * m[4] / m[3]]

    d, e, total = discounts(two.values()), discounts(before.values()), sum(before.values())
    mass = sum(e[min(x, 3)] for x in before.values()) / total

    def p(a, b):
        low = max(before[b] - e[min(before[b], 3)], 0) / total + mass / (v + 1)
        if a not in contexts:
            return low
        s, c = contexts[a], two[a, b]
        return (max(c - d[min(c, 3)], 0) + sum(d[k] * s[k] for k in (1, 2, 3)) * low) / s[0]

    rows = run("op2_lm_scoring")
    assert len(rows) == len(texts)
    for r in rows:
        w = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (r["doc_id"] in held, len(w), n)
        assert r["n_known"] == sum(x in one for x in w)
        assert math.isclose(r["base_score"], sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(a, b)) for a, b in zip(["<s>", *w[:-1]], w, strict=True)), rel_tol=1e-5)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_language_held_out(spark, run):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in run("op3_language_id") if r["held_out"]]
    assert rows and sum(r["lang_pred"] == lang[r["doc_id"]] for r in rows) >= 0.98 * len(rows)


def test_fingerprints(run, texts):
    order = sorted(texts, reverse=True)
    rows = {r["doc_id"]: r for r in run("op4_fingerprints")}
    assert len(rows) == len(texts)
    for i, j in zip(order, order[1:] + order[:1], strict=True):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[j][:half]
        assert rows[i]["n_chars"] == len(texts[i])
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i]["fingerprint"] == plain_fingerprint(texts[i])
        assert rows[i]["edited_fingerprint"] == plain_fingerprint(edited)
        assert math.isclose(rows[i]["near_edited"], plain_likeness(rows[i]["fingerprint"], rows[i]["edited_fingerprint"]), abs_tol=1e-9)
    assert sum(r["near_edited"] > r["near_next"] for r in rows.values()) > 0.9 * len(rows)


def plain_hash(data):
    from sunledger.llm import common

    return int(common.Prefix(np.frombuffer(data, np.uint8)).ranges(np.array([0]), np.array([len(data)]))[0])


def plain_fingerprint(text):
    data = text.encode()
    rolling = [plain_hash(data[max(0, i - 6) : i + 1]) >> 20 for i in range(len(data))]
    k = max(0, math.ceil(math.log2(max(len(data), 1) / 192)))
    while k and sum((r + 1) % (3 << k) == 0 for r in rolling) < 32:
        k -= 1

    def signature(size, most):
        cuts = [i + 1 for i, r in enumerate(rolling) if (r + 1) % size == 0][: most - 1]
        ends = [0, *cuts] + ([len(data)] if (cuts or [0])[-1] < len(data) else [])
        return "".join(chr(fingerprint._ALPHABET[plain_hash(data[a:b]) & 63]) for a, b in zip(ends, ends[1:], strict=False))

    return f"{3 << k}:{signature(3 << k, 64)}:{signature(6 << k, 32)}"


def plain_likeness(x, y):
    def alike(a, b):
        run = min(7, len(a), len(b))
        if not run or not {a[i : i + run] for i in range(len(a) - run + 1)} & {b[i : i + run] for i in range(len(b) - run + 1)}:
            return 0.0
        row = [0] * (len(b) + 1)
        for c in a:
            last = 0
            for j, d in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if c == d else max(row[j], row[j - 1])
        return 2 * row[-1] / (len(a) + len(b))

    (m, a1, a2), (n, b1, b2) = x.split(":"), y.split(":")
    m, n = int(m), int(n)
    if x == y:
        return 1.0
    return max(alike(a1, b1), alike(a2, b2)) if m == n else alike(a1, b2) if m == 2 * n else alike(a2, b1) if 2 * m == n else 0.0


@pytest.fixture(scope="module")
def ids(texts):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    return {i: [*tok.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_packing(run, ids):
    rows = run("op5_best_fit_packing")
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert set(by) == set(ids)
    for i, mine in by.items():
        mine.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert len(mine) == -(-len(ids[i]) // 2048)
        assert all(r["length"] == 2048 for r in mine[1:])
        at = 0
        for r in mine:
            assert r["start"] == at and r["ids_crc32"] == crc(ids[i][at : at + r["length"]])
            at += r["length"]
        assert at == len(ids[i])
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for x in bins.values():
        x.sort()
        assert [o for o, _ in x] == [sum(n for _, n in x[:k]) for k in range(len(x))]
        assert sum(n for _, n in x) <= 2048
    # sequential best-fit-decreasing
    gaps = []
    for n in sorted((r["length"] for r in rows), reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((2048 if fit is None else fit) - n)
    assert len(bins) == len(gaps)


def test_suffix_dedup(run, texts):
    seen = Counter()
    raw = {i: t.encode() for i, t in texts.items()}
    for b in raw.values():
        seen.update(b[k : k + 200] for k in range(len(b) - 199))
    for r in run("op6_suffix_dedup"):
        b = raw.pop(r["doc_id"])
        covered = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                covered[k : k + 200] = True
        spans = int((covered[:-1] & ~np.concatenate([[False], covered[:-2]])).sum()) if b else 0
        kept = np.frombuffer(b, np.uint8)[~covered[:-1]].tobytes()
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest())
    assert not raw


def test_cover():
    assert {(a - b) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER} == set(range(repeats.PERIOD))


def test_token_files(run, ids):
    start = 0
    rows = {r["doc_id"]: r for r in run("op7_token_files")}
    for i in sorted(ids):
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids[i]), crc(ids[i]))
        start += len(ids[i])


def test_elias_fano():
    rng = np.random.default_rng(7)
    for n, u in ((1, 1), (5, 3), (1000, 10), (1000, 10**6), (20_000, 10**12), (3, 2**40)):
        values = np.sort(rng.integers(0, u, n))
        ef = token_files.EliasFano.of(values)
        assert (ef.select(np.arange(n)) == values).all()
        some = rng.permutation(n)[:7]
        assert (ef.select(some) == values[some]).all()
        assert ef.bits() <= n * (3 + max(0, math.ceil(math.log2(max(u / n, 1))))) + 32


def test_decontamination(spark, run, texts):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = defaultdict(set)
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = word.findall(r["text"].translate(ASCII_LOWER))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(str(r["item_id"]))
    sizes = {len(w) for w in windows}
    for r in run("op8_decontamination"):
        w = word.findall(texts[r["doc_id"]].translate(ASCII_LOWER))
        hit, items = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    items |= found
                    hit.update(range(k, k + n))
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (len(w), len(hit), len(items), sha, bool(hit))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a0 x b0 y c0"), (2, "a0 b0 c0"), (3, "a0 x x x x x b0 x x x x c0")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "a0 b0 c0")], "item_id long, text string")
    got = decontaminate.search(decontaminate.build_index(docs), bench, slop=2).collect()
    assert {r["doc_id"]: (r["items"], r["near_items"]) for r in got} == {1: ([], ["7"]), 2: (["7"], ["7"]), 3: ([], [])}


def test_near_dedup(run, texts):
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := words(t)) else frozenset() for i, t in texts.items()}
    label = {i: i for i in sets}
    changed = True
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != label[j]
            label[i] = label[j] = low
    rows = run("op9_near_dedup")
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {(i, len(s), label[i], label[i] == i) for i, s in sets.items()}


def test_near_dedup_with_passages(spark):
    """Many documents that share a passage, but not enough, next to a group of near copies of which few are alike to the first."""
    rng = np.random.default_rng(3)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"d{i}w{k}" for k in range(60)])) for i in range(200)]
    base = [f"b{i}" for i in range(200)]
    for i in range(200, 320):
        copy = list(base)
        for at in rng.choice(200, 3, replace=False):
            copy[at] = f"e{i}x{at}"
        rows.append((i, " ".join(copy)))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    label = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    for _ in range(len(sets)):
        before = dict(label)
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    assert {r["doc_id"]: r["component_id"] for r in got} == label


def test_urls_are_judged_by_the_longest_rule(spark, run):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = run("op10_url_filter")
    assert len(rows) == len(urls)
    for r in rows:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", urls[r["page_id"]] or "")
        host, path = (m[1].translate(ASCII_LOWER), m[2]) if m else ("", "")
        fits = []
        for kind, rule in registry.URL_RULES:
            name, _, rest = rule.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
                fits.append((len(rule), rule, kind))
        best = max(fits, default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best[1] if best else None)
        assert r["verdict"] in (("allow", "block") if best is None else (best[2],))

"""Operator 10: URL filter by rules and, beyond them, by the ratio of two character language models.

A model is a variable-order Markov model over the bytes of a URL: orders 0 to ``ORDER``, each interpolated with the next
shorter one by Witten-Bell weights.  A gram's name holds its order, context and byte whole, so counts are exact.  A block of
URLs sends its distinct grams, with how often each class has them, to buckets of their contexts; a bucket adds up and
answers.  The decision is the difference of mean log-likelihoods per byte against a threshold calibrated on a fold left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.llm import common
from sunledger.llm.blocks import Blocks, total_bytes
from sunledger.llm.language_model import _batch, _buckets, _narrow, _widened

ORDER = 5
FOLDS = 5
#: Bytes of URLs in a block, and for each bucket.
BLOCK_BYTES, BUCKET_BYTES = 1 << 19, 1 << 20
#: Scores are counted in bins of this width, from -BINS to BINS of them, to find the threshold.
BIN, BINS = 0.002, 4000

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (of equal length the first in order of text), else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: (len(r[1]), r[1]), reverse=False):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def _grams(data: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, the gram of each byte: the order, nine bits for each byte before it (0 before the start) and for it."""
    at = np.arange(len(data)) - np.repeat(ends[:-1], np.diff(ends))
    byte = data.astype(np.uint64) + np.uint64(1)
    before = np.zeros(len(data), np.uint64)
    for k in range(ORDER + 1):
        if k:
            prior = np.zeros(len(data), np.uint64)
            prior[k:] = byte[:-k]
            prior[at < k] = 0
            before |= prior << np.uint64(9 * (k - 1))
        yield np.uint64(k << 56) | before << np.uint64(9) | byte


class Asked:
    """Distinct grams of a block in the order of their buckets, and for each order and byte the place of its gram."""

    def __init__(self, row: dict, buckets: int):
        self.data, self.ends = np.frombuffer(row["data"], np.uint8), np.array(row["ends"], np.int64)
        found = [np.unique(g, return_inverse=True) for g in _grams(self.data, self.ends)]
        grams = np.concatenate([g for g, _ in found])
        bucket = _buckets(common.mix(grams >> np.uint64(9)), buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        first = np.cumsum([0, *[len(g) for g, _ in found]])
        self.grams, self.place = grams[order], [place[at + back] for (_, back), at in zip(found, first, strict=False)]
        self.edges = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()


def _asked(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked = Asked(row, buckets)
                kinds = np.array([-1 if x["c4"] is None or x["c5"] or x["absent"] else x["c4"] == "allow" for x in row["rows"]], np.int64)
                of = np.repeat(kinds, np.diff(asked.ends))
                counts = [sum(np.bincount(p[of == k], minlength=len(asked.grams)) for p in asked.place) for k in (0, 1)]
                rows = [(b, row["block"], hi - lo, asked.grams[lo:hi].tobytes(), [_narrow(n[lo:hi]) for n in counts]) for b, (lo, hi) in enumerate(zip(asked.edges[:-1], asked.edges[1:], strict=True)) if lo < hi]
                yield _batch(rows, "bucket block n grams counts", (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary())))

    return run


def _answered(table: pa.Table) -> pa.Table:
    """To each block, of its grams by class: counts, and counts and distinct followers of their contexts."""
    table = table.sort_by("block").combine_chunks()
    sizes = table.column("n").to_numpy()
    ends = np.cumsum([0, *sizes])
    grams, back = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), "<u8") for x in table.column("grams")]), return_inverse=True)
    context = grams >> np.uint64(9)
    of = np.cumsum(np.concatenate([[False], context[1:] != context[:-1]]))
    answers, counts = [], table.column("counts").to_pylist()
    for k in (0, 1):
        n = np.bincount(back, np.concatenate([_widened(c[k], m) for c, m in zip(counts, sizes.tolist(), strict=True)]), len(grams)).astype(np.int64)
        answers += [n, np.bincount(of, n).astype(np.int64)[of], np.bincount(of, n > 0).astype(np.int64)[of]]
    bucket = table.column("bucket")[0].as_py()
    rows = [(b, bucket, hi - lo, [_narrow(a[back[lo:hi]]) for a in answers]) for b, lo, hi in zip(table.column("block").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return pa.Table.from_batches([_batch(rows, "block bucket n counts", (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.binary())))])


def _scored(buckets: int, names: Sequence[str]):
    """Mean log-likelihood of each row's bytes as accepted, less that as rejected; 0 for an empty row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = batch.schema.field("rows").type.value_type
            for row in batch.to_pylist():
                asked, logs = Asked(row, buckets), []
                mine = sorted(row["answers"] or [], key=lambda a: a["bucket"])
                for k in (0, 1) if mine else ():
                    n, seen, kinds = (np.concatenate([_widened(a["counts"][i], a["n"]) for a in mine]) for i in range(3 * k, 3 * k + 3))
                    p = np.full(len(asked.data), 1 / 256)
                    for at in asked.place:
                        whole = (seen + kinds)[at]
                        p = np.where(whole > 0, (n[at] + kinds[at] * p) / np.maximum(whole, 1), p)
                    logs.append(np.log(np.maximum(p, 1e-12)))
                lengths = np.diff(asked.ends)
                of = np.repeat(np.arange(len(lengths)), lengths)
                scores = np.bincount(of, logs[1] - logs[0] if logs else None, minlength=len(lengths)) / np.maximum(lengths, 1)
                kept = {name: pa.array([x[f"c{i}"] for x in row["rows"]], fields.field(f"c{i}").type) for i, name in enumerate(names)}
                yield common.batch_of(kept | {"score": scores})

    return run


def _threshold(scored: DataFrame) -> float:
    """The score at which the mean of both classes' accuracy on the left-out fold is best (0 without rows of both classes)."""
    bins = (
        scored.where("left_out and by_rule is not null")
        .groupBy((F.col("by_rule") == "allow").alias("accepted"), F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("score") / BIN))).cast("int").alias("bin"))
        .agg(F.count("*").alias("n")).collect()  # at most 2 * (2 * BINS + 1) rows
    )
    held = np.zeros((2, 2 * BINS + 2))
    for r in bins:
        held[int(r["accepted"]), r["bin"] + BINS] += r["n"]
    if not held.sum(1).all():
        return 0.0
    # a row is accepted from the threshold's bin on
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(held, 1)], 1)
    accuracy = below[0] / below[0, -1] + 1 - below[1] / below[1, -1]
    best = np.flatnonzero(accuracy == accuracy.max())
    return float((best[len(best) // 2] - BINS) * BIN)


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every page.

    What the rules decide trains the models, which judge the rest: ``allow`` from the threshold on.  URLs of one in ``FOLDS``
    calibrate the threshold.  A null or empty URL has empty host and path, fits no rule and scores 0.  Without any row
    decided by a rule all scores are 0, so all is allowed.
    """
    stage = common.Stage(pages.sparkSession)
    urls = common.keyed(pages, "page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    names = ("page_id", "host", "path", "rule", "by_rule", "left_out")
    left_out = F.coalesce(F.crc32("url") % FOLDS == 0, F.lit(False))
    ruled = urls.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"), left_out.alias("left_out"), F.col("url").alias("text"))
    blocks = Blocks(ruled, stage, BLOCK_BYTES)
    buckets = max(blocks.n, total_bytes(blocks.frame) // BUCKET_BYTES)
    asked = blocks.frame.mapInArrow(_asked(buckets), "bucket int, block long, n long, grams binary, counts array<binary>")
    answers = asked.groupBy("bucket").applyInArrow(_answered, "block long, bucket int, n long, counts array<binary>")
    by_block = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "counts")).alias("answers"))
    schema = ruled.drop("text").withColumn("score", F.lit(0.0)).schema
    scored = stage.save(blocks.met(by_block, "rows").mapInArrow(_scored(buckets, names), schema), "scored")
    by_model = F.when(F.col("score") >= _threshold(scored), "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "score")

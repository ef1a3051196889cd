"""Operator 9: near-duplicates by fast similarity sketching, banding and exact verification.

A sketch has ``BANDS * BAND`` coordinates.  In round i every shingle goes to one hashed coordinate with the value i plus a
hashed fraction; a coordinate keeps its least value, and rounds go on until all are filled (after as many rounds as
coordinates, round by round one coordinate takes all shingles).  So a set of n shingles needs about n + t log t steps, every
coordinate is filled, and the share of equal coordinates of two sets is concentrated about their similarity.

Equal sets are one class.  Classes that agree on a band share a bucket; links are confirmed on full sets.  In a bucket all
are compared with its least class first, so a large group of copies takes as many comparisons as it has members.  Classes
that buckets join are a family.  Only families that then still hold several components (as of copies edited more and more,
or of documents that share a passage) are compared pair by pair, in blocks: a task holds some hundred sets, takes pairs of
different components whose coordinates are alike enough, and gives back nothing but the links that join components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm import common
from sunledger.llm.components import components

WIDTH = 5
#: A pair of similarity 0.75 shares no band of 38 with a probability of 5e-7.
BANDS, BAND = 38, 4
COORDINATES = BANDS * BAND
#: Per cent of the union.
SIMILAR = 75
#: Members compared with one copy of a representative's set in a task.
SALTED = 400
#: Members and bytes of a family that a block of pairs takes from either side, about.
SIDE, SIDE_BYTES = 1000, 16 << 20
#: Equal coordinates for a pair to be confirmed; one of similarity 0.75 has fewer with a probability of 1e-6.
ALIKE = 88

_BITS = np.uint64(48)
#: Bits of a coordinate's fraction; those above hold the round, up to 2 * COORDINATES.
_FRACTION = np.uint64(54)
_ALL = np.uint64((1 << 64) - 1)


def sets_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 5-word shingles of each row (hashes of 48 bits, ascending), their row ends, and exact set sizes."""
    words, rows = common.hashed_words(data, ends)
    h, stop = common.shingles(words, rows, WIDTH)
    n = len(ends) - 1
    row = np.repeat(np.arange(n, dtype=np.uint64), np.diff(stop))
    sizes = np.array([len(np.unique(h))]) if n == 1 else None  # one very long row: all 64 bits
    keys = np.sort(row << _BITS | h >> np.uint64(16))
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    ends = np.searchsorted(keys, np.arange(n + 1, dtype=np.uint64) << _BITS) if n < 1 << 16 else None
    return keys & np.uint64((1 << 48) - 1), ends, np.diff(ends) if sizes is None else sizes


def sketches(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of coordinates for each set; those of empty sets stay unfilled."""
    n, t = len(ends) - 1, COORDINATES
    out = np.full(n * t, _ALL, np.uint64)
    row = np.repeat(np.arange(n), np.diff(ends))
    h = common.mix(sets)
    for i in range(2 * t):
        x = common.mix(h + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        bins = ((x >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else i - t
        np.minimum.at(out, row * t + bins, np.uint64(i) << _FRACTION | x & (np.uint64(1) << _FRACTION) - np.uint64(1))
        open_rows = (out.reshape(n, t) == _ALL).any(1)
        mine = open_rows[row]
        if not mine.any():
            break
        if not mine.all():
            row, h = row[mine], h[mine]
    return out.reshape(n, t)


def bands(sketch: np.ndarray) -> np.ndarray:
    """A hash for each band and row."""
    parts = sketch.reshape(len(sketch), BANDS, BAND)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sketch), BANDS))
    for k in range(BAND):
        h = common.mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return h


def _chunks(batches: Iterator[pa.RecordBatch]):
    for some, data, ends in common.chunks(batches):
        for lo in range(0, some.num_rows, 1 << 15):
            hi = min(lo + (1 << 15), some.num_rows)
            yield some.slice(lo, hi - lo), data[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo]


def _classes_of(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[np.uint64(0)], np.cumsum(common.mix(sets ^ np.uint64(0x5DEECE66D)))])
    return common.mix(sums[ends[1:]] - sums[ends[:-1]]).view(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some, data, ends in _chunks(batches):
        sets, stop, sizes = sets_of(data, ends)
        sketch = sketches(sets, stop)
        b = bands(sketch).view(np.int64)
        codes = pa.array([c.tobytes() for c in (sketch & np.uint64(255)).astype(np.uint8)], pa.binary())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1) * BANDS, pa.int32()), pa.array(b.ravel()))
        yield common.batch_of({"doc_id": some.column("doc_id"), "text_hash": some.column("text_hash"), "n_shingles": sizes, "node": _classes_of(sets, stop), "bands": lists, "codes": codes})


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some, data, ends in _chunks(batches):
        sets, stop, _ = sets_of(data, ends)
        raw = sets.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        yield common.batch_of({"node": some.column("node"), "shingles": pa.array([raw[a:b].tobytes() for a, b in zip(stop[:-1].tolist(), stop[1:].tolist(), strict=True)], pa.binary())})


def unpacked(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view("<u8").ravel()


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets (ascending) are linked."""
    if 100 * min(len(x), len(y)) < SIMILAR * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]))
    inter = int((both[1:] == both[:-1]).sum())
    return 100 * inter >= SIMILAR * (len(both) - inter)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by representative, its own set first."""
    held, own = None, None
    for batch in batches:
        a, b = [], []
        for rep, salt, node, raw in zip(*(batch.column(c) for c in ("rep", "salt", "node", "shingles")), strict=True):
            rep, salt, node = rep.as_py(), salt.as_py(), node.as_py()
            if node is None:
                held, own = (rep, salt), unpacked(raw.as_buffer())
            elif (rep, salt) == held:
                if similar(own, unpacked(raw.as_buffer())):
                    a.append(node)
                    b.append(rep)
        yield common.batch_of({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` among pairs ``node, rep`` whose full sets are similar enough.

    The members of a representative are dealt out to as many copies of its set as their number needs.
    """
    salts = pairs.groupBy("rep").agg(F.ceil(F.count("*") / SALTED).cast("int").alias("salts"))
    owns = salts.join(sets.withColumnRenamed("node", "rep"), "rep").select("rep", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("node"), "shingles")
    members = pairs.join(salts, "rep").select("rep", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), "node").join(sets, "node").select("rep", "salt", "node", "shingles")
    n = common.partitions(pairs.sparkSession)
    rows = owns.unionByName(members).repartition(n, "rep", "salt").sortWithinPartitions("rep", "salt", F.asc_nulls_first("node"))
    return rows.mapInArrow(_confirmed, "a long, b long")


def _block_links(rows: pa.Table, i: int, j: int) -> pa.RecordBatch:
    """Links between components of a block, each pair of them joined once."""
    node, c, side = (rows.column(x).to_numpy() for x in ("node", "c", "side"))
    codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(-1, COORDINATES)
    sets = [unpacked(x) for x in rows.column("shingles").to_pylist()]
    left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
    root = {x: x for x in np.unique(c).tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    a, b = [], []
    for lo in range(0, len(left), 32):
        mine = left[lo : lo + 32]
        same = np.stack([(codes[k] == codes[right]).sum(1, dtype=np.int16) for k in mine])
        same[c[mine][:, None] == c[right][None, :]] = 0
        at, to = np.nonzero(same >= ALIKE)
        order = np.lexsort((-same[at, to], at))
        for x, y in zip(mine[at[order]].tolist(), right[to[order]].tolist(), strict=True):
            m, n = find(c[x]), find(c[y])
            if m != n and similar(sets[x], sets[y]):
                root[m] = n
                a.append(node[x])
                b.append(node[y])
    return common.batch_of({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block; each block's rows are few."""
    held, key = [], None
    for batch in batches:
        family, i, j = (batch.column(x).to_numpy() for x in ("family", "i", "j"))
        cuts = np.flatnonzero((np.diff(family) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(family)], strict=True):
            if lo < hi:
                now = (family[lo], i[lo], j[lo])
                if held and now != key:
                    yield _block_links(pa.Table.from_batches(held).combine_chunks(), *key[1:])
                    held = []
                key = now
                held.append(batch.slice(lo, hi - lo))
    if held:
        yield _block_links(pa.Table.from_batches(held).combine_chunks(), *key[1:])


def across(families: DataFrame, found: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` between different components of one family.

    A large family is split in sides, and each pair of sides is a block of its own; a member goes to all blocks of its side.
    """
    rows = families.join(found, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component").join(sets, "node")
    sides = F.ceil(F.greatest(F.count("*") / SIDE, F.sum(F.length("shingles")) / SIDE_BYTES)).cast("int").alias("sides")
    several = rows.groupBy("family").agg(F.min("c").alias("least"), F.max("c").alias("most"), sides).where("least < most").select("family", "sides")
    rows = rows.join(several, "family").withColumn("side", F.pmod(F.xxhash64("node"), F.col("sides")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    rows = rows.select("family", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "c", "codes", "shingles")
    rows = rows.repartition(common.partitions(families.sparkSession), "family", "i", "j").sortWithinPartitions("family", "i", "j")
    return rows.mapInArrow(_across, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, group_id, component_id, kept`` of every row.

    ``group_id`` numbers the components of rows with shingles, by a hash; ``text_hash`` is ``xxhash64`` of the text.  Rows without words (or with a null text) have no shingles and are linked with nothing.  Rows with a null ``doc_id`` take
    part; their component's id is the smallest that is not null, or null.  Rows may share a ``doc_id``.
    """
    spark = common.shipped(docs.sparkSession)
    stage = common.Stage(spark)
    texts = common.keyed(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    rows = stage.save(texts.mapInArrow(_sketched, "doc_id long, text_hash long, n_shingles long, node long, bands array<long>, codes binary"), "rows", "snappy")
    filled = rows.where("n_shingles > 0")
    classes = filled.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min_by("text_hash", F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("text_hash"), F.first("bands").alias("bands"), F.first("codes").alias("codes"))
    classes = stage.save(classes, "classes", "snappy")
    members = classes.select("node", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("rep"), F.max("node").alias("top")).where("rep < top").select("bucket", "rep")
    shared = stage.save(members.join(shared, "bucket"), "shared")

    involved = shared.select("node").distinct().join(classes.select("node", "doc_id", "text_hash"), "node")
    some = texts.alias("t").join(involved.alias("i"), F.col("t.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("t.text_hash") == F.col("i.text_hash"))).select("i.node", "t.text")
    sets = stage.save(some.mapInArrow(_packed, "node long, shingles binary").dropDuplicates(["node"]), "sets", "snappy")

    pairs = stage.save(shared.where("node <> rep").select("node", "rep").distinct(), "pairs")
    links = stage.save(confirm(pairs, sets), "links")
    stage.release()
    found = components(links, stage, "components")
    families = components(pairs.select(F.col("node").alias("a"), F.col("rep").alias("b")), stage, "families").withColumnRenamed("component", "family")
    more = stage.save(across(families, found, sets.join(classes.select("node", "codes"), "node")), "more-links")
    stage.release()
    if not more.isEmpty():
        found = components(links.unionByName(more), stage, "all-components")

    labels = classes.select("node", "doc_id").join(found, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    least = labels.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = labels.join(least, "component").select("node", F.col("component").alias("group_id"), "component_id")
    out = filled.drop("bands", "codes").join(by_node, "node").select("doc_id", "text_hash", "n_shingles", "group_id", "component_id")
    alone = rows.where("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.lit(None).cast("long").alias("group_id"), F.col("doc_id").alias("component_id"))
    out = out.unionByName(alone)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest ``doc_id`` (null last, then by text hash).

    Of rows with shingles that agree in ``doc_id`` and text one stays.  Rows without shingles (null, empty or blank texts) all
    stay, repeated ones too, whatever else the table holds.  Texts may be of any length; an empty table stays empty.
    """
    stage = common.Stage(docs.sparkSession)
    near = stage.save(near_duplicates(docs).select("doc_id", "text_hash", "group_id"), "near")
    grouped = near.where("group_id is not null")
    first = grouped.groupBy("group_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("least"))
    first = first.select("least.doc_id", "least.text_hash").distinct()
    again = grouped.groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash")

    def chosen(rows: DataFrame) -> DataFrame:
        """Rows of ``docs`` with one of these ids and text hashes."""
        keep = rows.select(F.col("doc_id").alias("k"), F.col("text_hash").alias("h"))
        return docs.join(keep, keep["k"].eqNullSafe(docs["doc_id"]) & (keep["h"] == F.xxhash64(docs["text"])), "left_semi")

    def among(rows: DataFrame, others: DataFrame, how: str) -> DataFrame:
        o = others.select(F.col("doc_id").alias("k"), F.col("text_hash").alias("h"))
        return rows.join(o, o["k"].eqNullSafe(rows["doc_id"]) & (o["h"] == rows["text_hash"]), how)

    alone = near.where("group_id is null").select("doc_id", "text_hash").distinct()
    if again.isEmpty():  # nothing to drop below
        return chosen(first.unionByName(alone))
    once = chosen(among(first, again, "left_anti").unionByName(alone))
    return once.unionByName(chosen(among(first, again, "left_semi")).dropDuplicates(["doc_id", "text"]))

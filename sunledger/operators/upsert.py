"""Merging incoming rows into stored ones by key.

Plain Parquet has no MERGE, so a merge is a full outer join on the key with one
rule per column.  Keys are unique on both sides, hence no join key is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.functions.numeric import POWER, half_away
from sunledger.sources.scratch import remove, scratch_dir
from sunledger.sources.versioned import Manifest, VersionedTable, values_of

Rule = Callable[[Column, Column], Column]


def to_power(x: Column) -> Column:
    """Double to a stored power, half a thousandth away from zero."""
    return half_away(x, 3).cast(POWER)


def _halfway(old: Column, new: Column) -> Column:
    return to_power((old + new).cast("double") / F.lit(2.0))


def replace(old: Column, new: Column) -> Column:
    """The incoming value wins."""
    return new


def mean_unless_zero(old: Column, new: Column) -> Column:
    """A stored 0 is replaced, any other value meets the incoming one halfway.

    Not idempotent: each replay halves the distance to the incoming value.
    """
    return F.when(old == 0, new).otherwise(_halfway(old, new))


def raise_only(old: Column, new: Column) -> Column:
    """Like :func:`mean_unless_zero`, but a larger stored value stays."""
    return F.when(old == 0, new).when(old < new, _halfway(old, new)).otherwise(old)


def keep_first(old: Column, new: Column) -> Column:
    """Only gaps are filled."""
    return F.coalesce(old, new)


RULES: dict[str, Rule] = {
    "replace": replace,
    "mean_unless_zero": mean_unless_zero,
    "raise_only": raise_only,
    "keep_first": keep_first,
}


def merge(
    stored: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Stored rows with incoming ones merged in; both sides unique per key.

    ``rules`` names a rule for each incoming column; other columns of a new row
    take their value from ``defaults`` or stay NULL.
    """
    types = {f.name: f.dataType for f in stored.schema}
    old = stored.select(*keys, F.struct(*[c for c in stored.columns if c not in keys]).alias("__old"))
    new = incoming.select(*keys, F.struct(*[F.col(c).cast(types[c]).alias(c) for c in rules]).alias("__new"))
    both = old.join(new, list(keys), "full")
    is_old, is_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    cols = []
    for c in stored.columns:
        if c in keys:
            cols.append(F.col(c))
            continue
        was = F.col("__old")[c]
        if c in rules:
            comes = F.col("__new")[c]
            value = F.when(is_old & is_new, RULES[rules[c]](was, comes)).when(is_new, comes).otherwise(was)
        else:
            fresh = F.lit((defaults or {}).get(c)).cast(types[c])
            value = F.when(is_old, was).otherwise(fresh)
        cols.append(value.cast(types[c]).alias(c))
    return both.select(*cols)


def insert_if_absent(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows plus those incoming ones whose key is new (columns matched by name).

    Of several incoming rows with one key, the smallest row goes in.
    """
    cols = stored.columns
    rest = [c for c in cols if c not in keys]
    typed = incoming.select(*[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in cols])
    one = typed.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r")).select(*keys, "__r.*")
    return stored.unionByName(one.join(stored.select(*keys), list(keys), "left_anti").select(*cols))


#: Partitions of one delivery that are named in the filter; a history of more is bounded by its first and last one.
NAMED_PARTITIONS = 400


def only_partitions(table: DataFrame, fresh: DataFrame, partition: str) -> DataFrame:
    """The partitions of ``table`` that ``fresh`` touches, as literals, so that no other one is opened."""
    touched = [r[0] for r in fresh.select(partition).distinct().limit(NAMED_PARTITIONS + 1).collect()]
    if len(touched) <= NAMED_PARTITIONS:
        return table.where(F.col(partition).isin(touched)) if touched else table.where("false")
    low, high = fresh.agg(F.min(partition), F.max(partition)).head()
    return table.where(F.col(partition).between(low, high)).join(fresh.select(partition).distinct(), partition, "left_semi")


def stage_merge(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, str],
    partition: str,
    partition_value: Column,
    schema: str,
    defaults: Mapping[str, object] | None = None,
    work_dir: str | None = None,
) -> str:
    """Merge into a copy of the partitions of a Parquet table that change; gives its place.

    ``schema`` declares the table's columns, which an empty table could not tell.
    Both the incoming rows and the result are written to the shared scratch folder,
    so what is read is never overwritten and a lost executor reads files again.
    """
    landed = f"{scratch_dir(spark, work_dir)}/incoming"
    incoming.withColumn(partition, partition_value).write.parquet(landed)
    fresh = spark.read.parquet(landed)
    table = spark.read.schema(f"{schema}, {partition} string").parquet(path)
    stored = only_partitions(table, fresh, partition)
    merged = merge(stored.drop(partition), fresh.drop(partition), keys, rules, defaults)
    staged = f"{scratch_dir(spark, work_dir)}/merged"
    merged.withColumn(partition, partition_value).write.partitionBy(partition).parquet(staged)
    remove(spark, landed)
    return staged


def publish(spark: SparkSession, staged: str, path: str, partition: str, keys: Sequence[str]) -> None:
    """Replace the partitions of ``path`` found in ``staged``; may be repeated after a failure.

    Rebalancing splits a large partition over tasks and packs small ones, and each
    file is sorted, so that filters on the keys skip pages.
    """
    (
        spark.read.parquet(staged)
        .hint("rebalance", partition)
        .sortWithinPartitions(partition, *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def merge_into_parquet(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, str],
    partition: str,
    partition_value: Column,
    schema: str,
    defaults: Mapping[str, object] | None = None,
    work_dir: str | None = None,
) -> None:
    """Merge into a Parquet table, rewriting only the partitions that change; what was staged is removed afterwards."""
    staged = stage_merge(spark, path, incoming, keys, rules, partition, partition_value, schema, defaults, work_dir)
    publish(spark, staged, path, partition, keys)
    remove(spark, staged)


def merge_into(
    table: VersionedTable,
    incoming: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, str],
    partition_value: Column,
    defaults: Mapping[str, object] | None = None,
    work_dir: str | None = None,
) -> Manifest:
    """Merge into a versioned table: only the partitions that change are read and written, and all change in one step.

    A reader sees the table before or after the merge.  If another writer has changed one of these partitions in the
    meantime, the merge starts again from what that one left.  After a failure the table is as before.
    """
    spark, name = table.spark, table.partition
    landed = f"{scratch_dir(spark, work_dir)}/incoming"
    incoming.withColumn(name, partition_value).write.parquet(landed)
    fresh = spark.read.parquet(landed)

    def change(state: Manifest) -> Manifest:
        touched = values_of(fresh, name, NAMED_PARTITIONS)
        touched = sorted(state.parts) if touched is None else touched
        stored = table.read(state, touched)
        merged = merge(stored.drop(name), fresh.drop(name), keys, rules, defaults)
        return table.replace(merged.withColumn(name, partition_value), touched, state, sort=keys)

    done = table.retried(change)
    remove(spark, landed)
    return done

"""Pairs of entities with similar vectors, by random projections and exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeline.runtime import lookup, materialize

# Vectors compared with each other in one step; buckets with more are cut into blocks.
BUCKET_ROWS = 2000
# A block takes several steps, so that there are about GROUPS blocks in a bucket, as far as its vectors stay within
# BLOCK_BYTES: each vector is copied once for every block that its own one meets.
GROUPS = 16
BLOCK_BYTES = 16_000_000
# Tables of projections at most, so that a vector is copied so often at most.
MAX_TABLES = 48
# The chance that a pair at the threshold meets in no table.
MISS = 1e-4


def plan_tables(n: int, threshold: float, bucket_rows: int, miss: float = MISS, max_tables: int = MAX_TABLES) -> tuple[int, int]:
    """(bits, tables): as many signs of projections as bring buckets to size, with tables enough for the chance `miss`.

    Two vectors at an angle a have the same sign with a chance of 1 - a / pi. Bits that
    would take more than `max_tables` tables are left out, and so are those that would have
    more pairs compared than no bits at all; buckets are larger then.
    """
    same = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    best = (0, 1)
    for bits in range(1, max(0, math.ceil(math.log2(max(n, 1) / bucket_rows))) + 1):
        hit = same**bits
        tables = 1 if hit >= 1 else math.ceil(math.log(miss) / math.log1p(-hit)) if hit > 0 else max_tables + 1
        if tables > max_tables:
            break
        if tables < 2**bits:
            best = (bits, tables)
    return best


def sound_vectors(df: DataFrame, id: Column, vector: str) -> DataFrame:
    """(entity, v) of rows with an id and a vector with a direction: no null or non-finite parts, not zero."""
    rows = df.select(id.cast("string").alias("entity"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("entity").isNotNull() & F.col("v").isNotNull()).filter(finite & F.exists("v", lambda x: x != 0))


def distinct_vectors(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(vid, entity, v) with the smallest entity of each distinct vector, (entity, same_as) of the others, and how many there are."""
    keyed, seen = materialize(rows.distinct().withColumn("key", F.struct(F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g"))))
    firsts = keyed.groupBy("key").agg(F.min(F.struct("entity", "v")).alias("first"))
    firsts = firsts.select("key", "first.entity", "first.v").withColumn("vid", F.monotonically_increasing_id())
    firsts, counted = materialize(firsts)
    named = firsts.select("key", F.col("entity").alias("same_as"))
    copies = lookup(keyed.select("entity", "key"), "key", named, by=F.col("entity"), rows=seen["rows"], how="inner")
    return firsts.drop("key"), copies.filter("entity <> same_as").select("entity", "same_as"), counted["rows"]


def _buckets(vectors: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(dims, table, bucket, vid, entity, v): every vector in one bucket of each table."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        weights = 1 << np.arange(bits)
        for batch in batches:
            lengths = batch.column("v").value_lengths().to_numpy()
            for dims in np.unique(lengths).tolist():
                some = batch.take(pa.array(np.flatnonzero(lengths == dims)))
                matrix = some.column("v").flatten().to_numpy().reshape(-1, dims)
                for table in range(tables):
                    if (table, dims) not in planes:
                        planes[table, dims] = np.random.default_rng((seed, table)).normal(size=(dims, bits))
                    bucket = ((matrix @ planes[table, dims]) > 0) @ weights if bits else np.zeros(len(matrix))
                    columns = [
                        pa.array(np.full(len(matrix), dims, np.int32)),
                        pa.array(np.full(len(matrix), table, np.int32)),
                        pa.array(bucket.astype(np.int64)),
                        some.column("vid"),
                        some.column("entity"),
                        some.column("v"),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["dims", "table", "bucket", "vid", "entity", "v"])

    kinds = "dims int, table int, bucket long, vid long, entity string, v array<double>"
    return vectors.select("vid", "entity", "v").mapInArrow(project, kinds)


def similar_vectors(
    vectors: DataFrame, n: int, threshold: float, bucket_rows: int = BUCKET_ROWS, max_tables: int = MAX_TABLES, seed: int = 11
) -> DataFrame:
    """(a, b, cosine) with a < b: pairs of vid whose vectors reach the threshold, each once."""
    named = vectors.withColumn("entity", F.lit(None).cast("string"))
    return similar_entities(named, n, threshold, bucket_rows, max_tables, seed).select("a", "b", "cosine")


def similar_entities(
    vectors: DataFrame, n: int, threshold: float, bucket_rows: int = BUCKET_ROWS, max_tables: int = MAX_TABLES, seed: int = 11
) -> DataFrame:
    """(a, b, one, two, cosine) with a < b: pairs of vid whose vectors reach the threshold, with their entities, each once.

    A pair at the threshold is missed with a chance of MISS at most, nearer ones less;
    with one bucket none is. Buckets above `bucket_rows` are cut into blocks, every two of which meet in
    a group of their own, so no task holds more than two blocks. With one bucket for all, pairs are handed on
    as they are found; otherwise those of several tables are made distinct.
    """
    bits, tables = plan_tables(n, threshold, bucket_rows, max_tables=max_tables)
    rows = _buckets(vectors, bits, tables, seed) if bits else vectors.select(
        F.size("v").alias("dims"), F.lit(0).alias("table"), F.lit(0).cast("long").alias("bucket"), "vid", "entity", "v"
    )
    if bits:
        rows, _ = materialize(rows)
    where = ["dims", "table", "bucket"]
    most = F.greatest(F.lit(bucket_rows), F.least(F.count(F.lit(1)) / F.lit(GROUPS), F.lit(BLOCK_BYTES) / (8 * F.col("dims"))))
    sizes = rows.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("blocks"))
    # At most 2^bits * tables buckets for each length, of bucket_rows rows on average.
    rows = rows.join(F.broadcast(sizes), where).withColumn("block", F.pmod(F.xxhash64("vid"), "blocks").cast("int"))
    rows = rows.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("block", "met"), "high": F.greatest("block", "met")})
    names = ["a", "b", "one", "two", "cosine"]

    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        vid, block = table.column("vid").to_numpy(), table.column("block").to_numpy()
        entity = table.column("entity").combine_chunks()
        raw = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(vid), -1)
        norms = np.sqrt((raw * raw).sum(axis=1))
        unit = raw / norms[:, None]
        low, high = key[3].as_py(), key[4].as_py()
        one, two = np.flatnonzero(block == low), np.flatnonzero(block == high)
        for x in range(0, len(one), bucket_rows):
            for y in range(x if low == high else 0, len(two), bucket_rows):
                left, right = one[x : x + bucket_rows], two[y : y + bucket_rows]
                i, j = np.nonzero(unit[left] @ unit[right].T >= threshold - 1e-9)
                i, j = left[i], right[j]
                keep = i < j if low == high else np.ones(len(i), bool)
                i, j = i[keep], j[keep]
                cosine = np.einsum("ij,ij->i", raw[i], raw[j]) / (norms[i] * norms[j])
                i, j, cosine = i[cosine >= threshold], j[cosine >= threshold], cosine[cosine >= threshold]
                turned = vid[i] > vid[j]
                i, j = np.where(turned, j, i), np.where(turned, i, j)
                columns = [pa.array(vid[i]), pa.array(vid[j]), entity.take(pa.array(i)), entity.take(pa.array(j)), pa.array(cosine)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    found = rows.groupBy(*where, "low", "high").applyInArrow(compare, "a long, b long, one string, two string, cosine double")
    if not bits:
        return found
    return found.groupBy("a", "b").agg(*[F.max(c).alias(c) for c in names[2:]])

"""Sharding by jump consistent hashing, in DataFrame functions alone.

A stable key is mapped to one of ``shards`` buckets without a ring table
(Lamping and Veach): a 64-bit linear congruential sequence seeded by the key
names the bucket that the key jumps to next as buckets are appended; the last
one below ``shards`` is its shard. Appending a shard moves rows only into that
shard, 1 / (shards + 1) of them.

The sequence needs products modulo 2**64, which Spark's integers refuse as
overflow, so a state is three limbs of 24, 20 and 20 bits whose products stay
below 2**49. The key's text is hashed by MD5 first, so that neighbouring ids
start far apart.

Slots number a shard's rows from 0 in the order of doc_id, then text checksum,
size and row number. No task holds a shard: rows are range-partitioned on
(shard, doc_id, checksum, size, row number), so a large shard is many chunks
and even one doc_id with a third of all rows is cut by the row number; counts
by (shard, chunk) give the rows before each chunk, and rows are numbered within
a chunk. What is shuffled holds a few numbers a row, never a text, and is
written, so that a lost executor cannot renumber rows.

The law is ``key``: doc_id and the shard count decide, so copies of a text
under several ids are spread like any rows.

Cases: a null doc_id is hashed as the empty text and comes first in its shard;
a null text has no bytes (size 8, checksum 0). Repeated rows take neighbouring
slots. With one shard everything is in shard 0. Extra columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.llm.common import Scratch, table

SHARDS = 24
#: Fixed value: the multiplier of the published generator.
MULTIPLIER = 2862933555777941757
LOW, HIGH = 24, 20
_M0, _M1, _M2 = MULTIPLIER % (1 << LOW), (MULTIPLIER >> LOW) % (1 << HIGH), MULTIPLIER >> (LOW + HIGH)


def _low_bits(c: Column, bits: int) -> Column:
    return c.bitwiseAND(F.lit((1 << bits) - 1))


def _advance(a: Column, b: Column, c: Column) -> tuple[Column, Column, Column]:
    """Limbs of (a + b * 2**24 + c * 2**44) * MULTIPLIER + 1 modulo 2**64."""
    low = a * F.lit(_M0) + 1
    middle = a * F.lit(_M1) + b * F.lit(_M0) + F.shiftright(low, LOW)
    high = a * F.lit(_M2) + c * F.lit(_M0) + b * F.lit(_M1 << (LOW - HIGH)) + F.shiftright(middle, HIGH)
    return _low_bits(low, LOW), _low_bits(middle, HIGH), _low_bits(high, HIGH)


def jump_shard(key: Column, shards: int) -> Column:
    """struct(shard, grown): the key's bucket among ``shards`` and among one more."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 16)
    limb = lambda start, n: F.conv(F.substring(digits, start, n), 16, 10).cast("long")
    start = F.struct(limb(11, 6).alias("a"), limb(6, 5).alias("b"), limb(1, 5).alias("c"),
                     F.lit(0).cast("long").alias("jump"), F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"))

    def step(s: Column, _: Column) -> Column:
        a, b, c = _advance(s.a, s.b, s.c)
        draw = F.shiftleft(c, 31 - HIGH) + F.shiftright(b, 33 - LOW)  # the state's top 31 bits
        jump = F.floor((s.jump + 1) * (F.lit(float(1 << 31)) / (draw + 1))).cast("long")
        moved = F.struct(a.alias("a"), b.alias("b"), c.alias("c"), jump.alias("jump"),
                         F.when(s.jump < shards, s.jump).otherwise(s.shard).alias("shard"), s.jump.alias("grown"))
        return F.when(s.jump <= shards, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step,
                       lambda s: F.struct(s.shard.cast("int").alias("shard"), s.grown.cast("int").alias("grown")))


def number_rows(scratch: Scratch, rows: DataFrame, group: str, order: list[str], name: str = "slot") -> DataFrame:
    """``rows`` with a gapless number from 0 within ``group``, in the order of ``order`` and then any fixed one."""
    chunked = scratch.keep(scratch.keep(rows.withColumn("_row", F.monotonically_increasing_id()))
                           .repartitionByRange(group, *order, "_row").withColumn("_chunk", F.spark_partition_id()))
    before = (chunked.groupBy(group, "_chunk").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy(group).orderBy("_chunk")) - F.col("_n")).drop("_n"))
    place = F.row_number().over(Window.partitionBy(group, "_chunk").orderBy(*order, "_row"))
    return (chunked.withColumn("_place", place).join(before, [group, "_chunk"])
            .withColumn(name, F.col("_before") + F.col("_place") - 1).drop("_row", "_chunk", "_place", "_before"))


def assign(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    if shards < 1:
        raise ValueError("at least one shard")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 8).cast("long").alias("size"),
                             F.crc32(raw).alias("text_crc32"), jump_shard(F.col("doc_id"), shards).alias("to"))
            .select("doc_id", "size", "text_crc32", "to.shard", F.col("to.grown").alias("grown_shard")))
    numbered = number_rows(Scratch(documents.sparkSession), rows, "shard", ["doc_id", "text_crc32", "size"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(documents: DataFrame, path: str, key: str = "doc_id", shards: int = SHARDS, files_per_shard: int = 1) -> None:
    """Write the rows as Parquet folders ``shard=0..``; ``files_per_shard`` tasks share a shard by a hash of the row.

    Size it so that a file stays within a task (about 256 MB of text each). A
    column called shard is replaced.
    """
    salt = F.pmod(F.xxhash64(*documents.columns), F.lit(files_per_shard))
    (documents.withColumn("shard", jump_shard(F.col(key), shards).shard)
     .repartition(shards * files_per_shard, "shard", salt).write.partitionBy("shard").parquet(path))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place among 24 shards."""
    return assign(table(spark, sf_dir, "documents"))


#: The checksum is folded over the bytes with the standard reflected polynomial.
SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS v FROM range(256) r(i)) x),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)),
      lambda c, x: xor(c // 256, crc.t[xor(c, x) % 256 + 1]), 4294967295), 4294967295) AS text_crc32,
    CAST('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 16) AS UBIGINT) AS start
  FROM documents, crc),
j AS (
  SELECT doc_id, size, text_crc32, start, CAST(start AS UHUGEINT) AS s, 0::BIGINT AS jump, 0::BIGINT AS shard, 0::BIGINT AS grown, 0 AS i FROM d
  UNION ALL
  SELECT doc_id, size, text_crc32, start, n, CAST(floor((jump + 1)::DOUBLE * (2147483648::DOUBLE / CAST((n // 8589934592) + 1 AS DOUBLE))) AS BIGINT),
    CASE WHEN jump < {SHARDS} THEN jump ELSE shard END, jump, i + 1
  FROM (SELECT *, (s * {MULTIPLIER}::UHUGEINT + 1::UHUGEINT) % 18446744073709551616::UHUGEINT AS n FROM j WHERE jump <= {SHARDS}) x)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard
FROM j WHERE jump > {SHARDS}
"""

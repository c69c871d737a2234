"""Sharding by extendible hashing, DataFrame operations only.

A row's hash is the first 60 bits of the MD5 of its key.  The directory starts
as one bucket (prefix of no bits); a bucket above the byte limit splits on the
next bit, and only such buckets split, until every shard fits.

The splitting is done on sums, not on rows.  One pass over the table leaves a
narrow table (key, bytes, hash).  Per round, the rows still in an oversized bucket
are summed by the next ``STEP`` bits, every ancestor's size follows from those cell
sums, and a cell's bucket is the shortest prefix that fits.  Cells that don't
fit even at the end of a round go to the next one.  A hash has even bits, so a
round divides the bytes of a bucket by 2^STEP; 100 TB at 1 MiB a shard take two.

Equal rows share every bit, so no hash can part them.  They are counted as one
class (which is also what keeps a row repeated millions of times off one task),
and a class above the limit at the last bit is cut into shards by copy number.
A single row above the limit is a shard of its own.

Edge cases: a null text has 0 bytes; a null key hashes as the empty string;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.llm.common import require, stored

HASH_BITS = 60
STEP = 12
SHARD_BYTES = 1 << 20


def key_bits(key: Column) -> Column:
    """60 bits of the key's MD5 as a string of 0 and 1, most significant first."""
    half = [F.lpad(F.conv(F.substring(F.md5(key), a, 7), 16, 2), 28, "0") for a in (1, 8)]
    return F.concat(half[0], half[1], F.lpad(F.conv(F.substring(F.md5(key), 15, 1), 16, 2), 4, "0"))


def _cells(rows: DataFrame, known: int) -> DataFrame:
    """Bucket of every cell of ``known + STEP`` bits, or none where it doesn't fit yet.

    ``rows`` hold (bits, size) of buckets that are oversized at ``known`` bits.
    """
    upto = known + STEP
    cells = rows.groupBy(F.substring("bits", 1, upto).alias("cell")).agg(
        F.sum("size").alias("cell_bytes"))
    depths = F.explode(F.sequence(F.lit(known), F.lit(upto))).alias("depth")
    prefix = F.substring("cell", F.lit(1), F.col("depth"))
    sized = cells.select("cell", "cell_bytes", depths).withColumn("prefix", prefix)
    return sized.groupBy("prefix").agg(F.sum("cell_bytes").alias("prefix_bytes"))


def _place(rows: DataFrame, sizes: DataFrame, known: int, limit: int) -> DataFrame:
    """Shortest fitting prefix per cell of the rows."""
    upto = known + STEP
    cells = rows.select(F.substring("bits", 1, upto).alias("cell")).distinct()
    depths = F.explode(F.sequence(F.lit(known), F.lit(upto))).alias("depth")
    walked = cells.select("cell", depths).withColumn(
        "prefix", F.substring("cell", F.lit(1), F.col("depth")))
    fit = walked.join(sizes.filter(F.col("prefix_bytes") <= limit), "prefix")
    best = fit.groupBy("cell").agg(F.min(F.struct("depth", "prefix", "prefix_bytes")).alias("b"))
    return cells.join(best, "cell", "left").select("cell", "b.*")


def extendible_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      limit: int = SHARD_BYTES) -> DataFrame:
    """Shard of every row: id, n_bytes, shard (bit prefix), depth, shard_bytes."""
    require(docs, id_col, text_col)
    key = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("_id"),
                         F.coalesce(F.octet_length(F.col(text_col)), F.lit(0))
                         .cast("long").alias("n_bytes"))
    classes = stored(narrow.groupBy("_id", "n_bytes").agg(F.count(F.lit(1)).alias("copies"))
                     .withColumns({"bits": key_bits(key),
                                   "size": F.col("n_bytes") * F.col("copies")}), "shard-rows")
    done, rest, known = [], classes, 0
    while known < HASH_BITS:
        sizes = stored(_cells(rest, known), "shard-sizes")
        cells = stored(_place(rest, sizes, known, limit), "shard-directory")
        placed = stored(rest.withColumn("cell", F.substring("bits", 1, known + STEP))
                        .join(cells, "cell").drop("cell"), "shard-placed")
        done.append(placed.filter(F.col("depth").isNotNull()))
        rest = placed.filter(F.col("depth").isNull()).drop("depth", "prefix", "prefix_bytes")
        known += STEP
        if rest.isEmpty():
            break
    else:
        done.append(_by_copies(rest, limit))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    # equal rows are interchangeable: give each copy its row back
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        F.col("_id").alias(id_col), "n_bytes", F.col("prefix").alias("shard"), "depth",
        F.col("prefix_bytes").alias("shard_bytes"))


def _by_copies(rest: DataFrame, limit: int) -> DataFrame:
    """Rows that share all bits and don't fit: cut the copies of each row into shards.

    Different rows with one 60-bit hash are told apart by id and size.
    """
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.lit(1), F.col("n_bytes"))))
    parts = F.ceil(F.col("copies") / per).cast("long")
    cut = rest.withColumns({"_per": per, "_part": F.explode(F.sequence(F.lit(0), parts - 1))})
    copies = F.least(F.col("_per"), F.col("copies") - F.col("_part") * F.col("_per"))
    name = F.concat_ws("-", "bits", F.col("n_bytes").cast("string"), F.col("_part").cast("string"))
    return cut.withColumns({"copies": copies.cast("long"), "depth": F.lit(HASH_BITS),
                            "prefix": name}).withColumns(
        {"size": F.col("n_bytes") * F.col("copies"),
         "prefix_bytes": F.col("n_bytes") * F.col("copies")}).drop("_per", "_part")


# The same directory in SQL: sizes of all prefixes up to 24 bits (small tables).
ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
         md5(CAST(doc_id AS VARCHAR)) AS m FROM documents),
b AS (
  SELECT doc_id, n_bytes, lpad(bin(('0x' || substr(m, 1, 6))::BIGINT), 24, '0') AS bits FROM d),
s AS (
  SELECT left(bits, depth::INT) AS prefix, depth, sum(n_bytes)::BIGINT AS prefix_bytes
  FROM b, range(0, 25) AS r(depth) GROUP BY ALL),
f AS (
  SELECT b.doc_id, b.n_bytes, min(s.depth) AS depth
  FROM b JOIN s ON left(b.bits, s.depth::INT) = s.prefix AND s.prefix_bytes <= {SHARD_BYTES}
  GROUP BY ALL)
SELECT f.doc_id, f.n_bytes, s.prefix AS shard, f.depth::INTEGER AS depth,
       s.prefix_bytes AS shard_bytes
FROM f JOIN b USING (doc_id) JOIN s ON s.depth = f.depth AND s.prefix = left(b.bits, f.depth::INT)
"""

"""Sharding by extendible hashing, in DataFrame operations only.

Documents hash to bit strings. The directory maps prefixes of those bits to
shards: a shard starts as the empty prefix, and one that holds more bytes than
the limit splits on its next bit, until every shard fits. Only oversized
buckets go deeper, so the prefixes differ in length.

A round reads some bits at once: documents are folded to sums per prefix, the
sums are rolled up to all shorter prefixes, and each shard is the shortest
prefix that fits. Buckets still too large after a round's bits take the next
round's bits. The bits of a document are those of its id's hash and then those
of its row's, so repeated rows and null ids, which share the first, part on the
second. A document larger than the limit gets a shard of its own, marked
oversize.

Null texts have no bytes. An empty table has no shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolens.llm.common import fresh, materialize, materialize_observed, table

LIMIT = 64 << 20  # bytes of UTF-8 text in a shard
ID_BITS = 60  # of the id's hash
ROW_BITS = 48  # of the row's hash
ROUND_BITS = 8  # that the first round reads beyond the expected depth
LATER_BITS = 16  # that a later round reads, of the buckets still too large


def id_bits(doc_id: Column) -> Column:
    """The leading 60 bits of the id's MD5."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, 1, ID_BITS // 4), 16, 10).cast("long")


def _slice(high: Column, low: Column, start: int, width: int) -> Column:
    """Bits ``start`` to ``start + width`` of the 60 bits of ``high`` and the 48 of ``low``."""
    out = None
    for word, size, at in ((high, ID_BITS, 0), (low, ROW_BITS, ID_BITS)):
        first, last = max(start, at), min(start + width, at + size)
        if first >= last:
            continue
        part = F.shiftright(word, at + size - last).bitwiseAND(F.lit((1 << (last - first)) - 1))
        out = part if out is None else F.shiftleft(out, last - first).bitwiseOR(part)
    return out


def _bits(value: Column, width: Column | int) -> Column:
    """``value`` in binary, ``width`` digits; the empty string for width 0."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.when(width == 0, F.lit("")).otherwise(F.lpad(F.bin(value), width, "0"))


def assign_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    row: Column | None = None,
) -> DataFrame:
    """One row per document: its ``row`` number (given, or taken in scan order),
    ``id``, ``n_bytes``, ``shard`` (its prefix in binary), ``depth``,
    ``shard_bytes``, ``shard_docs`` and ``oversize``."""
    row = F.monotonically_increasing_id() if row is None else row
    rows, seen = materialize_observed(
        docs.select(
            row.alias("row"),
            F.col(f"`{id_col}`").alias("id"),
            F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long").alias("n_bytes"),
            id_bits(F.col(f"`{id_col}`")).alias("high"),
            F.shiftrightunsigned(F.xxhash64(row), 64 - ROW_BITS).alias("low"),
        ),
        "shard-rows",
        {"bytes": F.sum("n_bytes")},
    )
    expected = max(0, ((seen["bytes"] or 0) // limit).bit_length())
    done, start, width = None, 0, expected + ROUND_BITS
    todo = rows.withColumn("parent", F.lit(""))
    while True:
        width = min(width, ID_BITS + ROW_BITS - start)
        last = start + width == ID_BITS + ROW_BITS
        leaf = todo.withColumn("leaf", _slice(F.col("high"), F.col("low"), start, width))
        # The directory: a row per prefix, its size bound by the corpus over the limit and not by a key's rows.
        leaves = materialize(
            leaf.groupBy("parent", "leaf").agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs")),
            "shard-leaves",
        )
        nodes = (
            leaves.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(width))))
            .withColumn("prefix", F.call_function("shiftright", F.col("leaf"), F.lit(width) - F.col("depth")))
            .groupBy("parent", "depth", "prefix")
            .agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
            .filter((F.col("bytes") <= limit) | (F.col("docs") == 1) | (F.lit(last) & (F.col("depth") == width)))
        )
        ancestors = leaves.select(
            "parent", "leaf", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("depth")
        ).withColumn("prefix", F.call_function("shiftright", F.col("leaf"), F.lit(width) - F.col("depth")))
        shards = (
            ancestors.join(nodes, ["parent", "depth", "prefix"])
            .groupBy("parent", "leaf")
            .agg(F.min(F.struct("depth", "prefix", "bytes", "docs")).alias("shard"))
        )
        placed = leaf.join(materialize(shards, "shard-directory"), ["parent", "leaf"], "left")
        placed, seen = materialize_observed(placed, "shard-placed", {"left": F.count_if(F.col("shard").isNull())})
        fits = placed.filter("shard IS NOT NULL").select(
            "row",
            "id",
            "n_bytes",
            F.concat("parent", _bits(F.col("shard.prefix"), F.col("shard.depth"))).alias("shard"),
            (F.col("shard.depth") + F.lit(start)).alias("depth"),
            F.col("shard.bytes").alias("shard_bytes"),
            F.col("shard.docs").alias("shard_docs"),
            (F.col("shard.bytes") > limit).alias("oversize"),
        )
        done = fits if done is None else done.unionByName(fits)
        if not seen["left"]:
            return done
        todo = placed.filter("shard IS NULL").select(
            "row", "id", "n_bytes", "high", "low", F.concat("parent", _bits(F.col("leaf"), width)).alias("parent")
        )
        start, width = start + width, LATER_BITS


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> None:
    """Write ``docs`` under ``path``, one folder ``shard=<prefix>`` per shard."""
    row, shard = fresh(docs, "__row", "shard")
    held = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "shard-docs")
    shards = assign_shards(held, id_col, text_col, limit, F.col(row))
    name = F.concat(F.lit("p"), F.col("shard")).alias(shard)
    placed = held.join(shards.select(F.col("row").alias(row), name), row).drop(row)
    placed.repartition(shard).write.partitionBy(shard).parquet(path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard at 64 MiB of text a shard."""
    return assign_shards(table(spark, sf_dir, "documents")).drop("row").withColumnRenamed("id", "doc_id")


def oracle_sql(limit: int = LIMIT, depth: int = 24) -> str:
    """The directory in DuckDB SQL for shards of at most ``depth`` bits."""
    return f"""
WITH hashed AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, {ID_BITS // 4}) AS BIGINT) AS h
  FROM documents
), nodes AS (
  SELECT d.depth, h >> ({ID_BITS} - d.depth) AS prefix, sum(n_bytes) AS bytes, count(*) AS docs
  FROM hashed, (SELECT unnest(range({depth + 1})) AS depth) d
  GROUP BY ALL
  HAVING sum(n_bytes) <= {limit} OR count(*) = 1
), placed AS (
  SELECT h.doc_id, h.n_bytes, n.*,
         row_number() OVER (PARTITION BY h.doc_id ORDER BY n.depth) AS k
  FROM hashed h JOIN nodes n ON h.h >> ({ID_BITS} - n.depth) = n.prefix
)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INT, '0') END AS shard,
       depth::INT AS depth, bytes::BIGINT AS shard_bytes, docs AS shard_docs, bytes > {limit} AS oversize
FROM placed WHERE k = 1
"""

"""SimHash near-duplicates by deletion-variant signatures.

A document's fingerprint has a bit set where over half of its shingle hashes
have it set. Fingerprints that differ in at most k bits are linked. Cut into
k // 2 + 1 segments, two such fingerprints have one segment that differs by at
most one bit, so they agree on that segment or on the segment with that one bit
wild. Every distinct fingerprint is indexed under each segment and each
one-wildcard variant of it; equal keys are candidates, verified on all bits.

Copies of a fingerprint meet first, so a key holds different fingerprints only.
A wildcard key counts only where its members differ in the wild bit (else the
segment's own key has them). Keys of two fingerprints are settled by their
minimum and maximum; larger ones send their members to tasks, in pairs of
blocks where there are very many, which return a spanning forest of the links
and never the pairs themselves. Components are then found on those edges.

Null and empty texts have fingerprint zero. Repeated rows are documents of
their own. A null id is never the smallest of its component unless all are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.common import (
    connected_components,
    fresh,
    lean,
    materialize,
    materialize_observed,
    slices,
    sorted_runs,
    table,
    tasks_for,
    with_fields,
)

SHINGLE = 3
DISTANCE = 3
SEED = 42
BITS = 64
BLOCK = 20_000  # fingerprints of one key that a task compares with each other or with another block


def fingerprint(text: bytes | None, shingle: int, seed: int) -> int:
    """The 64-bit fingerprint of the A-Z-lowered words of ``text``, as a signed integer."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    hash_of = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [hash_of(joined, seed)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends[:-shingle]]
        hashes = [hash_of(joined[a : b - 1], seed) for a, b in zip(starts, ends[shingle - 1 :])]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(np.array(hashes[at : at + (1 << 15)], "<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(
    docs: DataFrame, text_col: str, name: str = "fingerprint", shingle: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """``docs`` without its text column, with the fingerprint of the whole text as a long."""
    rest = [c for c in docs.columns if c != text_col]
    schema = with_fields(docs.select(*[F.col(f"`{c}`") for c in rest]).schema, [(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(len(rest))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints, pa.int64())], names=schema.names)

    text = F.col(f"`{text_col}`").cast("binary").alias("__text")
    return docs.select(*[F.col(f"`{c}`") for c in rest], text).mapInArrow(lean(run), schema)


def segment_widths(distance: int) -> list[int]:
    """Widths of the segments of which one differs by at most one bit."""
    parts = distance // 2 + 1
    return [BITS // parts + (i < BITS % parts) for i in range(parts)]


def variants(prints: DataFrame, distance: int) -> DataFrame:
    """``(code, value, bit, fp)``: every segment of every fingerprint, whole
    (``bit`` null) and with each of its bits wild (``bit`` is what it was)."""
    lows, codes, at = [], [], 0
    for width in segment_widths(distance):
        lows.append((at, width))
        codes.append(width + 1)
        at += width
    fp, code = F.col("fp"), F.col("code")

    def piecewise(values: list) -> Column:
        edge, out = 0, None
        for size, value in zip(codes, values):
            edge += size
            out = F.when(code < edge, value) if out is None else out.when(code < edge, value)
        return out

    first = piecewise([sum(codes[:i]) for i in range(len(codes))])
    low = piecewise([F.lit(a) for a, _ in lows])
    mask = piecewise([F.lit((1 << w) - 1 if w < BITS else -1).cast("long") for _, w in lows])
    wild = code - first  # 0: the whole segment
    exploded = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(sum(codes) - 1))).alias("code"))
    segment = F.call_function("shiftrightunsigned", fp, low).bitwiseAND(mask)
    shifted = exploded.withColumns({"segment": segment, "wild": wild})
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("wild") - 1)
    whole = F.col("wild") == 0
    return shifted.select(
        code.cast("short").alias("code"),
        F.when(whole, F.col("segment")).otherwise(F.col("segment").bitwiseAND(F.bitwise_not(one))).alias("value"),
        F.when(~whole, F.col("segment").bitwiseAND(one) != 0).alias("bit"),
        "fp",
    )


def spanning_links(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints (signed).

    A fingerprint that is reached leaves the rest, so dense groups take a pass
    per few members and no pair is listed twice.
    """
    rest, edges = prints.astype(np.int64).view(np.uint64), []  # bits of a negative number count as they stand
    while rest.size > 1:
        front, rest = [rest[0]], rest[1:]
        while front and rest.size:
            one = front.pop()
            near = np.bitwise_count(rest ^ one) <= distance
            if near.any():
                found = rest[near]
                edges.extend((int(one.view(np.int64)), f) for f in found.view(np.int64).tolist())
                front.extend(found)
                rest = rest[~near]
    return edges


def links(prints: DataFrame, distance: int = DISTANCE, block: int = BLOCK, rows: int | None = None) -> DataFrame:
    """Edges ``(u, v)`` that connect exactly the fingerprints ``fp`` (distinct
    rows) which chains of at most ``distance`` differing bits connect. ``rows``
    is the number of fingerprints, or more: it sizes the tasks."""
    index = variants(prints, distance)
    each = sum(w + 1 for w in segment_widths(distance))
    sized = lambda df: df if rows is None else df.coalesce(tasks_for(each * rows))
    keys = index.groupBy("code", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("fp").alias("u"),
        F.max("fp").alias("v"),
        F.min("bit").alias("low"),
        F.max("bit").alias("high"),
    )
    # A key of one fingerprint, or a wildcard key without both bits, links nothing of its own.
    keys = sized(keys.filter("n > 1 AND (low IS NULL OR low <> high)").drop("low", "high"))
    keys = materialize(keys, "simhash-keys")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    pairs = keys.filter("n = 2").filter(close).select("u", "v")

    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    large = keys.filter("n > 2").select("code", "value", blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    members = (
        index.join(large, ["code", "value"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("code", "value", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
            "fp",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple[int, int]] = []
        for group in sorted_runs(batches, "task"):
            edges.extend(spanning_links(np.unique(group["fp"]), distance))
            if len(edges) > 50_000:
                yield _edge_batch(edges)
                edges = []
        if edges:
            yield _edge_batch(edges)

    dealt = sized(members.repartition("task")).sortWithinPartitions("task")
    found = dealt.mapInArrow(lean(run), "u long, v long")
    return pairs.unionByName(found)


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*edges)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def components(rows: DataFrame, n: int, distance: int, block: int) -> DataFrame:
    """``(fp, first)`` for every distinct ``fp`` of the ``n`` ``rows`` (``row``, ``id``,
    ``fp``): ``first.id`` is the smallest id of its component and ``first.row``
    the first row that has it."""
    own = F.struct(F.col("id").isNull().alias("nameless"), F.col("id"), F.col("row"))
    firsts = rows.groupBy("fp").agg(F.min(own).alias("first")).coalesce(tasks_for(n))
    firsts = materialize(firsts, "simhash-firsts")
    # one file a task: dealt anew, as every fingerprint becomes many rows
    edges = links(firsts.select("fp").repartition("fp"), distance, block, n)
    roots = connected_components(edges.coalesce(tasks_for(n)))
    linked = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = linked.groupBy("root").agg(F.min("first").alias("first"))
    return linked.select("fp", "root").join(smallest, "root").select("fp", "first")


def _fingerprinted(
    docs: DataFrame, row: Column, id_col: str, text_col: str, shingle: int, seed: int
) -> tuple[DataFrame, int]:
    """``row``, ``id`` and ``fp`` of every document, written, and their number."""
    narrow = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    printed = with_fingerprint(narrow, "text", "fp", shingle, seed)
    done, seen = materialize_observed(printed, "simhash-prints", {"n": F.count(F.lit(1))})
    return done, seen["n"]


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits) and ``component_id``."""
    rows, n = _fingerprinted(docs, F.monotonically_increasing_id(), id_col, text_col, shingle, seed)
    return rows.join(components(rows, n, distance, block), "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.id").alias("component_id"),
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest id
    (of rows that share it, the first in scan order), columns unchanged."""
    (row,) = fresh(docs, "__row")
    held = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    rows, n = _fingerprinted(held, F.col(row), id_col, text_col, shingle, seed)
    kept = components(rows, n, distance, block).groupBy("first.row").count().select("row")
    dropped = rows.select("row").join(kept, "row", "left_anti").select(F.col("row").alias(row))
    return held.join(dropped, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: fingerprints of 3-word shingles, linked at 3 or fewer differing bits."""
    return near_duplicates(table(spark, sf_dir, "documents"))

"""Mixing sources to target weights by capped water-filling.

Every source gets its weight's share of a word budget, but no more than a
maximum number of epochs of its own words. What capped sources cannot take is
shared again by weight among the others until none is above its cap. A source's
target is then met with whole repetitions of all its documents and one more of
a seeded sample: its documents in seeded order, up to the words still wanted.

Null and empty texts have size 0 and take nothing. A null source is a source of
its own and comes last. Repeated rows are documents of their own. The result
depends on the rows and the seed alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrolens.llm.common import fresh, materialize, order_totals, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5  # words of the mix per word of the corpus
EPOCHS = 2  # most often that a source's words may be taken
SEED = 42


def word_count(text: Column) -> Column:
    """Words of ``text``; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_order(doc_id: Column, seed: int) -> Column:
    """A sort key that deals documents in an order the seed decides."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def fill_level(sources: DataFrame, size: str, weight: str, share: float, epochs: float) -> tuple[float, float, float]:
    """``(level, words, weights)``: a source of weight w that is below its cap
    gets ``w * words / weights``, and ``level`` is words / weights.

    Each round clamps the sources whose cap the level reaches and shares the
    rest anew; the level only rises, so a clamped source stays clamped. A round
    is one aggregate over the sources.
    """
    cap, w = F.col(size) * F.lit(epochs), F.col(weight)
    total, weights = sources.agg(F.sum(size), F.sum(w)).first()
    words = share * (total or 0)
    level, clamped = (words / weights if weights else 0.0), 0
    left = (words, float(weights or 0))
    while True:
        full = cap <= F.lit(level) * w
        n, caps, free = sources.agg(
            F.count_if(full), F.sum(F.when(full, cap)), F.sum(F.when(~full, w))
        ).first()
        if n == clamped or not free:
            return (level, *left) if free else (float("inf"), 0.0, 1.0)
        clamped, left = n, (words - (caps or 0), float(free))
        level = left[0] / left[1]


def source_targets(
    docs: DataFrame, source: str, size: str, weights: tuple[int, ...], share: float, epochs: float
) -> DataFrame:
    """One row per source: ``source``, ``__size``, ``__before`` (words of the
    sources before it) and ``__target``."""
    sizes = docs.groupBy(source).agg(F.sum(size).alias("__size"))
    # One row per source from here on: numbered in one task and written once, as the rounds below read it again.
    in_order = Window.orderBy(F.col(source).asc_nulls_last())
    ranked = sizes.coalesce(1).select(
        source,
        "__size",
        (F.row_number().over(in_order) - 1).alias("__rank"),
        (F.sum("__size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")).alias("__before"),
    )
    ranked = materialize(ranked, "mix-sources")
    repeating = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    weighted = ranked.withColumn("__weight", repeating)
    level, words, free = fill_level(weighted, "__size", "__weight", share, epochs)
    cap = F.col("__size") * F.lit(float(epochs))
    full = cap <= F.lit(level) * F.col("__weight")
    return weighted.select(
        source,
        "__size",
        "__before",
        F.when(full, cap).otherwise(F.col("__weight") * F.lit(words) / F.lit(free)).alias("__target"),
    )


def mix_counts(
    docs: DataFrame,
    key: str,
    id_col: str,
    source_col: str,
    size: str,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """How often the mix takes each row of ``docs`` (written before the call;
    ``key`` is unique): ``key``, id, size, source size, target and ``__copies``.

    The documents of all sources are sorted once by (source, seeded order,
    key), so a source of any share is spread over many tasks; the words before
    a document in that order decide whether it gets the extra repetition.
    """
    rows = docs.select(
        F.col(f"`{key}`").alias("__key"),
        F.col(f"`{id_col}`").alias("__id"),
        F.col(f"`{source_col}`").alias("__source"),
        F.col(f"`{size}`").alias("__words"),
    ).withColumn("__order", seeded_order(F.col("__id"), seed))
    targets = source_targets(rows, "__source", "__words", weights, share, epochs)
    targets = targets.withColumnRenamed("__source", "__of").withColumnRenamed("__before", "__base")
    ranked = order_totals(
        rows, [F.col("__source").asc_nulls_last(), F.col("__order"), F.col("__key")], "__words", "__rank", "__before"
    )
    joined = ranked.join(targets, F.col("__source").eqNullSafe(F.col("__of")))
    whole = F.when(F.col("__size") > 0, F.floor(F.col("__target") / F.col("__size"))).otherwise(F.lit(0))
    wanted = F.col("__target") - whole * F.col("__size")
    middle = F.col("__before") - F.col("__base") + F.col("__words") / F.lit(2.0)
    return joined.select(
        "__key",
        "__id",
        "__words",
        "__size",
        "__target",
        (whole + F.when(middle < wanted, F.lit(1)).otherwise(F.lit(0))).cast("int").alias("__copies"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, columns unchanged."""
    key, size = fresh(docs, "__key", "__words")
    held = materialize(
        docs.withColumn(key, F.monotonically_increasing_id()).withColumn(size, word_count(F.col(f"`{text_col}`"))),
        "mix-rows",
    )
    counts = mix_counts(held, key, id_col, source_col, size, weights, share, epochs, seed)
    (copies,) = fresh(held, "__copies")
    taken = counts.filter("__copies > 0").select(F.col("__key").alias(key), F.col("__copies").alias(copies))
    repeated = held.join(taken, key).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: how many words of each document the mix takes."""
    docs = table(spark, sf_dir, "documents")
    held = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("__key"), "doc_id", "source", word_count(F.col("text")).alias("size")
        ),
        "mix-sizes",
    )
    counts = mix_counts(held, "__key", "doc_id", "source", "size")
    return counts.select(
        F.col("__id").alias("doc_id"),
        F.col("__words").alias("size"),
        F.col("__size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__words") * F.col("__copies")).alias("taken"),
    )


def oracle_sql(seed: int = SEED) -> str:
    """The contract in DuckDB SQL: the level is found over the sources sorted by
    the level that would fill them."""
    return rf"""
WITH sized AS (
  SELECT doc_id, source, md5('{seed}:' || CAST(doc_id AS VARCHAR)) AS seeded,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source
), filled AS (
  SELECT *, 1.5 * (SELECT sum(source_size) FROM sources)::DOUBLE AS words,
         coalesce(sum(2 * source_size) OVER up, 0)::DOUBLE AS caps_before,
         sum(w) OVER ()::DOUBLE - coalesce(sum(w) OVER up, 0)::DOUBLE AS weights_left
  FROM sources
  WINDOW up AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT words - caps_before AS words_left, weights_left, (words - caps_before) / weights_left AS height
  FROM filled
  WHERE 2.0::DOUBLE * source_size > (words - caps_before) / weights_left * w
  ORDER BY caps_before, weights_left DESC LIMIT 1
), targets AS (
  SELECT s.source, s.source_size,
         CASE WHEN l.height IS NULL OR 2.0::DOUBLE * s.source_size <= l.height * s.w THEN 2.0::DOUBLE * s.source_size
              ELSE s.w * l.words_left / l.weights_left END AS target
  FROM sources s LEFT JOIN level l ON true
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.seeded
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2.0::DOUBLE AS middle
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN middle < target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

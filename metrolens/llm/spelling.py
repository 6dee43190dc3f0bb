"""Spelling variants grouped by pivotal grams.

Two words are near if one inserted, deleted or replaced letter turns one into
the other. One edit touches at most one of two bigrams that do not overlap, so
of two such bigrams of a word (its pivots) one stands in every near word. All
bigrams have one global order, the rare ones first, and a word's prefix is its
three first in that order. The pivots are chosen from the prefix, the two
rarest that do not overlap, by dynamic programming. Of two near words, the one
whose prefix ends earlier has a pivot in the other's prefix; so pivots are
looked up in an index of prefixes, never words with words.

Positions limit the lookups: the edit stands on one side of the bigram that
survives, so the other side is the same in both words, and the lengths differ
by at most one. An index key is therefore a bigram with all that stands before
it, or with all that stands behind it, and a length. Pairs that meet in a key
are verified, first by the sets of their letters, then by edit distance.

A word's form is its commonest near word, if that is at least twice as common;
roots follow the forms. Forms rise in frequency by a factor of two or more, so
chains are short and doubling their steps ends after a few joins.

All joins are sort-merge joins by hint. Their sides grow with the vocabulary,
and the planner would guess a size from files of packed words, or from a table
before each of its words became many rows, and send such a side to the driver.

Null and empty texts have no words. A null id is written as nothing before the
colon. Repeated rows count again. An empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolens.llm.common import lean, materialize, slices, table

SHORTEST = 5
LEAST = 3
FACTOR = 2
DROPPED = 97  # an occurrence loses a letter if this divides its checksum
HELD = 1 << 19  # words that a task counts before it hands them on

# Fixed value: the letters of a word once A-Z are lowered.
LETTERS = "a-zÀ-ÿ"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dropped: int | None = DROPPED) -> DataFrame:
    """``(word, n)`` over all texts: runs of letters, A-Z lowered. Where
    ``dropped`` divides the CRC-32 of ``<id>:<run>`` the run loses the letter
    that the checksum points to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[{LETTERS}]+").findall
        held: Counter = Counter()
        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = Counter(runs((text.as_py() or b"").lower().decode("utf-8", "replace")))
                if dropped:
                    start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for word in list(own):
                        h = zlib.crc32(word.encode(), start)
                        if h % dropped == 0:
                            at = h % len(word)
                            n = own.pop(word)
                            held[word[:at] + word[at + 1 :]] += n
                held.update(own)
            if len(held) > HELD:
                yield _counted(held)
                held = Counter()
        if held:
            yield _counted(held)

    narrow = docs.select(
        F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text")
    )
    counted = narrow.mapInArrow(lean(run), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
    )


def gram_order(words: DataFrame) -> dict[str, int]:
    """The rank of every bigram of the distinct ``word``s, rare ones first. At
    most the square of the number of letters: 8,100 for these."""
    at = F.explode(F.sequence(F.lit(1), F.char_length("word") - 1))
    grams = words.select("word", at.alias("at")).select(F.expr("substring(word, at, 2)").alias("gram"))
    counted = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "gram")
    return {r.gram: i for i, r in enumerate(counted.collect())}


def prefix_and_pivots(word: str, order: dict[str, int]) -> tuple[list[int], tuple[int, int], int]:
    """Positions of the prefix, positions of the two pivots, and the rank the prefix ends with.

    The prefix takes all bigrams up to the third in order, with all that tie
    with it. The pivots have the least sum of ranks of any two in the prefix
    that do not overlap: the best single bigram that ends before a position is
    carried along, and each bigram is paired with it.
    """
    ranks = [order[word[i : i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[2]
    prefix = [i for i, r in enumerate(ranks) if r <= last]
    best: tuple[int, int, int] | None = None  # sum, first, second
    left: tuple[int, int] | None = None  # the rarest of the prefix that ends before the current one
    behind = 0
    for i in prefix:
        while prefix[behind] <= i - 2:
            one = prefix[behind]
            left = (ranks[one], one) if left is None or ranks[one] < left[0] else left
            behind += 1
        if left is not None and (best is None or left[0] + ranks[i] < best[0]):
            best = (left[0] + ranks[i], left[1], i)
    return prefix, best[1:], last


def letter_set(word: str) -> int:
    """The word's letters as 64 bits (signed): an edit changes at most two."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def index_rows(words: DataFrame, order: dict[str, int], pivots: bool) -> DataFrame:
    """``(key, word, last, letters)``: one row per index key of a word. As
    prefixes a word stands under its own length, as pivots it is looked up
    under all lengths that a near word may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            rows = []
            for word in batch.column(0).to_pylist():
                prefix, chosen, last = prefix_and_pivots(word, order)
                size, letters = len(word), letter_set(word)
                for i in chosen if pivots else prefix:
                    for other in (size - 1, size, size + 1) if pivots else (size,):
                        rows.append((f"{other}<{word[: i + 2]}", word, last, letters))
                        rows.append((f"{other}>{word[i:]}", word, last, letters))
            columns = zip(*rows) if rows else ((), (), (), ())
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "word", "last", "letters"]
            )

    found = words.select("word").mapInArrow(lean(run), "key string, word string, last int, letters long")
    return found.withColumn("key", F.xxhash64("key"))  # equal hashes of other keys only make candidates that fail


def near_words(words: DataFrame) -> DataFrame:
    """Every pair ``(u, v)``, ``u < v``, of distinct ``word``s (of at least five letters) that are near."""
    order = gram_order(words)
    index = index_rows(words, order, pivots=False)
    looked = index_rows(words, order, pivots=True).toDF("key", "seeker", "ends", "marks")
    # the word whose prefix ends earlier looks the other one up
    alike = (F.col("ends") <= F.col("last")) & (F.bit_count(F.col("letters").bitwiseXOR(F.col("marks"))) <= 2)
    near = F.levenshtein("word", "seeker", 1) == 1
    pairs = index.join(looked.hint("merge"), "key").filter(alike).filter(near)
    return pairs.select(F.least("word", "seeker").alias("u"), F.greatest("word", "seeker").alias("v")).distinct()


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of every row of ``forms`` (``word``, ``form``, null at the
    end of a chain): the root of a word is looked up as its own root's root
    until none changes."""
    step = materialize(forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    while True:
        onward = step.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = step.join(onward.hint("merge"), F.col("root") == F.col("at")).select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
        moved = materialize(moved, "spelling-roots")
        step = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return step


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST,
    least: int = LEAST,
    factor: int = FACTOR,
    dropped: int | None = DROPPED,
) -> DataFrame:
    """All words of at least ``shortest`` (5 or more) letters and ``least``
    occurrences with their ``form``, ``root``, ``n``, ``n_near`` and ``form_n``."""
    if shortest < 5:
        raise ValueError("two bigrams of a prefix must not overlap: words need five letters")
    counted = word_counts(docs, id_col, text_col, dropped)
    words = materialize(counted.filter((F.char_length("word") >= shortest) & (F.col("n") >= least)), "spelling-words")
    pairs = materialize(near_words(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    common = words.select(F.col("word").alias("v"), F.col("n").alias("v_n"))
    best = (
        both.join(common.hint("merge"), "v")
        .groupBy(F.col("u").alias("word"))
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("v_n")).alias("down"), F.col("v"))).alias("best"))
    )
    enough = -F.col("best.down") >= factor * F.col("n")
    named = words.join(best.hint("merge"), "word", "left").select(
        "word",
        F.when(enough, F.col("best.v")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.down")).alias("form_n"),
    )
    named = materialize(named, "spelling-forms")
    return named.join(follow(named).hint("merge"), "word").select("word", "form", "root", "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all words with their spelling variants."""
    return variants(table(spark, sf_dir, "documents"))


def oracle_sql() -> str:
    """The contract in DuckDB SQL: CRC-32 byte by byte, near words by equal
    words with one letter masked or left out."""
    crc_table = """
WITH RECURSIVE crc_bits AS (
  SELECT b::BIGINT AS b, b::BIGINT AS c, 0 AS i FROM range(256) t(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i + 1 FROM crc_bits WHERE i < 8
), crc AS (
  SELECT list(c ORDER BY b) AS t FROM crc_bits WHERE i = 8
)"""
    return crc_table + r""", runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  GROUP BY ALL
), codes AS (
  SELECT run, n, list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: unicode(c)::BIGINT) AS cp
  FROM runs
), bytes AS (
  SELECT run, n, flatten(list_transform(cp, lambda c:
           CASE WHEN c < 128 THEN [c] ELSE [192 + (c >> 6), 128 + (c & 63)] END)) AS bytes
  FROM codes
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM bytes, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5
  GROUP BY word HAVING sum(n) >= 3
), masked AS (
  SELECT word, unnest(list_transform(range(length(word)), lambda i: word[1:i] || '*' || word[i + 2:])) AS m,
         unnest(list_transform(range(length(word)), lambda i: word[1:i] || word[i + 2:])) AS shorter
  FROM words
), near AS (
  SELECT DISTINCT a.word AS u, b.word AS v FROM masked a JOIN masked b ON a.m = b.m AND a.word <> b.word
  UNION
  SELECT DISTINCT a.word, b.word FROM masked a JOIN words b ON a.shorter = b.word
  UNION
  SELECT DISTINCT b.word, a.word FROM masked a JOIN words b ON a.shorter = b.word
), best AS (
  SELECT u, count(*) AS n_near, first(v ORDER BY w.n DESC, v) AS v, max(w.n) AS v_n
  FROM near JOIN words w ON w.word = near.v GROUP BY u
), forms AS (
  SELECT w.word, CASE WHEN b.v_n >= 2 * w.n THEN b.v END AS form, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
         CASE WHEN b.v_n >= 2 * w.n THEN b.v_n END AS form_n
  FROM words w LEFT JOIN best b ON b.u = w.word
), chain AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""

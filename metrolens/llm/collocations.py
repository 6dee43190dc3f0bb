"""Phrase collocations by partitioned frequent-phrase mining.

A phrase is two to five words that stand next to each other in one piece of a
text. Documents are dealt to a few shards by a hash of their id. Every shard is
mined completely, level by level, with the support lowered to the shard's share
of all words: a phrase that reaches the support overall reaches the lowered one
in some shard, so the union of what the shards find holds every frequent phrase.
Of these, hashes whose counts in all shards are below the support together are
dropped: all parts of a frequent phrase are frequent, so every shard has counted it.

Words are counted by themselves. A longer phrase is counted under a 64-bit hash,
made of the hash of its words but the last (its prefix) and that of the last word
so that hash and prefix give the last word's hash back. Every count carries the
prefix; where a hash has one prefix in all places of the corpus, that prefix is
such a phrase itself, and its words have hashes of their own, all places hold
the same words and the count is exact. The words of found phrases are put together
from these parts by joins, no task reads the texts for them. Phrases that share a hash
are counted once more over all documents, by their words, and the support is
applied to those counts.

A level looks at places whose shorter phrases were found in some shard. The found
hashes reach the tasks as a bit filter of fixed size at most: where it fills up it
lets more phrases through to be counted, and loses none. Counts of a shard are summed
by Spark, so a shard of any size is spread over many tasks.

Null text has no words; a null language is ``und``, in one class with that
name. Repeated rows are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrolens.llm.common import (
    STEP,
    lean,
    materialize,
    scrambled,
    slices,
    span_hashes,
    span_numbers,
    table,
    unscrambled,
    worker_cache,
)

SUPPORT = 100
LONGEST = 5
TOP = 2000
SHARDS = 4
FILTER_BITS = 1 << 26  # of the filter a level passes on: 8 MiB at most whatever the corpus
ROOM = 256  # bits that a filter keeps for each found phrase, as long as it has so many
LEAST_BITS = 1 << 20  # smaller filters are left as they are
HELD = 1 << 22  # hashes that a task counts before it hands them on, or a quarter of the bytes of phrases
JOINED = 1 << 22  # bytes of texts that are cut into words together, or four times those whose phrases are cut out
PENDING = 1 << 20  # bytes of counted phrases that wait to be summed with those of earlier texts, more only where these have more

# The characters that end a piece, and the blanks between words.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"


def byte_classes() -> bytes:
    """A table that lower-cases A-Z, writes every end as a line feed and every blank as a space."""
    letters = bytearray(range(256))
    letters[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
    for b in ENDS:
        letters[b] = 10
    for b in BLANKS:
        letters[b] = 32
    return bytes(letters)


class Words:
    """The words of a text as byte spans of its lowered form, and their hashes.

    ``last[i]`` is the number of words from word i to the end of its piece.
    """

    def __init__(self, text: bytes, seed: int = 0, block: int = 1 << 20):
        self.text = text.translate(worker_cache("byte-classes", byte_classes))
        self.raw = raw = np.frombuffer(self.text, np.uint8)
        inside = raw != 32
        inside &= raw != 10
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.starts, self.ends = edges[::2], edges[1::2]
        piece = np.cumsum(raw == 10)[self.starts] if len(self.starts) else self.starts
        edge = np.flatnonzero(np.diff(piece, append=-1))
        self.last = np.repeat(edge, np.diff(edge, prepend=-1)) - np.arange(len(piece)) + 1
        self.hashes = span_hashes(raw, self.starts, self.ends, seed, block)

    def longer(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words from those of the phrases one word shorter."""
        n = max(0, len(self.starts) - size + 1)
        return scrambled(hashes[:n] * np.uint64(STEP) + self.hashes[size - 1 :])

    def fits(self, size: int) -> np.ndarray:
        """Which words begin a phrase of ``size`` words."""
        return self.last[: max(0, len(self.starts) - size + 1)] >= size


class Filter:
    """A set of hashes as bits, a power of two of them."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(64 * len(self.bits) - 1)
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    def folded(self) -> Filter:
        """The same set in fewer bits where they are many for what it holds: its halves laid upon each other."""
        bits = self.bits
        while 64 * len(bits) > LEAST_BITS and 32 * len(bits) >= ROOM * int(np.bitwise_count(bits).sum()):
            bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
        return Filter(bits)

    @staticmethod
    def of(found: DataFrame, size: int) -> Filter:
        """The filter of the ``hash`` column: at most ``size / 64`` rows reach the driver."""
        at = F.col("hash").bitwiseAND(F.lit(size - 1))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
        words = found.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
        rows = words.toArrow()
        bits = np.zeros(size // 64, np.uint64)
        bits[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
        return Filter(bits).folded()


def shard_of(doc_id: Column, shards: int) -> Column:
    """A document's shard, decided by its id."""
    return F.pmod(F.xxhash64(doc_id), F.lit(shards)).cast("int")


def _texts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, shards: int) -> DataFrame:
    return docs.select(
        shard_of(F.col(f"`{id_col}`"), shards).alias("shard"),
        F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"),
    )


def _seed(lang: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))


def _joined(batches: Iterator[pa.RecordBatch], keys: int, upto: int) -> Iterator[tuple[tuple, bytes]]:
    """Texts of one key (the first ``keys`` columns; the text is the last one) put
    together, a line feed between them: it ends a piece, so no phrase runs on.
    Texts of all keys are held up to ``upto`` bytes, or the text that passes them."""
    held: dict[tuple, list[bytes]] = {}
    total = 0
    for batch in slices(batches):
        columns = [batch.column(i).to_pylist() for i in range(keys)]
        for key, text in zip(zip(*columns), batch.column(batch.num_columns - 1)):
            text = text.as_py()
            held.setdefault(key, []).append(text)
            total += len(text)
            if total > upto:
                yield from _together(held)
                total = 0
    yield from _together(held)


def _together(held: dict[tuple, list[bytes]]) -> Iterator[tuple[tuple, bytes]]:
    while held:
        key, texts = held.popitem()
        yield key, b"\n".join(texts)


def _places(
    words: Words, filters: list[Filter], sizes: range
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(size, hashes, prefixes, places)`` of the phrases of each size whose parts, one word shorter, all pass
    their filters; a prefix is the hash without the last word, of a single word its own."""
    hashes, good = words.hashes, np.ones(len(words.hashes), bool)
    prefixes = hashes
    for size in range(1, sizes[-1] + 1):
        if size > 1:
            prefixes = hashes
            hashes = words.longer(hashes, size)
            good = good[: len(hashes)] & good[1 : len(hashes) + 1] & words.fits(size)
        if size in sizes:
            yield size, hashes, prefixes, np.flatnonzero(good)
        if size <= len(filters):
            good = good & filters[size - 1].holds(hashes)
        if not good.any():
            return


def _counted(hashes: np.ndarray, prefixes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, prefix, n)`` of runs of equal rows in the order of the hashes; a hash has more than one if its prefixes differ."""
    order = np.argsort(hashes)
    hashes, prefixes = hashes[order], prefixes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (prefixes[1:] != prefixes[:-1])
    at = np.flatnonzero(new)
    return hashes[at], prefixes[at], np.diff(at, append=len(hashes))


def local_counts(texts: DataFrame, filters: list[Filter], sizes: range) -> DataFrame:
    """``(shard, size, hash, prefix, n)``: how often phrases of the given ``sizes`` stand in
    each shard, where all their parts pass the ``filters`` of one word, two words, ...;
    a task's counts are rows of their own, to be summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        n = 0

        def written() -> Iterator[pa.RecordBatch]:
            while held:
                (shard, size), parts = held.popitem()
                hashes, prefixes, counts = _counted(*(np.concatenate(p) for p in zip(*parts)))
                same = np.ones(len(hashes), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(same * np.int32(shard)),
                        pa.array(same * np.int32(size)),
                        pa.array(hashes.view(np.int64)),
                        pa.array(prefixes.view(np.int64)),
                        pa.array(counts, pa.int64()),
                    ],
                    names=["shard", "size", "hash", "prefix", "n"],
                )

        for (shard, lang), text in _joined(batches, 2, JOINED):
            for size, hashes, prefixes, at in _places(Words(text, _seed(lang)), filters, sizes):
                if len(at):
                    held.setdefault((shard, size), []).append((hashes[at], prefixes[at]))
                    n += len(at)
            if n > HELD:
                yield from written()
                n = 0
        yield from written()

    return texts.mapInArrow(lean(run), "shard int, size int, hash long, prefix long, n long")


def local_words(texts: DataFrame) -> DataFrame:
    """``(shard, lang, word, n)``: how often words stand in each shard, by their bytes;
    a task's counts are rows of their own, to be summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], PhraseCounts] = {}

        def written() -> Iterator[pa.RecordBatch]:
            while held:
                (shard, lang), counts = held.popitem()
                rows = counts.total()
                yield from pa.table(
                    {
                        "shard": pa.repeat(pa.scalar(shard, pa.int32()), rows.num_rows),
                        "lang": pa.repeat(pa.scalar(lang, pa.string()), rows.num_rows),
                        "word": rows.column("phrase"),
                        "n": rows.column("n"),
                    }
                ).to_batches()

        for (shard, lang), text in _joined(batches, 2, JOINED // 4):
            words = Words(text, _seed(lang))
            if len(words.starts):
                first, numbers = span_numbers(words.raw, words.starts, words.ends, words.hashes)
                spans = zip(words.starts[first].tolist(), words.ends[first].tolist())
                found = [words.text[a:b] for a, b in spans]
                held.setdefault((shard, lang), PhraseCounts()).add({"phrase": pa.array(found, pa.binary())}, np.bincount(numbers))
            if _full(held):
                yield from written()
        yield from written()

    return texts.mapInArrow(lean(run), "shard int, lang string, word binary, n long")


def with_hashes(words: DataFrame) -> DataFrame:
    """``(shard, lang, word, n)`` with the words' hashes, as texts of their language have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(1).dictionary_encode()
            langs = codes.indices.to_numpy()
            hashes = np.empty(batch.num_rows, np.uint64)
            for i, lang in enumerate(codes.dictionary.to_pylist()):
                at = np.flatnonzero(langs == i)
                spans = batch.column(2).take(pa.array(at))
                raw = np.frombuffer(b"".join(spans.to_pylist()), np.uint8)
                ends = np.cumsum(pc.binary_length(spans).to_numpy(), dtype=np.int64)
                hashes[at] = span_hashes(raw, np.append(0, ends[:-1]), ends, _seed(lang))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hashes.view(np.int64))], names=["shard", "lang", "word", "n", "hash"]
            )

    plain = words.select("shard", "lang", "word", "n")
    return plain.mapInArrow(lean(run), "shard int, lang string, word binary, n long, hash long")


def frequent_in_shards(counts: DataFrame, share: dict[int, tuple[int, int]], support: int) -> DataFrame:
    """``(size, hash, n, lo, hi)`` of the phrases that reach the support lowered to the share ``(words, of all words)``
    of some shard, and the support itself over all shards: every shard counts the same phrases. ``lo`` and ``hi`` are
    the smallest and largest of a hash's prefixes, ``n`` its places in all shards."""
    counts = counts.repartition("size", "hash")  # tasks' counts are folded already: rows before the sums are shorter
    sides = [F.min("prefix").alias("lo"), F.max("prefix").alias("hi")]
    if not share:
        return counts.groupBy("size", "hash").agg(F.sum("n").alias("n"), *sides).limit(0)
    per_shard = [F.coalesce(F.sum(F.when(F.col("shard") == one, F.col("n"))), F.lit(0)).alias(f"n{one}") for one in share]
    reached, every = F.lit(False), F.lit(0).cast("long")
    for one, (words, total) in share.items():
        n = F.col(f"n{one}").cast("decimal(38,0)") * F.lit(total).cast("decimal(19,0)")
        reached = reached | (n >= F.lit(support * words).cast("decimal(30,0)"))
        every = every + F.col(f"n{one}")
    folded = counts.groupBy("size", "hash").agg(*per_shard, *sides)
    return folded.filter(every >= support).filter(reached).select("size", "hash", every.alias("n"), "lo", "hi")


def _mined(
    texts: DataFrame, support: int, longest: int, filter_bits: int
) -> tuple[list[Filter], dict[int, int], DataFrame, list[DataFrame]]:
    """What :func:`mine` returns, all words ``(shard, lang, word, n, hash)``, and the found hashes of one word, two
    words, and more."""
    words = local_words(texts).groupBy("shard", "lang", "word").agg(F.sum("n").alias("n"))
    words = materialize(with_hashes(words), "phrase-words")
    own = dict(words.groupBy("shard").agg(F.sum("n")).collect())  # one row per shard
    share = {shard: (n, sum(own.values())) for shard, n in own.items()}
    single = words.select("shard", F.lit(1).alias("size"), "hash", F.col("hash").alias("prefix"), "n")
    found = [materialize(frequent_in_shards(single, share, support), "phrases-1")]
    filters = [Filter.of(found[0], filter_bits)]
    for sizes in [range(2, 3)] + ([range(3, longest + 1)] if longest > 2 else []):
        level = frequent_in_shards(local_counts(texts, filters, sizes), share, support)
        found.append(materialize(level, f"phrases-{sizes[0]}"))
        filters += [Filter.of(found[-1].filter(F.col("size") == size), filter_bits) for size in sizes]
    return filters[:longest], own, words, found


def mine(
    texts: DataFrame, support: int = SUPPORT, longest: int = LONGEST, filter_bits: int = FILTER_BITS
) -> tuple[list[Filter], dict[int, int]]:
    """Filters of the phrases of one word, two words, ... found in any shard, and the words of each shard."""
    return _mined(texts, support, longest, filter_bits)[:2]


def _text(word: str) -> Column:
    return F.make_valid_utf8(F.col(word).cast("string"))


def with_last(found: DataFrame) -> DataFrame:
    """``(size, hash, prefix, last, n)`` of found hashes of one prefix; ``last`` is the hash of the last word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, hashes, prefixes, n = batch.columns
            sums = unscrambled(hashes.to_numpy().view(np.uint64))
            last = sums - prefixes.to_numpy().view(np.uint64) * np.uint64(STEP)
            yield pa.RecordBatch.from_arrays(
                [size, hashes, prefixes, pa.array(last.view(np.int64)), n], names=["size", "hash", "prefix", "last", "n"]
            )

    plain = found.filter("lo = hi").select("size", "hash", "lo", "n")
    return plain.mapInArrow(run, "size int, hash long, prefix long, last long, n long")


def spelled(words: DataFrame, found: DataFrame, longest: int) -> DataFrame:
    """``(size, hash, lang, phrase, n)`` of those ``found`` phrases of two words and more that share their
    hash with no other, nor do their parts; ``words`` are ``(lang, word, hash)`` of all words that have a found hash."""
    shared = words.groupBy("hash").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    level = words.join(shared, "hash", "left_anti").select("hash", "lang", _text("word").alias("phrase"))
    last = level.select(F.col("hash").alias("last"), F.col("phrase").alias("word"))
    parts = materialize(with_last(found).join(last, "last").drop("last"), "phrase-parts")
    out = []
    for size in range(2, longest + 1):
        shorter = level.select(F.col("hash").alias("prefix"), "lang", "phrase")
        level = parts.filter(F.col("size") == size).join(shorter, "prefix")
        level = level.select("size", "hash", "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "n")
        level = materialize(level, f"spelled-{size}")
        out.append(level)
    return functools.reduce(DataFrame.unionByName, out)


def phrase_counts(
    words: Words, filters: list[Filter], wanted: list[Filter]
) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
    """``(size, phrases, hashes, counts)`` of the phrases that pass the ``wanted`` filter of their size; their parts
    pass the others."""
    if not len(words.starts):
        return
    _, own = span_numbers(words.raw, words.starts, words.ends, words.hashes)
    numbers = own
    for size, hashes, _, at in _places(words, filters, range(1, len(filters) + 1)):
        if size > 1:
            # pairs of (number of the phrase one word shorter, number of the last word) are numbered anew
            pairs = numbers[: len(hashes)] * np.int64(len(own)) + own[size - 1 :]
            _, numbers = np.unique(pairs, return_inverse=True)
        taken = at[wanted[size - 1].holds(hashes[at])]
        if not len(taken):
            continue
        _, first, n = np.unique(numbers[taken], return_index=True, return_counts=True)
        first = taken[first]
        spans = zip(words.starts[first].tolist(), words.ends[first + size - 1].tolist())
        phrases = [words.text[a:b] for a, b in spans]
        if size > 1:
            phrases = [b" ".join(p.split()) if b"  " in p else p for p in phrases]
        yield size, phrases, hashes[first], n


class PhraseCounts:
    """Counts of the phrases of a language and size, kept as arrays: a table of different
    phrases takes little more than their bytes."""

    def __init__(self) -> None:
        self.summed: pa.Table | None = None
        self.waiting: list[pa.Table] = []
        self.pending = 0

    @property
    def nbytes(self) -> int:
        return (self.summed.nbytes if self.summed else 0) + self.pending

    def add(self, columns: dict[str, pa.Array], counts: np.ndarray) -> None:
        self.waiting.append(pa.table({**columns, "n": pa.array(counts, pa.int64())}))
        self.pending += self.waiting[-1].nbytes
        if self.pending > max(PENDING, self.nbytes - self.pending) or len(self.waiting) > 256:
            self.total()

    def total(self) -> pa.Table:
        """One row for each phrase."""
        if self.waiting:
            rows = pa.concat_tables(([self.summed] if self.summed else []) + self.waiting)
            self.waiting, self.pending = [], 0
            keys = rows.column_names[:-1]
            rows = rows.group_by(keys, use_threads=False).aggregate([("n", "sum")])
            self.summed = rows.select([*keys, "n_sum"]).rename_columns([*keys, "n"])
        return self.summed


def _full(held: Mapping[tuple, PhraseCounts]) -> bool:
    """Whether counts take more room than a task may hold."""
    if len(held) > 4096:
        return True
    if sum(c.nbytes for c in held.values()) <= 4 * HELD:
        return False
    return sum(c.total().nbytes for c in held.values()) > 4 * HELD


def _as_strings(phrases: pa.ChunkedArray) -> pa.ChunkedArray:
    try:
        return phrases.cast(pa.string())
    except pa.ArrowInvalid:  # not UTF-8
        return pa.chunked_array([pa.array([p.decode("utf-8", "replace") for p in phrases.to_pylist()], pa.string())])


def phrase_rows(
    batches: Iterator[pa.RecordBatch], filters: list[Filter], wanted: list[Filter] | None = None
) -> Iterator[pa.RecordBatch]:
    """A task's ``(lang, words, phrase, hash, n)`` of batches of ``(lang, text)``, to be summed."""
    held: dict[tuple[str, int], PhraseCounts] = {}

    def written() -> Iterator[pa.RecordBatch]:
        while held:
            (lang, size), counts = held.popitem()
            rows = counts.total()
            yield from pa.table(
                {
                    "lang": pa.repeat(pa.scalar(lang, pa.string()), rows.num_rows),
                    "words": pa.repeat(pa.scalar(size, pa.int32()), rows.num_rows),
                    "phrase": _as_strings(rows.column("phrase")),
                    "hash": rows.column("hash"),
                    "n": rows.column("n"),
                }
            ).to_batches()

    for (lang,), text in _joined(batches, 1, JOINED // 4):
        words = Words(text, _seed(lang))
        none = {"phrase": pa.array([b""]), "hash": pa.array([0], pa.int64())}
        held.setdefault((lang, 0), PhraseCounts()).add(none, np.array([len(words.starts)]))
        for size, phrases, hashes, counts in phrase_counts(words, filters, wanted or filters):
            columns = {"phrase": pa.array(phrases, pa.binary()), "hash": pa.array(hashes.view(np.int64))}
            held.setdefault((lang, size), PhraseCounts()).add(columns, counts)
        if _full(held):
            yield from written()
    yield from written()


def count_phrases(texts: DataFrame, filters: list[Filter], wanted: list[Filter] | None = None) -> DataFrame:
    """``(lang, words, phrase, hash, n)``: exact counts over all documents of the phrases that pass
    the filter of their size (of ``wanted``, if given), and all words of a language with ``words`` 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return phrase_rows(batches, filters, wanted)

    schema = "lang string, words int, phrase string, hash long, n long"
    counted = texts.select("lang", "text").mapInArrow(lean(run), schema)
    return counted.groupBy("lang", "words", "phrase", "hash").agg(F.sum("n").alias("n"))


def exact_counts(
    texts: DataFrame, filters: list[Filter], words: DataFrame, found: list[DataFrame], filter_bits: int
) -> DataFrame:
    """``(lang, words, phrase, n)``: exact counts over all documents of the ``found`` words and phrases.

    Tasks hand on no row for each phrase that they meet: phrases are spelled from found hashes, and
    only those that share a hash with another are counted by their words in the texts."""
    single = words.join(found[0].select("hash"), "hash", "left_semi").groupBy("lang", "word", "hash")
    single = materialize(single.agg(F.sum("n").alias("n")), "found-words")
    rows = [single.select("lang", F.lit(1).alias("words"), _text("word").alias("phrase"), "n")]
    if len(filters) > 1:
        phrases = functools.reduce(DataFrame.unionByName, found[1:])
        known = spelled(single, phrases, len(filters))
        rows.append(known.select("lang", F.col("size").alias("words"), "phrase", "n"))
        if known.count() < phrases.count():
            left = materialize(phrases.join(known, ["size", "hash"], "left_anti").select("size", "hash"), "shared-hashes")
            wanted = [Filter.of(left.filter(F.col("size") == size), filter_bits) for size in range(1, len(filters) + 1)]
            again = count_phrases(texts, filters, wanted).withColumnRenamed("words", "size")
            again = again.join(left, ["size", "hash"], "left_semi")
            rows.append(again.select("lang", F.col("size").alias("words"), "phrase", "n"))
    return functools.reduce(DataFrame.unionByName, rows).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def collocations(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    support: int = SUPPORT,
    longest: int = LONGEST,
    shards: int = SHARDS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """All phrases of 2 to ``longest`` words with ``a >= support`` occurrences in
    their language that no longer phrase accounts for: ``lang``, ``phrase``,
    ``words``, ``a``, ``l`` and ``r`` (occurrences of the two parts of the cut
    that explains the phrase best), ``n`` (words of the language) and ``score``."""
    texts = _texts(docs, id_col, text_col, lang_col, shards)
    filters, _, every, levels = _mined(texts, support, longest, filter_bits)
    found = materialize(exact_counts(texts, filters, every, levels, filter_bits).filter(F.col("n") >= support), "phrase-counts")
    # one row per language
    sizes = every.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("total"))
    split = F.split("phrase", " ")
    phrases = found.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))

    part = found.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("n").alias("f"))

    def frequency(df: DataFrame, text: str, name: str) -> DataFrame:
        right = part.withColumnRenamed("f", name)
        return df.join(right, (F.col("lang") == F.col("of")) & (F.col(text) == F.col("part"))).drop("of", "part")

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumns(
        {
            "first": F.array_join(F.slice(split, F.lit(1), F.col("k")), " "),
            "rest": F.array_join(F.slice(split, F.col("k") + 1, F.col("words") - F.col("k")), " "),
        }
    )
    cuts = frequency(frequency(cuts, "first", "l"), "rest", "r").drop("first", "rest")
    scored = cuts.join(sizes, F.col("lang") == F.col("of")).drop("of")
    exact = "decimal(17,0)"  # products of two have 35 digits at most, a thousand times that 38
    score = f"(1000 * cast(a AS {exact}) * cast(total AS {exact})) DIV (cast(l AS {exact}) * cast(r AS {exact}))"
    scored = scored.withColumn("score", F.expr(score))
    best = (
        scored.groupBy("lang", "phrase", "words", "a", F.col("total").alias("n"))
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")
    )
    # A phrase goes if one that is a word longer is as frequent; if any longer one is, so is one of those between.
    inner = F.array(
        F.array_join(F.slice(split, F.lit(1), F.col("words") - 1), " "),
        F.array_join(F.slice(split, F.lit(2), F.col("words") - 1), " "),
    )
    covered = (
        phrases.filter("words > 2")
        .select(F.col("lang").alias("of"), F.explode(inner).alias("part"), F.col("a").alias("f"))
        .groupBy("of", "part")
        .agg(F.max("f").alias("f"))
    )
    held = (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("part")) & (100 * F.col("f") >= 100 * F.col("a"))
    return best.join(covered, held, "left_anti")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the 2000 strongest phrases of every language."""
    found = collocations(table(spark, sf_dir, "documents"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, row_number() OVER () AS row_no,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
  SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM split WHERE len(w) > 0
), sizes AS (
  SELECT lang, count(*)::HUGEINT AS n FROM placed GROUP BY lang
), f AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS n
  FROM placed, (SELECT unnest([1, 2, 3, 4, 5]) AS size)
  WHERE i + size - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 100
), cut AS (
  SELECT p.lang, p.phrase, p.size, p.n AS a, unnest(generate_series(1, p.size - 1)) AS k FROM f p WHERE p.size > 1
), scored AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, l.n AS l, r.n AS r, s.n AS n,
         (1000::HUGEINT * c.a * s.n) // (l.n::HUGEINT * r.n) AS score
  FROM cut c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(string_split(c.phrase, ' ')[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(string_split(c.phrase, ' ')[c.k + 1:], ' ')
  JOIN sizes s ON s.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM f q WHERE q.lang = b.lang AND q.size > b.size AND 100 * q.n >= 100 * b.a
      AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
WHERE rank <= 2000
"""

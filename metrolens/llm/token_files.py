"""Token ids in binary files: frequency-ranked, byte-aligned, control bytes apart.

Documents are sorted once by id (a range sort of the texts, so every task holds
one range of ids) and encoded in that order; the ids of a task are cut into
chunks of bounded size and written. The frequencies of all ids give every id a
rank, 0 for the commonest, so that the common ones take one byte. A second pass
writes each chunk as one file, in the order of the paths:

    head     magic, documents, ids, ids of all documents before this file,
             bytes of the four parts below
    names    64-bit id of every document, then a bit per document: id is null
    lengths  ids of every document, coded as the ids are
    control  two bits an id, four ids a byte: bytes of the id's rank less one
    data     the ranks' bytes, lowest first, without leading zeros

``ranks/`` holds the id of every rank. :func:`read_ids` needs nothing but the
folder: it decodes with numpy table lookups, one control byte (four ids) each.

Null and empty texts are their closing id alone. Documents without an id come
first. Repeated rows are documents of their own. An empty table gives a folder
without files, which reads as no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.common import lean, slices, span_hashes, span_numbers, stage, table, worker_cache
from metrolens.session import staging_path

CLOSING_ID = 2
VOCABULARY = "byte_bpe_50k.json"
CHUNK_IDS = 2 << 20  # ids of a file, more only where one document has more

# Parts a Python worker remembers; others are encoded in each batch they come in.
HELD_PARTS = 500_000

# Latin letters, white space but the space and the line feed, and the pattern of pieces of the vocabulary file's pre-tokenizer.
LATIN = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
UNUSUAL = "\\t\\x0b-\\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class PartIds(dict):
    """Little-endian ids of parts of texts (as UTF-8), kept from one batch to the next.

    A part ends where the pattern of pieces always cuts: around a lone line
    feed, before a lone space, and between a Latin letter and ASCII
    punctuation. So equal parts have equal ids wherever they stand. The parts
    of a batch are found and told apart as arrays of bytes; only the different
    ones are looked up, and the new ones encoded.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.encoder = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.encoder.model)  # takes pieces that are cut out already
        self.width, self.code = ("<u2", "H") if self.encoder.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.letters = self.byte_letters()
        self.pieces = regex.compile(PIECE).findall
        self.word = re.compile(f" ?[{LATIN}]+").fullmatch
        # special strings, white space that is neither a lone space nor a lone line feed, and
        # controls that Python and the pre-tokenizer class differently
        special = [re.escape(t.content) for t in self.encoder.get_added_tokens_decoder().values()]
        self.unusual = re.compile("|".join([f"[{UNUSUAL}]", "[ \n][ \n]", *special])).search
        letter = np.zeros(256, bool)
        letter[[*range(65, 91), *range(97, 123)]] = True
        mark = np.zeros(256, bool)
        mark[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
        self.letter, self.mark = letter, mark

    @staticmethod
    def byte_letters() -> dict[int, str]:
        """The printable letter that a byte-level vocabulary writes for each byte."""
        plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        spare = iter(range(0x100, 0x200))
        return {b: chr(b if b in plain else next(spare)) for b in range(256)}

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def shown(self, piece: str) -> str:
        """The piece in the vocabulary's letters."""
        if piece.isascii() and piece.isprintable():  # of these, only the space has another letter
            return piece.replace(" ", self.letters[32])
        return piece.encode().decode("latin-1").translate(self.letters)

    def learned(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Ids of parts that are not held yet."""
        cut = {}
        for part in parts:
            text = part.decode()
            cut[part] = (text,) if self.word(text) else self.pieces(text)
        pieces = list({one for found in cut.values() for one in found})
        coded = self.merges.encode_batch_fast(list(map(self.shown, pieces)), add_special_tokens=False)
        ids = {p: self.packed(c.ids) for p, c in zip(pieces, coded)}
        return {part: b"".join(map(ids.__getitem__, found)) for part, found in cut.items()}

    def starts(self, raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where the parts of the texts between ``edges`` begin."""
        cut = raw == 32
        feed = raw == 10
        cut |= feed
        cut[1:] |= feed[:-1]
        letter = self.letter[raw]
        # two bytes of a Latin-1 letter: all but the signs for multiplication and division
        letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        cut[1:] |= letter[:-1] & self.mark[raw[1:]]
        cut[edges[:-1][np.diff(edges) > 0]] = True
        return np.flatnonzero(cut)

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts."""
        odd = [bool(self.unusual(t)) for t in texts]
        plain = [t.encode() for t, o in zip(texts, odd) if not o]
        edges = np.cumsum([0, *map(len, plain)])
        whole = b"".join(plain)
        raw = np.frombuffer(whole, np.uint8)
        begins = self.starts(raw, edges) if len(raw) else np.zeros(0, np.int64)
        ends = np.append(begins[1:], len(raw)) if len(begins) else begins
        first, number = span_numbers(raw, begins, ends, span_hashes(raw, begins, ends))
        parts = [whole[a:b] for a, b in zip(begins[first].tolist(), ends[first].tolist())]
        new = self.learned([p for p in parts if p not in self])
        self.update(new)
        ids = [self[p] for p in parts]
        if len(self) > HELD_PARTS:
            for part in new:
                del self[part]
        # the ids of all parts one after another, then those of each text
        unit = np.dtype(self.width).itemsize
        size = np.array([len(i) // unit for i in ids], np.int64)
        held = np.frombuffer(b"".join(ids), self.width)
        base, many = (np.cumsum(size) - size)[number], size[number]
        after = np.cumsum(many)
        flat = held[np.arange(int(many.sum())) + np.repeat(base - (after - many), many)].tobytes()
        at = unit * np.concatenate([[0], after])[np.searchsorted(begins, edges)]
        spans = iter(zip(at[:-1].tolist(), at[1:].tolist()))
        return [
            self.packed(self.encoder.encode(t, add_special_tokens=False).ids) if o else flat[slice(*next(spans))]
            for t, o in zip(texts, odd)
        ]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


ENCODED = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("chunk", T.IntegerType()),
        T.StructField("docs", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("before", T.LongType()),
        T.StructField("names", T.BinaryType()),
        T.StructField("unnamed", T.BinaryType()),
        T.StructField("lengths", T.BinaryType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField(
            "counts",
            T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType())])),
        ),
    ]
)


def encode_sorted(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    closing_id: int = CLOSING_ID,
    tokenizer_path: str | None = None,
    chunk_ids: int = CHUNK_IDS,
) -> DataFrame:
    """Chunks of consecutive documents in id order, written: ``part`` and
    ``chunk`` order them, each has its documents' ids and lengths and the token
    ids; ``before`` counts the ids of the part before it and ``counts`` how often
    each token id stands in it."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(ENCODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        path = tokenizer_path or vocabulary_path()
        words = worker_cache(f"part-ids:{path}", lambda: PartIds(path))
        closing = words.packed([closing_id])
        size = len(closing)
        part, chunk, before = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        held: list[bytes] = []
        total = 0

        def written() -> pa.RecordBatch:
            ids = b"".join(held)
            n = np.bincount(np.frombuffer(ids, words.width))
            token = np.flatnonzero(n)
            lengths = np.array([len(h) // size for h in held], "<u8")
            unnamed = np.packbits([n is None for n in names], bitorder="little")
            row = (
                part,
                chunk,
                len(names),
                int(lengths.sum()),
                before,
                np.array([n or 0 for n in names], "<i8").tobytes(),
                unnamed.tobytes(),
                lengths.tobytes(),
                ids,
                [{"id": int(t), "n": int(c)} for t, c in zip(token, n[token])],
            )
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], names=arrow.names)

        for batch in slices(batches, 512):
            texts = words.texts([t or "" for t in batch.column(1).to_pylist()])
            for name, ids in zip(batch.column(0).to_pylist(), texts):
                ids += closing
                if total and total + len(ids) // size > chunk_ids:
                    yield written()
                    chunk, before = chunk + 1, before + total
                    names, held, total = [], [], 0
                names.append(name)
                held.append(ids)
                total += len(ids) // size
        if names:
            yield written()

    # Rows of one id are dealt by their text, equal rows by their place in the input: no range grows with a hot id.
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    keys = ("id", F.xxhash64("text"), F.monotonically_increasing_id())
    return stage(rows.orderBy(*keys).mapInArrow(lean(run), ENCODED), "token-chunks", codec="zstd")


def put_numbers(values: np.ndarray) -> tuple[bytes, bytes]:
    """``(control, data)`` of numbers below 2**32."""
    values = np.ascontiguousarray(values, "<u4")
    most = int(values.max()) if len(values) else 0
    width = max(1, -(-most.bit_length() // 8))
    size = np.ones(len(values), np.uint8)
    for byte in range(1, width):
        size += values >> (8 * byte) > 0
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = size - 1
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    kept = np.arange(width, dtype=np.uint8) < size[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[:, :width][kept].tobytes()


def lookup_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every control byte: the bytes its four numbers take, where each of
    them begins behind the first, and the mask that leaves its own bytes of the
    four that stand there."""
    size = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
    mask = ((1 << 8 * size.astype(np.uint64)) - 1).astype("<u4")
    return size.sum(axis=1), np.cumsum(size, axis=1) - size, mask


def get_numbers(control: bytes, data: bytes, n: int, block: int = 1 << 15) -> np.ndarray:
    """The ``n`` numbers of :func:`put_numbers`, ``block`` control bytes at a time."""
    widths, firsts, masks = lookup_tables()
    control = np.frombuffer(control, np.uint8)
    held = data + bytes(16)  # the last control byte may stand for fewer than four numbers
    four = np.ndarray(len(held) - 3, "<u4", held, strides=(1,))  # the four bytes from every place on
    out = np.empty(len(control) * 4, "<u4")
    start = 0
    for at in range(0, len(control), block):
        codes = control[at : at + block]
        ends = start + np.cumsum(widths[codes])
        places = (ends - widths[codes])[:, None] + firsts[codes]
        out[4 * at : 4 * (at + len(codes))] = (four[places] & masks[codes]).reshape(-1)
        start = int(ends[-1])
    return out[:n]


MAGIC = b"ranked-ids-1\n"
HEAD = "<13sQQQ6Q"  # magic, documents, ids, ids before, bytes of the parts
RANKS = "ranks"
FILES = "files"


def _write_rows(df: DataFrame, path: str, *by: str) -> None:
    """One binary column as files of raw bytes (and a closing line feed), by Spark's own committer."""
    rest = [c for c in df.columns if c not in by]
    raw = df.select(F.col(rest[0]).cast("string").alias("raw"), *by)
    writer = raw.write.partitionBy(*by) if by else raw.write
    writer.text(path)


def write_ids(docs: DataFrame, path: str, **options) -> None:
    """Encode all of ``docs`` and write its token ids below ``path`` (see the module's text for the format)."""
    spark = docs.sparkSession
    chunks = encode_sorted(docs, **options)
    counts = chunks.select(F.explode("counts").alias("c")).groupBy("c.id").agg(F.sum("c.n").alias("n"))
    by_rank = [r.id for r in counts.orderBy(F.desc("n"), "id").collect()]  # at most one row per id of the vocabulary
    ids = np.array(by_rank, "<u4")
    ranks = spark.createDataFrame([(bytearray(ids.tobytes()),)], "ids binary").coalesce(1)
    _write_rows(ranks, f"{path}/{RANKS}")

    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank_of[ids] = np.arange(len(ids), dtype=np.uint32)
    # One row per task of the sort: the ids before its first document.
    earlier, total = {}, 0
    for part, n in chunks.groupBy("part").agg(F.sum("total")).orderBy("part").collect():
        earlier[part] = total
        total += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = {n: batch.column(i)[0].as_py() for i, n in enumerate(batch.schema.names)}
            width = len(row["ids"]) // row["total"]
            lengths = put_numbers(np.frombuffer(row["lengths"], "<u8"))
            coded = put_numbers(rank_of[np.frombuffer(row["ids"], f"<u{width}")])
            parts = (row["names"], row["unnamed"], *lengths, *coded)
            head = struct.pack(HEAD, MAGIC, row["docs"], row["total"], earlier[row["part"]] + row["before"], *map(len, parts))
            name = f"{row['part']:08d}-{row['chunk']:08d}"
            yield pa.RecordBatch.from_arrays(
                [pa.array([b"".join((head, *parts))], pa.binary()), pa.array([name])], names=["raw", "file"]
            )

    coded = chunks.drop("counts").mapInArrow(lean(run), "raw binary, file string")
    _write_rows(coded, f"{path}/{FILES}", "file")


def parse_file(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """``(document ids, which are null, lengths, ranks, ids before)`` of one file."""
    magic, docs, total, before, *sizes = struct.unpack_from(HEAD, content)
    if magic != MAGIC:
        raise ValueError("not a file of ranked ids")
    edges = np.cumsum([struct.calcsize(HEAD), *sizes]).tolist()
    if len(content) < edges[-1]:
        raise ValueError("a file of ranked ids is cut off")
    names, unnamed, *coded = (content[a:b] for a, b in zip(edges, edges[1:]))
    missing = np.unpackbits(np.frombuffer(unnamed, np.uint8), bitorder="little")[:docs].astype(bool)
    lengths = get_numbers(coded[0], coded[1], docs).astype(np.int64)
    return np.frombuffer(names, "<i8"), missing, lengths, get_numbers(coded[2], coded[3], total), before


def read_ids(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """The documents of :func:`write_ids`: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32`` (of the ids as
    little-endian 32-bit integers) and, unless ``ids`` is false, the ``ids``."""
    files = spark.read.format("binaryFile")
    ranks = [r.content for r in files.load(f"{path}/{RANKS}").select("content").collect()]  # one row per id of the vocabulary
    by_rank = np.frombuffer(b"".join(r[:-1] for r in ranks), "<u4")  # less the closing line feed
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            names, missing, lengths, found, before = parse_file(batch.column(0)[0].as_py())
            tokens = by_rank[found]
            edges = np.concatenate([[0], np.cumsum(lengths)])
            raw, cuts = tokens.tobytes(), (4 * edges).tolist()
            view = memoryview(raw)
            columns = [
                pa.array(names, pa.int64(), mask=missing),
                pa.array(before + edges[:-1], pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array([zlib.crc32(view[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
            ]
            if ids:
                columns.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(tokens, pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return files.option("recursiveFileLookup", "true").load(f"{path}/{FILES}").select("content").mapInArrow(lean(run), schema)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents written as ranked ids and read back, by digest."""
    path = staging_path(spark, "token-files")
    write_ids(table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path, ids=False)

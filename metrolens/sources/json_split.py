"""Large JSON documents of any line layout, one line included, cut up by many tasks.

The text is read in records that end with a closing brace (the record separator
of Spark's text source), so a file splits at bytes, wherever its lines end. A
task cannot know whether its block of the file starts inside a string, nor how
deep. It therefore works out both cases at once: a block is a map from (outside
or inside a string) to (the same at its end, change of depth). A record never
ends inside an escape, since an escaped brace is no JSON. The maps, one row per
block, are composed along each file by running sums, which gives the state at
every block's start; a second pass over the text then cuts the objects out, all
brackets of a batch at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrolens.session import materialize

# Offsets of file blocks (one row per block) are broadcast up to this many, else joined by shuffle.
MAX_BROADCAST_BLOCKS = 200_000

CLOSE = b"}"
_ESCAPE = re.compile(rb"\\.", re.DOTALL)

# A root member "type" and its value; neither holds a closing brace, so one record has both.
_TYPE = re.compile(rb'"type"\s*:\s*("(?:[^"\\]|\\.)*"|[^,\s]+)', re.DOTALL)

# Depth of the elements of a root member: inside the root object (1) and the member (2).
_ELEMENT = 3


def read_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The bytes before each closing brace, in file order within a block: ``value``,
    ``file``, ``block`` (its start), ``size`` of the file and ``mid``, which rises with the order."""
    return spark.read.option("lineSep", CLOSE.decode()).text(list(paths)).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("mid"),
    )


def lex(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quotes (as positions), positions of brackets, and +1 or -1 for each
    bracket; escapes count as neither."""
    raw = np.frombuffer(_ESCAPE.sub(b"__", data) if b"\\" in data else data, np.uint8)
    turn = np.zeros(256, np.int8)
    turn[[ord("["), ord("{")]], turn[[ord("]"), ord("}")]] = 1, -1
    step = turn[raw]
    brackets = np.flatnonzero(step)
    return np.flatnonzero(raw == ord('"')), brackets, step[brackets]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes, bytes]]:
    """Neighbouring records of one block: its first row, the text with its braces, and the last record."""
    last = None
    for batch in batches:
        names = batch.schema.names
        values = batch.column(names.index("value")).to_pylist()
        files = batch.column(names.index("file")).to_numpy(zero_copy_only=False)
        blocks = batch.column(names.index("block")).to_numpy()
        mids = batch.column(names.index("mid")).to_numpy()
        cuts = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            row = {n: batch.column(i)[a].as_py() for i, n in enumerate(names) if n != "value"}
            if (np.diff(mids[a:b]) <= 0).any() or (last is not None and last[:2] == (row["file"], row["block"]) and last[2] >= row["mid"]):
                raise RuntimeError("records of a file block arrived out of order")
            last = (row["file"], row["block"], int(mids[b - 1]))
            yield row, CLOSE.join(values[a:b]) + CLOSE, values[b - 1]


def _block_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, held = None, None
    done: list[tuple] = []
    for row, data, ending in _runs(batches):
        if key != (row["file"], row["block"]):
            if held:
                done.append((*key, *held))
            key, held = (row["file"], row["block"]), [row["size"], 0, 0, 0, 0, False]
        quotes, brackets, step = lex(data)
        inside = np.searchsorted(quotes, brackets) & 1
        outer, inner = int(step[inside == 0].sum()), int(step[inside == 1].sum())
        if held[1] % 2:
            outer, inner = inner, outer
        held[1] += len(quotes)
        held[2] += outer
        held[3] += inner
        held[4] += len(data)
        held[5] = not ending.strip()
    if held:
        done.append((*key, *held))
    if done:
        names = ["file", "block", "size", "quotes", "outer", "inner", "bytes", "blank"]
        kinds = [pa.string(), *[pa.int64()] * 6, pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)


def block_states(records: DataFrame, holds) -> DataFrame:
    """``(file, block, quoted, depth)`` at every block's start, written. ``holds``
    turns a condition and a message into a filter that fails the query.

    Each record counts with a closing brace, which the last one of a file lacks
    if anything follows the document. The bytes tell: a file that is one byte
    short must end in blanks, and with one brace too many.
    """
    maps = records.mapInArrow(
        _block_maps, "file string, block long, size long, quotes long, outer long, inner long, bytes long, blank boolean"
    )
    maps = materialize(maps, "json-blocks")
    in_order = Window.partitionBy("file").orderBy("block")
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    stated = maps.withColumn("quoted", ((F.sum("quotes").over(upto) - F.col("quotes")) % 2).cast("int"))
    stated = stated.withColumn("change", F.when(F.col("quoted") == 0, F.col("outer")).otherwise(F.col("inner")))
    stated = stated.select(
        "*",
        (F.sum("change").over(upto) - F.col("change")).alias("depth"),
        F.sum("change").over(upto).alias("then"),
        F.sum("bytes").over(upto).alias("seen"),
        F.sum("quotes").over(upto).alias("marks"),
        F.lead("block").over(in_order).isNull().alias("last"),
    )
    complete = (F.col("seen") == F.col("size")) & (F.col("then") == 0)
    followed = (F.col("seen") == F.col("size") + 1) & (F.col("then") == -1) & F.col("blank")
    sound = F.when(F.col("last"), (complete | followed) & (F.col("marks") % 2 == 0)).otherwise(F.col("then") >= 0)
    checked = stated.filter(holds(sound, "a document is cut off or compressed"))
    return materialize(checked.select("file", "block", "quoted", "depth"), "json-states")


_CUT = "file string, block bigint, at bigint, kind string, member string, text string"


def _member_name(data: bytes, quotes: np.ndarray, at: int) -> str:
    """The key before a bracket of the root. A key that another record began holds a brace."""
    upto = int(np.searchsorted(quotes, at))
    if upto < 2:
        return CLOSE.decode()
    return str(json.loads(data[quotes[upto - 2] : quotes[upto - 1] + 1]))


def _cut_elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut out the objects and arrays that are elements of a root member.

    Emits ``whole`` for one inside the block, ``head`` for one that opens here
    and runs past the block's end, ``tail`` for the end of one that opened in an
    earlier block, ``body`` for a block lying wholly inside one, and ``member``
    for every array or object of the root (its text is the opening bracket),
    ``type`` for the root's type and ``scalar`` for what a member holds besides
    objects and arrays (``null`` or ``other``). ``at`` is the byte in the block where
    it begins; tails and bodies have -1 and so come first in their block.
    ``member`` of an element is the member that holds it, or None where that
    began in an earlier block."""
    key = None
    depth = quoted = base = 0
    opened: int | None = None  # where the element now open began in this block, -1: before it
    parts: list[bytes] = []
    member = own = None
    out: list[tuple] = []

    def shut():
        if key is not None and opened is not None:
            out.append((*key, opened, "body" if opened < 0 else "head", own, b"".join(parts)))

    for row, data, _ in _runs(batches):
        if key != (row["file"], row["block"]):
            shut()
            key = (row["file"], row["block"])
            depth, quoted, base, parts, member, own = row["depth"], row["quoted"], 0, [], None, None
            opened = -1 if depth >= _ELEMENT else None
            if depth == 0 and key[1] == 0 and not data.removeprefix(b"\xef\xbb\xbf").lstrip().startswith(b"{"):
                raise ValueError("a document does not begin with an object")
        quotes, brackets, step = lex(data)
        free = (np.searchsorted(quotes, brackets) + quoted) & 1 == 0
        brackets, step = brackets[free], step[free]
        depths = depth + np.cumsum(step, dtype=np.int64)
        ended = np.flatnonzero(depths <= 0)
        if depth <= 0 and base + key[1] > 0 and data.strip(b" \t\r\n") not in (b"", CLOSE):
            raise ValueError("text behind the end of a document")
        if len(ended) and data[brackets[ended[0]] + 1 :].strip(b" \t\r\n") not in (b"", CLOSE):
            raise ValueError("text behind the end of a document")
        up = step > 0
        members = brackets[up & (depths == _ELEMENT - 1)].tolist()
        names = [_member_name(data, quotes, at) for at in members]
        out.extend((*key, base + at, "member", name, data[at : at + 1]) for at, name in zip(members, names))
        out.extend((*key, base + at, kind, None, text) for at, kind, text in _between(data, brackets, depths, depth))
        starts = brackets[up & (depths == _ELEMENT)].tolist()
        ends = (brackets[~up & (depths == _ELEMENT - 1)] + 1).tolist()
        if opened is not None and ends:
            parts.append(data[: ends[0]])
            out.append((*key, opened, "tail" if opened < 0 else "whole", own, b"".join(parts)))
            opened, parts = None, []
            ends = ends[1:]
        elif opened is not None:
            parts.append(data)
        held = np.searchsorted(members, starts).tolist()
        holders = [names[i - 1] if i else member for i in held]
        out.extend((*key, base + a, "whole", h, data[a:b]) for a, b, h in zip(starts, ends, holders))
        if len(starts) > len(ends):
            opened, own, parts = base + starts[-1], holders[-1], [data[starts[-1] :]]
        member = names[-1] if names else member
        depth = int(depths[-1]) if len(depths) else depth
        quoted = (quoted + len(quotes)) & 1
        base += len(data)
        if out:
            yield _cut_batch(out)
            out = []
    shut()
    if out:
        yield _cut_batch(out)


def _between(data: bytes, brackets: np.ndarray, depths: np.ndarray, depth: int) -> Iterator[tuple[int, str, bytes]]:
    """``(at, kind, text)`` of the root's type and of scalars in its members, which stand between brackets."""
    froms, levels = np.append(0, brackets + 1), np.append(depth, depths)
    upto = np.append(brackets, len(data))
    for level in (1, 2):
        taken = np.flatnonzero(levels == level)
        for a, b in zip(froms[taken].tolist(), upto[taken].tolist()):
            if level == 1:
                for found in _TYPE.finditer(data, a, b):
                    value = found[1]
                    yield found.start(), "type", str(json.loads(value)).encode() if value[:1] == b'"' else b""
            elif b - a > 1 or data[a:b] != b",":
                for word in data[a:b].replace(b",", b" ").split():
                    if word != CLOSE:  # the end that a file's last record lacks
                        yield a, "scalar", b"null" if word == b"null" else b"other"


def _cut_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    columns[-1] = columns[-1].cast(pa.string())
    return pa.RecordBatch.from_arrays(columns, names=["file", "block", "at", "kind", "member", "text"])


def member_elements(
    spark: SparkSession, paths: Sequence[str], member: str, holds, kind: str | None = None
) -> DataFrame:
    """The JSON text of every object or array that is an element of the root's ``member`` (one column, ``text``).

    With ``kind``, every root must have that ``type`` and one array ``member``
    of objects and nulls, and the nulls are returned too.

    Pieces of elements that cross a block's end (at most a head and a tail per
    block, or a body for a block inside one) are numbered over rows without
    text, and their texts joined and put together by that number. The states
    and the cut texts are written under the shared checkpoint folder, so jobs
    run when the DataFrame is built.
    """
    records = read_records(spark, paths)
    states = block_states(records, holds)
    if states.count() <= MAX_BROADCAST_BLOCKS:
        # The scan streams through a broadcast join, so a block's records keep their order (the cutting pass checks it).
        placed = records.join(F.broadcast(states), ["file", "block"])
    else:
        placed = records.join(states, ["file", "block"]).sortWithinPartitions("file", "block", "mid")
    # Written once: the uses below read it without the text.
    cut = materialize(placed.drop("size").mapInArrow(_cut_elements, _CUT), "json-cut")

    place = Window.partitionBy("file").orderBy("block", "at").rowsBetween(Window.unboundedPreceding, 0)
    # Per block: pieces and members, a few rows without text. Each takes the head and the member it follows.
    told = cut.filter("kind <> 'whole'" + ("" if kind else " AND kind NOT IN ('type', 'scalar')")).select(
        "file",
        "block",
        "at",
        "kind",
        F.when(~F.col("kind").isin("head", "tail", "body"), F.col("text")).alias("told"),
        F.last(F.when(F.col("kind") == "head", F.struct("block", "at")), ignorenulls=True).over(place).alias("element"),
        F.last(F.when(F.col("kind") == "member", F.col("member")), ignorenulls=True).over(place).alias("within"),
    )
    # What a block starts in: the member that was open at the end of the last block that names one.
    ends = told.groupBy("file", "block").agg(F.max_by("within", "at").alias("within"))
    whole = (
        cut.filter("kind = 'whole'")
        .select("file", "block", "member", "text")
        .join(_members_at_starts(states, ends), ["file", "block"])
        .filter(F.coalesce("member", "within") == member)
        .select("text")
    )
    is_piece = F.col("kind").isin("head", "tail", "body")
    texts = cut.filter(is_piece).select("file", "block", "at", "text")
    headed = told.filter(is_piece).drop("told").withColumnRenamed("within", "of").join(texts, ["file", "block", "at"])
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "text", "of")))
    stitched = (
        headed.groupBy("file", "element")
        .agg(parts.alias("parts"))
        .filter(F.col("parts")[0]["of"] == member)
        .select(F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    )
    found = whole.unionByName(stitched)
    if kind is None:
        return found
    own = F.col("kind") == "member"
    roots = told.groupBy("file").agg(
        F.max_by(F.when(F.col("kind") == "type", F.col("told")), F.when(F.col("kind") == "type", F.struct("block", "at"))).alias("type"),
        F.count_if(own & (F.col("within") == member)).alias("n"),
        F.count_if(own & (F.col("within") == member) & (F.col("told") == "[")).alias("arrays"),
    )
    right = (F.col("type") == kind) & (F.col("n") == 1) & (F.col("arrays") == 1)
    files = states.select("file").distinct().join(roots, "file", "left")
    files.filter(holds(F.coalesce(right, F.lit(False)), f"not a {kind} document")).count()  # a row per file
    scalars = told.filter((F.col("kind") == "scalar") & (F.col("within") == member))
    nulls = scalars.filter(holds(F.col("told") == "null", f"an element of {member} is no object")).select(F.col("told").alias("text"))
    objects = found.filter(holds(F.col("text").startswith("{"), f"an element of {member} is no object"))
    return objects.unionByName(nulls)


def _members_at_starts(states: DataFrame, ends: DataFrame) -> DataFrame:
    """``(file, block, within)``: the root member that is open where each block starts."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (
        states.select("file", "block")
        .join(ends, ["file", "block"], "left")
        .select("file", "block", F.last("within", ignorenulls=True).over(before).alias("within"))
    )

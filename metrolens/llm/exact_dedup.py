"""Exact deduplication with Patricia tries as owners of the texts.

Two passes of compressed radix tries. The first runs inside the scan tasks, so
a group of copies leaves each task as one row, however large it is. The second
deals those representatives by text length and content hash and inserts their
full byte strings, so equality is decided on bytes and never on a hash. A
terminal node stores the owner of its text. A trie over its byte budget gives
up its largest subtree: texts under that subtree are written out and go
through another pass over more partitions.

Null text counts as empty. Repeated rows with the same id are different rows,
of which one is kept (the first in scan order). A null id never owns a text
that has a row with an id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.common import fresh, lean, materialize, materialize_observed, slices, table

SCAN_TRIE_BYTES = 32 << 20  # a scan task hands its representatives on beyond this
OWNER_TRIE_BYTES = 128 << 20  # an owner task spills subtrees beyond this
NODE_BYTES = 320  # what a node costs besides the bytes of its edge


class Node:
    __slots__ = ("edge", "children", "entry", "spilled")

    def __init__(self, edge: bytes):
        self.edge = edge
        self.children: dict[int, Node] = {}
        self.entry = None
        self.spilled = False


def common_prefix(edge: bytes, data: bytes, pos: int) -> int:
    """How many leading bytes of ``edge`` stand in ``data`` at ``pos``."""
    low, high = 0, min(len(edge), len(data) - pos)
    while low < high:
        mid = (low + high + 1) // 2
        if data.startswith(edge[low:mid], pos + low):
            low = mid
        else:
            high = mid - 1
    return low


class PatriciaTrie:
    """Byte strings with one mutable entry each, on edges that never branch."""

    def __init__(self):
        self.root = Node(b"")
        self.bytes = 0

    def find(self, data: bytes) -> Node | None:
        """The node that ends ``data``, made if needed; None under a spilled subtree."""
        node, pos, size = self.root, 0, len(data)
        while pos < size:
            child = node.children.get(data[pos])
            if child is None:
                child = Node(data[pos:])
                node.children[data[pos]] = child
                self.bytes += len(child.edge) + NODE_BYTES
                return child
            if data.startswith(child.edge, pos):
                if child.spilled:
                    return None
                pos += len(child.edge)
                node = child
                continue
            shared = common_prefix(child.edge, data, pos)
            fork = Node(child.edge[:shared])
            child.edge = child.edge[shared:]
            fork.children[child.edge[0]] = child
            node.children[data[pos]] = fork
            self.bytes += NODE_BYTES
            node, pos = fork, pos + shared
        return node

    def items(self, node: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, object]]:
        """Texts and entries below ``node``, without recursion."""
        stack = [(node or self.root, prefix)]
        while stack:
            at, path = stack.pop()
            path += at.edge
            if at.entry is not None:
                yield path, at.entry
            stack.extend((child, path) for child in at.children.values())

    def spill(self) -> list[tuple[bytes, object]]:
        """Give up the largest subtree below the first branching node."""
        node, path = self.root, b""
        while len(node.children) == 1 and node.entry is None:
            (only,) = node.children.values()
            if only.spilled or not only.children:
                break
            node = only
            path += node.edge
        sizes = {k: self._weight(c) for k, c in node.children.items() if not c.spilled}
        if not sizes:
            return []
        child = node.children[max(sizes, key=sizes.get)]
        out = list(self.items(child, path))
        child.children, child.entry, child.spilled = {}, None, True
        self.bytes -= sizes[child.edge[0]] - len(child.edge) - NODE_BYTES
        return out

    @staticmethod
    def _weight(node: Node) -> int:
        total, stack = 0, [node]
        while stack:
            at = stack.pop()
            total += len(at.edge) + NODE_BYTES
            stack.extend(at.children.values())
        return total


def _owns(a: tuple, b: tuple, largest: bool) -> bool:
    """Whether (id, tag) ``a`` takes the text over from ``b``."""
    if a[0] is None or b[0] is None:
        if (a[0] is None) != (b[0] is None):
            return b[0] is None
    elif a[0] != b[0]:
        return (a[0] > b[0]) == largest
    return a[1] < b[1]


def _scan_schema(members: T.StructType, id_type: T.DataType) -> T.StructType:
    return T.StructType(
        list(members.fields)
        + [
            T.StructField("__tag", T.LongType()),
            T.StructField("__copy", T.LongType()),
            T.StructField("__null", T.BooleanType()),
            T.StructField("__text", T.BinaryType()),
            T.StructField("__sha", T.StringType()),
            T.StructField("__bytes", T.LongType()),
            T.StructField("__rows", T.LongType()),
            T.StructField("__own_id", id_type),
            T.StructField("__own_tag", T.LongType()),
        ]
    )


def _scan(schema: T.StructType, n_members: int, id_at: int, largest: bool, budget: int):
    """Per task: a row for each input row (which copy group of this task it is
    in) and a row for each distinct text with its local owner."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    names = arrow.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        trie, copies, tag = PatriciaTrie(), 0, 0

        def representatives(held: PatriciaTrie) -> Iterator[pa.RecordBatch]:
            rows, size = [], 0
            for text, (copy, sha, n, own) in held.items():
                rows.append((copy, text, sha, len(text), n, own[0], own[1]))
                size += len(text)
                if size > 2 << 20 or len(rows) >= 1000:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            copy, text, sha, size, n, own_id, own_tag = zip(*rows)
            given = {
                "__copy": copy, "__text": text, "__sha": sha, "__bytes": size,
                "__rows": n, "__own_id": own_id, "__own_tag": own_tag,
            }
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(given[f.name], f.type) if f.name in given else pa.nulls(len(rows), f.type)
                    for f in arrow
                ],
                names=names,
            )

        for batch in slices(batches):
            texts = batch.column(n_members).to_pylist()
            ids = batch.column(id_at).to_pylist()
            groups = []
            for text, row_id in zip(texts, ids):
                node = trie.find(text or b"")
                own = (row_id, base + tag)
                tag += 1
                entry = node.entry
                if entry is None:
                    node.entry = [base + copies, hashlib.sha256(text or b"").hexdigest(), 1, own]
                    copies += 1
                else:
                    entry[2] += 1
                    if _owns(own, entry[3], largest):
                        entry[3] = own
                groups.append(node.entry[0])
            n = len(groups)
            own_columns = {
                "__tag": pa.array(range(base + tag - n, base + tag), pa.int64()),
                "__copy": pa.array(groups, pa.int64()),
                "__null": pa.array([t is None for t in texts], pa.bool_()),
            }
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(i).cast(f.type) if i < n_members else own_columns.get(f.name, pa.nulls(n, f.type))
                    for i, f in enumerate(arrow)
                ],
                names=names,
            )
            if trie.bytes > budget:
                yield from representatives(trie)
                trie = PatriciaTrie()
        yield from representatives(trie)

    return run


def _owner_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("__copy", T.LongType()),
            T.StructField("__text", T.BinaryType()),
            T.StructField("__sha", T.StringType()),
            T.StructField("__bytes", T.LongType()),
            T.StructField("__rows", T.LongType()),
            T.StructField("__own_id", id_type),
            T.StructField("__own_tag", T.LongType()),
        ]
    )


def _owners(schema: T.StructType, largest: bool, budget: int):
    """Per task: one row for each local group with its global owner and group
    size; rows that still hold their text go through another pass."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, out, size = PatriciaTrie(), [], 0

        def batch() -> pa.RecordBatch:
            columns = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], names=arrow.names)

        def given_up(text: bytes, entry: list) -> None:
            out.extend((copy, text, entry[1], len(text), n, *own) for copy, n, own in entry[0])

        for b in slices(batches):
            for copy, text, sha, _, n, own_id, own_tag in zip(*(c.to_pylist() for c in b.columns)):
                own = (own_id, own_tag)
                node = trie.find(text)
                if node is None:
                    out.append((copy, text, sha, len(text), n, *own))
                elif node.entry is None:
                    node.entry = [[(copy, n, own)], sha]
                else:
                    node.entry[0].append((copy, n, own))
            while trie.bytes > budget:
                spilled = trie.spill()
                if not spilled:
                    break
                for text, entry in spilled:
                    given_up(text, entry)
                    if len(out) >= 256:
                        yield batch()
                        out.clear()
            if len(out) >= 5000:
                yield batch()
                out.clear()
        for text, (parts, sha) in trie.items():
            best = parts[0][2]
            for _, _, own in parts[1:]:
                if _owns(own, best, largest):
                    best = own
            total = sum(n for _, n, _ in parts)
            out.extend((copy, None, sha, len(text), total, *best) for copy, _, _ in parts)
            if len(out) >= 5000:
                yield batch()
                out.clear()
        if out:
            yield batch()

    return run


def _find(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    columns: list[str],
    keep: str,
    scan_bytes: int = SCAN_TRIE_BYTES,
    owner_bytes: int = OWNER_TRIE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """``(members, texts)``: a row per input row, with ``columns`` as ``__m0``,
    ``__m1``, ..., and a row per distinct text of each scan task, joined by ``__copy``."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    id_type = docs.schema[id_col].dataType
    (own,) = fresh(docs, "__id")
    renamed = docs.select(
        *[F.col(f"`{c}`").alias(f"__m{i}") for i, c in enumerate(columns)],
        F.col(f"`{id_col}`").alias(own),
        F.col(f"`{text_col}`").cast("binary").alias("__text"),
    )
    members_in = T.StructType(renamed.schema.fields[:-1])
    schema = _scan_schema(members_in, id_type)
    n = len(columns) + 1
    scanned = materialize(
        renamed.mapInArrow(lean(_scan(schema, n, n - 1, keep == "largest", scan_bytes)), schema), "copies-scan"
    )

    owner = _owner_schema(id_type)
    todo = scanned.filter("__text IS NOT NULL").select(*owner.names)
    resolved, partitions = None, 0
    while True:
        dealt = (
            todo.repartition(partitions, "__bytes", "__sha") if partitions else todo.repartition("__bytes", "__sha")
        )
        done, seen = materialize_observed(
            dealt.mapInArrow(lean(_owners(owner, keep == "largest", owner_bytes)), owner),
            "copies-owners",
            {"left": F.count("__text")},
        )
        part = done.filter("__text IS NULL")
        resolved = part if resolved is None else resolved.unionByName(part)
        if not seen["left"]:
            break
        todo = done.filter("__text IS NOT NULL")
        partitions = 4 * (partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    rows = scanned.filter("__text IS NULL").select(*members_in.names, "__tag", "__copy", "__null")
    found = resolved.select(
        "__copy", "__sha", F.col("__rows").alias("__group"), F.col("__own_id").alias("__keep_id"), "__own_tag"
    )
    members = rows.join(found, "__copy").select(
        *[f"__m{i}" for i in range(len(columns))],
        "__copy",
        "__null",
        "__keep_id",
        "__group",
        "__sha",
        (F.col("__tag") == F.col("__own_tag")).alias("__kept"),
    )
    texts = scanned.filter("__text IS NOT NULL").select("__copy", F.col("__text").cast("string").alias("__text"))
    return members, texts


def find_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    scan_bytes: int = SCAN_TRIE_BYTES,
    owner_bytes: int = OWNER_TRIE_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id`` (id of the row that
    stays), ``group_size``, ``kept`` and ``text_sha256``.

    ``keep`` is ``largest`` or ``smallest`` id; among rows of one id the first
    in scan order stays. The byte budgets bound the memory of a task, not the
    result.
    """
    members, _ = _find(docs, id_col, text_col, [id_col], keep, scan_bytes, owner_bytes)
    return members.select(
        F.col("__m0").alias(id_col),
        F.col("__keep_id").alias("keep_id"),
        F.col("__group").alias("group_size"),
        F.col("__kept").alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``docs`` with one row of each group of identical texts, columns unchanged."""
    others = [c for c in docs.columns if c != text_col]
    members, texts = _find(docs, id_col, text_col, others, keep)
    kept = members.filter("__kept").join(texts, "__copy")
    text = F.when(F.col("__null"), F.lit(None).cast("string")).otherwise(F.col("__text"))
    at = {c: F.col(f"__m{i}") for i, c in enumerate(others)}
    return kept.select(*[at.get(c, text).alias(c) for c in docs.columns])


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the row with the largest doc_id of equal texts stays."""
    return find_copies(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

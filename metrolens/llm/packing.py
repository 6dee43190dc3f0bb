"""Packing token sequences into windows by non-negative least squares.

Every document is encoded once and cut into whole windows and a remainder. The
histogram of piece lengths (at most one row per length, whatever the corpus) is
all the driver sees: it lists shallow combinations of lengths that fill a
window exactly, solves for how often to repeat each one, rounds, and writes
down which ranks of each length go where. What the recipes leave is packed
greedily, longest first, each window closed by cutting the piece that crosses
its end. The last partial window is cut into powers of two, which need no
padding.

Null text counts as empty (its document is the closing id alone). Repeated rows
are documents of their own. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain, combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.common import (
    STEP,
    lean,
    order_totals,
    scrambled,
    slices,
    stage,
    table,
    worker_cache,
)

WINDOW = 4096
CLOSING_ID = 2
VOCABULARY = "word_bpe_49k.json"
BROADCAST_BYTES = 32 << 20  # the list of cut pieces is broadcast up to this size, else joined by shuffle

# Long words and short sub-words a Python worker remembers; others are encoded in each batch they come in.
CACHED_WORDS = 50_000
CACHED_PIECES = 500_000
JOINED = 1 << 18  # characters of texts that are worked on together, more only where one text has more

# White space and controls, and the vocabulary file's own pattern of sub-words.
UNUSUAL = "\\x00\\t\\x0b-\\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNUSUAL_BYTES = b"\0\t\x0b\x0c\r\x1c\x1d\x1e\x1f"  # those of ASCII
SUBWORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others take the letters from U+0100 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return {b: chr(b if b in keep else next(spare)) for b in range(256)}


def byte_kinds() -> np.ndarray:
    """What a byte of a text is: 0 blank, 1 letter, 2 digit, 3 other sign, 4 what only whole words are read with."""
    kinds = np.full(256, 4, np.uint8)
    for b in range(0x21, 0x7F):
        kinds[b] = 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3
    kinds[ord("'")] = 4
    kinds[[32, 10]] = 0
    return kinds


def small_letters() -> np.ndarray:
    """A table that lower-cases A-Z."""
    return np.frombuffer(bytes(range(256)).lower(), np.uint8)


def runs_of(values: np.ndarray, at: np.ndarray, many: np.ndarray) -> np.ndarray:
    """``many[i]`` values from ``at[i]`` on, for every i, one after another."""
    after = np.cumsum(many)
    return values[np.arange(int(many.sum())) + np.repeat(at - (after - many), many)]


class SpanTable:
    """Ids of byte spans of at most 16 bytes, none of them zero, held as arrays.

    A span's bytes are two 64-bit numbers, compared whole. It stands in one of two
    slots; a span that finds both taken is not held. Ids are kept one span after another.
    """

    def __init__(self, most: int):
        self.most, self.n, self.used = most, 0, 0
        self.bits = max(8, (4 * most - 1).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros((2, most), np.uint64)
        self.at, self.many = np.zeros(most, np.int64), np.zeros(most, np.int64)
        self.ids = np.zeros(1 << 10, np.uint32)

    def __len__(self) -> int:
        return self.n

    @staticmethod
    def mixed(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return scrambled(one * np.uint64(STEP) + two)

    def _slot(self, mix: np.ndarray, way: int) -> np.ndarray:
        return (mix >> np.uint64(64 - self.bits) if way == 0 else mix & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def find(self, one: np.ndarray, two: np.ndarray, mix: np.ndarray) -> np.ndarray:
        """The number of each span, -1 if it is not held."""
        found = np.full(len(mix), -1, np.int32)
        left = np.arange(len(mix))
        for way in (0, 1):
            number = self.slots[self._slot(mix[left], way)]
            # number -1 looks at the last entry, and is dropped
            same = (self.keys[0][number] == one[left]) & (self.keys[1][number] == two[left]) & (number >= 0)
            found[left[same]] = number[same]
            left = left[~same]
        return found

    def kept(self, ids: np.ndarray) -> int:
        """Write ids behind the others; returns their place."""
        place = self.used
        if place + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:place], np.zeros(place + 2 * len(ids), np.uint32)])
        self.ids[place : place + len(ids)] = ids
        self.used = place + len(ids)
        return place

    def hold(self, one: np.ndarray, two: np.ndarray, mix: np.ndarray, at: np.ndarray, many: np.ndarray) -> None:
        """Hold different spans that are not held yet, as far as there is room; their ids
        stand at ``at``, before or behind the end."""
        left = np.arange(len(mix))[: self.most - self.n]
        for way in (0, 1):
            slot, first = np.unique(self._slot(mix[left], way), return_index=True)
            free = self.slots[slot] < 0
            slot, first = slot[free], first[free]
            taken = np.sort(left[first])
            slot = self._slot(mix[taken], way)
            numbers = np.arange(self.n, self.n + len(taken))
            self.slots[slot] = numbers
            self.keys[0][numbers], self.keys[1][numbers] = one[taken], two[taken]
            self.n += len(taken)
            left = np.delete(left, first)
            if way == 0:
                kept = taken
        kept = np.concatenate([kept, taken])
        n, numbers = many[kept], np.arange(self.n - len(kept), self.n)
        self.at[numbers], self.many[numbers] = self.kept(runs_of(self.ids, at[kept], n)) + np.cumsum(n) - n, n


class WordIds(dict):
    """Packed ids (little-endian 32-bit) of texts, put together from those of
    their sub-words, kept from one batch to the next.

    Equal to encoding the whole text, since no sub-word of this vocabulary
    spans white space. Words of printable ASCII without an apostrophe are split
    as arrays of bytes, and their sub-words go to the vocabulary's merges. Words
    of other plain Latin letters are split by the vocabulary's pattern; any
    other word goes through the whole encoder. Sub-words and words of at most 16
    bytes are held in ``pieces``, longer ones in the dictionary itself.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.encoder = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.encoder.model)  # takes sub-words that are cut out already
        self.subwords = regex.compile(SUBWORD).findall
        self.plain = re.compile("[\x21-\x7e\xa1-ɏ]+").fullmatch
        self.letters = byte_letters()
        self.kinds, self.small = byte_kinds(), small_letters()
        self.masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
        self.pieces = SpanTable(CACHED_PIECES)
        self.special = [t.content for t in self.encoder.get_added_tokens_decoder().values()]
        self.blanks = re.compile(f"[{UNUSUAL}]").search

    @staticmethod
    def pack(ids: Sequence[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def unusual(self, text: str, raw: bytes) -> bool:
        """Whether a text has special strings, or white space or controls but the space and the line feed."""
        if any(s in text for s in self.special):
            return True
        return len(raw.translate(None, UNUSUAL_BYTES)) < len(raw) if len(raw) == len(text) else bool(self.blanks(text))

    def merged(self, pieces: list[str]) -> list[list[int]]:
        """Ids of sub-words."""
        shown = [p if p.isascii() else p.encode().decode("latin-1").translate(self.letters) for p in pieces]
        return [c.ids for c in self.merges.encode_batch_fast(shown, add_special_tokens=False)]

    def learned(self, spans: list[bytes], odd: list[bool]) -> list[list[int]]:
        """Ids of spans: sub-words, and where ``odd`` whole words."""
        ids = self.merged([b.decode() for b, o in zip(spans, odd) if not o])
        if len(ids) == len(spans):
            return ids
        words = [b.decode() for b, o in zip(spans, odd) if o]
        cut = [self.subwords(w.lower()) if self.plain(w) else () for w in words]
        found = iter(self.merged([p for parts in cut for p in parts]))
        own = [
            [i for _ in parts for i in next(found)] if parts else self.encoder.encode(w, add_special_tokens=False).ids
            for w, parts in zip(words, cut)
        ]
        ids, own = iter(ids), iter(own)
        return [next(own) if o else next(ids) for o in odd]

    def _spans(self, raw: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(bytes, begins, ends, odd)`` of the sub-words of plain ASCII words, lower-cased, and of whole odd words."""
        kinds = self.kinds[raw]
        strange = np.flatnonzero(kinds == 4)
        low = self.small[raw]
        inside = None
        if len(strange):
            cuts = np.flatnonzero(np.diff(kinds != 0, prepend=False, append=False))
            words = np.unique(np.searchsorted(cuts[::2], strange, side="right") - 1)
            mark = np.zeros(len(raw) + 1, np.int8)
            mark[cuts[::2][words]] = 1
            mark[cuts[1::2][words]] = -1
            inside = np.cumsum(mark[:-1], dtype=np.int8).view(bool)
            kinds[inside] = 4
            low = np.where(inside, raw, low)
        change = np.diff(kinds, prepend=0, append=0) != 0
        digit = kinds == 2
        begins = np.flatnonzero((change[:-1] | digit) & (kinds != 0))
        ends = np.flatnonzero((change[1:] | digit) & (kinds != 0)) + 1
        return low, begins, ends, np.zeros(len(begins), bool) if inside is None else inside[begins]

    def texts(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts, some of them worked on together."""
        out, held, size = [], [], 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size > JOINED:
                out += self._together(held)
                held, size = [], 0
        return out + self._together(held)

    def _together(self, texts: list[str]) -> list[bytes]:
        coded = [t.encode() for t in texts]
        odd = [self.unusual(t, raw) for t, raw in zip(texts, coded)]
        # a line feed between texts: it ends a word
        plain = [raw + b"\n" for raw, o in zip(coded, odd) if not o]
        raw = np.frombuffer(b"".join(plain), np.uint8)
        low, begins, ends, strange = self._spans(raw)
        size = ends - begins
        table = self.pieces
        base = table.used  # what this step writes behind it is dropped again
        # a span of 16 bytes as two numbers
        low = np.concatenate([low, np.zeros(16, np.uint8)])
        pairs = np.lib.stride_tricks.sliding_window_view(low, 16)[begins].view("<u8")
        one = pairs[:, 0] & self.masks[np.minimum(size, 8)]
        two = pairs[:, 1] & self.masks[np.clip(size - 8, 0, 8)]
        mix = table.mixed(one, two)
        number = table.find(one, two, mix)
        short = size <= 16
        number[~short] = -1
        at, many = table.at[number], table.many[number]
        whole = low.tobytes()

        def cut(places: np.ndarray) -> list[bytes]:
            return [whole[a:b] for a, b in zip(begins[places].tolist(), ends[places].tolist())]

        long = np.flatnonzero(~short)
        if len(long):
            spans = cut(long)
            kind = dict(zip(spans, strange[long].tolist()))
            fresh = [w for w in kind if w not in self]
            self.update(zip(fresh, map(self.pack, self.learned(fresh, [kind[w] for w in fresh]))))
            held = [np.frombuffer(self[w], "<u4") for w in kind]
            order = dict(zip(kind, range(len(kind))))
            index = np.array([order[w] for w in spans])
            n = np.array([len(h) for h in held], np.int64)
            at[long], many[long] = (table.kept(np.concatenate(held)) + np.cumsum(n) - n)[index], n[index]
            if len(self) > CACHED_WORDS:
                for w in fresh:
                    del self[w]
        missed = np.flatnonzero((number < 0) & short)
        if len(missed):
            _, first, kinds = np.unique(mix[missed], return_index=True, return_inverse=True)
            like = missed[first][kinds]
            if (one[missed] != one[like]).any() or (two[missed] != two[like]).any():  # two spans share a hash
                both = np.stack([one[missed], two[missed]], 1)
                _, first, kinds = np.unique(both, axis=0, return_index=True, return_inverse=True)
                kinds = kinds.reshape(-1)
            new = missed[first]
            ids = self.learned(cut(new), strange[new].tolist())
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            place = table.kept(np.fromiter(chain.from_iterable(ids), np.uint32, int(n.sum()))) + np.cumsum(n) - n
            at[missed], many[missed] = place[kinds], n[kinds]
        flat = runs_of(table.ids, at, many).tobytes()
        after = np.concatenate([[0], np.cumsum(many)])
        table.used = base
        if len(missed):
            table.hold(one[new], two[new], mix[new], place, n)
        edges = np.cumsum([0, *map(len, plain)])
        parts = 4 * after[np.searchsorted(begins, edges)]
        cuts = iter(zip(parts[:-1].tolist(), parts[1:].tolist()))
        return [
            self.pack(self.encoder.encode(t, add_special_tokens=False).ids) if o else flat[slice(*next(cuts))]
            for t, o in zip(texts, odd)
        ]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


PIECES = T.StructType(
    [
        T.StructField("piece", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def tokenize_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    closing_id: int = CLOSING_ID,
    tokenizer_path: str | None = None,
) -> DataFrame:
    """Whole windows and the remainder of every document, written once with
    their ids (little-endian 16-bit where the vocabulary allows, else 32-bit)."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type), *PIECES.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        path = tokenizer_path or vocabulary_path()
        words = worker_cache(f"word-ids:{path}", lambda: WordIds(path))
        closing = np.array([closing_id], "<u4").tobytes()
        small = words.encoder.get_vocab_size() <= 1 << 16
        piece = TaskContext.get().partitionId() << 33
        for batch in slices(batches, 512):
            rows, size = [], 0
            texts = words.texts([t or "" for t in batch.column(1).to_pylist()])
            for doc, packed in zip(batch.column(0), texts):
                packed += closing
                n = len(packed) // 4
                for start in range(0, n, window):
                    ids = packed[4 * start : 4 * (start + window)]
                    held = np.frombuffer(ids, "<u4").astype("<u2").tobytes() if small else ids
                    rows.append((doc.as_py(), piece, start, len(ids) // 4, n, zlib.crc32(ids), held))
                    piece += 1
                    size += len(held)
                if size > 4 << 20:
                    yield packed_batch(rows)
                    rows, size = [], 0
            if rows:
                yield packed_batch(rows)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def packed_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], names=arrow.names)

    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return stage(narrow.mapInArrow(lean(run), schema), "pieces", codec="zstd")


Recipe = tuple[tuple[int, int], ...]  # (length, how often) of every length in a window


def fill_combinations(histogram: np.ndarray, window: int) -> list[Recipe]:
    """Recipes over present lengths that sum to ``window``: all singles and
    pairs; triples and quadruples of the lengths that hold most, with the one
    length that completes them; and one length as often as nearly fits, with one
    or two others. A recipe has four different lengths at most."""
    lengths = np.arange(len(histogram))
    most = [int(v) for v in np.argsort(-(histogram * lengths), kind="stable")[:window] if histogram[v] and v]
    present = set(most)
    found: set[Recipe] = set()

    def add(head: Sequence[int]) -> None:
        last = window - sum(head)
        if last in present or last == 0:
            counts = Counter(head)
            counts[last] += 1
            recipe = tuple(sorted(((n, k) for n, k in counts.items() if n), reverse=True))
            if all(histogram[n] >= k for n, k in recipe):
                found.add(recipe)

    add(())
    for depth, width in ((1, window), (2, 96), (3, 24)):
        for head in combinations_with_replacement(most[:width], depth):
            if sum(head) < window:
                add(head)
    for one in most[:96]:
        fit = min(window // one, int(histogram[one]))
        for times in range(fit, max(0, fit - 8), -1):
            add((one,) * times)
            for other in most[:24]:
                if times * one + other <= window:
                    add((one,) * times + (other,))
    return sorted(found, reverse=True)


def solve_counts(recipes: list[Recipe], histogram: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Non-negative least squares for the repeat counts: accelerated projected
    gradient on the sparse matrix of (length, recipe) multiplicities."""
    rows = np.array([length for recipe in recipes for length, _ in recipe])
    many = np.array([k for recipe in recipes for _, k in recipe], float)
    cols = np.repeat(np.arange(len(recipes)), [len(r) for r in recipes])
    forward = lambda x: np.bincount(rows, many * x[cols], len(histogram))
    back = lambda r: np.bincount(cols, many * r[rows], len(recipes))
    probe = np.ones(len(recipes))
    for _ in range(30):  # largest eigenvalue of A'A
        probe = back(forward(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    step = 1.0 / (1.05 * norm)
    x = y = np.zeros(len(recipes))
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(0.0, y - step * back(forward(y) - histogram))
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / s * (nxt - x)
        x, t = nxt, s
    return x


def plan_windows(histogram: np.ndarray, window: int = WINDOW) -> dict:
    """Which ranks of each length go to which window and offset.

    The counts of all recipes are solved for, rounded down (the largest up, if
    all are below one) and taken, and the rest is solved for again, until no
    recipe fits. ``slots[length]`` holds (first rank, first window, offset) by
    rank; ranks from ``used[length]`` on belong to the greedy stream, where the
    pieces of a length stand from ``base[length]`` on. ``ends`` closes the
    stream's last, partial window in powers of two.
    """
    left = histogram.astype(np.int64).copy()
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used = np.zeros_like(left)
    windows = 0

    def take(recipe: Recipe, times: int) -> None:
        nonlocal windows
        offset = 0
        for length, many in recipe:
            for _ in range(many):
                slots.setdefault(length, []).append((int(used[length]), windows, offset))
                used[length] += times
                offset += length
            left[length] -= times * many
        windows += times

    if len(left) > window and left[window]:
        take(((window, 1),), int(left[window]))
    while recipes := fill_combinations(left, window):
        counts = solve_counts(recipes, left.astype(float))
        least = min(1.0, counts.max())
        for at in np.argsort(-counts, kind="stable"):
            if counts[at] < least * 0.5:
                break
            fit = min(int(left[length]) // many for length, many in recipes[at])
            times = min(fit, max(1, int(counts[at])))
            if times > 0:
                take(recipes[at], times)
    base = np.zeros_like(left)
    total = 0
    for length in range(len(left) - 1, 0, -1):
        base[length] = total
        total += int(left[length]) * length
    tail, ends = total - total % window, []
    rest, at = total % window, tail
    while rest:
        part = 1 << (rest.bit_length() - 1)
        at, rest = at + part, rest - part
        ends.append(at)
    return {
        "slots": {k: np.array(v, np.int64) for k, v in slots.items()},
        "used": used,
        "base": base,
        "window": window,
        "windows": windows,
        "tail": tail,
        "ends": ends,
    }


def place(length: np.ndarray, rank: np.ndarray, plan: dict) -> tuple[np.ndarray, ...]:
    """``(piece, start in piece, length, window, offset)`` of every part of the given pieces."""
    out: list[tuple[np.ndarray, ...]] = []
    fixed = rank < plan["used"][length]
    for one in np.unique(length[fixed]):
        at = np.flatnonzero(fixed & (length == one))
        slots = plan["slots"][int(one)]
        slot = slots[np.searchsorted(slots[:, 0], rank[at], side="right") - 1]
        out.append((at, np.zeros_like(at), length[at], slot[:, 1] + rank[at] - slot[:, 0], slot[:, 2]))
    at = np.flatnonzero(~fixed)
    start = plan["base"][length[at]] + (rank[at] - plan["used"][length[at]]) * length[at]
    window, tail, ends = plan["window"], plan["tail"], np.array(plan["ends"], np.int64)
    done = np.zeros_like(at)
    while at.size:  # a part for each piece; what crosses the end of its window goes round again
        in_tail = start >= tail
        k = np.searchsorted(ends, start, side="right")
        first = np.where(in_tail, np.concatenate([[tail], ends])[k], start // window * window)
        last = np.where(in_tail, np.concatenate([ends, [0]])[k], first + window)
        part = np.minimum(length[at] - done, last - start)
        number = plan["windows"] + np.where(in_tail, tail // window + k, start // window)
        out.append((at, done, part, number, start - first))
        more = done + part < length[at]
        at, done, start = at[more], (done + part)[more], (start + part)[more]
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*out))


def pack(pieces: DataFrame, window: int = WINDOW, ids: bool = True) -> DataFrame:
    """Places of the pieces of :func:`tokenize_pieces`: ``id``, ``piece``,
    ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and
    ``offset``, and the ``ids`` themselves as in ``pieces`` unless ``ids`` is
    false. A sequence holds at most ``window`` ids, without gaps."""
    spark = pieces.sparkSession
    narrow = pieces.drop("ids")
    histogram = np.zeros(window + 1, np.int64)
    for length, n in narrow.groupBy("length").count().collect():  # at most ``window`` rows
        histogram[length] = n
    plan = plan_windows(histogram, window)
    # ranks count within a length: the sort has the shorter lengths first
    before = np.concatenate([[0], np.cumsum(histogram)[:-1]])
    ranked = order_totals(narrow, [F.col("length"), F.col("piece")], "length", "rank", "before")
    schema = T.StructType(
        [narrow.schema["id"]]
        + [T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32", "doc_tokens")]
        + [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset", "skip")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda n: batch.column(batch.schema.get_field_index(n))
            length = get("length").to_numpy()
            at, skip, part, number, offset = place(length, get("rank").to_numpy() - before[length], plan)
            taken = pa.array(at)
            whole = part == length[at]
            yield pa.RecordBatch.from_arrays(
                [
                    get("id").take(taken),
                    get("piece").take(taken),
                    pa.array(get("start").to_numpy()[at] + skip),
                    pa.array(part),
                    pa.array(get("ids_crc32").to_numpy()[at], pa.int64(), mask=~whole),
                    get("doc_tokens").take(taken),
                    pa.array(number),
                    pa.array(offset),
                    pa.array(skip),
                ],
                names=schema.names,
            )

    placed = stage(ranked.mapInArrow(lean(run), schema), "placed")
    if ids:
        return part_ids(pieces, placed).select(*schema.names[:-1], "ids")
    cut = placed.filter("ids_crc32 IS NULL")
    sliced = part_ids(pieces, cut, broadcast=cut.count() * 8 * len(schema.names) <= BROADCAST_BYTES)
    whole = placed.filter("ids_crc32 IS NOT NULL").select(*schema.names[:-1])
    return whole.unionByName(sliced.select(*schema.names[:-1]))


def part_ids(pieces: DataFrame, placed: DataFrame, broadcast: bool = False) -> DataFrame:
    """``placed`` parts (with ``skip``, their start within the piece) and their
    own ``ids``, little-endian as in ``pieces``; the checksum is taken anew."""
    names = [c for c in placed.columns if c not in ("piece", "ids_crc32")]
    listed = placed.select("piece", *[F.col(c).alias(f"__{c}") for c in names])
    joined = pieces.select("piece", "ids", F.col("length").alias("whole")).join(
        F.broadcast(listed) if broadcast else listed, "piece"
    )
    schema = T.StructType(
        [T.StructField("piece", T.LongType()), *[placed.schema[c] for c in names]]
        + [T.StructField("ids_crc32", T.LongType()), T.StructField("ids", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            get = lambda n: batch.column(batch.schema.get_field_index(n))
            sums, parts = [], []
            for ids, whole, skip, n in zip(*(get(c).to_pylist() for c in ("ids", "whole", "__skip", "__length"))):
                width = len(ids) // whole
                part = ids[width * skip : width * (skip + n)]
                sums.append(zlib.crc32(np.frombuffer(part, f"<u{width}").astype("<u4").tobytes()))
                parts.append(part)
            columns = [get("piece"), *[get(f"__{c}") for c in names], pa.array(sums, pa.int64()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(lean(run), schema)


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, ids: bool = True, **options
) -> DataFrame:
    """Tokenize and pack ``docs``: one row per piece with its place and, unless
    ``ids`` is false, its ids (little-endian, ``length`` of them). The ids of a
    ``sequence_id`` in the order of ``offset`` are a training sequence."""
    placed = pack(tokenize_pieces(docs, id_col, text_col, window, **options), window, ids)
    held = ["ids"] if ids else []
    return placed.select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *held
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents packed into sequences of at most 4096 tokens, by digest."""
    return pack_documents(table(spark, sf_dir, "documents"), ids=False)

"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages: stretches of ``PASSAGE`` bytes that together
cover the whole text, whatever its length (the last takes what is left over).
A passage is described by shares of byte
classes, hashed byte pairs, how varied it is and how often it repeats itself.
A small encoder maps every description to a hidden vector; gated attention

    a_k ~ exp(w . (tanh(V h_k) * sigmoid(U h_k)))

weighs the passages, and a linear layer scores the weighted sum. Every passage
is encoded; those of long documents stream through a running maximum, weight and
weighted sum. All of it is learned from document labels alone, by Adam in numpy,
on a bounded sample: the first ``SAMPLE`` labelled documents in hash order, with
at most ``PASSAGES`` passages of each, spread evenly over its text.

A null or empty text is one passage without bytes and gets a score like any
other. Without labels of both kinds the score is the known label, or 1/2.
Documents labelled more than once take their smallest label.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.common import fresh, lean, slices, table, with_fields
from metrolens.llm.language import remainder

SAMPLE = 4000  # labelled documents that the model may be fitted on
PASSAGE = 512  # bytes
PASSAGES = 64  # of a document that the model is fitted on
AT_ONCE = 256  # passages of a long document that are held at a time
BYTES_AT_ONCE = 1 << 16  # for words, which may be longer than a passage
PAIRS = 128  # buckets of byte pairs
HIDDEN = 32
ATTENTION = 16
EPOCHS = 30
BATCH = 64
RATE = 0.004
CUT = 0.3  # a document of this score or more is accepted

#: Class of each byte: letters by case, digits, white space, every ASCII sign by itself, bytes beyond ASCII.
SIGNS = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
CLASSES = 7 + len(SIGNS)
BYTE_CLASS = np.array(
    [
        0 if chr(b).islower() and b < 0x80
        else 1 if chr(b).isupper() and b < 0x80
        else 2 if chr(b).isdigit() and b < 0x80
        else 3 if b == 0x20
        else 4 if b == 0x0A
        else 5 if b >= 0x80
        else 7 + SIGNS.index(b) if b in SIGNS
        else 6
        for b in range(256)
    ],
    np.int64,
)
FEATURES = CLASSES + PAIRS + 5


def passage_count(n: int) -> int:
    return max(1, n // PASSAGE)  # the last passage takes what is left over


def _words(data: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Per passage: words, and words equal to the one before, where they begin."""
    n = len(data)
    words, again = np.ones(count), np.zeros(count)
    last, last_width = np.zeros(1, np.uint32), -1  # the word before
    held, held_width, held_place = np.zeros(1, np.uint32), 0, -1  # the word that is still open
    for a in range(0, n, BYTES_AT_ONCE):
        piece = data[a : a + BYTES_AT_ONCE].astype(np.uint32)
        space = np.flatnonzero((piece == 0x20) | (piece == 0x0A))
        edges = np.concatenate([[-1], space, [len(piece)]])
        sums = np.concatenate([np.zeros(1, np.uint32), np.cumsum(piece * piece, dtype=np.uint32)])
        word = sums[edges[1:]] - sums[edges[:-1] + 1]
        width = np.diff(edges) - 1
        word[:1] += held
        width[0] += held_width
        begun = np.minimum(np.minimum(space + a + 1, n - 1) // PASSAGE, count - 1)
        words += np.bincount(begun, minlength=count)
        place = np.concatenate([[held_place], begun])
        before, before_width = np.concatenate([last, word[:-1]]), np.concatenate([[last_width], width[:-1]])
        same = (word == before) & (width == before_width) & (width > 0)
        again += np.bincount(place[:-1][same[:-1]], minlength=count)
        if len(space):
            last, last_width = word[-2:-1], width[-2]
        held, held_width, held_place = word[-1:], width[-1], place[-1]
    if held_place >= 0 and held_width > 0 and held_width == last_width and held[0] == last[0]:
        again[held_place] += 1
    return words, again


def every_passage(text: bytes | None, at_once: int = AT_ONCE) -> Iterator[np.ndarray]:
    """One row of features per passage of the whole text, ``at_once`` rows at a time."""
    data = np.frombuffer(text or b"", np.uint8)
    n = len(data)
    if not n:
        yield np.zeros((1, FEATURES), np.float32)
        return
    total = passage_count(n)
    all_words, all_again = _words(data, total)
    for first in range(0, total, at_once):
        count = min(at_once, total - first)
        a, b = first * PASSAGE, n if first + count == total else (first + count) * PASSAGE
        back = min(a, 3)  # pairs and fours belong to the passage of their last byte
        here, near = data[a:b], data[a - back : b]
        owner = np.minimum(np.arange(b - a) // PASSAGE, count - 1)
        size = np.bincount(owner, minlength=count).astype(np.float64)
        kinds = np.bincount(owner * CLASSES + BYTE_CLASS[here], minlength=count * CLASSES).reshape(count, CLASSES)
        pair = ((near[:-1].astype(np.int64) * 31 + near[1:] * 17) % PAIRS)[max(back - 1, 0) :]
        pairs = np.bincount(owner[b - a - len(pair) :] * PAIRS + pair, minlength=count * PAIRS).reshape(count, PAIRS)
        # Variety: different four-byte hashes against bytes; repetition: words equal to the one before.
        slots = 1024
        seen = np.zeros(count * slots, bool)
        if len(near) > 3:
            wide = near.astype(np.uint32)
            four = wide[:-3] + wide[1:-2] * np.uint32(31) + wide[2:-1] * np.uint32(1009) + wide[3:] * np.uint32(40503)
            seen[owner[3 - back :] * slots + (four * np.uint32(2246822519) >> np.uint32(22))] = True
        variety = seen.reshape(count, slots).sum(axis=1) / np.minimum(size, slots)
        words, again = all_words[first : first + count], all_again[first : first + count]
        whole = np.full(count, np.log1p(n) / 12)
        rest = np.stack([variety, again / words, np.log1p(size) / 8, size / words / 16, whole], axis=1)
        shares = np.hstack([np.sqrt(kinds / size[:, None]), np.sqrt(pairs / size[:, None])])
        yield np.hstack([shares, rest]).astype(np.float32)


def passages(text: bytes | None) -> np.ndarray:
    """Features of a document to learn from: at most ``PASSAGES`` passages, spread evenly from first to last."""
    count = passage_count(len(text or b""))
    chosen = np.unique(np.linspace(0, count - 1, min(count, PASSAGES)).round().astype(np.int64))
    rows, first = [], 0
    for x in every_passage(text):
        rows.append(x[chosen[(chosen >= first) & (chosen < first + len(x))] - first])
        first += len(x)
    return np.concatenate(rows)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def encode(model: dict, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hidden vectors of passages, both sides of their gates and the logarithms of their weights."""
    h = np.tanh((x - model["mean"]) / model["scale"] @ model["W"] + model["b"])
    t, g = np.tanh(h @ model["V"]), _sigmoid(h @ model["U"])
    return h, t, g, (t * g) @ model["w"]


def score_stream(model: dict, chunks: Iterable[np.ndarray]) -> float:
    """As :func:`forward` for one document, whose passages come in chunks."""
    top, weight, pooled = -np.inf, 0.0, np.zeros(HIDDEN)
    for x in chunks:
        h, _, _, z = encode(model, x)
        new = max(top, z.max())
        e, kept = np.exp(z - new), np.exp(top - new)
        top, weight, pooled = new, weight * kept + e.sum(), pooled * kept + e @ h
    return float(_sigmoid(pooled / weight @ model["c"] + model["d"]))


def forward(model: dict, x: np.ndarray, bag: np.ndarray, bags: int) -> dict:
    """All layers for passages ``x`` of the documents ``bag`` (sorted, 0 to ``bags`` - 1)."""
    h, t, g, z = encode(model, x)
    first = np.searchsorted(bag, np.arange(bags))
    e = np.exp(z - np.maximum.reduceat(z, first)[bag])
    a = e / np.add.reduceat(e, first)[bag]
    pooled = np.add.reduceat(a[:, None] * h, first, axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "pooled": pooled, "score": _sigmoid(pooled @ model["c"] + model["d"])}


def fit(x: np.ndarray, bag: np.ndarray, labels: np.ndarray, seed: int = 11) -> dict:
    """Train the encoder, the gated attention and the scoring layer together."""
    rng = np.random.default_rng(seed)
    starts = np.searchsorted(bag, np.arange(len(labels) + 1))
    model = {
        "mean": x.mean(axis=0).astype(np.float64),
        "scale": x.std(axis=0).astype(np.float64) + 0.02,
        "W": rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)),
        "b": np.zeros(HIDDEN),
        "V": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, ATTENTION)),
        "U": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, ATTENTION)),
        "w": np.zeros(ATTENTION),
        "c": np.zeros(HIDDEN),
        "d": np.zeros(()),
    }
    learned = ("W", "b", "V", "U", "w", "c", "d")
    m1 = {k: np.zeros_like(model[k]) for k in learned}
    m2 = {k: np.zeros_like(model[k]) for k in learned}
    step, batches = 0, max(1, -(-len(labels) // BATCH))
    for _ in range(EPOCHS):
        for docs in np.array_split(rng.permutation(len(labels)), batches):
            docs = np.sort(docs)
            rows = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in docs])
            own = np.repeat(np.arange(len(docs)), starts[docs + 1] - starts[docs])
            grads = _gradients(model, x[rows], own, labels[docs])
            step += 1
            rate = RATE * (1 - step / (EPOCHS * batches + 1))
            for k in learned:
                m1[k] = 0.9 * m1[k] + 0.1 * grads[k]
                m2[k] = 0.999 * m2[k] + 0.001 * grads[k] ** 2
                model[k] = model[k] - rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _gradients(model: dict, x: np.ndarray, bag: np.ndarray, labels: np.ndarray) -> dict:
    """Of the mean cross-entropy plus a small weight decay."""
    f = forward(model, x, bag, len(labels))
    gap = (f["score"] - labels) / len(labels)
    out = {"c": f["pooled"].T @ gap, "d": gap.sum()}
    pooled = gap[:, None] * model["c"][None, :]
    along = (pooled[bag] * f["h"]).sum(axis=1)
    first = np.searchsorted(bag, np.arange(len(labels)))
    z = f["a"] * (along - np.add.reduceat(f["a"] * along, first)[bag])
    gate = z[:, None] * model["w"][None, :]
    out["w"] = (f["t"] * f["g"]).T @ z
    dt = gate * f["g"] * (1 - f["t"] ** 2)
    dg = gate * f["t"] * f["g"] * (1 - f["g"])
    out["V"], out["U"] = f["h"].T @ dt, f["h"].T @ dg
    h = f["a"][:, None] * pooled[bag] + dt @ model["V"].T + dg @ model["U"].T
    inner = h * (1 - f["h"] ** 2)
    out["W"] = ((x - model["mean"]) / model["scale"]).T @ inner
    out["b"] = inner.sum(axis=0)
    return {k: v + (1e-5 * model[k] if k != "d" else 0) for k, v in out.items()}


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> dict:
    """Fit on a bounded sample of ``labels`` rows where ``learn`` (over the id)
    holds. Only the sample's passages reach the driver, at most 64 a document."""
    known = (
        labels.filter(learn & F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull())
        .groupBy(F.col(f"`{id_col}`").alias("id"))
        .agg(F.min(f"`{label_col}`").cast("int").alias("label"))
    )
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            texts, marks = (c.to_pylist() for c in batch.columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array([passages(t).tobytes() for t in texts], pa.binary()), pa.array(marks, pa.int32())],
                names=["x", "label"],
            )

    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").select("text", "label").limit(SAMPLE)
    got = sample.mapInArrow(lean(run), "x binary, label int").toArrow()
    bags = got.column("x").to_pylist()
    marks = got.column("label").to_pylist()
    order = sorted(range(len(bags)), key=lambda i: (bags[i], marks[i]))  # tasks end in any order
    bags, y = [bags[i] for i in order], np.array([marks[i] for i in order], np.float64)
    if len(set(marks)) < 2:
        return {"constant": float(y[0]) if len(y) else 0.5}
    sizes = [len(b) // (4 * FEATURES) for b in bags]
    x = np.frombuffer(b"".join(bags), np.float32).reshape(-1, FEATURES)
    return fit(x, np.repeat(np.arange(len(bags)), sizes), y)


def score_texts(model: dict, texts: list[bytes | None]) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    if not texts:
        return np.zeros(0)
    scores = np.zeros(len(texts))
    short = [i for i, t in enumerate(texts) if passage_count(len(t or b"")) <= PASSAGES]
    if short:
        bags = [next(every_passage(texts[i])) for i in short]
        own = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        scores[short] = forward(model, np.concatenate(bags), own, len(bags))["score"]
    for i in sorted(set(range(len(texts))).difference(short)):
        scores[i] = score_stream(model, every_passage(texts[i]))
    return scores


def with_quality(docs: DataFrame, model: dict, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text; other columns unchanged."""
    (at_name,) = fresh(docs, name)
    schema = with_fields(docs.schema, [(at_name, T.DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score_texts(model, texts), pa.float64())], names=schema.names
            )

    return docs.mapInArrow(lean(run), schema)


def accepted(docs: DataFrame, model: dict, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that the model accepts, columns unchanged."""
    (score,) = fresh(docs, "score")
    scored = with_quality(docs, model, text_col, score)
    return scored.filter(F.col(score) >= cut).select(*[F.col(f"`{c}`") for c in docs.columns])


def learnable(doc_id: Column) -> Column:
    """Documents that labels may be learned from: the id's remainder modulo 5 is not 0."""
    return F.coalesce(remainder(doc_id, 5) != 0, F.lit(False))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the quality of every document, learned from the labels
    whose id's remainder modulo 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), learnable(F.col("doc_id")))
    scored = with_quality(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )

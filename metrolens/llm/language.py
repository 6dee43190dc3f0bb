"""Language identification by averaged hashed subword embeddings.

A text's words are cut into overlapping subwords of two to four bytes, word
edges included, and each subword hashes to one of a fixed number of buckets. A
bucket has an embedding; a text is the average of its subwords' embeddings, and
a linear softmax over that average gives the languages. Both are trained by
stochastic gradient descent in numpy on a bounded sample of labelled texts: the
``PER_LANG`` first of each language in hash order, ``SAMPLE`` in all. Part of
the sample is kept from training to fit the softmax's temperature and the score
below which a prediction is rejected.

Whole texts are read, in training and in prediction. A null text, or one
without a letter, is ``und`` with score 0. Without any labelled text every
text is ``und``. Rows with a null language are never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from metrolens.llm.common import fresh, lean, slices, table, with_fields

SAMPLE = 4000  # texts that the model may be fitted on
PER_LANG = 600  # of them in one language
BUCKETS = 4096
WIDTH = 16  # of an embedding
ORDERS = (2, 3, 4)  # bytes of a subword
EPOCHS = 12
BATCH = 32
RATE = 8.0
KEPT_OUT = 0.2  # of the sample, for calibration
TRUSTED = 0.99  # share of kept-out predictions at or above the rejection score that are right
UNKNOWN = "und"

#: ASCII bytes that are no letters become spaces.
EDGES = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def subword_counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket's subwords stand in the lower-cased text."""
    words = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(EDGES).split())
    if not words:
        return np.zeros(buckets, np.float32)
    data = np.frombuffer(b" " + words + b" ", np.uint8)
    edge = data == 0x20
    out = np.zeros(buckets, np.int64)
    rolled = data.astype(np.uint32)
    inner = np.zeros(len(data), bool)
    mixed = rolled.copy()
    for order in range(2, max(ORDERS) + 1):
        # mixed[i] covers the bytes i to i + order - 1; no edge may stand between its first and last
        mixed = mixed[:-1] * np.uint32(0x01000193) + rolled[order - 1 :]
        if order > 2:
            inner = inner[:-1] | edge[order - 2 : len(edge) - 1]
        else:
            inner = np.zeros(len(mixed), bool)
        if not len(mixed):
            break
        if order in ORDERS:
            hashed = (mixed[~inner] + np.uint32(order)) * np.uint32(0x9E3779B1)
            out += np.bincount((hashed >> np.uint32(15)) % np.uint32(buckets), minlength=buckets)
    return out.astype(np.float32)


def averages(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(1.0, counts.sum(axis=1, keepdims=True))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(counts: np.ndarray, labels: list[str], seed: int = 7) -> dict:
    """Train on rows of bucket counts; returns the classes, the folded table
    (a row of logits per bucket), the bias, the temperature and the rejection score."""
    rng = np.random.default_rng(seed)
    classes = sorted(set(labels))
    y = np.array([classes.index(v) for v in labels])
    x = averages(counts)
    order = rng.permutation(len(x))
    out = order[: int(len(x) * KEPT_OUT)] if len(x) >= 20 else order[:0]
    train = np.setdiff1d(order, out)
    embed = rng.normal(0, 1 / np.sqrt(WIDTH), (x.shape[1], WIDTH))
    weight = np.zeros((WIDTH, len(classes)))
    bias = np.zeros(len(classes))
    steps = max(1, EPOCHS * -(-len(train) // BATCH))
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(train), max(1, -(-len(train) // BATCH))):
            rate = RATE * (1 - step / steps)
            step += 1
            xb = x[rows]
            hidden = xb @ embed
            gap = softmax(hidden @ weight + bias)
            gap[np.arange(len(rows)), y[rows]] -= 1
            gap /= len(rows)
            back = gap @ weight.T
            weight -= rate * (hidden.T @ gap)
            bias -= 0.1 * rate * gap.sum(axis=0)
            embed -= 20 * rate * (xb.T @ back)
    model = {"classes": classes, "logits": embed @ weight, "bias": bias, "heat": 1.0, "reject": 0.0}
    if len(out):
        raw = x[out] @ model["logits"] + bias
        heats = np.geomspace(0.1, 10, 41)
        loss = [-np.log(softmax(raw / t)[np.arange(len(out)), y[out]] + 1e-12).mean() for t in heats]
        model["heat"] = float(heats[int(np.argmin(loss))])
        p = softmax(raw / model["heat"])
        model["reject"] = rejection_score(p.max(axis=1), p.argmax(axis=1) == y[out])
    return model


def rejection_score(scores: np.ndarray, right: np.ndarray) -> float:
    """The smallest score such that of the predictions at or above it the trusted share is right."""
    order = np.argsort(-scores, kind="stable")
    good = np.cumsum(right[order]) >= TRUSTED * np.arange(1, len(order) + 1)
    return float(scores[order[np.flatnonzero(good)[-1]]]) if good.any() else 1.0


def predict(texts: list[str | None], model: dict | None) -> tuple[list[str], list[float]]:
    """Best language and calibrated score of every text."""
    names, scores = [], []
    for text in texts:
        if model is None or text is None or not has_letter(text):
            names.append(UNKNOWN)
            scores.append(0.0)
            continue
        x = averages(subword_counts(text, len(model["logits"]))[None, :])
        p = softmax((x @ model["logits"] + model["bias"]) / model["heat"])[0]
        names.append(model["classes"][int(p.argmax())])
        scores.append(float(p.max()))
    return names, scores


def train(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> dict | None:
    """Fit on a bounded sample of the rows where ``learn`` holds and the language
    is known; None if there are none. Only the sample's bucket counts reach the driver."""
    known = docs.filter(learn & F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")
    )
    known = known.withColumn("deal", F.xxhash64("id", "lang"))
    # The hash deals a few times what is wanted of each language, so the ranking below is of few rows.
    # No more languages than texts can be learned: the commonest, at most SAMPLE rows.
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("of_lang"))
    counts = F.broadcast(counts.orderBy(F.desc("of_lang"), "lang").limit(SAMPLE))
    share = F.pmod(F.xxhash64("deal"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    dealt = known.select("id", "lang", "deal").join(counts, "lang").filter(share * F.col("of_lang") < 4 * PER_LANG)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("deal", "id"))
    chosen = dealt.withColumn("nth", nth).filter(F.col("nth") <= PER_LANG)
    chosen = chosen.orderBy("nth", "lang").limit(SAMPLE).select("id", "lang").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pairs = zip(*(c.to_pylist() for c in batch.columns))
            rows = [(subword_counts(t), v) for t, v in pairs if t and has_letter(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c.tobytes() for c, _ in rows], pa.binary()), pa.array([v for _, v in rows], pa.string())],
                names=["counts", "lang"],
            )

    texts = known.join(F.broadcast(chosen), ["id", "lang"], "left_semi").select("text", "lang")
    sample = texts.limit(SAMPLE).mapInArrow(lean(run), "counts binary, lang string").toArrow()
    if not sample.num_rows:
        return None
    packed = sample.column("counts").combine_chunks().to_pylist()
    counts = np.frombuffer(b"".join(packed), np.float32).reshape(len(packed), -1)
    langs = sample.column("lang").to_pylist()
    # Tasks end in any order: the model must not depend on it.
    order = sorted(range(len(packed)), key=lambda i: (langs[i], packed[i]))
    return fit(counts[order], [langs[i] for i in order])


def with_language(docs: DataFrame, model: dict | None, text_col: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` (a score under the calibrated one)."""
    kept = [c for c in docs.columns if not (drop_text and c == text_col)]
    name, score, rejected = fresh(docs.select(*[F.col(f"`{c}`") for c in kept]), "lang_pred", "score", "rejected")
    fields = [(name, T.StringType()), (score, T.DoubleType()), (rejected, T.BooleanType())]
    schema = with_fields(docs.select(*[F.col(f"`{c}`") for c in kept]).schema, fields)
    at = len(kept)
    limit = model["reject"] if model else 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, scores = predict(batch.column(at).to_pylist(), model)
            flags = [s < limit for s in scores]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(flags)],
                names=schema.names,
            )

    text = F.col(f"`{text_col}`").alias("__text")
    return docs.select(*[F.col(f"`{c}`") for c in kept], text).mapInArrow(lean(run), schema)


def remainder(doc_id: Column, parts: int) -> Column:
    """CRC-32 of the id as text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: predicted language of every document, learned from the
    documents whose id's remainder modulo 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    model = train(docs, ~held_out)
    found = with_language(docs.select("doc_id", "text"), model, drop_text=True)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


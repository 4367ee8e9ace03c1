"""Language ID (operator 1): averaged hashed subword embeddings with a linear softmax.

Subwords are character n-grams over letters (everything else is a word edge), hashed into a fixed number of
buckets. A text is the average of its subwords' embeddings; a linear layer and a softmax give
the language. The model is trained by stochastic gradient descent in numpy on a bounded sample of
labelled rows (``PER_LABEL`` documents of each label, chosen by a hash, each with a few short excerpts); a part
of the sample is kept from training to fit a temperature, which makes scores probabilities, and the score
below which a prediction is rejected. For prediction the embeddings are folded into one table of
buckets x labels, which is broadcast; whole texts are read, in pieces if very long.

Defined cases: a null text or one without a letter is ``und`` with score 0; a null label is never
learned from; a null id counts as the empty string when folds are dealt; repeated rows get equal results, and
an id enters the sample once; ties between labels go to the first in sorted order; without any labelled
row everything is ``und``; an empty table gives an empty table; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, col, slices

BITS, ORDERS, DIM = 14, (1, 2, 3, 4), 16
#: Documents of each label that the model may learn from, and excerpts made of each.
PER_LABEL, EXCERPTS = 600, 4
PIECE = 1 << 20
LETTER = regex.compile(r"\p{L}")
_MULTIPLIER, _FINISH = np.uint32(0x01000193), np.uint32(0x9E3779B1)


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x3000)])


IS_LETTER = _letters()


def buckets(text: str) -> np.ndarray:
    """Buckets of all subwords of the text, of every order."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    low = codes < len(IS_LETTER)
    codes = np.where(low & ~IS_LETTER[np.where(low, codes, 0)], np.uint32(32), codes)
    edge = codes == 32
    codes = codes[~(edge & np.concatenate([[False], edge[:-1]]))]      # runs of edges are one edge
    out, gram = [], codes
    for n in range(1, max(ORDERS) + 1):
        if n > 1:
            gram = gram[:-1] * _MULTIPLIER + codes[n - 1:]
        if n in ORDERS and len(gram):
            out.append(((gram ^ (gram >> np.uint32(15))) * _FINISH + np.uint32(n) * _MULTIPLIER) * _FINISH >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.empty(0, "u4")


def counts(text: str) -> np.ndarray:
    """How often each bucket occurs; very long texts in pieces that overlap by the longest subword less one."""
    if len(text) <= PIECE:
        return np.bincount(buckets(text), minlength=1 << BITS)
    total = np.zeros(1 << BITS, "i8")
    for at in range(0, len(text), PIECE):
        total += np.bincount(buckets(text[at:at + PIECE]), minlength=1 << BITS)
    return total


def excerpts(text: str, n: int, rng: np.random.Generator) -> list[str]:
    words = text.split()
    out = []
    for _ in range(n if len(words) > 1 else 0):
        size = int(rng.integers(1, min(len(words), 12) + 1))
        at = int(rng.integers(0, len(words) - size + 1))
        out.append(" ".join(words[at:at + size]))
    return out


class Model:
    """Labels, the folded table (buckets x labels), the bias, the temperature and the rejection score."""

    def __init__(self, labels: list[str], table: np.ndarray, bias: np.ndarray) -> None:
        self.labels, self.table, self.bias, self.temperature, self.reject = labels, table, bias, 1.0, 0.0

    def logits(self, hits: np.ndarray) -> np.ndarray:
        return hits @ self.table / max(1, hits.sum()) + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.labels or not LETTER.search(text):
            return "und", 0.0
        if len(text) < 2000:      # few subwords: their rows of the table, without the whole histogram
            b = buckets(text)
            logits = self.table[b].sum(0) / max(1, len(b)) + self.bias
        else:
            logits = self.logits(counts(text))
        p = self.probabilities(logits)
        k = int(p.argmax())
        return self.labels[k], float(p[k])


Row = tuple[str, np.ndarray, np.ndarray]


def train(rows: list[Row], calibration: list[Row], epochs: int = 8, rate: float = 4.0, keep: float = 0.99, seed: int = 7) -> Model:
    """Stochastic gradient descent over (label, buckets, counts) rows of arrays; ``calibration`` fits the temperature and the
    score that ``keep`` of the rows predicted right reach."""
    labels = sorted({r[0] for r in rows})
    code = {x: i for i, x in enumerate(labels)}
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM))
    out, bias = rng.normal(0, 0.5, (DIM, len(labels))), np.zeros(len(labels))
    data = [(code[y], i, c / c.sum()) for y, i, c in rows if len(i)]
    steps, done = max(1, epochs * len(data)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            y, idx, w = data[k]
            lr = rate * (1 - done / steps)
            done += 1
            hidden = w @ emb[idx]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= 0.1 * lr * np.outer(hidden, p)
            bias -= 0.01 * lr * p
            emb[idx] -= lr * w[:, None] * back
    model = Model(labels, emb @ out, bias)
    known = [(code[y], i, c / c.sum()) for y, i, c in calibration if len(i) and y in code]
    if known:
        z = np.array([w @ model.table[i] + model.bias for _, i, w in known])
        y = np.array([k for k, _, _ in known])

        def loss(t: float) -> float:
            model.temperature = t
            return -float(np.log(np.maximum(model.probabilities(z)[np.arange(len(y)), y], 1e-12)).mean())

        model.temperature = min(np.geomspace(0.05, 20, 120), key=loss)
        p = model.probabilities(z)
        right = np.sort(p.max(1)[p.argmax(1) == y])
        if len(right):
            model.reject = float(right[int((1 - keep) * len(right))])
    return model


def numpy_lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        values, at = chunk.values.to_numpy(zero_copy_only=False), chunk.offsets.to_numpy()
        out += [values[a:b] for a, b in zip(at, at[1:])]
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        per_label: int = PER_LABEL, usable: Column | None = None) -> Model:
    """A model of the rows of ``docs`` that are ``usable`` (a condition) and have a label.

    The driver receives at most ``per_label`` ids of each label, then their bucket counts, never texts.
    """
    spark = docs.sparkSession
    ids = docs.where(usable) if usable is not None else docs
    ids = ids.select(col(docs, id_col).alias("id"), col(docs, label_col).cast("string").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    sizes = {r.y: r["count"] for r in ids.groupBy("y").count().collect()}        # one row per label
    if not sizes:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0))
    # a little more than enough by a threshold on the hash, so that the window sees a bounded number of rows of any label
    share = spark.createDataFrame([(y, min(1.0, (1.2 * per_label + 50) / n)) for y, n in sorted(sizes.items())], "y string, share double")
    few = (ids.join(F.broadcast(share), "y").where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < F.col("share") * float(1 << 40))
           .select("id", "y").distinct())
    by_hash = Window.partitionBy("y").orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 40)), "id")
    chosen = few.withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= per_label).select("id", "y").collect()
    if not chosen:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0))
    picked = spark.createDataFrame([(r.id, r.y) for r in chosen], ids.schema)
    source = docs.select(col(docs, id_col).alias("id"), col(docs, label_col).cast("string").alias("y"), col(docs, text_col).alias("t"))
    source = source.join(F.broadcast(picked), ["id", "y"]).dropDuplicates(["id", "y"])     # bounded by ``per_label``

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for y, text, h in zip(*(c.to_pylist() for c in b.columns)):
                if not text or not LETTER.search(text):
                    continue
                rng = np.random.default_rng(h & 0xFFFFFFFF)
                for part in [text, *excerpts(text, EXCERPTS, rng)]:
                    n = counts(part)
                    at = np.flatnonzero(n)
                    rows.append((y, h, at.astype("i4"), n[at].astype("i4")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int32())), pa.array([r[3] for r in rows], pa.list_(pa.int32()))],
                ["y", "h", "at", "n"])

    made = arrow_map(source.select("y", "t", F.xxhash64("id").alias("h")), run, "y string, h long, at array<int>, n array<int>")
    made = made.toArrow()
    made = [(y, h, np.array(i, "i4"), np.array(c, "i4")) for y, h, i, c in zip(
        made["y"].to_pylist(), made["h"].to_pylist(), numpy_lists(made["at"]), numpy_lists(made["n"]))]
    # the order of the rows that came must not matter: it decides the steps of the descent
    made.sort(key=lambda r: (r[1], r[0], len(r[2]), r[2].tobytes(), r[3].tobytes()))
    rows = [(y, i, c) for y, h, i, c in made if h % 5]
    return train(rows or [(y, i, c) for y, _, i, c in made], [(y, i, c) for y, h, i, c in made if not h % 5])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted), one row per row of ``docs``; a caller that wants rejection puts ``und``
    where ``accepted`` is false."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # buckets x labels numbers
    source = docs.select(col(docs, id_col).alias("id"), col(docs, text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches):
            found = [m.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64()),
                 pa.array([x != "und" and s >= m.reject for x, s in found], pa.bool_())], ["id", "lang_pred", "score", "accepted"])

    schema = source.select("id").schema.add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    return arrow_map(source, run, schema)


def fold(id_col: Column, n: int) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % n


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs, usable=fold(F.col("doc_id"), 3) != 1)
    out = predict(docs, model)
    return out.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 3) == 1).alias("held_out"), "lang_pred", "score", "accepted")

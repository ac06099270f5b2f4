"""Language identification with a blended-spectrum string kernel.

Kernel: for each n-gram order, the number of distinct byte n-grams that two texts share (presence, not counts), divided
by the root of the product of their own numbers; the orders' kernels are summed.  n-grams of orders above 2 are hashed
to 16 bits.  ASCII letters are lower-cased; digits, punctuation and white space are one blank.

Model: m landmarks of the training sample give the Nyström features K_xm; one-versus-rest ridge regression on them,
(K_nm' K_nm + lambda K_mm) a = K_nm' y, is kernel ridge regression in the landmarks' span.  As the kernel is a sum of inner
products of presence vectors, K_xm a is one matrix product of a batch's scaled presence matrix and the folded weights.

The training sample is bounded: at most `per_label` whole texts a label, the rows with the smallest hashes, drawn over
all rows; every label is learned.  Landmarks grow with the labels: `LABEL_MARKS` a label, if that is more.  Prediction reads every text whole, in blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktel.llm import texthash as th
from sparktel.llm.common import fits_broadcast, tidied, written

ORDERS = (2, 3, 4)
WIDTH = 1 << 16
UND = "und"
_BLANK = 32
_FOLD = np.full(256, _BLANK, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_ASCII_LETTER = _FOLD[:] != _BLANK
_ASCII_LETTER[128:] = False
#: Landmarks a label at least, as far as its texts go.
LABEL_MARKS = 8
#: Landmarks whose kernel columns are computed at once.
MARKS = 640
#: Texts scored by one matrix product.
ROWS = 32


def presence(data: np.ndarray, out: np.ndarray) -> None:
    """Set out[o, code] for each n-gram of a text, blanks collapsed, a blank at both ends; whatever its length."""
    out[:] = 0
    before = np.array([_BLANK], np.uint32)  # the last symbols of what came before, which the next n-grams begin with
    for lo in range(0, max(len(data), 1), th.BLOCK_BYTES):
        part = data[lo : lo + th.BLOCK_BYTES]
        b = np.concatenate([before, _FOLD[part], [_BLANK] * (lo + th.BLOCK_BYTES >= len(data))]).astype(np.uint32)
        b = b[np.concatenate([[True], (b[1:] != _BLANK) | (b[:-1] != _BLANK)])]
        before = b[1 - max(ORDERS) :]
        two = b[:-1] << np.uint32(8) | b[1:]
        out[0, two] = 1
        if len(b) > 2:
            three = (two[:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435769) >> np.uint32(16)
            out[1, three] = 1
        if len(b) > 3:
            four = (two[:-2] << np.uint32(16) | two[2:]) * np.uint32(2246822519) >> np.uint32(16)
            out[2, four] = 1


def has_letter(raw: np.ndarray) -> bool:
    """Whether a text has a character of Unicode's letter categories."""
    if _ASCII_LETTER[raw].any():
        return True
    return bool((raw >= 128).any()) and any(c.isalpha() for c in raw.tobytes().decode("utf-8", "ignore"))


@dataclass
class Model:
    """labels, and weights of each order's scaled presence (orders * WIDTH, labels); scale turns margins into a score."""

    labels: list[str]
    weights: np.ndarray
    scale: float

    def scores(self, flags: np.ndarray) -> np.ndarray:
        """Margins of a batch of presence matrices (rows, orders, WIDTH)."""
        own = np.sqrt(np.maximum(flags.sum(axis=2, dtype=np.float32), 1))
        total = np.zeros((len(flags), len(self.labels)), np.float32)
        for o in range(len(ORDERS)):
            total += flags[:, o].astype(np.float32) @ self.weights[o * WIDTH : (o + 1) * WIDTH] / own[:, o : o + 1]
        return total


def draw(docs: DataFrame, key: Column, label: Column, body: Column, held_out: Column, per_label: int, most_labels: int | None = None) -> list[tuple[str, bytes]]:
    """The bounded sample as (label, packed and deflated presence), sorted: a label's rows with the smallest key hashes."""
    rows = docs.select(label.alias("label"), body.alias("text"), F.xxhash64(key.cast("string"), F.lit(3)).alias("h")).where(~held_out & label.isNotNull() & body.isNotNull())
    counts = rows.groupBy("label").count()
    if most_labels is not None:
        counts = counts.orderBy(F.desc("count"), "label").limit(most_labels)
    # A threshold a label on the uniform hash: about 1.25 * per_label rows pass, wherever they are.
    span = float(1 << 64)
    counts = written(docs.sparkSession, counts.select("label", F.least(F.lit(1.0), F.lit(1.25 * per_label + 8) / F.col("count")).alias("limit")), "labels")
    if fits_broadcast(counts, 64, 16 << 20):
        counts = F.broadcast(counts)
    rows = rows.join(counts, "label").where((F.col("h").cast("double") + span / 2) / span < F.col("limit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros((len(ORDERS), WIDTH), np.uint8)
        for batch in batches:
            data, offs = th.string_buffers(batch.column(1))
            packed, good = [], []
            for r in range(batch.num_rows):
                raw = data[offs[r] : offs[r + 1]]
                good.append(has_letter(raw))
                if good[-1]:
                    presence(raw, flags)
                    packed.append(zlib.compress(np.packbits(flags).tobytes(), 1))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(2).filter(keep), pa.array(packed, pa.binary())], ["label", "h", "packed"])

    got: dict[str, list[tuple[int, bytes]]] = {}
    for r in rows.select("label", "text", "h").mapInArrow(tidied(run), "label string, h bigint, packed binary").toLocalIterator():
        got.setdefault(r["label"], []).append((r["h"], bytes(r["packed"])))
    return [(k, p) for k in sorted(got) for _, p in sorted(got[k])[:per_label]]


def train(sample: list[tuple[str, bytes]], landmarks: int = 160, ridge: float = 1e-2) -> Model:
    """Landmarks are dealt evenly to the labels, `LABEL_MARKS` each at least; deterministic in the sample."""
    labels = sorted({k for k, _ in sample})
    if not labels:
        return Model([], np.zeros((len(ORDERS) * WIDTH, 0), np.float32), 1.0)
    place = {k: i for i, k in enumerate(labels)}
    y = np.array([place[k] for k, _ in sample])
    landmarks = max(landmarks, LABEL_MARKS * len(labels))
    turn = np.concatenate([np.arange((y == c).sum()) for c in range(len(labels))])
    marks = np.sort(np.argsort(turn, kind="stable")[:landmarks])

    def rows(which: np.ndarray, order: int) -> np.ndarray:
        """Scaled presence of one order; one order at a time bounds the driver's memory."""
        size = WIDTH // 8
        flags = np.stack([np.unpackbits(np.frombuffer(zlib.decompress(sample[i][1]), np.uint8, size, order * size)) for i in which]).astype(np.float32)
        flags /= np.sqrt(np.maximum(flags.sum(axis=1, keepdims=True), 1))
        return flags

    knm = np.zeros((len(sample), len(marks)))
    for o in range(len(ORDERS)):
        for first in range(0, len(marks), MARKS):
            base = rows(marks[first : first + MARKS], o).T
            for lo in range(0, len(sample), 64):
                which = np.arange(lo, min(lo + 64, len(sample)))
                knm[which, first : first + MARKS] += rows(which, o) @ base
    kmm = knm[marks]
    target = np.where(y[:, None] == np.arange(len(labels))[None, :], 1.0, -1.0)
    weight = 1.0 / np.bincount(y)[y][:, None]  # each label weighs the same
    left = knm.T @ (knm * weight) + ridge * kmm / len(marks) * len(labels) + 1e-9 * np.eye(len(marks)) * np.trace(kmm)
    alpha = np.linalg.solve(left, knm.T @ (target * weight)).astype(np.float32)
    weights = np.zeros((len(ORDERS) * WIDTH, len(labels)), np.float32)
    for o in range(len(ORDERS)):
        for first in range(0, len(marks), MARKS):
            weights[o * WIDTH : (o + 1) * WIDTH] += rows(marks[first : first + MARKS], o).T @ alpha[first : first + MARKS]
    return Model(labels, weights, 4.0)


def fit(docs: DataFrame, key: str = "doc_id", label: str = "lang", body: str = "text", per_label: int = 200, most_labels: int | None = None, landmarks: int = 160) -> Model:
    """Learn from the rows that held_out() leaves; all labels, or the `most_labels` commonest."""
    sample = draw(docs, docs[key], docs[label].cast("string"), docs[body].cast("string"), held_out(docs[key]), per_label, most_labels)
    return train(sample, landmarks)


def held_out(key: Column) -> Column:
    """crc32 of the key as text divides by 5; a null key counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def predict(docs: DataFrame, model: Model, body: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of docs and the two named, which must not clash: the best label and a softmax of the margins.

    `und` with score 0 for a null text or one without a letter, and wherever no label was learned; ties go to the
    first label in sorted order; repeated rows are scored alike; an empty table gives an empty one.
    """
    if {n.lower() for n in names} & {c.lower() for c in docs.columns}:
        raise ValueError("docs has a column of that name")
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, flags = held.value, np.zeros((ROWS, len(ORDERS), WIDTH), np.uint8)
        for batch in batches:
            data, offs = th.string_buffers(batch.column(at_text))
            best, score = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            for lo in range(0, batch.num_rows, ROWS):
                at = [r for r in range(lo, min(lo + ROWS, batch.num_rows)) if m.labels and has_letter(data[offs[r] : offs[r + 1]])]
                for i, r in enumerate(at):
                    presence(data[offs[r] : offs[r + 1]], flags[i])
                if at:
                    margin = m.scores(flags[: len(at)]) * m.scale
                    e = np.exp(margin - margin.max(axis=1, keepdims=True))
                    best[at] = margin.argmax(axis=1)
                    score[at] = e.max(axis=1) / e.sum(axis=1)
            label = pa.array([m.labels[i] if i >= 0 else UND for i in best.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], label, pa.array(score)], [*[f"c{i}" for i in range(width)], "l", "s"])

    # The text travels once where it is a column of strings already.
    width, sent = len(docs.columns), [docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]
    at_text = docs.columns.index(body) if docs.schema[body].dataType.simpleString() == "string" else width
    plain = docs.select(*sent, *[docs[body].cast("string").alias("b")] * (at_text == width))
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    return plain.mapInArrow(tidied(run), f"{schema}, l string, s double").toDF(*docs.columns, *names)

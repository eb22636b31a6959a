"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL.

A text's features are its tokens, pairs of tokens, and pairs and triples that come back to
their first token whatever it is, hashed to ``DIM`` cells; a feature's value is its share of
the text times ``SCALE``. Training is iterative parameter mixing: the
labelled documents, at most ``SAMPLE`` of them (those whose ids have the least hashes), are dealt to ``SHARDS``
groups of bounded size; each runs follow-the-regularised-leader over its rows, and the
averages of the weights are the model. It is ``DIM`` floats, 1 MB, whatever the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from railyard.llm.common import in_worker, lean, small_batches, trim, text_of, thin_out

DIM = 1 << 18
SCALE = 30.0
SAMPLE, SHARDS, EPOCHS = 16_384, 8, 3
RETURNS = (DIM - 1, DIM - 2)  # cells of a token that follows itself, or itself and another
ALPHA, BETA, L1, L2 = 10.0, 1.0, 0.002, 0.02
HELD, LONGEST = 200_000, 64  # entries of a worker's dictionary, and their characters
TOKEN = re.compile(r"\w+|[^\w\s]+")
HELD_OUT = 2
GOOD = 0.7  # least score of a text that is kept


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


class Cells(dict):
    """Hash cell by token."""

    def __missing__(self, token: str) -> int:
        import zlib

        cell = zlib.crc32(token.encode())
        if len(token) <= LONGEST:
            thin_out(self, HELD)
            self[token] = cell
        return cell


def cells_of(text: str, held: Cells) -> np.ndarray:
    """The cell of every token and pair of neighbours, and of each return to a token."""
    tokens = TOKEN.findall(text)
    one = np.fromiter(map(held.__getitem__, tokens), np.uint32, len(tokens))
    two = one[:-1] * np.uint32(0x9E3779B1) + (one[1:] ^ np.uint32(0x5BD1E995))
    cells = (np.concatenate((one, two)) >> np.uint32(5)) % np.uint32(DIM)
    back = [(one[k:] == one[:-k]).sum() for k in (1, 2)]
    return np.concatenate((cells, np.repeat(np.array(RETURNS, np.uint32), back)))


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int) -> tuple[np.ndarray, float]:
    """Weights and bias after ``epochs`` passes, one update per row."""
    z, n = np.zeros(DIM + 1), np.zeros(DIM + 1)

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    for _ in range(epochs):
        for cells, label in rows:
            at, times = np.unique(cells, return_counts=True)
            at = np.append(at, DIM)
            x = np.append(SCALE * times / max(len(cells), 1), 1.0)
            w = weights(at)
            g = (logistic(w @ x) - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    every = weights(np.arange(DIM + 1))
    return every[:DIM], float(every[DIM])


def learnable(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of at most ``SAMPLE`` documents that may be learnt from.

    Several labels of one document are averaged; a tie, and a null, gives none.
    """
    mean = labels.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("quality").alias("m"))
    label = F.when(F.col("m") > 0.5, 1).when(F.col("m") < 0.5, 0)
    named = mean.select("doc_id", label.alias("label")).filter("label is not null")
    return named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)


def train(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """The model. The labels are sampled first, so that no more than ``SAMPLE`` documents
    leave the scan; without any, weights and bias are zero."""
    sample = documents.select("doc_id", text_of().alias("text")).join(
        F.broadcast(learnable(labels)), "doc_id"
    )
    at = F.xxhash64("doc_id", "text")
    dealt = sample.withColumn("at", at).withColumn("shard", F.pmod("at", F.lit(SHARDS)).cast("int"))

    def fit(key, frame):
        import pandas as pd

        held = Cells()
        frame = frame.sort_values(["at", "text"])
        n = len(frame)
        rows = [(cells_of(t, held), y) for t, y in zip(frame.text, frame.label)]
        del frame, held
        w, b = ftrl(rows, EPOCHS)
        del rows
        trim()
        return pd.DataFrame({"n": [n], "w": [w.astype("<f4").tobytes()], "b": [b]})

    columns = dealt.select("shard", "at", "text", "label")
    models = columns.groupBy("shard").applyInPandas(fit, "n long, w binary, b double").collect()
    total, weights, bias = 0, np.zeros(DIM), 0.0
    for m in models:  # SHARDS at most
        total += m.n
        weights += m.n * np.frombuffer(bytes(m.w), "<f4")
        bias += m.n * m.b
    return (weights / max(total, 1)).astype(np.float32), bias / max(total, 1)


def score(documents: DataFrame, model: tuple[np.ndarray, float], with_text: bool = True) -> DataFrame:
    """``documents``, on request without their text, with score, the model's probability of
    a good text.

    A null or empty text gets the bias alone. A column named score is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in documents.columns if c not in ("score", "text")]
    source = small_batches(documents).select(*keep, "text")
    out = source if with_text else source.drop("text")

    def dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        held = in_worker("quality cells", Cells)
        for batch in batches:
            sums = [bias] * batch.num_rows
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                cells = cells_of(text or "", held)
                if len(cells):
                    sums[i] += SCALE * float(weights[cells].mean(dtype=np.float64))
            scores = pa.array(logistic(np.array(sums)), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], scores], [*batch.schema.names[:width], "score"]
            )

    width = len(out.columns)
    schema = StructType([*out.schema.fields, StructField("score", DoubleType())])
    return source.mapInArrow(lean(dot), schema)

"""Quality of a text by a small convolutional network over its bytes, in numpy.

Filters of ``TAPS`` bytes run over the whole text. Their outputs are max-pooled over chunks that
overlap, and a text's probability is a logistic function of the mean and the maximum of its chunks'
pooled outputs. As bytes come in one-hot form, a filter is a table of weights by tap and byte, and the
convolution is a sum of table rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .flat import steps

TAPS, FILTERS = 5, 16
# A chunk is four blocks long and begins three blocks after the last one.
BLOCK, CHUNK_BLOCKS, CHUNK_STEP = 64, 4, 3
# Labelled rows that the network learns from.
TRAINING_ROWS, TRAINING_BYTES = 3000, 24 << 20
STEP_BYTES = 1 << 20


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text from a block border on, with zeros behind it, and the block offsets. Any text has a
    block, and zeros for the taps that reach over its end."""
    sizes = np.diff(offsets)
    blocks = (sizes + TAPS - 1) // BLOCK + 1
    firsts = np.concatenate([[0], np.cumsum(blocks)])
    out = np.zeros(int(firsts[-1]) * BLOCK + TAPS, np.uint8)
    out[np.arange(len(data)) + np.repeat(firsts[:-1] * BLOCK - offsets[:-1], sizes)] = data
    return out, firsts


def _chunks(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end block of every chunk, and the offsets of each text's chunks. Together the chunks of
    a text hold all its blocks."""
    blocks = np.diff(firsts)
    counts = 1 + np.maximum(0, -(-(blocks - CHUNK_BLOCKS) // CHUNK_STEP))
    ends = np.cumsum(counts)
    within = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
    first = np.repeat(firsts[:-1], counts) + CHUNK_STEP * within
    return first, np.minimum(first + CHUNK_BLOCKS, np.repeat(firsts[1:], counts)), np.concatenate([[0], ends])


class ByteNetwork:
    def __init__(self, seed: int = 3):
        random = np.random.default_rng(seed)
        self.filters = (random.standard_normal((TAPS, 256, FILTERS)) * 0.3).astype(np.float32)
        self.filters[:, 0] = 0
        self.offset = np.zeros(FILTERS, np.float32)
        self.weights = (random.standard_normal(2 * FILTERS) * 0.3).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    def _blocks(self, padded: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Outputs of all places by block: (blocks, BLOCK, FILTERS). The last places of a text are padding,
        from which taps would reach into the next text; their output is that of zeros."""
        n = len(padded) - TAPS
        out = np.take(self.filters[0], padded[:n], axis=0)
        for k in range(1, TAPS):
            out += np.take(self.filters[k], padded[k : k + n], axis=0)
        out = out.reshape(-1, BLOCK, FILTERS)
        out[firsts[1:] - 1, BLOCK - TAPS + 1 :] = 0
        return out

    def _pooled(self, tops: np.ndarray, firsts: np.ndarray):
        first, end, texts = _chunks(firsts)
        chunk = tops[first]
        for k in range(1, CHUNK_BLOCKS):
            chunk = np.maximum(chunk, tops[np.minimum(first + k, end - 1)])
        active = np.maximum(chunk + self.offset, 0)
        sizes = np.diff(texts)[:, None]
        mean = np.add.reduceat(active, texts[:-1], axis=0) / sizes
        most = np.maximum.reduceat(active, texts[:-1], axis=0)
        return first, end, texts, active, mean, most

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        padded, firsts = _padded(data, offsets)
        *_, mean, most = self._pooled(self._blocks(padded, firsts).max(1), firsts)
        logit = np.concatenate([mean, most], 1).astype(float) @ self.weights.astype(float) + float(self.bias[0])
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def _gradients(self, data, offsets, labels):
        padded, firsts = _padded(data, offsets)
        outputs = self._blocks(padded, firsts)
        places = outputs.argmax(1)
        tops = np.take_along_axis(outputs, places[:, None], 1)[:, 0]
        first, end, texts, active, mean, most = self._pooled(tops, firsts)
        joint = np.concatenate([mean, most], 1)
        p = 1 / (1 + np.exp(-np.clip(joint @ self.weights + self.bias, -30, 30)))
        error = ((p - labels) / len(labels)).astype(np.float32)
        back = error[:, None] * self.weights
        sizes = np.diff(texts)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        top = (active == most[owner]).astype(np.float32)
        ties = np.add.reduceat(top, texts[:-1], axis=0)
        flow = back[owner, :FILTERS] / sizes[owner, None] + back[owner, FILTERS:] * top / ties[owner]
        flow *= active > 0
        # The block and place of every chunk's largest output.
        best = np.repeat(first[:, None], FILTERS, 1)
        for k in range(1, CHUNK_BLOCKS):
            other = np.minimum(first + k, end - 1)[:, None]
            better = np.take_along_axis(tops, np.broadcast_to(other, best.shape), 0) > np.take_along_axis(tops, best, 0)
            best = np.where(better, other, best)
        place = best * BLOCK + np.take_along_axis(places, best, 0)
        chunk, column = np.nonzero(flow)
        amount, spot = flow[chunk, column], place[chunk, column]
        of_filters = np.zeros_like(self.filters)
        for k in range(TAPS):
            cell = padded[spot + k].astype(np.int64) * FILTERS + column
            of_filters[k] = np.bincount(cell, weights=amount, minlength=256 * FILTERS).reshape(256, FILTERS)
        of_filters[:, 0] = 0
        return [of_filters, flow.sum(0), error @ joint, error.sum(keepdims=True)]

    def fit(self, texts: list[bytes], labels: np.ndarray, rounds: int = 6, batch: int = 32, rate: float = 0.01, decay: float = 1e-4, seed: int = 4):
        """Adam on the logistic loss. Without both labels nothing is learned but their share."""
        if len(set(labels.tolist())) < 2:
            share = (labels.sum() + 1) / (len(labels) + 2)
            self.weights[:], self.bias[0] = 0, np.log(share / (1 - share))
            return self
        random = np.random.default_rng(seed)
        parameters = [self.filters, self.offset, self.weights, self.bias]
        slopes = [(np.zeros_like(x), np.zeros_like(x)) for x in parameters]
        turn = 0
        for _ in range(rounds):
            order = random.permutation(len(texts))
            for at in range(0, len(order), batch):
                pick = order[at : at + batch]
                data = np.frombuffer(b"".join(texts[i] for i in pick), np.uint8)
                offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])]).astype(np.int64)
                turn += 1
                for x, g, (m, v) in zip(parameters, self._gradients(data, offsets, labels[pick]), slopes):
                    g = g + decay * x
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    x -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
        return self


def training_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int = TRAINING_ROWS) -> DataFrame:
    """``(text, label)`` of at most ``rows`` labelled documents, the first by a hash of the id.

    The ids are picked first; their number is bounded, so they are broadcast to the documents. Labels
    that are null or of no document are left out; of repeated ids one label counts.
    """
    labelled = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    picked = (
        labelled.select(F.col("doc_id").cast("long").alias("picked"), F.col(label).cast("int").alias("label"))
        .groupBy("picked").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("picked"), "picked").limit(rows)
    )
    joined = documents.join(F.broadcast(picked), F.col("doc_id").cast("long") == F.col("picked"))
    return joined.select("picked", F.coalesce("text", F.lit("")).alias("text"), "label").dropDuplicates(["picked"])


def fit_quality(documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAINING_ROWS) -> ByteNetwork:
    """A network fitted on the driver to the sample, which is bounded in rows and in bytes: of the rows in the order
    of their hashes, those whose texts fit into ``TRAINING_BYTES`` together with the ones taken before. A text that
    does not fit is passed over as a whole. Runs jobs; the sample is stored."""
    stored = cut_lineage(training_sample(documents, labels, label, rows))
    sizes = stored.select(F.xxhash64("picked").alias("place"), "picked", F.octet_length("text").alias("size")).collect()
    taken, total = [], 0
    for _, picked, size in sorted(map(tuple, sizes)):
        if total + size <= TRAINING_BYTES:
            taken.append(picked)
            total += size
    chosen = stored if len(taken) == len(sizes) else stored.where(F.col("picked").isin(taken))
    sample = sorted((r["picked"], r["text"].encode(), r["label"]) for r in chosen.collect())
    return ByteNetwork().fit([x[1] for x in sample], np.array([x[2] for x in sample], np.float32))


def score_quality(documents: DataFrame, network: ByteNetwork) -> DataFrame:
    """``(doc_id, score, predicted)`` for every row; a null text is empty, and an empty one has a score too."""
    shared = documents.sparkSession.sparkContext.broadcast(network)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in steps(batch.column("text"), STEP_BYTES):
                p = shared.value.probabilities(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double, predicted int")


def held_out_quality(documents: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``: learn outside one part of the ids, score all rows."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))
    network = fit_quality(documents, labels.where(~held_out))
    return score_quality(documents, network).select("doc_id", held_out.alias("held_out"), "score", "predicted")

"""Language identification by a small byte convolutional network, trained in numpy.

A text's bytes are cut into windows of fixed length (the last one is padded with zero
bytes). Every byte is embedded, filters of several widths slide over a window, each
filter keeps its greatest response, and a softmax layer names the language. A document's
answer is the mean of its windows' log-probabilities, weighted by their bytes: all of a
text counts, however long it is.

Defined results: a null text and one without a letter give `und` with score 0; an empty
training table gives `und` for every row. Repeated rows get equal answers.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pulsefold.llm.tables import own_columns, part_of
from pulsefold.llm.texts import slices, utf8

UNKNOWN = "und"
HELD_OUT_PARTS, HELD_OUT = 5, 0


@dataclass(frozen=True)
class Settings:
    """`train_windows` bounds the labelled sample for each language; it is spread over the whole table by a hash."""

    window: int = 192
    embedding: int = 6
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    train_windows: int = 2500
    steps: int = 800
    windows_of_document: int = 8
    batch: int = 64
    rate: float = 0.004
    seed: int = 7


class ByteNet:
    """Embedding, filters of several widths, max over positions, one softmax layer.

    All filters live in one matrix over the widest span; `mask` keeps the rows beyond a narrower filter at zero.
    """

    def __init__(self, labels: list[str], settings: Settings, params: dict[str, np.ndarray] | None = None):
        self.labels, self.settings = labels, settings
        rng, s = np.random.default_rng(settings.seed), settings
        width = np.repeat(s.widths, s.filters)
        self.mask = (np.arange(max(s.widths) * s.embedding)[:, None] < width * s.embedding).astype(np.float32)
        self.params = params or {
            "embed": rng.normal(0, 0.5, (256, s.embedding)).astype(np.float32),
            "bank": (rng.normal(0, 1, self.mask.shape) / np.sqrt(width * s.embedding) * self.mask).astype(np.float32),
            "bias": np.zeros(len(width), np.float32),
            "out": rng.normal(0, 0.1, (len(width), len(labels))).astype(np.float32),
            "out_bias": np.zeros(len(labels), np.float32),
        }

    def to_bytes(self) -> bytes:
        buffer = io.BytesIO()
        np.savez(buffer, labels=np.array(self.labels), **self.params)
        return buffer.getvalue()

    @classmethod
    def from_bytes(cls, blob: bytes, settings: Settings) -> ByteNet:
        held = dict(np.load(io.BytesIO(blob), allow_pickle=False))
        labels = [str(x) for x in held.pop("labels")]
        return cls(labels, settings, held)

    def responses(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter at each position (windows, positions, filters), and the bytes' vectors it saw."""
        s, n = self.settings, len(windows)
        reach = max(s.widths)
        padded = np.concatenate([windows, np.zeros((n, reach - 1), np.uint8)], 1)
        vectors = self.params["embed"][padded].reshape(n, -1)
        step = vectors.itemsize * s.embedding
        seen = np.lib.stride_tricks.as_strided(
            vectors, (n, windows.shape[1], reach * s.embedding), (vectors.strides[0], step, vectors.itemsize))
        seen = np.ascontiguousarray(seen).reshape(-1, reach * s.embedding)
        return (seen @ self.params["bank"]).reshape(n, windows.shape[1], -1), seen.reshape(n, windows.shape[1], -1)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        top = np.maximum(self.responses(windows)[0].max(1) + self.params["bias"], 0)
        return _log_softmax(top @ self.params["out"] + self.params["out_bias"])

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        response, seen = self.responses(windows)
        rows, spot = np.arange(len(windows)), response.argmax(1)
        top = np.maximum(response.max(1) + self.params["bias"], 0)
        error = np.exp(_log_softmax(top @ self.params["out"] + self.params["out_bias"]))
        error[rows, target] -= 1
        error /= len(windows)
        back = (error @ self.params["out"].T) * (top > 0)
        reach = max(self.settings.widths)
        padded = np.concatenate([windows, np.zeros((len(windows), reach - 1), np.uint8)], 1)
        touched = padded[rows[:, None, None], spot[:, :, None] + np.arange(reach)]
        to_vectors = (back[:, :, None] * self.params["bank"].T[None]).reshape(-1, self.settings.embedding)
        embed = np.zeros_like(self.params["embed"])
        np.add.at(embed, touched.ravel(), to_vectors)
        return {
            "embed": embed, "bias": back.sum(0), "out": top.T @ error, "out_bias": error.sum(0),
            "bank": np.einsum("nfd,nf->df", seen[rows[:, None], spot], back) * self.mask,
        }


def _log_softmax(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(1, keepdims=True))


def fit(windows: np.ndarray, target: np.ndarray, labels: list[str], settings: Settings) -> ByteNet:
    """Adam on the mean cross-entropy, in an order fixed by the seed."""
    net, rng = ByteNet(labels, settings), np.random.default_rng(settings.seed + 1)
    mean = {k: np.zeros_like(v) for k, v in net.params.items()}
    square = {k: np.zeros_like(v) for k, v in net.params.items()}
    step = 0
    while step < settings.steps:
        # As many passes as the steps take, however few windows there are.
        order = rng.permutation(len(windows))
        for begin in range(0, len(order), settings.batch):
            chosen, step = order[begin:begin + settings.batch], step + 1
            for k, g in net.gradients(windows[chosen], target[chosen]).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                ahead = mean[k] / (1 - 0.9**step)
                net.params[k] -= (settings.rate * ahead / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def windows_of(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, the text of each, and its number of bytes."""
    data, offsets = utf8(column)
    length = np.diff(offsets)
    count = -(-length // size)
    doc = np.repeat(np.arange(len(length)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[:-1][doc] + nth * size
    filled = np.minimum(size, offsets[1:][doc] - begin)
    padded = np.concatenate([data, np.zeros(size, np.uint8)])
    out = np.lib.stride_tricks.sliding_window_view(padded, size)[begin]
    out[np.arange(size)[None, :] >= filled[:, None]] = 0
    return out, doc, filled


def train(labelled: DataFrame, settings: Settings = Settings()) -> ByteNet | None:
    """Fit on `labelled` (doc_id, text, lang). None if no row has both a text and a language.

    The counts that set each language's sampling rate cover all rows; the sample holds about
    `train_windows` windows per language (one per document, or up to `windows_of_document` where documents are few)
    and is fitted in one task.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    labels, size = sorted(counts), settings.window
    each = max(1, min(settings.windows_of_document, settings.train_windows // max(counts.values())))
    rate = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, settings.train_windows / n)))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.where(draw < rate[F.col("lang")]).select("doc_id", "text", "lang")

    def one_window(batches):
        for piece in slices(batches, "text"):
            cut, doc, _ = windows_of(piece.column(1), size)
            seed = piece.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) & 0x7FFFFFFF
            count = np.bincount(doc, minlength=len(piece))
            first = np.cumsum(count) - count
            # Full windows where there are any: the last one may be nearly empty.
            full = np.maximum(count - 1, 1)
            for k in range(each):
                has = (count > 0) & (full > k)
                pick = first + (seed * 2654435761 % 2**32 + k) % full
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed[has]), pa.array([cut[i].tobytes() for i in pick[has]], pa.binary()), piece.column(2).filter(pa.array(has))],
                    ["seed", "bytes", "lang"])

    def one_task(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["seed", "bytes", "lang"])
        stacked = np.frombuffer(b"".join(pdf["bytes"]), np.uint8).reshape(-1, size)
        net = fit(stacked, np.searchsorted(labels, pdf["lang"].to_numpy(str)), labels, settings)
        return pd.DataFrame({"model": [net.to_bytes()]})

    drawn = sample.mapInArrow(one_window, "seed long, bytes binary, lang string")
    rows = drawn.groupBy(F.lit(0).alias("_all")).applyInPandas(one_task, "model binary").collect()
    return ByteNet.from_bytes(bytes(rows[0]["model"]), settings) if rows else None


def _scores(piece: pa.RecordBatch, column: int, lettered: int, model: ByteNet) -> tuple[np.ndarray, np.ndarray]:
    """Number of the best label of each row (one more than there are: unknown), and its probability."""
    cut, doc, filled = windows_of(piece.column(column), model.settings.window)
    total = np.zeros((len(piece), len(model.labels)))
    for i in range(0, len(cut), 64):
        part = slice(i, i + 64)
        np.add.at(total, doc[part], model.log_probabilities(cut[part]) * filled[part, None])
    size = np.bincount(doc, filled, len(piece))
    chance = np.exp(_log_softmax(total / np.maximum(size, 1)[:, None]))
    known = piece.column(lettered).to_numpy(zero_copy_only=False) & (size > 0)
    return np.where(known, chance.argmax(1), len(model.labels)), np.where(known, chance.max(1), 0.0)


def _lettered() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, net: ByteNet | None, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of `docs` (doc_id, text)."""
    rows = docs.select("doc_id", "text", held_out.alias("held_out"), _lettered().alias("lettered"))
    if net is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    blob, settings = net.to_bytes(), net.settings

    def scored(batches):
        model = ByteNet.from_bytes(blob, settings)
        names = np.array([*model.labels, UNKNOWN], object)
        for piece in slices(batches, "text"):
            best, score = _scores(piece, 1, 3, model)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(2), pa.array(names[best], pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(scored, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Train on the rows whose crc32(doc_id) mod 5 is not 0, then name the language of every row.

    `documents` needs doc_id, text and lang; other columns are left aside.
    """
    docs = own_columns(documents, "doc_id", "text", "lang")
    held_out = part_of("doc_id", HELD_OUT_PARTS) == HELD_OUT
    return predict(docs, train(docs.where(~held_out), settings), held_out)


def accepted(documents: DataFrame, settings: Settings = Settings(), least_score: float = 0.5) -> DataFrame:
    """The rows of `documents` (all columns) whose text has a language: one pass, no shuffle.

    Rejected are `und` and texts for which the network gives no language more than `least_score`: by default, all that
    it does not hold to be one language rather than any other. Without labels to learn from, only `und` goes.
    """
    docs = own_columns(documents, "doc_id", "text", "lang")
    net = train(docs.where(part_of("doc_id", HELD_OUT_PARTS) != HELD_OUT), settings)
    if net is None:
        return documents.where(_lettered())
    blob, settings, schema = net.to_bytes(), net.settings, documents.schema
    # The helper column goes to the end, under a name no other column has.
    helper = "_" * (1 + max(map(len, documents.columns)))

    def filtered(batches):
        model = ByteNet.from_bytes(blob, settings)
        for piece in slices(batches, "text"):
            last = piece.num_columns - 1
            best, score = _scores(piece, piece.schema.get_field_index("text"), last, model)
            keep = (best < len(model.labels)) & (score >= least_score)
            yield piece.select(range(last)).filter(pa.array(keep))

    return documents.withColumn(helper, _lettered()).mapInArrow(filtered, schema)

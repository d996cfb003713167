"""Language of whole texts by a small byte convolutional network trained here."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from voxstar.llm.words import slices
from voxstar.shipping import ship

#: Bytes of a window; size of a byte's vector; filter widths and filters of each.
WINDOW = 256
DIMENSIONS = 8
WIDTHS = (2, 3, 4)
FILTERS = 12
#: Windows scored together.
BATCH = 128


@dataclass(frozen=True)
class Model:
    """Byte vectors, one weight block per width (width * DIMENSIONS, FILTERS), filter biases, output layer, languages."""

    bytes_: np.ndarray
    filters: tuple[np.ndarray, ...]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    languages: tuple[str, ...]


def cut(text: bytes) -> np.ndarray:
    """The whole text as rows of WINDOW bytes, the last filled up with zeros."""
    n = max(1, -(-len(text) // WINDOW))
    return np.frombuffer(text.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], steps: int = 400, batch: int = 64,
          rate: float = 0.01, seed: int = 1) -> Model:
    """Adam on the cross entropy; a filter learns at the place of its maximum. Same input, same model."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.5, (256, DIMENSIONS))]
    params += [rng.normal(0, 1 / np.sqrt(w * DIMENSIONS), (w * DIMENSIONS, FILTERS)) for w in WIDTHS]
    params += [np.zeros(FILTERS * len(WIDTHS)), rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))), np.zeros(len(languages))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), min(batch, len(windows)))
        x, y = windows[pick], labels[pick]
        vectors, grads = params[0][x], [np.zeros_like(p) for p in params]
        rows, pooled, places = np.arange(len(x))[:, None], [], []
        for k, w in enumerate(WIDTHS):
            spread = np.concatenate([vectors[:, j:WINDOW - w + 1 + j] for j in range(w)], axis=2)
            answer = spread @ params[1 + k]
            places.append(answer.argmax(axis=1))
            pooled.append(np.take_along_axis(answer, places[-1][:, None], axis=1)[:, 0])
        held = np.concatenate(pooled, axis=1) + params[-3]
        active = np.maximum(held, 0)
        wrong = _softmax(active @ params[-2] + params[-1])
        wrong[np.arange(len(y)), y] -= 1
        wrong /= len(y)
        grads[-2], grads[-1] = active.T @ wrong, wrong.sum(axis=0)
        back = (wrong @ params[-2].T) * (held > 0)
        grads[-3] = back.sum(axis=0)
        for k, w in enumerate(WIDTHS):
            part = back[:, k * FILTERS:(k + 1) * FILTERS]
            for j in range(w):
                at = x[rows, places[k] + j]
                block = slice(j * DIMENSIONS, (j + 1) * DIMENSIONS)
                grads[1 + k][block] = np.einsum("bfd,bf->df", params[0][at], part)
                np.add.at(grads[0], at, part[:, :, None] * params[1 + k][block].T[None])
        for i, grad in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad ** 2
            params[i] = params[i] - rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    p = [a.astype(np.float32) for a in params]
    return Model(p[0], tuple(p[1:1 + len(WIDTHS)]), p[-3], p[-2], p[-1], languages)


class Scorer:
    """The trained network with the byte vectors multiplied out: a filter's answer is a sum of looked-up rows."""

    def __init__(self, model: Model):
        self.model = model
        row = [[model.bytes_ @ block[j * DIMENSIONS:(j + 1) * DIMENSIONS] for j in range(w)] for w, block in zip(WIDTHS, model.filters, strict=True)]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        self.starts = np.concatenate([pair(*row[0]), pair(row[1][0], row[1][1]), pair(row[2][0], row[2][1])], axis=1)
        self.third, self.ends = row[1][2], pair(row[2][2], row[2][3])

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """A row of language probabilities for each window."""
        out = []
        for at in range(0, len(windows), BATCH):
            x = windows[at:at + BATCH]
            pairs = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
            answer = self.starts[pairs]
            answer[:, :-1, FILTERS:2 * FILTERS] += self.third[x[:, 2:]]
            answer[:, :-2, 2 * FILTERS:] += self.ends[pairs[:, 2:]]
            pooled = np.concatenate([answer[:, :, :FILTERS].max(axis=1), answer[:, :-1, FILTERS:2 * FILTERS].max(axis=1),
                                     answer[:, :-2, 2 * FILTERS:].max(axis=1)], axis=1)
            out.append(_softmax(np.maximum(pooled + self.model.bias, 0) @ self.model.out + self.model.out_bias))
        return np.concatenate(out)

    def classify(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        """Language and its mean probability over the whole text's windows, each weighted by its bytes."""
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        able = [i for i, t in enumerate(texts) if t is not None and any(c.isalpha() for c in t.decode("utf-8", "replace"))]
        part, begins, sizes = [], [0], []
        for i in able:
            rows = cut(texts[i])
            part.append(rows)
            size = np.full(len(rows), WINDOW)
            size[-1] = len(texts[i]) - WINDOW * (len(rows) - 1)
            sizes.append(size)
            begins.append(begins[-1] + len(rows))
        if able:
            weights = np.concatenate(sizes)
            sums = np.add.reduceat(self.probabilities(np.concatenate(part)) * weights[:, None], begins[:-1])
            mean = sums / np.add.reduceat(weights, begins[:-1])[:, None]
            best = mean.argmax(axis=1)
            for i, k, p in zip(able, best, mean[np.arange(len(able)), best], strict=True):
                out[i] = (self.model.languages[k], float(min(1.0, max(0.0, p))))
        return out


def sample(docs: DataFrame, learn: Column, per_language: int, windows: int) -> DataFrame:
    """Up to ``per_language`` labelled rows of each language, lowest hash first, with ``windows`` stretches of each whole text."""
    length = F.length("text")
    parts = [F.substring(F.col("text"), (F.floor(length * F.lit(i / windows)) + 1).cast("int"), F.lit(WINDOW)) for i in range(windows)]
    picked = (docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
              .select("lang", F.xxhash64("doc_id", "text").alias("rank"), F.array(*parts).alias("parts")))
    order = Window.partitionBy("lang").orderBy("rank")
    return picked.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language)


def fit(docs: DataFrame, learn: Column, per_language: int = 200, windows: int = 4) -> Model | None:
    """Train on the bounded sample: at most ``per_language * windows`` windows of each language reach the driver."""
    rows = sorted(sample(docs, learn, per_language, windows).select("lang", "k", "parts").collect())
    languages = tuple(sorted({r["lang"] for r in rows}))
    if not languages:
        return None
    found, labels = [], []
    for r in rows:
        for part in r["parts"]:
            data = part.encode()[:WINDOW]
            if data:
                found.append(cut(data)[0])
                labels.append(languages.index(r["lang"]))
    return train(np.stack(found), np.array(labels), languages) if found else None


_scorers: dict[bytes, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    key = model.out.tobytes() + model.bias.tobytes()
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model)
    return _scorers[key]


def identify(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` of every row, from its text alone.

    The whole text is cut into windows of 256 bytes; their probabilities are averaged. Null texts, texts without a letter and any text when
    nothing could be learned get ``und`` and 0. Equal texts get equal answers; an empty table gives no rows.
    Rows are scored where they lie; memory holds about a megabyte of text at a time.
    """
    ship(docs.sparkSession)
    kept = docs.select(*keep, F.col("text").cast("binary").alias("_text"))
    schema = kept.drop("_text").schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        for batch in batches:
            texts, answers = batch.column(len(keep)).to_pylist(), []
            for first, part in slices(texts):
                answers += _scorer(model).classify(texts[first:first + len(part)]) if model else [("und", 0.0)] * len(part)
            if answers:
                lang, score = zip(*answers, strict=True)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 names=[*keep, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)

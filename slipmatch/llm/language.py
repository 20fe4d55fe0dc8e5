"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its hashed byte n-grams, upon which a linear layer
and a softmax stand; both are trained together by stochastic gradient descent in numpy, on a
bounded sample. A temperature fitted on part of that sample calibrates the scores, and the
lowest scores found there set the score below which a prediction is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from slipmatch.llm.tables import runs

UNKNOWN = "und"
SAMPLE_PER_LANGUAGE = 600
SAMPLE_BYTES = 1 << 24
GRAMS = (1, 2, 3, 4)
BUCKETS = 1 << 14
DIMENSIONS = 16
EPOCHS, RATE, SEED = 12, 0.5, 7
# Rejected is what scores below half of the lowest score of this share of right answers.
RIGHT_ANSWERS_BELOW = 0.001


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    table[65:91] += 32
    return table


LOWER = _lower_table()


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length the hashed n-grams of all rows, and where each row's begin."""
    low = LOWER[data]
    lengths = np.diff(offsets)
    value = np.zeros(len(low), dtype=np.uint32)
    for n in GRAMS:
        size = max(0, len(low) - n + 1)
        value = value[:size] * np.uint32(257) + low[n - 1 : n - 1 + size] + np.uint32(1)
        mixed = value * np.uint32(2654435761)
        bucket = ((mixed ^ (mixed >> np.uint32(15)) ^ np.uint32(n * 40503)) & np.uint32(BUCKETS - 1)).astype(np.int32)
        inside = np.ones(size, dtype=bool)
        for back in range(1, n):
            at = offsets[1:] - back
            at = at[(at >= 0) & (at < size)]
            inside[at] = False
        # Grams that reach over the end of a row belong to none.
        counts = np.maximum(0, lengths - n + 1)
        yield bucket[inside], np.concatenate([[0], np.cumsum(counts)])


@dataclass
class Model:
    languages: list[str]
    # Logit of each hashed n-gram for each language: embeddings times the linear layer.
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        logits = np.zeros((len(offsets) - 1, len(self.languages)), dtype=np.float64)
        total = np.zeros(len(offsets) - 1)
        for bucket, starts in gram_buckets(data, offsets):
            for j in range(len(self.languages)):
                run = np.concatenate([[0.0], np.cumsum(self.table[j][bucket], dtype=np.float64)])
                logits[:, j] += run[starts[1:]] - run[starts[:-1]]
            total += np.diff(starts)
        logits = logits / np.maximum(total, 1)[:, None] + self.bias
        return softmax(logits / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def bounded_sample(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> list[tuple[str, str]]:
    """About ``per_language`` texts of each language, chosen by a hash of doc_id and text.

    The driver gets no more than that: rows are chosen by hash thresholds out of the counts
    per language, and texts over 64 KB are not chosen.
    """
    usable = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text")) & (F.octet_length("text") <= 1 << 16))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return []
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, per_language / n)).otherwise(share)
    chosen = usable.where(part < share).select("lang", "text", F.xxhash64("doc_id", "text").alias("at"))
    rows = chosen.limit(2 * per_language * len(counts)).collect()
    return [(r["lang"], r["text"]) for r in sorted(rows, key=lambda r: (r["at"], r["lang"], r["text"]))]


def trained(sample: list[tuple[str, str]]) -> Model:
    """The model of a sample; a fifth of it calibrates. With no sample nothing is ever learned."""
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0), 1.0, 0.0)
    code = {lang: i for i, lang in enumerate(languages)}
    want = np.array([code[lang] for lang, _ in sample])
    grams = [_counts(text) for _, text in sample]
    held = np.arange(len(sample)) % 5 == 4
    rng = np.random.default_rng(SEED)
    embeddings = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    layer, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    layer += rng.normal(0, 0.1, layer.shape)
    train = np.flatnonzero(~held)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) * 8
        for i in rng.permutation(train):
            at, share = grams[i]
            average = share @ embeddings[at]
            error = softmax((average @ layer + bias)[None])[0]
            error[want[i]] -= 1
            back = layer @ error
            layer -= rate * 0.1 * np.outer(average, error)
            bias -= rate * 0.01 * error
            embeddings[at] -= rate * share[:, None] * back
    table = (embeddings @ layer).T
    logits = np.array([share @ table[:, at].T for at, share in grams]) + bias
    judged = held if held.any() else ~held
    temperature = min((2.0**k for k in np.arange(-6, 4, 0.25)), key=lambda t: _loss(logits[judged], want[judged], t))
    probability = softmax(logits[judged] / temperature)
    right = probability.argmax(axis=1) == want[judged]
    best = probability.max(axis=1)[right]
    least = 0.5 * float(np.quantile(best, RIGHT_ANSWERS_BELOW)) if len(best) else 0.0
    return Model(languages, table.astype(np.float32), bias, float(temperature), least)


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    found = np.concatenate([bucket for bucket, _ in gram_buckets(data, np.array([0, len(data)]))])
    at, n = np.unique(found, return_counts=True)
    return at, n / n.sum()


def _loss(logits: np.ndarray, want: np.ndarray, temperature: float) -> float:
    probability = softmax(logits / temperature)[np.arange(len(want)), want]
    # A smoothed loss, so that a perfect sample doesn't ask for certainty.
    return float(-np.log(0.98 * probability + 0.01).mean() + 0.002 / temperature)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """Rows ``document`` (a struct of all columns), ``lang_pred``, ``score``, ``rejected``.

    Only the text is looked at, all of it. A null text, one without a letter, and any text if
    nothing was learned give ``und`` with score 0. Rejected are these and predictions that
    score below the model's least score. The model goes to the tasks: its size is fixed.
    """
    held = docs.sparkSession.sparkContext.broadcast(astuple(model))
    rows = docs.select(F.struct("*").alias("document"), F.col("text").alias("whole"), has_letter(F.col("text")).alias("letters"))
    schema = rows.drop("whole", "letters").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def predict(batches):
        model = Model(*held.value)
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for part, data, offsets in runs(batch, "whole"):
                known = np.asarray(part.column("letters").to_numpy(zero_copy_only=False), dtype=bool)
                known = known & bool(model.languages)
                score, best = np.zeros(len(part)), np.full(len(part), len(model.languages))
                if known.any():
                    probability = model.scores(data, offsets)
                    score = np.where(known, probability.max(axis=1), 0.0)
                    best = np.where(known, probability.argmax(axis=1), len(model.languages))
                columns = [part.column("document"), pa.array(names[best], pa.string()), pa.array(score)]
                columns.append(pa.array(~known | (score < model.least)))
                yield pa.RecordBatch.from_arrays(columns, ["document", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(predict, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the row takes no part in learning; a null id does."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame) -> Model:
    return trained(bounded_sample(docs.where(~held_out())))

"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Both chosen by recall and precision on a fifth of the training rows, with the weights of the others.
ORDERS = (4, 5, 6)
HASH_BITS = 18
# n-grams are counted in about this many labelled rows at most, drawn per class by a hash of the doc_id.
COUNT_ROWS = 1 << 18
# The weights are fitted on about this many labelled rows at most, drawn per class by a hash of the doc_id.
TRAIN_ROWS = 8_000
# n-grams that the classifier weighs: those that tell the classes apart best.
FEATURES = 1 << 12
# Characters that are hashed at a time.
BLOCK_CHARS = 1 << 20


def ngram_slots(text: str) -> Iterator[np.ndarray]:
    """Hash slots of the character n-grams of the lower-cased text, padded by a blank on each side."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    last = max(ORDERS) - 1
    for start in range(0, len(codes), BLOCK_CHARS):
        part = codes[start : start + BLOCK_CHARS + last]
        rolled = part * np.uint32(2654435761)
        for order in range(2, last + 2):
            if len(part) < order:
                break
            rolled = (rolled[:-1] * np.uint32(16777619) + part[order - 1 :]) * np.uint32(2246822519)
            if order in ORDERS:
                yield (rolled ^ (rolled >> np.uint32(15))) * np.uint32(3266489917) >> np.uint32(32 - HASH_BITS)


@dataclass
class Model:
    """``place``: slot → 1 + its feature, or 0; ``weight``: per feature, 0 first; ``bias``."""

    place: np.ndarray
    weight: np.ndarray
    bias: float

    def features(self, text: str) -> np.ndarray:
        """The features present in the whole text, each once."""
        found = [np.zeros(0, self.place.dtype)]
        for slots in ngram_slots(text):
            places = self.place[slots]
            found.append(np.unique(places[places > 0]))
        return np.unique(np.concatenate(found))

    def score(self, text: str) -> float:
        margin = float(self.weight[self.features(text)].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def _class_counts(rows: DataFrame) -> DataFrame:
    """(slot, pos, neg): in how many texts of each class a slot occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros((2, 1 << HASH_BITS), np.int64), np.zeros(1 << HASH_BITS, bool)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                for slots in ngram_slots(text.as_py() or ""):
                    seen[slots] = True
                counts[toxic] += seen
                seen[:] = False
        used = np.flatnonzero(counts.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(counts[1, used]), pa.array(counts[0, used])],
            names=["slot", "pos", "neg"],
        )

    return rows.select("text", "toxic").mapInArrow(run, "slot int, pos bigint, neg bigint").groupBy("slot").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )


def _rows_of_features(rows: DataFrame, place: np.ndarray) -> list:
    model = Model(place, np.zeros(1), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.features(t.as_py() or "").astype(np.int16).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], names=["toxic", "f"])

    return rows.select("text", "toxic").mapInArrow(run, "toxic int, f binary").collect()


def _logistic(rows: list, ratio: np.ndarray, penalty: float = 1e-3, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights (already times the ratios) and bias by Nesterov's gradient steps on the mean log loss.

    ``rows``: (label, feature bytes), sorted so that the result does not depend on their order.
    """
    rows = sorted((r["toxic"], bytes(r["f"])) for r in rows)
    label = np.array([r[0] for r in rows], np.float64)
    parts = [np.frombuffer(r[1], np.int16) for r in rows]
    feature = np.concatenate(parts).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
    scale = ratio[feature]
    # The step is bounded by the largest row norm.
    norms = np.bincount(row, scale * scale, len(rows)) + 1
    rate = 4.0 / max(float(norms.mean() + norms.std()), 1.0)
    # Both classes weigh the same, however rare one is.
    share = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    weight, bias, held, held_bias = np.zeros(len(ratio)), 0.0, np.zeros(len(ratio)), 0.0
    for step in range(steps):
        margin = np.bincount(row, weight[feature] * scale, len(rows)) + bias
        error = share * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - label)
        new = weight - rate * (np.bincount(feature, error[row] * scale, len(ratio)) + penalty * weight)
        new_bias = bias - rate * error.sum()
        pull = step / (step + 3)
        weight, held = new + pull * (new - held), new
        bias, held_bias = new_bias + pull * (new_bias - held_bias), new_bias
    return held * ratio, float(held_bias)


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Model fitted on rows (doc_id, text, toxic 0/1), which are read three times, once without texts.

    The n-grams are counted in all rows; ``train_rows`` bounds those of the logistic fit, of which a
    rare class gets up to half.  Without a row of each class every text scores the same: 0 without
    toxic rows, 1 without others.
    """
    rows = labelled.select("text", "toxic", _draw("doc_id").alias("part"))
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    place = np.zeros(1 << HASH_BITS, np.int16)
    if not sizes.get(1) or not sizes.get(0):
        return Model(place, np.zeros(1), 500.0 if sizes.get(1) else -500.0)
    sample = rows.where(F.col("part") < _bound(sizes, train_rows))
    # At most 2 ** HASH_BITS rows, whatever the corpus.
    counts = _class_counts(rows).where("pos + neg > 2").toPandas().sort_values("slot")
    pos, neg = counts["pos"].to_numpy(float), counts["neg"].to_numpy(float)
    ratio = np.log((pos + 1) / (sizes[1] + 2)) - np.log((neg + 1) / (sizes[0] + 2))
    strength = np.abs(pos / sizes[1] - neg / sizes[0]) * np.abs(ratio)
    best = np.sort(np.argsort(-strength, kind="stable")[: FEATURES - 1])
    place[counts["slot"].to_numpy()[best]] = np.arange(1, len(best) + 1)
    ratios = np.concatenate(([0.0], ratio[best]))
    return Model(place, *_logistic(_rows_of_features(sample, place), ratios))


def _draw(column: str):
    """A number below 2 ** 30 by which rows are drawn."""
    return F.pmod(F.xxhash64(F.lit("toxicity"), column), F.lit(1 << 30))


def _bound(sizes: dict[int, int], rows: int):
    """What :func:`_draw` must stay below for about ``rows`` rows; a rare class gets up to half of them."""
    share = {c: min(1.0, max(rows // 2, rows - sizes.get(1 - c, 0)) / max(sizes.get(c, 0), 1)) for c in (0, 1)}
    return F.when(F.col("toxic") == 1, int((1 << 30) * share[1])).otherwise(int((1 << 30) * share[0]))


def _known(labels: DataFrame, held_out: bool) -> DataFrame:
    """(id, toxic): a label that is null or neither 0 nor 1 counts as none; of differing labels of an
    id the larger counts."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return known.where(is_held_out("doc_id") == F.lit(held_out)).withColumnRenamed("doc_id", "__llm_key")


def _with_labels(docs: DataFrame, known: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.join(known, rows["doc_id"] == known["__llm_key"]).select("doc_id", "text", "toxic")


def labelled_rows(docs: DataFrame, labels: DataFrame, held_out: bool = False) -> DataFrame:
    """(doc_id, text, toxic) of all labelled rows, without those that are held out for tests."""
    return _with_labels(docs, _known(labels, held_out))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = COUNT_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of about ``rows`` labelled rows at most, none of them held out.

    The rows are drawn from the labels, so their ids and labels are few whatever the corpus and meet
    the texts where these are read: no text moves.
    """
    known = _known(labels, held_out=False)
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    return _with_labels(docs, F.broadcast(known.where(_draw("__llm_key") < _bound(sizes, rows))))


def is_held_out(column: str):
    """Whether the CRC-32 of the id as text is divisible by five; false without id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _scorer(docs: DataFrame, model: Model):
    """The score as a column function.  Its parts are sent, as a broadcast names classes by module."""
    sent = docs.sparkSession.sparkContext.broadcast((model.place, model.weight, model.bias))

    @F.pandas_udf("double")
    def score(texts):
        received = Model(*sent.value)
        return texts.map(lambda text: received.score(text or ""))

    return score


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a last column ``toxicity``: the score of each whole text, 0 to 1.

    Null counts as empty; an empty text scores by its blanks and the bias.  Repeated rows score the
    same.  All other columns stay; one that is called ``toxicity`` already is replaced.
    """
    return docs.withColumn("toxicity", _scorer(docs, model)(F.coalesce("text", F.lit(""))))


def drop_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below ``limit``, with the same columns."""
    return docs.where(_scorer(docs, model)(F.coalesce("text", F.lit(""))) < limit)

"""Toxicity by a linear classifier over character n-grams scaled by log-count ratios.

Features are hashed n-grams of the lower-cased UTF-8 text; one that occurs ``n`` times counts
``1 + log n``, whatever the length of the text, so a toxic passage weighs as much in a long
text as in a short one. The corpus pass counts, over all labelled training rows, in how many
toxic and how many other texts each n-gram stands; the naive Bayes log-count ratio of these
counts scales the feature. Logistic regression over the scaled features is then fitted to a
bounded sample of the training rows, on the ``MAX_FEATURES`` n-grams that tell most. A
training row is scaled by the ratios of all other rows, so that rare n-grams of its own do not
speak for it.

Both labels weigh the same in the fit, however rare one of them is. The score is calibrated on
training rows alone: the rows are dealt into folds, each fold is scored by a fit to the others,
and a logistic curve through those scores gives slope and offset.

Bounds: the model has ``MAX_FEATURES`` weights, the sample ``SAMPLE_ROWS`` rows; both are
parameters and do not depend on the data. Counts and scores cover all rows and whole texts.

Defined cases: a null text counts as an empty one; every row gets a score, also repeated rows
and rows with a null id; rows with a null label are not learned from; without rows of both
labels there are no weights. An empty table gives an empty result. ``extra`` columns may have
any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, materialise, record_batches, short_batches, to_batch

ORDERS = (3, 5, 7)
BITS = 20
MAX_FEATURES = 1 << 12
SAMPLE_ROWS = 12_000
#: Parts of the feature space that are counted apart.
SLICES = 64
#: Labels, of 12 bytes each, that are sent to the texts. A shuffle of the texts costs their size
#: again on disk.
BROADCAST_LABELS = 2_000_000
#: Parts of the sample for the calibration.
FOLDS = 4
THRESHOLD = 0.7
#: Bytes that are hashed at once.
CHUNK = 1 << 20
#: Entries of the sample, a feature of a text each, whose values are made at once.
ENTRIES = 1 << 16

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)


def _grams(text: bytes, order: int) -> np.ndarray:
    """Hashed feature of the n-gram that starts at each byte."""
    n = len(text) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(text, np.uint8)
    h = np.full(n, order, np.uint64)
    for j in range(order):
        h = h * _MULTIPLIER + raw[j : j + n]
    h ^= h >> np.uint64(29)
    h *= _SPREAD
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def normal_form(text: str | None) -> bytes:
    return b" " + (text or "").lower().encode() + b" "


def _chunks(text: bytes, order: int):
    """Slices of a text whose n-grams are together those of the text."""
    for at in range(0, max(1, len(text) - order + 1), CHUNK):
        yield text[at : at + CHUNK + order - 1]


def feature_counts(text: str | None, columns: np.ndarray | None = None) -> tuple:
    """Distinct features of a text, and how often each occurs.

    ``columns`` maps a feature to its column in the model, or -1: others are left out.
    """
    data, found, counts = normal_form(text), [], []
    for order in ORDERS:
        for part in _chunks(data, order):
            grams = _grams(part, order)
            if columns is not None:
                grams = columns[grams]
                grams = grams[grams >= 0]
            values, n = np.unique(grams, return_counts=True)
            found.append(values)
            counts.append(n)
    values, place = np.unique(np.concatenate(found), return_inverse=True)
    return values, np.bincount(place, np.concatenate(counts), len(values))


def strength(n: np.ndarray) -> np.ndarray:
    """Value of a feature that occurs ``n`` times."""
    return 1 + np.log(n)


@dataclass(frozen=True)
class ToxicityModel:
    """Column of every hashed feature (-1 for most), weight of every column, and bias."""

    columns: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> list[float]:
        """Probability of label 1; whole batches are hashed at once, texts never cut."""
        logits: list[float] = []
        held: list[bytes] = []
        size = 0
        for text in map(normal_form, texts):
            if size + len(text) > CHUNK and held:
                logits += self._logits(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        logits += self._logits(held) if held else []
        return (1 / (1 + np.exp(-np.clip(np.array(logits), -500, 500)))).tolist()

    def _logits(self, texts: list[bytes]) -> list[float]:
        if not len(self.weights):
            return [self.bias] * len(texts)
        if len(texts) == 1:
            times = np.zeros(len(self.weights), dtype=np.int64)
            for order in ORDERS:
                for part in _chunks(texts[0], order):
                    found = self.columns[_grams(part, order)]
                    times += np.bincount(found[found >= 0], minlength=len(times))
            held = np.flatnonzero(times)
            return [self.bias + float(np.sum(self.weights[held] * strength(times[held])))]
        lengths = np.array([len(t) for t in texts])
        ends, owner = np.cumsum(lengths), np.repeat(np.arange(len(texts)), lengths)
        joined = b"".join(texts)
        pairs = []
        for order in ORDERS:
            found = self.columns[_grams(joined, order)]
            at = np.flatnonzero(found >= 0)
            at = at[at + order <= ends[owner[at]]]  # not across two texts
            pairs.append(owner[at] * len(self.weights) + found[at])
        pairs, n = np.unique(np.concatenate(pairs), return_counts=True)
        worth = self.weights[pairs % len(self.weights)] * strength(n)
        sums = np.bincount(pairs // len(self.weights), worth, len(texts))
        return (self.bias + sums).tolist()


def _document_counts(rows: DataFrame) -> DataFrame:
    """Per feature: texts of each class that hold it, from all rows.

    A task hands on its counts in ``SLICES`` compressed parts, each added up in one place.
    Feature -1 stands for all texts.
    """
    width = (1 << BITS) // SLICES

    def count(batches):
        seen = np.zeros((2, 1 << BITS), dtype=np.int32)
        texts = np.zeros(2, dtype=np.int64)
        for batch in batches:
            for text, toxic in zip(column(batch, "text"), column(batch, "toxic"), strict=True):
                seen[toxic, feature_counts(text)[0]] += 1
                texts[toxic] += 1
        if texts.any():
            pack = zstandard.ZstdCompressor(level=1).compress
            rows = [
                (k, pack(seen[:, k * width : (k + 1) * width].astype("<i4").tobytes()))
                for k in range(SLICES)
            ]
            yield to_batch([*rows, (-1, pack(texts.astype("<i4").tobytes()))], part_schema)

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for k, part in zip(column(batch, "slice"), column(batch, "part"), strict=True):
                counts = np.frombuffer(unpack.decompress(part), "<i4").reshape(2, -1)
                totals[k] = totals.get(k, 0) + counts.astype(np.int64)
        for k, counts in totals.items():
            held = np.flatnonzero(counts.any(axis=0))
            feature = held + k * width if k >= 0 else held - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(feature), pa.array(counts[0, held]), pa.array(counts[1, held])],
                names=["feature", "clean", "toxic"],
            )

    part_schema = pa.schema([("slice", pa.int32()), ("part", pa.binary())])
    parts = rows.mapInArrow(count, "slice int, part binary")
    return parts.repartition("slice").mapInArrow(add, "feature long, clean long, toxic long")


def _select_features(counts: DataFrame, n_clean: int, n_toxic: int, limit: int):
    """Features with the largest spread of log-count ratio times the support behind it."""
    clean = (F.col("clean") + 1) / F.lit(n_clean + 2.0)
    toxic = (F.col("toxic") + 1) / F.lit(n_toxic + 2.0)
    told = F.abs(toxic - clean) / F.sqrt(
        toxic * (1 - toxic) / (n_toxic + 2.0) + clean * (1 - clean) / (n_clean + 2.0)
    )
    rows = (
        counts.filter("feature >= 0")
        .select("feature", "clean", "toxic", told.alias("told"))
        .orderBy(F.desc("told"), "feature")
        .limit(limit)  # the size of the model
        .collect()
    )
    return (
        np.array([r["feature"] for r in rows], dtype=np.int64),
        np.array([(r["clean"], r["toxic"]) for r in rows], dtype=np.float64).reshape(-1, 2),
    )


def _ratio(held: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log-count ratio of features in ``held`` of ``n`` texts of either label (clean, toxic)."""
    share = (held + 1) / (n + 2)
    return np.log(share[..., 1] / share[..., 0])


def train(labelled: DataFrame, max_features: int = MAX_FEATURES, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Model from ``labelled (doc_id, text, toxic)``; rows with a null label are not used.

    Without rows, or without both labels, every score is one half of the way it can be:
    the bias is the log-odds of the (smoothed) labels and there are no weights.
    """
    spark = labelled.sparkSession
    short_batches(spark)
    rows = labelled.filter("toxic is not null").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") > 0).cast("int").alias("toxic")
    )
    counts = materialise(_document_counts(rows), "ngram-counts")
    totals = counts.filter("feature = -1").first()
    n_clean, n_toxic = (totals["clean"], totals["toxic"]) if totals else (0, 0)
    prior = float(np.log((n_toxic + 1) / (n_clean + 1)))
    columns = np.full(1 << BITS, -1, dtype=np.int32)
    if not n_clean or not n_toxic:
        return ToxicityModel(columns, np.zeros(0), prior)
    features, held = _select_features(counts, n_clean, n_toxic, max_features)
    columns[features] = np.arange(len(features))

    # A hash of the id orders the rows, so the sample is the same at every run.
    chosen = (
        rows.select("doc_id", F.xxhash64("doc_id").alias("at")).orderBy("at", "doc_id").limit(sample_rows)
    )
    last = chosen.agg(F.max("at")).first()[0]
    sample = rows.withColumn("at", F.xxhash64("doc_id")).filter(F.col("at") <= F.lit(last))
    schema = pa.schema(
        [("at", pa.int64()), ("toxic", pa.int32()), ("found", pa.binary()), ("times", pa.binary())]
    )

    def featurise(batches):
        for batch in batches:
            out = []
            for at, text, toxic in zip(*(column(batch, c) for c in ("at", "text", "toxic")), strict=True):
                found, n = feature_counts(text, columns)
                out.append((at, toxic, found.astype("<i4").tobytes(), n.astype("<i4").tobytes()))
            yield from record_batches(out, schema)

    made = sample.mapInArrow(featurise, "at long, toxic int, found binary, times binary")
    data = made.limit(2 * sample_rows).toArrow()  # an id may repeat beyond the sample's size
    data = data.sort_by([("at", "ascending"), ("toxic", "ascending"), ("found", "ascending"), ("times", "ascending")])
    labels = np.array(data["toxic"], dtype=np.int64)
    sizes = np.array(pc.binary_length(data["found"]), dtype=np.int64) // 4
    place, times = _numbers(data["found"]), _numbers(data["times"])
    del data
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    # Ratios without the row itself: one text less of its label, in the corpus and with the feature.
    n_texts = np.array([n_clean, n_toxic], dtype=np.float64)
    value = np.empty(len(place))
    for k in range(0, len(place), ENTRIES):
        part = slice(k, k + ENTRIES)
        own = np.eye(2)[labels[owner[part]]]
        value[part] = strength(times[part]) * _ratio(held[place[part]] - own, n_texts - own)
    del times
    scale = max(1e-12, float(np.sqrt((value**2).sum() / max(1, len(labels)))))
    value /= scale
    slope, offset = _calibration(owner, place, value, labels, len(features))
    w, bias = _fit(owner, place, value, labels, len(features))
    return ToxicityModel(columns, slope * w * _ratio(held, n_texts) / scale, slope * bias + offset)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """The 32-bit numbers of all values of a column, one after the other."""
    out = np.empty(pc.sum(pc.binary_length(column)).as_py() // 4, "<i4")
    at = 0
    for value in column:
        part = np.frombuffer(value.as_buffer(), "<i4")
        out[at : at + len(part)] = part
        at += len(part)
    return out


def _starts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal ``values`` starts."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)


def _class_weights(labels: np.ndarray) -> np.ndarray:
    """Weight of each row; rows of either label together weigh one half."""
    toxic = max(1, int(labels.sum()))
    clean = max(1, len(labels) - int(labels.sum()))
    return np.where(labels > 0, 0.5 / toxic, 0.5 / clean)


def _calibration(owner, place, value, labels, n_features, folds: int = FOLDS) -> tuple[float, float]:
    """Slope and offset of the logistic curve through scores of rows that a fit has not seen."""
    fold = np.zeros(len(labels), dtype=np.int64)
    for label in (0, 1):
        rows = np.flatnonzero(labels == label)
        if len(rows) < folds:
            return 1.0, 0.0
        fold[rows] = np.arange(len(rows)) % folds
    logits = np.zeros(len(labels))
    for k in range(folds):
        rows = np.flatnonzero(fold != k)
        number = np.full(len(labels), -1, dtype=np.int32)
        number[rows] = np.arange(len(rows))
        seen = number[owner] >= 0
        w, bias = _fit(number[owner[seen]], place[seen], value[seen].astype(np.float32), labels[rows], n_features)
        rest = ~seen
        scored = np.bincount(owner[rest], w[place[rest]] * value[rest], len(labels)) + bias
        logits[fold == k] = scored[fold == k]
    weight, (slope, offset) = _class_weights(labels), (1.0, 0.0)
    for _ in range(50):  # Newton steps; the small term keeps separable scores finite
        p = 1 / (1 + np.exp(-np.clip(slope * logits + offset, -500, 500)))
        error, bend = weight * (p - labels), weight * p * (1 - p)
        gradient = np.array([error @ logits + 1e-4 * (slope - 1), error.sum()])
        middle = bend @ logits
        curve = np.array([[bend @ logits**2 + 1e-4, middle], [middle, bend.sum() + 1e-6]])
        change = np.clip(np.linalg.solve(curve, gradient), -2, 2)
        slope, offset = slope - change[0], offset - change[1]
        if np.abs(change).max() < 1e-9:
            break
    return (float(slope), float(offset)) if slope > 0 and np.isfinite(offset) else (1.0, 0.0)


def _fit(owner, place, value, labels, n_features, steps: int = 300, ridge: float = 1e-4):
    """Logistic regression by full-batch Adam steps; values come in the order of their rows.

    Rows of both labels weigh the same in sum.
    """
    value, weight, bias = value.astype(np.float32, copy=False), _class_weights(labels), 0.0
    by_feature = np.argsort(place, kind="stable")
    owner_f, value_f, place_f = owner[by_feature], value[by_feature], place[by_feature]
    del by_feature
    row_starts, feature_starts = _starts(owner), _starts(place_f)
    rows, held = owner[row_starts], place_f[feature_starts]
    del place_f
    z, part = np.zeros(len(labels)), np.zeros(n_features)
    w = np.zeros(n_features)
    moment, square = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        z[:] = bias
        if len(rows):
            z[rows] += np.add.reduceat(value * w.astype(np.float32)[place], row_starts)
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) * weight
        if len(held):
            part[held] = np.add.reduceat(value_f * error.astype(np.float32)[owner_f], feature_starts)
        slope = np.empty(n_features + 1)
        slope[:-1] = part + ridge * w
        slope[-1] = error.sum()
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        change = 0.1 * (1 - step / (steps + 1)) * (moment / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.999**step)) + 1e-9
        )
        w -= change[:-1]
        bias -= change[-1]
    return w, float(bias)


def score(
    docs: DataFrame,
    model: ToxicityModel,
    extra: list[str] | None = None,
    names: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """``extra`` columns of every row (default: doc_id) with its score and its prediction."""
    spark = docs.sparkSession
    short_batches(spark)
    kept = ["doc_id"] if extra is None else extra
    shared = spark.sparkContext.broadcast(model)  # bounded: one weight per hashed feature
    fields = docs.select(*kept).schema

    def run(batches):
        for batch in batches:
            scores = shared.value.scores(column(batch, "__text"))
            arrays = [batch.column(i) for i in range(len(kept))]
            arrays += [
                pa.array(scores, pa.float64()),
                pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*(f"c{i}" for i in range(len(kept))), "score", "predicted"])

    numbered = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)], F.col("text").alias("__text"))
    out = numbered.drop("__text").schema.add("score", "double").add("predicted", "integer")
    scored = numbered.mapInArrow(run, out)
    return scored.select(
        *[F.col(f"c{i}").alias(f.name) for i, f in enumerate(fields)],
        F.col("score").alias(names[0]),
        F.col("predicted").alias(names[1]),
    )


def held_out(doc_id: Column | str) -> Column:
    """Whether a document's labels are kept for checking: crc32 of its id mod 3 is 1."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents that are not held out; a document with several labels counts once."""
    toxic = (
        labels.filter("doc_id is not null and toxic is not null")
        .filter(~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # Up to a checked number the labels go to the texts; beyond it Spark decides, and the texts
    # may be shuffled to them.
    if toxic.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        toxic = F.broadcast(toxic)
    return docs.select("doc_id", "text").filter(~held_out("doc_id")).join(toxic, "doc_id")

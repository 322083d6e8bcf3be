r"""Toxicity by cumulative-link ordinal regression.

A document has a severity grade 0 .. K-1. One weight vector over sparse text features serves all
thresholds: P(grade > k) = sigmoid(w.x - t_k) with t_0 <= t_1 <= ...; the expected severity is the sum
of these probabilities. Thresholds stay ordered because the model holds the first and the logarithms of
the steps. Features are hashed words (A-Z lower-cased, outer punctuation removed) and their beginnings of
three to seven characters, each once per text, damped by the square root of the number of distinct words.
Only features whose number of toxic training rows is `CERTAIN` standard deviations from chance have a weight;
it starts at their smoothed log odds and is pulled back towards them.

The labels say toxic or not, so the grades of the training rows are made from them: grade 0 is not toxic;
toxic rows get the grades 1 .. K-1 by how much of the text is toxic vocabulary, at the quantiles of the
toxic training rows. A feature is toxic vocabulary if its smoothed log odds exceed `strong`.

Fitted on at most `most_rows` labelled rows chosen by a hash of doc_id, toxic and other rows by halves.
Prediction covers every whole text.

Defined results: a null or empty text, or one without words, has severity 0. Documents without a label are
predicted like all others; a repeated label row counts once, contradicting labels count as toxic. Without toxic
or without other labels nothing can be learned and every severity is 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mentiongrid.llm.common import annotate, table
from mentiongrid.session import materialise

BUCKETS = 1 << 18
GRADES = 4
CERTAIN = 5.0
_EDGES = b".,;:!?\"'()[]{}<>*#$%&|-_/\\"
_CACHE = 200_000


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray  # one per bucket
    thresholds: np.ndarray  # GRADES - 1, ascending; empty if nothing was learned


class _Buckets(dict):
    """Word to the buckets of its features; emptied when full."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > _CACHE:
            self.clear()
        core = (word.strip(_EDGES) or word).decode("utf-8", "surrogatepass")
        parts = [core, *(f"^{core[:k]}" for k in range(3, min(7, len(core)) + 1))]
        value = self[word] = tuple(xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts)
        return value


def feature_buckets(text: str | None, known: dict[bytes, tuple[int, ...]]) -> np.ndarray:
    """The number of distinct words of a text, and the distinct buckets of their features."""
    words = set((text or "").encode("utf-8", "surrogatepass").lower().split())
    buckets = np.unique(np.fromiter(chain.from_iterable(map(known.__getitem__, words)), np.int32))
    return np.concatenate([np.array([len(words)], np.int32), buckets])


def _training_rows(documents: DataFrame, labels: DataFrame, most_rows: int) -> DataFrame:
    """At most `most_rows` rows (doc_id, text, toxic). Ids are chosen first, so few texts move."""
    usable = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    usable = materialise(usable, "labels-once")
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect() if r["toxic"] in (0, 1)}
    half = most_rows // 2
    h = F.xxhash64("doc_id")
    # About four times the rows needed are ranked, whatever the number of labels.
    share = F.when(F.col("toxic") == 1, min(1.0, 4 * half / max(1, counts.get(1, 0)))).otherwise(min(1.0, 4 * half / max(1, counts.get(0, 0))))
    some = usable.where(F.col("toxic").isin(0, 1) & (F.pmod(h, F.lit(1 << 40)) < share * float(1 << 40)))
    chosen = some.withColumn("n", F.row_number().over(Window.partitionBy("toxic").orderBy(h, "doc_id"))).where(F.col("n") <= half).drop("n")
    rows = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    again = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text")  # ids may repeat
    return rows.withColumn("n", F.row_number().over(again)).where(F.col("n") <= half).drop("n")


def fit(documents: DataFrame, labels: DataFrame, most_rows: int = 6000, strong: float = 3.0, rounds: int = 150, pull: float = 1e-3) -> OrdinalModel:
    def work(texts):
        known = _Buckets()
        for text in texts:
            yield (feature_buckets(text, known).tobytes(),)

    got = annotate(_training_rows(documents, labels, most_rows), ["doc_id", "toxic"], ["text"], work, "x binary")
    rows = got.select("row.doc_id", "row.toxic", "x").toArrow().sort_by([("doc_id", "ascending"), ("toxic", "ascending")])
    found = [np.frombuffer(b, np.int32) for b in rows.column("x").to_pylist()]
    return learn(found, np.array(rows.column("toxic").to_pylist(), np.int64), strong, rounds, pull)


def learn(found: list[np.ndarray], toxic: np.ndarray, strong: float = 3.0, rounds: int = 150, pull: float = 1e-3) -> OrdinalModel:
    """From the feature vectors and labels of the training rows."""
    keep = [i for i, x in enumerate(found) if x[0] > 0]
    found, toxic = [found[i] for i in keep], toxic[keep]
    if len(set(toxic.tolist())) < 2:
        return OrdinalModel(np.zeros(BUCKETS, np.float32), np.zeros(0))
    words = np.array([x[0] for x in found])
    columns, owner = np.concatenate([x[1:] for x in found]), np.repeat(np.arange(len(found)), [len(x) - 1 for x in found])
    bad = toxic[owner] == 1
    in_bad, in_good = (np.bincount(columns[m], minlength=BUCKETS) for m in (bad, ~bad))
    share_bad, both = toxic.mean(), in_bad + in_good
    expected = both * share_bad
    odds = np.log((in_bad + 1) / (expected + 1)) - np.log((in_good + 1) / (both - expected + 1))
    # Only features whose count in toxic rows chance does not explain have a weight.
    odds[np.abs(in_bad - expected) < CERTAIN * np.sqrt(expected * (1 - share_bad))] = 0
    share = np.bincount(owner, odds[columns] > strong, len(words)) / words  # of the vocabulary, by its features
    cuts = np.quantile(share[toxic == 1], [k / (GRADES - 1) for k in range(1, GRADES - 1)])
    grade = np.where(toxic == 1, 1 + np.searchsorted(cuts, share, side="right"), 0)
    return _descend(columns, owner, odds, 1 / np.sqrt(words), grade, rounds, pull)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _descend(columns, owner, odds, scale, grade, rounds: int, pull: float) -> OrdinalModel:
    """Penalised likelihood of the cumulative-link model, by adaptive gradient steps (Adam).

    A weight is odds * (1 + change); the penalty holds the changes near 0.
    """
    used, place = np.unique(columns, return_inverse=True)
    n, k = len(grade), GRADES - 1
    value, m = scale[owner] * odds[columns], len(used)
    # the changes, the common factor, the first threshold, and the logarithms of the steps to the others
    state = np.concatenate([np.zeros(m), [1.0, 0.0], np.zeros(k - 1)])
    first, second = np.zeros_like(state), np.zeros_like(state)
    rate = np.concatenate([np.full(m, 0.02), np.full(k + 1, 0.1)])
    for step in range(1, rounds + 1):
        change, factor, t0, steps = state[:m], state[m], state[m + 1], np.exp(state[m + 2 :])
        thresholds = np.concatenate([[-np.inf], t0 + np.concatenate([[0.0], np.cumsum(steps)]), [np.inf]])
        plain = np.bincount(owner, (1 + change[place]) * value, n)
        z = factor * plain
        low, high = z - thresholds[grade], z - thresholds[grade + 1]  # P(grade) = s(low) - s(high)
        s_low, s_high = np.where(np.isinf(low), 1.0, _sigmoid(low)), np.where(np.isinf(high), 0.0, _sigmoid(high))
        likely = np.maximum(s_low - s_high, 1e-9)
        d_low, d_high = s_low * (1 - s_low) / likely / n, s_high * (1 - s_high) / likely / n
        d_z = d_low - d_high
        d_t = np.bincount(grade, -d_low, k + 1)[1:] + np.bincount(grade, d_high, k + 1)[:k]
        d_steps = np.cumsum(d_t[::-1])[::-1][1:] * steps
        d_change = factor * np.bincount(place, d_z[owner] * value, m) - pull * change
        slope = np.concatenate([d_change, [(d_z * plain).sum(), d_t.sum()], d_steps])
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        state = state + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = state[m] * (1 + state[:m]) * odds[used]
    return OrdinalModel(weights, state[m + 1] + np.concatenate([[0.0], np.cumsum(np.exp(state[m + 2 :]))]))


def predict(model: OrdinalModel, x: np.ndarray) -> tuple[float, int, float, bool]:
    """expected_severity, severity, p_toxic and toxic of a feature vector."""
    if not x[0] or not len(model.thresholds):
        return 0.0, 0, 0.0, False
    above = _sigmoid(float(model.weights[x[1:]].sum()) / np.sqrt(x[0]) - model.thresholds)
    each = -np.diff(np.concatenate([[1.0], above, [0.0]]))
    return float(above.sum()), int(np.argmax(each)), float(above[0]), bool(above[0] >= 0.5)


def grade_severity(documents: DataFrame, model: OrdinalModel, keep=("doc_id",)) -> DataFrame:
    """`row`, expected_severity (0 .. GRADES-1), severity (the likeliest grade), p_toxic, toxic."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers, 1 MB

    def work(texts):
        model, known = shared.value, _Buckets()
        for text in texts:
            yield predict(model, feature_buckets(text, known))

    return annotate(documents, keep, ["text"], work, "expected_severity double, severity int, p_toxic double, toxic boolean")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents, table(spark, sf_dir, "labels"))
    return grade_severity(documents, model).select("row.*", "expected_severity", "severity", "p_toxic", "toxic")


QUERIES = {"op8_toxicity": op8_toxicity}
SQL: dict[str, str] = {}

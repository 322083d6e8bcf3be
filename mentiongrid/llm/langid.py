"""Language identification with error-correcting output codes.

Every language owns a codeword of +1/-1 bits. One linear classifier per bit, over hashed
character n-grams (1 to 3 code points of the lower-cased letters, runs of other characters
count as one blank), predicts a margin. Decoding weighs the logistic loss of every bit by how
well that bit did on validation rows of the language, and takes the codeword of least loss. A
document is `ambiguous` if the signs of its margins lie outside the correcting radius of the
codeword, or if its score is below one half.

Only the classifiers are fitted on a sample: at most `per_language` rows of each language
and about `total` in all, chosen by a hash of doc_id. Prediction covers every whole text.

Defined results: a text that is null, empty or without letters is `und` with score 0. Rows
without text or lang teach nothing; without any usable row every text is `und`. Repeated
rows get equal predictions. Ties of the loss go to the language first in code-point order.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mentiongrid.llm.common import annotate, table
from mentiongrid.session import materialise

UNKNOWN = "und"
RESULT = "lang_pred string, score double, runner_up string, bit_errors int, ambiguous boolean"
_CHUNK = 1 << 20


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1/-1
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray
    trust: np.ndarray  # languages x bits, rows sum to 1
    radius: int


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def features(text: str, buckets: int) -> np.ndarray | None:
    """Square roots of the n-gram shares (a unit vector), or None without letters."""
    counts, tail, found = np.zeros(buckets, np.int64), np.array([32], np.uint32), False
    shift = np.uint32(32 - buckets.bit_length() + 1)
    for start in range(0, len(text), _CHUNK):
        points = np.frombuffer(text[start : start + _CHUNK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        found = found or bool(letter.any())
        before = np.empty_like(letter)
        before[0], before[1:] = tail[-1] != 32, letter[:-1]
        new = np.where(letter, points, np.uint32(32))[letter | before]
        run = np.concatenate([tail, new])
        one = run * np.uint32(0x9E3779B1)
        two = one[:-1] * np.uint32(31) + one[1:]
        three = two[:-1] * np.uint32(31) + one[2:]
        # An n-gram belongs to the chunk that holds its last character.
        for grams in (one[len(run) - len(new) :], two[max(0, len(tail) - 1) :], three[max(0, len(tail) - 2) :]):
            mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA77)
            counts += np.bincount(mixed >> shift, minlength=buckets)
        tail = run[-2:]
    if not found:
        return None
    return np.sqrt(counts / counts.sum())


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords: all splits up to five languages, else the random code of best distance."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 5:
        splits = [[1 if i == 0 or (s >> (i - 1)) & 1 else -1 for i in range(n)] for s in range(2 ** (n - 1) - 1)]
        return np.array(splits, np.float64).T.reshape(n, -1)
    bits, rng, best, most = int(np.ceil(10 * np.log2(n))), np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, bits))
        if np.abs(code.sum(0)).max() < n and (d := _distance(code)) > most:
            best, most = code, d
    return best


def _distance(codes: np.ndarray) -> int:
    n, bits = codes.shape
    if n < 2:
        return bits
    apart = (bits - codes @ codes.T) / 2
    return int(apart[~np.eye(n, dtype=bool)].min())


def _sample(labelled: DataFrame, per_language: int, total: int) -> DataFrame:
    """At most `per_language` rows (text, lang) of each language, by a hash of doc_id.

    Ids are chosen first from two narrow columns; a share of the hashes, some four times as many
    rows as needed, goes through the ranking. The ids chosen, at most `total` or 20 for each language,
    are broadcast, so no text is shuffled except those chosen.
    """
    usable = labelled.where("text is not null and lang is not null and doc_id is not null")
    counts = materialise(usable.groupBy("lang").count(), "language-counts")
    n = max(20, min(per_language, total // max(1, counts.count())))
    hashed = F.xxhash64("doc_id")
    some = usable.select("doc_id", "lang").join(counts, "lang").where(F.pmod(hashed, F.lit(1 << 40)).cast("double") * F.col("count") < F.lit(float(4 * n * (1 << 40))))
    first = Window.partitionBy("lang").orderBy(hashed, "doc_id")
    ids = some.select("doc_id", "lang").withColumn("n", F.row_number().over(first)).where(F.col("n") <= n)
    ids = ids.select("doc_id", "lang").distinct()
    again = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text")
    rows = usable.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"])  # more rows than ids if ids repeat
    return rows.withColumn("n", F.row_number().over(again)).where(F.col("n") <= n).select("lang", "text", "doc_id")


def fit(
    labelled: DataFrame, buckets: int = 4096, per_language: int = 600, total: int = 4000, rounds: int = 150, penalty: float = 1e-5
) -> LanguageModel:
    """Learn from rows (doc_id, text, lang); features are made on the executors."""

    def work(texts):
        for text in texts:
            x = features(text, buckets)
            yield (None if x is None else x.astype(np.float16).tobytes(),)

    got = annotate(_sample(labelled, per_language, total), ["lang", "doc_id"], ["text"], work, "x binary")
    rows = got.where("x is not null").select(F.lit(0).alias("one"), "row.lang", "row.doc_id", "x")
    # The sample is bounded, so one task learns from it, and only the model comes to the driver.
    learnt = rows.groupBy("one").applyInArrow(lambda t: pa.table({"model": [pickle.dumps(_learn(t, buckets, rounds, penalty))]}), "model binary")
    found = learnt.collect()
    return pickle.loads(found[0]["model"]) if found else _without_bits([], buckets)


def _without_bits(languages: list[str], buckets: int) -> LanguageModel:
    empty = np.zeros((len(languages), 0))
    return LanguageModel(languages, empty, np.zeros((buckets, 0)), np.zeros(0), empty, 0)


def _learn(rows: pa.Table, buckets: int, rounds: int, penalty: float) -> LanguageModel:
    rows = rows.sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    languages = sorted(set(rows.column("lang").to_pylist()))
    codes = codewords(len(languages))
    if codes.shape[1] == 0:
        return _without_bits(languages, buckets)
    x = np.stack([np.frombuffer(b, np.float16) for b in rows.column("x").to_pylist()]).astype(np.float32)
    index = {name: i for i, name in enumerate(languages)}
    y = np.array([index[v] for v in rows.column("lang").to_pylist()])
    check = np.arange(len(y)) % 5 == 4
    if len(set(y[~check])) < len(languages):
        check[:] = False
    weights, bias = _logistic(x[~check], codes[y[~check]], rounds, penalty)
    seen = check if check.any() else ~check
    right = (x[seen] @ weights + bias) * codes[y[seen]] > 0
    trust = np.stack([(right[y[seen] == i].sum(0) + 1) / ((y[seen] == i).sum() + 2) for i in range(len(languages))])
    return LanguageModel(languages, codes, weights.astype(np.float64), bias.astype(np.float64), trust / trust.sum(1, keepdims=True), (_distance(codes) - 1) // 2)


def _logistic(x: np.ndarray, signs: np.ndarray, rounds: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """One logistic classifier per column of `signs`, all by accelerated gradient steps."""
    n, bits = len(x), signs.shape[1]
    signs = signs.astype(np.float32)
    weights, bias = np.zeros((x.shape[1], bits), np.float32), np.zeros(bits, np.float32)
    ahead, ahead_bias, step = weights, bias, np.float32(2.0)  # |x| = 1: the slope changes by 1/2 at most
    for k in range(rounds):
        pull = signs / (1 + np.exp(np.clip(signs * (x @ ahead + ahead_bias), -30, 30))) / n
        new = ahead + step * (x.T @ pull - np.float32(penalty) * ahead)
        new_bias = ahead_bias + step * pull.sum(0)
        momentum = np.float32(k / (k + 3))
        ahead, ahead_bias = new + momentum * (new - weights), new_bias + momentum * (new_bias - bias)
        weights, bias = new, new_bias
    return weights, bias


def decode(model: LanguageModel, margins: np.ndarray) -> tuple:
    names, codes = model.languages, model.codes
    if len(names) == 1:
        return names[0], 1.0, None, 0, False
    loss = (model.trust * np.logaddexp(0, -codes * margins)).sum(1)
    order = np.argsort(loss, kind="stable")
    likely = np.exp(-codes.shape[1] * (loss - loss[order[0]]))
    score, errors = float(1 / likely.sum()), int((codes[order[0]] * margins <= 0).sum())
    return names[order[0]], score, names[order[1]], errors, errors > model.radius or score < 0.5


def identify(documents: DataFrame, model: LanguageModel, keep=("doc_id",)) -> DataFrame:
    """`row` (the columns `keep`) and the prediction for every row of `documents`."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a few buckets x bits numbers
    buckets = model.weights.shape[0]

    def work(texts):
        model = shared.value
        for text in texts:
            x = features(text, buckets) if text and model.languages else None
            yield (UNKNOWN, 0.0, None, 0, False) if x is None else decode(model, x @ model.weights + model.bias)

    return annotate(documents, keep, ["text"], work, RESULT)


def with_fold(documents: DataFrame) -> DataFrame:
    """Adds `held_out`: crc32 of the id, written as text, leaves 2 modulo 4 (false without an id)."""
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    return documents.withColumn("held_out", F.coalesce(rest == 2, F.lit(False)))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = with_fold(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    model = fit(documents.where("not held_out"))
    found = identify(documents.select("doc_id", "held_out", "text"), model, ("doc_id", "held_out"))
    return found.select("row.*", "lang_pred", "score", "runner_up", "bit_errors", "ambiguous")


QUERIES = {"op1_language_id": op1_language_id}
SQL: dict[str, str] = {}

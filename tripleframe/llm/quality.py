"""Quality classification by ordinal cumulative-link regression.

Graded ratings 0 .. G-1 are modelled as P(grade > k) = sigmoid(w.x - theta_k):
one vector of weights over hashed text features is shared by all grades, ordered
thresholds tell the grades apart. Features are the distinct words of the whole
text and its shapes (shares of capitals, symbols, repeated words ...), hashed
into one space. The result is the expected grade and the tail probability of the
grade that selection asks for.

The model is fitted on the driver from a bounded sample of rated documents
(MAX_RATED, a parameter); its size is fixed by BUCKETS. All documents are scored.

Defined results
* null text: an empty text, whose features are its shapes; scored like any other.
* null identifiers, repeated rows: rows of their own. Very long texts: whole.
* empty table: empty result. No rating at all: every document gets the same,
  neutral probabilities and is kept. Ratings outside 0 .. G-1 or null are ignored.
* other columns are ignored by grade() and returned untouched by select_good().
"""

from __future__ import annotations

import math
import operator
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, kept, lean

#: Rated documents at most that the model is fitted on, hash buckets, and documents that a bucket needs for a weight.
MAX_RATED, BUCKETS, LEAST_DOCS = 16384, 1 << 17, 8
#: A bucket gets a weight if its share of documents on the two sides of some threshold differs by so many standard
#: errors and by this factor; common words differ a little, by chance and by copies, and would drown what tells.
CLEAR, LIFT = 5.0, 4.0
#: Gradient steps, their size, and the strength of the pull to zero for each document.
STEPS, RATE, PULL = 500, 0.15, 1e-5

_STRIP = ".,;:!?|#$%&*()[]{}\"'"
_SHARES = (0.0, 0.01, 0.03, 0.1, 0.2, 0.4, 0.7)


def features(text: str) -> list[int]:
    """Buckets of the text's features."""
    words = text.split()
    n = max(1, len(words))
    mask, crc = BUCKETS - 1, zlib.crc32
    found = {crc(w.strip(_STRIP).lower().encode("utf-8", "surrogatepass")) & mask for w in set(words)}
    chars = max(1, len(text))
    shapes = {
        "upper": sum(map(str.isupper, words)) / n,
        "repeat": sum(map(operator.eq, words, words[1:])) / n,
        "repeat3": sum(map(operator.eq, words, words[3:])) / n,
        "symbols": sum(map(text.count, "#$%&*|<>{}\\^~")) / n,
        "shout": text.count("!") / n,
        "bars": text.count("|") / n,
        "digits": sum(map(text.count, "0123456789")) / chars,
        "distinct": 1 - len(set(words)) / n,
    }
    for name, share in shapes.items():
        found.update(crc(f"\0{name}>{s}".encode()) & mask for s in _SHARES if share > s)
    found.add(crc(b"\0size%d" % min(12, int(math.log2(n + 1)))) & mask)
    return sorted(found)


def fit(rows: list[tuple[int, list[int]]], grades: int) -> tuple[dict[int, float], list[float]]:
    """Weights by bucket and ordered thresholds, from (grade, buckets of the features)."""
    if not rows:
        return {}, [0.0] * (grades - 1)
    y = np.array([g for g, _ in rows])
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(f) for _, f in rows])
    bucket = np.concatenate([np.asarray(f, dtype=np.int32) for _, f in rows])
    docs = np.bincount(bucket, minlength=BUCKETS)
    used = np.flatnonzero((docs >= min(LEAST_DOCS, 1 + len(rows) // 100)) & _tells(y, row, bucket, docs, grades))
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))
    held = place[bucket] >= 0
    row, col = row[held].astype(np.intp), place[bucket[held]]
    above = [(y > k).mean().clip(1e-3, 1 - 1e-3) for k in range(grades - 1)]
    w, theta = np.zeros(len(used)), np.array([math.log((1 - a) / a) for a in above])
    first, second = [np.zeros(len(used) + grades - 1) for _ in range(2)]
    for step in range(1, STEPS + 1):  # Adam over all rows
        z = np.bincount(row, weights=w[col], minlength=len(rows))
        tail = np.column_stack([np.ones(len(rows)), *[_sigmoid(z - t) for t in theta], np.zeros(len(rows))])
        at = np.arange(len(rows))
        p = np.maximum(tail[at, y] - tail[at, y + 1], 1e-9)
        slope = tail * (1 - tail)
        by_z = (slope[at, y] - slope[at, y + 1]) / p / len(rows)
        grad_w = PULL * w - np.bincount(col, weights=by_z[row], minlength=len(used))
        grad_t = np.array([(np.where(y == k + 1, slope[at, k + 1], 0) - np.where(y == k, slope[at, k + 1], 0)) @ (1 / p) / len(rows) for k in range(grades - 1)])
        grad = np.concatenate([grad_w, grad_t])
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, theta = w - move[: len(used)], np.maximum.accumulate(theta - move[len(used) :] + 1e-6 * np.arange(grades - 1))
    return {int(b): float(x) for b, x in zip(used, w, strict=True) if x}, [float(t) for t in theta]


def _tells(y: np.ndarray, row: np.ndarray, bucket: np.ndarray, docs: np.ndarray, grades: int) -> np.ndarray:
    """Which buckets tell the grades above some threshold from those below; the rest would only fit noise."""
    out, share = np.zeros(BUCKETS, bool), docs / len(y)
    for k in range(grades - 1):
        high = y > k
        n, m = int(high.sum()), int((~high).sum())
        if n and m:
            above = np.bincount(bucket, weights=high[row], minlength=BUCKETS)
            error = np.sqrt(share * (1 - share) * (1 / n + 1 / m)) + 1e-12
            p, q = above / n, (docs - above) / m
            out |= (np.abs(p - q) / error >= CLEAR) & (np.maximum(p, q) >= LIFT * np.minimum(p, q))
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(docs: DataFrame, ratings: DataFrame, grades: int, id_col: str = "doc_id", text_col: str = "text", max_rated: int = MAX_RATED) -> tuple[dict[int, float], list[float]]:
    """fit() on at most max_rated rated documents, those of smallest hash; ratings: identifier and grade, its first two columns."""
    chosen = (
        ratings.select(F.col(ratings.columns[0]).alias("_rid"), F.col(ratings.columns[1]).cast("int").alias("_grade"))
        .filter(F.col("_rid").isNotNull() & F.col("_grade").between(0, grades - 1))
        .orderBy(F.xxhash64("_rid"), "_rid", "_grade")
        .limit(max_rated)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    rated = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_rid")).select("_grade", "_text", "_rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = [np.array(features(t.as_py()), dtype=np.int32).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2)], ["_grade", "_found", "_rid"])

    found = rated.mapInArrow(lean(run), f"_grade int, _found binary, _rid {docs.schema[id_col].dataType.simpleString()}")
    rows = found.groupBy("_rid").agg(F.min("_grade").alias("_grade"), F.min("_found").alias("_found")).collect()  # max_rated rows at most
    rows.sort(key=lambda r: str(r[0]))  # the same sums whatever the order of partitions
    return fit([(r[1], np.frombuffer(bytes(r[2]), dtype=np.int32)) for r in rows], grades)


def grade(docs: DataFrame, ratings: DataFrame, grades: int = 3, least: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, expected_grade, tail_probability (of grade `least` or better, the best if not given), grade, kept.

    kept: the tail probability is 0.5 or more.
    """
    tails_of, kind = _scorer(docs, ratings, grades, id_col, text_col), docs.schema[id_col].dataType.simpleString()
    wanted = _wanted(grades, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = tails_of(batch.column(1))
            bounds = [np.ones(len(batch)), *tails, np.zeros(len(batch))]
            best = np.argmax([a - b for a, b in zip(bounds, bounds[1:])], axis=0)
            out = [pa.array(sum(tails), pa.float64()), pa.array(tails[wanted], pa.float64()), pa.array(best.astype(np.int32)), pa.array(tails[wanted] >= 0.5)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], ["_id", "expected_grade", "tail_probability", "grade", "kept"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = f"_id {kind}, expected_grade double, tail_probability double, grade int, kept boolean"
    return rows.mapInArrow(lean(run), schema).withColumnRenamed("_id", id_col)


def _wanted(grades: int, least: int | None) -> int:
    """The place of the tail that selection asks for."""
    return (grades - 1 if least is None else least) - 1


def _dense(by_bucket: dict[int, float]) -> np.ndarray:
    """The weights of all buckets."""
    out = np.zeros(BUCKETS)
    out[list(by_bucket)] = list(by_bucket.values())
    return out


def _scorer(docs: DataFrame, ratings: DataFrame, grades: int, id_col: str, text_col: str) -> Callable[[pa.Array], list[np.ndarray]]:
    """A fitted model, as a function of a column of texts: their tail probabilities at each threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, ratings, grades, id_col, text_col))  # bounded by BUCKETS

    def tails_of(texts: pa.Array) -> list[np.ndarray]:
        model = shared.value
        dense, cuts, _ = kept(("quality", id(model)), lambda: (_dense(model[0]), model[1], model))
        z = np.array([dense[features(t.as_py() or "")].sum() for t in texts])
        return [_sigmoid(z - t) for t in cuts]

    return tails_of


def select_good(docs: DataFrame, ratings: DataFrame, grades: int = 3, least: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose grade is good enough, with all their columns; each row by its own text, whatever its identifier."""
    tails_of, wanted, at = _scorer(docs, ratings, grades, id_col, text_col), _wanted(grades, least), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(tails_of(batch.column(at))[wanted] >= 0.5)).select(range(at))

    return docs.select("*", F.col(text_col).cast("string").alias("_scored")).mapInArrow(lean(run), docs.schema)


def ratings_of(labels: DataFrame) -> DataFrame:
    """Grades of the labels table: 0 poor, 1 well written but toxic, 2 good."""
    grade_col = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade_col.alias("grade"))

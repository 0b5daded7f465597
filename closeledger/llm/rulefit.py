"""Quality classifier: a sparse ensemble of conjunctive rules.

1. Text statistics of every whole document are counted in numpy, in Arrow
   batches of the text alone.
2. Small regression trees are grown in numpy on bootstrap samples of a bounded
   labelled sample (``FIT_ROWS`` rows, chosen by hash of the id); every path
   from a root to a node becomes a rule, a conjunction of ``stat <= cut``.
3. An L1-penalised logistic regression (proximal gradient) keeps few rules.
4. The kept rules are compiled into one Spark column over the statistics.

Defined cases: a null or empty text has all statistics 0 and is scored as
such; no labelled row, or one class only, gives the constant score of the
class share (0.5 without rows); several labels of a document count by their
mean, 0.5 and more being 1, null labels not at all; repeated rows and null
ids are scored like others; an empty table gives no rows; further columns
stay out of the statistics.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from closeledger.llm.common import id_remainder, read_table, release, ship, slices, stored

#: Bound of the labelled sample that the model is fitted on.
FIT_ROWS = 20_000


#: Names of the statistics, in the order of a rule's numbers.
STATS = (
    "chars words lines word_length letters capitals digits marks stops mark_runs lone_marks distinct_words distinct_lines words_a_line"
).split()

_SPACE, _LOWER, _UPPER, _DIGIT, _STOP, _MARK, _HIGH = range(7)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[0x80:] = _HIGH
for _characters, _kind in (
    (" \t\n\v\f\r", _SPACE),
    (string.ascii_lowercase, _LOWER),
    (string.ascii_uppercase, _UPPER),
    (string.digits, _DIGIT),
    (".,;:!?'\"()-", _STOP),
):
    _KIND[[ord(c) for c in _characters]] = _kind


def statistics(text: str) -> list[float]:
    """The statistics of one whole text; all 0 for an empty one."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    kinds = _KIND[data]
    n = np.bincount(kinds, minlength=7).astype(float)
    chars = float(len(text))
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = kinds != _SPACE
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    marked = np.zeros(len(data) + 2, np.int8)
    marked[1:-1] = (kinds == _STOP) | (kinds == _MARK)
    so_far = np.cumsum(marked[:-1], dtype=np.int64)
    lone = np.count_nonzero(so_far[ends] - so_far[starts] == ends - starts)
    runs = np.count_nonzero(marked[1:-1] & marked[2:] & ~marked[:-2])
    words, lines = text.split(), [x for x in text.split("\n") if x]
    letters = n[_LOWER] + n[_UPPER] + n[_HIGH]
    over = lambda a, b: float(a) / float(b) if b else 0.0
    return [
        chars,
        float(len(words)),
        float(len(lines)),
        over(chars, len(words)),
        over(letters, len(data)),
        over(n[_UPPER], letters),
        over(n[_DIGIT], len(data)),
        over(n[_MARK], len(data)),
        over(n[_STOP], len(words)),
        over(runs, len(words)),
        over(lone, len(words)),
        over(len(set(words)), len(words)),
        over(len(set(lines)), len(lines)),
        over(len(words), len(lines)),
    ]


Condition = tuple[int, bool, float]  # statistic, at most the cut or above it, cut


@dataclass
class RuleModel:
    rules: list[tuple[Condition, ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    base: float = 0.0

    def column(self) -> Column:
        """Probability of label 1 as a Spark expression over the statistics."""
        total = F.lit(self.base)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            held = F.lit(True)
            for stat, low, cut in rule:
                c = F.col(STATS[stat])
                held = held & ((c <= F.lit(cut)) if low else (c > F.lit(cut)))
            total = total + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The same in numpy, for tests."""
        total = rule_matrix(self.rules, x) @ np.array(self.weights) + self.base if self.rules else np.full(len(x), self.base)
        return 1.0 / (1.0 + np.exp(-total))


def rule_matrix(rules: list[tuple[Condition, ...]], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for stat, low, cut in rule:
            out[:, j] *= (x[:, stat] <= cut) if low else (x[:, stat] > cut)
    return out


def _best_cut(x: np.ndarray, y: np.ndarray, stats: np.ndarray, least: int) -> tuple[float, int, float] | None:
    """Statistic and cut with the largest fall of the squared error."""
    best, whole = None, y.sum() ** 2 / len(y)
    for s in stats:
        order = np.argsort(x[:, s], kind="stable")
        v, left = x[order, s], np.cumsum(y[order])
        n = np.arange(1, len(y))
        ok = (v[1:] > v[:-1]) & (n >= least) & (len(y) - n >= least)
        if not ok.any():
            continue
        gain = np.where(ok, left[:-1] ** 2 / n + (left[-1] - left[:-1]) ** 2 / (len(y) - n) - whole, -1.0)
        i = int(np.argmax(gain))
        if gain[i] > 1e-9 and (best is None or gain[i] > best[0]):
            best = (float(gain[i]), int(s), float((v[i] + v[i + 1]) / 2))
    return best


def _paths(x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator, path: tuple[Condition, ...] = ()) -> list[tuple[Condition, ...]]:
    """Rules of one tree: the path to every node but the root."""
    own = [path] if path else []
    if not depth or len(y) < 20 or y.min() == y.max():
        return own
    stats = rng.choice(x.shape[1], max(1, x.shape[1] * 2 // 3), replace=False)
    cut = _best_cut(x, y, stats, max(5, len(y) // 100))
    if cut is None:
        return own
    _, s, at = cut
    low = x[:, s] <= at
    for side, rows in ((True, low), (False, ~low)):
        own += _paths(x[rows], y[rows], depth - 1, rng, (*path, (s, side, at)))
    return own


def fit(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 2e-3, seed: int = 7) -> RuleModel:
    """Grow trees, take their rules, and fit lasso logistic weights."""
    share = float(y.mean()) if len(y) else 0.5
    base = math.log((share * len(y) + 0.5) / ((1 - share) * len(y) + 0.5))
    if not len(y) or share in (0.0, 1.0):
        return RuleModel(base=base)
    rng = np.random.default_rng(seed)
    rules: dict[tuple[Condition, ...], None] = {}
    for _ in range(trees):
        rows = rng.integers(0, len(y), min(len(y), 4000))
        rules |= dict.fromkeys(_paths(x[rows], y[rows].astype(float), depth, rng))
    kept, found = [], rule_matrix(list(rules), x)
    seen: set[bytes] = set()
    for j, rule in enumerate(rules):  # rules that hold for the same rows are one rule
        bits = np.packbits(found[:, j] > 0).tobytes()
        if 0 < found[:, j].mean() < 1 and bits not in seen:
            seen.add(bits)
            kept.append((j, rule))
    if not kept:
        return RuleModel(base=base)
    a = found[:, [j for j, _ in kept]]
    scale = a.std(axis=0)
    a = a / scale
    w, b, z, t = np.zeros(a.shape[1]), base, np.zeros(a.shape[1]), 1.0
    step = 4.0 / (np.linalg.norm(a.T @ a / len(y), 2) + 1.0)
    for _ in range(400):  # accelerated proximal gradient
        p = 1.0 / (1.0 + np.exp(-(a @ z + b)))
        b -= step * float((p - y).mean())
        new = z - step * (a.T @ (p - y)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0.0)
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        z, w = new + (before - 1) / t * (new - w), new
    used = np.flatnonzero(w)
    return RuleModel([kept[i][1] for i in used], [float(w[i] / scale[i]) for i in used], float(b))


def with_statistics(docs: DataFrame, *keep: Column) -> DataFrame:
    """``keep`` columns and the statistics of every row; only the text goes
    to Python."""
    ship(docs.sparkSession)

    def measure(texts: pa.Array) -> pa.Array:
        batch, out = pa.RecordBatch.from_arrays([texts.cast(pa.string())], names=["t"]), []
        for part in slices(iter([batch]), "t"):
            out += [statistics(t or "") for t in part.column("t").to_pylist()]
        found = np.array(out).reshape(-1, len(STATS))
        release()
        return pa.StructArray.from_arrays([pa.array(x) for x in found.T], names=list(STATS))

    kind = StructType([StructField(s, DoubleType()) for s in STATS])
    rows = docs.select(*keep, F.arrow_udf(measure, kind)(F.col("text").cast("string")).alias("_cl_stats"))
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns[:-1]], "_cl_stats.*")


def train(rows: DataFrame, labels: DataFrame, label: str = "quality", limit: int = FIT_ROWS) -> RuleModel:
    """Fit on at most ``limit`` labelled rows of ``rows`` (doc_id and the
    statistics), the first by hash of their id."""
    marks = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
    marks = marks.agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("double").alias("_cl_label"))
    sample = rows.join(marks, "doc_id").select("doc_id", *STATS, "_cl_label")
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).drop("doc_id").toPandas()
    return fit(sample[list(STATS)].to_numpy(float), sample["_cl_label"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame, *keep: Column, learn: Column) -> DataFrame:
    """``keep`` columns, score and predicted of every document; rows where
    ``learn`` holds may be learned from."""
    rows = stored(with_statistics(docs, F.col("doc_id"), learn.alias("_cl_learn"), *keep), "statistics")
    model = train(rows.where("_cl_learn"), labels)
    kept = [c for c in rows.columns if c not in STATS and c not in ("_cl_learn",)]
    out = rows.select(*kept, model.column().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def learnable() -> Column:
    return id_remainder("doc_id", 3) != 1


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from labelled documents whose crc32(doc_id) mod 3 is not 1."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    out = scored(docs, labels, (~learnable()).alias("held_out"), learn=learnable())
    return out.select("doc_id", "held_out", "score", "predicted")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts, columns unchanged."""
    labels = read_table(spark, sf_dir, "labels")
    rows = stored(with_statistics(docs.where(learnable()), F.col("doc_id")), "statistics")
    model = train(rows, labels)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_cl_doc")
    return with_statistics(docs, whole).where(model.column() >= 0.5).select("_cl_doc.*")

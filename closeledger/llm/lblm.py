"""Language-model scoring with a log-bilinear model.

Counts of every training word are made over the whole training corpus in
Spark.  The model's vocabulary grows with the words counted twice or more, up to
``VOCABULARY`` tokens (6.5 MB of parameters), of which one is the end of a text
and one stands for all other words; a word outside is scored as that token
times its smoothed share among such words, so probabilities sum to one.  The
model predicts a token from the two before it: the sum of their context
vectors, each weighted by a diagonal matrix of its distance, times the token's
vector plus its bias.  The ``FLAT`` commonest tokens are predicted directly, the
others in two steps: a class of ``MEMBERS`` words of like frequency, and the word
in its class.  Every word of the vocabulary has its own context vector, token
vector and bias.

Training is noise-contrastive estimation in numpy, of both steps.  Every task
makes one pass over its own training texts from the same start, and Spark
averages each token's parameters, weighted by how often a task has used them.
Scoring is normalised: over all direct tokens and classes, as a product of two
rows of exponentials for each distinct context of a batch, and those of words in
a class through a matrix product with all members.

The ``HEAD`` commonest words that occur twice or more, ties by word, are broadcast
with their counts.  Rarer words leave the scoring task as
(row, word, times) and meet their counts in a join, so no count is missing
however many words there are.

Defined cases: a null text counts as empty, one end token; without training
texts the base is that of the formula at N = V = 0 and the model's scores are
uniform over an empty vocabulary (0.5 / 0.5 = 1 for every unknown word); rows
equal in id and text are scored each; null ids are kept and count as the empty
text in the split; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyarrow import compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from closeledger.llm.common import arrow_map, id_remainder, partitions, ranked, read_table, slices, stored

VOCABULARY = 1 << 15
#: Tokens predicted directly, words of a class.
FLAT, MEMBERS = 512, 128
HEAD = 1 << 18
DIMS = 24
NOISE = 32
#: Noise words in the class of a target.
NOISE_IN = 8
#: Rows of parameters that are averaged together.
ROWS = 256
BATCH = 4096
RATE = 0.1
#: Gradients of a row that are added run by run, all first ones, all second ones.
SHORT = 8
#: Pairs of context tokens that one product takes, tokens whose products are kept.
PRODUCT, COMMON = 512, 2048
#: Targets whose vectors are held at a time while scoring.
PART = 8192
#: Counted words that a task holds before it adds them up, and passes on if many differ.
HELD = 400_000
END, OTHER = 0, 1


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, and their number in each; Arrow's ASCII white
    space is 0x20 and 0x09-0x0D."""
    found = compute.ascii_split_whitespace(compute.ascii_lower(texts.cast(pa.string())))
    words, rows = found.flatten(), compute.list_parent_indices(found)
    there = compute.greater(compute.binary_length(words), 0)
    return words.filter(there), np.bincount(rows.filter(there).to_numpy(), minlength=len(texts))


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) of all words in the texts of ``train``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in slices(batches, "text"):
            words, n = words_of(batch.column("text"))[0].value_counts().flatten()
            held.append(pa.table({"word": words, "c": n}))
            if sum(map(len, held)) > HELD:
                held = [pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])]
                if 2 * len(held[0]) > HELD:
                    yield from held.pop().to_batches()
        for table in held:
            yield from table.to_batches()

    return arrow_map(train.select("text"), count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Counts:
    """Totals of the training tokens, and the counts of common words."""

    tokens: int  # N
    distinct: int  # V
    ends: int
    words: dict[bytes, int]  # number of a common word, commonest first
    c: np.ndarray  # its count

    @property
    def names(self) -> pa.Array:
        """The common words, in order of their numbers."""
        return pa.array(list(self.words), pa.binary()).cast(pa.string())

    @cached_property
    def vocabulary(self) -> int:
        """Words that the model knows by themselves."""
        return min(VOCABULARY - 2, int((self.c > 1).sum()))

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def other_share(self, c: np.ndarray) -> np.ndarray:
        """log10 of a word's share among the words outside the vocabulary."""
        known = self.vocabulary
        rest = self.tokens - self.ends - self.c[:known].sum()
        kinds = self.distinct - (self.ends > 0) - known
        return np.log10((c + 0.5) / (rest + 0.5 * (kinds + 1)))


def commonest(words: DataFrame, n: int) -> DataFrame:
    """The ``n`` words of the largest counts, ties by word (all, if fewer).
    Words are counted by the magnitude of their count, some hundred rows; only
    those of the magnitude that the cut falls into are ranked, in Spark."""
    step = F.floor(F.log2(F.col("c")) * 8).cast("int")
    kept, cut, room = 0, None, 0
    for row in words.groupBy(step.alias("m")).agg(F.count("*").alias("n")).orderBy(F.desc("m")).collect():
        if kept + row["n"] > n:
            cut, room = row["m"], n - kept
            break
        kept += row["n"]
    if cut is None:
        return words
    order, _ = ranked(words.where(step == cut).withColumn("_cl_less", -F.col("c")), ["_cl_less", "word"], "_cl_rank", "words-at-the-cut")
    return words.where(step > cut).unionByName(order.where(F.col("_cl_rank") < room).select(*words.columns))


def counts_of(words: DataFrame, ends: int) -> Counts:
    """``words`` is the stored table of word counts."""
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head = commonest(words.where("c > 1"), HEAD).toArrow().to_pylist()
    head.sort(key=lambda r: (-r["c"], r["word"].encode("utf-8")))
    names = {r["word"].encode("utf-8"): i for i, r in enumerate(head)}
    return Counts(total + ends, distinct + (ends > 0), ends, names, np.array([r["c"] for r in head], dtype=np.int64))


def numbered(words: pa.Array, names: pa.Array) -> np.ndarray:
    """Numbers of words in ``names`` (-1: not there)."""
    return compute.index_in(words, value_set=names).fill_null(-1).to_numpy()


def model_tokens(numbers: np.ndarray, sizes: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Model tokens of texts of ``sizes`` words, each with its end, and the tokens
    one and two before each; before a text stand ends."""
    ends = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(numbers) + len(sizes), bool)
    inside[ends] = False
    found = np.full(len(inside), END, np.int64)
    found[inside] = np.where((numbers >= 0) & (numbers < known), numbers + 2, OTHER)
    padded = np.concatenate([[END, END], found])
    one, two = padded[1:-1], padded[:-2].copy()
    two[ends - sizes] = END
    return found, one, two


def top(found: np.ndarray) -> np.ndarray:
    """The direct tokens, or classes, of tokens."""
    return np.where(found < FLAT, found, FLAT + (found - FLAT) // MEMBERS)


def _sums(take: Callable[[np.ndarray], np.ndarray], order: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the gradients ``take(order)`` over runs.  Most runs are short:
    their first members are added run by run, all first ones, all second ones."""
    out = take(order[starts])
    for k in range(1, SHORT):
        runs = np.flatnonzero(sizes > k)
        if not len(runs):
            return out
        out[runs] += take(order[starts[runs] + k])
    runs = np.flatnonzero(sizes > SHORT)
    if len(runs):
        rest = sizes[runs] - SHORT
        ends = np.cumsum(rest)
        places = np.arange(ends[-1]) + np.repeat(starts[runs] + SHORT - (ends - rest), rest)
        out[runs] += np.add.reduceat(take(order[places]), ends - rest, axis=0)
    return out


def _add(p: np.ndarray, s: np.ndarray, used: np.ndarray, rows: np.ndarray, take: Callable[[np.ndarray], np.ndarray]) -> None:
    """One Adagrad step of the rows of ``p`` that the batch uses; ``take`` gives
    the gradients of places of ``rows``."""
    order = np.argsort(rows.astype(np.uint16) if len(p) <= 1 << 16 else rows, kind="stable")
    rows = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    at, sizes = rows[starts], np.diff(np.append(starts, len(rows)))
    g = _sums(take, order, starts, sizes)
    past = s.take(at, axis=0)
    past += g * g
    s[at] = past
    g *= RATE
    past += 1e-10
    g /= np.sqrt(past, out=past)
    g += p.take(at, axis=0)
    p[at] = g
    used[at] += sizes


class LogBilinear:
    """Parameters, a row a token, the bias last: context vectors (bias unused),
    vectors of direct tokens and classes, vectors of words in a class; and two
    diagonals."""

    def __init__(self, unigram: np.ndarray, seed: int = 3) -> None:
        rng, size = np.random.default_rng(seed), len(unigram)
        tops = top(np.arange(size))
        self.size, share = size, np.bincount(tops, unigram)
        made = lambda n: rng.normal(scale=0.1, size=(n, DIMS + 1)).astype(np.float32)
        self.r, self.q, self.m = made(size), made(len(share)), made(max(0, size - FLAT))
        self.d = np.ones((2, DIMS + 1), np.float32)
        self.tables: tuple | None = None
        self.r[:, -1] = 0
        self.q[:, -1] = np.log(share)
        self.m[:, -1] = np.log(unigram[FLAT:] / share[tops[FLAT:]])

    def parts(self) -> list[np.ndarray]:
        return [self.r, self.q, self.m, self.d]

    def rows(self) -> np.ndarray:
        return np.concatenate(self.parts())

    def load(self, rows: np.ndarray) -> LogBilinear:
        at, self.tables = 0, None
        for p in self.parts():
            p[...] = rows[at : at + len(p)]
            at += len(p)
        return self

    def predicted(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """With a last column of ones, for the biases."""
        out = self.r.take(one, axis=0) * self.d[0]
        out += self.r.take(two, axis=0) * self.d[1]
        out[:, -1] = 1
        return out

    def step(self, one: np.ndarray, two: np.ndarray, target: np.ndarray, noise: np.ndarray, inside: np.ndarray, log_noise: np.ndarray, past: list[np.ndarray], used: list[np.ndarray]) -> None:
        """One Adagrad step of noise-contrastive estimation.  The batch shares
        its noise among direct tokens and classes; ``inside`` is uniform noise
        in [0, 1) for the words of a class, a row a target."""
        n, goal, self.tables = len(target), top(target), None
        made = self.predicted(one, two)
        goals = self.q.take(goal, axis=0)
        real = np.einsum("ij,ij->i", made, goals) - log_noise[goal]
        false = made @ self.q[noise].T - log_noise[noise]
        up = (1.0 / (1.0 + np.exp(np.clip(real, -30, 30)))) / n
        down = (-1.0 / (1.0 + np.exp(-np.clip(false, -30, 30)))) / n
        to_made = up[:, None] * goals + down @ self.q[noise]
        rows = np.flatnonzero(target >= FLAT)
        if len(rows):
            word, mine = target[rows] - FLAT, made[rows]
            first = word // MEMBERS * MEMBERS
            sizes = np.minimum(len(self.m) - first, MEMBERS)
            other = first[:, None] + (inside[rows] * sizes[:, None]).astype(np.int64)
            all_ = np.concatenate([word[:, None], other], axis=1)
            vectors = self.m.take(all_, axis=0)
            value = (vectors @ mine[:, :, None])[:, :, 0] - np.log(NOISE_IN / sizes)[:, None]
            pull = -1.0 / (1.0 + np.exp(-np.clip(value, -30, 30)))
            pull[:, 0] += 1
            pull = (pull / n).astype(np.float32)
            to_made[rows] += (pull[:, None, :] @ vectors)[:, 0]
            flat = pull.ravel()
        ones, twos = self.r.take(one, axis=0), self.r.take(two, axis=0)
        to_made[:, -1] = 0
        to_d = np.stack([(to_made * ones).sum(axis=0), (to_made * twos).sum(axis=0)])
        to_r = np.concatenate([to_made * self.d[0], to_made * self.d[1]])
        to_q = np.concatenate([up[:, None] * made, down.T @ made])
        _add(self.r, past[0], used[0], np.concatenate([one, two]), lambda i: to_r.take(i, axis=0))
        _add(self.q, past[1], used[1], np.concatenate([goal, noise]), lambda i: to_q.take(i, axis=0))
        if len(rows):
            _add(self.m, past[2], used[2], all_.ravel(), lambda i: mine.take(i // all_.shape[1], axis=0) * flat.take(i)[:, None])
        _add(self.d, past[3], used[3], np.arange(2), to_d.__getitem__)

    def exponentials(self, i: int, bias: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        """exp of the term that every token at distance ``i`` adds to the logits of
        direct tokens and classes, less the largest of its row; and the largest."""
        out, most = np.empty((self.size, len(self.q)), np.float32), np.empty(self.size, np.float32)
        for at in range(0, self.size, 256):
            made = out[at : at + 256]
            np.matmul(self.r[at : at + 256, :-1] * self.d[i, :-1], self.q[:, :-1].T, out=made)
            made += bias
            most[at : at + 256] = made.max(axis=1)
            made -= most[at : at + 256, None]
            np.exp(made, out=made)
        return out, most

    def normaliser(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """log of the sum of exp(logit) over direct tokens and classes, a pair of
        context tokens each, in order of the first.  The logits are a sum of a term
        of either token, so the sum is a product of two rows of exponentials, which
        are made once a model (100 MB each at most), as are the products of the
        ``COMMON`` commonest tokens (16 MB); -inf where it is too small."""
        if self.tables is None:
            left, right = self.exponentials(0, 0), self.exponentials(1, self.q[:, -1])
            self.tables = left, right, left[0][:COMMON] @ right[0][:COMMON].T
        (left, left_most), (right, right_most), common = self.tables
        out = np.empty(len(one), np.float32)
        both = (one < COMMON) & (two < COMMON)
        out[both] = common[one[both], two[both]]
        rest = np.flatnonzero(~both)
        for at in range(0, len(rest), PRODUCT):
            some = rest[at : at + PRODUCT]
            a, b = one[some], two[some]
            rows = right.take(b, axis=0)
            out[some] = rows @ left[a[0]] if a[0] == a[-1] else np.einsum("ij,ij->i", left.take(a, axis=0), rows)
        with np.errstate(divide="ignore"):
            np.log(out, out=out)
        return np.where(out > -60, out + left_most[one] + right_most[two], -np.inf)

    def log10(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of every target; vectors of predictions
        are held for ``PART`` targets at a time."""

        def log_sum(logits: np.ndarray) -> np.ndarray:
            most = logits.max(axis=1)
            logits = logits - most[:, None]
            return most + np.log(np.exp(logits, out=logits).sum(axis=1))

        kind = np.int32 if self.size * self.size < 1 << 31 else np.int64
        pairs, place = np.unique((one * self.size + two).astype(kind), return_inverse=True)
        norm = self.normaliser(pairs // self.size, pairs % self.size)
        small = np.flatnonzero(~np.isfinite(norm))  # products too small for a float
        for at in range(0, len(small), PART):
            rows = small[at : at + PART]
            norm[rows] = log_sum(self.predicted(pairs[rows] // self.size, pairs[rows] % self.size) @ self.q.T)
        own = -norm[place]
        del pairs, place, norm
        for at in range(0, len(own), PART):
            some = slice(at, at + PART)
            own[some] += np.einsum("ij,ij->i", self.predicted(one[some], two[some]), self.q.take(top(target[some]), axis=0))
        rows = np.flatnonzero(target >= FLAT)
        rows = rows[np.argsort(target[rows], kind="stable")]
        word = target[rows] - FLAT
        cuts = np.searchsorted(word, np.arange(0, len(self.m) + MEMBERS, MEMBERS))
        for i, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            for at in range(low, high, PART):
                some = slice(at, min(at + PART, high))
                logits = self.predicted(one[rows[some]], two[rows[some]]) @ self.m[i * MEMBERS : (i + 1) * MEMBERS].T
                own[rows[some]] += logits[np.arange(len(logits)), word[some] - i * MEMBERS] - log_sum(logits)
        return own.astype(np.float64) / np.log(10.0)


def unigram(counts: Counts) -> np.ndarray:
    known = counts.vocabulary
    c = np.concatenate([[counts.ends, counts.tokens - counts.ends - counts.c[:known].sum()], counts.c[:known]])
    return (c + 0.5) / (c + 0.5).sum()


def averaged(found: DataFrame) -> DataFrame:
    """(i, p, w): the weighted mean of every block of parameter rows."""

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for i, p, w in zip(batch["i"].to_pylist(), batch["p"], batch["w"], strict=True):
                weight = w.values.to_numpy().astype(np.float64)
                rows = p.values.to_numpy().reshape(len(weight), -1) * weight[:, None]
                if i in held:
                    held[i][0] += rows
                    held[i][1] += weight
                else:
                    held[i] = [rows, weight]
        for i, (rows, weight) in held.items():
            yield _block(i, rows / np.maximum(weight, 1)[:, None], weight)

    return arrow_map(found.repartition(min(64, partitions(found.sparkSession)), "i"), mean, found.schema)


def _block(i: int, rows: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
    kind = pa.list_(pa.float32())
    made = [[rows.ravel().astype(np.float32)], [weight.astype(np.float32)]]
    return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *[pa.array(m, kind) for m in made]], names=["i", "p", "w"])


def train(texts: DataFrame, counts: Counts) -> LogBilinear:
    """One pass over all training texts, averaged over the tasks."""
    start = LogBilinear(unigram(counts))
    given = texts.sparkSession.sparkContext.broadcast((replace(counts, words={}), counts.names[: counts.vocabulary], start))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, names, start = given.value
        share = unigram(counts)
        model, tops = LogBilinear(share).load(start.rows()), np.bincount(top(np.arange(len(share))), share)
        rng, log_noise = np.random.default_rng(TaskContext.get().partitionId()), np.log(NOISE * tops).astype(np.float32)
        cumulative, past, seen = np.cumsum(tops), [np.zeros_like(p) for p in model.parts()], 0
        used = [np.zeros(len(p), np.int64) for p in model.parts()]
        for batch in slices(batches, "text", 2 << 20):
            words, sizes = words_of(batch.column("text"))
            target, one, two = model_tokens(numbered(words, names), sizes, counts.vocabulary)
            order = rng.permutation(len(target))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                noise = np.minimum(np.searchsorted(cumulative, rng.random(NOISE)), len(tops) - 1)
                model.step(one[rows], two[rows], target[rows], noise, rng.random((len(rows), NOISE_IN), np.float32), log_noise, past, used)
            seen += len(order)
        if seen:
            made, weight = model.rows(), np.concatenate(used)
            for i in range(0, len(made), ROWS):
                if weight[i : i + ROWS].any():
                    yield _block(i // ROWS, made[i : i + ROWS], weight[i : i + ROWS])

    found = averaged(arrow_map(texts.select("text"), learn, "i int, p array<float>, w array<float>")).toArrow()
    rows = start.rows()
    for i, p, w in zip(found["i"].to_pylist(), found["p"], found["w"], strict=True):
        weight = w.values.to_numpy()
        mean = p.values.to_numpy().reshape(len(weight), -1)
        at = slice(i * ROWS, i * ROWS + len(weight))
        rows[at] = np.where(weight[:, None] > 0, mean, rows[at])
    return start.load(rows)


def scored(docs: DataFrame, learn: Column, *keep: Column) -> DataFrame:
    """``keep`` columns, n_tokens, n_known, train_tokens, base_score and score
    of every row; rows where ``learn`` holds are learned from."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    training = docs.where(learn).select(text)
    words = stored(word_counts(training), "words")
    counts = counts_of(words, training.count())
    model = train(training, counts)
    given = spark.sparkContext.broadcast((replace(counts, words={}), counts.names, model))
    rows = docs.select(*keep, text)
    kept = rows.schema.fields[:-1]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, names, model = given.value
        base, share = counts.base(counts.c), counts.other_share(counts.c)
        known, row, first = counts.vocabulary, 0, TaskContext.get().partitionId() << 40
        share[:known] = 0
        for batch in slices(batches, "text", 4 << 20):
            words, sizes = words_of(batch.column("text"))
            n, numbers, texts = len(sizes), numbered(words, names), np.repeat(np.arange(len(sizes)), sizes)
            common = numbers >= 0
            per_text = lambda values: np.bincount(texts[common], values[numbers[common]], n).astype(np.float64)  # noqa: B023, E731
            total = per_text(base) + counts.base(np.array(counts.ends))
            value = per_text(share)
            found = np.bincount(texts[common], minlength=n) + (counts.ends > 0)
            # rarer words: each once a text, with its times there
            rare = words.filter(pa.array(~common)).dictionary_encode()
            kinds = max(1, len(rare.dictionary))
            once, times = np.unique(texts[~common] * kinds + rare.indices.to_numpy(), return_counts=True)
            cuts = pa.array(np.searchsorted(once, np.arange(n + 1) * kinds), pa.int32())
            targets, one, two = model_tokens(numbers, sizes, known)
            value += np.add.reduceat(model.log10(one, two, targets), np.cumsum(sizes + 1) - sizes - 1)
            made = [
                pa.array(first + row + np.arange(n)),
                pa.array(sizes + 1, pa.int64()),
                pa.array(found, pa.int64()),
                pa.array(total),
                pa.array(value),
                pa.ListArray.from_arrays(cuts, rare.dictionary.take(pa.array(once % kinds))),
                pa.ListArray.from_arrays(cuts, pa.array(times, pa.int32())),
            ]
            row += n
            more = ["_cl_row", "n_tokens", "_cl_known", "_cl_base", "_cl_score", "_cl_words", "_cl_times"]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *made], names=[*(f.name for f in kept), *more])

    kinds = [("_cl_row", LongType()), ("n_tokens", LongType()), ("_cl_known", LongType()), ("_cl_base", DoubleType()), ("_cl_score", DoubleType())]
    kinds += [("_cl_words", ArrayType(StringType())), ("_cl_times", ArrayType(IntegerType()))]
    first = stored(arrow_map(rows, score, StructType([*kept, *[StructField(n, k) for n, k in kinds]])), "scores")

    rare = first.select("_cl_row", F.explode(F.arrays_zip("_cl_words", "_cl_times")).alias("x"))
    rare = rare.select("_cl_row", F.col("x._cl_words").alias("word"), F.col("x._cl_times").cast("long").alias("times")).join(words, "word", "left")
    c = F.coalesce("c", F.lit(0))
    n, v = counts.tokens, counts.distinct
    known = counts.vocabulary
    rest, others = n - counts.ends - int(counts.c[:known].sum()), v - (counts.ends > 0) - known
    by_row = rare.groupBy("_cl_row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("_r_known"),
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(n + 0.5 * (v + 1)))).alias("_r_base"),
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(rest + 0.5 * (others + 1)))).alias("_r_score"),
    )
    out = first.drop("_cl_words", "_cl_times").join(by_row, "_cl_row", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return out.select(
        *[F.col(f"`{f.name}`") for f in kept],
        "n_tokens",
        plus("_cl_known", "_r_known").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        plus("_cl_base", "_r_base").alias("base_score"),
        plus("_cl_score", "_r_score").alias("score"),
    )


def op3_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from documents whose crc32(doc_id) mod 5 is not 1; score all."""
    held_out = id_remainder("doc_id", 5) == 1
    return scored(read_table(spark, sf_dir, "documents"), ~held_out, F.col("doc_id"), held_out.alias("held_out"))

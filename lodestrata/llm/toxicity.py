"""Toxicity by a small convolutional network over hashed word embeddings, trained on all labelled texts in rounds over the tasks."""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.common import LOWER, code_of, extend, mix, row_slices, spread, text_arrays, tidy, words_of
from lodestrata.session import cut_lineage, release

#: Words are runs of ASCII letters and of bytes beyond ASCII.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
WIDTHS = (1, 2, 3)
#: Bytes of the two prefixes that are hashed beside the whole word (inflected forms share them).
PREFIXES = (4, 6)
#: Bytes of texts that are turned into arrays at a time (a word takes some hundred bytes there).
SCORED_BYTES = 1 << 18
#: Hash buckets; three 16-bit numbers of each word are stored while a model learns.
BUCKETS = 1 << 16
WORD_BYTES = 2 * (1 + len(PREFIXES))
#: Bytes of stored words that a task learns from at a time.
LEARNT_BYTES = 1 << 21
#: Texts of a task that learns, at least (if there are as many).
PART = 8192
#: Changes of parameters are added up as multiples of one in so many.
UNIT = 1 << 24


@dataclass
class Model:
    """Embeddings of hash buckets, filters by width and offset, output weights, thresholds by language."""

    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, dimensions, filters)
    bias: np.ndarray
    weights: np.ndarray
    intercept: float
    thresholds: dict[str, float]
    threshold: float

    def tables(self) -> np.ndarray:
        """What a bucket adds to every filter at every offset: embeddings times all filters."""
        return np.concatenate([self.embedding @ f for w in WIDTHS for f in self.filters[w]], axis=1)

    def scores(self, table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score between 0 and 1 of each of consecutive texts, over all their words."""
        return self.of_words(table, *features(data, offsets, len(self.embedding)), len(offsets) - 1)

    def of_words(self, table: np.ndarray, buckets: list[np.ndarray], row: np.ndarray, rows: int) -> np.ndarray:
        """Score of each of ``rows`` texts from the buckets of their words and the text number of each."""
        count = len(self.bias) // len(WIDTHS)
        pooled = np.zeros((rows, len(self.bias)), np.float32)
        if len(row):
            each = table[buckets[0]]
            for b in buckets[1:]:
                each += table[b]
            begin = np.flatnonzero(np.diff(row, prepend=-1))
            at = 0
            for k, width in enumerate(WIDTHS):
                total = each[:, at : at + count].copy()
                for shift in range(1, width):
                    same = row[shift:] == row[:-shift]
                    total[:-shift] += each[shift:, at + shift * count : at + (shift + 1) * count] * same[:, None]
                at += width * count
                pooled[row[begin], k * count : (k + 1) * count] = np.maximum.reduceat(total, begin, axis=0)
        hidden = np.maximum(pooled + self.bias, 0)
        # summed row by row, so that a text's score does not depend on the texts beside it
        logit = (hidden.astype(np.float64) * self.weights).sum(axis=1) + self.intercept
        return 1 / (1 + np.exp(-logit))


def features(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hash buckets of each word (whole and prefixes) and its text number; a prefix as long as the word counts as well."""
    starts, ends, row = words_of(data, offsets, NOT_LETTER)
    lower = LOWER[data]
    out = []
    for k, limit in enumerate((None, *PREFIXES)):
        until = ends if limit is None else np.minimum(ends, starts + limit)
        out.append((mix(code_of(lower, starts, until) + np.uint64(k)) % np.uint64(size)).astype(np.int64))
    return out, row


class Learner:
    """A model while it learns: its parameters beside the sums of squared gradients that set their steps (Adagrad)."""

    def __init__(self, buckets: int = BUCKETS, dimensions: int = 8, filters: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        embedding = rng.normal(0, 0.1, (buckets, dimensions)).astype(np.float32)
        bank = {w: rng.normal(0, 0.5, (w, dimensions, filters)).astype(np.float32) for w in WIDTHS}
        total = filters * len(WIDTHS)
        weights = rng.normal(0, 0.3, total).astype(np.float32)
        self.model = Model(embedding, bank, np.zeros(total, np.float32), weights, 0.0, {}, 0.5)
        self.squares = np.full(buckets, 1e-6)
        self.dense_squares = np.full(len(self.dense()), 1e-6)

    def dense(self) -> np.ndarray:
        """All parameters but the embeddings."""
        m = self.model
        return np.concatenate([m.bias, m.weights, [m.intercept], *(m.filters[w].ravel() for w in WIDTHS)])

    def move(self, change: np.ndarray) -> None:
        """Add to all parameters but the embeddings."""
        m, at = self.model, 0

        def part(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return change[at - size : at]

        m.bias = (m.bias + part(len(m.bias))).astype(np.float32)
        m.weights = (m.weights + part(len(m.weights))).astype(np.float32)
        m.intercept += float(part(1)[0])
        for w in WIDTHS:
            m.filters[w] = (m.filters[w] + part(m.filters[w].size).reshape(m.filters[w].shape)).astype(np.float32)

    def learn(self, hashed: np.ndarray, sizes: np.ndarray, toxic: np.ndarray, passes: int, rng) -> Iterator[np.ndarray]:
        """Go through the texts in steps of 64, ``passes`` times in random order; the buckets that each step moved."""
        begin, usable = np.cumsum(sizes) - sizes, np.flatnonzero(sizes)
        for _ in range(passes):
            rng.shuffle(usable)
            for lo in range(0, len(usable), 64):
                chosen = usable[lo : lo + 64]
                yield self.step(hashed[spread(begin[chosen], sizes[chosen])], sizes[chosen], toxic[chosen])

    def step(self, hashed: np.ndarray, sizes: np.ndarray, toxic: np.ndarray, rate: float = 0.1) -> np.ndarray:
        """One step on some texts, each with a word at least; the buckets whose embeddings moved."""
        m, n = self.model, len(hashed)
        filters = len(m.bias) // len(WIDTHS)
        x = sum(m.embedding[hashed[:, k]] for k in range(hashed.shape[1]))
        end = np.cumsum(sizes)
        begin, row = end - sizes, np.repeat(np.arange(len(sizes)), sizes)
        pooled, best = [], []
        for w in WIDTHS:
            conv = x @ m.filters[w][0]
            for s in range(1, w):
                conv[:-s] += (x[s:] @ m.filters[w][s]) * (row[s:] == row[:-s])[:, None]
            top = np.maximum.reduceat(conv, begin, axis=0)
            at, column = np.nonzero(conv == top[row])
            first = np.full((len(sizes), filters), n, np.int64)
            np.minimum.at(first, (row[at], column), at)
            pooled.append(top)
            best.append(first)
        pooled = np.concatenate(pooled, axis=1)
        hidden = np.maximum(pooled + m.bias, 0)
        score = 1 / (1 + np.exp(-(hidden @ m.weights + m.intercept)))
        error = ((score - toxic) / len(sizes)).astype(np.float32)
        back = error[:, None] * m.weights * (hidden > 0)
        of_filters, places, changes = [], [], []
        for j, w in enumerate(WIDTHS):
            g, gradient = back[:, j * filters : (j + 1) * filters], np.zeros_like(m.filters[w])
            for s in range(w):
                at = best[j] + s
                inside = at < end[:, None]
                each = np.where(inside, g, 0)
                gradient[s] = np.einsum("tfd,tf->df", x[np.minimum(at, n - 1)], each)
                t, f = np.nonzero(each)
                places.append(at[t, f])
                changes.append(m.filters[w][s].T[f] * each[t, f][:, None])
            of_filters.append(gradient.ravel())
        gradient = np.concatenate([back.sum(axis=0), hidden.T @ error, [error.sum()], *of_filters]).astype(np.float64)
        self.dense_squares += gradient * gradient
        self.move(-rate * gradient / np.sqrt(self.dense_squares))
        touched = hashed[np.concatenate(places)]
        rows, which = np.unique(touched.ravel(), return_inverse=True)
        each = np.repeat(np.concatenate(changes), touched.shape[1], axis=0)
        moved = np.stack([np.bincount(which.ravel(), each[:, k], len(rows)) for k in range(each.shape[1])], axis=1)
        self.squares[rows] += (moved * moved).mean(axis=1)
        m.embedding[rows] -= (rate * moved / np.sqrt(self.squares[rows])[:, None]).astype(np.float32)
        return rows

    def constant(self, share: float) -> Model:
        """A model that gives ``share`` to every text."""
        self.model.weights[:] = 0
        self.model.intercept = logit(share)
        return self.model


def logit(share: float) -> float:
    share = min(max(share, 1e-4), 1 - 1e-4)
    return float(np.log(share / (1 - share)))


def train(
    texts: list[str], toxic: np.ndarray, languages: list[str | None], share: float, buckets: int = BUCKETS,
    dimensions: int = 8, filters: int = 8, examples: int = 20_000, seed: int = 7,
) -> Model:
    """Fit the network on a list of texts in this process; ``share`` is the true share of toxic texts.

    About ``examples`` texts are shown in all, each as often as any other.
    Every fifth text is left out of the fit and serves to set the thresholds. With one class only (or no
    texts) the model gives every text the share. For tables see :func:`fit`.
    """
    learner = Learner(buckets, dimensions, filters, seed)
    if not len(texts) or toxic.min() == toxic.max():
        return learner.constant(share)
    fitted = np.arange(len(texts)) % 5 != 4
    hashed, sizes = [], []
    for part in blocks_of([t for t, f in zip(texts, fitted) if f]):
        found, row = features(*text_arrays(part), buckets)
        hashed.append(np.stack(found, axis=1))
        sizes.append(np.bincount(row, minlength=len(part)))
    passes = max(5, examples // int(fitted.sum()))
    for _ in learner.learn(np.concatenate(hashed), np.concatenate(sizes), toxic[fitted], passes, np.random.default_rng(seed)):
        pass
    model = learner.model
    # from the list's share of toxic texts to the true one
    model.intercept += logit(share) - logit(toxic.mean())
    calibrate(model, texts, toxic, languages, ~fitted)
    return model


def blocks_of(texts: list[str]) -> Iterator[pa.Array]:
    """The texts in blocks of bounded size."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    for part in row_slices(batch, "text", SCORED_BYTES):
        yield part.column("text")


def calibrate(model: Model, texts: list[str], toxic: np.ndarray, languages, held: np.ndarray, least: int = 10) -> None:
    """For each language the threshold with the fewest errors on the texts that were not fitted.

    Between equally good thresholds the middle of the widest stretch of scores is taken. Languages with fewer
    than ``least`` texts of either class use the threshold over all.
    """
    table = model.tables()
    score = np.concatenate([model.scores(table, *text_arrays(part)) for part in blocks_of(texts)])

    def best(which: np.ndarray) -> float:
        order = np.argsort(score[which], kind="stable")
        s, y = score[which][order], toxic[which][order]
        wrong = np.concatenate(([0], np.cumsum(y))) + np.concatenate(([np.sum(1 - y)], np.sum(1 - y) - np.cumsum(1 - y)))
        low, high = np.concatenate(([0.0], s)), np.concatenate((s, [1.0]))
        good = np.flatnonzero(wrong == wrong.min())
        k = good[np.argmax((high - low)[good])]
        return float((low[k] + high[k]) / 2)

    enough = lambda which: min(toxic[which].sum(), (1 - toxic[which]).sum()) >= least
    if enough(held):
        model.threshold = best(held)
    names = np.array([x or "" for x in languages])
    for language in sorted(set(names[held].tolist())):
        which = held & (names == language)
        if language and enough(which):
            model.thresholds[language] = best(which)


def fit(
    docs: DataFrame, labels: DataFrame, key: str, text: str, language: str, label: str, usable: Column,
    rounds: int = 5, examples: int = 20_000,
) -> Model:
    """Train on every labelled text for which ``usable`` holds, whole and however many there are.

    ``usable`` is a condition on the key; a key labelled more than once counts as its largest label. The words of
    the labelled texts are hashed once and stored. In each of ``rounds`` the tasks go through their parts of them from
    the same model, and the changes are averaged over the tasks, each weighed by its steps (see :func:`one_round`).
    A task has some ``PART`` texts at least, as less would teach it too little by itself, and goes through them more often if
    there are so few that it would not be shown ``examples`` in all. A fifth of the texts, by
    a hash of the key, is left out of the rounds; all of these set the thresholds (see :func:`set_thresholds`).
    Only counts, thresholds and the model itself (at most its 65,536 buckets) pass through the driver.
    """
    known = labels.filter(usable & F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("_key")).agg(F.max(label).alias("_toxic"))
    given = docs.filter(usable).select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"), F.col(f"`{language}`").alias("_lang"))
    # texts are dealt once, by the key, for the join and so that parts are alike
    given = given.filter("_key IS NOT NULL").repartition("_key")
    joined = given.join(known.filter("_toxic IN (0, 1)"), "_key").select(
        F.xxhash64("_key").alias("_order"), F.col("_toxic").cast("int").alias("_toxic"), F.col("_lang").cast("string").alias("_lang"), "_text"
    )
    # in an order that does not depend on how they came
    words = hashed_words(joined).sortWithinPartitions("_order", "_toxic", "_lang", "_words")
    stored = cut_lineage(words)
    held = F.pmod("_order", F.lit(5)) == 4
    counts = {(r["h"], r["_toxic"]): r["n"] for r in stored.groupBy(held.alias("h"), "_toxic").agg(F.count("*").alias("n")).collect()}
    seen = [counts.get((False, c), 0) for c in (0, 1)]
    share = sum(n for (_, c), n in counts.items() if c == 1) / max(1, sum(counts.values()))
    learner = Learner()
    if min(seen):
        parts = max(1, sum(seen) // PART)
        fitted = stored.filter(~held).select("_toxic", "_words").coalesce(parts)
        passes = max(1, -(-examples * parts // (rounds * sum(seen))))
        for k in range(rounds):
            one_round(fitted, learner, passes, k)
        set_thresholds(learner.model, stored.filter(held))
    release(stored)
    return learner.model if min(seen) else learner.constant(share)


def hashed_words(df: DataFrame) -> DataFrame:
    """``_words`` in the place of ``_text``: three 16-bit buckets of each word."""
    names = [c for c in df.columns if c != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "_text", SCORED_BYTES):
                found, row = features(*text_arrays(part.column("_text")), BUCKETS)
                ends = np.zeros(part.num_rows + 1, np.int64)
                np.cumsum(np.bincount(row, minlength=part.num_rows) * WORD_BYTES, out=ends[1:])
                data = np.stack(found, axis=1).astype("<u2").tobytes()
                words = [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(words, pa.binary())], [*names, "_words"])

    kept = df.select(*names, "_text")
    return kept.mapInArrow(tidy(run), T.StructType([*df.select(*names).schema.fields, T.StructField("_words", T.BinaryType(), False)]))


def stored_words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words of some stored texts, and how many words each has."""
    data, offsets = text_arrays(part.column("_words"))
    return np.frombuffer(data.tobytes(), "<u2").reshape(-1, WORD_BYTES // 2).astype(np.int64), np.diff(offsets) // WORD_BYTES


def one_round(fitted: DataFrame, learner: Learner, passes: int, number: int) -> None:
    """Let every task learn from its part, and take the mean of the changes into ``learner``.

    A task holds the model and some megabytes of words. What it changed is one row for each bucket that it moved (and for each
    other parameter), weighed by the steps that moved it: a word that few tasks know keeps what these learnt. Changes are added up
    as whole numbers, so the sums do not depend on the order of the tasks.
    """
    spark, start = fitted.sparkSession, learner
    sent = spark.sparkContext.broadcast(start)
    size, width = start.model.embedding.shape
    fields = [T.StructField("at", T.IntegerType(), False), T.StructField("n", T.LongType(), False)]
    fields += [T.StructField(f"v{k}", T.LongType(), False) for k in range(width + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = sent.value
        mine, rng = copy.deepcopy(begin), np.random.default_rng([number, TaskContext.get().partitionId()])
        steps, moved = 0, np.zeros(size, np.int64)
        for batch in batches:
            for part in row_slices(batch, "_words", LEARNT_BYTES):
                toxic = part.column("_toxic").to_numpy(zero_copy_only=False)
                for rows in mine.learn(*stored_words(part), toxic, passes, rng):
                    moved[rows] += 1
                    steps += 1
        if not steps:
            return
        rows, dense = np.flatnonzero(moved), len(begin.dense())
        changes = np.zeros((len(rows) + dense, width + 1))
        changes[: len(rows), :width] = mine.model.embedding[rows].astype(np.float64) - begin.model.embedding[rows]
        changes[: len(rows), width] = mine.squares[rows] - begin.squares[rows]
        changes[len(rows) :, 0] = mine.dense() - begin.dense()
        changes[len(rows) :, width] = mine.dense_squares - begin.dense_squares
        n = np.concatenate((moved[rows], np.full(dense, steps)))
        whole = np.rint(changes * n[:, None] * UNIT).astype(np.int64)
        at = np.concatenate((rows, size + np.arange(dense))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n), *(pa.array(v) for v in whole.T)], [f.name for f in fields])

    made = fitted.mapInArrow(tidy(run), T.StructType(fields))
    total = made.groupBy("at").agg(*[F.sum(f.name).alias(f.name) for f in fields[1:]]).toArrow()
    sent.destroy()
    columns = [total.column(k).to_numpy() for k in range(total.num_columns)]
    at, mean = columns[0], np.stack(columns[2:], axis=1) / (columns[1] * UNIT)[:, None]
    rows, other = at < size, at >= size
    start.model.embedding[at[rows]] += mean[rows, :width].astype(np.float32)
    start.squares[at[rows]] += mean[rows, width]
    change = np.zeros(len(start.dense_squares))
    change[at[other] - size] = mean[other, 0]
    start.move(change)
    start.dense_squares[at[other] - size] += mean[other, width]


def set_thresholds(model: Model, held: DataFrame, least: int = 10) -> None:
    """For each language the threshold with the fewest errors on all of ``held``, from counts by language and score.

    As :func:`calibrate`, but for scores that are counted in steps of 1/64 of their logit, between -16 and 16. A
    task goes through the counts of a language, at most 2,048.
    """
    sent = held.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        table = model.tables()
        for batch in batches:
            for part in row_slices(batch, "_words", LEARNT_BYTES):
                words, sizes = stored_words(part)
                score = model.of_words(table, list(words.T), np.repeat(np.arange(len(sizes)), sizes), len(sizes))
                with np.errstate(divide="ignore"):
                    step = np.floor((np.clip(np.log(score / (1 - score)), -16, 16 - 1e-9) + 16) * 64).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("_lang"), part.column("_toxic"), pa.array(step)], ["lang", "toxic", "step"])

    found = held.select("_lang", "_toxic", "_words").mapInArrow(tidy(run), "lang string, toxic int, step int")
    each = found.groupBy("lang", "step").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    each = each.filter("lang <> ''").unionAll(each.groupBy(F.lit(None).cast("string"), "step").agg(F.sum("toxic"), F.sum("clean")))
    # the border behind the last score counts too
    ends = each.groupBy("lang").agg(F.lit(1 << 11).alias("step"), F.lit(0).alias("toxic"), F.lit(0).alias("clean"), F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    enough = ends.filter((F.col("a") >= least) & (F.col("b") >= least))
    borders = each.join(enough.select(F.col("lang").alias("l")), F.col("lang").eqNullSafe(F.col("l"))).drop("l").unionAll(enough.drop("a", "b"))
    up = Window.partitionBy("lang").orderBy("step")
    before, onward = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(0, Window.unboundedFollowing)
    edge = lambda step: 1 / (1 + F.exp(16 - step / 64))
    borders = borders.select(
        "lang", "step",
        (F.coalesce(F.sum("toxic").over(before), F.lit(0)) + F.sum("clean").over(onward)).alias("wrong"),
        F.coalesce(edge(F.lag("step").over(up) + 1), F.lit(0.0)).alias("low"),
        F.when(F.col("step") == 1 << 11, 1.0).otherwise(edge(F.col("step"))).alias("high"),
    )
    order = Window.partitionBy("lang").orderBy("wrong", F.col("low") - F.col("high"), "step")
    best = borders.withColumn("k", F.row_number().over(order)).filter("k = 1").select("lang", ((F.col("low") + F.col("high")) / 2).alias("at"))
    for r in best.orderBy("lang").collect():
        if r["lang"] is None:
            model.threshold = r["at"]
        else:
            model.thresholds[r["lang"]] = r["at"]


def score(df: DataFrame, text: str, language: str, model: Model) -> DataFrame:
    """Add ``score`` (double, 0 to 1) of the whole text and ``toxic`` (boolean): score at least its language's threshold.

    The score depends on the text alone; the language only picks the threshold, and an unknown or NULL
    language takes the threshold over all. NULL and empty texts are scored like a text without any word.
    Equal rows get equal scores; columns of these names are replaced. Nothing is shuffled.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value
        table = model.tables()

        def extra(part: pa.RecordBatch):
            return [pa.array(model.scores(table, *text_arrays(part.column(text))), pa.float64())]

        return extra

    scored = extend(df, text, [T.StructField("score", T.DoubleType(), False)], make, SCORED_BYTES)
    limit = F.lit(model.threshold)
    for name, value in model.thresholds.items():
        limit = F.when(F.col(f"`{language}`") == name, value).otherwise(limit)
    return scored.withColumn("toxic", F.col("score") >= limit)

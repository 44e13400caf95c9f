"""Toxicity by subword-bag embeddings averaged into a linear softmax.

Each character n-gram of a word, its borders included, has a vector; a passage is
the mean of its n-grams' vectors, and a linear softmax over it says how likely
it is toxic (as in fastText). Vectors and softmax are trained together, so a misspelling shares
most n-grams with words that were seen. A few insults in a long text must not
drown in its mean: a document scores as its most toxic passage of ``PASSAGE`` words,
and training goes back and forth between choosing each document's passage and
fitting on those. Two numbers then turn a passage's margin into a probability.

Letters, marks and digits of every script make words. A long run without blanks, as scripts
without spaces have, counts as a word per ``LONGEST`` letters, so that its passages are short as well.

The fit takes a bounded sample of labelled texts; scoring reads every passage of
every whole text.
"""

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.languageid import crc_slot

NGRAMS = (3, 4, 5)
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 8
PASSAGE = 4
#: Labelled texts that the fit reads, at most, of each label.
SAMPLE_TOXIC = 1500
SAMPLE_CLEAN = 2500
#: Bytes of text of each label that the fit reads: a text is taken whole if those before it leave room.
SAMPLE_BYTES = 10 << 20
#: Letters after which a run without blanks counts as the next word.
LONGEST = 16
EPOCHS, ROUNDS, BATCH, RATE = 8, 3, 128, 0.5
#: Characters scored together.
STRETCH = 1 << 19
#: Weight of the penalty that keeps the slope of the final curve finite.
RIDGE = 1e-5

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_BLANK = np.uint32(32)


# --- n-grams -----------------------------------------------------------------


#: By code point of the basic plane, whether it belongs to a word; all beyond do.
WORD = np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(1 << 16)])


def _characters(text: str) -> np.ndarray:
    """Lower-cased code points, with blanks, controls and punctuation as one kind of blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    word = WORD[np.minimum(points, len(WORD) - 1)] | (points >= len(WORD))
    return np.where(word, points, _BLANK)


def _starts(blank: np.ndarray) -> np.ndarray:
    """Where words begin, by the place before: after a blank, and within long runs."""
    starts = ~blank[1:] & blank[:-1]
    place = np.arange(len(blank))
    since = place - np.maximum.accumulate(np.where(blank, place, 0))
    return starts | (~blank[1:] & (since[1:] > 1) & (since[1:] % LONGEST == 1))


def grams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Word number and bucket of each n-gram, and the number of words.

    An n-gram lies in one word and may take in the blank before or after it.
    ``points`` starts and ends with a blank.
    """
    blank = points == _BLANK
    words = np.cumsum(_starts(blank))
    before = np.concatenate([[0], np.cumsum(blank)])
    value, power = np.zeros(len(points), np.uint64), 1
    owners, buckets = [], []
    for n in range(1, max(NGRAMS) + 1):
        count = len(points) - n + 1
        if count < 1:
            break
        value = value[:count] + (points[n - 1 :].astype(np.uint64) + np.uint64(1)) * np.uint64(power)
        power = power * _BASE & (1 << 64) - 1
        if n in NGRAMS:
            inner = before[n - 1 : n - 1 + count] - before[1 : 1 + count]
            at = np.flatnonzero(inner == 0)
            mixed = (value[at] + np.uint64(n)) * _FACTOR
            mixed = (mixed ^ (mixed >> np.uint64(32))) * _FACTOR
            buckets.append((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
            owners.append(words[at] - 1)
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), 0
    return np.concatenate(owners), np.concatenate(buckets), int(words[-1]) if len(words) else 0


def _padded(text: str) -> np.ndarray:
    return np.concatenate([[_BLANK], _characters(text), [_BLANK]]).astype(np.uint32)


class Text:
    """A training text's n-grams, in the order of its words."""

    def __init__(self, text: str):
        owner, bucket, self.words = grams(_padded(text))
        order = np.argsort(owner, kind="stable")
        self.buckets = bucket[order]
        counts = np.bincount(owner, minlength=self.words)[: self.words]
        self.ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)

    def passage(self, first: int) -> np.ndarray:
        last = min(first + PASSAGE, self.words)
        return self.buckets[self.ends[first] : self.ends[last]]

    def strongest(self, table: np.ndarray) -> tuple[int, float]:
        """The passage with the largest mean, and that mean."""
        sums = np.concatenate([[0.0], np.cumsum(table[self.buckets])])[self.ends]
        return _strongest(sums, self.ends)


def _strongest(sums: np.ndarray, counts: np.ndarray) -> tuple[int, float]:
    """From running sums and counts by word: where the passage of the largest mean starts."""
    span = min(PASSAGE, len(sums) - 1)
    size = counts[span:] - counts[: len(counts) - span]
    means = (sums[span:] - sums[: len(sums) - span]) / np.maximum(size, 1)
    best = int(means.argmax())
    return best, float(means[best])


# --- training ----------------------------------------------------------------


class Network:
    """Embeddings of the n-gram buckets and a two-class softmax over their mean."""

    def __init__(self, seed: int = 0):
        random = np.random.default_rng(seed)
        self.vectors = np.zeros((BUCKETS, DIMENSIONS), np.float32)
        self.weights = random.normal(0, 1, (2, DIMENSIONS)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        self.seen_vectors = np.full(BUCKETS, 1e-8, np.float32)
        self.seen_weights = np.full((2, DIMENSIONS), 1e-8, np.float32)
        self.random = random

    def fit(self, bags: list[np.ndarray], toxic: np.ndarray, epochs: int = EPOCHS) -> None:
        """Adagrad steps on batches of bags of buckets."""
        for _ in range(epochs):
            order = self.random.permutation(len(bags))
            for a in range(0, len(order), BATCH):
                part = order[a : a + BATCH]
                self._step([bags[k] for k in part], toxic[part])

    def _step(self, bags: list[np.ndarray], toxic: np.ndarray) -> None:
        sizes = np.array([len(b) for b in bags])
        buckets = np.concatenate(bags)
        starts = np.cumsum(sizes) - sizes
        hidden = np.add.reduceat(self.vectors[buckets], starts, axis=0) / sizes[:, None]
        logits = hidden @ self.weights.T + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        error = odds / odds.sum(axis=1, keepdims=True)
        error[np.arange(len(bags)), toxic] -= 1.0
        # Both classes' errors are opposite, so a vector's gradient is along their difference.
        direction = self.weights[1] - self.weights[0]
        pull = np.bincount(buckets, np.repeat(error[:, 1] / sizes, sizes), minlength=BUCKETS)
        touched = np.flatnonzero(pull)
        pull = pull[touched].astype(np.float32)
        self.seen_vectors[touched] += pull**2
        step = RATE * pull / np.sqrt(self.seen_vectors[touched])
        change = error.T @ hidden / len(bags)
        self.seen_weights += change**2
        self.vectors[touched] -= step[:, None] * direction
        self.weights -= (0.1 * RATE * change / np.sqrt(self.seen_weights)).astype(np.float32)
        self.bias -= (0.1 * RATE * error.mean(axis=0)).astype(np.float32)

    def margins(self) -> np.ndarray:
        """What each bucket adds to a mean's margin of toxic over clean."""
        return (self.vectors @ (self.weights[1] - self.weights[0])).astype(np.float64)


class Model:
    """A margin per bucket, and the two numbers that make it a probability."""

    def __init__(self, table: np.ndarray, slope: float, offset: float, base: float):
        self.table, self.slope, self.offset, self.base = table, slope, offset, base

    def probability(self, margin: float | None) -> float:
        """For a text without n-grams, the share of toxic texts."""
        if margin is None:
            return self.base
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def _calibrated(margins: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps; a little ridge keeps them finite."""
    center, spread = margins.mean(), margins.std() or 1.0
    x = np.column_stack([(margins - center) / spread, np.ones(len(margins))])
    theta = np.zeros(2)
    ridge = np.diag([RIDGE, 1e-6]) * weights.sum()
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weights * (p - toxic)) + ridge @ theta
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge
        move = np.linalg.solve(curve + 1e-9 * np.eye(2), slope)
        theta -= move
        if np.abs(move).max() < 1e-9:
            break
    return float(theta[0] / spread), float(theta[1] - theta[0] * center / spread)


def train(texts: list[str], toxic: list[int], share: float) -> Model:
    """A model from labelled texts; ``share`` is the share of toxic ones among all labelled texts.

    With labels of one kind only, or none, every text scores ``share``.
    """
    found = [(t, y) for t, y in zip(map(Text, texts), toxic) if len(t.buckets)]
    labels = np.array([y for _, y in found], np.int64)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(BUCKETS), 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))), share)
    network = Network()
    network.fit([t.buckets for t, _ in found], labels)
    for k in range(ROUNDS):
        table = network.margins()
        bags, goals = [], []
        for text, label in found:
            bags.append(text.passage(text.strongest(table)[0]))
            goals.append(label)
            if not label:
                bags.append(text.passage(int(network.random.integers(max(1, text.words - PASSAGE + 1)))))
                goals.append(0)
        full = [k for k, bag in enumerate(bags) if len(bag)]
        network.fit([bags[k] for k in full], np.array(goals)[full])
    table = network.margins()
    margins = np.array([t.strongest(table)[1] for t, _ in found])
    mine = labels.mean()
    weights = np.where(labels == 1, share / mine, (1 - share) / (1 - mine))
    return Model(table, *_calibrated(margins, labels, weights), share)


# --- scoring -----------------------------------------------------------------


def margins(texts: list[str], table: np.ndarray) -> list[float | None]:
    """The margin of each text's strongest passage; None for a text without n-grams."""
    found: list[float | None] = []
    for text in texts:
        # A long text is scored in stretches that overlap by more than a passage needs.
        best = None
        for points in _pieces(_padded(text)):
            owner, bucket, words = grams(points)
            if not len(bucket):
                continue
            counts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=words)[:words])])
            sums = np.bincount(owner, table[bucket], minlength=words)[:words]
            value = _strongest(np.concatenate([[0.0], np.cumsum(sums)]), counts)[1]
            best = value if best is None else max(best, value)
        found.append(best)
    return found


def _pieces(points: np.ndarray) -> Iterator[np.ndarray]:
    """Stretches that begin and end at blanks; each repeats the last words of the one before."""
    if len(points) <= STRETCH:
        yield points
        return
    blanks = np.flatnonzero(points == _BLANK)
    first = 0
    while True:
        last = int(np.searchsorted(blanks, blanks[first] + STRETCH))
        last = min(max(last, first + 1), len(blanks) - 1)
        yield points[blanks[first] : blanks[last] + 1]
        if last == len(blanks) - 1:
            return
        starts = np.flatnonzero(np.diff(blanks[first : last + 1]) > 1) + first
        first = int(starts[-PASSAGE]) if len(starts) > PASSAGE else last


def _held_out(folds: int) -> Column:
    return F.coalesce(crc_slot(folds) == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5) -> Model:
    """A model from a bounded sample, by hash, of the labelled rows that are not held out.

    Texts of any length take part; of each label the first in the order of the hash, until
    ``SAMPLE_BYTES`` are read, and one at least.
    """
    known = (
        labels.where(~_held_out(folds) & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    order = F.xxhash64("label_id")
    chosen = [
        known.where(F.col("toxic") == kind).orderBy(order, "label_id").limit(size)
        for kind, size in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))
    ]
    rows = (
        docs.where(F.col("text").isNotNull())
        .select(F.col("doc_id").cast("long").alias("label_id"), F.col("text").cast("string").alias("body"))
        .join(F.broadcast(chosen[0].union(chosen[1])), "label_id")
        .groupBy("label_id", "toxic")
        .agg(F.min("body").alias("body"))
    )
    # A few thousand rows at most.
    before = Window.partitionBy("toxic").orderBy(order, "label_id").rowsBetween(Window.unboundedPreceding, -1)
    read = F.coalesce(F.sum(F.octet_length("body")).over(before), F.lit(0))
    texts = rows.withColumn("read", read).where(F.col("read") < SAMPLE_BYTES).orderBy("label_id").toArrow()
    return train(texts.column("body").to_pylist(), texts.column("toxic").to_pylist(), float(share))


def scored(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Each row's ``doc_id, held_out, score, predicted``.

    A row is held out if the CRC-32 of its id is 0 modulo ``folds``, or its id is
    null. Null and empty texts, and those without letters or digits, score the
    share of toxic texts among the labelled; so do all texts where no labelled text has
    letters, or all such have one label. An empty table gives an empty table.
    """
    model = fit(docs, labels, folds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = margins(batch.column(2).fill_null("").to_pylist(), model.table)
            scores = np.array([model.probability(m) for m in found])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _held_out(folds).alias("held_out"),
        F.col("text").cast("string").alias("body"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")

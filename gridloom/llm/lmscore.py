"""Scores of texts under a subword language model that sums over all segmentations.

The pieces are those of an existing vocabulary, which is never changed. Its order
gives each piece a first score, by Zipf's law over ranks; the training documents then
estimate the scores by expected counts over all segmentations (Kudo, "Subword
Regularization", the unigram model), the first scores staying in as a prior. A text
is its words, lower-cased by ASCII, and an end. No piece reaches over a word's end, so the sum over
all segmentations of a text is the product of its words' sums, and each different word
of the corpus is summed once.

The corpus is gathered as words with counts: documents become shards with
vocabularies of their own, words are counted over all shards, scored, and joined
back by word. A plain word model with one added count stands beside the score.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridloom.llm.common import checkpoint
from gridloom.llm.languageid import crc_slot
from gridloom.llm.lattice import WORD_END, Lattice, Trie, byte_of
from gridloom.llm.terms import BETWEEN_BLANKS, Shard, shards

#: Rounds of expected counts; a fourth adds less than a hundredth of a digit a word.
ROUNDS = 3
#: Pieces that the first scores count for beside the training documents.
PRIOR = 1000.0
#: Texts and bytes of text that share a vocabulary; larger shards ask for fewer words.
SHARD_TEXTS, SHARD_BYTES = 8192, 5 << 21
#: Ranks that come before the first piece in Zipf's law, which flattens its head.
RANKS = 512
#: The rows whose id's CRC-32 is ``HELD`` modulo ``FOLDS`` are not learned from.
FOLDS, HELD = 7, 2


def vocabulary(path: str) -> list[tuple[bytes, bool]]:
    """A byte-level vocabulary with word ends: each piece's bytes, and whether it ends words, by rank."""
    tokenizer = Tokenizer.from_file(path)
    special = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
    byte = byte_of()
    found = []
    for piece, _ in sorted(tokenizer.get_vocab().items(), key=lambda item: item[1]):
        if piece not in special:
            last = piece.endswith(WORD_END)
            found.append((bytes(byte[c] for c in (piece[: -len(WORD_END)] if last else piece)), last))
    single = {piece for piece in found if len(piece[0]) == 1}
    if len(single) != 512:
        raise ValueError(f"{path} lacks some of the bytes as pieces")
    return found


class Model:
    """Natural logarithms of the pieces' probabilities and of the end's."""

    def __init__(self, scores: np.ndarray, end: float):
        self.scores, self.end = scores, end

    @classmethod
    def of(cls, expected: np.ndarray, ends: int) -> "Model":
        """From expected counts of pieces and the number of ends; without any, from ranks alone."""
        zipf = 1.0 / (RANKS + np.arange(len(expected)))
        mass = expected + PRIOR * zipf / zipf.sum()
        total = mass.sum() + ends + 1
        return cls(np.log(mass / total), float(np.log((ends + 1) / total)))


def _expected(trie: Trie, model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, sums = Lattice(trie, model.scores), np.zeros(trie.pieces)
        for batch in batches:
            words = batch.column(0).cast(pa.binary()).to_pylist()
            sums += lattice.expected(words, batch.column(1).to_numpy().astype(np.float64))
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["piece", "n"])

    return run


def fit(counts: DataFrame, ends: int, trie: Trie, rounds: int = ROUNDS) -> Model:
    """Piece scores from ``word, c``; what reaches the driver is a number per piece."""
    model = Model.of(np.zeros(trie.pieces), 0)
    known = counts.where("c > 0").select("word", "c")
    for _ in range(rounds):
        sums = known.mapInArrow(_expected(trie, model), "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        # Sums of doubles in another order differ in their last bits; round these off.
        table = sums.toArrow()
        expected = np.zeros(trie.pieces)
        expected[table.column("piece").to_numpy()] = np.round(table.column("n").to_numpy(), 6)
        model = Model.of(expected, ends)
    return model


def _with_scores(counts: DataFrame, trie: Trie, model: Model) -> DataFrame:
    """``word, c`` and ``lp``, the natural logarithm of the word's probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(trie, model.scores)
        for batch in batches:
            found = lattice.log_probabilities(batch.column(0).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=["word", "c", "lp"])

    return counts.select("word", "c").mapInArrow(run, "word string, c long, lp double")


def _scorer(train_tokens: int, different: int, ends: int, model: Model):
    """``different`` tokens, the end among them if there is any."""
    floor = np.log10(train_tokens + different + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = Shard.read({name: batch.column(name)[k].as_buffer() for name in Shard.KINDS})
                answers = batch.column("answers").slice(k, 1).flatten()
                at, c_at, lp_at = (answers.field(name).to_numpy() for name in ("code", "c", "lp"))
                c, lp = np.zeros(len(answers), np.int64), np.zeros(len(answers))
                c[at], lp[at] = c_at, lp_at
                rows, size = shard.rows(), len(shard.ids)
                times, known = shard.counts.astype(np.int64), c[shard.codes] > 0

                def sums(values: np.ndarray) -> np.ndarray:
                    return np.bincount(rows, values, minlength=size)

                base = sums(times * (np.log10(c + 1.0) - floor)[shard.codes]) + np.log10(ends + 1.0) - floor
                score = (sums(times * lp[shard.codes]) + model.end) / np.log(10.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.ids, pa.int64(), mask=shard.no_id.astype(bool)),
                        pa.array(shard.marked == 0),
                        pa.array(shard.sizes + 1),
                        pa.array(sums(times * known).astype(np.int64) + (ends > 0)),
                        pa.array(np.full(size, train_tokens, np.int64)),
                        pa.array(base),
                        pa.array(score),
                    ],
                    names=[c.split()[0] for c in SCORED.split(", ")],
                )

    return run


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def scored(docs: DataFrame, tokenizer: str, folds: int = FOLDS, held: int = HELD, rounds: int = ROUNDS) -> DataFrame:
    """Each row's ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    A row is held out if the CRC-32 of its id is ``held`` modulo ``folds``, or its id is null; all others
    are learned from, repeats included. Null and empty texts are an end alone. ``score`` is the log10
    probability of the whole text, ``base_score`` that of a word model with one added count.
    With nothing to learn from, piece scores follow from ranks. An empty table gives an empty table.
    """
    learn = F.coalesce(crc_slot(folds) != held, F.lit(False))
    parts = checkpoint(shards(docs, BETWEEN_BLANKS, marked=learn, texts=SHARD_TEXTS, size=SHARD_BYTES))
    exploded = parts.select("shard", F.posexplode(F.arrays_zip("words", "learned")).alias("code", "x"))
    exploded = exploded.select("shard", "code", F.col("x.words").alias("word"), F.col("x.learned").alias("n"))
    counts = checkpoint(exploded.groupBy("word").agg(F.sum("n").alias("c")))
    totals = counts.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    ends = docs.where(learn).count()
    trie = Trie.build(vocabulary(tokenizer))
    model = fit(counts, ends, trie, rounds)
    answers = (
        exploded.select("shard", "code", "word")
        .join(_with_scores(counts, trie, model), "word")
        .groupBy("shard")
        .agg(F.collect_list(F.struct("code", "c", "lp")).alias("answers"))
    )
    asked = parts.select("shard", *Shard.KINDS).join(answers, "shard", "left")
    run = _scorer((totals[0] or 0) + ends, totals[1] + (ends > 0), ends, model)
    return asked.mapInArrow(run, SCORED)

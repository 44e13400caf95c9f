"""Language identification by prediction by partial matching over bytes.

For each language a tree of byte contexts of up to ``ORDER`` bytes counts which
byte followed. A byte seen in a context costs by its count there; for others the
context escapes, by method C with probability d / (n + d) after n bytes of d
kinds, to the next shorter context, over the bytes it has not seen itself. The
statistics are frozen after training, so each context is a fixed distribution and
the code length of a text is the sum of its bytes' costs. The language with the
shortest code wins; the score is its share of the languages' probabilities.

The fit uses at most ``SAMPLE_DOCS`` documents of each language, and keeps all contexts
met in them. The model so grows with the number of languages alone. Languages
whose trees do not fit into one task together are dealt into parts of bounded size; the
documents pass one part after the other and carry the best code length along. Scoring
reads every byte of every text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import checkpoint

ORDER = 3
#: Labelled documents that each language's tree is grown from.
SAMPLE_DOCS = 400
#: Languages whose numbers of documents are sent to every task.
FEW_LANGUAGES = 100_000
#: Bytes of trees that a task holds, and what a language takes besides its contexts.
PART_BYTES, LANGUAGE_BYTES = 1 << 27, 1 << 19
#: Different bytes.
KINDS = 256
#: What stands before the first byte of a text.
BEFORE = b"\n" * ORDER
#: Bytes scored together.
STRETCH = 1 << 20
#: Rows scored together.
ROWS = 1024
UNDETERMINED = "und"


# --- training ----------------------------------------------------------------


def crc_slot(parts: int) -> Column:
    """CRC-32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def sample(docs: DataFrame, learn: Column, size: int = SAMPLE_DOCS) -> DataFrame:
    """``lang, body`` of at most ``size`` rows of each language that ``learn`` allows, by hash."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = checkpoint(rows.groupBy("lang").count())
    # Else the texts would be shuffled by language only to be thinned out.
    few = F.broadcast(counts) if counts.count() <= FEW_LANGUAGES else counts
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / F.lit(float(1 << 53))
    likely = (
        rows.join(few, "lang")
        .select("lang", F.col("text").alias("body"), draw.alias("draw"), "count")
        .where(F.col("draw") * F.col("count") < 2.0 * size)
    )
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "body"))
    return likely.withColumn("place", first).where(F.col("place") <= size).select("lang", "body")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each byte follows each context, by language, order and batch."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for lang in sorted(set(langs)):
            data = b"".join(BEFORE + texts[k] for k in np.flatnonzero(langs == lang))
            codes = np.frombuffer(data, np.uint8).astype(np.int64)
            real = np.concatenate(
                [np.arange(len(BEFORE) + len(texts[k])) >= len(BEFORE) for k in np.flatnonzero(langs == lang)]
            )
            at = np.flatnonzero(real)
            window = codes[at]
            for order in range(ORDER + 1):
                if order:
                    window = window + (codes[at - order] << (8 * order))
                keys, counts = np.unique(window, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(keys), pa.string()),
                        pa.array(np.full(len(keys), order, np.int32)),
                        pa.array(keys >> 8),
                        pa.array((keys & 0xFF).astype(np.int32)),
                        pa.array(counts),
                    ],
                    names=["lang", "depth", "context", "symbol", "n"],
                )


def count_contexts(rows: DataFrame) -> DataFrame:
    """``lang, depth, context, symbol, n``; a context is its bytes, the latest lowest."""
    kinds = "lang string, depth int, context long, symbol int, n long"
    return rows.mapInArrow(_counted, kinds).groupBy("lang", "depth", "context", "symbol").agg(F.sum("n").alias("n"))


def _blend(seen: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Each context's distribution: its counts, and by escape the shorter context's unseen bytes."""
    total = seen.sum(axis=1, keepdims=True)
    kinds = (seen > 0).sum(axis=1, keepdims=True)
    unseen = np.where(seen > 0, 0.0, lower)
    rest = unseen.sum(axis=1, keepdims=True)
    escape = np.where(rest > 0, kinds, 0)
    return (seen + escape * unseen / np.where(rest > 0, rest, 1.0)) / (total + escape)


class Tree:
    """One language's contexts and what each byte costs in them, in bits.

    A context is a number in base ``KINDS``, its latest byte the lowest digit.
    Row 0 of the costs is the uniform distribution, then come the kept contexts
    from the shortest on.
    """

    def __init__(self, counts: pa.Table):
        depth, context, symbol, n = (
            counts.column(c).to_numpy() for c in ("depth", "context", "symbol", "n")
        )
        rows, self.keys = [np.full((1, KINDS), 1.0 / KINDS)], []
        state = np.zeros(1, np.int32)
        for order in range(ORDER + 1):
            here = depth == order
            keys, at = np.unique(context[here], return_inverse=True)
            seen = np.zeros((len(keys), KINDS))
            np.add.at(seen, (at, symbol[here]), n[here])
            lower = np.concatenate(rows)[state[keys % len(state)]]
            self.keys.append(keys)
            if order < ORDER:
                state = self._longer(state, order, keys, sum(map(len, rows)))
            rows.append(_blend(seen, lower))
        self.costs = -np.log2(np.maximum(np.concatenate(rows), 1e-300)).astype("f4")

    def _longer(self, state: np.ndarray, order: int, keys: np.ndarray, base: int) -> np.ndarray:
        """The row of each context one symbol longer: its own, or that of its suffix."""
        state = np.tile(state, KINDS) if order else state.copy()
        state[keys] = np.arange(base, base + len(keys), dtype=np.int32)
        return state

    def states(self, contexts: np.ndarray) -> np.ndarray:
        """The row of costs for ``contexts`` of ``ORDER`` bytes, then for all that are one byte shorter."""
        state, base = np.zeros(1, np.int32), 1
        for order, keys in enumerate(self.keys[:-1]):
            state = self._longer(state, order, keys, base)
            base += len(keys)
        found = state[contexts % len(state)]
        found[np.searchsorted(contexts, self.keys[-1])] = np.arange(
            base, base + len(self.keys[-1]), dtype=np.int32
        )
        return np.concatenate([found, state])


class Model:
    """The frozen trees of all languages."""

    def __init__(self, counts: pa.Table):
        self.kinds, self.symbols = KINDS, np.arange(KINDS, dtype=np.uint8)
        names = counts.column("lang").to_pylist()
        self.langs = sorted(set(names))
        names = np.array(names, object)
        self.trees = [
            Tree(counts.filter(pa.array(names == lang))) for lang in self.langs
        ]


class Scorer:
    """Code lengths of texts under every language."""

    def __init__(self, model: Model):
        self.model = model
        kept = [tree.keys[-1] for tree in model.trees]
        contexts = np.unique(np.concatenate([np.zeros(0, np.int64), *kept]))
        # One table for all languages: the place of a context that any keeps, else of its suffix. Only
        # suffixes of kept contexts have a row, with an entry for each byte before them.
        shorter = KINDS ** (ORDER - 1)
        wide, row = np.unique(contexts % shorter, return_inverse=True)
        self.first = np.arange(shorter, dtype=np.int32)
        self.first[wide] = shorter + KINDS * np.arange(len(wide), dtype=np.int32)
        self.mask = np.zeros(shorter, np.uint8)
        self.mask[wide] = KINDS - 1
        others = np.concatenate([np.arange(shorter), np.repeat(wide, KINDS)]) + len(contexts)
        self.places = others.astype(np.int32)
        self.places[shorter + KINDS * row + contexts // shorter] = np.arange(len(contexts), dtype=np.int32)
        self.states = [tree.states(contexts) for tree in model.trees]

    def _stretch(self, data: bytes, starts: list[int]) -> np.ndarray:
        """Bits of each segment under each language; a segment begins with ``ORDER`` bytes of context."""
        k = KINDS
        given = np.frombuffer(data, np.uint8)
        symbols = given.astype(np.int32)
        suffix = symbols[2:-1] + k * symbols[1:-2]
        place = self.places[self.first[suffix] + (given[:-3] & self.mask[suffix])]
        bits = np.empty((len(self.states), len(starts)))
        first, last = np.array(starts), np.array([*starts[1:], len(data)]) - ORDER
        for row, state, tree in zip(bits, self.states, self.model.trees):
            costs = tree.costs.ravel()[state[place] * k + symbols[ORDER:]]
            sums = np.concatenate([[0.0], np.cumsum(costs, dtype=np.float64)])
            row[:] = sums[last] - sums[first]
        return bits

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language, one row per text."""
        found = np.zeros((len(texts), len(self.states)))
        held, starts, owners, size = [], [], [], 0

        def flush() -> None:
            nonlocal held, starts, owners, size
            if held:
                np.add.at(found, owners, self._stretch(b"".join(held), starts).T)
            held, starts, owners, size = [], [], [], 0

        for owner, text in enumerate(texts):
            for a in range(0, len(text), STRETCH):
                context = text[a - ORDER : a] if a else BEFORE
                part = context + text[a : a + STRETCH]
                held.append(part)
                starts.append(size)
                owners.append(owner)
                size += len(part)
                if size >= STRETCH:
                    flush()
        flush()
        return found


def fit(docs: DataFrame, learn: Column, size: int = SAMPLE_DOCS) -> tuple[DataFrame, int]:
    """Context counts of the languages in ``lang``, from the rows that ``learn`` allows, each language
    with its ``part``, and the number of parts; 0 if there is nothing to learn from."""
    counts = checkpoint(count_contexts(checkpoint(sample(docs, learn, size))))
    contexts = counts.select("lang", "depth", "context").distinct()
    sizes = contexts.groupBy("lang").agg((F.count("*") * (4 * KINDS) + LANGUAGE_BYTES).alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    parts = -(-total // PART_BYTES)
    return counts.withColumn("part", F.pmod(F.xxhash64("lang"), F.lit(max(1, parts)))), parts


def _model(counts: DataFrame, part: int) -> Model:
    rows = counts.where(F.col("part") == part).drop("part")
    return Model(rows.orderBy("lang", "depth", "context", "symbol").toArrow())


def _passes(model: Model, keeps_text: bool):
    """Each row's best language so far with its bits, and all languages' probabilities beside it."""

    def scored(scorer: Scorer, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.num_columns - 1)
        found = scorer.code_lengths(texts.cast(pa.binary()).fill_null(b"").to_pylist())
        langs, best, mass = (batch.column(k).to_pylist() for k in range(batch.num_columns - 4, batch.num_columns - 1))
        for k, row in enumerate(found):
            text = texts[k].as_py()
            if text is None or not any(map(str.isalpha, text)):
                continue
            first = int(row.argmin())
            bits, lang = float(row[first]), model.langs[first]
            share = float(np.exp2(np.maximum(bits - row, -1000.0)).sum())
            if langs[k] is not None and (best[k], langs[k]) < (bits, lang):
                bits, lang, share, other, weight = best[k], langs[k], mass[k], bits, share
            else:
                other, weight = best[k], mass[k]
            if langs[k] is not None:
                share += weight * float(np.exp2(max(bits - other, -1000.0)))
            langs[k], best[k], mass[k] = lang, bits, share
        columns = [pa.array(langs, pa.string()), pa.array(best, pa.float64()), pa.array(mass, pa.float64())]
        kept = [texts] if keeps_text else []
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-4], *columns, *kept], names=batch.schema.names[: None if keeps_text else -1]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model.langs else None
        for batch in batches:
            if scorer is None:
                yield batch if keeps_text else batch.select(batch.schema.names[:-1])
                continue
            for a in range(0, batch.num_rows, ROWS):
                yield scored(scorer, batch.slice(a, ROWS))

    return run


def _asked(docs: DataFrame, model: tuple[DataFrame, int], keep: list, keeps_text: bool) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score``, and the text as ``body`` if it is kept."""
    counts, parts = model
    rows = docs.select(
        *keep,
        F.lit(None).cast("string").alias("lang_pred"),
        F.lit(None).cast("double").alias("bits"),
        F.lit(None).cast("double").alias("mass"),
        F.col("text").cast("string").alias("body"),
    )
    names = rows.columns[:-4]
    for part in range(parts):
        learned, last = _model(counts, part), part + 1 == parts
        schema = rows.schema if keeps_text or not last else rows.drop("body").schema
        rows = rows.mapInArrow(_passes(learned, keeps_text or not last), schema)
        if not last:  # else all parts' trees would be held together
            rows = checkpoint(rows)
    return rows.select(
        *names,
        F.coalesce("lang_pred", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.coalesce(1.0 / F.col("mass"), F.lit(0.0)).alias("score"),
        *(["body"] if keeps_text else []),
    )


def predict(docs: DataFrame, model: tuple[DataFrame, int], *keep: Column) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` of each row.

    ``und`` with score 0 where the text is null or has no letter, or no language
    was learned. Equal code lengths go to the first language by name.
    """
    return _asked(docs, model, list(keep), keeps_text=False)


def identified(docs: DataFrame, folds: int = 4, held: int = 2, size: int = SAMPLE_DOCS) -> DataFrame:
    """Each row's ``doc_id, held_out, lang_pred, score``, learned from the rows not held out.

    A row is held out if the CRC-32 of its id is ``held`` modulo ``folds``, or its id is
    null. An empty table gives an empty table.
    """
    held_out = F.coalesce(crc_slot(folds) == held, F.lit(True))
    model = fit(docs, ~held_out, size)
    return predict(docs, model, F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"))


def with_language(docs: DataFrame, size: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of ``docs`` in which a language was found; those without a letter go.

    Where no row has a ``lang`` to learn from, every text with a letter stays.
    """
    model = fit(docs, F.lit(True), size)
    # The text travels once.
    others = [c for c in docs.columns if c != "text"]
    names = {c: f"__{k}" for k, c in enumerate(others)} | {"text": "body"}
    rows = docs.select(*(F.col(f"`{c}`").alias(names[c]) for c in others), "text")
    if model[1]:
        rows = _asked(rows, model, [names[c] for c in others], keeps_text=True)
        rows = rows.where(F.col("lang_pred") != UNDETERMINED)
    else:
        rows = rows.where(F.col("text").cast("string").rlike(r"\p{L}")).withColumnRenamed("text", "body")
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    return rows.select(*(F.col(names[c]).cast(kinds[c]).alias(c) for c in docs.columns))

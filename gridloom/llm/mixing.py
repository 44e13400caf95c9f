"""Mixing sources to target weights by pivotal dependent rounding, in built-in expressions.

A source's target over its size is the expected number of copies of each of its
documents. The whole part is given; the fractions are settled in pairs: words
move at random from one document of a pair to the other until one fraction is 0
or 1, with odds that leave both expectations as they were. The open one of a
pair meets the next document. A chunk of documents so ends with at most one open
fraction; those meet in chunks of the next level, up to one per source. Words are
conserved at every step, so a source ends within one document of its target. What
that document leaves over is made good by ``CORRECTIONS`` settled documents of about
that many words.

Levels are group-bys over chunks of about ``CHUNK`` documents, whatever the size
of a source, so a source with a third of all rows is spread like any other.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import ROW_KEY, checkpoint, named_rows, row_key

#: Documents that a chunk holds on average.
CHUNK = 32
#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: No source and no document is taken more often than this.
MOST_COPIES = 3
#: Settled documents of a source that may be turned to meet its target more closely.
CORRECTIONS = 2
WORD = r"[^\x20\x09-\x0D]+"
TINY = 1e-9
SOURCE = ["no_source", "source"]


#: Parts that the rows of one source are dealt into where they meet its figures.
SALTS = 64


def _with_figures(rows: DataFrame, figures: DataFrame) -> DataFrame:
    """``rows`` joined to the one row of ``figures`` for their source, which is repeated ``SALTS`` times.

    So a source with a third of all rows meets its figures in many tasks.
    """
    salted = figures.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("row_hash", "doc_id"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [*SOURCE, "salt"]).drop("salt")


def _let(value: Column, then) -> Column:
    """``then(value)``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


# --- targets -----------------------------------------------------------------


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with their place in code point order, null last, from 0."""
    ordered = checkpoint(sources.orderBy(*SOURCE))
    placed = ordered.withColumn("at", F.monotonically_increasing_id()).withColumn(
        "part", F.shiftright("at", 33)
    )
    # One row per partition that holds sources.
    counts = placed.groupBy("part").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    place = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(starts), "part").withColumn("place", place).drop("part", "at", "start")


def targets(sources: DataFrame, weights=WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """``sources`` with ``target``: the shares of the total by weight, held to ``most`` times the size.

    What a full source cannot take goes to the others by weight, until none is
    above its bound. Each round reads two sums; a round fills at least one source.
    """
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int")
    )
    rows = _numbered(sources).withColumn("weight", weight)
    rows = checkpoint(rows.withColumn("bound", F.lit(float(most)) * F.col("source_size")))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, full = None, F.lit(False)
    while True:
        held, open_weight = rows.agg(
            F.sum(F.when(full, F.col("bound"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        now = (total - (held or 0.0)) / open_weight if open_weight else 0.0
        if level is not None and now <= level:
            break
        level = now
        full = F.col("weight") * F.lit(level) > F.col("bound")
    share = F.least(F.col("weight") * F.lit(level), F.col("bound"))
    return rows.select(*SOURCE, "source_size", "groups", share.alias("target"))


# --- pivotal rounding --------------------------------------------------------


def _uniform(seed: int, *keys: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11) / F.lit(float(1 << 53))


def _with_part(item: Column, part: Column) -> Column:
    whole = F.when(part < TINY, 0.0).when(part > 1 - TINY, 1.0).otherwise(part)
    return item.withField("part", whole)


def _settle(a: Column, b: Column, seed: int) -> Column:
    """Both items after words moved between them; one of them is whole."""
    mass = lambda x: F.greatest(x["size"], F.lit(1)).cast("double")
    to_a = F.least((1 - a["part"]) * mass(a), b["part"] * mass(b))
    to_b = F.least((1 - b["part"]) * mass(b), a["part"] * mass(a))
    first = _uniform(seed, a["row_hash"], a["doc_id"], b["row_hash"], b["doc_id"])

    def move(m: Column) -> Column:
        gain = F.when(first * (m["to_a"] + m["to_b"]) < m["to_b"], m["to_a"]).otherwise(-m["to_b"])
        return F.array(
            _with_part(a, a["part"] + gain / mass(a)), _with_part(b, b["part"] - gain / mass(b))
        )

    return _let(F.struct(to_a.alias("to_a"), to_b.alias("to_b")), move)


def _between(part: Column) -> Column:
    return (part > 0) & (part < 1)


def _is_open(item: Column) -> Column:
    return _between(item["part"])


def _fold(items: Column, kind: str, seed: int) -> Column:
    """``done``, the settled items, and ``carry``, an open one or null."""
    start = F.expr(f"named_struct('done', cast(array() as array<{kind}>), 'carry', cast(null as {kind}))")

    def step(state: Column, item: Column) -> Column:
        def after(pair: Column) -> Column:
            left = F.filter(pair, _is_open)
            return F.struct(
                F.concat(state["done"], F.filter(pair, lambda x: ~_is_open(x))).alias("done"),
                F.get(left, F.lit(0)).alias("carry"),
            )

        met = _let(_settle(state["carry"], item, seed), after)
        fresh = F.struct(state["done"].alias("done"), item.alias("carry"))
        return F.when(state["carry"].isNull(), fresh).otherwise(met)

    return F.aggregate(items, start, step)


ITEM = ["size", "row_hash", "doc_id", "rows", "whole", "rounds", "part"]


def round_copies(items: DataFrame, seed: int = 0) -> DataFrame:
    """``items`` with ``part`` settled to 0 or 1 within each source.

    Items have the columns of ``SOURCE`` and ``ITEM`` and ``groups``, the number of
    items of their source.
    """
    columns = [*SOURCE, *ITEM]
    settled = items.where(~_between(F.col("part"))).select(*columns)
    rest = items.where(_between(F.col("part"))).select(*columns, "groups")
    level = 0
    while True:
        chunks = F.ceil(F.col("groups") / CHUNK).cast("long")
        chunk = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "row_hash", "doc_id"), chunks)
        grouped = (
            rest.withColumn("chunks", chunks)
            .withColumn("chunk", chunk)
            .groupBy(*SOURCE, "chunks", "chunk")
            .agg(F.sort_array(F.collect_list(F.struct(*ITEM)), asc=False).alias("items"))
        )
        kind = grouped.schema["items"].dataType.elementType.simpleString()
        folded = checkpoint(
            grouped.withColumn("state", _fold(F.col("items"), kind, seed + level)).select(
                *SOURCE, "chunks", F.col("state.done").alias("done"), F.col("state.carry").alias("carry")
            )
        )
        done = folded.select(*SOURCE, F.inline("done"))
        settled = settled.unionByName(done.select(*columns))
        still = folded.where("carry is not null").select(*SOURCE, "chunks", "carry.*")
        last = still.where("chunks = 1").withColumn("part", F.round("part"))
        settled = settled.unionByName(last.select(*columns))
        rest = still.where("chunks > 1").withColumn("groups", F.col("chunks"))
        if rest.isEmpty():
            return settled.select(*columns)
        level += 1


def make_good(settled: DataFrame, goals: DataFrame) -> DataFrame:
    """``settled`` with at most one document of each source taken once more or once less.

    It is the one whose words come nearest to what the source is over or under its
    target by, if that brings the source nearer.
    """
    copies = F.col("whole") + F.col("part").cast("long")
    over = settled.groupBy(*SOURCE).agg(F.sum(F.col("size") * copies).alias("taken"))
    over = over.join(goals, SOURCE).select(*SOURCE, (F.col("taken") - F.col("target")).alias("over"))
    misses = F.abs(F.col("size") - F.abs("over"))
    turned = F.when(F.col("over") > 0, F.col("part") == 1).otherwise(
        (F.col("part") == 0) & F.col("rounds")
    )
    best = (
        _with_figures(settled, over)
        .where(turned & (misses < F.abs("over")))
        .groupBy(*SOURCE)
        .agg(F.min(F.struct(misses.alias("miss"), "row_hash", "doc_id")).alias("best"))
        .select(
            *(F.col(c).alias(f"best_{c}") for c in SOURCE),
            F.col("best.row_hash").alias("best_hash"),
            F.col("best.doc_id").alias("best_id"),
        )
    )
    same = [F.col(c) == F.col(f"best_{c}") for c in SOURCE]
    same += [F.col("row_hash") == F.col("best_hash"), F.col("doc_id").eqNullSafe(F.col("best_id"))]
    turned = settled.join(best, same, "left")
    part = F.when(F.col("best_hash").isNotNull(), 1 - F.col("part")).otherwise(F.col("part"))
    return turned.withColumn("part", part).select(*settled.columns)


# --- the operator ------------------------------------------------------------


def plan(docs: DataFrame, weights=WEIGHTS, most: float = MOST_COPIES, seed: int = 0) -> DataFrame:
    """How often each row is taken: one row for rows that repeat each other.

    Columns: ``no_source, source, source_size, target, doc_id, row_hash, size``
    (words of the text, null 0), ``rows`` (how many such rows there are) and
    ``copies`` (of all of them together). Words are runs without ASCII blanks.
    Rows without a source form one, last in order. A document without words
    rounds like one of a single word. Without any words all targets are 0.
    """
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0))
    items = checkpoint(
        docs.select(
            F.col("source").isNull().alias("no_source"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
            F.col("doc_id").cast("long").alias("doc_id"),
            row_key(docs)[1].alias("row_hash"),
            words.cast("long").alias("size"),
        )
        .groupBy(*SOURCE, "doc_id", "row_hash", "size")
        .agg(F.count("*").alias("rows"))
    )
    sources = items.groupBy(*SOURCE).agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("groups")
    )
    goals = checkpoint(targets(sources, weights, most))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = rate * F.col("rows")
    parts = (
        _with_figures(items, goals)
        .withColumn("whole", F.floor(wanted + TINY).cast("long"))
        .withColumn("part", F.greatest(wanted - F.floor(wanted + TINY), F.lit(0.0)))
    )
    parts = parts.withColumn("part", F.when(F.col("part") < TINY, 0.0).otherwise(F.col("part")))
    # A part that starts at 0 stands for copies that are whole already.
    parts = parts.withColumn("rounds", F.col("part") > 0)
    rounded = round_copies(parts, seed)
    for _ in range(CORRECTIONS):
        rounded = make_good(checkpoint(rounded), goals)
    return _with_figures(rounded, goals.drop("groups")).select(
        *SOURCE,
        "source_size",
        "target",
        "doc_id",
        "row_hash",
        "size",
        "rows",
        (F.col("whole") + F.col("part").cast("long")).alias("copies"),
    )


def _share(copies: str, rows: str, place: Column) -> Column:
    """What the ``place``-th of ``rows`` equal rows gets of their ``copies``, as even as can be."""
    even = F.floor(F.col(copies) / F.col(rows)).cast("long")
    return even + (place <= F.pmod(F.col(copies), F.col(rows))).cast("long")


def taken_words(docs: DataFrame, weights=WEIGHTS, most: float = MOST_COPIES, seed: int = 0) -> DataFrame:
    """Per row ``doc_id, size, source_size, target, taken``: the words the mix takes, repeats counted.

    A document is taken at most ``most`` times, for a whole number of ``most``; reruns agree. An
    empty table gives an empty table.
    """
    places = plan(docs, weights, most, seed).withColumn(
        "place", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    )
    taken = F.col("size") * _share("copies", "rows", F.col("place"))
    return places.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, most: float = MOST_COPIES, seed: int = 0) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the plan takes it."""
    chosen = plan(docs, weights, most, seed).select(
        F.coalesce("doc_id", F.lit(0).cast("long")).alias(ROW_KEY[0]),
        F.col("row_hash").alias(ROW_KEY[1]),
        "rows",
        "copies",
    )
    place = F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy(ROW_KEY[1]))
    joined = named_rows(docs).join(chosen.where("copies > 0"), ROW_KEY)
    times = joined.withColumn("times", _share("copies", "rows", place)).where("times > 0")
    return times.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")

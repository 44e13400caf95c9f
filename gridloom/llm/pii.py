"""Personal data: base patterns, and the terms around them that give them away.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Each
different value is an entity to protect. A term is a word of a text that holds an entity. Over
the whole corpus, the pointwise mutual information of term and entity says how
much of the entity's information a reader gains from the term alone (Sánchez and
Batet, "C-sanitized"): with n documents, p_e the share with the entity, n_t documents with
the term, and n_te with both, of k different texts,

    p = (k * n_te / n_t + WEIGHT * p_e) / (k + WEIGHT)
    disclosure = log(p / p_e) / log(1 / p_e)

p is how likely the term's documents hold the entity, drawn towards what holds without
the term as if ``WEIGHT`` more texts said so; copies of a text are one piece of evidence.
From ``REMOVE`` on a term is removed wherever it stands in the texts with that entity, from
``GENERALISE`` on it is replaced by a general word. Every entity and every pair met is rated;
pairs whose term stands in too many documents to pass, even if all that could hold
the entity did, are left out before they are counted. Entities that stand in the same texts
are counted as one.

A pair that meets in one text only is rated by the text's figures and the entity's count alone.
So a text's terms are rated against the different counts of its entities, not against each
entity; only terms and entities that both stand in several texts are paired to be counted.
"""

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import checkpoint, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Texts that speak for chance before any is read.
WEIGHT = 1.5
GENERALISE, REMOVE = 0.75, 0.9
#: Bits of the filter for candidate terms: more terms pass more words, and change nothing else.
FILTER_BITS = 1 << 23
#: Terms that a task counts before it hands them on.
HELD_TERMS = 200_000
PLACEHOLDERS = {kind: f"[{kind.upper()}]" for kind in KINDS} | {"generalise": "[TERM]", "remove": ""}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_WORD = re.compile(r"[^\W_]+")
_DIGITS = re.compile(r"[^0-9]")

Span = tuple[int, int]


# --- base patterns -----------------------------------------------------------


def emails(text: str) -> Iterator[Span]:
    """An address takes all allowed characters before its ``@``; each is looked at once."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        free = at + 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def _ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by kind, then start."""
    if not _HINT.search(text):
        return []
    finders = zip(KINDS, (emails, _ips, _cards, _phones))
    return [(kind, a, b) for kind, find in finders for a, b in find(text)]


def entity(kind: str, value: str) -> str:
    plain = value.lower() if kind in ("email", "ip") else _DIGITS.sub("", value)
    return f"{kind}:{plain}"


def _merged(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what the spans cover."""
    starts, ends = [], []
    for a, b in sorted((a, b) for _, a, b in spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def words(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """``(term, start, end)`` for the words that lie in no span."""
    starts, ends = _merged(spans)
    for m in _WORD.finditer(text):
        a, b = m.span()
        place = bisect_left(starts, b) - 1
        if not (place >= 0 and ends[place] > a):
            yield m[0].lower(), a, b


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def _parted(joined: str) -> list[tuple[str, int, int]]:
    return [(kind, int(a), int(b)) for kind, a, b in (s.split(":") for s in joined.split(",") if s)]


_FOUND = (
    ", ".join(f"n_{kind} long" for kind in KINDS)
    + ", base_sha256 string, base string, entities array<string>, body string"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(2).to_pylist():
            spans = base_spans(text)
            joined, counts = _joined(spans), Counter(kind for kind, _, _ in spans)
            names = {entity(kind, text[a:b]) for kind, a, b in spans}
            digest = hashlib.sha256(joined.encode()).hexdigest()
            rows.append((*(counts[kind] for kind in KINDS), digest, joined, sorted(names), text if spans else None))
        columns = list(zip(*rows)) or [()] * 8
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.list_(pa.string()), pa.string()]
        names = [f"n_{kind}" for kind in KINDS] + ["base_sha256", "base", "entities", "body"]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], *(pa.array(c, kind) for c, kind in zip(columns, kinds))],
            names=["doc_id", "digest", *names],
        )


# --- corpus statistics -------------------------------------------------------


def _filter_of(terms: DataFrame) -> bytes:
    """A bit per CRC-32 of the terms; at most ``FILTER_BITS`` bits reach the driver."""
    place = F.pmod(F.crc32("term"), F.lit(FILTER_BITS))
    parts = (
        terms.select(F.floor(place / 32).alias("word"), (place % 32).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    bits = bytearray(FILTER_BITS // 8)
    for word, value in zip(parts.column("word").to_pylist(), parts.column("bits").to_pylist()):
        bits[4 * word : 4 * word + 4] = value.to_bytes(4, "little")
    return bytes(bits)


def document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, n_t``: in how many documents each of ``terms`` occurs as a word."""
    bits = _filter_of(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            row = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["term", "n"],
            )
            counts.clear()
            return row

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word in {w.lower() for w in set(_WORD.findall(text))}:
                    place = zlib.crc32(word.encode("utf-8", "replace")) % FILTER_BITS
                    if bits[place >> 3] >> (place & 7) & 1:
                        counts[word] += 1
                if len(counts) > HELD_TERMS:
                    yield flush()
        yield flush()

    found = docs.select(text_or_empty().alias("body")).mapInArrow(run, "term string, n long")
    return found.groupBy("term").agg(F.sum("n").alias("n_t")).join(terms, "term", "left_semi")


def _disclosure(n_te: Column, texts: Column, n_t: Column, n_e: Column, total: int) -> Column:
    """The share of the entity's information that the term gives; ``n_e`` is below ``total``."""
    chance = n_e / F.lit(float(total))
    likely = (texts * n_te / n_t + WEIGHT * chance) / (texts + WEIGHT)
    return F.lit(1.0) - F.log(likely) / F.log(chance)


def holders(texts: DataFrame, total: int) -> DataFrame:
    """``text_hash, copies, entity, n_e, texts`` of the entities that some documents lack.

    Of entities that stand in the same texts, which have all counts in common, the first alone.
    """
    held = texts.select("text_hash", "copies", F.explode("entities").alias("entity"))
    same = [F.bit_xor(F.xxhash64("text_hash", F.lit(k))).alias(f"same{k}") for k in (1, 2)]
    alone = (
        held.groupBy("entity")
        .agg(F.sum("copies").alias("n_e"), F.count("*").alias("texts"), *same)
        .where(F.col("n_e") < total)
        .groupBy("same1", "same2", "n_e", "texts")
        .agg(F.min("entity").alias("entity"))
    )
    return held.join(alone.select("entity", "n_e", "texts"), "entity")


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's different terms."""
    for batch in batches:
        for digest, base, body in zip(*(c.to_pylist() for c in batch.columns)):
            found = sorted({term for term, _, _ in words(body, _parted(base))})
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest] * len(found), pa.int64()), pa.array(found, pa.string())],
                names=["text_hash", "term"],
            )


def revealing(docs: DataFrame, texts: DataFrame, total: int) -> DataFrame:
    """``text_hash, term, action`` for the terms whose disclosure of an entity passes a threshold."""
    held = checkpoint(holders(texts, total))
    most = held.agg(F.max("n_e")).first()[0]
    if most is None:
        return texts.select("text_hash", F.lit("").alias("term"), F.lit("").alias("action")).limit(0)
    terms = texts.select("text_hash", "base", "body").mapInArrow(_terms, "text_hash long, term string")
    counts = document_counts(docs, checkpoint(terms.select("term").distinct()))
    # n_te / n_t must reach (n_e / total) ** (1 - GENERALISE), and n_te is at most n_e.
    counts = counts.where(F.col("n_t") <= 1.001 * most**GENERALISE * total ** (1 - GENERALISE))
    known = checkpoint(terms.join(counts, "term"))
    n_t, n_e, copies = F.col("n_t"), F.col("n_e"), F.col("copies")
    # Met in this text alone, or at least here: the figures of one text.
    levels = held.select("text_hash", "copies", "n_e").distinct()
    once = _disclosure(F.least(copies, n_t), F.lit(1), n_t, n_e, total)
    alone = (
        known.join(levels, "text_hash")
        .groupBy("text_hash", "term")
        .agg(F.max(once).alias("disclosure"))
        .where(F.col("disclosure") >= GENERALISE)
    )
    # Met in several texts: counted.
    several = known.groupBy("term").agg(F.count("*").alias("k")).where("k > 1").select("term")
    best = _disclosure(F.least(n_e, n_t), F.least("texts", "n_t"), n_t, n_e, total)
    met = checkpoint(
        known.join(several, "term")
        .join(held.where("texts > 1"), "text_hash")
        .where(best >= GENERALISE - 1e-9)
        .select("text_hash", "entity", "term", "copies", "n_t", "n_e")
    )
    disclosure = _disclosure(F.col("n_te"), F.col("k"), n_t, n_e, total)
    rated = (
        met.groupBy("entity", "term", "n_t", "n_e")
        .agg(F.sum("copies").alias("n_te"), F.count("*").alias("k"))
        .withColumn("disclosure", disclosure)
        .where((F.col("disclosure") >= GENERALISE) & (F.col("k") > 1))
    )
    together = met.select("text_hash", "entity", "term").join(
        rated.select("entity", "term", "disclosure"), ["entity", "term"]
    )
    # A term that several entities mark takes the stronger action.
    action = F.when(F.max("disclosure") >= REMOVE, "remove").otherwise("generalise")
    marked = alone.union(together.select("text_hash", "term", "disclosure"))
    return marked.groupBy("text_hash", "term").agg(action.alias("action"))


# --- the operator ------------------------------------------------------------


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each text's marked terms, those to generalise first."""
    for batch in batches:
        marks = []
        for _, base, body, marked in zip(*(c.to_pylist() for c in batch.columns)):
            actions = {m["term"]: m["action"] for m in marked}
            spans = [(actions[t], a, b) for t, a, b in words(body, _parted(base)) if t in actions]
            marks.append(_joined(sorted(spans)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(marks, pa.string())], names=["text_hash", "marks"]
        )


def found(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, the text's SHA-256 ``digest``, the counts of base spans, ``base_sha256`` and ``spans``.

    Spans are ``kind:start:end`` in code points, joined by commas: the base spans by
    kind, then start, then the terms to generalise and those to remove by start.
    A revealing term is marked wherever it stands in a text with its entity, by the
    stronger action if several entities mark it. Null and empty texts have
    no spans; rows with equal ids and texts have equal spans. An empty table gives
    an empty table.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest"), text_or_empty().alias("body")
    )
    scanned = checkpoint(rows.mapInArrow(_scan, f"doc_id long, digest binary, {_FOUND}"))
    texts = checkpoint(
        scanned.where(F.col("base") != "")
        .groupBy("digest")
        .agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("base", "entities", "body")))
        .withColumn("text_hash", F.monotonically_increasing_id())
    )
    actions = (
        revealing(docs, texts, scanned.count())
        .groupBy("text_hash")
        .agg(F.collect_list(F.struct("term", "action")).alias("marked"))
    )
    marked = (
        texts.select("text_hash", "base", "body")
        .join(actions, "text_hash")
        .mapInArrow(_marks, "text_hash long, marks string")
    )
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), "marks")
    named = marked.join(texts.select("text_hash", "digest"), "text_hash").select("digest", "marks")
    return scanned.join(named, "digest", "left").select(
        "doc_id", "digest", *(f"n_{kind}" for kind in KINDS), "base_sha256", spans.alias("spans")
    )


def _digest() -> Column:
    """The SHA-256 of a text, by which texts are told apart."""
    return F.unhex(F.sha2(text_or_empty(), 256))


def redact(text: str, spans: str) -> str:
    """``text`` with each span replaced; of overlapping ones the first to start, then the longest."""
    parts = [s.split(":") for s in spans.split(",") if s]
    parts.sort(key=lambda p: (int(p[1]), -int(p[2])))
    out, at = [], 0
    for kind, a, b in parts:
        if int(a) >= at:
            out += [text[at : int(a)], PLACEHOLDERS[kind]]
        at = max(at, int(b))
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with all spans of their ``text`` replaced; a null text becomes empty."""
    spans = found(docs).where("spans <> ''").select("digest", "spans").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [redact(t, s or "") for t, s in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "clean"])

    rows = docs.select(F.struct("*").alias("row"), text_or_empty().alias("body"), _digest().alias("digest"))
    joined = rows.join(spans, "digest", "left").select("row", "body", "spans")
    kept = joined.select("row").schema
    clean = joined.mapInArrow(run, T.StructType([*kept.fields, T.StructField("clean", T.StringType())]))
    columns = [F.col("clean").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return clean.select(*columns)

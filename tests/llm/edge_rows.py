"""Documents with every odd row the operators must take."""

CLASHES = (
    "fp cluster least body length lane index size rows part source_size target "
    "lang_pred score held_out good draw key place kept spans text_hash node other links "
    "__row_id __row_hash __rows __copies __times __hash __spans __repeat __0 row repeat times copies clean digest shard words "
    "marked item term form n bits mass"
).split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, clashes=True):
    """Documents; with ``clashes``, also columns of names that operators use inside."""
    docs = spark.createDataFrame(
        [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows], SCHEMA
    ).repartition(3)
    if clashes:
        docs = docs.selectExpr("*", *(f"'x' AS `{name}`" for name in CLASHES))
    return docs


LONG = " ".join(f"word{i % 977}" for i in range(30_000))
EDGES = [
    (1, "Hello big World of words", "en", "a"),
    (2, "hello  big world of words", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \t\n", "fr", "b"),
    (None, "a text without an id", "fr", None),
    (7, LONG, "en", "b"),
    (8, "Größe, écrit: ñandú 123", None, ""),
    (9, "Hello big World of words", "en", "c"),
    (10, "one", "fr", "c"),
    (10, "one", "fr", "c"),
    (11, "12 34 !!", "fr", "c"),
]

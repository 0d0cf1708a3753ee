"""Small tables with everything that is awkward, shared by the operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside, as further columns of the input.
EXTRA = (
    "fp", "text_hash", "hash", "rid", "id", "words", "key", "bucket", "tail", "at", "size", "first", "idx", "sid",
    "taken", "target", "salt", "label", "vector", "class", "n", "score", "lang_pred", "_language", "_words", "_id",
    "_taken", "_copy", "_rank", "_size", "_pseudonyms", "pii_spans", "ids", "decoded", "list", "found", "_row", "_text_hash", "_doc_id", "_found", "_new", "_hash", "_spans",
)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    names = [f"{a}{b}" for a in ("ka", "lo", "mi", "ren", "tu", "vos", "qui", "zal") for b in range(vocabulary // 8)]
    return " ".join(rng.choice(names) for _ in range(n))


def awkward_rows():
    """Nulls in any column, empty, blank and very long texts, copies, near copies, repeated rows."""
    base = prose(1, 300)
    words = base.split(" ")
    near = " ".join([*words[:150], "other", *words[151:]])
    shared = prose(2, 60)
    long_text = prose(3, 30_000)
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "b"),
        (3, near, "en", None),
        (4, None, "en", "a"),
        (5, "", "de", "a"),
        (6, " \t\n ", "de", "c"),
        (7, "one", None, "c"),
        (8, "two words", "fr", None),
        (9, f"{prose(4, 40)} {shared} {prose(5, 40)}", "fr", "a"),
        (10, f"{prose(6, 20)}\n{shared}\t{prose(7, 50)}", "fr", "b"),
        (11, long_text, "en", "a"),
        (11, long_text, "en", "a"),
        (12, "Umlaut ä ß — 日本語 😀 <|endoftext|> it's 3 x", "de", "b"),
        (13, "123 !!! 456", "es", "b"),
        (None, shared, "es", "a"),
        (None, None, None, None),
        (-4, shared + " Tail", "es", "zz"),
        (40, "mail bo.x@host.example.com or +1 (269) 555-3296, card 4524132264652876 on 2024-02-29", "en", "a"),
    ]
    return [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows]


def awkward(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, DOCS)


def with_extra(frame):
    """Columns of clashing names added; their values are wrong on purpose."""
    from pyspark.sql import functions as F

    return frame.withColumns({name: F.lit("clash") for name in EXTRA if name not in frame.columns})


def as_rows(frame, *columns):
    found = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in found.collect()), key=repr)

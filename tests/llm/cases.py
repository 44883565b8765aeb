"""Awkward inputs that every operator has to take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, size int, key string, rep long, mix_no int, host string, score string, value string"
EXTRA = ("x", 1, "k", 9, 3, "h", "s", "v")


def docs(spark, rows):
    """Documents from (doc_id, text, source), with extra columns whose names operators use inside."""
    full = [(i, t, "en", s, len(t or ""), *EXTRA) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


PROSE = " ".join(f"Word{i % 97} of{i % 13} the line{i}." for i in range(60))
AWKWARD = [
    (1, PROSE, "a"), (1, PROSE, "a"), (2, PROSE.upper(), "b"), (None, PROSE, "a"), (3, None, "a"), (4, "", None),
    (5, " \t\n\x0b ", "a"), (6, "single", None), (7, "single", "b"), (8, "two words", "b"), (9, "naïve café — 你好 мир " * 40, None),
    (10, "long " + " ".join(f"w{i}" for i in range(60_000)), "a"), (None, "other words here", None), (11, "x" * 3_000_000, "b"),
]

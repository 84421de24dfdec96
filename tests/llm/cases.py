"""Small tables with the awkward rows every operator must take."""

WORDS = "the and of thing er tion on red blue green sea sky house tree river stone".split()
LONG = " ".join(WORDS[(i * i + i // 7) % len(WORDS)] for i in range(30_000))

ROWS = [
    (0, "The red house, by the sea.", "en", "a"),
    (1, "the  RED house, by the sea.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", ""),
    (4, " \n\t", "xx", "b"),
    (5, LONG, "en", "b"),
    (6, LONG + " end", "en", "b"),
    (7, "éà 漢字 ~~ token = abcdefgh", "fr", "c"),
    (8, "12345 ---", "fr", "c"),
    (8, "12345 ---", "fr", "c"),
    (None, "a row without an id", "en", "c"),
    (None, None, None, None),
    (100, "The red house, by the sea.", "de", "a"),
    (101, "one", "en", "a"),
]

CLASHES = "row string, maybe boolean, digest string, lang_pred string, score string, mix_slot string, _row string, n string"


def documents(spark, rows=None, clashes=False):
    rows = ROWS if rows is None else rows
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c.split()[0]: F.lit("x" if "string" in c else True).cast(c.split()[1]) for c in CLASHES.split(", ")})
    return df


def empty(spark):
    return documents(spark, [])

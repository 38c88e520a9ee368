"""Awkward documents: nulls in every column, empty and long texts, ties, repeated rows, clashing names."""

from pyspark.sql import functions as F

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, row string, gone string, mark string, fp string, k string, h string,"
    " c string, at string, part string, place string, number string, shard string, slot string, ids string, score string, lang_pred string, kept string, n_tokens string,"
    " __key string, __hash string, __row string, __k string, __h string, __words string, __lines string, its_key string, its_row string, its_hash string,"
    " own_words string, own_lines string, __lang_pred string, __lang_score string, __n_removed string"
)
EXTRA = 34
LINE = "this very line stands on many sites"


def rows():
    texts = [
        (1, f"alpha beta gamma delta\n{LINE}\nthe end of one", "en", "a"),
        (2, f"{LINE}\nother words of the second text here", "en", "b"),
        (3, f"{LINE}  \n\n{LINE}\nthird", "en", "c"),
        (4, f"{LINE}", "en", "d"),
        (5, f"x\n{LINE}", "en", "e"),
        (6, None, "en", "a"),
        (7, "", "de", "b"),
        (8, " \t\n", None, "c"),
        (None, "nobody knows the number of this text but it is a text", "en", None),
        (9, "wörter und ▁ sätze der die das über   weiß 한국어 \U0001f600 " + "lang " * 30_000, "de", "a"),
        (10, "same text of a tie\nwith two lines of words", "en", "a"),
        (10, "same text of a tie\nwith two lines of words", "en", "a"),
        (10, "another text of a tie with its own words", None, None),
        (11, "12345 67890 !!! ???", "en", "b"),
        (12, "x" * 50_000, "en", "b"),
    ]
    return [(i, t, l, s, len(t) if t is not None else None, *["clash"] * EXTRA) for i, t, l, s in texts]


def frame(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)


def empty(spark):
    return frame(spark).where(F.lit(False))

"""Documents with everything that operators have to take: nulls, empty and long texts, repeats,
further columns with the names of results."""

import public_tokenizers

PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"word{i % 977} and-{i}" for i in range(40_000))

ROWS = [
    (1, "a short text", "en", "s1"),
    (2, None, None, None),
    (3, "", "en", "s1"),
    (4, "   \n\t ", "fr", "s2"),
    (5, LONG, "en", "s1"),
    (6, LONG + " end", "en", "s2"),
    (7, "repeated row " * 30, "de", "s2"),
    (7, "repeated row " * 30, "de", "s2"),
    (7, "same id, other text " * 30, "de", None),
    (None, "no id at all, but a text of its own " * 10, "en", "s1"),
    (None, None, None, None),
    (8, "ümläut 日本語 𝄞 ▁ <s> \x00 tab\tend", "de", "s3"),
]


def documents(spark, rows=None):
    """The rows with columns in front and behind that are named like results."""
    frame = spark.createDataFrame(
        ROWS if rows is None else rows, "doc_id long, text string, lang string, source string"
    )
    clash = ("n_tokens", "kept", "ord", "size", "toxic", "score", "component", "band", "start", "u")
    return frame.selectExpr(*[f"'x' AS {c}" for c in clash], "*", "length(text) AS n_chars")


def empty(spark):
    return documents(spark).limit(0)


def given(spark, name, scale="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{scale}/{name}.parquet")

"""Small frames with the awkward rows that every operator must take."""
from pyspark.sql import functions as F

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew tea near an old mill"


def edge_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns whose
    names clash with the operators' outputs."""
    long = " ".join(f"word{i % 977} und{i % 31}" for i in range(30_000))
    rows = [(1, WORDS, "en", "a", 10), (2, None, "en", "a", None), (3, "", None, None, 0),
            (4, "   \n\t ", "en", "b", 6), (5, long, "de", "a", len(long)),
            (6, WORDS, "en", "a", 10), (6, WORDS, "en", "a", 10), (None, WORDS + " x", "en", "a", 3),
            (8, "été naïve – “quoted” 東京 Σας \x1f a  b   c \n d", "fr", "c", 40),
            (9, "line one\nline one\nline two\nline one", "en", "b", 30), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", F.lit("x").alias("part"), F.lit(1).alias("_salt"), F.lit(2).alias("ids"),
                     F.lit(3).alias("n_tokens"), F.lit("k").alias("kind"), F.lit(0).alias("grp"))


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")

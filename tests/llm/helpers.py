"""Fixtures of the training-data tests."""

import zlib

import pandas as pd

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ("the of and to in is that it was for on are with as his they be at one have this from or had by hot word but what some "
         "we can out other were all there when up use your how said an each she which do their time if will way about").split()


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def edge_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = " ".join(WORDS[(i * 7 + i // 11) % len(WORDS)] for i in range(60_000))
    text = "the quick brown fox jumps over the lazy dog near the old river bank today"
    return [(1, text, "en", "a", len(text)), (2, None, "en", "a", None), (3, "", None, None, 0), (4, long, "en", "b", len(long)),
            (5, text, "en", "a", len(text)), (5, text, "en", "a", len(text)), (6, " \t\n", "en", None, 3), (7, "12 34 !!", None, "c", 8),
            (8, "école très près du château où vont les élèves", "fr", "b", 45)]


def clashing(df):
    """The same rows with extra columns named like things the operators use."""
    from pyspark.sql import functions as F
    for c in ("size", "key", "id", "score", "shard", "class_id", "block", "kind", "component", "taken", "range", "v",
              "row", "copy", "n", "first", "tie", "chunk", "h", "__clean", "__drop", "__cut_c", "__cut_turn", "__mix_size", "__langid"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("x"))
    return df


def pandas(df, index="doc_id"):
    out = df.toPandas()
    return out.set_index(index).sort_index() if index else out


def documents(sf=SMALL):
    return pd.read_parquet(f"{sf}/documents.parquet").set_index("doc_id").sort_index()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())

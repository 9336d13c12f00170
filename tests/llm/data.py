"""Small tables with every awkward case, and words as the contracts define them."""

import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

SF_DIR = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"shared{i} passage" for i in range(30))  # above 200 bytes
LONG = " ".join(f"Word{i % 977} of {i % 31}" for i in range(30_000))

#: Columns beside those of documents, named as the operators name things inside.
CLASH = ("h", "fp", "n", "size", "bucket", "doc", "node", "a", "k", "component", "rank", "starts", "_id", "_h", "_g", "_of", "_starts", "_text_hash", "_copy", "_whole")

TEXTS = [
    None, "", " \t\n", "one", "one two", "One TWO\x0bthree four five", PASSAGE, PASSAGE, "before it " + PASSAGE + " after it",
    "café 中文 \U0001f600 naïve " * 30, LONG, LONG + " end", "a" * 5000, "x " * 800,
    "the quick brown fox jumps over the lazy dog\n" * 12, " not blank ", "tail  <b>&amp; #1 $2 |",
]


def documents(spark, texts=TEXTS):
    """doc_id 0, 1, ...; a null id, an id with two texts, a row that repeats wholly, a null source, clashing columns."""
    rows = [(i, t, "en", ("web", "books", None, "code")[i % 4], len(t or "")) for i, t in enumerate(texts)]
    if texts:
        rows += [(None, "no id here " * 9, None, None, None), (1, "a second text of this id", "de", "web", 1), rows[-1], rows[min(8, len(rows) - 1)]]
    fields = [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
              StructField("source", StringType()), StructField("n_chars", LongType())]
    fields += [StructField(c, StringType()) for c in CLASH]
    return spark.createDataFrame([r + tuple(f"{c}{i % 3}" for c in CLASH) for i, r in enumerate(rows)], StructType(fields))


def plain(spark, sf_dir, table="documents"):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")

"""Plain forms of what the operators compute, and awkward rows."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: doc_id, text, and extra columns whose names the operators use inside.
SCHEMA = "doc_id long, text string, source string, score double, size int, hits string, n int, cid int, t1 string, _b int"


def awkward(spark, texts):
    """Rows of (id, text) and rows with nulls, empty texts, repeated rows and ids, and clashing extra columns."""
    rows = [(i, t) for i, t in texts]
    rows += [(None, None), (None, ""), (None, "only one"), (1_000_001, ""), (1_000_002, None), (1_000_003, " \n\t ")]
    rows += [(1_000_004, "same row twice, same row twice.")] * 2 + [(1_000_004, "other text")]
    rows += [(1_000_005, "é ü 漢字 " * 40), (1_000_006, "x" * 5000), (1_000_007, "word " * 3000)]
    return spark.createDataFrame([(i, t, "s", 0.5, 1, "h", 2, 3, "t", 4) for i, t in rows], SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def normal(text):
    """Words of letters and digits; Latin-1 capitals in lower case too."""
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text or "")
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", small)


def shingles(text, k=5):
    w = normal(text)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def sample(spark, n, table="documents"):
    df = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
    key = df.columns[0]
    return [tuple(r) for r in df.orderBy(key).limit(n).collect()]

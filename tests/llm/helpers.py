"""Small tables with every awkward case, and plain versions of what operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import duckdb
import xxhash

SF = "/root/testdata/sf0.01"
#: Names that operators use inside or return, here as unrelated columns of the input.
CLASHES = ("id", "key", "row", "x", "n", "p", "f", "size", "kept", "again", "best", "target", "copies", "keep_id", "group_size",
           "fingerprint", "component_id", "score", "spans", "block", "node", "u", "step", "root", "first", "text_sha256", "bucket")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark, extra_texts=()):
    """NULLs in every column, empty, blank and long texts, repeated ids and rows, clashing columns."""
    long = " ".join(f"word{i % 977} thing{i % 31}" for i in range(30_000))
    texts = [None, "", "   \n", "One two three four five", "one TWO three four five", "É one", "é one", long, long, "x", *extra_texts]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "en", "src0", 23), (3, texts[3], "en", "src0", 23), (None, "no id", None, None, None), (None, None, None, None, None), (None, "no id", "en", None, 5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    return frame.withColumns({c: F.lit("clash") for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(columns="doc_id, text", sf=SF, name="documents"):
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{name}.parquet'").fetchall()


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def simhash(text, width=3):
    w = words(ascii_lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def linked(values, near):
    """The smallest of each value's component, by comparing all pairs."""
    values, parent = sorted(values), {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {v: find(v) for v in values}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def grouped(rows, key):
    found = defaultdict(list)
    for r in rows:
        found[key(r)].append(r)
    return found

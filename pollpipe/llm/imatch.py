"""I-Match fingerprints over randomised lexicons of terms within a band of document frequencies."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Band of inverse document frequency, ln(documents / documents with the term).
BAND = (3.0, 25.0)
#: Terms are told apart by this many bits of their hash, which bounds the lexicon.
BITS = 22
#: Each draw gives a random lexicon of each density: a half, a quarter, and so on.
DRAWS, HALVINGS = 4, 12
#: Lexicons, from the sparsest that either text has terms in, on which likeness is judged.
JUDGED = 12
#: The band is judged by only if it holds at least one in so many of a text's terms.
DESCRIBED = 8

_APART = bytes(0x20 if chr(b) in string.punctuation else b for b in range(256))
_SEEDS = np.array([[xxhash.xxh64_intdigest(f"lexicon {d}".encode())] for d in range(DRAWS)], np.uint64)


def terms(text: str) -> np.ndarray:
    """Sorted hashes of the distinct terms: runs without white space and ASCII punctuation, lower-case."""
    words = set(text.lower().encode().translate(_APART).split())
    return np.sort(np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words)))


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND, text: str = "text") -> np.ndarray:
    """Bitmap of the terms (by the leading ``BITS`` bits of their hash) within the band.

    Document frequencies are counted over all rows, in each task first; terms that share
    the leading bits count as one. Only terms of two documents or more can be kept. What comes
    to the driver is one bit per place, half a megabyte whatever the corpus.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for content in batch["text"]:
                seen[np.unique(_places(terms(content)))] += 1
        at = np.flatnonzero(seen)
        for i in range(0, len(at), 1 << 17):
            part = at[i : i + (1 << 17)]
            yield pd.DataFrame({"place": part.astype(np.int32), "n": seen[part]})

    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = texts.mapInPandas(count, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    total = docs.count()
    least, most = max(2.0, total * np.exp(-band[1])), total * np.exp(-band[0])
    place = F.col("place").cast("long") + 1
    bits = (
        counts.where((F.col("n") >= float(least)) & (F.col("n") <= float(most)))
        .groupBy(F.bitmap_bucket_number(place).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    )
    found = np.zeros((1 << BITS) // 8, np.uint8)
    for row in bits.collect():
        own = np.frombuffer(row["bits"], np.uint8)
        at = (row["part"] - 1) * len(own)
        found[at : at + len(own)] = own[: len(found) - at]
    return found


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Numbers of the terms in each draw."""
    mixed = hashes ^ _SEEDS
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return mixed ^ (mixed >> np.uint64(31))


def _drawn(hashes: np.ndarray, mixed: np.ndarray, most: int = DRAWS * HALVINGS) -> str:
    """Hashes of the sets of terms in each randomised lexicon, sparse to dense, until ``most`` have any."""
    parts, found, turned = [""] * (DRAWS * HALVINGS), 0, 0
    for level, h in enumerate(range(HALVINGS, 0, -1)):
        if turned + h > 64:  # the bits are used up; dense lexicons may share some
            turned = 0
        inside = (mixed >> np.uint64(turned)) & np.uint64((1 << h) - 1) == 0
        for d in np.flatnonzero(inside.any(axis=1)):
            if found < most:
                found += 1
                parts[level * DRAWS + d] = f"{xxhash.xxh32_intdigest(hashes[inside[d]].tobytes()) & 0xFFFFFF:06x}"
        if found >= most:
            break
        turned += h
    return ",".join(parts) if found else ""


def fingerprint(text: str, known: np.ndarray) -> str:
    """I-Match fingerprint: a hash of all terms kept, then one for each randomised lexicon, twice.

    The lexicons go from sparse to dense; each contributes the hash of its sorted distinct terms
    that occur in the text, or nothing where none does. A term is in a lexicon of density 1/2^h if h
    bits of its number in the draw are zero, other bits for each density, so that lexicons do not
    hang on the same few terms. The first time they are drawn from the terms in the band; this is left
    out where fewer than one in ``DESCRIBED`` of the text's terms is, as in copies that make up much
    of the corpus. The second time they are drawn from all terms, up to the ``JUDGED``-th that has
    any, as no later one is ever judged. Texts without any term in the band are told apart by all
    their terms, and by themselves if they have no terms.
    """
    every = terms(text)
    at = _places(every)
    inside = (known[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    kept, mixed = every[inside], _mixed(every)
    whole = kept.tobytes() if len(kept) else every.tobytes() or b"text:" + text.encode()
    band = _drawn(kept, mixed[:, inside]) if len(kept) * DESCRIBED >= len(every) else ""
    return f"{xxhash.xxh64_hexdigest(whole)}:{band}:{_drawn(every, mixed, JUDGED)}"


def likeness(a: str, b: str, judged: int = JUDGED) -> float:
    """1 for equal fingerprints; else the share of equal hashes among the first ``judged`` lexicons,
    sparsest first, that have terms in either text (0 if there are none).

    Starting where the lexicons are just dense enough puts short and long texts on one scale: a
    hash of few terms outlives an edit as often in either. Lexicons of the band are judged, or, where
    it says too little of either text, those of all terms (``JUDGED`` at most).
    """
    if a == b:
        return 1.0
    (_, band_a, all_a), (_, band_b, all_b) = a.split(":"), b.split(":")
    if not (band_a and band_b):
        band_a, band_b, judged = all_a, all_b, min(judged, JUDGED)
    pairs = zip(band_a.split(","), band_b.split(","), strict=bool(band_a and band_b))
    first = [x == y for x, y in pairs if x or y][:judged]
    return sum(first) / len(first) if first else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by as many of ``following``, or all it has."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def in_order(docs: DataFrame, doc_id: str, text: str, parts: int) -> DataFrame:
    """``part``, ``tail``, ``id``, ``packed`` (the text, compressed), sorted by id within each part.

    Each part is a range of ids and ends with a copy (``tail``) of the first row of the next part, the
    last with the first of all. The ranges come from approximate quantiles; only their bounds
    and first ids, one each per part, reach the driver. NULL ids come first, equal ids follow
    each other by a hash of the text.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shares = [k / parts for k in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("id", shares, 10_000)).first()[0] if shares else None
    bounds = sorted(set(bounds or []))
    part = F.lit(0) if not bounds else F.coalesce(
        F.size(F.filter(F.array(*(F.lit(b) for b in bounds)), lambda b: b <= F.col("id"))), F.lit(0)
    )
    rows = rows.withColumn("part", part.cast("int"))
    firsts = {
        r["part"]: None if r["none"] else r["first_id"]
        for r in rows.groupBy("part").agg(F.min("id").alias("first_id"), F.max(F.col("id").isNull()).alias("none")).collect()
    }
    filled = sorted(firsts)
    before = {p: filled[i - 1] for i, p in enumerate(filled)}

    @F.pandas_udf(T.BinaryType())
    def packed(texts: pd.Series) -> pd.Series:
        tool = zstandard.ZstdCompressor(level=3)
        return pd.Series([tool.compress(t.encode()) for t in texts], dtype=object)

    is_first, to = F.lit(False), F.lit(0)
    if filled:
        first_of = F.create_map(*(F.lit(x) for p in filled for x in (p, firsts[p])))
        is_first = F.col("id").eqNullSafe(F.element_at(first_of, F.col("part")))
        to = F.element_at(F.create_map(*(F.lit(x) for p in filled for x in (p, before[p]))), F.col("part"))
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("tail"))
    places = F.when(is_first, F.array(own, F.struct(to.alias("part"), F.lit(1).alias("tail")))).otherwise(F.array(own))
    rows = rows.select("id", F.xxhash64("text").alias("h"), packed("text").alias("packed"), places.alias("places"))
    rows = rows.select("id", "h", "packed", F.inline("places"))
    return rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "tail", F.col("id").asc_nulls_first(), "h")


def fingerprints(
    docs: DataFrame, band: tuple[float, float] = BAND, doc_id: str = "doc_id", text: str = "text", parts: int | None = None
) -> DataFrame:
    """Every row of ``docs`` with the fingerprints of its text and of an edited version of it.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``
    and ``near_next``, the likeness of the fingerprint to the edited text's and the next document's.
    The edit replaces the last quarter by the beginning of the next document by id.

    Texts are shuffled once, compressed, into ranges of ids; a task then looks at each text with
    the one after it. NULL texts count as empty; rows with NULL ids come first in order, and
    rows with equal ids follow each other in a fixed order. A lone row is its own next. An empty
    table gives an empty result; other columns do not matter.
    """
    known = lexicon(docs, band, text)
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[doc_id].dataType
    rows = in_order(docs, doc_id, text, parts)
    # Ids travel as text: pandas would turn long ids into floating-point numbers beside a NULL.
    rows = rows.select("part", "tail", F.col("id").cast("string").alias("id"), "packed")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool, last = zstandard.ZstdDecompressor(), None
        for batch in batches:
            out = []
            for part, tail, i, content in zip(batch["part"], batch["tail"], batch["id"], batch["packed"], strict=True):
                if last is not None and (last[0] != part or last[1]):
                    last = None
                if tail and last is None:
                    continue  # one of several first rows of the next part
                now = tool.decompress(content).decode()
                mark = fingerprint(now, known)
                if last is not None:
                    _, _, key, before, own = last
                    changed = edited(before, now)
                    other = fingerprint(changed, known)
                    sha = hashlib.sha256(changed.encode()).hexdigest()
                    out.append((key, len(before), sha, own, other, likeness(own, other), likeness(own, mark)))
                last = (part, tail, i, now, mark)
            yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    schema = "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInPandas(compare, schema).withColumn("doc_id", F.col("doc_id").cast(kind))

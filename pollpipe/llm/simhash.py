"""SimHash near duplicates: a self-join of the binary trie of all fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import FILTER_BITS, flagged, places_of, written
from .components import components

#: Trie depths at which work may be handed out.
DEPTHS = (6, 12, 18, 24, 30, 36, 42, 48, 54, 60, 64)
#: Most fingerprints of a pair of nodes that one task gets; larger pairs are taken a depth deeper.
PAIR_LIMIT = 2_000_000
#: Fingerprints that travel together.
BLOCK = 8192
#: Pairs of nodes that a task looks at in one step.
FRONTIER = 1 << 18


def fingerprint_of(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of the word shingles of ``text``, as an unsigned number.

    A-Z are lower-cased, words are runs without ASCII white space. A bit is 1 if it is set in
    over half the shingles' hashes (XXH64, seed 42), repeats included. Fewer words than
    ``width`` are one shingle; no words give 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < width:
        return xxhash.xxh64_intdigest(joined, 42)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    first, last = starts[: len(words) - width + 1], ends[width - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), 1 << 16):
        spans = zip(first[at : at + (1 << 16)].tolist(), last[at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[x:y], 42) for x, y in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, width: int = 3) -> Column:
    """The fingerprint of a text column as a long (the same 64 bits, signed)."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint_of(t, width) for t in texts], np.uint64)
        return pd.Series(values.view(np.int64))

    return of(text)


def close_pairs(a: np.ndarray, b: np.ndarray, bit: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of all pairs of ``a`` and ``b`` that differ in at most ``budget`` bits.

    Both are sorted, distinct and alike within themselves in all bits from ``bit`` up; the same
    array twice gives each pair of different elements once. Pairs of trie nodes, which are ranges
    of the arrays, are split bit by bit together; a pair goes as soon as the bits in which its
    two paths differ exceed the budget. Works through bounded pieces of the frontier, depth first.
    """
    same = a is b
    start = int(a[0] ^ b[0]) >> bit if len(a) and len(b) else 0
    if not len(a) or not len(b) or start.bit_count() > budget:
        return
    one = lambda x: np.array([x], np.int64)
    stack = [(bit, one(0), one(len(a)), one(0), one(len(b)), one(start.bit_count()))]
    while stack:
        bit, alo, ahi, blo, bhi, far = stack.pop()
        if len(alo) > FRONTIER:
            cut = len(alo) // 2
            parts = (alo, ahi, blo, bhi, far)
            stack += [(bit, *(x[:cut] for x in parts)), (bit, *(x[cut:] for x in parts))]
            continue
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            hit = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                hit &= i != j
            if hit.any():
                yield i[hit], j[hit]
            alo, ahi, blo, bhi, far = (x[~single] for x in (alo, ahi, blo, bhi, far))
        if not len(alo):
            continue
        bit -= 1
        low, high = np.uint64((1 << (bit + 1)) - 1), np.uint64(1 << bit)
        am = np.searchsorted(a, (a[alo] & ~low) | high)
        bm = am if same and alo is blo else np.searchsorted(b, (b[blo] & ~low) | high)
        twin = (alo == blo) & (ahi == bhi) if same else np.zeros(len(alo), bool)
        parts = [
            np.concatenate(x)
            for x in ((alo, am, alo, am), (am, ahi, am, ahi), (blo, bm, bm, blo), (bm, bhi, bhi, bm), (far, far, far + 1, far + 1))
        ]
        left, left_end, right, right_end, far = parts
        keep = (left < left_end) & (right < right_end) & (far <= budget)
        keep[3 * len(twin) :] &= ~twin  # the mirror image of the pair before
        if keep.any():
            stack.append((bit, *(x[keep] for x in (left, left_end, right, right_end, far))))


def join_roots(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root`` (index of each element's smallest known relative) after linking i with j."""
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return root
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (further := root[root]).tobytes() != root.tobytes():
            root = further


def _linker(budget: int):
    """Links within a pair of nodes, as a star around each local group: no more than elements."""

    def link(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        depth, a, b = (int(x) for x in key)
        nodes = {}
        for node, own in rows.groupby("node"):
            nodes[int(node)] = np.sort(np.concatenate([np.asarray(x, np.int64) for x in own["block"]]).view(np.uint64))
        left, right = nodes[a], nodes[b]
        values = left if a == b else np.concatenate([left, right])
        root = np.arange(len(values))
        for i, j in close_pairs(left, left if a == b else right, 64 - depth, budget):
            root = join_roots(root, i, j if a == b else j + len(left))
        moved = np.flatnonzero(root != np.arange(len(values)))
        return pd.DataFrame({"a": values[moved].view(np.int64), "b": values[root[moved]].view(np.int64)})

    return link


def _masks(bits: int, budget: int) -> Column:
    """All patterns of ``bits`` bits with at most ``budget`` ones, as an array of (mask, ones)."""
    found = [0]
    for _ in range(budget):
        found = sorted({m | 1 << k for m in found for k in range(bits)} | set(found))
    return F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m.bit_count()).alias("ones")) for m in found))


def _prefix(value: Column, depth: int) -> Column:
    return F.shiftrightunsigned(value, 64 - depth) if depth < 64 else value


def node_pairs(values: DataFrame, budget: int, limit: int = PAIR_LIMIT) -> list[tuple[int, DataFrame, DataFrame]]:
    """Pairs of trie nodes within the budget, by depth, each with no more than ``limit`` values.

    ``values`` has the distinct fingerprints ``f``. For each depth: pairs ``a``, ``b`` and the
    sizes of the nodes (``node``, ``n``). Pairs that hold more values are replaced by the pairs
    of their children, with what is left of the budget; node meets node by equality of the
    flipped prefix, never all with all.
    """
    found, above, done = [], None, 0
    for depth in DEPTHS:
        nodes = written(values.groupBy(_prefix(F.col("f"), depth).alias("node")).agg(F.count("*").alias("n")), "trie-nodes")
        step = depth - done
        masks = F.explode(_masks(step, budget))
        mine = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"))
        if above is None:
            pairs = mine.select("a", "na", masks.alias("m")).select(
                "a", "na", F.col("a").bitwiseXOR(F.col("m.mask")).alias("b"), F.col("m.ones").alias("ones")
            ).where("a <= b")
        else:
            parent = F.shiftrightunsigned(F.col("a"), step)
            heirs = above.join(mine, above.up_a == parent).select("up_a", "up_b", "ones", "a", "na", masks.alias("m"))
            low = F.col("a").bitwiseAND(F.lit((1 << step) - 1)).bitwiseXOR(F.col("m.mask"))
            pairs = heirs.where(F.col("ones") + F.col("m.ones") <= budget).select(
                "a", "na", F.shiftleft(F.col("up_b"), step).bitwiseOR(low).alias("b"),
                (F.col("ones") + F.col("m.ones")).alias("ones"), (F.col("up_a") == F.col("up_b")).alias("twins"),
            ).where("not twins or a <= b")
        theirs = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"))
        pairs = written(pairs.join(theirs, "b").select("a", "b", "ones", "na", "nb"), "trie-pairs")
        large = (F.when(F.col("a") == F.col("b"), F.col("na")).otherwise(F.col("na") + F.col("nb")) > limit) & F.lit(depth < 64)
        found.append((depth, pairs.where(~large).select("a", "b"), nodes))
        above = pairs.where(large).select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), "ones")
        done = depth
        if above.isEmpty():
            break
    return found


def near_links(values: DataFrame, budget: int = 2, limit: int = PAIR_LIMIT) -> DataFrame:
    """Links ``a``, ``b`` that join all fingerprints ``f`` at ``budget`` or fewer differing bits.

    Not every such pair is returned, but enough of them, or pairs joined by them, that the
    connected components are exactly those of all pairs.
    """
    links = None
    for depth, pairs, nodes in node_pairs(values, budget, limit):
        blocks = F.ceil(F.col("n") / BLOCK)
        packed = (
            values.select("f", _prefix(F.col("f"), depth).alias("node"))
            .join(nodes, "node")
            .groupBy("node", F.pmod(F.xxhash64("f"), blocks).alias("salt"))
            .agg(F.collect_list("f").alias("block"))
        )
        ends = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("node"))
        found = (
            packed.join(ends, "node")
            .select(F.lit(depth).alias("depth"), "a", "b", "node", "block")
            .groupBy("depth", "a", "b")
            .applyInPandas(_linker(budget), "a long, b long")
        )
        links = found if links is None else links.unionAll(found)
    return links


def simhash_groups(
    docs: DataFrame,
    width: int = 3,
    budget: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    limit: int = PAIR_LIMIT,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """Every row of ``docs`` with its fingerprint and the component it is linked into.

    Columns: ``doc_id``, ``fingerprint`` (long), ``component_id``, the smallest id reachable
    over links of ``budget`` or fewer differing bits, ``first`` (whether the row is the one of its
    component that stays), and the columns named in ``keep``.

    Equal fingerprints are one node, so copies cost nothing beyond their own row. Rows that are
    alone in their component are told by a filter of bounded size over the fingerprints of larger
    components and stay where they are; only the others, and those that share a place with them, are
    shuffled with what they ``keep``. Texts that are
    NULL, empty or blank have fingerprint 0 and link like any other. Repeated rows are rows of
    their own. A NULL id is no smallest id unless the component has no other; ``first`` is the row with
    the smallest id and, where ids repeat or are NULL, any single one of those. Empty tables
    give empty results; other columns do not matter.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), width).alias("f"),
        F.struct(F.lit(None).alias("_"), *(F.col(f"`{c}`") for c in keep)).alias("kept"),
    )
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "simhash-rows")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")
    values = written(rows.groupBy("f").agg(best, F.count("*").alias("n")), "simhash-values")
    links = written(near_links(values.select("f"), budget, limit), "simhash-links")
    nodes = components(links).withColumnRenamed("node", "f")
    values = values.join(nodes, "f", "left").select("f", F.coalesce("root", "f").alias("root"), "best", "n")
    roots = values.groupBy("root").agg(F.min("best").alias("best"), F.sum("n").alias("size"))
    labels = written(values.select("f", "root").join(roots, "root").select("f", "best", "size"), "simhash-labels")
    places = places_of(labels.where("size > 1").select("f"), "simhash-together", bits)
    rows = flagged(rows, ("f",), places, "together", bits)
    alone = rows.where("not together").withColumn("component_id", F.col("doc_id")).withColumn("first", F.lit(True))
    found = rows.where("together").join(labels, "f")
    found = found.withColumn("component_id", F.col("best.doc_id")).withColumn("first", F.col("row") == F.col("best.row"))
    columns = ("doc_id", F.col("f").alias("fingerprint"), "component_id", "first", *(F.col(f"kept.`{c}`").alias(c) for c in keep))
    return alone.select(*columns).unionAll(found.select(*columns))

"""Embedding near duplicates: learned binary codes, Hamming tables over their parts, exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few, written
from .components import components

#: Components (rows times length) of the sample on which codes are learned.
SAMPLE_VALUES = 1 << 20
#: Rows that a table's bucket should hold on average; more rows give longer bucket keys.
BUCKET_ROWS = 1024
#: Rows of a bucket that travel together; larger buckets are compared block against block.
BLOCK = 16_384
#: Share of pairs exactly at the threshold that the tables must retrieve.
RECALL = 0.99
#: Tables after which centred codes are given up for codes about the origin.
MOST_CENTRED = 48
#: Rows of one side that are compared at a time.
TILE = 512


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, without overflow; rows of zeros stay."""
    x = np.asarray(x, np.float64)
    top = np.abs(x).max(axis=1, keepdims=True, initial=0)
    x = x / np.where(top > 0, top, 1)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def learn_rotation(x: np.ndarray, rng: np.random.Generator, rounds: int = 25) -> np.ndarray:
    """A rotation under which the rows of ``x`` lie close to the corners of a cube (iterative quantisation).

    Starting from a random rotation, codes are the signs of the rotated rows, then the rotation
    becomes the one that brings the rows nearest to their codes, and so on.
    """
    turn = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
    for _ in range(rounds if len(x) else 0):
        u, _, v = np.linalg.svd(x.T @ np.where(x @ turn >= 0, 1.0, -1.0))
        turn = u @ v
    return turn


@dataclass(frozen=True)
class Codes:
    """Learned codes: ``tables`` parts of ``width`` bits; pairs more than ``budget`` bits apart are no candidates."""

    centre: np.ndarray
    turns: np.ndarray
    width: int
    tables: int
    budget: int

    def parts(self, x: np.ndarray) -> np.ndarray:
        """The parts of each row's code as numbers, one column per table."""
        return _parts(_bits(x - self.centre, self.turns), self.width)[:, : self.tables]


def _bits(x: np.ndarray, turns: np.ndarray) -> np.ndarray:
    return x @ turns >= 0


def _parts(bits: np.ndarray, width: int) -> np.ndarray:
    whole = bits.shape[1] // width
    values = bits[:, : whole * width].reshape(len(bits), whole, width)
    return (values << np.arange(width, dtype=np.uint32)).sum(axis=2, dtype=np.uint32)


def _partners(x: np.ndarray, cosine: float, rng: np.random.Generator) -> np.ndarray:
    """For each unit row a unit row in a random direction at exactly the given cosine."""
    if x.shape[1] < 2:
        return x
    other = rng.standard_normal(x.shape)
    other = unit(other - (other * x).sum(axis=1, keepdims=True) * x)
    return cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * other


def learn(sample: np.ndarray, width: int, cosine: float, recall: float = RECALL, seed: int = 0) -> Codes:
    """Codes for unit vectors like those of ``sample``, with tables for the wanted recall.

    The sample is centred, which balances the bits, and rotations are learned until as many
    parts of ``width`` bits stand side by side that ``recall`` of pairs made exactly at the
    threshold share at least one. Where the sample lies so far to one side that centring tears such
    pairs apart, codes are learned about the origin instead.
    """
    for centred in (True, False):
        rng = np.random.default_rng(seed)
        centre = sample.mean(axis=0) if centred and len(sample) else np.zeros(sample.shape[1])
        mine = sample[:: max(1, len(sample) // 4000)]
        theirs = _partners(mine, cosine, rng)
        turns = np.zeros((sample.shape[1], 0))
        while True:
            turns = np.concatenate([turns, learn_rotation(sample - centre, rng)], axis=1)
            a, b = _bits(mine - centre, turns), _bits(theirs - centre, turns)
            met = np.maximum.accumulate(_parts(a, width) == _parts(b, width), axis=1).mean(axis=0) if len(mine) else np.ones(turns.shape[1] // width)
            enough = np.flatnonzero(met >= recall)
            if len(enough):
                tables = int(enough[0]) + 1
                apart = (a[:, : tables * width] != b[:, : tables * width]).sum(axis=1)
                budget = int(np.quantile(apart, 0.9995)) + 1 if len(apart) else tables * width
                return Codes(centre, turns[:, : tables * width], width, tables, budget)
            if centred and len(met) > MOST_CENTRED:
                break


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of every row of ``a`` (n, words) with every row of ``b``."""
    far = np.zeros((len(a), len(b)), np.uint16)
    for w in range(a.shape[1]):
        far += np.bitwise_count(a[:, w, None] ^ b[None, :, w])
    return far


def linked_pairs(
    x: np.ndarray, y: np.ndarray, xp: np.ndarray, yp: np.ndarray, table: int, budget: int, cosine: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows with at least the cosine that this table is the first to bring together.

    ``x``, ``y`` are unit rows, ``xp``, ``yp`` the parts of their codes, alike in ``table``; the same
    array twice gives each pair once. Pairs beyond the code budget are no candidates; those
    left are judged by their vectors, a whole tile at once where most of it is left.
    """
    same = x is y
    words = lambda p: np.ascontiguousarray(np.pad(p, ((0, 0), (0, p.shape[1] % 2)))).view(np.uint64)
    xw, yw = words(xp), words(yp)
    for at in range(0, len(x), TILE):
        upto = at + TILE
        start = at if same else 0
        i, j = np.nonzero(hamming(xw[at:upto], yw[start:]) <= budget)
        if same:
            later = j > i
            i, j = i[later], j[later]
        if not len(i):
            continue
        if len(i) > 0.05 * len(x[at:upto]) * len(y[start:]):
            value = (x[at:upto] @ y[start:].T)[i, j]
            near = value >= cosine
        else:
            near = np.einsum("ij,ij->i", x[at + i], y[start + j]) >= cosine
        i, j = at + i[near], start + j[near]
        first = np.ones(len(i), bool)
        for t in range(table):
            first &= xp[i, t] != yp[j, t]
        if first.any():
            yield i[first], j[first]


def join_roots(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give the ends of all pairs i, j, and what is joined to them, one common smallest ``root``, in place."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def _matcher(codes: Codes, cosine: float):
    """Links of a bucket, or of two of its blocks: their number per row, and a star per local group."""

    def match(key: tuple, rows: pa.Table) -> pa.Table:
        table, _, a, b = (k.as_py() for k in key)
        rows = rows.combine_chunks()
        of = lambda c: rows.column(c).combine_chunks()
        n = rows.num_rows
        x = unit(of("e").flatten().to_numpy(zero_copy_only=False).reshape(n, -1))
        parts = np.frombuffer(b"".join(of("code").to_pylist()), np.uint32).reshape(n, -1)
        node, copies = of("node").to_numpy(), of("copies").to_numpy()
        left = np.flatnonzero(of("block").to_numpy() == a)
        right = left if a == b else np.flatnonzero(of("block").to_numpy() == b)
        xl, pl = x[left], parts[left]
        xr, pr = (xl, pl) if a == b else (x[right], parts[right])
        links, root = np.zeros(n, np.int64), np.arange(n)
        for i, j in linked_pairs(xl, xr, pl, pr, table, codes.budget, cosine):
            i, j = left[i], right[j]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            join_roots(root, i, j)
        some = np.flatnonzero(links)
        return pa.table({"node": pa.array(node[some], pa.int64()), "links": pa.array(links[some], pa.int64()), "root": pa.array(node[root[some]], pa.int64())})

    return match


def comparable(embedding: Column) -> Column:
    """Whether a vector has a direction: not NULL, all components finite, not all of them zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(F.forall(embedding, finite) & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matches(nodes: DataFrame, dims: int, n: int, cosine: float, block: int, recall: float) -> DataFrame:
    """``node``, ``links``, ``root`` found among ``n`` vectors ``e`` of length ``dims``, over all tables."""
    rows = max(2, SAMPLE_VALUES // dims)
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(rows).select("e").collect()
    width = min(24, max(4, math.ceil(math.log2(max(1, n / BUCKET_ROWS)))))
    codes = learn(unit(np.array([r["e"] for r in sample], np.float64)), width, cosine, recall)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(batch.column("e").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
            parts = codes.parts(x)
            buckets = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * codes.tables, pa.int32()), pa.array(parts.ravel().astype(np.int32)))
            code = pa.array([p.tobytes() for p in np.ascontiguousarray(parts)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, buckets, code], [*batch.schema.names, "buckets", "code"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    coded = written(nodes.mapInArrow(encode, f"{fields}, buckets array<int>, code binary"), "itq-codes")
    sizes = coded.select(F.posexplode("buckets").alias("t", "bucket")).groupBy("t", "bucket").agg(F.count("*").alias("n"))
    large = written(sizes.where(F.col("n") > block).select("t", "bucket", F.ceil(F.col("n") / block).alias("blocks")), "itq-large")
    placed = coded.select("node", "copies", "e", "code", F.posexplode("buckets").alias("t", "bucket"))
    if large.isEmpty():
        placed = placed.withColumn("blocks", F.lit(1).cast("long"))
    else:
        placed = placed.join(F.broadcast(large) if few(large) else large, ["t", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    placed = placed.withColumn("block", own).withColumn("other", other)
    placed = placed.select("node", "copies", "e", "code", "block", "t", "bucket", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    return placed.groupBy("t", "bucket", "x", "y").applyInArrow(_matcher(codes, cosine), "node long, links long, root long")


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.9,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block: int = BLOCK,
    recall: float = RECALL,
) -> DataFrame:
    """Every row of ``vectors`` with ``n_links`` and ``component_id``.

    ``n_links`` counts the other vectors found at ``cosine`` or more, ``component_id`` is the smallest id
    reachable over such links, the row's own included.

    Equal vectors become one node with their number, so copies cost nothing beyond their own row and
    all count as linked. Codes are learned on a sample of ``SAMPLE_VALUES`` components, then every node
    is filed under each part of its code. Only nodes that share a whole part are compared, and only
    if their codes are within a budget; cosines are of the vectors themselves, in double precision,
    so no link is below the threshold. The number of tables is chosen so that ``recall`` of pairs exactly at
    the threshold meet; closer pairs meet more often. A pair counts in the first table
    that brings it together, so links are added up without listing pairs. A bucket of more
    than ``block`` nodes is cut and compared block against block, all of it. The work on a group of
    different vectors that all link is the square of its size, as in counting links it must be.

    Vectors that are NULL, empty, zero, or hold a NULL or non-finite component have no links and
    are components of their own. Vectors of different lengths never link; each length is a search
    of its own. Rows with a NULL id take part; their component has no id if no row in it has one.
    Repeated ids are rows of their own. An empty table gives an empty result.
    """
    key = [F.xxhash64("e", F.lit(seed)).alias(f"k{seed}") for seed in (1, 2)]
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("e"))
    rows = rows.withColumn("e", F.when(comparable(F.col("e")), F.col("e")))
    rows = written(rows.select("vec_id", "e", *key, F.size("e").alias("dims"), F.monotonically_increasing_id().alias("row")), "itq-rows")
    whole = rows.where("e is not null")
    groups = whole.groupBy("dims", "k1", "k2").agg(F.min("row").alias("node"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    groups = written(groups, "itq-groups")
    nodes = whole.select("row", "e").join(groups.select(F.col("node").alias("row"), "dims", "copies"), "row")
    nodes = written(nodes.select(F.col("row").alias("node"), "dims", "copies", "e"), "itq-nodes")
    links = None
    for r in groups.groupBy("dims").count().where("count > 1").collect():
        own = nodes.where(F.col("dims") == r["dims"]).select("node", "copies", "e")
        found = matches(own, r["dims"], r["count"], cosine, block, recall)
        links = found if links is None else links.unionAll(found)
    groups = groups.select("dims", "k1", "k2", "node", "copies", "least")
    if links is None:
        labels = groups.withColumns({"links": F.lit(0).cast("long"), "best": F.col("least")})
    else:
        links = written(links, "itq-links")
        roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b"))
        counts = links.groupBy("node").agg(F.sum("links").alias("links"))
        labels = groups.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        labels = written(labels, "itq-labels")
        best = labels.groupBy("root").agg(F.min("least").alias("best"))
        labels = labels.join(best, "root")
    labels = labels.select("dims", "k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "best")
    linked = whole.select("vec_id", "dims", "k1", "k2").join(labels, ["dims", "k1", "k2"]).select("vec_id", "n_links", F.col("best").alias("component_id"))
    alone = rows.where("e is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone)

"""Clustering, near duplicates of embeddings, and resampling, against plain versions."""

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pollpipe.llm import QUERIES, itq, orchard, resample

from helpers import SF, awkward, documents, empty, linked

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    frame = spark.createDataFrame([(i, e, 0) for i, e in rows], VECTORS)
    return frame.withColumns({c: F.lit("clash") for c in ("node", "row", "k1", "e", "x", "n", "links", "root", "block", "cluster", "distance", "t", "bucket")})


def odd_vectors(dims):
    """NULL, empty, short, long, zero, NULL and non-finite components; copies; a repeated id; no id."""
    one = [1.0] + [0.0] * (dims - 1)
    two = [0.0, 2.0] + [0.0] * (dims - 2)
    near = [1.0, 0.1] + [0.0] * (dims - 2)
    rows = [(1, None), (2, []), (3, [0.0] * dims), (4, [1.0, None] + [0.0] * (dims - 2)), (5, [float("nan")] + one[1:])]
    rows += [(6, [float("inf")] + one[1:]), (7, one[:-1]), (8, one), (9, one), (9, two), (None, two), (10, near), (10, near), (11, [-v for v in one])]
    return rows + [(12, [1e30] + [0.0] * (dims - 1))]


# --- centroid clustering ---


def plain_clusters(rows, k, rounds, dims, seed=3, scale=1024):
    kept = [(i, [math.floor(min(max(scale * v, -(1 << 23)), 1 << 23)) for v in e]) for i, e in rows
            if e is not None and len(e) == dims and all(v is not None and math.isfinite(v) for v in e)]
    seeds = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:k]
    centres = [x for _, x in seeds]

    def assign():
        found = []
        for i, x in kept:
            d, c = min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), c) for c, y in enumerate(centres))
            found.append((i, x, c, d))
        return found

    for _ in range(rounds):
        found = assign()
        for c in range(len(centres)):
            own = [x for _, x, o, _ in found if o == c]
            if own:
                centres[c] = [sum(v) // len(own) for v in zip(*own, strict=True)]
    return sorted([(i is None, i or 0, c, d) for i, _, c, d in assign()]), centres


def test_clusters_of_odd_vectors_are_those_of_the_plain_version(spark):
    rng = np.random.default_rng(1)
    rows = odd_vectors(4) + [(100 + i, rng.normal(size=4).astype("float32").tolist()) for i in range(200)]
    found, centres = orchard.cluster(vectors(spark, rows), k=5, rounds=4, dims=4)
    plain, wanted = plain_clusters(rows, 5, 4, 4)
    assert centres == wanted
    assert sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance) for r in found.collect()) == plain


@pytest.mark.parametrize("k", [1, 2, 7, 60])
def test_orchard_finds_the_nearest_with_ties_to_the_smaller_number(k):
    rng = np.random.default_rng(k)
    centres = rng.integers(-3, 4, size=(k, 2))  # many equal centroids and equal distances
    points = rng.integers(-5, 6, size=(500, 2))
    own, far = orchard.nearest(points, centres, *orchard.neighbour_lists(centres))
    all_far = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (own == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()


def test_orchard_looks_at_few_centroids(monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.integers(-10_000, 10_000, size=(400, 2))
    points = centres[rng.integers(0, 400, 300)] + rng.integers(-50, 50, size=(300, 2))
    order, gaps = orchard.neighbour_lists(centres)
    looked = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                looked.append(len(key))
            return np.asarray(super().__getitem__(key))

    orchard.nearest(points, centres.view(Counted), order, gaps)
    assert sum(looked) < 0.5 * 300 * 400


def test_clusters_with_few_or_no_vectors(spark):
    found, centres = orchard.cluster(vectors(spark, odd_vectors(4)[:2]), dims=4)
    assert found.count() == 0 and centres == [] and found.columns == ["vec_id", "cluster", "distance"]
    found, centres = orchard.cluster(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), k=8, dims=2)
    assert centres == [[1024, 2048]] * 2 and {r.cluster for r in found.collect()} == {0}
    found, centres = orchard.cluster(vectors(spark, [(None, [1.0, 2.0])]), k=8, dims=2)
    assert found.count() == 0
    huge = orchard.with_inertia(orchard.cluster(vectors(spark, [(i, [(-1.0) ** i * 3e38] * 64) for i in range(40)]), k=1)[0])
    assert {r.inertia for r in huge.collect()} == {40 * 64 * (1 << 46)}


# --- near duplicates ---


def plain_links(rows, cosine=0.9):
    usable = {}
    for n, (_, e) in enumerate(rows):
        if e and all(v is not None and math.isfinite(v) for v in e) and any(e):
            usable[n] = itq.unit(np.array([e], np.float32))[0]
    near = lambda a, b: len(usable[a]) == len(usable[b]) and float(usable[a] @ usable[b]) >= cosine
    root = linked(usable, near)
    links = {a: sum(near(a, b) for b in usable if b != a) for a in usable}
    least = {}
    for n, r in root.items():
        i = rows[n][0]
        if i is not None:
            least[r] = min(least.get(r, i), i)
    out = [(rows[n][0], links[n], least.get(r)) for n, r in root.items()]
    return sorted(map(str, out + [(i, 0, i) for n, (i, _) in enumerate(rows) if n not in usable]))


def test_near_duplicates_of_odd_vectors(spark):
    rows = odd_vectors(4) + [(20, [1.0, 0.05, 0.0]), (21, [1.0, 0.0, 0.0]), (22, [5.0]), (23, [7.0]), (24, [-1.0])]
    found = itq.near_duplicates(vectors(spark, rows), recall=1.0)
    assert sorted(str((r.vec_id, r.n_links, r.component_id)) for r in found.collect()) == plain_links(rows)


@pytest.mark.parametrize("block", [64, itq.BLOCK])
def test_groups_of_near_copies_are_counted_whole_in_blocks(spark, block):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 32))
    hot = base[0] + 0.01 * rng.normal(size=(400, 32))  # all link with each other
    chain = [base[1]]
    for _ in range(20):
        chain.append(itq._partners(itq.unit(np.array([chain[-1]])), 0.93, rng)[0])
    rows = [(i, e.astype("float32").tolist()) for i, e in enumerate([*base, *hot, *chain])] + [(5000 + i, [2.0] * 32) for i in range(300)]
    found = itq.near_duplicates(vectors(spark, rows), block=block, recall=0.999)
    assert sorted(str((r.vec_id, r.n_links, r.component_id)) for r in found.collect()) == plain_links(rows)


def test_links_are_exact_and_recall_holds_at_the_threshold(spark):
    rng = np.random.default_rng(6)
    base = itq.unit(rng.normal(size=(1500, 48)) * np.linspace(2, 0.3, 48) + 0.2)
    near = itq._partners(base, 0.9001, rng)
    under = itq._partners(base, 0.8999, rng)
    x = np.concatenate([base, near, under])
    rows = [(i, e.tolist()) for i, e in enumerate(x)]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in itq.near_duplicates(wide).collect()}
    u = itq.unit(x)
    true = (u @ u.T >= 0.9).sum(axis=1) - 1
    assert all(found[i] <= true[i] for i in found)
    assert sum(found.values()) >= 0.95 * true.sum()


def test_codes_far_from_the_origin_keep_their_recall(spark):
    rng = np.random.default_rng(7)
    x = 1 + 0.02 * rng.normal(size=(300, 16))  # one tight bundle: all pairs link
    found = itq.near_duplicates(spark.createDataFrame([(i, e.tolist()) for i, e in enumerate(x)], "vec_id long, embedding array<double>"))
    counts = [r.n_links for r in found.collect()]
    assert sum(counts) >= 0.95 * 300 * 299 and {r.component_id for r in found.collect()} == {0}


def test_near_duplicates_of_nothing(spark):
    nothing = spark.createDataFrame([], VECTORS)
    assert itq.near_duplicates(nothing).count() == 0
    assert [tuple(r) for r in itq.near_duplicates(vectors(spark, [(3, [1.0, 2.0])])).collect()] == [(3, 0, 3)]


def test_near_duplicates_recall_on_a_larger_table(spark):
    path = "/root/testdata/check_s/embeddings.parquet"
    try:
        rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{path}/*.parquet'").fetchall()
    except duckdb.IOException:
        rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/../sf0.1/embeddings.parquet'").fetchall()
        path = f"{SF}/../sf0.1/embeddings.parquet"
    u = itq.unit(np.array([e for _, e in rows], np.float32))
    true = {}
    for at in range(0, len(u), 1000):
        for (i, _), n in zip(rows[at : at + 1000], (u[at : at + 1000] @ u.T >= 0.9).sum(axis=1) - 1, strict=True):
            true[i] = int(n)
    found = {r.vec_id: r.n_links for r in itq.near_duplicates(spark.read.parquet(path)).collect()}
    assert found.keys() == true.keys() and all(found[i] <= true[i] for i in true)
    assert sum(found.values()) >= 0.99 * sum(true.values())


def test_rotation_brings_rows_nearer_to_their_codes():
    rng = np.random.default_rng(8)
    corners = np.where(rng.random((12, 8)) < 0.5, -1.0, 1.0)
    turn = np.linalg.qr(rng.standard_normal((8, 8)))[0]
    x = (corners[rng.integers(0, 12, 2000)] + 0.05 * rng.standard_normal((2000, 8))) @ turn
    loss = lambda r: float(((np.where(x @ r >= 0, 1.0, -1.0) - x @ r) ** 2).sum())
    learned = min(loss(itq.learn_rotation(x, np.random.default_rng(s), 50)) for s in range(5))
    assert learned < 0.5 * loss(np.linalg.qr(np.random.default_rng(0).standard_normal((8, 8)))[0])


# --- importance resampling ---


def plain_resample(docs, target, buckets=10_000, longest=1, least=20, percent=10):
    def features(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(f.encode()) % buckets for f in runs]

    own = [(i, *features(t)) for i, t in docs]
    raw, aim = [0] * buckets, [0] * buckets
    for _, _, found in own:
        for b in found:
            raw[b] += 1
    for t in target:
        for b in features(t)[1]:
            aim[b] += 1
    s, t = sum(raw) + buckets, sum(aim) + buckets
    gain = [math.floor(1000 * math.log((aim[b] + 1) * s / ((raw[b] + 1) * t))) for b in range(buckets)]
    rows = []
    for i, n, found in own:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2], r[3]))
    drawn = order[: len(order) * percent // 100]
    ranks = [(i, n, w, sc, k) for k, (i, _, n, w, sc) in enumerate(drawn, 1)]
    rest = [(i, n, w, sc, None) for i, _, n, w, sc in order[len(drawn) :]] + [(i, n, w, sc, None) for i, m, n, w, sc in rows if m < least]
    return sorted(map(str, ranks + rest))


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_is_that_of_the_plain_version(spark, longest):
    docs = documents()[:300]
    target = [t for _, t in documents("item_id, text", name="benchmark")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    aim = spark.createDataFrame([(t,) for t in target] + [(None,), ("",)], "text string")
    found = resample.resample(frame, aim, longest=longest, buckets=997)
    assert sorted(str(tuple(r)) for r in found.collect()) == plain_resample(docs, [*target, None, ""], buckets=997, longest=longest)


def test_resampling_of_awkward_rows(spark):
    extra = ["\x00\x7f`A9é日本 x_y--Z", "ſİK word " * 30, "é \U0001f600 tail " * 25]
    frame = awkward(spark, extra)
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    found = resample.resample(frame, frame.limit(0), percent=50)
    assert sorted(str(tuple(r)) for r in found.collect()) == plain_resample(rows, [], percent=50)


def test_resampling_of_nothing(spark):
    assert resample.resample(empty(spark), empty(spark)).count() == 0
    found = resample.resample(awkward(spark), empty(spark), least_words=10**9)
    assert {r["rank"] for r in found.collect()} == {None}


def test_the_registered_queries_return_whole_tables(spark):
    for name, source in {"op11_orchard": "embeddings", "op12_importance": "documents", "op13_itq": "embeddings"}.items():
        rows = duckdb.sql(f"SELECT count(*) FROM '{SF}/{source}.parquet'").fetchall()[0][0]
        assert QUERIES[name](spark, SF).count() == rows


def test_resampling_works_on_few_rows_at_a_time():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1000))})
    found = list(resample.pieces(iter([batch, batch.slice(0, 0), batch.slice(0, 10)])))
    assert max(p.num_rows for p in found) <= 256
    assert [i for p in found for i in p.column("doc_id").to_pylist()] == [*range(1000), *range(10)]

"""The registered queries: each applies one operator, with production parameters, to its table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import chat_turns
from .common import ascii_lower, fresh, table, written
from .exact import exact_groups
from .imatch import fingerprints
from .itq import near_duplicates
from .mix import longer_likelier, mix
from .orchard import cluster, with_inertia
from .packing import pack, tokenize
from .quality import quality
from .registry import query
from .resample import resample
from .runindex import remove_repeats
from .secret_scan import scan, spans_text
from .simhash import simhash_groups
from .warc import page_of, read_warc, write_warc

#: Vocabulary of the public byte-level tokenizer, as installed.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select(
        page_of(F.col("record_id")).cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), page_of(F.col("refers_to")).cast("long").alias("refers_to"),
    )


@query()
def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokenize(table(spark, sf_dir, "documents"), tokenizer_path())
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(written(pieces, "pieces"))


@query(
    """
    WITH n AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    ), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
    FROM n JOIN g USING (t)
    """
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = ascii_lower(F.coalesce("text", F.lit("")))
    return exact_groups(table(spark, sf_dir, "documents"), carry={"text_sha256": F.sha2(content, 256)})


@query(
    r"""
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
            (('0x' || left(md5('7|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 13))::BIGINT::DOUBLE + 0.5)
                / 4503599627370496.0 AS u
        FROM documents
    ), s AS (
        SELECT source, sum(size)::BIGINT AS source_size,
            [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w
        FROM d GROUP BY source
    ), l AS (
        SELECT *, source_size * 2.0::DOUBLE AS lim, source_size * 2.0::DOUBLE / w AS level,
            sum(source_size) OVER () * 1.5::DOUBLE AS total, sum(w) OVER () AS all_w
        FROM s
    ), c AS (
        SELECT *, sum(lim) OVER upto + level * (all_w - sum(w) OVER upto) <= total AS cut
        FROM l WINDOW upto AS (ORDER BY level RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ), t AS (
        SELECT source, source_size, CASE WHEN cut THEN lim ELSE w * ((total
            - coalesce(sum(lim) FILTER (WHERE cut) OVER (), 0.0)) / sum(w) FILTER (WHERE NOT cut) OVER ()) END AS target
        FROM c
    ), r AS (
        SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    ), p AS (
        SELECT *, least(floor(ratio), 2)::BIGINT AS whole, ratio - least(floor(ratio), 2) AS part FROM r
    ), q AS (
        SELECT *, CASE WHEN part > 0 THEN (u / (1 - u)) / (((size + 1) / (size + 100.0::DOUBLE)) * (part / (1 - part))) END AS k FROM p
    ), o AS (
        SELECT *, sum(size) OVER (PARTITION BY source, part > 0 ORDER BY k / (1 + k), u, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0 AS middle
        FROM q
    )
    SELECT doc_id, size, source_size, target,
        (size * (whole + CASE WHEN part > 0 AND middle <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM o
    """
)
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longer documents are likelier to be taken once more than their source's whole copies."""
    mixed = mix(table(spark, sf_dir, "documents"), odds=longer_likelier)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


@query()
def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


@query()
def op6_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, b: a + b)
    return found.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


@query()
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"),
    )


@query(
    r"""
    WITH d AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
    p AS (
        SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS turns,
            string_agg(coalesce('r' || role, '-') || chr(1) || coalesce('t' || text, '-'), chr(2)) OVER w AS prefix
        FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ), e AS (SELECT prefix, min(conv_id) AS conv_id, count(*) AS copies FROM p WHERE place = turns GROUP BY prefix),
    k AS (SELECT * FROM e WHERE prefix NOT IN (SELECT prefix FROM p WHERE place < turns))
    SELECT p.conv_id, place, turns, copies, coalesce(role, 'user') AS role,
        '<|im_start|>' || coalesce(role, 'user') || chr(10)
            || regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '< |\1| >', 'g') || '<|im_end|>' || chr(10) AS rendered
    FROM p JOIN k USING (conv_id)
    """
)
def op10_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_turns(table(spark, sf_dir, "conversations"))


def _clustering_sql(k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3, scale: int = 1024) -> str:
    """One step of SQL per round: distances to all centroids, the nearest, floors of the means."""
    far = "list_sum(list_transform(range(1, {d} + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT".format(d=dims)
    steps = [f"""
    WITH v AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS x FROM embeddings
        WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    ), c0 AS MATERIALIZED (
        SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1)::INT AS cluster, x AS c
        FROM v QUALIFY cluster < {k}
    )"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
        SELECT vec_id, x, cluster, distance FROM (SELECT vec_id, x, cluster, {far} AS distance FROM v, c{r})
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1
    )""")
        if r < rounds:
            steps.append(f"""s{r + 1} AS MATERIALIZED (
        SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, {dims} + 1) AS t(i) GROUP BY cluster, i
    ), c{r + 1} AS MATERIALIZED (
        SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{r + 1} GROUP BY cluster
        UNION ALL SELECT cluster, c FROM c{r} WHERE cluster NOT IN (SELECT cluster FROM s{r + 1})
    )""")
    return ", ".join(steps) + f"""
    SELECT vec_id, a.cluster, distance, sum(distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
        sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.cluster
    """


@query(_clustering_sql())
def op11_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all usable ``embeddings``: one row per vector, with sums over its cluster and over all."""
    clustered, centres = cluster(table(spark, sf_dir, "embeddings"))
    sha = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centres)]
    named = spark.createDataFrame(sha, "cluster int, centroid_sha256 string")
    return with_inertia(clustered).join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


@query(
    r"""
    WITH w AS MATERIALIZED (
        SELECT 0 AS aim, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
        UNION ALL
        SELECT 1, NULL, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
    ), polynomial AS (
        SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS p
        FROM range(256) AS t(i)
    ), vocabulary AS MATERIALIZED (
        SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(word))),
                lambda i: ('0x' || hex(encode(word))[2 * i + 1 : 2 * i + 2])::BIGINT)),
            lambda c, b: xor(c >> 8, p[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
        FROM (SELECT DISTINCT word FROM w), polynomial
    ), held AS (
        SELECT bucket, count(*) FILTER (aim = 0) AS s, count(*) FILTER (aim = 1) AS t FROM w JOIN vocabulary USING (word) GROUP BY bucket
    ), gain AS (
        SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
        FROM held
    ), weighed AS (
        SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight
        FROM w JOIN vocabulary USING (word) JOIN gain USING (bucket) WHERE aim = 0 GROUP BY doc_id
    ), scored AS (
        SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
            (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || d.doc_id), 8))::BIGINT + 0.5)::DOUBLE / 4294967296.0::DOUBLE))))::BIGINT AS score
        FROM documents d LEFT JOIN weighed USING (doc_id)
    ), placed AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
    )
    SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
    FROM scored s LEFT JOIN placed USING (doc_id)
    """
)
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` scored by how much more their words are the words of ``benchmark``; a tenth drawn."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op13_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all ``embeddings``, whatever their labels."""
    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

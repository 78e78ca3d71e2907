"""WARC archives: writing with revisit records, reading by verified chains of record boundaries."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, few, written

# Fixed values of the format.
MAGIC, END = "WARC/1.", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_CUT = len(END + MAGIC)


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in upper-case base32, as archives write it: 20 bits at a time from the hex digits."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def write_warc(
    pages: DataFrame, path: str, least: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html",
    date: str = "2026-01-01T00:00:00Z", broadcast_rows: int = BROADCAST_ROWS,
) -> None:
    """Write a record per row of ``pages`` into archives in the folder ``path``.

    Of rows with equal payloads of ``least`` bytes or more, those with the smallest id become
    responses and the others revisits, which have the HTTP head but no payload. Only digests are
    shuffled to find them; the groups with more than one row are broadcast up to
    ``broadcast_rows`` and beyond that joined by a shuffle.

    A NULL payload is empty, a NULL address is left out, a NULL id becomes an empty one and is
    never the smallest unless there is no other. Line ends in addresses are escaped. Rows
    that repeat the smallest id are all responses. An empty table writes no records.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("id"), F.col(url).alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("n"), sha1_base32(payload).alias("digest"),
    )
    groups = rows.where(F.col("n") >= least).groupBy("digest", "n").agg(F.min("id").alias("first_id"), F.count("*").alias("rows"))
    groups = written(groups.where("rows > 1 and first_id is not null").drop("rows"), "warc-groups")
    rows = rows.join(F.broadcast(groups) if few(groups, broadcast_rows) else groups, ["digest", "n"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    address = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    head = F.concat(
        F.lit(MAGIC + "1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("id"))),
        F.coalesce(line("WARC-Target-URI", address), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(line("WARC-Refers-To", name(F.col("first_id"))), F.lit(f"WARC-Profile: {PROFILE}\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    # The blank lines after a record are what the sink writes after each row.
    rows.select(F.concat(head, F.lit("\r\n"), block).alias("value")).write.option("lineSep", END).option("compression", "none").text(path)


def _fields(head: bytes) -> dict[bytes, bytes]:
    lines = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in lines}


def _http_payload(fields: dict[bytes, bytes], block: bytes) -> tuple[bytes, bytes]:
    """(HTTP head, payload) of a record's block."""
    if not fields.get(b"content-type", b"").startswith(b"application/http"):
        return b"", block
    head, _, payload = block.partition(b"\r\n\r\n")
    return head, payload


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _described(raw: bytes, first: bool) -> dict | None:
    """What a piece says if it is the beginning of a record, else None.

    ``body`` is where the block begins, relative to the piece, ``size`` its length.
    """
    text = raw[len(MAGIC) :] if first and raw.startswith(MAGIC.encode()) else raw
    if (first and text is raw) or not re.match(rb"\d\r\n", text):
        return None
    head, _, _ = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    size = fields.get(b"content-length", b"")
    if not size.isdigit():
        return None
    decode = lambda key: fields[key].decode("utf-8", "replace") if key in fields else None
    return {
        "body": len(head) + 4, "size": int(size), "fields": fields, "type": decode(b"warc-type"), "record_id": decode(b"warc-record-id"),
        "refers_to": decode(b"warc-refers-to"), "uri": decode(b"warc-target-uri"), "stated": (decode(b"warc-payload-digest") or "").removeprefix("sha1:") or None,
    }


PIECES = (
    "file string, split long, seq long, start long, length long, at long, next long, leaves long, closed boolean, "
    "type string, record_id string, refers_to string, uri string, stated string, payload_bytes long, payload_digest string, payload binary"
)
_COLUMNS = [c.split()[0] for c in PIECES.split(", ")]


def _split_rows(own: list[dict]) -> list[dict]:
    """Pieces of one split, with the chains inside it followed to where they leave it.

    Records lead forward only, so one pass from the end knows for each where its chain leaves the
    split (``leaves``).
    """
    ends: dict[int, int] = {}
    for row in reversed(own):
        if row["at"] is not None:
            row["leaves"] = ends[row["at"]] = ends.get(row["next"], row["next"])
    return own


def _scan(payloads: bool):
    """Pieces between possible boundaries, by split of a file, with offsets from its first piece."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, own, at = None, [], 0
        for batch in batches:
            for file, split, raw in zip(batch["file"], batch["split"], batch["value"], strict=True):
                if (file, split) != key:
                    if own:
                        yield pd.DataFrame(_split_rows(own), columns=_COLUMNS)
                    key, own, at = (file, split), [], 0
                first = split == 0 and not own
                row = dict.fromkeys(_COLUMNS) | {"file": file, "split": split, "seq": len(own), "start": at, "length": len(raw), "closed": False}
                if found := _described(raw, first):
                    end = found["body"] + found["size"]
                    row |= {"at": 0 if first else at - len(MAGIC), "next": at + end + 4}
                    row |= {k: found[k] for k in ("type", "record_id", "refers_to", "uri", "stated")}
                    if len(raw) == end or raw[end:] == b"\r\n\r\n":
                        row |= _content(found["fields"], found["type"], raw[found["body"] : end], payloads) | {"closed": True}
                own.append(row)
                at += len(raw) + _CUT
        if own:
            yield pd.DataFrame(_split_rows(own), columns=_COLUMNS)

    return scan


def _content(fields: dict[bytes, bytes], kind: str | None, block: bytes, payloads: bool) -> dict:
    head, payload = _http_payload(fields, block)
    if kind == "revisit":
        size = _fields(b"\r\n" + head).get(b"content-length", b"")
        return {"payload_bytes": int(size) if size.isdigit() else None}
    return {"payload_bytes": len(payload), "payload_digest": _digest(payload), "payload": payload if payloads else None}


def _raw(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", END + MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value")
    )


def _cores(spark: SparkSession) -> str:
    """What Spark would derive the size of splits from at this moment."""
    return spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or str(spark.sparkContext.defaultParallelism)


@contextmanager
def _splits_for(spark: SparkSession, cores: str):
    """Cut files into the same splits however many cores there are by now; for jobs run inside only."""
    key = "spark.sql.files.minPartitionNum"
    own = spark.conf.get(key, None)
    spark.conf.set(key, own or cores)
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(key)


def _reachable(entries: DataFrame) -> DataFrame:
    """``file``, ``at`` of the entries on the chain from the start of their file.

    Pointer jumping: after each round the reached set covers twice as many steps and the pointers
    lead twice as far, so a file of n splits takes about log2(n) rounds.
    """
    reached = entries.where("at = 0").select("file", "at")
    jumps = entries.select("file", "at", "leaves")
    count = reached.count()
    while True:
        ahead = reached.join(jumps, ["file", "at"]).select("file", F.col("leaves").alias("at"))
        more = ahead.join(entries.select("file", "at"), ["file", "at"])
        reached = written(reached.unionAll(more).distinct(), "warc-reached")
        if reached.count() == count:
            return reached
        count = reached.count()
        further = jumps.select("file", F.col("at").alias("leaves"), F.col("leaves").alias("far"))
        jumps = written(jumps.join(further, ["file", "leaves"]).select("file", "at", F.col("far").alias("leaves")), "warc-jumps")


def _follow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The candidates of one split that do not lie on the chain through its reached entries."""
    after = dict(zip(rows["at"].tolist(), rows["next"].tolist(), strict=True))
    on = set()
    for at in rows.loc[rows["entry"], "at"].tolist():
        while at in after and at not in on:
            on.add(at)
            at = after[at]
    return rows.loc[~rows["at"].isin(on), ["file", "split", "seq"]]


def read_warc(spark: SparkSession, path: str, payloads: bool = False, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The records of all archives (uncompressed, or compressed as whole files) under ``path``.

    Columns: ``file``, ``at`` (offset), ``type``, ``record_id``, ``refers_to``, ``uri``, ``payload_bytes``,
    ``payload_digest`` (base32 SHA-1: computed of what was read, for revisits as stated),
    and ``payload`` if asked for.

    Archives are cut into splits, and splits at everything that looks like the end of one record
    and the beginning of the next. A piece that begins like a record is a candidate and says
    where its successor would be. Chains are followed within each split, then by pointer jumping
    over the few candidates where chains enter splits, from the start of each file. What is not
    reached was part of a payload that looks like a record. A record with such a payload, or one
    that runs over several splits, is put together from its pieces, which alone are read again, in
    the splits of the first time even if the number of cores has changed since.
    Offsets are sums of lengths, per split first, so no task sees more than its split.

    Chains end where a successor is missing; what follows in a damaged file is left out. An
    empty folder gives an empty result.
    """
    cores = _cores(spark)
    with _splits_for(spark, cores):
        pieces = written(_raw(spark, path).mapInPandas(_scan(payloads), PIECES), "warc-pieces")
    sums = pieces.groupBy("file", "split").agg(F.sum(F.col("length") + _CUT).alias("total"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(sums.select("file", "split", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")), "warc-splits")
    moved = pieces.join(bases, ["file", "split"]).withColumns(
        {c: F.col(c) + F.col("base") for c in ("start", "at", "next", "leaves")}
    )
    records = moved.where("at is not null").select("file", "split", "seq", "start", "at", "next", "leaves")
    entries = records.select("file", F.col("leaves").alias("at")).unionAll(records.where("at = 0").select("file", "at")).distinct()
    entries = written(records.join(entries, ["file", "at"]).select("file", "at", "leaves"), "warc-entries")
    reached = _reachable(entries).withColumn("entry", F.lit(True))
    flagged = records.join(reached, ["file", "at"], "left").select(
        "file", "split", "seq", "at", "next", F.coalesce("entry", F.lit(False)).alias("entry")
    )
    # Few: only payloads that look like records, and what follows damage.
    off_chain = written(flagged.groupBy("file", "split").applyInPandas(_follow, "file string, split long, seq long"), "warc-off-chain")
    found = moved.where("at is not null").join(off_chain, ["file", "split", "seq"], "left_anti")
    names = ["file", "at", "type", "record_id", "refers_to", "uri"]
    value = [F.col("payload_bytes"), F.coalesce("payload_digest", "stated").alias("payload_digest"), *([F.col("payload")] if payloads else [])]
    closed = found.where("closed").select(*names, *value)
    parted = written(found.where("not closed").select(*names, "next", "stated"), "warc-parted")
    if parted.isEmpty():
        return closed
    with _splits_for(spark, cores):
        rest = written(_put_together(spark, path, moved, parted, payloads, broadcast_rows), "warc-whole")
    if rest.count() != parted.count():
        raise RuntimeError(f"the archives under {path} changed while they were read")
    return closed.unionByName(parted.join(rest, ["file", "at"]).select(*names, *value))


def _put_together(spark: SparkSession, path: str, moved: DataFrame, parted: DataFrame, payloads: bool, broadcast_rows: int) -> DataFrame:
    """Payloads of the records that consist of several pieces, from a second look at the archives."""
    files = parted.select("file").distinct()
    marks = moved.join(files, "file", "left_semi").select("file", "split", "seq", "start", F.lit(None).cast("long").alias("at"), F.lit(None).cast("long").alias("next"))
    heads = parted.select("file", F.lit(None).cast("long").alias("split"), F.lit(None).cast("long").alias("seq"), F.col("at").alias("start"), "at", "next")
    upto = Window.partitionBy("file").orderBy("start", F.col("seq").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = marks.unionByName(heads).select(
        "file", "split", "seq", "start", F.last("at", ignorenulls=True).over(upto).alias("at"), F.last("next", ignorenulls=True).over(upto).alias("next")
    )
    needed = written(owned.where("seq is not null and start < next").select("file", "split", "seq", "start", "at"), "warc-needed")

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, seq = None, 0
        for batch in batches:
            places = []
            for own in zip(batch["file"], batch["split"], strict=True):
                key, seq = own, seq + 1 if own == key else 0
                places.append(seq)
            yield batch.assign(seq=places)

    def joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("start")
        whole = (END + MAGIC).encode().join(rows["value"].tolist())
        found = _described(whole, key[1] == 0)
        block = whole[found["body"] : found["body"] + found["size"]]
        got = {"payload_digest": None, "payload": None} | _content(found["fields"], found["type"], block, payloads)
        return pd.DataFrame([{"file": key[0], "at": key[1], **got}])

    pieces = _raw(spark, path).mapInPandas(numbered, "file string, split long, value binary, seq long")
    small = F.broadcast(needed) if few(needed, broadcast_rows) else needed
    own = pieces.join(small, ["file", "split", "seq"])
    return own.groupBy("file", "at").applyInPandas(joined, "file string, at long, payload_bytes long, payload_digest string, payload binary")


def page_of(record: Column) -> Column:
    """The page id in a record id written by ``write_warc``."""
    return F.nullif(F.regexp_extract(record, "^<urn:page:(.*)>$", 1), F.lit(""))

"""Archives, packing, fingerprints and repeat removal against plain versions and round trips."""

import base64
import hashlib
import math
import random
import re
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tokenizers
import xxhash
from helpers import SF, awkward, documents, empty, grouped
from pyspark.sql import functions as F

from pollpipe.llm import QUERIES, imatch, packing, runindex, warc
from pollpipe.llm.common import fresh, written
from pollpipe.llm.queries import tokenizer_path

PAGES = "page_id long, url string, html string, n long, digest string, file string, at long"


def page_rows(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "d", "f", 2) for i, u, h in rows], PAGES)


def forged(n):
    return f"<p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{n}>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n</p>"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected_pages(rows, least=0):
    first = {}
    for i, _, h in rows:
        size = len((h or "").encode())
        if size >= least and i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    found = []
    for i, _, h in rows:
        owner = first.get(h or "")
        again = owner is not None and owner != i
        found.append((i, len((h or "").encode()), digest(h), "revisit" if again else "response", owner if again else None))
    return sorted(found, key=repr)


def read_pages(spark, path, **options):
    rows = warc.read_warc(spark, path, **options).collect()
    number = lambda x: int(x.split(":")[2][:-1]) if x and x != "<urn:page:>" else None
    return sorted(((number(r.record_id), r.payload_bytes, r.payload_digest, r.type, number(r.refers_to)) for r in rows), key=repr)


@pytest.mark.parametrize("split, bound", [("128m", 500_000), ("2k", 0), ("300b", 500_000)])
def test_archives_round_trip(spark, split, bound):
    texts = ["plain", "", None, "é😀 \r\n", forged(77), forged(78) * 9, "\r\n\r\nWARC/1.0\r\n", "ends\r\n\r\n", "ends\r\n", "WARC/1.1\r\n", "x" * 5000, "plain", "plain", "", forged(77), "long " * 700 + forged(3)]
    rows = [(i, f"http://x/{i}", t) for i, t in enumerate(texts)] + [(None, None, "plain"), (None, "u\r\nv", "no id"), (3, "WARC/1.1", "again")]
    path = fresh(spark, "test-warc")
    warc.write_warc(page_rows(spark, rows).repartition(2), path, broadcast_rows=bound)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert read_pages(spark, path, broadcast_rows=bound) == expected_pages(rows)
        payloads = warc.read_warc(spark, path, payloads=True).where("type = 'response'").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert all(digest(bytes(r.payload).decode()) == r.payload_digest for r in payloads)


def test_archives_read_while_cores_change(spark, monkeypatch):
    rows = [(i, f"u{i}", forged(i % 4) + f"page {i} " * 20) for i in range(60)]
    path = fresh(spark, "test-warc")
    warc.write_warc(page_rows(spark, rows).coalesce(1), path)
    raw, cores, key = warc._raw, iter((3, 11, 5, 7)), "spark.sql.leafNodeDefaultParallelism"

    def after_a_change(*args):
        spark.conf.set(key, next(cores))
        return raw(*args)

    monkeypatch.setattr(warc, "_raw", after_a_change)
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        got = {r.record_id: r.payload.decode() for r in warc.read_warc(spark, path, payloads=True).collect()}
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset(key)
    assert got == {f"<urn:page:{i}>": html for i, _, html in rows}
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_archives_least_and_empty(spark):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    path = fresh(spark, "test-warc")
    warc.write_warc(page_rows(spark, rows), path, least=5)
    assert read_pages(spark, path) == expected_pages(rows, 5)
    path = fresh(spark, "test-warc")
    warc.write_warc(page_rows(spark, rows).limit(0), path)
    assert warc.read_warc(spark, path).count() == 0


def test_archive_bytes_are_a_valid_chain(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_warc(page_rows(spark, [(1, "u", forged(4)), (2, "v", "é")]).coalesce(1), path)
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "archives").glob("part-*")))
    at, records = 0, 0
    while at < len(data):
        head = data[at:].split(b"\r\n\r\n")[0]
        size = int(dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])[b"Content-Length"])
        at += len(head) + 4 + size + 4
        records += 1
    assert at == len(data) and records == 2


def test_warc_query(spark):
    rows = documents("page_id, url, html", name="pages")
    got = [tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in QUERIES["op1_warc"](spark, SF).collect()]
    assert sorted(got, key=repr) == expected_pages(rows)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def test_encoder_equals_library(library):
    encode = packing.encoder(open(tokenizer_path(), encoding="utf-8").read())
    texts = ["", "a", "  a  ", "it's we'll I'M", "<|endoftext|> x", "x" * 3000, " " * 700 + "y", "\n\n\t a\r\n", "日本語 テスト", "１２ ½ ①", "àé​ z", "\x00\x85\x1c­"]
    texts += [t for _, t in documents()[:200]]
    common = [chr(c) for c in range(0x24FF) if not packing._COMMON.search(chr(c))]
    texts += [f"{c}a{c} {c}1{c}{c} !{c}\n{c}" for c in common]
    assert len(common) > 800
    for text in texts:
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("length", [1, 5, 1023, 1024, 1025, 2048, 5000])
def test_cuts(length):
    parts = packing.cuts(length, 1024)
    assert parts[0][0] == 0 and sum(n for _, n in parts) == length
    assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
    assert all(n == 1024 for _, n in parts[1:]) and len(parts) == -(-length // 1024)


def fewest(sizes, capacity):
    """The least number of bins, by trying everything."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[i]}:
            j = rooms.index(room)
            place(i + 1, [*rooms[:j], room - sizes[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


def check_packed(counts, packed, capacity):
    assert all(sum(f) <= capacity for f in packed)
    placed = Counter()
    for filling, number in packed.items():
        placed.update({s: filling.count(s) * number for s in set(filling)})
    assert placed == Counter(counts)


@pytest.mark.parametrize("seed", range(12))
def test_bin_completion_is_optimal_on_small_cases(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(3, 45) for _ in range(11)), reverse=True)
    packed = packing.complete_bins(Counter(sizes), 50)
    check_packed(Counter(sizes), packed, 50)
    assert sum(packed.values()) == fewest(sizes, 50)


@pytest.mark.parametrize("n", [0, 1, 40, 3000, 200_000])
def test_bin_completion_is_near_the_bound(n):
    rng = np.random.default_rng(n)
    counts = Counter((rng.lognormal(6, 1, n).astype(int) % 1024 + 1).tolist())
    packed = packing.complete_bins(counts)
    check_packed(counts, packed, 1024)
    bound = packing.least_bins(counts, 1024) if n else 0
    assert bound <= sum(packed.values()) <= min(bound + 2, sum(packing.best_fit(counts, 1024).values()))


def test_bin_completion_leaves_no_filling_out():
    sizes = Counter([400, 390, 390, 380, 350, 322, 322, 274, 244])
    packed = packing.complete_bins(sizes, 1024)
    check_packed(sizes, packed, 1024)
    assert sum(packed.values()) == 3
    draw = random.Random(8)
    sizes = Counter(draw.randint(200, 500) for _ in range(30))
    packed = packing.complete_bins(sizes, 1024)
    check_packed(sizes, packed, 1024)
    assert sum(packed.values()) == packing.least_bins(sizes, 1024) == 11


def test_fillings_are_all_undominated_ones_by_waste():
    sizes = Counter([390, 390, 380, 350, 322, 322, 274, 244])
    counts, order = sizes | Counter([400]), [*sorted(sizes), 400]
    bits = packing._Sums(1024).of(sizes | Counter({400: 0}), order)
    found = packing.fillings(counts, order, 400, 1024, bits, lambda: 300, set(), packing._Steps(1000))
    assert list(found) == [(400, 380, 244), (400, 350, 274), (400, 390)]


def check_sequences(rows, capacity=1024):
    for own in grouped(rows, lambda r: r.sequence_id).values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity


def test_pack_query(spark, library):
    rows = QUERIES["op2_pack"](spark, SF).collect()
    check_sequences(rows)
    by_doc = grouped(rows, lambda r: r.doc_id)
    lengths = Counter()
    for i, text in documents():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in own] == packing.cuts(len(ids), 1024)
        assert [r.ids_crc32 for r in own] == [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own]
        lengths.update(r.length for r in own)
    assert len({r.sequence_id for r in rows}) <= packing.least_bins(lengths, 1024) + 1


def test_pack_awkward(spark):
    docs = awkward(spark)
    pieces = written(packing.tokenize(docs.drop("length"), tokenizer_path()).withColumn("size", F.lit(1)).withColumn("task", F.lit("x")), "test-pieces")
    rows = packing.pack(pieces).collect()
    check_sequences(rows)
    assert sum(r.piece == 0 for r in rows) == docs.count() and {r.task for r in rows} == {"x"}
    assert sum(r.length == 1 for r in rows if r.doc_id in (0, 1)) == 2
    assert packing.pack(written(packing.tokenize(empty(spark), tokenizer_path()), "test-pieces")).count() == 0


def test_imatch_query(spark):
    docs = sorted(documents())
    rows = {r.doc_id: r for r in QUERIES["op4_imatch"](spark, SF).collect()}
    assert len(rows) == len(docs)
    prints = defaultdict(set)
    for k, (i, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[1][:quarter]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert r.near_edited == imatch.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == imatch.likeness(r.fingerprint, rows[following[0]].fingerprint)
        prints[text].add(r.fingerprint)
        prints[changed].add(r.edited_fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    near, other = (np.array([r[c] for r in rows.values()]) for c in ("near_edited", "near_next"))
    # a likeness of 0.1 tells an edited text from another one
    assert (near >= 0.1).mean() >= 0.9 and (other >= 0.1).mean() <= 0.02
    assert near.mean() > 0.3 and np.median(other) == 0 and (near[:, None] > other[None, :]).mean() > 0.9


def plain_hashes(text):
    return sorted({xxhash.xxh64_intdigest(w) for w in re.split(rb"[\x09-\x0d !-/:-@\[-`{-~]+", text.lower().encode()) if w})


def plain_lexicons(hashes, most):
    """Hashes of the random lexicons' terms, in whole numbers and one term after the other."""
    found, bits = [], 0
    for halving in range(12, 0, -1):
        bits = bits if bits + halving <= 64 else 0
        for draw in range(4):
            inside = []
            for h in hashes:
                x = h ^ xxhash.xxh64_intdigest(f"lexicon {draw}".encode())
                x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
                x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
                x ^= x >> 31
                if (x >> bits) % 2**halving == 0:
                    inside.append(h)
            enough = sum(f != "" for f in found) >= most
            content = b"".join(h.to_bytes(8, "little") for h in inside)
            found.append("" if enough or not inside else f"{xxhash.xxh32_intdigest(content) % 2**24:06x}")
        bits += halving
    return found


def plain_likeness(a, b, in_band):
    """Likeness of two texts from their words, without fingerprints."""
    terms = [plain_hashes(t) for t in (a, b)]
    kept = [[h for h in t if in_band(h)] for t in terms]
    signs = [(k or t) or text for k, t, text in zip(kept, terms, (a, b), strict=True)]
    sides = [plain_lexicons(k, 48) for k in kept]
    if any(len(k) * 8 < len(t) or not any(s) for k, t, s in zip(kept, terms, sides, strict=True)):
        sides = [plain_lexicons(t, 12) for t in terms]
    same = [x == y for x, y in zip(*sides, strict=True) if x or y][:12]
    everything = signs[0] == signs[1] and all(plain_lexicons(t, 12) == plain_lexicons(terms[0], 12) for t in terms)
    return 1.0 if everything and kept[0] == kept[1] else sum(same) / len(same) if same else 0.0


def test_imatch_equals_a_plain_version(spark):
    docs = sorted((i, t) for i, t in documents(sf="/root/testdata/sf0.001") if len(t or "") < 6000)
    rows = {r.doc_id: r for r in imatch.fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    count = Counter(p for _, t in docs for p in {h >> 42 for h in plain_hashes(t or "")})
    in_band = lambda h: 2 <= count[h >> 42] <= len(docs) * math.exp(-3)
    for k, (i, text) in enumerate(docs):
        text, following = text or "", docs[(k + 1) % len(docs)][1] or ""
        changed = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        assert rows[i].near_next == plain_likeness(text, following, in_band), i
        assert rows[i].near_edited == plain_likeness(text, changed, in_band), i


def test_lexicon_counts_documents(spark):
    docs = [(i, f"all shared{i // 2} own{i} own{i}") for i in range(60)]
    known = imatch.lexicon(spark.createDataFrame(docs, "doc_id long, text string"), band=(1.0, 25.0))
    held = lambda w: bool(known[(p := int(imatch._places(imatch.terms(w))[0])) >> 3] >> (p & 7) & 1)
    assert not held("all") and all(held(f"shared{i}") for i in range(30)) and sum(held(f"own{i}") for i in range(60)) <= 1


def test_imatch_awkward(spark):
    docs = awkward(spark)
    rows = imatch.fingerprints(docs, parts=5).collect()
    assert len(rows) == docs.count()
    assert {r.fingerprint for r in rows if r.n_chars == 0} and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)
    one = imatch.fingerprints(docs.where("doc_id = 4")).first()
    assert one.near_next == 1.0
    assert imatch.fingerprints(empty(spark)).count() == 0


def test_imatch_edited_copies_of_a_hot_group(spark):
    hot = " ".join(f"common{k}" for k in range(200))
    other = lambda i: " ".join(f"word{(i * 7 + k) % 500}" for k in range(40))
    docs = [(i, hot if i % 3 == 0 else f"{hot} own{i // 6}" if i % 3 == 1 and i < 60 else other(i)) for i in range(300)]
    rows = {r.doc_id: r for r in imatch.fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    copies = [rows[i].near_edited for i in range(0, 300, 3)]  # a third of the rows, next to texts of terms in the band
    near = [rows[i].near_edited for i in range(1, 60, 3)]  # one term of their own
    assert min(copies + near) > 0 and np.mean(copies) > 0.2 and np.mean(near) > 0.2
    assert np.median([rows[i].near_next for i in range(2, 297, 3)]) == 0


def repeats(rows):
    """Plain version: bytes covered by a window of a document with a smaller id; NULL ids last."""
    order = lambda k: float("inf") if k is None else k
    first = {}
    for k, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - 49):
            w = raw[i : i + 50]
            first[w] = min(first.get(w, order(k)), order(k))
    found = []
    for k, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < order(k):
                gone[i : i + 50] = True
        edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(int)))
        found.append((k, len(raw), edges[::2].tolist(), edges[1::2].tolist(), np.frombuffer(raw, np.uint8)[~gone].tobytes()))
    return sorted(found, key=repr)


def got_repeats(frame):
    return sorted(((r.doc_id, r.n_bytes, list(r.starts), list(r.ends), bytes(r.kept)) for r in frame.collect()), key=repr)


def test_repeats_query(spark):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op6_remove_repeats"](spark, SF).collect()}
    plain = repeats(documents())
    assert got == {k: (n, sum(e) - sum(s), len(s), hashlib.sha256(kept).hexdigest()) for k, n, s, e, kept in plain}


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_over_many_partitions(spark, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abé \n") for _ in range(rng.randint(30, 180))) for _ in range(9)]
    texts = ["".join(rng.choice(pool) if rng.random() < 0.6 else uuid.UUID(int=rng.getrandbits(128)).hex for _ in range(rng.randint(0, 8))) for _ in range(80)]
    texts += ["a" * 400, "ab" * 300, "a" * 200 + "ab" * 60, None, ""]
    rows = [(rng.choice([None, *range(60)]), t) for t in texts]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit(1)).withColumn("keys", F.lit("x"))
    for common in (2000, 4):
        got = got_repeats(runindex.remove_repeats(frame.repartition(6), text_per_hashes=5000, text_per_index=2000, common=common))
        assert got == repeats(rows)


def test_repeats_awkward(spark):
    docs = awkward(spark)
    got = got_repeats(runindex.remove_repeats(docs.where("length(text) < 1000 or text is null")))
    assert got == repeats([(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 1000])
    long = {r.doc_id: (r.n_bytes, list(r.starts), list(r.ends)) for r in runindex.remove_repeats(docs).collect() if r.doc_id in (7, 8)}
    assert long[7][1] == [] and long[8] == (long[7][0], [0], [long[7][0]])
    assert runindex.remove_repeats(empty(spark)).count() == 0


def test_run_index_is_smaller_than_its_text():
    rng = random.Random(0)
    base = bytes(rng.choice(b"abcdefgh") for _ in range(70))
    strings = [base[:60] + bytes([65 + i]) for i in range(20)] + [base]
    index = runindex.RunIndex(strings, np.arange(21))
    assert len(index.run_start) < sum(map(len, strings)) / 4
    found, place = index.least_keys()
    assert found[place].tolist() == [0] * 21

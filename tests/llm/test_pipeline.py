"""The pipeline, stage by stage, against plain versions over the rows each stage was given."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import tokenizers
from helpers import SF, ascii_lower, awkward, empty, grouped, linked, simhash, words

import __spark_entry__ as contract
from pollpipe.llm import QUERIES, packing
from pollpipe.llm.common import written
from pollpipe.llm.quality import quality
from pollpipe.llm.queries import tokenizer_path


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, given = docs.columns, docs.collect()
    scores = {r.doc_id: r.predicted for r in QUERIES["op7_quality"](spark, SF).collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test-stage")
        rows = docs.collect()
        assert docs.columns == columns and set(rows) <= set(given), name
        kept.append((given, rows))
        given = rows
    (given, rows), (_, unique), (_, apart), (_, mixed) = kept
    assert sorted(rows) == sorted(r for r in given if scores[r.doc_id])
    largest = {}
    for r in rows:
        largest[ascii_lower(r.text)] = max(largest.get(ascii_lower(r.text), -1), r.doc_id)
    assert sorted(r.doc_id for r in unique) == sorted(largest.values())
    prints = {r.doc_id: simhash(r.text) for r in unique}
    roots = linked(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    smallest = {}
    for i in sorted(prints):
        smallest.setdefault(roots[prints[i]], i)
    assert sorted(r.doc_id for r in apart) == sorted(smallest.values())
    times = Counter(r.doc_id for r in mixed)
    assert max(times.values()) <= 2
    total = sum(len(words(r.text)) for r in apart)
    longest = max(len(words(r.text)) for r in apart)
    taken = sum(len(words(r.text)) for r in mixed)
    assert abs(taken - 1.5 * total) <= longest * len({r.source for r in apart}) / 2

    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    packed = corpus_pipeline.pack_sequences(spark, docs, SF).collect()
    tokens = {r.doc_id: [*library.encode(r.text, add_special_tokens=False).ids, 2] for r in apart}
    lengths = {i: len(t) for i, t in tokens.items()}
    expected = Counter((i, p, s, n) for i, t in times.items() for p, (s, n) in enumerate(packing.cuts(lengths[i], 1024)) for _ in range(t))
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in packed) == expected
    for own in grouped(packed, lambda r: r.sequence_id).values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))] and sum(r.length for r in own) <= 1024
    # the tokens of every document come back out of the sequences
    sequences = {s: b"".join(bytes(r.ids) for r in sorted(own, key=lambda r: r.offset)) for s, own in grouped(packed, lambda r: r.sequence_id).items()}
    for r in packed:
        ids = np.frombuffer(sequences[r.sequence_id], "<u4")[r.offset : r.offset + r.length]
        assert ids.tolist() == tokens[r.doc_id][r.start : r.start + r.length] and r.ids_crc32 == zlib.crc32(ids.tobytes())


def test_run_is_the_stages(spark):
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert len(stages) == 5 and "quality" in stages[0] and "packing" in stages[-1]
    rows = contract.queries()["pipeline"](spark, SF.replace("0.01", "0.001")).collect()
    assert rows and {r.piece for r in rows} >= {0}


def test_awkward_rows_pass_through(spark):
    """What each stage keeps of NULLs, blanks, copies and clashing columns, given the rows of the one before."""
    docs = awkward(spark)
    scores = {(r.doc_id, r.text): r.predicted for r in quality(docs, spark.read.parquet(f"{SF}/labels.parquet"), keep=("text",)).collect()}
    whole = docs.collect()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = written(stage(spark, docs, SF), "test-stage")
        rows = out.collect()
        if number < 4:
            assert out.columns == docs.columns and set(rows) <= set(whole), name
        if number == 0:
            assert sorted(map(str, rows)) == sorted(str(r) for r in whole if scores[r.doc_id, r.text])
            out = docs  # the later stages are to see every awkward row
        elif number == 1:
            assert len(rows) == len({ascii_lower(r.text) for r in whole})
        elif number == 2:
            assert len(rows) == len(set(linked({simhash(r.text) for r in given}, lambda a, b: (a ^ b).bit_count() <= 2).values()))
        elif number == 3:
            assert max(Counter(rows).values()) <= 2
        else:
            assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in given)
        docs, given = out, rows if number else whole
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SF).count() == 0, name

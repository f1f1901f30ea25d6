import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from test_decontamination import words
from test_ngram_join import by_hand
from tokenizers import Tokenizer

from pulsegrain.llm import toxicity

FOLDER = "/root/testdata/sf0.01"


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    results, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, FOLDER), "test-stage")
        results[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    machine = toxicity.learn_from_tables(source, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.score(source, machine).where("predicted = 0").collect()}
    assert {r.doc_id for r in results["toxicity"]} == clean
    largest = {}
    for r in results["toxicity"]:
        key = exact_dedup_key(r.text)
        largest[key] = max(largest.get(key, -1), r.doc_id)
    assert sorted(r.doc_id for r in results["exact_dedup"]) == sorted(largest.values())
    single = {d for d, c, _ in by_hand([(r.doc_id, r.text) for r in results["exact_dedup"]]) if d == c}
    assert {r.doc_id for r in results["ngram_jaccard_join"]} == single
    items = [f" {' '.join(words(r.text))} " for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaking = {r.doc_id for r in results["ngram_jaccard_join"] if any(i in f" {' '.join(words(r.text))} " for i in items)}
    left = {r.doc_id for r in results["benchmark_decontamination"]}
    assert len(left & leaking) <= 0.05 * len(leaking) and left | leaking == {r.doc_id for r in results["ngram_jaccard_join"]}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for p in results["packing"]:
        pieces[p.doc_id].append(p)
    assert set(pieces) == left
    for r in results["benchmark_decontamination"]:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(pieces[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)


def exact_dedup_key(text):
    return "".join(c.lower() if c.isascii() else c for c in (text or ""))


def test_odd_rows_pass_every_stage(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, FOLDER), "odd-stage")
            assert name == "packing" or docs.columns == odd.columns


def test_rows_are_dropped_by_their_own_text(spark, rows):
    """Null ids, repeated ids with other texts and repeated rows: every decision is about one row."""
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    item = max((r.text for r in bench.collect()), key=len)
    near = " ".join(f"word{i} other{i % 7}" for i in range(120))
    clean = [f"clean text {c} " + " ".join(f"{c}{i}" for i in range(40)) for c in "pqrs"]
    docs = spark.createDataFrame(
        [(None, item), (None, clean[0]), (5, item), (5, clean[1]), (7, near), (None, near + " more"), (7, clean[2]), (8, near), (8, near), (None, clean[3]), (None, clean[3])],
        "doc_id long, text string").repartition(3)
    left = rows(corpus_pipeline.remove_benchmark(spark, docs, FOLDER))
    assert left == sorted([(i, t) for i, t in map(tuple, docs.collect()) if t != item], key=repr)
    left = rows(corpus_pipeline.remove_copies(spark, docs, FOLDER))
    assert [t for _, t in left].count(near) == 1 and [t for _, t in left].count(clean[3]) == 1 and len(left) == 7
    left = rows(corpus_pipeline.remove_near_copies(spark, docs, FOLDER))
    assert (None, near + " more") in left and not any(t == near for _, t in left)
    assert sorted(t for _, t in left) == sorted([item, *clean, near + " more"])

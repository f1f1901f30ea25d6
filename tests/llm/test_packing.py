import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pulsegrain.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(pieces, docs, tokenizer, size=packing.WINDOW):
    ids = defaultdict(list)
    for i, t in docs:
        ids[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for i, own in by_doc.items():
        assert sum(p.length for p in own) == sum(map(len, ids[i]))
        if len(ids[i]) == 1:
            at = 0
            for p in sorted(own, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids[i][0])
                assert p.ids_crc32 == zlib.crc32(np.array(ids[i][0][at:at + p.length], "<u4").tobytes())
                at += p.length
            assert at == len(ids[i][0])
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= size
    return len(by_sequence), sum(p.length for p in pieces)


def test_odd_rows_round_trip(odd, tokenizer):
    got = packing.pack(odd, packing.default_ranks()).collect()
    check(got, [(r.doc_id, r.text) for r in odd.collect()], tokenizer)


def test_documents_round_trip_with_little_padding(spark, sf_dir, tokenizer):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sequences, tokens = check(packing.op4_packing(spark, sf_dir).collect(), docs, tokenizer)
    assert sequences <= tokens // packing.WINDOW + 1


@pytest.mark.parametrize("text", ["a  b", "a\n b", " a", "a ", "a \n", "\n \n b", "don't  it's", "a  b", "", " ", "x\x1f y", "tab\t b", "1 2 3", "héé éà ñ"])
def test_words_apart_give_the_ids_of_the_whole(text, tokenizer):
    got = np.frombuffer(packing.token_bytes(packing.default_ranks())(text), "<u4").tolist()
    assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_level_with_the_least_sum_of_squares():
    packer, counts = packing.Packer(10), [0] * 11
    rng = np.random.default_rng(1)
    for n, length in enumerate(rng.integers(1, 10, 300).tolist()):
        costs = {}
        for level in range(0, 11 - length):
            if level and not counts[level]:
                continue
            trial = counts.copy()
            if level:
                trial[level] -= 1
            if level + length < 10:
                trial[level + length] += 1
            costs[level] = (sum(c * c for c in trial), -level, trial)
        best = min(costs.values())
        counts = best[2]
        packer.place(length, n)
        assert [len(packer.open.get(i, [])) for i in range(1, 10)] == counts[1:10]


def test_empty_table(nothing):
    assert packing.pack(nothing, packing.default_ranks()).count() == 0

import hashlib
import string
from collections import defaultdict

from pulsegrain.llm import exact_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for i, t in rows:
        value = (t or "").translate(LOWER)
        ids = [x for x in groups[value] if x is not None]
        keep = max(ids, default=None)
        out.append((i, keep, len(groups[value]), i == keep, hashlib.sha256(value.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_labels_match_by_hand(odd, rows):
    data = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows(exact_dedup.label_duplicates(odd)) == by_hand(data)


def test_labels_of_documents(spark, sf_dir, rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    data = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows(exact_dedup.op9_exact_dedup(spark, sf_dir)) == by_hand(data)


def test_drop_keeps_one_of_each(odd, rows):
    left = exact_dedup.drop_duplicates(odd)
    assert left.columns == odd.columns
    kept = {(r[0], r[4]) for r in by_hand([(r.doc_id, r.text) for r in odd.collect()]) if r[3]}
    found = [(r.doc_id, hashlib.sha256((r.text or "").translate(LOWER).encode()).hexdigest()) for r in left.collect()]
    assert set(found) == kept


def test_a_large_group_and_an_unlike_row_of_its_length(spark, rows):
    docs = spark.createDataFrame([(i, "same text " * 20) for i in range(500)] + [(900, "some text " * 20)], "doc_id long, text string")
    got = rows(exact_dedup.label_duplicates(docs), "doc_id", "keep_id", "group_size", "kept")
    assert got[-1] == (99, 499, 500, False) or (900, 900, 1, True) in got
    assert sum(r[3] for r in got) == 2


def test_empty_table(nothing):
    assert exact_dedup.label_duplicates(nothing).count() == 0
    assert exact_dedup.drop_duplicates(nothing).count() == 0


def test_no_python_in_the_plan(odd):
    plan = exact_dedup.label_duplicates(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

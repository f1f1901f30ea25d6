import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pulsegrain.llm import toxicity

INSULTS = ["idiot", "clown", "moron", "pathetic", "stupid"]


def by_hand(s, t):
    """The kernel by walking all triples of both units."""

    def features(u):
        out = {}
        for i in range(len(u)):
            for j in range(i + 1, len(u)):
                for k in range(j + 1, min(len(u), i + toxicity.SPAN)):
                    key = u[i] + u[j] + u[k]
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    a, b = features(s), features(t)
    norm = toxicity.length_norm(np.array([len(s), len(t)]))
    return sum(v * b.get(k, 0) for k, v in a.items()) / norm[0] / norm[1]


def test_kernel_matches_by_hand():
    units = ["idiot", "idxiot", "banana", "abc", "thorough", "aaaa"]
    got = toxicity.kernel(units, units)
    assert np.allclose(got, [[by_hand(s, t) for t in units] for s in units])
    assert np.linalg.eigvalsh(got).min() > -1e-9


def test_decision_is_the_kernel_machine():
    machine = toxicity.train_units(INSULTS, ["table", "water", "house", "garden", "river", "idea", "total"], landmarks=8)
    chosen = INSULTS[:4] + ["table", "water"]
    symbols, starts = toxicity._symbols(chosen + ["x"])
    assert len(machine.decide(symbols, starts)) == 7
    decisions = dict(zip(chosen, machine.decide(symbols, starts)))
    assert min(decisions[u] for u in INSULTS[:4]) > max(decisions["table"], decisions["water"])


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(5)
    words = ["".join(p) for p in zip(*[rng.choice(list("abcdefghilmnoprstu"), 400) for _ in range(6)])]
    rows = []
    for i in range(400):
        text = list(rng.choice(words, 40))
        if i % 4 == 0:
            text[int(rng.integers(0, 40))] = INSULTS[(i // 4) % 5]
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


@pytest.fixture(scope="module")
def machine(labelled):
    return toxicity.learn(labelled)


def test_disguised_insults_are_found(machine):
    texts = ["a idiot b", "an id-iot here", "i d i o t", "IDIOT!", "stu.pid", "clxown", "pathetic" * 1, "nothing of the kind", "", None, " . "]
    score = machine.score(machine.worst(pa.array(texts))[0])
    assert (score[:7] >= toxicity.CUT).all()
    assert (score[7:] < toxicity.CUT).all() and (score[8:] == 0).all()


def test_a_long_text_and_a_long_unit_are_read_whole(machine):
    texts = ["good words " * 20_000 + "moron", "z" * 5_000 + "stupid" * 8 + "z" * 5_000]
    assert (machine.score(machine.worst(pa.array(texts))[0]) >= toxicity.CUT).all()


def test_slices_do_not_change_decisions(machine, monkeypatch):
    texts = pa.array(["idiot", "", "some text", None, "i d", "i o t", "stupid thing"] * 5)
    whole = machine.worst(texts)[0]
    for i, text in enumerate(texts):
        assert np.array_equal(machine.worst(pa.array([text.as_py()], pa.string()))[0], whole[i:i + 1])


def test_odd_rows(odd, nothing, machine, rows):
    got = rows(toxicity.score(odd, machine), "doc_id", "held_out", "score", "predicted")
    assert len(got) == odd.count() and all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.7) for r in got)
    assert all(r[1] == (r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 1) for r in got)
    assert toxicity.score(nothing, machine).count() == 0
    left = toxicity.drop_toxic(odd, machine)
    assert left.columns == odd.columns and left.count() == sum(r[3] == 0 for r in got)
    assert toxicity.drop_toxic(nothing, machine).count() == 0


def test_without_both_labels_nothing_is_toxic(labelled, odd):
    machine = toxicity.learn(labelled.where("toxic = 0"))
    assert {r.score for r in toxicity.score(odd, machine).collect()} == {0.0}


def test_held_out_documents(spark, rows):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [r for r in toxicity.op7_toxicity(spark, folder).collect() if r.held_out and r.doc_id in truth]
    found = [r for r in got if r.predicted]
    right = sum(truth[r.doc_id] for r in found)
    assert right >= 0.9 * len(found) and right >= 0.75 * sum(truth[r.doc_id] for r in got)


def test_training_holds_little_beside_its_features():
    """Products with all units at once took five times the features of the driver."""
    rng = np.random.default_rng(3)
    units = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(3, 12))) for _ in range(6_000)]
    toxicity.train_units(units[:50], units[50:100])
    tracemalloc.start()
    toxicity.train_units(units[:2_500], units[2_500:])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 4 * 8 * len(units) * toxicity.LANDMARKS

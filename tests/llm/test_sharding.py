import zlib
from collections import defaultdict

from pulsegrain.llm import sharding
from pulsegrain.session import new_path


def stored(spark, shards=8):
    path = new_path(spark, "map")
    first = sharding.even_map(spark, shards)
    sharding.store_map(first, path, 1)
    sharding.store_map(sharding.grown_map(first, shards), path, 2)
    return path


def test_rows_are_whole_and_numbered(spark, odd):
    got = sharding.shard_documents(odd, stored(spark)).collect()
    want = sorted((r.doc_id or 0, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in odd.collect())
    assert sorted((r.doc_id or 0, r["size"], r.text_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_growing_moves_rows_only_into_the_new_shard(spark, sf_dir):
    got = sharding.op6_sharding(spark, sf_dir).collect()
    assert {r.shard for r in got} == set(range(8))
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    assert any(r.grown_shard == 8 for r in got)
    places = defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_a_row_keeps_its_shard_among_other_rows(spark, odd):
    path = stored(spark)
    whole = {r.doc_id: r.shard for r in sharding.shard_documents(odd, path).collect()}
    part = {r.doc_id: r.shard for r in sharding.shard_documents(odd.where("doc_id % 2 = 0"), path).collect()}
    assert all(whole[k] == v for k, v in part.items())


def test_versions_stay_readable_and_grow_evenly(spark):
    path = stored(spark)
    first = {r.virtual_slot: r.map_shard for r in sharding.read_map(spark, path, 1).collect()}
    second = {r.virtual_slot: r.map_shard for r in sharding.read_map(spark, path, 2).collect()}
    assert len(first) == len(second) == sharding.SLOTS
    counts = [list(second.values()).count(s) for s in range(9)]
    assert max(counts) - min(counts) <= 8
    assert all(second[s] in (first[s], 8) for s in first)


def test_rebalancing_evens_bytes(spark):
    slot_map = sharding.even_map(spark, 4, 256)
    sizes = spark.createDataFrame([(s, 1, 1000 if s % 4 == 0 else 10) for s in range(256)], "virtual_slot int, slot_rows long, slot_bytes long")
    after = sharding.rebalanced_map(slot_map, sizes, 4)
    weight = {r.virtual_slot: r.slot_bytes for r in sizes.collect()}
    loads = defaultdict(int)
    got = after.collect()
    assert sorted(r.virtual_slot for r in got) == list(range(256))
    for r in got:
        loads[r.map_shard] += weight[r.virtual_slot]
    assert max(loads.values()) < 1.2 * sum(weight.values()) / 4


def test_slot_bytes_add_up(odd):
    total = sharding.slot_bytes(odd).groupBy().sum("slot_bytes", "slot_rows").first()
    assert total[0] == sum(len((r.text or "").encode()) + 1 for r in odd.collect()) and total[1] == odd.count()


def test_empty_table(spark, nothing):
    assert sharding.shard_documents(nothing, stored(spark)).count() == 0

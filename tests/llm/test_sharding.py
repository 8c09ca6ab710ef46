import zlib

from pyspark.sql import functions as F

from cosecha.llm.sharding import latest, rebalance, shard_documents, sized, slot_map


def test_sizes_near_equal_and_slots_gapless(spark, documents, sample):
    rows = sample + [(900, None), (901, ""), (None, "x"), (902, "same"), (902, "same")]
    out = shard_documents(documents(rows), shards=4).collect()
    assert len(out) == len(rows) and {r.law for r in out} == {"bytes"} and all(r.grown_shard is None for r in out)
    text = dict(rows)
    load, slots = [0] * 4, [[] for _ in range(4)]
    for r in out:
        b = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(b) + 1, zlib.crc32(b))
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(load) - min(load) <= max(len((t or "").encode()) + 1 for _, t in rows)
    assert max(load) <= 1.01 * min(load)


def test_rebalancing_moves_few_slots(spark, documents, sample):
    sizes = sized(documents(sample), 256)
    one = slot_map(sizes, 4, 256)
    two = rebalance(one, 5)
    old = {r.virtual_slot: r.shard for r in one.collect()}
    new = {r.virtual_slot: r for r in latest(two).collect()}
    assert two.select(F.countDistinct("version")).first()[0] == 2 and sorted(new) == sorted(old) == list(range(256))
    moved = [s for s in old if old[s] != new[s].shard]
    load = [sum(r.bytes for r in new.values() if r.shard == k) for k in range(5)]
    assert sum(new[s].bytes for s in moved) < 0.35 * sum(load) and max(load) < 1.3 * min(load)
    back = {r.virtual_slot: r.shard for r in latest(rebalance(two, 3)).collect()}
    assert set(back.values()) == {0, 1, 2}


def test_native_plan_and_no_documents(spark, documents, sample):
    df = shard_documents(documents(sample), shards=4)
    assert "Python" not in df._jdf.queryExecution().toString() and shard_documents(documents([])).count() == 0

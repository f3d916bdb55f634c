"""The two-pass shuffle: every row once, gapless slots, and the law of keys."""

import zlib
from collections import Counter, defaultdict

from searchtide.llm import sharding
from tests.helpers import bag, plan, tuples
from tests.llm.conftest import documents


def test_digest(odd_docs):
    rows = tuples(sharding.shard_digest(odd_docs), "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    data = [(r[0], (r[1] or "").encode()) for r in documents()]
    assert sorted(map(repr, [(d, len(t) + 1, zlib.crc32(t)) for d, t in data])) == sorted(repr(r[:3]) for r in rows)
    slots, shards = defaultdict(list), defaultdict(set)
    for doc_id, _, _, law, shard, slot, grown in rows:
        assert law == "key" and 0 <= shard < 16 and grown in (shard, 16)
        slots[shard].append(slot)
        shards[doc_id].add((shard, grown))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())


def test_digest_is_of_whole_sharded_documents(odd_docs, monkeypatch):
    written, real = [], sharding.stored
    monkeypatch.setattr(sharding, "stored", lambda df, name: written.append(real(df, name)) or written[-1])
    found = sharding.shard_digest(odd_docs)
    assert bag(written[0].select(*[f"row.{c}" for c in odd_docs.columns])) == bag(odd_docs)
    assert any("row:struct<" in line and "text:string" in line for line in plan(found).splitlines())


def test_many_buckets_and_a_heavy_key(spark):
    rows = [(i if i % 3 else 7, i) for i in range(3000)]
    table = spark.createDataFrame(rows, "id long, number long").repartition(4)
    found = tuples(sharding.shuffled_shards(table, "id", 4, bucket_weight=50), "id", "number", "shard", "grown_shard", "slot")
    assert Counter(r[:2] for r in found) == Counter(rows)
    for shard in range(4):
        own = sorted((r[4], r[1]) for r in found if r[2] == shard)
        assert [s for s, _ in own] == list(range(len(own)))
        numbers = [n for _, n in own]
        rises = sum(a < b for a, b in zip(numbers, numbers[1:], strict=False))
        assert 0.4 < rises / len(numbers) < 0.6
    spread = Counter(r[2] for r in found if r[0] != 7)
    assert min(spread.values()) > 400
    grown = sharding.shuffled_shards(table, "id", 5, bucket_weight=50)
    assert bag(grown.select("id", "number", "shard")) == sorted([(r[0], r[1], r[3]) for r in found], key=repr)


def test_same_seed_same_order(spark):
    table = spark.range(500).repartition(3)
    one, two, other = (
        bag(sharding.shuffled_shards(table, "id", 2, bucket_weight=100, seed=s), "id", "shard", "slot") for s in (1, 1, 2)
    )
    assert one == two != other


def test_clashing_names_and_files(spark, clashing_docs, tmp_path):
    found = sharding.shuffled_shards(clashing_docs, "doc_id", 3)
    assert sorted(found.columns) == sorted(clashing_docs.columns)
    assert {r[0] for r in tuples(found, "class")} == {"own class"}
    sharding.write_shards(found, f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").count() == len(documents())


def test_no_python_in_the_plan(odd_docs):
    text = plan(sharding.shard_digest(odd_docs))
    assert not any(word in text for word in ("Python", "InPandas", "InArrow", "CartesianProduct"))

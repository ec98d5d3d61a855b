import random

import numpy as np
import pytest

from spotweave.llm import packing


def by_hand(sizes, capacity, even=packing.EVEN_LENGTH):
    """Each size to the container of lowest cost, then lowest number, that has room; else to a new one."""
    n = max(1, -(-sum(sizes) // capacity))
    room, cost, out = [capacity] * n, [0.0] * n, []
    for s in sizes:
        fit = [j for j in range(len(room)) if room[j] >= s]
        if fit:
            j = min(fit, key=lambda k: (cost[k], k))
        else:
            room.append(capacity), cost.append(0.0)
            j = len(room) - 1
        room[j] -= s
        cost[j] += s + s * s / even
        out.append(j)
    return out


@pytest.mark.parametrize("capacity", [10, 50, 2048])
def test_assignment(capacity):
    r = random.Random(capacity)
    for _ in range(40):
        sizes = sorted((r.randint(1, capacity) for _ in range(r.randint(1, 120))), reverse=True)
        assert packing.assign(np.array(sizes), capacity).tolist() == by_hand(sizes, capacity)


def test_every_token_once(spark):
    r = random.Random(1)
    lengths = {i: r.choice([0, 1, 5, 300, 2048, 2049, 5000, 4096, None]) for i in range(600)}
    df = spark.createDataFrame([(i, n, 0) for i, n in lengths.items()], "doc_id bigint, n_tokens bigint, piece int").repartition(3)
    packed = packing.pack(df, group_tokens=100_000)
    rows = packed.collect()
    per = {}
    for x in rows:
        per.setdefault(x.container_id, []).append(x)
    assert all(sum(x.n_tokens for x in v) <= packing.CAPACITY for v in per.values())
    assert all(sorted(x.slot for x in v) == list(range(len(v))) for v in per.values())
    docs = {}
    for x in rows:
        docs.setdefault(x.doc_id, []).append((x.piece, x.start_token, x.n_tokens))
    for i, n in lengths.items():
        expect = [(k, k * 2048, min(2048, n - k * 2048)) for k in range(-(-n // 2048))] if n else []
        assert sorted(docs.get(i, [])) == expect
    assert {x.doc_id for x in packing.split_texts(packed).collect()} == {i for i, n in lengths.items() if n and n > 2048}
    assert sum(x.n_tokens for x in packing.containers(packed).collect()) == sum(n or 0 for n in lengths.values())


def test_little_room_is_left(spark):
    r = random.Random(2)
    df = spark.createDataFrame([(i, int(min(2048, max(1, r.lognormvariate(5.5, 0.8))))) for i in range(20_000)], "doc_id bigint, n_tokens bigint")
    used = packing.containers(packing.pack(df, group_tokens=500_000))
    r = used.selectExpr("sum(n_tokens) / (count(*) * 2048) as filled").first()
    assert r.filled > 0.97


def test_edges(spark):
    df = spark.createDataFrame([], "doc_id bigint, n_tokens bigint")
    assert packing.pack(df).count() == 0
    df = spark.createDataFrame([(1, 5), (1, 5)], "doc_id bigint, n_tokens bigint")
    assert packing.pack(df).count() == 2


def test_repeated_and_null_ids_spread_over_the_groups(spark):
    lengths = spark.range(400).selectExpr("cast(null as bigint) as doc_id", "100L as n_tokens")
    packed = packing.pack(lengths, 1000, 5000).collect()
    assert sum(r.n_tokens for r in packed) == 40_000 and len({r.container_id >> 24 for r in packed}) > 4

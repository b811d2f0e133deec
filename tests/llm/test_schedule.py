"""The schedule of the mix decides: prefixes keep the weights, and another ratio gives other slots."""

import pytest
from pyspark.sql import functions as F

from urlsift.llm import mixing


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, "w " * (50 + i % 90), "abc"[i % 3]) for i in range(240)] + [(1000, None, "a"), (1001, "", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def slots_of(mixed):
    return {r.id: (r.size, r.slots, r.first_slot, r.last_slot) for r in mixed.slots().collect()}


def test_slots_against_the_schedule(table):
    mixed = mixing.mix(table, block=64)
    places = {}
    for r in mixed.schedule.collect():
        places.setdefault((r.s, r.block), []).append((r.slot, r.words))
    want = {}
    for d in mixed.documents.collect():
        met = []
        for block in range(d.start // 64, (d.start + d.size - 1) // 64 + 1) if d.size else ():
            met += [slot for slot, words in places.get((d.s, block), ()) if words > max(d.start - block * 64, 0)]
        real = [m for m in met if m is not None]
        want[d.id] = (d.size, len(met), min(real, default=None), max(real, default=None))
    assert slots_of(mixed) == want and want[1000] == want[1001] == (0, 0, None, None)


def test_every_prefix_keeps_the_weights(table):
    mixed = mixing.mix(table, block=64)
    wanted = {r.s: r.slots for r in mixed.sources.collect()}
    total = sum(wanted.values())
    order = [r.s for r in mixed.schedule.filter("slot is not null").orderBy("slot").collect()]
    seen = dict.fromkeys(wanted, 0)
    for n, s in enumerate(order, 1):
        seen[s] += 1
        assert all(abs(seen[x] - n * wanted[x] / total) <= 4 for x in wanted)


def test_another_ratio_gives_other_slots(table, monkeypatch):
    golden = slots_of(mixing.mix(table, block=64))
    assert golden == slots_of(mixing.mix(table.repartition(3), block=64))
    monkeypatch.setattr(mixing, "GOLDEN", 0.5)
    assert golden != slots_of(mixing.mix(table, block=64))

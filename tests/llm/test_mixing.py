from collections import Counter

import pytest
from helpers import CASES, documents

from tidemark.llm import mixing


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 0.9, "b": 0.05, "c": 0.03, "d": 0.02},
                                     {str(i): i + 1 for i in range(40)}])
def test_period_keeps_windows_and_shares(weights):
    slots = mixing.shares(weights)
    length = sum(slots.values())
    plan = mixing.period(slots)
    assert [slot for _, _, slot, _, _ in plan] == list(range(length))
    done = Counter()
    for source, block, slot, release, deadline in plan:
        assert release <= slot < deadline and block == done[source]
        done[source] += 1
        for s, w in slots.items():
            assert abs(done[s] * length - w * (slot + 1)) < length
    assert done == slots


def test_every_row_once_in_earliest_deadline_order(spark):
    rows = [(i, f"t{i}", "en", "big" if i % 3 else "small", i) for i in range(1000)]
    table = mixing.mix(documents(spark, rows), {"big": 2, "small": 1}, block_rows=8, resolution=3)
    got = sorted(table.collect(), key=lambda r: (r["mix_slot"], r["mix_place"]))
    assert sorted(r["doc_id"] for r in got) == list(range(1000))
    seen, slots = Counter(), mixing.shares({"big": 2, "small": 1}, 3)
    for r in got:
        n = seen[r["source"]]
        assert (r["mix_block"], r["mix_place"]) == (n // 8, n % 8)
        assert r["mix_release"] <= r["mix_slot"] < r["mix_deadline"]
        seen[r["source"]] += 1
        # Rows so far differ from the weights by less than a block each, and the one being filled.
        total = sum(seen.values())
        if seen["small"] < 300:
            assert abs(seen["big"] - total * slots["big"] / 3) <= 16


def test_cases(spark):
    rows = [*CASES, (50, "no source", None, None, 1)]
    table = mixing.mix(documents(spark, rows))
    got = table.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(((r[0], r[1]) for r in rows), key=repr)
    assert len({(r["mix_slot"], r["mix_place"]) for r in got}) == len(rows)
    assert mixing.mix(documents(spark, [])).collect() == []

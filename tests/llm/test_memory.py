"""Memory that the driver and idle Python workers give back."""

from types import SimpleNamespace

import pandas as pd
import pytest

from loadlake.llm import common, order_minhash


@pytest.mark.parametrize(("taken", "collected"), [(500, 0), (501, 1)])
def test_driver_collects_when_half_of_its_heap_is_taken(taken, collected):
    calls = []
    heap = SimpleNamespace(totalMemory=lambda: taken, maxMemory=lambda: 1000)
    runtime = SimpleNamespace(getRuntime=lambda: heap)
    lang = SimpleNamespace(Runtime=runtime, System=SimpleNamespace(gc=lambda: calls.append(1)))
    jvm = SimpleNamespace(java=SimpleNamespace(lang=lang))
    common.collect_driver(SimpleNamespace(sparkContext=SimpleNamespace(_jvm=jvm)))
    assert len(calls) == collected


def test_every_kept_table_is_followed_by_a_look_at_the_heap(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(common, "collect_driver", calls.append)
    tables = common.Tables(spark, "test")
    kept = tables.keep(spark.range(10))
    assert calls == [spark] and kept.count() == 10
    tables.drop(kept)


def test_sketches_and_alignments_give_memory_back_at_their_end(monkeypatch):
    calls = []
    monkeypatch.setattr(order_minhash, "give_back", lambda: calls.append(1))
    texts = [pd.Series([b"a b c d e f", None]), pd.Series([b"a b c d e f"])]
    told = list(order_minhash.sketches_of.func(iter(texts)))
    assert len(calls) == 1 and [len(x) for x in told] == [2, 1]
    assert told[0][0] == told[1][0] and told[0][1] is None
    pairs = [(texts[1], texts[1]), (texts[1], pd.Series([b"x y z"]))]
    assert [x.tolist() for x in order_minhash.alignment.func(iter(pairs))] == [[1.0], [0.0]] and len(calls) == 2

import pytest
from pyspark.sql import functions as F

from fleetscope.llm import mixing
from fleetscope.llm.mixing import mix, targets

from .conftest import LONG, documents


def test_targets_share_everything_and_stop_at_three_times():
    assert targets([100, 100, 100], [5, 2, 1]) == pytest.approx([187.5, 75, 37.5])
    got = targets([10, 500, 90], [5, 2, 1])
    assert got == pytest.approx([30, 380, 190]) and sum(got) == pytest.approx(600)
    assert targets([0, 5], [5, 2]) == [0, 5] and targets([], []) == []


@pytest.mark.parametrize("block", [None, 1, 7, 5000])
def test_every_source_comes_to_its_target(shipped, block):
    texts = [*("w " * (i % 9) for i in range(200)), None, "", LONG, "a b c"]
    docs = documents(shipped, texts, source=["b", "a", None, "c"])
    rows = mix(docs, block_words=block).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: r.size for r in rows}[204] == 2
    for s in {r.source for r in rows}:
        mine = [r for r in rows if r.source == s]
        assert sum(r.size for r in mine) == mine[0].source_size
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 1
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    again = mix(docs.repartition(5), block_words=block).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in rows}


def test_sources_are_cut_into_chunks(shipped, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 10)
    rows = mix(documents(shipped, ["a b c"] * 300), block_words=2).collect()
    assert sum(r.taken for r in rows) == 900 and len(rows) == 300


def test_repeated_rows_and_empty_tables(shipped):
    docs = documents(shipped, ["a b", "a b", "c"])
    twice = docs.union(docs)
    assert sum(r.taken for r in mix(twice).collect()) == 10 and mix(twice).count() == 6
    assert mix(docs.limit(0)).collect() == []
    assert [r.taken for r in mix(documents(shipped, [None, ""])).collect()] == [0, 0]


def test_prefixes_of_the_schedule_keep_the_shares(shipped):
    rows = mixing._schedule(shipped, 2000, [5.0, 2.0, 1.0]).orderBy("n").collect()
    for n in (100, 500, 2000):
        own = sum(r.rank_id == 0 for r in rows[:n])
        assert abs(own - n * 5 / 8) <= 4

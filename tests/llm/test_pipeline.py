import random

import pytest

import corpus_pipeline as cp
from tests.conftest import SF_MID, SF_SMALL, duck
from tests.helpers import canon

from .conftest import LONG, documents


@pytest.fixture(scope="module")
def odd(shipped):
    rng = random.Random(2)
    words = [f"word{i}" for i in range(400)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = line(80)
    texts = [*("\n".join(line(rng.randint(8, 30)) for _ in range(4)) for _ in range(40)), None, "", " ", LONG, long, long, long + " and more",
             "own line here is quite unique\n" + long, *["same text in some rows"] * 5]
    return documents(shipped, texts, source=["a", "b", None]), texts


def test_stages_keep_the_columns_and_take_odd_rows(shipped, odd, tmp_path):
    docs, texts = odd
    start = docs
    for name, stage in cp.STAGES:
        out = stage(shipped, docs, SF_SMALL)
        assert stage(shipped, start.limit(0), SF_SMALL).count() == 0, name
        if name != cp.STAGES[-1][0]:
            assert out.columns == start.columns, name
        out.write.parquet(path := str(tmp_path / name))
        docs = shipped.read.parquet(path)
    final = docs.collect()
    assert final and {"doc_id", "ids", "n_tokens"} <= set(docs.columns)


def test_line_dedup_drops_copies_and_keeps_the_rest(shipped, odd):
    docs, texts = odd
    left = {r.doc_id: r for r in cp.line_dedup(shipped, docs, SF_SMALL).collect()}
    at = {t: i for i, t in enumerate(texts, 1) if t}
    first = texts.index(next(t for t in texts if t and t.count(" ") == 79 and "\n" not in t)) + 1
    assert first in left and first + 1 not in left
    assert left[first + 3].text == "own line here is quite unique" and left[first + 3].n_chars == 29
    assert {41, 42, 43} <= set(left) and left[41].text is None
    assert sum(r.text == "same text in some rows" for r in left.values()) == 1 and len(at) > 0


def test_near_duplicates_leave_one_of_each_group(shipped, odd):
    docs, texts = odd
    left = [r.doc_id for r in cp.near_duplicates(shipped, docs, SF_SMALL).collect()]
    first = next(i for i, t in enumerate(texts, 1) if t and t.count(" ") == 79 and "\n" not in t)
    assert first in left and first + 1 not in left and first + 2 not in left and first + 3 not in left
    assert {41, 42, 43} <= set(left) and len(left) == len(set(left)) == len(texts) - 3 - 4


def test_mix_repeats_at_most_three_times(shipped, odd):
    docs, _ = odd
    rows = cp.source_mix(shipped, docs, SF_SMALL).groupBy("doc_id").count().collect()
    assert rows and max(r["count"] for r in rows) <= 3


def test_documents_stay_where_they_are_read(shipped, tmp_path):
    """The rows kept and their copies come to the documents, also when no table is small enough to be broadcast by itself."""
    texts = [" ".join(f"w{i * k % 97}" for k in range(3, 20)) for i in range(90)]
    documents(shipped, texts, source=["a", "b"]).write.parquet(path := str(tmp_path / "docs"))
    docs = shipped.read.parquet(path)
    old = shipped.conf.get("spark.sql.autoBroadcastJoinThreshold")
    shipped.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for stage in (cp.near_duplicates, cp.source_mix):
            out = stage(shipped, docs, SF_SMALL)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    finally:
        shipped.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("most", [1 << 22, 0])
def test_rows_by_their_copies(shipped, monkeypatch, most):
    monkeypatch.setattr(cp, "MOST_BLOCKS", most)
    want = {r: r % 4 for r in [*range(200), *range(5 << 40, (5 << 40) + 70)]}
    keyed = shipped.createDataFrame([(r, (r, "t")) for r in want], "row long, doc struct<doc_id: long, text: string>")
    copies = shipped.createDataFrame([(r, n) for r, n in want.items() if n], "row long, n int")
    got = cp._copied(keyed, copies).collect()
    assert len(got) == sum(n > 0 for n in want.values()) and {r.doc.doc_id: r.n for r in got} == {r: n for r, n in want.items() if n}
    assert cp._copied(keyed, copies.limit(0)).collect() == []


def test_toxicity_keeps_clean_documents(shipped):
    docs = shipped.read.parquet(f"{SF_MID}/documents.parquet")
    labels = shipped.read.parquet(f"{SF_MID}/labels.parquet")
    left = cp.toxicity(shipped, docs, SF_MID)
    assert left.columns == docs.columns
    clean = labels.filter("toxic = 0").join(docs, "doc_id")
    assert clean.join(left, "doc_id", "left_anti").count() <= 0.01 * clean.count()


def test_queries_with_sql_agree_with_it(shipped):
    from fleetscope.llm.queries import QUERIES, SQL
    con = duck(SF_SMALL)
    for name, sql in SQL.items():
        assert canon(QUERIES[name](shipped, SF_SMALL).toPandas()) == canon(con.execute(sql).df()), name

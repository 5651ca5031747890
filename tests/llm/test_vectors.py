"""Vector searches and the pipeline against brute force."""

import math
import re

import numpy as np
import pytest

from plinth.llm.elias_fano import Level, Sequence, encode
from plinth.llm.exact_top import exact_top
from plinth.llm.neighbours import nearest
from plinth.llm.queries import QUERIES
from plinth.llm.vectors import usable
from plinth.runtime import cut
from tests.conftest import SF_DIR


def awkward(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(120)]
    rows += [(i, [1.0, 2.0, 0.0, 0.0, 1.0]) for i in range(200, 260)]
    rows += [(300, None), (301, [1.0, None, 2.0, 0.0, 0.0]), (302, [math.nan] * 5), (303, [math.inf] + [0.0] * 4), (304, []), (305, [0.0] * 5)]
    rows += [(None, [1.0] * 5), (306, [2.0, 1.0]), (100, [9.0] * 5)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS id", "'y' AS vector")


def plain(table, ids, k):
    pad = lambda v: np.pad(v, (0, 5 - len(v)))
    held = {r.id: pad(np.array(r.vector)) for r in table.collect()}
    out = []
    for q in sorted(x for x in held if x in ids):
        order = sorted((-float(held[q] @ v), i) for i, v in held.items() if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(order)]
    return out


def test_exact_top(spark):
    vectors = cut(usable(awkward(spark), "vec_id", "embedding"))
    rows = cut(vectors.selectExpr("id", "transform(vector, x -> cast(x AS bigint)) AS weights"))
    expected = plain(vectors, set(range(0, 400, 4)), 7)
    for blocks in ((1 << 13, 1 << 10), (17, 5)):
        got = exact_top(rows, rows.where("id % 4 = 0"), 7, *blocks).orderBy("query_id", "rank").collect()
        assert [tuple(r) for r in got] == expected
    assert exact_top(rows.limit(0), rows.limit(0), 7).collect() == []
    assert exact_top(rows.where("id = 0"), rows.where("id = 0"), 7).collect() == []


def test_exact_top_of_repeated_and_empty(spark, tmp_path):
    """Repeated ids are candidates each, empty vectors score 0, the smallest of a query id's vectors asks."""
    rows = [(i, [float(i % 7), float(-i % 5), 1.0]) for i in range(90, 140)]
    rows += [(100, [9.0, 9.0, 9.0]), (101, [5.0, 5.0, 5.0]), (101, [5.0, 5.0, 5.0]), (150, []), (200, []), (151, None), (None, [1.0] * 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    table.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = [tuple(r) for r in QUERIES["op8_exact_top"](spark, str(tmp_path)).orderBy("query_id", "rank").collect()]
    held = [(i, [int(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None]
    expected = []
    for q in (100, 200):
        own = min(v for i, v in held if i == q)
        best = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in held if i != q)[:10]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == expected


def test_exact_top_broadcasts_nothing(spark):
    """the few queries looked small to the planner, but a copy of them per row block went through the driver."""
    rows = spark.range(0, 3000).selectExpr("id", "array(id, 1L, -id) AS weights")
    found = exact_top(rows, rows.where("id % 100 = 0"), 5, 100, 10)
    assert found.count() == 150
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [row_block" in plan and "BroadcastHashJoin" not in plan


def test_nearest(spark):
    vectors = cut(usable(awkward(spark), "vec_id", "embedding", zeros=False))
    expected = plain(vectors, set(range(0, 400, 4)), 6)
    got = [tuple(r) for r in nearest(vectors, vectors.where("id % 4 = 0"), 6).orderBy("query_id", "rank").collect()]
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    best = {(r[0], r[2]) for r in expected}
    assert len({(r[0], r[2]) for r in got} & best) >= 0.9 * len(best)
    assert nearest(vectors.limit(0), vectors.limit(0), 6).collect() == []
    assert nearest(vectors.where("id = 0"), vectors.where("id = 0"), 6).collect() == []


def test_recall(spark):
    got = QUERIES["op7_neighbours"](spark, SF_DIR).collect()
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    hits = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        score = x @ x[at]
        score[at] = -9
        own = {r.vec_id: r for r in got if r.query_id == ids[at]}
        assert all(abs(r.score - score[np.searchsorted(ids, i)]) < 1e-12 for i, r in own.items())
        best = ids[np.lexsort((ids, -score))[:20]].tolist()
        hits, total = hits + len(own.keys() & set(best)), total + len(best)
    assert hits >= 0.9 * total


@pytest.mark.parametrize("kind", ["spread", "lognormal", "one huge"])
def test_recall_with_unequal_norms(spark, kind):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "one huge":
        x[1234] *= 1e5
    else:
        x *= (rng.uniform(0.5, 2, 3000) if kind == "spread" else rng.lognormal(0, 1, 3000))[:, None]
    vectors = cut(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>"))
    got = nearest(vectors, vectors.where("id % 20 = 0"), 20).collect()
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    best = np.argsort(-score, axis=1, kind="stable")[:, :20]
    hits = sum(r.vec_id in best[r.query_id] for r in got)
    assert len(got) == 3000 and hits >= 0.9 * 3000
    assert all(abs(r.score - score[r.query_id, r.vec_id]) <= 1e-9 * max(1, abs(r.score)) for r in got)


@pytest.mark.parametrize("n,top", [(1, 0), (7, 3), (1000, 1000), (1000, 10**6), (3000, 10**12), (0, 0)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top + 1, n))
    assert (Sequence(encode(values)).access(np.arange(n)) == values).all()


@pytest.mark.parametrize("parents,size", [(1, 1), (50, 3), (400, 100_000), (300, 4_000_000)])
def test_level(parents, size):
    rng = np.random.default_rng(size)
    pairs = np.unique(np.stack([rng.integers(0, parents, 2000), rng.integers(0, size, 2000)], axis=1), axis=0)
    level = Level(Level.encode(parents, pairs[:, 0], pairs[:, 1]))
    assert (level.find(pairs[:, 0], pairs[:, 1])[0] == np.arange(len(pairs))).all()
    asked = np.stack([rng.integers(0, parents, 2000), rng.integers(0, size, 2000)], axis=1)
    place = {tuple(p): i for i, p in enumerate(pairs.tolist())}
    assert level.find(asked[:, 0], asked[:, 1])[0].tolist() == [place.get(tuple(p), -1) for p in asked.tolist()]


def test_pipeline_keeps_what_loses_nothing(spark):
    import corpus_pipeline as pipeline

    passage = " ".join(f"p{i}" for i in range(20))
    rows = [
        (1, f"one\n\n{passage}\ttail ", "en", "a", 7), (2, f"two\n{passage}\nend", "de", "b", 9), (3, passage, "en", "c", None),
        (4, None, None, "d", 0), (5, " \n", "fr", None, 2), (None, f"x\n{passage}", "en", "e", 1),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(map(tuple, pipeline.drop_repeats(spark, table, "").collect()), key=repr)
    changed = {2: (2, "two end", "de", "b", 7), 3: (3, "", "en", "c", 0)}
    assert got == sorted((changed.get(r[0], r) for r in rows), key=repr)


def test_pipeline_texts_of_the_third_stage(spark):
    """The stage's texts against a plain loop over the whole table."""
    import corpus_pipeline as pipeline

    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*pipeline.COLUMNS).collect()
    word, first = re.compile(r"[^\x20\x09-\x0D]+"), {}
    words = {r.doc_id: word.findall(r.text or "") for r in rows}
    for d, own in words.items():
        for i in range(len(own) - 12):
            key = tuple(own[i:i + 13])
            first[key] = min(d, first.get(key, d))
    expected = {}
    for r in rows:
        own = words[r.doc_id]
        gone = {i + k for i in range(len(own) - 12) if first[tuple(own[i:i + 13])] < r.doc_id for k in range(13)}
        text = " ".join(w for i, w in enumerate(own) if i not in gone)
        expected[r.doc_id] = (text, len(text)) if gone else (r.text, r.n_chars)
    got = pipeline.drop_repeats(spark, spark.createDataFrame(rows), "").collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in got} == expected and len(got) == len(rows)


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    scores = {r.doc_id: r.predicted for r in QUERIES["op9_toxicity"](spark, SF_DIR).collect()}
    clean = cut(pipeline.STAGES[0][1](spark, docs, SF_DIR))
    assert clean.columns == docs.columns
    assert {r.doc_id: r for r in clean.collect()} == {d: r for d, r in before.items() if not scores[d]}
    single = cut(pipeline.STAGES[1][1](spark, clean, SF_DIR))
    sets = {}
    for r in clean.collect():
        words = r.text.lower().split()
        sets[r.doc_id] = frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))
    root = dict(zip(sets, sets))

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r.doc_id for r in single.collect()} == {d for d in sets if find(d) == d}
    rest = cut(pipeline.STAGES[2][1](spark, single, SF_DIR))
    assert rest.columns == docs.columns and rest.count() == single.count()
    packed = pipeline.STAGES[3][1](spark, rest, SF_DIR).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rest.collect()}
    assert sorted(map(tuple, pipeline.run(spark, SF_DIR).drop("sequence_id", "offset").collect())) == sorted(
        tuple(v for k, v in r.asDict().items() if k not in ("sequence_id", "offset")) for r in packed
    )


def test_long_runs_and_gaps_of_a_level():
    """op6: buckets that fill whole words, start at any bit and end in a later word."""
    rng = np.random.default_rng(3)
    for dense, gap in ((700, 3), (130, 10**5), (64, 10**9)):
        child = np.concatenate([np.arange(dense) + start for start in np.cumsum(rng.integers(dense, dense + gap, 40))])
        parent = np.repeat([2, 5], [len(child) // 2, len(child) - len(child) // 2])
        level = Level(Level.encode(9, parent, child))
        assert (level.find(parent, child)[0] == np.arange(len(child))).all()
        asked = rng.integers(0, child[-1] + 2, 5000)
        owner = rng.integers(0, 9, 5000)
        place = {p: i for i, p in enumerate(zip(parent.tolist(), child.tolist()))}
        assert level.find(owner, asked)[0].tolist() == [place.get(p, -1) for p in zip(owner.tolist(), asked.tolist())]

"""What a reviewer found on larger tables: the work of near-dedup and of the search."""

import random

import numpy as np

from tidewell.llm import neardup, vectors


def common_tails(n, head=30, tail=110):
    """Texts of one long tail and heads of their own, some of them near copies of one before: similarities about the threshold."""
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(60)]
    heads = []
    for k in range(n):
        one = [rng.choice(vocabulary) for _ in range(head)]
        if k % 3 == 2:
            one = [w if rng.random() < 0.9 else rng.choice(vocabulary) for w in heads[-1]]
        heads.append(one)
    return [" ".join(h + ["is", "on"] * (tail // 2)) for h in heads]


def classes_by_brute_force(texts):
    words = [neardup.Words()(t) for t in texts]
    name = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if name[i] != name[j] and neardup.similar(words[i], words[j]):
                name = [min(name[i], name[j]) if x in (name[i], name[j]) else x for x in name]
    return name


def test_blocks_give_fewer_pairs_than_members(spark):
    texts = common_tails(120)
    words = [neardup.Words()(t) for t in texts]
    rows = [(0, 1, len(texts), k, k, len(w), [1], neardup.held_of(w)) for k, w in enumerate(words)]
    members = spark.createDataFrame(rows, "band int, value long, n long, node long, root long, size int, keys array<long>, held binary")
    spared, all_pairs = (neardup.unlinked_pairs(members, x).select("a", "b").collect() for x in (True, False))
    assert {tuple(r) for r in all_pairs} == {(i, j) for j in range(len(words)) for i in range(j) if neardup.similar(words[i], words[j])}
    assert len(spared) < len(texts) < len(all_pairs)
    root = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame(spared, "a long, b long")).collect()}
    assert [root.get(k, k) for k in range(len(texts))] == classes_by_brute_force(texts)


def test_links_that_do_not_hold_spare_nothing(spark, monkeypatch):
    """Words that all look alike in a block join every pair there; the classes stay those of whole words."""
    texts = common_tails(24)
    monkeypatch.setattr(neardup, "ROUNDS", 1)
    monkeypatch.setattr(neardup, "held_of", lambda words: b"\0\0" * len(words))
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs)[0].collect()}
    assert [got[k] for k in range(len(texts))] == classes_by_brute_force(texts)


def rows_made(df):
    """Most rows that one of a collected frame's Python steps gave."""
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        else:
            todo += [node.children().apply(k) for k in range(node.children().size())]
        if name.endswith("InArrow"):
            found = max(found, node.metrics().apply("pythonNumRowsReceived").value())
    return found


def test_search_gives_as_many_rows_from_more_units(spark, monkeypatch):
    """What a query gives follows the splits, which are fixed, not the units, which grow with the rows."""
    monkeypatch.setattr(vectors, "SPLITS", 4, raising=False)
    x = np.random.default_rng(5).normal(size=(1600, 16))
    x[:300] = x[0]
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = []
    for unit in (400, 50):
        monkeypatch.setattr(vectors, "LEAST_UNIT", unit)
        monkeypatch.setattr(vectors, "UNIT", unit)
        index = vectors.index_of(rows)
        queries = index.coded.where("vec_id % 20 = 0")
        near = index.run(queries, 80)
        got = {}
        for r in near.collect():
            got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert set(got) == set(range(0, 1600, 20)) and all(len(set(i)) == 20 for i in got.values())
        hits = 0
        for q, ids in got.items():
            score = (x * x[q]).sum(axis=1)
            score[q] = -np.inf
            hits += len(set(ids) & set(np.lexsort((np.arange(1600), -score))[:20].tolist()))
        assert hits >= 0.9 * 20 * 80
        found.append(rows_made(near))
    assert 80 * 20 <= min(found) and max(found) <= 80 * 20 * 4

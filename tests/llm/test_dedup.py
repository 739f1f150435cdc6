"""Fingerprints, lines, near copies, vectors: against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import fingerprints, lines, neardup, vectors

R = random.Random(5)
WORDS = [f"w{k}" for k in range(3000)]


def prose(n):
    return " ".join(R.choice(WORDS) for _ in range(n))


def edited(text, k):
    words = text.split()
    for _ in range(k):
        i = R.randrange(len(words))
        words[i : i + 1] = R.choice([[], [R.choice(WORDS)], [words[i], R.choice(WORDS)]])
    return " ".join(words)


def test_edits_and_next(spark, odd, docs, empty):
    for df in (odd, docs, docs.repartition(5)):
        got = fingerprints.fingerprint(df).select("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next", "sketch").collect()
        want = sorted(((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        assert len(got) == len(want)
        expected = []
        for k, (i, t) in enumerate(want):
            m = len(t) // 4
            e = t[: len(t) - m] + want[(k + 1) % len(want)][1][:m]
            expected.append((i if i is not None else -1, len(t), hashlib.sha256(e.encode()).hexdigest()))
        assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_chars"], r["edited_sha256"]) for r in got) == sorted(expected)
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprints.fingerprint(empty).count() == 0


def slow_sketch(text):
    """The sketch word by word, with the xxhash library."""
    import struct

    import xxhash

    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x

    def chained(longs):
        seed = 42
        for x in longs:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
        return signed(seed)

    import re

    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w]
    if len(words) < fingerprints.WORDS:  # the whole text, hashed as an array
        hashes = [chained(words)] if words else []
    else:
        hashes = [chained(words[k : k + fingerprints.WORDS]) for k in range(len(words) - fingerprints.WORDS + 1)]
    bound = -(1 << 63) + int(fingerprints.FRACTION * (1 << 64))
    return {x for x in hashes if x < bound} or set(sorted(hashes)[:1])


def slow_likeness(a, b):
    least = min(len(a), len(b))
    return len(a & b) / least if least else float(len(a) == len(b))


def test_op1_is_brute_force(spark):
    """Every row of the query again in plain Python."""
    sf = "/root/testdata/sf0.001"
    rows = sorted(((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    got = {r["doc_id"]: r for r in fingerprints.query(spark, sf).collect()}
    assert len(got) == len(rows)
    sketches = [slow_sketch(t) for _, t in rows]
    write = lambda s: "".join(f"{x & (1 << 64) - 1:016X}" for x in sorted(s))
    for k, (i, t) in enumerate(rows):
        after = (k + 1) % len(rows)
        m = len(t) // 4
        e = t[: len(t) - m] + rows[after][1][:m]
        want = (len(t), hashlib.sha256(e.encode()).hexdigest(), write(sketches[k]), write(slow_sketch(e)))
        assert (got[i]["n_chars"], got[i]["edited_sha256"], got[i]["fingerprint"], got[i]["edited_fingerprint"]) == want
        assert got[i]["near_edited"] == slow_likeness(sketches[k], slow_sketch(e)) and got[i]["near_next"] == slow_likeness(sketches[k], sketches[after])


def test_one_row_follows_itself(frame):
    r = fingerprints.fingerprint(frame([(1, "a b c d e f g h", "s")])).collect()[0]
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"a b c d e f a b").hexdigest()


def test_sketch_is_threshold_and_merges(spark):
    texts = [prose(400), prose(30), "a b", "", edited(prose(400), 3)]
    df = spark.createDataFrame([(t, u) for t in texts for u in texts], "t string, u string")
    got = df.select(
        fingerprints.sketch(F.col("t")).alias("a"), fingerprints.shingle_hashes(F.col("t")).alias("h"), fingerprints.sketch(F.col("t"), 1.0).alias("all"),
        fingerprints.merged(fingerprints.sketch(F.col("t")), fingerprints.sketch(F.col("u"))).alias("m"), fingerprints.sketch(F.col("u")).alias("b"), "t",
    ).collect()
    bound = -(1 << 63) + int(fingerprints.FRACTION * (1 << 64))
    for r in got:
        assert len(r["h"]) == (max(1, len(r["t"].split()) - 4) if r["t"] else 0)
        kept = sorted(x for x in set(r["h"]) if x < bound) or sorted(r["h"])[:1]
        assert r["a"] == kept
        low = sorted(x for x in {*r["a"], *r["b"]} if x < bound)
        assert r["m"] == (low or sorted({*r["a"], *r["b"]})[:1])


def test_likeness_estimates_containment(spark):
    base = prose(4000)
    part = " ".join(base.split()[:1000])
    r = spark.createDataFrame([(base, part)], "a string, b string").select(fingerprints.likeness(fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))).alias("x")).collect()
    assert r[0]["x"] == 1.0


def slow_lines(rows, sites):
    spread, whole = {}, {}
    for _, t, s in rows:
        whole.setdefault(t, set()).add(s)
        for x in (t or "").split("\n"):
            if x.strip(" \t\r"):
                spread.setdefault(x.strip(" \t\r"), set()).add(s)
    bad = {x for x, s in spread.items() if len(s) >= sites}
    out = []
    for i, t, _ in rows:
        parts = (t or "").split("\n")
        hit = sum(p.strip(" \t\r") in bad for p in parts)
        if t and hit and len(whole[t]) < sites:
            out.append((i, "\n".join(p for p in parts if p.strip(" \t\r") not in bad), hit))
        else:
            out.append((i, t, 0))
    return out


@pytest.mark.parametrize("sites", [3, 10, 14])
def test_lines_are_exact(frame, sites, monkeypatch):
    common_ = [f"shared line {k}" for k in range(30)]
    rows = []
    for i in range(200):
        own = [prose(12) for _ in range(4)]
        for k, line in enumerate(common_):
            if R.random() < (k + 1) / 40:
                own.insert(R.randrange(len(own) + 1), R.choice(["", "  "]) + line)
        rows.append((i, "\n".join(own[:12]), f"s{R.randrange(16)}"))
    rows += [(300, None, "a"), (301, "", "a"), (302, "\n\n", None), (303, "shared line 29", "b"), (303, "shared line 29", "b"), (None, "x\nshared line 29\nlong enough text here", None)]
    rows += [(400 + k, "a copy on many sites\nof two lines", f"s{k}") for k in range(12)]
    got = lines.clean(frame(rows), sites)
    monkeypatch.setattr(lines, "BROADCAST_LINES", 1)  # all joins by shuffle, hot lines dealt out
    dealt = lines.clean(frame(rows, "h1 long, removed string"), sites)
    assert sorted(map(repr, got.select("doc_id", "text", "removed").collect())) == sorted(map(repr, dealt.select("doc_id", "text", "removed").collect()))
    assert sorted(map(repr, ((r["doc_id"], r["text"], r["removed"]) for r in got.collect()))) == sorted(map(repr, slow_lines(rows, sites)))
    assert got.columns[:-1] == frame(rows).columns


def test_lines_leave_the_most_affected_pages(spark, frame):
    """A short article under a long notice loses the notice; copies of a whole text stay."""
    import corpus_pipeline

    notice = "\n".join(f"long notice line {k} of every site" for k in range(4))
    copy = "a copied article\nwith its second line"
    rows = [(i, f"own article {i} of a page\n{notice}", f"s{i}") for i in range(12)] + [(20 + i, copy, f"s{i}") for i in range(12)]
    rows += [(40, notice, "s1"), (41, notice + "\n" + copy, "s2"), (42, None, "s3"), (43, "", "s4")]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.drop_boilerplate(spark, frame(rows), "").collect()}
    assert len(got) == len(rows)
    for i in range(12):
        text = f"own article {i} of a page"
        assert got[i] == (text, len(text)) and got[20 + i] == (copy, len(copy))
    assert got[40] == got[41] == got[43] == ("", 0) and got[42][0] is None


def test_lines_empty(empty):
    assert lines.clean(empty).count() == 0


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment():
    for _ in range(150):
        a = [R.randrange(5) for _ in range(R.randrange(0, 40))]
        b = list(a) if R.random() < 0.6 else [R.randrange(5) for _ in range(R.randrange(0, 40))]
        for _ in range(R.randrange(0, 8)):
            if b:
                b[R.randrange(len(b))] = R.randrange(6)
            if b and R.random() < 0.3:
                del b[R.randrange(len(b))]
        d = slow_distance(a, b)
        for most in (0, 3, 10, 60):
            got = neardup.distance_within(np.array(a, np.uint64), np.array(b, np.uint64), most)
            assert got == d if d <= most else got > most, (a, b, most)


def test_sketch_is_sensitive_to_order():
    words = neardup.Words()
    a = prose(300)
    assert (neardup.order_min_hash(words(a)) == neardup.order_min_hash(words(a))).all()
    half = " ".join(a.split()[150:] + a.split()[:150])
    same = (neardup.order_min_hash(words(a), 64) == neardup.order_min_hash(words(half), 64)).mean()
    near = (neardup.order_min_hash(words(a), 64) == neardup.order_min_hash(words(edited(a, 3)), 64)).mean()
    assert near > 0.6 and same < near
    assert len(neardup.kmers(words("a a a a a a a"))) == len(set(neardup.kmers(words("a a a a a a a")).tolist())) == 3


def test_near_copies(frame):
    rows, want, n = [], {}, 0
    for g in range(25):
        base = prose(R.randrange(60, 250))
        for c in range(R.choice([1, 2, 5])):
            rows.append((n, base if c % 2 else edited(base, 3) if c else base, "s"))
            want[n] = g
            n += 1
    passage = prose(60)
    for g in range(25, 45):  # a shared passage is no near copy
        rows.append((n, passage + " " + prose(120), "s"))
        want[n] = g
        n += 1
    out, links = neardup.classes(frame(rows))
    got = {r["doc_id"]: r["class_id"] for r in out.collect()}
    assert len(got) == n
    least = {}
    for i, g in want.items():
        least.setdefault(g, i)
    assert got == {i: least[g] for i, g in want.items()}
    kept = neardup.deduplicate(frame(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values()) and kept.columns == frame(rows).columns


def similar_pairs(texts):
    """Pairs of texts at edit similarity 0.8 over words, by brute force."""
    words = neardup.Words()
    w = [words(t) for t in texts]
    return {(i, j) for i in range(len(w)) for j in range(i) if neardup.distance_within(w[i], w[j], m := int(0.2 * max(len(w[i]), len(w[j])) + 1e-9)) <= m}


def test_every_member_of_a_bucket_is_compared(frame):
    """Many texts of one template, pairs of them near copies: none is dropped after some leaders."""
    passage = prose(170)
    texts = []
    for _ in range(40):
        own = prose(70)
        texts += [f"{passage} {own}", f"{passage} {edited(own, 15)}"]
    R.shuffle(texts)
    out, _ = neardup.classes(frame([(i, t, "s") for i, t in enumerate(texts)]))
    got = {r["doc_id"]: r["class_id"] for r in out.collect()}
    want = similar_pairs(texts)
    assert len(want) == 40 and all(got[i] == got[j] for i, j in want) and len(set(got.values())) == 40


def test_scattered_edits_share_a_bucket():
    """At an edit similarity of 0.8 by substitutions anywhere, hardly a pair shares no bucket."""
    words, met = neardup.Words(), 0
    for _ in range(150):
        a = prose(240).split()
        b = list(a)
        for i in R.sample(range(240), 48):
            b[i] = "other"
        met += bool((neardup.band_values(words(" ".join(a))) == neardup.band_values(words(" ".join(b)))).any())
    assert met >= 0.95 * 150


def test_bound_by_counts_never_rejects():
    words = neardup.Words()
    texts = [prose(100) for _ in range(5)]
    texts += [prose(130), "many " * 700 + prose(20)]
    texts += [edited(t, k) for t in texts for k in (3, 10, 20, 30)] + ["", "a", "a a a a"]
    w = [words(t) for t in texts]
    sizes, counts = np.array([len(x) for x in w]), [neardup.word_counts(x) for x in w]
    may = neardup.may_be_similar(sizes, counts, sizes, counts, np.ones((len(w), len(w)), bool))
    assert all(may[i, j] for i in range(len(w)) for j in range(len(w)) if neardup.similar(w[i], w[j])) and not may.all()


def test_near_copies_odd(frame, odd, empty):
    out, _ = neardup.classes(odd)
    got = {r["doc_id"]: (r["class_id"], r["copies"]) for r in out.collect()}
    assert got[1][0] == got[2][0] == 1 and got[6] == (6, 2) and got[2][1] == 2 and got[None] == (None, 1)
    kept = neardup.deduplicate(odd)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7]
    assert neardup.deduplicate(empty).count() == 0


def test_hot_keys_are_dealt(frame, spark, monkeypatch):
    """Every key hot, by broadcast marks and without: the same classes."""
    base = [prose(80) for _ in range(12)]
    rows = [(k, base[k % 12] if k % 3 else edited(base[k % 12], 4), "s") for k in range(90)] + [(None, "a null id's text", "s"), (None, "another one of these", "s")]
    want = {(r["doc_id"], r["t1"]): r["class_id"] for r in neardup.classes(frame(rows))[0].collect()}
    monkeypatch.setattr(neardup, "HOT", 1)
    for most in (1000, 1):
        monkeypatch.setattr(neardup, "BROADCAST_KEYS", most)
        assert {(r["doc_id"], r["t1"]): r["class_id"] for r in neardup.classes(frame(rows))[0].collect()} == want
    kept = neardup.deduplicate(frame(rows)).collect()
    assert len({r["text"] for r in kept}) == len(kept) and sum(r["doc_id"] is None for r in kept) == 2


def test_all_pairs(spark):
    """sf0.001 and one text edited at growing distance: links are those of all pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    base = prose(200)
    more = spark.createDataFrame([(10_000 + k, edited(base, k)) for k in range(0, 36, 4)] + [(20_000 + k, " ".join(R.sample(base.split(), 170))) for k in range(3)], docs.schema)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.unionByName(more).collect()]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in similar_pairs([t for _, t in rows]):
        root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(i, least.get(find(k), i))
    out, _ = neardup.classes(docs.unionByName(more))
    got = {r["doc_id"]: r["class_id"] for r in out.collect()}
    want = {i: least[find(k)] for k, (i, _) in enumerate(rows)}
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want) and all(got[i] >= want[i] for i in want)


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, 103), (101, 103), (102, 101), (200, 200)]
    got = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(61)) and all(got[k] == 100 for k in range(100, 104))


def test_vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[100:500] = x[100]  # copies of one vector
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)] + [(2000, None, 1), (2020, [0.0] * 16, 1), (2040, [float("nan")] * 16, 1), (2060, [1.0], 1), (2080, [None] * 16, 1), (None, x[0].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int")
    got = {}
    for r in vectors.search(df).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    wide = x.astype(float)
    assert set(got) == set(range(0, 1500, 20))
    hits = 0
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21))
        score = wide @ wide[q]
        ranked = [found[k] for k in range(1, 21)]
        assert ranked == sorted(ranked, key=lambda z: (-z[1], z[0])) and all(i != q and abs(s - score[i]) < 1e-9 for i, s in ranked)
        score[q] = -np.inf
        best = sorted(range(1500), key=lambda i: (-round(score[i], 9), i))[:20]
        hits += len({i for i, _ in ranked} & set(best))
    assert hits >= 0.9 * 20 * len(got)


def test_index_prunes_and_splits(spark, monkeypatch):
    """With several times more cells than are visited, units and parts of a few rows: recall against brute force, ties by the smaller id."""
    monkeypatch.setattr(vectors, "LEAST_UNIT", 64)
    monkeypatch.setattr(vectors, "UNIT", 64)
    monkeypatch.setattr(vectors, "PART", 32)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 24)).repeat(60, axis=0) + 0.3 * rng.normal(size=(2400, 24))
    x[:800] = x[0]  # a third are copies
    index = vectors.index_of(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>"))
    assert index.index.probes < len(index.index.cells) == 49 and index.recall >= vectors.TARGET_RECALL and (index.index.first + index.index.units).max() > 30
    queries = index.coded.where("vec_id % 20 = 0")
    hits = 0
    got = {}
    for r in index.run(queries, queries.count()).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 2400, 20))
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21)) and [r[1:] for r in rows] == sorted((r[1:] for r in rows), key=lambda z: (-z[1], z[0]))
        score = (x * x[q]).sum(axis=1)
        score[q] = -np.inf
        want = np.lexsort((np.arange(2400), -score))[:20]
        hits += len({r[1] for r in rows} & set(want.tolist()))
        if q < 800:
            assert [r[1] for r in rows] == want.tolist()
    assert hits >= 0.9 * 20 * len(got)


def test_cells_are_topped_up():
    """A query whose cells hold fewer than k rows visits more."""
    index = vectors.Index(np.eye(8), 64)
    index.lay_out(dict.fromkeys(range(len(index.cells)), 3), 4)
    index.probes = 1
    units, reach = index.visits(np.eye(8)[:2], 5)
    assert all(len(u) >= 2 for u in units) and ((np.eye(8)[:2] @ index.cells.T >= reach[:, None] - 1e-9).sum(axis=1) * 3 >= 6).all()


def test_vectors_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in vectors.search(df).collect()] == [(0, 1, 1, 0.5)]
    assert vectors.search(df.where("vec_id > 5")).count() == 0

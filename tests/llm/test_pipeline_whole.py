"""The dedup stages of the pipeline: near copies by brute force, and one row of each group."""

import os
import random
import sys
import weakref

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from pagetide.llm import langid, shingles  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.01"


def shingle_set(text, width=5):
    words = brute.SPACED.findall((text or "").translate(brute.LOWER))
    return {" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def groups(texts):
    """For each text the position of the first one in its component, by all pairs that share a shingle."""
    sets, holders, root = [shingle_set(t) for t in texts], {}, list(range(len(texts)))
    pairs = 0

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders.get(g, ())}:
            if 5 * len(s & sets[j]) >= 4 * len(s | sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
                pairs += 1
        for g in s:
            holders.setdefault(g, []).append(i)
    return [top(i) for i in range(len(texts))], pairs


def near_family(seed, copies, words=150, edits=3):
    """A base and edited copies: near the base, often not near each other."""
    rng = random.Random(seed)
    base = [f"{rng.choice('bcdfg')}{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for k in range(copies):
        own = list(base)
        for at in rng.sample(range(words), rng.randrange(edits + 1)):
            own[at] = f"x{seed}_{k}_{at}"
        out.append(" ".join(own))
    return out


def same_groups(labels, first):
    seen, back = {}, {}
    return all(seen.setdefault(a, b) == b and back.setdefault(b, a) == a for a, b in zip(labels, first))


@pytest.mark.parametrize("block", [shingles.BLOCK, 200])
def test_near_copies_are_components(spark, block):
    """Families with chains of links and bridges, whole and with buckets cut into blocks."""
    texts = sorted({t for seed in range(4) for t in near_family(seed, 30)}) + ["a b", "A  b", "", " \n"]
    rows = [(k, t) for k, t in enumerate(texts)]
    found = shingles.near_copies(spark.createDataFrame(rows, "doc_id int, text string"), block=block)
    label = {r["id"]: r["label"] for r in found.collect()}
    want, pairs = groups(texts)
    assert pairs > 100 and len(label) == len(texts)
    assert same_groups([label[k] for k, _ in rows], want)


def test_near_fingerprints_are_candidates(spark):
    """The trie self-join finds what the buckets are kept from finding; its pairs are verified too."""
    base = near_family(70, 0, words=4000)[0].split()
    near = [" ".join([*base[:at], f"y{at}", *base[at + 1 :]]) for at in (7, 1900, 3000)]
    texts = [" ".join(base), *near, *(near_family(s, 0)[0] for s in range(71, 90)), "a b", "A  b"]
    # Unlike, though of one fingerprint: repeats count there and not in a set.
    words = base[:41]
    texts += [" ".join(words * 200), " ".join(words * 200 + base[41:61])]
    sets = [shingle_set(t) for t in texts]
    assert 5 * len(sets[-1] & sets[-2]) < 4 * len(sets[-1] | sets[-2])
    prints = [brute.fingerprint(t, 5) for t in texts]
    assert (prints[-1] ^ prints[-2]).bit_count() <= 4
    assert max((prints[0] ^ p).bit_count() for p in prints[1:4]) <= 4
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    # One bucket of very many minima, which only texts with nearly all their shingles in common share.
    found = {r["id"]: r["label"] for r in shingles.near_copies(table, bands=1, rows=3000).collect()}
    assert same_groups([found[k] for k in range(len(texts))], groups(texts)[0])


def test_one_worker_reads_the_texts_of_a_task(spark, monkeypatch):
    """Every Python function of a task has a worker of its own, and a worker's memory is the executor's."""
    plans, store = [], shingles.stored
    monkeypatch.setattr(shingles, "stored", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or store(df))
    found = shingles.near_copies(spark.createDataFrame([(1, "a b"), (2, None), (3, "A  b")], "doc_id int, text string"))
    labels = {r["id"]: r["label"] for r in found.collect()}
    assert labels[1] == labels[3] != labels[2]
    first = plans[0].split("Initial Plan")[0]  # that of adaptive execution repeats the nodes
    assert first.count("ArrowEvalPython") == 1


def test_a_scorer_ends_with_its_model():
    """A worker that goes on to other queries keeps neither the model nor the pieces it has scored."""
    table = langid.Table(np.zeros(0, np.int64), np.zeros((0, 1), np.float32))
    model = langid.Model(["en"], table, dict.fromkeys(langid.ORDERS, table))
    scorer = weakref.ref(langid.scorer_of(model))
    assert langid.scorer_of(model) is scorer()
    del model
    assert scorer() is None


def test_spanning_skips_nothing():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, 80).astype(np.uint64)) for _ in range(60)]
    links = shingles.spanning(sets, np.arange(60), np.arange(60), np.arange(60), (4, 5), cells=500)
    near = [
        (i, j) for i in range(60) for j in range(i)
        if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))
    ]

    def parts(pairs):
        root = list(range(60))
        for a, b in pairs:
            a, b = root[a], root[b]
            root = [min(a, b) if x in (a, b) else x for x in root]
        return root

    assert near and parts(links) == parts(near)
    assert all((max(p), min(p)) in near for p in links)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_near_stage_against_brute_force(spark):
    """On the given documents the stage keeps the smallest id of each component, no pair missed."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").dropDuplicates(["text"]).orderBy("doc_id")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    want, pairs = groups([t for _, t in rows])
    assert pairs
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, table, SF).collect())
    assert kept == [d for (d, _), k in zip(rows, want) if rows[k][0] == d]


def test_one_row_of_each_group_stays(spark):
    """Repeated rows, copies without ids, and one id with two texts."""
    a, b, c = near_family(90, 0)[0], near_family(91, 0)[0], near_family(92, 0)[0]
    rows = [
        (1, a, "en", "s", 3), (2, a, "en", "s", 3), (2, a, "en", "s", 3), (2, a, "fr", "s", 3), (None, a, None, None, None),
        (None, b, "en", "s", 1), (None, b, "en", "t", 1), (None, b + " x", "en", "s", 1), (None, b + " x", "en", "s", 1),
        (7, c, "en", "s", 1), (7, c + " x", "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    once = corpus_pipeline.drop_exact_copies(spark, docs, "")
    pairs = sorted(((r["doc_id"], r["text"]) for r in once.collect()), key=repr)
    assert pairs == sorted([(2, a), (None, b), (None, b + " x"), (7, c), (7, c + " x")], key=repr)
    assert once.columns == docs.columns
    # The near stage also by itself, on rows that exact dedup has not seen.
    for start, first in ((once, 2), (docs, 1)):
        near = corpus_pipeline.drop_near_copies(spark, start, "")
        assert sorted((r["doc_id"] for r in near.collect()), key=repr) == [first, 7, None]


def test_many_repeats_stay_once(spark):
    """A third of the rows is one row repeated; others carry maps and clashing names."""
    rows = [(5, near_family(95, 0)[0], {"k": 1}, 0)] * 100 + [
        (100 + k, t, {"k": k}, k) for k, t in enumerate(near_family(s, 0)[0] for s in range(200, 400))
    ]
    docs = spark.createDataFrame(rows, "doc_id int, text string, _row map<string,int>, _mark int").repartition(7)
    for stage in (corpus_pipeline.drop_exact_copies, corpus_pipeline.drop_near_copies):
        ids = sorted(r["doc_id"] for r in stage(spark, docs, "").collect())
        assert ids == [5, *range(100, 300)], stage.__name__

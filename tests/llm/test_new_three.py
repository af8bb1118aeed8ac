"""Phrases, hard negatives and near vectors: against brute force, and in their edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pagetide.llm import negatives, phrases, rotations

# ---------------------------------------------------------------- phrases


def brute_phrases(docs, least, inside, top):
    out = []
    by_lang = {}
    for lang, text in docs:
        by_lang.setdefault(lang or "und", []).append(text or "")
    for lang, texts in by_lang.items():
        f = Counter()
        for text in texts:
            lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
                words = re.findall("[^\x20\x09]+", piece)
                for k in range(1, 5):
                    f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        frequent = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in frequent.items():
            around = (
                c for q, c in frequent.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            )
            if any(100 * c >= inside * a for c in around):
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def found_phrases(spark, docs, **options):
    rows = spark.createDataFrame(docs, "lang string, text string")
    found = phrases.collocations(rows, **options)
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("top", [7, None])
def test_phrases_against_brute_force(spark, top):
    rng = random.Random(5)
    docs = []
    for _ in range(120):
        words = [rng.choice("Ab c d é z\x00 \x1c  x ß".split(" ")) for _ in range(rng.randrange(80))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ? "]) for w in words)
        docs.append((rng.choice(["en", "de", None]), text))
    docs += [("en", None), ("en", ""), (None, " . "), ("fr", "only once")] + docs[:5]
    options = dict(least=4, inside=80, top=top)
    assert found_phrases(spark, docs, **options) == brute_phrases(docs, 4, 80, top)


def test_phrases_over_slices_and_flushes(spark, monkeypatch):
    rng = random.Random(6)
    docs = [("en", " ".join(rng.choice("abcd") for _ in range(300))) for _ in range(4)]
    docs.append(("en", "w" * 300 + " a b " + "w" * 300 + ".c"))
    data = [phrases.pa.RecordBatch.from_pylist([{"lang": a, "text": b} for a, b in docs])]
    monkeypatch.setattr(phrases, "SLICE", 64)
    monkeypatch.setattr(phrases, "GATHERED", 50)
    got = Counter()

    def count(lang, codes, begins, names):
        for i in range(begins):
            for k in range(1, 5):
                words = [names[c] for c in codes[i : i + k]]
                if phrases.BREAK not in words:
                    got[tuple(w.decode() for w in words)] += 1
        return iter(())

    list(phrases.gather(iter(data), count))
    expected = Counter()
    for _, text in docs:
        for piece in text.split("."):
            words = piece.split()
            for k in range(1, 5):
                expected.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    assert got == expected


def test_phrases_of_saturated_filters(spark, monkeypatch):
    """Bits that are all set let everything pass and change nothing."""
    docs = [("en", "a b c d e f a b. a b c x y")] * 5 + [("en", "q r s t")]
    plain = found_phrases(spark, docs, least=5)
    monkeypatch.setattr(phrases, "bits_of", lambda found: phrases.Bits(spark, 15, b"\xff" * 4096))
    assert found_phrases(spark, docs, least=5) == plain == brute_phrases(docs, 5, 80, 2000)


def test_phrases_empty_and_wide_numbers(spark):
    assert found_phrases(spark, []) == []
    assert found_phrases(spark, [("en", "a b c")], least=30) == []
    big = 4 * 10**18
    candidates = spark.createDataFrame([("en", "a b", big, 2)], "lang string, phrase string, a bigint, length int")
    known = spark.createDataFrame([("en", "a", big), ("en", "b", big + 8)], "lang string, part string, f bigint")
    assert phrases.scored(candidates, known).first()["score"] == 2_000_000 * big // (2 * big + 8)


def test_phrases_clashing_columns(spark):
    rows = spark.createDataFrame([("en", "x y", 1, 2, "p")] * 6, "lang string, text string, n int, rank int, phrase string")
    assert phrases.collocations(rows, least=6).select("phrase", "n").collect() == [("x y", 12)]


# ---------------------------------------------------------------- hard negatives


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_negatives(rows, is_anchor, positives=5, negatives_=3, low=50, high=95):
    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if label is not None and usable(v)]
    order = lambda i: (i is None, i or 0)
    out = []
    for at, (i, label, v) in enumerate(rows):
        if i is None or not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), order(j), j, m) for n, (j, m, w) in enumerate(rows) if n != at]
        scored.sort(key=lambda s: s[:2])
        for p, _, j, m in [s for s in scored if s[3] == label][:positives]:
            fits = [s for s in scored if s[3] != label and low * -p <= 100 * -s[0] <= high * -p][:negatives_]
            out += [(i, j, rank, s[2], -p, -s[0]) for rank, s in enumerate(fits, 1)]
    return sorted(out, key=repr)


def found_negatives(spark, rows, every, **options):
    frame = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    found = negatives.mine(frame, negatives.F.col("vec_id") % every == 0, **options)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.select(*names).collect()), key=repr)


@pytest.mark.parametrize("chunk, anchor_block", [(7, 3), (2048, 512)])
def test_negatives_against_brute_force(spark, chunk, anchor_block):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 3)), np.round(rng.normal(size=3), 1).tolist()) for i in range(150)]
    rows += [(150, None, [1.0, 1.0, 1.0]), (155, 1, None), (160, 1, [1.0, None, 1.0]), (165, 1, [float("nan")] * 3)]
    rows += [(170, 1, [float("inf"), 0.0, 0.0]), (None, 0, [2.0, 2.0, 2.0]), (None, 1, [2.0, 2.0, 2.0]), (175, 2, [])]
    rows += [(180, 1, [1.5]), (185, 0, [1.0, 1.0, 1.0, 9.0]), (5, 0, rows[5][2]), (190, 2, [0.0, 0.0, 0.0])] + rows[:20]
    got = found_negatives(spark, rows, 5, chunk=chunk, anchor_block=anchor_block)
    assert got == brute_negatives(rows, lambda i: i % 5 == 0) and got


def test_negatives_one_hot_label_and_ties(spark):
    rows = [(i, 0 if i % 3 else 1, [1.0, 0.0]) for i in range(60)] + [(60 + i, 2, [0.9, 0.0]) for i in range(9)]
    got = found_negatives(spark, rows, 10, chunk=5, anchor_block=2)
    assert got == brute_negatives(rows, lambda i: i % 10 == 0) and {g[3] for g in got} <= set(range(60, 69))


def test_negatives_empty_and_large(spark):
    assert found_negatives(spark, [], 5) == []
    assert found_negatives(spark, [(1, 1, [1.0])], 5) == []
    big = 2.0**20  # products beyond what doubles hold exactly
    rows = [(0, 0, [big, 1 / 256]), (1, 0, [big, 3 / 256]), (2, 1, [big * 0.7, 1 / 256]), (3, 1, [big * 0.7, 0.0])]
    assert found_negatives(spark, rows, 2) == brute_negatives(rows, lambda i: i % 2 == 0)


# ---------------------------------------------------------------- near vectors


def brute_near(rows, least=0.95):
    fine = [usable(v) and any(v) for _, v in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if fine[a] and fine[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                x, y = x / abs(x).max(), y / abs(y).max()
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    smallest = {}
    for a in range(n):
        if rows[a][0] is not None:
            smallest[find(a)] = min(rows[a][0], smallest.get(find(a), rows[a][0]))
    found = [(rows[a][0], links[a], smallest.get(find(a)) if fine[a] else rows[a][0]) for a in range(n)]
    return sorted(((i, k, c, i is None if i is None or c is None else i == c) for i, k, c in found), key=repr)


def found_near(spark, rows, kind="double", **options):
    frame = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")
    found = rotations.near_vectors(frame, **options)
    return sorted((tuple(r) for r in found.select("id", "n_links", "component_id", "kept").collect()), key=repr)


def groups_of_vectors(rng, groups, size, dim, spread):
    out = []
    for _ in range(groups):
        centre = rng.normal(size=dim)
        out += [(centre + rng.normal(size=dim) * spread).tolist() for _ in range(size)]
    return out


@pytest.mark.parametrize("block", [4, 512])
def test_near_against_brute_force(spark, block):
    rng = np.random.default_rng(1)
    vectors = groups_of_vectors(rng, 12, 9, 24, 0.17) + groups_of_vectors(rng, 30, 1, 24, 1)
    vectors += vectors[:6] + [(3.0 * np.array(vectors[0])).tolist()] * 3 + [vectors[20]] * 15
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(vectors)), vectors)]
    got = found_near(spark, rows, block=block)
    assert got == brute_near(rows) and sum(g[1] for g in got) > 300


def test_near_edges(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(1, one), (1, one), (2, [0.99, 0.01, 0.0]), (None, one), (3, None), (4, []), (5, [0.0, 0.0, 0.0])]
    rows += [(6, [1.0, None, 0.0]), (7, [float("nan"), 0.0, 0.0]), (8, [float("inf"), 0.0, 0.0]), (9, [1.0, 0.0])]
    rows += [(10, [1e-200, 0.0, 0.0]), (11, [1e200, 1e198, 0.0]), (None, [0.0, 1.0, 0.0]), (None, [0.0, 1.0, -0.0]), (12, [-1.0, 0.0, 0.0])]
    rows += [(13, [2.0]), (14, [3.0]), (15, [-2.0])]
    assert found_near(spark, rows) == brute_near(rows)
    assert found_near(spark, []) == []
    assert found_near(spark, [(3, None)]) == [(3, 0, 3, True)]


def test_near_recall_at_the_threshold(spark):
    """Pairs of just 0.95 in 64 dimensions, the hardest there are: the operator finds 0.99 or more."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(1000):
        x, y = rng.normal(size=(2, 64))
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        rows += [(2 * i, x.tolist()), (2 * i + 1, (0.9501 * x + math.sqrt(1 - 0.9501**2) * y).tolist())]
    linked = sum(r[1] for r in found_near(spark, rows)) / len(rows)
    assert linked >= 0.99


def test_near_clashing_columns(spark):
    frame = spark.createDataFrame(
        [(1, [1.0, 2.0], 5, 6, 7), (2, [1.0, 2.0], 5, 6, 7)], "vec_id bigint, embedding array<float>, id int, n int, `class` int"
    )
    got = rotations.near_vectors(frame).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1, True), (2, 1, 1, False)]

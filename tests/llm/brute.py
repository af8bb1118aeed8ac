"""What the corpus queries must return, worked out one document at a time."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def op3(docs):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc_id, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        yield doc_id, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))


def op5(docs):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc_id, text in docs:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        yield doc_id, len((text or "").encode()), n, n > 2048


def op2_pieces(docs):
    """(doc_id, piece, start, length, ids_crc32) of every piece."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc_id, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, len(ids)] if len(ids) <= 2048 else sorted({0, *range(len(ids) % 2048, len(ids) + 1, 2048)})
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())


def op4(docs):
    """Without the labels and score of the method."""
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    phrases = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
    for doc_id, text in docs:
        words = word.findall((text or "").translate(LOWER))
        at = [
            (i, label)
            for phrase, label in phrases
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        spots = [i for i, _ in at]
        labels = ",".join(sorted({label for _, label in at}))
        yield doc_id, len(words), len(at), min(spots, default=None), max(spots, default=None), labels


def op7(docs):
    """doc_id, counts and base spans as text."""
    name = "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in x)
        for x in ("password", "passwd", "secret", "token", "api_?key")
    )
    kinds = [
        ("assign", re.compile(rf"""({name})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
        ("hex", re.compile("[0-9a-f]+"), 0, 32),
    ]
    for doc_id, text in docs:
        spans = [
            (m.start(), k, kind, m.end())
            for k, (kind, pattern, group, least) in enumerate(kinds)
            for m in pattern.finditer(text or "")
            if len(m[group]) >= least
        ]
        n = Counter(kind for _, _, kind, _ in spans)
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
        yield doc_id, n["assign"], n["access"], n["hex"], joined


def fingerprint(text: str | None, width: int = 4) -> int:
    words = SPACED.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def linked(prints: list[int], budget: int) -> list[int]:
    """For each print the position of the first one in its component."""
    root = list(range(len(prints)))

    def top(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    values = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= budget).tolist():
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(prints))]


def op8(docs, width: int = 4, budget: int = 4):
    docs = sorted(docs)
    prints = [fingerprint(text, width) for _, text in docs]
    first = linked(prints, budget)
    for (doc_id, _), p, k in zip(docs, prints, first):
        yield doc_id, f"{p:016x}", docs[k][0]


def op9(docs):
    """Without kept."""
    for doc_id, text in docs:
        text = text or ""
        words = SPACED.findall(text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if SPACED.search(line):
                dup += line in seen
                seen.add(line)
        places = defaultdict(list)
        for i in range(len(words) - 2):
            places[tuple(words[i : i + 3])].append(i)
        covered = {j for at in places.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
        symbols = len(re.findall("[#*$%&|<>]", text))
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        yield doc_id, len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def quality_kept(text: str | None) -> bool:
    """The verdict of all rules, each worked out by itself."""
    text = text or ""
    _, n, chars, signs, dup, _, failed = next(iter(op9([(0, text)])))
    letters = [c for c in text if c.isalpha()]
    lines = sum(1 for line in text.split("\n") if SPACED.search(line))
    shouting = len([c for c in text if c.isupper()]) > 0.5 * max(1, len(letters))
    same = dup > 3 and 10 * dup > 3 * lines
    return not (failed or 10 * signs > n or shouting or same or chars < 2 * n or chars > 20 * n)


def language(learned: list, text: str | None) -> tuple:
    """Label and score of a text by words, then n-grams of 5 to 1, from (text, lang) pairs."""
    langs = sorted({lang for t, lang in learned if any(c.isalpha() for c in t)})
    counts: dict = {order: {} for order in range(6)}  # 0: words
    for t, lang in learned:
        for word in re.findall(r"[^\W\d_]+", t.lower()):
            keys = [(0, word)]
            w = f"^{word}$"
            keys += [(n, w[k : k + n]) for n in range(1, 6) for k in range(len(w) - n + 1) if w[k : k + n] not in ("^", "$")]
            for n, key in keys:
                row = counts[n].setdefault(key, dict.fromkeys(langs, 0))
                row[lang] += 1
    total = {n: {g: max(1, sum(r[g] for r in rows.values())) for g in langs} for n, rows in counts.items()}

    def rates(n: int, key: str) -> list | None:
        row = counts[n].get(key)
        if row is None:
            return None
        shares = [row[g] / total[n][g] for g in langs]
        return [math.log(s + 0.01 * sum(shares) / len(shares)) for s in shares]

    sums, letters = [0.0] * len(langs), False
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        letters = letters or any(c.isalpha() for c in word)
        found = rates(0, word)
        for n in (5, 4, 3, 2, 1):
            if found:
                break
            w = f"^{word}$"
            rows = [r for k in range(len(w) - n + 1) if (r := rates(n, w[k : k + n]))]
            found = [0.5 * sum(c) / len(rows) for c in zip(*rows)] if rows else None
        sums = [a + b for a, b in zip(sums, found or [0.0] * len(langs))]
    if not letters or not langs:
        return "und", 0.0
    best = max(range(len(langs)), key=lambda i: (sums[i], -i))
    return langs[best], 1 / sum(math.exp(x - sums[best]) for x in sums)

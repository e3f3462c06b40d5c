"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np

from riskflow.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_row(doc_id, text):
    words = brute_planted(doc_id, WORD.findall(text or ""))
    found = brute_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    collapsed = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed))


def periodic(rng, size):
    """Words with runs of many periods, next to and inside one another."""
    out = []
    while len(out) < size:
        kind = rng.randrange(4)
        part = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 21, 34]))]
        if kind == 0:
            out += part
        elif kind == 1:
            out += (part * 12)[: int(len(part) * rng.uniform(2, 9))]
        elif kind == 2:
            out += (part * 2 + [rng.randrange(50)]) * rng.randrange(2, 7)
        else:
            out += [part[0]] * rng.randrange(1, 12)
    return out[:size]


def test_catchers_find_all_runs():
    rng = random.Random(5)
    for case in range(300):
        texts = [periodic(rng, rng.choice([0, 1, 5, 6, 7, 30, 100, 300])) for _ in range(rng.randrange(1, 6))]
        codes = np.array([c for t in texts for c in t], np.int64)
        found, text = runs.runs_of(codes, np.cumsum([0, *map(len, texts)]))
        for i, t in enumerate(texts):
            got = [(b, e - b, p) for b, e, p in found[text == i].tolist()]
            assert got == brute_runs(t), (case, i)


def test_words_appended_one_at_a_time_give_the_same(monkeypatch):
    rng = random.Random(6)
    texts = [periodic(rng, n) for n in (400, 90, 7)]
    codes, first = np.array([c for t in texts for c in t], np.int64), np.cumsum([0, *map(len, texts)])
    whole = runs.runs_of(codes, first)
    for size in (1, 3, 64):
        monkeypatch.setattr(runs, "APPENDED", size)
        found = runs.runs_of(codes, first)
        assert (found[0] == whole[0]).all() and (found[1] == whole[1]).all()


def test_long_texts_take_little_time():
    n = 400_000
    codes = np.arange(n) % 99_991  # one run of the greatest period
    assert runs.runs_of(codes, np.array([0, n]))[0].tolist() == [[0, n, 99_991]]
    assert runs.runs_of(np.zeros(n, np.int64), np.array([0, n]))[0].tolist() == [[0, n, 1]]
    fibonacci = [[1], [1, 2]]
    while len(fibonacci[-1]) < n:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    assert len(runs.runs_of(np.array(fibonacci[-1]), np.array([0, len(fibonacci[-1])]))[0]) == 0  # no four periods anywhere


def test_rows_against_brute_force(spark):
    rng = random.Random(7)
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "é é  é\té\né é é", "\x85x \x85x \x85x \x85x \x85x \x85x", "x " * 30_000]
    texts += [" ".join(f"w{c}" for c in periodic(rng, rng.choice([5, 50, 200]))) for _ in range(60)]
    texts += [" ".join(str(rng.randrange(9000)) for _ in range(400)) for _ in range(30)]
    rows = list(enumerate(texts)) + [(3, "b b b b b b b"), (3, "b b b b b b b")]
    docs = spark.createDataFrame([(d, t, "r", 1) for d, t in rows], "doc_id long, text string, runs string, _c0 int")
    got = runs.digests(runs.find_runs(runs.with_planted_repetition(docs)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((brute_row(*r) for r in rows), key=repr)
    assert runs.find_runs(docs).columns == ["doc_id", "text", "_c0", *runs.NEW_COLUMNS]
    assert runs.find_runs(docs.limit(0)).count() == 0
    nobody = runs.find_runs(runs.with_planted_repetition(spark.createDataFrame([(None, "a " * 8)], "doc_id long, text string"))).collect()
    assert nobody[0]["collapsed"] == "a" and [tuple(r) for r in nobody[0]["runs"]] == [(0, 8, 1)]

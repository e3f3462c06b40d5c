"""Exact dedup, line dedup and the Jaccard join against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskflow.llm import components as linked, exact_dedup, jaccard, line_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, _sha string, _hash string, _block int, _bits int, node int, tile int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "s", "h", 1, 2, 3, 4) for d, t in rows], SCHEMA)


def words(rng, n):
    return " ".join(rng.choice(["ab", "cd", "ef", "gh", "ij", "kl", "Mn", "öp"]) + str(rng.randrange(60)) for _ in range(n))


EXACT = [(1, "Aa"), (2, "aA"), (3, "ÄA"), (4, "äa"), (5, None), (6, ""), (7, "x" * 200_000), (8, "x" * 200_000), (None, "aa"), (9, "one"), (9, "one"), (9, "two"), (None, None)]


def test_exact_report_and_rows_that_stay(spark):
    rows = EXACT * 1
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(d)
    keep = {k: max((d for d in v if d is not None), default=None) for k, v in groups.items()}
    got = [tuple(r) for r in exact_dedup.duplicate_report(frame(spark, rows)).collect()]
    assert len(got) == len(rows)
    assert Counter(r[0] for r in got) == Counter(d for d, _ in rows)
    for d, t in rows:
        k = (t or "").translate(LOWER)
        assert any(r[:3] == (d, keep[k], len(groups[k])) and r[4] == hashlib.sha256(k.encode()).hexdigest() for r in got)
    for k in groups:
        assert sum(r[3] for r in got if r[4] == hashlib.sha256(k.encode()).hexdigest()) == 1
    kept = exact_dedup.drop_duplicates(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert Counter((r["doc_id"], (r["text"] or "").translate(LOWER)) for r in kept.collect()) == Counter((keep[k], k) for k in groups)
    assert {(r["_sha"], r["_block"]) for r in kept.collect()} == {("s", 1)}
    assert exact_dedup.duplicate_report(frame(spark, [])).count() == 0
    assert exact_dedup.drop_duplicates(frame(spark, [])).count() == 0


def test_a_full_filter_changes_nothing(spark):
    rows = [(i, f"t{i % 50}") for i in range(300)]
    one = exact_dedup.duplicate_report(frame(spark, rows), cells=64)
    other = exact_dedup.duplicate_report(frame(spark, rows))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
    assert one.filter("kept").count() == 50


def brute_chunks(text):
    lines = text.split("\n")
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    h = [md5(x) for x in lines]
    r = [md5((h[i - 1] if i else "") + h[i]) for i in range(len(h))]
    starts = [0] + [i for i in range(1, len(r) - 1) if r[i] < r[i - 1] and r[i] <= r[i + 1]]
    return [lines[a:b] for a, b in zip(starts, [*starts[1:], len(lines)])]


def test_line_chunks(spark):
    rng = random.Random(1)
    passage = [words(rng, 12) for _ in range(12)]
    rows = [(i, "\n".join([*(words(rng, 5) for _ in range(rng.randrange(4))), *passage, *(words(rng, 5) for _ in range(rng.randrange(4)))])) for i in range(20)]
    rows += [(100, None), (101, ""), (102, "one line"), (103, "one line"), (104, "\n\n\n\n"), (105, "\n\n\n\n"), (None, rows[0][1]), (106, rows[3][1]), (3, rows[3][1]), (107, "a\r\n" * 5000)]
    frame_ = frame(spark, rows)
    got = line_dedup.without_repeated_chunks(frame_)
    assert got.columns == [*frame_.columns, "n_lines", "n_removed_lines", "n_removed_chunks"]
    got = got.collect()
    assert len(got) == len(rows)
    seen, expected = set(), {}
    for d, t in sorted({(d, t) for d, t in rows if t is not None}, key=lambda x: -1 if x[0] is None else x[0]):
        kept, gone = [], 0
        for chunk in brute_chunks(t):
            key = tuple(chunk)
            if len(chunk) > 1 and "".join(chunk).strip(" \t\r\n"):
                if key in seen:
                    gone += len(chunk)
                    continue
                seen.add(key)
            kept.append("\n".join(chunk))
        expected[d, t] = ("\n".join(kept), t.count("\n") + 1, gone)
    originals = Counter((expected[d, t] if t is not None else (None, 0, 0), d) for d, t in rows)
    assert Counter(((r["text"], r["n_lines"], r["n_removed_lines"]), r["doc_id"]) for r in got) == originals
    assert sum(r["n_removed_lines"] for r in got) > 19 * 6
    assert line_dedup.without_repeated_chunks(frame(spark, [])).count() == 0


def brute_gone(rows):
    """The lines that go, by their place, and of each text its lines."""
    seen, gone, lines = {}, {}, {}
    texts = sorted({(d, t) for d, t in rows if t is not None}, key=lambda x: -(2**63) if x[0] is None else x[0])
    for d, t in texts:
        split = lines[d, t] = t.split("\n")
        gone[d, t], at = set(), 0
        units = [(i, 2) for i in range(len(split) - 1)]
        units += [(i, 1) for i, x in enumerate(split) if len(re.findall(r"[^\x20\x09-\x0D]+", x)) >= 50]
        for chunk in brute_chunks(t):
            units.append((at, len(chunk)))
            at += len(chunk)
        for i, n in sorted(units):
            unit = tuple(split[i : i + n])
            if (n > 1 or len(unit[0].split()) >= 50) and "".join(unit).strip(" \t\r\n"):
                if seen.setdefault(unit, (d, t, i)) != (d, t, i):
                    gone[d, t].update(range(i, i + n))
    return gone, lines


def test_short_passages(spark):
    rng = random.Random(7)
    rows = []
    for size in range(1, 7):  # passages of 1 to 6 lines, between lines that differ
        passage = [words(rng, 60 // size + 1) for _ in range(size)]
        for i in range(8):
            other = lambda: [words(rng, 9) for _ in range(rng.randrange(1, 5))]
            rows.append((100 * size + i, "\n".join([*other(), *passage, *other()])))
    rows += [(1, None), (2, ""), (3, "one line"), (4, "one line"), (5, "\n\n\n\n"), (6, "\n\n\n\n"), (None, rows[0][1]), (900, "a\r\n" * 3000), (901, "q\nq\nq"), (3, "one line"), (902, rows[9][1])]
    rows += [(910, words(rng, 49)), (912, "x\n\n\n\n\n\ny"), (913, "x\n\n\n\n\n\ny"), (915, " ".join(["ü"] * 50)), (916, " ".join(["ü"] * 50))]
    rows.append((911, rows[-5][1] + "\nelse"))
    gone, lines = brute_gone(rows)
    got = line_dedup.without_repeated_passages(frame(spark, rows))
    assert got.columns == [*frame(spark, rows).columns, "n_lines", "n_removed_lines", "n_removed_runs"]
    got = got.collect()
    expected = []
    for d, t in rows:
        g = gone.get((d, t), set())
        kept = None if t is None else "\n".join(x for i, x in enumerate(lines[d, t]) if i not in g)
        expected.append((d, kept, len(lines.get((d, t), [])), len(g), sum(i - 1 not in g for i in g)))
    assert sorted(repr((r["doc_id"], r["text"], r["n_lines"], r["n_removed_lines"], r["n_removed_runs"])) for r in got) == sorted(map(repr, expected))
    # No line is lost, and nothing of the passages is left after their first occurrences. 49 words alone are too few.
    left = Counter(x for r in got for x in (r["text"] or "").split("\n"))
    assert all(x in left for _, t in rows for x in (t or "").split("\n"))
    assert {len(x.split()) for x, n in left.items() if n > 1 and len(x.split()) >= 10} == {49}
    assert {r["text"] for r in got if r["doc_id"] == 901} == {"q"}
    assert line_dedup.without_repeated_passages(frame(spark, [])).count() == 0


def brute_classes(rows, width, percent):
    sets = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (d, _) in enumerate(rows):
        for j in range(i):
            e = rows[j][0]
            if d is not None and e is not None and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = root(d), root(e)
                    parent[max(a, b)] = min(a, b)
    return [(d, len(s), None if d is None else root(d)) for (d, _), s in zip(rows, sets)]


def near_copies(rng):
    rows, base = [], words(rng, 120).split()
    for i in range(30):  # a chain: each differs a little from the one before
        base = base[:]
        for _ in range(2):
            base[rng.randrange(len(base))] = f"new{i}"
        rows.append((100 + i, " ".join(base)))
    passage = words(rng, 60)
    rows += [(200 + i, passage + " " + words(rng, 25)) for i in range(25)]  # share a passage only
    hub = words(rng, 80).split()
    for i in range(25):  # all similar to one text, not to each other
        w = hub[:]
        w[3 * i % 80] = f"odd{i}"
        w[(3 * i + 31) % 80] = f"even{i}"
        rows.append((300 + i, " ".join(w)))
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, "a"), (404, "A"), (405, "a b"), (406, "a b"), (None, "a b"), (407, rows[0][1].upper()), (400, "a b")]
    rows += [(500, words(rng, 20_000)), (501, "b " + "a " * 3000)]
    rows.append((502, rows[-2][1] + " x y z"))
    return rows


@pytest.mark.parametrize("width, percent, block", [(3, 90, 32), (5, 80, 32), (3, 80, 2), (2, 60, 2)])
def test_jaccard_classes(spark, monkeypatch, width, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(random.Random(width))
    got = jaccard.near_duplicate_classes(frame(spark, rows), width, percent).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_classes(rows, width, percent)))


def test_one_of_each_class_stays(spark):
    rows = [(5, "a b c d"), (3, "A b c d"), (9, "other words are here"), (None, "a b c d"), (8, None), (7, None), (9, "other words are here")]
    kept = jaccard.keep_one_of_each_class(frame(spark, rows), 3, 90)
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == ["3", "7", "8", "9", "9", "None"]
    assert kept.columns == frame(spark, rows).columns
    assert jaccard.keep_one_of_each_class(frame(spark, [])).count() == 0


def test_ids_that_repeat_with_different_texts(spark):
    rng = random.Random(3)
    x, y, other = words(rng, 60), words(rng, 60), words(rng, 60)
    rows = [(5, x), (5, y), (3, y.replace(" ", "\n")), (7, x + " more"), (7, ""), (7, None), (8, other), (9, ""), (9, None), (None, x), (2, other), (2, "")]
    got = jaccard.near_duplicate_classes(frame(spark, rows), 3, 90).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_classes(rows, 3, 90)))
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(5, 3), (3, 3), (7, 3), (8, 2), (2, 2), (9, 9), (None, None)}
    kept = jaccard.keep_one_of_each_class(frame(spark, rows), 3, 90)
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == ["2", "2", "3", "9", "9", "None"]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    order = list(range(1000, 1200))
    rng.shuffle(order)
    links = list(zip(order, order[1:])) + [(5, i) for i in range(6, 60)] + [(70, 70), (2, 1), (1, 2)]
    got = {r["node"]: r["label"] for r in linked.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1000 for i in range(1001, 1200)}, **{i: 5 for i in range(6, 60)}, 2: 1}


def test_few_listed_pairs_read_arrays(spark, sf_dir, monkeypatch):
    bounded, possible = [], jaccard._possible
    monkeypatch.setattr(jaccard, "_possible", lambda *a: bounded.append(possible(*a)) or bounded[-1])
    docs = exact_dedup.drop_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    assert jaccard.near_duplicate_classes(docs, width=5, percent=80).count() == docs.count()
    listed = bounded[1]  # the first round compares with the centres of tiles
    assert listed.filter("possible").count() < 0.05 * listed.count()


@pytest.mark.parametrize("width, percent", [(5, 80), (3, 90), (2, 60)])
def test_no_set_with_a_partner_is_left_out(spark, width, percent):
    rng = random.Random(8)
    rows = near_copies(rng)
    passage = words(rng, 30)
    rows += [(900 + i, passage + " " + words(rng, 150)) for i in range(20)]  # mostly shingles of their own
    rows += [(950, rows[-1][1]), (950, words(rng, 90)), (951, rows[-2][1] + " end"), (952, "few"), (953, None)]
    nodes = spark.createDataFrame([(d,) for d in sorted({d for d, t in rows if d is not None and t})], "node long")
    sets = jaccard._Sets(frame(spark, rows).select("doc_id", F.coalesce("text", F.lit("")).alias("_text")), nodes, width, percent)
    left = {r["node"] for r in jaccard._with_company(nodes, sets).collect()}
    classes = {}
    for d, n, c in brute_classes(rows, width, percent):
        if d is not None and n:
            classes.setdefault(c, set()).add(d)
    assert all(members <= left for members in classes.values() if len(members) > 1)
    assert {918, 951, 919, 950} <= left  # one of the two texts of 950 has a partner
    assert not left & set(range(900, 918))

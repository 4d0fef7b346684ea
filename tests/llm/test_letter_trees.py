"""Near words by trees against all pairs."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import letter_trees as lt


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(docs):
    counts = {}
    for key, text in docs:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                mark = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                word = run if mark % 199 else run[: mark % len(run)] + run[mark % len(run) + 1 :]
                counts[word] = counts.get(word, 0) + 1
            run = ""
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    found, forms = {}, {}
    for w, n in words.items():
        others = sorted((-m, o) for o, m in words.items() if near(w, o))
        form = others[0][1] if others and -others[0][0] >= 5 * n else None
        forms[w] = form
        found[w] = (n, len(others), words.get(form))
    def root(w):
        while forms[w]:
            w = forms[w]
        return w
    return {(w, forms[w], root(w), *found[w]) for w in words}


def docs_of(seed, letters="abé", words=400):
    """Short words over few letters: very many neighbours, anagrams and ties."""
    rng = random.Random(seed)
    stock = ["".join(rng.choice(letters) for _ in range(rng.choice([5, 6, 6, 7, 7, 8]))) for _ in range(words)]
    stock = [w.upper() if rng.random() < 0.1 else w for w in stock]
    return [(i % 7 if i % 11 else None, " ".join(rng.choices(stock, [1 / (j + 1) for j in range(words)], k=400)) + rng.choice([".", "1", "×"])) for i in range(25)]


@pytest.mark.parametrize("seed", range(3))
def test_variants_equal_all_pairs(spark, seed, monkeypatch):
    # Many leaves from few words, so that searches cross borders.
    monkeypatch.setattr(lt, "LEAF_LETTERS", 100)
    monkeypatch.setattr(lt, "SAMPLE", 150)
    made = [*docs_of(seed), (None, None), (3, ""), (3, "12 34"), (3, "x" * 5000 + " "), *[(1, "y" * 3000)] * 6]
    docs = spark.createDataFrame(made, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(0))
    got = {tuple(r) for r in lt.variants(docs).collect()}
    assert got == brute(made)
    assert sum(1 for r in got if r[1]) > 5 and max(len(r[0]) for r in got) >= 2999


def test_trees_find_all_within_distance():
    rng = np.random.default_rng(5)
    points = rng.integers(0, 3, (700, 9)).astype(np.int16)
    queries = np.concatenate([points[:300], rng.integers(0, 3, (200, 9)).astype(np.int16)])
    apart = np.abs(queries[:, None] - points[None]).sum(2)
    for radius in (1, 2):
        q, p = lt.within(points, queries, radius)
        assert len(q) and set(zip(q.tolist(), p.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(apart == radius)), strict=True))
        tree = lt.upper_levels(points[:200], 16)
        rows, leaves, home = lt.route(tree, points, 0)
        assert home.all() and sorted(rows.tolist()) == list(range(700)) and len(set(leaves.tolist())) > 8
        at = dict(zip(rows.tolist(), leaves.tolist(), strict=True))
        visited = set(zip(*(a.tolist() for a in lt.route(tree, queries, radius)[:2]), strict=True))
        assert all((i, at[j]) in visited for i, j in zip(*np.nonzero(apart <= radius), strict=True))
    same = np.zeros((500, 4), np.int16)
    assert lt.upper_levels(same, 8) == 0 and len(lt.within(same, same, 1)[0]) == 0


def test_one_edit():
    rng = random.Random(2)
    for _ in range(2000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 6)))
        for b in ("".join(rng.choice("ab") for _ in range(len(a))), "".join(rng.choice("ab") for _ in range(len(a) + 1))):
            rows = [lt.letters_of([w])[0][None, :] for w in (a, b)]
            assert bool((lt.one_replaced if len(a) == len(b) else lt.one_inserted)(*rows)[0]) == near(a, b)


def test_no_words(spark):
    assert lt.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert lt.variants(spark.createDataFrame([(1, None), (2, "few words here")], "doc_id long, text string")).count() == 0


def test_long_paths_lead_to_their_root(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w5")], "word string, form string")
    assert {tuple(r) for r in lt.roots(forms).collect()} == {(f"w{i}", "w37") for i in range(37)} | {("x", "w37")}
    assert lt.roots(forms.limit(0)).count() == 0

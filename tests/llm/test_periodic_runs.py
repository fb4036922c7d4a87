"""Runs against a plain search of every period, on texts made of a few words."""

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD_TEXTS, words
from pyspark.sql import functions as F

from keytables.llm.periodic_runs import find_runs, longest_run, occurrences, runs_of
from keytables.llm.words import split_words


def plain_runs(w):
    """(start, length, period) of all stretches of a smallest period q and at least 4 * q words."""
    if len(w) > 10_000 and len(set(w)) == 1:
        return [(0, len(w), 1)]
    least = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= 4 * q:
                least.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in least.items())


def plain_collapsed(w, least_length):
    gone = {i for s, n, q in plain_runs(w) if n >= least_length for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def repetitive(rnd):
    letters, size, out = rnd.choice([1, 2, 2, 3, 5]), rnd.choice([0, 1, 5, 8, 20, 60, 300]), []
    while len(out) < size:
        unit = [rnd.choice("abcde"[:letters]) for _ in range(rnd.randint(1, 20))]
        times = rnd.choice([1, 1, 2, 4, 5, 7, 9])
        out += (unit * times)[: len(unit) * times - rnd.randint(0, len(unit) - 1)]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_random_texts(seed):
    rnd = random.Random(seed)
    texts = [repetitive(rnd) for _ in range(100)]
    split = split_words(pa.array([" ".join(t) for t in texts]))
    found = runs_of(split)
    of = np.searchsorted(split.first, found.start, "right") - 1
    for d, text in enumerate(texts):
        mine = of == d
        got = zip((found.start - split.first[d])[mine].tolist(), found.length[mine].tolist(), found.period[mine].tolist())
        assert sorted(got) == plain_runs(text), text


@pytest.mark.parametrize("unit", [["a"], ["a", "b"], ["a"] * 300 + ["b"], [str(i) for i in range(700)]])
def test_long_repetitions(unit):
    text = (unit * 60_000)[:60_000]
    found = runs_of(split_words(pa.array([" ".join(text)])))
    assert (0, 60_000, len(unit)) in set(zip(*(x.tolist() for x in found)))


@pytest.mark.parametrize("size, letters", [(1, 2), (2, 2), (8, 2), (64, 3), (512, 2), (16, 2**40)])
def test_occurrences_are_exact(size, letters):
    rng = np.random.default_rng(size)
    windows = rng.integers(0, letters, (20, 2 * size))
    if letters > 3:  # more than one prime is needed, and no more than three
        windows %= 2**30
    at = rng.integers(0, size, 20)
    blocks = windows[np.arange(20)[:, None], at[:, None] + np.arange(size)]
    blocks[0] += 1
    want = [[(windows[i, k : k + size] == blocks[i]).all() for k in range(size)] for i in range(20)]
    assert occurrences(blocks, windows).tolist() == want


def test_values_beyond_the_primes_are_refused():
    with pytest.raises(ValueError):
        occurrences(np.full((1, 2), 2**46), np.zeros((1, 4), np.int64))


def test_find_runs_of_odd_documents(spark):
    rows = [(i, t, "kept", -1) for i, t in ODD_TEXTS] + [(20, "a b " * 4 + "c", "kept", -1), (21, "x " * 5, None, -1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, runs_of string, runs int")
    found = find_runs(table, least_length=6)
    assert found.columns == ["doc_id", "text", "runs_of", "n_words", "runs", "collapsed"]
    got = found.withColumn("longest", longest_run()).collect()
    assert len(got) == len(rows)
    for r in got:
        w = words(r.text)
        want = [x for x in plain_runs(w) if x[1] >= 6]
        assert r.n_words == len(w) and [tuple(x) for x in r.runs] == want
        assert r.collapsed.encode() == b" ".join(plain_collapsed(w, 6))
        assert (tuple(r.longest) if r.longest else None) == (max(want, key=lambda x: (x[1], -x[0], -x[2])) if want else None)
    assert {len(r.runs) for r in got} >= {0, 1}


def test_find_runs_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert find_runs(empty).count() == 0


def test_least_length(spark):
    table = spark.createDataFrame([(1, "x " * 5), (2, "x " * 4 + "y")], "doc_id long, text string")
    counts = find_runs(table, least_length=4).select("doc_id", F.size("runs")).collect()
    assert sorted(map(tuple, counts)) == [(1, 1), (2, 1)]

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslake.llm import jaccard_join as j
from saleslake.llm.components import components

SCHEMA = "doc_id long, text string, key string, class int"


def shingles(text, words=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lower).split(" ") if x]
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(texts, join):
    sets = [shingles(t, join.words) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and join.den * common >= join.num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


def corpus(seed, n=150):
    chosen = random.Random(seed)
    word = lambda: chosen.choice("the of and a to in é".split()) if chosen.random() < 0.3 else f"w{chosen.randint(0, 3000)}"
    texts = [None, "", " \n", "one", "One", "one two", "one two three", "a " * 500, "A " * 30]
    for _ in range(n):
        size = chosen.choice([3, 8, 11, 12, 15, 30, 60, 200, 400])
        base = [word() for _ in range(size)]
        texts.append(" ".join(base))
        for _ in range(chosen.choice([0, 1, 2, 5])):
            copy = list(base)
            for _ in range(chosen.randint(0, max(1, size // 25))):
                at = chosen.randrange(len(copy))
                kind = chosen.random()
                copy[at : at + (kind < 0.6)] = [word()] if kind > 0.3 else []
            texts.append("\n".join(copy).upper() if chosen.random() < 0.2 else "  ".join(copy))
    texts += texts[20:30] * 2
    return texts


@pytest.mark.parametrize("join", [j.Join(), j.Join(words=5, num=80)])
def test_equals_brute_force(spark, join):
    texts = corpus(1)
    docs = spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], SCHEMA)
    got = sorted(tuple(r) for r in j.join_documents(docs, join).collect())
    assert got == brute(texts, join)


def test_exchange_of_segments_loses_no_link(spark, monkeypatch):
    """Give up half of all segments: the others' one-deletion neighbourhoods must make up for it."""
    join, texts = j.Join(), corpus(2, 60)

    def all_of_it(rest, classes, join):
        last = join.bands(classes.agg({"n": "max"}).first()[0])
        n = join.segments(last)
        dropped = {(b << 40) | s for b in range(1, len(n)) for s in range(n[b] // 2)}
        return dropped, {(b << 40) | (int(n[b]) - 1 - s) for b in range(1, len(n)) for s in range(n[b] // 2)}

    whole = j._members

    def without_dropped(rows, join):
        return whole(rows, join).where(~F.col("slot").isin(list(all_of_it(None, rows, join)[0])))

    monkeypatch.setattr(j, "_exchanges", all_of_it)
    monkeypatch.setattr(j, "_members", without_dropped)
    docs = spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], SCHEMA)
    assert sorted(tuple(r) for r in j.join_documents(docs, join).collect()) == brute(texts, join)


def test_segments_cover_the_difference():
    for join in (j.Join(), j.Join(num=80), j.Join(num=1, den=2)):
        last = join.bands(3000)
        n = join.segments(last)
        for b in range(1, len(last)):
            for x in range(last[b - 1] + 1, last[b] + 1, max(1, last[b] // 50)):
                y = x * join.den // join.num
                common = -(-join.num * (x + y) // (join.den + join.num))
                assert x + y - 2 * common < n[b]
                assert join.layout(np.array([y]), True)[0] == b or join.layout(np.array([y]), False)[0] == b


def test_unrelated_texts_share_no_key(spark):
    """Two large sets always have some segment that is empty in both; that is no reason to compare them."""
    texts = [" ".join(f"w{i}_{k}" for k in range(1000 + 7 * i)) for i in range(60)]
    near = texts[5].replace("w5_300 ", "x ").replace("w5_700 ", "y ")
    docs = spark.createDataFrame(list(enumerate([*texts, near])), "doc_id long, text string")
    join = j.Join(words=5, num=80)
    rows = j.summaries(docs, join)
    shared = {r["class"] for r in j._members(rows, join).collect()}
    assert shared == {r["class"] for r in rows.where("doc_id IN (5, 60)").collect()}
    got = sorted(tuple(r) for r in j.join_documents(docs, join).collect())
    assert [r for r in got if r[0] != r[2]] == [(60, len(shingles(near, 5)), 5)]


def test_sets_with_empty_segments_keep_their_links():
    """Two sets that link have a key in common, whatever segments are empty."""
    chosen = np.random.default_rng(7)
    join = j.Join(words=5, num=80)
    for size in (*range(5, 60), 200, 450, 680, 681, 2000):
        base = chosen.integers(0, 2**63, size, dtype=np.uint64)
        less = base[: -(-size * 80 // 100)]
        most = join.difference(np.array([size]), np.array([size]))[0] // 2
        other = np.concatenate([base[most:], chosen.integers(0, 2**63, most, dtype=np.uint64)])
        for two in (less, other):
            keys, at = join.keys(np.concatenate([np.sort(base), np.sort(two)]), np.array([0, size, size + len(two)]))
            assert set(keys[: at[1]].tolist()) & set(keys[at[1] :].tolist()), size


def test_odd_rows(spark):
    rows = [(None, "a b c d", "", 0), (None, "", "", 0), (7, "a b c d", "", 0), (7, "a b c d", "", 0), (5, "", "", 0), (6, "", "", 0)]
    got = j.join_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(got, key=str) == sorted([(None, 2, None), (None, 0, None), (7, 2, 7), (7, 2, 7), (5, 0, 5), (6, 0, 6)], key=str)
    assert j.join_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (300, 100), (500, 500)] + [(1000, i) for i in range(1001, 1100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {200: 100, 300: 100} | {i: 1000 for i in range(1001, 1100)}

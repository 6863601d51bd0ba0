import hashlib
import math
import random
import re
import zlib

import numpy as np

from saleslake.llm import resampling as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, score string, rank int"


def features(text, longest):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, items, r):
    bucket = lambda f: zlib.crc32(f.encode()) % r.buckets
    s, t = [0] * r.buckets, [0] * r.buckets
    for texts, counts in ((rows, s), (items, t)):
        for _, text in texts:
            for f in features(text, r.longest_run)[1]:
                counts[bucket(f)] += 1
    big_s, big_t = sum(s), sum(t)
    out = []
    for doc_id, text in rows:
        words, own = features(text, r.longest_run)
        total = 0
        for b in map(bucket, own):
            ratio = (t[b] + 1) * (big_s + r.buckets) / ((s[b] + 1) * (big_t + r.buckets))
            total += math.floor(r.scale * math.log(ratio))
        weight = total // len(own) if own else 0
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"{r.seed}:{name}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-r.scale * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words), len(own), weight, weight + noise, None])
    able = sorted((x for x in out if x[1] >= r.min_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    for k, x in enumerate(able[: r.percent * len(able) // 100], 1):
        x[5] = k
    return sorted(map(tuple, out), key=str)


def corpus(seed, n):
    chosen = random.Random(seed)
    vocabulary = ["the", "The", "é", "ß1", "中文", "of", "x9", "it's", *(f"w{i}" for i in range(200)), *(f"a long word number {i}".replace(" ", "") for i in range(50))]
    text = lambda: chosen.choice([" ", "\n", ", ", "\x00"]).join(chosen.choices(vocabulary, k=chosen.choice([0, 3, 19, 20, 21, 60, 300])))
    return [(i, text()) for i in range(n)]


def got(spark, rows, items, r):
    docs = spark.createDataFrame([(*x, "x", 1) for x in rows], SCHEMA).repartition(3)
    found = d.draw(d.score(docs, spark.createDataFrame(items, "item_id long, text string"), r), r)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, found.collect()), key=str)


def test_equals_brute_force(spark):
    rows, items = corpus(1, 150), corpus(2, 12)
    rows += [(200, None), (201, ""), (202, " .,"), (203, "中" * 30_000), (204, rows[7][1]), (None, rows[9][1]), (None, None)]
    for r in (d.Resampling(), d.Resampling(longest_run=3, percent=50, buckets=97, min_words=3), d.Resampling(percent=100)):
        assert got(spark, rows, items, r) == brute(rows, items, r)


def test_repeated_rows_take_neighbouring_ranks(spark):
    rows = corpus(3, 40)
    rows += [rows[5]] * 60
    r = d.Resampling(percent=60, min_words=1)
    found = got(spark, rows, [(1, "the of w3")], r)
    assert sorted(x[:5] for x in found) == sorted(x[:5] for x in brute(rows, [(1, "the of w3")], r))
    ranks = sorted(x[5] for x in found if x[5])
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == 60 * sum(x[1] >= 1 for x in found) // 100
    by_rank = [x for x in sorted(found, key=lambda x: x[5] or 999) if x[5]]
    assert by_rank == sorted(by_rank, key=lambda x: (-x[4], x[0]))


def test_empty_tables_and_nobody_drawn(spark):
    rows, r = corpus(4, 9), d.Resampling()
    assert got(spark, [], [(1, "a b")], r) == []
    assert got(spark, rows, [], r) == brute(rows, [], r)  # nine documents: a tenth of them is none
    assert all(x[5] is None for x in got(spark, rows, [(None, None)], r))


def test_checksums_of_all_lengths():
    chosen = random.Random(5)
    words = [bytes(chosen.choices(range(1, 256), k=n)) for n in [*range(1, 40)] * 12 + [500, 70_000]] + [b"same"] * 30
    at = np.cumsum([0, *map(len, words)])
    data = np.frombuffer(b"".join(words), np.uint8)
    assert d.checksums(data, at[:-1], np.diff(at)).tolist() == [zlib.crc32(w) for w in words]


def test_resample_keeps_the_columns_of_the_drawn(spark):
    rows, items, r = corpus(6, 80), corpus(7, 5), d.Resampling(percent=25)
    docs = spark.createDataFrame([(*x, "own", 3) for x in rows], SCHEMA)
    kept = d.resample(docs, spark.createDataFrame(items, "item_id long, text string"), r)
    drawn = {x[0] for x in brute(rows, items, r) if x[5]}
    assert kept.columns == docs.columns and drawn
    assert sorted(map(tuple, kept.collect())) == sorted((*x, "own", 3) for x in rows if x[0] in drawn)

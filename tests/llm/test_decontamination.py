import random
import re

from pyspark.sql import types as T

from saleslake.llm import decontamination as d

DOCS = "doc_id long, text string, item string, first long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(text, items, window=13):
    w, hit, names = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        k = min(len(v), window)
        for i in range(max(1, len(v) - window + 1) if v else 0):
            for j in range(len(w) - k + 1):
                if w[j : j + k] == v[i : i + k]:
                    hit.update(range(j, j + k))
                    if item_id is not None:
                        names.add(str(item_id))
    return len(w), len(hit), sorted(names)


def test_equals_brute_force(spark):
    chosen = random.Random(3)
    vocabulary = ["a", "Ab", "é", "ß1", "the", "of", "x9", "中文", "it's"]
    line = lambda n: " ".join(chosen.choices(vocabulary, k=n))
    items = [(i, line(chosen.choice([1, 2, 4, 13, 14, 30]))) for i in range(12)]
    items += [(None, line(5)), (50, None), (51, ""), (52, "--- !!"), (1, items[1][1]), (53, items[2][1])]
    texts = [None, "", " .,", line(400)]
    for _ in range(60):
        parts = [line(chosen.randint(0, 30)), chosen.choice(items)[1] or "", line(3), chosen.choice(items)[1] or ""]
        texts.append(chosen.choice([" ", "\n", ", ", "\x00"]).join(parts).upper())
    texts += [texts[7], "a " * 30_000]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], DOCS)
    table = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (10**9, 100):  # one block of items, and several
        found = d.find_items(docs, table, block_bytes=block_bytes)
        assert found.columns[:4] == ["doc_id", "text", "item", "first"]
        for r in found.collect():
            if r.doc_id < len(texts) - 1:
                assert (r.n_words, r.n_hit, list(r.item_ids)) == brute(r.text, items)


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b", "", 0)], DOCS)
    items = spark.createDataFrame([], "item_id long, text string")
    row = d.find_items(docs, items).collect()[0]
    assert (row.n_words, row.n_hit, row.item_ids, row.hits) == (2, 0, [], [])
    assert d.find_items(docs.limit(0), spark.createDataFrame([(1, "a")], items.schema)).count() == 0
    clash = d.find_items(docs.withColumnsRenamed({"item": "N_Hit", "first": "hits"}), spark.createDataFrame([(1, "b")], items.schema))
    assert clash.columns == ["doc_id", "text", "N_Hit", "hits", "n_words", "hits_1", "item_ids", "n_hit_1"]
    row = clash.collect()[0]
    assert (row.N_Hit, row.hits, row.n_words, row.n_hit_1, row.item_ids) == ("", 0, 2, 1, ["1"])


def test_limit_is_one_word_in_twenty(spark):
    rows = spark.createDataFrame([(20, 1), (21, 1), (0, 0), (13, 0)], T.StructType().add("n_words", "long").add("n_hit", "long"))
    assert [r[0] for r in rows.select(d.contaminated()).collect()] == [True, False, False, False]

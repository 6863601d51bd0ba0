"""Every stage of the pipeline against a brute-force version, on the rows its predecessor kept."""

import hashlib
import struct
import time
from pathlib import Path

import public_tokenizers
import test_decontamination
import test_jaccard_join
import test_line_dedup
from tokenizers import Tokenizer

import corpus_pipeline as p
from saleslake.llm import jaccard_join, line_dedup, tables
from saleslake.llm.queries import table
from saleslake.llm.tables import stored

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark):
    docs = table(spark, SF, "documents")
    before, results = rows_of(docs), []
    for name, stage in p.STAGES:
        docs = stored(stage(spark, docs, SF))
        results.append((name, docs))
    assert all(df.columns == COLUMNS for _, df in results[:-1])
    good, lines, alone, clean, tokens = [rows_of(df) for _, df in results]

    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    wrong = [i for i, q in labels.items() if (i in good) != (q == 1)]
    assert len(wrong) <= 0.05 * len(labels)
    assert all(good[i] == before[i] for i in good)

    left = test_line_dedup.brute([(i, good[i].text) for i in sorted(good)], line_dedup.Similarity())
    want = {i: text for i, text, _, removed in left if not removed or text.split()}
    assert {i: r.text for i, r in lines.items()} == want
    assert all(r.n_chars == len(r.text) for r in lines.values())

    ids = sorted(lines)
    found = test_jaccard_join.brute([lines[i].text for i in ids], p.NEAR)
    assert set(alone) == {ids[k] for k, _, root in found if root == k}
    assert all(alone[i] == lines[i] for i in alone)

    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    hits = {i: test_decontamination.brute(r.text, items) for i, r in alone.items()}
    assert set(clean) == {i for i, (n, hit, _) in hits.items() if not (hit and 20 * hit >= n)}

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert set(tokens) == set(clean)
    for i, r in tokens.items():
        want = library.encode(clean[i].text, add_special_tokens=False).ids
        assert bytes(r.ids) == struct.pack(f"<{len(want)}I", *want) and r.n_tokens == len(want)
        assert r.decoded_sha256 == hashlib.sha256(clean[i].text.encode()).hexdigest()


def test_run_gives_the_last_stage(spark):
    got = p.run(spark, SF)
    assert got.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "decoded_sha256"] and got.count() > 0


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    line = "one two three four five six seven."
    docs = spark.createDataFrame([(1, line, "en", "s", 34), (2, line, "en", "s", 34), (3, None, None, None, None), (None, "", "", "", 0)], schema)
    for stage in (p.drop_lines, p.one_of_each_group, p.decontaminate):
        assert sorted((r.doc_id for r in stage(spark, docs, SF).collect()), key=str) == sorted([1, 3, None] if stage is not p.decontaminate else [1, 2, 3, None], key=str)
    for _, stage in p.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_columns_of_clashing_names_travel_along(spark):
    names = ["score", "n_lines", "n_removed", "_row", "_id", "n_words", "hits", "item_ids", "n_hit", "class", "component_id"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    line = "one two three four five six seven."
    own = tuple(names)
    docs = spark.createDataFrame([(1, f"{line}\nAnother line of some words.", "en", "s", 63, *own), (2, line, "en", "s", 34, *own)], schema)
    for stage in (p.keep_good, p.drop_lines, p.one_of_each_group, p.decontaminate):
        found = stage(spark, docs, SF)
        assert found.columns == docs.columns
        assert all(tuple(r)[5:] == own for r in found.collect())
    assert [r.doc_id for r in p.drop_lines(spark, docs, SF).collect()] == [1]


def test_near_copies_of_five_word_shingles_go(spark):
    """Two words of a hundred differ: 0.81 of the five-word shingles, 0.88 of the three-word ones."""
    base = [f"w{i}" for i in range(100)]
    near, far = list(base), list(base)
    near[30], near[70] = "x", "y"
    far[20], far[50], far[80] = "x", "y", "z"
    texts = [" ".join(base), " ".join(near), " ".join(far), *test_jaccard_join.corpus(3, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    roots = {i: root for i, _, root in test_jaccard_join.brute(texts, jaccard_join.Join(words=5, num=80, den=100))}
    assert (roots[0], roots[1], roots[2]) == (0, 0, 2)
    assert {r.doc_id for r in p.one_of_each_group(spark, docs, SF).collect()} == {i for i, root in roots.items() if i == root}


def test_shuffle_files_go_with_the_step(spark):
    """What a step shuffled is deleted when its table is written; the session's setting stays as it was."""
    before = spark.conf.get(tables.CLEAN_UP)
    blocks = lambda: {b for d in folders for b in d.rglob("shuffle_*.data")}
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(f.getPath()) for f in manager.localDirs()]
    there = blocks()
    got = stored(spark.range(100_000, numPartitions=4).repartition(5, "id"))
    for _ in range(50):
        if not blocks() - there:
            break
        time.sleep(0.1)
    assert not blocks() - there and got.count() == 100_000 and spark.conf.get(tables.CLEAN_UP) == before

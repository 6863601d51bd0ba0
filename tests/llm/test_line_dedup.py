import random

import numpy as np
import pyarrow as pa
import pytest

from saleslake.llm import arrays
from saleslake.llm import line_dedup as d

SCHEMA = "doc_id long, text string, word string, class int"


def words(line):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    for c in "\t\x0b\x0c\r":
        lower = lower.replace(c, " ")
    return frozenset(x for x in lower.split(" ") if x)


def brute(rows, s):
    seen, out = [], []
    for doc_id, text in rows:
        kept, lines = [], (text or "").split("\n")
        for line in lines:
            w = words(line)
            similar = len(w) >= s.min_words and any(
                s.den * len(w & v) >= s.num * len(w | v) for v in seen if s.num * len(v) <= s.den * len(w)
            )
            if not similar:
                kept.append(line)
            if len(w) >= s.min_words:
                seen.append(w)
        out.append((doc_id, text if len(kept) == len(lines) else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def corpus(seed):
    chosen = random.Random(seed)
    word = lambda: chosen.choice("the of and a to in é".split()) if chosen.random() < 0.4 else f"w{chosen.randint(0, 400)}"
    lines = ["", " \t", "a b c d", "The common line of all documents."]
    for _ in range(250):
        lines.append(" ".join(word() for _ in range(chosen.choice([3, 4, 5, 6, 9, 10, 12, 25, 60, 200]))))
    rows = []
    for i in range(60):
        own = []
        for _ in range(chosen.randint(0, 12)):
            line = chosen.choice(lines).split(" ")
            for _ in range(chosen.randint(0, max(1, len(line) // 8))):
                at = chosen.randrange(len(line))
                line[at : at + 1] = chosen.choice([[], [word()], [line[at], word()]])
            own.append(" ".join(line).upper() if chosen.random() < 0.1 else " ".join(line))
        rows.append((i, "\n".join(own)))
    return [*rows, (60, None), (61, ""), (62, rows[3][1]), (63, "\n".join([lines[3]] * 500))]


@pytest.mark.parametrize("s", [d.Similarity(), d.Similarity(min_words=1), d.Similarity(num=2, den=3)])
def test_equals_brute_force(spark, s):
    rows = corpus(5)
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(4)
    got = d.dedup_lines(docs, s)
    assert got.columns == ["doc_id", "text", "word", "class", "n_lines", "n_removed"]
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()) == brute(rows, s)


def test_odd_rows(spark):
    line = "one two three four five six"
    rows = [(None, line, "", 0), (3, line, "", 0), (3, line, "", 0), (9, f"{line}\n{line} \nx", "", 0)]
    got = d.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == [(3, line), (3, line), (9, "x"), (None, line)]
    assert d.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = d.dedup_lines(spark.createDataFrame(rows, SCHEMA.replace("class", "n_lines").replace("word", "N_Removed_1")))
    assert clash.columns == ["doc_id", "text", "N_Removed_1", "n_lines", "n_lines_1", "n_removed"]
    assert sorted((r.n_lines, r.n_lines_1, r.n_removed) for r in clash.collect()) == [(0, 1, 0)] * 3 + [(0, 3, 2)]


def test_rows_of_one_id_lose_their_own_lines_only(spark):
    line, other = "the shared line of some words", "unique line of quite other words here"
    rows = [(1, line), (5, line), (5, other), (5, f"{other}\n{line}"), (7, f"{line} \n{other}\nlast words of all")]
    got = d.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id, r.text, r.n_removed) for r in got) == [(1, line, 0), (5, "", 1), (5, other, 0), (5, other, 1), (7, "last words of all", 2)]


def test_one_order_of_words_in_all_texts():
    """Words of one slot keep their order, whatever the number of lines of a slice."""
    ranks = np.zeros(d.SLOTS, np.int64)  # all words equally rare: the order is that of the hashes
    text = " ".join(f"w{i}" for i in range(3000))
    alone, _, _ = d.line_sets(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), ranks)
    data = f"{text}\n".encode() + b"\n" * (1 << 22)
    many, at, _ = d.line_sets(np.frombuffer(data, np.uint8), np.array([0, len(data)]), ranks)
    assert alone.tolist() == many[at[0] : at[1]].tolist()


def test_short_lines_take_part(spark):
    """Brute force over all lines with words, however few."""
    chosen = random.Random(11)
    lines = ["yes", "YES  yes", "no", "a b", "b a a", "a b c", "a b c d", "a b c d e", "a b d e", "ha " * 300, "漢字" * 200, "ha hm " * 90, "", " \t"]
    rows = [(i, "\n".join(chosen.choice(lines) for _ in range(chosen.randint(1, 4)))) for i in range(40)]
    seen, want = [], []
    for doc_id, text in rows:
        kept = []
        for line in text.split("\n"):
            w = words(line)
            if not w or not any(100 * len(w & v) >= 80 * len(w | v) for v in seen):
                kept.append(line)
            seen.append(w)
        want.append((doc_id, "\n".join(kept), len(kept)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.text, r.n_lines - r.n_removed) for r in d.dedup_lines(docs).collect())
    assert got == want and sum(len(t.split("\n")) for _, t in rows) > sum(n for *_, n in want)


def test_first_pairs_take_one_join(spark):
    """Sizes and parity bits travel with the near keys: pairs aren't joined with the classes again."""
    line = "one two three four five six seven eight nine ten"
    rows = [(1, line), (2, f"{line} eleven"), (3, "quite other words that nobody else has in any line")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    s, ranks = d.Similarity(), spark.sparkContext.broadcast(np.arange(d.SLOTS))
    classes = d.class_table(d.line_table(docs, ranks, s))
    pairs = d.first_candidates(classes, s)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1
    assert {(r.doc_id_x, r.doc_id_y) for r in pairs.collect()} == {(2, 1)}


def test_pieces_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": ["a" * 700_000, None, "b" * 700_000, "c"]})
    parts = list(arrays.pieces(batch, "text"))
    assert [p.column("doc_id").to_pylist() for p in parts] == [[1, 2], [3, 4]]
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()


from saleslake.llm import quality_rules as q

PROSE = " ".join(f"word{i}" for i in range(60)) + "."


def judge(spark, *texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _words string")
    rows = q.apply_rules(df).orderBy("doc_id").collect()
    assert [r._words for r in rows] == ["x"] * len(texts)
    return rows


def test_counts(spark):
    repeated = "a b c d a b c e\na b c\n\nx#$\nx#$\n x"
    none, empty, counted, same = judge(spark, None, "", repeated, "w " * 100)
    for r in (none, empty):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (0, 0, 0, 0, 0)
        assert r.base_failed and not r.kept
    assert (counted.n_words, counted.n_symbols, counted.n_dup_lines, counted.n_repeat_words) == (14, 4, 1, 9)
    assert counted.word_chars == 18
    assert same.n_repeat_words == same.n_words == 100


def test_lines_and_verdict(spark):
    menu = "\n".join("Home | News | Sports | About" for _ in range(3))
    good, half, shout = judge(
        spark, f"{PROSE}\n{menu}", f"{PROSE}\n" + "\n".join(f"a{i} b{i} | c{i} | d{i} | e{i} |" for i in range(90)),
        " ".join(f"LOUD{i}!!" for i in range(60)),
    )
    assert good.kept and good.cleaned == PROSE and good.n_removed_lines == 3
    assert not half.kept and not half.base_failed
    assert not shout.kept and shout.cleaned == ""


def test_empty_table_long_text_and_clash(spark):
    assert q.apply_rules(spark.createDataFrame([], "text string")).count() == 0
    (long,) = judge(spark, "\n".join(f"{PROSE} {i}." for i in range(5000)))
    assert long.n_words == 61 * 5000 and long.n_lines == 5000
    clash = q.apply_rules(spark.createDataFrame([("a", 1)], "text string, Kept int"))
    assert clash.columns == ["text", "Kept", *[f"{c}_1" if c == "kept" else c for c in q.ADDED]]
    (row,) = clash.collect()
    assert (row.Kept, row.kept_1, row.n_words) == (1, False, 1)

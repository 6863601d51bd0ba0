"""Encoding, decoding and counting against the tokenizers library."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from saleslake.llm import bpe_automaton, token_counts
from saleslake.llm.queries import op1_bpe_encode_decode, op9_token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "b", "s", "t", "re", "'", "'s", "'ll", "'ve", "'d", " ", "  ", "\n", "\t", " ", "1", "²", "é",
    "ß", "!", "-", "中", "\U0001f600", "\x1c", "aaaa", "!!!!!!", "<|endoftext|>", "the", " of", "=====", "    ",
    "\U00010d4a", "́", "\r\n", "\x00",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    chosen = random.Random(7)
    mixed = ["".join(chosen.choices(PIECES, k=chosen.randint(0, 15))) for _ in range(3000)]
    long = ["x" * 40_000, "ab 12 " * 300_000, "é" * 3000, " " * 2000, "a" * 70_000]
    return [None, "", *mixed, *long, mixed[5], mixed[5]]


def frame(spark, rows):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    return spark.createDataFrame(list(enumerate(rows)), schema)


def test_encode_decode_and_count_equal_the_library(spark, library):
    rows = texts()
    encoded = bpe_automaton.encode(frame(spark, rows), PATH)
    got = {r.doc_id: r for r in bpe_automaton.decode(encoded, PATH).collect()}
    counted = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame(spark, rows), PATH).collect()}
    for i, text in enumerate(rows):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert bpe_automaton.unpacked(got[i].ids) == want, repr(text)[:80]
        assert got[i].n_tokens == counted[i] == len(want)
        assert got[i].decoded == library.decode(want, skip_special_tokens=False)


def test_ids_that_are_no_text(spark, library):
    ids = [[250, 251], [library.token_to_id("é"[:1]) or 0, 128, 50256], []]
    packed = [(struct.pack(f"<{len(x)}I", *x),) for x in ids]
    got = [r.decoded for r in bpe_automaton.decode(spark.createDataFrame(packed, "ids binary"), PATH).collect()]
    assert got == [library.decode(x, skip_special_tokens=False) for x in ids]


def test_empty_tables_and_clashing_names(spark):
    empty = frame(spark, [])
    assert bpe_automaton.encode(empty, PATH).count() == token_counts.count_tokens(empty, PATH).count() == 0
    clash = frame(spark, ["a b"]).withColumnRenamed("doc_id", "ids").selectExpr("*", "7 AS n_tokens", "8 AS decoded")
    encoded = bpe_automaton.encode(clash, PATH)
    assert encoded.columns == [*clash.columns, "ids_1", "n_tokens_1"]
    assert token_counts.count_tokens(clash, PATH).columns[-1] == "n_tokens_1"
    (row,) = bpe_automaton.decode(encoded, PATH, ids="ids_1").collect()
    assert (row.n_tokens, row.n_tokens_1, row.decoded, row.decoded_1) == (7, 2, 8, "a b")
    named = frame(spark, ["a b"]).withColumnsRenamed({"doc_id": "start"}).selectExpr("*", "1 AS end", "null AS state")
    assert token_counts.count_tokens(named, PATH).collect()[0].n_tokens == 2


def test_queries(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    one = {r.doc_id: r for r in op1_bpe_encode_decode(spark, sf).collect()}
    nine = {r.doc_id: r for r in op9_token_counts(spark, sf).collect()}
    assert set(one) == set(nine) == set(rows)
    for i, text in rows.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert one[i].n_tokens == nine[i].n_tokens == len(ids)
        assert one[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert one[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert nine[i].n_bytes == len((text or "").encode())
        assert nine[i].over_limit == (len(ids) > 1024)

"""Licences of files: sparse TF-IDF cosine to templates, then inheritance from directories.

Every line of a file, and its text as a whole, is compared with every template; the best similarity
of at least ``threshold`` is the file's own licence (ties: the first template by name). Document
frequencies of all words are counted over all lines of all files. No weight is below 1, so the words
of a template in a line or text bound its cosine from above; those that may reach the threshold
are joined with the weights of their other words. A file without a licence of its own takes that of the nearest directory on its
path that has one: of the licence files directly in a directory, the most similar counts (ties:
the smallest path).

A null text has no licence and a null path no directory; both only pass through. Repeated rows get
equal results.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm import bitmaps
from saleslake.llm.tables import free_names, stored

THRESHOLD = 0.6
LICENCE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)[^/]*$"

# Short notices of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "Licensed under CC BY 4.0, the Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0, Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright: CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

COUNTED = 200_000  # words that a task counts before it hands them on; bounds its memory

_WORDS = re.compile(r"[^\W_]+(?:\.\d+)*")
Vector = dict[str, float]


def terms(text: str) -> Counter:
    return Counter(_WORDS.findall(text.lower()))


def vocabulary(templates: dict[str, str]) -> frozenset[str]:
    return frozenset(w for text in templates.values() for w in terms(text))


def document_frequencies(files: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): the lines that hold each word; the row without a word has the number of lines."""
    schema = T.StructType().add("word", T.StringType()).add("n", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, lines = Counter(), 0
        for batch in batches:
            for value in batch.column(text):
                for line in (value.as_py() or "").lower().split("\n"):
                    lines += 1
                    found.update(set(_WORDS.findall(line)))
                if len(found) >= COUNTED:
                    yield pa.RecordBatch.from_pydict({"word": [*found], "n": [*found.values()]}, schema=_arrow(schema))
                    found.clear()
        yield pa.RecordBatch.from_pydict({"word": [None, *found], "n": [lines, *found.values()]}, schema=_arrow(schema))

    return files.select(text).mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    return {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.DoubleType(): pa.float64()}[kind]


def _arrow(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, _arrow_type(f.dataType)) for f in schema])


class Matcher:
    """Cosine of a text to each template over sparse vectors."""

    def __init__(self, templates: dict[str, str], lines: int, counts: dict[str, int]):
        words = vocabulary(templates)
        self.weight = {w: math.log((1 + lines) / (1 + counts.get(w, 0))) + 1 for w in words}
        self.other = math.log((1 + lines) / 2) + 1
        self.known = words
        self.vectors = {name: self._unit(terms(text)) for name, text in sorted(templates.items())}

    def _unit(self, counts: Counter) -> Vector:
        vector = {w: n * self.weight.get(w, self.other) for w, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in vector.values()))
        return {w: x / norm for w, x in vector.items()}

    def parts(self, text: str) -> tuple[str, float, float, Vector] | None:
        """Best template, its scalar product, the square of the known words' norm, and the other words; none if no word is known."""
        words = _WORDS.findall(text.lower())
        if not self.known.intersection(words):
            return None
        counts = Counter(words)
        vector = {w: n * self.weight[w] for w, n in counts.items() if w in self.known}
        found = (None, 0.0)
        for name, template in self.vectors.items():
            value = sum(x * vector[w] for w, x in template.items() if w in vector)
            if value > found[1] * (1 + 1e-12):
                found = (name, value)
        return *found, sum(x * x for x in vector.values()), {w: n for w, n in counts.items() if w not in self.known}

    def best(self, text: str) -> tuple[str | None, float]:
        """Best template and its cosine if no other word had more lines than one."""
        found = self.parts(text)
        if found is None:
            return None, 0.0
        name, product, square, others = found
        return name, product / math.sqrt(square + sum((n * self.other) ** 2 for n in others.values()))

    def units(self, text: str | None, threshold: float) -> Iterator[tuple[int, str, float, float, Vector]]:
        """Number and parts of the lines, and of the text as a whole, that may reach the threshold."""
        lines = (text or "").split("\n")
        for i, part in enumerate(lines if len(lines) == 1 else [*lines, text]):
            found = self.parts(part)
            if found and found[1] >= (threshold - 1e-9) * math.sqrt(found[2] + sum(n * n for n in found[3].values())):
                yield i, *found


UNITS = (
    T.StructType()
    .add("k1", T.LongType())
    .add("k2", T.LongType())
    .add("unit", T.LongType())
    .add("name", T.StringType())
    .add("product", T.DoubleType())
    .add("square", T.DoubleType())
    .add("words", T.ArrayType(T.StringType()))
    .add("times", T.ArrayType(T.LongType()))
)


def candidates(keyed: DataFrame, matcher: Broadcast, threshold: float) -> DataFrame:
    """Lines and whole texts of (k1, k2, text) that may reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            rows = [
                (k1[i], k2[i], *unit[:-1], [*unit[-1]], [*unit[-1].values()])
                for i, value in enumerate(batch.column("text"))
                for unit in matcher.value.units(value.as_py(), threshold)
            ]
            columns = zip(*rows, strict=True) if rows else [[]] * len(UNITS)
            kinds = [_arrow_type(f.dataType) for f in UNITS]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=UNITS.names)

    return keyed.mapInArrow(run, UNITS)


def own_licences(
    files: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """Add ``own_licence`` and ``similarity``, under free names.

    Equal texts are one until the last join. Only texts that may have a licence are joined.
    """
    licence_name, similarity_name = free_names(files, "own_licence", "similarity")
    spark = files.sparkSession
    frequencies = stored(document_frequencies(files, text))
    known = F.col("word").isNull() | F.col("word").isin(*vocabulary(templates))
    counts = {r.word: r.n for r in frequencies.where(known).collect()}  # a row per template word
    lines = counts.pop(None, 0)
    matcher = spark.sparkContext.broadcast(Matcher(templates, lines, counts))

    value = F.col(f"`{text}`")
    keys = [F.xxhash64(value).alias("k1"), F.xxhash64(F.lit(1), value).alias("k2")]
    units = stored(candidates(files.select(value.alias("text"), *keys), matcher, threshold)).dropDuplicates(["k1", "k2", "unit"])
    each = units.select("k1", "k2", "unit", F.explode(F.arrays_zip("words", "times")).alias("x"))
    each = each.select("k1", "k2", "unit", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    weight = F.log(F.lit(1.0 + lines) / (1 + F.col("n"))) + 1
    others = (
        each.join(frequencies.where("word IS NOT NULL"), "word")
        .groupBy("k1", "k2", "unit")
        .agg(F.sum((F.col("times") * weight) ** 2).alias("others"))
    )
    cosine = F.col("product") / F.sqrt(F.col("square") + F.coalesce("others", F.lit(0.0)))
    valued = units.join(others, ["k1", "k2", "unit"], "left").select("k1", "k2", "unit", "name", cosine.alias("cosine"))
    order = F.struct(F.round("cosine", 12), -F.col("unit"))  # the last bits depend on the order of the sum
    found = stored(
        valued.where(F.col("cosine") >= threshold)
        .groupBy(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
        .agg(F.max_by(F.struct("name", "cosine"), order).alias("_best"))
    )

    row = F.struct(*[F.col(f"`{c}`") for c in files.columns]).alias("own")
    flagged = bitmaps.flagged(files.select(row, *keys), "k1", found, "_k1")
    same = (F.col("_row.k1") == F.col("_k1")) & (F.col("_row.k2") == F.col("_k2"))
    touched = flagged.where("_maybe").join(found, same, "left").select("_row", "_best")
    whole = flagged.where("NOT _maybe").select("_row", F.lit(None).cast(found.schema["_best"].dataType).alias("_best"))
    return touched.unionByName(whole).select(
        *[F.col(f"_row.own.`{c}`") for c in files.columns],
        F.col("_best.name").alias(licence_name),
        F.coalesce("_best.cosine", F.lit(0.0)).alias(similarity_name),
    )


def inherit(
    files: DataFrame, any_file: bool = False, own_licence: str = "own_licence", similarity: str = "similarity"
) -> DataFrame:
    """Add ``licence`` and ``licence_from`` (a path), under free names, to files with path, own_licence and similarity.

    Directories are resolved once each, so a directory with very many files is one row until the last join.
    """
    own = [F.col(f"`{c}`") for c in files.columns]
    licence_name, giver_name = free_names(files, "licence", "licence_from")
    parts = F.split("path", "/")
    directory = F.when(F.col("path").isNotNull(), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"))
    placed = files.select(F.struct(*own).alias("row"), directory.alias("dir"))
    giving = F.col(f"row.`{own_licence}`").isNotNull() & (F.lit(any_file) | F.col("row.path").rlike(LICENCE_NAMES))
    rank = F.struct((-F.col(f"row.`{similarity}`")).alias("s"), F.col("row.path").alias("path"))
    holders = (
        placed.where(giving & F.col("dir").isNotNull())
        .groupBy("dir")
        .agg(F.min(F.struct(rank.alias("rank"), F.col(f"row.`{own_licence}`").alias("licence"))).alias("best"))
        .select(F.col("dir").alias("above"), F.col("best.licence").alias("given"), F.col("best.rank.path").alias("giver"))
    )
    dirs = placed.where(F.col(f"row.`{own_licence}`").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
    steps = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    chain = dirs.select(
        "dir",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))).alias("depth", "above"),
    )
    nearest = (
        chain.join(holders, "above")
        .groupBy("dir")
        .agg(F.max_by(F.struct("given", "giver"), "depth").alias("found"))
        .select(F.col("dir").alias("of_dir"), "found")
    )
    open_ = F.when(F.col(f"row.`{own_licence}`").isNull(), F.col("dir"))
    joined = placed.join(nearest, open_ == F.col("of_dir"), "left")
    return joined.select(
        "row.*",
        F.coalesce(f"row.`{own_licence}`", "found.given").alias(licence_name),
        F.when(F.col(f"row.`{own_licence}`").isNotNull(), F.col("row.path")).otherwise(F.col("found.giver")).alias(giver_name),
    )

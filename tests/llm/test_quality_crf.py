import itertools
import zlib

import numpy as np
import pyarrow as pa

from saleslake.llm import arrays
from saleslake.llm import quality_crf as q
from saleslake.llm.queries import op4_quality_crf

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    first = np.array([0, 3, 4, 9])
    score, pairs = rng.normal(size=9), rng.normal(size=(2, 2))
    good, expected, z = q.forward_backward(score, pairs, first)
    want, want_pairs, want_z = np.zeros(9), np.zeros((2, 2)), 0.0
    for a, b in itertools.pairwise(first):
        paths = list(itertools.product((0, 1), repeat=b - a))
        value = [sum(score[a + i] * y for i, y in enumerate(p)) + sum(pairs[x] for x in itertools.pairwise(p)) for p in paths]
        log_z = np.logaddexp.reduce(value)
        want_z += log_z
        for p, v in zip(paths, np.exp(value - log_z), strict=True):
            want[a:b] += v * np.array(p)
            for x in itertools.pairwise(p):
                want_pairs[x] += v
    assert np.allclose(good, want) and np.allclose(expected, want_pairs) and np.isclose(z, want_z)


def test_lines():
    texts = ["a\n\nb c.", "", "\n", "x", "A B\nA B"]
    data, offsets = arrays.text_bytes(pa.array([None, *texts]))
    starts, ends, first = q.split_lines(data, offsets)
    raw = data.tobytes()
    got = [[raw[a:b].decode() for a, b in zip(starts[i:j], ends[i:j], strict=True)] for i, j in itertools.pairwise(first)]
    assert got == [t.split("\n") for t in ["", *texts]]
    features, size, _ = q.line_features(data, offsets)
    assert features.shape == (len(starts), 3 * q.OWN) and size.tolist() == (ends - starts + 1).tolist()
    assert features[:, 11].tolist() == [0] * (len(starts) - 1) + [1]


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op4_quality_crf(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    unseen = [r for r in rows if r.held_out and r.doc_id in labels]
    for quality in (0, 1):
        own = [r.predicted == quality for r in unseen if labels[r.doc_id] == quality]
        assert sum(own) >= 0.9 * len(own)


def test_odd_rows(spark):
    schema = "doc_id long, text string, weights string"
    docs = spark.createDataFrame([(1, None, ""), (None, "", ""), (2, "a\n" * 50_000, ""), (2, "x", "")], schema)
    model = q.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    rows = q.score(docs, model, lines="marginals").collect()
    assert [r.score for r in rows] == [0.5] * 4 and len(rows[2].marginals) == 50_001
    assert q.score(docs.limit(0), model).count() == 0
    clash = q.score(docs, model, name="weights")
    assert clash.columns == [*docs.columns, "weights_1"] and [r.weights_1 for r in clash.collect()] == [0.5] * 4


def test_training_rows_do_not_depend_on_the_order_of_rows(spark):
    """Contradictory and repeated labels, and ids with several texts."""
    good = [f"The {w} of the city was opened by the mayor in spring." for w in ("bridge", "school", "market", "garden", "library", "station")]
    rows = [(i, good[i % 6] if i % 2 else "$$$ click here ### $$$") for i in range(0, 60)]
    rows += [(5, "$$$ another text of the same id"), (7, None), (9, "x" * 300_000)]
    labels = [(i, i % 2) for i in range(60)] + [(1, 1), (3, 0), (4, 1), (None, 1), (6, None), (8, 7)]
    models = []
    for order in (1, -1):
        docs = spark.createDataFrame(rows[::order], "doc_id long, text string").repartition(3)
        models.append(q.fit(docs, spark.createDataFrame(labels[::order], "doc_id long, quality int").repartition(2)))
    one, two = models
    assert (one.weights == two.weights).all() and (one.pairs == two.pairs).all() and one.slope == two.slope
    clear = [x for x in labels if x[0] not in (3, 4)]
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(clear, "doc_id long, quality int")
    assert (q.fit(docs, table).weights == one.weights).all()  # contradictory labels count for nothing

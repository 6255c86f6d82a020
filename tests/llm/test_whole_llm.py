"""Cases that the operators once judged by less than the whole of their input."""

import random

import numpy as np

from pushbroom.llm import embeddings


def test_rows_that_share_a_doc_id_are_judged_by_their_texts(spark):
    import corpus_pipeline as C

    rng = random.Random(3)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(5))
    rows = [(1, a + " end", "x"), (3, a, "x"), (3, b, "x"), (7, b + " end", "x"), (9, c, "x"), (9, d, "x"), (11, e, "x"), (11, e, "y"), (12, e + " end", "x"), (None, a, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [{(r.doc_id, r.text, r.source) for r in C.keep_one_of_each_group(spark, docs.repartition(n), "").collect()} for n in (1, 3)]
    assert kept[0] == kept[1]
    assert sorted((i, t) for i, t, _ in kept[0] if i is not None) == sorted([(1, a + " end"), (3, b), (9, c), (9, d), (11, e)])
    assert (None, a, "x") in kept[0]


def test_pairs_that_meet_through_probes_only_link_once():
    vectors = [v.tobytes() for v in embeddings.unit(np.array([[1.0, 0.0], [1.0, 0.01]]))]

    def links(codes, table, bucket):
        held = {"vector": vectors, "h": [1, 2], "copies": [1, 1], "right": [0, 0], "table": [table] * 2, "bucket": [bucket] * 2, "codes": codes}
        return embeddings._compare(0.98)(held)

    probes = [[1, 7, 8, 9, 20, 21, 22, 23], [2, 8, 7, 5, 20, 31, 32, 33]]
    assert links(probes, 0, 7) == [(1, None, 1), (2, None, 1), (1, 2, None)]
    assert links(probes, 0, 8) == links(probes, 1, 20) == [(1, 2, None)]


def test_sketches_bound_cosines():
    rng = np.random.default_rng(6)
    for dim in (1, 2, 5, 16, 17, 64, 300):
        x = embeddings.unit(rng.normal(size=(200, dim)))
        x[100:] = embeddings.unit(x[:100] + 0.1 * rng.normal(size=(100, dim)))
        bound, cos = embeddings.bounds(embeddings.sketch(x)), x @ x.T
        assert (bound >= cos).all()
        # most pairs that are far from the threshold need no exact comparison
        if dim >= 5:
            assert (bound[cos < 0.5] < embeddings.THRESHOLD).mean() > 0.9


def test_recall_in_any_dimension():
    rng = np.random.default_rng(7)
    for dim in (2, 3, 4, 8, 16, 64, 256, 1024):
        x = embeddings.unit(rng.normal(size=(300, dim)))
        r = rng.normal(size=x.shape)
        r = embeddings.unit(r - (r * x).sum(1, keepdims=True) * x)
        y = 0.98 * x + np.sqrt(1 - 0.98**2) * r
        for functions in (1, 2, 3):
            tables = min(embeddings.tables_for(functions), 8 if dim > 256 else 99)
            a, b = (embeddings.codes(v, functions, tables) for v in (x, y))
            assert (a[:, :, :, None] == b[:, :, None, :]).any((1, 2, 3)).mean() >= 0.97, (dim, functions)


def test_recall_does_not_fall_with_more_functions():
    rng = np.random.default_rng(4)
    x = embeddings.unit(rng.normal(size=(4000, 64)))
    r = rng.normal(size=x.shape)
    r = embeddings.unit(r - (r * x).sum(1, keepdims=True) * x)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * r
    assert [embeddings.tables_for(n) for n in (1, 2)] == [embeddings.TABLES] * 2
    for n in (3, 4):
        a, b = (embeddings.codes(v, n, embeddings.tables_for(n)) for v in (x, y))
        assert (a[:, :, :, None] == b[:, :, None, :]).any((1, 2, 3)).all()

"""The n-gram Jaccard join against brute force where groups are large, chained or hot, and doc_ids repeat."""

import random

import pytest

from pushbroom.llm import partenum


def shingles(text, k):
    ws = (text or "").encode().lower().split()
    return frozenset(tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))) if ws else frozenset()


def brute(rows, k, percent):
    """The least doc_id reachable from each doc_id: by links of texts, and by texts of one doc_id."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in up}


def families(rng, families, copies, length):
    """Texts in families of near copies, each an edit of one before it; some edits are heavy, so families fall into several components."""
    out = []
    for f in range(families):
        texts = [[f"f{f}w{rng.randrange(10**6)}" for _ in range(rng.randrange(4, length))]]
        for _ in range(rng.randrange(copies)):
            ws = list(rng.choice(texts))
            for _ in range(rng.randrange(1 + len(ws) // rng.choice([4, 12, 40]))):
                ws[rng.randrange(len(ws))] = f"e{rng.randrange(10**6)}"
            texts.append(ws + [f"t{rng.randrange(9)}"] * rng.randrange(3))
        out += [" ".join(t) for t in texts]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("k, percent, local, block, lead, n", [(4, 85, 64, 400, 10, 12), (2, 60, 2, 3, 1, 8), (5, 80, 1, 2, 1, 8), (5, 80, 1, 2, 99, 8)])
def test_components_of_families(spark, monkeypatch, k, percent, local, block, lead, n):
    monkeypatch.setattr(partenum, "LOCAL", local)
    monkeypatch.setattr(partenum, "BLOCK", block)
    monkeypatch.setattr(partenum, "BLOCKS_TO_LEAD", lead)
    monkeypatch.setattr(partenum, "PACK", 3000)
    monkeypatch.setattr(partenum, "LEAST_SLICE", 200)
    rows = list(enumerate(families(random.Random(percent), n, 30, 90)))
    want = brute(rows, k, percent)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in partenum.jaccard_classes(spark, df, k, percent, links=False).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(shingles(t, k)) and got[i].n_links is None for i, t in rows)
    assert len(set(want.values())) > n


def test_texts_of_one_doc_id_join_their_components(spark):
    rng = random.Random(2)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(100)) for _ in range(5))
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " y"), (5, c), (6, c + " x"), (6, d), (8, d), (8, e), (9, e + " u v"), (9, None), (None, a), (10, " ")]
    got = partenum.jaccard_classes(spark, spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == brute(rows, 4, 85) == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 8: 5, 9: 5, 10: 10}
    assert {r.doc_id: r.n_links for r in got if r.doc_id} == {1: 2, 2: 1, 3: 1, 5: 1, 6: 2, 8: 2, 9: 1, 10: 0}


def test_bitmaps_bound_differences():
    import numpy as np

    rng = np.random.default_rng(1)
    for size in (1, 5, 40, 700):
        a = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 1 << 64, size, dtype=np.uint64)]))
        least = partenum._least_difference(partenum.bitmap(a), partenum.bitmap(b))
        assert least <= len(np.setxor1d(a, b)) and least >= len(np.setxor1d(a, b)) // 2
        assert partenum._least_difference(partenum.bitmap(a), partenum.bitmap(a)) == 0


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_a_signature_is_shared_at_the_threshold(percent):
    import numpy as np

    rng, bands = np.random.default_rng(percent), partenum.Bands(percent)
    for size in (3, 8, 9, 17, 60, 250, 2000):
        for small in {size, max(1, -(-size * percent // 100)), (size + -(-size * percent // 100)) // 2}:
            for _ in range(8):
                # as many differences as the threshold allows
                common = -(-percent * (size + small) // (100 + percent))
                if common > small:
                    continue
                x = rng.integers(0, 1 << 64, size + small - common, dtype=np.uint64)
                a, b = np.sort(x[:size]), np.sort(np.concatenate([x[:common], x[size:]]))
                assert len(np.intersect1d(partenum.signatures(a, bands), partenum.signatures(b, bands)))

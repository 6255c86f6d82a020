"""Operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pushbroom.llm import components as components_module
from pushbroom.llm import decontaminate, embeddings, language, line_runs, mixing, partenum, quality, tokens, url_rules, warc
from pushbroom.llm.components import connected_components
from pushbroom.llm.registry import vocabulary
from pushbroom.llm.store import Workspace

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def texts(n=60, seed=0):
    """Texts over few words, with near copies, copies, shared lines, nulls and a long one."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        if i % 5 == 4 and out[-1]:
            ws = out[-1].split(" ")
            ws[rng.randrange(len(ws))] = "changed"
            out.append(" ".join(ws) if i % 2 else out[-1])
        else:
            out.append(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 120))) + "\nA line that many texts share, long enough.\n " + str(i % 3))
    return [*out, None, "", " \t ", "one two", "ONE two", "x" * 5000 + " " + " ".join(words * 5)]


def documents(spark, extra=()):
    rows = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None, "é"][i % 4], 0) for i, t in enumerate(texts())]
    return frame(spark, [*rows, *extra], DOC)


def components(n, links):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("many", [200_000, 3])
def test_components(spark, monkeypatch, many):
    monkeypatch.setattr(components_module, "MANY_EDGES", many)
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(40)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(Workspace(spark, "t"), frame(spark, edges, "a long, b long")).collect()}
    want = components(200, [(a, b) for a, b in edges if a is not None])
    touched = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert got == {i: want[i] for i in touched}
    assert connected_components(Workspace(spark, "t"), frame(spark, [], "a long, b long")).count() == 0


# token ids


@pytest.mark.parametrize("text", ["", "a  b", " a b ", "a \n b", "a\n b", " ", "it's 12  3", "a\u3000b c", "\n\n a", "a <|endoftext|> b", "a\0b c", "é ñ 漢字 x"])
def test_pieces_encode_as_the_whole(text):
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(vocabulary()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.Encoder(vocabulary())(text), "<u2").tolist() == want


def test_token_records(spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    docs = documents(spark, [(3, "again", None, None, 1), (None, "no id", None, None, 1)])
    path = f"file://{tmp_path}/tokens"
    tokens.write_tokens(spark, docs, vocabulary(), path, shard_bytes=4000)
    got = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is not None, i or 0))
    by_id = Counter()
    for r in docs.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [2]
        by_id[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert by_id == Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:n]) for n in range(len(got))]
    cut = tokens.read_shuffled(spark, path, 1).collect()
    assert sorted(len(next(tokens.frames(bytes(r.frame)))[2]) for r in cut) == sorted(9 + 2 * r.n_tokens for r in got)
    assert [r.doc_id for r in cut] != [r.doc_id for r in got]
    assert tokens.token_table(spark, docs.limit(0), vocabulary()).count() == 0


def test_damaged_frames_are_found():
    good = tokens.frame(5, b"\1\0\2\0", False) + b"\0"
    assert [tokens.parse(p)[0] for _, _, p in tokens.frames(good * 2)] == [5, 5]
    for k in (0, 9, 14, len(good) - 3):
        with pytest.raises(ValueError):
            list(tokens.frames(good[:k] + bytes([good[k] ^ 1]) + good[k + 1 :]))


# URL rules


def test_url_rules(spark):
    rules = [url_rules.rule(*r) for r in [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("block", "com"), ("allow", "example.org/es/a")]]
    urls = ["http://Example.org/es/x", "https://a.example.org/en/17?x", "http://badexample.org/en/1", "http://x.org", "http://x.org/", None, "nothing", "http://y.com:80/", "ftp://q.com#f", "a://b://c", "http://example.org/es/ab", "http://organic.net/org/"]
    df = frame(spark, [(i, u, "old", "old") for i, u in enumerate(urls)], "id int, url string, rule string, host string")
    for block in (200_000, 2):
        got = {r.id: r for r in url_rules.judge(df, rules, block=block).collect()}
        for i, u in enumerate(urls):
            rest = u.split("://", 1)[1] if u and "://" in u else ""
            host = rest.split("/")[0].split("?")[0].split("#")[0]
            path = rest[len(host) :].split("?")[0].split("#")[0]
            host = host.lower()
            fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
            best = max(fits, key=lambda r: len(r.text), default=None)
            assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, best and best.text, best.verdict if best else "allow"), u
    assert url_rules.index(rules, {"es": 1, "example": 9, "org": 5, "en": 7})["es"] == [1, 4]


def test_urls_that_repeat_or_are_very_long_and_no_urls(spark):
    rules = [url_rules.rule(*r) for r in [("block", "a.org/x"), ("allow", "a.org/x/y")]]
    long = "http://a.org/x/y/" + "p" * 200_000 + "?q"
    df = frame(spark, [(1, "http://b.a.org/x1"), (1, "http://b.a.org/x1"), (2, long), (None, "http://a.org/x")], "id int, url string")
    got = sorted(((r.id, r.rule, r.verdict, len(r.path)) for r in url_rules.judge(df, rules).collect()), key=str)
    assert got == sorted([(1, "a.org/x", "block", 3)] * 2 + [(2, "a.org/x/y", "allow", 200_005), (None, "a.org/x", "block", 2)], key=str)
    assert url_rules.judge(df.limit(0), rules).count() == 0


# mixing


def test_mix(spark):
    docs = documents(spark, [(3, "again and again", None, "b", 1), (3, "again and again", None, "b", 1), (None, "no id", None, "a", 1)])
    rows = mixing.mix(spark, docs, keep=("source",)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(spark, docs, keep=("source",)).collect()), key=str)
    assert Counter(r.size for r in rows) == Counter(len((r.text or "").encode().split()) for r in docs.collect())
    total = sum(r.size for r in rows)
    by = {}
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size)
        by.setdefault(r.source, []).append(r)
    assert sum(v[0].target for v in by.values()) == pytest.approx(1.5 * total)
    for v in by.values():
        assert v[0].source_size == sum(r.size for r in v) and v[0].target <= 2 * v[0].source_size + 1e-9
        assert abs(sum(r.taken for r in v) - v[0].target) <= max(r.size for r in v) / 2 + 1
    assert mixing.mix(spark, docs.limit(0)).count() == 0
    mixed = mixing.mixed(spark, docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)


def test_the_sliced_cut_is_the_sorted_cut(spark, monkeypatch):
    docs = frame(spark, [(i, "w " * (1 + i * 7 % 30), None, "a" if i % 3 else "b", 0) for i in range(300)], DOC)
    whole = sorted(map(tuple, mixing.mix(spark, docs).collect()))
    monkeypatch.setattr(mixing, "SLICE_ROWS", 10)
    assert sorted(map(tuple, mixing.mix(spark, docs).collect())) == whole


# embeddings


def test_embedding_links(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(12, 20))
    vecs = [list(map(float, base[i % 12] + 0.03 * (i // 12) * rng.normal(size=20))) for i in range(90)]
    rows = [(i, v, i % 12 % 3) for i, v in enumerate(vecs)]
    rows += [(100, vecs[0], 0), (101, [2 * x for x in vecs[0]], 0), (102, vecs[0], None), (103, None, 0), (104, [0.0] * 20, 0), (105, [float("nan")] + vecs[0][1:], 0), (106, [float("inf")] + vecs[0][1:], 0), (107, [], 0), (108, vecs[0][:7], 0), (109, [None] + vecs[0][1:], 0), (100, vecs[0], 0)]
    df = frame(spark, rows, "vec_id long, embedding array<double>, label int").withColumn("kept", F.lit("clash"))
    sound = {i: (np.array(v) / np.linalg.norm(v), g) for i, v, g in rows if i < 102 or i == 108}
    links = [(a, b) for a in sound for b in sound if a != b and sound[a][1] == sound[b][1] and len(sound[a][0]) == len(sound[b][0]) and sound[a][0] @ sound[b][0] >= 0.98]
    n, comp = Counter(a for a, _ in links), components(110, links)
    got = embeddings.near_duplicates(spark, df).collect()
    assert len(got) == len(rows) and len(links) > 50
    for r in got:
        assert (r.n_links, r.component_id, r.kept) == (n[r.vec_id], comp[r.vec_id], comp[r.vec_id] == r.vec_id), r
    assert embeddings.near_duplicates(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("functions, least", [(1, 1.0), (2, 0.999), (3, 0.99)])
def test_recall_at_the_threshold(functions, least):
    rng = np.random.default_rng(1)
    x = embeddings.unit(rng.normal(size=(1500, 64)))
    r = rng.normal(size=x.shape)
    r = embeddings.unit(r - (r * x).sum(1, keepdims=True) * x)
    a, b = (embeddings.codes(v, functions) for v in (x, 0.98 * x + np.sqrt(1 - 0.98**2) * r))
    assert ((b == a[:, :, :1]).any(2) | (a == b[:, :, :1]).any(2)).any(1).mean() >= least


# WARC


def test_warc(spark, tmp_path):
    rng = random.Random(2)
    big = bytes(rng.randrange(256) for _ in range(300_000))
    pages = [(i, f"http://h/{i}\r\n%", big[: rng.randrange(3000)] if i % 4 else b"same") for i in range(40)] + [(40, None, None), (41, "u", b""), (None, "v", b"same"), (43, "w", big), (44, "zip", zlib.compress(big)[:100] + b"\x1f\x8b\x08" * 50), (4, "again", b"same")]
    df = frame(spark, pages, "page_id long, url string, payload binary").withColumn("digest", F.lit("clash"))
    path = f"file://{tmp_path}/warc"
    warc.write_warc(spark, df, path)
    first = {}
    for i, _, p in pages:
        if i is not None:
            first[p or b""] = min(i, first.get(p or b"", 10**9))
    want = Counter()
    for i, u, p in pages:
        p = p or b""
        revisit = i != first.get(p, i)
        want[i, len(p), warc.base32_sha1(p), "revisit" if revisit else "response", first[p] if revisit else None, u, None if revisit else p] += 1
    for split in (warc.SPLIT_BYTES, 700):
        got = warc.read_warc(spark, path, split).collect()
        assert Counter((*r[:6], None if r.payload is None else bytes(r.payload)) for r in got) == want
    warc.write_warc(spark, df.limit(0), f"{path}0")
    warc.write_warc(spark, df, f"{path}1", min_bytes=5)
    assert warc.read_warc(spark, f"{path}1").where("record_type = 'revisit' and payload_bytes < 5").count() == 0


def test_long_members_are_read_in_pieces(spark, tmp_path):
    import io

    rng = np.random.default_rng(3)
    payloads = [rng.bytes(3_000_000), b"<html>short</html>", rng.bytes(1_500_000)]
    data = b"".join(warc.member(i, "u", p, warc.base32_sha1(p), None, False) for i, p in enumerate(payloads))
    held = []

    class Watched(warc._Bytes):
        def forget(self, before):
            super().forget(before)
            held.append(len(self.data))

    kept, warc._Bytes = warc._Bytes, Watched
    try:
        for cut in (len(data), 700_000):
            got = [warc.parse(r)[6] for start in range(0, len(data), cut) for _, r in warc.records_in(io.BytesIO(data), start, min(len(data), start + cut))]
            assert got == payloads
    finally:
        warc._Bytes = kept
    assert max(held) <= 8 * warc._CHUNK


# n-gram Jaccard join


def jaccard(rows, k, percent):
    def shingles(t):
        ws = (t or "").encode().lower().split()
        return frozenset(tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))) if ws else frozenset()

    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a != b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, Counter(a for a, _ in links), components(max(sets) + 1, links)


@pytest.mark.parametrize("k, percent, block", [(4, 85, 400), (1, 60, 400), (1, 60, 3)])
def test_jaccard_classes(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(partenum, "BLOCK", block)
    rows = [(i, t) for i, t in enumerate(texts(90, 3))]
    df = frame(spark, [*rows, rows[5], (None, rows[5][1])], "doc_id long, text string").withColumn("n", F.lit("clash"))
    sets, n, comp = jaccard(rows, k, percent)
    got = partenum.jaccard_classes(spark, df, k, percent).collect()
    assert len(got) == len(rows) + 2 and sum(n.values()) > 10
    for r in got:
        assert tuple(r)[1:] == ((len(sets[r.doc_id]), n[r.doc_id], comp[r.doc_id]) if r.doc_id is not None else (len(sets[5]), 0, None)), r
    assert partenum.jaccard_classes(spark, df.limit(0), k, percent).count() == 0


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for size in [*range(1, 40), 63, 100, 333, 1500]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            # as different as the threshold lets it be
            drop = int(rng.integers(0, size + 1))
            b = a[rng.permutation(size)[drop:]]
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, int(rng.integers(0, size + 1)), dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if len(b) and 100 * common >= percent * (len(a) + len(b) - common):
                bands = partenum.Bands(percent)
                assert len(np.intersect1d(partenum.signatures(a, bands), partenum.signatures(b, bands)))


# lines


def test_line_dedup(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(90, "Long line number one, yes.\n  LONG line number one, yes.\nx"), (91, "long LINE number one, yes."), (92, "é" * 19), (93, "é" * 20), (94, "é" * 20), (95, "\té" + "é" * 19), (96, "Long line number one, yes.")]
    df = frame(spark, rows, "doc_id long, text string").withColumn("drops", F.lit("clash"))
    held, last = {}, {}
    lines = {i: (t or "").encode().split(b"\n") for i, t in rows}
    key = lambda x: x.strip().lower()
    for i, ls in lines.items():
        for x in {key(x) for x in ls if len(key(x).decode()) >= 20}:
            held[x] = held.get(x, 0) + 1
            last[x] = max(i, last.get(x, i))
    for batches in (1, 7):
        got = {r.doc_id: r for r in line_runs.dedup_lines(spark, df, batches=batches).collect()}
        for i, ls in lines.items():
            kept = [x for x in ls if held.get(key(x), 0) < 3 or last[key(x)] == i]
            r = got[i]
            assert (r.n_lines, r.n_dropped, r.kept_sha256, r.text.encode()) == (len(ls), len(ls) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest(), b"\n".join(kept))
    assert line_runs.dedup_lines(spark, df.limit(0)).count() == 0


def test_lines_of_rows_without_ids_and_of_rows_that_repeat(spark):
    common, other = "A line that many hold, long enough", "Another such line, of null ids alone"
    rows = [(None, f"{common}\n{other}\nx"), (None, f"{common}\ny"), (5, common), (5, common), (7, f"{common}\n7"), (None, f"{common}\n{other}\nx"), (None, f"{other}\nz"), (8, None)]
    for batches in (1, 3):
        got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_runs.dedup_lines(spark, frame(spark, rows, "doc_id long, text string"), batches=batches).collect())
        # null ids are never the largest unless all are null
        assert got == Counter([(None, 3, 1, f"{other}\nx"), (None, 2, 1, "y"), (5, 1, 1, ""), (5, 1, 1, ""), (7, 2, 0, f"{common}\n7"), (None, 3, 1, f"{other}\nx"), (None, 2, 0, f"{other}\nz"), (8, 1, 0, "")])


def test_runs_are_neither_dealt_nor_sorted_again(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = line_runs.LineRuns(Workspace(spark, "t"), fanout=9)
        for n in range(3):
            runs.add(frame(spark, [(n, k, k) for k in range(n * 300, n * 300 + 600)], "doc_id long, k1 long, k2 long"))
        totals = runs.totals()
        assert totals.count() == 1200 and totals.agg(F.sum("docs")).first()[0] == 1800
        runs.fanout = 3
        runs.compact()
        assert [r.rdd.getNumPartitions() for r in runs.runs()] == [4] and sum(f.endswith(".parquet") for f in runs.runs()[0].inputFiles()) == 4
        batch = frame(spark, [(9, 1, 1)], "doc_id long, k1 long, k2 long").groupBy("k1", "k2").count()
        for r in runs.runs():
            batch = batch.join(r.select("k1", "k2", F.lit(1).alias(f"_{id(r)}")).hint("merge"), ["k1", "k2"], "left")
        plan = batch._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange") == 1 and plan.count(" Sort [") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_runs_are_disjoint_and_levelled(spark):
    runs, seen = line_runs.LineRuns(Workspace(spark, "t"), fanout=2), set()
    for n in range(5):
        batch = {(k, k) for k in range(n * 3, n * 3 + 6)}
        fresh = {(r.k1, r.k2) for r in runs.add(frame(spark, [(n, *k) for k in batch], "doc_id long, k1 long, k2 long")).collect()}
        assert fresh == batch - seen
        seen |= batch
    assert sum(r.count() for r in runs.runs()) == len(seen) and len(runs.runs()) <= 3
    assert {r.k1: r.docs for r in runs.totals().collect()} == Counter(k for n in range(5) for k in range(n * 3, n * 3 + 6))


# test items


def test_contamination(spark):
    docs = [(i, t) for i, t in enumerate(texts(40, 5))]
    long = texts(40, 9)
    items = [(0, docs[3][1]), (1, "w1 w2 w3 w4 w5 w6 w7 w8"), (2, "only four words here"), (3, None), (4, ""), (5, "ONE two"), (6, " ".join((docs[7][1] or "x").split()[:30])), (None, "w9 w8 w7 w6 w5 w4")]
    docs += [(50, " ".join(x or "" for x in long[:20]) + " w1 w2 w3 w4 w5 w6 w7 w8 " + " ".join(x or "" for x in long[20:])), (51, "a w1 w2 w3 w4 w5 w6 w7 z w8"), (52, "before Only four WORDS here after"), (52, "before Only four WORDS here after"), (None, "w9 w8 w7 w6 w5 w4")]

    def found(t, q):
        ws, qs = (t or "").lower().split(), (q or "").lower().split()
        k = min(5, len(qs))
        want, have = ({tuple(x[j : j + k]) for j in range(len(x) - k + 1)} for x in (qs, ws))
        return len(want & have) / len(want) if qs and len(want & have) >= 0.8 * len(want) else None

    d, b = frame(spark, docs, "doc_id long, text string").withColumn("item_id", F.lit("clash")), frame(spark, items, "item_id long, text string")
    want = Counter((i, q, found(t, x)) for i, t in docs for q, x in items if found(t, x) is not None)
    for block in (20_000, 3):
        got = Counter((r.doc_id, r.item_id, r.containment) for r in decontaminate.contaminated(spark, d, b, block=block).collect())
        assert got == want and len(want) > 5
    assert decontaminate.contaminated(spark, d, b.limit(0)).count() == decontaminate.contaminated(spark, d.limit(0), b).count() == 0
    assert decontaminate.clean(spark, d.limit(0), b).count() == 0
    assert {r.doc_id for r in decontaminate.clean(spark, d.where("doc_id IS NOT NULL"), b).collect()} == {i for i, _ in docs if i is not None} - {k[0] for k in want}


def test_items_in_very_long_texts_and_ties(spark):
    rng = random.Random(4)
    noise = [f"n{rng.randrange(10**6)}" for _ in range(60_000)]
    item = "the quick brown fox jumps over the lazy dog again"
    long = " ".join([*noise[:50_000], item, *noise[50_000:], *[item] * 50])
    d = frame(spark, [(1, long), (2, " ".join(noise)), (3, None)], "doc_id long, text string")
    b = frame(spark, [(7, item), (8, item), (9, item.upper()), (10, "")], "item_id long, text string")
    assert sorted(map(tuple, decontaminate.contaminated(spark, d, b).collect())) == [(1, i, 6, 1.0) for i in (7, 8, 9)]


# models


def test_quality(spark):
    rng = random.Random(0)
    good = lambda: " ".join(rng.choice(["the", "river", "runs", "slowly", "past", "old", "stone", "houses", "and", "quiet", "gardens"]) for _ in range(80))
    bad = lambda: " ".join(rng.choice(["BUY", "NOW", "$$$", "click", "!!!", "free", "###"]) + "%%" for _ in range(80))
    rows = [(i, good() if i % 4 else bad()) for i in range(400)] + [(400, None), (401, ""), (None, good())]
    docs = frame(spark, rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = frame(spark, [(i, int(i % 4 > 0)) for i in range(400)] + [(400, None), (None, 1)], "doc_id long, quality int")
    got = quality.classify(spark, docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert all(r.predicted == int(r.doc_id % 4 > 0) for r in held if r.doc_id < 400) and all(0 <= r.score <= 1 for r in got)
    assert quality.classify(spark, docs, labels.limit(0)).where("score = 0.5").count() == len(rows)


def test_language(spark):
    rng = random.Random(0)
    stems = {"xx": "ka lo mi tu sa".split(), "yy": "ber sch ung eit zen".split()}
    make = lambda g, n: " ".join("".join(rng.choice(stems[g]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    rows = [(i, make(g, rng.randrange(3, 40)) + ", 12!", g) for i in range(200) for g in [("xx", "yy")[i % 2]]]
    rows += [(200, None, "xx"), (201, "12 !!", "yy"), (202, "", None), (203, make("xx", 30) + " " + make("yy", 10), None), (204, "k" * 3000, None)]
    docs = frame(spark, rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("clash"))
    got = {r.doc_id: r for r in language.identify(spark, docs).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 200]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3
    assert got[203].lang_pred == "xx" and 0.6 < got[203].score < 0.9


def test_forward_backward_is_enumeration():
    rng = np.random.default_rng(0)
    e, start, trans = rng.normal(size=(4, 2, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    live = np.ones((4, 2), bool)
    live[2:, 1] = False
    post = language.forward_backward(e, live, start, trans)
    for r, n in ((0, 4), (1, 2)):
        total, want = 0.0, np.zeros((n, 3))
        for path in np.ndindex(*(3,) * n):
            p = np.exp(start[path[0]] + sum(e[t, r, y] for t, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
            total += p
            for t, y in enumerate(path):
                want[t, y] += p
        assert np.allclose(post[:n, r], want / total) and not post[n:, r].any()


def sequence_scores(e, start, trans):
    """The weight of every labelling of one sequence, by brute force."""
    n, k = e.shape
    for path in np.ndindex(*(k,) * n):
        yield path, np.exp(start[path[0]] + sum(e[t, y] for t, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))


def test_expected_pairs_are_enumeration():
    rng = np.random.default_rng(2)
    e, start, trans = rng.normal(size=(4, 3, 2)), rng.normal(size=2), rng.normal(size=(2, 2))
    live = np.array([[True] * 3, [True] * 3, [True, True, False], [True, False, False]])
    post = language.forward_backward(e, live, start, trans)
    want = np.zeros((2, 2))
    for r, n in ((0, 4), (1, 3), (2, 2)):
        paths = list(sequence_scores(e[:n, r], start, trans))
        for path, p in paths:
            for a, b in zip(path, path[1:]):
                want[a, b] += p / sum(q for _, q in paths)
    assert np.allclose(language.pair_counts(e, post, live, start, trans), want)


def features_by_hand(find, word):
    """Feature numbers of a word, letter by letter."""
    c = [0, *map(ord, word), 0]
    h = lambda tag, x: int(language._hash(tag, [np.array([v], np.uint32) for v in x])[0]) % language.TABLE + 1
    out = [h(1, c[i : i + 2]) for i in range(len(c) - 1)] + [h(2, c[i : i + 3]) for i in range(len(c) - 2)]
    for k in (1, 2, 3):
        if len(word) >= k:
            out += [h(2 + k, [c[min(j + 1, len(c) - 1)] for j in range(k)]), h(5 + k, [c[len(word) - j] for j in range(k)])]
    return sorted([*out, find.lexicon.get(word, 0)])


def test_features_and_document_sums_by_hand():
    rng = random.Random(3)
    segments = [(g, " ".join("".join(rng.choice(a) for _ in range(rng.randrange(1, 6))) for _ in range(20))) for g, a in (("xx", "abcé"), ("yy", "cdef")) for _ in range(20)]
    model = language.train(segments)
    find, labeller = language.Features(model.lexicon), language.Labeller(model)
    words = ["a", "cd", "abc", "é", "x" * 40, *model.lexicon[:3]]
    for at, f in find(words):
        for row, n in zip(f, at):
            assert sorted(v for v in row.tolist() if v) == [v for v in features_by_hand(find, words[n]) if v]
    texts = ["abc, cd! 12 fe", None, "...", "Dd", "dd cé aaa fed c"]
    sums = labeller(texts)
    for t, got in zip(texts, sums):
        ws = [w for w in map(language.letters, (t or "").lower().split()) if w]
        want = np.zeros(2)
        if ws:
            e = np.array([model.weights[features_by_hand(find, w)].sum(0) for w in ws])
            paths = list(sequence_scores(e, model.start, model.trans))
            for path, p in paths:
                for y in path:
                    want[y] += p / sum(q for _, q in paths)
        assert np.allclose(got, want, atol=1e-5)


def test_words_of_switching_texts(spark):
    rng = random.Random(1)
    stems = {"xx": "ka lo mi tu sa".split(), "yy": "ber sch ung eit zen".split()}
    word = lambda g: "".join(rng.choice(stems[g]) for _ in range(rng.randrange(2, 4)))
    model = language.train([(g, " ".join(word(g) for _ in range(30))) for _ in range(80) for g in stems])
    truth = [["xx"] * 6 + ["yy"] * 5, ["yy"] * 4 + ["xx"] * 7 + ["yy"] * 6, ["xx"]]
    rows = [(i, "12 " + " ".join(f'"{word(g).title()}",' for g in gs)) for i, gs in enumerate(truth)] + [(8, None), (9, "1 !"), (None, word("yy"))]
    docs = frame(spark, rows, "doc_id long, text string").withColumn("lang", F.lit("clash"))
    got = language.label_words(spark, docs, model).collect()
    assert len(got) == sum(map(len, truth)) + 1
    right = 0
    for r in got:
        if r.doc_id is None:
            assert (r.n, r.lang) == (0, "yy")
            continue
        token = rows[r.doc_id][1].split()[r.n]
        assert r.word == token.strip('",').lower() and 0.5 <= r.posterior <= 1
        right += r.lang == truth[r.doc_id][r.n - 1]
    assert right >= 0.95 * (len(got) - 1)
    assert language.label_words(spark, docs.limit(0), model).count() == language.label_words(spark, docs, language.train([])).count() == 0


def test_no_task_sorts_a_language(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "SPARE", 5)
    monkeypatch.setattr(language, "train", lambda got: seen.append(sorted(got)) or language.Model([], [], np.zeros((1, 0), np.float32), np.zeros(0), np.zeros((0, 0))))
    plans = []
    broadcast = language.F.broadcast
    monkeypatch.setattr(language.F, "broadcast", lambda df: plans.append(df) or broadcast(df))
    docs = frame(spark, [(i, f"text number {i}", "xy"[i % 2]) for i in range(400)], "doc_id long, text string, lang string")
    language.fit(spark, docs, segments=30)
    assert Counter(g for g, _ in seen[0]) == {"x": 30, "y": 30}
    # the window gets those below the cut only
    plan = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("xxhash64(doc_id") and "<= " in plan[plan.index("Filter", plan.index("Window")) :]
    first = {g: sorted((r.h, r.doc_id) for r in docs.where(f"lang = '{g}'").where("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) <> 2").select("doc_id", F.xxhash64("doc_id").alias("h")).collect())[:30] for g in "xy"}
    assert seen[0] == sorted((g, f"text number {i}") for g in "xy" for _, i in first[g])


def test_ties_repeats_and_empty_tables_of_languages(spark):
    docs = frame(spark, [(i, "same words here", g) for i, g in enumerate(["bb", "aa"] * 30)] + [(1, "same words here", "aa")], "doc_id long, text string, lang string")
    got = language.identify(spark, docs).collect()
    assert len(got) == 61 and len({(r.lang_pred, r.score) for r in got}) == 1
    assert language.identify(spark, docs.limit(0)).count() == 0
    model = language.Model(["aa", "bb"], [], np.zeros((1 + language.TABLE, 2), np.float32), np.zeros(2), np.zeros((2, 2)))
    assert [tuple(r) for r in language.label(spark, docs.limit(1).select("text"), model).select("lang_pred", "score").collect()] == [("aa", 0.5)]


# the pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as C

    docs = documents(spark, [(None, "no id at all", None, "a", 1)])
    item = " ".join(docs.where("doc_id = 8").first().text.split()[:12])
    for name, df in {"documents": docs, "labels": frame(spark, [(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int"), "benchmark": frame(spark, [(0, item)], "item_id long, text string")}.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    kept = {r.doc_id for r in C.STAGES[1][1](spark, docs, str(tmp_path)).collect()}
    _, _, comp = jaccard([(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None], 5, 80)
    assert kept == {None} | {r.doc_id for r in docs.collect() if r.doc_id is not None and comp[r.doc_id] == r.doc_id}
    clean = {r.doc_id for r in C.STAGES[2][1](spark, docs, str(tmp_path)).collect()}
    assert 8 not in clean and 1 in clean
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    out = C.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


def mixed_by_sql(rows):
    """Copies of each document by the query's SQL, for rows (doc_id, text, source) with ids of their own."""
    import duckdb
    import pandas as pd

    from pushbroom.llm.registry import ORACLE_SQL

    db, documents = duckdb.connect(), pd.DataFrame(rows, columns=["doc_id", "text", "source"])
    db.register("documents", documents)
    return {r[0]: r[4] // r[1] if r[1] else 0 for r in db.sql(ORACLE_SQL["op3_source_mix"]).fetchall()}


def test_quality_stage_by_hand(spark, tmp_path):
    import corpus_pipeline as C

    rng = random.Random(8)
    good = lambda: " ".join(rng.choice("the river runs slowly past old stone houses and quiet gardens".split()) for _ in range(90))
    bad = lambda: " ".join(rng.choice("BUY NOW $$$ click !!! free ###".split()) + "%%" for _ in range(90))
    rows = [(i, good() if i % 4 else bad(), None, "a", 1) for i in range(300)] + [(300, None, None, "a", 0), (301, "", None, None, 0), (None, good(), None, "b", 1), (5, good(), None, "b", 1), (5, bad(), None, "b", 1)]
    docs = frame(spark, rows, DOC).withColumn("score", F.lit("clash"))
    frame(spark, [(i, int(i % 4 > 0), 0) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = Counter((r.doc_id, r.text) for r in C.keep_quality(spark, docs, str(tmp_path)).collect())
    model = quality.fit(spark, docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    sizes = quality.Sizes(model.good, model.bad)
    want = Counter()
    for i, t, *_ in rows:
        # the difference and its calibration, written out
        parts = [(t or "").encode()[k : k + quality.CHUNK] for k in range(0, len((t or "").encode()), quality.CHUNK)]
        n = sum(map(len, parts))
        d = sum(len(sizes.bad.compress(c)) - len(sizes.good.compress(c)) for c in parts) / n if n else 0.0
        f = [min(max(d, -1), 1), *(max(d - b, 0) for b in model.calibration.bends)]
        z = model.calibration.weights[0] + sum(w * (v - m) / s for w, v, m, s in zip(model.calibration.weights[1:], f, model.calibration.mean, model.calibration.scale))
        if 1 / (1 + np.exp(-z)) >= quality.THRESHOLD:
            want[i, t] += 1
    assert got == want and len(want) > 200 and sum(want.values()) < len(rows)


def test_calibration_finds_the_likeliest_weights():
    rng = np.random.default_rng(0)
    d = rng.normal(size=400)
    y = (rng.uniform(size=400) < 1 / (1 + np.exp(-3 * d))).astype(float)
    model = quality.calibrate(d, y, ridge=1e-3)
    f = (quality.features(d, model.bends) - model.mean) / model.scale

    def loss(w):
        z = w[0] + f @ w[1:]
        return np.sum(np.log1p(np.exp(-np.where(y == 1, z, -z)))) + 0.5e-3 * len(d) * np.sum(w[1:] ** 2)

    best = loss(model.weights)
    for k in range(len(model.weights)):
        for step in (-1e-3, 1e-3):
            w = model.weights.copy()
            w[k] += step
            assert loss(w) >= best - 1e-9
    assert np.corrcoef(model(np.sort(d)), np.arange(400))[0, 1] > 0.9


def test_mix_stage_is_the_sql_of_the_mix(spark):
    import corpus_pipeline as C

    rows = [(i, t, ["a", "b", None, "é"][i % 4]) for i, t in enumerate(texts(120, 11))]
    docs = frame(spark, rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("col", F.lit(1))
    out = C.mix_sources(spark, docs, "")
    assert out.columns == docs.columns
    got = Counter(r.doc_id for r in out.collect())
    assert got == Counter({i: n for i, n in mixed_by_sql(rows).items() if n}) and max(got.values()) <= 2


def test_mix_stage_takes_rows_that_repeat_one_by_one(spark):
    import corpus_pipeline as C

    rows = [(i % 7 if i % 3 else None, f"word{i} " * 5, "ab"[i % 2]) for i in range(200)]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    got = Counter((r.doc_id, r.text) for r in C.mix_sources(spark, docs, "").collect())
    by = Counter()
    for (_, t), n in got.items():
        assert n <= 2
        by["ab"[int(t.split()[0][4:]) % 2]] += 5 * n
    # targets are 3 and 1 shares of 150 % of 1,000 words, none above twice a source's 500
    assert abs(by["a"] - 1000) <= 5 and abs(by["b"] - 500) <= 5
    assert C.mix_sources(spark, docs.limit(0), "").count() == 0


def test_token_stage_by_the_plain_tokenizer(spark):
    import corpus_pipeline as C
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    docs = documents(spark, [(3, "again", None, "a", 1), (3, "again", None, "b", 1), (None, "no id", None, "a", 1)])
    got = sorted(C.to_tokens(spark, docs, "").collect(), key=lambda r: r.start)
    want = Counter((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for r in docs.collect() for ids in [t.encode(r.text or "", add_special_tokens=False).ids + [2]])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1]) and got[0].doc_id is None


def test_stages_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as C

    docs = documents(spark).limit(0)
    frame(spark, [(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, [(0, "some test item of many words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in C.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0

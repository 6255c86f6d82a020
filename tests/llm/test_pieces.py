"""Pieces of texts, and what an encoder remembers of them."""

import random

import numpy as np
import pyarrow as pa

from pushbroom.llm import registry, tokens


def pieces(*texts):
    raw = [t.encode() for t in texts]
    whole, at = b"".join(raw), np.cumsum([0, *map(len, raw)])
    starts = [*tokens.cuts(np.frombuffer(whole, np.uint8), at), len(whole)]
    return [whole[i:j].decode() for i, j in zip(starts, starts[1:])]


def test_texts_are_cut_at_single_spaces_and_marks():
    assert pieces("one two,\nthree!!") == ["one", " two", ",", "\nthree", "!!"]
    assert pieces("ab ", " c", "", "d  e　 f", "don't", "ü, 2.5") == ["ab ", " c", "d  e　 f", "don't", "ü", ",", " 2.5"]


def test_an_encoder_gives_whole_texts_and_remembers_few_pieces():
    from tokenizers import Tokenizer

    plain, encode = Tokenizer.from_file(registry.vocabulary()), tokens.Encoder(registry.vocabulary(), 50)
    rng = random.Random(4)
    parts = [" ", " ", "\n", "a", "Zb", "é", "×", "”", "'", "'s", ",", "!!", "12", "　", " ", " ", "\u0085", "\t", "\x1c", "\0", "日", "😀", "  ", "́", "²", "_", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(3000)] + [None, "x" * 500]
    want = [np.array(plain.encode(t or "", add_special_tokens=False).ids, encode.kind).tobytes() for t in texts]
    for hold in (1, 300, 1_000_000):
        assert list(encode.many(texts, hold)) == want
    assert list(encode.many(pa.array(texts, pa.string())[5:])) == want[5:]
    assert len(encode.words) <= 50 and max(map(len, encode.words.to_pylist())) <= 60


def test_files_are_opened_by_workers(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one text"), (2, None)], "doc_id long, text string")
    path = f"file://{tmp_path}/tokens with a space"
    tokens.write_tokens(spark, docs, registry.vocabulary(), path)
    rows = tokens.scan(spark, path)
    assert "content" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [(r.doc_id, r.nth) for r in rows.collect()] == [(1, 0), (2, 1)]

import base64
import hashlib
import json
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from zonecast.llm import bpe_codec, token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.codec(RANKS, P.PATTERN)


def fuzz(n, seed=1):
    rng = random.Random(seed)
    letters = "abcdefgh'  \n\tÄßéñ中文字🎉́ΣİSs.!?<|>12٣\x1c\x85\xa0 stremvlld"
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(n)]
    return out + ["a" * 5000, "!" * 3000, "ab" * 2000, "don't I'll we've  \n\n x", "<|endoftext|>a<|startoftext|> b <|endoftext|"]


def test_codec_equals_library(codec, reference):
    texts = fuzz(3000)
    for t, raw in zip(texts, codec.encode(texts), strict=True):
        ids = np.frombuffer(raw, dtype=np.int32)
        assert ids.tolist() == reference.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


def test_append_and_edit_equal_a_new_encoding(codec):
    rng = random.Random(5)
    for _ in range(200):
        raw = "".join(rng.choice("abcdefghtheing") for _ in range(rng.randrange(1, 400))).encode()
        last = codec.prefixes(raw)
        at = rng.randrange(len(raw) + 1)
        cut = rng.randrange(0, min(5, len(raw) - at) + 1)
        new, got = codec.edit(raw, last, at, cut, b"xing"[:rng.randrange(5)])
        assert got == codec.prefixes(new)
        new, got = codec.append(raw, last, b"tion")
        assert got == codec.prefixes(new)


def test_encode_odd_rows(odd, odd_rows, empty, reference):
    rows = bpe_codec.digest(bpe_codec.encode(odd, RANKS, P.PATTERN)).collect()
    want = []
    for i, t, *_ in odd_rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert bpe_codec.encode(empty, RANKS, P.PATTERN).count() == 0


def test_encode_keeps_every_row_of_a_large_batch(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "concat('w', id) as text").coalesce(1)
    assert bpe_codec.encode(df, RANKS, P.PATTERN).count() == 5000
    assert token_counts.token_counts(df, JSON).count() == 5000


def test_counts_equal_library():
    texts = fuzz(3000, 2)
    want = [len(e.ids) for e in Tokenizer.from_file(JSON).encode_batch(texts, add_special_tokens=False)]
    assert token_counts.Counter(json.load(open(JSON))).count(texts) == want


def test_counts_odd_rows(odd, odd_rows, empty):
    tok = Tokenizer.from_file(JSON)
    want = [(i, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t, *_ in odd_rows]
    got = token_counts.token_counts(odd, JSON).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(empty, JSON).count() == 0

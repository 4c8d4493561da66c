import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from daylake.llm import queries, wavelet

SF = "/root/testdata/sf0.001"
PIECES = ["the", "The", "été", "ñandú", "漢字", "don't", "'ll", "x,", "-.", "a-b", "(c)", "end.", "\0", "\x00a", "ª", "µm", "9", "a1",
          " ", "  ", "\n", "\n\n", "\t", "\r", "\x1c", "\x85", " ", " ", "​", "<|endoftext|>", "<", "É", "ÿ", "×", "ß!"]


@pytest.fixture(scope="module")
def encoder():
    return wavelet.Encoder(queries.tokenizer_path())


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(queries.tokenizer_path())


def same(encoder, plain, texts):
    got = encoder.encode(pa.array(texts, pa.string()))
    want = plain.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [g.tolist() for g in got] == [w.ids for w in want]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.lists(st.sampled_from(PIECES), max_size=12).map("".join),
                          st.lists(st.sampled_from(PIECES), max_size=12).map(" ".join)), max_size=8))
def test_encoder_equals_the_tokenizer(encoder, plain, texts):
    same(encoder, plain, texts)


def test_encoder_on_many_random_texts(encoder, plain):
    rng = random.Random(11)
    stock = PIECES + ["".join(rng.choices("aeinrstléè", k=rng.randrange(1, 12))) + rng.choice(["", "", ",", ".", "!?"])
                      for _ in range(3000)]
    texts = [rng.choice([" ", " ", " ", "", "\n"]).join(rng.choices(stock, k=rng.randrange(0, 60))) for _ in range(3000)]
    for k in range(0, len(texts), 200):
        same(encoder, plain, texts[k:k + 200])
    same(encoder, plain, ["word " * 50_000 + "x" * 5000, None, ""])


def test_the_cache_may_be_forgotten(plain, monkeypatch):
    monkeypatch.setattr(wavelet, "CACHED", 5)
    encoder = wavelet.Encoder(queries.tokenizer_path())
    for k in range(20):
        same(encoder, plain, [f"some words {k}, and more-or-less {k * 7} of them", "the same again"])


def test_all_occurrences_at_once():
    rng = np.random.default_rng(3)
    for n in (1, 511, 512, 513, 5000):
        ids = (rng.zipf(1.4, n) % 700).astype(np.uint16)
        m = wavelet.WaveletMatrix(wavelet.pack(ids, [1], np.array([n]), 16))
        for token in (0, 1, 2, 300, 699, 65535, 70000):
            found = list(m.locate_all(token, step=100))
            at = np.concatenate(found) if found else np.zeros(0)
            assert at.tolist() == np.flatnonzero(ids == token).tolist()
            assert [m.locate(token, k) for k in range(min(3, len(at)))] == at[:3].tolist()


def test_token_positions_against_plain_encoding(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    ids = np.concatenate([[*plain.encode(d.text or "", add_special_tokens=False).ids, 0] for d in docs])
    at = np.flatnonzero(ids == 0)
    got = queries.token_positions(spark, SF).collect()
    assert sorted(r.position for r in got) == at.tolist() and {r.n_all for r in got} == {len(at)}

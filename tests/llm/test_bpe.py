import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quillstream.llm import bpe
from tests.llm.conftest import rows_of

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(PATH)
    out.no_truncation()
    out.no_padding()
    return out


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(open(PATH, "rb").read())


def ids(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def test_every_character(library, encoder):
    points = [*range(0xD800), *range(0xE000, 0x11000), *range(0x1F300, 0x1F700), 0x10FFFF]
    texts = [f"a{chr(p)}b {chr(p)}́x" for p in points]
    bad = [p for p, t, got in zip(points, texts, encoder.encode(texts)) if got != ids(library, t)]
    assert not bad


def test_fuzz(library, encoder):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices("aabbccdeefgh'tsrelvm 1290.,!<|>éñ\t\n\x1d ΣΑ", k=rng.randint(0, 40)))
        text += rng.choice(["", "<|endoftext|>", "x<|startoftext|>y", "a" * 15, "ab" * 8])
        assert encoder.encode([text])[0] == ids(library, text), text


def test_merges_one_place_at_a_time():
    """A vocabulary in which a product takes part in an earlier merge."""
    import json
    letters = bpe._byte_symbols()
    vocab = {c: i for i, c in enumerate([*letters, *(c + "</w>" for c in letters)])}
    merges = [("b", "c"), ("a", "bc"), ("abc", "abc</w>"), ("abc", "a"), ("a", "b"), ("ab", "c"), ("ab", "c</w>")]
    for x, y in merges:
        vocab.setdefault(x + y, len(vocab))
    spec = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "post_processor": None, "decoder": None,
            "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>",
                      "fuse_unk": False, "byte_fallback": False, "ignore_merges": False, "vocab": vocab, "merges": [list(m) for m in merges]}}
    own, library = bpe.Encoder(json.dumps(spec).encode()), Tokenizer.from_str(json.dumps(spec))
    assert own.one_by_one.any()
    rng = random.Random(2)
    for _ in range(500):
        word = "".join(rng.choices("abc", k=rng.randint(1, 14)))
        assert own.merge([word.encode()])[0] == np.array(library.encode(word).ids, "<u4").tobytes(), word


def test_digests_and_round_trip(spark, docs, texts, library):
    want = []
    for doc, text in texts:
        raw = ids(library, text)
        decoded = library.decode(np.frombuffer(raw, "<u4").tolist(), skip_special_tokens=False)
        want.append((doc, len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert rows_of(bpe.encoded_digests(docs)) == sorted(want, key=repr)
    first = texts[0]
    got = {r.doc_id: r.ids for r in bpe.encoded(docs.limit(5)).collect()}
    assert np.array(got[first[0]], "<u4").tobytes() == ids(library, first[1])
    file = bpe.tokenizer_file(spark)
    both = docs.filter("doc_id < 20").select("text", bpe.encode_column(file)("text").alias("i")).select("text", bpe.decode_column(file)("i").alias("d"))
    assert all(r.d == library.decode(library.encode(r.text, add_special_tokens=False).ids, skip_special_tokens=False) for r in both.collect())


def test_empty(no_docs):
    assert bpe.encoded_digests(no_docs).count() == 0


def test_digests_leave_a_small_cache(monkeypatch):
    """A step of a job bounds what its worker remembers; the results are those of a large cache."""
    monkeypatch.setattr(bpe, "STEP_CHUNKS", 50)
    enc = bpe.Encoder(open(PATH, "rb").read())
    texts = [" ".join(f"w{i}x{k}" for k in range(40)) for i in range(20)]
    want = [bpe.Encoder(open(PATH, "rb").read()).encode([t])[0] for t in texts[-2:]]
    got = [enc.encode([t], bpe.STEP_CHUNKS)[0] for t in texts]
    assert got[-2:] == want and len(enc.cache) <= 50 + 40

import glob
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from quillstream.llm import bpe
from quillstream.llm import token_files as K
from quillstream.llm.common import shared
from tests.llm.conftest import rows_of


def file_of(docs):
    return b"".join(p + K.LAST for p in K.file_pieces(docs))


def test_frames_and_seek_table():
    docs = [(None, b""), (-5, b"\x8f\x8f\0\0" * 3), (1, b"\x01\0\0\0" * 5), (2, b"\x02\0\0\0" * (K.FRAME_IDS + 7)), (2, b"")]
    raw = file_of(docs)
    assert [(i, x.tobytes()) for i, x in K.documents(raw)] == docs
    assert [(i, x.tobytes()) for i, x in K.documents(raw, {2, 99})] == [d for d in docs if d[0] == 2]
    assert [i for i, _ in K.documents(raw, {None})] == [None]
    # any zstandard reader can inflate the whole file; skippable frames add nothing
    assert len(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()) > 4 * K.FRAME_IDS
    assert list(K.documents(b"")) == [] and file_of([]) == b""


def test_damage_is_found():
    raw = bytearray(file_of([(i, bytes([i, 0, 0, 0]) * 50) for i in range(20)]))
    (count,) = struct.unpack("<I", raw[-9:-5])
    raw[len(raw) - 9 - 12 * count + 8] ^= 1  # the first frame's checksum in the seek table
    with pytest.raises(ValueError):
        list(K.documents(bytes(raw)))
    with pytest.raises(ValueError):
        list(K.documents(bytes(raw[:-1])))


def test_only_requested_frames_are_inflated():
    raw = bytearray(file_of([(i, bytes(4) * K.FRAME_IDS) for i in range(4)]))
    raw[20] ^= 0xFF  # breaks the first frame only
    assert [i for i, _ in K.documents(bytes(raw), {3})] == [3]
    with pytest.raises(Exception):
        list(K.documents(bytes(raw), {0}))


def test_report(spark, docs, texts, no_docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    own = {}
    for doc, text in texts:
        own.setdefault(doc, []).append(np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    want, at = [], 0
    for doc in sorted(own, key=lambda d: (d is not None, d)):
        for x in own[doc]:
            want.append((doc, at, len(x), zlib.crc32(x)))
            at += len(x)
    assert rows_of(K.token_files(docs)) == sorted(want, key=repr)
    assert K.token_files(no_docs).count() == 0


def test_read_some(spark, table_docs):
    path = shared(spark, "t")
    K.write_token_files(table_docs, path)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4") for r in K.read_token_files(spark, path, {3, 50}).collect()}
    assert set(got) == {3, 50} and all(x[-1] == K.END_ID for x in got.values())
    assert glob.glob(path.removeprefix("file://") + "/part-*")


def test_special_tokens_on_a_fresh_worker(monkeypatch):
    """The first texts that a worker encodes, and those after its memory was emptied, hold special tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    fresh = K.LibraryEncoder(open(path, "rb").read())
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 0)
    for text in ("a word<|endoftext|>x <|startoftext|> it's", "<|startoftext|>", "<|endoftext|><|endoftext|> a word"):
        assert fresh.encode([text]) == [np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()], text

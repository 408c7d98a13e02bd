"""Operator 4: BPE encoding and decoding by batched numpy merge rounds.

White space always ends a symbol run of the tokenizer, so a text is the
concatenation of its white-space-free chunks, and each distinct chunk, and each
distinct word in chunks, is encoded once per worker. All new words of a batch
lie in one flat symbol array. A round finds, by binary search over the sorted pair keys, the
rank of every adjacent pair, merges the lowest-ranked pair of each word at all
its places at once, and drops words that have no pair left.

Defined cases: null is the empty text and has no ids; special-token strings in
a text become their ids, as the library does by default; very long texts are
encoded whole. Rows are mapped one to one, so repeated rows and extra columns
need no care.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm.common import session

#: Chunks remembered per Python worker, about 200 bytes each; then the memory is emptied.
CACHE_CHUNKS = 1_000_000
#: The same where the encoder is one step of several: a worker that waits for its next
#: task keeps its memory beside that of the other steps.
STEP_CHUNKS = 200_000
#: Control characters that Python calls white space and the tokenizer does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WHITE = regex.compile(r"[^\t-\r \x85\xa0  -     　]+")
#: Texts of these characters need no library call: they are in normal form, and
#: their letters are ASCII and the accented Latin-1 ones.
_LATIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
_LATIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    itself where it is printable Latin-1, else the next unused code point from 256."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Encoder:
    """Encoder and decoder of one tokenizer file (BPE with a word-end suffix)."""

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(file)
        library = Tokenizer.from_str(file.decode())
        self.normalizer, self.pre = library.normalizer, library.pre_tokenizer
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.suffix = suffix
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        symbols = _byte_symbols()
        self.char_byte = {c: b for b, c in enumerate(symbols)}
        self.inner = np.array([vocab[c] for c in symbols], np.int64)
        self.final = np.array([vocab[c + suffix] for c in symbols], np.int64)
        pairs = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]], np.int64).reshape(-1, 3)
        key = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(key, kind="stable")
        self.keys, self.rank, self.made = key[order], order.astype(np.int64), pairs[:, 2]
        # A pair whose product takes part in an earlier merge may only be merged one place at a time.
        first_use = np.full(max(vocab.values()) + 1, len(pairs), np.int64)
        for column in (0, 1):
            np.minimum.at(first_use, pairs[:, column], np.arange(len(pairs)))
        self.one_by_one = first_use[pairs[:, 2]] <= np.arange(len(pairs))
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for text, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = text.encode()
        self.cache: dict[str, bytes] = {}
        # a special token can only be a step of its own: words hold no letters next to symbols
        self.special_ids = {t: i.to_bytes(4, "little") for t, i in self.special.items()}
        self.word_ids = dict(self.special_ids)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian 32-bit) of each word, given as its UTF-8 bytes."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[flat]
        stop = np.cumsum(length)
        sym[stop[length > 0] - 1] = self.final[flat[stop[length > 0] - 1]]
        word = np.repeat(np.arange(len(words)), length)
        done_sym, done_word = [], []
        none = len(self.rank)
        while len(sym):
            key = sym[:-1] << 32 | sym[1:]
            at = np.searchsorted(self.keys, key)
            at[at == none] = 0
            rank = np.append(np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.rank[at], none), none)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            of = np.repeat(lowest, np.diff(np.append(starts, len(sym))))
            ended = of == none
            if ended.any():
                done_sym.append(sym[ended])
                done_word.append(word[ended])
                sym, word, rank, of = sym[~ended], word[~ended], rank[~ended], of[~ended]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == of)
            # of pairs that overlap (a a a) every other one counts, from the left
            new_run = np.append(True, np.diff(hit) != 1)
            hit = hit[(np.arange(len(hit)) - np.flatnonzero(new_run)[np.cumsum(new_run) - 1]) % 2 == 0]
            single = self.one_by_one[rank[hit]]
            if single.any():
                hit = hit[~single | np.append(True, word[hit][1:] != word[hit][:-1])]
            sym[hit] = self.made[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            sym, word = sym[keep], word[keep]
        if not done_sym:
            return [b""] * len(words)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        ids = sym[order].astype("<u4").tobytes()
        bound = 4 * np.searchsorted(word[order], np.arange(len(words) + 1))
        return [ids[a:b] for a, b in zip(bound[:-1].tolist(), bound[1:].tolist())]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words as the pre-tokenizer cuts them."""
        return self.merge([w.encode() for w in words])

    def _words(self, piece: str) -> list[str]:
        if _LATIN.fullmatch(piece):
            return _LATIN_WORDS.findall(piece.lower())
        found = self.pre.pre_tokenize_str(self.normalizer.normalize_str(piece))
        return [bytes(map(self.char_byte.__getitem__, w)).decode() for w, _ in found]

    def _steps(self, chunk: str) -> list[str]:
        """Words and special tokens of a chunk, in order."""
        if not self.special_re or "<|" not in chunk:
            return self._words(chunk)
        steps: list[str] = []
        for piece in self.special_re.split(chunk):
            steps.extend([piece] if piece in self.special else self._words(piece))
        return steps

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode the chunks that the cache does not hold, each new word once."""
        new = [c for c in chunks if c not in self.cache]
        plan = [self._steps(c) for c in new]
        words = [w for w in set().union(*plan) if w not in self.word_ids]
        self.word_ids.update(zip(words, self.encode_words(words)))
        get = self.word_ids.__getitem__
        for chunk, steps in zip(new, plan):
            self.cache[chunk] = get(steps[0]) if len(steps) == 1 else b"".join(map(get, steps))

    def chunks(self, text: str) -> list[str]:
        return _WHITE.findall(text) if _SEPARATORS.search(text) else text.split()

    def encode(self, texts: list[str | None], remembered: int | None = None) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if len(self.cache) > (CACHE_CHUNKS if remembered is None else remembered):
            self.cache.clear()
            self.word_ids = dict(self.special_ids)
        split = [self.chunks(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        get = self.cache.__getitem__
        return [b"".join(map(get, s)) for s in split]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of ids: the tokens joined by one space, as without a decoder."""
        return b" ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[str, Encoder] = {}


def encoder(file: bytes) -> Encoder:
    """The worker's encoder for a tokenizer file's bytes, made once."""
    key = hashlib.sha256(file).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(file)
    return _ENCODERS[key]


def tokenizer_file(spark: SparkSession, path: str | None = None):
    """The tokenizer file (about 2 MB, of fixed size) broadcast as bytes."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


#: Texts encoded together; bounds what a batch of long texts holds at once.
PIECE_CHARS = 1 << 21


def pieces(texts: list[str | None]) -> Iterable[list[str | None]]:
    """Runs of texts of about PIECE_CHARS characters."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text or "")
        if size >= PIECE_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode_column(file) -> Column:
    """UDF: text to its ids as binary (little-endian unsigned 32-bit integers)."""
    @F.arrow_udf(returnType=T.BinaryType())
    def encode(text: pa.Array) -> pa.Array:
        enc = encoder(file.value)
        return pa.array([i for run in pieces(text.to_pylist()) for i in enc.encode(run)], pa.binary())
    return encode


def decode_column(file) -> Column:
    """UDF: ids as binary to the decoded text; null stays null."""
    @F.arrow_udf(returnType=T.StringType())
    def decode(ids: pa.Array) -> pa.Array:
        enc = encoder(file.value)
        return pa.array([None if i is None else enc.decode(i).decode() for i in ids.to_pylist()], pa.string())
    return decode


DIGESTS = T.StructType([T.StructField("n_tokens", T.LongType(), False), T.StructField("ids_sha256", T.StringType(), False),
                        T.StructField("decoded_sha256", T.StringType(), False)])


def encoded_digests(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them."""
    spark = session(docs)
    file = tokenizer_file(spark, path)

    @F.arrow_udf(returnType=DIGESTS)
    def digests(column: pa.Array) -> pa.Array:
        enc = encoder(file.value)
        count, ids_sha, text_sha = [], [], []
        for run in pieces(column.to_pylist()):
            for ids in enc.encode(run, STEP_CHUNKS):
                count.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(enc.decode(ids)).hexdigest())
        return pa.StructArray.from_arrays([pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                          names=DIGESTS.fieldNames())

    return docs.select("doc_id", digests(F.col(text)).alias("d")).select("doc_id", "d.*")


def encoded(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every document."""
    spark = session(docs)
    file = tokenizer_file(spark, path)

    @F.arrow_udf(returnType=T.ArrayType(T.IntegerType()))
    def ids(column: pa.Array) -> pa.Array:
        enc = encoder(file.value)
        rows = [np.frombuffer(i, "<i4") for run in pieces(column.to_pylist()) for i in enc.encode(run)]
        bound = np.zeros(len(rows) + 1, np.int32)
        np.cumsum([len(r) for r in rows], out=bound[1:])
        return pa.ListArray.from_arrays(pa.array(bound), pa.array(np.concatenate([*rows, np.zeros(0, np.int32)])))

    return docs.select("doc_id", ids(F.col(text)).alias("ids"))

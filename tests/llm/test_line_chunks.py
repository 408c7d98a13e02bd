import hashlib
import random
import re

from quillstream.llm import line_chunks as L
from quillstream.llm import words as W
from tests.llm.conftest import SECRET_LINES, rows_of

MASK = 2**64 - 1


def mix(x):
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & MASK
    return x ^ x >> 31


def line_hash(line):
    factor = W._factors(len(line))
    return mix(sum(int(W._BYTE[c]) * int(factor[i]) for i, c in enumerate(line)) + len(line) * 0x9E3779B97F4A7C15 & MASK)


def chunks(text):
    lines = text.split("\n")
    own = [line_hash(x.encode()) for x in lines]
    rolling = [mix(own[0] + 0x9E3779B97F4A7C15 & MASK)] + [mix(a * 0xD6E8FEB86659FD93 + b & MASK) for a, b in zip(own, own[1:])]
    cuts = [0, *(i for i in range(1, len(lines) - 1) if rolling[i] < min(rolling[i - 1], rolling[i + 1])), len(lines)]
    return [lines[a:b] for a, b in zip(cuts, cuts[1:])]


def keys(text):
    """Bytes of each chunk, without the newline at its end."""
    own = chunks(text)
    return ["\n".join(c) + "\n" for c in own[:-1]] + ["\n".join(own[-1])]


def brute(rows):
    first = {}
    order = sorted({(r[0] is not None, r[0] or 0, r[1]) for r in rows if r[1] is not None}, key=lambda x: x[:2])
    for has, doc, text in order:
        for n, key in enumerate(keys(text)):
            first.setdefault(key.removesuffix("\n"), (has, doc, text, n))
    out = []
    for doc, text in rows:
        if text is None:
            out.append((doc, 0, 0, 0, hashlib.sha256(b"").hexdigest()))
            continue
        kept, gone = [], 0
        for n, (c, key) in enumerate(zip(chunks(text), keys(text))):
            filled = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in c)
            if filled >= 2 and first[key.removesuffix("\n")] != (doc is not None, doc or 0, text, n):
                gone += len(c)
            else:
                kept += c
        kept = "\n".join(kept)
        out.append((doc, len(text.split("\n")), gone, len(kept), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_documents_equal_brute_force(docs, texts):
    assert rows_of(L.line_report(docs)) == brute(texts)


def test_boundaries_resist_shifts():
    rng = random.Random(1)
    lines = [f"line {rng.randrange(10**6)}" for _ in range(200)]
    whole = {"\n".join(c) for c in chunks("\n".join(lines))}
    moved = {"\n".join(c) for c in chunks("\n".join([*lines[:50], "new line", *lines[50:]]))}
    assert len(whole - moved) <= 3
    assert all(len(c) >= 2 for c in chunks("\n".join(lines))[1:])


def test_random_lines(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c c", "", " ", "dd"]) for _ in range(rng.randint(0, 12)))) for i in range(150)]
    assert rows_of(L.line_report(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_deduplicated(spark, docs, no_docs):
    rows = [(1, SECRET_LINES + "own text", 70), (2, SECRET_LINES, 9), (3, "", 0), (4, None, None), (5, "a clean\ndocument", 16)]
    out = {r.doc_id: r for r in L.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, n_chars int")).collect()}
    assert set(out) >= {1, 3, 4, 5} and out[1].text == rows[0][1] and out[5].n_chars == 16
    assert 2 not in out or out[2].text != SECRET_LINES or len(chunks(SECRET_LINES + "own text")) == 1
    assert L.deduplicated(docs).columns == docs.columns
    assert L.deduplicated(no_docs).count() == 0 and L.line_report(no_docs).count() == 0


def test_copies_lose_every_line(spark):
    """A copy of any text of two or more non-blank lines, also in paragraphs, goes whole."""
    rng = random.Random(3)
    own = [[f"t{i} l{n} {rng.randrange(10**6)}" for n in range(2 + i % 9)] for i in range(60)]
    first = [(i, ("\n\n" if i % 2 else "\n").join(x)) for i, x in enumerate(own)]
    rows = first + [(1000 + i, text) for i, text in first] + [(2000 + i, text + "\n") for i, text in first]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in L.line_report(docs, copies=True).collect():
        assert r.n_removed_lines == (0 if r.doc_id < 1000 else r.n_lines) and (r.doc_id < 1000 or r.kept_chars == 0), r
    assert rows_of(L.deduplicated(docs)) == sorted(first, key=repr)
    assert rows_of(L.line_report(docs)) == brute(rows)

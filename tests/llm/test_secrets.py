import hashlib
import math
import random
import re
from collections import Counter

from quillstream.llm import secrets as S
from tests.llm.conftest import rows_of

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    text, base, added = text or "", [], []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 12:
            base.append((m.start(), 0, m.end(), "assign"))
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    for n, cls in enumerate(S.CLASSES):
        for m in re.finditer(cls.candidate, text):
            if any(re.search(a, m[0]) for a in S.ALLOW):
                continue
            spans = []
            for i in range(len(m[0]) - cls.window + 1):
                share = [v / cls.window for v in Counter(m[0][i:i + cls.window]).values()]
                if -sum(p * math.log2(p) for p in share) >= cls.bits - 1e-9:
                    low, high = m.start() + i, m.start() + i + cls.window
                    if spans and spans[-1][1] >= low:
                        spans[-1][1] = high
                    else:
                        spans.append([low, high])
            added += [(a, 3 + n, b, f"entropy_{cls.name}") for a, b in spans]
    text_of = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
    kinds = Counter(s[3] for s in base)
    return (kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(base + added), len(added))


def test_report_equals_brute_force(spark, docs, texts):
    assert rows_of(S.secret_report(docs)) == sorted([(i, *brute(t)) for i, t in texts], key=repr)


def test_made_up_secrets(spark):
    rng = random.Random(5)
    pieces = [lambda: rng.choice(["token", "secret=", "API_KEY ", "apikey: ", "passwd'= \"", "AKIA", " ", "é", "😀\n", "example"]),
              lambda: "".join(rng.choices("0123456789abcdef", k=25)), lambda: "".join(rng.choices("ABCDEFGHabcdefgh0123456789+/", k=44)),
              lambda: "".join(rng.choices("0123456789ABCDEF", k=24))]
    rows = [(i, "".join(rng.choice(pieces)() for _ in range(rng.randint(0, 30)))) for i in range(150)]
    rows += [(900, "token=abcdefghijkl " * 1500), (901, "secret=password: longvalue1234"), (902, "AKIA" * 4), (903, "AKIA" * 5)]
    got = rows_of(S.secret_report(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == sorted([(i, *brute(t)) for i, t in rows], key=repr)
    assert any(r[-1] for r in got)


def test_allow_list_leaves_base(spark):
    key = "Zx9Qw8Er7Ty6Ui5Op4As"
    rows = [(1, key), (2, key + "EXAMPLE"), (3, f"token={key}EXAMPLE")]
    got = {r.doc_id: r for r in S.secret_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_entropy == 1 and got[2].n_entropy == 0 and got[3].n_assign == 1


def test_empty(no_docs):
    assert S.secret_report(no_docs).count() == 0


def test_sql_finds_the_same_spans(spark):
    """The DuckDB form of the scan on texts dense with candidates."""
    import duckdb
    import pandas as pd

    from quillstream.llm.oracle import SQL

    rng = random.Random(6)
    pieces = [lambda: rng.choice(["token=", " ", "é", "😀\n", "example", "aaaaaaaaa"]), lambda: "".join(rng.choices("ABCDEFGHabcdefgh0123456789+/", k=rng.randint(18, 60))),
              lambda: "".join(rng.choices("0123456789ABCDEF", k=rng.randint(18, 40)))]
    rows = [(i, "".join(rng.choice(pieces)() for _ in range(rng.randint(0, 12)))) for i in range(200)]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"]
    got = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({SQL['op1_secrets']})").fetchall())
    assert got == sorted((i, *brute(t)) for i, t in rows) and sum(r[-1] for r in got) > 50


def test_long_runs_do_not_overflow(spark):
    """Each class's longest candidates: paths, underscored names, one letter, digits, hex, padding, keys."""
    units = ("a/", "abc_", "a", "7", "0f", "=", "token=", "AKIA", "A-b+", "secret: x", "0123456789ABCDEF", 'api_key="')
    rows = [(i, unit * (60_000 // len(unit))) for i, unit in enumerate(units)]
    got = {r.doc_id: r for r in S.secret_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    assert got[0].spans == got[1].spans == ""
    assert got[4].n_hex == 1 and got[4].spans.startswith("hex:0:60000")

import pytest

SF001 = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 9000
SECRET_LINES = "first shared line of a passage\nsecond shared line of it\nthird shared line here\nfourth shared line there\n"


def thue_morse(n: int) -> tuple[str, str]:
    """Two different words of 2**n letters that sums of powers of one base cannot tell apart."""
    x = "".join("ab"[bin(i).count("1") % 2] for i in range(2**n))
    return x, x.translate(str.maketrans("ab", "ba"))


def edge_rows(first: int = 10_000):
    """Null, empty and blank texts, ties, copies, periodic and very long texts."""
    base = " ".join(f"word{i}" for i in range(120))
    near = base.replace("word60", "other60")
    x, y = thue_morse(10)
    big_x, big_y = thue_morse(13)
    return [
        (first, None), (first + 1, ""), (first + 2, " \t\n"), (first + 3, "one"), (first + 4, "a b c"), (first + 5, "A B c"),
        (first + 6, base), (first + 7, base), (first + 8, near), (first + 9, near + " tail"), (first + 10, LONG), (first + 11, "For " * 200),
        (first + 12, "x\x1cy z İΣ <|endoftext|> it's 42%"), (first + 13, SECRET_LINES + base), (first + 14, "top\n" + SECRET_LINES + near),
        (first + 15, "repeat me\nrepeat me\n\nrepeat me"), (None, base), (first + 16, "copy of one id " * 20), (first + 16, "copy of one id " * 20),
        (first + 17, f"{x} one two three four"), (first + 18, f"{y} one two three four"), (first + 19, f"{x} " * 35), (first + 20, f"{y} " * 35),
        (first + 21, f"{big_x} of\n{big_y} of\n{x} a b {y} a b"), (first + 22, f"{big_x}\nsecond line\nthird"), (first + 23, f"{big_y}\nsecond line\nthird"),
    ]


@pytest.fixture(scope="session")
def table_docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="session")
def docs(spark, table_docs):
    """Documents and edge rows, with extra columns whose names the operators use themselves."""
    rows = spark.createDataFrame([(i, t, None, None, None) for i, t in edge_rows()], table_docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    out = table_docs.unionByName(rows)
    for name in ("n_words", "kept", "regs", "key", "node", "uid", "m", "host", "t", "anchor", "row", "at", "n_lines", "component_id", "s"):
        out = out.selectExpr("*", f"'x' AS {name}")
    return out.persist()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

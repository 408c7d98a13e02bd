import re
from collections import Counter

from quillstream.llm import host_quality as H
from tests.llm.conftest import rows_of


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = Counter(x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(lines.values()) - len(lines), len(covered)


def failed(m):
    return m[0] < 50 or 100 * m[4] > 50 * m[0]


def soft(m):
    return 10 * m[2] > m[0] or 10 * m[3] > m[0] or m[1] < 3 * m[0] or m[1] > 12 * m[0]


def brute(rows, bad_rate=0.5):
    """rows: (doc_id, text, host)"""
    hosts = {}
    for _, text, host in rows:
        m = measures(text)
        n, bad = hosts.get(host, (0, 0))
        hosts[host] = n + 1, bad + (failed(m) or soft(m))
    rates = [b / n for n, b in hosts.values()]
    mean = sum(rates) / len(rates)
    var = sum((r - mean) ** 2 for r in rates) / len(rates)
    weight = max(1.0, mean * (1 - mean) / var - 1) if var else 1.0
    bad_host = {h: (b + mean * weight) / (n + weight) >= bad_rate for h, (n, b) in hosts.items()}
    out = []
    for doc, text, host in rows:
        m = measures(text)
        out.append((doc, *m, failed(m), not failed(m) and not (bad_host[host] and soft(m))))
    return sorted(out, key=repr), bad_host


def test_rows_equal_brute_force(docs):
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    assert rows_of(H.quality_rules(docs)) == brute(rows)[0]


def test_bad_host_binds_soft_rules_only(spark):
    good = " ".join(f"word{i}" for i in range(80))
    symbols = good + " ##" * 20
    rows = [(i, "short", "bad") for i in range(20)] + [(20, good, "bad"), (21, symbols, "bad"), (22, symbols, "fine")]
    rows += [(30 + i, good, "fine") for i in range(20)] + [(60 + i, good, None) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = rows_of(H.quality_rules(df))
    want, hosts = brute(rows)
    assert got == want and hosts["bad"] and not hosts["fine"]
    kept = {r[0]: r[-1] for r in got}
    assert kept[20] and not kept[21] and kept[22]
    assert sorted(r.doc_id for r in H.filter_documents(df).collect()) == sorted(i for i, k in kept.items() if k)


def test_filter_keeps_columns(docs, no_docs):
    assert H.filter_documents(docs).columns == docs.columns
    assert H.filter_documents(no_docs).count() == 0 and H.quality_rules(no_docs).count() == 0

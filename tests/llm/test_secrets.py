import hashlib
import re
import time
from itertools import accumulate

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sipnote.llm import secrets as S
from sipnote.llm.common import table
from tests.llm.helpers import docs_of

EXPRESSIONS = {r.kind: re.compile(r.pattern, re.ASCII) for r in S.RULES}


def plain_spans(text):
    out = []
    for order, rule in enumerate(S.RULES):
        for m in EXPRESSIONS[rule.kind].finditer(text or ""):
            if len(m[rule.group]) >= max(rule.least, 1):
                out.append((m.start(), order, f"{rule.kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def check(docs):
    rows = {}
    for r in S.secret_digest(S.find_secrets(docs)).collect():
        rows.setdefault(r.doc_id, []).append(r)
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    assert rows.keys() == texts.keys()
    for k, own in rows.items():
        wanted = []
        for t in texts[k]:
            spans = plain_spans(t)
            base = [s for s in spans if s.split(":")[0] in ("assign", "access", "hex")]
            n = [sum(s.startswith(f"{kind}:") for s in spans) for kind in ("assign", "access", "hex")]
            wanted.append((*n, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(spans)))
        assert sorted(tuple(r)[1:] for r in own) == sorted(wanted)


def test_given_documents(spark, sf):
    check(table(spark, sf, "documents"))


def test_edges(spark):
    key = "AKIA" + "Z9" * 8
    rows = [
        (1, None),
        (2, ""),
        (3, f'x Password : "abc123" tOkEn=short api-key=none API_KEY="a.b=c+d/e" é{key}é {key[:-1]}'),
        (4, "password==abcdef password=token=abcdef secret=secret=ab"),
        (5, "0123456789abcdef01234567 0123456789abcdef0123456 " + "f" * 60),
        (6, "😀 passwd=hunter22 😀 apikey:12345 apikey:123456"),
        (6, "passwd=hunter22 twice the id"),
        (None, "token = 'abcdefg'"),
        (7, "ghp_" + "a1" * 18 + " xoxb-1234567890-abc AIza" + "k" * 35 + " sk_live_" + "9" * 16),
        (8, "-----BEGIN RSA PRIVATE KEY----- eyJhbGciOiJI.eyJzdWIiOiIx.abcdefghij"),
        (9, "token=" + "a" * 50_000 + " password=bcdefg" * 800),
        (10, "paſſword=abcdefg toKen=abcdefg"),
    ]
    check(docs_of(spark, *rows))
    check(docs_of(spark, *rows).withColumnRenamed("lang", "kinds").withColumnRenamed("source", "found"))
    assert S.find_secrets(docs_of(spark, *rows).limit(0)).count() == 0


def test_very_many_matches_in_one_text(spark):
    text = "password=abcdef " * 100_000 + "token=12345 AKIA" + "Z9" * 9
    start = time.monotonic()
    row = S.secret_digest(S.find_secrets(docs_of(spark, (1, text), (2, "secret=abcdef")))).where("doc_id = 1").first()
    assert time.monotonic() - start < 30  # a fold that copies what it has found takes minutes
    assert row.spans == ",".join(plain_spans(text)) and row.n_assign == 100_000 and row.n_access == 1


def test_running_sums(spark):
    lengths = [[], [5], [1, 2, 3], [0, 0, 4, 0, 1], list(range(1, 101))]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lengths)], "i int, x array<int>")
    got = {r.i: r.sums for r in df.select("i", S.running_sums(F.col("x")).alias("sums")).collect()}
    assert got == {i: list(accumulate(x)) for i, x in enumerate(lengths)}


def test_index_is_used(spark):
    docs = docs_of(spark, (1, "password=abcdef"), (2, "nothing here"), (3, "pass wordy"))
    queries = {r.kind: S.trigram_query(r.pattern) for r in S.RULES}
    assert queries["hex"] is None and queries["access"] == ("and", ("aki", "kia"))
    wanted = set().union(*map(S.trigrams, queries.values()))
    postings = S.build_index(docs.select("doc_id", "text"), wanted)
    found = S.candidates(postings, S.RULES).collect()
    assert [(r.doc_id, r.kinds) for r in found] == [(1, ["assign"])]


def holds(query, text):
    if query is None:
        return True
    if isinstance(query, str):
        return query in text
    return (all if query[0] == "and" else any)(holds(q, text) for q in query[1])


PATTERNS = [r.pattern for r in S.RULES] + ["a(bc|d[ef]g)+hij?k", "(ab|)cde{2}f", "[xy]abc.*def|ghi", "a?b?c?", "(abc){2,}"]


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_queries_never_rule_out_a_match(data):
    pattern = data.draw(st.sampled_from(PATTERNS))
    text = data.draw(st.from_regex(re.compile(pattern, re.ASCII)))
    assert holds(S.trigram_query(pattern), text.lower())

import random
import time

from sipnote.llm import licenses as L
from tests.llm.helpers import docs_of


def best_dice(text, template):
    """Over all stretches of the text's word bigrams."""
    own, asked = L.pairs_of(L.words_of(text)), L.pairs_of(L.words_of(template))
    return max(
        (L.dice(own[i:j], asked) for i in range(len(own)) for j in range(i + 1, len(own) + 1)), default=0.0
    )


def test_finds_what_all_stretches_hold():
    rng = random.Random(3)
    names = ["MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0"]
    seen = 0
    for _ in range(120):
        name = rng.choice(names)
        words = L.words_of(L.TEMPLATES[name])
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = [rng.choice(["the", "of", "x", "license"])]
        text = " ".join([*rng.choices("abcd", k=3), *words, *rng.choices("abcd", k=3)])
        found = L.Matcher({name: L.TEMPLATES[name]}, 0.8).find(text)
        wanted = best_dice(text, L.TEMPLATES[name])
        seen += wanted >= 0.8
        assert bool(found) == (wanted >= 0.8)
        assert not found or abs(max(d for d, *_ in found) - wanted) < 1e-12
    assert 20 < seen < 120


def test_size_bounds_are_those_of_the_coefficient():
    for t in L.Matcher(L.TEMPLATES, 0.8).templates:
        dice = lambda w, m=t.size: 2 * min(w, m) / (w + m)
        assert dice(t.least) >= 0.8 - 1e-9 > dice(t.least - 1)
        assert dice(t.most) >= 0.8 - 1e-9 > dice(t.most + 1)


def test_edges(spark):
    mit, apache = L.TEMPLATES["MIT"], L.TEMPLATES["Apache-2.0"]
    rows = [
        (1, None),
        (2, ""),
        (3, "word"),
        (4, f"Text.\n{mit.upper()}\nmore {apache}"),
        (4, f"{apache} {apache}"),
        (None, f"RELEASED -- under: the_MIT license"),
        (5, "of the " * 20_000 + mit),
        (6, f"{mit} " * 500),
    ]
    docs = docs_of(spark, *rows).withColumnRenamed("lang", "license").withColumnRenamed("source", "notices")
    out = L.license_summary(L.find_licenses(docs)).collect()
    assert len(out) == len(rows)
    got = sorted((str(r.doc_id), r.license, r.n_notices) for r in out)
    assert got == sorted(
        [
            ("1", None, 0),
            ("2", None, 0),
            ("3", None, 0),
            ("4", "MIT", 2),
            ("4", "Apache-2.0", 2),
            ("None", "MIT", 1),
            ("5", "MIT", 1),
            ("6", "MIT", 500),
        ],
        key=str,
    )
    assert L.find_licenses(docs.limit(0)).count() == 0


def test_given_documents(spark, sf):
    from sipnote.llm.common import table

    docs = table(spark, sf, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r.license for r in L.license_summary(L.find_licenses(docs)).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        line = any(L.TEMPLATES[n] in text for n in L.TEMPLATES)
        assert not line or found[i] is not None
        if found[i] is not None:
            assert "licen" in text.lower()


def test_very_many_notices():
    """Time in proportion to the notices of a text."""
    matcher = L.Matcher(L.TEMPLATES, 0.8)
    text = (L.TEMPLATES["MIT"] + " and other words between them ") * 20_000
    start = time.perf_counter()
    found = matcher.find(text)
    assert [x[3] for x in found] == ["MIT"] * 20_000 and time.perf_counter() - start < 60
    assert all(a[2] <= b[1] for a, b in zip(found, found[1:]))
    few = matcher.find((L.TEMPLATES["MIT"] + " and other words between them ") * 50)
    assert [x[:3] for x in few] == [x[:3] for x in found[:50]]

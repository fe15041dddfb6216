import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sipnote.llm import packing as P
from sipnote.llm.common import table
from tests.llm.helpers import docs_of

FULL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*FULL.encode(text or "", add_special_tokens=False).ids, 0]


def check(docs, sequence=2048):
    out = P.pack_documents(docs, sequence).collect()
    wanted, total = [], 0
    for r in docs.select("doc_id", "text").collect():
        ids = ids_of(r.text)
        total += len(ids)
        first = len(ids) % sequence or sequence
        starts = [0, *range(first, len(ids), sequence)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            wanted.append((r.doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    assert sorted(map(str, [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out])) == sorted(map(str, wanted))
    held = defaultdict(list)
    for r in out:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= sequence
    return len(held), -(-total // sequence)


def test_given_documents(spark, sf):
    used, least = check(table(spark, sf, "documents"))
    assert used <= 1.02 * least + 1


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "<|endoftext|> a b\u0085 ٣ 😀"), (None, "null id"), (4, "word " * 30_000)]
    rows += [(5, "twice"), (5, "twice"), *[(i, "hot copies of one text") for i in range(10, 200)]]
    check(docs_of(spark, *rows))
    check(docs_of(spark, *rows).withColumnRenamed("lang", "row").withColumnRenamed("source", "length"), 64)
    assert P.pack_documents(docs_of(spark, (1, "x")).limit(0)).count() == 0


def test_sequences_round_trip(spark):
    docs = docs_of(spark, *[(i, f"text number {i} " * (i % 40)) for i in range(60)])
    packed = P.pack_documents(docs, 32)
    filled = {r.sequence_id: r.ids for r in P.sequences(docs, packed).collect()}
    for r in packed.collect():
        text = docs.where(f"doc_id = {r.doc_id}").first().text if r.doc_id % 10 == 0 else None
        if text is not None:
            assert filled[r.sequence_id][r.offset : r.offset + r.length] == ids_of(text)[r.start : r.start + r.length]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200) | st.text(st.characters(max_codepoint=0x24F), max_size=200))
def test_ids_are_those_of_the_file(text):
    assert [*P.token_ids(text, "byte_bpe_50k").tolist(), 0] == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 40), min_size=1))
def test_plan_places_every_piece_once(counts):
    plan = P.Plan(counts, 24)
    places, ranks = defaultdict(int), defaultdict(list)
    for length, a, b, first, offset, times in plan.intervals():
        ranks[length] += range(a, b)
        for r in range(b - a):
            places[first + r // times] |= 0 if not length else ((1 << length) - 1) << (offset + r % times * length)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert sum(bin(p).count("1") for p in places.values()) == sum(k * n for k, n in counts.items())
    assert max(places.values()) < 1 << 24 and len(places) == plan.used
    assert plan.used <= 2 * (sum(k * n for k, n in counts.items()) / 24) + 1


def test_exact_complements_come_first():
    # One, two and three lengths that fill the gap, none of which best fit alone would leave whole.
    assert P.Plan({15: 5, 9: 5}, 24).used == 5
    assert P.Plan({14: 3, 6: 3, 4: 3}, 24).used == 3
    assert P.Plan({13: 2, 5: 2, 4: 2, 2: 2}, 24).used == 2

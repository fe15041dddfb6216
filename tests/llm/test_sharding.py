import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sipnote.llm import sharding as S
from sipnote.llm.common import table
from tests.llm.helpers import docs_of


def smallest_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, left = (low + high) // 2, 1, None
        left = middle
        for s in sizes:
            if s > left:
                used, left = used + 1, middle
            left -= s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def check(docs, shards=8):
    texts = defaultdict(int)
    rows = docs.select("doc_id", "text").collect()
    for r in rows:
        texts[r.text or ""] += len((r.text or "").encode()) + 1
    ordered = [n for _, n in sorted((sha256(t.encode()).hexdigest(), n) for t, n in texts.items())]
    out = S.shard(docs, shards).collect()
    assert len(out) == len(rows)
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in out) == sorted(
        (r.doc_id or 0, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows
    )
    held, slots = defaultdict(int), defaultdict(list)
    for r in out:
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert max(held.values()) == smallest_capacity(ordered, shards)
    assert set(held) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    place = defaultdict(set)
    for r in out:
        place[r.text_crc32, r.size].add(r.shard)
    assert all(len(p) == 1 for p in place.values())


def test_given_documents(spark, sf):
    check(table(spark, sf, "documents"))


def test_edges(spark):
    rows = [(i, "same text") for i in range(40)] + [(i, "x" * i) for i in range(40, 100)]
    rows += [(1, None), (2, ""), (None, "null id"), (3, "rep"), (3, "rep"), (4, "y" * 50_000)]
    check(docs_of(spark, *rows))
    check(docs_of(spark, *rows).withColumnRenamed("source", "shard").withColumnRenamed("lang", "slot"))
    check(docs_of(spark, (1, "only")), 8)
    assert S.shard(docs_of(spark, (1, "x")).limit(0), 8).count() == 0


class Plain:
    """Groups as a list, answering what the search asks of a table."""

    def __init__(self, groups):
        self.groups = groups

    def ranges(self, digits, within=None, length=0):
        found = defaultdict(list)
        for d, n in self.groups:
            if within is None or d[:length] in within:
                found[d[:digits]].append(n)
        rows = [{"key": k, "bytes": sum(v), "n": len(v), "most": max(v)} for k, v in found.items()]
        return sorted(rows, key=lambda r: sha256(r["key"].encode()).digest())  # in no order


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=80), st.integers(1, 9), st.integers(1, 3))
def test_search_by_refinement(sizes, shards, digits):
    groups = sorted((sha256(str(i).encode()).hexdigest(), n) for i, n in enumerate(sizes))
    plain = Plain(groups)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(S, "_ranges", lambda g, *a: g.ranges(*a))
        patch.setattr(S, "FIRST_DIGITS", digits)
        cuts, capacity = S.minimax_cuts(plain, shards)
    assert capacity == smallest_capacity([n for _, n in groups], shards)
    held = defaultdict(int)
    for d, n in groups:
        held[sum(d >= c for c in cuts)] += n
    assert len(cuts) < shards and max(held.values()) == capacity


def test_writes_shards(spark, tmp_path):
    docs = docs_of(spark, *[(i, f"text {i}") for i in range(30)])
    S.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 30 and back.select("shard").distinct().count() == 4

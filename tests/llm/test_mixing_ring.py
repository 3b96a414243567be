"""Mixing and sharding against their definitions."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from isobar.llm import mixing, ring


def _targets(sizes):
    """Shares by weight, what is above a limit shared out again, until none is."""
    sources = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sources)}
    total, target, open_ = float(sum(sizes.values())), {}, set(sources)
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            open_.discard(s)
    return target


@pytest.mark.parametrize("table", ["docs", "odd", "hot", "nothing"])
def test_mix(request, table):
    table = request.getfixturevalue(table)
    rows = mixing.mix(table).collect()
    given = [(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in table.collect()]
    key = lambda r: tuple((x is None, x or 0 if not isinstance(x, str) else x) for x in r)
    assert sorted([(r.doc_id, r.source, r["size"]) for r in rows], key=repr) == sorted(given, key=repr)
    sizes = defaultdict(int)
    for _, source, size in given:
        sizes[source] += size
    target, taken = _targets(sizes), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-9)
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 0.5 + 1e-6
    again = mixing.mix(table.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert key


@pytest.mark.parametrize("table", ["docs", "odd", "hot", "nothing"])
@pytest.mark.parametrize("shards", [8, 3])
def test_rows_law(request, table, shards):
    table = request.getfixturevalue(table)
    rows = ring.assign(table, shards).collect()
    given = [(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in table.collect()]
    assert sorted([(r.doc_id, r["size"], r.text_crc32) for r in rows], key=repr) == sorted(given, key=repr)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(s, ())) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(given)
    again = ring.assign(table.repartition(4), shards).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_bytes_law(docs):
    rows = ring.assign(docs, 4, law="bytes").collect()
    loads = Counter()
    for r in rows:
        loads[r.shard] += r["size"]
    largest = max(r["size"] for r in rows)
    assert max(loads.values()) <= sum(loads.values()) / 4 + largest


def test_slack_limits_movement(hot):
    """With room to spare most rows stay where they are when a shard is added."""
    small = {r.doc_id: r.shard for r in ring.assign(hot, 8, slack=0.5).select("doc_id", "shard").collect()}
    large = {r.doc_id: r.shard for r in ring.assign(hot, 9, slack=0.5).select("doc_id", "shard").collect()}
    counts = Counter(small.values())
    assert max(counts.values()) <= 1.5 * len(small) / 8 + 1
    assert sum(small[i] != large[i] for i in small) < 0.3 * len(small)


def test_ring_is_searched_as_bisect_does(spark):
    points = ring.ring_points(5, 7)
    starts = [p for p, _ in points]
    probes = sorted({0, 2**31 - 1, *starts, *(p + 1 for p in starts), *(p - 1 for p in starts)})
    table = spark.createDataFrame([(p, p) for p in probes], "at long, position int")
    found = {r["at"]: r["arc"] for r in ring._with_arc(table, starts).collect()}
    assert found == {p: ring.place_of(p, points) for p in probes}


def test_documents_of_a_mix_row_by_row(spark, odd, hot, nothing):
    """A third of the rows without an id, ids and texts repeated: each source still takes its words, up to the one document at the cut."""
    import random

    rng = random.Random(6)
    rows = []
    for i in range(600):
        text = " ".join(f"w{rng.randrange(99)}" for _ in range(20)) if i % 5 else "the same text for all of us here"
        rows.append((None if i % 3 == 0 else rng.randrange(150), text, rng.choice(["a", "a", "b", None]), i))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies long")
    for table in (docs, odd, hot, nothing):
        mixed = mixing.mix(table).collect()
        found = mixing.mixed_documents(table)
        assert found.columns == table.columns
        times, words = Counter(), Counter()
        for r in found.collect():
            times[r.doc_id, r.source, r.text] += 1
            words[r.source] += len((r.text or "").encode().split())
        expected = Counter()
        by_rank = {}
        for r in mixed:
            expected[r.doc_id, r.source, r.size] += r.copies
            by_rank[r.source] = max(by_rank.get(r.source, 0), r.size)
        short = Counter()
        for (doc_id, source, text), n in times.items():
            short[doc_id, source, len((text or "").encode().split())] += n
        assert short == +expected
        for r in mixed:
            assert 0 <= words[r.source] - round(r.target) < max(1, by_rank[r.source])

"""Exact, line and near duplicates against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import line_dedup, minhash, trie_dedup
from isobar.llm.components import components


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# ------------------------------------------------------------------ exact
@pytest.mark.parametrize("table", ["docs", "odd", "hot", "nothing"])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("most_bytes", [1 << 27, 5_000])
def test_exact(request, table, keep, most_bytes):
    table = request.getfixturevalue(table)
    given = [(r.doc_id, _lower(r.text)) for r in table.collect()]
    ids = defaultdict(list)
    for doc_id, text in given:
        ids[text].append(doc_id)
    expected = []
    for doc_id, text in given:
        known = [i for i in ids[text] if i is not None]
        owner = (max if keep == "largest" else min)(known) if known else None
        expected.append((doc_id, owner, len(ids[text]), doc_id == owner, hashlib.sha256(text.encode()).hexdigest()))
    found = trie_dedup.exact_dedup(table, keep, most_bytes).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


@pytest.mark.parametrize("most_bytes", [300, 2_000, 1 << 20])
def test_trie_with_spilled_subtrees(most_bytes):
    rng = random.Random(most_bytes)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(3000)]
    keys += [b"same start " * 20 + k for k in keys[:500]] + [b""] * 3
    trie = trie_dedup.PatriciaTrie(trie_dedup._smaller, most_bytes)
    expected = {}
    for i, key in enumerate(keys):
        trie.insert(key, [i, 1, None])
        first, n = expected.get(key, (i, 0))
        expected[key] = (first, n + 1)
    found = list(trie.items())
    assert len(found) == len(expected)
    assert {k: (o[0], o[1]) for k, o in found} == expected


# ------------------------------------------------------------------ lines
def _lines(given, least_length=20, least_documents=3):
    keys = []
    holders = defaultdict(list)
    for doc_id, text in given:
        of = [_lower(line.strip(" \t\n\x0b\x0c\r")) for line in (text or "").split("\n")]
        keys.append(of)
        for key in set(of):
            if len(key) >= least_length:
                holders[key].append(doc_id)
    out = []
    for (doc_id, text), of in zip(given, keys):
        lines = (text or "").split("\n")
        kept = []
        for line, key in zip(lines, of):
            held = holders.get(key, ())
            known = [i for i in held if i is not None]
            owner = max(known) if known else None
            if len(held) < least_documents or doc_id == owner:
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("table", ["docs", "odd", "hot", "nothing"])
@pytest.mark.parametrize("lines_per_copy", [1 << 20, 40])
def test_lines(request, table, lines_per_copy, monkeypatch):
    """Also where a shard's filter goes to many tasks."""
    monkeypatch.setattr(line_dedup, "LINES_PER_COPY", lines_per_copy)
    table = request.getfixturevalue(table)
    index = line_dedup.LineIndex.empty(table.sparkSession, 4).insert(table)
    found = index.clean(table).collect()
    expected = _lines([(r.doc_id, r.text) for r in table.collect()])
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_lines_are_reversible(spark, hot, docs):
    """Documents come and go; what is left is as if the others had never been there."""
    first = hot.where("doc_id < 300")
    rest = hot.where("doc_id >= 300")
    index = line_dedup.LineIndex.empty(spark, 3).insert(first)
    grown = index.insert(rest)
    whole = line_dedup.LineIndex.empty(spark, 3).insert(hot)
    back = grown.remove(rest.select("doc_id"))
    rows = lambda i, t: sorted(map(repr, i.clean(t).collect()))
    assert rows(grown, hot) == rows(whole, hot)
    assert rows(back, first) == rows(index, first)
    assert rows(back.remove(first), first)[0].find("n_dropped=0") > 0
    held = lambda i: sorted(map(tuple, i.repeated.select("h1", "h2", "n_docs", "owner").collect()))
    assert held(back) == held(index) and held(grown) == held(whole)
    assert held(index.remove(first)) == []


def test_shards_grow_with_later_inserts(spark):
    """Three inserts into small shards, a third of the rows without an id; the filters alone turn away nearly all other lines."""
    rng = random.Random(8)
    shared = [f"a line number {i} that several documents share" for i in range(200)]
    data = []
    for i in range(900):
        lines = rng.sample(shared, 4) + [f"a line of document {i} and of no other one", shared[0]]
        data.append((None if i % 3 == 0 else rng.randrange(400), "\n".join(lines)))
    table = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    parts = [spark.createDataFrame(data[a : a + 300], table.schema) for a in (0, 300, 600)]
    index = line_dedup.LineIndex.empty(spark, 1, keys_per_shard=8)
    shards = []
    for part in parts:
        index = index.insert(part)
        shards.append(index.shards)
        assert index.filters.agg({"n_keys": "sum"}).first()[0] == index.repeated.count()
    assert 8 < shards[0] <= shards[1] <= shards[2] and shards[2] * 8 >= index.repeated.count()
    expected = _lines(data)
    assert sorted(map(repr, map(tuple, index.clean(table).collect()))) == sorted(map(repr, expected))
    refs = line_dedup.written(line_dedup.line_refs(table), "refs")
    maybe, held = index._maybe_repeated(refs).count(), refs.join(index.repeated, ["h1", "h2"]).count()
    assert held <= maybe < held + 30 < refs.count()


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63 - 1, (5000, 2))
    made = line_dedup._with_keys(5000, keys[:, 0], keys[:, 1])
    assert made.contains(keys[:, 0], keys[:, 1]).all()
    other = rng.integers(-(2**63), 2**63 - 1, (20000, 2))
    assert made.contains(other[:, 0], other[:, 1]).mean() < 0.01
    made.delete(keys[:2500, 0], keys[:2500, 1])
    assert made.contains(keys[2500:, 0], keys[2500:, 1]).all()
    assert made.contains(keys[:2500, 0], keys[:2500, 1]).mean() < 0.02
    small = line_dedup.CuckooFilter(4)
    assert not small.insert(keys[:100, 0], keys[:100, 1])


# ------------------------------------------------------------------ near duplicates
def _near(given, length=3, percent=85):
    sets = []
    for _, text in given:
        words = _lower(text).encode().split()
        k = min(length, len(words))
        sets.append(frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset())
    parent = list(range(len(given)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_id = defaultdict(list)
    for i, (doc_id, _) in enumerate(given):
        if doc_id is not None and sets[i]:
            by_id[doc_id].append(i)
    for same in by_id.values():
        for i in same[1:]:
            parent[root(i)] = root(same[0])
    for i in range(len(given)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * (len(a) + len(b) - len(a & b)):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(given):
        r = root(i)
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(given):
        component = least.get(root(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


@pytest.mark.parametrize("table", ["docs", "odd", "hot", "nothing"])
def test_near(request, table):
    table = request.getfixturevalue(table)
    found = minhash.near_duplicates(table).collect()
    expected = _near([(r.doc_id, r.text) for r in table.collect()])
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_stars_in_blocks(hot, monkeypatch):
    """Large stars are dealt to salts and blocks without losing a link."""
    expected = sorted(map(repr, minhash.near_duplicates(hot).collect()))
    monkeypatch.setattr(minhash, "_BLOCK", 40)
    monkeypatch.setattr(minhash, "_ROWS_PER_SALT", 25)
    assert sorted(map(repr, minhash.near_duplicates(hot).collect())) == expected


def test_min_max_estimates_similarity():
    rng = np.random.default_rng(4)
    factors = minhash._multipliers(96)
    errors = []
    for share in (0.3, 0.6, 0.85):
        for _ in range(20):
            both = rng.integers(0, 2**64, 600, dtype=np.uint64)
            n = int(600 * share)
            rest = (600 - n) // 2
            a, b = both[: n + rest], np.concatenate([both[:n], both[n + rest :]])
            ends = minhash.min_max([a, b], factors)
            errors.append(float((ends[0] == ends[1]).mean()) - n / 600)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000)]
    links += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(250)]
    rng.shuffle(links)
    parent = {n: n for pair in links for n in pair}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {n: root(n) for n in parent}
    assert len(found) == len(parent)
    assert Counter(r.component for r in found)[1000] == 300
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert F is not None

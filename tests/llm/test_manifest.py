"""The Merkle manifest against a tree built leaf by leaf."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from isobar.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, columns):
    values = [row[c] for c in columns]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """All levels, bottom first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i : i + 3]) for i in range(0, len(low), 3)])
    return levels


def path(levels, place):
    steps = []
    for low in levels[:-1]:
        start = place // 3 * 3
        steps.append((low[start:place], low[place + 1 : start + 3]))
        place //= 3
    return steps


def brute(rows, columns):
    """{(doc_id, leaf): the row of the result} where every leaf is claimed as it is."""
    by_source = defaultdict(list)
    for row in rows:
        by_source[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, columns)))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    found = defaultdict(list)
    for rank, s in enumerate(names):
        for place, (has_id, doc_id, digest) in enumerate(sorted(by_source[s])):
            steps = path(trees[s], place) + path(top, rank)
            flat = [d for before, after in steps for d in (*before, *after)]
            found[doc_id if has_id else None, digest].append((trees[s][-1][0], top[-1][0], h(*flat), steps))
    return found


def made(spark, n, sources, seed=1):
    rng = random.Random(seed)
    rows = [(rng.randrange(3 * n), rng.choice(sources), "en", i, f"text {i}\nline") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)


@pytest.mark.parametrize("sources, leaves_at_once", [(["hot"] * 40 + [f"s{i}" for i in range(30)] + [None], 700), (["one"], 10**6)])
def test_against_a_tree_built_leaf_by_leaf(spark, sources, leaves_at_once):
    docs = made(spark, 2600, sources)
    rows = docs.collect()
    expected = brute(rows, merkle.COLUMNS)
    got = merkle.prove(merkle.build(docs), with_proof=True, leaves_at_once=leaves_at_once).collect()
    assert len(got) == len(rows)
    for r in got:
        subroot, root, proof, steps = expected[r.doc_id, r.leaf].pop()
        assert (r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) == (subroot, root, proof, root, True)
        assert [([d.hex() for d in s.before], [d.hex() for d in s.after]) for s in r.proof] == steps
        assert merkle.folded(bytes.fromhex(r.leaf), [(s.before, s.after) for s in r.proof]).hex() == root


def test_a_changed_document_is_found_and_no_other(spark):
    docs = made(spark, 900, ["a", "b"])
    plain = [F.col(c) for c in merkle.COLUMNS]
    changed = merkle.leaf_of([F.lit("x") if c == "text" else F.col(c) for c in merkle.COLUMNS])
    claimed = F.when(F.col("n_chars") % 7 == 0, changed).otherwise(merkle.leaf_of(plain))
    manifest = merkle.build(docs, carried={"claimed_leaf": claimed, "number": F.col("n_chars")})
    got = merkle.prove(manifest, claimed="claimed_leaf").join(manifest.leaves.select(F.lower(F.hex("leaf")).alias("l"), "number"), F.col("leaf") == F.col("l"))
    assert {r.number % 7 == 0: r.verified for r in got.collect()} == {True: False, False: True}
    assert got.where(F.col("verified") == (F.col("number") % 7 == 0)).count() == 0


def test_wanted_coordinates_are_the_least():
    for n in (1, 2, 3, 4, 10, 27, 28, 100):
        levels = [list(range(merkle.width_at(n, k))) for k in range(merkle.height(n) + 1)]
        assert len(levels[-1]) == 1 and (n == 1 or len(levels[-2]) > 1)
        for first, end in [(0, n), (0, 1), (n - 1, n), (n // 3, n // 2 + 1)]:
            needed = set()
            for place in range(first, end):
                for k in range(merkle.height(n)):
                    needed |= {(k, p) for p in range(place // 3 * 3, min(place // 3 * 3 + 3, len(levels[k]))) if p != place}
                    place //= 3
            own = {(k, p) for k in range(len(levels)) for p in levels[k] if p * 3**k < end and (p + 1) * 3**k > first}
            assert set(merkle.missing(first, end, n)) == needed - own


def test_odd_rows_and_nothing(spark, odd, nothing):
    columns = ("doc_id", "source", "text")
    rows = odd.collect()
    expected = brute(rows, columns)
    got = merkle.prove(merkle.build(odd, columns)).collect()
    assert len(got) == len(rows) and all(r.verified for r in got)
    for r in got:
        assert (r.subroot, r.root, r.proof_sha256) in {x[:3] for x in expected[r.doc_id, r.leaf]}
    empty = merkle.build(nothing, columns)
    assert empty.root is None and merkle.prove(empty).count() == 0
    one = merkle.prove(merkle.build(odd.where("doc_id = 6"), columns)).collect()
    assert len(one) == 1 and one[0].leaf == one[0].root and one[0].proof_sha256 == h()


def test_rerun_and_column_names(spark, hot):
    columns = ("doc_id", "source", "text")
    runs = [sorted(map(tuple, merkle.prove(merkle.build(hot.repartition(n), columns), leaves_at_once=100).collect())) for n in (2, 7)]
    assert runs[0] == runs[1]
    with pytest.raises(ValueError):
        merkle.build(hot, columns, carried={"place": F.lit(1)})


def test_tampered_documents_of_the_query(spark, docs):
    from isobar.llm import registered

    rows = {r.doc_id: r for r in docs.collect()}
    got = registered.op13_manifest(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(rows)
    for r in got:
        text = rows[r.doc_id].text
        touched = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and text is not None and "\n" in text
        assert r.verified == (not touched)

"""Stages of the pipeline against brute force."""

import random

import corpus_pipeline


def _shingles(text, length=5):
    words = text.split()
    return {tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1))} if words else set()


def _representatives(rows, length=5, percent=80):
    """Ids of the documents that stay: the smallest of each component of (id, text)."""
    sets = [(i, _shingles(t.lower(), length)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for at, (i, a) in enumerate(sets):
        for j, b in sets[:at]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i for i in parent if root(i) == i}


def test_near_copies_share_four_fifths_of_five_word_shingles(spark):
    """A piece appended or cut off leaves 0.79 to 0.85; edits dealt over the text stay below 0.8 though three words are above 0.85."""
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    pairs = []
    for m in range(19, 28):
        text = words(104)
        pairs += [(text, text + words(m)), (text + words(m), text)]
    for edits in (23, 25, 27):
        text = words(1000)
        edited = list(text)
        for k in range(edits):
            edited[10 + k * 36] = words(1)[0]
        pairs.append((text, edited))
    rows = [(2 * i + k, " ".join(t)) for i, pair in enumerate(pairs) for k, t in enumerate(pair)]
    expected = _representatives(rows)
    narrow = _representatives(rows, 3, 85)
    assert expected - narrow and narrow - expected  # each rule removes documents that the other keeps
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, table, "").collect()} == expected

"""Quality, personal data and benchmark phrases against brute force and held-out labels."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import fm_index, pii, quality
from isobar.llm.boost import fit


def _lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# ------------------------------------------------------------------ trees and quality
def test_flat_trees_and_sql(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, (4000, 3)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 2)).astype(float)
    forest = fit(x, y, trees=20, depth=3)
    p = forest.probabilities(x)
    assert ((p > 0.5) == (y == 1)).mean() > 0.99
    table = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x[:300])], "i int, a double, b double, c double")
    told = {r.i: r.m for r in table.select("i", F.expr(forest.sql(["a", "b", "c"])).alias("m")).collect()}
    assert np.allclose([told[i] for i in range(300)], forest.margins(x[:300]))


def test_trees_without_rows_or_contrast():
    nothing = fit(np.zeros((0, 3)), np.zeros(0))
    assert np.allclose(nothing.probabilities(np.ones((2, 3))), 0.5)
    one = fit(np.ones((50, 3)), np.ones(50))
    assert (one.probabilities(np.zeros((2, 3))) > 0.9).all()


def test_quality_on_held_out_labels(docs, labels, spark):
    big = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    forest = quality.learn(docs, labels)
    scored = quality.score(docs, forest, "score", ["doc_id"]).withColumn("held", quality.held_out("doc_id"))
    rows = scored.join(labels, "doc_id").collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held]
    assert np.mean([(r.score >= quality.THRESHOLD) == (r.quality == 1) for r in held]) > 0.97
    again = quality.score(docs.repartition(3), quality.learn(docs.repartition(4), labels.repartition(2)), "score", ["doc_id"])
    assert sorted(map(tuple, again.collect())) == sorted((r.doc_id, r.score) for r in scored.collect())


def test_quality_never_looks_at_held_out_labels(docs, labels):
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.learn(docs, t) for t in (labels, flipped))
    assert np.array_equal(a.leaves, b.leaves) and np.array_equal(a.features, b.features)


def test_quality_of_odd_rows(odd, nothing, docs, labels):
    forest = quality.learn(docs, labels)
    with pytest.raises(ValueError):
        quality.score(odd, forest)  # there is a column of that name
    rows = quality.score(odd, forest, "_score").collect()
    assert len(rows) == odd.count() and all(0 <= r._score <= 1 for r in rows)
    assert {c for c in rows[0].asDict()} == {*odd.columns, "_score"}
    empty = {r._score for r in rows if not r.text}
    assert len(empty) == 1
    assert quality.score(nothing, forest, "_score").count() == 0
    untaught = quality.learn(nothing, labels.limit(0))
    assert {r._score for r in quality.score(odd, untaught, "_score").collect()} == {0.5}


# ------------------------------------------------------------------ personal data
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def _base(text):
    return [
        (number, m.start(), m.end())
        for number, (kind, pattern) in enumerate(_PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if _holds(kind, m.group())
    ]


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(6)
    parts = ["a", "@", ".", "b.c", " ", "1", "23", "255", "256", "+", "-", "(", ")", "4111 1111 1111 1111", "é", "日", "_", "%", "+1 (555) 010-2345", "\n", "x@y.z", "1.2.3.4", "5500-0000-0000-0004"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(25)))) for i in range(3000)]
    rows += [(None, "a@b.c and a@b.c_d@e.f"), (7, "a@b.c"), (7, "a@b.c"), (-1, None), (-2, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("table", ["docs", "noisy", "nothing"])
def test_base_spans(request, table):
    table = request.getfixturevalue(table)
    found = pii.find_personal_data(table).collect()
    base = [(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans if s.is_base]) for r in found]
    expected = [(r.doc_id, _base(r.text)) for r in table.collect()]
    assert sorted(map(repr, base)) == sorted(map(repr, expected))
    for r in found:
        added = [s for s in r.spans if not s.is_base]
        for s in added:
            assert all(s.end <= o.start or o.end <= s.start for o in r.spans if o != s)


def test_odd_texts_do_not_stall(odd):
    """Runs that would make the plain patterns slow, and every other odd row."""
    found = pii.digest(pii.find_personal_data(odd)).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[13].n_email == 1 and by_id[11].n_email == 0 and by_id[14].n_card == 0
    assert by_id[12].n_ip == len(_base("1.2.3." * 20_000))


def test_candidates_are_chosen(spark):
    """A wider form is added where the trees have seen its like confirmed, and a number that fails Luhn is not."""
    rng = random.Random(1)
    rows = []
    for i in range(400):
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        check = next(c for c in "0123456789" if _luhn(digits + c))
        wrong = str((int(check) + 1) % 10)
        rows.append((i, f"pay with card {digits + check} or {digits + wrong} now"))
    rows.append((1000, "pay with card 4111.1111.1111.1111 now"))
    found = {r.doc_id: r.spans for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(len(found[i]) == 1 and found[i][0].is_base for i in range(400))
    assert all(s.is_base or s.kind == 2 for s in found[1000])


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é a@b.cd, 1.2.3.4!"), (2, None), (3, "clean")], "doc_id long, text string")
    hidden = pii.redact(docs, pii.find_personal_data(docs)).collect()
    assert {r.doc_id: r.text for r in hidden} == {1: "é ******, *******!", 2: None, 3: "clean"}


# ------------------------------------------------------------------ benchmark phrases
def _phrases(items, window):
    found = defaultdict(set)
    for item_id, text in items:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(text))
        for at in range(max(1, len(words) - window + 1) if words else 0):
            found[tuple(words[at : at + window])].add(item_id)
    return found


def _hits(text, phrases):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(text))
    hit, items = [False] * len(words), set()
    for length in {len(p) for p in phrases}:
        for at in range(len(words) - length + 1):
            holders = phrases.get(tuple(words[at : at + length]))
            if holders:
                hit[at : at + length] = [True] * length
                items |= holders
    spans, at = [], 0
    while at < len(words):
        end = at
        while end < len(words) and hit[end]:
            end += 1
        if end > at:
            spans.append((at, end))
        at = max(end, at + 1)
    return len(words), spans, sorted(i for i in items if i is not None)


def _compare(table, items, window):
    found = fm_index.find_items(table, items, window).collect()
    phrases = _phrases([(r.item_id, r.text) for r in items.collect()], window)
    expected = [(r.doc_id, *_hits(r.text, phrases)) for r in table.collect()]
    got = [(r.doc_id, r._n_words, [(s.start, s.end) for s in r._spans], r._items) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


@pytest.mark.parametrize("blocks", [1, 5])
def test_benchmark(docs, benchmark, monkeypatch, blocks):
    if blocks > 1:
        monkeypatch.setattr(fm_index.phrase_blocks, "__defaults__", (fm_index.WINDOW, 300))
    _compare(docs, benchmark, 10)


@pytest.mark.parametrize("window", [1, 3, 10])
def test_phrases_in_few_words(spark, window, monkeypatch):
    """A small alphabet: repeats within and across documents, short items, NULLs."""
    rng = random.Random(window)
    text = lambda n: " ".join(rng.choice(["a", "B", "é", "9", "out"]) for _ in range(n))
    docs = [(i, text(rng.randrange(200))) for i in range(120)] + [(None, text(50)), (1, None), (2, "")] + [(3, "a b " * 9_000)]
    items = [(i, text(rng.randrange(15)).replace("out", "in")) for i in range(40)] + [(None, "a b a"), (5, "é é"), (9, None), (8, "...")]
    _compare(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), window,
    )


def test_odd_tables(odd, nothing, benchmark, spark):
    assert {tuple(r._items) for r in fm_index.find_items(odd, benchmark).collect()} == {()}
    assert fm_index.find_items(nothing, benchmark).count() == 0
    none = fm_index.find_items(odd, benchmark.limit(0)).collect()
    assert len(none) == odd.count() and not any(r._spans for r in none)
    with_text = spark.createDataFrame([("x", "The quick brown Fox")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "So THE quick, brown fox. Ran", 7)], "doc_id long, text string, _spans int")
    cut = fm_index.remove_spans(docs, with_text, 3).collect()
    assert [tuple(r) for r in cut] == [(1, "So Ran", 7)] or [tuple(r) for r in cut] == [(1, "So . Ran", 7)]


def test_index_by_itself():
    rng = np.random.default_rng(3)
    stretches = [rng.integers(1, 4, n).astype(np.int32) for n in (1, 5, 300, 300, 17)]
    stretches.append(stretches[2].copy())
    index = fm_index.FMIndex(stretches, 3)
    text = np.concatenate([np.append(s, 0) for s in stretches])
    phrases = rng.integers(1, 4, (60, 6))
    lengths = rng.integers(1, 7, 60)
    low, high = index.find(phrases, lengths)
    for phrase, n, a, b in zip(phrases, lengths, low, high):
        expected = [i for i in range(len(text) - n + 1) if np.array_equal(text[i : i + n], phrase[:n])]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def _card(rng):
    digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return digits + next(c for c in "0123456789" if _luhn(digits + c))


def test_planted_wider_forms_are_added(spark):
    """As many wider forms as base spans, in text without hints; look-alikes that fail the evidence stay out."""
    rng = random.Random(8)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    fours = lambda d, s: s.join(d[i : i + 4] for i in range(0, 16, 4))
    rows, planted = [], {}
    for i in range(300):
        card, phone = _card(rng), f"({number(3)}) 555-{number(4)}"
        ip = ".".join(str(rng.randrange(100, 256)) for _ in range(4))
        rows.append((i, f"so anna{i}@example.org then {ip} then {card} then +1 {phone} end"))
        wide = [f"otto{i} [at] example [dot] org", ip.replace(".", ","), fours(card, "./"[i % 2]), phone]
        rows.append((1000 + i, "so " + " then ".join(wide) + " end"))
        planted[1000 + i] = {(k, rows[-1][1].index(w), rows[-1][1].index(w) + len(w)) for k, w in enumerate(wide)}
        no = str(int(card) + 1)  # fails Luhn
        rows.append((2000 + i, f"so {no} then 2024-01-{10 + i % 20} then {number(9)} then {rng.randrange(300, 999)},{number(3)},{number(3)},{number(3)}x end"))
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    for r in found:
        added = {(s.kind, s.start, s.end) for s in r.spans if not s.is_base}
        assert added == planted.get(r.doc_id, set()), r.doc_id


def test_cards_need_no_base_span(spark):
    """Luhn's check alone tells real numbers of a wider form from chance; numbers of which a tenth passes are left."""
    rng = random.Random(9)
    rows = []
    for i in range(200):
        card = _card(rng)
        rows.append((i, "so " + "/".join(card[k : k + 4] for k in range(0, 16, 4)) + " end"))
        rows.append((1000 + i, "so " + "".join(rng.choice("0123456789") for _ in range(13)) + " end"))
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found if r.spans} == set(range(200))


def test_addresses_without_digit_or_sign(spark):
    """An address written out is found in a text that has neither a digit nor an @."""
    rows = [(i, "so anna@example.org end") for i in range(20)]
    rows += [(100 + i, "so otto [at] example [dot] org end" if i % 2 else "so otto(at)example.org end") for i in range(20)]
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(len(r.spans) == 1 and r.spans[0].is_base == (r.doc_id < 100) for r in found)

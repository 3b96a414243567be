"""Quality rules and importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from isobar.llm import crc_grams, likelihood, resampling
from isobar.llm.quality import held_out

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
INK = re.compile("[^\\x20\\x09-\\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def gain_table(s, t, buckets):
    total_s, total_t = sum(s.values()), sum(t.values())
    return {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in s}


# ------------------------------------------------------------------ checksums of word runs
def test_checksums_of_runs_follow_from_prefixes():
    rng = random.Random(3)
    texts = [None, "", " ", "..", "a", "A b"] + [
        " ".join("".join(rng.choice("abXYZ09é日-._") for _ in range(rng.choice([1, 5, 70, 900]))) for _ in range(rng.randrange(12))) for _ in range(60)
    ]
    prefixes = crc_grams.Prefixes.scan(texts)
    split = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    for n in (1, 2, 5):
        found, counts = prefixes.grams(n)
        assert counts.tolist() == [max(0, len(w) - n + 1) for w in split]
        assert found.tolist() == [zlib.crc32(" ".join(w[i : i + n]).encode()) for w in split for i in range(len(w) - n + 1)]


def test_long_shifts():
    lengths = np.array([0, 1, 63, 64, 65, 4096, 1_000_003])
    crc = np.full(len(lengths), zlib.crc32(b"head"), np.uint32)
    for n, got in zip(lengths.tolist(), crc_grams.shifted(crc, lengths).tolist()):
        assert got ^ zlib.crc32(b"\0" * n) == zlib.crc32(b"head" + b"\0" * n)


# ------------------------------------------------------------------ resampling
def brute_resample(rows, target, share=25, least=20, buckets=10_000):
    def runs(text):
        w = WORD.findall((text or "").translate(LOWER))
        return len(w), [zlib.crc32(x.encode()) % buckets for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    found = [(doc_id, *runs(text)) for doc_id, text in rows]
    s = Counter(b for *_, f in found for b in f)
    t = Counter(b for text in target for b in runs(text)[1])
    gain = gain_table(s, t, buckets)
    out = []
    for doc_id, n, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        x = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((x + 0.5) / 4294967296)))))
    eligible = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = eligible[: share * len(eligible) // 100]
    ranked = [(*r, i + 1) for i, r in enumerate(drawn)]
    rest = Counter(out) - Counter(drawn)
    return sorted(ranked + [(*r, None) for r in rest.elements()], key=str)


@pytest.mark.parametrize("parameters", [{}, {"share": 60, "least": 3}])
def test_resampling_against_brute_force(spark, odd, hot, nothing, benchmark, parameters):
    target = [r.text for r in benchmark.collect()]
    names = {"share": "share_percent", "least": "least_words"}
    for table in (odd, hot, nothing):
        got = resampling.resample(table, benchmark, **{names[k]: v for k, v in parameters.items()})
        expected = brute_resample([(r.doc_id, r.text) for r in table.collect()], target, **parameters)
        assert sorted(map(tuple, got.collect()), key=str) == expected


def test_an_empty_target_and_clashing_names(spark, hot, odd, benchmark):
    got = resampling.resample(hot, benchmark.limit(0))
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample([(r.doc_id, r.text) for r in hot.collect()], [])
    clash = odd.withColumnsRenamed({"kept": "rank", "score": "weight"})
    drawn = resampling.drawn_documents(clash, benchmark, share_percent=50, least_words=1)
    assert drawn.columns == clash.columns and drawn.count() == clash.where("text RLIKE '[0-9A-Za-zÄ]'").count() // 2
    with pytest.raises(ValueError):
        resampling.resample(clash, benchmark, columns=["doc_id", "rank"])


def test_batches_are_cut_by_size(spark, odd, benchmark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(resampling, "_BYTES_AT_ONCE", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 4, None, "b" * 30, "", "c" * 5, "d" * 5])], names=["text"])
    parts = list(resampling._portions(batch))
    assert [p.num_rows for p in parts] == [2, 1, 3]
    assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist()


# ------------------------------------------------------------------ quality rules
def brute_rules(rows, good):
    def buckets(text):
        crc = [zlib.crc32(w.encode()) for w in INK.findall((text or "").translate(LOWER))]
        return [c % 65536 for c in crc] + [(a * 1_000_003 + b) % 65536 for a, b in zip(crc, crc[1:])]

    runs = [buckets(text) for _, text in rows]
    s = Counter(b for f in runs for b in f)
    t = Counter(b for (doc_id, _), f in zip(rows, runs) if doc_id in good for b in f)
    share = sum(t.values()) / max(1, sum(s.values()))
    gain = {b: math.floor(1000 * math.log((t[b] + 10) / (s[b] * sum(t.values()) / sum(s.values()) + 10))) for b in s}
    assert share or not any(gain.values())
    out = []
    for (doc_id, text), f in zip(rows, runs):
        text = text or ""
        w = INK.findall(text)
        windows = defaultdict(list)
        for i in range(len(w) - 4):
            windows[tuple(w[i : i + 5])].append(i)
        repeated = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(5)}
        lines = [line for line in text.split("\n") if INK.search(line)]
        ratio = sum(gain[b] for b in f) // (len(f) + 20)
        failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
        out.append((
            doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            ratio, failed, not failed and ratio >= -125,
        ))
    return sorted(out, key=str)


def test_rules_against_brute_force(spark, odd, hot, nothing):
    labels = spark.createDataFrame(
        [(9, 1), (10, 1), (1, 1), (1, 0), (11, 0), (None, 1), (12, None), (77_777, 1), (16, 7), *((i, 1) for i in range(20, 500, 3))],
        "doc_id long, quality int",
    )
    good = {9, 10, 77_777, *range(20, 500, 3)}
    lines = "one line again and a bit of text\n\n  \none line again and a bit of text\nanother | line & <x>\n#one\n"
    more = spark.createDataFrame([(700, lines), (701, "a b c d e f a b c d e g"), (702, "a a a a a a"), (703, "   x y")], "doc_id long, text string")
    for table in (odd, hot, nothing, more):
        got = likelihood.apply_rules(table, labels).collect()
        assert sorted(map(tuple, got), key=str) == brute_rules([(r.doc_id, r.text) for r in table.collect()], good)
    assert likelihood.apply_rules(odd, labels, ["source", "doc_id", "size"]).columns[:3] == ["source", "doc_id", "size"]
    with pytest.raises(ValueError):
        likelihood.apply_rules(odd, labels, ["doc_id", "kept"])


def test_rules_on_labels_not_counted(spark, docs, labels):
    """Trusted documents without the held-out ones; these are judged like their labels, both ways."""
    judged = likelihood.apply_rules(docs, labels.where(~held_out("doc_id")))
    rows = judged.join(labels.where(held_out("doc_id")), "doc_id").where("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert len(good) > 10 and np.mean(good) > 0.95
    assert not bad or np.mean(bad) < 0.3


def test_no_trusted_documents(spark, hot):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = likelihood.apply_rules(hot, none).collect()
    assert sorted(map(tuple, got), key=str) == brute_rules([(r.doc_id, r.text) for r in hot.collect()], set())

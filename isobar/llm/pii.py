"""Personal data: base patterns, wider candidates, and boosted trees that choose among the candidates.

All work on documents is DataFrame code. Only a table of feature cells, bounded by the features' ranges, comes to the
driver, where the trees are fitted; they return as a SQL expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.boost import Forest, fit
from isobar.llm.common import written

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
_BEFORE, _AFTER = 24, 2

# Patterns as asked for, written so that no text makes them slow: quantifiers give nothing back where that could not
# help, and a run of characters is entered only at its start or where the last match ended.
_NAME = "[A-Za-z0-9._%+-]"
_BASE = {
    "email": rf"(?:\G|(?<!{_NAME})){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider forms: other separators, written-out signs, no country sign.
_CANDIDATES = {
    "email": rf"(?:\G|(?<!{_NAME})){_NAME}++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?\[dot\]\x20?|\x20?\(dot\)\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.,:])[0-9]{1,3}+[.,:][0-9]{1,3}+[.,:][0-9]{1,3}+[.,:][0-9]{1,3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20._/-]?[0-9])++",
    "phone": r"(?<![0-9])\(?[0-9](?:[\x20()./-]{0,2}+[0-9])++",
}
_DIGITS = {"email": (0, 10**9), "ip": (4, 12), "card": (12, 20), "phone": (7, 15)}
_HINTS = {
    "email": "mail|contact|write to|reach",
    "ip": r"\bip\b|address|host|server|login from",
    "card": "card|visa|master|amex|credit|debit|payment|carte|karte|tarjeta",
    "phone": "phone|tel|call|fax|mobile|cell|dial|whatsapp",
}
#: Every feature of the trees and how many values it has; cells of them are what comes to the driver. None tells which separators or
#: sign a span has: what base patterns confirm has theirs alone, and the trees would learn nothing else. Digits are counted from the
#: least of the kind; shapes are the lengths, up to 5, of a phone's last three groups, the same with and without a country code.
FEATURES = {"f_kind": 4, "f_digits": 16, "f_shape": 216, "f_valid": 2, "f_long": 2, "f_glued": 2, "f_hint": 2}
#: Chance of a number that is none to pass: Luhn's check, and 100 to 255 among numbers of three digits. As odds.
_LUCK = {"card": 1 / 9, "ip": 156 / 744}
_LEAST_ALIKE = 5

def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether up to 20 digits pass the check."""
    n = F.length(digits)
    values = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1))
    total = F.aggregate(values, F.lit(0), lambda t, v: t + F.when(v > 9, v - 9).otherwise(v))
    return F.when(n.between(12, 20), total % 10 == 0).otherwise(False)


_OCTETS = "^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})" + "[.,:]0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})" * 3 + "$"

_HOST = r"(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z]{2,}$"  # the last label; what is before it has matched a pattern already
_DATE = r"^\(?(?:(?:19|20)[0-9]{2}[\x20./-][0-9]{1,2}[\x20./-][0-9]|[0-9]{1,2}[\x20./-][0-9]{1,2}[\x20./-](?:19|20)[0-9]{2}(?![0-9]))"
#: What base patterns do not allow inside a number.
_WIDE = {"email": r"\x20|\[|\(", "ip": "[,:]", "card": "[._/]", "phone": "."}


def _found(docs: DataFrame) -> DataFrame:
    """Base and candidate matches: _row, doc_id, is_base, kind, start, end, match, before, after; a row with NULL kind for a text without any.

    One row of each text, with or without a match, is its ``_anchor``.

    A pattern's matches and the texts between them, alternating, give the places by sums over the pieces before.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", text.alias("text"))
    specs = [(True, k, p) for k, p in _BASE.items()] + [(False, k, p) for k, p in _CANDIDATES.items()]
    tries = F.array(*[
        F.struct(
            F.lit(is_base).alias("is_base"), F.lit(KINDS.index(kind)).alias("kind"),
            F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("matches"), F.split("text", pattern, -1).alias("between"),
        )
        for is_base, kind, pattern in specs
    ])
    # Most texts have no digit, @ or [at]: one quick search leaves them out, none of which a pattern could match.
    rows = rows.withColumn("tries", F.when(F.col("text").rlike(r"[0-9@]|[\[(]at[\])]"), tries)).drop("text")
    rows = rows.select("_row", "doc_id", F.explode_outer("tries").alias("t"))
    rows = rows.select("_row", "doc_id", "t.is_base", "t.kind", F.col("t.matches").alias("m"), F.col("t.between").alias("s"))
    rows = rows.where("kind IS NULL OR size(m) > 0 OR (is_base AND kind = 0)")  # each text keeps a row
    pieces = F.arrays_zip(F.col("m").alias("match"), F.col("s").alias("before"), F.slice("s", F.lit(2), F.greatest(F.size("s"), F.lit(1))).alias("after"))
    rows = rows.select("_row", "doc_id", "is_base", "kind", F.posexplode_outer(pieces).alias("pos", "p"))
    rows = rows.where("pos IS NULL OR pos = 0 OR p.match IS NOT NULL").select(
        # The first piece for the base pattern of email: each text has it, or no pieces at all.
        "_row", "doc_id", "is_base", F.expr("kind IS NULL OR (is_base AND kind = 0 AND coalesce(pos, 0) = 0)").alias("_anchor"), F.when(F.col("p.match").isNotNull(), F.col("kind")).alias("kind"), "pos",
        F.col("p.match").alias("match"),
        F.length("p.before").alias("gap"), F.expr(f"right(p.before, {_BEFORE})").alias("before"), F.expr(f"left(p.after, {_AFTER})").alias("after"),
    )
    order = Window.partitionBy("_row", "is_base", "kind").orderBy("pos")
    upto, earlier = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum("gap").over(upto) + F.coalesce(F.sum(F.length("match")).over(earlier), F.lit(0))
    return rows.withColumn("start", start).withColumn("end", F.col("start") + F.length("match")).drop("pos", "gap")


def _of_kind(kind: str) -> Column:
    return F.col("kind") == KINDS.index(kind)


def _by_kind(values: dict[str, Column]) -> Column:
    chosen = F
    for kind, value in values.items():
        chosen = chosen.when(_of_kind(kind), value)
    return chosen.otherwise(F.lit(False))


def spans(docs: DataFrame) -> DataFrame:
    """Valid base spans and candidates with their features, and an empty row (NULL kind) for each text."""
    rows = _found(docs).withColumn("digits", _digits(F.col("match")))
    n = F.length("digits")
    rows = rows.withColumn("luhn", _luhn(F.col("digits"))).withColumn("octets", F.coalesce(F.col("match").rlike(_OCTETS), F.lit(False)))
    valid = _by_kind({"email": F.lit(True), "ip": F.col("octets"), "card": n.between(16, 19) & F.col("luhn"), "phone": n.between(8, 15)})
    likely = _by_kind({k: n.between(*_DIGITS[k]) for k in KINDS})
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    hint = _by_kind({k: F.lower("before").rlike(h) for k, h in _HINTS.items()})
    glued = F.col("before").rlike("[A-Za-z0-9_]$") | F.col("after").rlike("^[A-Za-z0-9_]")
    groups = F.regexp_extract_all("match", F.lit("[0-9]+"), F.lit(0))
    # What speaks for the kind whatever the separators are. A run of digits alone or a date is no phone.
    speaks = _by_kind({
        "email": F.col("match").rlike(_HOST), "ip": F.col("octets"), "card": F.col("luhn"),
        "phone": n.between(8, 15) & (F.size(groups) > 1) & ~F.col("match").rlike(_DATE),
    })
    last = lambda i: F.least(F.lit(5), F.coalesce(F.length(F.get(groups, F.size(groups) - i)), F.lit(0)))
    wide = _by_kind({k: F.col("match").rlike(w) if k != "card" else F.col("match").rlike(w) | ~n.between(16, 19) for k, w in _WIDE.items()})
    counted = F.when(_of_kind("ip"), n - _DIGITS["ip"][0]).when(_of_kind("card"), n - _DIGITS["card"][0]).otherwise(0)
    featured = rows.select(
        "_row", "doc_id", "_anchor", "is_base", "kind", "start", "end",
        F.when(F.col("is_base"), valid).otherwise(likely).alias("_holds"),
        F.col("kind").alias("f_kind"),
        F.least(F.lit(15), F.greatest(F.lit(0), counted)).alias("f_digits"),
        F.when(_of_kind("phone"), last(3) * 36 + last(2) * 6 + last(1)).otherwise(0).alias("f_shape"),
        flag(speaks).alias("f_valid"), flag(_of_kind("ip") & F.col("match").rlike("[0-9]{3}")).alias("f_long"),
        flag(glued).alias("f_glued"), flag(hint).alias("f_hint"), flag(wide).alias("_wide"),
    )
    # An anchor is there twice, the second time as the empty row of its text.
    copies = F.when(F.col("_anchor"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    twice = featured.withColumn("_empty", F.explode(copies)).where("_empty OR (kind IS NOT NULL AND _holds)")
    values = [c for c in featured.columns if c not in ("_row", "doc_id", "_anchor", "_holds")]
    return twice.select("_row", "doc_id", *[F.when(~F.col("_empty"), F.col(c)).alias(c) for c in values])


def _near_base(same_kind: bool) -> Column:
    """Whether a base span overlaps this row's span, among all of the text or those of its kind."""
    parts = ["_row", "kind"] if same_kind else ["_row"]
    order = Window.partitionBy(*parts).orderBy(F.col("start"), F.col("is_base").desc(), F.col("end"))
    base = F.col("is_base")
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    return F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))


def _likely_true(x: np.ndarray, wide: np.ndarray, unconfirmed: np.ndarray, confirmed: np.ndarray) -> np.ndarray:
    """How many of each cell's unconfirmed candidates are expected to be real, from evidence that no separator bears on.

    Cards, and addresses with a number of three digits: those that pass the check without glued edges, less those that pass by
    luck, as told by how many alike fail it. Others: those that speak for the kind, less as many as are alike but glued, if base spans
    confirm some of the same shape. Base and wider forms are counted apart.
    """
    kind, digits, shape, speaks, long, glued, hint = (x[:, i] for i in range(len(FEATURES)))
    real = np.zeros(len(x))
    for c in np.flatnonzero((speaks == 1) & (glued == 0) & (unconfirmed > 0)):
        name = KINDS[int(kind[c])]
        if name == "card" or (name == "ip" and long[c]):
            alike = (kind == kind[c]) & (digits == digits[c]) & (long == long[c]) & (wide == wide[c]) & (glued == 0)
            wrong = (1 + unconfirmed[alike & (speaks == 0)].sum()) * _LUCK[name]
            all_ = unconfirmed[alike & (speaks == 1)].sum()
        else:
            alike = (kind == kind[c]) & (shape == shape[c]) & (speaks == 1)
            if name == "ip":
                alike &= hint == 1
            if confirmed[alike & (glued == 0)].sum() < _LEAST_ALIKE or (name == "ip" and not hint[c]):
                continue
            alike &= wide == wide[c]
            wrong, all_ = unconfirmed[alike & (glued == 1)].sum(), unconfirmed[alike & (glued == 0)].sum()
        real[c] = unconfirmed[c] * max(0.0, 1 - wrong / all_)
    return real


@dataclass(frozen=True)
class Chooser:
    """Trees over candidate features, and the log-odds from which a candidate of each kind counts."""

    forest: Forest
    least: dict[str, float]

    @staticmethod
    def learn(marks: DataFrame, precision: float = PRECISION) -> Chooser:
        """Fit on all candidates, counted by cells of features: a table with a bounded number of rows for any corpus.

        What a base span of the kind confirms is positive. Others are not negative for want of a base pattern: of those that
        ``_likely_true`` finds real, as many are positive. A kind's threshold is the lowest at which ``precision`` of the
        unconfirmed candidates above it, those that would be added, are expected to be real, and never under even odds.
        """
        names = list(FEATURES)
        cells = marks.where("kind IS NOT NULL AND NOT is_base").groupBy(*names, "_wide").agg(
            F.count("*").alias("n"), F.sum(F.col("_confirmed").cast("long")).alias("yes")
        ).orderBy(*names, "_wide").collect()
        x = np.array([[c[name] for name in names] for c in cells], float).reshape(len(cells), len(names))
        n, yes = (np.array([c[k] for c in cells], float) for k in ("n", "yes"))
        real = _likely_true(x, np.array([c["_wide"] for c in cells], float), n - yes, yes)
        positive = yes + real
        forest = fit(np.concatenate([x, x]), np.repeat([1.0, 0.0], len(x)), np.concatenate([positive, n - positive]), trees=40, depth=4, bins=256)
        margins = forest.margins(x)
        least = {}
        for number, kind in enumerate(KINDS):
            own = np.flatnonzero((x[:, 0] == number) & (n > yes))
            own = own[np.argsort(-margins[own], kind="stable")]
            last = np.append(margins[own][1:] != margins[own][:-1], True)[: len(own)]  # equal margins are taken together
            good = np.flatnonzero(last & (np.cumsum(real[own]) >= precision * np.cumsum((n - yes)[own])))
            least[kind] = max(0.0, float(margins[own[good[-1]]])) if len(good) else float("inf")
        return Chooser(forest, least)

    def margin(self) -> Column:
        return F.expr(self.forest.sql(list(FEATURES)))

    def accepts(self) -> Column:
        return _by_kind({
            k: F.col("_margin") >= F.lit(v) if v != float("inf") else F.lit(False) for k, v in self.least.items()
        })


def find_personal_data(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """Per row of ``docs``: doc_id and ``spans``, an array of (kind, start, end, is_base), by kind and start.

    Base spans are the leftmost matches of the base patterns, taken one after the other, that hold (numbers of an address up to 255, 16 to 19 digits that
    pass Luhn, 8 to 15 digits of a phone); they always stay. Candidates are found by wider patterns, may overlap across kinds,
    and are added where the trees choose them, no base span overlaps them, and no candidate that overlaps them scores higher. Places count code
    points, ends are exclusive. NULL text counts as empty; NULL and repeated doc_ids are rows like others. An empty
    table gives no rows.
    """
    marks = written(spans(docs).withColumn("_confirmed", F.when(F.col("kind").isNotNull(), _near_base(True))), "pii")
    chooser = Chooser.learn(marks, precision)
    rows = marks.withColumn("_margin", chooser.margin())
    rows = rows.where(F.col("kind").isNull() | F.col("is_base") | (chooser.accepts() & ~F.col("_confirmed")))
    rows = rows.withColumn("_covered", ~F.col("is_base") & _near_base(False))
    rows = rows.where(F.col("kind").isNull() | ~F.col("_covered"))
    # Added spans that overlap form islands; each keeps its best.
    order = Window.partitionBy("_row", "is_base").orderBy("start", "end", "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_first", (reach.isNull() | (reach <= F.col("start"))).cast("int"))
    rows = rows.withColumn("_island", F.sum("_first").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    best = Window.partitionBy("_row", "is_base", "_island").orderBy(F.desc("_margin"), F.desc(F.col("end") - F.col("start")), "kind", "start")
    rows = rows.withColumn("_rank", F.row_number().over(best)).where("kind IS NULL OR is_base OR _rank = 1")
    span = F.when(F.col("kind").isNotNull(), F.struct("kind", "start", "end", "is_base"))
    return rows.groupBy("_row", "doc_id").agg(F.sort_array(F.collect_list(span)).alias("spans")).drop("_row")


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the hash of their list, and the list of all spans as text."""
    names = F.array(*[F.lit(k) for k in KINDS])
    said = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["is_base"])
    of_kind = lambda number: F.filter("spans", lambda s: s["is_base"] & (s["kind"] == number))
    counts = [F.size(of_kind(i)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, found: DataFrame, mask: str = "*") -> DataFrame:
    """``docs`` with every character of the spans replaced; ``found`` has distinct doc_ids."""
    hidden = found.select(F.col("doc_id").alias("_found"), F.col("spans").alias("_spans"))
    rows = docs.join(hidden, F.col("doc_id") == F.col("_found"), "left")
    covered = F.aggregate(
        "_spans", F.col("text"),
        lambda t, s: F.overlay(t, F.repeat(F.lit(mask), (s["end"] - s["start"]).cast("int")), (s["start"] + 1).cast("int")),
    )
    return rows.withColumn("text", F.when(F.size("_spans") > 0, covered).otherwise(F.col("text"))).select(*docs.columns)

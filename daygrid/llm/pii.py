"""Personal data: generators propose spans, boosted trees over format and context choose among them.

Base rules find emails, IP addresses, cards and phones as stated by their patterns. Wider generators
propose further, overlapping spans. Their features are counted in cells over all documents; boosting
runs over the cells and gives trees that are CASE expressions. A threshold per kind is calibrated on the
same cells. Everything that touches rows is a built-in function of Spark; positions are code points.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


KINDS = ("email", "ip", "card", "phone")
TREES, RATE = 12, 0.4
#: Added spans must be right so often among all spans at or above the threshold.
PRECISION = 0.98
CONTEXT = 24

_LOCAL = "[A-Za-z0-9._%+-]"
_HOST = "[A-Za-z0-9-]"
#: A run that fails from its first character fails from every other one, so only starts of runs are tried.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Text without this cannot match the base pattern.
HINT = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
WIDE = {
    "email": r"(?<![^\s<>(),;:\"])[^\s<>(),;:\"@]++@[^\s<>(),;:\"@]*[^\s<>(),;:\"@.]",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}[\x20.-]?){3}[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00)[1-9][0-9()./\x20-]{6,18}[0-9](?![0-9])",
}
#: Text without this cannot match the wide pattern.
WIDE_HINT = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]{4}", "phone": r"(?:\+|00)[1-9]"}
KEYWORDS = "(?i)mail|phone|tel|call|mobile|fax|card|visa|credit|ip|host|server|address|contact"
FEATURES = ("digits", "breaks", "valid", "context", "before", "after", "tail")


def _empty() -> Column:
    return F.array().cast("array<struct<start:int,end:int,text:string>>")


def located(text: Column, pattern: str, hint: str) -> Column:
    """Matches of ``pattern`` with their places: what lies between matches tells where they start."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.filter(
        F.zip_with(found, F.split(text, pattern, -1), lambda m, gap: F.struct(m.alias("m"), F.length(gap).alias("gap"))),
        lambda s: s["m"].isNotNull(),
    )
    start = F.struct(F.lit(0).alias("at"), _empty().alias("spans"))

    def add(acc: Column, s: Column) -> Column:
        begin = acc["at"] + s["gap"]
        end = begin + F.length(s["m"])
        span = F.struct(begin.alias("start"), end.alias("end"), s["m"].alias("text"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.when(text.rlike(hint), F.aggregate(steps, start, add, lambda acc: acc["spans"])).otherwise(_empty())


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The weighted digit sum is a multiple of ten."""
    each = F.split(F.reverse(digits), "")

    def value(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    marked = F.transform(F.filter(each, lambda d: d != ""), value)
    return F.aggregate(marked, F.lit(0), lambda a, v: a + v) % 10 == 0


def valid(kind: str, s: Column) -> Column:
    digits = _digits(s)
    if kind == "ip":
        parts = F.transform(F.split(s, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) > 3, False).otherwise(p.cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True) if kind == "email" else F.lit(False)


def _email_shape(s: Column) -> Column:
    return s.rlike(r"^[^@]{1,64}@[^@.-][^@]*\.[^@.0-9]{2,}$")


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(located(text, BASE[kind], HINT[kind]), lambda s: valid(kind, s["text"]))


def _class_at(text: Column, place: Column) -> Column:
    """0 nothing or white space, 1 digit, 2 letter, 3 other."""
    c = F.when(place >= 0, F.substr(text, place + 1, F.lit(1))).otherwise("")
    return F.when(c.rlike(r"^\s*$"), 0).when(c.rlike("[0-9]"), 1).when(c.rlike(r"\p{L}"), 2).otherwise(3)


def proposals(text: Column, kind: str) -> Column:
    """Wider spans of a kind with their features."""

    def features(s: Column) -> Column:
        t = s["text"]
        left = F.greatest(F.lit(0), s["start"] - CONTEXT)
        ok = _email_shape(t) if kind == "email" else valid(kind, t)
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), t.alias("text"),
            F.least(F.length(_digits(t)), F.lit(20)).alias("digits"),
            F.least(F.length(F.regexp_replace(t, "[0-9A-Za-z]", "")), F.lit(8)).alias("breaks"),
            ok.cast("int").alias("valid"),
            F.substr(text, left + 1, s["start"] - left).rlike(KEYWORDS).cast("int").alias("context"),
            _class_at(text, s["start"] - 1).alias("before"), _class_at(text, s["end"]).alias("after"),
            F.least(F.length(F.regexp_extract(t, r"\.(\p{L}+)$", 1)), F.lit(8)).alias("tail"),
        )

    return F.transform(located(text, WIDE[kind], WIDE_HINT[kind]), features)


# Boosting over cells.




def boost(cells: np.ndarray, right: np.ndarray, total: np.ndarray) -> tuple[float, list]:
    """Logistic boosting with trees of two levels over cells (rows of features) with counts."""
    prior = (right.sum() + 1) / (total.sum() + 2)
    base = float(np.log(prior / (1 - prior)))
    score, trees = np.full(len(cells), base), []
    cuts = [(f, c) for f in range(cells.shape[1]) for c in np.unique(cells[:, f])[1:]] if len(cells) else []
    for _ in range(TREES if cuts else 0):
        p = 1 / (1 + np.exp(-score))
        grad, hess = right - total * p, total * p * (1 - p) + 1e-9

        def best(rows: np.ndarray):
            gain = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + 1)  # noqa: B023, E731
            return max(cuts, key=lambda fc: gain(rows & (cells[:, fc[0]] < fc[1])) + gain(rows & (cells[:, fc[0]] >= fc[1])))

        f, c = best(np.ones(len(cells), bool))
        low = cells[:, f] < c
        leaves, second = [], []
        for side in (low, ~low):
            g, d = best(side)
            second.append((g, int(d)))
            under = cells[:, g] < d
            for leaf in (side & under, side & ~under):
                value = RATE * grad[leaf].sum() / (hess[leaf].sum() + 1)
                leaves.append(float(value))
                score[leaf] += value
        trees.append((f, int(c), second, leaves))
    return base, trees


def score_of(s: Column, base: float, trees: list) -> Column:
    """The boosted score (log odds) of a proposal as one expression."""
    out = F.lit(base)
    for f, c, ((g, d), (h, e)), (a, b, x, y) in trees:
        left = F.when(s[FEATURES[g]] < d, a).otherwise(b)
        right = F.when(s[FEATURES[h]] < e, x).otherwise(y)
        out = out + F.when(s[FEATURES[f]] < c, left).otherwise(right)
    return out


def _score(cells: np.ndarray, base: float, trees: list) -> np.ndarray:
    score = np.full(len(cells), base)
    for f, c, ((g, d), (h, e)), (a, b, x, y) in trees:
        left, right = np.where(cells[:, g] < d, a, b), np.where(cells[:, h] < e, x, y)
        score += np.where(cells[:, f] < c, left, right)
    return score


def fit(docs: DataFrame) -> dict[str, tuple[float, list, float]]:
    """Prior, trees and threshold per kind, from the proposals of all rows. A proposal counts as right if it
    has the kind's form: its checks hold and neither a letter nor a digit touches it. Features are small
    integers, so cells are few; they, not rows, come to the driver."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    model = {}
    rows = reduce(
        lambda a, b: a.unionByName(b),
        [
            texts.select(F.lit(kind).alias("kind"), F.explode(proposals(F.col("text"), kind)).alias("s")) for kind in KINDS
        ],
    )
    right = (F.col("s.valid") == 1) & ~F.col("s.before").isin(1, 2) & ~F.col("s.after").isin(1, 2)
    counted = rows.groupBy("kind", *[F.col(f"s.{f}").alias(f) for f in FEATURES]).agg(
        F.count("*").alias("n"), F.count_if(right).alias("right")
    ).collect()
    for kind in KINDS:
        mine = sorted((tuple(r[f] for f in FEATURES), r.right, r.n) for r in counted if r.kind == kind)
        cells = np.array([m[0] for m in mine], np.int64).reshape(-1, len(FEATURES))
        good, total = np.array([m[1] for m in mine], float), np.array([m[2] for m in mine], float)
        base, trees = boost(cells, good, total)
        model[kind] = (base, trees, threshold_of(_score(cells, base, trees), good, total) - 1e-9)
    return model


def threshold_of(score: np.ndarray, right: np.ndarray, total: np.ndarray) -> float:
    """The lowest score down to which every bar leaves PRECISION of the spans right; infinite if there is none."""
    order = np.argsort(-score, kind="stable")
    bars = score[order]
    last = np.flatnonzero(np.r_[bars[1:] != bars[:-1], np.ones(min(1, len(bars)), bool)])
    enough = right[order].cumsum()[last] >= PRECISION * total[order].cumsum()[last]
    held = len(last) if enough.all() else int(enough.argmin())
    return float(bars[last[held - 1]]) if held else float("inf")


def find(docs: DataFrame, model: dict) -> DataFrame:
    """The columns of ``docs`` and, per kind, ``base_<kind>`` and ``all_<kind>``: arrays of (start, end, text).

    Base spans always stay; an added span reaches its threshold and overlaps no base span of its kind
    and no added span before it. Null texts are empty. Columns of ``docs`` with such names are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumns({f"base_{kind}": base_spans(text, kind) for kind in KINDS})
    return out.withColumns({f"all_{kind}": _with_added(text, kind, *model[kind]) for kind in KINDS})


def _with_added(text: Column, kind: str, base: float, trees: list, threshold: float) -> Column:
    own = F.col(f"base_{kind}")
    if threshold == float("inf"):
        return own
    apart = lambda s: ~F.exists(own, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    chosen = F.filter(proposals(text, kind), lambda s: (score_of(s, base, trees) >= threshold) & apart(s))
    plain = F.transform(chosen, lambda s: F.struct(*[s[name].alias(name) for name in ("start", "end", "text")]))
    return F.when(text.rlike(WIDE_HINT[kind]), F.array_sort(F.concat(own, plain))).otherwise(own)


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span (start, end, kind), sorted by start, replaced by its kind in brackets."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        gap = F.substr(text, acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(spans, start, add, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))


def listing(prefix: str) -> Column:
    """kind:start:end of all spans by kind as listed, then start, joined by commas."""
    def lines(kind: str) -> Column:
        return F.transform(F.col(f"{prefix}_{kind}"), lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.array_join(F.concat(*[lines(kind) for kind in KINDS]), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts of base spans, the digest of their listing and all spans per row of ``docs`` (doc_id, text)."""
    model = fit(docs)
    found = find(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        *[F.size(f"base_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listing("base"), 256).alias("base_sha256"),
        listing("all").alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind; a null text stays null, n_chars follows."""
    model = fit(docs)
    names = docs.columns

    def marked(kind: str) -> Column:
        negative_end = lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), F.lit(kind).alias("kind"))
        return F.transform(F.col(f"all_{kind}"), negative_end)

    # Of spans with one start the longest comes first.
    ordered = F.transform(
        F.array_sort(F.concat(*[marked(kind) for kind in KINDS])),
        lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind")),
    )
    found = find(docs, model).withColumn("pii_spans", ordered)
    text = F.when(F.size("pii_spans") == 0, F.col("text")).otherwise(redacted(F.col("text"), F.col("pii_spans")))
    out = found.withColumn("text", text)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.size("pii_spans") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*names)

"""Personal data by pattern rules and gradient-boosted candidates, in DataFrame functions only.

*Base spans* follow fixed patterns with checks (parts of an address, Luhn digits, number of digits).
*Candidates* come from wider patterns of each kind (other separators, spelled-out signs). Boosted trees
over format and context features score them; they are fitted on the candidates of all documents, where
one that a base span confirms is a positive. Features tell nothing about the separators, so a
spelling that the base pattern does not know gets the score of the same number or address in a known one.
Scores are calibrated per kind on a quarter of all documents, whose candidates the trees have not seen: the threshold is the least score at
which ``PRECISION`` of the candidates above it are confirmed. A chosen candidate that touches no base span
is added; of added spans that overlap, the first stays.

Matching is one pass over the text per pattern: the text between the matches gives their positions and
contexts. Patterns are possessive and start only where a match can start, so long texts cost linear time.
There is no shuffle but for the counts the model is fitted on.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.frames import session_of

KINDS = ("email", "ip", "card", "phone")
ROUNDS, DEPTH, RATE = 30, 3, 0.3
PRECISION = 0.9
CONTEXT = 24

# The base patterns; each is equal to its plain greedy form, leftmost and without overlap. ``\G`` is the
# end of the match before: a local part may begin there though a word character precedes it.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# The wider patterns.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]|(?<= )at(?= )) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]|(?<= )dot(?= )) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.,:])[0-9]{1,4}+(?: ?[.,:] ?[0-9]{1,4}+){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ ./_-]{0,2}+[0-9]){11,19}+(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00|\()[ ]?[0-9][0-9 ()./-]{6,20}[0-9](?![0-9])",
}
NEEDS = {"email": r"@|\(at\)|\[at\]| at ", "ip": "[0-9]", "card": "[0-9]", "phone": r"[0-9]"}
CUES = r"(?i)(?:mail|contact|call|tel|phone|fax|mobile|card|visa|pay|iban|account|ip|host|server|address|reach)[^A-Za-z]{0,12}$"

_SPAN = "struct<kind:int,start:int,stop:int>"
FEATURES = ("kind", "digits", "letters", "length", "luhn", "sign", "octets", "before", "after", "cue", "plus", "variety")


def matches(text: Column, kind: int, pattern: str, needs: str) -> Column:
    """All matches, as structs of kind, start, stop (code points), value and the text around."""
    shape = f"array<struct<kind:int,start:int,stop:int,value:string,before:string,after:string>>"
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    around = F.split(text, pattern, -1)
    # n values stand between n + 1 pieces; the last value is padded with null.
    paired = F.zip_with(around, values, lambda p, v: F.struct(p.alias("p"), v.alias("v")))
    nexts = F.concat(F.slice(around, 2, F.size(around)), F.array(F.lit("")))
    rows = F.zip_with(paired, nexts, lambda x, n: F.struct(
        x["p"].alias("p"), x["v"].alias("v"), n.alias("n")))

    def step(acc, x):
        start = acc["at"] + F.length(x["p"])
        stop = start + F.coalesce(F.length(x["v"]), F.lit(0))
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), x["v"].alias("value"),
                       F.right(x["p"], F.lit(CONTEXT)).alias("before"), F.substring(x["n"], 1, CONTEXT).alias("after"))
        return F.struct(stop.alias("at"), F.when(x["v"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(one))).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(shape).alias("out"))
    found = F.aggregate(rows, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(needs), found).otherwise(F.array().cast(shape))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, F.element_at(
        F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.aggregate(places, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _octets(value: Column) -> Column:
    """Whether every run of digits is at most 255, whatever its leading zeros."""
    parts = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))
    return F.forall(parts, lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def base_spans(text: Column) -> Column:
    """The checked base spans, by kind as listed, then by start."""
    checks = {
        "email": lambda x: F.lit(True), "ip": lambda x: _octets(x["value"]), "card": lambda x: luhn(digits_of(x["value"])),
        "phone": lambda x: F.length(digits_of(x["value"])).between(9, 15)}
    parts = [F.filter(matches(text, i, BASE[k], NEEDS[k] if k != "email" else "@"), checks[k]) for i, k in enumerate(KINDS)]
    return F.transform(F.concat(*parts), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")))


def _class(char: Column) -> Column:
    return F.when(F.length(char) == 0, 0).when(char.rlike(r"^\p{L}"), 1).when(char.rlike("^[0-9]"), 2).when(char.rlike(r"^\s"), 0).otherwise(3)


def features(x: Column) -> dict[str, Column]:
    """Small whole numbers about a candidate; none tells which separators it has."""
    value, digits = x["value"], digits_of(x["value"])
    flag = lambda c: c.cast("int")
    return {
        "kind": x["kind"], "digits": F.least(F.length(digits), F.lit(20)),
        "letters": F.least(F.length(F.regexp_replace(value, r"[^\p{L}]", "")) / 4, F.lit(5)).cast("int"),
        "length": F.least(F.length(F.regexp_replace(value, r"[^\p{L}0-9]", "")) / 6, F.lit(6)).cast("int"),
        "luhn": flag((F.length(digits) > 0) & luhn(digits)), "sign": flag(value.rlike("@|at")), "octets": flag(_octets(value)),
        "before": _class(F.right(x["before"], F.lit(1))), "after": _class(F.substring(x["after"], 1, 1)),
        "cue": flag(x["before"].rlike(CUES)), "plus": flag(value.startswith("+")),
        "variety": F.least(F.size(F.array_distinct(F.split(digits, ""))), F.lit(6)),
    }


def candidates(text: Column) -> Column:
    """Candidates of all kinds with their features."""
    found = F.concat(*(matches(text, i, WIDE[k], NEEDS[k]) for i, k in enumerate(KINDS)))
    return F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), x["stop"].alias("stop"), *(v.alias(k) for k, v in features(x).items())))


# -- boosted trees ---------------------------------------------------------------------------------

@dataclass
class Tree:
    """A split (feature, limit) with the trees at or below and above the limit, or a leaf value."""
    value: float = 0.0
    feature: int = -1
    limit: int = 0
    low: Tree | None = None
    high: Tree | None = None

    def apply(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.value)
        return np.where(x[:, self.feature] <= self.limit, self.low.apply(x), self.high.apply(x))

    def column(self, of: dict[str, Column]) -> Column:
        if self.feature < 0:
            return F.lit(self.value)
        return F.when(of[FEATURES[self.feature]] <= self.limit, self.low.column(of)).otherwise(self.high.column(of))


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> Tree:
    """A regression tree on gradients and curvatures by exhaustive splits."""
    total_g, total_h = g.sum(), h.sum()
    best, leaf = (1e-6, -1, 0), Tree(RATE * total_g / (total_h + 1.0))
    if depth:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for limit in values[:-1]:
                low = x[:, f] <= limit
                a, b = g[low].sum(), h[low].sum()
                gain = a * a / (b + 1) + (total_g - a) ** 2 / (total_h - b + 1) - total_g**2 / (total_h + 1)
                if gain > best[0]:
                    best = (gain, f, int(limit))
    if best[1] < 0:
        return leaf
    low = x[:, best[1]] <= best[2]
    return Tree(0.0, best[1], best[2], _grow(x[low], g[low], h[low], depth - 1), _grow(x[~low], g[~low], h[~low], depth - 1))


@dataclass
class Model:
    trees: list[Tree]
    thresholds: tuple[float, ...]  # per kind, on the raw score

    def chosen(self, x: Column) -> Column:
        of = {k: x[k] for k in FEATURES}
        score = reduce(lambda a, b: a + b, (t.column(of) for t in self.trees), F.lit(0.0))
        return score >= F.element_at(F.array(*map(F.lit, self.thresholds)), x["kind"] + 1)


def boost(x: np.ndarray, positive: np.ndarray, count: np.ndarray, held: np.ndarray) -> Model:
    """Trees for cells of equal features with their numbers of rows, and thresholds from the held-out cells."""
    score, trees = np.zeros(len(x)), []
    n, y = np.where(held, 0, count), np.where(held, 0, positive)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        trees.append(_grow(x[n > 0], (y - n * p)[n > 0], (n * p * (1 - p))[n > 0], DEPTH) if n.any() else Tree())
        score = score + trees[-1].apply(x)
    thresholds = []
    for kind in range(len(KINDS)):
        own = np.flatnonzero(held & (x[:, 0] == kind))
        own = own[np.argsort(-score[own], kind="stable")]
        right = np.cumsum(positive[own]) / np.maximum(np.cumsum(count[own]), 1)
        # A threshold may not cut through cells of one score.
        last = np.append(score[own][1:] != score[own][:-1], True) if len(own) else np.zeros(0, bool)
        good = np.flatnonzero((right >= PRECISION) & last)
        thresholds.append(float(score[own][good[-1]]) if len(good) else float("inf"))
    return Model(trees, tuple(thresholds))


def fit(docs: DataFrame) -> Model:
    """A model from all documents: three quarters of them, by hash, give the trees, the others the thresholds.

    The driver gets counts per cell of equal features. Their number is bounded by the few values that each
    feature takes, not by the input.
    """
    session_of(docs)
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), "doc_id")
    rows = rows.select("doc_id", base_spans(F.col("text")).alias("base"), F.explode(candidates(F.col("text"))).alias("x"))
    confirmed = F.exists("base", lambda b: (b["kind"] == F.col("x.kind")) & (b["start"] < F.col("x.stop")) & (b["stop"] > F.col("x.start")))
    cells = rows.select("x.*", confirmed.cast("int").alias("y"), (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)) == 0).cast("int").alias("held")).groupBy(
        *FEATURES, "held").agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *FEATURES, "held").collect()
    if not cells:
        return Model([], (float("inf"),) * len(KINDS))
    x = np.array([[r[f] for f in FEATURES] for r in cells], np.int64)
    return boost(x, np.array([float(r["y"]) for r in cells]), np.array([float(r["n"]) for r in cells]), np.array([r["held"] == 1 for r in cells]))


# -- spans and redaction ---------------------------------------------------------------------------

def all_spans(base: Column, wide: Column, model: Model) -> Column:
    """Base spans and the added ones, by kind, then start; ``base`` and ``wide`` are columns of their own."""
    empty = F.array().cast(f"array<{_SPAN}>")
    if not model.trees:
        return base
    tagged = lambda c, own: F.transform(c, lambda x: F.struct(
        x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind"), F.lit(own).alias("base")))
    row = F.array_sort(F.concat(tagged(base, True), tagged(F.filter(wide, model.chosen), False)))
    shape = "array<struct<start:int,stop:int,kind:int,base:boolean>>"
    # Backwards: a candidate that reaches into a base span behind it goes. Forwards: one that begins inside
    # a base span, or inside a candidate that stays, goes.
    back = F.aggregate(F.reverse(row), F.struct(F.lit(2**31 - 1).alias("edge"), F.array().cast(shape).alias("out")), lambda a, x: F.struct(
        F.when(x["base"], F.least(a["edge"], x["start"])).otherwise(a["edge"]).alias("edge"),
        F.when(x["base"] | (x["stop"] <= a["edge"]), F.concat(a["out"], F.array(x))).otherwise(a["out"]).alias("out")),
        lambda a: F.reverse(a["out"]))
    kept = F.aggregate(back, F.struct(F.lit(0).alias("edge"), empty.alias("out")), lambda a, x: F.struct(
        F.when(x["base"] | (x["start"] >= a["edge"]), F.greatest(a["edge"], x["stop"])).otherwise(a["edge"]).alias("edge"),
        F.when(~x["base"] & (x["start"] >= a["edge"]), F.concat(a["out"], F.array(F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"))))).otherwise(a["out"]).alias("out")),
        lambda a: a["out"])
    return F.array_sort(F.concat(base, kept))


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of kind (index in ``KINDS``), start, stop.

    Offsets are code points, stop is exclusive. Null and empty texts have no spans. Rows with a null id,
    repeated ids and repeated rows each keep their row, and so do columns of other names; columns named
    ``base_spans``, ``wide_spans`` or ``spans`` are replaced. An empty table gives no rows.
    """
    session_of(docs)
    text = F.coalesce("text", F.lit(""))
    found = docs.withColumn("base_spans", base_spans(text)).withColumn("wide_spans", candidates(text))
    return found.withColumn("spans", all_spans(F.col("base_spans"), F.col("wide_spans"), model)).drop("wide_spans")


def redacted(text: Column, spans: Column) -> Column:
    """The text with ``<KIND>`` in place of each span; of overlapping ones the earliest gives the name."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind"))))
    name = lambda x: F.element_at(F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS)), x["kind"] + 1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    parts = F.aggregate(ordered, start, lambda a, x: F.struct(
        F.greatest(a["at"], x["stop"]).alias("at"),
        F.when(x["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(
            F.substring(text, a["at"] + 1, x["start"] - a["at"]), name(x)))).alias("out")))
    joined = F.concat(F.array_join(parts["out"], ""), F.substring(text, parts["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, joined).otherwise(text)


def listed(spans: Column) -> Column:
    """``kind:start:stop``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["stop"].cast("string"))), ",")

"""Personal data by candidates and boosted trees, in DataFrame functions.

Four base patterns find what is certain.  Beside them looser patterns propose
candidates, which may overlap; features of a candidate's format and of the
characters around it are small whole numbers, so the corpus is summed up by a
table of at most ``CELLS`` feature combinations.  Trees are boosted on that
table on the driver and written out as CASE expressions; isotonic calibration
on other documents gives each kind the score from which on a candidate counts.

Positions come from splitting the text at marked matches and adding up lengths,
so every pattern passes once over the text.  Patterns are written with
possessive quantifiers where nothing can follow: no backtracking, and no stack
that grows with a run of digits.  The plan that scores is narrow.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
MARK, OTHER = "\x01", "\x02"
LOCAL = "[A-Za-z0-9._%+-]"

#: The base patterns.  A match of one of them can only begin where its run of characters begins or where the last match ended.
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What proposes candidates: the same with written-out signs, other separators, or no plus sign.
LOOSE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:(?:\.|\[\.\])[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20._/-][0-9]++)*+",
    "phone": r"(?<![0-9])(?:\+|\(|00)?[0-9][\x20()./0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9]\]?\.", "card": "[0-9]", "phone": "[0-9]"}
#: Words that announce a kind, in the languages at hand.
HINTS = {
    "email": r"(?i)mail|contact|write|address|correo|schreib|courriel",
    "ip": r"(?i)\bip\b|host|server|address|adresse",
    "card": r"(?i)card|visa|credit|carte|tarjeta|karte",
    "phone": r"(?i)phone|call|tel|mobile|fax|rufen|appel|llama",
}
OCTET = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"
BLOCK = 256


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda x, y: x + y)


def _blocks(numbers: Column) -> Column:
    return F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int"))


def running_starts(docs: DataFrame, cut: str, into: str) -> DataFrame:
    """For each piece the length of those before it, by blocks, so that a text
    with very many matches costs little more than their number.  Each step is
    a column of its own, and no column that is used once stands inside a lambda:
    the optimiser would put its expression there, to be computed per element."""
    lengths, sums, opens = f"{into}_lengths", f"{into}_sums", f"{into}_opens"
    docs = docs.withColumn(lengths, F.transform(cut, F.length))
    docs = docs.withColumn(sums, F.transform(_blocks(F.col(lengths)), lambda b: _total(F.slice(lengths, b * BLOCK + 1, BLOCK))))
    docs = docs.withColumn(opens, F.transform(sums, lambda _, b: _total(F.slice(sums, F.lit(1), b))))
    return docs.withColumn(into, F.flatten(F.transform(opens, lambda o, b: F.transform(
        F.slice(lengths, b * BLOCK + 1, BLOCK), lambda _, i: o + _total(F.slice(lengths, b * BLOCK + 1, i)))))).drop(lengths, sums, opens)


def pieces(text: Column, kind: str, pattern: str) -> Column:
    """The text cut at the matches: every second element is one."""
    plain = F.translate(text, MARK, OTHER)  # neither is part of any pattern
    marked = F.when(plain.rlike(NEEDS[kind]), F.regexp_replace(plain, pattern, f"{MARK}$0{MARK}")).otherwise(plain)
    return F.split(marked, MARK, -1)


def spans(cut: Column, starts: Column, kind: str) -> Column:
    """Structs (kind, rank, start, end, value, before, after) of the matches."""
    rank = KINDS.index(kind)
    odd = F.slice(F.sequence(F.lit(1), F.greatest(F.size(cut) - 2, F.lit(1)), F.lit(2)), F.lit(1), ((F.size(cut) - 1) / 2).cast("int"))
    return F.transform(odd, lambda i: F.struct(
        F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), F.get(starts, i).alias("start"),
        (F.get(starts, i) + F.length(F.get(cut, i))).alias("end"), F.get(cut, i).alias("value"),
        F.right(F.get(cut, i - 1), F.lit(24)).alias("before"), F.left(F.get(cut, i + 1), F.lit(1)).alias("after")))


def found(docs: DataFrame, patterns: dict[str, str], text: str, into: str) -> DataFrame:
    """Adds one array of all matches of all ``patterns``."""
    names = {k: (f"_{into}_{k}_cut", f"_{into}_{k}_at") for k in KINDS}
    docs = docs.withColumns({names[k][0]: pieces(F.coalesce(F.col(text), F.lit("")), k, patterns[k]) for k in KINDS})
    for cut, at in names.values():
        docs = running_starts(docs, cut, at)
    every = F.concat(*[spans(F.col(names[k][0]), F.col(names[k][1]), k) for k in KINDS])
    return docs.withColumn(into, every).drop(*[n for pair in names.values() for n in pair])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(s: Column) -> Column:
    """Whether a match of a kind's pattern passes that kind's test."""
    n = F.length(digits(s["value"]))
    ip = F.forall(F.split(F.regexp_replace(s["value"], r"[\[\]]", ""), r"\."), lambda p: p.rlike(OCTET))
    return (F.when(s["kind"] == "email", True).when(s["kind"] == "ip", ip)
            .when(s["kind"] == "card", n.between(12, 19) & F.call_function("luhn_check", F.when(n.between(12, 19), digits(s["value"])).otherwise(F.lit("1"))))
            .otherwise(n.between(9, 15)))


def certain(s: Column) -> Column:
    """Whether a candidate is itself a valid match of its kind's base pattern."""
    full = F.lit(False)
    for kind in KINDS:
        body = BASE[kind].replace(rf"(?:\G|(?<!{LOCAL}))", "").replace("(?<![0-9])", "")
        full = F.when(s["kind"] == kind, s["value"].rlike(f"^(?:{body})$")).otherwise(full)
    return full & valid(s)


def sound(s: Column) -> Column:
    """Whether a candidate passes its kind's test; of an email, that its last label can be a top-level domain."""
    return F.when(s["kind"] == "email", s["value"].rlike(r"(?:\.|\)\x20?|\]\x20?)[A-Za-z][A-Za-z0-9-]*[A-Za-z0-9]$")).otherwise(valid(s))


def rewritten(s: Column) -> Column:
    """A certain span as it is and in the loose forms of its kind, where it stands."""
    v = s["value"]
    bare = F.regexp_replace(v, r"^\+", "")
    forms = (F.when(s["kind"] == "email", F.array(
        v, F.regexp_replace(v, "@", " (at) "), F.regexp_replace(F.regexp_replace(v, r"\.(?=[^@]*$)", " (dot) "), "@", " (at) ")))
        .when(s["kind"] == "ip", F.array(v, F.regexp_replace(v, r"\.", "[.]"), F.regexp_replace(v, r"\.([0-9]+)$", "[.]$1")))
        .when(s["kind"] == "card", F.array(v, F.regexp_replace(v, r"[\x20-]", "."), F.regexp_replace(v, r"[\x20-]", "_")))
        .otherwise(F.array(v, bare, F.concat(F.lit("00"), bare), F.regexp_replace(bare, r"[\x20().-]+", "."))))
    return F.filter(F.transform(forms, lambda form: F.struct(*[
        (form if name == "value" else s[name]).alias(name) for name in ("kind", "rank", "start", "end", "value", "before", "after")])), sound)


def overlap(s: Column, t: Column) -> Column:
    return (s["start"] < t["end"]) & (t["start"] < s["end"])


#: Features and the number of their values.  None tells how many digits there are: counterexamples have too few or too many, and
#: the trees would learn that test again instead of the context.
FEATURES = {"kind": 4, "left": 3, "right": 2, "hint": 2, "groups": 3, "spelled": 2}
CELLS = math.prod(FEATURES.values())


def features(s: Column) -> list[Column]:
    hint = F.lit(False)
    for kind in KINDS:
        hint = F.when(s["kind"] == kind, s["before"].rlike(HINTS[kind])).otherwise(hint)
    last = F.right(s["before"], F.lit(1))
    gaps = F.length(F.regexp_replace(s["value"], "[0-9A-Za-z]", ""))
    columns = {
        "kind": s["rank"],
        "left": F.when(last.rlike("[0-9A-Za-z]"), 2).when(last.rlike(r"[\s(\[<:\"']"), 0).when(last == "", 0).otherwise(1),
        "right": s["after"].rlike("[0-9A-Za-z@]").cast("int"), "hint": hint.cast("int"),
        "groups": F.when(gaps == 0, 0).when(gaps <= 5, 1).otherwise(2),
        "spelled": s["value"].rlike(r"at[)\]]|dot[)\]]|\[\.\]").cast("int"),
    }
    return [columns[name].alias(name) for name in FEATURES]


@dataclass
class Boosted:
    """Trees as (feature, cut, feature, cut, four values), and what a kind's score must reach."""

    trees: list[tuple] = field(default_factory=list)
    base: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, x: dict) -> float:
        return self.base + sum(v[2 * (x[a] > i) + (x[b] > j)] for a, i, b, j, v in self.trees)

    def column(self, x: Column) -> Column:
        total = F.lit(self.base)
        for a, i, b, j, v in self.trees:
            second = lambda k: F.when(x[b] > j, v[k + 1]).otherwise(v[k])  # noqa: B023, E731
            total = total + F.when(x[a] > i, second(2)).otherwise(second(0))
        return total


def boost(cells: list[dict], rounds: int = 20, rate: float = 0.4) -> Boosted:
    """Logistic boosting of trees with two cuts over the cells (``yes`` and
    ``no`` counts); few cells, so each round tries every pair of cuts."""
    yes, no = sum(c["yes"] for c in cells), sum(c["no"] for c in cells)
    model = Boosted(base=math.log((yes + 1) / (no + 1)))
    cuts = [(f, i) for f, n in FEATURES.items() for i in range(n - 1) if len({c[f] > i for c in cells}) > 1]
    scores = [model.base] * len(cells)
    for _ in range(rounds if cuts else 0):
        gradients = []
        for c, s in zip(cells, scores):
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, s))))
            n = c["yes"] + c["no"]
            gradients.append((c["yes"] - n * p, max(n * p * (1 - p), 1e-9)))
        best = None
        for m, (a, i) in enumerate(cuts):
            for b, j in cuts[m:]:
                g, h = [0.0] * 4, [1.0] * 4
                for c, (dg, dh) in zip(cells, gradients):
                    leaf = 2 * (c[a] > i) + (c[b] > j)
                    g[leaf] += dg
                    h[leaf] += dh
                gain = sum(x * x / y for x, y in zip(g, h))
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, (a, i, b, j, [round(rate * x / y, 6) for x, y in zip(g, h)]))
        model.trees.append(best[1])
        a, i, b, j, v = best[1]
        scores = [s + v[2 * (c[a] > i) + (c[b] > j)] for c, s in zip(cells, scores)]
    return model


def calibrate(model: Boosted, cells: list[dict], precision: float, least: int) -> None:
    """Isotonic precision over the score per kind; the threshold is the lowest
    score whose calibrated precision is high enough.  A kind with fewer than
    ``least`` examples, or none of whose scores is precise enough by itself,
    takes the calibration of all kinds together."""
    pooled = _least_score(model, cells, precision)
    for rank, kind in enumerate(KINDS):
        own = [c for c in cells if c["kind"] == rank]
        alone = _least_score(model, own, precision) if sum(c["yes"] for c in own) >= least else None
        threshold = pooled if alone is None else alone
        if threshold is not None:
            model.thresholds[kind] = threshold


def _least_score(model: Boosted, cells: list[dict], precision: float) -> float | None:
    pools: list[list[float]] = []
    for s, yes, no in sorted((model.score(c), c["yes"], c["no"]) for c in cells):
        pools.append([s, yes, yes + no])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, y, n = pools.pop()
            pools[-1][1] += y
            pools[-1][2] += n
    good = [s for s, y, n in pools if n and y / n >= precision]
    return good[0] - 1e-9 if good else None


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", precision: float = 0.98, least: int = 50) -> Boosted:
    """Trees from the candidates of all documents, summed up to at most 2 *
    ``CELLS`` rows: by the hash of id and text half of the documents train, half
    calibrate.  Certain spans are examples of their kind, as they are and
    rewritten in its loose forms; candidates that fail their kind's test and
    overlap no certain span of it are counterexamples.  Candidates that pass
    without being certain are neither: they are what the scores decide."""
    h = F.pmod(F.xxhash64(doc_id, text), F.lit(1 << 30))
    # explode_outer: a plain explode filters on its array, and the filter is pushed below the steps that make it
    rows = found(docs.select(text, F.pmod(h, F.lit(2)).alias("_fold")), LOOSE, text, "_c")
    rows = rows.withColumn("_sure", F.filter("_c", certain))
    rows = rows.withColumn("_wrong", F.filter("_c", lambda s: ~sound(s) & ~F.exists("_sure", lambda t: (t["kind"] == s["kind"]) & overlap(s, t))))
    rows = rows.withColumn("_s", F.concat(
        F.transform(F.flatten(F.transform("_sure", rewritten)), lambda s: F.struct(s.alias("s"), F.lit(True).alias("yes"))),
        F.transform("_wrong", lambda s: F.struct(s.alias("s"), F.lit(False).alias("yes")))))
    one = rows.select("_fold", F.explode_outer("_s").alias("e")).where("e IS NOT NULL").select("_fold", F.col("e.yes").alias("_yes"), *features(F.col("e.s")))
    cells = one.groupBy("_fold", *FEATURES).agg(
        F.count_if("_yes").alias("yes"), F.count_if(~F.col("_yes")).alias("no")).collect()  # at most 2 * CELLS rows
    model = boost([r.asDict() for r in cells if r["_fold"] == 0])
    calibrate(model, [r.asDict() for r in cells if r["_fold"] == 1], precision, least)
    return model


def find_spans(docs: DataFrame, model: Boosted, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of structs (kind, rank,
    start, end) by start, then kind; code points, end exclusive.

    Spans of the base patterns that pass their tests always stay; candidates
    that are not among them, score high enough and overlap none of them are
    added.  NULL and empty texts have empty arrays; equal rows get equal arrays.
    Columns called ``base_spans`` or ``spans`` are replaced, others pass through
    whatever they are called.  Texts of any length are read whole.
    """
    def narrow(a: Column) -> Column:
        return F.array_sort(F.transform(a, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])))

    given = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("kept"), F.col(f"`{text}`").alias("text"))
    rows = found(given, BASE, "text", "_b").withColumn("_b", F.filter("_b", valid))
    extra = F.filter("_b", lambda _: F.lit(False))
    if model.thresholds:
        rows = found(rows, {k: LOOSE[k] for k in KINDS}, "text", "_l")
        enough = lambda s, score: F.coalesce(*[
            F.when(s["kind"] == k, score >= t) for k, t in model.thresholds.items()], F.lit(False))
        open_ = F.filter("_l", lambda s: sound(s) & ~certain(s))
        scored = F.transform(open_, lambda s: F.struct(s.alias("s"), F.struct(*features(s)).alias("x")))
        chosen = F.transform(F.filter(scored, lambda c: enough(c["s"], model.column(c["x"]))), lambda c: c["s"])
        extra = F.filter(chosen, lambda s: ~F.exists("_b", lambda b: overlap(s, b)))
    names = [(f"kept.c{i}", c) for i, c in enumerate(docs.columns) if c not in ("base_spans", "spans")]
    return rows.select(*[F.col(at).alias(c) for at, c in names], narrow(F.col("_b")).alias("base_spans"), narrow(F.array_union(F.col("_b"), extra)).alias("spans"))


def as_text(found_spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(found_spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(rows: DataFrame, text: str = "text") -> DataFrame:
    """Replaces each span of ``spans`` by its kind in brackets; where spans
    overlap, the part that an earlier one covers is not repeated."""
    ends = lambda k: F.coalesce(F.array_max(F.transform(F.slice("spans", F.lit(1), k), lambda s: s["end"])), F.lit(0))
    part = F.transform(F.sequence(F.lit(0), F.size("spans")), lambda k: F.concat(
        F.coalesce(F.col(text).substr(ends(k) + 1, F.greatest(F.lit(0), F.coalesce(F.get("spans", k)["start"], F.length(text)) - ends(k))), F.lit("")),
        F.coalesce(F.concat(F.lit("["), F.upper(F.get("spans", k)["kind"]), F.lit("]")), F.lit(""))))
    return rows.withColumn(text, F.when(F.col(text).isNotNull(), F.array_join(part, "")))

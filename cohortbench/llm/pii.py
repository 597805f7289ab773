"""Personal data by weak supervision, in DataFrame functions only.

Base spans follow fixed patterns and checks. Wider patterns propose further spans. Labelers (pattern,
gazetteer and context) vote on every candidate; expectation-maximisation over the counts of equal
votes estimates how reliable each labeler is; a classifier trained on the resulting probabilities
decides which of the proposed spans count. Base spans always do.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortbench.llm.common import as_row, columns_of, text_of

KINDS = ("email", "ip", "card", "phone")

# The base patterns, written so that a long run of fitting characters is passed over once: possessive
# where nothing can be given back, and not begun inside a run that has just failed as a whole.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Wider patterns: spelt-out addresses, eight-part ip addresses, unbroken runs of card length, and
# numbers that are grouped like a phone number.
WIDE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?[(\[]at[)\]]\x20?[a-z0-9-]{1,63}+"
             r"(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[a-z0-9-]{1,63}+)++",
    "ip": r"(?<![0-9A-Fa-f:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:.])",
    "card": r"(?<![0-9])[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{3,4}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+(])(?:\([0-9]{3}\)\x20?|00[0-9]{1,3}[\x20-]|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
}

#: A text without these can't hold a candidate of the kind.
NEEDS = {"email": "(?i)@|[(\\[]at[)\\]]", "ip": "[0-9A-Fa-f]", "card": "[0-9]", "phone": "[0-9]"}

IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"

# Gazetteers: fixed lists of common endings, prefixes and reserved ranges.
GAZETTEER = {
    "email": r"(?i)\b(?:com|net|org|edu|gov|info|io|co|de|fr|es|uk|eu|us|ch|at|it|nl)$",
    "ip": r"^(?!0*(?:0|127|22[4-9]|2[3-5][0-9])\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^(?:\+|00|\()",
}

#: Words that speak for a kind when they stand shortly before the span, and those that speak against any.
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|from|to|cc|kontakt|correo|courriel)\b[^\n]{0,20}$",
    "ip": r"(?i)\b(?:ip|host|server|address|adresse|login|from)\b[^\n]{0,20}$",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|karte|carte|tarjeta|pay(?:ment)?)\b[^\n]{0,20}$",
    "phone": r"(?i)\b(?:tel|phone|call|mobile|fax|cell|telefon|appel|llame)\b[^\n]{0,20}$",
}
AGAINST = r"(?i)(?:\b(?:version|ver|release|order|invoice|isbn|issn|doi|serial|sku|token|id|no|nr|page)\b[^\n]{0,10}|[=#v/_\"'])$"

#: Characters before a span that context labelers see.
LOOK_BACK = 40

#: The labelers, and how often each is taken to be right before any vote is seen.
LABELERS = {"pattern": 0.7, "check": 0.99, "gazetteer": 0.65, "context": 0.9, "against": 0.8, "edges": 0.6}

#: Labelers that apply a kind's own definition, such as the Luhn check: not estimated anew, so that
#: others which often agree with each other can't outvote the definition.
ANCHORS = ("check",)

#: Votes that this belief is worth.
BELIEF = 20.0


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of 1 to 40 digits passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def base_check(kind: str, text: Column) -> Column:
    """Whether a match of the base pattern is a span."""
    digits = _digits(text)
    n = F.length(digits)
    if kind == "ip":
        return F.rlike(text, F.lit(IP_PARTS))
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(F.when(n.between(14, 19), digits).otherwise("0"))).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


SPANS = "array<struct<start:int,end:int,span:string>>"


def located(gaps: Column, matches: Column) -> Column:
    """array<struct<start, end, span>> of the matches, given the text between them.

    A match begins where the lengths before it end. Positions are code points from 0, the end exclusive.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gap"])
        stop = begin + F.length(pair["span"])
        one = F.struct(begin.alias("start"), stop.alias("end"), pair["span"].alias("span"))
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches,
                       lambda g, m: F.struct(g.alias("gap"), m.alias("span")))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def votes(kind: str, text: Column, span: Column) -> list[Column]:
    """-1, 0 or 1 of each labeler, on a span of the kind with start, end and span."""
    before = F.substring(text, F.greatest(span["start"] - LOOK_BACK, F.lit(0)) + 1,
                         F.least(span["start"], F.lit(LOOK_BACK)))
    last, after = F.substring(before, -1, 1), F.substring(text, span["end"] + 1, F.lit(1))
    word = "[A-Za-z0-9@_/\\\\=]"
    whole = F.rlike(span["span"], F.lit("^(?:" + BASE[kind] + ")$"))
    digits = _digits(span["span"])
    yes, no = F.lit(1), F.lit(-1)
    if kind == "card":
        fit = F.length(digits).between(14, 19)
        check = F.when(fit, F.when(_luhn(F.when(fit, digits).otherwise("0")), yes).otherwise(no)).otherwise(no)
    elif kind == "phone":
        check = F.when(F.length(digits).between(10, 15), yes).otherwise(no)
    elif kind == "ip":
        check = F.when(F.contains(span["span"], F.lit(":")) | base_check("ip", span["span"]), yes).otherwise(no)
    else:
        check = F.when(F.length(span["span"]) <= 254, yes).otherwise(no)
    return [
        F.when(whole, yes).otherwise(F.lit(0)),
        check,
        F.when(F.rlike(F.regexp_replace(span["span"], "[)\\]]$", ""), F.lit(GAZETTEER[kind])), yes).otherwise(no),
        F.when(F.rlike(before, F.lit(CONTEXT[kind])), yes).otherwise(F.lit(0)),
        F.when(F.rlike(before, F.lit(AGAINST)), no).otherwise(F.lit(0)),
        F.when(F.rlike(last, F.lit(word)) | F.rlike(after, F.lit(word)), no).otherwise(yes),
    ]


def with_candidates(df: DataFrame) -> DataFrame:
    """Adds __cands to a table with __text: array<struct<start, end, kind, base, votes, size>>.

    Base spans, and wider candidates that touch none of them. kind is the place in KINDS; size, a
    feature of the classifier, is the length in steps of 8, up to 4. The steps are columns of their
    own, so that each pattern goes over a text once for its matches, and once for the gaps if it has any.
    """
    named = [(f"__{kind}_{sort}", kind, i, patterns[kind], sort == "base")
             for sort, patterns in (("base", BASE), ("wide", WIDE)) for i, kind in enumerate(KINDS)]
    text = F.col("__text")
    none = F.array().cast("array<string>")
    df = df.withColumns({name: F.when(F.rlike(text, F.lit(NEEDS[kind])), F.regexp_extract_all(
        text, F.lit(pattern), F.lit(0))).otherwise(none) for name, kind, _, pattern, _ in named})
    df = df.withColumns({f"{name}_gaps": F.when(F.size(name) > 0, F.split(text, pattern, -1))
                         for name, _, _, pattern, _ in named})
    df = df.withColumns({name: F.when(F.size(name) > 0, located(F.col(f"{name}_gaps"), F.col(name))).otherwise(
        F.array().cast(SPANS)) for name, *_ in named})

    def described(name: str, kind: str, i: int, is_base: bool) -> Column:
        spans = F.col(name)
        if is_base:
            spans = F.filter(spans, lambda s: base_check(kind, s["span"]))
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(i).alias("kind"), F.lit(is_base).alias("base"),
            F.array(*votes(kind, text, s)).alias("votes"),
            F.least(F.floor((s["end"] - s["start"]) / 8), F.lit(4)).cast("int").alias("size")))

    for sort in (True, False):
        df = df.withColumn("__fixed" if sort else "__wider", F.concat(
            *[described(name, kind, i, is_base) for name, kind, i, _, is_base in named if is_base == sort]))
    free = F.filter("__wider", lambda s: ~F.exists(
        F.col("__fixed"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    df = df.withColumn("__cands", F.concat("__fixed", free))
    return df.drop("__fixed", "__wider", *[n for name, *_ in named for n in (name, f"{name}_gaps")])


@dataclass(frozen=True)
class Model:
    """Weights of the span classifier: bias, one for each labeler's yes and no, kind and size step."""

    bias: float
    yes: tuple[float, ...]
    no: tuple[float, ...]
    kind: tuple[float, ...]
    size: tuple[float, ...]

    def features(self, kind: int, votes: tuple[int, ...], size: int) -> float:
        total = self.bias + self.kind[kind] + self.size[size]
        return total + sum(self.yes[j] * (v > 0) + self.no[j] * (v < 0) for j, v in enumerate(votes))

    def keeps(self, span: Column) -> Column:
        """Whether the classifier gives the span at least one half."""
        known = F.array(*[F.lit(x) for x in self.kind]), F.array(*[F.lit(x) for x in self.size])
        total = F.lit(self.bias) + F.get(known[0], span["kind"]) + F.get(known[1], span["size"])
        for j, (y, n) in enumerate(zip(self.yes, self.no, strict=True)):
            vote = F.get(span["votes"], F.lit(j))
            total = total + F.when(vote > 0, F.lit(y)).when(vote < 0, F.lit(n)).otherwise(F.lit(0.0))
        return total >= 0


Counts = dict[tuple[int, tuple[int, ...], int], int]


def reliabilities(counts: Counts, rounds: int = 50) -> tuple[dict, dict[int, float], dict]:
    """Expectation-maximisation over equal votes: (probability of each pattern, prior of each kind,
    share of correct votes of each labeler and kind).

    Starts from the beliefs in LABELERS, which also count as some votes, so that a labeler that hardly
    votes stays near them. Labelers are independent given the truth; an abstention says nothing.
    """
    belief = list(LABELERS.values())
    anchored = {j for j, name in enumerate(LABELERS) if name in ANCHORS}
    right = {(k, j): belief[j] for k in range(len(KINDS)) for j in range(len(belief))}
    prior = dict.fromkeys(range(len(KINDS)), 0.5)
    soft: dict = {}
    for _ in range(rounds):
        for k, votes, size in counts:
            odds = math.log(prior[k] / (1 - prior[k]))
            for j, v in enumerate(votes):
                odds += v * math.log(right[k, j] / (1 - right[k, j]))
            soft[k, votes, size] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        total = {key: [BELIEF * belief[key[1]], BELIEF] for key in right}
        mass = {k: [5.0, 10.0] for k in prior}
        for (k, votes, size), n in counts.items():
            p = soft[k, votes, size]
            mass[k][0] += n * p
            mass[k][1] += n
            for j, v in enumerate(votes):
                if v:
                    total[k, j][0] += n * (p if v > 0 else 1 - p)
                    total[k, j][1] += n
        right = {(k, j): belief[j] if j in anchored else min(0.97, max(0.55, a / b))
                 for (k, j), (a, b) in total.items()}
        prior = {k: min(0.99, max(0.01, a / b)) for k, (a, b) in mass.items()}
    return soft, prior, right


def train(counts: Counts, steps: int = 400, rate: float = 0.5) -> Model:
    """Logistic regression on the probabilities that expectation-maximisation gives to each pattern.

    Works on counts of equal patterns, in a fixed order, so the same counts give the same model.
    """
    soft, _, _ = reliabilities(counts)
    m, total = len(LABELERS), max(1, sum(counts.values()))
    size = 1 + 2 * m + len(KINDS) + 5
    rows = []
    for (k, votes, step), n in sorted(counts.items()):
        on = [0, *(1 + j for j, v in enumerate(votes) if v > 0), *(1 + m + j for j, v in enumerate(votes) if v < 0),
              1 + 2 * m + k, 1 + 2 * m + len(KINDS) + step]
        rows.append((on, soft[k, votes, step], n / total))
    w = [0.0] * size
    for _ in range(steps):
        grad = [1e-3 * x for x in w]
        for on, p, share in rows:
            miss = share * (1 / (1 + math.exp(-sum(w[i] for i in on))) - p)
            for i in on:
                grad[i] += miss
        w = [x - rate * g for x, g in zip(w, grad, strict=True)]
    w = [round(x, 6) for x in w]
    return Model(w[0], tuple(w[1 : 1 + m]), tuple(w[1 + m : 1 + 2 * m]),
                 tuple(w[1 + 2 * m : 1 + 2 * m + len(KINDS)]), tuple(w[-5:]))


def vote_counts(docs: DataFrame) -> Counts:
    """Rows of equal kind, votes and size over all texts: at most 4 x 3^6 x 5 of them."""
    found = with_candidates(docs.select(text_of().alias("__text"))).select(F.explode("__cands").alias("s"))
    counted = found.groupBy("s.kind", "s.votes", "s.size").agg(F.count("*").alias("n"))
    return {(r["kind"], tuple(r["votes"]), r["size"]): r["n"] for r in counted.collect()}


def _kept(model: Model) -> Column:
    """The spans of __cands that count, by start, then kind."""
    spans = F.filter("__cands", lambda s: s["base"] | model.keeps(s))
    return F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"))))


def spans_of(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """All columns of ``docs`` in __row, the text in __text, and spans: array<struct<start, kind, end, base>>.

    Sorted by start, then kind. An absent text is empty and has none; long texts are searched whole. Repeated
    rows and ids, and rows without an id, each keep their row and get equal spans. An empty table gives an empty
    result. Without a model, one is trained on the votes over all texts of ``docs``.
    """
    model = train(vote_counts(docs)) if model is None else model
    rows = with_candidates(docs.select(as_row(docs), text_of().alias("__text")))
    return rows.select("__row", "__text", _kept(model).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; n_chars, if there, follows.

    Of overlapping spans the first is replaced, together with what later ones reach beyond it. An absent
    text stays absent, an empty one empty; long texts are redacted whole. Repeated rows each stay. All columns
    stay, whatever they are called. An empty table gives an empty result.
    """
    found = spans_of(docs, model)
    text = F.col("__text")
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(s["start"] < acc["at"], F.lit("")).otherwise(F.get(names, s["kind"]))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.concat(acc["out"], F.array(gap, mark)).alias("out"))

    pieces = F.aggregate(F.col("spans"), start, step)
    whole = F.concat(F.array_join(pieces["out"], ""),
                     F.substring(text, pieces["at"] + 1, F.length(text) - pieces["at"]))
    new = F.when(F.size("spans") > 0, whole).otherwise(text)
    found = found.withColumn("__new", F.when(F.col("__row.text").isNotNull(), new))
    changed = {"text": F.col("__new")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length("__new").cast(kind)).otherwise(F.col("__row.n_chars"))
    return found.select(*[changed.get(c, old).alias(c) for c, old in zip(docs.columns, columns_of(found), strict=True)])

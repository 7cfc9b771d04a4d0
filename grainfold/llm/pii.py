"""Personal data by weak supervision: labelers vote, EM rates them, a classifier decides.

Base spans follow fixed patterns and always stay. Further candidates come from looser patterns. Every
candidate gets votes of four labelers (pattern, gazetteer, context, shape). A two-class latent
model, fitted by expectation-maximisation over the counted vote patterns, estimates how
reliable each labeler is for each kind; its posteriors are the labels on which a logistic
span classifier over votes and context features is trained. Candidates it accepts are added.

Texts are only touched by DataFrame expressions. What reaches the driver are counts of distinct vote and
feature patterns, at most 6 * 3**4 * 3 * 4 of them however large the corpus is.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.session import written

KINDS = ["email", "ip", "card", "phone", "secret", "ssn"]
BASE_KINDS = KINDS[:4]
ROUNDS = 50
ACCEPT = 0.5
CONTEXT = 24

#: Length-preserving stand-ins for a dot within a name, a separator within a number, and for
#: these two characters where a text has them itself.
DOT, JOIN, OTHER = "\ue001", "\ue000", "\ue002"

LOCAL = rf"[A-Za-z0-9._%+\-{DOT}]"
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++{DOT}[A-Za-z0-9{DOT}-]*+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = rf"(?<![0-9{JOIN}])[0-9][0-9{JOIN}]{{12,}}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
VALID_IP = rf"^{PART}\.{PART}\.{PART}\.{PART}$"

LOOSE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+"
             r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{2,63}+){1,4}",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
    "secret": r"(?i)(?<![A-Za-z0-9_])(?:password|passwd|pwd|secret|token|api[_-]?key) ?[=:] ?[^\s]{8,}+",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}

GAZETTEER = {
    "email": r"(?i)(?:\.|\bdot\W{0,2})(?:com|org|net|edu|gov|int|info|io|co|de|fr|es|uk|us|eu)$",
    "ip": r"^(?!0|10\.|127\.|169\.254\.|192\.168\.|2[3-9][0-9]\.|22[4-9]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^(?:\+(?:1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])|\(?[2-9][0-9]{2})",
    "secret": r"(?i)[=:] ?(?=[^\s]*[0-9])(?=[^\s]*[a-z])",
    "ssn": r"^(?!000|666|9)",
}

CUES = {
    "email": r"(?i)(?:mail|contact|write|reach|schreib|correo|courriel)",
    "ip": r"(?i)(?:\bip\b|host|server|address|addr|ping|from|client)",
    "card": r"(?i)(?:card|visa|master|amex|credit|konto|tarjeta|carte|pay)",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|sms|ruf|llam|appel)",
    "secret": r"(?i)(?:user|login|auth|account|config|env)",
    "ssn": r"(?i)(?:ssn|social|security|tax)",
}
AGAINST = {
    "email": r"[/@]$", "ip": r"(?i)(?:version|ver\.?|release|section|v) ?$", "card": r"(?i)(?:isbn|id|no\.?|[#.=/]) ?$",
    "phone": r"[=*/^] ?$", "secret": r"(?i)(?:example|your|<) ?$", "ssn": r"[=+*/] ?$",
}
SHAPES = {
    "email": r"^.{6,64}$", "ip": r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$", "card": r"^(?:[0-9]{13,16}|(?:[0-9]{4}[ -]){3}[0-9]{4})$",
    "phone": r"^(?=(?:[^0-9]*[0-9]){10,13}[^0-9]*$).{10,22}$", "secret": r"^.{14,80}$", "ssn": r"^.{11}$",
}


# --- candidates ---------------------------------------------------------------------------


def _places(text: Column, pattern: str, original: Column) -> Column:
    """Start, end and text of all matches, in code points, from the texts between them."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,found:string>>").alias("out"))

    def add(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["gap"])
        end = start + F.length(part["found"])
        own = F.struct(start.alias("start"), end.alias("end"), F.substring(original, start + 1, end - start).alias("found"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(own)).alias("out"))

    pairs = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)), found,
        lambda gap, own: F.struct(gap.alias("gap"), own.alias("found")),
    )
    return F.aggregate(pairs, zero, add, lambda done: done["out"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def add(done: Column, i: Column) -> Column:
        own = backwards.substr(i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return done + own - F.when(own > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add, lambda done: done % 10 == 0)


def _kept(kind: str, place: Column) -> Column:
    size = F.length(_digits(place["found"]))
    if kind == "ip":
        return place["found"].rlike(VALID_IP)
    if kind == "card":
        return F.when(size.between(13, 19), _luhn(_digits(place["found"]))).otherwise(False)
    if kind == "phone":
        return size.between(9, 15)
    return F.lit(True)


def _valid(kind: str, places: Column) -> Column:
    return F.filter(places, lambda p: _kept(kind, p))


EMPTY = "array<struct<kind:string,start:int,end:int,found:string,base:boolean>>"


def _of_kind(kind: str, places: Column, base: bool) -> Column:
    return F.transform(places, lambda p: F.struct(
        F.lit(kind).alias("kind"), p["start"].alias("start"), p["end"].alias("end"),
        p["found"].alias("found"), F.lit(base).alias("base"),
    ))


def _if(guard: Column, spans: Column) -> Column:
    return F.when(guard, spans).otherwise(F.array().cast(EMPTY))


def _base_spans(text: Column) -> Column:
    plain = F.translate(text, DOT + JOIN, OTHER + OTHER)
    dotted = F.regexp_replace(plain, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT)
    joined = F.regexp_replace(plain, r"(?<=[0-9])[\x20-](?=[0-9])", JOIN)
    of = {"email": (dotted, EMAIL, r"@[A-Za-z0-9-]"), "ip": (text, IP, r"[0-9]\.[0-9]"),
          "card": (joined, CARD, r"[0-9](?:[\x20-]?+[0-9]){12}"), "phone": (text, PHONE, r"\+[0-9]")}
    parts = []
    for kind, (source, pattern, guard) in of.items():
        places = _valid(kind, _places(source, pattern, text))
        parts.append(_if(text.rlike(guard), _of_kind(kind, places, True)))
    return F.concat(*parts)


def _loose_spans(text: Column) -> Column:
    guards = {"email": r"(?i)[(\[]at[)\]]", "phone": r"[0-9]{3}[ .-][0-9]{4}", "ssn": r"-[0-9]{2}-[0-9]{4}",
              "secret": r"(?i)(?:pass|pwd|secret|token|api)"}
    return F.concat(*(
        _if(text.rlike(guards[kind]), _of_kind(kind, _places(text, pattern, text), False))
        for kind, pattern in LOOSE.items()
    ))


def _by_kind(of: Column, patterns: dict[str, str], kind: Column) -> Column:
    chosen = F.lit(False)
    for name, pattern in patterns.items():
        chosen = F.when(kind == name, of.rlike(pattern)).otherwise(chosen)
    return chosen


def _votes(text: Column, span: Column) -> Column:
    """Votes 1 (personal data), 0 (not) and -1 (no opinion), and two context features."""
    kind, found = span["kind"], span["found"]
    from_ = F.greatest(span["start"] - CONTEXT, F.lit(0))
    before = F.substring(text, from_ + 1, span["start"] - from_)
    after = F.substring(text, span["end"] + 1, F.lit(1))
    opinion = F.when(_by_kind(before, AGAINST, kind), 0).when(_by_kind(before, CUES, kind), 1).otherwise(-1)
    edge = F.when(after == "", 0).when(after.rlike(r"^\s$"), 1).when(after.rlike(r"^\p{Punct}$"), 2).otherwise(3)
    return F.struct(
        kind.alias("kind"), span["start"].alias("start"), span["end"].alias("end"), span["base"].alias("base"),
        span["base"].cast("int").alias("pattern"),
        _by_kind(found, GAZETTEER, kind).cast("int").alias("gazetteer"),
        opinion.alias("context"),
        _by_kind(found, SHAPES, kind).cast("int").alias("shape"),
        F.when(before == "", 0).when(before.rlike(r"\s$"), 1).otherwise(2).alias("left"),
        edge.alias("right"),
    )


LABELERS = ["pattern", "gazetteer", "context", "shape"]
FEATURES = [*LABELERS, "left", "right"]


def with_candidates(docs: DataFrame) -> DataFrame:
    """Add ``candidates``: base spans and looser ones outside them, with votes and features."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.withColumn("base_spans", _base_spans(text)).withColumn("loose_spans", _loose_spans(text))
    free = F.filter("loose_spans", lambda s: ~F.exists(
        "base_spans", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])
    ))
    spans = base.withColumn("spans", F.concat("base_spans", free)).drop("base_spans", "loose_spans")
    return spans.withColumn("candidates", F.transform("spans", lambda s: _votes(text, s))).drop("spans")


# --- the label model and the span classifier ----------------------------------------------


@dataclass
class SpanModel:
    """Log-odds of each (kind, feature, value), to be added up, and the rates EM found."""

    bias: dict[str, float] = field(default_factory=dict)
    weights: dict[tuple[str, str, int], float] = field(default_factory=dict)
    rates: dict[tuple[str, str], dict] = field(default_factory=dict)


def label_model(patterns: list[dict]) -> tuple[list[float], dict]:
    """Posterior of each counted vote pattern of one kind by EM, and each labeler's vote rates.

    Labelers vote independently given the truth; rates are smoothed, and start from the
    assumption that a vote is right four times in five.
    """
    values = (-1, 0, 1)
    start = {1: {1: 0.7, 0: 0.1, -1: 0.2}, 0: {1: 0.2, 0: 0.6, -1: 0.2}}
    rates = {name: start for name in LABELERS}
    prior = 0.5
    posterior = [0.5] * len(patterns)
    for _ in range(ROUNDS):
        for i, p in enumerate(patterns):
            odds = math.log(prior / (1 - prior))
            odds += sum(math.log(rates[n][1][p[n]] / rates[n][0][p[n]]) for n in LABELERS)
            posterior[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        total = sum(p["n"] for p in patterns)
        yes = sum(p["n"] * q for p, q in zip(patterns, posterior))
        prior = (yes + 1) / (total + 2)
        # a prior of ten votes at the starting rates keeps the classes from changing places
        rates = {
            name: {
                side: {
                    v: (sum(p["n"] * (q if side else 1 - q) for p, q in zip(patterns, posterior) if p[name] == v)
                        + 10 * start[side][v]) / ((yes if side else total - yes) + 10)
                    for v in values
                }
                for side in (0, 1)
            }
            for name in LABELERS
        }
    return posterior, rates


def span_classifier(patterns: list[dict], labels: list[float]) -> tuple[float, dict]:
    """Logistic regression on one-hot features with soft labels, by gradient steps."""
    weights: dict[tuple[str, int], float] = defaultdict(float)
    bias = 0.0
    total = sum(p["n"] for p in patterns)
    for _ in range(300):
        grads: dict[tuple[str, int], float] = defaultdict(float)
        for p, label in zip(patterns, labels):
            keys = [(f, p[f]) for f in FEATURES]
            odds = bias + sum(weights[k] for k in keys)
            step = p["n"] / total * (label - 1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
            for k in keys:
                grads[k] += step
            grads["bias", 0] += step
        bias += grads.pop(("bias", 0))
        for k, g in grads.items():
            weights[k] += g - 1e-4 * weights[k]
    return bias, dict(weights)


def fit(candidates: DataFrame) -> SpanModel:
    """Fit on the candidates of all documents, as counted patterns. Runs a job."""
    rows = candidates.select(F.explode("candidates").alias("c")).select("c.*")
    counted = rows.groupBy("kind", *FEATURES).agg(F.count("*").alias("n")).orderBy("kind", *FEATURES).collect()
    model = SpanModel()
    for kind in KINDS:
        patterns = [r.asDict() for r in counted if r.kind == kind]
        if not patterns:
            continue
        labels, rates = label_model(patterns)
        model.bias[kind], weights = span_classifier(patterns, labels)
        model.weights |= {(kind, f, v): w for (f, v), w in weights.items()}
        model.rates |= {(kind, name): r for name, r in rates.items()}
    return model


def _odds(model: SpanModel, span: Column) -> Column:
    total = F.lit(0.0)
    for kind, bias in model.bias.items():
        own = F.lit(bias)
        for f in FEATURES:
            values = {v: w for (k, g, v), w in model.weights.items() if (k, g) == (kind, f)}
            part = F.lit(0.0)
            for v, w in values.items():
                part = F.when(span[f] == v, w).otherwise(part)
            own = own + part
        total = F.when(span["kind"] == kind, own).otherwise(total)
    return total


def _order(kind: Column) -> Column:
    place = F.lit(len(KINDS))
    for i, name in enumerate(KINDS):
        place = F.when(kind == name, i).otherwise(place)
    return place


def accepted(candidates: Column, model: SpanModel) -> Column:
    """Base spans and accepted others, by kind as listed and then start: order, start, end, kind, base."""
    least = math.log(ACCEPT / (1 - ACCEPT))
    chosen = F.filter(candidates, lambda c: c["base"] | (_odds(model, c) > least))
    return F.array_sort(F.transform(chosen, lambda c: F.struct(
        _order(c["kind"]).alias("order"), c["start"].alias("start"), c["end"].alias("end"),
        c["kind"].alias("kind"), c["base"].alias("base"),
    )))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_spans(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with ``spans`` added: struct order, start, end, kind, base.

    Null text counts as empty and has no spans. Whole texts are searched, in time linear in their length. Rows are
    independent once the model is fitted, so repeated rows and null ids get spans like others; a
    column named spans or candidates is replaced. Without any candidate nothing is
    fitted. Runs jobs when called.
    """
    table = written(with_candidates(docs.drop("spans", "candidates")), "candidates")
    return table.withColumn("spans", accepted(F.col("candidates"), fit(table))).drop("candidates")


def span_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, their digest, and all spans as text."""
    # the text is not needed once the candidates are known
    source = with_candidates(docs.select(F.col("doc_id").cast("long"), "text")).drop("text")
    table = written(source, "candidates")
    found = table.withColumn("spans", accepted(F.col("candidates"), fit(table)))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; n_chars follows if present.

    Overlapping spans become the mark of the first. Null texts stay null.
    """
    found = find_spans(docs)
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(done: Column, span: Column) -> Column:
        gap = F.substring(F.col("text"), done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        mark = F.when(span["start"] < done["at"], "").otherwise(F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">")))
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), F.concat(done["out"], gap, mark).alias("out"))

    end = F.lit(2**31 - 1)
    text = F.aggregate(by_start, zero, add, lambda done: F.concat(
        done["out"], F.substring(F.col("text"), done["at"] + 1, end)))
    clean = found.withColumn("text", F.when(F.size("spans") > 0, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(
            F.size("spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)

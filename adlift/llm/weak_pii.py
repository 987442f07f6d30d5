"""Personal data by weak supervision, from DataFrame functions only.

Base spans come from four exact patterns (email, ip, card, phone) and always stay. Looser
patterns propose further candidates (written-out emails, phones without a country code,
social security numbers, bank accounts, credentials, titled names). Three kinds of labelers
vote on every candidate, base ones included: the span's format, gazetteers (domains, dialling codes, issuers, reserved networks, countries,
stand-in words, given names) and the words just before it. On an added kind a labeler votes
only on what its pattern leaves open, and abstains otherwise, so that a vote that every match
would get does not outweigh the others. Expectation-maximisation over all candidates
estimates how reliable each labeler is; its posteriors then train the final span classifier, a
naive Bayes model per kind over the span's shape and surroundings, which decides on the
candidates that are not base spans. Where a kind shows no difference, its features weigh nothing.

A match's place is the summed length, in code points, of the pieces and matches before it,
from one split by the same pattern, added up over chunks and a rest. The patterns use look-behinds and possessive
quantifiers, so each scan is linear in the text and never recurses.

EM works on counts per vote pattern (at most kinds * 3^labelers rows) and the classifier
on counts per kind and feature value (a fixed set), both partial aggregates over all documents.

Null text is empty and has no spans. Spans of one kind never overlap; an added span never
overlaps a base span or an earlier added one of another kind's list. Repeated rows are
scanned one by one, empty tables give empty tables, other columns are ignored, or passed
through by :func:`redact`.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlift.llm.common import save, text_or_empty

# The base patterns of the contract, in linear-time form, in the contract's order.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A capitalised word of any script, with inner capitals and joined parts (O'Brien, McDonald, Anna-Maria).
NAME_WORD = r"(?:\p{Lu}['’])?+\p{Lu}[\p{Ll}\p{M}]++(?:['’-]?\p{Lu}[\p{Ll}\p{M}]++)*+"
# Candidates of the method, in the order their kinds are listed. Open lengths, so no span ends inside its value.
LOOSE = {
    "email_text": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++"
                  r"(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]++| ?\. ?[A-Za-z][A-Za-z0-9-]++)++",
    "phone_local": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?i:password|passwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
              r"[A-Za-z0-9_/+-]{8,}+[\"']?+",
    "name": rf"(?<!\p{{L}})(?:Mr|Mrs|Ms|Dr)\.?(?: {NAME_WORD})++",
}
KINDS = (*BASE, *LOOSE)
CONTEXT = 40
ROUNDS = 10
ACCEPT_AT = 0.5
DRAW = 8

# Gazetteers: fixed values.
TLDS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "nl", "eu")
DIAL_CODES = ("1", "33", "34", "39", "41", "43", "44", "49", "52", "55", "61", "81", "86", "91")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35|30|36|38)"
RESERVED_NETS = r"^(?:0|127|255|22[4-9]|23[0-9])\."
# Length of an account number by country.
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27,
                "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
STAND_INS = r"(?i)^(?:change[_-]?me|dummy|example|placeholder|redacted|required|sample|undefined|x{4,}|your)"
GIVEN_NAMES = ("Anna", "Carlos", "Claire", "David", "Elena", "Emma", "Hans", "Ivan", "Jean", "John", "Julia", "Karl",
               "Laura", "Maria", "Marie", "Mary", "Michael", "Paul", "Peter", "Pierre", "Robert", "Sophie", "Thomas")
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|address|kontakt|correo|courriel)[^\n]{0,20}$",
    "ip": r"(?i)(?:\bip\b|address|host|server|client|login|from)[^\n]{0,20}$",
    "card": r"(?i)(?:card|visa|credit|karte|carte|tarjeta|pay)[^\n]{0,20}$",
    "phone": r"(?i)(?:phone|call|tel|mobile|fax|telefon|appel)[^\n]{0,20}$",
    "ssn": r"(?i)(?:ssn|social|security)[^\n]{0,20}$",
    "iban": r"(?i)(?:iban|account|bank|konto|compte|cuenta)[^\n]{0,20}$",
}
COUNTER_CUES = r"(?i)(?:version|release|section|chapter|isbn|issn|order|invoice|figure|page|part no)[^\n]{0,12}$"
FAMILY = {"email_text": "email", "phone_local": "phone"}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled, its digits summed; the total ends in 0."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2).cast("int") % 10
                                             + F.when(c.cast("int") >= 5, 1).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}")
    if kind == "card":
        return _luhn(_digits(text))
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    return F.lit(True)


def _value(text: Column) -> Column:
    """What stands after a credential's key word."""
    return F.regexp_extract(text, r"[=:]\s*[\"']?([^\"']*)", 1)


def _format_vote(kind: str, text: Column) -> Column:
    """Format labeler: 1 looks right, -1 looks wrong, 0 abstains."""
    digits = _digits(text)
    one = lambda good, bad: F.when(bad, -1).when(good, 1).otherwise(0)
    if kind in ("email", "email_text"):
        return one(text.rlike(r"[A-Za-z]{2,24}$"), text.rlike(r"(?:\.\.|^[.-])"))
    if kind == "ip":
        return one(~text.rlike(r"(?:^|\.)0[0-9]"), text.rlike(r"(?:^|\.)0[0-9]"))
    if kind == "card":
        return one(F.length(digits).isin(15, 16), digits.rlike(r"^(.)\1*$"))
    if kind == "phone":
        return one(F.length(digits).between(10, 13), digits.rlike(r"^(.)\1*$"))
    if kind == "phone_local":
        return F.when(digits.rlike(r"^(?:[01]|...[01]|(.)\1*$)"), -1).otherwise(0)
    if kind == "ssn":
        return F.when(text.rlike(r"^(?:000|666|9)|-00-|-0000$"), -1).otherwise(0)
    if kind == "secret":
        value = _value(text)
        mixed = (F.length(value) >= 16) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
        return one(mixed, value.rlike(r"^(?:[A-Z]?[a-z]+|[A-Z]+)(?:[_-](?:[A-Z]?[a-z]+|[A-Z]+))*$"))
    if kind == "iban":
        return F.when(F.length(digits) < 8, -1).otherwise(0)
    return F.lit(0)


def _gazetteer_vote(kind: str, text: Column) -> Column:
    digits = _digits(text)
    if kind in ("email", "email_text"):
        return F.when(F.lower(F.regexp_extract(text, r"(?<![A-Za-z])([A-Za-z]++)\W*+$", 1)).isin(*TLDS), 1).otherwise(0)
    if kind == "ip":
        return F.when(text.rlike(RESERVED_NETS), -1).otherwise(0)
    if kind == "card":
        return F.when(digits.rlike(ISSUERS), 1).otherwise(-1)
    if kind == "phone":
        return F.when(F.left(digits, F.lit(1)).isin(*DIAL_CODES) | F.left(digits, F.lit(2)).isin(*DIAL_CODES), 1).otherwise(0)
    if kind == "secret":
        return F.when(_value(text).rlike(STAND_INS), -1).otherwise(0)
    if kind == "iban":
        length = F.length(F.replace(text, F.lit(" ")))
        known = [F.when(F.left(text, F.lit(2)) == c, F.when(length == n, 1).otherwise(-1)) for c, n in IBAN_LENGTHS.items()]
        return F.coalesce(*known, F.lit(0))
    if kind == "name":
        return F.when(F.regexp_extract(text, r"^\S+ ([\p{L}\p{M}]+)", 1).isin(*GIVEN_NAMES), 1).otherwise(0)
    return F.lit(0)


def _context_vote(kind: str, before: Column) -> Column:
    vote = F.when(before.rlike(COUNTER_CUES), -1)
    cue = CUES.get(FAMILY.get(kind, kind))
    return (vote.when(before.rlike(cue), 1) if cue else vote).otherwise(0)


def _edge_vote(before: Column, after: Column) -> Column:
    glued = before.rlike(r"[\p{L}0-9]$") | after.rlike(r"^[\p{L}0-9]")
    return F.when(glued, -1).otherwise(0)


LABELERS = ("format", "gazetteer", "context", "edge")


def _shape(text: Column, before: Column, after: Column) -> list[tuple[str, Column]]:
    """Features of the final classifier; each has a fixed set of values."""
    length = F.length(text)
    share = F.length(_digits(text)) / length
    edge = lambda c: (F.when(c == "", "none").when(c.rlike(r"^\s$"), "space")
                      .when(c.rlike(r"^[\p{L}0-9]$"), "word").otherwise("mark"))
    return [
        ("length", F.least(F.floor(F.log2(length.cast("double"))), F.lit(8)).cast("string")),
        ("digits", F.floor(share * 4).cast("string")),
        ("before", edge(F.right(before, F.lit(1)))),
        ("after", edge(F.left(after, F.lit(1)))),
    ]


FEATURES = ("length", "digits", "before", "after")


CHUNK = 256


def _add(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _lengths(kind: str) -> Column:
    """Per match: the length of the piece before it plus its own."""
    return F.transform(f"_m_{kind}", lambda m, i: F.length(F.element_at(F.col(f"_p_{kind}"), i + F.lit(1))) + F.length(m))


def _totals(kind: str) -> Column:
    """Sums over whole chunks of ``_lengths``, so that no place adds up more than two short stretches."""
    lens = F.col(f"_l_{kind}")
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(lens) - 1) / CHUNK).cast("int")),
                       lambda j: _add(F.slice(lens, j * CHUNK + 1, F.lit(CHUNK))))


def _of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _matches(kind: str) -> Column:
    """All valid matches of a kind in ``_text`` with place, votes and features; null if none."""
    found = F.col(f"_m_{kind}")
    pieces, lens, totals = F.col(f"_p_{kind}"), F.col(f"_l_{kind}"), F.col(f"_t_{kind}")

    def one(text: Column, i: Column) -> Column:
        chunk = F.floor(i / CHUNK).cast("int")
        start = (_add(F.slice(totals, F.lit(1), chunk))
                 + _add(F.slice(lens, chunk * CHUNK + 1, i - chunk * CHUNK + 1)) - F.length(text))
        before = F.right(F.element_at(pieces, i + F.lit(1)), F.lit(CONTEXT))
        after = F.left(F.element_at(pieces, i + F.lit(2)), F.lit(CONTEXT))
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(text)).alias("end"),
            _valid(kind, text).alias("valid"),
            *[v.cast("tinyint").alias(k) for k, v in zip(LABELERS, (
                _format_vote(kind, text), _gazetteer_vote(kind, text), _context_vote(kind, before),
                _edge_vote(before, after)))],
            *[v.alias(f"f_{k}") for k, v in _shape(text, before, after)])

    return F.when(F.size(found) > 0, F.filter(F.transform(found, one), lambda s: s["valid"]))


SPAN = ("array<struct<kind:string,start:int,end:int,valid:boolean,format:tinyint,gazetteer:tinyint,context:tinyint,"
        "edge:tinyint,f_length:string,f_digits:string,f_before:string,f_after:string>>")


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _chunks(size: Column) -> Column:
    return F.sequence(F.lit(0), F.floor((size - 1) / CHUNK).cast("int"))


def _stretches(spans: Column) -> Column:
    """Spans by start, in stretches of ``CHUNK`` with the place each stretch covers; empty for none."""
    def cut(places: Column) -> Column:
        def one(j: Column) -> Column:
            return _bound(F.slice(places, j * CHUNK + 1, F.lit(CHUNK)), lambda own: F.struct(
                own.alias("own"), own[0]["start"].alias("start"), F.array_max(F.transform(own, lambda s: s["end"])).alias("end")))

        return F.when(F.size(places) > 0, F.transform(_chunks(F.size(places)), one))

    return _bound(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))), cut)


def _meets(stretches: Column, s: Column) -> Column:
    """Whether a span overlaps one of them: looked for in the stretches around it alone."""
    overlap = lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"])
    return F.coalesce(F.exists(stretches, lambda c: overlap(c) & F.exists(c["own"], overlap)), F.lit(False))


def _clear(b: Column) -> Column:
    return F.filter(b["own"], lambda s: ~_meets(b["taken"], s))


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``_base`` and ``_more``: arrays of base spans and further candidates."""
    df = docs.withColumn("_text", text_or_empty())
    patterns = {**BASE, **LOOSE}
    found = {k: F.regexp_extract_all("_text", F.lit(p), F.lit(0)) for k, p in patterns.items()}
    df = df.withColumns({f"_m_{k}": c for k, c in found.items()})
    some = lambda k: F.size(f"_m_{k}") > 0
    df = df.withColumns({f"_p_{k}": F.when(some(k), F.split("_text", p, -1)) for k, p in patterns.items()})
    df = df.withColumns({f"_l_{k}": F.when(some(k), _lengths(k)) for k in patterns})
    df = df.withColumns({f"_t_{k}": F.when(some(k), _totals(k)) for k in patterns})
    df = df.withColumns({f"_s_{k}": F.coalesce(_matches(k).cast(SPAN), F.array().cast(SPAN))
                         for k in patterns})
    df = df.withColumn("_base", F.concat(*[f"_s_{k}" for k in BASE]))
    df = df.withColumn("_more", F.array().cast(SPAN))
    for k in LOOSE:
        own = F.col(f"_s_{k}")
        clear = _bound(F.struct(own.alias("own"), _stretches(F.concat("_base", "_more")).alias("taken")), _clear)
        df = df.withColumn("_more", F.when(F.size(own) > 0, F.concat("_more", clear)).otherwise(F.col("_more")))
    return df.select(*docs.columns, "_text", "_base", "_more")


@dataclass(frozen=True)
class PiiModel:
    """EM's labeler reliabilities and the classifier's log odds."""

    reliability: dict[str, float]
    prior: dict[str, float]
    log_odds: dict[tuple[str, str, str], float] = field(default_factory=dict)

    def label_score(self, span) -> Column:
        """Log odds from the votes alone."""
        score = F.lit(0.0)
        for kind in KINDS:
            p = self.prior.get(kind, 0.5)
            score = score + F.when(span("kind") == kind, math.log(p / (1 - p))).otherwise(0.0)
        for k in LABELERS:
            r = self.reliability[k]
            score = score + span(k).cast("double") * math.log(r / (1 - r))
        return score

    def span_score(self, span) -> Column:
        """Log odds of the final classifier: kind, votes and shape together."""
        score = self.label_score(span)
        if self.log_odds:
            table = F.create_map(*[F.lit(x) for k, w in self.log_odds.items() for x in (":".join(k), w)])
            for f in FEATURES:
                key = F.concat_ws(":", span("kind"), F.lit(f), span(f"f_{f}"))
                score = score + F.coalesce(F.try_element_at(table, key), F.lit(0.0))
        return score


def _probability(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def _em(patterns: DataFrame, rounds: int) -> tuple[dict[str, float], dict[str, float]]:
    """(labeler reliabilities, share of personal data per kind) from ``kind, <labelers>, n``.

    All rounds are one expression over the pattern table as a one-row array.
    """
    number = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)]), F.col("kind"))
    table = patterns.select(F.struct(F.col("n").cast("double").alias("n"), number.alias("k"),
                                     F.array(*[F.col(k).cast("int") for k in LABELERS]).alias("v")).alias("s"))
    table = table.groupBy().agg(F.collect_list("s").alias("rows"))
    start = F.struct(F.array(*[F.lit(0.75)] * len(LABELERS)).alias("r"), F.array(*[F.lit(0.7)] * len(KINDS)).alias("p"))
    each = lambda names: F.sequence(F.lit(0), F.lit(len(names) - 1))

    def posterior(s: Column, m: Column) -> Column:
        prior = m["p"][s["k"]]
        return _probability(F.aggregate(each(LABELERS), F.log(prior / (1 - prior)),
                                        lambda a, r: a + s["v"][r] * F.log(m["r"][r] / (1 - m["r"][r]))))

    def share(scored: Column, first: float, hit, of, low: float, high: float) -> Column:
        sums = F.aggregate(scored, F.struct(F.lit(first).alias("hit"), F.lit(1.0).alias("of")), lambda a, x: F.struct(
            (a["hit"] + x["n"] * hit(x)).alias("hit"), (a["of"] + x["n"] * of(x)).alias("of")))
        return F.least(F.lit(high), F.greatest(F.lit(low), sums["hit"] / sums["of"]))

    def maximise(scored: Column) -> Column:
        right = lambda r: share(
            scored, 0.75, lambda x: F.when(x["v"][r] == 1, x["p"]).when(x["v"][r] == -1, 1 - x["p"]).otherwise(0.0),
            lambda x: F.when(x["v"][r] != 0, 1.0).otherwise(0.0), 0.55, 0.99)
        personal = lambda k: share(
            scored, 0.7, lambda x: F.when(x["k"] == k, x["p"]).otherwise(0.0),
            lambda x: F.when(x["k"] == k, 1.0).otherwise(0.0), 0.05, 0.95)
        return F.struct(F.transform(each(LABELERS), right).alias("r"), F.transform(each(KINDS), personal).alias("p"))

    def step(m: Column, _round: Column) -> Column:
        scored = F.transform("rows", lambda s: F.struct(s["n"], s["k"], s["v"], posterior(s, m).alias("p")))
        return F.transform(F.array(scored), maximise)[0]  # binds the scored rows once

    m = table.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("m")).first()["m"]
    return dict(zip(LABELERS, m["r"])), dict(zip(KINDS, m["p"]))


def learn(spans: DataFrame, rounds: int = ROUNDS) -> PiiModel:
    """Fit on a table ``kind, <labelers>, f_<features>`` with one row per candidate.

    Reliabilities start at 0.75 and stay within 0.55..0.99, a kind's share of personal
    data starts at 0.7 and stays within 0.05..0.95, so labelers cannot swap sense.
    """
    patterns = save(spans.groupBy("kind", *LABELERS, *[f"f_{f}" for f in FEATURES]).agg(F.count("*").alias("n")),
                    "pii-patterns")
    model = PiiModel(*_em(patterns.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")), rounds))
    scored = patterns.withColumn("p", _probability(model.label_score(F.col)))
    both = scored.select("n", "p", "kind", F.explode(F.array(*[
        F.struct(F.lit(f).alias("name"), F.col(f"f_{f}").alias("value")) for f in FEATURES])).alias("f"))
    # The fixed value sets bound this table to a few dozen rows per kind.
    weights = both.where("f.value is not null").groupBy("kind", "f.name", "f.value").agg(
        F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")).collect()
    yes, no = Counter(), Counter()
    for w in weights:
        yes[w["kind"], w["name"]] += w["yes"]
        no[w["kind"], w["name"]] += w["no"]
    odds = {}
    for w in sorted(weights, key=lambda w: (w["kind"], w["name"], w["value"])):
        y, n = yes[w["kind"], w["name"]], no[w["kind"], w["name"]]
        # Both classes are drawn towards the value's share among all of the kind, so a class
        # without examples tells nothing.
        own = DRAW * (w["yes"] + w["no"]) / (y + n)
        odds[w["kind"], w["name"], w["value"]] = math.log((w["yes"] + own) / (y + DRAW)) - math.log((w["no"] + own) / (n + DRAW))
    return PiiModel(model.reliability, model.prior, odds)


def _accepted(model: PiiModel) -> Column:
    return F.filter("_more", lambda s: _probability(model.span_score(lambda k: s[k])) >= ACCEPT_AT)


def _candidates(scanned: DataFrame) -> DataFrame:
    spans = scanned.select(F.explode(F.concat("_base", "_more")).alias("s"))
    return spans.select("s.kind", *[f"s.{k}" for k in LABELERS], *[f"s.f_{f}" for f in FEATURES])


def _listing(spans: str) -> Column:
    """``kind:start:end`` of each span, by kind as listed, then start; comma-joined."""
    def listed(kind: str) -> Column:
        places = F.array_sort(F.transform(_of_kind(spans, kind), lambda s: F.struct(s["start"], s["end"])))
        return F.transform(places, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    names = F.concat(*[listed(k) for k in KINDS])
    return F.array_join(names, ",")


def find(docs: DataFrame) -> DataFrame:
    """Per document: counts of base spans, ``base`` and ``spans`` listings, one row per row."""
    scanned = save(scan(docs.select("doc_id", "text")).select("doc_id", "_base", "_more"), "pii-spans")
    model = learn(_candidates(scanned))
    out = scanned.withColumn("_spans", F.concat("_base", _accepted(model)))
    counts = [F.size(_of_kind("_base", k)).cast("long").alias(f"n_{k}") for k in BASE]
    return out.select("doc_id", *counts, _listing("_base").alias("base"), _listing("_spans").alias("spans"))


def _mask(text: Column, spans: Column) -> Column:
    """``text`` with its spans (start, end, kind; by start) replaced, overlapping ones under the first's name.

    Stretches of ``CHUNK`` spans are masked within their own part of the text and joined
    once, so neither the output nor the way to a place is walked again for every span.
    """
    def all_of(b: Column) -> Column:
        ends = F.transform(_chunks(F.size(b["s"])), lambda j: F.array_max(
            F.transform(F.slice(b["s"], j * CHUNK + 1, F.lit(CHUNK)), lambda s: s["end"])))

        def joined(reach: Column) -> Column:
            def part(j: Column) -> Column:
                at = F.coalesce(F.array_max(F.slice(reach, F.lit(1), j)), F.lit(0))
                return _bound(at, lambda at: _bound(F.struct(
                    F.slice(b["s"], j * CHUNK + 1, F.lit(CHUNK)).alias("s"), at.alias("at"),
                    F.substr(b["t"], at + F.lit(1), F.greatest(reach[j] - at, F.lit(0))).alias("t")), filled))

            return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), F.size(reach) - 1), part), ""),
                            F.substr(b["t"], F.array_max(reach) + F.lit(1), F.length(b["t"])))

        return _bound(ends, joined)

    def filled(c: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            gap = F.substr(c["t"], acc["at"] - c["at"] + F.lit(1), F.greatest(s["start"] - acc["at"], F.lit(0)))
            mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.struct(F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, mark)).otherwise(acc["out"]).alias("out"),
                            F.greatest(s["end"], acc["at"]).alias("at"))

        return F.aggregate(c["s"], F.struct(F.lit("").alias("out"), c["at"].alias("at")), step, lambda acc: acc["out"])

    return _bound(F.struct(text.alias("t"), spans.alias("s")), all_of)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``[KIND]``; all columns, all rows.

    Overlapping spans of different kinds are masked together under the earlier one's
    name. A text without spans, null included, stays as it is. ``n_chars``, where it
    exists and a text changes, becomes the new length. Texts are scanned once: rows are
    written with their candidates, which then train the model and are judged in place.
    """
    names = docs.columns
    rest = [F.col(f"`{c}`") for c in names if c != "text"] or [F.lit(None).cast("string").alias("none")]
    rows = docs.select(F.col("text").cast("string").alias("text"), F.struct(*rest).alias("_in"))
    scanned = save(scan(rows).select("text", "_in", "_base", "_more"), "pii-rows")
    model = learn(_candidates(scanned))
    df = scanned.withColumn("_spans", F.array_sort(F.transform(
        F.concat("_base", _accepted(model)), lambda s: F.struct(s["start"], s["end"], s["kind"]))))
    changed = F.size("_spans") > 0
    df = df.withColumn("_masked", F.when(changed, _mask(F.col("text"), F.col("_spans"))).otherwise(F.col("text")))
    out = []
    for c in names:
        given = F.col("_masked") if c == "text" else F.col(f"_in.`{c}`")
        if c == "n_chars":
            given = F.when(changed, F.length("_masked")).otherwise(given).cast(docs.schema[c].dataType)
        out.append(given.alias(c))
    return df.select(*out)

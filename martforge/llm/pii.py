"""Personal data by weak supervision.

Three labelers vote on every candidate span: a *regex* labeler (strict form and
check digits), a *gazetteer* labeler (known top-level domains, card issuers,
calling codes, titles, ...) and a *context* labeler (cue words before the span).
Expectation-maximisation over the counts of vote patterns estimates how reliable
each labeler is, without labels; its posteriors then train the final span
classifier (naive Bayes over the kind, votes and shape of a span), which decides
on every candidate that is not already certain.

Base spans (strict email, ip, card and phone) always stay; the classifier adds
spans: written-out emails, national phone numbers, short cards, identity and bank
numbers, titled names and secrets.

Everything on the documents is built-in SQL. One row per document holds its
candidates, so nothing is regrouped by document; only counts by vote pattern and by
feature (both bounded by fixed vocabularies) reach the driver.

Defined cases: null text is empty; empty texts have no spans; repeated rows and null
ids are answered row by row; other columns are not read; with no candidates at all
the classifier falls back to its prior. Patterns are written so that matching is
linear in the text (possessive runs), however long a text or word is; contexts are cut from
blocks of the text, and overlaps with many base spans are found by search in sorted places.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import let, staged

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("email", "phone", "card", "ssn", "iban", "name", "secret")
CONTEXT_CHARS = 32
CHUNK = 256
#: Code points of a block of text (contexts are cut from blocks, not from the whole text), and
#: base spans from which overlaps are searched for in sorted places instead of one by one.
BLOCK, MANY = 1024, 32
LABELERS = ("regex", "gazetteer", "context")

# Fixed patterns of the base spans. A run is entered only at its start (or where
# the last match ended) and is possessive: the same leftmost matches as the plain
# forms, without quadratic retries.
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a base pattern to match.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}

# Candidate patterns of the added spans (fixed values). Each ends at an edge of its own:
# a secret is a whole run whatever its length, a name ends where its letters do.
EDGE_BEFORE = r"(?<![A-Za-z0-9_@+])"
EDGE_AFTER = r"(?![A-Za-z0-9_@])"
TITLE = r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Señor|Señora)\.? "
NAME = r"\p{Lu}[\p{Ll}\p{M}]++"
SECRET = r"[A-Za-z0-9_/+-]"
EXTRA = {
    "email": r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{1,63}){1,4}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"\(?[0-9]{3,5}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}",
    "card": r"[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,3}",
    "name": rf"(?<!\p{{L}}){TITLE}{NAME}(?: {NAME})?(?![\p{{L}}\p{{M}}0-9_@])",
    "secret": rf"AKIA[A-Z0-9]{{16}}{EDGE_AFTER}"
              rf"|(?:password|passwd|token|secret|api_key|apikey) ?[=:] ?\"?{SECRET}{{8,}}+(?:\"{EDGE_AFTER})?",
}
EDGES = {"name": "", "secret": ""}
ANY_EXTRA = EDGE_BEFORE + "(?:" + "|".join(f"(?:{EXTRA[k]}){EDGES.get(k, EDGE_AFTER)}" for k in
                                           ("email", "iban", "ssn", "phone", "card", "name", "secret")) + ")"
#: Cheap test whether a text can hold an added span at all: every candidate pattern has one of these in it.
MAY_HAVE_EXTRA = (rf"[0-9]{{3}}|[A-Z]{{2}}[0-9]{{2}}|AKIA|\(at\)|\[at\]|{TITLE}\p{{Lu}}"
                  rf"|[=:] ?\"?{SECRET}{{8}}")

# Gazetteers and cue words (fixed values).
DOMAINS = "com|org|net|edu|gov|io|info|de|fr|es|it|uk|us|ch|at|eu"
GAZETTEER = {
    "email": rf"(?i)(?:\.|dot[)\]] ?)(?:{DOMAINS})$",
    "ip": r"^(?!0+\.|127\.|255\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^(?:\+(?:1|33|34|39|41|43|44|49)[^0-9]?|\(?0?[2-9][0-9]{2})",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "iban": r"^(?:DE|FR|ES|IT|GB|CH|AT|NL|BE)",
    "name": r"^(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Señor|Señora)\b",
    "secret": r"^(?:AKIA|password|passwd|token|secret|api_?key)",
}
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|contacto|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|adresse)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|karte|carte|tarjeta|credit)\b",
    "phone": r"(?i)\b(?:phone|tel|telefon|telephone|call|mobile|fax|llame)\b",
    "ssn": r"(?i)\b(?:ssn|social security)\b",
    "iban": r"(?i)\b(?:iban|account|konto|compte|cuenta)\b",
    "name": r"(?i)\b(?:dear|from|by|sincerely|hello|liebe|cher|querido)\b",
    "secret": r"(?i)\b(?:key|password|token|secret|login)\b",
}
AGAINST = r"(?i)\b(?:version|isbn|issn|order|page|figure|invoice|no)\b\W*$"
STRICT = {
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$",
    "email": r"(?:\(at\)|\[at\]).*(?:\(dot\)|\[dot\]|\.)",
    "name": rf" {NAME} {NAME}$",
    "secret": r"^AKIA[A-Z0-9]{16}$|[=:] ?\"?(?=[A-Za-z_/+-]*[0-9])[A-Za-z0-9_/+-]{12,}\"?$",
}


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]+", "")


def luhn(s: Column) -> Column:
    """Whether up to 20 digits pass the check sum."""
    d = F.lpad(digits(s), 20, "0")
    total = F.lit(0)
    for i in range(20):  # place 0 is left; every second digit from the right doubles
        v = F.substring(d, i + 1, 1).cast("int")
        total = total + (v if i % 2 else F.when(v > 4, 2 * v - 9).otherwise(2 * v))
    return total % 10 == 0


def located(text: Column, pattern: str) -> Column:
    """All matches with their places: array of (s, e, m), code points, end exclusive.

    Gaps (the text split at the matches) and matches alternate; places are running
    sums, taken over chunks so that they stay cheap for many matches.
    """
    empty = F.array().cast("array<struct<s:int,e:int,m:string>>")

    def within(chunk: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
        return F.aggregate(chunk, start, lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("s"), (acc["at"] + x["gap"] + x["len"]).alias("e"),
                x["m"].alias("m")))).alias("out")))

    def shifted(parts: Column) -> Column:
        return F.flatten(F.transform(parts, lambda p, i: let(
            F.aggregate(F.slice(parts, F.lit(1), i), F.lit(0), lambda a, q: a + q["at"]),
            lambda off: F.transform(p["out"], lambda x: F.struct(
                (x["s"] + off).alias("s"), (x["e"] + off).alias("e"), x["m"].alias("m"))))))

    def from_pieces(pieces: Column) -> Column:
        last = F.ceil(F.size(pieces) / CHUNK).cast("int") - 1
        chunks = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(pieces, c * CHUNK + 1, CHUNK))
        return let(F.transform(chunks, within), shifted)

    def from_matches(m: Column) -> Column:
        pieces = F.zip_with(m, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m)), lambda x, gap: F.struct(
            F.length(gap).alias("gap"), F.length(x).alias("len"), x.alias("m")))
        return F.when(F.size(m) == 0, empty).otherwise(let(pieces, from_pieces))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), from_matches)


def base_spans(text: Column, kind: str) -> Column:
    """The valid base spans of a kind: array of (s, e, m)."""
    def valid(x: Column) -> Column:
        n = F.length(digits(x["m"]))
        if kind == "card":
            return n.between(16, 19) & luhn(x["m"])
        if kind == "phone":
            return n.between(8, 15)
        if kind == "ip":
            part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
            return x["m"].rlike(rf"^{part}\.{part}\.{part}\.{part}$")
        return F.lit(True)

    found = located(text, BASE[kind])
    spans = found if kind == "email" else F.filter(found, valid)
    can = text.contains(NEEDS[kind]) if NEEDS[kind] else text.rlike("[0-9]{2}")
    if kind == "card":
        can = text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}")
    if kind == "ip":
        can = text.rlike(r"[0-9]\.[0-9]")
    return F.when(can, spans).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def kind_of(m: Column) -> Column:
    """The kind of an added span: the first candidate pattern that it matches whole."""
    k = F.lit("secret")
    for kind in ("name", "card", "phone", "ssn", "iban", "email"):
        k = F.when(m.rlike(f"^(?:{EXTRA[kind]})$"), F.lit(kind)).otherwise(k)
    return k


def by_kind(kind: Column, per_kind: dict[str, Column], default: Column) -> Column:
    c = default
    for k, v in per_kind.items():
        c = F.when(kind == k, v).otherwise(c)
    return c


def blocks_of(text: Column) -> Column:
    """The text in pieces of BLOCK code points."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0))


def context(blocks: Column, s: Column) -> Column:
    """The CONTEXT_CHARS code points before place ``s``, from its block and the one before."""
    at, off = F.floor(s / BLOCK).cast("int"), s % BLOCK
    here = F.coalesce(F.get(blocks, at), F.lit(""))
    near = F.substring(here, F.greatest(off - CONTEXT_CHARS + 1, F.lit(1)), F.least(off, F.lit(CONTEXT_CHARS)))
    cut = (off < CONTEXT_CHARS) & (at > 0)
    return F.when(cut, F.concat(F.right(F.get(blocks, at - 1), F.lit(CONTEXT_CHARS) - off), near)).otherwise(near)


def below(places: Column, value: Column) -> Column:
    """How many of ascending ``places`` are less than ``value``, by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda n, k: F.when(
        (F.size(places) - n >= k) & (F.get(places, n + k - 1) < value), n + k).otherwise(n))


def apart(spans: Column, base: Column) -> Column:
    """The spans that overlap no base span. A base span that ends before x starts also starts before
    x ends, so x is free if as many base spans end by its start as start before its end."""
    def one_by_one() -> Column:
        return F.filter(spans, lambda x: ~F.exists(base, lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"])))

    def searched(places: Column) -> Column:
        return F.filter(spans, lambda x: below(places["s"], x["e"]) == below(places["e"], x["s"] + 1))

    places = F.struct(F.array_sort(F.transform(base, lambda y: y["s"])).alias("s"),
                      F.array_sort(F.transform(base, lambda y: y["e"])).alias("e"))
    return F.when(F.size(base) <= MANY, one_by_one()).otherwise(let(places, searched))


def described(before: Column, kind: Column, x: Column, base: bool) -> Column:
    """A span with its votes (-1, 0, 1 by labeler) and its features for the classifier; ``before``
    is the text in front of it."""
    m = x["m"]
    n = F.length(digits(m))
    sign = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(-1))
    if base:
        strict = F.lit(1)
    else:
        strict = by_kind(kind, {k: sign(m.rlike(p)) for k, p in STRICT.items()}
                         | {"card": sign(n.between(13, 15) & luhn(m)), "phone": sign(n.between(9, 12))}, F.lit(0))
    known = by_kind(kind, {k: sign(m.rlike(p)) for k, p in GAZETTEER.items()}, F.lit(0))
    cue = F.when(by_kind(kind, {k: before.rlike(p) for k, p in CUES.items()}, F.lit(False)), F.lit(1)) \
        .when(before.rlike(AGAINST), F.lit(-1)).otherwise(F.lit(0))
    votes = F.concat_ws(",", *[v.cast("string") for v in (strict, known, cue)])
    share = F.floor(F.least(F.lit(4), n * 5 / F.greatest(F.length(m), F.lit(1)))).cast("string")
    size = F.least(F.lit(9), F.length(m) / 4).cast("int").cast("string")
    features = F.array(F.concat(F.lit("kind="), kind), F.concat(F.lit("regex="), kind, strict.cast("string")),
                       F.concat(F.lit("known="), kind, known.cast("string")),
                       F.concat(F.lit("cue="), cue.cast("string")),
                       F.concat(F.lit("digits="), kind, share), F.concat(F.lit("size="), kind, size))
    return F.struct(kind.alias("kind"), x["s"].alias("s"), x["e"].alias("e"), votes.alias("votes"),
                    features.alias("features"))


def _described_all(text: Column, spans: Column, kind: str | None = None) -> Column:
    """Spans (array of s, e, m) described, base ones of ``kind`` or added ones; blocks only where there are spans."""
    def one(x: Column, blocks: Column) -> Column:
        told = F.struct(context(blocks, x["s"]).alias("before"), (F.lit(kind) if kind else kind_of(x["m"])).alias("kind"))
        return let(told, lambda t: described(t["before"], F.lit(kind) if kind else t["kind"], x, kind is not None))

    def with_blocks(found: Column) -> Column:
        blocks = F.when(F.size(found) > 0, blocks_of(text)).otherwise(F.array().cast("array<string>"))
        return let(blocks, lambda b: F.transform(found, lambda x: one(x, b)))

    return let(spans, with_blocks)


def of_kind(spans: Column | str, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` and ``extra``: the described spans of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(*[_described_all(text, base_spans(text, k), k) for k in BASE_KINDS])

    def extra(b: Column) -> Column:
        return let(located(text, ANY_EXTRA), lambda found: _described_all(text, apart(found, b)))

    none = F.transform(F.slice(F.col("base"), 1, 0), lambda x: x)
    return (docs.select("doc_id", F.col("text"), base.alias("base"))
            .select("doc_id", "base", F.when(text.rlike(MAY_HAVE_EXTRA), extra(F.col("base"))).otherwise(none)
                    .alias("extra")))


#: Right and wrong votes that each labeler starts with, in each class.
HEAD_START = (8.0, 2.0)


def estimate_labelers(counts: dict[tuple[int, ...], int], steps: int = 50) -> tuple[float, list[dict[int, float]]]:
    """EM over vote patterns: P(personal) and, per labeler, P(right | class, it votes).

    An abstention says nothing about the class. Labelers start out right in 4 of 5
    cases, which also tells the classes apart.
    """
    prior, right = 0.5, [{0: 0.8, 1: 0.8} for _ in LABELERS]
    for _ in range(steps):
        mass = {0: 1.0, 1: 1.0}
        votes_seen = [{c: list(HEAD_START) for c in (0, 1)} for _ in LABELERS]
        for votes, n in counts.items():
            p = posterior(votes, prior, right)
            for c, w in ((1, p * n), (0, (1 - p) * n)):
                mass[c] += w
                for k, v in enumerate(votes):
                    if v:
                        votes_seen[k][c][(v > 0) != (c == 1)] += w
        prior = min(0.999, max(0.001, mass[1] / (mass[0] + mass[1])))
        right = [{c: s[c][0] / sum(s[c]) for c in (0, 1)} for s in votes_seen]
    return prior, right


def posterior(votes: tuple[int, ...], prior: float, right: list[dict[int, float]]) -> float:
    odds = log(prior / (1 - prior))
    for v, r in zip(votes, right, strict=True):
        if v > 0:
            odds += log(r[1] / (1 - r[0]))
        elif v < 0:
            odds += log((1 - r[1]) / r[0])
    return 1 / (1 + exp(-max(-700.0, min(700.0, odds))))


def _lookup(values: dict[str, float], key: Column, default: float) -> Column:
    if not values:
        return F.lit(default)
    table = F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*map(F.lit, values.values())))
    return F.coalesce(F.try_element_at(table, key), F.lit(default))


def train_classifier(spans: DataFrame) -> tuple[float, dict[str, float]]:
    """Prior log odds and a weight per feature, from the EM posteriors of all candidates."""
    patterns = {tuple(map(int, r["votes"].split(","))): r["n"]
                for r in spans.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 27 rows
    prior, right = estimate_labelers(patterns)
    soft = {",".join(map(str, v)): posterior(v, prior, right) for v in patterns}
    p = _lookup(soft, F.col("votes"), 0.5)
    weighed = (spans.select(p.alias("p"), F.explode("features").alias("feature")).groupBy("feature")
               .agg(F.sum(F.col("p").cast("decimal(20,9)")).cast("double").alias("yes"),
                    F.count(F.lit(1)).alias("n")).collect())  # fixed vocabulary: under 400 rows
    yes = sum(soft[",".join(map(str, v))] * n for v, n in patterns.items()) + 1
    no = sum(patterns.values()) + 2 - yes
    weights = {r["feature"]: round(log((r["yes"] + 0.5) / (yes + 1)) - log((r["n"] - r["yes"] + 0.5) / (no + 1)), 9)
               for r in weighed}
    return round(log(yes / no), 9), weights


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: array of (kind, s, e), base ones first by kind, and
    ``base`` alone."""
    rows = staged(docs.sparkSession, candidates(docs), "pii")
    prior, weights = train_classifier(rows.select(F.explode(F.concat("base", "extra")).alias("x")).select("x.*"))

    def score(x: Column) -> Column:
        return F.aggregate(x["features"], F.lit(prior), lambda a, f: a + _lookup(weights, f, 0.0))

    place = lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"))
    added = F.transform(F.filter("extra", lambda x: score(x) >= 0), place)
    return rows.select("doc_id", F.transform("base", place).alias("base"), added.alias("added"))


def pii_report(docs: DataFrame) -> DataFrame:
    order = (*BASE_KINDS, *(k for k in EXTRA_KINDS if k not in BASE_KINDS))
    written = lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))
    found = find_spans(docs)
    everything = F.concat(*[F.sort_array(of_kind(F.concat("base", "added"), k)) for k in order])
    return found.select(
        "doc_id", *[F.size(of_kind("base", k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.array_join(F.transform("base", written), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(everything, written), ",").alias("spans"))

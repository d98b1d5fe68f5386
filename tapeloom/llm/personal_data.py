"""Personal data: labelers vote on candidate spans, and a classifier learns from their votes.

One pass over the texts finds candidates: the base kinds, also those that fail the base
check, and the kinds added here. For each candidate three labelers vote for, against or not
at all: its format (checksums, digit counts, reserved ranges), a gazetteer (endings, country
codes, issuers, names) and the words around it. Expectation-maximisation over the counts of
vote patterns, without any true label, estimates how reliable each labeler is and how likely
each pattern is personal data. Those probabilities are soft labels: a classifier over features
of the span is trained on them, over all candidates, and decides about the added kinds. Base
spans stay whatever it says. Everything here is DataFrame functions; the driver holds the counts
of vote patterns and features, whose number is fixed by the labelers, not by the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.spans import count_of, joined, matches, searchable
from tapeloom.sources.paths import shared_dir

# The patterns. (?:(?<!x)|\G) lets a match begin only where a run of x begins or
# the last match ended: it finds the same and does not try every place of a long run.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SOCIAL = r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
ACCOUNT = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
LOCAL_PHONE = r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])"
PERSON = r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]+(?:\x20[A-Z][a-z]+)?"
IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# Kinds in the order of the result, the base kinds first.
BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["social", "account", "local_phone", "person"]
KINDS = BASE_KINDS + ADDED_KINDS
# Gazetteers, as patterns over a candidate's text.
KNOWN = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|info|de|fr|es|uk|eu|io|co)$",
    "ip": r"^(?!0|10\.|127\.|169\.254\.|192\.168\.|2(?:2[4-9]|[3-5][0-9])\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^\+(?:1|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
    "social": r"^(?!000|666|9)",
    "account": r"^(?:A[DELTZ]|B[AEGHIRY]|C[HRYZ]|D[EJKO]|E[EGS]|F[IKOR]|G[BEILRT]|H[NRU]|I[ELQST]|JO|K[WZ]|"
    r"L[BCITUVY]|M[CDEKNRTU]|N[ILO]|OM|P[KLST]|QA|R[OSU]|S[ACDEIKMOTV]|T[LNR]|UA|V[AG]|XK|YE)",
    "local_phone": r"^\(?[2-9]",
    "person": r"\b(?:Anna|David|Emma|James|Jean|John|Juan|Karl|Laura|Maria|Marie|Mary|Paul|Peter|Robert|Sarah|Smith|Müller)\b",
}
# Kinds whose gazetteer lists what is known; a value outside is not evidence against. The other
# gazetteers name what cannot be, such as ranges that are never given out.
OPEN_LISTS = ["email", "card", "phone", "account", "person"]
FOR_WORDS = {
    "email": "mail|contact|write|e-mail",
    "ip": r"\bip\b|address|host|server|login",
    "card": "card|visa|credit|payment|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax",
    "social": r"social|ssn|security",
    "account": "iban|account|bank|konto|compte|cuenta",
    "local_phone": "phone|call|tel|mobile|fax",
    "person": r"name|patient|client|dear|signed",
}
AGAINST_WORDS = r"version|release|chapter|section|isbn|invoice|order|serial|part no|example"
CONTEXT_CHARS = 40

LABELERS = ["format", "gazetteer", "context"]
EM_ROUNDS = 50
FIRST_RELIABILITY = 0.7

CANDIDATE = (
    "struct<kind_order:int,start:int,kind:string,stop:int,base:boolean,"
    "votes:array<int>,features:array<string>>"
)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backward = F.reverse(number)

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(backward, place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    places = F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1)))
    return F.coalesce(F.aggregate(places, F.lit(0), add) % 10 == 0, F.lit(False))


def valid(kind: str, value: Column) -> Column:
    """The check of a kind's format: for base kinds the one that decides whether a match counts."""
    number = digits(value)
    if kind == "ip":
        return value.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")
    if kind == "card":
        right_length = F.length(number).between(13, 19)
        return F.when(right_length, luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(number).between(9, 15)
    if kind == "social":
        return ~value.rlike(r"^(?:000|666|9)|-00-|-0000$")
    if kind == "account":
        plain = F.regexp_replace(value, " ", "")
        return F.length(plain).between(15, 34)
    return F.lit(True)


def _vote(condition: Column, otherwise: int = -1) -> Column:
    return F.when(condition, 1).otherwise(otherwise)


def _candidates(kind: str, order: int, found: Column) -> Column:
    def candidate(span: Column) -> Column:
        value = span["value"]
        base = valid(kind, value) if kind in BASE_KINDS else F.lit(False)
        before = F.lower(span["before"])
        context = (
            F.when(before.rlike(AGAINST_WORDS), -1).when(before.rlike(FOR_WORDS[kind]), 1).otherwise(0)
        )
        listed = _vote(value.rlike(KNOWN[kind]), 0 if kind in OPEN_LISTS else -1)
        votes = F.array(_vote(valid(kind, value)), listed, context)
        features = F.array(
            F.concat(F.lit("length "), F.least(F.length(value), F.lit(30)).cast("string")),
            F.concat(F.lit("before "), _shape(F.right(span["before"], F.lit(1)))),
            F.concat(F.lit("format "), votes[0].cast("string")),
            F.concat(F.lit("gazetteer "), votes[1].cast("string")),
            F.concat(F.lit("context "), votes[2].cast("string")),
        )
        return F.struct(
            F.lit(order).alias("kind_order"),
            span["start"].alias("start"),
            F.lit(kind).alias("kind"),
            span["stop"].alias("stop"),
            base.alias("base"),
            votes.alias("votes"),
            features.alias("features"),
        )

    return F.transform(found, candidate)


def _shape(character: Column) -> Column:
    return (
        F.when(character == "", "edge")
        .when(character.rlike(r"[\x20\x09-\x0D]"), "blank")
        .when(character.rlike("[0-9]"), "digit")
        .when(character.rlike("[A-Za-z]"), "letter")
        .otherwise("mark")
    )


def find_candidates(rows: DataFrame) -> DataFrame:
    """All candidates of each text, by kind and start, from one pass over the texts."""
    searched = rows.withColumn("text", searchable(F.col("text")))
    text = F.col("text")
    patterns = [
        (EMAIL, "@"), (IP, "."), (CARD, None), (PHONE, "+"), (SOCIAL, "-"), (ACCOUNT, None),
        (LOCAL_PHONE, None), (PERSON, None),
    ]
    found = searched.select(
        "*",
        *[
            matches(text, pattern, hint, CONTEXT_CHARS).alias(f"_{kind}")
            for kind, (pattern, hint) in zip(KINDS, patterns)
        ],
    )
    candidates = F.concat(
        *[_candidates(kind, order, F.col(f"_{kind}")) for order, kind in enumerate(KINDS)]
    )
    return found.select(*rows.drop("text").columns, candidates.cast(f"array<{CANDIDATE}>").alias("candidates"))


# -- what is learned ------------------------------------------------------------------


@dataclass(frozen=True)
class Reliability:
    """Prior of each kind, and each labeler's probability of a vote given the truth."""

    prior: dict[str, float]
    votes: list[dict[tuple[int, int], float]]  # by labeler: (truth, vote) -> probability

    def posterior(self, kind: str, votes: tuple[int, ...]) -> float:
        odds = log(self.prior[kind] / (1 - self.prior[kind]))
        for table, vote in zip(self.votes, votes):
            odds += log(table[1, vote] / table[0, vote])
        return 1 / (1 + exp(-max(-700.0, min(700.0, odds))))


def fit_reliability(patterns: dict[tuple[str, tuple[int, ...]], int]) -> Reliability:
    """Expectation-maximisation over the counts of (kind, votes), at most 27 for a kind.

    Starts from labelers that are right more often than not, so that a vote for a span means
    what it says; adds one to every count, so that nothing is impossible.
    """
    first = {1: FIRST_RELIABILITY, -1: 1 - FIRST_RELIABILITY, 0: 0.5}
    tables = [
        {(truth, v): first[v if truth else -v] for truth in (0, 1) for v in (-1, 0, 1)}
        for _ in LABELERS
    ]
    fitted = Reliability({kind: 0.5 for kind, _ in patterns}, tables)
    for _ in range(EM_ROUNDS):
        truth = {pattern: fitted.posterior(*pattern) for pattern in patterns}
        prior = {}
        for kind in fitted.prior:
            own = [(truth[p] * n, n) for p, n in patterns.items() if p[0] == kind]
            prior[kind] = (sum(t for t, _ in own) + 1) / (sum(n for _, n in own) + 2)
        tables = []
        for place in range(len(LABELERS)):
            sums = {(t, v): 1.0 for t in (0, 1) for v in (-1, 0, 1)}
            for (kind, votes), n in patterns.items():
                p = truth[kind, votes]
                sums[1, votes[place]] += p * n
                sums[0, votes[place]] += (1 - p) * n
            totals = {t: sum(sums[t, v] for v in (-1, 0, 1)) for t in (0, 1)}
            tables.append({(t, v): sums[t, v] / totals[t] for t, v in sums})
        fitted = Reliability(prior, tables)
    return fitted


@dataclass(frozen=True)
class Classifier:
    """Log odds of each kind, and what each of a span's features adds to them."""

    start: dict[str, float]
    weights: dict[tuple[str, str], float]

    def keeps(self, candidate: Column) -> Column:
        """Whether the odds of a candidate are for it."""
        starts = [x for kind, odds in self.start.items() for x in (F.lit(kind), F.lit(odds))]
        weights = [
            x
            for (kind, feature), weight in self.weights.items()
            for x in (F.lit(f"{kind} {feature}"), F.lit(weight))
        ]
        if not starts:
            return F.lit(False)
        table = F.create_map(*weights)
        kind = candidate["kind"]
        total = F.aggregate(
            candidate["features"],
            F.coalesce(F.create_map(*starts)[kind], F.lit(0.0)),
            lambda so_far, feature: so_far
            + F.coalesce(table[F.concat_ws(" ", kind, feature)], F.lit(0.0)),
        )
        return total > 0


def train_classifier(each: DataFrame, reliability: Reliability) -> Classifier:
    """Naive Bayes from soft labels: a span counts for its features as far as it is likely true.

    `each` has one row for every kind, vote pattern and feature list, with its count `n`.
    """
    rows = each.select("kind", "votes", F.explode("features").alias("feature"), "n")
    sums = rows.groupBy("kind", "votes", "feature").agg(F.sum("n").alias("n")).collect()
    kinds: dict[str, list[float]] = {}
    features: dict[tuple[str, str], list[float]] = {}
    for row in sums:  # kinds x vote patterns x features: bounded by the labelers
        p = reliability.posterior(row["kind"], tuple(row["votes"]))
        for counts in (
            features.setdefault((row["kind"], row["feature"]), [1.0, 1.0]),
            *([kinds.setdefault(row["kind"], [1.0, 1.0])] if row["feature"].startswith("format ") else []),
        ):
            counts[0] += p * row["n"]
            counts[1] += (1 - p) * row["n"]
    start = {kind: log(yes / no) for kind, (yes, no) in kinds.items()}
    weights = {
        (kind, feature): log(yes / no) - start[kind] for (kind, feature), (yes, no) in features.items()
    }
    return Classifier(start, weights)


# -- operator -------------------------------------------------------------------------


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, digest and list of the personal data of every document.

    A null text counts as empty. Repeated rows and rows with a null id are each searched;
    further columns are ignored. The candidates, without the texts, are written to the shared
    folder once and read for the counts and for the result.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    folder = shared_dir(spark, "candidates")
    find_candidates(rows).write.parquet(folder)
    candidates = spark.read.schema(f"doc_id long, candidates array<{CANDIDATE}>").parquet(folder)

    each = candidates.select(F.inline("candidates"))
    counted = each.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).alias("n"))
    patterns = {
        (row["kind"], tuple(row["votes"])): row["n"]
        for row in each.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    reliability = fit_reliability(patterns)
    classifier = train_classifier(counted, reliability)

    def accepted(of_text: Column) -> Column:
        base = F.filter(of_text, lambda c: c["base"])

        def added(c: Column) -> Column:
            apart = ~F.exists(base, lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"]))
            return c["kind"].isin(ADDED_KINDS) & apart & classifier.keeps(c)

        return F.filter(of_text, lambda c: c["base"] | added(c))

    spans = candidates.select("doc_id", accepted(F.col("candidates")).alias("found"))
    base = F.filter("found", lambda span: span["base"])
    return spans.select(
        "doc_id",
        *[count_of(base, kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )

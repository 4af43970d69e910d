"""Personal data by weak supervision (DataFrame operations only).

Fixed rules give the base spans (email, ip, card, phone).  Besides, a loose pattern gives
candidates of other shapes (numbers in groups, spelled-out addresses, account numbers).
Labelers vote on every candidate, the base spans among them: strict shape, gazetteers
(top-level domains, dialling and country codes, reserved networks), checksum (Luhn, IBAN),
structure (digits, separators, function words), and words of the context.  A vote is 1
(personal), 0 (not) or -1 (abstains); each labeler can vote 0 on some kind.

1. One pass counts the candidates by group (base or one of the added kinds) and vote pattern
   (at most 4 x 3^5) and by feature value, after map-side combining, so a hot source changes nothing.
2. Expectation-maximisation over the vote patterns estimates how reliable each labeler is,
   the share of personal data in each group, and how likely each pattern is personal data.
3. These soft labels train the final span classifier, naive Bayes for each added kind over
   features that no labeler votes on alone: digit count, length, separator, the characters beside
   the span, and a hash of the word before it.
4. A second pass adds the candidates that the classifier takes for personal data and that
   overlap no base span, as kinds ``contact``, ``number`` and ``account``.  Base spans always stay.

Only the bounded count tables reach the driver.

Defined cases: null text counts as empty and gives zero counts and empty lists; repeated rows
are scanned each; other columns are ignored; without any candidate nothing is added.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, literal_array
from .spans import apart_from, joined, match_spans, tagged

# The base rules.  Possessive where it cannot change a match, and a match starts where a run of its
# first characters does or where the last match ended, so that a failing run is read once and not from each of its characters.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

BASE = ["email", "ip", "card", "phone"]
ADDED = ["contact", "number", "account"]
KINDS = BASE + ADDED

#: Loose candidates: an address with a spelled "dot", or with "@" or a bracketed "at" and blanks; digit groups; an account number.
_USER = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
_AT = r"\x20?[\[(]\x20?(?i:at|@)\x20?[\])]\x20?|\x20?@\x20?"
_DOT = r"\x20?[\[(]\x20?(?i:dot|\.)\x20?[\])]\x20?|\x20(?i:dot)\x20"
CONTACT = _USER + rf"(?:(?:{_AT}|\x20(?i:at)\x20)[A-Za-z0-9-]++(?:(?:{_DOT})[A-Za-z0-9-]++){{0,3}}(?:{_DOT})|(?:{_AT})(?:[A-Za-z0-9-]++(?:\.|{_DOT})){{1,4}})[A-Za-z]{{2,24}}(?![A-Za-z0-9])"
NUMBER = r"(?<![A-Za-z0-9.])\(?[0-9]{2,4}\)?[\x20.-][0-9]{2,4}[\x20.-][0-9]{3,4}(?:[\x20.-][0-9]{2,4}){0,2}(?![0-9A-Za-z])"
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"

# Gazetteers and context words.
DOMAINS = ["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu"]
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "NL": 18,
                "NO": 15, "PL": 28, "PT": 25, "SE": 24}
DIALLING = ["+1", "+33", "+34", "+44", "+49", "+39", "+41", "+43"]
FUNCTION_WORDS = ["a", "an", "and", "at", "be", "by", "de", "der", "die", "el", "en", "for", "he", "in", "is", "it", "la", "le", "look", "looked",
                  "of", "on", "one", "or", "she", "the", "they", "this", "to", "us", "was", "we", "were", "you"]
FOR_IT = r"(?i)(?<!\p{L})(mail|e-?mail|contact|phone|tel|call|fax|mobile|cell|address|card|visa|account|iban|ssn|passport|reach|kontakt|telefon|correo|adresse)(?!\p{L})\P{L}*(?:\p{L}{1,4}\P{L}+){0,2}$"
AGAINST_IT = r"(?i)(?<!\p{L})(version|isbn|issn|order|invoice|page|line|chapter|section|item|seite|página|ratio|score)(?!\p{L})\P{L}*$"

#: Classifier probability from which a candidate is added, rounds of expectation-maximisation, pseudo-count.
ACCEPT = 0.5
ROUNDS = 40
PRIOR = 1.0
#: Groups of kinds with a share of personal data of their own, and vote patterns of five labelers.
GROUP = {**{k: 0 for k in BASE}, **{k: i + 1 for i, k in enumerate(ADDED)}}
LABELERS = 5
PATTERNS = 3 ** LABELERS


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn checksum."""
    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.coalesce(c.try_cast("int"), F.lit(0)) * (1 + i % 2)),
                        F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v))
    return total % 10 == 0


def iban(account: Column) -> Column:
    """Whether an account number leaves 1 modulo 97, its first four characters moved to the end, letters as 10 to 35."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    codes = F.transform(F.filter(F.split(moved, ""), lambda c: c != ""), lambda c: F.ascii(c))
    return F.aggregate(codes, F.lit(0), lambda a, c: F.when(c <= 57, a * 10 + c - 48).otherwise(a * 100 + c - 55) % 97) == 1


def _octets(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (
        F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255))


def _between(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


def _scanned(docs: DataFrame) -> DataFrame:
    """doc_id, text, the base spans by kind, and the loose candidates by kind that overlap none of them."""
    t = F.col("text")
    numeric = t.rlike("[0-9]")
    base = docs.select(
        "doc_id", "text", numeric.alias("numeric"),
        match_spans(t, EMAIL, t.contains("@")).alias("email"),
        F.filter(match_spans(t, IP, t.rlike(r"[0-9]\.[0-9]")), lambda x: _octets(x["m"])).alias("ip"),
        F.filter(match_spans(t, CARD, t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")), lambda x: _between(
            F.length(_digits(x["m"])), 13, 19) & luhn(_digits(x["m"]))).alias("card"),
        F.filter(match_spans(t, PHONE, t.contains("+")), lambda x: _between(F.length(_digits(x["m"])), 9, 15)).alias("phone"))
    spelled = t.rlike(r"@|(?i:dot)|[\[(]\x20?(?i:at)\x20?[\])]")
    return base.select(
        "doc_id", "text", *BASE,
        apart_from(match_spans(t, CONTACT, spelled), *BASE).alias("contact"),
        apart_from(match_spans(t, NUMBER, F.col("numeric")), *BASE).alias("number"),
        apart_from(match_spans(t, ACCOUNT, F.col("numeric") & t.rlike("[A-Z]{2}[0-9]{2}[A-Z0-9]{11}")), *BASE).alias("account"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(0)).otherwise(F.lit(-1))


def _either(yes: Column) -> Column:
    return _vote(yes, ~yes)


def _strict(kind: str, m: Column, x: Column) -> Column:
    """The shape that a careful writer gives such data."""
    if kind == "email":
        return _either(m.rlike(r"\.[A-Za-z]{2,24}$"))
    if kind == "ip":
        return _either(~m.rlike(r"(^|\.)0[0-9]") & ~x["after"].rlike(r"^\.[0-9]"))
    if kind == "card":
        return _either(m.rlike("^[3-6]") & _between(F.length(_digits(m)), 14, 16))
    if kind == "phone":
        return _either(m.rlike(r"^\+[0-9]{1,3}(?:[\x20.-]?\(?[0-9]{1,5}\)?){2,6}$"))
    if kind == "contact":
        return _vote(m.rlike(r"[@\[(]"), F.lit(False))
    if kind == "number":
        return _vote(m.rlike(r"^(?:\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4})$"),
                     m.rlike(r"^(?:1[5-9]|20)[0-9]{2}[\x20.-]|^[0-9]+\.[0-9]+\.[0-9]+\."))
    length = F.get(literal_array(list(IBAN_LENGTHS.values()), "int"), F.array_position(F.lit(list(IBAN_LENGTHS)), F.substring(m, 1, 2)).cast("int") - 1)
    return _either(F.coalesce(length == F.length(m), F.lit(False)))


def _gazetteer(kind: str, m: Column) -> Column:
    if kind in ("email", "contact"):
        return _either(F.lower(F.regexp_extract(m, r"([A-Za-z]+)$", 1)).isin(DOMAINS))
    if kind == "account":
        return _either(F.substring(m, 1, 2).isin(list(IBAN_LENGTHS)))
    if kind == "phone":
        return _vote(F.substring(m, 1, 2).isin(DIALLING) | F.substring(m, 1, 3).isin(DIALLING), F.lit(False))
    if kind == "ip":
        return _either(~m.rlike(r"^(?:0|10|127|255|192\.168)\."))
    return F.lit(-1)


def _structure(kind: str, m: Column, digits: Column) -> Column:
    if kind in ("email", "contact"):
        user, host = F.lower(F.regexp_extract(m, "^([A-Za-z0-9._%+-]+)", 1)), F.lower(F.regexp_extract(
            m, r"^[A-Za-z0-9._%+-]+[^A-Za-z0-9]*(?:(?i:at)[^A-Za-z0-9]+)?([A-Za-z0-9-]+)", 1))
        return _either(~user.isin(FUNCTION_WORDS) & ~host.isin(FUNCTION_WORDS) & (F.length(user) > 1))
    if kind == "number":
        return _either(_between(digits, 9, 15) & m.rlike(r"[().-]"))
    if kind == "account":
        return _either(digits * 2 >= F.length(m))
    return F.lit(-1) if kind == "ip" else _either(_between(digits, 9, 19))


def _votes(kind: str, x: Column) -> Column:
    """The group and the five labelers' votes as one number, the votes in base 3."""
    m, d = x["m"], F.length(_digits(x["m"]))
    if kind == "account":
        checksum = _either(iban(m))
    else:
        checksum = _vote(_between(d, 13, 19) & luhn(_digits(m)), _between(d, 13, 19)) if kind in ("card", "number") else F.lit(-1)
    context = _vote(x["before"].rlike(FOR_IT), x["before"].rlike(AGAINST_IT))
    code = F.lit(GROUP[kind])
    for v in (_strict(kind, m, x), _gazetteer(kind, m), checksum, _structure(kind, m, d), context):
        code = code * 3 + v + 1
    return code.cast("int")


FEATURES = {"digits": 8, "length": 8, "separator": 8, "before": 5, "after": 5, "word": 64}
N_CELLS = sum(FEATURES.values())


def _features(x: Column) -> list[Column]:
    """Small integer features of a span; none is a vote."""
    m = x["m"]
    digits, length = F.length(_digits(m)), F.length(m)

    def neighbour(c: Column) -> Column:
        return F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^[0-9]$"), 2).when(c.rlike(r"^\p{L}$"), 3).otherwise(4)

    separator = F.when(m.contains("@"), 1).when(m.startswith("+"), 2).when(m.contains("("), 3).when(m.contains("."), 4) \
        .when(m.contains("-"), 5).when(m.contains(" "), 6).when(m.rlike("^[0-9]+$"), 0).otherwise(7)
    word = F.lower(F.regexp_extract(x["before"], r"(\p{L}+)\P{L}*$", 1))
    return [F.least(F.floor(digits / 3), F.lit(7)).cast("int"), F.least(F.floor(length / 5), F.lit(7)).cast("int"), separator,
            neighbour(F.substring(x["before"], -1, 1)), neighbour(F.substring(x["after"], 1, 1)),
            F.when(word == "", 0).otherwise(1 + F.pmod(F.xxhash64(word), F.lit(FEATURES["word"] - 1))).cast("int")]


def _feature_cells(x: Column) -> Column:
    """One number per feature, distinct over all features: a row of the model's table."""
    offsets, at = [], 0
    for n in FEATURES.values():
        offsets.append(at)
        at += n
    return F.array(*[(F.lit(o) + f).cast("int") for o, f in zip(offsets, _features(x), strict=True)])


def _unpack(code: int) -> list[int]:
    out = []
    for _ in range(LABELERS):
        out.append(code % 3 - 1)
        code //= 3
    return out[::-1]


def reliabilities(patterns: dict[int, int], rounds: int = ROUNDS) -> tuple[dict[int, float], list[tuple[float, float]], dict[int, float]]:
    """Expectation-maximisation for independent labelers that may abstain.

    ``patterns`` counts spans by group * 3^5 + votes.  Returns the probability of personal data per pattern,
    per labeler the chances to vote 1 on personal data and on other spans, and per group the share of personal data."""
    votes = {p: _unpack(p % PATTERNS) for p in patterns}
    # start from the majority of the votes
    belief = {p: (sum(v == 1 for v in vs) + 0.5) / (sum(v >= 0 for v in vs) + 1) for p, vs in votes.items()}
    rates, share = [(0.5, 0.5)] * LABELERS, {}
    for _ in range(rounds):
        for g in {p // PATTERNS for p in patterns}:
            own = {p: n for p, n in patterns.items() if p // PATTERNS == g}
            share[g] = (sum(n * belief[p] for p, n in own.items()) + PRIOR) / (sum(own.values()) + 2 * PRIOR)
        rates = []
        for k in range(LABELERS):
            cast = [(n, belief[p], votes[p][k]) for p, n in patterns.items() if votes[p][k] >= 0]
            # the prior takes a labeler for somewhat better than chance
            yes = (sum(n * b * v for n, b, v in cast) + 1.6 * PRIOR) / (sum(n * b for n, b, _ in cast) + 2 * PRIOR)
            no = (sum(n * (1 - b) * v for n, b, v in cast) + 0.4 * PRIOR) / (sum(n * (1 - b) for n, b, _ in cast) + 2 * PRIOR)
            rates.append((yes, no))
        for p, vs in votes.items():
            odds = math.log(share[p // PATTERNS] / (1 - share[p // PATTERNS]))
            for (yes, no), v in zip(rates, vs, strict=True):
                if v >= 0:
                    odds += math.log(yes / no) if v else math.log((1 - yes) / (1 - no))
            belief[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief, rates, share


def train(docs: DataFrame) -> dict:
    """The span classifier (per added kind the log odds of the class and of every feature value) and the labelers' estimates."""
    found = _scanned(documents(docs))
    whole = F.array(F.lit(-1))

    def rows_of(kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(
            _votes(kind, x).alias("votes"), (F.concat(whole, _feature_cells(x)) if kind in ADDED else whole).alias("cells")))

    every = found.select(F.explode(F.concat(*[rows_of(k) for k in KINDS])).alias("x")).select("x.votes", F.explode("x.cells").alias("cell"))
    rows = every.groupBy("votes", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
    belief, rates, share = reliabilities({r["votes"]: r["n"] for r in rows if r["cell"] == -1})
    mass = [defaultdict(float), defaultdict(float)]
    for r in rows:
        cell = (r["votes"] // PATTERNS, r["cell"])
        mass[1][cell] += r["n"] * belief[r["votes"]]
        mass[0][cell] += r["n"] * (1 - belief[r["votes"]])
    odds, prior = {}, {}
    for kind in ADDED:
        g, at, odds[kind] = GROUP[kind], 0, []
        for n in FEATURES.values():
            # a prior of PRIOR spread over the values of a feature
            odds[kind] += [math.log((mass[1][g, c] + PRIOR / n) / (mass[1][g, -1] + PRIOR)) - math.log((mass[0][g, c] + PRIOR / n) / (mass[0][g, -1] + PRIOR))
                           for c in range(at, at + n)]
            at += n
        prior[kind] = math.log((mass[1][g, -1] + PRIOR) / (mass[0][g, -1] + PRIOR))
    return {"odds": odds, "prior": prior, "rates": rates, "share": share}


def find_pii(docs: DataFrame, model: dict | None = None, accept: float = ACCEPT) -> DataFrame:
    """Per row: doc_id, text, and one array of spans (s, e, m, before, after) per kind of ``KINDS``."""
    model = train(docs) if model is None else model
    need = math.log(accept / (1 - accept))

    def personal(kind: str) -> Column:
        odds, prior = literal_array([round(x, 6) for x in model["odds"][kind]], "double"), F.lit(model["prior"][kind])
        return F.filter(kind, lambda x: F.aggregate(_feature_cells(x), prior, lambda a, c: a + F.get(odds, c)) >= need).alias(kind)

    return _scanned(documents(docs)).select("doc_id", "text", *BASE, *[personal(k) for k in ADDED])


def mask(found: DataFrame) -> DataFrame:
    """(doc_id, text) of ``find_pii`` with every span replaced by ``[kind]``; of overlapping spans the first one counts."""

    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(f"[{kind}]").alias("k")))

    every = F.array_sort(F.concat(*[named(k) for k in KINDS]))
    cut = F.aggregate(
        every, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, x: F.when(x["s"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], x["e"]).alias("at"))).otherwise(
            F.struct(F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, x["s"] - a["at"]), x["k"]).alias("out"), x["e"].alias("at"))))
    done = found.select("doc_id", "text", cut.alias("c"))
    return done.select("doc_id", F.concat("c.out", F.substring(F.col("text"), F.col("c.at") + 1, F.length("text"))).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    base = F.concat(*[tagged(F.col(k), i, False) for i, k in enumerate(BASE)])
    every = F.concat(*[tagged(F.col(k), i, False) for i, k in enumerate(KINDS)])
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base, KINDS, False).cast("binary"), 256).alias("base_sha256"), joined(every, KINDS, False).alias("spans"),
        (F.size("contact") + F.size("number") + F.size("account")).cast("long").alias("n_added"))


__all__ = ["find_pii", "mask", "digest", "train", "reliabilities", "luhn", "iban"]

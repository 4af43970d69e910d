"""Secret scans with character Markov models (DataFrame operations only).

Three fixed rules give the base spans: assignments, access keys, long hex strings.  Two
character-bigram models are then trained from labelled samples: strings that a base rule
marks (random) and the ordinary identifiers, words and numbers of documents without any such
mark.  Every other long run of key characters in every text is scored by the log-likelihood
ratio of the two models, and added as kind ``random`` where the ratio is above a threshold both
in total and for each character, so that neither a short nor a very long run passes by its length.

The samples are bounded and drawn by a hash of the row (``RANDOM_SAMPLE`` strings,
about ``ORDINARY_DOCS`` documents); the bigram tables have 67 x 66 cells.  Both models fall back
on the shares of single characters and these on a uniform share (a fifth of the weight in the random
model, whose sample may know few alphabets), so without any sample no span is added.  Scanning is one pass without a shuffle.

Defined cases: null text counts as empty and gives zero counts and an empty list; repeated
rows are scanned each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, literal_array
from .spans import apart_from, joined, let, match_spans, tagged

# The base rules.
KEY_WORDS = ["password", "passwd", "secret", "token", "api_?key"]
ASSIGN = "(?i:(" + "|".join(KEY_WORDS) + r"""))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
MIN_VALUE, MIN_ACCESS = 8, 16

KINDS = ["assign", "access", "hex", "random"]
#: Characters of keys; a candidate is a run of at least ``MIN_RUN`` of them.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_="
MIN_RUN = 16
CANDIDATE = r"[A-Za-z0-9+/_=]{16,}"
#: What the ordinary model learns from: runs of key characters, numbers and short identifiers with digits among them.
ORDINARY = r"[A-Za-z0-9+/_=]{4,}"
#: Bounds of the labelled samples, and the weight of a character's own share against its bigrams.
RANDOM_SAMPLE = 20_000
ORDINARY_DOCS = 2_000
PRIOR = 8.0
#: Uniform share in the random model's characters.
UNIFORM = 0.2
#: Natural log-likelihood ratio from which a candidate is a secret: in total, and for each character.
THRESHOLD = 12.0
PER_CHARACTER = 0.5


def _with_base(docs: DataFrame) -> DataFrame:
    text, low = F.col("text"), F.lower("text")
    worded = low.contains("passw") | low.contains("secret") | low.contains("token") | (low.contains("api") & low.contains("key"))
    assign = F.filter(match_spans(text, ASSIGN, worded), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= MIN_VALUE)
    access = F.filter(match_spans(text, ACCESS, text.contains("AKIA")), lambda x: F.length(x["m"]) >= MIN_ACCESS)
    hexes = match_spans(text, HEX, text.rlike(HEX))
    return docs.select("doc_id", "text", assign.alias("assign"), access.alias("access"), hexes.alias("hex"))


def _bigrams(strings: DataFrame) -> dict[tuple[int, int], float]:
    """Counts of (previous, next) character numbers; the previous of a first character is 66."""
    chars = strings.select(F.filter(F.transform(F.split("s", ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1), lambda i: i >= 0).alias("c"))
    pairs = chars.select(F.explode(F.transform("c", lambda x, i: F.struct(
        F.when(i == 0, F.lit(len(ALPHABET))).otherwise(F.get(F.col("c"), i - 1)).alias("a"), x.alias("b")))).alias("p"))
    rows = pairs.groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n")).collect()
    return {(r["a"], r["b"]): r["n"] for r in rows}


def train_models(docs: DataFrame) -> list[float]:
    """The log-likelihood ratio (random over ordinary) of each character given the one before, as a flat table."""
    base = _with_base(documents(docs))
    draw = F.xxhash64("doc_id", "text")
    is_marked = (F.size("assign") > 0) | (F.size("access") > 0) | (F.size("hex") > 0)
    marked = base.where(is_marked)
    values = F.concat(F.transform("assign", lambda x: F.regexp_extract(x["m"], ASSIGN, 2)), F.transform("access", lambda x: x["m"]),
                      F.transform("hex", lambda x: x["m"]))
    random = marked.select(draw.alias("draw"), F.explode(values).alias("s")).where(F.length("s") >= 12)
    random = random.groupBy("s").agg(F.min("draw").alias("draw")).orderBy("draw", "s").limit(RANDOM_SAMPLE)
    share = min(1.0, ORDINARY_DOCS / max(docs.count(), 1))
    plain = documents(docs).where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    plain = _with_base(plain).where(~is_marked)
    ordinary = plain.select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("s"))
    # a long mix of letters and digits is what is looked for, so it is no example of the ordinary
    mixed = F.col("s").rlike("[0-9]") & F.col("s").rlike("[A-Za-z]") & (F.length("s") >= 12)
    ordinary = ordinary.where(~mixed)
    counts = [_bigrams(random), _bigrams(ordinary)]
    if not counts[0] or not counts[1]:
        return [0.0] * (len(ALPHABET) * (len(ALPHABET) + 1))
    models = [_model(counts[0], UNIFORM), _model(counts[1])]
    return [math.log(r) - math.log(o) for r, o in zip(*models, strict=True)]


def _model(counts: dict[tuple[int, int], float], uniform: float = 0.0) -> list[float]:
    """P(next | previous) for all cells: bigram counts over a prior of ``PRIOR`` times the character's own share."""
    n = len(ALPHABET)
    before, single = defaultdict(float), defaultdict(float)
    for (a, b), k in counts.items():
        before[a] += k
        single[b] += k
    total = sum(single.values())
    share = [(1 - uniform) * (single[b] + 1) / (total + n) + uniform / n for b in range(n)]
    return [(counts.get((a, b), 0) + PRIOR * share[b]) / (before[a] + PRIOR) for a in range(n + 1) for b in range(n)]


def ratio(string: Column, table: list[float]) -> Column:
    """The summed log-likelihood ratio of a string of key characters."""
    n = len(ALPHABET)
    cells = literal_array([round(x, 6) for x in table], "double")
    codes = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return let(codes, lambda c: F.aggregate(
        F.transform(c, lambda x, i: F.coalesce(F.get(cells, F.when(i == 0, F.lit(n)).otherwise(F.get(c, i - 1)) * n + x), F.lit(0.0))),
        F.lit(0.0), lambda a, x: a + x))


def find_secrets(docs: DataFrame, table: list[float] | None = None, threshold: float = THRESHOLD, per_character: float = PER_CHARACTER) -> DataFrame:
    """Per row: doc_id, the text, and arrays of spans (s, e, m, before, after) ``assign access hex random``."""
    table = train_models(docs) if table is None else table
    base = _with_base(documents(docs))
    runs = F.filter(match_spans(F.col("text"), CANDIDATE, F.col("text").rlike(CANDIDATE)), lambda x: ratio(x["m"], table) >= F.greatest(
        F.lit(threshold), F.length(x["m"]) * per_character))
    return base.select("*", apart_from(runs, "assign", "access", "hex").alias("random"))


def redact(found: DataFrame, mark: str = "[secret]") -> DataFrame:
    """(doc_id, text) of ``find_secrets`` with every span replaced by ``mark``; overlapping spans count as one."""
    every = F.array_sort(F.concat(*[F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for k in KINDS]))
    cut = F.aggregate(
        every, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, x: F.when(x["s"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], x["e"]).alias("at"))).otherwise(
            F.struct(F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, x["s"] - a["at"]), F.lit(mark)).alias("out"), x["e"].alias("at"))))
    done = found.select("doc_id", "text", cut.alias("c"))
    return done.select("doc_id", F.concat("c.out", F.substring(F.col("text"), F.col("c.at") + 1, F.length("text"))).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    base = F.concat(*[tagged(F.col(k), i, True) for i, k in enumerate(KINDS[:3])])
    every = F.concat(*[tagged(F.col(k), i, True) for i, k in enumerate(KINDS)])
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base, KINDS, True).cast("binary"), 256).alias("base_sha256"), joined(every, KINDS, True).alias("spans"))


__all__ = ["find_secrets", "redact", "digest", "train_models", "ratio"]

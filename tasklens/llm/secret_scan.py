"""Secret scans with character Markov models, in built-in functions only.

Patterns find the base spans. Two models of character pairs, of random strings and of ordinary identifiers, then judge
long tokens outside them by the mean log-likelihood ratio of their pairs. The pattern matches of all documents are the
labelled random strings. The labelled identifiers are the tokens of all documents outside those matches that are not of
the shape that is judged, and samples of that shape: dated paths, versioned names and the like.
"""

from __future__ import annotations

import math
import random as chance
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.llm.staging import materialize

# The stated patterns, with the smallest length of the judged part.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # AKIA[A-Z0-9]+ of 18 or more characters
HEX = r"[0-9a-f]{16,}"  # [0-9a-f]+ of 16 or more
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = string.ascii_letters + string.digits + "+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}"
_BASE = len(ALPHABET) + 1
# A token whose rest without such ids is short is an ordinary name, however random the ids are.
UUID = r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
# Words that identifiers are often made of.
NAMES = """access account action address admin agent alert archive article asset audit backup balance batch blog book branch
    build cache calendar campaign catalog chapter client cloud code column comment company config content contract control
    country customer data date default delivery design detail device document domain download draft email error event export
    feature field file filter final finance folder form gallery group guide header history holiday home image import index
    input invoice item job journal key label language layout legal letter level library license list local log login main
    manager map market media member menu message meta method mobile model module month name network news note number object
    office order output owner package page panel part payment person photo plan policy post price print private process
    product profile project public query quote record region release remote report request result return review role route
    sale sample scan schema script search section server service session setting share sheet shop site size snapshot source
    state status stock storage store stream student style summary support survey system table tag task team template term
    test text theme thread ticket time title topic track trade train transfer travel type update upload user value vendor
    version video view volume web week widget window work year zone""".split()


def _spans(kind: int, matches: Column, gaps: Column, good) -> Column:
    """Where matches stand: each starts after the gaps and matches before it, counted in code points."""
    pairs = F.arrays_zip(gaps.alias("gap"), matches.alias("match"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,text:string>>").alias("out"))

    def step(state, pair):
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(F.coalesce(pair["match"], F.lit("")))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["match"].alias("text"))
        return F.struct(end.alias("at"), F.when(F.coalesce(good(pair["match"]), F.lit(False)),
                                                F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    return F.aggregate(pairs, empty, step, lambda s: s["out"])


def _found(kind: int, text: Column, pattern: str, good=lambda m: m.isNotNull()) -> Column:
    """Spans of the good ones among the leftmost matches that don't overlap."""
    spans = _spans(kind, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1), good)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,text:string>>"))


def _pairs(token: Column) -> Column:
    """Numbers of the character pairs of a token of at least two characters."""
    code = lambda at: F.instr(F.lit(ALPHABET), F.substring(token, at, F.lit(1)))
    return F.transform(F.sequence(F.lit(1), F.length(token) - 1), lambda i: code(i) * _BASE + code(i + 1))


def ordinary_names(n: int = 4000, seed: int = 1) -> list[str]:
    """Labelled identifiers of the judged shape: words put together with dates, versions and numbers."""
    r = chance.Random(seed)

    def one() -> str:
        words = [r.choice(NAMES) for _ in range(r.randrange(3, 6))]
        sep, y, m, d = r.choice("_-/"), r.randrange(1990, 2040), r.randrange(1, 13), r.randrange(1, 29)
        date = r.choice([f"{y}{sep}{m:02d}{sep}{d:02d}", f"{y}{m:02d}{d:02d}", f"{y}"])
        clock = f"{r.randrange(24):02d}{r.choice('-_')}{r.randrange(60):02d}{r.choice('-_')}{r.randrange(60):02d}"
        style = r.choice([str.lower, str.lower, str.lower, str.capitalize, str.upper])
        styled = [style(w) for w in words]
        return r.choice([
            f"/{styled[0]}/{y}/{m:02d}/{d:02d}/" + "-".join(styled[1:]), sep.join([styled[0], date, *styled[1:]]),
            sep.join([*styled, date]), sep.join([date, *styled]), sep.join(styled) + f"{sep}v{r.randrange(1, 30)}",
            f"{y}-{m:02d}-{d:02d}T{clock}" + sep + sep.join(styled[:2]), f"{styled[0]}{sep}{y}{m:02d}{d:02d}{sep}{r.randrange(10**6):06d}",
            words[0] + "".join(map(str.capitalize, words[1:])) + str(r.randrange(100)),
            "/".join(words) + f"/{r.randrange(100_000)}", f"{words[0]}={styled[1]}-{r.randrange(1000)}-{styled[2]}"])

    return [one() for _ in range(n)]


def pair_counts_of(tokens: list[str]) -> list[int]:
    """pair_counts of a few tokens."""
    counts = [0] * _BASE**2
    for token in tokens:
        codes = [ALPHABET.find(c) + 1 for c in token]
        for a, b in zip(codes, codes[1:], strict=False):
            counts[a * _BASE + b] += 1
    return counts


def mixed_counts(found: list[int], sampled: list[int], share: float = 0.5) -> list[float]:
    """Counts of both, those of the sample enlarged (never made less) to `share` of all."""
    scale = max(1.0, share / (1 - share) * sum(found) / max(1, sum(sampled)))
    return [f + scale * s for f, s in zip(found, sampled, strict=True)]


def pair_counts(tokens: DataFrame) -> list[int]:
    """How often each character pair stands in the tokens, in column `token`. The table has a fixed size."""
    rows = tokens.select(F.explode(_pairs(F.col("token"))).alias("pair")).groupBy("pair").count().collect()
    counts = [0] * _BASE**2
    for row in rows:
        counts[row["pair"]] = row["count"]
    return counts


def _chances(counts: list[float], prior: float = 5.0) -> list[list[float]]:
    """P(next | character), drawn to P(next) where a character was seen rarely."""
    rows = [counts[i * _BASE: (i + 1) * _BASE] for i in range(_BASE)]
    total = sum(counts) + 0.5 * _BASE
    single = [(sum(column) + 0.5) / total for column in zip(*rows, strict=True)]
    return [[(n + prior * p) / (sum(row) + prior) for n, p in zip(row, single, strict=True)] for row in rows]


def log_ratios(random: list[int], ordinary: list[float], even: float = 0.5) -> list[float]:
    """log P(next | character) under random strings over that under identifiers. Random strings are mixed with evenly
    distributed ones by the share `even`, as the samples need not use the whole alphabet."""
    return [math.log(even / _BASE + (1 - even) * p) - math.log(q)
            for a, b in zip(_chances(random), _chances(ordinary), strict=True) for p, q in zip(a, b, strict=True)]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_token: int = 20,
                 min_ratio: float = 1.5) -> DataFrame:
    """Spans that look like secrets, in code points with the end exclusive.

    Returns one row per input row: doc_id, base (spans of the patterns) and spans (those and the ones the models add),
    both sorted by start and kind; a span is a struct of start, kind (a number in KINDS), end and text. A token of at
    least `min_token` characters that touches no base span, and has a letter and a digit, is added if the mean log ratio
    of its pairs is at least `min_ratio`. Identifiers are learnt from the words of all documents.

    A null text counts as empty and has no spans. Without base matches the random model is even; without words so is the
    other. Repeated rows and null ids are scanned like others; other columns are ignored; no rows give no rows.
    """
    text = F.coalesce(F.col("_text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    long_enough = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]") & (
        F.length(F.regexp_replace(m, UUID, "")) >= min_token)
    base = F.concat(_found(0, text, ASSIGN, long_enough), _found(1, text, ACCESS), _found(2, text, HEX))
    found = materialize(rows.select(
        "doc_id", F.array_sort(base).alias("base"), _found(3, text, TOKEN % min_token, mixed).alias("tokens")))

    secret = F.when(F.col("s.kind") == 0, F.regexp_extract("s.text", ASSIGN, 2)).otherwise(F.col("s.text"))
    random = pair_counts(found.select(F.explode("base").alias("s")).select(secret.alias("token")))
    plain = text
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    # Tokens that are judged don't teach what is ordinary: there the samples stand in.
    words = F.filter(F.regexp_extract_all(plain, F.lit(TOKEN % 4), F.lit(0)),
                     lambda m: (F.length(m) < min_token) | ~(m.rlike("[0-9]") & m.rlike("[A-Za-z]")))
    words = pair_counts(rows.select(F.explode(words).alias("token")))
    ordinary = mixed_counts(words, pair_counts_of(ordinary_names()))

    table = F.split(F.lit(",".join(f"{r:.6f}" for r in log_ratios(random, ordinary))), ",").cast("array<double>")
    tokens = found.withColumn("_table", table)
    apart = lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    added = F.filter("tokens", lambda t: apart(t) & (
        F.aggregate(_pairs(t["text"]), F.lit(0.0), lambda s, p: s + F.element_at(F.col("_table"), p + 1))
        >= min_ratio * (F.length(t["text"]) - 1)))
    return tokens.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by a mark; spans that touch or overlap share one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, span):
        free = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        new = F.concat(state["out"], free, F.lit(mark))
        joined = (span["start"] <= state["at"]) & (state["at"] > 0)
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"),
                        F.when(joined, state["out"]).otherwise(new).alias("out"))

    return F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))

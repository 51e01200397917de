"""Secret scans: fixed patterns, and a battery of randomness tests.  DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.llm.common import text_of
from shelfline.session import materialize

# The patterns and least lengths of the base kinds, in their order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIN_ASSIGNED = 12
KINDS = ("assign", "access", "hex", "random")

# Candidates of the battery, and the shorter tokens that show what is ordinary.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ORDINARY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{2,15}+(?![A-Za-z0-9+/_=-])"

# Alphabets, the narrowest that holds a token being its encoding.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
# Digits of a written number are as random as those of a key: they are left out.
NOT_KEYS = ("decimal",)
LEVEL = 0.01  # of the battery: of random tokens about this share is taken for not random

# Characters of a token by number from 1, and their types.
_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_="
_UPPER, _LOWER, _DIGIT, _SIGN, _START = range(5)
# Shares of the ordinary model that take any type after any other, as names in code do, and any letter after any other, as
# words of languages do that the documents lack; and what its counts start with.
_ANY_TYPE, _ANY_LETTER, _PRIOR = 0.3, 0.3, 100.0
_PRIOR_TYPES = {  # from: to upper, lower, digit, sign
    _START: (0.15, 0.8, 0.04, 0.01), _UPPER: (0.2, 0.7, 0.05, 0.05), _LOWER: (0.03, 0.9, 0.03, 0.04),
    _DIGIT: (0.05, 0.1, 0.75, 0.1), _SIGN: (0.2, 0.5, 0.2, 0.1)}


def _hits(kind: str, pattern: str, ok: Column | None = None) -> Column:
    """The matches of one kind in order, each with the length of the gap before it.

    Splitting at a pattern and extracting it walk the same leftmost matches, so
    gap and match lengths add up to positions without a position function.
    """
    gaps, found = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))

    def row(hit: Column, k: Column) -> Column:
        passed = F.length(F.regexp_extract(hit, pattern, 2)) >= MIN_ASSIGNED if kind == "assign" else F.lit(True)
        return F.struct(
            F.lit(kind).alias("kind"), k.alias("k"), F.length(F.get(gaps, k)).alias("gap"), F.length(hit).alias("len"),
            passed.alias("ok"), F.when(F.lit(kind == "random"), hit).alias("token"),
        )

    empty = F.array().cast("array<struct<kind:string,k:int,gap:int,len:int,ok:boolean,token:string>>")
    return F.when(F.col("text").rlike(pattern), F.transform(found, row)).otherwise(empty)


def _upper_tail(z: Column) -> Column:
    """P(N > z) for z >= 0, by the continued fraction of the normal tail (relative error below 1 %)."""
    density = F.exp(-z * z / 2) / 2.5066282746310002
    fraction = z
    for k in range(12, 0, -1):
        fraction = z + F.lit(float(k)) / F.greatest(fraction, F.lit(0.05))
    return F.when(z < 0.3, 0.5 - z * 0.3989422804014327 * (1 - z * z / 6)).otherwise(density / fraction)


def randomness(tokens: DataFrame) -> DataFrame:
    """Adds encoding and p_random to rows with ``token``.

    Three tests of "the characters are independent and uniform over the encoding's
    alphabet": chi-squared (Wilson-Hilferty), runs about the middle of the
    alphabet, and lag-1 serial correlation, the last two on both sides.  p_random is the least of the
    three p-values times three.
    """
    body = F.rtrim(F.translate("token", "=", " "))
    rows = tokens.withColumn("_body", F.replace(body, F.lit(" "), F.lit("")))
    encoding, letters = F.lit("base64"), F.lit(ALPHABETS["base64"])
    for name, chars in reversed(ALPHABETS.items()):
        fits = F.col("_body").rlike(f"^[{chars}]+$") if name != "base64" else F.lit(True)
        encoding, letters = F.when(fits, name).otherwise(encoding), F.when(fits, chars).otherwise(letters)
    rows = rows.withColumns({"encoding": encoding, "_letters": letters})
    size = F.when(F.col("encoding") == "base64", 64.0).otherwise(F.length("_letters").cast("double"))
    # a token of nothing but padding has no characters to test
    rows = rows.withColumns({"_n": F.greatest(F.length("_body"), F.lit(2)).cast("double"), "_k": size})
    rows = rows.withColumn("_x", F.filter(
        F.transform(F.split("_body", ""), lambda c: F.instr(F.col("_letters"), c)), lambda v: v > 0))
    squares = F.aggregate(
        F.array_distinct(F.split("_body", "")), F.lit(0.0),
        lambda total, c: total + F.when(c == "", 0.0).otherwise(F.pow(
            F.length("_body") - F.length(F.replace(F.col("_body"), c, F.lit(""))), F.lit(2.0))),
    )
    chi = F.col("_k") / F.col("_n") * F.col("_squares") - F.col("_n")
    df = F.col("_k") - 1
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    mean = F.aggregate("_x", F.lit(0.0), lambda t, v: t + v) / F.col("_n")
    rows = rows.withColumns({"_squares": squares, "_mean": mean})
    pairs = F.transform("_x", lambda v, i: F.struct(v.alias("v"), F.get("_x", i + 1).alias("w")))
    pairs = F.filter(pairs, lambda p: p["w"].isNotNull())
    middle = F.col("_k") / 2
    rows = rows.withColumns({
        "_var": F.aggregate("_x", F.lit(0.0), lambda t, v: t + (v - F.col("_mean")) * (v - F.col("_mean"))),
        "_cov": F.aggregate(pairs, F.lit(0.0), lambda t, p: t + (p["v"] - F.col("_mean")) * (p["w"] - F.col("_mean"))),
        "_high": F.size(F.filter("_x", lambda v: v > middle)).cast("double"),
        "_runs": F.size(F.filter(pairs, lambda p: (p["v"] > middle) != (p["w"] > middle))) + F.lit(1.0),
    })
    low = F.col("_n") - F.col("_high")
    cross = 2 * F.col("_high") * low
    runs_var = cross * (cross - F.col("_n")) / (F.col("_n") * F.col("_n") * (F.col("_n") - 1))
    z_runs = F.when(runs_var > 0, F.abs(F.col("_runs") - cross / F.col("_n") - 1) / F.sqrt(runs_var)).otherwise(9.0)
    z_serial = F.when(F.col("_var") > 0, F.abs(F.col("_cov") / F.col("_var") + 1 / F.col("_n")) * F.sqrt("_n")).otherwise(9.0)
    rows = rows.withColumns({"_z1": z_chi, "_z2": z_runs, "_z3": z_serial})
    p1 = F.when(F.col("_z1") > 0, _upper_tail(F.col("_z1"))).otherwise(F.lit(0.5))
    both = [2 * _upper_tail(F.col(z)) for z in ("_z2", "_z3")]
    p = F.when(F.length("_body") < 2, 0.0).otherwise(F.least(F.lit(1.0), 3 * F.least(p1, *both)))
    return rows.withColumn("p_random", p).select(*tokens.columns, "encoding", "p_random")


def _type(v: int) -> int:
    return _START if v == 0 else _UPPER if v <= 26 else _LOWER if v <= 52 else _DIGIT if v <= 62 else _SIGN


def _letter(v: int) -> int:
    return (v - 1) % 26 + 1 if 0 < v <= 52 else 0


def _before(prev: int, v: int) -> int:
    """The letter that ``v`` follows in its word; 0 where a word begins, as at a capital behind a small letter."""
    return 0 if _type(prev) == _LOWER and _type(v) == _UPPER else _letter(prev)


def ordinary_pairs(texts: DataFrame) -> dict[tuple[int, int], int]:
    """How often a character (by number; 0 is the beginning) is followed by another in the short tokens of all ``texts``.

    Tokens are counted first, so a word costs one row per task; what comes to the
    driver are the counts of at most 68 x 67 pairs.
    """
    tokens = texts.select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("token")).groupBy("token").agg(
        F.count("*").alias("n"))
    numbers = F.transform(F.split("token", ""), lambda c: F.instr(F.lit(_CHARS), c))
    numbers = F.filter(numbers, lambda v: v > 0)
    pairs = tokens.withColumn("_v", numbers).select("n", F.explode(F.transform("_v", lambda v, i: F.struct(
        F.coalesce(F.get("_v", i - 1), F.lit(0)).alias("a"), v.alias("b")))).alias("p"))
    return {(r["a"], r["b"]): r["n"] for r in pairs.groupBy("p.a", "p.b").agg(F.sum("n").alias("n")).collect()}


def ordinary_model(pairs: Mapping[tuple[int, int], int]) -> list[float]:
    """Log-probabilities of each character after each other in ordinary tokens, as a table of 68 x 68 numbers.

    The type comes first (capital, small letter, digit, sign, given the type before), then the letter
    given the one before in its word, whatever their case.
    """
    types = {t: [_PRIOR * p for p in shares] for t, shares in _PRIOR_TYPES.items()}
    letters = [[_PRIOR / 26] * 27 for _ in range(27)]
    for (a, b), n in pairs.items():
        types[_type(a)][_type(b)] += n
        if _letter(b):
            letters[_before(a, b)][_letter(b)] += n
    table = [0.0] * (68 * 68)
    for a in range(68):
        for b in range(1, 68):
            share = types[_type(a)]
            kind = (1 - _ANY_TYPE) * share[_type(b)] / sum(share) + _ANY_TYPE / 4
            if _letter(b):
                row = letters[_before(a, b)]
                inside = (1 - _ANY_LETTER) * row[_letter(b)] / sum(row[1:]) + _ANY_LETTER / 26
            else:
                inside = 0.1 if _type(b) == _DIGIT else 0.2
            table[68 * a + b] = math.log(kind) + math.log(inside)
    return table


def ordinary_chance(tokens: DataFrame, model: list[float]) -> DataFrame:
    """Adds p_ordinary to rows with ``token`` and ``encoding``: a bound on the chance that an ordinary token looks as random.

    The likelihood of the token under uniform characters of an encoding over that under the ordinary model
    is, in ordinary tokens, 1 on the average, so it exceeds x at most once in x.  The encoding is chosen
    after looking, which costs their number.
    """
    numbers = F.filter(F.transform(F.split("token", ""), lambda c: F.instr(F.lit(_CHARS), c)), lambda v: v > 0)
    rows = tokens.withColumn("_v", numbers)
    places = F.transform("_v", lambda v, i: F.coalesce(F.get("_v", i - 1), F.lit(0)) * 68 + v)
    table = F.lit(model)
    ordinary = F.aggregate(places, F.lit(0.0), lambda total, at: total + F.get(table, at.cast("int")))
    sizes = F.create_map(*[x for name, chars in ALPHABETS.items() for x in (F.lit(name), F.lit(float(64 if name == "base64" else len(chars))))])
    uniform = -F.log(sizes[F.col("encoding")]) * F.size("_v")
    p = F.least(F.lit(1.0), F.exp(F.lit(math.log(len(ALPHABETS))) - (uniform - ordinary)))
    return rows.withColumn("p_ordinary", p).drop("_v")


def _cutoffs(tested: DataFrame, rate: float) -> DataFrame:
    """Largest p_ordinary of each length class that is a find at false-discovery ``rate``.

    Benjamini-Hochberg within classes of like length (by octave): short tokens give weaker
    evidence, and their number shall not loosen or tighten the bound for long ones.  p is counted in steps
    of 0.05 of its logarithm, so a class has at most 1,000 counts whatever it holds.
    """
    steps = tested.groupBy("octave", "step").agg(F.count("*").alias("n"), F.max("p_ordinary").alias("p"))
    group = Window.partitionBy("octave")
    upto = group.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = steps.withColumns({"rank": F.sum("n").over(upto), "all": F.sum("n").over(group)})
    return ranked.filter(F.col("p") <= F.lit(rate) * F.col("rank") / F.col("all")).groupBy("octave").agg(F.max("p").alias("cutoff"))


def scan(docs: DataFrame, rate: float = 0.01) -> DataFrame:
    """All secrets of each document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Base kinds are leftmost matches of fixed patterns.  Every other token of 16 or more
    characters is a candidate.  The battery infers its encoding and tests whether its characters are independent and
    uniform; what fails is no key.  For the others the chance is bounded that an ordinary token, as the
    short tokens of all documents show them, looks as random, and those below the bound of false-discovery
    control at ``rate``, by length class, are added as kind ``random`` where they overlap no base
    span: of what is added, about ``rate`` is ordinary.  Numbers are not added.  ``spans`` lists kind:start:end by start, code
    points, end exclusive.

    Each text is read once and only its hits go on.  Positions are running sums over the hits
    of one row.  Null or empty texts give zero counts and empty lists, rows that
    repeat are scanned each, and no rows give no rows.
    """
    texts = docs.select("doc_id", text_of().alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = materialize(texts.select("doc_id", "row", F.concat(
        _hits("assign", ASSIGN), _hits("access", ACCESS), _hits("hex", HEX), _hits("random", TOKEN)).alias("hits")))
    hits = rows.filter(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.*")
    in_text = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    spans = hits.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(in_text))
    spans = spans.withColumn("start", F.col("end") - F.col("len")).filter("ok")
    # farthest end of the base spans before, and nearest start of those after
    placed = spans.withColumn("order", F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")))
    base = F.col("kind") != "random"
    along = Window.partitionBy("row").orderBy("start", "order")
    placed = placed.withColumns({
        "_end_before": F.max(F.when(base, F.col("end"))).over(along.rowsBetween(Window.unboundedPreceding, -1)),
        "_start_after": F.min(F.when(base, F.col("start"))).over(along.rowsBetween(1, Window.unboundedFollowing)),
    })
    clear = (F.coalesce(F.col("_end_before"), F.lit(0)) <= F.col("start")) & (
        F.col("_start_after").isNull() | (F.col("_start_after") >= F.col("end")))
    placed = materialize(placed.filter(base | clear).select("row", "kind", "order", "start", "end", "token"))
    model = ordinary_model(ordinary_pairs(texts))
    tested = ordinary_chance(randomness(placed.filter("kind = 'random'")), model).withColumns({
        "octave": F.floor(F.log2(F.col("end") - F.col("start"))),
        "step": F.least(F.lit(999), F.floor(-20 * F.log(F.greatest(F.col("p_ordinary"), F.lit(1e-21))))),
    })
    tested = materialize(tested)
    # one row for each octave
    random = tested.join(F.broadcast(_cutoffs(tested, rate)), "octave").filter(
        (F.col("p_ordinary") <= F.col("cutoff")) & (F.col("p_random") > LEVEL) & ~F.col("encoding").isin(*NOT_KEYS))
    final = placed.filter("kind <> 'random'").drop("token").unionByName(random.select("row", "kind", "order", "start", "end"))
    written = F.concat_ws(":", "kind", "start", "end")
    gathered = final.groupBy("row").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS],
        F.sort_array(F.collect_list(F.struct("start", "order", "kind", written.alias("s")))).alias("all"),
    )
    joined = rows.select("row", "doc_id").join(gathered, "row", "left")
    everything = F.coalesce(F.col("all"), F.array().cast("array<struct<start:bigint,order:bigint,kind:string,s:string>>"))
    only_base = F.transform(F.filter(everything, lambda x: x["kind"] != "random"), lambda x: x["s"])
    count = {k: F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS}
    return joined.select(
        "doc_id", count["assign"], count["access"], count["hex"],
        F.sha2(F.array_join(only_base, ","), 256).alias("base_sha256"),
        F.array_join(F.transform(everything, lambda x: x["s"]), ",").alias("spans"), count["random"],
    )

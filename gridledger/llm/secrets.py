"""Secret scan: fixed patterns, and a battery of randomness tests on long tokens. DataFrame functions only.

Every run of 16 or more key characters is a token. Its encoding is inferred (digits, hex, base 32, letters,
letters with digits, base 64), which gives the alphabet. Three tests follow: chi-squared distance from an
even use of the alphabet, the number of runs of character classes, and the serial correlation of neighbouring
characters. The null hypothesis is written language: uneven letters, few changes of class. How far a token
departs from it towards randomness gives a p-value; serial correlation takes from it, as counting sequences
are even but not random.

Tokens are judged together with false-discovery control (Benjamini and Hochberg), in strata of length, since
short tokens are many and prove little. The control needs the ranks of p-values over the whole corpus; they
come from a histogram of fixed bins, a few hundred numbers at any size.

Defined cases: a null text is empty; every row, repeated ones too, gives one row; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import clean_text, stage_table

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A shorter run of the same characters holds no longer one, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
#: Every long enough run, from its first character; runs of ACCESS and HEX lie inside.
TOKEN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
#: What a text must hold for ASSIGN, in lower case.
KEYWORDS = ("password", "passwd", "secret", "token", "api")

#: Encodings in order: pattern, size of the alphabet, and how uneven language in it is (sum of squared shares). Those of
#: letters were measured, like CLASS_CHANGES, on names made of the words of licences.TEMPLATES (snake, camel, kebab and
#: upper case, some with numbers). Words make such names vary more than single characters drawn alike would;
#: DISPERSION is by how much, so that of such names no more than a share p gets a p-value of p or less.
ENCODINGS = (
    (r"^[0-9]+$", 10, 0.16),
    (r"^(?:[0-9a-f]+|[0-9A-F]+)$", 16, 0.19),
    (r"^[A-Z2-7]+=*$", 32, 0.075),
    (r"^(?:[a-z]+|[A-Z]+)$", 26, 0.060),
    (r"^(?:[a-z0-9]+|[A-Z0-9]+)$", 36, 0.055),
    (r"^[A-Za-z0-9]+$", 62, 0.047),
    (r"", 64, 0.062),
)
CLASS_CHANGES = 0.08
DISPERSION = 1.5
STRATA = (24, 32, 48, 96)
BINS = 400  # of a tenth of a decade each


def _let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(text: Column, found: Column, pattern: str, kind: int, fits: Column | None = None) -> Column:
    """Spans (start, kind, stop, text) of all matches, from the lengths of what lies between and of the matches."""
    between = F.split(text, pattern, -1)
    rows = F.arrays_zip(F.transform(F.slice(between, 1, F.size(found)), F.length).alias("gap"), found.alias("text"), (fits if fits is not None else F.transform(found, lambda v: F.lit(True))).alias("fits"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        stop = start + F.length(x["text"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), x["text"].alias("text"))
        return F.struct(stop.alias("at"), F.when(x["fits"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(rows, F.struct(F.lit(0).alias("at"), _no_spans().alias("out")), step, lambda acc: acc["out"])


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,stop:int,text:string>>")


def log_p(s: Column) -> Column:
    """-log10 of the p-value that a token is written language."""
    encoding = F.lit(len(ENCODINGS) - 1)
    for i, (pattern, _, _) in reversed(list(enumerate(ENCODINGS[:-1]))):
        encoding = F.when(s.rlike(pattern), F.lit(i)).otherwise(encoding)
    # Runs: adjacent characters of unlike class. Each run is written as one sign; words of a name are one run.
    # No pattern repeats a group, which would need stack in proportion to a token's length.
    classes = s
    for pattern, sign in (("[A-Z]?[a-z]+[_-]?", "a"), ("a+", "a"), ("[A-Z]+[_-]?", "B"), ("B+", "B"), ("[0-9]+", "0"), ("[^aB0]+", "-")):
        classes = F.regexp_replace(classes, pattern, sign)
    chars = F.split(s, "")
    start = F.struct(*[F.lit(0.0).alias(k) for k in ("before", "sum", "squares", "products")])
    moments = F.aggregate(
        F.transform(chars, lambda c: F.ascii(c).cast("double")),
        start,
        lambda acc, x: F.struct(x.alias("before"), (acc["sum"] + x).alias("sum"), (acc["squares"] + x * x).alias("squares"), (acc["products"] + acc["before"] * x).alias("products")),
    )
    even = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc + F.pow((F.length(s) - F.length(F.replace(s, c, F.lit("")))).cast("double"), F.lit(2.0)))
    facts = F.struct(F.length(s).cast("double").alias("n"), encoding.alias("e"), (F.length(classes) - 1).alias("changes"), moments.alias("m"), even.alias("even"), F.ascii(F.substring(s, 1, 1)).cast("double").alias("first"), F.ascii(F.substring(s, -1, 1)).cast("double").alias("last"))
    return _let(facts, _evidence)


def _evidence(f: Column) -> Column:
    """-log10 p from a token's counts: the tests' distances in standard deviations, summed and turned into a tail."""
    n = f["n"]
    size = F.element_at(F.array(*[F.lit(float(a)) for _, a, _ in ENCODINGS]), f["e"] + 1)
    uneven = F.element_at(F.array(*[F.lit(q) for _, _, q in ENCODINGS]), f["e"] + 1)
    distance = size * f["even"] / n - n
    excess = (n - 1) * (size * uneven - 1)
    z_even = (size - 1 + excess - distance) / F.sqrt(2 * (size - 1) + 4 * excess)
    z_runs = (f["changes"] - (n - 1) * CLASS_CHANGES) / F.sqrt(F.greatest(n - 1, F.lit(1.0)) * CLASS_CHANGES * (1 - CLASS_CHANGES))
    mean = f["m"]["sum"] / n
    spread = f["m"]["squares"] - n * mean * mean
    serial = F.when(spread > 1e-9, (f["m"]["products"] - mean * (2 * f["m"]["sum"] - f["first"] - f["last"]) + (n - 1) * mean * mean) / spread).otherwise(F.lit(1.0))
    clip = lambda z: F.greatest(F.lit(-6.0), F.least(F.lit(6.0), z))
    z = ((clip(z_even) + clip(z_runs)) / F.sqrt(F.lit(2.0)) - F.greatest(F.lit(0.0), F.abs(serial) * F.sqrt(n) - 3)) / DISPERSION
    # The tail of the normal distribution, by its logistic approximation.
    return _let(z, lambda v: F.log(1 + F.exp(F.least(F.lit(600.0), 1.5976 * v + 0.070565 * v * v * v))) / F.log(F.lit(10.0)))


def _stratum(n: Column) -> Column:
    return sum((F.when(n >= s, 1).otherwise(0) for s in STRATA), F.lit(0))


def discovery_bins(scored: DataFrame, alpha: float) -> list[int]:
    """For each stratum of length, the least bin of -log10 p (in tenths) whose tokens are discoveries."""
    tested = scored.select(F.explode("tokens").alias("t")).select(_stratum(F.col("t.stop") - F.col("t.start")).alias("stratum"), F.least(F.lit(BINS), F.floor(F.col("t.log_p") * 10)).alias("bin"))
    counts = tested.groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n")).collect()  # at most strata x bins
    least = []
    for s in range(len(STRATA) + 1):
        own = sorted(((r["bin"], r["n"]) for r in counts if r["stratum"] == s), reverse=True)
        total, seen, cut = sum(n for _, n in own), 0, BINS + 1
        for b, n in own:
            seen += n
            if 10 ** (-b / 10) <= alpha * seen / total:  # the largest p of the bin
                cut = b
        least.append(int(cut))
    return least


def scan(docs: DataFrame, alpha: float = 0.001) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, code points)."""
    text = F.col("text")
    lower = F.lower(text)
    named = lower.contains(KEYWORDS[0])
    for word in KEYWORDS[1:]:
        named = named | lower.contains(word)
    # One pass of each text finds the long runs; the other patterns are tried only where they can match.
    rows = docs.select("doc_id", clean_text().alias("text")).withColumns({"runs": F.regexp_extract_all(text, F.lit(TOKEN), 0), "named": named})
    runs = F.col("runs")
    whole = lambda pattern: F.regexp_extract_all(text, F.lit(pattern), 0)
    long_values = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), 1), lambda v: F.length(v) >= 6)
    bare = lambda spans: F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop")))
    rows = rows.select(
        "doc_id",
        bare(F.when(F.col("named"), _spans(text, whole(ASSIGN), ASSIGN, 0, long_values)).otherwise(_no_spans())).alias("assign"),
        bare(F.when(F.exists(runs, lambda r: r.contains("AKIA")), _spans(text, whole(ACCESS), ACCESS, 1)).otherwise(_no_spans())).alias("access"),
        bare(F.when(F.exists(runs, lambda r: r.rlike(HEX)), _spans(text, whole(HEX), HEX, 2)).otherwise(_no_spans())).alias("hex"),
        F.transform(
            F.when(F.size(runs) > 0, _spans(text, runs, TOKEN, 3)).otherwise(_no_spans()),
            lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), log_p(x["text"]).alias("log_p")),
        ).alias("tokens"),
    )
    scored = stage_table(rows, "secret-tokens")
    least = discovery_bins(scored, alpha)
    base = F.array_sort(F.concat("assign", "access", "hex"))
    bins = F.array(*[F.lit(b) for b in least])

    def found(t: Column) -> Column:
        high = F.least(F.lit(BINS), F.floor(t["log_p"] * 10)) >= F.element_at(bins, _stratum(t["stop"] - t["start"]) + 1)
        return high & ~F.exists("base", lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"]))

    own = F.transform(F.filter("tokens", found), lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["stop"].alias("stop")))
    names = F.array(*[F.lit(k) for k in KINDS])
    say = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["stop"].cast("string"))))
    return scored.withColumn("base", base).withColumn("all", F.array_sort(F.concat("base", own))).select(
        "doc_id",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.sha2(say(F.col("base")), 256).alias("base_sha256"),
        say(F.col("all")).alias("spans"),
    )

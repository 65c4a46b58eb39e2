"""Secret scans: fixed patterns, and random strings found by a battery of randomness tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetext.llm.common import LONG, find_all, kept, let, span_text, text_of

# The base patterns, as pattern for the search (possessive, so that
# long runs cost linear time, with the same matches) and condition on a match.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=-]++"""
)
ASSIGN_VALUE = r"[A-Za-z0-9+/_.=-]{8,}$"
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
KINDS = ("assign", "access", "hex", "random")

# A candidate for the tests: a whole run of these characters, with a digit and a letter.
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"

# Encodings tried in this order: name, what all characters must be, alphabet in order.
DIGITS, UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^[0-9a-z]+$", DIGITS + UPPER.lower()),
    ("BASE36", "^[0-9A-Z]+$", DIGITS + UPPER),
    ("base62", "^[0-9A-Za-z]+$", DIGITS + UPPER + UPPER.lower()),
    ("base64", "^.*$", UPPER + UPPER.lower() + DIGITS + "+/-_="),
)

# Length classes of the false-discovery control, the least number of candidates that make one of its own, and steps
# of the p-values in it. Candidates below one step have structure in any case.
CLASSES = (20, 32, 48, 80)
LEAST_IN_CLASS = 50
STEPS = 1000


def base_spans(text: Column) -> Column:
    """array<struct<kind_no, start, end, m>> of the fixed patterns, in order of start, then kind."""

    def named(no: int, spans: Column, test) -> Column:
        good = F.filter(spans, test) if test else spans
        return F.transform(
            good, lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("no"), s["end"].alias("end"))
        )

    assign = named(0, find_all(text, ASSIGN), lambda s: F.regexp_like(_value(s["m"]), F.lit("^" + ASSIGN_VALUE)))
    access, hexes = named(1, find_all(text, ACCESS), None), named(2, find_all(text, HEX), None)
    return F.array_sort(F.concat(assign, access, hexes))


def _value(m: Column) -> Column:
    """Group 2 of an assign match: what follows the sign, spaces and quote."""
    return F.regexp_extract(m, r"""^[^:="'\x20]+["']?\x20*[:=]\x20*["']?(.*)$""", 1)


def _two_sided(z: Column) -> Column:
    """P(|Z| >= |z|) of a normal Z, by a rational approximation (error below 2e-7)."""

    def tail(x: Column, t: Column) -> Column:
        poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), poly * F.exp(-x * x)))

    return let(F.abs(z) / F.sqrt(F.lit(2.0)), lambda x: let(1 / (1 + 0.3275911 * x), lambda t: tail(x, t)))


def _one_sided(z: Column) -> Column:
    """P(Z >= z)."""
    return let(z, lambda v: let(_two_sided(v) / 2, lambda half: F.when(v > 0, half).otherwise(1 - half)))


def battery(m: Column) -> Column:
    """struct<encoding, p>: p is the combined p-value under the hypothesis that
    ``m`` is drawn evenly from the alphabet of its encoding; small p means structure.

    Four tests: chi-squared over the alphabet and over its kinds of
    characters (digits, capitals, small letters, the rest), runs above and below its
    middle, correlation of neighbours; all but the second with moments that are
    exact for every length. The least of k even p-values has 1 - (1 - least)**k
    even again; the tests depend on one another a little, so they count as three quarters of a test less.
    """
    encoding, alphabet = F.lit(ENCODINGS[-1][0]), F.lit(ENCODINGS[-1][2])
    for name, rule, letters in reversed(ENCODINGS[:-1]):
        fits = F.regexp_like(m, F.lit(rule))
        encoding, alphabet = F.when(fits, name).otherwise(encoding), F.when(fits, letters).otherwise(alphabet)
    n, k = F.length(m).cast("double"), F.length(alphabet).cast("double")
    chars = F.split(m, "")
    chars = F.array_remove(chars, "")
    zero = F.lit(0.0)
    squares = F.aggregate(
        F.array_distinct(chars),
        zero,
        lambda acc, c: acc + F.pow((F.length(m) - F.length(F.replace(m, c, F.lit("")))).cast("double"), F.lit(2.0)),
    )
    chi = (squares * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    kinds, kind_of = F.lit(0.0), F.lit(-1.0)
    for letters in ("0-9", "A-Z", "a-z", "+/_=-"):
        here = F.length(F.regexp_replace(m, f"[^{letters}]", "")).cast("double")
        wanted = n * F.length(F.regexp_replace(alphabet, f"[^{letters}]", "")) / k
        kinds = kinds + F.when(wanted > 0, (here - wanted) * (here - wanted) / wanted).otherwise(0.0)
        kind_of = kind_of + (wanted > 0).cast("double")
    # chi-squared with few degrees of freedom to a normal one, by its cube root
    cube = F.when(kind_of > 0, (F.pow(kinds / kind_of, F.lit(1 / 3)) - 1 + 2 / (9 * kind_of)) / F.sqrt(2 / (9 * kind_of)))
    by_kind = F.when(kind_of > 0, _one_sided(cube)).otherwise(F.lit(1.0))
    start = F.struct(
        zero.alias("s"), zero.alias("ss"), zero.alias("sp"), zero.alias("up"), zero.alias("runs"),
        F.lit(-1.0).alias("last"), F.lit(-1.0).alias("first"),
    )

    def step(a: Column, c: Column) -> Column:
        v = F.instr(alphabet, c).cast("double")
        high = v > k / 2
        new_run = (a["last"] < 0) | (high != (a["last"] > k / 2))
        return F.struct(
            (a["s"] + v).alias("s"),
            (a["ss"] + v * v).alias("ss"),
            F.when(a["last"] < 0, zero).otherwise(a["sp"] + v * a["last"]).alias("sp"),
            (a["up"] + high.cast("double")).alias("up"),
            (a["runs"] + new_run.cast("double")).alias("runs"),
            v.alias("last"),
            F.when(a["first"] < 0, v).otherwise(a["first"]).alias("first"),
        )

    def finish(a: Column) -> Column:
        up, down = a["up"], n - a["up"]
        mean = 2 * up * down / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs = F.when(var > 0, (a["runs"] - mean) / F.sqrt(var)).otherwise(F.lit(9.0))
        # circular correlation: mean -1/(n-1), variance close to 1/(n-1)
        spread = a["ss"] - a["s"] * a["s"] / n
        r = (a["sp"] + a["last"] * a["first"] - a["s"] * a["s"] / n) / spread
        serial = F.when(spread > 0, (r + 1 / (n - 1)) * F.sqrt(n - 1)).otherwise(F.lit(9.0))
        least = F.least(_two_sided(chi), by_kind, _two_sided(runs), _two_sided(serial))
        tests = F.lit(2.25) + (kind_of > 0).cast("int")
        return F.struct(encoding.alias("encoding"), (1 - F.pow(1 - least, tests)).alias("p"))

    return F.aggregate(chars, start, step, finish)


def thresholds(counts: list, q: float) -> dict[int, int]:
    """Per length class the step that a reported candidate must exceed, from rows ``c, p, n`` (class, step,
    candidates): at most len(CLASSES) * (STEPS + 1) numbers, however many candidates there are."""
    by_class: dict[int, list[int]] = {}
    for c, p, n in counts:
        by_class.setdefault(c, [0] * (STEPS + 1))[min(max(p, 0), STEPS)] += n
    few = [c for c, steps in by_class.items() if sum(steps) < LEAST_IN_CLASS]
    shared = [sum(by_class[c][p] for c in few) for p in range(STEPS + 1)]
    alone = sum(shared) < LEAST_IN_CLASS
    together = round(q * STEPS) if alone else _threshold(shared, q)
    return {c: together if c in few else _threshold(steps, q) for c, steps in by_class.items()}


def _threshold(steps: list[int], q: float) -> int:
    upper = sum(steps[STEPS // 2 + 1 :])
    random = 2 * (upper + upper**0.5)
    above = sum(steps[2:])
    for t in range(1, STEPS):
        if above - random * (1 - t / STEPS) <= q * above:
            return t
        above -= steps[t + 1]
    return STEPS


def scan(docs: DataFrame, q: float = 0.05, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` and ``random``, arrays of
    struct<start, no, end> (no: place in ``KINDS``).

    A candidate is reported as random if its p-value is above the bound of its
    length class, and the bounds keep the share of structured strings among the
    reported ones near ``q`` (as near as the number of candidates allows to estimate): p-values of random strings are even, those of
    others lie near 0. So twice the candidates above 1/2, and a standard
    deviation more, are an estimate of the random ones, ``1 - t`` of these lie
    above t, and what else lies there is false. The bound is the least t (one step at least) at which the false ones
    are ``q`` of the reported ones; without one nothing is reported. Classes
    with few candidates share a bound; where all of them are too few to
    estimate anything, it is ``q`` itself. P-values are rounded up to
    1/``STEPS``, so the rule needs one small table of counts and no order of all
    candidates.

    Null texts are empty; repeated rows each get a row and count in the rule.
    The text is read once; counts are combined before the shuffle.
    """
    body = text_of(text)
    candidates = F.filter(
        find_all(body, RUN),
        lambda s: F.regexp_like(s["m"], F.lit("[0-9]")) & F.regexp_like(s["m"], F.lit("[A-Za-z]")),
    )
    tested = F.transform(
        candidates,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.ceil(battery(s["m"])["p"] * STEPS).cast("int").alias("p")
        ),
    )
    rows = docs.select("doc_id", base_spans(body).alias("base"), tested.alias("tested"))
    rows = kept(rows, "secrets")

    def size_class(s: Column) -> Column:
        n = s["end"] - s["start"]
        return sum(((n >= c).cast("int") for c in CLASSES), F.lit(0))

    each = rows.select(F.explode("tested").alias("t")).select(size_class(F.col("t")).alias("c"), F.col("t.p").alias("p"))
    counts = each.groupBy("c", "p").agg(F.count("*").alias("n"))
    # at most len(CLASSES) * (STEPS + 1) rows from here on
    bounds = thresholds(counts.collect(), q)

    def bound(s: Column) -> Column:
        out = F.lit(STEPS)
        for c, t in bounds.items():
            out = F.when(size_class(s) == c, F.lit(t)).otherwise(out)
        return out

    free = F.filter(
        F.col("tested"),
        lambda s: (s["p"] > bound(s))
        & ~F.exists(F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    random = F.transform(free, lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("no"), s["end"].alias("end")))
    return rows.select("doc_id", "base", random.alias("random"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash and text of the spans of ``scan``."""
    names = F.array(*[F.lit(k) for k in KINDS])
    line = lambda spans: F.array_join(F.transform(spans, lambda s: span_text(F.get(names, s["no"]), s)), ",")
    count = lambda no: F.size(F.filter("base", lambda s: s["no"] == no)).cast(LONG)
    return found.select(
        "doc_id",
        *[count(no).alias(f"n_{KINDS[no]}") for no in range(3)],
        F.sha2(line(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        line(F.array_sort(F.concat("base", "random"))).alias("spans"),
        F.size("random").cast(LONG).alias("n_random"),
    )

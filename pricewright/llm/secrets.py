"""Secret scans: fixed patterns, and a battery of randomness tests.

Long tokens are tested against the alphabet of their inferred encoding: a
chi-squared test of uniform symbols, a runs test around the middle of the
alphabet and a serial test: lag-one correlation, replaced by the number of
equal symbol pairs where that number is next to impossible. The combined
p-value is uniform for random tokens and near zero for ordinary ones. Per
encoding and length band, the distribution of p-values over the distinct tokens
of the whole corpus tells which share of those above a threshold is not random;
tokens are reported where that false discovery rate is not above its limit, as
far as the number of tokens can show.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored, text_or_empty

MIN_TOKEN = 16
FALSE_DISCOVERY_RATE = 0.1
#: No more than this share of random tokens may be given up for a low rate.
LARGEST_THRESHOLD = 0.2
#: Classes with fewer testable tokens are judged with the bands up to twice as long and half as long.
SPARSE_CLASS = 30
NEAR_BANDS = 2
#: Below this chance the equal pairs of a token decide its serial test.
IMPOSSIBLE_PAIRS = 0.001
#: One-sided 5% point of the normal distribution.
SIGNIFICANT = 1.645

# The patterns of the contract, and the alphabets of the encodings.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"      # maximal runs, so the least length may stand in the pattern
TOKEN = r"[A-Za-z0-9+/_-]{%d,}" % MIN_TOKEN
_LOWER = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (
    ("digits", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("upper_hex", "0123456789ABCDEF"),
    ("lower", _LOWER),
    ("upper", _LOWER.upper()),
    ("base32", _LOWER.upper() + "234567"),
    ("letters", _LOWER.upper() + _LOWER),
    ("lower_digits", "0123456789" + _LOWER),
    ("upper_digits", "0123456789" + _LOWER.upper()),
    ("base62", "0123456789" + _LOWER.upper() + _LOWER),
    ("base64", _LOWER.upper() + _LOWER + "0123456789+/-_"),
)


def _hits(text: Column, pattern: str, kind: int, group: int, likely: Column) -> Column:
    """Array of (kind, i, gap, size, token, group_size): all matches and the gaps before them.

    Places follow from the running sums of gaps and sizes.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)
    made = F.transform(
        F.arrays_zip(found.alias("m"), inner.alias("g"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"),
            F.length(x["m"]).alias("size"), x["m"].alias("token"), F.length(x["g"]).alias("group_size")))
    return F.when(likely, made)


def _normal_tail(z: Column) -> Column:
    """Two-sided p-value of a standard normal, by a rational approximation of the error function."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(poly * F.exp(-x * x), F.lit(1e-15))


def randomness(tokens: DataFrame) -> DataFrame:
    """Add encoding, band and p (combined p-value of the three tests) to rows with ``token``."""
    encoding, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, symbols in reversed(ALPHABETS):
        fits = F.length(F.translate("token", symbols, "")) == 0
        encoding = F.when(fits, F.lit(name)).otherwise(encoding)
        alphabet = F.when(fits, F.lit(symbols)).otherwise(alphabet)
    rows = tokens.withColumns({"encoding": encoding, "_alphabet": alphabet})
    rows = rows.withColumns({
        "_n": F.length("token").cast("double"), "_k": F.length("_alphabet").cast("double"),
        "_v": F.transform(F.split("token", ""), lambda c: F.instr(F.col("_alphabet"), c).cast("double"))})
    rows = rows.withColumn("_v", F.filter("_v", lambda v: v > 0))
    n, k = F.col("_n"), F.col("_k")
    squares = F.aggregate(
        F.array_distinct("_v"), F.lit(0.0),
        lambda acc, v: acc + F.pow(F.size(F.filter("_v", lambda w: w == v)).cast("double"), F.lit(2.0)))
    chi = k / n * squares - n
    rows = rows.withColumn("_z1", (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))
    high = F.transform("_v", lambda v: (v > F.col("_k") / 2).cast("int"))
    rows = rows.withColumn("_high", high)
    n1 = F.aggregate("_high", F.lit(0), lambda a, b: a + b).cast("double")
    changes = F.aggregate(
        F.sequence(F.lit(1), F.size("_high") - 1), F.lit(0),
        lambda a, i: a + (F.element_at("_high", i) != F.element_at("_high", i + 1)).cast("int"))
    expected = 2 * n1 * (n - n1) / n + 1
    spread = F.sqrt((expected - 1) * (expected - 2) / (n - 1))
    rows = rows.withColumn("_z2", F.when(spread > 0, (changes + 1 - expected) / spread).otherwise(F.lit(9.0)))
    mean = F.aggregate("_v", F.lit(0.0), lambda a, b: a + b) / n
    rows = rows.withColumn("_mean", mean)
    power = F.aggregate("_v", F.lit(0.0), lambda a, b: a + (b - F.col("_mean")) * (b - F.col("_mean")))
    lag = F.aggregate(
        F.sequence(F.lit(1), F.size("_v") - 1), F.lit(0.0),
        lambda a, i: a + (F.element_at("_v", i) - F.col("_mean")) * (F.element_at("_v", i + 1) - F.col("_mean")))
    rows = rows.withColumn("_z3", F.when(power > 0, (lag / power + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0)))
    pairs = F.array_sort(F.transform(
        F.sequence(F.lit(1), F.size("_v") - 1),
        lambda i: F.element_at("_v", i) * F.col("_k") + F.element_at("_v", i + 1)))
    # equal neighbours in the sorted pairs: the sum over groups of 1 + ... + (size - 1)
    start = F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("same"), F.lit(0.0).alias("total"))

    def step(acc: Column, v: Column) -> Column:
        same = F.when(acc["last"] == v, acc["same"] + 1).otherwise(F.lit(0.0))
        return F.struct(v.alias("last"), same.alias("same"), (acc["total"] + same).alias("total"))

    rows = rows.withColumn("_equal", F.aggregate(pairs, start, step, lambda acc: acc["total"]))
    likely = (n - 1) * (n - 2) / 2 / (k * k)
    # Chernoff's bound of the Poisson tail
    chance = F.when(F.col("_equal") > likely, F.exp(
        F.col("_equal") - likely + F.col("_equal") * F.log(likely / F.col("_equal")))).otherwise(F.lit(1.0))
    rows = rows.withColumn("_p3", F.when(chance < IMPOSSIBLE_PAIRS, F.greatest(chance, F.lit(1e-15))).otherwise(
        _normal_tail(F.col("_z3"))))
    x = -2 * (F.log(_normal_tail(F.col("_z1"))) + F.log(_normal_tail(F.col("_z2"))) + F.log("_p3"))
    # Fisher's sum of three has six degrees of freedom
    p = F.exp(-x / 2) * (1 + x / 2 + x * x / 8)
    band = F.floor(2 * F.log2(n)).cast("int")
    return rows.withColumns({"p": p, "band": band}).drop(
        "_alphabet", "_n", "_k", "_v", "_z1", "_z2", "_z3", "_high", "_mean", "_equal", "_p3")


def thresholds(tested: DataFrame, rate: float = FALSE_DISCOVERY_RATE) -> DataFrame:
    """(encoding, band, least_p): the smallest p-value from which tokens are reported.

    Random tokens spread evenly over p, so the number above a half estimates
    all random ones of a class. Every class is judged on the same grid of
    p-values, filled or not; a class of few tokens is judged with the bands
    around it. A value of the grid is refused where significantly fewer tokens
    lie above a half than the rate allows, so a lone token is refused only for
    its own p-value. One row per encoding and length band at most, a few
    hundred however large the corpus. With a column ``token`` (any key of it)
    repeats of a token count once.
    """
    if "token" in tested.columns:
        tested = tested.dropDuplicates(["encoding", "band", "token"])
    grid = range(1, round(100 * LARGEST_THRESHOLD) + 1)
    names = [*(f"above_{t}" for t in grid), "high"]
    bins = tested.groupBy("encoding", "band", F.floor(F.col("p") * 100).cast("int").alias("bin")).agg(
        F.count("*").alias("n"))
    own = bins.groupBy("encoding", "band").agg(
        *[F.sum(F.when(F.col("bin") >= t, F.col("n")).otherwise(0)).alias(f"above_{t}") for t in grid],
        F.sum(F.when(F.col("bin") >= 50, F.col("n")).otherwise(0)).alias("high"))
    near = Window.partitionBy("encoding").orderBy("band").rangeBetween(-NEAR_BANDS, NEAR_BANDS)
    sparse = F.col("above_1") < SPARSE_CLASS
    used = own.select("encoding", "band", *[
        F.when(sparse, F.sum(c).over(near)).otherwise(F.col(c)).alias(c) for c in names])

    def allowed(t: int) -> Column:
        n, share = F.col(f"above_{t}"), (1 - rate) * 0.5 / (1 - t / 100)
        return F.col("high") + 0.5 >= n * share - SIGNIFICANT * F.sqrt(n * share * (1 - share))

    least = F.coalesce(*[F.when(allowed(t), F.lit(t / 100)) for t in grid])
    return used.select("encoding", "band", least.alias("least_p")).where("least_p IS NOT NULL")


def _joined(spans: Column, known: bool) -> Column:
    chosen = F.filter(spans, lambda s: s["kind"] < 3) if known else spans
    names = F.array(*map(F.lit, ("assign", "access", "hex", "random")))
    text = F.transform(F.array_sort(chosen), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", text)


def find_secrets(docs: DataFrame, rate: float = FALSE_DISCOVERY_RATE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Null texts count as empty. Spans of the randomness tests (kind ``random``)
    are added where no pattern's span overlaps. Other columns are ignored.
    """
    text = F.col("text")
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"))
    hits = F.concat(*[F.coalesce(h, F.expr("array()")) for h in (
        _hits(text, ASSIGN, 0, 2, text.rlike(r"(?i:passw|secret|token|api_?key)")),
        _hits(text, ACCESS, 1, 0, text.contains("AKIA")),
        _hits(text, HEX, 2, 0, text.rlike(HEX)),
        _hits(text, TOKEN, 3, 0, text.rlike(TOKEN)))])
    base = stored(rows.select("rid", "doc_id", hits.alias("hits")), "secret-hits")
    each = base.select("rid", F.explode("hits").alias("h")).select("rid", "h.*")
    upto = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
    each = each.withColumn("start", F.col("end") - F.col("size"))
    fits = (
        ((F.col("kind") == 0) & (F.col("group_size") >= 12)) | ((F.col("kind") == 1) & (F.col("size") >= 18))
        | (F.col("kind") >= 2))
    each = stored(each.where(fits).select("rid", "start", "kind", "end", "token"), "secret-spans")
    tested = stored(
        randomness(each.where("kind = 3")).withColumn("token", F.xxhash64("token")), "secret-tests")
    # written first: a few hundred rows, and the joins below need not carry the plan behind them
    least = stored(thresholds(tested, rate), "secret-thresholds")
    random = tested.join(F.broadcast(least), ["encoding", "band"]).where("p >= least_p")
    spans = stored(
        each.where("kind < 3").drop("token").unionByName(random.select("rid", "start", "kind", "end")), "secret-found")
    grouped = spans.groupBy("rid").agg(F.collect_list(F.struct("start", "kind", "end")).alias("all"))
    known = F.filter("all", lambda s: s["kind"] < 3)
    grouped = grouped.withColumn("known", known).withColumn("all", F.filter("all", lambda s: (s["kind"] < 3) | ~F.exists(
        F.col("known"), lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"]))))
    out = base.select("rid", "doc_id").join(grouped.drop("known"), "rid", "left").withColumn(
        "all", F.coalesce("all", F.expr("array()")))
    count = lambda kind: F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long")
    return out.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("all"), True), 256).alias("base_sha256"),
        _joined(F.col("all"), False).alias("spans"), count(3).alias("n_random"))

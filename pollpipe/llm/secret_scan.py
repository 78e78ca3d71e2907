"""Secret scan: fixed patterns, and strings that a battery of randomness tests takes for random."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

# The patterns and least lengths of the scan's contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA and a run, 20 characters or more
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

#: What a run of word-like characters has to look like to be tested: 20 or more, with a digit.
_IN_RUN = "[A-Za-z0-9+/_-]"
CANDIDATE = rf"(?<!{_IN_RUN})(?=[A-Za-z+/_-]*[0-9]){_IN_RUN}{{20,}}"

#: Encodings in the order in which they are inferred: name, pattern, alphabet, least length.
#: The least length gives each about 80 bits, below which the tests cannot tell much.
ENCODINGS = (
    ("hex", "^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 20),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 20),
    ("base36", "^(?:[a-z0-9]+|[A-Z0-9]+)$", "0123456789abcdefghijklmnopqrstuvwxyz", 20),
    ("base62", "^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 20),
    ("base64", "^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 20),
    ("base64url", "^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 20),
)
#: Matches of a text that are placed together.
SPANS = 256
#: Steps of -log10 p in which false discoveries are counted, and their number.
STEP, STEPS = 0.125, 160


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of ``pattern``: array of (start, end, found), code points.

    The gaps between matches are what splitting by the same pattern leaves. Their lengths are
    summed by ``SPANS`` matches at a time and then over those, so that a text with very many
    matches does not take time by their square.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    size = lambda p: F.char_length(p["gap"]) + F.char_length(p["found"])

    def add(done: Column, pair: Column) -> Column:
        last = F.when(F.size(done) > 0, F.element_at(done, -1)["end"]).otherwise(F.lit(0))
        return F.concat(done, F.array(_span(last + F.char_length(pair["gap"]), last + size(pair), pair["found"])))

    def placed(pairs: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / SPANS).cast("int")), lambda i: F.slice(pairs, i * SPANS + 1, SPANS))
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, p: n + size(p)))
        before = F.aggregate(totals, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
        inner = F.arrays_zip(F.transform(chunks, lambda c: F.aggregate(c, none, add)).alias("own"), F.slice(before, 1, F.size(chunks)).alias("at"))
        return F.flatten(F.transform(inner, lambda x: F.transform(x["own"], lambda s: _span(s["start"] + x["at"], s["end"] + x["at"], s["found"]))))

    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("found")), lambda p: p["found"].isNotNull())
    # As the only element of an array, the pairs are computed once however often they are used.
    once = F.element_at(F.transform(F.array(pairs), placed), 1)
    return F.when(F.regexp_like(text, F.lit(pattern)), once).otherwise(none)


def _span(start: Column, end: Column, found: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), found.alias("found"))


def _upper_tail(z: Column) -> Column:
    """About the probability that a standard normal variable exceeds ``z``, for z >= 0."""
    return 1 / (1 + F.exp(F.least(1.5976 * z + 0.070566 * z * z * z, F.lit(700.0))))


def _two_sided(z: Column) -> Column:
    return F.least(2 * _upper_tail(F.abs(z)), F.lit(1.0))


def _encoding(found: Column, pick) -> Column:
    """``pick(encoding)`` of the first encoding that ``found`` could be in."""
    return reduce(lambda rest, e: F.when(F.regexp_like(found, F.lit(e[1])), pick(e)).otherwise(rest), reversed(ENCODINGS), F.lit(None))


def _kind(c: Column) -> Column:
    return F.when(c.between("a", "z"), 0).when(c.between("A", "Z"), 1).when(c.between("0", "9"), 2).otherwise(3)


def _is(kind: int):
    return lambda y: y == kind


def battery(found: Column) -> Column:
    """Probability of a string at least as uneven as ``found`` among random strings of its
    inferred encoding and length; NULL if it is in none or too short for one.

    Three tests: chi-squared of the counts of the k characters of the alphabet against uniformity
    (by the cube-root approximation of Wilson and Hilferty, both tails), the number of runs of
    lower case, upper case, digits and others against what their order by chance would give, and
    the correlation of each character's place in the alphabet with the next one's. The least of
    the three, times three, is the joint value (Bonferroni).
    """
    alphabet = _encoding(found, lambda e: F.lit(e[2]))
    plain = F.when(F.regexp_like(found, F.lit("^[0-9A-F]+$")), F.lower(found)).otherwise(
        F.when((alphabet == ENCODINGS[2][2]), F.lower(found)).otherwise(found)
    )
    places = F.transform(F.split(plain, ""), lambda c: (F.instr(alphabet, c) - 1).cast("double"))
    k, n = F.char_length(alphabet).cast("double"), F.char_length(found).cast("double")
    held = F.struct(places.alias("v"), k.alias("k"), n.alias("n"), F.transform(F.split(found, ""), _kind).alias("kinds"))

    def joint(x: Column) -> Column:
        v, k, n = x["v"], x["k"], x["n"]
        total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, y: s + y)
        squares = total(F.transform(F.array_distinct(v), lambda p: F.pow(F.size(F.filter(v, lambda y: y == p)).cast("double"), F.lit(2.0))))
        chi, df = squares * k / n - n, k - 1
        chi_z = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        kinds = x["kinds"]
        runs = 1 + total(F.zip_with(F.slice(kinds, 1, F.size(kinds) - 1), F.slice(kinds, 2, F.size(kinds)), lambda a, b: (a != b).cast("double")))
        each = [F.size(F.filter(kinds, _is(kind))).cast("double") for kind in range(4)]
        twos, threes = (sum((F.pow(c, F.lit(e)) for c in each), F.lit(0.0)) for e in (2.0, 3.0))
        mean = n + 1 - twos / n
        var = (twos * (twos + n * (n + 1)) - 2 * n * threes - n * n * n) / (n * n * (n - 1))
        runs_z = F.when(var > 0, F.try_divide(runs - mean, F.sqrt(F.greatest(var, F.lit(0.0))))).otherwise(F.lit(9.0))
        centre = total(v) / n
        off = F.transform(v, lambda y: y - centre)
        spread = total(F.transform(off, lambda y: y * y))
        serial = total(F.zip_with(F.slice(off, 1, F.size(off) - 1), F.slice(off, 2, F.size(off)), lambda a, b: a * b))
        serial_z = F.when(spread > 0, (F.try_divide(serial, spread) + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
        return F.least(3 * F.least(_two_sided(chi_z), _two_sided(runs_z), _two_sided(serial_z)), F.lit(1.0))

    value = F.element_at(F.transform(F.array(held), joint), 1)
    return F.when(n >= _encoding(found, lambda e: F.lit(e[3])), value)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", level: float = 0.05) -> DataFrame:
    """Every row of ``docs`` with its secrets: ``doc_id``, ``spans``.

    ``spans`` is an array of (kind, start, end, found), in code points, end exclusive, by start
    and then kind: assignments of a value to a telling name, access key ids, long hex runs, and
    ``random``: runs of 20 or more word-like characters with digit and letter that pass the battery
    and are not within a span of the other kinds.

    The battery rejects strings that random ones of their encoding would hardly be. Rejections are
    made so that, per encoding and length class, at most the share ``level`` of them hits truly
    random strings (Benjamini and Hochberg, with counts per step of p in place of a full sort;
    a whole step is rejected or none of it). Short and long strings, whose tests differ in power,
    thus do not set each other's limit. What is not rejected and shows all classes of characters
    that a random string of its length would be expected to show is reported. Counts cover all
    strings of all rows; what reaches the driver is one limit per encoding and length class.

    NULL texts count as empty and have no spans; repeated rows are scanned each on their own;
    an empty table gives an empty result; other columns do not matter.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(spans(content, ASSIGN), lambda s: F.char_length(F.regexp_extract(s["found"], ASSIGN, 2)) >= ASSIGN_LEAST)
    base = {"assign": assign, "access": spans(content, ACCESS), "hex": spans(content, HEX)}
    rows = docs.select(F.col(doc_id).alias("doc_id"), *(v.alias(k) for k, v in base.items()), spans(content, CANDIDATE).alias("maybe"))
    inside = lambda s, kind: F.exists(kind, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    looks = lambda s: F.regexp_like(s["found"], F.lit("[A-Za-z]")) & F.regexp_like(s["found"], F.lit("[0-9]"))
    free = F.filter("maybe", lambda s: looks(s) & ~inside(s, F.col("assign")) & ~inside(s, F.col("access")) & ~inside(s, F.col("hex")))
    rows = rows.select("doc_id", *base, free.alias("maybe"))
    tested = F.transform("maybe", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"),
        _stratum(s["found"]).alias("stratum"), _step(battery(s["found"])).alias("step"), _varied(s["found"]).alias("varied"),
    ))
    # Only rows with a candidate run the battery, which is long.
    rows = written(rows.withColumn("tests", F.when(F.size("maybe") > 0, tested)).drop("maybe"), "secret-spans")
    limits = _limits(rows.select(F.explode("tests").alias("t")).select("t.stratum", "t.step"), level)
    limit = F.lit(STEPS + 1)
    if limits:
        known = F.create_map(*(F.lit(x) for pair in sorted(limits.items()) for x in pair))
        first_rejected = lambda t: F.coalesce(F.try_element_at(known, t["stratum"]), limit)
    else:
        first_rejected = lambda t: limit
    tests = F.coalesce("tests", F.array())
    random = F.filter(tests, lambda t: t["step"].isNotNull() & t["varied"] & (t["step"] < first_rejected(t)))
    parts = [_ranked(column, kind) for kind, column in enumerate((F.col("assign"), F.col("access"), F.col("hex"), random))]
    ordered = F.array_sort(F.concat(*parts))
    names = F.array(*(F.lit(k) for k in KINDS))
    return rows.select("doc_id", F.transform(ordered, lambda s: F.struct(
        F.element_at(names, s["rank"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"),
    )).alias("spans"))


def _ranked(spans: Column, kind: int) -> Column:
    """Spans in a form that sorts by start and kind."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("rank"), s["end"].alias("end"), s["found"].alias("found"),
    ))


def _stratum(found: Column) -> Column:
    """Encoding and length class (by powers of the square root of two) that are judged together."""
    name = _encoding(found, lambda e: F.lit(e[0]))
    return F.concat_ws(":", name, F.floor(2 * F.log2(F.char_length(found).cast("double"))).cast("string"))


def _step(p: Column) -> Column:
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) / STEP), F.lit(STEPS)).cast("int")


def _varied(found: Column) -> Column:
    """Whether digits and letters both occur about as often as random characters would give.

    Ordinary words with a number beside them have far too few digits; four standard deviations
    are allowed.
    """
    n = F.char_length(found).cast("double")
    share = _encoding(found, lambda e: F.lit(sum(c.isdigit() for c in e[2]) / len(e[2])))
    digits = n - F.char_length(F.regexp_replace(found, "[0-9]", ""))
    room = 4 * F.sqrt(n * share * (1 - share))
    signs = n - F.char_length(F.regexp_replace(found, "[+/_-]", ""))
    mixed = F.regexp_like(found, F.lit("[a-z]")) & F.regexp_like(found, F.lit("[A-Z]"))
    many = _encoding(found, lambda e: F.lit(len(e[2]) > 36))
    return (F.abs(digits - n * share) <= room) & (signs <= n / 32 + 4 * F.sqrt(n / 32)) & (~many | mixed)


def _limits(tests: DataFrame, level: float) -> dict[str, int]:
    """For each stratum the first step of p that is rejected; strata without rejections are absent.

    Bounded by the number of encodings and of length classes.
    """
    counts = tests.where("step is not null").groupBy("stratum", "step").agg(F.count("*").alias("n"))
    down = Window.partitionBy("stratum").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy("stratum")
    summed = counts.select("stratum", "step", F.sum("n").over(down).alias("beyond"), F.sum("n").over(everything).alias("tests"))
    largest_p = F.pow(F.lit(10.0), -F.col("step") * STEP)
    passing = summed.where(largest_p * F.col("tests") <= level * F.col("beyond"))
    return {r["stratum"]: r["first"] for r in passing.groupBy("stratum").agg(F.min("step").alias("first")).collect()}


def spans_text(column: Column) -> Column:
    """Spans as ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


"""Secret scan: known kinds by pattern, unknown ones by a battery of randomness tests. DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exportlens.llm.common import cut

# Kinds in listed order. The lengths in the last two patterns give the same spans as a filter of the
# unbounded ones: a failing match holds no later start that would pass.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ["assign", "access", "hex", "random"]

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encoding: pattern of the token without padding, and its alphabet in code order. The first that fits counts.
ENCODINGS = [
    (r"^[0-9]+$", DIGITS),
    (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^[a-z]+$", LOWER),
    (r"^[A-Z]+$", UPPER),
    (r"^[A-Z2-7]+$", UPPER + "234567"),
    (r"^[a-z2-7]+$", LOWER + "234567"),
    (r"^[A-Z0-9]+$", UPPER + DIGITS),
    (r"^[a-z0-9]+$", LOWER + DIGITS),
    (r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    (r"^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    (r"^", UPPER + LOWER + DIGITS + "+/-_"),
]
# What a token that is no secret looks like. Letters alone: running text, in which two letters are equal with this chance
# (index of coincidence of European languages). Digits, or letters and digits together: numbers and identifiers, which repeat
# their signs at least three times as often as chance does, as years, zeros, counters and prefixes make them.
REPEAT_RATE = 0.066
REPEATS = 3.0
LETTERS_ONLY = (LOWER, UPPER)
# In encodings with letters of both cases, the chance that an ordinary token changes between capitals, small letters, digits and signs
# from one character to the next; in a random one it is about two thirds.
CHANGE_RATE = 0.35
CASES = [k for k, (_, letters) in enumerate(ENCODINGS) if UPPER in letters and LOWER in letters]
Z_LIMIT = 3.29  # two-sided 0.1 % point of the runs and serial-correlation tests
STEPS = 20  # steps of a power of ten to which p-values are rounded up
LAST_STEP = 6000
SUM_BLOCK = 128  # elements added up one by one in prefix sums
STRATA = 32  # length classes, by powers of two


def _prefix_sums(numbers: Column) -> Column:
    """For an array<int>, the sum of the elements before each one, in blocks: no element is carried more than a block long."""
    whole = lambda x: F.aggregate(x, F.lit(0), lambda a, n: a + n)
    block = lambda x, b: F.slice(x, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK))
    blocks = lambda x: F.sequence(F.lit(0), F.call_function("div", F.size(x) - 1, F.lit(SUM_BLOCK)).cast("int"))
    # Sums before each block: a short array, built by appending.
    bases = lambda sums: F.aggregate(sums, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    one = F.transform(F.array(numbers), lambda x: F.struct(x.alias("x"), F.transform(blocks(x), lambda b: whole(block(x, b))).alias("s")))
    one = F.transform(one, lambda y: F.struct(y["x"].alias("x"), bases(y["s"]).alias("b")))
    inside = lambda y: F.transform(blocks(y["x"]), lambda b: F.transform(
        F.array(block(y["x"], b)), lambda part: F.transform(part, lambda _, i: F.get(y["b"], b) + whole(F.slice(part, F.lit(1), i))))[0])
    return F.when(F.size(numbers) == 0, F.array().cast("array<int>")).otherwise(F.transform(one, lambda y: F.flatten(inside(y)))[0])


def _spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """array of (s, k, e, m): start, kind, end in code points and the match, leftmost non-overlapping.

    A match starts after all pieces and matches before it: their lengths are added up, the text is not searched again.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<s:int,k:int,e:int,m:string>>")
    pairs = F.transform(F.array(F.struct(F.split(text, pattern, -1).alias("p"), matches.alias("m"))), lambda x: F.zip_with(
        F.slice(x["p"], F.lit(1), F.size(x["m"])), x["m"], lambda p, m: F.struct(F.length(p).alias("p"), m.alias("m"))))
    placed = F.transform(pairs, lambda x: F.struct(x.alias("x"), _prefix_sums(F.transform(x, lambda y: y["p"] + F.length(y["m"]))).alias("at")))
    found = F.transform(placed, lambda x: F.zip_with(x["x"], x["at"], lambda y, at: F.struct(
        (at + y["p"]).alias("s"), F.lit(kind).alias("k"), (at + y["p"] + F.length(y["m"])).alias("e"), y["m"].alias("m"))))[0]
    if keep is not None:
        found = F.filter(found, lambda x: keep(x["m"]))
    return F.when(text.rlike(pattern), found).otherwise(none)


def _apart(seen: Column, base: Column, size: Column) -> Column:
    """The spans of ``seen`` that overlap none of ``base``. Both are looked up by cells of the text, 256 at most."""
    cell = F.greatest(F.call_function("div", size, F.lit(256)).cast("int") + 1, F.lit(512))
    of = lambda x: F.call_function("div", x, cell).cast("int")
    cells = F.transform(F.sequence(F.lit(0), of(size)), lambda c: F.filter(base, lambda b: (of(b["s"]) <= c) & (c <= of(b["e"]))))
    near = lambda by, x: F.exists(F.sequence(of(x["s"]), of(x["e"])), lambda c: F.exists(F.get(by, c), lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    return F.when((F.size(base) == 0) | (F.size(seen) == 0), seen).otherwise(
        F.transform(F.array(cells), lambda by: F.filter(seen, lambda x: ~near(by, x)))[0])


def _lower_tail(z: Column) -> Column:
    """Normal distribution function by the rational approximation of Hastings."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * poly
    return F.when(z < 0, tail).otherwise(1 - tail)


def _bare(token: Column) -> Column:
    return F.regexp_replace(token, "=+$", "")


def _encoding(token: Column) -> Column:
    """Number of the first encoding that fits."""
    bare, number = _bare(token), F.lit(len(ENCODINGS) - 1)
    for k in reversed(range(len(ENCODINGS) - 1)):
        number = F.when(bare.rlike(ENCODINGS[k][0]), F.lit(k)).otherwise(number)
    return number


def _alphabet(encoding: Column) -> Column:
    return F.get(F.array(*[F.lit(letters) for _, letters in ENCODINGS]), encoding)


def _p_value(token: Column) -> Column:
    """Chance that a token that is no secret looks as uniform as this one; 1 where a test refuses randomness.

    Chi-squared of the alphabet's counts: under randomness about df, in ordinary tokens larger by the
    length times the excess of their repeat rate, so a short token can't be told apart and a long one can. The
    excess is that of the token's encoding: running text for letters alone, numbers and identifiers for the others. Where an encoding has
    letters of both cases, the runs of one kind of character tell as well: words written together change their kind seldom.
    Runs test above and below the alphabet's middle and lag-1 serial correlation of the codes: a
    counter, a keyboard row or a repeated block has a flat alphabet but fails these.
    """
    bare, alphabet = _bare(token), _alphabet(_encoding(token))

    def tests(x):
        n, size = x["n"], F.length(x["alphabet"]).cast("double")
        squares = F.aggregate(F.split(x["alphabet"], ""), F.lit(0.0), lambda a, c: a + F.pow(
            n - F.length(F.replace(x["bare"], c, F.lit(""))), F.lit(2.0)))
        chi, df = squares * size / n - n, size - 1
        rate = F.when(x["alphabet"].isin(*LETTERS_ONLY), size * REPEAT_RATE).otherwise(F.greatest(size * REPEAT_RATE, F.lit(REPEATS)))
        excess = n * (rate - 1)
        p = _lower_tail((chi - df - excess) / F.sqrt(2 * (df + 2 * excess)))
        codes, mean = x["codes"], x["mean"]
        high = F.transform(codes, lambda c: (c > (size - 1) / 2).cast("int"))
        n1 = F.aggregate(high, F.lit(0), lambda a, c: a + c).cast("double")
        n0 = n - n1
        runs = F.lit(1.0) + F.aggregate(F.zip_with(F.slice(high, F.lit(1), F.size(high) - 1), F.slice(high, F.lit(2), F.size(high) - 1),
                                                   lambda a, b: (a != b).cast("int")), F.lit(0), lambda a, c: a + c)
        expected = 2 * n1 * n0 / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = F.when(variance > 0, F.abs(runs - expected) / F.sqrt(variance)).otherwise(F.lit(99.0))
        spread = F.aggregate(codes, F.lit(0.0), lambda a, c: a + (c - mean) * (c - mean))
        joint = F.aggregate(F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1),
                                       lambda a, b: (a - mean) * (b - mean)), F.lit(0.0), lambda a, c: a + c)
        z_serial = F.when(spread > 0, F.abs(joint / spread * n + 1) / F.sqrt(n)).otherwise(F.lit(99.0))
        # Runs of one kind of character: evidence of its own, joined to the first by Fisher's rule for two tests.
        kinds = F.transform(codes, lambda c: F.when(c < 26, 0).when(c < 52, 1).when(c < 62, 2).otherwise(3))
        changes = F.aggregate(F.zip_with(F.slice(kinds, F.lit(1), F.size(kinds) - 1), F.slice(kinds, F.lit(2), F.size(kinds) - 1),
                                         lambda a, b: (a != b).cast("int")), F.lit(0), lambda a, c: a + c)
        m = n - 1
        both = F.greatest(p * (1 - _lower_tail((changes - CHANGE_RATE * m - 0.5) / F.sqrt(CHANGE_RATE * (1 - CHANGE_RATE) * m))), F.lit(1e-299))
        joined = F.when(x["alphabet"].isin(*[ENCODINGS[k][1] for k in CASES]), F.least(F.lit(1.0), both * (1 - F.log(both)))).otherwise(p)
        return F.when((z_runs <= Z_LIMIT) & (z_serial <= Z_LIMIT), joined).otherwise(F.lit(1.0))

    # Each step is bound once by a one-element transform, so later uses don't repeat the work.
    codes = lambda x: F.transform(F.split(x["bare"], ""), lambda c: F.instr(x["alphabet"], c) - 1)
    one = F.array(F.struct(bare.alias("bare"), alphabet.alias("alphabet"), F.length(bare).cast("double").alias("n")))
    one = F.transform(one, lambda x: F.struct(x["bare"], x["alphabet"], x["n"], codes(x).alias("codes")))
    one = F.transform(one, lambda x: F.struct(x["bare"], x["alphabet"], x["n"], x["codes"], (
        F.aggregate(x["codes"], F.lit(0.0), lambda a, c: a + c) / x["n"]).alias("mean")))
    return F.transform(one, tests)[0]


def find_secrets(docs: DataFrame, false_rate: float = 0.01) -> DataFrame:
    """(doc_id, base, random) for every row of ``docs`` (doc_id, text); arrays of (s, k, e, m).

    ``base`` are the spans of the three known kinds, ordered by start and kind; ``random`` are tokens
    of 20 characters or more outside of them that the test battery calls random. The p-values of all
    tokens of an encoding and a length class (powers of two) are judged together by the Benjamini-Hochberg rule at
    ``false_rate``, so many ordinary words of one encoding don't hide the few keys of another; they are rounded
    up to twentieths of a power of ten, so a family has at most 6,001 values to rank, whatever the data's size.

    A null or empty text has no spans; rows that repeat are judged each; no rows give no rows; other columns are
    ignored. Texts are not shuffled: only counts of rounded p-values are.
    """
    spans = lambda pattern, k, keep=None: _spans(F.col("text"), pattern, k, keep)
    long_enough = lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 8
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = df.select("doc_id", F.array_sort(F.concat(
        spans(ASSIGN, 0, long_enough), spans(ACCESS, 1), spans(HEX, 2))).alias("base"), spans(CANDIDATE, 3).alias("seen"), F.length("text").alias("size"))
    df = df.select("doc_id", "base", _apart(F.col("seen"), F.col("base"), F.col("size")).alias("seen"))
    step = lambda c: F.least(F.floor(-F.log10(F.greatest(_p_value(c["m"]), F.lit(1e-299))) * STEPS), F.lit(LAST_STEP)).cast("int")
    scored = F.transform("seen", lambda c: F.struct(c["s"], c["k"], c["e"], c["m"], F.greatest(step(c), F.lit(0)).alias("p"), (
        _encoding(c["m"]) * STRATA + F.least(F.floor(F.log2(F.length(c["m"]).cast("double"))), F.lit(STRATA - 1))).cast("int").alias("stratum")))
    df = cut(df.withColumn("seen", scored))

    counts = df.select(F.explode("seen").alias("c")).groupBy("c.stratum", "c.p").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("stratum").orderBy(F.desc("p"))
    total = Window.partitionBy("stratum")
    rule = F.pow(F.lit(10.0), -F.col("p") / STEPS) <= false_rate * F.sum("n").over(down) / F.sum("n").over(total)
    least = counts.withColumn("ok", rule).where("ok").groupBy("stratum").agg(F.min("p").alias("p")).collect()  # one row per encoding and length class
    bounds = F.create_map(*[F.lit(x) for row in least for x in (row["stratum"], row["p"])]) if least else F.create_map().cast("map<int,int>")

    def ok(c):
        return F.coalesce(c["p"] >= F.try_element_at(bounds, c["stratum"]), F.lit(False))

    chosen = F.transform(F.filter("seen", ok), lambda c: F.struct(c["s"], c["k"], c["e"], c["m"]))
    return df.select("doc_id", "base", chosen.alias("random"))


def span_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["k"]], x["s"], x["e"])), ",")

"""Quality rules whose cutoffs carry a guarantee.

Fixed base rules reject the plainly unusable. Beyond them, the signals of a text have
cutoffs per stratum (language), chosen on labelled documents so that, with confidence
``1 - DELTA`` over all strata together, at most ``ALPHA`` of a stratum's good documents
are rejected by them. The cutoffs of all signals move together, along one path of levels from loose
to tight, so a stratum needs one sequence of tests only, and about 220 good labels for the
first of them. DataFrame functions only.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.llm import rowstore
from shardlog.llm.common import squeezed, text_of, words_of
from shardlog.workdir import materialised

ALPHA = 0.02  # of a stratum's good documents, rejected at most by all signals together
DELTA = 0.05  # chance that the promise fails in any stratum
COST = 10.0  # a good document's weight against a bad one when a certified level is chosen
LEVELS = 13
LOOSEST = 700  # cutoff of every signal at the first level, in thousandths
# fixed values: cutoffs at the last level, in thousandths, which plain prose seldom exceeds
TIGHTEST = {"symbols": 10, "dup_lines": 100, "repeats": 100, "capitals": 60, "shouts": 10}
# each signal's cutoffs by level, tighter by the same ratio from one to the next
PATH = {s: [round(LOOSEST * (t / LOOSEST) ** (j / (LEVELS - 1))) for j in range(LEVELS)] for s, t in TIGHTEST.items()}
MIN_WORDS = 50


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _with_windows(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from ``words``: positions in 3-word windows that occur twice or more.

    Windows are told apart by 64-bit hashes. Sorting (hash, position) puts equal windows
    side by side; texts without any repeated window skip the sort.
    """
    word = lambda i: F.get("words", i)
    ends = F.size("words") - 3
    hashes = F.when(
        ends >= 0, F.transform(F.sequence(F.lit(0), ends), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))
    )
    placed = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    met = F.zip_with(
        "placed",
        F.slice("placed", 2, F.size("placed")),
        lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>")),
    )
    steps = F.zip_with("at", F.slice("at", 2, F.size("at")), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    keep = [c for c in df.columns if c != "words"]
    df = df.select(*keep, hashes.alias("hashes"))
    df = df.select(*keep, F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed).alias("placed"))
    df = df.select(*keep, F.sort_array(F.array_distinct(F.flatten(met))).alias("at"))
    total = F.aggregate(steps, F.lit(0), lambda s, x: s + x)
    return df.select(*keep, F.coalesce(F.when(F.size("at") > 0, total), F.lit(0)).cast("long").alias("n_repeat_words"))


def signals(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the counts of its text column: base counts and those of further signals.

    Null texts count as empty: no words, no lines, nothing else.
    """
    keep = df.columns
    whole = text_of(F.col(text))
    lines = F.filter(F.split("whole", "\n"), lambda x: F.length(squeezed(x)) > 0)
    df = df.select(*keep, whole.alias("whole")).select(*keep, "whole", lines.alias("lines"), words_of(F.col("whole")).alias("words"))
    df = df.select(
        *keep,
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(squeezed(F.col("whole"))).cast("long").alias("word_chars"),
        _count_of(F.col("whole"), "#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        _count_of(F.col("whole"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
        _count_of(F.col("whole"), "!").alias("n_shouts"),
    )
    return _with_windows(df)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_capitals", "n_shouts", "n_repeat_words")


def _values() -> dict[str, Column]:
    """Each signal in thousandths, as a whole number."""
    share = lambda a, b: F.coalesce(F.expr(f"1000 * {a} div nullif({b}, 0)"), F.lit(0))
    return {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "shouts": share("n_shouts", "word_chars"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _log_gamma(x: Column) -> Column:
    """Stirling's series after ten steps of the recurrence; right to about 13 digits."""
    y = x + 10
    steps = F.log(x)
    for i in range(1, 10):
        steps = steps + F.log(x + i)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - steps


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) where k < n p, and 1 from there on, where no bound can hold.

    The last term from logarithms, the ones before it by their ratios; terms further off
    than forty deviations add nothing in double precision.
    """
    k, n = k.cast("double"), n.cast("double")
    last = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    far = F.least(k, F.ceil(40 * F.sqrt(n * p)) + 100).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def back(s: Column, i: Column) -> Column:
        term = s["term"] * (k - i + 1) / (n - k + i) * ((1 - p) / p)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    steps = F.when(far >= 1, F.sequence(F.lit(1), far)).otherwise(F.array().cast("array<int>"))
    return F.when(k < n * p, F.exp(last) * F.aggregate(steps, start, back, lambda s: s["sum"])).otherwise(1.0)


def level() -> Column:
    """The first level of the path at which any signal of a document is over its cutoff, ``LEVELS`` if none is.

    Levels only get tighter, so the document is rejected there and at all later ones.
    """
    within = [sum(((value <= c).cast("int") for c in PATH[name]), F.lit(0)) for name, value in _values().items()]
    return F.least(*within)


def cutoffs(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """Per stratum with a certified level: ``stratum`` and ``level``.

    ``counted`` has ``doc_id``, ``stratum`` and the counts, ``labels`` has ``doc_id`` and
    ``quality``. A level rejects what any signal puts over its cutoff there. Levels are
    tested from the loosest on, and the first that fails ends the test (fixed sequence): as
    the path is fixed beforehand and later levels reject more, each test has the whole
    ``ALPHA``, and ``DELTA`` is divided by the number of strata only. Of the certified levels
    the one is taken that separates labelled good and bad best.
    """
    marks = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality")
    rows = (
        counted.where("stratum is not null")
        .join(marks, "doc_id")
        # what the base rules reject is not rejected by a level
        .groupBy("stratum", F.when(base_failed(), LEVELS).otherwise(level()).alias("level"))
        .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") != 1).alias("bad"))
    )
    levels = materialised(rows, "levels")
    strata = levels.agg(F.countDistinct("stratum")).first()[0]
    # at most one row a level: a stratum's histogram as arrays
    sums = levels.groupBy("stratum").agg(
        F.sum("good").alias("n"), F.sum("bad").alias("m"),
        *(F.sum(F.when(F.col("level") <= j, F.col("good")).otherwise(0)).alias(f"good_{j}") for j in range(LEVELS)),
        *(F.sum(F.when(F.col("level") <= j, F.col("bad")).otherwise(0)).alias(f"bad_{j}") for j in range(LEVELS)),
    )
    tries = F.array(*(F.struct(F.lit(j).alias("j"), F.col(f"good_{j}").alias("k"), F.col(f"bad_{j}").alias("caught")) for j in range(LEVELS)))
    tried = sums.select("stratum", "n", "m", F.explode(tries).alias("x"))
    passed = binomial_at_most(F.col("x.k"), F.col("n"), ALPHA) <= DELTA / max(1, strata)
    gain = F.coalesce(F.col("x.caught") / F.expr("nullif(m, 0)"), F.lit(0.0)) - COST * F.col("x.k") / F.expr("nullif(n, 0)")
    tested = tried.select("stratum", "x.j", passed.alias("passed"), gain.alias("gain"))
    failed = F.coalesce(F.min(F.when(~F.col("passed"), F.col("j"))), F.lit(LEVELS))
    sure = tested.groupBy("stratum").agg(failed.alias("failed"), F.collect_list(F.struct("gain", (-F.col("j")).alias("back"))).alias("all"))
    best = F.array_max(F.filter("all", lambda x: (-x["back"] < F.col("failed")) & (x["gain"] > 0)))  # the loosest of equals
    return materialised(sure.select("stratum", (-best["back"]).alias("level")).where("level is not null"), "cutoffs")


def judged(counted: DataFrame, chosen: DataFrame) -> DataFrame:
    """``counted`` with ``base_failed`` and ``kept``. Strata without a certified level reject nothing beyond the base."""
    names = chosen.select("stratum", F.col("level").alias("_level"))
    beyond = F.coalesce(level() <= F.col("_level"), F.lit(False))
    return counted.join(names, "stratum", "left").select(
        *counted.columns, base_failed().alias("base_failed"), (~base_failed() & ~beyond).alias("kept")
    )


def quality_rules(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """One row a document: ``doc_id``, all counts, ``base_failed`` and ``kept``.

    Repeated rows are judged each; a document labelled more than once counts once a label.
    """
    rows = documents.select(documents[key].alias("doc_id"), documents[stratum].alias("stratum"), documents[text].alias("text"))
    counted = materialised(signals(rows, "text").drop("text"), "counts")
    return judged(counted, cutoffs(counted, labels))


def passing(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    rows = documents.select(
        F.struct(*documents.columns).alias("row"),
        documents[key].alias("doc_id"), documents[stratum].alias("stratum"), documents[text].alias("text"),
    )
    counted = materialised(signals(rows, "text").drop("text"), "counts")
    kept = judged(counted, cutoffs(counted.drop("row"), labels)).where("kept")
    return rowstore.rows_of(kept)

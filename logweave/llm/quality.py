"""Quality rules by weak supervision, in DataFrame functions only.

Every rule votes 1 (good), -1 (bad) or 0 (abstains). Documents with the same votes form a
pattern; there are at most 3 to the power of the number of rules. Expectation-maximisation over
the counted patterns estimates the accuracy of every rule, the probability that its vote is right
when it casts one. A document is kept if its posterior probability of being good reaches the
threshold. Most rules vote on one side only: a rule that finds nothing odd abstains, as it says
nothing about the other faults. A fault that a single rule sees looks like that rule's error, so
estimates stay inside bounds given with the rule: the presence of a fault is strong evidence, the
absence of some is weak. The prior is a parameter for the same reason.

Edge cases: null and blank texts have no words, so they fail the base test; texts of any length
are processed whole; an empty table gives an empty table; rows are judged one by one, so repeated
rows get equal verdicts; names this operator adds must not be among the columns (``ValueError``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import stage, words

WINDOW = 8
ITERATIONS = 20
THRESHOLD = 0.5
#: Share of good documents among those without votes, and the first guess of every accuracy.
PRIOR, ACCURACY = 0.5, 0.9

#: Rules as (name, bad if, good if, least accuracy, most accuracy) over the counts of
#: :func:`features`; where neither condition holds they abstain.
RULES = [
    ("length", "false", "n_words >= 50", 0.5, 0.8),
    ("punctuation", "false", "20 * n_ends >= n_words AND 4 * n_ends <= n_words", 0.5, 0.8),
    ("mean_word", "word_chars < 3 * n_words OR word_chars > 10 * n_words", "false", 0.6, 0.999),
    ("symbols", "10 * n_symbols > n_words", "false", 0.95, 0.999),
    ("lines", "10 * n_dup_lines > 3 * n_lines", "false", 0.6, 0.999),
    ("repeats", "100 * n_repeat_words > 30 * n_words", "false", 0.6, 0.999),
    ("capitals", "10 * n_capitals > 3 * word_chars", "false", 0.95, 0.999),
    ("shouting", "10 * n_marks > 3 * n_words", "false", 0.95, 0.999),
]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_ends"]


def repeated_words(items: Column, width: int = WINDOW) -> Column:
    """How many words lie in windows of ``width`` words that occur twice or more in the array.

    Sorted window hashes tell whether any window repeats; only then are (hash, position) pairs
    sorted and the covered positions summed up, so the cost is n log n for any text.
    """
    n = F.size(items)
    key = lambda i: F.xxhash64(F.slice(items, i, width))
    starts = F.sequence(F.lit(1), n - (width - 1))
    hashes = F.sort_array(F.transform(starts, key))
    some = F.size(F.array_distinct(hashes)) < n - (width - 1)
    pairs = F.sort_array(F.transform(starts, lambda i: F.struct(key(i).alias("h"), i.alias("p"))))
    return F.when(n < width + 1, F.lit(0)).when(some, _covered(pairs, n, width)).otherwise(F.lit(0)).cast("long")


def _covered(pairs: Column, n: Column, width: int) -> Column:
    def both(p):
        count = F.size(p)
        at = lambda i: F.try_element_at(p, i)["h"]
        twice = F.filter(
            F.transform(p, lambda x, i: F.when(x["h"].eqNullSafe(F.when(i > 0, at(i))) | ((i + 2 <= count) & x["h"].eqNullSafe(at(i + 2))), x["p"])),
            lambda x: x.isNotNull(),
        )
        return F.sort_array(twice)

    positions = F.transform(F.array(pairs), both)[0]
    step = F.transform(
        F.array(positions),
        lambda q: F.aggregate(
            q,
            F.struct(F.lit(0).alias("sum"), F.lit(-width).alias("end")),
            lambda s, x: F.struct((s["sum"] + F.least(F.lit(width), x + width - s["end"])).cast("int").alias("sum"), (x + width).cast("int").alias("end")),
        )["sum"],
    )
    return step[0]


def features(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus the counts the rules look at."""
    added = [*COUNTS, "__words", "__lines"]
    if clash := set(added) & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} exist")
    body = F.coalesce(F.col(text), F.lit(""))
    w, lines = F.col("__words"), F.col("__lines")
    return (
        df.withColumns({"__words": words(F.col(text)), "__lines": F.filter(F.split(body, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))})
        .withColumns(
            {
                "n_words": F.size(w).cast("long"),
                "word_chars": F.length(F.array_join(w, "")).cast("long"),
                "n_symbols": F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long"),
                "n_lines": F.size(lines).cast("long"),
                "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
                "n_repeat_words": repeated_words(w),
                "n_capitals": F.regexp_count(body, F.lit("[A-Z]")).cast("long"),
                "n_marks": F.regexp_count(body, F.lit("[!?]")).cast("long"),
                "n_ends": F.regexp_count(body, F.lit("[.,;:][ \\t-\\r]")).cast("long"),
            }
        )
        .drop("__words", "__lines")
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def votes(rules=RULES) -> Column:
    """The votes of all rules as an array of -1, 0 and 1."""
    return F.array(*[F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0) for _, bad, good, *_ in rules])


def _posterior(v: Column, accuracy: Column, k: int, prior: float) -> Column:
    good, bad = F.lit(prior), F.lit(1 - prior)
    for j in range(k):
        x, a = F.element_at(v, j + 1), F.element_at(accuracy, j + 1)
        good = good * F.when(x == 1, a).when(x == -1, 1 - a).otherwise(1.0)
        bad = bad * F.when(x == 1, 1 - a).when(x == -1, a).otherwise(1.0)
    return good / (good + bad)


def estimate(patterns: DataFrame, rules=RULES, iterations: int = ITERATIONS, prior: float = PRIOR) -> DataFrame:
    """``patterns`` (votes, n) plus ``posterior``. At most 3**k rows meet in one; the iterations are
    a fold over them inside one row."""
    k = len(rules)
    total = lambda rows, value: F.aggregate(rows, F.lit(0.0), lambda acc, r: acc + value(r))

    def again(all_rows, accuracy):
        weighed = F.transform(
            all_rows,
            lambda r: F.struct(r["votes"].alias("v"), r["n"].cast("double").alias("n"), _posterior(r["votes"], accuracy, k, prior).alias("q")),
        )

        def rate(rows, j):
            x = lambda r: F.element_at(r["v"], j + 1)
            right = total(rows, lambda r: F.when(x(r) == 1, r["n"] * r["q"]).when(x(r) == -1, r["n"] * (1 - r["q"])).otherwise(0.0))
            cast = total(rows, lambda r: F.when(x(r) != 0, r["n"]).otherwise(0.0))
            value = F.when(cast > 0, right / cast).otherwise(ACCURACY)
            return F.least(F.greatest(value, F.lit(rules[j][3])), F.lit(rules[j][4]))

        return F.transform(F.array(weighed), lambda rows: F.array(*[rate(rows, j) for j in range(k)]))[0]

    start = F.array(*[F.lit(ACCURACY)] * k)
    rows = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("rows"))
    fitted = rows.select("rows", F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, lambda s, _: again(F.col("rows"), s)).alias("a"))
    return fitted.select(F.explode("rows").alias("r"), "a").select("r.votes", "r.n", _posterior(F.col("r.votes"), F.col("a"), k, prior).alias("posterior"))


def judge(counted: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """Rows with the counts of :func:`features`, plus base_failed, posterior and kept.

    ``counted`` is read twice; stage it first where it is costly. The table of patterns has at
    most 3**len(rules) rows, which is why it is broadcast.
    """
    voted = counted.withColumn("__votes", votes(rules))
    patterns = voted.groupBy(F.col("__votes").alias("votes")).agg(F.count("*").alias("n"))
    table = stage(estimate(patterns, rules), "patterns").select(F.col("votes").alias("__votes"), "posterior")
    return (
        voted.join(F.broadcast(table), "__votes")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
        .drop("__votes")
    )


def quality_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document the counts, the posterior and the verdict; texts are not moved."""
    counted = features(docs.select("doc_id", text), text).drop(text)
    return judge(stage(counted, "counts"))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that the rules keep, with their columns. The counts are made twice, for the
    patterns and for the verdicts, so that no copy of the texts is stored."""
    added = [*COUNTS, "posterior", "base_failed", "kept"]
    names = {c: f"__in_{c}" for c in docs.columns if c in added and c != text}
    # Conditions do not move below a number of the row: moved into the counts they would be made of
    # the text, and split it anew for every word.
    counted = features(docs.withColumnsRenamed(names), text).withColumn("__row", F.monotonically_increasing_id())
    back = {v: k for k, v in names.items()}
    return judge(counted).where("kept and __row >= 0").drop(*added).withColumnsRenamed(back).select(*docs.columns)

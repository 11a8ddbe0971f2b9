"""Quality rules as a learned decision list.

``statistics`` measures each text with native expressions. ``learn`` covers the bad ones
among labelled rows one rule at a time: a rule grows by the threshold condition of the
highest gain until it covers no good row of the growing part or no condition gains, is
then pruned back to the conditions that do best on the pruning part, and is kept if it is
precise enough there; the rows it covers are set aside. The result is a list of
conjunctions such as ``dup_line_share >= 0.31 AND n_words < 80``, emitted as one ordered
Spark conditional expression.

Thresholds are bin edges of the labelled rows, and counts per bin are made by Spark; the
driver sees only the table of counts, of as many rows as there are features and bins.
Everything is DataFrame functions; rows are never sampled unless ``sample`` bounds the
labelled rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.llm.names import set_aside
from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import written

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 3
#: Labelled rows learned from at most.
SAMPLE = 20_000
BINS = 24
MAX_RULES = 12
MAX_CONDITIONS = 4
#: Least rows a rule covers in growing, and least precision it keeps in pruning.
LEAST_COVER = 3
PRECISION = 0.95

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "upper_share", "digit_share", "end_mark_share", "exclamation_share",
)


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash of each window of ``WINDOW`` words, by its first word."""
    n = F.size(words)
    return F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), n - WINDOW + 1),
        lambda i: F.xxhash64(*[F.get(words, i + (k - 1)) for k in range(WINDOW)]),
    )).otherwise(F.array().cast("array<bigint>"))


def _covered(pairs: Column) -> Column:
    """Words inside windows that occur twice, from the sorted (hash, place) of all."""
    twice = F.filter(pairs, lambda p, i: (
        (F.get(pairs, i - 1)["h"] == p["h"]) | (F.get(pairs, i + 1)["h"] == p["h"])
    ))
    at = F.sort_array(F.transform(twice, lambda p: p["i"]))
    return F.aggregate(
        at,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda state, i: F.struct(
            (state["n"] + F.least(F.lit(WINDOW), i - state["last"])).alias("n"), i.alias("last")
        ),
        lambda state: state["n"],
    )


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with COUNTS, FEATURES and base_failed; input columns of these names are
    replaced, those whose names begin with ``dl_`` are returned as they are. Null and empty
    texts have zero counts. Shares of nothing are 0."""
    docs, aside = set_aside(docs, "dl_")
    text = aside.get(text, text)
    kept = [c for c in docs.columns if c not in {*COUNTS, *FEATURES, "base_failed"}]
    body = F.coalesce(F.col(text), F.lit(""))
    first = docs.select(
        *kept, body.alias("dl_text"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("dl_words"),
    )
    lines = F.filter(F.split("dl_text", "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    second = first.select(
        *kept, "dl_text", F.size("dl_words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("dl_text", r"[\x20\x09-\x0D]+", "")).cast("long")
        .alias("word_chars"),
        F.regexp_count("dl_text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        lines.alias("dl_lines"),
        _window_hashes(F.col("dl_words")).alias("dl_hashes"),
        F.size(F.array_distinct("dl_words")).alias("dl_distinct"),
        F.regexp_count("dl_text", F.lit("[A-Z]")).alias("dl_upper"),
        F.regexp_count("dl_text", F.lit("[0-9]")).alias("dl_digit"),
        F.regexp_count("dl_text", F.lit("!")).alias("dl_exclaim"),
        F.regexp_count("dl_text", F.lit(r"[.?](?=[\x20\x09-\x0D]|$)")).alias("dl_ends"),
    )
    third = second.select(
        *kept, "n_words", "word_chars", "n_symbols",
        (F.size("dl_lines") - F.size(F.array_distinct("dl_lines"))).cast("long")
        .alias("n_dup_lines"),
        # only texts with a repeated window are sorted; a column of its own, as the lambda
        # that reads it would otherwise work it out anew for each element
        F.when(F.size(F.array_distinct("dl_hashes")) < F.size("dl_hashes"), F.sort_array(
            F.transform("dl_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )).alias("dl_pairs"),
        F.size("dl_lines").alias("dl_n_lines"), "dl_distinct", "dl_upper", "dl_digit",
        "dl_exclaim", "dl_ends",
    )

    counted = third.withColumn(
        "n_repeat_words", F.coalesce(_covered(F.col("dl_pairs")), F.lit(0)).cast("long")
    )

    def share(part, whole) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return counted.select(
        *kept, *COUNTS,
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "dl_n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("dl_distinct", "n_words").alias("distinct_share"),
        share("dl_upper", "word_chars").alias("upper_share"),
        share("dl_digit", "word_chars").alias("digit_share"),
        share("dl_ends", "n_words").alias("end_mark_share"),
        share("dl_exclaim", "n_words").alias("exclamation_share"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .alias("base_failed"),
    ).withColumnsRenamed({new: old for old, new in aside.items()})


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float
    bin: int

    def column(self) -> Column:
        value, edge = F.col(self.feature).cast("double"), F.lit(self.threshold)
        return value >= edge if self.at_least else value < edge

    def binned(self) -> Column:
        value = F.col("b_" + self.feature)
        return value >= self.bin if self.at_least else value < self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _all(conditions: Sequence[Column]) -> Column:
    met = F.lit(True)
    for condition in conditions:
        met = met & condition
    return met


def verdict(rules: Sequence[Rule]) -> Column:
    """The number of the first rule that a row meets, from 1; 0 if none."""
    expression = F.lit(0)
    for number, rule in reversed(list(enumerate(rules, start=1))):
        expression = F.when(_all([c.column() for c in rule]), number).otherwise(expression)
    return expression


def describe(rules: Sequence[Rule]) -> list[str]:
    return [" AND ".join(str(c) for c in rule) for rule in rules]


def labelled_rows(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
                  label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """Documents with a label, at most ``sample`` labels: those of the smallest hash of
    the id. An id labelled more than once has its mean label, at least a half being good."""
    known = labels.select(F.col(id_column), F.col(label).alias("dl_label")).dropna()
    known = known.groupBy(id_column).agg((F.avg("dl_label") >= 0.5).alias("good"))
    known = known.orderBy(F.xxhash64(id_column), id_column).limit(sample)
    return docs.join(broadcast_if_small(written(known, "rules-labels")), id_column)


def learn(rows: DataFrame, features: Sequence[str] = FEATURES, good: str = "good",
          id_column: str = "doc_id") -> list[Rule]:
    """Rules that reject, in order, from ``rows`` with features and the boolean ``good``.
    No rules without rows, or if no bad row can be told apart."""
    prune = F.pmod(F.xxhash64(id_column, F.lit("prune")), F.lit(3)) == 0
    numbers = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]
    rows = written(
        rows.select(*numbers, F.col(good).alias("good"), prune.alias("prune")), "rules-rows"
    )
    steps = [(k + 1) / (BINS + 1) for k in range(BINS)]
    # edges of all rows, and of bad rows, as these are few
    asked = rows.agg(
        *[F.percentile_approx(f, steps, 10_000).alias(f) for f in features],
        *[F.percentile_approx(F.when(~F.col("good"), F.col(f)), steps, 10_000).alias("bad_" + f)
          for f in features],
    ).first()
    edges = {f: sorted({*(asked[f] or ()), *(asked["bad_" + f] or ())}) for f in features}
    binned = []
    for f in features:
        place = sum((F.when(F.col(f) >= F.lit(e), 1).otherwise(0) for e in edges[f]), F.lit(0))
        binned.append(place.alias("b_" + f))
    rows = written(rows.select("good", "prune", *binned), "rules-binned")

    def table(part: DataFrame) -> dict:
        """(feature, bin) -> good and bad rows, for the growing part."""
        cells = F.explode(F.array(*[
            F.struct(F.lit(f).alias("f"), F.col("b_" + f).alias("b")) for f in features]))
        counted = part.filter(~F.col("prune")).select(cells.alias("c"), "good").groupBy(
            "c.f", "c.b").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good"))
                              .alias("bad"))
        return {(r["f"], r["b"]): (r["good"], r["bad"]) for r in counted.collect()}

    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            counts = table(rows.filter(_all([c.binned() for c in rule])))
            best = _best(counts, edges, features)
            if best is None:
                break
            rule, pure = (*rule, best[0]), best[1]
            if pure:
                break
        if not rule:
            break
        rule = _pruned(rows, rule)
        if not rule:
            break
        rules.append(rule)
        rows = rows.filter(~_all([c.binned() for c in rule]))
    return rules


def _best(counts: dict, edges: dict, features: Sequence[str]):
    """The condition of the highest gain in the sense of FOIL, and whether it leaves no
    good rows; None if nothing gains."""
    best, most = None, 1e-9
    for f in features:
        good = sum(g for (name, _), (g, _) in counts.items() if name == f)
        bad = sum(b for (name, _), (_, b) in counts.items() if name == f)
        if not bad or not good:
            return None
        below_good = below_bad = 0
        for k, edge in enumerate(edges[f], start=1):
            g, b = counts.get((f, k - 1), (0, 0))
            below_good, below_bad = below_good + g, below_bad + b
            sides = ((False, below_good, below_bad), (True, good - below_good, bad - below_bad))
            for at_least, p_good, p_bad in sides:
                if p_bad < LEAST_COVER:
                    continue
                gain = p_bad * (log2(p_bad / (p_bad + p_good)) - log2(bad / (bad + good)))
                if gain > most:
                    best, most = (Condition(f, at_least, float(edge), k), p_good == 0), gain
    return best


def _pruned(rows: DataFrame, rule: Rule) -> Rule:
    """The first conditions of the rule that do best on the pruning part, or nothing if
    they are not precise enough in either part."""
    met = [_all([c.binned() for c in rule[: k + 1]]) for k in range(len(rule))]
    sums = []
    for k, m in enumerate(met):
        for part, chosen in (("g", ~F.col("prune")), ("p", F.col("prune"))):
            sums.append(F.count_if(m & chosen & ~F.col("good")).alias(f"bad_{part}{k}"))
            sums.append(F.count_if(m & chosen & F.col("good")).alias(f"good_{part}{k}"))
    seen = rows.agg(*sums).first()
    best, most = 0, None
    for k in range(len(rule)):
        bad, good = seen[f"bad_p{k}"], seen[f"good_p{k}"]
        value = (bad - good) / (bad + good) if bad + good else -1.0
        all_bad, all_good = bad + seen[f"bad_g{k}"], good + seen[f"good_g{k}"]
        precise = all_bad >= PRECISION * (all_bad + all_good)
        if precise and (most is None or value > most):
            best, most = k + 1, value
    return rule[:best]


def apply(measured: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows of ``statistics`` with rule (0: none rejects) and kept."""
    return measured.withColumn("rule", verdict(rules)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )

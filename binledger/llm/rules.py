"""Quality rules: statistics of texts in built-in expressions, and decision lists of
threshold conjunctions learned from labelled rows by sequential covering."""

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.staging import staged

BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SAMPLE_ROWS = 20_000


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the ``STATISTICS`` of its whole texts as BIGINT columns, and
    n_lines and n_upper that rules may use besides.

    n_words: runs of characters other than blanks (0x20, 0x09 to 0x0D); word_chars: code
    points in them; n_symbols: characters of ``#*$%&|<>``; n_lines: \\n-split lines with a
    word, n_dup_lines: those equal to an earlier one; n_repeat_words: words in windows of
    three words that the text has twice or more; n_upper: upper-case letters. A missing
    text counts as empty: all are 0. Each row stands for itself; columns of these names
    are replaced. Windows are compared by a 64-bit hash.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    names = [*STATISTICS, "n_lines", "n_upper"]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(NOT_BLANK))
    split = df.select(
        *kept,
        F.filter(F.split(value, BLANKS), lambda x: x != "").alias("_words"),
        lines.alias("_lines"),
        F.length(F.regexp_replace(value, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(value, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
    )
    words = F.col("_words")
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )
    counted = split.select(
        *kept,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        "n_upper",
        F.sort_array(windows).alias("_sorted"),
    )
    ordered = F.col("_sorted")

    def repeated(window, k):
        near = F.coalesce(F.get(ordered, k + 1)["h"] == window["h"], F.lit(False))
        return near | F.coalesce(F.get(ordered, k - 1)["h"] == window["h"], F.lit(False))

    found = counted.withColumn("_places", F.sort_array(F.transform(F.filter(ordered, repeated), lambda x: x["i"])))
    places = F.col("_places")
    covered = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b)
    columns = [(total if c == "n_repeat_words" else F.col(c)).alias(c) for c in names]
    # As a generator's output, so that a filter on them is not pushed below and worked out
    # anew for each column that it names.
    return found.select(*kept, F.inline(F.array(F.struct(*columns))))


def base_failed():
    """The fixed rule before the learned ones, on the columns of ``text_statistics``."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features():
    """What the learned rules may compare with a threshold: name -> column."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "chars_per_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
    }


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` if above, else ``feature <= threshold``."""

    feature: str
    above: bool
    threshold: float

    def column(self):
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def labelled_sample(labels: DataFrame, key: str = "doc_id", label: str = "quality", rows: int = SAMPLE_ROWS) -> DataFrame:
    """key and good (1 or 0) of at most ``rows`` labelled keys, picked by a hash of the
    key. A key with several labels is good if one says so; missing ones are left out."""
    each = labels.select(F.col(f"`{key}`").alias(key), F.col(f"`{label}`").alias("good")).dropna()
    return each.groupBy(key).agg(F.max("good").alias("good")).orderBy(F.xxhash64(key), key).limit(rows)


def learn_rules(
    labelled: DataFrame,
    good: str = "good",
    max_rules: int = 8,
    max_conditions: int = 3,
    cuts: int = 24,
    least_precision: float = 0.95,
    least_covered: int = 5,
) -> list[list[Condition]]:
    """Ordered rules that tell bad rows (``good`` = 0), learned one after the other.

    ``labelled`` holds the columns of ``text_statistics`` and the label. Two thirds of
    the rows, by a hash, grow a rule: the condition of the highest information gain is
    added until it covers no good row. The others prune it: last conditions go while that
    does not lower its worth on them. A rule that covers fewer than ``least_covered`` bad
    rows, or with a precision below ``least_precision`` there, ends the list; otherwise
    the rows it covers leave both sets. Thresholds lie half-way between quantiles of either class. Rows
    without a label do not count; with one class or no rows the list is empty.

    The driver sees counts per threshold only, and the job count does not depend on the
    number of rows. Ties go to the feature and threshold that sort first.
    """
    names = list(features())
    rows = labelled.select(
        *[c.alias(n) for n, c in features().items()],
        (F.col(good) == 0).cast("int").alias("bad"),
        (F.pmod(F.xxhash64(*STATISTICS, "n_upper"), F.lit(3)) < 2).alias("grow"),
    ).filter("bad is not null")
    rows = staged(rows.coalesce(8), "rule-rows")
    shares = [i / cuts for i in range(1, cuts)]
    wanted = [F.percentile_approx(n, shares, 10_000).alias(n) for n in names]
    found = rows.groupBy("bad").agg(*wanted).collect()
    if len(found) < 2:
        return []
    thresholds = {}
    for name in names:
        values = sorted({v for r in found for v in r[name]})
        thresholds[name] = [(a + b) / 2 for a, b in zip(values, values[1:])] or values
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("value")) for n in names])).alias("f")
    limits = F.create_map(*[x for n in names for x in (F.lit(n), F.array(*map(F.lit, thresholds[n])))])

    def best_condition(df, bad0, good0):
        """The condition with the highest gain over the rows left."""
        each = df.select(pairs, "bad").select("f.feature", "f.value", "bad")
        place = F.size(F.filter(limits[F.col("feature")], lambda t: t < F.col("value")))
        counts = each.groupBy("feature", place.alias("bin")).agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect()
        best, top = None, 1e-9
        base = math.log2(bad0 / (bad0 + good0))
        for name in sorted(names):
            bins = {r["bin"]: (r["bad"], r["n"] - r["bad"]) for r in counts if r["feature"] == name}
            bad = fine = 0
            for i, limit in enumerate(thresholds[name]):
                bad, fine = bad + bins.get(i, (0, 0))[0], fine + bins.get(i, (0, 0))[1]
                for above, p, n in ((False, bad, fine), (True, bad0 - bad, good0 - fine)):
                    gain = p * (math.log2(p / (p + n)) - base) if p else 0
                    if gain > top:
                        best, top = (Condition(name, above, limit), p, n), gain
        return best

    def holds(conditions):
        tests = [F.col(c.feature) > c.threshold if c.above else F.col(c.feature) <= c.threshold for c in conditions]
        out = F.lit(True)
        for test in tests:
            out = out & test
        return out

    rules, left = [], rows
    while len(rules) < max_rules:
        grow, rule = left.filter("grow"), []
        bad, fine = grow.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum(1 - F.col("bad")), F.lit(0))).first()
        while bad and fine and len(rule) < max_conditions:
            step = best_condition(grow.filter(holds(rule)), bad, fine)
            if step is None:
                break
            rule.append(step[0])
            _, bad, fine = step
        if not rule:
            break
        covered = []
        for k in range(1, len(rule) + 1):
            inside = holds(rule[:k])
            covered += [F.sum(F.when(inside, F.col("bad"))), F.count(F.when(inside, 1))]
        counts = left.filter(~F.col("grow")).agg(*[c.alias(f"c{i}") for i, c in enumerate(covered)]).first()
        worth = [((2 * (counts[2 * k] or 0) - counts[2 * k + 1]) / max(counts[2 * k + 1], 1), -k) for k in range(len(rule))]
        k = -max(worth)[1]
        hit, n = counts[2 * k] or 0, counts[2 * k + 1]
        if hit < least_covered or hit < least_precision * n:
            break
        rules.append(rule[: k + 1])
        left = left.filter(~holds(rules[-1]))
    return rules


def accepted(rules: list[list[Condition]]):
    """The decision list as one conditional expression: false at the first rule whose
    conditions all hold, else true."""
    verdict = None
    for rule in rules:
        test = rule[0].column()
        for condition in rule[1:]:
            test = test & condition.column()
        verdict = F.when(test, False) if verdict is None else verdict.when(test, False)
    return F.lit(True) if verdict is None else verdict.otherwise(True)


def judged(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with the columns of ``text_statistics``, base_failed and kept (false
    if base_failed, else what the rules learned from ``labels`` say).

    The rules are fitted on at most ``SAMPLE_ROWS`` labelled rows; statistics and verdict
    cover every row and whole texts. Documents without label, copies and missing keys are
    judged as any other; with no labels the base rule alone decides.
    """
    sample = F.broadcast(labelled_sample(labels, key))  # SAMPLE_ROWS rows at most
    training = documents.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias(text)).join(sample, key)
    rules = learn_rules(text_statistics(training, text))
    return text_statistics(documents, text).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & accepted(rules)
    )

"""Quality rules: learned decision lists over text statistics.

Everything here is DataFrame expressions. ``text_statistics`` turns each text
into counts; ``learn_rules`` grows and prunes conjunctions of thresholds by
sequential covering; ``verdict`` turns the list into one ordered conditional
expression.

Learning sees the rows only as histograms: every step is one grouped count of
(statistic, bin, label, part), at most ``len(STATISTICS) * (MAX_BIN + 1) * 4``
rows for any number of labelled rows. Thresholds lie on one fixed logarithmic
grid, so they do not depend on the order or the number of the rows.

Defined results: a null text counts as an empty one (no words, all counts 0,
all ratios 0); a null label, and a label other than 0 and 1, teaches nothing;
repeated rows count each time; with no labelled rows the list is empty and the
verdict is "keep".
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
#: White space between words: space and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = "[^ \\t-\\r]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

STATISTICS = (
    "n_words",
    "mean_word_chars",
    "symbols_per_word",
    "bangs_per_word",
    "capitals_per_char",
    "distinct_word_share",
    "dup_line_share",
    "repeat_word_share",
)
#: Bin b of the grid starts at (2 ** (b / STEPS) - 1) / SCALE.
STEPS, SCALE, MAX_BIN = 8, 16, 150
EDGES = [(2.0 ** (b / STEPS) - 1) / SCALE for b in range(MAX_BIN + 2)]


def _chars_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once though ``body`` uses it in lambdas."""
    return F.transform(F.array(value), body)[0]


def _covered_words(keys: Column) -> Column:
    """Words inside windows whose key occurs twice or more in the text."""
    pairs = F.array_sort(F.transform(keys, lambda key, at: F.struct(key.alias("key"), at.alias("at"))))

    def repeated(pairs: Column) -> Column:
        last = F.size(pairs) - 1
        return F.filter(
            F.transform(
                pairs,
                lambda pair, i: F.when(
                    ((i > 0) & (pairs[F.greatest(i - 1, F.lit(0))]["key"] == pair["key"]))
                    | ((i < last) & (pairs[F.least(i + 1, last)]["key"] == pair["key"])),
                    pair["at"],
                ),
            ),
            lambda at: at.isNotNull(),
        )

    def reach(starts: Column) -> Column:
        # A window adds what the next repeated window does not cover itself.
        return F.zip_with(
            starts,
            F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
            lambda at, following: F.least(F.coalesce(following - at, F.lit(WINDOW)), F.lit(WINDOW)),
        )

    starts = F.array_sort(_bound(pairs, repeated))
    return F.aggregate(_bound(starts, reach), F.lit(0).cast("long"), lambda total, n: total + n)


def text_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the statistics of each text.

    Words are runs of anything but white space. Windows are eight consecutive
    words, compared by 64-bit hashes of their words' 64-bit hashes within one
    text. Texts without repeated windows, nearly all, skip the sort.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = docs.select(
        *keep,
        whole.alias("_text"),
        F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)).alias("_words"),
    )
    hashed = words.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        (F.length("_text") - _chars_of(F.col("_text"), BLANKS)).cast("long").alias("word_chars"),
        _chars_of(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        _chars_of(F.col("_text"), "!").cast("long").alias("n_bangs"),
        _chars_of(F.col("_text"), CAPITALS).cast("long").alias("n_capitals"),
        F.filter(F.split("_text", "\n", -1), lambda line: F.trim(F.translate(line, BLANKS, "")) != "").alias("_lines"),
        F.transform("_words", lambda word: F.xxhash64(word)).alias("_hashes"),
    )
    keyed = hashed.withColumn(
        "_keys",
        F.when(
            F.col("n_words") < WINDOW, F.array().cast("array<bigint>")
        ).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.col("n_words").cast("int") - (WINDOW - 1), F.lit(1))),
                lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW)),
            )
        ),
    )
    counted = keyed.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_bangs",
        "n_capitals",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_hashes")).cast("long").alias("n_distinct_words"),
        F.when(F.size(F.array_distinct("_keys")) == F.size("_keys"), F.lit(0).cast("long"))
        .otherwise(_covered_words(F.col("_keys")))
        .alias("n_repeat_words"),
    )
    share = lambda part, total: F.when(F.col(total) > 0, F.col(part) / F.col(total)).otherwise(F.lit(0.0))
    return counted.select(
        "*",
        share("word_chars", "n_words").alias("mean_word_chars"),
        share("n_symbols", "n_words").alias("symbols_per_word"),
        share("n_bangs", "n_words").alias("bangs_per_word"),
        share("n_capitals", "word_chars").alias("capitals_per_char"),
        share("n_distinct_words", "n_words").alias("distinct_word_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_word_share"),
    )


@dataclass(frozen=True)
class Test:
    """One threshold: the statistic's bin is at least, or below, ``bin``."""

    statistic: str
    at_least: bool
    bin: int

    def column(self) -> Column:
        edge = EDGES[self.bin]
        value = F.col(self.statistic).cast("double")
        return value >= edge if self.at_least else value < edge

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<'} {EDGES[self.bin]:.6g}"


Rule = tuple[Test, ...]


def _matches(rule: Rule) -> Column:
    found = F.lit(True)
    for test in rule:
        found = found & test.column()
    return found


def _bin(statistic: str) -> Column:
    """The number of grid edges at or below the value, less one; exact at the edges."""
    value = F.col(statistic).cast("double")
    near = F.least(F.floor(F.log2(F.lit(1.0) + value * SCALE) * STEPS).cast("int"), F.lit(MAX_BIN))
    edges = F.array(*map(F.lit, EDGES))
    return near + F.when((near < MAX_BIN) & (value >= edges[near + 1]), 1).when(value < edges[near], -1).otherwise(0)


def _histogram(rows: DataFrame) -> dict[tuple[str, bool], dict[int, tuple[int, int]]]:
    """Counts (bad, good) by (statistic, is it the pruning part) and bin."""
    cells = (
        rows.select(
            F.col("_bad"),
            F.col("_prune"),
            F.explode(
                F.array(*(F.struct(F.lit(name).alias("statistic"), _bin(name).alias("bin")) for name in STATISTICS))
            ).alias("cell"),
        )
        .groupBy("cell.statistic", "cell.bin", "_prune")
        .agg(F.sum(F.col("_bad").cast("long")).alias("bad"), F.count("*").alias("n"))
        .collect()
    )
    found: dict[tuple[str, bool], dict[int, tuple[int, int]]] = {}
    for cell in cells:
        found.setdefault((cell["statistic"], cell["_prune"]), {})[cell["bin"]] = (cell["bad"], cell["n"] - cell["bad"])
    return found


def _total(bins: dict[int, tuple[int, int]]) -> tuple[int, int]:
    return sum(b for b, _ in bins.values()), sum(g for _, g in bins.values())


def _best_test(histogram: dict, least: int) -> tuple[Test | None, tuple[int, int]]:
    """The threshold with the largest information gain over the growing part."""
    best, kept, top = None, (0, 0), 1e-9
    for statistic in STATISTICS:
        bins = histogram.get((statistic, False), {})
        bad, good = _total(bins)
        if not bad:
            continue
        before = log2(bad / (bad + good))
        low_bad = low_good = 0
        edges = sorted(bins)
        for low, edge in zip(edges, edges[1:], strict=False):
            low_bad, low_good = low_bad + bins[low][0], low_good + bins[low][1]
            for at_least, b, g in ((True, bad - low_bad, good - low_good), (False, low_bad, low_good)):
                if b >= least and (gain := b * (log2(b / (b + g)) - before)) > top:
                    best, kept, top = Test(statistic, at_least, edge), (b, g), gain
    return best, kept


def learn_rules(
    rows: DataFrame,
    label: str = "quality",
    id: str = "doc_id",
    max_rules: int = 8,
    max_tests: int = 4,
    least_bad: int = 5,
    least_precision: float = 0.98,
) -> list[Rule]:
    """Conjunctions that find rows labelled 0, in the order they were learned.

    ``rows`` has the statistics, ``label`` and ``id``. Two thirds of the rows
    (by a hash of the id) grow each rule one threshold at a time; the last
    third prunes it from the end and decides if it is precise enough. Rows that
    an accepted rule matches no longer count for later ones.
    """
    base = rows.where(F.col(label).isin(0, 1)).select(
        (F.col(label) == 0).alias("_bad"),
        (F.pmod(F.xxhash64(F.col(id)), F.lit(3)) == 0).alias("_prune"),
        *STATISTICS,
    )
    rules: list[Rule] = []
    for _ in range(max_rules):
        left = base
        for rule in rules:
            left = left.where(~_matches(rule))
        grown: list[tuple[Test, tuple[int, int]]] = []
        reached = left
        histogram = _histogram(reached)
        while len(grown) < max_tests:
            test, (bad, good) = _best_test(histogram, least_bad)
            if test is None:
                break
            reached = reached.where(test.column())
            histogram = _histogram(reached)
            grown.append((test, _total(histogram.get((STATISTICS[0], True), {}))))
            if not good:
                break
        worth = lambda counts: (counts[0] - counts[1]) / max(1, sum(counts))
        size = max(range(len(grown) + 1), key=lambda n: (worth(grown[n - 1][1]) if n else 0.0, -n))
        if not size:
            break
        bad, good = grown[size - 1][1]
        if bad < max(1, least_bad // 2) or bad < least_precision * (bad + good):
            break
        rules.append(tuple(test for test, _ in grown[:size]))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True where no rule matches: one conditional expression, rules in order."""
    if not rules:
        return F.lit(True)
    found = F.when(_matches(rules[0]), F.lit(False))
    for rule in rules[1:]:
        found = found.when(_matches(rule), F.lit(False))
    return found.otherwise(F.lit(True))


def base_failed() -> Column:
    """Fewer than 20 words, or over 30 % of the words in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))

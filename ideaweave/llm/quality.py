"""Quality rules: one projection of built-in functions, compiled from a threshold table.

Every figure (word count, word characters, symbols, repeated lines, repeated five-word windows,
stop words) comes from array and string functions on the row itself: no shuffle, no Python.

Defined results: a null or empty text has zero words and fails; figures of the same text are the
same in every row; an empty table gives an empty result; other columns pass through untouched.
Five-word windows are compared by the 64-bit hash of their five words inside one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

# Frequent function words, a parameter of the stop-word rule: English, German, French, Spanish, Italian,
# Portuguese, Dutch, Danish, Swedish, Polish. Other languages in Latin script must use the rule with a
# list of their own; texts in other scripts are not asked (``latin``).
STOP_WORDS = (
    "the of and to in is that it for was with as on are by at be this an from he she or not "
    "der die das und zu den mit von ist im ein eine nicht sich auf für des dem auch "
    "le la les de du et des un une en que est pour dans qui sur par pas au il elle ne "
    "el los las y del se por con una su para lo como más al un es "
    "di che è e per non sono della nel gli ma "
    "o os da do em não uma com mais dos das na no "
    "het een van dat niet zijn op te voor met maar "
    "og det at ikke til af har som jeg vi "
    "och att inte är för men på "
    "w i z na się że jest do nie"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``, asked only of texts of ``min_words`` words or more and,
    if ``latin``, of at most 1.5 UTF-8 bytes a character (what texts in Latin script have)."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0
    latin: bool = False


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbol_ratio", "n_symbols", "n_words", high=0.1),
    Rule("exclamation_ratio", "n_exclamations", "n_words", high=0.2),
    Rule("echo_ratio", "n_echoes", "n_words", high=0.2),  # words equal to the word before
    Rule("stop_word_ratio", "n_stop_words", "n_words", low=0.02, min_words=50, latin=True),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", high=0.5),
)


def _repeat_words(words: Column) -> Column:
    """Words covered by a five-word window that occurs twice or more in the same text."""
    k = WINDOW

    def windows(h: Column) -> Column:
        n = F.greatest(F.size(h) - F.lit(k - 1), F.lit(0))
        return F.transform(F.slice(h, F.lit(1), n),
                           lambda x, i: F.xxhash64(x, *[F.get(h, i + F.lit(j)) for j in range(1, k)]))

    def covered(w: Column) -> Column:
        pairs = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def starts(s: Column) -> Column:
            def same(e: Column, i: Column) -> Column:
                before = F.get(s, i - F.lit(1))["h"] == e["h"]
                after = F.get(s, i + F.lit(1))["h"] == e["h"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))
            return F.array_sort(F.transform(F.filter(s, same), lambda e: e["p"]))

        def width(p: Column) -> Column:
            steps = F.transform(p, lambda x, i: F.least(F.lit(k), F.coalesce(F.get(p, i + F.lit(1)) - x, F.lit(k))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(let(pairs, starts), width)

    return let(let(F.transform(words, lambda x: F.xxhash64(x)), windows),
               lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))


def figures(text: Column, stop_words=STOP_WORDS) -> Column:
    """Struct of every figure the rules use."""
    t = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))

    def of(v: Column) -> Column:
        return F.struct(
            F.size(v["w"]).cast("long").alias("n_words"),
            F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(v["l"]) - F.size(F.array_distinct(v["l"]))).cast("long").alias("n_dup_lines"),
            _repeat_words(v["w"]).cast("long").alias("n_repeat_words"),
            (F.length(t) - F.length(F.translate(t, "!", ""))).cast("long").alias("n_exclamations"),
            F.size(F.filter(v["w"], lambda x: F.lower(x).isin(*stop_words))).cast("long").alias("n_stop_words"),
            F.size(F.filter(v["w"], lambda x, i: x == F.get(v["w"], i - F.lit(1)))).cast("long").alias("n_echoes"),
            F.size(v["l"]).cast("long").alias("n_lines"),
            F.octet_length(t).cast("long").alias("n_bytes"),
            F.length(t).cast("long").alias("n_chars"),
        )

    return let(F.struct(words.alias("w"), lines.alias("l")), of)


def failed_rules(m: Column, rules=RULES) -> Column:
    """Names of the rules a document breaks, from the figures struct ``m``."""
    broken = []
    for r in rules:
        num, den = m[r.numerator].cast("double"), m[r.denominator].cast("double")
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (num < F.lit(r.low) * den)
        if r.high is not None:
            bad = bad | (num > F.lit(r.high) * den)
        asked = m["n_words"] >= r.min_words
        if r.latin:
            asked = asked & (F.lit(2) * m["n_bytes"] <= F.lit(3) * m["n_chars"])
        broken.append(F.when(bad & asked, F.lit(r.name)))
    return F.filter(F.array(*broken), lambda x: x.isNotNull())


def base_failed(m: Column) -> Column:
    return ((m["n_words"] < MIN_WORDS)
            | (F.lit(100) * m["n_repeat_words"] > F.lit(MAX_REPEAT_PERCENT) * m["n_words"]))


def quality(df: DataFrame, text: str = "text", rules=RULES, out: str = "quality") -> DataFrame:
    """``df`` with a struct column ``out``: the figures, ``failed_rules``, ``base_failed``, ``kept``."""
    def verdict(m: Column) -> Column:
        def judged(f: Column) -> Column:
            base = base_failed(m)
            return F.struct(*[m[c].alias(c) for c in (
                "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "n_exclamations", "n_stop_words", "n_echoes", "n_lines")],
                f.alias("failed_rules"), base.alias("base_failed"),
                (~base & (F.size(f) == 0)).alias("kept"))
        return let(failed_rules(m, rules), judged)

    return df.withColumn(out, let(figures(df[text]), verdict))

"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a native expression over the whole text; there is no shuffle and no user
function, so a text is judged where it is read.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words, and the characters that count as symbols.
WHITE_SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!?"
WORD_BREAK = r"[\x20\x09-\x0D]+"
REPEAT_WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was on are as with be by at this from or an a "
    "der die das und ist nicht ein eine zu den von mit sich des auf für im dem auch als "
    "le la les et est un une des que en dans du pour qui sur au par plus ce "
    "el los las y es que en un una por con del se para no su al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if ``low <= measure <= high``; None leaves a side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("few_words", "n_words", low=20),
    Rule("repeated_words", "repeat_ratio", high=0.3),
    Rule("short_words", "mean_word_length", low=2.0),
    Rule("long_words", "mean_word_length", high=14.0),
    Rule("symbols", "symbol_ratio", high=0.3),
    Rule("marks", "mark_ratio", high=0.5),
    Rule("stop_words", "stop_word_ratio", low=0.03),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
)
BASE_RULES = ("few_words", "repeated_words")


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts and ratios of its texts.

    Counts: n_words, word_chars, n_symbols, n_marks, n_stop_words, n_lines (lines with a word),
    n_dup_lines (lines with a word equal to an earlier one), n_repeat_words (words in
    8-word windows that the text holds twice or more).  A null or empty text counts
    0 everywhere, and its ratios are 0.  Columns of these names are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    # Each step names what the next one uses more than once, so it is computed once.
    out = df.withColumn(
        "_words", F.filter(F.split(whole, WORD_BREAK), lambda word: word != "")
    ).withColumn(
        "_lines",
        F.filter(F.split(whole, "\n"), lambda line: _without(line, WHITE_SPACE) != ""),
    )
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(_without(whole, WHITE_SPACE)).cast("long"),
            "n_symbols": _count(whole, SYMBOLS),
            "n_marks": _count(whole, MARKS),
            "n_stop_words": _stop_words("_words"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": _windows("_words"),
        }
    )
    out = out.withColumn("_sorted", _sorted_windows("_windows")).withColumn(
        "_places", _repeated_places("_sorted")
    )
    out = out.withColumn("n_repeat_words", _covered("_places").cast("long"))
    per_word = {
        "mean_word_length": "word_chars",
        "symbol_ratio": "n_symbols",
        "mark_ratio": "n_marks",
        "stop_word_ratio": "n_stop_words",
        "repeat_ratio": "n_repeat_words",
    }
    ratios = {name: _ratio(count, "n_words") for name, count in per_word.items()}
    ratios["dup_line_ratio"] = _ratio("n_dup_lines", "n_lines")
    return out.withColumns(ratios).drop("_words", "_lines", "_windows", "_sorted", "_places")


def passes(rules=RULES) -> Column:
    """The threshold table as one boolean expression over the measures."""
    verdict = F.lit(True)
    for rule in rules:
        verdict = verdict & _passes(rule)
    return verdict


def failures(rules=RULES) -> Column:
    """Names of the rules a text fails, in the order of the table."""
    named = [F.when(~_passes(rule), F.lit(rule.name)) for rule in rules]
    return F.filter(F.array(*named), lambda name: name.isNotNull())


def judge(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``df`` with its measures, ``failed_rules`` and ``kept``.

    A null or empty text fails few_words.  Repeated rows are judged alike; other columns
    pass through.
    """
    measured = measures(df, text)
    return measured.withColumns({"failed_rules": failures(rules), "kept": passes(rules)})


def _passes(rule: Rule) -> Column:
    verdict = F.lit(True)
    if rule.low is not None:
        verdict = verdict & (F.col(rule.measure) >= rule.low)
    if rule.high is not None:
        verdict = verdict & (F.col(rule.measure) <= rule.high)
    return verdict


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(_without(text, characters))).cast("long")


def _ratio(count: str, of: str) -> Column:
    return F.when(F.col(of) > 0, F.col(count) / F.col(of)).otherwise(F.lit(0.0))


def _stop_words(words: str) -> Column:
    def is_stop(word):
        return F.lower(word).isin(STOP_WORDS)

    return F.size(F.filter(words, is_stop)).cast("long")


def _windows(words: str) -> Column:
    """A hash of the window that starts at each word."""
    last = F.size(words) - (REPEAT_WINDOW - 1)
    hashes = F.transform(
        F.sequence(F.lit(1), last),
        lambda place: F.xxhash64(F.slice(words, place, F.lit(REPEAT_WINDOW))),
    )
    return F.when(last >= 1, hashes).otherwise(F.array().cast("array<bigint>"))


def _sorted_windows(windows: str) -> Column:
    """(hash, place) in order, or null if no hash comes twice, as in most texts."""
    pairs = F.transform(windows, lambda h, place: F.struct(h.alias("h"), place.alias("p")))
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(repeats, F.sort_array(pairs))


def _repeated_places(windows: str) -> Column:
    """Places of the windows that come twice or more, in order."""
    following = F.slice(windows, F.lit(2), F.size(windows))
    twins = F.zip_with(
        windows,
        following,
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])),
    )
    found = F.flatten(F.filter(twins, lambda pair: pair.isNotNull()))
    return F.sort_array(F.array_distinct(found))


def _covered(places: str) -> Column:
    """Words under windows that start at these places."""
    following = F.slice(places, F.lit(2), F.size(places))
    widths = F.zip_with(
        places,
        following,
        lambda a, b: F.least(F.coalesce(b - a, F.lit(REPEAT_WINDOW)), F.lit(REPEAT_WINDOW)),
    )
    total = F.aggregate(widths, F.lit(0), lambda sum_, width: sum_ + width)
    return F.coalesce(total, F.lit(0))

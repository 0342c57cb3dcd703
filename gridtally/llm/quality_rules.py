"""Quality rules: a threshold table compiled into one projection of built-in functions.

Base columns count words, symbols, repeated lines and repeated word windows of the whole text; the
table then bounds lengths and ratios of them. No rule runs user code and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"
NOT_WHITE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
TRAILING = ".,;:!?\"')]}" + SYMBOLS

# The commonest function words of English, German, French and Spanish.
STOP_WORDS = (
    "a", "an", "and", "as", "at", "be", "by", "for", "from", "has", "have", "he", "in", "is", "it", "of", "on", "or",
    "that", "the", "this", "to", "was", "with",
    "auf", "aus", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "ist", "mit", "nicht", "sich", "und",
    "von", "zu",
    "au", "aux", "avec", "ce", "dans", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "par", "pas", "pour",
    "que", "qui", "sur", "un", "une",
    "al", "con", "de", "del", "el", "lo", "los", "las", "más", "no", "para", "por", "se", "su", "una", "y",
)


@dataclass(frozen=True)
class Rule:
    """``low <= scale * top / bottom <= high``; a side that is None is open; an empty bottom passes."""

    name: str
    top: str
    bottom: str
    low: float | None = None
    high: float | None = None
    langs: tuple[str, ...] = ()  # only for texts of these languages; none: for all


#: Codes of the languages that STOP_WORDS covers.
STOP_LANGUAGES = ("en", "eng", "de", "deu", "ger", "fr", "fra", "fre", "es", "spa")

RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", high=0.3),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02, langs=STOP_LANGUAGES),
    Rule("shouting_words", "n_shouted_words", "n_words", high=0.5),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
    Rule("open_lines", "n_open_lines", "n_lines", high=0.3),
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Words lying in a window that the text has twice or more.

    Windows are sorted as (hash, place): copies become neighbours. Their places, sorted again, each
    add the words that the one before does not reach.
    """
    seen = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    with_seen = lambda s: F.filter(
        F.transform(
            s,
            lambda p, j: F.when(
                F.coalesce(F.get(s, j - 1)["h"] == p["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == p["h"], F.lit(False)),
                p["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    bound = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))
    places = bound(seen, lambda s: F.sort_array(with_seen(s)))
    return bound(
        places,
        lambda at: F.aggregate(
            F.transform(at, lambda i, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - i, F.lit(3)))),
            F.lit(0),
            lambda total, x: total + x,
        ),
    )


def private(docs: DataFrame) -> str:
    """A start of column names that no column of ``docs`` has."""
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in docs.columns), default=0))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the count columns that the rules bound; a null text counts as no words."""
    own = private(docs)
    words, lines, hashes = (f"{own}{name}" for name in ("words", "lines", "hashes"))
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns(
        {
            words: F.filter(F.split(body, WORD_BREAK), lambda w: w != ""),
            lines: F.filter(F.split(body, "\n"), lambda x: x.rlike(NOT_WHITE)),
            "n_symbols": F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("long"),
        }
    )
    bare = lambda w: F.rtrim(w, F.lit(TRAILING))
    out = out.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_stop_words": F.size(F.filter(words, lambda w: F.lower(bare(w)).isin(*STOP_WORDS))).cast("long"),
            "n_shouted_words": F.size(F.filter(words, lambda w: (w == F.upper(w)) & (w != F.lower(w)))).cast("long"),
            "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•|]"))).cast("long"),
            "n_open_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))).cast("long"),
            hashes: F.when(
                F.size(words) >= 3,
                F.transform(
                    F.sequence(F.lit(0), F.size(words) - 3),
                    lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    )
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    out = out.withColumn("n_repeat_words", F.when(some, _repeat_words(F.col(words), F.col(hashes))).otherwise(0).cast("long"))
    return out.drop(words, lines, hashes)


def _in_language(langs: tuple[str, ...], text: Column, lang: Column) -> Column:
    """Whether a text is of one of the languages; without a label, whether its letters are mostly Latin ones."""
    code = F.lower(F.regexp_extract(lang, r"^\s*(\p{Alpha}+)", 1))
    labelled = F.coalesce(~code.isin("", "und", "unknown"), F.lit(False))
    n_letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    n_latin = F.length(F.regexp_replace(text, r"\P{IsLatin}+", ""))
    return F.when(labelled, code.isin(*langs)).otherwise(2 * n_latin >= n_letters)


def verdict(rules: tuple[Rule, ...] = RULES, own: str = "_") -> Column:
    """Names of the rules a measured row breaks; empty for a kept row.

    For a rule of some languages, the column ``own`` + ``in_`` and its name tells whether the row is in one of them.
    """
    broken = []
    for rule in rules:
        ratio = F.col(rule.top) / F.col(rule.bottom)
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (ratio < rule.low)
        if rule.high is not None:
            bad = bad | (ratio > rule.high)
        if rule.langs:
            bad = F.col(f"{own}in_{rule.name}") & bad
        broken.append(F.when((F.col(rule.bottom) > 0) & bad, F.lit(rule.name)))
    return F.filter(F.array(*broken), lambda name: name.isNotNull())


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, lang: str = "lang") -> DataFrame:
    """``docs`` with counts, ``base_failed``, ``broken_rules`` and ``kept``.

    A null or empty text has no words and fails the base; ties do not arise, each row is judged alone,
    so repeated rows get the same verdict. Whole texts are read, however long; an empty table gives no rows.
    Columns of ``docs`` that have the name of a measure are replaced, all others are passed on.
    ``lang`` names the column of language codes, if there is one.
    """
    label = F.col(lang) if lang in docs.columns else F.lit(None)
    body = F.coalesce(F.col(text), F.lit(""))
    # Told before the text is measured, so that it need not be carried on.
    own = private(docs)
    languages = {f"{own}in_{r.name}": _in_language(r.langs, body, label.cast("string")) for r in rules if r.langs}
    out = measure(docs.withColumns(languages), text)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = out.withColumns({"base_failed": failed, "broken_rules": verdict(rules, own)}).drop(*languages)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, lang: str = "lang") -> DataFrame:
    """The documents that pass, with the columns they came with."""
    own = docs.columns
    label = F.col(f"`{lang}`").cast("string") if lang in own else F.lit(None).cast("string")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), F.col(f"`{text}`").alias("_text"), label.alias("_lang"))
    judged = judge(row, "_text", rules, "_lang")
    # A plain filter would be pushed below the projections and repeat their work for every word; one row
    # is generated for each that is kept instead.
    kept = judged.select("_row", F.explode(F.array_repeat(F.lit(True), F.col("kept").cast("int"))).alias("_kept"))
    return kept.select("_row.*")

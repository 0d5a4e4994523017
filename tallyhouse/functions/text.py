"""Text rules that do not depend on the business: trimming, numbers, keys, ASCII folding."""

from __future__ import annotations

import unicodedata
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import rules

# Java's \s leaves out the four separator controls, even in its Unicode mode
BLANK = r"[\s\x1c-\x1f]"


@cache
def _blanks() -> str:
    return "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip(text: Column) -> Column:
    """Cut Unicode white space at both ends."""
    return F.btrim(text, F.lit(_blanks()))


def collapse_blanks(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U){BLANK}+", " ")


def is_filled(text: Column) -> Column:
    """Not null and not only white space."""
    return text.isNotNull() & (strip(text) != "")


def whole_words(words: str) -> str:
    """A pattern for ``words`` between word boundaries."""
    return rf"(?U)\b{_literal(words)}\b"


def _literal(words: str) -> str:
    """A pattern that fits just these characters; an end mark among them is quoted on its own."""
    return r"\Q" + words.replace(r"\E", r"\E\\E\Q") + r"\E"


def _literal_replacement(words: str) -> str:
    return words.replace("\\", "\\\\").replace("$", "\\$")


def replace_words(text: Column, replacements) -> Column:
    """Apply the (words, replacement) rules once each, in order.

    Most texts hold none of the words, and then every rule leaves them as they are; one search finds that out.
    """
    anywhere = r"(?U)\b(?:" + "|".join(_literal(words) for words, _ in replacements) + r")\b"
    replaced = reduce(
        lambda out, rule: F.regexp_replace(out, F.lit(whole_words(rule[0])), F.lit(_literal_replacement(rule[1]))),
        replacements,
        text,
    )
    return F.when(text.rlike(anywhere), replaced).otherwise(text)


def tax_id_root(tax_id: Column) -> Column:
    """The tax id without its check digit: everything before the first dash."""
    return F.substring_index(tax_id.cast("string"), "-", 1)


def decimal_comma(text: Column, precision: int = 18, scale: int = 2) -> Column:
    """A number written with a decimal comma or point; null where it is not a number."""
    return F.replace(text.cast("string"), F.lit(","), F.lit(".")).try_cast(f"decimal({precision},{scale})")


def clean_cell(text: Column) -> Column:
    """Strip, turn the spellings of "missing" into null, collapse white space."""
    stripped = strip(text.cast("string"))
    return F.when(~stripped.isin(*rules.MISSING_TEXT), collapse_blanks(stripped))


def canonical_digits(text: Column) -> Column:
    """Drop blanks, commas and points; a tail of five or more zeros goes too, unless nothing else is left."""
    return F.regexp_replace(F.translate(text, " ,.", ""), "(?s)^(.*[^0])0{5,}$", "$1")


def canonical_key(text: Column) -> Column:
    """A cell as it is compared when looking for a known row."""
    return canonical_digits(clean_cell(text))


@cache
def _ascii_folds() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition of the basic plane, reduced to ASCII: one-letter folds, and the longer ones."""
    single, multiple = {}, {}
    for code in range(0x80, 0x10000):
        letter = chr(code)
        folded = unicodedata.normalize("NFKD", letter).encode("ascii", "ignore").decode()
        if len(folded) == 1:
            single[letter] = folded
        elif folded:
            multiple[letter] = folded
    return "".join(single), "".join(single.values()), multiple


def ascii_fold(text: Column) -> Column:
    """Letters without accents; what has no ASCII form is dropped."""
    source, target, multiple = _ascii_folds()
    wide = r"[^\x00-\x7F]"
    translated = F.translate(text, source, target)
    table = F.create_map(*[F.lit(part) for pair in multiple.items() for part in pair])
    spelled = F.array_join(F.transform(F.split(translated, ""), lambda c: F.coalesce(table[c], c)), "")
    return (
        F.when(~text.rlike(wide), text)
        .when(~translated.rlike(wide), translated)
        .otherwise(F.regexp_replace(spelled, wide, ""))
    )


def reference_key(reference: Column) -> Column:
    """A product reference reduced to lower-case ASCII without blanks and dashes; null becomes empty text."""
    lowered = F.lower(strip(reference.cast("string")))
    return F.coalesce(ascii_fold(F.translate(lowered, " -", "")), F.lit(""))

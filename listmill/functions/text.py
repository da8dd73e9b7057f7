"""Text cleaning as column expressions; they run unchanged on batch and streaming frames."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill import fixed

# White space of every script, as members of a character class.
SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
SPECIAL = rf"[^\p{{L}}\p{{N}}\p{{Punct}}{SPACE}]"
EMOJI = (
    r"[\x{1F1E6}-\x{1F1FF}\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B50}\x{2B55}]"
    r"[\x{FE0F}\x{200D}\x{1F3FB}-\x{1F3FF}]*"
)
# All ASCII marks but the backslash; the full stop has a rule of its own.
_MARKS = r"""!"#$%&'()*+,\-/:;<=>?@\[\]^_`{|}~"""


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Trim white space of every kind on both ends."""
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def squeeze(text: Column) -> Column:
    """Turn each run of white space into one blank and trim."""
    return F.trim(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def _filled(text: Column, value: Column) -> Column:
    return F.when(text.isNotNull() & (text != ""), value)


def is_special(char: Column) -> Column:
    """Neither letter, digit, white space nor ASCII punctuation."""
    return char.rlike(SPECIAL)


def strip_special(text: Column) -> Column:
    """Drop every special character; empty text becomes null.

    A character that occurs in the corpus and is special is in the corpus' special set by definition, so removing the
    class gives what removing the collected set gives, without the pass that collects it.
    """
    return _filled(text, F.regexp_replace(text, SPECIAL, ""))


def strip_chars(text: Column, chars: str) -> Column:
    """Drop a given set of characters; empty text becomes null."""
    return _filled(text, F.translate(text, chars, ""))


def collapse_punctuation(text: Column) -> Column:
    """Shrink runs of one mark (full stops from three on) and pull blanks in front of a mark away.

    One mark's rule never touches another mark, so all marks share one pattern with a back reference.
    """
    out = F.regexp_replace(text, rf"([{_MARKS}])\1+", "$1")
    out = F.regexp_replace(out, r"\.{3,}", ".")
    out = F.regexp_replace(out, rf"[{SPACE}]([{_MARKS}])(?:[{SPACE}]\1)*", "$1")
    out = F.regexp_replace(out, rf"(?:[{SPACE}]\.){{3,}}", ".")
    return _filled(text, out)


def _capitalise(text: Column) -> Column:
    return let(text, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1_000_000_000))))


def lookup(value: Column, table: dict, default: Column | None = None) -> Column:
    """Look ``value`` up in a fixed table; unknown values give ``default``, or null."""
    pairs = F.create_map(*[F.lit(x) for item in table.items() for x in item])
    found = F.when(value.isNotNull(), pairs[value])
    return found if default is None else F.coalesce(found, default)


def category_label(label: Column, table: dict | None = None) -> Column:
    """Strip the listing prefixes, capitalise, then map known spellings to the served label."""
    out = label
    for prefix in fixed.LABEL_PREFIXES:
        out = _capitalise(strip(F.replace(out, F.lit(prefix), F.lit(""))))
    known = fixed.LABEL_MAP_BATCH if table is None else table
    return _filled(label, let(out, lambda name: lookup(name, known, name)))


def simple_clean(text: Column) -> Column:
    """Keep word characters, white space and ``. , ? ! % / -``; squeeze blanks; null gives an empty text."""
    kept = F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}_{SPACE}.,?!%/\-]", "")
    return F.coalesce(squeeze(kept), F.lit(""))


def trimmed_label(label: Column, default: str = fixed.LABEL_DEFAULT) -> Column:
    return F.coalesce(strip(label), F.lit(default))


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode composition; Spark has no built-in for it."""
    return text.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


def normalise_text(text: Column) -> Column:
    """Drop emoji and compose Unicode."""
    return nfc(F.regexp_replace(text, EMOJI, ""))


def strip_place_prefix(name: Column) -> Column:
    """Drop administrative prefixes such as those of districts and wards."""
    words = "|".join(dict.fromkeys(fixed.PLACE_PREFIXES))
    return strip(F.regexp_replace(name, f"({words})", ""))


def clean_phones(phones: Column) -> Column:
    return F.transform(phones, lambda p: F.replace(F.replace(p, F.lit("tel:"), F.lit("")), F.lit("."), F.lit("")))


def label_value(line: Column) -> Column:
    """Split ``label: value`` into a struct; null unless the line has exactly one colon."""

    def pair(parts: Column) -> Column:
        label, value = (squeeze(F.get(parts, F.lit(i))) for i in (0, 1))
        return F.when(F.size(parts) == 2, F.struct(label.alias("label"), value.alias("value")))

    return let(F.split(line, ":"), pair)


def contains_any_case(text: Column, part: Column) -> Column:
    return F.contains(F.lower(text), F.lower(part))


def truncate(text: Column, length: int = fixed.TRUNCATE_AT, mark: str = fixed.TRUNCATE_MARK) -> Column:
    short = F.concat(F.substring(text, 1, length), F.lit(mark))
    return F.when(F.length(text) > length, short).otherwise(text)


def clean_markdown(text: Column) -> Column:
    """Drop bold markers and turn star bullets into dashes."""
    return F.regexp_replace(F.replace(text, F.lit("**"), F.lit("")), r"(^|\n)\s*\*\s+", "$1- ")


def strip_quotes(text: Column) -> Column:
    return F.translate(text, "\"'", "")


def is_email(text: Column) -> Column:
    return text.rlike(fixed.EMAIL_PATTERN)


def search_text(*parts: Column) -> Column:
    """Join the given texts with blanks, nulls left out."""
    return F.concat_ws(" ", *parts)


def breadcrumb_address(parts: Column) -> Column:
    """Address from a breadcrumb: first entry dropped, the rest trimmed, reversed and joined."""
    rest = F.reverse(F.slice(parts, 2, 1_000_000_000))
    return F.array_join(F.transform(rest, strip), ", ")


def joined_lines(lines: Column) -> Column:
    return F.array_join(F.transform(lines, strip), "\n")


def tokens(text: Column) -> Column:
    """Lower-cased words of a text, empty ones left out."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


# ---------------------------------------------------------------- tone marks

# Vowels without tone, plain and with a mark of their own, and the combining tone marks.
_PLAIN_VOWELS, _MARKED_VOWELS, _TONES = "aeiouy", "ăâêôơư", "\u0300\u0301\u0303\u0309\u0323"
_PLAIN, _MARKED = _PLAIN_VOWELS + _PLAIN_VOWELS.upper(), _MARKED_VOWELS + _MARKED_VOWELS.upper()
# While a text is worked on, tones and gliding vowels are characters of the private use area.
_TONE, _GLIDES = "\ue000-\ue004", {"u": "\ue010", "U": "\ue011", "i": "\ue012", "I": "\ue013"}

# What is looked up in a table, which is a walk along it: what no table holds goes in runs.
_UNITS, _TONED_UNITS = r"(?s)[\x00-\x7F]+|.", f"(?s)[^{_TONE}]+(?![{_TONE}])|.[{_TONE}]?"


def _toned() -> dict[str, str]:
    """Every vowel with a tone, and the vowel and the stand-in for the tone."""
    return {
        unicodedata.normalize("NFC", v + t): v + chr(0xE000 + n) for v in _PLAIN + _MARKED for n, t in enumerate(_TONES)
    }


def _mapped(text: Column, unit: str, table: dict[str, str]) -> Column:
    """Each unit of a text by a table, others as they are."""
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    units = F.regexp_extract_all(text, F.lit(unit), F.lit(0))
    return F.array_join(F.transform(units, lambda u: F.coalesce(known[u], u)), "")


def tone_marks(text: Column, new_spelling: bool = False) -> Column:
    """Vietnamese syllables with their tone mark on the right vowel; the text should be composed (NFC).

    The mark is taken off its vowel, moved behind the vowels, and put back: on the last vowel that has a mark of its own, else on
    the middle of three vowels, else on the second of two before a consonant and on the first of two at the end. In the new
    spelling an ending oa, oe or uy has it on the second. The u of qu and the i of gi before a vowel are no vowels.

    Only whole runs of letters that are consonants, vowels and consonants with one tone are touched. A text without tones
    is handed back as it is.
    """
    vowel, consonant = f"[{_PLAIN}{_MARKED}]", rf"[\p{{L}}&&[^{_PLAIN}{_MARKED}]]"
    letter = rf"[\p{{L}}{_TONE}]"
    out = _mapped(text, _UNITS, _toned())
    out = F.regexp_replace(out, f"(?<!{letter})({consonant}*)({vowel}*)([{_TONE}])({vowel}*)({consonant}*)(?!{letter})", "$1$2$4$3$5")
    for glide, stand_in in _GLIDES.items():
        before = "[qQ]" if glide in "uU" else "[gG]"
        out = F.regexp_replace(out, f"(?<={before}){glide}(?={vowel})", stand_in)
    out = F.regexp_replace(out, f"([{_MARKED}])([{_PLAIN}]+)([{_TONE}])", "$1$3$2")
    out = F.regexp_replace(out, f"([{_PLAIN}]{{2}})([{_PLAIN}])([{_TONE}])", "$1$3$2")
    kept = "(?!(?i:oa|oe|uy))" if new_spelling else ""
    out = F.regexp_replace(out, rf"(?<!{vowel}){kept}([{_PLAIN}])([{_PLAIN}])([{_TONE}])(?!\p{{L}})", "$1$3$2")
    for glide, stand_in in _GLIDES.items():
        out = F.replace(out, F.lit(stand_in), F.lit(glide))
    back = _mapped(out, _TONED_UNITS, {v: k for k, v in _toned().items()})
    return F.when(text.rlike("[" + "".join(_toned()) + "]"), back).otherwise(text)

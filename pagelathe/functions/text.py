"""Column expressions over text: strip, clean, trim, noise tests, codes."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# White space and digits as Python's str methods see them.  Spark's own trim
# and \s know fewer characters, so both sets are derived from the rule instead.
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# The same set inside a regex class under (?U).  A class with one entry per
# character is an order of magnitude slower in Java.
SPACE_CLASS = r"\s\x1c-\x1f"
_DIGITS = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Nd" and not c.isascii()]
_FOREIGN_DIGITS = "".join(_DIGITS)
_ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)

WORD_CLASS = r"[\p{L}\p{N}_]"
WORD_START = rf"(?<!{WORD_CLASS})"
WORD_END = rf"(?!{WORD_CLASS})"

HYPHEN_BREAK = rf"-\n(?={WORD_CLASS})"
# What counts as a page number, blank run, gap and dot leader.
PAGE_NUMBER_LINE = rf"(?mdU)^[{SPACE_CLASS}]*\p{{Nd}}{{1,4}}[{SPACE_CLASS}]*$"
BLANK_RUN = r"\n{3,}"
GAP_RUN = r"[ \t]+"
SPACE_RUN = rf"(?U)[{SPACE_CLASS}]+"
DOT_LEADER = rf"(?U)\.{{3,}}[{SPACE_CLASS}]*\p{{Nd}}+"
TEXT_CHARS = rf"(?U)[\p{{L}}\p{{N}}{SPACE_CLASS}]+"

# The headings that end a Turkish text book, open its table of
# contents and start its first chapter.
END_HEADINGS = (
    "KAYNAKLAR",
    "KAYNAKÇA",
    "BİBLİYOGRAFYA",
    "REFERANSLAR",
    "DİZİN",
    "İNDEKS",
    "SÖZLÜK",
    "EKLE",
    "EKLER",
)
CONTENTS_HEADINGS = ("İÇİNDEKİLER",)
OPENING_HEADINGS = ("GİRİŞ",)
CHAPTER_ORDINALS = ("1", "BİRİNCİ", "İLK")
CHAPTER_WORDS = ("ÜNİTE", "BÖLÜM")

# Languages with a two-letter code of their own.
LANGUAGE_CODES = {"english": "en", "turkish": "tr"}

PASSAGE_PREFIX = "passage: "
QUERY_PREFIX = "query: "


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Remove white space of any script from both ends."""
    return F.btrim(col(c), F.lit(SPACES))


def strip_or_empty(c: ColumnOrName) -> Column:
    return strip(F.coalesce(col(c), F.lit("")))


def ascii_digits(c: ColumnOrName) -> Column:
    """Decimal digits of every script as 0-9."""
    return F.translate(col(c), _FOREIGN_DIGITS, _ASCII_DIGITS)


# The steps of cleaning in order: pattern, replacement, and substrings without
# which the pattern changes nothing (none: always try).
CLEANING = (
    ("\r", "", ("\r",)),
    (HYPHEN_BREAK, "", ("-\n",)),
    (PAGE_NUMBER_LINE, "", ()),
    (BLANK_RUN, "\n\n", ("\n\n\n",)),
    (GAP_RUN, " ", ("  ", "\t")),
)


def clean_text(c: ColumnOrName) -> Column:
    """Undo line-break hyphens, drop page-number lines, squeeze blanks."""
    text = col(c)
    for pattern, replacement, _ in CLEANING:
        text = F.regexp_replace(text, pattern, replacement)
    return strip(text)


def _any_of(words) -> str:
    return "(?:" + "|".join(words) + ")"


def word_pattern(words) -> str:
    """Any of the words, whole and in any case."""
    return rf"{WORD_START}(?iu:{_any_of(words)}){WORD_END}"


def heading_pattern(openings=OPENING_HEADINGS, ordinals=CHAPTER_ORDINALS, chapters=CHAPTER_WORDS) -> str:
    gap = f"(?U:[{SPACE_CLASS}]*)"
    forms = [
        _any_of(openings),
        rf"{_any_of(ordinals)}{gap}\.{gap}{_any_of(chapters)}",
        rf"{_any_of(chapters)}{gap}1",
    ]
    return rf"{WORD_START}(?iu:{_any_of(forms)}){WORD_END}"


def last_word_after(text: ColumnOrName, start: ColumnOrName, words=END_HEADINGS) -> Column:
    """Offset of the last of ``words`` beyond ``start``, null if there is none.

    Only the text from ``start`` on is searched.
    """
    rest = F.substr(col(text), col(start) + 1)
    return col(start) + F.length(F.regexp_substr(rest, F.lit(rf"(?s)^.+(?={word_pattern(words)})")))


def heading_after_contents(
    text: ColumnOrName, within: ColumnOrName, contents=CONTENTS_HEADINGS, heading: str | None = None
) -> tuple[Column, Column]:
    """Offsets of the first contents heading and of the first chapter after it.

    The second is 0 unless both were found and the contents heading lies in
    the first ``within`` characters; most texts are dismissed on those alone.
    """
    pattern = word_pattern(contents)
    longest = max(map(len, contents))
    opens = F.rlike(F.left(col(text), col(within) + longest + 1), F.lit(pattern))
    both = rf"(?s)^((.*?){pattern}.*?){heading or heading_pattern()}"
    found = lambda group: F.when(opens, F.length(F.regexp_extract(col(text), both, group))).otherwise(0)
    return found(2), found(1)


def noise_reason(c: ColumnOrName, min_chars: int = 150, max_ratio: float = 0.40, min_leaders: int = 2) -> Column:
    """Why a chunk is noise (short, dot_leaders, symbols), else null.

    The branches of CASE run in order, so the costly symbol count only sees
    chunks that passed the cheap tests.
    """
    c = col(c)
    # Outer white space matters to the length alone.
    n = F.length(strip(c))
    symbols = F.length(F.regexp_replace(c, TEXT_CHARS, ""))
    leaders = F.contains(c, F.lit("...")) & (F.regexp_count(c, F.lit(DOT_LEADER)) >= min_leaders)
    return (
        F.when(n < min_chars, "short")
        .when(leaders, "dot_leaders")
        .when(F.try_divide(symbols.cast("double"), n) > F.lit(float(max_ratio)), "symbols")
    )


def language_code(name: ColumnOrName) -> Column:
    lowered = F.lower(col(name))
    code = F.lower(F.substring(col(name), 1, 2))
    for known, short in LANGUAGE_CODES.items():
        code = F.when(lowered == known, short).otherwise(code)
    return code


def direction(src_lang: ColumnOrName, tgt_lang: ColumnOrName) -> Column:
    return F.concat(language_code(src_lang), F.lit("2"), language_code(tgt_lang))


def add_prefix(c: ColumnOrName, prefix: str = PASSAGE_PREFIX) -> Column:
    return F.concat(F.lit(prefix), col(c))


def remove_prefix(c: ColumnOrName, prefix: str = PASSAGE_PREFIX) -> Column:
    """Drop the prefix once, if it is there."""
    c = col(c)
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def first_letter(c: ColumnOrName, strict: bool = False) -> Column:
    """First A-E in the upper-cased text, else null.

    ``strict`` asks for a letter standing alone.
    """
    pattern = rf"{WORD_START}[ABCDE]{WORD_END}" if strict else "[ABCDE]"
    return F.regexp_substr(F.upper(col(c)), F.lit(pattern))


def truncate_words(c: ColumnOrName, max_tokens: int) -> Column:
    """Cut to a budget of white-space tokens, joined by single spaces."""
    words = F.split(strip(c), SPACE_RUN, max_tokens + 1)
    return F.array_join(F.slice(words, 1, max_tokens), " ")


def format_score(c: ColumnOrName, digits: int = 4, signed: bool = False, missing: str = "—") -> Column:
    pattern = f"%{'+' if signed else ''}.{digits}f"
    return F.when(col(c).isNotNull(), F.format_string(pattern, col(c).cast("double"))).otherwise(missing)

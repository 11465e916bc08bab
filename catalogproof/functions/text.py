"""Column functions for text: cleaning, folding, labels, ids and paths parts.

Everything is a built-in expression.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx

#: every character a Unicode-aware strip removes
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
#: a regex class equal to it (Java's Unicode \s leaves out the four separators)
SPACE = r"[\s\x1c-\x1f]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once a row and hand it to ``body``.

    An expression used inside a lambda is evaluated for every element; bound this way
    it is a variable there.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Strip Unicode whitespace at both ends (``trim`` takes only spaces)."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def squeeze(c: Column) -> Column:
    """Each run of whitespace to one space; the many that are one already, and ASCII letters, are passed over."""
    return F.regexp_replace(c, r"(?U)(?=[^!-~])(?: \s++|(?! )\s++)", " ")


def clean_text(c: Column) -> Column:
    """Drop control characters, squeeze whitespace, trim; blank becomes null."""
    no_control = F.regexp_replace(c, r"[\x00-\x1f](?<![\t\n\r])", "")
    return blank_to_null(F.trim(squeeze(no_control)))


def _ascii(ch: str) -> str:
    return unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, str]:
    """By rule, over all code points: characters with a one-letter fold, those letters, and
    ``<character><fold>`` of each that folds to more."""
    one, folded, spelled = [], [], []
    for code in range(0x80, 0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        plain = _ascii(chr(code))
        if len(plain) == 1:
            one.append(chr(code))
            folded.append(plain)
        elif plain:
            spelled.append(f"{chr(code)}\x02{plain}")
    return "".join(one), "".join(folded), "\x01".join(spelled)


def weave(s: Column, pattern: str, replacement: Callable[[Column], Column]) -> Column:
    """Put ``replacement`` in the place of every match of ``pattern`` (no groups in it)."""
    between = F.split(s, pattern)
    found = F.transform(F.regexp_extract_all(s, F.lit(f"({pattern})"), F.lit(1)), replacement)
    return F.array_join(F.zip_with(between, found, lambda t, r: F.concat(t, F.coalesce(r, F.lit("")))), "")


def fold_ascii(c: Column) -> Column:
    """Compatibility-decompose and keep ASCII, without leaving the JVM; exact for every character."""
    beyond = r"[^\x00-\x7F]"
    one, folded, spelled = _fold_tables()
    long_folds = F.str_to_map(F.lit(spelled), F.lit("\x01"), F.lit("\x02"))

    def rest(s: Column) -> Column:
        # what has no fold is not in the map, and goes
        return F.when(s.rlike(beyond), weave(s, beyond, lambda ch: F.try_element_at(long_folds, ch))).otherwise(s)

    return F.when(c.rlike(beyond), let(F.translate(c, one, folded), rest)).otherwise(c)


def slug(c: Column, empty: str | None = None) -> Column:
    """``'Contencioso Adm. Laboral'`` -> ``'contencioso-adm-laboral'``.

    ``empty`` replaces a null or an empty slug.
    """
    s = F.btrim(F.regexp_replace(F.lower(fold_ascii(c)), "[^a-z0-9]+", "-"), F.lit("-"))
    return s if empty is None else F.coalesce(blank_to_null(s), F.lit(empty))


def category_key(c: Column) -> Column:
    """Key under which spellings of one category meet (``c`` already cleaned)."""
    return F.lower(F.rtrim(fold_ascii(c), F.lit(".")))


def _label(label: str, optional: bool) -> str:
    word = rf"(?:{label}\s*+)?+" if optional else rf"{label}\s*+"
    return rf"(?iuU)^(?:\s*+{word}[{fx.LABEL_PUNCTUATION}]++\s*+)++"


def had_label(c: Column, label: str = fx.SUMMARY_LABEL) -> Column:
    """Does the text start with its own label? (null: no)"""
    return F.coalesce(c.rlike(_label(label, optional=False)), F.lit(False))


def keeps_label(c: Column, label: str = fx.SUMMARY_LABEL) -> Column:
    """Does the text still start with the label or with stray punctuation?"""
    return F.coalesce(c.rlike(_label(label, optional=True)), F.lit(False))


def strip_label(c: Column, label: str = fx.SUMMARY_LABEL) -> Column:
    """Remove leading labels and stray punctuation; blank becomes null."""
    return blank_to_null(strip(F.regexp_replace(c, _label(label, optional=True), "")))


def extract_id(link: Column, pattern: str = fx.ID_IN_LINK) -> Column:
    return blank_to_null(F.regexp_extract(link, pattern, 1))


def link_for(record_id: Column, base: str) -> Column:
    return F.concat(F.lit(base), record_id)


def case_key(case_type: Column, case_no: Column) -> Column:
    return F.concat_ws("-", F.coalesce(case_type, F.lit("")), F.coalesce(case_no, F.lit("")))


def split_case_key(c: Column) -> tuple[Column, Column]:
    """(type, number) by splitting off at most two dashes from the right."""
    two = r"(?s)^(.*)-([^-]*-[^-]*)$"
    one = r"(?s)^([^-]*)-([^-]*)$"
    kind = (
        F.when(c.rlike(two), F.regexp_extract(c, two, 1))
        .when(c.rlike(one), F.regexp_extract(c, one, 1))
        .otherwise(c)
    )
    number = (
        F.when(c.rlike(two), F.regexp_extract(c, two, 2))
        .when(c.rlike(one), F.regexp_extract(c, one, 2))
        .when(c.isNotNull(), F.lit(""))
    )
    return kind, number


def parse_count(c: Column) -> Column:
    """``'674.530'`` or ``'674,530'`` -> 674530."""
    return F.regexp_replace(c, "[.,]", "").try_cast("bigint")


def contains_ignoring_case(c: Column, text: str) -> Column:
    return F.coalesce(F.lower(c).contains(text.lower()), F.lit(False))


def yaml_scalar(c: Column) -> Column:
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.concat(
        F.lit('"'), strip(F.translate(text, '"\n', "' ")), F.lit('"')
    )

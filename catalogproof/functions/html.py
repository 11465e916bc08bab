"""Listing pages: panels, their embedded payload and their visible labels."""

from __future__ import annotations

import html
from dataclasses import dataclass
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.functions import text as tx

#: what may be a character reference: digits, or a name, with or without its semicolon
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_NOT_A_CHARACTER = 0xFFFD


def _table(pairs: dict[str, str]) -> Column:
    listed = "\x01".join(f"{name}\x02{text}" for name, text in pairs.items())
    return F.str_to_map(F.lit(listed), F.lit("\x01"), F.lit("\x02"))


@lru_cache(maxsize=1)
def _odd_numbers() -> dict[str, str]:
    """Numbers that stand for another character or for none, by the standard library's rules."""
    ends = [plane * 0x10000 + end for plane in range(17) for end in (0xFFFE, 0xFFFF)]
    asked = [*range(0xA0), *range(0xFDD0, 0xFDF0), *ends]
    return {str(n): text for n in asked if (text := html.unescape(f"&#{n};")) != chr(n)}


def _number(digits: Column, base: int, most: int) -> Column:
    """Value of a number of any length; what is beyond all characters becomes the replacement character."""
    short = F.ltrim(digits, F.lit("0"))
    value = F.conv(F.concat(F.lit("0"), F.substring(short, 1, most)), base, 10).cast("bigint")
    surrogate = value.between(0xD800, 0xDFFF)
    return F.when((F.length(short) > most) | (value > 0x10FFFF) | surrogate, F.lit(_NOT_A_CHARACTER)).otherwise(value)


def _character(code: Column) -> Column:
    text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.coalesce(F.try_element_at(_table(_odd_numbers()), code.cast("string")), text)


def _decode(reference: Column) -> Column:
    """One reference to its text; an unknown one stays as it is."""
    body = F.substring(reference, F.lit(2), F.length(reference))
    hexadecimal = F.regexp_extract(body, "^#[xX]([0-9A-Fa-f]+)", 1)
    decimal = F.regexp_extract(body, "^#([0-9]+)", 1)
    # names that count without a semicolon also count as the beginning of a longer one
    open_names = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    begins = F.regexp_extract(body, f"^({'|'.join(open_names)})", 1)
    names = _table(html5)
    return (
        F.when(hexadecimal != "", _character(_number(hexadecimal, 16, 6)))
        .when(decimal != "", _character(_number(decimal, 10, 7)))
        .otherwise(
            F.coalesce(
                F.try_element_at(names, body),
                F.when(
                    begins != "",
                    F.concat(F.try_element_at(names, begins), F.substring(body, F.length(begins) + 1, F.length(body))),
                ),
                reference,
            )
        )
    )


def unescape(c: Column) -> Column:
    """Character references to characters, by the rules of HTML 5, each decoded once; never fails."""
    # marks that cannot become part of another reference go first, by plain search
    common = c
    for entity, mark in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'")):
        common = F.replace(common, F.lit(entity), F.lit(mark))

    def rest(s: Column) -> Column:
        return F.when(s.contains("&"), tx.weave(s, _REFERENCE, _decode)).otherwise(s)

    return F.when(c.contains("&"), tx.let(common, rest)).otherwise(c)


def finish_unescape(c: Column) -> Column:
    r"""Undo the ``\uXXXX`` and ``\/`` that survive the first JSON decoding."""
    lone = F.regexp_replace(c, r"\\(?!u[0-9a-fA-F]{4}|/)", r"\\\\")
    quoted = F.replace(lone, F.lit('"'), F.lit('\\"'))
    for raw, escaped in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        quoted = F.replace(quoted, F.lit(raw), F.lit(escaped))
    decoded = F.from_json(F.concat(F.lit('{"v":"'), quoted, F.lit('"}')), "v string")["v"]
    return F.when(c.rlike(r"\\u[0-9a-fA-F]{4}|\\/"), F.coalesce(decoded, c)).otherwise(c)


def payload(onclick: Column) -> Column:
    """The ``"parameters"`` object inside an ``onclick``, as a map; null when broken.

    The JSON reader stops at the brace that closes the object, so the script that
    follows it needs no separate cut.  A quote left open in the source breaks the
    object, and then the visible labels have to serve.
    """
    script = F.replace(unescape(onclick), F.lit('\\"'), F.lit('"'))
    tail = F.regexp_extract(script, r'(?s)"parameters":[^{]*(\{.*)$', 1)
    parsed = F.from_json(tx.blank_to_null(tail), "map<string,string>")
    return F.transform_values(parsed, lambda _, v: finish_unescape(v))


def inner_text(c: Column, between: str = " ") -> Column:
    """Visible text of a fragment: tags out (``between`` in their place), references decoded, spacing squeezed."""
    return tx.strip(F.regexp_replace(unescape(F.regexp_replace(c, "<[^>]*+>", between)), r"(?U)\s+", " "))


def label_key(c: Column) -> Column:
    """Visible label -> lookup key: folded, trimmed, without its colon, lower case."""
    return F.lower(tx.strip(F.rtrim(tx.strip(tx.fold_ascii(c)), F.lit(":"))))


#: a comment, a tag (a quote counts behind an equals sign only, where a value begins), text, or a lone bracket
_MARKUP = (
    r"(?s:<!--.*?(?:-->|$))|<[A-Za-z/](?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+>|[^<]++|<"
)
_LABEL_CLASS = r"""(?i)^<div\b[^>]*\bclass\s*=\s*(?:"[^"]*\btxtbold\b[^"]*"|'[^']*\btxtbold\b[^']*'|txtbold\b)"""


def markup(c: Column) -> Column:
    """A fragment in tokens, nothing left out: comments, tags, and the text between."""
    return F.regexp_extract_all(c, F.lit(_MARKUP), F.lit(0))


def tag_names(tokens: Column) -> Column:
    """``div`` for an opening tag, ``/div`` for a closing one, empty for what is no tag."""
    return F.transform(tokens, lambda t: F.lower(F.regexp_extract(t, "^<(/?[A-Za-z][A-Za-z0-9]*)", 1)))


def _depths(names: Column, name: Column) -> Column:
    """How many elements ``name`` are open behind each token."""

    def step(open_: Column, n: Column) -> Column:
        change = F.when(n == name, 1).when(n == F.concat(F.lit("/"), name), -1).otherwise(0)
        return F.array_append(open_, F.coalesce(F.get(open_, F.size(open_) - 1), F.lit(0)) + change)

    return F.aggregate(names, F.expr("cast(array() AS array<int>)"), step)


def own_element(c: Column) -> Column:
    """The element that a fragment begins with, to its own closing tag; all of it if that is missing."""
    def cut(read: Column) -> Column:
        tokens, name = read["tokens"], read["name"]
        state = F.struct(F.lit(0).alias("open"), F.lit(0).alias("n"), F.lit(0).alias("until"))

        def step(at: Column, n: Column) -> Column:
            still = at["open"] + F.when(n == name, 1).when(n == F.concat(F.lit("/"), name), -1).otherwise(0)
            ends = (at["until"] == 0) & (still == 0)
            return F.struct(
                still.alias("open"), (at["n"] + 1).alias("n"), F.when(ends, at["n"] + 1).otherwise(at["until"]).alias("until")
            )

        until = F.aggregate(tag_names(tokens), state, step, lambda at: at["until"])
        return F.when(name == "", c).otherwise(
            tx.let(until, lambda u: F.when(u > 0, F.array_join(F.slice(tokens, F.lit(1), u), "")).otherwise(c))
        )

    # the name is bound like the tokens: read anew at every token, a page would cost its length for each
    name = F.lower(F.regexp_extract(c, "^<([A-Za-z][A-Za-z0-9]*)", 1))
    return tx.let(F.struct(markup(c).alias("tokens"), name.alias("name")), cut)


def label_fields(panel: Column) -> Column:
    """Map of column name -> value from the label ``div``s of a panel and the ``div`` that follows each as its sibling.

    Both reach to their own closing tags, whatever ``div``s they hold.
    """
    known = F.create_map(*[F.lit(x) for kv in fx.PANEL_LABELS.items() for x in kv])

    def pairs(read: Column) -> Column:
        tokens, names, depth, places = (read[c] for c in ("tokens", "names", "depth", "places"))

        def closing(i: Column) -> Column:
            """Place of the tag that closes the ``div`` opened at i; beyond the end if there is none."""
            behind = F.filter(places, lambda j: (j > i) & (F.get(depth, j) < F.get(depth, i)))
            return F.coalesce(F.get(behind, F.lit(0)), F.size(tokens))

        def inside(i: Column, end: Column) -> Column:
            return F.array_join(F.slice(tokens, i + 2, end - i - 1), "")

        def sibling(end: Column) -> Column:
            """The next ``div``, unless the parent is closed before it."""
            behind = F.filter(places, lambda j: (j > end) & F.get(names, j).isin("div", "/div"))
            after = F.get(behind, F.lit(0))

            def content(i: Column) -> Column:
                return F.when(F.get(names, i) == "div", tx.let(closing(i), lambda close: inside(i, close))).otherwise(F.lit(""))

            return tx.let(after, content)

        def pair(i: Column) -> Column:
            return tx.let(closing(i), lambda end: F.struct(inside(i, end).alias("name"), sibling(end).alias("value")))

        labels = F.filter(places, lambda i: F.get(tokens, i).rlike(_LABEL_CLASS))
        return F.transform(labels, pair)

    def read(tokens: Column) -> Column:
        return tx.let(
            tag_names(tokens),
            lambda names: F.struct(
                tokens.alias("tokens"),
                names.alias("names"),
                _depths(names, F.lit("div")).alias("depth"),
                F.sequence(F.lit(0), F.size(tokens) - 1).alias("places"),
            ),
        )

    def named(p: Column) -> Column:
        return F.struct(F.try_element_at(known, label_key(inner_text(p["name"]))).alias("field"), inner_text(p["value"]).alias("value"))

    def to_map(found: Column, names: Column) -> Column:
        # a repeated label: the last one stands
        last = F.transform(names, lambda n: F.element_at(F.filter(found, lambda f: f["field"] == n), -1)["value"])
        return F.map_from_arrays(names, last)

    fields = F.transform(tx.let(tx.let(markup(panel), read), pairs), named)
    return tx.let(
        F.filter(fields, lambda f: f["field"].isNotNull()),
        lambda found: tx.let(
            F.array_distinct(F.transform(found, lambda f: f["field"])), lambda names: to_map(found, names)
        ),
    )


def panel_header(panel: Column) -> Column:
    """Texts of the ``span``s in the panel's header (type and number come first)."""
    header = F.regexp_extract(panel, r'(?s)<div[^>]*class="[^"]*\brf-p-hdr\b[^"]*"[^>]*>(.*?)</div>', 1)
    return F.transform(
        F.regexp_extract_all(header, F.lit(r"(?s)<span[^>]*>(.*?)</span>"), F.lit(1)), lambda s: inner_text(s, "")
    )


def listing_totals(page: Column) -> tuple[Column, Column]:
    """(catalogue total, result total) announced on a page; null when it says none."""
    plain = F.regexp_replace(page, "<[^>]+>", "")
    return tuple(
        tx.parse_count(tx.blank_to_null(F.regexp_extract(plain, fx.LISTING_TOTALS, group)))
        for group in (1, 2)
    )


def announced_pages(total: Column, page_size: int = fx.PAGE_SIZE) -> Column:
    """Pages the total makes; an unknown total stays unknown, never zero."""
    return F.ceil(total / page_size).cast("bigint")


@dataclass(frozen=True)
class PanelLayout:
    """Where a page keeps its items.  ``start`` matches the opening of each item."""

    start: str = rf"""(?=<div[^>]*\bid=["']{fx.PANEL_ID}["'])"""
    link: str = rf"""<a[^>]*href=["']([^"']*{fx.ID_IN_DOWNLOAD_LINK}[^"']*)["']"""
    link_id: str = fx.ID_IN_DOWNLOAD_LINK
    onclick: str = r"""<a[^>]*onclick=(?:"(?=[^"]*\buuid\b)|'(?=[^']*\buuid\b))((?<=")[^"]*|(?<=')[^']*)"""
    counter: str = fx.PANEL_COUNT


def panels(page: Column, layout: PanelLayout) -> Column:
    """Array of the elements that begin at each item, each to its own closing tag; what stands around them is dropped."""
    parts = F.split(page, layout.start)
    return F.transform(F.filter(parts, lambda p: p.rlike(f"^{layout.start}")), own_element)


def panels_shown(page: Column, layout: PanelLayout) -> Column:
    """Items a page displays, counted without parsing it."""
    return F.regexp_count(page, F.lit(layout.counter))

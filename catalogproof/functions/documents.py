"""Document text: noise removal, sections and markdown, row by row without a shuffle.

A document is one row, so its lines are handled with higher-order functions inside
that row; nothing is exploded, grouped or sorted across rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.functions import text as tx

_LINE_ENDS = r"[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
# the stamp marks, behind a look at their possible first letters
_STAMP = rf"(?iU)(?=[sfvdr])(?:{fx.STAMP})"


def lines(text: Column) -> Column:
    """Lines of a text, at every line end Unicode knows; a final one opens no extra line."""
    plain = F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), _LINE_ENDS, "\n")

    def cut(t: Column) -> Column:
        closed = F.when(F.endswith(t, F.lit("\n")), F.left(t, F.length(t) - 1)).otherwise(t)
        return F.split(closed, "\n")

    return tx.let(plain, cut)


def page_count(text: Column, ignore_trailing_break: bool = False) -> Column:
    """Pages by form feeds.  A text that ends in one counts an extra page unless told not to."""
    counted = F.rtrim(text, F.lit("\f")) if ignore_trailing_break else text
    return F.regexp_count(counted, F.lit("\\f")) + 1


def strip_boilerplate(text: Column) -> Column:
    """Drop stamp blocks, letterhead lines and surplus spacing."""
    blocks = F.split(text, rf"(?U)\n{tx.SPACE}*\n")
    body = F.filter(blocks, lambda b: ~b.rlike(_STAMP))
    body = F.transform(
        body,
        lambda b: tx.strip(
            F.array_join(F.filter(lines(b), lambda line: ~line.rlike(rf"(?iU){fx.LETTERHEAD}")), "\n")
        ),
    )
    joined = F.array_join(F.filter(body, lambda b: b != ""), "\n\n")
    return tx.strip(F.regexp_replace(F.replace(joined, F.lit("\f"), F.lit("\n")), r"\n{3,}", "\n\n"))


def reject_reason(text: Column, cleaned: Column) -> Column:
    """Why a document gives no markdown; null when it does."""
    return F.when(tx.is_blank(text), F.lit(fx.REASON_NO_TEXT)).when(
        F.length(cleaned) < fx.MIN_TEXT_CHARS, F.lit(fx.REASON_SCANNED)
    )


def _header_pattern(p: str) -> str:
    return rf"(?iU)^\s*(?:{p})\s*[:.\-]?\s*$"


def _opener_pattern(p: str) -> str:
    return rf"(?iU)^\s*(?:{p})"


def _ladder(line: Column, rules, pattern) -> Column:
    return reduce(
        lambda acc, rule: acc.when(line.rlike(pattern(rule[0])), F.lit(rule[1])),
        rules[1:],
        F.when(line.rlike(pattern(rules[0][0])), F.lit(rules[0][1])),
    )


def _any(rules) -> str:
    return "|".join(p for p, _ in rules)


def _marked(text: Column) -> Column:
    """Each line with the section it opens as a header, or may open as an opener."""

    def mark(line: Column) -> Column:
        header = F.when(
            line.rlike(_header_pattern(_any(fx.SECTION_HEADERS))),
            _ladder(line, fx.SECTION_HEADERS, _header_pattern),
        )
        opener = F.when(
            line.rlike(_opener_pattern(_any(fx.SECTION_OPENERS))),
            _ladder(line, fx.SECTION_OPENERS, _opener_pattern),
        )
        return F.struct(
            line.alias("line"),
            header.alias("header"),
            F.when(header.isNull(), opener).alias("opener"),
        )

    return F.transform(lines(text), mark)


def _name(m: Column) -> Column:
    return F.coalesce(m["header"], m["opener"])


def _settled(marked: Column, names: Column) -> Column:
    """Settle the openers: one opens its section only where no earlier line named it."""

    def settle(m: Column, i: Column) -> Column:
        opens = m["opener"].isNotNull() & (F.array_position(names, m["opener"]) == i + 1)
        return F.struct(
            m["line"].alias("line"),
            m["header"].alias("header"),
            F.when(opens, m["opener"]).alias("opener"),
        )

    return F.transform(marked, settle)


def section_marks(text: Column) -> Column:
    """Array of (line, header, opener): what each line opens, if anything.

    Keep it in a column of its own and feed the functions below from it.
    """
    return tx.let(
        _marked(text),
        lambda marked: tx.let(F.transform(marked, _name), lambda names: _settled(marked, names)),
    )


def sectioned_body(marks: Column, keep_header_text: bool = False) -> Column:
    """Text with its section openings written as markdown headings.

    A header line is replaced by its heading, with whatever followed on it;
    ``keep_header_text`` keeps the line under the heading.
    """

    def render(m: Column) -> Column:
        heading = F.concat(F.lit("\n## "), _name(m), F.lit("\n"))
        header = F.concat(heading, F.lit("\n"), m["line"]) if keep_header_text else heading
        return (
            F.when(m["header"].isNotNull(), header)
            .when(
                m["opener"].isNotNull(),
                F.concat(heading, F.lit("\n"), F.ltrim(m["line"], F.lit(tx.WHITESPACE))),
            )
            .otherwise(m["line"])
        )

    return F.array_join(F.transform(marks, render), "\n")


def section_names(marks: Column) -> Column:
    """Names in order of appearance, repeats included."""
    return F.filter(F.transform(marks, _name), lambda n: n.isNotNull())


def section_parts(marks: Column) -> Column:
    """Array of (section_no, section, body); number 0 is what precedes the first section."""
    starts = F.filter(
        F.transform(marks, lambda m, i: F.when(_name(m).isNotNull(), i)), lambda i: i.isNotNull()
    )
    bounds = F.concat(F.array(F.lit(0)), starts, F.array(F.size(marks)))

    def body(piece: Column) -> Column:
        kept = F.filter(piece, lambda m: m["header"].isNull())
        text = F.transform(
            kept,
            lambda m: F.when(m["opener"].isNotNull(), F.ltrim(m["line"], F.lit(tx.WHITESPACE))).otherwise(m["line"]),
        )
        return F.array_join(text, "\n")

    def part(start: Column, k: Column, bounds: Column) -> Column:
        end = F.get(bounds, k + 1)
        return F.struct(
            k.alias("section_no"),
            F.when(k > 0, _name(F.get(marks, start))).alias("section"),
            body(F.slice(marks, start + 1, end - start)).alias("body"),
        )

    return tx.let(
        bounds,
        lambda b: F.transform(F.slice(b, F.lit(1), F.size(b) - 1), lambda start, k: part(start, k, b)),
    )


def front_matter(values: dict[str, Column]) -> Column:
    """YAML block; ``values`` holds a column for each name in the fixed key list."""
    rows = [
        F.concat(F.lit(f"{key}: "), tx.yaml_scalar(values[name]))
        for key, name in fx.FRONT_MATTER.items()
    ]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *rows), F.lit("\n---\n"))


def markdown(head: Column, case_type: Column, case_no: Column, summary: Column, body: Column) -> Column:
    title = F.concat(
        F.lit("# "), F.coalesce(case_type, F.lit("")), F.lit(" "), F.coalesce(case_no, F.lit(""))
    )
    quote = F.when(tx.is_blank(summary), F.lit("")).otherwise(
        F.concat(F.lit("\n> **Sumilla.** "), tx.strip(summary), F.lit("\n"))
    )
    return F.concat(head, F.lit("\n"), title, F.lit("\n"), quote, F.lit("\n"), tx.strip(body), F.lit("\n"))

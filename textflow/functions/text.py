"""Column -> Column text functions (all JVM-side, no Python UDFs).

Each function only builds a Catalyst expression, so a chain of them is one
projection inside whole-stage codegen and runs the same on a batch or a
streaming DataFrame.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from textflow.functions.constants import CONTRACTIONS, TOKEN_SPLITS

# Java regex: \s is ASCII-only there, so add the ideographic space (U+3000,
# used by the HTML step as a separator) and every Unicode space separator.
WHITESPACE_RUN = "[\\s\\u3000\\p{Z}]+"
# script and style bodies, comments, declarations and tags (quoted attribute
# values may hold ">"); "5 < 6" is text
MARKUP = (r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
          r"|<!--.*?-->|<![a-z][^>]*>"
          r"|</?[a-z][^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*>")
ENTITY = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
#: the named character references; a no-break space counts as a space
ENTITY_NAMES = {n: " " if n == "nbsp" else chr(c)
                for n, c in sorted(name2codepoint.items())}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_non_alpha(c: Column | str) -> Column:
    """Every character outside ``[a-zA-Z]`` becomes one space."""
    return F.regexp_replace(_c(c), "[^a-zA-Z]", " ")


def collapse_ws(c: Column | str) -> Column:
    """T4: ``" ".join(s.split())`` -- runs of any whitespace to one space."""
    return F.trim(F.regexp_replace(_c(c), WHITESPACE_RUN, " "))


def lower_trim(c: Column | str) -> Column:
    """T3."""
    return F.trim(F.lower(_c(c)))


def _entity_text(e: Column) -> Column:
    """What one reference ``&...;`` stands for; unknown names stay."""
    body = F.substr(e, F.lit(2), F.length(e) - 2)
    is_hex = F.lower(body).startswith("#x")
    code = F.when(is_hex, F.conv(F.substr(body, F.lit(3)), 16, 10)).otherwise(
        F.substr(body, F.lit(2))).try_cast("long")
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    char = F.when(code == 160, " ").when(valid, F.decode(F.unhex(
        F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")
    names = F.map_from_arrays(
        F.array(*[F.lit(n) for n in ENTITY_NAMES]),
        F.array(*[F.lit(t) for t in ENTITY_NAMES.values()]))
    return F.when(body.startswith("#"), char).otherwise(
        F.coalesce(F.element_at(names, body), e))


def decode_entities(c: Column | str) -> Column:
    """Numeric and named character references; those that stand for ``&``
    come last, so that ``&amp;lt;`` becomes ``&lt;``."""
    c = _c(c)
    pairs = F.transform(
        F.array_distinct(F.regexp_extract_all(c, F.lit(ENTITY), F.lit(0))),
        lambda e: F.struct(e.alias("e"), _entity_text(e).alias("t")))
    amp = F.filter(pairs, lambda p: p["t"] == "&")
    rest = F.filter(pairs, lambda p: p["t"] != "&")
    done = F.aggregate(F.concat(rest, amp), c,
                       lambda s, p: F.replace(s, p["e"], p["t"]))
    return F.when(F.contains(c, F.lit("&")), done).otherwise(c)


def html_to_text(c: Column | str) -> Column:
    """Text nodes of an HTML fragment.

    Script and style bodies, comments and tags become a space, character
    references are decoded and whitespace is collapsed.  Values without any
    markup pass through unchanged, as in the reference, which only parses
    when a tag is found.
    """
    c = _c(c)
    s = decode_entities(F.regexp_replace(c, MARKUP, " "))
    s = F.trim(F.regexp_replace(s, "[ \\t\\r\\n]+", " "))
    return F.when(c.rlike(MARKUP), s).otherwise(c)


def clean_text(c: Column | str) -> Column:
    """T5 as one projection: HTML -> non-alpha -> lower + trim -> collapse."""
    return collapse_ws(lower_trim(strip_non_alpha(html_to_text(c))))


def expand_contractions(c: Column | str) -> Column:
    """Whole-word, case-insensitive rewrite by the contraction table.

    The table is fixed and small, so the rewrite is a projection: no join,
    no shuffle, and texts without an apostrophe skip it.
    """
    c = _c(c)
    pattern = "(?i)\\b(?:" + "|".join(w for w, _ in CONTRACTIONS) + ")\\b"
    full = F.create_map(*[F.lit(x) for pair in CONTRACTIONS for x in pair])
    found = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)),
                        lambda w: F.element_at(full, F.lower(w)))
    s = F.array_join(F.zip_with(
        F.split(c, pattern, -1), F.concat(found, F.array(F.lit(""))),
        lambda gap, word: F.concat(gap, word)), "")
    return F.when(F.instr(c, "'") > 0, s).otherwise(c)


def cap_code(c: Column | str) -> Column:
    """2 = all cased characters upper, 1 = first character upper, 0."""
    c = _c(c)
    first = F.substring(c, 1, 1)
    all_upper = (F.upper(c) == c) & (F.lower(c) != c)
    first_upper = (F.upper(first) == first) & (F.lower(first) != first)
    return (F.when(all_upper, 2).when(first_upper, 1).otherwise(0)
            .cast("int"))


def rating_class(c: Column | str, numeric: bool = False) -> Column:
    """1,2 -> Class 1; 3 -> Class 2; 4,5 -> Class 3 (or 0/1/2)."""
    r = _c(c).try_cast("int")
    if numeric:
        return (F.when(r <= 2, 0).when(r == 3, 1).when(r >= 4, 2)
                .cast("int"))
    return (F.when(r <= 2, "Class 1").when(r == 3, "Class 2")
            .when(r >= 4, "Class 3"))


def split_words(c: Column | str) -> Column:
    """Words of a cleaned ``[a-z ]`` text, with the fixed split table
    applied ("cannot" -> "can", "not")."""
    c = _c(c)
    s = c
    for word, parts in TOKEN_SPLITS:
        s = F.regexp_replace(s, rf"\b{word}\b", parts)
    any_word = r"\b(" + "|".join(w for w, _ in TOKEN_SPLITS) + r")\b"
    return word_array(F.when(c.rlike(any_word), s).otherwise(c))


def word_array(c: Column | str, min_len: int = 1) -> Column:
    """Split a cleaned ``[a-z ]`` text into words of ``min_len``+ chars.

    ``min_len=2`` is the n-gram vectorizer's token rule (F1: two or more
    word characters); everything else keeps all words.
    """
    parts = F.split(_c(c), " ")
    return F.filter(parts, lambda x: F.length(x) >= min_len)

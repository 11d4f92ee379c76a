"""Text and link expressions."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce
from html.entities import html5
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space in the Unicode sense, for Java's regex engine.
SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"

# Named entities that are decoded without leaving the JVM. The ampersand comes
# last so that "&amp;lt;" is decoded once only.
COMMON_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&nbsp;": " ",
    "&amp;": "&",
}
# Any reference: by number, by hexadecimal number, or by a name with or without its end.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Names that count without an end, also with other text behind them; longest first.
_OPEN_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
# Numbers 128 to 159 mean the characters of that code page, where it has one.
_LATIN_WINDOWS = [
    bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)
]
_OTHER_ENTITY = r"&(?!(?:lt|gt|quot|#39|nbsp|amp);)[#A-Za-z]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _char(code: Column) -> Column:
    """The character of a number; some numbers stand for another one or for none."""
    utf32 = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    none = (
        code.between(1, 8)
        | (code == 0xB)
        | code.between(0xE, 0x1F)
        | (code == 0x7F)
        | code.between(0xFDD0, 0xFDEF)
        | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    unknown = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    windows = F.element_at(F.lit(_LATIN_WINDOWS), (code - 0x7F).cast("int"))
    return (
        F.when(code.between(0x80, 0x9F), windows)
        .when(unknown, "\ufffd")
        .when(none, "")
        .otherwise(utf32)
    )


def _decode(reference: Column) -> Column:
    """One reference with its ampersand; what is none stays as it is."""
    digits = F.regexp_extract(reference, "^&#0*([0-9]*);?$", 1)
    hexadecimal = F.regexp_extract(reference, "^&#[xX]0*([0-9a-fA-F]*);?$", 1)
    beyond = F.lit(0x110000).cast("long")
    by_hex = F.conv(F.concat(F.lit("0"), hexadecimal), 16, 10).cast("long")
    by_digits = F.concat(F.lit("0"), digits).cast("long")
    code = F.when(
        reference.rlike("^&#[xX]"), F.when(F.length(hexadecimal) > 6, beyond).otherwise(by_hex)
    ).otherwise(F.when(F.length(digits) > 7, beyond).otherwise(by_digits))
    name = F.substring(reference, 2, 40)
    # A literal that the optimizer folds into one map.
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    start = F.regexp_extract(name, f"^(?:{'|'.join(_OPEN_NAMES)})", 0)
    rest = F.substring(name, F.length(start) + 1, F.lit(40))
    named = F.coalesce(
        F.try_element_at(names, name), F.concat(F.try_element_at(names, start), rest), reference
    )
    return F.when(reference.startswith("&#"), _char(code)).otherwise(named)


def unescape(text: Column | str, exact: bool = True) -> Column:
    """Decode character references.

    Text without an ampersand is passed through. The common references are
    plain string replacements. With ``exact`` the rare rows that hold any other
    reference are cut at their references, each of which is decoded.
    """
    text = _col(text)
    decoded = reduce(
        lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), COMMON_ENTITIES.items(), text
    )
    if exact:
        rare = F.contains(text, F.lit("&")) & text.rlike(_OTHER_ENTITY)
        parts = F.zip_with(
            F.split(text, _REFERENCE, -1),
            F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)),
            lambda before, found: F.concat(before, F.coalesce(_decode(found), F.lit(""))),
        )
        decoded = F.when(rare, F.array_join(parts, "")).otherwise(decoded)
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def drop_tags(text: Column | str) -> Column:
    """Every ``<...>`` becomes a space."""
    text = _col(text)
    stripped = F.regexp_replace(text, "<[^>]+>", " ")
    return F.when(F.contains(text, F.lit("<")), stripped).otherwise(text)


def collapse_space(text: Column | str) -> Column:
    squeezed = F.regexp_replace(_col(text), f"{SPACE}+", " ")
    return F.trim(squeezed)


def bare_text(text: Column | str, exact: bool = True) -> Column:
    """Decoded, tag-free, lower-case text; null becomes ''."""
    return F.lower(drop_tags(unescape(F.coalesce(_col(text), F.lit("")), exact)))


def plain_text(text: Column | str, exact: bool = True) -> Column:
    """``bare_text`` with single spaces and none at the ends."""
    return collapse_space(bare_text(text, exact))


def search_text(*cols: Column | str) -> Column:
    """Lower-cased concatenation; null parts are skipped."""
    return F.lower(F.concat_ws(" ", *[_col(c) for c in cols]))


def word_text(text: Column | str) -> Column:
    """The words of a lower-cased text, each set off by one space on both sides."""
    words = F.regexp_replace(F.lower(_col(text)), r"[^\p{L}\p{N}]+", " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def holds(text: Column | str, needles: Iterable[str]) -> Column:
    return reduce(or_, [F.contains(_col(text), F.lit(n)) for n in needles])


def needles(keywords: Iterable[str], mode: str) -> list[str]:
    """What to look for in lower-cased text, or in ``word_text`` in word mode."""
    if mode not in ("substring", "word"):
        raise ValueError(f"unknown mode {mode!r}")
    return [f" {k.lower()} " if mode == "word" else k.lower() for k in keywords]


def contains_any(text: Column | str, keywords: Iterable[str], mode: str = "substring") -> Column:
    """True if any keyword occurs in an already lower-cased text.

    ``substring`` finds it anywhere, ``word`` only as whole words.
    """
    wanted = needles(keywords, mode)
    hay = word_text(text) if mode == "word" else _col(text)
    # A filter is pushed below the projection that prepares the text, which
    # would repeat that work per keyword; as an array element it is done once.
    return F.exists(F.array(hay), lambda t: holds(t, wanted))


def stable_key(link: Column | str) -> Column:
    return F.substring(F.md5(_col(link).cast("binary")), 1, 12)


def link_host(url: Column | str) -> Column:
    """The authority part (port and user info included), lower-cased."""
    return F.lower(F.regexp_extract(_col(url), r"^(?:[^:/?#]+:)?//([^/?#]*)", 1))


def link_path(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(_col(url), r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1))

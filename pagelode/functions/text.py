"""Text scalars as JVM column expressions (no Python on the executors).

Null in, null out, unless a docstring says otherwise.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Windows-1252 code points above U+00FF and the bytes they stand for.
CP1252_HIGH = {
    0x20AC: 0x80, 0x201A: 0x82, 0x0192: 0x83, 0x201E: 0x84, 0x2026: 0x85, 0x2020: 0x86, 0x2021: 0x87,
    0x02C6: 0x88, 0x2030: 0x89, 0x0160: 0x8A, 0x2039: 0x8B, 0x0152: 0x8C, 0x017D: 0x8E, 0x2018: 0x91,
    0x2019: 0x92, 0x201C: 0x93, 0x201D: 0x94, 0x2022: 0x95, 0x2013: 0x96, 0x2014: 0x97, 0x02DC: 0x98,
    0x2122: 0x99, 0x0161: 0x9A, 0x203A: 0x9B, 0x0153: 0x9C, 0x017E: 0x9E, 0x0178: 0x9F,
}


def _accent_table() -> tuple[str, str]:
    """Latin letters with marks and their plain letters, by Unicode decomposition."""
    src, dst = [], []
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(cp))[0]
        if base.isascii() and base.isalpha():
            src.append(chr(cp))
            dst.append(base)
    return "".join(src), "".join(dst)


ACCENTED, PLAIN = _accent_table()
COMBINING = "[\\u0300-\\u036f]"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c: Column | str, body) -> Column:
    """body(x) with x bound to the value of c: long expressions that use it often stay short in the plan."""
    return F.get(F.transform(F.array(as_col(c)), body), F.lit(0))


def fold_accents(c: Column | str) -> Column:
    """Latin letters without their marks; other scripts stay as they are."""
    return F.regexp_replace(F.translate(as_col(c), ACCENTED, PLAIN), COMBINING, "")


def repair_mojibake(c: Column | str) -> Column:
    """Undo UTF-8 that was read as windows-1252; text that does not round-trip comes back untouched."""
    high = "".join(map(chr, CP1252_HIGH))
    low = "".join(map(chr, CP1252_HIGH.values()))

    def decoded(narrow: Column, c: Column) -> Column:
        # encode() raises on characters beyond its set, so only narrow text reaches it
        data = F.encode(F.when(narrow.rlike("^[\\x00-\\xff]*$"), narrow), "iso-8859-1")
        return let(data, lambda d: F.coalesce(F.decode(F.when(F.is_valid_utf8(d.cast("string")), d), "utf-8"), c))

    return let(c, lambda x: F.when(x.rlike("[ÂÃâ]"), let(F.translate(x, high, low), lambda n: decoded(n, x))).otherwise(x))


def normalize_separators(c: Column | str) -> Column:
    """Mojibake repaired; dashes and bullets to '-', curly quotes to straight ones, odd spaces to a space."""
    dashes = "‐‑‒–—―−•·"
    src = dashes + "‘’" + "“”" + "   ​"
    dst = "-" * len(dashes) + "''" + '""' + "    "
    return F.translate(repair_mojibake(c), src, dst)


def squash_spaces(c: Column | str) -> Column:
    """Runs of white space to one space, ends trimmed."""
    return F.trim(F.regexp_replace(as_col(c), "[\\s\\u00a0\\u2007\\u202f\\u200b\\u3000\\ufeff]+", " "))


def blank_to_null(c: Column | str) -> Column:
    """Null where nothing but white space is left, else the trimmed text."""
    t = squash_spaces(c)
    return F.when(F.length(t) > 0, t)


def edge(ignore: str = "") -> str:
    """An ASCII word boundary: Java's own \\b also counts letters beyond ASCII."""
    w = "[A-Za-z0-9_]"
    return f"(?:(?<={w})(?!{w})|(?<!{w})(?={w}))"


def ascii_words(pattern: str) -> str:
    """A pattern whose \\b are ASCII word boundaries."""
    return pattern.replace("\\b", edge())


def any_word(words) -> str:
    """Alternation of literal words, longest first, quoted for a regular expression."""
    quoted = ["".join("\\" + c if c in ".^$*+?()[]{}|\\/-" else c for c in w) for w in words]
    return "|".join(sorted(quoted, key=lambda w: (-len(w), w)))


def name_key(c: Column | str) -> Column:
    """Name reduced for comparison: ASCII letters and digits, filler words dropped; '' for null."""
    from pagelode.profile import NAME_STOP_WORDS

    c = F.regexp_replace(F.lower(F.coalesce(as_col(c), F.lit(""))), "[^a-z0-9]+", " ")
    c = F.regexp_replace(c, ascii_words(f"\\b({'|'.join(NAME_STOP_WORDS)})\\b"), " ")
    return F.trim(F.regexp_replace(c, "\\s+", " "))


def title_case(c: Column | str) -> Column:
    """All-capital or all-small text with capitals after a blank, an apostrophe or a hyphen; mixed case stays; '' for null."""

    def body(t: Column) -> Column:
        parts = F.split(F.lower(t), "(?<=[\\s'’-])")
        capital = F.transform(parts, lambda p: F.when(p.rlike("^[a-z]"), F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))).otherwise(p))
        return F.when((t != F.upper(t)) & (t != F.lower(t)), t).otherwise(F.array_join(capital, ""))

    return let(F.trim(F.coalesce(as_col(c), F.lit(""))), body)


def normalize_city(c: Column | str, aliases: dict[str, str]) -> Column:
    """Trailing marks cut, known short forms spelled out, shouted names in title case; '' for null.

    Capitals are a-z only, after anything but a-z, 0-9 and _: an accented letter stays small and the next one is raised."""

    def body(t: Column) -> Column:
        out = F.when(t == F.upper(t), F.array_join(F.transform(F.split(F.lower(t), "(?<![a-z0-9_])(?=[a-z])"), lambda p: F.concat(F.when(p.rlike("^[a-z]"), F.upper(F.substring(p, 1, 1))).otherwise(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), "")).otherwise(t)
        for pattern, name in aliases.items():
            out = F.when(t.rlike(f"(?i){pattern}"), F.lit(name)).otherwise(out)
        return out

    blank = "[\\s\\u000b\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]+"
    return let(F.regexp_replace(F.regexp_replace(F.coalesce(as_col(c), F.lit("")), "[.'’-]+\\z", ""), f"^{blank}|{blank}\\z", ""), body)


def local_letters(c: Column | str) -> Column:
    """Letters a-z of a name without marks, as they stand in an address; '' for null."""
    return F.regexp_replace(fold_accents(F.lower(F.coalesce(as_col(c), F.lit("")))), "[^a-z]", "")


def decode_entities(c: Column | str) -> Column:
    """HTML character references read once, left to right; unknown names stay; white space squashed; '' for null."""
    from pagelode.profile import ENTITIES

    names = F.create_map(*[F.lit(x) for kv in ENTITIES.items() for x in kv])

    def one(piece: Column) -> Column:
        key = F.lower(F.regexp_extract(piece, "^&(#x[0-9a-fA-F]+|#\\d+|[a-zA-Z]+);", 1))
        rest = F.regexp_replace(piece, "^&(?:#x[0-9a-fA-F]+|#\\d+|[a-zA-Z]+);", "")
        code = F.when(key.startswith("#x"), F.conv(F.substring(key, 3, 8), 16, 10)).when(key.startswith("#"), F.substring(key, 2, 8)).try_cast("int")
        # char() knows the first 256 code points only; the rest is read from its UTF-16 bytes
        high = F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "utf-16be")
        astral = F.decode(F.unhex(F.concat(F.hex(55296 + F.floor((code - 65536) / 1024)), F.hex(56320 + (code - 65536) % 1024))), "utf-16be")
        char = F.when(code.between(1, 65535), high).when(code.between(65536, 1114111), astral)
        value = F.when(key.startswith("#"), char).otherwise(F.try_element_at(names, key))
        return F.when((key == "") | value.isNull(), piece).otherwise(F.concat(value, rest))

    pieces = lambda t: F.array_join(F.transform(F.split(t, "(?=&)"), one), "")
    return let(F.coalesce(as_col(c), F.lit("")), lambda t: squash_spaces(F.when(t.contains("&"), pieces(t)).otherwise(t)))


def html_to_text(c: Column | str) -> Column:
    """Visible text of markup: scripts, styles and comments dropped, blocks to lines, tags cut, references read; '' for null."""
    c = F.regexp_replace(F.coalesce(as_col(c), F.lit("")), "(?is)<(script|style|noscript|template)\\b.*?</\\1\\s*>|<!--.*?-->", " ")
    c = F.regexp_replace(c, "(?i)<br\\s*/?>|</?(p|div|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|title|option|address|blockquote|dd|dt|dl|form)\\b[^>]*>", "\n")
    c = F.regexp_replace(c, "<[^>]*>", "")
    lines = F.transform(F.split(c, "\n"), decode_entities)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")

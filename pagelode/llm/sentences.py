"""Sentence units of texts in any of the usual scripts (problem 8).

Method: all in SQL expressions. Points, quotes' insides and line breaks that end nothing (decimals, hosts and addresses,
initials, abbreviations, ordinals, speech inside a sentence, wrapped lines) are masked one for one by private-use
characters, so no offset moves; a mark is set wherever a script's terminators end a unit; the text is cut at the marks
and the offsets are the running lengths. The unit's text is cut from the original, so nothing has to be unmasked.

Null, empty and blank texts give no unit. A text without any terminator is one unit per line. Texts are processed whole,
whatever their length. Repeated rows give repeated units. Private-use characters in the input are read as letters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions.text import let
from pagelode.llm.common import table

MARK = "\ue0ff"  # set where a unit ends
# Terminators and their masks, one private-use character each.
ENDS = ".!?…。！？｡؟।;"
MASKS = "".join(chr(0xE000 + k) for k in range(len(ENDS)))
BREAK = "\ue010"  # a line break within a sentence
FILL = "\ue012"  # the second character of a two-character line end
PRIVATE = "[\\ue000-\\uf8ff]"
BLANKS = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(map(chr, range(0x2000, 0x200C))) + BREAK + FILL  # no unit begins or ends with one
SPACE = "[\\s\\u00a0\\u1680\\u2000-\\u200b\\u202f\\u205f\\u3000\\ufeff\\x85" + BREAK + FILL + "]"
INDENT = "[ \\t" + FILL + "]*"
EMOJI = "[\\x{1F000}-\\x{1FAFF}\\x{2600}-\\x{27BF}\\x{2B00}-\\x{2BFF}\\x{FE0F}\\x{200D}\\x{20E3}]"
CLOSE = "[\"'”’“»›)\\]）】》」』]"
OPEN = "[\"'“‘«‹„(\\[（【《「『¿¡]"
PARTICLE = "(?:de la|van der|von|van|del|della|di|du|el|al)"
# What a sentence may begin with: a capital, a digit, a letter of a script without case, a name like iPad, a tag.
START = f"(?:{OPEN}{{0,3}}{SPACE}{{0,2}}(?:\\p{{Lu}}|\\p{{Lt}}|\\p{{Lo}}|\\p{{N}}|\\p{{Ll}}{{1,12}}\\p{{Lu}}|<[a-z]|\\$|{PARTICLE} \\p{{Lu}})|[¿¡])"
# Abbreviations that stand before a name, before a number, and within a firm's name.
BEFORE_NAME = "Mr|Mrs|Ms|Mx|Dr|Prof|St|Ste|Lt|Col|Gen|Mgr|Capt|Sgt|Maj|Rev|Hon|Gov|Sen|Messrs|Sr|Sra|Srta|Dra|Dña|Fr|Hr|Frl|Mme|Mlle|Me|Ing|Av|av|Avda|δρ|Δρ|κ|κα|Κ|د|أ|ул|пр|им|пер|डॉ|श्री|r|dr|prof|inż"
BEFORE_NUMBER = (
    "No|Nos|Nr|nr|Núm|núm|n|p|pp|S|Ext|ext|Div|Bldg|Apt|Fig|fig|Abs|Art|art|Vol|vol|Ch|Sec|Rte|Hwy|approx|aprox|ca|env|max|min|Max|Min|circa|Tel|tel|Fax|fax|Str|str|av|Av|Ave|Blvd"
    "|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec|п|д|стр|кв|рис|с|άρθ|αρ|σελ|सं|क्र|h"
)
FIRM = "Bros|Inc|Co|Ltd|Corp|Cie"
MONTHS_DE = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"
ITEM = 48  # headings and list items are shorter than this
WRAP = 60  # a line of so many characters that ends without a terminator runs on in the next line


def _after(before: str, then: str = "", point: str = "\\.") -> str:
    """What must stand behind a point and what must follow; the point itself comes first in the pattern, so the engine skips all other characters fast."""
    return f"(?<={before}{point}){then}"


def _mask_points(c: Column) -> Column:
    """Points that end nothing become masks, in one pass."""
    word, gap = "(?<![\\p{L}\\p{N}])", f"{SPACE}{{0,3}}"
    cases = (
        # hosts, addresses, decimals, a.m.: a small letter or digit follows at once
        _after("[\\p{L}\\p{N}_/)-]", "(?=[\\p{Ll}\\p{N}_/])"),
        _after(f"{word}Ph", "(?=D\\b)"),
        _after(f"{word}Ph\\.D", "(?= \\p{L})"),
        _after(f"{word}(?:{BEFORE_NAME})", f"(?={gap}[\\p{{L}}])"),
        _after(f"{word}(?:{BEFORE_NUMBER})", f"(?={gap}[(+]?\\p{{N}})"),
        _after(f"{word}(?:Nov|Dec|Jan|Feb|Mar|Apr|Aug|Sept|Sep|Oct)\\.?", f"(?=\\.{{0,2}}{gap}\\p{{N}})"),
        _after("[a-zß]{3}str", "(?= \\p{N})"),
        # initials: one capital, followed by a name or another initial
        _after(f"{word}\\p{{Lu}}", f"(?={gap}(?:\\p{{Lu}}|{PARTICLE} \\p{{Lu}}))"),
        # the Russian г. is a year after a number and a town before a name
        _after(f"(?<!\\p{{N}}{SPACE})(?<![\\p{{L}}\\p{{N}}])г", f"(?={gap}\\p{{Lu}})"),
        _after(f"{word}(?:{FIRM})", f"(?={gap}(?:{FIRM})\\b)"),
        # ordinals
        _after("(?<!\\p{N})\\p{N}{1,2}", f"(?={SPACE}(?:{MONTHS_DE})\\b)"),
        _after("\\b(?:die|der|dem|den|das|Die|Der|Das|am|Am|im|vom|zum) \\p{N}{1,2}", "(?= \\p{Lu})"),
    )
    return F.regexp_replace(c, f"\\.(?:{'|'.join(cases)})", MASKS[0])


def _mask_breaks(c: Column) -> Column:
    """Line breaks within a sentence become BREAK; what is left of them ends a unit."""
    done = "[.!?…।؟;:。！？\"'”’»)\\]）」】]|" + EMOJI
    bullet, number = f"{INDENT}[•*–·-][ \\t]", f"{INDENT}\\p{{N}}{{1,3}}[.)][ \\t]"
    open_end, long = f"(?<!(?:{done}|[\\u0e00-\\u0e7f\\n])\\n)", f"(?<=[^\\n]{{{WRAP}}}\\n)"
    more = f"(?!{INDENT}\\n)(?!{INDENT}$)"
    rules = (
        # a long line without an end goes on, even with a number that looks like an item's
        f"{open_end}{long}(?!{bullet}){more}",
        f"{open_end}(?<=[^\\n]{{{ITEM}}}\\n)(?!{bullet}|{number}){more}",
        # after a long line that ends, the next words decide
        f"{long}(?<![\\u0e00-\\u0e7f]\\n)(?!{bullet}|{number}){more}",
        # after an abbreviation, and before a small letter
        f"(?<={MASKS[0]}\\n){more}",
        f"{open_end}(?={INDENT}\\p{{Ll}}{{1,30}}[\\s,.;])",
    )
    c = F.regexp_replace(c, f"\\n(?:{'|'.join(rules)})", BREAK)
    # the number of a list item
    return F.regexp_replace(c, f"\\.(?<=(?:^|\\n){INDENT[:-1]}{{0,3}}\\p{{N}}{{1,3}}\\.)(?=[ \\t])", MASKS[0])


def _inside(speech: Column) -> Column:
    """Terminators of a piece of speech masked, but for those that end it."""
    tail = F.length(F.regexp_extract(speech, "[.!?…。！？｡؟।]*[\\s\\u00a0\\u202f]?[\"”»“」』›]?$", 0))
    body = F.length(speech) - tail
    return F.concat(F.translate(F.substring(speech, F.lit(1), body), ENDS[:-1], MASKS[:-1]), F.substring(speech, body + 1, tail))


def _mask_speech(c: Column) -> Column:
    """Terminators within speech become masks, but for those right before the closing quote."""

    def paired(x: Column, opening: str, closing: str) -> Column:
        whole = lambda p: p.rlike(f"^[{opening}]") & p.rlike(f"[{closing}]$") & ~p.contains("\n\n")
        cut = F.split(x, f"(?=[{opening}])|(?<=[{closing}])")
        return F.when(x.rlike(f"[{opening}]"), F.array_join(F.transform(cut, lambda p: F.when(whole(p), _inside(p)).otherwise(p)), "")).otherwise(x)

    def straight(x: Column) -> Column:
        parts = lambda p: F.split(p, '"')
        line = lambda p: let(parts(p), lambda q: F.array_join(F.transform(q, lambda y, i: F.when((i % 2 == 1) & (i < F.size(q) - 1), _inside(y)).otherwise(y)), '"'))
        # straight quotes are paired within a paragraph
        return F.when(x.contains('"'), F.array_join(F.transform(F.split(x, f"\\n(?={INDENT}\\n)"), line), "\n")).otherwise(x)

    return let(let(let(c, lambda x: paired(x, "„", "“”")), lambda x: paired(x, "“«「『‹", "”»」』›")), straight)


def _mark(c: Column) -> Column:
    """Sets MARK after every unit."""
    tail = f"(?:{SPACE}?[»›])?{CLOSE}{{0,4}}(?:{SPACE}{{0,3}}{EMOJI}{{1,8}}){{0,4}}"
    rules = (
        # scripts with spaces
        (f"([.!?…؟।]+{tail})(?={SPACE}+{START})", f"$1{MARK}"),
        # no space after the terminator, or after its closing quote
        (
            "[.!?](?:" + _after("[\\p{Ll}\\p{N})\\]”»>]", point="[.!?]") + "(?=[\"“(]?\\p{Lu}(?:\\p{Ll}|[." + MASKS[0] + "]|\\b))|[”»)\\]]{1,2}(?=\\p{Lu}\\p{Ll}))",
            f"$0{MARK}",
        ),
        # line breaks that are left, list items among them
        ("\\n+", f"{MARK}$0"),
    )
    for r, put in rules:
        c = F.regexp_replace(c, r, put)
    rare = (
        (EMOJI, f"({EMOJI}+)(?={SPACE}+{START})", f"$1{MARK}"),
        # the Greek question mark
        ("[\\u0370-\\u03ff]", ";(?<=[\\u0370-\\u03ff\\u1f00-\\u1fff];)" + f"({CLOSE}{{0,2}})(?={SPACE}+{START})", f";$1{MARK}"),
        # scripts without spaces: speech that goes on after its closing quote does not end there
        ("[。！？｡]", f"([。！？｡]+(?:[）)】》]|{SPACE}{{0,2}}{EMOJI})*)(?![。！？｡」』”’\")）)】》])", f"$1{MARK}"),
        ("[。！？｡]", f"([。！？｡]+[」』”’\"]+)(?={SPACE}|$)", f"$1{MARK}"),
        # speech after a colon ends its sentence, if nothing goes on from it
        ("[：，][“「『]", "([：，][“「『][^”」』\\n]*[。！？｡][”」』])(?=[^と、，。！？\\s" + MARK + "])", f"$1{MARK}"),
        ("[\\u0e00-\\u0e7f]", "[ \\u00a0\\u2009\\u200b\\t](?<=[\\u0e00-\\u0e7f].)(?=[ \\u00a0\\u2009\\u200b\\t]*[\\u0e00-\\u0e7f])", f"{MARK}$0"),
    )

    def all_rare(x: Column) -> Column:
        for there, r, put in rare:
            x = let(x, _where(there, r, put))
        return x

    # most texts have none of these scripts and signs
    any_ = "|".join(there for there, _, _ in rare)
    return let(c, lambda x: F.when(x.rlike(any_), all_rare(x)).otherwise(x))


def _where(there: str, pattern: str, put: str):
    return lambda x: F.when(x.rlike(there), F.regexp_replace(x, pattern, put)).otherwise(x)


def units(text: Column) -> Column:
    """Array of (start_pos, end_pos) of a text's units, in code points, end exclusive."""
    # line ends of one kind, and private-use characters as letters, so that no mark comes from the text; most texts need neither
    even = lambda x: F.translate(F.replace(F.regexp_replace(x, PRIVATE, "x"), F.lit("\r\n"), F.lit("\n" + FILL)), "\r\u2028\u2029", "\n\n\n")
    flat = let(text, lambda x: F.when(x.rlike(f"[\r\u2028\u2029{PRIVATE[1:-1]}]"), even(x)).otherwise(x))
    marked = let(flat, lambda w: let(_mask_points(w), lambda p: let(_mask_breaks(p), lambda q: let(_mask_speech(q), _mark))))

    def cut(pieces: Column) -> Column:
        lens = F.transform(pieces, F.length)
        state = F.aggregate(
            lens, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
            lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")),
        )
        lead = lambda x: F.length(x) - F.length(F.ltrim(x, F.lit(BLANKS)))
        body = lambda x: F.length(F.trim(x, F.lit(BLANKS)))
        one = lambda x, s: F.struct((s + lead(x)).alias("start_pos"), (s + lead(x) + body(x)).alias("end_pos"))
        return F.filter(F.zip_with(pieces, state["starts"], one), lambda u: u["end_pos"] > u["start_pos"])

    return let(F.split(marked, MARK), cut)


def split_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start_pos, end_pos, sentence) of every unit of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(F.length("text") > 0)
    rows = rows.select("doc_id", "text", F.explode(units(F.col("text"))).alias("u"))
    return rows.select("doc_id", F.col("u.start_pos").alias("start_pos"), F.col("u.end_pos").alias("end_pos"), F.substring("text", F.col("u.start_pos") + 1, F.col("u.end_pos") - F.col("u.start_pos")).alias("sentence"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start_pos, end_pos of every sentence unit."""
    return split_sentences(table(spark, sf_dir, "documents")).select("doc_id", F.col("start_pos").cast("long").alias("start_pos"), F.col("end_pos").cast("long").alias("end_pos"))

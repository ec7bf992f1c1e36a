"""Text functions: normalisation, features, classification. All are Column expressions but the Unicode forms."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from scriptorium.functions import profiles as P
from scriptorium.functions.profiles import DEVA, WHITE, WHITE_CHARS, ScriptProfile

ZERO_WIDTH = "\u200b\u200c\u200d\ufeff\u2060"
DOUBLE_QUOTES = "\u201c\u201d\u201e\u201f\u00ab\u00bb\u2039\u203a\u2033\u2036"
SINGLE_QUOTES = "\u2018\u2019\u201a\u201b\u00b4\u0060\u2032\u2035"
DASHES = "[\u2012-\u2015]+"
#: Spaces that become a plain one.
ONE_SPACES = "\t\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"
_OTHER_WHITE = WHITE[1:-1].replace(" ", "")
#: Runs of white space that are not one plain space already: single spaces are left alone, as most are.
WHITE_RUNS = f"[{_OTHER_WHITE}]{WHITE}*| {WHITE}+"
#: Nothing but punctuation, symbols and marks; letters and numbers are what remains.
NO_WORD = r"^[^\p{L}\p{N}]+$"


def unicode_form(text: Column, form: str) -> Column:
    """NFC, NFKC and so on: Spark has no built-in for them, so this is an Arrow function. Null stays null."""

    @F.pandas_udf(StringType())
    def normal(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize(form, t), na_action="ignore")

    return normal(text)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value worked out once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Takes all Unicode white space off both ends."""
    return F.btrim(text, F.lit(WHITE_CHARS))


def is_blank(text: Column) -> Column:
    """Null, empty or spaces only."""
    return F.trim(F.coalesce(text, F.lit(""))) == ""


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(text, F.lit(phrase))
    return found


# --- normalisation ------------------------------------------------------------------------------


def tidy(text: Column) -> Column:
    """The part of ``normalize`` that follows the Unicode form."""
    quotes, apostrophes, spaces = len(DOUBLE_QUOTES), len(SINGLE_QUOTES), len(ONE_SPACES)
    # what becomes one character, then what goes
    out = F.translate(
        F.coalesce(text, F.lit("")),
        DOUBLE_QUOTES + SINGLE_QUOTES + ONE_SPACES + "\u00ad" + ZERO_WIDTH,
        '"' * quotes + "'" * apostrophes + " " * spaces,
    )
    for pattern, by in (("\r\n?", "\n"), (f"-{WHITE}*\n{WHITE}*", ""), (DASHES, "-"), ("  +", " ")):
        out = F.regexp_replace(out, pattern, by)
    return strip(out)


def normalize(text: Column) -> Column:
    """NFKC, then invisible characters go, line ends, quotes, dashes and spaces become plain ones."""
    return tidy(unicode_form(F.coalesce(text, F.lit("")), "NFKC"))


def space_delimiters(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """One space on both sides of each delimiter, in place of all white space there."""
    marks = f"{profile.minor}{profile.major}".replace("\n", "\\n")
    out = F.regexp_replace(text, f"{WHITE}*([{marks}]){WHITE}*", " $1 ")
    return strip(F.regexp_replace(out, "  +", " "))


def normalize_verses(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """``normalize``; a lone ``|`` becomes the minor delimiter; delimiters are spaced."""
    return space_delimiters(F.regexp_replace(normalize(text), r"(?<!\|)\|(?!\|)", profile.minor), profile)


def normalize_record(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """After OCR: words broken over lines are joined, all white space becomes one space, then ``normalize_verses``."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n")
    out = F.regexp_replace(F.regexp_replace(out, f"-{WHITE}*\n{WHITE}*", ""), f"{WHITE}+", " ")
    return normalize_verses(out, profile)


def legacy_clean(text: Column, marks: str = "\u0964\u0965", hyphens: str = "-\u2010\u2011\u2012\u2013") -> Column:
    """NFC, without zero-width characters, delimiters as ``|``, hyphens as ``-``."""
    out = unicode_form(F.coalesce(text, F.lit("")), "NFC")
    return strip(F.translate(out, marks + hyphens + ZERO_WIDTH, "|" * len(marks) + "-" * len(hyphens)))


def strip_lines(text: Column) -> Column:
    """Each line stripped, then the whole."""
    return strip(F.array_join(F.transform(F.split(text, "\n", -1), strip), "\n"))


def collapse(text: Column) -> Column:
    """Any white space becomes one space; ends are stripped."""
    return strip(F.regexp_replace(text, WHITE_RUNS, " "))


def clean_for_translation(text: Column) -> Column:
    """Without a leading bullet, a lone page label, bracketed folio and note marks, repeated spaces."""
    out = text
    for pattern, by in (
        (f"^{WHITE}*[-•*]{WHITE}+", ""),
        (f"(?i)^{WHITE}*Page{WHITE}+[0-9]+{WHITE}*$", ""),
        (f"\\[{WHITE}*[0-9]+[°*]{WHITE}*\\]", ""),
        (f"(?i)\\[fol\\.{WHITE}*[0-9]+[\\p{{L}}\\p{{N}}_]*\\]", ""),
        ("  +", " "),
    ):
        out = F.regexp_replace(out, pattern, by)
    return strip(out)


def ascii_digits(text: Column, profile: ScriptProfile = DEVA) -> Column:
    return F.translate(text, profile.digits_from, profile.digits_to)


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[ \t]*\r?\n[ \t]*", " "))


# --- names --------------------------------------------------------------------------------------


def doc_code(slug: Column, prefix: str) -> Column:
    """A slug as a code: no leading article, other characters as ``_``, no digit at the end, 64 characters."""
    out = F.regexp_replace(F.lower(slug), "^(the|a|an)-", "")
    out = F.regexp_replace(F.regexp_replace(out, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    out = F.when(F.regexp_like(out, F.lit("[0-9]$")), F.concat(out, F.lit("_x"))).otherwise(out)
    return F.substring(F.concat(F.lit(prefix), out), 1, 64)


def file_name(text: Column) -> Column:
    out = F.regexp_replace(strip(text), r"[^\p{L}\p{N}_-]+", "_")
    return F.regexp_replace(F.regexp_replace(out, "_+", "_"), "^[._]+|[._]+$", "")


def is_doc_code(text: Column) -> Column:
    return F.regexp_like(text, F.lit(r"^[A-Za-z0-9_\-]+$"))


# --- features -----------------------------------------------------------------------------------


def count_of(text: Column, chars: str) -> Column:
    """How many characters are of the class ``[chars]``; null counts as empty."""
    return let(F.coalesce(text, F.lit("")), lambda t: F.length(t) - F.length(F.regexp_replace(t, f"[{chars}]+", "")))


def share(text: Column, chars: str) -> Column:
    """The part of the characters that are of the class ``[chars]``; 0 for an empty text."""
    return count_of(text, chars) / F.greatest(F.length(F.coalesce(text, F.lit(""))), F.lit(1))


def script_share(text: Column, profile: ScriptProfile = DEVA) -> Column:
    return share(text, profile.letters)


def delimiters(text: Column, profile: ScriptProfile = DEVA) -> tuple[Column, Column]:
    """How many minor and major delimiters there are."""
    n = F.length(text)
    return (
        n - F.length(F.replace(text, F.lit(profile.minor), F.lit(""))),
        n - F.length(F.replace(text, F.lit(profile.major), F.lit(""))),
    )


def density_score(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """0.6 of the script's share plus 0.4 of the delimiters' score; three digits."""
    minor, major = delimiters(text, profile)
    marks = F.least(F.lit(1.0), (minor + major * 2) / F.lit(5.0))
    return F.round(0.6 * script_share(text, profile) + 0.4 * marks, 3)


def passage_quality(text: Column, profile: ScriptProfile = DEVA) -> Column:
    return F.when(is_noise(text), F.lit(0.0)).otherwise(density_score(text, profile))


def ingest_quality(stored: Column, engine: Column, text: Column, profile: ScriptProfile = DEVA) -> Column:
    """A stored score, else 0.98 for e-texts, else the passage's own."""
    etext = F.startswith(F.coalesce(engine, F.lit("")), F.lit("gretil"))
    return F.coalesce(stored, F.when(etext, 0.98), passage_quality(text, profile))


def quality_band(score: Column, edges: Sequence[float] = (0.4, 0.7), names: Sequence[str] = ("red", "amber", "green")) -> Column:
    """The name of the highest edge that ``score`` reaches; null for a null score."""
    out = F.lit(names[0])
    for edge, name in zip(edges, names[1:], strict=True):
        out = F.when(score >= edge, name).otherwise(out)
    return F.when(score.isNotNull(), out)


# --- classification -----------------------------------------------------------------------------


def is_noise(text: Column) -> Column:
    """Nothing but white space, punctuation and marks."""
    return let(strip(F.coalesce(text, F.lit(""))), lambda t: (t == "") | F.regexp_like(t, F.lit(NO_WORD)))


def is_heading(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """Two characters at most, or a colon at the end, or all capitals without a letter of the script.

    For a script that has capitals itself, its letters do not count against it.
    """

    def of(t: Column) -> Column:
        capitals = (F.upper(t) == t) & (F.lower(t) != t)
        if profile.name != "latin":
            capitals = capitals & (count_of(t, profile.letters) == 0)
        return (F.length(t) <= 2) | F.endswith(t, F.lit(":")) | capitals

    return (F.coalesce(text, F.lit("")) != "") & let(strip(F.coalesce(text, F.lit(""))), of)


def is_table_fragment(text: Column) -> Column:
    """A word of Roman numerals' letters before ``.`` or ``)``, or a leading bullet before a word."""
    word = r"(?i)(?:^|[^\p{L}\p{N}_])[ivxlcdm]+" + WHITE + r"*[.)]"
    return F.regexp_like(text, F.lit(word)) | F.regexp_like(text, F.lit(f"^{WHITE}*[-•*]{WHITE}+[\\p{{L}}\\p{{N}}_]"))


def is_front_matter(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """A publisher's banner anywhere, or a front-matter word in a text with next to none of the script."""
    plain = script_share(text, profile) <= 0.05  # the share is worked out only where there is such a word
    return let(F.lower(text), lambda t: contains_any(t, P.PUBLISHER_BANNERS) | (contains_any(t, P.FRONT_MATTER) & plain))


def worth_translating(text: Column, profile: ScriptProfile = DEVA, least: float = 0.05) -> Column:
    return (
        ~is_noise(text)
        & ~is_heading(text, profile)
        & ~is_table_fragment(text)
        & ~is_front_matter(text, profile)
        & (script_share(text, profile) >= least)
    )


def skips_quality(score: Column, least: Column | float) -> Column:
    """Whether the quality gate skips a row; a score of 0 or null passes, and so does all at a gate of 0."""
    least = least if isinstance(least, Column) else F.lit(float(least))
    return F.coalesce((least > 0) & (score > 0) & (score < least), F.lit(False))


def is_navigation(text: Column, profile: ScriptProfile = DEVA) -> Column:
    t = F.lower(collapse(F.replace(text, F.lit("\u00a0"), F.lit(" "))))
    return let(t, lambda t: t.isin(*P.NAVIGATION) | ((F.length(t) <= 2) & (count_of(t, profile.letters) == 0)))


def is_verse_line(line: Column, least: float = 0.25, profile: ScriptProfile = DEVA, marks: str = P.IAST_MARKS) -> Column:
    """The script dominates, or a delimiter stands by script or transliteration marks, or such marks are dense."""
    ends = f"{profile.minor}{profile.major}".replace("\n", "\\n")

    def of(f: Column) -> Column:
        dominant = (f.own > 0) & (f.own / f.n >= least)
        return dominant | ((f.ends > 0) & ((f.own > 0) | (f.iast > 0))) | ((f.iast >= 3) & (f.iast / f.n >= 0.02))

    def features(t: Column) -> Column:
        return F.struct(
            F.length(t).alias("n"),
            count_of(t, profile.letters).alias("own"),
            count_of(t, marks).alias("iast"),
            count_of(t, ends).alias("ends"),
        )

    return let(strip(F.coalesce(line, F.lit(""))), lambda t: (t != "") & let(features(t), of))

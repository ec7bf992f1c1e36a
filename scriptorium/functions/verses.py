"""The structure of verses: references, chapters, kinds, metre. Column expressions, but for transliteration."""

from __future__ import annotations

import re
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from scriptorium.functions import profiles as P
from scriptorium.functions.profiles import DEVA, WHITE, WHITE_CHARS, ScriptProfile
from scriptorium.functions.text import ascii_digits, contains_any, count_of, delimiters, let, script_share, strip
from scriptorium.session import ship


def _edge(profile: ScriptProfile) -> str:
    """What may stand around a number at the end of a verse: delimiters and white space."""
    marks = "".join(f"\\{c}" if c in ".|" else c for c in (profile.minor, profile.major) if c != "\n")
    return f"[{marks}{WHITE[1:-1]}]*"


def ref_and_text(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """``struct<ref, clean>``: the reference at a text's end, in ASCII digits (else null), and the text before it.

    ``a.b`` or ``a.b.c`` goes before a single number. A number of four digits gives
    up its first digit to the text. Only what may belong to a reference is searched:
    the characters at the end that are digits, points, delimiters or white space.
    """
    edge, number = _edge(profile), f"[{profile.digits}]{{1,3}}"
    dotted = f"{edge}({number})\\.({number})(?:\\.({number}))?{edge}$"
    single = f"{edge}({number}){edge}$"
    digits = "".join(dict.fromkeys(profile.digits_from + profile.digits_to))
    endings = digits + "." + profile.minor + profile.major + WHITE_CHARS

    def of(s: Column) -> Column:
        parts = [ascii_digits(F.regexp_extract(s.tail, dotted, k), profile) for k in (1, 2, 3)]
        clean = lambda pattern: F.rtrim(F.concat(s.body, F.regexp_replace(s.tail, pattern, "")), F.lit(WHITE_CHARS))
        pair = lambda ref, clean: F.struct(ref.alias("ref"), clean.alias("clean"))
        return (
            F.when(
                F.regexp_like(s.tail, F.lit(dotted)),
                pair(F.concat_ws(".", parts[0], parts[1], F.nullif(parts[2], F.lit(""))), clean(dotted)),
            )
            .when(
                F.regexp_like(s.tail, F.lit(single)),
                pair(ascii_digits(F.regexp_extract(s.tail, single, 1), profile), clean(single)),
            )
            .otherwise(pair(F.lit(None).cast("string"), text))
        )

    def split(whole: Column) -> Column:
        body = F.rtrim(whole, F.lit(endings))
        return F.struct(body.alias("body"), F.substring(whole, F.length(body) + 1, F.length(whole)).alias("tail"))

    return let(let(F.rtrim(text, F.lit(WHITE_CHARS)), split), of)


def verse_ref(text: Column, profile: ScriptProfile = DEVA) -> tuple[Column, Column]:
    """The two fields of ``ref_and_text``."""
    both = ref_and_text(text, profile)
    return both["ref"], both["clean"]


def chapter(text: Column, profile: ScriptProfile = DEVA, bare_number: bool = False) -> Column:
    """The number behind the first chapter word, else the header as it stands; null without one.

    A header takes in the number behind its word, so only a second number counts as
    such; ``bare_number`` gives the header's own.
    """
    pattern = f"({profile.chapter}){WHITE}*([{profile.digits}]*)"

    def of(hit: Column) -> Column:
        # the hit is short, so the groups are searched for in it and not in the text again
        head, number = F.regexp_extract(hit, pattern, 1), F.regexp_extract(hit, pattern, 2)
        out = F.when(number != "", ascii_digits(number, profile)).otherwise(strip(head))
        if bare_number:
            own = ascii_digits(F.regexp_extract(head, f"([{profile.digits}]+)$", 1), profile)
            out = F.when(own != "", own).otherwise(out)
        return F.when(hit != "", out)

    return let(F.regexp_extract(text, pattern, 0), of)


def lines_with_text(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n", -1), lambda x: strip(x) != ""))


def text_kind(text: Column, profile: ScriptProfile = DEVA, anchored: bool = False) -> Column:
    """``noise``, ``frontmatter``, ``prose``, ``colophon``, ``tika`` or ``mula``; the first rule that fits.

    A text of one or two lines with a chapter word is a colophon; ``anchored`` asks
    for the word at a line's start.
    """
    header = f"(?m)^{WHITE}*{profile.chapter}" if anchored else profile.chapter

    def of(f: Column) -> Column:
        t, own = f.t, f.own
        return (
            F.when((own < 0.03) & (F.length(strip(t)) < 30), "noise")
            .when((own < 0.05) & contains_any(F.lower(t), P.SEGMENT_FRONT_MATTER), "frontmatter")
            .when(own < 0.05, "prose")
            .when(F.regexp_like(t, F.lit(profile.colophon)), "colophon")
            .when((lines_with_text(t) <= 2) & F.regexp_like(t, F.lit(header)), "colophon")
            .when((own < 0.40) & F.regexp_like(t, F.lit(profile.commentary)), "tika")
            .when(~F.contains(t, F.lit(profile.minor)) & ~F.contains(t, F.lit(profile.major)) & (own < 0.60), "prose")
            .otherwise("mula")
        )

    t = F.coalesce(text, F.lit(""))
    return let(F.struct(t.alias("t"), script_share(t, profile).alias("own")), of)


def syllables(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """Vowels, and consonants that no sign follows."""
    bare = f"[{profile.consonants}](?![{profile.signs}])"
    return count_of(text, profile.vowels) + F.regexp_count(F.coalesce(text, F.lit("")), F.lit(bare))


def metre(n: Column) -> Column:
    """The metre's name for a number of syllables, or null."""
    out = F.lit(None).cast("string")
    for low, high, name in reversed(P.METRES):
        out = F.when(n.between(low, high), name).otherwise(out)
    return out


def metre_of(text: Column, profile: ScriptProfile = DEVA) -> Column:
    return let(syllables(text, profile), metre)


def padas(text: Column, kind: Column, profile: ScriptProfile = DEVA) -> Column:
    minor, major = delimiters(text, profile)
    return F.when(kind == "mula", minor + 2 * major).otherwise(0)


def section_key(chapter: Column, page: Column) -> Column:
    """``chapter:N`` for a numeric chapter, else ``page:N``."""
    numeric = F.regexp_like(F.coalesce(strip(chapter), F.lit("")), F.lit(r"^[0-9]+([.\-–][0-9]+)*$"))
    return F.when(numeric, F.concat(F.lit("chapter:"), strip(chapter))).otherwise(F.concat(F.lit("page:"), page.cast("string")))


def clauses(text: Column, profile: ScriptProfile = DEVA) -> Column:
    """Clauses between delimiters, each an array of words; the whole text where there are none."""
    marks = "".join(f"\\{c}" if c in ".|" else c for c in "|" + profile.minor + profile.major)
    parts = F.transform(
        F.split(strip(text), f"[{marks}]+", -1), lambda c: F.filter(F.split(c, f"{WHITE}+", -1), lambda w: w != "")
    )
    found = F.filter(parts, lambda c: F.size(c) > 0)
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.array(strip(text))))


def find_all(text: Column, form: Column) -> Column:
    """The zero-based places of ``form`` in ``text``, overlapping ones too; one search after the other, so in linear time."""
    ship()

    def places(t: str | None, f: str | None) -> list[int]:
        out: list[int] = []
        if t and f:
            at = t.find(f)
            while at >= 0:
                out.append(at)
                at = t.find(f, at + 1)
        return out

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([places(t, f) for t, f in zip(texts, forms, strict=True)], dtype=object)

    return run(text, form)


# --- transliteration ----------------------------------------------------------------------------

#: Devanagari letters and signs with their romanisation.
VOWELS = dict(zip("अआइईउऊऋॠऌॡएऐओऔ", "a ā i ī u ū ṛ ṝ ḷ ḹ e ai o au".split(), strict=True))
SIGNS = dict(zip("ािीुूृॄॢॣेैोौ", "ā i ī u ū ṛ ṝ ḷ ḹ e ai o au".split(), strict=True))
CONSONANTS = dict(
    zip(
        "कखगघङचछजझञटठडढणतथदधनपफबभमयरलवशषसहळ",
        "k kh g gh ṅ c ch j jh ñ ṭ ṭh ḍ ḍh ṇ t th d dh n p ph b bh m y r l v ś ṣ s h ḻ".split(),
        strict=True,
    )
)
OTHERS = {"ं": "ṃ", "ः": "ḥ", "ँ": "m̐", "ऽ": "'", "।": "|", "॥": "||"} | dict(zip("०१२३४५६७८९", "0123456789", strict=True))
VIRAMA = "्"
#: The SLP1 letters of the same sounds, where they are not the same.
SLP1 = {
    "ā": "A", "ī": "I", "ū": "U", "ṛ": "f", "ṝ": "F", "ḷ": "x", "ḹ": "X", "ai": "E", "au": "O", "kh": "K", "gh": "G",
    "ṅ": "N", "ch": "C", "jh": "J", "ñ": "Y", "ṭh": "W", "ṭ": "w", "ḍh": "Q", "ḍ": "q", "ṇ": "R", "th": "T", "dh": "D",
    "ph": "P", "bh": "B", "ś": "S", "ṣ": "z", "ṃ": "M", "ḥ": "H", "ḻ": "L",
}


def romanise(text: str) -> str:
    """Devanagari to IAST; other characters stay."""
    out: list[str] = []
    for k, c in enumerate(text):
        if c in CONSONANTS:
            out.append(CONSONANTS[c])
            after = text[k + 1 : k + 2]
            if after != VIRAMA and after not in SIGNS:
                out.append("a")
        elif c != VIRAMA:
            out.append(SIGNS.get(c) or VOWELS.get(c) or OTHERS.get(c) or c)
    return "".join(out)


def devanagari(text: str) -> str:
    """IAST to Devanagari, the longest sound first."""
    consonants, vowels = {v: k for k, v in CONSONANTS.items()}, {v: k for k, v in VOWELS.items()}
    signs, others = {v: k for k, v in SIGNS.items()}, {v: k for k, v in OTHERS.items()}
    out: list[str] = []
    at, open_consonant = 0, False
    while at < len(text):
        for n in (2, 1):
            s = text[at : at + n]
            if s in consonants:
                out += [VIRAMA] * open_consonant + [consonants[s]]
                open_consonant = True
            elif s in vowels:
                out.append("" if open_consonant and s == "a" else signs[s] if open_consonant else vowels[s])
                open_consonant = False
            elif s in others or n == 1:
                out += [VIRAMA] * open_consonant + [others.get(s, s)]
                open_consonant = False
            else:
                continue
            at += n
            break
    return "".join(out + [VIRAMA] * open_consonant)


def slp1(text: str) -> str:
    """Devanagari to SLP1."""
    iast, out, at = romanise(text), [], 0
    while at < len(iast):
        n = 2 if iast[at : at + 2] in SLP1 else 1
        out.append(SLP1.get(iast[at : at + n], iast[at : at + n]))
        at += n
    return "".join(out)


def _arrow(function):
    ship()

    @F.pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(function, na_action="ignore")

    return run


def to_iast(text: Column) -> Column:
    """Empty for a blank text."""
    return F.when(strip(F.coalesce(text, F.lit(""))) == "", "").otherwise(_arrow(romanise)(text))


def to_devanagari(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(_arrow(devanagari)(text))


def lemmas(text: Column) -> Column:
    """``array<struct<form, lemma, pos>>``: each word with its SLP1 form as a stand-in for a lemma."""
    forms = F.filter(F.split(strip(text), f"{WHITE}+", -1), lambda w: w != "")
    romans = F.split(_arrow(slp1)(F.array_join(forms, " ")), " ", -1)
    return F.transform(
        F.arrays_zip(forms.alias("form"), romans.alias("lemma")),
        lambda z: F.struct(z.form.alias("form"), z.lemma.alias("lemma"), F.lit(None).cast("string").alias("pos")),
    )


_NAME = re.compile(r"(?<!\w)[A-ZĀĪŪṚṜḶṄÑṬḌṆŚṢḤṂ][a-zāīūṛṝḷṅñṭḍṇśṣḥṃ]+")


def proper_nouns(iast: Column) -> Column:
    """Capitalised romanised words: ``array<struct<iast, start, end>>``, zero-based, the end exclusive.

    In one pass over a text; expressions would add up all that is before each name anew.
    """
    ship()

    @F.pandas_udf("array<struct<iast: string, start: int, end: int>>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"iast": m.group(), "start": m.start(), "end": m.end()} for m in _NAME.finditer(t)], na_action="ignore")

    return run(iast)

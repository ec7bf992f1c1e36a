"""Judging, salvaging and styling translations; prompts and costs. Column expressions throughout."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions import profiles as P
from scriptorium.functions.profiles import DEVA, WHITE
from scriptorium.functions.text import NO_WORD, contains_any, let, share, strip

WORDS = f"{WHITE}+"
#: Where a word begins and ends, whatever its script.
_EDGE, _END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def words(text: Column) -> Column:
    """The parts between white space, without empty ones."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORDS, -1), lambda w: w != "")


def overlap(source: Column, out: Column) -> Column:
    """The part of the source's distinct words that ``out`` has."""
    own = F.array_distinct(words(source))
    return F.size(F.array_intersect(own, words(out))) / F.greatest(F.size(own), F.lit(1))


def is_boilerplate(text: Column, lang: str = "en") -> Column:
    """A refusal, a remark on the text, punctuation, or next to nothing."""
    raw = F.coalesce(text, F.lit(""))
    out = let(
        F.lower(strip(raw)),
        lambda t: (F.length(t) < 4) | F.regexp_like(t, F.lit(NO_WORD)) | contains_any(t, P.JUNK_PHRASES),
    )
    return out | contains_any(raw, P.JUNK_PHRASES_HI) if lang == "hi" else out


def is_export_junk(text: Column) -> Column:
    """The shorter list that exports use."""
    return let(
        F.lower(strip(F.coalesce(text, F.lit("")))),
        lambda t: (t == "") | F.regexp_like(t, F.lit(NO_WORD)) | contains_any(t, P.EXPORT_JUNK),
    )


def is_echo(source: Column, out: Column, lang: str = "en") -> Column:
    """Whether ``out`` is the source come back."""
    digits = lambda o: F.regexp_like(o, F.lit("[\u0966-\u096f]"))

    def english(o: Column) -> Column:
        return (o != "") & (digits(o) | (share(o, DEVA.letters) > 0.5))

    def hindi(o: Column) -> Column:
        grammar = contains_any(o, P.HINDI_FUNCTION_WORDS)
        echo = let(overlap(source, o), lambda same: (~grammar & (F.length(o) > 30)) | (digits(o) & (same > 0.4)) | (same > 0.6))
        return (o != "") & (share(o, DEVA.letters) >= 0.5) & echo

    return let(strip(F.coalesce(out, F.lit(""))), hindi if lang == "hi" else english)


def salvage(out: Column, lang: str = "en") -> Column:
    """What stands before the first caveat, up to its last full sentence, with `` […]``; unchanged without a caveat."""
    # the shortest head before any phrase is the one before the first
    quoted = "|".join(f"(?i:\\Q{p}\\E)" for p in P.JUNK_PHRASES + P.CAVEATS)
    if lang == "hi":
        quoted += "".join(f"|\\Q{p}\\E" for p in P.JUNK_PHRASES_HI + P.CAVEATS_HI)

    def sound(kept: Column) -> Column:
        good = (F.length(kept) >= 15) & ~is_boilerplate(kept, lang) & ~is_echo(F.lit(""), kept, lang)
        return F.when(good, F.concat(kept, F.lit(" […]"))).otherwise(F.lit(""))

    def of(t: Column) -> Column:
        head = F.regexp_extract(t, f"(?s)^(.*?)(?:{quoted})", 1)
        kept = strip(F.regexp_extract(head, f"(?s)^(.*(?:[.\u0964\u0965!?](?:{WHITE}|$)|//))", 1))
        return F.when(~F.regexp_like(t, F.lit(quoted)), t).otherwise(let(kept, sound))

    return let(strip(F.coalesce(out, F.lit(""))), of)


def _bands(value: Column, cases: Sequence[tuple[str, float, float]]) -> Column:
    """The penalty of the first case that fits: ``(below or above, bound, penalty)``."""
    out = None
    for way, bound, penalty in cases:
        fits = value < bound if way == "below" else value > bound
        out = F.when(fits, penalty) if out is None else out.when(fits, penalty)
    return out.otherwise(0.0)


def translation_quality(source: Column, out: Column, lang: str = "en") -> Column:
    """A score of 0 to 1 by deductions: length ratio, script, glosses, slashes."""
    pair = f"^{WHITE}*([^|/\n]{{2,60}}){WHITE}*\\|{WHITE}*([^|/\n]{{2,60}}){WHITE}*$"

    def features(t: Column) -> Column:
        n = F.length(t)
        left, right = (F.lower(strip(F.regexp_extract(t, pair, k))) for k in (1, 2))
        slashes = (n - F.length(F.replace(t, F.lit(" / "), F.lit("")))) / 3
        return F.struct(
            t.alias("t"),
            (n / F.greatest(F.length(strip(F.coalesce(source, F.lit("")))), F.lit(1))).alias("ratio"),
            share(t, DEVA.letters).alias("own"),
            share(t, "A-Za-z").alias("latin"),
            (F.regexp_like(t, F.lit(pair)) & (left == right)).alias("gloss"),
            (slashes / F.greatest(F.size(words(t)), F.lit(1))).alias("density"),
        )

    def of(f: Column) -> Column:
        lost = F.when(f.gloss, 0.6).otherwise(0.0)
        if lang == "hi":
            lost = lost + _bands(f.ratio, [("below", 0.5, 0.4), ("below", 0.8, 0.15), ("above", 3.5, 0.3), ("above", 2.5, 0.1)])
            lost = lost + _bands(f.own, [("below", 0.30, 0.5), ("below", 0.55, 0.2)])
            lost = lost + _bands(f.latin, [("above", 0.25, 0.3), ("above", 0.12, 0.1)])
        else:
            lost = lost + _bands(f.ratio, [("below", 0.6, 0.4), ("below", 1.0, 0.15), ("above", 5.0, 0.3), ("above", 3.5, 0.1)])
            lost = lost + _bands(f.own, [("above", 0.30, 0.5), ("above", 0.05, 0.2)])
            lost = lost + _bands(f.density, [("above", 0.08, 0.2), ("above", 0.04, 0.1)])
            lost = lost + F.when(f.latin == 0, 0.5).otherwise(0.0)
        score = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - lost)), 3)
        void = (f.t == "") | f.t.isin(*P.ILLEGIBLE) | is_boilerplate(f.t, lang) | is_echo(source, f.t, lang)
        return F.when(void, F.lit(0.0)).otherwise(score)

    return let(let(strip(F.coalesce(out, F.lit(""))), features), of)


def length_score(source: Column, out: Column) -> Column:
    """A fifth of the length ratio, at most 1; three digits."""
    n = F.length(F.coalesce(out, F.lit(""))) / F.greatest(F.length(F.coalesce(source, F.lit(""))), F.lit(1))
    return F.round(F.least(F.lit(1.0), n / 5), 3)


# --- styling ------------------------------------------------------------------------------------


def escape_html(text: Column) -> Column:
    out = text
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def inline_format(escaped: Column) -> Column:
    """Verse-end slashes go, inner ones become dashes, ``*term*`` is emphasised."""
    out = F.regexp_replace(escaped, f"{WHITE}*//+{WHITE}*$", "")
    out = F.regexp_replace(out, f"{WHITE}*//+{WHITE}*", " — ")
    out = F.regexp_replace(out, f"{WHITE}+/{WHITE}+", " — ")
    out = F.regexp_replace(out, f"{WHITE}+", " ")
    return strip(F.regexp_replace(out, f"\\*(?!{WHITE})([^*\n]+?)(?<!{WHITE})\\*", "<em>$1</em>"))


def footnote_parts(escaped: Column) -> Column:
    """A text as ``array<struct<kind, text>>`` in order: ``plain``, ``gloss`` or ``note``.

    Bracketed notes of two or more words are ``note``, shorter ones ``gloss``;
    marks of illegible places stay plain.
    """
    kept = "|".join(f"\\[{WHITE}*{m.strip('[]').lower()}{WHITE}*\\]" for m in P.ILLEGIBLE)
    split = F.filter(F.split(escaped, r"(?=\[[^\]]+\])|(?<=\])", -1), lambda p: p != "")

    def part(p: Column) -> Column:
        inner = strip(F.regexp_extract(p, r"^\[([^\]]+)\]$", 1))
        bracket = F.regexp_like(p, F.lit(r"^\[[^\]]+\]$")) & ~F.regexp_like(F.lower(p), F.lit(f"^(?:{kept})$"))
        kind = F.when(~bracket, "plain").when(F.size(words(inner)) < 2, "gloss").otherwise("note")
        return F.struct(kind.alias("kind"), F.when(bracket, inner).otherwise(p).alias("text"))

    return F.transform(split, part)


def swap_term(text: Column, old: str, new: str) -> Column:
    """``new`` for the word ``old`` in any case: all capitals, a capital first, or as given."""
    out = F.regexp_replace(text, f"{_EDGE}{old.upper()}{_END}", new.upper())
    out = F.regexp_replace(out, f"{_EDGE}(?=\\p{{Lu}})(?iu:{old}){_END}", new[0].upper() + new[1:].lower())
    return F.regexp_replace(out, f"{_EDGE}(?iu:{old}){_END}", new)


#: The style rules in order, by name, as patterns and replacements, and the terms to swap.
STYLE_CLEAN = (("[\u200b\u200c\u200d\u200e\u200f\u202a-\u202e\u2060]", ""), (f"{WHITE}*\n+{WHITE}*", " "), (f"{WHITE}{{2,}}", " "))
STYLE_STEPS = (
    ("strip:SfP", f"(?i)^{WHITE}*Stories from Panchatantra{WHITE}*[:\\-–—]?{WHITE}*", ""),
    ("strip:TaleOf", f"(?i)^{WHITE}*Tale of the{WHITE}+", ""),
    ("diction:used_to_be", f"(?i){_EDGE}There{WHITE}+used{WHITE}+to{WHITE}+be{_END}", "There was"),
    ("diction:once_was", f"(?i){_EDGE}There{WHITE}+once{WHITE}+was{_END}", "There was"),
)
STYLE_TERMS = {
    "common": (("bargad", "banyan"), ("nyagrodha", "banyan"), ("śṛgāla", "jackal"), ("shrigala", "jackal")),
    "iast": (("banyan", "nyagrodha"), ("bargad", "nyagrodha"), ("jackal", "śṛgāla")),
}


def style(text: Column, mode: str = "common") -> tuple[Column, Column]:
    """The styled text, and the names of the rules that changed it, in order."""
    stages = [text, strip(reduce(lambda t, s: F.regexp_replace(t, *s), STYLE_CLEAN, text))]
    names = ["whitespace/zw"]
    for name, pattern, by in STYLE_STEPS:
        stages.append(F.regexp_replace(stages[-1], pattern, by))
        names.append(name)
    if mode in STYLE_TERMS:
        stages.append(reduce(lambda t, s: swap_term(t, *s), STYLE_TERMS[mode], stages[-1]))
        names.append(f"terms:{mode}")
    hits = [F.when(a != b, F.lit(n)) for n, a, b in zip(names, stages, stages[1:], strict=False)]
    return stages[-1], F.array_compact(F.array(*hits))


def apply_terms(text: Column, terms: Sequence[tuple[str, str]]) -> Column:
    """Each ``(source, target)`` in turn: as a word, then anywhere. The list is small and part of the plan."""
    out = text
    for old, new in terms:
        out = F.regexp_replace(out, rf"(?<![\p{{L}}\p{{N}}_])\Q{old}\E(?![\p{{L}}\p{{N}}_])", new.replace("\\", r"\\").replace("$", r"\$"))
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


#: What opens a tale and goes, with what takes its place.
OPENINGS = (
    (f"(?i)^{WHITE}*There used to be{_END}", "There was"),
    (f"(?i)^{WHITE}*There was once{_END}", "There was"),
    (f"(?i)^{WHITE}*Once upon a time[,]?{WHITE}*", ""),
    (f"(?i){_EDGE}There (?:lived|resided){_END}", "lived"),
)


def polish(text: Column) -> Column:
    """Plain quotes and dashes, joined lines, no opening fillers, spaces after punctuation, no lone numbers."""
    out = F.translate(text, "“”‘’—–", "\"\"''--")
    out = F.replace(out, F.lit("…"), F.lit("..."))
    out = F.regexp_replace(out, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", "$1$2")
    out = F.regexp_replace(out, "[ \t]*\n[ \t]*", " ")
    out = strip(F.regexp_replace(out, "[ \t]+", " "))
    for pattern, by in OPENINGS:
        out = strip(F.regexp_replace(out, pattern, by))
    out = F.regexp_replace(out, f"{WHITE}+([,.;:?!])", "$1")
    out = F.regexp_replace(out, r"([,.;:?!])([^\s])", "$1 $2")
    out = strip(F.regexp_replace(out, "[ \t]+", " "))
    return F.when(F.regexp_like(out, F.lit(r"^\s*[0-9IVXLC]+[.)]?\s*$")), F.lit("")).otherwise(out)


def metre_name(metre: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in P.METRE_NAMES.items() for x in pair))
    return F.coalesce(F.try_element_at(names, metre), metre)


# --- prompts, keys, costs -----------------------------------------------------------------------


def context_line(code: Column, category: Column, chapter: Column, ref: Column, metre: Column, kind: Column) -> Column:
    """What is known of a passage, parts joined by `` | ``; null parts are left out."""
    say = lambda label, c: F.concat(F.lit(label), F.when(c != "", c))
    note = (
        F.when(kind == "tika", "Note: This passage is commentary (ṭīkā), not the root text (mūla)")
        .when(kind == "colophon", "Note: This is a colophon or chapter-closing verse")
        .when(kind == "prose", "Note: This passage is Sanskrit prose, not metrical verse")
    )
    line = F.concat_ws(
        " | ",
        F.concat(F.lit("Text: "), F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))),
        say("Category: ", category),
        say("Chapter/Adhyāya: ", chapter),
        say("Verse: ", ref),
        say("Meter (chandas): ", metre_name(metre)),
        note,
    )
    return F.when(F.contains(line, F.lit(" | ")), F.concat(F.lit("Context: "), line)).otherwise(F.lit(""))


def user_message(text: Column, iast: Column, context: Column, reference: Column) -> Column:
    """The request for one passage; ``context`` is ``array<struct<verse_ref, translation>>``."""
    before = F.transform(
        F.filter(context, lambda c: F.coalesce(c.translation, F.lit("")) != ""),
        lambda c: F.concat(
            F.when(F.coalesce(c.verse_ref, F.lit("")) != "", F.concat(F.lit("["), c.verse_ref, F.lit("] "))).otherwise(F.lit("")),
            c.translation,
        ),
    )
    framed = F.when(
        F.size(context) > 0,
        F.concat_ws(
            "\n",
            F.lit("=== Preceding verses (for context only — do not translate these) ==="),
            F.array_join(before, "\n"),
            F.lit("=== Verse to translate ==="),
        ),
    )
    aid = F.when(strip(iast) != "", F.concat(F.lit("\n[IAST aid: "), strip(iast), F.lit("]")))
    anchor = F.when(
        strip(reference) != "",
        F.concat(F.lit("\n[Verified English reference — for meaning only, DO NOT translate this: "), strip(reference), F.lit("]")),
    )
    return F.concat_ws("\n", framed, strip(text), aid, anchor)


def cache_key(text: Column, version: str = P.PROMPT_VERSION) -> Column:
    """SHA-256 of the prompt's version, a zero character and the text."""
    return F.sha2(F.concat(F.lit(version + "\x00"), text), 256)


def price(engine: Column, side: int, exact: bool = True, prices=P.PRICES, default=P.DEFAULT_PRICE) -> Column:
    """USD for a million tokens, ``side`` 0 in or 1 out.

    ``exact`` looks for the engine's own entry first; else, and without it, the
    first entry of which one name contains the other.
    """
    out = None
    for loose in ([False, True] if exact else [True]):
        for name, *usd in prices:
            fits = engine == name
            if loose:
                fits = F.contains(engine, F.lit(name)) | F.contains(F.lit(name), engine)
            out = F.when(fits, usd[side]) if out is None else out.when(fits, usd[side])
    return out.otherwise(default[side])


def cost(engine: Column, in_chars: Column, out_chars: Column, exact: bool = True, prices=P.PRICES, default=P.DEFAULT_PRICE) -> Column:
    million = P.CHARS_PER_TOKEN * 1e6
    usd = lambda side: price(engine, side, exact, prices, default)
    return usd(0) * (in_chars / million) + usd(1) * (out_chars / million)

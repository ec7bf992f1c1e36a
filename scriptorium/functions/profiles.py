"""What depends on the script of a text, in one place.

Operators take a ``ScriptProfile``: ``DEVA`` for Devanagari, ``LATIN`` for the same
algebra over Latin texts. Patterns are Java regular expressions; ``\\w``, ``\\d``
and ``\\s`` are avoided, as they mean ASCII there.
"""

from __future__ import annotations

from dataclasses import dataclass

#: What Python takes for white space; single characters below 256 are one bit test in Java's patterns, ranges are not.
WHITE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
WHITE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# --- fixed values: word lists and patterns that results depend on -------------------------------

JUNK_PHRASES = (
    "i am not able to provide a translation",
    "i am not able to translate this snippet",
    "i cannot translate",
    "i'm unable to translate",
    "i'm sorry, but",
    "i'm sorry, i cannot",
    "i am sorry",
    "sorry, but",
    "the translation is unclear",
    "does not form a coherent",
    "appears to be a mix of",
    "please provide a complete and coherent snippet",
    "not enough context to translate",
    "unable to translate",
    "this text is not in sanskrit",
    "this does not appear to be",
    "does not appear to be in sanskrit",
    "does not appear to be",
    "the provided text",
    "the text you provided",
    "the text appears to be",
    "this appears to be",
    "cannot be translated",
    "not recognizable as",
    "not a valid sanskrit",
    "not in sanskrit",
    "no valid text",
    "cannot identify",
    "incomplete text",
    "appears to be noise",
    "seems to be noise",
    "garbled",
    "illegible",
    "the text is too",
    "insufficient text",
    "no sanskrit text",
    "[echo]",
    "<<no translation>>",
    "n/a",
)
JUNK_PHRASES_HI = (
    "अनुवाद नहीं",
    "अनुवाद करने में असमर्थ",
    "यह पाठ",
    "स्पष्ट नहीं",
    "संस्कृत नहीं",
    "प्रदान नहीं कर",
    "क्षमा कर",
    "मैं असमर्थ",
    "पठनीय नहीं",
)
CAVEATS = (
    "appears to be a mix",
    "the rest is unclear",
    "the rest of the text",
    "the remaining text",
    "the remainder of",
    "the provided text",
    "unclear due to",
    "due to ocr",
    "due to the ocr",
    "the ocr",
    "illegible portion",
    "difficult to render",
    "cannot be reliably",
    "translator's note",
    "the sanskrit here is",
)
CAVEATS_HI = ("शेष पाठ", "शेष भाग", "अस्पष्ट है", "ओसीआर", "पाठ अस्पष्ट")
EXPORT_JUNK = (
    "i am not able to provide a translation",
    "i am not able to translate this snippet",
    "the translation is unclear",
    "does not form a coherent",
    "appears to be a mix of",
    "please provide a complete and coherent snippet",
    "not enough context to translate",
    "unable to translate",
    "garbled",
)
HINDI_FUNCTION_WORDS = (
    "है", "हैं", "था", "थे", "थी", "के", "में", "और", "ने", "को", "से", "का", "की", "हुआ", "गया", "कहा", "यह", "वह",
    "पर", "भी", "तथा", "किया", "हो",
)
PUBLISHER_BANNERS = (
    "vedic literature",
    "literaturecollection",
    "digital library",
    "gretil",
    "www.",
    "http://",
    "https://",
    "sanskritdocuments",
    "all rights reserved",
    "e-text",
    "input by",
)
FRONT_MATTER = (
    "table of contents",
    "preface",
    "foreword",
    "introduction",
    "bibliography",
    "index",
    "copyright",
    "all rights reserved",
    "printed in",
    "published by",
    "isbn",
    "transliteration scheme",
    "abbreviations",
    "acknowledgements",
)
SEGMENT_FRONT_MATTER = (
    "table of contents",
    "preface",
    "foreword",
    "introduction",
    "bibliography",
    "isbn",
    "copyright",
    "printed in",
    "published by",
    "transliteration",
    "abbreviations",
)
NAVIGATION = (
    "home",
    "about",
    "contact",
    "newsletter",
    "shop",
    "links",
    "photos",
    "tools",
    "resources",
    "support me on patreon",
    "buy relevant books",
)
COMMENT_HEADINGS = ("comments:", "comment:", "add a comment")
ILLEGIBLE = ("[ILLEGIBLE]", "[अस्पष्ट]")
IAST_MARKS = "āīūṛṝḷḹṃḥśṣṭḍṇñṅĀĪŪṚṜḶṂḤŚṢṬḌṆÑṄ"
#: Syllables: the first range that fits names the metre.
METRES = (
    (28, 36, "anustubh"),
    (40, 48, "tristubh"),
    (44, 52, "jagati"),
    (70, 82, "sardula_vikridata"),
    (56, 64, "malini"),
    (52, 60, "vasantatilaka"),
)
METRE_NAMES = {
    "anustubh": "Anuṣṭubh (8-8-8-8 syllables, most common Purāṇic meter)",
    "tristubh": "Triṣṭubh (11-11-11-11 syllables, Vedic)",
    "jagati": "Jagatī (12-12-12-12 syllables)",
    "sloka": "Śloka (Anuṣṭubh variant)",
    "sardula_vikridata": "Śārdūlavikrīḍita (19 syllables per pāda)",
    "malini": "Mālinī (15 syllables per pāda)",
}
#: USD for a million tokens in and out, in order: the first that fits counts where names are matched loosely.
PRICES = (
    ("gemini:gemini-2.5-pro", 1.25, 10.00),
    ("gemini:gemini-2.5-flash", 0.15, 0.60),
    ("gemini:gemini-2.0-flash", 0.075, 0.30),
    ("gemini:gemini-1.5-pro", 1.25, 5.00),
    ("openai:gpt-4o-mini", 0.15, 0.60),
    ("openai:gpt-4o", 2.50, 10.00),
    ("openai:gpt-4o-mini-2024-07-18", 0.15, 0.60),
)
DEFAULT_PRICE = (0.15, 0.60)
#: The same of the older cost report.
LEGACY_PRICES = (
    ("gemini:gemini-2.5-pro", 1.25, 10.00),
    ("gemini:gemini-2.0-flash", 0.075, 0.30),
    ("openai:gpt-4o-mini", 0.15, 0.60),
    ("openai:gpt-4o", 2.50, 10.00),
)
LEGACY_DEFAULT = (1.25, 10.00)
CHARS_PER_TOKEN = 4.0
PROMPT_VERSION = "v2-2026-07-20"
LEGACY_VERSION = "v1-legacy"

# --- profiles; their patterns and classes are fixed values too -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class ScriptProfile:
    """Character classes are given without brackets; patterns as a whole."""

    name: str
    letters: str
    minor: str
    major: str
    digits: str
    digits_from: str
    digits_to: str
    consonants: str
    signs: str  # vowel signs and what silences a consonant
    vowels: str  # independent vowels and vowel signs
    chapter: str
    colophon: str
    commentary: str


DEVA = ScriptProfile(
    name="deva",
    letters="\u0900-\u097f",
    minor="\u0964",
    major="\u0965",
    digits="0-9\u0966-\u096f",
    digits_from="०१२३४५६७८९",
    digits_to="0123456789",
    consonants="\u0915-\u0939\u0958-\u095f",
    signs="\u093e-\u094d",
    vowels="\u0904-\u0914\u093e-\u094c\u0960-\u0963",
    chapter="(?:अध्याय[ःस]?|अध्यायः|पर्व[ण]?|काण्ड[ः]?|सर्ग[ः]?|स्कन्ध[ः]?|प्रकरण[ः]?)" + WHITE + "*(?:[0-9\u0966-\u096f]+)?",
    colophon="इति" + WHITE + "+.{5,80}(?:समाप्त[ःम्]?|पर्व|अध्याय|समाप्[तिः])",
    commentary="तात्पर्यम्|विवरण[मं]|व्याख्या|भाष्य[मं]|टीका|अर्थः|अत्र|यथा" + WHITE + "+-",
)
LATIN = ScriptProfile(
    name="latin",
    letters="A-Za-z",
    minor=".",
    major="\n",
    digits="0-9",
    digits_from="0123456789",
    digits_to="0123456789",
    consonants="b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ",
    signs="aeiouyAEIOUY",
    vowels="aeiouyAEIOUY",
    chapter="(?:Chapter|Kapitel|The|Der)[ ]*(?:[0-9]+)?",
    colophon="[Tt]he .{5,80}(?:tion|ing)",
    commentary="ver|tre|and",
)

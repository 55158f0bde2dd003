"""Text and name cleaning expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TAG = r"<[^>]*>"

# Lower-case Latin letters that fold to ASCII but do not decompose.
LETTERS_WITHOUT_DECOMPOSITION = {
    "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ŋ": "ng", "ĳ": "ij",
    "ð": "d", "đ": "d", "ø": "o", "ł": "l", "ħ": "h", "ı": "i", "ĸ": "k", "ŧ": "t",
    "ſ": "s", "ƒ": "f",
}

# Fixed value: generational suffixes, at the start or after white space.
NAME_SUFFIX = r"(^|\s)(jr|sr|ii|iii|iv|v|vi)\b"

# Fixed value: first or last names entered while trying a survey out.
TEST_NAMES = ("fd", "x", "xx", "xxx", "test")

# Cyrillic and Greek lower-case letters in Latin ones.
ROMANISED = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "i",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
    "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu",
    "я": "ia", "є": "ie", "і": "i", "ї": "i", "ґ": "g", "ў": "u", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "c", "ђ": "d",
    "џ": "dz",
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "i", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
    "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "y", "φ": "ph",
    "χ": "ch", "ψ": "ps", "ω": "o", "ά": "a", "έ": "e", "ή": "i", "ί": "i", "ό": "o", "ύ": "y", "ώ": "o", "ϊ": "i",
    "ϋ": "y", "ΐ": "i", "ΰ": "y",
}

# The characters with the Unicode property Emoji, digits and signs of
# the keyboard and flag letters excepted, written for regular expressions.
EMOJI_CHARACTERS = (
    r"\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{2199}\x{21A9}\x{21AA}\x{231A}\x{231B}\x{2328}\x{23CF}"
    r"\x{23E9}-\x{23F3}\x{23F8}-\x{23FA}\x{24C2}\x{25AA}\x{25AB}\x{25B6}\x{25C0}\x{25FB}-\x{25FE}\x{2600}-\x{2604}"
    r"\x{260E}\x{2611}\x{2614}\x{2615}\x{2618}\x{261D}\x{2620}\x{2622}\x{2623}\x{2626}\x{262A}\x{262E}\x{262F}"
    r"\x{2638}-\x{263A}\x{2640}\x{2642}\x{2648}-\x{2653}\x{265F}\x{2660}\x{2663}\x{2665}\x{2666}\x{2668}\x{267B}"
    r"\x{267E}\x{267F}\x{2692}-\x{2697}\x{2699}\x{269B}\x{269C}\x{26A0}\x{26A1}\x{26A7}\x{26AA}\x{26AB}\x{26B0}\x{26B1}"
    r"\x{26BD}\x{26BE}\x{26C4}\x{26C5}\x{26C8}\x{26CE}\x{26CF}\x{26D1}\x{26D3}\x{26D4}\x{26E9}\x{26EA}\x{26F0}-\x{26F5}"
    r"\x{26F7}-\x{26FA}\x{26FD}\x{2702}\x{2705}\x{2708}-\x{270D}\x{270F}\x{2712}\x{2714}\x{2716}\x{271D}\x{2721}\x{2728}"
    r"\x{2733}\x{2734}\x{2744}\x{2747}\x{274C}\x{274E}\x{2753}-\x{2755}\x{2757}\x{2763}\x{2764}\x{2795}-\x{2797}\x{27A1}"
    r"\x{27B0}\x{27BF}\x{2934}\x{2935}\x{2B05}-\x{2B07}\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}\x{3030}\x{303D}\x{3297}\x{3299}"
    r"\x{1F004}\x{1F0CF}\x{1F170}\x{1F171}\x{1F17E}\x{1F17F}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F201}\x{1F202}\x{1F21A}"
    r"\x{1F22F}\x{1F232}-\x{1F23A}\x{1F250}\x{1F251}\x{1F300}-\x{1F321}\x{1F324}-\x{1F393}\x{1F396}\x{1F397}"
    r"\x{1F399}-\x{1F39B}\x{1F39E}-\x{1F3F0}\x{1F3F3}-\x{1F3F5}\x{1F3F7}-\x{1F4FD}\x{1F4FF}-\x{1F53D}\x{1F549}-\x{1F54E}"
    r"\x{1F550}-\x{1F567}\x{1F56F}\x{1F570}\x{1F573}-\x{1F57A}\x{1F587}\x{1F58A}-\x{1F58D}\x{1F590}\x{1F595}\x{1F596}"
    r"\x{1F5A4}\x{1F5A5}\x{1F5A8}\x{1F5B1}\x{1F5B2}\x{1F5BC}\x{1F5C2}-\x{1F5C4}\x{1F5D1}-\x{1F5D3}\x{1F5DC}-\x{1F5DE}"
    r"\x{1F5E1}\x{1F5E3}\x{1F5E8}\x{1F5EF}\x{1F5F3}\x{1F5FA}-\x{1F64F}\x{1F680}-\x{1F6C5}\x{1F6CB}-\x{1F6D2}"
    r"\x{1F6D5}-\x{1F6D9}\x{1F6DC}-\x{1F6E5}\x{1F6E9}\x{1F6EB}\x{1F6EC}\x{1F6F0}\x{1F6F3}-\x{1F6FC}\x{1F7E0}-\x{1F7EB}"
    r"\x{1F7F0}\x{1F90C}-\x{1F93A}\x{1F93C}-\x{1F945}\x{1F947}-\x{1F9FF}\x{1FA70}-\x{1FA7C}\x{1FA80}-\x{1FAC6}"
    r"\x{1FAC8}\x{1FACC}-\x{1FADD}\x{1FADF}-\x{1FAEB}\x{1FAEF}-\x{1FAFA}"
)
_ONE = (
    rf"[{EMOJI_CHARACTERS}][\x{{FE0E}}\x{{FE0F}}\x{{1F3FB}}-\x{{1F3FF}}]?\x{{20E3}}?"
    r"(?:[\x{E0020}-\x{E007E}]+\x{E007F})?"
)
# A keycap, a flag, or emoji joined to one; joiners and selectors elsewhere are left alone.
# The look-ahead tells most characters apart by a few ranges, before the many are tried.
EMOJI = (
    r"(?=[0-9#*\x{A9}\x{AE}\x{203C}-\x{3299}\x{1F004}-\x{1FAFF}])(?:"
    r"[0-9#*]\x{FE0F}?\x{20E3}"
    r"|[\x{1F1E6}-\x{1F1FF}]{2}"
    rf"|{_ONE}(?:\x{{200D}}{_ONE})*)"
)

# White space of every script, common characters first.
SPACE = r" \t-\r\x1C-\x1F\x85\p{Z}"
NOT_WORD_OR_SPACE = rf"[^a-z0-9_{SPACE}\p{{L}}\p{{N}}]"


def strip_html(value: Column) -> Column:
    """Delete tags; entities stay."""
    return F.regexp_replace(value, TAG, "")


def strip_html_deep(value: Column, data_type: T.DataType) -> Column:
    """``strip_html`` on every string inside arrays, maps and structs."""
    if isinstance(data_type, T.StringType):
        return strip_html(value)
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: strip_html_deep(x, data_type.elementType))
    if isinstance(data_type, T.MapType):
        return F.transform_values(value, lambda _, x: strip_html_deep(x, data_type.valueType))
    if isinstance(data_type, T.StructType):
        fields = [
            strip_html_deep(value[f.name], f.dataType).alias(f.name) for f in data_type.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


@lru_cache(maxsize=1)
def _single_letter_folds() -> tuple[str, str]:
    """Lower-case letters and the one ASCII letter each folds to, mostly by decomposition."""
    plain = {a: b for a, b in LETTERS_WITHOUT_DECOMPOSITION.items() if len(b) == 1}
    source, target = list(plain), list(plain.values())
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        letter = chr(code)
        base = unicodedata.normalize("NFKD", letter)[0]
        known = letter in LETTERS_WITHOUT_DECOMPOSITION or letter != letter.lower()
        if not known and base != letter and base.isascii():
            source.append(letter)
            target.append(base)
    return "".join(source), "".join(target)


def fold_to_latin(value: Column) -> Column:
    """Lower case; accented Latin, Cyrillic and Greek letters to ASCII, fullwidth forms to plain ones.

    Letters of other scripts stay as they are.
    """
    source, target = _single_letter_folds()
    fullwidth = {chr(0xFF41 + i): chr(ord("a") + i) for i in range(26)}
    tables = {**LETTERS_WITHOUT_DECOMPOSITION, **ROMANISED, **fullwidth}
    single = {a: b for a, b in tables.items() if len(b) == 1 and a not in source}
    folded = F.translate(F.lower(value), source + "".join(single), target + "".join(single.values()))
    for letter, letters in tables.items():
        if len(letters) != 1:
            folded = F.replace(folded, F.lit(letter), F.lit(letters))
    return F.regexp_replace(folded, r"[\x{0300}-\x{036F}]", "")


def clean_name(value: Column) -> Column:
    """Comparable form of a first or last name; a missing one becomes ``''``.

    Latin, Cyrillic and Greek letters become ASCII ones where they have such a
    form; all other letters stay.
    """
    raw = F.coalesce(value, F.lit(""))
    # Most names are ASCII and need no folding.
    name = F.when(raw.rlike(r"^\p{ASCII}*$"), F.lower(raw)).otherwise(fold_to_latin(raw))
    name = F.regexp_replace(name, NAME_SUFFIX, "")
    name = F.regexp_replace(name, r"[^a-z\x{80}-\x{10FFFF}]", " ")
    name = F.regexp_replace(name, r"[\x{80}-\x{10FFFF}&&[^\p{L}\p{M}]]", "")
    return F.trim(F.regexp_replace(name, r"\s+", " "))


def is_placeholder_name(name: Column) -> Column:
    """A test entry, or too short to be a name (input already cleaned); in other scripts one letter is a name."""
    return name.isin(*TEST_NAMES) | name.rlike("^[a-z]?$")


def clean_text(value: Column, exact: bool = False) -> Column:
    """Free text for comparison and translation.

    A text with ``N/A`` or ``nan`` anywhere in it is treated as missing; with
    ``exact`` only a text that says nothing else is. White-space-only texts
    are missing too. The rest is lowered and freed of everything that is not a
    letter, a number, an underscore or white space.
    """
    missing = value.rlike(r"^\s*(N/A|nan)\s*$" if exact else "N/A|nan")
    flat = F.regexp_replace(value, "\n", " ")
    blank = flat.rlike(f"^[{SPACE}]*$")
    cleaned = F.regexp_replace(F.lower(flat), NOT_WORD_OR_SPACE, "")
    return F.when(~missing & ~blank, cleaned)


def remove_emojis(value: Column) -> Column:
    return F.regexp_replace(value, EMOJI, "")

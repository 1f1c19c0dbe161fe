"""Text functions as Column expressions: normalisation, language filters, citations, headings."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str`` sees it; the class is the same in Java and in RE2.
SPACES = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A run of white space that is anything but one plain space: the only runs that normalising changes.
ODD_RUN = SPACES.replace(r"\x1c-\x20", r"\x1c-\x1f") + SPACES + "*| " + SPACES + "+"

# Self-talk phrases, script ranges, heading words and numbers, citation patterns and limits that
# decide which rows are kept.
SELF_TALK = [
    r"<\s*/?\s*think\s*>",
    r"\b(?:as an ai|i cannot|i can't|i am unable)\b",
    r"作为\s*(?:一个)?\s*ai",
    r"我是\s*(?:一个)?\s*ai",
    r"我无法",
]
HAN = r"[\x{4e00}-\x{9fff}]"
OTHER_SCRIPTS = r"[\x{3040}-\x{30ff}\x{ac00}-\x{d7af}\x{0400}-\x{04ff}\x{0370}-\x{03ff}\x{0590}-\x{05ff}\x{0600}-\x{06ff}\x{0900}-\x{097f}\x{0e00}-\x{0e7f}]"
REFERENCE_HEADINGS = ["references", "bibliography", "参考文献"]
DROPPED_PREFIXES = ["acknowledgment", "acknowledgement", "appendix", "supplementary"]
HEADING_NUMBER = r"^\s*(?:\d+(?:\.\d+)*|[A-Z])\.?\s+"
SECTION_NUMBER = r"^\d+(?:\.\d+)*\s*"
NAMED_SECTIONS = ["abstract", "introduction", "conclusion"]
MARKS = "([.,;:?!])"
CITATIONS = [
    r"\[(?:\s*\d+\s*(?:[-,;]\s*\d+\s*)*)\]",
    r"\[\s*[A-Za-z][A-Za-z0-9:_./-]*\d+[A-Za-z0-9:_./-]*\s*\]",
    r"\[\s*[A-Za-z][A-Za-z0-9:_./-]*\d+[A-Za-z0-9:_./-]*(?:\s*[,;]\s*[A-Za-z][A-Za-z0-9:_./-]*\d+[A-Za-z0-9:_./-]*)+\s*\]",
    r"\((?:[A-Z][A-Za-z'`-]+(?:\s+et\s+al\.)?|\w+\s+and\s+\w+),?\s+\d{4}[a-z]?\)",
]
FLOAT_MENTION = r"\b(?:Table|Figure|Fig\.)\s+\d+(?:\.\d+)*:?"
MATH_SPAN = r"(\$\$.*?\$\$|\$[^$\n]+?\$)"
LATEX_ESCAPES = {"\\": r"\textbackslash{}", "&": r"\&", "%": r"\%", "$": r"\$", "#": r"\#", "_": r"\_", "{": r"\{", "}": r"\}", "~": r"\textasciitilde{}", "^": r"\textasciicircum{}"}
#: Characters beside the rule of :func:`traditional_characters`: ones it lacks, ones it must not hold.
TRADITIONAL_TOO = "兹壹夥後徵於鋈阪裏説綫啓僞衆麽鈎閲鋭録緑産顔鷄"
NOT_TRADITIONAL = "國並"


def normalize(text: Column) -> Column:
    """White-space runs become one space; ends are trimmed; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), ODD_RUN, " "))


def join_parts(*parts: Column) -> Column:
    """Non-empty normalised parts with a blank line between them."""
    return F.concat_ws("\n\n", *[F.nullif(normalize(p), F.lit("")) for p in parts])


def search_form(text: Column) -> Column:
    return F.lower(normalize(text))


def self_talk(text: Column) -> Column:
    hit = F.lit(False)
    for pattern in SELF_TALK:
        hit = hit | F.coalesce(text.rlike("(?iU)" + pattern), F.lit(False))
    return hit


def other_script(text: Column) -> Column:
    return F.coalesce(text.rlike(OTHER_SCRIPTS), F.lit(False))


@lru_cache
def traditional_characters() -> str:
    """Han characters of the Taiwanese standard set that the mainland's simplified set lacks.

    A rule instead of a table; callers with a list of their own pass it to the filters, see
    :func:`listed_characters`.
    """

    def held(ch: str, codec: str) -> bool:
        try:
            ch.encode(codec)
        except UnicodeEncodeError:
            return False
        return True

    found = (chr(c) for c in range(0x4E00, 0xA000) if held(chr(c), "big5") and not held(chr(c), "gb2312"))
    return "".join(sorted(set(found) - set(NOT_TRADITIONAL) | set(TRADITIONAL_TOO)))


def listed_characters(path: str) -> str:
    """The distinct characters of a UTF-8 file, white space aside, in its order: a list for the filters."""
    with open(path, encoding="utf-8") as file:
        return "".join(dict.fromkeys("".join(file.read().split())))


def traditional(text: Column, characters: str | None = None) -> Column:
    """Whether a traditional-only character occurs; ``translate`` is far cheaper than a regex class."""
    bare = F.translate(text, characters or traditional_characters(), "")
    return F.coalesce(F.length(bare) < F.length(text), F.lit(False))


def han_ratio(text: Column) -> Column:
    body = F.coalesce(text, F.lit(""))
    return F.when(F.length(body) == 0, F.lit(0.0)).otherwise(F.regexp_count(body, F.lit(HAN)) / F.length(body))


def simplified_target(text: Column, least_ratio: float = 0.2, characters: str | None = None) -> Column:
    body = normalize(text)
    return (han_ratio(body) >= least_ratio) & ~other_script(body) & ~traditional(body, characters)


def valid_pair(source: Column, target: Column, least_source: int = 12, least_target: int = 6, most_ratio: float = 8.0, characters: str | None = None) -> Column:
    """A translation pair worth keeping; cheap tests stand before dear ones."""
    s, t = normalize(source), normalize(target)
    longer, shorter = F.greatest(F.length(s), F.length(t)), F.least(F.length(s), F.length(t))
    return (F.length(s) >= least_source) & (F.length(t) >= least_target) & (longer <= most_ratio * shorter) & simplified_target(t, characters=characters) & ~self_talk(s) & ~self_talk(t)


def useful_english(text: Column, least: int = 80) -> Column:
    body = normalize(text)
    return (F.length(body) >= least) & (F.regexp_count(body, F.lit("[A-Za-z]")) >= 0.45 * F.length(body))


def has_math(text: Column) -> Column:
    return F.coalesce(text.contains("$"), F.lit(False))


def kept_paragraph(text: Column, least: int = 80) -> Column:
    return useful_english(text, least) | has_math(text)


def math_spans(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)" + MATH_SPAN), F.lit(1))


def clean_prose(text: Column) -> Column:
    """Text outside mathematics without citations and mentions of floats; spaces collapsed, ends kept."""
    out = text
    for pattern in CITATIONS:
        out = F.regexp_replace(out, "(?U)" + pattern, "")
    out = F.regexp_replace(out, "(?iU)" + FLOAT_MENTION, "")
    out = F.regexp_replace(out, SPACES + "+" + MARKS, "$1")
    return F.regexp_replace(out, SPACES + "+", " ")


def dropped_heading(heading: Column) -> Column:
    bare = F.lower(F.regexp_replace(F.trim(heading), HEADING_NUMBER, ""))
    hit = bare.isin(REFERENCE_HEADINGS)
    for prefix in DROPPED_PREFIXES:
        hit = hit | bare.startswith(prefix)
    return F.coalesce(hit, F.lit(False))


def section_name(heading: Column) -> Column:
    bare = F.regexp_replace(F.lower(F.trim(heading)), SECTION_NUMBER, "")
    slug = F.regexp_replace(F.regexp_replace(bare, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    named = [F.when(bare.contains(name), name) for name in NAMED_SECTIONS]
    return F.coalesce(*named, F.nullif(slug, F.lit("")), F.lit("body"))


def latex_escape(text: Column) -> Column:
    """One pass over the characters, so that escapes are not escaped again."""
    pairs = F.create_map(*[F.lit(x) for kv in LATEX_ESCAPES.items() for x in kv])
    return F.array_join(F.transform(F.split(text, ""), lambda ch: F.coalesce(F.try_element_at(pairs, ch), ch)), "")


def user_text(source: Column, user_message: Column) -> Column:
    """``source``, or else the user message after its first blank line."""
    return F.when(F.coalesce(source, F.lit("")) != "", source).otherwise(F.regexp_replace(F.coalesce(user_message, F.lit("")), r"(?s)^.*?\n\n", ""))


def sentences(text: Column) -> Column:
    """Trimmed non-empty sentences, split after ``.``, ``!`` or ``?`` and white space."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])" + SPACES + "+"), lambda s: F.trim(s)), lambda s: s != "")

"""Plain-Python twins of the text functions, for Arrow UDFs that cannot be said in Column terms."""

from __future__ import annotations

import html
import re

from quillmill.functions.text import CITATIONS, DROPPED_PREFIXES, FLOAT_MENTION, HEADING_NUMBER, MARKS, MATH_SPAN, NAMED_SECTIONS, REFERENCE_HEADINGS, SECTION_NUMBER

_math = re.compile(MATH_SPAN, re.DOTALL)
_cuts = [re.compile(p) for p in CITATIONS] + [re.compile(FLOAT_MENTION, re.IGNORECASE)]
_heading_number, _section_number = re.compile(HEADING_NUMBER), re.compile(SECTION_NUMBER)
_space_before_mark = re.compile(r"\s+" + MARKS)


def squeeze(text: str | None) -> str:
    return " ".join((text or "").split())


def spans(text: str) -> list[tuple[bool, str]]:
    """The text as (is mathematics, stretch) in order; stretches outside may be empty."""
    pieces = _math.split(text)
    return [(k % 2 == 1, piece) for k, piece in enumerate(pieces)]


def clean_prose(text: str) -> str:
    """As the column function of that name: ends keep one space where they had any."""
    for cut in _cuts:
        text = cut.sub("", text)
    text = _space_before_mark.sub(r"\1", text)
    words = text.split()
    if not words:
        return " " if text else ""
    return " " * text[0].isspace() + " ".join(words) + " " * text[-1].isspace()


def clean_text(text: str) -> str:
    """Unescaped; prose cleaned, mathematics untouched; ends stripped."""
    return "".join(piece if is_math else clean_prose(piece) for is_math, piece in spans(html.unescape(text))).strip()


def useful_english(text: str, least: int = 80) -> bool:
    body = squeeze(text)
    return len(body) >= least and len(re.findall("[A-Za-z]", body)) >= 0.45 * max(1, len(body))


def kept_paragraph(text: str, least: int = 80) -> bool:
    return "$" in text or useful_english(text, least)


def dropped_heading(heading: str) -> bool:
    bare = _heading_number.sub("", heading.strip(), count=1).lower()
    return bare in REFERENCE_HEADINGS or any(map(bare.startswith, DROPPED_PREFIXES))


def section_name(heading: str) -> str:
    bare = _section_number.sub("", heading.strip().lower(), count=1)
    slug = "_".join(re.findall("[a-z0-9]+", bare))
    return next((name for name in NAMED_SECTIONS if name in bare), slug or "body")

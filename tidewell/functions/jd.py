"""The job-description score as a function of a string, for use inside page functions."""

from __future__ import annotations

import re

from tidewell.functions import textscore as t


def pattern(patterns):
    """Any of the patterns as whole words; group 1 is what was found."""
    return re.compile(t.whole_words(patterns).replace("(?iu)", "").replace(r"[\p{L}\p{N}_]", r"\w"), re.I)


_HEADINGS, _LABELS, _APPLY, _READER = map(pattern, (t.HEADINGS, t.LABELS, t.APPLY, t.READER))
_EQUAL, _CLOSED = re.compile(t.any_of(t.EQUAL), re.I), re.compile(t.any_of(t.CLOSED), re.I)


def score(text: str, items: int = 0) -> float:
    """As textscore.jd_score."""
    if not text:
        return 0.0
    distinct = lambda p: len({m.lower() for m in p.findall(text)})
    applies = len(_APPLY.findall(text))
    bullets = max(items, len(re.findall(r"(?:^|\s)[•●▪‣⁃\-*]\s+\S", text)))
    return (
        min(len(text) / 1500, 2.0)
        + 0.8 * min(distinct(_HEADINGS), 5)
        + (1 <= applies <= 3)
        - 2 * (applies >= 6)
        + 0.4 * min(distinct(_LABELS), 4)
        + bool(_EQUAL.search(text))
        + (len(_READER.findall(text)) >= 3)
        + (bullets >= 4)
        - 4 * bool(_CLOSED.search(text[:3000]))
    )


def is_closed(text: str) -> bool:
    """As textscore.is_closed."""
    return bool(_CLOSED.search(text[:3000]))

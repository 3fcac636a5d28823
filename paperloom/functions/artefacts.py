"""Text artefacts in Python, for readers that open files themselves. Same formats as the column functions in text.py."""

from __future__ import annotations

import re

from paperloom.model import END_MARK, BEGIN_MARK, FOOTER_LINE

_BEGIN, _END, _FOOTER = (re.compile(p, re.IGNORECASE | re.MULTILINE) for p in (BEGIN_MARK, END_MARK, FOOTER_LINE))


def body(text: str) -> str:
    """What stands between the marks, stripped; without both marks the text as it is."""
    begin = _BEGIN.search(text)
    end = begin and _END.search(text, begin.end())
    return text[begin.end() : end.start()].strip() if end else text


def pages(text: str) -> list[tuple[int, str]]:
    """(page number, stripped text) of each page, in order; a footer ends its page and what follows the last is dropped."""
    out, at = [], 0
    text = body(text).replace("\r\n", "\n")
    for footer in _FOOTER.finditer(text):
        out.append((int(footer[1]), text[at : footer.start()].strip()))
        at = footer.end()
    return out

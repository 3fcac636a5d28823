"""Prompts for the vision model. Only the word NONE is read by the engine."""

from __future__ import annotations

VERSION = "1"

_TEXT = """Transcribe the page image.
Answer with the page's text and nothing else: no JSON, no code fences, no page numbers, no summary, no translation.
Keep paragraphs, numbering, units and symbols as they stand; write [ILLEGIBLE] for what can't be read.
"""

_FIGURES = """Look for figures, diagrams and technical drawings on the page image; leave out tables, text, logos and decoration.
Describe each in two to four sentences, in the language of the page, with its position first: "- (pos: top|middle|bottom) ...".
Say only what can be seen. If the page has no figure, answer exactly:
NONE
"""


def text_prompt(extra: str | None = "") -> str:
    extra = (extra or "").strip()
    return _TEXT + (f"\nAdditional instructions:\n{extra}\n" if extra else "")


def figures_prompt() -> str:
    return _FIGURES

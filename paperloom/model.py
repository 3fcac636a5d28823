"""Schemas, settings and fixed formats of the ingestion engine."""

from __future__ import annotations

from dataclasses import dataclass

# The white space of text handling, labels, modes and the page artefact's marks.
WS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0            "
    "    　"
)
WS_CLASS = r"\x09-\x0d\x1c-\x20\x85\xa0  -     　"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
TEXT_PDF, SCANNED_PDF, MIXED = "TEXT_PDF", "SCANNED_PDF", "MIXED_OR_UNKNOWN"
LABELS = (TEXT_PDF, SCANNED_PDF, MIXED)
AUTO, LAYER, VISION = "auto", "pypdf", "vlm"
MODES = (AUTO, LAYER, VISION)
BEGIN_LINE = "\n" + "=" * 20 + " BEGIN TEXT " + "=" * 20 + "\n\n"
END_LINE = "\n" + "=" * 21 + " END TEXT " + "=" * 21 + "\n"
FOOTER_LINE = rf"^[{WS_CLASS}]*---[{WS_CLASS}]*PAGE[{WS_CLASS}]+(\d+)[{WS_CLASS}]*---[{WS_CLASS}]*$"
FOOTER = "(?imdU)" + FOOTER_LINE
_MARK = rf"^[={WS_CLASS}]*{{0}}[{WS_CLASS}]+TEXT[{WS_CLASS}]*[={WS_CLASS}]*$"
BEGIN_MARK, END_MARK = _MARK.format("BEGIN"), _MARK.format("END")
BODY = rf"(?imdsU)(?>{BEGIN_MARK})(.*?){END_MARK}"
SOURCE_LINE = rf"(?imdU)^[{WS_CLASS}]*SOURCE[{WS_CLASS}]+PDF:[{WS_CLASS}]*(.+)[{WS_CLASS}]*$"
COLLECTION_NAME = r"[A-Za-z][A-Za-z0-9_$#]*"

PAGES = "doc STRING, page_no INT, text STRING"
SIGNALS = "doc STRING, page_idx INT, text STRING, has_image BOOLEAN"
IMAGES = "doc STRING, page_no INT, width INT, height INT, image BINARY"
CHUNKS = "text STRING, source_name STRING, page_label STRING, chunk_index INT, metadata MAP<STRING,STRING>"
COLLECTION = "id STRING, text STRING, metadata STRING, embedding ARRAY<FLOAT>"
TOKENS = "request_id STRING, seq INT, content STRING, add_kw STRING, resp_meta STRING"


def model_parameters(model_id: str, temperature: float = 0.0, max_tokens: int = 8000) -> dict[str, float]:
    """What a model is called with; the limit of output tokens has the name that its provider takes (functions.text.token_limit_name)."""
    provider = model_id.strip().split(".", 1)[0].strip().lower() if "." in (model_id or "") else ""
    limit = {"openai": "max_completion_tokens", "gemini": "max_output_tokens"}.get(provider, "max_tokens")
    return {"temperature": temperature, limit: max_tokens}


@dataclass(frozen=True)
class ClassifyConfig:
    sample_pages: int = 10
    min_text_chars_doc: int = 200
    min_text_chars_page: int = 50
    scanned_ratio: float = 0.6
    strong_text_chars: int = 5000


@dataclass(frozen=True)
class ExtractConfig:
    model_id: str = "google.gemini-2.5-pro"
    dpi: int = 200
    max_pages: int | None = None
    save_images: bool = False
    images_dir: str | None = None
    mode: str = AUTO
    #: Type of all documents; None takes each document's own label column.
    pdf_type: str | None = None
    min_text_chars_page: int = 50
    extra_prompt: str = ""
    white_threshold: int = 245
    min_nonwhite_ratio: float = 0.01
    center_crop: bool = True
    max_side: int = 1600
    jpeg_quality: int = 85
    blank_placeholder: str = "[BLANK PAGE SKIPPED]"
    describe_figures: bool = False

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if self.pdf_type is not None and self.pdf_type not in LABELS:
            raise ValueError(f"pdf_type must be one of {LABELS}")

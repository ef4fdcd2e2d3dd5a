"""Text expressions: key building, error-text cleanup, prompt templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's templates.
INSTRUCTION_MARKER = "### Instruction:"
RESPONSE_MARKER = "### Response:"
DEFAULT_EOS = "<|endoftext|>"
BLANK_MESSAGE_WARNING = "\u26a0\ufe0f Please enter a valid question."
UNKNOWN_ERROR = "Unknown"

# The characters Python's str.strip() removes (str.isspace), as a
# regex class both Java and RE2 read.
PY_WHITESPACE = ("[\\x{9}-\\x{d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
                 "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
_STRIP_CLASS = PY_WHITESPACE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def concat_strict(*cols) -> Column:
    """CONCAT that is NULL when any part is NULL (Snowflake rule)."""
    return F.concat(*[_c(c).cast("string") for c in cols])


def concat_lenient(*cols) -> Column:
    """CONCAT that reads NULL parts as '' (T-SQL rule)."""
    return F.concat_ws("", *[_c(c).cast("string") for c in cols])


def date_text(c) -> Column:
    """FORMAT(x, 'yyyy-MM-dd') / TO_CHAR(x, 'yyyy-MM-dd'). A cast through DATE:
    for TIMESTAMP_NTZ no time zone is involved."""
    return _c(c).cast("date").cast("string")


def datetime_text(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a TIMESTAMP_NTZ, zone-free (fractions dropped)."""
    return F.substring(_c(c).cast("timestamp_ntz").cast("string"), 1, 19)


def normalise_error_text(c) -> Column:
    """``CASE WHEN COALESCE(msg,'Unknown') = ' ' THEN 'Unknown' ELSE msg END``
    under T-SQL comparison (trailing blanks ignored): '' and all-blank text become
    'Unknown', NULL stays NULL."""
    msg = _c(c)
    return F.when(F.rtrim(msg) == "", F.lit(UNKNOWN_ERROR)).otherwise(msg)


def python_strip(c) -> Column:
    """Python ``str.strip()`` for ASCII whitespace (Spark ``trim`` only drops blanks)."""
    return F.regexp_replace(_c(c), f"^{_STRIP_CLASS}+|{_STRIP_CLASS}+$", "")


def training_text(prompt, response, eos: str = DEFAULT_EOS) -> Column:
    """``### Instruction: {prompt}\\n### Response: {response}{eos}``; NULL when
    either side is NULL (callers reject those rows)."""
    return F.concat(F.lit(INSTRUCTION_MARKER + " "), _c(prompt), F.lit("\n" + RESPONSE_MARKER + " "),
                    _c(response), F.lit(eos))


def is_blank(c) -> Column:
    """Absent, empty or whitespace-only text."""
    return python_strip(F.coalesce(_c(c), F.lit(""))) == ""


def inference_prompt(message) -> Column:
    """``### Instruction: {message}\n### Response:``; NULL for a blank or absent
    message, which gets ``blank_message_reply`` instead of a generation."""
    msg = _c(message)
    return F.when(is_blank(msg), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(INSTRUCTION_MARKER + " "), msg, F.lit("\n" + RESPONSE_MARKER)))


def blank_message_reply(message) -> Column:
    """The fixed warning for a blank message, NULL otherwise."""
    return F.when(is_blank(message), F.lit(BLANK_MESSAGE_WARNING))


def extract_response(text) -> Column:
    """Text after the last response marker, stripped; the whole text, not
    stripped, when the marker is absent."""
    t = _c(text)
    after_last = F.element_at(F.split(t, F.lit(RESPONSE_MARKER.replace("#", "\\#")), -1), -1)
    return F.when(F.instr(t, RESPONSE_MARKER) > 0, python_strip(after_last)).otherwise(t)

"""Expressions over raw feed frames and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeloom.schemas import WIRE_MESSAGE


def parse_message(value: Column | str) -> Column:
    """The message struct of a JSON text; permissive, so bad fields become null."""
    return F.from_json(value, WIRE_MESSAGE)


def frame_elements(text: Column) -> Column:
    """A frame parsed as the first of two array elements, the second being `frame_end`.

    `from_json` alone stops at the end of the first object and would accept junk after it.
    Here a frame is one whole JSON object only if the second element is reached. That
    element names the digest of the frame, so no frame can hold it and end the array early.
    """
    return F.from_json(
        F.concat(F.lit("["), text, F.lit(',{"type":"'), frame_end(text), F.lit('"}]')),
        "array<struct<type:string>>",
        {"allowSingleQuotes": "false"},
    )


def frame_end(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def is_frame(value: Column | str, message_type: str) -> Column:
    """Whether a text is exactly one well-formed JSON object of the given type.

    One comparison, so the text is parsed once.
    """
    text = value if isinstance(value, Column) else F.col(value)
    wanted = F.array(*[F.struct(t.alias("type")) for t in (F.lit(message_type), frame_end(text))])
    # null-safe: a plain comparison adds a null check, which would parse once more
    return frame_elements(text).eqNullSafe(wanted)


def decode_utf8(value: Column | str, on_error: str = "raise") -> Column:
    """Bytes as text, refusing invalid UTF-8: fail the job ('raise') or give null ('null')."""
    text = (value if isinstance(value, Column) else F.col(value)).cast("string")
    if on_error == "raise":
        return F.validate_utf8(text)
    if on_error == "null":
        return F.try_validate_utf8(text)
    raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")

"""Where patterns match in a text, with DataFrame functions only.

All matches are marked in a copy of the text, the copy is split at the marks, and running
lengths of the parts give the places, in code points. The mark is a private-use character; in
the copy, one that the text already holds is first replaced by another of the same length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARK, _INSTEAD = "", ""
_BLOCK = 256
_NO_SPANS = "array<struct<start:int,stop:int,value:string,before:string>>"


def searchable(text: Column) -> Column:
    """The copy of a text to search; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _MARK, _INSTEAD)


def matches(searched: Column, pattern: str, hint: str | None = None, context: int = 0) -> Column:
    """Leftmost, non-overlapping matches as (start, stop, value, before), stop exclusive.

    `hint` is a string without which there can be no match; it saves the search. `before` is
    the end of what stands before the match, `context` characters long at most. It is
    carried along, as cutting it out of a long text for each match would walk the text again.
    """
    marked = F.regexp_replace(searched, pattern, f"{_MARK}$0{_MARK}")
    if hint is not None:
        marked = F.when(F.contains(searched, F.lit(hint)), marked).otherwise(F.lit(""))
    begin = F.struct(
        F.lit(0).alias("at"),
        F.lit(False).alias("inside"),
        F.lit("").alias("before"),
        F.array().cast(_NO_SPANS).alias("found"),
    )

    def step(so_far: Column, part: Column) -> Column:
        stop = so_far["at"] + F.length(part)
        before = so_far["before"]
        span = F.struct(
            so_far["at"].alias("start"), stop.alias("stop"), part.alias("value"), before.alias("before")
        )
        tail = F.right(F.concat(before, part), F.lit(context)) if context else before
        return F.struct(
            stop.alias("at"),
            (~so_far["inside"]).alias("inside"),
            tail.alias("before"),
            F.when(so_far["inside"], F.concat(so_far["found"], F.array(span)))
            .otherwise(so_far["found"])
            .alias("found"),
        )

    def walk(parts: Column) -> Column:
        """Block by block: an array that grows by one is copied, so none grows long."""
        blocks = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _BLOCK).cast("int"))
        none = F.array().cast(f"array<{_NO_SPANS}>")

        def block(so_far: Column, number: Column) -> Column:
            last = so_far["last"]
            carried = F.struct(
                last["at"].alias("at"),
                last["inside"].alias("inside"),
                last["before"].alias("before"),
                F.array().cast(_NO_SPANS).alias("found"),
            )
            own = F.aggregate(F.slice(parts, number * _BLOCK + 1, F.lit(_BLOCK)), carried, step)
            done = F.concat(so_far["done"], F.array(last["found"]))
            return F.struct(own.alias("last"), done.alias("done"))

        return F.aggregate(
            blocks,
            F.struct(begin.alias("last"), none.alias("done")),
            block,
            lambda end: F.flatten(F.concat(end["done"], F.array(end["last"]["found"]))),
        )

    # an array of one, so that the parts are a variable and not computed for every block
    return F.transform(F.array(F.split(marked, _MARK, -1)), walk)[0]


def labelled(found: Column, kind: str, order: int) -> Column:
    """The spans of one kind as (start, kind_order, kind, stop)."""
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("kind_order"),
            F.lit(kind).alias("kind"),
            s["stop"].alias("stop"),
        ),
    )


def joined(spans: Column) -> Column:
    """Spans as kind:start:stop, comma-joined in the order they have."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
        ),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


def redact(text: Column, spans: Column, instead: str) -> Column:
    """The text with each span, or run of overlapping spans, replaced. Spans come by start."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(so_far: Column, span: Column) -> Column:
        new = span["start"] >= so_far["at"]
        kept = F.substring(text, so_far["at"] + 1, span["start"] - so_far["at"])
        return F.struct(
            F.greatest(so_far["at"], span["stop"]).alias("at"),
            F.when(new, F.concat(so_far["out"], kept, F.lit(instead)))
            .otherwise(so_far["out"])
            .alias("out"),
        )

    return F.aggregate(
        spans, begin, step, lambda end: F.concat(end["out"], F.substring(text, end["at"] + 1, F.length(text)))
    )

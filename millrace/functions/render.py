"""Text forms of records, windows and matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.times import epoch_millis, plain_timestamp_text


# The patterns below must equal the known text forms.


def click_text(user: Column, ts: Column, url: Column) -> Column:
    return F.format_string("%s-%s-%s", user, plain_timestamp_text(ts), url)


def key_record_text(boy: Column, key: Column) -> Column:
    return F.format_string("%s:%s", boy, key)


def book_text(
    id_: Column, title: Column, author: Column, price: Column, qty: Column
) -> Column:
    return F.format_string("%d-%s-%s-%f-%d", id_, title, author, price, qty)


def window_range_text(start: Column, end: Column) -> Column:
    """Window bounds as epoch milliseconds."""
    return F.format_string("%d----%d", epoch_millis(start), epoch_millis(end))


def match_text(match: Column, stages: Sequence[str], fields: Sequence[str]) -> Column:
    """``stage=(field|field),...;...`` in stage order.

    ``match`` maps a stage name to the list of structs matched there.  A map has
    no order of its own, so the stage order is given.
    """

    def row(event: Column) -> Column:
        values = F.array(*[event[field].cast("string") for field in fields])
        return F.concat(F.lit("("), F.array_join(values, "|", "null"), F.lit(")"))

    parts = [
        F.concat(F.lit(f"{stage}="), F.array_join(F.transform(match[stage], row), ","))
        for stage in stages
    ]
    return F.concat_ws(";", *parts)

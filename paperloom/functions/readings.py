"""Reading typed values out of form text. Unreadable text gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Marks that stand in a cell but hold no value (lower case, trimmed).
NO_VALUE = (
    "null", "none", "n/a", "na", "unk", "unknown", "none given", "pending", "see narrative",
    "illegible", "[illegible]", "[blank]", "blank", "(torn)", "torn",
)
#: Month names as the form writes them.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTHS = "".join(MONTHS)
_DATE = r"^(\d{4})-(\d{1,2}|[A-Za-z]{3})-(\d{1,2})"
_CLOCK = r"(?:[ T]+(?:(\d{1,2}):(\d{2})(?::\d{2})?\s*([AaPp][Mm])?|(\d{2})(\d{2})\s*(?:hrs|hours)))?$"


def plain_text(text: Column) -> Column:
    """Trimmed text, or null where it is blank or a mark that holds no value."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(t.rlike(r"[\p{L}\p{N}]") & ~F.lower(t).isin(*NO_VALUE), t)


def whole_number(text: Column) -> Column:
    """An integer with optional #, thousands commas and a unit beside it; BIGINT or null."""
    digits = F.regexp_extract(text, r"^#?\s*(\d{1,3}(?:,\d{3})+|\d+)\s*[A-Za-z.]*$", 1)
    return F.nullif(F.regexp_replace(digits, ",", ""), F.lit("")).try_cast("bigint")


def truth_value(text: Column) -> Column:
    """yes/no, y/n, true/false in any case; BOOLEAN or null."""
    t = F.lower(text)
    return F.when(t.isin("yes", "y", "true"), True).when(t.isin("no", "n", "false"), False)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (keeps generated code small)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _year_first(text: Column) -> Column:
    """Rewrites 3/17/2015, 17-MAR-2015, 17 Mar 2015 and Mar 17, 2015 to year-month-day order."""
    t = F.regexp_replace(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2")
    t = F.regexp_replace(t, r"^(\d{1,2})[- ]([A-Za-z]{3})[a-z]*[- ](\d{4})", "$3-$2-$1")
    return F.regexp_replace(t, r"^([A-Za-z]{3})[a-z]*\.? (\d{1,2}), ?(\d{4})", "$3-$1-$2")


def _iso_day(t: Column) -> Column:
    month = F.regexp_extract(t, _DATE, 2)
    named = ((F.position(F.lower(month), F.lit(_MONTHS)) + 2) / 3).cast("int").cast("string")
    number = F.when(month.rlike(r"^\d"), month).otherwise(named)
    return F.concat_ws("-", F.regexp_extract(t, _DATE, 1), F.lpad(number, 2, "0"), F.lpad(F.regexp_extract(t, _DATE, 3), 2, "0"))


def day_value(text: Column) -> Column:
    """A calendar date in any of the four styles; impossible dates give null."""
    return _bind(_year_first(text), lambda t: F.when(t.rlike(_DATE + _CLOCK), _iso_day(t))).try_cast("date")


def moment_value(text: Column) -> Column:
    """A date with an optional time of day (12 or 24 hours, or '1310 hrs'); null if impossible.

    A date without a time counts as its midnight.
    """

    def build(t: Column) -> Column:
        g = lambda i: F.regexp_extract(t, _DATE + _CLOCK, i)
        hour = g(4).try_cast("int")
        half = F.upper(g(6))
        hour = F.when(half == "PM", hour % 12 + 12).when(half == "AM", hour % 12).otherwise(hour)
        clock = F.when(g(4) != "", F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), g(5))).when(
            g(7) != "", F.concat(g(7), F.lit(":"), g(8))
        )
        return F.when(t.rlike(_DATE + _CLOCK), F.concat(_iso_day(t), F.lit(" "), F.coalesce(clock, F.lit("00:00"))))

    return _bind(_year_first(text), build).try_cast("timestamp_ntz")


#: value_type of a form column -> (reader, Spark type of the wide column).
READERS = {
    "string": (lambda t: t, "string"),
    "int": (whole_number, "bigint"),
    "date": (day_value, "date"),
    "timestamp": (moment_value, "timestamp_ntz"),
    "boolean": (truth_value, "boolean"),
}


def canonical_reading(text: Column, value_type: Column) -> Column:
    """The value as canonical text (castable to its type), or null where it is unreadable."""

    def choose(t: Column) -> Column:
        out = None
        for kind, (read, _) in READERS.items():
            value = read(t).cast("string")
            out = F.when(value_type == kind, value) if out is None else out.when(value_type == kind, value)
        return out

    return _bind(plain_text(text), choose)

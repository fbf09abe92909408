"""String measures and edits as column expressions; Python only where no expression exists."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def trigrams(text: Column) -> Column:
    """Distinct trigrams of the words of a text (letters and digits in lower case), each word
    padded by two blanks before and one after. Null gives null, no word an empty array."""
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))
    ))
    return F.array_distinct(F.flatten(grams))


def set_similarity(a: Column, b: Column) -> Column:
    """Shared elements over all elements of two arrays of distinct elements; 0 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.coalesce(shared / F.nullif(F.size(a) + F.size(b) - shared, F.lit(0)), F.lit(0.0))


def round_even(value: Column, digits: int = 2) -> Column:
    """Round half to even on the double itself."""
    return F.rint(value * float(10**digits)) / float(10**digits)


def normalized_levenshtein(a: Column, b: Column) -> Column:
    """Edits over the longer length; 0 for equal texts, two empty ones included."""
    return F.when(a == b, 0.0).otherwise(F.levenshtein(a, b) / F.nullif(F.greatest(F.length(a), F.length(b)), F.lit(0)))


def osa(a: str | None, b: str | None) -> int | None:
    """Edits with swaps of neighbours as one edit, no stretch being edited twice."""
    if a is None or b is None:
        return None
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(rows[-1][j] + 1, row[j - 1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[-2][j - 2] + 1)
            row.append(best)
        rows.append(row)
    return rows[-1][-1]


def osa_below(a: Column, b: Column, limit: int) -> Column:
    """OSA distance under ``limit``. Levenshtein (never below OSA, at most twice it) decides
    nearly all pairs in the JVM; Python measures only those between."""

    def measure(x: pd.Series, y: pd.Series, undecided: pd.Series) -> pd.Series:
        return pd.Series([osa(p, q) < limit if u else None for p, q, u in zip(x, y, undecided)], dtype="boolean")

    lev = F.levenshtein(a, b)
    between = F.coalesce((F.abs(F.length(a) - F.length(b)) < limit) & (lev >= limit) & (lev <= 2 * (limit - 1)), F.lit(False))
    rest = F.pandas_udf(measure, "boolean")(F.when(between, a), b, between)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("boolean")).when(lev < limit, True).when(between, rest).otherwise(False)


def qgrams(text: Column, q: int) -> Column:
    """All runs of q characters; empty for shorter texts. The text is cut into characters once, so
    the work follows its length."""
    return F.when(F.length(text) >= q, bind([F.split(text, "")], lambda chars: F.transform(
        F.sequence(F.lit(1), F.size(chars) - (q - 1)), lambda i: F.array_join(F.slice(chars, i, q), "")
    ))).when(text.isNotNull(), F.expr("cast(array() as array<string>)"))


def bind(values: list[Column], body) -> Column:
    """``body(*values)`` with each value evaluated once, however often the body uses it."""
    packed = F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    return F.element_at(F.transform(F.array(packed), lambda s: body(*[s[f"v{i}"] for i in range(len(values))])), 1)


def qgram_jaccard_distance(a: Column, b: Column, q: int) -> Column:
    """1 - shared distinct q-grams over all; 1 where a text is shorter than q, 0 if both are equal."""
    measured = bind([F.array_distinct(qgrams(a, q)), F.array_distinct(qgrams(b, q))], lambda x, y: 1 - set_similarity(x, y))
    return F.when(a == b, 0.0).otherwise(measured)


def qgram_cosine_distance(a: Column, b: Column, q: int) -> Column:
    """1 - cosine of the q-gram counts; 1 where a text is shorter than q, 0 if both are equal.

    For single pairs; to compare many texts with a list, join on the grams instead.
    """
    def count(grams: Column, g: Column) -> Column:
        return F.size(F.filter(grams, lambda h: h == g)).cast("double")

    def squares(grams: Column) -> Column:
        # each occurrence of a gram adds its count, so the sum is that of the squared counts
        return F.aggregate(grams, F.lit(0.0), lambda s, g: s + count(grams, g))

    def measure(x: Column, y: Column) -> Column:
        dot = F.aggregate(x, F.lit(0.0), lambda s, g: s + count(y, g))
        return 1 - F.coalesce(dot / F.nullif(F.sqrt(squares(x) * squares(y)), F.lit(0.0)), F.lit(0.0))

    return F.when(a == b, 0.0).otherwise(bind([qgrams(a, q), qgrams(b, q)], measure))


def squish(text: Column) -> Column:
    """Trimmed, runs of white space as one blank."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without one."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def page_tail(filename: Column) -> tuple[Column, Column, Column]:
    """(original name, first page, last page) of a name ending -XXXX-XXXX.pdf."""
    stem = F.concat(F.substring(filename, F.lit(1), F.greatest(F.length(filename) - 14, F.lit(0))), F.lit(".pdf"))
    return stem, F.substring(filename, -13, 4).try_cast("int"), F.substring(filename, -8, 4).try_cast("int")


def bins(value: Column, edges: list[float]) -> Column:
    """Label of the half-open bin (a,b] that holds the value, the first closed on both sides;
    null outside and for null. An edge of None is infinite."""
    show = lambda e: "Inf" if e is None else f"{e:g}"
    out = None
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        first = i == 0 and low is not None
        above = F.lit(True) if low is None else (value >= low if first else value > low)
        below = F.lit(True) if high is None else value <= high
        label = f"{'[' if first else '('}{'-Inf' if low is None else show(low)},{show(high)}]"
        hit = value.isNotNull() & above & below
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def parallel_min(*values: Column) -> Column:
    """Least value, null if any is null."""
    missing = values[0].isNull()
    for v in values[1:]:
        missing = missing | v.isNull()
    return F.when(~missing, F.least(*values))


def parallel_max(*values: Column) -> Column:
    """Greatest value, null if any is null."""
    missing = values[0].isNull()
    for v in values[1:]:
        missing = missing | v.isNull()
    return F.when(~missing, F.greatest(*values))


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def line_key(page: Column, y: Column) -> Column:
    """A sortable key of a line: page on four digits, y on six with two decimals."""
    return F.concat(padded(page, 4), F.lit("-"), F.format_string("%06.2f", y.cast("double")))

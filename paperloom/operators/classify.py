"""Page classes by ordered fuzzy rules, and control numbers, as array expressions per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import normalized_levenshtein
from paperloom.operators.rules import HEAD_RULES, LEFT_RULES, TAIL_RULES
from paperloom.tables import spread


def kept_lines(text: Column) -> Column:
    """Lines with their line ends that hold three letters in a row; an unterminated last line
    'CITY OF CHICAGO' is left out. Null text gives null."""
    return F.filter(F.split(text, "(?<=\n)"), lambda x: x.rlike("[a-zA-Z]{3,}") & (x != "CITY OF CHICAGO"))


def _rule_array(rules) -> Column:
    return F.array(*[F.struct(F.lit(p.lower()).alias("p"), F.lit(c).alias("c")) for p, c in rules])


def _first_rule(lines: Column, rules) -> Column:
    """Class of the first rule that one of ``lines`` begins with, give or take .15 of its length."""
    def near(line: Column, p: Column) -> Column:
        # a line that is too short by itself needs no measuring
        long = F.length(line) > F.length(p) * 0.85
        return long & (normalized_levenshtein(F.lower(F.substring(line, F.lit(1), F.length(p))), p) < 0.15)

    def fits(r: Column) -> Column:
        return F.exists(lines, lambda line: near(line, r["p"]))

    return F.get(F.filter(_rule_array(rules), fits), F.lit(0))["c"]


def head_class(lines: Column) -> Column:
    return _first_rule(F.slice(lines, 1, 2), HEAD_RULES)


def tail_class(lines: Column) -> Column:
    return _first_rule(F.slice(lines, F.greatest(F.size(lines) - 1, F.lit(1)), 2), TAIL_RULES)


def left_margin_class(lines: Column, require_last: bool = False) -> Column:
    """Class of the first rule whose beginnings occur in order, each on a line of its own.

    By default the last beginning of a rule need not occur, as in the rules' source.
    """
    rules = F.array(*[
        F.struct(F.array(*[F.lit(x) for x in p]).alias("p"), F.lit(len(p) - (0 if require_last else 1)).alias("need"), F.lit(c).alias("c"))
        for p, c in LEFT_RULES
    ])

    def fits(r: Column) -> Column:
        def step(i: Column, line: Column) -> Column:
            want = F.get(r["p"], i)
            long = F.length(line) >= F.length(want) * 0.875
            near = normalized_levenshtein(F.substring(line, F.lit(1), F.length(want)), want) <= 0.125
            return F.when((i < r["need"]) & long & near, i + 1).otherwise(i)

        return F.aggregate(lines, F.lit(0), step) >= r["need"]

    return F.get(F.filter(rules, fits), F.lit(0))["c"]


def page_class(lines: Column, require_last: bool = False) -> Column:
    """Head, then tail, then left-margin rules; null for pages without kept lines."""
    return F.when(F.size(lines) > 0, F.coalesce(head_class(lines), tail_class(lines), left_margin_class(lines, require_last)))


def control_number(text: Column) -> Column:
    """The control number of the last line that holds one, null without."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x.rlike("CPD {0,2}00[0-3][0-9]{4,6}"))
    line = F.regexp_replace(F.try_element_at(lines, F.lit(-1)), "^.*CPD 00", "CPD 00")
    return F.array_join(F.slice(F.split(line, "[^CPD0-9]"), 1, 2), " ")


def classified_pages(pages: DataFrame, text: str = "text", require_last: bool = False) -> DataFrame:
    """``pages`` with head, tail, left_margin and page_class of their text."""
    rows = spread(pages).withColumn("_lines", kept_lines(F.col(text)))
    lines = F.col("_lines")
    some = F.size(lines) > 0
    rows = rows.withColumns({
        "head": F.when(some, head_class(lines)), "tail": F.when(some, tail_class(lines)), "left_margin": F.when(some, left_margin_class(lines, require_last)),
    })
    return rows.withColumn("page_class", F.coalesce("head", "tail", "left_margin")).drop("_lines")

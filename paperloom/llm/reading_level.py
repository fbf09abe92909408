"""Reading level of documents from the acquisition grades of their words.

Each word of the graded samples gets an acquisition grade: the grade by which a share KNOWN of
its smoothed use, over grades of equal weight, has been seen. A text is described by quantiles
of the grades of its known words, and a level is the nearest grade centre in quantile space,
where centres and the scale of each quantile come from the graded samples (calibration).

Defined results: texts with fewer words than asked for, null or empty texts have no level; a
text without any known word gets the grade of the prior (the commonest); ties go to the lower
grade; repeated rows are levelled each; an empty sample table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.tables import spread

#: Share of a word's use that is seen by its acquisition grade.
KNOWN = 0.5
#: Quantiles of the word grades that describe a text.
QUANTILES = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95)
#: Graded samples that may be brought to the driver; the table is fixed and small.
MOST_SAMPLES = 20_000
#: Samples a word must stand in.
LEAST_SAMPLES = 1
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


def level_words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class LevelModel:
    """Fitted on (grade, text) rows."""

    def __init__(self, rows: list[tuple[int, str]]):
        grades = sorted({g for g, _ in rows})
        self.grades = grades
        place = {g: i for i, g in enumerate(grades)}
        uses: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        totals = np.zeros(len(grades))
        for g, text in rows:
            words = level_words(text)
            totals[place[g]] += len(words)
            for w in words:
                uses.setdefault(w, np.zeros(len(grades)))[place[g]] += 1
            for w in set(words):
                texts[w] = texts.get(w, 0) + 1
        self.word_grade: dict[str, float] = {}
        for w, n in uses.items():
            if texts[w] < LEAST_SAMPLES:
                continue
            rate = n / np.maximum(totals, 1)
            seen = np.cumsum(rate) / rate.sum()
            at = int(np.searchsorted(seen, KNOWN))
            before = seen[at - 1] if at else 0.0
            part = (KNOWN - before) / (seen[at] - before)
            low = grades[at - 1] if at else grades[0] - 1
            self.word_grade[w] = low + part * (grades[at] - low)
        described = [(g, q) for g, text in rows if (q := self.quantiles(text)) is not None]
        self.centres, self.scale = None, None
        if described:
            x = np.array([q for _, q in described])
            y = np.array([g for g, _ in described])
            self.centres = np.array([x[y == g].mean(axis=0) if (y == g).any() else np.full(x.shape[1], np.inf) for g in grades])
            within = np.concatenate([x[y == g] - x[y == g].mean(axis=0) for g in grades if (y == g).any()])
            self.scale = within.std(axis=0) + 0.05
        self.prior = min(grades, key=lambda g: (-sum(1 for h, _ in rows if h == g), g)) if grades else None

    def quantiles(self, text: str | None):
        known = [g for w in level_words(text) if (g := self.word_grade.get(w)) is not None]
        return np.quantile(known, QUANTILES) if known else None

    def level(self, text: str | None) -> int | None:
        q = self.quantiles(text)
        if q is None or self.centres is None:
            return self.prior
        return self.grades[int(np.argmin((((self.centres - q) / self.scale) ** 2).sum(axis=1)))]


def reading_levels(documents: DataFrame, samples: DataFrame, least_words: int = 40, lang: str | None = "en") -> DataFrame:
    """doc_id, grade of each document of ``lang`` (exactly; None: any) with ``least_words`` words.

    Words are counted as runs of non-blanks. The graded samples (checked against MOST_SAMPLES)
    are fitted once on the driver; documents are read once and not shuffled.
    """
    rows = [(r["grade"], r["text"]) for r in samples.where("grade is not null and text is not null").select("grade", "text").limit(MOST_SAMPLES + 1).collect()]
    if len(rows) > MOST_SAMPLES:
        raise ValueError(f"more than {MOST_SAMPLES} graded samples")
    asked = documents.select("doc_id", "text", "lang") if lang is not None else documents.select("doc_id", "text")
    asked = asked.where(F.col("lang") == lang) if lang is not None else asked
    asked = asked.where(F.size(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")) >= least_words).select("doc_id", "text")
    if not rows:
        return asked.where(F.lit(False)).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(0).alias("grade"))
    model = documents.sparkSession.sparkContext.broadcast(LevelModel(rows))

    def grade(batches):
        m = model.value
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "grade": pd.Series([m.level(t) for t in batch["text"]], dtype="int32")})

    return spread(asked).mapInPandas(grade, "doc_id bigint, grade int")

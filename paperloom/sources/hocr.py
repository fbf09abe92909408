"""Words of hOCR pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import first_group
from paperloom.tables import spread


class _Words(HTMLParser):
    """Collects the words of a page with the ids of the elements around them."""

    LEVELS = {"ocr_page": "page", "ocr_carea": "block", "ocr_par": "par", "ocr_line": "line", "ocr_header": "line", "ocr_textfloat": "line", "ocr_caption": "line"}
    VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

    def __init__(self):
        super().__init__()
        self.around: list[tuple[str, str | None, str | None]] = []
        self.words: list[dict] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        if tag in self.VOID:
            return
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        level = next((self.LEVELS[c] for c in classes if c in self.LEVELS), None)
        self.around.append((tag, level, a.get("id")))
        if "ocrx_word" in classes:
            ids = {lv: i for _, lv, i in self.around if lv}
            self.words.append({"id": a.get("id"), "title": a.get("title"), "text": "", **ids})
            self.depth = len(self.around)

    def handle_endtag(self, tag):
        for i in range(len(self.around) - 1, -1, -1):
            if self.around[i][0] == tag:
                del self.around[i:]
                break
        if self.depth > len(self.around):
            self.depth = 0

    def handle_data(self, data):
        if self.depth and self.words:
            self.words[-1]["text"] += data


def parsed_words(xml: str | None) -> list[dict]:
    """Words of one page; malformed markup gives what can be read of it."""
    if not xml:
        return []
    reader = _Words()
    reader.feed(xml)
    return reader.words


def trailing_number(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d+)$", 1).try_cast("int")


def keyed_title(title: Column, key: str) -> Column:
    """Value of a key of a title such as 'bbox 1 2 3 4; x_wconf 95', null without it."""
    return F.trim(first_group(title, rf"(^|\s+){key}([^;]+)(;|$)", 2))


def hocr_words(pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys..., page_id, block_id, paragraph_id, line_id, word_id, text, x0, y0, x1, y1, conf, sz.

    ``pages`` has ``xml``. A box needs four numbers of at most four digits; else it is null, as
    are ids without a trailing number, missing confidences and sizes.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches):
        for batch in batches:
            rows = []
            for row in zip(*[batch[k] for k in keys], batch["xml"]):
                rows += [(*row[:-1], w.get("page"), w.get("block"), w.get("par"), w.get("line"), w["id"], w["title"], w["text"]) for w in parsed_words(row[-1])]
            yield pd.DataFrame(rows, columns=[*keys, "_page", "_block", "_par", "_line", "_id", "_title", "_text"])

    raw = spread(pages.select(*keys, "xml")).mapInPandas(
        run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", _page string, _block string, _par string, _line string, _id string, _title string, _text string"
    )
    box = F.split(F.trim(F.regexp_replace(F.regexp_extract("_title", r"bbox ([0-9]{1,4}(\s|;|$)){4}", 0), "[^0-9 ]", "")), r"\s+")
    at = lambda i: F.get(box, F.lit(i)).try_cast("int")
    conf = F.coalesce(keyed_title(F.col("_title"), "x_wconf").try_cast("double"), F.lit(None))
    return raw.select(
        *keys, trailing_number(F.col("_page")).alias("page_id"), trailing_number(F.col("_block")).alias("block_id"), trailing_number(F.col("_par")).alias("paragraph_id"),
        trailing_number(F.col("_line")).alias("line_id"), trailing_number(F.col("_id")).alias("word_id"), F.trim("_text").alias("text"),
        at(0).alias("x0"), at(1).alias("y0"), at(2).alias("x1"), at(3).alias("y1"), conf.alias("conf"), keyed_title(F.col("_title"), "x_size").try_cast("double").alias("sz"),
    )


def in_inches(words: DataFrame, dpi: int = 300) -> DataFrame:
    return words.withColumns({c: F.col(c) / float(dpi) for c in ("x0", "y0", "x1", "y1")})

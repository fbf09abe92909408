"""Evaluation passages inside corpus texts, copied or with changed slots.

Words are runs of letters and digits in lower case. Numbers, names and units are slots: their
place in a template holds a typed placeholder. Windows of WINDOW template words of items and
documents are hashed and joined on the hash; the slots of joined windows are compared word by
word: all equal is a copy, a one-to-one change of slots throughout the window is a
re-parameterised passage. Before the join a bit map of the items' hashes, of fixed size however
many items there are, spares the shuffle of nearly all document windows that match nothing.

Defined results: null, empty and short texts match nothing; repeated rows match once each id;
items shorter than a window can't leak; empty tables give empty results.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import written
from paperloom.tables import spread

#: Successive words that make a leak.
WINDOW = 12
#: Names learned from the items go to every worker as 64-bit hashes: 8 MB at most, an error beyond.
MOST_NAMES = 1_000_000
#: Bits of the map of item hashes (2 MB); with more items more windows pass it, none is lost.
BITS = 1 << 24
#: Units that stand beside numbers.
UNITS = frozenset("mm cm m km in ft yd mi mg g kg oz lb lbs ml l gal sec secs second seconds min mins minute minutes hour hours hr hrs day days week weeks month months year years percent mph usd dollars cents am pm".split())
_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _raw_words(text: str | None) -> list[str]:
    return _WORD.findall(text) if text else []


def _hash(word: str) -> int:
    h = 1469598103934665603
    for b in word.encode():
        h = ((h ^ b) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return h


def _window_hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of each run of WINDOW codes (wrapping 64-bit arithmetic)."""
    n = len(codes) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            out = out * _BASE + (codes[k : k + n] ^ (codes[k : k + n] >> np.uint64(29))) * _MIX
    return out


class Templates:
    """Template codes of words; ``names`` is a sorted array of the hashes of names."""

    def __init__(self, names: np.ndarray):
        self.names = names
        self.code: dict[str, int] = {}

    def kind(self, word: str) -> str:
        """The typed placeholder of a number, unit or name, else the word."""
        if any(c.isdigit() for c in word):
            return "\x01num"
        if word in UNITS:
            return "\x01unit"
        at = np.searchsorted(self.names, np.uint64(_hash(word))) if len(self.names) else 0
        return "\x01name" if at < len(self.names) and self.names[at] == np.uint64(_hash(word)) else word

    def codes(self, words: list[str]) -> np.ndarray:
        code = self.code
        out = []
        for w in words:
            c = code.get(w)
            if c is None:
                c = _hash(self.kind(w))
                if len(code) < 500_000:
                    code[w] = c
            out.append(c)
        return np.array(out, np.uint64)

    def compared(self, own: list[str], theirs: list[str]) -> tuple[bool, bool]:
        """(equal, equal up to slots changed one to one) of two windows."""
        if own == theirs:
            return True, True
        same = all(a == b or (self.kind(a)[0] == "\x01" and self.kind(a) == self.kind(b)) for a, b in zip(own, theirs))
        return False, same and len(set(zip(own, theirs))) == len(set(own)) == len(set(theirs))


def item_names(items: DataFrame) -> np.ndarray:
    """Hashes, sorted, of the words that the items always write with a capital, also where no text begins."""

    def cases(batches):
        for batch in batches:
            got = [(raw.lower(), raw[:1].isupper() and raw.lower() != raw and i > 0) for text in batch["text"] for i, raw in enumerate(_raw_words(text))]
            yield pd.DataFrame(got, columns=["word", "cap"])

    words = items.select("text").mapInPandas(cases, "word string, cap boolean").groupBy("word").agg(F.min("cap").alias("always"))
    rows = words.where("always").select("word").limit(MOST_NAMES + 1).collect()
    if len(rows) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names in the evaluation items: split them and unite the results")
    return np.array(sorted({_hash(r["word"]) for r in rows}), np.uint64)


def template_windows(texts: DataFrame, id_column: str, names: np.ndarray, bits: np.ndarray | None = None) -> DataFrame:
    """h, id, w: the windows of each text with the hash of their template and their words joined by
    blanks; with ``bits`` only those whose hash is on the map."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast((names, bits))

    def cut(batches):
        names, bits = shared.value
        templates = Templates(names)
        for batch in batches:
            hashes, ids, windows = [], [], []
            for key, text in zip(batch[id_column], batch["text"]):
                words = words_of(text)
                h = _window_hashes(templates.codes(words))
                at = np.arange(len(h)) if bits is None else np.nonzero(bits[(h >> np.uint64(6)) % np.uint64(len(bits))] >> (h & np.uint64(63)) & np.uint64(1))[0]
                hashes += h.view(np.int64)[at].tolist()
                ids += [key] * len(at)
                windows += [" ".join(words[i : i + WINDOW]) for i in at.tolist()]
            yield pd.DataFrame({"h": np.array(hashes, np.int64), "id": np.array(ids, np.int64), "w": np.array(windows, object)})

    return texts.select(id_column, "text").where(F.col(id_column).isNotNull()).mapInPandas(cut, "h bigint, id bigint, w string")


def hash_map(windows: DataFrame) -> np.ndarray:
    """The bits of all hashes: at most BITS / 64 longs come to the driver."""
    cells = BITS // 64
    # as an unsigned number: the upper 58 bits of the hash choose the long, the lower six its bit
    cell = F.pmod(F.shiftrightunsigned("h", 6), F.lit(cells)).cast("int")
    rows = windows.groupBy(cell.alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("mask")).collect()
    bits = np.zeros(cells, np.uint64)
    if rows:
        bits[np.array([r["cell"] for r in rows])] = np.array([r["mask"] for r in rows], np.int64).view(np.uint64)
    return bits


def leaked_windows(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, exact_windows, changed_windows of every document that holds item windows.

    Windows of repeated passages count each time. The corpus is read once; what is shuffled are
    its windows on the map and the items' windows.
    """
    names = item_names(items)
    theirs = written(template_windows(items, "item_id", names))
    own = written(template_windows(spread(documents.select("doc_id", "text")), "doc_id", names, hash_map(theirs)))
    # the same window of several items, or several times of one document, meets once
    met = own.groupBy("h", "w").agg(F.count(F.lit(1)).alias("n")).select("h", F.col("w").alias("a")).join(theirs.select("h", F.col("w").alias("b")).distinct(), "h")
    shared = documents.sparkSession.sparkContext.broadcast(names)

    def compare(batches):
        templates = Templates(shared.value)
        for batch in batches:
            got = [(a, b, *templates.compared(a.split(" "), b.split(" "))) for a, b in zip(batch["a"], batch["b"])]
            got = [(a, b, int(exact), int(changed and not exact)) for a, b, exact, changed in got if changed]
            yield pd.DataFrame(got, columns=["a", "b", "exact", "changed"])

    told = written(met.select("a", "b").mapInPandas(compare, "a string, b string, exact int, changed int"))
    mine = own.select(F.col("id").alias("doc_id"), F.col("w").alias("a")).groupBy("doc_id", "a").agg(F.count(F.lit(1)).alias("n"))
    of_items = theirs.select(F.col("id").alias("item_id"), F.col("w").alias("b")).groupBy("item_id", "b").agg(F.count(F.lit(1)).alias("m"))
    times = F.col("n") * F.col("m")
    return mine.join(told, "a").join(of_items, "b").groupBy("doc_id", "item_id").agg(
        F.sum(F.col("exact") * times).cast("int").alias("exact_windows"), F.sum(F.col("changed") * times).cast("int").alias("changed_windows")
    )


def leaks_found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id (distinct): the text holds WINDOW successive words of the item."""
    return leaked_windows(documents, items).where("exact_windows > 0").select("doc_id", "item_id").distinct()

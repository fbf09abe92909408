"""Near-duplicate statements with small edits, by b-bit MinHash.

Words are runs of letters and digits in lower case. A pair counts when at least SHARE of the
runs of three successive words of the longer text, with repeats, also stand in the other.

Texts of equal words are one class. Each class representative gets ROWS x BANDS minima over its
set of word triples; bands of ROWS minima give candidates; of every minimum one low bit is kept
and the bits are packed into a signature; candidates whose signatures agree in too few bits,
after correction for bits that agree by chance, are dropped; the rest is checked exactly. A
share of 0.7 of a longer text without repeated triples means a Jaccard similarity of at least
0.7 / 1.3 = 0.538, at which 80 bands of 4 miss a pair with probability 0.0009; the bit filter
stands four standard deviations below it. Where a share d of the longer text's triples are
distinct, the least similarity is (d - 0.3) / 1.3: 0.5 at d = LEAST_DISTINCT, missed by bands or bits
with probability 0.007 at worst. Texts below LEAST_DISTINCT get their candidates exactly: a partner may
miss 0.3 of the text, so of the rarest triples that make up half of it it must hold the rest.

Defined results: null texts and texts under LEAST_WORDS words never count; of equally long
texts either may be the longer one; copies share a class; empty tables give empty results;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.form_keys import resolve_cells
from paperloom.operators.pairs import unequal_pairs
from paperloom.session import written
from paperloom.tables import spread

SHARE, LEAST_WORDS, RUN = 0.7, 32, 3
ROWS, BANDS = 4, 80
#: Share of distinct triples below which a text's partners are looked for exactly.
LEAST_DISTINCT = 0.95
#: Bits of the map of such texts' triples (2 MB); with more of them more triples pass it, none is lost.
BITS = 1 << 24
#: Members from which a bucket is cut into blocks that are compared pair of blocks by pair.
BLOCK = 256
#: The statement columns of the form.
STATEMENTS = (
    ("Accused Members", "Initial / Intake Allegation"),
    ("Current Allegations", "Allegation"),
    ("Incident Finding / Overall Case Finding", "Description of Incident"),
)
_LONGS = (ROWS * BANDS + 63) // 64


def statements(cells: DataFrame, pdfs: DataFrame, form: DataFrame) -> DataFrame:
    """row_id, file, words (joined by blanks), n_words of the statement rows long enough to count."""
    rows = resolve_cells(cells, pdfs, form, ["row_id", "text"])
    wanted = None
    for section, column in STATEMENTS:
        hit = (F.col("section_name") == section) & (F.col("column_name") == column)
        wanted = hit if wanted is None else wanted | hit
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return (
        rows.where(wanted & F.col("text").isNotNull())
        .select("row_id", F.col("pdf_name").alias("file"), words.alias("w"))
        .where(F.size("w") >= LEAST_WORDS)
        .select("row_id", "file", F.array_join("w", " ").alias("words"), F.size("w").alias("n_words"))
    )


def text_classes(rows: DataFrame) -> DataFrame:
    """``rows`` with cid, equal for equal words (a 64-bit hash of the words and their mirror)."""
    return rows.withColumn("cid", F.xxhash64("words", F.reverse("words")))


class Sketcher:
    """Band keys and the packed one-bit signature of a text's set of word triples."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        k = ROWS * BANDS
        self.a = rng.integers(1, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, k, dtype=np.uint64)
        self.mix = rng.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = np.arange(1, BANDS + 1, dtype=np.uint64)
        self.word: dict[str, int] = {}

    def _codes(self, words: list[str]) -> np.ndarray:
        import xxhash

        known, out = self.word, []
        for w in words:
            c = known.get(w)
            if c is None:
                c = xxhash.xxh64_intdigest(w)
                if len(known) < 300_000:
                    known[w] = c
            out.append(c)
        return np.array(out, np.uint64)

    def triples(self, text: str) -> np.ndarray:
        """Hashes of the runs of three successive words, with repeats."""
        c, m = self._codes(text.split(" ")), self.mix
        with np.errstate(over="ignore"):
            h = c[:-2] * m[0] + c[1:-1] * m[1] + c[2:] * m[2]
            h ^= h >> np.uint64(31)
            return h * m[3]

    def sketch(self, triples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys and signature of a text's distinct triples."""
        h, m = triples, self.mix
        with np.errstate(over="ignore"):
            v = h[None, :] * self.a[:, None] + self.b[:, None]
            v ^= v >> np.uint64(29)
            minima = (v * m[4]).min(axis=1)
            low = ((minima ^ (minima >> np.uint64(33))) * m[5]) >> np.uint64(63)
            parts = minima.reshape(BANDS, ROWS)
            key = self.band * m[6]
            for r in range(ROWS):
                key = (key ^ parts[:, r]) * m[7]
                key ^= key >> np.uint64(32)
        bits = np.zeros(_LONGS * 64, np.uint8)
        bits[: ROWS * BANDS] = low
        return key.view(np.int64), np.packbits(bits).view(">i8").astype(np.int64)


def sketches(reps: DataFrame) -> DataFrame:
    """cid, keys (array of BANDS longs), sig (array of longs) of each representative; of texts with many
    repeats also repeated: their distinct triples, and times: how often each stands there."""

    def run(batches):
        s = Sketcher()
        for batch in batches:
            keys, sigs, repeated, times = [], [], [], []
            for text in batch["words"]:
                all_of = s.triples(text)
                h, n = np.unique(all_of, return_counts=True)
                k, g = s.sketch(h)
                low = len(h) < LEAST_DISTINCT * len(all_of)
                keys.append(k)
                sigs.append(g)
                repeated.append(h.view(np.int64) if low else None)
                times.append(n if low else None)
            yield pd.DataFrame({"cid": batch["cid"], "keys": keys, "sig": sigs, "repeated": repeated, "times": times})

    return spread(reps.select("cid", "words")).mapInPandas(run, "cid bigint, keys array<bigint>, sig array<bigint>, repeated array<bigint>, times array<bigint>")


def exact_candidates(reps: DataFrame, sk: DataFrame) -> DataFrame:
    """cid_a < cid_b (distinct): every text that can hold SHARE of a longer text with many repeats."""
    low = sk.where("repeated is not null").select("cid", F.inline(F.arrays_zip("repeated", "times")).alias("t", "w"))
    none = low.select(F.col("cid").alias("cid_a"), F.col("cid").alias("cid_b")).where(F.lit(False))
    cells = BITS // 64
    cell = F.pmod(F.shiftrightunsigned("t", 6), F.lit(cells)).cast("int")
    marked = low.groupBy(cell.alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(t & 63 as int))")).alias("mask")).collect()
    if not marked:
        return none
    bits = np.zeros(cells, np.uint64)
    bits[np.array([r["cell"] for r in marked])] = np.array([r["mask"] for r in marked], np.int64).view(np.uint64)
    shared = reps.sparkSession.sparkContext.broadcast(bits)

    def held(batches):
        s, bits = Sketcher(), shared.value
        for batch in batches:
            found, sizes = [], []
            for text in batch["words"]:
                h = s.triples(text)
                sizes.append(len(h))
                h = h[(bits[(h >> np.uint64(6)) % np.uint64(len(bits))] >> (h & np.uint64(63)) & np.uint64(1)) > 0]
                found.append(np.unique(h).view(np.int64))
            yield pd.DataFrame({"cid_b": batch["cid"], "ts": found, "size": np.array(sizes, np.int32)})

    others = written(spread(reps.select("cid", "words")).mapInPandas(held, "cid_b bigint, ts array<bigint>, size int"))
    others = others.select("cid_b", "size", F.explode("ts").alias("t"))
    often = others.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    own = Window.partitionBy("cid")
    ranked = low.join(often, "t").withColumns({"m": F.sum("w").over(own), "through": F.sum("w").over(own.orderBy("df", "t"))})
    rare = ranked.where(F.col("through") - F.col("w") <= 0.5 * F.col("m")).withColumn("held", F.sum("w").over(own)).select("cid", "t", "w", "m", "held")
    met = rare.join(others, "t").where((F.col("cid") != F.col("cid_b")) & (F.col("size") <= F.col("m")))
    # a partner misses at most 1 - SHARE of the text, so it holds the rest of its rarer half
    enough = met.groupBy("cid", "cid_b", "m", "held").agg(F.sum("w").alias("got")).where(F.col("got") >= F.col("held") - (1 - SHARE) * F.col("m") - 1e-9)
    return enough.select(F.least("cid", "cid_b").alias("cid_a"), F.greatest("cid", "cid_b").alias("cid_b")).distinct()


def least_agreeing_bits(share: float = SHARE) -> int:
    """Agreeing bits that a pair at the least Jaccard similarity of ``share`` falls short of by
    four standard deviations: p = J + (1 - J) / 2 for bits that agree by chance."""
    k = ROWS * BANDS
    p = (1 + share / (2 - share)) / 2
    return int(k * p - 4 * (k * p * (1 - p)) ** 0.5)


def candidates(sk: DataFrame) -> DataFrame:
    """cid_a < cid_b (distinct): pairs of a common band whose signatures agree well enough.

    Only keys with two members go on. A hot bucket is cut into blocks by a hash of the member,
    and each pair of blocks is a group of its own, so no task holds a whole hot bucket.
    """
    rows = sk.select("cid", "sig", F.explode("keys").alias("key"))
    sizes = sk.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.join(sizes, "key").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", "cid", "sig", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    a, b = rows.alias("a"), rows.alias("b")
    differing = None
    for i in range(_LONGS):
        n = F.bit_count(F.col("a.sig")[i].bitwiseXOR(F.col("b.sig")[i]))
        differing = n if differing is None else differing + n
    most = ROWS * BANDS - least_agreeing_bits()
    on = (
        (F.col("a.key") == F.col("b.key")) & (F.col("a.lo") == F.col("b.lo")) & (F.col("a.hi") == F.col("b.hi"))
        & (F.col("a.cid") < F.col("b.cid"))
        & ((F.col("a.lo") == F.col("a.hi")) | (F.col("a.own") != F.col("b.own")))
        & (differing <= most)
    )
    return a.join(b, on).select(F.col("a.cid").alias("cid_a"), F.col("b.cid").alias("cid_b")).distinct()


def share_of_longer(a: list[str], b: list[str]) -> float:
    """Of the word triples of the longer text, with repeats, the share that stand in the other."""
    if len(a) < len(b):
        a, b = b, a
    there = set(zip(b, b[1:], b[2:]))
    runs = list(zip(a, a[1:], a[2:]))
    got = sum(r in there for r in runs) / len(runs)
    if len(a) == len(b):
        back = set(runs)
        other = list(zip(b, b[1:], b[2:]))
        got = max(got, sum(r in back for r in other) / len(other))
    return got


def similar_classes(reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """cid_a, cid_b, share of the pairs that hold by exact count."""
    t = reps.select("cid", "words")
    both = pairs.join(t.select(F.col("cid").alias("cid_a"), F.col("words").alias("wa")), "cid_a").join(
        t.select(F.col("cid").alias("cid_b"), F.col("words").alias("wb")), "cid_b"
    )

    def check(batches):
        for batch in batches:
            got = [
                (x, y, s) for x, y, p, q in zip(batch["cid_a"], batch["cid_b"], batch["wa"], batch["wb"])
                if (s := share_of_longer(p.split(" "), q.split(" "))) >= SHARE
            ]
            yield pd.DataFrame(got, columns=["cid_a", "cid_b", "share"])

    return both.select("cid_a", "cid_b", "wa", "wb").mapInPandas(check, "cid_a bigint, cid_b bigint, share double")


def class_links(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: row_id, file, cid; links: cid_a, cid_b, share) of statement rows."""
    classed = written(text_classes(rows))
    reps = written(classed.groupBy("cid").agg(F.first("words").alias("words")))
    sk = written(sketches(reps))
    links = similar_classes(reps, written(candidates(sk).unionByName(exact_candidates(reps, sk)).distinct()))
    return classed.select("row_id", "file", "cid"), links


def near_copies(cells: DataFrame, pdfs: DataFrame, form: DataFrame) -> DataFrame:
    """row_id_a < row_id_b of different files whose statements repeat each other."""
    members, links = class_links(statements(cells, pdfs, form))
    links = written(links)
    a = members.select(F.col("row_id").alias("ra"), F.col("file").alias("fa"), F.col("cid").alias("cid_a"))
    b = members.select(F.col("row_id").alias("rb"), F.col("file").alias("fb"), F.col("cid").alias("cid_b"))
    linked = links.select("cid_a", "cid_b").join(a, "cid_a").join(b, "cid_b").where("fa <> fb")
    names = ("row_id_a", "row_id_b")
    unequal = linked.select(F.least("ra", "rb").cast("bigint").alias(names[0]), F.greatest("ra", "rb").cast("bigint").alias(names[1]))
    return unequal.unionByName(unequal_pairs(members, "cid", "file", "row_id", names)).distinct()


def copy_classes(cells: DataFrame, pdfs: DataFrame, form: DataFrame) -> DataFrame:
    """row_id, class_id (smallest row of equal words), links: the number of other classes it
    repeats. One row per statement; copies are not expanded into pairs."""
    members, links = class_links(statements(cells, pdfs, form))
    links = written(links)
    ends = links.select(F.explode(F.array("cid_a", "cid_b")).alias("cid")).groupBy("cid").agg(F.count(F.lit(1)).alias("links"))
    names = members.groupBy("cid").agg(F.min("row_id").alias("class_id")).join(ends, "cid", "left")
    return members.join(names, "cid").select(
        F.col("row_id").cast("bigint").alias("row_id"), F.col("class_id").cast("bigint").alias("class_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links")
    )

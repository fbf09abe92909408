"""Exact byte-pair ids of every text by per-prefix dynamic programming.

A pre-token's encoding is built left to right: for every prefix the last token of its one
correct encoding is found among the vocabulary entries that end there (all matches of an
automaton over the bytes), as the entry whose previous token, stored for the shorter prefix,
is pair-compatible with it. Following the stored tokens back gives the ids. Two tokens are
compatible if merging their joined bytes from scratch yields just these two.

Defined results: an empty or null text has an empty list of ids; blank texts, stray Unicode
and very long texts are encoded like any other, wholly.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from paperloom.tables import spread

#: Default folder of the public vocabulary files.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pattern that cuts a text into pre-tokens before any merge.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens remembered in each Python worker; beyond it they are encoded anew.
REMEMBERED = 200_000


class PrefixEncoder:
    """Encodes pre-tokens with a rank file (base64 token, rank) as ids."""

    def __init__(self, rank_file: str):
        import ahocorasick
        import regex

        with open(rank_file, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes_of = {rank: token for token, rank in self.rank.items()}
        self.cut = regex.compile(PRETOKEN)
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.compatible = lru_cache(maxsize=1_000_000)(self._compatible)
        self.alone = lru_cache(maxsize=200_000)(self._alone)
        self.known: dict[str, list[int]] = {}

    def merged(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first; used on the few bytes of a pair of tokens only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.rank[p] for p in parts]

    def _alone(self, token: int) -> bool:
        return self.merged(self.bytes_of[token]) == [token]

    def _compatible(self, left: int, right: int) -> bool:
        return self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]

    def pretoken_ids(self, piece: str) -> list[int]:
        data = piece.encode("utf-8")
        whole = self.rank.get(data)
        if whole is not None and self.alone(whole):
            return [whole]
        ends: list[list[tuple[int, int]]] = [[] for _ in range(len(data) + 1)]
        for end, hit in self.automaton.iter(data.decode("latin-1")):
            ends[end + 1].append(hit)
        last = [-1] * (len(data) + 1)
        start_of = [0] * (len(data) + 1)
        for end in range(1, len(data) + 1):
            for token, size in ends[end]:
                start = end - size
                fits = self.alone(token) if start == 0 else last[start] >= 0 and self.alone(token) and self.compatible(last[start], token)
                if fits:
                    last[end], start_of[end] = token, start
                    break
        out, at = [], len(data)
        while at > 0:
            out.append(last[at])
            at = start_of[at]
        return out[::-1]

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, out = self.known, []
        for piece in self.cut.findall(text):
            got = known.get(piece)
            if got is None:
                got = self.pretoken_ids(piece)
                if len(known) < REMEMBERED and len(piece) <= 64:
                    known[piece] = got
            out += got
        return out


@lru_cache(maxsize=2)
def _encoder(rank_file: str) -> PrefixEncoder:
    return PrefixEncoder(rank_file)


def token_ids(documents: DataFrame, rank_file: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) of every row of ``documents``, repeated rows included.

    Row by row without a shuffle but one: few large input files are spread over the cores
    first. ``rank_file`` is a rank file on the driver's machine; it goes to the executors with the job.
    """
    rank_file = rank_file or os.path.join(TOKENIZERS, "byte_bpe_50k.tiktoken")
    documents.sparkSession.sparkContext.addFile(rank_file)
    name = os.path.basename(rank_file)

    def encode(batches):
        encoder = _encoder(SparkFiles.get(name))
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": [encoder.ids(t) for t in batch["text"]]})

    kind = dict(documents.dtypes)["doc_id"]
    return spread(documents.select("doc_id", "text")).mapInPandas(encode, f"doc_id {kind}, ids array<int>")

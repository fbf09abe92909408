"""Personal information in free text by a skip-chain conditional random field.

A text is a sequence of blank-parted tokens (a token broken over a line end is one), each
labelled plain, name, email, phone, idnum or address. Unary potentials are linear in hashed
features of a token (word, affixes, shapes, kind) and of its neighbours, chain potentials in
pairs of labels. Proper words of one text that are spelled alike, up to confusable glyphs, share
a skip potential, and loopy sum-product message passing brings their labels into line, so that
a bare surname takes the label its full mention earned. All three are fitted together by
pseudo-likelihood: the label of each token given those of its neighbours in the chain and on its
skip edges. Words of a token and of its neighbours are left out at random while fitting, so that
a form is also known where its surroundings are new. Runs of one label are stretches; their ends
are set to the exact form of their kind.

The texts come without labels. A bounded sample is labelled by structure alone, never by the
sentence around it: formats of addresses, numbers and mail; labels such as SSN before a number;
titles, initials and comma order, from which given names and surnames of the sample are
learned, for names. Tokens the rules leave open take no part in fitting.

Defined results: null and empty texts hold nothing and stay as they are; repeated rows are
found once (results are distinct); stretches never overlap; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.page_noise import GLYPHS, STROKES
from paperloom.tables import spread

#: Texts that the model is fitted on at most (the first by a hash of id and text).
MOST_TRAINING = 1500
#: A word is a name if at least one in so many of its capitalised uses follows a title in its place.
LEAST_TITLED = 20
#: Rounds of message passing.
ROUNDS = 6
LABELS = ("plain", "name", "email", "phone", "idnum", "address")
_L = len(LABELS)
#: Tokens whose potentials a worker remembers.
_REMEMBERED = 400_000

#: Titles before names, suffixes behind them, street directions and types, unit words.
TITLES = frozenset("officer off detective det sergeant sgt lieutenant lt captain capt commander mr mrs ms miss dr agent investigator".split())
SUFFIXES = frozenset("jr sr ii iii iv".split())
_DIR = r"(?:N|S|E|W|(?:No|NO)(?!\.?\s*\d{4})|So|SO|North|South|East|West|NORTH|SOUTH|EAST|WEST)\b\.?"
_TYPE = r"(?i:avenue|ave|av|boulevard|blvd|bl|court|ct|drive|dr|parkway|pkwy|pky|place|pl|road|rd|street|str|st|lane|ln|terrace|ter)\b\.?"
_UNIT = r"(?:(?i:apt|apartment|unit|ste|suite|fl|floor|rm)\b\.?\s+#?\w+|\#\s?\w+)"
_STREET = r"(?:\d{1,3}(?:st|nd|rd|th|ST|ND|RD|TH)|\d{1,2}(?=\s)|[A-Z][\w€@|+ƒ]*(?:-[A-Z]\w*)?)"
_TOWN = r"[A-Z][\w€@|+ƒ]+(?:\s+[A-Z][\w€@|+ƒ]+)?"
ADDRESS = re.compile(
    rf"(?<![\w-])\d{{1,6}}\s+(?P<d1>{_DIR}\s+)?{_STREET}(?P<type>\s+{_TYPE})?(?P<d2>\s+{_DIR})?(?P<u1>,?\s+{_UNIT})?(?:,?\s+(?!{_DIR}\s){_TOWN}(?P<zip>,?\s+\d{{5}}(?![\w-]))?)?(?P<u2>,?\s+{_UNIT})?"
)
EMAIL = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|(?<![\w.+-])[\w.+-]+\s+(?i:at)\s+[\w-]+(?:\s+(?i:dot)\s+[\w-]+)+")
PHONE = re.compile(
    r"(?<![\w.-])(?:\+?1[\s.-]?)?(?:\(\d{3}\)\s*|\d{3}[\s.-])\d{3}[\s.-]\d{4}(?:\s+(?i:ext|x)\.?\s*\d+)?(?![\w-])"
    r"|(?<![\w.-])(?:\d{10}|\d{3}[.-]\d{4})(?:\s+(?i:ext|x)\.?\s*\d+)?(?![\w-])"
)
_IDCUE = re.compile(
    r"(?:SSN|(?i:social\s+security)(?:\s+(?i:number|no\.?))?|(?i:driver['’]?s?\s+licen[cs]e)(?:\s+(?i:number|no\.?))?|(?i:state\s+id)(?:\s+(?i:number|no\.?))?|(?i:passport)(?:\s+(?i:number|no\.?))?)[\s:#]+"
    r"(\d{3}[\s-]\d{2}[\s-]\d{4}|[A-Za-z]?\d[\w-]{5,})"
)
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
IDNUM = re.compile(r"(?<![\w-])(?:\d{3}[\s-]\d{2}[\s-]\d{4}|[A-Za-z]?\d[\w-]{4,}\w)(?![\w-])")
_TOKEN = re.compile(r"\S*[\w][-­¬]\s*\n\s*(?=[\w€@|+])\S+|\S+")
_BROKEN = re.compile(r"[-­¬]\s*\n\s*")
_EDGES = ".,;:!?()\"'[]“”"
_INITIAL = re.compile(r"[A-Z]\.?")
_UNKNOWN = -1


def tokens_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def _core(token: str) -> str:
    """The token without punctuation around it, put together over a line end, without 's."""
    core = (_BROKEN.sub("", token) if "\n" in token else token).strip(_EDGES)
    return core[:-2] if core.endswith(("'s", "’s")) else core


def _skeleton(low: str) -> str:
    for glyph, strokes in STROKES:
        low = low.replace(glyph, strokes)
    return low.translate(str.maketrans(*GLYPHS))


def word_cases(texts: list[str]) -> tuple[Counter, Counter]:
    """How often each word stands in lower case, and how often with a capital."""
    low, high = Counter(), Counter()
    for text in texts:
        for token in text.split():
            core = token.strip(_EDGES)
            if core.isalpha():
                (low if core.islower() else high)[core.lower()] += 1
    return low, high


class Labeller:
    """Labels of training tokens by structure; names are learned from titles and comma order."""

    def __init__(self, texts: list[str]):
        low, high = word_cases(texts)
        #: words written in lower case at least a quarter as often as with a capital
        self.common = frozenset(w for w, n in low.items() if 4 * n >= high[w])
        given, family = Counter(), Counter()
        for text in texts:
            cores = self._cores(text)
            for i, (core, end) in enumerate(cores[:-1]):
                if self._title(core) and (body := self._body(cores, i + 1)):
                    family[cores[body[2]][0].lower()] += 1
                    if body[1] is not None and len(cores[body[1]][0]) > 2:
                        given[cores[body[1]][0].lower()] += 1
        # a word that seldom follows a title stood there by accident
        self.given = {w for w, n in given.items() if n * LEAST_TITLED >= high[w]}
        self.family = {w for w, n in family.items() if n * LEAST_TITLED >= high[w]}

    def _cores(self, text: str) -> list[tuple[str, str]]:
        """Core and the punctuation behind it, of each token."""
        tokens = [text[a:b] for a, b in tokens_of(text)]
        return [(_core(t), t.rstrip("'s’")[-1:] if not t[-1:].isalnum() else "") for t in tokens]

    def _title(self, core: str) -> bool:
        return core[:1].isupper() and core.lower() in TITLES

    def _proper(self, core: str) -> bool:
        return len(core) > 2 and core[0].isupper() and core[1].isalpha() and core.lower() not in self.common and core.lower() not in TITLES

    def _body(self, cores: list[tuple[str, str]], i: int):
        """(end, given, family) as token places of the name that begins at token i, or None."""
        n = len(cores)

        def initial(k: int) -> bool:
            return k < n and bool(_INITIAL.fullmatch(cores[k][0])) and cores[k][1] in (".", "")

        def proper(k: int) -> bool:
            return k < n and self._proper(cores[k][0])

        def suffixed(k: int) -> int:
            return k + 1 if k < n and cores[k][0].lower() in SUFFIXES else k

        if not (proper(i) or initial(i)):
            return None
        if proper(i) and cores[i][1] == "," and (proper(i + 1) or initial(i + 1)):
            end = i + 2
            if initial(end) and cores[i + 1][1] in ("", "."):
                end += 1
            return suffixed(end), i + 1, i
        if cores[i][1] in ("", ".") and (cores[i][1] == "" or initial(i)):
            at = i + 1
            if initial(at):
                at += 1
            if proper(at):
                return suffixed(at + 1), i, at
        return (i + 1, None, i) if proper(i) else None

    def labels(self, text: str) -> list[int]:
        spans = tokens_of(text)
        out = [0] * len(spans)

        def mark(start: int, end: int, label: int) -> None:
            inside = [i for i, (a, b) in enumerate(spans) if a < end and start < b]
            if inside and not any(out[i] for i in inside):
                for i in inside:
                    out[i] = label

        for m in EMAIL.finditer(text):
            mark(m.start(), m.end(), 2)
        for m in _IDCUE.finditer(text):
            mark(m.start(1), m.end(1), 4)
        for m in _SSN.finditer(text):
            mark(m.start(), m.end(), 4)
        for m in PHONE.finditer(text):
            mark(m.start(), m.end(), 3)
        for m in ADDRESS.finditer(text):
            # a number and a street alone may be anything
            mark(m.start(), m.end(), 5 if any(m[k] for k in ("d1", "type", "d2", "u1", "zip", "u2")) else _UNKNOWN)
        cores = self._cores(text)
        named: set[str] = set()
        i = 0
        while i < len(cores):
            body = self._body(cores, i)
            if body is None or any(out[i : body[0]]):
                i += 1
                continue
            end, given, family = body
            low = cores[family][0].lower()
            titled = i > 0 and self._title(cores[i - 1][0])
            called = given is not None and cores[given][0].lower().rstrip(".") or ""
            sure = titled or called in self.given or (
                len(called) == 1 and (called not in "nsew" or low in self.family)
            )
            if not sure:
                i += 1
                continue
            for k in range(i, end):
                out[k] = 1
            named.add(_skeleton(low))
            i = end
        for k, (core, _) in enumerate(cores):
            if not out[k] and self._proper(core):
                low = core.lower()
                out[k] = 1 if _skeleton(low) in named else _UNKNOWN if low in self.family or low in self.given else 0
        return out


def _h(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass"))


def _shape(core: str) -> str:
    s = re.sub(r"[A-ZÀ-Þ]", "X", core)
    s = re.sub(r"[a-zß-ÿ]", "x", s)
    return re.sub(r"\d", "9", s)


#: Kinds of tokens; pairs of neighbouring kinds have potentials of their own.
_KINDS = ("other", "lower", "opening", "proper", "capitals", "initial", "title", "suffix", "number", "mixed", "mail", "type")
_TYPES = re.compile(_TYPE + "|" + _DIR)
#: Features of a token itself (the first is its word) and reach of those of its neighbours.
_OWN, _REACH = 10, 3
_OFFSETS = [o for o in range(-_REACH, _REACH + 1) if o]


class Featurizer:
    """Feature ids of distinct tokens: _OWN of the token itself, then word and shape for each of
    the places it can have beside another token. Tokens are numbered as they come."""

    def __init__(self, common: frozenset[str], rows: dict[int, int] | None = None):
        self.common = common
        #: Row of each feature's hash; grown while fitting. Row 0 stands for what is unknown or left out.
        self.rows, self.grows = ({}, True) if rows is None else (rows, False)
        self.number: dict[str, int] = {}
        self.ids: list[list[int]] = []
        self.kinds: list[int] = []
        self.keys: list[str] = []

    def row(self, feature: str) -> int:
        h = _h(feature)
        return self.rows.setdefault(h, len(self.rows) + 1) if self.grows else self.rows.get(h, 0)

    def beside(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each kind with the kind before it, and with the kind behind it (or no token)."""
        n = range(len(_KINDS) + 1)
        return tuple(np.array([[self.row(f"{side}{a}.{b}") for b in n] for a in n]) for side in "qr")

    def _kind(self, core: str, low: str) -> str:
        if "@" in core[1:-1] and "." in core:
            return "mail"
        if low in TITLES and core[:1].isupper():
            return "title"
        if low in SUFFIXES and core[:1].isupper():
            return "suffix"
        if _TYPES.fullmatch(core) and core[:1].isupper() and len(core) > 1:
            return "type"
        if _INITIAL.fullmatch(core):
            return "initial"
        if any(c.isdigit() for c in core) and sum(c.isalpha() for c in core) < 3:
            return "mixed" if any(c.isalpha() for c in core) else "number"
        if not core[:1].isalpha():
            return "other"
        if core[0].islower():
            return "lower"
        if low in self.common:
            return "opening"
        return "capitals" if core.isupper() and len(core) > 1 else "proper"

    def place(self, token: str) -> int:
        at = self.number.get(token)
        if at is None:
            core = _core(token)
            low = core.lower()
            shape = _shape(core)
            brief = re.sub(r"(.)\1+", r"\1", shape)[:16]
            kind = self._kind(core, low)
            big = kind in ("proper", "capitals")
            last = token[-1:] if token[-1:] in ".,;:!?" else ""
            own = [
                "w" + low, "s" + re.sub(r"(X{3})X+|(x{2})x+", r"\1\2", shape)[:18], "b" + brief, f"3{big}{low[-3:]}", f"4{big}{low[-4:]}", f"p{big}{low[:3]}", "k" + kind,
                f"e{last}{kind}", f"o{token[:1] == '('}{'@' in core}", f"d{sum(c.isdigit() for c in core)}{brief[:1]}",
            ]
            beside = [f"{o}{x}" for o in _OFFSETS for x in ("w" + low, f"{brief if kind in ('number', 'mixed') else kind}{last}")]
            at = len(self.ids)
            self.ids.append([self.row(x) for x in own + beside])
            self.kinds.append(_KINDS.index(kind))
            self.keys.append(_skeleton(low) if kind in ("proper", "capitals") and len(low) >= 4 else "")
            self.number[token] = at
        return at


class SkipChain:
    """Weights of the field; ``fit`` on texts, ``labels`` of texts."""

    def __init__(self, seed: int = 3):
        self.weights = np.zeros((1, _L), np.float32)
        self.chain = np.zeros((_L + 1, _L + 1))  # the last label is unknown
        self.skip = np.zeros((_L + 1, _L + 1))
        self.features = Featurizer(frozenset(), {})
        self.before, self.behind = self.features.beside()
        self.seed = seed

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("weights", "chain", "skip", "seed")} | {"common": self.features.common, "rows": self.features.rows}

    def __setstate__(self, state):
        self.__init__(state["seed"])
        self.weights, self.chain, self.skip = state["weights"], state["chain"], state["skip"]
        self.features = Featurizer(state["common"], state["rows"])
        self.before, self.behind = self.features.beside()

    def _laid_out(self, texts: list[list[str]]):
        """(number of each token, its document, kinds before and behind with an end mark)."""
        place = self.features.place
        at = np.array([place(t) for tokens in texts for t in tokens], np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        kinds = np.array(self.features.kinds, np.int64)[at] if len(at) else at
        end = len(_KINDS)
        same = doc[1:] == doc[:-1]
        before, behind = np.full(len(at), end), np.full(len(at), end)
        before[1:][same] = kinds[:-1][same]
        behind[:-1][same] = kinds[1:][same]
        return at, doc, kinds, before, behind

    def _skips(self, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Pairs of tokens of one text with one key, each with the one before it."""
        keys = self.features.keys
        keyed = np.array([bool(k) for k in keys], bool)
        seen: dict[tuple[int, str], int] = {}
        out = []
        for i in np.nonzero(keyed[at])[0].tolist() if len(at) else []:
            k = (doc[i], keys[at[i]])
            if k in seen:
                out.append((seen[k], i))
            seen[k] = i
        return np.array(out, np.int64).reshape(-1, 2)

    def fit(self, texts: list[str], epochs: int = 4, rate: float = 0.15) -> "SkipChain":
        labeller = Labeller(texts)
        self.features = Featurizer(labeller.common)
        docs = [[t[a:b] for a, b in tokens_of(t)] for t in texts]
        y = np.array([k for t in texts for k in labeller.labels(t)], np.int64)
        if not (y >= 0).any():
            return self
        at, doc, kinds, before, behind = self._laid_out(docs)
        self.before, self.behind = self.features.beside()
        n, ids = len(at), np.array(self.features.ids, np.int32)
        x = np.zeros((n, _OWN + 2 * len(_OFFSETS) + 2), np.int32)
        x[:, :_OWN] = ids[at, :_OWN]
        for k, o in enumerate(_OFFSETS):
            there = np.arange(n) + o
            inside = (there >= 0) & (there < n)
            inside[inside] = doc[there[inside]] == doc[inside]
            x[inside, _OWN + 2 * k] = ids[at[there[inside]], _OWN + 2 * k]
            x[inside, _OWN + 2 * k + 1] = ids[at[there[inside]], _OWN + 2 * k + 1]
        x[:, -2], x[:, -1] = self.before[before, kinds], self.behind[kinds, behind]
        self.weights = np.zeros((len(self.features.rows) + 1, _L), np.float32)
        # what only these texts may have: words, affixes, and all but the kind of the next tokens
        worded = np.array([0, 3, 4, 5] + [_OWN + 2 * k + j for k, o in enumerate(_OFFSETS) for j in (0, 1) if j == 0 or abs(o) > 1])
        # labels on the chain and skip edges of each token; unknown ones are the last label
        known = np.where(y >= 0, y, _L)
        sides = np.full((n, 4), _L)
        same = doc[1:] == doc[:-1]
        sides[1:, 0][same], sides[:-1, 1][same] = known[:-1][same], known[1:][same]
        skips = self._skips(at, doc)
        if len(skips):
            sides[skips[:, 1], 2], sides[skips[:, 0], 3] = known[skips[:, 0]], known[skips[:, 1]]
        rng = np.random.default_rng(self.seed)
        square = np.full(self.weights.shape, 1e-2, np.float32)
        square_chain, square_skip = np.full(self.chain.shape, 1e-2), np.full(self.skip.shape, 1e-2)
        eye = np.eye(_L, dtype=np.float32)
        keyed = sides[:, 2:].min(axis=1) < _L
        kept = np.nonzero((y > 0) | ((y == 0) & (keyed | (rng.random(n) < 0.5))))[0]
        for _ in range(epochs):
            order = rng.permutation(kept)
            for i in range(0, len(order), 256):
                rows = order[i : i + 256]
                f, side = x[rows], sides[rows]
                # every third token keeps its words, every third half of them, every third none
                share = rng.integers(0, 3, (len(rows), 1)) / 2
                f[:, worded] = np.where(rng.random((len(rows), len(worded))) < share, 0, f[:, worded])
                side[:, :2] = np.where(rng.random((len(rows), 1)) < 0.5, _L, side[:, :2])
                side[:, 2:] = np.where(rng.random((len(rows), 1)) < 0.25, _L, side[:, 2:])
                pair = self.chain[side[:, 0], :_L] + self.chain[:_L, side[:, 1]].T + self.skip[side[:, 2], :_L] + self.skip[side[:, 3], :_L]
                score = self.weights[f].sum(axis=1) + pair
                p = np.exp(score - score.max(axis=1, keepdims=True))
                g = (p / p.sum(axis=1, keepdims=True) - eye[y[rows]]).astype(np.float32)
                uniq, back = np.unique(f, return_inverse=True)
                back, total = back.reshape(f.shape), np.empty((len(uniq), _L), np.float32)
                for label in range(_L):
                    total[:, label] = np.bincount(back.ravel(), np.repeat(g[:, label], f.shape[1]), len(uniq))
                square[uniq] += total**2
                self.weights[uniq] -= rate * total / np.sqrt(square[uniq])
                self.weights[0] = 0
                for table, squares, ends in ((self.chain, square_chain, ((0, False), (1, True))), (self.skip, square_skip, ((2, False), (3, False)))):
                    grad = np.zeros_like(table)
                    for column, turned in ends:
                        part = np.zeros_like(table)
                        np.add.at(part[:, :_L], side[:, column], g)
                        grad += part.T if turned else part
                    grad = grad + grad.T if table is self.skip else grad
                    grad[_L, :] = grad[:, _L] = 0
                    squares += grad**2
                    table -= rate * grad / np.sqrt(squares)
        self.features.grows = False
        return self

    def _potentials(self) -> tuple[np.ndarray, np.ndarray]:
        """Unary potentials of all tokens numbered so far: their own, and what they add to a token
        at each offset. Computed for new tokens only."""
        done = getattr(self, "_own", None)
        have = len(done) if done is not None else 0
        if have < len(self.features.ids):
            w = self.weights[np.array(self.features.ids[have:], np.int32)]
            own = w[:, :_OWN].sum(axis=1)
            beside = w[:, _OWN:].reshape(len(w), len(_OFFSETS), 2, _L).sum(axis=2)
            self._own = own if done is None else np.concatenate([done, own])
            self._beside = beside if done is None else np.concatenate([self._beside, beside])
        return self._own, self._beside

    def marginals(self, docs: list[list[str]]) -> np.ndarray:
        """Label probabilities of all tokens by loopy message passing over chain and skip edges."""
        if len(self.features.ids) > _REMEMBERED:
            self.features = Featurizer(self.features.common, self.features.rows)
            self._own = None
        at, doc, kinds, before, behind = self._laid_out(docs)
        n = len(at)
        if not n:
            return np.empty((0, _L))
        own, beside = self._potentials()
        unary = own[at] + self.weights[self.before[before, kinds]] + self.weights[self.behind[kinds, behind]]
        for k, o in enumerate(_OFFSETS):
            here, there = (slice(-o, n), slice(0, n + o)) if o < 0 else (slice(0, n - o), slice(o, n))
            if abs(o) < n:
                unary[here] += np.where((doc[here] == doc[there])[:, None], beside[at[there], k], 0)
        unary = unary.astype(np.float64)
        unary -= unary.max(axis=1, keepdims=True)
        p = np.exp(unary)
        p /= p.sum(axis=1, keepdims=True)
        sure = p[:, 0] > 0.9999
        left = np.nonzero((doc[:-1] == doc[1:]) & ~(sure[:-1] & sure[1:]))[0]
        skip = self._skips(at, doc)
        skip = skip[~(sure[skip[:, 0]] & sure[skip[:, 1]])]
        a, b = np.concatenate([left, skip[:, 0]]), np.concatenate([left + 1, skip[:, 1]])
        if not len(a):
            return p
        # only tokens on an edge take part
        nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b = ends[: len(a)], ends[len(a) :]
        base, cut = unary[nodes], len(left)
        chain, tie = np.exp(self.chain[:_L, :_L]), np.exp(self.skip[:_L, :_L])
        m_ab, m_ba = np.full((len(a), _L), 1 / _L), np.full((len(a), _L), 1 / _L)

        def gathered() -> np.ndarray:
            got = base.copy()
            la, lb = np.log(m_ba), np.log(m_ab)
            for label in range(_L):
                got[:, label] += np.bincount(a, la[:, label], len(nodes)) + np.bincount(b, lb[:, label], len(nodes))
            return got

        for _ in range(ROUNDS):
            got = gathered()
            out_a, out_b = got[a] - np.log(m_ba), got[b] - np.log(m_ab)
            out_a, out_b = np.exp(out_a - out_a.max(axis=1, keepdims=True)), np.exp(out_b - out_b.max(axis=1, keepdims=True))
            m_ab = np.concatenate([out_a[:cut] @ chain, out_a[cut:] @ tie])
            m_ba = np.concatenate([out_b[:cut] @ chain.T, out_b[cut:] @ tie])
            m_ab = np.maximum(m_ab / m_ab.sum(axis=1, keepdims=True), 1e-12)
            m_ba = np.maximum(m_ba / m_ba.sum(axis=1, keepdims=True), 1e-12)
        got = gathered()
        q = np.exp(got - got.max(axis=1, keepdims=True))
        p[nodes] = q / q.sum(axis=1, keepdims=True)
        return p

    def stretches(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """(start, end, kind) of each text."""
        spans = [tokens_of(t) for t in texts]
        label = self.marginals([[t[a:b] for a, b in s] for t, s in zip(texts, spans)]).argmax(axis=1)
        out, at = [], 0
        for t, s in zip(texts, spans):
            out.append(_runs(t, s, label[at : at + len(s)]))
            at += len(s)
        return out


_FORMS = {2: EMAIL, 3: PHONE, 4: IDNUM, 5: ADDRESS}
_RUN_ENDS = re.compile(r"[^.\s][;:!?]$|\w{3}\.$")
_NAME_HEAD = re.compile(rf"[\W_]*(?:(?i:{'|'.join(sorted(TITLES))})\b\.?\s+)?[\W_]*")
_NAME_TAIL = re.compile(r"(?:['’]s)?[\s,;:!?()\"'-]*$")


def _runs(text: str, spans: list[tuple[int, int]], labels: np.ndarray) -> list[tuple[int, int, str]]:
    found = []
    marked = np.nonzero(labels)[0].tolist()
    i = 0
    while i < len(marked):
        k, first = int(labels[marked[i]]), marked[i]
        last = first
        while i + 1 < len(marked) and marked[i + 1] == last + 1 and labels[last + 1] == k and not (k == 1 and _RUN_ENDS.search(text[spans[last][0] : spans[last][1]])):
            last += 1
            i += 1
        found += _ends(text, spans[first][0], spans[last][1], k)
        i += 1
    found.sort()
    out: list[tuple[int, int, str]] = []
    for f in found:
        if not out or f[0] >= out[-1][1]:
            out.append(f)
    return out


def _ends(text: str, start: int, end: int, kind: int) -> list[tuple[int, int, str]]:
    """Set the ends of a run to the form of its kind."""
    if kind == 1:
        start += _NAME_HEAD.match(text[start:end]).end()
        run = _NAME_TAIL.sub("", text[start:end])
        if run.endswith(".") and not re.search(r"(?:^|\s)(?:[A-Z]|[JjSs][Rr])\.$", run):
            run = run.rstrip(".")
        return [(start, start + len(run), "name")] if len(re.sub(r"\W", "", run)) >= 2 and run[:1].isupper() else []
    out = []
    # the exact form may begin a token before the run, or for short kinds end one behind it, but
    # must share ground with it
    for m in _FORMS[kind].finditer(text, max(0, start - 40), end if kind == 5 else min(len(text), end + 40)):
        if m.start() < end and start < m.end():
            stop = m.end()
            if kind == 2:
                stop = m.start() + len(m[0].rstrip("."))
            out.append((m.start(), stop, LABELS[kind]))
    return out


def fitted_field(texts: DataFrame, id_column: str, text_column: str) -> SkipChain:
    """The field fitted on at most MOST_TRAINING texts, the first by a hash of id and text."""
    rows = texts.where(F.col(text_column).isNotNull()).select(id_column, text_column).orderBy(F.xxhash64(id_column, text_column), id_column).limit(MOST_TRAINING)
    return SkipChain().fit([r[1] for r in rows.collect()])


def _mapped(texts: DataFrame, id_column: str, text_column: str, build, schema: str) -> DataFrame:
    model = texts.sparkSession.sparkContext.broadcast(fitted_field(texts, id_column, text_column))

    def run(batches):
        field = model.value
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                given = [t or "" for t in part[text_column]]
                yield build(part[id_column].tolist(), part[text_column].tolist(), field.stretches(given))

    return spread(texts.select(id_column, text_column)).mapInPandas(run, schema)


def personal_stretches(report_extract: DataFrame) -> DataFrame:
    """docid, kind, value_text (distinct): the stretch as it stands, white space as one blank."""

    def build(ids, texts, found):
        rows = [(i, kind, re.sub(r"\s+", " ", t[a:b]).strip()) for i, t, spans in zip(ids, texts, found) for a, b, kind in spans]
        return pd.DataFrame(rows, columns=["docid", "kind", "value_text"])

    return _mapped(report_extract, "docid", "narrative", build, "docid string, kind string, value_text string").distinct()


def masked_texts(report_extract: DataFrame) -> DataFrame:
    """docid, narrative with each stretch replaced by its kind in brackets, such as [NAME]."""

    def build(ids, texts, found):
        out = []
        for t, spans in zip(texts, found):
            if t is not None:
                for a, b, kind in reversed(spans):
                    t = f"{t[:a]}[{kind.upper()}]{t[b:]}"
            out.append(t)
        return pd.DataFrame({"docid": ids, "narrative": out})

    return _mapped(report_extract, "docid", "narrative", build, "docid string, narrative string")

"""Secret scans: fixed patterns, and values in a credential context that would be expensive to guess.

The guess cost of a value is the least, over all ways to cut it into spans, of the product of the guesses that each span
takes: a common word by its rank, a date by the days it could be, a repeat by its unit and count, a keyboard walk by its
start, length and direction, anything else character by character. Every word, date, walk and repeat inside a value counts,
whatever it is a part of or overlaps. A value whose cost reaches a threshold is a secret;
a placeholder, a word or a date is not.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluiceway.llm.shared import chunks, texts_of

KINDS = ["assign", "access", "hex", "guess"]

# The base patterns.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

#: What introduces a credential, and its value: quoted, or up to white space, a quote, a comma or a semicolon.
CONTEXT = re.compile(
    r"""(?ai:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|(?:access|private|secret)[_-]?key|credentials?|auth(?:orization)?)"""
    r"""["']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"',;]+))"""
)
#: A password in a URL: ``scheme://user:password@host``.
URL_USER = re.compile(r"""://[^\s:/@"']+:([^\s/@"']+)@""")

#: Words that passwords and placeholders are often made of, the most common first.
COMMON_WORDS = (
    "password admin welcome login qwerty letmein master dragon monkey shadow sunshine princess football baseball "
    "secret token user test guest root default changeme example sample dummy placeholder redacted required optional "
    "none null true false undefined string value your here name email hello love please enter insert username system "
    "server database access private public public key api service account manager summer winter spring autumn monday "
    "friday january october december company office super hunter killer soccer hockey batman superman michael jordan "
    "charlie daniel thomas robert ashley jessica jennifer freedom whatever trustno starwars computer internet pass "
    "word the and for with this that from have not are you all new old my is in of to it"
).split()
KEY_ROWS = ["`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz"]
#: Letters that digits and signs stand for.
LOOK_ALIKE = str.maketrans({"4": "a", "@": "a", "3": "e", "1": "l", "0": "o", "$": "s", "5": "s", "7": "t"})
_YEAR, _MONTH, _DAY, _SIGN = r"(?:19|20)\d\d", "(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])", "([-/._]?)"
#: Dates with the year first or last, and years, each at every place, and how many of them there are.
DATES = [
    (re.compile(f"(?a:(?=({_YEAR}{_SIGN}{_MONTH}\\2{_DAY})))"), 365 * 150 * 3),
    (re.compile(f"(?a:(?=({_DAY}{_SIGN}{_MONTH}\\2{_YEAR})))"), 365 * 150 * 3),
    (re.compile(f"(?a:(?=({_YEAR})))"), 150),
]
#: The longest unit of a repeat, and the shortest walk, in characters.
LONGEST_UNIT, SHORTEST_WALK = 8, 3
_PROPER_DIVISORS = {u: [d for d in range(1, u) if u % d == 0] for u in range(1, LONGEST_UNIT + 1)}


def _steps() -> dict[tuple[str, str], int]:
    """Neighbouring keys and their direction: 1 to the right or forward, 2 to the left or back, 3 down, 4 up."""
    found = {}
    for row in KEY_ROWS:
        for a, b in zip(row, row[1:], strict=False):
            found[a, b], found[b, a] = 1, 2
    for upper, lower in zip(KEY_ROWS, KEY_ROWS[1:4], strict=False):
        for a, b in zip(upper[upper is KEY_ROWS[0] :], lower, strict=False):
            found.setdefault((a, b), 3)
            found.setdefault((b, a), 4)
    return found


_STEPS = _steps()


def _character(c: str) -> float:
    """Guesses of one character, as a power of ten, by its class."""
    if c.isdigit():
        return 1.0
    if c.isascii():
        return math.log10(26) if c.isalpha() else math.log10(33)
    return 2.0


class GuessCost:
    """Least guess cost of a value, as a power of ten, given words from common to rare."""

    #: Guesses of where one span ends and the next begins.
    JOINT = math.log10(2)
    #: Costs that differ by less are one: sums of the same numbers in another order.
    SAME = 1e-9

    def __init__(self, words: Sequence[str] = COMMON_WORDS):
        ranks: dict[str, int] = {}
        for word in words:
            ranks.setdefault(word.lower(), len(ranks) + 1)
        self.words = {w: math.log10(rank + 1) for w, rank in ranks.items()}
        self.longest = max(map(len, self.words), default=0)

    def spans(self, value: str) -> Iterator[tuple[int, int, float]]:
        """Start, end and cost of every word and date; walks and repeats are found on the way, see ``__call__``."""
        low = value.lower()
        plain = low.translate(LOOK_ALIKE)
        for start in range(len(value)):
            for end in range(start + 2, min(len(value), start + self.longest) + 1):
                cost = self.words.get(low[start:end])
                swapped = self.words.get(plain[start:end])
                if cost is None and swapped is not None:
                    cost = swapped + math.log10(4)
                if cost is not None:
                    piece = value[start:end]
                    yield start, end, cost + (0 if piece == low[start:end] else math.log10(2 if piece[1:].islower() or piece.isupper() else 16))
        for pattern, count in DATES:
            for m in pattern.finditer(value):
                yield m.start(), m.end(1), math.log10(count)

    def __call__(self, value: str) -> float:
        """Dynamic programming over the ends of spans; a brute-force span grows character by character.

        Every part of a walk or of a repeat is a span of its own, so their starts are kept as they come up, less those that a later start
        beats for good and those where the same walk or repeat has just ended, which it is cheaper to go on with.
        """
        ending: dict[int, list[tuple[int, float]]] = {}
        for start, end, cost in self.spans(value):
            ending.setdefault(end, []).append((start, cost))
        best, brute, walks, repeats = [0.0], [math.inf], _Walks(value.lower()), _Repeats(value)
        for end in range(1, len(value) + 1):
            joint = self.JOINT if end > 1 else 0.0
            loose = min(brute[end - 1], best[end - 1] + joint) + _character(value[end - 1])
            known = min((best[s] + c + (self.JOINT if s else 0.0) for s, c in ending.get(end, ())), default=math.inf)
            walked, repeated = walks.least(end, best, self.JOINT), repeats.least(end, best, self.JOINT)
            brute.append(loose)
            best.append(min(loose, known, walked, repeated))
            walks.ended(walked <= best[end] + self.SAME)
            repeats.ended(repeated <= best[end] + self.SAME)
        return best[-1]


def _push(starts: list[tuple[float, int]], cost: float, start: int) -> None:
    """Add a start to those in use; what came before it and costs as much can never be better again."""
    while starts and starts[-1][0] >= cost:
        starts.pop()
    starts.append((cost, start))


class _Walks:
    """The cheapest way to end with a keyboard walk, end by end: guesses for its first key, its length and each turn."""

    TURN = math.log10(4)

    def __init__(self, low: str):
        self.low, self.begin, self.direction = low, 0, None
        self.turns: list[int] = []  # of the walk at hand, up to each key
        self.starts: list[tuple[float, int]] = []
        self.last: list[int] = [-1]  # the walk that the best way to each end closes with

    def least(self, end: int, best: list[float], joint: float) -> float:
        at = end - 1
        step = _STEPS.get((self.low[at - 1], self.low[at])) if at else None
        if step is None:
            self.begin, self.direction, self.starts = at, None, []
            self.turns.append(0)
            return math.inf
        self.turns.append(self.turns[-1] + (self.direction is not None and step != self.direction))
        self.direction = step
        start = end - SHORTEST_WALK
        if start >= self.begin and self.last[start] != self.begin:
            _push(self.starts, best[start] + (joint if start else 0.0) - self.TURN * self.turns[start + 1], start)
        rest = self.TURN * (1 + self.turns[at])
        return min((cost + math.log10(47 * (end - s)) + rest for cost, s in self.starts), default=math.inf)

    def ended(self, is_best: bool) -> None:
        self.last.append(self.begin if is_best else -1)


class _Repeats:
    """The cheapest way to end with two or more copies of a unit, end by end: guesses for the unit and their number."""

    def __init__(self, value: str):
        self.value = value
        self.sums = [0.0]
        self.run = dict.fromkeys(_PROPER_DIVISORS, 0)  # characters that equal the one a unit before
        self.starts: dict[int, dict[int, list[tuple[float, int]]]] = {unit: {} for unit in self.run}
        self.last: list[tuple[int, int] | None] = [None]
        self.found: tuple[int, int] | None = None

    def least(self, end: int, best: list[float], joint: float) -> float:
        value, run, at = self.value, self.run, end - 1
        self.sums.append(self.sums[-1] + _character(value[at]))
        cheapest, self.found = math.inf, None
        for unit in run:
            if at < unit or value[at] != value[at - unit]:
                run[unit] = 0
                if self.starts[unit]:
                    self.starts[unit] = {}
                continue
            run[unit] += 1
            # a unit that repeats a shorter one costs more than the shorter one
            if run[unit] < unit or any(run[d] >= unit - d for d in _PROPER_DIVISORS[unit]):
                continue
            start, begin = end - 2 * unit, end - unit - run[unit]
            starts = self.starts[unit].setdefault(end % unit, [])
            if self.last[start] != (unit, begin):
                _push(starts, best[start] + (joint if start else 0.0), start)
            own = self.sums[end] - self.sums[end - unit]
            cost = min((c + own + math.log10((end - s) // unit) for c, s in starts), default=math.inf)
            if cost < cheapest:
                cheapest, self.found = cost, (unit, begin)
        return cheapest

    def ended(self, is_best: bool) -> None:
        self.last.append(self.found if is_best else None)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns: leftmost, not overlapping within a kind, those that are too short left out."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def guess_spans(text: str, cost: GuessCost, threshold: float, least: int) -> list[tuple[int, int, str]]:
    """Values in a credential context that take at least ``10 ** threshold`` guesses."""
    if ":" not in text and "=" not in text:
        return []
    places = []
    for m in CONTEXT.finditer(text):
        group = m.lastindex
        start, end = m.span(group)
        if group == 3:
            end = start + len(text[start:end].rstrip(".:)]}>"))
        places.append((start, end))
    if "://" in text:
        places += [m.span(1) for m in URL_USER.finditer(text)]
    return [(s, e, "guess") for s, e in dict.fromkeys(places) if e - s >= least and cost(text[s:e]) >= threshold]


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered(spans))


@cache
def _cost(words: tuple[str, ...]) -> GuessCost:
    return GuessCost(words)


def secrets_found(docs: DataFrame, words: Sequence[str] = COMMON_WORDS, threshold: float = 8.0, least: int = 6) -> DataFrame:
    """The secrets of every row of ``docs`` (doc_id, text), in one scan: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    Spans are kind:start:end in code points, end exclusive, by start and then kind; ``base_sha256`` is over those of the fixed
    patterns. A null text is empty: no spans, the digest of nothing. A null doc_id stays null; repeated rows are scanned each;
    other columns are not read; an empty table gives no rows. Values shorter than ``least`` are no guess spans.
    """
    words = tuple(words)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = _cost(words)
        for batch in batches:
            for part in chunks(batch, "text"):
                counts, digests, spans = [], [], []
                for text in texts_of(part):
                    base = base_spans(text)
                    kinds = [kind for _, _, kind in base]
                    counts.append([kinds.count(kind) for kind in KINDS[:3]])
                    digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                    spans.append(joined(base + guess_spans(text, cost, threshold, least)))
                numbers = np.array(counts, np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *(pa.array(numbers[:, i]) for i in range(3)), pa.array(digests), pa.array(spans)],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )


def redacted(docs: DataFrame, mark: str = "[secret]", threshold: float = 8.0, least: int = 6) -> DataFrame:
    """``docs`` with every secret of its texts replaced by ``mark``, overlapping ones by one; n_chars follows where it exists.

    All rows and columns stay; null texts stay null.
    """
    schema = docs.schema
    has_length = "n_chars" in schema.names

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = _cost(tuple(COMMON_WORDS))
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch["text"].to_pylist()
            changed = {}
            for i, text in enumerate(texts):
                spans = ordered(base_spans(text) + guess_spans(text, cost, threshold, least)) if text else []
                if spans:
                    pieces, end = [], 0
                    for start, stop, _ in spans:
                        if start >= end:
                            pieces += [text[end:start], mark]
                        end = max(end, stop)
                    changed[i] = "".join(pieces) + text[end:]
            if changed:
                texts = [changed.get(i, t) for i, t in enumerate(texts)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                if has_length:
                    at = batch.schema.get_field_index("n_chars")
                    sizes = batch["n_chars"].to_pylist()
                    sizes = [len(changed[i]) if i in changed else n for i, n in enumerate(sizes)]
                    batch = batch.set_column(at, batch.schema.field(at), pa.array(sizes, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(replace, schema)

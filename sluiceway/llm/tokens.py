"""Token ids of whole texts by the tokenizers library, one library call per distinct word.

Both vocabularies split a text into pre-tokens before any merge, and no pre-token crosses a single
blank between two other characters. A text is therefore cut there, each distinct piece is encoded once
by the library, and the ids are put together as arrays. Texts with white space on which Python and the
library could differ go to the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np

_ODD = re.compile("[^\\S \\n]|\u180e")
_DOUBLE = re.compile(r"[ \n][ \n]")
_BEFORE_SINGLE = re.compile(r"(?<=[^ \n])(?=[ \n][^ \n])")

#: What byte-level vocabularies write for a blank and a line feed, and what stands between joined pieces elsewhere.
_BLANK_BYTES = "\u0120\u010a"
_BETWEEN = "\x01"
_JOINED = 2000


def units_with_blanks(text: str) -> list:
    """Pieces of a text whose pre-tokens keep blanks.

    A piece stands for itself behind one blank, or behind the line feed it begins with; a tuple holds a
    piece as it is.
    """
    if _ODD.search(text):
        return [(text,)]
    if _DOUBLE.search(text):
        return [(unit,) for unit in _BEFORE_SINGLE.split(text)]
    first, *rest = text.replace("\n", " \n").split(" ")
    return [(first,), *rest] if first else rest


def _with_blank(unit) -> str:
    if isinstance(unit, tuple):
        return unit[0]
    return unit if unit[:1] == "\n" else " " + unit


def lower_case(text: str) -> str:
    """The text in lower case where that cannot change its ids: no composed forms, no special tokens.

    For vocabularies that lower the case themselves; fewer pieces are then distinct.
    """
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text if "<|" in text else text.lower()


def units_without_blanks(text: str) -> list:
    """Pieces of a text whose pre-tokens drop white space and case."""
    return [(text,)] if _ODD.search(text) else lower_case(text).split()


def _bare(unit) -> str:
    return unit[0] if isinstance(unit, tuple) else unit


class _Slots(dict):
    """Numbers pieces as they are met."""

    def __missing__(self, unit):
        slot = self[unit] = len(self)
        self.new.append(unit)
        return slot

    def __init__(self):
        super().__init__()
        self.new = []


class Encoder:
    """Ids of texts, exactly as ``tokenizers`` gives them.

    ``blanks``: whether the vocabulary keeps blanks (byte-level) or drops them. At most ``cache_units``
    distinct pieces, or eight times as many ids, are remembered (about 150 bytes a piece); then those met once
    are forgotten.
    """

    def __init__(self, path: str, blanks: bool, cache_units: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.blanks = blanks
        self.begins = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        if blanks:
            self.begins[[i for token, i in self.tokenizer.get_vocab().items() if token[0] in _BLANK_BYTES]] = True
        else:
            self.begins[self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids] = True
        self.split: Callable = units_with_blanks if blanks else units_without_blanks
        self.plain: Callable = _with_blank if blanks else _bare
        self.limit = cache_units
        self._forget()

    def _forget(self) -> None:
        self.slots = _Slots()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 16, np.int64)
        self.sizes = np.zeros(1 << 16, np.int32)
        self.met = np.zeros(1 << 16, np.int32)

    def _thin(self) -> None:
        """Forget the pieces met only once; those met more often, at most half of the limit, stay."""
        met = self.met[: len(self.slots)]
        often = np.flatnonzero(met > 1)
        often = often[np.argsort(-met[often], kind="stable")[: self.limit // 2]]
        units, ids, sizes = list(self.slots), self._spread(often), self.sizes[often]
        self._forget()
        if len(ids) <= 4 * self.limit:
            self.slots.update((units[k], slot) for slot, k in enumerate(often.tolist()))
            self._keep(np.arange(len(often)), ids, sizes)

    def _encode_joined(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that the library reads many at a time, and how many each has.

        Where blanks are kept, each piece begins with the only blank or line feed in it, and so does its
        first token; else a control character stands between the pieces as a token of its own.
        """
        blocks = [units[i : i + _JOINED] for i in range(0, len(units), _JOINED)]
        if self.blanks:
            joined = [" " + " ".join(block).replace(" \n", "\n") for block in blocks]
            joined = [text[1:] if block[0][0] == "\n" else text for text, block in zip(joined, blocks, strict=True)]
        else:
            joined = [f"{_BETWEEN} " + f" {_BETWEEN} ".join(block) for block in blocks]
        found = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        first = self.begins[ids]
        sizes = np.diff(np.append(np.flatnonzero(first), len(ids)))
        return (ids, sizes) if self.blanks else (ids[~first], sizes - 1)

    def _room(self, total: int) -> None:
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.slots) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
            self.met = np.concatenate([self.met, np.zeros_like(self.met)])

    def _keep(self, slots: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        self._room(len(ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[slots] = self.used + np.cumsum(sizes) - sizes
        self.sizes[slots] = sizes
        self.used += len(ids)

    def _spread(self, slots: np.ndarray) -> np.ndarray:
        """The ids of pieces, one after another."""
        size = self.sizes[slots].astype(np.int64)
        upto = np.cumsum(size)
        return self.ids[np.repeat(self.starts[slots] - (upto - size), size) + np.arange(int(size.sum()))]

    def _learn(self) -> None:
        """Encode the pieces met since the last call."""
        new, self.slots.new = self.slots.new, []
        if not new:
            return
        slots = np.arange(len(self.slots) - len(new), len(self.slots))
        plain = np.fromiter((isinstance(u, str) and u not in ("", "\n") and _BETWEEN not in u for u in new), bool, len(new))
        if plain.any():
            self._keep(slots[plain], *self._encode_joined([u for u, p in zip(new, plain, strict=True) if p]))
        if not plain.all():
            alone = [self.plain(u) for u, p in zip(new, plain, strict=True) if not p]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]
            self._keep(slots[~plain], np.array([i for ids in found for i in ids], np.uint32), np.array(list(map(len, found))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and how many each text has."""
        if len(self.slots) > self.limit or self.used > 8 * self.limit:
            self._thin()
        units, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = self.split(text) if text else []
            counts[i] = len(found)
            units += found
        slot = np.fromiter(map(self.slots.__getitem__, units), np.int64, len(units))
        self._learn()
        self.met[: len(self.slots)] += np.bincount(slot, minlength=len(self.slots)).astype(np.int32)
        ids = self._spread(slot)
        upto = np.cumsum(self.sizes[slot], dtype=np.int64)
        edges = np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(edges)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, blanks: bool) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    key = (path, blanks)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, blanks)
    return _ENCODERS[key]

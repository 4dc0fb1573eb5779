"""Whole-text token ids by the tokenizers library, with the ids of recurring parts kept.

Texts are cut, a batch at a time and in Arrow, only where the pre-tokens of both public
vocabularies always end: before a single space, around line feeds, between a letter and the
punctuation that closes a word. A text's ids are then those of its parts one after another.
A batch's distinct parts are looked up among those a worker knows; new ones go to the
library, many at a time, and the ids of the whole batch are gathered in one step. Texts with
other white space, or with a special token's own string, take the plain way through the
library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts kept by a worker before it starts afresh, about 200 bytes each; bytes of text cut at once.
MOST_KEPT = 600_000
BATCH_BYTES = 2 << 20
_CHUNK = 1024
_CUT = "\0"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_CLOSING = ".,;:!?#$%&*|"
#: A space and a word of known letters: one pre-token in either vocabulary.
_PLAIN = re.compile(rf" [{_LETTERS}]+")
#: Parts that end and begin where pre-tokens do, whatever stands around them.
_FIT = re.compile(r" ?\S+|\n+|")

_encoders: dict[str, Encoder] = {}


def cut(texts: pa.Array) -> pa.Array:
    """Lists of the parts of texts that hold no ``_CUT`` of their own; some parts may be empty.

    The last of several line feeds is a pre-token of its own where a sign follows, not where
    a space or nothing does.
    """
    x = pc.replace_substring(texts, " ", _CUT + " ")
    x = pc.replace_substring_regex(x, r"(\n+)", rf"{_CUT}\1{_CUT}")
    x = pc.replace_substring_regex(x, rf"\n\n{_CUT}([^{_CUT}])", f"\n{_CUT}\n{_CUT}\\1")
    x = pc.replace_substring_regex(x, f"([{_LETTERS}])([{_CLOSING}])", rf"\1{_CUT}\2")
    x = pc.replace_substring_regex(x, f"([{_CLOSING}])([{_LETTERS}])", rf"\1{_CUT}\2")
    return pc.split_pattern(x, _CUT)


class Encoder:
    """Ids of texts as unsigned 32-bit numbers."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses every core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = self.library.get_added_tokens_decoder()
        self.divider_id, divider = next(iter(sorted(special.items())))
        self.divider = divider.content
        self.marks = [_CUT, *(t.content for t in special.values())]
        tokens = self.library.get_vocab()
        # ids that close a word where the vocabulary marks word ends, else ids that open one
        self.word_ends = any(t.endswith("</w>") for t in tokens)
        self.edge = np.zeros(max(tokens.values()) + 1, bool)
        self.edge[[i for t, i in tokens.items() if (t.endswith("</w>") if self.word_ends else t.startswith("Ġ"))]] = True
        self._forget()

    def _forget(self) -> None:
        """Known parts by number, each with a place and a length in the pool of ids; number 0 is the empty one."""
        self.known: dict[str, int] = {"": 0}
        self.pool = np.zeros(0, np.uint32)
        self.place = np.zeros(1, np.int64)
        self.length = np.zeros(1, np.int64)

    def whole(self, text: str) -> bytes:
        """The ids of one text straight from the library, as little-endian bytes."""
        return self._whole(text).astype("<u4", copy=False).tobytes()

    def _whole(self, text: str) -> np.ndarray:
        return np.asarray(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _keep(self, parts: list[str], ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts)), strict=True))
        self.place = np.append(self.place, len(self.pool) + starts)
        self.length = np.append(self.length, ends - starts)
        self.pool = np.append(self.pool, ids)

    def _learn(self, parts: list[str]) -> None:
        """Keep the ids of parts: plain words encoded side by side, others with a special token between."""
        plain, rest, ids, starts, ends, at = [], [], [], [], [], 0
        for p in parts:
            (plain if _PLAIN.fullmatch(p) else rest).append(p)
        kept: list[str] = []
        for lo in range(0, len(plain), _CHUNK):
            some = plain[lo : lo + _CHUNK]
            own = self._whole("".join(some))
            edges = np.flatnonzero(self.edge[own])
            if len(edges) != len(some):
                rest += some
                continue
            first = np.append(0, edges[:-1] + 1) if self.word_ends else edges
            kept, ids, starts, at = kept + some, [*ids, own], [*starts, at + first], at + len(own)
            ends.append(np.append(starts[-1][1:], at))
        for lo in range(0, len(rest), _CHUNK):
            some = rest[lo : lo + _CHUNK]
            own = self._whole(self.divider.join(some))
            last = np.append(np.flatnonzero(own == self.divider_id), len(own))
            kept, ids, starts = kept + some, [*ids, own], [*starts, at + np.append(0, last[:-1] + 1)]
            ends, at = [*ends, at + last], at + len(own)
        if kept:
            self._keep(kept, np.concatenate(ids), np.concatenate(starts), np.concatenate(ends))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's end; null or empty ones have none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = np.zeros(len(texts), bool)
        for m in self.marks:
            odd |= pc.match_substring(texts, m).to_numpy(zero_copy_only=False)
        parts = cut(pc.if_else(pa.array(odd), "", texts) if odd.any() else texts)
        coded = parts.flatten().dictionary_encode()
        bounds, code = parts.offsets.to_numpy(), coded.indices.to_numpy()
        used = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist()
        if len(self.known) > MOST_KEPT:
            self._forget()
        new = [p for p in used if p not in self.known]
        loose = {p for p in new if not _FIT.fullmatch(p)}
        self._learn([p for p in new if p not in loose] if loose else new)
        number = np.fromiter(map(self.known.get, used, repeat(0)), np.int64, len(used))[code]
        if loose:
            is_loose = np.fromiter((p in loose for p in used), bool, len(used))[code]
            odd |= np.diff(np.append(0, np.cumsum(is_loose))[bounds]) > 0
        length = self.length[number]
        before = np.append(0, np.cumsum(length))
        place = np.repeat(self.place[number] - before[:-1], length) + np.arange(before[-1])
        ids, ends = self.pool[place], before[bounds[1:]]
        if not odd.any():
            return ids, ends
        own = np.split(ids, ends[:-1])
        for k in np.flatnonzero(odd):
            own[k] = self._whole(texts[int(k)].as_py())
        return np.concatenate(own), np.cumsum([len(x) for x in own])

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian bytes."""
        ids, ends = self.batch(pa.array(texts, pa.large_string()))
        raw, at = ids.astype("<u4", copy=False).tobytes(), 0
        for end in ends.tolist():
            yield raw[4 * at : 4 * end]
            at = end


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(path: str, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, ids, ends) of slices of ``texts`` of about BATCH_BYTES, a longer text alone."""
    own = encoder(path)
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, lo = np.cumsum(size), 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] - size[lo] + BATCH_BYTES, side="right")))
        yield lo, hi, *own.batch(texts.slice(lo, hi - lo))
        pa.default_memory_pool().release_unused()  # else a worker keeps its largest batch's memory
        lo = hi

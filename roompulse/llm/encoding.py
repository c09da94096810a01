"""Tokenizer calls that encode each distinct piece of text once.

A byte-pair tokenizer splits a text into words before it merges bytes, so a text may be cut at word borders,
its pieces encoded apart and their ids joined. The borders used here are those where every supported
tokenizer splits: before a run of white space, after a single line feed, and between ASCII letters or digits
and ASCII punctuation (the apostrophe excepted, for contractions). Ids are the same as for the whole text.

Added tokens that a text holds literally (``<|endoftext|>``, say) become their ids, as by the library's defaults; the
parts between them are texts of their own.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from tokenizers import Tokenizer

from roompulse.llm import bytetext

# A task has one core; a thread pool in each Python worker would also keep memory of its own per thread.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_OTHER, _ALNUM, _PUNCT, _WHITE = 0, 1, 2, 3
_CLASS = np.zeros(256, np.uint8)
for _code in range(128):
    if chr(_code).isalnum():
        _CLASS[_code] = _ALNUM
    elif chr(_code).isprintable() and chr(_code) not in " '":
        _CLASS[_code] = _PUNCT
_CLASS[[9, 10, 11, 12, 13, 32]] = _WHITE
#: Pieces kept between slices; beyond it those that came up in one slice only go, and of the others the rarer ones.
CACHE_PIECES = 400_000
_GROUP, _GROUPS = 100, 20
_ADDED = np.uint64(1 << 40)


def _wide_space(data: np.ndarray) -> np.ndarray:
    """Marks the bytes of white space beyond ASCII, and control characters that some count as white space."""
    mark = (data >= 0x1C) & (data <= 0x1F)
    for lead, rest in ((0xC2, (0x85, 0xA0)),):
        at = np.flatnonzero(data[:-1] == lead)
        at = at[np.isin(data[at + 1], rest)]
        mark[at] = mark[at + 1] = True
    at = np.flatnonzero((data[:-2] >= 0xE1) & (data[:-2] <= 0xE3)) if len(data) > 2 else np.empty(0, np.int64)
    code = (data[at].astype(np.int64) << 16) | (data[at + 1].astype(np.int64) << 8) | data[at + 2]
    wide = [0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]
    at = at[np.isin(code, wide)]
    for step in range(3):
        mark[at + step] = True
    return mark


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start of each piece, in order; every row that isn't empty starts one."""
    n = len(data)
    start = np.zeros(n, bool)
    if not n:
        return np.empty(0, np.int64)
    kind, wide = _CLASS[data], _wide_space(data)
    white = kind == _WHITE
    start[1:] = white[1:] & ~white[:-1] & ~wide[:-1]
    start[1:] |= (kind[1:] + kind[:-1] == _ALNUM + _PUNCT) & (kind[1:] != _OTHER) & (kind[:-1] != _OTHER)
    line = np.flatnonzero(data[1:-1] == 10) + 1 if n > 2 else np.empty(0, np.int64)
    line = line[~(white[line - 1] | wide[line - 1] | white[line + 1] | wide[line + 1])]
    start[line + 1] = True
    at = offsets[:-1][np.diff(offsets) > 0]
    start[at] = True
    return np.flatnonzero(start)


class PieceEncoder:
    """Encodes batches of texts with a tokenizers file, each distinct piece once.

    With ``added_tokens`` literal added tokens become their ids, as by the library's defaults; without, those that
    are special count as text (the library's ``encode_special_tokens``).
    """

    def __init__(self, path: str, added_tokens: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items()} if added_tokens else {}
        # Added tokens that also take white space, or that are looked for in normalized text, are left to the library.
        self.whole_texts = added_tokens and any(
            t.normalized or t.lstrip or t.rstrip or t.single_word or not t.special
            for t in self.tokenizer.get_added_tokens_decoder().values())
        # The parts between added tokens hold none, and must not get any by lower case.
        self.tokenizer.encode_special_tokens = not self.whole_texts
        self.added_ids = np.array(sorted(self.added.values()), np.uint32)
        self.added_keys = bytetext.mix(self.added_ids.astype(np.uint64) + _ADDED)
        self.literals = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))))
        self.lowers = self._ids("AB") == self._ids("ab")
        if len(self._ids("a\nb")) == 3:
            self.mark, self.mark_id = "\n", self._ids("a\nb")[1]
            self.separator = b"\n"
        else:
            self.mark = next(c for c in "¤§¶†‡«»¿" if len(self._ids(c)) == 1)
            self.mark_id = self._ids(self.mark)[0]
            self.separator = f" {self.mark} ".encode()
        self._clear()

    def close(self) -> None:
        """Let go of the tokenizer and the pieces."""
        self.tokenizer = None
        self._clear()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _clear(self) -> None:
        order = np.argsort(self.added_keys)
        self.keys = self.added_keys[order]
        self.first, self.count, self.uses = order, np.ones(len(order), np.int64), np.zeros(len(order), np.int64)
        self.ids = self.added_ids

    def _forget(self) -> None:
        """Keep the pieces that came up in more than one slice, at most half of ``CACHE_PIECES``: the more slices the better."""
        rare = np.isin(self.keys, self.added_keys, invert=True)
        least = 2
        if len(self.uses) > CACHE_PIECES // 2:
            least = max(least, int(np.partition(self.uses, -(CACHE_PIECES // 2))[-(CACHE_PIECES // 2)]) + 1)
        kept = np.flatnonzero(~rare | (self.uses >= least))
        count = self.count[kept]
        self.ids = self.ids[bytetext.ragged(self.first[kept], count)]
        self.keys, self.first, self.count = self.keys[kept], np.cumsum(count) - count, count
        # What was kept has to come up again to stay.
        self.uses = np.ones(len(kept), np.int64)

    def _odd(self, data: np.ndarray, raw: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces that aren't one plain word with at most one space before it, or that hold the mark."""
        white = (_CLASS[data] == _WHITE) | _wide_space(data)
        mark = self.mark.encode()
        at = -1 if self.mark.isspace() else raw.find(mark)
        while at >= 0:
            white[at] = True
            at = raw.find(mark, at + 1)
        before = np.concatenate([[0], np.cumsum(white)])
        body = begin + (data[begin] == 32)
        return (before[end] > before[body]) | (body == end)

    def _encode_distinct(self, texts: list[bytes], odd: np.ndarray) -> list[np.ndarray]:
        """Ids of each piece; plain pieces (one word) go in groups with a separator whose id is known."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain, apart = np.flatnonzero(~odd).tolist(), np.flatnonzero(odd).tolist()
        groups = [plain[k:k + _GROUP] for k in range(0, len(plain), _GROUP)]
        for k in range(0, len(groups), _GROUPS):
            some = groups[k:k + _GROUPS]
            joined = [self.separator.join([texts[i] for i in group]).decode() for group in some]
            for group, found in zip(some, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
                flat = np.array(found.ids, np.uint32)
                at = np.flatnonzero(flat == self.mark_id).tolist()
                if len(at) != len(group) - 1:
                    apart.extend(group)
                    continue
                begin = 0
                for i, end in zip(group, [*at, len(flat)], strict=True):
                    out[i] = flat[begin:end]
                    begin = end + 1
        for k in range(0, len(apart), _GROUP):
            some = apart[k:k + _GROUP]
            encoded = self.tokenizer.encode_batch_fast([texts[i].decode() for i in some], add_special_tokens=False)
            for i, found in zip(some, encoded, strict=True):
                out[i] = np.array(found.ids, np.uint32)
        return out

    def _added_spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and keys of the added tokens that rows hold literally."""
        raw = data.tobytes() if self.added else b""
        spans, keys = [], []
        if any(literal in raw for literal in self.added):
            key_of = dict(zip(self.added_ids.tolist(), self.added_keys, strict=True))
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                for found in self.literals.finditer(raw, a, b):
                    spans.append(found.span())
                    keys.append(key_of[self.added[found[0]]])
        starts, ends = np.array(spans, np.int64).reshape(-1, 2).T
        return starts, ends, np.array(keys, np.uint64)

    def _encode_whole(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, borders = data.tobytes(), offsets.tolist()
        out = [self._ids(raw[a:b].decode()) for a, b in zip(borders[:-1], borders[1:], strict=True)]
        counts = np.fromiter(map(len, out), np.int64, len(out))
        return np.concatenate([np.empty(0, np.uint32), *(np.array(ids, np.uint32) for ids in out)]), counts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows one after the other, and how many each row has."""
        rows = len(offsets) - 1
        if self.whole_texts:
            return self._encode_whole(data, offsets)
        added_starts, added_ends, added_keys = self._added_spans(data, offsets)
        if self.lowers:
            data = bytetext.lower(data)
        starts = pieces(data, np.unique(np.concatenate([offsets, added_starts, added_ends])))
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(rows, np.int64)
        if len(added_starts):
            token = np.searchsorted(added_starts, starts, side="right") - 1
            starts = starts[(token < 0) | (starts >= added_ends[token]) | (starts == added_starts[token])]
        ends = np.append(starts[1:], len(data))
        hashes = bytetext.span_hashes(data, starts, ends)
        hashes[np.searchsorted(starts, added_starts)] = added_keys
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_PIECES:
            self._forget()
        found = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = found < len(self.keys)
        known[inside] = self.keys[found[inside]] == distinct[inside]
        self.uses[found[known]] += 1
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            begin, end = starts[at[new]], ends[at[new]]
            texts = [raw[s:e] for s, e in zip(begin.tolist(), end.tolist(), strict=True)]
            encoded = self._encode_distinct(texts, self._odd(data, raw, begin, end))
            count = np.fromiter(map(len, encoded), np.int64, len(encoded))
            first = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, *encoded])
            at = found[new]  # both are sorted
            self.keys = np.insert(self.keys, at, distinct[new])
            self.first, self.count = np.insert(self.first, at, first), np.insert(self.count, at, count)
            self.uses = np.insert(self.uses, at, 1)
            found = np.searchsorted(self.keys, distinct)
        place = found[inverse.reshape(-1)]
        count = self.count[place]
        ids = self.ids[bytetext.ragged(self.first[place], count)]
        before = np.concatenate([[0], np.cumsum(count)])
        borders = before[np.searchsorted(starts, offsets)]
        return ids, np.diff(borders)


_ENCODERS: dict[str, PieceEncoder] = {}


@contextmanager
def encoding_task(path: str) -> Iterator[PieceEncoder]:
    """The encoder of this worker process, whose tasks run one after the other; it holds one tokenizer at a time."""
    encoder = _ENCODERS.get(path)
    if encoder is None:
        for other in _ENCODERS.values():
            other.close()
        _ENCODERS.clear()
        encoder = _ENCODERS[path] = PieceEncoder(path, added_tokens=True)
    yield encoder


def tokenizer_path(name: str) -> str:
    """A public tokenizer file of this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)

"""Ids of whole texts under a tokenizer file, with a word cache in flat arrays.

A word-level tokenizer splits a text at white space before anything else, so the ids of
a text are those of its words in order.  A group of texts is cut into words in numpy, the
distinct words are found by Arrow's dictionary encoding, only words that the worker has
not met are given to the tokenizer, and the ids are gathered by index.  The cache is one
dictionary from word to number and three flat arrays; it lives as long as the Python
worker, over its tasks, and is emptied when it holds ``CACHE_WORDS`` words or ``CACHE_IDS`` ids.

Which tokenizers allow this is read from the file (:func:`splits_at_space`); any other
one encodes every text whole.  Both ways give the tokenizer's own ids.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

from .common import LOWER, joined_bytes

CACHE_WORDS = 500_000      # distinct words that a worker remembers
CACHE_IDS = 8_000_000     # ids that they may have together
GROUP_CHARS = 2_500_000    # texts are handled in groups of about this size

# The normalisers and the pattern of a tokenizer that lower-cases and drops white space.
_NORMALIZERS = [("NFC", None), ("Replace", "\\s+"), ("Lowercase", None)]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


def splits_at_space(tokenizer) -> bool:
    """Whether white space separates words for this tokenizer, ASCII case does not matter, a stop after
    an ASCII letter at a word's end is a piece of its own, and nothing is added before or after a text."""
    made = json.loads(tokenizer.to_str())
    try:
        steps = [(n["type"], n.get("pattern", {}).get("Regex")) for n in made["normalizer"]["normalizers"]]
        first, second = made["pre_tokenizer"]["pretokenizers"]
    except (KeyError, TypeError, ValueError):
        return False
    return (steps == _NORMALIZERS and first["type"] == "Split" and first["pattern"] == {"Regex": _PATTERN}
            and first["behavior"] == "Removed" and first["invert"] and second["type"] == "ByteLevel"
            and not second["add_prefix_space"] and not second["use_regex"]
            and not made["model"].get("dropout") and not made["truncation"] and not made["padding"])


def cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
    """Words of the joined texts, without white space, and where each text's words start (with the end appended).

    Words are runs of other than space, tab, newline and carriage return; a comma or full stop that ends a
    run after an ASCII letter is a word of its own; words of ASCII alone are lower-cased."""
    space = _SPACE[data]
    held = ~space
    first = held.copy()
    first[1:] &= space[:-1]
    stop = np.flatnonzero((data == 0x2C) | (data == 0x2E))       # never the last byte, which is a newline
    stop = stop[space[stop + 1] & _LETTER[data[stop - 1]]]
    first[stop[stop > 0]] = True
    inside = [np.count_nonzero(held[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
    compact = data[held]
    begin = np.flatnonzero(first[held])
    if len(begin):
        wide = compact >= 0x80
        if wide.any():
            size = np.diff(begin, append=len(compact))
            plain = ~np.logical_or.reduceat(wide, begin)
            compact = np.where(np.repeat(plain, size), LOWER[compact], compact)
        else:
            compact = LOWER[compact]
    bounds = np.searchsorted(begin, np.cumsum([0, *inside]))
    places = np.append(begin, len(compact)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(compact))])
    return words, bounds


def _byte_strings(array: pa.BinaryArray) -> list[bytes]:
    cuts = np.frombuffer(array.buffers()[1], np.int32, len(array) + 1, 4 * array.offset).tolist()
    data = array.buffers()[2].to_pybytes() if len(array) else b""
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


class TextIds:
    """Ids of texts under one tokenizer file (see the module docstring)."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = splits_at_space(self.tokenizer)
        self.control = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache_words = cache_words
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.begin = np.zeros(1 << 12, np.int64)     # of each word's ids in self.ids, the end appended
        self.ids = np.empty(1 << 14, self.type)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.type) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _remember(self, words: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> None:
        n, used = len(self.known), int(self.begin[len(self.known)])
        while len(self.begin) < n + len(words) + 1:
            self.begin = np.concatenate([self.begin, np.zeros(len(self.begin), np.int64)])
        while len(self.ids) < used + len(ids):
            self.ids = np.concatenate([self.ids, np.empty(len(self.ids), self.type)])
        self.begin[n + 1:n + 1 + len(words)] = used + np.cumsum(sizes)
        self.ids[used:used + len(ids)] = ids
        self.known.update(zip(words, range(n, n + len(words))))

    def _learn(self, words: list[bytes]) -> None:
        """ASCII letters alone are one piece, which the model takes as it is; other words go through the whole
        tokenizer, many joined by spaces, and the offsets of the ids tell whose they are."""
        letters = [w for w in words if w.isalpha()]
        model = self.tokenizer.model.tokenize
        for lo in range(0, len(letters), 20_000):
            some = letters[lo:lo + 20_000]
            got = [[t.id for t in model(w.decode())] for w in some]
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            self._remember(some, sizes, np.fromiter((i for g in got for i in g), self.type, int(sizes.sum())))
        others = [w for w in words if not w.isalpha()]
        for lo in range(0, len(others), 20_000):
            some = others[lo:lo + 20_000]
            texts = [w.decode("utf-8", "surrogatepass") for w in some]
            got = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            starts = np.cumsum([0] + [len(t) + 1 for t in texts])
            owner = np.searchsorted(starts, np.fromiter((a for a, _ in got.offsets), np.int64, len(got.ids)), "right") - 1
            self._remember(some, np.bincount(owner, minlength=len(some)), np.array(got.ids, self.type))

    def _group(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a group of texts in one array, and where each text's ids start (with the end appended)."""
        odd = [k for k, t in enumerate(texts) if t and (not self.by_word or any(c in t for c in self.control))]
        whole = dict(zip(odd, self._whole([texts[k] for k in odd]))) if odd else {}
        words, bounds = cut_words(*joined_bytes([None if k in whole else t for k, t in enumerate(texts)]))
        coded = words.dictionary_encode()
        distinct = _byte_strings(coded.dictionary)
        entry = np.array([self.known.get(w, -1) for w in distinct], np.int64)
        fresh = np.flatnonzero(entry < 0)
        if len(fresh):
            if len(self.known) + len(fresh) > self.cache_words or self.begin[len(self.known)] > CACHE_IDS:
                self.clear()
                fresh = np.arange(len(distinct))
            self._learn([distinct[k] for k in fresh])
            entry[fresh] = [self.known[distinct[k]] for k in fresh]
        each = coded.indices.to_numpy(zero_copy_only=False)
        sizes = (self.begin[entry + 1] - self.begin[entry])[each]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(self.begin[entry][each] - (ends - sizes), sizes)
        source += np.arange(total)
        ids, starts = self.ids[source], np.concatenate([[0], ends])[bounds]
        if len(self.known) > self.cache_words:      # one group alone may have more
            self.clear()
        if whole:
            pieces = [whole.get(k, ids[starts[k]:starts[k + 1]]) for k in range(len(texts))]
            starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
            ids = np.concatenate(pieces) if pieces else ids
        return ids, starts

    def encode(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in order (null: empty)."""
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size < GROUP_CHARS):
                size += len(texts[stop] or "")
                stop += 1
            ids, starts = self._group(texts[at:stop])
            for k in range(stop - at):
                yield ids[starts[k]:starts[k + 1]]
            at = stop


_OPEN: dict[str, TextIds] = {}


def text_ids(path: str) -> TextIds:
    """One per worker process and file."""
    if path not in _OPEN:
        _OPEN[path] = TextIds(path)
    return _OPEN[path]

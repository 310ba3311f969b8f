"""Exact ids of the tokenizers library for whole texts, split into words by vector operations.

``split`` finds, for many texts at once, the words that a tokenizer's own pattern would hand to its BPE model; equal
words of a block are merged once. It knows the two public patterns used here (byte-level, and lower case with word
ends) for texts of Latin letters and ASCII white space. Any other text (other scripts, control characters, strings
of added tokens), and every text under another pattern, goes to the library as a whole. Remembered words are found by their
hash and compared letter by letter with the word that the hash stands for, so ids are always the library's. ``CACHE`` words at most are remembered, then forgotten all at once:
memory does not grow with the texts.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from rillframe.llm.words import U, distinct, firsts, spans, unpacked

CACHE = 1_400_000
LETTER, NUMBER, GAP, OTHER, ODD = 1, 2, 3, 4, 5
LATIN = 0x250
#: The split patterns known here, as their files write them.
BYTE_LEVEL = "ByteLevel"
WORD_ENDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The endings that follow an apostrophe as one word.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _kind(c: int) -> int:
    if c in (9, 10, 11, 12, 13, 32):
        return GAP
    kind = unicodedata.category(chr(c))[0]
    return ODD if kind in "CZ" else LETTER if kind == "L" else NUMBER if kind == "N" else OTHER


KINDS = np.array([_kind(c) for c in range(LATIN)] + [ODD], np.uint8)


def byte_alphabet() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Split:
    """Words of a block of texts.

    ``text`` and the code points of it, LATIN for all from there on; spans of the words and each row's first word; the
    different ``words`` as bytes of their code points, and ``which`` of them each word is. ``whole`` are the rows that
    only the library may split; they have no words here.
    """

    def __init__(self, text: str, points, starts, ends, edges, whole):
        keep = ~whole[np.searchsorted(edges, starts, side="right") - 1]
        self.text, self.points, self.whole = text, points.astype(np.uint16), whole
        self.starts, self.ends = starts[keep], ends[keep]
        self.edges = np.searchsorted(self.starts, edges)
        self.words, self.which = distinct(self.points, self.starts, self.ends)

    def spelled(self, some: np.ndarray) -> list[str]:
        """Some of the different words."""
        at = firsts(self.which, len(self.words))[some]
        return [self.text[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist())]


def split(texts: list[str], lower: bool, added: list[str]) -> Split:
    if lower:
        texts = [t.lower() for t in texts]
    text = "".join(texts)
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    points = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), LATIN)
    kinds = KINDS[points]
    odd = np.concatenate([[0], np.cumsum(kinds == ODD)])
    whole = odd[edges[1:]] > odd[edges[:-1]]
    if any(a in text for a in added):
        whole |= np.array([any(a in t for a in added) for t in texts], bool)
    n = len(points)
    if not n:
        return Split(text, points, *[np.zeros(0, np.int64)] * 2, edges, whole)

    bound = np.zeros(n + 1, bool)
    bound[edges] = True
    first = np.concatenate([[True], kinds[1:] != kinds[:-1]]) | bound[:n]
    if lower:
        first |= kinds == NUMBER  # numbers stand alone
    spaced = np.zeros(n, bool)
    if not lower:
        spaced[1:] = (points[:-1] == 32) & ~bound[1:n]  # a space belongs to the word behind it
    runs = np.flatnonzero(first)
    stops = np.append(runs[1:], n)

    single = runs[(points[runs] == 39) & (stops - runs == 1) & ~spaced[runs]]
    single = single[(single + 1 < n)]
    single = single[(kinds[np.minimum(single + 1, n - 1)] == LETTER) & ~bound[single + 1]]
    skip = {}
    for at in single.tolist():
        end = next((e for e in ENDINGS if text.startswith(e, at + 1) and not bound[at + 2:at + 1 + len(e)].any()), None)
        if end:
            skip[at] = at + 1 + len(end)
    if skip:  # the apostrophe takes the ending; what is left of the letters is a word of its own
        first[[a + 1 for a in skip]] = False
        rest = [e for e in skip.values() if e < n]
        first[rest] = True
        runs = np.flatnonzero(first)
        stops = np.append(runs[1:], n)

    gap = kinds[runs] == GAP
    if lower:
        starts, ends = runs[~gap], stops[~gap]
    else:
        begin = runs[~gap] - spaced[runs[~gap]]
        a, b = runs[gap], stops[gap]
        last = bound[b]
        begins = np.zeros(n, bool)
        for at in (begin, a[last | (b - a > 1)], (b - 1)[~last & (points[b - 1] != 32)]):
            begins[at] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], n)
    return Split(text, points, starts, ends, edges, whole)


class Places:
    """Numbers from 0 for 64-bit hashes in the order they are added, found by open addressing; 16 to 33 bytes each."""

    def __init__(self):
        self.count = 0
        self.keys, self.numbers = np.zeros(1 << 16, U), np.full(1 << 16, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for one that was not added."""
        found, rest, slot = np.full(len(keys), -1, np.int64), np.arange(len(keys)), keys & U(len(self.keys) - 1)
        while len(rest):
            number = self.numbers[slot]
            same = (self.keys[slot] == keys[rest]) & (number >= 0)
            found[rest[same]] = number[same]
            on = ~same & (number >= 0)
            rest, slot = rest[on], (slot[on] + U(1)) & U(len(self.keys) - 1)
        return found

    def add(self, keys: np.ndarray) -> None:
        """Add distinct hashes that are not there yet."""
        while 4 * (self.count + len(keys)) > 3 * len(self.keys):
            held = np.flatnonzero(self.numbers >= 0)
            old, numbers = self.keys[held], self.numbers[held]
            self.keys, self.numbers = np.zeros(2 * len(self.keys), U), np.full(2 * len(self.keys), -1, np.int32)
            self._put(old, numbers)
        self._put(keys, np.arange(self.count, self.count + len(keys), dtype=np.int32))
        self.count += len(keys)

    def _put(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        slot = keys & U(len(self.keys) - 1)
        while len(keys):
            free = self.numbers[slot] < 0
            self.numbers[slot[free]] = numbers[free]  # of several that come to a slot the last one stays
            won = free & (self.numbers[slot] == numbers)
            self.keys[slot[won]] = keys[won]
            keys, numbers, slot = keys[~won], numbers[~won], (slot[~won] + U(1)) & U(len(self.keys) - 1)


class Encoder:
    """Encodes with a tokenizer file; one for each worker process, see ``encoder``."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        made = json.loads(self.library.to_str())
        self.model = self.library.model
        self.added = [t["content"] for t in made["added_tokens"]]
        self.alphabet = dict(enumerate(byte_alphabet()))
        steps, normal = made["pre_tokenizer"] or {}, made["normalizer"]
        inner = steps.get("pretokenizers") or [steps]
        if steps.get("type") == BYTE_LEVEL and steps["use_regex"] and not steps["add_prefix_space"] and not normal:
            self.lower = False
        elif [s["type"] for s in (normal or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and inner[0].get("pattern") == {"Regex": WORD_ENDS}:
            self.lower = True
        else:
            self.lower = None
        self.forget()

    def forget(self) -> None:
        self.places = Places()
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begins = np.zeros(1 << 16, np.int32)  # where each number's ids begin; they end where the next one's do
        self.letters = np.zeros(1 << 18, np.uint16)  # the remembered words one after another
        self.spelled = np.zeros(1 << 16, np.int64)  # where each number's word begins in them

    def shown(self, word: str) -> str:
        """A word in the alphabet of the vocabulary."""
        if word.isascii():
            if word.isalnum():
                return word
            if word[0] == " " and word[1:].isalnum():
                return self.alphabet[32] + word[1:]
        return word.encode().decode("latin-1").translate(self.alphabet)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that the pattern has split, and where each word's ids begin."""
        cut = self.model.tokenize
        found = [[token.id for token in cut(self.shown(w))] for w in words]
        return np.array([i for ids in found for i in ids], np.uint32), np.concatenate([[0], np.cumsum([len(ids) for ids in found], dtype=np.int64)])

    def learn(self, block: Split, hashes: np.ndarray, words: pa.Array, which: np.ndarray) -> None:
        """Remember ``words``, the different words ``which`` of a block."""
        spelled = block.spelled(which)
        for k in range(0, len(hashes), 5_000):
            ids, edges = self.merged(spelled[k:k + 5_000])
            letters, bounds = unpacked(words.slice(k, 5_000), np.uint16)
            at = self.places.count
            end = int(self.spelled[at])
            self.ids = _room(self.ids, self.used + len(ids))
            self.letters = _room(self.letters, end + len(letters))
            self.begins, self.spelled = _room(self.begins, at + len(edges)), _room(self.spelled, at + len(edges))
            self.ids[self.used:self.used + len(ids)] = ids
            self.letters[end:end + len(letters)] = letters
            self.begins[at:at + len(edges)], self.spelled[at:at + len(edges)] = edges + self.used, bounds + end
            self.places.add(hashes[k:k + 5_000])
            self.used += len(ids)

    def strange(self, place: np.ndarray, words: pa.Array) -> np.ndarray:
        """Which words are not the remembered word that has their hash."""
        held = np.flatnonzero(place >= 0)
        if not len(held):
            return held
        bounds = pa.py_buffer(self.spelled[:self.places.count + 1] * 2)
        known = pa.LargeBinaryArray.from_buffers(pa.large_binary(), self.places.count, [None, bounds, pa.py_buffer(self.letters)])
        own = words if len(held) == len(words) else words.take(pa.array(held))
        return held[~pc.equal(own, known.take(pa.array(place[held]))).to_numpy(zero_copy_only=False)]

    def known(self, block: Split, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them those of the different words of a block, or of ``some`` of them, begin and end."""
        words = block.words if some is None else block.words.take(pa.array(some))
        numbers = np.arange(len(words)) if some is None else some
        letters, edges = unpacked(words, np.uint16)
        hashes = spans(letters, edges[:-1], edges[1:])
        place = self.places.find(hashes)
        odd = self.strange(place, words)
        if len(odd) or self.places.count + len(hashes) > CACHE:
            self.forget()
            place[:] = -1
        new = np.flatnonzero(place < 0)
        if len(new):
            first = new[np.unique(hashes[new], return_index=True)[1]]
            self.learn(block, hashes[first], words.take(pa.array(first)), numbers[first])
            place[new] = self.places.find(hashes[new])
        values, begins, stops = self.ids, self.begins[place].astype(np.int64), self.begins[place + 1].astype(np.int64)
        if len(odd) or len(new) and len(first) < len(new):  # two words of this block may share a hash
            odd = self.strange(place, words)
            more, edges = self.merged(block.spelled(numbers[odd]))
            begins[odd], stops[odd] = edges[:-1] + len(values), edges[1:] + len(values)
            values = np.concatenate([values, more])
        return values, begins, stops

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, little-endian 32-bit numbers; a null text is empty."""
        texts = [t or "" for t in texts]
        if self.lower is None:
            return [np.array(e.ids, "<u4") for e in self.library.encode_batch(texts, add_special_tokens=False)]
        block = split(texts, self.lower, self.added)
        values, begins, ends = self.known(block)
        ids, edges = gather(values, begins[block.which], ends[block.which])
        cuts = edges[block.edges].tolist()
        rows = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        rest = np.flatnonzero(block.whole).tolist()
        for row, found in zip(rest, self.library.encode_batch([texts[r] for r in rest], add_special_tokens=False)):
            rows[row] = np.array(found.ids, "<u4")
        return rows


def gather(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of ``values`` one after another, and where each begins."""
    edges = np.concatenate([[0], np.cumsum(ends - starts)])
    return values[np.arange(edges[-1]) + np.repeat(starts - edges[:-1], ends - starts)], edges


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """The same values with room for ``size`` at least."""
    return values if size <= len(values) else np.concatenate([values, np.zeros(2 * size - len(values), values.dtype)])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]

"""Token ids of whole texts by the tokenizers library, which is asked once for each distinct word.

Both vocabularies here split a text before merging, and merge inside a piece only, so words can be encoded apart as
long as no piece reaches over a cut.  Real text repeats its words: they are split and numbered in Arrow, a worker
remembers the ids of those it has seen, and the text's ids are gathered by number.

* A vocabulary that drops white space and folds case is cut at ASCII white space.
* A byte-level vocabulary is cut before blanks.  A blank belongs to the word behind it; only where it stands between
  white space, or between white space and the end, can a piece reach over it, and such texts go to the library whole.
* Any other tokenizer gets its texts whole.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import spelled, word_hashes

#: Words a worker remembers before it starts anew.
REMEMBERED = 1_000_000

#: Bytes of text that are split at a time.
AT_ONCE = 4 << 20

_SPACES = r"\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WHITE = f"[{_SPACES}]"
#: Punctuation that closes words, and words that can be asked for together.
_CLOSING = ".,;:!?)]|*$%&#"
_ENDS = r"(?P<end>[.,;:!?)\]|*$%&#]+)\z"
_SOLID = f"[^<{_SPACES}]+"
_UNSURE = f"{_WHITE} (?:{_WHITE}|\\z)"
#: Words that are asked for in one text.
TOGETHER = 500


def _where(mask: pa.Array) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False).astype(bool)


def _cut(config: dict) -> str:
    """Where a tokenizer's texts can be cut: "white", "blank" or "never"."""
    split = config.get("pre_tokenizer") or {}
    normal = [n["type"] for n in (config.get("normalizer") or {}).get("normalizers", [])]
    if split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and config.get("normalizer") is None:
        return "blank"
    if normal == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in split.get("pretokenizers", [])] == ["Split", "ByteLevel"]:
        rule = split["pretokenizers"][0]
        if rule["behavior"] == "Removed" and rule["invert"] and r"\s" not in rule["pattern"]["Regex"].replace(r"[^\s", ""):
            return "white"
    return "never"


class Grown:
    """An array that values are put behind, with room ahead for more."""

    def __init__(self, dtype: type, first: tuple = ()):
        self.room, self.size = np.empty(1 << 10, dtype), 0
        self.extend(np.array(first, dtype))

    def extend(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.room):
            room = np.empty(max(size, len(self.room) * 3 // 2), self.room.dtype)
            room[: self.size] = self.values
            self.room = room
        self.room[self.size : size] = values
        self.size = size

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]


class Known:
    """Words, each with its place, and their ids: a table of places by hash, in arrays instead of Python objects.

    A word found by its hash is compared with the one remembered, so words that share a hash are told apart.
    """

    def __init__(self):
        self.hashes, self.ids, self.bounds = Grown(np.uint64), Grown(np.uint32), Grown(np.int64, (0,))
        self.data, self.starts = Grown(np.uint8), Grown(np.int64, (0,))
        self.slots = np.full(1 << 16, -1, np.int32)

    def __len__(self) -> int:
        return self.hashes.size

    def _enter(self, places: np.ndarray) -> None:
        last = len(self.slots) - 1
        slot = (self.hashes.values[places] & np.uint64(last)).astype(np.int64)
        while len(places):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = places[free]
            lost = self.slots[slot] != places
            places, slot = places[lost], (slot[lost] + 1) & last

    def add(self, words: pa.Array, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The places that the words get."""
        data, bounds = spelled(words)
        places = np.arange(len(self), len(self) + len(words))
        self.data.extend(data)
        self.starts.extend(self.starts.values[-1] + bounds[1:])
        self.ids.extend(ids)
        self.bounds.extend(self.bounds.values[-1] + np.cumsum(sizes))
        self.hashes.extend(hashes)
        if 2 * len(self) > len(self.slots):
            self.slots = np.full(1 << (4 * len(self) - 1).bit_length(), -1, np.int32)
            self._enter(np.arange(len(self)))
        else:
            self._enter(places)
        return places

    def places(self, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The words' places, -1 for those not remembered."""
        last, known = len(self.slots) - 1, self.hashes.values
        at, row, slot = np.full(len(words), -1), np.arange(len(words)), (hashes & np.uint64(last)).astype(np.int64)
        while len(row):
            place = self.slots[slot]
            used = place >= 0
            row, slot, place = row[used], slot[used], place[used]
            same = known[place] == hashes[row]
            at[row[same]] = place[same]
            row, slot = row[~same], (slot[~same] + 1) & last
        hits = np.flatnonzero(at >= 0)
        remembered = pa.LargeStringArray.from_buffers(len(self), pa.py_buffer(self.starts.values), pa.py_buffer(self.data.values))
        at[hits[~_where(pc.equal(words.take(pa.array(hits)), remembered.take(pa.array(at[hits]))))]] = -1
        return at

    def taken(self, places: np.ndarray) -> pa.Array:
        """A list of ids for each place."""
        return pa.LargeListArray.from_arrays(pa.array(self.bounds.values), pa.array(self.ids.values)).take(pa.array(places))


class TextEncoder:
    """``encode(texts)``: the ids of all texts one after the other, and where each text's begin (and the end)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.cut = _cut(json.load(f))
        vocabulary = self.library.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # a character stands for a byte in both
            self.bytes[i] = len(token.removesuffix("</w>") if self.cut == "white" else token)
        self.known = Known()

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: pa.Array, lengths: np.ndarray, between: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without white space inside, and how many each has: asked for in one text and told apart by their bytes.

        What stands between words is a piece of its own, or white space that the vocabulary drops.
        """
        gap = 1 if between == "\n" else 0
        cuts = pa.array([*range(0, len(words), TOGETHER), len(words)], pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(cuts, words), pa.scalar(between, pa.large_string())).to_pylist()
        ids, sizes = [], []
        for k, e in enumerate(self.library.encode_batch_fast(texts, add_special_tokens=False)):
            some = slice(k * TOGETHER, (k + 1) * TOGETHER)
            got = np.array(e.ids, np.uint32)
            ends = np.cumsum(self.bytes[got])
            last = np.cumsum(lengths[some] + gap) - gap
            at = np.searchsorted(ends, last)
            fits = len(got) > 0 and at[-1] == len(got) - 1 and (ends[at] == last).all()
            if fits and gap:  # one id stands for what is between
                fits = (ends[at[:-1] + 1] == last[:-1] + 1).all()
                keep = np.ones(len(got), bool)
                keep[at[:-1] + 1] = False
                got, at = got[keep], at - np.arange(len(at))
            if fits:
                ids.append(got)
                sizes.append(np.diff(at, prepend=-1))
            else:
                for part, out in zip(self._apart(words.slice(k * TOGETHER, TOGETHER)), (ids, sizes)):
                    out.append(part)
        return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64)

    def _apart(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = self.whole(words.to_pylist())
        return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.fromiter(map(len, ids), np.int64, len(ids))

    def _composed(self, *parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words whose parts, one after the other, have their ids, and how many each has."""
        different = pa.chunked_array(parts).combine_chunks().dictionary_encode()
        places = self._places(different.dictionary)[different.indices.to_numpy()]
        ids = self.known.taken(places.reshape(len(parts), -1).T.reshape(-1))
        return ids.flatten().to_numpy(), np.diff(ids.offsets.to_numpy()[:: len(parts)])

    def _learn(self, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The places of new words, each different.

        A word's closing punctuation is a piece of its own, and so is a single end of line between two words.
        """
        blank = self.cut == "blank"
        special = _where(pc.match_substring(words, "<|"))
        lines = _where(pc.match_substring_regex(words, f"\\A ?{_SOLID}\n{_SOLID}\\z")) & ~special if blank else np.zeros(len(words), bool)
        core = pc.utf8_rtrim(words, characters=_CLOSING)
        closed = _where(pc.less(pc.binary_length(core), pc.binary_length(words))) & _where(pc.utf8_is_alnum(pc.utf8_slice_codeunits(core, -1))) & ~special
        closed &= ~_where(pc.match_substring(words, "\n"))
        after = _where(pc.starts_with(words, " "))
        solid = _where(pc.match_substring_regex(words, f"\\A ?{_SOLID}\\z" if blank else f"\\A{_SOLID}\\z"))
        if not blank:
            solid &= _where(pc.string_is_ascii(words))
        places, lengths = np.empty(len(words), np.int64), pc.binary_length(words).to_numpy().astype(np.int64)
        rest = ~(lines | closed)

        def learn(mask: np.ndarray, ids_of: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> None:
            if mask.any():
                some = words.filter(pa.array(mask))
                places[mask] = self.known.add(some, hashes[mask], *ids_of(some))

        for mask, between in ((rest & solid & after, ""), (rest & solid & ~after, "\n")) if blank else ((rest & solid, " "),):
            learn(mask, lambda some: self._joined(some, lengths[mask], between))
        learn(rest & ~solid, self._apart)
        learn(closed, lambda some: self._composed(core.filter(pa.array(closed)), pc.extract_regex(some, _ENDS).field("end")))

        def halves(some: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            both = pc.split_pattern(some, "\n").flatten()
            at = np.arange(0, len(both), 2)
            return self._composed(both.take(pa.array(at)), pa.array(["\n"] * len(at), pa.large_string()), both.take(pa.array(at + 1)))

        learn(lines, halves)
        return places

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where each of some different words is remembered."""
        hashes = word_hashes(words)
        at = self.known.places(words, hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = self._learn(words.take(pa.array(new)), hashes[new])
        return at

    def _numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known = Known()
        blank = self.cut == "blank"
        cut = pc.split_pattern(texts, " ") if blank else pc.ascii_split_whitespace(pc.ascii_lower(texts))
        bounds = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary
        number = coded.indices.to_numpy().astype(np.int64)
        if blank:  # the first word of a text has no blank before it
            opening = words.take(coded.indices.take(pa.array(bounds[:-1]))).dictionary_encode()
            number[bounds[:-1]] = len(words) + opening.indices.to_numpy()
            words = pa.concat_arrays([pc.binary_join_element_wise(pa.scalar("", pa.large_string()), words, pa.scalar(" ", pa.large_string())), opening.dictionary])
        ids = self.known.taken(self._places(words)[number])
        return ids.flatten().to_numpy(), ids.offsets.to_numpy()[bounds]

    def parts(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The texts in stretches of a few megabytes: the first one's number, their ids, and where each text's begin (and the end)."""
        texts = texts.cast(pa.large_string())
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(texts):
            done = size[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(size, done + AT_ONCE, side="right")))
            some = texts.slice(first, last - first)
            unsure = np.ones(len(some), bool)
            if self.cut != "never":
                unsure = np.zeros(len(some), bool) if self.cut == "white" else pc.match_substring_regex(some, _UNSURE).to_numpy(zero_copy_only=False)
            if unsure.any():
                ids = [None] * len(some)
                sure = np.flatnonzero(~unsure)
                flat, bounds = self._numbered(some.take(pa.array(sure))) if len(sure) else (None, None)
                for k, i in enumerate(sure):
                    ids[i] = flat[bounds[k] : bounds[k + 1]]
                for i, x in zip(np.flatnonzero(unsure), self.whole(some.filter(pa.array(unsure)).to_pylist())):
                    ids[i] = x
                yield first, np.concatenate(ids), np.concatenate(([0], np.cumsum([len(x) for x in ids])))
            else:
                yield first, *self._numbered(some)
            first = last

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flats, starts, total = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)], 0
        for _, flat, bounds in self.parts(texts):
            flats.append(flat)
            starts.append(bounds[1:] + total)
            total += len(flat)
        return np.concatenate(flats), np.concatenate(starts)


@functools.cache
def encoder(path: str) -> TextEncoder:
    """One encoder for each file and worker, kept over its tasks."""
    return TextEncoder(path)

"""Token ids of whole texts, with every distinct piece of a batch tokenized once."""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of texts that are cut and numbered at a time; one longer text goes alone.
SLICE = 4_000_000
#: Distinct pieces kept between batches, and characters of them; beyond that a cache starts anew.
KEPT, KEPT_LENGTH = 400_000, 8_000_000
#: Pieces tokenized as one line.
LINE = 256

# white space before a space, and a space in front: texts that a cut at every space would cut wrongly
_ODD = r"(^|[\s\x0b\x1c-\x1f\x{85}\pZ]) "
_CUT = re.compile(r"(?<=\S)(?= )")


def one_thread() -> None:
    """Keep tokenizers in Python workers to the core of their task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, pa.Array]]:
    """Start and texts of runs of about ``most`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def split_words(texts: pa.Array) -> pa.ListArray:
    """What lies between ASCII white space, for tokenizers that drop white space."""
    return pc.ascii_split_whitespace(texts)


def split_units(texts: pa.Array) -> pa.ListArray:
    """The runs of a space and the text behind it that ``" " + text`` consists of, without that space.

    A run starts at a space that follows something visible. Byte-level tokenizers cut there, and
    so do piece tokenizers none of whose pieces has a space behind another character; white space
    in a row stays together. Tokens of a text are those of its units, one after the other.
    """
    cut = pc.split_pattern(texts, " ")
    odd = np.flatnonzero(pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False))
    if not len(odd):
        return cut
    own = [[unit[1:] for unit in _CUT.split(" " + text)] for text in texts.take(pa.array(odd)).to_pylist()]
    order = np.arange(len(texts))
    order[odd] = len(texts) + np.arange(len(odd))
    return pa.concat_arrays([cut, pa.array(own, cut.type)]).take(pa.array(order))


class Ragged:
    """Lists of numbers, one behind the other in a growing array."""

    def __init__(self, kind: type):
        self.values, self.used = np.zeros(1024, kind), 0
        self.starts, self.sizes, self.lists = np.zeros(256, np.int64), np.zeros(256, np.int64), 0

    @staticmethod
    def _room(array: np.ndarray, needed: int) -> np.ndarray:
        while needed > len(array):
            array = np.concatenate([array, np.zeros_like(array)])
        return array

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values = self._room(self.values, self.used + len(values))
        self.values[self.used : self.used + len(values)] = values
        stop = self.lists + len(sizes)
        self.starts, self.sizes = self._room(self.starts, stop), self._room(self.sizes, stop)
        self.starts[self.lists : stop] = self.used + np.cumsum(sizes) - sizes
        self.sizes[self.lists : stop] = sizes
        self.used, self.lists = self.used + len(values), stop

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the lists ``at``, one behind the other, and the size of each list."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self.starts[at] - (ends - sizes), sizes)
        places += np.arange(total)
        return self.values[places], sizes


class Numbered:
    """Numbers of distinct pieces, and what ``learn`` keeps of each new one.

    ``learn`` takes new pieces in the order of their numbers; ``forget`` drops all it has kept.
    """

    def __init__(self, learn: Callable[[list[str]], None], forget: Callable[[], None]):
        self.learn, self.forget, self.index, self.held = learn, forget, {}, 0
        forget()

    def numbers(self, pieces: pa.Array) -> np.ndarray:
        if self.held > KEPT_LENGTH or len(self.index) > KEPT:
            self.index, self.held = {}, 0
            self.forget()
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist
        new = [piece for piece in distinct if piece not in self.index]
        if new:
            self.learn(new)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.held += sum(map(len, new))
        table = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        return table[coded.indices.to_numpy()]


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of the given sizes."""
    ends = np.cumsum(sizes)
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[ends - sizes]


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes


@cache
def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Visible characters of Latin-1 stand for themselves, the other bytes for those from U+0100 on, in order.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(byte if byte in visible else next(others)) for byte in range(256)]


@cache
def _line_letters() -> str:
    """Byte letters for the bytes of a line; spaces stay, and a zero stands for a space within a piece."""
    letters = byte_letters()
    return letters[0x20] + "".join(letters[1:0x20]) + " " + "".join(letters[0x21:])


# Letters without other forms, and signs that stay together behind them. Tokenizers cut such a piece
# into the letters and the signs, whatever their patterns are besides.
_LETTERS, SIGNS = r"A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF", ".,;:!?%$&*#"
_SIMPLE = re.compile(f"[{_LETTERS}]+[{SIGNS}]*")
_BEFORE_SIGNS = re.compile(f"(?<=[{_LETTERS}])(?=[{SIGNS}])")


def simple(piece: str) -> bool:
    return (piece.isascii() and piece.isalpha()) or _SIMPLE.fullmatch(piece) is not None


class Lines:
    """Ids of simple pieces by the tokenizer's own model, many to a line.

    The lines are cut at spaces instead of by the tokenizer's patterns, which takes a quarter of the time.
    """

    def __init__(self, path: str, spaced: bool, lower: bool):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.before, self.lower = "\0" if spaced else "", lower
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.normalizer = normalizers.Sequence([])
        self.tokenizer.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")

    def ids(self, pieces: list[str]) -> np.ndarray:
        lines = []
        for at in range(0, len(pieces), LINE):
            line = self.before + f" {self.before}".join(pieces[at : at + LINE])
            line = _BEFORE_SIGNS.sub(" ", line.lower() if self.lower else line)
            lines.append(codecs.charmap_decode(line.encode(), "strict", _line_letters())[0])
        encoded = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        return flat([e.ids for e in encoded])[0]


def simple_first(pieces: list[str], of_simple: Callable, alone: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Ids and sizes of pieces: simple ones by ``of_simple``, all others by ``alone``."""
    is_simple = list(map(simple, pieces))
    if all(is_simple):
        return of_simple(pieces) if pieces else flat([])
    both, order = Ragged(np.uint32), np.argsort(~np.array(is_simple), kind="stable")
    if any(is_simple):
        both.extend(*of_simple(list(compress(pieces, is_simple))))
    both.extend(*alone([piece for piece, own in zip(pieces, is_simple) if not own]))
    return both.take(np.argsort(order))


class WordIds:
    """Ids of texts by a lower-casing tokenizer that drops white space and marks ends of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        one_thread()
        self.tokenizer = Tokenizer.from_file(path)
        self.lines = Lines(path, spaced=False, lower=True)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.words = Numbered(self._learn, self._forget)

    def _forget(self) -> None:
        self.kept = Ragged(np.uint32)

    def _simple(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.lines.ids(words)
        parts = np.fromiter((1 + (word[-1] in SIGNS) for word in words), np.int64, len(words))
        ends = np.flatnonzero(self.ends[ids])[np.cumsum(parts) - 1]
        return ids, np.diff(ends, prepend=-1)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat([e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)])

    def _learn(self, words: list[str]) -> None:
        self.kept.extend(*simple_first(words, self._simple, self._alone))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row and their number in each."""
        pieces = split_words(texts)
        numbers = self.words.numbers(pieces.flatten())  # may start ``kept`` anew
        values, sizes = self.kept.take(numbers)
        return values, sums(sizes, pc.list_value_length(pieces).to_numpy().astype(np.int64))


class UnitIds:
    """Ids of texts by a byte-level tokenizer, unit by unit; see ``split_units``.

    ``special_as_text`` takes the strings of special tokens in texts for ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        one_thread()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            # special tokens are not spelled in byte letters
            if all(letter in byte_of for letter in token):
                self.bytes[i] = bytes(byte_of[letter] for letter in token)
        self.starts = np.array([own[:1] == b" " for own in self.bytes])
        self.lines = Lines(path, spaced=True, lower=False)
        self.units = Numbered(self._learn, self._forget)

    def _forget(self) -> None:
        self.kept = Ragged(np.uint32)

    def _learn(self, units: list[str]) -> None:
        self.kept.extend(*self.of_units(units))

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def _simple(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.lines.ids(units)
        starts = np.flatnonzero(self.starts[ids])  # only first tokens begin with the space
        return ids, np.diff(starts, append=len(ids))

    def of_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each unit, given without the space in front."""
        return simple_first(units, self._simple, lambda some: self._encode([" " + unit for unit in some]))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row and their number in each."""
        units = split_units(texts)
        size = pc.list_value_length(units).to_numpy().astype(np.int64)
        every = units.flatten()
        # a text begins without a space
        first = np.zeros(len(every), bool)
        first[np.cumsum(size) - size] = True
        values, sizes = self._encode(every.filter(pa.array(first)).to_pylist())
        numbers = self.units.numbers(every.filter(pa.array(~first)))  # may start ``kept`` anew
        more, more_sizes = self.kept.take(numbers)
        both = Ragged(np.uint32)
        both.extend(values, sizes)
        both.extend(more, more_sizes)
        order = np.empty(len(every), np.int64)
        order[first], order[~first] = np.arange(len(size)), np.arange(len(size), len(every))
        values, sizes = both.take(order)
        return values, sums(sizes, size)


@cache
def word_ids(path: str) -> WordIds:
    """One for all tasks of a Python worker."""
    return WordIds(path)


@cache
def unit_ids(path: str) -> UnitIds:
    """One for all tasks of a Python worker."""
    return UnitIds(path)

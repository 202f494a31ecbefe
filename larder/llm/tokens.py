"""Whole texts to token ids with a public tokenizer file, at corpus speed.

The tokenizers library spends microseconds on every word, and a corpus repeats
its words. Texts are therefore cut at blanks that no token of the given file can
span, each distinct piece is encoded once by the library, and a text's ids are
its pieces' ids in a row. The result equals encoding the whole text at once.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np

#: Distinct pieces of a generation. A Python worker keeps the current generation and
#: the one before, so frequent pieces stay and its memory is bounded.
CACHED_PIECES = 800_000

#: White space that is neither a blank nor a line end; looking for one after the other
#: is faster than a pattern that looks for all.
OTHER_SPACE = [chr(i) for i in range(0x3001) if chr(i).isspace() and chr(i) not in " \n"]
#: Blanks between two visible characters: no token reaches across from before them.
SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")


def evenly_spaced(text: str) -> bool:
    """Whether every blank and line end stands alone between two visible characters."""
    return not (
        "  " in text
        or "\n\n" in text
        or text[0] == "\n"
        or text[-1] == "\n"
        or " \n" in text
        or "\n " in text
        or text[0] == " "
        or text[-1] == " "
        or any(map(text.__contains__, OTHER_SPACE))
    )


#: Letters that are their own composed form and have a lower case of one letter, and
#: marks that never start a contraction or a special token. A run of either is one
#: unit of both public tokenizers, and so is a line end before a visible character.
LETTERS, MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", "[.,;:!?()#*$%&|\"-]+"
PLAIN = re.compile(rf" ?{LETTERS}| ?{MARKS}|\n(?=\S)")
#: Most pieces: a word, and the marks behind it.
WORD = re.compile(rf"(\n?)( ?{LETTERS})({MARKS})?")


class _Made(dict):
    """Values made from their keys on first use."""

    def __init__(self, make: Callable[[str], object]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> object:
        value = self[key] = self.make(key)
        return value


class _Numbers(dict):
    """Piece to running number; unknown pieces get the next one and are kept as new.

    Where a blank joins the word after it, a plain key stands for the word with its
    blank; keys that begin with a line end and tuples of one are pieces as they are.
    """

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str | tuple[str]] = []

    def __missing__(self, piece: str | tuple[str]) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class TextEncoder:
    """Encodes many texts with one tokenizer file.

    ``blank_joins`` says that a blank belongs to the word after it, as in
    byte-level vocabularies; otherwise blanks carry no token at all.
    """

    def __init__(self, path: str, blank_joins: bool, cached: int = CACHED_PIECES) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.bytes_shown = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = _Made(lambda letter: self.bytes_shown.pre_tokenize_str(letter)[0][0])
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.blank_joins = blank_joins
        self.cached = cached
        self._begin()

    def _begin(self) -> None:
        """Begin a generation; pieces met again are copied from the one before."""
        self.old = getattr(self, "numbers", {}), getattr(self, "starts", None), getattr(self, "ids", None)
        self.numbers = _Numbers()
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.filled = 0
        self.units = _Made(self._unit)

    def _unit(self, unit: str) -> bytes:
        """The ids of one plain unit, by the library's model itself."""
        if not self.blank_joins:
            unit = unit.strip().lower()
            if not unit:
                return b""
        shown = "".join(map(self.letters.__getitem__, unit))
        return array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()

    def _whole(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces that are not made of plain units, by the whole tokenizer."""
        encoding = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(encoding.ids, np.uint32)
        owners = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
        cuts = np.searchsorted(owners, np.arange(len(pieces) + 1))
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _encode_new(self) -> None:
        """Encode the pieces met for the first time and append their ids to the table."""
        new, self.numbers.new = self.numbers.new, []
        if not new:
            return
        units, got, odd = self.units, [], []
        old, old_starts, old_ids = self.old
        for at, key in enumerate(new):
            before = old.get(key)
            if before is not None:
                got.append(old_ids[old_starts[before] : old_starts[before + 1]].tobytes())
                continue
            piece = key
            if self.blank_joins:
                piece = key[0] if isinstance(key, tuple) else key if key[0] == "\n" else " " + key
            word = WORD.fullmatch(piece)
            if word:
                line, letters, marks = word.groups()
                ids = units[letters]
                if marks:
                    ids += units[marks]
                got.append(units[line] + ids if line else ids)
                continue
            parts = PLAIN.findall(piece)
            if sum(map(len, parts)) != len(piece):
                odd.append((at, piece))
                got.append(b"")
                continue
            got.append(b"".join(map(units.__getitem__, parts)))
        if odd:
            for (at, _), ids in zip(odd, self._whole([piece for _, piece in odd]), strict=True):
                got[at] = ids
        first, last = len(self.numbers) - len(new), len(self.numbers)
        if last + 1 > len(self.starts):
            self.starts = np.resize(self.starts, max(last + 1, 2 * len(self.starts)))
        counts = np.fromiter(map(len, got), np.int64, len(got)) // 4
        self.starts[first + 1 : last + 1] = self.starts[first] + np.cumsum(counts)
        fresh = np.frombuffer(b"".join(got), np.uint32)
        if self.filled + len(fresh) > len(self.ids):
            grown = np.zeros(max(self.filled + len(fresh), 2 * len(self.ids)), np.uint32)
            grown[: self.filled] = self.ids[: self.filled]
            self.ids = grown
        self.ids[self.filled : self.filled + len(fresh)] = fresh
        self.filled += len(fresh)

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each text (NULL: none)."""
        if len(self.numbers) > self.cached:
            self._begin()
        numbers, lookup = self.numbers, self.numbers.__getitem__
        found, sizes = [], []
        for text in texts:
            if not text:
                sizes.append(0)
                continue
            if not self.blank_joins:
                pieces = text.replace("\n", " ").split(" ")
            elif evenly_spaced(text):
                pieces = text.replace("\n", " \n").split(" ")
                pieces[0] = (pieces[0],)
            else:
                pieces = [(piece,) for piece in SAFE_CUT.split(text)]
            found.append(np.fromiter(map(lookup, pieces), np.int64, len(pieces)))
            sizes.append(len(pieces))
        self._encode_new()
        at = np.concatenate(found) if found else np.zeros(0, np.int64)
        starts = self.starts[at]
        lengths = self.starts[at + 1] - starts
        ids = self.ids[ragged(starts, lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return ids, np.diff(ends[edges])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, in a row."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


_ENCODERS: dict[tuple[str, bool, int], TextEncoder] = {}


def encoder(path: str, blank_joins: bool, cached: int = CACHED_PIECES) -> TextEncoder:
    """The worker's encoder of a file; a worker keeps it from task to task."""
    key = (path, blank_joins, cached)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(path, blank_joins, cached)
    return _ENCODERS[key]


def chunks(texts: Sequence[str | None], characters: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters, at least one text each."""
    start = held = 0
    for at, text in enumerate(texts):
        held += len(text or "")
        if held >= characters:
            yield start, at + 1
            start, held = at + 1, 0
    if start < len(texts):
        yield start, len(texts)

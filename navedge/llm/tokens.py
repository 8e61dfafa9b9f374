"""Fast exact use of a tokenizer file: the library encodes each distinct word once a task.

A text is cut where the tokenizer's own pre-tokenisation always cuts, the
library encodes each distinct piece, and its ids are kept as little-endian
32-bit integers, so that encoding a text is mostly a join of byte strings.
Texts in which such cuts could change the result go to the library whole.
The cache has two generations of at most so many pieces (``CACHE_UNITS``): when the new
one is full it becomes the old one, and pieces met again move back.
"""

from __future__ import annotations

import re
import sys
import types
from array import array

CACHE_UNITS = 275_000
#: Pieces of the vocabulary for whole columns (about 50 MB), and bytes of texts encoded together.
VOCABULARY_UNITS = 600_000
TOGETHER_BYTES = 6 << 20
#: Longer pieces are rarely met again and not kept.
KEPT_CHARS = 14

#: White space other than blanks and line feeds: pre-tokenisers may not agree on it.
_ODD = re.compile(r"[\t\r\v\f\x1c-\x1f\x85\xa0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000]")
_ODD_WIDE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000]")
#: Runs of white space that a cut before each blank and line feed could split.
_RUNS = re.compile(r"[ \n]{3}|[ \n]{2}\Z")
#: Either of them, for Arrow's expressions.
_RISKY_RE2 = (r"[\t\r\v\f\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
              r"|[ \n]{3}|[ \n]{2}\z")
_WORD = re.compile(r"[^ \t\n\r\f\v]+")
#: A word that is one pre-token, with or without what may stand before it, and marks that are one more.
#: Normal forms and lower case of these letters hold no surprise.
_SIMPLE = re.compile(r"(\n?)([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)\Z")


def _byte_letters(lower: bool) -> dict[int, str]:
    """Code point below 256 -> letters that stand for its UTF-8 bytes in a byte-level vocabulary.

    A byte that prints stands for itself, the others for code points from 256 up.
    """
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    letter = {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(letter[b] for b in (chr(c).lower() if lower else chr(c)).encode()) for c in range(256)}


class _Pieces(dict):
    """piece -> ids; ``blank`` stood before each piece that doesn't start with a line feed."""

    def __init__(self, encoder: Encoder, blank: str):
        self.encoder, self.blank, self.old = encoder, blank, {}
        self.tokenize, self.letter, self.lower = encoder.tokenize, encoder.blanks[blank], not encoder.keeps_spaces

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            if piece.isascii() and piece.isalpha():  # most pieces; the byte letters are the letters themselves
                out = array("I", [t.id for t in self.tokenize(self.letter + (piece.lower() if self.lower else piece))]).tobytes()
            else:
                out = self.encoded(piece)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= self.encoder.cache_units:
                self.old = dict(self)
                self.clear()
            self[piece] = out
        return out

    def encoded(self, piece: str) -> bytes:
        encoder, simple = self.encoder, _SIMPLE.match(piece)
        if not simple:
            return encoder.whole(piece if piece[:1] == "\n" else self.blank + piece)
        feed, word, marks = simple.groups()
        if marks:
            return self[feed + word] + encoder.mark(marks)
        if feed:
            return encoder.mark(feed) + encoder.word(word, "")
        return encoder.word(word, self.blank)


class Encoder:
    """Ids of whole texts, as little-endian 32-bit integers in bytes, by a file of the ``tokenizers`` library."""

    def __init__(self, path: str, keeps_spaces: bool, cache_units: int = CACHE_UNITS,
                 vocabulary_units: int = VOCABULARY_UNITS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.vocabulary_units = vocabulary_units
        self.cache_units, self.vocabulary, self.blank = cache_units, None, " " if keeps_spaces else ""
        self.tokenize, self.keeps_spaces = self.tokenizer.model.tokenize, keeps_spaces
        self.letters = _byte_letters(lower=not keeps_spaces)
        self.blanks = {"": "", " ": self.letters[ord(" ")]}
        self.first, self.rest, self.marks = _Pieces(self, ""), _Pieces(self, " "), {"": b""}

    def whole(self, text: str) -> bytes:
        """By the tokenizer with all its steps."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, text: str, blank: str) -> bytes:
        """One pre-token of simple letters, by the tokenizer's model alone."""
        return array("I", [t.id for t in self.tokenize(self.blanks[blank] + text.translate(self.letters))]).tobytes()

    def mark(self, text: str) -> bytes:
        if (ids := self.marks.get(text)) is None:
            ids = self.whole(text)
            if len(self.marks) < self.cache_units:
                self.marks[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not self.keeps_spaces:
            return b"".join(map(self.first.__getitem__, _WORD.findall(text) if _ODD_WIDE.search(text) else text.split()))
        if _ODD.search(text) or ("  " in text or "\n\n" in text or "\n " in text or " \n" in text) and _RUNS.search(text):
            return self.whole(text)
        # A piece starts at each blank, which it loses, and at each line feed, which it keeps.
        pieces = text.replace("\n", " \n").split(" ")
        first = self.first[pieces.pop(0)]
        return first + b"".join(map(self.rest.__getitem__, pieces))

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [self.encode(x) for x in texts]


    def fresh(self, piece: str) -> bytes:
        """A piece, after a blank if pieces keep theirs; only the word before marks is looked for in the cache."""
        if piece.isascii() and piece.isalpha():
            return self.word(piece, self.blank)
        return (self.rest if self.blank else self.first).encoded(piece) if piece or self.blank else b""

    def column(self, texts, end_id: int):
        """(ids of all texts of an Arrow column one after another, number of ids of each), an end id after each text.

        Arrow cuts and numbers the pieces and finds the distinct ones in the vocabulary; only new ones reach Python,
        and the ids are gathered by number.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        pa.set_memory_pool(pa.system_memory_pool())  # it gives large blocks back
        vocabulary = self.vocabulary = self.vocabulary or _Vocabulary(self.vocabulary_units)
        texts = pc.fill_null(texts, "")
        if self.keeps_spaces:
            risky = pc.match_substring_regex(texts, pattern=_RISKY_RE2)
            plain = pc.if_else(risky, "", texts)
            cut = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        else:
            cut = pc.ascii_split_whitespace(texts)
        bounds = cut.offsets.to_numpy()
        flat, bounds = cut.values.slice(bounds[0], bounds[-1] - bounds[0]), bounds - bounds[0]
        numbered = flat.dictionary_encode()
        begin, sizes, missing = vocabulary.find(numbered.dictionary)
        new = numbered.dictionary.filter(pa.array(missing))
        known, firsts = list(map(self.fresh, new.to_pylist())), []
        if self.keeps_spaces:
            # A text's first piece had no blank before it; a risky text is all in its first piece.
            whole = {i: texts[i].as_py() for i in np.flatnonzero(risky.to_numpy(zero_copy_only=False)).tolist()}
            firsts = flat.take(pa.array(bounds[:-1])).to_pylist()
            known += [self.whole(whole[i]) if i in whole else self.first[x] for i, x in enumerate(firsts)]
        new_sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        new_ids = np.frombuffer(b"".join(known), "<u4")
        new_begin = len(vocabulary.ids) + np.cumsum(new_sizes) - new_sizes
        begin[missing], sizes[missing] = new_begin[:len(new)], new_sizes[:len(new)]
        begin, sizes = np.concatenate((begin, new_begin[len(new):])), np.concatenate((sizes, new_sizes[len(new):]))
        number = numbered.indices.to_numpy().astype(np.int64)
        if firsts:
            number[bounds[:-1]] = len(numbered.dictionary) + np.arange(len(firsts))
        each = sizes[number]
        ids = _gathered(np.concatenate((vocabulary.ids, new_ids)), begin[number], each)
        ends = np.concatenate(([0], np.cumsum(each)))[bounds]
        vocabulary.add(new, new_ids, new_begin[:len(new)] - len(vocabulary.ids), new_sizes[:len(new)])
        return np.insert(ids, ends[1:], end_id), np.diff(ends) + 1


def _gathered(ids, begin, sizes):
    """The runs of ids that begin and have sizes as given, one after another."""
    import numpy as np

    upto = np.cumsum(sizes)
    total = int(upto[-1]) if len(upto) else 0
    kind = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64
    at = np.arange(total, dtype=kind)
    at += np.repeat((begin - (upto - sizes)).astype(kind), sizes)
    return ids[at]


class _Vocabulary:
    """Pieces with their ids, in Arrow and numpy arrays; beyond ``most`` the half that was met last stays."""

    def __init__(self, most: int):
        import numpy as np
        import pyarrow as pa

        self.most, self.turn = most, 0
        self.pieces, self.ids = pa.array([], pa.string()), np.empty(0, "<u4")
        self.begin, self.sizes, self.met = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def find(self, pieces):
        """(begin, size, whether it is missing) of each distinct piece."""
        import numpy as np
        import pyarrow.compute as pc

        self.turn += 1
        place = pc.fill_null(pc.index_in(pieces, value_set=self.pieces), -1).to_numpy().astype(np.int64)
        missing = place < 0
        self.met[place[~missing]] = self.turn
        begin, sizes = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        begin[~missing], sizes[~missing] = self.begin[place[~missing]], self.sizes[place[~missing]]
        return begin, sizes, missing

    def add(self, pieces, ids, begin, sizes) -> None:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        short = pc.less_equal(pc.utf8_length(pieces), KEPT_CHARS)
        at = short.to_numpy(zero_copy_only=False)
        kept = _gathered(ids, begin[at], sizes[at])
        self.pieces = pa.concat_arrays([self.pieces, pieces.filter(short)])
        self.begin = np.concatenate((self.begin, len(self.ids) + np.cumsum(sizes[at]) - sizes[at]))
        self.ids, self.sizes = np.concatenate((self.ids, kept)), np.concatenate((self.sizes, sizes[at]))
        self.met = np.concatenate((self.met, np.full(int(at.sum()), self.turn)))
        if len(self.met) > self.most:
            stay = np.sort(np.argsort(-self.met, kind="stable")[:self.most // 2])
            self.ids = _gathered(self.ids, self.begin[stay], self.sizes[stay])
            self.pieces, self.sizes, self.met = self.pieces.take(pa.array(stay)), self.sizes[stay], self.met[stay]
            self.begin = np.cumsum(self.sizes) - self.sizes


def together(parts, size: int = TOGETHER_BYTES):
    """(doc_ids, texts) of neighbouring record batches, about ``size`` bytes of texts at a time."""
    import pyarrow as pa

    def joined(some):
        return (pa.concat_arrays([p.column(n) for p in some]) for n in ("doc_id", "text"))

    waiting, so_far = [], 0
    for part in parts:
        waiting.append(part)
        so_far += part.column("text").nbytes
        if so_far >= size:
            yield joined(waiting)
            waiting, so_far = [], 0
    if waiting:
        yield joined(waiting)


def worker_encoder(path: str, keeps_spaces: bool) -> Encoder:
    """One encoder for each Python worker and file: later tasks of the worker find its cache."""
    kept = sys.modules.setdefault("_navedge_encoders", types.ModuleType("_navedge_encoders")).__dict__
    if (path, keeps_spaces) not in kept:
        kept[path, keeps_spaces] = Encoder(path, keeps_spaces)
    return kept[path, keeps_spaces]

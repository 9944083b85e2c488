"""Token ids by the tokenizers library, with a memory of the words seen.

Words are found, hashed and looked up for a whole slice of texts at once; the library sees
only words that are not remembered, and texts with irregular white space.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import pyarrow as pa

from tripstats.llm.arrays import U64, hash_spans, mix, text_bytes

#: Words remembered by one Python worker, about 70 bytes each; above it the half that was not
#: seen for longest is forgotten.
MEMORY = 1_500_000

#: Words encoded in one call, parted by a mark that is a token of its own.
TOGETHER = 200
MARK = b"|"

# What stands before a word: a blank, a line end, or nothing (at the start of a text, and
# before a closing mark).
BLANK, LINE, NOTHING = range(3)
BEFORE = (b" ", b"\n", b"")

# White space other than blank and line end (fixed values): single bytes, and sequences of
# UTF-8 by their first two bytes.
_OTHER_SPACE = b"\0\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_WIDE_SPACE = {
    b"\xc2": (b"\x85", b"\xa0"),
    b"\xe1\x9a": (b"\x80",),
    b"\xe2\x80": (*(bytes([x]) for x in range(0x80, 0x8B)), b"\xa8", b"\xa9", b"\xaf"),
    b"\xe2\x81": (b"\x9f",),
    b"\xe3\x80": (b"\x80",),
}

_BYTES = np.arange(256)
_IS_OTHER = np.isin(_BYTES, list(_OTHER_SPACE))
_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
# Second bytes of the letters of Latin-1, whose first byte is C3: all but two signs.
_LATIN = (_BYTES >= 0x80) & (_BYTES <= 0xBF) & (_BYTES != 0x97) & (_BYTES != 0xB7)


def tokenizer_path(name: str) -> str:
    """A tokenizer file: a path, or the name of one of the public vocabulary files."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _any_within(places: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether some of the sorted places lies in each span."""
    return np.searchsorted(places, end) > np.searchsorted(places, start)


def _irregular(data: np.ndarray, is_cut: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with two blanks or line ends in a row, or any other white space."""
    odd = _IS_OTHER[data]
    odd[1:] |= is_cut[1:] & is_cut[:-1]
    for first, last in _WIDE_SPACE.items():
        at = np.flatnonzero(data[: len(data) - len(first)] == first[0])
        for k in range(1, len(first)):
            at = at[data[at + k] == first[k]]
        ends = np.frombuffer(b"".join(last), np.uint8)
        odd[at[np.isin(data[at + len(first)], ends)]] = True
    return _any_within(np.flatnonzero(odd), offsets[:-1], offsets[1:])


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of letters: ASCII and, both bytes of each, Latin-1."""
    found = _LETTER[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[_LATIN[data[second]]]
    found[second] = found[second - 1] = True
    return found


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, after: bytes) -> np.ndarray:
    """The bytes of all spans, each followed by the same few."""
    size = end - start
    stop = np.cumsum(size + len(after))
    place = np.repeat(start - (stop - size - len(after)), size + len(after)) + np.arange(stop[-1] if len(stop) else 0)
    out = data[np.minimum(place, max(len(data) - 1, 0))] if len(data) else np.zeros(len(place), np.uint8)
    for k, byte in enumerate(after):
        out[stop - len(after) + k] = byte
    return out


def _picked(data: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of data that belong to some rows, and where each ends, after a 0."""
    size = end[row + 1] - end[row]
    stop = np.r_[0, np.cumsum(size)]
    return data[np.repeat(end[row] - stop[:-1], size) + np.arange(stop[-1])], stop


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    Both public vocabularies split a text into words before anything else, and no word
    spans a change from another character to a blank or line end. So a text is cut there,
    each distinct word is encoded once by the library, and a text is the join of its
    words. A ``.`` or ``,`` after a plain letter or digit is a word of its own; after others it
    may not be, as folding turns some into a letter and a mark. A text with irregular white
    space is encoded whole.

    Words are looked up by 64 hash bits and then compared byte by byte.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        (self.mark,) = self.tokenizer.encode(" |", add_special_tokens=False).ids
        # The same model for words of letters alone, which are one piece each: given as pieces
        # already, in the bytes-as-letters form, they need no search for pieces.
        self.pieces = Tokenizer.from_file(tokenizer_path(name))
        self.pieces.normalizer = None
        self.pieces.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        (self.piece_mark,) = self.pieces.encode("|", add_special_tokens=False).ids
        as_letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.alphabet = np.arange(256, dtype="<u2")  # code points of bytes in that form
        for x in map(chr, range(0xC0, 0x100)):
            for byte, point in zip(x.encode(), as_letters.pre_tokenize_str(x)[0][0]):
                self.alphabet[byte] = ord(point)
        normal = self.tokenizer.normalizer
        self.folds = normal is not None and normal.normalize_str("Aa") == "aa"
        ((piece, _),) = self.tokenizer.pre_tokenizer.pre_tokenize_str(" a")
        self.lead = piece[:-1]  # how a piece shows the blank before it
        self.hash = np.zeros(0, U64)  # sorted
        self.row = np.zeros(0, np.int64)  # of each hash
        self.word_end = np.zeros(1, np.int64)  # in words, after a 0
        self.ids_end = np.zeros(1, np.int64)
        self.words = np.zeros(0, np.uint8)
        self.ids = np.zeros(0, "<u4")
        self.seen = np.zeros(0, np.int32)  # of each row, the slice that had it last
        self.slice = 0

    def _forget(self) -> None:
        """Keep the words that were seen last."""
        order = np.argsort(-self.seen[self.row], kind="stable")[: MEMORY // 2]
        kept = np.sort(order)
        self.hash, row = self.hash[kept], self.row[kept]
        self.words, self.word_end = _picked(self.words, self.word_end, row)
        self.ids, self.ids_end = _picked(self.ids, self.ids_end, row)
        self.seen, self.row = self.seen[row], np.arange(len(row))

    def _library(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _cut(self, data: np.ndarray, offsets: np.ndarray):
        """(start, end, kind, text) of the words of texts that are not irregular."""
        is_cut = (data == 0x20) | (data == 0x0A)
        whole = _irregular(data, is_cut, offsets) if len(data) else np.zeros(len(offsets) - 1, bool)
        at = np.flatnonzero(is_cut)
        heads = np.searchsorted(at, offsets[:-1])  # cuts before each text
        start = np.insert(at + 1, heads, offsets[:-1])
        kind = np.insert(np.where(data[at] == 0x20, BLANK, LINE), heads, NOTHING).astype(np.int8)
        text = np.insert(np.searchsorted(offsets, at, "right") - 1, heads, np.arange(len(offsets) - 1))
        end = np.r_[start[1:] - (kind[1:] != NOTHING), len(data)]
        last = np.r_[text[1:] != text[:-1], True] if len(text) else np.zeros(0, bool)
        end[last] = offsets[text[last] + 1]
        own = ~whole[text] & ((end > start) | (kind != NOTHING))
        start, end, kind, text = start[own], end[own], kind[own], text[own]

        mark = np.flatnonzero(end - start > 1)
        last = data[end[mark] - 1]
        mark = mark[(last == ord(".")) | (last == ord(","))]
        plain = (_LETTER | _DIGIT)[data[end[mark] - 2]]
        wide = (end - start)[mark] > 2
        plain |= wide & _LATIN[data[end[mark] - 2]] & (data[end[mark] - 3] == 0xC3)
        mark = mark[plain]
        end[mark] -= 1
        start, end = np.insert(start, mark + 1, end[mark]), np.insert(end, mark + 1, end[mark] + 1)
        kind, text = np.insert(kind, mark + 1, NOTHING), np.insert(text, mark + 1, text[mark])
        return start, end, kind, text, np.flatnonzero(whole)

    @staticmethod
    def _same(a: np.ndarray, a_start, a_end, b: np.ndarray, b_start, b_end) -> np.ndarray:
        """Whether the bytes of spans in a and b are the same."""
        same = a_end - a_start == b_end - b_start
        left, right = (np.ndarray((len(x) + 1,), "<u8", x.tobytes() + bytes(8), strides=(1,)) for x in (a, b))
        live, done = np.flatnonzero(same & (a_end > a_start)), 0
        while len(live):
            rest = (a_end - a_start)[live] - done
            diff = left[a_start[live] + done] ^ right[b_start[live] + done]
            short = np.minimum(rest, 8).astype(U64)
            diff <<= U64(64) - U64(8) * short  # bytes behind the span don't count
            same[live[diff != 0]] = False
            done += 8
            live = live[(rest > 8) & (diff == 0)]
        return same

    def _known_rows(self, data, start, end, kind, value) -> np.ndarray:
        """The remembered row of each word, or -1."""
        if not len(self.hash):
            return np.full(len(value), -1)
        at = np.minimum(np.searchsorted(self.hash, value), len(self.hash) - 1)
        row = np.where(self.hash[at] == value, self.row[at], -1)
        hit = np.flatnonzero(row >= 0)
        own = row[hit]
        same = self._same(data, start[hit], end[hit], self.words, self.word_end[own] + 1, self.word_end[own + 1])
        same &= self.words[self.word_end[own]] == kind[hit]
        row[hit[~same]] = -1
        return row

    def _remember(self, data, start, end, kind, value, letters) -> np.ndarray:
        """Encode the words of these spans, keep them, and return their rows."""
        size = end - start
        text = _joined(data, start, end, b"")
        held = np.zeros(len(text) + len(size), np.uint8)
        heads = np.cumsum(size + 1) - (size + 1)
        is_head = np.zeros(len(held), bool)
        is_head[heads] = True
        held[heads], held[~is_head] = kind, text

        alone = _any_within(np.flatnonzero(data == MARK[0]), start, end)
        alone |= (size == 0) | (kind == NOTHING)
        groups = [(np.flatnonzero(alone), *self._one_by_one(data, start[alone], end[alone], kind[alone]))]
        plain = ~alone & letters & (kind == BLANK)
        for own, before in ((plain, None), (~alone & ~plain & (kind == BLANK), b" "), (~alone & (kind == LINE), b"\n")):
            groups.append((np.flatnonzero(own), *self._together(data, start[own], end[own], before)))
        order, sizes, ids = (np.concatenate(x) for x in zip(*groups))

        n = len(self.ids_end) - 1
        row = np.empty(len(size), np.int64)
        row[order] = n + np.arange(len(order))
        self.words = np.concatenate([self.words, _joined(held, heads[order], heads[order] + size[order] + 1, b"")])
        self.word_end = np.concatenate([self.word_end, self.word_end[-1] + np.cumsum(size[order] + 1)])
        self.ids = np.concatenate([self.ids, ids])
        self.ids_end = np.concatenate([self.ids_end, self.ids_end[-1] + np.cumsum(sizes)])
        self.seen = np.concatenate([self.seen, np.zeros(len(size), np.int32)])
        at = np.searchsorted(self.hash, value)
        self.hash, self.row = np.insert(self.hash, at, value), np.insert(self.row, at, row)
        return row

    def _one_by_one(self, data, start, end, kind) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        spans = zip(start.tolist(), end.tolist(), kind.tolist())
        found = self._library([(BEFORE[k] + raw[a:b]).decode() for a, b, k in spans])
        none = np.zeros(0, "<u4")
        return np.array([len(x) for x in found], np.int64), np.concatenate([none, *found])

    def _together(self, data, start, end, before: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each word, all ids) of words with the same white space before them; None:
        words of letters with a blank before them, given as pieces."""
        after = b" | \0" if before is None else b" |" + before
        text = _joined(data, start, end, after).tobytes()
        ends = np.cumsum(end - start + len(after))
        ends = [*ends[TOGETHER - 1 :: TOGETHER].tolist(), len(text)]
        drop = 2 if before is None else len(before)
        lines = [text[a : b - drop] for a, b in zip([0, *ends], ends) if b > a]
        if before is None:
            mark, found = self.piece_mark, self._library(list(map(self._as_pieces, lines)), self.pieces)
        else:
            mark, found = self.mark, self._library([(before + x).decode() for x in lines])
        for x, ids in zip(lines, found):
            if np.count_nonzero(ids == mark) != x.count(MARK):
                raise ValueError("a word gave the id of the mark between words")
        ids = np.concatenate([np.zeros(0, "<u4"), *found])
        cut = np.flatnonzero(ids == mark)
        return np.diff(np.r_[-1, cut]) - 1, ids[ids != mark]

    def _as_pieces(self, line: bytes) -> str:
        """Words with a 0 between them as pieces with what shows a blank before each."""
        if self.folds:
            line = line.decode().lower().encode()
        points = self.alphabet[np.frombuffer(line, np.uint8)]
        return self.lead + points.tobytes().decode("utf-16-le").replace("\0", self.lead)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of every text."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        data, offsets = text_bytes(texts)
        start, end, kind, text, whole = self._cut(data, offsets)
        value = mix(hash_spans(data, start, end) + kind.astype(U64))
        order = np.argsort(value)
        value = value[order]
        head = np.ones(len(value), bool)
        head[1:] = value[1:] != value[:-1]
        number = np.empty(len(value), np.int64)
        number[order] = np.cumsum(head) - 1
        value, first = value[head], order[head]
        # words of one hash are one word, but for a clash: then its texts are encoded whole
        same = self._same(data, start, end, data, start[first][number], end[first][number])
        same &= kind == kind[first][number]
        whole = np.union1d(whole, text[~same])
        start, end, kind = start[first], end[first], kind[first]
        if len(self.row) > MEMORY:
            self._forget()
        self.slice += 1
        row = self._known_rows(data, start, end, kind, value)
        new = np.flatnonzero(row < 0)
        if len(new):
            # a word whose hash is that of another one remembered takes its place
            at = np.searchsorted(self.hash, value[new])
            at, wanted = at[at < len(self.hash)], value[new][at < len(self.hash)]
            clash = at[self.hash[at] == wanted]
            if len(clash):
                self.hash, self.row = np.delete(self.hash, clash), np.delete(self.row, clash)
            letter = np.r_[0, np.cumsum(_letters(data))] if len(data) else np.zeros(1, np.int64)
            letters = (letter[end[new]] - letter[start[new]] == (end - start)[new]) & (end > start)[new]
            row[new] = self._remember(data, start[new], end[new], kind[new], value[new], letters)
        self.seen[row] = self.slice
        row = row[number]
        ids, total = _picked(self.ids, self.ids_end, row)
        raw = ids.tobytes()
        cuts = total[np.searchsorted(text, np.arange(len(texts) + 1))] * 4
        out = [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        for i, ids in zip(whole.tolist(), self._library(texts.take(pa.array(whole)).to_pylist())):
            out[i] = ids.tobytes()
        return out


@cache
def encoder(name: str) -> Encoder:
    """One encoder per worker and vocabulary, kept between tasks."""
    return Encoder(name)

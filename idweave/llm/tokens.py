"""Token ids of texts, by their distinct words and pieces with bounded caches, as bytes of 2 or 4 an id.

For BPE tokenizers that split at white space before their model runs (the one
with word ends does): a text's ids are the ids of its words, in order. The
distinct words of a run of texts are cut into pieces where the kind of their
characters changes, if they hold only ASCII signs, digits and letters and
common Latin letters; each distinct piece goes to the model once. Other words
of Latin characters, and those with an apostrophe, are split by the
tokenizer's own pattern; any other word goes through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

CACHE_WORDS, CACHE_PIECES = 200_000, 600_000

#: Characters that no normaliser changes beyond lower case and no pattern treats as space.
_OTHER = regex.compile("[^\x21-\x7e¡-įı-ɏ]")
#: Ends a word in a run of ids, by bytes of an id: no id's high byte is 255, so no neighbours hold these bytes.
_LINE = {"H": b"\xff\xff", "I": b"\xff\xff\xff\xff"}
#: Kinds of bytes: letters (and both bytes of Latin ones), digits, signs; 0 for those of words that are not cut here.
_LETTER, _DIGIT, _SIGN = 1, 2, 3
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = _LETTER
_KIND[[*b"0123456789"]] = _DIGIT
_KIND[ord("'")] = 0
#: Letter bytes that are no letter as a pair: the signs for times and by, and the capital whose lower case is longer.
_PAIRS = [(0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0)]


def binary(sizes_end: np.ndarray, data: pa.Buffer | np.ndarray) -> pa.Array:
    """Byte strings that lie one after another in ``data``, from where each begins and the last ends."""
    return pa.Array.from_buffers(pa.large_binary(), len(sizes_end) - 1,
                                 [None, pa.py_buffer(sizes_end.astype(np.int64)), pa.py_buffer(data)])


def parts(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each byte string begins and the last ends; the bytes."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    return at - at[0], np.frombuffer(data if data is not None else b"", np.uint8)[at[0]:at[-1]]


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest for 256, 257, ..."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in printable else next(rest)) for b in range(256)}


class WordIds:
    """Little-endian ids of texts, unsigned 32-bit ("I") or 16-bit ("H"); holds about ``limit`` words, ``piece_limit`` pieces."""

    def __init__(self, path: str, limit: int = CACHE_WORDS, piece_limit: int = CACHE_PIECES, kind: str = "I"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer, self.limit, self.piece_limit = Tokenizer.from_file(path), limit, piece_limit
        self.kind, self.line = kind, _LINE[kind]
        assert kind == "I" or self.tokenizer.get_vocab_size() < 0xFF00, "ids need 32 bits"
        with open(path) as f:
            rules = json.load(f)
        split = rules["pre_tokenizer"]["pretokenizers"][0]
        assert split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"], "unknown pattern kind"
        self.pattern = regex.compile(split["pattern"]["Regex"] + "|\n")  # and the end of a line
        self.marks = tuple({t["content"][:2].encode() for t in rules["added_tokens"]})
        self.alphabet, self.model = byte_alphabet(), self.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.keys, self.ids = pa.array([], pa.large_binary()), pa.array([], pa.large_binary())  # the same as columns

    def model_ids(self, piece: str) -> bytes:
        """The ids of a piece, by the model."""
        mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
        return array(self.kind, [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def pieces_ids(self, found: set[str]) -> None:
        """Hold the ids of every piece in ``found``."""
        new = found - self.pieces.keys()
        if len(self.pieces) + len(new) > self.piece_limit:
            self.pieces.clear()
            new = found
        self.pieces.update((p, self.model_ids(p)) for p in new)

    def column_ids(self, found: pa.Array) -> pa.Array:
        """The ids of each of distinct pieces; what is not held yet is held then."""
        at = pc.index_in(found, value_set=self.keys).fill_null(-1).to_numpy().copy()
        new = at < 0
        if len(self.keys) + new.sum() > self.piece_limit:
            self.keys, self.ids = self.keys[:0], self.ids[:0]
            new[:] = True
        at[new] = np.arange(len(self.keys), len(self.keys) + new.sum())
        more = found.filter(pa.array(new))
        made = pa.array(map(self.model_ids, more.cast(pa.large_string()).to_pylist()), pa.large_binary())
        self.keys, self.ids = pa.concat_arrays([self.keys, more]), pa.concat_arrays([self.ids, made])
        return self.ids.take(pa.array(at))

    def learn(self, new: list[bytes]) -> None:
        """Encode words that are not held yet: all plain ones as the lines of one text."""
        if not new:
            return
        lines = b"\n".join(new).decode().split("\n")
        odd = {i for i, t in enumerate(lines) if _OTHER.search(t)} if _OTHER.search("".join(lines)) else set()
        odd |= {i for i, w in enumerate(new) if any(m in w for m in self.marks)} if any(
            m in b"\n".join(new) for m in self.marks) else set()
        plain = [i for i in range(len(new)) if i not in odd]
        found = self.pattern.findall("\n".join([lines[i] for i in plain]).lower())
        self.pieces_ids(set(found) - {"\n"})
        self.pieces["\n"] = self.line
        get = self.pieces.__getitem__
        self.words.update(zip([new[i] for i in plain], b"".join(map(get, found)).split(self.line)))
        rest = [lines[i] for i in sorted(odd)]
        for i, e in zip(sorted(odd), self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.words[new[i]] = array(self.kind, e.ids).tobytes()

    def cut_words(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words whose bytes all have a kind."""
        begin, data = parts(words)
        low = np.frombuffer(data.tobytes().decode().lower().encode(), np.uint8)  # as long as before
        kind = _KIND[low]
        new = np.empty(len(low), dtype=bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        new[begin[:-1]] = True
        cut = np.append(np.flatnonzero(new), len(low))
        each = binary(cut, low).dictionary_encode()
        at, held = parts(self.column_ids(each.dictionary).take(each.indices))
        return binary(at[np.searchsorted(cut, begin)], held)

    def words_ids(self, words: pa.Array) -> pa.Array:
        """The ids of each of distinct words."""
        begin, data = parts(words)
        bad = _KIND[data] == 0
        for a, b in [*_PAIRS, *(tuple(m[:2]) for m in self.marks)]:
            bad[:-1] |= (data[:-1] == a) & (data[1:] == b)
        before = np.concatenate([[0], np.cumsum(bad)])
        cut = (before[begin[1:]] == before[begin[:-1]]) & (begin[1:] > begin[:-1])
        other = words.filter(pa.array(~cut)).to_pylist()
        new = set(other) - self.words.keys()
        if len(self.words) + len(new) > self.limit:
            self.words.clear()
            new = set(other)
        self.learn(list(new - {b""}))
        self.words[b""] = b""
        ids = pa.concat_arrays([self.cut_words(words.filter(pa.array(cut))),
                                pa.array(map(self.words.__getitem__, other), pa.large_binary())])
        place = np.empty(len(cut), dtype=np.int64)
        place[cut], place[~cut] = np.arange(cut.sum()), np.arange(cut.sum(), len(cut))
        return ids.take(pa.array(place))

    def encode(self, values: list[bytes]) -> list[bytes]:
        """The ids of each text, as bytes."""
        split = pc.ascii_split_whitespace(pa.array(values, pa.large_binary()).cast(pa.large_string()))
        each = split.flatten().cast(pa.large_binary()).dictionary_encode()
        at, ids = parts(self.words_ids(each.dictionary).take(each.indices))
        sizes = pc.list_value_length(split).to_numpy()
        end = at[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(end, end[1:])]


@cache
def word_ids(path: str, kind: str = "I") -> WordIds:
    """One encoder for each worker process, vocabulary file and kind."""
    return WordIds(path, kind=kind)

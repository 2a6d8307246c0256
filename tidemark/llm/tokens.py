"""Token ids of whole texts by the tokenizers library, with distinct words encoded once.

Texts are cut where both vocabularies always cut: at spaces, between a letter or digit and an ASCII sign behind it, and
around a line feed between signs or letters. The places are found on the bytes of a slice of texts, and each distinct piece is
looked up among the known ones, of which a bounded number is kept. Pieces of plain Latin letters, digits and ASCII signs are split here by the vocabulary's
own pattern and go to the library's model; all others, and texts with runs of white space where the byte vocabulary
joins spaces, go through the library whole. The strings of special tokens are special ids, as the library's plain
call gives them (such texts go through the library whole too), or ordinary text if asked for.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"
#: Ends every document.
END_ID = 2
#: Bytes of the pieces that a worker knows, with their ids.
CACHE_BYTES = 16 << 20
SLICE_CHARS = 8 << 20

_LATIN = "À-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[\n!-~ {_LATIN}]*")
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_BYTE_PARTS = re.compile(
    rf"{_CONTRACTIONS}| ?[a-zA-Z{_LATIN}]+| ?[0-9]+| ?[^\sa-zA-Z0-9{_LATIN}]+|\s+(?!\S)|\s+"
)
#: Nearly all pieces.
_BYTE_SIMPLE = re.compile(rf" ?[a-zA-Z{_LATIN}]+")
_WORD_SIMPLE = re.compile(rf"[a-z{_LATIN}]+")
_WORD_PARTS = re.compile(rf"{_CONTRACTIONS}|[a-z{_LATIN}]+|[0-9]|[^\sa-z0-9{_LATIN}]+")
#: White space other than the space and the line feed.
_OTHER_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_RUNS = re.compile(r" \s|\s ")


def _joins_spaces(text: str) -> bool:
    """Whether a space stands beside other white space."""
    if "  " in text or " \n" in text or "\n " in text:
        return True
    return any(c in text for c in _OTHER_SPACES) and _RUNS.search(text) is not None


#: Classes of bytes that pieces are cut by. 0xC3 leads the Latin letters beyond ASCII, and two signs.
_SPACE, _LETTER, _SIGN, _LINE, _LEAD = range(1, 6)
_CLASSES = bytes(
    _LETTER if chr(b).isalnum() and b < 128 else _SIGN if 32 < b < 127 else {32: _SPACE, 10: _LINE, 0xC3: _LEAD}.get(b, 0)
    for b in range(256)
)


def _cuts(raw: np.ndarray) -> np.ndarray:
    """By byte of UTF-8, whether a piece begins there; the texts' own beginnings are left to the caller."""
    kind = np.frombuffer(raw.tobytes().translate(_CLASSES), np.uint8)
    cut = kind == _SPACE
    cut[1:] |= (kind[:-1] == _LETTER) & (kind[1:] == _SIGN)
    lead = np.flatnonzero(kind[:-2] == _LEAD)
    late = raw[lead + 1]
    cut[lead[(late != 0x97) & (late != 0xB7) & (kind[lead + 2] == _SIGN)] + 2] = True
    line = np.flatnonzero(kind[1:-1] == _LINE) + 1
    before, behind = kind[line - 1], kind[line + 1]
    line = line[((before == _LETTER) | (before == _SIGN)) & ((behind == _LETTER) | (behind == _SIGN))]
    cut[line] = cut[line + 1] = True
    return cut


def vocabulary_path(vocabulary: str) -> str:
    """The file itself if a path is given, else the installed public file of that name."""
    if os.sep in vocabulary:
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def _strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def _sizes(values: pa.Array) -> np.ndarray:
    return pc.binary_length(values).to_numpy()


class _Known:
    """Pieces with their ids as bytes, of at most ``limit`` bytes. Where they would be more, those used last stay, as far as they fit."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.names, self.values = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def values_of(self, pieces: pa.Array, make: Callable[[list[str]], list[bytes]]) -> pa.Array:
        """The value of every piece; ``make`` gives those of distinct new ones."""
        before = len(self.names)
        coded = pa.concat_arrays([self.names, pieces]).dictionary_encode()
        codes, names = coded.indices.slice(before), coded.dictionary
        values = pa.concat_arrays([self.values, pa.array(make(_strings(names.slice(before))), pa.large_binary())])
        taken = values.take(codes)
        if names.nbytes + values.nbytes > self.limit:
            used = np.zeros(len(names), bool)
            used[codes.to_numpy()] = True
            used = np.flatnonzero(used)
            sizes = 16 + (_sizes(names) + _sizes(values))[used]
            used = pa.array(used[np.cumsum(sizes) <= self.limit // 2])
            names, values = names.take(used), values.take(used)
        self.names, self.values = names, values
        return taken


class Encoder:
    """Encodes texts with one vocabulary. ``byte_level``: spaces belong to tokens, as opposed to being dropped.

    ``special_as_text``: whether the strings of special tokens are ordinary text.
    """

    def __init__(self, vocabulary: str, special_as_text: bool = False, cache: int = CACHE_BYTES) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.library.encode_special_tokens = special_as_text
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = None if special_as_text or not special else re.compile("|".join(map(re.escape, special)), re.IGNORECASE)
        self.byte_level = "Ġb" in self.library.encode("a b", add_special_tokens=False).tokens
        self.kind = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.letters = byte_letters()
        self.alphabet = np.array([ord(self.letters[b]) for b in range(256)], "<u4")
        self.simple = _BYTE_SIMPLE if self.byte_level else _WORD_SIMPLE
        self.known = _Known(cache)
        self.model = self.library.model

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _tokenize(self, parts: list[str]) -> list[bytes]:
        """The ids of parts the vocabulary's pattern gives, by the library's model.

        All are mapped to byte letters at once, divided by a byte that UTF-8 never uses.
        """
        raw = np.frombuffer(b"\xff".join([p.encode() for p in parts]), np.uint8)
        mapped = self.alphabet[raw].tobytes().decode("utf-32-le").split(self.letters[0xFF]) if parts else []
        tokenize, code = self.model.tokenize, self.code
        return [array(code, [t.id for t in tokenize(m)]).tobytes() for m in mapped]

    def _encode_new(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces: words of letters by the model, others by their parts or through the library whole."""
        if not self.byte_level:
            pieces = [p.removeprefix(" ") for p in pieces]
        texts = pieces if self.byte_level else [p.lower() for p in pieces]
        out: list[bytes] = [b""] * len(pieces)
        simple, find = self.simple.fullmatch, (_BYTE_PARTS if self.byte_level else _WORD_PARTS).findall
        words, split = [], {}
        for i, text in enumerate(texts):
            if simple(text):
                words.append(i)
            elif _PLAIN.fullmatch(pieces[i]):
                split[i] = find(text)
            else:
                out[i] = self._whole(pieces[i])
        for i, value in zip(words, self._tokenize([texts[i] for i in words]), strict=True):
            out[i] = value
        distinct = list(dict.fromkeys(p for ps in split.values() for p in ps))
        parts = dict(zip(distinct, self._tokenize(distinct), strict=True))
        for i, ps in split.items():
            out[i] = b"".join([parts[p] for p in ps])
        return out

    def _slice(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where they end."""
        joined = pa.array(texts, pa.large_string())
        bounds = np.frombuffer(joined.buffers()[1], np.int64, len(texts) + 1)
        data = joined.buffers()[2]
        raw = np.frombuffer(data or b"", np.uint8, bounds[-1])
        begins = np.zeros(len(raw) + 1, bool)
        begins[:-1] = _cuts(raw)
        begins[bounds] = True
        at = np.flatnonzero(begins)
        words = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), data)
        taken = self.known.values_of(words, self._encode_new)
        ends = np.frombuffer(taken.buffers()[1], np.int64, len(words) + 1) // self.kind.itemsize
        flat = np.frombuffer(taken.buffers()[2] or b"", self.kind, ends[-1])
        return flat, ends[np.searchsorted(at, bounds[1:])]

    def encode(self, texts: Iterable[str | None]):
        """The id array of every text, in order."""
        held: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            if held and size + len(text) > SLICE_CHARS:
                yield from self._split(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        if held:
            yield from self._split(held)

    def _split(self, texts: list[str]):
        whole = {
            i for i, t in enumerate(texts)
            if (self.byte_level and _joins_spaces(t)) or (self.special and self.special.search(t))
        }
        ids, ends = self._slice(["" if i in whole else t for i, t in enumerate(texts)])
        at = 0
        for i, end in enumerate(ends.tolist()):
            yield np.frombuffer(self._whole(texts[i]), self.kind) if i in whole else ids[at:end]
            at = end


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(vocabulary: str, special_as_text: bool = False) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if (vocabulary, special_as_text) not in _ENCODERS:
        _ENCODERS[vocabulary, special_as_text] = Encoder(vocabulary, special_as_text)
    return _ENCODERS[vocabulary, special_as_text]

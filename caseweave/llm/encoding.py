"""Fast exact encoding with a public BPE tokenizer.

Texts are cut where the tokenizer itself always cuts, at white space, and each distinct piece is
encoded once per worker: a bounded cache holds its ids. A text with white space that the cut can't
reproduce is encoded whole, so the ids are those of the tokenizer on the whole text in every case.
Strings like ``<|endoftext|>`` in a text give the ids that the tokenizer's plain call gives, those of the
added tokens; with ``special_as_text`` they are ordinary text. A text that may hold one is encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Pieces that one cache generation holds; the last two generations are kept.
CACHE_PIECES = 350_000
#: The same for the parts that pieces are made of, as far as the tokenizer's own pattern parts them.
CACHE_PARTS = 20_000

_FOREIGN_SPACE = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LONG_PIECE = 256

#: Patterns of the two kinds of files, for pieces of ASCII and Latin-1 letters. White space is
#: ASCII here; other pieces go to the tokenizer.
_PLAIN = re.compile(r"[\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ÿ]*\Z")
_PARTS = {
    "spaces": re.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+"
    ),
    "words": re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+"),
}


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Cache(dict):
    """Piece -> ids as bytes; a missing piece is looked up in the last generation, or encoded."""

    def __init__(self, encode, size: int):
        super().__init__()
        self.encode, self.size, self.old = encode, size, {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= _LONG_PIECE:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """``encode(utf8) -> numpy array of ids`` with the given tokenizer file."""

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model, self.code = self.tokenizer.model, {2: "H", 4: "I"}[self.dtype.itemsize]
        self.kind = self._kind(spec)
        self.added = [] if special_as_text else self._added(spec)
        self.parts = _PARTS.get(self.kind)
        letters = _byte_letters()
        self.letters = {b: "".join(letters[x] for x in chr(b).encode()) for b in range(256)}
        self.cache, self.known = _Cache(self._piece, CACHE_PIECES), _Cache(self._part, CACHE_PARTS)

    @staticmethod
    def _kind(spec: dict) -> str:
        """Where pieces may be cut: before single spaces, at all white space, or nowhere."""
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        plain = spec["model"].get("type") == "BPE" and not spec["model"].get("dropout")
        plain = plain and all(t["content"].isascii() for t in spec.get("added_tokens") or [])
        if plain and not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            return "spaces"
        inner = [x["type"] for x in pre.get("pretokenizers", [])]
        cleans = [x["type"] for x in norm.get("normalizers", [])]
        if plain and inner == ["Split", "ByteLevel"] and cleans == ["NFC", "Replace", "Lowercase"]:
            split = pre["pretokenizers"][0]
            if split["behavior"] == "Removed" and split["invert"] and r"[\p{N}]|" in split["pattern"]["Regex"]:
                return "words"
        return "whole"

    def _added(self, spec: dict) -> list[bytes]:
        """What to look for in texts that may hold an added token; lower-cased where a normaliser lowers texts."""
        names = [t["content"].encode() for t in spec.get("added_tokens") or []]
        if self.kind == "words":
            names = [n.lower() for n in names]
            # the Kelvin sign is the one letter outside ASCII that becomes a single letter inside
            names += ["\u212a".encode()] * any(b"k" in n for n in names)
        return names

    def _special(self, data: np.ndarray) -> Iterator[int]:
        """Places of added tokens."""
        held = data.tobytes() if self.added else b""
        for name in self.added:
            at = held.find(name)
            while at >= 0:
                yield at
                at = held.find(name, at + 1)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _part(self, part: str) -> bytes:
        if part.isascii() and part.isprintable():
            part = part.replace(" ", self.letters[32])
        else:
            part = part.translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(part)]).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8", "replace")
        if not (piece.isascii() or _PLAIN.match(text)):
            return self._whole(text)
        if self.kind == "words":
            text = text.lower()
        return b"".join(map(self.known.__getitem__, self.parts.findall(text)))

    def encode_rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids start (one more at the end).

        ``data`` and ``offsets`` are the UTF-8 bytes of the texts as in ``common.texts``.
        """
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(offsets), np.int64)
        space = _SPACE[data]
        cut = np.zeros(len(data), bool)
        if self.kind != "whole":
            cut[1:] = space[1:] & ~space[:-1]
        foreign = set()
        low = _LOWER[data] if self.kind == "words" else data
        if self.kind != "whole":
            found = [m.start() for m in _FOREIGN_SPACE.finditer(data)]
            found += self._special(low)
            foreign = set((np.searchsorted(offsets, found, "right") - 1).tolist())
            for row in foreign:
                cut[offsets[row] : offsets[row + 1]] = False
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        cuts = np.append(np.flatnonzero(cut), len(data))
        if self.kind == "words":
            for row in foreign:
                low[offsets[row] : offsets[row + 1]] = data[offsets[row] : offsets[row + 1]]
            data = low
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(np.ascontiguousarray(cuts, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        each = pieces.indices.to_numpy()
        whole = set()
        if self.kind == "whole" or foreign:
            rows = range(len(offsets) - 1) if self.kind == "whole" else foreign
            at = np.searchsorted(cuts, [offsets[r] for r in rows if offsets[r] < offsets[r + 1]])
            whole = set(each[at].tolist())
        get = self.cache.__getitem__
        ids = [
            self._whole(x.decode("utf-8", "replace")) if i in whole else get(x)
            for i, x in enumerate(pieces.dictionary.to_pylist())
        ]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(ids), self.dtype)
        first = np.cumsum(sizes) - sizes
        lengths = sizes[each]
        ends = np.cumsum(lengths)
        total = int(ends[-1])
        take = np.repeat(first[each] - (ends - lengths), lengths)
        take += np.arange(total)
        starts = np.concatenate([[0], ends])[np.searchsorted(cuts, offsets)]
        return flat[take], starts

    def encode(self, text: bytes) -> np.ndarray:
        return self.encode_rows(np.frombuffer(text, np.uint8), np.array([0, len(text)], np.int64))[0]


@lru_cache(maxsize=4)
def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """One encoder per worker, file and reading of special strings, kept between tasks."""
    return Encoder(path, special_as_text)


def tokenizer_path(name: str) -> str:
    """Where a file of the public tokenizers lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)

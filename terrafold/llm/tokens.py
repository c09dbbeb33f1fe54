"""Exact tokenisation with a memo of pre-token pieces.

The vocabulary's pre-tokeniser cuts a text into pieces that are encoded on
their own, so the ids of a piece can be remembered.  The memo is used for
texts of ASCII and Latin-1 letters, where the splitting pattern can be written
out exactly; all other texts, those with special strings, and all texts under a
vocabulary file that splits differently go through the library itself.  Either
way the ids are those of the library.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

# The splitting pattern of the vocabulary file, with its Unicode
# classes restricted to U+0000-U+007F and U+00A0-U+00FF in lower case.
_L, _N, _S = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \xa0"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_OTHER = re.compile("[^\x00-\x7f\xa0-\xff]|<\\|")

# The settings of a vocabulary file under which that pattern holds.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
_PRETOKENIZERS = [{"type": "Split", "pattern": _SPLIT, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]

#: Entries of each of the two generations of a worker's memo.
MEMO_LIMIT = 150_000


def _byte_letters() -> dict[int, str]:
    """The letters by which the vocabulary writes the UTF-8 bytes of U+0000-U+00FF.

    Printable Latin-1 bytes stand for themselves, the others in order for the
    code points from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    letter = [chr(b) if b in plain else chr(next(others)) for b in range(256)]
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


class _Memo(dict):
    """Ids of pieces as bytes; pieces of the last generation move up when met."""

    def __init__(self, model, old):
        self.model, self.old, self.letters = model, old, _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("I", [t.id for t in self.model.tokenize(piece.translate(self.letters))]).tobytes()
        self[piece] = ids
        return ids


def splits_as_written(path: str) -> bool:
    """Whether the file splits texts by ``_PIECE`` and marks special strings by ``<|``."""
    with open(path, encoding="utf-8") as f:
        has = json.load(f)
    cuts = has.get("normalizer") == {"type": "Sequence", "normalizers": _NORMALIZERS} and has.get("pre_tokenizer") == {"type": "Sequence", "pretokenizers": _PRETOKENIZERS}
    plain = all(has.get(k) is None for k in ("truncation", "padding", "post_processor")) and not has["model"].get("dropout")
    return cuts and plain and all(t["content"].startswith("<|") for t in has.get("added_tokens", []))


class PieceTokenizer:
    """Ids of texts under a tokenizers .json file, as little-endian uint32 bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.by_pieces = splits_as_written(path)
        self.memo = _Memo(self.library.model, {})

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return np.asarray(ids, dtype="<u4").tobytes()

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        if len(self.memo) > MEMO_LIMIT:
            self.memo = _Memo(self.memo.model, self.memo)
            self.memo.old.old = {}
        return list(map(self.memo.__getitem__, pieces))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text (null: none) without added special tokens."""
        if not text:
            return b""
        if not self.by_pieces or _OTHER.search(text):
            return self._pack(self.library.encode(text, add_special_tokens=False).ids)
        return b"".join(self._ids_of(_PIECE.findall(text.lower())))

    def count(self, text: str | None) -> int:
        return len(self.encode(text)) // 4

    def encode_with_starts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(start offset in the text, id) of each token; later tokens of a piece may share its start."""
        if not self.by_pieces or _OTHER.search(text):
            e = self.library.encode(text, add_special_tokens=False)
            return np.array([s for s, _ in e.offsets], dtype=np.int64), np.array(e.ids, dtype=np.int64)
        found = [(m.start(), m.group()) for m in _PIECE.finditer(text.lower())]
        ids = self._ids_of([p for _, p in found])
        starts = np.repeat(np.array([s for s, _ in found], dtype=np.int64), np.array([len(x) // 4 for x in ids], dtype=np.int64))
        return starts, np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int64)


_open: dict[str, PieceTokenizer] = {}


def tokenizer(name_or_path: str) -> PieceTokenizer:
    """The tokenizer of this worker for a file name of the public set, or a path."""
    if name_or_path not in _open:
        path = name_or_path
        if not os.path.exists(path):
            import public_tokenizers

            path = public_tokenizers.path(name_or_path)
        _open[name_or_path] = PieceTokenizer(path)
    return _open[name_or_path]

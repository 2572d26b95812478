"""Byte-level BPE token ids through the tokenizers library, with a cache of chunks.

The vocabulary's pre-tokenizer always starts a new piece at a space that follows a character
other than white space, and merges never cross pieces. So a text can be cut at its spaces and
each distinct chunk split into pieces and merged once per Python worker, by the library's BPE
model. A chunk that begins or ends with white space, holds adjacent white space, or holds
characters outside the ranges below (where definitions of white space and letters vary between
Unicode versions) sends its text to the library whole, and so does the content of an added token
(`<|endoftext|>`), which the library reads as that token wherever it stands. Both ways give the ids of the whole
text; tests hold them against each other."""

from __future__ import annotations

import os
import re

import numpy as np

CACHE_ENTRIES = 500_000  # per Python worker and cache; what comes later is worked out each time

_ODD = re.compile(r"\s\s|^\s|\s$|[^\t\n\r\x20-\x7e\xa1-ɏ]|^$")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_WORKER: dict[str, "ChunkEncoder"] = {}


def bpe_json_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class _Pieces(dict):
    """Ids of one pre-tokenizer piece, by the library's BPE model."""

    def __init__(self, tok, dtype):
        from tokenizers.pre_tokenizers import ByteLevel
        self.model = tok.model
        self.id_bytes = [i.to_bytes(dtype.itemsize, "little") for i in range(tok.get_vocab_size())]
        # the model's alphabet: one printable character for each byte
        split = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        known = {b: split(bytes([b]).decode())[0][0] for b in range(128)}
        for first in range(0xC2, 0xF5):
            tail = {0xE0: b"\xa0\x80", 0xF0: b"\x90\x80\x80"}.get(
                first, b"\x80" * (1 if first < 0xE0 else 2 if first < 0xF0 else 3))
            known[first] = split((bytes([first]) + tail).decode())[0][0][0]
        for last in range(0x80, 0xC0):
            known[last] = split(bytes([0xC2, last]).decode())[0][0][1]
        self.alphabet = known  # by latin-1 code point, for str.translate

    def __missing__(self, piece: str) -> bytes:
        ids = self.ids(piece)
        if len(self) < CACHE_ENTRIES:
            self[piece] = ids
        return ids

    def ids(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():  # of these only the space has a stand-in
            text = piece.replace(" ", self.alphabet[32])
        else:
            text = piece.encode().decode("latin-1").translate(self.alphabet)
        return b"".join([self.id_bytes[t.id] for t in self.model.tokenize(text)])


class _Chunks(dict):
    """Ids of a chunk after its space; None for one that only its whole text decides."""

    def __init__(self, pieces: _Pieces):
        import public_tokenizers
        import regex
        self.pieces, self.split = pieces, regex.compile(public_tokenizers.PATTERN).findall
        self.tokenize, self.space = pieces.model.tokenize, pieces.alphabet[32]

    def __missing__(self, chunk: str) -> bytes | None:
        if chunk.isalpha():
            if chunk.isascii():  # bytes and the model's characters are the same but for the space
                by_id = self.pieces.id_bytes
                ids = b"".join([by_id[t.id] for t in self.tokenize(self.space + chunk)])
            else:
                ids = None if _ODD.search(chunk) else self.pieces.ids(" " + chunk)
        else:
            word = chunk.rstrip(_MARKS)
            if word.isalpha():  # a word and marks are two pieces
                ids = self[word]
                ids = ids and ids + self.pieces[chunk[len(word):]]
            elif _ODD.search(chunk):
                ids = None
            else:
                ids = b"".join([self.pieces[p] for p in self.split(" " + chunk)])
        if len(self) < CACHE_ENTRIES:
            self[chunk] = ids
        return ids


class ChunkEncoder:
    """Token ids of texts as little-endian bytes, `width` bytes an id (2 if the vocabulary
    allows it, else 4)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype("<u2" if self.width == 2 else "<u4")
        self.chunks = _Chunks(_Pieces(self.tok, self.dtype))

    def whole(self, text: str) -> bytes:
        """The library's ids of one text, without the cache."""
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        head, *rest = text.split(" ")
        if _ODD.search(head) or any([a in text for a in self.added]):
            return self.whole(text) if text else b""
        get = self.chunks.__getitem__
        try:
            ids = b"".join(map(get, rest))
        except TypeError:
            return self.whole(text)
        return b"".join([self.chunks.pieces[p] for p in self.chunks.split(head)]) + ids

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text), self.dtype)


def worker_encoder(path: str) -> ChunkEncoder:
    """The encoder of this Python worker for a vocabulary file."""
    if path not in _WORKER:
        _WORKER[path] = ChunkEncoder(path)
    return _WORKER[path]

"""Token ids by the tokenizers library, cached by piece: a piece is tokenised once, then looked up."""

from __future__ import annotations

import os
import re
from array import array
from functools import cache

#: White space of one byte; texts with any other kind take the plain way.
_SPACE = r" \t\n\r\x0b\x0c"
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CONTROL_SPACE = re.compile("[\x1c-\x1f]")


class _Cache(dict):
    def __init__(self, make):
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.make(piece)
        return ids


class PieceEncoder:
    """Encodes whole texts to little-endian unsigned 32-bit ids, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    Pieces are cut where neither vocabulary's pre-tokenizer lets a token cross. kind "byte": before the one space that precedes
    a word, and around runs of white space. kind "word": white space is dropped, and pieces are what stands between it. A piece
    of letters, with full stops and commas after it or not, goes straight to the library's BPE model; any other is encoded
    by the whole tokenizer. The cache is bounded, so memory doesn't grow with the vocabulary.
    """

    def __init__(self, path: str, kind: str, most: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model.tokenize
        self.bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.byte, self.most = kind == "byte", most
        self.space = self.bytes_of(" ")[0][0]
        #: Strings that are tokens wherever they stand; a text with one takes the plain way.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = _Cache(self._make)
        self.pattern = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]" if self.byte else f"[^{_SPACE}]+")

    def direct(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _make(self, piece: str) -> bytes:
        lead = self.byte and piece[0] == " "
        body = piece[1:] if lead else piece
        core = body.rstrip(".,")
        if not core.isalpha():
            return self.direct(piece)
        tail = body[len(core) :]
        if tail:
            return self.cache[piece[: len(piece) - len(tail)]] + self.cache[tail]
        if core.isascii():
            mapped = core if self.byte else core.lower()
        else:
            if not self.byte:
                core = self.tokenizer.normalizer.normalize_str(core)
                if not core.isalpha():
                    return self.direct(piece)
            mapped = self.bytes_of(core)[0][0]
        return array("I", [t.id for t in self.model(self.space + mapped if lead else mapped)]).tobytes()

    def __call__(self, text: str | None) -> bytes:
        """The ids of a text, as bytes."""
        text = text or ""
        if (_CONTROL_SPACE if text.isascii() else _OTHER_SPACE).search(text) or any(a in text for a in self.added):
            return self.direct(text)
        if len(self.cache) > self.most:
            self.cache.clear()
        return b"".join(map(self.cache.__getitem__, self.pattern.findall(text)))


@cache
def encoder(path: str, kind: str) -> PieceEncoder:
    """One encoder a worker process, so that what it has learned serves the next task."""
    return PieceEncoder(path, kind)

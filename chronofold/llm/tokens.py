"""Token ids of whole texts, each distinct piece of text encoded by the tokenizers library once."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np

MAX_CACHED = 1_500_000  # pieces, about 200 bytes each; half of them go when it is full: those not met since the last time
MAX_PIECE = 64  # characters of a piece that is kept
TOGETHER = 1024  # words that are encoded as one text

# Where the supported split patterns part a text whatever else stands in it: a word of Latin letters, with
# the space before it, between spaces, line ends and plain points; a run of plain points likewise; a single line end
# between visible characters. All else goes as a whole up to the next single space between visible characters.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_POINTS = r".,;:!?*$%&#"
_PIECES = re.compile(
    rf" ?[{_LETTERS}]++(?=[ \n{_POINTS}]|\Z)"
    rf"| ?[{_POINTS}]++(?=[ \n{_LETTERS}]|\Z)"
    rf"|\n(?=[{_LETTERS}{_POINTS}])"
    r"|\s*\S+(?:(?! \S)\s+(?:\S+|\Z))*|\s+"
)
WORD_END = "</w>"
_WORD = re.compile(rf" ?[{_LETTERS}]+")


class Encoder:
    """Texts to little-endian unsigned ids, of 32 bits or as ``kind`` says. Exactly what ``encode(text, add_special_tokens=False)`` gives for the whole text.

    Strings of special tokens in a text become those tokens, as in the plain call of the library.
    """

    def __init__(self, path: str, max_cached: int = MAX_CACHED, kind: str = "<u4") -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}
        self._max_cached = max_cached
        self._kind, self._width = kind, np.dtype(kind).itemsize
        # Letter case and white space are nothing to some vocabularies; their tokens mark the ends of words.
        self._folds = self._ids(" A") == self._ids("a")
        tokens = sorted(self._tokenizer.get_vocab().items(), key=lambda t: t[1])
        self._sizes = np.zeros(tokens[-1][1] + 1, np.int64)
        for token, i in tokens:
            self._sizes[i] = token.endswith(WORD_END) if self._folds else len(token)

    @property
    def size(self) -> int:
        return self._tokenizer.get_vocab_size()

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        cut = [self._pieces(text) for text in texts]
        if len(self._known) > self._max_cached // 2:
            self._known, self._before = {}, self._known
        known, before = self._known, self._before
        missing = set(chain.from_iterable(cut)).difference(known)
        if missing:
            for piece in missing.intersection(before):
                known[piece] = before.pop(piece)
            self._learn(missing.difference(known))
        made = [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
        for piece in missing:
            if len(piece) > MAX_PIECE:
                del known[piece]
        return made

    def _pieces(self, text: str) -> list[str]:
        if self._special is None or "<" not in text:
            return _PIECES.findall(text)
        parts = self._special.split(text)
        return [p for i, part in enumerate(parts) for p in ([part] if i % 2 else _PIECES.findall(part))]

    def _ids(self, text: str) -> list[int]:
        return self._many([text])[0]

    def _many(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: set[str]) -> None:
        words = [p for p in pieces if len(p) <= MAX_PIECE and _WORD.fullmatch(p)]
        if self._folds:
            plain = {w: w.strip().lower() for w in words}
            found: dict[str, bytes] = {}
            self._learn_words(list(set(plain.values())), " ", found)
            self._known.update((w, found[p]) for w, p in plain.items())
        else:
            self._learn_words([p for p in words if p[0] == " "], "", self._known)
            self._learn_words([p for p in words if p[0] != " "], "\n", self._known)
        self._learn_each(list(pieces.difference(words)), self._known)

    def _learn_each(self, pieces: list[str], into: dict[str, bytes]) -> None:
        for i in range(0, len(pieces), 256):
            some = pieces[i : i + 256]
            into.update(zip(some, [np.asarray(ids, self._kind).tobytes() for ids in self._many(some)], strict=True))

    def _learn_words(self, words: list[str], between: str, into: dict[str, bytes]) -> None:
        """Words of letters, many in one text; where each ends follows from the sizes of its tokens."""
        for i in range(0, len(words), TOGETHER):
            some = words[i : i + TOGETHER]
            ids = np.asarray(self._ids(between.join(some)), self._kind)
            done = np.cumsum(self._sizes[ids])
            ends = np.arange(1, len(some) + 1) if self._folds else np.cumsum([len(w.encode()) + len(between) for w in some]) - len(between)
            last = np.searchsorted(done, ends)  # the token that completes each word
            if not len(ids) or done[-1] != ends[-1] or (done[last] != ends).any():
                self._learn_each(some, into)  # tokens do not part where words do
                continue
            first = np.concatenate([[0], last[:-1] + 1 + (0 if self._folds else len(between))])
            whole, cuts = ids.tobytes(), zip((self._width * first).tolist(), (self._width * (last + 1)).tolist(), strict=True)
            into.update(zip(some, [whole[a:b] for a, b in cuts], strict=True))


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, max_cached: int = MAX_CACHED, kind: str = "<u4") -> Encoder:
    """The encoder of this Python worker; its cache stays from task to task."""
    key = (path, max_cached, kind)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, max_cached, kind)
    return _ENCODERS[key]


def vocabulary_size(path: str) -> int:
    """Ids of a tokenizer file, special tokens included."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()

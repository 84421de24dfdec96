"""Words of a text and their split into vocabulary pieces."""

from __future__ import annotations

import unicodedata

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from chronofold.functions.text import DIGIT_RUN_PATTERN

# The public sub-word conventions.
PAD, UNKNOWN, START, END = "[PAD]", "[UNK]", "[CLS]", "[SEP]"
CONTINUATION = "##"
MAX_WORD_CHARS = 100
CONTROL_PATTERN = r"[\p{C}\x{FFFD}&&[^\t\n\r]]"
ASCII_PUNCTUATION = r"!-/:-@\[-`{-~"
CJK = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B920}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)


def words_of(text: Column, numbers: bool = False) -> Column:
    """Whitespace-separated words; each punctuation mark or CJK character is its own word.

    With ``numbers`` every digit run (see ``digit_runs``) is one word too, wherever it stands: the
    words of a value text whose digits and dots will be set apart.
    """
    run = DIGIT_RUN_PATTERN + "|" if numbers else ""
    digits = "0-9." if numbers else ""

    def words(source: Column, letters: str, marks: str, space: str) -> Column:
        # Letters come first and alone: they are the bulk of a text and cheap to test.
        word = f"(?:[{letters}]++|[^{space}{marks}{digits}])++"
        return F.regexp_extract_all(source, F.lit(f"({word}|{run}[{marks}])"), F.lit(1))

    # Printable ASCII, tabs and line ends only: the narrow classes give the same words.
    ascii_words = words(text, "a-zA-Z", ASCII_PUNCTUATION, r"\x00-\x20\x7F")
    clean = F.regexp_replace(text, CONTROL_PATTERN, "")
    wide_words = words(clean, r"a-zA-Z\xC0-\x{24F}", ASCII_PUNCTUATION + r"\p{P}" + CJK, r"\s\p{Z}")
    return F.when(text.rlike(r"[^\t\n\r -~]"), wide_words).otherwise(ascii_words)


class Pieces:
    """Splits words into the longest vocabulary pieces, in time linear in their length.

    The vocabulary is a trie in flat arrays, in which continuations hang from the node of their mark. A node that cannot go on with a
    character has a link to the node of the longest rest that can, and the pieces that are complete by then; so no character is
    looked at twice. All words of a list walk at once, one step of each at a time.
    """

    def __init__(self, vocab: dict[str, int], lowercase: bool):
        self.lowercase = lowercase
        self.unknown = vocab[UNKNOWN]
        children: list[dict[str, int]] = [{}]
        ends: dict[int, int] = {}

        def insert(text: str) -> int:
            node = 0
            for c in text:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                node = children[node][c]
            return node

        self.inner = insert(CONTINUATION)
        for token, i in vocab.items():
            if token and token != CONTINUATION:
                ends[insert(token)] = i
        self.link, pops = self._links(children, ends)
        self.pop_counts = np.array([len(p) for p in pops])
        self.pops = np.array([i for p in pops for i in p], np.int64)
        self.pop_starts = np.cumsum(self.pop_counts) - self.pop_counts
        self.chars = np.array(sorted({ord(c) for edges in children for c in edges}), np.int64)
        edges = sorted((node * len(self.chars) + int(np.searchsorted(self.chars, ord(c))), to) for node, e in enumerate(children) for c, to in e.items())
        self.edges, self.targets = (np.array(x, np.int64) for x in zip(*edges, strict=True))

    def _links(self, children: list[dict[str, int]], ends: dict[int, int]) -> tuple[np.ndarray, list[list[int]]]:
        """Per node the node to go on from where it has no edge (-1: none), and the pieces that are complete then."""
        link, pops = [-1] * len(children), [[] for _ in children]
        level = [0, self.inner]
        while level:
            below = []
            for node in level:
                for c, child in children[node].items():
                    if child == self.inner:
                        continue
                    below.append(child)
                    if child in ends:
                        link[child], pops[child] = self.inner, [ends[child]]
                        continue
                    at, done = link[node], list(pops[node])
                    while at >= 0 and c not in children[at]:
                        done += pops[at]
                        at = link[at]
                    if at >= 0:
                        link[child], pops[child] = children[at][c], done
            level = below
        return np.array(link, np.int64), pops

    def _step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The edge's end, or -1."""
        at = np.minimum(np.searchsorted(self.chars, char), len(self.chars) - 1)
        key = node * len(self.chars) + at
        edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where((self.chars[at] == char) & (self.edges[edge] == key), self.targets[edge], -1)

    def _plain(self, word: str) -> str:
        folded = unicodedata.normalize("NFD", word.lower())
        return "".join(c for c in folded if unicodedata.category(c) != "Mn")

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words, one after the other, and their number per word; the unknown id for a word some rest of which has no piece."""
        if self.lowercase:
            words = [self._plain(w) for w in words]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        text = np.append(text, -1)
        starts = np.cumsum(sizes) - sizes
        node, place = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        whole = np.zeros(len(words), bool)
        walking = np.flatnonzero((sizes > 0) & (sizes <= MAX_WORD_CHARS))
        found_word, found_node = [], []
        while len(walking):
            here, done = node[walking], place[walking]
            inside = done < sizes[walking]
            to = self._step(here, np.where(inside, text[np.minimum(starts[walking] + done, len(text) - 1)], -1))
            on = to >= 0
            node[walking[on]] = to[on]
            place[walking[on]] += 1
            stuck = walking[~on]
            back = self.link[node[stuck]]
            over = back < 0
            whole[stuck[over]] = (place[stuck[over]] == sizes[stuck[over]]) & (node[stuck[over]] == self.inner)
            popping = stuck[~over]
            found_word.append(popping)
            found_node.append(node[popping])
            node[popping] = back[~over]
            walking = np.concatenate([walking[on], popping])
        word = np.concatenate([*found_word, np.zeros(0, np.int64)])
        from_node = np.concatenate([*found_node, np.zeros(0, np.int64)])
        order = np.argsort(word, kind="stable")
        order = order[whole[word[order]]]
        word, from_node = word[order], from_node[order]
        n = self.pop_counts[from_node]
        ids = self.pops[np.repeat(self.pop_starts[from_node], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        counts = np.bincount(word, weights=n, minlength=len(words)).astype(np.int64)
        # Words without pieces become the unknown id.
        lost = (counts == 0) & (sizes > 0)
        counts[lost] = 1
        out = np.full(counts.sum(), self.unknown, np.int64)
        out[np.repeat(~lost, counts)] = ids
        return out, counts


def split_words(text: str) -> list[str]:
    """``words_of`` for a short ASCII name on the driver."""
    words, current = [], ""
    for c in text:
        if c.isalnum() or ord(c) > 127:
            current += c
            continue
        words += [current] if current else []
        words += [c] if not c.isspace() else []
        current = ""
    return words + ([current] if current else [])

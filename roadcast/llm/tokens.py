"""Whole texts to token ids with a public tokenizer, each distinct word encoded once.

A text is cut before every run of white space, and between Latin letters and the commonest
punctuation after them. Both tokenizer kinds used here (byte-level BPE with its usual
pattern, BPE with word ends) end a token at these places whatever stands around, so the
ids of a text are the ids of its cuts in a row. Texts with white space beyond the ASCII
kinds are encoded whole, since rare spaces take part in runs that this cut would split.
``tests/llm/test_tokens.py`` compares both ways.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from roadcast.llm.common import kept

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
# possessive: a shorter run of letters ends before a letter, a shorter run of spaces before a space
CUT = re.compile(rf"[ \t\n\r]*+(?:[{_LETTER}]++(?=[.,;:|!?])|[^ \t\n\r]++)|[ \t\n\r]++")
#: The same for a tokenizer that drops white space.
BARE_CUT = re.compile(rf"[{_LETTER}]++(?=[.,;:|!?])|[^ \t\n\r]++")
RARE_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\n\r"]
MEMO_WORDS = 500_000
JOINED_WORDS = 500
_SPACES = " \t\n\r"


def encoded_words(tokenizer, words: list[str], bytes_of: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, lengths)``: the ids of all words in a row, and how many each has.

    A word that begins with white space after one that does not end with it is a cut, so with a byte-level
    tokenizer (``bytes_of``: the bytes of each id) such words are encoded as one text and its ids dealt by their
    bytes. A text whose ids do not end where its words end is encoded word by word.
    """
    ids: list[list[int]] = [[]] * len(words)
    alone = list(range(len(words)))
    if bytes_of is not None:
        cuts = [i for i, word in enumerate(words) if word[0] in _SPACES and not word[-1].isspace()]
        groups = [cuts[i : i + JOINED_WORDS] for i in range(0, len(cuts), JOINED_WORDS)]
        texts = ["".join([words[i] for i in group]) for group in groups]
        joined = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        done = set()
        for group, found in zip(groups, joined, strict=True):
            ends = np.cumsum(bytes_of[found])
            stops = np.cumsum([len(words[i].encode()) for i in group])
            at = np.searchsorted(ends, stops)
            if ends[-1] == stops[-1] and (ends[at] == stops).all():
                start = 0
                for i, stop in zip(group, (at + 1).tolist(), strict=True):
                    ids[i] = found[start:stop]
                    start = stop
                done.update(group)
        alone = [i for i in alone if i not in done]
    for i, e in zip(alone, tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False), strict=True):
        ids[i] = e.ids
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths


def byte_lengths(tokenizer) -> np.ndarray | None:
    """The bytes that each id of a byte-level tokenizer stands for (a character of its entry is a byte); None for others."""
    from tokenizers import pre_tokenizers

    if not isinstance(tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) or tokenizer.normalizer is not None:
        return None
    sizes = {i: len(entry) for entry, i in tokenizer.get_vocab(with_added_tokens=False).items()}
    sizes |= {i: len(added.content.encode()) for i, added in tokenizer.get_added_tokens_decoder().items()}
    found = np.zeros(max(sizes, default=0) + 1, np.int64)
    found[list(sizes)] = list(sizes.values())
    return found


class _Places(dict):
    """Word to number; a word asked for the first time gets the next number and is noted as new."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class WordEncoder:
    """Encodes batches of texts; remembers about ``MEMO_WORDS`` words between batches."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        plain, spaced, space = (self.tokenizer.encode(t, add_special_tokens=False).ids for t in ("a", " \na\t", " \n\t"))
        self.bytes_of = byte_lengths(self.tokenizer)
        self.cut = BARE_CUT if plain == spaced and not space else CUT
        self._forget()

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """The encoder of this worker process; it outlives a task."""
        return kept(("words", path), lambda: cls(path))

    def _forget(self) -> None:
        self.places = _Places()
        self.ids = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def _learn(self) -> None:
        flat, lengths = encoded_words(self.tokenizer, self.places.new, self.bytes_of)
        self.places.new = []
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])

    def encode(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: text ``i`` has ``ids[bounds[i]:bounds[i + 1]]``, ``end_id`` last. Null is empty."""
        if len(self.places) > MEMO_WORDS:
            self._forget()
        cuts: list[str] = []
        counts = []
        for text in texts:
            before = len(cuts)
            if text:
                cuts += [text] if any(c in text for c in RARE_SPACES) else self.cut.findall(text)
            counts.append(len(cuts) - before)
        at = np.fromiter(map(self.places.__getitem__, cuts), np.int64, len(cuts))
        if self.places.new:
            self._learn()
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.repeat(self.starts[at] - (ends - lengths), lengths) + np.arange(total)]
        last = np.concatenate(([0], ends))[np.cumsum(counts, dtype=np.int64)]
        bounds = np.concatenate(([0], last + np.arange(1, len(texts) + 1)))
        return np.insert(flat, last, np.uint32(end_id)), bounds

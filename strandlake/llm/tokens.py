"""Token ids of many texts with a public word-level BPE vocabulary, through the tokenizers library.

The vocabulary's pre-tokenizer never joins characters across white space or between letters, digits and other
characters, so the ids of a text are those of its pre-tokens in turn. Texts of plain Latin letters and ASCII are lowered
and cut into pre-tokens here; others into their space-separated chunks, which the library lowers, composes and cuts.
Each distinct part goes through the library once while a worker's bounded cache holds it.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np

from .common import kept

#: Distinct parts that a worker remembers, and their characters; the half used longest ago goes when there are more.
CACHED, CHARACTERS = 400_000, 16_000_000
#: Text bytes encoded at a time; the library's results for new parts take many times their size.
AT_ONCE = 1 << 19

# The vocabulary's mark of a pre-token's end, its published splitting pattern over the letters of _PLAIN, and Unicode's white space.
_END = "</w>"
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u017f"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\t-\\r 0-9{_LETTERS}]+")
#: Pieces that are one pre-token as they stand, whatever stands around them.
_ONE = re.compile(f"[{_LETTERS}]+|[0-9]|[!-/:-@\\[-`{{-~]+")
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Characters whose lower case and composition are beyond doubt.
_PLAIN = re.compile("[\t-\r -~\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf-\u012f\u0131-\u017f\u2010-\u2027\u20ac]*")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """encode(texts) gives all ids as one uint32 array and the number of each text's ids, each with end_id last."""

    def __init__(self, vocab: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary(vocab))
        self.end_id = end_id
        self.last = np.zeros(self.library.get_vocab_size(), bool)  # ids that end a pre-token
        self.last[[i for w, i in self.library.get_vocab().items() if w.endswith(_END)]] = True
        self.known: dict[str, int] = {}
        self.held = 0
        self.ids = np.zeros(0, np.uint32)
        self.first = np.zeros(1, np.int64)
        self.used = np.zeros(0, np.int64)
        self.turn = 0

    def _forget(self) -> None:
        """Keeps the half of the parts that was used last."""
        keep = self.used > np.median(self.used)
        sizes = np.diff(self.first)
        self.ids = self.ids[np.repeat(keep, sizes)]
        self.first = np.concatenate(([0], np.cumsum(sizes[keep])))
        self.used = self.used[keep]
        self.known = {w: i for i, w in enumerate(w for w, k in zip(self.known, keep.tolist(), strict=True) if k)}
        self.held = sum(map(len, self.known))

    def _learn(self, parts: list[str]) -> None:
        """Single pre-tokens go through the library as one text, which is faster; other parts one by one."""
        single = [bool(_ONE.fullmatch(p)) for p in parts]
        alone = [p for p, s in zip(parts, single, strict=True) if s]
        others = [p for p, s in zip(parts, single, strict=True) if not s]
        ids, sizes = [self.ids], []
        if alone:
            ids.append(np.array(self.library.encode_batch_fast([" ".join(alone)], add_special_tokens=False)[0].ids, np.uint32))
            sizes.append(np.diff(np.flatnonzero(self.last[ids[-1]]), prepend=-1))
        if others:
            coded = self.library.encode(others, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(coded.ids, np.uint32))
            sizes.append(np.bincount(np.array(coded.word_ids, np.int64), minlength=len(others)))
        self.known.update(zip(alone + others, range(len(self.known), len(self.known) + len(parts)), strict=True))
        self.held += sum(map(len, parts))
        self.ids = np.concatenate(ids)
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(np.concatenate(sizes))))
        self.used = np.concatenate((self.used, np.full(len(parts), self.turn)))

    @staticmethod
    def _parts(text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return _PIECE.findall(text.lower())
        return [c for c in _SPACE.split(text) if c]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        self.turn += 1
        if len(self.known) > CACHED or self.held > CHARACTERS:
            self._forget()
        cut = [self._parts(t) for t in texts]
        parts = [p for c in cut for p in c]
        at = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
        new = np.flatnonzero(at < 0)
        if len(new):
            missing = [parts[i] for i in new]
            self._learn(list(dict.fromkeys(missing)))
            at[new] = list(map(self.known.__getitem__, missing))
        self.used[at] = self.turn
        size = self.first[at + 1] - self.first[at]
        ends = np.concatenate(([0], np.cumsum(size)))
        flat = self.ids[np.repeat(self.first[at] - ends[:-1], size) + np.arange(ends[-1])]
        counts = np.diff(ends[np.concatenate(([0], np.cumsum([len(c) for c in cut], dtype=np.int64)))]) + 1
        out = np.full(len(flat) + len(texts), self.end_id, np.uint32)
        body = np.ones(len(out), bool)
        body[np.cumsum(counts) - 1] = False
        out[body] = flat
        return out, counts


def encoder(vocab: str, end_id: int) -> Encoder:
    """One encoder for all tasks of a stage that a worker runs."""
    return kept((vocab, end_id), lambda: Encoder(vocab, end_id))

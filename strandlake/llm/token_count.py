"""Token counts of byte-level BPE by merging alone: no identifier is ever looked up.

The symbols of a pre-token form a linked list; a heap holds its adjacent pairs that have a rank. The lowest-ranked pair,
leftmost first, is merged again and again; the count is the number of bytes less the number of merges.
"""

from __future__ import annotations

import json
import re
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, kept, record, slices, table, text_buffer, trimmed
from .tokens import vocabulary

VOCAB, LIMIT = "byte_bpe_50k.json", 1024
#: Distinct pre-tokens whose counts a worker remembers; the half used longest ago goes when there are more.
CACHED = 700_000

# The vocabulary's published splitting pattern, and Unicode's white space as its matcher has it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Texts of these characters are cut by the same pattern over their own letters, digits and white space.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_PLAIN = re.compile(f"[\t-\r -~\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7{_LETTERS}\u2010-\u2027\u20ac]*")


def _pattern(letters: str, digits: str, space: str) -> str:
    """PATTERN over the given classes of letters, digits and white space."""
    return f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?[^{space}{letters}{digits}]+|[{space}]+(?![^{space}])|[{space}]+"


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: itself, or the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Counter:
    """count(text) for one vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, vocab: str):
        with open(vocabulary(vocab), encoding="utf-8") as file:
            spec = json.load(file)
        symbol = {c: b for b, c in enumerate(_byte_letters())}
        self.rank: dict[int, int] = {}  # of two symbols, left << 20 | right
        self.made: list[int] = []  # the symbol that the merge of each rank makes
        for i, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[symbol[left] << 20 | symbol[right]] = i
            self.made.append(symbol.setdefault(left + right, len(symbol)))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split_special = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) or "(?!)")
        self.any = regex.compile(_pattern(r"\p{L}", r"\p{N}", SPACE))
        self.plain = re.compile(_pattern(_LETTERS, "0-9", r"\t-\r "))
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def merged(self, pretoken: str) -> int:
        """Symbols of one pre-token after all merges."""
        symbols = list(pretoken.encode())
        n = count = len(symbols)
        get, made = self.rank.get, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = [get(a << 20 | b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]  # of the pair that begins here
        ranks.append(-1)
        heap = [r << 32 | i for i, r in enumerate(ranks) if r >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            if ranks[i] != r:
                continue  # one of the two was merged meanwhile
            j = after[i]
            k = after[i] = after[j]
            symbols[i] = new = made[r]
            ranks[j] = -1
            count -= 1
            if k < n:
                before[k] = i
                ranks[i] = r = get(new << 20 | symbols[k], -1)
                if r >= 0:
                    heappush(heap, r << 32 | i)
            else:
                ranks[i] = -1
            h = before[i]
            if h >= 0:
                ranks[h] = r = get(symbols[h] << 20 | new, -1)
                if r >= 0:
                    heappush(heap, r << 32 | h)
        return count

    def _piece(self, text: str) -> int:
        """A text without special strings."""
        found = (self.plain if _PLAIN.fullmatch(text) else self.any).findall(text)
        known = self.known
        if len(known) > CACHED // 2:
            self.older, self.known = known, {}
            known = self.known
        new = [p for p in set(found) if p not in known]
        older, merged = self.older.get, self.merged
        for p in new:
            n = older(p)
            known[p] = merged(p) if n is None else n
        return sum(map(known.__getitem__, found))

    def __call__(self, text: str) -> int:
        if any(s in text for s in self.special):
            pieces = self.split_special.split(text)
            return len(pieces) - 1 + sum(map(self._piece, pieces))
        return self._piece(text)


def counter(vocab: str) -> Counter:
    """One counter for all tasks of a stage that a worker runs."""
    return kept((vocab,), lambda: Counter(vocab))


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = VOCAB, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row: UTF-8 bytes and tokens of the text, n_tokens > limit.

    Null and empty texts count 0. Special strings inside a text are one token each, as the library has it. Repeated rows
    and null ids each give a row; other columns are ignored; an empty table gives an empty result.
    """
    ddl = "doc_id long,n_bytes long,n_tokens long"

    def run(batches):
        count = counter(vocab)
        for batch in slices(batches):
            _, ends = text_buffer(batch.column(1))
            yield record(ddl, batch.column(0), np.diff(ends), [count(t) for t in batch.column(1).to_pylist()])

    return documents(df, id_col, text_col).mapInArrow(trimmed(run), ddl).withColumn("over_limit", F.col("n_tokens") > limit)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
